"""Declarative source specifications, strictly checked when they are loaded."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any
from urllib.parse import urlsplit

from .functions.transforms import ARRAY, COMPOUND, SCALAR
from .schema import PATHS

FORMATS = ("csv", "ods", "xlsx", "xls", "json", "pdf", "html")
#: The assigned ISO 639-1 codes.
LANGUAGES = frozenset(
    "aa ab ae af ak am an ar as av ay az ba be bg bh bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el en eo es et eu"
    " fa ff fi fj fo fr fy ga gd gl gn gu gv ha he hi ho hr ht hu hy hz ia id ie ig ii ik io is it iu ja jv ka kg ki kj kk kl km kn"
    " ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv mg mh mi mk ml mn mr ms mt my na nb nd ne ng nl nn no nr nv ny oc oj om or os"
    " pa pi pl ps pt qu rm rn ro ru rw sa sc sd se sg si sk sl sm sn so sq sr ss st su sv sw ta te tg th ti tk tl tn to tr ts tt tw"
    " ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu".split()
)
UNSET: Any = type("Unset", (), {"__repr__": lambda s: "UNSET", "__bool__": lambda s: False})()


class ConfigError(ValueError):
    """All that is wrong with a specification, one line each."""


@dataclass(frozen=True)
class Mapping:
    """How one field of the record is made; ``UNSET`` tells an absent value from a stated null."""

    field: str | None = None
    fields: tuple[str, ...] = ()
    constant: Any = UNSET
    transform: str | None = None
    array_transform: str | None = None
    compound_transform: str | None = None
    lookup: dict[str, str | None] | None = None
    null_values: tuple[str, ...] = ()
    default: Any = UNSET


@dataclass(frozen=True)
class Merge:
    fields: tuple[str, ...]
    separator: str = ", "
    set_on_merge: dict[str, str | None] = field(default_factory=dict)


@dataclass(frozen=True)
class Join:
    name: str
    file: str
    key: str
    on: str
    merge: Merge | None = None


@dataclass(frozen=True)
class Source:
    id: str
    label: str
    country: str
    language: str
    encoding: str
    primary: str
    source_id: str
    registration: str
    mapping: dict[str, Mapping]
    download: dict[str, Any] = field(default_factory=dict)
    delimiter: str = ","
    trim_all: bool = False
    quoted_line_ends: bool = False
    format: str = "csv"
    record_path: str = ""
    pdf: dict[str, Any] | None = None
    record_count: dict[str, Any] | None = None
    sheet: str | int = 0
    skip_rows: int = 0
    columns: dict[str, list[str]] = field(default_factory=dict)
    allowed_ragged_rows: dict[str, int] = field(default_factory=dict)
    allowed_missing: dict[str, Any] | None = None
    latest_snapshot_by: str | None = None
    joins: tuple[Join, ...] = ()
    source_id_transform: str | None = None
    cadence_days: int | None = None
    merge: Merge | None = None


class _Check:
    """Collects problems, each under the path where it is."""

    def __init__(self) -> None:
        self.found: list[str] = []

    def __call__(self, ok: Any, message: str) -> bool:
        if not ok:
            self.found.append(message)
        return bool(ok)

    def keys(self, at: str, d: dict, allowed: str) -> None:
        for k in sorted(set(d) - set(allowed.split())):
            self.found.append(f"{at}: unknown key {k}")

    def text(self, at: str, d: dict, key: str, required: bool = True) -> None:
        if key in d or required:
            self(isinstance(d.get(key), str) and d[key], f"{at}.{key}: a non-empty text is needed")

    def regex(self, at: str, pattern: Any, groups: int | None = None) -> None:
        try:
            n = re.compile(pattern).groups
            self(groups is None or n == groups, f"{at}: exactly {groups} capture group is needed")
        except (re.error, TypeError):
            self.found.append(f"{at}: not a regular expression")


def _origin(url: str) -> tuple:
    u = urlsplit(url)
    return u.scheme, u.hostname, u.port


def _check_mapping(c: _Check, at: str, m: dict) -> Mapping:
    c.keys(at, m, "field fields constant transform array_transform compound_transform lookup null_values default")
    origins = [k for k in ("field", "fields", "constant") if k in m]
    c(len(origins) == 1, f"{at}: one of field, fields and constant is needed")
    c(("compound_transform" in m) == ("fields" in m), f"{at}: fields and compound_transform go together")
    if "constant" in m:
        c(not set(m) & {"transform", "array_transform", "lookup", "null_values", "default"}, f"{at}: a constant stands alone")
    for k, known in (("transform", SCALAR), ("array_transform", ARRAY), ("compound_transform", COMPOUND)):
        if k in m:
            c(m[k] in known, f"{at}: no {k} {m[k]}")
            c(k == "compound_transform" or "field" in m, f"{at}: {k} needs field")
    c(not ("transform" in m and "array_transform" in m), f"{at}: transform and array_transform exclude each other")
    return Mapping(**{k: tuple(v) if k in ("fields", "null_values") else v for k, v in m.items() if k in Mapping.__dataclass_fields__})


def _check_merge(c: _Check, at: str, m: dict | None, record: bool) -> Merge | None:
    if m is None:
        return None
    c.keys(at, m, "fields separator set_on_merge")
    fields, stamps = list(m.get("fields") or []), dict(m.get("set_on_merge") or {})
    c(fields, f"{at}.fields: at least one is needed")
    if record:
        for p in [*fields, *stamps]:
            c(p in PATHS, f"{at}: {p} is not a path of the record")
        for p in set(fields) & set(stamps):
            c(False, f"{at}: {p} is both joined and stamped")
    return Merge(tuple(fields), m.get("separator", ", "), stamps)


def parse(raw: dict[str, Any]) -> Source:
    """Checks a specification and returns it; raises ConfigError with all problems."""
    c = _Check()
    c.keys(
        "source", raw,
        "id label country language encoding download primary delimiter trim_all quoted_line_ends format record_path pdf record_count sheet skip_rows"
        " columns allowed_ragged_rows allowed_missing_source_id_rows latest_snapshot_by joins source_id source_id_transform"
        " registration cadence_days merge_duplicates mapping",
    )
    for k in ("id", "label", "country", "primary", "delimiter", "source_id", "registration"):
        c.text("source", raw, k)
    for name in [raw.get("id"), *((raw.get("download") or {}).get("entries") or {})]:
        c(isinstance(name, str) and re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", name) and ".." not in name, f"{name!r} is no plain name")
    c(raw.get("language") in LANGUAGES, "source.language: an assigned ISO 639-1 code is needed")
    c(raw.get("encoding") in ("utf8", "latin1"), "source.encoding: utf8 or latin1")
    fmt = raw.get("format", "csv")
    c(fmt in FORMATS, f"source.format: no format {fmt}")
    c(fmt != "pdf" or raw.get("pdf"), "source.pdf: needed for this format")

    d = raw.get("download") or {}
    entries = d.get("entries") or {}
    c.keys("download", d, "url format method body entries headers prime_url discover_url discover_pattern")
    c.text("download", d, "url")
    c(entries, "download.entries: at least one is needed")
    c(d.get("format", "zip") != "file" or len(entries) == 1, "download.entries: one alias for a single file")
    c(len(set(entries.values())) == len(entries), "download.entries: paths must differ")
    c(("discover_url" in d) == ("discover_pattern" in d), "download: discover_url and discover_pattern go together")
    if "discover_pattern" in d:
        c.regex("download.discover_pattern", d["discover_pattern"])
    if "prime_url" in d:
        same = all(_origin(u) == _origin(d["prime_url"]) for u in (d.get("url"), d.get("discover_url")) if u)
        c(same, "download.prime_url: another origin")
    c(d.get("method", "GET") == "POST" or "body" not in d, "download.body: only with POST")

    joins = []
    for j in raw.get("joins") or []:
        at = f"joins.{j.get('name')}"
        c.keys(at, j, "name file key on merge_duplicates")
        for k in ("name", "file", "key", "on"):
            c.text(at, j, k)
        merge = _check_merge(c, at, j.get("merge_duplicates"), record=False)
        joins.append(Join(j.get("name", ""), j.get("file", ""), j.get("key", ""), j.get("on", ""), merge))
    c(len({j.name for j in joins}) == len(joins), "joins: names must differ")
    c({raw.get("primary"), *(j.file for j in joins)} <= set(entries), "primary and joins must name download entries")

    mapping = {}
    for path, m in (raw.get("mapping") or {}).items():
        if c(path in PATHS, f"mapping.{path}: not a path of the record"):
            mapping[path] = _check_mapping(c, f"mapping.{path}", m or {})
    for j in joins:
        if j.merge:
            covered = {f"{j.name}.{x}" for x in (*j.merge.fields, *j.merge.set_on_merge)}
            read = {m.field for m in mapping.values() if m.field and m.field.startswith(f"{j.name}.")}
            c(read <= covered, f"joins.{j.name}: mapped columns {sorted(read - covered)} are not merged")

    columns = raw.get("columns") or {}
    files = {raw.get("primary"), *(j.file for j in joins)}
    for k, v in columns.items():
        c(len(set(v)) == len(v), f"columns.{k}: names must differ")
    c({*columns, *(raw.get("allowed_ragged_rows") or {})} <= files, "columns and allowed_ragged_rows must name parsed files")
    c(raw.get("primary") not in (raw.get("allowed_ragged_rows") or {}) or fmt == "csv", "allowed_ragged_rows: only for csv")
    if pdf := raw.get("pdf"):
        c.keys("pdf", pdf, "field_axis column_pos anchor_pattern allowed_anchorless_pages")
        c(pdf.get("field_axis") in ("x", "y"), "pdf.field_axis: x or y")
        c.regex("pdf.anchor_pattern", pdf.get("anchor_pattern"))
        c(len(pdf.get("column_pos") or []) == len(columns.get(raw.get("primary"), [])), "pdf.column_pos: one for each column")
    if count := raw.get("record_count"):
        c.keys("record_count", count, "pattern url against")
        c.regex("record_count.pattern", count.get("pattern"), 1)
        c(count.get("against", "translated") in ("parsed", "translated"), "record_count.against: parsed or translated")
    missing = raw.get("allowed_missing_source_id_rows")
    if missing:
        c.keys("allowed_missing_source_id_rows", missing, "max field pattern")
        c.regex("allowed_missing_source_id_rows.pattern", missing.get("pattern"))
    if "source_id_transform" in raw:
        c(raw["source_id_transform"] in SCALAR, f"source_id_transform: no transform {raw['source_id_transform']}")
    merge = _check_merge(c, "merge_duplicates", raw.get("merge_duplicates"), record=True)
    if c.found:
        raise ConfigError("\n".join(c.found))
    plain = {k: raw[k] for k in raw if k in Source.__dataclass_fields__ and k not in ("mapping", "joins")}
    return Source(**plain, mapping=mapping, joins=tuple(joins), merge=merge, allowed_missing=missing)


def load(path: str | Path) -> Source:
    """Reads a specification from a JSON file, or from YAML where that library is installed."""
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith(".json"):
        return parse(json.loads(text))
    try:
        import yaml
    except ImportError as e:
        raise ConfigError("YAML needs the yaml library; give the specification as JSON") from e
    return parse(yaml.safe_load(text))

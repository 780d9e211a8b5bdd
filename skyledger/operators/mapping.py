"""Compiles field mappings to Column expressions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import UNSET, Mapping, Source
from ..functions.text import number, staged, trim
from ..functions.transforms import ARRAY, COMPOUND, SCALAR
from ..schema import ARRAYS, COUNTS, DATES, ENUMS, MIRRORED, NUMBERS, PATHS, RECORD, leaf_type
from .joins import cell


@dataclass
class Compiled:
    """A value, the message of a failure or null, and an unmatched lookup (field, value) or null."""

    value: Column
    failure: Column | None = None
    unmatched: Column | None = None


def _text(value) -> Column:
    return F.lit(None if value is UNSET else value).cast("string")


def _lookup(value: Column, m: Mapping, name: str) -> Compiled:
    """A listed value gives its entry, which may be null; an unlisted one the declared default
    (counted unless blank); without a default a blank gives null and anything else fails."""
    entries = m.lookup or {}
    pairs = [x for k, v in entries.items() for x in (F.lit(k), F.lit(v).cast("string"))]
    table = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    listed = F.map_contains_key(table, value)
    found = F.when(listed, F.try_element_at(table, value))
    if m.default is not UNSET:
        stray = ~listed & (value != "")
        return Compiled(
            found.when(~listed, _text(m.default)),
            unmatched=F.when(stray, F.struct(F.lit(name).alias("field"), value.alias("value"))),
        )
    stray = ~listed & (value != "")
    return Compiled(found, failure=F.when(stray, F.concat(F.lit(f"unknown value of {name}: "), value)))


def _else_default(ok: Column, then: Compiled, m: Mapping) -> Compiled:
    """``then`` where ``ok`` (null counts as false), elsewhere the default."""
    ok = F.coalesce(ok, F.lit(False))
    gate = lambda x: None if x is None else F.when(ok, x)
    return Compiled(F.when(ok, then.value).otherwise(_text(m.default)), gate(then.failure), gate(then.unmatched))


Transform = Callable[[Column], Column]


def transform_of(m: Mapping, columns: list[str]) -> tuple[Transform, Column] | None:
    """The transform of a mapped path and what it is applied to, if there is any."""
    if m.constant is not UNSET or m.array_transform and not m.field:
        return None
    if m.compound_transform:
        values = [cell(columns, f) for f in m.fields]
        return (lambda first: COMPOUND[m.compound_transform]([first, *values[1:]])), values[0]
    if not m.field:
        return None
    name = m.array_transform or m.transform
    if not name:
        return None
    return (ARRAY if m.array_transform else SCALAR)[name], cell(columns, m.field)


def _made(m: Mapping, columns: list[str], value: Column | None) -> Column:
    """The transformed cell: ``value`` if it was made before."""
    if value is not None:
        return value
    found = transform_of(m, columns)
    return found[0](found[1]) if found else cell(columns, m.field)


def scalar(m: Mapping, columns: list[str], value: Column | None = None) -> Compiled:
    if m.constant is not UNSET:
        return Compiled(_text(m.constant))
    if m.compound_transform:
        value = _made(m, columns, value)
        inner = _lookup(value, m, ",".join(m.fields)) if m.lookup is not None else Compiled(value)
        return _else_default(value.isNotNull(), inner, m)
    if not m.field:
        return Compiled(_text(m.default))
    value = _made(m, columns, value)
    inner = _lookup(value, m, m.field) if m.lookup is not None else Compiled(value)
    ok = value.isNotNull() if m.lookup is not None else value != ""
    if m.null_values:
        ok = ~cell(columns, m.field).isin(*m.null_values) & ok
    return _else_default(ok, inner, m)


def status(m: Mapping, columns: list[str], value: Column | None = None) -> Compiled:
    """Like a scalar, but a blank cell is null whatever the default."""
    if m.constant is not UNSET:
        return Compiled(_text(m.constant))
    if not m.field:
        return Compiled(_text(m.default))
    value = _made(m, columns, value)
    inner = _lookup(value, m, m.field) if m.lookup is not None else Compiled(value)
    stated = F.coalesce(value != "", F.lit(False))
    gate = lambda x: None if x is None else F.when(stated, x)
    return Compiled(F.when(stated, inner.value), gate(inner.failure), gate(inner.unmatched))


def array(m: Mapping, columns: list[str], value: Column | None = None) -> Compiled:
    none = F.array().cast("array<string>")
    if m.array_transform:
        return Compiled(_made(m, columns, value) if m.field else none)
    one = scalar(m, columns, value)
    return Compiled(F.when(F.coalesce(one.value, F.lit("")) != "", F.array(one.value)).otherwise(none), one.failure, one.unmatched)


def source_id(source: Source, columns: list[str]) -> Column:
    """The key of a row, empty for a missing one."""
    name = source.source_id_transform or "trim_or_null"
    return F.coalesce(SCALAR[name](cell(columns, source.source_id)), F.lit(""))


def with_record(rows: DataFrame, source: Source) -> DataFrame:
    """Adds ``record``, ``failures`` and ``unmatched`` (arrays) to rows of cells.

    Transformed cells, mapped values and numbers are columns of their own on the way,
    so that each is computed once, in generated code.
    """
    columns, start = rows.columns, "_"
    while any(c.lower().startswith(start) for c in columns):
        start += "_"
    mapped = {p: m for p, m in source.mapping.items() if p in PATHS}
    place = {p: i for i, p in enumerate(mapped)}

    transforms = {p: x for p, m in mapped.items() if (x := transform_of(m, columns))}
    rows = staged(rows, {f"{start}t{place[p]}": x for p, x in transforms.items()})
    made: dict[str, Compiled] = {}
    for p, m in mapped.items():
        compile_ = array if p in ARRAYS else status if p == "status" else scalar
        made[p] = compile_(m, columns, F.col(f"{start}t{place[p]}") if p in transforms else None)
    parts = {"v": "value", "f": "failure", "u": "unmatched"}
    rows = rows.withColumns(
        {f"{start}{k}{place[p]}": x for p, c in made.items() for k, part in parts.items() if (x := getattr(c, part)) is not None}
    )
    column = lambda k, p: F.col(f"{start}{k}{place[p]}")
    rows = staged(rows, {f"{start}n{place[p]}": (number, column("v", p)) for p in mapped if p in COUNTS or p in NUMBERS})

    values: dict[str, Column] = {}
    for p in PATHS:
        if p in mapped:
            values[p] = column("n" if p in COUNTS or p in NUMBERS else "v", p)
        else:
            values[p] = F.array().cast("array<string>") if p in ARRAYS else F.lit(None).cast(leaf_type(p))
    values["source"] = F.lit(source.id)
    values["source_id"] = source_id(source, columns)
    values["country"] = F.coalesce(values["country"], F.lit(source.country))
    for p in MIRRORED:  # the untranslated original is the value itself unless mapped
        values[f"{p}_source_text"] = F.coalesce(values[f"{p}_source_text"], values[p])
    own = values["operational_classes_source_text"]
    values["operational_classes_source_text"] = F.when(F.size(own) > 0, own).otherwise(values["operational_classes"])
    failures = [column("f", p) for p, c in made.items() if c.failure is not None] + checks(values, {*mapped, "registration"})
    unmatched = [column("u", p) for p, c in made.items() if c.unmatched is not None]
    for p in COUNTS:
        if p in mapped:
            values[p] = F.when(F.abs(values[p]) < 2.0**63, values[p]).cast("long")

    def built(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.StructType):
            return F.struct(*[values[f"{f.name}.{g.name}"].cast(g.dataType).alias(g.name) for g in f.dataType.fields]).alias(f.name)
        return values[f.name].cast(f.dataType).alias(f.name)

    return rows.select(
        *[F.col(f"`{c}`") for c in columns],
        F.struct(*[built(f) for f in RECORD.fields]).alias("record"),
        _stated(failures, "array<string>").alias("failures"),
        _stated(unmatched, "array<struct<field:string,value:string>>").alias("unmatched"),
    )


def _stated(xs: list[Column], kind: str) -> Column:
    """An array of those that are not null; it is only put together where there is one."""
    none = F.array().cast(kind)
    if not xs:
        return none
    return F.when(F.coalesce(*xs).isNull(), none).otherwise(F.concat(*[F.when(x.isNotNull(), F.array(x)).otherwise(none) for x in xs]))


def checks(values: dict[str, Column], paths: set[str]) -> list[Column]:
    """The rules of ``paths``; each gives a message where it is broken, else null.

    A path that nothing is mapped to is null and breaks no rule.
    """
    rules = {"registration": trim(F.coalesce(values["registration"], F.lit(""))) != ""}
    rules["icao_hex"] = values["icao_hex"].isNull() | values["icao_hex"].rlike("^[0-9a-f]{6}$")
    for p, allowed in ENUMS.items():
        if p not in paths:
            continue
        rules[p] = values[p].isNull() | values[p].isin(*allowed)
    for p in DATES:
        rules[p] = values[p].isNull() | values[p].rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    for p in COUNTS:
        rules[p] = values[p].isNull() | (values[p] >= 0) & (values[p] == F.floor(values[p])) & (values[p] <= float(2**53 - 1))
    for p in NUMBERS:
        rules[p] = values[p].isNull() | (values[p] >= 0)
    return [F.when(~F.coalesce(ok, F.lit(False)), F.lit(f"{p} is not allowed")) for p, ok in rules.items() if p in paths]

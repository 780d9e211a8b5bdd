"""The named field transforms, each a builder of Column expressions.

A scalar transform goes from a cell's text (never null) to text or null, an array
transform to an array, a compound transform from several cells to text or null.
``register_*`` adds further ones under new names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import MAX_SAFE, WHITE_CLASS, Steps, collapse, date_like, in_calendar, leading_int, null, number, or_null, registration_key, shown, trim, trimmed, ymd

Scalar = Callable[[Column], Column]
Compound = Callable[[list[Column]], Column]

SCALAR: dict[str, Scalar] = {}
ARRAY: dict[str, Scalar] = {}
COMPOUND: dict[str, Compound] = {}

#: Fixed values.
KNOTS_PER_MPH = 0.868976
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
ENGINE_SENTINELS = ["AIRCRAFT NOT FITTED WITH ENGINE", "NOT APPLICABLE"]
SPANISH_SENTINELS = ["NO DISPONIBLE", "N/A", "NO TIENE", "DESCONOCIDO"]
UNDISCLOSED = "Indisponível"
CANTONS = "ZH BE LU UR SZ OW NW GL ZG FR SO BS BL SH AR AI SG GR AG TG TI VD VS NE GE JU".split()
SPANISH_CLASSES = {
    "HELICOPTERO": ("rotorcraft", "helicopter (VTOL)"),
    "GLOBO": ("balloon", "balloon"),
    "PLANEADOR": ("glider", "glider / motor-glider"),
    "AUTOGIRO": ("gyroplane", "gyroplane"),
    "PENDULAR": ("weight-shift", "weight-shift"),
    "AVION": (None, "airplane"),
}
SINGLE, MULTI = "fixed-wing-single-engine", "fixed-wing-multi-engine"


def _into(registry: dict, name: str):
    def add(f):
        if name in registry:
            raise ValueError(f"transform {name} is there already")
        registry[name] = f
        return f

    return add


def register_scalar(name: str):
    return _into(SCALAR, name)


def register_array(name: str):
    return _into(ARRAY, name)


def register_compound(name: str):
    return _into(COMPOUND, name)


def _upper(v: Column) -> Column:
    return F.upper(trim(v))


def _matching(v: Column, pattern: str) -> Column:
    return F.when(v.rlike(pattern), v)


def _first(values: Column) -> Column:
    return F.try_element_at(values, F.lit(1))


def _by_engines(count: Column) -> Column:
    """Aeroplanes by their number of engines; null below one."""
    return F.when(count == 1, SINGLE).when(count > 1, MULTI)


# Text

SCALAR |= {
    "trim": trim,
    "trim_or_null": trimmed,
    "na_or_null": lambda v: F.nullif(trimmed(v), F.lit("N/A")),
    "lowercase": lambda v: F.lower(trim(v)),
    "first_line_or_null": lambda v: trimmed(F.split(v, "\n")[0]),
    "collapse_ws_or_null": lambda v: or_null(collapse(v)),
    "casa_engine_detail_or_null": lambda v: F.when(~trim(v).isin(ENGINE_SENTINELS), trimmed(v)),
    "es_aesa_detail_or_null": lambda v: F.when(~F.upper(collapse(v)).isin(SPANISH_SENTINELS), or_null(collapse(v))),
    "br_build_certification": lambda v: F.when(_upper(v) == "NÃO CERTIFICADA", "not-type-certificated"),
    "br_status": lambda v: F.when(trim(v) != "", "cancelled").otherwise("valid"),
}


@register_scalar("last_comma_segment_or_null")
def _last_comma_segment(v: Column) -> Column:
    parts = F.filter(F.transform(F.split(v, ","), trim), lambda s: s != "")
    return F.try_element_at(parts, F.lit(-1))


@register_scalar("mv_idera_party")
def _idera_party(v: Column) -> Column:
    lines = F.transform(F.split(v, "\n"), trim)
    named = lambda s: (s != "") & (s != "None") & ~s.rlike(r"(?i)^Letter No\b") & ~s.rlike(r"^\([^\r\n]*\)$")
    return _first(F.filter(lines, named))


@register_scalar("es_aesa_class_en")
def _spanish_class(v: Column) -> Column:
    raw = F.upper(collapse(v))
    base = F.regexp_replace(raw, r"^(ULM|AFI)\s*-\s*", "")
    kind = F.coalesce(*[F.when(base.startswith(k), label) for k, (_, label) in SPANISH_CLASSES.items()])
    tier = F.when(raw.rlike(r"^ULM\s*-\s*"), "ultralight ").when(raw.rlike(r"^AFI\s*-\s*"), "amateur-built ").otherwise("")
    return F.concat(tier, kind)


# Numbers


def _mph(v: Column) -> Column:
    return or_null(F.regexp_extract(trim(v), r"^([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)", 1)).try_cast("double")


def _serial_year(n: Column) -> Column:
    return F.year(F.date_add(F.lit("1899-12-30").cast("date"), F.when((n > 0) & (n < 1e6), F.floor(n)).cast("int")))


SCALAR |= {
    "int_or_null": Steps(number, lambda n: F.when((n == F.floor(n)) & (F.abs(n) <= float(MAX_SAFE)), n), shown),
    "float_or_null": Steps(number, shown),
    "positive_float_or_null": Steps(number, lambda n: F.when(n > 0, n), shown),
    "mph_to_ktas_or_null": Steps(_mph, lambda mph: F.when(mph > 0, F.floor(mph * KNOTS_PER_MPH * 10 + 0.5) / 10), shown),
    "excel_serial_year_or_null": Steps(number, _serial_year, lambda y: F.when((y >= 1900) & (y <= 2100), y.cast("string"))),
}


@register_scalar("binary_to_hex_or_null")
def _binary_hex(v: Column) -> Column:
    t = trim(v)
    return F.when(t.rlike("^[01]{24}$"), F.lpad(F.lower(F.conv(t, 2, 16)), 6, "0"))


# Dates

SCALAR |= {
    "date_yyyymmdd_or_null": date_like(r"^[0-9]{8}$", (1, 4), (5, 2), (7, 2)),
    "date_ddmmyyyy_or_null": date_like(r"^[0-9]{8}$", (5, 4), (3, 2), (1, 2)),
    "date_yyyy_slash_or_null": date_like(r"^[0-9]{4}/[0-9]{2}/[0-9]{2}$", (1, 4), (6, 2), (9, 2)),
    "date_dd_slash_or_null": date_like(r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$", (7, 4), (4, 2), (1, 2)),
    "date_dd_dot_or_null": date_like(r"^[0-9]{2}\.[0-9]{2}\.[0-9]{4}$", (7, 4), (4, 2), (1, 2)),
    "iso_date_only_or_null": date_like(
        r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", (1, 4), (6, 2), (9, 2), lambda v: F.substring(trim(v), 1, 10)
    ),
}
SCALAR["iso_year_or_null"] = Steps(SCALAR["iso_date_only_or_null"], lambda d: F.substring(d, 1, 4))


def _month_name_parts(t: Column) -> Column:
    """Two-digit years below 50 are of the 2000s."""
    part = lambda i: F.regexp_extract(t, r"^([0-9]{1,2})-([A-Za-z]{3})-([0-9]{2})$", i)
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(part(2)))
    yy = part(3).try_cast("int")
    year = F.when(yy < 50, yy + 2000).otherwise(yy + 1900).cast("string")
    return F.when(month > 0, ymd(year, F.lpad(month.cast("string"), 2, "0"), F.lpad(part(1), 2, "0")))


SCALAR["date_dmmmyy_or_null"] = Steps(trim, _month_name_parts, in_calendar)


def _date_parts(parts: Column) -> Column:
    whole = F.forall(parts, lambda x: F.schema_of_variant(x) == "BIGINT")
    text = F.transform(parts, lambda x: F.try_variant_get(x, "$", "string"))
    at = lambda i, n: F.lpad(F.try_element_at(text, F.lit(i)), n, "0")
    fits = F.forall(F.slice(text, 2, 2), lambda s: F.length(s) <= 2) & (F.length(F.try_element_at(text, F.lit(1))) == 4)
    return F.when((F.size(parts) == 3) & whole & fits, ymd(at(1, 4), at(2, 2), at(3, 2)))


# Marks and addresses

SCALAR |= {
    "faa_n_number": lambda v: F.when(_upper(v).startswith("N"), _upper(v)).when(trim(v) != "", F.concat(F.lit("N"), _upper(v))),
    "tc_full_registration": lambda v: F.when(F.length(trim(v)) == 3, F.concat(F.lit("CF-"), _upper(v))).when(
        trim(v) != "", F.concat(F.lit("C-"), _upper(v))
    ),
    "casa_full_registration": lambda v: F.when(trim(v) != "", F.concat(F.lit("VH-"), _upper(v))),
    "nl_ilt_registration_or_null": lambda v: _matching(_upper(v), r"^PH-[A-Z0-9]+$"),
    "ee_registration": lambda v: _matching(F.upper(F.regexp_replace(v, f"{WHITE_CLASS}+", "")), r"^ES-[A-Z0-9]+$"),
    "br_registration": lambda v: F.when(
        _upper(v).rlike(r"^[A-Z]{2}[A-Z0-9]{3}$"), F.concat_ws("-", F.substring(_upper(v), 1, 2), F.substring(_upper(v), 3, 3))
    ),
    "cl_registration": lambda v: F.when(_upper(v).rlike(r"^CC[A-Z0-9]{3}$"), F.concat(F.lit("CC-"), F.substring(_upper(v), 3, 3))),
    "foca_hex_or_null": lambda v: _matching(F.lower(trim(v)), r"^[0-9a-f]{6}$"),
    "faa_cert_class": lambda v: or_null(F.substring(trim(v), 1, 1)),
}


@register_scalar("br_airframe")
def _class_code(v: Column) -> Column:
    t = _upper(v)
    kind, digit = F.substring(t, 1, 1), F.substring(t, 2, 1)
    return (
        F.when(t == "RPA", "uav")
        .when(F.length(t) < 2, null())
        .when(kind == "H", "rotorcraft")
        .when(kind == "G", "gyroplane")
        .when(kind == "B", "balloon")
        .when(kind.isin("L", "A", "S") & digit.rlike("^[0-9]$"), F.when(digit == "0", "glider").when(digit == "1", SINGLE).otherwise(MULTI))
    )


# Cells that hold JSON: a step for the array, one for the element, one for its text, so that a cell is parsed once.


def _json_array(v: Column) -> Column:
    """The elements of a JSON array; null for any other cell."""
    return F.try_variant_get(F.try_parse_json(trim(v)), "$", "array<variant>")


def _text(x: Column, path: str) -> Column:
    """The trimmed string at a path, empty for none and for values of other types."""
    return F.when(F.schema_of_variant(F.try_variant_get(x, path, "variant")) == "STRING", trim(F.try_variant_get(x, path, "string"))).otherwise("")


def _stated_text(path: str) -> Callable[[Column], Column]:
    return lambda x: or_null(_text(x, path))


SCALAR["foca_date_array_or_null"] = Steps(_json_array, _date_parts, in_calendar)

SCALAR["no_hex_or_null"] = Steps(
    _json_array,
    lambda a: _first(F.filter(a, lambda x: F.schema_of_variant(F.try_variant_get(x, "$.Heksadesimal", "variant")) == "STRING")),
    lambda x: F.lower(_text(x, "$.Heksadesimal")),
    lambda h: F.when(h.rlike("^[0-9a-f]{1,6}$"), F.lpad(h, 6, "0")),
)


def _party(x: Column) -> Column:
    return F.struct(_text(x, "$.NOME").alias("name"), _text(x, "$.DOCUMENTO").alias("doc"), _text(x, "$.UF").alias("state"))


def _same_party(every: Column) -> Column:
    """All parties of a cell, and those that are the first one again (by its document)."""
    first = _first(every)
    same = F.when(first["doc"] == "", F.slice(every, 1, 1)).otherwise(F.filter(every, lambda p: p["doc"] == first["doc"]))
    return F.struct(every.alias("every"), same.alias("same"))


def _stated(p: Column, name: str) -> Column:
    values = F.transform(p["same"], lambda x: x[name])
    return _first(F.filter(values, lambda s: (s != "") & (s != UNDISCLOSED)))


def _document_kind(p: Column) -> Column:
    docs = F.transform(p["every"], lambda x: x["doc"])
    parties = F.size(F.filter(docs, lambda d: d == "")) + F.size(F.array_distinct(F.filter(docs, lambda d: d != "")))
    first = _first(p["same"])
    size = F.length(first["doc"])
    hidden = _stated(p, "name").isNull() & (first["name"] == UNDISCLOSED)
    one = F.when(hidden | (size == 0), null()).when(size == 14, "corporation").when(size == 11, "individual").otherwise("other")
    return F.when(parties > 1, "co-owner").when(parties == 1, one)


_parties = Steps(_json_array, lambda a: F.transform(a, _party), _same_party)
SCALAR |= {
    "br_party_name": Steps(_parties, lambda p: _stated(p, "name")),
    "br_party_state": Steps(_parties, lambda p: _stated(p, "state")),
    "br_party_kind": Steps(_parties, _document_kind),
}


def _has_role(x: Column, *roles: str) -> Column:
    """Whether an element has one of the roles; the text of a number, object or array is none of them."""
    return F.try_variant_get(x, "$.holderCategory.categoryNames.en", "string").isin(*roles)


def _swiss(role: str, path: str) -> Steps:
    return Steps(_json_array, lambda a: _first(F.filter(a, lambda x: _has_role(x, role))), _stated_text(path))


def _several(*roles: str) -> Steps:
    return Steps(_json_array, lambda a: F.when(F.size(F.filter(a, lambda x: _has_role(x, *roles))) > 1, "co-owner"))


for _who in ("owner", "operator"):
    _main, _part = f"Main {_who.title()}", f"Part {_who.title()}"
    SCALAR |= {
        f"foca_{_who}_name": _swiss(_main, "$.ownerOperator"),
        f"foca_{_who}_state": Steps(_swiss(_main, "$.address.extraLine"), lambda s: F.when(s.isin(CANTONS), s)),
        f"foca_{_who}_country": _swiss(_main, "$.address.country"),
        f"foca_{_who}_kind": _several(_main, _part),
    }


def _contact(owners: Column) -> Column:
    flagged = F.filter(owners, lambda x: F.try_variant_get(x, "$['Eier type']", "string") == "Eier/Kontakt")
    return F.coalesce(_first(flagged), _first(owners))


SCALAR["no_owner_name"] = Steps(_json_array, _contact, _stated_text("$.Navn"))
SCALAR["no_owner_country"] = Steps(_json_array, _contact, _stated_text("$.Land"))


def _norwegian_kind(owners: Column) -> Column:
    only = _first(owners)
    one = F.when(_text(only, "$.Navn") == "", null()).when(_text(only, "$.Organisasjonsnummer") != "", "corporation")
    return F.when(F.size(owners) > 1, "co-owner").when(F.size(owners) == 1, one.when(_text(only, "$.Land") == "Norge", "individual"))


SCALAR["no_owner_kind"] = Steps(_json_array, _norwegian_kind)


# Arrays

ARRAY["faa_cert_ops"] = lambda v: F.filter(F.split(F.substring(trim(v), 2, 1 << 30), ""), lambda c: c != "")


def _classes(a: Column) -> Column:
    texts = F.filter(a, lambda x: F.schema_of_variant(x) == "STRING")
    out = F.filter(F.transform(texts, lambda x: trim(F.try_variant_get(x, "$", "string"))), lambda s: s != "")
    return F.coalesce(out, F.array().cast("array<string>"))


ARRAY["no_airworthiness_classes"] = Steps(_json_array, _classes)


# Compounds


def _categories(direct: dict[str, str | None], powered: tuple[str, ...]) -> Compound:
    """A transform of (category, engines): named categories directly, powered ones by their engines."""

    def build(values: list[Column]) -> Column:
        category, engines = trim(values[0]), leading_int(values[1]) if len(values) > 1 else F.lit(None).cast("long")
        cases = [F.when(category == k, F.lit(x).cast("string")) for k, x in direct.items()]
        return F.coalesce(*cases, F.when(category.isin(*powered), _by_engines(engines)))

    return build


COMPOUND |= {
    "tc_airframe": _categories(
        {"Helicopter": "rotorcraft", "Glider": "glider", "Balloon": "balloon", "Gyroplane": "gyroplane"}, ("Aeroplane",)
    ),
    "nl_ilt_airframe": _categories(
        {"Sailplane": "glider", "Balloon": "balloon", "Rotorcraft": "rotorcraft", "Drones": None},
        ("Small aeroplane", "Large aeroplane", "MLA, MLH"),
    ),
    "casa_airframe": _categories(
        {"Glider": "glider", "Motor-Glider": "glider", "Manned Free Balloon": "balloon", "Airship": "blimp", "Rotorcraft": "rotorcraft"},
        ("Power Driven Aeroplane",),
    ),
}


@register_compound("es_aesa_airframe")
def _spanish_airframe(values: list[Column]) -> Column:
    base = F.regexp_replace(F.upper(collapse(values[0])), r"^(ULM|AFI)\s*-\s*", "")
    direct = [F.when(base.startswith(k), kind) for k, (kind, _) in SPANISH_CLASSES.items() if kind]
    return F.coalesce(*direct, F.when(base.startswith("AVION"), _by_engines(leading_int(values[1]))))


@register_compound("no_operator_kind")
def _operator_kind(values: list[Column]) -> Column:
    return F.when((trim(values[0]) != "") & (trim(values[1]) != ""), "corporation")


__all__ = ["ARRAY", "COMPOUND", "SCALAR", "register_array", "register_compound", "register_scalar", "registration_key"]

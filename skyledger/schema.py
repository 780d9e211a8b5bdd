"""The canonical record: types, closed value sets and paths."""

from __future__ import annotations

from pyspark.sql import types as T

#: The closed sets of the canonical record.
OWNER_KINDS = (
    "individual partnership corporation co-owner government llc non-citizen-corporation non-citizen-co-owner other"
).split()
STATUSES = "valid invalid expired cancelled restricted reserved other".split()
AIRFRAME_TYPES = (
    "glider balloon blimp fixed-wing fixed-wing-single-engine fixed-wing-multi-engine rotorcraft weight-shift"
    " powered-parachute gyroplane hybrid-lift uav other"
).split()
ENGINE_TYPES = (
    "none reciprocating turbo-prop turbo-shaft turbo-jet turbo-fan ramjet 2-cycle 4-cycle unknown electric rotary other"
).split()
CATEGORIES = (
    "standard limited restricted experimental provisional primary multiple special-flight-permit light-sport other"
).split()
BUILD_CERTIFICATIONS = "type-certificated not-type-certificated light-sport".split()
OPERATING_ENVIRONMENTS = "land sea amphibian".split()

S, L, D = T.StringType(), T.LongType(), T.DoubleType()
TEXTS = T.ArrayType(S)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


PARTY = _struct(("name", S), ("kind", S), ("state", S), ("country", S))
ENGINE = _struct(("manufacturer", S), ("model", S), ("type", S), ("count", L), ("horsepower", D), ("thrust_lbs", D))

RECORD = _struct(
    ("source", S), ("source_id", S), ("registration", S), ("icao_hex", S), ("icao_type_code", S), ("status", S),
    ("country", S), ("manufacturer", S), ("model", S), ("serial_number", S), ("year_manufactured", L),
    ("airframe_type", S), ("category", S), ("build_certification", S), ("airworthiness_class", S),
    ("airworthiness_class_source_text", S), ("operating_environment", S), ("operational_classes", TEXTS),
    ("operational_classes_source_text", TEXTS), ("engine", ENGINE), ("propeller", S), ("home_base", S),
    ("owner", PARTY), ("operator", PARTY), ("legal_owner", PARTY), ("idera_authorised_party", S),
    ("certification_date", S), ("airworthiness_date", S), ("expiration_date", S), ("last_action_date", S),
    ("cruise_speed_ktas", D), ("max_takeoff_weight_kg", D), ("seats", L), ("max_passengers", L), ("min_crew", L),
    ("airworthiness_review_date", S), ("cancellation_reason", S), ("cancellation_reason_source_text", S),
    ("lien_status", S), ("lien_status_source_text", S), ("interdiction_code", S),
)

#: Every leaf as a dotted path.
PATHS = [
    f"{f.name}.{g.name}" if isinstance(f.dataType, T.StructType) else f.name
    for f in RECORD.fields
    for g in (f.dataType.fields if isinstance(f.dataType, T.StructType) else [f])
]
ENUMS = {
    "status": STATUSES, "airframe_type": AIRFRAME_TYPES, "category": CATEGORIES,
    "build_certification": BUILD_CERTIFICATIONS, "operating_environment": OPERATING_ENVIRONMENTS,
    "engine.type": ENGINE_TYPES, "owner.kind": OWNER_KINDS, "operator.kind": OWNER_KINDS, "legal_owner.kind": OWNER_KINDS,
}
DATES = [p for p in PATHS if p.endswith("_date")]
COUNTS = ["year_manufactured", "engine.count", "seats", "max_passengers", "min_crew"]
NUMBERS = ["engine.horsepower", "engine.thrust_lbs", "cruise_speed_ktas", "max_takeoff_weight_kg"]
ARRAYS = ["operational_classes", "operational_classes_source_text"]
MIRRORED = ["airworthiness_class", "cancellation_reason", "lien_status"]
#: Dates that tell how recent a record is; the review date does not.
RECENCY = ["certification_date", "airworthiness_date", "expiration_date", "last_action_date"]


def leaf_type(path: str) -> T.DataType:
    t: T.DataType = RECORD
    for part in path.split("."):
        t = t[part].dataType  # type: ignore[index]
    return t


#: Columns of the served feed, in order, and the record path each comes from.
FEED = {
    "icao_hex": "icao_hex", "registration": "registration", "registration_key": None, "icao_type_code": "icao_type_code",
    "status": "status", "country": "country", "manufacturer": "manufacturer", "model": "model",
    "serial_number": "serial_number", "year_manufactured": "year_manufactured", "airframe_type": "airframe_type",
    "category": "category",
    **{f"engine_{n}": f"engine.{n}" for n in ("manufacturer", "model", "type", "count", "horsepower", "thrust_lbs")},
    "seats": "seats", "max_passengers": "max_passengers", "cruise_speed_ktas": "cruise_speed_ktas",
    "max_takeoff_weight_kg": "max_takeoff_weight_kg",
    **{f"{p}_{n}": f"{p}.{n}" for p in ("owner", "operator") for n in ("name", "kind", "state", "country")},
    "cancellation_reason": "cancellation_reason", "airworthiness_class": "airworthiness_class", "source": "source",
}
FEED_SCHEMA = T.StructType(
    [
        T.StructField(c, leaf_type(p) if p else S, c not in ("registration", "status", "country", "source"))
        for c, p in FEED.items()
    ]
)

"""The served feed: one row an aircraft, ambiguous keys cleared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..cluster import written
from ..functions.text import or_null, registration_key
from ..schema import FEED
from .artifact import any_of
from .joins import GuardError
from .resolve import latest_date

UNSERVED = ("cancelled", "reserved")


def served(df: DataFrame, status_col: str = "status") -> DataFrame:
    """Rows with a stated status that is served."""
    return df.where(~F.col(status_col).isin(*UNSERVED))


def project(record: Column) -> list[Column]:
    """The columns of the feed from a record struct."""

    def of(path: str) -> Column:
        c = record
        for part in path.split("."):
            c = c[part]
        return c

    return [
        (or_null(registration_key(record["registration"])) if path is None else of(path)).alias(c) for c, path in FEED.items()
    ]


def resolved(rows: DataFrame, key: str) -> DataFrame:
    """(key, id, same): of each key's newest rows the least id, and whether they all serve the same.

    ``rows`` has the key, ``date`` (a number), ``shown`` (a number that stands for what is served) and ``id``.
    Both steps combine before they shuffle; their states have fixed width, so they are hashed, not sorted.
    """
    by_date = rows.groupBy(key, "date").agg(F.min("shown").alias("lo"), F.max("shown").alias("hi"), F.min("id").alias("id"))
    newest = by_date.groupBy(key).agg(*[F.max_by(c, "date").alias(c) for c in ("lo", "hi", "id")])
    return newest.select(key, "id", (F.col("lo") == F.col("hi")).alias("same"))


def feed_slice(records: DataFrame) -> DataFrame:
    """The feed rows of one source, from (record, _ord).

    Rows with an address resolve by it, others by their mark.  The rows of an
    ambiguous address fall back to their marks.  A mark that an address's winner
    holds is that aircraft's, unless rows fell back to it; an ambiguous mark is
    served for nobody.

    The rows are written once with an id; what decides are slim rows of keys and numbers, and the winners' ids fetch
    the served columns in the end.
    """
    r = F.col("record")
    served_rows = records.where(~r["status"].isin(*UNSERVED)).select(
        F.coalesce(F.regexp_replace(latest_date(r), "-", "").try_cast("long"), F.lit(0)).alias("date"), F.struct(*project(r)).alias("row")
    )
    without = F.col("row").withField("icao_hex", F.lit(None).cast("string"))
    shown = F.xxhash64(F.to_json(without, {"ignoreNullFields": "false"}))
    rows = written(served_rows.select("date", shown.alias("shown"), "row.*").withColumn("id", F.monotonically_increasing_id()), "served")
    slim = rows.select("id", "date", "shown", F.col("icao_hex").alias("hex"), F.col("registration_key").alias("mark"))
    with_hex = slim.where(F.col("hex").isNotNull())
    by_hex = resolved(with_hex, "hex")
    winners = by_hex.where("same").select("id").join(slim.select("id", "mark"), "id")
    unclear = by_hex.where("NOT same").select("hex")
    fallback = with_hex.join(unclear, "hex", "left_semi").where(F.col("mark").isNotNull())
    superseded = winners.where(F.col("mark").isNotNull()).select("mark").distinct()
    superseded = superseded.join(fallback.select("mark").distinct(), "mark", "left_anti")
    marked = slim.where(F.col("hex").isNull() & F.col("mark").isNotNull()).unionByName(fallback.select(*slim.columns))
    by_mark = resolved(marked.join(superseded, "mark", "left_anti"), "mark")
    ambiguous = by_mark.where("NOT same").select("mark", F.lit(True).alias("unclear"))
    first = winners.join(ambiguous, "mark", "left").select("id", F.lit(True).alias("by_hex"), F.coalesce("unclear", F.lit(False)).alias("unclear"))
    second = by_mark.where("same").select("id", F.lit(False).alias("by_hex"), F.lit(False).alias("unclear"))
    found = rows.join(first.unionByName(second), "id")
    shown_as = {"icao_hex": F.when(F.col("by_hex"), F.col("icao_hex")), "registration_key": F.when(~F.col("unclear"), F.col("registration_key"))}
    return found.select(*[shown_as.get(c, F.col(c)).alias(c) for c in FEED])


def absent(declared: DataFrame, rows: DataFrame, name: str, of: str) -> DataFrame:
    """What is declared and has no rows."""
    return declared.join(rows.select(F.col(of).alias("_of")).distinct(), F.col(name) == F.col("_of"), "left_anti")


def first_by_hex(rows: DataFrame, hex_col: str, order: list[str]) -> DataFrame:
    """Of the rows of one address the first by ``order``; all rows without an address."""
    w = Window.partitionBy(hex_col).orderBy(*order)
    with_hex = rows.where(F.col(hex_col).isNotNull()).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return with_hex.unionByName(rows.where(F.col(hex_col).isNull()))


def clear_ambiguous(rows: DataFrame, key_col: str = "registration_key", hex_col: str = "icao_hex") -> DataFrame:
    """A key that several rows hold is no row's: rows with an address lose it, others go."""
    held = rows.where(F.col(key_col).isNotNull()).groupBy(key_col).count().where("count > 1")
    held = held.select(F.col(key_col).alias("_held"))
    marked = rows.join(held, F.col(key_col) == F.col("_held"), "left")
    kept = marked.where(F.col("_held").isNull() | F.col(hex_col).isNotNull())
    return kept.withColumn(key_col, F.when(F.col("_held").isNull(), F.col(key_col))).drop("_held")


def consolidate(slices: DataFrame, order: tuple[str, ...] = ("source", "registration")) -> DataFrame:
    """All sources' slices as one feed: the first source by name wins an address."""
    return clear_ambiguous(first_by_hex(slices, "icao_hex", list(order)))


def ambiguity_report(rows: DataFrame, key_col: str = "registration_key", samples: int = 10) -> dict:
    """How many keys several rows hold, and the first of them by name."""
    held = rows.where(F.col(key_col).isNotNull()).groupBy(key_col).count().where("count > 1").select(key_col)
    first = [r[0] for r in held.orderBy(key_col).limit(samples).collect()]
    return {"keys": held.count(), "sample": first}


def assert_unique(rows: DataFrame, key_col: str) -> None:
    twice = rows.where(F.col(key_col).isNotNull()).groupBy(key_col).count().where("count > 1").first()
    if twice:
        raise GuardError(f"{key_col} {twice[0]} occurs {twice['count']} times")


def compose_model(maker: Column, model: Column) -> Column:
    """Maker and model as one text, without saying the maker twice."""
    has = lambda c: F.coalesce(c, F.lit("")) != ""
    return (
        F.when(~has(maker), or_null(model))
        .when(~has(model), maker)
        .when(F.lower(model).startswith(F.lower(maker)), model)
        .otherwise(F.concat_ws(" ", maker, model))
    )


#: Limits of one lookup request; fixed values.
MAX_KEYS = 500
HEX, MARK = r"^[0-9a-f]{6}$", r"^[A-Z0-9]{2,10}$"


def request_keys(keys: list[str], kind: str) -> list[str]:
    """Normalized distinct keys of a request; any bad key, or too many, fails it."""
    import re

    if not isinstance(keys, list) or any(not isinstance(k, str) for k in keys):
        raise ValueError("keys must be a list of texts")
    norm = [k.strip().lower() if kind == "hex" else re.sub("[^A-Z0-9]", "", k.upper()) for k in keys]
    pattern = HEX if kind == "hex" else MARK
    if bad := [k for k, n in zip(keys, norm, strict=True) if not re.match(pattern, n)]:
        raise ValueError(f"bad keys: {bad[:5]}")
    norm = list(dict.fromkeys(norm))
    if len(norm) > MAX_KEYS:
        raise ValueError(f"more than {MAX_KEYS} keys")
    return norm


def lookup(feed: DataFrame, keys: list[str], kind: str = "hex", attributions: dict[str, str] | None = None, fallback: str = "") -> DataFrame:
    """The served rows of up to 500 keys, as ``key`` and the response's columns.

    The keys become equalities by which Parquet scans skip row groups.
    """
    column = "icao_hex" if kind == "hex" else "registration_key"
    found = feed.where(any_of(column, request_keys(keys, kind)))
    pairs = [F.lit(x) for kv in (attributions or {}).items() for x in kv]
    notice = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("source")), F.lit(fallback)) if pairs else F.lit(fallback)
    return found.select(
        F.col(column).alias("key"),
        *[c for c in feed.columns if c not in ("icao_hex", "registration_key")],
        compose_model(F.col("manufacturer"), F.col("model")).alias("type"),
        compose_model(F.col("engine_manufacturer"), F.col("engine_model")).alias("engine"),
        notice.alias("attribution"),
    )


def lookup_many(feed: DataFrame, keys: DataFrame, key_col: str, column: str) -> DataFrame:
    """The feed rows of any number of keys, by a semi join."""
    wanted = keys.where(F.col(key_col).isNotNull()).select(F.col(key_col).alias(column)).distinct()
    return feed.join(wanted, column, "left_semi")

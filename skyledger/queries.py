"""Registered queries: every operator on the given tables, with SQL for the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .config import Join, Mapping, Merge, Source
from .functions.text import registration_key, staged
from .functions.transforms import SCALAR
from .operators import artifact, feed, localize, mapping
from .operators.joins import GuardError, conflicting_keys, latest_snapshot, lookup_join, merged_build_side
from .operators.resolve import resolve
from .plans.translate import translate
from .schema import RECORD

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(df: DataFrame, **columns: str) -> DataFrame:
    """Columns as the text cells that readers give; null is empty."""
    return df.select(*[F.coalesce(F.expr(e).cast("string"), F.lit("")).alias(n) for n, e in columns.items()])


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows over all cores, for costly columns: a small file has few row groups, which one task each reads."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, key)


# The record of an order: the flagship plan from rows to served feed.

ORDERS = Source(
    id="orders", label="Orders", country="US", language="en", encoding="utf8", primary="orders", source_id="key",
    registration="mark",
    joins=(Join("cust", "customer", "ckey", "ckey"),),
    mapping={
        "registration": Mapping(field="mark", transform="faa_n_number", default=""),
        "icao_hex": Mapping(field="hex", transform="foca_hex_or_null"),
        "status": Mapping(field="status", transform="trim_or_null", lookup={"F": "valid", "O": "restricted", "P": "reserved"}, default="other"),
        "manufacturer": Mapping(field="cust.name", transform="trim_or_null"),
        "model": Mapping(field="priority", transform="last_comma_segment_or_null"),
        "category": Mapping(field="cust.segment", lookup={"BUILDING": "standard", "MACHINERY": "restricted"}, default="other"),
        "last_action_date": Mapping(field="date", transform="iso_date_only_or_null"),
        "year_manufactured": Mapping(field="date", transform="iso_year_or_null"),
        "max_takeoff_weight_kg": Mapping(field="price", transform="positive_float_or_null"),
        "owner.name": Mapping(field="cust.name", transform="trim_or_null"),
        "owner.kind": Mapping(constant="corporation"),
    },
)


def order_rows(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = texts(
        t(spark, sf, "orders"), key="o_orderkey", mark="concat(o_orderkey, 'x')", hex="lpad(lower(hex(o_orderkey)), 6, '0')",
        status="o_orderstatus", priority="o_orderpriority", date="date_format(o_orderdate, 'yyyy-MM-dd')", price="o_totalprice", ckey="o_custkey",
    )
    customers = texts(t(spark, sf, "customer"), ckey="c_custkey", name="c_name", segment="c_mktsegment")
    return orders.withColumn("_ord", F.col("key").cast("long")), customers.withColumn("_ord", F.col("ckey").cast("long"))


def order_records(spark: SparkSession, sf: str) -> DataFrame:
    orders, customers = order_rows(spark, sf)
    rows = lookup_join(orders, customers, ORDERS.joins[0]).drop("_hit_cust")
    return mapping.with_record(rows, ORDERS).select("_ord", "record", "failures", "unmatched")


_ORDER_ROW = """
SELECT o.*, c.c_name, c.c_mktsegment, lpad(lower(to_hex(o.o_orderkey)), 6, '0') AS hex,
  'N' || CAST(o.o_orderkey AS VARCHAR) || 'X' AS reg,
  CASE o.o_orderstatus WHEN 'F' THEN 'valid' WHEN 'O' THEN 'restricted' WHEN 'P' THEN 'reserved' ELSE 'other' END AS status,
  CASE c.c_mktsegment WHEN 'BUILDING' THEN 'standard' WHEN 'MACHINERY' THEN 'restricted' ELSE 'other' END AS category
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
"""


@query(f"""
SELECT hex AS icao_hex, reg AS registration, upper(reg) AS registration_key, status, c_name AS manufacturer, category,
  CAST(strftime(o_orderdate, '%Y') AS BIGINT) AS year_manufactured, 'corporation' AS owner_kind, 'orders' AS source
FROM ({_ORDER_ROW}) WHERE status <> 'reserved'
""")
def order_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, lookup join, mapping, feed: P1-P4, P8, P11, P12, J1, F9, A8-A12."""
    rows = feed.feed_slice(order_records(spark, sf))
    return rows.select(
        "icao_hex", "registration", "registration_key", "status", "manufacturer", "category", "year_manufactured", "owner_kind", "source"
    )


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS id,
  CASE o_orderstatus WHEN 'F' THEN 'valid' WHEN 'O' THEN 'restricted' ELSE 'other' END AS status FROM orders
""")
def map_lookup_status(spark: SparkSession, sf: str) -> DataFrame:
    rows = texts(t(spark, sf, "orders"), id="o_orderkey", s="o_orderstatus")
    m = Mapping(field="s", transform="trim_or_null", lookup={"F": "valid", "O": "restricted"}, default="other")
    return rows.select("id", mapping.status(m, rows.columns).value.alias("status"))


@query("""
SELECT 'kind' AS field, event_type AS value, count(*) AS n FROM events
WHERE event_type NOT IN ('click', 'view') AND event_type <> '' GROUP BY event_type
""")
def map_lookup_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """Lookups that took the default, counted."""
    rows = texts(t(spark, sf, "events"), kind="event_type")
    m = Mapping(field="kind", lookup={"click": "c", "view": "v"}, default="other")
    stray = rows.select(mapping.scalar(m, rows.columns).unmatched.alias("u")).where(F.col("u").isNotNull())
    return stray.groupBy("u.field", "u.value").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS id,
  CASE WHEN p_size IN (1, 2) THEN 'none' WHEN p_size % 7 = 0 THEN 'seven' ELSE 'none' END AS size_name,
  CASE WHEN p_type = 'LARGE BRASS' THEN NULL ELSE nullif(trim(p_type), '') END AS kind
FROM part
""")
def map_scalar_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """null_values before the transform, default for null and blank."""
    rows = texts(t(spark, sf, "part"), id="p_partkey", size="p_size", seven="CASE WHEN p_size % 7 = 0 THEN 'seven' ELSE '' END", kind="p_type")
    a = mapping.scalar(Mapping(field="seven", transform="trim_or_null", default="none"), rows.columns).value
    b = mapping.scalar(Mapping(field="kind", transform="trim_or_null", null_values=("LARGE BRASS",)), rows.columns).value
    return rows.select("id", F.when(F.col("size").isin("1", "2"), "none").otherwise(a).alias("size_name"), b.alias("kind"))


@query("""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
  CASE WHEN l_returnflag = 'R' AND l_quantity >= 1 THEN CASE WHEN CAST(floor(l_quantity) AS BIGINT) = 1 THEN 'fixed-wing-single-engine' ELSE 'fixed-wing-multi-engine' END
       WHEN l_returnflag = 'A' THEN 'rotorcraft' END AS airframe
FROM lineitem
""")
def map_compound(spark: SparkSession, sf: str) -> DataFrame:
    """A compound transform of two cells, mapped."""
    rows = texts(
        t(spark, sf, "lineitem"), id="concat(l_orderkey, '-', l_linenumber)",
        group="CASE l_returnflag WHEN 'R' THEN 'Aeroplane' WHEN 'A' THEN 'Helicopter' ELSE 'Ship' END", engines="l_quantity",
    )
    m = Mapping(fields=("group", "engines"), compound_transform="tc_airframe")
    return rows.select("id", mapping.scalar(m, rows.columns).value.alias("airframe"))


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS id, CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS weight, nullif(trim(s_name), '') AS name, 'corporation' AS kind,
  CAST(s_nationkey AS BIGINT) AS seats, s_acctbal < 0 AS broken
FROM supplier
""")
def map_numeric_and_party(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and numbers from text with their rules, and a party, in the record."""
    rows = texts(t(spark, sf, "supplier"), id="s_suppkey", balance="s_acctbal", name="s_name", nation="s_nationkey")
    source = _plain(mapping={
        "registration": Mapping(field="id"), "max_takeoff_weight_kg": Mapping(field="balance"), "seats": Mapping(field="nation"),
        "owner.name": Mapping(field="name", transform="trim_or_null"), "owner.kind": Mapping(constant="corporation"),
    })
    made = mapping.with_record(rows, source)
    weight = F.when(F.size("failures") == 0, F.col("record.max_takeoff_weight_kg")).alias("weight")
    return made.select("id", weight, "record.owner.name", "record.owner.kind", "record.seats", (F.size("failures") > 0).alias("broken"))


@query("""
SELECT CAST(doc_id AS VARCHAR) AS id, len(classes) AS n, array_to_string(classes, '|') AS classes
FROM (SELECT doc_id, list_filter(string_split(substr(trim(source), 2), ''), lambda x: x <> '') AS classes FROM documents)
""")
def map_array(spark: SparkSession, sf: str) -> DataFrame:
    """An array transform."""
    rows = texts(t(spark, sf, "documents"), id="doc_id", source="source")
    made = mapping.array(Mapping(field="source", array_transform="faa_cert_ops"), rows.columns).value
    return rows.select("id", F.size(made).cast("long").alias("n"), F.array_join(made, "|").alias("classes"))


@query(f"SELECT hex AS icao_hex, reg AS registration, c_name AS maker, category, CAST(0 AS BIGINT) AS broken FROM ({_ORDER_ROW})")
def record_build(spark: SparkSession, sf: str) -> DataFrame:
    """The whole record with its rules."""
    r = order_records(spark, sf)
    return r.select("record.icao_hex", "record.registration", F.col("record.manufacturer").alias("maker"), "record.category", F.size("failures").cast("long").alias("broken"))


def _stats(spark: SparkSession, source: Source, rows: DataFrame, names: str) -> DataFrame:
    """One row of a translation's counts."""
    done = translate(source, rows, {})
    out = spark.createDataFrame([tuple(done.stats[n] for n in names.split())], ", ".join(f"{n} long" for n in names.split()))
    done.release()
    return out


def _plain(**more) -> Source:
    base = {"id": "rows", "label": "Rows", "country": "US", "language": "en", "encoding": "utf8", "primary": "rows", "source_id": "id", "registration": "id"}
    return Source(**(base | more))


@query("""
SELECT count(*) AS total, count(*) FILTER (NOT bad) AS ok, count(*) FILTER (bad) AS failed
FROM (SELECT NOT (o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice >= 1000 AND o_orderkey % 11 <> 0) AS bad FROM orders)
""")
def validate_rows(spark: SparkSession, sf: str) -> DataFrame:
    """rows that break a rule (an unlisted value, a negative number, a malformed address) fail."""
    rows = texts(
        t(spark, sf, "orders"), id="o_orderkey", priority="o_orderpriority", over="o_totalprice - 1000",
        hex="CASE WHEN o_orderkey % 11 = 0 THEN 'not hex' ELSE lpad(lower(hex(o_orderkey)), 6, '0') END",
    )
    source = _plain(mapping={
        "registration": Mapping(field="id"), "status": Mapping(field="priority", lookup={"1-URGENT": "valid", "2-HIGH": "expired"}),
        "max_takeoff_weight_kg": Mapping(field="over"), "icao_hex": Mapping(field="hex"),
    })
    return _stats(spark, source, rows, "total ok failed")


@query("""
SELECT o.o_orderkey AS id, coalesce(c.c_name, '') AS name, coalesce(n.n_name, '') AS nation
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def lookup_joins(spark: SparkSession, sf: str) -> DataFrame:
    """Left lookups by one-row build sides."""
    c = texts(t(spark, sf, "customer"), ckey="c_custkey", name="c_name", nkey="c_nationkey").withColumn("_ord", F.lit(0))
    n = texts(t(spark, sf, "nation"), nkey="n_nationkey", name="n_name").withColumn("_ord", F.lit(0))
    o = texts(t(spark, sf, "orders"), id="o_orderkey", ckey="o_custkey")
    rows = lookup_join(o, c, Join("c", "c", "ckey", "ckey"))
    rows = lookup_join(rows, n, Join("n", "n", "nkey", "c.nkey"))
    return rows.select(F.col("id").cast("long").alias("id"), F.coalesce("`c.name`", F.lit("")).alias("name"), F.coalesce("`n.name`", F.lit("")).alias("nation"))


@query("""
SELECT count(*) AS n, count(c.c_custkey) AS hits FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""")
def join_hit_floor(spark: SparkSession, sf: str) -> DataFrame:
    """how many rows a join matched."""
    orders, customers = order_rows(spark, sf)
    return lookup_join(orders, customers, ORDERS.joins[0]).agg(F.count(F.lit(1)).alias("n"), F.count("_hit_cust").alias("hits"))


_PARTIES = """
SELECT CAST(l_orderkey AS VARCHAR) AS k, CAST(l_suppkey AS VARCHAR) AS s, l_returnflag AS f,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_returnflag) AS o FROM lineitem
"""


@query(f"""
SELECT a.k AS orderkey, string_agg(a.s, ' Y ' ORDER BY a.o) AS parties, any_value(b.kind) AS kind
FROM (SELECT k, s, min(o) AS o FROM ({_PARTIES}) GROUP BY k, s) a
JOIN (SELECT k, CASE WHEN count(DISTINCT s || ':' || f) > 1 THEN 'co-owner' ELSE min_by(f, o) END AS kind FROM ({_PARTIES}) GROUP BY k) b ON a.k = b.k
GROUP BY a.k
""")
def join_merge_stamp(spark: SparkSession, sf: str) -> DataFrame:
    """Parties joined in order of first sight, a stamp where they differ."""
    lines = t(spark, sf, "lineitem").withColumn("_ord", F.struct("l_linenumber", "l_suppkey", "l_returnflag"))
    side = lines.select(F.col("l_orderkey").cast("string").alias("k"), F.col("l_suppkey").cast("string").alias("s"), F.col("l_returnflag").alias("f"), "_ord")
    out = merged_build_side(side, "k", Merge(("s",), " Y ", {"f": "co-owner"}))
    return out.select(F.col("k").alias("orderkey"), F.col("s").alias("parties"), F.col("f").alias("kind"))


@query("SELECT p_brand AS key FROM part GROUP BY p_brand HAVING count(DISTINCT p_size) > 1")
def join_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Build-side keys whose rows differ."""
    side = t(spark, sf, "part").select("p_brand", F.col("p_size").cast("string").alias("size"), F.lit(0).alias("_ord"))
    return conflicting_keys(side, "p_brand")


@query("""
SELECT event_id, event_type FROM events WHERE strftime(ts, '%Y-%m-%d') = (SELECT max(strftime(ts, '%Y-%m-%d')) FROM events)
""")
def latest_snapshot_rows(spark: SparkSession, sf: str) -> DataFrame:
    """only the newest publication."""
    rows = t(spark, sf, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return latest_snapshot(rows, "day").select("event_id", "event_type")


@query("""
SELECT count(*) AS total, count(*) FILTER (id <> '') AS ok, least(count(*) FILTER (id = '' AND lang = 'de'), 40) AS skipped,
  count(*) FILTER (id = '') - least(count(*) FILTER (id = '' AND lang = 'de'), 40) AS failed
FROM (SELECT CASE WHEN doc_id % 10 = 0 THEN '' ELSE CAST(doc_id AS VARCHAR) END AS id, lang FROM documents)
""")
def missing_key_policy(spark: SparkSession, sf: str) -> DataFrame:
    """blank keys within a budget are skipped, others fail."""
    rows = texts(t(spark, sf, "documents"), id="CASE WHEN doc_id % 10 = 0 THEN '' ELSE string(doc_id) END", lang="lang", mark="string(doc_id)")
    source = _plain(mapping={"registration": Mapping(field="mark")}, allowed_missing={"max": 40, "field": "lang", "pattern": "^de$"})
    return _stats(spark, source, rows, "total ok skipped failed")


@query("""
SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k FROM events
""")
def json_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """Leaves of a JSON cell as text."""
    from .sources.jsontext import flat_text

    return t(spark, sf, "events").select("event_id", flat_text(F.try_parse_json("props"), ("k",)).alias("k"))


@query("""
SELECT p_partkey AS id, nullif(trim(p_name), '') AS name, lower(trim(p_type)) AS kind,
  CASE WHEN trim(p_brand) = 'Brand#11' THEN NULL ELSE nullif(trim(p_brand), '') END AS brand,
  regexp_replace(trim(p_type), '\\s+', '_', 'g') AS joined,
  nullif(string_split(p_name, ' ')[-1], '') AS last_word
FROM part
""")
def transform_text(spark: SparkSession, sf: str) -> DataFrame:
    """Text transforms."""
    p = t(spark, sf, "part")
    name = F.coalesce("p_name", F.lit(""))
    return p.select(
        F.col("p_partkey").alias("id"),
        SCALAR["trim_or_null"](name).alias("name"),
        SCALAR["lowercase"](F.col("p_type")).alias("kind"),
        SCALAR["na_or_null"](F.regexp_replace("p_brand", "^Brand#11$", "N/A")).alias("brand"),
        F.regexp_replace(SCALAR["collapse_ws_or_null"](F.col("p_type")), " ", "_").alias("joined"),
        SCALAR["last_comma_segment_or_null"](F.regexp_replace(name, " ", ",")).alias("last_word"),
    )


@query("""
SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS d1, strftime(o_orderdate, '%Y-%m-%d') AS d2, strftime(o_orderdate, '%Y-%m-%d') AS d3,
  strftime(o_orderdate, '%Y-%m-%d') AS d4, strftime(o_orderdate, '%Y-%m-%d') AS d5, strftime(o_orderdate, '%Y') AS y
FROM orders
""")
def transform_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Date transforms: six written forms of one date."""
    f = lambda p: F.date_format("o_orderdate", p)
    made = {
        "d1": (SCALAR["date_yyyymmdd_or_null"], f("yyyyMMdd")),
        "d2": (SCALAR["date_ddmmyyyy_or_null"], f("ddMMyyyy")),
        "d3": (SCALAR["date_dd_slash_or_null"], f("dd/MM/yyyy")),
        "d4": (SCALAR["date_dd_dot_or_null"], f("dd.MM.yyyy")),
        "d5": (SCALAR["date_dmmmyy_or_null"], f("d-MMM-yy")),
        "y": (SCALAR["iso_year_or_null"], f("yyyy-MM-dd'T'HH:mm:ss")),
    }
    return staged(t(spark, sf, "orders"), made).select(F.col("o_orderkey").alias("id"), *made)


@query("""
SELECT c_custkey AS id, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS positive, CAST(c_custkey AS VARCHAR) AS whole,
  CASE WHEN c_acctbal = floor(c_acctbal) THEN CAST(CAST(c_acctbal AS BIGINT) AS VARCHAR) END AS int_balance,
  CASE WHEN c_acctbal > 0 THEN round(floor(c_acctbal * 0.868976::DOUBLE * 10 + 0.5) / 10, 1) END AS knots
FROM customer
""")
def transform_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Number transforms."""
    text = F.col("c_acctbal").cast("string")
    return t(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        SCALAR["positive_float_or_null"](text).cast("double").alias("positive"),
        SCALAR["int_or_null"](F.concat(F.lit(" "), F.col("c_custkey").cast("string"))).alias("whole"),
        SCALAR["int_or_null"](text).alias("int_balance"),
        F.round(SCALAR["mph_to_ktas_or_null"](text).cast("double"), 1).alias("knots"),
    )


@query("""
SELECT s_suppkey AS id, 'N' || s_suppkey AS n_number, CASE WHEN length(CAST(s_suppkey AS VARCHAR)) = 3 THEN 'CF-' ELSE 'C-' END || s_suppkey AS tc,
  'VH-' || s_suppkey AS vh, 'PH-' || s_suppkey AS ph, 'ES-' || s_suppkey AS es, upper(regexp_replace(upper(s_name), '[^A-Z0-9]', '', 'g')) AS mark,
  lpad(lower(to_hex(s_suppkey)), 6, '0') AS hex
FROM supplier
""")
def transform_marks(spark: SparkSession, sf: str) -> DataFrame:
    """Mark and address transforms, and the lookup key of a mark."""
    key = F.col("s_suppkey").cast("string")
    return t(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"),
        SCALAR["faa_n_number"](key).alias("n_number"),
        SCALAR["tc_full_registration"](key).alias("tc"),
        SCALAR["casa_full_registration"](key).alias("vh"),
        SCALAR["nl_ilt_registration_or_null"](F.concat(F.lit("ph-"), key)).alias("ph"),
        SCALAR["ee_registration"](F.concat(F.lit("es - "), key)).alias("es"),
        registration_key(F.col("s_name")).alias("mark"),
        SCALAR["binary_to_hex_or_null"](F.lpad(F.conv(key, 10, 2), 24, "0")).alias("hex"),
    )


@query("""
SELECT c_custkey AS id, c_name AS name, CASE WHEN c_acctbal >= 0 THEN 'SP' END AS state,
  CASE WHEN c_custkey % 3 = 0 THEN 'co-owner' WHEN c_custkey % 3 = 1 THEN 'corporation' ELSE 'individual' END AS kind
FROM customer
""")
def transform_json_parties(spark: SparkSession, sf: str) -> DataFrame:
    """Parties in a JSON cell: the first one's name and state, its kind by the document's length."""
    doc = "lpad(c_custkey, CASE WHEN c_custkey % 3 = 1 THEN 14 ELSE 11 END, '0')"
    first = f"named_struct('NOME', c_name, 'DOCUMENTO', {doc}, 'UF', CASE WHEN c_acctbal >= 0 THEN 'SP' ELSE 'Indisponível' END)"
    other = "named_struct('NOME', 'B', 'DOCUMENTO', '9', 'UF', 'RJ')"
    cell = F.expr(f"to_json(CASE WHEN c_custkey % 3 = 0 THEN array({first}, {other}) ELSE array({first}) END)")
    c = spread(t(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), "c_custkey").select(F.col("c_custkey").alias("id"), cell.alias("cell"))
    return staged(c, {n: (SCALAR[f"br_party_{n}"], F.col("cell")) for n in ("name", "state", "kind")}).drop("cell")


def record_struct(made: dict[str, Column]) -> Column:
    """A record with the given paths; the others are null or empty."""

    def leaf(path: str, kind: T.DataType) -> Column:
        if path in made:
            return made[path].cast(kind)
        return F.array().cast(kind) if isinstance(kind, T.ArrayType) else F.lit(None).cast(kind)

    columns = []
    for f in RECORD.fields:
        if isinstance(f.dataType, T.StructType):
            columns.append(F.struct(*[leaf(f"{f.name}.{g.name}", g.dataType).alias(g.name) for g in f.dataType.fields]).alias(f.name))
        else:
            columns.append(leaf(f.name, f.dataType).alias(f.name))
    return F.struct(*columns)


def _order_states(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as rows that share a key: the customer."""
    o = t(spark, sf, "orders")
    made = {
        "source": F.lit("orders"), "source_id": F.col("o_custkey").cast("string"), "registration": F.col("o_orderkey").cast("string"),
        "country": F.lit("US"), "status": F.when(F.col("o_orderstatus") == "P", "cancelled").otherwise("valid"),
        "last_action_date": F.date_format("o_orderdate", "yyyy-MM-dd"),
    }
    return o.select(
        F.col("o_custkey").cast("string").alias("source_id"), F.col("o_orderkey").alias("_ord"), F.col("o_orderkey").cast("string").alias("raw"),
        record_struct(made).alias("record"), F.lit(False).alias("bad"),
    )


@query("""
WITH o AS (
  SELECT CAST(o_custkey AS VARCHAR) AS source_id, o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'cancelled' ELSE 'valid' END AS status,
    strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders
), live AS (
  SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY status = 'cancelled', d DESC) AS rn,
    max(CASE WHEN status = 'valid' THEN 1 ELSE 0 END) OVER (PARTITION BY source_id) AS any_live FROM o
)
SELECT source_id, status, d AS last_date FROM live WHERE rn = 1
""")
def duplicates_by_recency(spark: SparkSession, sf: str) -> DataFrame:
    """The fold over rows of one key; what it settles by status and date is order-free."""
    done = resolve(_order_states(spark, sf))
    return done.select("source_id", "record.status", F.col("record.last_action_date").alias("last_date"))


@query("""
SELECT count(*) AS ids, (SELECT count(*) FROM orders) AS total FROM (SELECT DISTINCT o_custkey FROM orders)
""")
def duplicate_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that hold a record, and rows in all."""
    rows = _order_states(spark, sf)
    return resolve(rows).agg(F.count("record").alias("ids")).crossJoin(rows.agg(F.count(F.lit(1)).alias("total")))  # one row each


@query("""
SELECT p_partkey AS id, CASE WHEN count(*) OVER (PARTITION BY k) < 2 THEN k END AS registration_key
FROM (SELECT p_partkey, upper(regexp_replace(upper(p_brand), '[^A-Z0-9]', '', 'g')) || p_size AS k, p_partkey % 2 = 0 AS has_hex FROM part)
QUALIFY has_hex OR count(*) OVER (PARTITION BY k) < 2
""")
def feed_ambiguous_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that several rows hold are cleared, rows without an address go."""
    p = t(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.concat(registration_key(F.col("p_brand")), F.col("p_size")).alias("registration_key"),
        F.when(F.col("p_partkey") % 2 == 0, F.hex("p_partkey")).alias("icao_hex"),
    )
    return feed.clear_ambiguous(p).select("id", "registration_key")


@query("""
SELECT hex, source, id FROM (
  SELECT *, row_number() OVER (PARTITION BY hex ORDER BY source, id) AS rn FROM (
    SELECT c_nationkey AS hex, 'customer' AS source, c_custkey AS id FROM customer
    UNION ALL SELECT s_nationkey, 'supplier', s_suppkey FROM supplier)) WHERE rn = 1
""")
def feed_hex_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The first source by name wins an address."""
    c = t(spark, sf, "customer").select(F.col("c_nationkey").alias("hex"), F.lit("customer").alias("source"), F.col("c_custkey").alias("id"))
    s = t(spark, sf, "supplier").select(F.col("s_nationkey").alias("hex"), F.lit("supplier").alias("source"), F.col("s_suppkey").alias("id"))
    return feed.first_by_hex(c.unionByName(s), "hex", ["source", "id"])


@query("""
WITH r AS (
  SELECT CAST(c_nationkey AS VARCHAR) || c_mktsegment AS k, floor(c_acctbal / 500) AS d, md5(substr(c_name, -1)) AS shown, substr(c_name, -1) AS tail FROM customer
), top AS (
  SELECT k, max(lpad(CAST(d + 100 AS INTEGER)::VARCHAR, 6, '0')) AS d FROM r GROUP BY k
)
SELECT r.k AS key, min(r.shown) = max(r.shown) AS same FROM r JOIN top ON r.k = top.k AND lpad(CAST(r.d + 100 AS INTEGER)::VARCHAR, 6, '0') = top.d GROUP BY r.k
""")
def feed_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Of each key's newest rows, whether all serve the same."""
    c = t(spark, sf, "customer")
    rows = c.select(
        F.concat(F.col("c_nationkey").cast("string"), "c_mktsegment").alias("key"),
        (F.floor(F.col("c_acctbal") / 500) + 100).alias("date"), F.xxhash64(F.substring("c_name", -1, 1)).alias("shown"), F.col("c_custkey").alias("id"),
    )
    return feed.resolved(rows, "key").select("key", "same")


@query("SELECT o_orderkey, status FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'reserved' WHEN 'O' THEN NULL ELSE 'valid' END AS status FROM orders) WHERE status NOT IN ('cancelled', 'reserved')")
def feed_status_filter(spark: SparkSession, sf: str) -> DataFrame:
    """a null status is not served."""
    s = F.when(F.col("o_orderstatus") == "P", "reserved").when(F.col("o_orderstatus") == "F", "valid")
    return feed.served(t(spark, sf, "orders").select("o_orderkey", s.alias("status")))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def feed_lookup_many(spark: SparkSession, sf: str) -> DataFrame:
    """Any number of keys by a semi join."""
    keys = t(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    return feed.lookup_many(t(spark, sf, "customer"), keys, "o_custkey", "c_custkey").select("c_custkey", "c_name")


@query(f"SELECT hex AS key, reg AS registration, c_name || ' ' || o_orderpriority AS type, 'From Orders' AS attribution FROM ({_ORDER_ROW}) WHERE hex IN ('000001', '00000a', '0000ff') AND status <> 'reserved'")
def feed_lookup_hex(spark: SparkSession, sf: str) -> DataFrame:
    """An exact lookup of request keys with the response's columns."""
    rows = feed.feed_slice(order_records(spark, sf))
    found = feed.lookup(rows, ["000001", " 00000A ", "0000ff"], attributions={"orders": "From Orders"})
    return found.select("key", "registration", "type", "attribution")


@query("""
SELECT p_partkey AS id, CASE WHEN lower(p_name) LIKE lower(p_brand) || '%' THEN p_name ELSE p_brand || ' ' || p_name END AS model FROM part
""")
def compose_maker_model(spark: SparkSession, sf: str) -> DataFrame:
    """P15."""
    return t(spark, sf, "part").select(F.col("p_partkey").alias("id"), feed.compose_model(F.col("p_brand"), F.col("p_name")).alias("model"))


@query("""
WITH h AS (SELECT sha256(CAST(o_orderkey AS VARCHAR) || chr(0) || o_orderstatus || o_orderpriority) AS h FROM orders),
b AS (SELECT substr(h, 1, 3) AS b, sha256(string_agg(h, chr(10) ORDER BY h)) AS d FROM h GROUP BY 1)
SELECT sha256(string_agg(b || ':' || d, chr(10) ORDER BY b)) AS content_hash FROM b
""")
def content_hash(spark: SparkSession, sf: str) -> DataFrame:
    """A digest of a set of rows, whatever their order."""
    o = t(spark, sf, "orders")
    return artifact.content_hash(o, F.col("o_orderkey").cast("string"), F.concat("o_orderstatus", "o_orderpriority"))


_CACHE = "(SELECT DISTINCT sha256('lien_status' || chr(0) || source) AS hash FROM documents WHERE lang = 'en' AND doc_id % 2 = 0)"


@query(f"""
SELECT DISTINCT sha256('lien_status' || chr(0) || source) AS hash, source AS text FROM documents
WHERE lang <> 'en' AND source <> '' AND sha256('lien_status' || chr(0) || source) NOT IN (SELECT hash FROM {_CACHE})
""")
def translate_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct texts that are neither cached nor given up."""
    d = t(spark, sf, "documents").withColumn("hash", localize.text_hash(F.lit("lien_status"), F.col("source")))
    cache = d.where("lang = 'en' AND doc_id % 2 = 0").select("hash").distinct()
    found = d.where("lang <> 'en' AND source <> ''").select("hash", F.col("source").alias("text")).dropDuplicates(["hash"])
    return localize.delta(found, cache, spark.createDataFrame([], localize.FAILURES))


@query("""
SELECT doc_id, coalesce(CASE WHEN source IN (SELECT source FROM documents WHERE lang = 'en' AND doc_id % 2 = 0) THEN upper(source) END, source) AS text FROM documents
""")
def translate_apply(spark: SparkSession, sf: str) -> DataFrame:
    """Cached renderings joined back."""
    d = t(spark, sf, "documents")
    cache = d.where("lang = 'en' AND doc_id % 2 = 0").select(localize.text_hash(F.lit("lien_status"), F.col("source")).alias("hash"), F.upper("source").alias("text")).distinct()
    return localize.apply_text(d.select("doc_id", F.col("source").alias("text_")), "lien_status", "text_", cache).select("doc_id", F.col("text_").alias("text"))


@query("""
SELECT CAST(doc_id AS VARCHAR) AS hash, CAST(CASE WHEN lang = 'de' THEN 2 ELSE 0 END + CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS failures
FROM documents WHERE doc_id % 3 <> 0 AND (lang = 'de' OR doc_id % 2 = 0)
""")
def cache_failures(spark: SparkSession, sf: str) -> DataFrame:
    """An answer clears a count, an attempt without one adds."""
    d = t(spark, sf, "documents").withColumn("hash", F.col("doc_id").cast("string"))
    before = d.where("lang = 'de'").select("hash", F.lit(2).alias("failures"))
    return localize.count_failures(before, d.where("doc_id % 2 = 0").select("hash"), d.where("doc_id % 3 = 0").select("hash"))


_NOW = "TIMESTAMP '2024-06-01 00:00:00'"


@query(f"""
SELECT event_type, epoch({_NOW}) - epoch(date_trunc('second', last)) >= 7 * 86400 AS due,
  epoch({_NOW}) - epoch(date_trunc('second', last)) > 7 * 86400 * 1.5 AS overdue,
  CAST(floor((epoch({_NOW}) - epoch(date_trunc('second', last))) / 86400) AS BIGINT) AS days
FROM (SELECT event_type, max(ts) AS last FROM events GROUP BY event_type)
""")
def cadence(spark: SparkSession, sf: str) -> DataFrame:
    """Due, overdue and age."""
    last = t(spark, sf, "events").groupBy("event_type").agg(F.max("ts").alias("last"))
    now, week = F.to_timestamp(F.lit("2024-06-01 00:00:00")), F.lit(7)
    return last.select(
        "event_type", artifact.due(F.col("last"), week, now).alias("due"), artifact.overdue(F.col("last"), week, now).alias("overdue"),
        artifact.days_since(F.col("last"), now).alias("days"),
    )


@query("""
SELECT l_returnflag AS flag, n, prior, n = 0 OR prior > 0 AND n * 1.0 / prior < 0.5 AS refused
FROM (SELECT l_returnflag, count(*) FILTER (l_shipdate >= TIMESTAMP '1995-01-01') AS n, count(*) FILTER (l_shipdate < TIMESTAMP '1995-01-01') AS prior
  FROM lineitem GROUP BY 1)
""")
def retain_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Nothing is written if it is empty or shrank by half; one decision a flag."""
    late = F.col("l_shipdate") >= "1995-01-01"
    counts = t(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("flag")).agg(F.count_if(late).alias("n"), F.count_if(~late).alias("prior"))

    def refused(n: int, prior: int) -> bool:
        try:
            artifact.guard_counts(n, prior)
        except GuardError:
            return True
        return False

    rows = [(r["flag"], r["n"], r["prior"], refused(r["n"], r["prior"])) for r in counts.collect()]  # a row a flag
    return spark.createDataFrame(rows, "flag string, n long, prior long, refused boolean")


@query("SELECT n_name AS missing FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)")
def missing_slices(spark: SparkSession, sf: str) -> DataFrame:
    """What is declared and has no rows."""
    rows = t(spark, sf, "supplier").where("s_acctbal > 9000")
    return feed.absent(t(spark, sf, "nation"), rows, "n_nationkey", "s_nationkey").select(F.col("n_name").alias("missing"))


@query("""
SELECT CAST(l_orderkey AS BIGINT) AS page, CAST(r AS BIGINT) AS row, string_agg(CAST(l_partkey AS VARCHAR), chr(10) ORDER BY l_partkey) AS parts
FROM (SELECT l_orderkey, l_partkey, least(2, CAST(floor(l_quantity / 20) AS INTEGER)) AS r FROM (SELECT DISTINCT l_orderkey, l_partkey, l_quantity FROM lineitem))
GROUP BY 1, 2
""")
def positioned_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Items snapped to the nearest of fixed positions, lines in reading order."""
    from .sources.positioned import column_of

    items = t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity").distinct()
    at = column_of([10.0, 30.0, 50.0], F.floor(F.col("l_quantity") / 20) * 20 + 10)
    placed = items.select(F.col("l_orderkey").alias("page"), F.least(at, F.lit(2)).cast("long").alias("row"), "l_partkey")
    lines = F.transform(F.array_sort(F.collect_list("l_partkey")), lambda x: x.cast("string"))
    return placed.groupBy("page", "row").agg(F.array_join(lines, "\n").alias("parts"))


@query("SELECT user_id, max(ts) AS ts FROM events GROUP BY user_id")
def newest_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """The batch form of the streaming refresh."""
    from .streaming.refresh import newest

    return newest(t(spark, sf, "events").select("user_id", "ts"), "user_id", "ts")


@query("""
SELECT r_name, n_name, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, n_name
""")
def coverage_by_region(spark: SparkSession, sf: str) -> DataFrame:
    """Rows served by place: a report over the lookup joins; each order is counted before the joins widen."""
    per_customer = t(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    c, n, r = t(spark, sf, "customer"), t(spark, sf, "nation"), t(spark, sf, "region")
    placed = per_customer.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(F.sum("n").alias("n"))
    named = placed.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return named.groupBy("r_name", "n_name").agg(F.sum("n").alias("orders"))


__all__ = ["QUERIES", "SQL", "Window", "order_feed"]

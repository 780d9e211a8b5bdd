"""Registered queries over files and stores, written in a source's format and read back by the engine, and over large key sets."""

from __future__ import annotations

import dataclasses
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .cluster import fresh_path
from .config import Mapping, Source
from .operators import artifact, heavy, mapping
from .operators.joins import GuardError
from .plans.pipeline import Store, deploy_due, lookup, mark_deployed, publish, refresh
from .queries import ORDERS, SQL, cadence, order_rows, query, t, texts
from .sources.delimited import read_delimited
from .sources.positioned import read_positioned
from .sources.reader import read_primary
from .streaming.buckets import Buckets


def _csv(df: DataFrame, name: str, **options: str) -> str:
    """``df`` as delimited text in the shared folder, without a header."""
    path = fresh_path(df.sparkSession, name)
    fixed = {"quoteAll": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.options(**(fixed | options)).csv(path)
    return path


@query("SELECT CAST(doc_id AS VARCHAR) AS id, coalesce(lang, '') AS lang, coalesce(text, '') AS text FROM documents")
def csv_with_line_ends(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts with quotes and line ends through quoted cells, cut in byte ranges; pinned columns."""
    path = _csv(texts(t(spark, sf, "documents"), id="doc_id", lang="lang", text="text"), "quoted")
    source = Source(
        id="docs", label="Docs", country="US", language="en", encoding="utf8", primary="m", source_id="id", registration="id",
        columns={"m": ["id", "lang", "text"]}, quoted_line_ends=True, mapping={},
    )
    return read_primary(spark, source, {"m": path}).drop("_ord")


@query(r"SELECT CAST(doc_id AS VARCHAR) AS id, regexp_replace(coalesce(text, ''), '[^\x00-\x7F\xA0-\xFF]', '', 'g') AS text FROM documents")
def csv_latin1(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts in a one-byte encoding."""
    d = texts(t(spark, sf, "documents"), id="doc_id", text=r"regexp_replace(text, '[^\\x00-\\x7F\\xA0-\\xFF]', '')")
    path = _csv(d, "latin1", encoding="ISO-8859-1", sep=";")
    return read_delimited(spark, path, ";", "latin1", ["id", "text"], quoted_line_ends=True).drop("_ord")


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS id, trim(p_name) AS name, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_brand END AS brand,
  CASE WHEN p_partkey % 7 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS size FROM part
""")
def csv_ragged(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with too few and too many cells, blank lines, trimmed cells."""
    p = t(spark, sf, "part")
    line = F.expr("""CASE WHEN p_partkey % 7 = 0 THEN concat(p_partkey, '| ', p_name, ' ')
      WHEN p_partkey % 7 = 1 THEN concat(p_partkey, '|', p_name, '|', p_brand, '|', p_size, '|more|cells')
      ELSE concat(p_partkey, '|"', p_name, '"|', p_brand, '|', p_size, '\n') END""")
    path = fresh_path(spark, "ragged")
    p.select(line.alias("value")).write.text(path)
    n = p.where("p_partkey % 7 < 2").count()
    return read_delimited(spark, path, "|", "utf8", ["id", "name", "brand", "size"], trim=True, allowed_ragged_rows=n).drop("_ord")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS "key", CAST(o_custkey AS VARCHAR) AS "cust.id", o_orderpriority || '} ], {"' AS "cust.note",
  '["' || o_orderstatus || '",' || CAST(o_orderkey % 5 AS VARCHAR) || ']' AS marks, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'true' END AS flag
FROM orders
""")
def json_array(spark: SparkSession, sf: str) -> DataFrame:
    """Arrays of nested records under a path, each file cut in byte ranges."""
    o = t(spark, sf, "orders")
    record = F.to_json(F.expr("""named_struct('key', o_orderkey, 'cust', named_struct('id', o_custkey, 'note', concat(o_orderpriority, '} ], {"')),
      'marks', array(o_orderstatus, string(o_orderkey % 5)), 'flag', CASE WHEN o_orderkey % 3 <> 0 THEN true END)"""))
    record = F.regexp_replace(record, '"([0-4])"\\]', "$1]")  # the second mark is a number
    files = max(8, o.count() // 2_000_000)
    rows = o.select(F.pmod("o_orderkey", F.lit(files)).cast("int").alias("file"), "o_orderkey", record.alias("r"))
    firsts = F.broadcast(o.groupBy(F.pmod("o_orderkey", F.lit(files)).cast("int").alias("file")).agg(F.min("o_orderkey").alias("least")))  # a row for each file
    first = F.col("o_orderkey") == F.col("least")
    rows = rows.join(firsts, "file")
    rows = rows.select("file", F.lit(1).alias("place"), "o_orderkey", F.concat(F.when(first, F.lit("")).otherwise(F.lit(",")), "r").alias("value"))
    ends = spark.range(files).select(F.col("id").cast("int").alias("file"), F.explode(F.expr("array(named_struct('p', 0, 'v', '{\"meta\": {\"n\": [1]}, \"data\": {\"rows\": ['), named_struct('p', 2, 'v', ']}, \"end\": {}}'))")).alias("e"))
    ends = ends.select("file", F.col("e.p").alias("place"), F.lit(0).cast("long").alias("o_orderkey"), F.col("e.v").alias("value"))
    path = fresh_path(spark, "json")
    rows.unionByName(ends).repartitionById(files, F.col("file")).sortWithinPartitions("file", "place", "o_orderkey").select("value").write.text(path)
    source = Source(
        id="orders", label="Orders", country="US", language="en", encoding="utf8", primary="m", source_id="key", registration="key",
        format="json", record_path="data.rows", mapping={},
    )
    return read_primary(spark, source, {"m": path}).select("key", "`cust.id`", "`cust.note`", "marks", "flag")


@query("""
SELECT CAST(l_orderkey AS BIGINT) AS page, 'N' || l_linenumber AS mark, string_agg(part, chr(10) ORDER BY y DESC, part) AS parts, CAST(min(l_suppkey) AS VARCHAR) AS supplier
FROM (SELECT l_orderkey, l_linenumber, l_suppkey, 'P' || l_partkey AS part, l_partkey % 10 AS y FROM lineitem) GROUP BY l_orderkey, l_linenumber
""")
def positioned_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A page for each order, a row for each line number; parts stand up to half a row above it, ties included."""
    lines = t(spark, sf, "lineitem").selectExpr("l_orderkey AS page", "l_linenumber AS n", "l_partkey AS part", "l_suppkey AS supplier")
    # One shuffle by page: what follows, here and in the reading, stays within pages.
    lines = lines.repartition("page")
    rows = lines.groupBy("page", "n").agg(F.min("supplier").alias("s"))
    rows = rows.selectExpr("page", """inline(array(
      named_struct('x', 10.0D, 'y', n * 20.0D, 'str', concat('N', n)), named_struct('x', 88.0D, 'y', n * 20.0D, 'str', string(s))))""")
    items = rows.unionByName(lines.selectExpr("page", "52.0D AS x", "n * 20.0D + part % 10 AS y", "concat('P', part) AS str"))
    # Single rows reach any distance; blank pages do not count, one page without an anchor is allowed.
    more = spark.range(1, 3).selectExpr("-id AS page", "1.0D AS x", "1.0D AS y", "IF(id = 1, 'legend', ' ') AS str")
    items = items.unionByName(more.withColumn("page", F.col("page").cast(items.schema["page"].dataType)).repartition("page"))
    rows = read_positioned(items, "x", [10.0, 50.0, 90.0], ["mark", "parts", "supplier"], "^N[0-9]+$", allowed_anchorless_pages=1)
    return rows.select(F.col("_ord.page").cast("long").alias("page"), "mark", "parts", "supplier")


_DIGEST = """
SELECT count(*) AS n, {words}
FROM (SELECT sha256(CAST(o_orderkey AS VARCHAR) || chr(0) || o_orderstatus || o_orderpriority) AS h FROM orders WHERE {where})
""".replace("{words}", ", ".join(f"sum(CAST('0x' || substr(h, {16 * i + 1}, 16) AS UBIGINT)) % CAST('18446744073709551616' AS HUGEINT) AS w{i}" for i in range(4)))
_KEPT = "sha256(n || ':' || w0 || '-' || w1 || '-' || w2 || '-' || w3)"


@query(f"""
SELECT 'whole' AS of, n AS rows, {_KEPT} AS digest FROM ({_DIGEST.format(where="true")})
UNION ALL SELECT 'base', n, {_KEPT} FROM ({_DIGEST.format(where="o_orderkey % 10 <> 3")})
UNION ALL SELECT 'base and what came', n, {_KEPT} FROM ({_DIGEST.format(where="true")})
UNION ALL SELECT 'less what went', n, {_KEPT} FROM ({_DIGEST.format(where="o_orderkey % 7 <> 0")})
""")
def set_digest_changes(spark: SparkSession, sf: str) -> DataFrame:
    """A set's digest follows from what came and what went, without reading the rest again."""
    o = t(spark, sf, "orders")
    of = lambda rows: artifact.set_digest(rows, F.col("o_orderkey").cast("string"), F.concat("o_orderstatus", "o_orderpriority"))
    base = of(o.where("o_orderkey % 10 <> 3"))
    came = artifact.SetDigest.parse(base.kept()) + of(o.where("o_orderkey % 10 = 3"))
    went = came - of(o.where("o_orderkey % 7 = 0"))
    made = {"whole": of(o), "base": base, "base and what came": came, "less what went": went}
    return spark.createDataFrame([(k, d.rows, d.text()) for k, d in made.items()], "of string, rows long, digest string")


_GROUP_WORDS = ", ".join(f"CAST(sum(CAST('0x' || substr(h, {16 * i + 1}, 16) AS UBIGINT)) % CAST('18446744073709551616' AS HUGEINT) AS DECIMAL(20,0)) AS w{i}" for i in range(4))


@query(f"""
SELECT source, count(*) AS rows, {_GROUP_WORDS}
FROM (SELECT coalesce(source, '') AS source, sha256(CAST(doc_id AS VARCHAR) || chr(0) || coalesce(text, '')) AS h FROM documents) GROUP BY source
""")
def set_digest_by_source(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of all groups at once; a hot group is combined before it is shuffled."""
    d = t(spark, sf, "documents").withColumn("source", F.coalesce("source", F.lit("")))
    return artifact.digest_sums(d, F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")), "source")




@query("""
SELECT 'part' AS field, CAST(l_partkey AS VARCHAR) AS value, count(*) AS rows FROM lineitem GROUP BY l_partkey ORDER BY rows DESC, value LIMIT 40
""")
def unmatched_top(spark: SparkSession, sf: str) -> DataFrame:
    """The most frequent stray values, from bounded summaries and an exact recount of what they keep."""
    rows = texts(t(spark, sf, "lineitem"), key="l_orderkey", part="l_partkey")
    m = Mapping(field="part", lookup={"": "none"}, default="other")
    stray = rows.select(mapping.scalar(m, rows.columns).unmatched.alias("u")).where(F.col("u").isNotNull()).select("u.field", "u.value")
    return heavy.top_values(stray, ["field", "value"], 40)


@query("SELECT user_id, max(ts) AS ts FROM events GROUP BY user_id")
def newest_in_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches folded into a table of buckets."""
    e = t(spark, sf, "events").select("user_id", "ts")
    table = Buckets(spark, fresh_path(spark, "buckets"))
    for i in range(3):
        table.merge(e.where(F.pmod(F.xxhash64("user_id", "ts"), F.lit(3)) == i), i, "user_id", "ts", 8)
    return table.read()


_ORDER_COLUMNS = {"orders": ["key", "mark", "hex", "status", "priority", "date", "price", "ckey"], "customer": ["ckey", "name", "segment"]}


def _order_store(spark: SparkSession, sf: str) -> tuple[Store, Source, dict[str, str]]:
    """A store, the source of orders over delimited files, and the files."""
    orders, customers = order_rows(spark, sf)
    files = {"orders": _csv(orders.select(*_ORDER_COLUMNS["orders"]), "orders"), "customer": _csv(customers.select(*_ORDER_COLUMNS["customer"]), "customer")}
    return Store(spark, fresh_path(spark, "store")), dataclasses.replace(ORDERS, columns=_ORDER_COLUMNS, cadence_days=7), files


@query(SQL["order_feed"])
def store_publish(spark: SparkSession, sf: str) -> DataFrame:
    """Files to a source's table and slice, slices to the published feed, read back."""
    store, source, files = _order_store(spark, sf)
    refresh(spark, store, source, files)
    publish(spark, store, [source.id])
    return store.read("feed").select(
        "icao_hex", "registration", "registration_key", "status", "manufacturer", "category", "year_manufactured", "owner_kind", "source"
    )


@query("""
SELECT * FROM (VALUES ('first run', 'written'), ('too early', 'not due'), ('unchanged', 'written'), ('dry run', 'written'), ('of half the rows', 'refused'),
  ('deploy due', 'True'), ('once deployed', 'False'), ('versions of the table', '1'), ('versions of the slice', '2')) v(step, result)
UNION ALL SELECT 'rows of the table', CAST(count(*) AS VARCHAR) FROM supplier
UNION ALL SELECT 'rows of the feed', CAST(count(*) AS VARCHAR) FROM supplier
UNION ALL SELECT 'by mark', 'A' || max(s_suppkey) FROM supplier
""")
def store_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs that write, are not due, leave an unchanged table, are refused; the deployed marker; a lookup by mark."""
    suppliers = texts(t(spark, sf, "supplier"), id="s_suppkey", mark="concat('a', s_suppkey)")
    path, half = _csv(suppliers, "suppliers"), _csv(suppliers.where(F.pmod(F.col("id").cast("int"), F.lit(5)) < 2), "suppliers")
    source = Source(
        id="suppliers", label="Suppliers", country="US", language="en", encoding="utf8", primary="m", source_id="id", registration="mark",
        columns={"m": ["id", "mark"]}, cadence_days=7, mapping={"registration": Mapping(field="mark"), "status": Mapping(constant="valid")},
    )
    store, start = Store(spark, fresh_path(spark, "store")), datetime(2024, 1, 1, tzinfo=timezone.utc)
    run = lambda days, file=path, to=store: refresh(spark, to, source, {"m": file}, now=start + timedelta(days=days))["status"]
    out = [("first run", run(0)), ("too early", run(3)), ("unchanged", run(8)), ("dry run", run(20, to=Store(spark, store.base, dry_run=True)))]
    try:
        out.append(("of half the rows", run(20, half)))
    except GuardError:
        out.append(("of half the rows", "refused"))
    feed = publish(spark, store, [source.id])
    out.append(("deploy due", str(deploy_due(store))))
    mark_deployed(store)
    publish(spark, store, [source.id])
    out.append(("once deployed", str(deploy_due(store))))
    last = suppliers.agg(F.max(F.col("id").cast("int"))).first()[0]
    out += [("versions of the table", str(store.kept("aircraft/source=suppliers"))), ("versions of the slice", str(store.kept("feed_slice/source=suppliers")))]
    out += [("rows of the table", str(store.read("aircraft/source=suppliers").count())), ("rows of the feed", str(feed.count()))]
    out.append(("by mark", lookup(store, [f"a{last}"], "mark").first()["key"]))
    return spark.createDataFrame(out, "step string, result string")


_FEED_ROW = """'{"icao_hex":"' || hex || '","registration_key":"' || mark || '"}'"""


@query(f"""
SELECT n AS rows, {_KEPT} AS digest FROM (SELECT count(*) AS n, {", ".join(f"sum(CAST('0x' || substr(h, {16 * i + 1}, 16) AS UBIGINT)) % CAST('18446744073709551616' AS HUGEINT) AS w{i}" for i in range(4))}
FROM (SELECT sha256(hex || chr(0) || {_FEED_ROW}) AS h FROM (SELECT lpad(lower(to_hex(o_orderkey)), 6, '0') AS hex, 'N' || o_orderkey AS mark FROM orders)))
""")
def feed_digest(spark: SparkSession, sf: str) -> DataFrame:
    """The digest of a feed's rows."""
    rows = t(spark, sf, "orders").select(F.lpad(F.lower(F.hex("o_orderkey")), 6, "0").alias("icao_hex"), F.concat(F.lit("N"), F.col("o_orderkey").cast("string")).alias("registration_key"))
    d = artifact.feed_digest(rows)
    return spark.createDataFrame([(d.rows, d.text())], "rows long, digest string")


@query("""
SELECT '| ' || event_type || ' | ' || days || ' | 7 | ' || CASE WHEN overdue THEN 'yes' ELSE 'no' END || ' |' AS line, row_number() OVER (ORDER BY event_type) + 1 AS n
FROM (SELECT event_type, CAST(floor((epoch(TIMESTAMP '2024-06-01 00:00:00') - epoch(date_trunc('second', last))) / 86400) AS BIGINT) AS days,
  epoch(TIMESTAMP '2024-06-01 00:00:00') - epoch(date_trunc('second', last)) > 7 * 86400 * 1.5 AS overdue FROM (SELECT event_type, max(ts) AS last FROM events GROUP BY event_type))
UNION ALL SELECT '| source | days since change | cadence | overdue |', 0 UNION ALL SELECT '| --- | --- | --- | --- |', 1
""")
def stale_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The staleness table, a line for each source by name."""
    rows = [{"source": r["event_type"], "days": r["days"], "cadence_days": 7, "overdue": r["overdue"]} for r in cadence(spark, sf).collect()]  # a row for each source
    return spark.createDataFrame(list(enumerate(artifact.stale_table(rows).split("\n"))), "n long, line string")


@query("""
SELECT CAST(doc_id AS VARCHAR) AS id, nullif(trim(lang), '') AS lien, nullif(trim(lang), '') AS kept, 'x' || source AS class, 'x' || source AS kept_class FROM documents
""")
def record_mirrors(spark: SparkSession, sf: str) -> DataFrame:
    """Translatable fields keep their source text beside them."""
    rows = texts(t(spark, sf, "documents"), id="doc_id", lang="lang", c="concat('x', source)")
    source = Source(
        id="docs", label="Docs", country="US", language="es", encoding="utf8", primary="m", source_id="id", registration="id",
        mapping={"registration": Mapping(field="id"), "lien_status": Mapping(field="lang", transform="trim_or_null"), "airworthiness_class": Mapping(field="c")},
    )
    made = mapping.with_record(rows, source)
    return made.select("id", F.col("record.lien_status").alias("lien"), F.col("record.lien_status_source_text").alias("kept"), F.col("record.airworthiness_class").alias("class"), F.col("record.airworthiness_class_source_text").alias("kept_class"))

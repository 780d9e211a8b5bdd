"""Registered queries for the single transforms and for the rules that need conflicting rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Mapping, Merge
from .functions.text import staged
from .functions.transforms import ARRAY, SCALAR
from .operators import feed, localize, mapping
from .operators.resolve import resolve
from .queries import query, record_struct, spread, t, texts


def _applied(df: DataFrame, **made: tuple[str, str]) -> DataFrame:
    """The id and, for each name, a scalar transform of an expression."""
    cells = df.select("id", *[F.expr(e).alias(n) for n, (_, e) in made.items()])
    return staged(cells, {n: (SCALAR[f], F.col(n)) for n, (f, _) in made.items()})


@query("""
SELECT p_partkey AS id, trim(p_name) AS trimmed, p_name AS first_line,
  CASE WHEN p_size % 3 <> 0 THEN p_type END AS engine, CASE WHEN p_size % 4 <> 1 THEN p_name END AS detail,
  CASE WHEN p_size % 2 = 0 THEN 'not-type-certificated' END AS certification,
  CASE WHEN p_size % 5 = 0 THEN 'valid' ELSE 'cancelled' END AS status, trim(p_name) AS party, substr(p_type, 1, 1) AS class
FROM part
""")
def transform_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels, sentinels and first lines."""
    p = t(spark, sf, "part").withColumn("id", F.col("p_partkey"))
    return _applied(
        p,
        trimmed=("trim", "concat(' \t', p_name, ' \n')"),
        first_line=("first_line_or_null", "concat(p_name, ' \n', p_type)"),
        engine=("casa_engine_detail_or_null", "CASE WHEN p_size % 3 = 0 THEN ' NOT APPLICABLE ' ELSE p_type END"),
        detail=("es_aesa_detail_or_null", "CASE WHEN p_size % 4 = 1 THEN 'no   disponible' ELSE concat(' ', p_name) END"),
        certification=("br_build_certification", "CASE WHEN p_size % 2 = 0 THEN ' não certificada' ELSE p_type END"),
        status=("br_status", "CASE WHEN p_size % 5 = 0 THEN '  ' ELSE p_brand END"),
        party=("mv_idera_party", "concat('Letter No 7/', p_partkey, '\nNone\n\n(', p_brand, ')\n ', p_name, '\nother')"),
        **{"class": ("faa_cert_class", "concat(' ', p_type)")},
    )


@query("""
SELECT p_partkey AS id,
  CASE p_size % 5 WHEN 0 THEN 'ultralight helicopter (VTOL)' WHEN 1 THEN 'amateur-built airplane' WHEN 2 THEN 'balloon' WHEN 3 THEN 'gyroplane' END AS spanish,
  'PT-' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') AS brazilian, CASE WHEN p_size % 2 = 0 THEN 'CC-' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') END AS chilean,
  CASE p_size % 9 WHEN 0 THEN 'uav' WHEN 1 THEN 'rotorcraft' WHEN 2 THEN 'gyroplane' WHEN 3 THEN 'balloon' WHEN 4 THEN 'glider' WHEN 5 THEN 'fixed-wing-single-engine'
    WHEN 6 THEN 'fixed-wing-multi-engine' END AS class_code
FROM part
""")
def transform_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Coded classes and marks."""
    p = t(spark, sf, "part").withColumn("id", F.col("p_partkey"))
    tail = "lpad(string(p_partkey % 1000), 3, '0')"
    return _applied(
        p,
        spanish=("es_aesa_class_en", "element_at(array('ULM - HELICOPTERO ', 'afi-avion terrestre', 'GLOBO  libre', 'Autogiro', 'OTRO'), int(p_size % 5 + 1))"),
        brazilian=("br_registration", f"concat(' pt', {tail})"),
        chilean=("cl_registration", f"concat(CASE WHEN p_size % 2 = 0 THEN 'cc' ELSE 'cd' END, {tail})"),
        class_code=("br_airframe", "element_at(array('rpa', 'H1T', 'G0', 'B1', 'L0', 'a1p', 'S4J', 'X', 'LA'), int(p_size % 9 + 1))"),
    )


@query("""
SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS slashed, CASE WHEN o_orderkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS listed,
  strftime(o_orderdate, '%Y') AS serial, regexp_replace(CAST(o_totalprice AS VARCHAR), '\\.0$', '') AS price
FROM orders
""")
def transform_more_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Dates with slashes, in JSON arrays and as serial days; numbers as text."""
    o = t(spark, sf, "orders").withColumn("id", F.col("o_orderkey"))
    return _applied(
        o,
        slashed=("date_yyyy_slash_or_null", "date_format(o_orderdate, ' yyyy/MM/dd')"),
        listed=("foca_date_array_or_null", "concat('[', year(o_orderdate), ', ', CASE WHEN o_orderkey % 7 = 0 THEN 13 ELSE month(o_orderdate) END, ',', day(o_orderdate), ']')"),
        serial=("excel_serial_year_or_null", "string(datediff(o_orderdate, date'1899-12-30') + 0.5)"),
        price=("float_or_null", "concat(o_totalprice, ' ')"),
    )


@query("""
SELECT c_custkey AS id, c_name AS owner_name, CASE WHEN c_custkey % 2 = 0 THEN 'ZH' END AS owner_state, 'CH' AS owner_country, CASE WHEN c_custkey % 3 = 0 THEN 'co-owner' END AS owner_kind,
  CASE WHEN c_custkey % 4 <> 0 THEN 'Op ' || c_name END AS operator_name, CASE WHEN c_custkey % 4 <> 0 THEN 'BE' END AS operator_state,
  CASE WHEN c_custkey % 4 <> 0 THEN 'DE' END AS operator_country, CASE WHEN c_custkey % 4 <> 0 AND c_custkey % 5 = 0 THEN 'co-owner' END AS operator_kind
FROM customer
""")
def transform_holder_parties(spark: SparkSession, sf: str) -> DataFrame:
    """Owners and operators in a JSON array of holders with roles."""
    holder = "named_struct('ownerOperator', {}, 'holderCategory', named_struct('categoryNames', named_struct('en', '{}')), 'address', named_struct('extraLine', {}, 'country', '{}'))"
    part = lambda role: holder.format("'second'", f"Part {role}", "'TI'", "CH")
    owner = holder.format("concat(' ', c_name)", "Main Owner", "CASE WHEN c_custkey % 2 = 0 THEN 'ZH' ELSE 'Xy' END", "CH")
    operator = holder.format("concat('Op ', c_name)", "Main Operator", "'BE'", "DE")
    some = lambda x, condition: f"CASE WHEN {condition} THEN array({x}) ELSE array() END"
    operators = f"concat(array({operator}), {some(part('Operator'), 'c_custkey % 5 = 0')})"
    cell = f"to_json(concat({some(part('Owner'), 'c_custkey % 3 = 0')}, array({owner}), CASE WHEN c_custkey % 4 <> 0 THEN {operators} ELSE array() END))"
    c = spread(t(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey").select(F.col("c_custkey").alias("id"), F.expr(cell).alias("cell"))
    return _applied(c, **{f"{who}_{what}": (f"foca_{who}_{what}", "cell") for who in ("owner", "operator") for what in ("name", "state", "country", "kind")})


@query("""
SELECT s_suppkey AS id, lpad(lower(to_hex(s_suppkey)), 6, '0') AS hex, CASE WHEN s_suppkey % 3 = 0 THEN 'Contact' ELSE s_name END AS name,
  CASE WHEN s_suppkey % 3 = 0 THEN 'Sverige' ELSE 'Norge' END AS country,
  CASE WHEN s_suppkey % 3 = 0 THEN 'co-owner' WHEN s_suppkey % 2 = 0 THEN 'corporation' ELSE 'individual' END AS kind,
  'Normal|' || s_nationkey AS classes
FROM supplier
""")
def transform_contact_parties(spark: SparkSession, sf: str) -> DataFrame:
    """Contacts, addresses and classes in JSON arrays."""
    first = "named_struct('Navn', s_name, 'Land', 'Norge', 'Organisasjonsnummer', CASE WHEN s_suppkey % 2 = 0 THEN '9' ELSE '' END, 'Eier type', 'Eier')"
    second = "named_struct('Navn', 'Contact ', 'Land', 'Sverige', 'Organisasjonsnummer', '', 'Eier type', 'Eier/Kontakt')"
    s = t(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"),
        F.expr(f"to_json(CASE WHEN s_suppkey % 3 = 0 THEN array({first}, {second}) ELSE array({first}) END)").alias("owners"),
        F.expr("concat('[{\"Oktal\": \"1\"}, {\"Heksadesimal\": \"', hex(s_suppkey), '\"}]')").alias("addresses"),
    )
    classes = ARRAY["no_airworthiness_classes"](F.expr("concat('[\"Normal\", 7, \" \", \" ', nation, '\"]')"))
    out = s.select("*", classes.alias("classes"))
    made = _applied(out, hex=("no_hex_or_null", "addresses"), name=("no_owner_name", "owners"), country=("no_owner_country", "owners"), kind=("no_owner_kind", "owners"))
    return made.join(out.select("id", F.array_join("classes", "|").alias("classes")), "id")


@query("""
SELECT l_orderkey || '-' || l_linenumber AS id,
  CASE l_linenumber % 4 WHEN 0 THEN 'glider' WHEN 1 THEN 'rotorcraft' WHEN 2 THEN CASE WHEN floor(l_quantity) = 1 THEN 'fixed-wing-single-engine' ELSE 'fixed-wing-multi-engine' END END AS dutch,
  CASE l_linenumber % 4 WHEN 0 THEN 'glider' WHEN 1 THEN 'blimp' WHEN 2 THEN CASE WHEN floor(l_quantity) = 1 THEN 'fixed-wing-single-engine' ELSE 'fixed-wing-multi-engine' END END AS australian,
  CASE l_linenumber % 4 WHEN 0 THEN 'balloon' WHEN 1 THEN 'weight-shift' WHEN 2 THEN CASE WHEN floor(l_quantity) = 1 THEN 'fixed-wing-single-engine' ELSE 'fixed-wing-multi-engine' END END AS spanish,
  CASE WHEN l_returnflag = 'R' THEN 'corporation' ELSE 'unknown' END AS operator
FROM lineitem
""")
def map_compounds(spark: SparkSession, sf: str) -> DataFrame:
    """Compound transforms of several cells, mapped."""
    pick = lambda *xs: "element_at(array({}), int(l_linenumber % 4 + 1))".format(", ".join(f"'{x}'" for x in xs))
    rows = texts(
        t(spark, sf, "lineitem"), id="concat(l_orderkey, '-', l_linenumber)", n="floor(l_quantity)",
        dutch=pick("Sailplane", " Rotorcraft", "Large aeroplane", "Drones"), australian=pick("Motor-Glider", "Airship", "Power Driven Aeroplane", "Kite"),
        spanish=pick("Globo libre", "ULM - Pendular", "AFI - avion", "Otro"), firm="CASE WHEN l_returnflag = 'R' THEN 'Firm' ELSE ' ' END", number="l_suppkey",
    )
    made = {
        "dutch": Mapping(fields=("dutch", "n"), compound_transform="nl_ilt_airframe"),
        "australian": Mapping(fields=("australian", "n"), compound_transform="casa_airframe"),
        "spanish": Mapping(fields=("spanish", "n"), compound_transform="es_aesa_airframe"),
        "operator": Mapping(fields=("firm", "number"), compound_transform="no_operator_kind", default="unknown"),
    }
    return rows.select("id", *[mapping.scalar(m, rows.columns).value.alias(n) for n, m in made.items()])


_CONFLICTS = """
SELECT p_partkey AS k, p_partkey % 6 AS g, lpad(lower(to_hex(p_partkey)), 6, '0') AS hex, 'M' || p_partkey AS mark, p_name AS name, p_type AS kind FROM part
"""


@query(f"""
WITH p AS ({_CONFLICTS})
SELECT hex AS icao_hex, mark AS registration, mark AS registration_key, name AS model FROM p WHERE g = 0
UNION ALL SELECT hex, mark, mark, kind FROM p WHERE g = 1
UNION ALL SELECT NULL, mark, mark, name FROM p WHERE g = 2 UNION ALL SELECT NULL, mark || 'B', mark || 'B', kind FROM p WHERE g = 2
UNION ALL SELECT hex, mark, mark, name FROM p WHERE g = 4
UNION ALL SELECT hex, mark, NULL, name FROM p WHERE g = 5 UNION ALL SELECT NULL, mark || 'B', mark || 'B', kind FROM p WHERE g = 5
""")
def feed_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of rows that claim one address or mark.

    Parts stand for six cases: 0 alone; 1 one address, the newer row wins; 2 one address
    at one date, both rows fall back to their marks; 3 one mark, nobody has it; 4 a
    row without address is superseded by an address's winner of its mark; 5 rows
    fell back to the mark of a winner and differ, so the winner loses it.
    """
    p = t(spark, sf, "part").select(
        (F.col("p_partkey") % 6).alias("g"), F.lpad(F.lower(F.hex("p_partkey")), 6, "0").alias("hex"), F.concat(F.lit("M"), F.col("p_partkey")).alias("mark"),
        F.col("p_name").alias("name"), F.col("p_type").alias("kind"), F.concat(F.lit("f"), F.lpad(F.lower(F.hex("p_partkey")), 5, "0")).alias("other"),
    )
    row = lambda hex_, mark, model, date, n: f"named_struct('hex', {hex_}, 'mark', {mark}, 'model', {model}, 'date', '{date}', 'n', {n})"
    second, none = "concat(mark, 'B')", "string(null)"
    cases = {
        0: [row("hex", "mark", "name", "2020-01-01", 0), row("hex", "mark", "name", "2020-01-01", 1)],
        1: [row("hex", "mark", "name", "2020-01-01", 0), row("hex", "mark", "kind", "2021-01-01", 1)],
        2: [row("hex", "mark", "name", "2020-01-01", 0), row("hex", second, "kind", "2020-01-01", 1)],
        3: [row(none, "mark", "name", "2020-01-01", 0), row(none, "mark", "kind", "2020-01-01", 1)],
        4: [row("hex", "mark", "name", "2020-01-01", 0), row(none, "mark", "kind", "2022-01-01", 1)],
        5: [row("hex", "mark", "name", "2020-01-01", 0), row("other", "mark", "kind", "2020-01-01", 1), row("other", second, "kind", "2020-01-01", 2), row(none, "mark", "'x'", "2020-01-01", 3)],
    }
    rows = p.select("mark", F.expr("inline(CASE g " + " ".join(f"WHEN {g} THEN array({', '.join(x)})" for g, x in cases.items()) + " END)").alias("hex", "m", "model", "date", "n"))
    made = {
        "registration": F.col("m"), "icao_hex": F.col("hex"), "model": F.col("model"), "last_action_date": F.col("date"), "status": F.lit("valid"),
        "country": F.lit("US"), "source": F.lit("parts"), "source_id": F.concat_ws("-", "mark", "n"),
    }
    records = rows.select(F.struct("mark", "n").alias("_ord"), record_struct(made).alias("record"))
    return feed.feed_slice(records).select("icao_hex", "registration", "registration_key", "model")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS source_id,
  CASE o_orderkey % 5 WHEN 2 THEN 'A; B' ELSE 'A' END AS owner, CASE o_orderkey % 5 WHEN 2 THEN 'co-owner' END AS kind, CASE o_orderkey % 5 WHEN 3 THEN 'X' END AS serial,
  'm' AS model, CASE o_orderkey % 5 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 3 THEN 0 ELSE 0 END AS skipped, CASE o_orderkey % 5 WHEN 4 THEN 1 ELSE 0 END AS failed
FROM orders
""")
def duplicate_policies(spark: SparkSession, sf: str) -> DataFrame:
    """Equal rows, equal records, merged owners, a superset, and rows that nothing decides between."""
    o = t(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 5).alias("g"))
    copies = o.select("k", "g", F.explode(F.expr("sequence(0, CASE WHEN g = 0 THEN 2 ELSE 1 END)")).alias("n"))
    made = {
        "source": F.lit("orders"), "source_id": F.col("k").cast("string"), "registration": F.col("k").cast("string"), "country": F.lit("US"), "status": F.lit("valid"),
        "owner.name": F.when((F.col("g") == 2) & (F.col("n") == 1), "B").otherwise("A"), "serial_number": F.when((F.col("g") == 3) & (F.col("n") == 1), "X"),
        "model": F.when((F.col("g") == 4) & (F.col("n") == 1), "other").otherwise("m"),
    }
    raw = F.concat_ws("-", "k", F.when(F.col("g") == 0, F.lit(0)).otherwise(F.col("n")))
    rows = copies.select(F.col("k").cast("string").alias("source_id"), F.col("n").alias("_ord"), raw.alias("raw"), record_struct(made).alias("record"), F.lit(False).alias("bad"))
    done = resolve(rows, Merge(("owner.name",), "; ", {"owner.kind": "co-owner"}))
    return done.select(
        "source_id", F.col("record.owner.name").alias("owner"), F.col("record.owner.kind").alias("kind"), F.col("record.serial_number").alias("serial"),
        "record.model", "skipped", "failed",
    )


_TEXTS = "SELECT doc_id, source, CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'reason ' || doc_id % 50 END AS reason, lang FROM documents"


@query(f"""
SELECT DISTINCT sha256(field || chr(0) || text) AS hash, field, text FROM (
  SELECT 'cancellation_reason' AS field, reason AS text FROM ({_TEXTS}) UNION ALL SELECT 'lien_status', source FROM ({_TEXTS})
  UNION ALL SELECT 'operational_classes', unnest([lang, source]) FROM ({_TEXTS}))
WHERE trim(text) <> ''
""")
def translate_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """The distinct translatable texts of records, arrays among them."""
    return localize.candidates(_documents(spark, sf), excluded=("airworthiness_class",))


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    d = t(spark, sf, "documents")
    made = {
        "registration": F.col("doc_id").cast("string"), "lien_status": F.col("source"), "operational_classes": F.array("lang", "source"),
        "cancellation_reason": F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.concat(F.lit("reason "), F.col("doc_id") % 50)),
    }
    return d.select(F.col("doc_id").alias("_ord"), record_struct(made).alias("record"))


@query(f"""
SELECT doc_id AS id, CASE WHEN doc_id % 4 = 0 THEN '' ELSE upper(reason) END AS reason, source AS lien, upper(lang) || '|' || source AS classes FROM ({_TEXTS})
""")
def translate_records(spark: SparkSession, sf: str) -> DataFrame:
    """Texts rendered in batches by the tasks and put back into records, arrays too; some are not rendered."""
    records = _documents(spark, sf)
    found = localize.candidates(records).where("field <> 'lien_status' AND text NOT LIKE 'src%'")
    answers = localize.translate(found, lambda batch: [(h, text.upper()) for h, _, text in batch])
    done = localize.apply(records, answers.where("text IS NOT NULL").select("hash", "text"))
    return done.select(
        F.col("_ord").alias("id"), F.col("record.cancellation_reason").alias("reason"), F.col("record.lien_status").alias("lien"),
        F.array_join("record.operational_classes", "|").alias("classes"),
    )


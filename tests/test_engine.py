"""Sources to served feed: readers, joins, mapping, duplicates, guards, feed, enrichment."""

import json
import random
import zipfile
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from skyledger import config
from skyledger.config import ConfigError, Join, Merge
from skyledger.operators import artifact, feed, localize
from skyledger.operators.joins import GuardError, latest_snapshot, lookup_join, merged_build_side
from skyledger.operators.resolve import fold, resolve
from skyledger.plans.pipeline import Store, deploy_due, localized, mark_deployed, publish, refresh, safe_name
from skyledger.plans.translate import translate
from skyledger.schema import PATHS, RECORD
from skyledger.sources.delimited import read_delimited
from skyledger.sources.jsontext import read_json
from skyledger.sources.landing import discovered_url, land_zip, worth_retrying
from skyledger.sources.positioned import read_positioned
from skyledger.sources.tables import read_sheet

SPEC = {
    "id": "demo", "label": "Demo", "country": "US", "language": "en", "encoding": "utf8", "primary": "main", "delimiter": ",",
    "trim_all": True, "source_id": "ID", "registration": "MARK", "cadence_days": 7,
    "download": {"url": "https://example.org/x.zip", "entries": {"main": "m.csv", "type": "t.csv"}},
    "joins": [{"name": "type", "file": "type", "key": "CODE", "on": "TYPE"}],
    "mapping": {
        "registration": {"field": "MARK", "transform": "faa_n_number", "default": ""},
        "icao_hex": {"field": "HEX", "transform": "foca_hex_or_null"},
        "status": {"field": "STATUS", "transform": "trim_or_null", "lookup": {"V": "valid", "X": "cancelled", "R": "reserved"}, "default": "other"},
        "manufacturer": {"field": "type.MFR", "transform": "trim_or_null"},
        "model": {"field": "type.MODEL", "null_values": ["-"], "default": "unknown"},
        "engine.count": {"field": "ENGINES", "transform": "int_or_null"},
        "airframe_type": {"fields": ["GROUP", "ENGINES"], "compound_transform": "tc_airframe"},
        "operational_classes": {"field": "OPS", "array_transform": "faa_cert_ops"},
        "last_action_date": {"field": "DATE", "transform": "iso_date_only_or_null"},
        "lien_status": {"field": "LIEN", "transform": "trim_or_null"},
    },
}
MAIN = '''ID,MARK,HEX,STATUS,TYPE,ENGINES,GROUP,OPS,DATE,LIEN
1,1A,a00001,V,T1,1,Aeroplane,1AN,2020-01-01,free
2,2B,a00002,Z,T2,2,Aeroplane,,2020-01-02,"held, by ""B"""

3,3C,,,T9,,Glider,,,
4,4D,a00004,X,T1,1,Balloon,,2020-01-01,
4,4D,a00004,V,T1,1,Balloon,,2019-01-01,
1,1A,a00001,V,T1,1,Aeroplane,1AN,2020-01-01,free
'''
TYPE = "CODE,MFR,MODEL\nT1,ACME,Fox\nT2,Bolt,-\nT1,ACME,Fox\n,x,y\n"


def spec(**changes):
    return json.loads(json.dumps(SPEC)) | changes


def write(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding)
    return str(path)


@pytest.fixture
def files(tmp_path):
    return {"main": write(tmp_path / "m.csv", "﻿" + MAIN), "type": write(tmp_path / "t.csv", TYPE)}


def run(spark, source, files, **kw):
    from skyledger.sources.reader import read_joins, read_primary

    return translate(source, read_primary(spark, source, files), read_joins(spark, source, files), **kw)


def test_translate(spark, files):
    t = run(spark, config.parse(spec()), files)
    assert t.stats == {"total": 6, "ok": 4, "failed": 0, "skipped": 1, "duplicate_skipped": 1}
    rec = {r.source_id: r.record for r in t.records.collect()}
    one = rec["1"]
    assert (one.registration, one.icao_hex, one.status, one.manufacturer, one.model) == ("N1A", "a00001", "valid", "ACME", "Fox")
    assert one.engine["count"] == 1 and one.operational_classes == ["A", "N"] == one.operational_classes_source_text
    assert one.lien_status_source_text == "free" and one.country == "US" and one.source == "demo"
    assert (rec["2"].status, rec["2"].model, rec["2"].lien_status) == ("other", "unknown", 'held, by "B"')
    assert (rec["3"].status, rec["3"].icao_hex, rec["3"].manufacturer, rec["3"].airframe_type) == (None, None, None, "glider")
    assert rec["4"].status == "valid"  # the live row wins though older
    assert [tuple(r) for r in t.unmatched.collect()] == [("STATUS", "Z", 1)]


def test_failures_and_guards(spark, files, tmp_path):
    source = config.parse(spec(mapping=spec()["mapping"] | {"status": {"field": "STATUS", "lookup": {"V": "valid", "X": "cancelled"}}}))
    t = run(spark, source, files)
    assert t.stats["failed"] == 1 and t.stats["ok"] == 3
    assert any("unknown value" in m for r in t.failures.collect() for m in r.messages)
    count = spec(record_count={"pattern": "total (\\d+)"})
    assert run(spark, config.parse(count), files, published="total 4").stats["ok"] == 4
    with pytest.raises(GuardError, match="published"):
        run(spark, config.parse(count), files, published="total 5")
    files["type"] = write(tmp_path / "t2.csv", "CODE,MFR,MODEL\nT1,ACME,Fox\nT1,ACME,Owl\n")
    with pytest.raises(GuardError, match="differ"):
        run(spark, config.parse(spec()), files)
    files["type"] = write(tmp_path / "t3.csv", "CODE,MFR,MODEL\nZZ,ACME,Fox\n")
    with pytest.raises(GuardError, match="no row matched"):
        run(spark, config.parse(spec()), files)


def test_missing_keys(spark, tmp_path):
    s = spec(joins=[], download={"url": "https://e.org/a", "format": "file", "entries": {"main": "m"}}, mapping={"registration": {"field": "MARK"}})
    s["allowed_missing_source_id_rows"] = {"max": 1, "field": "MARK", "pattern": "^note"}
    path = write(tmp_path / "m.csv", "ID,MARK\n1,A\n,note 1\n,note 2\n,other\n")
    assert run(spark, config.parse(s), {"main": path}).stats == {"total": 4, "ok": 1, "failed": 2, "skipped": 1, "duplicate_skipped": 0}


def test_delimited(spark, tmp_path):
    p = write(tmp_path / "a.csv", 'A,B,\n"B"-X, y ,z\n1,"a ""q"", b",\n')
    rows = [tuple(r)[1:] for r in read_delimited(spark, p).orderBy("_ord").collect()]
    assert rows == [('"B"-X', " y "), ("1", 'a "q", b')]
    p = write(tmp_path / "b.csv", "banner;1;2\nx;é;3\nfooter\n", "latin-1")
    df = read_delimited(spark, p, ";", "latin1", ["P", "Q", "R"], skip_rows=1, allowed_ragged_rows=1)
    assert [tuple(r)[1:] for r in df.orderBy("_ord").collect()] == [("x", "é", "3"), ("footer", "", "")]
    with pytest.raises(GuardError, match="width"):
        read_delimited(spark, p, ";", "latin1", ["P", "Q", "R"], skip_rows=1)
    with pytest.raises(GuardError, match="pinned"):
        read_delimited(spark, p, ";", "latin1", ["P", "Q"], skip_rows=1, allowed_ragged_rows=9)
    with pytest.raises(GuardError, match="twice"):
        read_delimited(spark, write(tmp_path / "c.csv", "A,A\n1,2\n"))
    assert read_delimited(spark, write(tmp_path / "d.csv", "A,B\n")).count() == 0


def test_json(spark, tmp_path):
    doc = {"data": [{"a": 1, "b": {"c": "x", "d e": None}, "l": [2019, 3, {"k": None}]}, {"a": 2.5, "b": {"c": True}}]}
    p = write(tmp_path / "a.json", json.dumps(doc))
    rows = [r.asDict() for r in read_json(spark, p, "data").orderBy("_ord").collect()]
    assert (rows[0]["a"], rows[0]["b.c"], rows[0]["b.d e"]) == ("1", "x", "") and json.loads(rows[0]["l"]) == [2019, 3, {"k": None}]
    assert (rows[1]["a"], rows[1]["b.c"], rows[1]["l"]) == ("2.5", "true", "")
    for path in ("missing", "data.a"):
        with pytest.raises(GuardError, match="no array"):
            read_json(spark, p, path)
    with pytest.raises(GuardError, match="no object"):
        read_json(spark, write(tmp_path / "b.json", "[1]"))


def test_html_table(spark, tmp_path):
    page = "<table><tr><td>note</td></tr><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>x &amp; y<table><tr><td>in</td></tr></table></td></tr><tr><td> </td><td></td></tr></table><table><tr><td>Z</td></tr></table>"
    p = write(tmp_path / "a.html", page)
    rows = read_sheet(spark, p, "html", skip_rows=1).collect()
    assert [(r.A, r.B) for r in rows] == [("1", "x & yin")]
    assert read_sheet(spark, p, "html", sheet="Sheet2", columns=["Q"]).first().Q == "Z"
    with pytest.raises(GuardError, match="no sheet"):
        read_sheet(spark, p, "html", sheet=5)


def archive(path, parts):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return str(path)


def test_spreadsheets(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    x = archive(tmp_path / "a.xlsx", {
        "xl/workbook.xml": f'<workbook {ns} {rel}><sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="p"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/sharedStrings.xml": f"<sst {ns}><si><t>Banner</t></si><si><r><t>NA</t></r><r><t>ME</t></r></si></sst>",
        "xl/worksheets/sheet1.xml": f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c></row><row r="3"><c r="A3" t="s"><v>1</v></c><c r="C3" t="inlineStr"><is><t>N</t></is></c></row><row r="4"><c r="A4"><v>7</v></c><c r="C4" t="b"><v>1</v></c></row></sheetData></worksheet>',
    })
    assert [(r.NAME, r.N) for r in read_sheet(spark, x, "xlsx", "S", skip_rows=2).collect()] == [("7", "true")]
    o = 'xmlns:table="t" xmlns:text="x" xmlns:office="o"'
    cell = lambda t: f"<table:table-cell><text:p>{t}</text:p></table:table-cell>"
    s = archive(tmp_path / "a.ods", {
        "content.xml": f'<doc {o}><table:table table:name="T"><table:table-row>{cell("A")}{cell("B")}</table:table-row><table:table-row>{cell("x")}<table:table-cell office:value-type="float" office:value="2"/></table:table-row><table:table-row table:number-rows-repeated="1048574"><table:table-cell table:number-columns-repeated="9"/></table:table-row></table:table></doc>'
    })
    assert [(r.A, r.B) for r in read_sheet(spark, s, "ods").collect()] == [("x", "2")]


def test_positioned(spark):
    items = [(1, 10.0, 100.0, "N1"), (1, 50.0, 101.0, "Acme"), (1, 52.0, 99.0, "Corp"), (1, 10.0, 80.0, "N2"), (1, 49.0, 80.0, "Bolt"), (1, 10.0, 150.0, "title"), (1, 9.0, 70.0, "-"), (2, 1.0, 1.0, "legend"), (3, 1.0, 1.0, " ")]
    df = spark.createDataFrame(items, "page int, x double, y double, str string")
    read = lambda **kw: read_positioned(df, "x", [10.0, 50.0], ["MARK", "MAKER"], r"^N\d$", **kw)
    rows = sorted((r.MARK, r.MAKER) for r in read(allowed_anchorless_pages=1).collect())
    assert rows == [("N1", "Acme\nCorp"), ("N2\n-", "Bolt")]
    with pytest.raises(GuardError, match="without an anchor"):
        read()


def test_positioned_reads_items_once(spark):
    read = spark.sparkContext.accumulator(0)
    items = [(p, x, 20.0 * n + up, t) for p in range(20) for n in range(5) for x, up, t in ((10.0, 0.0, f"N{n}"), (50.0, 9.0, "b"), (50.0, 10.0, "a"), (50.0, 12.0, "up"))]
    items += [(1, 10.0, 0.0, "N9"), (2, 50.0, -11.0, "below"), (2, 50.0, -10.0, "edge"), (None, 10.0, 0.0, "N1"), (30, 10.0, 5.0, "legend")]

    def counted(row):
        read.add(1)
        return row

    df = spark.createDataFrame(spark.sparkContext.parallelize(items, 4).map(counted), "page int, x double, y double, str string")
    rows = {(r._ord.page, r._ord.row): (r.MARK, r.PARTS) for r in read_positioned(df, "x", [10.0, 50.0], ["MARK", "PARTS"], r"^N\d$", allowed_anchorless_pages=2).collect()}
    assert len(rows) == 100 and rows[0, 0] == ("N0", "a\nb") and rows[0, 1] == ("N1", "a\nb\nup") and rows[0, 4] == ("N4", "a\nb\nup")
    assert rows[2, 0] == ("N0", "a\nb\nedge")
    # Two anchors at one place: items go to the first, both take a number, and outer rows reach nowhere.
    assert rows[1, 0] == ("N0\nN9", "a\nb") and rows[1, 2] == ("N1", "a\nb\nup") and (1, 1) not in rows and rows[1, 5] == ("N4", "up")
    assert read.value == len(items)


def test_merged_side_and_snapshot(spark):
    rows = [("k", "B", "i", 1), ("k", "A", "i", 2), ("k", "B", "i", 3), ("k", "", "i", 4), ("m", "C", "i", 5), ("", "Z", "i", 6)]
    dim = spark.createDataFrame(rows, "key string, name string, kind string, _ord int")
    out = {r["key"]: (r["name"], r["kind"]) for r in merged_build_side(dim, "key", Merge(("name",), " Y ", {"kind": "co"})).collect()}
    assert out == {"k": ("B Y A", "co"), "m": ("C", "i")}
    left = spark.createDataFrame([("k",), ("zz",), ("",)], "on string")
    hit = lookup_join(left, dim, Join("d", "d", "key", "on", Merge(("name",))))
    assert sorted((r["on"], r["d.name"]) for r in hit.collect()) == [("", None), ("k", "B, A"), ("zz", None)]
    snap = spark.createDataFrame([("2020-01-01", 1), ("2020-02-01", 2), (None, 3)], "at string, v int")
    assert [r.v for r in latest_snapshot(snap, "at").collect()] == [2]
    assert latest_snapshot(snap.limit(0), "at").count() == 0
    with pytest.raises(GuardError):
        latest_snapshot(snap.where("v = 3"), "at")


def record(**kw):
    out = {}
    for p in PATHS:
        if "." in p:
            a, b = p.split(".")
            out.setdefault(a, {})[b] = kw.get(p.replace(".", "_"))
        else:
            out[p] = kw.get(p, [] if p.startswith("operational") else None)
    return out


def test_fold_rules():
    a, b = record(status="valid", last_action_date="2020-01-01"), record(status="cancelled", last_action_date="2021-01-01")
    rows = [("a", a, False, 1), ("b", b, False, 2), ("a", a, False, 3)]
    assert fold(rows, None) == (a, 5, 0)
    rich = record(model="x", serial_number="1")
    assert fold([("1", record(model="x"), False, 1), ("2", rich, False, 1)], None) == (rich, 0, 0)
    assert fold([("1", rich, False, 1), ("2", record(model="x"), False, 1)], None) == (rich, 1, 0)
    assert fold([("1", rich, False, 1), ("2", record(model="y"), False, 4)], None)[2] == 4
    policy = Merge(("operator.name",), " Y ", {"operator.kind": "co-owner"})
    x, y = record(operator_name="A"), record(operator_name="B")
    both, skipped, failed = fold([("1", x, False, 1), ("2", y, False, 1), ("3", x, False, 1)], policy)
    assert (both["operator"]["name"], both["operator"]["kind"], skipped, failed) == ("A Y B", "co-owner", 0, 0)
    z = record(operator_name="C", operator_kind="government")
    assert fold([("1", x, False, 1), ("2", z, False, 1)], policy) == (x, 0, 1)  # a stated kind is not stamped over
    assert fold([("1", x, True, 2)], None) == (None, 0, 2)


def test_resolve_equals_plain_fold(spark):
    r = random.Random(1)
    rows = []
    for i in range(200):
        rec = record(status=r.choice(["valid", "cancelled", None]), last_action_date=r.choice([None, "2020-01-01", "2021-01-01"]), model=r.choice(["a", "b", None]))
        rows.append((f"k{r.randint(0, 40)}", i, json.dumps(rec), r.random() < 0.1))
    df = spark.createDataFrame(rows, "source_id string, _ord int, json string, bad boolean")
    df = df.select("source_id", "_ord", F.md5(F.concat("json", F.col("bad").cast("string"))).alias("raw"), F.from_json("json", RECORD).alias("record"), "bad").repartition(3)
    got = {x.source_id: (x.record and x.record.status, x.record and x.record.model, x.skipped, x.failed) for x in resolve(df).collect()}
    want = {}
    for k in {x[0] for x in rows}:
        state, s, f = fold([(x[2] + str(x[3]), json.loads(x[2]), x[3], 1) for x in rows if x[0] == k], None)
        want[k] = (state and state["status"], state and state["model"], s, f)
    assert got == want


def feed_of(spark, rows):
    made = [(i, json.dumps(record(source="s", source_id=str(i), country="US", status=kw.pop("status", "valid"), **kw))) for i, kw in enumerate(rows)]
    df = spark.createDataFrame(made, "_ord int, json string").select("_ord", F.from_json("json", RECORD).alias("record"))
    return sorted((r.icao_hex or "", r.registration, r.registration_key or "", r.model or "") for r in feed.feed_slice(df).collect())


def test_feed_slice(spark):
    row = lambda reg, hex_=None, date=None, model=None, **kw: dict(registration=reg, icao_hex=hex_, last_action_date=date, model=model, **kw)
    assert feed_of(spark, [row("N-1", "aaaaaa", "2020-01-01", "old"), row("N-1", "aaaaaa", "2021-01-01", "new")]) == [("aaaaaa", "N-1", "N1", "new")]
    assert feed_of(spark, [row("N1", status="cancelled"), row("N2", status="reserved"), row("N3", status=None), row("--")]) == []
    same = [row("N1", "aaaaaa", model="m", home_base="x"), row("N1", "aaaaaa", model="m", home_base="y")]
    assert feed_of(spark, same) == [("aaaaaa", "N1", "N1", "m")]
    clash = [row("N1", "aaaaaa", model="m"), row("N2", "aaaaaa", model="n")]  # both fall back to their marks
    assert feed_of(spark, clash) == [("", "N1", "N1", "m"), ("", "N2", "N2", "n")]
    assert feed_of(spark, [row("N1", "aaaaaa", model="m"), row("N1", model="z")]) == [("aaaaaa", "N1", "N1", "m")]  # superseded
    both = clash + [row("N1", "bbbbbb", model="q")]  # N1 is claimed by a winner and by a fallback row
    assert feed_of(spark, both) == [("", "N1", "N1", "m"), ("", "N2", "N2", "n"), ("bbbbbb", "N1", "N1", "q")]
    torn = [row("N1", model="a"), row("N1", model="b"), row("N1", "cccccc")]
    assert feed_of(spark, torn) == [("cccccc", "N1", "N1", "")]


def test_consolidate_and_lookup(spark):
    rows = [("a1", "N1", "b"), ("a1", "N9", "a"), (None, "N2", "a"), (None, "N3", "a"), ("a2", "N3", "b"), (None, "N2", "b")]
    df = spark.createDataFrame(rows, "icao_hex string, registration_key string, source string").withColumn("registration", F.col("registration_key"))
    out = sorted(((r.icao_hex or ""), r.registration_key or "", r.source) for r in feed.consolidate(df).collect())
    assert out == [("a1", "N9", "a"), ("a2", "", "b")]
    assert feed.ambiguity_report(df)["sample"] == ["N2", "N3"]
    with pytest.raises(GuardError):
        feed.assert_unique(df, "registration_key")
    assert feed.request_keys([" A00001", "a00001"], "hex") == ["a00001"]
    for bad in (["xyz"], [1], [f"{i:06x}" for i in range(501)]):
        with pytest.raises(ValueError):
            feed.request_keys(bad, "hex")


def test_hash_ignores_order(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    h = lambda d: artifact.content_hash(d, F.col("id").cast("string"), F.col("v").cast("string")).first()[0]
    assert h(df) == h(df.orderBy(F.rand(1)).repartition(5)) != h(df.where("id > 0"))


def test_guards_state_and_dates(spark):
    for n, prior in ((0, None), (49, 100)):
        with pytest.raises(GuardError):
            artifact.guard_counts(n, prior)
    artifact.guard_counts(50, 100)
    now = datetime(2024, 1, 1, tzinfo=timezone.utc)
    s1 = artifact.next_state(None, "c", "u", 3, now)
    s2 = artifact.next_state(s1, "c2", "u", 3, now + timedelta(days=1))
    assert s2["last_content_change"] == s1["last_content_change"] != s2["last_run"]
    df = spark.sql("SELECT timestamp'2024-01-01' a, timestamp'2024-01-08' b, cast(null as timestamp) c")
    week = F.lit(7)
    r = df.select(artifact.due(F.col("a"), week, F.col("b")), artifact.due(F.col("c"), week, F.col("b")), artifact.overdue(F.col("a"), week, F.col("b")), artifact.days_since(F.col("c"), F.col("b"))).first()
    assert tuple(r) == (True, True, False, -1)


def test_localize(spark):
    recs = [record(lien_status="uno", operational_classes=["x", "y"]), record(lien_status="dos"), record(lien_status="uno")]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(recs)], "_ord int, json string").select("_ord", F.from_json("json", RECORD).alias("record"))
    found = localize.candidates(df)
    assert {r.text for r in found.collect()} == {"uno", "dos", "x", "y"}
    hashes = {r.text: r.hash for r in found.collect()}
    cache = spark.createDataFrame([(hashes["uno"], "one")], localize.CACHE)
    failures = spark.createDataFrame([(hashes["dos"], 3), (hashes["y"], 2)], localize.FAILURES)
    want = localize.delta(found, cache, failures)
    assert {r.text for r in want.collect()} == {"x", "y"}
    answers = lambda batch: [(h, "X") for h, f, t in batch if t == "x"] + [(h, "again") for h, f, t in batch] + [("other", "no")]
    doubled = {r.hash: (r.text, r.tried) for r in localize.translate(want, answers).collect()}
    assert doubled == {hashes["x"]: ("X", True), hashes["y"]: ("again", True)}
    some = localize.translate(want.coalesce(1), lambda batch: {h: "X" for h, f, t in batch if t == "x"} | {"other": "no"}).collect()
    came, tried = [(r.hash, r.text) for r in some if r.text], [r.hash for r in some if r.tried]
    assert came == [(hashes["x"], "X")] and set(tried) == {hashes["x"], hashes["y"]}
    none = localize.translate(want.coalesce(1), lambda batch: {batch[0][0]: " "}).collect()
    assert {(r.text, r.tried) for r in none} == {(None, False)}
    new = cache.unionByName(spark.createDataFrame(came, localize.CACHE))
    counts = localize.count_failures(failures, spark.createDataFrame([(h,) for h in tried], "hash string"), spark.createDataFrame(came, localize.CACHE))
    assert {r.hash: r.failures for r in counts.collect()} == {hashes["dos"]: 3, hashes["y"]: 3}
    out = {r._ord: r.record for r in localize.apply(df, new).collect()}
    assert out[0].lien_status == "one" and out[0].operational_classes == ["X", "y"] and out[1].lien_status == "dos" and out[1].operational_classes == []
    assert localize.stats(found, new, counts) == {"candidates": 4, "cache_hits": 2, "exhausted": 2}
    assert localize.prune(new, found.where("text = 'x'"), True).count() == 1 and localize.prune(new, found.limit(0), True).count() == 2


def test_refresh_and_publish(spark, files, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    source = config.parse(spec())
    now = datetime(2024, 1, 1, tzinfo=timezone.utc)
    assert refresh(spark, store, source, files, now=now)["status"] == "written"
    assert refresh(spark, store, source, files, now=now + timedelta(days=1)) == {"status": "not due"}
    es = config.parse(spec(id="demo2", language="es"))
    refresh(spark, store, es, files, render=lambda batch: {h: t.upper() for h, f, t in batch}, now=now)
    flat = store.read("aircraft/source=demo2")
    assert {r.lien_status for r in flat.collect()} == {"FREE", 'HELD, BY "B"', None} and len(flat.columns) == 55
    with pytest.raises(GuardError, match="no feed slice"):
        publish(spark, store, ["demo", "other"])
    report = {}
    served = publish(spark, store, ["demo2", "demo"], report)
    assert report["rows"] == 3 and report["ambiguous"]["keys"] == 0
    assert deploy_due(store)
    mark_deployed(store)
    assert not deploy_due(store)
    publish(spark, store, ["demo2", "demo"])
    assert not deploy_due(store)  # the same rows
    assert {(r.icao_hex, r.source) for r in served.collect()} == {("a00001", "demo"), ("a00002", "demo"), ("a00004", "demo")}
    answer = feed.lookup(store.read("feed"), ["A00001"], attributions={"demo": "From Demo"}).collect()
    assert [(r.key, r.type, r.attribution) for r in answer] == [("a00001", "ACME Fox", "From Demo")]
    assert feed.lookup(served, ["n1a"], "mark").first().registration == "N1A"


def test_cells_with_line_ends_and_web_latin(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'A,B\n1,"two\nlines, ""x"""\n\n2,plain\n3\n')
    rows = read_delimited(spark, path, quoted_line_ends=True, allowed_ragged_rows=1).orderBy("_ord").collect()
    assert [(r.A, r.B) for r in rows] == [("1", 'two\nlines, "x"'), ("2", "plain"), ("3", "")]
    with pytest.raises(GuardError, match="width"):
        read_delimited(spark, path, quoted_line_ends=True)
    pinned = read_delimited(spark, path, columns=["X", "Y"], skip_rows=1, quoted_line_ends=True, allowed_ragged_rows=1)
    assert [r.X for r in pinned.orderBy("_ord").collect()] == ["1", "2", "3"]
    web = write(tmp_path / "w.csv", "A,B\n5 €,Dvořák’s\n".replace("ř", "r"), "cp1252")
    for whole in (False, True):
        assert [(r.A, r.B) for r in read_delimited(spark, web, encoding="latin1", quoted_line_ends=whole).collect()] == [("5 €", "Dvorák’s")]


def test_store_keeps_the_last_whole_version(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    for n in (1, 2, 3):
        store.write(spark.range(n), "t")
    assert store.read("t").count() == 3 and sorted(p.name for p in (tmp_path / "s" / "t").iterdir()) == ["v=00000002", "v=00000003"]

    def broken(df, path):
        df.write.parquet(path)
        (tmp_path / "s" / "t" / path.rsplit("/", 1)[1] / "_SUCCESS").unlink()
        raise OSError("lost")

    with pytest.raises(OSError):
        store.write(spark.range(9), "t", broken)
    assert store.read("t").count() == 3
    store.write(store.read("t").union(spark.range(1)), "t")  # a table made from its own last version
    assert store.read("t").count() == 4 and len(list((tmp_path / "s" / "t").iterdir())) == 2
    dry = Store(spark, str(tmp_path / "s"), dry_run=True)
    dry.write(spark.range(9), "t")
    assert dry.read("t").count() == 4


def test_names_stay_in_the_store(spark, files, tmp_path):
    for bad in ("../x", "a/b", "", "..", ".hidden", "a..b"):
        with pytest.raises(GuardError, match="plain name"):
            safe_name(bad)
    with pytest.raises(ConfigError, match="plain name"):
        config.parse(spec(id="../up"))
    with pytest.raises(ConfigError, match="plain name"):
        config.parse(spec(download={"url": "https://e.org", "entries": {"main": "a", "type": "b", "../t": "c"}}))
    with pytest.raises(GuardError, match="plain name"):
        land_zip(archive(tmp_path / "b.zip", {"m.csv": "A"}), {"../m": "m.csv"}, tmp_path)


def test_slices_are_checked(spark, files, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    refresh(spark, store, config.parse(spec()), files)
    whole = store.read("feed_slice/source=demo")
    good = spark.createDataFrame(whole.collect(), whole.schema)
    store.write(good.drop("model"), "feed_slice/source=demo")
    with pytest.raises(GuardError, match="other columns"):
        publish(spark, store, ["demo"])
    store.write(good.withColumn("status", F.lit(None).cast("string")), "feed_slice/source=demo")
    with pytest.raises(GuardError, match="nulls"):
        publish(spark, store, ["demo"])
    store.write(good, "feed_slice/source=demo")
    store.put_state("demo", store.state("demo") | {"slice_version": 2})
    with pytest.raises(GuardError, match="version 2"):
        publish(spark, store, ["demo"])


def test_cache_versions_and_pruning(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    recs = [record(lien_status="uno"), record(lien_status="dos"), record(lien_status="uno")]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(recs)], "_ord int, json string").select("_ord", F.from_json("json", RECORD).alias("record"))
    upper = lambda batch: {h: t.upper() for h, f, t in batch if t != "dos"}
    done, first = localized(spark, store, df, upper, ())
    assert sorted(str(r.record.lien_status) for r in done.collect()) == ["UNO", "UNO", "dos"]
    assert (first["candidates"], first["translated"], first["untranslated"]) == (2, 1, 1)
    assert localized(spark, store, df, upper, ())[1]["cache_hits"] == 1
    store.write(store.read("translations").union(spark.createDataFrame([("unused", "x")], localize.CACHE)), "translations")
    localized(spark, store, df, upper, (), prune=True)
    assert store.read("translations").count() == 1
    store.put_state("translation-cache", {"version": 0})  # of an older version: made again
    assert localized(spark, store, df, upper, ())[1]["cache_hits"] == 0
    store.put_state("translation-cache", {"version": 99})
    with pytest.raises(GuardError, match="version 99"):
        localized(spark, store, df, upper, ())
    store.put_state("translation-cache", {"version": 1})
    for part in (tmp_path / "store" / "translations").rglob("part-*"):
        part.write_text("no table")
    same, report = localized(spark, store, df, upper, ())
    assert report["rendering"].startswith("left out") and same is df


def test_config_rules():
    with pytest.raises(ConfigError) as e:
        config.parse(spec(language="em", extra=1, mapping={"nope": {"field": "a"}, "model": {"field": "a", "constant": "b"}}))
    for part in ("ISO 639-1", "unknown key extra", "mapping.nope", "mapping.model"):
        assert part in str(e.value)
    bad = [
        {"download": {"url": "https://e.org", "entries": {"main": "a", "type": "a"}}},
        {"download": {"url": "https://e.org", "entries": {"main": "a"}, "prime_url": "https://f.org"}},
        {"columns": {"other": ["A"]}}, {"format": "pdf"}, {"record_count": {"pattern": "x"}}, {"source_id_transform": "nothing"},
        {"merge_duplicates": {"fields": ["model"], "set_on_merge": {"model": "x"}}},
        {"joins": [{"name": "type", "file": "type", "key": "CODE", "on": "TYPE", "merge_duplicates": {"fields": ["MFR"]}}]},
    ]
    for change in bad:
        with pytest.raises(ConfigError):
            config.parse(spec(**change))
    assert config.parse(spec()).mapping["model"].default == "unknown"


def test_landing(tmp_path):
    z = archive(tmp_path / "a.zip", {"m.csv": "A\n1\n"})
    assert open(land_zip(z, {"main": "m.csv"}, tmp_path / "out")["main"]).read() == "A\n1\n"
    with pytest.raises(GuardError, match="no entry"):
        land_zip(z, {"main": "x.csv"}, tmp_path)
    assert discovered_url('<a href="/f/x.zip">', "https://e.org/p/", 'href="([^"]+)"') == "https://e.org/f/x.zip"
    assert worth_retrying(503) and worth_retrying(429) and not worth_retrying(404)


def test_stream_keeps_newest(spark, tmp_path):
    from skyledger.streaming.refresh import keep_newest

    src = tmp_path / "in"
    for i, rows in enumerate([[(1, 1, "a"), (2, 1, "b")], [(1, 2, "c"), (1, 0, "z")]]):
        spark.createDataFrame(rows, "k int, at int, v string").coalesce(1).write.mode("append").parquet(str(src / f"p={i}"))
    stream = spark.readStream.schema("k int, at int, v string").option("maxFilesPerTrigger", 1).parquet(str(src / "*"))
    q = keep_newest(stream, "k", "at", str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(60)
    last = max((p.name for p in (tmp_path / "out").iterdir() if p.name.startswith("v=")), key=lambda s: int(s[2:]))
    assert sorted((r.k, r.v) for r in spark.read.parquet(str(tmp_path / "out" / last)).collect()) == [(1, "c"), (2, "b")]

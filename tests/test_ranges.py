"""Files cut into byte ranges of a few hundred bytes, against Python's own parsers."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import DataFrameReader

from skyledger.operators.joins import GuardError
from skyledger.sources.delimited import ends_open, read_delimited
from skyledger.sources.jsontext import cut_array, read_json

RANGE = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_ranges(spark):
    names = (RANGE, "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, "1200")
    yield
    for n, v in zip(names, before, strict=True):
        spark.conf.set(n, v)


def cells(r):
    return "".join(r.choice(["a", "é", '"', ",", "\n", "\r\n", " ", "x" * 40, "€"]) for _ in range(r.choice([0, 1, 5, 40])))


@pytest.mark.parametrize(("seed", "encoding"), [(1, "utf8"), (2, "latin1")])
def test_quoted_line_ends_in_ranges(spark, small_ranges, tmp_path, seed, encoding):
    r = random.Random(seed)
    rows = [[cells(r) or "e", cells(r), cells(r)] for _ in range(150)] + [["long", "line\n" * 400 + '"', "end"], ["last", "", "1"]]
    text = io.StringIO()
    w = csv.writer(text, lineterminator=r.choice(["\n", "\r\n"]))
    w.writerow(["A", "B\nb", "C"])
    w.writerows(rows)
    (tmp_path / "m.csv").write_bytes(text.getvalue().encode("utf-8" if encoding == "utf8" else "cp1252"))
    df = read_delimited(spark, str(tmp_path / "m.csv"), encoding=encoding, quoted_line_ends=True)
    assert df.columns == ["_ord", "A", "B\nb", "C"]
    got = [list(x)[1:] for x in df.orderBy("_ord").collect()]
    assert got == rows
    assert len({x[0].s for x in df.select("_ord").collect()}) > 5  # records begin in many ranges


def test_quotes_that_stay_open(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text('A,B\n1,"never\nclosed\n')
    with pytest.raises(GuardError, match="never closed"):
        read_delimited(spark, str(p), quoted_line_ends=True)
    p.write_text('A,B\n5" pipe,x\n\n \n"a"" b","c" d\n')  # quotes within plain cells open nothing
    rows = read_delimited(spark, str(p), quoted_line_ends=True).orderBy("_ord").collect()
    assert [(x.A, x.B) for x in rows][0] == ('5" pipe', "x") and rows[1].A == 'a" b' and len(rows) == 2
    p.write_text("")
    assert read_delimited(spark, str(p), quoted_line_ends=True).count() == 0


def test_ends_open():
    for line, quoted, want in [
        ('a,"b', False, True), ('a,"b""', False, True), ('a,"b"""', False, False), ('b",c', True, False), ('b",",c', True, True), ("", True, True),
        ('a"b,c', False, False), ('"a"b",c', False, False), ('﻿"x', False, True), ('""', False, False), ('""', True, True), ('"', True, False),
    ]:
        assert ends_open(line, ",", quoted) == want, line


def value(r, depth=0):
    kind = r.randint(0, 7 if depth < 3 else 4)
    if kind == 0:
        return r.choice([None, True, 1, 2.5, -3])
    if kind <= 4:
        return "".join(r.choice(['"', "\\", "{", "}", "[", "]", ",", ":", "a", "é", " ", "\n"]) for _ in range(r.randint(0, 12)))
    if kind == 5:
        return [value(r, depth + 1) for _ in range(r.randint(0, 4))]
    return {r.choice("abcd"): value(r, depth + 1) for _ in range(r.randint(0, 3))}


@pytest.mark.parametrize(("seed", "indent"), [(1, None), (2, 1)])
def test_json_arrays_in_ranges(spark, small_ranges, tmp_path, seed, indent):
    r = random.Random(seed)
    records = [{"i": i, "v": value(r), "data": value(r)} for i in range(120)] + [{}, {"i": 1, "v": "}" * 1500}, {"i": 2, "v": [1] * 700}]
    others = [value(r) for _ in range(30)]
    docs = {
        "": records, "data": {"head": others, "x": {"data": [{"no": 1}]}, "data": records, "tail": others},
        "a.b": {"b": others, "a": {"c": {"b": [{"no": 1}]}, "b": records, "d": others}, "e": {"b": [{"no": 2}]}},
    }
    for path, doc in docs.items():
        p = tmp_path / f"{path or 'root'}.json"
        p.write_text(json.dumps(doc, indent=indent, ensure_ascii=r.random() < 0.5))
        found = cut_array(spark, str(p), tuple(k for k in path.split(".") if k)).orderBy("_ord").collect()
        assert [json.loads(x.text) for x in found] == records
        assert len({x._ord.s for x in found}) > 5
        rows = read_json(spark, str(p), path).orderBy("_ord").collect()
        assert [x.i for x in rows] == [str(x["i"]) if "i" in x else "" for x in records]


def test_json_shape_from_one_record_of_each_kind(spark, tmp_path, monkeypatch):
    """Only one record of each kind passes through Python for the shape, and the shape is that of all records."""
    records = [{"a": i, "b": {"c": [i]}} if i % 3 else {"a": {"d": str(i)}, "b": {}, "e": None} for i in range(300)] + [{"b": {"c": None, "x y": 1}}]
    (tmp_path / "a.json").write_text(json.dumps(records))
    inferred, json_of = [], DataFrameReader.json

    def counted(self, rdd):
        inferred.append(rdd.count())
        return json_of(self, rdd)

    monkeypatch.setattr(DataFrameReader, "json", counted)
    rows = read_json(spark, str(tmp_path / "a.json")).orderBy("_ord")
    assert inferred == [3]
    assert rows.columns == ["_ord", "a", "b.c", "b.x y", "e"]
    rows = rows.collect()
    assert len(rows) == 301 and rows[1]["a"] == "1" and rows[1]["b.c"] == "[1]" and json.loads(rows[3]["a"]) == {"d": "3"} and rows[-1]["b.x y"] == "1"


def test_json_that_is_no_array_of_objects(spark, tmp_path):
    p = tmp_path / "a.json"
    for text, path, message in [
        ("[1]", "", "no object"), ('[{"a": 1}, 5, {"a": 2}]', "", "no object"), ('{"a": {"b": 1}}', "a", "no array"), ('{"a": 1}', "", "no array"),
        ('{"a": [{"b": 1}, [2]]}', "a", "no object"), ('[{"a": 1}, {"a": ', "", "cannot be read"), ("[[1]]", "", "no object"), ('[{"a": tru}]', "", "cannot be read"),
    ]:
        p.write_text(text)
        with pytest.raises(GuardError, match=message):
            read_json(spark, str(p), path)
    p.write_text(' ﻿[ ]\n')
    assert read_json(spark, str(p)).count() == 0
    p.write_text('{"n": {"a": "]"}, "a": [ ] , "b": [{"c": 1}]}')
    assert read_json(spark, str(p), "a").count() == 0 and read_json(spark, str(p), "b").first().c == "1"

"""Delimited text, split by Spark and parsed in the JVM, with strict width checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..cluster import written
from ..operators.joins import GuardError
from .ranges import CUT, HEAD, MIDDLE, TAIL, WHOLE, joined_records, over_ranges, pieces, states, with_states
from .shape import check_names, check_width, named

#: latin1 is windows-1252, as on the web: what differs from ISO-8859-1, which Spark splits, is translated.
ENCODINGS = {"utf8": "UTF-8", "latin1": "ISO-8859-1"}
_C1 = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
_FROM, _TO = bytes(_C1).decode("latin-1"), bytes(_C1).decode("cp1252")


def _decoded(c: Column, encoding: str) -> Column:
    return F.translate(c, _FROM, _TO) if encoding == "latin1" else c


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """(line, _ord): non-blank lines with their place; splits stay parallel.

    A place is file, start of the split and number within the partition, which orders
    lines as they stand in the file.
    """
    lines = (
        spark.read.schema("line string")
        .options(sep="\u0001", quote="", escape="", encoding=ENCODINGS[encoding], maxCharsPerColumn=-1)
        .csv(path)
    )
    place = F.struct(
        F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("s"), F.monotonically_increasing_id().alias("i")
    )
    return lines.select(_decoded(F.col("line"), encoding).alias("line"), place.alias("_ord")).where(F.col("line").isNotNull() & (F.trim("line") != ""))


def ends_open(line: str, delimiter: str, quoted: bool) -> bool:
    """Whether a line's end is inside quotes, given whether its begin is.

    Quotes open a cell at its begin only and double within; after the closing one the rest of the cell is plain text.
    """
    at = 1 if line.startswith("\ufeff") and not quoted else 0
    while True:
        if not quoted:
            if not line.startswith('"', at):
                at = line.find(delimiter, at)
                if at < 0:
                    return False
                at += len(delimiter)
                continue
            at += 1
        at = line.find('"', at)
        if at < 0:
            return True
        if line.startswith('"', at + 1):
            at, quoted = at + 2, True
            continue
        at, quoted = line.find(delimiter, at + 1), False
        if at < 0:
            return False
        at += len(delimiter)


def _records(spark: SparkSession, path: str, delimiter: str, encoding: str) -> DataFrame:
    """(line, _ord): records whose quoted cells may hold line ends; files are split as others are."""

    def effect(key, lines):
        ends = [False, True]
        for line in lines:
            if '"' in line:
                ends = [ends_open(line, delimiter, x) for x in ends]
        yield (*key, int(ends[0]), int(ends[1]))

    def cut(key, lines):
        file, start, before = key
        quoted, seq, held, kind = bool(before), 0, [], HEAD if before else WHOLE
        for line in lines:
            quoted = ends_open(line, delimiter, quoted) if '"' in line else quoted
            held.append(line)
            if not quoted:
                yield file, start, seq, kind, "\n".join(held)
                seq, held, kind = seq + 1, [], WHOLE
        if held:
            yield file, start, seq, MIDDLE if kind == HEAD else TAIL, "\n".join(held)

    lines = pieces(spark, path, "\n", ENCODINGS[encoding])
    known = written(states(over_ranges(lines, effect, "file string, start long, to0 int, to1 int")), "ranges")
    last = known.groupBy("file").agg(F.max_by("after", "start").alias("after")).where("after = 1").first()
    if last:
        raise GuardError(f"a quote of {last['file']} is never closed")
    # Written once, as the header, the width check and the rows are read from it.
    cuts = written(over_ranges(with_states(lines, known.select("file", "start", "before")), cut, CUT), "records")
    found = joined_records(cuts, "\n")
    text = _decoded(F.regexp_replace("text", "\\r$", ""), encoding)
    return found.select(text.alias("line"), "_ord").where(F.trim(F.regexp_replace("line", "^\ufeff", "")) != "")


def _options(delimiter: str) -> dict[str, str]:
    return {"sep": delimiter, "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "\u0000", "maxCharsPerColumn": "-1", "maxColumns": "20480"}


def read_delimited(
    spark: SparkSession,
    path: str,
    delimiter: str = ",",
    encoding: str = "utf8",
    columns: list[str] | None = None,
    skip_rows: int = 0,
    trim: bool = False,
    allowed_ragged_rows: int = 0,
    quoted_line_ends: bool = False,
) -> DataFrame:
    """Reads a file with a header, or with pinned columns, as text columns and ``_ord``.

    Blank lines do not count.  Quoted cells may hold delimiters and doubled quotes, and
    line ends only with ``quoted_line_ends``, for which each byte range is read twice (see ``ranges``);
    a stray quote stays.  Rows of another width than the header are kept
    (missing cells empty, extra ones dropped) but fail the read beyond their budget.
    """
    lines = _records(spark, path, delimiter, encoding) if quoted_line_ends else _lines(spark, path, encoding)
    first = lines.orderBy("_ord").limit(skip_rows + (0 if columns else 1)).collect() if skip_rows or not columns else []
    options = _options(delimiter) | ({"multiLine": "true"} if quoted_line_ends else {})

    def cells_of(line: str) -> list[str]:
        import csv

        return next(csv.reader(line.lstrip("﻿").splitlines(keepends=True), delimiter=delimiter), [])

    if columns:
        names = columns
        if skip_rows:
            check_width(cells_of(first[-1]["line"]) if first else None, columns)
    else:
        if not first or len(first) <= skip_rows:
            return spark.createDataFrame([], "_ord struct<f:string,s:bigint,i:bigint>")
        names = check_names(cells_of(first[-1]["line"]))
    body = lines
    if first:
        last = first[-1]["_ord"]
        body = lines.where(F.col("_ord") > F.struct(F.lit(last["f"]).alias("f"), F.lit(last["s"]).alias("s"), F.lit(last["i"]).alias("i")))
    width = len(names)
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)] + [T.StructField("_bad", T.StringType())])
    text = F.regexp_replace("line", "^﻿", "")
    parsed = body.withColumn("p", F.from_csv(text, schema.simpleString()[7:-1].replace(":", " "), options | {"columnNameOfCorruptRecord": "_bad"}))
    ragged = parsed.where(F.col("p._bad").isNotNull()).count()
    if ragged > allowed_ragged_rows:
        raise GuardError(f"{ragged} rows have another width than the header; {allowed_ragged_rows} allowed")
    return named(parsed, F.array(*[F.col(f"p.c{i}") for i in range(width)]), names, trim)

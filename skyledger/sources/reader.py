"""Picks the reader that a source's format names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import Source
from .delimited import read_delimited
from .jsontext import read_json
from .positioned import read_positioned
from .tables import READERS, read_sheet


def read_primary(spark: SparkSession, source: Source, files: dict[str, str]) -> DataFrame:
    """A source's main file as rows of text; positioned items come as Parquet of (page, x, y, str)."""
    path, columns = files[source.primary], source.columns.get(source.primary)
    if source.format == "csv":
        ragged = source.allowed_ragged_rows.get(source.primary, 0)
        return read_delimited(spark, path, source.delimiter, source.encoding, columns, source.skip_rows, source.trim_all, ragged, source.quoted_line_ends)
    if source.format == "json":
        return read_json(spark, path, source.record_path, source.trim_all)
    if source.format == "pdf":
        p = source.pdf or {}
        return read_positioned(
            spark.read.parquet(path), p["field_axis"], p["column_pos"], columns or [], p["anchor_pattern"], source.trim_all,
            p.get("allowed_anchorless_pages", 0),
        )
    if source.format not in READERS:
        raise NotImplementedError(f"format {source.format}: convert the file to xlsx or ods first")
    return read_sheet(spark, path, source.format, source.sheet, source.skip_rows, columns, source.trim_all, source.encoding)


def read_joins(spark: SparkSession, source: Source, files: dict[str, str]) -> dict[str, DataFrame]:
    """The side files, always delimited text."""
    return {
        j.file: read_delimited(
            spark, files[j.file], source.delimiter, source.encoding, source.columns.get(j.file), 0, source.trim_all,
            source.allowed_ragged_rows.get(j.file, 0), source.quoted_line_ends,
        )
        for j in source.joins
    }

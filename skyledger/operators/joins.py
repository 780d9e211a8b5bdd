"""Left lookup joins whose build side has one row for each key."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Join, Merge


class GuardError(RuntimeError):
    """A check of the data failed; nothing may be written."""


def safe_name(name: str) -> str:
    """``name`` if it can stand in a path as one plain part; else an error."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", name) or ".." in name:
        raise GuardError(f"{name!r} is no plain name")
    return name


def cell(df_columns: list[str], name: str) -> Column:
    """A cell's text; a missing column or value is empty."""
    return F.coalesce(F.col(f"`{name}`"), F.lit("")) if name in df_columns else F.lit("")


def _in_order(order: str, value: Column) -> Column:
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), value.alias("v"))))
    return F.array_distinct(F.filter(F.transform(pairs, lambda p: p["v"]), lambda s: s != ""))


def merged_build_side(dim: DataFrame, key: str, merge: Merge, order: str = "_ord") -> DataFrame:
    """One row a key: merged columns joined in order of first sight, stamps where parties differ.

    The values of one key are gathered together; a key has few parties.
    """
    relevant = F.struct(*[cell(dim.columns, c) for c in (*merge.fields, *merge.set_on_merge)])
    several = F.count_distinct(relevant) > 1
    out = []
    for c in dim.columns:
        if c in (key, order):
            continue
        first = F.min_by(F.col(f"`{c}`"), F.col(order))
        value = F.array_join(_in_order(order, cell(dim.columns, c)), merge.separator) if c in merge.fields else first
        if c in merge.set_on_merge:
            value = F.when(several, F.lit(merge.set_on_merge[c])).otherwise(value)
        out.append(value.alias(c))
    return dim.where(cell(dim.columns, key) != "").groupBy(F.col(f"`{key}`")).agg(*out)


def conflicting_keys(dim: DataFrame, key: str, order: str = "_ord") -> DataFrame:
    """Keys whose rows differ."""
    rest = F.struct(*[cell(dim.columns, c).alias(f"c{i}") for i, c in enumerate(dim.columns) if c not in (key, order)], F.lit(1))
    return (
        dim.where(cell(dim.columns, key) != "")
        .groupBy(F.col(f"`{key}`").alias("key"))
        .agg(F.min(rest).alias("lo"), F.max(rest).alias("hi"))
        .where("lo <> hi")
        .select("key")
    )


def lookup_join(rows: DataFrame, dim: DataFrame, join: Join, order: str = "_ord") -> DataFrame:
    """Adds ``<name>.<column>`` for every column of the build side; misses stay empty.

    Spark plans the join from the sides' sizes.  Rows always match by their own columns.
    A key's rows are taken to be equal or to be merged; ``assert_consistent`` tells.
    """
    if join.merge:
        side = merged_build_side(dim, join.key, join.merge, order)
    else:
        side = dim.where(cell(dim.columns, join.key) != "").drop(order).dropDuplicates([join.key])
    names = [F.col(f"`{c}`").alias(f"{join.name}.{c}") for c in side.columns]
    side = side.select(*names, F.lit(True).alias(f"_hit_{join.name}"))
    return rows.join(side, cell(rows.columns, join.on) == F.col(f"`{join.name}.{join.key}`"), "left")


def assert_consistent(dim: DataFrame, join: Join, order: str = "_ord") -> None:
    """The rows of one key of the build side must be equal, unless they are merged."""
    clash = None if join.merge else conflicting_keys(dim, join.key, order).first()
    if clash:
        raise GuardError(f"join {join.name}: rows of key {clash[0]} differ")


def assert_hits(rows: DataFrame, joins: tuple[Join, ...]) -> None:
    """Every join must match at least one row of a non-empty input."""
    if not joins:
        return
    counts = rows.agg(F.count(F.lit(1)).alias("n"), *[F.count(f"_hit_{j.name}").alias(j.name) for j in joins]).first()
    for j in joins:
        if counts["n"] and not counts[j.name]:
            raise GuardError(f"join {j.name}: no row matched")


def latest_snapshot(rows: DataFrame, column: str) -> DataFrame:
    """The rows of the newest publication by text order; an empty input is left as it is."""
    newest = rows.agg(F.max(cell(rows.columns, column)).alias("newest")).first()["newest"]
    if newest is None:
        return rows
    if newest == "":
        raise GuardError(f"{column} is blank in all rows")
    return rows.where(cell(rows.columns, column) == newest)

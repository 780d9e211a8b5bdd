"""Tables rebuilt from positioned text items, such as those of a PDF's pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..cluster import written
from ..functions.text import trim as trimmed
from ..operators.joins import GuardError


def nearest(items: DataFrame) -> DataFrame:
    """Items (page, at, anchor, ...) with ``row``, ``at_row``: which of their page's anchors is nearest, from 0 in order of place,
    and whether the item belongs to it; outside the outer anchors it does up to half the smallest gap between them.

    Both are null on a page without anchors, or without a number.  Of two anchors as near the lower one counts; of anchors at one place,
    the first.  Everything is windows by page: items are shuffled once, and no item meets the other anchors.
    """
    at = F.col("at")
    page = Window.partitionBy("page")
    in_order = page.orderBy("at", F.col("anchor").desc())
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = items.withColumns(
        {"_before": F.count(F.when(F.col("anchor"), 1)).over(earlier), "_prior": F.last(F.when(F.col("anchor"), at), ignorenulls=True).over(earlier)}
    )
    place = F.struct(at.alias("at"), F.col("_before").cast("int").alias("row"))
    is_place = F.col("anchor") & at.isNotNull() & (F.col("_prior").isNull() | (F.col("_prior") < at))
    found = found.withColumns({"_place": F.when(is_place, place), "_gap": F.when(F.col("anchor"), at - F.col("_prior"))})
    found = found.withColumns(
        {
            "_last": F.last("_place", ignorenulls=True).over(in_order.rowsBetween(Window.unboundedPreceding, 0)),
            "_reach": F.coalesce(F.min("_gap").over(whole) / 2, F.lit(float("inf"))),
            "_any": F.max("anchor").over(whole),
        }
    )
    # Going down from the end, the last place met is the next one above.
    downwards = page.orderBy(at.desc(), F.col("anchor").desc()).rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("_next", F.last("_place", ignorenulls=True).over(downwards))
    down, up = at - F.col("_last.at"), F.col("_next.at") - at
    lower = F.col("_last").isNotNull() & (F.col("_next").isNull() | (down <= up))
    row = F.when(lower, F.col("_last.row")).otherwise(F.col("_next.row"))
    within = F.when(F.col("_last").isNull(), at >= F.col("_next.at") - F.col("_reach"))
    within = F.coalesce(within.when(F.col("_next").isNull(), at <= F.col("_last.at") + F.col("_reach")).otherwise(at.isNotNull()), F.lit(False))
    known = F.col("page").isNotNull() & F.col("_any")
    added = {"row": F.when(known, row), "at_row": F.when(known, within)}
    return found.withColumns(added).drop("_before", "_prior", "_place", "_gap", "_last", "_reach", "_any", "_next")


def column_of(positions: list[float], at: Column) -> Column:
    """Index of the nearest of fixed positions, the lower one of a tie: how many midpoints between neighbours are below."""
    in_order = sorted(range(len(positions)), key=lambda i: (positions[i], i))
    out = F.lit(in_order[0])
    for a, b in zip(in_order, in_order[1:], strict=False):
        out = F.when(at - positions[a] > positions[b] - at, F.lit(b)).otherwise(out)
    return out


def read_positioned(
    items: DataFrame,
    field_axis: str,
    column_pos: list[float],
    columns: list[str],
    anchor_pattern: str,
    trim: bool = False,
    allowed_anchorless_pages: int = 0,
) -> DataFrame:
    """Rows of (page, x, y, str) items as text columns and ``_ord``.

    Every item that matches the anchor is a record; items go to the nearest anchor on
    the record axis and the nearest column on the field axis.  Outer records reach
    half the smallest gap between anchors.  A cell's items are its lines in reading
    order.  Pages with text but no anchor count against their budget.
    """
    across, along = ("y", "x") if field_axis == "y" else ("x", "y")
    text = items.where(trimmed(F.col("str")) != "")
    placed = text.select(
        "page", F.col(along).cast("double").alias("at"), F.col(across).cast("double").alias("across"), "str",
        trimmed(F.col("str")).rlike(anchor_pattern).alias("anchor"),
    )
    rows = nearest(placed).where(F.coalesce("at_row", F.lit(True)))
    line = F.struct(
        column_of(column_pos, F.col("across")).alias("col"),
        (F.col("at") if along == "x" else -F.col("at")).alias("place"),
        (trimmed(F.col("str")) if trim else F.col("str")).alias("line"),
    )
    # A page without an anchor is one row without a number, and without lines.
    rows = rows.groupBy("page", "row").agg(F.array_sort(F.collect_list(F.when(F.col("at_row"), line))).alias("lines"))
    named = [F.expr(f"array_join(transform(filter(lines, x -> x.col = {i}), x -> x.line), '\\n')").alias(f"_cell{i}") for i in range(len(columns))]
    # Written once, so that the checks do not read the items again.
    rows = written(rows.select("page", "row", *named), "positioned")
    lost_pages = [r[0] for r in rows.where(F.col("row").isNull()).select("page").orderBy("page").limit(allowed_anchorless_pages + 6).collect()]
    if len(lost_pages) > allowed_anchorless_pages:
        raise GuardError(f"pages without an anchor: {lost_pages}")
    rows = rows.where(F.col("row").isNotNull())
    if rows.isEmpty():
        raise GuardError("no row was found on any page")
    return rows.select(F.struct("page", "row").alias("_ord"), *[F.col(f"_cell{i}").alias(c) for i, c in enumerate(columns)])

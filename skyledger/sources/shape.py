"""From rows of cells to named text columns, with the layout checks all readers share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import trim as trimmed
from ..operators.joins import GuardError


def check_names(names: list[str]) -> list[str]:
    """Header names must differ; blank ones are columns left out."""
    names = [n.strip() for n in names]
    twice = {n for n in names if n and names.count(n) > 1}
    if twice:
        raise GuardError(f"header names occur twice: {sorted(twice)}")
    return names


def check_width(header: list[str] | None, columns: list[str]) -> None:
    """The header that pinned columns replace must have as many cells."""
    if header is not None and len(header) != len(columns):
        raise GuardError(f"{len(columns)} columns pinned, the discarded header has {len(header)}")


def named(rows: DataFrame, cells: Column, names: list[str], trim: bool) -> DataFrame:
    """(_ord, columns...) by position; a missing cell is empty, the last of equal names stands."""
    at = {n: i for i, n in enumerate(names) if n}

    def one(i: int) -> Column:
        c = F.coalesce(F.get(cells, F.lit(i)), F.lit(""))
        return trimmed(c) if trim else c

    return rows.select("_ord", *[one(i).alias(n) for n, i in at.items()])


def shape(rows: DataFrame, skip_rows: int = 0, columns: list[str] | None = None, trim: bool = False) -> DataFrame:
    """Named rows of (_ord, n, cells): ``n`` is the row's number in its sheet, from 0.

    The first ``skip_rows`` rows go; the next row with a non-empty cell is the header
    unless columns are pinned.  Rows with empty cells only go.
    """
    text = (lambda c: trimmed(c)) if trim else (lambda c: c)
    filled = F.exists("cells", lambda c: text(c) != "")
    if columns:
        if skip_rows:
            lost = rows.where((F.col("n") < skip_rows) & F.exists("cells", lambda c: trimmed(c) != "")).orderBy(F.col("n").desc()).first()
            check_width(lost["cells"] if lost else None, columns)
        body, names = rows.where((F.col("n") >= skip_rows) & filled), columns
    else:
        head = rows.where((F.col("n") >= skip_rows) & filled).orderBy("n").first()
        names = check_names(head["cells"]) if head else []
        body = rows.where((F.col("n") > (head["n"] if head else -1)) & filled)
    return named(body, F.col("cells"), names, trim)

"""Column expressions with the white space, number and date rules of the record mapping."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space that trimming removes; fixed values.
WHITE = " \t\n\x0b\x0c\r\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
WHITE_CLASS = f"[{WHITE}]"
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_RADIX = r"^0[xX][0-9a-fA-F]+$|^0[oO][0-7]+$|^0[bB][01]+$"
MAX_SAFE = 2**53 - 1


def bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with the value computed once, however often ``f`` uses it; its lambda is not compiled."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


class Steps:
    """A transform in steps, each of which may use the value before it several times.

    ``staged`` makes a column of every step's value, so that each is computed once and
    the plan stays in generated code; calling it gives one expression instead.
    """

    def __init__(self, *steps: Callable[[Column], Column]):
        self.steps = tuple(x for f in steps for x in (f.steps if isinstance(f, Steps) else (f,)))

    def __call__(self, v: Column) -> Column:
        for f in self.steps:
            v = bind(v, f)
        return v


def staged(df: DataFrame, made: dict[str, tuple[Callable[[Column], Column], Column]]) -> DataFrame:
    """Adds each named column, a transform of a column, in as many projections as the longest one has steps."""
    todo = {name: (list(f.steps) if isinstance(f, Steps) else [f], v) for name, (f, v) in made.items()}
    while todo:
        df = df.withColumns({name: fs[0](v) for name, (fs, v) in todo.items()})
        todo = {name: (fs[1:], F.col(f"`{name}`")) for name, (fs, _) in todo.items() if fs[1:]}
    return df


def null() -> Column:
    return F.lit(None).cast("string")


def trim(v: Column) -> Column:
    return F.btrim(v, F.lit(WHITE))


def or_null(v: Column) -> Column:
    """Null for the empty string."""
    return F.nullif(v, F.lit(""))


def trimmed(v: Column) -> Column:
    return or_null(trim(v))


def collapse(v: Column) -> Column:
    return trim(F.regexp_replace(v, f"{WHITE_CLASS}+", " "))


def _number(t: Column) -> Column:
    digits = F.substring(t, 3, 64)
    base = F.lower(F.substring(t, 2, 1))
    of = lambda b: F.conv(digits, b, 10).cast("double")
    radix = F.when(base == "x", of(16)).when(base == "o", of(8)).otherwise(of(2))
    return F.when(t.rlike(DECIMAL), t.try_cast("double")).when(t.rlike(_RADIX), radix)


def _finite(n: Column) -> Column:
    return F.when(F.abs(n) < float("inf"), n)


#: The finite number a whole cell states, in decimal or with a 0x, 0o or 0b radix; else null.
number = Steps(trim, _number, _finite)


def _shown(n: Column) -> Column:
    size = F.abs(n)
    decimal = lambda kind: F.regexp_replace(F.regexp_replace(n.cast(kind).cast("string"), r"0+$", ""), r"\.$", "")
    spelled = F.regexp_replace(F.regexp_replace(F.regexp_replace(n.cast("string"), r"\.0(?=E|$)", ""), r"E(?=[0-9])", "e+"), "E-", "e-")
    return (
        F.when((n == F.floor(n)) & (size < 1e18), n.try_cast("decimal(20,0)").cast("string"))
        .when((size >= 1e7) & (size < 1e18), decimal("decimal(38,12)"))
        .when((size < 1e-3) & (size >= 1e-6), decimal("decimal(38,20)"))
        .otherwise(spelled)
    )


#: A number as text: whole numbers without a fraction, others in the shortest decimal form.
shown = Steps(_shown)


def in_calendar(s: Column) -> Column:
    """A text of the form yyyy-mm-dd if the calendar has that day, else null."""
    return F.when((s.try_cast("date").cast("string") == s) & (F.substring(s, 1, 4) != "0000"), s)


def ymd(y: Column, m: Column, d: Column) -> Column:
    """The ISO date of text parts, to be checked by ``in_calendar``."""
    return F.concat_ws("-", y, m, d)


def date_like(pattern: str, y: tuple[int, int], m: tuple[int, int], d: tuple[int, int], first: Callable[[Column], Column] = trim) -> Steps:
    """The date in a cell that has ``pattern``; parts are (start, length)."""
    parts = lambda t: F.when(t.rlike(pattern), ymd(F.substring(t, *y), F.substring(t, *m), F.substring(t, *d)))
    return Steps(first, parts, in_calendar)


def leading_int(v: Column) -> Column:
    """The integer a cell starts with, else null."""
    return F.regexp_extract(trim(v), r"^([+-]?[0-9]{1,15})", 1).try_cast("long")


def registration_key(v: Column) -> Column:
    """The lookup key of a mark: upper case, letters and digits only."""
    return F.regexp_replace(F.upper(v), "[^A-Z0-9]", "")

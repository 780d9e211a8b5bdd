"""What a run leaves: flat typed tables, content hashes, guards, state and cadence."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RECORD
from .joins import GuardError

#: Versions, and the shares of the guards.
SCHEMA_VERSION = 12
MIN_RETAINED = 0.5
OVERDUE_FACTOR = 1.5


def flatten(records: DataFrame) -> DataFrame:
    """Records as flat columns; structs become prefixed columns, arrays JSON text."""
    out = []
    for f in RECORD.fields:
        c = F.col(f"record.{f.name}")
        if isinstance(f.dataType, T.StructType):
            out += [c[g.name].alias(f"{f.name}_{g.name}") for g in f.dataType.fields]
        elif isinstance(f.dataType, T.ArrayType):
            out.append(F.to_json(c).alias(f.name))
        else:
            out.append(c.alias(f.name))
    return records.select(*out)


def hashed_rows(df: DataFrame, key: Column, body: Column) -> DataFrame:
    """(h): the digest of each row's key and content."""
    return df.select(F.sha2(F.concat(F.coalesce(key, F.lit("")), F.char(F.lit(0)), body), 256).alias("h"))


def content_hash(df: DataFrame, key: Column, body: Column, salt: str = "") -> DataFrame:
    """One row with the digest of a set of rows, whatever their order.

    Row digests go to 4,096 buckets by their first three hex digits; the buckets'
    digests make the whole one.  So no task holds all rows.
    """
    rows = hashed_rows(df, key, body).groupBy(F.substring("h", 1, 3).alias("b")).agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list("h")), "\n"), 256).alias("d")
    )
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("b", "d"))), lambda x: F.concat(x["b"], F.lit(":"), x["d"]))
    return rows.agg(F.sha2(F.concat(F.lit(salt), F.array_join(ordered, "\n")), 256).alias("content_hash"))


#: Words of a set's digest, 64 bits each.
WORDS = 4
_WORD = 1 << 64


@dataclass(frozen=True)
class SetDigest:
    """The digest of a multiset of rows: their number, and the sums of their digests' words modulo 2^64.

    Sums do not depend on the order, so a set's digest is a plain aggregate, and the digest of a changed set
    follows from what came and what went: ``whole == base + came - went``.  It tells sets apart that differ by chance or
    by work; it is no defence against rows made to collide.
    """

    rows: int
    words: tuple[int, ...]

    def __add__(self, other: SetDigest) -> SetDigest:
        return SetDigest(self.rows + other.rows, tuple((a + b) % _WORD for a, b in zip(self.words, other.words, strict=True)))

    def __sub__(self, other: SetDigest) -> SetDigest:
        return SetDigest(self.rows - other.rows, tuple((a - b) % _WORD for a, b in zip(self.words, other.words, strict=True)))

    def text(self, salt: str = "") -> str:
        import hashlib

        return hashlib.sha256(f"{salt}{self.rows}:{'-'.join(map(str, self.words))}".encode()).hexdigest()

    @classmethod
    def parse(cls, kept: str) -> SetDigest:
        """From ``kept()``."""
        rows, _, words = kept.partition(":")
        return cls(int(rows), tuple(map(int, words.split("-"))))

    def kept(self) -> str:
        """As it stands in a state, to be added to later."""
        return f"{self.rows}:{'-'.join(map(str, self.words))}"


def digest_sums(df: DataFrame, key: Column, body: Column, *by: str) -> DataFrame:
    """(by..., rows, w0 ... w3): the digest of the rows, or of those of each group, as sums that combine before they shuffle.

    A digest's words are up to 2^64, and a decimal of 38 digits holds the sum of 5 * 10^18 of them.
    """
    digest = F.sha2(F.concat(F.coalesce(key, F.lit("")), F.char(F.lit(0)), body), 256)
    rows = df.select(*by, digest.alias("_h"))
    word = lambda i: F.conv(F.substring("_h", 16 * i + 1, 16), 16, 10).cast("decimal(20,0)")
    sums = [F.coalesce(F.sum(word(i).cast("decimal(38,0)")), F.lit(0)).alias(f"s{i}") for i in range(WORDS)]
    made = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *sums)
    modulus = F.lit(str(_WORD)).cast("decimal(20,0)")
    return made.select(*by, "rows", *[(F.col(f"s{i}") % modulus).cast("decimal(20,0)").alias(f"w{i}") for i in range(WORDS)])


def set_digest(df: DataFrame, key: Column, body: Column) -> SetDigest:
    """The digest of all rows; one row comes to the driver."""
    r = digest_sums(df, key, body).first()
    return SetDigest(r["rows"], tuple(int(r[f"w{i}"]) for i in range(WORDS)))


def record_digest(records: DataFrame) -> SetDigest:
    return set_digest(records, F.col("record.source_id"), F.to_json("record", {"ignoreNullFields": "false"}))


def record_hash(records: DataFrame, salt: str = "") -> str:
    return record_digest(records).text(salt)


def feed_digest(feed: DataFrame) -> SetDigest:
    """The digest of a feed's rows, whatever their order."""
    body = F.to_json(F.struct(*sorted(feed.columns)), {"ignoreNullFields": "false"})
    return set_digest(feed, F.coalesce("icao_hex", F.lit("")), body)


def feed_hash(feed: DataFrame) -> str:
    return feed_digest(feed).text()


def guard_counts(n: int, prior: int | None) -> None:
    """Refuses an empty result and one of less than half the rows before."""
    if n == 0:
        raise GuardError("no records")
    if prior and n / prior < MIN_RETAINED:
        raise GuardError(f"{n} records, {prior} before")


def guard_published(text: str, pattern: str, count: int) -> None:
    """The total that the register publishes must be the count."""
    import re

    m = re.search(pattern, text)
    if not m:
        raise GuardError("the published total was not found")
    total = int(re.sub(r"\D", "", m[1]) or -1)
    if total != count:
        raise GuardError(f"{count} records, {total} published")


#: Columns by which the tables are asked; fixed values.
TABLE_LOOKUPS = ("icao_hex", "registration", "status", "airframe_type", "owner_country")
FEED_LOOKUPS = ("icao_hex", "registration_key", "country")


def write_sorted(df: DataFrame, path: str, key: str, then: str, lookups: tuple[str, ...] = FEED_LOOKUPS, row_group_bytes: int = 8 << 20) -> None:
    """Writes a table for lookups: rows sorted by ``key``, rows without one spread by ``then``.

    A lookup by the key reads the row groups whose range holds it; one by another of ``lookups`` those whose bloom
    filter knows it.  Small row groups keep both short.
    """
    w = df.repartitionByRange(key, then).sortWithinPartitions(key, then).write.option("parquet.block.size", row_group_bytes)
    w = w.option("parquet.bloom.filter.adaptive.enabled", "true")
    for c in lookups:
        if c in df.columns:
            w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.parquet(path)


def any_of(column: str, keys: list[str]) -> Column:
    """Whether a column is one of the keys, as a balanced tree of equalities.

    Scans test each of them against ranges and bloom filters; of a long IN list they keep the least and greatest key only.
    """
    tests = [F.col(column) == k for k in keys] or [F.lit(False)]
    while len(tests) > 1:
        tests = [a | b for a, b in zip(tests[::2], tests[1::2], strict=False)] + tests[len(tests) - len(tests) % 2 :]
    return tests[0]


def write_table(flat: DataFrame, path: str, key: str = "source_id") -> None:
    """Writes a source's table for lookups; its keys are unique."""
    twice = flat.groupBy(key).count().where("count > 1").first()
    if twice:
        raise GuardError(f"{key} {twice[0]} occurs {twice['count']} times")
    write_sorted(flat, path, key, key, TABLE_LOOKUPS)


def due(last_run: Column, cadence_days: Column, now: Column) -> Column:
    """Whether a run is due: never run, or at least the cadence ago."""
    return last_run.isNull() | (F.unix_timestamp(now) - F.unix_timestamp(last_run) >= cadence_days * 86400)


def overdue(last_change: Column, cadence_days: Column, now: Column) -> Column:
    """Whether the content is older than one and a half cadences."""
    age = F.unix_timestamp(now) - F.unix_timestamp(last_change)
    return F.coalesce(age > cadence_days * 86400 * OVERDUE_FACTOR, F.lit(False))


def days_since(t: Column, now: Column) -> Column:
    """Whole days, -1 for unknown."""
    return F.coalesce(F.floor((F.unix_timestamp(now) - F.unix_timestamp(t)) / 86400), F.lit(-1)).cast("long")


def stale_table(rows: list[dict]) -> str:
    """A Markdown table of staleness entries by source."""
    lines = ["| source | days since change | cadence | overdue |", "| --- | --- | --- | --- |"]
    for r in sorted(rows, key=lambda r: r["source"]):
        lines.append(f"| {r['source']} | {r['days']} | {r['cadence_days']} | {'yes' if r['overdue'] else 'no'} |")
    return "\n".join(lines)


def next_state(prior: dict | None, content: str, upstream: str, n: int, now: datetime | None = None) -> dict:
    """The state after a run; the time of change moves only with the upstream content."""
    stamp = (now or datetime.now(timezone.utc)).isoformat()
    same = prior is not None and prior.get("upstream_hash") == upstream
    return {
        "last_run": stamp,
        "last_content_change": prior["last_content_change"] if same else stamp,
        "record_count": n,
        "content_hash": content,
        "upstream_hash": upstream,
        "schema_version": SCHEMA_VERSION,
    }

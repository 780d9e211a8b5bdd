"""Runs: refresh one source, publish the feed of all."""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cluster import hadoop_path, unwritten, written
from ..config import Source
from ..operators import localize
from ..operators.artifact import MIN_RETAINED, SCHEMA_VERSION, feed_hash, flatten, guard_counts, next_state, record_digest, write_sorted, write_table
from ..operators.feed import ambiguity_report, assert_unique, clear_ambiguous, feed_slice, first_by_hex
from ..operators.feed import lookup as feed_lookup
from ..operators.joins import GuardError, safe_name
from ..schema import FEED_SCHEMA
from ..sources.reader import read_joins, read_primary
from .translate import assert_clean, translate


SLICE_VERSION, CACHE_VERSION = 3, 1
#: Marks the commit of a log's batch; batches after which a log is written as one table.
BATCH, COMPACT_AFTER = "+", 16


class CommitConflict(GuardError):
    """Another run has written the table since this one read it."""


class Store:
    """Tables and small JSON states under one base path that Spark can write.

    A table is a folder of versions.  Every attempt at a version has a folder of its own, and the version is the attempt
    that its commit file names.  That file is created only if it is absent, so of several writers one wins and the
    others fail with CommitConflict, their attempts removed; readers see the whole old or the whole new version.
    A writer works upon the version that it has read first, or on the newest one if it has read none (``begun`` starts
    anew).  The version before stays for readers that are under way, older ones go with the next write;
    attempts at the next version, of whatever run, are left alone.
    """

    def __init__(self, spark: SparkSession, base: str, dry_run: bool = False):
        self.spark, self.base, self.dry_run = spark, base.rstrip("/"), dry_run
        self._seen: dict[str, int] = {}

    def begun(self) -> Store:
        """The same store for one run, which has read nothing yet."""
        return Store(self.spark, self.base, self.dry_run)

    def _file(self, name: str):
        return hadoop_path(self.spark, f"{self.base}/{name}")

    def _text(self, name: str) -> str:
        """A small file's text."""
        path, fs = self._file(name)
        stream = fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _create(self, name: str, text: str) -> bool:
        """Creates a small file unless there is one of that name."""
        path, fs = self._file(name)
        if fs.getScheme() == "file":  # a link is made or fails at once
            target = path.toUri().getPath()
            draft = f"{target}.{uuid.uuid4().hex}"
            with open(draft, "w") as f:
                f.write(text)
            try:
                os.link(draft, target)
            except FileExistsError:
                return False
            finally:
                os.unlink(draft)
            return True
        try:
            stream = fs.create(path, False)
        except Py4JJavaError as e:
            if "AlreadyExists" in str(e.java_exception):
                return False
            raise
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def _versions(self, name: str) -> list[tuple[int, str | None]]:
        """The versions of a table in order, each with the folder of its data if it is complete."""
        path, fs = self._file(name)
        if not fs.exists(path):
            return []
        found = [s.getPath().getName() for s in fs.listStatus(path)]
        out: list[tuple[int, str | None]] = []
        for v in sorted(int(n[2:]) for n in found if re.fullmatch("v=[0-9]{8}", n)):
            of, whole = f"{name}/v={v:08d}", None
            if fs.exists(self._file(f"{of}/_commit")[0]):
                whole = f"{of}/{self._text(f'{of}/_commit').removeprefix(BATCH)}"
            elif fs.exists(self._file(f"{of}/_SUCCESS")[0]):  # written before there were attempts
                whole = of
            out.append((v, whole))
        return out

    def path(self, name: str) -> str | None:
        """Where the newest complete version of a table is."""
        whole = [(v, of) for v, of in self._versions(name) if of]
        self._seen.setdefault(name, whole[-1][0] if whole else 0)
        return f"{self.base}/{whole[-1][1]}" if whole else None

    def has(self, name: str) -> bool:
        return self.path(name) is not None

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def _put(self, name: str, save: Callable[[str], None], batch: bool = False) -> None:
        if self.dry_run:
            return
        self.path(name)  # the version that counts, if none has been read
        number, attempt = self._seen[name] + 1, f"attempt-{uuid.uuid4().hex}"
        of = f"{name}/v={number:08d}"
        committed = False
        try:
            commit, fs = self._file(f"{of}/_commit")
            if not fs.exists(commit):
                save(f"{self.base}/{of}/{attempt}")
                committed = self._create(f"{of}/_commit", BATCH * batch + attempt)
        finally:
            if not committed:
                path, fs = self._file(f"{of}/{attempt}")
                fs.delete(path, True)
        if not committed:
            raise CommitConflict(f"{name} was written by another run; this one has read version {number - 1}")
        self._seen[name] = number
        if batch:
            return
        # The version before stays, and of a log the batches that it stands on.
        first = self._stack(name, number - 1)
        for v, _ in self._versions(name):
            if v < min([number - 1, *first]):
                path, fs = self._file(f"{name}/v={v:08d}")
                fs.delete(path, True)

    def _stack(self, name: str, last: int | None = None) -> list[int]:
        """The versions that make a log up to ``last``: a whole table, if there is one, and the batches since."""
        out: list[int] = []
        for v, of in reversed(self._versions(name)):
            if of is None or (last is not None and v > last):
                continue
            out.insert(0, v)
            commit, fs = self._file(f"{name}/v={v:08d}/_commit")
            if not fs.exists(commit) or not self._text(f"{name}/v={v:08d}/_commit").startswith(BATCH):
                break
        return out

    def append(self, df: DataFrame, name: str) -> bool:
        """Adds a batch of rows to a log; nothing is written without rows."""
        if self.dry_run or df.isEmpty():
            return False
        self._put(name, df.write.parquet, batch=True)
        return True

    def read_log(self, name: str, key: str) -> DataFrame | None:
        """The rows of a log, of each key those of the newest batch that has it."""
        folders = dict(self._versions(name))
        parts = [self.spark.read.parquet(f"{self.base}/{folders[v]}").withColumn("_v", F.lit(v)) for v in self._stack(name)]
        self.path(name)
        if not parts:
            return None
        every = parts[0]
        for more in parts[1:]:
            every = every.unionByName(more)
        if len(parts) == 1:
            return every.drop("_v")
        others = [c for c in every.columns if c not in (key, "_v")]
        newest = every.groupBy(key).agg(F.max_by(F.struct(*others), "_v").alias("r"))
        return newest.select(key, "r.*")

    def batches(self, name: str) -> int:
        """How many tables a reader of the log reads."""
        return len(self._stack(name))

    def kept(self, name: str) -> int:
        """How many complete versions of a table are kept."""
        return sum(of is not None for _, of in self._versions(name))

    def write(self, df: DataFrame, name: str, save: Callable[[DataFrame, str], None] | None = None) -> None:
        self._put(name, lambda path: save(df, path) if save else df.write.parquet(path))

    def state(self, source: str) -> dict | None:
        """A source's state; an unreadable one counts as none."""
        where = self.path(f"state/{safe_name(source)}")
        if where is None:
            return None
        try:
            return json.loads(self.spark.read.text(where).first()[0])
        except (TypeError, ValueError):
            return None

    def put_state(self, source: str, state: dict) -> None:
        one = self.spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1)
        self._put(f"state/{safe_name(source)}", one.write.text)


def due(source: Source, state: dict | None, now: datetime) -> bool:
    if state is None or source.cadence_days is None:
        return True
    try:
        last = datetime.fromisoformat(state["last_run"])
    except (KeyError, ValueError):
        return True
    return now - last >= timedelta(days=source.cadence_days)


def refresh(
    spark: SparkSession,
    store: Store,
    source: Source,
    files: dict[str, str],
    published: str | None = None,
    render: Callable | None = None,
    excluded: tuple[str, ...] = (),
    now: datetime | None = None,
) -> dict:
    """Translates a source and writes its table and feed slice; gives its stats.

    Nothing is written if a row fails, the result is empty or shrank by half.  The
    table is written only if its content changed; the state comes last.
    """
    now, store = now or datetime.now(timezone.utc), store.begun()
    slice_of, table_of = f"feed_slice/source={safe_name(source.id)}", f"aircraft/source={source.id}"
    state = store.state(source.id)
    if not due(source, state, now) and store.has(slice_of):
        return {"status": "not due"}
    done = translate(source, read_primary(spark, source, files), read_joins(spark, source, files), published)
    try:
        assert_clean(done)
        prior = state and state.get("record_count")
        guard_counts(done.stats["ok"], prior)
        digest = record_digest(done.records)
        upstream = digest.text()
        records, rendered = done.records, {}
        if render and source.language != "en":
            whole = bool(prior) and done.stats["ok"] / prior >= MIN_RETAINED
            records, rendered = localized(spark, store, records, render, excluded, prune=whole)
            digest = record_digest(records)
        content = digest.text(str(SCHEMA_VERSION))
        known = state is not None and state.get("content_hash") == content and state.get("schema_version") == SCHEMA_VERSION
        if not known or not store.has(table_of):
            store.write(flatten(records), table_of, write_table)
        store.write(feed_slice(records), slice_of)
        stamp = next_state(state, content, upstream, done.stats["ok"], now)
        store.put_state(source.id, stamp | {"slice_version": SLICE_VERSION, "content_digest": digest.kept()})
        return {"status": "written", **done.stats, **rendered}
    finally:
        done.release()


def _cache(spark: SparkSession, store: Store) -> tuple[DataFrame, DataFrame, bool]:
    """The renderings, the failure counts, and whether they begin anew: those of an older version are forgotten, a newer one is an error."""
    version = (store.state("translation-cache") or {}).get("version", 0)
    if version > CACHE_VERSION:
        raise GuardError(f"the cache has version {version}, {CACHE_VERSION} is known")
    old = version < CACHE_VERSION

    def read(name: str, schema: str) -> DataFrame:
        known = None if old else store.read_log(name, "hash")
        return spark.createDataFrame([], schema) if known is None else known

    return read("translations", localize.CACHE), read("translation_failures", localize.FAILURES).where("failures > 0"), old


def localized(
    spark: SparkSession, store: Store, records: DataFrame, render: Callable, excluded: tuple[str, ...], prune: bool = False
) -> tuple[DataFrame, dict]:
    """Renders what the cache lacks, adds it to the cache and applies the cache; gives counts too.

    The cache is a log: a run adds a batch of what is new, and without anything new writes nothing.  After
    COMPACT_AFTER batches, or where entries go, it is written as one table.  Without a readable cache nothing is rendered in this
    run.  Entries of other sources are kept; ``prune`` lets those go that no text of this store's slices needs.
    """
    try:
        cache, failures, anew = _cache(spark, store)
        cache.count(), failures.count()
    except GuardError:
        raise
    except (PySparkException, Py4JError, OSError) as e:  # storage and format errors
        return records, {"rendering": f"left out: {type(e).__name__}"}
    found = localize.candidates(records, excluded).persist()
    try:
        counted = localize.stats(found, cache, failures)
        wanted = counted["candidates"] - counted["cache_hits"] - counted["exhausted"]
        fresh = spark.createDataFrame([], localize.CACHE)
        if wanted:
            answers = localize.translate(localize.delta(found, cache, failures), render)
            if store.dry_run:
                answers = answers.persist()
            else:
                store.write(answers, "translation_answers")
                answers = store.read("translation_answers")
            fresh = answers.where("text IS NOT NULL").select("hash", "text")
            missed = localize.failure_changes(failures, answers.where("tried").select("hash"), fresh)
            for rows, name in ((fresh, "translations"), (missed, "translation_failures")):
                store.write(rows, name) if anew else store.append(rows, name)
        if anew:
            store.put_state("translation-cache", {"version": CACHE_VERSION})
        came = fresh.count()
        whole = cache.unionByName(fresh)
        kept = localize.prune(whole, found.select("hash"), prune)
        if kept is not whole:
            store.write(kept, "translations")
            whole = kept
        for name in ("translations", "translation_failures"):
            if not store.dry_run and store.batches(name) > COMPACT_AFTER:
                store.write(store.read_log(name, "hash"), name)
        return localize.apply(records, whole if store.dry_run else _cache(spark, store)[0], excluded), {
            **counted, "translated": came, "untranslated": wanted - came,
        }
    finally:
        found.unpersist()


def checked_slice(store: Store, source: str) -> DataFrame:
    """A source's slice, if it has the version and the columns of the feed and no nulls where there may be none."""
    name = f"feed_slice/source={safe_name(source)}"
    version = (store.state(source) or {}).get("slice_version")
    if version != SLICE_VERSION:
        raise GuardError(f"the slice of {source} has version {version}, {SLICE_VERSION} is needed")
    rows = store.read(name)
    shape = lambda t: [(f.name, f.dataType) for f in t.fields]
    if shape(rows.schema) != shape(FEED_SCHEMA):
        raise GuardError(f"the slice of {source} has other columns than the feed")
    needed = [f.name for f in FEED_SCHEMA.fields if not f.nullable]
    broken = rows.where(F.exists(F.array(*needed), lambda x: x.isNull())).first()
    if broken:
        raise GuardError(f"the slice of {source} has a row with nulls: {broken.asDict()}")
    return rows


def publish(spark: SparkSession, store: Store, sources: list[str], report: dict | None = None) -> DataFrame:
    """Merges all slices to the feed; a missing slice fails, as does one of another shape.

    Readers of the feed (``served``) see the old version until the new one is complete.
    ``report`` takes the counts of rows and of ambiguous keys, with samples.
    """
    store = store.begun()
    missing = missing_slices(store, sources)
    if missing:
        raise GuardError(f"no feed slice of {missing}")
    slices = [checked_slice(store, s) for s in sorted(sources)]
    every = slices[0]
    for s in slices[1:]:
        every = every.unionByName(s)
    merged = first_by_hex(every, "icao_hex", ["source", "registration"])
    merged = written(merged, "merged")  # in no executor's memory
    try:
        ambiguous = ambiguity_report(merged)
        feed = clear_ambiguous(merged)
        assert_unique(feed, "icao_hex")
        assert_unique(feed, "registration_key")
        store.write(feed, "feed", lambda df, path: write_sorted(df, path, "icao_hex", "registration_key"))
        out = feed if store.dry_run else store.read("feed")
        # The same rows in the order of their marks, for lookups by mark; rows without one cannot be asked for.
        by_mark = out.where(F.col("registration_key").isNotNull())
        store.write(by_mark, "feed_by_mark", lambda df, path: write_sorted(df, path, "registration_key", "icao_hex"))
        content = feed_hash(out)
        store.put_state("feed", {"content_hash": content})
        if report is not None:
            report |= {"rows": out.count(), "content_hash": content, "ambiguous": ambiguous}
        return out
    finally:
        if not store.dry_run:
            unwritten(merged)


def lookup(store: Store, keys: list[str], kind: str = "hex", attributions: dict[str, str] | None = None, fallback: str = "") -> DataFrame:
    """The served rows of up to 500 keys, from the copy of the feed that is sorted by such keys."""
    return feed_lookup(store.read("feed" if kind == "hex" else "feed_by_mark"), keys, kind, attributions, fallback)


def missing_slices(store: Store, sources: list[str]) -> list[str]:
    return [s for s in sources if not store.has(f"feed_slice/source={safe_name(s)}")]


def deploy_due(store: Store) -> bool:
    """Whether the published feed is another than the one marked as deployed."""
    content = (store.state("feed") or {}).get("content_hash")
    return content is not None and content != (store.state("deployed") or {}).get("content_hash")


def mark_deployed(store: Store) -> None:
    """Marks the published feed as deployed, once it is."""
    state = store.state("feed")
    if state is None:
        raise GuardError("no feed is published")
    store.put_state("deployed", {"content_hash": state["content_hash"]})

"""N-gram Jaccard join: rare-first prefix filter, length, position and suffix filters.

Documents are sets of word shingles.  Two documents link when ``100 * common >=
percent * union``.  A document's shingles are put in one global order, rare ones
first; linked documents share a shingle of their prefixes (the first ``n -
ceil(percent n / 100) + 1``).  Pairs that share one pass the length filter, the
positional filter and a suffix filter (shingles are dealt into 512 parts by hash; parts
whose counts differ in parity hold a shingle that is not common) and are verified
once, on their whole sets.

Any global order is right; rareness only keeps the lists short.  All shingles of all
documents are counted, in ``COUNT_BUCKETS`` buckets of their hashes, so the table that
is broadcast has one size whatever the corpus; a shingle's rank is its bucket's count,
then its hash.

Sets that are equal are one node, known by the number of one of its rows.  Lists travel
as (shingle, node, size, place).  In those of up to ``WHOLE`` members, nearly all, every
pair is compared; sketches for the suffix filter are fetched for distinct pairs.

A group of near copies is not expanded into all pairs: every longer list, whose members
have their sketches with them, first offers its members a few pivots; each member is verified
with one of them, then with the others that are not yet in its component, and at last members of a list whose components still differ are paired with each other.  So
every pair that passes the filters is either verified or already connected, and the
components are exact.

Keys with more than a thousandth of a join's rows (there are at most a thousand) are
split: their rows are dealt to several tasks, or stay where they are.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, discard, drop_materialized, hot_keys, join_keys, largest, materialize, materialized, parts_of, release, ship, small_batches, table, unused, with_value

#: Shingles are counted in this many buckets, by bits of their hash from this one on; a clash only changes the order.
COUNT_BUCKETS, COUNT_PART, COUNT_SHIFT = 1 << 20, 1 << 12, 24
_COUNTS = pa.schema([("part", pa.int32()), ("counts", pa.binary())])
SKETCH = [f"s{i}" for i in range(8)]
_KEPT_WORDS = 150_000
#: Lists of up to so many members are compared pair by pair.
WHOLE = 8
#: Members of a longer list, besides the earliest one, that the others are first compared with.
PIVOTS = 5
#: Shingles that a task keeps at most while it compares sets (16 MB).
KEPT_SHINGLES = 1 << 21
#: Documents that a common shingle is in at least; edges that one task of a round of components handles.
FEW, EDGES_A_TASK = 1000, 200_000
#: Edges up to which what is left of them is closed at once, in one task; the bound holds whatever the input.
FEW_EDGES = 1 << 15

_MIX = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93]
_words: dict[bytes, int] = {}


def _word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, kept by the worker for the words it has seen."""
    if len(_words) > _KEPT_WORDS:
        _words.clear()
    known = _words
    out = [known.get(w) for w in words]
    for i, h in enumerate(out):
        if h is None:
            w = words[i]
            out[i] = known[w] = xxhash.xxh3_64_intdigest(w)
    return np.array(out, dtype=np.uint64)


def shingles(text: str | None, size: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes.

    Words are runs of other than ASCII white space with A-Z lower-cased.  With fewer
    words than ``size`` the whole sequence is the only one; without words there is none.
    """
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.int64)
    w = _word_hashes(words)
    n = min(size, len(w))
    h = np.full(len(w) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        h = (h ^ w[k : len(w) - n + 1 + k]) * np.uint64(_MIX[k % len(_MIX)])
        h ^= h >> np.uint64(29)
    return np.unique(h.view(np.int64))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _key(toks: np.ndarray) -> bytes | None:
    return hashlib.blake2b(toks.tobytes(), digest_size=12).digest() if len(toks) else None


def _sketch(toks: np.ndarray) -> list[int]:
    parity = np.bincount((toks >> 13) & 511, minlength=512).astype(np.uint8) & 1
    return np.packbits(parity).view(np.int64).tolist()


def _pack(text: str | None) -> bytes | None:
    return None if text is None else zlib.compress(text.encode("utf-8", "replace"), 1)


def _unpack(packed: bytes | None) -> str | None:
    return None if packed is None else zlib.decompress(packed).decode("utf-8")


def _bucket(toks: np.ndarray) -> np.ndarray:
    return (toks >> COUNT_SHIFT) & (COUNT_BUCKETS - 1)


def shingle_counts(docs: DataFrame, text_col: str, size: int) -> np.ndarray:
    """How often documents hold shingles of each of COUNT_BUCKETS hash buckets, over all shingles of all documents.

    A task sends one table of counts, in parts, whatever its documents; a part is summed as it streams by.
    """
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)
    parts = COUNT_BUCKETS // COUNT_PART

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNT_BUCKETS, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                found = [shingles(t, size) for t in batch.slice(at, 512).column(0).to_pylist()]
                total += np.bincount(_bucket(np.concatenate(found)), minlength=COUNT_BUCKETS)
        for i in np.flatnonzero(total.reshape(parts, -1).any(axis=1)).tolist():
            yield pa.RecordBatch.from_pydict({"part": [i], "counts": [total[i * COUNT_PART : (i + 1) * COUNT_PART].tobytes()]}, _COUNTS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = None, None
        for batch in batches:
            for i, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if i != part:
                    if part is not None:
                        yield pa.RecordBatch.from_pydict({"part": [part], "counts": [total.tobytes()]}, _COUNTS)
                    part, total = i, np.zeros(COUNT_PART, dtype=np.int64)
                total += np.frombuffer(counts, dtype=np.int64)
        if part is not None:
            yield pa.RecordBatch.from_pydict({"part": [part], "counts": [total.tobytes()]}, _COUNTS)

    schema = "part int, counts binary"
    sums = docs.select(F.col(text_col).alias("body")).mapInArrow(tally, schema)
    sums = sums.repartition("part").sortWithinPartitions("part").mapInArrow(add, schema)
    out = np.zeros(COUNT_BUCKETS, dtype=np.int64)
    for r in sums.collect():  # COUNT_BUCKETS numbers
        out[r["part"] * COUNT_PART : (r["part"] + 1) * COUNT_PART] = np.frombuffer(r["counts"], dtype=np.int64)
    return out


def profiles(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int, counts: np.ndarray) -> DataFrame:
    """(doc_id, text_hash, set_key, n, s0 ... s7, prefix, cut, row) of every row; the key is null for an empty set.

    ``row`` numbers the rows; the numbers are fixed once the table is written.
    From place ``cut`` of the prefix on, the shingles' buckets hold many more than others do.
    """
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # COUNT_BUCKETS numbers
    many = 8 * int(counts.sum()) // COUNT_BUCKETS + FEW

    def make():
        def compute(texts):
            keys, sizes, sketches, prefixes, cuts = [], [], [], [], []
            for t in texts:
                s = shingles(t, size)
                keys.append(_key(s))
                sizes.append(len(s))
                sketches.append(_sketch(s))
                p = prefix_length(len(s), percent) if len(s) else 0
                held = shared.value[_bucket(s)]
                first = np.lexsort((s, held))[:p]
                prefixes.append(s[first])
                cuts.append(int((held[first] <= many).sum()))
            return [keys, sizes, *(list(x) for x in zip(*sketches, strict=True)), prefixes, cuts] if texts else [[] for _ in range(12)]

        return compute

    fields = [T.StructField("set_key", T.BinaryType()), T.StructField("n", T.IntegerType())]
    fields += [T.StructField(c, T.LongType()) for c in SKETCH] + [T.StructField("prefix", T.ArrayType(T.LongType())), T.StructField("cut", T.IntegerType())]
    source = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("body"))
    return add_columns(source, ["body"], fields, make, ("body",)).withColumn("row", F.monotonically_increasing_id())


def _unlike(a: str, b: str) -> str:
    """How many parts of the shingles' hashes differ in parity: at most the shingles that are not common."""
    return "(" + " + ".join(f"bit_count({a}.{s} ^ {b}.{s})" for s in SKETCH) + ")"


def _need(percent: int, a: str, b: str) -> str:
    """How many shingles a and b have in common at least if they link."""
    return f"ceil({percent}.0 * ({a}.n + {b}.n) / {100 + percent})"


def _in_reach(percent: int, a: str, b: str) -> str:
    """Length and positional filter for rows a and b of one list.

    The positional bound holds for the first shingle that a pair shares, and that one
    has its row as well.
    """
    return (
        f"100 * least({a}.n, {b}.n) >= {percent} * greatest({a}.n, {b}.n)"
        f" AND least({a}.n - {a}.pos, {b}.n - {b}.pos) >= {_need(percent, a, b)}"
    )


def _alike(percent: int, a: str, b: str) -> str:
    """Suffix filter for a and b."""
    return f"{_unlike(a, b)} <= {a}.n + {b}.n - 2 * {_need(percent, a, b)}"


def _passes(percent: int, a: str, b: str) -> str:
    return f"{_in_reach(percent, a, b)} AND {_alike(percent, a, b)}"


def salted_join(df: DataFrame, values: DataFrame, key: str, by: str, hot: dict) -> DataFrame:
    """``df`` joined with ``values`` on ``key``; a hot key's rows are dealt by a hash of ``by`` to its parts, which all get its values."""
    if not hot:
        return df.join(values, key)
    parts = F.broadcast(parts_of(df.sparkSession, hot, df, key))  # at most a thousand rows
    with_parts = lambda x: x.join(parts, F.col(key) == F.col("hot_key"), "left").withColumn("parts", F.coalesce("parts", F.lit(1))).drop("hot_key")
    left = with_parts(df).withColumn("salt", F.pmod(F.xxhash64(by), F.col("parts")).cast("int")).drop("parts")
    right = with_parts(values).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return left.join(right, [key, "salt"]).drop("salt")


class Sets:
    """The packed texts of the nodes that candidate pairs are made of, as a table (row, body).

    A text, compressed, is a third of its shingles' hashes or less; whoever compares two
    makes their shingles again.
    """

    def __init__(self, pairs: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, size: int, percent: int):
        self.size, self.percent = size, percent
        members = pairs.select(F.col("a").alias("row")).union(pairs.select(F.col("b").alias("row"))).distinct()
        keys = materialize(nodes.join(members, "row", "left_semi"), "wanted")
        texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("body"))
        texts = join_keys(texts, keys.select(F.col("doc_id").alias("_id")).distinct(), "_doc <=> _id", "left_semi")

        def make():
            def compute(bodies):
                return [[_key(shingles(t, size)) for t in bodies], [_pack(t) for t in bodies]]

            return compute

        fields = [T.StructField("set_key", T.BinaryType()), T.StructField("packed", T.BinaryType())]
        found = add_columns(texts.select("body"), ["body"], fields, make, ("body",)).join(keys.select("set_key", "row"), "set_key")
        self.table = materialize(found.dropDuplicates(["row"]).select("row", "packed"), "packed-texts")
        discard(keys)

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that link, checked on whole sets."""
        both = pairs.select("a", "b")
        for key, other, packed in (("a", "b", "ta"), ("b", "a", "tb")):
            copies = self.table.select(F.col("row").alias(key), F.col("packed").alias(packed))
            both = salted_join(both, copies, key, other, hot_keys(pairs, key))
        size, percent = self.size, self.percent

        def make():
            kept: dict[int, np.ndarray] = {}
            held = 0

            def of(row, packed):
                nonlocal held
                s = kept.get(row)
                if s is None:
                    s = shingles(_unpack(packed), size)
                    if held > KEPT_SHINGLES:
                        kept.clear()
                        held = 0
                    kept[row] = s
                    held += len(s)
                return s

            def compute(a, b, ta, tb):
                out = []
                for x, y, tx, ty in zip(a, b, ta, tb, strict=True):
                    x, y = of(x, tx), of(y, ty)
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    out.append(100 * common >= percent * (len(x) + len(y) - common))
                return [out]

            return compute

        found = add_columns(both, ["a", "b", "ta", "tb"], [T.StructField("links", T.BooleanType())], make, ("ta", "tb"))
        return materialize(found.where("links").select("a", "b"), "links-found")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of edges (a, b): every component has one of its nodes as root.

    Local contraction: in each round a node takes the neighbour, or itself, that comes
    first in the round's hash order, and nodes that took the same one become one.  In
    expectation the nodes of every component halve at least, so rounds grow with the
    logarithm of its size whatever its shape.  Every round is written to the shared folder.
    Each costs the driver a few jobs, however few edges are left, so the last
    FEW_EDGES, a bounded number, are closed in one step.
    """
    left = materialize(edges.where("a <> b").select("a", "b").distinct(), "edges")
    rounds: list[tuple[DataFrame, dict]] = []
    while (n := left.count()) > FEW_EDGES:
        tasks = -(-n // EDGES_A_TASK)  # the edges dwindle, and so do the tasks of a round
        near = left.selectExpr("inline(array(struct(a AS k, b AS other), struct(b AS k, a AS other), struct(a AS k, a AS other), struct(b AS k, b AS other)))")
        near = near.groupBy("k").agg(
            F.min_by("other", F.struct(F.xxhash64(F.lit(len(rounds)), "other"), "other")).alias("v"), F.count(F.lit(1)).alias("links")
        )
        labels = materialize(near.coalesce(tasks), "labels")
        hot = largest(labels.select("k", "links"))
        labels = labels.drop("links")
        rounds.append((labels, hot))
        at_a = with_value(left, "a", labels, hot).select("b", F.col("v").alias("x"))
        at_b = with_value(at_a, "b", labels, hot).select("x", F.col("v").alias("y"))
        ends = at_b.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        now = materialize(ends.distinct().coalesce(tasks), "edges")
        discard(left)
        left = now
    if n:
        rounds.append((materialize(_closed(left), "labels"), {}))
        discard(left)
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = rounds[-1][0]
    # Ever larger ones; nodes that were alone by then keep their label.  Only a node of many links is the label of many.
    for earlier, hot in reversed(rounds[:-1]):
        step = with_value(earlier.select(F.col("k").alias("node"), F.col("v").alias("mid")), "mid", roots, hot)
        roots = step.select(F.col("node").alias("k"), F.coalesce("v", "mid").alias("v"))
    return roots.toDF("node", "root")


def _closed(edges: DataFrame) -> DataFrame:
    """(k, v) for the nodes of at most FEW_EDGES edges, v being the component's smallest node."""

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict = {}

        def top(x):
            while above.setdefault(x, x) != x:
                above[x] = x = above[above[x]]
            return x

        kind = None
        for batch in batches:
            kind = batch.schema.field("a").type
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                a, b = sorted((top(a), top(b)))
                above[b] = a
        if above:
            nodes = list(above)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array([top(x) for x in nodes], kind)], ["k", "v"])

    kind = edges.schema["a"].dataType
    return edges.coalesce(1).mapInArrow(close, T.StructType([T.StructField("k", kind), T.StructField("v", kind)]))


def link_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """(doc_id, set_key, text_hash, n_shingles, component_id, stays) for every row of ``docs``.

    ``component_id`` is the smallest id reachable by links, the row's own included;
    ``stays`` marks the rows to keep of each component.
    Null and empty texts and texts without words have the empty set: they link with
    nothing, not with each other, and their key is null.  Rows without an id link by
    their text and take the component's smallest id, null if it has none.  Repeated
    rows and exact copies are one node.  Long texts are read whole.  An empty table
    gives an empty result.  Other columns play no part.
    """
    spark, before = docs.sparkSession, materialized()
    counts = shingle_counts(docs, text_col, size)
    made = materialize(profiles(docs, id_col, text_col, size, percent, counts), "profiles")
    rows = materialize(made.select("doc_id", "set_key", "text_hash", F.col("n").cast("long").alias("n_shingles")), "rows")
    some = made.where(F.col("set_key").isNotNull())
    nodes = materialize(some.groupBy("set_key").agg(F.min("doc_id").alias("doc_id"), F.min("row").alias("row")), "nodes")
    sketches = materialize(some.select("row", "n", *SKETCH), "sketches")
    lists = _lists(some, nodes)
    discard(made)
    release(spark)
    roots = _roots(lists, sketches, lambda pairs: Sets(pairs, nodes, docs, id_col, text_col, size, percent), percent)

    placed = nodes.join(roots.toDF("row", "root"), "row", "left").withColumn("root", F.coalesce("root", "row"))
    placed = materialize(placed, "placed")
    drop_materialized(spark, before, (rows._materialized, placed._materialized))  # what follows reads these only
    release(spark)
    smallest = placed.groupBy("root").agg(
        F.min("doc_id").alias("v_id"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "set_key")).alias("v_first"),
    )
    smallest = smallest.select(F.col("root").alias("k"), F.struct("v_id", "v_first").alias("v"))
    answer = with_value(placed.select("set_key", "root"), "root", smallest)
    answer = answer.select(F.col("set_key").alias("k"), "v")
    alone = F.col("set_key").isNull()
    first = F.col("v.v_first")
    return with_value(rows, "set_key", answer).select(
        "doc_id", "set_key", "text_hash", "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("v.v_id")).alias("component_id"),
        (alone | (first["set_key"] == F.col("set_key")) & first["doc_id"].eqNullSafe(F.col("doc_id"))).alias("stays"),
    )


def _lists(some: DataFrame, nodes: DataFrame) -> DataFrame:
    """(tok, members) of the prefixes' shingles that occur in several sets, a member being (row, n, pos).

    Lists of up to WHOLE members stand in one row each, longer ones in a row for each member.
    """
    copies = some.select("row").join(nodes.select("row"), "row", "left_anti")
    # Equal sets have equal columns, so one row stands for its key; the others are few or many, no list needs them.
    one = join_keys(some, copies.withColumnRenamed("row", "_copy"), "row = _copy", "left_anti")
    lists = one.select("row", "n", "cut", F.posexplode("prefix").alias("pos", "tok"))
    # A shingle is alone in its list or not; common ones, whose lists may be long, are taken without counting.
    counted = lists.where("pos < cut").drop("cut").withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("tok"))).where("m > 1")
    member = F.struct("row", "n", "pos")
    # Grouped where the counting has put them.
    counted = counted.groupBy("tok", F.when(F.col("m") > WHOLE, F.col("row")).alias("apart")).agg(F.collect_list(member).alias("members"))
    common = lists.where("pos >= cut").select("tok", F.array(member).alias("members"))
    return materialize(counted.select("tok", "members").unionByName(common), "postings")


def _roots(lists: DataFrame, sketches: DataFrame, sets_of, percent: int) -> DataFrame:
    """(row, root) of the nodes that link with others; drops the tables it reads after their last reader."""
    whole = lists.where(F.size("members") > 1).select(F.explode("members").alias("x"), "members").select("x", F.explode("members").alias("y"))
    whole = whole.where(F.expr(f"x.row < y.row AND {_in_reach(percent, 'x', 'y')}"))
    whole = whole.select(F.col("x.row").alias("a"), F.col("y.row").alias("b")).distinct()
    for key, side in (("a", "x"), ("b", "y")):
        whole = whole.join(sketches.select(F.col("row").alias(key), F.struct("n", *SKETCH).alias(side)), key)
    whole = whole.where(F.expr(_alike(percent, "x", "y"))).select("a", "b")
    postings = lists.where(F.size("members") == 1).select("tok", F.col("members")[0].alias("x")).select("tok", "x.row", "x.n", "x.pos")
    postings = materialize(postings.join(sketches.drop("n"), "row"), "long-postings")

    # A list's pivots: the member that has the shingle earliest in its order, as an original has fewer rare
    # shingles than its near copies, and some that a hash picks for each list anew.
    member = F.struct("pos", "n", "row", *SKETCH)
    picks = [F.min_by(member, F.xxhash64("tok", "row", F.lit(i))).alias(f"p{i}") for i in range(PIVOTS)]
    pivots = postings.groupBy("tok").agg(F.min(member).alias("p"), *picks)
    pivots = pivots.select(F.col("tok").alias("k"), F.array_distinct(F.array("p", *[f"p{i}" for i in range(PIVOTS)])).alias("v"))
    star = with_value(postings, "tok", pivots).withColumn("y", F.explode("v")).drop("v")
    star = star.select(F.struct(*[c for c in postings.columns if c != "tok"]).alias("x"), "y")
    star = star.where(F.expr(f"x.row <> y.row AND {_passes(percent, 'x', 'y')}"))
    pair = [F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")]
    star = star.select(F.col("x.row").alias("x"), F.col("y.row").alias("y")).select(*pair)
    tried = materialize(whole.unionByName(star).distinct(), "tried-pairs")
    discard(lists, sketches)
    release(tried.sparkSession)
    sets = sets_of(tried)
    first = sets.linked(tried)
    discard(sets.table)
    roots = materialize(components(first), "roots")
    release(tried.sparkSession)

    # Then the members of a long list whose components differ, with each other.
    of = roots.toDF("k", "v")
    open_lists = with_value(postings, "row", of).withColumn("root", F.coalesce("v", "row")).drop("v")
    mixed = open_lists.groupBy("tok").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("tok")
    open_lists = materialize(open_lists.join(mixed, "tok", "left_semi"), "open-postings")
    discard(postings)
    columns = [c for c in open_lists.columns if c != "tok"]
    x = open_lists.select("tok", F.col("row").alias("by"), F.struct(*columns).alias("x"))
    y = open_lists.select("tok", F.struct(*columns).alias("y"))
    rest = salted_join(x, y, "tok", "by", hot_keys(open_lists, "tok"))
    rest = rest.where(F.expr(f"x.root < y.root AND {_passes(percent, 'x', 'y')}"))
    rest = rest.select(F.col("x.row").alias("x"), F.col("y.row").alias("y")).select(*pair).distinct()
    rest = materialize(rest.join(tried, ["a", "b"], "left_anti"), "rest-pairs")
    discard(open_lists, tried)
    if not rest.isEmpty():
        sets = sets_of(rest)
        third = sets.linked(rest)
        discard(sets.table)
        roots = _joined(roots, third)
    discard(rest)
    return roots


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The roots once further links are there."""
    if links.isEmpty():
        return roots
    of = roots.toDF("k", "v")
    at_a = with_value(links, "a", of).withColumnRenamed("v", "ra")
    both = with_value(at_a, "b", of).select(F.coalesce("ra", "a").alias("a"), F.coalesce("v", "b").alias("b"))
    upper = components(both)
    known = roots.toDF("node", "mid").unionByName(
        upper.select("node", F.col("node").alias("mid")).join(roots.select("node"), "node", "left_anti")
    )
    return with_value(known, "mid", upper.toDF("k", "v")).select("node", F.coalesce("v", "mid").alias("root"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of linked documents, that of the smallest id.

    Rows with the empty set stay.  Of rows alike in id and text one stays.
    """
    linked = link_components(docs, id_col, text_col, size, percent)
    found = materialize(linked.select(F.col("doc_id").alias("i"), F.col("text_hash").alias("h"), "stays"), "kept")
    mine, gone_id, gone_hash = (unused(c, docs) for c in ("_hash", "_i", "_h"))
    key = [F.col("i").alias(gone_id), F.col("h").alias(gone_hash)]
    same = f"`{id_col}` <=> `{gone_id}` AND `{mine}` <=> `{gone_hash}`"
    rows = docs.withColumn(mine, F.xxhash64(text_col))
    rows = join_keys(rows, found.where(~F.col("stays")).select(*key).distinct(), same, "left_anti")
    twice = found.where("stays").groupBy(*key).count().where("count > 1").drop("count")
    if not twice.isEmpty():  # only rows that are there more than once are shuffled
        again = join_keys(rows, twice, same, "left_semi").dropDuplicates([id_col, mine])
        rows = join_keys(rows, twice, same, "left_anti").unionByName(again)
    return rows.select(*[f"`{c}`" for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return link_components(docs, size=4, percent=85).select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i : i + 3], ' ') FOR i IN generate_series(1, len(w) - 3)] END) AS s
  FROM words
), cells AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM cells a JOIN cells b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach(x, y) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.component_id
FROM sets s JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) r ON s.doc_id = r.x
"""

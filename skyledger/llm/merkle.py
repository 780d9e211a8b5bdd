"""Merkle manifest of a dataset: a log of nodes in postorder.

The records of a group are the leaves of a tree in the order of their ids; every
``FAN`` consecutive nodes (the last run: fewer, even one) have a parent, up to one
node, the group's subroot.  The subroots, in the order of their groups, are the leaves of one
more tree, whose top is the root.

Nodes are written in the order in which they are completed.  Builders are aligned: one
takes ``FAN ** LEVELS`` consecutive nodes and appends what stands above them, so builders
need nothing of each other, and each round of builders works on what the one before has
completed.  Where a node stands in its tree's log follows from the sizes of complete subtrees
alone (``position``), so a proof is a list of addresses: the siblings of a leaf, level by
level.  Proofs go down the same way, a block gets the proof of its top and addresses the
siblings below it in its own part of the log.

No task holds more than a block, and the driver holds the root and a few counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import discard, materialize, ship, small_batches, table

FAN = 3
#: Levels that one builder makes: a block has FAN ** LEVELS nodes at its bottom.
LEVELS = 6
#: The tree over all subroots; trees of groups begin with n (the null group) or s.
OVER_ALL = "*"

LOG = "tree string, count long, height int, at long, position long, digest string, top boolean"
PATH = "array<struct<before:string,after:string>>"


def sha256_of(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height_of(count: int) -> int:
    """Levels above ``count`` leaves, until one node remains."""
    height = 0
    while FAN**height < count:
        height += 1
    return height


def position(height: int, at: int, count: int) -> int:
    """Where the node ``at`` of a height stands in the postorder log of a tree of ``count`` leaves.

    It is completed with its last leaf; before leaf i stand i leaves, i // FAN complete
    parents, i // FAN ** 2 of the next level and so on, and after it its own completed ancestors.
    """
    below = min((at + 1) * FAN**height, count) - 1
    out = height
    while below:
        out += below
        below //= FAN
    return out


def append(digests: list[str], levels: int) -> Iterator[tuple[int, int, str]]:
    """(height, at, digest) of all nodes over a block's bottom nodes, these among them, as they are completed."""
    runs: list[list[str]] = [[] for _ in range(levels)]
    made = [0] * (levels + 1)
    for i, digest in enumerate(digests):
        height = 0
        while True:
            yield height, made[height], digest
            made[height] += 1
            if height == levels:
                break
            runs[height].append(digest)
            if len(runs[height]) < FAN and i < len(digests) - 1:
                break
            digest, runs[height] = sha256_of(runs[height]), []
            height += 1


def siblings(segment: dict[int, str], bottom: int, levels: int, at: int, count: int) -> list[dict[str, str]]:
    """Digests before and after a node in its run, for ``levels`` levels upwards from height ``bottom``."""
    out = []
    for height in range(bottom, bottom + levels):
        first = at // FAN * FAN
        run = range(first, min(first + FAN, -(-count // FAN**height)))
        have = {j: segment[position(height, j, count)] for j in run if j != at}
        out.append({"before": "".join(have[j] for j in run if j < at), "after": "".join(have[j] for j in run if j > at)})
        at //= FAN
    return out


def fold(leaf: str, path: list[dict[str, str]]) -> str:
    """The top that a leaf and its siblings lead to."""
    for step in path:
        leaf = sha256_of([step["before"], leaf, step["after"]])
    return leaf


def _encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def record_digest(*values: Column) -> Column:
    """SHA-256 of values, each as its UTF-8 byte count, a colon and itself, or ``-`` for null."""
    return F.sha2(F.concat(*[_encoded(v) for v in values]), 256)


def _tree(group: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), group.cast("string")), F.lit("n"))


def numbered(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """Adds ``at`` (a row's place in its tree, from 0) and ``count`` (the tree's rows).

    Rows are dealt to ranges of (tree, order), so one tree may fill many partitions; each range
    counts its own rows, and the counts of the ranges before it, a row a range and tree, give the offset.
    """
    dealt = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    dealt = materialize(dealt.withColumn("at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("at", 33)
    ranges = dealt.groupBy(part.alias("part"), F.col(tree).alias("of")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("of")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("part", "of", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("n").over(whole).alias("count"))
    out = dealt.join(ranges, (part == F.col("part")) & (F.col(tree) == F.col("of")))
    return out.select(*rows.columns, (F.col("at") - F.col("first") + F.col("offset")).alias("at"), "count")


def _by_block(rows: DataFrame, *then: str) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", *then)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 1024) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _in_python(df: DataFrame, run, schema: str) -> DataFrame:
    """Rows in, rows out, in the order of each partition."""
    arrow = to_arrow_schema(T._parse_datatype_string(schema))
    return df.mapInArrow(lambda batches: _batches(run(_rows(batches)), arrow), schema)


def _built(nodes: DataFrame, bottom: int, step: int) -> DataFrame:
    """The part of the log that one round of builders appends to nodes (tree, count, at, digest) of height ``bottom``."""
    blocks = _by_block(nodes.select("tree", F.expr(f"at div {FAN**step}").alias("block"), "count", "at", "digest"), "at")

    def run(rows):
        def built(key, count, digests):
            tree, block = key
            top = height_of(count)
            levels = min(step, top - bottom)
            for height, at, digest in append(digests, levels):
                if height or not bottom:  # the bottom nodes of later rounds are in the log already
                    at += block * FAN ** (step - height)
                    yield tree, count, bottom + height, at, position(bottom + height, at, count), digest, bottom + height == top

        key, size, digests = None, 0, []
        for tree, block, count, _, digest in rows:
            if (tree, block) != key:
                if digests:
                    yield from built(key, size, digests)
                key, size, digests = (tree, block), count, []
            digests.append(digest)
        if digests:
            yield from built(key, size, digests)

    return _in_python(blocks, run, LOG)


def _log(leaves: DataFrame, step: int) -> list[DataFrame]:
    """The logs of the trees over leaves (tree, count, at, digest): one written table for each round."""
    rounds = [materialize(_built(leaves, 0, step), "log-0")]
    most = leaves.agg(F.max("count")).first()[0] or 0
    while FAN ** (step * len(rounds)) < most:
        bottom = step * len(rounds)
        nodes = rounds[-1].where((F.col("height") == bottom) & ~F.col("top"))
        rounds.append(materialize(_built(nodes, bottom, step), f"log-{len(rounds)}"))
    return rounds


def _paths_down(rounds: list[DataFrame], tops: DataFrame, leaves: DataFrame, step: int, answer, schema: str) -> DataFrame:
    """Carries the paths of the trees' tops (tree, count, path, subroot) down to their leaves.

    ``answer(info, path, subroot)`` makes a row of the result for each of ``leaves`` (tree, at, info).
    """
    kind_of_info = leaves.schema["info"].dataType.simpleString()
    empty = {"count": "long", "position": "long", "digest": "string", "path": PATH, "subroot": "string", "info": kind_of_info}

    def rows_of(df: DataFrame, kind: int, *have: str) -> DataFrame:
        made = [F.col(c) if c in have else F.lit(None).cast(t).alias(c) for c, t in empty.items()]
        return df.select("tree", "block", F.lit(kind).alias("kind"), "at", *made)

    round_of = F.lit(0)
    for j in range(1, len(rounds)):
        round_of = round_of + (F.col("count") > FAN ** (step * j)).cast("int")
    tops = tops.select("tree", F.lit(0).cast("long").alias("at"), "count", "path", "subroot", round_of.alias("round"))
    given = None
    for r in reversed(range(len(rounds))):
        bottom = step * r
        heads = tops.where(F.col("round") == r).drop("round")
        heads = heads if given is None else heads.unionByName(given)
        log = rounds[r] if r == 0 else rounds[r].unionByName(rounds[r - 1].where(F.col("height") == bottom))
        span = F.expr(f"at div cast(power({FAN}, {bottom + step} - height) as bigint)")
        log = log.where((F.col("height") < bottom + step) & ~F.col("top")).withColumn("block", span)
        asked = leaves.withColumn("block", F.expr(f"at div {FAN**step}")) if r == 0 else log.where(F.col("height") == bottom)
        rows = rows_of(heads.withColumn("block", F.col("at")), 0, "count", "path", "subroot")
        rows = rows.unionByName(rows_of(log, 1, "position", "digest")).unionByName(rows_of(asked, 2, *(["info"] if r == 0 else [])))

        def run(rows, bottom=bottom, last=r == 0):
            for tree, _, kind, at, count, place, digest, path, subroot, info in rows:
                if kind == 0:  # a block begins
                    segment, size, upper, of = {}, count, path, subroot
                    levels = min(step, height_of(count) - bottom)
                elif kind == 1:
                    segment[place] = digest
                else:
                    whole = siblings(segment, bottom, levels, at, size) + upper
                    yield answer(info, whole, of) if last else (tree, at, size, whole, of)

        out = f"tree string, at long, count long, path {PATH}, subroot string"
        given = _in_python(_by_block(rows, "kind", "position", "at"), run, schema if r == 0 else out)
        if r:
            given = materialize(given, f"paths-{r}")
    return given


@dataclass
class Manifest:
    """The trees of a dataset.  ``log`` has every node (tree, count, height, at, position, digest, top)."""

    root: str | None
    leaves: DataFrame
    rounds: list[DataFrame]
    group_leaves: DataFrame
    group_rounds: list[DataFrame]
    levels: int = LEVELS

    @property
    def log(self) -> DataFrame:
        out = self.rounds[0]
        for more in [*self.rounds[1:], *self.group_rounds]:
            out = out.unionByName(more)
        return out

    def save(self, path: str) -> None:
        """Writes the log, one file or more for each range of (tree, position)."""
        self.log.repartitionByRange("tree", "position").sortWithinPartitions("tree", "position").write.parquet(path)


def build(records: DataFrame, id_col: str = "doc_id", group_col: str = "source", digest: Column | None = None, claim: Column | None = None, levels: int = LEVELS) -> Manifest:
    """The manifest of ``records``: a tree for each value of ``group_col``, its leaves in the order of ``id_col``.

    ``digest`` is a record's leaf (by default of doc_id, source, lang, n_chars and text), ``claim`` what is to be
    checked in its place, by default the same; a builder makes ``levels`` levels.  The null group is one of its own, before all others; groups go by the
    bytes of their names.  Null ids come first; rows with one id go by their leaves, so repeated rows are leaves of their own,
    one after the other.  An empty table has no root and no rows.
    """
    ship(records.sparkSession)
    small_batches(records.sparkSession)
    if digest is None:
        digest = record_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    made = records.select(_tree(F.col(group_col)).alias("tree"), F.col(id_col).alias("id"), digest.alias("digest"), (digest if claim is None else claim).alias("claim"))
    made = materialize(made, "leaves")
    leaves = materialize(numbered(made, "tree", "id", "digest", "claim"), "numbered-leaves")
    rounds = _log(leaves, levels)
    tops = rounds[0].where("top").select("tree", "count", "digest")
    for more in rounds[1:]:
        tops = tops.unionByName(more.where("top").select("tree", "count", "digest"))
    groups = tops.select(F.lit(OVER_ALL).alias("tree"), F.col("tree").alias("group"), F.col("count").alias("size"), "digest")
    group_leaves = materialize(numbered(groups, "tree", "group"), "numbered-groups")
    discard(made)
    group_rounds = _log(group_leaves, levels)
    root = group_rounds[-1].where("top").select("digest").first()
    return Manifest(root[0] if root else None, leaves, rounds, group_leaves, group_rounds, levels)


def prove(manifest: Manifest) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) for every leaf.

    ``proof_sha256`` is the digest of the leaf's siblings from its run up to the root's children, left to right;
    ``folded_root`` is what the leaf's claim and these siblings lead to, ``verified`` whether that is the root.
    """
    spark = manifest.leaves.sparkSession
    over = manifest.group_leaves.select("tree", "at", F.struct("group", "size", "digest").alias("info"))
    top = spark.createDataFrame([(OVER_ALL, manifest.group_leaves.count(), [], None)], f"tree string, count long, path {PATH}, subroot string")
    as_top = lambda info, path, _: (info["group"], info["size"], path, info["digest"])
    tops = _paths_down(manifest.group_rounds, top, over, manifest.levels, as_top, f"tree string, count long, path {PATH}, subroot string")
    tops = materialize(tops, "group-paths")
    id_type, root = manifest.leaves.schema["id"].dataType.simpleString(), manifest.root

    def answer(info, path, subroot):
        folded = fold(info["claim"], path)
        proof = sha256_of([step[side] for step in path for side in ("before", "after")])
        return info["id"], info["digest"], subroot, root, proof, folded, folded == root

    leaves = manifest.leaves.select("tree", "at", F.struct("id", "digest", "claim").alias("info"))
    schema = f"id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _paths_down(manifest.rounds, tops, leaves, manifest.levels, answer, schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    whole = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampers = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    text = F.when(tampers, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return prove(build(docs, claim=record_digest(*whole, text))).withColumnRenamed("id", "doc_id")


SQL = r"""
WITH RECURSIVE base AS (
  SELECT row_number() OVER () AS r, doc_id, source, text,
    CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS tree,
    concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-'),
      coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
      coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-')) AS head,
    list_reduce([CAST(4294967295 AS BIGINT)] || [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')],
      lambda c, b: list_reduce([xor(c, b)] || [CAST(i AS BIGINT) FOR i IN range(8)],
        lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) & 1 AS low_bit
  FROM documents
), made AS (
  SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN low_bit = 1
      THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-'))
      ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS claim
  FROM base
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, claim) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
  FROM made
), lv AS (
  SELECT tree, 0 AS h, pos, leaf AS d, n FROM leaves
  UNION ALL
  SELECT tree, h + 1, pos // 3, sha256(string_agg(d, '' ORDER BY pos)), (n + 2) // 3 FROM lv WHERE n > 1 GROUP BY tree, h, pos // 3, n
), subroots AS (
  SELECT tree, d AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM lv WHERE n = 1
), up AS (
  SELECT 0 AS h, pos, subroot AS d, n FROM subroots
  UNION ALL
  SELECT h + 1, pos // 3, sha256(string_agg(d, '' ORDER BY pos)), (n + 2) // 3 FROM up WHERE n > 1 GROUP BY h, pos // 3, n
), walk AS (
  SELECT tree, pos AS leaf_at, 0 AS h, pos, n FROM leaves
  UNION ALL
  SELECT tree, leaf_at, h + 1, pos // 3, (n + 2) // 3 FROM walk WHERE n > 1
), rise AS (
  SELECT tree, 0 AS h, pos, n FROM subroots
  UNION ALL
  SELECT tree, h + 1, pos // 3, (n + 2) // 3 FROM rise WHERE n > 1
), steps AS (
  SELECT w.tree, w.leaf_at, w.h, coalesce(string_agg(s.d, '' ORDER BY s.pos) FILTER (s.pos < w.pos), '') AS b,
    coalesce(string_agg(s.d, '' ORDER BY s.pos) FILTER (s.pos > w.pos), '') AS a
  FROM walk w JOIN lv s ON s.tree = w.tree AND s.h = w.h AND s.pos // 3 = w.pos // 3 WHERE w.n > 1 GROUP BY ALL
), over_all AS (
  SELECT r.tree, r.h + 1000 AS h, coalesce(string_agg(s.d, '' ORDER BY s.pos) FILTER (s.pos < r.pos), '') AS b,
    coalesce(string_agg(s.d, '' ORDER BY s.pos) FILTER (s.pos > r.pos), '') AS a
  FROM rise r JOIN up s ON s.h = r.h AND s.pos // 3 = r.pos // 3 WHERE r.n > 1 GROUP BY ALL
), both_ways AS (
  SELECT * FROM steps UNION ALL SELECT o.tree, l.pos, o.h, o.b, o.a FROM over_all o JOIN leaves l ON l.tree = o.tree
), paths AS (
  SELECT tree, leaf_at, string_agg(b || a, '' ORDER BY h) AS proof, list(b || ',' || a ORDER BY h) AS path FROM both_ways GROUP BY ALL
), found AS (
  SELECT l.doc_id, l.leaf, s.subroot, (SELECT d FROM up WHERE n = 1) AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
    list_reduce([l.claim] || coalesce(p.path, []), lambda d, s: sha256(split_part(s, ',', 1) || d || split_part(s, ',', 2))) AS folded_root
  FROM leaves l JOIN subroots s ON s.tree = l.tree LEFT JOIN paths p ON p.tree = l.tree AND p.leaf_at = l.pos
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM found
"""

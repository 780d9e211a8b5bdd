"""Exact top-k search by inner product, norm-bucketed.

Vectors are grouped by length (a bucket spans a fixed ratio of norms; full buckets
are dealt into blocks by a hash).  Queries first meet the longest vectors; the k-th score
found there bounds the lengths that can still matter, and queries in blocks of like
bounds then meet the blocks of long enough buckets only.  Within a block the vectors are taken longest first in small local buckets; a query's k-th score so
far, divided by its own length and the bucket's longest length, is its local cosine
threshold.  Above 1 the bucket is pruned for the query.  A high threshold prunes by
coordinates, a lower one by length; what is left is verified by exact products.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, ship, table

#: From this local cosine threshold on, coordinates prune better than lengths.
COORDINATE_FROM = 0.85
FOCUS = 4
#: Bytes of a block's doubles, of queries or of vectors; rows of the longest vectors met first, at most one block; bucket of zero vectors.
BLOCK_BYTES, HEAD_ROWS, NO_LENGTH = 32 << 20, 16384, -9999


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, dim, norm, v): components floor(scale * x) of every usable vector.

    Null vectors and vectors with a null, NaN or infinite component are left out.
    """
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    v = F.transform(x, lambda c: F.floor(c * scale).cast("double"))
    return (
        df.where(F.col(vector_col).isNotNull() & ~bad)
        .select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
        .select(
            "vec_id",
            F.size("v").alias("dim"),
            F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)).alias("norm"),
            "v",
        )
    )


def _products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles where every sum fits in 53 bits, else in Python integers."""
    top = (np.abs(q).max(initial=0.0)) * (np.abs(p).max(initial=0.0)) * max(1, q.shape[1])
    if top < 2.0**53:
        return (q @ p.T).astype(np.int64)
    big = q.astype(np.float64).astype(object)
    return np.vectorize(int, otypes=[object])(big) @ np.vectorize(int, otypes=[object])(p.astype(object)).T


def _candidates(q: np.ndarray, q_norm: float, p_unit: np.ndarray, cos: float) -> np.ndarray:
    """Rows of a local bucket whose focus coordinates allow a cosine of at least ``cos``.

    For unit vectors with product >= cos, coordinate f is at least
    q_f cos - sqrt((1 - q_f^2)(1 - cos^2)) for positive q_f, and the mirror image for negative.
    """
    u = q / q_norm
    keep = np.ones(len(p_unit), dtype=bool)
    for f in np.argsort(-np.abs(u))[:FOCUS]:
        reach = math.sqrt(max(0.0, (1 - u[f] ** 2) * (1 - cos * cos))) + 1e-9
        x = p_unit[:, f]
        keep &= x >= u[f] * cos - reach if u[f] > 0 else x <= u[f] * cos + reach
    return np.flatnonzero(keep)


def search_block(
    q_ids: np.ndarray, q: np.ndarray, p_ids: np.ndarray, p: np.ndarray, k: int, local: int = 512
) -> list[tuple[int, int, int]]:
    """Each query's best k of a block, as (place of the query, vector, score); ties go to the smaller id."""
    q_norm, p_norm = np.sqrt((q * q).sum(1)), np.sqrt((p * p).sum(1))
    order = np.lexsort((p_ids, -p_norm))
    p, p_ids, p_norm = p[order], p_ids[order], p_norm[order]
    best: list[list[tuple[int, int]]] = [[] for _ in q_ids]  # heaps of (score, -id)
    floor = np.full(len(q), -np.inf)
    for at in range(0, len(p), local):
        rows, norms, ids = p[at : at + local], p_norm[at : at + local], p_ids[at : at + local]
        longest = norms[0]
        with np.errstate(divide="ignore", invalid="ignore"):
            cos = np.where(q_norm * longest > 0, floor / (q_norm * longest), np.where(floor > 0, np.inf, -np.inf))
        by_length = np.flatnonzero(cos < COORDINATE_FROM)
        by_coordinate = np.flatnonzero((cos >= COORDINATE_FROM) & (cos <= 1 + 1e-9))
        if len(by_length):
            # Only vectors long enough for the lowest of these thresholds.
            lowest = floor[by_length].min()
            need = lowest / max(q_norm[by_length].max(), 1e-300) if lowest > 0 else -np.inf
            n = int(np.searchsorted(-norms, -need * (1 - 1e-9), side="right")) if need > 0 else len(rows)
            if n:
                scores = _products(q[by_length], rows[:n])
                for i, row in zip(by_length.tolist(), scores, strict=True):
                    near = np.flatnonzero(row >= floor[i]) if floor[i] > -np.inf else np.arange(n)
                    if len(near) > 4 * k:  # the others cannot be among the best k here
                        cut = np.partition(row[near], len(near) - k - 1)[len(near) - k - 1] if row.dtype != object else None
                        near = near if cut is None else near[row[near] >= cut]
                    floor[i] = _offer(best[i], int(q_ids[i]), ids, row, near, k, floor[i])
        if len(by_coordinate):
            with np.errstate(divide="ignore", invalid="ignore"):
                unit = np.where(norms[:, None] > 0, rows / norms[:, None], 0.0)
            for i in by_coordinate.tolist():
                # A shorter vector needs a higher cosine, so the longest one's threshold is safe for all.
                near = _candidates(q[i], q_norm[i], unit, min(1.0, float(cos[i])))
                if len(near):
                    row = np.zeros(len(rows), dtype=object)
                    row[near] = _products(q[i : i + 1], rows[near])[0]
                    floor[i] = _offer(best[i], int(q_ids[i]), ids, row, near, k, floor[i])
    return [(i, -minus, score) for i, heap in enumerate(best) for score, minus in heap]


def _offer(heap: list, query: int, ids: np.ndarray, row, near: np.ndarray, k: int, floor: float) -> float:
    for j in near.tolist():
        if ids[j] == query:
            continue
        entry = (int(row[j]), -int(ids[j]))
        if len(heap) < k:
            heapq.heappush(heap, entry)
        elif entry > heap[0]:
            heapq.heapreplace(heap, entry)
    return heap[0][0] if len(heap) == k else floor


def top_k(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 50,
    k: int = 5,
    scale: int = 256,
    block_rows: int | None = None,
    query_rows: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors of highest integer inner product.

    Queries are the rows whose id is divisible by ``every``, against every other
    row.  Vectors of another dimension than the query's are not compared.  Rows
    without an id are left out.  A repeated id is searched once for each distinct
    vector it has and never finds itself; a repeated candidate fills as many places
    as it has rows.  Unusable vectors (see ``integer_vectors``) take no part; with
    none left the result is empty.  Other columns play no part.

    Blocks of vectors and of queries hold ``block_rows`` and ``query_rows`` rows, by
    default as many as fit in ``BLOCK_BYTES``.
    """
    ship(df.sparkSession)
    vectors = integer_vectors(df, id_col, vector_col, scale).where(F.col("vec_id").isNotNull())
    # Norms within a factor of 2^(1/4) are one bucket; the exponents of doubles bound the number of buckets.
    bucket = F.when(F.col("norm") > 0, F.floor(F.log2("norm") * 4)).otherwise(F.lit(NO_LENGTH)).cast("int")
    vectors = materialize(vectors.withColumn("bucket", bucket), "vectors")
    fitting = F.greatest(F.lit(1), F.floor(F.lit(BLOCK_BYTES / 8) / F.greatest("dim", F.lit(1))))
    rows = F.lit(block_rows) if block_rows else fitting
    sizes = vectors.groupBy("dim", "bucket").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("longest"))
    longer = Window.partitionBy("dim").orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    buckets = sizes.select(
        "dim", "bucket", "longest", F.ceil(F.col("n") / rows).cast("int").alias("blocks"),
        # The head of a dimension: its longest buckets, as many as are needed for a block.
        (F.coalesce(F.sum("n").over(longer), F.lit(0)) < F.least(rows, F.lit(HEAD_ROWS))).alias("head"),
    )
    buckets = materialize(buckets, "buckets")  # a row for each bucket
    is_query = F.pmod(F.col("vec_id"), F.lit(every)) == 0
    queries = vectors.where(is_query).dropDuplicates(["vec_id", "v"])
    counted = vectors.where(is_query).groupBy("dim").agg(F.count(F.lit(1)).alias("n"))  # a row for each dimension
    wanted = F.lit(query_rows) if query_rows else fitting
    query_blocks = counted.select("dim", F.greatest(F.lit(1), F.ceil(F.col("n") / wanted)).cast("int").alias("qbs"))
    queries = queries.join(F.broadcast(query_blocks), "dim").select("dim", "vec_id", "v", "norm", "qbs")

    # First the longest vectors, which give each query a score that the k-th best reaches.
    at_random = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.col("qbs")).cast("int")
    head = materialize(_meet(vectors, queries.withColumn("qb", at_random), buckets.where("head"), None, k), "head-scores")
    downwards = Window.partitionBy("query_id", "query_hash").orderBy(F.col("score").desc())
    least = head.withColumn("place", F.row_number().over(downwards)).where(F.col("place") == k)
    least = least.select(F.col("query_id").alias("q"), F.col("query_hash").alias("h"), F.col("score").alias("least"))

    # Then only buckets with a vector long enough for that: score <= length of the query * longest of the bucket.
    known = queries.join(least, (F.col("vec_id") == F.col("q")) & (F.xxhash64("v") == F.col("h")), "left")
    need = F.when((F.col("least") > 0) & (F.col("norm") > 0), F.col("least") / F.col("norm") * (1 - 1e-9)).otherwise(0.0)
    known = known.select("dim", "vec_id", "v", "qbs", need.alias("need"))
    # Queries of like needs share a block: blocks are ranges of the need, cut at its quantiles.
    cuts = known.groupBy("dim").agg(F.percentile_approx("need", [i / 64 for i in range(1, 64)], 10_000).alias("cuts"))
    known = known.join(F.broadcast(cuts), "dim")
    span = F.size(F.filter("cuts", lambda c: c < F.col("need")))
    width = F.ceil(F.col("qbs") / 64).cast("int")  # blocks of a range, once there are more than 64
    ranged = F.when(F.col("qbs") <= 64, F.floor(span * F.col("qbs") / 64)).otherwise(span * width + F.pmod(F.xxhash64("vec_id", F.lit(3)), width))
    known = materialize(known.withColumn("qb", ranged.cast("int")).drop("cuts", "qbs"), "queries")
    needs = known.groupBy("dim", "qb").agg(F.min("need").alias("need"))  # a row for each block of queries
    rest = _meet(vectors, known, buckets.where("NOT head"), needs, k)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    every_score = head.unionByName(rest).select("query_id", "vec_id", "score")
    return every_score.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _meet(vectors: DataFrame, queries: DataFrame, buckets: DataFrame, needs: DataFrame | None, k: int) -> DataFrame:
    """(query_id, query_hash, vec_id, score): the best k of every block of the buckets for every query.

    With ``needs``, a block of queries meets only buckets whose longest vector is as long as its least need.
    """
    pairs = buckets.select("dim", "bucket", "blocks", "longest")
    blocks = queries.select("dim", "qb").distinct() if needs is None else needs
    pairs = pairs.join(F.broadcast(blocks), "dim")
    if needs is not None:
        pairs = pairs.where(F.col("longest") * (1 + 1e-9) >= F.col("need"))
    pairs = pairs.select("dim", "bucket", "blocks", "qb")  # a row for each bucket and block of queries that meet
    of_bucket = pairs.groupBy("dim", "bucket", "blocks").agg(F.collect_list("qb").alias("qbs"))
    left = (
        vectors.join(F.broadcast(of_bucket), ["dim", "bucket"])
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
        .select("dim", "bucket", "block", F.explode("qbs").alias("qb"), "vec_id", "v")
    )
    of_queries = pairs.groupBy("dim", "qb").agg(F.collect_list(F.struct("bucket", "blocks")).alias("met"))
    right = (
        queries.join(F.broadcast(of_queries), ["dim", "qb"])
        .select("dim", "qb", "vec_id", "v", F.explode("met").alias("m"))
        .select("dim", F.col("m.bucket").alias("bucket"), F.explode(F.expr("sequence(0, m.blocks - 1)")).alias("block"), "qb", "vec_id", "v", F.xxhash64("v").alias("query_hash"))
    )

    def run(key, a: pa.Table, b: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        hashes: list[int] = []
        if a.num_rows and b.num_rows:
            dim = key[0].as_py()
            p_ids, p = _matrix(a, dim)
            q_ids, q = _matrix(b, dim)
            of = b.column("query_hash").to_numpy()
            for at in range(0, len(q), 1024):
                # A repeated id stands for several vectors, so the search goes by place.
                for i, j, score in search_block(q_ids[at : at + 1024], q[at : at + 1024], p_ids, p, k):
                    out.append((int(q_ids[at + i]), j, score))
                    hashes.append(int(of[at + i]))
        query, found, score = list(zip(*out, strict=True)) or [[], [], []]
        columns = {"query_id": query, "query_hash": hashes, "vec_id": found, "score": score}
        return pa.table({n: pa.array(list(c), pa.int64()) for n, c in columns.items()})

    keys = ["dim", "bucket", "block", "qb"]
    right = right.toDF(*right.columns)  # columns of its own, as both come from one table
    schema = "query_id long, query_hash long, vec_id long, score long"
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


def _matrix(t: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray]:
    values = t.column("v").combine_chunks()
    flat = values.flatten() if isinstance(values, pa.ListArray | pa.LargeListArray) else pa.concat_arrays([c.flatten() for c in values.chunks])
    return t.column("vec_id").to_numpy(), flat.to_numpy(zero_copy_only=False).reshape(t.num_rows, dim)


def query(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


SQL = """
WITH v AS (
  SELECT vec_id, len(embedding) AS dim, [floor(CAST(x AS DOUBLE) * 256) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, p.vec_id, CAST(list_inner_product(q.e, p.e) AS BIGINT) AS score
  FROM v q JOIN v p ON q.dim = p.dim AND q.vec_id <> p.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

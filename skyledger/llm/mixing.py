"""Mixing sources to target weights, with DataFrame functions only.

Every source is a line of tokens (its documents in seeded order), cut into blocks
of equal size.  Sainte-Lague apportionment gives the blocks of the mix to the
sources by highest quotients ``target / (2 j - 1)``.  The order of the seats is
the order of the mix, so seats ``(k N / K, (k + 1) N / K]`` are shard ``k``: the
method is house monotone, and the differences of its quotas at those house sizes
are each shard's integer quotas.  A source's seats take its blocks in turn from a
seeded start, around the end as often as the quota asks.

For the plan, what is shuffled is a row of a few numbers for each document; sums over a
source go through seeded buckets and runs of buckets, so no task holds a whole source.
One row a source goes through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, table

#: White space that separates tokens: space and the control characters tab to carriage return.
TOKEN = r"[^\x20\x09-\x0D]+"
MAX_REPEATS = 3
#: Buckets whose sizes one task adds up.
RUN = 4096


def _hash(seed: int, *parts: Column) -> Column:
    """A seeded 60-bit number from MD5, the same in any engine."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _named(source: Column) -> Column:
    """A source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def targets(sources: DataFrame, weights: tuple[int, ...], max_repeats: int) -> DataFrame:
    """Adds ``weight`` and ``target`` to (source, source_size).

    Targets share the total by weight, capped at ``max_repeats`` times the
    source's size; the excess is reshared until none is above.  With sources in
    the order of cap / weight the capped ones are a prefix, so running sums give
    the level directly.  One row a source goes through one task.
    """
    every = Window.partitionBy()
    by_name = every.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("i", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("i") % len(weights) + 1).cast("int")).cast("long")
    )
    cap = F.col("source_size") * max_repeats
    order = every.orderBy(F.col("source_size") / F.col("weight"), "i")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(every)
    level = (total - F.coalesce(F.sum(cap).over(before), F.lit(0))) / F.sum("weight").over(after)
    capped = cap <= F.col("weight") * level
    levelled = ranked.withColumn("total", total).withColumn("level", F.when(~capped, level))
    return levelled.withColumn("level", F.max("level").over(every)).select(
        "source",
        "i",
        "source_size",
        "total",
        "weight",
        F.when(F.col("level").isNull(), cap.cast("double"))
        .otherwise(F.least(cap.cast("double"), F.col("weight") * F.col("level")))
        .alias("target"),
    )


def quotas(wanted: DataFrame, block: int, shards: int, max_repeats: int) -> DataFrame:
    """Adds ``n_blocks`` and ``quota`` (array: seats after each shard) to the targets.

    Only seats near the cut are ranked: with V votes, S parties and N seats every
    divisor above V / (N - S/2) gives too few seats and every one below
    V / (N + S/2) too many, so at most about 2 S quotients lie between.
    """
    every = Window.partitionBy()
    n = F.greatest(F.ceil(F.col("total") / block), F.col("parties"))
    base = wanted.withColumn("parties", F.count(F.lit(1)).over(every)).withColumn("votes", F.sum("target").over(every))
    base = base.withColumn("n_blocks", F.ceil(F.col("source_size") / block).cast("long"))
    houses = base.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn(
        "house", F.floor(n * (F.col("shard") + 1) / shards).cast("long")
    )
    share = F.when(F.col("votes") > 0, F.col("target") / F.col("votes")).otherwise(F.lit(0.0))
    most = F.col("n_blocks") * max_repeats
    low = F.floor(share * F.greatest(F.col("house") - F.col("parties"), F.lit(0)) - 0.5).cast("long")
    high = F.ceil(share * (F.col("house") + F.col("parties")) + 0.5).cast("long")
    ranged = houses.withColumn("low", F.least(F.greatest(low, F.lit(0)), most)).withColumn("high", F.least(high, most))
    seats = ranged.select(
        "source", "i", "shard", "house", "low", "target",
        F.explode(F.expr("CASE WHEN high > low THEN sequence(low + 1, high) ELSE array() END")).alias("j"),
    )
    by_quotient = Window.partitionBy("shard").orderBy((F.col("target") / (2 * F.col("j") - 1)).desc(), "i", "j")
    sure = ranged.groupBy("shard").agg(F.sum("low").alias("sure"))
    won = (
        seats.withColumn("rank", F.row_number().over(by_quotient))
        .join(F.broadcast(sure), "shard")  # one row a shard
        .where((F.col("rank") <= F.col("house") - F.col("sure")) & (F.col("target") > 0))
        .groupBy("i", "shard")
        .agg(F.count(F.lit(1)).alias("more"))
    )
    return (
        ranged.join(won, ["i", "shard"], "left")
        .groupBy("source", "i", "source_size", "weight", "target", "n_blocks")
        .agg(F.array_sort(F.collect_list(F.col("low") + F.coalesce("more", F.lit(0)))).alias("quota"))
    )


def _starts(groups: DataFrame) -> DataFrame:
    """Adds ``start``, the sizes of the source's buckets before: sums within runs of RUN buckets, and of the runs."""
    groups = groups.withColumn("run", F.floor(F.col("bucket") / RUN))
    runs = groups.groupBy("source", "run").agg(F.sum("bucket_size").alias("run_size"))
    earlier = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("source").alias("s"), F.col("run").alias("r"), F.coalesce(F.sum("run_size").over(earlier), F.lit(0)).alias("run_start"))
    before = Window.partitionBy("source", "run").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    inside = groups.withColumn("inside", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)))
    joined = inside.join(runs, F.expr("source <=> s AND run = r"))
    return joined.select("source", "bucket", "bucket_size", (F.col("run_start") + F.col("inside")).alias("start"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    max_repeats: int = MAX_REPEATS,
    shards: int = 16,
    block: int = 16,
    seed: int = 17,
    rows_per_bucket: int = 2000,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """What a mix takes of every document.

    Returns ``doc_id, source, size, source_size, target, taken, ranges`` and the
    columns in ``keep``, each as ``keep_<name>`` so that no name clashes.  ``ranges`` holds, for each shard that takes words of the
    document, structs (shard, from_word, to_word); ``taken`` is their total length.

    Sources go by code point, null last, and take the weights in turn.  A null
    text has no tokens; documents of no tokens have a row and nothing is taken of
    them.  Ties in the seeded order fall to the document's id and size; rows alike
    in both are interchangeable.  An empty table gives an empty result.
    """
    kept = [F.col(f"`{c}`").alias(f"keep_{c}") for c in keep]
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(text_col, F.lit(TOKEN)), F.lit(0)).cast("long").alias("size"),
        *kept,
    ).withColumns({"h": _hash(seed, F.col("doc_id")), "of": _named(F.col("source"))})
    slim = materialize(rows.drop(*[f"keep_{c}" for c in keep]), "sizes")
    buckets = max(1, -(-slim.count() // rows_per_bucket))
    numbered = lambda df: df.withColumn("bucket", F.col("h") % buckets)
    sized = numbered(rows if keep else slim)
    groups = numbered(slim).groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    # Both tables are small and read by several branches below; written once, they keep the plan small.
    groups = materialize(_starts(groups), "buckets")
    wanted = targets(groups.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, max_repeats)
    wanted = materialize(wanted, "targets")
    granted = quotas(wanted, block, shards, max_repeats)
    info = groups.alias("g").join(granted.alias("q"), F.expr("g.source <=> q.source")).select(
        _named(F.col("g.source")).alias("of"), F.col("g.bucket").alias("bucket"), "start", "source_size", "target", "n_blocks", "quota"
    )
    # The window and the join have the same keys, without nulls, so that the texts in ``keep`` are shuffled once.
    inside = Window.partitionBy("of", "bucket").orderBy("h", F.col("doc_id").asc_nulls_last(), "size")
    laid = sized.withColumn("end", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    placed = laid.join(info, ["of", "bucket"]).withColumns(
        {
            "a": F.col("start") + F.col("end") - F.col("size"),
            "z": F.col("start") + F.col("end"),
            "turn": F.when(F.col("n_blocks") > 0, _hash(seed, F.col("source")) % F.col("n_blocks")).otherwise(F.lit(0)),
        }
    )
    # Seats t = from .. to - 1 of a shard take blocks (turn + t) mod n; lap l covers the blocks at l n .. l n + n.
    ranges = F.expr(
        f"""filter(flatten(transform(sequence(0, {shards - 1}), k -> transform(sequence(0, {max_repeats}), l -> named_struct(
          'shard', k,
          'from_word', greatest(a, least(source_size, greatest(0, turn + (CASE WHEN k = 0 THEN 0 ELSE quota[k - 1] END) - l * n_blocks) * {block})) - a,
          'to_word', least(z, source_size, greatest(0, turn + quota[k] - l * n_blocks) * {block}) - a)))), r -> r.to_word > r.from_word)"""
    )
    return placed.withColumn("ranges", ranges).select(
        "doc_id", "source", "size", "source_size", "target",
        F.expr("aggregate(ranges, 0L, (n, r) -> n + r.to_word - r.from_word)").alias("taken"),
        "ranges",
        *[F.col(f"`keep_{c}`") for c in keep],
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``.

    A document comes once for each pass that takes all its words, unchanged, and
    once for each pass that takes a part; such a part (one or two documents of a
    source and shard are cut by a block's edge) is its words joined by spaces.
    ``n_chars``, where there is one, is the length of the text given out.
    """
    text = options.get("text_col", "text")
    out = mix(docs, keep=tuple(docs.columns), **options)
    # Adjacent ranges of a pass meet at a shard's edge and are one part.
    merged = F.expr(
        """aggregate(slice(ranges, 2, 1000000), slice(ranges, 1, 1), (done, r) ->
             CASE WHEN element_at(done, -1).to_word = r.from_word
             THEN concat(slice(done, 1, size(done) - 1), array(named_struct('shard', element_at(done, -1).shard,
               'from_word', element_at(done, -1).from_word, 'to_word', r.to_word)))
             ELSE concat(done, array(r)) END)"""
    )
    part = out.withColumn("r", F.explode(merged))
    whole = (F.col("r.from_word") == 0) & (F.col("r.to_word") == F.col("size"))
    cut = F.expr(
        rf"array_join(slice(regexp_extract_all(`keep_{text}`, '[^\\x20\\x09-\\x0D]+', 0), int(r.from_word) + 1, int(r.to_word - r.from_word)), ' ')"
    )
    part = part.withColumn("_text", F.when(whole, F.col(f"`keep_{text}`")).otherwise(cut))
    given = {text: F.col("_text"), "n_chars": F.char_length("_text").cast("long")}
    return part.select(*[given.get(c, F.col(f"`keep_{c}`")).alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS h
  FROM documents
), buckets AS (
  SELECT greatest(1, CAST(ceil(count(*) / 2000.0) AS BIGINT)) AS b FROM docs
), sources AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source)
), weighted AS (
  SELECT *, i % 3 + 1 AS weight, CAST(sum(source_size) OVER () AS BIGINT) AS total, count(*) OVER () AS parties FROM sources
), levels AS (
  SELECT *, (total - coalesce(sum(3 * source_size) OVER (ORDER BY source_size / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY source_size / weight, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted
), level AS (
  SELECT max(CASE WHEN NOT 3 * source_size <= weight * level THEN level END) AS level FROM levels
), targets AS (
  SELECT w.*, coalesce(least(CAST(3 * source_size AS DOUBLE), weight * l.level), CAST(3 * source_size AS DOUBLE)) AS target,
    CAST(ceil(source_size / 16) AS BIGINT) AS n_blocks, greatest(CAST(ceil(total / 16) AS BIGINT), parties) AS house
  FROM weighted w, level l
), shares AS (
  SELECT *, CASE WHEN sum(target) OVER () > 0 THEN target / sum(target) OVER () ELSE 0 END AS share FROM targets
), brackets AS (
  SELECT *, least(greatest(CAST(floor(share * greatest(house - parties, 0) - 0.5) AS BIGINT), 0), 3 * n_blocks) AS low,
    least(CAST(ceil(share * (house + parties) + 0.5) AS BIGINT), 3 * n_blocks) AS high FROM shares
), seats AS (
  SELECT i, target, house, (SELECT sum(low) FROM brackets) AS sure, unnest(generate_series(low + 1, high)) AS j FROM brackets
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY target / (2 * j - 1) DESC, i, j) AS rank FROM seats
), quotas AS (
  SELECT b.*, b.low + (SELECT count(*) FROM ranked r WHERE r.i = b.i AND r.rank <= r.house - r.sure AND r.target > 0) AS quota,
    CASE WHEN n_blocks > 0 THEN CAST('0x' || substr(md5('17:' || coalesce(source, 'null')), 1, 15) AS BIGINT) % n_blocks ELSE 0 END AS turn
  FROM brackets b
), placed AS (
  SELECT d.*, sum(size) OVER (PARTITION BY source ORDER BY h % b, h, doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) AS z
  FROM docs d, buckets
)
SELECT p.doc_id, p.size, q.source_size, q.target, CAST((
    SELECT sum(greatest(0, least(p.z, q.source_size, greatest(0, q.turn + q.quota - l * q.n_blocks) * 16)
      - greatest(p.z - p.size, least(q.source_size, greatest(0, q.turn - l * q.n_blocks) * 16))))
    FROM (VALUES (0), (1), (2), (3)) laps(l)) AS BIGINT) AS taken
FROM placed p JOIN quotas q ON p.source IS NOT DISTINCT FROM q.source
"""

"""Line dedup by a log-template tree, with DataFrame functions only.

A line goes down a tree of fixed depth: first by its number of tokens, then by its
leading tokens, where a token with a digit is a variable field.  A leaf holds several
templates.  A token is known by how many different lines of its leaf have it at its
place; tokens of fewer than ``min_docs`` lines are variable fields, and a line has a
template for each step of a ladder (min_docs times 1, 4, 16 ...) below which its tokens
become fields too, so that a field's frequent values do not hide it.  At least
``similarity_percent`` of 100 of a template's places are constants.

Dropped are the lines that recur in ``min_docs`` different documents: as they are, with
the tokens that have digits as fields, or by a template.

Exact copies of a document count once.  Texts are read once; what is shuffled are hashes
of lines, and the different lines of leaves that recur.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, table, unused, with_value

WHITE = r"\x20\x09-\x0D"
#: A token that has a digit; the look-behind lets it begin at a token's start only, so a long token is read once.
WITH_DIGIT = rf"(?<![^{WHITE}])[^{WHITE}0-9]*+[0-9][^{WHITE}]*+"
FIELD = "<*>"
#: Steps of the ladder: up to 4 ** 20 times ``min_docs`` lines.
STEPS = 20
#: Leaves, two numbers each, that may be broadcast.
MAX_BROADCAST_LEAVES = 1_000_000


def _lines(docs: DataFrame, text_col: str, depth: int) -> DataFrame:
    """(th, line_no, chars, lh, mh, n, fields, leaf, masked): every line of every text.

    ``masked`` is the line's tokens, those with digits as fields, joined by one space;
    th, lh and mh hash the text, the line and the masked line.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = docs.select(F.xxhash64(text).alias("th"), F.posexplode(F.split(text, "\n", -1)).alias("line_no", "line"))
    one_space = F.trim(F.regexp_replace(F.regexp_replace("line", WITH_DIGIT, FIELD), f"[{WHITE}]+", " "))
    tokens = F.when(F.col("masked") == "", F.array().cast("array<string>")).otherwise(F.split("masked", " "))
    return (
        split.withColumn("masked", one_space)
        .withColumn("tokens", tokens)
        .select(
            "th", "line_no", F.char_length("line").alias("chars"), F.xxhash64("line").alias("lh"), F.xxhash64("masked").alias("mh"),
            F.size("tokens").alias("n"), F.size(F.array_remove("tokens", FIELD)).alias("constants"),
            F.xxhash64(F.size("tokens"), F.array_join(F.slice("tokens", 1, depth), " ")).alias("leaf"), "masked",
        )
    )


def _recurring(df: DataFrame, key: str, min_docs: int) -> DataFrame:
    """Keys that occur in at least ``min_docs`` different texts; both steps combine before they shuffle."""
    return df.select(key, "th").distinct().groupBy(key).count().where(F.col("count") >= min_docs).select(key)


def _step(count: Column, min_docs: int) -> Column:
    """The steps of the ladder that a count reaches, 0 for a count below ``min_docs``."""
    return reduce(lambda a, b: a + b, [(count >= min_docs * 4**j).cast("int") for j in range(STEPS)])


def templates(full: DataFrame, depth: int, similarity_percent: int, min_docs: int) -> DataFrame:
    """(k, v): the lines (k, their hash) of leaves that recur, with the hashes of their templates."""
    recurring = _recurring(full, "leaf", min_docs)
    several = full.select("leaf", "lh").distinct().groupBy("leaf").agg(F.count(F.lit(1)).alias("v")).where(F.col("v") >= min_docs)
    leaves = materialize(several.join(recurring, "leaf", "left_semi").withColumnRenamed("leaf", "k"), "leaves")
    lines = full.select("leaf", "lh", "masked")
    if leaves.count() <= MAX_BROADCAST_LEAVES:  # the other lines are not shuffled
        lines = lines.join(F.broadcast(leaves), F.col("leaf") == F.col("k")).drop("k")
    else:
        lines = with_value(lines, "leaf", leaves).where("v IS NOT NULL")
    lines = lines.groupBy("leaf", "lh").agg(F.first("masked").alias("masked"), F.first("v").alias("lines"))
    cells = lines.select("leaf", "lh", "lines", F.posexplode(F.split("masked", " ")).alias("pos", "token")).select(
        "lh", "pos", "lines", "leaf", (F.col("token") != FIELD).alias("named"), F.xxhash64("token").alias("token"),
        F.xxhash64("leaf", "pos", "token").alias("cell"),
    )
    cells = materialize(cells, "cells")
    # The leading tokens are the same in all lines of a leaf; the others are counted.
    inner = cells.where(F.col("named") & (F.col("pos") >= depth))
    counts = inner.groupBy(F.col("cell").alias("k")).agg(F.count(F.lit(1)).alias("v")).where(F.col("v") >= min_docs)
    counts = materialize(counts, "cell-counts")
    steps = with_value(inner, "cell", counts).select("lh", "leaf", "pos", "token", _step(F.coalesce("v", F.lit(0)), min_docs).alias("step"))
    others = cells.where(~(F.col("named") & (F.col("pos") >= depth)))
    others = others.select("lh", "leaf", "pos", "token", F.when(F.col("named"), _step(F.col("lines"), min_docs)).otherwise(0).alias("step"))
    whole = steps.unionByName(others).groupBy("leaf", "lh").agg(F.sort_array(F.collect_list(F.struct("pos", "token", "step"))).alias("cells"))
    ladder = F.array_distinct(F.filter(F.transform("cells", lambda c: c["step"]), lambda s: s > 0))
    at = whole.select("leaf", "lh", "cells", F.explode(ladder).alias("at"))
    kept = F.transform("cells", lambda c: F.when(c["step"] >= F.col("at"), c["token"]))
    enough = F.size(F.array_compact(F.col("kept"))) * 100 >= F.size("kept") * similarity_percent
    made = at.withColumn("kept", kept).where(enough).select("lh", F.xxhash64("leaf", F.transform("kept", lambda x: F.coalesce(x.cast("string"), F.lit("")))).alias("template"))
    made = materialize(made.groupBy(F.col("lh").alias("k")).agg(F.collect_set("template").alias("v")), "templates")
    discard(leaves, cells, counts)
    return made


def dropped_lines(docs: DataFrame, text_col: str, depth: int, similarity_percent: int, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """The lines of all texts as (th, line_no, lh, chars), and those that go as (k, v): their hash and 1."""
    lines = materialize(_lines(docs, text_col, depth), "lines")
    full = lines.where(F.col("n") > 0)
    alike = full.where(F.col("constants") * 100 >= F.col("n") * similarity_percent)
    made = templates(full, depth, similarity_percent, min_docs)
    slim = materialize(lines.select("th", "line_no", "lh", "mh", "chars", "n", "constants"), "slim-lines")
    discard(lines)
    full, alike = slim.where(F.col("n") > 0), slim.where((F.col("n") > 0) & (F.col("constants") * 100 >= F.col("n") * similarity_percent))
    same = _recurring(full, "lh", min_docs)
    masked = materialize(_recurring(alike, "mh", min_docs).select(F.col("mh").alias("k"), F.lit(1).alias("v")), "masks")
    masked = with_value(alike.select("mh", "lh").distinct(), "mh", masked).where("v = 1").select("lh")
    texts = with_value(full.select("lh", "th"), "lh", made).select("th", F.explode("v").alias("template"))
    recurring = materialize(_recurring(texts, "template", min_docs).select(F.col("template").alias("k"), F.lit(1).alias("v")), "recurring-templates")
    of = made.select(F.col("k").alias("lh"), F.explode("v").alias("template"))
    general = with_value(of, "template", recurring).where("v = 1").select("lh")
    gone = same.union(masked).union(general).distinct().select(F.col("lh").alias("k"), F.lit(1).alias("v"))
    return slim, materialize(gone, "gone-lines")


def dedup_lines(
    docs: DataFrame,
    text_col: str = "text",
    depth: int = 3,
    similarity_percent: int = 70,
    min_docs: int = 4,
    clean: bool = True,
) -> DataFrame:
    """Adds ``n_lines``, ``n_dropped``, ``dropped_chars`` and ``dropped_lines`` (line numbers
    from 0) and, with ``clean``, replaces the text by its remaining lines.

    Lines end at line feeds.  Lines without tokens stay.  Null counts as one empty
    line and stays null.  Exact copies, repeated rows among them, count as one
    document and are cleaned alike; ids play no part.  An empty table gives an empty
    result.  Input columns with the name of an added column are replaced.
    """
    slim, gone = dropped_lines(docs, text_col, depth, similarity_percent, min_docs)
    flags = (
        with_value(slim.select("th", "line_no", "lh", "chars").distinct(), "lh", gone)
        .groupBy("th")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.count("v").alias("n_dropped"),
            F.coalesce(F.sum(F.when(F.col("v") == 1, F.col("chars"))), F.lit(0)).cast("long").alias("dropped_chars"),
            F.sort_array(F.collect_list(F.when(F.col("v") == 1, F.col("line_no")))).alias("dropped_lines"),
        )
    )
    rows = docs.drop(*[c for c in docs.columns if c.lower() in ("n_lines", "n_dropped", "dropped_chars", "dropped_lines")])
    mine, theirs = unused("_mine", rows), unused("_theirs", rows)
    rows = rows.withColumn(mine, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    out = rows.join(flags.withColumnRenamed("th", theirs), F.col(mine) == F.col(theirs)).drop(mine, theirs)
    if clean:
        kept = F.filter(
            F.transform(F.split(text_col, "\n", -1), lambda line, i: F.when(~F.array_contains("dropped_lines", i), line)),
            lambda line: line.isNotNull(),
        )
        out = out.withColumn(text_col, F.when(F.col("n_dropped") > 0, F.array_join(kept, "\n")).otherwise(F.col(text_col)))
    return out


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, clean=False).select(
        "doc_id", "n_lines", "n_dropped", "dropped_chars", F.array_join(F.transform("dropped_lines", lambda x: x.cast("string")), ",").alias("dropped_lines")
    )


SQL = r"""
WITH texts AS (
  SELECT DISTINCT coalesce(text, '') AS text FROM documents
), split AS (
  SELECT text, generate_subscripts(ls, 1) - 1 AS line_no, unnest(ls) AS line
  FROM (SELECT text, string_split(text, chr(10)) AS ls FROM texts)
), lines AS (
  SELECT *, [CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END FOR t IN regexp_extract_all(line, '[^\x20\x09-\x0D]+')] AS m FROM split
), keyed AS (
  SELECT text, line_no, line, m, len(m) AS n, array_to_string(m, ' ') AS mask,
    len(m) || ':' || array_to_string(m[1:3], ' ') AS leaf
  FROM lines
), same AS (
  SELECT line FROM keyed WHERE n > 0 GROUP BY line HAVING count(DISTINCT text) >= 4
), masks AS (
  SELECT mask FROM keyed WHERE n > 0 AND len([t FOR t IN m IF t <> '<*>']) * 100 >= n * 70 GROUP BY mask HAVING count(DISTINCT text) >= 4
), leaves AS (
  SELECT leaf FROM keyed WHERE n > 0 GROUP BY leaf HAVING count(DISTINCT text) >= 4 AND count(DISTINCT line) >= 4
), variants AS (
  SELECT DISTINCT leaf, line, m, n FROM keyed WHERE n > 0 AND leaf IN (SELECT leaf FROM leaves)
), cells AS (
  SELECT leaf, line, n, generate_subscripts(m, 1) AS pos, unnest(m) AS token FROM variants
), counts AS (
  SELECT leaf, pos, token, count(*) AS c FROM cells WHERE token <> '<*>' GROUP BY ALL
), steps AS (
  SELECT e.leaf, e.line, e.n, e.pos, e.token, len([j FOR j IN range(0, 20) IF coalesce(c.c, 0) >= 4 * 4 ** j]) AS step
  FROM cells e LEFT JOIN counts c ON e.leaf = c.leaf AND e.pos = c.pos AND e.token = c.token
), ladder AS (
  SELECT DISTINCT leaf, line, step AS at FROM steps WHERE step > 0
), made AS (
  SELECT s.leaf, s.line, array_agg(CASE WHEN s.step >= l.at THEN s.token END ORDER BY s.pos) AS template
  FROM steps s JOIN ladder l ON s.leaf = l.leaf AND s.line = l.line
  GROUP BY s.leaf, s.line, l.at HAVING count(*) FILTER (s.step >= l.at) * 100 >= count(*) * 70
), recurring AS (
  SELECT m.leaf, m.template FROM keyed k JOIN made m ON k.leaf = m.leaf AND k.line = m.line
  GROUP BY m.leaf, m.template HAVING count(DISTINCT k.text) >= 4
), general AS (
  SELECT DISTINCT m.line FROM made m JOIN recurring r ON m.leaf = r.leaf AND m.template = r.template
), flagged AS (
  SELECT k.text, k.line_no, length(k.line) AS chars,
    k.n > 0 AND (k.line IN (SELECT line FROM same) OR k.line IN (SELECT line FROM general)
      OR len([t FOR t IN k.m IF t <> '<*>']) * 100 >= k.n * 70 AND k.mask IN (SELECT mask FROM masks)) AS gone
  FROM keyed k
), result AS (
  SELECT text, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    CAST(coalesce(sum(chars) FILTER (gone), 0) AS BIGINT) AS dropped_chars,
    coalesce(string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) FILTER (gone), '') AS dropped_lines
  FROM flagged GROUP BY text
)
SELECT d.doc_id, r.n_lines, r.n_dropped, r.dropped_chars, r.dropped_lines
FROM documents d JOIN result r ON coalesce(d.text, '') = r.text
"""

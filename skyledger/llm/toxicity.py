"""Toxic passages by maximum-scoring segment search.

A token is a run of letters, told apart by its first ``LETTERS``.  Its score is the log odds of the texts marked toxic among those
that hold it, against the same for all texts, with Dirichlet priors: the counts of a token are
smoothed towards those of its longest stem, those towards the next shorter stem's, and the
shortest stem's towards the share of toxic texts in all.  So a word seen once says little, unless
words of its stem have said the same.

A text is read once, in linear time: ``segments`` finds every maximal run of tokens whose scores add up
to more than any extension or part of it.  The scores, less a constant, have a negative mean in
clean texts, so the best segments of clean texts follow an extreme-value law (scale ``rate``,
size ``k``), by which a segment of score S in a text of n tokens is expected k n exp(-rate S) times by
chance.  A text's segments are aggregated into one evidence, and a logistic curve turns evidence
into the score.

Counts, law and curve are fitted on all marked rows that are not held out.  A marked text is judged
without its own counts while law and curve are fitted.  Tables have ``BUCKETS`` entries whatever
the corpus, as tokens and stems are hashed.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import MAX_BROADCAST_KEYS, add_columns, materialize, table, unused

BUCKETS = 1 << 20
#: Lengths of the stems that a token's counts are smoothed towards, shortest first.
STEMS = (3, 4, 5, 6, 7)
#: Texts that the prior of a token or stem counts for.
PRIOR = 8.0
#: Taken from each token's log odds, so that clean text has a negative mean.
COST = 1.0
#: A segment counts as significant if as good a one is expected less often than this in clean text of the same length.
SIGNIFICANT = 1.0
#: Bins of a unit of score or evidence, and the range that they cover.
BINS, REACH = 10, 64
#: Tokens whose score is kept in a task, and the letters by which tokens are told apart.
KEPT_WORDS, LETTERS = 200_000, 32

_TOKEN = re.compile(r"[^\W\d_]+")
_FACTOR, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def buckets_of(words: list[str]) -> np.ndarray:
    """A row for each token: the buckets of its stems, shortest first, and of itself; -1 for stems as long as the token.

    A rolling hash of the letters gives all of them at once.
    """
    letters = np.array(words, dtype=f"<U{LETTERS}").view(np.uint32).reshape(len(words), LETTERS)
    length = (letters != 0).sum(1)
    out = np.full((len(words), len(STEMS) + 1), -1, dtype=np.int32)
    h = np.full(len(words), 0xCBF29CE484222325, dtype=np.uint64)
    for n in range(1, int(length.max(initial=0)) + 1):
        h = np.where(length >= n, (h ^ letters[:, n - 1].astype(np.uint64)) * _FACTOR, h)
        if n in STEMS:
            out[:, STEMS.index(n)] = np.where(length > n, _bucket(h), -1)
    out[:, -1] = _bucket(h ^ _MIX)  # a token is told from the stem with its letters
    return out


def _bucket(h: np.ndarray) -> np.ndarray:
    return ((h * _MIX) >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end exclusive, score), from left to right, in linear time.

    Each candidate keeps the sum of all scores before it and up to its end.  A new positive score joins with the
    nearest candidate that begins lower, if that candidate also ends lower; all between are then part of one.
    Scores that are not positive only count in the sums.
    """
    after = np.cumsum(scores)
    places = np.flatnonzero(scores > 0)
    out: list[tuple[int, int, float, float]] = []  # first, end, sum before, sum up to the end
    lower: list[int] = []  # for each candidate, the nearest one before that begins lower
    for i, low, high in zip(places.tolist(), (after[places] - scores[places]).tolist(), after[places].tolist(), strict=True):
        first, end = i, i + 1
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= low:
                j = lower[j]
            if j < 0 or out[j][3] >= high:
                out.append((first, end, low, high))
                lower.append(j)
                break
            first, low = out[j][0], out[j][2]
            del out[j:], lower[j:]
    return [(a, b, high - low) for a, b, low, high in out]


@dataclass
class ToxicModel:
    toxic: np.ndarray  # texts marked toxic that hold a token or stem of the bucket
    clean: np.ndarray
    n_toxic: int
    n_clean: int
    rate: float = 1.0
    k: float = 1.0
    slope: float = 1.0
    shift: float = 0.0

    @property
    def share(self) -> float:
        return (self.n_toxic + 0.5) / (self.n_toxic + self.n_clean + 1.0)

    def log_odds(self, words: list[str], own: int | None = None) -> np.ndarray:
        """Tokens' log odds against all texts'; ``own`` is the mark of a text whose own counts are left out."""
        share = self.share
        p = np.full(len(words), share)
        for b in buckets_of(words).T:
            toxic, both = self.toxic[b].astype(float), (self.toxic[b] + self.clean[b]).astype(float)
            if own is not None:
                toxic, both = np.maximum(toxic - own, 0), np.maximum(both - 1, 0)
            p = np.where(b >= 0, (toxic + PRIOR * p) / (both + PRIOR), p)
        return np.log(p / (1 - p)) - math.log(share / (1 - share))

    def evidence(self, found: list[float], n: int) -> float:
        """Minus the log of the expected number of texts of n tokens with segments as good, by chance.

        ``found`` has the segments' scores.  The significant segments' evidence adds up, less what their number makes likely; without one the best segment counts.
        """
        if not found:
            return -math.log(self.k * max(n, 1)) - 1.0
        each = sorted((self.rate * s - math.log(self.k * n) for s in found), reverse=True)
        best = total = each[0]
        for i, x in enumerate(each[1:], 2):
            if x <= -math.log(SIGNIFICANT):
                break
            total += x - math.log(i)
            best = max(best, total)
        return min(best, float(REACH))

    def probability(self, evidence: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, self.slope * evidence + self.shift))))


class Scorer:
    """Scores the tokens of texts for one task; the scores of ``KEPT_WORDS`` tokens are kept."""

    def __init__(self, model: ToxicModel):
        self.model = model
        self.kept: dict[int | None, dict[str, float]] = {None: {}, 0: {}, 1: {}}

    def scores(self, words: list[str], own: int | None = None) -> np.ndarray:
        kept = self.kept[own]
        new = list(set(words).difference(kept))
        if len(kept) + len(new) > KEPT_WORDS:
            kept.clear()
            new = list(set(words))
        for at in range(0, len(new), 1 << 16):
            part = new[at : at + (1 << 16)]
            kept.update(zip(part, (self.model.log_odds(part, own) - COST).tolist(), strict=True))
        return np.fromiter(map(kept.__getitem__, words), dtype=float, count=len(words))

    def of_batch(self, texts: list[str | None], own: int | None = None) -> list[tuple[np.ndarray, list[tuple[int, int, float]]]]:
        """The tokens' scores and the segments of each text; new tokens of all texts are looked up together."""
        words = [tokens(t) for t in texts]
        whole = self.scores([w for ws in words for w in ws], own)
        out, at = [], 0
        for ws in words:
            part = whole[at : at + len(ws)]
            at += len(ws)
            out.append((part, segments(part)))
        return out


def _marked(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int) -> DataFrame:
    """(text, mark): the marked rows that are not held out.  Labels up to MAX_BROADCAST_KEYS are broadcast."""
    marks = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("marked"))
    marks = marks.agg(F.max((F.col(label_col) > 0).cast("int")).alias("mark")).where(~_held_out(F.col("marked"), folds))
    marks = materialize(marks, "marks")
    side = F.broadcast(marks) if marks.count() <= MAX_BROADCAST_KEYS else marks
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.join(side, F.col("id") == F.col("marked")).select("text", "mark")


def _held_out(id_col, folds: int):
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == 0, F.lit(False))


def _binned(x: float) -> int:
    return int(math.floor(max(-REACH, min(REACH, x)) * BINS))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5) -> ToxicModel:
    """Fits on every row of ``docs`` that ``labels`` marks and whose crc32 of the id is not divisible by ``folds``.

    A text counts once for each bucket that its tokens and stems have.  An id with several labels is toxic
    if one of them says so; null labels say nothing.  Without marks of both kinds nothing is known, and every text gets
    the share of toxic marks (one half without any).
    """
    spark = docs.sparkSession
    marked = _marked(docs, labels, id_col, text_col, label_col, folds)

    def seen():
        def compute(texts):
            words = [set(tokens(t)) for t in texts]
            all_words = list(set().union(*words))
            rows = buckets_of(all_words)
            place = {w: i for i, w in enumerate(all_words)}
            out = []
            for ws in words:
                found = np.unique(rows[[place[w] for w in ws]]) if ws else np.empty(0, dtype=np.int32)
                out.append(found[found >= 0])
            return [out]

        return compute

    held = add_columns(marked, ["text"], [T.StructField("bucket", T.ArrayType(T.IntegerType()))], seen, ("text",))
    held = held.select("mark", F.explode(F.concat("bucket", F.array(F.lit(-1)))).alias("bucket"))  # -1 counts the texts
    counts = held.groupBy("bucket").agg(F.sum("mark").alias("toxic"), F.count(F.lit(1)).alias("both")).toArrow()  # BUCKETS + 1 rows at most
    toxic, both = np.zeros(BUCKETS + 1, dtype=np.int64), np.zeros(BUCKETS + 1, dtype=np.int64)
    at = counts["bucket"].to_numpy()
    toxic[at], both[at] = counts["toxic"].to_numpy(), counts["both"].to_numpy()
    n_toxic, n_clean = int(toxic[-1]), int(both[-1] - toxic[-1])
    model = ToxicModel(toxic[:-1].astype(np.int32), (both - toxic)[:-1].astype(np.int32), n_toxic, n_clean)
    if not n_toxic or not n_clean:
        model.slope, model.shift = 0.0, math.log(model.share / (1 - model.share))
        return model

    # The law of the best segment in clean texts: E(exp(rate * score)) = 1, and log(k n) is the mean of rate * best, less Euler's constant.
    shared = spark.sparkContext.broadcast(model)

    def scored():
        scorer = Scorer(shared.value)

        def compute(texts, marks):
            rows: list = [None] * len(texts)
            for own in (0, 1):
                mine = [i for i, m in enumerate(marks) if m == own]
                for i, (scores, found) in zip(mine, scorer.of_batch([texts[i] for i in mine], own), strict=True):
                    bins, n = np.unique(np.floor(np.clip(scores, -REACH, REACH) * BINS).astype(np.int32), return_counts=True)
                    rows[i] = (bins, n, [x for _, _, x in found], len(scores))
            return [list(c) for c in zip(*rows, strict=True)] if rows else [[], [], [], []]

        return compute

    ints, doubles = T.ArrayType(T.IntegerType()), T.ArrayType(T.DoubleType())
    fields = [T.StructField("bins", ints), T.StructField("times", ints), T.StructField("found", doubles), T.StructField("n", T.LongType())]
    each = materialize(add_columns(marked, ["text", "mark"], fields, scored, ("text",)), "scored")
    clean = each.where("mark = 0 AND n > 0")
    spread = clean.select(F.explode(F.arrays_zip("bins", "times")).alias("b")).groupBy("b.bins").agg(F.sum("b.times").alias("times")).toArrow()  # 2 * REACH * BINS + 1 rows at most
    model.rate = rate_of((spread["bins"].to_numpy() + 0.5) / BINS, spread["times"].to_numpy().astype(float))
    best = F.coalesce(F.array_max("found"), F.lit(0.0))
    mean = clean.agg(F.avg(F.lit(model.rate) * best - F.log(F.col("n").cast("double")))).first()[0]
    model.k = math.exp(min(20.0, max(-20.0, (mean or 0.0) - 0.5772156649)))
    shared.destroy()
    law = (model.rate, model.k)

    def judged():
        plain = ToxicModel(np.empty(0), np.empty(0), 0, 0, *law)

        def compute(found, n):
            return [[_binned(plain.evidence(x, k)) for x, k in zip(found, n, strict=True)]]

        return compute

    evidence = add_columns(each.select("mark", "found", "n"), ["found", "n"], [T.StructField("bin", T.IntegerType())], judged, ("found",))
    told = evidence.groupBy("bin").agg(F.sum("mark").alias("toxic"), F.count(F.lit(1)).alias("both")).toArrow()
    model.slope, model.shift = curve((told["bin"].to_numpy() + 0.5) / BINS, told["toxic"].to_numpy().astype(float), told["both"].to_numpy().astype(float))
    return model


def rate_of(scores: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of E(exp(rate * score)) = 1; one if there is none, as where no score is positive."""
    if not len(scores) or scores.max() <= 0 or (scores * counts).sum() >= 0:
        return 1.0
    p = counts / counts.sum()
    low, high = 0.0, 1.0
    while (p * np.exp(np.minimum(high * scores, 700.0))).sum() < 1 and high < 64:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        if (p * np.exp(np.minimum(middle * scores, 700.0))).sum() < 1:
            low = middle
        else:
            high = middle
    return high


def curve(x: np.ndarray, ones: np.ndarray, both: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of the most likely shares, by Newton's method with a weak prior."""
    mean, spread = float(np.average(x, weights=both)), float(max(1e-6, np.sqrt(np.average((x - np.average(x, weights=both)) ** 2, weights=both))))
    z = (x - mean) / spread
    a, b = 1.0, math.log((ones.sum() + 1) / (both.sum() - ones.sum() + 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -50, 50)))
        gap, w = ones - both * p, both * p * (1 - p)
        g = np.array([(gap * z).sum() - 0.01 * a, gap.sum()])
        h = np.array([[(w * z * z).sum() + 0.01, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 4.0 / max(1e-9, float(np.abs(step).max())))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return a / spread, b - a * mean / spread


def score(docs: DataFrame, model: ToxicModel, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Adds ``tox_score`` (0 to 1) and ``tox_passages``, the significant segments as (first token, tokens, evidence).

    Null and empty texts have no tokens and get the score of a text in which nothing was found.  Rows do not depend on
    each other, so repeated rows and copies get one score.  An empty table gives an empty result.
    Input columns with the name of an added column are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passage = T.StructType([T.StructField("first", T.IntegerType()), T.StructField("tokens", T.IntegerType()), T.StructField("evidence", T.DoubleType())])

    def make():
        model, scorer = shared.value, Scorer(shared.value)

        def compute(texts):
            scores, passages = [], []
            for s, found in scorer.of_batch(texts):
                n = len(s)
                scores.append(model.probability(model.evidence([x for _, _, x in found], n)))
                each = [(a, b - a, model.rate * x - math.log(model.k * n)) for a, b, x in found]
                passages.append([p for p in each if p[2] > -math.log(SIGNIFICANT)])
            return [scores, passages]

        return compute

    fields = [T.StructField("tox_score", T.DoubleType()), T.StructField("tox_passages", T.ArrayType(passage))]
    return add_columns(docs, [text_col], fields, make, () if keep_text else (text_col,))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    held = unused("_held", docs)
    found = score(docs.withColumn(held, _held_out(F.col("doc_id"), 5)), model, keep_text=False)
    return found.select("doc_id", F.col(held).alias("held_out"), F.col("tox_score").alias("score"), (F.col("tox_score") >= 0.5).cast("int").alias("predicted"), F.size("tox_passages").alias("n_passages"))

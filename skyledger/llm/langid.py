"""Language identification by Bayesian fusion of evidence.

Text evidence is a naive Bayes likelihood over hashed byte trigrams.  It is fused
with the declared markup language, the address suffix and a prior of the host.  Host
priors are counted over all rows by grouped aggregation and smoothed towards their
suffix's prior, which is smoothed towards the global one.

The text model is fitted on a bounded sample of labelled rows (``sample_rows`` for
each language); everything else covers all rows.  To identify, a row is read twice, once
for the host counts and once for its answer; texts are not shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, materialize, table, unused

BUCKETS = 1 << 15
#: Rows a language at most that the text model is fitted on.
SAMPLE_ROWS = 800
#: Neighbouring trigrams depend on each other; a text speaks at most as this many independent ones.
INDEPENDENT = 60.0
#: Share of right declarations, and pseudo-counts of the suffix in the host's prior and of the whole in the suffix's.
TRUST_DECLARED = 0.9
HOST_WEIGHT, SUFFIX_WEIGHT = 20.0, 50.0
#: Languages that country suffixes speak for; fixed values.
SUFFIXES = {
    "ar": "ae dz eg iq jo kw lb ly ma om qa sa sd sy tn ye", "bg": "bg", "ca": "cat", "cs": "cz", "da": "dk", "de": "at de li", "el": "cy gr",
    "en": "au gb gh ie jm ke ng nz uk us zw", "es": "ar bo cl co cr cu do ec es gt hn mx ni pa pe pr py sv uy ve", "et": "ee", "eu": "eus",
    "fa": "ir", "fi": "fi", "fr": "bf bj ci fr ga gf gp mc mq sn tg", "gl": "gal", "he": "il", "hi": "in", "hr": "hr", "hu": "hu", "hy": "am",
    "id": "id", "is": "is", "it": "it sm va", "ja": "jp", "ka": "ge", "ko": "kr", "lt": "lt", "lv": "lv", "mk": "mk", "mn": "mn", "ms": "my",
    "nl": "nl sr", "no": "no", "pl": "pl", "pt": "ao br mz pt", "ro": "md ro", "ru": "by ru su", "sk": "sk", "sl": "si", "sq": "al", "sr": "rs",
    "sv": "se", "th": "th", "tr": "tr", "uk": "ua", "ur": "pk", "uz": "uz", "vi": "vn", "zh": "cn hk tw",
}
SUFFIX_LANGUAGE = {s: lang for lang, all_of_it in SUFFIXES.items() for s in all_of_it.split()}
TRUST_SUFFIX = 0.8
UNKNOWN = "und"
MAX_BROADCAST_HOSTS = 200_000

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[ord("A") : ord("Z") + 1] += 32
for _b in [*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]:
    _FOLD[_b] = 0x20


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of lower-cased bytes; all that is not a letter counts as one space."""
    b = _FOLD[np.frombuffer(f" {text} ".encode("utf-8", "replace"), dtype=np.uint8)]
    b = b[np.concatenate(([True], (b[1:] != 0x20) | (b[:-1] != 0x20)))]
    if len(b) < 3:
        return np.empty(0, dtype=np.uint32)
    h = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return ((h * np.uint32(2654435761)) >> np.uint32(17)).astype(np.uint32)


@dataclass
class TextModel:
    """Trigram log likelihoods, one table for each fold of the rows it was fitted on; the table
    of a fold has not seen that fold's rows."""

    languages: list[str]
    log_p: np.ndarray  # (BUCKETS, languages + 1) or (folds, BUCKETS, languages + 1); the last is for text of no known language

    @property
    def folds(self) -> int:
        return len(self.log_p) if self.log_p.ndim == 3 else 1

    def log_likelihood(self, text: str | None, fold: int = 0) -> np.ndarray:
        """Log likelihoods, tempered so that long texts do not drown the other evidence."""
        log_p = self.log_p[fold] if self.log_p.ndim == 3 else self.log_p
        grams = trigrams(text) if text else np.empty(0, dtype=np.uint32)
        if not len(grams):
            return np.zeros(log_p.shape[1])
        counts = np.bincount(grams, minlength=BUCKETS) if len(grams) > 4096 else None
        total = counts @ log_p if counts is not None else log_p[grams].sum(0)
        return total * min(1.0, INDEPENDENT / len(grams))


def _fold(text: Column, folds: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(7), text), F.lit(folds)).cast("int")


def _primary(code: Column) -> Column:
    """The primary subtag of a language code, in lower case: en of en, EN-us and en_gb."""
    return F.regexp_extract(F.lower(code), r"^\s*([^\s_-]*)", 1)


def fit(labelled: DataFrame, text_col: str, label_col: str, sample_rows: int = SAMPLE_ROWS, folds: int = 1) -> TextModel:
    """Fits the text model on the ``sample_rows`` rows of each label that come first in hash order.

    Labels count by their primary subtag, as declarations do; every label that occurs
    with a text is fitted, however few rows it has.  With several ``folds``, dealt by a
    hash of the text, each text is judged by what the other folds taught: where the
    labels are also the declarations to be fused, a declaration is then not counted twice.
    A label that only one fold has is taught by that one to all.
    """
    rows = labelled.select(F.col(text_col).alias("body"), _primary(F.col(label_col)).alias("label"))
    rows = rows.where(F.col("body").isNotNull() & (F.length("label") > 0)).withColumn("h", F.xxhash64("body"))
    count = rows.groupBy("label").agg(F.count(F.lit(1)).alias("_rows"))  # one row a language
    # A hash threshold for each label keeps about twice the bound; the window then cuts to it.
    share = F.least(F.lit(1.0), 2.0 * sample_rows / F.col("_rows"))
    near = rows.join(F.broadcast(count), "label").where(F.pmod("h", F.lit(1 << 20)) < share * (1 << 20)).dropDuplicates(["label", "h"])
    first = near.withColumn("i", F.row_number().over(Window.partitionBy("label").orderBy("h"))).where(F.col("i") <= sample_rows)

    def make():
        def compute(texts):
            found = [np.unique(trigrams(t), return_counts=True) for t in texts]
            return [[g.astype(np.int32) for g, _ in found], [n.astype(np.int32) for _, n in found]]

        return compute

    fields = [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("gram", "n")]
    grams = add_columns(first.select("label", "body", _fold(F.col("body"), folds).alias("fold")), ["body"], fields, make, ("body",))
    cells = grams.select("label", "fold", F.explode(F.arrays_zip("gram", "n")).alias("c"))
    sums = cells.groupBy("label", "fold", "c.gram").agg(F.sum("c.n").alias("n")).toPandas()  # at most BUCKETS rows a language and fold
    got = {k: np.zeros((folds, BUCKETS)) for k in sums["label"].unique()}
    for (k, fold), part in sums.groupby(["label", "fold"]):
        got[k][fold, part["gram"].to_numpy()] = part["n"].to_numpy()
    if not got:
        return TextModel([], np.zeros((BUCKETS, 1)))
    languages, tables = sorted(got), []
    # Text of no known language: every trigram alike, at four times the chance of a bucket at random.
    other = np.full((BUCKETS, 1), np.log(4.0 / BUCKETS))
    for fold in range(folds):
        others = [got[k].sum(0) - got[k][fold] if folds > 1 else got[k][0] for k in languages]
        table = np.stack([x if x.any() else got[k].sum(0) for k, x in zip(languages, others, strict=True)], axis=1)
        tables.append(np.hstack([np.log((table + 0.1) / (table + 0.1).sum(0)), other]))
    return TextModel(languages, np.stack(tables))


def _posterior(log_like: np.ndarray, *factors: np.ndarray) -> np.ndarray:
    x = log_like + sum(np.log(f) for f in factors)
    x = np.exp(x - x.max())
    return x / x.sum()


def _declared(languages: list[str], code: str | None) -> np.ndarray:
    """Likelihood of a declaration (a primary subtag) under each language; none, or one unknown, says nothing."""
    out = np.ones(len(languages) + 1)
    if code in languages:
        out[:] = (1 - TRUST_DECLARED) / max(1, len(languages))
        out[languages.index(code)] = TRUST_DECLARED
    return out


def _suffix(languages: list[str], suffix: str | None) -> np.ndarray:
    out = np.ones(len(languages) + 1)
    spoken = SUFFIX_LANGUAGE.get((suffix or "").lower())
    if spoken in languages:
        out[:] = (1 - TRUST_SUFFIX) / max(1, len(languages))
        out[languages.index(spoken)] = TRUST_SUFFIX
    return out


def _smooth(counts: Column, prior: Column, weight: float) -> Column:
    """Shares of an array of counts, smoothed towards a prior; its expression does not grow with the languages."""
    whole = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x) + weight
    return F.zip_with(counts, prior, lambda c, p: (c + weight * p) / whole)


def identify(
    df: DataFrame,
    model: TextModel,
    text_col: str = "text",
    declared_col: str | None = "lang",
    host_col: str | None = "source",
    threshold: float = 0.5,
    keep_text: bool = True,
) -> DataFrame:
    """Adds ``lang_id``, ``lang_confidence`` and ``lang_rejected`` to ``df``.

    ``host_col`` holds host names; what follows the last dot is the suffix.  A row is
    rejected if its text has no letters, if text of no known language explains it
    best, or if no language reaches ``threshold``; ``lang_id`` is then ``und`` in the
    first two cases.  Null and empty texts have no letters.  A null or unknown
    declaration, host or suffix says nothing.  Repeated rows each count for their
    host.  Ties go to the language first by name.  An empty table gives an empty
    result.  Input columns with the name of an added column are replaced.
    """
    languages = model.languages
    shared = df.sparkSession.sparkContext.broadcast(model)
    host = F.lower(F.trim(F.col(host_col))) if host_col else F.lit(None).cast("string")
    suffix = F.when(host.contains("."), F.substring_index(host, ".", -1))
    names = {c: unused(f"_{c}", df) for c in ("host", "suffix", "declared", "fold", "prior", "key", "salt")}
    added = df.withColumns(
        {
            names["host"]: host,
            names["suffix"]: suffix,
            names["declared"]: _primary(F.col(declared_col)) if declared_col else F.lit(None).cast("string"),
            names["fold"]: _fold(F.coalesce(F.col(text_col), F.lit("")), model.folds),
        }
    )

    def of_text():
        def compute(texts, declared, suffixes, folds):
            out = []
            for t, d, s, f in zip(texts, declared, suffixes, folds, strict=True):
                like = shared.value.log_likelihood(t, f)
                out.append(_posterior(like, _declared(languages, d), _suffix(languages, s)).tolist() if like.any() else None)
            return [out]

        return compute

    # First reading: soft counts by host, which the counts by suffix and in all are sums of.
    n = len(languages) + 1
    slim = added.select(F.col(text_col).alias("text"), *[F.col(names[c]).alias(c) for c in ("host", "suffix", "declared", "fold")])
    probability = [T.StructField("p", T.ArrayType(T.DoubleType()))]
    soft = add_columns(slim, ["text", "declared", "suffix", "fold"], probability, of_text, ("text", "declared", "fold"))
    sums = F.array(*[F.sum(F.col("p")[i]) for i in range(n)])
    by_host = materialize(soft.where(F.col("p").isNotNull()).groupBy("host", "suffix").agg(sums.alias("n")), "by-host")
    by_suffix = by_host.groupBy("suffix").agg(F.array(*[F.sum(F.col("n")[i]) for i in range(n)]).alias("n"))
    total = by_suffix.agg(F.array(*[F.coalesce(F.sum(F.col("n")[i]), F.lit(0.0)) for i in range(n)]).alias("n"))  # one row
    total = total.select(_smooth(F.col("n"), F.array_repeat(F.lit(1.0 / n), n), float(n)).alias("top"))
    suffixes = by_suffix.join(F.broadcast(total)).select(F.col("suffix").alias("s"), _smooth(F.col("n"), F.col("top"), SUFFIX_WEIGHT).alias("mid"))
    # Suffixes are far fewer than hosts; the join below is planned by Spark from their size.
    priors = by_host.where(F.col("host").isNotNull()).join(suffixes, F.expr("suffix <=> s"))
    priors = priors.select(F.col("host").alias(names["key"]), _smooth(F.col("n"), F.col("mid"), HOST_WEIGHT).alias(names["prior"]))
    joined = _with_prior(added, priors, names)

    def fused():
        def compute(texts, declared, suffixes, folds, prior):
            found, confidence, rejected = [], [], []
            for t, d, s, f, p in zip(texts, declared, suffixes, folds, prior, strict=True):
                like = shared.value.log_likelihood(t, f)
                if not languages or not like.any():
                    found.append(UNKNOWN), confidence.append(0.0), rejected.append(True)
                    continue
                q = _posterior(like, _declared(languages, d), _suffix(languages, s), np.array(p) if p else np.ones(n))
                best = int(q.argmax())
                found.append([*languages, UNKNOWN][best])
                confidence.append(round(float(q[best]), 6))
                rejected.append(best == n - 1 or q[best] < threshold)
            return [found, confidence, rejected]

        return compute

    fields = [
        T.StructField("lang_id", T.StringType()),
        T.StructField("lang_confidence", T.DoubleType()),
        T.StructField("lang_rejected", T.BooleanType()),
    ]
    evidence = [names[c] for c in ("declared", "suffix", "fold", "prior")]
    drop = (names["host"], *evidence) + (() if keep_text else (text_col,))
    return add_columns(joined, [text_col, *evidence], fields, fused, drop)


def _with_prior(df: DataFrame, priors: DataFrame, names: dict[str, str]) -> DataFrame:
    """Joins the hosts' priors: broadcast up to MAX_BROADCAST_HOSTS hosts, else on salted keys."""
    host, key = F.col(names["host"]), F.col(names["key"])
    priors = materialize(priors, "host-priors")
    if priors.count() <= MAX_BROADCAST_HOSTS:
        return df.join(F.broadcast(priors), host == key, "left").drop(names["key"])
    salts = 32  # a hot host's rows go to this many tasks
    salted = priors.withColumn(names["salt"], F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    mine = unused("_mine", df, list(names.values()))
    rows = df.withColumn(mine, F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    return rows.join(salted, (host == key) & (F.col(mine) == F.col(names["salt"])), "left").drop(names["key"], mine, names["salt"])


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, fit(docs, "text", "lang", folds=2), keep_text=False)
    return found.select("doc_id", "lang", "lang_id", "lang_confidence", "lang_rejected")

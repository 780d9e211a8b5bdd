"""Benchmark decontamination.

A hash set of normalised test n-grams is broadcast; windows of the training words
are looked up in it, every hit is verified word by word, and the hit spans or the
whole documents are removed.

The broadcast is bounded: benchmark items are dealt by a hash into blocks of about
``block_bytes`` of text, whose index is some five times that, and the documents are
scanned once for each block.  The usual benchmark is one block.  No document is shuffled.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, materialize, unused

#: A-Z become a-z; digits, a-z and all bytes above 0x7F are parts of words; the rest separates.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b > 0x7F else 0x20 for b in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    """The lower-cased words of a text, as UTF-8; none for null."""
    return text.encode("utf-8", "replace").translate(_FOLD).split() if text else []


def _window_hashes(w: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words, from the words' hashes."""
    h = np.zeros(len(w) - size + 1, dtype=np.uint64)
    for k in range(size):
        h = (h ^ w[k : len(w) - size + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


_KEPT_WORDS = 150_000
_kept: dict[bytes, int] = {}


def _word_hashes(found: list[bytes]) -> np.ndarray:
    """64-bit hashes of words; a worker keeps those of words it has seen, up to a bound."""
    if len(_kept) > _KEPT_WORDS:
        _kept.clear()
    out = [_kept.get(w) for w in found]
    for i, h in enumerate(out):
        if h is None:
            h = out[i] = xxhash.xxh3_64_intdigest(found[i])
            if len(found[i]) <= 64:
                _kept[found[i]] = h
    return np.array(out, dtype=np.uint64)


class NgramIndex:
    """The windows of a block of items, in flat arrays: about five bytes for each byte of text.

    ``text`` is the items' words joined by spaces.  For each window length there are the
    windows' hashes, sorted, with the word each begins at, and a bit table of the hashes
    that most other windows fail at once.
    """

    def __init__(self, items: list[tuple[str | None, str | None]], n: int):
        parts, self.names, lengths = [], [], []
        for item, text in items:
            found = words(text)
            if found:
                parts.append(b" ".join(found))
                self.names.append(item)
                lengths.append(len(found))
        self.text = b" ".join(parts)
        flat = np.frombuffer(self.text + b" ", dtype=np.uint8)
        self.ends = np.flatnonzero(flat == 0x20).astype(np.int32)  # where each word ends
        self.first = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)  # each item's first word
        hashes = _word_hashes(self.text.split(b" ")) if parts else np.empty(0, dtype=np.uint64)
        lengths = np.array(lengths, dtype=np.int64)
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, int]] = {}
        for size in sorted(set(np.minimum(lengths, n).tolist())):
            mine = np.flatnonzero(np.minimum(lengths, n) == size)
            at = np.concatenate([np.arange(self.first[i], self.first[i + 1] - size + 1, dtype=np.int32) for i in mine])
            h = _window_hashes(hashes, size)[at]
            order = np.argsort(h, kind="stable")
            h, at = h[order], at[order]
            bits = max(10, int(len(h) * 8).bit_length())
            table = np.zeros(1 << bits - 3, dtype=np.uint8)
            low = h & np.uint64((1 << bits) - 1)
            np.bitwise_or.at(table, (low >> np.uint64(3)).astype(np.int64), np.uint8(1) << (low & np.uint64(7)).astype(np.uint8))
            self.windows[size] = (h, at, table, bits)

    def nbytes(self) -> int:
        """Bytes of the index."""
        arrays = [x for w in self.windows.values() for x in w[:3]] + [self.ends, self.first]
        return len(self.text) + sum(x.nbytes for x in arrays)

    def _words_at(self, word: int, size: int) -> bytes:
        start = int(self.ends[word - 1]) + 1 if word else 0
        return self.text[start : int(self.ends[word + size - 1])]

    def scan(self, found: list[bytes]) -> tuple[list[int], set]:
        """The hit windows, flat as start, end, start, end ..., and the items they are of."""
        spans, items = [], set()
        if not found:
            return spans, items
        hashes = _word_hashes(found)
        for size, (known, at, table, bits) in self.windows.items():
            if len(found) < size:
                continue
            h = _window_hashes(hashes, size)
            low = h & np.uint64((1 << bits) - 1)
            maybe = np.flatnonzero(table[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8) & 1)
            if not len(maybe):
                continue
            lo, hi = np.searchsorted(known, h[maybe], "left"), np.searchsorted(known, h[maybe], "right")
            for i, a, b in zip(maybe.tolist(), lo.tolist(), hi.tolist(), strict=True):
                if a == b:
                    continue
                window = b" ".join(found[i : i + size])
                same = [w for w in at[a:b].tolist() if self._words_at(w, size) == window]
                if same:
                    spans += (i, i + size)
                    items.update(self.names[k] for k in np.searchsorted(self.first, same, "right") - 1)
        return spans, items


def _covered(spans: list[int]) -> list[tuple[int, int]]:
    """Disjoint word ranges that cover the windows."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _without(text: str, ranges: list[tuple[int, int]]) -> str:
    """The text without the words of the ranges; one space stands where a range was."""
    at = [m.span() for m in _WORD.finditer(text)]
    parts, last = [], 0
    for a, b in ranges:
        parts.append(text[last : at[a][0]].rstrip())
        last = at[b - 1][1]
    parts.append(text[last:])
    return " ".join(p for p in parts if p.strip())


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    n: int = 10,
    action: str = "flag",
    keep_text: bool = True,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """Finds the words of ``docs`` that lie in windows of ``n`` words of the benchmark.

    An item of fewer words, but not none, is one window.  Adds ``n_words``,
    ``n_hit``, ``n_items``, ``item_ids`` (array of strings, sorted, distinct),
    ``hit_spans`` (array of word ranges start:end) and ``contaminated``.

    action: ``flag`` keeps all rows; ``drop`` removes contaminated rows;
    ``clean`` cuts the hit spans out of the text.

    Null texts and texts without words have no words and are never hit.  Items with
    a null or empty text have no window; the words of an item with a null id count
    as hit but it is not among the items.  Repeated items count once, repeated
    documents are rows of their own.  Either table may be empty.  Input columns
    with the name of an added column are replaced.
    """
    sized = benchmark.select(
        F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("body")
    ).where(F.length("body") > 0)
    total = sized.agg(F.sum(F.octet_length("body")).alias("b")).first()["b"] or 0
    blocks = -(-total // block_bytes) or 1
    at, of = unused("_spans", docs), unused("_items", docs)
    state = [T.StructField(at, T.ArrayType(T.IntegerType())), T.StructField(of, T.ArrayType(T.StringType()))]
    df = docs
    for b in range(blocks):
        mine = sized.where(F.pmod(F.xxhash64("body"), F.lit(blocks)) == b)
        index = docs.sparkSession.sparkContext.broadcast(NgramIndex([tuple(r) for r in mine.collect()], n))

        def make(index=index, first=b == 0):
            def compute(texts, spans=None, items=None):
                out = ([], [])
                for i, text in enumerate(texts):
                    s, hit = index.value.scan(words(text))
                    known = hit - {None}
                    out[0].append(s if first else spans[i] + s)
                    out[1].append(list(known) if first else list(known | set(items[i])))
                return out

            return compute

        df = add_columns(df, [text_col] + [at, of] * (b > 0), state, make)
        if b + 1 < blocks:
            df = materialize(df, "decontaminate")
    return _finish(df, text_col, at, of, action, keep_text)


def _finish(df: DataFrame, text_col: str, at: str, of: str, action: str, keep_text: bool) -> DataFrame:
    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("n_items", T.LongType()),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
        T.StructField("hit_spans", T.ArrayType(T.StringType())),
        T.StructField("contaminated", T.BooleanType()),
    ]
    if action == "clean":
        cleaned = unused("_clean", df)
        fields.append(T.StructField(cleaned, T.StringType()))

    def make():
        def compute(texts, spans, items):
            out = [[] for _ in fields]
            for text, s, hit in zip(texts, spans, items, strict=True):
                ranges = _covered(s)
                row = [
                    len(words(text)),
                    sum(b - a for a, b in ranges),
                    len(hit),
                    sorted(hit),
                    [f"{a}:{b}" for a, b in ranges],
                    bool(ranges),
                ]
                if action == "clean":
                    row.append(_without(text, ranges) if ranges else text)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            return out

        return compute

    drop = (at, of) + (() if keep_text and action != "clean" else (text_col,))
    df = add_columns(df, [text_col, at, of], fields, make, drop)
    if action == "drop":
        return df.where(~F.col("contaminated"))
    return df.withColumnRenamed(cleaned, text_col) if action == "clean" else df


def query(spark, sf_dir: str) -> DataFrame:
    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"), keep_text=False)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


SQL = r"""
WITH words AS (
  SELECT rowid AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item, size, array_to_string(w[i : i + size - 1], ' ') AS gram
  FROM (SELECT item, w, least(10, len(w)) AS size, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i
        FROM items WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT size FROM windows
), grams AS (
  SELECT r, size, i, array_to_string(w[i : i + size - 1], ' ') AS gram
  FROM (SELECT r, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM words, sizes WHERE len(w) >= size)
), hits AS (
  SELECT g.r, g.i, g.size, v.item FROM grams g JOIN windows v ON g.size = v.size AND g.gram = v.gram
), positions AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(generate_series(i, i + size - 1)) AS p FROM (SELECT DISTINCT r, i, size FROM hits))
  GROUP BY r
), found AS (
  SELECT r, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(p.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(f.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(f.ids, '')) AS items_sha256,
  coalesce(p.n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN positions p ON w.r = p.r LEFT JOIN found f ON w.r = f.r
"""

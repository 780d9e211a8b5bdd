"""Exact token counts at every prefix, by dynamic programming.

A byte-pair vocabulary encodes a text uniquely, and each prefix of a word extends a
shorter prefix by one last token: the longest vocabulary entry that ends there and
is compatible with the last token of the shorter prefix (two tokens are compatible
if merging their joined text gives just these two).  So the count at prefix i is the
count at i - len(token) plus the token's own, found once for each distinct word and
kept; a text's counts are running sums over its words.  Truncation and budget
questions read the table and encode nothing again.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import add_columns, table

SPACE = "▁"
#: Distinct words whose counts a worker keeps; beyond it they are forgotten and made again.
KEPT_WORDS, KEPT_LENGTH = 700_000, 64


class PrefixCounter:
    """Token counts of prefixes under a SentencePiece byte-pair model with byte fallback.

    The model file gives the pieces and their scores.  The model must leave texts as
    they are but for a leading space and the space sign, and no piece may have the
    space sign after another character; both are checked.
    """

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.vocab_size())
        skip = {i for i in ids if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)}
        self.scores = {sp.id_to_piece(i): sp.get_score(i) for i in ids if i not in skip}
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.scores):
            raise ValueError("a piece goes over the start of a word or line")
        if sp.normalize(" a  Åﬁ\n") != SPACE * 2 + "a" + SPACE * 2 + "Åﬁ\n":
            raise ValueError("the model changes texts")
        self.longest = max(map(len, self.scores))
        self.pieces = list(self.scores)
        self.letters = {p for p in self.pieces if len(p) == 1}
        # Every occurrence of a piece in a word, the longest of an end first.
        self.finder = ahocorasick.Automaton()
        for i, p in enumerate(self.pieces):
            self.finder.add_word(p, (len(p), i))
        self.finder.make_automaton()
        self.fits: dict[int, bool] = {}
        self.totals: dict[str, int] = {}

    def merged(self, text: str) -> list[str]:
        """Merges by score, ties leftmost, until no neighbours make a piece."""
        parts, scores = list(text), self.scores
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = scores.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, a: int, b: int) -> bool:
        """Whether two pieces stay apart when their texts are merged; a = -1 asks whether b comes of its own text."""
        key = (a << 20) | b
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > 2_000_000:
                self.fits.clear()
            parts = [self.pieces[b]] if a < 0 else [self.pieces[a], self.pieces[b]]
            known = self.fits[key] = self.merged("".join(parts)) == parts
        return known

    def word(self, text: str) -> list[int]:
        """The counts at prefixes 0 ... len(text) of a word that starts with its spaces."""
        if not self.letters.issuperset(text):
            return self._with_unknown(text)
        n = len(text)
        counts, last = [0] * (n + 1), [-1] * (n + 1)
        get, compatible = self.fits.get, self.compatible
        for end, (size, piece) in self.finder.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            start = end - size
            before = last[start]
            ok = get((before << 20) | piece)
            if ok is None:
                ok = compatible(before, piece)
            if ok:
                last[end] = piece
                counts[end] = counts[start] + 1
        return counts

    def _with_unknown(self, text: str) -> list[int]:
        """The same for words with characters that are no piece: these cost their bytes and part the word."""
        counts = [0]
        for part in re.split(f"([^{re.escape(''.join(sorted(set(text) & self.letters)))}])" if set(text) & self.letters else "(.)", text, flags=re.S):
            if not part:
                continue
            if part in self.letters or self.letters.issuperset(part):
                counts += [counts[-1] + c for c in self.word(part)[1:]]
            else:
                counts.append(counts[-1] + len(part.encode("utf-8", "replace")))
        return counts

    def total(self, text: str) -> int:
        done = self.word(text)[-1]
        if len(text) <= KEPT_LENGTH:
            if len(self.totals) >= KEPT_WORDS:
                self.totals.clear()
            self.totals[text] = done
        return done

    #: A line feed is no piece and so a word of its own.
    _words = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")

    def words(self, text: str) -> list[str]:
        return self._words.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def count(self, text: str) -> int:
        get, total = self.totals.get, self.total
        return sum([get(w) or total(w) for w in self.words(text)])

    def prefixes(self, text: str) -> np.ndarray:
        """Exact count at every prefix: entry i is that of ``text[:i]``, entry 0 is 0."""
        out = [0]  # of the leading space alone, which no prefix of the text is
        for w in self.words(text):
            out += [out[-1] + c for c in self.word(w)[1:]] if len(out) > 1 else self.word(w)[1:]
        table = np.array(out if text else [0, 0], dtype=np.int64)
        table[1] = 0  # the empty prefix has no token
        return table[1:]

    def cut(self, text: str, budget: int) -> int:
        """Length of the longest prefix of at most ``budget`` tokens."""
        return int(np.flatnonzero(self.prefixes(text) <= budget)[-1])


_loaded: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter a worker process and model file."""
    if path not in _loaded:
        _loaded[path] = PrefixCounter(path)
    return _loaded[path]


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def count_tokens(
    df: DataFrame, text_col: str = "text", path: str | None = None, limit: int = 4096, keep_text: bool = True
) -> DataFrame:
    """Adds ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``).

    Whole texts are counted; null counts as empty, and an empty text has no tokens.
    Rows are independent: null or repeated ids and repeated rows change nothing, and
    an empty table gives an empty result.  Input columns with the name of an added
    column are replaced.
    """
    path = path or vocabulary_path()

    def make():
        count = counter(path).count

        def compute(texts):
            n = [count(t) if t else 0 for t in texts]
            return [[len(t.encode("utf-8", "replace")) if t else 0 for t in texts], n, [x > limit for x in n]]

        return compute

    fields = [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
    ]
    return add_columns(df, [text_col], fields, make, () if keep_text else (text_col,))


def truncate(df: DataFrame, budget: int, text_col: str = "text", path: str | None = None) -> DataFrame:
    """Cuts every text to its longest prefix of at most ``budget`` tokens (``truncated_text``).

    Null stays null.  The count at the cut is ``truncated_tokens``.
    """
    path = path or vocabulary_path()

    def make():
        of = counter(path)

        def compute(texts):
            ends = [of.cut(t, budget) if t else 0 for t in texts]
            cuts = [t[:e] if t is not None else None for t, e in zip(texts, ends, strict=True)]
            return [cuts, [of.count(c) if c else 0 for c in cuts]]

        return compute

    fields = [T.StructField("truncated_text", T.StringType()), T.StructField("truncated_tokens", T.LongType())]
    return add_columns(df, [text_col], fields, make)


def prefix_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, prefix_tokens): the array of counts at every prefix, from the empty one on."""
    path = path or vocabulary_path()

    def make():
        of = counter(path)
        return lambda texts: [[of.prefixes(t or "").tolist() for t in texts]]

    fields = [T.StructField("prefix_tokens", T.ArrayType(T.LongType()))]
    return add_columns(df.select(id_col, text_col), [text_col], fields, make, (text_col,))


def query(spark, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)

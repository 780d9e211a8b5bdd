"""Phrase collocations, counted in HAT-tries.

Each task counts the phrases of its texts in a trie of word ids (``PhraseTrie``): below each first
word is a hash container of what follows, which bursts into one for each second word once it
holds ``BURST`` phrases.  At ``LIMIT`` phrases the largest subtrees are
spilled whole, as sorted runs of (phrase, count), until half is free.  The runs go to the partition of their prefix, the first word, where they are merged; a hot first
word's phrases are dealt by the whole phrase.

A phrase cannot be frequent unless its words and pairs of words are.  So texts are read four times: words are
counted first, then pairs of frequent words by their hashed place in a filter, then longer phrases of such pairs in the same way, and then
the phrases that pass both filters in tries, exactly.
Counts by place are shuffled as blocks of places, a byte or two for each.
What is frequent is passed on as a bitmap of ``FILTER_BITS`` hashed bits, whose size does not
depend on the corpus: a full one lets more phrases through to be counted, and changes no count.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, ship, small_batches, table, with_value

#: Words of the longest phrase.
LONGEST = 4
#: Phrases of a container before it bursts, and of a task's tries before they spill.
BURST, LIMIT = 4096, 500_000
#: Different pairs that a task holds, two numbers each.
PAIR_LIMIT = 4_000_000
#: Words whose id, or whose absence from the filter, a task keeps; longer words than this are looked up each time.
KEPT_WORDS, KEPT_LENGTH = 400_000, 64
#: A word's id in a packed sequence.
ID_BITS = 21
#: Words that are taken together before they are counted.
BATCH_WORDS = 300_000
FILTER_BITS = 1 << 26
UNKNOWN = "und"
#: A first word with more than one in so many of all words is hot.
HOT_SHARE = 1000
#: Parts that each language's candidates are ranked in before the final ranking.
RANK_PARTS = 64

#: Characters that part pieces; the first, which no word holds, stands for all of them.
_SEPARATORS = "\n.,;:!?\x0B\x0C\x0D"
_END = _SEPARATORS[0]
#: Phrases that are written as one run.
RUN_ROWS = 1 << 16
_MASK = (1 << ID_BITS) - 1
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BLOCKS = pa.schema([("part", pa.int32()), ("gaps", pa.binary()), ("n", pa.binary())])
_BITS = pa.schema([("part", pa.int32()), ("bits", pa.binary())])
RUN = "prefix long, lang string, phrase string, f long"


def words_of(text: str) -> list[str]:
    """The words of a text, with ``_END`` between its pieces."""
    for c in _SEPARATORS:
        if c in text:
            text = text.replace(c, f" {_END} ")
    return list(filter(None, text.replace("\t", " ").split(" ")))


def hash_of(lang: str, word: str) -> int:
    return xxhash.xxh64_intdigest(f"{lang}\t{word}".encode(), seed=42)


def mixed(*hashes: np.ndarray) -> np.ndarray:
    """A hash of each sequence of words from the words' hashes (unsigned 64-bit)."""
    out = hashes[0]
    for h in hashes[1:]:
        out = (out ^ (out >> np.uint64(29))) * _M1 + h
    return (out ^ (out >> np.uint64(31))) * _M2


def _place(mix: np.ndarray) -> np.ndarray:
    """The bit of the filter."""
    return (mix >> np.uint64(65 - FILTER_BITS.bit_length())).astype(np.int64)


class Inner:
    """A node of the trie below the first word: a container for each second word."""

    __slots__ = ("kids",)

    def __init__(self) -> None:
        self.kids: dict[int, dict[int, int]] = {}

    def add(self, rest: int, n: int) -> int:
        """Adds a count; gives 1 if the phrase is new."""
        second, rest = rest >> 2 * ID_BITS, rest & (1 << 2 * ID_BITS) - 1
        kid = self.kids.get(second)
        if kid is None:
            kid = self.kids[second] = {}
        old = kid.get(rest)
        kid[rest] = n + (old or 0)
        return old is None


class PhraseTrie:
    """Counts sequences of two to four word ids.

    Below each first word is a hash container of what follows, three ids packed into one number (absent ones are 0).
    A container of more than ``burst_at`` longer sequences bursts into one for each second word.
    """

    def __init__(self, longest: int, burst_at: int = BURST) -> None:
        self.root: dict[int, Inner | dict[int, int]] = {}
        self.longest, self.burst_at, self.size = longest, burst_at, 0

    def add(self, first: np.ndarray, rest: np.ndarray) -> None:
        """Counts many sequences; equal ones are put together before they meet the containers."""
        if not len(first):
            return
        order = np.lexsort((rest, first))
        first, rest = first[order], rest[order]
        new = np.flatnonzero(np.concatenate(([True], (first[1:] != first[:-1]) | (rest[1:] != rest[:-1]))))
        times = np.diff(np.append(new, len(first))).tolist()
        first, rest = first[new], rest[new].tolist()
        begins = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
        ends = np.append(begins[1:], len(first)).tolist()
        for word, a, b in zip(first[begins].tolist(), begins.tolist(), ends, strict=True):
            node = self.root.get(word)
            if node is None:
                node = self.root[word] = {}
            if type(node) is Inner:
                self.size += sum(map(node.add, rest[a:b], times[a:b]))
                continue
            before, get = len(node), node.get
            for r, n in zip(rest[a:b], times[a:b], strict=True):
                node[r] = get(r, 0) + n
            self.size += len(node) - before
            if len(node) > self.burst_at and self.longest > 2:  # pairs would not part
                made = self.root[word] = Inner()
                for r, n in node.items():
                    made.add(r, n)

    def spill(self, keep: int) -> Iterator[tuple[int, list[int], list[int]]]:
        """Takes out the largest subtrees, a run of (first word, rests, counts) each, until ``keep`` phrases are left."""
        size = lambda node: sum(map(len, node.kids.values())) if type(node) is Inner else len(node)
        for n, word in sorted(((size(node), word) for word, node in self.root.items()), reverse=True):
            if self.size <= keep:
                break
            node = self.root.pop(word)
            self.size -= n
            if type(node) is Inner:
                yield word, [second << 2 * ID_BITS | r for second, kid in node.kids.items() for r in kid], [n for kid in node.kids.values() for n in kid.values()]
            else:
                yield word, list(node), list(node.values())


class Lookup:
    """Ids of a language's words that pass the filter, from 1; -1 stands for a word that does not, and for the end of a piece."""

    def __init__(self, lang: str, bits: bytes, hot: frozenset) -> None:
        self.lang, self.bits, self.hot_words = lang, np.frombuffer(bits, dtype=np.uint8), hot
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {_END: -1}
        self.names, self.hashes, self.hot = [""], [0], [False]

    def full(self) -> bool:
        return len(self.ids) >= KEPT_WORDS

    def has(self, mix: np.ndarray, bits: np.ndarray) -> np.ndarray:
        at = _place(mix)
        return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

    def of(self, words: list[str]) -> np.ndarray:
        get = self.ids.get
        out = np.array([get(w, 0) for w in words], dtype=np.int64)
        open_ = np.flatnonzero(out == 0)
        if len(open_):
            new = list({words[i] for i in open_.tolist()})
            hashes = [hash_of(self.lang, w) for w in new]
            known = dict.fromkeys(new, -1)
            for w, h, ok in zip(new, hashes, self.has(mixed(np.array(hashes, dtype=np.uint64)), self.bits).tolist(), strict=True):
                if ok:
                    known[w] = len(self.names)
                    self.names.append(w)
                    self.hashes.append(h)
                    self.hot.append((self.lang, w) in self.hot_words)
                if ok or len(w) <= KEPT_LENGTH:
                    self.ids[w] = known[w]
            out[open_] = [known[words[i]] for i in open_.tolist()]
        return out

    def runs_of(self, subtrees: Iterator[tuple[int, list[int], list[int]]]) -> Iterator[tuple[str, list, list, list]]:
        """Subtrees as sorted runs of RUN_ROWS phrases or more: language, partitions of the prefixes, phrases, counts."""
        firsts: list[int] = []
        rests: list[int] = []
        counts: list[int] = []
        for word, rest, n in subtrees:
            firsts += [word] * len(rest)
            rests += rest
            counts += n
            if len(counts) >= RUN_ROWS:
                yield self._run(firsts, rests, counts)
                firsts, rests, counts = [], [], []
        if counts:
            yield self._run(firsts, rests, counts)

    def _run(self, firsts: list[int], rests: list[int], counts: list[int]) -> tuple[str, list, list, list]:
        first, rest = np.array(firsts, dtype=np.int64), np.array(rests, dtype=np.int64)
        ids = [first, rest >> 2 * ID_BITS, rest >> ID_BITS & _MASK, rest & _MASK]
        names = self.names
        phrases = [f"{names[a]} {names[b]}" for a, b in zip(firsts, ids[1].tolist(), strict=True)]
        for more in ids[2:]:
            if more.any():
                phrases = [f"{p} {names[i]}" if i else p for p, i in zip(phrases, more.tolist(), strict=True)]
        hashes = np.array(self.hashes, dtype=np.uint64)
        prefix = np.where(np.array(self.hot)[first], mixed(*(hashes[x] for x in ids)), mixed(hashes[first])).view(np.int64)
        order = sorted(range(len(phrases)), key=phrases.__getitem__)
        return self.lang, prefix[order].tolist(), [phrases[i] for i in order], [counts[i] for i in order]


def _count_words(rows: Iterator[tuple[str, str]], limit: int) -> Iterator[tuple[str, list, list, list]]:
    """Runs of words as (lang, prefixes, words, counts); the word that stands for all words is null, and prefixes are not needed."""
    seen: dict[str, Counter] = {}
    size = 0

    def run_of(lang, counts):
        total = sum(counts.values()) - counts.pop(_END, 0)
        words = sorted(counts)
        return lang, [0] * (len(words) + 1), [*words, None], [*map(counts.__getitem__, words), total]

    for lang, text in rows:
        counts = seen.setdefault(lang, Counter())
        size -= len(counts)
        counts.update(words_of(text))
        size += len(counts)
        if size > limit:
            for other, c in seen.items():
                yield run_of(other, c)
            seen, size = {}, 0
    for lang, c in seen.items():
        yield run_of(lang, c)


def _begins(ok: np.ndarray, n: int) -> np.ndarray:
    """Where sequences of ``n`` words begin whose neighbouring pairs are all ``ok``."""
    if len(ok) < n - 1:
        return np.empty(0, dtype=np.int64)
    return np.flatnonzero(np.logical_and.reduce([ok[i : len(ok) - n + 2 + i] for i in range(n - 1)]))


def _hashes_at(lookup: Lookup, ids: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    hashes = np.array(lookup.hashes, dtype=np.uint64)
    return mixed(*(hashes[ids[at + i]] for i in range(n)))


def _sequences(ids: np.ndarray, ok: np.ndarray, longest: int, passes: Callable[[np.ndarray, int], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(first, rest) of all sequences of two or more words whose neighbouring pairs are all ``ok``; of those longer than pairs, of such
    as pass, by where they begin and their length."""
    firsts, rests = [], []
    for n in range(2, longest + 1):
        at = _begins(ok, n)
        if n > 2 and passes is not None:
            at = at[passes(at, n)]
        firsts.append(ids[at])
        rests.append(sum((ids[at + i] << (3 - i) * ID_BITS for i in range(1, n)), np.zeros(len(at), dtype=np.int64)))
    return np.concatenate(firsts), np.concatenate(rests)


def _batches(rows: Iterator[tuple[str, str]], lookups: dict[str, Lookup], words: bytes, hot: frozenset) -> Iterator[list[tuple[Lookup, np.ndarray]]]:
    """Of BATCH_WORDS words each, the ids of each language's words, ends of pieces among them."""
    waiting: dict[str, list[str]] = {}
    n = 0

    def taken():
        for lang in waiting:
            if lang not in lookups:
                lookups[lang] = Lookup(lang, words, hot)
        out = [(lookups[lang], lookups[lang].of(found)) for lang, found in waiting.items()]
        waiting.clear()
        return out

    for lang, text in rows:
        found = words_of(text)
        waiting.setdefault(lang, []).extend(found)
        waiting[lang].append(_END)
        n += len(found) + 1
        if n >= BATCH_WORDS:
            yield taken()
            n = 0
    yield taken()


def _pair_hashes(lookup: Lookup, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which neighbours are known words both, and the hashes of those pairs."""
    hashes = np.array(lookup.hashes, dtype=np.uint64)
    known = (ids[:-1] > 0) & (ids[1:] > 0)
    return known, mixed(hashes[ids[:-1][known]], hashes[ids[1:][known]])


def _count_places(rows: Iterator[tuple[str, str]], words: bytes, pairs: bytes | None, limit: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of (place in the filter, count), by place, of the pairs of known words, or, if there is a filter of ``pairs``, of the longer
    sequences of pairs that pass it; a task holds ``limit`` places, or those of two batches."""
    bits = None if pairs is None else np.frombuffer(pairs, dtype=np.uint8)

    def hashes_of(lookup: Lookup, ids: np.ndarray) -> np.ndarray:
        ok, hashes = _pair_hashes(lookup, ids)
        if bits is None:
            return hashes
        ok[ok] = lookup.has(hashes, bits)
        return np.concatenate([_hashes_at(lookup, ids, _begins(ok, n), n) for n in range(3, longest + 1)])

    lookups: dict[str, Lookup] = {}
    held: list[np.ndarray] = []
    times: list[np.ndarray] = []

    def merged():
        every, n = np.concatenate(held), np.concatenate(times)
        order = np.argsort(every, kind="stable")
        every, n = every[order], n[order]
        new = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
        return every[new], np.add.reduceat(n, new)

    size = 0
    for batch in _batches(rows, lookups, words, frozenset()):
        for lookup, ids in batch:
            found, n = np.unique(_place(hashes_of(lookup, ids)).astype(np.int32), return_counts=True)
            held.append(found)
            times.append(n)
            size += len(found)
            if lookup.full():
                lookup.clear()
        if size > limit:
            held[:], times[:] = ([x] for x in merged())
            size = len(held[0])
            if size > limit // 2:
                yield held.pop(), times.pop()
                size = 0
    if size:
        yield merged()


def _count_phrases(
    rows: Iterator[tuple[str, str]], words: bytes, pairs: bytes, longer: bytes, hot: frozenset, limit: int, longest: int
) -> Iterator[tuple[str, list, list, list]]:
    """Runs of (lang, prefixes, phrases, counts): phrases of two words and more, of words, pairs and longer sequences that pass the filters."""
    lookups: dict[str, Lookup] = {}
    tries: dict[str, PhraseTrie] = {}
    bits, long_bits = np.frombuffer(pairs, dtype=np.uint8), np.frombuffer(longer, dtype=np.uint8)
    for batch in _batches(rows, lookups, words, hot):
        for lookup, ids in batch:
            trie = tries.setdefault(lookup.lang, PhraseTrie(longest))
            ok, hashes = _pair_hashes(lookup, ids)
            ok[ok] = lookup.has(hashes, bits)
            passes = lambda at, n, lookup=lookup, ids=ids: lookup.has(_hashes_at(lookup, ids, at, n), long_bits)
            trie.add(*_sequences(ids, ok, longest, passes))
            if lookup.full():  # its ids go, so its phrases do
                yield from lookup.runs_of(trie.spill(0))
                lookup.clear()
        while sum(t.size for t in tries.values()) > limit:
            lang, most = max(tries.items(), key=lambda x: x[1].size)
            yield from lookups[lang].runs_of(most.spill(most.size // 2))
    for lang, trie in tries.items():
        yield from lookups[lang].runs_of(trie.spill(0))


def _runs(texts: DataFrame, count: Callable[[Iterator[tuple[str, str]]], Iterator[tuple[str, list, list, list]]]) -> DataFrame:
    """The runs that the tasks spill, with the partition of each phrase's prefix."""

    def run(batches):
        rows = ((lang, text) for b in batches for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        held: list[list] = [[], [], [], []]

        def batch():
            types = (pa.int64(), pa.string(), pa.string(), pa.int64())
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(held, types, strict=True)], names=["prefix", "lang", "phrase", "f"])
            for c in held:
                c.clear()
            return out

        for lang, prefix, phrase, n in count(rows):
            for at in range(0, len(phrase), 8192):
                part = phrase[at : at + 8192]
                for c, more in zip(held, (prefix[at : at + 8192], [lang] * len(part), part, n[at : at + 8192]), strict=True):
                    c += more
                if len(held[0]) >= 8192:
                    yield batch()
        if held[0]:
            yield batch()

    return texts.mapInArrow(run, RUN)


def _merged(runs: DataFrame) -> DataFrame:
    """(lang, phrase, f): the runs of each prefix partition merged."""
    return runs.repartition("prefix").groupBy("prefix", "lang", "phrase").agg(F.sum("f").alias("f")).drop("prefix")


def _key(lang, phrase):
    """Phrases hold no tabs, so the last tab parts language and phrase."""
    return F.concat(lang, F.lit("\t"), phrase)


def word_places(words: DataFrame) -> DataFrame:
    """(at): the places of words (lang, phrase) in the filter."""

    def run(batches):
        for b in batches:
            hashes = [hash_of(lang, w) for lang, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            at = _place(mixed(np.array(hashes, dtype=np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32))], names=["at"])

    return words.select("lang", "phrase").mapInArrow(run, "at int")


def bitmap(places: DataFrame) -> bytes:
    """The filter of places (at): FILTER_BITS bits, whatever their number."""
    bits = places.select("at").distinct().withColumn("part", F.shiftright("at", 16))

    def packed(key, t):
        at = t.column("at").to_numpy() & 0xFFFF
        of = np.zeros(1 << 16, dtype=bool)
        of[at] = True
        made = np.packbits(of, bitorder="little").tobytes()
        return pa.table({"part": [key[0].as_py()], "bits": [made]}, schema=pa.schema([("part", pa.int32()), ("bits", pa.binary())]))

    return _filter_of(bits.groupBy("part").applyInArrow(packed, "part int, bits binary"))


def _blocks(at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """A run of ascending places and their counts as blocks (part, gaps, n): low and high bytes of the gaps between places, and bytes of the counts."""
    begins = np.flatnonzero(np.concatenate(([True], at[1:] >> 16 != at[:-1] >> 16)))
    gaps, counts = [], []
    for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(at)], strict=True):
        gap = np.diff(at[a:b] & 0xFFFF, prepend=0).astype("<u2")
        gaps.append(gap.view(np.uint8).reshape(-1, 2).T.tobytes())
        few = n[a:b].max() < 256
        counts.append(n[a:b].astype(np.uint8 if few else "<i8").tobytes())
    return pa.RecordBatch.from_arrays([pa.array(at[begins] >> 16, pa.int32()), pa.array(gaps, pa.binary()), pa.array(counts, pa.binary())], schema=_BLOCKS)


def _places_and_counts(gaps: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """What ``_blocks`` has packed: places within the part, and counts."""
    k = len(gaps) // 2
    at = np.cumsum(np.ascontiguousarray(np.frombuffer(gaps, dtype=np.uint8).reshape(2, -1).T).view("<u2").ravel(), dtype=np.int64)
    return at, np.frombuffer(counts, dtype=np.uint8 if len(counts) == k else "<i8")


def _frequent_places(texts: DataFrame, count: Callable[[Iterator[tuple[str, str]]], Iterator[tuple[np.ndarray, np.ndarray]]], least: int) -> bytes:
    """The filter of the places that all tasks together count ``least`` times."""

    def run(batches):
        rows = ((lang, text) for b in batches for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        for at, n in count(rows):
            yield _blocks(at, n)

    def add(batches):
        part, total = None, np.zeros(1 << 16, dtype=np.int64)
        made = lambda: pa.RecordBatch.from_pydict({"part": [part], "bits": [np.packbits(total >= least, bitorder="little").tobytes()]}, schema=_BITS)
        for b in batches:
            for i, gaps, counts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if i != part:
                    if part is not None:
                        yield made()
                    part = i
                    total[:] = 0
                at, n = _places_and_counts(gaps, counts)
                total[at] += n
        if part is not None:
            yield made()

    sums = texts.mapInArrow(run, "part int, gaps binary, n binary").repartition("part").sortWithinPartitions("part").mapInArrow(add, "part int, bits binary")
    return _filter_of(sums)


def _filter_of(parts: DataFrame) -> bytes:
    out = bytearray(FILTER_BITS >> 3)
    for r in parts.collect():  # FILTER_BITS / 8 bytes at most
        out[r.part << 13 : (r.part + 1) << 13] = r.bits
    return bytes(out)


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, longest: int = LONGEST, limit: int = LIMIT) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of every phrase of 1 to ``longest`` words that occurs ``least`` times, and (lang, n): all words."""
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    lower = F.translate(F.coalesce(F.col(text_col), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), lower.alias("text"))
    found = _runs(texts, lambda rows: _count_words(rows, limit)).drop("prefix")
    counted = found.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))  # combined by the tasks before
    words = materialize(counted.where((F.col("f") >= least) | F.col("phrase").isNull()), "words")
    totals = words.where("phrase IS NULL").select("lang", F.col("f").alias("n"))
    words = words.where("phrase IS NOT NULL")
    if longest < 2:
        return words, totals
    all_words = totals.agg(F.sum("n")).first()[0] or 0
    hot = frozenset((r.lang, r.phrase) for r in words.where(F.col("f") > all_words // HOT_SHARE).collect())  # HOT_SHARE rows at most
    word_bits = spark.sparkContext.broadcast(bitmap(word_places(words)))

    # By their place in the filter alone: phrases that fall together only let more phrases through.
    pair_bits = spark.sparkContext.broadcast(_frequent_places(texts, lambda rows: _count_places(rows, word_bits.value, None, PAIR_LIMIT, 2), least))
    long_bits = pair_bits  # of no use to pairs
    if longest > 2:
        long_bits = spark.sparkContext.broadcast(_frequent_places(texts, lambda rows: _count_places(rows, word_bits.value, pair_bits.value, PAIR_LIMIT, longest), least))
    runs = _runs(texts, lambda rows: _count_phrases(rows, word_bits.value, pair_bits.value, long_bits.value, hot, limit, longest))
    longer = materialize(_merged(runs).where(F.col("f") >= least), "phrases")
    word_bits.destroy()
    pair_bits.destroy()
    if long_bits is not pair_bits:
        long_bits.destroy()
    return words.unionByName(longer), totals


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = 30,
    top: int = 2000,
    longest: int = LONGEST,
    contained_percent: int = 80,
    limit: int = LIMIT,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    A phrase's score is floor(2000000 a / (l + r)) at the cut into two parts where it is lowest, the first of equal ones; a, l
    and r are how often the phrase and its parts occur within pieces of text, n the language's words.  A phrase
    that a longer one of at least ``contained_percent`` percent of its count contains is left out.

    Null texts are empty, the null language is ``und``.  Repeated rows and copies each count.  Ties go to the higher count,
    then to the phrase first in bytes.  Without phrases of ``least`` occurrences the result is empty; other columns play no part.
    """
    frequent, totals = frequent_phrases(docs, text_col, lang_col, least, longest, limit)
    words = F.split("phrase", " ")
    known = materialize(frequent.select(_key(F.col("lang"), F.col("phrase")).alias("key"), "lang", "phrase", "f", F.size(words).alias("m")), "frequent")
    values = known.select(F.col("key").alias("k"), F.col("f").alias("v"))
    phrases = known.where("m > 1")
    cut = phrases.select("key", "lang", "phrase", F.col("f").alias("a"), words.alias("w"), "m", F.explode(F.expr("sequence(1, m - 1)")).alias("cut"))
    cut = cut.select("key", "lang", "phrase", "a", "cut", _key(F.col("lang"), F.array_join(F.slice("w", 1, F.col("cut")), " ")).alias("first"), _key(F.col("lang"), F.array_join(F.slice("w", F.col("cut") + 1, F.col("m")), " ")).alias("rest"))
    cut = with_value(cut, "first", values).withColumnRenamed("v", "l")
    cut = with_value(cut, "rest", values).withColumnRenamed("v", "r")
    product = F.lit(2_000_000).cast("decimal(38,0)") * F.col("a")
    cut = cut.withColumn("product", product).withColumn("score", F.expr("product div (l + r)"))
    scored = cut.groupBy("key", "lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("c"))
    # What a longer phrase contains: each of its parts, with the highest count of those that contain it.
    longer = known.where("m > 2").select("lang", "f", words.alias("w"), "m")
    spans = F.expr("flatten(transform(sequence(2, m - 1), n -> transform(sequence(1, m - n + 1), i -> array_join(slice(w, i, n), ' '))))")
    inside = longer.select("lang", "f", F.explode(F.array_distinct(spans)).alias("phrase"))
    inside = inside.groupBy(_key(F.col("lang"), F.col("phrase")).alias("part")).agg(F.max("f").alias("most"))
    left = scored.join(inside, F.col("key") == F.col("part"), "left").where(F.col("most").isNull() | (100 * F.col("most") < contained_percent * F.col("a")))
    left = left.select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))).orderBy(*order)
    left = left.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)  # so that no task ranks a whole language
    left = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    of = totals.select(F.col("lang").alias("of"), "n")  # a row for each language
    return left.join(of, F.col("lang") == F.col("of")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), split AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), sized AS (
  SELECT lang, w, unnest([1, 2, 3, 4]) AS m FROM split
), placed AS (
  SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM sized WHERE len(w) >= m
), counts AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM placed GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE m = 1 GROUP BY lang
), phrases AS (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE m > 1 AND f >= 30
), cuts AS (
  SELECT *, unnest(range(1, m)) AS cut FROM phrases
), scores AS (
  SELECT c.lang, c.phrase, c.a, c.cut, l.f AS l, r.f AS r, CAST(CAST(2000000 AS HUGEINT) * c.a // (l.f + r.f) AS BIGINT) AS score
  FROM cuts c JOIN counts l ON l.lang = c.lang AND l.m = c.cut AND l.phrase = array_to_string(c.w[1:c.cut], ' ')
    JOIN counts r ON r.lang = c.lang AND r.m = c.m - c.cut AND r.phrase = array_to_string(c.w[c.cut + 1:], ' ')
), least AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), parts AS (
  SELECT lang, a, w, m, unnest(range(2, m)) AS n FROM phrases WHERE m > 2
), placed_parts AS (
  SELECT lang, a, w, n, unnest(range(1, m - n + 2)) AS i FROM parts
), inside AS (
  SELECT lang, array_to_string(w[i:i + n - 1], ' ') AS phrase, max(a) AS most FROM placed_parts GROUP BY ALL
), ranked AS (
  SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank, s.phrase, s.a, s.l, s.r, s.score
  FROM least s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE i.most IS NULL OR 100 * i.most < 80 * s.a
)
SELECT k.lang, k.rank, k.phrase, k.a, k.l, k.r, t.n, k.score FROM ranked k JOIN totals t ON t.lang = k.lang WHERE k.rank <= 2000
"""

"""Collocations, the Merkle manifest and toxicity against brute force."""

import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import merkle, phrases, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


# Collocations


def plain_collocations(rows, least, top=2000, longest=4):
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = [x for x in re.split(r"[\x20\x09]", piece) if x]
            total[lang] += len(w)
            counts.update((lang, tuple(w[i : i + n])) for n in range(1, longest + 1) for i in range(len(w) - n + 1))
    often = {k: n for k, n in counts.items() if n >= least and len(k[1]) > 1}
    out = []
    for lang in total:
        found = []
        for (of, p), a in often.items():
            if of != lang:
                continue
            inside = [q for (o, q), b in often.items() if o == lang and len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if inside:
                continue
            cuts = []
            for k in range(1, len(p)):
                l, r = counts[lang, p[:k]], counts[lang, p[k:]]
                cuts.append((math.floor(Fraction(2_000_000 * a, l + r)), k, l, r))
            score, _, l, r = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


@pytest.mark.parametrize(("limit", "least"), [(40, 3), (400_000, 5)])
def test_collocations_equal_brute_force(spark, limit, least):
    r = random.Random(limit)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "x y", "ſ", "o'o"]
    rows = []
    for _ in range(120):
        parts = [r.choice(vocabulary) + r.choice(["", "", " ", ",", "\t", ".", "\n", "\x0b"]) + " " for _ in range(r.randint(0, 40))]
        rows.append(("".join(parts).title() if r.random() < 0.3 else "".join(parts), r.choice(["en", "de", None, ""])))
    rows += [("hot pair of words " * 50, "en")] * 3 + [(None, "en"), ("", None), (" \t. ", "xx"), ("z" * 40_000 + " z", "en")]
    df = spark.createDataFrame([(*x, 1) for x in rows], "text string, lang string, score int").repartition(3)
    got = sorted(tuple(x) for x in phrases.collocations(df, least=least, limit=limit).collect())
    assert got == plain_collocations(rows, least)
    assert phrases.collocations(df, least=least, top=2).groupBy("lang").count().agg(F.max("count")).first()[0] == 2
    assert phrases.collocations(df.limit(0)).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    assert spark.sql("SELECT cast(2000000 AS decimal(38,0)) * 9000000000000001L div (9000000000000001L + 9000000000000002L) AS s").first().s == 999999


def test_trie_bursts_and_spills():
    r = random.Random(3)
    trie, want, got = phrases.PhraseTrie(4, burst_at=8), Counter(), Counter()
    for step in range(60):
        pairs = [(r.randint(1, 6), r.randint(1, 9) << 42 | r.randint(0, 3) << 21 | r.randint(0, 3)) for _ in range(r.randint(0, 100))]
        trie.add(np.array([a for a, _ in pairs], dtype=np.int64), np.array([b for _, b in pairs], dtype=np.int64))
        want.update(pairs)
        assert trie.size <= len(want)
        if step % 9 == 8:
            for word, rests, counts in trie.spill(trie.size // 2):
                got.update(dict(zip([(word, x) for x in rests], counts, strict=True)))
    assert any(isinstance(n, phrases.Inner) for n in trie.root.values())
    for word, rests, counts in trie.spill(0):
        got.update(dict(zip([(word, x) for x in rests], counts, strict=True)))
    assert got == want and trie.size == 0 and not trie.root


def test_sequences():
    ids = np.array([1, 2, 3, 4, -1, 5, 6, 7, 8])
    ok = np.array([True, True, True, False, False, True, False, True])
    first, rest = phrases._sequences(ids, ok, 4)
    pairs = [(1, 2 << 42), (2, 3 << 42), (3, 4 << 42), (5, 6 << 42), (7, 8 << 42)]
    longer = [(1, 2 << 42 | 3 << 21), (1, 2 << 42 | 3 << 21 | 4), (2, 3 << 42 | 4 << 21)]
    assert sorted(zip(first.tolist(), rest.tolist(), strict=True)) == sorted(pairs + longer)
    assert len(phrases._sequences(ids[:1], ok[:0], 4)[0]) == 0


def test_blocks_of_places_and_rare_long_phrases(spark):
    r = random.Random(4)
    at = np.array(sorted(r.sample(range(phrases.FILTER_BITS), 3000)) + [phrases.FILTER_BITS - 1], dtype=np.int32)
    n = np.array([r.choice([1, 2, 255, 70_000]) if a >> 16 < 500 else 1 for a in at.tolist()])
    got = {}
    for part, gaps, counts in zip(*(c.to_pylist() for c in phrases._blocks(at, n).columns), strict=True):
        places, times = phrases._places_and_counts(gaps, counts)
        got |= {(part << 16) + p: t for p, t in zip(places.tolist(), times.tolist(), strict=True)}
    assert got == dict(zip(at.tolist(), n.tolist(), strict=True))
    # Of pairs that are frequent, longer phrases that are not do not reach the tries.
    words = [f"w{i}" for i in range(12)]
    rows = [("en", " ".join(r.choice(words) for _ in range(50))) for _ in range(40)] + [("en", "w1 w2 w3.")] * 30
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    every = lambda rows: phrases._count_places(rows, b"\xff" * (phrases.FILTER_BITS // 8), b"\xff" * (phrases.FILTER_BITS // 8), 1000, 4)
    bits = phrases._frequent_places(df, every, 30)
    full = b"\xff" * (phrases.FILTER_BITS // 8)
    runs = phrases._count_phrases(iter(rows), full, full, bits, frozenset(), 1000, 4)
    counts = {p: f for _, _, found, fs in runs for p, f in zip(found, fs, strict=True)}
    long_ones = {p for p in counts if p.count(" ") > 1}
    assert "w1 w2 w3" in long_ones and len(long_ones) < 10 and sum(p.count(" ") == 1 for p in counts) == 144


def test_bitmap_keeps_every_hash(spark):
    mix = lambda lang, *w: phrases.mixed(*[np.array([phrases.hash_of(lang, x)], dtype=np.uint64) for x in w])
    known = [mix("en", "a", "b"), mix("", "é"), mix("en", "x")]
    df = spark.createDataFrame([(int(phrases._place(h)[0]),) for h in known], "at int")
    words = spark.createDataFrame([("en", "x"), ("", "é")], "lang string, phrase string")
    assert {r.at for r in phrases.word_places(words).collect()} == {int(phrases._place(h)[0]) for h in known[1:]}
    bits = phrases.bitmap(df)
    en, none = (phrases.Lookup(lang, bits, frozenset()) for lang in ("en", ""))
    assert en.of(["x", "no", "x", "\n", "no"]).tolist() == [1, -1, 1, -1, -1] and none.of(["é", "x"]).tolist() == [1, -1]
    assert en.has(known[0], en.bits)[0] and not en.has(mix("en", "b", "a"), en.bits)[0] and len(bits) == phrases.FILTER_BITS // 8


# The Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])])


def plain_tree(leaves):
    """All levels, and for each leaf its siblings as (before, after) by level."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    paths = []
    for at in range(len(leaves)):
        path = []
        for level in levels[:-1]:
            first = at // 3 * 3
            path.append((level[first:at], level[at + 1 : first + 3]))
            at //= 3
        paths.append(path)
    return levels[-1][0], paths


def plain_manifest(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        mine = []
        for row in by_source[s]:
            tampers = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[1] is not None
            claim = plain_leaf((row[0], row[1].replace("\n", ""), *row[2:])) if tampers else plain_leaf(row)
            mine.append(((row[0] is not None, row[0] or 0), plain_leaf(row), claim, row[0]))
        mine.sort()
        trees[s] = (mine, *plain_tree([x[1] for x in mine]))
    root, tops = plain_tree([trees[s][1] for s in order])
    out = []
    for s, top in zip(order, tops, strict=True):
        mine, subroot, paths = trees[s]
        for (_, leaf, claim, i), path in zip(mine, paths, strict=True):
            whole, folded = path + top, claim
            for before, after in whole:
                folded = sha(*before, folded, *after)
            out.append((i, leaf, subroot, root, sha(*[d for b, a in whole for d in (*b, *a)]), folded, folded == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_equals_brute_force(spark, levels):
    r = random.Random(levels)
    rows = [(i * 3, f"text\n{i}", "en", r.choice(["hot", "hot", "b", None, "", "é", "n", "*"]), i) for i in range(150)]
    rows += [(5, None, None, "one", None), (None, "a\nb", "x", "hot", 1), (None, None, None, None, None), (6, "", "", "hot", 0), rows[7], rows[7], (7, "p", "l", "hot", 1), (7, "q", "l", "hot", 1)]
    df = spark.createDataFrame([(*x, 9) for x in rows], SCHEMA + ", leaf int").repartition(3)
    digest = merkle.record_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    tampers = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    text = F.when(tampers, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    claim = merkle.record_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)
    made = merkle.build(df, digest=digest, claim=claim, levels=levels)
    got = sorted((tuple(x) for x in merkle.prove(made).collect()), key=str)
    assert got == plain_manifest(rows)
    log = made.log.collect()
    for tree in {x.tree for x in log}:  # each tree's log is complete, in postorder, without a gap
        mine = sorted((x for x in log if x.tree == tree), key=lambda x: x.position)
        assert [x.position for x in mine] == list(range(len(mine))) and mine[-1].top
        heights = [x.height for x in mine]
        for i, h in enumerate(heights):
            assert h == 0 or heights[i - 1] == h - 1


def test_manifest_of_little(spark, tmp_path):
    none = merkle.build(spark.createDataFrame([], SCHEMA))
    assert none.root is None and merkle.prove(none).count() == 0
    one = merkle.build(spark.createDataFrame([(1, "x", "en", "s", 1)], SCHEMA))
    row = merkle.prove(one).first()
    assert row.leaf == row.subroot == row.root == row.folded_root == one.root and row.proof_sha256 == sha("") and row.verified
    one.save(str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2


def test_positions():
    for n in range(1, 60):
        height, order, done = merkle.height_of(n), [], {}
        for h, at, _ in merkle.append([str(i) for i in range(n)], height):
            done[h, at] = len(order)
            order.append((h, at))
        assert all(merkle.position(h, at, n) == p for (h, at), p in done.items())


# Toxicity


def plain_segments(scores):
    """Maximal-scoring segments by their definition: the best segment, then those left and right of it."""
    best = max(((sum(scores[i:j]), -(j - i), -i) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    i = -best[2]
    j = i - best[1]
    right = [(a + j, b + j, s) for a, b, s in plain_segments(scores[j:])]
    return plain_segments(scores[:i]) + [(i, j, best[0])] + right


def test_segments_equal_their_definition():
    r = random.Random(2)
    for _ in range(300):
        scores = [r.randint(-400, 300) / 97 + 1 / (i + 7) for i in range(r.randint(0, 14))]
        got, want = toxicity.segments(np.array(scores)), plain_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert all(abs(x[2] - y[2]) < 1e-9 for x, y in zip(got, want, strict=True))


def test_rate_and_curve():
    # Steps of +1 with p and -1 with q have the rate log(q / p).
    assert abs(toxicity.rate_of(np.array([1.0, -1.0]), np.array([0.2, 0.8])) - math.log(4)) < 1e-6
    assert toxicity.rate_of(np.array([-1.0]), np.array([3.0])) == 1.0
    x = np.linspace(-3, 3, 25)
    slope, shift = toxicity.curve(x, 1000 / (1 + np.exp(-(1.5 * x - 0.5))), np.full(25, 1000.0))
    assert abs(slope - 1.5) < 0.02 and abs(shift + 0.5) < 0.02


def test_log_odds_smooth_towards_stems():
    toxic, clean = np.zeros(toxicity.BUCKETS, dtype=np.int32), np.zeros(toxicity.BUCKETS, dtype=np.int32)
    for w, t, c in (("badword", 30, 0), ("goodword", 0, 300)):
        for b in toxicity.buckets_of([w])[0]:
            if b >= 0:
                toxic[b] += t
                clean[b] += c
    m = toxicity.ToxicModel(toxic, clean, 40, 400)
    bad, kin, unknown, good = m.log_odds(["badword", "badwords", "xyz", "goodword"])
    assert bad > kin > unknown > good and abs(unknown) < 1e-9
    assert m.log_odds(["badword"], own=1)[0] < bad


def test_toxicity(spark):
    r = random.Random(4)
    plain = [f"{a}{b}{c}" for a in ("ka", "lo", "mi") for b in ("ra", "ta", "nu") for c in ("m", "s", "l", "n")]
    rows, labels = [], []
    for i in range(500):
        toxic = i % 5 == 0
        w = [r.choice(plain) for _ in range(r.randint(20, 200))]
        if toxic:
            at = r.randrange(len(w))
            w[at:at] = [r.choice(["Vile", "FOUL", "nasty", "rotten"]) for _ in range(r.randint(2, 5))]
        rows.append((i, " ".join(w), None, None, 1))
        if i < 480:
            labels.append((i, int(toxic)))
    rows += [(900, None, None, None, None), (901, "", None, None, 0), (None, "vile foul nasty rotten", None, None, 1), (902, "x" * 50_000, None, None, 1), (903, "vile foul nasty rotten", None, None, 1), rows[3], rows[3]]
    labels += [(3, None), (None, 1), (5, 1), (5, 0), (7777, 1)]
    docs = spark.createDataFrame([(*x, "clash") for x in rows], SCHEMA + ", TOX_score string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, marks)
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(rows) and [c for c in out[0].__fields__] == ["doc_id", "text", "lang", "source", "n_chars", "tox_score", "tox_passages"]
    held = [x for x in out if x.doc_id is not None and x.doc_id < 500 and zlib.crc32(str(x.doc_id).encode()) % 5 == 0]
    assert len(held) > 60 and all((x.tox_score >= 0.5) == (x.doc_id % 5 == 0) for x in held)
    for x in held:
        if x.doc_id % 5 == 0:
            words = toxicity.tokens(x.text)
            marked = {i for p in x.tox_passages for i in range(p.first, p.first + p.tokens)}
            assert {i for i, w in enumerate(words) if w in ("vile", "foul", "nasty", "rotten")} <= marked
    by_id = {x.doc_id: x.tox_score for x in out}
    assert by_id[900] == by_id[901] < 0.5 and by_id[902] < 0.5 and by_id[903] == by_id[None] > 0.5
    # Rows that are held out teach nothing: their labels turned around change no score.
    turned = [(i, 1 - y if i is not None and y is not None and zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    again = toxicity.score(docs, toxicity.fit(docs, spark.createDataFrame(turned, "doc_id long, toxic int")))
    assert sorted(x.tox_score for x in again.collect()) == sorted(x.tox_score for x in out)
    none = toxicity.fit(docs, marks.limit(0))
    assert {x.tox_score for x in toxicity.score(docs, none).collect()} == {0.5}
    assert toxicity.score(docs.limit(0), model).count() == 0

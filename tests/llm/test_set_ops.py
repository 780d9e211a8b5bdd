"""Line dedup, mixing, near duplicates, sharding and search against plain versions."""

import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import common, linededup, mixing, ngramjoin, sharding, topk


def in_duckdb(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(f"_{name}", df.toPandas())
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM _{name}")
    return con.execute(sql).fetchall()


@pytest.mark.parametrize("broadcast", [True, False])
def test_line_dedup_equals_sql(spark, empty, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(linededup, "MAX_BROADCAST_LEAVES", 0)
        monkeypatch.setattr(common, "FEW_ROWS", 3)
    r = random.Random(8)
    fixed = ["Copyright {y} by the authors of this page", "Page {y}", "User {w} logged in from {w} on port {y}", ""]
    rows = []
    for i in range(60):
        lines = [" ".join(r.choice("a b c d e".split()) for _ in range(r.randint(0, 9))) + f" own{i}" for _ in range(3)]
        lines += [r.choice(fixed).format(y=r.randint(1, 99), w=r.choice("ann bob cid".split())) for _ in range(2)]
        r.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    rows += [(60, None), (61, ""), (62, rows[0][1]), (None, rows[1][1]), (63, "z " * 20000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = linededup.dedup_lines(docs).collect()
    text = lambda xs: ",".join(map(str, xs))
    got = sorted((str(x.doc_id), x.n_lines, x.n_dropped, x.dropped_chars, text(x.dropped_lines)) for x in out)
    want = sorted((str(None if a is None or a != a else int(a)), *rest) for a, *rest in in_duckdb(linededup.SQL, documents=docs))
    assert got == want
    assert any("logged" in t for _, t in rows if t) and not any("logged" in (x.text or "") or "Copyright" in (x.text or "") for x in out)
    assert [x.text for x in out if x.doc_id == 60] == [None]
    assert linededup.dedup_lines(empty).count() == 0


def _dropped(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sum(x.n_dropped for x in linededup.dedup_lines(docs, **options).collect())


def test_line_dedup_keeps_several_templates_of_a_leaf(spark):
    names = "ann bob cid dora eve finn gwen hugo iris jan".split()
    done = [f"Job run for {n} finished ok today" for n in names]
    broken = [f"Job run for {n} crashed very badly" for n in names]
    # Common names: tokens in many lines of the leaf, yet fields.
    often = [f"Mail from {n} to {m} was sent on time" for n in names[:6] for m in names[:6]]
    alone = [f"Mail from x{chr(97 + i)} is {w} by any of them here" for i, w in enumerate("red blue green grey".split())]
    assert _dropped(spark, done) == 10 and _dropped(spark, broken) == 10
    assert _dropped(spark, done + broken) == 20
    assert _dropped(spark, done + broken + often + alone) == 20 + 36
    assert _dropped(spark, done + [f"Job run for own{chr(97 + i)} or {w} not {w}" for i, w in enumerate(names)]) == 10


def test_line_dedup_keeps_lines_of_fields_alone(spark):
    assert _dropped(spark, ["1 2 3", "4 5 6", "7 8 9", "10 11 12"]) == 0
    assert _dropped(spark, ["1 2 3\nx", "1 2 3", "1 2 3\ny", "1 2 3\nz"]) == 4


def test_line_dedup_beside_clashing_names(spark, docs):
    more = docs.withColumns({c: F.lit("kept") for c in ("th", "_th", "lh", "k", "v", "line", "leaf", "TH_")})
    out = linededup.dedup_lines(more)
    assert set(more.columns) <= set(out.columns) and all(x.th == x._th == x.k == x.leaf == "kept" for x in out.collect())
    assert out.count() == docs.count()


def plain_targets(sizes, weights, cap):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    t, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        total = sum(w[s] for s in free)
        over = {s for s in free if cap * sizes[s] < w[s] * left / total - 1e-9}
        if not over:
            return t | {s: w[s] * left / total for s in free}
        for s in over:
            t[s] = cap * sizes[s]
            left -= t[s]
        free -= over
    return t


@pytest.mark.parametrize("block", [1, 16])
def test_mixing(spark, docs, rows, empty, block):
    out = mixing.mix(docs, block=block).collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    want, taken = plain_targets(sizes, (1, 2, 3), 3), Counter()
    for x in out:
        assert x.source_size == sizes[x.source] and abs(x.target - want[x.source]) < 1e-6
        assert 0 <= x.taken <= 3 * x.size
        taken[x.source] += x.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 3 * block + 1, (s, taken[s], want[s])
    key = lambda o: sorted(str((x.doc_id, x.size, x.taken)) for x in o)
    assert key(mixing.mix(docs.repartition(5), block=block).collect()) == key(out)
    assert mixing.mix(empty).count() == 0


def test_mixed_documents(docs, rows):
    out = mixing.mixed_documents(docs).collect()
    plan = mixing.mix(docs).collect()
    assert sum(len((x.text or "").split()) for x in out) == sum(x.taken for x in plan)
    originals = {r[1] for r in rows}
    cut = [x for x in out if x.text not in originals]
    assert len(cut) < 30 and all(x.n_chars == len(x.text) for x in out)


def test_mixing_shuffles_texts_once(spark, docs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = mixing.mixed_documents(docs)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Only the lines of the branch that holds the texts, down to their scan: shuffles above it.
    scan = next(i for i, line in enumerate(plan) if "Scan" in line and "text" in line and "n_chars" in line)
    depth = len(plan[scan]) - len(plan[scan].lstrip(" :+-"))
    above, at = 0, depth
    for line in reversed(plan[:scan]):
        d = len(line) - len(line.lstrip(" :+-"))
        if d < at:
            at = d
            above += "Exchange" in line and "RoundRobin" not in line
    assert above == 1


def test_quotas_are_sainte_lague(spark):
    r = random.Random(9)
    sizes = [(f"s{i:02d}", r.randint(1, 5000)) for i in range(17)]
    wanted = mixing.targets(spark.createDataFrame(sizes, "source string, source_size long"), (1, 2, 3), 3)
    got = {x.source: x for x in mixing.quotas(wanted, 16, 4, 3).collect()}
    n = max(-(-sum(s for _, s in sizes) // 16), len(sizes))
    seats = Counter()
    for house in range(1, n + 1):
        best = max(got.values(), key=lambda x: ((x.target / (2 * seats[x.source] + 1)) if seats[x.source] < 3 * x.n_blocks else -1, [-ord(c) for c in x.source]))
        seats[best.source] += 1
        for k in range(4):
            if house == n * (k + 1) // 4:
                assert {s: x.quota[k] for s, x in got.items()} == {s: seats[s] for s in got}


def plain_components(rows, size, percent):
    def shingles(t):
        w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or "")).split()]
        return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])

    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        ids[find(i)].append(r[0])
    smallest = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return [(r[0], len(sets[i]), smallest[find(i)] if sets[i] else r[0]) for i, r in enumerate(rows)]


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80), (2, 50)])
def test_ngram_join_equals_all_pairs(docs, rows, size, percent):
    out = ngramjoin.link_components(docs, size=size, percent=percent).collect()
    got = sorted(str((x.doc_id, x.n_shingles, x.component_id)) for x in out)
    assert got == sorted(str(x) for x in plain_components(rows, size, percent))


def test_ngram_join_short_lists_are_done_at_once_and_texts_travel_packed(spark, monkeypatch):
    r = random.Random(9)
    long = [" ".join(f"w{r.randrange(400)}" for _ in range(300)) for _ in range(60)]
    near = [t + " one more" for t in long[:20]]  # links
    part = [" ".join(t.split()[:250] + [f"z{r.randrange(9999)}" for _ in range(50)]) for t in long[20:40]]  # share shingles, no links
    texts = long + near + part
    made, real = {}, ngramjoin.materialize

    def kept(df, name):
        out = real(df, name)
        made[name] = (out.count(), sum(len(x) for row in out.collect() for x in row if isinstance(x, (bytes, bytearray, list))))
        return out

    monkeypatch.setattr(ngramjoin, "materialize", kept)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in ngramjoin.link_components(docs, size=3, percent=80).collect()}
    assert got == {i: i - 60 if 60 <= i < 80 else i for i in range(len(texts))}
    assert made["open-postings"][0] == 0  # every list has two members, which have been compared
    assert made["packed-texts"][1] < 40 * 300 * 8 / 2  # not half of the shingles' hashes of the 40 candidates


def test_ngram_join_chains_and_common_shingles(spark, empty, monkeypatch):
    r = random.Random(11)
    monkeypatch.setattr(ngramjoin, "FEW", 3)  # few documents make a shingle common
    monkeypatch.setattr(common, "FEW_ROWS", 2)  # and a key hot
    rows, w = [], [f"w{r.randint(0, 40)}" for _ in range(60)]
    for i in range(60):  # a walk: neighbours link, ends do not
        w = list(w)
        w[r.randrange(60)] = f"n{i}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(["common passage of words that all hold"] * 3 + [f"u{i}_{k}" for k in range(r.randint(1, 30))])) for i in range(40)]
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(x)[0:1] + (x.n_shingles, x.component_id) for x in ngramjoin.link_components(docs, size=3, percent=80).collect())
    assert got == sorted(plain_components(rows, 3, 80))
    assert ngramjoin.link_components(empty).count() == 0


def test_components_of_a_long_chain_take_few_rounds(spark, monkeypatch):
    n = 4096
    names = [f"{i * 2654435761 % 2**32:08x}" for i in range(n)]
    edges = list(zip(names, names[1:], strict=False)) + [("x", "y"), ("y", "z"), ("z", "x"), ("x", "x")]
    edges += [("hub", f"leaf{i}") for i in range(500)]
    rounds = []
    real = ngramjoin.materialize
    monkeypatch.setattr(ngramjoin, "materialize", lambda df, name: rounds.append(name) or real(df, name))
    got = ngramjoin.components(spark.createDataFrame(edges, "a string, b string")).collect()
    assert rounds.count("labels") < 20
    groups = defaultdict(set)
    for x in got:
        groups[x.root].add(x.node)
    assert all(k in v for k, v in groups.items())
    assert sorted(map(len, groups.values())) == [3, 501, n]


@pytest.mark.parametrize(("few", "most"), [(None, 1), (40, 15), (0, 19)])
def test_components_close_few_edges_at_once(spark, monkeypatch, few, most):
    if few is not None:  # rounds first, the rest of them at once
        monkeypatch.setattr(ngramjoin, "FEW_EDGES", few)
    ids = list(range(900))
    random.Random(4).shuffle(ids)
    edges = list(zip(ids[:500], ids[1:500], strict=False)) + [(ids[500], x) for x in ids[501:800]] + list(zip(ids[800::2], ids[801::2], strict=True))
    rounds, real = [], ngramjoin.materialize
    monkeypatch.setattr(ngramjoin, "materialize", lambda df, name: rounds.append(name) or real(df, name))
    got = ngramjoin.components(spark.createDataFrame([*edges, (7, 7), (7, None)], "a long, b long")).collect()
    assert 0 < rounds.count("labels") <= most
    groups = defaultdict(set)
    for x in got:
        groups[x.root].add(x.node)
    assert len(got) == 900 and all(k in v for k, v in groups.items())
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, [ids[:500], ids[500:800], *(ids[i : i + 2] for i in range(800, 900, 2))]))


def test_keep_one_beside_clashing_names(docs):
    more = docs.withColumns({c: F.lit("kept") for c in ("_id", "_hash", "_h", "_i", "_HASH_", "i", "h", "k", "v", "salt", "stays", "set_key")})
    kept = ngramjoin.keep_one(more)
    assert kept.columns == more.columns
    rows = kept.collect()
    assert len(rows) == ngramjoin.keep_one(docs).count() and all(x["_hash"] == x["k"] == x["stays"] == "kept" for x in rows)


def test_keep_one(docs, rows):
    kept = ngramjoin.keep_one(docs).collect()
    comp = plain_components(rows, 5, 80)
    groups = {c for (_, n, c) in comp if n}
    assert sum(1 for x in kept if (x.text or "").split()) == len(groups)
    assert kept[0].__fields__ == docs.columns


def test_sharding(spark, docs, rows, empty, tmp_path):
    path = str(tmp_path / "map")
    out = sharding.shard_documents(docs, 4, n_slots=64, map_path=path).collect()
    assert len(out) == len(rows)
    by = defaultdict(list)
    for x in out:
        assert x.size == len((x.text or "").encode()) + 16
        by[x.shard].append(x.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) <= set(range(4))
    first = {x.virtual_slot: x.shard for x in out}
    again = sharding.shard_documents(docs, 5, n_slots=64, map_path=path).collect()
    assert {x.map_version for x in again} == {2} and {x.virtual_slot for x in again} == set(first)
    version, slots = sharding.load_map(spark, path)
    assert version == 2 and len(slots) == 64
    assert sharding.shard_documents(empty, 3).count() == 0


def test_sharding_against_plain_rules(spark, empty):
    r = random.Random(21)
    rows = [(i, None if i % 50 == 0 else "é" * r.randint(0, 40) + "x" * r.choice([0, 3, 900]), "hot" if i % 3 else "s") for i in range(3000)]
    rows += [rows[1], (None, None, None), (None, "text", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = sharding.shard_documents(docs, 10, n_slots=512, rows_per_bucket=1).collect()
    size = lambda t: len((t or "").encode()) + 16
    want = Counter((i, s, size(t), zlib.crc32((t or "").encode())) for i, t, s in rows)
    assert Counter((x.doc_id, x.source, x.size, x.text_crc32) for x in out) == want
    load, places = Counter(), defaultdict(list)
    for x in out:
        load[x.shard] += x.size
        places[x.shard].append(x.slot)
    assert set(load) == set(range(10)) and max(load.values()) < 1.02 * min(load.values())
    assert all(sorted(v) == list(range(len(v))) for v in places.values())
    assert len({(x.virtual_slot, x.shard) for x in out}) == len({x.virtual_slot for x in out})


def test_sharding_beside_clashing_names(docs):
    more = docs.withColumns({c: F.lit("kept") for c in ("_s", "_p", "_part", "_start", "_at", "_place", "SHARD")})
    rows = sharding.shard_documents(more, 3).collect()
    assert len(rows) == docs.count() and all(x._s == x._part == x._at == "kept" and x.shard in (0, 1, 2) for x in rows)


def test_mixing_beside_clashing_names(docs, rows, monkeypatch):
    more = docs.withColumns({c: F.lit("kept") for c in ("size", "h", "bucket", "s", "r", "_text", "keep_text", "ranges", "start")})
    plain = lambda o: sorted(str((x.doc_id, x.taken)) for x in o.collect())
    want = plain(mixing.mix(docs, rows_per_bucket=2))
    assert plain(mixing.mix(more, rows_per_bucket=2)) == want
    monkeypatch.setattr(mixing, "RUN", 3)
    assert plain(mixing.mix(more, rows_per_bucket=2)) == want
    given = mixing.mixed_documents(more)
    assert given.columns == more.columns and all(x.size == x.keep_text == x.r == "kept" for x in given.collect())


def test_topk_beside_clashing_names(spark):
    names = ("v", "dim", "norm", "bucket", "block", "qb", "score", "rank", "n")
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(60)], "vec_id long, embedding array<double>")
    want = sorted(map(tuple, topk.top_k(df).collect()))
    assert sorted(map(tuple, topk.top_k(df.withColumns({c: F.lit("x") for c in names})).collect())) == want


def test_rebalance_moves_few_slots():
    r = random.Random(6)
    sizes = {s: r.randint(1, 1000) for s in range(512)}
    old = sharding.first_map(sizes, 512, 10)
    load = lambda m, n: [sum(sizes[s] for s in m if m[s] == k) for k in range(n)]
    assert max(load(old, 10)) <= 1.02 * sum(sizes.values()) / 10
    new = sharding.rebalanced(old, sizes, 11)
    moved = [s for s in old if old[s] != new[s]]
    assert all(new[s] == 10 for s in moved) or len(moved) < 120
    assert max(load(new, 11)) <= 1.1 * sum(sizes.values()) / 11
    fewer = sharding.rebalanced(old, sizes, 9)
    assert set(fewer.values()) == set(range(9)) and sum(old[s] != fewer[s] for s in old if old[s] < 9) < 120


def brute_topk(rows, every, k, scale):
    good = [(i, np.floor(np.array(v, dtype=float) * scale)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for i, q in good:
        if i % every == 0:
            s = sorted((-int(q @ p), j) for j, p in good if j != i and len(p) == len(q))[:k]
            out |= {(i, n + 1, j, -x) for n, (x, j) in enumerate(s)}
    return out


@pytest.mark.parametrize(("block_rows", "query_rows"), [(None, None), (20, 3), (20, 1)])
def test_topk_equals_brute_force(spark, block_rows, query_rows):
    r = np.random.default_rng(3)
    rows = [(i, (r.normal(size=8) * r.choice([0.1, 1, 1, 7])).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 330)]  # equal vectors: ties
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (None, rows[0][1]), (404, [0.0] * 8), (450, [1.0, 2.0]), (500, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = {tuple(x) for x in topk.top_k(df, every=10, block_rows=block_rows, query_rows=query_rows).collect()}
    assert out == brute_topk(rows, 10, 5, 256)
    assert topk.top_k(df.limit(0)).count() == 0


def test_topk_meets_long_enough_buckets_only(spark, monkeypatch):
    r = np.random.default_rng(4)
    rows = [(i, (r.normal(size=8) * 10.0 ** (i % 4)).tolist()) for i in range(2000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    met = []
    real = topk.search_block
    monkeypatch.setattr(topk, "_meet", lambda *a, f=topk._meet: met.append(f(*a)) or met[-1])
    out = {tuple(x) for x in topk.top_k(df, every=10, scale=1, block_rows=50, query_rows=20).collect()}
    assert out == brute_topk(rows, 10, 5, 1)
    pairs = [m.select("query_id", "vec_id").count() for m in met]
    assert real is topk.search_block and sum(pairs) < 0.3 * 200 * 5 * 40  # of 40 blocks


def test_topk_prunes_by_coordinates():
    r = np.random.default_rng(5)
    p = np.floor(r.normal(size=(3000, 8)) * 256)
    q = np.floor(p[:40] * 1.0)
    ids = np.arange(3000)
    got = [(int(ids[i]), j, x) for i, j, x in topk.search_block(ids[:40], q, ids, p, 3, local=64)]
    want = set()
    s = (q @ p.T).astype(np.int64)
    for i in range(40):
        order = sorted((-s[i, j], j) for j in range(3000) if j != i)[:3]
        want |= {(i, j, -x) for x, j in order}
    assert set(got) == want
    big = topk._products(np.array([[2.0**40, 3.0]]), np.array([[2.0**30, 5.0]]))
    assert int(big[0][0]) == 2**70 + 15

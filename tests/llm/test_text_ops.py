"""PII, decontamination, language ID, token counts and main text against plain versions."""

import random
import re
import string
import time

import pytest
from pyspark.sql import functions as F

from skyledger.llm import decontaminate, htmltext, langid, pii, tokens


def brute_pii(text):
    def luhn(d):
        s = 0
        for i, c in enumerate(reversed(d)):
            v = int(c) * (1 + i % 2)
            s += v - 9 * (v > 9)
        return s % 10 == 0

    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], ("email", "ip", "card", "phone").index(s[0])))


def test_pii_base_spans():
    r = random.Random(1)
    parts = ["a.b@c.de", "x_@y.z.w_k@l.m", "1.2.3.4", "1.2.3.4.5.6.7.8.9", "999.1.1.1", "4539 1488 0343 6467", "4539-1488-0343-6468",
             "+1 (017) 555-7713", "+++12", " ", "é", "@", ".", "0", "12", "@@a.b", "+1 ((((", "00000000000000", "\n"]
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 8)))
        assert sorted(pii.base_spans(text), key=lambda s: (s[1], pii.KINDS.index(s[0]))) == brute_pii(text), text
    assert pii.base_spans("a" * 200_000) == [] and pii.base_spans("1" * 200_000) == []  # linear in long runs


def test_pii_method_adds_and_keeps():
    text = "IBAN GB82 WEST 1234 5698 7654 32, social security 123-45-6789, other 123-45-6789" + " x" * 60 + " 321-54-9876"
    kinds = [s[0] for s in pii.find(text)[0]]
    assert kinds.count("iban") == 1 and kinds.count("ssn") == 2
    near = pii.find("card 4539148803436467")[0][0]
    far = pii.find("4539148803436467")[0][0]
    assert near[3] > far[3] and far[0] == "card"


def test_pii_frame(docs, rows, empty):
    out = pii.find_pii(docs.withColumn("pii", F.lit(1)), redact=True).collect()
    assert len(out) == len(rows) and all((x.redacted is None) == (x.text is None) for x in out)
    assert pii.find_pii(empty).count() == 0


def brute_hits(text, items, n):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, found = find(text), set(), set()
    for i, t in items:
        v = find(t)
        size = min(n, len(v))
        grams = {tuple(v[k : k + size]) for k in range(len(v) - size + 1)} if v else set()
        for k in range(len(w) - size + 1 if v else 0):
            if tuple(w[k : k + size]) in grams:
                hit |= set(range(k, k + size))
                found |= {i} - {None}
    return len(w), len(hit), sorted(map(str, found))


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_decontaminate(spark, docs, rows, empty, block_bytes):
    items = [(1, rows[0][1]), (2, " ".join(rows[45][1].split()[5:25])), (3, "ONE, two"), (4, None), (5, "..."), (None, rows[1][1]), (2, rows[50][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.decontaminate(docs, bench, block_bytes=block_bytes)
    got = sorted((str(x.doc_id), x.text or "", x.n_words, x.n_hit, sorted(x.item_ids)) for x in out.collect())
    assert got == sorted((str(r[0]), r[1] or "", *brute_hits(r[1], items, 10)) for r in rows)
    clean = decontaminate.decontaminate(docs, bench, action="clean")
    assert clean.columns.count("text") == 1
    again = decontaminate.decontaminate(clean.select("doc_id", "text"), bench.where("item_id = 2"), n=10)
    assert again.where("contaminated").count() == 0
    kept = decontaminate.decontaminate(docs, bench, action="drop")
    assert kept.count() == sum(brute_hits(r[1], items, 10)[1] == 0 for r in rows)
    assert decontaminate.decontaminate(empty, bench).count() == 0
    assert decontaminate.decontaminate(docs, bench.limit(0)).where("contaminated").count() == 0


SYLLABLES = {"en": "the and ing tion th er ea ou", "fr": "le que eau ment é è ou ç", "de": "der sch ung ß ü ein ge ver"}


def speech(r, lang, n):
    s = SYLLABLES[lang].split()
    return " ".join("".join(r.choice(s) for _ in range(r.randint(1, 3))) for _ in range(n))


def test_language_id(spark, docs, rows, empty):
    r = random.Random(3)
    made = [(i, speech(r, lang, r.randint(3, 80)), lang) for i, lang in enumerate(r.choice(list(SYLLABLES)) for _ in range(600))]
    train = spark.createDataFrame(made[:300], "doc_id long, text string, lang string")
    test = spark.createDataFrame([(*m, f"www.x{m[0] % 7}.{m[2]}") for m in made[300:]], "doc_id long, text string, lang string, host string")
    model = langid.fit(train, "text", "lang")
    assert model.languages == sorted(SYLLABLES)
    alone = langid.identify(test, model, declared_col=None, host_col=None).collect()
    assert sum(x.lang == x.lang_id for x in alone) >= 0.97 * len(alone)
    fused = langid.identify(test, model, declared_col="lang", host_col="host").collect()
    assert sum(x.lang == x.lang_id and not x.lang_rejected for x in fused) >= 0.99 * len(fused)
    odd = langid.identify(docs, model, host_col="source").collect()
    assert len(odd) == len(rows)
    assert all(x.lang_rejected and x.lang_id == "und" for x in odd if not (x.text or "").strip())
    assert langid.identify(empty, langid.fit(empty, "text", "lang")).count() == 0


def plain_language(model, rows, threshold=0.5):
    """(text, declared, host) -> (language, confidence, rejected), by dictionaries."""
    names, n = model.languages, len(model.languages) + 1
    fold = {t: f for t, f in rows["folds"].items()}

    def evidence(t, d, h):
        like = model.log_likelihood(t, fold[t or ""])
        if not like.any():
            return None
        p = langid.np.exp(like - like.max())
        tail = h.rsplit(".", 1)[1] if h and "." in h else None
        for said, trust in ((d, langid.TRUST_DECLARED), (langid.SUFFIX_LANGUAGE.get(tail), langid.TRUST_SUFFIX)):
            if said in names:
                p = p * [trust if x == said else (1 - trust) / len(names) for x in [*names, None]]
        return p / p.sum(), tail

    found = [evidence(*r) for r in rows["rows"]]
    hosts, tails, top = {}, {}, langid.np.zeros(n)
    for (_, _, h), e in zip(rows["rows"], found):
        if e:
            hosts[h] = hosts.get(h, 0) + e[0]
            tails[e[1]] = tails.get(e[1], 0) + e[0]
            top = top + e[0]
    smooth = lambda c, p, w: (c + w * p) / (c.sum() + w)
    whole = smooth(top, langid.np.full(n, 1 / n), n)
    out = []
    for (_, _, h), e in zip(rows["rows"], found):
        if not e:
            out.append(("und", 0.0, True))
            continue
        q = e[0] * (smooth(hosts[h], smooth(tails[e[1]], whole, langid.SUFFIX_WEIGHT), langid.HOST_WEIGHT) if h is not None else 1)
        q = q / q.sum()
        best = int(q.argmax())
        out.append(([*names, "und"][best], round(float(q[best]), 6), bool(best == n - 1 or q[best] < threshold)))
    return out


def test_language_id_equals_plain_fusion(spark):
    r = random.Random(13)
    rows = []
    for i in range(300):
        lang = r.choice(list(SYLLABLES))
        text = r.choice([speech(r, lang, r.randint(1, 9)), speech(r, lang, 2), None, "", "12 34", "qzx"]) if i % 3 == 0 else speech(r, lang, r.randint(1, 30))
        rows.append((text, r.choice([lang, lang, "en", "xx", None]), r.choice([None, "plain", f"a{i % 5}.{lang}", f"b{i % 3}.com", "c.co.uk", "hot.de"])))
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "doc_id long, text string, lang string, host string")
    model = langid.fit(df, "text", "lang", folds=2)
    assert model.folds == 2
    folds = {x[0]: x[1] for x in df.select(F.coalesce("text", F.lit("")).alias("t"), langid._fold(F.coalesce("text", F.lit("")), 2).alias("f")).collect()}
    got = {x.doc_id: (x.lang_id, x.lang_confidence, x.lang_rejected) for x in langid.identify(df, model, host_col="host").collect()}
    want = plain_language(model, {"rows": rows, "folds": folds})
    for i, w in enumerate(want):
        assert got[i][0] == w[0] and got[i][2] == w[2] and abs(got[i][1] - w[1]) < 2e-6, (rows[i], got[i], w)


def test_a_label_of_one_row_is_known_to_all_folds(spark):
    r = random.Random(14)
    rows = [(i, speech(r, "de", 20), "de") for i in range(30)] + [(99, "zzyx wvvu zzyx " * 9, "qq")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {x.doc_id: x for x in langid.identify(df, langid.fit(df, "text", "lang", folds=2), host_col=None).collect()}
    assert out[99].lang_id == "qq" and not out[99].lang_rejected and all(out[i].lang_id == "de" for i in range(30))


def test_language_id_beside_clashing_names(docs):
    names = ("_h", "_host", "_suffix", "_declared", "_prior", "_fold", "_key", "_salt", "p", "host", "s")
    more = docs.withColumns({c: F.lit("kept") for c in names})
    out = langid.identify(more, langid.fit(more, "text", "lang", folds=2))
    assert out.columns[: len(more.columns)] == more.columns
    assert all(x[c] == "kept" for x in out.collect() for c in names)


def test_decontaminate_beside_clashing_names(docs):
    more = docs.withColumns({c: F.lit("kept") for c in ("_spans", "_items", "_clean")})
    bench = docs.select(F.col("doc_id").alias("item_id"), "text").limit(3)
    for action in ("flag", "clean"):
        rows = decontaminate.decontaminate(more, bench, action=action).collect()
        assert len(rows) == docs.count() and all(x._spans == x._items == x._clean == "kept" for x in rows)


def test_decontaminate_index_is_bounded():
    r = random.Random(4)
    items = [(str(i), " ".join(f"w{r.randrange(50000):x}" for _ in range(200))) for i in range(1500)]
    index = decontaminate.NgramIndex(items, 10)
    assert index.nbytes() < 6 * sum(len(t) for _, t in items)


def test_host_prior_decides_a_tie(spark):
    model = langid.TextModel(["de", "en"], langid.np.zeros((langid.BUCKETS, 3)) - 5)
    model.log_p[:, 2] = -9
    model.log_p[langid.trigrams("ja")] = [-4, -9, -9]
    rows = [(i, "ja", "h.one") for i in range(30)] + [(99, "xyz", "h.one")]
    out = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, source string"), model, declared_col=None).collect()
    assert {x.lang_id for x in out} == {"de"}


def test_salted_prior_join_is_the_same(spark, docs, monkeypatch):
    model = langid.fit(docs.where("lang is not null"), "text", "lang")
    key = lambda df: sorted(str(x) for x in df.select("doc_id", "text", "lang_id", "lang_confidence").collect())
    one = key(langid.identify(docs, model))
    monkeypatch.setattr(langid, "MAX_BROADCAST_HOSTS", 0)
    assert key(langid.identify(docs, model)) == one


@pytest.fixture(scope="module")
def counter():
    return tokens.counter(tokens.vocabulary_path())


@pytest.fixture(scope="module")
def library():
    sp = pytest.importorskip("sentencepiece")
    return sp.SentencePieceProcessor(model_file=tokens.vocabulary_path())


def test_token_counts_equal_the_library(counter, library):
    r = random.Random(2)
    letters = string.ascii_letters + "   ▁\n\té🙂中<>0123456789.,"
    for _ in range(3000):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 30)))
        assert counter.count(text) == len(library.encode(text)), text
    for n in (1, 2, 3, 15, 16, 17, 33, 64, 200):
        assert counter.count(" " * n) == len(library.encode(" " * n))


def test_prefix_counts_equal_encoding_again(counter, library):
    text = "The  quick, brown\nfox — 12,345 jumps über 中 🙂 <s>  end "
    assert counter.prefixes(text).tolist() == [len(library.encode(text[:i])) for i in range(len(text) + 1)]
    for budget in (0, 1, 5, 11, 99):
        cut = counter.cut(text, budget)
        assert cut == max(i for i in range(len(text) + 1) if len(library.encode(text[:i])) <= budget)


def test_token_frame(docs, rows, empty, library):
    out = tokens.count_tokens(docs.withColumn("N_Tokens", F.lit("x")), limit=100).collect()
    assert sorted((str(x.doc_id), x.n_bytes, x.n_tokens, x.over_limit) for x in out) == sorted(
        (str(r[0]), len((r[1] or "").encode()), n := len(library.encode(r[1] or "")), n > 100) for r in rows
    )
    short = tokens.truncate(docs, 20).collect()
    assert all((x.truncated_text is None) == (x.text is None) and x.truncated_tokens <= 20 for x in short)
    assert tokens.prefix_table(docs.where("doc_id < 3")).count() == 3 and tokens.count_tokens(empty).count() == 0


def test_main_text_on_held_out_pages():
    crf = htmltext.trained()
    pages = htmltext.labelled_pages(200, seed=77)
    right = total = 0
    for page, labels in pages:
        found = htmltext.blocks(page)
        assert len(found) == len(labels)
        got = crf.decode(htmltext.features(found), htmltext.relations(found))
        right += sum(a == b for a, b in zip(got, labels, strict=True))
        total += len(labels)
    assert right / total >= 0.98


def test_viterbi_is_the_best_path():
    r = random.Random(4)
    for _ in range(200):
        n = r.randint(1, 8)
        s, same, between = [r.uniform(-2, 2) for _ in range(n)], (r.uniform(-1, 1), r.uniform(-1, 1)), [r.randint(0, 1) for _ in range(n - 1)]
        crf = htmltext.Crf({f"f{i}": x for i, x in enumerate(s)}, same)
        value = lambda path: sum(x for x, y in zip(s, path, strict=True) if y) + sum(same[between[i]] for i in range(n - 1) if path[i] == path[i + 1])  # noqa: E731,B023
        best = max(value([bool(k >> i & 1) for i in range(n)]) for k in range(2**n))
        assert abs(value(crf.decode([[f"f{i}"] for i in range(n)], between)) - best) < 1e-9


PAGE = """<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li><a href=/a>Home</a></li></ul></nav>
<article><h1>Big  &amp; small</h1><p>First para&shy;graph, with <b>bold</b> text.<p>Second one&nbsp;here, and it goes on.</p>
<div class="ad">Buy now</div></article><footer>&copy; 2020 x</footer></body></html>"""


def test_main_text_frame(spark):
    rows = [(1, PAGE), (2, None), (3, ""), (4, "<p>"), (5, PAGE[: PAGE.index("Second") + 10] + "<p"), (6, "<!-- never closed"), (None, PAGE)]
    out = {x.page_id: x for x in htmltext.extract(spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit(1))).collect()}
    assert out[1].text == "Big & small\n\nFirst para­graph, with bold text.\n\nSecond one here, and it goes on."
    assert out[1].n_chars == len(out[1].text) and out[None].text == out[1].text
    assert out[2].text == out[3].text == out[4].text == out[6].text == ""
    assert out[5].text.endswith("Second one")


def test_name_kinds_do_not_depend_on_words_seen_before():
    word = lambda i: "".join(string.ascii_lowercase[i // 26**k % 26] for k in range(4))
    size = len(htmltext._KINDS)
    for i in range(100_001):
        htmltext._element("div", f' class="q{word(i)}"')
    for name, kind in (("adsbygoogle", "ad"), ("commentthread", "talk"), ("sidebarleft", "side"), ("cookiebanner", "notice")):
        assert f"kind={kind}" in htmltext._element("div", f' class="{name}"').features
    assert len(htmltext._KINDS) == size


STORY = "<h1>A long valley</h1>" + "".join(f"<p>Sentence {i} of the story goes on for some more words, and then it ends.</p>" for i in range(6))


@pytest.mark.parametrize(
    "attributes",
    ['data-title="The hidden valley"', 'data-url="/hidden-gems/1"', "data-x='style=display:none hidden'", "hidden", 'aria-hidden="true"', 'style="display:none"'],
)
@pytest.mark.parametrize("tag", ["main", "article", "div"])
def test_hidden_is_evidence_and_not_a_cut(tag, attributes):
    page = f'<body><nav><ul><li><a href="/">Home</a></li></ul></nav><{tag} {attributes}>{STORY}</{tag}><footer>&copy; 2020 x</footer></body>'
    text = htmltext.main_text(page, htmltext.trained())
    assert text.count("of the story") == 6 and "Home" not in text and "2020" not in text
    dialog = '<div class="cookie-consent" hidden><p>We use cookies to serve you.</p></div>'
    assert "cookies" not in htmltext.main_text(page.replace("<footer>", dialog + "<footer>"), htmltext.trained())


def test_attribute_names_are_told_from_values():
    get = lambda a: "hidden" in htmltext._element("div", a).features
    assert not get(' data-title="The hidden valley" data-url="/hidden-gems/1"') and not get(" data-hidden aria-hidden=false title=hidden")
    assert get(" HIDDEN") and get(" title='a' aria-hidden = 'true'") and get(' style="color:red;display : none"')


@pytest.mark.parametrize("tag", "svg math object canvas audio video template select noscript".split())
def test_an_unclosed_element_takes_no_text_with_it(tag):
    for at in ("<p>Sentence 0", "<p>Sentence 3", "of the story goes"):
        for again in ("", f"<p><{tag}></{tag}>"):
            page = f"<body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article>{STORY.replace(at, f'<{tag} id=q>' + at, 1)}{again}</article></body>"
            text = htmltext.main_text(page, htmltext.trained())
            assert text.count("of the story") == 6 and "Home" not in text


def test_elements_apart_keep_their_text():
    get = lambda page: [(b.text, b.path[-1].tag if b.path else "") for b in htmltext.blocks(page)]
    assert get("<p>So <math><mi>E</mi> <mo>=</mo> <mi>m</mi></math> holds.</p>") == [("So E = m holds.", "p")]
    assert get("<p>An icon <svg><path d='M0'/></svg> in a line.</p>") == [("An icon in a line.", "p")]
    assert get("<p>A <svg><text>graph</text></svg> in a line.</p>") == [("A", "p"), ("graph", "svg"), ("in a line.", "p")]
    assert get("<p>One<video src=a>No video.</video></p>two") == [("One", "p"), ("No video.", "video"), ("two", "")]
    assert get("<select><option>a<option>b</select>c") == [("a", "option"), ("b", "option"), ("c", "")]
    assert get("<p>a<object><p>b</p></object>c</p>") == [("a", "p"), ("b", "p"), ("c", "p")]
    assert get("a<script>b</p>") == [("a", "")]
    page = f"<body><article>{STORY}<object data=x><p>The object tells the same thing in words, and it ends here.</p></object></article></body>"
    assert "The object tells" in htmltext.main_text(page, htmltext.trained())


def test_all_parts_of_a_name_count():
    long = "wp-block-group has-background alignwide is-layout-flow comments-area"
    for attribute in ("class", "id", "role"):
        assert {"name=comments", "kind=talk", "name=area"} <= set(htmltext._element("div", f' {attribute}="{long}"').features)
    many = " ".join(f"u{c}" for c in string.ascii_lowercase) + " sponsored"
    page = f'<body><div class="entry">{STORY}</div><div class="{many}"><p>Sentence of an advert that goes on, and ends here.</p></div></body>'
    assert "kind=ad" in htmltext.features(htmltext.blocks(page))[-1]


def test_every_labelled_language_is_fitted(spark):
    r = random.Random(8)
    names = [a + b for a in "qwxyzvu" for b in string.ascii_lowercase] + [f"k{c}{d}" for c in "ab" for d in string.ascii_lowercase]
    speak = {k: ["".join(r.choice(string.ascii_lowercase) for _ in range(r.randint(2, 4))) for _ in range(9)] for k in names}
    rare = set(names[:4])  # one row each; all others five
    made = [(k, i) for k in names for i in range(1 if k in rare else 5)]
    spelled = lambda k, i: (k, f"{k.upper()}-X", f"{k}_gb", f" {k}", k)[i]
    rows = [(f"{k}{i}", " ".join(r.choice(speak[k]) for _ in range(60)), spelled(k, i), "h.one") for k, i in made]
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string, source string")
    model = langid.fit(df, "text", "lang")
    assert len(names) > 200 and model.languages == sorted(names)
    out = langid.identify(df, model).collect()
    assert len(out) == len(rows) and all(x.lang_id == x.doc_id[:-1] and not x.lang_rejected for x in out)


def test_many_unended_tags_are_read_in_a_second():
    for page in ("<a" * 500_000 + ">x", "<a" * 500_000, "<p>one</p>" + "<!" * 500_000, "<b '" * 250_000 + "<p>x</p>"):
        start = time.perf_counter()
        htmltext.blocks(page)
        assert time.perf_counter() - start < 3
    assert [b.text for b in htmltext.blocks("<p>one</p><p>two</p> a < b <em")] == ["one", "two", "a < b"]


def test_further_spans_give_way_in_long_texts():
    r = random.Random(8)
    some = ["mail a.b@c.de now", "card 4111 1111 1111 1111", "ssn 123-45-6789", "10.0.0.1", "call +49 30 1234567", "phone (555) 123-4567", "IBAN DE89370400440532013000"]
    text = " ".join(r.choice(some) for _ in range(400))
    every, base = pii.find(text)
    for kind, a, b, _ in every:
        if (kind, a, b) not in base:
            assert not any(a < z and y < b for _, y, z in base)
    kept = {(k, a, b) for k, a, b, _ in every}
    for kind, a, b in pii.further_spans(text):
        free = not any(a < z and y < b for _, y, z in base)
        assert ((kind, a, b) in kept) == (free and pii.score(text, kind, a, b) >= pii.THRESHOLD)
    start = time.perf_counter()
    pii.find(" ".join(r.choice(some) for _ in range(40_000)))
    assert time.perf_counter() - start < 20

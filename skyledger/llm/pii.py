"""Personal data: patterns propose spans, validators confirm them, context adjusts.

Base kinds (email, ip, card, phone) stand whatever their context; further kinds
(IBAN, national identity and phone numbers) need a checksum or context words near
them to reach the threshold.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, table

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "local_phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A whole chain of dotted numbers, so that long runs of digits are read once.
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+()-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z-])")

#: Score before context, threshold, and the context words of each kind.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.35, "local_phone": 0.35}
THRESHOLD = 0.5
CONTEXT = {
    "email": {"email", "mail", "e-mail", "contact", "correo", "courriel"},
    "ip": {"ip", "address", "host", "server", "adresse"},
    "card": {"card", "credit", "visa", "mastercard", "payment", "karte", "carte", "tarjeta"},
    "phone": {"phone", "tel", "telephone", "mobile", "call", "fax", "telefon", "teléfono", "téléphone"},
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta"},
    "ssn": {"ssn", "social", "security", "taxpayer"},
    "local_phone": {"phone", "tel", "telephone", "mobile", "call", "fax", "telefon", "teléfono", "téléphone"},
}
#: Words that speak against personal data.
AGAINST = {"version", "example", "sample", "order", "invoice", "isbn", "part", "model"}
NEAR = 48
UP, DOWN = 0.25, 0.2
_NEAR_WORD = re.compile(r"[^\W\d_](?:[\w-]*[^\W\d_])?")


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum((2 * int(d) - 9 * (d > "4")) for d in digits[-2::-2])) % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _DOTTED.finditer(text):
        if text.count(".", m.start(), m.end()) < 3:
            continue
        at = m.start()
        parts = m[0].split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the base kinds, leftmost and disjoint within a kind."""
    out = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", a, b) for a, b in _ips(text)]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return out


def further_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("iban", *m.span()) for m in _IBAN.finditer(text) if mod97(m[0])]
    out += [("ssn", *m.span()) for m in _SSN.finditer(text)]
    return out + [("local_phone", *m.span()) for m in _LOCAL_PHONE.finditer(text)]


def score(text: str, kind: str, start: int, end: int) -> float:
    """The kind's prior, raised by its context words nearby and lowered by contrary ones."""
    near = {w.lower() for w in _NEAR_WORD.findall(text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR // 2])}
    s = PRIOR[kind] + UP * bool(near & CONTEXT[kind]) - DOWN * bool(near & AGAINST)
    return round(min(1.0, max(0.0, s)), 2)


def find(text: str) -> tuple[list[tuple[str, int, int, float]], list[tuple[str, int, int]]]:
    """All spans with their scores, and the base spans; each by start, then kind.

    A further span that overlaps a base span gives way to it.
    """
    rank = {k: i for i, k in enumerate(KINDS)}
    order = lambda s: (s[1], rank[s[0]])
    base = sorted(base_spans(text), key=order)
    every = [(*s, score(text, *s)) for s in base]
    starts, reach = [s[1] for s in base], list(accumulate((s[2] for s in base), max))
    for s in further_spans(text):
        before = bisect_left(starts, s[2])  # base spans that begin before this one's end
        if before and reach[before - 1] > s[1]:
            continue
        value = score(text, *s)
        if value >= THRESHOLD:
            every.append((*s, value))
    return sorted(every, key=order), base


SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def find_pii(df: DataFrame, text_col: str = "text", keep_text: bool = True, redact: bool = False) -> DataFrame:
    """Adds ``pii`` (array of kind, start, end, score) and ``base_pii`` (array of strings kind:start:end).

    Offsets are code points, the end exclusive.  ``redact`` also replaces every span
    of the text by its kind in brackets.  Null counts as empty and has no spans (with
    ``redact`` it stays null).  Rows are independent: null or repeated ids and repeated
    rows change nothing, an empty table gives an empty result.  Long texts are read
    in one pass.  Input columns with the name of an added column are replaced.
    """

    def make():
        def compute(texts):
            spans, base, redacted = [], [], []
            for t in texts:
                every, plain = find(t) if t else ([], [])
                spans.append([dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in every])
                base.append([f"{k}:{a}:{b}" for k, a, b in plain])
                if redact:
                    redacted.append(_redacted(t, every))
            return [spans, base, redacted] if redact else [spans, base]

        return compute

    fields = [T.StructField("pii", T.ArrayType(SPAN)), T.StructField("base_pii", T.ArrayType(T.StringType()))]
    if redact:
        fields.append(T.StructField("redacted", T.StringType()))
    return add_columns(df, [text_col], fields, make, () if keep_text else (text_col,))


def _redacted(text: str | None, spans: list[tuple[str, int, int, float]]) -> str | None:
    if not text:
        return text
    out, at = [], 0
    for kind, a, b, _ in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def query(spark, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)

    def n(kind: str):
        return F.size(F.filter("base_pii", lambda s: s.startswith(kind + ":"))).cast("long").alias(f"n_{kind}")

    label = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    return found.select(
        "doc_id",
        *map(n, BASE_KINDS),
        F.sha2(F.array_join("base_pii", ","), 256).alias("base_sha256"),
        F.array_join(F.transform("pii", label), ",").alias("spans"),
        F.array_max(F.transform("pii", lambda s: s["score"])).alias("top_score"),
    )

"""Main text of web pages: a linear-chain CRF over the leaf blocks of the DOM.

A page is cut into leaf blocks (runs of inline content under one block element).
Each block has features from its ancestors' tags, classes, ids and roles, from
whether they are hidden, and from its text.  A linear-chain conditional random field with two labels, trained on
labelled pages, is decoded by Viterbi; blocks labelled as content make the text.

The labelled pages are made by ``labelled_pages``: layouts drawn at random with
known labels, with and without semantic elements and telling class names.
"""

from __future__ import annotations

import html as _html
import math
import random
import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import add_columns, table

#: Pages, seed and passes of the training.
TRAINING_PAGES, TRAINING_SEED, TRAINING_PASSES = 480, 11, 6

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup; without an end tag they last to the page's end, as in browsers.
_RAW = frozenset("script style iframe textarea title".split())
#: Elements with text of their own: it makes blocks apart from the text around, with the element's tag as a feature.
_APART = frozenset("template noscript svg object select canvas audio video".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td"
    " tfoot th thead tr ul".split()
)
#: An open element that ends when one of the second set begins inside it.
_CLOSES = {
    "p": _BLOCK - {"body", "html", "head", "option", "legend", "caption", "tbody", "tr", "td", "th", "thead", "tfoot"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody"},
    "th": {"td", "th", "tr", "tbody"}, "option": {"option"}, "head": {"body"},
}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)>",
    re.S,
)
_APART_END = re.compile(rf"</({'|'.join(sorted(_APART))})(?![A-Za-z0-9:-])", re.I)
#: The beginning of a tag; one after the page's last > never ends.
_BEGINS = re.compile(r"<(?:[A-Za-z/!?]|\Z)")
#: A name with its value, if any; a name inside a quoted value is no name.
_ATTRIBUTE = re.compile(r"""([^\s/>=][^\s/>=]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_HIDING = re.compile(r"display\s*:\s*none", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@lru_cache(maxsize=100_000)
def _kinds(word: str) -> tuple[str, ...]:
    return _KINDS.get(word) or tuple(k for start, k in KIND_STARTS.items() if word.startswith(start))


@dataclass
class Element:
    tag: str
    features: tuple[str, ...] = ()
    closed: bool = False  # by its own end tag

    @property
    def hidden(self) -> bool:
        return "hidden" in self.features


@dataclass
class Block:
    text: str
    path: list[Element] = field(default_factory=list)
    linked: int = 0


def _element(tag: str, attributes: str) -> Element:
    found = [f"tag={tag}"]
    if attributes and not attributes.isspace():
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or "").strip("\"'")
            if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true" or name == "style" and _HIDING.search(value):
                found.append("hidden")
            elif name in ("class", "id", "role"):
                for w in dict.fromkeys(x.lower() for x in _PART.findall(value)):
                    found.append(f"name={w}")
                    found += [f"kind={k}" for k in _kinds(w)]
    return Element(tag, tuple(dict.fromkeys(found)))


#: Words in class, id and role names, by what they tell; fixed values.
KIND_WORDS = {
    "menu": "nav navigation navbar menu menubar breadcrumb breadcrumbs toc tabs pager pagination crumbs topbar toolbar",
    "frame": "header masthead footer foot copyright legal banner contentinfo colophon logo branding bottom tagline",
    "side": "sidebar side aside complementary widget widgets rail related recommended recommendations popular trending more teaser links archive tags tagcloud",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promotions adsense dfp commercial outbrain taboola partner",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay dialog subscribe newsletter signup paywall warning message",
    "form": "form search login signin register contact survey poll input",
    "talk": "comment comments reply replies respond disqus discussion feedback responses reader commentlist thread",
    "share": "share sharing social follow facebook twitter buttons",
    "main": "article content main post entry story text body blog prose page single maincontent articlebody hentry",
}
#: Beginnings that tell the kind of a compound name such as adsbygoogle; fixed values.
KIND_STARTS = {
    "ads": "ad", "advert": "ad", "sponsor": "ad", "promo": "ad", "comment": "talk", "sidebar": "side", "footer": "frame",
    "navig": "menu", "cookie": "notice", "newsletter": "notice", "share": "share", "social": "share",
}
_KINDS: dict[str, tuple[str, ...]] = {}
for _k, _words in KIND_WORDS.items():
    for _w in _words.split():
        _KINDS[_w] = (*_KINDS.get(_w, ()), _k)


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page, in page order; elements never closed end with the page.

    An element of _APART without its end tag is ignored: what follows is not its content.
    """
    out: list[Block] = []
    stack: list[Element] = []
    pieces: list[str] = []
    linked = in_link = at = 0
    apart: list[Element] = []  # open elements of _APART
    held: tuple[Element | None, list[Element]] | None = None  # the innermost of them where the pieces' text began, and the path there
    unended = _BEGINS.search(page, page.rfind(">") + 1)
    page = page[: unended.start()] if unended else page
    ends = {e[1].lower(): e.start() for e in _APART_END.finditer(page)}  # where the last end tag of each is

    def path() -> list[Element]:
        return [e for e in stack if e.tag in _BLOCK or e.tag in _APART]

    def flush() -> None:
        nonlocal linked, held
        if pieces:
            text = " ".join(_html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                same = held is None or held[0] is (apart[-1] if apart else None)
                out.append(Block(text, path() if same else held[1], min(linked, len(text))))
        linked, held = 0, None

    def pop(i: int) -> None:
        nonlocal in_link
        in_link -= sum(e.tag == "a" for e in stack[i:])
        for e in reversed(stack[i:]):
            if apart and e is apart[-1]:
                apart.pop()
        del stack[i:]

    end = len(page)
    m = _TOKEN.search(page)
    while True:
        upto = m.start() if m else end
        if upto > at:
            piece = page[at:upto]
            if ends and not piece.isspace():
                inner = apart[-1] if apart else None
                if held and held[0] is not inner:
                    flush()
                held = held or (inner, path())
            pieces.append(piece)
            if in_link:
                linked += len(piece)
        if not m:
            break
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if tag:
            tag = tag.lower()
            if tag == "text":  # of svg
                pieces.append(" ")
            if tag in _RAW and not closing:
                if not attributes.endswith("/"):
                    close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                    at = close.end() if close else end
                if tag == "title":
                    pieces.append(" ")
            elif tag == "br":
                pieces.append(" ")
            elif closing:
                i = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag), -1)
                if tag in _BLOCK:
                    flush()
                if i >= 0:
                    stack[i].closed = True
                    pop(i)
            elif tag in _VOID:
                if tag in _BLOCK:
                    flush()
            else:
                if tag in _BLOCK:
                    flush()
                    for i in range(len(stack) - 1, -1, -1):
                        open_tag = stack[i].tag
                        if tag in _CLOSES.get(open_tag, ()):
                            pop(i)
                        elif open_tag in _SCOPE.get(tag, ()) or tag in _SCOPE and open_tag == "table" or open_tag in _APART:
                            break
                        elif open_tag in _BLOCK and tag not in _SCOPE:
                            break
                if not attributes.endswith("/") and (tag not in _APART or ends.get(tag, -1) >= at):
                    stack.append(_element(tag, attributes))
                    in_link += tag == "a"
                    if tag in _APART:
                        apart.append(stack[-1])
        m = _TOKEN.search(page, at)
    flush()
    if ends:
        for b in out:
            b.path = [e for e in b.path if e.closed or e.tag not in _APART]
    return out


_END = re.compile(r"[.!?…:;\"'»”)]\W*\Z")


def features(found: list[Block]) -> list[list[str]]:
    """The features of every block of a page."""
    n, rows = len(found), []
    longest = max((len(b.text) for b in found), default=1)
    whole = sum(len(b.text) for b in found)
    within: dict[int, int] = {}  # characters in each hidden element
    for b in found:
        for e in b.path:
            if e.hidden:
                within[id(e)] = within.get(id(e), 0) + len(b.text)
    for i, b in enumerate(found):
        tags = [e.tag for e in b.path]
        row = ["bias", f"leaf={tags[-1] if tags else ''}"]
        seen = set()
        for depth, e in enumerate(reversed(b.path)):
            for f in e.features:
                seen.add(f)
                if depth < 2 and not f.startswith("tag="):
                    seen.add(f"near:{f}")
        row += sorted(seen)
        if within and (most := max((within.get(id(e), 0) for e in b.path), default=0)):
            row.append(f"unseen={min(3, most * 4 // whole)}")
        words = b.text.count(" ") + 1
        density = b.linked / max(1, len(b.text))
        row += [
            f"words={min(7, int(math.log2(words)))}",
            f"link={0 if density == 0 else 1 + min(3, int(density * 4))}",
            f"end={bool(_END.search(b.text))}",
            f"size={min(6, int(math.log2(max(1, longest / len(b.text)))))}",
        ]
        if "©" in b.text[:40] or "copyright" in b.text[:60].lower():
            row.append("sign=copyright")
        if i == 0:
            row.append("at=first")
        if i == n - 1:
            row.append("at=last")
        if len(b.path) > 1:
            row.append(f"parent={b.path[-2].tag}")
            row += [f"parent:{f}" for f in b.path[-2].features if not f.startswith("tag=")]
        rows.append(row)
    return rows


def relations(found: list[Block]) -> list[int]:
    """For each block but the first 0 if it has the same parent element as the one before, else 1."""
    parent = [id(b.path[-2]) if len(b.path) > 1 else 0 for b in found]
    return [int(a != b) for a, b in zip(parent, parent[1:], strict=False)]


@dataclass
class Crf:
    """Weights content minus other for each feature; scores of equal neighbouring labels by relation."""

    weights: dict[str, float]
    same: tuple[float, float]

    def decode(self, rows: list[list[str]], between: list[int]) -> list[bool]:
        """Viterbi over two labels."""
        if not rows:
            return []
        get = self.weights.get
        back: list[tuple[bool, bool]] = []
        a = b = 0.0  # best path that ends in other, in content
        for i, row in enumerate(rows):
            s = sum([get(f, 0.0) for f in row])
            if i:
                same = self.same[between[i - 1]]
                to_a, to_b = a + same >= b, b + same >= a
                back.append((not to_a, to_b))
                a, b = max(a + same, b), max(b + same, a) + s
            else:
                b = s
        label = b > a
        out = [label]
        for to_a, to_b in reversed(back):
            label = to_b if label else to_a
            out.append(label)
        return out[::-1]


def train(pages: list[tuple[str, list[bool]]], passes: int = TRAINING_PASSES, rate: float = 0.3, decay: float = 1e-5, seed: int = 3) -> Crf:
    """Fits the field by stochastic gradient ascent (AdaGrad) on the conditional likelihood."""
    rng = random.Random(seed)
    names: dict[str, int] = {}
    data = []
    for page, labels in pages:
        found = blocks(page)
        rows = features(found)
        if len(rows) != len(labels):
            raise ValueError("labels do not fit the page's blocks")
        data.append(([[names.setdefault(f, len(names)) for f in r] for r in rows], relations(found), labels))
    w, g = np.zeros(len(names)), np.full(len(names), 1e-6)
    same, same_g = [0.5, 0.0], [1e-6, 1e-6]
    for _ in range(passes):
        rng.shuffle(data)
        for rows, between, labels in data:
            if not rows:
                continue
            s = [float(w[r].sum()) for r in rows]
            p, equal = _marginals(s, [same[k] for k in between])
            for r, y, q in zip(rows, labels, p, strict=True):
                step = (1.0 if y else 0.0) - q - decay * w[r]
                g[r] += step * step
                w[r] += rate * step / np.sqrt(g[r])
            for k in (0, 1):
                d = sum((labels[i + 1] == labels[i]) - equal[i] for i in range(len(between)) if between[i] == k)
                same_g[k] += d * d
                same[k] += rate * d / math.sqrt(same_g[k])
    return Crf({n: round(float(w[i]), 4) for n, i in names.items() if abs(w[i]) > 1e-3}, (round(same[0], 4), round(same[1], 4)))


def _marginals(s: list[float], same: list[float]) -> tuple[list[float], list[float]]:
    """Chance of content at each block, and of equal labels at each pair of neighbours."""
    add = lambda x, y: max(x, y) + math.log1p(math.exp(-abs(x - y)))
    n = len(s)
    fa, fb = [0.0] * n, [0.0] * n
    fb[0] = s[0]
    for i in range(1, n):
        k = same[i - 1]
        fa[i] = add(fa[i - 1] + k, fb[i - 1])
        fb[i] = add(fb[i - 1] + k, fa[i - 1]) + s[i]
    ba, bb = [0.0] * n, [0.0] * n
    for i in range(n - 2, -1, -1):
        k = same[i]
        ba[i] = add(ba[i + 1] + k, bb[i + 1] + s[i + 1])
        bb[i] = add(bb[i + 1] + s[i + 1] + k, ba[i + 1])
    z = add(fa[-1], fb[-1])
    p = [math.exp(min(0.0, fb[i] + bb[i] - z)) for i in range(n)]
    equal = [
        math.exp(fa[i] + same[i] + ba[i + 1] - z) + math.exp(fb[i] + same[i] + s[i + 1] + bb[i + 1] - z) for i in range(n - 1)
    ]
    return p, equal


def labelled_pages(n: int = TRAINING_PAGES, seed: int = TRAINING_SEED) -> list[tuple[str, list[bool]]]:
    """Pages of random layouts with the label of each leaf block, in order."""
    return [_page(random.Random(f"{seed}:{i}")) for i in range(n)]


def _page(r: random.Random) -> tuple[str, list[bool]]:
    out: list[str] = []
    labels: list[bool] = []
    semantic, telling = r.random() < 0.55, r.random() < 0.7
    syllables = "ba co de fi gu la mo ne pi ra so tu ve zu en th er st ou".split()

    def word() -> str:
        return "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))

    def words(low: int, high: int) -> str:
        return " ".join(word() for _ in range(r.randint(low, high))).capitalize()

    def sentence(low: int = 4, high: int = 60) -> str:
        return words(low, high) + r.choice(("", "###", "***", ".", ".", ".", ".", "!", "?"))

    def name(kind: str) -> str:
        if not telling:
            return f' class="{r.choice("abcdexyz")}{r.randint(1, 99)}"' if r.random() < 0.7 else ""
        word_ = r.choice(KIND_WORDS[kind].split())
        return f' {r.choice(("class", "class", "id"))}="{r.choice(("", "site-", "page-", "main-" if kind == "main" else "the-"))}{word_}"'

    def tagged(tag: str, kind: str) -> tuple[str, str]:
        t = tag if semantic else "div"
        a = name(kind) if not semantic or r.random() < 0.5 else ""
        return f"<{t}{a}>", f"</{t}>"

    def block(tag: str, text: str, label: bool, attributes: str = "", closed: bool = True) -> None:
        out.append(f"<{tag}{attributes}>{text}" + (f"</{tag}>" if closed else ""))
        labels.append(label)

    def link(text: str) -> str:
        return f'<a href="/{word()}">{text}</a>'

    def links(low: int, high: int) -> None:
        out.append("<ul>")
        for _ in range(r.randint(low, high)):
            block("li", link(words(1, 5)), False)
        out.append("</ul>")

    def menu() -> None:
        a, z = tagged("nav", "menu")
        out.append(a)
        links(2, 9) if r.random() < 0.7 else block("div", " | ".join(link(words(1, 2)) for _ in range(r.randint(2, 6))), False)
        out.append(z)

    def header() -> None:
        a, z = tagged("header", "frame")
        out.append(a)
        block(r.choice(("div", "p", "h2")), link(words(1, 4)) if r.random() < 0.5 else words(1, 4), False)
        if r.random() < 0.5:
            block("p", sentence(3, 9), False)
        if r.random() < 0.4:
            menu()
        out.append(z)

    def advert() -> None:
        out.append(f'<div{name("ad") if telling or r.random() < 0.7 else ""}>' if not semantic or r.random() < 0.5 else '<div class="ad">')
        tag = r.choice(("", "p", "span"))
        out.append(f"<{tag}>" * bool(tag) + (link(words(3, 12)) if r.random() < 0.5 else sentence(4, 18)) + f"</{tag}>" * bool(tag) + "</div>")
        labels.append(False)

    def notice() -> None:
        out.append(f'<div{name("notice")}>')
        block("p", sentence(6, 24), False)
        if r.random() < 0.6:
            out.append("<button>" + words(1, 2) + "</button>")
            labels.append(False)
        out.append("</div>")

    def form() -> None:
        out.append(f'<form action="/{word()}"{name("form") if telling else ""}>')
        block(r.choice(("p", "div", "legend")), sentence(2, 12), False)
        out.append('<input name="q">')
        if r.random() < 0.5:
            out.append(f"<button>{words(1, 2)}</button>")
            labels.append(False)
        out.append("</form>")

    def side() -> None:
        a, z = tagged("aside", "side")
        out.append(a)
        block(r.choice(("h2", "h3", "h4")), words(1, 4), False)
        if r.random() < 0.7:
            links(2, 7)
        else:
            for _ in range(r.randint(1, 3)):
                block("p", sentence(4, 30), False)
        out.append(z)

    def talk() -> None:
        a, z = f'<{"section" if semantic else "div"}{name("talk") if telling or semantic and r.random() < 0.8 else " id=comments"}>', f'</{"section" if semantic else "div"}>'
        out.append(a)
        block(r.choice(("h2", "h3")), words(1, 3), False)
        for _ in range(r.randint(1, 5)):
            out.append(f'<div class="{r.choice(("comment", "reply", "comment-body", "response"))}">')
            if r.random() < 0.6:
                block(r.choice(("p", "div", "h4")), words(1, 3), False)
            for _ in range(r.randint(1, 2)):
                block("p", sentence(3, 50), False)
            out.append("</div>")
        out.append(z)

    def hiding() -> str:
        return r.choice((" hidden", ' hidden=""', ' aria-hidden="true"', ' style="display:none"', ' style="margin:0; display: none"'))

    def unseen() -> None:  # a hidden dialog, hint or template of a list
        out.append(f'<div{name(r.choice(("notice", "menu", "form", "side", "ad"))) if r.random() < 0.5 else ""}{hiding()}>')
        for _ in range(r.randint(1, 3)):
            block(r.choice(("p", "p", "div", "li")), sentence(2, 40), False)
        out.append("</div>")

    def apart(content: bool) -> None:  # an element with text of its own
        if content:
            tag = r.choice(("object", "object", "noscript", "template", "svg"))
            out.append(f"<{tag}>")
            if tag == "svg":
                for _ in range(r.randint(1, 4)):
                    out.append(f"<text>{words(1, 3)}</text>")
                labels.append(True)
            else:
                for _ in range(r.randint(1, 3)):
                    block("p", " ".join(sentence(4, 40) for _ in range(r.randint(1, 3))), True)
        else:
            tag = r.choice(("select", "select", "noscript", "canvas", "audio", "video", "template", "svg"))
            out.append(f"<{tag}>")
            if tag == "select":
                for _ in range(r.randint(2, 6)):
                    block("option", words(1, 3), False)
            else:
                out.append(words(1, 2) if tag == "svg" else sentence(4, 14))
                labels.append(False)
        out.append(f"</{tag}>")

    def share() -> None:
        out.append(f'<div{name("share")}>')
        out.append(" ".join(link(words(1, 1)) for _ in range(r.randint(2, 4))) + "</div>")
        labels.append(False)

    def footer() -> None:
        a, z = tagged("footer", "frame")
        out.append(a)
        if r.random() < 0.4:
            links(2, 5)
        if r.random() < 0.5:
            block("p", r.choice(("&copy; ", "Copyright ", "")) + sentence(2, 14), False)
        else:
            out.append(r.choice(("&copy; ", "")) + word() + ".example &middot; " + sentence(2, 12))
            labels.append(False)
        out.append(z)

    def article() -> None:
        a, z = (f"<article{name('main') if r.random() < 0.3 else ''}>", "</article>") if semantic else (f"<div{name('main')}>", "</div>")
        if r.random() < 0.12:  # content that is folded, or behind an open dialog
            a = a[:-1] + hiding() + ">"
        if r.random() < 0.15:  # content that stands in the page itself
            a = z = ""
        out.append(a)
        if r.random() < 0.85:
            block("h1", words(2, 12), True)
        for i in range(r.randint(1, 14)):
            x = r.random()
            if x < 0.60:
                block("p", f"<b>{sentence(1, 60)}<br>" if r.random() < 0.15 else " ".join(sentence(1, 40) for _ in range(r.randint(1, 5))), True, closed=r.random() < 0.85)
            elif x < 0.66:
                block(r.choice(("h2", "h3")), words(1, 8), True)
            elif x < 0.72:
                out.append("<ul>")
                for _ in range(r.randint(2, 5)):
                    block("li", sentence(2, 14), True)
                out.append("</ul>")
            elif x < 0.76:
                block("blockquote", sentence(5, 30), True)
            elif x < 0.79:
                block("p", sentence(5, 20) + " " + link(words(1, 3)) + " " + sentence(3, 20), True)
            elif x < 0.81:
                out.append("<table><tr>")
                for _ in range(r.randint(2, 4)):
                    block("td", words(1, 3), True)
                out.append("</tr></table>")
            elif x < 0.83:
                block("pre", words(3, 20), True)
            elif x < 0.87:
                apart(r.random() < 0.5)
            elif i and i < 13 and r.random() < 0.9:
                r.choice((advert, advert, form, share, notice, side, unseen))()
        if r.random() < 0.2:
            talk()
        out.append(z)

    out.append("<!DOCTYPE html><html><head><meta charset=utf-8><title>" + words(2, 9) + "</title><style>p{}</style></head><body>")
    for part in r.sample((menu, header, notice, advert, side, form, unseen), r.randint(1, 4)):
        part()
    if r.random() < 0.15:
        apart(False)
    if r.random() < 0.5:
        out.append(("<main" if semantic else "<div") + (hiding() if r.random() < 0.12 else "") + ">")
    if r.random() < 0.97:
        article()
    for part in r.sample((share, advert, side, form, notice, unseen), r.randint(0, 2)):
        part()
    if r.random() < 0.4:
        talk()
    if r.random() < 0.9:
        footer()
    out.append("</body></html>")
    page = "".join(out)
    return page, labels


_trained: list[Crf] = []


def trained() -> Crf:
    """The field of the default training, fitted once a process."""
    if not _trained:
        _trained.append(train(labelled_pages()))
    return _trained[0]


def main_text(page: str | None, crf: Crf) -> str:
    found = blocks(page) if page else []
    return "\n\n".join([b.text for b, keep in zip(found, crf.decode(features(found), relations(found)), strict=True) if keep])


def extract(df: DataFrame, html_col: str = "html", crf: Crf | None = None, keep_html: bool = True) -> DataFrame:
    """Adds ``text``, the page's main text: content blocks joined by an empty line, and ``n_chars``.

    Character references are decoded and white space within a block is one space.
    Null, empty and blockless pages have the empty text.  Elements never closed end
    with the page, and object, svg and the like then count for nothing; a tag cut off by the page's end is dropped.  Rows are independent:
    null or repeated ids and repeated rows change nothing, an empty table gives an
    empty result.  Input columns with the name of an added column are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(crf or trained())  # some thousand weights

    def make():
        def compute(pages):
            texts = [main_text(p, shared.value) for p in pages]
            return [texts, [len(t) for t in texts]]

        return compute

    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return add_columns(df, [html_col], fields, make, () if keep_html else (html_col,))


def query(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, keep_html=False).select("page_id", "url", "text", "n_chars")

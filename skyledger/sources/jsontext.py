"""JSON documents as flat text rows, through variants."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..cluster import written
from ..functions.text import shown, trim as trimmed
from ..operators.joins import GuardError
from .ranges import CUT, HEAD, MIDDLE, TAIL, WHOLE, joined_records, over_ranges, pieces, states, with_states


def _path(keys: tuple[str, ...]) -> str:
    return "$" + "".join(f"[{k!r}]" if "'" not in k else f'["{k}"]' for k in keys)


def flat_text(v: Column, keys: tuple[str, ...]) -> Column:
    """A leaf as text: arrays and their objects as JSON, numbers in short form, null as empty."""
    at = F.try_variant_get(v, _path(keys), "variant")
    kind = F.schema_of_variant(at)
    number = F.try_variant_get(v, _path(keys), "double")
    return F.coalesce(
        F.when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), F.to_json(at))
        .when(kind.isin("DOUBLE", "FLOAT") | kind.startswith("DECIMAL"), shown(number))
        .when(kind != "VOID", F.try_variant_get(v, _path(keys), "string")),
        F.lit(""),
    )


def _leaves(t: T.DataType, at: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    if isinstance(t, T.StructType):
        return [leaf for f in t.fields for leaf in _leaves(f.dataType, (*at, f.name))]
    return [at]


_ESCAPE = re.compile(r"\\.", re.DOTALL)
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]:]', re.DOTALL)
_BETWEEN = " \t\r\n,\ufeff"
_BETWEEN_BYTES = b" \t\r\n,"
#: Cuts of other kinds: the array begins; what is no object stands where a record should.
FOUND, NO_OBJECT = 8, 9


#: By how much a byte opens brackets.
_STEP = np.zeros(256, dtype=np.int8)
_STEP[[ord("{"), ord("[")]], _STEP[[ord("}"), ord("]")]] = 1, -1
_ESCAPED = re.compile(rb"\\.", re.DOTALL)


def effect_of(piece: str, inside: int) -> tuple[int, int]:
    """Whether the end of a piece is inside a string, and by how much its brackets open, if its begin is ``inside`` (0 or 1)."""
    parts = (_ESCAPE.sub("", piece) if "\\" in piece else piece).split('"')
    outside = "".join(parts[inside::2])
    depth = outside.count("{") + outside.count("[") - outside.count("}") - outside.count("]")
    return (inside + len(parts) - 1) & 1, depth


def depths_of(text: bytes, inside: int, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a text with blanks for its escapes, and after each of them whether it is inside a string, and the depth."""
    bytes_ = np.frombuffer(_ESCAPED.sub(b"  ", text) if b"\\" in text else text, dtype=np.uint8)
    strings = np.cumsum(bytes_ == 34, dtype=np.uint8) & 1 ^ inside
    depths = np.cumsum(np.where(strings, 0, _STEP[bytes_]), dtype=np.int32)
    depths += depth
    return bytes_, strings, depths


class Walk:
    """Goes through pieces outside the array of records, and notes the keys on the way to it."""

    def __init__(self, keys: tuple[str, ...], depth: int = 0, path: dict[int, str] | None = None):
        self.keys, self.depth, self.path, self.found = keys, depth, dict(path or {}), False

    def on_the_way(self) -> bool:
        return all(self.path.get(i + 1) == k for i, k in enumerate(self.keys))

    def step(self, text: str) -> str | None:
        """Takes a text that begins and ends outside strings; gives what follows the array's bracket, once it opens."""
        last = None
        for m in _TOKEN.finditer(text):
            token = m[0]
            if token[0] == '"':
                last = token
            elif token == ":":
                if self.depth <= len(self.keys):
                    self.path[self.depth] = json.loads(last)
            elif token in "{[":
                if token == "[" and self.depth == len(self.keys) and self.on_the_way():
                    self.depth, self.found = self.depth + 1, True
                    return text[m.end() :]
                self.depth += 1
            else:
                self.path.pop(self.depth, None)
                self.depth -= 1
        return None


def _cut_whole(pieces_: list[str], inside: int, depth: int, level: int, between: bool) -> tuple[list[str], str, int, int] | None:
    """Pieces within the array at ``level``: the ends of its objects, what follows the last one, and the state then.

    None if the array ends in them, or something else than an object begins.
    """
    text = ("}".join(pieces_) + "}").encode()
    bytes_, strings, depths = depths_of(text, inside, depth)
    if min(depth, int(depths.min())) < level:
        return None
    ends = (np.flatnonzero((bytes_ == 125) & (strings == 0) & (depths == level)) + 1).tolist()
    found = [text[a:b] for a, b in zip([0, *ends], [*ends, len(text)], strict=True)]
    if between:
        found[0] = found[0].lstrip(_BETWEEN_BYTES)
    found[1:] = [x.lstrip(_BETWEEN_BYTES) for x in found[1:]]
    begun = found if between else found[1:]
    if not all(x[:1] == b"{" for x in begun[:-1]) or begun and begun[-1] and begun[-1][:1] != b"{":
        return None
    *records, rest = [x.decode() for x in found]
    return records, rest, int(strings[-1]), int(depths[-1])


def _cut(keys: tuple[str, ...], key: tuple, lists: Iterator[list[str]]) -> Iterator[tuple]:
    """The records of one range of pieces, each up to a closing brace, which is put back.

    An element of the array that is an object ends with a piece that ends outside strings at the array's depth.
    A list of pieces that stays in the array, and holds objects only, is cut as a whole; others piece by piece.
    """
    file, start, inside, depth, path = key
    level = len(keys) + 1
    walk = Walk(keys, depth, {p["depth"]: p["key"] for p in json.loads(path or "[]")})
    in_array = depth >= level and walk.on_the_way()
    between = in_array and depth == level and not inside
    kind, held, seq = (HEAD if in_array and not between else WHOLE), [], 0
    waiting: list[str] = ['"'] if inside and not in_array else []  # outside the array: what is in an open string
    for pieces_ in lists:
        whole = _cut_whole(pieces_, inside, depth, level, between) if in_array else None
        if whole is not None:
            found, rest, inside, depth = whole
            for text in found:
                yield file, start, seq, kind, "".join([*held, text])
                seq, held, kind = seq + 1, [], WHOLE
            if rest:
                held.append(rest)
            between = not rest
            continue
        for piece in pieces_:
            text: str | None = piece + "}"
            while text is not None:
                if not in_array:
                    inside, _ = effect_of(text, inside)
                    waiting.append(text)
                    if inside:
                        break
                    text, waiting = walk.step("".join(waiting)), []
                    if text is not None:
                        in_array, between, depth = True, True, level
                        yield file, start, -1, FOUND, ""
                    continue
                if between:
                    text = text.lstrip(_BETWEEN)
                    if text.startswith("]"):
                        walk.depth, in_array, between, text = level - 1, False, False, text[1:]
                        continue
                    if not text.startswith("{"):
                        yield file, start, seq, NO_OBJECT, text[:200]
                        return
                    between = False
                inside, more = effect_of(text, inside)
                depth += more
                held.append(text)
                if not inside and depth == level:
                    yield file, start, seq, kind, "".join(held)
                    seq, held, kind, between = seq + 1, [], WHOLE, True
                break
    if waiting and not in_array:  # the range ends in a string; the array may have begun before it
        text = walk.step("".join(waiting) + '"')
        if text is not None:
            yield file, start, -1, FOUND, ""
            text = text[:-1].lstrip(_BETWEEN)
            held.append(text)
            if not text.startswith("{"):
                yield file, start, seq, NO_OBJECT, text[:200]
    if held:
        yield file, start, seq, MIDDLE if kind == HEAD else TAIL, "".join(held)


def _last_keys(keys: tuple[str, ...], key: tuple, lists: Iterator[list[str]]) -> Iterator[tuple]:
    """(file, start, path): the last key of a range at each depth that leads to the array."""
    file, start, inside, depth = key
    walk, waiting = Walk(keys, depth), []
    if inside:
        waiting.append('"')

    def read(text: str) -> None:
        rest = walk.step(text)
        while rest is not None:  # the array's insides are walked as well
            rest = walk.step(rest)

    for pieces_ in lists:
        if waiting in ([], ['"']) and walk.depth > len(keys):
            _, strings, depths = depths_of(("}".join(pieces_) + "}").encode(), inside, walk.depth)
            if depths.min() > len(keys):  # too deep for such a key
                inside, walk.depth = int(strings[-1]), int(depths[-1])
                waiting = ['"'] if inside else []
                continue
        for piece in pieces_:
            text = piece + "}"
            inside, _ = effect_of(text, inside)
            waiting.append(text)
            if not inside:
                read("".join(waiting))
                waiting = []
    if waiting:
        read("".join(waiting) + '"')
    yield file, start, sorted(walk.path.items())


def cut_array(spark: SparkSession, path: str, keys: tuple[str, ...]) -> DataFrame:
    """(_ord, text): the objects of the array at ``keys``, the text of each; files are split as others are.

    Two readings of every byte range tell its strings and depth, a third one for the keys if there are any; see ``ranges``.
    """

    def effect(key, lists):
        ends, depths = [0, 1], [0, 0]
        for pieces_ in lists:
            text = "}".join(pieces_) + "}"
            for s in (0, 1):
                ends[s], more = effect_of(text, ends[s])
                depths[s] += more
        yield (*key, *ends, *depths)

    parts = pieces(spark, path, "}")
    known = states(over_ranges(parts, effect, "file string, start long, to0 int, to1 int, d0 int, d1 int", lists=True))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.when(F.col("before") == 1, F.col("d1")).otherwise(F.col("d0"))
    known = written(known.select("file", "start", "before", F.coalesce(F.sum(opened).over(before), F.lit(0)).cast("int").alias("depth")), "ranges")
    path_type = "array<struct<depth:int,key:string>>"
    if keys:
        seen = over_ranges(with_states(parts, known), lambda k, texts: _last_keys(keys, k, texts), f"file string, start long, path {path_type}", lists=True)
        last = [F.last(F.expr(f"get(filter(path, x -> x.depth = {d}), 0)"), ignorenulls=True).over(before) for d in range(1, len(keys) + 1)]
        seen = seen.select(F.col("file").alias("of"), F.col("start").alias("at"), F.to_json(F.array_compact(F.array(*last))).alias("path"))
        known = written(known.join(seen, (F.col("file") == F.col("of")) & (F.col("start") == F.col("at"))).drop("of", "at"), "ranges")
    else:
        known = known.withColumn("path", F.lit("[]"))
    cuts = written(over_ranges(with_states(parts, known), lambda k, texts: _cut(keys, k, texts), CUT, lists=True), "records")
    if cuts.where(F.col("kind") == FOUND).isEmpty():
        raise GuardError(f"no array of records at {'.'.join(keys) or 'the root'}")
    bad = cuts.where(F.col("kind") == NO_OBJECT).first()
    if bad:
        raise GuardError(f"a record of {bad['file']} is no object: {bad['text']}")
    return joined_records(cuts.where(F.col("kind") <= MIDDLE), "")


def read_json(spark: SparkSession, path: str, record_path: str = "", trim: bool = False) -> DataFrame:
    """The records of JSON documents as text columns and ``_ord``.

    ``record_path`` leads through objects to the array of records.  Objects become
    dotted columns, arrays JSON text.  A record that is no object, or cannot be read, fails the read.
    """
    keys = tuple(k for k in record_path.split(".") if k)
    records = cut_array(spark, path, keys)
    # The shape follows from one record of each kind; there is a null kind if a record cannot be read.
    mark = F.xxhash64("text")
    kinds = records.select(F.schema_of_variant(F.try_parse_json("text")).alias("kind"), mark.alias("mark")).groupBy("kind").agg(F.min("mark").alias("mark"))
    kinds = written(kinds, "kinds")
    if not kinds.where(F.col("kind").isNull()).isEmpty():
        bad = records.where(F.try_parse_json("text").isNull()).first()
        raise GuardError(f"a record cannot be read: {bad['text'][:200]}")
    of_each = records.join(kinds.select(F.col("mark").alias("_mark")), mark == F.col("_mark"), "left_semi")
    shape = spark.read.json(of_each.select("text").rdd.map(lambda r: r[0])).schema
    rows = records.select("_ord", F.try_parse_json("text").alias("v"))
    cell = (lambda c: trimmed(c)) if trim else (lambda c: c)
    return rows.select("_ord", *[cell(flat_text(F.col("v"), k)).alias(".".join(k)) for k in _leaves(shape)])

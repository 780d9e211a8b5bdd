"""HTML tables and spreadsheets: each file is one task's work and gives rows of cells."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cluster import ship
from ..operators.joins import GuardError
from .shape import shape

ROWS = "path string, sheet int, name string, n int, cells array<string>"


class _Tables(HTMLParser):
    """Cells of a page's tables; a nested table's text belongs to the outer cell."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[str]]] = []
        self.depth, self.text = 0, None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.depth += 1
            if self.depth == 1:
                self.tables.append([])
        elif self.depth == 1 and tag == "tr":
            self._close()
            self.tables[-1].append([])
        elif self.depth == 1 and tag in ("td", "th"):
            self._close()
            if not self.tables[-1]:
                self.tables[-1].append([])
            self.text = []
        elif tag == "br" and self.text is not None:
            self.text.append("\n")

    def handle_endtag(self, tag):
        if tag == "table" and self.depth:
            self._close()
            self.depth -= 1
        elif tag in ("td", "th", "tr") and self.depth == 1:
            self._close()

    def handle_data(self, data):
        if self.text is not None:
            self.text.append(data)

    def _close(self):
        if self.text is not None and self.depth == 1:
            self.tables[-1][-1].append(re.sub(r"[ \t\r\f]+", " ", "".join(self.text)).strip())
            self.text = None


def html_sheets(data: bytes, encoding: str) -> list[tuple[str, list[list[str]]]]:
    p = _Tables()
    p.feed(data.decode(encoding, "replace"))
    p.close()
    return [(f"Sheet{i + 1}", t) for i, t in enumerate(p.tables)]


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def xlsx_sheets(data: bytes, encoding: str) -> list[tuple[str, list[list[str]]]]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")):
                shared.append("".join(t.text or "" for t in si.iter() if _local(t.tag) == "t"))
        relations = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        out = []
        for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter():
            if _local(s.tag) != "sheet":
                continue
            target = relations[next(v for k, v in s.attrib.items() if _local(k) == "id" and k != "id")].lstrip("/")
            rows: list[list[str]] = []
            for r in ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}")).iter():
                if _local(r.tag) != "row":
                    continue
                at = int(r.get("r", len(rows) + 1)) - 1
                rows += [[] for _ in range(at - len(rows) + 1)]
                cells = rows[at]
                for c in r:
                    letters = re.match("[A-Z]+", c.get("r", ""))
                    i = len(cells)
                    if letters:
                        i = 0
                        for x in letters[0]:
                            i = i * 26 + ord(x) - 64
                        i -= 1
                    cells += [""] * (i - len(cells) + 1)
                    kind = c.get("t")
                    value = next((v.text or "" for v in c if _local(v.tag) == "v"), "")
                    if kind == "s":
                        value = shared[int(value)]
                    elif kind == "inlineStr":
                        value = "".join(t.text or "" for t in c.iter() if _local(t.tag) == "t")
                    elif kind == "b":
                        value = "true" if value == "1" else "false"
                    cells[i] = value
            out.append((s.get("name", ""), rows))
        return out


def ods_sheets(data: bytes, encoding: str) -> list[tuple[str, list[list[str]]]]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ElementTree.fromstring(z.read("content.xml"))
    attribute = lambda e, name: next((v for k, v in e.attrib.items() if _local(k) == name), None)
    out = []
    for table in (t for t in root.iter() if _local(t.tag) == "table"):
        rows: list[list[str]] = []
        for r in (r for r in table.iter() if _local(r.tag) == "table-row"):
            cells: list[str] = []
            for c in r:
                if _local(c.tag) not in ("table-cell", "covered-table-cell"):
                    continue
                date, kind = attribute(c, "date-value"), attribute(c, "value-type")
                text = "\n".join("".join(p.itertext()) for p in c if _local(p.tag) == "p")
                value = date if kind == "date" and date else attribute(c, "value") if kind == "float" else text
                cells += [value or ""] * min(int(attribute(c, "number-columns-repeated") or 1), 16384)
            while cells and cells[-1] == "":
                cells.pop()
            repeat = int(attribute(r, "number-rows-repeated") or 1)
            rows += [list(cells) for _ in range(repeat if cells else min(repeat, 1000))]
        while rows and not rows[-1]:
            rows.pop()
        out.append((attribute(table, "name") or "", rows))
    return out


READERS = {"html": html_sheets, "xlsx": xlsx_sheets, "ods": ods_sheets}


def sheet_rows(spark: SparkSession, path: str, kind: str, encoding: str = "utf8") -> DataFrame:
    """(path, sheet, name, n, cells) of every sheet or table of every file."""
    reader, codec = READERS[kind], "utf-8-sig" if encoding == "utf8" else "cp1252"

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"], strict=True):
                for i, (name, rows) in enumerate(reader(bytes(content), codec)):
                    for at in range(0, max(1, len(rows)), 5000):
                        part = rows[at : at + 5000]
                        yield pd.DataFrame(
                            {"path": p, "sheet": i, "name": name, "n": range(at, at + len(part)), "cells": part},
                            columns=["path", "sheet", "name", "n", "cells"],
                        )

    ship(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, ROWS)


def read_sheet(
    spark: SparkSession,
    path: str,
    kind: str,
    sheet: str | int = 0,
    skip_rows: int = 0,
    columns: list[str] | None = None,
    trim: bool = False,
    encoding: str = "utf8",
) -> DataFrame:
    """One sheet of a file (by place or name) as text columns and ``_ord``; blank rows count to ``skip_rows``."""
    rows = sheet_rows(spark, path, kind, encoding)
    mine = rows.where(F.col("sheet") == sheet) if isinstance(sheet, int) else rows.where(F.col("name") == sheet)
    if not mine.limit(1).count():
        raise GuardError(f"no sheet {sheet}")
    return shape(mine.select(F.col("n").alias("_ord"), "n", "cells"), skip_rows, columns, trim)

"""Chapters and paragraphs of HTML and EPUB documents."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

PARAGRAPHS = ("p", "h1", "h2", "h3", "h4", "h5", "h6")
#: Characters of chapters that wait to be handed on.
CHARS = 1 << 20
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class _Element:
    def __init__(self, tag: str, classes: list[str]):
        self.tag, self.classes, self.parts, self.children = tag, classes, [], []

    def text(self, skip: frozenset[str] = frozenset()) -> str:
        return "".join(p if isinstance(p, str) else "" if skip & set(p.classes) else p.text(skip) for p in self.parts)

    def walk(self):
        for p in self.parts:
            if not isinstance(p, str):
                yield p
                yield from p.walk()


class _Tree(HTMLParser):
    """Elements as they are nested by their tags alone: what isn't closed holds all that follows inside its parent."""

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.root = _Element("", [])
        self.open = [self.root]
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        e = _Element(tag, (dict(attrs).get("class") or "").split())
        self.open[-1].parts.append(e)
        if tag not in _VOID and len(self.open) < 400:
            self.open.append(e)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].parts.append(_Element(tag, []))

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                break

    def handle_data(self, data):
        if self.open[-1].tag not in ("script", "style"):
            self.open[-1].parts.append(data)


SKIPPED = frozenset(("caption", "footnote"))


def paragraphs(page: str | None) -> list[str]:
    """Trimmed texts of paragraphs and headings in order, captions and footnotes left out, blank ones dropped."""
    found = [e for e in _Tree(page or "").root.walk() if e.tag in PARAGRAPHS and not SKIPPED & set(e.classes)]
    return [t for e in found if (t := e.text(SKIPPED).strip())]


def _is_marker(e: _Element) -> bool:
    return e.tag in ("h2", "div") and any("chapter" in c for c in e.classes)


def chapters(page: str | None, strict: bool = False) -> list[str]:
    """Texts between chapter markers: h2 or div with a class that names a chapter, else every h2, else the whole page.

    A chapter is what follows its marker among its siblings up to the next one. ``strict`` leaves out the last block
    before a following marker, as the known tool does.
    """
    root = _Tree(page or "").root
    parents = [root, *root.walk()]
    is_marker = _is_marker if any(_is_marker(e) for e in root.walk()) else lambda e: e.tag == "h2"
    out = []
    for parent in parents:
        kids = [p for p in parent.parts if not isinstance(p, str)]
        for k, e in enumerate(kids):
            if is_marker(e):
                end = next((j for j in range(k + 1, len(kids)) if is_marker(kids[j])), len(kids))
                stop = end - 1 if strict and end < len(kids) and end > k + 1 else end
                inside = [e, *kids[k + 1 : stop]] if e.tag == "div" else kids[k + 1 : stop]
                texts = [x.text(SKIPPED).strip() for x in inside if not SKIPPED & set(x.classes)]
                if any(texts):
                    out.append("\n\n".join(t for t in texts if t))
    if out:
        return out
    found = paragraphs(page)
    return ["\n\n".join(found)] * bool(found)


def paragraph_text(page: Column) -> Column:
    return F.pandas_udf(lambda s: s.map(lambda x: "\n\n".join(paragraphs(x))), "string")(page)


def chapter_rows(pages: DataFrame, key: str, page: str) -> DataFrame:
    """(key, ord, text): a row for each chapter, handed on whenever ``CHARS`` of them are there.

    One page's tree is there at a time, and chapters of many pages never wait for each other.
    """
    kind = pages.select(key).schema[0].dataType

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [key, "ord", "text"]
        for batch in batches:
            for rows in _portions(batch.column(1)):
                place, order, texts = zip(*rows, strict=True)
                taken = batch.column(0).take(pa.array(place, pa.int64()))
                yield pa.RecordBatch.from_arrays([taken, pa.array(order, pa.int32()), pa.array(texts, pa.string())], names)

    return pages.select(key, F.col(page).cast("string").alias("page")).mapInArrow(split, f"`{key}` {kind.simpleString()}, ord int, text string")


def _portions(column: pa.Array) -> Iterator[list[tuple[int, int, str]]]:
    """Rows (page, ord, text) of a batch's pages, cut after the page with which they pass ``CHARS``."""
    rows, size = [], 0
    for k in range(len(column)):
        for n, t in enumerate(chapters(column[k].as_py())):
            rows.append((k, n, t))
            size += len(t)
        if size > CHARS:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def epub_chapters(content: bytes) -> list[str]:
    """Chapters of the documents in an EPUB file in the order of their names, covers and contents left out."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = [n for n in sorted(z.namelist()) if n.lower().endswith((".html", ".xhtml", ".htm")) and not re.search("cover|toc", n.lower())]
        return [c for n in names for c in chapters(z.read(n).decode("utf-8", "replace"))]


def epub_rows(files: DataFrame) -> DataFrame:
    """(path, ord, text) of files as the binary reader gives them (path, content)."""

    def split(batches):
        for pdf in batches:
            rows = [(p, k, t) for p, c in zip(pdf.path, pdf.content, strict=True) for k, t in enumerate(epub_chapters(c))]
            yield pd.DataFrame(rows, columns=["path", "ord", "text"])

    return files.select("path", "content").mapInPandas(split, "path string, ord int, text string")


def grouped(rows: DataFrame, book: str, order: str, text: str, n: int) -> DataFrame:
    """Every n chapters of a book joined by blank lines: book, part, text."""
    n = max(1, n)
    pairs = F.array_sort(F.collect_list(F.struct(order, text)))
    out = rows.groupBy(book, F.floor(F.col(order) / n).cast("int").alias("part")).agg(pairs.alias("x"))
    return out.select(book, "part", F.array_join(F.col(f"x.{text}"), "\n\n").alias("text"))

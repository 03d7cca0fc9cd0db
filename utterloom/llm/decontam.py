"""Benchmark decontamination: an FM-index over each training shard, searched for all benchmark phrases at once.

A shard is a bounded run of rows of one partition. Its words become symbols of the benchmark's vocabulary; a word that
no phrase has can't be part of an occurrence and becomes a break, and so does a run of words too short for any phrase.
What is left is indexed by its Burrows-Wheeler transform: phrases are found by backward search through wavelet-tree
ranks, located by sampled suffix positions, and their spans merged. Texts are never shuffled.

The benchmark is read in blocks of at most ``BLOCK_BYTES`` (one, for usual sizes); each block is broadcast and searched
in a pass of its own, and spans are united before anything is counted or removed.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from utterloom.llm.common import unique_name
from utterloom.llm.fm_index import FMIndex

BLOCK_BYTES = 16 << 20
SHARD_WORDS = 1 << 20
#: Lower-cases A-Z and blanks the other ASCII characters that are not digits or letters.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


class Phrases:
    """Windows of benchmark items as rows of word ids, by length; ids start at 1."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            w = [self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in words(text)]
            for at in range(max(1, len(w) - window + 1) if w else 0):
                owners = found.setdefault(tuple(w[at : at + window]), set())
                if item is not None:
                    owners.add(str(item))
        self.tables: list[tuple[np.ndarray, list[tuple[str, ...]]]] = []
        for m in sorted({len(k) for k in found}):
            keys = [k for k in found if len(k) == m]
            self.tables.append((np.array(keys, np.int64), [tuple(found[k]) for k in keys]))
        self.shortest = min((t.shape[1] for t, _ in self.tables), default=0)


def search_shard(phrases: Phrases, docs: list[np.ndarray]) -> list[tuple[list[tuple[int, int]], set[str]]]:
    """Merged word spans and item ids for each document, given as word ids (0: a word of no phrase)."""
    none: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in docs]
    if not phrases.tables or not docs:
        return none
    starts = np.cumsum([0, *(len(d) + 1 for d in docs)])
    text = np.zeros(starts[-1] + 1, np.int64)
    for at, d in zip(starts, docs, strict=False):
        text[at : at + len(d)] = d
    edge = np.flatnonzero(np.diff(np.concatenate(([0], (text != 0).astype(np.int8), [0]))))
    begin, end = edge[::2], edge[1::2]
    long = end - begin >= phrases.shortest
    begin, end = begin[long], end[long]
    if not len(begin):
        return none
    keep = np.zeros(len(text) + 1, np.int64)
    keep[begin] += 1
    keep[end + 1] -= 1  # each run keeps the break after it
    place = np.concatenate(([len(text) - 1], np.flatnonzero(np.cumsum(keep[:-1]) > 0)))
    index = FMIndex(text[place], len(phrases.vocabulary) + 1)
    marks, owners = np.zeros(len(text) + 1, np.int64), [set() for _ in docs]
    for table, items in phrases.tables:
        low, high = index.search(table)
        times = high - low
        which = np.repeat(np.arange(len(table)), times)
        rows = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)
        at = place[index.locate(rows)]
        np.add.at(marks, at, 1)
        np.add.at(marks, at + table.shape[1], -1)
        doc = np.searchsorted(starts, at, side="right") - 1
        for pair in np.unique(doc * len(table) + which).tolist():
            owners[pair // len(table)].update(items[pair % len(table)])
    hit = np.concatenate(([0], (np.cumsum(marks) > 0).astype(np.int8)))
    edge = np.flatnonzero(np.diff(hit))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        k = int(np.searchsorted(starts, a, side="right")) - 1
        none[k][0].append((a - int(starts[k]), b - int(starts[k])))
    return [(spans, ids) for (spans, _), ids in zip(none, owners, strict=True)]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(benchmark: DataFrame, window: int) -> Iterator[tuple[Phrases, bool]]:
    """(block, whether it is the last): one at a time, so that the driver holds one block's tables only."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + size // BLOCK_BYTES
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        yield Phrases([tuple(r) for r in items.where(block == k).toLocalIterator()], window), k == n - 1


Found = tuple[list[tuple[int, int]], set[str]]
Finish = Callable[[pa.RecordBatch, list[int], list[Found]], Iterator[pa.RecordBatch]]
_STATE = ArrayType(StructType([StructField("a", IntegerType()), StructField("b", IntegerType())]))


def _searched(docs: DataFrame, benchmark: DataFrame, window: int, finish: Finish, schema: StructType) -> DataFrame:
    """docs (text last) passed through each block's search; finish turns batches and what was found into output."""
    spans_col, items_col = unique_name(docs, "spans"), unique_name(docs, "items")
    between = StructType([*docs.schema.fields, StructField(spans_col, _STATE), StructField(items_col, ArrayType(StringType()))])
    width = len(docs.columns)
    first = True
    for phrases, last in _blocks(benchmark, window):
        sent = docs.sparkSession.sparkContext.broadcast(phrases)
        docs = docs.mapInArrow(_pass(sent, width, first, finish if last else None, between.names), schema if last else between)
        first = False
    return docs


def _pass(sent, width: int, first: bool, finish: Finish | None, names: list[str]):
    def flush(held: list[pa.RecordBatch], ids: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found, at = search_shard(sent.value, ids), 0
        for batch in held:
            part, counts = found[at : at + batch.num_rows], [len(x) for x in ids[at : at + batch.num_rows]]
            at += batch.num_rows
            if not first:
                before = zip(batch.column(width).to_pylist(), batch.column(width + 1).to_pylist(), strict=True)
                part = [(_merged([*s, *((x["a"], x["b"]) for x in a)]), i | set(b)) for (s, i), (a, b) in zip(part, before, strict=True)]
            own = pa.RecordBatch.from_arrays(batch.columns[:width], names[:width])
            if finish:
                yield from finish(own, counts, part)
            else:
                spans = pa.array([[{"a": a, "b": b} for a, b in s] for s, _ in part], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))
                yield pa.RecordBatch.from_arrays([*own.columns, spans, pa.array([sorted(i) for _, i in part], pa.list_(pa.string()))], names)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, held, ids, n = sent.value.vocabulary.get, [], [], 0
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                held.append(batch)
                for text in batch.column(width - 1).to_pylist():
                    w = words(text.encode() if text else None)
                    ids.append(np.fromiter(map(get, w, repeat(0)), np.int32, len(w)))
                    n += len(w)
                if n >= SHARD_WORDS:
                    yield from flush(held, ids)
                    held, ids, n = [], [], 0
        if held:
            yield from flush(held, ids)

    return rows


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans, items.

    ``spans`` are merged half-open ranges of word numbers, ``items`` the ids of the benchmark items with an occurring
    window, sorted as strings. Null and empty texts have no words and no hits; an empty benchmark hits nothing. A
    benchmark item without id counts towards n_hit but can't be listed; items that share an id count once.
    """

    def finish(batch: pa.RecordBatch, counts: list[int], found: list[Found]) -> Iterator[pa.RecordBatch]:
        lists = [sorted(i) for _, i in found]
        hits = [sum(b - a for a, b in s) for s, _ in found]
        digests = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in lists]
        spans = pa.array([[{"a": a, "b": b} for a, b in s] for s, _ in found], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))
        columns = [batch.column(0), *(pa.array(x, pa.int64()) for x in (counts, hits, [len(x) for x in lists]))]
        columns += [pa.array(digests, pa.string()), pa.array([x > 0 for x in hits], pa.bool_()), spans, pa.array(lists, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, out.names)

    out = StructType.fromDDL("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")
    out = StructType([*out.fields, StructField("spans", _STATE), StructField("items", ArrayType(StringType()))])
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _searched(chosen, benchmark, window, finish, out)


def remove(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """docs, less the text of each merged span; a document of which no word is left goes.

    All columns come back under their names. Documents without hits, null and empty texts included, stay as they are.
    """
    order = [c for c in docs.columns if c != "text"] + ["text"]

    def cleaned(text: str, spans: list[tuple[int, int]]) -> str:
        place, out, at = [m.span() for m in _WORD.finditer(text)], [], 0
        for a, b in spans:
            out.append(text[at : place[a][0]])
            at = place[b - 1][1]
        return "".join(out) + text[at:]

    def finish(batch: pa.RecordBatch, counts: list[int], found: list[Found]) -> Iterator[pa.RecordBatch]:
        hit = [k for k, (s, _) in enumerate(found) if s]
        if not hit:
            yield batch
            return
        texts = batch.column(batch.num_columns - 1).to_pylist()
        gone = np.zeros(batch.num_rows, bool)
        for k in hit:
            gone[k] = sum(b - a for a, b in found[k][0]) == counts[k]
            texts[k] = cleaned(texts[k], found[k][0])
        whole = pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, batch.column(batch.num_columns - 1).type)], order)
        yield whole.filter(pa.array(~gone))

    shaped = docs.select(*(F.col(f"`{c}`") for c in order))
    return _searched(shaped, benchmark, window, finish, shaped.schema).select(*(F.col(f"`{c}`") for c in docs.columns))

"""SimHash near-duplicates: pigeonhole blocks find close fingerprints, Hamming distance decides.

Fingerprints are made beside the text, so only (doc_id, fingerprint) is shuffled. Equal fingerprints become one node
before anything is joined, so thousands of copies cost one row. Blocks that hold more than ``hot`` different
fingerprints are not joined pair by pair: their members meet at shared one-bit neighbours, of which none has more than
65 members, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from utterloom.llm.common import arrow_pass, binaries, cut, unique_name
from utterloom.llm.components import connected_components

SEED = 42
BITS = 64
#: Bits in which linked fingerprints may differ; one-bit neighbours are exact for this value only.
DISTANCE = 2


def majority(hashes: bytes) -> int:
    """Unsigned 64-bit number of the bits that are set in over half of the hashes of 8 bytes."""
    n = len(hashes) // 8
    each = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 8192):
        ones += np.unpackbits(each[at : at + 8192], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of the word shingles, repeats included; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(whole, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    digest = xxhash.xxh64_digest
    return majority(b"".join([digest(whole[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]))


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): one row per row of docs; fp is the fingerprint as a signed long."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x, shingle) for x in binaries(batch.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return arrow_pass(chosen, rows, "doc_id long, fp long")


def _blocks(fp: Column, distance: int) -> Column:
    """Keys of which close fingerprints share at least one: every pair of distance + 2 blocks of the 64 bits.

    As many differing bits as ``distance`` touch that many blocks at most, so two blocks agree.
    """
    n = distance + 2
    edges = [round(i * BITS / n) for i in range(n + 1)]
    part = [
        F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:], strict=False)
    ]
    keys = [
        F.shiftleft(part[i], BITS // n + 1).bitwiseOR(part[j]).bitwiseOR(F.lit(t << 60).cast("long"))
        for t, (i, j) in enumerate(combinations(range(n), 2))
    ]
    return F.array(*keys)


def close_pairs(distinct: DataFrame, hot: int = 400) -> DataFrame:
    """Links (u, v) among different fingerprints ``fp``; their components are those of all pairs within 2 bits.

    Cold blocks are joined and verified. Members of hot blocks are linked through shared one-bit neighbours: two
    fingerprints have one in common exactly if they differ in at most 2 bits.
    """
    keyed = distinct.select("fp", F.explode(_blocks(F.col("fp"), DISTANCE)).alias("k"))
    sizes = keyed.groupBy("k").agg(F.count("*").alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v")).where("n > 1")
    sizes = cut(sizes)
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= DISTANCE
    pairs = sizes.where("n = 2").where(near).select("u", "v")
    marked = cut(keyed.join(sizes.where("n > 2").select("k", "n"), "k"))
    cold = marked.where(F.col("n") <= hot)
    more = cold.select("k", F.col("fp").alias("u")).join(cold.select("k", F.col("fp").alias("v")), "k")
    more = more.where((F.col("u") < F.col("v")) & near).select("u", "v")
    flips = F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(BITS)))
    stars = (
        marked.where(F.col("n") > hot)
        .select("fp")
        .distinct()
        .select("fp", F.explode(flips).alias("near"))
        .groupBy("near")
        .agg(F.collect_set("fp").alias("members"))  # at most 65
        .where(F.size("members") > 1)
        .select(F.array_min("members").alias("u"), F.explode("members").alias("v"))
        .where("u <> v")
    )
    return pairs.unionByName(more).unionByName(stars)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def labelled(fps: DataFrame) -> DataFrame:
    """(fp, component_id) for every different fingerprint of ``fps`` (doc_id, fp)."""
    groups = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first")))
    parts = connected_components(close_pairs(groups.select("fp")))
    linked = cut(groups.join(parts, groups.fp == parts.node, "left").select("fp", "first", "component"))
    least = linked.where("component is not null").groupBy("component").agg(F.min("first").alias("least"))
    return linked.join(least, "component", "left").select("fp", F.coalesce("least", "first").alias("component_id"))


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable).

    Null text counts as empty: fingerprint zero, linked like any other. A row without doc_id belongs to its component
    but never names it; component_id is null only where no member has an id. Repeated rows come back repeated.
    """
    fps = cut(fingerprints(docs, shingle))
    return fps.join(labelled(fps), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """docs with one document of each component: the smallest doc_id, of rows that share it the least text hash.

    All columns of docs come back, whatever their names. A component without any id keeps its least text hash. Of rows
    that repeat both id and text one stays.
    """
    key, digest = unique_name(docs, "near_key"), unique_name(docs, "near_digest")
    mark = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    with_text = docs.select("doc_id", "text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = binaries(batch.column(1))
            fps = np.array([fingerprint(x, shingle) for x in texts], np.uint64).view(np.int64)
            marks = np.array([xxhash.xxh64_intdigest(x or b"", SEED) for x in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps), pa.array(marks)], ["doc_id", "fp", "h"])

    chosen = with_text.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    fps = cut(arrow_pass(chosen, rows, "doc_id long, fp long, h long"))
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "h")
    firsts = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first"), F.min(rank).alias("best")))
    parts = connected_components(close_pairs(firsts.select("fp")))
    parts = firsts.join(parts, firsts.fp == parts.node, "left")
    parts = cut(parts.select("fp", F.coalesce("component", "fp").alias("g"), "best"))
    best = parts.groupBy("g").agg(F.min("best").alias("b"))
    best = parts.select("fp", "g").join(best, "g").select("fp", "b.doc_id", "b.h")
    best = best.select("fp", F.col("doc_id").alias("best_id"), F.col("h").alias("best_h"))
    won = F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("h") == F.col("best_h"))
    losers = fps.join(best, "fp").where(~won).select(F.col("doc_id").alias(key), F.col("h").alias(f"{digest}_")).distinct()
    out = docs.withColumn(digest, mark)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(key)) & (F.col(digest) == F.col(f"{digest}_"))
    out = out.join(losers, same, "left_anti")
    if fps.groupBy("doc_id", "h").count().where("count > 1").isEmpty():
        return out.drop(digest)
    return out.dropDuplicates(["doc_id", digest]).drop(digest)

"""Token output: best-fit-decreasing packing into rows of fixed width, as binary id matrices.

Each partition is packed in shards of a bounded number of ids. Documents longer than a row are cut into full rows and
a rest, so no id is lost. Pieces are placed longest first, each into the open row with the least room that holds it; a
segment tree over room sizes finds that row in logarithmic time. Nothing is shuffled; a lost task packs its shards anew.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from utterloom.llm.common import arrow_pass
from utterloom.llm.tokens import token_ids

SHARD_IDS = 1 << 21
#: Low bits of a sequence_id that count the rows of one partition; the bits above are the partition.
PARTITION_SHIFT = 40


class RoomTree:
    """Open rows by the room that they have left; finds the least room of at least a given size."""

    def __init__(self, most: int):
        self.size = 1 << max(1, most).bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += by
            at >>= 1

    def put(self, row: int, room: int) -> None:
        self.rows[room].append(row)
        if len(self.rows[room]) == 1:
            self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(row, room) of the best fit, taken out of the tree; None if no open row holds it."""
        at = need + self.size
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.size
        row = self.rows[room].pop()
        if not self.rows[room]:
            self._add(room, -1)
        return row, room


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows as lists of piece numbers; every piece is at most capacity long. Ties keep the order given."""
    tree, rows = RoomTree(capacity), []
    for piece in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        found = tree.take(lengths[piece]) if lengths[piece] < capacity else None
        if found is None:
            found = len(rows), capacity
            rows.append([])
        row, room = found
        rows[row].append(piece)
        if room > lengths[piece]:
            tree.put(row, room - lengths[piece])
    return rows


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 50256, pad_id: int = 50256, with_ids: bool = True) -> DataFrame:
    """One row per packed row: sequence_id, n_tokens, doc_ids, starts, cu_seqlens, resets, ids_crc32 (and ids).

    ``doc_ids`` and ``starts`` name the document of each piece and the ids before it; ``cu_seqlens`` are its cumulated
    lengths from 0; ``resets`` the places where positions start again at 0; ``ids`` the row of ``capacity``
    little-endian unsigned 32-bit ids, padded with ``pad_id``; ``ids_crc32`` is that of the unpadded part. Each document
    ends with ``end_id``; null or empty text is that id alone. Repeated rows are packed each for itself; a null doc_id
    stays null in the list; an empty table gives no rows.
    """
    names = ["sequence_id", "n_tokens", "doc_ids", "starts", "cu_seqlens", "resets", "ids_crc32", "ids"]
    end, pad = end_id.to_bytes(4, "little"), pad_id.to_bytes(4, "little")

    def shard(held: list[tuple[int | None, bytes]], first: int) -> pa.RecordBatch:
        pieces = []
        for doc, whole in held:
            pieces += [(doc, at // 4, whole[at : at + 4 * capacity]) for at in range(0, len(whole), 4 * capacity)]
        packed = best_fit_decreasing([len(p) // 4 for _, _, p in pieces], capacity)
        joined = [b"".join([pieces[k][2] for k in row]) for row in packed]
        ends = [np.cumsum([0, *(len(pieces[k][2]) // 4 for k in row)]).tolist() for row in packed]
        columns = [
            pa.array(range(first, first + len(packed)), pa.int64()),
            pa.array([e[-1] for e in ends], pa.int64()),
            pa.array([[pieces[k][0] for k in row] for row in packed], pa.list_(pa.int64())),
            pa.array([[pieces[k][1] for k in row] for row in packed], pa.list_(pa.int64())),
            pa.array(ends, pa.list_(pa.int32())),
            pa.array([e[:-1] for e in ends], pa.list_(pa.int32())),
            pa.array(map(zlib.crc32, joined), pa.int64()),
        ]
        if with_ids:
            columns.append(pa.array([x + pad * (capacity - len(x) // 4) for x in joined], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, sequence = token_ids(tokenizer_path), TaskContext.get().partitionId() << PARTITION_SHIFT
        held: list[tuple[int | None, bytes]] = []
        n = 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.append((doc, encode(text or "") + end))
                n += len(held[-1][1]) // 4
                if n >= SHARD_IDS:
                    yield (out := shard(held, sequence))
                    sequence, held, n = sequence + out.num_rows, [], 0
        if held:
            yield shard(held, sequence)

    schema = "sequence_id long, n_tokens long, doc_ids array<long>, starts array<long>, cu_seqlens array<int>, resets array<int>, ids_crc32 long"
    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return arrow_pass(chosen, rows, schema + ", ids binary" * with_ids)


def write_matrices(packed: DataFrame, path: str) -> None:
    """Parquet files whose ``ids`` column holds the rows of the id matrix, with cu_seqlens and resets beside them."""
    packed.select("sequence_id", "n_tokens", "ids", "cu_seqlens", "resets").write.mode("overwrite").parquet(path)


def matrix(rows: list, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, position ids) of collected rows, as a training step reads them."""
    ids = np.frombuffer(b"".join(bytes(r.ids) for r in rows), "<u4").reshape(len(rows), capacity)
    position = np.tile(np.arange(capacity), (len(rows), 1))
    for k, r in enumerate(rows):
        for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            position[k, a:b] = np.arange(b - a)
    return ids, position

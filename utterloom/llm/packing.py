"""Packing by power-of-two decomposition: no sequence crosses documents and none is padded.

A document of n ids is cut into as many pieces of the largest length as fit, then into one piece for each one-bit of
the rest, longest first. Every piece is a sequence of its own; sequences of equal length form a bucket, so a batch is
drawn from one bucket and needs no padding. The work is one pass over each partition, without any shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from utterloom.llm.common import arrow_pass
from utterloom.llm.tokens import END_OF_DOCUMENT, token_ids

#: Low bits of a sequence_id that count the sequences of one partition; the bits above are the partition.
PARTITION_SHIFT = 40


def piece_lengths(n: int, longest: int = 1024) -> list[int]:
    """Lengths of the pieces of a document of n ids; longest is a power of two.

    >>> piece_lengths(2053)
    [1024, 1024, 4, 1]
    """
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer_path: str, longest: int = 1024, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket (and ids).

    ``start`` counts the document's ids before the piece; ``doc_tokens`` includes the id 0 that ends each document;
    ``offset`` is 0, since a piece fills its sequence; ``bucket`` is the logarithm of its length; ``ids`` holds
    little-endian unsigned 32-bit ids. Null or empty text gives one piece, of the end id alone. Rows without doc_id and
    repeated rows are packed like others, each for itself. An empty table gives no rows.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket", "ids"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, sequence = token_ids(tokenizer_path), TaskContext.get().partitionId() << PARTITION_SHIFT
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                which, start, length, crc, total, ids = [], [], [], [], [], []
                for k, text in enumerate(part.column(1).to_pylist()):
                    whole = encode(text or "") + END_OF_DOCUMENT
                    n, done = len(whole) // 4, 0
                    for size in piece_lengths(n, longest):
                        piece = whole[4 * done : 4 * (done + size)]
                        which.append(k)
                        start.append(done)
                        length.append(size)
                        crc.append(zlib.crc32(piece))
                        total.append(n)
                        if with_ids:
                            ids.append(piece)
                        done += size
                m = len(which)
                columns = [
                    part.column(0).take(pa.array(which, pa.int64())),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc, total)),
                    pa.array(np.arange(sequence, sequence + m)),
                    pa.array(np.zeros(m, np.int64)),
                    pa.array(np.log2(np.array(length, np.float64)).astype(np.int32)),
                ]
                sequence += m
                columns += [pa.array(ids, pa.binary())] if with_ids else []
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, bucket int"
    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return arrow_pass(chosen, rows, schema + ", ids binary" * with_ids)


def write_buckets(packed: DataFrame, path: str) -> None:
    """The packed pieces as Parquet, one folder for each length: a reader of one bucket gets equal lengths only."""
    packed.write.mode("overwrite").partitionBy("bucket").parquet(path)

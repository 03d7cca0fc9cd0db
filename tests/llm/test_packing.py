import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from utterloom.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_piece_lengths():
    for n in range(1, 5000):
        pieces = packing.piece_lengths(n, 1024)
        assert sum(pieces) == n
        assert all(x & (x - 1) == 0 and x <= 1024 for x in pieces)
        assert sum(x < 1024 for x in pieces) <= 10
    with pytest.raises(ValueError):
        packing.pack(None, PATH, longest=1000)


def test_round_trip(spark):
    texts = [(1, "one two"), (2, None), (3, ""), (None, "x " * 3000), (1, "one two"), (4, "  spaces \n\n here  ")]
    d = spark.createDataFrame([(i, t, "clash", 7) for i, t in texts], "doc_id long, text string, ids string, start int")
    rows = packing.pack(d, PATH, longest=64).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    tok = Tokenizer.from_file(PATH)
    want = sorted(b"".join(i.to_bytes(4, "little") for i in [*tok.encode(t or "", add_special_tokens=False).ids, 0]) for _, t in texts)
    docs, whole = [], b""
    for r in sorted(rows, key=lambda r: r.sequence_id):
        assert r.length == len(r.ids) // 4 == 1 << r.bucket and r.offset == 0 and r.ids_crc32 == zlib.crc32(r.ids)
        assert r.start == len(whole) // 4
        whole += r.ids
        if len(whole) // 4 == r.doc_tokens:
            docs.append(whole)
            whole = b""
    assert sorted(docs) == want
    assert packing.pack(d.limit(0), PATH).count() == 0


def test_buckets_on_disk(spark, tmp_path):
    d = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    packing.write_buckets(packing.pack(d, PATH), str(tmp_path / "packed"))
    back = spark.read.parquet(str(tmp_path / "packed"))
    assert {(r.bucket, r.length) for r in back.collect()} == {(3, 8)}

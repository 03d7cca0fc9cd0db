import doctest

import numpy as np

from utterloom.functions import setup
from utterloom.operators import process, segment
from utterloom.operators.process import Processing, quietest
from utterloom.sources import config

WORDS = "file_id long, pos int, word string, start_ms long, end_ms long"


def recording(words, rate=8000, until=7000):
    audio = np.zeros(until * rate // 1000)
    for _, _, _, a, b in words:
        t = np.arange((b - a) * rate // 1000)
        audio[a * rate // 1000 : a * rate // 1000 + len(t)] = 0.4 * np.sin(2 * np.pi * 200 * t / rate) * np.linspace(1, 0, len(t))
    return audio


def test_chain(spark):
    words = [(1, 0, "One", 500, 900), (1, 1, "two.", 1000, 3000), (1, 2, "Three", 3060, 3500), (1, 3, "four.", 3600, 5600), (2, 0, "No", 0, 500), (2, 1, "audio.", 600, 2900)]
    w = spark.createDataFrame(words, WORDS)
    audio = spark.createDataFrame([(1, 8000, recording(words[:4]).tolist())], "file_id long, rate int, samples array<double>")
    segments = segment.cut(w, "punctuation-only")
    got = {(r.file_id, r.seg_id): r for r in process.process(segments, w, audio).collect()}
    assert {k: r.reason for k, r in got.items()} == {(1, 0): None, (1, 1): None, (2, 0): "no audio"}
    one = got[1, 0]
    assert one.cut_start_ms == 350 and 2900 <= one.cut_end_ms <= 3060
    assert len(one.samples) == one.cut_end_ms * 8 - one.cut_start_ms * 8 and max(map(abs, one.samples)) <= 0.99
    assert sorted(r.audio_file for r in process.qualifying(process.process(segments, w, audio)).collect()) == ["1_segment_0.wav", "1_segment_1.wav"]
    near = process.process(segments, w, audio, Processing(min_gap_ms=1000))
    assert {r.reason: r.n for r in process.discards(near).collect()} == {"small gap": 2, "no audio": 1}


def test_quietest_place():
    a = np.full(1000, 0.5)
    a[640:644] = 0.0
    assert quietest(a, 1000, 600, 700, 100, True) in (640, 642)
    assert quietest(a, 1000, 700, 700, 100, True) == 700
    assert quietest(a, 1000, 10, 11, 100, True) == 10


def test_examples():
    assert doctest.testmod(setup).failed == 0 and doctest.testmod(config).failed == 0
    assert setup.first_found([None, "a", "b"], lambda p: p == "b") == "b"

import re

import pytest

from utterloom import catalog
from utterloom.operators import process

WORDS = "file_id long, pos int, word string, start_ms long, end_ms long"


@pytest.mark.parametrize("name", ["j5_adjacent", "d4_cut_points", "k9_cut_point_log"])
def test_only_whole_turns_are_shuffled_and_no_samples_sorted(spark, name):
    """Words take several times the text of their turns, samples hundreds of times."""
    plan = catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    dealt = [x for x in lines if re.search(r"\bExchange\b", x)]
    assert dealt and all("hashpartitioning(conv_id" in x for x in dealt)
    made = next((k for k, x in enumerate(lines) if "sequence(0" in x and "7919" in x), None)
    assert (made is None) == (name == "j5_adjacent")
    if made is not None:
        above = lines[:made]
        assert "FlatMapCoGroups" in "".join(above) and not re.match(r"[\s:+\-*()\d]*Sort ", above[-1])


def test_words_of_segments(spark):
    """Places that start late, have gaps, or are asked for outside the words; times that are missing."""
    words = [(1, p, f"w{p}.", None if p == 6 else 100 * p, 100 * p + 60) for p in (5, 6, 7, 8)]
    words += [(2, p, f"w{p}", 100 * p, None if p == 9 else 100 * p + 60) for p in (0, 3, 9)] + [(3, 0, "x", 0, 50)]
    segments = [(1, 0, 3, 6, "a"), (1, 1, 6, 8, "b"), (1, 2, 9, 12, "none"), (2, 0, 1, 9, "c"), (2, 1, 9, 0, "back"), (2, 2, None, 1, "null"), (4, 0, 0, 1, "no file")]
    got = process.timed_segments(spark.createDataFrame(segments, "file_id long, seg_id int, w_from int, w_to int, text string"), spark.createDataFrame(words, WORDS))
    found = {(r.file_id, r.text): (r.start_ms, r.end_ms) for r in got.select("file_id", "seg_id", "text", "start_ms", "end_ms").collect()}
    # the end is 50 ms earlier, 100 behind a mark, not before the last start that is known
    assert found == {(1, "a"): (500, 560), (1, "b"): (700, 800), (2, "c"): (300, 900), (2, "back"): (0, 900)}

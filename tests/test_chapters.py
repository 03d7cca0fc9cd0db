import pyarrow as pa

from utterloom.operators import documents

PAGES = [f"<h2 class='chapter'>{k}</h2><p>{'word ' * 40}{k}</p><h2 class='chapter'>b</h2><p>more {k}</p>" for k in range(30)] + [None, "", "<p>plain</p>"]


def test_chapters_are_handed_on_in_portions(monkeypatch):
    """What waits is bounded by characters, not by the rows of a batch."""
    monkeypatch.setattr(documents, "CHARS", 500)
    parts = list(documents._portions(pa.array(PAGES, pa.string())))
    assert len(parts) > 5 and all(sum(len(t) for _, _, t in x) < 1000 for x in parts)
    assert [r for x in parts for r in x] == [(k, n, t) for k, x in enumerate(PAGES) for n, t in enumerate(documents.chapters(x))]


def test_rows(spark):
    pages = spark.createDataFrame([(None if k == 3 else k, x) for k, x in enumerate(PAGES)], "page_id long, html string")
    got = sorted(((r.page_id, r.ord, r.text) for r in documents.chapter_rows(pages, "page_id", "html").collect()), key=str)
    assert got == sorted(((None if k == 3 else k, n, t) for k, x in enumerate(PAGES) for n, t in enumerate(documents.chapters(x))), key=str)
    assert documents.chapter_rows(pages.limit(0), "page_id", "html").count() == 0

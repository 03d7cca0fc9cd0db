import html
import math
import random
import re

from utterloom.llm.html_extract import REACH, edits, extract, main_text, parsed, strengths

LONG = "A paragraph of the article, with commas, points, and enough words to be told from a menu. It goes on."


def test_article_without_its_surroundings():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";a(1<2)</script></head>
    <body class="has-sidebar"><header>Site</header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- <p>no</p> -->
    <div class="ad">Buy</div><div id="cookie-notice"><p>We use cookies, yes.</p></div>
    <article><h1>Title &amp; more</h1><p><b>Lead&nbsp;text.<br><p>{LONG}<p>Second&#46;<ul><li>one<li>two</ul>
    <form><label>mail</label><input></form><blockquote>said</blockquote></article>
    <section class="comments"><p>{LONG} First!</p></section><aside>Side</aside><footer>&copy; x</footer>"""
    assert main_text(page).split("\n\n") == ["Title & more", "Lead text.", LONG, "Second.", "one", "two", "said"]


def test_pages_without_article_element():
    page = f"<body><div class='menu'><a>x</a></div><div><p>{LONG}</p><p>{LONG}</p></div><div>tiny</div></body>"
    assert main_text(page) == f"{LONG}\n\n{LONG}"
    assert main_text(f"<p>{LONG}") == LONG
    assert main_text(LONG) == LONG


def test_broken_markup_ends():
    for page in ("", None, "<", "<p", "<!--", "<script>", "<a href='>x", "<p>" * 3000, "<div>" * 3000 + LONG, "</p></div>"):
        assert isinstance(main_text(page), str)


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = extract(pages).collect()
    assert len(rows) == pages.count()
    source = {r.page_id: r.html for r in pages.collect()}
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", source[r.page_id], re.S)[1]
        want = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(x for x in want if x) and r.n_chars == len(r.text)


def test_nulls_and_empty_table(spark):
    d = spark.createDataFrame([(1, None, None, 3), (None, "u", "", 4)], "page_id long, url string, html string, text int")
    assert sorted(map(str, (tuple(r) for r in extract(d).collect()))) == ["(1, None, '', 0)", "(None, 'u', '', 0)"]
    assert extract(d.limit(0)).count() == 0


def test_names_decide_as_a_whole():
    page = f"""<body><div class="site-header"><p>{LONG}</p></div><article><div class="article-header"><h1>Title</h1></div>
    <div class="header"><h2>Part</h2><span>by me</span></div><div class="share-price"><p>The price, of 3, fell.</p></div><p>{LONG}</p>
    <div class="comment-list"><p>{LONG}</p></div><p class="ad-slot">Buy</p></article><div id="related-posts"><p>{LONG}</p></div>"""
    assert main_text(page).split("\n\n") == ["Title", "Part", "The price, of 3, fell.", LONG]


def test_paths_select_in_several_containers():
    two = f"<body><div class=menu><a href=x>x</a></div><div class=intro><p>{LONG}</p></div><div class=text><p>{LONG}</p><ul><li>one</ul></div><p><a>{LONG}</a>"
    assert main_text(two).split("\n\n") == [LONG, LONG]
    inner = f"<body><div id=x><div class=intro><p>{LONG}</p></div><div class=text><p>{LONG}</p><ul><li>one</ul></div></div><div>tiny</div>"
    assert main_text(inner).split("\n\n") == [LONG, LONG, "one"]
    both = f"<body><article><p>{LONG}</article><div>between</div><article><p>{LONG}<p>x</article>"
    assert main_text(both).split("\n\n") == [LONG, LONG, "x"]


def _full(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_scores_are_those_of_a_plain_model():
    rng = random.Random(5)
    for _ in range(60):
        a, b = (tuple(rng.choice("xyz") for _ in range(rng.randint(0, 9))) for _ in range(2))
        assert edits(a, b) == min(REACH + 1, _full(a, b))
    for _ in range(25):
        parts = []
        for _ in range(rng.randint(1, 30)):
            tags = [rng.choice(["div", "section", "div class=a", "div class='b c d e f'"]) for _ in range(rng.randint(0, 6))]
            said = rng.choice([LONG, "Short, one.", "word " * rng.randint(1, 30), f"<a href=x>{LONG}</a> rest"])
            parts.append("".join(f"<{t}>" for t in tags) + f"<p>{said}</p>" + "".join(f"</{t.split()[0]}>" for t in reversed(tags)))
        page = parsed("<body>" + "".join(parts))
        sums = {}
        for b in page.blocks:
            t, p, n = sums.get(page.path(b.path), (0, 0, 0))
            marks = sum(c in ".,;:!?\"'()–—…、。！，？" for c in b.text)
            sums[page.path(b.path)] = t + max(0, len(b.text) - 2 * b.linked), p + marks, n + 1
        for path, (got, total) in strengths(page).items():
            near = [(math.exp(-(_full(page.path(path), q) ** 2) / 2), s) for q, s in sums.items() if _full(page.path(path), q) <= REACH]
            text, points = (sum(w * s[k] / s[2] for w, s in near) / sum(w for w, _ in near) for k in (0, 1))
            t, p, n = sums[page.path(path)]
            assert math.isclose(got, math.sqrt(t / n * (1 + p / n) * text * (1 + points)), abs_tol=1e-9) and total == t


def test_long_and_deep_pages_and_repeated_rows(spark):
    many = "<article>" + "".join(f"<p class=c{k}>{LONG}</p>" for k in range(300)) + "".join(f"<p>{k} {LONG}</p>" for k in range(5000)) + "</article>"
    deep = "<div>" * 5000 + f"<p>{LONG}</p>" * 20
    assert main_text(many).count(LONG) == 5300 and main_text(deep).count(LONG) == 20
    d = spark.createDataFrame([(1, "u", f"<p>{LONG}")] * 3, "page_id long, url string, html string")
    assert [tuple(r) for r in extract(d).collect()] == [(1, "u", LONG, len(LONG))] * 3

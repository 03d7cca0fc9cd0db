"""Main text of web pages by tag-path ratios.

A page is read once into blocks: runs of text inside one block element, with the path of tags (and class names) from
the root. Blocks inside menus, headers, footers, sidebars, notices, adverts, forms and comments are known by their tag,
role or class and left out. For each path the text length outside links and the punctuation of its blocks are summed
and divided by their number; the ratios are smoothed over paths that differ in three tags at most, multiplied, and fused
with the path's own by the geometric mean. Paths that reach a share of the strongest are content: their blocks are selected, less those that are mostly links,
and with them what stands beside them, in the article or main element around them or, on pages without one, in the
element that holds all of them if that is less than the page.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from utterloom.llm.common import arrow_pass

# Elements of HTML by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p "
    "plaintext pre search section summary table tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCK - frozenset("caption body html legend optgroup option tbody td tfoot th thead tr".split())
SAME_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
SCOPES = frozenset("table ul ol dl select article section div body html td th".split())
DROPPED = frozenset(
    "head nav aside footer form button select datalist noscript template svg canvas object audio video dialog menu "
    "search script style textarea title iframe noembed noframes input".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog".split())
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners breadcrumb breadcrumbs byline-social comment "
    "comments commentlist cookie cookies consent disclaimer disqus footer form gdpr header login masthead menu menus modal "
    "nav navbar navigation newsletter notice notices alert popup promo promotion related replies reply respond search share "
    "sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets pagination pager".split()
)
#: What a compound name may hold beside those: a name that says anything else decides nothing.
PLAIN = frozenset(
    "area bar block bottom box button container content cta footer group header inner item items left link links list main "
    "outer page panel post posts right section site slot strip text thread title top unit wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Tags in which paths may differ to lift one another.
REACH = 3

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TOKEN = re.compile(r"[a-z0-9]+")
_POINTS = re.compile(r"[.,;:!?\"'()–—…、。！，？]")


@dataclass
class Block:
    text: str
    path: int  # number of its path in the page's table of paths
    linked: int  # characters inside links
    node: int  # number of its element


@dataclass
class Page:
    """Blocks, and the trees of paths and elements: the parent of each, by number; 0 is the root."""

    blocks: list[Block] = field(default_factory=list)
    labels: list[str] = field(default_factory=lambda: [""])
    above: list[int] = field(default_factory=lambda: [0])
    tags: list[str] = field(default_factory=lambda: [""])
    parents: list[int] = field(default_factory=lambda: [0])
    depths: list[int] = field(default_factory=lambda: [0])

    def path(self, number: int) -> tuple[str, ...]:
        out = []
        while number:
            out.append(self.labels[number])
            number = self.above[number]
        return tuple(reversed(out))


@dataclass
class _Open:
    tag: str
    path: int
    out: bool  # not part of any article
    head: bool  # a header inside an article: only headings count
    node: int = 0
    inside: bool = False  # an article or main element, or in one
    links: bool = False


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)} if raw.strip(" /\n\t") else {}


def _named_out(tag: str, at: dict[str, str]) -> bool:
    if not at or tag in ("html", "body", "main"):
        return False
    if "hidden" in at or at.get("aria-hidden") == "true" or ROLES & set(at.get("role", "").lower().split()):
        return True
    if re.search(r"display\s*:\s*none", at.get("style", "").lower()):
        return True
    return any(map(lambda n: _names(n, tag), _names_of(at)))


def _names_of(at: dict[str, str]) -> list[str]:
    return f"{at.get('class', '')} {at.get('id', '')}".lower().split()


def _names(name: str, tag: str) -> bool:
    """Whether a whole name, or all parts of a compound one, say that this is no article."""
    hints = {"comment", "comments", "reply"} if tag == "article" else HINTS
    parts = set(_TOKEN.findall(name))
    return name in hints or (bool(parts & hints) and parts <= hints | PLAIN)


def _headed(tag: str, at: dict[str, str]) -> bool:
    """Whether an element is a header, by tag or by nothing else in its names."""
    return tag == "header" or any("header" in _TOKEN.findall(n) and _names(n, tag) for n in _names_of(at))


def parsed(page: str) -> Page:
    """Blocks of text that may belong to the article, in page order."""
    out = Page()
    known: dict[tuple[int, str], int] = {}
    stack, held, linked, at, n = [_Open("", 0, False, False)], [], 0, 0, len(page)

    def text(piece: str) -> None:
        nonlocal linked
        if piece and not stack[-1].out:
            held.append(piece)
            linked += len(piece) if stack[-1].links else 0

    def flush() -> None:
        nonlocal linked
        if held:
            whole = " ".join(html.unescape("".join(held)).split())
            inner = next((x for x in reversed(stack) if x.tag in BLOCK), stack[0])
            if whole and not (inner.head and inner.tag not in HEADINGS):
                out.blocks.append(Block(whole, inner.path, min(linked, len(whole)), inner.node))
            held.clear()
        linked = 0

    def close(depth: int) -> None:
        if any(x.tag in BLOCK for x in stack[depth:]):
            flush()
        del stack[depth:]

    while at < n:
        m = _TAG.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    close(depth)
                    break
                if tag not in BLOCK and stack[depth].tag in SCOPES:
                    break
            else:
                if tag in BLOCK:
                    flush()
            continue
        raw = m[3] or m[6] or ""
        if tag in ENDS_P or tag in SAME_ENDS:
            ends = SAME_ENDS.get(tag, frozenset()) | ({"p"} if tag in ENDS_P else set())
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in ends:
                    close(depth)
                    break
                if stack[depth].tag in SCOPES - ends and stack[depth].tag != "td":
                    break
        if tag in VOID:
            if tag in BLOCK:
                flush()
            elif tag == "br":
                text(" ")
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in BLOCK:
            flush()
        attributes, top = _attributes(raw), stack[-1]
        headed = top.inside and _headed(tag, attributes)
        drop = top.out or tag in DROPPED or (not headed and (_named_out(tag, attributes) or tag == "header"))
        label = ".".join([tag, *sorted(set(attributes.get("class", "").lower().split()))])
        path = known.setdefault((top.path, label), len(out.labels))
        if path == len(out.labels):
            out.labels.append(label)
            out.above.append(top.path)
        out.tags.append(tag)
        out.parents.append(top.node)
        out.depths.append(out.depths[top.node] + 1)
        inside = top.inside or tag in ("article", "main")
        stack.append(_Open(tag, path, drop, top.head or headed, len(out.tags) - 1, inside, top.links or tag == "a"))
    flush()
    return out


def edits(a: tuple[str, ...], b: tuple[str, ...], most: int = REACH) -> int:
    """Edit distance of two paths; most + 1 stands for all that are farther."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    first = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    a, b = a[first:], b[first:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if max(len(a), len(b)) <= most:
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]
    # reached[k]: how far into a one comes with d edits where one is k places farther in b
    reached = {0: 0}
    for d in range(most + 1):
        if d:
            old, reached = reached, {}
            for k in range(-d, d + 1):
                reached[k] = max(old.get(k, -9) + 1, old.get(k - 1, -9), old.get(k + 1, -9) + 1)
        for k, i in reached.items():
            while 0 <= i < len(a) and 0 <= i + k < len(b) and a[i] == b[i + k]:
                i += 1
            reached[k] = i
        if reached.get(len(b) - len(a), -9) >= len(a):
            return d
    return most + 1


def strengths(page: Page, sigma: float = 1.0) -> dict[int, tuple[float, float]]:
    """(strength, text) for each path that has a block: the products of its own ratios and of the smoothed ones, fused."""
    sums: dict[int, list[float]] = {}
    for b in page.blocks:
        s = sums.setdefault(b.path, [0.0, 0.0, 0.0])
        s[0] += max(0, len(b.text) - 2 * b.linked)
        s[1] += len(_POINTS.findall(b.text))
        s[2] += 1
    paths = {p: page.path(p) for p in sums}
    by_length: dict[int, list[int]] = {}
    for p, tags in paths.items():
        by_length.setdefault(len(tags), []).append(p)
    out = {}
    for p, tags in paths.items():
        near = [q for d in range(-REACH, REACH + 1) for q in by_length.get(len(tags) + d, ())]
        parts = [(math.exp(-(d**2) / (2 * sigma**2)), sums[q]) for q in near if (d := edits(tags, paths[q])) <= REACH]
        weight = sum(w for w, _ in parts)
        text, points = (sum(w * s[k] / s[2] for w, s in parts) / weight for k in (0, 1))
        own = sums[p][0] / sums[p][2] * (1 + sums[p][1] / sums[p][2])
        out[p] = math.sqrt(own * text * (1 + points)), sums[p][0]
    return out


def content(page: Page, share: float = 0.2, sigma: float = 1.0) -> list[Block]:
    """The blocks whose tag path makes them content, and those beside them in the same container."""
    strong = strengths(page, sigma)
    reach = share * max((x for x, _ in strong.values()), default=0.0)
    chosen = {p for p, (x, _) in strong.items() if x >= reach and x > 0}
    seeds = [b for b in page.blocks if b.path in chosen and b.linked * 2 <= len(b.text)]
    if not seeds:
        return []
    # the strongest path is the one with most text among those that reach the share: one long caption is no article
    best = max({b.path for b in seeds}, key=lambda p: (strong[p][1], p))
    holds = {x: x if page.tags[x] in ("article", "main") else 0 for x in range(len(page.tags))}
    for x in range(1, len(page.tags)):  # parents come before their children
        holds[x] = holds[page.parents[x]] or holds[x]
    articles = {holds[b.node] for b in seeds if b.path == best} - {0}
    if articles:
        articles |= {holds[b.node] for b in seeds} - {0}
        return [b for b in page.blocks if holds[b.node] in articles]
    common = seeds[0].node
    for b in seeds:
        common = _meeting(page, common, b.node)
    if len({b.node for b in seeds}) == 1:
        common = page.parents[common]
    if page.tags[common] in ("", "html", "body"):
        picked = set(map(id, seeds))
        return [b for b in page.blocks if id(b) in picked]
    within = {0: False}
    for x in range(1, len(page.tags)):
        within[x] = x == common or within[page.parents[x]]
    return [b for b in page.blocks if within[b.node]]


def _meeting(page: Page, x: int, y: int) -> int:
    """The innermost element that holds both."""
    while x != y:
        if page.depths[x] >= page.depths[y]:
            x = page.parents[x]
        else:
            y = page.parents[y]
    return x


def main_text(page: str | None) -> str:
    """Blocks of the article joined by blank lines; empty if there is none."""
    return "\n\n".join(b.text for b in content(parsed(page or "")))


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars (code points). Null or empty html gives an empty text.

    Repeated rows and rows with null ids or urls come back as they are; an empty table gives no rows.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = [main_text(x) for x in batch.column(2).to_pylist()]
                columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    chosen = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col(html_col).cast("string"))
    return arrow_pass(chosen, rows, "page_id long, url string, text string, n_chars long")

"""Secret scans: fixed patterns, and character Markov models of random strings against ordinary identifiers.

Both models are first-order (bigram) with add-one smoothing, trained from labelled samples; a candidate is a secret
if its log-likelihood ratio for each character passes a threshold that is set on the same samples. Whole texts are
read, beside their rows: nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from utterloom.llm.common import arrow_pass

KINDS = ("assign", "access", "hex", "markov")
_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # leftmost and greedy: the runs of [0-9a-f]+ that are long enough
#: Candidates of the method: unbroken runs that could be keys. Shorter ones say too little: the samples start at 20.
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"

# Parts of ordinary identifiers, the "ordinary" label of the built-in samples.
PARTS = (
    "get set is has on off to from by with user users name names list map item items index count total value values key "
    "keys file files path paths data base table row rows column columns field fields type types class object string number "
    "integer float double boolean array vector matrix node edge tree graph root leaf parent child first last next previous "
    "start stop begin end open close read write load save send receive request response client server session account "
    "order product price customer address city country phone email message subject body header footer title page pages "
    "image images video audio text font color style width height size length depth level time date year month day hour "
    "minute second stamp zone local global public private static final const default config configuration option options "
    "setting settings property properties manager handler factory builder service provider controller model view template "
    "test tests check validate parse format convert encode decode compress extract filter search find replace insert update "
    "delete remove create make build compute calculate process execute run init initialize shutdown application component "
    "container context environment language version release package module import export internationalization "
    "responsibility characteristic administration communication development information organisation unfortunately"
).split()


def built_in_samples(n: int = 4000, seed: int = 7) -> list[tuple[str, bool]]:
    """Labelled strings: random keys of common alphabets (True), identifiers composed of words (False)."""
    rng, out = random.Random(seed), []
    alphabets = ["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", _ALPHABET[:62], _ALPHABET[:64], _ALPHABET[:62]]
    for _ in range(n):
        out.append(("".join(rng.choices(rng.choice(alphabets), k=rng.randint(20, 64))), True))
        words = rng.choices(PARTS, k=rng.randint(3, 7))
        style = rng.randrange(7)
        name = ("_", "-", "", "", "/", "_", "")[style].join(w.capitalize() if style in (2, 5) else w for w in words)
        name = name.upper() if rng.random() < 0.15 else name
        out.append((name + rng.choice(["", "", "", str(rng.randint(1, 99)), "=" * 3]), False))
    return out


@dataclass
class MarkovPair:
    """Bigram models of both labels and the threshold between them."""

    order: int = 1
    tables: tuple[dict[str, dict[str, int]], dict[str, dict[str, int]]] = field(default_factory=lambda: ({}, {}))
    threshold: float = 0.0

    def _pairs(self, text: str) -> Iterator[tuple[str, str]]:
        padded = "^" * self.order + text
        for i in range(self.order, len(padded)):
            yield padded[i - self.order : i], padded[i]

    def ratio(self, text: str) -> float:
        """Mean over characters of log P(random) - log P(ordinary)."""
        total, size = 0.0, len(_ALPHABET) + 1
        for before, c in self._pairs(text):
            for table, sign in zip(self.tables, (-1, 1), strict=True):
                seen = table.get(before, {})
                total += sign * math.log((seen.get(c, 0) + 1) / (sum(seen.values()) + size))
        return total / max(1, len(text))

    def is_secret(self, text: str) -> bool:
        return self.ratio(text) > self.threshold


def train(samples: Iterable[tuple[str, bool]], false_rate: float = 0.001) -> MarkovPair:
    """Models from labelled strings (True: random); at most ``false_rate`` of the ordinary ones pass the threshold.

    Every fourth sample is held out of the counts and sets the threshold.
    """
    samples, model = list(samples), MarkovPair()
    for k, (text, label) in enumerate(samples):
        if k // 2 % 4:
            for before, c in model._pairs(text):
                row = model.tables[label].setdefault(before, {})
                row[c] = row.get(c, 0) + 1
    held = [(model.ratio(t), label) for k, (t, label) in enumerate(samples) if not k // 2 % 4]
    ordinary = sorted(r for r, label in held if not label)
    if ordinary:
        model.threshold = max(0.0, ordinary[min(len(ordinary) - 1, int(len(ordinary) * (1 - false_rate)))])
    return model


Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) in code points: leftmost matches that don't overlap within a kind, failing ones dropped."""
    out = []
    for m in _ASSIGN.finditer(text):
        if len(m[1]) >= 8:
            out.append((m.start(), m.end(), "assign"))
    out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(out, key=_place)


def _place(span: Span) -> tuple[int, int]:
    return span[0], KINDS.index(span[2])


def markov_spans(text: str, model: MarkovPair, base: list[Span]) -> list[Span]:
    """Candidates that the models call random and that no base span overlaps."""
    out = []
    for m in _CANDIDATE.finditer(text):
        word = m[0]
        if not any(a < m.end() and m.start() < b for a, b, _ in base) and model.is_secret(word):
            out.append((m.start(), m.end(), "markov"))
    return out


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in sorted(spans, key=_place))


def scan(docs: DataFrame, model: MarkovPair | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov.

    ``spans`` lists kind:start:end by start, then kind, comma-joined; starts and ends count code points. Null text
    counts as empty; repeated rows repeat; an empty table gives no rows.
    """
    model = model or train(built_in_samples())
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov"]

    def row(text: str) -> tuple:
        base = base_spans(text)
        more = markov_spans(text, model, base)
        counts = [sum(k == kind for _, _, k in base) for kind in KINDS[:3]]
        return (*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + more), len(more))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                got = list(zip(*(row(x or "") for x in batch.column(1).to_pylist()), strict=True))
                types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
                yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, got, types)], names)

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return arrow_pass(
        chosen, rows, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_markov long"
    )


def redact(docs: DataFrame, model: MarkovPair | None = None, mask: str = "[secret]") -> DataFrame:
    """docs with each found span of text masked (overlapping spans as one); all columns come back, null text stays."""
    model, order = model or train(built_in_samples()), docs.columns
    at_text = order.index("text")

    def masked(text: str | None) -> str | None:
        if not text:
            return text
        base, out, at = base_spans(text), [], 0
        spans = sorted((a, b) for a, b, _ in base + markov_spans(text, model, base))
        for a, b in spans:
            if a >= at:
                out += [text[at:a], mask]
            at = max(at, b)
        return "".join(out) + text[at:]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            columns[at_text] = pa.array(map(masked, columns[at_text].to_pylist()), columns[at_text].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(rows, docs.schema)

"""License scans by sentence rules.

Each line is cut into sentences, each sentence normalised, and each normalised sentence looked up among patterns of
known license sentences. Lines that follow one another are then read as a paragraph, without comment marks, for what
stands across their ends. What a document says is then a sequence of sentence identifiers; ordered rules are tried on
it one after the other, each taking the identifiers that it explains, until none fits. Identifiers that no rule
explains make the verdict "unknown". All of it happens beside the rows: nothing is shuffled or joined.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from utterloom.llm.common import arrow_pass

# Identifiers of license sentences, with patterns over normalised sentences (lower case, one space, no
# points or quotes). Placeholders in names: <v> is filled from the match.
SENTENCES = [
    ("ApacheRef", r"licensed under (?:the )?apache(?: software)? license(?: version)? (?P<v>2\.0|1\.1|1\.0)"),
    ("ApacheUnversioned", r"licensed under (?:the )?apache(?: software)? license"),
    ("NoUseExcept", r"you may not use this file except in compliance with the license"),
    ("ObtainCopy", r"you may obtain a copy of the license at"),
    ("AsIsBasis", r"distributed (?:under the license is distributed )?on an as is basis"),
    ("GplRef", r"gnu (?P<f>lesser |affero |library )?general public license(?: as published by the free software foundation)?(?: either)?(?:,? version (?P<v>[123](?:\.[01])?))?"),
    ("OrLater", r"or (?:at your option )?any later version"),
    ("GplShort", r"\b(?P<f>l|a)?gpl ?v?(?P<v>[123](?:\.[01])?)(?P<p>\+| or later)?"),
    ("MitRef", r"(?:released|licensed|distributed|available) under (?:the )?mit license|\bthe mit license\b|\bmit licensed\b"),
    ("MitGrant", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("MitNotice", r"the above copyright notice and this permission notice shall be included in all copies"),
    ("BsdRef", r"(?:under (?:the )?|\b)(?P<v>[234])[- ]clause bsd license|under (?:the )?(?:new |modified |simplified )?bsd license"),
    ("BsdGrant", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("BsdSource", r"redistributions of source code must retain the above copyright notice"),
    ("BsdBinary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("BsdEndorse", r"neither the name of .{1,120} nor the names of its contributors may be used to endorse"),
    ("IscGrant", r"permission to use copy modify and(?:/or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("CcRef", r"(?:licensed|released|available|distributed|published) under (?:a |the )?(?:cc|creative commons)[- ](?P<f>by(?:[- ](?:nc|sa|nd))*|zero|0|attribution(?:[- ](?:noncommercial|sharealike|noderivatives|noderivs))*)(?: license)?(?: (?P<v>[1-4]\.0))?"),
    ("MplRef", r"mozilla public license(?: version| v)? ?(?P<v>[12]\.[01])?"),
    ("EplRef", r"eclipse public license(?: version| v)? ?(?P<v>[12]\.0)?"),
    ("UnlicenseRef", r"this is free and unencumbered software released into the public domain"),
    ("PublicDomain", r"(?:is|in|into|to) (?:the )?public domain"),
    ("Spdx", r"spdx[- ]license[- ]identifier:? ?(?P<v>[a-z0-9.+-]+)"),
    ("AllRights", r"all rights reserved"),
    ("Proprietary", r"proprietary and confidential|unauthorized copying of this file"),
]
# License rules in the order in which they are tried: name, the identifiers that must follow one another
# in this order (others may stand between), and those that are taken along if present.
RULES = [
    ("SPDX:{v}", ["Spdx"], []),
    ("Apache-{v}", ["ApacheRef"], ["NoUseExcept", "ObtainCopy", "AsIsBasis"]),
    ("Apache", ["ApacheUnversioned"], ["NoUseExcept", "ObtainCopy", "AsIsBasis"]),
    ("{f}GPL-{v}-or-later", ["GplRef", "OrLater"], []),
    ("{f}GPL-{v}-or-later", ["GplShort+"], []),
    ("{f}GPL-{v}-only", ["GplRef"], []),
    ("{f}GPL-{v}-only", ["GplShort"], []),
    ("MIT", ["MitRef"], ["MitGrant", "MitNotice"]),
    ("MIT", ["MitGrant", "MitNotice"], []),
    ("BSD-3-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse"], ["BsdRef"]),
    ("BSD-2-Clause", ["BsdGrant", "BsdSource", "BsdBinary"], ["BsdRef"]),
    ("BSD-{v}-Clause", ["BsdRef"], []),
    ("ISC", ["IscGrant"], []),
    ("CC-{f}-{v}", ["CcRef"], []),
    ("MPL-{v}", ["MplRef"], []),
    ("EPL-{v}", ["EplRef"], []),
    ("Unlicense", ["UnlicenseRef"], ["PublicDomain"]),
    ("Public-Domain", ["PublicDomain"], []),
    ("Proprietary", ["Proprietary"], ["AllRights"]),
    ("All-Rights-Reserved", ["AllRights"], []),
]
_FAMILY = {"lesser ": "L", "library ": "L", "affero ": "A", "l": "L", "a": "A"}
_LONG = {"attribution": "by", "noncommercial": "nc", "sharealike": "sa", "noderivatives": "nd", "noderivs": "nd", "0": "zero"}
_PATTERNS = [(name, re.compile(pattern)) for name, pattern in SENTENCES]
#: Every pattern holds one of these; other lines are passed over.
_HINT = re.compile(r"licen[sc]|gpl|rights reserved|permission|redistribut|public domain|confidential|unauthorized|endorse|contributors may|as is|any later version|spdx|creative commons|under (?:a |the )?cc", re.I)
#: The same over line ends and comment marks.
_WRAPPED_HINT = re.compile(_HINT.pattern.replace(" ", r"[\s*#/;%>|-]+"), re.I)
_LEADER = re.compile(r"\s*(?:(?:/?\*+(?!\S*\*)/?|//+!?|#+|;+|--+|%+|>+|\||<!--|dnl\b|rem\b)\s*)*", re.I)
_TRAILER = re.compile(r"\s*(?:\*+/|-->|\*+|\|)?\s*$")
_STOP = re.compile(r"[.!?][\"')\]]*$")
_END = re.compile(r"(?<=[.!?;])\s+(?=[^\s])")
_DROP = re.compile(r"[\"'`“”‘’()\[\]{}*#]|,|[.;:!?]+(?=\s|$)")


@dataclass(frozen=True)
class Found:
    ident: str
    start: int  # code point of the sentence in the text
    end: int
    values: tuple[tuple[str, str], ...]


def normalised(sentence: str) -> str:
    """Lower case, no quotes, brackets, commas or closing points, every white space run one space."""
    return " ".join(_DROP.sub(" ", sentence.lower().replace("licence", "license")).split())


def sentences(text: str) -> Iterator[tuple[int, int]]:
    """Spans of sentences: lines that hold a hint are cut at points that end a sentence."""
    at = 0
    for line in text.split("\n"):
        if _HINT.search(line):
            begin = at
            for m in _END.finditer(line):
                yield begin, at + m.start()
                begin = at + m.end()
            yield begin, at + len(line)
        at += len(line) + 1


def paragraphs(text: str) -> Iterator[list[tuple[int, int]]]:
    """Spans of the lines of each paragraph of two lines and more, without comment marks."""
    at, lines = 0, []
    for line in [*text.split("\n"), ""]:
        begin = _LEADER.match(line).end()
        end = max(begin, _TRAILER.search(line).start())
        if begin < end:
            lines.append((at + begin, at + end))
        else:
            if len(lines) > 1:
                yield lines
            lines = []
        at += len(line) + 1


def _mapped(text: str, spans: list[tuple[int, int]]) -> Iterator[tuple[str, list[int], list[tuple[int, int]]]]:
    """Sentences of the lines together: normalised, where each word begins in that, and the span of its source."""
    words, starts, places, size = [], [], [], 0
    for a, b in spans:
        for m in re.finditer(r"\S+", text[a:b]):
            for word in normalised(m[0]).split():
                words.append(word)
                starts.append(size)
                places.append((a + m.start(), a + m.end()))
                size += len(word) + 1
            if _STOP.search(m[0]) and words:
                yield " ".join(words), starts, places
                words, starts, places, size = [], [], [], 0
    if words:
        yield " ".join(words), starts, places


def _across(text: str) -> Iterator[tuple[str, int, int, tuple[int, int], dict[str, str]]]:
    """(name, start, end, span of its sentence, values) of what matches across line ends or semicolons."""
    for lines in paragraphs(text):
        if not _WRAPPED_HINT.search(text, lines[0][0], lines[-1][1]):
            continue
        own = None
        for plain, starts, places in _mapped(text, lines):
            for name, pattern in _PATTERNS if _HINT.search(plain) else ():
                for m in pattern.finditer(plain):
                    first, last = bisect_right(starts, m.start()) - 1, bisect_left(starts, m.end()) - 1
                    a, b = places[first][0], places[last][1]
                    own = own or list(sentences(text[lines[0][0] : lines[-1][1]]))
                    k = bisect_right(own, (a - lines[0][0], len(text))) - 1  # the last sentence of a line that begins by then
                    if k < 0 or b - lines[0][0] > own[k][1]:
                        yield name, a, b, (places[0][0], places[-1][1]), {k: v for k, v in m.groupdict().items() if v}


def identified(text: str) -> list[Found]:
    """License sentences of a text in order; a sentence may hold more than one, in the order of SENTENCES."""
    out = []
    for a, b in sentences(text):
        plain = normalised(text[a:b])
        if not _HINT.search(plain):
            continue
        names = set()
        for order, (name, pattern) in enumerate(_PATTERNS):
            if (name, "ApacheRef" in names) == ("ApacheUnversioned", True) or not (m := pattern.search(plain)):
                continue
            got = {k: v for k, v in m.groupdict().items() if v}
            names.add(name)
            out.append((a, order, Found(name + "+" * ("p" in got), a, b, tuple(sorted(got.items()))), m[0]))
    across = list(_across(text))
    versioned = {a for name, a, *_ in across if name == "ApacheRef"}
    order = {name: k for k, (name, _) in enumerate(SENTENCES)}
    for name, a, b, span, got in across:
        if name == "ApacheUnversioned" and a in versioned:
            continue
        # what a line says of it is the beginning of the same
        whole = normalised(" ".join(text[a:b].split()))
        same = (name, "ApacheUnversioned" if name == "ApacheRef" else name)
        part = lambda f, said: f.ident.rstrip("+") in same and f.start <= a < f.end and whole.startswith(said)  # noqa: E731, B023
        out = [x for x in out if not part(x[2], x[3])]
        out.append((a, order[name], Found(name + "+" * ("p" in got), *span, tuple(sorted(got.items()))), whole))
    return [x[2] for x in sorted(out, key=lambda x: x[:2])]


def _filled(name: str, found: Found) -> str:
    v = dict(found.values)
    f = v.get("f", "")
    if found.ident.startswith("Gpl"):
        f = _FAMILY.get(f, "")
    elif found.ident == "CcRef":
        f = "-".join(_LONG.get(x, x) for x in re.split("[- ]", f)).upper()
    version = v.get("v", "")
    if name.startswith("BSD") and not version:
        version = "3"
    out = name.replace("{f}", f).replace("{v}", version)
    return re.sub(r"-(?=-|$)", "", out).replace("CC-ZERO", "CC0")


def matched(found: list[Found]) -> tuple[list[str], list[Found]]:
    """Licenses by the ordered rules, and the identifiers that none explains; each rule passes over the text once."""
    out: list[str] = []
    used: set[int] = set()
    for name, needed, along in RULES:
        places: dict[str, list[int]] = {ident: [] for ident in (*needed, *along)}
        for k, f in enumerate(found):
            if k not in used and f.ident in places:
                places[f.ident].append(k)
        at = dict.fromkeys(places, 0)
        while True:
            chosen: list[int] = []
            for ident in needed:  # the first one behind the one before; what is passed over is never needed again
                while at[ident] < len(places[ident]) and chosen and places[ident][at[ident]] <= chosen[-1]:
                    at[ident] += 1
                if at[ident] == len(places[ident]):
                    break
                chosen.append(places[ident][at[ident]])
            if len(chosen) < len(needed):
                break
            out.append(_filled(name, found[chosen[0]]))
            for ident in along:  # the first of each kind goes with this license
                if at[ident] < len(places[ident]):
                    chosen.append(places[ident][at[ident]])
                    at[ident] += 1
            for ident in needed:
                at[ident] += 1
            used.update(chosen)
    return out, [f for k, f in enumerate(found) if k not in used]


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_sentences, idents, licenses, unexplained, verdict, spans.

    ``idents`` lists the sentence identifiers in text order, ``licenses`` the distinct licenses in rule order,
    ``unexplained`` the identifiers left over; ``verdict`` is licensed, unknown (only unexplained ones) or none. Null
    and empty texts have no license. Repeated rows repeat; an empty table gives no rows.
    """
    names = ["doc_id", "n_sentences", "idents", "licenses", "unexplained", "verdict", "spans"]

    def row(text: str) -> tuple:
        found = identified(text) if text and _WRAPPED_HINT.search(text) else []
        licenses, left = matched(found)
        verdict = "licensed" if licenses else "unknown" if left else "none"
        spans = ",".join(f"{f.ident}:{f.start}:{f.end}" for f in found)
        return len(found), ",".join(f.ident for f in found), ",".join(dict.fromkeys(licenses)), ",".join(f.ident for f in left), verdict, spans

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                got = zip(*map(row, batch.column(1).to_pylist()), strict=True)
                types = [pa.int64()] + [pa.string()] * 5
                yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, map(list, got), types)], names)

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return arrow_pass(
        chosen, rows, "doc_id long, n_sentences long, idents string, licenses string, unexplained string, verdict string, spans string"
    )

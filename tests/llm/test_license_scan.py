import random
import time

import pytest

from utterloom.llm import license_scan
from utterloom.llm.license_scan import identified, matched

MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software.\n'
    "The above copyright notice and this permission notice shall be included in all copies."
)
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted.
Redistributions of source code must retain the above copyright notice. Redistributions in binary form must reproduce
Redistributions in binary form must reproduce the above copyright notice."""


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
        ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
        ("Released under the MIT License.", ["MIT"]),
        ("All rights reserved.", ["All-Rights-Reserved"]),
        ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3-only"]),
        ("Under the GNU Lesser General Public License version 2.1, or (at your option) any later version.", ["LGPL-2.1-or-later"]),
        ("It is GPLv2+ code.", ["GPL-2-or-later"]),
        (MIT, ["MIT"]),
        (f"The MIT License\n{MIT}", ["MIT"]),
        (BSD, ["BSD-2-Clause"]),
        (BSD + "\nNeither the name of X nor the names of its contributors may be used to endorse products.", ["BSD-3-Clause"]),
        ("Available under Creative Commons Attribution-ShareAlike 3.0", ["CC-BY-SA-3.0"]),
        ("SPDX-License-Identifier: MPL-2.0", ["SPDX:mpl-2.0"]),
        ("Released under the MIT License.\nLicensed under CC BY-NC 4.0.", ["MIT", "CC-BY-NC-4.0"]),
        ("No license here, only a permission to walk.", []),
    ],
)
def test_rules(text, want):
    assert matched(identified(text))[0] == want


def test_order_of_sentences_matters():
    a, b = MIT.split("\n")
    licenses, left = matched(identified(f"{b}\n{a}"))
    assert licenses == [] and [f.ident for f in left] == ["MitNotice", "MitGrant"]


def test_table(spark):
    rows = [(1, "x\nReleased under the MIT License.", 1), (2, None, 1), (None, "", 1), (4, "Any later version", 1), (1, "x\nReleased under the MIT License.", 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, verdict int")
    got = sorted(((r.doc_id, r.licenses, r.verdict, r.spans) for r in license_scan.scan(d).collect()), key=str)
    one = (1, "MIT", "licensed", "MitRef:2:33")
    assert got == sorted([one, one, (2, "", "none", ""), (None, "", "none", ""), (4, "", "none", "")], key=str)
    assert license_scan.scan(d.limit(0)).count() == 0


def _plain(found):
    """Rules tried one match at a time over all that is left."""
    left, out = list(found), []
    for name, needed, along in license_scan.RULES:
        while True:
            at, used = 0, []
            for f in left:
                if at < len(needed) and f.ident == needed[at]:
                    used.append(f)
                    at += 1
            if at < len(needed):
                break
            out.append(license_scan._filled(name, used[0]))
            for ident in along:
                used += [f for f in left if f.ident == ident][:1]
            left = [f for f in left if f not in used]
    return out, left


def test_rules_against_a_plain_model_and_on_long_texts():
    rng = random.Random(9)
    idents = [name for name, _ in license_scan.SENTENCES] + ["GplShort+"]
    for _ in range(1500):
        few = rng.sample(idents, rng.randint(1, 6))
        found = [license_scan.Found(rng.choice(few), k, k + 1, ()) for k in range(rng.randint(0, 14))]
        assert license_scan.matched(found) == _plain(found)
    began = time.perf_counter()
    text = "Released under the MIT License.\n" * 50_000
    assert len(license_scan.matched(license_scan.identified(text))[0]) == 50_000
    assert time.perf_counter() - began < 30

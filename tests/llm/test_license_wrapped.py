from utterloom.llm.license_scan import identified, matched

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above
   copyright notice, this list of conditions.
"""
BSD3 = BSD + """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above"""
APACHE = """Licensed under the Apache License,
Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of
the License at"""
GPL = """This program is free software; you can redistribute it and/or modify it under
the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version."""


def test_wrapped_notices():
    want = [(MIT, "MIT"), (BSD, "BSD-2-Clause"), (BSD3, "BSD-3-Clause"), (ISC, "ISC"), (APACHE, "Apache-2.0"), (GPL, "GPL-2.0-or-later")]
    for text, name in want:
        for before in ("", "// ", " * ", "# ", "-- "):
            marked = "Some words\n\n" + "\n".join((before + x).rstrip() for x in text.split("\n"))
            found = identified(marked)
            licenses, left = matched(found)
            assert [x.replace("GPL-2-", "GPL-2.0-") for x in licenses] == [name], (text, before)
            assert not left and all(0 <= f.start < f.end <= len(marked) for f in found)


def test_lines_of_their_own():
    text = "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: Apache-2.0\nAll rights\nreserved"
    assert [f.ident for f in identified(text)] == ["Spdx", "Spdx", "AllRights"]

"""License notices as projects ship them, typed apart from the operator's own texts."""

import collections

from vesselflow.llm import licenses

GPL2 = """    This program is free software; you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation; either version 2 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License along
    with this program; if not, write to the Free Software Foundation, Inc.
"""
GPL3 = """/*
 * Foo is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * Foo is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details.
 */"""
LGPL21 = """/* This library is free software; you can redistribute it and/or
   modify it under the terms of the GNU Lesser General Public
   License as published by the Free Software Foundation; either
   version 2.1 of the License, or (at your option) any later version.

   This library is distributed in the hope that it will be useful,
   but WITHOUT ANY WARRANTY; without even the implied warranty of
   MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
   Lesser General Public License for more details. */"""
GPL2_ONLY = """# This program is free software; you can redistribute it and/or modify it
# under the terms of the GNU General Public License as published by the Free
# Software Foundation; version 2 of the License."""
BSD = """Copyright (c) 2009 The Authors. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are
met:

   * Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer.
   * Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the
distribution.
{0}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS
"AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.
"""
NAMES = """   * Neither the name of Example Corp. nor the names of its
contributors may be used to endorse or promote products derived from
this software without specific prior written permission.
"""
BSD4 = """1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
3. All advertising materials mentioning features or use of this software
   must display the following acknowledgement:
     This product includes software developed by the University of
     Somewhere and its contributors.
4. Neither the name of the University nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.
"""
BSD4 = BSD.split("\n\n")[1].replace("conditions are\nmet:", "conditions\nare met:") + "\n" + BSD4
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
{0} BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
X11 = MIT.format("X CONSORTIUM") + """
Except as contained in this notice, the name of the X Consortium shall not be
used in advertising or otherwise to promote the sale, use or other dealings
in this Software without prior written authorization from the X Consortium.
"""
SHIPPED = [
    (GPL2, {"GPL-2.0-or-later": 1}),
    (GPL3, {"GPL-3.0-or-later": 1}),
    (LGPL21, {"LGPL-2.1-or-later": 1}),
    (GPL2_ONLY, {"GPL-2.0-only": 1}),
    (BSD.format(""), {"BSD-2-Clause": 1, "all-rights-reserved": 1}),
    (BSD.format(NAMES), {"BSD-3-Clause": 1, "all-rights-reserved": 1}),
    (BSD4, {"BSD-4-Clause": 1}),
    (MIT.format("AUTHORS OR COPYRIGHT HOLDERS"), {"MIT": 1}),
    (MIT.format("FOO FOUNDATION"), {"MIT": 1}),
    (X11, {"X11": 1}),
    (MIT.format("AUTHORS") + "\n\n" + GPL2, {"MIT": 1, "GPL-2.0-or-later": 1}),
    ("License: MIT\n", {"MIT": 1}),
    ("## License\n\nThis project is licensed under the terms of the MIT License.\n", {"MIT": 1}),
    ("It is available under the BSD 3-Clause License.", {"BSD-3-Clause": 1}),
    ("Note: Released under the Apache License 2.0. See LICENSE.", {"Apache-2.0": 1}),
    ("Distributed under GPLv3.", {"GPL-3.0-only": 1}),
    ("We like the MIT License. It is a license; it is free software, they say.", {}),
    ("The program may be redistributed. Neither warranty nor permission is given.", {}),
    ("license " * 50_000, {}),
]


def test_licenses_as_shipped(spark):
    rows = [(i, text) for i, (text, _) in enumerate(SHIPPED)]
    got = collections.defaultdict(dict)
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r.doc_id][r.license] = r.n_found
    for i, (text, want) in enumerate(SHIPPED):
        assert got[i] == want, (text[:200], got[i])


def test_wordings_share_an_identifier(spark):
    known, rules = licenses.known_sentences(spark)
    sids = {r.sentence: r.sid for r in known.collect()}
    assert sids["licensed under the terms of the mit license"] == sids["license mit"]
    assert len({tuple(x) for _, x in rules}) == len(rules)

"""License scans: known license sentences are mapped to identifiers, and sequences of identifiers to licenses.

A text is cut into sentences in two views: line by line, and by paragraphs with comment marks and list numbers taken off
and wrapped lines joined. Copyright lines and addresses stand alone there, and names that a license leaves to its user
(the holder, the program) are put in one form. Several wordings may stand for one identifier. Sentences are normalised (lower case, letters
and digits only, single spaces) and joined with the table of known sentences, which comes from the texts of this module,
cut in the same way, and so is of fixed size. What a document's sentences are recognised as, in order, is then searched
for every rule's sequence of identifiers; longer rules win over the rules whose sequence they contain. The licenses
named by `SPDX-License-Identifier:` are sentences of a view of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vesselflow.llm import _common as C

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"""
_MIT_NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
_MIT_NO_EVENT = "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_BINARY = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_AUTHOR = "The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_ADVERTS = "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the holder."
_X11_NAMES = "Except as contained in this notice, the name of the holder shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization from the holder."
_GNU_HOPE = "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
_GNU_SEE = "See the GNU {0} General Public License for more details."


def _gnu(name: str, which: str, notice: bool) -> str:
    """The notice that a GNU license asks for, or only its first sentence."""
    terms = f"This program is free software; you can redistribute it and/or modify it under the terms of the GNU {name}General Public License as published by the Free Software Foundation; {which}"
    return f"{terms} {_GNU_HOPE} {_GNU_SEE.format(name.strip())}" if notice else terms


#: What public licenses and notices say, in the rules' order: (license, text that states it).
RULES = [
    ("X11", f"{_MIT_GRANT} {_MIT_NOTICE} {_AS_IS} {_MIT_NO_EVENT} {_X11_NAMES}"),
    ("MIT", f"{_MIT_GRANT} {_MIT_NOTICE} {_AS_IS} {_MIT_NO_EVENT}"),
    ("MIT", f"{_MIT_GRANT} {_MIT_NOTICE} {_AS_IS}"),
    ("MIT", f"{_MIT_GRANT} {_MIT_NOTICE}"),
    ("MIT-0", f"""{_MIT_GRANT.removesuffix(', subject to the following conditions:')}. {_AS_IS}"""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Licensed under the MIT license (see LICENSE)."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "This software is released under the MIT License."),
    ("MIT", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

        http://www.apache.org/licenses/LICENSE-2.0

        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    ),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License."""),
    ("Apache-2.0", """The ASF licenses this file to You under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License."""),
    ("Apache-2.0", """The ASF licenses this file to you under the Apache License, Version 2.0 (the "License");"""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License 2.0."),
    ("Apache-2.0", "This project is licensed under the Apache License 2.0."),
    ("Apache-2.0", "This project is licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License\n\nVersion 2.0, January 2004\n\nhttp://www.apache.org/licenses/"),
    ("BSD-4-Clause", f"{_BSD_GRANT} {_BSD_SOURCE} {_BSD_BINARY} {_BSD_ADVERTS} {_BSD_NAMES}"),
    ("BSD-4-Clause", f"{_BSD_GRANT} {_BSD_SOURCE} {_BSD_BINARY} {_BSD_ADVERTS} {_BSD_AUTHOR}"),
    ("BSD-3-Clause", f"{_BSD_GRANT} {_BSD_SOURCE} {_BSD_BINARY} {_BSD_NAMES}"),
    ("BSD-3-Clause", f"{_BSD_GRANT} {_BSD_SOURCE} {_BSD_BINARY} {_BSD_AUTHOR}"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-2-Clause", f"{_BSD_GRANT} {_BSD_SOURCE} {_BSD_BINARY}"),
    *(
        (f"{short}-{version}-{'or-later' if later else 'only'}", _gnu(name, which.format(version.removesuffix(".0")), notice))
        for short, name, versions in (("GPL", "", ("2.0", "3.0")), ("LGPL", "Library ", ("2.0",)), ("LGPL", "Lesser ", ("2.1", "3.0")), ("AGPL", "Affero ", ("3.0",)))
        for version in versions
        for later, which in (
            (True, "either version {} of the License, or (at your option) any later version."),
            (False, "version {} of the License."),
            (False, "version {}."),
        )
        for notice in (True, False)
    ),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "This program is licensed under the GNU General Public License version 3."),
    ("GPL-3.0-only", "GNU GENERAL PUBLIC LICENSE\n\nVersion 3, 29 June 2007"),
    ("GPL-2.0-only", "GNU GENERAL PUBLIC LICENSE\n\nVersion 2, June 1991"),
    ("AGPL-3.0-only", "GNU AFFERO GENERAL PUBLIC LICENSE\n\nVersion 3, 19 November 2007"),
    ("LGPL-3.0-only", "GNU LESSER GENERAL PUBLIC LICENSE\n\nVersion 3, 29 June 2007"),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("WTFPL", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE"),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    *(
        (f"CC-{short}-4.0", text)
        for short, name in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
        for text in (
            f"Licensed under CC {short} 4.0.",
            f"This work is licensed under CC {short} 4.0.",
            f"This work is licensed under a Creative Commons {name} 4.0 International License.",
            f"This work is licensed under the Creative Commons {name} 4.0 International License.",
            f"Creative Commons {name} 4.0 International",
        )
    ),
    ("all-rights-reserved", "All rights reserved."),
]
#: Names that licenses go by in short statements, and the statements; all wordings of a license have one identifier.
NAMES = {
    "MIT": ("MIT License", "MIT"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "BSD-3-Clause"),
    "ISC": ("ISC License", "ISC"),
    "GPL-2.0-only": ("GNU General Public License v2.0", "GNU General Public License, version 2", "GNU GPL v2", "GPLv2"),
    "GPL-3.0-only": ("GNU General Public License v3.0", "GNU General Public License, version 3", "GNU GPL v3", "GPLv3"),
    "LGPL-2.1-only": ("GNU Lesser General Public License v2.1", "GNU Lesser General Public License, version 2.1", "LGPLv2.1"),
    "LGPL-3.0-only": ("GNU Lesser General Public License v3.0", "GNU Lesser General Public License, version 3", "LGPLv3"),
    "AGPL-3.0-only": ("GNU Affero General Public License v3.0", "GNU Affero General Public License, version 3", "AGPLv3"),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0", "MPL-2.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License, version 2.0", "EPL-2.0"),
    "BSL-1.0": ("Boost Software License 1.0", "Boost Software License, Version 1.0", "BSL-1.0"),
    "Unlicense": ("Unlicense",),
}
STATEMENTS = ("License: {0}", "{1} licensed under {0}", "{1} released under {0}", "{1} distributed under {0}", "{1} available under {0}", "{1} made available under {0}")
#: What a license leaves to its user to name, and the form it takes here.
SLOTS = (
    (r"(?i)\bneither the names? of .{1,300}? nor the names? of .{0,200}?contributors may be used", "Neither the name of the copyright holder nor the names of its contributors may be used"),
    (r"(?i)\bfollowing acknowledge?ment:", "following acknowledgement:"),
    (r"(?i)\bthis product includes software developed by .{1,300}?\.(?=\W|$)", "This product includes software developed by the holder."),
    (r"(?i)\bin no event shall .{1,200}? be liable for any claim", "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM"),
    (r"(?i)\bexcept as contained in this notice,? the names? of .{1,200}? shall not be used in advertising", "Except as contained in this notice, the name of the holder shall not be used in advertising"),
    (r"(?i)\bwithout prior written authorization from .{1,200}?\.(?=\W|$)", "without prior written authorization from the holder."),
    (r"(?i)\b(?:this )?[\w.-]+ is free software(?=[,:;])", "This program is free software"),
    (r"(?i)\b(?:this )?[\w.-]+ is distributed in the hope that", "This program is distributed in the hope that"),
)
#: Names that an SPDX line may give, besides the licenses of RULES.
SPDX = ("GPL-2.0", "GPL-2.0+", "GPL-3.0", "GPL-3.0+", "LGPL-2.1", "LGPL-2.1+", "LGPL-3.0", "AGPL-3.0", "Apache-1.1", "BSD-4-Clause", "EPL-1.0", "EUPL-1.2", "MPL-1.1", "Artistic-2.0", "PSF-2.0", "CC-BY-3.0", "CC-BY-SA-3.0")

#: Every rule's text has one of these words; texts without any are not cut up.
HINT = r"(?i)licen[sc]e|(?:released|distributed|available)\s+under|permission|warrant|redistribut|rights\s+reserved|unencumbered|CC0|Creative\s+Commons|possible\s+under\s+law"
#: A colon or semicolon ends a sentence only before a capital letter: terms of one sentence are kept together, however marked.
SENTENCE_END = r"(?<=[.!?])\s+|(?<=[:;])(?<!(?i:licen[sc]e):)\s+(?=[\"“]?\p{Lu})"
_NAMED = r"(?i)SPDX-License-Identifier:\s*([^\n\r*]+)"


def normalised(sentence: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}]+", " "))


def paragraphs(text: Column) -> Column:
    """Sentences of the paragraphs: comment marks and list numbers off, wrapped lines joined, copyright lines and addresses alone."""
    for pattern, by in (
        (r"\r\n?", "\n"),
        (r"(?m)[ \t]*(?:\*+/|-->)[ \t]*$", ""),
        (r"(?m)^[ \t]*(?:(?:#+|/{2,}|/\*+|\*+|--+|;+|%+|>+|\.\.|dnl\b|REM\b|<!--)[ \t]*)+", ""),
        (r"(?m)^[ \t]*(?:\(?(?:\d{1,2}|[a-zA-Z]|[ivx]{1,4})[.)]|[-•])[ \t]+", ""),
        (r"(?im)^([ \t]*(?:portions )?(?:copyright[ \t]*(?:\(c\)|©|[12]\d{3}|by\b|:|\[|<|\{)|\(c\)|©)[^\n]*)$", "\n\n$1\n\n"),
        (r"(https?://\S+)", "\n\n$1\n\n"),
    ):
        text = F.regexp_replace(text, pattern, by)

    def sentences(x: Column) -> Column:
        x = F.btrim(F.regexp_replace(x, r"\s+", " "))
        for pattern, by in SLOTS:
            x = F.regexp_replace(x, pattern, by)
        return F.split(x, SENTENCE_END)

    return F.flatten(F.transform(F.split(text, r"\n[ \t]*\n\s*"), sentences))


def stated() -> list[tuple[str, str]]:
    """(license, short statement that names it)."""
    who = ("This project is", "This software is", "This work is", "This program is", "The code is", "It is", "")
    how = ("the {}", "the terms of the {}", "the terms and conditions of the {}", "{}", "a {}")
    out = {}
    for name, names in NAMES.items():
        for own in names:
            for form in STATEMENTS:
                for subject in who if "{1}" in form else ("",):
                    for by in how if "{1}" in form else ("{}", "the {}"):
                        out.setdefault(form.format(by.format(own), subject).strip(), name)
    return [(name, text) for text, name in out.items()]


def _spdx(text: Column) -> Column:
    """A sentence for each license that the SPDX lines name."""
    names = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(_NAMED), F.lit(1)), lambda x: F.split(x, r"(?i)\s+(?:and|or|with)\s+|[()\s/]+")))
    return F.transform(F.filter(names, lambda x: x != ""), lambda x: F.concat(F.lit("SPDX license "), F.regexp_replace(x, r"\+$", " plus")))


def known_sentences(spark: SparkSession) -> tuple[DataFrame, list[tuple[str, tuple[int, ...]]]]:
    """(sentence, sid), and the rules as (license, sids): as many rows as this module lists."""
    names = dict.fromkeys([*(name for name, _ in RULES[:-1]), *SPDX])
    wordings = stated()
    first = len(RULES) + len(names)
    rows = [(k, name, text, False) for k, (name, text) in enumerate(RULES)] + [(len(RULES) + k, name, f"SPDX-License-Identifier: {name}", True) for k, name in enumerate(names)]
    rows += [(first + k, name, text, False) for k, (name, text) in enumerate(wordings)]
    frame = spark.createDataFrame(rows, "rule int, license string, raw string, spdx boolean")
    cut = F.when(F.col("spdx"), _spdx(F.col("raw"))).otherwise(paragraphs(F.col("raw")))
    found = frame.select("rule", "license", F.posexplode(cut).alias("at", "s")).select("rule", "license", "at", normalised(F.col("s")).alias("s")).where("s <> ''").orderBy("rule", "at").collect()
    ids: dict[str, int] = {}
    rules: dict[int, tuple[str, list[int]]] = {}
    one: dict[str, int] = {}  # identifier of a license's short statements
    for r in found:
        new = one.setdefault(r.license, len(ids)) if r.rule >= first else len(ids)
        rules.setdefault(r.rule, (r.license, []))[1].append(ids.setdefault(r.s, new))
    # Longer sequences first; a rule of the table before a later one with the same sequence.
    ordered: dict[tuple[int, ...], str] = {}
    for _, (name, sids) in sorted(rules.items(), key=lambda x: (-len(x[1][1]), x[0])):
        ordered.setdefault(tuple(sids), name)
    return spark.createDataFrame(list(ids.items()), "sentence string, sid int"), [(name, sids) for sids, name in ordered.items()]


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, license, n_found: a row for every license that a document (doc_id, text) states; none for the others.

    n_found counts the rule's places in the document, SPDX lines besides. Null and empty texts state nothing. Every row is
    read by itself: no rule spans two rows, and what rows with the same doc_id (or none) state is added up.
    """
    spark = docs.sparkSession
    known, rules = known_sentences(spark)
    hinted = docs.select("doc_id", "text").where(F.col("text").rlike(HINT)).withColumn("row", F.monotonically_increasing_id())
    lines = F.flatten(F.transform(F.split("text", r"\r?\n"), lambda x: F.split(x, SENTENCE_END)))
    views = F.array(*(F.struct(F.lit(k).alias("view"), s.alias("s")) for k, s in enumerate((lines, paragraphs(F.col("text")), _spdx(F.col("text"))))))
    placed = hinted.select("row", "doc_id", F.inline(views)).select("row", "doc_id", "view", F.posexplode("s").alias("at", "raw"))
    found = placed.select("row", "doc_id", "view", "at", normalised(F.col("raw")).alias("sentence")).where("sentence <> ''").join(F.broadcast(known), "sentence")
    # Few bytes, but work for each row: by size alone all of them would be one task. All groups of a row follow this one shuffle.
    found = found.select("row", "doc_id", "view", "at", "sid").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "row")
    chain = found.groupBy("row", "doc_id", "view").agg(F.sort_array(F.collect_list(F.struct("at", "sid"))).alias("c"))
    text = chain.select("row", "doc_id", "view", F.concat(F.lit("|"), F.array_join(F.transform("c", lambda x: x["sid"].cast("string")), "||"), F.lit("|")).alias("chain"))

    # What a rule takes is marked as used, so that shorter rules don't count it again.
    step = lambda acc, rule: F.struct(F.replace(acc["left"], rule["ids"], F.lit("|#|")).alias("left"), F.concat(acc["found"], F.array(F.struct(rule["license"].alias("license"), ((F.length(acc["left"]) - F.length(F.replace(acc["left"], rule["ids"], F.lit("")))) / F.length(rule["ids"])).cast("long").alias("n")))).alias("found"))
    listed = F.array(*(F.struct(F.lit(name).alias("license"), F.lit("".join(f"|{i}|" for i in sids)).alias("ids")) for name, sids in rules))
    nothing = F.struct(F.col("chain").alias("left"), F.array().cast("array<struct<license:string,n:bigint>>").alias("found"))
    rows = text.select("row", "doc_id", "view", F.inline(F.aggregate(listed, nothing, step)["found"])).where("n > 0")
    by_view = rows.groupBy("row", "doc_id", "license", "view").agg(F.sum("n").alias("n"))
    # The first two views see the same places; the fuller one counts.
    n = F.coalesce(F.max(F.when(F.col("view") < 2, F.col("n"))), F.lit(0)) + F.coalesce(F.max(F.when(F.col("view") == 2, F.col("n"))), F.lit(0))
    by_row = by_view.groupBy("row", "doc_id", "license").agg(n.alias("n"))
    return by_row.groupBy("doc_id", "license").agg(F.sum("n").alias("n_found"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(C.table(spark, sf_dir, "documents"))

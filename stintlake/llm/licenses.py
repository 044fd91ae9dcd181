"""License scans by canonical digest lookup, in DataFrame functions.

A text is made canonical: lower case, without copyright lines, punctuation as
single spaces, equivalent spellings alike. Whole texts, their paragraphs
(parted by blank lines) and their lines are digested and hash-joined with the
digests of known licence texts and notices. A licence of several paragraphs is
found when the document has all of them (so a text with all of BSD-3-Clause
also has all of BSD-2-Clause).

Null texts have no units, and units without a letter or digit are not looked
up. Rows that share doc_id and text are one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick

# Words and phrases that count as the same, after punctuation went.
SPELLINGS = {
    "licence": "license", "sub license": "sublicense", "organisation": "organization", "authorisation": "authorization",
    "authorised": "authorized", "favour": "favor", "behaviour": "behavior", "honour": "honor", "labour": "labor",
    "acknowledgement": "acknowledgment", "analogue": "analog", "artefact": "artifact", "catalogue": "catalog",
    "fulfil ": "fulfill ", "initialise": "initialize", "merchantibility": "merchantability", "modelling": "modeling",
    "non commercial": "noncommercial", "per cent": "percent", "practise": "practice", "programme": "program",
    "recognise": "recognize", "utilisation": "utilization", "whilst": "while", "wilful": "willful", "https": "http",
    "copyright owner": "copyright holder", "copyright holders and contributors": "copyright holder and contributors",
}
COPYRIGHT_LINE = r"(^|\n)[^\n\p{L}\p{N}]*(?:copyright[ :]*(?:\(c\)|©)?[ ,<\[(]*(?:\p{N}{4}|year|yyyy)|\(c\) *\p{N}{4}|© *\p{N}{4}|all rights reserved)[^\n]*"

_WARRANTY = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
             "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
             "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
             "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_1 = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_2 = ("2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
          "disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_3 = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
          "derived from this software without specific prior written permission.")
_BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
            "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
            "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
            "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
            "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
            "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
            "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC_HEAD = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted{}.")
_ISC_END = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
            "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
            "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
            "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
            "THIS SOFTWARE.")

# Full texts of short licences, paragraph by paragraph, without title and copyright lines.
TEXTS = {
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
            "Software is furnished to do so, subject to the following conditions:",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
            _WARRANTY],
    "ISC": [_ISC_HEAD.format(", provided that the above copyright notice and this permission notice appear in all copies"), _ISC_END],
    "0BSD": [_ISC_HEAD.format(""), _ISC_END],
    "BSD-2-Clause": [_BSD_HEAD, _BSD_1, _BSD_2, _BSD_END],
    "BSD-3-Clause": [_BSD_HEAD, _BSD_1, _BSD_2, _BSD_3, _BSD_END],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
             "any damages arising from the use of this software.",
             "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
             "redistribute it freely, subject to the following restrictions:",
             "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you "
             "use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.",
             "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
             "3. This notice may not be removed or altered from any source distribution."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.",
                  "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or "
                  "as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
                  "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright "
                  "interest in the software to the public domain. We make this dedication for the benefit of the public at large and to "
                  "the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity "
                  "of all present and future rights to this software under copyright law.",
                  _WARRANTY.replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS")],
    "BSL-1.0": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
                "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and "
                "transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software "
                "is furnished to do so, all subject to the following:",
                "The copyright notices in the Software and this entire statement, including the above license grant, this restriction and "
                "the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of "
                "the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by "
                "a source language processor.",
                "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
                "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT "
                "HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR "
                "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
}

_APACHE = ("under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
           "You may obtain a copy of the License at")
_GNU = "This {} is free software: you can redistribute it and/or modify it under the terms of the GNU {} License"
_FSF = " as published by the Free Software Foundation"

# Standard headers of files, by the paragraph or line that names the licence.
HEADERS = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0 (the \"License\");", "Licensed " + _APACHE,
                   "Licensed " + _APACHE + " http://www.apache.org/licenses/LICENSE-2.0",
                   "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file "
                   "distributed with this work for additional information regarding copyright ownership. The ASF licenses this file to You " + _APACHE],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
                "with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
                "http://www.boost.org/LICENSE_1_0.txt)"],
    **{f"{short}-{v}": [_GNU.format(what, long) + end for what in ("program", "library", "file", "software")
                        for end in (f"{_FSF}, either version {v.removesuffix('.0')} of the License, or (at your option) any later version.",
                                    f"{_FSF}, version {v.removesuffix('.0')} of the License.", f" version {v.removesuffix('.0')}{_FSF}.")]
       for short, long, v in (("GPL", "General Public", "2.0"), ("GPL", "General Public", "3.0"), ("LGPL", "Library General Public", "2.0"),
                              ("LGPL", "Lesser General Public", "2.1"), ("LGPL", "Lesser General Public", "3.0"),
                              ("AGPL", "Affero General Public", "3.0"))},
}

# Names by which notices call licences.
NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"],
    "MIT": ["MIT License", "MIT"], "ISC": ["ISC License", "ISC"], "BSD-2-Clause": ["BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "BSD License"], "Zlib": ["zlib License"], "BSL-1.0": ["Boost Software License, Version 1.0"],
    "Unlicense": ["Unlicense"], "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    **{f"{short}-{v}.0": [f"GNU {long} License, version {v}", f"GNU {long} License v{v}.0", f"GNU {long} License version {v}.0", f"GNU {short} v{v}", f"{short}v{v}", f"{short}-{v}.0"]
       for short, long, versions in (("GPL", "General Public", "23"), ("LGPL", "Lesser General Public", "23"), ("AGPL", "Affero General Public", "3")) for v in versions},
    **{f"CC-{kind}-{v}": [f"CC {kind} {v}", f"CC-{kind}-{v}", f"Creative Commons {kind} {v}"]
       for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND") for v in ("2.0", "3.0", "4.0")},
    "CC0-1.0": ["CC0 1.0", "CC0"],
}
NOTICES = ["Licensed under {}", "Released under {}", "Distributed under {}", "This work is licensed under {}", "This software is licensed under {}",
           "This project is licensed under {}", "This file is licensed under {}", "License: {}", "SPDX-License-Identifier: {}"]


def known_units() -> list[tuple[str, int, int, str]]:
    """(license_id, part, parts, text); notices are licences of one part."""
    rows = [(k, i, len(parts), p) for k, parts in TEXTS.items() for i, p in enumerate(parts)]
    rows += [(k, -1, 1, notice.format(article + name)) for k, names in NAMES.items() for name in names for notice in NOTICES for article in ("", "the ")]
    rows += [(k, -2, 1, "\n\n".join(parts)) for k, parts in TEXTS.items()]
    rows += [(k, -3, 1, header) for k, headers in HEADERS.items() for header in headers]
    return rows


def canonical(text: Column) -> Column:
    """Canonical form that still has the text's line feeds."""
    t = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "$1")
    t = F.regexp_replace(t, r"[^\p{L}\p{N}\n]+", " ")
    for other, usual in SPELLINGS.items():
        t = F.replace(t, F.lit(other), F.lit(usual))
    return t


def _flat(t: Column) -> Column:
    return F.trim(F.regexp_replace(t, r"[ \n]+", " "))


def known_digests(spark: SparkSession) -> DataFrame:
    """(digest, license_id, part, parts): a fixed number of rows, some thousands."""
    rows = spark.createDataFrame(known_units(), "license_id string, part int, parts int, text string")
    return rows.select(F.sha2(_flat(canonical(F.col("text"))), 256).alias("digest"), "license_id", "part", "parts").distinct()


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document and licence found whole: doc_id, license_id, scope (the
    widest unit that it was found in: text, paragraph, line)."""
    d = pick(docs, doc_id=doc_id, text=text).filter(F.col("text").isNotNull())
    d = d.select("doc_id", F.xxhash64("text").alias("h"), canonical(F.col("text")).alias("c"))
    whole = F.array(_flat(F.col("c")))
    paragraphs = F.transform(F.split("c", r"\n *\n"), _flat)
    lines = F.transform(F.split("c", "\n"), lambda x: F.trim(x))

    def digests(units: Column, scope: int) -> Column:
        return F.transform(F.array_distinct(units), lambda u: F.struct(F.lit(scope).alias("scope"), F.sha2(u, 256).alias("digest")))

    units = d.select("doc_id", "h", F.explode_outer(F.concat(digests(whole, 0), digests(paragraphs, 1), digests(lines, 2))).alias("u"))
    hits = units.select("doc_id", "h", "u.*").join(F.broadcast(known_digests(docs.sparkSession)), "digest")
    # the parts of a licence: all of them, in units of one scope; a notice or whole text is one part
    kind = F.when(F.col("part") >= 0, F.lit(0)).otherwise(F.col("part"))
    whole_found = (hits.groupBy("doc_id", "h", "license_id", "scope", kind.alias("kind"), "parts")
                   .agg(F.count_distinct("part").alias("n")).filter(F.col("n") == F.col("parts")))
    return (whole_found.groupBy("doc_id", "h", "license_id").agg(F.min("scope").alias("scope"))
            .select("doc_id", "license_id", F.element_at(F.array(*map(F.lit, ("text", "paragraph", "line"))), F.col("scope") + 1).alias("scope")))


def oracle_sql() -> str:
    """DuckDB SQL for ``scan`` over ``documents``, from the same fixed values."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    text = f"regexp_replace(regexp_replace(lower(text), {quote(COPYRIGHT_LINE)}, '\\1', 'g'), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
    for other, usual in SPELLINGS.items():
        text = f"replace({text}, {quote(other)}, {quote(usual)})"
    flat = "trim(regexp_replace({}, '[ \\n]+', ' ', 'g'), ' ')"
    rows = ", ".join(f"({quote(k)}, {i}, {n}, {quote(t)})" for k, i, n, t in known_units())
    return f"""
WITH known_text(license_id, part, parts, text) AS (VALUES {rows}),
known AS (SELECT DISTINCT license_id, part, parts, {flat.format('c')} AS unit
          FROM (SELECT license_id, part, parts, {text} AS c FROM known_text)),
docs AS (SELECT DISTINCT doc_id, text, {text} AS c FROM documents WHERE text IS NOT NULL),
units AS (SELECT doc_id, text, 0 AS scope, {flat.format('c')} AS unit FROM docs
          UNION ALL SELECT doc_id, text, 1, {flat.format('p')} FROM (SELECT doc_id, text, unnest(string_split_regex(c, '\\n *\\n')) AS p FROM docs)
          UNION ALL SELECT doc_id, text, 2, trim(l, ' ') FROM (SELECT doc_id, text, unnest(string_split(c, chr(10))) AS l FROM docs)),
found AS (SELECT doc_id, text, license_id, scope, parts, CASE WHEN part >= 0 THEN 0 ELSE part END AS kind, count(DISTINCT part) AS n
          FROM units JOIN known USING (unit) GROUP BY ALL)
SELECT doc_id, license_id, CASE min(scope) WHEN 0 THEN 'text' WHEN 1 THEN 'paragraph' ELSE 'line' END AS scope
FROM (SELECT doc_id, text, license_id, scope FROM found WHERE n = parts)
GROUP BY doc_id, text, license_id"""

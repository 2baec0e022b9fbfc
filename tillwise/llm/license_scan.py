"""Licence scan by canonical digests, in DataFrame expressions only.

A text is reduced to a canonical form: case, punctuation, copyright lines, URLs'
schemes and equivalent spellings are levelled. Its SHA-256 is looked up among the
digests of known licence texts by a hash join. The entire text is looked up, each of its
lines, and each run of lines as long as a known text, however it is wrapped: a document
can be a licence, hold one, or end with a notice.

A copyright line begins with "copyright" and has "(c)", the sign, a year or a placeholder;
or begins with one of the former two and has a year. "All rights reserved" goes as well.

Only rows with a match are regrouped; the table of known digests is as long as the
list below and is broadcast. Repeated lines of a document are looked up once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.workspace import materialise

# Equivalent spellings, as licence comparison guidelines list them.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("copyright owner", "copyright holder"),
    ("favour", "favor"),
    ("fulfilment", "fulfillment"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelled", "labeled"),
    ("licence", "license"),
    ("noncommercial", "non commercial"),
    ("organisation", "organization"),
    ("per cent", "percent"),
    ("recognise", "recognize"),
    ("sub license", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
)

# Published licence texts and notices.
MIT_BODY = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_BODY = """Permission to use, copy, modify, and/or distribute this software for any purpose with
or without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License
is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
implied. See the License for the specific language governing permissions and limitations under the
License."""
BSD_CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions
and the following disclaimer in the documentation and/or other materials provided with the
distribution.

"""
BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission.

"""
BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ZLIB_BODY = """This software is provided 'as-is', without any express or implied warranty. In no event will
the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications,
and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be
appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software.

3. This notice may not be removed or altered from any source distribution."""
MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy
of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
GNU_NOTICE = """This {what} is free software: you can redistribute it and/or modify it under the terms of the
GNU {name} as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version.

This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more
details.

You should have received a copy of the GNU {name} along with this {what}. If not, see
<https://www.gnu.org/licenses/>."""
UNLICENSE_BODY = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source
code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all
copyright interest in the software to the public domain. We make this dedication for the benefit of the
public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt
act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""
SPDX_IDS = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause",
    "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0",
    "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-2.0",
    "Unlicense", "WTFPL", "Zlib",
)
KNOWN = (
    ("AGPL-3.0", GNU_NOTICE.format(what="program", name="Affero General Public License")),
    ("Apache-2.0", APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", BSD_CONDITIONS + BSD_DISCLAIMER),
    ("BSD-3-Clause", BSD_CONDITIONS + BSD_NAMES + BSD_DISCLAIMER),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", GNU_NOTICE.format(what="program", name="General Public License")),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("ISC", ISC_BODY),
    ("ISC", "ISC License\n" + ISC_BODY),
    ("LGPL-3.0", GNU_NOTICE.format(what="library", name="Lesser General Public License")),
    ("MIT", MIT_BODY),
    ("MIT", "MIT License\n" + MIT_BODY),
    ("MIT", "The MIT License (MIT)\n" + MIT_BODY),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", MPL_NOTICE),
    ("Unlicense", UNLICENSE_BODY),
    ("Zlib", ZLIB_BODY),
    *((name, f"SPDX-License-Identifier: {name}") for name in SPDX_IDS),
)
# Copyright lines of a text in small letters, each with the end of the line before. The sign
# has become "(c)"; a line that only begins with that needs a year, as lists are lettered too.
COPYRIGHT = (
    r"\n[^a-z0-9\n]*(copyright[^\n]*(\(c\)|[0-9][0-9][0-9][0-9]|<[^>\n]*>|\[yyyy\])[^\n]*"
    r"|\(c\)[^\n]*[0-9][0-9][0-9][0-9][^\n]*|all rights reserved[^a-z0-9\n]*)"
)


def canonical_lines(text: Column) -> Column:
    """The lines of ``text`` with case, punctuation, copyright lines and spellings levelled.

    ASCII punctuation becomes white space; letters of other scripts are kept.
    """
    out = F.concat(F.lit("\n"), F.lower(text))
    for old, new in (("https://", ""), ("http://", ""), ("&", " and ")):
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.replace(out, F.lit("©"), F.lit("(c)"))
    out = F.regexp_replace(out, COPYRIGHT, "\n")
    out = F.regexp_replace(out, "[\\x00-\\x09\\x0b-\\x2f\\x3a-\\x60\\x7b-\\x7f‘’“”–—]+", " ")
    out = reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, out)
    lines = F.transform(F.split(out, "\n"), lambda line: F.trim(line))
    return F.filter(lines, lambda line: line != "")


def _whole(lines: Column) -> Column:
    return F.array_join(lines, " ")


def _runs(lines: Column, lengths: list[int]) -> Column:
    """Runs of several lines, joined by spaces, that are as long as some known form.

    A line ends at the sum of the lengths before it, each with its space. A run of length n
    lies between ends that differ by n + 1, so one intersection a length finds them all.
    """
    ends = F.aggregate(
        lines, F.array(F.lit(0)),
        lambda acc, line: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(line) + 1)),
    )

    def between(e: Column, n: int) -> Column:
        starts = F.array_intersect(F.transform(e, lambda x: x + (n + 1)), e)
        return F.transform(starts, lambda x: F.struct((x - (n + 1)).alias("a"), x.alias("b")))

    def texts(e: Column) -> Column:
        found = F.concat(*[between(e, n) for n in lengths])
        first = lambda p: F.array_position(e, p["a"]).cast("int")
        several = F.filter(found, lambda p: F.array_position(e, p["b"]).cast("int") - first(p) > 1)
        return F.transform(several, lambda p: _whole(
            F.slice(lines, first(p), F.array_position(e, p["b"]).cast("int") - first(p))))

    return F.flatten(F.transform(F.array(ends), texts))


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """``license, length, several, digest`` of the canonical forms of the known texts.

    ``several``: whether the text has several lines.
    """
    texts = spark.createDataFrame(list(known), "license string, text string")
    lines = texts.select("license", canonical_lines(F.col("text")).alias("lines"))
    return lines.select(
        "license", _whole(F.col("lines")).alias("form"), (F.size("lines") > 1).alias("several")
    ).select(
        "license", F.length("form").alias("length"), "several", F.sha2("form", 256).alias("digest")
    ).distinct()


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known=KNOWN) -> DataFrame:
    """``id_col, digest, license, notices`` for every row of ``docs``.

    ``digest``: SHA-256 of the whole canonical text (of the empty string for null and
    empty texts). ``license``: the licence whose text it is, else null; the first in
    order where texts coincide. ``notices``: licences that some line names, or whose text a
    run of lines is where the whole text is none, sorted.
    Rows repeated with the same id and text are repeated in the result. Texts of equal
    id are told apart by digest; where that agrees too, they share their notices.
    """
    spark = docs.sparkSession
    digests = known_digests(spark, known)
    # A line or run of another length than the known forms has another digest.
    sizes = digests.select("length", "several").distinct().collect()
    lengths = sorted({r.length for r in sizes})
    longer = sorted({r.length for r in sizes if r.several})
    lines = docs.select(
        F.col(id_col).alias("_id"),
        canonical_lines(F.coalesce(F.col(text_col), F.lit(""))).alias("lines"),
    )
    digested = materialise(
        lines.select(
            "_id",
            F.sha2(_whole(F.col("lines")), 256).alias("_digest"),
            F.array_distinct(
                F.filter("lines", lambda line: F.length(line).isin(lengths))
            ).alias("singles"),
            F.array_distinct(_runs(F.col("lines"), longer)).alias("runs"),
        ),
        "license-lines",
    )
    digests = F.broadcast(digests.select("license", "digest").distinct())
    of_line = F.transform("singles", lambda x: F.struct(F.lit(True).alias("single"), x.alias("line")))
    of_run = F.transform("runs", lambda x: F.struct(F.lit(False).alias("single"), x.alias("line")))
    hits = (
        digested.select("_id", "_digest", F.explode(F.concat(of_line, of_run)).alias("u"))
        .select("_id", "_digest", "u.single", F.sha2("u.line", 256).alias("digest"))
        .join(digests, "digest")
        .groupBy("_id", "_digest")
        .agg(
            F.array_sort(F.collect_set("license")).alias("all"),
            F.array_sort(F.collect_set(F.when(F.col("single"), F.col("license")))).alias("of_lines"),
        )
    )
    whole = digests.groupBy("digest").agg(F.min("license").alias("license"))
    return (
        digested.select("_id", "_digest")
        .join(F.broadcast(whole), F.col("_digest") == F.col("digest"), "left")
        .drop("digest")
        .join(
            hits.select(F.col("_id").alias("_hit"), F.col("_digest").alias("_same"), "all", "of_lines"),
            F.expr("_id <=> _hit and _digest = _same"),
            "left",
        )
        .select(
            F.col("_id").alias(id_col),
            F.col("_digest").alias("digest"),
            "license",
            F.coalesce(
                F.when(F.col("license").isNull(), F.col("all")).otherwise(F.col("of_lines")),
                F.array().cast("array<string>"),
            ).alias("notices"),
        )
    )

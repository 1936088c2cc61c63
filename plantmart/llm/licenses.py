"""License scans: a text is a licence when its canonical form has the digest of a known licence text.

The canonical form lower-cases, drops copyright notices, evens out spellings, and turns punctuation and white space into single
spaces. Scanned units are the whole text, each of its lines, and runs of lines that have as many words as a known text and begin with its
first two. The known digests are a short literal table, so it is broadcast; the scan needs no exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query, table

# Known licence texts and notices.
MIT_BODY = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_BODY = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""
BSD_TERMS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution."""
BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission."""
BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING
IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ZLIB_BODY = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
UNLICENSE_BODY = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the
software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this
software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR
OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>"""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions
and limitations under the License."""
MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""


def _gnu_notice(thing: str, name: str, version: str, later: bool) -> str:
    """The notice that the GNU licences ask to put at the top of a file."""
    how = f"either version {version} of the License, or (at your option) any later version" if later else f"version {version} of the License"
    return (
        f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by "
        f"the Free Software Foundation, {how}.\n"
        f"This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        f"warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details.\n"
        f"You should have received a copy of the {name} along with this {thing}. If not, see <https://www.gnu.org/licenses/>."
    )


GNU = [("GPL", "program", "GNU General Public License", ("2", "3")), ("LGPL", "library", "GNU Lesser General Public License", ("2.1", "3")),
       ("AGPL", "program", "GNU Affero General Public License", ("3",))]
IDS = (
    "MIT ISC Apache-2.0 BSD-2-Clause BSD-3-Clause 0BSD Zlib Unlicense GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later "
    "LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0-only AGPL-3.0-or-later MPL-2.0 CC0-1.0 CC-BY-4.0 "
    "CC-BY-SA-4.0 CC-BY-NC-4.0 CC-BY-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-NC-ND-4.0"
).split()
KNOWN = [
    ("MIT", MIT_BODY),
    ("MIT", "MIT License\n" + MIT_BODY),
    ("MIT", "The MIT License (MIT)\n" + MIT_BODY),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", ISC_BODY),
    ("ISC", "ISC License\n" + ISC_BODY),
    ("BSD-2-Clause", BSD_TERMS + "\n" + BSD_DISCLAIMER),
    ("BSD-2-Clause", "BSD 2-Clause License\n" + BSD_TERMS + "\n" + BSD_DISCLAIMER),
    ("BSD-3-Clause", BSD_TERMS + "\n" + BSD_NAMES + "\n" + BSD_DISCLAIMER),
    ("BSD-3-Clause", "BSD 3-Clause License\n" + BSD_TERMS + "\n" + BSD_NAMES + "\n" + BSD_DISCLAIMER),
    ("Zlib", ZLIB_BODY),
    ("Zlib", "zlib License\n" + ZLIB_BODY),
    ("Unlicense", UNLICENSE_BODY),
    ("Apache-2.0", APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MPL-2.0", MPL_NOTICE),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    *((i, f"SPDX-License-Identifier: {i}") for i in IDS),
    *(
        (f"{short}-{version if '.' in version else version + '.0'}-{'or-later' if later else 'only'}", _gnu_notice(thing, name, version, later))
        for short, thing, name, versions in GNU for version in versions for later in (False, True)
    ),
]
# Equivalent spellings, as the form found and the form kept.
SPELLINGS = [("licence", "license"), ("sublicence", "sublicense"), ("organisation", "organization"), ("per cent", "percent"),
             ("copyright owner", "copyright holder"), ("noninfringement", "non infringement")]
# A notice is a line that begins with "copyright" and has a sign or a year, or with a sign, behind comment signs or none; licence texts say
# "copyright holders" too.
COPYRIGHT_LINE = (
    r"(?m)^[ \t#*/;%!.-]*(?:copyright\b[^\n]*(?:\(c\)|©|(?:19|20)[0-9]{2})[^\n]*|\(c\)[ \t]*[0-9]{4}[^\n]*|©[^\n]*)$"
    r"|all[ \t]+rights[ \t]+reserved"
)


def _spelled(form: Column) -> Column:
    for found, kept in SPELLINGS:
        form = F.replace(form, F.lit(found), F.lit(kept))
    return form


def canonical(text: Column) -> Column:
    """The canonical form of a text; null counts as empty."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, " ")
    return _spelled(F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " ")))


def _words(form: Column) -> Column:
    return F.size(F.split(form, " "))


def _head(form: Column) -> Column:
    """The first two words."""
    return F.substring_index(form, " ", 2)


def known_digests(spark: SparkSession, known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """``license_id``, ``digest``, number of words and first two words of each known text; one id for each digest."""
    rows = spark.createDataFrame(known, "license_id string, body string").select("license_id", canonical(F.col("body")).alias("form"))
    return rows.groupBy(F.md5("form").alias("digest")).agg(
        F.min("license_id").alias("license_id"), F.min(_words(F.col("form"))).alias("words"), F.min(_head(F.col("form"))).alias("head")
    )


def license_units(
    docs: DataFrame, known: DataFrame | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """A row for each unit that is a known licence: id, ``unit`` (0 the whole text, k from its k-th line on), ``license_id``, ``digest``.

    ``known`` is a table like that of ``known_digests``, which takes any list of texts. A null or empty text has no match, as an empty
    canonical form never counts. A text of one line matches as unit 0 and as unit 1. In a text that is a licence as a whole, runs of lines
    are not looked for; elsewhere a run has two lines or more, and lines without words, like notices, are passed over. Repeated rows give
    repeated matches; rows without id are scanned too. Other columns are not read.
    """
    known = known_digests(docs.sparkSession) if known is None else known
    # The known texts are a short table; so are the words they begin with.
    heads = sorted(r[0] for r in known.select("head").distinct().collect())
    longest = known.agg(F.max("words")).first()[0] or 0
    text = F.coalesce(F.col(text_column), F.lit(""))
    forms = F.transform(F.split(text, "\n"), lambda x, k: F.struct((k + 1).alias("unit"), canonical(x).alias("form")))
    held = docs.select(
        F.col(id_column).alias("id"), canonical(text).alias("whole"), F.filter(forms, lambda x: x["form"] != "").alias("lines")
    )
    short = F.broadcast(known.select("digest", "license_id"))
    one = F.array(F.struct(F.lit(0).alias("unit"), F.col("whole").alias("form")))
    units = held.select("id", F.inline(F.concat(one, "lines"))).where("form <> ''").select("id", "unit", F.md5("form").alias("digest"))
    single = units.join(short, "digest").select("id", "unit", "license_id", "digest")
    # Places where a known text may begin, each with the lines from there on; a line has one word at least.
    begins = F.filter(
        F.transform("lines", lambda x, k: F.when(_head(x["form"]).isin(heads), k + 1)), lambda k: k.isNotNull() & (k < F.size("lines"))
    )
    started = held.where((F.size("lines") > 1) & F.exists("lines", lambda x: _head(x["form"]).isin(heads))).join(
        short.select(F.col("digest").alias("__digest")), F.md5("whole") == F.col("__digest"), "left_anti"
    )
    started = started.select("id", "lines", F.explode(begins).alias("at"))
    started = started.select("id", F.slice("lines", F.col("at"), F.lit(longest)).alias("run"))
    tried = started.join(F.broadcast(known.withColumnRenamed("digest", "wanted")), _head(F.col("run")[0]["form"]) == F.col("head"))
    begun = F.struct(F.lit("").alias("form"), F.lit(0).alias("lines"))

    def longer(done: Column, line: Column) -> Column:
        """One more line, unless the run has its words."""
        enough = (done["lines"] > 0) & (_words(done["form"]) >= F.col("words"))
        form = F.when(done["lines"] == 0, line["form"]).otherwise(_spelled(F.concat_ws(" ", done["form"], line["form"])))
        return F.when(enough, done).otherwise(F.struct(form.alias("form"), (done["lines"] + 1).alias("lines")))

    found = tried.withColumn("found", F.aggregate("run", begun, longer))
    several = found.where((F.md5("found.form") == F.col("wanted")) & (F.col("found.lines") > 1))
    several = several.select("id", F.col("run")[0]["unit"].alias("unit"), "license_id", F.col("wanted").alias("digest"))
    return single.unionByName(several).select(F.col("id").alias(id_column), F.col("unit").cast("long").alias("unit"), "license_id", "digest")


def _sql() -> str:
    def spelled(out: str) -> str:
        for found, kept in SPELLINGS:
            out = f"replace({out}, '{found}', '{kept}')"
        return out

    def form(x: str) -> str:
        out = f"regexp_replace(lower(coalesce({x}, '')), '{COPYRIGHT_LINE}', ' ', 'g')"
        return spelled(f"trim(regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))".replace("\\\\", "\\"))

    words = lambda x: f"len(string_split({x}, ' '))"
    head = lambda x: f"array_to_string(string_split({x}, ' ')[1:2], ' ')"
    rows = ", ".join("('{}', '{}')".format(i, b.replace("'", "''")) for i, b in KNOWN)
    return f"""
    WITH known AS (SELECT md5(form) AS digest, min(id) AS license_id, min({words('form')}) AS words, min({head('form')}) AS head
                   FROM (SELECT id, {form('body')} AS form FROM (VALUES {rows}) v(id, body)) GROUP BY 1),
         docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
         units AS (SELECT r, doc_id, 0 AS unit, text AS body FROM docs
                   UNION ALL
                   SELECT r, doc_id, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS unit,
                          unnest(string_split(coalesce(text, ''), chr(10))) AS body FROM docs),
         forms AS (SELECT r, doc_id, unit, {form('body')} AS form FROM units),
         single AS (SELECT r, doc_id, unit, license_id, digest FROM forms JOIN known ON digest = md5(form) WHERE form <> ''),
         lines AS (SELECT r, doc_id, unit, form, row_number() OVER (PARTITION BY r ORDER BY unit) AS nth FROM forms
                   WHERE unit > 0 AND form <> '' AND r NOT IN (SELECT r FROM single WHERE unit = 0)),
         runs AS (SELECT s.r, s.doc_id, s.unit, s.nth AS first, l.nth AS last, k.digest, k.license_id, k.words,
                         {spelled("string_agg(l.form, ' ') OVER (PARTITION BY s.r, s.unit, k.digest ORDER BY l.nth)")} AS form
                  FROM lines s JOIN known k ON {head('s.form')} = k.head JOIN lines l ON l.r = s.r AND l.nth BETWEEN s.nth AND s.nth + k.words)
    SELECT doc_id, CAST(unit AS BIGINT) AS unit, license_id, digest FROM single
    UNION ALL
    SELECT doc_id, CAST(unit AS BIGINT), license_id, digest FROM runs WHERE last > first AND {words('form')} = words AND md5(form) = digest
    """


@query("op3_license_scans", _sql())
def op3_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return license_units(table(spark, folder, "documents"))

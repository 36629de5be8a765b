"""License scans by canonical digest lookup, with SQL functions only.

A unit of text is canonicalised: lines that state a copyright or reserve rights go, case and punctuation go, a first line
that is the title of a licence goes, equivalent spellings become one, white space becomes single spaces.  The
digest of what is left is hash-joined with the digests of known licence texts, canonicalised by the same expressions.
Units are the whole document, each of its lines (there a title stays), and each run of RUN paragraphs or fewer that has several
lines and is not the whole: lines of punctuation only, as in the frame of a comment, separate paragraphs as empty ones do.

The registry is texts and, for texts that are too long to print here, digests; folder() makes one of licence files.

Cases: null and empty texts, and texts whose canonical form is empty, match nothing; a document may
match several licences and a licence several times (n counts units); equal registry texts under two
ids give both ids; repeated rows of a document count together; texts are used whole; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table

BROADCAST_ROWS = 100_000  # of a registry, of which each is counted; a larger one is joined by shuffle
RUN = 6  # paragraphs of one unit

_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
_BSD_1 = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
_BSD_2 = (
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. "
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission. "
)
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
    "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS "
    "OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_END = (
    " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
    "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
    "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)

#: Public licence texts and the usual notices, by SPDX id.
REGISTRY: list[tuple[str, str]] = [
    ("MIT", _GRANT + "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
     "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
     "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS),
    ("BSD-2-Clause", _BSD + _BSD_1 + _BSD_2 + _BSD_END),
    ("BSD-3-Clause", _BSD + _BSD_1 + _BSD_2 + _BSD_3 + _BSD_END),
    ("BSD-2-Clause", _BSD + (_BSD_1 + _BSD_2).replace("1. ", "").replace("2. ", "") + _BSD_END),
    ("BSD-3-Clause", _BSD + (_BSD_1 + _BSD_2 + _BSD_3).replace("1. ", "").replace("2. ", "").replace("3. ", "") + _BSD_END),
    ("ISC", _ISC + ", provided that the above copyright notice and this permission notice appear in all copies." + _ISC_END),
    ("0BSD", _ISC + "." + _ISC_END),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "This project is licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a "
     "copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the "
     "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
     "language governing permissions and limitations under the License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
     "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be "
     "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License "
     "for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("GPL-2.0-only", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0-only", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0-only", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can "
     "obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

#: Equivalent spellings, after case and punctuation are gone.
SPELLINGS: list[tuple[str, str]] = [
    ("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("non infringement", "noninfringement"),
    ("share alike", "sharealike"), ("per cent", "percent"), ("copyright owner", "copyright holder"), ("merchantibility", "merchantability"),
    ("https", "http"), ("favour", "favor"), ("fulfil ", "fulfill "), ("honour", "honor"), ("labour", "labor"), ("organisation", "organization"),
    ("recognise", "recognize"), ("authorisation", "authorization"), ("authorise", "authorize"), ("acknowledgement", "acknowledgment"),
    ("artefact", "artifact"), ("whilst", "while"), ("wilful", "willful"), ("licencing", "licensing"), ("v 2 0", "version 2 0"), ("v2 0", "version 2 0"),
]

#: Full texts by SPDX id: digest and length of the canonical form.
DIGESTS: list[tuple[str, str, int]] = [
    ("Apache-2.0", "da8a765034a879d63277e9cfdf568aadafafea1c17a1c54df774d591d06e5b25", 8766),
    ("Apache-2.0", "2295e316b6e525a824b867463925b9336c159a244448c57e561e3a013db1ae5a", 8794),
    ("Apache-2.0", "905cb44fb0178cb947d66c0ea4aecab0b8eb3502ef89c93d6c1560d9cd8a7b91", 9810),
    ("Artistic-1.0-Perl", "09298ea5f55a44867296b42e98842579815a99e2b295c0aa24cf234134c9ebeb", 5812),
    ("CC0-1.0", "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e", 6691),
    ("GFDL-1.2-only", "2f75fa79b178d495a9ab6b69b82e5502c3cb2012aff01a5b63768646ace39d89", 19547),
    ("GFDL-1.3-only", "6a9067c2d89ede2254cdd38c447816cd552e2fae3ab5ad765750b3c78493c5df", 21981),
    ("GPL-1.0-only", "004d51305feee6b52152c2f281ce28deaeb53eb4a4d007ee76cd7a921214d66a", 9360),
    ("GPL-1.0-only", "ca8a13e258985f008e9e869c46b2f9ce910ff6e64682660c0130a3a2597b9056", 9388),
    ("GPL-1.0-only", "9132a605811c9f9a51621da0e0708f46e408e3507a3c1a9d16a5f48291082b8c", 11738),
    ("GPL-2.0-only", "639c69262acf6777ee0c163867caf39bdb5ec90b59bad9412c9e6101fb65e404", 14428),
    ("GPL-2.0-only", "b519669ce969d79c162f16dca67a0abab53b46986efb528afe3e105936cc0050", 14456),
    ("GPL-2.0-only", "29507662ad31f55a5ac02f26a5d8cca21add440b2dff4a9ce97e458a0ca43f7f", 17090),
    ("GPL-3.0-only", "888dd3b6e21b31412e3e47000b49d18dbd8f52fb42ccb5fc3108c8ca3c150b16", 30913),
    ("GPL-3.0-only", "7649ebbf3b070f38d710d6c6b656cbe1d02e00991423dedb73cb040e73d42572", 30941),
    ("GPL-3.0-only", "bf9e206799496404ec781ceaf777966308e875445239b2a25248b6a0f817844d", 33379),
    ("LGPL-2.0-only", "9c23d4ec08c96de18510022fc734a8ee0a97727299d09046fc5ce263d269352e", 22214),
    ("LGPL-2.0-only", "1bcddbd821db9aff439d7cd0cc29582bde4192194dead3bbf1218f38ca99554f", 22242),
    ("LGPL-2.0-only", "f17ebefdba4ae01060494f3396c1bc854578b6eaafaa6fe8abcf7a94e7fc2a6e", 24095),
    ("LGPL-2.1-only", "02d1c6765d5d7d83c080934e4f4d4e8a534db157a3addff8d581f70e285a297a", 23303),
    ("LGPL-2.1-only", "1b0f2373f80527d4e0de3c4558c0b3804f46c844770e82398a9876c782f360f9", 23331),
    ("LGPL-2.1-only", "50866b22e296e073a398813dc84c4c9dec94ed1ee7d617c063eb6851a562b9d4", 25183),
    ("LGPL-3.0-only", "e1c7b25e9116bcad127297bbfb82e6a89822822ba6bfa3af9eae995aad877765", 7070),
    ("MPL-1.1", "cbfc00b9f88d8b5c99c2b680632d93a36e40c29744dea389252791b72d254d66", 22316),
    ("MPL-2.0", "59f4f179a6364feb62413164893f95ba482263f14cb4ec49ff8b840cca4c7767", 14249),
]

# The same patterns serve Java and RE2 regular expressions; they see lower case.  A line that begins with copyright is a
# notice if it has a mark, a year or authors: licences have lines that begin with copyright holder.
COPYRIGHT_LINES = r"(^|\n)[ \t*#/;-]*(copyright:|copyright[ \t]*(\(c\)|©)|copyright[ \t][^\n]*([0-9]{4}|yyyy|<year>|authors)|\(c\)[ \t]|©|all rights reserved)[^\n]*"
COPYRIGHT_HINTS = ("copyright", "(c)", "©", "all rights reserved")
DROPPED = r"[^a-z0-9\n\x{80}-\x{10FFFF}]+"
# A title before something else, in a cleaned text.
TITLE = r"^[ \n]*(?:[a-z0-9]+ ){0,7}licen[cs]e(?: [a-z0-9]+){0,3} *\n([ \n]*[^ \n])"
PARAGRAPHS = r"\n[ \n]*\n"
SEVERAL_LINES = r"[^ \n] *\n *[^ \n]"
# No spelling makes a form longer or shorter than this.
STRETCH = 3


def cleaned(low: Column) -> Column:
    """A text in lower case without copyright lines and punctuation; line breaks stay."""
    hinted = F.lit(False)
    for hint in COPYRIGHT_HINTS:
        hinted = hinted | F.contains(low, F.lit(hint))
    return F.regexp_replace(F.when(hinted, F.regexp_replace(low, COPYRIGHT_LINES, "\n")).otherwise(low), DROPPED, " ")


def untitled(text: Column) -> Column:
    """A cleaned text without its title."""
    return F.regexp_replace(text, TITLE, "$1")


def squeezed(text: Column) -> Column:
    """A cleaned text as one line."""
    return F.trim(F.regexp_replace(text, "[ \n]+", " "))


def spelled(form: Column) -> Column:
    """A squeezed text with equivalent spellings made one."""
    out = F.concat(F.lit(" "), form, F.lit(" "))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.trim(out)


def registry(spark: SparkSession, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """(license_id, digest, length) of the texts, or of REGISTRY and DIGESTS."""
    rows = spark.createDataFrame(REGISTRY if texts is None else texts, "license_id string, text string")
    if texts is not None:
        return digests_of(rows)
    return digests_of(rows).unionByName(spark.createDataFrame(DIGESTS, "license_id string, digest string, length int")).distinct()


def folder(spark: SparkSession, path: str) -> DataFrame:
    """(license_id, digest, length) of a folder of licence texts, each named by its id, with or without .txt."""
    files = spark.read.text(path, wholetext=True).select(F.col("value").alias("text"), F.regexp_replace(F.element_at(F.split("_metadata.file_path", "/"), -1), "[.]txt$", "").alias("license_id"))
    return digests_of(files)


def digests_of(texts: DataFrame) -> DataFrame:
    """(license_id, digest, length) of a table (license_id, text)."""
    form = texts.select("license_id", spelled(squeezed(untitled(cleaned(F.lower("text"))))).alias("form")).where("form <> ''")
    return form.select("license_id", F.sha2("form", 256).alias("digest"), F.length("form").alias("length")).distinct()


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text: str = "text", small: bool | None = None) -> DataFrame:
    """(doc_id, license_id, scope, n): units of docs whose canonical digest is a known one; scope is 'document' (the whole
    text), 'line' or 'block' (a run of paragraphs).  A one-line text is a document unit and a line unit.  small tells
    whether known may be broadcast; if it is None, known is counted."""
    least, most, n = known.agg(F.min("length"), F.max("length"), F.count("*")).first()
    small = n <= BROADCAST_ROWS if small is None else small
    # What is used several times is a column of its own, and so is made once.
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.lower(F.col(text).cast("string")).alias("low")).where("low is not null")
    rows = rows.select("doc_id", cleaned(F.col("low")).alias("text"))
    rows = rows.withColumn("body", untitled(F.col("text")))
    part = F.transform(F.split("body", PARAGRAPHS, -1), lambda x: F.struct(squeezed(x).alias("form"), squeezed(untitled(x)).alias("bare"), x.rlike(SEVERAL_LINES).alias("several")))
    rows = rows.withColumn("parts", F.when(F.col("body").rlike(PARAGRAPHS), F.filter(part, lambda x: x["form"] != "")).otherwise(F.array().cast("array<struct<form:string,bare:string,several:boolean>>")))
    runs = F.expr(f"""if(size(parts) < 2, cast(array() as array<string>), flatten(transform(sequence(1, size(parts)), i ->
      transform(sequence(1, least({RUN}, size(parts) - i + 1)), k -> if(k = size(parts) or (k = 1 and not parts[i - 1].several), '',
        concat_ws(' ', parts[i - 1].bare, transform(slice(parts, i + 1, k - 1), x -> x.form)))))))""")
    # Digests are taken only of forms that have a known text's length, give or take what spellings change.
    fits = lambda x: F.length(x).between((least or 1) // STRETCH, (most or 0) * STRETCH)
    named = lambda xs, scope: F.transform(F.filter(xs, fits), lambda x: F.struct(F.lit(scope).alias("scope"), x.alias("form")))
    lines = F.transform(F.split("text", "\n", -1), lambda x: F.trim(x))
    units = F.concat(named(F.array(squeezed(F.col("body"))), "document"), named(lines, "line"), named(runs, "block"))
    units = rows.select("doc_id", F.explode(units).alias("unit")).select("doc_id", "unit.scope", F.sha2(spelled(F.col("unit.form")), 256).alias("digest"))
    known = known.select("license_id", "digest")
    found = units.join(F.broadcast(known) if small else known, "digest")
    return found.groupBy("doc_id", "license_id", "scope").agg(F.count("*").alias("n"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences stated by whole documents, by lines and by runs of paragraphs."""
    return scan(table(spark, sf_dir, "documents"), registry(spark))


def op3_sql() -> str:
    """The scan in DuckDB SQL."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    clean = f"regexp_replace(regexp_replace(lower(text), {quoted(COPYRIGHT_LINES)}, chr(10), 'g'), {quoted(DROPPED)}, ' ', 'g')"
    bare = lambda x: f"regexp_replace({x}, {quoted(TITLE)}, '\\1')"
    squeeze = lambda x: f"trim(regexp_replace({x}, '[ ' || chr(10) || ']+', ' ', 'g'))"
    digest = "' ' || form || ' '"
    for old, new in SPELLINGS:
        digest = f"replace({digest}, {quoted(old)}, {quoted(new)})"
    texts = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in REGISTRY)
    full = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b, _ in DIGESTS)
    return f"""
WITH known AS (
  SELECT license_id, sha256(trim({digest})) AS digest FROM (SELECT license_id, {squeeze(bare(clean))} AS form FROM (VALUES {texts}) AS k(license_id, text))
  UNION SELECT * FROM (VALUES {full}) AS d(license_id, digest)
),
docs AS (SELECT doc_id, {clean} AS text, {bare(clean)} AS body FROM documents WHERE text IS NOT NULL),
parts AS (
  SELECT doc_id, list_filter(regexp_split_to_array(body, {quoted(PARAGRAPHS)}), lambda x: {squeeze("x")} <> '') AS ps FROM docs
),
starts AS (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM parts WHERE len(ps) > 1),
runs AS (SELECT doc_id, ps, i, unnest(range(1, least({RUN}, len(ps) - i + 1) + 1)) AS k FROM starts),
units AS (
  SELECT doc_id, 'document' AS scope, {squeeze("body")} AS form FROM docs
  UNION ALL
  SELECT doc_id, 'line', trim(unnest(string_split(text, chr(10)))) FROM docs
  UNION ALL
  SELECT doc_id, 'block', {squeeze(bare("ps[i]") + " || ' ' || array_to_string(ps[i + 1:i + k - 1], ' ')")} FROM runs
  WHERE k < len(ps) AND (k > 1 OR regexp_matches(ps[i], {quoted(SEVERAL_LINES)}))
)
SELECT doc_id, license_id, scope, count(*) AS n
FROM (SELECT doc_id, scope, sha256(trim({digest})) AS digest FROM units) JOIN known USING (digest)
GROUP BY doc_id, license_id, scope"""

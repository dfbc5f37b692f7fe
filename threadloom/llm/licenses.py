"""Licence texts found by the digest of their canonical form; DataFrame functions only."""

from __future__ import annotations

from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialize
from .frames import chosen

# Public licence texts and notices, as their authors publish them, without the copyright lines.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software.\n\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
    "SOFTWARE."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted"
)
_ISC_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies"
_ISC_REST = (
    '.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n\n"
)
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
LICENCES = (
    ("MIT", _MIT_GRANT),
    ("MIT", "The MIT License\n\n" + _MIT_GRANT),
    ("MIT", "MIT License\n\n" + _MIT_GRANT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", _ISC_GRANT + _ISC_NOTICE + _ISC_REST),
    ("0BSD", _ISC_GRANT + _ISC_REST),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_NAMES + _BSD_TAIL),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\n"
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        'on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
)
#: Whole texts beside this module, one file per licence, named by its SPDX id.
TEXTS = "license_texts"
#: Lines after which a licence only says how to apply it; texts are listed with and without what follows.
_LAST_LINES = ("END OF TERMS AND CONDITIONS", "ADDENDUM: How to use this License for your documents", "Exhibit A - ", "EXHIBIT A -")
# Spellings that say the same in a licence, British to American as in the SPDX matching guidelines.
SPELLINGS = (
    ("licence", "license"), ("organisation", "organization"), ("authoris", "authoriz"), ("favour", "favor"),
    ("sub license", "sublicense"), ("non infringement", "noninfringement"), ("non commercial", "noncommercial"),
    ("whilst", "while"), ("per cent", "percent"), ("copyright owner", "copyright holder"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A line that only names the holder: comment marks, the word or sign, then a year or the sign or a name after "by".
COPYRIGHT_LINE = r"(?m)^[ \t*#/;-]*((copyright[ \t]+)?(\(c\)|©)|copyright[ \t]+([0-9]|by[ \t]))[^\n]*$"
RESERVED_LINE = r"(?m)^[ \t*#/;-]*all rights reserved\.?[ \t\r]*$"
MARKS = r"[\x01-\x2F\x3A-\x60\x7B-\x7F]+"
# What follows on lines of a licence that happen to begin with "copyright" or "(c)", as a text may be wrapped anywhere.
_WORDING = (
    "licen[cs]e|permi|notice|warrant|liab|provided|redistribut|holder|owner|law|treat|statement|infring|disclaim|interest|"
    "doctrine|prohibit|program|software"
)
_NEXT = "(?:and|or|on|in|to|of|if|is|are|the|for|as|that|under|resulting|you|your|any|must|may|accompany|state|convey)\\b"
#: Lines that name a holder, in lower case: with a sign or year as above, or without, if they have no words of a licence.
HOLDER_LINE = (
    r"(?m)^[^\p{L}\p{N}\n(©]*(?:(?:copyright[^\p{L}\p{N}\n(©]*)?©|copyright[^\p{L}\p{N}\n(]*\(c\)|copyright[^\p{L}\p{N}\n]+(?:[0-9]|by\s)"
    r"|\(c\)[^\n]*[0-9]{4}|(?:copyright[^\p{L}\p{N}\n]+|\(c\)[^\p{L}\p{N}\n]*)(?=[\p{L}\p{N}])(?!" + _NEXT + r")(?![^\n]*(?:" + _WORDING + r")))[^\n]*$"
)
HOLDER_RESERVED = r"(?m)^[^\p{L}\p{N}\n]*all rights reserved[^\p{L}\p{N}\n]*$"
NO_WORD = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """Lower case A-Z, no copyright lines, one space for each run of marks and white space, one spelling."""
    out = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    out = F.regexp_replace(out, COPYRIGHT_LINE, " ")
    out = F.regexp_replace(out, RESERVED_LINE, " ")
    out = F.regexp_replace(out, MARKS, " ")
    for one, other in SPELLINGS:
        out = F.replace(out, F.lit(one), F.lit(other))
    return F.trim(out)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def plain(text: Column) -> Column:
    """``canonical`` for any script: lower case, no holder lines, one space for each run of other than letters and digits."""
    out = F.lower(F.coalesce(text, F.lit("")))
    out = F.regexp_replace(out, HOLDER_LINE, " ")
    out = F.regexp_replace(out, HOLDER_RESERVED, " ")
    out = F.regexp_replace(out, NO_WORD, " ")
    for one, other in SPELLINGS:
        out = F.replace(out, F.lit(one), F.lit(other))
    return F.trim(out)


def key(text: Column) -> Column:
    """What licences are joined by. Not nullable, as a join would else compute it twice."""
    return F.coalesce(F.sha2(plain(text), 256), F.lit(""))


def head(text: Column) -> Column:
    """Up to three letters or digits that a line begins with; ``plain`` keeps them, as ``SPELLINGS`` change later ones only."""
    return F.regexp_extract(F.lower(F.coalesce(text, F.lit(""))), r"[\p{L}\p{N}]{1,3}", 0)


def whole_texts() -> list[tuple[str, str]]:
    """(license, text) of the files in ``TEXTS``: whole, without the closing remarks, and each of these as one line."""
    out = []
    for file in sorted(files(__package__).joinpath(TEXTS).iterdir(), key=lambda f: f.name):
        text = file.read_text(encoding="utf-8")
        forms = [text]
        for mark in _LAST_LINES:
            if (at := text.rfind(mark)) > 0:
                forms += [text[:at], text[: at + len(mark)]]
        out += [(file.name.removesuffix(".txt"), form) for one in forms for form in (one, " ".join(one.split()))]
    return out


def default_licences(spark: SparkSession) -> DataFrame:
    """``license`` and ``text`` of the texts and notices in this module and of the whole texts beside it."""
    pairs = [*LICENCES, *whole_texts()]
    rows = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(text).alias("text")) for name, text in pairs])
    return spark.range(1).select(F.inline(rows))


def known(licences: DataFrame) -> DataFrame:
    """``license`` and ``__key``, one row per distinct plain text, and its ``__head``, of a table of ``license`` and ``text``."""
    listed = licences.select("license", key(F.col("text")).alias("__key"), head(plain(F.col("text"))).alias("__head"))
    return listed.where("__head <> ''").groupBy("__key", "__head").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", licences: DataFrame | None = None) -> DataFrame:
    """Each document with the digest of its whole text, the licence that it is, and the notices among its lines.

    ``digest`` is of the ``canonical`` text; licences are found by the digest of the ``plain`` one, in which
    typographic marks and any holder line go too.

    ``license`` is null if the whole text is no known licence. ``notices`` are the
    distinct licences, in order and joined by commas, whose text is a whole line of the
    document, else an empty string. ``licences`` is a table of ``license`` and ``text``, by
    default ``default_licences``; a licence may have many texts, and one text of several licences
    counts for the first by name. Spark joins their digests by the size that they have. Only lines that match are grouped.

    A null or empty text has the digest of an empty text and no licence. Rows that repeat, or share an id or have
    none, each get the notices of their own text. An empty table gives none.
    """
    # Notices depend on the text alone, so rows meet them by their text, whatever their ids.
    body = [F.xxhash64("text").alias("__h1"), F.xxhash64(F.lit("2"), "text").alias("__h2")]
    rows = chosen(docs, doc_id=doc_id, text=text)
    listed = materialize(known(default_licences(docs.sparkSession) if licences is None else licences), "licences")
    table = listed.drop("__head")
    lines = rows.select(*body, F.explode(F.split("text", "\n")).alias("__line"))
    # A line can only match if it begins as a listed text does.
    lines = lines.withColumn("__head", head(F.col("__line"))).join(listed.select("__head").distinct(), "__head", "left_semi")
    lines = lines.select("__h1", "__h2", key(F.col("__line")).alias("__key"))
    notices = lines.join(table, "__key").groupBy("__h1", "__h2").agg(
        F.array_join(F.sort_array(F.collect_set("license")), ",").alias("notices")
    )
    whole = rows.select("doc_id", *body, digest(F.col("text")).alias("digest"), key(F.col("text")).alias("__key")).join(table, "__key", "left")
    return whole.join(notices, ["__h1", "__h2"], "left").select("doc_id", "digest", "license", F.coalesce("notices", F.lit("")).alias("notices"))


def sql(table: str = "documents") -> str:
    """The result in DuckDB's SQL, by ``canonical`` and ``LICENCES`` alone: it lacks what ``plain`` and ``whole_texts`` find."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"

    def normal(x: str) -> str:
        out = f"translate(coalesce({x}, ''), '{_UPPER}', '{_LOWER}')"
        for pattern in (COPYRIGHT_LINE, RESERVED_LINE, MARKS):
            out = f"regexp_replace({out}, {quote(pattern)}, ' ', 'g')"
        for one, other in SPELLINGS:
            out = f"replace({out}, {quote(one)}, {quote(other)})"
        return f"sha256(trim({out}))"

    values = ", ".join(f"({quote(name)}, {quote(text)})" for name, text in LICENCES)
    return f"""
WITH listed AS (SELECT {normal("t")} AS digest, min(l) AS license FROM (VALUES {values}) v(l, t) GROUP BY 1),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM {table}),
matched AS (
    SELECT doc_id, array_to_string(list_sort(list_distinct(list(license))), ',') AS notices
    FROM (SELECT doc_id, {normal("line")} AS digest FROM lines) JOIN listed USING (digest) GROUP BY doc_id
),
whole AS (SELECT doc_id, {normal("text")} AS digest FROM {table})
SELECT w.doc_id, w.digest, l.license, coalesce(m.notices, '') AS notices
FROM whole w LEFT JOIN listed l USING (digest) LEFT JOIN matched m ON w.doc_id IS NOT DISTINCT FROM m.doc_id"""

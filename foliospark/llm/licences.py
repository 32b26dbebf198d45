"""Licence scan by canonical digests.

A text is canonical once its copyright lines are gone, equivalent spellings are one, and only lower-case words remain. Texts
with the same canonical SHA-256 are the same licence. Whole documents and each of their lines are looked up by one hash join with
the digests of known licence texts and notices. So is, wherever the first words of a known text stand in a document, the run of words of its
length that begins there, whatever the lines around it: a licence inside other text is found wherever it stands.
"""

from __future__ import annotations

from functools import reduce
from itertools import groupby
from math import prod

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.session import spread, table, written

#: Spellings that count as equal, (pattern, replacement), applied in this order to lower-case words with a space before and after each.
SPELLINGS = (
    ("licence", "license"),
    ("authoris", "authoriz"),
    ("organis", "organiz"),
    ("acknowledgement", "acknowledgment"),
    (" copyright holder", " copyright owner"),
    (" sub license", " sublicense"),
    (" non infringement", " noninfringement"),
    (" per cent ", " percent "),
    ("merchantibility", "merchantability"),
    (" version 3 0 ", " version 3 "),
    (" version 2 0 ", " version 2 "),
    (" by nc ", " bync "),
    (" http ", " https "),
)

_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A '
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
#: Short licence texts, (identifier, text).
TEXTS = (
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + _BSD_3 + _BSD_END),
    ("reserved", "All rights reserved."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        'above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL '
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
        "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS "
        'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY '
        "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
        "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising "
        "from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must "
        "not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be "
        "appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
        "software. 3. This notice may not be removed or altered from any source distribution.",
    ),
)
#: Longer licence texts by digest, (identifier, first words, characters, SHA-256), all of the canonical text as published.
DIGESTS = (
    ("Apache-2.0", "apache license version 2 january 2004 https www", 9918, "d96b1c6abc4537758bc436c48bafba5e878c63d6f2dee31d22bb444ce2bcc13f"),
    ("Artistic-1.0-Perl", "the artistic license preamble the intent of this", 5823, "bc4d0c00d493021b9f3b1041689fa28b4bf980cf2e37601f7cb475a7265e3b93"),
    ("CC0-1.0", "creative commons legal code cc0 1 0 universal", 6691, "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e"),
    ("GFDL-1.2", "gnu free documentation license version 1 2 november", 19577, "dc0a69dd77c36ecefaab939fe6f1fe20d430b27b4bba90820623760aadc9d0be"),
    ("GFDL-1.3", "gnu free documentation license version 1 3 3", 22007, "f63115b17c1c179670bd2984927f637d14545c9ad5ef5b33ab30f5073f67a635"),
    ("GPL-1.0", "gnu general public license version 1 february 1989", 11762, "37f380f152339f34a15db620545eb53f0b5c7d9e6a9542aa09ed0d22f186920f"),
    ("GPL-2.0", "gnu general public license version 2 june 1991", 17113, "ae2be2aaa68f5e52ef402874fc8c7c691879b445cb12e49d84f88168cc2d7dd6"),
    ("GPL-3.0", "gnu general public license version 3 29 june", 33398, "42de4913c0ec220db6e274a84efcdc7a52715762d22943334032232048072bc1"),
    ("LGPL-2.0", "gnu library general public license version 2 june", 24126, "bea988245c65edbddad6f43ff12ca2472c232324e916d42648b90eac944d833e"),
    ("LGPL-2.1", "gnu lesser general public license version 2 1", 25213, "ed875dac9045cba09a17867210991f3a4a82f80b82096b054560a3a8dae9d692"),
    ("LGPL-3.0", "gnu lesser general public license version 3 29", 7104, "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "mozilla public license version 1 1 1 definitions", 22468, "3f0343dd4f3b064be36e0c6584737c9b7bb5c322721694563f9009e088ce96d1"),
    ("MPL-2.0", "mozilla public license version 2 1 definitions 1", 14336, "ccb2452a3828a0c9f754214e184af2652be8efce4805cb9838cd64e558fcb9ef"),
)
#: Names by which notices call licences, by identifier.
NAMES = {
    "MIT": ("MIT License", "MIT"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL version 2", "GPL-2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL version 3", "GPL-3.0"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "LGPL-2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPL-3.0"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPL-3.0"),
    "BSD-2-Clause": ("2-Clause BSD License", "BSD 2-Clause License", "BSD-2-Clause"),
    "BSD-3-Clause": ("3-Clause BSD License", "BSD 3-Clause License", "BSD-3-Clause"),
    "ISC": ("ISC License", "ISC"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0"),
    "EPL-2.0": ("Eclipse Public License, version 2.0", "Eclipse Public License 2.0", "EPL-2.0"),
    "BSL-1.0": ("Boost Software License, Version 1.0", "BSL-1.0"),
    "Unlicense": ("Unlicense",),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "CC0-1.0"),
    **{f"CC-{x.replace(' ', '-')}-{v}": (f"CC {x} {v}", f"CC-{x.replace(' ', '-')}-{v}", f"Creative Commons {x} {v}") for x in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND") for v in ("3.0", "4.0")},
}
#: How notices name a licence.
NOTICES = ("Licensed under the {}.", "Licensed under {}.", "Released under the {}.", "Released under {}.", "Distributed under the {}.", "This work is licensed under the {}.", "This work is licensed under {}.", "This project is licensed under the {}.", "This software is licensed under the {}.", "SPDX-License-Identifier: {}", "License: {}")
#: A line that is a copyright statement: the word or a sign of it, and a sign, a year, a colon or "by" after the word. Other lines that begin with the word are text.
COPYRIGHT_LINE = r"(?im)^[ \t]*(?:copyright[ \t]*(?:\(c\)|©|:|[0-9]{4}|by[ \t])|\(c\)[ \t]*(?:copyright|[0-9]{4})|©)[^\n]*\n?"
ANCHOR = 8  # words with which a longer known text begins, and by which its places are found; shorter ones are looked up as whole lines
NOT_WORD = r"[^a-z0-9\n]+"
NOT_WORD_JAVA = r"[\x00-\x09\x0b-/:-`{-\x{10ffff}]+"  # the same characters: Java takes six times as long over a negated class with a line end in it
#: No text gets shorter by SPELLINGS than this share of itself, with a space at either end: each of them in turn shortens by its own share at most.
SHORTEST = prod(min(1.0, len(new) / len(old)) for old, new in SPELLINGS)
#: The texts and every notice of every name.
KNOWN = (*TEXTS, *((k, n.format(name)) for k, names in NAMES.items() for name in names for n in NOTICES))


def words_of(text: Column) -> Column:
    """The text's lines without copyright lines, each of lower-case ASCII words and digits with single spaces between them and none at the ends."""
    words = F.regexp_replace(F.lower(F.regexp_replace(text, COPYRIGHT_LINE, "")), NOT_WORD_JAVA, " ")
    return F.trim(F.regexp_replace(words, " *\n *", "\n"))


def spelled(words: Column) -> Column:
    """Words in a row with equal spellings made one."""
    padded = F.concat(F.lit(" "), F.regexp_replace(words, "\n+", " "), F.lit(" "))
    return F.trim(reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, padded))


def canonical(text: Column) -> Column:
    """Copyright lines removed, lower-case ASCII words and digits joined by single spaces, equal spellings made one; null stays null."""
    return spelled(words_of(text))


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN, digests: tuple[tuple[str, str, int, str], ...] = DIGESTS) -> DataFrame:
    """(digest, licence, anchor, n_chars) of the known texts: one row a digest, however often it is listed. anchor: the first ANCHOR words of a text that has more, else null; n_chars: of the canonical text."""
    rows = spark.createDataFrame(list(known), "licence string, text string").withColumn("c", canonical(F.col("text")))
    words = F.split("c", " ")
    anchor = F.when(F.size(words) > ANCHOR, F.array_join(F.slice(words, 1, ANCHOR), " "))
    own = rows.select(F.sha2("c", 256).alias("digest"), "licence", anchor.alias("anchor"), F.length("c").cast("long").alias("n_chars"))
    if digests:
        own = own.unionByName(spark.createDataFrame([(d, k, a, n) for k, a, n, d in digests], own.schema))
    return own.groupBy("digest").agg(F.min("licence").alias("licence"), F.min("anchor").alias("anchor"), F.min("n_chars").alias("n_chars"))


def _any_of(phrases: list[list[str]]) -> str:
    """A pattern of any of the phrases, all of as many words; what begins alike is tried once."""
    heads = groupby(sorted(phrases), key=lambda p: p[0])
    return "(?:" + "|".join(w + (" " + _any_of([p[1:] for p in rest]) if len(phrases[0]) > 1 else "") for w, rest in heads) + ")"


def _standing(padded: Column, anchors: list[str]) -> Column:
    """The anchors that stand in a canonical text with a space before and after, each once. Anchors of as many words can't begin at the same place."""
    split = sorted((a.split(" ") for a in set(anchors)), key=len)
    found = [F.regexp_extract_all(padded, F.lit(f" (?=({_any_of([*same])}) )"), F.lit(1)) for _, same in groupby(split, key=len)]
    return F.array_distinct(F.concat(*found)) if found else F.array().cast("array<string>")


def scan_licences(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, digest (of the whole canonical text), licence (of the whole text, or null), line_licences (sorted, distinct) and n_lines for every row.

    known: (digest, licence, anchor, n_chars), one row a digest. The whole text and each line are hash-joined with it by their digests, and so is
    each run of words that begins with the anchor of a known text and has its length; n_lines counts the lines and runs found, a line that is a whole longer text once. A
    null text has a null digest and no licences; a text without ASCII words has the digest of the empty string and matches nothing. Rows that repeat a
    doc_id share what they hold. A null doc_id has no lines. Other columns of docs are ignored. Texts are read and made canonical once, into a table of ids and digests,
    of lines that can be a known one by their length; only texts in which an anchor stands are kept there, and ids and digests alone are shuffled. The driver sees the anchors and lengths of the known texts, not of documents.
    """
    known = known.filter(F.col("digest") != F.sha2(F.lit(""), 256))
    lengths = known.select("anchor", "n_chars").distinct().collect()
    longest = max((r["n_chars"] for r in lengths if r["anchor"] is None), default=-2)
    most = int((longest + 2) / SHORTEST) - 2  # characters of a line before its spellings
    size = F.octet_length  # all is ASCII
    lines = F.filter(F.split("words", "\n"), lambda x: (size(x) > 0) & (size(x) <= most))
    words = docs.select("doc_id", words_of(F.col("text")).alias("words")).select("doc_id", spelled(F.col("words")).alias("canon"), lines.alias("lines"))
    padded = F.concat(F.lit(" "), "canon", F.lit(" "))
    seen = words.select("doc_id", "canon", "lines", _standing(padded, [r["anchor"] for r in lengths if r["anchor"] is not None]).alias("anchors"))
    digests = F.transform("lines", lambda x: F.sha2(spelled(x), 256))
    texts = written(seen.select("doc_id", F.sha2("canon", 256).alias("digest"), digests.alias("lines"), "anchors", F.when(F.size("anchors") > 0, padded).alias("canon")), "licence-texts")
    whole = texts.select("doc_id", "digest").join(known.select("digest", "licence"), "digest", "left")
    named = texts.filter("doc_id is not null")
    pieces = named.select("doc_id", F.explode("lines").alias("digest"), F.lit(True).alias("line"))
    starts = F.broadcast(known.filter("anchor is not null").select("anchor", F.col("n_chars").cast("int").alias("n")).distinct())
    near = named.filter("canon is not null").select("doc_id", "canon", F.explode("anchors").alias("anchor"))
    gaps = F.split("canon", F.concat(F.lit(" "), F.col("anchor"), F.lit("(?= )")))
    place = F.aggregate("gaps", F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("all")), lambda acc, g: F.struct((acc["at"] + F.length(g) + 1 + F.length("anchor")).alias("at"), F.concat(acc["all"], F.array(acc["at"] + F.length(g) + 1)).alias("all")))
    at = near.withColumn("gaps", gaps).withColumn("at", F.explode(F.slice(place["all"], 1, F.size("gaps") - 1))).join(starts, "anchor")
    ends = F.substr("canon", F.col("at") + F.col("n"), F.lit(1)) == " "
    pieces = pieces.unionByName(at.filter(ends).select("doc_id", F.sha2(F.substr("canon", "at", "n"), 256).alias("digest"), F.lit(False).alias("line")))
    hits = pieces.join(known.select("digest", "licence", F.col("anchor").isNull().alias("short")), "digest").filter("line = short").groupBy("doc_id").agg(F.array_sort(F.collect_set("licence")).alias("line_licences"), F.count("*").alias("n_lines"))
    none = F.array().cast("array<string>")
    out = whole.join(hits, "doc_id", "left")
    return out.select("doc_id", "digest", "licence", F.coalesce("line_licences", none).alias("line_licences"), F.coalesce("n_lines", F.lit(0)).alias("n_lines"))


def _oracle() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"

    def words(c: str) -> str:
        return f"trim(regexp_replace(regexp_replace(lower(regexp_replace({c}, {quoted(COPYRIGHT_LINE)}, '', 'g')), {quoted(NOT_WORD)}, ' ', 'g'), ' *\n *', chr(10), 'g'))"

    def spelt(c: str) -> str:
        out = f"' ' || regexp_replace({c}, '\n+', ' ', 'g') || ' '"
        for old, new in SPELLINGS:
            out = f"replace({out}, {quoted(old)}, {quoted(new)})"
        return f"trim({out})"

    values = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in KNOWN)
    more = ", ".join(f"({quoted(d)}, {quoted(k)}, {quoted(a)}, {n})" for k, a, n, d in DIGESTS)
    return f"""
WITH texts AS MATERIALIZED (SELECT n, {spelt(words("t"))} AS c FROM (VALUES {values}) v(n, t)),
known AS MATERIALIZED (SELECT digest, min(licence) AS licence, min(anchor) AS anchor, min(n_chars) AS n_chars FROM (
  SELECT sha256(c) AS digest, n AS licence, CASE WHEN len(string_split(c, ' ')) > {ANCHOR} THEN array_to_string(list_slice(string_split(c, ' '), 1, {ANCHOR}), ' ') END AS anchor, length(c) AS n_chars FROM texts UNION ALL SELECT * FROM (VALUES {more})) GROUP BY digest),
w AS MATERIALIZED (SELECT doc_id, w, {spelt("w")} AS c FROM (SELECT doc_id, {words("text")} AS w FROM documents)),
whole AS (SELECT doc_id, sha256(c) AS digest FROM w),
lines AS (SELECT doc_id, sha256({spelt("p")}) AS digest FROM (SELECT doc_id, unnest(string_split(w, chr(10))) AS p FROM w) WHERE p <> ''),
near AS (SELECT doc_id, string_split(c, ' ') AS s, anchor, n_chars FROM w JOIN (SELECT DISTINCT anchor, n_chars FROM known WHERE anchor IS NOT NULL) k ON contains(' ' || c || ' ', ' ' || anchor || ' ')),
runs AS (SELECT doc_id, array_to_string(list_slice(s, i, len(s)), ' ') || ' ' AS r, n_chars FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM near) WHERE array_to_string(list_slice(s, i, i + {ANCHOR - 1}), ' ') = anchor),
hits AS (
  SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS line_licences, count(*) AS n_lines FROM (
    SELECT doc_id, licence FROM lines JOIN known USING (digest) WHERE anchor IS NULL
    UNION ALL SELECT doc_id, licence FROM (SELECT doc_id, sha256(left(r, n_chars)) AS digest FROM runs WHERE substr(r, n_chars + 1, 1) = ' ') JOIN known USING (digest) WHERE anchor IS NOT NULL) GROUP BY doc_id
)
SELECT w.doc_id, w.digest, k.licence, coalesce(h.line_licences, '') AS line_licences, coalesce(h.n_lines, 0) AS n_lines
FROM whole w LEFT JOIN known k USING (digest) LEFT JOIN hits h ON w.doc_id = h.doc_id
"""


ORACLE = _oracle()


def op9_licence_scan(spark, sf_dir: str) -> DataFrame:
    found = scan_licences(spread(table(spark, sf_dir, "documents")), known_digests(spark))
    return found.select("doc_id", "digest", "licence", F.concat_ws(",", "line_licences").alias("line_licences"), F.col("n_lines").cast("long").alias("n_lines"))

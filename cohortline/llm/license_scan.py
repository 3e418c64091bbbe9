"""Licence scan by canonical digest lookup.

A text and its parts (paragraphs between empty lines, and lines) are normalised as a whole:
ASCII letters in lower case, copyright notices dropped, equivalent spellings unified, runs of
punctuation and white space turned into one blank. Only a line shaped as a notice is dropped
(``COPYRIGHT_LINE``), whole or up to where a licence opens on it, so the form of a licence text does
not depend on where its prose is wrapped. The SHA-256 of the result is joined by hash with the digests of known licence texts, which went through the same steps. A part
matches only if it is a known text from end to end.

The known texts are a parameter, (licence, text) rows; their digests (about 100 bytes each)
are broadcast when there are at most ``BROADCAST_TEXTS``, else joined by a shuffle. Only
matches are grouped by document, with partial aggregation. The texts of the Creative Commons
BY licences are not among them, only their short notices. The GPL texts hold notices of their
own and match only with those on lines of their own, as published.

Defined results: a null text counts as empty, an empty part matches nothing; long texts are
taken whole; a text that is known under several names reports all of them; rows that repeat
an id count as one document, their matches are reported on each; extra columns are ignored;
an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm.common import col, whole_text

BROADCAST_TEXTS = 20_000     # 2 MB of digests
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Short public notices and licence texts, as (licence, text).
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MIT", """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
)

_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

{} Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

{} Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

"""
_BSD_NAME = """{} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.

"""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def _titled(licence: str, titles: Iterable[str], body: str) -> list[tuple[str, str]]:
    return [(licence, f"{title}\n\n{body}") for title in titles]


def _entire_texts() -> list[tuple[str, str]]:
    """Whole licence texts under their usual titles or none, and those of ``licences/``."""
    body = {licence: text.split("\n\n", 1)[1] for licence, text in KNOWN if "\n\n" in text}
    out = _titled("MIT", ("", "The MIT License", "The MIT License (MIT)"), body["MIT"])
    out += _titled("ISC", ("", "The ISC License", "ISC License"), body["ISC"])
    for marks in (("1.", "2.", "3."), ("*", "*", "*")):
        start, end = _BSD_START.format(*marks[:2]), _BSD_END
        for name, clauses in (("2", start + end), ("3", start + _BSD_NAME.format(marks[2]) + end)):
            out += _titled(f"BSD-{name}-Clause", ("", f"BSD {name}-Clause License", f"The BSD {name}-Clause License"), clauses)
    for name in ("Apache-2.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "MPL-2.0"):
        out.append((name, files("cohortline.llm").joinpath("licences", f"{name}.txt").read_text("utf-8")))
    return out


KNOWN += tuple(_entire_texts())

# Words that follow "copyright" in the prose of licences; any other word or a
# number makes a line that starts with "copyright" a notice with its sign, year or holder.
PROSE_WORDS = (
    "act", "acts", "also", "and", "as", "claim", "claims", "control", "disclaimer", "for", "header", "headers", "holder",
    "holders", "in", "information", "infringement", "interest", "interests", "is", "law", "laws", "licence", "licences",
    "license", "licenses", "like", "line", "lines", "material", "notice", "notices", "of", "on", "or", "owner", "owners",
    "ownership", "permission", "protection", "right", "rights", "statement", "statements", "status", "to", "treaties",
    "treaty", "under", "work", "works",
)


def _other_word(words: Iterable[str], prefix: str = "") -> str:
    """Pattern of the start of a lower-case word that is none of ``words``, without the
    look-ahead that not every engine has."""
    following = sorted({w[len(prefix)] for w in words if w.startswith(prefix) and w != prefix})
    if not following:
        return "[a-z]"
    fresh = "".join(c for c in LOWER if c not in following)
    ways = [f"[{fresh}]"] + [c + _other_word(words, prefix + c) for c in following]
    if prefix and prefix not in words:
        ways += ["[^a-z\\n]", "$"]
    return "(" + "|".join(ways) + ")"


_NOTICE = f"copyright[^a-z0-9\\n]+([0-9]|{_other_word(PROSE_WORDS)})"
# A notice ends where a licence opens, or else with its line, however long that is.
COPYRIGHT_LINE = (
    f"(?m)^[^a-z0-9\\n]*((\\(c\\)[^a-z0-9\\n]*)?{_NOTICE}[^\\n]*|©[^\\n]*"
    "|\\(c\\)[^\\n]*(19|20)[0-9]{2}[^\\n]*|all rights reserved[^a-z0-9\\n]*)$")
# How licences open (pattern, its usual text), where a whole text was put on the line
# of its notice.
OPENINGS = (
    *[(opening, opening) for opening in (
        "permission is hereby granted", "permission to use, copy", "redistribution and use in source")],
    ("mozilla public license version 2.0[^a-z0-9\\n]+1. definitions", "mozilla public license version 2.0 1. definitions"),
    ("creative commons legal code[^a-z0-9\\n]+cc0 1.0 universal", "creative commons legal code cc0 1.0 universal"),
)
NOTICE_ENDS = tuple((f"(\\(c\\) *)?{_NOTICE}[^\\n]*?{pattern}", opening) for pattern, opening in OPENINGS)

# Spellings that licence matching treats as equal, after lower-casing and
# before punctuation is removed (pattern, replacement). A spelling with a separator stands
# for the one without, so that a line may end there.
SPELLINGS = (
    ("https://", "http://"),
    ("\\(c\\)|©", "copyright"),
    ("&", "and"),
    ("\\blicence", "license"),
    ("sublicen[cs]e", "sub license"),
    ("acknowledgement", "acknowledgment"),
    ("noninfringement", "non infringement"),
    ("\\bpercent\\b", "per cent"),
    ("\\bv\\.", "version "),
    ("analogue", "analog"),
    ("authorisation", "authorization"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("fulfilment", "fulfillment"),
    ("programme", "program"),
    ("wilful", "willful"),
)
# ASCII white space and punctuation, and typographic blanks, dots, dashes, quotes and bullets
SEPARATORS = "[\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f\u00a0\u00b7\u2010-\u2015\u2018-\u201f\u2022\u2026]+"


# Substrings of which every copyright line or variant spelling has one.
VARIANT_SIGNS = (
    "copyright", "all rights reserved", "https://", "(c)", "©", "&", "licence", "sublicen",
    "acknowledgement", "noninfringement", "percent", "v.", "analogue", "authorisation", "organisation",
    "favour", "fulfilment", "programme", "wilful",
)


def _line_form(line: Column) -> Column:
    """Canonical form of one line in lower case."""
    unified = line
    for pattern, replacement in (*NOTICE_ENDS, ("(?d)" + COPYRIGHT_LINE, " "), *SPELLINGS):
        unified = F.regexp_replace(unified, F.lit(pattern), F.lit(replacement))
    # most lines have none of the variants: plain searches spare them the replacements
    some = reduce(lambda x, y: x | y, [F.contains(line, F.lit(sign)) for sign in VARIANT_SIGNS])
    return F.trim(F.regexp_replace(F.when(some, unified).otherwise(line), F.lit(SEPARATORS), F.lit(" ")))


def _joined(forms: Column) -> Column:
    return F.array_join(F.filter(forms, lambda f: f != ""), " ")


def canonical_parts(text: Column) -> Column:
    """Canonical lines of each paragraph of a text. No rule reaches over a line's end, so the
    form of a paragraph or of the whole text is its lines' forms, joined by blanks."""
    lower = F.translate(text, UPPER, LOWER)
    return F.transform(F.split(lower, "\n[ \\t\\r]*\n"), lambda p: F.transform(F.split(p, "\n"), _line_form))


def _digest(form: Column) -> Column:
    return F.when(form != "", F.sha2(form.cast("binary"), 256))


def canonical(text: Column) -> Column:
    """Canonical form of a whole text."""
    return _joined(F.flatten(canonical_parts(text)))


def known_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(KNOWN), "licence string, text string")


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: id, ``licences`` (sorted names, comma-joined, or null), ``n_matches``
    (distinct parts that are a known text), ``whole_licences`` (names of the whole text)."""
    digests = known.select(canonical(whole_text("text")).alias("__form"), "licence").select(
        _digest(F.col("__form")).alias("__digest"), "licence").filter(
        "__digest is not null").groupBy("__digest").agg(F.array_sort(F.collect_set("licence")).alias("__names"))
    if digests.count() <= BROADCAST_TEXTS:
        digests = F.broadcast(digests)
    forms = docs.select(col(id_col).alias("__id"), canonical_parts(whole_text(text)).alias("__parts")).select(
        "__id", _joined(F.flatten("__parts")).alias("__whole"),
        F.concat(F.transform("__parts", _joined), F.flatten("__parts")).alias("__forms"))
    digests_of = forms.select("__id", _digest(F.col("__whole")).alias("__whole"), F.transform("__forms", _digest).alias("__forms"))
    units = digests_of.select("__id", "__whole", F.explode(F.array_distinct(F.concat(
        F.array("__whole"), "__forms"))).alias("__digest")).select(
        "__id", "__digest", (F.col("__digest") == F.col("__whole")).alias("__is_whole"))
    found = (
        units.filter("__digest is not null").join(digests, "__digest")
        .groupBy("__id", "__digest").agg(F.max("__is_whole").alias("__is_whole"), F.first("__names").alias("__names"))
        .groupBy("__id").agg(
            F.count("*").alias("n_matches"),
            F.concat_ws(",", F.array_sort(F.array_distinct(F.flatten(F.collect_list("__names"))))).alias("licences"),
            F.concat_ws(",", F.array_sort(F.array_distinct(F.flatten(F.collect_list(
                F.when(F.col("__is_whole"), F.col("__names"))))))).alias("whole_licences"))
    )
    return (
        docs.select(col(id_col).alias(id_col))
        .join(found, col(id_col).eqNullSafe(F.col("__id")), "left")
        .select(
            col(id_col), "licences", F.coalesce("n_matches", F.lit(0).cast("long")).alias("n_matches"),
            F.when(F.col("whole_licences") != "", F.col("whole_licences")).alias("whole_licences"))
    )

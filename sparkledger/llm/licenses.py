r"""Licences by the digest of a canonical text.

A text is made canonical: lower case, variant spellings made one, copyright lines dropped, everything but letters and
digits turned into single blanks. Its SHA-256 is then looked up, by a hash join, among the digests of known licences,
which are made canonical by the same expressions. Looked up are whole texts, and each line of a text as a notice of its
own; a line is no part of a longer one. Only DataFrame functions are used.

Defined results: null and empty texts, and lines that are empty once canonical, match nothing; a text that repeats a
notice counts it each time in n_notices and once in licenses; rows that repeat id and text keep a row each; null ids
stay; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkledger.llm.common import documents, prepare

# Spellings that licences use for the same word, as (written, canonical).
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("sub-license", "sublicense"), ("sub license", "sublicense"), ("non-commercial", "noncommercial"),
    ("organisation", "organization"), ("authorised", "authorized"), ("favour", "favor"), ("whilst", "while"), ("wilful", "willful"),
    ("per cent", "percent"), ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"), ("merchantibility", "merchantability"),
    ("https", "http"), ("noninfringement", "non infringement"), ("acknowledgement", "acknowledgment"), ("judgement", "judgment"),
)
# A line that states who holds the copyright, not the terms: copyright with a mark, a year, a placeholder,
# "by" or a company. A name alone is not told from a line of prose that begins with that word. No pattern repeats a
# group, which would make the matcher recurse: marks are taken off one after another before a year is looked for.
HOLDER = (
    r"^[^\p{L}\p{N}]*(copyright[^\p{L}\p{N}(©]*(\(c\)|©).*|©.*|copyright by .*"
    r"|copyright[^\p{L}\p{N}].*\b(inc|incorporated|llc|ltd|limited|corp|corporation|company|gmbh|foundation)\b[^\p{L}\p{N}]*)$"
)
FIRST_MARK = r"^[^\p{L}\p{N}]*(copyright|\(c\)|©)"
MARK = r"copyright|\(c\)|©"
YEAR_FIRST = r"^[^\p{L}\p{N}]*([12][0-9]{3}|[<\[{])"
# Fixed value: what separates words once the text is in lower case.
NOT_WORD = r"[^\p{L}\p{N}]+"

# Notices, one line each, by SPDX name or as they are known.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("rights-reserved", "All rights reserved."),
)

# Whole texts of short licences.
MIT_TEXT = """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
ISC_TEXT = """ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.
"""
BSD_TEXT = """BSD 2-Clause License

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
BSD_3_TEXT = BSD_TEXT.replace("BSD 2-", "BSD 3-", 1).replace("""
THIS SOFTWARE IS""", """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.

THIS SOFTWARE IS""", 1)

# Titles that whole texts go by, besides none.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License", "BSD 2-Clause \"Simplified\" License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License", "BSD 3-Clause \"New\" or \"Revised\" License"),
}
# Whole texts that lie beside this module, with the start of the terms, and what may be left out after them.
FILES = {
    "Apache-2.0": ("TERMS AND CONDITIONS FOR USE", "END OF TERMS AND CONDITIONS"), "GPL-2.0": ("Everyone is permitted", "END OF TERMS AND CONDITIONS"),
    "GPL-3.0": ("Everyone is permitted", "END OF TERMS AND CONDITIONS"), "LGPL-3.0": ("Everyone is permitted", None),
    "MPL-2.0": ("1. Definitions", None), "CC0-1.0": ("Statement of Purpose", None), "CC-BY-SA-4.0": ("By exercising the Licensed Rights", None),
}


def _short(name: str, text: str) -> list[tuple[str, str]]:
    """A short licence under each of its titles and without one, with numbered or plain conditions."""
    body = text.split("\n", 1)[1]
    bodies = {body, re.sub(r"(?m)^[0-9]\. ", "", body)}
    reserved = ("", "All rights reserved.\n") if name.startswith("BSD") else ("",)
    return [(name, f"{title}\n{line}{b}") for title in ("", *TITLES[name]) for line in reserved for b in sorted(bodies)]


def _long(name: str) -> list[tuple[str, str]]:
    """A licence from its file, with and without its title and with and without what follows the terms."""
    text = (files(__package__) / "license_texts" / f"{name}.txt").read_text("utf-8")
    start, end = FILES[name]
    found = [text]
    if end:
        cut = text.index(end)
        found += [text[: cut + len(end)], text[:cut]]
    return [(name, t) for whole in found for t in (whole, whole[whole.index(start) :])]


SHORT = (("MIT", MIT_TEXT), ("ISC", ISC_TEXT), ("BSD-2-Clause", BSD_TEXT), ("BSD-3-Clause", BSD_3_TEXT))
TEXTS = (*(t for name, text in SHORT for t in _short(name, text)), *(t for name in FILES for t in _long(name)))


def plain(line: Column) -> Column:
    """A line in lower case, with single blanks between its words; empty if it states a copyright."""
    # Every such line has a mark, which is quickly seen.
    marked = F.contains(line, F.lit("copyright")) | F.contains(line, F.lit("(c)")) | F.contains(line, F.lit("©"))
    unmarked = F.regexp_replace(F.regexp_replace(line, FIRST_MARK, ""), MARK, "")
    holder = marked & (line.rlike(HOLDER) | (line.rlike(FIRST_MARK) & unmarked.rlike(YEAR_FIRST)))
    return F.when(holder, "").otherwise(F.trim(F.regexp_replace(line, NOT_WORD, " ")))


def spelled(text: Column) -> Column:
    """A plain text in canonical spelling. Blanks are doubled meanwhile, so that neighbouring words do not share one."""
    text = F.concat(F.lit(" "), F.replace(text, F.lit(" "), F.lit("  ")), F.lit(" "))
    for written, wanted in SPELLINGS:
        text = F.replace(text, F.lit(f" {_doubled(written)} "), F.lit(f" {_doubled(wanted)} "))
    return F.trim(F.replace(text, F.lit("  "), F.lit(" ")))


def _doubled(words: str) -> str:
    return words.replace("-", " ").replace(" ", "  ")


def parts(text: Column) -> tuple[Column, Column]:
    """Two arrays of (whole, part): the canonical lines that have words, and the canonical text as a whole."""
    lines = F.filter(F.transform(F.split(F.lower(text), "\n"), plain), lambda line: line != "")
    return F.transform(lines, lambda line: F.struct(F.lit(False).alias("whole"), spelled(line).alias("part"))), F.array(
        F.struct(F.lit(True).alias("whole"), spelled(F.array_join(lines, " ")).alias("part"))
    )


def known_licenses(spark: SparkSession, notices=NOTICES, texts=TEXTS) -> DataFrame:
    """digest, license: a few rows from the given lists; a digest with several names has the first by name."""
    rows = spark.createDataFrame([*notices, *texts], "license string, text string")
    whole = rows.select("license", parts(F.col("text"))[1][0]["part"].alias("part"))
    return whole.groupBy(F.sha2("part", 256).alias("digest")).agg(F.min("license").alias("license"))


def scan_licenses(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, whole_text (licence that the whole text is, or null), n_notices, licenses (sorted names, comma-joined)."""
    spark = prepare(docs.sparkSession)
    known = known if known is not None else known_licenses(spark)
    texts = documents(docs, id_col, text_col)
    row = F.struct("doc_id", F.xxhash64("text").alias("text")).alias("row")
    # A text of one line is looked up as a text and as a notice.
    lines, whole = parts(F.col("text"))
    each = texts.filter(F.col("text").isNotNull()).select(row, F.explode(F.concat(whole, lines)).alias("p")).filter("p.part <> ''")
    found = each.select("row", "p.whole", F.sha2("p.part", 256).alias("digest")).join(known, "digest")
    notice = F.when(~F.col("whole"), F.col("license"))
    hits = found.groupBy("row").agg(
        F.min(F.when(F.col("whole"), F.col("license"))).alias("whole_text"), F.count(notice).alias("n"), F.collect_set("license").alias("names")
    )
    # Copies of a row were counted together.
    copies = texts.select(row).groupBy("row").agg(F.count("*").alias("copies"))
    hits = hits.join(copies, "row")
    return texts.select("doc_id", row).join(hits, "row", "left").select(
        "doc_id", "whole_text", F.coalesce(F.floor(F.col("n") / F.col("copies")), F.lit(0).cast("long")).alias("n_notices"),
        F.coalesce(F.concat_ws(",", F.array_sort("names")), F.lit("")).alias("licenses"),
    )

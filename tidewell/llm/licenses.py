"""License scans by MinHash bands over overlapping text windows. DataFrame functions only.

Words are runs of letters and digits in lower case; shingles are five consecutive words. Templates of equal length form a
class; for a class of n distinct shingles a text is read in windows of 2 n shingles that start every n / 4 shingles, so that
every occurrence of up to 1.75 n shingles (a copy with three words put in for every four) lies inside one window whole. Each window has
128 minima of its shingles' hashes under as many independent hash functions, in 64 bands of two; longer texts of a template also in windows of their own.

An occurrence that keeps 80 % of a template's shingles has a Jaccard similarity of at least 0.8 / 2.2 = 0.36 with its window, so
a band matches with probability 0.13, and one of 64 with 0.9998. Windows that share a band with a template are verified by
exact containment: the share of the template's distinct shingles that the window holds.

A minimum is known by the shingle that has it. A band can match only if the window holds shingles that are minima of a template: the
marks, a table that texts' shingles are joined with. Only windows over marks are built. Before that, a bitmap of the marks' hashes drops the shingles that are no
mark. And a text that holds 80 % of a template's shingles contains one of a few words that stand in more than 20 % of them:
with up to ``MAX_ANCHORS`` such words, texts without any are not split into shingles. All of it skips without loss. Templates and marks are tables; Spark
decides by their size whether to broadcast them.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut_lineage, own_name, table

SHINGLE, BANDS, ROWS, CONTAINMENT = 5, 64, 2, 0.8
#: Windows hold so many times a class's shingles, and start so often in each.
LONG, STEPS = 2, 4
#: Words of this length are long enough to be looked for; templates and words beyond which every text is read; bits that marks are looked up by.
ANCHOR_LENGTH, MAX_ANCHORED, MAX_ANCHORS, BITS = 7, 200, 40, 1 << 16

# Notices and texts of public licenses.
TEMPLATES = (
    ("apache-2.0-line", "Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("mit-line", "MIT", "Released under the MIT License."),
    ("gpl-3.0-line", "GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0-line", "CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("mit-grant", "MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("apache-2.0-notice", "Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("gpl-3.0-notice", "GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("bsd-conditions", "BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("isc-grant", "ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-2.0-notice", "MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "mit-text",
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "bsd-3-clause-text",
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "isc-text",
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "zlib-text",
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "unlicense-text",
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    ),
)


def default_templates(spark: SparkSession) -> DataFrame:
    """The templates above as a table; ``scan`` takes any table of template_id, license, text."""
    return spark.createDataFrame(list(TEMPLATES), "template_id string, license string, text string")


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with ``value`` as a generated column: it is computed once per row, not again wherever it is used."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def shingles(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with an array of the hashes of all shingles in order; empty for fewer words than a shingle."""
    words = own_name(df, "words_of_text")
    hashed = once(df, words, F.transform(F.split(normalised(F.col(text)), " "), lambda w: F.xxhash64(w)))
    n = F.size(words) - SHINGLE + 1
    # a shingle's hash is the hash of its words' hashes
    at = lambda i, k: F.get(F.col(words), i + k)
    each = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*[at(i, k) for k in range(SHINGLE)]))
    return once(hashed, name, F.when(n > 0, each).otherwise(F.array().cast("array<bigint>"))).drop(words)


def minima(held: Column) -> Column:
    """The shingles of an array of hashes that are smallest under each of the hash functions, as an array."""
    ranked = lambda j: F.transform(held, lambda x: F.struct(F.xxhash64(x, j).alias("rank"), x.alias("h")))
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS * ROWS - 1)), lambda j: F.array_min(ranked(j))["h"])


def banded(df: DataFrame, low: str, name: str) -> DataFrame:
    """``df`` with an array of band values from the array ``low`` of minima."""
    return once(df, name, F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.slice(low, b * ROWS + 1, ROWS))))


def anchors(templates: list[list[str]], containment: float) -> list[str]:
    """Words one of which every text has that holds at least ``containment`` of some template's distinct shingles.

    Such a text misses at most ``1 - containment`` of the shingles. So words that stand in more than that share of a template's
    shingles can't be missing all; they are chosen by how many shingles they stand in, long words first.
    """
    out: list[str] = []
    for words in templates:
        shingled = {tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}
        spare = math.floor((1 - containment) * len(shingled) + 1e-9)
        open_ = {s for s in shingled if not any(a in w for a in out for w in s)}
        while len(shingled) - len(open_) <= spare:
            cover: dict[str, int] = {}
            for s in open_:
                for w in set(s):
                    cover[w] = cover.get(w, 0) + 1
            out.append(max(cover, key=lambda w: (min(len(w), ANCHOR_LENGTH), cover[w], len(w), w)))
            open_ = {s for s in open_ if not any(out[-1] in w for w in s)}
    return out


def bitmap(marks: DataFrame) -> DataFrame:
    """One row with ``bits``, an array of ``BITS`` booleans: whether any mark has the place's number as its hash modulo ``BITS``."""
    taken = marks.select(F.pmod("h", F.lit(BITS)).alias("id")).distinct().withColumn("bit", F.lit(True))
    every = marks.sparkSession.range(BITS).join(taken, "id", "left").select("id", F.coalesce("bit", F.lit(False)).alias("bit"))
    return every.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "bit"))), lambda x: x["bit"]).alias("bits"))


def scan(docs: DataFrame, templates: DataFrame, key: str = "doc_id", text: str = "text", containment: float = CONTAINMENT) -> DataFrame:
    """One row per document and template found: key, ``template_id``, ``license``, ``containment``, ``first_word``, ``n_windows``.

    ``containment`` is the largest over the document's windows, ``first_word`` the word (from 0) at which the first of the matching
    windows begins, ``n_windows`` how many match. Null and empty texts, texts of fewer than five words and empty tables match nothing; texts of
    any length are read whole. Rows that repeat a key are read as one document; a row with a null key is a document of its own. Templates need five words. Other columns are not carried.
    """
    spelled = F.split(normalised(F.col("t")), " ")
    known = shingles(templates.select("template_id", "license", F.col("text").alias("t")), "t", "of_template").withColumn("spelled", spelled)
    known = known.filter(F.size("of_template") > 0).select("template_id", "license", F.array_distinct("of_template").alias("of_template"), "spelled")
    known = cut_lineage(once(known.withColumn("n", F.size("of_template")), "low", minima(F.col("of_template"))))
    # a shingle that is a minimum of some template leads to the classes (lengths) of such templates
    marks = cut_lineage(known.select("n", F.explode("low").alias("h")).distinct())
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("t"))
    if known.count() <= MAX_ANCHORED:
        looked_for = anchors([r["spelled"] for r in known.select("spelled").collect()], containment)  # at most MAX_ANCHORED templates
        if looked_for and len(looked_for) <= MAX_ANCHORS:
            low = once(texts, "low", F.lower(F.coalesce("t", F.lit("")))).select("key", F.col("low").alias("t"))
            texts = low.filter(reduce(or_, [F.contains("t", F.lit(w)) for w in looked_for]))
    read = shingles(texts, "t", "held").select("key", "held", bitmap(marks).scalar().alias("bits"))
    numbered = F.transform("held", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    hits = F.filter(numbered, lambda s: F.get("bits", F.pmod(s["h"], F.lit(BITS)).cast("int")))
    read = once(read, "hits", hits).filter(F.size("hits") > 0).select("key", "held", "hits", F.monotonically_increasing_id().alias("row"))
    own = F.when(F.col("key").isNull(), F.col("row")).alias("own")
    read = cut_lineage(read)  # texts with a possible mark only; row numbers stay what they are
    n, step, long = F.col("n"), F.greatest(F.lit(1), F.floor(F.col("n") / STEPS)), F.col("n") * LONG
    first = F.greatest(F.lit(0), F.ceil((F.col("i") - long + 1) / step))
    starts = read.select("row", F.inline("hits")).join(marks, "h").select("row", "n", F.explode(F.sequence(first, F.floor(F.col("i") / step))).alias("k")).distinct()
    at = (F.col("k") * step).cast("int")
    windows = starts.join(read.select("row", "key", "held"), "row").select("key", own, n, at.alias("at"), F.array_distinct(F.slice("held", at + 1, long)).alias("window"))
    of_windows = banded(once(windows, "low", minima(F.col("window"))), "low", "bands").select("key", "own", "n", "at", "window", F.explode("bands").alias("band"))
    of_templates = banded(known, "low", "bands").select("n", F.explode("bands").alias("band"), "template_id", "license", "of_template").distinct()
    met = of_windows.join(of_templates, ["n", "band"])
    # a window meets a template in many bands: verify, then count each once
    verified = met.withColumn("share", F.size(F.array_intersect("window", "of_template")) / F.size("of_template")).filter(F.col("share") >= containment)
    each = verified.groupBy("key", "own", "template_id", "license", "at").agg(F.max("share").alias("share"))
    found = each.groupBy("key", "own", "template_id", "license").agg(F.max("share").alias("containment"), F.min("at").cast("long").alias("first_word"), F.count(F.lit(1)).alias("n_windows"))
    return found.drop("own").withColumnRenamed("key", key)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"), default_templates(spark))

"""License scans by DataFrame functions alone: MinHash bands over overlapping windows, then exact containment.

A text's words (runs of letters and digits, lower case) give hashed five-word shingles. Windows of ``WINDOW``
shingles begin every ``STEP`` shingles; each has one smallest hash per band under ``BANDS`` permutations (a
hash XOR a constant), taken from the smallest hashes of its blocks of STEP shingles. A template is retrieved
if in any band its smallest hash over all its shingles is a window's. Whatever the template's length, a window
inside its copy collides as soon as it covers that one shingle, and windows cover the text without gaps: a
verbatim copy is missed only if in every band foreign shingles at its rim are smaller, and a copy with share c
of its shingles is retrieved with probability about 1 - (1 - c) ** BANDS, over 0.99999 at c = 0.8. Templates
too short to dominate a window (up to ``SHORT`` shingles) are looked up in windows of one shingle, where the
smallest hash is the shingle itself. A window's smallest hash is a shingle of the text, so texts that hold no
template's smallest one cannot hit in any band, and their windows are never built.

Verification counts the template's distinct shingles in windows of twice its length that begin anywhere, and
takes the best: a copy counts wherever it stands and as long as what is inserted in it stays below its length.
A match holds at least ``LEAST`` of the template's shingles; of templates one of which contains the other both are
reported. The count of all windows comes from one running
sum: an occurrence counts in the windows that begin after the same shingle's last occurrence, up to itself.

Edge cases: null, empty and short texts match nothing; a template repeated in a text gives one row; each row of
``docs`` is matched by itself, also where rows share a doc_id or have none; extra columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
LEAST = 0.8
BANDS = 8
STEP = 2
WINDOW = 4
SHORT = 2

# The wording of public license notices.
TEMPLATES = {
    "mit-line": "Released under the MIT License.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
    "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
    "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
    'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
    "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
    "permissions and limitations under the License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights '
    "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
    "whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission "
    "notice shall be included in all copies or substantial portions of the Software.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-2-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list "
    "of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list "
    "of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.",
    "bsd-disclaimer": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
    "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
    "THE POSSIBILITY OF SUCH DAMAGE.",
    "mit-disclaimer": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
    "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "lgpl-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
    "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later "
    "version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
    "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
    "commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this "
    "software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the "
    "benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act "
    "of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
    "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, "
    "including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The "
    "origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this "
    "software in a product, an acknowledgment in the product documentation would be appreciated but is not required. Altered "
    "source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice "
    "may not be removed or altered from any source distribution.",
}

WORDS = r"[\p{L}\p{N}]+"


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def constants(bands: int) -> list[int]:
    """One permutation's constant per band: odd multiples of a 64-bit number, as signed values."""
    found = [(2 * i + 1) * 0x9E3779B97F4A7C15 % (1 << 64) for i in range(bands)]
    return [c - (1 << 64) if c >> 63 else c for c in found]


def shingled(rows: DataFrame) -> DataFrame:
    """``rows`` (.., text) with __sh, the hashes of all shingles in order, instead of text.

    Every step is a projection of its own, so none is evaluated twice.
    """
    rows = rows.withColumn("__w", F.regexp_extract_all(F.lower(F.coalesce(F.col("text"), F.lit(""))), F.lit(WORDS), F.lit(0))).drop("text")
    rows = rows.withColumn("__h", F.transform("__w", lambda w: F.xxhash64(w))).drop("__w")
    at = F.sequence(F.lit(0), F.size("__h") - SHINGLE)
    hashed = F.transform(at, lambda i: F.xxhash64(*[F.get("__h", i + j) for j in range(SHINGLE)]))
    return rows.withColumn("__sh", F.when(F.size("__h") >= SHINGLE, hashed).otherwise(F.array().cast("array<bigint>"))).drop("__h")


def block_minima(band: int) -> Column:
    """The smallest permuted hash of each block of shingles."""
    return F.transform("__blocks", lambda block: F.array_min(F.transform(block, lambda x: x.bitwiseXOR(F.lit(band)))))


def window_minima(blocks: str, band: int) -> Column:
    """For the window that begins at each block, the hash that is smallest when permuted."""
    wide = WINDOW // STEP
    moved = [F.slice(blocks, j + 1, F.greatest(F.size(blocks), F.lit(1))).alias(f"b{j}") for j in range(wide)]
    return F.transform(F.arrays_zip(*moved), lambda z: F.least(*[z[f"b{j}"] for j in range(wide)]).bitwiseXOR(F.lit(band)))


def tagged(values: Column, band: int) -> Column:
    return F.transform(values, lambda k: F.struct(F.lit(band).alias("band"), k.alias("key")))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = LEAST, bands: int = BANDS) -> DataFrame:
    """doc_id, license, containment (the best window's), first_word (where the first window with enough begins).

    The templates' tables are bounded by their words; they are built by the same functions and broadcast.
    """
    spark = docs.sparkSession
    known = shingled(spark.createDataFrame([(k, t) for k, t in templates.items() if len(template_words(t)) >= SHINGLE], "license string, text string"))
    known = [(r["license"], sorted(set(r["__sh"])), len(r["__sh"])) for r in known.collect()]
    schema_out = "doc_id long, license string, containment double, first_word long"
    if not known:
        return spark.createDataFrame([], schema_out)
    marks = constants(bands)
    keys = [(i, min(h ^ c for h in own) ^ c, name) for i, c in enumerate(marks) for name, own, n in known if n > SHORT]
    keys += [(bands, h, name) for name, own, n in known if n <= SHORT for h in own]

    def wanted(band: int | None = None) -> Column:
        found = sorted({k for b, k, _ in keys if band is None or b == band})
        return F.array(*[F.lit(k) for k in found]) if found else F.array().cast("array<bigint>")

    # a row is told from others by its place, as ids may repeat or be null
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = shingled(rows)
    rows = rows.withColumn("__sh", F.when(F.arrays_overlap("__sh", wanted()), F.col("__sh")))
    # outer explodes, for the optimiser copies the arrays below a plain one as a filter
    blocks = F.transform(
        F.filter(F.sequence(F.lit(1), F.greatest(F.size("__sh"), F.lit(1)), F.lit(STEP)), lambda i: i <= F.size("__sh")),
        lambda i: F.slice("__sh", i, F.lit(STEP)),
    )
    rows = rows.withColumn("__blocks", F.when(F.col("__sh").isNotNull(), blocks))
    names = [f"__m{i}" for i in range(bands)]
    rows = rows.select("__row", "doc_id", "__sh", *[block_minima(c).alias(n) for c, n in zip(marks, names)])
    rows = rows.select("__row", "doc_id", "__sh", *[window_minima(n, c).alias(n) for c, n in zip(marks, names)])
    hits = [tagged(F.array_intersect(n, wanted(i)), i) for i, n in enumerate(names)]
    hits.append(tagged(F.array_intersect("__sh", wanted(bands)), bands))
    rows = rows.select("__row", "doc_id", "__sh", F.explode_outer(F.concat(*hits)).alias("hit")).where("hit IS NOT NULL")
    schema = "b int, k long, license string"
    table = spark.createDataFrame(sorted(set(keys)), schema)
    rows = rows.join(F.broadcast(table), (F.col("hit.band") == F.col("b")) & (F.col("hit.key") == F.col("k")))
    rows = rows.select("__row", "doc_id", "__sh", "license").dropDuplicates(["__row", "license"])

    parts = spark.createDataFrame([(name, h, len(own), n) for name, own, n in known for h in own], "of string, h long, distinct int, length int")
    rows = rows.select("__row", "doc_id", "license", F.posexplode_outer("__sh").alias("at", "sh"))
    rows = rows.join(F.broadcast(parts), (F.col("license") == F.col("of")) & (F.col("sh") == F.col("h")))
    own = Window.partitionBy("__row", "license")
    last = F.lag("at").over(Window.partitionBy("__row", "license", "sh").orderBy("at"))
    begin = F.greatest(F.coalesce(last, F.lit(-1)), F.col("at") - 2 * F.col("length")) + 1
    rows = rows.withColumn("begin", begin)
    step = lambda at, by, start: F.struct(at.alias("at"), F.lit(by).alias("by"), F.lit(start).alias("start"))
    steps = F.array(step(F.col("begin"), 1, False), step(F.col("at") + 1, -1, False), step(F.col("at"), 0, True))
    rows = rows.select("__row", "doc_id", "license", "distinct", F.explode(steps).alias("s")).select("__row", "doc_id", "license", "distinct", "s.*")
    rows = rows.withColumn("n", F.sum("by").over(own.orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    # the most shingles are in a window that begins at one of them
    rows = rows.where("start").withColumn("containment", F.col("n") / F.col("distinct")).where(F.col("containment") >= least)
    rows = rows.groupBy("__row", "doc_id", "license").agg(F.max("containment").alias("containment"), F.min("at").cast("long").alias("first_word"))
    return rows.drop("__row")


def _sql() -> str:
    """The same in DuckDB by brute force: every shingle of every text against every template's."""
    rows = []
    for name, text in TEMPLATES.items():
        words = template_words(text)
        own = [" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]
        rows += [f"('{name}', '{s}', {len(set(own))}, {len(own)})" for s in dict.fromkeys(own)]
    return rf"""
WITH t(license, sh, n_distinct, length) AS (VALUES {", ".join(rows)}),
w AS (SELECT row_number() OVER () AS own, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS w FROM documents),
s AS (SELECT own, doc_id, unnest(range(0, len(w) - {SHINGLE - 1})) AS pos, w FROM w WHERE len(w) >= {SHINGLE}),
h AS (SELECT own, doc_id, pos, array_to_string(w[pos + 1:pos + {SHINGLE}], ' ') AS sh FROM s),
m AS (SELECT h.own, h.doc_id, t.license, h.sh, h.pos, t.n_distinct, t.length FROM h JOIN t USING (sh)),
g AS (SELECT a.own, a.doc_id, a.license, a.pos, count(DISTINCT b.sh) / a.n_distinct::DOUBLE AS containment
      FROM m a JOIN m b ON a.own = b.own AND a.license = b.license AND b.pos >= a.pos AND b.pos < a.pos + 2 * a.length GROUP BY a.own, a.doc_id, a.license, a.pos, a.n_distinct)
SELECT doc_id, license, max(containment) AS containment, min(pos)::BIGINT AS first_word
FROM g WHERE containment >= {LEAST} GROUP BY own, doc_id, license
"""


SQL = _sql()

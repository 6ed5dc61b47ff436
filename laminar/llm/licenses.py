"""License scan: TF-IDF cosine of headers and licence files to templates, then inheritance by directory.

DataFrame operations only.  A file's units are, by level: the whole text, if its name marks it as a licence file (0); blocks
of two or more lines, which are paragraphs, comments and their paragraphs, so that wrapped headers are seen as one (1); single
lines (2).  A unit takes part if it holds one of ``KEYWORDS``.  Term weights are ``tf * idf`` with idf over
the template table; a term outside the templates weighs like the rarest one, and comment marks are no terms.
A unit matches the template of the largest cosine if that is at least ``threshold``.  A match of a lower
level goes before any of a higher one: a licence's body or header before a line in it.

The texts are read once: what is written for a file is its path and, if it holds a keyword, its units.

A file without a match of its own inherits from the nearest directory above it that holds a
matching licence file: every file is joined with its ancestor directories by path.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.llm.common import settle

# The notices, headers, titles and bodies by which licences are declared, and file names that declare them.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms are permitted under the BSD license."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("proprietary", "All rights reserved."),
)
TITLES = (
    ("MIT", "MIT License"), ("MIT", "The MIT License (MIT)"), ("ISC", "ISC License"),
    ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Apache License"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"), ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)
_GNU = ("is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free "
        "Software Foundation, either version {1} of the License, or (at your option) any later version. This {2} is distributed "
        "in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details. You should have received a copy of the GNU {0} "
        "along with this {2}. If not, see <https://www.gnu.org/licenses/>.")
HEADERS = (
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
                   'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
                   "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
                   "governing permissions and limitations under the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("GPL-2.0", "This program " + _GNU.format("General Public License", "2", "program")),
    ("GPL-3.0", "This program " + _GNU.format("General Public License", "3", "program")),
    ("LGPL-2.1", "This library " + _GNU.format("Lesser General Public License", "2.1", "library")),
    ("LGPL-3.0", "This library " + _GNU.format("Lesser General Public License", "3", "library")),
    ("AGPL-3.0", "This program " + _GNU.format("Affero General Public License", "3", "program")),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MIT", "Licensed under the MIT license. See LICENSE file in the project root for full license information."),
)
_AS_IS = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, '
          "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
          "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
          "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
          "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
          "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution.")
_ENDORSE = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
            "derived from this software without specific prior written permission.")
BODIES = (
    ("MIT", "MIT License Copyright (c) Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            'associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
            "whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission "
            'notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT '
            "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
            "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
            "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
            "THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-2-Clause", f"BSD 2-Clause License Copyright (c) All rights reserved. {_BSD} {_AS_IS}"),
    ("BSD-3-Clause", f"BSD 3-Clause License Copyright (c) All rights reserved. {_BSD} {_ENDORSE} {_AS_IS}"),
    ("ISC", "ISC License Copyright (c) Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
            'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
            "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
            "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
            "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
)
SPDX = ("MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC",
        "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0")
TEMPLATES = (*NOTICES, *TITLES, *HEADERS, *BODIES, *[(x, f"SPDX-License-Identifier: {x}") for x in SPDX])
KEYWORDS = r"(?i)licen[cs]e|rights reserved|permission|redistribut|public license|cc by|warrant"
COMMENT = r"^[ \t]*([#*;%]|//|--|/[*]|<!--)"
SAYING = COMMENT + ".*[A-Za-z0-9]"  # a comment line that says something
BLANK_LINE = r"\n[ \t\r]*\n"
TWO_LINES = r"[^ \t\r\n][^\n]*\n[^\n]*[^ \t\r\n]"
FILE_NAMES = ("license", "licence", "copying", "notice")
THRESHOLD = 0.8


def terms_of(text: str) -> list[str]:
    return [t for t in re.split("[^a-z0-9]+", text.lower()) if t]


class Templates:
    """Weights of a template list."""

    def __init__(self, templates=TEMPLATES):
        bags = [Counter(terms_of(t)) for _, t in templates]
        found = Counter(t for b in bags for t in b)
        n = len(bags)
        self.names = [name for name, _ in templates]
        self.idf = {t: math.log((1 + n) / (1 + d)) + 1 for t, d in found.items()}
        self.other = math.log(1 + n) + 1
        self.weights = [{t: c * self.idf[t] for t, c in b.items()} for b in bags]
        self.norms = [math.sqrt(sum(w * w for w in b.values())) for b in self.weights]

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, name, t, w, norm) for i, (name, b, norm) in enumerate(zip(self.names, self.weights, self.norms))
                for t, w in b.items()]
        return spark.createDataFrame(rows, "template int, license string, term string, weight double, norm double")

    def idf_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.idf.items()), "term string, idf double")


def _parent(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def units_of(text: Column, declares: Column) -> Column:
    """The units of a text that hold a keyword, as an array of ``(level, text)``."""
    lines = F.split(text, "\n")

    def runs(pattern: str) -> Column:
        """Runs of lines that match."""
        return F.split(F.array_join(F.transform(lines, lambda x: F.when(x.rlike(pattern), x).otherwise("")), "\n"), "\n\n+")

    # comments as a whole, and their paragraphs
    blocks = F.filter(F.concat(F.split(text, BLANK_LINE), runs(COMMENT), runs(SAYING)), lambda x: x.rlike(TWO_LINES))

    def level(n: int, units: Column) -> Column:
        return F.transform(units, lambda x: F.struct(F.lit(n).alias("level"), x.alias("text")))

    whole = F.when(declares, F.array(text)).otherwise(F.array().cast("array<string>"))
    return F.filter(F.concat(level(0, whole), level(1, blocks), level(2, lines)), lambda u: u["text"].rlike(KEYWORDS))


def match_units(units: DataFrame, known: Templates, threshold: float, keys: list[str]) -> DataFrame:
    """``units(*keys, unit, level, text)`` with ``license``, ``score``: the best template at or above the threshold, lowest level first."""
    spark = units.sparkSession
    terms = (units.select(*keys, "unit", "level", F.explode(F.split(F.lower("text"), "[^a-z0-9]+")).alias("term"))
             .where(F.col("term") != "").groupBy(*keys, "unit", "level", "term").agg(F.count("*").alias("tf")))
    weighed = terms.join(F.broadcast(known.idf_table(spark)), "term", "left").withColumn(
        "w", F.col("tf") * F.coalesce("idf", F.lit(known.other)))
    length = weighed.groupBy(*keys, "unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    dots = (weighed.join(F.broadcast(known.table(spark)), "term")
            .groupBy(*keys, "unit", "level", "template", "license").agg((F.sum(F.col("w") * F.col("weight"))
                                                                 / F.first("norm")).alias("dot")))
    score = F.round(F.col("dot") / F.col("length"), 9)
    best = F.struct((-F.col("level")).alias("level"), F.col("score"), (-F.col("template")).alias("rank"), F.col("license"))
    return (dots.join(length, [*keys, "unit"]).withColumn("score", score).where(F.col("score") >= threshold)
            .groupBy(*keys).agg(F.max(best).alias("best"))
            .select(*keys, F.col("best.license").alias("license"), F.col("best.score").alias("score")))


def scan_licenses(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id",
                  path_col: str = "path", text_col: str = "text") -> DataFrame:
    """One row per file: ``(id, path, license, score, origin, from_dir)``.

    ``origin`` is ``own``, ``inherited`` (then ``from_dir`` is the nearest directory above with a matching
    licence file, and ``score`` that file's), or ``none`` with null license and score.  Directories with
    several matching licence files take the best score, ties by licence name.  Null texts match nothing; a
    null path has no directories; repeated rows give repeated rows; other columns are
    ignored; an empty table gives no rows.
    """
    known = Templates(templates)
    src = files.select(F.col(id_col).alias("id"), F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    declares = F.coalesce(F.lower(F.regexp_extract("path", r"([^/.]*)[^/]*$", 1)).isin(*FILE_NAMES), F.lit(False))
    marked = src.withColumn("declares", declares).withColumn("hit", F.col("text").rlike(KEYWORDS))
    # one pass over the texts; the number tells rows apart from here on
    keyed = settle(marked.select("id", "path", "declares", F.when(F.col("hit"), units_of(F.col("text"), F.col("declares"))).alias("units"))
                   .withColumn("key", F.monotonically_increasing_id()), "units")
    units = keyed.select("key", F.posexplode("units").alias("unit", "u")).select("key", "unit", "u.level", "u.text")
    own = match_units(units, known, threshold, ["key"])

    named = keyed.drop("units").join(own, "key", "left")
    by_dir = (named.where(F.col("declares") & F.col("license").isNotNull() & F.col("path").isNotNull())
              .groupBy(_parent(F.col("path")).alias("dir"))
              .agg(F.max(F.col("score")).alias("dir_score"),
                   F.min_by("license", F.struct(-F.col("score"), F.col("license"))).alias("dir_license")))
    # every directory above an unlicensed file, nearest first, joined with the licensed directories
    bare = named.where(F.col("license").isNull() & F.col("path").isNotNull()).select("path").distinct()
    parts = F.split(_parent(F.col("path")), "/")
    above = bare.select("path", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth"), parts.alias("parts")).select(
        "path", "depth", F.array_join(F.slice("parts", 1, F.col("depth")), "/").alias("dir"))
    given = (above.join(by_dir, "dir").groupBy("path")
             .agg(F.max(F.struct("depth", "dir", "dir_license", "dir_score")).alias("near")))
    out = named.join(given, "path", "left")
    inherits = F.col("license").isNull() & F.col("near").isNotNull()
    return out.select(
        F.col("id").alias(id_col), F.col("path").alias(path_col),
        F.coalesce("license", "near.dir_license").alias("license"), F.coalesce("score", "near.dir_score").alias("score"),
        F.when(F.col("license").isNotNull(), "own").when(inherits, "inherited").otherwise("none").alias("origin"),
        F.when(inherits, F.col("near.dir")).alias("from_dir"))

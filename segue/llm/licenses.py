"""Licences of files: notices in their text, or those of the nearest directory."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from segue.operators.joins import fits_broadcast, lookup_join, spread_join
from segue.sources.storage import stage

# Usual notices by SPDX identifier.
# fixed values
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, v. 2.0."),
)

# Whole notices of several lines: usual file headers, and short licences.
# fixed values
TEXTS = (
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
        file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under
        the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY
        KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License.""",
    ),
    (
        "BSD-3-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met:
        1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer.
        2. Redistributions in binary form must reproduce the above copyright notice, this list
        of conditions and the following disclaimer in the documentation and/or other materials
        provided with the distribution.
        3. Neither the name of the copyright holder nor the names of its contributors may be
        used to endorse or promote products derived from this software without specific prior
        written permission.
        THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
        EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
        THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
        SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT
        OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
        INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
        LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
        OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    (
        "GPL-3.0",
        """This program is free software: you can redistribute it and/or modify it under the
        terms of the GNU General Public License as published by the Free Software Foundation,
        either version 3 of the License, or (at your option) any later version.
        This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
        PARTICULAR PURPOSE. See the GNU General Public License for more details.
        You should have received a copy of the GNU General Public License along with this
        program. If not, see <https://www.gnu.org/licenses/>.""",
    ),
    (
        "LGPL-3.0",
        """This library is free software: you can redistribute it and/or modify it under the
        terms of the GNU Lesser General Public License as published by the Free Software
        Foundation, either version 3 of the License, or (at your option) any later version.
        This library is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
        PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.
        You should have received a copy of the GNU Lesser General Public License along with
        this library. If not, see <https://www.gnu.org/licenses/>.""",
    ),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify,
        merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
        permit persons to whom the Software is furnished to do so, subject to the following
        conditions:
        The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
        PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
        LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT
        OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
        OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "MPL-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
        If a copy of the MPL was not distributed with this file, You can obtain one at
        https://mozilla.org/MPL/2.0/.""",
    ),
)

PASSAGES = r"\n\s*\n"  # what separates them
MIN_COSINE = 0.8
FILE_SHARE = 0.1
STRETCH = 2  # a stretch of passages has up to so many times the words of the longest text


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _notice_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def _stretches(files: DataFrame, file: list[str], most_words: int) -> DataFrame:
    """(file, part, pos, line): all runs of two or more passages of bounded length.

    ``part`` is the first passage and ``-pos`` the number of passages; those without
    words are left out. The passages that follow within ``most_words`` words are
    a range of the running count of words, so no row holds more than that.
    """
    passages = files.select(*file, F.posexplode(F.split("text", PASSAGES, -1)).alias("part", "passage"))
    counted = passages.withColumn("n", F.size(_words(F.col("passage")))).filter("n > 0")
    ordered = W.partitionBy(*file).orderBy("part")
    before = F.coalesce(F.sum("n").over(ordered.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = counted.withColumn("start", before.cast("bigint"))
    near = W.partitionBy(*file).orderBy("start").rangeBetween(0, most_words)
    ahead = placed.withColumn(
        "ahead", F.collect_list(F.struct("passage", (F.col("start") + F.col("n")).alias("end"))).over(near)
    )
    fitting = F.filter("ahead", lambda p: p["end"] - F.col("start") <= most_words)
    runs = ahead.withColumn("ahead", fitting).filter(F.size("ahead") > 1)
    return runs.select(*file, "part", "ahead", F.explode(F.sequence(F.lit(2), F.size("ahead"))).alias("k")).select(
        *file,
        "part",
        (-F.col("k")).alias("pos"),
        F.array_join(F.transform(F.slice("ahead", F.lit(1), F.col("k")), lambda p: p["passage"]), "\n\n").alias("line"),
    )


def license_scan(
    files: DataFrame,
    notices: Sequence[tuple[str, str]] = NOTICES,
    texts: Sequence[tuple[str, str]] = TEXTS,
    id_col: str = "doc_id",
    folder_col: str = "folder",
    text_col: str = "text",
    min_cosine: float = MIN_COSINE,
    file_share: float = FILE_SHARE,
) -> DataFrame:
    """(id, own_license, cosine, inherited_license, inherited_from, license).

    Every line of the whole text is a possible notice, and so are the joined
    lines of a paragraph (up to an empty line); both are compared with ``notices``
    and ``texts``. Stretches of consecutive paragraphs, wherever they lie in a file of
    any size, are compared with ``texts``, as long as they have at most ``STRETCH``
    times the words of the longest one. All are vectors of words, times by
    ln((1 + N) / (1 + df)) + 1, with df over all files. The licence is that of the
    template with the largest cosine (6 decimals, of equal ones the first name) if it
    reaches ``min_cosine``. The best one gives the file its own licence.

    A file is a licence file of its folder if its notices hold at least ``file_share``
    of its characters: all matching lines, all matching paragraphs, or the
    longest matching stretch. A folder's licence is the one most of those have
    (of equal ones the first name). A file without a licence of its own inherits
    from the nearest folder that has one, its own or one above it; folders are
    paths with ``/``.

    What has none of the rarest words of a template cannot reach the limit, so
    only lines, paragraphs and stretches with such a word are looked at. Words are
    counted before they are shuffled, inheritance is worked out once per folder,
    and folders with many files are spread when it is joined back. A very long
    text costs its size, and a stretch for each paragraph around rare words.

    A NULL or empty text has no licence of its own; a NULL folder inherits
    nothing. Repeated rows are judged alike. Other columns play no part. An empty
    table gives no rows.
    """
    templates = [*notices, *texts]
    most_words = STRETCH * max((len(_notice_words(t)) for _, t in texts), default=0)
    vocabulary = sorted({w for _, text in templates for w in _notice_words(text)})
    known = F.array(*[F.lit(w) for w in vocabulary])
    total = files.count()
    counted = (
        files.select(F.explode(F.array_intersect(_words(F.col(text_col)), known)).alias("w"))
        .groupBy("w")
        .count()
        .collect()
    )
    df = {r["w"]: r["count"] for r in counted}
    idf = {w: math.log((1 + total) / (1 + df.get(w, 0))) + 1 for w in vocabulary}
    vectors, rare, rare_in_texts = [], set(), set()
    for number, (name, text) in enumerate(templates):
        weights = {w: n * idf[w] for w, n in Counter(_notice_words(text)).items()}
        norm = math.sqrt(sum(x * x for x in weights.values()))
        vectors.append((name, {w: x / norm for w, x in weights.items()}))
        # The rest of a template alone gives a cosine of at most its own length.
        rest = 1.0
        for w, x in sorted(vectors[-1][1].items(), key=lambda p: (-idf[p[0]], -p[1], p[0])):
            if rest < min_cosine**2 - 1e-6:
                break
            rare.add(w)
            if number >= len(notices):
                rare_in_texts.add(w)
            rest -= x * x
    versioned = files.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.xxhash64(text_col).alias("version"),
        F.col(folder_col).alias("folder"),
        F.col(text_col).alias("text"),
    )
    any_of = lambda words: rf"(?<![\p{{L}}\p{{N}}])({'|'.join(sorted(words))})(?![\p{{L}}\p{{N}}])"
    may_match, may_match_texts = any_of(rare), any_of(rare_in_texts)
    file = ["id", "version", "folder", "chars"]
    matching = versioned.withColumn("chars", F.char_length("text")).filter(F.lower("text").rlike(may_match))
    passages = matching.select(*file, F.posexplode(F.split("text", PASSAGES, -1)).alias("part", "passage"))
    parts = passages.filter(F.lower("passage").rlike(may_match))
    # Unit -1 is the passage, others are lines; the same ones are met once.
    lines = F.split("passage", "\n", -1)
    units = F.concat(
        F.transform(lines, lambda x, i: F.struct(i.alias("pos"), x.alias("words"))),
        F.when(F.size(lines) > 1, F.array(F.struct(F.lit(-1).alias("pos"), F.col("passage").alias("words")))).otherwise(
            F.array().cast("array<struct<pos:int,words:string>>")
        ),
    )
    looked_at = (
        parts.select(*file, "part", F.explode(units).alias("unit"))
        .select(*file, "part", "unit.pos", F.col("unit.words").alias("line"))
        .filter(F.lower("line").rlike(may_match))
        .distinct()
    )
    if rare_in_texts:
        long = matching.filter(F.lower("text").rlike(may_match_texts)).dropDuplicates(file)
        stretches = _stretches(long, file, most_words)
        looked_at = looked_at.union(stretches.filter(F.lower("line").rlike(may_match_texts)))
    line = ["id", "version", "folder", "chars", "part", "pos"]
    counts = stage(
        looked_at.select(*line, F.char_length("line").alias("size"), _words(F.col("line")).alias("words"))
        .select(*line, "size", F.explode("words").alias("w"))
        .groupBy(*line, "size", "w")
        .agg(F.count("*").alias("n")),
        "license-words",
    )
    asked = stage(counts.select("w").distinct(), "license-vocabulary")
    every = files.select(F.explode(F.array_distinct(_words(F.col(text_col)))).alias("w"))
    if fits_broadcast(asked):
        found = every.join(F.broadcast(asked), "w", "left_semi").groupBy("w").agg(F.count("*").alias("df"))
    else:
        found = every.groupBy("w").agg(F.count("*").alias("df")).join(asked, "w", "left_semi")
    spark = files.sparkSession
    coordinates = spark.createDataFrame(
        [(w, [v.get(w, 0.0) for _, v in vectors]) for w in vocabulary], "w string, at array<double>"
    )
    weights = stage(
        found.join(F.broadcast(coordinates), "w", "left").select(
            "w", (F.log(F.lit(1.0 + total) / (F.col("df") + 1)) + 1).alias("idf"), "at"
        ),
        "license-weights",
    )
    weighed = lookup_join(counts, weights, "w").withColumn("x", F.col("n") * F.col("idf"))
    norms = weighed.groupBy(*line, "size").agg(
        F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"),
        *[
            F.sum(F.col("x") * F.coalesce(F.col("at")[i], F.lit(0.0))).alias(f"c{i}")
            for i in range(len(vectors))
        ],
    )
    best = F.array_min(
        F.array(
            *[
                F.struct(
                    # Stretches are compared with texts alone.
                    F.when(
                        F.lit(i >= len(notices)) | (F.col("pos") >= -1),
                        -F.round(F.col(f"c{i}") / F.col("norm"), 6),
                    ).otherwise(0.0).alias("minus"),
                    F.lit(name).alias("name"),
                )
                for i, (name, _) in enumerate(vectors)
            ]
        )
    )
    size = lambda pos: F.coalesce(F.sum(F.when(pos, F.col("size"))), F.lit(0))
    # Lines of a matching passage count once.
    own = stage(
        norms.select(*line, "size", best.alias("best"))
        .filter(F.col("best.minus") <= -min_cosine)
        .groupBy(*file, "part")
        .agg(
            F.min("best").alias("best"),
            F.greatest(size(F.col("pos") >= 0), size(F.col("pos") == -1)).alias("size"),
            F.max(F.when(F.col("pos") < -1, F.col("size"))).alias("longest"),
        )
        .groupBy(*file)
        .agg(F.min("best").alias("best"), F.greatest(F.sum("size"), F.max("longest")).alias("size")),
        "own-licenses",
    )
    folders = (
        own.filter((F.col("size") >= F.col("chars") * file_share) & F.col("folder").isNotNull())
        .groupBy("folder", "best.name")
        .agg(F.count("*").alias("n"))
        .groupBy("folder")
        .agg(F.min(F.struct((-F.col("n")).alias("minus"), "name")).alias("best"))
        .select(F.col("folder").alias("above"), F.col("best.name").alias("inherited_license"))
    )
    sizes = stage(
        files.groupBy(F.col(folder_col).alias("folder")).agg(F.count("*").alias("n")).filter("folder is not null"),
        "folders",
    )
    steps = F.split("folder", "/", -1)
    ancestors = sizes.select(
        "folder",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size(steps)),
                lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(steps, 1, n), "/").alias("above")),
            )
        ).alias("a"),
    ).select("folder", "a.depth", "a.above")
    nearest = stage(
        ancestors.join(folders, "above")
        .groupBy("folder")
        .agg(F.max(F.struct("depth", "above", "inherited_license")).alias("got"))
        .select("folder", F.col("got.inherited_license"), F.col("got.above").alias("inherited_from")),
        "inherited",
    )
    placed = versioned.select("id", "version", "folder")
    judged = spread_join(placed, nearest, ["folder"], "left", counts=sizes)
    mine = own.select(F.col("id").alias("_id"), F.col("version").alias("_v"), F.col("folder").alias("_f"), "best")
    judged = judged.join(
        mine,
        F.col("id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_v")) & F.col("folder").eqNullSafe(F.col("_f")),
        "left",
    )
    without = F.col("best").isNull()
    return judged.select(
        F.col("id").alias(id_col),
        F.col("best.name").alias("own_license"),
        (-F.col("best.minus")).alias("cosine"),
        F.when(without, F.col("inherited_license")).alias("inherited_license"),
        F.when(without, F.col("inherited_from")).alias("inherited_from"),
        F.coalesce("best.name", "inherited_license").alias("license"),
    )

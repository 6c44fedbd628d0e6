"""License scan: Dice coefficient over word bigrams against licence templates (DataFrame operations only).

A text is cut into units: its lines, its paragraphs (between blank lines) and the whole text, each
different unit once. A unit's normalised form is its lower-cased runs of ASCII letters and digits;
its features are the distinct bigrams of these words. Dice = 2 * common / (unit + template); a unit
has the licence of its best template if that reaches ``THRESHOLD`` (ties: the template listed
first). A template is a candidate only if the unit's bigram count lies between the bounds that
allow the threshold, t / (2 - t) and (2 - t) / t times the template's.

Before any unit is cut, a text must hold one of the guard words. They are chosen from the templates
so that a unit without any of them can't have enough bigrams of any template in common
(``guard_words`` proves it for each), so the test drops no match.

Common bigrams come from an equi-join with the template bigrams, a table fixed by the templates
given (not by the data) and therefore broadcast.

Defined cases: null, empty and wordless texts and units of one word have no licence; repeated rows
give rows of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.llm.common import materialise

THRESHOLD = 0.8
LONG = 30

# Licence names, and notices or texts as their authors publish them.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."),
)

# Words too frequent in any prose to serve as guards while others do.
COMMON = frozenset("a all an and any are as at be but by can for free from has have if in is it may not of on one or other out shall such that the their this to under use used was were whether which will with without work you your 0 1 2 3 4 5".split())


def bigrams(text: str) -> set[str]:
    words = re.findall(r"[a-z0-9]+", text.lower())
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def size_bounds(size: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Unit sizes that can reach the threshold with a template of ``size`` bigrams."""
    return math.ceil(size * threshold / (2 - threshold) - 1e-9), math.floor(size * (2 - threshold) / threshold + 1e-9)


def guard_words(templates=TEMPLATES, threshold: float = THRESHOLD) -> list[str]:
    """Words such that a unit holding none of them misses the threshold for every template.

    A match needs at least t * (smallest unit + template) / 2 common bigrams. Words are added, those
    of everyday prose last, until each template has fewer bigrams without a guard word.
    """
    sets = [bigrams(text) for _, text in templates]
    guard: set[str] = set()
    while True:
        short = []
        for s in sets:
            need = math.ceil(threshold * (size_bounds(len(s), threshold)[0] + len(s)) / 2 - 1e-9)
            free = [b for b in s if not guard.intersection(b.split())]
            if len(free) >= need:
                short.append(free)
        if not short:
            return sorted(guard)
        cover = Counter(w for free in short for b in free for w in set(b.split()))
        guard.add(max(cover, key=lambda w: (w not in COMMON, cover[w], w)))


def _windows(texts: DataFrame, grams: DataFrame, threshold: float) -> DataFrame:
    """Rows (rid, doc_id, no, license, dice): the windows of long templates in ``texts`` (rid, doc_id, pairs)."""
    grams = F.broadcast(grams.where(F.col("t_size") >= LONG).withColumn("need", F.ceil(threshold * (F.col("low") + F.col("t_size")) / 2 - 1e-9).cast("int")).withColumn("reach", 2 * F.col("high")))
    keys = ["rid", "no", "t_size", "need", "reach", "low", "high", "license"]
    # Only a text with enough bigrams of a template goes further.
    some = texts.select("rid", F.explode(F.array_distinct("pairs")).alias("gram")).join(grams, "gram").groupBy("rid", "no", "need").count().where("count >= need")
    some = materialise(some.select("rid", "no"), "license-some")
    at = texts.join(some.select("rid").distinct(), "rid").select("rid", "doc_id", F.posexplode("pairs").alias("p", "gram"))
    at = materialise(at.withColumn("last", F.coalesce(F.lag("p").over(Window.partitionBy("rid", "gram").orderBy("p")), F.lit(-1))), "license-places")
    hits = at.join(grams, "gram").join(some, ["rid", "no"]).groupBy(*keys).agg(F.array_sort(F.collect_list("p")).alias("h"))
    starts = hits.withColumn("start", F.explode(F.filter("h", lambda x, i: F.get("h", i + F.col("need") - 1) - x < F.col("reach")))).drop("h")
    # Distinct bigrams from the start to each place are those whose last place lies before the start.
    own = F.broadcast(grams.select(F.col("no").alias("_no"), F.col("gram").alias("_gram")))
    seen = starts.join(at, "rid").where("p between start and start + reach - 1 and last < start")
    seen = seen.join(own, (F.col("no") == F.col("_no")) & (F.col("gram") == F.col("_gram")), "left")
    grown = Window.partitionBy("rid", "no", "start").orderBy("p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = seen.withColumn("n", F.count("*").over(grown)).withColumn("dice", 2 * F.count("_no").over(grown) / (F.col("n") + F.col("t_size")))
    best = seen.where(F.col("dice") >= threshold).groupBy("rid", "doc_id", "no", "license", "low", "start").agg(F.max(F.struct("dice", (-F.col("p")).alias("p"))).alias("b"))
    best = best.select("rid", "doc_id", "no", "license", "low", "start", (-F.col("b.p")).alias("stop"), F.col("b.dice").alias("dice"), F.struct("b.dice", (-F.col("no")).alias("no"), (-F.col("start")).alias("start")).alias("rank"))
    # Windows hold ``low`` bigrams or more, so those that start in the same or the next ``low`` places overlap: the best of each stretch, then of all that overlap.
    best = best.withColumn("top", F.max("rank").over(Window.partitionBy("rid", "no", F.floor(F.col("start") / F.col("low"))))).where("rank = top").drop("top")
    best = materialise(best, "license-windows")
    other = best.select(F.col("rid").alias("_rid"), F.col("start").alias("_start"), F.col("stop").alias("_stop"), F.col("rank").alias("_rank"))
    return best.join(other, F.expr("rid = _rid and start <= _stop and _start <= stop and _rank > rank"), "left_anti").select("rid", "doc_id", "no", "license", "dice")


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (doc_id, license, dice, n_units): the licences of each document, best Dice and number of units."""
    spark = docs.sparkSession
    grams = spark.createDataFrame([(i, name, len(s), *size_bounds(len(s), threshold), g) for i, (name, text) in enumerate(templates)
                                   for s in (bigrams(text),) for g in sorted(s)], "no int, license string, t_size int, low int, high int, gram string")
    guard = r"(?<![a-z0-9])(?:" + "|".join(guard_words(templates, threshold)) + r")(?![a-z0-9])"
    held = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.lower("text").alias("t")).where(F.col("t").rlike(guard))
    units = held.select("rid", "doc_id", "t", F.explode(F.array_distinct(F.concat(F.split("t", "\n"), F.split("t", r"\n\s*\n"), F.array("t")))).alias("u"))
    units = units.where(F.col("u").rlike(guard)).select("rid", "doc_id", F.xxhash64("u", F.length("u")).alias("unit"), (F.col("u") == F.col("t")).alias("whole"), F.filter(F.split("u", "[^a-z0-9]+"), lambda w: w != "").alias("w"))
    units = materialise(units, "license-units")  # the few units with a guard word; what follows reads their words several times
    # Words beside their successors; an index into the words inside a lambda would split the unit anew for each.
    pairs = F.zip_with(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, F.size("w")), lambda a, b: F.concat_ws(" ", a, b))
    windows = _windows(units.where("whole").select("rid", "doc_id", pairs.alias("pairs")), grams, threshold)
    units = units.select("rid", "doc_id", "unit", F.array_distinct(pairs).alias("g")).withColumn("u_size", F.size("g"))
    least, most = (f(b) for f, b in ((min, [size_bounds(len(bigrams(t)), threshold)[0] for _, t in templates]), (max, [size_bounds(len(bigrams(t)), threshold)[1] for _, t in templates])))
    units = units.where(F.col("u_size").between(least, most)).select("rid", "doc_id", "unit", "u_size", F.explode("g").alias("gram"))
    common = units.join(F.broadcast(grams), "gram").where("u_size between low and high")
    dice = common.groupBy("rid", "doc_id", "unit", "no", "license").agg((2 * F.count("*") / F.first(F.col("u_size") + F.col("t_size"))).alias("dice")).where(F.col("dice") >= threshold)
    best = dice.groupBy("rid", "doc_id", "unit").agg(F.max(F.struct(F.col("dice"), (-F.col("no")).alias("first"), F.col("license"))).alias("b"))
    best = best.select("rid", "doc_id", (-F.col("b.first")).alias("no"), "b.license", "b.dice")
    best = materialise(best, "license-best")
    best = best.unionByName(windows.join(best.select("rid", "no"), ["rid", "no"], "left_anti"))
    return best.groupBy("rid", "doc_id", "license").agg(F.round(F.max("dice"), 6).alias("dice"), F.count("*").alias("n_units")).drop("rid")

"""Licence notices in texts: Dice coefficient of word bigrams against templates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import let, table

WARRANTY_MIT = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
CONDITIONS_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution."
)
THIRD_BSD = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission."
)
WARRANTY_BSD = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
#: Notices that licences ask for, or that are in use for them, and whole texts of the short ones, by SPDX
#: name. Long licences (GPL, Apache, MPL) quote their notice at the end, where a passage of a whole copy matches it.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. " + WARRANTY_MIT,
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in "
        "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in "
        "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "LGPL-3.0",
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public "
        "License, supplemented by the additional permissions listed below.",
    ),
    (
        "LGPL-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This library is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", CONDITIONS_BSD + THIRD_BSD + WARRANTY_BSD),
    ("BSD-2-Clause", CONDITIONS_BSD + WARRANTY_BSD),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        'the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS '
        "ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
        "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA "
        "OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
#: least Dice coefficient, in hundredths
LEAST = 85


def words_of(text: str) -> list[str]:
    """A template's words; the texts' come by the same rule in SQL."""
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def bigrams_of(text: str) -> list[str]:
    words = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def anchors(templates: list[list[str]], least: int) -> list[str]:
    """Words of which a unit holds at least one if it matches any of these templates, given by their bigrams.

    A match shares least / (200 - least) of a template's bigrams or more, so words that make up more than the rest of
    them cannot all be missing. Words that make up most come first, short ones last, as these are in other words too.
    """
    chosen: set[str] = set()
    for one in sorted(templates, key=len):
        may_miss = len(one) * (1 - least / (200 - least))
        rest = [set(b.split()) for b in one if not chosen & set(b.split())]
        while one and len(one) - len(rest) <= may_miss:
            words = {w for b in rest for w in b}
            best = min(words, key=lambda w: (len(w) < 5, not w.isalpha(), -sum(w in b for b in rest), -len(w), w))
            chosen.add(best)
            rest = [b for b in rest if best not in b]
    return sorted(chosen)


def _matches(unit: Column, known: Column, every: Column, least: int) -> Column:
    """(dice, licence) of the templates that a unit is close to."""

    def pairs(s: Column) -> Column:
        n = F.size(s["w"])
        made = F.transform(F.slice(s["w"], F.lit(1), F.greatest(F.lit(0), n - 1)), lambda w, i: F.concat(w, F.lit(" "), F.get(s["w"], i + 1)))
        return let({"b": F.array_distinct(made)}, lambda t: F.when(F.arrays_overlap(t["b"], every), close(t["b"])))

    def close(b: Column) -> Column:
        # |A & B| is at most the smaller size, so a template of far other size cannot reach the least coefficient
        n = F.size(b)
        fits = F.filter(known, lambda t: F.least(n, t["size"]) * 200 >= (n + t["size"]) * least)
        both = F.transform(
            fits,
            lambda t: F.struct(
                F.size(F.array_intersect(b, t["bigrams"])).alias("common"), (n + t["size"]).alias("sizes"), t["licence"].alias("licence")
            ),
        )
        found = F.filter(both, lambda m: m["common"] * 200 >= m["sizes"] * least)
        return F.transform(found, lambda m: F.struct((m["common"] * 2 / m["sizes"]).alias("dice"), m["licence"].alias("licence")))

    plain = F.trim(F.regexp_replace(F.lower(unit), r"[^\p{L}\p{N}]+", " "))
    return let({"w": F.split(plain, " ")}, pairs)


#: bigrams of a passage, repeats counted, for each different one that it may hold
REPEATS = 4


def _passages(text: Column, known: Column, every: Column, least: int) -> Column:
    """(dice, licence) of the passages close to a template, the best of each overlapping span.

    A passage starts and ends with a bigram of the template. From every such bigram one grows until it holds more
    different bigrams than a match may, or `REPEATS` times as many with repeats; what counts is where its coefficient,
    over different bigrams, is highest, and last of equals. A bigram is new to a passage if it came last before its start.
    """

    def pairs(s: Column) -> Column:
        n = F.size(s["w"])
        return F.transform(F.slice(s["w"], F.lit(1), F.greatest(F.lit(0), n - 1)), lambda w, i: F.concat(w, F.lit(" "), F.get(s["w"], i + 1)))

    def before(b: Column) -> Column:
        """For each bigram the place of the same one before it, or -1."""
        by_word = F.array_sort(F.transform(b, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def linked(s: Column) -> Column:
            same = lambda e, k: F.get(s["o"], k - 1)["x"] == e["x"]
            found = F.transform(s["o"], lambda e, k: F.struct(e["i"].alias("i"), F.when((k > 0) & same(e, k), F.get(s["o"], k - 1)["i"]).otherwise(-1).alias("p")))
            return F.transform(F.array_sort(found), lambda e: e["p"])

        return let({"o": by_word}, linked)

    def near(s: Column) -> Column:
        # a match shares least / (200 - least) of a template's bigrams or more
        some = lambda t: (t["size"] > 0) & (F.size(F.array_intersect(s["c"], t["bigrams"])) * (200 - least) >= t["size"] * least)
        none = F.array().cast(FOUND)

        def at(u: Column) -> Column:
            return F.when(F.size(u["t"]) > 0, let({"p": before(s["b"])}, lambda v: F.flatten(F.transform(u["t"], lambda t: of_template(s["b"], v["p"], t))))).otherwise(none)

        return let({"t": F.filter(known, some)}, at)

    def of_template(b: Column, p: Column, t: Column) -> Column:
        places = F.zip_with(b, p, lambda x, last: F.struct(F.array_contains(t["bigrams"], x).alias("hit"), last.alias("last")))
        longest = F.floor(t["size"] * (200 - least) / least).cast("int")
        return let({"z": F.transform(places, lambda x, i: F.struct(i.alias("i"), x["hit"].alias("hit"), x["last"].alias("last"))), "longest": longest}, lambda s: from_hits(t, s))

    def from_hits(t: Column, s: Column) -> Column:
        def grown(start: Column) -> Column:
            def step(state: Column, x: Column) -> Column:
                new = x["last"] < start["i"]
                d, c = state["d"] + new.cast("int"), state["c"] + (new & x["hit"]).cast("int")
                better = new & x["hit"] & (d <= s["longest"]) & (c * (state["of"] + t["size"]) >= state["best"] * (d + t["size"]))
                return F.struct(
                    d.alias("d"), c.alias("c"), F.when(better, c).otherwise(state["best"]).alias("best"),
                    F.when(better, d).otherwise(state["of"]).alias("of"), F.when(better, x["i"]).otherwise(state["end"]).alias("end"),
                )

            zero = F.struct(F.lit(0).alias("d"), F.lit(0).alias("c"), F.lit(0).alias("best"), F.lit(0).alias("of"), F.lit(-1).alias("end"))
            window = F.slice(s["z"], start["i"] + 1, s["longest"] * REPEATS)
            return F.aggregate(window, zero, step, lambda r: F.struct(r["best"].alias("c"), r["of"].alias("d"), start["i"].alias("start"), r["end"].alias("end")))

        spans = F.transform(F.filter(s["z"], lambda x: x["hit"]), grown)
        close = F.filter(spans, lambda m: m["c"] * 200 >= (m["d"] + t["size"]) * least)
        return F.transform(
            close,
            lambda m: F.struct(
                (m["c"] * 2 / (m["d"] + t["size"])).alias("dice"), (m["end"] - m["start"]).alias("length"),
                m["start"].alias("start"), m["end"].alias("end"), t["licence"].alias("licence"),
            ),
        )

    def keep(kept: Column, m: Column) -> Column:
        meets = F.exists(kept, lambda k: (k["start"] <= m["end"]) & (m["start"] <= k["end"]))
        return F.when(meets, kept).otherwise(F.concat(kept, F.array(m)))

    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    found = let({"w": F.split(plain, " ")}, lambda s: let({"b": pairs(s)}, lambda u: let({"b": u["b"], "c": F.array_intersect(u["b"], every)}, near)))
    best = F.aggregate(F.sort_array(found, asc=False), F.array().cast(FOUND), keep)
    return F.transform(best, lambda m: F.struct(m["dice"].alias("dice"), m["licence"].alias("licence")))


FOUND = "array<struct<dice:double,length:int,start:int,end:int,licence:string>>"


def licences(
    docs: DataFrame,
    columns: tuple[str, ...] | None = None,
    templates: list[tuple[str, str]] | None = None,
    least: int = LEAST,
    anywhere: bool = False,
) -> DataFrame:
    """`licences` (names found, sorted, joined by commas) and `best_dice` added to these columns of every document.

    Lines, paragraphs and the whole text are each lowered, cut into words of letters and digits, and compared with the
    templates by the Dice coefficient of their sets of word bigrams; `least` hundredths are a match. All units of all
    texts are looked at, in their row: nothing is shuffled. Units without any of the words that a match cannot do without
    (`anchors`) go no further. Null or empty text, and units of one word, match nothing:
    empty string, 0. Input columns named licences or best_dice are replaced.

    With `anywhere`, passages of the text count instead, wherever they start and end, across lines and paragraphs and
    within them: from each bigram of a template to the one up to which the coefficient is highest, repeats counting once,
    and of passages that overlap the one with the highest coefficient, then the longest, the last, the last by name. A
    passage holds at most `REPEATS` bigrams for each different one that a match may hold.
    """
    columns = [c for c in (columns or docs.columns) if c not in ("licences", "best_dice")]
    known = [(name, bigrams_of(text)) for name, text in (TEMPLATES if templates is None else templates)]
    lines = F.split("text", "\n")
    units = F.array_distinct(F.concat(lines, F.split("text", r"\n[\x20\t\r]*\n"), F.array("text")))
    needed = anchors([b for _, b in known], least)

    def likely(unit: Column) -> Column:
        return let({"low": F.lower(unit)}, lambda s: reduce(lambda a, b: a | b, [F.contains(s["low"], F.lit(w)) for w in needed], F.lit(False)))

    struct = "array<struct<dice:double,licence:string>>"
    if known:
        literal = F.array(*[F.struct(F.lit(n).alias("licence"), F.lit(b).alias("bigrams"), F.lit(len(b)).alias("size")) for n, b in known])
        every = F.lit(sorted({b for _, one in known for b in one}))
        if anywhere:
            matched = _passages(F.col("text"), literal, every, least)
        else:
            matched = F.flatten(F.transform(F.filter(units, likely), lambda u: F.coalesce(_matches(u, literal, every, least), F.array().cast(struct))))
        found = F.when(likely(F.col("text")), matched)
    else:
        found = F.array().cast(struct)
    numbered = docs.toDF(*[f"__{i}" for i in range(len(docs.columns))])
    kept = [f"__{docs.columns.index(c)}" for c in columns]
    rows = numbered.withColumn("text", F.col(f"__{docs.columns.index('text')}"))
    rows = rows.withColumn("__found", F.coalesce(found, F.array().cast(struct)))
    names = F.array_sort(F.array_distinct(F.transform("__found", lambda m: m["licence"])))
    best = F.coalesce(F.array_max(F.transform("__found", lambda m: m["dice"])), F.lit(0.0))
    out = rows.select(*kept, F.array_join(names, ",").alias("__names"), best.alias("__best"))
    return out.toDF(*columns, "licences", "best_dice")


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences(table(spark, sf_dir, "documents"), ("doc_id",), anywhere=True)

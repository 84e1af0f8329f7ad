"""Operator 1: licence scans.

The units of a file are its lines, its blocks of lines (between blank lines, so a header
or a paragraph that wraps over lines) and the file as a whole.  Units are compared with
templates by sparse TF-IDF cosine: terms are sorted and counted, weighted with document
frequencies of the templates (a term of none has the largest weight; a repeated term
counts 1 + log of its count) and looked up among the templates' terms.

Two bounds keep other units out, and lose none: by Cauchy-Schwarz the cosine is at most
the root of the share of a template's squared weights that lie on terms the unit
holds.  So a unit must hold one of the *telling* terms of a template, its rare ones
without which the share is too small (a test of its words), and then terms of enough
weight.  All of a unit's terms stand in one row, so its cosines are expressions on that
row; what is shuffled and written are keys, numbers and licence names.

A file's own licence is its best unit's.  A file that is little else than this unit, or
is named like a licence file, is the licence file of its directory.  Files without a
licence of their own take that of the nearest directory above them that has a licence
file: directories are resolved once by a join with the exploded paths of their
ancestors, and files join their directory.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .corpus_io import written

# Notices, header texts and short licences in full.  Long licences are known by
# these; ``scan`` takes other templates, whole texts too.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
            " documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES
OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission."""),
    ("Zlib", """This software is provided as-is, without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions"""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("GPL-2.0", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version."""),
    ("GPL-2.0", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later
version."""),
    ("LGPL-3.0", """This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
any later version."""),
    ("AGPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
any later version."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)

LICENCE_NAME = "(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"
TERM_CUT = "[^a-z0-9]+"
#: Between the blocks of a text.
BLANK_LINES = r"\n[ \t\r\n]*\n"


#: Words that most English texts hold: they tell of a template only where the others aren't enough.
COMMON = frozenset("a all an and any are as at be but by can do for from if in into is it its may more must no not of on one or "
                   "other out see so that the this to use used was will with work you your".split())


@dataclass(frozen=True)
class Rule:
    """Least cosine of a match, and least share of its words that makes a file a licence file."""

    cosine: float = 0.65
    file_share: float = 0.5


@dataclass(frozen=True)
class Weights:
    """Inverse document frequencies over the templates, each template's unit vector, and the telling terms."""

    idf: dict[str, float]
    unknown: float
    vectors: list[dict[str, float]]
    telling: list[str]


def weights(texts: Sequence[str], cosine: float) -> Weights:
    """Weights of the templates; a unit without telling terms has a cosine under ``cosine`` with all of them."""
    counts = [Counter(t for t in re.split(TERM_CUT, text.lower()) if t) for text in texts]
    df = Counter(t for c in counts for t in c)
    idf = {t: math.log((1 + len(texts)) / (1 + n)) + 1 for t, n in df.items()}
    vectors, telling = [], set()
    for c in counts:
        v = {t: (1 + math.log(n)) * idf[t] for t, n in c.items()}
        norm = math.sqrt(sum(w * w for w in v.values()))
        v = {t: w / norm for t, w in v.items()}
        vectors.append(v)
        rest = 1.0
        for t in sorted(v, key=lambda t: (t in COMMON, -idf[t], t)):
            if rest < cosine * cosine - 1e-6:
                break
            telling.add(t)
            rest -= v[t] ** 2
    return Weights(idf, math.log(1 + len(texts)) + 1, vectors, sorted(telling))


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), TERM_CUT), lambda t: t != "")


def _words(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))


def units(text: Column) -> Column:
    """Lines, blocks of several lines, and a text of several lines as a whole."""
    blocks = F.filter(F.split(text, BLANK_LINES), lambda b: b.contains("\n"))
    return F.concat(F.split(text, "\n"), blocks, F.when(text.contains("\n"), F.array(text)).otherwise(F.array().cast("array<string>")))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _by_term(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def _least(vector: dict[str, float], bound: float) -> int:
    """Fewest of a template's terms whose squared weights can reach ``bound``: units with fewer need no sums."""
    share = 0.0
    for n, w in enumerate(sorted(vector.values(), reverse=True), start=1):
        share += w * w
        if share >= bound - 1e-9:
            return n
    return len(vector)


def _best(terms: Column, known: Weights, names: Sequence[str], cosine: float) -> Column:
    """A unit's best licence as (minus its cosine, licence), NULL if none reaches ``cosine``; equal cosines: the lesser name."""
    own, idf = F.lit(sorted(known.idf)), _by_term(known.idf)
    bound = cosine ** 2 - 1e-6
    vectors = F.array(*[F.struct(F.lit(n).alias("licence"), F.lit(list(v)).alias("terms"), F.lit(_least(v, bound)).alias("least"),
                                 _by_term(v).alias("tw"), _by_term({t: w * w for t, w in v.items()}).alias("squares"))
                        for n, v in zip(names, known.vectors)])
    unknown = known.unknown

    def total(items: Column, term) -> Column:
        return F.aggregate(items, F.lit(0.0), lambda at, x: at + term(x))

    def within_reach(hits: Column) -> Column:
        # the bound: templates of whose squared weights the unit holds enough
        return F.filter(vectors, lambda v: (F.size(F.array_intersect(hits, v["terms"])) >= v["least"])
                        & (total(hits, lambda h: F.coalesce(v["squares"][h], F.lit(0.0))) >= bound))

    def counted(s: Column) -> Column:
        # the runs of equal terms in sorted ones: (term, 1 + log of its count)
        first = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return _let(first, lambda f: F.transform(f, lambda at, k: F.struct(
            F.get(s, at).alias("term"), (1 + F.log(F.coalesce(F.get(f, k + 1), F.size(s)) - at)).alias("tf"))))

    def judged(runs: Column, hits: Column, near: Column) -> Column:
        held = _let(F.map_from_entries(runs), lambda m: F.transform(hits, lambda h: F.struct(
            h.alias("term"), m[h].alias("tf"), idf[h].alias("idf"))))
        return _let(held, lambda ks: _let(
            F.sqrt(total(runs, lambda r: r["tf"] * r["tf"]) * unknown ** 2
                   + total(ks, lambda k: k["tf"] * k["tf"] * (k["idf"] * k["idf"] - unknown ** 2))),
            lambda norm: F.transform(near, lambda v: F.struct(
                (-F.round(total(ks, lambda k: k["tf"] * k["idf"] * F.coalesce(v["tw"][k["term"]], F.lit(0.0))) / norm, 6)).alias("c"),
                v["licence"].alias("licence")))))

    def unit(ts: Column) -> Column:
        return _let(F.array_intersect(ts, own), lambda hits: _let(within_reach(hits), lambda near: F.when(
            F.size(near) > 0, _let(F.array_sort(ts), lambda s: _let(counted(s), lambda runs: F.array_min(
                F.filter(judged(runs, hits, near), lambda x: x["c"] <= -cosine)))))))

    return _let(terms, unit)


def scan(docs: DataFrame, path: Column, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text",
         templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row for each file: ``doc_id, path, licence, origin, cosine, origin_dir``.

    ``origin`` is ``own``, ``inherited`` or ``none``.  Equal cosines go to the
    licence whose name is the lesser.  A null text has no licence of its own; a
    null path counts as a file in the root directory; repeated rows are scanned
    each; an empty table gives an empty result; other columns are not looked at.
    ``templates`` are licences and texts, held by the driver.
    """
    spark = docs.sparkSession
    known = weights([t for _, t in templates], rule.cosine)
    telling = F.lit(known.telling)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(path, F.lit("")).alias("path"), text.alias("_t"))
    rows = rows.withColumn("dir", F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.lit("")))
    # a file is named by its path and text; rows that agree in both have the same licence
    rows = rows.withColumn("key", F.xxhash64("path", "_t"))
    files = rows.select("doc_id", "path", "dir", "key")
    # a unit is judged in the row that holds it: no text is shuffled or written
    units_of = (rows.filter(F.arrays_overlap(F.split(F.lower("_t"), TERM_CUT), telling))
                # words and units stand before the generator, so that no unit carries its file's text
                .select("key", "path", "dir", _words(F.col("_t")).alias("words"), units(F.col("_t")).alias("units"))
                .select("key", "path", "dir", "words", F.posexplode("units").alias("unit", "text"))
                .filter(F.arrays_overlap(F.split(F.lower("text"), TERM_CUT), telling)))
    judged = units_of.select("key", "path", "dir", "words", "unit", _words(F.col("text")).alias("unit_words"),
                             _best(_terms(F.col("text")), known, [n for n, _ in templates], rule.cosine).alias("found"))
    # filtered after it is written: a filter before would be pushed below and judge each unit twice; equal files have equal units
    near = written(judged, "licence-units").filter(F.col("found").isNotNull())
    best = near.groupBy("key").agg(F.min(F.struct(F.col("found.c").alias("c"), F.col("found.licence").alias("licence"), "unit")).alias("best"))
    near = near.dropDuplicates(["key", "unit"])
    own = near.join(best, "key").filter("unit = best.unit").select(
        "key", "path", "dir", "words", F.col("best.licence").alias("own"), (-F.col("best.c")).alias("own_cosine"),
        F.col("unit_words").alias("line_words"))
    own = written(own, "licence-own")
    is_file = (F.col("line_words") >= rule.file_share * F.col("words")) | F.col("path").rlike(LICENCE_NAME)
    by_dir = own.filter(is_file).groupBy("dir").agg(F.min(F.struct((-F.col("own_cosine")).alias("c"), "own")).alias("f"))
    by_dir = by_dir.select(F.col("dir").alias("above"), F.col("f.own").alias("licence"), (-F.col("f.c")).alias("cosine"))
    # every directory meets those above it; the deepest with a licence file is kept
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(parts))),
                        lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    dirs = files.select("dir").distinct().withColumn("above", F.explode(above))
    found = dirs.join(by_dir, "above").groupBy("dir").agg(
        F.max(F.struct(F.length("above").alias("depth"), "above", "licence", "cosine")).alias("d"))
    out = (files.select("doc_id", "path", "dir", "key").join(own.select("key", "own", "own_cosine"), "key", "left")
           .join(found, "dir", "left"))
    return out.select(
        "doc_id", "path", F.coalesce("own", "d.licence").alias("licence"),
        F.when(F.col("own").isNotNull(), "own").when(F.col("d").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.coalesce("own_cosine", "d.cosine").alias("cosine"),
        F.when(F.col("own").isNotNull(), F.col("dir")).otherwise(F.col("d.above")).alias("origin_dir"))

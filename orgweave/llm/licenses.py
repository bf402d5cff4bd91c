"""Licence scans: a trained paragraph classifier. DataFrame functions only over the texts.

Paragraphs are lines. Sparse word uni- and bigrams feed a multinomial logistic regression
over licence families and an unknown class. Its probabilities are calibrated by a
temperature, fitted on templates that the folds of a cross-validation kept apart. A
prediction counts when a template of its family confirms it, in the order of its words:

- as a notice: the paragraph has 60 % of the template's neighbouring pairs of words, and
  half of the words and pairs that no other family's templates have, or
- as a piece of a longer text: six words or more, 80 % of whose pairs the template has, and
  one of them or its words is its family's own.

The guard words are chosen so that without them all, too few pairs are left of any template
to confirm it as a notice. So the paragraphs without one, and without the words and pairs
of a piece, would be unknown whatever their prediction, and need no score.
"""

from __future__ import annotations

import json
import random
import re
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, table, unused

UNKNOWN = "unknown"
# Notices and passages of published licences, by family.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license",
        "This project is licensed under the terms of the MIT license.",
        "The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "ISC": [
        "Released under the ISC License.",
        "Licensed under the ISC license",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ],
    "Zlib": [
        "Licensed under the zlib License.",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
        "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD license",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache 2.0 license",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may not use this file except in compliance with the License.",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work for additional information regarding copyright ownership.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GPL version 2 or later",
        "Licensed under GPLv3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "Released under the LGPL license",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "Released under the AGPL license",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ],
    "MPL": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "This Source Code Form is \"Incompatible With Secondary Licenses\", as defined by the Mozilla Public License, v. 2.0.",
    ],
    "EPL": [
        "Licensed under the Eclipse Public License 2.0.",
        "Released under the EPL license",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (\"AGREEMENT\"). ANY USE, REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT.",
    ],
    "EUPL": [
        "Licensed under the European Union Public Licence, version 1.2.",
        "Licensed under the EUPL, Version 1.2 or later",
        "Licensed under the EUPL, Version 1.1 or - as soon they will be approved by the European Commission - subsequent versions of the EUPL (the \"Licence\");",
        "You may not use this work except in compliance with the Licence.",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software",
    ],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "Except where otherwise noted, content on this site is licensed under a Creative Commons Attribution 4.0 International license."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Text is available under the Creative Commons Attribution-ShareAlike License"],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ],
    "CC-BY-ND": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "Public-Domain": [
        "Dedicated to the public domain under CC0 1.0 license.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "Released under the Unlicense license",
    ],
    "Proprietary": [
        "All rights reserved.", "Copyright 2020 Example Corporation. All rights reserved.", "Proprietary and confidential; unauthorized copying is prohibited without license.",
        "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
    ],
    UNKNOWN: [
        "The driver showed her license to the officer.", "A fishing license is needed at the lake.", "The terms were agreed by all parties.", "He is licensed to practise law.",
        "Their rights were respected by the court.", "Public transport is free of charge on Sundays.", "The general was known to the public.", "Apache helicopters flew over the hills.",
        "The work is under way and will be done soon.", "Version two of the plan was better than the first.", "Permission to land was given.", "They reserved a table for four.",
        "Copyright law is taught in the second year.", "MIT and other universities took part.", "The foundation was laid in spring.", "This is not about a license at all, but about the people who work here.",
        "Music rights are sold by the year.", "The library is open to the public.", "She may use the source of the river as a mark.", "Creative people in common rooms.",
        "The software was distributed to all schools in the district last autumn.", "Any person may attend the meeting without charge, subject to space.", "The warranty covers parts and labour for two years after purchase.",
        "Redistribution of wealth is a subject of debate in every election.", "The court held that the company was liable for damages arising from the accident.", "Please retain your receipt and the list of conditions for the journey.",
        "Conditions in binary star systems are hard to reproduce in the laboratory.", "The author disclaims any connection with the events described in the novel.", "Members may copy the form and distribute it among their neighbours.",
        "An eclipse is visible to the public from the terrace.", "The European Union published new terms for the licence fee.", "A boost to the economy was expected by the commission.", "The GNU is a large antelope of the plains.",
        "Contributors to the journal are paid by the page.", "The publisher reserved the right to change the programme.", "The domain is public, but the road to it is private.", "Use of the pool is governed by the rules on the board.",
        "Without limitation of speed the road was dangerous.", "She granted the request free of any condition.", "No event shall take place in the hall after ten.",
    ],
}
_FILL = ["the", "of", "and", "in", "to", "on", "for", "by", "from", "a", "work", "file", "text", "code", "document", "author", "year", "2019", "2021", "2024", "company", "team", "this", "see", "notice", "project", "data"]
#: Shares of a template's pairs, of its own n-grams, and of a piece's pairs, that confirm;
#: words of a piece; least probability.
COVER, OWN, PIECE, PIECE_WORDS, CERTAIN = 0.6, 0.5, 0.8, 6, 0.4
FOLDS = 3


def words_of(text: str) -> list[str]:
    """As _words() does: runs of letters, digits and - of the A-Z lower-cased text."""
    return re.findall(r"[a-z0-9][a-z0-9.-]*[a-z0-9]|[a-z0-9]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def pairs_of(words: list[str]) -> list[str]:
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def grams_of(words: list[str]) -> list[str]:
    return list(dict.fromkeys(words + pairs_of(words)))


def _examples(rng: random.Random, n: int, skip=lambda k: False) -> tuple[list[list[str]], list[int]]:
    """Variants of the templates: words dropped, pieces cut out, filler around them. Of the
    unknown class also licence words out of order. skip: numbers of templates to leave out."""
    xs, ys, number = [], [], 0
    bag = sorted({w for f, ts in TEMPLATES.items() if f != UNKNOWN for t in ts for w in words_of(t)})
    for y, family in enumerate(TEMPLATES):
        for t in TEMPLATES[family]:
            number += 1
            for k in range(0 if skip(number) else n):
                w = words_of(t)
                if k and family != UNKNOWN:
                    if len(w) > 16 and k % 3 == 0:
                        at = rng.randrange(len(w) - 10)
                        w = w[at : at + rng.randrange(10, 16)]
                    w = [x for x in w if len(w) < 6 or rng.random() > 0.06]
                    w = [rng.choice(_FILL) for _ in range(rng.randrange(6))] + w + [rng.choice(_FILL) for _ in range(rng.randrange(6))]
                elif k % 3 == 2:
                    w = rng.sample(bag, rng.randrange(4, 16))
                elif k:
                    w = rng.sample(w, max(1, len(w) - 2)) + rng.sample(_FILL, rng.randrange(1, 8))
                xs.append(grams_of(w))
                ys.append(y)
    return xs, ys


def _matrix(rows: list[list[str]], vocab: dict[str, int]) -> np.ndarray:
    m = np.zeros((len(rows), len(vocab)), np.float32)
    for i, x in enumerate(rows):
        m[i, [vocab[g] for g in x if g in vocab]] = 1 / np.sqrt(max(len(x), 1))
    return m


def _soft(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _fit(x: np.ndarray, ys: list[int], classes: int, steps: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """Gradient descent with momentum on the mean loss of the rows."""
    y = np.eye(classes, dtype=np.float32)[ys]
    w, b = np.zeros((x.shape[1], classes), np.float32), np.zeros(classes, np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(steps):
        e = (_soft(x @ w + b) - y) / len(x)
        vw = 0.8 * vw - 12 * (x.T @ e + 1e-4 * w)
        vb = 0.8 * vb - e.sum(0)
        w, b = w + vw, b + vb
    return w, b


@cache
def model() -> tuple[list[str], dict[str, list[float]], list[float]]:
    """(families, weights by n-gram, biases), the temperature divided out.

    Fitted on the driver on variants of the templates, a fixed number of rows; the fit
    depends on no table and is the same in every session. The temperature is the one by
    which the templates of each fold, scored by a fit on the others, are likeliest.
    """
    families = list(TEMPLATES)
    held = []
    for fold in range(FOLDS):
        xs, ys = _examples(random.Random(5), 4, lambda k: k % FOLDS == fold)
        vx, vy = _examples(random.Random(11), 2, lambda k: k % FOLDS != fold)
        vocab = {g: i for i, g in enumerate(sorted({g for x in xs for g in x}))}
        w, b = _fit(_matrix(xs, vocab), ys, len(families))
        held.append((_matrix(vx, vocab) @ w + b, vy))
    loss = lambda t: sum(-np.log(_soft(z / t)[np.arange(len(y)), y] + 1e-12).sum() for z, y in held)
    heat = min((0.25 * k for k in range(1, 25)), key=loss)
    xs, ys = _examples(random.Random(5), 10)
    vocab = {g: i for i, g in enumerate(sorted({g for x in xs for g in x}))}
    w, b = _fit(_matrix(xs, vocab), ys, len(families))
    return families, {g: [round(float(v) / heat, 3) for v in w[i]] for g, i in vocab.items()}, [round(float(v) / heat, 4) for v in b]


def needed(n: int) -> int:
    """Pairs of a template of n that confirm a notice."""
    return next(k for k in range(n + 1) if k >= COVER * n)


@cache
def shapes() -> list[dict]:
    """Of every template: family f, pairs p, own n-grams o that no other family has."""
    of: dict[str, set[str]] = {}
    known = [(f, words_of(t)) for f, ts in TEMPLATES.items() if f != UNKNOWN for t in ts]
    for f, w in known:
        for g in grams_of(w):
            of.setdefault(g, set()).add(f)
    return [{"f": f, "p": pairs_of(w), "o": [g for g in grams_of(w) if of[g] == {f}]} for f, w in known]


@cache
def guards() -> list[str]:
    """Words that leave every template too few pairs without them: picked one after the other,
    each time the word that takes most pairs from templates that still have enough, longer
    and so rarer words before shorter ones."""
    left = [(set(s["p"]), needed(len(s["p"]))) for s in shapes()]
    out: list[str] = []
    while any(len(p) >= n for p, n in left):
        gain: dict[str, float] = {}
        for p, n in left:
            if len(p) >= n:
                for pair in p:
                    for w in set(pair.split(" ")):
                        gain[w] = gain.get(w, 0) + min(1.0, 1 / (len(p) - n + 1)) * (0.02 if len(w) < 5 else 0.2 if len(w) < 6 else 1.0)
        best = max(gain, key=lambda w: (gain[w], len(w), w))
        out.append(best)
        left = [({x for x in p if best not in x.split(" ")}, n) for p, n in left]
    return out


@cache
def marks() -> list[str]:
    """Words of which every n-gram that is a family's own has one: the own words, and of the own
    pairs without such a word the longer one. A line without them is no piece."""
    own = {g for s in shapes() for g in s["o"]}
    out = {g for g in own if " " not in g}
    out |= {max(g.split(" "), key=lambda w: (len(w), w)) for g in own if not out & set(g.split(" "))}
    return sorted(out)


def _words(line: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(line), F.lit(r"[a-z0-9](?:[a-z0-9.-]*[a-z0-9])?"), F.lit(0))


def _pairs(w: Column) -> Column:
    n = F.greatest(F.size(w) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(w, 1, n), F.slice(w, 2, n), lambda a, b: F.concat_ws(" ", a, b)))


def scan(docs: DataFrame, text: str = "text", out: str = "licenses") -> DataFrame:
    """docs with array<struct<line, family, probability, confirmed>>, one for each line with a
    guard word or the pairs of a piece: line counts from 0, family is the calibrated prediction, or 'unknown' where
    it isn't certain or no template confirms it. Of classes that tie the first one counts.

    Null and empty texts have none; an empty table gives an empty one. Very long lines are
    scored like others, by all their n-grams. Repeated rows have equal results. A column of
    the input called as out is replaced; others stay.
    """
    families, weights, bias = model()
    table_of = F.from_json(F.lit(json.dumps(weights)), "map<string,array<double>>")
    templates = F.from_json(F.lit(json.dumps(shapes())), "array<struct<f:string,p:array<string>,o:array<string>>>")
    names = F.array(*map(F.lit, families))
    start = F.array(*(F.lit(v) for v in bias))

    def told(x: Column) -> Column:
        return F.struct(x["line"].alias("line"), x["w"].alias("w"), _pairs(x["w"]).alias("p"))

    def grams(x: Column) -> Column:
        g = F.array_distinct(F.concat(x["w"], x["p"]))
        v = F.filter(F.transform(g, lambda k: F.try_element_at(table_of, k)), lambda v: v.isNotNull())
        return F.struct(x["line"].alias("line"), F.size(x["w"]).alias("n"), x["p"].alias("p"), g.alias("g"), F.sqrt(F.greatest(F.size(g), F.lit(1))).alias("norm"), v.alias("v"))

    def logits(x: Column) -> Column:
        z = F.aggregate(x["v"], start, lambda a, v: F.zip_with(a, v, lambda p, q: p + q / x["norm"]))
        return F.struct(x["line"].alias("line"), x["n"].alias("n"), x["p"].alias("p"), x["g"].alias("g"), z.alias("z"))

    def best(x: Column) -> Column:
        top = F.array_max(x["z"])
        p = 1 / F.aggregate(x["z"], F.lit(0.0), lambda a, v: a + F.exp(v - top))
        return F.struct(x["line"].alias("line"), x["n"].alias("n"), x["p"].alias("p"), x["g"].alias("g"), p.alias("sure"), F.element_at(names, F.array_position(x["z"], top).cast("int")).alias("f"))

    def confirms(t: Column, x: Column) -> Column:
        common, own = F.size(F.array_intersect(t["p"], x["p"])), F.size(F.array_intersect(t["o"], x["g"]))
        notice = (common >= COVER * F.size(t["p"])) & (own >= OWN * F.size(t["o"]))
        piece = (x["n"] >= PIECE_WORDS) & (common >= PIECE * F.size(x["p"])) & (own > 0)
        return (t["f"] == x["f"]) & (notice | piece)

    def confirmed(x: Column) -> Column:
        good = (x["sure"] >= CERTAIN) & (x["f"] != UNKNOWN) & F.exists(templates, lambda t: confirms(t, x))
        return F.struct(x["line"].alias("line"), F.when(good, x["f"]).otherwise(UNKNOWN).alias("family"), F.round(x["sure"], 6).alias("probability"), good.alias("confirmed"))

    l = unused(docs, "lines")
    known = sorted({p for t in shapes() for p in t["p"]})

    def may(x: Column) -> Column:  # a line's words are looked up before its pairs are made
        marked = (F.size(x["w"]) >= PIECE_WORDS) & F.exists(x["w"], lambda w: w.isin(marks()))
        return F.exists(x["w"], lambda w: w.isin(guards())) | marked

    def kept(x: Column) -> Column:
        piece = F.size(F.filter(x["p"], lambda p: p.isin(known))) >= PIECE * F.size(x["p"])
        return F.exists(x["w"], lambda w: w.isin(guards())) | piece

    lines = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda t, i: F.struct(i.alias("line"), _words(t).alias("w")))
    d = docs.withColumn(l, F.filter(lines, may))
    d = d.withColumn(l, F.filter(F.transform(l, told), kept))
    for f in (grams, logits, best, confirmed):
        d = d.withColumn(l, F.transform(l, f))
    return d.withColumn(out, F.col(l)).drop(l)


def op3(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scan(docs)
    sure = F.filter("licenses", lambda x: x["confirmed"])
    return out.select(
        "doc_id", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_paragraphs"), F.size("licenses").cast("long").alias("n_candidates"),
        F.size(sure).cast("long").alias("n_licensed"), F.array_join(F.sort_array(F.array_distinct(F.transform(sure, lambda x: x["family"]))), ",").alias("families"),
        F.array_join(F.transform("licenses", lambda x: F.concat_ws(":", x["line"].cast("string"), x["family"])), ",").alias("found"),
    )

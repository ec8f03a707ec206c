"""Licence scans: a word n-gram logistic regression over paragraphs, confirmed against templates."""

from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import query, table, terms

#: Wordings by family (fixed values: names and standard sentences of the licences).
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license. See LICENSE for details.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "Without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.",
        "The MIT License (MIT)",
        "MIT License",
        "SPDX-License-Identifier: MIT",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS basis, without warranties or conditions of any kind.",
        "Apache License Version 2.0, January 2004",
        "Apache License 2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "Distributed under the terms of the GNU GPL version 2 or later.",
        "GNU General Public License Version 3, 29 June 2007",
        "GNU General Public License Version 2, June 1991",
        "Released under GPLv3.",
        "under GPLv2",
        "the GPLv3",
        "GPLv3 license",
        "under the GPL v3",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "You can redistribute this library under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "GNU Lesser General Public License Version 3, 29 June 2007",
        "under LGPLv3",
        "the LGPLv2",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "AGPL": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "Licensed under the AGPL version 3.",
        "GNU Affero General Public License Version 3, 19 November 2007",
        "under AGPLv3",
        "the AGPLv3",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "BSD 3-Clause License",
        "BSD 2-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "Mozilla Public License Version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "CC0": (
        "Released into the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "CC0 1.0 Universal",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "Proprietary": (
        "All rights reserved.",
        "Copyright. All rights reserved.",
        "All rights reserved. No part of this work may be reproduced without written permission of the publisher.",
    ),
}
#: Paragraphs that speak of something else in like words, for the unknown class.
UNLIKE = (
    "The driver must carry a licence and the papers of the car.",
    "The warranty of the kettle covers two years from the day of sale.",
    "Permission to leave the room was granted by the teacher.",
    "The apache helicopter version was shown to the public.",
    "The museum is free of charge on the first day of the month.",
    "Fishing under a licence of the county is allowed on this lake.",
    "He asked about the copyright of the song in the film.",
    "The general public was asked to vote on version 2.0 of the plan.",
    "Version 4.0 was released under the name of the founder.",
    "SPDX-License-Identifier: Zlib",
    "SPDX-License-Identifier: ISC",
    "Version 3 of the plan came out in June 2007.",
    "The minutes of January 2004 are version 2 of the text.",
)
UNKNOWN = "unknown"
CLASSES = (UNKNOWN, *TEMPLATES)
#: Words by which a paragraph without a known family counts as an unknown licence. They keep nothing from the classifier.
ANCHORS = r"(?i)licen[cs]e|licensed|copyright|creative commons|public domain|redistribut|permission|\brights\b|\bcc0\b|\bcc.by\b|\bspdx\b|[al]?gpl(?:v?\d|\b)"
#: Words too common to look for.
STOP = set("a an and any are as at be by can do for form forms free from general have in into is it may not of on or part person provided public source terms text that the this to under use version with without work you your 0 1 2 3 4".split())
GRAMS = (1, 2, 3)
#: Samples drawn for each class, probability asked for, and share of a template's word pairs.
SAMPLES, SURE, ALIKE = 300, 0.6, 0.6
#: Words after a line that are read with it: twice those of the longest wording.
RUN = 80
#: Share of its word pairs by which a line belongs to the wording of the run it stands in.
PART = 1 / 3


def words(text: str) -> list[str]:
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]


def grams(ws: list[str], sizes=GRAMS) -> set[str]:
    return {" ".join(ws[i : i + n]) for n in sizes for i in range(len(ws) - n + 1)}


def labelled_paragraphs(seed: int = 5) -> list[tuple[set[str], int]]:
    """Labelled samples: wordings as they stand, with a holder's line, with words left out or between others; and unlike ones."""
    rng = random.Random(seed)
    plain = words(" ".join(UNLIKE)) + "the of and to in on see file data text book page author holder name year".split()
    out = []
    for k, family in enumerate(CLASSES):
        for _ in range(SAMPLES if k else SAMPLES * 6):
            base = words(rng.choice(TEMPLATES[family] if k else UNLIKE))
            if k and rng.random() < 0.4:
                base = [w for w in base if rng.random() > 0.06]
            if not k and rng.random() < 0.6:
                # Pieces of wordings too short to name a family.
                piece = words(rng.choice(TEMPLATES[rng.choice(CLASSES[1:])]))
                at = rng.randrange(len(piece))
                base = rng.choices(plain, k=rng.randrange(4, 25)) + [w for w in piece[at : at + 2] if w not in _NAMES]
            pad = lambda: rng.choices(plain, k=rng.randrange(0, 12)) if rng.random() < 0.5 else []
            out.append((grams(pad() + base + pad()), k))
    rng.shuffle(out)
    return out


_NAMES = {"gplv2", "gplv3", "lgplv2", "lgplv3", "agplv3", "lgpl", "mpl", "by", "january", "june", "november", "universal", "mit", "apache", "gpl", "agpl", "lesser", "affero", "bsd", "mozilla", "cc", "cc0", "gnu", "commons", "sa", "nc"}


def gate_words() -> list[str]:
    """Words one of which stands in every paragraph that has ALIKE of the word pairs of a wording.

    For each wording, words are taken until the pairs without any of them are too few to reach ALIKE.
    """
    gate: set[str] = set()
    for wording in (t for ts in TEMPLATES.values() for t in ts):
        pairs = [p.split(" ") for p in grams(words(wording), (2,))]
        while sum(not gate & set(p) for p in pairs) >= ALIKE * len(pairs):
            left = [w for p in pairs if not gate & set(p) for w in set(p)]
            gate.add(min(sorted(set(left)), key=lambda w: (w in STOP, -left.count(w))))
    return sorted(gate)


def train(seed: int = 5) -> dict:
    """Weights of (gram, class), constants and temperature of a softmax regression on the labelled paragraphs.

    The grams are those of the wordings. The temperature is fitted on samples left out of training,
    so that the probabilities are calibrated.
    """
    vocabulary = sorted(set().union(*(grams(words(t)) for ts in TEMPLATES.values() for t in ts)))
    at = {g: i for i, g in enumerate(vocabulary)}
    samples = labelled_paragraphs(seed)
    x = np.zeros((len(samples), len(at) + 1), np.float32)
    for r, (gs, _) in enumerate(samples):
        x[r, [at[g] for g in gs if g in at]] = 1
        x[r, -1] = 1
    y = np.array([k for _, k in samples])
    fit = np.arange(len(samples)) % 5 != 0
    w = np.zeros((x.shape[1], len(CLASSES)), np.float32)
    one = np.eye(len(CLASSES), dtype=np.float32)[y]
    speed = np.zeros_like(w)
    for _ in range(400):
        z = x[fit] @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        speed = 0.9 * speed - 0.5 * (x[fit].T @ (p - one[fit]) / fit.sum() + 1e-4 * w)
        w += speed
    z = x[~fit] @ w

    def loss(t: float) -> float:
        s = z / t
        s = s - s.max(1, keepdims=True)
        return float(-(s[np.arange(len(s)), y[~fit]] - np.log(np.exp(s).sum(1))).mean())

    heat = min((0.25 * 1.15**k for k in range(25)), key=loss)
    return {"weights": {g: (w[i] / heat).tolist() for g, i in at.items()}, "constants": (w[-1] / heat).tolist()}


def _doubles(rows: list[list[float]]) -> Column:
    text = ";".join(",".join(f"{v:.5f}" for v in row) for row in rows)
    return F.transform(F.split(F.lit(text), ";"), lambda r: F.split(r, ",").cast("array<double>"))


def _grams(ws: Column, sizes) -> Column:
    """Different word n-grams, each as words with single blanks between: stretches of the joined words."""
    joined = F.array_join(ws, " ")
    return F.array_distinct(F.flatten(F.array(*[
        F.regexp_extract_all(joined, F.lit(rf"(?<![^ ])(?=({' '.join(['[^ ]+'] * n)})(?![^ ]))"), F.lit(1)) for n in sizes
    ])))


def _units(text: Column, vocabulary: list[str]) -> Column:
    """(line, last, norm, paragraph, n) of every line, and of every line with the lines after it, to RUN words or a line without words.

    Any stretch of RUN words that does not cross a line without words lies in the run of the line
    it begins in. ``norm`` is the words, each stretch of words that no wording has being one ~;
    ``n`` is the number of words of the line.
    """

    def read(line: Column) -> Column:
        ws = F.transform(terms(line), lambda w: F.when(w.isin(*vocabulary), w).otherwise("~"))
        return F.transform(F.array(ws), lambda w: F.struct(F.size(w).alias("n"), _shrunk(F.array_join(w, " ")).alias("t"), line.alias("s")))[0]

    def run_end(rows: Column, i: Column) -> Column:
        # RUN lines with words have RUN words.
        start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("lines"), (F.element_at(rows, i + 1)["n"] == 0).alias("over"))

        def step(a: Column, x: Column) -> Column:
            over = a["over"] | (x["n"] == 0) | (a["words"] >= RUN)
            return F.struct(F.when(over, a["words"]).otherwise(a["words"] + x["n"]).alias("words"), F.when(over, a["lines"]).otherwise(a["lines"] + 1).alias("lines"), over.alias("over"))

        return i + F.aggregate(F.slice(rows, i + 2, RUN), start, step, lambda a: a["lines"])

    def both(rows: Column):
        return lambda u: F.array(
            F.struct(u["line"].alias("line"), u["line"].alias("last"), u["t"].alias("norm"), u["s"].alias("paragraph"), u["n"].alias("n")),
            F.struct(u["line"].alias("line"), u["last"].alias("last"), F.when(u["last"] > u["line"], _shrunk(F.array_join(F.transform(F.slice(rows, u["line"] + 1, u["last"] - u["line"] + 1), lambda x: x["t"]), " "))).alias("norm"), F.array_join(F.transform(F.slice(rows, u["line"] + 1, u["last"] - u["line"] + 1), lambda x: x["s"]), "\n").alias("paragraph"), u["n"].alias("n")),
        )

    def ends(rows: Column):
        return lambda x, i: F.struct(i.alias("line"), run_end(rows, i).alias("last"), x["t"].alias("t"), x["s"].alias("s"), x["n"].alias("n"))

    held = F.array(F.transform(F.split(text, "\n"), read))
    return F.flatten(F.flatten(F.transform(held, lambda rows: F.transform(F.transform(rows, ends(rows)), both(rows)))))


def _shrunk(c: Column) -> Column:
    return F.regexp_replace(c, "~( ~)+", "~")


def scan_paragraphs(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, h, line, paragraph, family, probability, template) of every paragraph of a known family or with an anchor word.

    Paragraphs are lines and, for wordings broken over lines, runs of lines. The classifier gives
    the likeliest class and its calibrated probability; a family below SURE, or whose nearest wording
    has less than ALIKE of its word pairs in the paragraph, is unknown. A run counts only for a
    family that none of its lines has by itself, and of runs of one family that begin in
    consecutive lines the last one; a line in a run of a known family is not unknown if PART of its
    own word pairs, or its only word, are of the family's wordings. ``h`` is the hash of the text, which with the key
    knows the row.
    """
    spark = docs.sparkSession
    vocabulary = sorted({w for g in model["weights"] for w in g.split(" ")})
    letter = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    # What has no gate word cannot be confirmed.
    gate = rf"(?i)(?<!{letter})(?:{'|'.join(gate_words())})(?!{letter})"
    looked_at = lambda c: F.rlike(F.col(c), F.lit(gate)) | F.rlike(F.col(c), F.lit(ANCHORS))
    units = docs.where(looked_at(text)).select(F.col(key).alias("k"), F.xxhash64(text).alias("h"), F.explode(_units(F.col(text), vocabulary)).alias("u"))
    lines = units.select("k", "h", "u.line", "u.last", "u.norm", "u.paragraph", "u.n").where(F.col("norm").isNotNull())
    # A run never counts as unknown, so it needs a gate word.
    lines = lines.where(F.rlike("norm", F.lit(gate)) | ((F.col("last") == F.col("line")) & F.rlike("paragraph", F.lit(ANCHORS)))).withColumn("anchored", F.rlike("paragraph", F.lit(ANCHORS)))
    # The same words are judged once, however many documents have them.
    kinds = lines.select("norm").distinct()
    cut = kinds.select("norm", F.split("norm", " ").alias("w"))
    spread = cut.select("norm", F.explode(_grams(F.col("w"), GRAMS)).alias("g"))
    names = sorted(model["weights"])
    size = len(CLASSES)
    table_ = spark.range(1).select(F.posexplode(F.split(F.lit("\n".join(names)), "\n")).alias("i", "g"), _doubles([model["weights"][g] for g in names]).alias("m")).select("g", F.element_at("m", F.col("i") + 1).alias("v"))
    hit = spread.join(table_, "g", "left").groupBy("norm").agg(*[F.coalesce(F.sum(F.element_at("v", c + 1)), F.lit(0.0)).alias(f"s{c}") for c in range(size)])
    scores = F.array(*[F.col(f"s{c}") + F.lit(model["constants"][c]) for c in range(size)])
    best = hit.select("norm", scores.alias("s")).withColumn("top", F.array_max("s"))
    best = best.select("norm", (F.array_position("s", F.col("top")) - 1).alias("c"), (1 / F.aggregate("s", F.lit(0.0), lambda a, v: a + F.exp(v - F.col("top")))).alias("probability"))
    # Template comparison: share of a wording's word pairs in the paragraph.
    pairs = [(k, " | ".join(sorted(grams(words(t), (2,)))), t) for k, f in enumerate(CLASSES) if k for t in TEMPLATES[f]]
    wordings = F.array(*[F.struct(F.lit(k).alias("c"), F.split(F.lit(p), r" \| ").alias("pairs"), F.lit(t).alias("t")) for k, p, t in pairs])
    mine = cut.select("norm", _grams(F.col("w"), (2,)).alias("own"), "w").withColumn("parts", F.when(F.size("own") > 0, F.col("own")).otherwise(F.col("w"))).drop("w")
    near = F.transform(F.filter(wordings, lambda x: x["c"] == F.col("c")), lambda x: F.struct((F.size(F.array_intersect(x["pairs"], F.col("own"))) / F.size(x["pairs"])).alias("share"), x["t"].alias("t")))
    every = F.array(*[F.split(F.lit(" | ".join(sorted(set().union(*(grams(words(t), (1, 2)) for t in ts))))), r" \| ") for ts in TEMPLATES.values()])
    part = F.transform(every, lambda pairs: F.size(F.array_intersect(pairs, F.col("parts"))))
    judged = best.join(mine, "norm").select("norm", "c", "probability", F.array_max(near).alias("near"), part.alias("part"))
    sure = (F.col("c") > 0) & (F.col("probability") >= SURE) & (F.col("near.share") >= ALIKE)
    family = F.when(F.coalesce(sure, F.lit(False)), F.element_at(F.array(*[F.lit(c) for c in CLASSES]), F.col("c").cast("int") + 1)).otherwise(UNKNOWN)
    named = judged.select("norm", family.alias("family"), "probability", F.col("near.t").alias("template"), "part")
    found = lines.join(named, "norm").dropDuplicates(["k", "h", "line", "last"])
    known, run = F.col("family") != UNKNOWN, F.col("last") > F.col("line")
    same, before = W.partitionBy("k", "h", "family").orderBy("line"), W.partitionBy("k", "h").orderBy("line").rangeBetween(W.unboundedPreceding, W.currentRow)
    reach = F.array(*[F.max(F.when(run & (F.col("family") == f), F.col("last"))).over(before) for f in TEMPLATES])
    alone = F.min(F.when(known & ~run, F.col("line"))).over(same.rangeBetween(W.currentRow, W.unboundedFollowing))
    found = found.withColumn("reach", reach).where(known | ~run).withColumn("alone", alone).where(~run | F.col("alone").isNull() | (F.col("alone") > F.col("last")))
    next_run = F.lead("line").over(W.partitionBy("k", "h", "family", run).orderBy("line"))
    found = found.withColumn("next_run", next_run)
    inside = F.exists(F.zip_with("reach", "part", lambda last, part: (last >= F.col("line")) & (part >= PART * F.greatest(F.col("n") - 1, F.lit(1)))), lambda x: F.coalesce(x, F.lit(False)))
    stays = F.when(run, F.col("next_run").isNull() | (F.col("next_run") > F.col("line") + 1)).otherwise(known | (~inside & F.col("anchored")))
    return found.where(stays).select("k", "h", "line", "paragraph", "family", "probability", "template")


def scan_licences(docs: DataFrame, model: dict | None = None, key: str = "doc_id", text: str = "text", name: str = "licences") -> DataFrame:
    """The documents with their licences: an array of (line, family), unknown ones with anchor words included.

    Null and empty texts have none; repeated rows stay; an empty table gives an empty one; columns
    of the documents keep their names.
    """
    found = scan_paragraphs(docs, model or train(), key, text).select("k", "h", "line", "family").distinct()
    lists = found.groupBy("k", "h").agg(F.array_sort(F.collect_list(F.struct("line", "family"))).alias(f"_{name}"))
    lists = lists.select(F.col("k").alias("_key"), F.col("h").alias("_hash"), f"_{name}")
    mine = docs.withColumn("_own", F.xxhash64(text))
    out = mine.join(lists, (F.col("_own") == F.col("_hash")) & F.col(key).eqNullSafe(F.col("_key")), "left")
    return out.select(*docs.columns, F.coalesce(f"_{name}", F.array().cast("array<struct<line:int,family:string>>")).alias(name))


@query()
def op2_licences(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = scan_licences(docs)
    known = F.array_sort(F.array_distinct(F.filter(F.col("licences.family"), lambda f: f != UNKNOWN)))
    count = lambda test: F.size(F.filter("licences", test)).cast("bigint")
    return found.select("doc_id", count(lambda x: x["family"] != UNKNOWN).alias("n_licences"), count(lambda x: x["family"] == UNKNOWN).alias("n_unknown"), F.array_join(known, ",").alias("families"))

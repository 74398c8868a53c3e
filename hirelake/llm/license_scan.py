"""Operator 7: licence scans by a trained paragraph classifier.

A paragraph is a line, and a run of lines without a blank one between them, so a
notice counts on a line of its own and wrapped over several.  It is classified by
multinomial logistic regression on its word n-grams into a licence family or
``unknown``.  The model is trained here on notices of each family and on sentences
that grant nothing; a part of them is kept back to calibrate the probability
below which a paragraph stays unknown.  A prediction counts as confirmed if
the paragraph holds enough of a template of the family.

Which paragraphs are scored follows from the trained weights: ``gate_of`` gives
words without which no family can reach its probability, so what it passes over
would stay unknown.

Training, scoring and comparison are DataFrame and SQL functions and Spark's
own learner.  Equal paragraphs are scored once, so a notice that a third of all
documents carry costs one row; the weights have one row for each n-gram
of the training texts, which bounds what is broadcast.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import text_or_empty, written

UNKNOWN = "unknown"
#: Lines with one of these are listed also where they stay unknown.
CUE = r"(?i)licen[cs]|copyright|copyleft|warrant|redistribut|permission|public domain|rights reserved|spdx"
#: Notices of each family, one paragraph each.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "Released under the Apache 2.0 license."),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction.",
        "SPDX-License-Identifier: MIT",
        "This project is licensed under the MIT license."),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Licensed under the BSD license."),
    "GPL-2.0": (
        "This program is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "Released under the GPL version 2 license.",
        "GNU GPL v2",
        "Licensed under the GPLv2."),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it under the terms of the GNU General Public License, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Licensed under the GPL, version 3.",
        "GNU GPL v3",
        "Licensed under the GPLv3."),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "GNU LGPL v3"),
    "AGPL": (
        "This program is licensed under the GNU Affero General Public License.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "GNU AGPL v3"),
    "MPL-2.0": (
        "This source code form is subject to the terms of the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0"),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Creative Commons Attribution 4.0 International",
        "CC BY 4.0"),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Creative Commons Attribution-ShareAlike 4.0 International",
        "CC BY-SA 4.0"),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Creative Commons Attribution-NonCommercial 4.0 International",
        "CC BY-NC 4.0"),
    "CC0": (
        "Released into the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "CC0 1.0 Universal",
        "Dedicated to the public under CC0."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense"),
    "proprietary": (
        "All rights reserved.",
        "Copyright by the author. All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the publisher."),
}
#: Sentences that grant nothing, first those with the same words.
OTHERS = (
    "She renewed her driving license last week.", "The licensing office opens at nine.", "He asked for permission to leave the room.",
    "The warranty covers parts and labour for two years.", "They discussed copyright law at the conference.",
    "A fishing license is required at the lake.", "The court issued a search warrant.", "Permission was denied by the council.",
    "The band sold the license to use the song in a film.", "Copyright disputes are common in the music business.",
    "Wealth is redistributed by taxes.", "The state revoked his medical license.", "The extended warranty has expired.",
    "Read the license before you install the program.", "See the license file for details.", "Copyright notices are listed below.",
    "The old maps are in the public domain in most countries.", "The club reserved all rooms for the night.",
    "Version 2 of the report needs permission from the board.", "The teacher gave permission under one condition.",
    "She went to the market and bought some of the fruit that was left.", "This is the house that he wanted to buy with the money of his father.",
    "The work of the day was done by the time it got dark.", "All of the people in the public square were free to leave.",
    "They may use the road or walk along the river without a map.", "The source of the river is in the north of the country.",
    "He must be at the office by nine and is not to be late.", "The list of names that follows is in the form of a table.",
    "The film was released into cinemas in May.", "The software of the car was updated to version 4.0 last week.",
    "There are 3 or 4 of them above the door.", "It is subject to change at any time.",
    "The code of the door is written on the paper under the lamp.", "Only the author and the publisher were at the reading.",
    "Later in the year the project was sold to an international group.", "The terms and conditions of the contract are to be met by both sides.",
    "The attribution of the painting to the master is in doubt.", "The House of Commons met to discuss the general state of the roads.",
    "Creative people like to work with others in the same room.", "Version 3 of the program has 2 new screens.",
    "Sie ging mit ihm unter der Brücke und in die Stadt.", "El libro de la casa es de los padres y de la familia.",
    "Le livre est sur la table de la cuisine et dans la maison.", "She is a student at MIT and her notice is on the board.",
)
#: Words of every text, which the gate passes over first; they decide what scoring costs, not what is found.
COMMON = (
    "the of and to a in is that for it as was with be by on not he this are or his from at which but have an had they you were their one all we can her "
    "has there been if more when will would who so no out up into only any may must other these use two first new than under work free above public").split()


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"[a-z0-9]+(?:\.[0-9]+)*"), F.lit(0))


def once(value: Column, then) -> Column:
    """``then`` of a value that is computed once: an expression would be copied into every place that reads it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def grams(words: Column, most: int = 3) -> Column:
    """The distinct n-grams of 1 to ``most`` words."""
    def of(w: Column, n: int) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.size(w) - n + 1, F.lit(1)))
        return F.filter(F.transform(at, lambda i: F.array_join(F.slice(w, i, n), " ")), lambda g: F.length(g) > 0)

    return once(words, lambda w: F.array_distinct(F.concat(*[of(w, n) for n in range(1, most + 1)])))


def examples(spark: SparkSession) -> DataFrame:
    """``text, family, kept_back``: templates and other sentences, whole and with words left out at either end."""
    rows = []
    for family, texts in [*TEMPLATES.items(), (UNKNOWN, OTHERS)]:
        for n, t in enumerate(texts):
            words = t.split()
            cuts = {t} | ({" ".join(words[1:]), " ".join(words[:-1])} if len(words) > 5 else set()) | ({" ".join(words[2:])} if len(words) > 9 else set())
            # of the sentences that grant nothing a third is only calibrated on; of templates their cut forms
            rows += [(c, family, n % 3 == 2 if family == UNKNOWN else c == " ".join(words[:-1])) for c in sorted(cuts)]
    return spark.createDataFrame(rows, "text string, family string, kept_back boolean")


@dataclass(frozen=True)
class Model:
    weights: DataFrame  # gram, w: one weight for each class
    classes: list[str]
    intercept: list[float]
    least: float  # probability a family needs
    gate: str  # pattern of the lower-case paragraphs that can reach it


def gate_of(weights: dict[str, list[float]], classes: list[str], intercept: list[float], least: float) -> list[str]:
    """Words of the vocabulary of which a paragraph holds one, if a family can reach ``least`` in it.

    A family of probability ``least`` is ahead of ``unknown`` by its log odds at
    least.  Words are passed over, common ones and the least telling first, as long as all
    n-grams made of them alone, taken together, leave every family below that:
    a paragraph has no other n-grams of the vocabulary if it has no other words.
    """
    u, needed = classes.index(UNKNOWN), math.log(least / (1 - least))
    ahead = {g: [x - w[u] for k, x in enumerate(w) if k != u] for g, w in weights.items()}
    most = [x - intercept[u] for k, x in enumerate(intercept) if k != u]
    of: dict[str, list[str]] = {}
    for g in weights:
        for word in set(g.split()):
            of.setdefault(word, []).append(g)
    passed: set[str] = set()
    for word in sorted(of, key=lambda x: (x not in COMMON, max(ahead.get(x, [0.0])), x)):
        new = [ahead[g] for g in of[word] if passed.issuperset(set(g.split()) - {word})]
        more = [m + sum(max(0.0, a[k]) for a in new) for k, m in enumerate(most)]
        if max(more) < needed - 1e-6:  # room for the rounding of the sums
            passed.add(word)
            most = more
    return sorted(set(of) - passed)


def gate_pattern(words: list[str]) -> str:
    """Matches wherever one of the words is a token; a token may begin behind the digits of the last one."""
    whole = "|".join(re.escape(w) for w in words if "." not in w)
    dotted = "|".join(re.escape(w) for w in words if "." in w)
    return "(?<![a-z])(?:" + "|".join(f"(?:{p}){end}" for p, end in ((whole, "(?![a-z0-9])"), (dotted, "(?![0-9])")) if p) + ")"


def train(spark: SparkSession) -> Model:
    """The classifier, from the templates and sentences above only: a few hundred rows."""
    rows = examples(spark).withColumn("grams", grams(tokens(F.col("text"))))
    classes = [*sorted(TEMPLATES), UNKNOWN]
    place = F.array_position(F.array([F.lit(c) for c in classes]), F.col("family")) - 1
    rows = rows.withColumn("label", place.cast("double")).coalesce(1).cache()
    vocabulary = CountVectorizer(inputCol="grams", outputCol="features", binary=True).fit(rows)
    learner = LogisticRegression(family="multinomial", regParam=0.002, maxIter=40, standardization=False)
    fitted = learner.fit(vocabulary.transform(rows.where("not kept_back")))
    matrix = fitted.coefficientMatrix.toArray().T.tolist()
    weights = written(spark.createDataFrame(list(zip(vocabulary.vocabulary, matrix)), "gram string, w array<double>"), "license-weights")
    model = Model(weights, classes, fitted.interceptVector.toArray().tolist(), 0.0, "")
    # the least probability lies between those of kept-back notices and kept-back sentences
    scored = predicted(rows.where("kept_back").select(F.col("text").alias("key"), F.explode("grams").alias("gram")), model)
    right = scored.join(rows.select(F.col("text").alias("key"), F.col("family").alias("truth")), "key")
    low = right.where("truth = family and truth != 'unknown'").agg(F.percentile("probability", 0.1)).first()[0]
    high = right.where("truth = 'unknown' and family != 'unknown'").agg(F.max("probability")).first()[0]
    rows.unpersist()
    least = min(0.9, max(0.5, ((low or 0.5) + (high or 0.0)) / 2))
    words = gate_of(dict(zip(vocabulary.vocabulary, matrix)), classes, model.intercept, least)
    return Model(weights, classes, model.intercept, least, gate_pattern(words))


def predicted(paragraphs: DataFrame, model: Model) -> DataFrame:
    """``key, family, probability`` from ``key, gram``: the likeliest class by the weights of the n-grams."""
    one = paragraphs.select("key", "gram").join(F.broadcast(model.weights), "gram")
    sums = (one.select("key", F.posexplode("w").alias("class", "w")).groupBy("key", "class").agg(F.sum("w").alias("w"))
            .withColumn("logit", F.col("w") + F.array([F.lit(x) for x in model.intercept])[F.col("class")]))
    top = sums.groupBy("key").agg(F.max("logit").alias("top"), F.max_by("class", "logit").alias("class"),
                                  F.sort_array(F.collect_list("logit")).alias("logits"))
    share = F.aggregate("logits", F.lit(0.0), lambda acc, x: acc + F.exp(x - F.col("top")))
    family = F.array([F.lit(c) for c in model.classes])[F.col("class")]
    return top.select("key", family.alias("family"), (1 / share).alias("probability"))


def compared(paragraphs: DataFrame, spark: SparkSession) -> DataFrame:
    """``key, family, overlap``: the largest part of a template of each family that the paragraph holds."""
    templates = spark.createDataFrame([(f, n, t) for f, ts in TEMPLATES.items() for n, t in enumerate(ts)], "family string, template int, text string")
    templates = templates.withColumn("grams", grams(tokens(F.col("text")), 2))
    templates = templates.select("family", "template", F.size("grams").alias("size"), F.explode("grams").alias("gram"))
    return (paragraphs.select("key", "gram").join(F.broadcast(templates), "gram")
            .groupBy("key", "family", "template").agg((F.count(F.lit(1)) / F.first("size")).alias("overlap"))
            .groupBy("key", "family").agg(F.max("overlap").alias("overlap")))


def paragraphs_of(texts: DataFrame, pattern: str) -> DataFrame:
    """``doc_id, row, run, paragraph, lines, start, line`` of the lines that match, and of the runs of several lines that hold such a line.

    row: one for each row of ``texts``; run: the first line of the run.
    """
    step = 256  # lines whose sizes are summed at a time

    def total(sizes: Column, begin: Column, n: Column) -> Column:
        return F.aggregate(F.slice(sizes, begin + 1, n), F.lit(0), lambda a, x: a + x)

    def measured(lines: Column) -> Column:
        return F.struct(lines.alias("lines"), F.transform(lines, lambda x: F.length(x) + 1).alias("sizes"), F.transform(lines, lambda x: x.rlike(r"\S")).alias("full"),
                        F.transform(lines, lambda x: F.lower(x).rlike(pattern) | x.rlike(CUE)).alias("hit"),
                        F.sequence(F.lit(0), F.size(lines) - 1).alias("at"), F.sequence(F.lit(0), F.floor(F.size(lines) / step).cast("int")).alias("blocks"))

    def entries(d: Column, before: Column) -> Column:
        def full(i: Column) -> Column:
            return F.coalesce(F.get(d["full"], i), F.lit(False))  # no line before the first and behind the last

        def entry(run: Column, first: Column, n: Column, text: Column) -> Column:
            block = F.floor(first / step).cast("int")
            start = F.get(before, block) + total(d["sizes"], block * step, first - block * step)
            return F.struct(run.alias("run"), first.alias("paragraph"), n.cast("int").alias("lines"), start.alias("start"), text.alias("line"))

        def of_run(r: Column) -> Column:
            a, b, n = r["a"], r["b"], r["b"] - r["a"] + 1
            single = F.transform(r["hits"], lambda i: entry(a, i, F.lit(1), F.get(d["lines"], i)))
            whole = entry(a, a, n, F.array_join(F.slice(d["lines"], a + 1, n), "\n"))
            return F.when((n > 1) & (F.size(r["hits"]) > 0), F.concat(single, F.array(whole))).otherwise(single)

        firsts = F.filter(d["at"], lambda i: full(i) & ~full(i - 1))
        lasts = F.filter(d["at"], lambda i: full(i) & ~full(i + 1))
        runs = F.zip_with(firsts, lasts, lambda a, b: F.struct(
            a.alias("a"), b.alias("b"), F.filter(F.sequence(a, b), lambda i: F.get(d["hit"], i)).alias("hits")))
        return F.flatten(F.transform(runs, of_run))

    found = once(measured(F.split("text", "\n", -1)), lambda d: once(
        F.transform(d["blocks"], lambda b: total(d["sizes"], b * step, F.lit(step))), lambda sums: once(
            F.transform(d["blocks"], lambda b: total(sums, F.lit(0), b)), lambda before: entries(d, before))))
    # in a projection of its own: beside the generator, each of its rows would get another number
    return texts.withColumn("row", F.monotonically_increasing_id()).select("doc_id", "row", F.inline(found))


def scan(docs: DataFrame, model: Model | None = None, confirm: float = 0.7) -> DataFrame:
    """``doc_id, paragraph, start, family, probability, overlap, confirmed, lines`` of the paragraphs.

    Rows have every line and every run of non-blank lines of a family, and the
    unknown lines that hold a licensing word.  A run has no row if one of its lines
    says the same: is of its family, and confirmed if the run is.

    paragraph: number of the first line from 0; start: its first code point; lines: how
    many there are.  family is ``unknown`` where the likeliest class is or its
    probability is too low; a family is confirmed if the paragraph holds at least
    ``confirm`` of one of its templates' n-grams.  Null and blank texts give no
    rows; repeated rows and lines stay.  Only ``doc_id`` and ``text`` are read.
    """
    spark = docs.sparkSession
    model = model or train(spark)
    texts = docs.select("doc_id", text_or_empty().alias("text")).where(F.lower("text").rlike(model.gate) | F.col("text").rlike(CUE))
    found = written(paragraphs_of(texts, model.gate).withColumn("key", F.md5("line")), "license-lines")
    distinct = found.groupBy("key").agg(F.first("line").alias("line")).select("key", F.explode(grams(tokens(F.col("line")))).alias("gram"))
    distinct = written(distinct.join(F.broadcast(model.weights.select("gram")), "gram"), "license-grams")
    best = predicted(distinct, model).withColumn("family", F.when(F.col("probability") >= model.least, F.col("family")).otherwise(F.lit(UNKNOWN)))
    best = best.join(compared(distinct, spark), ["key", "family"], "left")
    cue = F.col("line").rlike(CUE)
    out = (found.withColumn("cue", cue & (F.col("lines") == 1)).drop("line").join(best, "key", "left")
           .withColumn("family", F.coalesce("family", F.lit(UNKNOWN))).withColumn("overlap", F.coalesce("overlap", F.lit(0.0)))
           .withColumn("confirmed", (F.col("family") != UNKNOWN) & (F.col("overlap") >= confirm))
           .where(F.col("cue") | (F.col("family") != UNKNOWN)))
    out = written(out, "license-families")
    same = ["row", "run", "family"]
    said = out.where("lines = 1").groupBy(*same).agg(F.max("confirmed").alias("said"))
    runs = out.where("lines > 1").join(said, same, "left").where("said is null or (confirmed and not said)")
    names = ["doc_id", "paragraph", "start", "family", "probability", "overlap", "confirmed", "lines"]
    return out.where("lines = 1").select(*names).unionByName(runs.select(*names))

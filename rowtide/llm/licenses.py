"""Licence scans: a trained paragraph classifier, confirmed by comparison with templates. DataFrame functions only."""

from __future__ import annotations

import math
import re
from functools import reduce

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.session import frozen

UNKNOWN = "unknown"

#: Sentences of public licence notices, by family.
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Licensed under the Apache License, Version 2.0.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "This project is released under the Apache License 2.0.",
        "SPDX: Apache-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc0": (
        "CC0 / public domain",
        "CC0 1.0 Universal",
        "This work is dedicated to the public domain under CC0 1.0.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "cc-by": (
        "CC BY 4.0",
        "CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc": (
        "CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-NC-SA 4.0.",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU General Public License, version 3.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GPL, version 2 or later.",
        "Released under GPLv3",
        "Released under GPLv2",
        "GPL-3.0-or-later",
        "GPL-2.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this work may be reproduced without written permission of the publisher.",
        "This material is proprietary and confidential; all rights reserved.",
    ),
}
#: Sentences with such words that name no family.
OTHERS = (
    "The licence of the driver was checked at the border.",
    "Ask for permission before you take a copy of the key.",
    "The copyright of a work ends many years after the death of its author.",
    "A licence may be obtained from the local office for a fee.",
    "Our warranty covers parts and labour for two years.",
    "The terms of use and the licence are listed on the next page.",
    "Public works are licensed by the city council.",
)
#: A paragraph of no known family is reported if it holds one of these.
SIGNALS = "licen[sc]|copyright|redistribut|permission|rights reserved"
#: A paragraph with one of these is no example of ``unknown``, nor one with a signal.
NAMES = r"spdx|\b[al]?gpl|\bmpl\b|\bmit\b|\bbsd\b|apache|creative commons|\bcc0|\bcc.by|public domain|as is\b|free software|warrant"

#: What stands in every paragraph in which SIGNALS or NAMES is found; looking for these is faster.
STEMS = (
    "licenc", "licens", "copyright", "redistribut", "permission", "rights reserved", "spdx", "gpl", "mpl", "mit", "bsd", "apache",
    "creative commons", "cc", "public domain", "as is", "free software", "warrant",
)
#: Documents whose paragraphs weigh a tenth of a template each; those of more documents weigh as much together.
WEIGHED = 400
#: Different paragraphs of a training partition, about.
EXAMPLES = 50_000


def words_of(paragraph: Column) -> Column:
    """Lower-case words of letters, digits and inner points."""
    clean = F.regexp_replace(F.lower(paragraph), r"[^a-z0-9.]+|\.(?![0-9])", " ")
    return F.filter(F.split(clean, " "), lambda w: w != "")


def grams(words: Column, n: int) -> Column:
    """The runs of ``n`` words, none if there are fewer."""
    last = F.size(words) - n + 1
    runs = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.concat_ws(" ", F.slice(words, i, n)))
    return F.when(last >= 1, runs).otherwise(F.array().cast("array<string>"))


def paragraphs(docs: DataFrame, id_col: str, text_col: str, holding: str = "[a-z0-9]") -> DataFrame:
    """``doc_id, paragraph, lines, line, words``: every line that holds words, and every run of several lines
    between blank ones; ``paragraph`` is the number of its first line. Only those in whose lower-case form the
    pattern ``holding`` is found; it must not reach over a line's end."""
    text = F.col(f"`{text_col}`")
    filled = docs.where(F.lower(text).rlike(holding)).select(
        F.col(f"`{id_col}`").alias("doc_id"), F.split(text, r"\r?\n").alias("_lines")
    )
    numbered = F.transform("_lines", lambda line, i: F.struct(i.alias("at"), line.rlike(r"\S").alias("filled"), line.alias("line")))
    marked = filled.select("doc_id", "_lines", numbered.alias("_numbered"))

    def beside(i: Column, step: int) -> Column:
        return F.coalesce(F.get(F.col("_numbered"), i + step)["filled"], F.lit(False))

    def edges(step: int) -> Column:
        return F.transform(F.filter("_numbered", lambda x: x["filled"] & ~beside(x["at"], step)), lambda x: x["at"])

    runs = marked.withColumn("_runs", F.arrays_zip(edges(-1).alias("first"), edges(1).alias("last")))
    blocks = F.transform(
        F.filter("_runs", lambda r: r["first"] < r["last"]),
        lambda r: F.struct(
            r["first"].alias("at"), (r["last"] - r["first"] + 1).alias("lines"),
            F.array_join(F.slice(F.col("_lines"), r["first"] + 1, r["last"] - r["first"] + 1), "\n").alias("line"),
        ),
    )
    single = F.transform(
        F.filter("_numbered", lambda x: x["filled"]),
        lambda x: F.struct(x["at"].alias("at"), F.lit(1).alias("lines"), x["line"].alias("line")),
    )
    every = runs.select("doc_id", F.explode(F.concat(blocks, single)).alias("_p")).select(
        "doc_id", F.col("_p.at").cast("long").alias("paragraph"), F.col("_p.lines").cast("long").alias("lines"), F.col("_p.line").alias("line")
    )
    return every.where(F.lower("line").rlike(holding)).withColumn("words", words_of(F.col("line")))


def templates(spark: SparkSession) -> DataFrame:
    rows = [(family, text) for family, texts in sorted(TEMPLATES.items()) for text in texts]
    return spark.createDataFrame(rows, "family string, text string").select("family", words_of(F.col("text")).alias("words"))


def runs_of(words: Column) -> Column:
    """The words, pairs and triples of ``words``."""
    return F.concat(words, grams(words, 2), grams(words, 3))


def known_runs(paragraphs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``paragraphs`` with ``runs``, those of ``runs_of(words)`` that the vocabulary has, each once and in order, instead of ``words``.

    A run of the vocabulary is made of words that it has, so only these are joined.
    """
    word = F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    held = paragraphs.withColumn("_held", F.filter(word, lambda x: x["word"].isin([w for w in vocabulary if " " not in w])))

    def joined(n: int) -> Column:
        def run(x: Column, i: Column) -> Column:
            next_ones = [F.get("_held", i + k) for k in range(1, n)]
            return F.when(next_ones[-1]["at"] == x["at"] + n - 1, F.concat_ws(" ", x["word"], *(y["word"] for y in next_ones)))

        return F.transform("_held", run)

    every = F.concat(F.transform("_held", lambda x: x["word"]), joined(2), joined(3))
    return held.withColumn("runs", F.array_sort(F.array_distinct(F.filter(every, lambda r: r.isin(vocabulary))))).drop("words", "_held")


def telling_words(gaps: np.ndarray, start: np.ndarray, vocabulary: list[str], common: dict[str, int], least: float) -> list[str] | None:
    """Words of which a paragraph needs at least one to be told as a family.

    ``gaps`` are the weights of each run of words for each family, less those for ``unknown``; ``start`` is the
    same for no run at all. A paragraph without the returned words has only runs without them, and the sum of
    all positive gaps of such runs stays below ``least`` for every family. Words are taken by the weight that
    goes with them, for each paragraph of the sample (``common``) that they let through. None if no choice is enough.
    """
    held = [set(run.split(" ")) for run in vocabulary]
    positive = np.maximum(gaps, 0.0)
    left = np.ones(len(vocabulary), bool)
    chosen: list[str] = []
    while (start + positive[:, left].sum(axis=1) >= least).any():
        worth: dict[str, float] = {}
        short = start + positive[:, left].sum(axis=1) >= least
        for i in np.flatnonzero(left & (positive[short].max(axis=0) > 0)):
            for word in held[i]:
                worth[word] = worth.get(word, 0.0) + float(positive[short, i].sum())
        if not worth:
            return None
        best = max(sorted(worth), key=lambda w: worth[w] / (1 + common.get(w, 0)))
        chosen.append(best)
        left &= np.array([best not in words for words in held])
    return chosen


class Classifier:
    """A multinomial logistic regression over families and ``unknown``, and the probability a family needs."""

    def __init__(self, model: LogisticRegressionModel, runs: CountVectorizerModel, families: list[str], bar: float):
        self.model, self.runs, self.families, self.bar = model, runs, families, bar
        self.common: dict[str, int] = {}

    def told(self) -> str:
        """A pattern that every lower-case paragraph matches that reaches the bar for a family, by its weights."""
        unknown = self.families.index(UNKNOWN)
        weights, start = self.model.coefficientMatrix.toArray(), self.model.interceptVector.toArray()
        gaps = np.delete(weights - weights[unknown], unknown, axis=0)
        start = np.delete(start - start[unknown], unknown)
        # Probabilities are compared after rounding to six places.
        p = self.bar - 1e-6
        words = telling_words(gaps, start, self.runs.vocabulary, self.common, math.log(p / (1 - p)))
        if words is None:
            return "[a-z0-9]"
        return f"(?<![a-z0-9])(?:{'|'.join(map(re.escape, sorted(words)))})(?![a-z0-9])" if words else "(?!)"

    def probabilities(self, paragraphs: DataFrame) -> DataFrame:
        """``paragraphs`` with the likeliest family, unknown or not, and its probability. ``runs`` is taken if it is there, else made of ``words``."""
        made = paragraphs if "runs" in paragraphs.columns else paragraphs.withColumn("runs", runs_of(F.col("words")))
        said = self.model.transform(self.runs.transform(made))
        chances = vector_to_array("probability")
        named = F.array(*map(F.lit, self.families))
        return (
            said.withColumn("_best", F.array_max(chances)).withColumn("_at", F.array_position(chances, F.col("_best")))
            .withColumn("likeliest", F.element_at(named, F.col("_at").cast("int")))
            .withColumn("probability", F.round("_best", 6))
            .drop("_best", "_at", "runs", "features", "rawPrediction", "prediction")
        )


def drawn(docs: DataFrame, sample: int, longest: int, id_col: str, text_col: str, seed: int) -> DataFrame:
    """``_order, _text`` of the ``sample`` different rows that come first by a hash of their id, of those with
    at most ``longest`` characters. Only hashes are ranked; texts are fetched afterwards, one of equal ones."""
    text = F.col(f"`{text_col}`")
    marked = docs.where(F.length(text) <= longest).select(
        F.xxhash64(F.col(f"`{id_col}`"), F.lit(seed)).alias("_order"), F.xxhash64(text).alias("_mark"), text.alias("_text")
    )
    first = marked.select("_order", "_mark").distinct().orderBy("_order", "_mark").limit(sample)
    return marked.join(F.broadcast(first), ["_order", "_mark"]).groupBy("_order", "_mark").agg(F.min("_text").alias("_text"))


def trained(
    docs: DataFrame, sample: int | None = None, longest: int = 100_000, id_col: str = "doc_id", text_col: str = "text", seed: int = 5
) -> Classifier:
    """A classifier from the templates, and from texts that name no licence.

    Its features are the words, pairs and triples of the templates and of the fixed other sentences. Examples of a
    family are its templates and their halves. Examples of ``unknown`` are the fixed other sentences and, of all documents,
    the paragraphs (as ``scan`` scores them) without a signal word or a licence's name; half of the documents, by a hash of
    their id, train, the other half calibrate: a family needs a probability that no more than 1 in 1,000 of their
    paragraphs reaches, and 0.5 at least. A paragraph weighs a tenth of a template, and less with more than WEIGHED documents, so that
    the families keep their share of the weight however large the table is. Paragraphs with the same features are one example with their weight.

    ``sample`` takes, instead of all documents, so many of at most ``longest`` characters that come first by a hash of their id.
    """
    spark = docs.sparkSession
    families = [*sorted(TEMPLATES), UNKNOWN]
    label = reduce(lambda c, f: c.when(F.col("family") == f[1], float(f[0])), enumerate(families), F).alias("label")
    whole = templates(spark)
    half = (F.size("words") / 2).cast("int")
    # Halves of long sentences only: a half of a short one may not tell its family.
    halves = whole.where(F.size("words") >= 16)
    known = whole.unionByName(halves.select("family", F.slice("words", F.lit(1), half).alias("words"))).unionByName(
        halves.select("family", F.slice("words", half + 1, F.size("words")).alias("words"))
    )
    others = spark.createDataFrame([(UNKNOWN, t) for t in OTHERS], "family string, text string")
    others = others.select("family", words_of(F.col("text")).alias("words"))
    fixed = known.unionByName(others)
    vocabulary = sorted(r[0] for r in fixed.select(F.explode(runs_of(F.col("words")))).distinct().collect())
    runs = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="runs", outputCol="features")
    runs = runs.setBinary(True).setMinTF(1.0)

    if sample is None:
        some = docs.select(F.xxhash64(F.col(f"`{id_col}`"), F.lit(seed)).alias("_order"), F.col(f"`{text_col}`").alias("_text")).where("_text IS NOT NULL")
        weight = 0.1 * min(1.0, WEIGHED / max(some.count(), 1))
    else:
        some, weight = drawn(docs, sample, longest, id_col, text_col, seed), 0.1
    low = F.lower("line")
    maybe = reduce(lambda a, b: a | b, (F.contains(low, F.lit(stem)) for stem in STEMS))
    clean = paragraphs(some, "_order", "_text").where(~F.when(maybe, F.col("line").rlike(f"(?i){SIGNALS}|{NAMES}")).otherwise(False))
    clean = known_runs(clean.select((F.col("doc_id") % 2 == 0).alias("trains"), "words"), vocabulary)
    seen = frozen(clean.groupBy("trains", "runs").agg(F.count(F.lit(1)).alias("times")))
    train = fixed.select("family", runs_of(F.col("words")).alias("runs"), F.lit(1.0).alias("weight")).unionByName(
        seen.where("trains").select(F.lit(UNKNOWN).alias("family"), "runs", (weight * F.col("times")).alias("weight"))
    )
    rows = runs.transform(train).select("features", label, "weight").coalesce(max(1, seen.count() // EXAMPLES))
    model = LogisticRegression(
        family="multinomial", weightCol="weight", regParam=0.002, elasticNetParam=0.5, maxIter=100, standardization=False
    ).fit(rows)
    classifier = Classifier(model, runs, families, 0.5)
    rest = classifier.probabilities(seen.where("NOT trains").select("runs", "times"))
    # Probabilities have six places, so there are a million at most.
    reached = rest.where(F.col("likeliest") != UNKNOWN).groupBy("probability").agg(F.sum("times").alias("times")).orderBy("probability").collect()
    enough, so_far = 0.999 * sum(r["times"] for r in reached), 0
    for row in reached:
        so_far += row["times"]
        if so_far >= enough:
            classifier.bar = max(0.5, float(row["probability"]))
            break
    held = seen.select(F.explode("runs").alias("word"), "times").where(~F.contains("word", F.lit(" ")))
    classifier.common = {r["word"]: r["times"] for r in held.groupBy("word").agg(F.sum("times").alias("times")).collect()}
    return classifier


def scan(
    docs: DataFrame, classifier: Classifier, least: float = 0.6, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The licences that paragraphs of ``docs`` name.

    ``doc_id, paragraph long`` (its first line, from 0), ``lines long, family string, probability double,
    similarity double, confirmed boolean``. Every line is judged, and every run of several lines between blank
    ones as a whole; those that by the classifier's own weights cannot reach its bar are not scored. There is a row for each that names a family, and for each other one that holds a signal
    word. ``family`` is the likeliest one, or ``unknown`` if that is likelier or the probability is below the
    calibrated bar. ``similarity`` is the largest share of common word pairs, of the smaller set, that the
    paragraph has with a template of the family; ``least`` confirms. Null and empty texts have no lines;
    repeated rows are scanned each; a null id stays null; an empty table gives no rows; long lines are taken
    whole; other columns are ignored.
    """
    scored = classifier.probabilities(paragraphs(docs, id_col, text_col, f"{SIGNALS}|{classifier.told()}"))
    sure = (F.col("likeliest") != UNKNOWN) & (F.col("probability") >= classifier.bar)
    # Not a filter: pushed below the model, its condition would run the model several times a row.
    told = F.when(sure | F.col("line").rlike(f"(?i){SIGNALS}"), F.array(F.struct("doc_id", "paragraph", "lines", "words", "likeliest", "probability")))
    said = scored.select(F.explode(told).alias("_said")).select("_said.*")
    known = templates(docs.sparkSession).groupBy("family").agg(F.collect_list(F.array_distinct(grams(F.col("words"), 2))).alias("_pairs"))
    own = F.array_distinct(grams(F.col("words"), 2))
    shares = F.transform(
        "_pairs",
        lambda pairs: F.size(F.array_intersect(pairs, F.col("_own"))) / F.greatest(F.lit(1), F.least(F.size(pairs), F.size("_own"))),
    )
    compared = (
        said.withColumn("_own", own)
        .join(F.broadcast(known), F.col("likeliest") == F.col("family"), "left").drop("family")
        .withColumn("similarity", F.round(F.coalesce(F.array_max(shares), F.lit(0.0)), 6))
    )
    return compared.select(
        "doc_id", "paragraph", "lines", F.when(sure, F.col("likeliest")).otherwise(UNKNOWN).alias("family"), "probability",
        "similarity", (sure & (F.col("similarity") >= least)).alias("confirmed"),
    )

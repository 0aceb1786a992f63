"""License scans: a trained paragraph classifier, confirmed against templates.

Paragraphs become sparse word n-grams; multinomial logistic regression gives licence family
probabilities with an unknown class. What it takes for a licence must also share enough word
pairs with a template of that family.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UNKNOWN = "unknown"
FIRST_FAMILY = 1

# Sentences by which licences are announced, per family.
TEMPLATES = {
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "You may not use the material for commercial purposes under the CC BY-NC license.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "proprietary": [
        "All rights reserved. Unauthorized copying of this file, via any medium, is strictly prohibited and confidential.",
        "No part of this publication may be reproduced without the prior written permission of the copyright holder.",
    ],
}
# Sentences with words of licences that announce none.
OTHER = [
    "A driver must carry a license at all times.",
    "The licence fee was raised by the council last year.",
    "She asked for permission to leave the room.",
    "The bank gave no warranty for the public.",
    "He has a fishing license from the general office, version of last year.",
    "The apache tribe lived under the terms of an old treaty.",
    "Students at MIT work under the general rule of free copy.",
    "They met in a public place and use the source of the river.",
    "The copyright office opened in the capital.",
    "Permission for the parade was granted by the city.",
    "Redistribution of land was the main demand of the farmers.",
    "The license plate was found near the library.",
    "This work is about the use of software in schools.",
    "Creative people work in common rooms.",
    "You may obtain a copy of the book at the library.",
    "The restaurant lost its liquor license in April.",
]
# Wrapped sentences are read in windows of so many lines, one from every seventh line on: any six
# neighbouring lines are together in one.
WINDOW_LINES, WINDOW_STEP = 12, 7
# Paragraphs with one of these are returned even if their family is unknown.
CUES = r"(?i)licen[cs]|copyright|permission|redistribut|rights reserved|public domain|spdx"
# Words put around the sentences to make further training paragraphs.
AROUND = ["", "Note:", "See the file for details.", "Copyright (c) 2020 The Authors.", "# //", "and the of was in"]


def labelled_paragraphs(spark: SparkSession) -> DataFrame:
    """(paragraph, family): templates and other sentences, each in several surroundings."""
    rows = []
    for family, sentences in [*TEMPLATES.items(), (UNKNOWN, OTHER)]:
        for sentence in sentences:
            rows += [(f"{words} {sentence}", family) for words in AROUND]
            rows += [(f"{sentence} {words}", family) for words in AROUND]
    rows += [(words, UNKNOWN) for words in AROUND]
    return spark.createDataFrame(rows, "paragraph string, family string").coalesce(1)


def _words(text: Column) -> Column:
    """64-bit digests of the words: numbers are cheaper to join, hash and compare than strings."""
    return F.transform(F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), ""), lambda w: F.xxhash64(w))


def _pairs(words: Column) -> Column:
    first = F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0)))
    return F.transform(first, lambda w, i: F.xxhash64(w, F.get(words, i + 1)))


@dataclass
class LicenseModel:
    pipeline: PipelineModel
    families: list[str]
    # A family is believed from this probability on.
    threshold: float


def train_license_model(labelled: DataFrame, features: int = 1 << 15, ridge: float = 0.001) -> LicenseModel:
    """Regression on (paragraph, family) rows, its unknown class calibrated on held-out ones.

    One row in four is held out; the threshold lies in the middle between the largest family
    probability of a held-out unknown paragraph and the 5th percentile of the right families'.
    """
    families = [UNKNOWN, *sorted(r[0] for r in labelled.filter(F.col("family") != UNKNOWN).select("family").distinct().collect())]
    label = reduce(lambda rest, f: F.when(F.col("family") == f, float(families.index(f))).otherwise(rest), families, F.lit(None))
    rows = with_ngrams(labelled.filter(F.col("paragraph").isNotNull())).withColumn("label", label)
    held = F.pmod(F.xxhash64("paragraph"), F.lit(4)) == 0
    hashing = HashingTF(numFeatures=features, binary=True, inputCol="__grams", outputCol="__features")
    regression = LogisticRegression(
        family="multinomial", featuresCol="__features", labelCol="label", probabilityCol="__probability",
        rawPredictionCol="__raw", predictionCol="__prediction", regParam=ridge, maxIter=60,
    )
    pipeline = Pipeline(stages=[hashing, regression])
    probabilities = vector_to_array("__probability")
    best = F.array_max(F.slice(probabilities, F.lit(FIRST_FAMILY + 1), F.size(probabilities)))
    scored = pipeline.fit(rows.filter(~held)).transform(rows.filter(held)).withColumn("best", best)
    right = F.col("__prediction") == F.col("label")
    negative, positive = scored.agg(
        F.max(F.when(F.col("label") == 0, F.col("best"))),
        F.percentile(F.when((F.col("label") > 0) & right, F.col("best")), 0.05),
    ).first()
    threshold = min(0.9, max(0.3, ((negative or 0.0) + (positive or 1.0)) / 2))
    return LicenseModel(pipeline.fit(rows), families, threshold)


def with_ngrams(df: DataFrame) -> DataFrame:
    if "__words" not in df.columns:
        df = df.withColumn("__words", _words(F.col("paragraph")))
    df = df.withColumn("__pairs", _pairs(F.col("__words")))
    return df.withColumn("__grams", F.concat("__words", "__pairs"))


def scan_licenses(docs: DataFrame, model: LicenseModel, confirm_from: float = 0.6) -> DataFrame:
    """(doc_id, paragraph_no, family, score, similarity, confirmed, paragraph, lines) per paragraph of a licence.

    Paragraphs are the lines of a text, numbered from 1, and windows of ``WINDOW_LINES`` lines,
    numbered by their first, for sentences that are wrapped. All are classified. ``family`` is
    ``unknown`` where no family reaches the calibrated threshold. ``similarity`` is the largest
    share of a template's word pairs found in the paragraph, over the family's templates; the
    prediction is ``confirmed`` from ``confirm_from`` on, a window's unless a window that overlaps
    is more similar to another family. Returned are lines with a family or a
    licence word, and windows with a family that none of their lines has, or none confirmed
    where the window is. Windows that overlap may tell of the same sentence. Null and empty
    texts have no paragraphs; repeated rows give repeated results; extra columns are not looked
    at; null ids stay null.
    """
    # Every line is cut into words once; a window has the words of its lines.
    split = docs.select("doc_id", F.monotonically_increasing_id().alias("__row"), F.split("text", "\r?\n").alias("__lines"))
    split = split.withColumn("__line_words", F.transform("__lines", lambda x: _words(x)))
    size = F.size("__lines")
    starts = F.when(size > 1, F.sequence(F.lit(0), F.greatest(size - 2, F.lit(0)), F.lit(WINDOW_STEP))).otherwise(F.array().cast("array<int>"))
    words = F.col("__line_words")
    single = F.transform("__lines", lambda x, i: F.struct(
        i.alias("n"), F.lit(1).alias("lines"), x.alias("paragraph"), F.get(words, i).alias("__words")))
    joined = F.transform(starts, lambda i: F.struct(
        i.alias("n"), F.least(F.lit(WINDOW_LINES), size - i).alias("lines"),
        F.array_join(F.slice("__lines", i + 1, F.lit(WINDOW_LINES)), "\n").alias("paragraph"),
        F.flatten(F.slice(words, i + 1, F.lit(WINDOW_LINES))).alias("__words"),
    ))
    paragraphs = split.select("doc_id", "__row", F.inline(F.concat(single, joined)))
    rows = with_ngrams(paragraphs.filter(F.col("paragraph").rlike(r"\S")))
    hashing, regression = model.pipeline.stages
    scored = regression.transform(hashing.transform(rows))
    probabilities = vector_to_array("__probability")
    # Unpacked from an array, so that the filter below is not run with copies of the whole model.
    scored = scored.select("doc_id", "__row", "n", "lines", "paragraph", "__pairs", F.inline(F.array(F.struct(probabilities.alias("__p")))))
    families = F.array(*[F.lit(f) for f in model.families])
    best = F.array_max(F.slice("__p", F.lit(FIRST_FAMILY + 1), F.size("__p")))
    scored = scored.withColumn("score", best)
    family = F.when(F.col("score") >= model.threshold, F.element_at(families, F.array_position("__p", F.col("score")).cast("int")))
    scored = scored.withColumn("family", F.coalesce(family, F.lit(UNKNOWN)))
    scored = scored.filter((F.col("family") != UNKNOWN) | ((F.col("lines") == 1) & F.col("paragraph").rlike(CUES)))
    spark = docs.sparkSession
    templates = spark.createDataFrame(
        [(f, t) for f, sentences in TEMPLATES.items() for t in sentences], "family string, paragraph string"
    )
    # The template pairs are a constant of the plan: a few dozen short arrays.
    pairs = {
        r["family"]: r["all"]
        for r in with_ngrams(templates).groupBy("family").agg(F.collect_list(F.array_distinct("__pairs")).alias("all")).collect()
    }
    shared = F.lit(0.0)
    for name, arrays in sorted(pairs.items()):
        shares = [F.size(F.array_intersect("__pairs", F.array(*[F.lit(x) for x in a]))) / len(a) for a in arrays if a]
        shared = F.when(F.col("family") == name, F.greatest(*shares, F.lit(0.0))).otherwise(shared)
    confirmed = (F.col("family") != UNKNOWN) & (F.col("similarity") >= confirm_from)
    told = scored.select("doc_id", "__row", "n", "lines", "family", "score", shared.alias("similarity"), "paragraph")
    # Half of a sentence may resemble that of another family: what windows around tell better is not confirmed.
    around = Window.partitionBy("__row").orderBy("n").rangeBetween(1 - WINDOW_LINES, WINDOW_LINES - 1)
    own = Window.partitionBy("__row", "family").orderBy("n").rangeBetween(1 - WINDOW_LINES, WINDOW_LINES - 1)
    joint = F.when(F.col("lines") > 1, F.col("similarity"))
    told = told.withColumn("__rival", F.max(joint).over(around)).withColumn("__own", F.max(joint).over(own))
    told = told.withColumn("confirmed", confirmed & ((F.col("lines") == 1) | (F.col("__own") >= F.col("__rival"))))
    # What the lines of a window tell of its family: 2 confirmed, 1 not, 0 nothing.
    level = F.when(F.col("confirmed"), 2).otherwise(1)
    inside = Window.partitionBy("__row", "family").orderBy("n").rangeBetween(0, WINDOW_LINES - 1)
    by_lines = F.coalesce(F.max(F.when(F.col("lines") == 1, level)).over(inside), F.lit(0))
    kept = told.withColumn("__by_lines", by_lines).filter((F.col("lines") == 1) | (level > F.col("__by_lines")))
    return kept.select(
        "doc_id", (F.col("n") + 1).alias("paragraph_no"), "family", "score", "similarity", "confirmed", "paragraph", "lines"
    )

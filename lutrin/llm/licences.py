"""Licence scans with a trained paragraph classifier, in DataFrame functions only.

A logistic regression over word n-grams tells licence families from other paragraphs. It is
trained on notices built from templates and on all of the corpus' own paragraphs as the
unknown class; paragraphs that have the same n-grams of the known ones are one weighted row.
Coefficients that do not matter are dropped, so the model is
a short table. A paragraph without any positive n-gram cannot reach a family and is passed
over; the others are scored by a join with that table. The unknown class is calibrated on
held-out rows, with all paragraphs that speak of licences without being a notice among
them, and a prediction counts as confirmed if the words of a template of its family are there.
"""

import re
from functools import reduce
from operator import or_

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Window
from pyspark.sql import functions as F

from lutrin.llm.common import Scratch

# Notices by which the families are known.
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "This project is released under the Apache 2.0 license.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "SPDX-License-Identifier: MIT",
        "This project is licensed under the terms of the MIT license.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Licensed under GPL v3.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "Licensed under GPL v2.",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "Licensed under the LGPL.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Licensed under the BSD 3-Clause License.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Released under CC BY-NC-SA 4.0.",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
}
# Words around a notice in training, and sentences that speak of licences without being one.
FRAMES = ["{}", "Copyright 2020 the authors. {}", "All rights reserved. {}", "{} See the file for details."]
OTHERS = [
    "The driver lost his license last year.",
    "A software license is a legal instrument.",
    "The general public was free to use the library.",
    "The commons attribution of the work is not known.",
    "Version 3 of the document was released under pressure.",
    "Permission was granted to build a house with a copy of the plan.",
    "All rights reserved.",
    "Copyright 2020 the authors.",
    "The terms and conditions of the public school were met.",
]
UNKNOWN = "unknown"
CUE = r"licen[sc]e|copyright|spdx|\bl?gpl|creative commons|\bcc by|\bcc0|permission is hereby|redistribution and use|source code form"

#: Every match of CUE has one of these.
CUE_PARTS = ["licen", "copyright", "spdx", "gpl", "creative commons", "cc by", "cc0", "permission is hereby", "redistribution and use", "source code form"]
WORD = r"[\p{L}\p{N}]+"

#: Weight of the corpus' paragraphs together, where there are more of them; one in so many is held out.
CORPUS_WEIGHT, FOLDS = 4000, 5
#: Coefficients below this are dropped; share of a template's words that confirms a prediction.
LEAST, CONFIRMED = 0.05, 0.8
#: Bounds of the calibrated threshold. A prediction that a template confirms only has to beat the lower one.
LIKELY, SURE = 0.5, 0.99
#: A notice may be wrapped over so many lines.
WRAP = 5
NEVER = "(?!)"


def words_of(paragraph):
    """Lower-case words; those of an identifier such as CC BY-NC are apart."""
    return F.regexp_extract_all(F.lower(paragraph), F.lit(WORD), F.lit(0))


def grams_of(words):
    """Distinct words and pairs of neighbours."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    both = F.arrays_zip(F.slice(words, 1, n).alias("a"), F.slice(words, 2, n).alias("b"))
    return F.array_distinct(F.concat(words, F.transform(both, lambda x: F.concat_ws(" ", x["a"], x["b"]))))


def paragraphs_of(text):
    return F.split(F.coalesce(text, F.lit("")), r"\r?\n", -1)


def templates():
    return F.array(
        *(F.struct(F.lit(f).alias("family"), grams_of(words_of(F.lit(n))).alias("grams")) for f, list_ in NOTICES.items() for n in list_)
    )


def likeness(found, words):
    """Largest share of a template's words and pairs that is among `words`; null without templates."""
    return F.array_max(F.transform(found, lambda t: F.size(F.array_intersect(t["grams"], words)) / F.size(t["grams"])))


def around(lists, place):
    """The line at `place` with those before and after it that a wrapped notice may take."""
    lines = F.slice(lists, F.greatest(place - WRAP + 2, F.lit(1)), F.least(place + 1, F.lit(WRAP)) + WRAP - 1)
    return F.array_join(lines, " ")


def known_paragraphs():
    """(label, paragraph): notices in frames, and sentences that are none."""
    notices = [(family, frame.replace("{}", notice)) for family, list_ in NOTICES.items() for notice in list_ for frame in FRAMES]
    return notices + [(UNKNOWN, sentence) for sentence in OTHERS for _ in range(3)]


def vocabulary():
    """Words and pairs of neighbours in the known paragraphs: fixed, whatever the corpus."""
    found = set()
    for _, paragraph in known_paragraphs():
        words = re.findall(r"[a-z0-9]+", paragraph.lower())
        found |= {*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))}
    return sorted(found)


def known_grams_of(words):
    """Distinct words and pairs of neighbours that are in the vocabulary, sorted."""
    grams = vocabulary()
    single = [g for g in grams if " " not in g]
    n = F.greatest(F.size(words) - 1, F.lit(0))
    both = F.arrays_zip(F.slice(words, 1, n).alias("a"), F.slice(words, 2, n).alias("b"))
    both = F.filter(both, lambda x: x["a"].isin(single) & x["b"].isin(single))
    both = F.filter(F.transform(both, lambda x: F.concat_ws(" ", x["a"], x["b"])), lambda g: g.isin(grams))
    return F.array_sort(F.array_distinct(F.concat(F.filter(words, lambda w: w.isin(single)), both)))


def training_rows(spark, docs, text, folds=FOLDS):
    """(label, words, sampled, held, n): notices in frames, other sentences, and all paragraphs of the corpus as unknown.

    Paragraphs with the same words and pairs of the vocabulary are one row, n of them. Of the
    corpus' paragraphs without cue words one in `folds`, told by a hash, is held out and the
    others are learned from; those with cue words, unless part of a template's text, are held out.
    """

    def quoted(value):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    body = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in known_paragraphs())
    known = spark.sql(f"SELECT * FROM VALUES {body} AS t(label, paragraph)")
    known = known.select("label", known_grams_of(words_of(F.col("paragraph"))).alias("words"), F.lit(False).alias("sampled"), F.lit(False).alias("held"))

    def cue(paragraph):
        # plain searches go before the pattern, which is slow
        return reduce(or_, [paragraph.contains(part) for part in CUE_PARTS]) & paragraph.rlike(CUE)

    lists = docs.where(F.length(text) > 0).select(paragraphs_of(F.lower(text)).alias("list"))
    # paragraphs that may be notices are no examples to learn the unknown class from
    plain = lists.select(F.explode("list").alias("paragraph")).where(F.col("paragraph").rlike(WORD) & ~cue(F.col("paragraph")))
    plain = plain.select(words_of(F.col("paragraph")).alias("all"), (F.pmod(F.xxhash64("paragraph"), F.lit(folds)) == 0).alias("held"))
    plain = plain.select(known_grams_of(F.col("all")).alias("words"), "held")
    places = F.filter(F.transform("list", lambda p, i: F.when(cue(p), i)), lambda i: i.isNotNull())
    hard = lists.select("list", F.explode(places).alias("place"))
    hard = hard.select(
        known_grams_of(words_of(F.get("list", F.col("place")))).alias("words"),
        known_grams_of(words_of(around(F.col("list"), F.col("place")))).alias("near"),
    )
    hard = hard.where(likeness(templates(), F.col("near")) < CONFIRMED).select("words", F.lit(True).alias("held"))
    corpus = plain.unionByName(hard).select(F.lit(UNKNOWN).alias("label"), "words", F.lit(True).alias("sampled"), "held")
    return known.unionByName(corpus).groupBy("label", "words", "sampled", "held").agg(F.count(F.lit(1)).alias("n"))


def train(spark, scratch, docs, text="text", corpus_weight=CORPUS_WEIGHT):
    """Fit the classifier: (families, intercepts, rows of (gram, weights), training rows)."""
    rows = scratch.save(training_rows(spark, docs, text), "training")
    learned = rows.where("sampled AND NOT held").agg(F.sum("n")).first()[0] or 1
    families = [*NOTICES, UNKNOWN]
    number = F.array_position(F.array(*map(F.lit, families)), F.col("label")) - 1
    # every paragraph of the corpus counts, together no more than corpus_weight: the families are rare
    share = F.when(F.col("sampled"), min(1.0, corpus_weight / learned)).when(F.col("label") == UNKNOWN, 1.0).otherwise(3.0)
    weighted = rows.where("NOT held").withColumn("y", number.cast("double")).withColumn("weight", F.col("n") * share)
    counted = CountVectorizerModel.from_vocabulary(vocabulary(), inputCol="words", outputCol="features")
    logistic = LogisticRegression(labelCol="y", weightCol="weight", regParam=1e-3, elasticNetParam=0.5, maxIter=30, family="multinomial", standardization=False)
    fitted = logistic.fit(counted.transform(weighted))
    table, intercepts = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    # relative to the unknown class, which then scores zero
    table, intercepts = table[:-1] - table[-1], intercepts[:-1] - intercepts[-1]
    table[abs(table) < LEAST] = 0
    used = [i for i in range(table.shape[1]) if table[:, i].any()]
    weights = [(counted.vocabulary[i], [float(x) for x in table[:, i]]) for i in used]
    return families[:-1], [float(x) for x in intercepts], weights, rows


def cues(weights, intercepts, frequency):
    """A pattern of words of which every paragraph that a family can win has at least one.

    A family wins only with a positive sum of its intercept and weights. So words may be left
    out of the pattern, the most frequent first, as long as all n-grams made of left-out words
    together cannot lift any family above zero. If an intercept is positive, every paragraph
    has to be scored.
    """
    if max(intercepts) > 0:
        return ""
    grams = [(gram.split(" "), values) for gram, values in weights if max(values) > 0]
    words = sorted({w for parts, _ in grams for w in parts}, key=lambda w: (-frequency.get(w, 0), w))
    left_out = set()
    for word in words:
        trial = left_out | {word}
        inside = [values for parts, values in grams if trial.issuperset(parts)]
        if all(bias + sum(max(v[f], 0) for v in inside) <= 0 for f, bias in enumerate(intercepts)):
            left_out = trial
    kept = [w for w in words if w not in left_out]
    return r"(?iu)(?<![\p{L}\p{N}])(?:" + "|".join(sorted(kept)) + r")(?![\p{L}\p{N}])" if kept else NEVER


def scored(spark, rows, families, intercepts, weights, keys):
    """Probability of every family for rows (keys, words): keys, family, probability of the best, and that of unknown."""
    n = len(families)

    def quoted(value):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    body = ", ".join(f"({quoted(g)}, array({', '.join(f'{x}D' for x in v)}))" for g, v in weights)
    table = spark.sql(f"SELECT * FROM VALUES {body} AS t(gram, weights)") if weights else spark.createDataFrame([], "gram string, weights array<double>")
    parts = rows.select(*keys, F.explode("words").alias("gram")).join(F.broadcast(table), "gram")  # no more than the vocabulary
    # rounded, so that equal paragraphs score the same in whatever order their n-grams meet
    sums = parts.groupBy(*keys).agg(*(F.round(F.sum(F.col("weights")[i]), 9).alias(f"s{i}") for i in range(n)))
    scores = F.array(*(F.col(f"s{i}") + intercepts[i] for i in range(n)))
    sums = sums.select(*keys, scores.alias("scores")).withColumn("top", F.array_max("scores"))
    total = F.aggregate(F.transform("scores", lambda s: F.exp(s - F.greatest("top", F.lit(0.0)))), F.exp(-F.greatest("top", F.lit(0.0))), lambda a, x: a + x)
    best = F.get(F.array(*map(F.lit, families)), (F.array_position("scores", F.col("top")) - 1).cast("int"))
    return sums.select(*keys, best.alias("family"), (F.exp(F.col("top") - F.greatest("top", F.lit(0.0))) / total).alias("probability"))


def find_licences(docs, doc_id="doc_id", text="text", corpus_weight=CORPUS_WEIGHT):
    """Licence notices of every document.

    One row per row of `docs`: doc_id, n_paragraphs, licences (ordered by paragraph: number
    from 0, family, probability, similarity to the nearest template, confirmed) and the
    calibrated threshold, which predictions have to exceed that no template confirms; for the
    others LIKELY is enough. Paragraphs are lines; a notice that is wrapped over up to WRAP lines,
    behind comment marks or not, is found around a line that has a word of it, and reported
    with the number of the first such line, if a template confirms it. Of the same family, one
    is reported for lines that near each other. Null and empty texts have one empty paragraph
    and no licence; equally likely families go to the one listed first; null and repeated
    doc_ids are carried as they are; further columns are ignored; an empty table gives no
    rows. Texts of any length are read whole, by training and calibration too.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "licences")
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    families, intercepts, weights, training = train(spark, scratch, docs, "text", corpus_weight)
    held = training.where("held").withColumn("row", F.monotonically_increasing_id())
    worst = scored(spark, held, families, intercepts, weights, ["row"]).agg(F.max("probability")).first()[0]
    threshold = max(LIKELY, min(SURE, worst or 0.0))

    words = training.where("sampled").select(F.explode("words").alias("word"), "n").where(~F.col("word").contains(" "))
    frequency = {r.word: r.n for r in words.groupBy("word").agg(F.sum("n").alias("n")).collect()}  # no more than the vocabulary
    pattern = cues(weights, intercepts, frequency)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lists = paragraphs_of(F.col("text"))
    numbered = F.transform(lists, lambda p, i: F.struct(i.alias("place"), p.alias("paragraph")))
    some = F.filter(numbered, lambda x: x["paragraph"].rlike(pattern)) if pattern else numbered

    def wide(x):
        return F.struct(x["place"].alias("place"), around(lists, x["place"]).alias("paragraph"), F.lit(True).alias("wide"))

    single = F.transform(some, lambda x: F.struct(x["place"].alias("place"), x["paragraph"].alias("paragraph"), F.lit(False).alias("wide")))
    some = F.concat(single, F.when(F.size(lists) > 1, F.transform(some, wide)).otherwise(F.slice(single, 1, 0)))
    marker = F.expr("array(named_struct('place', -1, 'paragraph', '', 'wide', false))")
    none = F.array().cast("array<struct<place:int,paragraph:string,wide:boolean>>")
    candidates = F.when(F.col("text").rlike(pattern), some).otherwise(none) if pattern else some
    exploded = rows.select("row", "doc_id", F.size(lists).cast("long").alias("n_paragraphs"), F.explode(F.concat(marker, candidates)).alias("part"))
    exploded = exploded.select("row", "doc_id", "n_paragraphs", "part.*").repartition("row")
    exploded = scratch.save(exploded, "candidates", compression="zstd")

    keys = ["row", "place", "wide"]
    worded = exploded.where("place >= 0").select(*keys, grams_of(words_of(F.col("paragraph"))).alias("words"))
    predicted = scored(spark, worded, families, intercepts, weights, keys).where(F.col("probability") > LIKELY)
    predicted = predicted.join(worded, keys)
    own = F.filter(templates(), lambda t: t["family"] == F.col("family"))
    predicted = predicted.withColumn("similarity", likeness(own, F.col("words")))
    predicted = predicted.where((F.col("probability") > threshold) | (F.col("similarity") >= CONFIRMED))
    # a wrapped notice counts if no line confirms its family alone, and once however many of its lines have a word of it
    near = Window.partitionBy("row", "family").orderBy("place")
    sure = F.col("similarity") >= CONFIRMED
    alone = F.max(F.when(~F.col("wide") & sure, 1)).over(near.rangeBetween(1 - WRAP, WRAP - 1))
    before = F.max(F.when(F.col("wide") & sure, 1)).over(near.rangeBetween(2 - 2 * WRAP, -1))
    predicted = predicted.withColumn("alone", alone).withColumn("before", before)
    predicted = predicted.where(~F.col("wide") | (sure & F.col("alone").isNull() & F.col("before").isNull()))
    found = predicted.select(
        "row", F.struct("place", "family", "probability", "similarity", (F.col("similarity") >= CONFIRMED).alias("confirmed")).alias("licence")
    )
    found = found.groupBy("row").agg(F.array_sort(F.collect_list("licence")).alias("licences"))
    empty = F.array().cast("array<struct<place:int,family:string,probability:double,similarity:double,confirmed:boolean>>")
    return exploded.where("place < 0").join(found, "row", "left").select(
        "doc_id", "n_paragraphs", F.coalesce("licences", empty).alias("licences"), F.lit(float(threshold)).alias("threshold")
    )

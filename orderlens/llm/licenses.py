"""Licence scans: a trained paragraph classifier whose predictions a template comparison confirms.

Every line of a document and every run of lines between blank lines is scored, so a
notice is found on one line and wrapped over several. A sparse (L1) multinomial logistic regression over hashed words and
word pairs tells the licence families and the class "unknown" apart. It learns from the
notices below, whole and with words dropped and prose around them, and from a bounded
sample of lines and paragraphs (of the ``MAX_SAMPLED`` documents with the smallest hash) that hold none of the notices:
``MAX_PROSE`` of them, and ``MAX_CUED`` more that talk of licences all the same
(``CUE``, which decides nothing else). The log odds of "not unknown" are
calibrated on rows held out from training. A prediction is confirmed when enough of the
word triples of one of the family's notices occur in the paragraph.

Everything is DataFrame functions and ``pyspark.ml``; no Python runs on executors.

Defined cases: null and empty texts have no paragraphs; repeated rows repeat; a null id stays
null; without prose in the corpus the unknown class learns from an empty
paragraph; an empty table gives none. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import keep, small_table

# The usual short notices of each family.
NOTICES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "Distributed under the terms of the LGPL, version 2.1.",
        "LGPL-2.1-or-later",
        "LGPL-3.0-or-later",
        "unter der Lizenz LGPL 2.1",
    ],
    "agpl-3.0": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "Distributed under AGPLv3.",
        "AGPL-3.0-or-later",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
        "BSD-3-Clause",
        "BSD-2-Clause",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "Subject to the terms of the MPL 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "unter der Lizenz MPL 2.0",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc0": [
        "Released into the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
    "proprietary": [
        "All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the copyright holder.",
    ],
}
CUE = (
    r"(?i)licen[cs]|lizen[sz]|copyright|\bgnu\b|\b[al]?gpl|\bbsd\b|\bmpl\b|\bspdx|creative commons|\bcc[ -]?(?:by|0)|public domain"
    r"|permission is hereby|rights reserved|redistribut"
)

FAMILIES = list(NOTICES)
FEATURES = 1 << 13
COPIES = 40
DROPPED_PERCENT = 8
MAX_SAMPLED, MAX_PROSE, MAX_CUED, MAX_WORDS = 500, 3_000, 1_000, 500
HELD_OUT = 4  # one in so many training rows calibrates
KNOWN = 0.5
CONFIRMED = 0.6


def words_of(paragraph: Column) -> Column:
    return F.regexp_extract_all(F.lower(paragraph), F.lit(r"[a-z0-9]+(?:\.[0-9]+)*"), F.lit(0))


def grams(words: Column, size: int) -> Column:
    """Runs of ``size`` words; a shorter paragraph has none, and one with a null word is null."""
    count = F.size(words) - (size - 1)
    shifted = [F.slice(words, start, count) for start in range(1, size + 1)]
    joined = reduce(lambda left, right: F.zip_with(left, right, lambda a, b: F.concat(a, F.lit(" "), b)), shifted)
    return F.when(count > 0, joined).otherwise(F.array().cast("array<string>"))


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """``rows`` with a costly ``value`` that is worked out once a row.

    A filter on a plain column is moved below it, and its expression goes along, to be worked out again for every mention
    of it; what comes out of an explode stays a column.
    """
    others = [c for c in rows.columns if c != name]
    return rows.select(*others, F.explode(F.array(value)).alias(name))


def with_features(rows: DataFrame, words: Column, pairs: Column) -> DataFrame:
    """``rows`` with hashed ``words`` and word ``pairs``."""
    terms = rows.withColumn("terms", F.concat(words, pairs))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="terms", outputCol="features").transform(terms)


def notices(spark) -> DataFrame:
    """(family, label, notice, words, triples); label 0 is unknown."""
    rows = [
        (family, label, f"{family}/{number}", text)
        for label, (family, texts) in enumerate(NOTICES.items(), start=1)
        for number, text in enumerate(texts)
    ]
    table = small_table(spark, rows, "family string, label int, notice string, text string")
    table = table.withColumn("words", words_of(F.col("text"))).drop("text")
    # A notice of two words is compared as a whole.
    size = F.least(F.size("words"), F.lit(3))
    triples = F.when(size == 3, grams(F.col("words"), 3)).otherwise(F.array(F.array_join("words", " ")))
    return table.withColumn("triples", F.array_distinct(triples))


def prose(docs: DataFrame) -> DataFrame:
    """(number, words): the bounded sample of paragraphs without a notice, numbered from 0."""
    ids = docs.filter("doc_id is not null").select("doc_id").distinct()
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_SAMPLED)
    texts = paragraphs(docs.join(F.broadcast(ids), "doc_id")).select(F.array_join("lines", "\n").alias("line")).distinct()
    texts, cued = keep(texts, "licence-sample"), F.col("line").rlike(CUE)
    first = lambda rows, most: rows.orderBy(F.xxhash64("line"), "line").limit(most)
    some = first(texts.filter(~cued), MAX_PROSE).unionByName(first(texts.filter(cued), MAX_CUED))
    some = keep(some.select("line", F.slice(words_of(F.col("line")), 1, MAX_WORDS).alias("words")), "licence-words")
    # Stored, because a filter would work the grams out once per notice.
    triples = _triples(docs.sparkSession)
    plain = keep(some.withColumn("grams", _noticed(F.col("words"), triples)), "licence-grams")
    plain = plain.filter(~_holds(F.col("grams"), triples))
    by_hash = Window.orderBy(F.xxhash64("line"), "line")  # of MAX_PROSE + MAX_CUED rows at most
    return plain.select((F.row_number().over(by_hash) - 1).alias("number"), "words")


def training_rows(docs: DataFrame) -> DataFrame:
    """(label, held_out, words)."""
    spark = docs.sparkSession
    plain = keep(prose(docs), "prose")
    count = plain.count()
    copies = notices(spark).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    draw = lambda i, *more: F.pmod(F.xxhash64("notice", "copy", *more), F.lit(i))
    copies = copies.withColumns({"number": draw(max(count, 1)).cast("int"), "held_out": draw(HELD_OUT, F.lit("held")) == 0})
    around = F.coalesce(F.col("prose.words"), F.array().cast("array<string>"))
    kept = F.filter(
        "c.words", lambda w, i: (F.col("copy") == 0) | (F.pmod(F.xxhash64(w, i, "copy"), F.lit(100)) >= DROPPED_PERCENT)
    )
    # Copies come bare, before, after and amid prose.
    place = F.pmod("copy", F.lit(4))
    none = F.array().cast("array<string>")
    before = F.when(place >= 2, F.slice(around, 1, 30)).otherwise(none)
    after = F.when((place == 1) | (place == 3), F.slice(around, 1, 30)).otherwise(none)
    known = copies.alias("c").join(F.broadcast(plain).alias("prose"), "number", "left").select(
        F.col("label").cast("double").alias("label"), "held_out", F.concat(before, kept, after).alias("words")
    )
    unknown = plain.select(F.lit(0.0).alias("label"), (F.pmod("number", F.lit(HELD_OUT)) == 0).alias("held_out"), "words")
    empty = small_table(spark, [(0.0, False), (0.0, True)], "label double, held_out boolean").withColumn("words", none)
    return known.unionByName(unknown).unionByName(empty)


def _odds(model, rows: DataFrame) -> DataFrame:
    """``rows`` with class probabilities and the log odds of "not unknown"."""
    scored = _once(model.transform(rows), "p", vector_to_array("probability"))
    clipped = F.greatest(F.least(F.col("p")[0], F.lit(1 - 1e-12)), F.lit(1e-12))
    return scored.withColumn("odds", F.log((1 - clipped) / clipped))


class LicenceModel:
    """A fitted classifier with its calibration."""

    def __init__(self, docs: DataFrame):
        rows = keep(training_rows(docs), "licence-training")
        shape = dict(featuresCol="features", labelCol="label", maxIter=40, standardization=False)
        featured = lambda some: with_features(some, F.col("words"), grams(F.col("words"), 2))
        train = featured(rows.filter("not held_out"))
        self.model = LogisticRegression(family="multinomial", regParam=5e-4, elasticNetParam=1.0, **shape).fit(train)
        held = _odds(self.model, featured(rows.filter("held_out")))
        held = VectorAssembler(inputCols=["odds"], outputCol="odd").transform(
            held.select("odds", (F.col("label") > 0).cast("double").alias("label"))
        )
        shape["featuresCol"] = "odd"
        calibration = LogisticRegression(family="binomial", regParam=1e-3, **shape).fit(held)
        self.slope, self.offset = float(calibration.coefficients[0]), float(calibration.intercept)

    def predict(self, rows: DataFrame) -> DataFrame:
        """``rows`` (line_words, pairs, ...) with family and probability; rows of unknown licence go."""
        scored = _odds(self.model, with_features(rows, F.flatten("line_words"), F.col("pairs")))
        known = 1 / (1 + F.exp(-(F.col("odds") * self.slope + self.offset)))
        classes = F.slice("p", 2, len(FAMILIES))
        best = F.element_at(F.array(*map(F.lit, FAMILIES)), F.array_position(classes, F.array_max(classes)).cast("int"))
        scored = scored.withColumns({"probability": known, "family": best}).filter(F.col("probability") >= KNOWN)
        return scored.select(*rows.columns, "family", "probability")


def _runs(docs: DataFrame) -> DataFrame:
    """(doc_id, all, runs): the lines of a text, and first line and length of what lies between blank ones."""
    texts = docs.select("doc_id", F.split("text", "\n").alias("all"))
    blank = F.filter(F.transform("all", lambda line, i: F.when(~line.rlike(r"\S"), i)), lambda i: i.isNotNull())
    texts = texts.withColumn("edges", F.concat(F.array(F.lit(-1)), blank, F.array(F.size("all"))))
    count = F.size("edges") - 1
    runs = F.zip_with(
        F.slice("edges", 1, count), F.slice("edges", 2, count),
        lambda a, b: F.struct((a + 1).alias("paragraph"), (b - a - 1).alias("n")),
    )
    return texts.select("doc_id", "all", runs.alias("runs"))


def _lines_of(longer_than: int) -> Column:
    """(paragraph, lines) of the runs of more lines than that."""
    return F.transform(
        F.filter("runs", lambda run: run["n"] > longer_than),
        lambda run: F.struct(run["paragraph"].alias("paragraph"), F.slice("all", run["paragraph"] + 1, run["n"]).alias("lines")),
    )


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph, lines): every line, and every run of two or more lines between blank ones, by its first line's number."""
    line_runs = F.transform("all", lambda line, i: F.struct(i.alias("paragraph"), F.array(line).alias("lines")))
    # Texts leave before the rows multiply, or every line would carry its whole document.
    rows = _runs(docs).select("doc_id", F.concat(line_runs, _lines_of(1)).alias("runs"))
    # Outer, or the optimizer would work the runs out a second time to leave out null texts, and below a join with few documents.
    return rows.select("doc_id", F.inline_outer("runs")).filter("lines is not null")


def paragraph_words(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph, line_words, pairs) of the ``paragraphs`` that have words: those of each line, and all word pairs.

    A line's words and pairs are worked out once, for itself and for its run.
    """
    rows = _runs(docs).select("doc_id", _lines_of(0).alias("runs")).select("doc_id", F.inline_outer("runs"))
    rows = _once(rows, "lines", F.transform("lines", words_of)).withColumnRenamed("lines", "line_words")
    rows = _once(rows, "line_pairs", F.transform("line_words", lambda words: grams(words, 2)))
    lines = F.transform("line_words", lambda words, i: F.struct(
        (F.col("paragraph") + i).alias("paragraph"), F.array(words).alias("line_words"), F.get("line_pairs", i).alias("pairs")
    ))
    ends = F.transform(
        F.filter("line_words", lambda words: F.size(words) > 0),
        lambda words: F.struct(F.get(words, F.lit(0)).alias("first"), F.element_at(words, -1).alias("last")),
    )
    rows = _once(rows, "ends", ends)
    across = F.zip_with(
        F.slice("ends", 1, F.greatest(F.size("ends") - 1, F.lit(0))), F.slice("ends", 2, F.size("ends")),
        lambda a, b: F.concat(a["last"], F.lit(" "), b["first"]),
    )
    run = F.struct("paragraph", "line_words", F.concat(F.flatten("line_pairs"), across).alias("pairs"))
    every = F.when(F.size("line_words") > 1, F.concat(lines, F.array(run))).otherwise(lines)
    rows = rows.select("doc_id", every.alias("every")).select("doc_id", F.inline_outer("every"))
    return rows.filter(F.exists("line_words", lambda words: F.size(words) > 0))


def licences(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph, n_lines, family, probability, notice, overlap, confirmed) of the paragraphs of a known licence.

    ``overlap`` is the share of word triples of the family's best fitting ``notice`` that the paragraph holds.
    """
    model = LicenceModel(docs)
    triples = _triples(docs.sparkSession)
    predicted = model.predict(paragraph_words(docs)).withColumn("n_lines", F.size("line_words"))
    # Words are columns before grams are taken of them: inside a transform they would be worked out again per mention.
    familiar = F.transform("line_words", lambda words: _familiar(words, triples))
    predicted = _once(predicted, "line_words", familiar)
    single = F.transform("line_words", lambda words: _noticed(words, triples))
    predicted = _once(predicted, "single", F.when(F.col("n_lines") > 1, single))
    rest = F.filter("line_words", lambda words, i: ~_holds(F.get("single", i), triples))
    predicted = _once(predicted, "rest", F.when(F.col("n_lines") > 1, rest).otherwise(F.col("line_words")))
    predicted = _once(predicted, "words", F.flatten("rest"))
    predicted = _once(predicted, "grams", _noticed(F.col("words"), triples))
    by_family = [
        F.when(F.col("family") == family, F.array(*[_overlap(F.col("grams"), name, wanted) for name, wanted in texts]))
        for family, texts in triples.items()
    ]
    # Structs compare by their first field, so the largest is the best fitting notice.
    best = F.array_max(reduce(lambda a, b: F.coalesce(a, b), by_family))
    confirmed = F.col("best.overlap") >= CONFIRMED
    named = _once(predicted, "best", best).filter(confirmed | (F.size("rest") == F.col("n_lines")))
    return named.select(
        "doc_id", "paragraph", "n_lines", "family", "probability", F.col("best.notice").alias("notice"),
        F.col("best.overlap").alias("overlap"), confirmed.alias("confirmed"),
    )


def _wanted(triples: dict[str, list[tuple[str, list[str]]]]) -> list[str]:
    return sorted({gram for texts in triples.values() for _, wanted in texts for gram in wanted})


def _familiar(words: Column, triples: dict[str, list[tuple[str, list[str]]]]) -> Column:
    """``words`` with null for those that occur in no notice, so that no gram is made of them."""
    known = sorted({word for gram in _wanted(triples) for word in gram.split(" ")})
    return F.transform(words, lambda word: F.when(word.isin(known), word))


def _noticed(words: Column, triples: dict[str, list[tuple[str, list[str]]]]) -> Column:
    """The distinct word triples, and pairs if a notice has but two words, that occur in any notice."""
    every = _wanted(triples)
    sizes = sorted({gram.count(" ") + 1 for gram in every})
    return F.array_intersect(F.concat(*[grams(words, size) for size in sizes]), F.array(*map(F.lit, every)))


def _holds(found: Column, triples: dict[str, list[tuple[str, list[str]]]]) -> Column:
    """Whether ``found`` confirms a notice of any family."""
    every = F.array(*[F.array(*map(F.lit, wanted)) for texts in triples.values() for _, wanted in texts])
    return (F.size(found) > 0) & F.exists(
        every, lambda wanted: F.size(F.array_intersect(found, wanted)) >= F.size(wanted) * CONFIRMED
    )


def _overlap(found: Column, name: str, triples: list[str]) -> Column:
    wanted = F.array(*map(F.lit, triples))
    share = F.size(F.array_intersect(found, wanted)) / len(triples)
    return F.struct(share.alias("overlap"), F.lit(name).alias("notice"))


def _triples(spark) -> dict[str, list[tuple[str, list[str]]]]:
    """Family -> (notice, triples); as many rows as there are fixed notices."""
    result: dict[str, list] = {}
    for row in notices(spark).select("family", "notice", "triples").collect():
        result.setdefault(row["family"], []).append((row["notice"], row["triples"]))
    return result

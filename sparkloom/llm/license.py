"""Licence scan: a trained paragraph classifier, in DataFrame operations only.

Lines with a licence cue, alone and with the passage around them, are described
by hashed word uni- and bigrams; a multinomial logistic regression names the licence family,
``none``, or ``other``: a notice of a licence that is none of the families.  The
probability a family needs is calibrated on all lines with a cue that match
no template, so that at most ``false_rate`` of these are above it; what is not
above is ``unknown``, as is ``other``.  A prediction also has to be confirmed by
comparison with the family's templates: half of the words and pairs of one, and
half of those words of it that the fewest families use.  So the words that all
notices share confirm nothing.  Else it is ``unknown`` too.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import materialize
from sparkloom.llm.quality import let

#: Bounds of the fit: hashed features, expected rows of the corpus as examples of ``none``.
FEATURES = 1 << 11
SAMPLE_ROWS = 400
CUE = r"(?i)licen[sc]|copyright|copyleft|permission|warrant|redistribut|public domain|creative commons|rights reserved|spdx|unlicen|\b[al]?gpl|apache|mozilla|cc0|\bcc[ -]by|(?-i:\bGNU\b|\bBSD\b|\bMPL\b)"

#: Notices as licensors commonly write them, by family.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license.", "SPDX-License-Identifier: MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License", "Distributed under the terms of the Apache License 2.0", "Apache 2.0", "Apache-2.0"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License", "GPLv3", "under GPLv3", "GPLv3 only", "GPLv3 or later", "GPL-3.0", "GPL version 3", "GNU GPL v3"],
    "GPL-2.0": ["Licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only", "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation", "GPLv2", "under GPLv2", "GPLv2 only", "GPLv2 or later", "GPL-2.0", "GPL version 2", "GNU GPL v2"],
    "LGPL": ["Licensed under the GNU Lesser General Public License.", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL", "under the LGPL", "LGPLv2.1", "LGPLv3", "under LGPLv3", "GNU LGPL"],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License", "SPDX-License-Identifier: AGPL-3.0-only", "AGPLv3", "under AGPLv3", "AGPLv3 only", "AGPL-3.0", "GNU AGPL"],
    "BSD": ["Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "BSD licence", "3-clause BSD", "2-clause BSD", "BSD-3-Clause"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0", "MPL 2.0", "Mozilla Public License 2.0"],
    "CC-BY": ["Licensed under CC BY 4.0.", "CC BY 4.0", "CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "CC BY-SA 4.0", "CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "CC BY-NC 4.0", "CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0", "CC0", "CC0 1.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
    "proprietary": ["Copyright. All rights reserved.", "No part of this publication may be reproduced without the prior written permission of the publisher."],
}
#: Lines with a cue that grant nothing.
PLAIN = ["He renewed his driving licence last week.", "Permission to speak was granted by the chair.", "The warranty covers parts for two years.", "She holds a licence to sell fish at the market.", "They asked for permission before they left.", "The copyright office opens at nine.", "A search warrant was issued on Monday.", "Wealth was redistributed after the war.", "The pilot lost her license.", "He spoke of the public domain of ideas.", "The Apache helicopter landed at noon.", "A gnu is an antelope, not a GNU tool.", "The web server is Apache and it answers slowly."]

#: Notices of licences outside the families: phrases around made-up names, so that what they teach is the phrase.
PHRASES = ["Licensed under the {} license.", "Licensed under the {} License 2.0.", "Released under the {} License.", "Distributed under the {} Software License, Version 1.0.", "This program is made available under the terms of the {} Public License v 1.0", "SPDX-License-Identifier: {}-1.0", "This work is licensed under the {} License, version 1.2.", "You may use this file under the terms of the {} license", "Published under the {} licence.", "Licensed under the {}.", "Released under the terms of the {}.", "under {} terms", "{} License", "{} License", "{} License 2.0"]
NAMES = ["Acme", "Foobar", "Quux", "Norland", "Zed", "Open Widget", "Sample", "Vega", "Third Moon", "KLM"]


def grams(text: Column) -> Column:
    """Lower-case words and pairs of neighbours."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def of(w: Column) -> Column:
        pairs = F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.array_distinct(F.concat(w, F.array_compact(pairs)))

    return let(words, of)


def _rows(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    values = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(t).alias("paragraph")) for f, t in rows])
    return spark.range(1).select(F.explode(values).alias("r")).select("r.family", "r.paragraph")


def passages(docs: DataFrame, id_col: str, text_col: str, span: int) -> DataFrame:
    """(id, line, passage) for the lines that have a cue.

    The passage is the line with its neighbours, up to a line without letters
    or digits (blank, or comment marks only) and to ``span`` words or more on
    each side, so it holds a wrapped notice of that many words as a whole.
    """
    text = F.col(text_col).cast("string")
    words = lambda x: F.size(F.filter(F.split(x, r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    start = F.struct(F.lit(False).alias("done"), F.lit(0).alias("words"), F.array().cast("array<string>").alias("lines"))

    def step(acc: Column, x: Column) -> Column:
        done = acc["done"] | (acc["words"] >= span) | ~x.rlike(r"[\p{L}\p{N}]")
        return F.struct(done.alias("done"), (acc["words"] + F.when(done, 0).otherwise(words(x))).alias("words"), F.when(done, acc["lines"]).otherwise(F.concat(acc["lines"], F.array(x))).alias("lines"))

    side = lambda xs: F.aggregate(xs, start, step, lambda acc: acc["lines"])
    # A line has one word at least, so ``span`` lines on a side are enough.
    before = F.reverse(F.slice("lines", F.greatest(F.col("at") - span + 1, F.lit(1)), F.least(F.col("at"), F.lit(span))))
    after = F.slice("lines", F.col("at") + 2, span)
    lines = docs.where(text.rlike(CUE)).select(F.col(id_col).alias("id"), F.split(text, "\n").alias("lines"))
    cues = F.filter(F.transform("lines", lambda x, i: F.struct(i.alias("at"), x.alias("line"))), lambda x: x["line"].rlike(CUE))
    near = lines.select("id", "lines", F.explode(cues).alias("cue")).select("id", "lines", "cue.at", "cue.line")
    return near.select("id", "line", F.concat_ws("\n", F.reverse(side(before)), F.array("line"), side(after)).alias("passage"))


def rarest(known: list[tuple[str, str]]) -> list[list[str]]:
    """Of each template the words that the fewest families have in theirs."""
    words = [sorted(set(re.findall(r"[^\W_]+", t.lower()))) for _, t in known]
    users: dict[str, set[str]] = {}
    for (family, _), ws in zip(known, words, strict=True):
        for w in ws:
            users.setdefault(w, set()).add(family)
    return [[w for w in ws if len(users[w]) == min(len(users[x]) for x in ws)] for ws in words]


def _steps(score: str) -> Column:
    """A score in millionths, rounded up: few distinct values, whatever the input."""
    return F.ceil(F.col(score) * 1000000)


def calibrate(judged: DataFrame, false_rate: float) -> int:
    """The level, in millionths, that at most ``false_rate`` of the lines with a cue that match no template are above.

    Over all such lines of the input; 0 without any.
    """
    if false_rate >= 1:
        return 0
    of = lambda family, score: F.when(~F.col(family).isin("none", "other"), _steps(score)).otherwise(0)
    plain = judged.where(~F.col("matched")).select(F.greatest(of("family", "score"), of("w_family", "w_score")).alias("s"))
    level = plain.agg(F.expr(f"percentile_disc({1.0 - false_rate!r}D) WITHIN GROUP (ORDER BY s)").alias("level")).first()["level"]
    return int(level or 0)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", false_rate: float = 0.01, overlap: float = 0.5, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per input row: id, license, families, score, n_paragraphs, n_confirmed.

    ``license`` is the confirmed family of highest probability (by name where
    equal), ``unknown`` where only unconfirmed lines look like a licence, else
    null.  ``families`` lists the confirmed families; ``score`` is the highest
    probability of a confirmed or unknown line, 0 without any.  The counts are
    of lines with a cue, a wrapped notice counts each of its own.

    A line is judged by itself and with the passage around it.  A confirmed
    passage decides, unless the line has more of a template of its own family
    than of the passage's (one-line notices that follow each other).

    ``sample_rows`` bounds the documents that show the fit plain lines; the level
    is taken from the lines with a cue of all documents.

    Null and empty texts have no paragraphs.  Rows that share an id, null
    included, are judged together and each get the result.  Whole texts are
    read; other columns are ignored.
    """
    spark = docs.sparkSession
    n = docs.count()
    share = int(min(1.0, sample_rows / max(1, n)) * (1 << 20))
    lines = docs.where(F.pmod(F.xxhash64(id_col, F.lit("plain")), F.lit(1 << 20)) < share).select(F.explode(F.filter(F.split(F.col(text_col).cast("string"), "\n"), lambda x: (x != "") & ~x.rlike(CUE))).alias("paragraph"))
    known = [(f, t) for f, ts in TEMPLATES.items() for t in ts]
    noisy = F.explode(F.array(F.lit(""), F.lit("the of and "), F.lit("in on ")))
    names_only = [(f, t) for f, t in known if len(re.findall(r"\w+", t)) <= 3] * 6  # few words must do
    others = [("other", p.format(x)) for p in PHRASES for x in NAMES]
    labelled = _rows(spark, known + names_only + others + [("none", t) for t in PLAIN]).select("family", "paragraph", noisy.alias("noise")).select("family", F.concat("noise", "paragraph").alias("paragraph"))
    examples = materialize(labelled.unionByName(lines.select(F.lit("none").alias("family"), "paragraph")), "examples")
    names = sorted([*TEMPLATES, "none", "other"])
    index = F.array_position(F.array(*[F.lit(x) for x in names]), F.col("family")) - 1
    hashed = HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True)
    prepared = hashed.transform(examples.withColumns({"grams": grams(F.col("paragraph")), "label": index.cast("double")}))
    model = LogisticRegression(regParam=0.003, maxIter=30, family="multinomial").fit(prepared.coalesce(1))
    reach = F.array_max(F.slice(vector_to_array("probability"), 1, len(names)))
    picked = lambda df: df.withColumn("p", vector_to_array("probability")).withColumn("family", F.element_at(F.array(*[F.lit(x) for x in names]), F.col("prediction").cast("int") + 1)).withColumn("score", reach)
    telling = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(t).alias("paragraph"), F.array(*[F.lit(w) for w in ws]).alias("telling")) for (f, t), ws in zip(known, rarest(known), strict=True)])
    templates = spark.range(1).select(F.explode(telling).alias("t")).select("t.*").withColumn("grams", grams(F.col("paragraph"))).agg(F.collect_list(F.struct("family", "grams", "telling")).alias("templates"), F.array_distinct(F.flatten(F.collect_list("grams"))).alias("vocabulary"))
    span = max(len(re.findall(r"\w+", t)) for _, t in known)
    found = passages(docs, id_col, text_col, span).crossJoin(F.broadcast(templates)).withColumn("line_grams", grams(F.col("line")))
    hits = F.transform("templates", lambda t: F.struct(t["family"].alias("family"), F.size(F.array_intersect("grams", t["grams"])).alias("n"), ((F.size(F.array_intersect("grams", t["grams"])) >= overlap * F.size(t["grams"])) & (2 * F.size(F.array_intersect("grams", t["telling"])) >= F.size(t["telling"]))).alias("near")))
    near = F.exists("hits", lambda h: h["near"] & (h["family"] == F.col("family")))
    most = lambda family: F.coalesce(F.array_max(F.transform(F.filter("hits", lambda h: h["family"] == F.col(family)), lambda h: h["n"])), F.lit(0))
    judge = lambda df: picked(model.transform(hashed.transform(df))).withColumn("hits", hits).withColumn("near", near & (F.col("family") != "none"))
    # Words of no template around a notice say nothing about it.
    whole = judge(found.withColumn("grams", F.array_intersect(grams(F.col("passage")), "vocabulary")))
    whole = whole.select("id", "line_grams", "templates", F.col("family").alias("w_family"), F.col("score").alias("w_score"), F.col("near").alias("w_near"), F.exists("hits", lambda h: h["near"]).alias("w_any"))
    each = judge(whole.withColumnRenamed("line_grams", "grams")).withColumn("part", most("w_family") >= most("family"))
    matched = F.col("w_any") | F.exists("hits", lambda h: h["near"])
    each = materialize(each.select("id", "family", "score", "near", "w_family", "w_score", "w_near", "part", matched.alias("matched")), "judged")

    level = calibrate(each, false_rate)
    above = _steps("w_score") > level
    by_whole = F.col("w_near") & F.col("part") & (above | (F.col("family") == "none"))
    by_line = F.col("near") & (_steps("score") > level)
    pick = lambda c: F.when(by_whole, F.col(f"w_{c}")).otherwise(F.col(c)).alias(c)
    judged = each.select("id", pick("family"), pick("score"), F.when(by_whole, above).otherwise(by_line).alias("confirmed")).where("family <> 'none'")
    per = judged.groupBy("id").agg(
        F.max(F.when(F.col("confirmed"), F.struct("score", "family"))).alias("best"),
        F.max("score").alias("score"),
        F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))).alias("families"),
        F.count("*").alias("n_paragraphs"),
        F.sum(F.col("confirmed").cast("bigint")).alias("n_confirmed"),
    )
    rows = docs.select(F.col(id_col).alias("row"))
    out = rows.join(per, rows.row.eqNullSafe(per.id), "left")
    named = F.when(F.col("n_confirmed") > 0, F.col("best.family")).when(F.col("n_paragraphs") > 0, F.lit("unknown"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return out.select(F.col("row").alias(id_col), named.alias("license"), F.coalesce("families", F.array().cast("array<string>")).alias("families"), F.coalesce("score", F.lit(0.0)).alias("score"), zero("n_paragraphs"), zero("n_confirmed"))

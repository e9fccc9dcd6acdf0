"""Licence scan of documents: a trained paragraph classifier, confirmed by templates, in DataFrame functions only.

A paragraph is a line of text, and beside it the lines it is wrapped with: up
to one before and two after it, as far as no blank line lies between, without
comment marks. Its features are the words and word pairs that occur in the
notices below, hashed into a sparse vector that keeps only the columns these
fall into. A multinomial logistic regression learns the families from the
notices, each alone and beside the features of other text, against all lines of
all documents that hold no telling word pair of a notice. Lines with the same
features count as one training row with their number, so the fit reads every
line and yet works on one row per set of features.
The weights of the classes are fixed shares and do not depend on the size of the
table. One in `CALIBRATION` lines only calibrates, and of these the ones that hold
a telling word, as the scored ones do: both the probability that a line is a
licence at all and that of its family must exceed what all but one in `FALSE` of
them reach, and lie within fixed bounds. A prediction is confirmed if the line,
or else the lines around it, hold at least `LIKE` of the word pairs of one notice
of that family; a licence that no notice confirms is `unknown`.

A line without any of the telling words of the notices has no features that
speak for a licence and is not scored; one without any word pair of the notices
either has no features at all and is only counted. Those shortcuts drop nothing.
Probability and similarity follow from the features alone, so they are worked
out once per set of features.

Cases: null and empty texts have no paragraphs and get empty lists. Every row
gives one row, repeated rows and null ids included. Texts are read whole. Other
columns are not looked at. An empty table gives no rows; the models then rest
on the notices and `PLAIN` alone.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.session import cut_lineage, new_dir
from strataloom.sources.sinks import full_refresh

CALIBRATION, FALSE, LIKE = 4, 1000, 0.8
FEATURES = 1 << 14
GATE, SURE = (0.2, 0.9), (0.3, 0.95)  # bounds of the calibrated limits: a licence at all, and of one family
ALONE, BESIDE, PLAIN_WEIGHT = 20.0, 100.0, 500.0  # weights in the fit: of a notice alone, of a notice beside all other text, of all text without licence
NONE, UNKNOWN = "none", "unknown"
SEPARATOR, SEPARATOR_PATTERN = "|", r"\|"  # between features; no word holds it

#: Customary short notices of each family, as their licences or users word them.
NOTICES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0", "you may not use this file except in compliance with the Apache License", "SPDX-License-Identifier: Apache-2.0", "released under the Apache 2.0 license"],
    "MIT": ["Released under the MIT License", "Licensed under the MIT license", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "SPDX-License-Identifier: MIT"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3", "either version 3 of the GNU General Public License, or any later version", "SPDX-License-Identifier: GPL-3.0-or-later", "licensed under the GPL v3", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2", "under the terms of the GNU General Public License version 2 as published by the Free Software Foundation", "SPDX-License-Identifier: GPL-2.0-only", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or any later version"],
    "LGPL": ["licensed under the GNU Lesser General Public License", "SPDX-License-Identifier: LGPL-2.1-or-later"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted", "Released under the BSD 3-Clause License", "Licensed under the BSD license", "SPDX-License-Identifier: BSD-3-Clause"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY": ["Licensed under CC BY 4.0", "licensed under a Creative Commons Attribution 4.0 International License"],
    "CC0": ["Dedicated to the public domain under CC0 1.0", "To the extent possible under law, the author has waived all copyright"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "Released under the ISC License"],
    UNKNOWN: ["Licensed under the terms of a proprietary license agreement", "See the license file for details", "This software may not be copied or distributed without written permission", "released under its own license", "Licensed under the Example License", "This work is licensed under a custom license", "Released under the Sample Public License, edition two", "distributed under the terms of another license", "SPDX-License-Identifier: Other-1.2", "Licensed under the Sample License, edition two"],
}
#: Ordinary sentences, so that a table without rows still trains; a mere reservation of rights is no licence either.
PLAIN = ["The water is cold today and the road is long", "This is a version of the story by the author", "She was under the tree with a copy of the file", "Use the form below or see the next page", "All rights reserved"]
COMMENT = r"^[ \t]*(?:#+|//+|/?\*+/?|;+|--+|%+)"  # marks at the beginning of a line
#: Words of the notices that occur in any text and tell nothing alone.
COMMON = "the of a to and in or is are be by for on with without under this that may not you any as its it see use all free next terms work file version person form forms own time details source published possible law author later either purpose any example custom sample another edition two".split()


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9]+(?:\.[0-9]+)*"), F.lit(0))


def grams(tokens: Column) -> Column:
    """Words and word pairs."""
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(tokens) - 1)), lambda i: F.concat_ws(" ", F.try_element_at(tokens, i), F.try_element_at(tokens, i + 1)))
    return F.array_distinct(F.when(F.size(tokens) < 2, tokens).otherwise(F.concat(tokens, pairs)))


def notices(spark: SparkSession) -> DataFrame:
    """family, notice, tokens of every notice."""
    rows = [F.struct(F.lit(f).alias("family"), F.lit(n).alias("notice")) for f, texts in NOTICES.items() for n in texts]
    return spark.range(1).select(F.inline(F.array(*rows))).withColumn("tokens", words(F.col("notice")))


def _vocabulary(known: DataFrame) -> tuple[list[str], list[str]]:
    """All words and pairs of the notices, and the words that tell."""
    every = sorted(r[0] for r in known.select(F.explode(grams(F.col("tokens")))).distinct().collect())
    telling = sorted(w for w in every if " " not in w and w not in COMMON and not w.replace(".", "").isdigit())
    return [g for g in every if " " in g or g in set(telling)], telling


class Scanner:
    """The marked lines of some documents and a classifier fitted on all of them."""

    def __init__(self, docs: DataFrame, keep_lines: bool = False):
        spark = docs.sparkSession
        self.known = notices(spark)
        self.vocabulary, self.telling = _vocabulary(self.known)
        self.families = [*NOTICES, NONE]
        self.hashing = HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="hashed")
        self.columns = sorted({self.hashing.indexOf(g) for g in self.vocabulary})
        self.marks = full_refresh(self._marked(docs, keep_lines), new_dir(spark, "licences"))
        rows = self._training()
        self.model: LogisticRegressionModel = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", regParam=0.0005, maxIter=60, family="multinomial").fit(rows.where("weight > 0").select("features", "label", "weight"))
        p = vector_to_array("probability")
        top = F.array_max(F.slice(p, 1, len(self.families) - 2))
        held = self.model.transform(rows.where("n_held > 0 AND tells").select("features", "n_held"))
        reached = held.agg(F.percentile(1 - F.element_at(p, -1), 1 - 1 / FALSE, F.col("n_held")).alias("gate"), F.percentile(top, 1 - 1 / FALSE, F.col("n_held")).alias("sure")).first()
        self.gate = min(GATE[1], max(GATE[0], reached["gate"] or 0.0))
        self.limit = min(SURE[1], max(SURE[0], reached["sure"] or 0.0))

    def pattern(self) -> str:
        """Matches a paragraph with a telling word."""
        ends = {a: "|".join(sorted((w[1:] for w in self.telling if w[0] == a), key=len, reverse=True)) for a in sorted({w[0] for w in self.telling})}
        return r"(?i)(?<![a-z0-9])(?:" + "|".join(f"{a}(?:{rest})" for a, rest in ends.items()) + r")(?![a-z0-9])"

    def pair_pattern(self) -> str:
        """Matches, in lower case, at least every paragraph with a pair of common words; a word may follow the digits of another at once."""
        ends: dict[str, list[str]] = {}
        for first, second in (g.split() for g in self.vocabulary if " " in g and not set(g.split()) & set(self.telling)):
            ends.setdefault(first, []).append(second)
        return r"(?<![a-z])(?:" + "|".join(re.escape(w) + ("[^a-z0-9]*" if w[-1].isdigit() else "[^a-z0-9]+") + f"(?:{'|'.join(map(re.escape, e))})" for w, e in sorted(ends.items())) + ")"

    def _features(self, tokens: str) -> Column:
        """The words and pairs of the notices among the tokens, in one string that is the same for equal sets."""
        return F.array_join(F.array_sort(F.array_intersect(grams(F.col(tokens)), F.array(*map(F.lit, self.vocabulary)))), SEPARATOR)

    def _marked(self, docs: DataFrame, keep_lines: bool) -> DataFrame:
        """One row per document (paragraph null) with its number of paragraphs and of those without features, and one per paragraph that may have features.

        doc_id, row, paragraph, n_paragraphs, n_bare, tells, held, features, around (features of the lines it is wrapped with) and, if kept, line.
        """
        lines = F.split(F.coalesce("text", F.lit("")), "\n")

        def near(i: Column, step: int) -> Column:
            return F.trim(F.regexp_replace(F.coalesce(F.get("lines", i + step), F.lit("")), COMMENT, ""))

        def around(i: Column) -> Column:
            after = F.when(near(i, 1) != "", F.concat_ws(" ", near(i, 1), near(i, 2))).otherwise("")
            return F.concat_ws(" ", near(i, -1), near(i, 0), after)

        def looked_at(i: Column) -> Column:
            line = F.get("lines", i)
            return F.struct(i.alias("paragraph"), line.rlike(self.pattern()).alias("tells"), F.lower(line).rlike(self.pair_pattern()).alias("pairs"), (F.length(F.trim(line)) > 0).alias("filled"), (F.pmod(F.xxhash64(line), F.lit(CALIBRATION)) == 0).alias("held"))

        looks = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), lines.alias("lines"))
        # generators, as Spark would work out their columns anew for every use of a plain one
        looks = looks.select("*", F.inline(F.array(F.struct(F.transform(F.sequence(F.lit(0), F.size("lines") - 1), looked_at).alias("looks")))))
        bare = F.filter("looks", lambda x: x["filled"] & ~x["tells"] & ~x["pairs"])
        counts = [F.size(F.filter(bare, lambda x: ~x["held"])), F.size(F.filter(bare, lambda x: x["held"]))]
        none = {"paragraph": "int", "tells": "boolean", "held": "boolean", "line": "string", "around": "string"}
        head = F.array(F.struct(*[F.lit(None).cast(t).alias(c) for c, t in none.items()], F.size(F.filter("looks", lambda x: x["filled"])).alias("n_paragraphs"), *[n.alias(c) for n, c in zip(counts, ("n_bare", "n_bare_held"))]))
        found = F.transform(
            F.filter("looks", lambda x: x["tells"] | x["pairs"]),
            lambda x: F.struct(x["paragraph"].alias("paragraph"), x["tells"].alias("tells"), x["held"].alias("held"), F.get("lines", x["paragraph"]).alias("line"), F.when(x["tells"], around(x["paragraph"])).alias("around"), *[F.lit(None).cast("int").alias(c) for c in ("n_paragraphs", "n_bare", "n_bare_held")]),
        )
        rows = looks.select("doc_id", "row", F.inline(F.concat(head, found)))
        tokens = F.struct(words(F.col("line")).alias("own_tokens"), words(F.col("around")).alias("around_tokens"))
        rows = rows.select("*", F.inline(F.array(tokens)))
        kept = ["line"] if keep_lines else []
        own = F.when(F.col("paragraph").isNotNull(), self._features("own_tokens")).alias("features")
        return rows.select("doc_id", "row", "paragraph", "tells", "held", *kept, "n_paragraphs", "n_bare", "n_bare_held", own, F.when(F.col("tells"), self._features("around_tokens")).alias("around"))

    def _training(self) -> DataFrame:
        """One row per family and set of features: features, label, weight, n_held, tells; of text without licence all lines count."""
        spark = self.known.sparkSession
        found = self.marks.where("paragraph IS NOT NULL").groupBy("features", "tells").agg(F.count_if(~F.col("held")).alias("n"), F.count_if("held").alias("n_held"))
        bare = self.marks.where("paragraph IS NULL").agg(F.coalesce(F.sum("n_bare"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_bare_held"), F.lit(0)).alias("n_held"))
        always = spark.range(1).select(F.explode(F.array(*map(F.lit, PLAIN))).alias("line")).select(F.inline(F.array(F.struct(words(F.col("line")).alias("tokens")))))
        always = always.select(self._features("tokens").alias("features"), F.lit(False).alias("tells"), F.lit(1).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("n_held"))
        every = found.unionByName(bare.select(F.lit("").alias("features"), F.lit(False).alias("tells"), "n", "n_held")).unionByName(always)
        pairs = [g for g in self.vocabulary if " " in g and set(g.split()) & set(self.telling)]
        every = every.where(~F.arrays_overlap(F.split("features", SEPARATOR_PATTERN), F.array(*map(F.lit, pairs))))
        plain = cut_lineage(every.groupBy("features", "tells").agg(F.sum("n").alias("n"), F.sum("n_held").alias("n_held")))
        share = F.col("n") / F.lit(plain.agg(F.sum("n")).first()[0])
        alone = self.known.select("family", self._features("tokens").alias("features"))
        either = F.array_join(F.array_sort(F.array_union(F.split("features", SEPARATOR_PATTERN), F.split("beside", SEPARATOR_PATTERN))), SEPARATOR)
        beside = plain.select(F.col("features").alias("beside"), (share * BESIDE).alias("weight")).crossJoin(F.broadcast(alone))  # the notices are a fixed list
        extra = [F.lit(0).cast("bigint").alias("n_held"), F.lit(False).alias("tells")]
        rows = plain.select(F.lit(NONE).alias("family"), "features", (share * PLAIN_WEIGHT).alias("weight"), "n_held", "tells")
        rows = rows.unionByName(beside.select("family", either.alias("features"), "weight", *extra)).unionByName(alone.select("family", "features", F.lit(ALONE).alias("weight"), *extra))
        label = F.create_map(*[x for i, f in enumerate(self.families) for x in (F.lit(f), F.lit(float(i)))])[F.col("family")]
        return cut_lineage(self._featured(rows).withColumn("label", label).select("features", "label", "weight", "n_held", "tells"))

    def _featured(self, rows: DataFrame) -> DataFrame:
        """Column `features` as a vector of the columns that the vocabulary is hashed to; no set has others, and the fit holds arrays of that width in the driver."""
        sets = rows.withColumn("grams", F.array_remove(F.split("features", SEPARATOR_PATTERN), "")).drop("features")
        return VectorSlicer(inputCol="hashed", outputCol="features", indices=self.columns).transform(self.hashing.transform(sets)).drop("hashed")

    def _judged(self) -> DataFrame:
        """Every set of features that a line to be scored or the lines around it have: of, licence (whether it is one), probability and similarity of the likeliest family (guess), confirmed."""
        scored = self.marks.where("tells")
        sets = cut_lineage(scored.select("features").union(scored.select("around")).distinct())
        rows = self.model.transform(self._featured(sets.withColumn("of", F.col("features")))).withColumn("p", vector_to_array("probability"))
        known = F.slice("p", 1, len(self.families) - 2)  # without unknown and none
        best = F.array_position(known, F.array_max(known)).cast("int")
        guess = F.element_at(F.array(*map(F.lit, self.families)), best)
        rows = cut_lineage(rows.select("of", "grams", guess.alias("guess"), F.array_max(known).alias("probability"), ((1 - F.element_at("p", -1)) > self.gate).alias("licence")))
        texts = self.known.where(F.col("family") != UNKNOWN).groupBy("family").agg(F.collect_list(F.filter(grams(F.col("tokens")), lambda g: g.contains(" "))).alias("texts"))
        rows = rows.join(F.broadcast(texts), rows["guess"] == texts["family"], "left").drop("family")  # one row per family
        similar = F.array_max(F.transform("texts", lambda t: F.size(F.array_intersect(t, F.col("grams"))) / F.size(t)))
        rows = rows.withColumn("similarity", F.coalesce(similar, F.lit(0.0))).drop("texts", "grams")
        return cut_lineage(rows.withColumn("confirmed", F.col("licence") & (F.col("probability") >= self.limit) & (F.col("similarity") >= LIKE)))

    def scored(self) -> DataFrame:
        """The marks, with family, probability, similarity and confirmed where a line is a licence; family is null elsewhere."""
        judged = self._judged()
        wrapped = judged.where("confirmed").select(F.col("of").alias("around"), F.struct("guess", "probability", "similarity").alias("_wrapped"))
        scored = F.col("tells") & (F.col("features") == F.col("of"))
        both = self.marks.join(judged, scored, "left").join(wrapped, "around", "left")
        own = F.coalesce("confirmed", F.lit(False))
        both = both.withColumn("_wrapped", F.when(~own, F.col("_wrapped"))).withColumn("confirmed", own | F.col("_wrapped").isNotNull())
        both = both.withColumns({c: F.coalesce(F.col("_wrapped")[c], F.col(c)) for c in ("guess", "probability", "similarity")})
        licence = F.coalesce("licence", F.lit(False)) | F.col("confirmed")
        return both.withColumn("family", F.when(F.col("confirmed"), F.col("guess")).when(licence, UNKNOWN)).drop("_wrapped", "guess", "licence", "of")


def licence_paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, row, paragraph, line, family, probability, similarity, confirmed of every licence paragraph."""
    found = Scanner(docs.select("doc_id", "text"), keep_lines=True).scored().where("family IS NOT NULL")
    return found.select("doc_id", "row", "paragraph", "line", "family", "probability", "similarity", "confirmed")


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, n_paragraphs, families (confirmed ones, sorted), n_unknown, top_probability."""
    found = Scanner(docs.select("doc_id", "text")).scored()
    each = found.groupBy("row", "doc_id").agg(
        F.max("n_paragraphs").alias("n_paragraphs"),
        F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))).alias("families"),
        F.count_if((F.col("family") == UNKNOWN) & ~F.col("confirmed")).alias("n_unknown"),
        F.round(F.max(F.when(F.col("family").isNotNull(), F.col("probability"))), 6).alias("top_probability"),
    )
    return each.drop("row")

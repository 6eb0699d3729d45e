"""License scan: a trained classifier of paragraphs, confirmed by comparison with templates.

A paragraph is a line of a text, or neighbouring lines over which a notice is wrapped. Lines come to the classifier if they hold
a word by which licenses are spoken of, or a word triple of a template; most of them are no notice. The words and word pairs
of templates, of license names and of the phrases they stand in are the features of a multinomial logistic regression with
an elastic net, so most weights are zero. It is trained on the templates with words left out, on the names in some phrases,
on scraps of both, and on a bounded sample of the corpus; the last two are the class ``unknown``. A temperature fitted on
phrases and variants that were held out makes the scores probabilities, and what is more likely ``unknown`` is rejected. A prediction
counts if the paragraph is similar to a template or name of the predicted family: by the weight of their common words and pairs, in
which those of few families weigh most.

Only DataFrame functions and Spark's own estimators.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UNKNOWN = "unknown"
#: Notices by which texts name their license (fixed values); digits are compared as 0.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0",
    ),
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-nd": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "cc0": (
        "Dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "SPDX-License-Identifier: ISC",
    ),
    "epl": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "all-rights-reserved": ("All rights reserved.",),
}
#: Names by which sentences speak of a license (fixed values).
NAMES: dict[str, tuple[str, ...]] = {
    "apache-2.0": ("Apache License", "Apache 2.0", "Apache License, Version 2.0", "Apache 2.0 license"),
    "mit": ("MIT License", "MIT licence"),
    "gpl": ("GNU General Public License", "GPL v3", "GPLv3", "GNU GPL"),
    "lgpl": ("GNU Lesser General Public License", "LGPL v3", "LGPLv3", "GNU LGPL"),
    "agpl": ("GNU Affero General Public License", "AGPL v3", "AGPLv3", "GNU AGPL"),
    "bsd": ("BSD License", "BSD 3-Clause License", "3-Clause BSD license", "BSD licence"),
    "mpl": ("Mozilla Public License", "MPL 2.0", "Mozilla Public License 2.0"),
    "cc-by": ("CC BY 4.0", "Creative Commons Attribution 4.0"),
    "cc-by-sa": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0"),
    "cc-by-nc": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0"),
    "cc-by-nd": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0"),
    "cc0": ("CC0 1.0", "CC0 1.0 Universal"),
    "isc": ("ISC License", "ISC licence"),
    "epl": ("Eclipse Public License", "EPL 2.0"),
}
#: Phrases that name a license, for training, and others that are held out for the temperature (fixed values).
PHRASES = ("{}", "Distributed under the {}.", "Licensed under {}", "Released under the terms of the {}", "available under the {} license",
           "This software is under {}", "See the {} for details", "license: {}", "published under {} terms", "code is {} licensed")
HELD_PHRASES = ("This project is available under the {}", "Code released under {}.", "You may use it under the {}")
#: Phrases with license words that name none (fixed values).
NO_NOTICE = (
    "driver's license", "the license plate of the car", "a licence to teach", "licensed taxi", "the licence fee", "license", "licensed",
    "he studied at MIT", "the MIT campus", "the MIT", "an MIT professor", "apache helicopter", "the Apache people", "gnu and zebra", "copyright",
    "copyright law", "rights of the public", "all rights", "human rights reserved for citizens", "public domain name", "the public library",
    "general public", "free software for the public", "creative commons room", "creative people", "version 2.0", "attribution of the quote", "under the terms of the contract",
    "the terms of the lease", "released under water", "available under the table", "source and binary", "permission to enter", "mozilla and opera",
    "an eclipse of the sun", "the public eclipse party", "use of this file", "see the notes for details", "software license agreement required",
    "public license office", "license office", "a list of licenses", "the bsd port", "cc by mail", "cc me on the mail", "isc meeting")
#: Words by which licenses are spoken of (fixed values); a line without them, and without a template's triple, is not looked at.
#: Alternatives share their beginnings: each of them is tried at every character of the corpus.
GATE = (r"licen[cs]|spdx|c(?:opyright|reative commons)|r(?:ights reserved|edistribut)|public domain|hereby granted"
        r"|\b(?:cc(?:0|[ -]by\b)|[al]?gpl|(?:gnu|m(?:it|ozilla|pl)|apache|bsd|isc|e(?:clipse public|pl))\b)")
SAMPLE = 4000
#: Words on either side of a line's end that a notice across it can hold; more than any template has.
REACH = 40
VARIANTS = 24


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once for the row, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits; every digit is a 0."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9]", "0"), "[^a-z0]+", " ")
    return F.filter(F.split(plain, " "), lambda w: w != "")


def _runs(own: Column, n: int) -> Column:
    """Different runs of ``n`` words; a shorter text is one run."""

    def runs(own: Column) -> Column:
        last = F.greatest(F.size(own) - n + 1, F.lit(1))
        cut = F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(own, i, n), " "))
        return F.array_distinct(F.when(F.size(own) > 0, cut).otherwise(F.array().cast("array<string>")))

    return _bound(own, runs)


def _terms(own: Column) -> Column:
    return _bound(own, lambda own: F.array_union(own, _runs(own, 2)))


def _values(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """Rows (family, own words) of fixed texts."""
    listed = ", ".join("('{}', '{}')".format(family, text.replace("'", "\\'")) for family, text in rows)
    return spark.sql(f"SELECT * FROM VALUES {listed} AS t(family, text)").select("family", words(F.col("text")).alias("own"))


def _phrased(phrases: tuple[str, ...]) -> list[tuple[str, str]]:
    return [(family, phrase.format(name)) for family, names in NAMES.items() for name in names for phrase in phrases]


class Model:
    def __init__(self, vocabulary: list[str], families: list[str], regression: LogisticRegressionModel, heat: float):
        self.vocabulary, self.families = vocabulary, families
        self.regression, self.heat = regression, heat

    def predict(self, paragraphs: DataFrame) -> DataFrame:
        """Adds family and probability to rows with ``own`` words."""
        counter = CountVectorizerModel.from_vocabulary(self.vocabulary, inputCol="_terms", outputCol="_vector").setBinary(True)
        scored = self.regression.transform(counter.transform(paragraphs.withColumn("_terms", _terms(F.col("own")))))
        heated = _bound(vector_to_array("_raw"), lambda raw: _bound(
            F.array_max(raw), lambda top: F.transform(raw, lambda x: F.exp((x - top) / self.heat))))
        best = _bound(heated, lambda heated: F.struct(
            F.element_at(F.array(*map(F.lit, self.families)), F.array_position(heated, F.array_max(heated)).cast("int")).alias("family"),
            (F.array_max(heated) / F.aggregate(heated, F.lit(0.0), lambda a, x: a + x)).alias("probability")))
        return scored.select(*paragraphs.columns, best.alias("_best")).select(*paragraphs.columns, "_best.family", "_best.probability")


def _pattern(similar: float) -> str:
    """A regular expression, for lower-case text, that every text holds which a template can confirm.

    Of n triples such a text lacks (1 - similar) n at most, so it holds one of any larger set of them: the longest. What is
    between words, a line's end or a comment mark, does not matter.
    """
    branches: dict[str, set[str]] = {}
    for text in (t for texts in TEMPLATES.values() for t in texts):
        runs = sorted(_triple_list(text), key=lambda x: (-len(x), x))
        for run in runs[:min(len(runs), int((1 - similar) * len(runs) + 1e-9) + 1)]:
            branches.setdefault(run[0], set()).add("[^a-z0-9]+".join(run.split(" ")).replace("0-9", "#").replace("0", "[0-9]").replace("#", "0-9")[1:])
    joined = "|".join(f"{'[0-9]' if k == '0' else k}(?:{'|'.join(sorted(v, reverse=True))})" for k, v in sorted(branches.items()))
    return rf"(?<![a-z0-9])(?:{joined})(?![a-z0-9])"


def _lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows (doc_id, row, line, paragraph, following): each line with those after it that a notice could go on in.

    These are cut where they hold ``REACH`` words, and at a line without words. ``row`` tells rows of one doc_id apart.
    """
    step = lambda held, n: F.when(held["open"] & (n > 0) & (held["n"] < REACH), F.struct(
        (held["n"] + n).alias("n"), (held["k"] + 1).alias("k"), F.lit(True).alias("open"))).otherwise(
        F.struct(held["n"].alias("n"), held["k"].alias("k"), F.lit(False).alias("open")))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("k"), F.lit(True).alias("open"))
    split = docs.select(F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.split(F.col(text), "\n").alias("_lines"))
    sized = split.withColumn("_sizes", F.transform("_lines", lambda x: F.size(words(x))))
    cut = _bound(F.struct("_lines", "_sizes"), lambda own: F.transform(own["_lines"], lambda x, i: F.struct(
        x.alias("paragraph"), F.slice(own["_lines"], i + 2, F.aggregate(
            F.slice(own["_sizes"], i + 2, REACH), start, step, lambda held: held["k"])).alias("following"))))
    return sized.select("doc_id", "row", F.posexplode(cut).alias("line", "_at")).select("doc_id", "row", "line", "_at.paragraph", "_at.following")


def _gate(text: Column) -> Column:
    return F.lower(text).rlike(f"{GATE}|{_pattern(0.8)}")


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Model:
    """Trains on the templates and names, and on lines of about ``sample`` documents, chosen by a hash of the text.

    Of these documents' different lines the 1,000 with the smallest hashes that pass the gate and 200 others
    are taken, so copies weigh once and the same rows give the same model, in whatever order tasks end.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(text).alias("text")).filter("text is not null")
    total = texts.count()
    mark = F.pmod(F.xxhash64(F.lit("sample"), "text"), F.lit(1 << 32))
    chosen = texts.filter(mark < int((1 << 32) * min(1.0, sample / total))) if total else texts
    lines = chosen.select(F.explode(F.split("text", "\n")).alias("line")).distinct().select(
        words(F.col("line")).alias("own"), _gate(F.col("line")).alias("gated"), F.xxhash64(F.lit("line"), "line").alias("mark"), "line")
    lines = lines.filter("size(own) > 0")
    drawn = lines.filter("gated").orderBy("mark", "line").limit(1000).unionByName(
        lines.filter("not gated").orderBy("mark", "line").limit(200)).select("own")
    templates = _values(spark, [(f, t) for f, texts in TEMPLATES.items() for t in texts])
    phrased = _values(spark, _phrased(PHRASES))
    held = _values(spark, _phrased(HELD_PHRASES))
    blank = _values(spark, [(UNKNOWN, t) for t in NO_NOTICE])
    terms = templates.unionByName(phrased).unionByName(blank).select(F.explode(_terms(F.col("own"))).alias("term")).distinct().collect()
    vocabulary = sorted(r["term"] for r in terms)
    # Variants of the templates: two in three whole, the others with about every sixth word left out by a hash.
    copies = templates.select("family", "own", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("copy"))
    thinned = F.filter("own", lambda w, i: (F.col("copy") % 3 != 1) | (F.pmod(F.xxhash64(w, i, "copy"), F.lit(6)) != 0))
    known = copies.select("family", thinned.alias("own"), "copy")
    # Scraps: a quarter of the words, or one word, say nothing.
    scrap = F.filter("own", lambda w, i: F.when(F.col("copy") % 2 == 0, F.pmod(F.xxhash64(w, i, "copy"), F.lit(4)) == 0).otherwise(
        i == F.pmod(F.col("copy"), F.size("own"))))
    scraps = copies.filter("size(own) > 3").select(F.lit(UNKNOWN).alias("family"), scrap.alias("own"), "copy")
    # Notices of the corpus itself are not negatives: a line that a template or name covers is left out.
    other = drawn.filter(_similarity(F.col("own")) < 0.5).select(F.lit(UNKNOWN).alias("family"), "own")
    turn = F.pmod(F.xxhash64("own"), F.lit(6)).cast("int").alias("copy")
    # Each name's phrases and each phrase without a notice several times: they are few beside the templates' variants.
    times = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("time")
    rows = known.unionByName(scraps).unionByName(other.select("family", "own", turn))
    rows = rows.unionByName(phrased.select("family", "own", F.lit(0).alias("copy"), times).drop("time"))
    rows = rows.unionByName(blank.select("family", "own", F.lit(0).alias("copy"), times).drop("time"))
    rows = rows.unionByName(held.select("family", "own", F.lit(5).alias("copy")))
    families = [UNKNOWN, *TEMPLATES]
    number = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    rows = rows.select(number.cast("double").alias("label"), _terms(F.col("own")).alias("_terms"), "copy")
    counter = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="_terms", outputCol="_vector").setBinary(True)
    # One partition in a fixed order: sums of floating-point numbers do not depend on how tasks end.
    rows = counter.transform(rows).repartition(1).sortWithinPartitions("label", "copy", F.hash("_terms")).cache()
    try:
        learner = LogisticRegression(
            featuresCol="_vector", labelCol="label", rawPredictionCol="_raw", probabilityCol="_probability",
            predictionCol="_prediction", family="multinomial", regParam=0.001, elasticNetParam=0.5, maxIter=40, standardization=False)
        regression = learner.fit(rows.filter("copy % 6 <> 5"))
        tuning = regression.transform(rows.filter("copy % 6 = 5")).select("label", vector_to_array("_raw").alias("raw")).collect()
    finally:
        rows.unpersist()
    return Model(vocabulary, families, regression, _heat([(r["raw"], int(r["label"])) for r in tuning]))


def _heat(rows: list[tuple[list[float], int]]) -> float:
    """The temperature, from 1/4 to 8, under which the held-out labels are most likely."""

    def loss(t: float) -> float:
        total = 0.0
        for raw, label in rows:
            top = max(raw)
            total += math.log(sum(math.exp((x - top) / t) for x in raw)) - (raw[label] - top) / t
        return total

    return min((2 ** (k / 4) for k in range(-8, 13)), key=loss)


def _triple_list(text: str) -> list[str]:
    own = "".join("0" if c.isdigit() else c if c.isascii() and c.isalpha() else " " for c in text.lower()).split()
    return sorted({" ".join(own[i:i + 3]) for i in range(max(1, len(own) - 2))})


def _plain_terms(text: str) -> set[str]:
    own = "".join("0" if c.isdigit() else c if c.isascii() and c.isalpha() else " " for c in text.lower()).split()
    return {*own, *(f"{a} {b}" for a, b in zip(own, own[1:]))}


def _weighed() -> dict[str, list[dict[str, float]]]:
    """The terms of every template and name with their weights, by family: a term of few families weighs more."""
    texts = {family: [*ts, *NAMES.get(family, ())] for family, ts in TEMPLATES.items()}
    held = {family: set().union(*map(_plain_terms, ts)) for family, ts in texts.items()}
    weight = lambda term: math.log((1 + len(held)) / sum(term in own for own in held.values()))
    return {family: [{t: round(weight(t), 6) for t in sorted(_plain_terms(text))} for text in ts] for family, ts in texts.items()}


def _compared(own: Column, family: Column | None = None) -> Column:
    """Array of (share, weight): of each template's weight, how much the paragraph holds, and the weight itself."""
    shown = lambda ts: F.array(*[F.struct(
        F.array(*map(F.lit, t)).alias("terms"), F.array(*map(F.lit, t.values())).alias("weights"), F.lit(sum(t.values())).alias("total")) for t in ts])
    weighed = _weighed()
    if family is None:
        templates = shown([t for ts in weighed.values() for t in ts])
    else:
        templates = F.element_at(F.create_map(*(x for name, ts in weighed.items() for x in (F.lit(name), shown(ts)))), family)

    def compare(mine: Column) -> Column:
        common = lambda t: F.aggregate(
            F.zip_with(t["terms"], t["weights"], lambda term, w: F.when(F.array_contains(mine, term), w).otherwise(0.0)), F.lit(0.0), lambda a, x: a + x)
        return F.transform(templates, lambda t: _bound(common(t), lambda c: F.struct((c / t["total"]).alias("share"), c.alias("weight"))))

    return _bound(_terms(own), compare)


def _similarity(own: Column) -> Column:
    return F.array_max(F.transform(_compared(own), lambda x: x["share"]))


def paragraphs(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", least: float = 0.5,
               similar: float = 0.7) -> DataFrame:
    """Rows (doc_id, line, paragraph, family, probability, similarity): the license paragraphs.

    The classifier judges every line that passes the gate, alone and with lines after it that a notice could go on in; the
    family it names counts if a template or name of that family is ``similar``. Of overlapping runs of lines of one family
    that with the most of a template is kept, and of those the shortest. ``line`` is the first, from 0. Null and
    empty texts have none.
    """
    near = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(_gate(F.col("text")))
    whole = F.array_join(F.concat(F.array("paragraph"), "following"), "\n")
    near = _lines(near, "doc_id", "text").filter(_gate(whole))
    # The line alone, and with one, two ... of those after it; of these, the words that a notice across the line's end can hold.
    ends = near.select("doc_id", "row", "line", "paragraph", "following", F.explode(F.sequence(F.lit(0), F.size("following"))).alias("more"))
    after = F.slice("following", 1, F.col("more"))
    across = _bound(words(F.col("paragraph")), lambda own: F.concat(
        F.slice(own, F.greatest(F.size(own) - REACH, F.lit(0)) + 1, REACH), F.slice(words(F.array_join(after, "\n")), 1, REACH)))
    cut = ends.select(
        "doc_id", "row", "line", "more", F.array_join(F.concat(F.array("paragraph"), after), "\n").alias("paragraph"),
        F.when(F.col("more") == 0, words(F.col("paragraph"))).otherwise(across).alias("own")).filter(_gate(F.col("paragraph")))
    scored = model.predict(cut).filter((F.col("family") != UNKNOWN) & (F.col("probability") >= least))
    # The template of which most is held, by weight, among those that are similar.
    best = F.array_max(F.transform(F.filter(_compared(F.col("own"), F.col("family")), lambda x: x["share"] >= similar), lambda x: F.struct(
        F.round(x["weight"], 6).alias("weight"), x["share"].alias("share"))))
    found = scored.withColumn("_best", best).filter("_best is not null").select(
        "doc_id", "row", "line", (F.col("line") + F.col("more")).alias("_end"), "paragraph", "family", "probability",
        F.col("_best.share").alias("similarity"), F.col("_best.weight").alias("_weight"))
    # Runs hold REACH words and so many lines at most; the ones beside a run are those that begin so near.
    beside = F.collect_list(F.struct(F.col("line").alias("a"), F.col("_end").alias("b"), F.col("_weight").alias("w"))).over(
        Window.partitionBy("row", "family").orderBy("line").rangeBetween(-REACH, REACH))
    own = F.struct(F.col("line").alias("a"), F.col("_end").alias("b"), F.col("_weight").alias("w"))
    worse = F.exists("_beside", lambda x: (x["a"] >= own["a"]) & (x["b"] <= own["b"]) & (x["b"] - x["a"] < own["b"] - own["a"]) & (x["w"] >= own["w"])
                     | (x["a"] <= own["a"]) & (x["b"] >= own["b"]) & (x["w"] > own["w"]))
    found = found.withColumn("_beside", beside).filter(~worse)
    # Of runs of lines that overlap, all of one notice, the first.
    found = found.withColumn("_last", F.lag("_end").over(Window.partitionBy("row", "family").orderBy("line", "_end")))
    return found.filter(F.col("_last").isNull() | (F.col("_last") < F.col("line"))).select(
        "doc_id", "line", "paragraph", "family", "probability", "similarity")


def scan(docs: DataFrame, model: Model | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_paragraphs, licenses, license, probability), one for each doc_id.

    ``licenses`` are the families found, sorted; ``license`` is the one with the surest paragraph (on a tie the first
    by name), null if there is none. Rows that share a doc_id, null among them, are one document.
    """
    found = paragraphs(docs, model or fit(docs, text), doc_id, text).select("doc_id", "family", "probability")
    every = docs.select(F.col(doc_id).alias("doc_id"), F.lit(None).cast("string").alias("family"), F.lit(None).cast("double").alias("probability"))
    order = F.when(F.col("family").isNotNull(), F.struct(-F.round("probability", 6), "family"))
    best = F.min_by("family", order)
    return every.unionByName(found).groupBy("doc_id").agg(
        F.count("family").alias("n_paragraphs"), F.array_sort(F.collect_set("family")).alias("licenses"),
        best.alias("license"), F.round(F.max("probability"), 6).alias("probability"))

"""Quality classifier, language identification and license scan."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerhouse.llm import language, licences, quality
from layerhouse.llm.queries import QUERIES
from tests.llm.conftest import SF

SF_LARGER = "/root/testdata/sf0.01"


# --- quality ---

def test_quality_against_labels_it_has_not_seen(spark):
    found = QUERIES["op3_quality"](spark, SF_LARGER)
    assert found.columns == ["doc_id", "votes", "posterior", "score", "keep"]
    labels = spark.read.parquet(f"{SF_LARGER}/labels.parquet")
    rows = found.join(labels, "doc_id").select("keep", "quality").collect()
    right = sum(r.keep == (r.quality == 1) for r in rows) / len(rows)
    lost = sum(not r.keep for r in rows if r.quality == 1) / sum(r.quality == 1 for r in rows)
    assert right > 0.97 and lost < 0.02
    assert found.count() == 1000


def brute_em(patterns: dict, rounds: int) -> dict:
    """The same model, one vote at a time."""
    names, k = sorted(patterns), len(next(iter(patterns)))
    good = {}
    for p in names:
        plus, minus = p.count("+"), p.count("-")
        good[p] = min(0.98, max(0.02, 0.5 + 0.5 * (plus - minus) / max(1, plus + minus)))
    for _ in range(rounds):
        chance = {}
        for cls in (0, 1):
            weight = {p: patterns[p] * (good[p] if cls else 1 - good[p]) for p in names}
            for h in range(k):
                seen = {v: sum(weight[p] for p in names if p[h] == v) + prior
                        for v, prior in zip("-0+", (0.5, 4, 4) if cls else (4, 4, 0.5))}
                for v in "-0+":
                    chance[cls, h, v] = seen[v] / sum(seen.values())
        share = (sum(patterns[p] * good[p] for p in names) + 1) / (sum(patterns.values()) + 2)
        for p in names:
            a = share * np.prod([chance[1, h, v] for h, v in enumerate(p)])
            b = (1 - share) * np.prod([chance[0, h, v] for h, v in enumerate(p)])
            good[p] = a / (a + b)
    return good


def test_expectation_maximisation_against_a_plain_one():
    draw = random.Random(4)
    patterns = {"".join(draw.choice("-0+") for _ in quality.HEURISTICS): draw.randint(1, 50) for _ in range(40)}
    posterior, chance, share = quality.expectation_maximisation(patterns, rounds=7)
    assert posterior == pytest.approx(brute_em(patterns, 7), abs=1e-9)
    assert chance.shape == (2, 3, 9) and 0 < share < 1
    assert quality.expectation_maximisation({})[0] == {}


def test_em_finds_the_accuracies_of_made_up_voters():
    draw = random.Random(5)
    right = [0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.9, 0.8, 0.6]
    patterns: dict = {}
    for _ in range(20_000):
        truth = draw.random() < 0.7
        votes = "".join("0" if draw.random() < 0.3 else "+" if (draw.random() < r) == truth else "-" for r in right)
        patterns[votes] = patterns.get(votes, 0) + 1
    _, chance, share = quality.expectation_maximisation(patterns)
    found = chance[1, 2] / (chance[1, 2] + chance[1, 0])
    assert share == pytest.approx(0.7, abs=0.03) and found.tolist() == pytest.approx(right, abs=0.04)


def test_quality_of_odd_rows(odd_documents, no_documents):
    model = quality.fit(odd_documents)
    rows = quality.judge(odd_documents, model).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r.score <= 1 for r in rows)
    assert [r.keep for r in rows if r.doc_id in (2, 3, 4)] == [False] * 3
    assert quality.keep(odd_documents).columns == odd_documents.columns
    assert quality.judge(no_documents, quality.fit(no_documents)).count() == 0


def test_long_text_measures_in_parts(monkeypatch):
    text = ("Some words, more words! " * 500).encode()
    values, _ = quality.measures(text)
    whole = quality.features(text, values)
    monkeypatch.setattr(quality, "CHUNK", 777)
    assert quality.measures(text)[0] == values
    parts = quality.features(text, values)
    assert parts[0].tolist() == whole[0].tolist() and parts[1].tolist() == pytest.approx(whole[1].tolist())


# --- language ---

def test_language_on_held_out_documents(spark):
    found = QUERIES["op7_language"](spark, SF_LARGER)
    docs = spark.read.parquet(f"{SF_LARGER}/documents.parquet")
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_never_read(spark, documents):
    """Spoiling the held-out documents' labels changes no prediction."""
    spoiled = documents.withColumn("lang", F.when(language.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    same = lambda df: sorted(map(tuple, language.identify(df).collect()))
    assert same(spoiled) == same(documents)


def brute_counts(text: str) -> dict:
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    points = [ord(c) for c in " " + " ".join(letters.split(" "))]
    points = [p for i, p in enumerate(points) if i == 0 or p != 32 or points[i - 1] != 32]
    out: dict = {}
    mask = (1 << 64) - 1
    for end in range(1, len(points)):
        for n in (1, 2, 3):
            if end - n + 1 < 0:
                continue
            mixed = 1
            for k, (point, m) in enumerate(zip(points[end - n + 1:end + 1], language._MULTIPLIERS), 1):
                mixed = ((mixed ^ (point + k)) * int(m)) & mask
                mixed ^= mixed >> 29
            key = mixed >> 5 & (language.DIMENSIONS - 1)
            out[key] = out.get(key, 0) + 1
    return out


@pytest.mark.parametrize("text", ["a", "Ab c", "  x  y1z ", "été über", "word " * 30, "日本語 текст"])
@pytest.mark.parametrize("chunk", [1 << 20, 3])
def test_ngram_counts(monkeypatch, text, chunk):
    monkeypatch.setattr(language, "CHUNK", chunk)
    found = language.counts(text)
    assert {int(i): int(found[i]) for i in np.flatnonzero(found)} == brute_counts(text)


def test_language_of_odd_rows(odd_documents, no_documents, spark):
    rows = language.identify(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    none = [r for r in rows if r.doc_id in (2, 3, 4, 6)]
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert {r.held_out for r in rows if r.doc_id is None} == {True}
    assert {r.lang_pred for r in rows} <= {"und", "en", "fr", "de", "es"}
    assert language.identify(no_documents).count() == 0
    unlabelled = odd_documents.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}
    assert language.keep(odd_documents).columns == odd_documents.columns


def test_rare_languages_are_classes_beside_copies(spark):
    common = [(i, f"the man and dog number{chr(97 + i % 26)} {chr(97 + i // 26)} went to town", "en") for i in range(300)]
    copies = [(1000 + i, "le chien et le chat sont dans la maison", "fr") for i in range(300)]
    rare = [(2000 + i, f"der hund {x} und die katze sind nicht im haus", "de") for i, x in enumerate(("alt", "jung"))]
    docs = spark.createDataFrame([*common, *copies, *rare], "doc_id long, text string, lang string")
    model = language.fit(docs, F.lit(True), sample=20)
    assert model.classes == ["de", "en", "fr"]
    assert [model.predict(t)[0] for t in (rare[0][1], common[0][1], copies[0][1])] == ["de", "en", "fr"]


def test_quality_sample_is_of_distinct_texts(spark, monkeypatch):
    texts = [*["the same text of many copies in here"] * 300, *(f"other text number {i} of the few" for i in range(30)), "!!!"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    sizes, train = [], quality.train
    monkeypatch.setattr(quality, "train", lambda rows: sizes.append(len(rows)) or train(rows))
    for sample in (20, 400):
        quality.fit(docs, sample=sample)
    assert sizes == [20, 32]


def test_bounds_of_the_sample_start_no_python(spark):
    docs = spark.createDataFrame([("one", "en", 1), ("two", "en", 3), ("drei", "de", 3), ("!", "de", 1), ("un", "fr", 1)], "text string, lang string, m long")
    found = language._below(docs, F.col("m"), {"en": 2, "de": 9})
    assert sorted(map(tuple, found.select("text", "lang", "mark").collect())) == [("drei", "de", 3), ("one", "en", 1)]
    assert language._below(docs, F.col("m"), {}).count() == 0
    table = spark.range(3).select(F.lit("a").alias("text"), F.lit("en").alias("lang"), F.col("id").alias("m"))
    assert "RDD" not in language._below(table, F.col("m"), {"en": 2})._jdf.queryExecution().optimizedPlan().toString()


def test_leader_is_sparse_and_learns():
    draw = np.random.default_rng(1)
    leader = language.Leader(2, l1=0.5)
    for _ in range(400):
        target = int(draw.integers(2))
        index = np.unique([target, *draw.integers(10, 300, 5)])
        leader.learn(index, np.full(len(index), 1 / np.sqrt(len(index))), target)
    weights = leader.weights()
    assert weights[0, 0] > weights[0, 1] and weights[1, 1] > weights[1, 0]
    assert np.count_nonzero(weights[10:300]) < 290


def test_temperature_makes_overconfident_scores_honest():
    draw = np.random.default_rng(2)
    targets = draw.integers(2, size=4000)
    honest = np.where(draw.random(4000) < 0.8, targets, 1 - targets)
    logits = np.zeros((4000, 2))
    logits[np.arange(4000), honest] = 10.0
    scores = language.softmax(logits / language.temperature(logits, targets))
    assert scores.max(1).mean() == pytest.approx(0.8, abs=0.03)


def test_counts_of_long_texts_are_not_cut(spark):
    rows = [(i, ("ab" * 100_000 if i % 2 else "the words of a text number") + " " + "xyz"[i % 3], "one" if i % 2 else "two") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    plain = language.weigh

    def weigh(index, count, idf):
        seen.append(int(count.max()))
        return plain(index, count, idf)

    language.weigh, model = weigh, None
    try:
        model = language.fit(docs, F.lit(True))
    finally:
        language.weigh = plain
    assert max(seen) == max(int(language.counts(t).max()) for _, t, _ in rows) > 65_535
    assert [model.predict(t)[0] for _, t, _ in rows] == [x for _, _, x in rows]


def test_too_many_languages_fail_clearly(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_CLASSES", 5)
    docs = spark.createDataFrame([(i, f"text {i}", f"l{i}") for i in range(6)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="6 different values of lang"):
        language.fit(docs, F.lit(True))


# --- licenses ---

@pytest.fixture(scope="module")
def scanner(spark):
    return licences.fit(spark.read.parquet(f"{SF_LARGER}/documents.parquet"))


def test_licenses_against_exact_lines(spark, scanner):
    docs = spark.read.parquet(f"{SF_LARGER}/documents.parquet")
    known = {t: family for family, texts in licences.TEMPLATES.items() for t in texts}
    rows = {r.doc_id: r for r in licences.scan(docs, scanner).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        expected = sorted({known[x] for x in text.split("\n") if x in known})
        assert rows[doc_id].licenses == expected and (rows[doc_id].license in expected or not expected)
    assert len(rows) == 1000 and sum(bool(r.licenses) for r in rows.values()) > 20


def test_license_query(spark, documents):
    assert QUERIES["op4_licences"](spark, SF).count() == documents.count()


def test_every_template_is_told_and_scraps_are_unknown(spark, scanner):
    texts = [(f, t) for f, ts in licences.TEMPLATES.items() for t in ts]
    noisy = [(f, f"  {t.upper()} and some other words follow here") for f, t in texts]
    scraps = [("none", t) for t in ("license", "the MIT", "All rights", "free software for the public", "copyright", "apache helicopter", "")]
    rows = [(i, t, f) for i, (f, t) in enumerate([*texts, *noisy, *scraps])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, truth string")
    found = {r.doc_id: r.license for r in licences.scan(docs, scanner).collect()}
    wrong = {t: found[i] for i, t, f in rows if (found[i] or "none") != f}
    assert wrong == {}


def test_license_of_odd_rows(spark, odd_documents, no_documents, scanner):
    rows = licences.scan(odd_documents.withColumn("family", F.lit("clash")), scanner).collect()
    assert len(rows) == odd_documents.select("doc_id").distinct().count() and all(r.licenses == [] for r in rows)
    assert licences.scan(no_documents, scanner).count() == 0
    assert licences.fit(no_documents).families[0] == licences.UNKNOWN


def test_common_licenses_are_found(spark):
    rows = [(i, f"Some words of document {i}\nand more of them\n" + ("Licensed under CC BY 4.0.", "All rights reserved.", "No notice.")[i % 3]) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.license for r in licences.scan(docs).collect()}
    assert all(found[i] == ("cc-by", "all-rights-reserved", None)[i % 3] for i in range(600))


def test_wrapped_notices_are_found(spark, scanner):
    texts = [
        ("mit", 2, "MIT\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files"),
        ("bsd", 1, "Some code\n# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that"),
        ("gpl", 0, "    This program is free software: you can redistribute it and/or modify\n    it under the terms of the GNU General Public License as published by\n    the Free"),
        ("mpl", 0, "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed"),
        ("mit", 0, "Permission\n" + "\n".join("is hereby granted, free of charge, to any person obtaining a copy of this software".split())),
        (None, None, "Permission is hereby granted, free of charge,\n\nto any person obtaining a copy\nof this software"),
        ("mit", 1, "x\nReleased under the MIT License.\ny")]
    docs = spark.createDataFrame([(i, t) for i, (_, _, t) in enumerate(texts)], "doc_id long, text string")
    rows = licences.paragraphs(docs, scanner).collect()
    assert sorted((r.doc_id, r.family) for r in rows) == [(i, f) for i, (f, _, _) in enumerate(texts) if f]
    assert all(r.line == texts[r.doc_id][1] for r in rows if r.doc_id != 4)


def test_held_out_paraphrases_are_found(spark, scanner):
    """Sentences that neither the templates nor the phrases of the training hold, and as many without a notice."""
    frames = ("The code in this repository may be used under the {}.", "We publish everything here under {} since 2019",
              "Unless stated otherwise, {} applies to these files", "Sources: {}")
    rows = [(f, frame.format(n)) for f, names in licences.NAMES.items() for n in names for frame in frames]
    rows += [("mit", "Distributed under the MIT license."), ("mit", "MIT License"), ("mit", "This project is available under the MIT licence"),
             ("apache-2.0", "Code released under Apache 2.0."), ("cc-by", "Licensed under Creative Commons Attribution 4.0"),
             ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
             ("epl", "This program is made available under the terms of the Eclipse Public License")]
    none = ("The taxi was licensed in the city", "Her licence was taken away", "a lecture at MIT about licensing", "copyright is a right", "The Apache tribe lived there",
            "a general public of two thousand", "the commons room is creative", "the public domain of the king", "all rights and duties", "He saw the eclipse in public",
            "a gnu in the zoo", "terms of the license dispute", "license plates are redistributed each year", "the mozilla monster film", "rights reserved seats only")
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)] + [(10_000 + i, t) for i, t in enumerate(none)], "doc_id long, text string")
    found = {r.doc_id: r.license for r in licences.scan(docs, scanner).collect()}
    hit = sum(found[i] == f for i, (f, _) in enumerate(rows))
    false = [t for i, t in enumerate(none) if found[10_000 + i]]
    print("recall", hit / len(rows), [(t, found[i]) for i, (f, t) in enumerate(rows) if found[i] != f][:12], "false alarms", false)
    assert hit >= 0.9 * len(rows) and len(false) <= 1
    assert all(found[i] == f for i, (f, _) in enumerate(rows) if i >= len(rows) - 7)


def test_the_license_model_does_not_depend_on_the_order_of_rows(spark, documents):
    one, two = (licences.fit(d) for d in (documents, documents.repartition(5).orderBy(F.rand(3))))
    assert one.vocabulary == two.vocabulary and one.heat == two.heat
    assert one.regression.coefficientMatrix.toArray().tolist() == two.regression.coefficientMatrix.toArray().tolist()


def test_license_scan_runs_no_python(spark, documents, scanner):
    plan = licences.scan(documents, scanner)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_gate_tries_few_alternatives_at_a_character():
    """The plain list of words and the shared beginnings pass the same lines; the gate has few branches at its top."""
    import re

    plain = (r"licen[cs]|spdx|copyright|rights reserved|public domain|creative commons|\bcc0|\bcc by\b|\bcc-by\b|redistribut|hereby granted"
             r"|\bgnu\b|\b[al]?gpl|\bmit\b|\bapache\b|\bbsd\b|\bmozilla\b|\bmpl\b|\bisc\b|\beclipse public\b|\bepl\b")
    terms = re.sub(r"\\b|\[cs\]|\[al\]\?", "", plain).split("|") + ["license", "licence", "agpl", "lgpl", "creative", "ep", "m"]
    texts = [a + t + b for t in terms for a in ("", "x", " ", "-", "_", "0") for b in ("", "x", " ", "-", "_", "0")]
    assert [t for t in texts if bool(re.search(plain, t)) != bool(re.search(licences.GATE, t))] == []
    depth, branches = 0, 1
    for c in licences.GATE:
        depth += (c == "(") - (c == ")")
        branches += c == "|" and depth == 0
    assert branches < 10

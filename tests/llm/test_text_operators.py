import hashlib
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import bytetext, columnbwt, decontaminate, fmindex, langid, license, minhash, packing, pii, quality, suffixdedup, toxicity
from tests.llm import helpers

SF = "/root/testdata/sf0.001"


def corpus(seed: int, n: int = 60) -> list:
    """Texts with copies, shared passages, one very long and several empty ones, nulls and a repeated row."""
    r = random.Random(seed)
    words = ["the", "of", "Ünd", "a", "b", "çà", "LOUD", "x1", "it's", "42", "***", "end.\n"]
    rows = []
    for i in range(n):
        t = " ".join(r.choice(words) for _ in range(r.randrange(0, 90)))
        if rows and r.random() < 0.5:
            other = r.choice(rows)[1] or ""
            cut = r.randrange(len(other) + 1)
            t = other[:cut] + r.choice(["", " new ", "\n"]) + other[cut:] if r.random() < 0.6 else t + " " + other[cut : cut + 120]
        rows.append((i, t))
    rows += [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, rows[3][1]), (n + 4, "word"), (n + 5, "long " + "abc def " * 4000)]
    return rows


def frame(spark, rows):
    """Rows with columns whose names clash with the operators' own."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", F.lit("x").alias("row"), F.lit(1).alias("n"), F.lit("y").alias("k1"), F.lit(2.0).alias("score")).repartition(3)


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def test_words_match_plain_regex():
    r = random.Random(1)
    for _ in range(300):
        texts = ["".join(r.choice("abZ é\n\t.9") for _ in range(r.randrange(0, 40))) for _ in range(5)]
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
        for table, pattern in ((bytetext.WHITESPACE_WORDS, helpers.SPACE_WORD), (bytetext.ALNUM_WORDS, helpers.ALNUM_WORD)):
            h, s, e, at = bytetext.words(data, offsets, table)
            found = [[data[a:b].tobytes().decode() for a, b in zip(s[lo:hi], e[lo:hi], strict=True)] for lo, hi in zip(at[:-1], at[1:], strict=True)]
            low = [[w.translate(helpers.LOWER) for w in ws] for ws in found]
            assert low == [pattern.findall(t.translate(helpers.LOWER)) for t in texts]
            assert [int(x) for x in h] == [bytetext.hash_word(w) for f in found for w in f]


def test_words_across_blocks(monkeypatch):
    text = ("alpha beta " * 50 + "x" * 500 + " gamma").encode()
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, 300, len(text)])
    whole = bytetext.words(data, offsets, bytetext.WHITESPACE_WORDS)
    monkeypatch.setattr(bytetext, "BLOCK", 64)
    for a, b in zip(whole, bytetext.words(data, offsets, bytetext.WHITESPACE_WORDS), strict=True):
        assert (a == b).all()


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates(spark, seed):
    rows = corpus(seed)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in minhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == helpers.clusters(dict(rows))


def test_near_duplicates_edges(spark):
    assert minhash.near_duplicates(empty(spark)).count() == 0
    rows = [(None, "a b c d e f g"), (7, "a b c d e f g"), (7, "a b c d e f g"), (3, None)]
    got = sorted(map(tuple, minhash.near_duplicates(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 3, 7, False), (7, 3, 7, True), (7, 3, 7, True), (3, 0, 3, True)], key=str)


def test_components_of_a_chain(spark):
    n = 40
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101)], "a long, b long")
    got = {r.node: r.label for r in minhash.components(edges).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {100: 100, 101: 100}


def test_estimate_follows_similarity():
    r = np.random.default_rng(3)
    pool = r.integers(0, 1 << 63, 3000, dtype=np.uint64)
    for share in (0.6, 0.75, 0.9):
        common = int(2000 * share / (1 + share) * 1.0)
        a, b = np.sort(pool[:1000]), np.sort(np.concatenate((pool[:common], pool[2000 : 3000 - common])))
        m = minhash.signatures(np.concatenate((a, b)), np.array([a.size, b.size]))
        true = common / (a.size + b.size - common)
        assert abs((m[:, 0] == m[:, 1]).mean() - true) < 0.1


def test_fm_index():
    r = np.random.default_rng(5)
    for _ in range(30):
        text = np.append(r.integers(0, 4, 200), 0)
        index = fmindex.FMIndex(text, 4, sample=5)
        for m in (1, 2, 4):
            phrases = r.integers(1, 4, (12, m))
            row, lo, hi = index.search(phrases)
            want = {i: [j for j in range(text.size - m + 1) if (text[j : j + m] == p).all()] for i, p in enumerate(phrases)}
            assert {int(x): sorted(index.locate(np.arange(a, b)).tolist()) for x, a, b in zip(row, lo, hi, strict=True)} == {i: v for i, v in want.items() if v}


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_decontaminate(spark, block_bytes):
    rows = corpus(4, 30)
    texts = dict(rows)
    items = [(1, " ".join((texts[5] or "").split()[2:40])), (2, "word"), (10, None), (11, ""), (3, texts[7]), (3, "it's 42")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {x.doc_id: x for x in decontaminate.decontaminate(frame(spark, rows), bench, block_bytes=block_bytes).collect()}
    for i, (n, hit, names) in helpers.contamination(texts, [(str(a), b) for a, b in items]).items():
        x = got[i]
        assert (x.n_words, x.n_hit, x.items) == (n, hit, names)
        assert x.items_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert x.contaminated == (hit > 0 and 20 * hit >= n)
        raw = (texts[i] or "").encode()
        assert sum(len(helpers.ALNUM_WORD.findall(raw[s.start : s.end].decode().translate(helpers.LOWER))) for s in x.spans) == hit
    none = decontaminate.decontaminate(frame(spark, rows), bench.limit(0)).agg(F.sum("n_hit")).first()[0]
    assert none == 0 and decontaminate.decontaminate(empty(spark), bench).count() == 0


@pytest.mark.parametrize("rows", [1 << 16, 3, 7])
def test_collection_of_documents(tmp_path, monkeypatch, rows):
    monkeypatch.setattr(columnbwt, "ROWS", rows)
    for seed in range(25):
        r = random.Random(seed)
        docs = [[r.randrange(3) for _ in range(r.randrange(0, 14))] for _ in range(r.randrange(0, 30))]
        bounds = np.concatenate(([0], np.cumsum([len(d) for d in docs]))).astype(np.int64)
        c = columnbwt.Collection(np.array([x for d in docs for x in d], np.int64), bounds, str(tmp_path))
        got = [(int(k), *map(int, x)) for common, rest in c.rows() for k, x in zip(common, rest, strict=True)]
        c.remove()
        order = sorted(((tuple(x + 1 for x in d[o:]) + (0,), i, o) for i, d in enumerate(docs) for o in range(len(d) + 1)), key=lambda t: t[:2])

        def common(a, b):
            k = 0
            while a[k] == b[k] and a[k]:
                k += 1
            return k

        shared = [0] + [common(x[0], y[0]) for x, y in zip(order, order[1:], strict=False)]
        assert got == [(k, docs[i][o - 1] if o else -1, i, o) for k, (_, i, o) in zip(shared, order, strict=False)]
    assert not list(tmp_path.iterdir())


@pytest.mark.parametrize("hot", [1 << 20, 0])
def test_surroundings_of_one_passage(spark, monkeypatch, hot):
    """A passage in many surroundings, some of which repeat too, also where its cores are cut on the finer grid."""
    monkeypatch.setattr(suffixdedup, "HOT_BYTES", hot)
    monkeypatch.setattr(suffixdedup, "COLLECTION_BYTES", 3000)
    monkeypatch.setattr(columnbwt, "ROWS", 50)
    r = random.Random(4)
    passage = "".join(r.choice("abcdefgh ") for _ in range(240))
    rows = []
    for i in range(90):
        cut, end = r.randrange(0, 80), r.randrange(160, 241)
        rows.append((i, "".join(r.choice("xyz") for _ in range(r.randrange(40))) + passage[cut:end] + "".join(r.choice("uv") for _ in range(r.randrange(40)))))
    got = sorted((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in suffixdedup.remove_repeats(frame(spark, rows), window=120, text=True).collect())
    assert got == sorted(helpers.repeats(rows, 120))


def test_intervals_of_a_long_text(monkeypatch):
    """A text looked at in parts has the same strings at the same anchors."""
    r = np.random.default_rng(3)
    data = r.integers(97, 101, 5000).astype(np.uint8)
    offsets = np.array([0, 10, 700, 700, 5000])
    starts = lambda: sorted((int(k), x, int(a), int(h)) for d, s, e, p, anchor in suffixdedup.intervals(data, offsets, 50, 24) for k, lo, hi, a, h in zip(d, s, e, p, anchor, strict=True) for x in range(lo, hi + 1))
    whole = starts()
    monkeypatch.setattr(suffixdedup, "_STARTS", 64)
    assert starts() == whole and len(whole) == 641 + 4251


@pytest.mark.parametrize("window", [200, 40, 9])
def test_remove_repeats(spark, window):
    rows = corpus(6, 40)[:-1] + [(200, "xy" * 300), (201, "long " + "abc def " * 300)]
    rows.append(rows[2])
    got = sorted((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in suffixdedup.remove_repeats(frame(spark, rows), window=window, text=True).collect())
    assert got == sorted(helpers.repeats(rows, window))


def test_remove_repeats_edges(spark):
    assert suffixdedup.remove_repeats(empty(spark)).count() == 0
    rows = [(None, "q" * 250), (None, "q" * 250), (1, None)]
    got = sorted((x.n_bytes, x.n_removed, x.n_spans) for x in suffixdedup.remove_repeats(frame(spark, rows)).collect())
    assert got == [(0, 0, 0), (250, 250, 1), (250, 250, 1)]


def test_quality_base_counts(spark):
    rows = corpus(8) + [(500, "a b c " * 40), (501, "same line\nsame line\n\nsame line"), (502, " ".join(f"w{i % 31} v{i % 17}" for i in range(800)))]
    got = {x.id: (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) for x in quality.features(frame(spark, rows), id_col="doc_id", stratum_col=None).collect()}
    assert got == {i: helpers.quality(t) for i, t in rows}


def test_binomial_tail(spark):
    from math import comb

    for n, k, p in ((100, 0, 0.05), (100, 2, 0.05), (400, 9, 0.05), (1000, 3, 0.01), (50, 40, 0.5), (20000, 80, 0.005)):
        got = spark.range(1).select(quality.binomial_tail(F.lit(k).cast("bigint"), F.lit(n).cast("bigint"), p)).first()[0]
        want = 1.0 if k >= p * n else sum(comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1)) if n <= 1000 else None
        assert want is None or got == pytest.approx(want, rel=1e-9)
        assert 0 <= got <= 1


def test_quality_certifies_only_with_enough_labels(spark):
    good = [(i, f"s{i % 7} " + " ".join(f"word{(i * 31 + j * 7) % 997}" for j in range(60)), "en") for i in range(4000)]
    bad = [(10000 + i, " ".join(f"word{(i * 17 + j) % 997}***" for j in range(60)), "en") for i in range(300)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 10000)) for i, _, _ in good + bad], "doc_id long, quality int")
    got = quality.judge(docs, labels).groupBy((F.col("doc_id") < 10000).alias("good")).agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()
    assert {x.good: x.share for x in got} == {True: 1.0, False: 0.0}
    few = quality.judge(docs, labels.limit(50)).where("not kept").count()
    assert few == 0


def test_language_identification(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs.where(~langid.held_out("doc_id")))
    seen = langid.identify(docs.where(langid.held_out("doc_id")), model).collect()
    assert sum(x.lang == x.lang_pred for x in seen) >= 0.9 * len(seen)
    rows = [(1, None), (2, ""), (3, "123 -- 4"), (4, "Å"), (5, "the of and")]
    odd = {x.doc_id: x for x in langid.identify(frame(spark, rows), model).collect()}
    assert [odd[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and odd[4].lang_pred != "und" and odd[5].lang_pred == "en"
    assert all(0 <= x.score <= 1 for x in odd.values()) and odd[1].row == "x"
    assert langid.train(empty(spark)).languages == []
    assert langid.identify(empty(spark), model).count() == 0


def test_unknown_words_back_off_to_shorter_grams():
    model = langid.Model.fit(["abcabc", "cabcab", "xyzxyz", "zxyzxy"], np.array([0, 0, 1, 1]), np.array([50, 40, 50, 40]), ["aa", "zz"])
    raw = [b"bcabca", b"yzxyzx", b"abcabc", b""]
    names, score = model.predict(np.frombuffer(b"".join(raw), np.uint8), np.array([0, 6, 12, 18, 18]))
    assert names == ["aa", "zz", "aa", "und"] and score[3] == 0


def test_language_against_brute_force(spark, monkeypatch):
    docs = [tuple(x) for x in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").where("text is not null").collect()]
    known = [(t, k) for i, t, k in docs if i % 3 == 0 and k is not None]
    probes = [t for i, t, _ in docs if i % 3 == 1] + ["zu jusqu'à Straße ÉTÉ 12 x", "...", "Ω", "", None, "a" * 300_000, "the of " * 50_000, "the of and"]
    model = langid.train(spark.createDataFrame([(i, t, k) for i, (t, k) in enumerate(known)], "doc_id long, text string, lang string"))
    rows = spark.createDataFrame(list(enumerate(probes)), "doc_id long, text string")
    want = helpers.language(known, probes)
    for cells in (langid._CELLS, 8):
        monkeypatch.setattr(langid, "_CELLS", cells)
        seen = {x.doc_id: x for x in langid.identify(rows, model).collect()}
        for i, (lang, score) in enumerate(want):
            assert seen[i].lang_pred == lang and abs(seen[i].score - score) < 1e-4, (i, seen[i], lang, score)


def test_more_languages_than_a_few_hundred(spark):
    rows = [(i, f"word{i} mot{i} wort{i}", f"l{i:04d}") for i in range(700)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.languages) == 700
    seen = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model).collect()
    assert all(x.lang == x.lang_pred for x in seen)


def test_toxicity_learns_pairs():
    """Two terms that are harmless alone and toxic together."""
    r = np.random.default_rng(2)
    rows, label = [], []
    for _ in range(3000):
        a, b = r.random() < 0.5, r.random() < 0.5
        rows.append(np.array(sorted(([10] if a else []) + ([20] if b else []) + [1000 + int(r.integers(50))]), np.int32))
        label.append(int(a and b))
    m = toxicity.Machine.fit(rows, np.array(label), np.array([20, 10, 1000, 1001]))
    x = np.zeros((4, m.chosen.size))
    for i, on in enumerate(((), (10,), (20,), (10, 20))):
        x[i, np.isin(m.chosen, on)] = 1
    p = m.score(x)
    assert p[3] > 0.9 and p[:3].max() < 0.2


def test_toxicity_finds_pairs_whose_parts_say_nothing(spark):
    """Exactly one of two words is toxic; each alone is as often in clean texts."""
    r = random.Random(6)
    rows = []
    for i in range(1600):
        a, b = r.random() < 0.5, r.random() < 0.5
        other = [f"w{r.randrange(30)}" for _ in range(12)]
        at = r.randrange(12)
        rows.append((i, " ".join(other[:at] + ["group"] * a + ["insult"] * b + other[at:]), int(a != b)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    machine = toxicity.train(docs, labels)
    word = lambda w: int(toxicity.buckets(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]))[0][0, 0])
    assert {word("group"), word("insult")} <= set(machine.chosen.tolist())
    seen = toxicity.score(docs, machine).join(labels, "doc_id")
    assert seen.where("predicted = toxic").count() >= 0.97 * len(rows)


def test_toxicity_score_against_brute_force(spark):
    r = np.random.default_rng(4)
    texts = ["", None, "Idiot idiots und idiotic", "a b c", "é" * 9 + " x", "long " * 30_000 + "idiot"]
    raw = [(t or "").encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)
    term, at = toxicity.buckets(np.frombuffer(b"".join(raw), np.uint8), offsets)
    every = np.unique(term)
    chosen = every[:: max(1, every.size // 9)]
    m = toxicity.Machine(chosen, -0.3, r.normal(size=chosen.size), r.normal(size=(chosen.size, 3)))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("predicted", F.lit("x"))
    got = {x.doc_id: x for x in toxicity.score(rows, m).collect()}
    for i in range(len(texts)):
        on = [k for k, c in enumerate(chosen) if c in term[:, at[i] : at[i + 1]]]
        z = m.bias + sum(m.weight[k] for k in on) + sum(m.factor[a] @ m.factor[b] for x, a in enumerate(on) for b in on[x + 1 :])
        assert abs(got[i].score - 1 / (1 + np.exp(-z))) < 1e-9 and got[i].predicted == int(got[i].score >= 0.5)


def test_toxicity_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    machine = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    out = toxicity.score(frame(spark, [(1, None), (2, ""), (None, "idiot")]), machine).collect()
    assert len(out) == 3 and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in out)
    assert toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int")).chosen.size == 0
    assert toxicity.score(empty(spark), machine).count() == 0


def test_licence_scan(spark):
    r = random.Random(4)
    prose = lambda: "\n".join(" ".join(r.choice(("sun", "tree", "walks", "slowly", "green")) for _ in range(12)) for _ in range(4))
    rows = [(i, prose()) for i in range(60)]
    rows += [(100, prose() + "\nReleased under the MIT License.\n" + prose()), (101, "Licensed under the Apache License, Version 2.0."), (102, "He lost his fishing licence."), (103, None), (104, "")]
    got = {x.doc_id: x for x in license.scan(frame(spark, rows)).collect()}
    assert got[100].license == "MIT" and got[101].license == "Apache-2.0" and got[101].n_confirmed == 1
    assert got[102].license in (None, "unknown") and got[103].license is None and got[104].score == 0
    assert all(got[i].license is None for i in range(60)) and len(got) == len(rows)


WRAPPED = {
    "MIT": "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated documentation\nfiles (the \"Software\"), to deal in the Software without\nrestriction, including without limitation the rights to use",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0\n(the \"License\"); you may not use this file except in\ncompliance with the License.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or\nmodify it under the terms of the GNU General Public License\nversion 2 as published by the Free Software Foundation.",
    "LGPL": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.",
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
    "BSD": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "CC-BY": "This work is licensed under a Creative Commons\nAttribution 4.0 International License.",
    "CC-BY-SA": "This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.",
    "CC-BY-NC": "This work is licensed under a Creative Commons\nAttribution-NonCommercial 4.0 International License.",
    "CC0": "To the extent possible under law, the author has waived all\ncopyright and related or neighboring rights to this work under CC0 1.0.",
    "Unlicense": "This is free and unencumbered software released\ninto the public domain.",
    "proprietary": "No part of this publication may be reproduced without the\nprior written permission of the publisher.",
}


def test_licence_of_wrapped_headers(spark):
    assert set(WRAPPED) == set(license.TEMPLATES)
    r = random.Random(5)
    prose = lambda: "\n".join(" ".join(r.choice(("sun", "tree", "walks", "slowly", "green")) for _ in range(12)) for _ in range(4))
    forms = (lambda t: t, lambda t: "/*\n * " + t.replace("\n", "\n * ") + "\n */\n\nint x;", lambda t: "# A tool.\n#\n# " + t.replace("\n", "\n# ") + "\n#\n# " + prose(), lambda t: prose() + "\n" + t + "\n" + prose())
    rows, want = [(i, prose()) for i in range(60)], {}
    for family, header in WRAPPED.items():
        for form in forms:
            want[len(rows)] = (family, [family])
            rows.append((len(rows), form(header)))
    want[len(rows)] = (None, ["Apache-2.0", "MIT"])
    rows.append((len(rows), "Released under the MIT License.\nLicensed under the Apache License, Version 2.0."))
    got = {x.doc_id: (x.license, x.families) for x in license.scan(frame(spark, rows)).collect()}
    wrong = {rows[i][1]: (got[i], w) for i, w in want.items() if got[i][1] != w[1] or w[0] not in (None, got[i][0])}
    assert wrong == {}


def test_licence_level_is_from_lines_with_a_cue(spark):
    r = random.Random(6)
    scores = [round(r.random(), 3) for _ in range(700)]
    rows = [("MIT", x, "none", 1.0, False) for x in scores] + [("MIT", 1.0, "MIT", 1.0, True)] * 50
    judged = spark.createDataFrame(rows, "family string, score double, w_family string, w_score double, matched boolean")
    for rate in (0.01, 0.1, 1.0):
        level = license.calibrate(judged, rate)
        above = sum(x * 1e6 > level + 1e-3 for x in scores)
        assert above <= rate * len(scores) and (rate == 1.0 or above > rate * len(scores) - 7)
    assert license.calibrate(judged.where("matched"), 0.01) == 0
    weak = "slowly the work is licensed sun under tree a creative green commons attribution walks 4 0 international river license"
    plain = [(i, "sun tree walks slowly green") for i in range(60)]
    strong = [(100 + i, "MIT License licensed released talk") for i in range(20)]
    name = lambda rows, rate: {x.doc_id: x.license for x in license.scan(frame(spark, rows), false_rate=rate).collect()}[99]
    assert name([*plain, (99, weak)], 0.01) == "CC-BY"
    assert name([*plain, *strong, (99, weak)], 0.01) == "unknown"
    assert name([*plain, *strong, (99, weak)], 1.0) == "CC-BY"


def test_licence_short_names_and_edges(spark):
    short = {"GPLv3": "GPL-3.0", "Apache 2.0 terms": "Apache-2.0", "CC BY 4.0": "CC-BY", "code is under GPLv2 only": "GPL-2.0", "AGPLv3": "AGPL-3.0", "3-clause BSD terms": "BSD", "The Apache helicopter landed at noon.": None}
    prose = "sun tree walks slowly green\n" * 5
    rows = [(i, prose) for i in range(60)] + [(100 + i, f"{prose}\n{t}\n\n{prose}") for i, t in enumerate(short)]
    rows += [(None, "Released under the MIT License."), (None, prose), (7, "Released under the MIT License."), (500, "x " * 200_000 + "\nReleased under the MIT License.\n")]
    got = [(x.doc_id, x.license) for x in license.scan(frame(spark, rows).withColumn("templates", F.lit(1)).withColumn("family", F.lit("x"))).collect()]
    assert len(got) == len(rows)
    assert {i: x for i, x in got if i is not None and 100 <= i < 500} == {100 + i: f for i, f in enumerate(short.values())}
    assert [x for i, x in got if i is None] == ["MIT", "MIT"] and [x for i, x in got if i == 7] == ["MIT", "MIT"] and dict(got)[500] == "MIT"
    none = license.scan(empty(spark))
    assert none.count() == 0 and "license" in none.columns


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_licences_outside_the_families_are_unknown(spark):
    """Notices of licences that no template is of, beside the corpus; every template is still its family's."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    other = ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "Licensed under the EUPL.", "Licensed under the European Union Public Licence, version 1.2", "Licensed under the Artistic License 2.0.", "Licensed under the ISC license.", "Licensed under the Zlib license.", "Distributed under the Boost Software License, Version 1.0.", "SPDX-License-Identifier: EPL-2.0"]
    known = [(f, t) for f, ts in license.TEMPLATES.items() for t in ts]
    rows = [(10**7 + i, t) for i, t in enumerate(other)] + [(2 * 10**7 + i, t) for i, (_, t) in enumerate(known)] + [(3 * 10**7 + i, t) for i, t in enumerate(license.PLAIN)]
    got = {x.doc_id: x.license for x in license.scan(docs.unionByName(spark.createDataFrame(rows, docs.schema))).collect()}
    assert {t: got[10**7 + i] for i, t in enumerate(other)} == dict.fromkeys(other, "unknown")
    assert [(t, got[2 * 10**7 + i]) for i, (f, t) in enumerate(known) if got[2 * 10**7 + i] != f] == []
    assert [t for i, t in enumerate(license.PLAIN) if got[3 * 10**7 + i] is not None] == []


def test_rarest_words_of_templates():
    known = [("a", "the x license"), ("b", "the y license"), ("b", "the license"), ("c", "The license: z z")]
    assert license.rarest(known) == [["x"], ["y"], ["license", "the"], ["z"]]


def test_quality_certification_against_brute_force(spark):
    """Certified cutoffs recomputed with exact fractions, and what they keep."""
    from fractions import Fraction
    from math import comb

    r = random.Random(12)
    docs, marks = [], []
    for i in range(3600):
        good = int(r.random() < 0.6)
        noisy = r.random() < (0.0005 if good else 0.7)
        words = [r.choice(("sun", "tree", "walks", "Slowly", "green", "river")) + str(r.randrange(40)) + ("###" if noisy and r.random() < 0.5 else "") for _ in range(60)]
        docs.append((i, " ".join(words), "en" if i % 4 else None))
        marks.append((i, good))
    docs += [(None, docs[0][1], "en"), (3, docs[5][1], "en"), (9000, None, "en")]
    marks += [(3, 1), (None, 1), (7, None)]
    spark_docs = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns({c: F.lit(c) for c in ("id", "stratum", "good", "rule")})
    labels = spark.createDataFrame(marks, "doc_id long, quality int").withColumn("stratum", F.lit("s"))
    counts = quality.features(spark_docs)
    held = counts.withColumn("held", F.pmod(F.xxhash64("id", F.lit("holdout")), F.lit(2)) == 1)
    rows = held.select("id", "stratum", "held", "n_words", "n_repeat_words", *[v.alias(k) for k, v in quality.rates(held).items()]).collect()
    good = {}
    for i, y in marks:
        if i is not None and y is not None:
            good[i] = max(y, good.get(i, 0))
    alpha = delta = 0.05
    strata = {x.stratum for x in rows if x.id in good}
    want = {}
    for s in strata:
        for rule, grid in quality.GRID.items():
            mine = [(x[rule], x.held, good[x.id]) for x in rows if x.id in good and x.stratum == s]
            passed, best = True, None
            for c in grid:
                n = sum(h and y == 1 for _, h, y in mine)
                k = sum(h and y == 1 and v > c for v, h, y in mine)
                p = Fraction(alpha / len(quality.GRID))
                tail = sum(comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1)) if k < p * n else 1
                passed = passed and tail <= delta / len(quality.GRID) / len(strata)
                use = sum(not h and y == 0 and v > c for v, h, y in mine) - 10 * sum(not h and y == 1 and v > c for v, h, y in mine)
                if passed and use > 0 and (best is None or (use, c) > best):
                    best = use, c
            if best:
                want[s, rule] = best[1]
    got = {(x.stratum, x.rule): x.cutoff for x in quality.certify(counts, labels.select(F.col("doc_id").alias("id"), "quality")).collect()}
    assert got == want and ("en", "symbol_rate") in want
    out = quality.judge(spark_docs, labels).collect()
    assert len(out) == len(docs)
    by = {(x.id, x.n_words, x.symbol_rate): x for x in rows}
    for x in out:
        if x.doc_id != 3:  # an id with two texts
            row = next(v for v in by.values() if v.id == x.doc_id)
            fails = any(row[rule] > want.get((row.stratum, rule), 10**9) for rule in quality.GRID)
            assert x.kept == (not x.base_failed and not fails)
    none = quality.judge(empty(spark), labels)
    assert none.count() == 0


def _plain_base(t):
    import re

    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        if 14 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out, key=lambda x: (x[1], pii.KINDS.index(x[0])))


def test_pii_base_patterns():
    r = random.Random(1)
    for _ in range(5000):
        t = "".join(r.choice("12345 .-+@()ab1é\n") for _ in range(r.randrange(0, 60)))
        assert pii.base_spans(t) == _plain_base(t)
    assert pii.base_spans("é x@y.z 4111 1111 1111 1111 +1 (909) 555-2931 x 10.0.0.256 1.2.3.4") == [("email", 2, 7), ("card", 8, 27), ("phone", 28, 45), ("ip", 59, 66)]


def test_pii_field(spark):
    field = pii.train()
    held = pii.examples(150, seed=77)
    assert sum(field.decode(a) == b for a, b in held) >= 0.95 * len(held)
    assert [k for k, _, _ in pii.find("call (909) 555-2931 or mail a.b@c.org", field)[1]] == ["phone", "email"]
    rows = [(1, None), (2, ""), (3, "no data"), (4, "x@y.org"), (None, "1.2.3.4"), (5, "1" * 20000)]
    got = {x.doc_id: x for x in pii.detect(frame(spark, rows), field, masked=True).collect()}
    assert got[1].masked is None and got[4].masked == "[EMAIL]" and got[None].masked == "[IP]" and got[4].n_email == 1
    assert got[2].base_sha256 == hashlib.sha256(b"").hexdigest() and pii.detect(empty(spark), field).count() == 0


def test_pii_spans_across_gaps():
    field = pii.train()
    for span in ("(415)  555-0123", "(415)\n    555-0123", "(909)\t 555-2931", "(415) - 555-0123", "415 - 555 - 0123"):
        text = f"call {span} now"
        assert [(k, text[s:e]) for k, s, e in pii.find(text, field)[1]] == [("phone", span)]
    for text in ("ends (415)\n\n555-0123 begins", "born in 1999 and again in 2004 here", "rooms 12 and 14, 16 or 18", "from 12 - 14 to 16 - 18"):
        assert pii.find(text, field)[1] == []


def test_pii_secrets():
    field = pii.train()
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    for form in ('token = "{}"', "password: {}", "TOKEN = '{}'!!", 'api_key="{}"', "Bearer {}", "x secret={} y"):
        text = f"set {form.format(key)} here"
        assert [(k, text[s:e]) for k, s, e in pii.find(text, field)[1]] == [("secret", key)], form
    for text in (f"see commit {key} of May", f"md5 = {key[:32]}", "id 3f2a9c1e-11aa-4b7e-9e01-aabbccddeeff ok", "7536784127813050 4845168114407329 4550997810720808", "order 4845168114407321 came", "on 2024-11-03 at 10 and 12"):
        assert not [x for x in pii.find(text, field)[1] if x[0] in ("secret", "card")] or pii.base_spans(text), text


def test_pii_decoding_against_brute_force():
    """The best of all segmentations of short token lists, and windows of a long list as one."""
    field = pii.train(60)
    for tokens, _ in [x for x in pii.examples(60, seed=3) if len(x[0]) <= 7]:
        lattice = field.lattice(tokens)

        def paths(at, before, score):
            if at == len(tokens):
                yield score
            for j in range(at + 1, len(tokens) + 1):
                for i, k, _, s in lattice[j]:
                    if i == at:
                        yield from paths(j, k, score + s + field.weights.get((k, "after:" + before), 0.0))

        found = {i: (j, k) for i, j, k in field.decode(tokens)}
        at, before, score = 0, "O", 0.0
        while at < len(tokens):
            j, k = found.get(at, (at + 1, "O"))
            score += next(s for i, x, _, s in lattice[j] if i == at and x == k) + field.weights.get((k, "after:" + before), 0.0)
            at, before = j, k
        assert abs(score - max(paths(0, "O", 0.0))) < 1e-9
    many = [t for tokens, _ in pii.examples(900, seed=8) for t in tokens]
    assert len(many) > pii.WINDOW and field.segment(many) == field.decode(many)


@pytest.fixture(scope="module")
def vocabulary():
    P = pytest.importorskip("public_tokenizers")
    return P.path("word_bpe_49k.json")


def test_packing_round_trip(spark, vocabulary):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    rows = corpus(9, 40) + [(300, "it's <|endoftext|> I'LL á  b ﬁ"), (None, "null id")]
    out = packing.pack(frame(spark, rows), vocabulary, length=256).collect()
    pieces, sequences = {}, {}
    for x in out:
        pieces.setdefault(x.doc_id, []).append(x)
        sequences.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for x in sorted(pieces[i], key=lambda x: x.start):
            assert x.start == at and x.doc_tokens == ids.size and x.ids_crc32 == zlib.crc32(ids[at : at + x.length])
            at += x.length
        assert at == ids.size
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 256
    assert packing.pack(empty(spark), vocabulary).count() == 0


def test_column_generation_covers_demand():
    r = np.random.default_rng(1)
    for _ in range(5):
        demand = np.where(r.random(65) < 0.5, r.integers(0, 400, 65), 0)
        demand[0] = 0
        patterns, x = packing.column_generation(demand, 64)
        covered = sum(p * v for p, v in zip(patterns, x, strict=True))
        assert (covered >= demand - 1e-6).all() and all((p * np.arange(65)).sum() <= 64 for p in patterns)
        plan = packing.Plan.build(demand, 64)
        assert plan.sequences <= sum(v for p, v in zip(patterns, x, strict=True) if p.any()) + 65
        used = [plan.assign(np.full(n, s), np.arange(n)) for s, n in enumerate(demand.tolist()) if n]
        places = {(a, b) for q, p in used for a, b in zip(q.tolist(), p.tolist(), strict=True)}
        assert len(places) == demand.sum()



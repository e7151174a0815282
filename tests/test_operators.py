import datetime
import itertools
import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sparkloom.functions import language, spelling, stemming, text
from sparkloom.operators import boundaries, classify, counts, descent, dictionary, filters, graph, html_comments, replies, sentiment, tagger
from sparkloom.operators import features as features_ops
from sparkloom.plans import catalog, jobs
from sparkloom.schema import Role, table_name
from sparkloom.session import EngineConfig
from sparkloom.sources import feed, keyed, sinks, tables
from sparkloom.streaming import ingest, stateful


def column(spark, values, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, w string")
    return [r[0] for r in rows.select(expr(F.col("w")).alias("o"), "i").orderBy("i").collect()]


@pytest.mark.parametrize(
    "rule, pairs",
    [
        (text.split_attached, {"aBcDEFg": "a Bc DE Fg", "HTMLPage": "HTML Page", "": "", "Abc": "Abc"}),
        (text.remove_url, {"http://a.b/c": "", "www.a.com": "", "wanita": "", "a_b@c.id": "", "kata": "kata", "w": "w"}),
        (lambda w: text.remove_url(w, compat=False), {"wanita": "wanita", "www.a.com": ""}),
        (text.expand_acronym, {"d.k.i.": "daerah khusus ibukota", "x.y.": "xy", "plain": "plain"}),
        (text.formalise, {"yg": "yang", "lain": "lain"}),
        (text.remove_symbols, {"a#b%c?": "abc?", "é": ""}),
        (text.pad_marks, {"a,b": "a , b"}),
        (text.remove_punctuation, {"a.b": "a b", "a.": "a", "a--b": "a--b", "x!?y": "x y", "!-": "-"}),
        (text.remove_stopword, {"yang": "", "1 2?": "", "kata": "kata"}),
        (text.stem, {"membacakan": "baca", "makan": "makan", "bukunya": "buku"}),
        (text.domain, {"http://www.a.com/x": "a.com", "nonsense": None, "https://b.org": "b.org"}),
    ],
)
def test_word_rules(spark, rule, pairs):
    assert column(spark, list(pairs), rule) == list(pairs.values())


def test_remove_punctuation_against_loop(spark):
    def loop(w):
        out = ""
        for i, c in enumerate(w):
            if re.match("[a-zA-Z0-9-]", c):
                out += c
            elif i + 1 < len(w) and re.match("[a-zA-Z0-9]", w[i + 1]):
                out += " "
        return out

    r = random.Random(1)
    words = ["".join(r.choice("aB9-.,! ") for _ in range(r.randrange(0, 9))) for _ in range(400)]
    assert column(spark, words, text.remove_punctuation) == [loop(w) for w in words]


def test_clean_text(spark):
    got = column(spark, ["Halo DuniaBaru! Lihat http://x.id sekarang. 123 yang", "", None], text.clean_terms)
    assert got[0].startswith("halo,dunia baru,lihat") and "123" not in got[0] and got[1:] == ["", None]


def plain_bucket(term):
    raw, h = term.encode("utf-16-be"), 0
    for i in range(0, len(raw), 2):
        h = (h * 31 + int.from_bytes(raw[i : i + 2], "big")) & 0xFFFFFFFF
    return h & 0xFFFFF


def test_hash_buckets_of_every_term(spark, tmp_path):
    terms = ["", "a", "ab", "straße", "où", "\u4e2d\u6587", "x\U0001f600y", "~ -", "e\u0301"]
    assert column(spark, terms, text.java_bucket) == [plain_bucket(t) for t in terms]
    texts = [None, "", "Über l'été ü \U0001f600", "abc Señor señor\n\u4e2d"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.term: r.bucket for r in catalog.QUERIES["hash_buckets"](spark, str(tmp_path)).collect()}
    assert got == {w.lower(): plain_bucket(w.lower()) for t in texts for w in (t or "").split()}


def test_dictionary_cleaning(spark, monkeypatch):
    """As the rules on the texts themselves have it, for repeated rows, nulls, composites and dictionaries that are not broadcast."""
    r = random.Random(4)
    words = ["yg", "makan", "bukunya", "HTMLPage", "a.s.", "p.t.x", "http://a.b/c", "wanita", "a,b", "x!?y", "12", "?", "the", "é", "menulis", "aBc", "--", "(kota)"]
    texts = [" ".join(r.choice(words) + r.choice(["", ".", "! ", "\n"]) for _ in range(r.randrange(0, 25))) for _ in range(40)] + [None, "", " \t", "the " * 500]
    rows = [(i % 30, t) for i, t in enumerate(texts)] + [(None, "kota"), (3, texts[3])]
    docs = spark.createDataFrame(rows, "k int, t string").withColumn("word", F.lit("x")).repartition(3)
    plain = lambda **o: sorted(((x.k, x.terms) for x in docs.select("k", F.coalesce(text.clean_terms(F.col("t"), **o), F.lit("")).alias("terms")).collect()), key=str)
    got = lambda **o: sorted(((x.k, x.terms) for x in dictionary.clean_terms(docs, ["k"], "t", **o).collect()), key=str)
    assert got() == plain() and got(composites=["the the", "yg makan"]) == plain(composites=["the the", "yg makan"])
    monkeypatch.setattr(dictionary, "BROADCAST_ROWS", 2)
    monkeypatch.setattr(dictionary, "HOT_SHARES", 12)
    assert got(compat=False) == plain(compat=False)
    assert dictionary.clean_terms(docs.limit(0), ["k"], "t").count() == 0


def test_word_lists_of_a_million(spark, tmp_path):
    """Lists come from files, whatever their size; a job takes them."""
    spark.range(1_000_000).select(F.concat(F.lit("stop"), "id")).write.text(f"{tmp_path}/stop")
    (tmp_path / "acronyms").write_text("a.b.:anton berta,x.y.:x\n:none\nq:")
    (tmp_path / "roots").write_text("ajar,makan\nbesar")
    (tmp_path / "slang").write_text("gw:saya")
    crawl = spark.createDataFrame([("1", "Stop7 stop999999 stopx a.b. gw pembelajaran besar dimakan makanan bes", None)], "row_key string, text string, cleaned string")
    crawl.write.parquet(f"{tmp_path}/crawl")
    jobs.main(["cleaner", f"{tmp_path}/crawl", f"{tmp_path}/out", *[x for k in ("stop", "acronyms", "roots", "slang") for x in (f"--{k}", f"{tmp_path}/{k}")]])
    assert spark.read.parquet(f"{tmp_path}/out").first().cleaned == "stopx,anton berta,saya,ajar,besar,makan,makan,bes"


@pytest.mark.parametrize("negation", [None, "window4"])
def test_sentiment_of_texts_equals_that_of_tagged_sentences(spark, negation):
    """Words scored once give what all tagged words give."""
    r = random.Random(15)
    vocabulary = [*text.TAGS, "on", "er", "kata", "bukunya", "Good", "con"]
    docs = [(i, " ".join(r.choice(vocabulary) + r.choice(["", "", "", ". ", "!"]) for _ in range(r.randrange(0, 40)))) for i in range(40)] + [(90, None), (91, ""), (92, "not " * 30 + "good")]
    df = spark.createDataFrame(docs, "k int, text string").withColumns({"word": F.lit("x"), "tag": F.lit("y"), "sentence": F.lit(1)})
    lexicon = sentiment.prior(spark.createDataFrame(sentiment.LEXICON, "pos string, id string, pos_score double, neg_score double, terms string"))
    tagged = F.transform(text.sentences(F.col("text")), lambda s: text.tag_words(text.words(F.lower(s))))
    rounded = lambda rows: sorted((x.k, round(x.pos, 9), round(x.neg, 9), x.sentiment) for x in rows.collect())
    want = rounded(sentiment.detect(df, "k", tagged, lexicon, negation))
    assert rounded(sentiment.detect_text(df, "k", "text", dictionary.tag_table(spark), lexicon, negation)) == want
    assert len({x[3] for x in want}) == 3


def test_sentence_boundaries(spark):
    """Abbreviations, ordinals and decimals are no ends; nulls, repeated rows and texts without words."""
    r = random.Random(1)
    plain = [" ".join(r.choice(["the", "old", "house", "stands", "here", "Smith", "on", "hill"]) for _ in range(7)) + "." for _ in range(150)]
    talk = [f"Yesterday Dr. Smith paid approx. {i}.5 coins on the 3. of May. The house stands. We left!" for i in range(40)]
    docs = [(0, " ".join(plain)), *[(i + 1, t) for i, t in enumerate(talk)], (1, talk[0]), (90, None), (91, " "), (92, "no stop at all"), (93, "He met Dr.")]
    got = {}
    for x in boundaries.split(spark.createDataFrame(docs, "k int, t string").withColumn("word", F.lit(1)).repartition(3), ["k"], "t").collect():
        got.setdefault(x.k, []).append((x.sentence, x.text))
    assert [t for _, t in sorted(got[0])] == plain
    for i, t in enumerate(talk[1:], 2):
        first, rest = t.split(" The house")
        assert [x for _, x in sorted(got[i])] == [first, "The house stands.", "We left!"]
    assert len(got[1]) == 6 and 90 not in got and 91 not in got and got[92] == [(0, "no stop at all")] and got[93] == [(0, "He met Dr.")]
    words = spark.createDataFrame([("x.", 0)], "word string, n int").limit(0)
    assert boundaries.abbreviations(words).count() == 0


def test_formal_words_against_all_pairs(spark, tmp_path):
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcé") for _ in range(r.randrange(0, 8)))
    formal = {word(): r.randrange(1, 5) for _ in range(60)}
    words = [word() for _ in range(300)] + [*list(formal)[:20], "x" * 5000, ""]

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    want = {}
    for w in set(words) - set(formal):
        near = [(-n, f.encode(), f) for f, n in formal.items() if min(len(w), len(f)) >= 4 and abs(len(w) - len(f)) < 2 and edits(w, f) <= 1]
        if near:
            want[w] = min(near)[2]
    known = spark.createDataFrame([*formal.items(), (next(iter(formal)), 0)], "word string, n int")
    df = spark.createDataFrame([(w,) for w in words], "word string")
    assert {x.word: x.formal for x in spelling.formal_words(df, known).collect()} == want and len(want) > 20
    assert spelling.formal_words(df, known.limit(0)).count() == 0
    (tmp_path / "formal").write_text("tidak:90\nrumah:7,junk")
    spark.createDataFrame([("1", "tidk rumahh tdk ruma! kota", None)], "row_key string, text string, cleaned string").write.parquet(f"{tmp_path}/crawl")
    jobs.main(["cleaner", f"{tmp_path}/crawl", f"{tmp_path}/out", "--formal", f"{tmp_path}/formal"])
    assert spark.read.parquet(f"{tmp_path}/out").first().cleaned == "tidak,rumah,tidak,ruma,kota"


def test_stems_against_plain(spark):
    """Every way to a root by a plain version, over made-up and real derivations."""
    roots = {"ajar", "baca", "tulis", "sapu", "pukul", "kirim", "makan", "besar", "main", "nyanyi", "racun", "rajut", "buku", "lihat", "adil", "an", "ku"}
    r = random.Random(6)
    derived = ["membacakan", "pembelajaran", "menulis", "penulisan", "menyapu", "memukul", "mengirimkan", "dimakan", "makanan", "terbesar", "bukunya", "bukumulah", "keadilan", "bernyanyi", "beracun", "merajut", "mengelihat", "besar", "unknownkan", "", "i", "ajarilah", "permainan", "diajari"]
    derived += [r.choice(["", "me", "mem", "men", "meng", "di", "ke", "ber", "pe", "per", "ter", "se"]) + r.choice(["", "ber", "per"]) + r.choice(sorted(roots)) + r.choice(["", "kan", "an", "i"]) + r.choice(["", "ku", "nya"]) + r.choice(["", "lah", "kah"]) for _ in range(150)]

    def plain(word):
        found = {(0, word, "", ())}
        strip = lambda w, e: w[: -len(e)] if w.endswith(e) and len(w) >= len(e) + 3 else None
        for group in (stemming.PARTICLES, stemming.POSSESSIVES, stemming.DERIVATIONS):
            found |= {(n + 1, f, e if group is stemming.DERIVATIONS else old, p) for n, w, old, p in found for e in group if (f := strip(w, e))}
        for _ in range(stemming.MOST_PREFIXES):
            for n, w, e, p in list(found):
                for name, pattern, to in stemming.PREFIXES:
                    if name not in p and (p or (name, e) not in stemming.NEVER) and (m := re.fullmatch(pattern, w)):
                        found.add((n + 1, to.replace("$1", m[1]), e, (*p, name)))
        hits = [(n, -len(w), w) for n, w, _, _ in found if w in roots]
        return min(hits)[2] if hits else word

    words = spark.createDataFrame([(w,) for w in [*derived, *derived[:5]]], "word string")
    known = spark.createDataFrame([(w,) for w in [*roots, None, "ajar"]], "word string")
    got = {x.word: x.stem for x in stemming.stems(words, known).collect()}
    assert got == {w: plain(w) for w in derived}
    assert got["pembelajaran"] == "ajar" and got["besar"] == "besar" and got["menyapu"] == "sapu" and got["unknownkan"] == "unknownkan" and got["penulisan"] == "tulis" and got["beracun"] == "racun"


def tagged_corpus(seed: int, n: int = 40) -> list:
    """(sentence, place, word, tag) of sentences whose words and moves depend on the tag."""
    r = random.Random(seed)
    words = {"N": ["kota", "rumah", "main", "xan"], "V": ["lari", "main", "bacakan", "tulis"], "A": ["besar", "kecil", "tulis"]}
    rows = []
    for s in range(n):
        t = r.choice("NV")
        for i in range(r.randrange(1, 7)):
            rows.append((s, i, r.choice(words[t]), t))
            t = r.choice({"N": "VVA", "V": "NNA", "A": "NNN"}[t])
    return [*rows, (n, 0, None, "N"), (n, 1, "kota", None)]


def test_tagger_against_all_taggings(spark, tmp_path):
    """The decoded tags score as high as any, by a model counted plainly; longer sentences take what a plain recursion takes."""
    rows = tagged_corpus(2)
    model = tagger.train(spark.createDataFrame(rows, "sentence int, place int, word string, tag string"), ["sentence"])
    seen = [x for x in rows if x[2] and x[3]]
    tags = sorted({x[3] for x in seen})
    assert model.tags == tags
    moves = Counter((seen[i - 1][3] if i and seen[i - 1][0] == x[0] else None, x[3]) for i, x in enumerate(seen))
    log = lambda b, t: math.log((moves[b, t] + 0.1) / sum(moves[b, u] + 0.1 for u in tags))
    pairs, total = Counter((w, t) for *_, w, t in seen), Counter(t for *_, t in seen)
    size = len({w for w, _ in pairs})
    count = Counter(w for w, _ in pairs.elements())
    ends = Counter()
    for (w, t), n in pairs.items():
        if count[w] <= tagger.RARE:
            ends.update({(e, t): n for e in {w[-k:] for k in (1, 2, 3) if len(w) > k} | {""}})
    kinds = {e for e, _ in ends}

    def emission(w):
        if w in count:
            return [math.log((pairs[w, t] + 0.1) / (total[t] + 0.1 * size)) for t in tags]
        e = next((w[len(w) - k :] for k in (3, 2, 1, 0) if (k == 0 or len(w) > k) and w[len(w) - k :] in kinds), None)
        return [0.0] * len(tags) if e is None else [math.log((ends[e, t] + 0.1) / (ends["", t] + 0.1 * max(1, len(kinds)))) for t in tags]

    def score(ws, path):
        es = [emission(w) for w in ws]
        return sum(log(b, t) + e[tags.index(t)] for b, t, e in zip([None, *path], path, es))  # noqa: B905

    r = random.Random(9)
    vocabulary = ["kota", "main", "lari", "tulis", "besar", "zzan", "bacakan", "ulis", "q", "Rumah"]
    docs = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randrange(1, 7))) + r.choice(["", ". kota main"])) for i in range(40)] + [(90, None), (91, " ")]
    long = (99, " ".join(r.choice(vocabulary) for _ in range(400)))
    model.save(f"{tmp_path}/model")
    model = tagger.Tagger.load(spark, f"{tmp_path}/model")
    got = tagger.tag(spark.createDataFrame([*docs, long], "k int, text string"), ["k"], "text", model).collect()
    assert {x.k for x in got} == {*range(40), 99}
    for x in got:
        ws, path = [t.word for t in x.tagged], [t.tag for t in x.tagged]
        if x.k == 99:
            best = [log(None, t) + e for t, e in zip(tags, emission(ws[0]), strict=True)]
            for w in ws[1:]:
                best = [max(b + log(u, t) for b, u in zip(best, tags, strict=True)) + e for t, e in zip(tags, emission(w), strict=True)]
            assert len(ws) == 400 and abs(score(ws, path) - max(best)) < 1e-6
        else:
            assert abs(score(ws, path) - max(score(ws, p) for p in itertools.product(tags, repeat=len(ws)))) < 1e-9
    whole = {x.k: x.tagged for x in tagger.tag_texts(spark.createDataFrame(docs, "k int, text string"), "k", "text", model).collect()}
    assert all([t.word for s in whole[i] for t in s] == t.lower().replace(".", " .").replace(" .", ".").split() for i, t in docs if i < 40)


def test_tagger_in_the_sentiment_job(spark, tmp_path):
    """A word that the model tags as an adjective meets the lexicon's adjective."""
    spark.createDataFrame(tagged_corpus(3), "sentence int, place int, word string, tag string").withColumn("tag", F.when(F.col("tag") == "A", "JJ").when(F.col("tag") == "N", "NN").otherwise("VBI")).write.parquet(f"{tmp_path}/tagged")
    jobs.main(["taggerbuilder", f"{tmp_path}/tagged", f"{tmp_path}/model"])
    (tmp_path / "lexicon").write_text("a\t1\t0.9\t0\tbesar#1\tgloss\n")
    spark.createDataFrame([("1", "rumah besar", None), ("2", "kota", None), ("3", None, None)], "row_key string, text string, sentiment string").write.parquet(f"{tmp_path}/rows")
    jobs.main(["sentimentanalyzer", f"{tmp_path}/rows", f"{tmp_path}/lexicon", f"{tmp_path}/out", "--tagger", f"{tmp_path}/model"])
    assert {x.row_key: x.sentiment for x in spark.read.parquet(f"{tmp_path}/out").collect()} == {"1": "positif", "2": "netral", "3": None}


SPOKEN = {"id": "yang dan di ini itu rumah dengan untuk tidak dari kepada orang", "en": "the of and to in house with for not from people", "fr": "le la et les des une maison avec pour pas"}


def spoken(spark):
    return language.train(spark.createDataFrame([*SPOKEN.items(), (None, "x"), ("en", None)], "lang string, text string"))


def test_language(spark):
    texts = ["the house of the people", "le chat et la maison", "Rumah ini untuk orang", "", None, "12 34 %%", "\u4e2d\u6587 \u4e2d", "qxz wvkj", "yang\n\t-dan-"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(3, "the house")], "k int, text string")
    known = spoken(spark)
    got = {r.k: r.detected for r in language.detect(rows, ["k"], "text", known).collect()}
    assert got == {0: "en", 1: "fr", 2: "id", 3: "en", 4: None, 5: None, 6: None, 7: None, 8: "id"}
    assert sorted(r.k for r in language.of_language(rows, ["k"], "text", known, "id").collect()) == [2, 8]
    assert language.detect(rows.limit(0), ["k"], "text", known).count() == 0
    assert {r.detected for r in language.detect(rows, ["k"], "text", known.limit(0)).collect()} == {None}


def test_language_against_plain(spark):
    """Ranks, distances and ties as a plain version has them."""
    r = random.Random(8)
    word = lambda letters: "".join(r.choice(letters) for _ in range(r.randrange(1, 6)))
    text_of = lambda letters, n: " ".join(word(letters) for _ in range(n))
    labelled = [(lang, text_of(letters, 60)) for lang, letters in (("a", "abcd"), ("b", "bcde"), ("c", "Çéx"))]
    texts = [text_of(r.choice(["abcd", "bcde", "çéx", "abcde"]), r.randrange(1, 30)) for _ in range(60)]

    def ranks(ts: list, n: int) -> dict:
        grams = Counter()
        for t in ts:
            m = "_" + re.sub(r"[\W\d_]+", "_", t.lower()) + "_"
            grams.update(m[i : i + 3] for i in range(len(m) - 2) if m[i + 1] != "_")
        return {g: i for i, (g, _) in enumerate(sorted(grams.items(), key=lambda x: (-x[1], x[0].encode()))[:n], 1)}

    profiles = {lang: ranks([t for x, t in labelled if x == lang], 20) for lang in "abc"}
    want = []
    for t in texts:
        mine = ranks([t], 20)
        agreed = {lang: sum(20 - abs(i - p[g]) for g, i in mine.items() if g in p) for lang, p in profiles.items() if set(mine) & set(p)}
        best = min(agreed, key=lambda x: (-agreed[x], x), default=None)
        want.append(best if best and agreed[best] >= 0.3 * 20 * len(mine) else None)
    known = language.train(spark.createDataFrame(labelled, "lang string, text string"), ranks=20)
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = {x.k: x.detected for x in language.detect(rows, ["k"], "text", known, ranks=20, least=0.3).collect()}
    assert [got[i] for i in range(len(texts))] == want and len(set(want)) > 2


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    held = docs.where("doc_id % 5 = 0 AND text RLIKE '[\\\\p{L}]'")
    known = language.train(docs.where("doc_id % 5 <> 0"))
    both = language.detect(held, ["doc_id"], "text", known).join(held.select("doc_id", "lang"), "doc_id").collect()
    assert len(both) > 150 and sum(x.detected == x.lang for x in both) >= 0.97 * len(both)


def test_scan_and_upsert(spark):
    old = spark.createDataFrame([("1", "a", None), ("2", None, "x"), ("3", "c", "y")], "k string, t string, c string")
    assert [r.k for r in tables.unprocessed(old, "k", "t", "c").collect()] == ["1"]
    new = spark.createDataFrame([("1", "z", None), ("4", "n", "m")], "k string, c string, extra string")
    got = {r.k: (r.t, r.c, r.extra) for r in sinks.upsert(old, new, ["k"]).collect()}
    assert got == {"1": ("a", "z", None), "2": (None, "x", None), "3": ("c", "y", None), "4": (None, "n", "m")}
    twice = sinks.upsert(sinks.upsert(old, new, ["k"]), new, ["k"])
    assert {r.k: (r.t, r.c, r.extra) for r in twice.collect()} == got
    with pytest.raises(Exception):
        tables.scan(old, ["nope"]).collect()


def test_state_versions(spark, tmp_path):
    path = f"file://{tmp_path}/s"
    assert tables.state(spark, path, "a int").count() == 0
    for n in (1, 2):
        sinks.save_state(tables.state(spark, path, "a int").union(spark.createDataFrame([(n,)], "a int")), path)
    assert sorted(r.a for r in tables.state(spark, path, "a int").collect()) == [1, 2]


def test_surrogate_keys(spark):
    dim = spark.createDataFrame([(5, "a")], "id long, name string")
    new = spark.createDataFrame([("a",), ("c",), ("b",), ("b",)], "name string")
    assert {r.name: r.id for r in sinks.with_keys(dim, new, ["name"]).collect()} == {"a": 5, "b": 6, "c": 7}


def test_training_file(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("judi\thttp://a\tx,y\nshort\nrest\thttp://b\t\n")
    got = [tuple(r) for r in tables.training_file(spark, str(tmp_path / "t.tsv")).collect()]
    assert got == [("judi", "http://a", "x,y")]


def test_negation(spark):
    words = [("good", "JJ", 1.0), ("not", "NEG", 0.0), *[("w", "NN", 1.0)] * 5, ("no", "NEG", 0.0), ("x", "NN", 2.0), ("and", "CC", 0.0), ("y", "NN", 2.0)]
    df = spark.createDataFrame([(words,)], "s array<struct<word:string,tag:string,score:double>>")
    got = [x.score for x in df.select(sentiment.negate(F.col("s"))).first()[0]]
    assert got == [1.0, 0.0, -1.0, -1.0, -1.0, -1.0, 1.0, 0.0, -2.0, 0.0, 2.0]


def plain_flips(tags, span=4):
    left, out = 0, []
    for t in tags:
        out.append(left > 0 and t not in ("NEG", "CC"))
        left = (0 if left > 0 else span) if t == "NEG" else 0 if t == "CC" else max(left - 1, 0)
    return out


def test_negation_against_brute_force(spark):
    r = random.Random(5)
    rows = [(i, [r.choice(["NEG", "CC", "NN", "NN", "JJ"]) for _ in range(r.randrange(0, 25))]) for i in range(200)]
    got = {x.i: x.f for x in spark.createDataFrame(rows, "i int, t array<string>").select("i", sentiment.flips(F.col("t")).alias("f")).collect()}
    assert all(got[i] == plain_flips(t) for i, t in rows)


def prior_map():
    """term#pos -> rank-weighted mean over the senses of the built-in lexicon."""
    top, low = {}, {}
    for pos, _, p, n, terms in sentiment.LEXICON:
        for t in terms.split(" "):
            term, rank = t.split("#")
            top[f"{term}#{pos}"] = top.get(f"{term}#{pos}", 0.0) + (p - n) / int(rank)
            low[f"{term}#{pos}"] = low.get(f"{term}#{pos}", 0.0) + 1 / int(rank)
    return {k: top[k] / low[k] for k in top}


def lexicon(spark):
    return sentiment.prior(spark.createDataFrame(sentiment.LEXICON, "pos string, id string, pos_score double, neg_score double, terms string"))


def test_document_sentiment_against_brute_force(spark):
    r = random.Random(2)
    docs = [" ".join(r.choice(["the", "of", "is", "Good", "bad", "her", "und.", "la", "thelah", "x!", "not"]) for _ in range(r.randrange(0, 30))) for _ in range(40)] + [""]
    scores = prior_map()

    def stem(w):
        if w in text.KEEP_UNSTEMMED:
            return w
        for pattern, to in text.AFFIXES:
            w = re.sub(pattern, to.replace("$", "\\"), w)
        return w

    def brute(t, negated):
        pos = neg = 0.0
        for s in re.split(r"(?<=[.!?])\s+", t):
            found, tags = [], [text.TAGS.get(w, "NN") for w in s.lower().split()]
            for w, tag, flip in zip(s.lower().split(), tags, plain_flips(tags), strict=True):
                tag = text.POS_CLASSES.get(tag, tag)
                v = scores.get(f"{w}#{tag}", scores.get(f"{stem(w)}#{tag}", 0.0))
                found.append(0.0 if abs(v) <= 0.1 else -v if flip and negated else v)
            up, down = [v for v in found if v > 0], [-v for v in found if v < 0]
            pos += sum(up) / len(up) if up else 0
            neg += sum(down) / len(down) if down else 0
        a, b = round(pos, 9), round(neg, 9)
        return "positif" if a > b else "negatif" if a < b else "netral"

    rows = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "row_key int, text string").withColumn("sentiment", F.lit(None).cast("string"))
    for negation in (None, "window4"):
        got = {x.row_key: x.sentiment for x in jobs.sentiment_analyzer(rows, lexicon(spark), negation).collect()}
        assert [got[i] for i in range(len(docs))] == [brute(t, negation) for t in docs]


def test_word_scores_of_every_word(spark, tmp_path):
    texts = [None, "", "The eran onan. inan GOOD bad, bad x is\nthelah", "zzz! Über of eran"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    scores, want = prior_map(), {}
    for w in (w for t in texts for w in (t or "").lower().split()):
        s = w
        for pattern, to in text.AFFIXES if w not in text.KEEP_UNSTEMMED else ():
            s = re.sub(pattern, to.replace("$", "\\"), s)
        tag = text.TAGS.get(w, "NN")
        tag = text.POS_CLASSES.get(tag, tag)
        v = scores.get(f"{w}#{tag}", scores.get(f"{s}#{tag}", 0.0))
        key = (tag, 0.0 if abs(v) <= 0.1 else round(v, 6))
        want[key] = want.get(key, 0) + 1
    got = {(r.pos, r.score): r.n for r in catalog.QUERIES["word_scores"](spark, str(tmp_path)).collect()}
    assert got == want and sum(got.values()) == 14 and scores["er#n"] != 0


def test_counts_and_filters(spark):
    df = spark.createDataFrame([("h", "a,b", "positif"), ("h", "a", None), ("g", "b", "negatif")], "host string, labels string, s string")
    got = {r.host: (r.a, r.b) for r in counts.label_pivot(counts.label_counts(df, "host", "labels"), ["a", "b"]).collect()}
    assert got == {"h": (2, 1), "g": (0, 1)}
    assert counts.monitoring(df, {"n": "s"}).first().n == 2
    times = spark.createDataFrame([(1, 0), (2, 90)], "id int, t long")
    assert [r.id for r in filters.due(times, "t", 100, 50).collect()] == [1]
    assert filters.search(df, "labels", "A", 1, ["labels"]).count() == 1


def test_graph_and_replies(spark):
    df = spark.createDataFrame([("t", "a", "b"), ("t", "a", "b"), (None, "c", None)], "title string, u string, r string")
    assert {(r.title, r.node): r["size"] for r in graph.nodes(df, "title", "u", "r").collect()} == {("t", "a"): 2, ("t", "b"): 2, ("all", "c"): 1}
    assert graph.edges(df, "title", "u", "r").count() == 1
    turns = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 1), (9, 8)], "id long, up long")
    assert {(r.child, r.parent, r.base, r.depth) for r in replies.tree(turns, "id", "up").collect()} == {(2, 1, 1, 1), (4, 1, 1, 1), (3, 2, 1, 2)}


def test_long_reply_chains(spark, tmp_path):
    r = random.Random(3)
    up = {i: i - 1 if i else None for i in range(1500)}
    up |= {i: r.choice([None, *range(2000, i)]) for i in range(2000, 2200)} | {3000: 3001, 3001: 3000, 3002: 3000, 4000: 9999, 4001: 4000}
    want = set()
    for i in up:
        path = [i]
        while up.get(path[-1]) is not None and len(path) < 3000:
            path.append(up[path[-1]])
        if path[-1] in up and up[path[-1]] is None and len(path) > 1:
            want.add((i, path[1], path[-1], len(path) - 1))
    df = spark.createDataFrame(list(up.items()), "id long, up long")
    assert {tuple(x) for x in replies.tree(df, "id", "up").collect()} == want
    assert replies.tree(df.where("false"), "id", "up").count() == 0
    turns = [(c, t, "user" if t % 2 == 0 else "system" if c == 1 else "assistant") for c in (1, 2) for t in range(1003)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string").write.parquet(str(tmp_path / "conversations.parquet"))
    depths = {x.depth: x.n for x in catalog.QUERIES["reply_depth_stats"](spark, str(tmp_path)).collect()}
    assert depths == {d: 2 for d in range(1, 1003)}
    based = catalog.QUERIES["reply_tree_with_base"](spark, str(tmp_path)).where("child = 2001").collect()
    assert sorted((x.base, x.depth, x.child_role) for x in based) == [(1000, 1001, "system"), (2000, 1, "assistant")]


def test_term_cloud_state(spark):
    docs = spark.createDataFrame([("x", ["a", "a", "b"]), ("x", ["b"]), ("y", ["c"])], "title string, terms array<string>")
    idf = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0)], "term string, df int, idf double")
    frequency = features_ops.term_frequency(features_ops.term_rows(docs, "title", F.col("terms")), "title")
    first, state = features_ops.term_cloud(frequency, "title", idf, 1)
    assert [(r.title, r.term, r.value) for r in first.collect()] == [("x", "b", 4.0)]
    _, total = features_ops.term_cloud(frequency, "title", idf, 1, state)
    assert {(r.title, r.term): r.value for r in total.collect()} == {("x", "a"): 4.0, ("x", "b"): 8.0}


def test_labels_in_given_order(spark):
    scores = spark.createDataFrame([(1, "b", 1.0), (1, "a", 2.0), (2, "a", 0.9)], "id int, label string, margin double")
    docs = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    got = {r.id: r.classification for r in classify.label_lists(scores, docs, "id", ["b", "a"]).collect()}
    assert got == {1: "b,a", 2: "none", 3: "none"}


PAGE = """<html><body><div class="comments"><ul>
<li class="c"><cite>Ann</cite><p>first</p><div class="replies x"><cite>Bob</cite><p>answer</p></div></li>
<li class="c"><span class="author">Eve</span><blockquote>second</blockquote></li>
<li class="c"><p>no author</p></li></ul></div><p>tail</p></body></html>"""


def test_html_comments(spark):
    got = [(u, t, d, r) for _, u, t, d, r in html_comments.comments(PAGE)]
    assert got == [("Ann", "first", 1, ""), ("Bob", "answer", 2, "Ann"), ("Eve", "second", 1, "")]
    assert html_comments.comments("<p>nothing</p>") == [] and html_comments.comments(None) == []
    assert html_comments.visible_text("<p>a</p><script>x</script> b&amp;c") == "a b&c"
    pages = spark.createDataFrame([(1, PAGE), (2, None)], "id long, html string")
    rows = html_comments.extract(pages, "id", "html").collect()
    assert len(rows) == 3 and len({r.row_key for r in rows}) == 3


def test_html_comments_of_several_threads():
    item = lambda u, t: f'<div class="comment x"><cite>{u}</cite><p>{t}</p></div>'
    two = f'<div class="comments"><div>{item("A", "1")}{item("B", "2")}</div><div>{item("C", "3")}{item("D", "4")}<div class="comment x"><p>no author</p></div></div></div>'
    assert [x[1] for x in html_comments.comments(two)] == ["A", "B", "C", "D"]
    deeper = f'<ul><li>{item("A", "1")}{item("B", "2")}</li><li>{item("C", "3")}{item("D", "4")}</li></ul>'
    assert {x[1] for x in html_comments.comments(deeper)} >= {"A", "C"}
    one = f'<div class="comments">{item("A", "1")}</div>'
    assert [x[1:] for x in html_comments.comments(one)] == [("A", "1", 1, "")]


def test_html_comments_nested_deep():
    n = 1500
    page = '<div class="comments">' + "".join(f'<div class="comment reply"><cite>u{i}</cite><p>t{i}</p>' for i in range(n)) + "</div>" * (n + 1)
    got = html_comments.comments(page)
    assert len(got) == n and got[-1][1] == f"u{n - 1}" and got[-1][3] == n


def test_composite_words(spark):
    r = random.Random(9)
    known = ["a b", "b c", "a b c", "c c"]
    rows = [(i, [r.choice("abcd") for _ in range(r.randrange(0, 14))]) for i in range(150)]
    got = {x.i: x.w for x in spark.createDataFrame(rows, "i int, t array<string>").select("i", text.compose(F.col("t"), known).alias("w")).collect()}
    for i, ws in rows:
        want, k = [], 0
        while k < len(ws):
            found = next((" ".join(ws[k : k + n]) for n in (3, 2) if k + n <= len(ws) and " ".join(ws[k : k + n]) in known), ws[k])
            want.append(found)
            k += len(found.split(" "))
        assert got[i] == want, (ws, got[i], want)
    assert column(spark, ["x  y"], lambda w: F.array_join(text.compose(text.words(w), []), "|")) == ["x|y"]


def test_lookup_in_large_lists(spark):
    many = {f"w{i}": f"e{i}" for i in range(500)}
    assert column(spark, ["w7", "w499", "x", None], lambda w: text.lookup(many, w)) == ["e7", "e499", None, None]


def test_word_files(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("yang, dan,\n di,,dan")
    (tmp_path / "acronyms.txt").write_text("d.k.i.:daerah khusus,p.t.:perseroan")
    (tmp_path / "lexicon.tsv").write_text("# c\na\t1\t0.5\t0.25\tgood#1 fine#2\tgloss\nshort\t2\nn\t3\tx\t0\tt#1\tg\n")
    assert tables.word_list(spark, str(tmp_path / "stop.txt")) == ["dan", "di", "yang"]
    assert tables.word_map(spark, str(tmp_path / "acronyms.txt")) == {"d.k.i.": "daerah khusus", "p.t.": "perseroan"}
    rows = tables.lexicon_file(spark, str(tmp_path / "lexicon.tsv"))
    assert [(x.pos, x.pos_score) for x in rows.collect()] == [("a", 0.5)]
    assert {x.term: x.score for x in sentiment.prior(rows).collect()} == {"good": 0.25, "fine": 0.25}


def test_numbered_rows(spark):
    rows = [(t, i) for t, n in (("all", 500), ("x", 3), (None, 2)) for i in range(n)]
    df = graph.numbered(spark.createDataFrame(rows, "title string, node int").repartition(7), ["node"])
    assert sorted(((x.title, x.node) for x in df.collect()), key=str) == sorted(rows, key=str) and all(x.id == x.node for x in df.collect())


def test_upsert_of_repeated_keys(spark):
    old = spark.createDataFrame([(1, "a", "b"), (None, "n", None)], "k int, x string, y string")
    new = spark.createDataFrame([(1, 2, "late", None), (1, 1, "early", "1"), (None, 1, None, "z"), (3, 1, None, None)], "k int, t int, x string, y string")
    got = {r.k: (r.x, r.y) for r in sinks.upsert(old, new, ["k"], "t").collect()}
    assert got == {1: ("late", "1"), None: ("n", "z"), 3: (None, None)}
    with pytest.raises(Exception, match="rows of one key differ"):
        sinks.upsert(old, new.drop("t"), ["k"]).collect()
    with pytest.raises(Exception, match="rows of one key differ"):
        sinks.upsert(old, new.withColumn("t", F.lit(1)), ["k"], "t").collect()
    equal = sinks.upsert(old, spark.createDataFrame([(1, "e", None)] * 3, old.schema), ["k"])
    assert {r.k: (r.x, r.y) for r in equal.collect()} == {1: ("e", "b"), None: ("n", None)}


def _bucket_files(path) -> dict:
    return {p.parent.name: p.name for p in sorted(path.glob("data/*/bucket=*/part-*.parquet"))}


def test_keyed_table(spark, tmp_path):
    """Random upserts against a dictionary; only touched buckets get new files, a repeated run changes nothing."""
    path, r = f"file://{tmp_path}/t", random.Random(3)
    schema = "k bigint, a string, b int"
    table = keyed.KeyedTable.create(spark, path, schema, "k", 8)
    assert table.read().count() == 0 and table.upsert(table.read().withColumn("t", F.lit(1)), F.col("t")) == []
    want, before = {}, {}
    for run in range(6):
        rows = [(r.choice([*range(12), None]) if run < 3 else 5, r.randrange(20), r.choice(["x", "y", "z", None]), r.choice([1, 2, None])) for _ in range(12)]
        df = spark.createDataFrame(rows, "k bigint, t int, a string, b int")
        touched = table.upsert(df.drop("b") if run == 2 else df, F.col("t"), f"run{run}")
        for k, t, a, b in rows:
            cells = want.setdefault(k, {})
            for c, v in (("a", a), *[("b", b)] * (run != 2)):
                if v is not None:
                    cells[c] = max(cells.get(c, (t, v)), (t, v))
        table.vacuum()
        files = _bucket_files(tmp_path / "t")
        assert {b for b in files if files[b] != before.get(b)} == {f"bucket={b}" for b in touched}
        assert run < 3 or len(touched) == 1
        assert table.upsert(df, F.col("t"), f"run{run}") == [] and _bucket_files(tmp_path / "t") == files
        before = files
        got = {x.k: (x.a, x.b, x.a_at, x.b_at) for x in keyed.KeyedTable.open(spark, path).read(times=True).collect()}
        cell = lambda c, n, i: c.get(n, (None, None))[i]
        assert got == {k: (cell(c, "a", 1), cell(c, "b", 1), cell(c, "a", 0), cell(c, "b", 0)) for k, c in want.items()}


def test_keyed_table_versions(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    table = keyed.KeyedTable.create(spark, path, "k string, v string", "k", 4)
    row = lambda k, v: spark.createDataFrame([(k, v)], "k string, v string")
    table.upsert(row("a", "1"), 1)
    old = table.read()
    table.upsert(row("a", "2"), 2)
    assert [x.v for x in old.collect()] == ["1"] and [x.v for x in table.read().collect()] == ["2"]
    # A writer whose version is taken meanwhile fails and leaves no files.
    files = _bucket_files(tmp_path / "t")
    (tmp_path / "t/manifest/3.json").write_text((tmp_path / "t/manifest/2.json").read_text())
    real = keyed._manifest
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(keyed, "_manifest", lambda spark, path: (2, real(spark, path)[1]))
        with pytest.raises(keyed.Conflict):
            table.upsert(row("a", "3"), 3)
    assert _bucket_files(tmp_path / "t") == files
    assert keyed.KeyedTable.create(spark, path, "k string, v string", "k", 99).buckets == 4
    assert not keyed.KeyedTable.exists(spark, f"file://{tmp_path}/none")


def test_jobs_on_a_keyed_table(spark, tmp_path):
    """Cells that jobs derive go into the crawl table itself."""
    path = f"file://{tmp_path}/crawl"
    crawl = keyed.KeyedTable.create(spark, path, "row_key string, text string, cleaned string, url string, host string", "row_key", 4)
    crawl.upsert(spark.createDataFrame([("1", "Rumah kota.", None, "http://www.a.com/x"), ("2", None, None, "nonsense"), ("3", "x", "done", None)], "row_key string, text string, cleaned string, url string"), 1)
    jobs.main(["cleaner", path, path])
    jobs.main(["setdomain", path, path])
    got = {r.row_key: (r.cleaned, r.host) for r in crawl.read().collect()}
    assert got["1"] == ("rumah,kota", "a.com") and got["2"] == (None, None) and got["3"] == ("done", None)


def test_jobs_with_state(spark, tmp_path):
    crawl = spark.createDataFrame([("1", "a,b", "x,y", None), ("2", "a", None, None), ("3", "b", "x", "1")], "row_key string, cleaned string, classification string, termcloud_status string")
    training = spark.createDataFrame([("l", "u1", "a,b"), ("l", "u2", "a")], "label string, url string, terms string")
    config = jobs.EngineConfig(min_doc_freq=1)
    done = jobs.term_cloud_builder(crawl, training, "classification", f"file://{tmp_path}", config)
    assert [r.row_key for r in done.collect()] == ["1"]
    assert tables.state(spark, f"file://{tmp_path}/state_classification", "title string, term string, value double").count() == 4
    schema = "row_key string, title string, user string, reply_to string, network_status string"
    sizes = lambda: {r.node: r["size"] for r in tables.state(spark, f"file://{tmp_path}/net/nodes", "title string, node string, size bigint").collect()}
    for _ in range(2):  # a run repeated before its status is written counts once
        jobs.network_analyzer(spark.createDataFrame([("1", "t", "a", "b", None)], schema), f"file://{tmp_path}/net")
        assert sizes() == {"a": 1, "b": 1}
    jobs.network_analyzer(spark.createDataFrame([("1", "t", "a", "b", "1"), ("2", "t", "a", "c", None)], schema), f"file://{tmp_path}/net")
    assert sizes() == {"a": 2, "b": 1, "c": 1}


def test_classifier_flow(spark, tmp_path):
    """Build, save, load and classify; the command line does the same."""
    lines = [f"{'Judi' if i % 2 else 'berita'}\thttp://u{i}\t{'kartu,taruhan' if i % 2 else 'politik,ekonomi'},{'x' if i % 3 else 'y'}" for i in range(40)]
    (tmp_path / "training.tsv").write_text("\n".join(lines) + "\nshort\n")
    crawl = spark.createDataFrame([("1", "kartu,taruhan", None, None), ("2", "politik,ekonomi", None, None), ("3", "", None, None), ("4", None, None, None), ("5", "kartu", "old", "1")], "row_key string, cleaned string, classification string, classified string")
    config = jobs.EngineConfig(min_doc_freq=1, svm_iterations=20, margin=0.5)
    names = jobs.classifier_builder(tables.training_file(spark, str(tmp_path / "training.tsv")), f"{tmp_path}/model", None, config)
    assert names == ["berita", "judi"]
    out = {x.row_key: (x.classification, x.classified) for x in jobs.classifier(crawl, jobs.by_models(spark, f"{tmp_path}/model", names, config), config).collect()}
    assert out == {"1": ("judi", "1"), "2": ("berita", "1"), "3": ("none", None), "4": (None, None), "5": ("old", "1")}
    crawl.write.parquet(f"{tmp_path}/crawl")
    jobs.main(["classifier", f"{tmp_path}/crawl", f"{tmp_path}/model", "berita,judi", f"{tmp_path}/out"])
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5


def test_all_labels_in_one_descent(spark):
    """Weights after some steps equal a NumPy version's; rows without terms count in the mean."""
    r = np.random.default_rng(2)
    x = np.where(r.random((60, 9)) < 0.4, r.random((60, 9)) * 3, 0.0)
    x[7] = 0
    names = np.array(["a", "b", "c"])[r.integers(0, 3, 60)]
    w = np.zeros((3, 9))
    y = np.where(names[None, :] == np.array([["a"], ["b"], ["c"]]), 1.0, -1.0)
    for t in range(1, 7):
        missed = y * (w @ x.T) < 1
        w = w * (1 - 0.05 * 0.7 / t**0.5) + 0.7 / t**0.5 / 60 * ((missed * y) @ x)
    values = spark.createDataFrame([(i, f"t{j}", float(x[i, j])) for i in range(60) for j in range(9) if x[i, j]], "key int, term string, value double")
    labels = spark.createDataFrame([(i, names[i].upper()) for i in range(60)], "key int, label string")
    got = {(k.label, k.term): k.weight for k in classify.train(values, labels, ["a", "b", "c"], 6, 0.7, 0.05).collect()}
    assert all(abs(got.get((k, f"t{j}"), 0.0) - w[i, j]) < 1e-9 for i, k in enumerate("abc") for j in range(9)) and len(got) <= 27
    assert classify.train(values, labels.limit(0), ["a"], 3).count() == 0


def test_descent_over_whole_rows(spark, monkeypatch):
    """The weights where terms are few are those of the joins: repeated and null keys, null labels, rows without terms, several chunks."""
    r = np.random.default_rng(4)
    rows = [(i - i % 2 if i < 10 else None if i == 11 else i, "ABC"[r.integers(3)] if i % 13 else None, None if i == 5 else [None if j == 7 else "" if j == 8 else f"t{j}" for j in r.integers(0, 30, 0 if i % 17 == 3 else r.integers(1, 40))]) for i in range(90)]
    rows.append((90, "A", ["alone"] * 3))
    docs = spark.createDataFrame(rows, "id int, label string, terms array<string>").repartition(3)
    monkeypatch.setattr(descent, "CHUNK_WORDS", 100)
    few = classify.build(docs, "id", F.col("terms"), "label", ["a", "b", "c"], 1, 7)
    labelled = lambda m: sorted(classify.by_weights(docs, "id", F.col("terms"), m.weights, m.idf, ["c", "a", "b"], -0.1).collect(), key=repr)
    whole = labelled(few)
    monkeypatch.setattr(descent, "FEW_WEIGHTS", 3)
    many = classify.build(docs, "id", F.col("terms"), "label", ["a", "b", "c"], 1, 7)
    got, want = ({(k.label, k.term): k.weight for k in m.weights.collect()} for m in (few, many))
    assert whole == labelled(few) and len(whole) == 91 and len({x.classification for x in whole}) > 2
    assert got.keys() == want.keys() and len(got) == 3 * 29 and few.weights.count() == len(got)
    assert all(abs(got[k] - want[k]) < 1e-12 for k in got)
    monkeypatch.undo()
    assert few.weights.schema == many.weights.schema
    assert classify.build(docs.limit(0), "id", F.col("terms"), "label", ["a"], 1, 3).weights.count() == 0
    assert classify.build(docs, "id", F.col("terms"), "label", ["a"], 1000, 3).weights.count() == 0


def test_training_takes_all_steps(spark, tmp_path):
    """The query classifies by a descent of all configured steps, whose labels those of few steps are not."""
    r, n = np.random.default_rng(6), 60
    good = r.random(n) < 0.8
    tf = r.poisson(np.where(good[:, None], 1.0, np.r_[[1.0] * 8, [1.6] * 4]), (n, 12))
    tf[5] = 0
    x = tf * np.log(n / ((tf > 0).sum(0) + 1))
    y, w, after = np.where(good, 1.0, -1.0), np.zeros(12), {}
    for t in range(1, EngineConfig().svm_iterations + 1):
        w = w * (1 - 0.01 / t**0.5) + ((y * (x @ w) < 1) * y) @ x / t**0.5 / n
        after[t] = [("good" if i else "junk", "none" if k == 5 else "good" if at >= 0 else "junk") for k, (i, at) in enumerate(zip(good, x @ w, strict=True))]
    spark.createDataFrame([(i, " ".join(f"t{j}" for j in range(12) for _ in range(tf[i, j]))) for i in range(n)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(good[i])) for i in range(n)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = [(k.label, k.classification) for k in catalog.QUERIES["svm_train_predict"](spark, str(tmp_path)).orderBy("doc_id").collect()]
    assert got == after[100] and got != after[4]


def test_commands(spark, tmp_path):
    assert {"cleaner", "trainingdatabuilder", "classifierbuilder", "classifier", "featureindicescreator", "twittercrawler", "facebookcrawler"} <= set(jobs.COMMANDS)
    d = str(tmp_path)
    (tmp_path / "up.tsv").write_text("a\tu1\tx,y\nb\tu2\nb\tu3\tz\n")
    jobs.main(["trainingdatabuilder", "upload", f"{d}/up.tsv", f"{d}/training"])
    assert sorted((r.label, r.terms) for r in tables.training_file(spark, f"{d}/training").collect()) == [("a", "x,y"), ("b", "z")]
    pages = spark.createDataFrame([("u1", "yang dan di ini itu rumah", "<p>x</p>"), ("u2", "the of and to in", ""), ("u3", None, None)], "url string, text string, html string")
    pages.write.parquet(f"{d}/pages")
    spark.createDataFrame(list(SPOKEN.items()), "lang string, text string").write.parquet(f"{d}/spoken")
    jobs.main(["languageprofiles", f"{d}/spoken", f"{d}/profiles"])
    jobs.main(["trainingdatabuilder", "download", f"{d}/up.tsv", f"{d}/built", "--pages", f"{d}/pages", "--profiles", f"{d}/profiles"])
    assert [r.label for r in tables.training_file(spark, f"{d}/built").collect()] == ["a"]
    (tmp_path / "urls.txt").write_text("u1\nu2\nu1\n\nu9\n")
    jobs.main(["htmlcontent", f"{d}/urls.txt", f"{d}/pages", f"{d}/html"])
    assert [r.url for r in spark.read.parquet(f"{d}/html").collect()] == ["u1"]
    spark.createDataFrame([("1", "yang dan di", 5, "7", "n"), ("2", "the of", 6, "8", "m")], "row_key string, text string, time_ms long, user_id string, user_name string").write.parquet(f"{d}/tweets")
    jobs.main(["twittercrawler", f"{d}/tweets", f"file://{d}/posts", f"{d}/checkpoint", f"{d}/profiles"])
    assert [r.row_key for r in spark.read.parquet(f"{d}/posts/batches/*").collect()] == ["1"]
    web = spark.createDataFrame([("p", PAGE, "http://a/x", "a", "judi", "1", None), ("q", PAGE, "http://a/y", "a", "judi", None, None)], "row_key string, html string, url string, host string, classification string, classified string, comment_status string")
    web.write.parquet(f"{d}/web")
    jobs.main(["websitecomment", f"{d}/web", f"{d}/comments", f"{d}/status"])
    assert spark.read.parquet(f"{d}/comments").where("url = 'http://a/x' and classification = 'judi'").count() == 3
    assert [r.row_key for r in spark.read.parquet(f"{d}/status").collect()] == ["p"]


def test_comment_threads(spark):
    rows = [("1", None, "x", None, "u1", "A"), ("2", "1", None, None, "u2", "B"), ("3", "2", None, None, "u3", "C"), ("4", None, None, None, "u4", "D"), ("5", "4", None, None, "u5", "E"), ("6", None, "x", 999_999_999, "u6", "F"), ("7", "6", None, None, "u7", "G")]
    posts = spark.createDataFrame(rows, "id string, reply_to string, classified string, comment_ms long, user_id string, user_name string").withColumns({"text": F.col("id"), "time_ms": F.lit(1)})
    found, status = jobs.comment_threads(posts, 1_000_000_000)
    got = {x.id: (x.replyto_id, x.base_id, x.depth, x.user_name, x.replyto_user_name, x.base_user_id) for x in found.collect()}
    assert got == {"2": ("1", "1", 1, "B", "A", "u1"), "3": ("2", "1", 2, "C", "B", "u1")}
    assert [(x.id, x.comment_ms) for x in status.collect()] == [("1", 1_000_000_000)]


def test_host_search(spark):
    hosts = spark.createDataFrame([("g", "group", "OPEN", "Rumah Kita"), ("h", "group", "CLOSED", "rumah"), ("p", "page", None, "RUMAH"), ("u", "user", None, "other"), ("v", "user", None, "rumah 2")], "id string, type string, privacy string, name string")
    texts = {"g": ["yang dan"] * 10 + ["the of"] * 30, "p": ["the of", "yang dan"], "v": ["the of"] * 3}
    posts = spark.createDataFrame([(k, -i, None, None, x, None, None) for k, v in texts.items() for i, x in enumerate(v)], "host_id string, time int, caption string, description string, message string, name string, story string")
    found = filters.search_hosts(hosts, posts, ["rumah", "x"], spoken(spark), "id", 100, 5)
    assert sorted(map(tuple, found.collect())) == [("g", "group", "Rumah Kita", 5), ("p", "page", "RUMAH", 5)]


@pytest.mark.parametrize("compact", [1, 3, 100])
def test_stream(spark, tmp_path, compact):
    rows = spark.range(40).select((F.col("id") % 16).alias("id"), "id", (F.col("id") % 7).alias("v")).toDF("id", "t", "v")
    rows = rows.withColumn("w", F.when(F.col("t") < 20, F.col("t")))
    for k in range(4):  # later files have later times
        rows.where(f"t div 10 = {k}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = ingest.source(spark, f"{tmp_path}/in", rows.schema)
    target = f"file://{tmp_path}/out"
    for _ in range(2):
        ingest.upsert_stream(stream, {c: F.col(c) for c in rows.columns}, "id", target, f"{tmp_path}/cp", F.col("v") > 0, order="t", compact_every=compact).awaitTermination()
    want, last = {}, {}
    for x in rows.orderBy("t").collect():
        if x.v > 0:
            batch = x.t // 10
            cell = last.setdefault(x.id, {})
            cell[batch] = (x.t, x.v, x.w)  # the last row of a batch
    for i, batches in last.items():
        t = v = w = None
        for b in sorted(batches):
            t, v, w = batches[b][0], batches[b][1], batches[b][2] if batches[b][2] is not None else w
        want[i] = (t, v, w)
    got = {x.id: (x.t, x.v, x.w) for x in ingest.current(spark, target, rows.schema, "id").collect()}
    assert got == want


def test_stream_keeps_its_aggregate(spark, tmp_path):
    """After batches, a restart and a repeated batch the table has the sizes of all rows."""
    r = random.Random(4)
    rows = [("t" if i % 2 else None, r.choice("abcd"), r.choice(["a", "e", None])) for i in range(60)]
    df = spark.createDataFrame(rows, "title string, u string, r string")
    table = keyed.KeyedTable.create(spark, f"file://{tmp_path}/table", "id struct<title:string,node:string>, size bigint", "id", 4)
    for lo, hi in ((0, 20), (20, 45), (45, 60)):
        spark.createDataFrame(rows[lo:hi], df.schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        sizes = graph.nodes(ingest.source(spark, f"{tmp_path}/in", df.schema), "title", "u", "r").select(F.struct("title", "node").alias("id"), "size")
        stateful.keep_aggregate(sizes, table, f"{tmp_path}/checkpoint").awaitTermination()
        want = Counter((t or "all", n) for t, u, a in rows[:hi] for n in (u, a) if n is not None)
        assert {(x.id.title, x.id.node): x["size"] for x in table.read().collect()} == want
    stateful.keep_aggregate(sizes, table, f"{tmp_path}/checkpoint").awaitTermination()
    assert {(x.id.title, x.id.node): x["size"] for x in table.read().collect()} == want


def test_stream_of_due_keys(spark, tmp_path):
    """Timers move with visits, fire once the stream's clock is past them, and outlive a restart."""
    schema = "k string, ts timestamp"
    at = lambda s: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s)
    got = []
    for rows in ([("a", 0), ("b", 5), (None, 6)], [("a", 8), ("c", 14)], [("d", 30), ("c", 31)], [("b", 32), ("e", 60)]):
        spark.createDataFrame([(k, at(s)) for k, s in rows], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stateful.start_due(ingest.source(spark, f"{tmp_path}/in", schema), "k", "ts", 10_000, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
        found = spark.read.schema(stateful.DUE).parquet(f"{tmp_path}/out").orderBy("due_ms").collect()
        got.append([(x.key, (x.due_ms - 10_000) % 86_400_000 // 1000) for x in found])
        assert all(x.due_ms == x.last_ms + 10_000 for x in found)
    # At 14 neither a (8) nor b (5, due at 15) has rested; at 31 both have; c's first visit ends at 24 unless its second comes with it.
    assert got[0] == [] and got[1] == [] and set(got[2]) >= {("a", 8), ("b", 5)}
    assert set(got[3]) >= {("a", 8), ("b", 5), ("d", 30), ("c", 31), ("b", 32)} and ("e", 60) not in got[3]


def test_paged_feed(spark, tmp_path):
    """A followed feed loses and repeats nothing, over new files, a failed batch and restarts; a search ends by whole pages."""
    feed.register(spark)
    schema, path = "k bigint, s string", f"file://{tmp_path}/in"
    rows = lambda lo, hi: spark.range(lo, hi).select(F.col("id").alias("k"), F.concat(F.lit("é"), "id").alias("s"), F.lit(1).alias("unused"))
    seen, fail = [], [False]

    def take(batch, number):
        seen.append((number, sorted(r.k for r in batch.collect())))
        if fail[0]:
            raise RuntimeError("after the batch was read")

    def run():
        stream = spark.readStream.format(feed.NAME).schema(schema).option("path", path).option("page", "7").load()
        stream.writeStream.option("checkpointLocation", f"{tmp_path}/cp").foreachBatch(take).trigger(availableNow=True).start().awaitTermination()

    sinks.named_files(rows(0, 130).repartition(2), path, "a")
    run()
    sinks.named_files(rows(130, 150).coalesce(1), path, "b")
    fail[0] = True
    with pytest.raises(StreamingQueryException):
        run()
    sinks.named_files(rows(150, 151).coalesce(1), path, "c")
    fail[0] = False
    run()
    run()
    batches = dict(seen)
    assert sorted(k for b in batches.values() for k in b) == list(range(151))
    assert len(seen) == len(batches) + 1 and seen[1] == seen[2]  # the failed batch came again as it was
    search = lambda **o: spark.read.format(feed.NAME).schema(schema).options(path=path, page="7", **o).load()
    assert sorted(r.s for r in search().collect()) == sorted(f"é{i}" for i in range(151))
    assert search(limit="20").count() == 21 and search(limit="1").count() == 7 and search(limit="0").count() == 0


def test_schema_helpers(spark):
    assert table_name("u", "t-1", "crawl") == "u_t_1_crawl"
    df = spark.createDataFrame([(1, "x")], "`p:cr` int, b string")
    assert Role("website", {"text": "p:cr"}).rename(df).columns == ["text"]
    sinks.create_table(spark, "role_table", "a int")
    assert sinks.table_has(spark, "role_table", ["a"]) and not sinks.table_has(spark, "role_table", ["b"])
    spark.sql("DROP TABLE role_table")


def counted(spark, df, column):
    """``df`` and an accumulator of how many values of ``column`` were computed."""
    seen = spark.sparkContext.accumulator(0)

    def one(x):
        seen.add(1)
        return x

    return df.withColumn(column, F.udf(one, df.schema[column].dataType)(column)), seen


def test_idf_reads_its_rows_once(spark):
    rows, seen = counted(spark, spark.createDataFrame([(["a", "b", "a"],), (["a", ""],), ([""],), ([],), (None,)], "t array<string>"), "t")
    idf = features_ops.inverse_frequency(rows, F.col("t"), 1)
    got = {r.term: (r.df, r.idf) for r in idf.collect()}
    assert got == {"a": (2, math.log(3 / 3)), "b": (1, math.log(3 / 2))}
    idf.collect()
    assert seen.value == 5


def test_few_idfs_go_to_the_frequencies(spark):
    rows = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "a", 1)], "k int, term string, tf int")
    idf = spark.createDataFrame([("a", 2, 0.5)], "term string, df long, idf double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        values = features_ops.tfidf(rows, idf, "k")
        assert sorted(values.collect()) == [(1, "a", 1.0), (2, "a", 0.5)]
        assert "SortMergeJoin" not in values._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_term_cloud_reads_its_rows_once(spark, tmp_path):
    crawl, seen = counted(spark, spark.createDataFrame([("1", "a,b,a", "x", None), ("2", "b,c", "y", None)], "row_key string, cleaned string, classification string, termcloud_status string"), "classification")
    training = spark.createDataFrame([("x", "u", "a,b"), ("y", "v", "b,c")], "label string, url string, terms string")
    jobs.term_cloud_builder(crawl, training, "classification", str(tmp_path), EngineConfig(min_doc_freq=1))
    assert seen.value <= 4  # the filter and the rows


def test_only_words_with_a_weight_are_counted(spark):
    rows = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"]), (3, None)], "k int, t array<string>")
    weights = spark.createDataFrame([("x", "a", 2.0), ("y", "a", 0.5)], "label string, term string, weight double")
    idf = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 1.0)], "term string, df long, idf double")
    kept = classify.known_terms(features_ops.term_rows(rows, "k", F.col("t")), weights)
    assert kept.select("k", "term").collect() == [(1, "a")]
    assert sorted(classify.by_weights(rows, "k", F.col("t"), weights, idf, ["x", "y"]).collect()) == [(1, "x"), (2, "none"), (3, "none")]


def test_simple_terms_of_odd_texts(spark):
    texts = ["Don't  STOP\u00a0it", "İx K9", "", " \t ", "--", "a\x0bb\x1cc", None, "...end"]
    rows = spark.createDataFrame([(x,) for x in texts], "t string")
    before = F.filter(F.split(F.regexp_replace(F.lower("t"), r"[^a-z0-9\s]", ""), r"\s+"), lambda w: w != "")
    got = rows.select(text.simple_terms(F.col("t")).alias("x"), before.alias("y")).collect()
    assert [r.x for r in got] == [r.y for r in got] and got[0].x == ["dont", "stopit"]


def test_language_where_the_text_is(spark):
    labelled = spark.createDataFrame([("en", "the cat and the dog"), ("de", "der hund und die katze")], "lang string, text string")
    known = language.train(labelled)
    rows = spark.createDataFrame([(1, "the dog"), (2, "und der"), (3, "12 ?"), (4, None)], "k int, text string")
    found = language.detect(rows, ["k"], "text", known)
    assert dict(found.collect()) == {1: "en", 2: "de", 3: None, 4: None}
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    # Rows of a key are one text, a part without letters changes nothing; one key twice, one null.
    twice = spark.createDataFrame([(1, "the"), (1, None), (1, " dog"), (None, "und der"), (None, "7"), (5, "the")], "k int, text string")
    assert dict(language.detect(twice, ["k"], "text", known).collect()) == {1: "en", None: "de", 5: "en"}


@pytest.mark.parametrize("name", ["stream_node_sizes", "stream_due_users"])
def test_stream_inputs_are_not_made_by_one_task(spark, monkeypatch, name):
    def fail(self, n):
        raise AssertionError(f"coalesce({n})")

    monkeypatch.setattr(type(spark.range(1)), "coalesce", fail)
    assert catalog.QUERIES[name](spark, "/root/testdata/sf0.001").columns


def test_tweets_take_several_files_at_once(spark, tmp_path):
    known = language.train(spark.createDataFrame([("en", "the cat and the dog"), ("de", "der hund und die katze")], "lang string, text string"))
    posts = spark.createDataFrame([(str(i), "the dog" if i % 2 else "der hund", i, "u", "n") for i in range(8)], "row_key string, text string, time_ms long, user_id string, user_name string")
    posts.repartition(4).write.parquet(f"{tmp_path}/in")
    jobs.tweets(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/checkpoint", known, "en", files_per_batch=4).awaitTermination()
    rows = ingest.current(spark, f"{tmp_path}/out", posts.schema, "row_key")
    assert sorted(r.row_key for r in rows.collect()) == ["1", "3", "5", "7"]
    assert {r["_batch"] for r in rows.select("_batch").collect()} == {1}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_chunk_has_a_dictionary_of_its_distinct_words(spark, monkeypatch):
    """Rows of the dictionaries do not grow with the words of the texts, which come back whole from chunks of any size (F8)."""
    rows = [(i, "kota. main! " * (i % 50) + "Makan  yg\n") for i in range(200)] + [(None, None), (7, "")]
    docs = spark.createDataFrame(rows, "k int, t string").repartition(3)
    coded = dictionary.encode(docs, ["k"], "t")
    assert coded.tokens.count() <= 4 * 3
    want = Counter(w for _, t in rows for w in (t or "").split())
    assert {x.word: x.n for x in coded.words().collect()} == want
    plain = sorted(((x.k, x.terms) for x in docs.select("k", F.coalesce(text.clean_terms(F.col("t")), F.lit("")).alias("terms")).collect()), key=str)
    for size in (1, 300, 1 << 25):
        monkeypatch.setattr(dictionary, "CHUNK_BYTES", size)
        assert sorted(((x.k, x.terms) for x in dictionary.clean_terms(docs, ["k"], "t").collect()), key=str) == plain
        assert {x.word: x.n for x in dictionary.encode(docs, ["k"], "t").words().collect()} == want
    assert "collect_list" not in plan_of(dictionary.clean_terms(docs, ["k"], "t"))


def test_sentences_and_tags_are_made_where_the_texts_lie(spark, monkeypatch):
    """No word is dealt out by its text or sentence (F9, F7); small chunks give what one gives; ties and lone words as all paths have it."""
    docs = spark.createDataFrame([(i, " ".join(["Dr. Kota main.", "Lari! besar", "2. mai", "x"][: i % 5])) for i in range(40)], "k int, t string").repartition(2)
    model = tagger.train(spark.createDataFrame(tagged_corpus(5), "sentence int, place int, word string, tag string"), ["sentence"])
    found = {}
    for size in (10, 1 << 25):
        monkeypatch.setattr(dictionary, "CHUNK_BYTES", size)
        split, tags = boundaries.split(docs, ["k"], "t"), tagger.tag(docs, ["k"], "t", model)
        found[size] = [sorted(map(str, x.collect())) for x in (split, tags)]
        assert all("collect_list" not in plan_of(x) and "Window" not in plan_of(x) for x in (split, tags))
    assert found[10] == found[1 << 25] and all(found[10])
    r = random.Random(8)
    for k in (1, 2, 4):
        values = lambda *shape: np.array([r.choice([0.0, -1.0, -2.5]) for _ in range(math.prod(shape))]).reshape(shape)  # noqa: B023, E731
        start, moves, e, sizes = values(k), values(k, k), values(6, k), np.array([0, 3, 1, 5, 0, 2, 5])
        at = np.array([r.randrange(6) for _ in range(sizes.sum())])
        got, begin = tagger.decode(e, at, sizes, start, moves), 0
        for n in sizes:
            score = lambda p: start[p[0]] + sum(moves[a, b] for a, b in itertools.pairwise(p)) + sum(e[w, t] for w, t in zip(at[begin : begin + n], p, strict=True))  # noqa: B023, E731
            if n:
                best = max(map(score, itertools.product(range(k), repeat=n)))
                assert tuple(got[begin : begin + n][::-1]) == min(p[::-1] for p in itertools.product(range(k), repeat=n) if score(p) == best)
            begin += n


def test_a_model_of_sentences_is_that_of_their_words(spark):
    rows = tagged_corpus(6)
    words = spark.createDataFrame(rows, "sentence int, place int, word string, tag string")
    whole = words.groupBy("sentence").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "word", "tag"))), lambda x: F.struct(x["word"].alias("word"), x["tag"].alias("tag"))).alias("tagged"))
    a, b = tagger.train(words, ["sentence"]), tagger.train_sentences(whole)
    assert (a.tags, a.start, a.moves) == (b.tags, b.start, b.moves)
    assert sorted(map(str, a.words.collect())) == sorted(map(str, b.words.collect())) and sorted(map(str, a.suffixes.collect())) == sorted(map(str, b.suffixes.collect()))


def test_upserted_rows_lie_for_the_join_as_they_were_grouped(spark):
    """Two shuffles, one a side, null keys equal (F8)."""
    old = spark.createDataFrame([(1, None, "a"), (None, 2, "b"), (None, None, "c"), (3, 3, None)], "k int, l int, v string")
    new = spark.createDataFrame([(1, None, "x"), (None, None, None), (3, 3, "y"), (None, 4, "z"), (None, 4, "z")], "k int, l int, v string")
    out = sinks.upsert(old, new, ["k", "l"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan_of(sinks.upsert(old, new, ["k", "l"])).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, None, "x"), (None, 2, "b"), (None, None, "c"), (3, 3, "y"), (None, 4, "z")], key=str)

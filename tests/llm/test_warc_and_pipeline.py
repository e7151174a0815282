import gzip
import hashlib
import io
import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from sparkloom.llm import common, packing, pii, warc
from tests.llm import helpers

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("digests, shares", [(1 << 17, 1000), (-1, 1000), (-1, 1)])
def test_warc_round_trip(spark, monkeypatch, digests, shares):
    """Repeated digests broadcast, all of them hot, or all dealt out."""
    monkeypatch.setattr(warc, "MOST_DIGESTS", digests)
    monkeypatch.setattr(common, "HOT_SHARES", shares)
    long = "é" * 600
    rows = [(1, "http://a", long), (2, "http://b\n", long), (9, None, long), (3, "u", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""), (9, "again", long), (None, "n", long)]
    rows += [(20, "big", "x" * 3_000_000), (21, "big", "x" * 3_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(c) for c in ("digest", "page", "top", "size", "kind", "key", "refers")})
    got = sorted(map(tuple, warc.round_trip(spark, pages).collect()), key=str)
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        top = 21 if len(b) > 2_000_000 else 9
        revisit = len(b) >= 1000 and i != top
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    assert got == sorted(want, key=str)
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_normaliser_writes_members():
    records = [warc._record("response", str(i), "u", hashlib.sha1(p).hexdigest(), len(p), None, p, "d") for i, p in enumerate((b"", b"x" * 3_000_000, b"\r\n\r\nWARC/1.1\r\n"))]
    plain = b"".join(h + b + b"\r\n\r\n" for h, b in records)
    for stream in (gzip.compress(plain), gzip.compress(plain[:500]) + gzip.compress(plain[500:])):
        out, index = io.BytesIO(), io.BytesIO()
        assert warc._Normaliser("x", 6).rewrite(io.BytesIO(stream), out, index) == 3
        assert gzip.decompress(out.getvalue()).count(b"WARC-Type") + gzip.decompress(out.getvalue()).count(b"warc-type") == 3
        for i, line in enumerate(index.getvalue().splitlines()):
            entry_ = json.loads(line)
            out.seek(entry_["offset"])
            page, size, digest, kind, _ = warc.read_member(out, entry_["length"])
            assert (page, kind) == (str(i), "response")


def test_normaliser_reports_a_cut_archive():
    head, block = warc._record("response", "1", "u", "d", 100, None, b"y" * 100, "d")
    with pytest.raises(EOFError):
        warc._Normaliser("x", 6).rewrite(io.BytesIO(gzip.compress(head + block[:-40])), io.BytesIO(), io.BytesIO())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = stages["language_id"](spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() >= 0.99 * len(texts)
    single = {r.doc_id for r in stages["minhash_near_dedup"](spark, docs, SF).collect()}
    assert single == {i for i, (_, c) in helpers.clusters(texts).items() if c == i}
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in stages["decontaminate"](spark, docs, SF).collect()}
    assert clean == {i for i, (n, h, _) in helpers.contamination(texts, items).items() if not (h and 20 * h >= n)}
    masked = {r.doc_id: r for r in stages["pii"](spark, docs, SF).collect()}
    for i, t in texts.items():
        base = pii.base_spans(t)
        assert not pii.base_spans(masked[i].text) and masked[i].n_chars == len(masked[i].text)
        assert base or masked[i].text == t or "[" in masked[i].text


def test_run_against_brute_force(spark, tmp_path):
    """All stages over a small corpus: what stays, what is masked, and the ids of every packed piece."""
    tokenizers = pytest.importorskip("tokenizers")
    base = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {r.doc_id: r for r in base.collect()}
    run = corpus_pipeline.run(spark, SF).collect()
    kept = {i: r.text for i, r in docs.items() if any(c.isalpha() for c in r.text or "")}
    langs = {r.doc_id for r in corpus_pipeline.identify_language(spark, base, SF).collect()}
    assert langs <= set(kept) and len(langs) >= 0.99 * len(kept)
    kept = {i: t for i, t in kept.items() if i in langs}
    kept = {i: kept[i] for i, (_, c) in helpers.clusters(kept).items() if c == i}
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {i: kept[i] for i, (n, h, _) in helpers.contamination(kept, items).items() if not (h and 20 * h >= n)}
    field = pii.train()
    tok = tokenizers.Tokenizer.from_file(corpus_pipeline.tokenizer_path())
    want = {}
    for i, t in kept.items():
        ids = tok.encode(pii.mask(t, pii.find(t, field)[1]), add_special_tokens=False).ids + [1]
        for s in range(0, len(ids), 2048):
            piece = ids[s : s + 2048]
            want[i, s] = (len(piece), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in piece)), len(ids))
    assert {(r.doc_id, r.start): (r.length, r.ids_crc32, r.doc_tokens) for r in run} == want
    ends = {}
    for r in sorted(run, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048 and sorted(ends) == list(range(len(ends)))


def test_near_duplicate_stage_with_odd_ids(spark):
    """Repeated and null ids: no different text is lost, no copy stays."""
    long = lambda w: " ".join(f"{w}{i}" for i in range(40))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    row = lambda i, t, s="s": (i, t, "en", s, len(t or ""))
    rows = [row(1, long("a")), row(1, long("b")), row(1, long("a")), row(2, long("a") + " x"), row(None, long("b")), row(None, long("c")), row(None, long("c")), row(3, long("d"), "p"), row(3, long("d"), "q"), row(4, None), row(4, ""), row(5, None)]
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, schema), SF).collect()]
    assert sorted(got, key=str) == sorted([(1, long("a")), (1, long("b")), (None, long("c")), (3, long("d")), (4, None), (4, ""), (5, None)], key=str)


CLASHING = ["spans", "masked", "items", "item", "_text", "_row", "_id", "_lang_pred", "lang_pred", "score", "row", "whole", "key", "t", "r", "n_words", "kept", "contaminated", "hashes", "a.b"]


def test_stages_keep_every_column(spark):
    """Whatever a column is called, all stages but the last give it back as it was, with repeated ids too."""
    long = lambda w: " ".join(f"{w}{i} Wort" for i in range(40))
    rows = [(i, long("abcdef"[i]), "de", "s", None) for i in range(6)] + [(6, long("a") + " x", "de", "s", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in CLASHING])
    for repeated in (False, True):
        state = docs.unionByName(docs.where("doc_id = 2").withColumn("text", F.lit(long("z")))) if repeated else docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            state = stage(spark, state, SF)
            assert state.columns == docs.columns, name
        state = state.cache()
        assert state.count() == 6 + repeated
        assert all(r[c] == f"{c}{r.doc_id}" for r in state.collect() for c in CLASHING)
        assert corpus_pipeline.pack_sequences(spark, state, SF).count() > 0


def test_stages_of_an_empty_table(spark):
    none = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, SF)
        assert out.count() == 0 and (name == "packing" or out.columns == none.columns), name


def test_packing_with_another_tokenizer():
    """A tokenizer that does not cut words as known encodes texts whole."""
    tokenizer = packing.WordTokenizer(corpus_pipeline.tokenizer_path())
    assert tokenizer.by_parts
    texts = ["It's done, isn't it? 12-3", "", "Ünd ça", "x" * 500]
    raw = "".join(texts).encode()
    offsets = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts]))).astype(np.int64)
    ids, at = tokenizer.encode(np.frombuffer(raw, np.uint8), offsets)
    tokenizer.by_parts = False
    whole, ends = tokenizer.encode(np.frombuffer(raw, np.uint8), offsets)
    assert ids.tolist() == whole.tolist() and at.tolist() == ends.tolist()
    assert not packing.WordTokenizer._cuts_words({"pre_tokenizer": {"type": "ByteLevel"}, "added_tokens": []})


def test_registered():
    names = entry.queries()
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert "pipeline" in names and "pipeline" not in entry.oracle_sql()

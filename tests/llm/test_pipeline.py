"""The pipeline's stages take effect, and run() is the stages in order."""

import hashlib
import os

import pytest
import regex
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("component_id", F.lit("clash"))
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.columns == docs.columns, name
        assert out.count() <= docs.count()
        docs = out
    assert docs.count() < n and docs.groupBy("doc_id").count().where("count > 1").isEmpty()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    ran = corpus_pipeline.run(spark, SF)
    key = ["doc_id", "n_tokens", "ids_sha256"]
    assert sorted(map(tuple, last.select(*key).collect())) == sorted(map(tuple, ran.select(*key).collect()))


def test_stages_take_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None, "en", "s", 0), (None, "some words here", None, None, None), (1, None, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).count()
        assert stage(spark, docs.limit(0), SF).count() == 0


def independent(rows, scores, items):
    """What the stages keep of (doc_id, text) rows, worked out one by one: quality, SimHash groups, benchmark passages, personal data."""
    from locuspark.llm import pii
    from tests.llm.test_dedup import closure, naive_fingerprint

    kept = {i: t for i, t in rows if scores[i] >= 0.7}
    prints = {i: int(naive_fingerprint(t)) for i, t in kept.items()}
    ids = sorted(kept)
    near = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if bin(prints[a] ^ prints[b]).count("1") <= 3]
    root = closure(ids, near)
    kept = {i: t for i, t in kept.items() if root[i] == i}

    def shingles(text):
        w = regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())
        return {" ".join(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {" ".join(w)} if w else set()

    wanted = [s for s in map(shingles, items) if s]
    kept = {i: t for i, t in kept.items() if not any(len(s & shingles(t)) >= 0.8 * len(s) - 1e-9 for s in wanted)}
    out, model = {}, pii.fitted()
    for i, t in kept.items():
        at, parts = 0, []
        for kind, s, e in sorted(pii.find_spans(t or "", model)[1], key=lambda x: (x[1], -x[2])):
            if s >= at:
                parts += [t[at:s], f"[{kind.upper()}]"]
            at = max(at, e)
        out[i] = "".join([*parts, (t or "")[at:]])
    return out


def test_run_equals_an_independent_computation(spark):
    from tokenizers import Tokenizer

    from locuspark.llm.queries import QUERIES, tokenizer_path

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    scores = {r.doc_id: r.score for r in QUERIES["op9_quality"](spark, SF).collect()}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()]
    want = independent(rows, scores, items)
    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    digest = {i: hashlib.sha256(",".join(map(str, tok.encode(t, add_special_tokens=False).ids)).encode()).hexdigest() for i, t in want.items()}
    assert {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SF).collect()} == digest and 0 < len(digest) < len(rows)


def test_stages_take_long_texts_and_ties(spark):
    long = "A sentence with a few words, and some more of them. " * 40_000
    rows = [(7, long), (3, long), (5, long + "end"), (5, long + "end"), (9, "short text"), (2, "short text")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    by_name = dict(corpus_pipeline.STAGES)
    near = by_name["simhash near-dedup"](spark, docs, SF)
    assert sorted(r.doc_id for r in near.select("doc_id").collect()) == [2, 3]
    for name, stage in corpus_pipeline.STAGES[2:]:
        assert stage(spark, docs, SF).count() == 6, name
    bench = spark.createDataFrame([(1, "few words, and some more of them")], "item_id long, text string")
    from locuspark.llm import decontamination

    assert sorted(r.doc_id for r in decontamination.decontaminated(docs, bench).select("doc_id").collect()) == [2, 9]

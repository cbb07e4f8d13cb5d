"""Odd and empty tables through every operator and stage."""

import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weftlink.llm import chunks, fingerprint, hamming, langid, lmscore, mixing, packing, pii, simhash, suffixes

ROWS = {
    "fingerprint": (fingerprint.compared, 11),
    "simhash": (simhash.grouped, 11),
    "mixing": (mixing.copies, 11),
    "pii": (pii.extracted, 11),
    "scores": (lmscore.scored, 11),
    "chunks": (chunks.repeated, None),
    "suffixes": (suffixes.repeated, None),
    "packing": (packing.packed, None),
    "language": (langid.recognised, None),
    "dedup": (simhash.deduplicated, None),
    "redacted": (pii.redacted, 11),
    "mixed": (mixing.mixed, None),
}


@pytest.mark.parametrize("name", sorted(ROWS))
def test_odd_rows(odd, name):
    f, n = ROWS[name]
    got = f(odd).toPandas()
    assert n is None or len(got) == n


@pytest.mark.parametrize("name", sorted(ROWS))
def test_empty_table(none, name):
    assert ROWS[name][0](none).count() == 0


def test_stages_keep_columns(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "").cache()
        assert docs.columns == odd.columns
    assert {r["doc_id"] for r in docs.collect()} <= {4, 5, 6, 7, 8, 9, None}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() > 0


def test_hamming_odd(spark):
    rows = [(1, [1.0, -1.0]), (2, None), (3, []), (None, [1.0]), (4, [1.0, -1.0]), (4, [1.0, -1.0]), (50, [None, float("nan")])]
    df = spark.createDataFrame(rows, "id long, e array<float>").select("id", F.when(F.size("e") > 0, hamming.sign_code(F.col("e"))).alias("code"))
    got = hamming.top_k(df, df.where("id = 1"), 3).orderBy("rank").collect()
    assert [(r["id"], r["distance"]) for r in got] == [(1, 0), (4, 0), (4, 0)]
    assert hamming.top_k(df, df.where("id = 50"), 10).count() == 4
    assert hamming.top_k(df.where("false"), df.where("false"), 3).count() == 0


def test_scores_without_training_words(spark):
    """Tasks whose rows hold no word, or no training row at all."""
    rows = [(i, None if i % 2 else " \n ") for i in range(30)]
    got = lmscore.scored(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert len(got) == 30 and all(r["n_tokens"] == 1 and r["n_known"] == 1 and -0.5 < r["score"] < 0 for r in got)
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    got = lmscore.scored(spark.createDataFrame([(i, "only held out") for i in held], "doc_id long, text string")).collect()
    assert [(r["train_tokens"], r["n_tokens"], r["n_known"], r["base_score"]) for r in got] == [(0, 4, 0, 0.0)] * 3

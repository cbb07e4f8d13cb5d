import random

import pytest
from pyspark.sql import functions as F

from weftlink.operators import blocking, features, metrics, model, resolve, validate
from weftlink.sources import tables


def pairs(spark, *rows):
    return spark.createDataFrame(rows, "sid string, cid string, score double")


def test_claim_once(spark):
    got = resolve.claimed(pairs(spark, ("a", "c", 0.9), ("b", "c", 0.8), ("b", "d", 0.7), ("b", "e", 0.4)), 0.5)
    lists = resolve.completed(spark.createDataFrame([("a",), ("b",), ("z",)], "entity_id string"), resolve.match_lists(got))
    assert {r["sid"]: r["cids"] for r in lists.collect()} == {"a": ["c"], "b": ["d"], "z": []}


def test_claims_equal_the_greedy_loop(spark):
    rng = random.Random(5)
    rows = [(f"s{i}", f"c{j}", rng.random()) for i in range(12) for j in range(15) if rng.random() < 0.5]
    owner, matched = set(), set()
    for s, c, p in sorted(rows, key=lambda r: -r[2]):
        if p >= 0.3 and c not in owner:
            owner.add(c)
            matched.add((s, c))
    assert {(r["sid"], r["cid"]) for r in resolve.claimed(pairs(spark, *rows), 0.3).collect()} == matched


def test_rank_and_gap(spark):
    got = features.ranked(pairs(spark, ("a", "x", 0.9), ("a", "y", 0.7), ("a", "z", 0.7)), score="score").orderBy("rank_within_s1").collect()
    assert [(r["rank_within_s1"], round(r["gap_to_next_best"], 6), r["s1_candidate_count"]) for r in got] == [(1, 0.2, 3), (2, 0.0, 3), (3, 0.0, 3)]


def f05(pred, true):
    if not true or not pred:
        return float(not true and not pred)
    hit = len(pred & true)
    p, r = hit / len(pred), hit / len(true)
    return 1.25 * p * r / (0.25 * p + r) if hit else 0.0


def test_f05(spark):
    truth = spark.createDataFrame([("a", ["x", "y"]), ("b", []), ("c", []), ("d", ["q"])], "sid string, trues array<string>")
    found = spark.createDataFrame([("a", ["x", "z", "y"]), ("c", ["q"])], "sid string, cids array<string>")
    got = {r["sid"]: r["f05"] for r in metrics.scored_entities(truth, found).collect()}
    assert got["a"] == pytest.approx(5 / 7)
    assert (got["b"], got["c"], got["d"]) == (1.0, 0.0, 0.0)
    micro = metrics.micro(metrics.scored_entities(truth, found)).first()
    assert (micro["hits"], micro["predicted_pairs"], micro["true_pairs"], micro["exact_sets"]) == (2, 4, 3, 1)


def test_tuning_equals_the_loop_over_thresholds(spark):
    rng = random.Random(9)
    rows = [(f"s{i}", f"c{j}", round(rng.random(), 3)) for i in range(10) for j in range(14) if rng.random() < 0.4]
    truth = {f"s{i}": {f"c{j}" for j in range(14) if rng.random() < 0.1} for i in range(10)}
    best = None
    for t in metrics.THRESHOLDS:
        owner, got = set(), {s: set() for s in truth}
        for s, c, p in sorted(rows, key=lambda r: (-r[2], r[0])):
            if p >= t and c not in owner:
                owner.add(c)
                got[s].add(c)
        f = sum(f05(got[s], truth[s]) for s in truth) / len(truth)
        if best is None or f > best[1] + 1e-12:
            best = (t, f)
    table = spark.createDataFrame([(s, sorted(c)) for s, c in truth.items()], "sid string, trues array<string>")
    r = metrics.tuned(pairs(spark, *rows), table).first()
    assert (r["threshold"], r["macro_f05"]) == (best[0], pytest.approx(best[1], abs=1e-8))


def entities(spark, rows):
    return spark.createDataFrame(rows, "entity_id string, country string, ord long, sorted_core string, core_name string")


def test_bucket_cap_keeps_the_first_in_order(spark):
    s1 = entities(spark, [("S1-1", "us", 0, "acme", "acme")])
    other = entities(spark, [(f"S2-{i:02}", "us", 99 - i, "acme", "acme") for i in range(40)] + [("S2-x", "fr", 0, "acme", "acme")])
    got = blocking.key_pairs(s1, other, "exact").collect()
    assert [r["cid"] for r in sorted(got, key=lambda r: r["pos"])] == [f"S2-{i:02}" for i in range(39, 9, -1)]


def test_priority_and_union(spark):
    rows = [("a", f"c{i:02}", p, 0, i) for i in range(20) for p in (0, 1)]
    got = blocking.prioritised(spark.createDataFrame(rows, "sid string, cid string, pass int, k int, pos int"))
    assert sorted(r["cid"] for r in got.collect()) == [f"c{i:02}" for i in range(15)]
    one = spark.createDataFrame([("a", "x", 1)], "sid string, cid string, pos int")
    both = blocking.union_pairs([one, one.select("sid", "cid")]).collect()
    assert [(r["sid"], r["cid"], r["pass"]) for r in both] == [("a", "x", 0)]


def test_empty_inputs(spark):
    none = pairs(spark)
    assert resolve.claimed(none, 0.5).count() == 0
    truth = spark.createDataFrame([], "sid string, trues array<string>")
    assert metrics.macro(metrics.scored_entities(truth, spark.createDataFrame([], "sid string, cids array<string>"))).first()["macro_f05"] == 0.0
    assert metrics.tuned(none, truth).first()["threshold"] == 0.3
    assert metrics.blocking_quality(none, none, 0, 0).first()["recall"] == 1.0


def test_downsampling(spark):
    rows = [(f"s{i}", "c", 1 if i < 3 else 0) for i in range(50)]
    df = spark.createDataFrame(rows, "sid string, cid string, label int")
    got = model.downsampled(df, least=0).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in got} == {1: 3, 0: 12}
    assert model.downsampled(df).count() == 50
    assert model.class_weight(df) == pytest.approx(47 / 3)


def test_trees_learn_and_reload(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"s{i % 60}", f"c{i}", float(i % 2) + rng.gauss(0, 0.2), i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "sid string, cid string, x double, label int")
    models = model.trained(df, ["x"], folds=2, rounds=3, depth=2)
    scored = model.out_of_fold(models, df, ["x"])
    means = {r["label"]: r["avg(score)"] for r in scored.groupBy("label").avg("score").collect()}
    assert scored.count() == 300 and means[1] - means[0] > 0.3
    folds = scored.groupBy("sid").agg(F.count_distinct("fold").alias("n")).agg(F.max("n")).first()[0]
    assert folds == 1
    model.saved(models, 0.7, ["x"], str(tmp_path))
    again, threshold, columns = model.loaded(spark, str(tmp_path))
    a = {r["cid"]: r["score"] for r in model.ensemble(models, df, ["x"]).collect()}
    b = {r["cid"]: r["score"] for r in model.ensemble(again, df, columns).collect()}
    assert threshold == 0.7 and a == b


def test_tsv_round_trip(spark, tmp_path):
    (tmp_path / "in.tsv").write_text('S1_ID\tBusiness_Name\tcountry\nS1-1\tA "q" B\tNA\nS1-2\t"x ""y"""\t\n', encoding="utf-8")
    got = tables.read_entities(spark, str(tmp_path / "in.tsv")).collect()
    assert [tuple(r) for r in got] == [("S1-1", 'A "q" B', "", ""), ("S1-2", 'x "y"', "", "")]
    (tmp_path / "gt.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1, S3-2,\nS1-2\t\n", encoding="utf-8")
    truth = tables.read_truth(spark, str(tmp_path / "gt.tsv"))
    assert [(r["sid"], r["trues"], r["n_matches"]) for r in truth.collect()] == [("S1-1", ["S2-1", "S3-2"], 2), ("S1-2", [], 0)]
    ents = spark.createDataFrame([("S1-2", 0), ("S1-1", 1)], "entity_id string, ord int")
    lists = truth.select("sid", F.col("trues").alias("cids"))
    tables.write_submission(ents, lists, lists, str(tmp_path / "out"))
    (part,) = (tmp_path / "out" / "matching_results").glob("part-*.csv")
    assert part.read_text().splitlines() == ["source1_entity_id\tmatched_entity_ids", "S1-2\t", "S1-1\tS2-1,S3-2"]
    merged = tables.merged([tables.read_tsv(spark, str(tmp_path / "out" / "matching_results"))] * 2)
    assert merged.count() == 4


def test_validator(spark):
    ids = spark.createDataFrame([("S1-1",), ("S1-2",)], "entity_id string")
    good = spark.createDataFrame([("S1-1", ["S2-1"]), ("S1-2", [])], "sid string, cids array<string>")
    assert validate.valid(ids, good, good)
    bad = spark.createDataFrame([("S1-1", ["S2-9"]), ("S1-1", ["S1-2"])], "sid string, cids array<string>")
    broken = {r["issue"] for r in validate.issues(ids, good, bad).where("n > 0").collect()}
    assert broken == {"matches: expected entity without a row", "matches: repeated row", "matches: id of the first source in a list", "matches: id that isn't a candidate"}


def test_record_store(spark):
    rec = spark.createDataFrame([("a", None), ("b", "inc")], "entity_id string, suffix string").withColumn("postal_code", F.lit(None).cast("string"))
    tables.record_store(rec, "records_test", 4)
    got = tables.lookup(spark.table("records_test"), spark.createDataFrame([("a",), ("q",)], "entity_id string")).collect()
    assert [(r["entity_id"], r["suffix"], r["postal_code"]) for r in got] == [("a", None, None)]
    spark.sql("drop table records_test")


def test_nearest_texts_over_many_packs(spark, monkeypatch):
    """Every pack meets every other without copies of rows (F1, F2); copies, one-letter words, no words, no common n-gram."""
    import math
    from collections import Counter

    from weftlink.operators import nearest

    monkeypatch.setattr(nearest, "ASKED", 40)
    monkeypatch.setattr(nearest, "THERE", 30)
    rng = random.Random(3)
    words = ["".join(rng.choice("abcde") for _ in range(rng.choice((1, 1, 2, 3, 5, 9)))) for _ in range(40)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(6))) for _ in range(150)] + ["copy of copy"] * 30 + ["zzz"]
    rows = [(f"S{1 + i % 2}-{i:03d}", t[: len(t) // 2].strip(), t[len(t) // 2 :].strip()) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "entity_id string, normalized_name string, normalized_addr string")
    got = blocking.tfidf_pairs(df.where("entity_id < 'S2'"), df.where("entity_id > 'S2'"), 5)
    assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()
    tf = {i: Counter(f" {w} "[j : j + n] for w in f"{a} {b}".split() for n in (3, 4, 5) for j in range(len(w) + 3 - n)) for i, a, b in rows}
    df_of = Counter(g for c in tf.values() for g in c)
    raw = {i: {g: n * (math.log((1 + len(rows)) / (1 + df_of[g])) + 1) for g, n in c.items()} for i, c in tf.items()}
    norm = {i: math.sqrt(sum(x * x for x in v.values())) for i, v in raw.items()}
    want = set()
    for i, v in raw.items():
        if i < "S2":
            sims = [(-round(sum(x * w[g] for g, x in v.items() if g in w) / norm[i] / norm[c], 9), c) for c, w in raw.items() if c > "S2" and v.keys() & w.keys()]
            want |= {(i, c, round(-s, 6), r) for r, (s, c) in enumerate(sorted(sims)[:5], 1)}
    assert {(r["sid"], r["cid"], round(r["sim"], 6), r["rank"]) for r in got.collect()} == want


def test_nearest_of_all_over_many_cells(spark, monkeypatch):
    """Ties, zeros and rows of both sides, in cells of a few rows each: what one cell finds, and plain loops."""
    import numpy as np

    from weftlink.operators import blocking

    monkeypatch.setattr(blocking, "EMBEDDING_BLOCK", 30)
    rng = np.random.default_rng(5)
    rows = [(f"e{i:03d}", [float(x) for x in rng.integers(-1, 2, 6)]) for i in range(120)]
    df = spark.createDataFrame(rows, "entity_id string, embedding array<float>")
    got = {}
    for r in blocking.embedding_pairs(df.limit(40), df, 5).collect():
        got.setdefault(r["sid"], {})[r["rank"]] = (r["cid"], None if r["sim"] is None else round(r["sim"], 6))
    for sid, u in rows[:40]:
        if any(u):
            sims = sorted((-round(float(np.dot(u, v) / np.linalg.norm(u) / np.linalg.norm(v)), 9), c) for c, v in rows if c != sid and any(v))
            assert [got[sid][k] for k in range(1, 6)] == [(c, round(-s, 6)) for s, c in sims[:5]]


def test_nearest_in_chunks(monkeypatch):
    """A cell searched a few texts and summed a few rows at a time gives what one step gives."""
    import pickle

    import pyarrow as pa

    from weftlink.operators import nearest

    rng = random.Random(4)
    texts = sorted({" ".join(rng.choice("abc") * rng.randrange(1, 8) + rng.choice("xy") for _ in range(rng.randrange(1, 9))) for _ in range(90)})
    known = nearest.taken_apart(texts)[0]
    x = pa.table({"pack": pa.array([0] * len(texts), pa.int32()), "c": list(range(len(texts))), "t": texts, "ids": [[f"{i:02d}"] for i in range(len(texts))]})
    y = pa.table({"gram": known, "g": [7 * i for i in range(len(known))], "df": [1 + i % 9 for i in range(len(known))]})
    pack = pickle.loads(nearest.packed(x, y, 200)["blob"][0].as_py())
    whole = nearest.met(pack, pack, 4).to_pydict()
    monkeypatch.setattr(nearest, "Q", 7)
    monkeypatch.setattr(nearest, "ROWS", 5)
    parts = nearest.met(pack, pack, 4).to_pydict()
    assert len(whole["c"]) > 100
    assert (whole["c"], whole["cid"]) == (parts["c"], parts["cid"]) and max(abs(a - b) for a, b in zip(whole["sim"], parts["sim"], strict=True)) < 1e-12


def test_candidates_by_ngrams_copy_no_rows(spark):
    """The whole job's search (F2) doesn't deal rows out to every block of the other side."""
    from weftlink.plans import linkage

    df = spark.createDataFrame([("S1-1", "acme tools", "high road"), ("S2-1", "acme tool", "high road"), ("S2-2", "zzz", "qqq")], "entity_id string, normalized_name string, normalized_addr string")
    got = linkage.candidates(df.where("entity_id < 'S2'"), df.where("entity_id > 'S2'"), linkage.Config(passes=(), by_address=False, tfidf_k=2))
    assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert [(r["sid"], r["cid"]) for r in got.collect()] == [("S1-1", "S2-1")]

"""Operators against plain versions on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tests.llm.conftest import SCHEMA
from weftlink.llm import bpe, chunks, entry, fingerprint, hamming, langid, lmscore, mixing, packing, pii, simhash, suffixes

DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet").toPandas().set_index("doc_id")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("name", sorted(entry.ORACLE))
def test_oracle(spark, name):
    import glob
    import os

    db = duckdb.connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        db.execute(f"create view {os.path.basename(f)[:-8]} as from '{f}'")
    a, b = entry.QUERIES[name](spark, DIR).toPandas(), db.execute(entry.ORACLE[name]).df()
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    a, b = (Counter(tuple(round(float(v), 6) if not isinstance(v, str) else v for v in r) for r in x[cols].itertuples(index=False)) for x in (a, b))
    assert a == b


def test_sketches_estimate_the_share_of_shingles():
    rng = random.Random(21)
    words = lambda n: [f"w{rng.getrandbits(40):x}" for _ in range(n)]
    off, pairs = [], []
    for _ in range(150):
        a = words(200)
        b = list(a)
        for i in rng.sample(range(200), 5):
            b[i] = words(1)[0]
        pairs += [" ".join(a), " ".join(b)]
    texts = pa.array([*pairs, None, "", " \n", "a b", "A  b", "a c"])
    got, sets = simhash.sketches(texts), simhash.shingle_sets(texts)
    # each text's own, whatever stands beside it
    assert all((simhash.sketches(texts.slice(i, 1))[0] == got[i]).all() for i in range(len(texts)))
    places = lambda x: [[int(c) >> 4 * k & 15 for c in x for k in range(16)]]
    unlike = lambda i, j: sum(x != y for x, y in zip(places(got[i])[0], places(got[j])[0], strict=True))
    for i in range(0, len(pairs), 2):
        share = len(np.intersect1d(sets[i], sets[i + 1])) / len(np.union1d(sets[i], sets[i + 1]))
        off.append(unlike(i, i + 1) - 15 / 16 * (1 - share) * simhash.SKETCH)
        assert share < 0.8 or unlike(i, i + 1) <= simhash.UNLIKE
    assert abs(sum(off)) / len(off) < 2
    assert unlike(-3, -2) == 0 and unlike(-3, -1) > 200 and not got[-6:-3].any()


# op1, op6


def repeats(texts, n=51):
    """Documents that share n successive words with another."""
    where = defaultdict(set)
    for i, t in texts.items():
        w = WORD.findall(t or "")
        for at in range(len(w) - n + 1):
            where[" ".join(w[at : at + n])].add(i)
    return set().union(*(s for s in where.values() if len(s) > 1))


def planted():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(55)
    rows = [(i, text(120), "en", "a") for i in range(20)]
    rows += [(100 + i, f"{text(30 + i)} {passage} {text(40)}", "en", "a") for i in range(30)]
    rows += [(200, rows[0][1], "en", "a"), (201, f"{rows[1][1]} tail", "en", "a")]
    return rows


@pytest.mark.parametrize(("query", "part"), [("op1_substring_dedup", chunks), ("op6_suffix_array_dedup", suffixes)])
def test_repeated_passages(spark, docs, query, part):
    want = repeats(docs["text"].to_dict())
    assert want <= {r["doc_id"] for r in entry.QUERIES[query](spark, DIR).collect()}
    rows = planted()
    got = part.repeated(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["doc_id"] for r in got} == {0, 1, 200, 201, *range(100, 130)}


def test_suffix_extents_are_exact(spark):
    rows = planted()
    for r in suffixes.repeated(spark.createDataFrame(rows, SCHEMA)).collect():
        if 100 <= r["doc_id"] < 130:
            start = 30 + r["doc_id"] - 100
            assert [(p["start"], p["stop"]) for p in r["passages"]] == [(start, start + 55)]


def test_suffix_passages_among_many_copies_of_their_middle(spark):
    rng = random.Random(11)
    text = lambda n: [f"w{rng.getrandbits(40):x}" for _ in range(n)]
    rows, want, add = [], {}, lambda words: rows.append((len(rows), " ".join(words), "en", "a"))
    for _ in range(12):
        # 56 words in two texts; 36 of them in 20 others
        middle, left, right = text(36), text(10), text(10)
        for n in (20, 35):
            want[len(rows)] = (n, n + 56)
            add(text(n) + left + middle + right + text(15))
        for _ in range(20):
            add(text(12) + middle + text(12))
        # 60 words in two texts; the middle 30 of them three times more in the first
        middle, left, right = text(30), text(15), text(15)
        want[len(rows)] = (7, 67)
        add(text(7) + left + middle + right + [w for _ in range(3) for w in text(9) + middle])
        want[len(rows)] = (3, 63)
        add(text(3) + left + middle + right + text(4))
    got = {r["doc_id"]: [(p["start"], p["stop"]) for p in r["passages"]] for r in suffixes.repeated(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: [w] for i, w in want.items()}


def test_suffix_passages_twice_in_one_document(spark):
    rng = random.Random(12)
    text = lambda n: " ".join(f"w{rng.getrandbits(40):x}" for _ in range(n))
    rows = []
    for i in range(30):
        passage = text(52)
        rows += [(2 * i, f"{passage} {text(20)} {passage} {text(6)}", "en", "a"), (2 * i + 1, f"{text(5)} {passage}", "en", "a")]
    got = {r["doc_id"]: [(p["start"], p["stop"], list(p["others"])) for p in r["passages"]] for r in suffixes.repeated(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i in range(30):
        assert got[2 * i] == [(0, 52, [2 * i + 1]), (72, 124, [2 * i + 1])] and got[2 * i + 1] == [(5, 57, [2 * i])]


@given(st.binary(max_size=3000), st.binary(min_size=1, max_size=20), st.integers(0, 3000))
@settings(max_examples=60, deadline=None)
def test_cuts_depend_on_what_is_near(data, new, at):
    at = min(at, len(data))
    a, b = chunks.cuts(data), chunks.cuts(data[:at] + new + data[at:])
    assert [e for e in a if e < at] == [e for e in b if e < at]
    after = at + chunks.WINDOW
    assert {e + len(new) for e in a if e > after} - {len(data) + len(new)} == {e for e in b if e > after + len(new)} - {len(data) + len(new)}


def test_chunks_stay_in_their_first_document(spark):
    rng = random.Random(31)
    text = lambda n: " ".join(f"w{rng.getrandbits(40):x}" for _ in range(n))
    a, b, d = text(60), text(60), text(60)
    texts = {1: f"{a} {b}", 2: f"{a} {d} {b}", 3: f"{a} {d} {b}"}
    got = {r["doc_id"]: r["passages"] for r in chunks.repeated(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    left = dict.fromkeys(texts, b"")
    for i, t in texts.items():
        data, at = t.encode(), 0
        for s in sorted((s["start"], s["stop"]) for p in got[i] for s in p["dropped"]):
            left[i] += data[at : s[0]]
            at = s[1]
        left[i] += data[at:]
    assert a.encode() in left[1] and b.encode() in left[1]
    # all chunks inside the insertion stay in document 2 alone
    assert d.encode()[200:-200] in left[2] and a.encode()[200:-200] not in left[2]
    assert left[3] == b"" and not any(s["dropped"] for s in got[1])


def test_no_chunk_is_dropped_everywhere(spark, tmp_path):
    rng = random.Random(32)
    text = lambda n: " ".join(f"w{rng.getrandbits(40):x}" for _ in range(n))
    a, b, d = text(60), text(60), text(60)
    texts = {1: f"{a} {b}", 2: f"{a} {d} {b}", 3: f"{a} {d} {b}"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    dropped = {r["doc_id"]: r["dropped_bytes"] for r in chunks.op1_substring_dedup(spark, str(tmp_path)).collect()}
    assert dropped[1] == 0 and dropped[3] == len(texts[3])
    # what document 2 adds stays there
    assert len(texts[2]) - dropped[2] >= len(d)


def test_gear_by_the_byte():
    rng = random.Random(2)
    data = bytes(rng.randrange(256) for _ in range(5000))
    table, ends = chunks.gear(), []
    for i in range(len(data)):
        h = sum(int(table[data[i - k]]) << k for k in range(min(16, i + 1))) & 0xFFFF
        if h < 65536 // chunks.AVERAGE:
            ends.append(i + 1)
    assert chunks.cuts(data).tolist() == sorted({*ends, 5000})


def test_all_minimisers_of_all_windows():
    h = np.random.default_rng(1).integers(0, 1 << 40, 300).astype(np.uint64)
    grams = suffixes.spans_hash(h, suffixes.GRAM)
    want = set()
    for i in range(len(grams) - suffixes.WINDOW + 1):
        w = grams[i : i + suffixes.WINDOW].tolist()
        want.add(i + max(j for j, x in enumerate(w) if x == min(w)))
    assert suffixes.minimisers(h).tolist() == sorted(want)


# op2


def test_fingerprints(spark, docs):
    got = fingerprint.op2_document_fingerprints(spark, DIR).toPandas().set_index("doc_id").sort_index()
    ids = sorted(docs.index)
    for i, after in zip(ids, [*ids[1:], ids[0]], strict=True):
        t, n = docs.text[i], len(docs.text[i])
        edited = t[: n - n // 2] + docs.text[after][: n // 2]
        assert got.n_chars[i] == n and got.edited_sha256[i] == hashlib.sha256(edited.encode()).hexdigest()
        assert (got.near_edited[i] == 1) == (edited == t)
    by_text = defaultdict(set)
    for i in ids:
        by_text[docs.text[i]].add(got.fingerprint[i])
    assert all(len(v) == 1 for v in by_text.values()) and len({min(v) for v in by_text.values()}) == len(by_text)


def test_many_buckets_give_the_same_neighbours(spark):
    rows = [(i * 7 - 300, f"text {i}") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: r["next_text"] for r in fingerprint.with_next(df, {}, rows=9).collect()}
    assert got == {i: rows[(k + 1) % 100][1] for k, (i, _) in enumerate(rows)}


def test_branches_name_the_section(spark):
    from pyspark.sql import functions as F

    a, b = "one\ntwo\n\nthree\n\nfour", "one\ntwo\n\nthree!\n\nfour"
    df = spark.createDataFrame([(a, b, a + "\n")], "a string, b string, c string").select(*[fingerprint.fingerprint(F.col(c)).alias(c) for c in "abc"])
    r = df.select(fingerprint.differing_sections(F.col("a"), F.col("b")).alias("d"), "a", "c").first()
    assert list(r["d"]) == [1] and r["a"] != r["c"]


# op3


def test_top_k_with_copies(spark):
    rng = random.Random(3)
    codes = [rng.getrandbits(64) for _ in range(40)]
    rows = [(i, rng.choice(codes) ^ (1 << rng.randrange(64) if rng.random() < 0.5 else 0)) for i in range(300)] + [(i, codes[0]) for i in range(300, 400)]
    signed = [(i, c - (1 << 64) if c >> 63 else c) for i, c in rows]
    df = spark.createDataFrame(signed, "id long, code long")
    got = defaultdict(list)
    for r in hamming.top_k(df, df.where("id % 50 = 0"), 5).collect():
        got[r["query_id"]].append((r["rank"], r["distance"], r["id"]))
    for q, c in rows[::50]:
        want = sorted(((c ^ x).bit_count(), i) for i, x in rows)[:5]
        assert sorted(got[q]) == [(k + 1, *w) for k, w in enumerate(want)]


@pytest.mark.parametrize("spread", [2, 64])
def test_top_k_of_many_codes(spark, spread):
    """More codes than a step has probes; clusters, where radii stay small, and random codes, where they grow."""
    rng = random.Random(33)
    centres = [rng.getrandbits(64) for _ in range(50)]
    codes = [rng.choice(centres) if spread < 64 else 0 for _ in range(4500)]
    for i in range(4500):
        for b in rng.sample(range(64), rng.randrange(spread + 1)) if spread < 64 else [b for b in range(64) if rng.random() < 0.5]:
            codes[i] ^= 1 << b
    df = spark.createDataFrame([(i, c - (1 << 64) if c >> 63 else c) for i, c in enumerate(codes)], "id long, code long")
    got = defaultdict(list)
    for r in hamming.top_k(df, df.where("id % 50 = 0"), 10).collect():
        got[r["query_id"]].append((r["rank"], r["distance"], r["id"]))
    assert len(got) == 90
    for q, c in list(enumerate(codes))[::50]:
        want = sorted(((c ^ x).bit_count(), i) for i, x in enumerate(codes))[:10]
        assert sorted(got[q]) == [(k + 1, *w) for k, w in enumerate(want)]


# op4


def plain_simhash(text):
    w = WORD.findall(lower(text))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def classes(prints, radius=2):
    ids, parent = sorted(prints), {}

    def find(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius and find(a) != find(b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


def test_simhash(spark, docs):
    prints = {i: plain_simhash(t) for i, t in docs.text.items()}
    want = classes(prints)
    for r in simhash.op4_simhash_near_dedup(spark, DIR).collect():
        assert r["fingerprint"] == f"{prints[r['doc_id']]:016x}" and r["component_id"] == want[r["doc_id"]]


@pytest.mark.parametrize("hot", [1, 4, simhash.HOT])
@pytest.mark.parametrize("radius", [1, 2])
def test_links_over_chains(spark, radius, hot):
    rng = random.Random(7)
    prints = {}
    for start in range(20):
        c = rng.getrandbits(64)
        for i in range(12):
            prints[start * 100 + i] = c
            for _ in range(rng.randrange(4)):
                c ^= 1 << rng.randrange(64)
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in prints.items()]
    df = spark.createDataFrame(signed, "doc_id long, fp long")
    found = simhash.components(simhash.links(df.select("fp").distinct(), radius, hot)).collect()
    of = {r["node"]: r["component"] for r in found}
    groups = defaultdict(set)
    for i, p in signed:
        groups[of.get(p, p)].add(i)
    want = defaultdict(set)
    for i, c in classes(prints, radius).items():
        want[c].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("hot", [3, simhash.HOT])
def test_links_of_large_groups(spark, hot):
    """Hundreds of distinct fingerprints around one centre share the values of a segment; no link is lost."""
    rng = random.Random(71)
    centre = rng.getrandbits(64)
    prints = {centre}
    while len(prints) < 400:
        prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    prints |= {rng.getrandbits(64) for _ in range(100)}
    prints = dict(enumerate(sorted(prints)))
    signed = {p - (1 << 64) if p >> 63 else p: i for i, p in prints.items()}
    links = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), 2, hot)
    of = {r["node"]: r["component"] for r in simhash.components(links).collect()}
    groups, want = defaultdict(set), defaultdict(set)
    for p, i in signed.items():
        groups[of.get(p, p)].add(i)
    for i, c in classes(prints).items():
        want[c].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values())) and len(want) < 450


def shingles(text, n=5):
    w = WORD.findall(lower(text))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def resembling(texts, least=0.8):
    """Groups of texts linked by their share of common shingles, by comparing all with all."""
    sets, of = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}
    by = defaultdict(set)
    for i, s in sets.items():
        for x in s or {()}:
            by[x].add(i)

    def find(i):
        while of[i] != i:
            i = of[i]
        return i

    for i in sets:
        for j in set().union(*(by[x] for x in sets[i] or {()})):
            both = len(sets[i] & sets[j])
            if both >= least * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                of[b] = a
    return {i: find(i) for i in sets}


def edited(rng, text, share):
    return " ".join(f"n{rng.getrandbits(30):x}" if rng.random() < share else w for w in text.split())


def grouping(of):
    groups = defaultdict(set)
    for i, c in of.items():
        groups[c].add(i)
    return sorted(map(sorted, groups.values()))


def test_near_copies_by_shingles(spark):
    rng = random.Random(81)
    word = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(word) for _ in range(n))
    texts = [text(rng.randint(150, 500)) for _ in range(60)]
    for i in range(60):
        texts += [edited(rng, texts[i], share) for share in (0.005, 0.01, 0.015)]
    centre = text(300)
    texts += [edited(rng, centre, 0.008) for _ in range(500)]  # one large group
    texts += ["", None, " ", "one", "One", "one two", "a b c d e", "A b c d e", "a b c d e f"]
    texts = dict(enumerate(texts))
    want = resembling(texts)
    got = {r["doc_id"]: r["component"] for r in simhash.resembling(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)).collect()}
    assert len(grouping(want)) < 200 and len(grouping(got)) <= len(grouping(want)) + 5
    # what is linked is linked rightly; of the links nearly all are found
    assert all(want[i] == want[got_first] for i, got_first in ((i, min(j for j in got if got[j] == c)) for i, c in got.items()))


def test_large_groups_of_distant_copies_are_linked_whole(spark):
    """Most pairs of the group share less than 0.8, so its links are few and any text may have the only one."""
    rng = random.Random(82)
    centre = " ".join(f"w{rng.getrandbits(30):x}" for _ in range(60))
    texts = dict(enumerate(edited(rng, centre, 0.03) for _ in range(500)))
    want = resembling(texts)
    got = {r["doc_id"]: r["component"] for r in simhash.resembling(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)).collect()}
    assert 100 < len(grouping(want)) < 400 and grouping(got) == grouping(want)


def test_every_text_under_a_key_is_linked(spark):
    """However many share a key: one link each, none dropped, no pairs."""
    rows = [(i, [7, 100 + i]) for i in range(2000)] + [(5000, [100 + 3]), (6000, [1]), (6001, [])]
    links = {(r["a"], r["b"]) for r in simhash.loose_links(spark.createDataFrame(rows, "node long, keys array<long>")).collect()}
    assert links == {(i, 0) for i in range(1, 2000)} | {(5000, 3)}


def test_classes_of_sets_by_loops():
    rng = random.Random(83)
    for n in (1, 2, 60, 300):
        sets = [np.array(sorted(rng.sample(range(24), rng.randint(15, 20))), np.uint64) for _ in range(n)] + [np.zeros(0, np.uint64)]
        want = list(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((want[i], want[j]))
                    want = [a if c == b else c for c in want]
        assert simhash.near_classes(sets).tolist() == want


def test_wide_prints_by_loops():
    import pyarrow as pa

    texts = ["a b c a b", "", None, "one", " x  y ", "é ü é"]
    key, fp = simhash.wide_prints(pa.array(texts))
    one, other = simhash.wide_prints(pa.array(["zz", *texts]).slice(1))
    assert (key == one).all() and (fp == other).all() and len({tuple(k) for k in key.tolist()}) == 5
    for t, row in zip(texts, fp.tolist(), strict=True):
        h = [int(x) for x in simhash.mix(*(np.array([plain_key(w)[k] for w in WORD.findall(lower(t))], np.int64) for k in range(2)))]
        joined = [int(simhash._stirred(np.array([(a * int(simhash._SEEDS[0]) + b) % (1 << 64)], np.uint64))[0]) for a, b in zip(h, h[1:], strict=False)] or h
        for k in range(simhash.LONG // 2):
            x = [int(simhash._stirred(np.array([v ^ int(simhash._SEEDS[k])], np.uint64))[0]) for v in joined]
            assert row[k] == sum(1 << b for b in range(64) if sum(v >> b & 1 for v in x) * 2 > len(x))


def test_dedup_keeps_one_row_of_each_group(spark):
    rng = random.Random(21)
    text = lambda: " ".join(f"w{rng.getrandbits(30):x}" for _ in range(60))
    rows = [(None if i % 3 == 0 else i % 7, text()) for i in range(90)]  # unrelated texts, ids missing or repeated
    rows += [(i, rows[k][1]) for i, k in ((500, 0), (501, 1), (None, 2), (None, 3), (None, 3), (3, 4))]
    rows += [(None, None), (None, ""), (8, None)]
    got = simhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {}
    for i, t in rows:
        want.setdefault(t or "", []).append((i is None, i or 0))
    assert len(got) == len(want)
    assert {r["text"] or "": (r["doc_id"] is None, r["doc_id"] or 0) for r in got} == {k: min(v) for k, v in want.items()}


# op5


def test_mix_of_few_sources(spark):
    rows = [(i, "w " * (1 + i % 17), "en", s) for i in range(600) for s in [("a", "b", "c", None)[min(3, i % 7)]]]
    got = mixing.copies(spark.createDataFrame(rows, SCHEMA)).toPandas()
    total = got["size"].sum()
    by = got.assign(taken=got["size"] * got["copies"]).groupby("source_size", as_index=False).agg(target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))
    assert abs(by.target.sum() - 1.5 * total) < 1e-6 and (by.target <= 2 * by.source_size + 1e-9).all()
    assert ((by.taken - by.target).abs() <= by.most / 2 + 1e-9).all()
    n = mixing.mixed(spark.createDataFrame(rows, SCHEMA)).groupBy("doc_id").count().toPandas().set_index("doc_id")["count"]
    assert all(n.get(r.doc_id, 0) == r.copies for r in got.itertuples())


def test_mix_of_rows_without_ids(spark):
    """Rows that share an id, or are equal throughout, are still taken one by one."""
    rng = random.Random(61)
    rows = [(None, "word", "en", "a")] * 1500 + [(7, " ".join("w" * rng.randint(1, 9) for _ in range(rng.randint(1, 5))), "en", "b") for _ in range(700)]
    rows += [(None, f"x{i}", "en", "c") for i in range(200)]
    got = mixing.copies(spark.createDataFrame(rows, SCHEMA).repartition(5)).toPandas()
    by = got.assign(taken=got["size"] * got["copies"]).groupby("source_size").agg(target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))
    assert ((by.taken - by.target).abs() <= by.most / 2 + 1e-9).all() and len(by) == 3
    assert got.copies.between(0, 2).all()


# op7


def test_language(spark, docs):
    got = langid.op7_language_id(spark, DIR).toPandas().set_index("doc_id")
    assert all(got.held_out[i] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in docs.index)
    held = got[got.held_out]
    assert (held.lang_pred == docs.lang[held.index]).mean() > 0.95
    assert got.score.between(0, 1).all()


def test_every_language_is_learned(spark):
    rng = random.Random(41)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 70 * 6)]
    text = lambda k: " ".join("".join(rng.choice(letters[6 * k : 6 * k + 6]) for _ in range(4)) for _ in range(12))
    rows = [(1000 * k + i, text(k), f"x{k:02}") for k in range(70) for i in range(8 if k else 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = df.select("lang", langid.predicted(langid.train(df), spark).alias("p")).select("lang", "p.lang_pred").collect()
    assert {r["lang"] for r in got if r["lang"] != r["lang_pred"]} == set()


def test_languages_with_missing_or_repeated_ids_are_learned(spark):
    rng = random.Random(42)
    text = lambda s: " ".join("".join(rng.choice(s) for _ in range(4)) for _ in range(6))
    rows = [(None, text("abcde"), "a") for _ in range(6000)] + [(8, text("fghij"), "b") for _ in range(6000)] + [(i, text("klmno"), "c") for i in range(40)]
    rows += [(9, "pqrst tsrqp", "d")] * 6000 + [(10, "rstpq qpstr", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    m = langid.train(df)
    assert m["langs"] == ["a", "b", "c", "d"]
    few = df.where("lang <> 'd'").sample(0.05, seed=1).unionByName(df.where("lang = 'd'").distinct())
    got = few.select("lang", langid.predicted(m, spark).alias("p")).select("lang", "p.lang_pred").collect()
    assert {r["lang"] for r in got} >= {"a", "b", "d"} and all(r["lang"] == r["lang_pred"] for r in got)


def test_language_counts_are_whole():
    text = "ab cd" * 40_000
    n = langid.counts(text)
    assert n.sum() == 3 * (len(langid.counts.__name__) * 0 + len(text) + 2) - 3
    assert langid.counts("12 !") is None and langid.counts(None) is None


# op8


def test_scores(spark, docs):
    got = lmscore.op8_lm_scoring(spark, DIR).toPandas().set_index("doc_id")
    tokens = {i: [*WORD.findall(lower(t)), None] for i, t in docs.text.items()}
    c = Counter()
    for i, w in tokens.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            c.update(w)
    n, v = sum(c.values()), len(c)
    for i, w in tokens.items():
        assert got.n_tokens[i] == len(w) and got.n_known[i] == sum(c[x] > 0 for x in w) and got.train_tokens[i] == n
        assert got.base_score[i] == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


def plain_key(word):
    """lo, hi (signed) and other of a word."""
    raw, low = word.encode(), (1 << 64) - 1
    x = int.from_bytes(raw, "little") | len(raw) << 120 if len(raw) <= 15 else xxhash.xxh3_128_intdigest(raw) | 0xFF << 120
    lo, hi = x & low, x >> 64
    m = (lo ^ (hi * 0x9E3779B97F4A7C15 & low)) * 0xBF58476D1CE4E5B9 & low
    m = (m ^ m >> 31) * 0x94D049BB133111EB & low
    other = (raw[-1] + (raw[-2] if len(raw) > 1 else 0) * 263) % lmscore.BY_FORM * 4096 + ((m ^ m >> 29) >> 52)
    return *(v - (1 << 64) if v >> 63 else v for v in (lo, hi)), other


def plain_scores(docs, share):
    """op8 by dictionaries and loops; share tells the round of an id. Only the k-means is the module's."""
    tokens = {i: WORD.findall(lower(t)) for i, t in docs.items()}
    learn = [i for i in docs if zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(w for i in learn for w in tokens[i])
    other = {w: plain_key(w)[2] for t in tokens.values() for w in t}
    head = sorted(c, key=lambda w: (-c[w], plain_key(w)[1::-1]))
    n, width = min(len(head), lmscore.CLUSTERED), min(len(head), lmscore.CONTEXTS) + 1
    place = {w: k for k, w in enumerate(head)}
    near = np.zeros((n, width), np.float32)
    for i in learn:
        at = [place[w] for w in tokens[i]] + [width]  # the end stands near words, too
        for x, k in enumerate(at[:-1]):
            for y in (x - 2, x - 1, x + 1, x + 2):
                if k < n and 0 <= y < len(at):
                    near[k, min(at[y], width - 1)] += 1
    m = np.sqrt(near)
    m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)
    weight = 1 / np.sqrt(np.arange(1, n + 1))
    of = lmscore._centred(m, weight, min(lmscore.LEARNED, n)) + 1
    where = {}
    for k in set(of.tolist()):
        own = np.flatnonzero(of == k)
        for j, part in zip(own.tolist(), lmscore._centred(m[own], weight[own], min(lmscore.INNER, len(own))).tolist(), strict=True):
            where[head[j]] = (k, part)

    def both(w):
        if w is None:
            return (0, 0)
        if w in where:
            return where[w]
        return (1 + lmscore.LEARNED + other[w] // 4096, other[w] % 4096 // 256)

    def steps(i):
        past = [None] * 3
        for w in [*tokens[i], None]:
            a, b, d = (lmscore.START if x is None else both(x)[0] for x in past[::-1][:3])
            slot = 0 if past[-1] is None else other[past[-1]] % 4096
            k, part = both(w)
            yield w, k, part, (("w", slot), ("n", a, b), ("s", b, d)), (("w", k, slot % 512), ("n", k, a), ("s", k, b))
            past.append(w)

    seen, distinct = Counter(), Counter()
    for w, times in [*c.items(), (None, len(learn))]:
        seen[both(w)] += times
        distinct[both(w)] += 1
    inside = {x: seen[x] + distinct[x] + (lmscore.FORM <= x[0] < lmscore.START) for x in {*seen, *((k, p) for k in range(lmscore.FORM, lmscore.START) for p in range(16))}}
    mass = {x: seen[x] + 0.5 for x in inside}
    outer_mass = {k: sum(v for x, v in mass.items() if x[0] == k) for k in {x[0] for x in inside}}

    def shares(bias, weights, features):
        e = {y: v * math.exp(sum(weights[f, y] for f in features)) for y, v in bias.items()}
        return {y: v / sum(e.values()) for y, v in e.items()}

    inner_mass = {k: {p: v for (j, p), v in mass.items() if j == k} for k in outer_mass}
    models = defaultdict(float), defaultdict(float)
    for turn in range(lmscore.ROUNDS):
        sums = defaultdict(float), defaultdict(float)
        expected = defaultdict(float), defaultdict(float)
        for i in learn:
            if share[i] == turn:
                for _, k, part, f, g in steps(i):
                    for level, y, features, bias in ((0, k, f, outer_mass), (1, part, g, inner_mass[k])):
                        p = shares(bias, models[level], features)
                        for x in features:
                            sums[level][x, y] += 1
                            for z, v in p.items():
                                expected[level][x, z] += v
        for level in (0, 1):
            for x, v in expected[level].items():
                models[level][x] += lmscore.STEP * math.log1p((sums[level][x] - v) / (v + lmscore.SMOOTH))
    out = {}
    for i in docs:
        total = 0.0
        for w, k, part, f, g in steps(i):
            times = len(learn) if w is None else c[w]
            total += math.log10(shares(outer_mass, models[0], f)[k] * shares(inner_mass[k], models[1], g)[part] * (times + 1) / inside[k, part])
        out[i] = total
    return out


def test_scores_of_the_model(spark):
    from pyspark.sql import functions as F

    rng = random.Random(51)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    docs = {i: " ".join(vocabulary[min(int(rng.expovariate(0.08)), 59)] for _ in range(rng.randint(0, 40))) for i in range(60)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    share = {r["doc_id"]: r["s"] for r in df.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(lmscore.ROUNDS)).alias("s")).collect()}
    want = plain_scores(docs, share)
    got = {r["doc_id"]: r["score"] for r in lmscore.scored(df).collect()}
    assert got == {i: pytest.approx(s, rel=1e-4, abs=1e-4) for i, s in want.items()}


def test_words_outside_of_the_head(spark):
    """With a head of 40 words, most are met in the join."""
    rng = random.Random(52)
    docs = {i: " ".join(f"w{rng.randrange(300)}" for _ in range(30)) for i in range(50)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    c = Counter(w for t in docs.values() for w in t.split())
    key = {plain_key(w)[:2]: w for w in c}
    vocabulary = lmscore.counted(df)
    assert {(key[r["lo"], r["hi"]], r["other"]) if r["hi"] is not None else None: r["c"] for r in vocabulary.collect()} == {(w, plain_key(w)[2]): k for w, k in c.items()} | {None: 50}
    head, others = lmscore.headed(vocabulary, 40)
    own = {key[a, b]: k for a, b, k in zip(head.lo.tolist(), head.hi.tolist(), head.counts.tolist(), strict=True)}
    rest = {key[r["lo"], r["hi"]]: r["c"] for r in others.collect()}
    assert 30 <= len(own) <= 40 and own | rest == c and min(own.values()) >= max(rest.values())
    place = {w: k for k, w in enumerate(own)}
    for r in lmscore.numbered(df, head).collect():
        w = docs[r["doc_id"]].split()
        assert r["codes"] == [*(place.get(x, lmscore.HEAD + plain_key(x)[2]) for x in w), lmscore.LAST]
        assert {key[a, b]: k for a, b, k in zip(r["lo"], r["hi"], r["times"], strict=True)} == Counter(x for x in w if x not in own)


@given(st.lists(st.text(st.sampled_from("aAZ z\t\x0b\x00\x1fé\u00a0\u2028\U0001f600-"), max_size=60) | st.none(), max_size=8))
@settings(max_examples=200, deadline=None)
def test_split(texts):
    import pyarrow as pa

    whole = pa.array(["x", *texts, "yz"], pa.string())
    lo, hi, other, sizes = lmscore.split(whole.slice(1, len(texts)))
    want = [WORD.findall(lower(t)) for t in texts]
    assert sizes.tolist() == [len(w) for w in want]
    assert list(zip(lo.tolist(), hi.tolist(), other.tolist(), strict=True)) == [plain_key(x) for w in want for x in w]


# op9

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0


def plain_spans(text):
    out = []
    for place, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")), "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), place, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_base_spans(spark, docs, tmp_path):
    rng = random.Random(3)
    alphabet = "a1.@ -+(0%\U0001f600é9\n_)"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    texts += ["1.2.3.4.5.6.7.8 +1 (555) 555-0100", "a@b.c%d@e.f", "4111 1111 1111 1111 x 4111111111111111", "a." * 300 + "@b" + ".c" * 300, "+" * 300 + "+1-----", "0001.2.3.4 256.1.1.1"]
    texts += docs.text.tolist()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    for r in pii.op9_pii(spark, str(tmp_path)).collect():
        want = plain_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert set(want.split(",")) - {""} <= set(r["spans"].split(","))
        assert [r[f"n_{k}"] for k in BASE] == [want.count(f"{k}:") for k in BASE]


def test_contexts_find_unseen_identifiers(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    for i in range(60):
        rows.append((i, f"{word()} {word()} reach me by mail: {word()}{i}@host.org {word()} {word()} cost 12{i} {word()}"))
    rows.append((900, f"{word()} reach me by mail: bob77_at_host {word()}"))
    rows.append((901, f"{word()} nothing here but 4.0 and 77 {word()}"))
    got = {r["doc_id"]: r for r in pii.extracted(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    learned = [(s["kind"], rows[60][1][s["start"] : s["stop"]]) for s in got[900]["learned"]]
    assert learned == [("email", "bob77_at_host")]
    assert all(not r["learned"] for i, r in got.items() if i != 900)


def test_contexts_are_cut_by_place(spark):
    """Neighbouring matches and long words don't change what stands before a place."""
    long = "v" * 300
    rows = [(1, f"pin 12 id77 and mail a@b.org c@d.org end {long} x9 {long} <e@f.org>, z")]
    (r,) = pii.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    text, base, words = rows[0][1], 0, rows[0][1].split()
    for s in [*r["base"], *r["other"]]:
        own = next(i for i, w in enumerate(words) if text[s["start"] : s["stop"]] in w)
        l2, l1 = ["", "", *words][own : own + 2]
        r1 = [*words, ""][own + 1]
        assert s["patterns"] == [f"L {l1}", f"LL {l2} {l1}", f"LR {l1} _ {r1}"]
        base += s["kind"] is not None
    assert base == 3 and len(r["other"]) == 3


def test_learned_instances_support_further_contexts(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = [f"{word()} {word()} reach me by mail: {word()}{i}@host.org {word()}" for i in range(80)]
    names = [f"{word()}7{i}_at_host" for i in range(12)]
    rows += [f"{word()} reach me by mail: {n} {word()}" for n in names]  # learned in the first round
    rows += [f"{word()} my own handle: {n} {word()}" for n in names]  # a context without any seed
    last = "y" * 50 + "9" * 30 + "zz"  # long, and only in the second context
    rows.append(f"{word()} my own handle: {last} {word()}")
    got = {r["doc_id"]: r["learned"] for r in pii.extracted(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert [[(s["kind"], rows[i][s["start"] : s["stop"]]) for s in got[i]] for i in range(80, 105)] == [[("email", n)] for n in [*names, *names, last]]


def test_redaction(spark):
    rows = [(1, "mail a.b@c.org or +1 (555) 555-0100!", 36), (2, "clean", 5), (3, None, None)]
    got = pii.redacted(spark.createDataFrame(rows, "doc_id long, text string, n_chars long")).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(1, "mail [EMAIL] or [PHONE]!", 24), (2, "clean", 5), (3, None, None)]


# op10


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def test_ids_are_the_librarys(tokenizer):
    rng = random.Random(1)
    alphabet = "aAbB'stredvml019.,!<|>éÉßÿÀ×÷ñ  \n\t\U0001f600Σςİ́ ªµ²endoftext"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += ["<|endoftext|>", "a<|endoftext|>b", "don't we'll I'd", "x" * 5000, "é" * 3000, "", ".'s"]
    words = packing._words(packing.VOCABULARY)
    assert words.merges
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in words.several(texts)] == want


def held(rows, ids):
    """The rules of a packing."""
    parts, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        parts[r["doc_id"]].append((r["start"], r["length"]))
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own)
        assert r["ids_crc32"] == zlib.crc32(np.array(own[r["start"] : r["start"] + r["length"]], "<u4").tobytes())
    for pieces in [*parts.values(), *bins.values()]:
        pieces.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:], strict=False)) and pieces[0][0] == 0
    assert {i: sum(n for _, n in p) for i, p in parts.items()} == {i: len(x) for i, x in ids.items()}
    return [sum(n for _, n in b) for b in bins.values()]


def test_packing(spark, docs, tokenizer):
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t in docs.text.items()}
    sizes = held(packing.op10_packing(spark, DIR).collect(), ids)
    assert all(n <= 4096 and n & (n - 1) == 0 for n in sizes)


def test_limits_on_segments_and_loss():
    rng = random.Random(2)
    packer = packing.Packer((64, 4, 40), cut=False, pool=32)
    sizes = [(rng.randint(1, 30), rng.random()) for _ in range(200)]
    for i, (n, share) in enumerate(sizes):
        packer.add(packing.Example(i, np.zeros(n, np.uint32), n, 0, int(n * share)))
    packer.flush()
    bins = defaultdict(list)
    for doc, start, n, _, total, seq, _ in packer.out:
        assert start == 0 and n == total
        bins[seq].append((n, n - int(n * sizes[doc][1])))
    assert sorted(d for d, *_ in packer.out) == list(range(200))
    assert all(sum(n for n, _ in b) <= 64 and len(b) <= 4 and sum(x for _, x in b) <= 40 for b in bins.values())


def test_byte_letters_are_a_bijection():
    assert len(set(bpe.byte_letters())) == 256


# pipeline


def test_pipeline(spark, docs, tokenizer):
    rows = corpus_pipeline.run(spark, DIR).toPandas()
    groups = resembling({i: t for i, t in docs.text.sort_index().items() if re.search(r"[^\W\d_]", t)})
    kept = {i for i, c in groups.items() if i == c}
    clean = {}
    for i in kept:
        t, out, at = docs.text[i], "", 0
        for kind, a, b in sorted((s.split(":") for s in plain_spans(t).split(",") if s), key=lambda s: (int(s[1]), int(s[2]))):
            if int(a) >= at:
                out += t[at : int(a)] + f"[{kind.upper()}]"
            at = max(at, int(b))
        clean[i] = out + t[at:]
    assert set(rows.doc_id) <= kept
    ids = {i: [*tokenizer.encode(clean[i], add_special_tokens=False).ids, 2] for i in set(rows.doc_id)}
    assert all(r.doc_tokens == len(ids[r.doc_id]) for r in rows.itertuples())
    size = {i: len(WORD.findall(t)) for i, t in clean.items()}
    copies = rows.groupby("doc_id").length.sum() / pd_lengths(ids)
    assert copies.isin([1, 2]).all()
    words = sum(size[i] * n for i, n in copies.items())
    assert 1.3 * sum(size.values()) < words < 1.7 * sum(size.values())
    sums = rows.groupby("sequence_id").length.sum()
    assert (sums <= 4096).all() and all(n & (n - 1) == 0 for n in sums)


def pd_lengths(ids):
    import pandas as pd

    return pd.Series({i: len(x) for i, x in ids.items()})

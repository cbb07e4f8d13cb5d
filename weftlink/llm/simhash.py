"""SimHash near-dedup over multi-index hashing.

Fingerprints are made in Python batches with numpy. For the links, a fingerprint is cut into two segments of 32
bits, and a table holds each distinct fingerprint under the value of each segment. Two fingerprints that differ
in r bits differ in r // 2 at most in one of the segments; so each enumerates the Hamming ball of radius r // 2
around its own value of each segment, fetches what the table holds there, and links to what is within r bits
of it as a whole.

A value of a segment is hot if more than HOT distinct fingerprints have it (a large group of near copies). It isn't
looked up, as all pairs would meet there. Fingerprints whose probes hit a hot value are looked up with the other
segment, too: under all 64 bits, with a flip of one bit at most on either side. At most 65 fingerprints lie within
one bit of such a key, all of them within 2 bits of one another, and each is linked to the least of them. So no link
is lost and no group's pairs are listed.

The table holds distinct fingerprints; links between them go to connected components; each document then
gets the component of its fingerprint. Exact copies never make links.

resembling() finds near copies by the share of common shingles, COMPARED words each. Candidates come from BANDS keys of
each text, each over DEEP of its SKETCH least hashes of shingles, 64 bits each: texts that share 0.8 of the shingles share
a key but for about one pair in 10^4, unrelated ones hardly ever. Under a key each text is linked to the least, so no pairs are listed,
nothing is capped, and whoever shares a key ends in one loose group. The texts of a loose group come together once, and
there their shingles are compared exactly: those not reached yet with each that was. So within a loose group no link is lost,
however large the group is and however few of its pairs are near. A loose group's shingles are in one task's memory.

Defined results: a text without words (or null) has fingerprint zero, which links like any other; a very long text
is read whole, its shingles a block at a time; a null doc_id never is a component's id unless the component has no
other; rows with the same doc_id are rows of their own, of which deduplicated() keeps one in each component; an empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from weftlink.llm import common
from weftlink.llm.components import components
from weftlink.llm.words import mix, split_words

#: Words of a shingle, seed of XXH64, differing bits of a link, shingles that are counted at a time.
SHINGLE, SEED, RADIUS, BLOCK = 3, 42, 2, 16_384
#: Bits of a segment, segments, distinct fingerprints that may meet under one value of a segment.
WIDTH, SEGMENTS, HOT = 32, 2, 64
#: Near copies: words of the shingles that are compared, least share of common ones; segments of 32 bits of a wide fingerprint.
COMPARED, LEAST, LONG = 5, 0.8, 6
#: Least hashes of a sketch (16 to a column), places in which the sketches of near copies may differ.
SKETCH, UNLIKE = 256, 82
#: Keys of a text, least hashes in each.
BANDS, DEEP = 64, 8
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)
_WORDS = re.compile(common.WORD.encode())
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_hash = functools.partial(xxh64_intdigest, seed=SEED)


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits: each is 1 if more than half of the shingles' hashes have it."""
    words = _WORDS.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
    if not words:
        return 0
    if len(words) < shingle:
        shingles: Iterator[bytes] = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    set_, n = np.zeros(64, np.int64), 0
    while len(h := np.fromiter(map(_hash, itertools.islice(shingles, BLOCK)), np.uint64)):
        set_ += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    return int.from_bytes(np.packbits(set_ * 2 > n, bitorder="little").tobytes(), "little")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@F.pandas_udf(T.LongType())
def simhash_udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series(np.fromiter((_signed(simhash(t)) for t in texts), np.int64, len(texts)))


def _segments(fp: Column) -> Column:
    """(segment, value) of a fingerprint."""
    return F.array(*[F.struct(F.lit(s).alias("segment"), F.shiftright(fp, s * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1)).alias("value")) for s in range(SEGMENTS)])


def _ball(radius: int) -> Column:
    """All values of a segment with up to so many bits."""
    masks = [sum(1 << b for b in bits) for n in range(radius + 1) for bits in itertools.combinations(range(WIDTH), n)]
    return F.array(*[F.lit(m).cast("long") for m in masks])


def _verified(pairs: DataFrame, radius: int) -> DataFrame:
    """a, b: the pairs (a, b) of different fingerprints that differ in up to `radius` of all bits."""
    return pairs.where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).select("a", "b")


def full_links(prints: DataFrame, radius: int) -> DataFrame:
    """a, b: enough links to connect all pairs of the distinct fingerprints fp that differ in up to `radius` (2 at most)
    bits, through keys of all bits: each probe is linked to the least that shares it."""
    flips = [0] + [_signed(1 << bit) for bit in range(64)]
    probes = prints.select("fp", F.explode(F.array(*[F.lit(m).cast("long") for m in flips])).alias("flip"))
    probes = probes.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("probe"))
    # whoever shares a probe is within 2 bits; within 1 bit one of the two shares the other's own place
    if radius < 2:
        own = prints.select(F.col("fp").alias("b"))
        met = probes.hint("merge").join(own.hint("merge"), F.col("probe") == F.col("b")).select(F.col("fp").alias("a"), "b")
    else:
        met = probes.select(F.col("fp").alias("a"), F.min("fp").over(Window.partitionBy("probe").orderBy("fp")).alias("b"))
    return _verified(met, radius)


def links(prints: DataFrame, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """a, b: links between the distinct fingerprints of column fp, enough to connect all pairs that differ
    in up to `radius` bits (2 at most)."""
    if not 0 < radius <= 2:
        raise ValueError("radius 1 or 2")
    entries = prints.select("fp", F.explode(_segments(F.col("fp"))).alias("x")).select("x.*", "fp")
    crowded = common.stored(entries.groupBy("segment", "value").count().where(F.col("count") > hot).select("segment", "value"), "crowded")
    n = crowded.count()
    probes = entries.select("segment", F.col("value").alias("own"), F.col("fp").alias("a"), F.explode(_ball(radius // SEGMENTS)).alias("flip"))
    probes = probes.select("segment", F.col("own").bitwiseXOR(F.col("flip")).alias("value"), "a")
    table = entries.withColumnRenamed("fp", "b")
    if n:
        table = table.join(common.beside(crowded, n), ["segment", "value"], "left_anti")
    # probes are many more than the rows they come from, so neither side may be broadcast by that estimate
    light = _verified(probes.hint("merge").join(table.hint("merge"), ["segment", "value"]), radius)
    if not n:
        return light.distinct()
    met = probes.join(common.beside(crowded, n), ["segment", "value"], "left_semi").select(F.col("a").alias("fp")).distinct()
    return light.unionByName(full_links(common.stored(met, "met"), radius)).distinct()


def grouped(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id of each row."""
    # fingerprints are made once; what follows reads 16 bytes a document
    prints = common.stored(docs.select("doc_id", simhash_udf("text").alias("fp")), "prints")
    distinct = common.stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    found = components(links(distinct.select("fp"), radius))
    of = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    ids = of.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = common.stored(of.where("component <> fp").select("fp", "component").join(ids, "component"), "linked")
    alone = of.where("component = fp").select("fp", "component").join(ids, "component")
    classes = linked.select("fp", "component_id").unionByName(alone.select("fp", "component_id"))
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def _stirred(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _SEEDS[1]
        x = (x ^ (x >> np.uint64(27))) * _SEEDS[2]
    return x ^ (x >> np.uint64(31))


def _joined(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n successive words each; of all of them if there are fewer."""
    n = min(n, len(h))
    out = h[: len(h) - n + 1]
    for k in range(1, n):
        out = _stirred(out * _SEEDS[0] + h[k : len(h) - n + 1 + k])
    return out


def shingle_sets(texts: pa.Array, n: int = COMPARED) -> list[np.ndarray]:
    """The hashes of the distinct shingles of each text."""
    lo, hi, _, sizes = split_words(texts)
    h, ends = mix(lo, hi), np.cumsum(sizes)
    return [np.unique(_joined(h[e - k : e], n)) if k else h[:0] for e, k in zip(ends.tolist(), sizes.tolist(), strict=True)]


def sequence_keys(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each text 128 bits of hash of all its words, whose hashes are h."""
    key, some = np.zeros((len(sizes), 2), np.uint64), np.flatnonzero(sizes)
    if len(h):
        first = (np.cumsum(sizes) - sizes)[some]
        place = np.arange(len(h)) - np.repeat(first, sizes[some])
        for k in range(2):
            key[some, k] = np.add.reduceat(_stirred((h ^ _SEEDS[k]) + place.astype(np.uint64) * _SEEDS[2 - k]), first)
    return key


def wide_prints(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each text 128 bits of hash of all its words, and the fingerprint of LONG segments, 64 bits a column."""
    lo, hi, _, sizes = split_words(texts)
    h, some = mix(lo, hi), np.flatnonzero(sizes)
    key, fp = sequence_keys(h, sizes), np.zeros((len(sizes), LONG // 2), np.uint64)
    if not len(h):
        return key, fp
    pair = h.copy()
    pair[:-1] = _stirred(h[:-1] * _SEEDS[0] + h[1:])
    first = (np.cumsum(sizes) - sizes)[some]
    last = np.cumsum(sizes)[some] - 1
    keep = np.ones(len(h), bool)
    keep[last[sizes[some] > 1]] = False  # a single word stands for itself
    pair[last] = h[last]
    n = np.add.reduceat(keep.astype(np.int64), first)
    pair = pair[keep]
    first = np.cumsum(n) - n
    for k in range(LONG // 2):
        bits = np.unpackbits(_stirred(pair ^ _SEEDS[k]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_ = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        fp[some, k] = np.packbits(set_ * 2 > n[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return key, fp


@functools.cache
def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    a, b = np.random.default_rng(SEED).integers(0, 1 << 64, (2, SKETCH), np.uint64)
    return a, b | np.uint64(1)


@functools.cache
def _bands() -> np.ndarray:
    """The least hashes of each band: each hash is in as many bands as any other."""
    rng = np.random.default_rng(SEED + 1)
    return np.concatenate([rng.permutation(SKETCH) for _ in range(BANDS * DEEP // SKETCH)]).reshape(BANDS, DEEP)


def _least_hashes(h: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """For each of SKETCH hash functions the least hash of a shingle of COMPARED words of each text that has words."""
    size = sizes[np.flatnonzero(sizes)]
    ends, n = np.cumsum(size), np.maximum(size - COMPARED + 1, 1)
    # all shingles but those over the end of a text; a shorter text is one shingle
    all_ = _joined(np.append(h, np.zeros(COMPARED - 1, np.uint64)), COMPARED)
    for i in np.flatnonzero(size < COMPARED).tolist():
        all_[ends[i] - size[i]] = _joined(h[ends[i] - size[i] : ends[i]], COMPARED)[0]
    first = np.cumsum(n) - n
    all_ = all_[np.arange(n.sum()) + np.repeat(ends - size - first, n)]
    for a, b in zip(*_multipliers(), strict=True):
        yield np.minimum.reduceat((all_ ^ a) * b, first)


def sketches(texts: pa.Array) -> np.ndarray:
    """For each text 4 bits of each of SKETCH least hashes of its shingles of COMPARED words, 16 to a column."""
    lo, hi, _, sizes = split_words(texts)
    h, some = mix(lo, hi), np.flatnonzero(sizes)
    out = np.zeros((len(sizes), SKETCH // 16), np.uint64)
    if len(h):
        for k, least in enumerate(_least_hashes(h, sizes)):
            out[some, k // 16] |= ((least >> np.uint64(20)) & np.uint64(15)) << np.uint64(4 * (k % 16))
    return out


def banded(texts: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """For each text 128 bits of hash of all its words, and its keys; none for a text without words."""
    lo, hi, _, sizes = split_words(texts)
    h = mix(lo, hi)
    keys: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(sizes)
    if len(h):
        least = np.stack(list(_least_hashes(h, sizes)), axis=1)
        made = np.repeat(np.arange(BANDS, dtype=np.uint64)[None], len(least), axis=0)
        for k in range(DEEP):
            made = _stirred(made * _SEEDS[0] + least[:, _bands()[:, k]])
        for i, row in zip(np.flatnonzero(sizes).tolist(), made, strict=True):
            keys[i] = row
    return sequence_keys(h, sizes), keys


def near_classes(sets: list[np.ndarray], least: float = LEAST) -> np.ndarray:
    """For each set (of distinct numbers) the first that is reached from it by links between sets that share at least
    `least` of the numbers that either has. Sets that were reached aren't compared again."""
    sizes = np.array([len(x) for x in sets])
    of = np.repeat(np.arange(len(sets)), sizes)
    _, which = np.unique(np.concatenate(sets), return_inverse=True)
    own, at = which, np.cumsum(sizes) - sizes
    out, left = np.full(len(sets), -1), len(sets)

    def listed(keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # the sets that have each number: only those that weren't reached
        order = np.argsort(own[keep], kind="stable")
        count = np.bincount(own[keep], minlength=int(which.max(initial=-1)) + 1)
        return of[keep][order], np.cumsum(count) - count, count

    having, begin, count = listed(np.arange(len(own)))
    listed_for = left
    for i in range(len(sets)):
        if out[i] >= 0:
            continue
        out[i], reached = i, [i]
        left -= 1
        while reached and left:
            if left < listed_for // 2:
                having, begin, count = listed(np.flatnonzero(out[of] < 0))
                listed_for = left
            x = reached.pop()
            mine = own[at[x] : at[x] + sizes[x]]
            n = count[mine]
            if not n.sum():
                continue
            shift = np.repeat(begin[mine] - (np.cumsum(n) - n), n)
            both = np.bincount(having[np.arange(len(shift)) + shift], minlength=len(sets))
            new = np.flatnonzero((out < 0) & (both > 0) & (both >= least * (sizes + sizes[x] - both)))
            out[new] = i
            left -= len(new)
            reached += new.tolist()
    return out


def loose_links(nodes: DataFrame) -> DataFrame:
    """a, b: each node of (node, keys) with the least of those that share a key."""
    rows = nodes.select("node", F.explode("keys").alias("key"))
    met = rows.select(F.col("node").alias("a"), F.min("node").over(Window.partitionBy("key").orderBy("node")).alias("b"))
    return met.where("a <> b").distinct()


def resembling(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, digest (MD5 of the text), row, component of each row of docs (doc_id, text): groups of texts that are linked
    by a share of at least `least` of common shingles of COMPARED words (of the distinct ones that either has)."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("digest"), "text")

    def print_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                key, keys = banded(part.column("text"))
                made = [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in key.T]
                made.append(pa.array([x.view(np.int64) for x in keys], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in ("row", "doc_id", "digest")] + made, names=["row", "doc_id", "digest", "k0", "k1", "keys"])

    prints = common.stored(rows.mapInArrow(print_, "row long, doc_id long, digest string, k0 long, k1 long, keys array<long>"), "prints")
    own = prints.groupBy("k0", "k1").agg(F.min(F.struct("row", "digest")).alias("own"))
    own = common.stored(own.select("k0", "k1", F.col("own.row").alias("node"), F.col("own.digest").alias("own")), "nodes")
    ends = own.select("node").hint("merge")
    nodes = prints.select(F.col("row").alias("node"), "keys").hint("merge").join(ends, "node", "left_semi")
    loose = components(loose_links(nodes))
    loose = loose.unionByName(loose.select(F.col("component").alias("node"), "component").distinct())  # the least of each, too
    # one text of each sequence of words, beside the others of its loose group
    wanted = common.stored(own.select("node", "own").hint("merge").join(loose.hint("merge"), "node"), "wanted")
    texts = docs.select("text", F.md5("text").alias("digest"))
    texts = texts.join(common.beside(wanted, wanted.count()), F.col("digest") == F.col("own")).groupBy("component", "node").agg(F.first("text").alias("text"))
    texts = texts.repartition("component").sortWithinPartitions("component")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, sets = None, [], []

        def classes() -> pa.RecordBatch:
            found = near_classes(sets, least)
            least_ids = {}
            for i, c in zip(ids, found.tolist(), strict=True):
                least_ids[c] = min(least_ids.get(c, i), i)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([least_ids[c] for c in found.tolist()], pa.int64())], names=["node", "component"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for c, i, x in zip(part.column("component").to_pylist(), part.column("node").to_pylist(), shingle_sets(part.column("text")), strict=True):
                    if c != group and ids:
                        yield classes()
                        ids, sets = [], []
                    group = c
                    ids.append(i)
                    sets.append(x)
        if ids:
            yield classes()

    found = common.stored(texts.mapInArrow(compare, "node long, component long"), "classes")
    of = own.select("k0", "k1", "node").hint("merge").join(found.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    return prints.select("doc_id", "digest", "row", "k0", "k1").hint("merge").join(of.select("k0", "k1", "component").hint("merge"), ["k0", "k1"]).select("doc_id", "digest", "row", "component")


def deduplicated(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """docs with one row of each group of resembling(): that of the least doc_id (null ids last), then of the first row with
    the least digest. Rows that are equal in doc_id and text are one row; other columns don't count."""
    classes = common.stored(resembling(docs, least), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    id_, hash_ = common.fresh(docs, "id", "hash")
    kept = classes.groupBy("component").agg(F.min(order).alias("k")).select(F.col("k.doc_id").alias(id_), F.col("k.digest").alias(hash_))
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & F.md5("text").eqNullSafe(F.col(hash_))
    first = docs.join(kept, same, "left_semi")
    # the texts are grouped by row only if a row repeats at all
    again = classes.groupBy("doc_id", "digest").count().where("count > 1").limit(1).count()
    return first.withColumn(hash_, F.md5("text")).dropDuplicates(["doc_id", hash_]).select(*docs.columns) if again else first


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = grouped(common.documents(spark, sf_dir))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op4_simhash_near_dedup": op4_simhash_near_dedup}
SQL: dict = {}

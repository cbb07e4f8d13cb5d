"""Suffix-array dedup over sparse suffixes.

Words are hashed. In every window of WINDOW places the place whose next GRAM words have the least hash (a
minimiser) keeps its suffix; so a passage keeps the same places wherever it stands. A kept suffix is
represented by a hash of its first MATCH words, and those whose hash stands in two rows go on.

Each WORDS successive words belong to the minimiser of their first WINDOW places, whose MATCH words lie inside
of them; so words that stand in two rows have a suffix there that goes on. The WORDS words around such a suffix
are a context, with a hash of its own and one for each WORDS successive words in it. Contexts that are equal
count once, with the least and greatest of their rows; then the WORDS words are counted by hash over distinct
contexts. What stands in two rows is so known for each WORDS words by themselves, however often parts of
them stand elsewhere, or in the same row. No group is gathered and no pairs are made. Overlapping finds in
a document merge to passages.

Defined results: a null or empty text has no suffixes; a very long text is read whole; of equal minimisers the last counts; of equal texts each document's whole text is a
passage, if long enough; a passage that repeats in one document alone is left to it; rows that are equal in
doc_id and text count as one; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from weftlink.llm import common

#: Places of a window, words whose hash makes a minimiser, words of a match, of a passage (WINDOW + MATCH - 1 at least).
WINDOW, GRAM, MATCH, WORDS = 24, 5, 26, 50
_WORDS = re.compile(common.WORD)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def hashed(text: str | None) -> np.ndarray:
    words = _WORDS.findall(text or "")
    return np.fromiter((xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))


def spans_hash(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n words from each place; as many as there are whole ones. n: a power of two is quickest."""
    if len(h) < n:
        return h[:0]
    out, have = h.copy(), 1
    with np.errstate(over="ignore"):
        while have < n:
            step = min(have, n - have)
            out = (out[: len(out) - step] * _MIX + np.uint64(have)) ^ ((out[step:] ^ (out[step:] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9))
            have += step
    return out


def owners(h: np.ndarray) -> np.ndarray:
    """For each window of the text, the place whose gram is the least (the last of equal ones)."""
    grams = spans_hash(h, GRAM)
    if len(grams) < WINDOW:
        return np.zeros(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)[:, ::-1]
    return np.arange(len(windows)) + WINDOW - 1 - windows.argmin(axis=1)


def minimisers(h: np.ndarray) -> np.ndarray:
    """Places whose gram is the least of a window; all windows of the text."""
    grams = spans_hash(h, GRAM)
    if 0 < len(grams) <= WINDOW:
        return np.array([len(grams) - 1 - int(np.argmin(grams[::-1]))])
    return np.unique(owners(h))


def parts(batches: Iterator[pa.RecordBatch], rows: int = 64) -> Iterator[pa.RecordBatch]:
    """The batches a few rows at a time: what is made of these is all that a task holds beside a batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    common.trim()


def keyed(docs: DataFrame) -> DataFrame:
    """row (a hash of doc_id and text), doc_id, text."""
    return docs.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")


def suffixes(rows: DataFrame) -> DataFrame:
    """row, place, key (hash of the first words) of each kept suffix."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            made = []
            for text in part.column("text").to_pylist():
                h = hashed(text)
                first, places = spans_hash(h, MATCH), minimisers(h)
                places = places[places < len(first)]
                made.append((places, first[places].view(np.int64)))
            place, key = (np.concatenate([m[k] for m in made]) for k in range(2))
            row = np.repeat(part.column("row").to_numpy(), [len(m[0]) for m in made])
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(place.astype(np.int32)), pa.array(key)], names=["row", "place", "key"])

    return rows.select("row", "text").mapInArrow(keep, "row long, place int, key long")


def shared_places(kept: DataFrame) -> DataFrame:
    """row, places: the suffixes that share MATCH words with another row."""
    shared = kept.groupBy("key").agg(F.min("row").alias("a"), F.max("row").alias("b")).where("a <> b").select("key")
    # as a table of its own, so that both sides of the join are plain exchanges and a hot key can be split
    found = kept.join(common.stored(shared, "shared"), "key")
    # as many as the row's own text has kept places
    return found.groupBy("row").agg(F.collect_set("place").alias("places"))


def contexts(rows: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """row, doc_id, first, context, hashes: the successive `words` words that belong to a wanted place (from
    place `first` of the text on), by their hashes, and a hash of all of these."""

    kind = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("first", pa.int64()), ("context", pa.int64()), ("hashes", pa.list_(pa.int64()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            out: list[list] = [[] for _ in kind]
            for row, doc_id, text, places in zip(*(part.column(c).to_pylist() for c in ("row", "doc_id", "text", "places")), strict=True):
                h = hashed(text)
                each = spans_hash(h, words)
                of = owners(h)[: len(each)]
                starts = np.flatnonzero(np.diff(of, prepend=-1))
                stops = np.append(starts[1:], len(of))
                for a, b in zip(starts[mine := np.isin(of[starts], places)].tolist(), stops[mine].tolist(), strict=True):
                    hashes = each[a:b].view(np.int64)
                    for column, x in zip(out, (row, doc_id, a, int(np.uint64(xxh3_64_intdigest(hashes.tobytes())).view(np.int64)), hashes), strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, kind, strict=True)], schema=kind)

    texts = rows.withColumn("doc_id", F.col("doc_id").cast("long")).join(wanted, "row")
    return texts.mapInArrow(read, "row long, doc_id long, first long, context long, hashes array<long>")


def repeated(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """row, doc_id, passages: array of (start, stop, others): words of the text that stand in other rows, and
    of the documents that they stand in the least and greatest doc_ids but its own."""
    if words < WINDOW + MATCH - 1:
        raise ValueError("fewer words than a window and a match have")
    rows = keyed(docs)
    met = common.stored(contexts(rows, shared_places(common.stored(suffixes(rows), "kept")), words), "met")
    extremes = lambda a, b, least, greatest: (F.min(a).alias("a"), F.max(b).alias("b"), F.min(least).alias("least"), F.max(greatest).alias("greatest"))
    distinct = common.stored(met.groupBy("context").agg(*extremes("row", "row", "doc_id", "doc_id"), F.first("hashes").alias("hashes")), "contexts")
    each = distinct.select("context", "a", "b", "least", "greatest", F.posexplode("hashes").alias("i", "h"))
    shared = common.stored(each.groupBy("h").agg(*extremes("a", "b", "least", "greatest")).where("a <> b").drop("a", "b"), "words")
    # a context has WINDOW places at most
    places = each.select("context", "i", "h").join(shared, "h").groupBy("context").agg(F.collect_list(F.struct("i", "least", "greatest")).alias("at"))
    found = met.select("row", "doc_id", "first", "context").join(common.stored(places, "places"), "context")
    # a document's contexts come together here: they are part of its own text
    by = found.groupBy("row", "doc_id").agg(F.collect_set(F.struct("first", "at")).alias("e"))

    spans_of = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("others", pa.list_(pa.int64()))]))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            out = []
            for doc_id, e in zip(part.column("doc_id").to_pylist(), part.column("e"), strict=True):
                spans: list[list] = []
                own = {None, doc_id}
                # a document's words become Python's objects one document at a time
                for start, others in sorted(((x["first"] + y["i"], (y["least"], y["greatest"])) for x in e.as_py() for y in x["at"]), key=lambda f: f[0]):
                    if spans and start <= spans[-1][1]:
                        spans[-1][1] = start + words
                        spans[-1][2].update(others)
                    else:
                        spans.append([start, start + words, set(others)])
                out.append([{"start": a, "stop": b, "others": sorted(others - own)} for a, b, others in spans])
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("doc_id"), pa.array(out, spans_of)], names=["row", "doc_id", "passages"])

    kind = "row long, doc_id long, passages array<struct<start:long,stop:long,others:array<long>>>"
    return by.mapInArrow(merge, kind)


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages that stand in others, too: their number, words, places and other documents."""
    found = repeated(common.documents(spark, sf_dir))
    return found.select(
        "doc_id",
        F.size("passages").cast("long").alias("n_passages"),
        F.aggregate("passages", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"]).alias("repeated_words"),
        F.array_join(F.transform("passages", lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string"))), ",").alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.transform("passages", lambda s: s["others"])))).alias("others"),
    )


QUERIES = {"op6_suffix_array_dedup": op6_suffix_array_dedup}
SQL: dict = {}

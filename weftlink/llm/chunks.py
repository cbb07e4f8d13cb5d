"""Substring dedup: content-defined chunks by a gear rolling hash, deduplicated by digest.

A text's UTF-8 bytes run through a gear hash (h = 2h + G[byte]); a chunk ends where the 16 low bits of the
hash are less than 2^16 / AVERAGE, so the end depends on the 16 bytes before it alone, and an insertion
changes only the chunks that it touches. A chunk has MOST bytes at most. A chunk whose 128-bit digest stands
in more than one document is a copy; in the document with the least doc_id it stays. Neighbouring copies
form a passage, and passages of at least REPEATED bytes are reported: shorter ones are common phrases.

A digest is counted once for each document, by partial sums; digests of one document alone go before the
chunks are joined back. No group is gathered.

Defined results: a null or empty text has no chunks; a very long text is hashed whole, a block at a time; equal texts are copies throughout; what repeats inside
one document alone is left to it; rows with the same doc_id are rows of their own, and chunks that they
share stay in each; a null doc_id comes last; an empty table gives an empty result. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from weftlink.llm import common

#: Average and most bytes of a chunk, least bytes of a passage, bytes hashed at a time.
AVERAGE, MOST, REPEATED, BLOCK = 40, 4096, 120, 1 << 18
WINDOW = 16


def gear(seed: int = 1) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 32, 256, np.uint32)


_GEAR = gear()


def cuts(data: bytes) -> np.ndarray:
    """Ends of the chunks of data, the last its length."""
    found = []
    for at in range(0, len(data), BLOCK):
        back = min(at, WINDOW - 1)
        h = _GEAR[np.frombuffer(data, np.uint8, min(BLOCK, len(data) - at) + back, at - back)]
        # h[i] = sum of G[i - k] << k for the 16 last bytes, by doubling the span that is summed
        for span in (1, 2, 4, 8):
            h[span:] = h[span:] + (h[:-span] << np.uint32(span))
        low = h[back:] & np.uint32((1 << WINDOW) - 1)
        found.append(np.flatnonzero(low < (1 << WINDOW) // AVERAGE) + at + 1)
    ends = np.concatenate([*found, [len(data)]]).astype(np.int64)
    ends = ends[np.diff(ends, prepend=0) > 0]
    if not len(ends):
        return ends
    sizes = np.diff(ends, prepend=0)
    if (sizes > MOST).any():
        ends = np.concatenate([np.append(np.arange(e - s + MOST, e, MOST), e) for e, s in zip(ends, sizes, strict=True)])
    return ends


def chunks(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Ends (bytes) and digests (two halves) of the chunks."""
    data = (text or "").encode("utf-8", "surrogatepass")
    ends = cuts(data)
    parts = map(data.__getitem__, map(slice, [0, *ends[:-1].tolist()], ends.tolist()))
    return ends, np.frombuffer(b"".join(map(xxh3_128_digest, parts)), ">i8").astype(np.int64).reshape(-1, 2)


def chunked(docs: DataFrame) -> DataFrame:
    """row, doc_id, start, stop, d1, d2 (digest), again (it stands in the document before) of each chunk."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch[at : at + 256]
                made = [chunks(t) for t in part["text"]]
                size = np.array([len(e) for e, _ in made], int)
                ends, digests = (np.concatenate([m[k] for m in made]) for k in (0, 1))
                first = np.zeros(len(ends), bool)
                first[(np.cumsum(size) - size)[size > 0]] = True
                out = part[["row", "doc_id"]].loc[part.index.repeat(size)].reset_index(drop=True)
                start = np.where(first, 0, np.roll(ends, 1))
                out = out.assign(start=start.astype(np.int32), stop=ends.astype(np.int32), d1=digests[:, 0], d2=digests[:, 1])
                yield out.assign(again=out.duplicated(["row", "d1", "d2"]))

    # ids pass through as text, so that a null among them doesn't make them floating
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("string").alias("doc_id"), "text")
    out = rows.mapInPandas(cut, "row long, doc_id string, start int, stop int, d1 long, d2 long, again boolean")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def repeated(docs: DataFrame, size: int = REPEATED) -> DataFrame:
    """row, doc_id, passages: array of (start, stop, kept, first_doc, dropped): bytes of the text that stand in
    other documents too; kept tells whether all of it stays; first_doc is the least document with its first
    chunk; dropped: array of (start, stop) of its bytes that stay in an earlier document."""
    all_ = common.stored(chunked(docs), "chunks")
    last = F.lit((1 << 63) - 1)
    by = all_.where("not again").groupBy("d1", "d2").agg(F.count("*").alias("copies"), F.min(F.coalesce("doc_id", last)).alias("first_doc"))
    # as a table of its own, so that both sides of the join are plain exchanges and a hot digest can be split
    met = all_.drop("again").join(common.stored(by.where("copies > 1").drop("copies"), "copied"), ["d1", "d2"])
    # a document's chunks come together here: they are as many as its own text has
    spans = met.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "stop", "first_doc"))).alias("c"))

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, c in zip(batch["doc_id"], batch["c"], strict=True):
                own = (1 << 63) - 1 if doc_id is None else int(doc_id)
                runs: list[list] = []
                for x in c:
                    if runs and runs[-1][1] == x["start"]:
                        runs[-1][1] = x["stop"]
                    else:
                        runs.append([x["start"], x["stop"], x["first_doc"], []])
                    dropped = runs[-1][3]
                    if x["first_doc"] != own:
                        if dropped and dropped[-1]["stop"] == x["start"]:
                            dropped[-1]["stop"] = x["stop"]
                        else:
                            dropped.append({"start": x["start"], "stop": x["stop"]})
                out.append([{"start": r[0], "stop": r[1], "kept": not r[3], "first_doc": r[2], "dropped": r[3]} for r in runs if r[1] - r[0] >= size])
            yield batch[["row", "doc_id"]].assign(passages=out)

    kind = "row long, doc_id string, passages array<struct<start:int,stop:int,kept:boolean,first_doc:long,dropped:array<struct<start:int,stop:int>>>>"
    text_ids = spans.withColumn("doc_id", F.col("doc_id").cast("string"))
    return text_ids.mapInPandas(joined, kind).withColumn("doc_id", F.col("doc_id").cast("long")).where(F.size("passages") > 0)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with repeated passages: their number and bytes, those to drop, the documents they are first in."""
    found = repeated(common.documents(spark, sf_dir))
    total = lambda spans: F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    shown = F.transform("passages", lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string")))
    return found.select(
        "doc_id",
        F.size("passages").cast("long").alias("n_passages"),
        total(F.col("passages")).alias("repeated_bytes"),
        total(F.flatten(F.transform("passages", lambda s: s["dropped"]))).alias("dropped_bytes"),
        F.array_join(shown, ",").alias("spans"),
        F.array_sort(F.array_distinct(F.transform("passages", lambda s: s["first_doc"]))).alias("first_docs"),
    )


QUERIES = {"op1_substring_dedup": op1_substring_dedup}
SQL: dict = {}

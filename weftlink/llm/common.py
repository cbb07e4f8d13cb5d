"""Helpers that the operators share: table access, and storage that all executors see."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.sources.storage import dropped, shared_dir, stored

__all__ = ["BROADCAST_ROWS", "WORD", "beside", "documents", "dropped", "fresh", "remainder", "shared_dir", "stored", "trim"]

#: The word class of the contracts, for Java's and Python's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
#: As many rows at most are sent to every executor; larger tables are joined by a shuffle.
BROADCAST_ROWS = 65_536


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores after them until df has no column of that name (in either case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def beside(df: DataFrame, rows: int) -> DataFrame:
    """df marked for broadcast if its counted rows are few; else Spark shuffles it."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def remainder(doc_id, parts: int):
    """crc32 of the doc_id as text, modulo parts; a null doc_id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(parts))


def trim() -> None:
    """Gives memory that a worker no longer uses back to the system, where the C library can do so."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass

"""Linking records as they arrive: a stream of entities against a static index, batch by batch."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def linked_stream(stream: DataFrame, link: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Appends link(batch) to a Parquet table; a batch that runs again replaces its own folder."""

    def each(batch: DataFrame, epoch: int) -> None:
        link(batch).write.mode("overwrite").parquet(f"{path}/batch={epoch}")

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def progress(done: DataFrame, total: int, started: float) -> DataFrame:
    """One row: how far a run over `total` entities has come."""
    seconds = max(time.time() - started, 1e-6)
    n = F.count("*")
    rate = n / F.lit(seconds)
    return done.agg(
        n.alias("entities_processed"),
        F.lit(total).cast("long").alias("total_entities"),
        F.round(F.coalesce(F.try_divide(n * 100.0, F.lit(total)), F.lit(0.0)), 2).alias("percent"),
        rate.alias("speed_eps"),
        F.coalesce(F.try_divide(F.lit(total) - n, rate), F.lit(0.0)).alias("eta_seconds"),
    )

"""Profiles of sources and truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_country(entities: DataFrame) -> DataFrame:
    """source, country, n of all sources in one aggregate."""
    return entities.groupBy("source", "country").agg(F.count("*").alias("n"))


def shapes(entities: DataFrame) -> DataFrame:
    return entities.groupBy("source").agg(F.count("*").alias("n_rows"), F.lit(len(entities.columns)).cast("long").alias("n_columns"))


def match_histogram(truth: DataFrame, top: int = 10) -> DataFrame:
    return truth.groupBy("n_matches").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "n_matches").limit(top)


def singletons(truth: DataFrame) -> DataFrame:
    return truth.agg(F.count_if(F.col("n_matches") == 0).alias("n_singletons"), F.coalesce(F.try_divide(F.count_if(F.col("n_matches") == 0), F.count("*")), F.lit(0.0)).alias("ratio"))


def claimed_twice(truth: DataFrame) -> DataFrame:
    """How many true ids have more than one owner."""
    flat = truth.select("sid", F.explode("trues").alias("cid")).distinct()
    return flat.groupBy("cid").agg(F.count("*").alias("owners")).agg(F.count("*").alias("n_ids"), F.count_if(F.col("owners") > 1).alias("n_shared"))


def metric_rows(entities: DataFrame, truth: DataFrame) -> DataFrame:
    """metric, key, n: all of the profile as one frame."""
    country = by_country(entities).select(F.lit("country").alias("metric"), F.concat_ws(":", F.concat(F.lit("S"), F.col("source")), "country").alias("key"), "n")
    rows = shapes(entities).select(F.lit("rows").alias("metric"), F.concat(F.lit("S"), F.col("source")).alias("key"), F.col("n_rows").alias("n"))
    matches = match_histogram(truth).select(F.lit("matches").alias("metric"), F.col("n_matches").cast("string").alias("key"), "n")
    single = singletons(truth).select(F.lit("singletons").alias("metric"), F.lit("").alias("key"), F.col("n_singletons").alias("n"))
    shared = claimed_twice(truth).select(F.lit("shared").alias("metric"), F.lit("").alias("key"), F.col("n_shared").alias("n"))
    return country.unionByName(rows).unionByName(matches).unionByName(single).unionByName(shared)

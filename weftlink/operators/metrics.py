"""Quality of candidates and matches: precision-weighted F, recall of blocking, thresholds in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Thresholds that are tried: 0.30 to 0.95 by hundredths.
THRESHOLDS = [t / 100 for t in range(30, 96)]


def f_half(hits: Column, predicted: Column, true: Column) -> Column:
    """F0.5 of a set: 1 if both are empty, 0 if one is or nothing is hit."""
    p, r = F.try_divide(hits, predicted), F.try_divide(hits, true)
    return (
        F.when((true == 0) & (predicted == 0), F.lit(1.0)).when((hits == 0) | (true == 0) | (predicted == 0), F.lit(0.0)).otherwise(1.25 * p * r / (0.25 * p + r))
    )


def scored_entities(truth: DataFrame, matches: DataFrame) -> DataFrame:
    """sid, n_true, n_pred, hits, f05 for every row of truth (sid, trues); missing matches are empty."""
    both = truth.join(matches, "sid", "left").withColumn("cids", F.coalesce("cids", F.array().cast("array<string>")))
    sets = {"trues": F.array_distinct("trues"), "cids": F.array_distinct("cids")}
    both = both.withColumns(sets).withColumns({"n_true": F.size("trues"), "n_pred": F.size("cids"), "hits": F.size(F.array_intersect("trues", "cids"))})
    return both.withColumn("f05", f_half(F.col("hits"), F.col("n_pred"), F.col("n_true")))


def macro(entities: DataFrame) -> DataFrame:
    return entities.agg(F.coalesce(F.avg("f05"), F.lit(0.0)).alias("macro_f05"), F.count("*").alias("n"))


def micro(entities: DataFrame) -> DataFrame:
    """Totals; precision and recall are 1 where there is nothing to divide by."""
    share = lambda n: F.coalesce(F.try_divide(F.sum("hits"), F.sum(n)), F.lit(1.0))
    exact = F.count_if((F.col("n_true") == F.col("n_pred")) & (F.col("hits") == F.col("n_true")))
    return entities.agg(
        F.sum("n_true").alias("true_pairs"),
        F.sum("n_pred").alias("predicted_pairs"),
        F.sum("hits").alias("hits"),
        share("n_pred").alias("micro_precision"),
        share("n_true").alias("micro_recall"),
        exact.alias("exact_sets"),
    )


def outcomes(predicted: DataFrame, true: DataFrame) -> DataFrame:
    """sid, cid, outcome (TP, FP, FN) of two tables of pairs."""
    p, t = predicted.select("sid", "cid", F.lit(1).alias("p")), true.select("sid", "cid", F.lit(1).alias("t"))
    kind = F.when(F.col("p").isNull(), "FN").when(F.col("t").isNull(), "FP").otherwise("TP")
    return p.join(t, ["sid", "cid"], "full_outer").select("sid", "cid", kind.alias("outcome"))


def labelled(pairs: DataFrame, true: DataFrame) -> DataFrame:
    return pairs.join(true.select("sid", "cid", F.lit(1).alias("label")), ["sid", "cid"], "left").withColumn("label", F.coalesce("label", F.lit(0)))


def blocking_quality(pairs: DataFrame, true: DataFrame, n1: int, n_other: int) -> DataFrame:
    """Recall (1 without true pairs) and the share of all pairs that blocking spares (0 without pairs)."""
    marked = labelled(pairs.select("sid", "cid").distinct(), true).agg(F.count("*").alias("candidates"), F.coalesce(F.sum("label"), F.lit(0)).alias("hits"))
    total = true.select("sid", "cid").distinct().agg(F.count("*").alias("true_pairs"))
    both = marked.crossJoin(total)  # one row each
    spared = F.lit(1.0) - F.col("candidates") / float(n1 * n_other) if n1 * n_other else F.lit(0.0)
    return both.select("true_pairs", "hits", "candidates", F.coalesce(F.try_divide("hits", "true_pairs"), F.lit(1.0)).alias("recall"), spared.alias("reduction_ratio"))


def tuned(pairs: DataFrame, truth: DataFrame, thresholds: list[float] = THRESHOLDS, score: str = "score") -> DataFrame:
    """threshold, macro_f05 of the least threshold with the best macro F0.5.

    Who owns a candidate doesn't depend on the threshold, so pairs are claimed once; a pair counts at each
    threshold up to its score, which is a range of a literal array. Entities without pairs are one group of
    constant score, so the aggregate holds (thresholds x entities with pairs) rows at most."""
    owner = Window.partitionBy("cid").orderBy(F.desc(score), "sid")
    own = pairs.where(F.col(score) >= min(thresholds)).withColumn("r__", F.row_number().over(owner)).where("r__ = 1")
    flat = truth.select("sid", F.explode(F.array_distinct("trues")).alias("cid"))
    grid = F.array(*map(F.lit, thresholds))
    hits = labelled(own.select("sid", "cid", score), flat).select("sid", "label", F.explode(F.filter(grid, lambda t: t <= F.col(score))).alias("threshold"))
    counts = hits.groupBy("threshold", "sid").agg(F.count("*").alias("n_pred"), F.sum("label").alias("hits"))
    sized = truth.select("sid", F.size(F.array_distinct("trues")).alias("n_true"))
    # against an empty prediction an entity scores 1 or 0 by itself; the counts give the difference
    base = sized.agg(F.sum((F.col("n_true") == 0).cast("double")).alias("base"), F.count("*").alias("n"))
    gain = counts.join(sized, "sid").withColumn("gain", f_half(F.col("hits"), F.col("n_pred"), F.col("n_true")) - (F.col("n_true") == 0).cast("double"))
    sums = gain.groupBy("threshold").agg(F.sum("gain").alias("gain"))
    every = pairs.sparkSession.createDataFrame([(t,) for t in thresholds], "threshold double")
    curve = every.join(sums, "threshold", "left").crossJoin(base)  # one row
    curve = curve.select("threshold", F.round(F.coalesce(F.try_divide(F.col("base") + F.coalesce("gain", F.lit(0.0)), F.col("n")), F.lit(0.0)), 9).alias("macro_f05"))
    return curve.orderBy(F.desc("macro_f05"), "threshold").limit(1)

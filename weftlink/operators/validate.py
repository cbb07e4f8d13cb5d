"""Checks of the two outputs against each other and the expected entities: a frame of issues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exploded(lists: DataFrame) -> DataFrame:
    return lists.select("sid", F.explode("cids").alias("cid"))


def issues(expected: DataFrame, candidates: DataFrame, matches: DataFrame) -> DataFrame:
    """issue, n (rows) for each rule that is broken; expected has entity_id, the outputs sid and cids."""
    ids = expected.select(F.col("entity_id").alias("sid"))
    pairs = exploded(matches).distinct()
    found = []

    def add(name: str, rows: DataFrame) -> None:
        found.append(rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("issue"), "n"))

    for name, out in (("candidates", candidates), ("matches", matches)):
        add(f"{name}: expected entity without a row", ids.join(out, "sid", "left_anti"))
        add(f"{name}: row of an unknown entity", out.join(ids, "sid", "left_anti"))
        again = out.groupBy("sid").count().where("count > 1")
        add(f"{name}: repeated row", again.select(F.explode(F.sequence(F.lit(2), F.col("count")))))
        add(f"{name}: id of the first source in a list", exploded(out).where(F.col("cid").startswith("S1-")))
        add(f"{name}: id twice in a list", out.where(F.size("cids") != F.size(F.array_distinct("cids"))))
    add("matches: id that isn't a candidate", pairs.join(exploded(candidates).distinct(), ["sid", "cid"], "left_anti"))
    add("matches: id with several owners", pairs.groupBy("cid").count().where("count > 1"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def valid(expected: DataFrame, candidates: DataFrame, matches: DataFrame) -> bool:
    return issues(expected, candidates, matches).where("n > 0").limit(1).count() == 0

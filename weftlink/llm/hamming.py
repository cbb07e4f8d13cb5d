"""Exact top-k search over binary codes: incremental multi-index hashing.

A code of 64 bits has four segments of 16 bits; a table holds each distinct code under the value of each
segment. A query enumerates the values that differ from its own segment in r bits, looks them up, and verifies
complete distances; r grows by one, in all segments, from 0 on. After radius r every code within 4r + 3 has been
met (else it would differ in more than r bits in each segment), so the search goes on for just those queries
whose k-th distance isn't covered yet. There is no other way to a result: at radius 16 every code has been met.

Equal codes are one entry with their k least ids, and equal queries are one search, so groups of copies cost
no more than one of them. Candidates beyond a query's k-th distance so far are dropped where they are met, and of
the others a query keeps k codes at most.

Defined results: ties go to the lesser id; a query finds itself; with fewer than k rows all are found; rows
with the same id are rows of their own; a null id or embedding, or one without numbers, is left out; an
element that is null or not a number is a zero bit, and so are those that a short embedding lacks; elements after the
64th don't count; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftlink.llm import common

#: Bits of a code, segments, results of a query, one of how many ids is a query.
BITS, SEGMENTS, K, EVERY = 64, 4, 10, 50
WIDTH = BITS // SEGMENTS


def sign_code(embedding: Column) -> Column:
    """Bit i is 1 where element i of the embedding is above zero; 64 elements count."""
    masks = F.array(*[F.lit((1 << i) - (1 << 64) * (i == 63)).cast("long") for i in range(BITS)])
    bits = F.transform(F.slice(embedding, 1, BITS), lambda x, i: F.when((x > 0) & ~F.isnan(x), F.get(masks, i)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def flips(radius: int) -> Column:
    """All values of a segment with so many bits."""
    return F.filter(F.sequence(F.lit(0), F.lit((1 << WIDTH) - 1)), lambda x: F.bit_count(x) == radius)


def segments(code: Column) -> Column:
    """(segment, value) of a code."""
    value = lambda s: F.shiftright(code, s * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1)).cast("int")
    return F.array(*[F.struct(F.lit(s).alias("segment"), value(s).alias("value")) for s in range(SEGMENTS)])


def _nearest(rows: DataFrame, k: int) -> DataFrame:
    """q, distance, code, least, size: of each query the nearest codes that together have k rows, k codes at most. Of codes
    that are equally near those with the least ids stay, as the ids of one may stand between those of another."""
    order = Window.partitionBy("q").orderBy("distance", "least", "code")
    first = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    nearer = Window.partitionBy("q").orderBy("distance").rangeBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(nearer), F.lit(0))
    return first.withColumn("before", before).where(F.col("before") < k).drop("rank", "before")


def top_k(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, id, distance for queries (id, code) against rows (id, code)."""
    spark = rows.sparkSession
    first = Window.partitionBy("code").orderBy("id")
    least = rows.where("id is not null and code is not null").withColumn("copy", F.row_number().over(first)).where(F.col("copy") <= k)
    grouped = least.groupBy("code").agg(F.array_sort(F.collect_list(F.struct("id", "copy"))).alias("ids"))  # k ids at most
    codes = common.stored(grouped.withColumns({"least": F.col("ids")[0]["id"], "size": F.size("ids")}), "codes")
    table = common.stored(codes.select("code", "least", "size", F.explode(segments(F.col("code"))).alias("x")).select("x.*", "code", "least", "size"), "table")
    total = codes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]  # of copies, k count
    queries = queries.where("id is not null and code is not null")
    # worst: the k-th distance so far
    open_ = common.stored(queries.select(F.col("code").alias("q")).distinct().withColumn("worst", F.lit(BITS)), "open")
    best = spark.createDataFrame([], "q long, distance int, code long, least long, size int")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    done = []
    distance = F.bit_count(F.col("q").bitwiseXOR(F.col("code"))).cast("int")
    for radius in range(WIDTH + 1):
        if not total or not open_.count():
            break
        # so few queries may stand in one file that one task would make all probes
        own = open_.repartition(tasks, "q").select("q", "worst", F.explode(segments(F.col("q"))).alias("x"))
        probes = own.select("q", "worst", "x.segment", F.explode(flips(radius)).alias("flip"), F.col("x.value").alias("own"))
        probes = probes.select("q", "worst", "segment", F.col("own").bitwiseXOR(F.col("flip")).alias("value"))
        # probes are many more than the rows they come from, so neither side may be broadcast by that estimate
        met = probes.hint("merge").join(table.hint("merge"), ["segment", "value"]).withColumn("distance", distance).where("distance <= worst")
        both = met.select("q", "distance", "code", "least", "size").unionByName(best).distinct()
        best = common.stored(_nearest(both, k), "best")
        # the k-th row stands at the greatest distance that is left, as k rows aren't nearer than that
        of = best.groupBy("q").agg(F.max("distance").alias("kth"), F.sum("size").alias("found"))
        state = open_.select("q").join(of, "q", "left").withColumn("worst", F.when(F.col("found") >= k, F.col("kth")).otherwise(F.lit(BITS)))
        covered = SEGMENTS * (radius + 1) - 1
        # all rows found, or k of them and none can be nearer
        over = F.coalesce(F.col("found") >= min(k, total), F.lit(False)) & ((F.col("worst") <= covered) | F.lit(total <= k)) | F.lit(radius == WIDTH)
        state = common.stored(state.select("q", "worst", over.alias("over")), "state")
        done.append(best.join(state.where("over").select("q"), "q"))
        best = best.join(state.where("not over").select("q"), "q")
        open_ = state.where("not over").select("q", "worst")
    found = functools.reduce(DataFrame.unionByName, done) if done else best
    # ids of the codes that were found
    listed = found.select("q", "distance", "code").join(codes.select("code", "ids"), "code").select("q", "distance", F.explode("ids").alias("i"))
    order = Window.partitionBy("q").orderBy("distance", "id", "copy")
    listed = listed.select("q", "distance", "i.id", "i.copy").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    asked = queries.select(F.col("id").alias("query_id"), F.col("code").alias("q"))
    return asked.join(listed, "q").select("query_id", F.col("rank").cast("int").alias("rank"), "id", "distance")


def op3_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = rows.select(F.col("vec_id").alias("id"), F.when(F.size("embedding") > 0, sign_code(F.col("embedding"))).alias("code"))
    return top_k(rows, rows.where(F.col("id") % EVERY == 0))


ORACLE = """
WITH c AS (
  SELECT vec_id AS id, list_sum(list_transform(embedding[1:64], lambda x, i: CASE WHEN x > 0 AND NOT isnan(x) THEN 1::UBIGINT << (i - 1)::UBIGINT ELSE 0::UBIGINT END))::UBIGINT AS code
  FROM embeddings WHERE len(embedding) > 0),
d AS (
  SELECT q.id AS query_id, c.id, bit_count(xor(q.code, c.code)::BIT)::INT AS distance
  FROM c AS q JOIN c ON q.id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id)::INT AS rank FROM d)
SELECT query_id, rank, id, distance FROM r WHERE rank <= 10
"""

QUERIES = {"op3_hamming_top_k": op3_hamming_top_k}
SQL = {"op3_hamming_top_k": ORACLE}

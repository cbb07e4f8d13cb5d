"""Mixing sources to target weights, with hash-threshold histograms. DataFrame functions only.

Every document has a 60-bit hash of its doc_id and text. For each source the words are summed by hash bucket; the
budget falls into one bucket; only the documents of that bucket are summed again, by the next bits, until
a single document remains, or documents that are equal in doc_id and text: of these a second hash, of the row, takes as
many as the budget has room for. What lies below the threshold is taken: nothing is sorted, and a histogram
has at most 4096 rows a source and level.

Defined results: a null text has no words, and a very long one is counted whole; a null source is a source of its own
and comes last; null or repeated doc_ids don't matter, as the text decides, too; of rows that are equal in both, any may
be taken, but how many is certain (mixed() takes rows that are equal in all columns together); an empty table gives an
empty mix. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftlink.llm import common

#: Weights of the sources in order, repeating.
WEIGHTS = (3, 1, 2)
#: Words that the mix has, as a share of all words; most copies of a document.
SHARE, MOST = 1.5, 2
#: Bits of the hash; bits that each level of a histogram adds.
BITS, STEP = 60, 12


def doc_hash() -> Column:
    """60 bits of the MD5 of the id and the text."""
    both = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(both), 1, BITS // 4), 16, 10).cast("long")


def _bits(n: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(n), 64 - BITS)


def sized(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """doc_id, source, size (words), h (hash), r (hash of the row, or of its place in the table)."""
    words = F.coalesce(F.regexp_count("text", F.lit(common.WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", words.alias("size"), doc_hash().alias("h"), (_bits(F.monotonically_increasing_id()) if row is None else row).alias("r"))


def row_hash(docs: DataFrame) -> Column:
    """60 bits of all columns that Spark hashes."""
    columns = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    return F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), 64 - BITS)


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target: the shares by weight, none above `most` times its source.

    What resharing the excess again and again tends to is a common level: each source gets the lesser of
    its cap and weight x level. Ordered by cap / weight, the capped sources come first, so the level
    follows from two running sums over the table of sources."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    by_source = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(by_name))
        .withColumn("w", F.get(cycle, F.pmod(F.col("rank") - 1, F.lit(len(weights)))))
        .withColumn("cap", (F.col("source_size") * most).cast("double"))
    )
    order = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    levels = by_source.withColumns(
        {
            "place": F.row_number().over(order),
            "level": (F.sum("source_size").over(every) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)),
        }
    )
    free = F.min(F.when(F.col("cap") / F.col("w") > F.col("level"), F.struct("place", "level"))).over(every)
    target = F.when(free.isNull() | (F.col("place") < free["place"]), F.col("cap")).otherwise(F.col("w") * free["level"])
    return levels.select("source", "source_size", F.least(target, F.col("cap")).alias("target"))


def thresholds(sizes: DataFrame, wanted: DataFrame) -> DataFrame:
    """source, source_size, target, whole (copies of every document), upto, upto_r (documents whose h is below upto, or
    equal to it with an r of up to upto_r, get one more).

    The document at the threshold is taken if that brings the sum nearer to the target."""
    n = F.col("source_size").cast("double")
    whole = F.when((n > 0) & (F.col("target") >= n), F.lit(1)).otherwise(F.lit(0))
    state = ["source", "source_size", "target", "whole"]
    open_ = wanted.select("source", "source_size", "target", whole.alias("whole"))
    open_ = open_.select(*state, (F.col("target") - F.col("whole") * n).alias("left"), F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("at_h"))
    open_ = open_.checkpoint()
    done, rows = [], open_.count()
    levels = [(key, low) for key in ("h", "r") for low in range(BITS - STEP, -1, -STEP)]
    for key, low in levels:
        inside = sizes.join(common.beside(open_.select(F.col("source").alias("s"), "prefix", "at_h"), rows), F.col("source").eqNullSafe(F.col("s")))
        inside = inside.where(F.shiftright(key, low + STEP) == F.col("prefix"))
        if key == "r":
            inside = inside.where(F.col("h") == F.col("at_h"))
        hist = inside.groupBy("source", F.shiftright(key, low).alias("bucket")).agg(F.sum("size").alias("words"), F.count("*").alias("n"), F.max(F.struct("h", "r")).alias("most"))
        running = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        hist = hist.withColumn("upto_here", running).select(F.col("source").alias("s"), "bucket", "words", "n", "most", "upto_here")
        at = (
            open_.join(hist, F.col("source").eqNullSafe(F.col("s")) & (F.col("upto_here") > F.col("left")), "left")
            .groupBy(*state, "left", "at_h")
            .agg(F.min(F.struct("bucket", "words", "n", "most", "upto_here")).alias("at"))
            .checkpoint()
        )
        rest = F.col("left") - (F.col("at.upto_here") - F.col("at.words"))
        none, last = F.col("at.bucket").isNull(), (F.col("at.n") == 1) | F.lit((key, low) == levels[-1])
        # all of the source (or, by r, all that are left); with the document of the bucket; without it
        all_ = F.struct(F.lit(1 << BITS).cast("long").alias("h"), F.lit(0).cast("long").alias("r"))
        if key == "r":
            all_ = F.struct(F.col("at_h").alias("h"), F.lit(1 << BITS).cast("long").alias("r"))
        without = F.struct(F.col("at.most.h").alias("h"), (F.col("at.most.r") - 1 if key == "h" else F.shiftleft("at.bucket", low) - 1).alias("r"))
        upto = F.when(none, all_).when(rest * 2 >= F.col("at.words"), F.col("at.most")).otherwise(without)
        done.append(at.where(none | last).select(*state, upto.alias("u")).select(*state, F.col("u.h").alias("upto"), F.col("u.r").alias("upto_r")))
        single = F.lit(key == "h" and low == 0)
        prefix, at_h = F.when(single, F.lit(0).cast("long")).otherwise(F.col("at.bucket")), F.when(single, F.col("at.bucket")).otherwise(F.col("at_h"))
        open_ = at.where(~none & ~last).select(*state, rest.alias("left"), prefix.alias("prefix"), at_h.alias("at_h"))
        if not (rows := open_.count()):
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _taken(h: Column, r: Column, upto: Column, upto_r: Column) -> Column:
    return ((h < upto) | ((h == upto) & (r <= upto_r))).cast("int")


def copies(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target, copies (0 to `most`) for each row of docs."""
    if not 0 < share <= most == 2:
        raise ValueError("a share above 0 and up to 2 copies are offered")
    sizes = common.stored(sized(docs), "sizes")
    limits = thresholds(sizes, targets(sizes, weights, share, most)).checkpoint()
    limits = common.beside(limits.withColumnRenamed("source", "s"), limits.count())
    joined = sizes.join(limits, F.col("source").eqNullSafe(F.col("s")))
    more = _taken(F.col("h"), F.col("r"), F.col("upto"), F.col("upto_r"))
    return joined.select("doc_id", "size", "source_size", "target", (F.col("whole") + more).alias("copies"))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs as often as the mix takes them. The copies of a row depend on its source and
    columns alone, so the limits are joined to docs rather than counts to rows."""
    sizes = common.stored(sized(docs, row_hash(docs)), "sizes")
    limits = thresholds(sizes, targets(sizes, **how)).checkpoint()
    s, whole, upto, upto_r = names = common.fresh(docs, "s", "whole", "upto", "upto_r")
    limits = common.beside(limits.select(*[F.col(c).alias(n) for c, n in zip(("source", "whole", "upto", "upto_r"), names, strict=True)]), limits.count())
    n = F.col(whole) + _taken(doc_hash(), row_hash(docs), F.col(upto), F.col(upto_r))
    taken = docs.join(limits, F.col("source").eqNullSafe(F.col(s)))
    return taken.withColumn(s, F.explode(F.array_repeat(F.lit(1), n))).select(*[docs[c] for c in docs.columns])


def op5_mixing_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = copies(common.documents(spark, sf_dir))
    return out.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), (F.col("size") * F.col("copies")).alias("taken"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h,
         row_number() OVER () AS r
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS n, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM d GROUP BY source),
w AS (SELECT *, CASE (k - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w, (n * 2)::DOUBLE AS cap FROM s),
l AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, k) AS place,
         ((SELECT sum(n)::DOUBLE FROM s) * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY cap / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
f AS (SELECT min(place) AS place, arg_min(level, place) AS level FROM l WHERE cap / w > level),
t AS (
  SELECT source, n, CASE WHEN f.place IS NULL OR l.place < f.place THEN cap ELSE least(w * f.level, cap) END AS target FROM l, f),
b AS (SELECT *, CASE WHEN n > 0 AND target >= n THEN 1 ELSE 0 END AS whole FROM t),
r AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h, r ROWS UNBOUNDED PRECEDING)::BIGINT AS upto_here FROM d)
SELECT r.doc_id, r.size, b.n AS source_size, round(b.target, 3) AS target,
       r.size * (b.whole + (upto_here <= target - whole * n
         OR (upto_here - size <= target - whole * n AND (target - whole * n - (upto_here - size)) * 2 >= size))::INT) AS taken
FROM r JOIN b ON r.source IS NOT DISTINCT FROM b.source
"""

QUERIES = {"op5_mixing_weights": op5_mixing_weights}
SQL = {"op5_mixing_weights": ORACLE}

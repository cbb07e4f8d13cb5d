"""Entity and truth tables from tab-separated files, their samples, and the outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftlink.sources.storage import stored

# Other names of the columns, and texts that stand for a missing value.
ALIASES = {
    "business_name": "name",
    "company_name": "name",
    "businessname": "name",
    "business_address": "address",
    "address_text": "address",
    "businessaddress": "address",
    "source1_entity_id": "entity_id",
    "source_1_id": "entity_id",
    "s1_id": "entity_id",
}
MISSING = ("#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
COLUMNS = ("entity_id", "name", "address", "country")


def present(c: Column) -> Column:
    """Text with '' for what is missing."""
    return F.when(c.isNull() | c.isin(*MISSING), F.lit("")).otherwise(c)


def shaped(df: DataFrame) -> DataFrame:
    """The four columns of an entity table from a frame whose columns go by any of their names; those that
    aren't there are empty. Further columns stay."""
    named = {}
    for c in df.columns:
        low = c.strip().lower()
        named.setdefault(ALIASES.get(low, low), c)
    rest = [c for n, c in named.items() if n not in COLUMNS]
    four = [(present(F.col(f"`{named[n]}`").cast("string")) if n in named else F.lit("")).alias(n) for n in COLUMNS]
    return df.select(*four, *rest)


def read_tsv(spark: SparkSession, path: str | list[str], header: bool = True) -> DataFrame:
    """All columns as text; a doubled quote is a quote. Only the header line is read for the schema."""
    return spark.read.csv(path, sep="\t", header=header, inferSchema=False, quote='"', escape='"', multiLine=False, encoding="UTF-8")


def read_entities(spark: SparkSession, path: str | list[str], limit: int | None = None) -> DataFrame:
    df = shaped(read_tsv(spark, path))
    return df if limit is None else df.limit(limit)


def truth_shaped(df: DataFrame) -> DataFrame:
    """sid, trues, n_matches: the first column unless one is called source1_entity_id, and the first that
    speaks of matches; lists are parted by commas, blanks go."""
    sid = next((c for c in df.columns if c.strip().lower() == "source1_entity_id"), df.columns[0])
    ids = next((c for c in df.columns if c != sid and any(w in c.lower() for w in ("matched", "candidate", "target"))), None)
    listed = present(F.col(f"`{ids}`").cast("string")) if ids else F.lit("")
    trues = F.filter(F.transform(F.split(listed, ","), lambda x: F.trim(x)), lambda x: x != "")
    return df.select(F.trim(F.col(f"`{sid}`")).alias("sid"), trues.alias("trues")).withColumn("n_matches", F.size("trues"))


def read_truth(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return truth_shaped(read_tsv(spark, path))


def slice_rows(df: DataFrame, skip: int, n: int, order: str = "ord") -> DataFrame:
    """Rows skip + 1 to skip + n in order; Spark keeps only skip + n of each task."""
    return df.orderBy(order).offset(skip).limit(n)


def matched_sample(s1: DataFrame, others: dict[str, DataFrame], truth: DataFrame, n: int, distractors: int, skip: int = 0) -> dict[str, DataFrame]:
    """n rows of truth from place `skip` on, their entities, all their true partners, and the first
    `distractors` rows of each other table."""
    truth = slice_rows(truth, skip, n)
    wanted = truth.select(F.explode("trues").alias("entity_id")).distinct()
    out = {"truth": truth, "s1": s1.join(truth.select(F.col("sid").alias("entity_id")), "entity_id", "left_semi")}
    for name, df in others.items():
        first = df.orderBy("ord").limit(distractors)
        out[name] = df.join(wanted, "entity_id", "left_semi").unionByName(first.join(wanted, "entity_id", "left_anti"))
    return out


def record_store(records: DataFrame, table: str, buckets: int = 64) -> None:
    """Records as a table bucketed by id, so that lookups and joins by id need no shuffle."""
    records.fillna("").write.mode("overwrite").bucketBy(buckets, "entity_id").sortBy("entity_id").saveAsTable(table)


def lookup(store: DataFrame, ids: DataFrame) -> DataFrame:
    """Records with the ids; empty suffixes and postal codes are missing again."""
    found = store.join(ids.select("entity_id").distinct(), "entity_id", "left_semi")
    return found.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in ("suffix", "postal_code")})


def output_rows(entities: DataFrame, lists: DataFrame, ids_name: str, order: str = "ord") -> DataFrame:
    """source1_entity_id and the comma-joined list of every entity, in order: ids trimmed, each once, blank
    if there is none."""
    ids = F.array_distinct(F.transform(F.coalesce("cids", F.array().cast("array<string>")), lambda x: F.trim(x)))
    rows = entities.select(F.col("entity_id").alias("sid"), F.col(order).alias("ord")).join(lists, "sid", "left")
    return rows.select("ord", F.col("sid").alias("source1_entity_id"), F.array_join(F.filter(ids, lambda x: x != ""), ",").alias(ids_name))


def write_tsv(rows: DataFrame, path: str, one_file: bool = True) -> None:
    """Rows in their order, tab-separated with a header. Several files keep the order by name."""
    rows = rows.orderBy("ord").drop("ord")
    (rows.coalesce(1) if one_file else rows).write.mode("overwrite").csv(path, sep="\t", header=True, emptyValue="", nullValue="", quote='"', escape='"')


def write_submission(entities: DataFrame, candidates: DataFrame, matches: DataFrame, folder: str) -> None:
    write_tsv(output_rows(entities, candidates, "candidate_entity_ids"), f"{folder}/candidate_pairs")
    write_tsv(output_rows(entities, matches, "matched_entity_ids"), f"{folder}/matching_results")


def placed(df: DataFrame, order: str = "ord") -> DataFrame:
    """df with place__, its rows' places (from 0) in order. Ranges are sorted each by itself, and only how many rows
    each of them has comes to the driver. The ranges are stored first, as Spark would draw others if asked again."""
    ranges = stored(df.repartitionByRange(order).withColumn("range__", F.spark_partition_id()), "ranges")
    before, n = {}, 0
    for r in sorted(ranges.groupBy("range__").count().collect()):
        before[r["range__"]], n = n, n + r["count"]
    if not before:
        return ranges.withColumn("place__", F.lit(0).cast("long")).drop("range__")
    first = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])[F.col("range__")]
    inside = F.row_number().over(Window.partitionBy("range__").orderBy(order))
    return ranges.withColumn("place__", (first + inside - 1).cast("long")).drop("range__")


def shards_of(df: DataFrame, shards: int, order: str = "ord") -> list[DataFrame]:
    """What runs over `shards` equal ranges get, in order; the last has what is left."""
    rows = placed(df, order)
    size = max(1, -(-rows.count() // shards))
    return [rows.where(F.col("place__").between(i * size, (i + 1) * size - 1)).drop("place__") for i in range(shards)]


def shard(df: DataFrame, shards: int, which: int, order: str = "ord") -> DataFrame:
    """The rows that a run over `shards` equal ranges gives to one of them."""
    return shards_of(df, shards, order)[which]


def merged(parts: list[DataFrame], first: str = "source1_entity_id") -> DataFrame:
    """Outputs of shards as one: header and blank lines go."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where((F.trim(F.coalesce(F.col(first), F.lit(""))) != "") & (F.col(first) != first))


ENTITY_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS])

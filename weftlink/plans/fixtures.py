"""Entity tables made of the driver's tables, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.functions.normalize import COMPOUNDS, LANDMARK, LEGAL, POSTAL, WEB, normalized

SPACE = r"[\x20\x09-\x0D]+"
SUFFIXES = ("Corp", "Private Limited", "Ltd", "& Sons", ".com", "Inc.")
COUNTRIES = ("us", "india", "france", "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ids(key: str) -> list:
    source = (F.col(key) % 3 + 1).cast("int")
    number = F.col(key).cast("string")
    return [F.concat(F.lit("S"), source.cast("string"), F.lit("-"), F.lpad(number, 8, "0")).alias("entity_id"), F.col(key).alias("ord"), source.alias("source")]


def doc_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record of each document: its first words are the name, the next the address; text_key tells copies."""
    words = F.split(F.trim(F.regexp_replace("text", SPACE, " ")), " ")
    docs = table(spark, sf_dir, "documents").withColumns({"w": F.slice(words, 1, 12), "text_key": F.md5("text")})
    name, address = F.array_join(F.slice("w", 1, 4), " "), F.array_join(F.slice("w", 5, 8), " ")
    return docs.select(*_ids("doc_id"), name.alias("name"), address.alias("address"), F.col("lang").alias("country"), "text_key")


def cust_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record of each customer, with legal forms, landmarks and postal codes."""
    customer, nation, part = (table(spark, sf_dir, t) for t in ("customer", "nation", "part"))
    n = part.count()
    joined = customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    joined = joined.withColumn("p", F.col("c_custkey") * 31 % n).join(part.select("p_partkey", "p_name"), F.col("p") == F.col("p_partkey"))
    key = F.col("c_custkey")
    pick = lambda words, k: F.element_at(F.array(*map(F.lit, words)), (k + 1).cast("int"))
    landmark = F.when(key % 4 == 0, F.concat(F.lit(" near "), "n_name")).otherwise(F.lit(""))
    address = F.concat((key % 97).cast("string"), F.lit(" "), "c_mktsegment", F.lit(" road"), landmark, F.lit(" "), F.lpad((key * 7919 % 1000000).cast("string"), 6, "0"))
    name = F.concat("p_name", F.lit(" "), pick(SUFFIXES, key % 6))
    return joined.select(*_ids("c_custkey"), name.alias("name"), address.alias("address"), pick(COUNTRIES, F.col("c_nationkey") % 4).alias("country"))


def sides(entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records of the first source, and of all others."""
    return entities.where("source = 1"), entities.where("source <> 1")


def docs_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized(doc_entities(spark, sf_dir))


def custs_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized(cust_entities(spark, sf_dir))


def doc_truth(entities: DataFrame) -> DataFrame:
    """sid, trues: records of other sources with the same text."""
    s1, other = sides(entities)
    pairs = s1.select(F.col("entity_id").alias("sid"), "text_key").join(other.select(F.col("entity_id").alias("cid"), "text_key"), "text_key")
    lists = pairs.groupBy("sid").agg(F.array_sort(F.collect_list("cid")).alias("trues"))
    return s1.select(F.col("entity_id").alias("sid")).join(lists, "sid", "left").withColumn("trues", F.coalesce("trues", F.array().cast("array<string>")))


# The same in DuckDB's SQL: common table expressions, in the order that they build on one another.
def _id(key: str) -> str:
    return f"'S' || (1 + {key} % 3)::VARCHAR || '-' || lpad({key}::VARCHAR, 8, '0') AS entity_id, {key} AS ord, (1 + {key} % 3)::INT AS source"


DOC_SQL = rf"""
d0 AS (SELECT doc_id, lang, md5(text) AS text_key, string_split(trim(regexp_replace(text, '{SPACE}', ' ', 'g')), ' ') AS w FROM documents),
ent AS (SELECT {_id("doc_id")}, array_to_string(w[1:4], ' ') AS name, array_to_string(w[5:12], ' ') AS address, lang AS country, text_key FROM d0)"""

CUST_SQL = rf"""
ent AS (
  SELECT {_id("c_custkey")}, p_name || ' ' || [{", ".join(f"'{s}'" for s in SUFFIXES)}][1 + c_custkey % 6] AS name,
    (c_custkey % 97)::VARCHAR || ' ' || c_mktsegment || ' road' || CASE WHEN c_custkey % 4 = 0 THEN ' near ' || n_name ELSE '' END || ' '
      || lpad((c_custkey * 7919 % 1000000)::VARCHAR, 6, '0') AS address,
    [{", ".join(f"'{c}'" for c in COUNTRIES)}][1 + c_nationkey % 4] AS country, '' AS text_key
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN part ON p_partkey = c_custkey * 31 % (SELECT count(*) FROM part))"""

_LEGAL = "[" + ", ".join(f"'{k}'" for k in LEGAL) + "]"
_FORM = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LEGAL.items())
_COMPOUND = " ".join(rf"WHEN regexp_matches(n0, '\b{c}\b') THEN '{v}'" for c, v in COMPOUNDS)
_WITHOUT = " ".join(rf"WHEN regexp_matches(n0, '\b{c}\b') THEN regexp_replace(n0, '\b{c}\b', ' ', 'g')" for c, _ in COMPOUNDS)


def squeezed_sql(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace({x}, '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def tokens_sql(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def _postal_sql() -> str:
    own = [f"CASE WHEN country = '{k}' THEN nullif(regexp_extract(a0, '{p}', 0), '') END" for k, p in POSTAL.items()]
    return "coalesce(" + ", ".join([*own, *[f"nullif(regexp_extract(a0, '{p}', 0), '')" for p in POSTAL.values()]]) + ")"


NORM_SQL = rf"""
m0 AS (SELECT * REPLACE (lower(trim(coalesce(country, ''))) AS country), regexp_replace(trim(lower(name)), '{WEB}', '', 'g') AS n0, trim(lower(address)) AS a0 FROM ent),
m1 AS (
  SELECT *, CASE {_COMPOUND} END AS c0, {squeezed_sql(f"CASE {_WITHOUT} ELSE n0 END")} AS normalized_name,
    nullif(trim(regexp_extract(a0, '{LANDMARK}', 0)), '') AS landmark, {_postal_sql()} AS postal_code,
    {squeezed_sql(f"regexp_replace(a0, '{LANDMARK}', '', 'g')")} AS normalized_addr FROM m0),
m2 AS (SELECT *, {tokens_sql("normalized_name")} AS tk, list_sort({tokens_sql("normalized_addr")}) AS ak FROM m1),
m3 AS (SELECT *, list_filter(tk, lambda t: NOT list_contains({_LEGAL}, t)) AS core, list_filter(tk, lambda t: list_contains({_LEGAL}, t))[1] AS legal FROM m2),
rec AS (
  SELECT entity_id, ord, source, country, name AS raw_name, normalized_name, array_to_string(core, ' ') AS core_name, array_to_string(list_sort(core), ' ') AS sorted_core,
    coalesce(c0, CASE legal {_FORM} END) AS suffix, address AS raw_addr, normalized_addr, array_to_string(ak, ' ') AS sorted_addr_tokens, postal_code, landmark, text_key
  FROM m3),
s1 AS (SELECT * FROM rec WHERE source = 1), oth AS (SELECT * FROM rec WHERE source <> 1)"""

TRUTH_SQL = """
gt AS (SELECT s1.entity_id AS sid, oth.entity_id AS cid FROM s1 JOIN oth USING (text_key)),
tru AS (SELECT s1.entity_id AS sid, coalesce(list_sort(list(gt.cid) FILTER (gt.cid IS NOT NULL)), []) AS trues FROM s1 LEFT JOIN gt ON gt.sid = s1.entity_id GROUP BY s1.entity_id)"""

"""Document fingerprints: Merkle trees over blocks, paragraphs and sections. DataFrame functions only.

A text is cut at blank lines into sections, each section at line ends into paragraphs, and a paragraph into
blocks: sentences of 64 code points or more, and where none ends within 256, that many. So blocks after an edit
are cut as before it. Leaves hash blocks, a section hashes its text and its leaves, the root hashes the sections,
the last two with all 128 bits of MD5. The fingerprint is written out, with the root first:

    root.section:leaf,leaf;leaf/section:leaf

with commas between blocks and semicolons between paragraphs, where a leaf is 12 hex digits of its MD5,
"-" and its length; so it can be compared without the text.
Equal texts have equal fingerprints, and unequal branches name the sections and blocks that differ.

Defined results: a null text counts as empty; its tree has one section without leaves. A very long text is hashed whole.
Rows with the same doc_id follow each other in the order of a hash of their texts; a null doc_id comes first. An empty
table gives an empty result. The only document of a table is its own successor. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftlink.llm import common

#: Rows that share a bucket of successive doc_ids; buckets at most.
ROWS, BUCKETS = 2_000, 65_536
#: Blocks of a paragraph.
BLOCK = r"(?s).{64,254}?[.!?]\x20|.{1,256}"


def tree(section: Column) -> Column:
    """The leaves of a section, written out: blocks parted by commas, paragraphs by semicolons."""
    leaf = lambda b: F.concat(F.substring(F.md5(b), 1, 12), F.lit("-"), F.length(b).cast("string"))
    blocks = lambda p: F.regexp_extract_all(p, F.lit(BLOCK), F.lit(0))
    return F.array_join(F.transform(F.split(section, "\n", -1), lambda p: F.array_join(F.transform(blocks(p), leaf), ",")), ";")


def fingerprint(text: Column) -> Column:
    parts = F.transform(F.split(text, "\n\n", -1), lambda s: F.struct(F.md5(s).alias("whole"), tree(s).alias("leaves")))
    sections = F.transform(parts, lambda x: F.concat(F.md5(F.concat(x["whole"], F.lit(":"), x["leaves"])), F.lit(":"), x["leaves"]))
    root = F.md5(F.array_join(F.transform(sections, lambda s: F.substring_index(s, ":", 1)), "/"))
    return F.concat(root, F.lit("."), F.array_join(sections, "/"))


def branches(fp: Column) -> Column:
    """The leaves of a written fingerprint, each once."""
    return F.array_distinct(F.regexp_extract_all(fp, F.lit("[0-9a-f]{12}-[0-9]+"), F.lit(0)))


def weight(leaf_list: Column) -> Column:
    return F.aggregate(leaf_list, F.lit(0).cast("long"), lambda n, x: n + F.substring_index(x, "-", -1).cast("long"))


def likeness(a: Column, b: Column, la: Column, lb: Column) -> Column:
    """Share of the code points that stand in common branches la and lb of fingerprints a and b, 0 to 1;
    1 for equal trees."""
    both = (weight(la) + weight(lb)).cast("double")
    return F.when(F.substring_index(a, ".", 1) == F.substring_index(b, ".", 1), F.lit(1.0)).otherwise(
        F.coalesce(F.round(F.try_divide(weight(F.array_intersect(la, lb)) * 2, both), 6), F.lit(0.0))
    )


def differing_sections(a: Column, b: Column) -> Column:
    """Places (from 0) of the sections of a that b's tree doesn't have at the same place."""
    parts = lambda fp: F.split(F.substring_index(fp, ".", -1), "/", -1)
    return F.filter(F.transform(parts(a), lambda s, i: F.when(F.get(parts(b), i).eqNullSafe(s), F.lit(None)).otherwise(i)), lambda i: i.isNotNull())


def _bucket(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most doc_id: first among every k-th, then among k."""
    k = max(1, math.isqrt(len(bounds)))
    coarse = F.array(*[F.lit(x).cast("long") for x in bounds[::k]])
    rows = F.array(*[F.array(*[F.lit(x).cast("long") for x in bounds[i : i + k]]) for i in range(0, len(bounds), k)])
    block = F.size(F.filter(coarse, lambda x: x <= doc_id))
    fine = F.size(F.filter(F.get(rows, block - 1), lambda x: x <= doc_id))
    return F.when(doc_id.isNull() | (block == 0), F.lit(0)).otherwise((block - 1) * k + fine)


def with_next(docs: DataFrame, derived: dict[str, Column], rows: int = ROWS) -> DataFrame:
    """docs (doc_id, text) with the derived columns, and next_<c> of each from the document that follows
    in the order of doc_id; the first follows the last.

    The texts are shuffled once: to buckets of neighbouring doc_ids, where the first row of a bucket goes
    to the bucket before it, too. The bounds come from a pass over doc_id alone."""
    ids = docs.select("doc_id")
    n = ids.count()
    if not n:
        return docs.withColumns(derived).select("*", *[F.col(c).alias(f"next_{c}") for c in ("text", *derived)])
    p = min(BUCKETS, max(1, n // rows))
    cuts = ids.agg(F.percentile_approx("doc_id", [i / p for i in range(1, p + 1)], max(10_000, 4 * p)).alias("b")).first()["b"] if p > 1 else []
    bounds = sorted(set(cuts or []))
    bucket = _bucket(F.col("doc_id"), bounds) if bounds else F.lit(0)
    firsts = sorted((r["bucket"], r["least"]) for r in ids.groupBy(bucket.alias("bucket")).agg(F.min(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("least")).collect())
    # first row of each bucket: wanted by the bucket before; that of the first by the last
    halo = [(least, firsts[i - 1][0], int(i == 0)) for i, (_, least) in enumerate(firsts)]
    table = docs.sparkSession.createDataFrame(halo, "h__ long, to__ int, wraps__ int")
    own = docs.withColumns({"bucket__": bucket, "halo__": F.lit(0)})
    extra = (
        own.join(F.broadcast(table), F.coalesce("doc_id", F.lit(-(1 << 63))) == F.col("h__"))
        .withColumns({"bucket__": F.col("to__"), "halo__": F.col("wraps__") + 1})
        .select(*own.columns)
    )
    order = Window.partitionBy("bucket__").orderBy(F.when(F.col("halo__") > 0, 1).otherwise(0), F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    both = own.unionByName(extra).withColumns(derived)
    return both.withColumns({f"next_{c}": F.lead(c).over(order) for c in ("text", *derived)}).where(F.col("halo__") == 0).drop("bucket__", "halo__")


def compared(docs: DataFrame) -> DataFrame:
    """For each document its fingerprint, that of its edited text (the last half replaced by as much of
    the next document's start), and their likeness."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", text.alias("text"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half))
    out = with_next(base, {"fingerprint": fingerprint(F.col("text"))}).withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", edited)
    out = out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", fingerprint(F.col("edited")).alias("edited_fingerprint"), "next_fingerprint")
    fps = {"l1": "fingerprint", "l2": "edited_fingerprint", "l3": "next_fingerprint"}
    out = out.withColumns({k: branches(F.col(v)) for k, v in fps.items()})
    near = lambda other, l: likeness(F.col("fingerprint"), F.col(other), F.col("l1"), F.col(l))  # noqa: E731, E741
    return out.withColumns({"near_edited": near("edited_fingerprint", "l2"), "near_next": near("next_fingerprint", "l3")}).drop(*fps, "next_fingerprint")


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(common.documents(spark, sf_dir))


_TREE = r"""
  list_transform(list_transform(string_split({t}, chr(10) || chr(10)), lambda s: struct_pack(whole := md5(s), leaves :=
    array_to_string(list_transform(string_split(s, chr(10)), lambda p: array_to_string(list_transform(regexp_extract_all(p, '(?s).{{64,254}}?[.!?]\x20|.{{1,256}}'),
      lambda b: substr(md5(b), 1, 12) || '-' || length(b)::VARCHAR), ',')), ';'))), lambda x: md5(x.whole || ':' || x.leaves) || ':' || x.leaves)"""
_WRITTEN = r"""
  md5(array_to_string(list_transform({s}, lambda x: split_part(x, ':', 1)), '/')) || '.' || array_to_string({s}, '/')"""
_LIKE = r"""
  CASE WHEN split_part({a}, '.', 1) = split_part({b}, '.', 1) THEN 1.0::DOUBLE
       WHEN coalesce(list_sum(list_transform({la} || {lb}, lambda x: split_part(x, '-', 2)::BIGINT)), 0) = 0 THEN 0.0::DOUBLE
       ELSE round(coalesce(list_sum(list_transform(list_intersect({la}, {lb}), lambda x: split_part(x, '-', 2)::BIGINT)), 0)::DOUBLE * 2
            / list_sum(list_transform({la} || {lb}, lambda x: split_part(x, '-', 2)::BIGINT))::DOUBLE, 6) END"""
_LEAVES = "list_distinct(regexp_extract_all({f}, '[0-9a-f]{{12}}-[0-9]+'))"

ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n FROM documents),
o AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id NULLS FIRST), first_value(text) OVER (ORDER BY doc_id NULLS FIRST)) AS next FROM d),
e AS (SELECT *, substr(text, 1, n - n // 2) || substr(next, 1, n // 2) AS edited FROM o),
t AS (SELECT *, {_TREE.format(t="text")} AS s1, {_TREE.format(t="edited")} AS s2, {_TREE.format(t="next")} AS s3 FROM e),
f AS (SELECT doc_id, n, sha256(edited) AS edited_sha256, {_WRITTEN.format(s="s1")} AS f1,
             {_WRITTEN.format(s="s2")} AS f2, {_WRITTEN.format(s="s3")} AS f3 FROM t),
l AS (SELECT *, {_LEAVES.format(f="f1")} AS l1, {_LEAVES.format(f="f2")} AS l2, {_LEAVES.format(f="f3")} AS l3 FROM f)
SELECT doc_id, n AS n_chars, edited_sha256, f1 AS fingerprint, f2 AS edited_fingerprint,
       {_LIKE.format(a="f1", b="f2", la="l1", lb="l2")} AS near_edited, {_LIKE.format(a="f1", b="f3", la="l1", lb="l3")} AS near_next
FROM l
"""

QUERIES = {"op2_document_fingerprints": op2_document_fingerprints}
SQL = {"op2_document_fingerprints": ORACLE}

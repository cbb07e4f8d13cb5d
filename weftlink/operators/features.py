"""Features of candidate pairs: one projection over the pair joined to both normalized records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftlink.functions import keys, phonetic, translit
from weftlink.functions import similarity as S
from weftlink.functions.normalize import RECORD, tokens


def joined(pairs: DataFrame, s1: DataFrame, other: DataFrame) -> DataFrame:
    """Pairs (sid, cid, ...) with both records as s_* and c_*; pairs without a record on either side go."""
    left = s1.select(*[F.col(c).alias("sid" if c == "entity_id" else f"s_{c}") for c in RECORD])
    right = other.select(*[F.col(c).alias("cid" if c == "entity_id" else f"c_{c}") for c in RECORD])
    return pairs.join(left, "sid").join(right, "cid")


def _flag(x: Column) -> Column:
    return F.coalesce(x, F.lit(False)).cast("int")


def _same(a: Column, b: Column) -> Column:
    return _flag((a != "") & (a == b))


def _codes(core: Column) -> Column:
    # words without a Latin letter have no code, and don't count
    return F.filter(phonetic.codes(tokens(core)), lambda c: c != "")


def native() -> dict[str, Column]:
    """The features that Catalyst expresses alone."""
    c = F.col
    n1, n2, k1, k2, a1, a2 = c("s_normalized_name"), c("c_normalized_name"), c("s_core_name"), c("c_core_name"), c("s_normalized_addr"), c("c_normalized_addr")
    bare1, bare2 = F.replace(n1, F.lit(" "), F.lit("")), F.replace(n2, F.lit(" "), F.lit(""))
    plain1, plain2 = F.regexp_replace(n1, r"[^\p{L}\p{N}_]", ""), F.regexp_replace(n2, r"[^\p{L}\p{N}_]", "")
    both = (a1 != "") & (a2 != "")
    longer = F.greatest(F.length(n1), F.length(n2))
    num1, num2 = keys.address_numbers(c("s_raw_addr")), keys.address_numbers(c("c_raw_addr"))
    common = F.size(F.array_intersect(num1, num2))
    acr1, acr2 = keys.acronym(k1), keys.acronym(k2)
    return {
        "name_exact": _same(n1, n2),
        "name_core_exact": _same(k1, k2),
        "name_sorted_exact": _same(c("s_sorted_core"), c("c_sorted_core")),
        "name_suffix_match": _same(c("s_suffix"), c("c_suffix")),
        "name_levenshtein": S.levenshtein_of(n1, n2),
        "name_jaccard": S.jaccard_of(tokens(n1), tokens(n2)),
        "name_len_diff": F.abs(F.length(n1) - F.length(n2)),
        "name_len_ratio": F.when(longer == 0, F.lit(1.0)).otherwise(F.least(F.length(n1), F.length(n2)) / F.greatest(longer, F.lit(1))),
        "name_nospace_exact": _same(bare1, bare2),
        "name_nospace_lev": S.levenshtein_of(bare1, bare2),
        "domain_subname_match": _flag((F.length(plain1) >= 5) & (F.length(plain2) >= 5) & (F.contains(plain1, plain2) | F.contains(plain2, plain1))),
        "acronym_match": _flag(((F.length(acr1) >= 2) & (acr1 == k2)) | ((F.length(acr2) >= 2) & (acr2 == k1))),
        "addr_either_empty": _flag(~both),
        "addr_levenshtein": F.when(both, S.levenshtein_of(a1, a2)).otherwise(F.lit(0.0)),
        "addr_token_jaccard": F.when(both, S.jaccard_of(tokens(a1), tokens(a2))).otherwise(F.lit(0.0)),
        "addr_postal_match": _same(c("s_postal_code"), c("c_postal_code")),
        "addr_postal_missing": _flag(c("s_postal_code").isNull() | c("c_postal_code").isNull()),
        "addr_landmark_match": _same(c("s_landmark"), c("c_landmark")),
        "addr_len_diff": F.abs(F.length(a1) - F.length(a2)),
        "has_common_addr_num": _flag(common > 0),
        "num_common_addr_nums": common,
        "country_match": _same(c("s_country"), c("c_country")),
        "country_missing": _flag((c("s_country") == "") | (c("c_country") == "")),
        "source_is_s2": _flag(c("cid").startswith("S2-")),
    }


def by_sound() -> dict[str, Column]:
    p1, p2 = _codes(F.col("s_core_name")), _codes(F.col("c_core_name"))
    return {"name_phonetic_match": _same(F.array_join(p1, " "), F.array_join(p2, " ")), "name_phonetic_jaccard": S.jaccard_of(p1, p2)}


def by_kernel() -> dict[str, Column]:
    """The features that need an Arrow kernel."""
    c = F.col
    n1, n2, a1, a2 = c("s_normalized_name"), c("c_normalized_name"), c("s_normalized_addr"), c("c_normalized_addr")
    join = lambda n, a: F.trim(F.concat_ws(" ", n, a))
    return {
        "name_jaro_winkler": S.jaro_winkler_of(n1, n2),
        "name_token_sort_ratio": S.token_sort_of(n1, n2),
        "name_token_set_ratio": S.token_set_of(n1, n2),
        "name_transliterated_sim": S.token_set_of(translit.latin(c("s_raw_name")), translit.latin(c("c_raw_name"))),
        "addr_token_sort_ratio": F.when((a1 != "") & (a2 != ""), S.token_sort_of(a1, a2)).otherwise(F.lit(0.0)),
        "combined_token_set": S.token_set_of(join(n1, a1), join(n2, a2)),
    }


def featured(pairs: DataFrame, s1: DataFrame, other: DataFrame, embedding: str | None = None) -> DataFrame:
    """Pairs with all features; `embedding` names a column of cosines of the pairs, 0 without one."""
    df = joined(pairs, s1, other).withColumns(native() | by_sound()).withColumns(by_kernel())
    df = df.withColumn("high_confidence_addr_match", F.col("has_common_addr_num") * (F.col("addr_token_sort_ratio") >= 0.65).cast("int"))
    df = df.withColumn("max_name_sim", F.greatest("name_token_set_ratio", "name_transliterated_sim", "name_nospace_lev", F.col("domain_subname_match").cast("double")))
    df = df.withColumn("joint_confidence", F.greatest("max_name_sim", F.col("high_confidence_addr_match") * 0.95))
    df = df.withColumn("embedding_cosine", F.coalesce(F.col(embedding), F.lit(0.0)) if embedding else F.lit(0.0))
    return df.drop(*[f"{side}_{c}" for side in "sc" for c in RECORD])


#: Columns that aren't features of a pair.
NOT_FEATURES = ("sid", "cid", "pass", "pos", "rank", "k", "label", "fold", "score", "weight")


def feature_columns(df: DataFrame) -> list[str]:
    numeric = ("int", "bigint", "double", "float")
    return [c for c, kind in df.dtypes if c not in NOT_FEATURES and kind in numeric]


def ranked(df: DataFrame, by: str = "sid", score: str = "joint_confidence", tie: str = "cid") -> DataFrame:
    """rank_within_s1, gap_to_next_best (to the row's own successor, 0 at the end), s1_candidate_count."""
    order = Window.partitionBy(by).orderBy(F.desc(score), tie)
    gap = F.coalesce(F.abs(F.col(score) - F.lead(score).over(order)), F.lit(0.0))
    return df.withColumns({"rank_within_s1": F.row_number().over(order), "gap_to_next_best": gap, "s1_candidate_count": F.count("*").over(Window.partitionBy(by))})

"""Names and addresses as normalized keys, in Catalyst expressions.

Text outside ASCII takes one Arrow pass for the NFKC form, which Spark has no function for."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Legal forms and their short forms, compounds in order of precedence, words that begin a
# landmark, postal codes by country in order of precedence, endings of web names.
LEGAL = {
    "corporation": "corp",
    "corp": "corp",
    "incorporated": "inc",
    "inc": "inc",
    "limited": "ltd",
    "ltd": "ltd",
    "private": "pvt",
    "pvt": "pvt",
    "llc": "llc",
    "llp": "llp",
    "gmbh": "gmbh",
    "sarl": "sarl",
    "sa": "sa",
    "company": "co",
    "co": "co",
    "plc": "plc",
    "nv": "nv",
    "bv": "bv",
    "spa": "spa",
    "srl": "srl",
}
COMPOUNDS = [
    ("private limited", "pvt ltd"),
    ("pvt limited", "pvt ltd"),
    ("private ltd", "pvt ltd"),
    ("pvt ltd", "pvt ltd"),
    ("co ltd", "co ltd"),
    ("company limited", "co ltd"),
]
LANDMARK = r"\b(near|opp\.?|opposite|behind|next to|beside|adj\.?|adjacent to)\b.*"
POSTAL = {"india": r"\b\d{6}\b", "us": r"\b\d{5}(-\d{4})?\b", "france": r"\b\d{5}\b", "generic": r"\b\d{4,6}\b"}
WEB = r"\.(com|org|net|in|co|io|gov|biz|edu|co\.in)\b"

#: Letters, digits and the underscore of all scripts, but no combining marks.
PUNCTUATION = r"[^\p{L}\p{N}_\s]"


@F.pandas_udf(T.StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def nfkc(text: Column) -> Column:
    """The NFKC form. ASCII is its own: it goes as null to the Python worker, so it isn't shipped."""
    return F.coalesce(_nfkc(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def folded(text: Column, unicode: bool = True) -> Column:
    text = F.coalesce(text.cast("string"), F.lit(""))
    return strip(F.lower(nfkc(text) if unicode else text))


def squeezed(text: Column) -> Column:
    """Punctuation as spaces, runs of white space as one space."""
    return strip(F.regexp_replace(F.regexp_replace(text, PUNCTUATION, " "), r"(?U)\s+", " "))


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda t: t != "")


def sorted_tokens(text: Column) -> Column:
    return F.array_join(F.array_sort(tokens(text)), " ")


def extracted(text: Column, pattern: str) -> Column:
    """The first match, or null."""
    return F.nullif(F.regexp_extract(text, f"(?U){pattern}", 0), F.lit(""))


def postal_code(address: Column, country: Column) -> Column:
    own = F.lower(strip(F.coalesce(country, F.lit(""))))
    by_country = [F.when(own == name, extracted(address, pattern)) for name, pattern in POSTAL.items()]
    return F.coalesce(*by_country, *[extracted(address, p) for p in POSTAL.values()])


def normalized_names(df: DataFrame, name: str = "name", unicode: bool = True) -> DataFrame:
    """df with raw_name, normalized_name, core_name, sorted_core, suffix (the leftmost legal form, null if none)."""
    hits = [(rf"(?U)\b{c}\b", short) for c, short in COMPOUNDS]
    df = df.withColumn("raw_name", F.coalesce(F.col(name).cast("string"), F.lit("")))
    df = df.withColumn("n__", F.regexp_replace(folded(F.col(name), unicode), f"(?U){WEB}", ""))
    compound = F.coalesce(*[F.when(F.col("n__").rlike(p), F.lit(short)) for p, short in hits])
    without = F.coalesce(*[F.when(F.col("n__").rlike(p), F.regexp_replace("n__", p, " ")) for p, _ in hits], F.col("n__"))
    df = df.withColumns({"c__": compound, "normalized_name": squeezed(without)})
    forms = F.create_map(*[F.lit(x) for kv in LEGAL.items() for x in kv])
    df = df.withColumn("t__", tokens(F.col("normalized_name")))
    legal = F.filter("t__", lambda t: t.isin(*LEGAL))
    core = F.filter("t__", lambda t: ~t.isin(*LEGAL))
    suffix = F.coalesce("c__", F.try_element_at(forms, F.coalesce(F.get(legal, F.lit(0)), F.lit(""))))
    df = df.withColumns({"core_name": F.array_join(core, " "), "sorted_core": F.array_join(F.array_sort(core), " "), "suffix": suffix})
    return df.drop("n__", "c__", "t__")


def normalized_addresses(df: DataFrame, address: str = "address", country: str = "country", unicode: bool = True) -> DataFrame:
    """df with raw_addr, normalized_addr, sorted_addr_tokens, postal_code, landmark (null if none)."""
    df = df.withColumns({"raw_addr": F.coalesce(F.col(address).cast("string"), F.lit("")), "a__": folded(F.col(address), unicode)})
    df = df.withColumns(
        {
            "landmark": F.nullif(strip(F.regexp_extract("a__", f"(?U){LANDMARK}", 0)), F.lit("")),
            "postal_code": postal_code(F.col("a__"), F.col(country)),
            "normalized_addr": squeezed(F.regexp_replace("a__", f"(?U){LANDMARK}", "")),
        }
    )
    return df.withColumn("sorted_addr_tokens", sorted_tokens(F.col("normalized_addr"))).drop("a__")


#: Columns of a normalized record.
RECORD = (
    "entity_id",
    "country",
    "raw_name",
    "normalized_name",
    "core_name",
    "sorted_core",
    "suffix",
    "raw_addr",
    "normalized_addr",
    "sorted_addr_tokens",
    "postal_code",
    "landmark",
)


def normalized(df: DataFrame, unicode: bool = True) -> DataFrame:
    """Records of (entity_id, name, address, country, ...) with their normalized columns; further columns stay."""
    df = df.withColumn("country", F.lower(strip(F.coalesce("country", F.lit("")))))
    out = normalized_addresses(normalized_names(df, unicode=unicode), unicode=unicode)
    rest = [c for c in df.columns if c not in (*RECORD, "name", "address")]
    return out.select(*RECORD, *rest)

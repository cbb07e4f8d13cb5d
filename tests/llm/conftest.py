import pytest

#: Texts that every operator must take: missing, empty, blank, one word, repeated rows, copies, long ones.
LONG = "lorem ipsum dolor sit amet " * 4000
ODD = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, " \t\n ", None, None),
    (4, "word", "en", "b"),
    (4, "word", "en", "b"),
    (5, "Grüße \U0001f600 ΑΣ ﬁne", "de", "b"),
    (None, "no id here at all", "en", None),
    (6, LONG, "en", "c"),
    (7, LONG, "en", "c"),
    (8, "x" * 50_000, "fr", "c"),
    (9, "1 " * 2000, "fr", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents, with columns whose names operators use inside."""
    df = spark.createDataFrame(ODD, SCHEMA)
    extra = {c: "1" for c in ("row", "size", "h", "fp", "key", "k", "score", "place", "start", "n", "bucket", "c", "spans", "base", "word", "component_id", "target", "whole", "upto", "upto_r", "s", "k__", "h__", "s__", "spans__", "said__", "said", "id", "hash", "sha", "a", "b", "i")}
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(v) for c, v in extra.items()} | {"n_chars": F.length("text").cast("long")})


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")

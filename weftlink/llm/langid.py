"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Letters are lower-cased, all else is one space; n-grams of 1 to 3 characters are hashed to 2^15 features.
Document frequencies come from all training documents. The weights are fitted on a bounded sample: of every
language at most PER_CLASS documents, or an equal part of SAMPLE if there are many languages (one document
at least), those with the least hash of doc_id and text, so reruns agree. They are trained with the follow-the-regularised-leader update (elastic net: l1
and l2), then a temperature is fitted on a part of the sample that the weights haven't seen. Everything
but that fit covers all documents and whole texts.

Learning uses text and lang of rows with a lang that crc32(doc_id as text) mod 4 doesn't hold out; a
prediction uses the text alone.

Defined results: a very long text is counted whole, a block at a time; a null text, or one without a letter, gets `und` with score 1; without any training rows
all documents get `und` with score 0; rows with the same doc_id are predicted each on its own; a null
doc_id counts as the empty text for holding out; ties between languages go to the first by code point.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftlink.llm import common

#: Bound of the sample: documents of a language, and of all languages.
PER_CLASS, SAMPLE = 400, 25_600
#: Hashed features, longest n-gram, held-out remainder of how many parts.
FEATURES, LONGEST, HELD, PARTS = 1 << 15, 3, 2, 4
#: Follow-the-regularised-leader: rate, smoothing, penalties; passes over the sample; the part kept for calibration.
ALPHA, BETA, L1, L2, PASSES, KEPT = 0.5, 1.0, 0.02, 0.1, 4, 5
UND = "und"
#: Least probability of a language for a document to be kept by recognised().
LEAST = 0.5
#: Characters that are hashed at a time.
BLOCK = 1 << 16


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def counts(text: str | None) -> np.ndarray | None:
    """How often each feature occurs in the text; None without a letter."""
    if not text:
        return None
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    ok = _letters()[c]
    if not ok.any():
        return None
    c = np.where(ok, c, 32)
    c = np.concatenate([[32], c[(c != 32) | (np.roll(c, 1) != 32)], [32]]).astype(np.uint32)  # runs of others count as one space
    out = np.zeros(FEATURES, np.int64)
    for at in range(0, len(c), BLOCK):
        part = c[at : at + BLOCK + LONGEST - 1]
        h = np.zeros(len(part), np.uint32)
        for n in range(LONGEST):
            h = (h[: len(part) - n] ^ part[n:]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            own = h[: min(len(h), BLOCK)]
            out += np.bincount((own * np.uint32(0x85EBCA6B)) >> np.uint32(32 - 15), minlength=FEATURES)
    return out


def vector(n: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and weights: (1 + ln tf) x idf, of length 1."""
    at = np.flatnonzero(n)
    x = (1 + np.log(n[at])) * idf[at]
    return at, x / max(np.sqrt((x * x).sum()), 1e-12)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights, biases and temperature from (class, features, values); every KEPT-th row of a class calibrates."""
    z, n = np.zeros((FEATURES + 1, classes)), np.zeros((FEATURES + 1, classes))
    learn, keep, seen = [], [], [0] * classes
    for r in rows:
        seen[r[0]] += 1
        (learn if seen[r[0]] % KEPT else keep).append(r)

    def weights(at: np.ndarray) -> np.ndarray:
        zi, ni = z[at], n[at]
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    order = np.random.default_rng(7)
    for _ in range(PASSES):
        for i in order.permutation(len(learn)):
            y, at, x = learn[i]
            at, x = np.append(at, FEATURES), np.append(x, 1.0)
            w = weights(at)
            p = _softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p[None, :]
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    w = weights(np.arange(FEATURES + 1))
    logits = np.array([x @ w[at] + w[-1] for _, at, x in keep]).reshape(-1, classes)
    labels = np.array([y for y, _, _ in keep], int)

    def loss(t: float) -> float:
        return -np.log(_softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean() if len(labels) else 0.0

    low, high = np.log(0.02), np.log(20.0)
    for _ in range(60):  # golden sections: the loss is convex in 1 / t
        a, b = high - (high - low) * 0.618, low + (high - low) * 0.618
        low, high = (low, b) if loss(np.exp(a)) <= loss(np.exp(b)) else (a, high)
    return w[:-1].astype(np.float32), w[-1], float(np.exp((low + high) / 2))


def train(docs: DataFrame) -> dict | None:
    """The model from the labelled rows of docs (doc_id, text, lang) that aren't held out."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (common.remainder(F.col("doc_id"), PARTS) != HELD)).select("doc_id", "text", "lang")
    many = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = list(many)
    if not langs:
        return None
    langs = sorted(langs, key=lambda x: x.encode("utf-8", "surrogatepass"))

    def document_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                if (c := counts(text)) is not None:
                    df += c > 0
                    n += 1
        at = np.flatnonzero(df)
        yield pd.DataFrame({"feature": np.append(at, FEATURES), "df": np.append(df[at], n)})

    seen = rows.select("text").mapInPandas(document_counts, "feature int, df long").groupBy("feature").agg(F.sum("df").alias("df")).toPandas()
    df = np.zeros(FEATURES + 1)
    df[seen["feature"]] = seen["df"]
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    most = max(1, min(PER_CLASS, SAMPLE // len(langs)))
    # rows that are equal in all of these count once
    hashed = rows.select("lang", "doc_id", F.xxhash64("text").alias("h"), F.xxhash64("doc_id", "text").alias("place"))
    # of a large language a small share by hash, some times the sample, goes to the window at all
    shares = {lang: 4 * most / n for lang, n in many.items() if n > 4 * most}

    def thinned() -> DataFrame:
        if not shares:
            return hashed.distinct()
        share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])
        return hashed.where(F.col("place") / float(1 << 64) + 0.5 < F.coalesce(F.try_element_at(share, F.col("lang")), F.lit(2.0))).distinct()

    if shares:
        # a language whose share is less than the sample, as its rows are few and often repeated, goes there whole
        left = {r["lang"]: r["count"] for r in thinned().groupBy("lang").count().collect()}
        shares = {lang: x for lang, x in shares.items() if left.get(lang, 0) >= most}
    order = Window.partitionBy("lang").orderBy("place", "doc_id", "h")
    chosen = thinned().withColumn("k", F.row_number().over(order)).where(F.col("k") <= most)
    chosen = chosen.select(*[F.col(c).alias(f"{c}_") for c in ("lang", "doc_id", "h")], "k")
    # SAMPLE rows at most, or one for each language
    same = (F.col("lang") == F.col("lang_")) & F.col("doc_id").eqNullSafe(F.col("doc_id_")) & (F.xxhash64("text") == F.col("h_"))
    sample = rows.join(F.broadcast(chosen), same)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(lang, int(k), v) for lang, k, text in zip(batch["lang"], batch["k"], batch["text"], strict=True) if (v := counts(text)) is not None]
            made = [(lang, k, *vector(v, idf)) for lang, k, v in found]
            yield pd.DataFrame([(lang, k, at.astype("<i4").tobytes(), x.astype("<f4").tobytes()) for lang, k, at, x in made], columns=["lang", "k", "at", "x"])

    got = sample.select("lang", "k", "text").mapInPandas(vectors, "lang string, k int, at binary, x binary")
    got = got.groupBy("lang", "k").agg(F.min("at").alias("at"), F.min("x").alias("x")).collect()  # equal rows count once
    got = sorted(got, key=lambda r: (r["k"], langs.index(r["lang"])))
    if not got:
        return None
    w, bias, t = fit([(langs.index(r["lang"]), np.frombuffer(r["at"], "<i4"), np.frombuffer(r["x"], "<f4").astype(float)) for r in got], len(langs))
    return {"langs": langs, "idf": idf, "w": w, "bias": bias, "t": t}


def predicted(model: dict | None, spark: SparkSession) -> Column:
    """lang_pred, score of column text."""
    sent = spark.sparkContext.broadcast(model)

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for texts in batches:
            out = []
            for text in texts:
                if (n := counts(text)) is None:
                    out.append((UND, 1.0))
                elif m is None:
                    out.append((UND, 0.0))
                else:
                    at, x = vector(n, m["idf"])
                    p = _softmax((x @ m["w"][at] + m["bias"]) / m["t"])
                    out.append((m["langs"][int(p.argmax())], float(p.max())))
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    predict.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(predict, kind)("text")


def recognised(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """docs without the rows whose text has no letter, or no language with so much probability."""
    (name,) = common.fresh(docs, "said")
    said = docs.withColumn(name, predicted(train(docs), docs.sparkSession))
    return said.where((F.col(name)["lang_pred"] != UND) & (F.col(name)["score"] >= least)).select(*docs.columns)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    out = docs.select("doc_id", (common.remainder(F.col("doc_id"), PARTS) == HELD).alias("held_out"), predicted(train(docs), spark).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")


QUERIES = {"op7_language_id": op7_language_id}
SQL: dict = {}

"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax.

P(token | history) = P(class | history) x P(part | class, history) x P(token | part). Both softmaxes have hashed
features of the history: the last word, the last two classes (n-grams), and what stands before the last
(a skip); those of the second belong to the class whose parts they tell apart. The weights are trained by
distributed gradient updates: in each round every task sums the gradients and their diagonal scales over its
share of the training documents (each document is in one round), the sums are added in a tree of tasks, and
the driver makes one step. In a part of a class a token has (c + 1) / (sum of c + 1 over the part, and 1 more
for all words that training hasn't seen, where such words can be), the maximum-entropy solution for the word
alone: so the probabilities of a history sum to 1.

Classes: the CLUSTERED most frequent words are clustered by the words that stand near them, over all
training documents, and each class so again into parts; any other word has a class by its last two bytes and
a part by a hash, so it needs no table; the end has its own.

Texts are split into words twice: to count these, and to write them as numbers, which is all that the
clustering, the training and the scoring read. Both read the bytes of many texts at once. A word is known by a key
of 128 bits: its own bytes and their number if it has up to 15, else 120 bits of hash. Counts are whole: every
training token is counted, in a table of the shared folder. At most HEAD frequent words are a table that each
task holds; other tokens meet their counts in a join. What is broadcast or collected is bounded by HEAD, CLASSES and
FEATURES, however large the corpus.

Defined results: a null text counts as empty, which is the end token alone; a very long text is read whole, its
numbers a block at a time; without training tokens N and V are 0 and both scores take every token as unseen; rows
with the same doc_id are rows of their own; a null doc_id counts as the empty text for holding out; of words of
one frequency at the end of the head, those with the lesser hashes are in it. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.llm import common
from weftlink.llm.words import mix, split_words

#: Words that tasks hold, those of them that are clustered, words whose company tells, held-out remainder.
HEAD, CLUSTERED, CONTEXTS, HELD, PARTS = 65_536, 8_192, 128, 2, 7
#: Classes: the end, of frequent words, of other words by their last bytes, one that stands before a text. Parts of a class.
END, LEARNED, BY_FORM, INNER = 0, 23, 7, 16
FORM = 1 + LEARNED
START = FORM + BY_FORM
CLASSES = START + 1
#: Hashed words of the history; all features: those, pairs of classes, skipped pairs.
HASHED = 4096
FEATURES = HASHED + 2 * CLASSES * CLASSES
#: The same for the parts of one class: hashed words, the last class, the class before it.
HASHED_INNER = 512
WIDTH = HASHED_INNER + 2 * CLASSES
FEATURES_INNER = CLASSES * WIDTH
#: Numbers of tokens: head words by place, other words by class and hash, the end.
LAST = HEAD + BY_FORM * HASHED
#: Rounds, step (there are 3 features a token), smoothing of the scale, tokens at a time.
ROUNDS, STEP, SMOOTH, BLOCK = 3, 0.5, 4.0, 1 << 14
#: Tokens that a task counts together, words that it keeps before it hands them on; numbers of a piece of a sum; tasks
#: that are summed at a time; texts read together.
COUNTED, KEPT, SLAB, FAN, TEXTS = 1 << 20, 1 << 20, 1 << 15, 64, 256
#: Bits of a place in the table of the head.
BITS = 18


def split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts: halves lo and hi of their keys, their numbers other (class by the last two bytes, hash)
    outside of the head; and how many each text has."""
    lo, hi, ending, sizes = split_words(texts)
    other = ending % BY_FORM * HASHED + (mix(lo, hi) >> np.uint64(64 - 12)).astype(np.int64)
    return lo, hi, other.astype(np.int32), sizes


def _training(doc_id: str = "doc_id") -> Column:
    return common.remainder(F.col(doc_id), PARTS) != HELD


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, TEXTS):
        yield batch.slice(at, TEXTS)


def tally(lo: np.ndarray, hi: np.ndarray, other: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each key once, with the sum of its counts."""
    order = np.argsort(mix(lo, hi))
    lo, hi, other, c = lo[order], hi[order], other[order], c[order]
    new = np.ones(len(lo), bool)
    new[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])  # keys of one hash may stand in turns: those are summed later
    at = np.flatnonzero(new)
    return lo[at], hi[at], other[at], np.add.reduceat(c, at) if len(at) else c


def counted(docs: DataFrame) -> DataFrame:
    """lo, hi, other of each word (nulls: the end), c: how often it stands in docs (text)."""
    schema = pa.schema([("lo", pa.int64()), ("hi", pa.int64()), ("other", pa.int32()), ("c", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, waiting, n, ends = [], [], 0, 0

        def added() -> None:
            nonlocal kept, waiting, n
            if waiting:
                kept, waiting, n = [tally(*(np.concatenate(x) for x in zip(*kept, *waiting, strict=True)))], [], 0

        for batch in batches:
            for part in _slices(batch):
                lo, hi, other, _ = split(part.column("text"))
                waiting.append((lo, hi, other, np.ones(len(lo), np.int64)))
                n, ends = n + len(lo), ends + part.num_rows
                if n >= COUNTED:
                    added()
                    if len(kept[0][0]) > KEPT:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, kept[0])), schema=schema)
                        kept = []
        added()
        for x in kept:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, x)), schema=schema)
        yield pa.RecordBatch.from_arrays([pa.array([None], t) for t in schema.types[:3]] + [pa.array([ends], pa.int64())], schema=schema)

    return docs.select("text").mapInArrow(count, "lo long, hi long, other int, c long").groupBy("hi", "lo", "other").agg(F.sum("c").alias("c")).where("c > 0")


class Head:
    """The most frequent words: keys, numbers outside of the head, counts, and a hash table of their places."""

    def __init__(self, lo: np.ndarray, hi: np.ndarray, other: np.ndarray, counts: np.ndarray):
        self.lo, self.hi, self.other, self.counts = lo, hi, other, counts
        self.table = np.full(1 << BITS, -1, np.int32)
        for i, at in enumerate(self._place(lo, hi).tolist()):
            while self.table[at] >= 0:
                at = (at + 1) % (1 << BITS)
            self.table[at] = i

    def __len__(self) -> int:
        return len(self.lo)

    @staticmethod
    def _place(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return (mix(lo, hi) >> np.uint64(20) & np.uint64((1 << BITS) - 1)).astype(np.int64)

    def find(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Places in the head; -1 for other words."""
        at = self._place(lo, hi)
        found = self.table[at]
        if not len(self.lo):
            return found
        wrong = np.flatnonzero((found >= 0) & ((self.lo[found] != lo) | (self.hi[found] != hi)))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) % (1 << BITS)
            f = found[wrong] = self.table[at[wrong]]
            wrong = wrong[(f >= 0) & ((self.lo[f] != lo[wrong]) | (self.hi[f] != hi[wrong]))]
        return found


def headed(vocabulary: DataFrame, most: int = HEAD) -> tuple[Head, DataFrame]:
    """The most frequent words, at most so many, and the rows of all other words.

    Words fall into narrow steps of their frequency, and those of the step that the limit cuts into further ones by
    hash. What comes to the driver is a histogram, and then the words themselves."""
    own = vocabulary.where("hi is not null").withColumns({"step": F.floor(F.log2("c") * 64).cast("int"), "bin": F.shiftrightunsigned(F.xxhash64("hi", "lo"), 52).cast("int")})
    left, least, cut, bins = most, 1 << 30, -1, -1
    for r in sorted(own.groupBy("step").count().collect(), reverse=True):  # 64 for each doubling of the count
        if r["count"] > left:
            cut = r["step"]
            break
        left, least = left - r["count"], r["step"]
    if cut >= 0:
        for r in sorted(own.where(F.col("step") == cut).groupBy("bin").count().collect()):  # 4096 at most
            if r["count"] > left:
                break
            left, bins = left - r["count"], r["bin"]
    inside = (F.col("step") >= least) | (F.col("step") == cut) & (F.col("bin") <= bins)
    columns = ["lo", "hi", "other", "c"]
    top = sorted(own.where(inside).select(*columns).collect(), key=lambda r: (-r["c"], r["hi"], r["lo"]))
    return Head(*(np.array([r[k] for r in top], np.int64) for k in columns)), own.where(~inside).select(*columns)


def numbered(docs: DataFrame, head: Head) -> DataFrame:
    """row, doc_id, codes (the numbers of the tokens, the end with them), and of the words outside of the head
    lo, hi (halves of the key) and times."""
    sent = docs.sparkSession.sparkContext.broadcast(head)
    longs = pa.list_(pa.int64())
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("codes", pa.list_(pa.int32())), ("lo", longs), ("hi", longs), ("times", pa.list_(pa.int32()))])

    def listed(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = sent.value
        for batch in batches:
            for part in _slices(batch):
                lo, hi, other, sizes = split(part.column("text"))
                doc = np.repeat(np.arange(len(sizes)), sizes)
                found = head.find(lo, hi)
                codes = np.full(len(lo) + len(sizes), LAST, np.int32)
                codes[np.arange(len(lo)) + doc] = np.where(found >= 0, found, HEAD + other)
                # each word outside of the head once for each text
                rare = np.flatnonzero(found < 0)
                rare = rare[np.lexsort((mix(lo[rare], hi[rare]), doc[rare]))]
                lo, hi, doc = lo[rare], hi[rare], doc[rare]
                new = np.ones(len(rare), bool)
                new[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]) | (doc[1:] != doc[:-1])
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(rare))).astype(np.int32)
                many = np.bincount(doc[at], minlength=len(sizes))
                lists = [listed(codes, sizes + 1), listed(lo[at], many), listed(hi[at], many), listed(times, many)]
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("doc_id"), *lists], schema=schema)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(number, "row long, doc_id long, codes array<int>, lo array<long>, hi array<long>, times array<int>")


def groups(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Texts of a batch in groups of about BLOCK tokens: the place of the first, all numbers, where each text begins."""
    codes = batch.column("codes")
    offsets = codes.offsets.to_numpy().astype(np.int64)
    values = codes.values.to_numpy()
    first = 0
    while first < len(offsets) - 1:
        stop = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK, "right")) - 1)
        yield first, values[offsets[first] : offsets[stop]], offsets[first:stop] - offsets[first]
        first = stop


class Tables:
    """What the model knows of each number: class, part of the class, hash in histories."""

    def __init__(self, head: Head, classes: np.ndarray, parts: np.ndarray):
        self.of = np.zeros(LAST + 1, np.int64)
        self.part = np.zeros(LAST + 1, np.int64)
        self.slot = np.zeros(LAST + 1, np.int64)
        n = len(head)
        self.of[:n], self.part[:n] = classes, parts
        self.slot[:n] = head.other % HASHED
        other = np.arange(LAST - HEAD)
        self.of[HEAD:LAST], self.slot[HEAD:LAST] = FORM + other // HASHED, other % HASHED
        self.part[HEAD:LAST] = self.slot[HEAD:LAST] * INNER // HASHED

    def features(self, codes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Classes and parts of the tokens, and the 3 features of what stands before each, for both softmaxes."""
        c = self.of[codes]
        before = np.full((3, len(c)), START)
        for k in range(3):
            before[k, k + 1 :] = c[: len(c) - k - 1]
            for j in range(k + 1):  # what stands before a text
                before[k, (firsts + j)[firsts + j < len(c)]] = START
        word = np.zeros(len(c), np.int64)
        word[1:] = self.slot[codes[:-1]]
        word[firsts] = 0
        outer = np.stack([word, HASHED + before[0] * CLASSES + before[1], HASHED + CLASSES * CLASSES + before[1] * CLASSES + before[2]])
        inner = c * WIDTH + np.stack([word % HASHED_INNER, HASHED_INNER + before[0], HASHED_INNER + CLASSES + before[1]])
        return c, self.part[codes], outer, inner


def softmax(w: np.ndarray, bias: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logits of the tokens, their exponentials, and the sums of these. bias: one row, or one for each token."""
    z = w.take(features[0], axis=0)
    z += w.take(features[1], axis=0)
    z += w.take(features[2], axis=0)
    z += bias
    with np.errstate(over="ignore"):
        e = np.exp(z)
        sums = e @ np.ones(e.shape[1], e.dtype)
    if len(z) and not (sums.min() > 1e-30 and sums.max() < 1e30):
        z -= z.max(axis=1, keepdims=True)
        e = np.exp(z)
        sums = e.sum(axis=1)
    return z, e, sums


def summed(rows: DataFrame, sizes: Callable[[int], int]) -> Iterator[tuple[int, np.ndarray]]:
    """Sums of arrays that tasks give in pieces (task, piece, sums), in a tree: no task adds more than FAN tasks'."""

    def added(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            for b in batch["sums"]:
                x = np.frombuffer(b, "<f4").astype(np.float64)
                total = x if total is None else total + x
        yield pd.DataFrame({"task": [key[1]], "piece": [key[0]], "sums": [total.astype("<f4").tobytes()]})

    tasks = rows.rdd.getNumPartitions()
    while True:
        tasks = -(-tasks // FAN)
        rows = rows.withColumn("task", F.floor(F.col("task") / FAN).cast("int")).groupBy("piece", "task").applyInPandas(added, "task int, piece int, sums binary")
        if tasks <= 1:
            break
    for r in rows.collect():  # as many numbers as the sums have
        yield r["piece"], np.frombuffer(r["sums"], "<f4")[: sizes(r["piece"])]


def _pieces(sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's sums in pieces; those of zeros alone are left out."""
    task, flat = TaskContext.get().partitionId(), sums.reshape(-1)
    for piece, at in enumerate(range(0, len(flat), SLAB)):
        if flat[at : at + SLAB].any():
            raw = flat[at : at + SLAB].astype("<f4").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([task], pa.int32()), pa.array([piece], pa.int32()), pa.array([raw], pa.binary())], names=["task", "piece", "sums"])


def total(docs: DataFrame, shape: tuple[int, ...], add: Callable[[np.ndarray, np.ndarray, np.ndarray], None]) -> np.ndarray:
    """An array that add(sums, numbers of a group of texts, their places) adds up over docs (codes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(shape, np.float32)
        for batch in batches:
            for _, codes, firsts in groups(batch):
                add(sums, codes, firsts)
        yield from _pieces(sums)

    out = np.zeros(int(np.prod(shape)), np.float32)
    parts = docs.select("codes").mapInArrow(run, "task int, piece int, sums binary")
    for piece, sums in summed(parts, lambda p: min(SLAB, len(out) - p * SLAB)):
        out[piece * SLAB : piece * SLAB + len(sums)] = sums
    return out.reshape(shape)


def _centred(m: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """k-means by cosine, from the first k rows on."""
    centres, assigned = m[:k].copy(), np.zeros(len(m), int)
    for _ in range(15):
        assigned = (m @ centres.T).argmax(axis=1)
        for c in range(k):
            if (own := assigned == c).any():
                centre = (m[own] * weight[own, None]).sum(axis=0)
                centres[c] = centre / max(np.linalg.norm(centre), 1e-9)
    return assigned


def clustered(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes and parts of the n most frequent words: k-means on what stands near them in all of docs (codes)."""
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    width = min(CONTEXTS, n) + 1

    def add(sums: np.ndarray, codes: np.ndarray, firsts: np.ndarray) -> None:
        # both neighbours at up to two words tell of the company a word keeps
        flat = sums.reshape(-1)
        text = np.zeros(len(codes), np.int64)
        text[firsts] = 1
        text = np.cumsum(text)
        far = np.minimum(codes, width - 1)
        for step in (1, 2):
            same = text[step:] == text[:-step]
            for x, y in ((codes[step:], far[:-step]), (codes[:-step], far[step:])):
                ok = same & (x < n)
                np.add.at(flat, x[ok].astype(np.int64) * width + y[ok], np.float32(1))

    m = np.sqrt(total(docs, (n, width), add))
    m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)
    weight = 1 / np.sqrt(np.arange(1, n + 1))  # about the words' shares
    of, parts = _centred(m, weight, min(LEARNED, n)), np.zeros(n, np.int64)
    for c in np.unique(of):
        own = np.flatnonzero(of == c)
        parts[own] = _centred(m[own], weight[own], min(INNER, len(own)))
    return of + 1, parts


def trained(docs: DataFrame, tables: Tables, biases: tuple[np.ndarray, np.ndarray], rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights of both softmaxes after one pass over docs (doc_id, codes) in as many rounds."""
    sc = docs.sparkSession.sparkContext
    shapes = (FEATURES, CLASSES), (FEATURES_INNER, INNER)
    w = [np.zeros(s, np.float32) for s in shapes]
    sizes = [x.size for x in w]
    for turn in range(rounds):
        sent = sc.broadcast((tables, biases, w))

        def add(sums: np.ndarray, codes: np.ndarray, firsts: np.ndarray, sent=sent) -> None:
            tables, biases, w = sent.value
            c, part, outer, inner = tables.features(codes, firsts)
            at = 0
            for k, (y, features) in enumerate(((c, outer), (part, inner))):
                seen = sums[at : at + sizes[k]]
                expected = sums[at + sizes[k] : at + 2 * sizes[k]].reshape(shapes[k])
                at += 2 * sizes[k]
                for lo in range(0, len(y), BLOCK):
                    f, own = features[:, lo : lo + BLOCK], y[lo : lo + BLOCK]
                    _, p, whole = softmax(w[k], biases[k] if k == 0 else biases[k][c[lo : lo + BLOCK]], f)
                    p /= whole[:, None]
                    for each in f:
                        np.add.at(seen, each * shapes[k][1] + own, np.float32(1))
                        order = np.argsort(each.astype(np.uint16), kind="stable")  # small integers sort by radix
                        ranked = each[order]
                        starts = np.flatnonzero(np.diff(ranked, prepend=-1))
                        expected[ranked[starts]] += np.add.reduceat(p.take(order, axis=0), starts, axis=0)

        share = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(rounds)) == turn)
        sums, at = total(share, (2 * sum(sizes),), add), 0
        for k, shape in enumerate(shapes):
            seen, expected = (sums[at + j * sizes[k] : at + (j + 1) * sizes[k]].reshape(shape) for j in range(2))
            at += 2 * sizes[k]
            # the gradient is seen - expected; its logarithmic scale is that of iterative scaling
            w[k] += STEP * np.log1p((seen - expected) / (expected + SMOOTH))
        sent.unpersist()
    return w[0], w[1]


def scored(docs: DataFrame) -> DataFrame:
    """The result of op8 for docs (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    vocabulary = common.stored(counted(docs.where(_training())), "vocabulary")
    n, v = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ends = vocabulary.where("hi is null").agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    head, others = headed(vocabulary)
    rows = common.stored(numbered(docs, head), "tokens")
    learn = rows.where(_training())

    classes, parts, counts = FORM + head.other // HASHED, head.other % HASHED * INNER // HASHED, head.counts
    near = min(CLUSTERED, len(head))
    classes[:near], parts[:near] = clustered(learn, near)
    # what each part of a class has of tokens, and of them and distinct words
    tokens, inside = np.zeros((CLASSES, INNER)), np.zeros((CLASSES, INNER))
    tokens[END, 0], inside[END, 0] = ends, ends + 1
    np.add.at(tokens, (classes, parts), counts)
    np.add.at(inside, (classes, parts), counts + 1)
    of, part = F.floor(F.col("other") / HASHED), F.floor(F.pmod("other", F.lit(HASHED)) * INNER / HASHED)
    sums = others.groupBy(of.alias("form"), part.alias("part")).agg(F.sum("c").alias("c"), F.count("*").alias("n"))
    for r in sums.collect():
        tokens[FORM + r["form"], r["part"]] += r["c"]
        inside[FORM + r["form"], r["part"]] += r["c"] + r["n"]
    inside[FORM:START] += 1  # words that training hasn't seen
    with np.errstate(divide="ignore"):
        biases = [np.log(np.where(inside > 0, tokens + 0.5, 0).sum(axis=1)), np.log(np.where(inside > 0, tokens + 0.5, 0))]
        # no probability where nothing can be; exponentials stay small
        biases = tuple(np.maximum(b - np.maximum(b.max(axis=-1, keepdims=True), -60), -60).astype(np.float32) for b in biases)
        logs_inside = np.log10(np.maximum(inside, 1e-300))
    tables = Tables(head, classes, parts)
    w = trained(learn, tables, biases)
    sent = spark.sparkContext.broadcast((tables, counts, biases, w, logs_inside, ends))
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("s1", pa.float64()), ("own", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, counts, biases, w, logs_inside, ends = sent.value
        known, logs = np.zeros(LAST + 1, bool), np.zeros(LAST + 1)
        known[: len(counts)], logs[: len(counts)] = True, np.log10(counts + 1.0)
        known[LAST], logs[LAST] = ends > 0, np.log10(ends + 1.0)
        for batch in batches:
            made = []
            for _, codes, firsts in groups(batch):
                c, part, outer, inner = tables.features(codes, firsts)
                own = -logs_inside[c, part]
                for lo in range(0, len(c), BLOCK):
                    here = slice(lo, lo + BLOCK)
                    each = np.arange(len(c[here]))
                    for x, bias, features, y in ((w[0], biases[0], outer, c), (w[1], biases[1][c[here]], inner, part)):
                        z, _, whole = softmax(x, bias, features[:, here])
                        own[here] += (z[each, y[here]].astype(np.float64) - np.log(whole.astype(np.float64))) / np.log(10)
                sizes = np.diff(np.append(firsts, len(codes)))
                made.append((sizes, *(np.add.reduceat(x, firsts) for x in (known[codes].astype(np.int64), logs[codes], own))))
            if made:
                columns = [np.concatenate([m[k] for m in made]) for k in range(4)]
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), *map(pa.array, columns)], schema=schema)

    scores = rows.select("row", "doc_id", "codes").mapInArrow(score, "row long, doc_id long, n_tokens long, known long, s1 double, own double")
    rare = rows.where(F.size("times") > 0).select("row", F.explode(F.arrays_zip("lo", "hi", "times")).alias("t")).select("row", "t.*")
    met = rare.join(others.select("lo", "hi", "c"), ["hi", "lo"]).groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("s2"))
    out = scores.join(met, "row", "left")
    s = F.col("s1") + F.coalesce("s2", F.lit(0.0))
    return out.select(
        "doc_id",
        (common.remainder(F.col("doc_id"), PARTS) == HELD).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (s - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))).alias("base_score"),
        (s + F.col("own")).alias("score"),
    )


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(common.documents(spark, sf_dir))


QUERIES = {"op8_lm_scoring": op8_lm_scoring}
SQL: dict = {}

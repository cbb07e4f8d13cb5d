"""Personal data: base patterns, and bootstrapped contextual extraction. DataFrame functions only.

Four base patterns give e-mail addresses, IP addresses, card numbers and phone numbers. These are the seeds
of a bootstrap: the words around the seeds of a kind are lexical patterns; every other token with a digit
that stands in such a context is an instance; patterns and instances form a graph on which Spark scores in
turn patterns (the share of their distinct instances that is known to be of the kind) and instances (that
one of their patterns is right), for a fixed number of rounds. Patterns of high confidence then mark
identifiers that no base pattern finds. A pattern needs several distinct seeds and nearly all of its
instances, so where contexts say nothing about kinds nothing is added.

Java's expressions are written with possessive quantifiers and begin where a run of characters begins (or
where the last match ended), which finds the same leftmost matches in linear time and without recursion.

Defined results: a null text counts as empty; a very long text, token or word is read whole; of several kinds that
contexts give to one token the most confident stays, then the last by name; rows with the same doc_id are rows of their own, null ids
too; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.llm import common

#: The kinds in the order that ties are listed in, and their patterns.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to match at all.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
#: Tokens that may be identifiers: runs without white space that hold a digit. Longer ones are told apart by a digest.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
LONGEST = 64
#: Characters on either side of a piece that mostly hold the words wanted there.
NEAR = 64
#: Distinct seeds that a pattern needs; its least confidence; an instance's; rounds of scoring.
SEEDS, SURE, LIKELY, ROUNDS = 5, 0.8, 0.8, 3


def _valid(kind: str):
    """Whether a match of the base pattern is one of the kind."""

    def valid(s: Column) -> Column:
        digits = F.regexp_replace(s["value"], "[^0-9]", "")
        if kind == "ip":
            return s["value"].rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
        if kind == "card":
            return F.length(digits).between(14, 19) & F.coalesce(F.call_function("luhn_check", digits), F.lit(False))
        return F.length(digits).between(10, 15) if kind == "phone" else F.lit(True)

    return valid


SPANS = "array<struct<start:int,stop:int,value:string,before:array<string>,after:array<string>>>"


def let(value: Column, body) -> Column:
    """body(value) with value computed once: the optimizer may copy a column into a lambda, but not this."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def occurrences(text: Column, pattern: str, needs: str) -> Column:
    """Matches of the pattern with their place in code points, and the words before and after.

    The pieces between the matches and the matches themselves add up to the text, so running lengths give
    the places. They are summed by blocks of about the square root of their number, and inside blocks.

    Words are runs without white space of the text itself, whatever matches; the run that a match is part of is neither
    before nor after it. They come from the three last words of a piece, the three first ones, and the two matches
    and pieces on either side."""
    blank = r"[\x20\x09-\x0D]+"
    words = lambda x: F.split(x, blank, -1)
    last = lambda w: F.array_join(F.slice(w, F.greatest(F.size(w) - 3, F.lit(1)), F.lit(4)), " ")
    first = lambda w: F.array_join(F.slice(w, 1, 4), " ")

    def near(piece: Column) -> Column:
        # a part at its end or start has four whole words but for very long ones; then the whole piece is split
        def ends(part: Column, side) -> Column:
            return let(words(part), lambda w: F.when((F.size(w) > 4) | (F.length(piece) <= NEAR), side(w)).otherwise(side(words(piece))))

        return F.struct(F.length(piece).alias("n"), ends(F.right(piece, F.lit(NEAR)), last).alias("last"), ends(F.left(piece, F.lit(NEAR)), first).alias("first"))

    def placed(x: Column) -> Column:
        lengths = F.transform(x["f"], lambda v, i: F.get(x["p"], i)["n"] + F.length(v))
        return let(F.struct(x["p"].alias("p"), x["f"].alias("f"), lengths.alias("n"), F.greatest(F.ceil(F.sqrt(F.size(x["f"]))), F.lit(1)).cast("int").alias("k")), blocked)

    def blocked(b: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), F.floor(F.size(b["n"]) / b["k"]).cast("int")), lambda i: _sum(F.slice(b["n"], i * b["k"] + 1, b["k"])))
        return let(sums, lambda s: let(F.transform(s, lambda _, i: _sum(F.slice(s, 1, i))), lambda starts: spans(b, starts)))

    def spans(b: Column, starts: Column) -> Column:
        piece = lambda i, side: F.coalesce(F.get(b["p"], i)[side], F.lit(""))
        value = lambda i: F.coalesce(F.get(b["f"], i), F.lit(""))

        def one(v: Column, i: Column) -> Column:
            block = F.floor(i / b["k"]).cast("int")
            stop = F.get(starts, block) + _sum(F.slice(b["n"], block * b["k"] + 1, i - block * b["k"] + 1))
            before = words(F.concat(piece(i - 2, "last"), value(i - 2), piece(i - 1, "last"), value(i - 1), piece(i, "last")))
            after = words(F.concat(piece(i + 1, "first"), value(i + 1), piece(i + 2, "first"), value(i + 2), piece(i + 3, "first")))
            # what is next to the match is part of its own run of letters, or empty
            return F.struct(
                (stop - F.length(v)).alias("start"),
                stop.alias("stop"),
                v.alias("value"),
                F.filter(F.slice(before, 1, F.size(before) - 1), lambda w: w != "").alias("before"),
                F.filter(F.slice(after, 2, F.size(after)), lambda w: w != "").alias("after"),
            )

        return F.transform(b["f"], one)

    pieces = F.transform(F.split(text, pattern, -1), near)
    split_up = let(F.struct(pieces.alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("f")), placed)
    return F.when(text.rlike(needs), split_up).otherwise(F.array().cast(SPANS))


def _words(span: Column) -> dict[str, Column]:
    """Patterns: the word before, the two before, the words on either side; '' where the text begins or ends."""
    before, after = span["before"], span["after"]
    at = lambda words, i: F.lower(F.coalesce(F.get(words, i), F.lit("")))
    l1, l2, r1 = at(before, F.size(before) - 1), at(before, F.size(before) - 2), at(after, F.lit(0))
    return {"L": l1, "LL": F.concat_ws(" ", l2, l1), "LR": F.concat_ws(" _ ", l1, r1)}


def _slots(spans: Column, kind: str | None) -> Column:
    """Spans with their patterns; kind is null for instances that no base pattern covers."""
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(KINDS.index(kind) if kind else len(KINDS)).alias("place"),
            s["stop"].alias("stop"),
            F.lit(kind).cast("string").alias("kind"),
            F.when(F.length(s["value"]) <= LONGEST, F.lower(s["value"])).otherwise(F.sha2(F.lower(s["value"]), 256)).alias("value"),
            F.array(*[F.concat(F.lit(f"{name} "), w) for name, w in _words(s).items()]).alias("patterns"),
        ),
    )


def scanned(docs: DataFrame) -> DataFrame:
    """row, doc_id, base (valid spans of all kinds), other (tokens with a digit outside of these)."""
    text = F.coalesce("text", F.lit(""))
    out = docs.select("doc_id", text.alias("text"))
    spans = {k: F.filter(occurrences(F.col("text"), PATTERNS[k], NEEDS[k]), _valid(k)) for k in KINDS}
    out = out.withColumns(spans | {"token": occurrences(F.col("text"), TOKEN, "[0-9]")})
    base = F.array_sort(F.concat(*[_slots(F.col(k), k) for k in KINDS]))
    out = out.select(F.monotonically_increasing_id().alias("row"), "doc_id", base.alias("base"), _slots(F.col("token"), None).alias("token"))
    free = lambda t: ~F.exists(F.col("base"), lambda b: (b["start"] < t["stop"]) & (t["start"] < b["stop"]))
    return out.select("row", "doc_id", "base", F.filter("token", free).alias("other"))


def bootstrap(found: DataFrame, seeds: int = SEEDS, sure: float = SURE, likely: float = LIKELY, rounds: int = ROUNDS) -> DataFrame:
    """pattern, kind, confidence of the patterns that the seeds and the graph support.

    Edges join distinct instances and patterns, so copies of a text count once. Every pattern and instance
    is a key of a partial aggregation; nothing is gathered for one key."""
    slots = found.select(F.explode(F.concat("base", "other")).alias("s")).select("s.kind", "s.value", F.explode("s.patterns").alias("pattern"))
    # contexts without seeds stay: what earlier rounds learn may support them in later ones
    edges = common.stored(slots.groupBy("pattern", "value").agg(F.max("kind").alias("kind")), "edges")
    belief = edges.select("pattern", "value", "kind", F.when(F.col("kind").isNotNull(), 1.0).otherwise(0.0).alias("p"))
    for left in range(rounds, 0, -1):
        per_kind = belief.where("kind is not null").groupBy("pattern", "kind").agg(F.sum("p").alias("mass"), F.count("*").alias("of_kind"))
        total = edges.groupBy("pattern").agg(F.count_distinct("value").alias("n"))
        scores = per_kind.where(F.col("of_kind") >= seeds).join(total, "pattern").select("pattern", "kind", (F.col("mass") / (F.col("n") + 1)).alias("confidence"))
        good = scores.where(F.col("confidence") >= sure).checkpoint()
        if left == 1:
            return good
        new = (
            edges.where("kind is null")
            .select("pattern", "value")
            .join(good, "pattern")
            .groupBy("value", "kind")
            .agg((1 - F.exp(F.sum(F.log1p(-F.least("confidence", F.lit(0.999)))))).alias("p"))
            .where(F.col("p") >= likely)
        )
        taken = edges.where("kind is null").select("pattern", "value").join(new, "value").select("pattern", "value", "kind", "p")
        belief = edges.where("kind is not null").select("pattern", "value", "kind", F.lit(1.0).alias("p")).unionByName(taken)
    raise ValueError("at least one round")


def extracted(docs: DataFrame, **how) -> DataFrame:
    """row, doc_id, base, learned: both arrays of (start, place, stop, kind)."""
    found = common.stored(scanned(docs), "spans")
    good = bootstrap(found, **how)
    slots = found.where(F.size("other") > 0).select("row", F.explode("other").alias("s"))
    slots = slots.select("row", "s.start", "s.stop", F.explode("s.patterns").alias("pattern"))
    hits = slots.join(common.beside(good, good.count()), "pattern").groupBy("row", "start", "stop").agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    # a document's learned spans are part of its own text, so the list is bounded by the row it came from
    learned = hits.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", place.alias("place"), "stop", "kind"))).alias("learned"))
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["place"].alias("place"), s["stop"].alias("stop"), s["kind"].alias("kind")))
    empty = F.array().cast("array<struct<start:int,place:int,stop:int,kind:string>>")
    return found.select("row", "doc_id", base.alias("base")).join(learned, "row", "left").withColumn("learned", F.coalesce("learned", empty))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redacted(docs: DataFrame) -> DataFrame:
    """docs with every span replaced by its kind in brackets, and n_chars to match, where it is there.

    The table is read once for the spans and once for the texts; a row's spans are found again by 256 bits of hash of
    its text. Equal texts get equal results. A null text stays null."""
    key, spans_ = common.fresh(docs, "key", "spans")
    digest = F.sha2("text", 256)
    spans = extracted(docs.select(digest.alias("doc_id"), "text").where("text is not null"))
    spans = spans.select(F.col("doc_id").alias(key), F.array_sort(F.concat("base", "learned")).alias(spans_)).where(F.size(spans_) > 0).dropDuplicates([key])
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, x: Column) -> Column:
        gap = F.concat(F.substring("text", s["at"] + 1, F.greatest(x["start"] - s["at"], F.lit(0))), F.lit("["), F.upper(x["kind"]), F.lit("]"))
        # a span that begins inside the last one is covered by it; what it has beyond goes, too
        return F.struct(F.greatest(s["at"], x["stop"]).alias("at"), F.concat(s["out"], F.when(x["start"] < s["at"], F.lit("")).otherwise(gap)).alias("out"))

    clean = F.aggregate(spans_, state, step, lambda s: F.concat(s["out"], F.substring("text", s["at"] + 1, F.lit(2**31 - 1) - s["at"])))
    out = docs.withColumn(key, digest).join(spans, key, "left").withColumn("text", F.when(F.col(spans_).isNull(), F.col("text")).otherwise(clean))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(spans_).isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*docs.columns)


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extracted(common.documents(spark, sf_dir))
    count = {f"n_{k}": _count(k) for k in KINDS}
    return out.select(
        "doc_id",
        *[c.alias(n) for n, c in count.items()],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.array_sort(F.concat("base", "learned"))).alias("spans"),
    )


QUERIES = {"op9_pii": op9_pii}
SQL: dict = {}

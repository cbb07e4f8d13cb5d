"""A query for each operator of the library, over whole tables, with its SQL oracle where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.functions import keys, phonetic, translit
from weftlink.functions import similarity as S
from weftlink.functions.normalize import nfkc
from weftlink.operators import blocking, features, metrics, model, profile, resolve, validate
from weftlink.plans import fixtures as X
from weftlink.plans import linkage
from weftlink.sources import tables

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return register


def _doc(sql: str) -> str:
    return f"WITH {X.DOC_SQL}, {X.NORM_SQL}, {X.TRUTH_SQL}, {sql}"


def _cust(sql: str) -> str:
    return f"WITH {X.CUST_SQL}, {X.NORM_SQL}, {sql}"


def _docs(spark, d):
    return X.sides(X.docs_normalized(spark, d))


def _custs(spark, d):
    return X.sides(X.custs_normalized(spark, d))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


# Sources

ENT = f"WITH {X.DOC_SQL}"


@query("s02_source_scan", f"{ENT} SELECT entity_id, coalesce(name, '') AS name, coalesce(address, '') AS address, coalesce(country, '') AS country FROM ent")
def s02(spark: SparkSession, d: str) -> DataFrame:
    """Aliased columns, missing texts."""
    raw = X.doc_entities(spark, d).select(F.col("entity_id").alias("S1_ID"), F.col("name").alias("Business_Name"), F.col("address").alias("address_text"), "country")
    return tables.shaped(raw)


@query(
    "s03_ground_truth_parse",
    _doc("z AS (SELECT 1) SELECT sid, array_to_string(trues, '|') AS trues, len(trues)::INT AS n_matches FROM tru"),
)
def s03(spark, d):
    truth = X.doc_truth(X.doc_entities(spark, d))
    text = truth.select(F.col("sid").alias("source1_entity_id"), F.concat(F.lit(" ,"), F.array_join("trues", " , "), F.lit(",")).alias("Matched_IDs"))
    return tables.truth_shaped(text).select("sid", F.array_join("trues", "|").alias("trues"), "n_matches")


@query(
    "s04_matched_sample",
    _doc("""
t AS (SELECT entity_id AS sid, ord FROM s1 ORDER BY ord OFFSET 5 LIMIT 100),
want AS (SELECT DISTINCT gt.cid FROM gt JOIN t USING (sid)),
o2 AS (SELECT entity_id, source FROM oth WHERE source = 2 AND entity_id IN (FROM want)
  UNION SELECT * FROM (SELECT entity_id, source FROM oth WHERE source = 2 ORDER BY ord LIMIT 50)),
o3 AS (SELECT entity_id, source FROM oth WHERE source = 3 AND entity_id IN (FROM want)
  UNION SELECT * FROM (SELECT entity_id, source FROM oth WHERE source = 3 ORDER BY ord LIMIT 50))
SELECT sid AS entity_id, 1::INT AS source FROM t UNION ALL FROM o2 UNION ALL FROM o3"""),
)
def s04(spark, d):
    """Sampling is the feature: 100 rows of truth from the sixth on, their partners, 50 more of each source."""
    ent = X.doc_entities(spark, d)
    s1 = ent.where("source = 1")
    truth = X.doc_truth(ent).join(s1.select(F.col("entity_id").alias("sid"), "ord"), "sid")
    got = tables.matched_sample(s1, {"s2": ent.where("source = 2"), "s3": ent.where("source = 3")}, truth, 100, 50, skip=5)
    return got["s1"].select("entity_id", "source").unionByName(got["s2"].select("entity_id", "source")).unionByName(got["s3"].select("entity_id", "source"))


@query(
    "s07_record_lookup",
    _cust("""z AS (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
SELECT entity_id, normalized_name, core_name, suffix, postal_code, country FROM rec WHERE ord IN (FROM z)"""),
)
def s07(spark, d):
    wanted = X.table(spark, d, "customer").where("c_acctbal > 0").select(X._ids("c_custkey")[0])
    store = X.custs_normalized(spark, d).select("entity_id", "normalized_name", "core_name", "suffix", "postal_code", "country").fillna("")
    return tables.lookup(store, wanted)


PARTS = "z AS (SELECT ceil(count(*) / 3)::BIGINT AS size FROM s1), sh AS (SELECT entity_id, row_number() OVER (ORDER BY ord) - 1 AS r FROM s1)"


@query(
    "s13_merge_shards",
    _doc(f"{PARTS} SELECT sh.entity_id AS source1_entity_id, (r // size)::INT AS shard, array_to_string(trues, ',') AS matched_entity_ids FROM sh JOIN tru ON sid = entity_id, z"),
)
def s13(spark, d):
    ent = X.doc_entities(spark, d)
    s1, truth = ent.where("source = 1"), X.doc_truth(ent).select("sid", F.col("trues").alias("cids"))
    parts = [tables.output_rows(rows, truth, "matched_entity_ids").withColumn("shard", F.lit(i)) for i, rows in enumerate(tables.shards_of(s1, 3))]
    return tables.merged(parts).select("source1_entity_id", "shard", "matched_entity_ids")


# Normalization and keys


@query("n_normalize_name", _cust("z AS (SELECT 1) SELECT entity_id, raw_name, normalized_name, core_name, sorted_core, suffix FROM rec"))
def n_name(spark, d):
    return X.custs_normalized(spark, d).select("entity_id", "raw_name", "normalized_name", "core_name", "sorted_core", "suffix")


@query("n_normalize_address", _cust("z AS (SELECT 1) SELECT entity_id, raw_addr, normalized_addr, sorted_addr_tokens, postal_code, landmark, country FROM rec"))
def n_address(spark, d):
    return X.custs_normalized(spark, d).select("entity_id", "raw_addr", "normalized_addr", "sorted_addr_tokens", "postal_code", "landmark", "country")


@query("n_normalize_documents", _doc("z AS (SELECT 1) SELECT entity_id, normalized_name, core_name, sorted_core, suffix, normalized_addr, landmark FROM rec"))
def n_documents(spark, d):
    return X.docs_normalized(spark, d).select("entity_id", "normalized_name", "core_name", "sorted_core", "suffix", "normalized_addr", "landmark")


@query("n02_nfkc")
def n02(spark, d):
    docs = X.table(spark, d, "documents")
    return docs.select("doc_id", F.md5(nfkc(F.col("text"))).alias("nfkc_md5"))


def let_sql(value: str, name: str, body: str) -> str:
    """body with the value under a name."""
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def nysiis_sql(word: str) -> str:
    """NYSIIS by letters and their neighbours, as DuckDB's expressions can't look around."""
    edges = [("^MAC", "MCC"), ("^KN", "NN"), ("^K", "C"), ("^P[HF]", "FF"), ("^SCH", "SSS"), ("(EE|IE)$", "Y"), ("(DT|RT|RD|NT|ND)$", "D")]
    start = f"regexp_replace(upper({word}), '[^A-Z]', '', 'g')"
    for old, new in edges:
        start = f"regexp_replace({start}, '{old}', '{new}')"

    def rest(x: str, rules: list[tuple[str, str]]) -> str:
        inside = f"substr({x}, 2)"
        for old, new in rules:
            inside = f"regexp_replace({inside}, '{old}', '{new}', 'g')"
        return f"substr({x}, 1, 1) || {inside}"

    def letters(x: str, case: str) -> str:
        return f"array_to_string(list_transform(string_split({x}, ''), lambda ch, i: CASE {case} ELSE ch END), '')"

    vowel = lambda at, x: f"contains('AEIOU', substr({x}, {at}, 1))"
    h = f"WHEN i > 1 AND ch = 'H' AND (NOT {vowel('i - 1', 'b')} OR (i < length(b) AND NOT {vowel('i + 1', 'b')})) THEN '_'"
    w = f"WHEN i > 1 AND ch = 'W' AND {vowel('i - 1', 'c')} THEN '_'"
    inner = [("EV", "af"), ("[AEIOU]", "a"), ("Q", "g"), ("Z", "s"), ("M", "n"), ("K", "c")]
    once = "array_to_string(list_filter(string_split(e, ''), lambda ch, i: i = 1 OR ch <> substr(e, i - 1, 1)), '')"
    end = "regexp_replace(regexp_replace(regexp_replace(f, '(.)S$', '\\1'), 'AY$', 'Y'), '(.)A$', '\\1')"
    body = let_sql(once, "f", end)
    body = let_sql("upper(replace(d, '_', ''))", "e", body)
    body = let_sql(rest("d0", inner), "d", body)
    body = let_sql(letters("c", w), "d0", body)
    body = let_sql(letters("b", h), "c", body)
    body = let_sql(rest("a", [("KN", "n"), ("SCH", "s"), ("PH", "f")]), "b", body)
    return f"CASE WHEN {start} = '' THEN '' ELSE {let_sql(start, 'a', body)} END"


_SOUND = f"array_to_string(list_transform(regexp_extract_all(core_name, '[A-Za-z]+'), lambda w: {nysiis_sql('w')}), ' ')"


@query("k01_nysiis", _cust(f"z AS (SELECT 1) SELECT entity_id, {_SOUND} AS phonetic_key FROM rec"))
def k01(spark, d):
    ent = X.custs_normalized(spark, d)
    return ent.select("entity_id", phonetic.phonetic_key(F.col("core_name")).alias("phonetic_key"))


def latin_sql(text: str) -> str:
    table = "MAP {" + ", ".join(f"{place}: '{latin}'" for place, latin in translit.LETTERS.items()) + "}"
    first, last = min(translit.BLOCKS), max(translit.BLOCKS) + 127
    letter = f"CASE WHEN unicode(ch) BETWEEN {first} AND {last} THEN coalesce({table}[(unicode(ch) - {first}) % 128], '') ELSE ch END"
    out = f"lower(array_to_string(list_transform(string_split({text}, ''), lambda ch: {letter}), ''))"
    for old, new in translit.SUBSTITUTIONS:
        out = f"replace({out}, '{old}', '{new}')"
    return out


@query("k04_transliterate", f"SELECT doc_id, md5({latin_sql("coalesce(text, '')")}) AS latin_md5 FROM documents")
def k04(spark, d):
    return X.table(spark, d, "documents").select("doc_id", F.md5(translit.latin(F.col("text"))).alias("latin_md5"))


NUMBER = keys.NUMBER


def _forms(x: str, unpadded: bool) -> str:
    more = f" || CASE WHEN length(ltrim({x}, '0')) >= 2 THEN [ltrim({x}, '0')] ELSE [] END" if unpadded else ""
    digits = rf"regexp_replace({x}, '\D', '', 'g')"
    return f"[{x}] || CASE WHEN length({digits}) >= 2 THEN [{digits}, ltrim({digits}, '0')] ELSE [] END{more}"


def _numbers(unpadded: bool) -> str:
    raw = f"list_filter(list_transform(regexp_extract_all(lower(raw_addr), '{NUMBER}'), lambda x: trim(x, '-# ')), lambda x: length(x) >= 2)"
    return f"list_sort(list_distinct(flatten(list_transform({raw}, lambda x: {_forms('x', unpadded)}))))"


@query("k05_address_numbers", _cust(f"z AS (SELECT 1) SELECT entity_id, array_to_string({_numbers(False)}, '|') AS numbers FROM rec"))
def k05(spark, d):
    return X.custs_normalized(spark, d).select("entity_id", F.array_join(keys.address_numbers(F.col("raw_addr")), "|").alias("numbers"))


_STOP = "[" + ", ".join(f"'{w}'" for w in keys.PLACE_WORDS) + "]"
ADDRESS_KEYS = rf"""
nk AS (SELECT *, {_numbers(True)} AS nums, list_filter({X.tokens_sql(X.squeezed_sql("lower(raw_addr)"))},
  lambda t: length(t) >= 3 AND NOT regexp_matches(t, '^[0-9]+$') AND NOT list_contains({_STOP}, t)) AS words FROM rec),
ak AS (SELECT entity_id, ord, source, country, unnest(list_distinct(
  CASE WHEN length(coalesce(postal_code, '')) >= 4 THEN ['post_' || postal_code] || list_transform(nums[1:3], lambda n: postal_code || '_' || n) ELSE [] END
  || flatten(list_transform(nums[1:4], lambda n: list_transform(words, lambda w: n || '_' || w))))) AS key FROM nk)"""


@query("k06_address_keys", _cust(f"{ADDRESS_KEYS} SELECT entity_id, key FROM ak"))
def k06(spark, d):
    return X.custs_normalized(spark, d).select("entity_id", F.explode(keys.address_keys(F.col("raw_addr"), F.col("postal_code"))).alias("key"))


_TITLES = "[" + ", ".join(f"'{w}'" for w in keys.TITLES) + "]"
_SAY = "[" + ", ".join(f"'{w}'" for w in keys.NAME_WORDS) + "]"
FIRST_WORD = f"""
fw0 AS (SELECT *, list_filter({X.tokens_sql("core_name")}, lambda t: NOT list_contains({_TITLES}, t))[1] AS w FROM rec),
fw AS (SELECT entity_id, ord, source, country, w AS key FROM fw0 WHERE length(w) >= 3 AND NOT list_contains({_SAY}, w))"""


@query("k07_first_word", _doc(f"{FIRST_WORD} SELECT entity_id, key FROM fw"))
def k07(spark, d):
    return X.docs_normalized(spark, d).select("entity_id", keys.first_word(F.col("core_name")).alias("key")).where("key is not null")


@query(
    "k08_acronym",
    _doc(f"z AS (SELECT 1) SELECT entity_id, array_to_string(list_transform({X.tokens_sql('core_name')}, lambda w: substr(w, 1, 1)), '') AS acronym FROM rec"),
)
def k08(spark, d):
    return X.docs_normalized(spark, d).select("entity_id", keys.acronym(F.col("core_name")).alias("acronym"))


_GRAMS = """
w0 AS (SELECT entity_id, source, ' ' || unnest(list_filter(string_split(normalized_name || ' ' || normalized_addr, ' '), lambda t: t <> '')) || ' ' AS w FROM rec),
g0 AS (SELECT entity_id, source, w, unnest(range(3, least(5, length(w)) + 1)) AS n FROM w0),
g1 AS (SELECT entity_id, source, w, n, unnest(range(1, length(w) - n + 2)) AS i FROM g0),
tf AS (SELECT entity_id, source, substr(w, i, n) AS gram, count(*) AS tf FROM g1 GROUP BY ALL)"""
_TFIDF = f"""{_GRAMS},
df AS (SELECT gram, count(*) AS df FROM tf GROUP BY gram),
rw AS (SELECT tf.*, tf * (ln((1.0 + (SELECT count(*) FROM rec)) / (1 + df)) + 1) AS raw FROM tf JOIN df USING (gram)),
nm AS (SELECT entity_id, sqrt(sum(raw * raw)) AS norm FROM rw GROUP BY entity_id),
wt AS (SELECT rw.entity_id, source, gram, raw / norm AS w FROM rw JOIN nm USING (entity_id))"""


def _text() -> F.Column:
    return F.concat_ws(" ", "normalized_name", "normalized_addr")


@query("k09_char_ngrams", _doc(f"{_GRAMS} SELECT entity_id, gram, tf FROM tf"))
def k09(spark, d):
    return X.docs_normalized(spark, d).select("entity_id", F.explode(keys.char_ngrams(_text())).alias("gram")).groupBy("entity_id", "gram").agg(F.count("*").alias("tf"))


@query("k10_tfidf", _doc(f"{_TFIDF} SELECT entity_id, gram, round(w, 6) AS w FROM wt"))
def k10(spark, d):
    ent = X.docs_normalized(spark, d)
    return _rounded(blocking.tfidf(ent, _text(), ent.count()))


# Joins


def _capped_sql(buckets: str, name: str) -> str:
    return f"""
{name}_b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key, country ORDER BY ord, entity_id) AS pos FROM {buckets} WHERE source <> 1) WHERE pos <= 30),
{name}_p AS (SELECT l.entity_id AS sid, b.entity_id AS cid, b.pos::INT AS pos FROM {buckets} l JOIN {name}_b b ON l.key = b.key AND l.country = b.country WHERE l.source = 1)"""


EXACT = "ex AS (SELECT entity_id, ord, source, country, sorted_core AS key FROM rec WHERE length(sorted_core) >= 3)"


@query("j01_exact_key_blocking", _doc(f"{EXACT}, {_capped_sql('ex', 'ex')} SELECT sid, cid, pos FROM ex_p"))
def j01(spark, d):
    return blocking.key_pairs(*_docs(spark, d), "exact")


PHONETIC = f"""
ph0 AS (SELECT *, {_SOUND} AS sound FROM rec), ph AS (SELECT entity_id, ord, source, country, sound AS key FROM ph0 WHERE length(core_name) >= 3 AND sound <> '')"""


@query("j02_phonetic_blocking", _cust(f"{PHONETIC}, {_capped_sql('ph', 'ph')} SELECT sid, cid, pos FROM ph_p"))
def j02(spark, d):
    return blocking.key_pairs(*_custs(spark, d), "phonetic")


@query(
    "j03_tfidf_topk",
    _doc(f"""{_TFIDF},
sm AS (SELECT a.entity_id AS sid, b.entity_id AS cid, round(sum(a.w * b.w), 9) AS sim FROM wt a JOIN wt b USING (gram) WHERE a.source = 1 AND b.source <> 1 GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY sim DESC, cid)::INT AS rank FROM sm)
SELECT sid, cid, round(sim, 6) AS sim, rank FROM rk WHERE rank <= 15"""),
)
def j03(spark, d):
    return _rounded(blocking.tfidf_pairs(*_docs(spark, d), 15))


@query("j04_first_word_blocking", _doc(f"{FIRST_WORD}, {_capped_sql('fw', 'fw')} SELECT sid, cid, pos FROM fw_p"))
def j04(spark, d):
    return blocking.key_pairs(*_docs(spark, d), "first_word")


@query("j05_address_key_blocking", _cust(f"{ADDRESS_KEYS}, {_capped_sql('ak', 'ak')} SELECT DISTINCT sid, cid FROM ak_p"))
def j05(spark, d):
    return blocking.address_pairs(*_custs(spark, d))


_VEC = "lpad(vec_id::VARCHAR, 8, '0')"


@query(
    "j06_embedding_topk",
    f"""WITH v AS (SELECT 'S' || (1 + vec_id % 3)::VARCHAR || '-' || {_VEC} AS id, 1 + vec_id % 3 AS source, embedding::DOUBLE[64] AS e FROM embeddings),
sm AS (SELECT a.id AS sid, b.id AS cid, round(list_cosine_similarity(a.e::DOUBLE[], b.e::DOUBLE[]), 9) AS sim FROM v a, v b WHERE a.source = 1 AND b.source <> 1),
rk AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY sim DESC, cid)::INT AS rank FROM sm)
SELECT sid, cid, round(sim, 6) AS sim, rank FROM rk WHERE rank <= 10""",
)
def j06(spark, d):
    ent = X.table(spark, d, "embeddings").select(*X._ids("vec_id"), "embedding")
    return _rounded(blocking.embedding_pairs(*X.sides(ent), 10))


@query(
    "j07_priority_cap",
    _doc(f"""{EXACT}, {_capped_sql("ex", "ex")}, {FIRST_WORD}, {_capped_sql("fw", "fw")},
un AS (SELECT sid, cid, 0 AS pass, pos FROM ex_p UNION ALL SELECT sid, cid, 1 AS pass, pos FROM fw_p),
mn AS (SELECT sid, cid, min(pass * 1000 + pos) AS first FROM un GROUP BY ALL),
rk AS (SELECT sid, cid, row_number() OVER (PARTITION BY sid ORDER BY first, cid)::INT AS rank FROM mn)
SELECT sid, cid, rank FROM rk WHERE rank <= 15"""),
)
def j07(spark, d):
    s1, other = _docs(spark, d)
    both = [blocking.key_pairs(s1, other, name).withColumns({"pass": F.lit(i), "k": F.lit(0)}) for i, name in enumerate(("exact", "first_word"))]
    return blocking.prioritised(both[0].unionByName(both[1]))


_NUM = f"""
nt AS (SELECT entity_id, ord, source, country, list_distinct(list_filter(list_transform(regexp_extract_all(lower(normalized_addr), '{NUMBER}'), lambda x: trim(x, '-# ')), lambda x: length(x) >= 2)) AS nums FROM rec),
nb AS (SELECT entity_id, ord, source, country, unnest(nums) AS key FROM nt)"""


@query("j08_number_blocking", _cust(f"{_NUM}, {_capped_sql('nb', 'nb')} SELECT DISTINCT sid, cid FROM nb_p"))
def j08(spark, d):
    return blocking.number_pairs(*_custs(spark, d)).select("sid", "cid").distinct()


_DOC_PAIRS = f"{EXACT}, {_capped_sql('ex', 'ex')}, {FIRST_WORD}, {_capped_sql('fw', 'fw')}, un AS (SELECT sid, cid FROM ex_p UNION SELECT sid, cid FROM fw_p)"


def _doc_pairs(s1, other):
    return blocking.union_pairs([blocking.key_pairs(s1, other, name) for name in ("exact", "first_word")])


@query("u02_candidate_union", _doc(f"{_DOC_PAIRS}, li AS (SELECT sid, list_sort(list(cid)) AS cids FROM un GROUP BY sid) SELECT sid, array_to_string(cids, ',') AS cids FROM li"))
def u02(spark, d):
    return blocking.listed(_doc_pairs(*_docs(spark, d))).select("sid", F.array_join("cids", ",").alias("cids"))


def _jaccard_sql(a: str, b: str) -> str:
    union = f"len(list_distinct({a} || {b}))"
    return f"CASE WHEN {union} = 0 THEN 1.0::DOUBLE ELSE len(list_intersect({a}, {b}))::DOUBLE / {union} END"


_SCORED = f"""{_DOC_PAIRS},
pt AS (SELECT un.sid, un.cid, a.sorted_core AS k1, b.sorted_core AS k2, {X.tokens_sql("a.normalized_name")} AS t1, {X.tokens_sql("b.normalized_name")} AS t2,
  {X.tokens_sql("a.normalized_addr")} AS u1, {X.tokens_sql("b.normalized_addr")} AS u2
  FROM un JOIN s1 a ON a.entity_id = un.sid JOIN oth b ON b.entity_id = un.cid),
sc AS (SELECT sid, cid, round(0.7::DOUBLE * greatest({_jaccard_sql("t1", "t2")}, CASE WHEN k1 <> '' AND k1 = k2 THEN 1.0::DOUBLE ELSE 0.0 END)
  + 0.3::DOUBLE * CASE WHEN len(u1) > 0 AND len(u2) > 0 THEN {_jaccard_sql("u1", "u2")} ELSE 0.0 END, 6) AS score FROM pt)"""
_CLAIMED = f"""{_SCORED},
ow AS (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY score DESC, sid) AS r FROM sc WHERE score >= 0.5),
cl AS (SELECT sid, cid, score FROM ow WHERE r = 1),
ml AS (SELECT sid, list(cid ORDER BY score DESC, cid) AS cids FROM cl GROUP BY sid),
fin AS (SELECT s1.entity_id AS sid, coalesce(ml.cids, []) AS cids FROM s1 LEFT JOIN ml ON ml.sid = s1.entity_id)"""


def _scored(spark, d):
    s1, other = _docs(spark, d)
    return s1, other, linkage.ruled(_doc_pairs(s1, other), s1, other)


@query("j10_labels", _doc(f"{_DOC_PAIRS} SELECT un.sid, un.cid, (gt.cid IS NOT NULL)::INT AS label FROM un LEFT JOIN gt ON gt.sid = un.sid AND gt.cid = un.cid"))
def j10(spark, d):
    s1, other = _docs(spark, d)
    flat = X.doc_truth(X.doc_entities(spark, d)).select("sid", F.explode("trues").alias("cid"))
    return metrics.labelled(_doc_pairs(s1, other).select("sid", "cid"), flat)


@query(
    "p12_negative_downsample",
    _doc(f"""{_DOC_PAIRS}, lb AS (SELECT un.sid, un.cid, (gt.cid IS NOT NULL)::INT AS label FROM un LEFT JOIN gt ON gt.sid = un.sid AND gt.cid = un.cid),
ng AS (SELECT *, row_number() OVER (ORDER BY md5(sid || '|' || cid), sid, cid) AS r FROM lb WHERE label = 0)
SELECT sid, cid, label FROM lb WHERE label = 1 UNION ALL SELECT sid, cid, label FROM ng WHERE r <= 4 * (SELECT sum(label) FROM lb)"""),
)
def p12(spark, d):
    return model.downsampled(j10(spark, d), least=0)


# Features

_PAIRS = f"{EXACT}, {_capped_sql('ex', 'ex')}"
_BARE = "regexp_replace({x}, '[^\\p{{L}}\\p{{N}}_]', '', 'g')"


def _lev(a: str, b: str) -> str:
    return f"CASE WHEN greatest(length({a}), length({b})) = 0 THEN 0.0::DOUBLE ELSE 1 - levenshtein({a}, {b})::DOUBLE / greatest(length({a}), length({b})) END"


def _eq(c: str) -> str:
    return f"coalesce(a.{c} <> '' AND a.{c} = b.{c}, FALSE)::INT"


_TK = {s: {c: X.tokens_sql(f"{s}.{c}") for c in ("normalized_name", "normalized_addr", "core_name")} for s in "ab"}
_ACR = {s: f"array_to_string(list_transform({_TK[s]['core_name']}, lambda w: substr(w, 1, 1)), '')" for s in "ab"}
_BOTH = "(a.normalized_addr <> '' AND b.normalized_addr <> '')"
_PLAIN = {s: _BARE.format(x=f"{s}.normalized_name") for s in "ab"}
_NATIVE_SQL = f"""{_PAIRS}, nu AS (SELECT *, {_numbers(False)} AS nums FROM rec),
fe AS (SELECT p.sid, p.cid,
  {_eq("normalized_name")} AS name_exact, {_eq("core_name")} AS name_core_exact, {_eq("sorted_core")} AS name_sorted_exact, {_eq("suffix")} AS name_suffix_match,
  {_lev("a.normalized_name", "b.normalized_name")} AS name_levenshtein, {_jaccard_sql(_TK["a"]["normalized_name"], _TK["b"]["normalized_name"])} AS name_jaccard,
  abs(length(a.normalized_name) - length(b.normalized_name))::INT AS name_len_diff,
  CASE WHEN greatest(length(a.normalized_name), length(b.normalized_name)) = 0 THEN 1.0::DOUBLE
    ELSE least(length(a.normalized_name), length(b.normalized_name))::DOUBLE / greatest(length(a.normalized_name), length(b.normalized_name)) END AS name_len_ratio,
  (replace(a.normalized_name, ' ', '') <> '' AND replace(a.normalized_name, ' ', '') = replace(b.normalized_name, ' ', ''))::INT AS name_nospace_exact,
  {_lev("replace(a.normalized_name, ' ', '')", "replace(b.normalized_name, ' ', '')")} AS name_nospace_lev,
  (length({_PLAIN["a"]}) >= 5 AND length({_PLAIN["b"]}) >= 5 AND (contains({_PLAIN["a"]}, {_PLAIN["b"]}) OR contains({_PLAIN["b"]}, {_PLAIN["a"]})))::INT AS domain_subname_match,
  ((length({_ACR["a"]}) >= 2 AND {_ACR["a"]} = b.core_name) OR (length({_ACR["b"]}) >= 2 AND {_ACR["b"]} = a.core_name))::INT AS acronym_match,
  (NOT {_BOTH})::INT AS addr_either_empty,
  CASE WHEN {_BOTH} THEN {_lev("a.normalized_addr", "b.normalized_addr")} ELSE 0.0 END AS addr_levenshtein,
  CASE WHEN {_BOTH} THEN {_jaccard_sql(_TK["a"]["normalized_addr"], _TK["b"]["normalized_addr"])} ELSE 0.0 END AS addr_token_jaccard,
  {_eq("postal_code")} AS addr_postal_match, (a.postal_code IS NULL OR b.postal_code IS NULL)::INT AS addr_postal_missing, {_eq("landmark")} AS addr_landmark_match,
  abs(length(a.normalized_addr) - length(b.normalized_addr))::INT AS addr_len_diff,
  (len(list_intersect(a.nums, b.nums)) > 0)::INT AS has_common_addr_num, len(list_intersect(a.nums, b.nums))::INT AS num_common_addr_nums,
  {_eq("country")} AS country_match, (a.country = '' OR b.country = '')::INT AS country_missing, starts_with(p.cid, 'S2-')::INT AS source_is_s2
  FROM ex_p p JOIN nu a ON a.entity_id = p.sid JOIN nu b ON b.entity_id = p.cid)"""


def _pairs(spark, d):
    s1, other = _custs(spark, d)
    return s1, other, blocking.key_pairs(s1, other, "exact").select("sid", "cid")


@query(
    "f_native_features",
    _cust(f"{_NATIVE_SQL} SELECT * REPLACE (round(name_levenshtein, 6) AS name_levenshtein, round(name_jaccard, 6) AS name_jaccard, round(name_len_ratio, 6) AS name_len_ratio, "
          "round(name_nospace_lev, 6) AS name_nospace_lev, round(addr_levenshtein, 6) AS addr_levenshtein, round(addr_token_jaccard, 6) AS addr_token_jaccard) FROM fe"),
)
def f_native(spark, d):
    s1, other, pairs = _pairs(spark, d)
    found = features.native()
    return _rounded(features.joined(pairs, s1, other).withColumns(found).select("sid", "cid", *found))


@query(
    "f06_jaro_winkler",
    _cust(f"{_PAIRS} SELECT sid, cid, round(jaro_winkler_similarity(a.normalized_name || ' ' || a.normalized_addr, b.normalized_name || ' ' || b.normalized_addr), 6) AS sim "
          "FROM ex_p JOIN rec a ON a.entity_id = sid JOIN rec b ON b.entity_id = cid"),
)
def f06(spark, d):
    s1, other, pairs = _pairs(spark, d)
    text = lambda s: F.concat_ws(" ", f"{s}_normalized_name", f"{s}_normalized_addr")
    return _rounded(features.joined(pairs, s1, other).select("sid", "cid", S.jaro_winkler_of(text("s"), text("c")).alias("sim")))


@query("f07_f08_token_ratios")
def f07(spark, d):
    s1, other, pairs = _pairs(spark, d)
    df = features.featured(pairs, s1, other)
    return _rounded(df.select("sid", "cid", *features.by_kernel(), "high_confidence_addr_match", "max_name_sim", "joint_confidence", "embedding_cosine"))


def _codes_sql(core: str) -> str:
    return f"list_filter(list_transform({X.tokens_sql(core)}, lambda w: {nysiis_sql('w')}), lambda c: c <> '')"


@query(
    "f10_phonetic",
    _cust(f"""{_PAIRS}, co AS (SELECT entity_id, {_codes_sql('core_name')} AS codes FROM rec)
SELECT sid, cid, (len(a.codes) > 0 AND a.codes = b.codes)::INT AS name_phonetic_match, round({_jaccard_sql('a.codes', 'b.codes')}, 6) AS name_phonetic_jaccard
FROM ex_p JOIN co a ON a.entity_id = sid JOIN co b ON b.entity_id = cid"""),
)
def f10(spark, d):
    s1, other, pairs = _pairs(spark, d)
    found = features.by_sound()
    return _rounded(features.joined(pairs, s1, other).withColumns(found).select("sid", "cid", *found))


@query(
    "w01_rank_margin",
    """WITH w AS (SELECT o_orderkey, o_custkey, row_number() OVER o AS rank_within_s1, lead(o_totalprice) OVER o AS nxt, o_totalprice,
  count(*) OVER (PARTITION BY o_custkey) AS s1_candidate_count FROM orders WINDOW o AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey))
SELECT o_orderkey, o_custkey, rank_within_s1::INT AS rank_within_s1, round(coalesce(abs(o_totalprice - nxt), 0.0), 4) AS gap_to_next_best, s1_candidate_count FROM w""",
)
def w01(spark, d):
    df = features.ranked(X.table(spark, d, "orders"), "o_custkey", "o_totalprice", "o_orderkey")
    return df.select("o_orderkey", "o_custkey", "rank_within_s1", F.round("gap_to_next_best", 4).alias("gap_to_next_best"), "s1_candidate_count")


# Matches and metrics


@query("w07_claim_once", _doc(f"{_CLAIMED} SELECT sid, cid, score FROM cl"))
def w07(spark, d):
    return resolve.claimed(_scored(spark, d)[2], 0.5)


def _final(spark, d):
    s1, other, scored = _scored(spark, d)
    return s1, scored, resolve.completed(s1, resolve.match_lists(resolve.claimed(scored, 0.5)))


@query("j11_singleton_completion", _doc(f"{_CLAIMED} SELECT sid, array_to_string(cids, ',') AS cids FROM fin"))
def j11(spark, d):
    return _final(spark, d)[2].select("sid", F.array_join("cids", ",").alias("cids"))


@query("s10_tsv_rows", _doc(f"{_CLAIMED} SELECT ord, sid AS source1_entity_id, array_to_string(cids, ',') AS matched_entity_ids FROM fin JOIN s1 ON entity_id = sid"))
def s10(spark, d):
    s1, _, final = _final(spark, d)
    return tables.output_rows(s1, final, "matched_entity_ids")


_F05 = """CASE WHEN n_true = 0 AND n_pred = 0 THEN 1.0::DOUBLE WHEN n_true = 0 OR n_pred = 0 OR hits = 0 THEN 0.0::DOUBLE
  ELSE 1.25 * (hits::DOUBLE / n_pred) * (hits::DOUBLE / n_true) / (0.25 * (hits::DOUBLE / n_pred) + hits::DOUBLE / n_true) END"""
_ENTS = f"""{_CLAIMED},
en0 AS (SELECT tru.sid, len(trues) AS n_true, len(cids) AS n_pred, len(list_intersect(trues, cids)) AS hits FROM tru JOIN fin USING (sid)),
en AS (SELECT *, {_F05} AS f05 FROM en0)"""


def _entities(spark, d):
    return metrics.scored_entities(X.doc_truth(X.doc_entities(spark, d)), _final(spark, d)[2])


@query("a11_entity_f05", _doc(f"{_ENTS} SELECT sid, n_true::INT AS n_true, n_pred::INT AS n_pred, hits::INT AS hits, round(f05, 6) AS f05 FROM en"))
def a11(spark, d):
    return _rounded(_entities(spark, d).select("sid", "n_true", "n_pred", "hits", "f05"))


@query("a12_macro_f05", _doc(f"{_ENTS} SELECT round(avg(f05), 6) AS macro_f05, count(*) AS n FROM en"))
def a12(spark, d):
    return _rounded(metrics.macro(_entities(spark, d)))


@query(
    "a13_blocking_metrics",
    _doc(f"""{_DOC_PAIRS}, ct AS (SELECT (SELECT count(*) FROM gt) AS true_pairs, (SELECT count(*) FROM un JOIN gt USING (sid, cid)) AS hits,
  (SELECT count(*) FROM un) AS candidates, (SELECT count(*) FROM s1) * (SELECT count(*) FROM oth) AS allp)
SELECT true_pairs, hits, candidates, round(hits::DOUBLE / true_pairs, 6) AS recall, round(1 - candidates::DOUBLE / allp, 6) AS reduction_ratio FROM ct"""),
)
def a13(spark, d):
    s1, other = _docs(spark, d)
    flat = X.doc_truth(X.doc_entities(spark, d)).select("sid", F.explode("trues").alias("cid"))
    n = X.doc_entities(spark, d).groupBy((F.col("source") == 1).alias("first")).count().collect()
    n1, n2 = (sum(r["count"] for r in n if r["first"] is first) for first in (True, False))
    return _rounded(metrics.blocking_quality(_doc_pairs(s1, other), flat, n1, n2))


@query(
    "a14_micro_metrics",
    _doc(f"""{_ENTS} SELECT sum(n_true)::BIGINT AS true_pairs, sum(n_pred)::BIGINT AS predicted_pairs, sum(hits)::BIGINT AS hits,
  round(coalesce(sum(hits)::DOUBLE / nullif(sum(n_pred), 0), 1.0), 6) AS micro_precision, round(coalesce(sum(hits)::DOUBLE / nullif(sum(n_true), 0), 1.0), 6) AS micro_recall,
  count(*) FILTER (n_true = n_pred AND hits = n_true) AS exact_sets FROM en"""),
)
def a14(spark, d):
    return _rounded(metrics.micro(_entities(spark, d)))


@query(
    "j16_outcomes",
    _doc(f"""{_CLAIMED} SELECT coalesce(cl.sid, gt.sid) AS sid, coalesce(cl.cid, gt.cid) AS cid,
  CASE WHEN cl.sid IS NULL THEN 'FN' WHEN gt.sid IS NULL THEN 'FP' ELSE 'TP' END AS outcome FROM cl FULL JOIN gt ON cl.sid = gt.sid AND cl.cid = gt.cid"""),
)
def j16(spark, d):
    flat = X.doc_truth(X.doc_entities(spark, d)).select("sid", F.explode("trues").alias("cid"))
    return metrics.outcomes(resolve.claimed(_scored(spark, d)[2], 0.5), flat)


@query(
    "a17_threshold_tuning",
    _doc(f"""{_SCORED}, th AS (SELECT (i / 100.0)::DOUBLE AS threshold FROM range(30, 96) r(i)),
ow AS (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY score DESC, sid) AS r FROM sc),
hi AS (SELECT threshold, ow.sid, count(*) AS n_pred, count(gt.cid) AS hits FROM ow LEFT JOIN gt ON gt.sid = ow.sid AND gt.cid = ow.cid, th WHERE r = 1 AND score >= threshold GROUP BY ALL),
al AS (SELECT threshold, tru.sid, len(trues) AS n_true, coalesce(n_pred, 0) AS n_pred, coalesce(hits, 0) AS hits FROM th CROSS JOIN tru LEFT JOIN hi USING (threshold, sid)),
cv AS (SELECT threshold, round(avg({_F05}), 9) AS macro_f05 FROM al GROUP BY threshold)
SELECT threshold, round(macro_f05, 6) AS macro_f05 FROM cv ORDER BY cv.macro_f05 DESC, threshold LIMIT 1"""),
)
def a17(spark, d):
    return _rounded(metrics.tuned(_scored(spark, d)[2], X.doc_truth(X.doc_entities(spark, d))))


@query("l02_gbt_oof")
def l02(spark, d):
    """Out-of-fold scores of the boosted trees on the labelled candidates of the documents."""
    ent = X.doc_entities(spark, d)
    config = linkage.Config(passes=("exact", "first_word"), by_address=False, folds=3, rounds=12, unicode=False)
    scored = linkage.train(ent, X.doc_truth(ent), config)[3]
    return scored.select("sid", "cid", "label", "fold", F.round("score", 6).alias("score"))


@query(
    "x05_profile",
    _doc("""nm AS (SELECT len(trues) AS n_matches FROM tru), ow AS (SELECT cid, count(*) AS c FROM gt GROUP BY cid)
SELECT 'country' AS metric, 'S' || source || ':' || country AS key, count(*) AS n FROM rec GROUP BY ALL
UNION ALL SELECT 'rows', 'S' || source, count(*) FROM rec GROUP BY ALL
UNION ALL (SELECT 'matches', n_matches::VARCHAR, count(*) AS n FROM nm GROUP BY n_matches ORDER BY n DESC, n_matches LIMIT 10)
UNION ALL SELECT 'singletons', '', count(*) FILTER (n_matches = 0) FROM nm
UNION ALL SELECT 'shared', '', count(*) FILTER (c > 1) FROM ow"""),
)
def x05(spark, d):
    ent = X.doc_entities(spark, d)
    return profile.metric_rows(ent, X.doc_truth(ent).withColumn("n_matches", F.size("trues")))


_BAD = f"""{_CLAIMED},
cd AS (SELECT sid, list(DISTINCT cid) AS cids FROM un GROUP BY sid), ca AS (SELECT s1.entity_id AS sid, coalesce(cids, []) AS cids FROM s1 LEFT JOIN cd ON cd.sid = s1.entity_id),
ma AS (SELECT fin.sid, CASE WHEN ord % 7 = 0 THEN cids || [fin.sid] ELSE cids END AS cids FROM fin JOIN s1 ON entity_id = fin.sid WHERE ord % 5 <> 0
  UNION ALL SELECT fin.sid, cids FROM fin JOIN s1 ON entity_id = fin.sid WHERE ord % 11 = 0 AND ord % 5 <> 0 UNION ALL SELECT 'S1-x', ['S2-x']),
mp AS (SELECT DISTINCT sid, unnest(cids) AS cid FROM ma), cp AS (SELECT sid, unnest(cids) AS cid FROM ca)
SELECT 'candidates: expected entity without a row' AS issue, count(*) AS n FROM s1 WHERE entity_id NOT IN (SELECT sid FROM ca)
UNION ALL SELECT 'candidates: row of an unknown entity', count(*) FROM ca WHERE sid NOT IN (SELECT entity_id FROM s1)
UNION ALL SELECT 'candidates: repeated row', count(*) - count(DISTINCT sid) FROM ca
UNION ALL SELECT 'candidates: id of the first source in a list', count(*) FROM cp WHERE starts_with(cid, 'S1-')
UNION ALL SELECT 'candidates: id twice in a list', count(*) FROM ca WHERE len(cids) <> len(list_distinct(cids))
UNION ALL SELECT 'matches: expected entity without a row', count(*) FROM s1 WHERE entity_id NOT IN (SELECT sid FROM ma)
UNION ALL SELECT 'matches: row of an unknown entity', count(*) FROM ma WHERE sid NOT IN (SELECT entity_id FROM s1)
UNION ALL SELECT 'matches: repeated row', count(*) - count(DISTINCT sid) FROM ma
UNION ALL SELECT 'matches: id of the first source in a list', count(*) FROM (SELECT unnest(cids) AS cid FROM ma) WHERE starts_with(cid, 'S1-')
UNION ALL SELECT 'matches: id twice in a list', count(*) FROM ma WHERE len(cids) <> len(list_distinct(cids))
UNION ALL SELECT 'matches: id that isn''t a candidate', count(*) FROM mp ANTI JOIN cp USING (sid, cid)
UNION ALL SELECT 'matches: id with several owners', count(*) FROM (SELECT cid FROM mp GROUP BY cid HAVING count(*) > 1)"""


@query("x07_validate", _doc(_BAD))
def x07(spark, d):
    """The validator over outputs with planted faults: rows left out, repeated and foreign, own ids in lists."""
    s1, other, scored = _scored(spark, d)
    final = resolve.completed(s1, resolve.match_lists(resolve.claimed(scored, 0.5))).join(s1.select(F.col("entity_id").alias("sid"), "ord"), "sid")
    cand = resolve.completed(s1, blocking.listed(_doc_pairs(s1, other)))
    kept = final.where("ord % 5 <> 0")
    own = F.when(F.col("ord") % 7 == 0, F.concat("cids", F.array("sid"))).otherwise(F.col("cids"))
    foreign = spark.createDataFrame([("S1-x", ["S2-x"])], "sid string, cids array<string>")
    bad = kept.select("sid", own.alias("cids")).unionByName(kept.where("ord % 11 = 0").select("sid", "cids")).unionByName(foreign)
    return validate.issues(s1, cand, bad)


@query("x04_pipeline", _doc(f"{_CLAIMED} SELECT sid, array_to_string(cids, ',') AS cids FROM fin"))
def x04(spark, d):
    """The whole job on the documents' records: normalize, block, score by the rule, claim, complete."""
    config = linkage.Config(passes=("exact", "first_word"), by_address=False)
    return linkage.link(X.doc_entities(spark, d), config).select("sid", F.array_join("cids", ",").alias("cids"))


_EVERY_PAIR = f"""{EXACT}, {_capped_sql('ex', 'ex')}, {PHONETIC}, {_capped_sql('ph', 'ph')}, {FIRST_WORD}, {_capped_sql('fw', 'fw')}, {ADDRESS_KEYS}, {_capped_sql('ak', 'ak')},
{_TFIDF.strip()}, sm AS (SELECT a.entity_id AS sid, b.entity_id AS cid, round(sum(a.w * b.w), 9) AS sim FROM wt a JOIN wt b USING (gram) WHERE a.source = 1 AND b.source <> 1 GROUP BY ALL),
tk AS (SELECT sid, cid FROM (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY sim DESC, cid) AS rank FROM sm) WHERE rank <= 15),
un AS (SELECT sid, cid FROM ex_p UNION SELECT sid, cid FROM ph_p UNION SELECT sid, cid FROM fw_p UNION SELECT sid, cid FROM ak_p UNION FROM tk)"""


@query("x04_full_pipeline", _doc(_CLAIMED.replace(_DOC_PAIRS, _EVERY_PAIR) + " SELECT sid, array_to_string(cids, ',') AS cids FROM fin"))
def x04_full(spark, d):
    """The same with all passes, that of resembling character n-grams among them."""
    return linkage.link(X.doc_entities(spark, d), linkage.Config(tfidf_k=15)).select("sid", F.array_join("cids", ",").alias("cids"))

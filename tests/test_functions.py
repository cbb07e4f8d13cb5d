import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftlink.functions import keys, phonetic, translit
from weftlink.functions import similarity as S
from weftlink.functions.normalize import normalized


def one(spark, column, **values):
    names = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], names).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("word", "code"), [("Smith", "SNAT"), ("Johnson", "JANSAN"), ("Knight", "NAGT"), ("", ""), (None, ""), ("123", ""), ("MacDonald", "MCDANALD"), ("a", "A")])
def test_nysiis(spark, word, code):
    assert one(spark, phonetic.nysiis(F.col("w")), w=word) == code


def test_phonetic_key_splits_at_accents(spark):
    assert one(spark, phonetic.phonetic_key(F.col("w")), w="smith johnson") == "SNAT JANSAN"
    assert one(spark, phonetic.phonetic_key(F.col("w")), w=None) == ""


def records(spark, *rows):
    return normalized(spark.createDataFrame(rows, "entity_id string, name string, address string, country string")).collect()


def test_names(spark):
    rows = records(
        spark,
        ("1", "Foo Private Limited", "", "india"),
        ("2", "Foo Pvt. Ltd.", "", ""),
        ("3", "shop.co.in", "", ""),
        ("4", None, None, None),
        ("5", "Ｆｏｏ  Bar Inc.", "", ""),
    )
    assert [(r["core_name"], r["suffix"], r["normalized_name"]) for r in rows] == [
        ("foo", "pvt ltd", "foo"),
        ("foo", "pvt", "foo pvt ltd"),
        ("shop", None, "shop"),
        ("", None, ""),
        ("foo bar", "inc", "foo bar inc"),
    ]


def test_addresses(spark):
    (a, b) = records(spark, ("1", "", "12 MG Road near Metro, 560001", "India"), ("2", "", "Rue X 75001-1", "france"))
    assert (a["normalized_addr"], a["landmark"], a["postal_code"], a["country"]) == ("12 mg road", "near metro, 560001", "560001", "india")
    assert b["postal_code"] == "75001"


def test_marks_split_words_as_in_python(spark):
    (r,) = records(spark, ("1", "naïve-é ग्लोबल", "", ""))
    assert r["normalized_name"] == "naïve é ग ल बल"


def test_address_numbers(spark):
    assert one(spark, keys.address_numbers(F.col("a")), a="A-12/3 and 007, 5") == ["007", "123", "7", "a-12/3"]
    assert one(spark, keys.address_numbers(F.col("a")), a=None) == []


def test_address_keys(spark):
    found = one(spark, keys.address_keys(F.col("a"), F.col("p")), a="12 Baker street 560001", p="560001")
    assert found == ["post_560001", "560001_12", "560001_560001", "12_baker", "560001_baker"]


def test_first_word_and_acronym(spark):
    assert one(spark, keys.first_word(F.col("c")), c="dr acme labs") == "acme"
    assert one(spark, keys.first_word(F.col("c")), c="the labs") is None
    assert one(spark, keys.acronym(F.col("c")), c="acme big labs") == "abl"


def test_char_ngrams(spark):
    assert one(spark, keys.char_ngrams(F.col("c")), c="ab a") == [" ab", "ab ", " ab ", " a "]
    assert one(spark, keys.char_ngrams(F.col("c")), c="") == []


def test_latin(spark):
    assert one(spark, translit.latin(F.col("t")), t="Friend") == "friand"
    assert one(spark, translit.latin(F.col("t")), t="नम") == "nm"
    assert one(spark, translit.latin(F.col("t")), t=None) == ""


def naive_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@given(st.text("abc ", max_size=12), st.text("abc ", max_size=12))
def test_lcs(a, b):
    assert S.lcs(a, b) == naive_lcs(a, b)


@given(st.text("ab c", max_size=12), st.text("ab c", max_size=12))
def test_ratios_are_symmetric_and_bounded(a, b):
    for f in (S.token_sort, S.token_set, S.jaro_winkler):
        assert 0 <= f(a, b) <= 1 + 1e-12
        assert f(a, b) == pytest.approx(f(b, a))


def test_known_ratios():
    assert S.jaro_winkler("martha", "marhta") == pytest.approx(0.9611, abs=1e-4)
    assert S.token_set("new york mets", "new york mets vs atlanta braves") == 1.0
    assert S.token_sort("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == 1.0
    assert S.token_set("", "x") == 0.0


def test_jaccard_and_cosine(spark):
    df = spark.sql("select array('a','b') x, array('b','c') y, cast(array() as array<string>) z, array(1f, 0f) u, array(1f, 1f) v, array(0f, 0f) o")
    r = df.select(S.jaccard_of(F.col("x"), F.col("y")), S.jaccard_of(F.col("z"), F.col("z")), S.jaccard_of(F.col("x"), F.col("z")), S.cosine_of(F.col("u"), F.col("v")), S.cosine_of(F.col("u"), F.col("o"))).first()
    assert [round(v, 6) if v is not None else None for v in r] == [round(1 / 3, 6), 1.0, 0.0, round(0.5**0.5, 6), None]

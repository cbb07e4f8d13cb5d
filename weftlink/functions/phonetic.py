"""NYSIIS codes without a length limit, as a chain of regular expressions.

Rules look at the letters of the source, so what a rule has settled is written in lower case and letters
that vanish become an underscore; upper case comes back at the end."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rules in order. Prefix, ending, inside the word, clean-up.
RULES = [
    (r"^MAC", "MCC"),
    (r"^KN", "NN"),
    (r"^K", "C"),
    (r"^P[HF]", "FF"),
    (r"^SCH", "SSS"),
    (r"(?:EE|IE)$", "Y"),
    (r"(?:DT|RT|RD|NT|ND)$", "D"),
    (r"(?<!^)KN", "n"),
    (r"(?<!^)SCH", "s"),
    (r"(?<!^)PH", "f"),
    (r"(?<!^)(?:(?<![AEIOU])H|(?<=[AEIOU])H(?=[^AEIOU]))", "_"),
    (r"(?<=[AEIOU])W", "_"),
    (r"(?<!^)EV", "af"),
    (r"(?<!^)[AEIOU]", "a"),
    (r"(?<!^)Q", "g"),
    (r"(?<!^)Z", "s"),
    (r"(?<!^)M", "n"),
    (r"(?<!^)K", "c"),
]


def nysiis(word: Column) -> Column:
    code = F.regexp_replace(F.upper(F.coalesce(word, F.lit(""))), "[^A-Z]", "")
    for pattern, into in RULES:
        code = F.regexp_replace(code, pattern, into)
    code = F.regexp_replace(F.upper(F.replace(code, F.lit("_"), F.lit(""))), r"(.)\1+", "$1")
    code = F.regexp_replace(code, r"(?<=.)S$", "")
    code = F.regexp_replace(code, r"AY$", "Y")
    return F.regexp_replace(code, r"(?<=.)A$", "")


def codes(words: Column) -> Column:
    """Codes of the words of an array, empty ones too."""
    return F.transform(words, nysiis)


def phonetic_key(text: Column) -> Column:
    """Codes of the runs of Latin letters, joined by spaces."""
    return F.array_join(codes(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("[A-Za-z]+"), F.lit(0))), " ")

"""Keys that records are blocked by: house numbers, first words, acronyms, character n-grams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftlink.functions.normalize import squeezed, tokens

# Number tokens of an address; words that don't distinguish a place or a name; titles.
NUMBER = r"\b[a-zA-Z]?[-#]?\d+[/a-zA-Z\-_]*\d*[a-zA-Z]?\b"
PLACE_WORDS = ("near", "opp", "opposite", "behind", "floor", "road", "street", "lane", "plot", "flat", "unit", "building", "complex", "house", "phase")
NAME_WORDS = ("the", "and", "for", "with", "all", "new", "top", "pro", "best", "inc", "ltd", "pvt", "corp", "llc", "co")
TITLES = ("m/s", "dr", "mr", "ms", "sri", "shri")


def _zeros_off(text: Column) -> Column:
    return F.regexp_replace(text, "^0+", "")


def number_tokens(address: Column) -> Column:
    """Number tokens in the order of the text, of 2 characters or more."""
    raw = F.regexp_extract_all(F.lower(F.coalesce(address, F.lit(""))), F.lit(f"(?U){NUMBER}"), F.lit(0))
    return F.filter(F.transform(raw, lambda n: F.regexp_replace(n, "^[-# ]+|[-# ]+$", "")), lambda n: F.length(n) >= 2)


def address_numbers(address: Column, unpadded: bool = False) -> Column:
    """Number tokens, their digits, and these without leading zeros (which leaves '' of zeros alone), each
    once and sorted; with `unpadded` the tokens without leading zeros, too."""

    def forms(n: Column) -> Column:
        digits = F.regexp_replace(n, r"(?U)\D", "")
        long = F.when(F.length(digits) >= 2, F.array(digits, _zeros_off(digits))).otherwise(F.array())
        more = F.when(F.length(_zeros_off(n)) >= 2, F.array(_zeros_off(n))).otherwise(F.array()) if unpadded else F.array().cast("array<string>")
        return F.concat(F.array(n), long.cast("array<string>"), more.cast("array<string>"))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(number_tokens(address), forms))))


def address_keys(address: Column, postal: Column) -> Column:
    """The postal code; it with up to 3 numbers; up to 4 numbers with each word of the place. Numbers are
    taken in sorted order. Each key once."""
    numbers = address_numbers(address, unpadded=True)
    words = F.filter(tokens(squeezed(F.lower(F.coalesce(address, F.lit(""))))), lambda t: (F.length(t) >= 3) & ~t.rlike(r"^\p{Nd}+$") & ~t.isin(*PLACE_WORDS))
    none = F.array().cast("array<string>")
    by_code = F.concat(F.array(F.concat(F.lit("post_"), postal)), F.transform(F.slice(numbers, 1, 3), lambda n: F.concat_ws("_", postal, n)))
    by_place = F.flatten(F.transform(F.slice(numbers, 1, 4), lambda n: F.transform(words, lambda w: F.concat_ws("_", n, w))))
    return F.array_distinct(F.concat(F.when(F.length(F.coalesce(postal, F.lit(""))) >= 4, by_code).otherwise(none), by_place))


def first_word(core: Column) -> Column:
    """The first word that isn't a title, or null if it is short or says little."""
    word = F.get(F.filter(tokens(core), lambda t: ~t.isin(*TITLES)), F.lit(0))
    return F.when((F.length(word) >= 3) & ~word.isin(*NAME_WORDS), word)


def acronym(core: Column) -> Column:
    return F.array_join(F.transform(tokens(core), lambda w: F.substring(w, 1, 1)), "")


def gram_words(text: Column) -> Column:
    """The words of which char_ngrams takes the n-grams."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s+"), lambda w: w != "")


def char_ngrams(text: Column, low: int = 3, high: int = 5) -> Column:
    """n-grams of the words, each with a space on either side; words shorter than n give none."""
    words = F.transform(gram_words(text), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def grams(w: Column) -> Column:
        def sized(n: Column) -> Column:
            return F.transform(F.sequence(F.lit(1), F.length(w) - n + 1), lambda i: F.substring(w, i, n))

        return F.flatten(F.transform(F.sequence(F.lit(low), F.least(F.lit(high), F.length(w))), sized))

    return F.flatten(F.transform(words, grams))

"""Similarity of strings and token sets. Arrow kernels only for what Catalyst can't express: longest common
subsequences (bit-parallel, a few machine words for a name) and Jaro-Winkler."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence: one addition of long integers for each character of b."""
    at: dict[str, int] = {}
    for i, ch in enumerate(a):
        at[ch] = at.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        both = row & at.get(ch, 0)
        row = ((row + both) | (row - both)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """1 less the share of characters to insert or delete; 1 for two empty strings."""
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """The best ratio among the common tokens, and these with either side's own; 1 if one side has no own."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, own_x, own_y = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and not (own_x and own_y):
        return 1.0
    gap = len(both) + bool(both)
    sides = [gap + len(own_x), gap + len(own_y)]
    apart = len(own_x) + len(own_y) - 2 * lcs(own_x, own_y)
    found = [1 - apart / sum(sides)]
    if both:
        found += [1 - (n - len(both)) / (len(both) + n) for n in sides]
    return max(0.0, *found)


def jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, mine = [False] * len(b), []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == ch:
                used[j] = True
                mine.append(ch)
                break
    n = len(mine)
    if not n:
        return 0.0
    swaps = sum(x != y for x, y in zip(mine, (c for c, u in zip(b, used, strict=True) if u), strict=True)) // 2
    jaro = (n / len(a) + n / len(b) + (n - swaps) / n) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


def _kernel(f):
    @F.pandas_udf(T.DoubleType())
    def of(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([f(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="float64")

    return of


_jaro_winkler, _token_sort, _token_set = _kernel(jaro_winkler), _kernel(token_sort), _kernel(token_set)


def _unless_empty(a: Column, b: Column, value: Column) -> Column:
    return F.when((a == "") & (b == ""), F.lit(0.0)).otherwise(value)


def jaro_winkler_of(a: Column, b: Column) -> Column:
    return _unless_empty(a, b, _jaro_winkler(a, b))


def token_sort_of(a: Column, b: Column) -> Column:
    return _unless_empty(a, b, _token_sort(a, b))


def token_set_of(a: Column, b: Column) -> Column:
    return _unless_empty(a, b, _token_set(a, b))


def levenshtein_of(a: Column, b: Column) -> Column:
    """1 less the edits over the longer length; 0 for two empty strings."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, F.lit(0.0)).otherwise(1 - F.levenshtein(a, b) / F.greatest(longer, F.lit(1)))


def jaccard_of(x: Column, y: Column) -> Column:
    """Of two arrays as sets: 1 if both are empty."""
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(x, y)) / F.greatest(union, F.lit(1)))


def cosine_of(a: Column, b: Column) -> Column:
    """Of two arrays of numbers of the same length; null if one is all zeros."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda u, v: u.cast("double") * v.cast("double")), F.lit(0.0), lambda s, t: s + t)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))

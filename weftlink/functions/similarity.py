"""Similarities of strings and word sets, as columns; edit similarity as one vectorised function.

Conventions: Jaccard of two empty sets is 1, of one empty set 0; overlap with an empty set is 0.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def words(col: Column) -> Column:
    """Distinct words; none for ''."""
    return F.when(col == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.split(col, " ")))


def ngrams(col: Column, n: int) -> Column:
    """Distinct letter n-grams; a shorter string is its only gram, '' has none."""
    spans = F.transform(F.sequence(F.lit(1), F.length(col) - n + 1), lambda i: F.substring(col, i, n))
    return F.when(col == "", F.array().cast("array<string>")).when(F.length(col) < n, F.array(col)).otherwise(F.array_distinct(spans))


def numbers(col: Column) -> Column:
    """Distinct words of digits only."""
    return F.filter(words(col), lambda w: w.rlike("^[0-9]+$"))


def jaccard(a: Column, b: Column) -> Column:
    both, any_ = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(any_ == 0, F.lit(1.0)).otherwise(both / any_)


def overlap(a: Column, b: Column) -> Column:
    least = F.least(F.size(a), F.size(b))
    return F.when(least == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / least)


def sorted_words(col: Column) -> Column:
    """The words, repeats kept, in order and joined again."""
    return F.array_join(F.array_sort(F.filter(F.split(col, " "), lambda w: w != "")), " ")


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row at a time in the bits of one integer."""
    if a == b:
        return len(a)
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & at.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """2 * LCS / (len a + len b): 1 for two empty strings."""
    n = len(a) + len(b)
    return 2 * _lcs(a, b) / n if n else 1.0


def set_ratio(a: str, b: str) -> float:
    """Similarity of word sets: the best of intersection against either side, and of the two differences; 0 if a side is empty."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    common = " ".join(sorted(x & y))
    dx, dy = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if common and (not dx or not dy):
        return 1.0
    sect = len(common)
    lx, ly = sect + (sect > 0) + len(dx), sect + (sect > 0) + len(dy)
    distance = len(dx) + len(dy) - 2 * _lcs(dx, dy)
    best = 1 - distance / (lx + ly)
    if sect:
        best = max(best, 1 - (1 + len(dx)) / (sect + lx), 1 - (1 + len(dy)) / (sect + ly))
    return best


def _edit_scores(a: pd.Series, b: pd.Series, a_sorted: pd.Series, b_sorted: pd.Series) -> pd.DataFrame:
    """Indel ratio of two strings, of their sorted words, and the ratio of their word sets."""
    known: dict[tuple[str, str], tuple[float, float, float]] = {}
    out = []
    for x, y, p, q in zip(a, b, a_sorted, b_sorted):
        if (x, y) not in known:
            known[x, y] = (indel_ratio(x, y), indel_ratio(p, q), set_ratio(x, y))
        out.append(known[x, y])
    return pd.DataFrame(out, columns=["lev", "sort", "set"])


def edit_scores(a: Column, b: Column, a_sorted: Column, b_sorted: Column) -> Column:
    """struct(lev, sort, set) of two strings and their sorted words, in one Arrow crossing."""
    return F.pandas_udf(_edit_scores, "struct<lev:double,sort:double,set:double>")(a, b, a_sorted, b_sorted)

"""Column functions that normalise names and addresses. Missing is the empty string, never null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Abbreviations and what they stand for.
NAME_WORDS = {"pvt": "private", "ltd": "limited", "corp": "corporation", "co": "company", "inc": "incorporated"}
ADDRESS_WORDS = {"rd": "road", "st": "street", "ave": "avenue", "blvd": "boulevard", "apt": "apartment", "fl": "floor", "sec": "sector", "nr": "near"}
# Words that are no tokens.
STOPWORDS = ["private", "limited", "company", "corporation", "incorporated", "and", "the", "of", "pvt", "ltd", "co", "inc"]
# Accented letters and their plain ones, for the option that keeps such words whole.
ACCENTS = ("àâäáãåçéèêëíìîïñóòôöõúùûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")


def _norm(col: Column, words: dict[str, str], expand: bool, fold_accents: bool) -> Column:
    x = F.lower(F.trim(F.coalesce(col, F.lit(""))))
    if fold_accents:
        x = F.translate(x, *ACCENTS)
    x = F.trim(F.regexp_replace(x, "[^a-z0-9]+", " "))
    if expand:
        for short, full in words.items():
            x = F.regexp_replace(x, rf"\b{short}\b", full)
    return x


def name_norm(col: Column, expand: bool = True, fold_accents: bool = False) -> Column:
    """Lower case, anything but a-z and 0-9 to one space, abbreviations written out. ``expand=False`` leaves them."""
    return _norm(col, NAME_WORDS, expand, fold_accents)


def address_norm(col: Column, expand: bool = True, fold_accents: bool = False) -> Column:
    return _norm(col, ADDRESS_WORDS, expand, fold_accents)


def alnum(col: Column) -> Column:
    return F.regexp_replace(F.coalesce(col, F.lit("")), "[^a-z0-9]", "")


def postal(col: Column) -> Column:
    """The first run of five or six digits in the raw text, also inside a longer number; else ''."""
    return F.regexp_extract(F.coalesce(col, F.lit("")), "([0-9]{5,6})", 1)


def first(col: Column) -> Column:
    return F.split_part(col, F.lit(" "), F.lit(1))


def first2(col: Column) -> Column:
    """The first two words, or one if there is only one."""
    return F.array_join(F.slice(F.split(col, " "), 1, 2), " ")


def country_key(col: Column) -> Column:
    """Country as it is compared: '' equals ''."""
    return F.lower(F.trim(F.coalesce(col, F.lit(""))))


def md5_bucket(col: Column, buckets: int = 100) -> Column:
    """A bucket that any engine can compute: the first eight hex digits of the md5, modulo ``buckets``."""
    return F.pmod(F.conv(F.substring(F.md5(col), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")

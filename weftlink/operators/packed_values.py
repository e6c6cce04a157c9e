"""Several values packed in one string: one row for each value, with its position.

A parsing expression grammar with ordered alternatives, run over Arrow batches::

    list     <- (filler / item)* end
    item     <- absent / quoted / bracketed / bare
    quoted   <- '"' ('""' / !'"' .)* '"' &(filler / end)      the same with "'"
    absent   <- a word or sign for "no value" &(filler / end)
    bracketed <- open list close                              a pair of one kind, nested to any depth
    bare     <- [letters digits - :]+
    filler   <- any other character, and a bracket or quote that no alternative takes

An alternative that fails gives its input back. So a quote that is never closed, or whose
closing quote is followed at once by a value, is read again as filler and what follows it as
bare values; the values of such a list carry the flag ``quote``. A bracket that has no partner is filler too and gives the flag
``bracket``; its inside is read alike as a list and as what follows filler, so nothing is read twice: open brackets wait on a stack.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words and signs that stand for "no value", compared in lower case.
ABSENT = ["none", "null", "nil", "nan", "na", "n/a", "n.a.", "n.a", "no match", "no matches", "no-match", "nomatch", "not found", "not matched", "unmatched", "empty", "nothing", "-", "--", "---"]

_SPACE = re.compile(r"\s+")
_BARE = re.compile(r"[^\W_](?:[^\W_]|[-:])*|[-:]+(?:[^\W_]|[-:])*")
_ABSENT = re.compile("(?:" + "|".join(re.escape(w).replace(r"\ ", r"[\s_]+") for w in sorted(ABSENT, key=len, reverse=True)) + r")(?![^\W_]|[-:])", re.I)
_QUOTED = {q: re.compile(f"{q}((?:{q}{q}|[^{q}])*+){q}(?![^\\W_]|[-:])") for q in "\"'"}
_PAIRS = {")": "(", "]": "[", "}": "{", ">": "<"}


def _is_value(text: str) -> bool:
    return any(c.isalnum() for c in text) and _SPACE.sub(" ", text).strip().lower() not in ABSENT


def parse(text: str | None) -> list[tuple[str, str | None]]:
    """The values of one packed string in order, each with the list's error flags or None."""
    values: list[str] = []
    flags: set[str] = set()
    opened: list[str] = []
    closed_from = {q: -1 for q in _QUOTED}  # where the last try for a closing quote failed: no later try needs to look again
    i, n = 0, len(text or "")
    while i < n:
        c = text[i]
        if c in _QUOTED:
            m = None if 0 <= closed_from[c] <= i else _QUOTED[c].match(text, i)
            if m:
                value = m[1].replace(c + c, c).strip()
                if _is_value(value):
                    values.append(value)
                i = m.end()
                continue
            if text.find(c, i + 1) < 0:
                closed_from[c] = i
            flags.add("quote")
        elif m := _ABSENT.match(text, i):
            i = m.end()
            continue
        elif m := _BARE.match(text, i):
            if _is_value(m[0]):
                values.append(m[0])
            i = m.end()
            continue
        elif c in "([{<":
            opened.append(c)
        elif c in _PAIRS:
            if not opened or opened.pop() != _PAIRS[c]:
                flags.add("bracket")
        i += 1
    if opened:
        flags.add("bracket")
    flag = ",".join(sorted(flags)) or None
    return [(v, flag) for v in values]


_ITEM = pa.list_(pa.struct([("value", pa.string()), ("flag", pa.string())]))


def unpack(df: DataFrame, keys: list[str], packed: str, pos: str = "pos", value: str = "value", flag: str = "error") -> DataFrame:
    """Distinct rows (*keys, pos, value, error) of the values packed in ``packed``.

    ``pos`` counts from 1 over the values of a list. Null, empty and blank strings and strings
    of separators or "no value" words give no row; a value listed twice has two rows; rows that
    repeat the same list under the same key give it once, with the flag of either packing. Null keys are kept. Other columns are
    ignored, whatever their names. A list is parsed whole, however long.
    """
    schema = T.StructType([*(T.StructField(f"k{i}", df.schema[k].dataType) for i, k in enumerate(keys)), T.StructField("items", T.ArrayType(T.StructType([T.StructField("value", T.StringType()), T.StructField("flag", T.StringType())])))])
    names = [f"k{i}" for i in range(len(keys))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            items = [[{"value": v, "flag": f} for v, f in parse(x)] for x in b.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(items, _ITEM)], [*names, "items"])

    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(packed).cast("string").alias("p")).filter(F.length(F.trim("p")) > 0).distinct()
    return (
        rows.mapInArrow(run, schema)
        .select(*names, F.posexplode("items").alias("pos", "item"))
        .groupBy(*names, "pos", F.col("item.value").alias("v"))
        .agg(F.max("item.flag").alias("f"))
        .select(*[F.col(n).alias(k) for n, k in zip(names, keys)], (F.col("pos") + 1).alias(pos), F.col("v").alias(value), F.col("f").alias(flag))
    )

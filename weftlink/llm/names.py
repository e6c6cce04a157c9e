"""Weighted character n-gram vectors of names, and the sparse cosine similarity join over them."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from math import ceil, floor, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftlink.llm.records import fold
from weftlink.session import release, settle, swept

N = 3
#: Steps of the weights in the sparse join, and parts in which its candidates are compared.
STEPS, PARTS = 1 << 15, 2

# Abbreviations in names and the words they stand for.
FORMS = {
    "pvt": "private", "p": "private", "ltd": "limited", "co": "company", "inc": "incorporated", "corp": "corporation", "bros": "brothers",
    "intl": "international", "mfg": "manufacturing", "ind": "industries", "inds": "industries", "engg": "engineering", "eng": "engineering", "wks": "works", "strs": "stores",
    "med": "medical", "tex": "textiles", "furn": "furniture", "constr": "construction", "const": "construction", "pharma": "pharmaceuticals", "ctr": "centre", "center": "centre",
    "ptg": "printing", "assoc": "associates", "assocs": "associates", "cons": "consulting", "agcy": "agency", "insur": "insurance", "svcs": "services", "transp": "transport",
    "autos": "automobiles", "1st": "first",
}
_TOKEN = re.compile(r"[a-z0-9]+")
_DOTS = re.compile(r"\b((?:[a-z]\.){2,})")
_ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"
_CODE = {c: i for i, c in enumerate(_ALPHABET)}


def name_tokens(name: str | None) -> list[str]:
    s = fold(name or "").replace("m/s", " ").replace("’", "").replace("'", "")
    s = _DOTS.sub(lambda m: m[1].replace(".", "") + " ", s)
    return [FORMS.get(t, t) for t in _TOKEN.findall(s)]


def core(name: str | None) -> str:
    """The tokens run together: names of one core have one vector."""
    return "".join(name_tokens(name))


def grams(s: str) -> list[int]:
    """Codes of the letter n-grams of a core: below 36**3, so any table of them is bounded."""
    if len(s) < N:
        s = s.ljust(N, "0") if s else ""
    c = [_CODE[x] for x in s]
    return [(c[i] * 36 + c[i + 1]) * 36 + c[i + 2] for i in range(len(c) - 2)]


def mapped(df: DataFrame, col: str, out: str, kind: T.DataType, f: Callable) -> DataFrame:
    """``df`` with the column ``out``: ``f`` of each value of ``col``, over Arrow batches, each distinct value of a batch once."""
    names_ = [*df.columns, out]
    at = names_.index(col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            enc = b.column(at).dictionary_encode()
            made = pa.array([f(x) for x in enc.dictionary.to_pylist()] + [f(None)], arrow)
            where = enc.indices.fill_null(len(enc.dictionary))
            yield pa.RecordBatch.from_arrays([*b.columns, made.take(where)], names_)

    arrow = {T.StringType(): pa.string()}[kind]
    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, kind)]))


def cores(df: DataFrame, col: str, out: str = "core") -> DataFrame:
    return mapped(df, col, out, T.StringType(), core)


def frequencies(names: DataFrame, col: str = "core") -> dict[int, int]:
    """In how many distinct cores each n-gram occurs (at most 36**3 entries, by the size of the alphabet), and the number of cores at -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for x in b.column(0).to_pylist():
                total.update(set(grams(x)))
                total[-1] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(total.keys()), pa.int32()), pa.array(list(total.values()), pa.int64())], ["g", "n"])

    counted = names.select(F.col(col).alias("n")).filter("n IS NOT NULL").distinct().mapInArrow(run, "g int, n long")
    with swept(names.sparkSession):
        return {r[0]: r[1] for r in counted.groupBy("g").agg(F.sum("n").alias("n")).collect()}


def vector(s: str, df: dict[int, int]) -> dict[int, float]:
    """Unit vector of a core: damped tf times the log of the inverse name frequency."""
    tf = Counter(grams(s))
    total = df.get(-1, 1) + 1
    w = {g: (1 + log(k)) * log(total / df.get(g, 1)) + 1e-6 for g, k in tf.items()}
    norm = sqrt(sum(x * x for x in w.values())) or 1.0
    return {g: x / norm for g, x in w.items()}


class Vectors:
    """Vectors by core, made once as long as they are kept."""

    def __init__(self, df: dict[int, int], most: int = 50_000):
        self.df, self.most, self.known = df, most, {}

    def of(self, s: str) -> dict[int, float]:
        v = self.known.get(s)
        if v is None:
            if len(self.known) > self.most:
                self.known.clear()
            v = self.known[s] = vector(s, self.df)
        return v

    def cosine(self, a: str, b: str) -> float:
        u, v = self.of(a), self.of(b)
        if len(u) > len(v):
            u, v = v, u
        return sum(w * v[g] for g, w in u.items() if g in v)

    def cosines(self, names: list[str]) -> np.ndarray:
        """Cosines of all pairs of a bounded list."""
        n = len(names)
        if n <= 12:
            out = np.eye(n)
            for i in range(n):
                for j in range(i):
                    out[i, j] = out[j, i] = self.cosine(names[i], names[j])
            return out
        vs = [self.of(x) for x in names]
        at = {g: i for i, g in enumerate({g for v in vs for g in v})}
        m = np.zeros((n, len(at)))
        for i, v in enumerate(vs):
            m[i, [at[g] for g in v]] = list(v.values())
        return m @ m.T


def prefix(v: dict[int, float], df: dict[int, int], least: float) -> list[tuple[int, float, float]]:
    """(gram, weight, norm of the grams after it), rarest first, until the norm left is below ``least``.

    All names take their grams in one order, by frequency in all names. So the first gram two names share is in both prefixes
    if their cosine is ``least`` or more, and there weight * weight + norm * norm reaches ``least``: no other
    shared gram comes before it.
    """
    out, rest = [], 1.0
    for g, x in sorted(v.items(), key=lambda t: (df.get(t[0], 1), t[0])):
        if rest < least * least:
            break
        rest = max(0.0, rest - x * x)
        out.append((g, x, sqrt(rest)))
    return out


def keyed(df: DataFrame, freq, least: float) -> DataFrame:
    """(id, block, core) to (id, block, k, w, r): a row for each gram of the prefix. Weight and norm are rounded up to whole ``STEPS``, a few bytes in a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = freq.value
        vectors = Vectors(table, 1)
        for b in batches:
            keys = [prefix(vectors.of(x), table, least) for x in b.column(2).to_pylist()]
            take = pa.array([i for i, k in enumerate(keys) for _ in k], pa.int64())
            g = pa.array([x[0] for k in keys for x in k], pa.int32())
            w, r = (pa.array([ceil(x[i] * STEPS) for k in keys for x in k], pa.int64()) for i in (1, 2))
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), g, w, r], ["id", "block", "k", "w", "r"])

    return df.select("id", "block", "core").mapInArrow(run, "id long, block string, k int, w long, r long")


def similar(left: DataFrame, right: DataFrame, freq, least: float, once: bool = False) -> DataFrame:
    """(a, b, cos): all pairs of different (id, block, core) of one block with a cosine of ``least`` or more; with ``once`` only a < b.

    Exact: candidates share the first prefix gram they can share. Merge joins, so AQE splits the partition of a gram that very many names have.
    """
    x, y = keyed(left, freq, least).hint("merge").alias("x"), keyed(right, freq, least).alias("y")
    bound = F.col("x.w") * F.col("y.w") + F.col("x.r") * F.col("y.r") >= floor((least - 1e-9) * STEPS * STEPS)
    other = F.col("x.id") < F.col("y.id") if once else F.col("x.id") != F.col("y.id")
    on = (F.col("x.block") == F.col("y.block")) & (F.col("x.k") == F.col("y.k")) & other & bound
    met = settle(x.join(y, on).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct())
    of = [side.select(F.col("id").alias(c), F.col("core").alias(f"core_{c}")).distinct().hint("merge") for side, c in ((left, "a"), (right, "b"))]
    found = None
    for part in range(PARTS):  # one part of the candidates after the other, as they carry both names
        named = met.filter(F.pmod(F.xxhash64("a"), F.lit(PARTS)) == part).join(of[0], "a").join(of[1], "b")
        near = settle(cosines(named, freq).filter(F.col("cos") >= least).select("a", "b", "cos"))
        found = near if found is None else found.unionByName(near)
    release(met)
    return found


def cosines(pairs: DataFrame, freq) -> DataFrame:
    """``pairs`` (..., core_a, core_b) with ``cos``."""
    names_ = [*pairs.columns, "cos"]
    ia, ib = names_.index("core_a"), names_.index("core_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Vectors(freq.value)
        for b in batches:
            cos = [vectors.cosine(x, y) for x, y in zip(b.column(ia).to_pylist(), b.column(ib).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cos, pa.float64())], names_)

    return pairs.mapInArrow(run, T.StructType([*pairs.schema.fields, T.StructField("cos", T.DoubleType())]))

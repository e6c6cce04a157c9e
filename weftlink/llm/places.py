"""The place of every address: one house number in one street of one town, however it is written.

1. Addresses are cut into house number, postal code, words of street and town, side words (landmark, locality) and unit.
2. Inside each postal code, a deletion-neighbourhood index over the distinct words finds words that differ by one or
   two letters; the rarer spelling takes the form of the most frequent one near it. A word is a street word
   of its postal code if most of its uses stand at a street type.
3. An address without postal code gets the code whose words explain its words best (inverse code frequencies as
   weights), from the blocks of the neighbouring localities that share its rarest word. Where a code outside these could explain it
   as well, all its words propose, so the choice is the best of all codes. An address no code explains is compared with those of the same words.
4. The place of a record is (postal code, house number, street word). Within a code and a number, streets spelled too differently
   for the index are compared if they share the form of a side word: the components of the two spellings are assigned one to one with
   the greatest total similarity, and the rarer spelling takes the better-known one if that is high enough, along chains to their end.
   House number, postal code and a street that is unlike in the assignment are hard vetoes; unit numbers are one if ``units`` is
   set (not by default, as a place is a building).

Everything is counted over all records, and no group is collected. All joins are merge joins, so AQE can split a hot key. The distinct words
of a code, up to ``AT_ONCE`` of them, meet in one task, since their deletion variants would be many times the input in a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftlink.llm.records import address_parts
from weftlink.session import Scope, release, settle

#: Least similarity of two street spellings that share a side word, and of all their components in the best assignment.
NEAR = 0.6
#: Words of a code that meet in one task, and how many of them have their variants held at a time.
AT_ONCE, PART = 100_000, 10_000
#: What a street counts among the components, a side word counting 1.
STREET = 2.0

_PARTS = "id string, num string, postal string, words array<struct<w:string,adj:boolean>>, side array<string>"
_WORDS = pa.list_(pa.struct([("w", pa.string()), ("adj", pa.bool_())]))


def parts(df: DataFrame, key: str, address: str, units: bool = False) -> DataFrame:
    """(id, num, postal, words, side) of every row; ``units`` makes the unit part of the number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cut = [address_parts(x) for x in b.column(1).to_pylist()]
            if units:
                cut = [(f"{c[0]}/{c[5]}" if c[0] and c[5] else c[0], *c[1:]) for c in cut]
            words = [[{"w": w, "adj": a} for w, a in zip(c[2], c[3])] for c in cut]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c[0] for c in cut], pa.string()), pa.array([c[1] for c in cut], pa.string()), pa.array(words, _WORDS), pa.array([c[4] for c in cut], pa.list_(pa.string()))], ["id", "num", "postal", "words", "side"])

    return df.select(F.col(key).alias("id"), F.col(address).alias("a")).mapInArrow(run, _PARTS)


def deletions(word: str) -> set[str]:
    """The word with up to two letters left out (one in short words)."""
    n = len(word)
    out = {word} | {word[:i] + word[i + 1 :] for i in range(n)}
    if n >= 7:
        out |= {word[:i] + word[i + 1 : j] + word[j + 1 :] for i, j in combinations(range(n), 2)}
    return out


def with_deletions(df: DataFrame, word: str = "w") -> DataFrame:
    """``df`` with a row for each deletion variant ``v`` (a 64-bit hash) of the column ``word``."""
    import xxhash

    names = [*df.columns, "v"]
    at = names.index(word)
    schema = T.StructType([*df.schema.fields, T.StructField("v", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            variants = [[xxhash.xxh64_intdigest(v) - (1 << 63) for v in deletions(w)] for w in b.column(at).to_pylist()]
            take = pa.array([i for i, v in enumerate(variants) for _ in v], pa.int64())
            cols = [c.take(take) for c in b.columns]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([x for v in variants for x in v], pa.int64())], names)

    return df.mapInArrow(run, schema)


def _close(a, b):
    """Spellings of one word: distance one, or two in words of six letters and more; or a swap of two letters."""
    d = F.levenshtein(a, b, 2)
    long = F.least(F.length(a), F.length(b)) >= 6
    swap = (d == 2) & (F.length(a) == F.length(b)) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, "")))
    return (d >= 0) & ((d <= 1) | long | swap)


def vocabulary(p: DataFrame) -> DataFrame:
    """(postal, w, c, n, street): each word of a postal code, the form ``c`` it stands for, uses, and whether that is a street word."""
    main = p.filter("postal <> ''").select("postal", F.explode("words").alias("x")).select("postal", F.col("x.w").alias("w"), F.col("x.adj").cast("int").alias("adj"), F.lit(1).alias("is_main"))
    side = p.filter("postal <> ''").select("postal", F.explode("side").alias("w")).select("postal", "w", F.lit(0).alias("adj"), F.lit(0).alias("is_main"))
    words = settle(main.unionByName(side).groupBy("postal", "w").agg(F.count(F.lit(1)).alias("n"), F.sum("adj").alias("adj"), F.sum("is_main").alias("is_main")))
    everywhere = words.groupBy("w").agg(F.sum("n").alias("all")).hint("merge")
    near = _near_in_code(words.join(everywhere, "w").select("postal", "w", "n", "all")).filter(_close(F.col("w"), F.col("c")))
    best = near.groupBy("postal", "w").agg(F.max_by("c", F.struct("bn", "c")).alias("c")).hint("merge")
    forms = settle(words.join(best, ["postal", "w"], "left").withColumn("c", F.coalesce("c", "w")))
    # a form may itself stand for a better one: one more step
    up = forms.filter("c <> w").select("postal", F.col("w").alias("c"), F.col("c").alias("c2"))
    forms = forms.join(up, ["postal", "c"], "left").withColumn("c", F.coalesce("c2", "c")).drop("c2")
    role = forms.groupBy("postal", "c").agg((2 * F.sum("adj") >= F.sum("is_main")).alias("street"), F.sum("n").alias("cn"), (F.sum("is_main") > 0).alias("in_main")).hint("merge")
    return forms.join(role, ["postal", "c"]).select("postal", "w", "c", F.col("cn").alias("n"), (F.col("street") & F.col("in_main")).alias("street"))


def _better(a_n, a_all, a_w, a_length, b_n, b_all, b_w):
    """Of two near spellings, whether the first is the rarer one, both here and everywhere (a word that is common elsewhere is no slip); columns or values."""
    less = (b_n > a_n) | ((b_n == a_n) & (b_w < a_w))
    return ((b_all > 4 * a_all) | ((a_all <= 2 * a_n) & less & (a_length > 5))) & (b_n >= a_n)


def _near_in_code(words: DataFrame, most: int = AT_ONCE) -> DataFrame:
    """(postal, w, n, all) to (postal, w, c, bn): words and the better-known ones, used bn times, of their code that share a deletion variant.

    The variants are many times the words, so they aren't shuffled: the words of a code meet in one task, which holds a bounded
    part of their variants at a time. Codes of more than ``most`` words are left to a join over the variants.
    """
    out = ["postal", "w", "n", "all", "c", "bn"]

    def pairs(held: list[tuple]) -> Iterator[tuple]:
        if len(held) < 2:
            return
        parts = -(-len(held) // PART)
        for part in range(parts):
            first: dict[str, int] = {}
            more: dict[str, list[int]] = {}
            for i, r in enumerate(held):
                for v in deletions(r[1]):
                    if parts == 1 or hash(v) % parts == part:
                        k = first.setdefault(v, i)
                        if k != i:
                            more.setdefault(v, [k]).append(i)
            met = {(i, j) for group in more.values() for i in group for j in group if i != j}
            for i, j in met:
                (_, w, n, all_), (_, c, bn, ball) = held[i], held[j]
                if _better(n, all_, w, len(w), bn, ball, c):
                    yield held[i] + (c, bn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        made: list[tuple] = []
        at, over = None, False  # the code at hand, and whether it has more than ``most`` words

        def flush() -> pa.RecordBatch:
            cols = list(zip(*made)) or [()] * 6
            made.clear()
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], out)

        def close() -> Iterator[pa.RecordBatch]:
            for x in [r + (None, None) for r in held] if over else pairs(held):
                made.append(x)
                if len(made) >= 10_000:
                    yield flush()
            held.clear()

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if r[0] != at:
                    yield from close()
                    at, over = r[0], False
                held.append(r)
                if len(held) > most:
                    over = True
                    yield from close()
        yield from close()
        yield flush()

    met = settle(words.repartition("postal").sortWithinPartitions("postal", "w").mapInArrow(run, "postal string, w string, n long, all long, c string, bn long"))
    near = met.filter("c IS NOT NULL").select("postal", "w", "c", "bn")
    large = met.filter("c IS NULL").select("postal", "w", "n", "all")
    if large.isEmpty():
        return near
    v = settle(with_deletions(large))
    a, b = v.alias("a"), v.alias("b")
    better = _better(F.col("a.n"), F.col("a.all"), F.col("a.w"), F.length("a.w"), F.col("b.n"), F.col("b.all"), F.col("b.w"))
    joined = a.join(b, (F.col("a.postal") == F.col("b.postal")) & (F.col("a.v") == F.col("b.v")) & (F.col("a.w") != F.col("b.w")) & better)
    return near.unionByName(joined.select("a.postal", "a.w", F.col("b.w").alias("c"), F.col("b.n").alias("bn")))


def _near(p: DataFrame, vocab: DataFrame) -> DataFrame:
    """(w, c, off): the words of addresses without postal code and the known forms near each; every distinct word is indexed once."""
    own = p.filter("postal = ''").select(F.explode(F.concat(F.col("words.w"), F.col("side"))).alias("w")).distinct()
    a, b = with_deletions(own).hint("merge"), with_deletions(vocab.select("c").distinct(), "c")
    return a.join(b, "v").filter(_close(F.col("w"), F.col("c"))).select("w", "c", F.levenshtein("w", "c").alias("off")).distinct()


def _codes(p: DataFrame, vocab: DataFrame, near: DataFrame) -> DataFrame:
    """(id, code): the postal code of addresses without one, where their words tell it: the code of the greatest sum of word weights."""
    lacking = p.filter("postal = '' AND size(words) > 0")
    own = lacking.select("id", F.explode(F.array_distinct(F.concat(F.col("words.w"), F.col("side")))).alias("w"))
    forms = vocab.groupBy("postal", "c").agg(F.max("n").alias("n"))
    spread = forms.groupBy("c").agg(F.count(F.lit(1)).alias("df"))
    codes = F.lit(float(max(1, forms.select("postal").distinct().count())))
    index = settle(forms.join(spread.hint("merge"), "c").select("postal", "c", (F.log(codes / F.col("df")) + 0.1).alias("idf"), "df", "n"))
    weight = index.select("c", "idf", "df").distinct()
    meant = settle(own.join(near, "w").join(weight, "c").select("id", "w", "c", "df", (F.col("idf") - 0.05 * F.col("off")).alias("gain")))
    word = meant.groupBy("id", "w").agg(F.sum("df").alias("codes"), F.max("gain").alias("most"))
    # the word in fewest codes proposes; what the others could give to a code without it
    first = settle(word.groupBy("id").agg(F.min_by("w", F.struct("codes", "w")).alias("w"), (F.sum("most") - F.min_by("most", F.struct("codes", "w"))).alias("rest")))
    tried = settle(_scored(meant.join(first.select("id", "w"), ["id", "w"], "left_semi"), meant, index).join(first.select("id", "rest"), "id"))
    # another code may be as good: of the other words only those propose without which a code can't reach the best so far
    open_ = tried.filter("s <= rest").select("id", "s")
    common = Window.partitionBy("id").orderBy(F.desc("codes"), "w").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    needed = word.join(open_, "id").withColumn("sum", F.sum("most").over(common)).filter("sum >= s - 1e-5").select("id", "w")
    again = settle(meant.join(needed.withColumn("proposes", F.lit(True)).hint("merge"), ["id", "w"], "left").join(open_.select("id"), "id", "left_semi"))
    return tried.filter("s > rest").select("id", "code").unionByName(_scored(again.filter("proposes"), again.drop("proposes"), index).select("id", "code"))


def _scored(proposing: DataFrame, meant: DataFrame, index: DataFrame) -> DataFrame:
    """(id, code, s): the best of the codes that the rows ``proposing`` name, by the words of ``meant``."""
    proposed = proposing.join(index.select("postal", "c"), "c").select("id", "postal").distinct().hint("merge")
    hits = meant.join(proposed, "id").join(index.select("postal", "c", "n"), ["postal", "c"])
    each = hits.groupBy("id", "postal", "w").agg(F.max("gain").alias("s"), F.max("n").alias("n"))
    total = each.groupBy("id", "postal").agg(F.round(F.sum("s"), 6).alias("s"), F.sum("n").alias("n"))
    best = total.groupBy("id").agg(F.max(F.struct("s", "n", "postal")).alias("b"))
    return best.select("id", F.col("b.postal").alias("code"), F.col("b.s").alias("s"))


def places(df: DataFrame, key: str, address: str, units: bool = False) -> DataFrame:
    """(id, num, postal, street) of every row, '' where unknown; ``id`` is ``key``, which should be unique.

    A null or empty address, one without house number, and one whose street nothing tells have no place. ``postal`` is '?' and
    the words of the address where no known code explains it.
    """
    with Scope() as scope:
        p = settle(parts(df, key, address, units))
        vocab = settle(vocabulary(p))
        near = settle(_near(p, vocab))
        found = _codes(p, vocab, near).hint("merge")
        told = F.concat(F.lit("?"), F.array_join(F.array_sort(F.array_distinct(F.concat(F.col("words.w"), F.col("side")))), " "))
        code = F.when(F.col("postal") != "", F.col("postal")).otherwise(F.coalesce("code", F.when(F.size("words") > 0, told), F.lit("")))
        full = settle(p.join(found, "id", "left").withColumn("code", code))
        release(p)
        main = full.filter("code <> ''").select("id", "code", F.posexplode("words").alias("at", "x")).select("id", "code", "at", F.col("x.w").alias("w"), F.col("x.adj").alias("adj"))
        known = settle(main.join(vocab.withColumnRenamed("postal", "code"), ["code", "w"], "left"))
        # words of guessed codes may be new to the code: take the street near them
        fresh = known.filter("c IS NULL").select("id", "code", "at", "w", "adj").join(near, "w")
        streets_of = vocab.filter("street").select(F.col("postal").alias("code"), "c", "n").distinct().hint("merge")
        guessed = fresh.join(streets_of, ["code", "c"]).groupBy("id", "at", "adj").agg(F.max_by("c", F.struct("n", "c")).alias("c"), F.max("n").alias("n"))
        cols = ["id", "c", "adj", "n", "at"]
        streets = known.filter("street").select(*cols).unionByName(guessed.select(*cols)).unionByName(known.filter("c IS NULL AND adj").select("id", F.col("w").alias("c"), "adj", F.lit(0).cast("long").alias("n"), "at"))
        street = streets.groupBy("id").agg(F.max_by("c", F.struct("adj", "n", F.negative("at"))).alias("street")).hint("merge")
        out = settle(full.join(street, "id", "left").select("id", "num", F.col("code").alias("postal"), F.coalesce("street", F.lit("")).alias("street"), "side"))
        for done in (full, known):
            release(done)
        return scope.keep(_assign(out, vocab))


def assignment(score: list[list[float]]) -> tuple[float, list[int]]:
    """The one-to-one assignment of rows to columns of the greatest total, and the column of each row (-1: none); no pair counts below 0.

    Shortest augmenting paths with potentials, a row at a time.
    """
    n, m = len(score), len(score[0]) if score else 0
    if not n or not m:
        return 0.0, [-1] * n
    if n > m:
        total, back = assignment([list(c) for c in zip(*score)])
        out = [-1] * n
        for j, i in enumerate(back):
            if i >= 0:
                out[i] = j
        return total, out
    row_of = [-1] * m
    u, v = [0.0] * n, [0.0] * m
    for start in range(n):
        dist, via, done = [float("inf")] * m, [-1] * m, [False] * m
        i, at, low = start, -1, 0.0
        while True:
            for j in range(m):
                if not done[j]:
                    d = low - max(score[i][j], 0.0) - u[i] - v[j]
                    if d < dist[j] - 1e-12:
                        dist[j], via[j] = d, at
            nxt = min((j for j in range(m) if not done[j]), key=lambda j: dist[j])
            low, at = dist[nxt], nxt
            done[nxt] = True
            if row_of[nxt] < 0:
                break
            i = row_of[nxt]
        for j in range(m):
            if done[j] and j != at:
                u[row_of[j]] += low - dist[j]
                v[j] -= low - dist[j]
        u[start] += low
        while at >= 0:  # turn the path round
            before = via[at]
            row_of[at] = row_of[before] if before >= 0 else start
            at = before
    out = [-1] * n
    for j, i in enumerate(row_of):
        if i >= 0 and score[i][j] > 0:
            out[i] = j
    return sum(score[i][j] for i, j in enumerate(out) if j >= 0), out


def likeness(a: str, b: str) -> float:
    """1 less the edit distance over the longer length."""
    if a == b:
        return 1.0
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return 1 - row[-1] / max(len(a), len(b))


def agreement(street_a: str, side_a: list[str], street_b: str, side_b: list[str]) -> float:
    """Share of the components of the shorter spelling that the best assignment explains, 0 if the streets are unlike.

    A street counts ``STREET``, a side word 1; a street may be taken for a side word at half its likeness. An unknown street vetoes nothing.
    """
    if street_a and street_b and likeness(street_a, street_b) < NEAR:
        return 0.0
    a, b = ([(s, STREET)] * bool(s) + [(w, 1.0) for w in side] for s, side in ((street_a, side_a), (street_b, side_b)))
    total, _ = assignment([[likeness(x, y) * (min(p, q) if p == q else 0.5) for y, q in b] for x, p in a])
    least = min(sum(p for _, p in a), sum(q for _, q in b))
    return total / least if least else 0.0


def _agreeing(pairs: DataFrame) -> DataFrame:
    """``pairs`` (street, side, street_b, side_b, ...) with ``like``, their agreement."""
    names = [*pairs.columns, "like"]
    at = [names.index(c) for c in ("street", "side", "street_b", "side_b")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            like = [agreement(*x) for x in zip(*(b.column(i).to_pylist() for i in at))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(like, pa.float64())], names)

    return pairs.mapInArrow(run, T.StructType([*pairs.schema.fields, T.StructField("like", T.DoubleType())]))


def _assign(p: DataFrame, vocab: DataFrame) -> DataFrame:
    """Streets written too differently for the index, to a street of the same code and number that shares the form of a side word."""
    at = ["postal", "num", "street"]
    use = p.filter("num <> '' AND postal <> ''")
    labels = use.groupBy(*at).agg(F.count(F.lit(1)).alias("n"))
    forms = vocab.select("postal", F.col("w").alias("side_word"), F.col("c").alias("form")).hint("merge")
    sides = use.select(*at, F.explode("side").alias("side_word")).distinct().join(forms, ["postal", "side_word"], "left").select(*at, F.coalesce("form", "side_word").alias("w")).distinct()
    s = settle(sides.join(labels.hint("merge"), at))
    a, b = s.alias("a"), s.alias("b")
    more = (F.col("b.n") > F.col("a.n")) | ((F.col("b.n") == F.col("a.n")) & (F.col("b.street") < F.col("a.street")))
    # of streets that share no letter order worth a look, none is kept; an unknown street may be any
    hopeful = (F.col("a.street") == "") | (F.levenshtein("a.street", "b.street") <= (1 - NEAR) * F.greatest(F.length("a.street"), F.length("b.street")))
    on = (F.col("a.postal") == F.col("b.postal")) & (F.col("a.num") == F.col("b.num")) & (F.col("a.w") == F.col("b.w")) & (F.col("a.street") != F.col("b.street")) & more & (F.col("b.street") != "") & hopeful
    met = settle(a.join(b, on).select("a.postal", "a.num", "a.street", F.col("b.street").alias("street_b"), F.col("b.n").alias("bn")).distinct())
    # the side words of a spelling; only of those that met
    some = met.select(*at).union(met.select("postal", "num", "street_b")).distinct().hint("merge")
    words = s.join(some, at, "left_semi").groupBy(*at).agg(F.sort_array(F.collect_set("w")).alias("side")).hint("merge")
    pairs = met.join(words, at).join(words.toDF("postal", "num", "street_b", "side_b"), ["postal", "num", "street_b"])
    best = _agreeing(pairs).filter(F.col("like") >= NEAR).groupBy(*at).agg(F.max_by("street_b", F.struct("like", "bn", "street_b")).alias("to"))
    best = settle(best)
    while True:  # every spelling points to a better-known one, so chains end; each pass doubles the step
        up = best.select("postal", "num", F.col("street").alias("to"), F.col("to").alias("far"))
        longer = settle(best.join(up, ["postal", "num", "to"], "left").select(*at, F.coalesce("far", "to").alias("to"), F.col("far").isNotNull().alias("moved")))
        moved = not longer.filter("moved").isEmpty()
        best = longer.drop("moved")
        if not moved:
            return p.join(best.hint("merge"), at, "left").select("id", "num", "postal", F.coalesce("to", "street").alias("street"))

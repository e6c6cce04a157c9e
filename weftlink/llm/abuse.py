"""Scores of pages for abusive, hateful or sexual passages: boosted trees over dense features, isotonic calibration.

Words are split by Spark and read in Arrow batches; each distinct word of a batch is folded once (case, accents, misread
letters), and all else is array arithmetic over word codes. The features of a page are taken over its windows of
``WINDOW`` words, so that one short passage in a long page counts:

* lexicon densities: a fitted lexicon of words and word pairs, weighted by the log-odds of labelled pages that have them,
  and fixed lists of insults, threats, group abuse and sexual words;
* second-person words near insults; capitals; exclamation and masking signs; words with signs among their letters.

The lexicon, the trees and the calibration are fitted on at most ``MOST_LABELS`` labelled pages. A labelled page gets its training features
from a lexicon of the other folds. The calibration is cross-fitted: the pages of each fold are scored by trees of the other folds,
the isotonic curve is fitted on all these scores, and the trees that score the corpus are fitted on all labelled pages. Counting and scoring cover
all pages.

Nulls: a null, empty or blank text has no words and the lowest score. A null source is a source of its own. Repeated keys are scored row by row. Extra columns are ignored. Votes that tie leave the page
out of the fit. With fewer labelled pages of either class than folds nothing can be fitted, and every score is null.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftlink.session import Scope, settle

WINDOW, FOLDS = 12, 5
#: Labelled pages and lexicon entries a fit uses at most.
MOST_LABELS, MOST_ENTRIES = 50_000, 200_000

# Common words of insult, threat, contempt of groups and sex, and of address, in four languages.
LISTS = {
    "insult": """idiot idiots moron morons imbecile imbeciles cretin cretins scum bastard bastards asshole arsehole bitch bitches whore whores slut sluts swine pig pigs maggot maggots turd shit crap filth filthy
        stinking rotten worthless stupid dumb ugly pathetic liar wretch degenerate fool fools coward cowards loser trash garbage disgusting disgrace
        salaud salauds salope connard connards connasse abruti abrutie menteur menteuse sale pute putes putain ordure ordures cochon merde idiote imbeciles
        puta putas puto cabron cabrones pendejo mentiroso mentirosa cerdo cerda asqueroso asquerosa basura imbecil sucio sucia mierda tonto
        arschloch arsch schwein schweine dreckig dreckiges dreckiger verlogen hure huren schlampe schlampen miststuck schmutzig scheisse dumm trottel feigling""",
    "threat": """kill hang burn drown strangle shoot beat stab whip kick slap smash choke throat bones blood
        tuer pendre bruler noyer etrangler frapper battre
        matar ahorcar quemar golpear pegar estrangular
        toten umbringen erschlagen verbrennen schlagen aufhangen erwurgen ertranken""",
    "group": """vermin rats animals savages inferior race breed breeding tribe disease plague parasites subhuman
        vermine race betes sauvages parasites inferieure
        ratas raza animales salvajes parasitos plaga inferior
        ungeziefer gesindel rasse tiere ratten parasiten""",
    "sexual": """naked nude sex sexual breasts thighs fuck fucking cock cunt pussy tits penis vagina undressed obscene
        nue nues seins sexe baiser obscene obscenes
        desnuda desnudas desnudo desnudos sexo tetas follar obsceno
        nackt nackte nackter nackten ficken titten schwanz bruste""",
    "you": "you your yours yourself thou thee thy ye tu te toi ta ton tes vous votre vos usted ustedes ti du dich dir dein deine deinen euch ihr",
}
# Signs that stand for letters, in misread or masked words.
SIGNS = {"0": "o", "1": "i", "|": "i", "!": "i", "l": "i", "5": "s", "$": "s", "ſ": "s", "8": "b", "@": "a", "ı": "i", "œ": "oe", "ß": "ss", "c": "e", "'": "", "’": ""}
FEATURES = ["llr", "llr_words", "hits", "density", "insult", "threat", "group", "sexual", "listed", "you_near", "caps", "caps_all", "signs", "shouts", "length"]

_SPLIT = r"[\p{L}\p{M}\p{N}*@$|'’]+|!"
_TABLE = str.maketrans(SIGNS)
_MUL = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]


def canonical(word: str) -> str:
    """A word without case, accents and the commonest misreadings."""
    w = word.lower()
    if not w.isascii():
        w = "".join(c for c in unicodedata.normalize("NFKD", w) if not unicodedata.combining(c))
    return w.translate(_TABLE).replace("rn", "m").replace("vv", "w").replace("*", "")


_CLASS = {k: frozenset(canonical(w) for w in v.split()) for k, v in LISTS.items()}


def words(df: DataFrame, key: str, text: str, *more: str) -> DataFrame:
    """(key, w, *more): the words of each text in order, words broken at line ends joined."""
    joined = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[-\x{AD}\x{AC}\x{2013}\x{2014}][ \t]*\r?\n\s*", "")
    return df.select(F.col(key).cast("long").alias("key"), F.regexp_extract_all(joined, F.lit(_SPLIT), F.lit(0)).alias("w"), *more)


@dataclass
class Coded:
    lengths: np.ndarray
    codes: np.ndarray
    hashes: np.ndarray  # by code
    classes: dict[str, np.ndarray]  # by code, 0 or 1
    caps: np.ndarray
    signs: np.ndarray
    shout: np.ndarray


def _code(lists: pa.Array) -> Coded:
    import xxhash

    lengths = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    enc = lists.flatten().dictionary_encode()
    raw = enc.dictionary.to_pylist()
    folded = [canonical(w) for w in raw]
    n = len(raw)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in folded), np.uint64, n)
    classes = {k: np.fromiter((w in v for w in folded), np.float32, n) for k, v in _CLASS.items()}
    caps = np.fromiter((len(w) > 2 and w.isupper() for w in raw), np.float32, n)
    signs = np.fromiter((not w.isalnum() and len(w) > 1 and "'" not in w and "’" not in w for w in raw), np.float32, n)
    shout = np.fromiter((w == "!" for w in raw), np.float32, n)
    return Coded(lengths, enc.indices.to_numpy(zero_copy_only=False), hashes, classes, caps, signs, shout)


def _grams(c: Coded) -> list[np.ndarray]:
    """Hashes of each word, each word with its next and each word with its next but one; pairs that cross a page's end are left as they are counted alike everywhere."""
    h = c.hashes[c.codes]
    out = [h]
    with np.errstate(over="ignore"):
        for gap, m in zip((1, 2), _MUL):
            pair = h * m
            pair[:-gap] += h[gap:]
            out.append(pair)
    return out


class Lexicon:
    """Log-odds by hash, with a bitmap in front of the search."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.weights = hashes[order], weights[order].astype(np.float32)
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.hashes & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def of(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), np.float32)
        if len(self.hashes):
            at = np.flatnonzero(self.bits[(h & np.uint64((1 << 22) - 1)).astype(np.int64)])
            k = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
            found = self.hashes[k] == h[at]
            out[at[found]] = self.weights[k[found]]
        return out


def features(c: Coded, lexicon: Lexicon) -> np.ndarray:
    """A row of FEATURES for each page."""
    n, m = len(c.lengths), len(c.codes)
    out = np.zeros((n, len(FEATURES)), np.float32)
    full = np.flatnonzero(c.lengths)
    if not m:
        return out
    ends = np.cumsum(c.lengths)
    starts = (ends - c.lengths)[full]
    stop = np.minimum(np.arange(m) + WINDOW, np.repeat(ends, c.lengths))

    def window(x: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(x, dtype=np.float64)])
        return (total[stop] - total[:-1]).astype(np.float32)

    most = lambda x: np.maximum.reduceat(x, starts)
    add = lambda x: np.add.reduceat(x, starts)
    single, pair, skip = (lexicon.of(h) for h in _grams(c))
    both = single + pair + skip
    long = np.maximum(c.lengths[full], 1)
    cls = {k: v[c.codes] for k, v in c.classes.items()}
    listed = {k: window(cls[k]) for k in ("insult", "threat", "group", "sexual")}
    caps = c.caps[c.codes]
    cols = [
        most(window(both)), most(window(single)), most(window((both > 1).astype(np.float32))), add(np.maximum(both, 0)) / long,
        *(most(listed[k]) for k in ("insult", "threat", "group", "sexual")), most(sum(listed.values())), most(np.minimum(window(cls["you"]), 2) * listed["insult"]),
        most(window(caps)), add(caps) / long, add(c.signs[c.codes]) / long, add(c.shout[c.codes]) / long, np.log1p(long),
    ]
    out[full] = np.stack(cols, 1)
    return out


def _featured(lexicons) -> object:
    """Batches (key, w, which) to (key, x): features with the lexicon of the given number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = [Lexicon(*x) for x in lexicons.value]
        for b in batches:
            which = b.column(2).to_numpy(zero_copy_only=False)
            for k in np.unique(which):
                part = b.filter(pa.array(which == k))
                x = features(_code(part.column(1)), made[k])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel(), pa.float32()), len(FEATURES)).cast(pa.list_(pa.float32()))], ["key", "x"])

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, w, y, fold) to (hash, fold, pos, neg): pages of either class with a word or pair."""
    for b in batches:
        if not b.num_rows:
            continue
        c = _code(b.column(1))
        page = np.repeat(np.arange(b.num_rows), c.lengths)
        y, fold = b.column(2).to_numpy(zero_copy_only=False), b.column(3).to_numpy(zero_copy_only=False)
        for h in _grams(c):
            seen = np.unique(np.stack([page.astype(np.uint64), h]), axis=1) if len(h) else np.zeros((2, 0), np.uint64)
            at = seen[0].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(seen[1].view(np.int64)), pa.array(fold[at], pa.int32()), pa.array(y[at], pa.int32()), pa.array(1 - y[at], pa.int32())], ["h", "fold", "pos", "neg"])


def _weights(pos: np.ndarray, neg: np.ndarray, n_pos: float, n_neg: float) -> np.ndarray:
    """Clipped log-odds of a page that has the entry, against the base rate."""
    prior = n_pos / max(n_pos + n_neg, 1)
    odds = np.log((pos + 2 * prior) / (neg + 2 * (1 - prior))) - np.log(max(n_pos, 1) / max(n_neg, 1))
    sure = (pos >= 2) & (odds > 0.9) | (pos + neg >= 12) & (odds < -0.9)
    return np.where(sure, np.clip(odds, -2, 3), 0)


def fit_lexicons(labelled: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """Lexicons without fold 0, 1, ... and, last, of all folds, from (key, w, y, fold)."""
    sums = [F.sum(F.when(F.col("fold") == f, F.col(c)).otherwise(0)).alias(f"{c}{f}") for c in ("pos", "neg") for f in range(FOLDS)]
    entries = labelled.mapInArrow(_counted, "h long, fold int, pos int, neg int").groupBy("h").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"), *sums)
    totals = {(r["fold"], r["y"]): r["count"] for r in labelled.groupBy("fold", "y").count().collect()}
    n_pos, n_neg = (np.array([totals.get((f, y), 0) for f in range(FOLDS)], float) for y in (1, 0))
    base = n_pos.sum() / max(n_neg.sum(), 1)
    # telling entries only, at most MOST_ENTRIES
    telling = entries.filter(((F.col("p") >= 2) & (F.col("p") > 2 * base * F.col("n"))) | ((F.col("p") + F.col("n") >= 12) & (F.col("p") < 0.5 * base * F.col("n"))))
    rows = telling.orderBy(F.desc(F.col("p") + F.col("n") * base), "h").limit(MOST_ENTRIES).toPandas()
    h = rows["h"].to_numpy(np.int64).view(np.uint64)
    pos, neg = (rows[[f"{c}{f}" for f in range(FOLDS)]].to_numpy(float).reshape(-1, FOLDS) for c in ("pos", "neg"))
    out = []
    for f in [*range(FOLDS), None]:
        keep = [k for k in range(FOLDS) if k != f]
        w = _weights(pos[:, keep].sum(1), neg[:, keep].sum(1), n_pos[keep].sum(), n_neg[keep].sum())
        out.append((h[w != 0], w[w != 0]))
    return out


def scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", vote: str = "abusive") -> DataFrame:
    """(key, score): the calibrated probability that a page has an abusive passage."""
    spark = docs.sparkSession
    votes = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("key")).agg(F.avg(F.col(vote)).alias("m")).filter("m <> 0.5")
    votes = votes.withColumn("r", F.xxhash64("key")).orderBy("r", "key").limit(MOST_LABELS).select("key", (F.col("m") > 0.5).cast("int").alias("y"), "r")
    plain = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t"))
    every = words(plain, "id", "t")
    with Scope() as scope:
        # at most MOST_LABELS rows, so the side with labels is broadcast
        known = plain.join(F.broadcast(votes), plain["id"] == votes["key"]).select("id", "t", "y", "r")
        # folds hold equal shares of each class
        fold = (F.row_number().over(Window.partitionBy("y").orderBy("r", "key")) % FOLDS).alias("fold")
        labelled = settle(words(known, "id", "t", "y", "r").dropDuplicates(["key"]).select("key", "w", "y", fold))
        by_class = {r["y"]: r["count"] for r in labelled.groupBy("y").count().collect()}
        if min(by_class.get(0, 0), by_class.get(1, 0)) < FOLDS:
            return scope.keep(plain.select(F.col("id").alias(key), F.lit(None).cast("double").alias("score")))
        lexicons = spark.sparkContext.broadcast(fit_lexicons(labelled))
        shape = "key long, x array<float>"
        rows = labelled.select("key", "w", F.col("fold").alias("which")).mapInArrow(_featured(lexicons), shape).join(labelled.select("key", "y", "fold"), "key")
        rows = settle(rows.select("x", F.col("y").cast("double").alias("y"), "fold").coalesce(1))  # at most MOST_LABELS rows
        rows = rows.select(array_to_vector("x").alias("features"), "y", "fold")
        raw = vector_to_array("rawPrediction")[1].alias("raw")
        grow = lambda df: GBTClassifier(labelCol="y", maxIter=20, maxDepth=3, stepSize=0.2, minInstancesPerNode=3, seed=42).fit(df)

        def held(f: int) -> DataFrame:
            return settle(grow(rows.filter(F.col("fold") != f)).transform(rows.filter(F.col("fold") == f)).select(raw, "y"))

        with ThreadPoolExecutor(FOLDS + 1) as pool:  # small jobs of one task each, side by side
            trees = pool.submit(grow, rows)
            unseen = reduce(DataFrame.unionByName, pool.map(held, range(FOLDS)))
            trees = trees.result()
        curve = IsotonicRegression(labelCol="y", featuresCol="raw").fit(unseen)
        x = every.select("key", "w", F.lit(FOLDS).alias("which")).mapInArrow(_featured(lexicons), shape)
        scored = curve.transform(trees.transform(x.select("key", array_to_vector("x").alias("features"))).select("key", raw))
        return scope.keep(scored.select(F.col("key").alias(key), F.round("prediction", 6).alias("score")))


def rates(scored: DataFrame, docs: DataFrame, key: str = "doc_id", source: str = "source", least: float = 0.5) -> DataFrame:
    """(source, pages, abusive, rate) of every source."""
    by = docs.select(key, source).join(scored.select(key, "score"), key).groupBy(source)
    return by.agg(F.count(F.lit(1)).alias("pages"), F.sum((F.col("score") >= least).cast("long")).alias("abusive")).withColumn("rate", F.round(F.col("abusive") / F.col("pages"), 6))

"""Labels, training sample, classifier, metrics and outputs."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftlink.operators.features import FEATURES

# Weights of the hard-negative score; sample weights; thresholds 0.30 to 0.98.
HARD = {"name_exact": 100, "addr_exact": 90, "postal_match": 80, "name_token_sort": 30, "addr_token_sort": 20}
WEIGHT_NEAR, WEIGHT_MINED, NEAR_SORT, MINED_FROM = 3.0, 5.0, 0.75, 0.5
GRID = [t / 100 for t in range(30, 99, 2)]


def label(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """``pairs`` with ``label`` 1 where the pair is in ``truth`` (s1_id, other_id), else 0."""
    known = truth.select("s1_id", "other_id").distinct().withColumn("hit", F.lit(1))
    return pairs.join(known, ["s1_id", "other_id"], "left").withColumn("label", F.coalesce("hit", F.lit(0))).drop("hit")


def hard_score(weights: dict[str, int] = HARD):
    return reduce(lambda a, b: a + b, [F.col(c) * float(w) for c, w in weights.items()])


def hard_negatives(labelled: DataFrame, per_entity: int = 6, weights: dict[str, int] = HARD) -> DataFrame:
    """The negatives of each entity that look most like matches; ties by other_id."""
    w = Window.partitionBy("s1_id").orderBy(F.desc("hard"), "other_id")
    return labelled.filter("label = 0").withColumn("hard", F.round(hard_score(weights), 6)).withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= per_entity).drop("rn")


def train_sample(labelled: DataFrame, per_entity: int = 6, most: int = 1_500_000, weights: dict[str, int] = HARD) -> DataFrame:
    """All positives and the hard negatives, each pair once, at most ``most`` rows, chosen by md5 of the pair.

    The bound is the documented size of the training sample; everything else works on all rows.
    """
    rows = labelled.filter("label = 1").withColumn("hard", F.round(hard_score(weights), 6)).unionByName(hard_negatives(labelled, per_entity, weights))
    return rows.dropDuplicates(["s1_id", "other_id"]).orderBy(F.md5(F.concat_ws("|", "s1_id", "other_id")), "s1_id", "other_id").limit(most)


def mined(scored: DataFrame, least: float = MINED_FROM) -> DataFrame:
    """(s1_id, other_id) of negatives that a model takes for matches."""
    return scored.filter((F.col("label") == 0) & (F.col("proba") >= least)).select("s1_id", "other_id")


def sample_weights(rows: DataFrame, mined_pairs: DataFrame | None = None, near: str = "name_token_sort") -> DataFrame:
    """``rows`` with ``weight``: 1, near negatives 3, mined negatives 5."""
    hit = F.lit(None)
    if mined_pairs is not None:
        rows = rows.join(mined_pairs.select("s1_id", "other_id").distinct().withColumn("mined", F.lit(1)), ["s1_id", "other_id"], "left")
        hit = F.col("mined")
    weight = F.when(hit.isNotNull(), WEIGHT_MINED).when((F.col("label") == 0) & (F.col(near) >= NEAR_SORT), WEIGHT_NEAR).otherwise(1.0)
    return rows.withColumn("weight", weight).drop("mined")


def fit(sample: DataFrame, trees: int = 300, depth: int = 7, step: float = 0.05, features: list[str] = FEATURES, held: int = 10) -> PipelineModel:
    """Boosted trees with classes balanced by weight, at most ``trees``: growth ends when the loss on one entity in ``held`` falls no more. Raises if a class is missing."""
    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if not n.get(0) or not n.get(1):
        raise ValueError("no training rows of one class")
    balance = F.when(F.col("label") == 1, n[0] / n[1]).otherwise(1.0)
    weighted = sample.withColumn("w", balance * (F.col("weight") if "weight" in sample.columns else F.lit(1.0))).withColumn("y", F.col("label").cast("double"))
    weighted = weighted.withColumn("held", F.pmod(F.xxhash64("s1_id"), F.lit(held)) == 0)
    gbt = GBTClassifier(
        featuresCol="x", labelCol="y", weightCol="w", maxIter=trees, maxDepth=depth, stepSize=step, subsamplingRate=0.85, featureSubsetStrategy="0.9", minInstancesPerNode=3, seed=42,
        validationIndicatorCol="held", validationTol=0.01, cacheNodeIds=True, checkpointInterval=-1,
    )
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="x"), gbt]).fit(weighted)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(s1_id, other_id, source, proba)."""
    return model.transform(rows).select("s1_id", "other_id", "source", vector_to_array("probability")[1].alias("proba"))


def plain_score(rows: DataFrame) -> DataFrame:
    """A score without a model, from exact and set similarities: what thresholds can be checked on in any engine."""
    total = 100 * F.col("name_exact") + 90 * F.col("addr_exact") + 80 * F.col("postal_match") + 30 * F.col("name_jaccard") + 20 * F.col("addr_jaccard")
    return rows.select("s1_id", "other_id", "source", F.round(total / 320, 6).alias("proba"))


def recall(candidates: DataFrame, truth: DataFrame, others: DataFrame) -> DataFrame:
    """(part, hits, total, recall) for S2, S3, ids in no source (UNK) and all; 0 where there is nothing to find."""
    known = others.select(F.col("entity_id").alias("other_id"), "source").distinct()
    t = truth.select("s1_id", "other_id").distinct().join(known, "other_id", "left").withColumn("source", F.coalesce("source", F.lit("UNK")))
    hit = candidates.select("s1_id", "other_id").distinct().withColumn("hit", F.lit(1))
    rows = t.join(hit, ["s1_id", "other_id"], "left").select(F.explode(F.array("source", F.lit("ALL"))).alias("part"), F.coalesce("hit", F.lit(0)).alias("hit"))
    out = rows.groupBy("part").agg(F.sum("hit").alias("hits"), F.count(F.lit(1)).alias("total"))
    return out.withColumn("recall", F.round(F.when(F.col("total") > 0, F.col("hits") / F.col("total")).otherwise(0.0), 9))


def _f05(tp, n_pred, n_true):
    precision, rec = tp / n_pred, tp / n_true
    value = 1.25 * precision * rec / (0.25 * precision + rec)
    return F.when((n_true == 0) & (n_pred == 0), 1.0).when((n_true == 0) | (n_pred == 0) | (tp == 0), 0.0).otherwise(value)


def f05_by_entity(ids: DataFrame, truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """(s1_id, n_true, n_pred, tp, f05) of every id in ``ids`` (s1_id), also those without truth or prediction."""
    n_true = truth.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n_true"))
    marked = label(predicted.select("s1_id", "other_id").distinct(), truth)
    n_pred = marked.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n_pred"), F.sum("label").alias("tp"))
    rows = ids.select("s1_id").distinct().join(n_true, "s1_id", "left").join(n_pred, "s1_id", "left").na.fill(0, ["n_true", "n_pred", "tp"])
    return rows.withColumn("f05", F.round(_f05(F.col("tp"), F.col("n_pred"), F.col("n_true")), 9))


def threshold_curve(ids: DataFrame, truth: DataFrame, scored: DataFrame, grid: list[float] = GRID) -> DataFrame:
    """(threshold, macro_f05) for the whole grid in one pass over the scores.

    Pairs are counted by entity and the largest threshold they reach, and each count is passed on to the thresholds below.
    Entities without any pair at a threshold stay in the average: they have 1 there if they have no truth, else 0.
    """
    steps = F.array(*[F.lit(t) for t in grid])
    reached = F.size(F.filter(steps, lambda t: F.col("proba") >= t))
    every = ids.select("s1_id").distinct()
    n_true = truth.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n_true"))
    # each pair once; the aggregate also keeps the score's expression from being copied into every comparison
    pairs = scored.join(every, "s1_id", "left_semi").groupBy("s1_id", "other_id").agg(F.max("proba").alias("proba"))
    per = label(pairs, truth).withColumn("k", reached).filter("k > 0").groupBy("s1_id", "k").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("tp"))
    below = per.select("s1_id", F.explode(F.sequence(F.lit(1), "k")).alias("t"), "n", "tp").groupBy("s1_id", "t").agg(F.sum("n").alias("n"), F.sum("tp").alias("tp"))
    at = below.join(n_true, "s1_id", "left").withColumn("n_true", F.coalesce("n_true", F.lit(0)))
    sums = at.groupBy("t").agg(F.sum(_f05(F.col("tp"), F.col("n"), F.col("n_true"))).alias("f"), F.count_if(F.col("n_true") == 0).alias("lost"))
    base = every.join(n_true, "s1_id", "left").agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("n_true").isNull()).alias("empty"))
    points = base.select("all", "empty", F.explode(F.sequence(F.lit(1), F.lit(len(grid)))).alias("t")).join(F.broadcast(sums), "t", "left")  # a row a threshold
    macro = (F.coalesce("f", F.lit(0.0)) + F.col("empty") - F.coalesce("lost", F.lit(0))) / F.col("all")
    return points.select(F.element_at(steps, F.col("t")).alias("threshold"), F.round(macro, 9).alias("macro_f05"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """The threshold of the highest macro F0.5, the lowest of equal ones."""
    return curve.orderBy(F.desc("macro_f05"), "threshold").limit(1)


def listed(ids: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """One row an id: its distinct other ids in order, joined by commas, '' if it has none."""
    each = pairs.groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_set("other_id")), ",").alias("x"))
    return ids.select("s1_id").distinct().join(each, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce("x", F.lit("")).alias(column))


def output_checks(results: DataFrame, ids: DataFrame, predicted: DataFrame, candidate_pairs: DataFrame) -> DataFrame:
    """(check, bad): entities missing from the results, repeated in them, unknown, and predictions that are no candidates."""
    r, i = results.select(F.col("source1_entity_id").alias("s1_id")), ids.select("s1_id").distinct()
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("bad")).select(F.lit(name).alias("check"), "bad")
    return reduce(
        DataFrame.unionByName,
        [
            count(i.join(r, "s1_id", "left_anti"), "missing"),
            count(r.groupBy("s1_id").count().filter("count > 1"), "repeated"),
            count(r.join(i, "s1_id", "left_anti"), "unknown"),
            count(predicted.select("s1_id", "other_id").distinct().join(candidate_pairs.select("s1_id", "other_id"), ["s1_id", "other_id"], "left_anti"), "not_candidates"),
        ],
    )

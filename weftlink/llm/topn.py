"""The N highest-scoring items of every group, by descending score bands.

Groups of at most N items are taken whole. The rows are written once, split by score band (band edges are quantiles of the score, so
bands hold similar numbers of rows), and the bands are read from the top, one at a time, each joined with the groups that are
still open, which leaves out those already filled. A group whose items in the band stay within its need takes them all; in its
boundary band, where they don't, its items are ranked exactly, ties by the item. The loop ends as soon as no group is open, so a
few top bands decide most groups, and the files of the others are not read. Ranking keeps at most N rows a group and task before its shuffle,
hence a group of millions of items never meets in one task.

Nulls: a null score ranks below all others (it has the last band), a null item after all items of its score,
a null group is a group. Repeated rows are items of their own unless ``fold_pairs`` folds them before. Extra
columns are ignored. Fewer than N items: all of them. An empty table: an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftlink.operators.blocking import consolidate, strength
from weftlink.session import Scope, settle


def fold_pairs(df: DataFrame) -> DataFrame:
    """One row for each (s1_id, source, other_id) with its score: flags OR-ed (null is unset), rows without other_id left out."""
    return consolidate(df).select("s1_id", "source", "other_id", strength().alias("score"))


def top_n(df: DataFrame, group: list[str], item: str, score: str, n: int, bands: int = 8) -> DataFrame:
    """Rows (*group, item, score, rank) with rank 1..n by descending score, equal scores by ascending item."""
    names = [f"g{i}" for i in range(len(group))]
    same = lambda a, b: reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in names])
    order = Window.partitionBy(*names).orderBy(F.desc_nulls_last("s"), F.asc_nulls_last("i"))
    count = F.count(F.lit(1)).alias("c")
    with Scope() as scope:
        rows = settle(df.select(*[F.col(g).alias(k) for g, k in zip(group, names)], F.col(item).alias("i"), F.col(score).alias("s")))
        sizes = settle(rows.groupBy(*names).agg(count))
        small, open_ = sizes.filter(F.col("c") <= n), sizes.filter(F.col("c") > n).select(*names, F.lit(n).cast("long").alias("need"))
        taken = [rows.join(small, same(rows, small), "left_semi")]
        large = rows.join(open_, same(rows, open_), "left_semi")
        kind = rows.schema["s"].dataType
        edges = large.agg(F.percentile_approx("s", [k / bands for k in range(1, bands)], 1000).alias("q")).first()["q"] or []  # bands - 1 numbers
        edges = sorted(set(edges))
        # band 0 is the top; a null score goes below the lowest
        at_least = [F.when(F.col("s") >= F.lit(e).cast(kind), 1).otherwise(0) for e in edges]
        band = F.when(F.col("s").isNull(), len(edges) + 1).otherwise(F.lit(len(edges)) - reduce(lambda a, b: a + b, at_least, F.lit(0)))
        stored = settle(large.withColumn("band", band.cast("int")), "band")
        for b in range(len(edges) + 2):
            if open_.isEmpty():
                break
            band_rows = stored.filter(F.col("band") == b).drop("band")
            here = band_rows.join(open_, same(band_rows, open_)).select(*[band_rows[k] for k in names], "i", "s", "need")
            seen = settle(here.groupBy(*names, "need").agg(count))
            whole, edge = seen.filter("c <= need"), seen.filter("c > need")
            taken.append(band_rows.join(whole, same(band_rows, whole), "left_semi"))
            last = here.join(edge.drop("need"), same(here, edge), "left_semi").withColumn("rank", F.row_number().over(order))
            taken.append(settle(last.filter(F.col("rank") <= n).filter("rank <= need").select(*names, "i", "s")))
            left = open_.join(seen.drop("need"), same(open_, seen), "left").select(*[open_[k] for k in names], (F.col("need") - F.coalesce("c", F.lit(0))).alias("need"))
            open_ = settle(left.filter("need > 0"))
        found = reduce(DataFrame.unionByName, taken).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)  # at most n rows a group
        return scope.keep(found.select(*[F.col(k).alias(g) for k, g in zip(names, group)], F.col("i").alias(item), F.col("s").alias(score), "rank"))

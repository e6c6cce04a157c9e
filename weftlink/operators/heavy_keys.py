"""Per-key results and joins where a few keys hold most rows.

Fragment-replicate by estimated load. The load of every key comes from a map-side combined
count. A key above a fraction of one task's fair share is *heavy*: there are at most
``SPLIT * tasks`` of those, so their list is bounded by the number of tasks, never by the data.
A heavy key is cut into shards in proportion to its load, all other keys fall into a fixed
number of hash buckets, and shards and buckets are packed onto tasks, largest first. In a join
the matching side is copied to the shards of its own key and nowhere else.

Nulls: a null key is a key of its own (it can be heavy too); a null entity counts as a row
and not as an entity. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftlink.session import task_count

#: A key is heavy above 1/SPLIT of a task's fair share; light keys share SPLIT buckets a task.
SPLIT = 8


@dataclass
class Placement:
    """Where keys go: ``heavy`` maps a key tuple to the tasks of its shards, ``buckets`` a hash bucket to its task."""

    tasks: int
    heavy: dict[tuple, list[int]]
    buckets: list[int]


def _alias(keys: list[str]) -> list[str]:
    return [f"k{i}" for i in range(len(keys))]


def _bucket(names: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in names]), F.lit(n)).cast("int")


def pack(loads: list[tuple[float, object]], tasks: int) -> dict[object, int]:
    """Longest-processing-time packing: each item to the task with least load so far; ties by task number."""
    heap = [(0.0, t) for t in range(tasks)]
    where = {}
    for load, item in sorted(loads, key=lambda x: (-x[0], str(x[1]))):
        at, t = heapq.heappop(heap)
        where[item] = t
        heapq.heappush(heap, (at + load, t))
    return where


def place(rows: DataFrame, names: list[str], tasks: int) -> Placement:
    """Loads by key, then shards and buckets packed onto ``tasks`` tasks. ``rows`` has the key columns ``names``."""
    n_buckets = SPLIT * tasks
    total = rows.count()
    if not total:
        return Placement(tasks, {}, [i % tasks for i in range(n_buckets)])
    share = total / tasks
    freq = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    is_heavy = F.col("n") > share / SPLIT
    # fewer than SPLIT * tasks keys are heavy and there are SPLIT * tasks buckets: what is collected is bounded by the cluster
    sums = (
        freq.select(F.when(is_heavy, F.struct(*names)).alias("h"), F.when(~is_heavy, _bucket(names, n_buckets)).alias("b"), "n")
        .groupBy("h", "b")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    heavy = [(tuple(r["h"]), r["n"]) for r in sums if r["h"] is not None]
    known = {r["b"]: r["n"] for r in sums if r["h"] is None}
    loads: list[tuple[float, object]] = []
    for key, n in heavy:
        parts = ceil(n / share)
        loads += [(n / parts, (key, i, parts)) for i in range(parts)]
    loads += [(known.get(b, 0), b) for b in range(n_buckets)]
    where = pack(loads, tasks)
    shards: dict[tuple, list[int]] = {}
    for item, t in where.items():
        if isinstance(item, tuple):
            shards.setdefault(item[0], [0] * item[2])[item[1]] = t
    return Placement(tasks, shards, [where[b] for b in range(n_buckets)])


def _shards(spark: SparkSession, p: Placement, names: list[str], types: list[T.DataType]) -> DataFrame:
    schema = T.StructType([*(T.StructField(f"h_{n}", t) for n, t in zip(names, types)), T.StructField("h_tasks", T.ArrayType(T.IntegerType()))])
    return spark.createDataFrame([(*k, t) for k, t in p.heavy.items()], schema)


def _placed(rows: DataFrame, names: list[str], p: Placement) -> DataFrame:
    """``rows`` with ``h_tasks`` (null for light keys) and ``h_home``, the task of the light key's bucket."""
    heavy = _shards(rows.sparkSession, p, names, [rows.schema[n].dataType for n in names])
    same = [F.col(n).eqNullSafe(F.col(f"h_{n}")) for n in names]
    on = same[0]
    for c in same[1:]:
        on = on & c
    home = F.element_at(F.lit(p.buckets), _bucket(names, len(p.buckets)) + 1)
    # fewer than SPLIT * tasks rows: bounded by the cluster, so always broadcast
    return rows.join(F.broadcast(heavy), on, "left").drop(*[f"h_{n}" for n in names]).withColumn("h_home", home)


def key_stats(df: DataFrame, keys: list[str], entity: str, tasks: int | None = None) -> DataFrame:
    """Rows and distinct entities of every key, without a task that does most of the work.

    Gives the key columns, ``n_rows``, ``n_entities`` (nulls aside) and ``n_shards``. Shards of a
    key split its entities, so their distinct counts add up exactly.
    """
    tasks = tasks or task_count(df.sparkSession)
    names = _alias(keys)
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(entity).alias("e"))
    p = place(rows, names, tasks)
    shard = F.when(F.col("h_tasks").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("e"), F.size("h_tasks")).cast("int"))
    at = (
        _placed(rows, names, p)
        .withColumn("shard", shard)
        .withColumn("task", F.coalesce(F.element_at("h_tasks", F.col("shard") + 1), F.col("h_home")))
        .select("task", *names, "shard", "e")
        .repartitionById(tasks, F.col("task"))
    )
    group = ["task", *names, "shard"]
    return (
        at.groupBy(*group, "e")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*group)
        .agg(F.sum("n").alias("n"), F.count("e").alias("d"))
        .groupBy(*names)
        .agg(F.sum("n").alias("n_rows"), F.sum("d").alias("n_entities"), F.count(F.lit(1)).alias("n_shards"))
        .select(*[F.col(n).alias(k) for n, k in zip(names, keys)], "n_rows", "n_entities", "n_shards")
    )


def fragment_replicate_join(facts: DataFrame, matching: DataFrame, keys: list[str], spread: str, tasks: int | None = None) -> DataFrame:
    """Inner join on ``keys`` (null keys meet nothing) for facts with a few very frequent keys.

    The facts of a heavy key are spread over its shards by ``spread`` (any column of ``facts``);
    the matching rows of that key are copied to those shards only. Other columns of ``matching``
    keep their names, a clash with a column of ``facts`` gets the suffix ``_r``.
    """
    tasks = tasks or task_count(facts.sparkSession)
    names = _alias(keys)
    left = facts.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.struct(*facts.columns).alias("l"))
    others = [c for c in matching.columns if c not in keys]
    right = matching.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.struct(*[F.col(c) for c in others] or [F.lit(1).alias("x")]).alias("r"))
    for n in names:
        left, right = left.filter(F.col(n).isNotNull()), right.filter(F.col(n).isNotNull())
    p = place(left, names, tasks)
    shard = F.when(F.col("h_tasks").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(F.col(f"l.{spread}")), F.size("h_tasks")).cast("int"))
    a = _placed(left, names, p).withColumn("shard", shard).withColumn("task", F.coalesce(F.element_at("h_tasks", F.col("shard") + 1), F.col("h_home")))
    b = _placed(right, names, p).select("*", F.posexplode(F.coalesce("h_tasks", F.array("h_home"))).alias("shard", "task"))
    on = ["task", *names, "shard"]
    a = a.select(*on, "l").repartitionById(tasks, F.col("task"))
    b = b.select(*on, "r").repartitionById(tasks, F.col("task"))
    taken = set(facts.columns)
    return a.join(b, on).select("l.*", *[F.col(f"r.{c}").alias(f"{c}_r" if c in taken else c) for c in others])

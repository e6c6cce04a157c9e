from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftlink.operators import heavy_keys as hk


def rows():
    out = [("hot", f"e{i % 400}") for i in range(1000)] + [(None, f"n{i}") for i in range(300)] + [("", "a"), ("", "a"), ("x", None), ("x", "b")]
    return out + [(f"k{i % 50}", f"e{i}") for i in range(200)]


def test_key_stats_counts_nulls_repeats_and_hot_keys(spark):
    data = rows()
    df = spark.createDataFrame(data, "key string, e string").withColumn("n_rows", F.lit(1)).withColumn("task", F.lit("x"))
    got = {r["key"]: (r["n_rows"], r["n_entities"]) for r in hk.key_stats(df, ["key"], "e", 6).collect()}
    n = Counter(k for k, _ in data)
    assert got == {k: (n[k], len({e for q, e in data if q == k and e is not None})) for k in n}


def test_hot_keys_are_split_in_proportion(spark):
    got = {r["key"]: r["n_shards"] for r in hk.key_stats(spark.createDataFrame(rows(), "key string, e string"), ["key"], "e", 6).collect()}
    assert got["hot"] == 4 and got[None] == 2 and got["k1"] == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "key string, e string")
    assert hk.key_stats(df, ["key"], "e", 4).collect() == []
    assert hk.fragment_replicate_join(df, df, ["key"], "e", 4).collect() == []


def test_packing_is_even():
    loads = [(float(x % 7 + 1), x) for x in range(100)]
    where = hk.pack(loads, 5)
    per = Counter()
    for load, item in loads:
        per[where[item]] += load
    assert max(per.values()) - min(per.values()) <= 1


@pytest.mark.parametrize("tasks", [1, 7])
def test_join_equals_plain_join(spark, tasks):
    facts = spark.createDataFrame(rows(), "key string, e string")
    dim = spark.createDataFrame([("hot", 1, "u"), ("hot", 2, "v"), ("x", 3, "w"), (None, 4, "z"), ("none", 5, "q")], "key string, v int, e string")
    got = sorted(map(tuple, hk.fragment_replicate_join(facts, dim, ["key"], "e", tasks).select("key", "e", "v", "e_r").collect()), key=str)
    plain = facts.alias("f").join(dim.alias("d"), F.col("f.key") == F.col("d.key")).select("f.key", "f.e", "d.v", "d.e")
    assert got == sorted(map(tuple, plain.collect()), key=str)

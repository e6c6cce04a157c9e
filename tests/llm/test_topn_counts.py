import random
from collections import Counter, defaultdict

import oracle
import pytest
from conftest import SMALL

from weftlink.llm import topn, value_counts
from weftlink.llm.queries import ORACLE, QUERIES
from weftlink.operators.blocking import FLAGS


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, con, name):
    assert oracle.differences(spark, con, QUERIES[name], ORACLE[name], SMALL) == ""


def best(rows, n):
    groups = defaultdict(list)
    for g, i, s in rows:
        groups[g].append((s is None, -(s or 0), i is None, i or "", i, s))
    return sorted(((g, x[4], x[5]) for g, v in groups.items() for x in sorted(v)[:n]), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_top_n_is_a_plain_sort(spark, seed):
    r = random.Random(seed)
    rows = [(r.choice(["a", "b", "c", "hot", "hot", "hot", None, ""]), r.choice([f"i{r.randrange(40)}", None]), r.choice([None, *range(r.choice([3, 50]))])) for _ in range(300)]
    df = spark.createDataFrame(rows, "g string, i string, s int").selectExpr("*", "1 AS band", "2 AS rank", "3 AS g0", "4 AS have")
    got = topn.top_n(df, ["g"], "i", "s", 5, bands=1 + seed * 2)
    assert sorted(map(tuple, got.select("g", "i", "s").collect()), key=str) == best(rows, 5)
    ranks = got.groupBy("g").agg({"rank": "max", "*": "count"}).collect()
    assert all(x["max(rank)"] == x["count(1)"] for x in ranks)


def test_top_n_of_nothing(spark):
    df = spark.createDataFrame([], "g string, i string, s int")
    assert topn.top_n(df, ["g"], "i", "s", 5).collect() == []
    nulls = spark.createDataFrame([("a", "x", None)], "g string, i string, s int")
    assert [tuple(r) for r in topn.top_n(nulls, ["g"], "i", "s", 5).collect()] == [("a", "x", None, 1)]


def test_fold_pairs_ors_flags(spark):
    cols = "s1_id string, other_id string, source string, " + ", ".join(f"{c} int" for c in FLAGS)
    rows = [("s", "o", "S2", 1, None, 0, 0, 0, 0, 0, 0), ("s", "o", "S2", 0, 1, None, 0, 0, 0, 0, 0), ("s", None, "S2", 1, 1, 1, 1, 1, 1, 1, 1)]
    assert [tuple(r) for r in topn.fold_pairs(spark.createDataFrame(rows, cols)).collect()] == [("s", "S2", "o", 100 + 95 + 20)]


def test_value_counts_are_plain_counts(spark):
    r = random.Random(1)
    rows = [(r.choice([None, "", "the", "the", f"w{r.randrange(9000)}", "x" * 5000]), r.choice([None, f"r{r.randrange(300)}"])) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "v string, r string").selectExpr("*", "1 AS id", "2 AS value", "3 AS n_rows")
    got = {x["value"]: (x["n_rows"], x["n_records"]) for x in value_counts.value_counts(df, "v", "r").collect()}
    n = Counter(v for v, _ in rows if v is not None)
    records = defaultdict(set)
    for v, k in rows:
        if k is not None:
            records[v].add(k)
    assert got == {v: (c, len(records[v])) for v, c in n.items()}


def test_many_ranges_of_scattered_ids(spark):
    r = random.Random(2)
    rows = [(f"w{r.randrange(6000):05}", f"r{r.randrange(50)}") for _ in range(15_000)] + [("w00007", f"r{i}") for i in range(5000)]
    df = spark.createDataFrame(rows, "v string, r string")
    got = {x["value"]: (x["n_rows"], x["n_records"]) for x in value_counts.value_counts(df, "v", "r", width=2).collect()}  # about 2,800 ranges
    n, records = Counter(v for v, _ in rows), defaultdict(set)
    for v, k in rows:
        records[v].add(k)
    assert got == {v: (c, len(records[v])) for v, c in n.items()}


def test_a_range_leaves_one_batch_of_sums():
    import numpy as np
    import pyarrow as pa

    ids = np.random.default_rng(1).integers(0, 5000 * 4, 20_000)
    ids.sort()
    batches = [pa.record_batch([pa.array(x // 4), pa.array(x), pa.array(np.ones(len(x), np.int64)), pa.array(np.ones(len(x), np.int64))], names=list("abcd")) for x in np.array_split(ids, 7)]
    out = list(value_counts._summed(4)(iter(batches)))
    assert len(out) == len(np.unique(ids // 4)) and sum(b.num_rows for b in out) == len(np.unique(ids))
    assert sum(sum(b.column(1).to_pylist()) for b in out) == 20_000


def test_dictionary_is_dense_and_ordered(spark):
    df = spark.createDataFrame([(f"w{i % 700}",) for i in range(3000)] + [(None,)], "v string")
    rows = sorted(map(tuple, value_counts.dictionary(df, "v").collect()))
    assert [i for i, _ in rows] == list(range(700)) and [v for _, v in rows] == sorted(v for _, v in rows)
    assert value_counts.value_counts(df.limit(0).selectExpr("v", "v AS r"), "v", "r").collect() == []

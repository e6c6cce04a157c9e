import random
from dataclasses import replace

import pytest

from weftlink.operators import blocking, entities, matching


def pairs(spark, rows, cols="s1_id string, other_id string"):
    return spark.createDataFrame(rows, cols)


@pytest.mark.parametrize("true,pred,expected", [("", "", 1.0), ("", "a", 0.0), ("ab", "", 0.0), ("ab", "a", 0.833333333), ("a", "ab", 0.555555556), ("a", "b", 0.0), ("ab", "ab", 1.0)])
def test_f05(spark, true, pred, expected):
    ids = pairs(spark, [("s",)], "s1_id string")
    got = matching.f05_by_entity(ids, pairs(spark, [("s", c) for c in true]), pairs(spark, [("s", c) for c in pred])).first()
    assert got["f05"] == expected


def test_threshold_curve_is_the_direct_scan(spark):
    ids = pairs(spark, [(f"s{i}",) for i in range(6)], "s1_id string")
    truth = pairs(spark, [("s0", "a"), ("s1", "b"), ("s1", "c"), ("s2", "d")])
    scored = pairs(spark, [("s0", "a", 0.58), ("s0", "x", 0.9), ("s1", "b", 0.3), ("s1", "c", 0.98), ("s3", "y", 0.44), ("s4", "z", 0.1)], "s1_id string, other_id string, proba double")
    curve = {r[0]: r[1] for r in matching.threshold_curve(ids, truth, scored).collect()}
    assert len(curve) == 35
    for t in (0.3, 0.44, 0.58, 0.6, 0.98):
        each = [r["f05"] for r in matching.f05_by_entity(ids, truth, scored.filter(f"proba >= {t}D")).collect()]
        assert curve[t] == pytest.approx(sum(each) / 6, abs=1e-8)


def test_first_of_equal_thresholds(spark):
    assert matching.best_threshold(pairs(spark, [(0.5, 0.9), (0.4, 0.9), (0.3, 0.1)], "threshold double, macro_f05 double")).first()["threshold"] == 0.4


def test_listed_and_checks(spark):
    ids = pairs(spark, [("a",), ("b",), ("b",)], "s1_id string")
    got = matching.listed(ids, pairs(spark, [("a", "y"), ("a", "x"), ("a", "x")]), "m")
    assert sorted(map(tuple, got.collect())) == [("a", "x,y"), ("b", "")]
    bad = matching.output_checks(pairs(spark, [("a",), ("a",), ("c",)], "source1_entity_id string"), ids, pairs(spark, [("a", "x"), ("a", "q")]), pairs(spark, [("a", "x")]))
    assert {r[0]: r[1] for r in bad.collect()} == {"missing": 1, "repeated": 1, "unknown": 1, "not_candidates": 1}


def test_fit_needs_both_classes(spark):
    with pytest.raises(ValueError):
        matching.fit(pairs(spark, [("a", 1, 0.0)], "s1_id string, label int, f double"), features=["f"])


def test_splits_are_disjoint(spark):
    s1 = pairs(spark, [(f"S1-{i}",) for i in range(500)] * 2, "entity_id string")
    w = entities.workset(s1, 200, 50)
    assert w.groupBy("split").count().count() == 2 and w.select("entity_id").distinct().count() == w.count() == 200
    e = entities.entity_split(s1)
    assert e.count() == 500 and e.filter("split = 'val'").count() == 100


def entity(spark, rows):
    return spark.createDataFrame([(i, i[:2], c, n, "", "", n, "") for i, n, c in rows], "entity_id string, source string, ckey string, name_norm string, addr_norm string, postal string, name_first2 string, addr_first2 string")


def test_posting_cap_counts_other_countries(spark):
    s1, o = entity(spark, [("S1-1", "acme", "us")]), entity(spark, [("S2-1", "acme", "us"), ("S2-2", "acme", "in"), ("S3-1", "acme", "us")])
    config = blocking.BlockConfig(posting={"exact_name": 1})
    assert [r["other_id"] for r in blocking.key_block(s1, o, "exact_name", config).collect()] == ["S3-1"]


def test_repeated_tokens_count_each_time(spark):
    s1, o = entity(spark, [("S1-1", "zeta zeta", "")]), entity(spark, [("S2-1", "zeta", "")])
    assert blocking.token_block(s1, o, "name_token").count() == 1
    assert blocking.token_block(s1, o, "name_token", blocking.BlockConfig(distinct_tokens=True)).count() == 0


def test_caps_hold(spark):
    s1, o = entity(spark, [("S1-1", "acme", "")]), entity(spark, [(f"S{2 + i % 2}-{i:03}", "acme", "") for i in range(120)])
    c = blocking.candidates(s1, o, blocking.BlockConfig(final=30))
    assert {r["source"]: r["count"] for r in c.groupBy("source").count().collect()} == {"S2": 30, "S3": 30}
    assert blocking.key_block(s1, o, "exact_name").count() == 80
    assert blocking.candidates(s1.limit(0), o).count() == 0


def test_flag_ranking_equals_all_pairs_without_joining_them(spark, monkeypatch):
    """Blocks without caps: the same rows as over all pairs, from a join that grows with the entities and not with their pairs."""
    rnd = random.Random(5)
    pick = lambda a, n: f"{a}{rnd.randrange(n)}"
    rows = []
    for k in range(240):
        name, address = f"{pick('name', 3)} {pick('word', 4)} {pick('last', 40)}", f"{pick('street', 3)} {pick('town', 5)} {k // 2}" if k % 9 else ""
        rows.append((f"S{k % 3 + 1}-{k:04d}", f"S{k % 3 + 1}", rnd.choice(["us", "us", "in"]), name, address, rnd.choice(["", "10000", "10000", "10000", "20000"]), " ".join(name.split()[:2]), ""))
    every = spark.createDataFrame(rows, "entity_id string, source string, ckey string, name_norm string, addr_norm string, postal string, name_first2 string, addr_first2 string")
    s1, others = every.filter("source = 'S1'"), every.filter("source <> 'S1'")
    for config in (replace(blocking.TEST_AS_WRITTEN, token_share=0.3, final=4), replace(blocking.TEST_AS_WRITTEN, token_share=0.3, final=4, country=False, extended=False)):
        full = blocking.bounded(blocking.consolidate(blocking.raw_blocks(s1, others, config)), config)
        assert full.exceptAll(blocking.candidates(s1, others, config)).isEmpty() and blocking.candidates(s1, others, config).count() == full.count() > 300
    joined, join = [], blocking.fragment_replicate_join
    monkeypatch.setattr(blocking, "fragment_replicate_join", lambda *a, **k: joined.append(join(*a, **k)) or joined[-1])
    blocking.candidates(s1, others, replace(blocking.TEST_AS_WRITTEN, token_share=0.3, final=1, extended=False)).count()
    assert sum(df.count() for df in joined) < 1000

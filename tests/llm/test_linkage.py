import random
import time
from itertools import combinations, permutations, product
from pathlib import Path
from types import SimpleNamespace

import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from weftlink.llm import linkage, name_variants, names, places, record_match
from weftlink.llm.queries import QUERIES
from weftlink.llm.records import address_parts
from weftlink.session import settle


@pytest.mark.parametrize(
    "text,num,postal,street",
    [
        ("78, Lake Cross Road, Vreliva Road Junction, Gurum Nagar, Domanagari 308794", "78", "308794", ["lake"]),
        ("Shop No 17, 50, Nerozine Road, Opp. Boshiga Road, Higowadi - 776687", "50", "776687", ["nerozine"]),
        ("LERVENKANE CROSS ROAD, 35, OPP. CHOSSAGA ROAD, KALVADIPUR PIN: 411946", "35", "411946", ["lervenkane"]),
        ("1048 S Sazorkosk Boulevard, Apt. 14A, Kambuburg, NV 67108-1234", "1048", "67108", ["sazorkosk"]),
        ("39911 - 11255 Mill rd - Vrobufield", "11255", "39911", ["mill"]),
        ("22117 W Tinkevil Boulevard, Suite 209, Brookmere, 44987, USA", "22117", "44987", ["tinkevil"]),
        ("S.NO 7, #64 FELDILLIL ST., MEMOBAD 697 320", "64", "697320", ["feldillil"]),
        ("7 rue de l'Église; 62387", "7", "62387", ["eglise"]),
        ("5th Fl., 001 Lace Mn Rd., Peragarh", "1", "", ["lace"]),
        (None, "", "", []),
        ("", "", "", []),
        ("!!!", "", "", []),
    ],
)
def test_address_parts(text, num, postal, street):
    n, p, words, at, _, _ = address_parts(text)
    assert (n, p, [w for w, a in zip(words, at) if a]) == (num, postal, street)


def test_long_address():
    assert address_parts("12 Mill Road, " + "x1 y, " * 20_000)[0] == "12"


def test_deletions_meet_within_two_letters():
    assert places.deletions("vundentisk") & places.deletions("vnudentsk")
    assert places.deletions("hill") & places.deletions("hyll") and not places.deletions("hill") & places.deletions("mall")


ADDRESSES = [
    ("a", "78, Lake Cross Road, Gurum Nagar, Domanagari 308794"), ("b", "Domanagari 308794, 78 LAKE X RD"), ("c", "Shop No 5, 078 Lace Cross Rd., Domanagari"), ("d", "79, Lake Cross Road, Domanagari 308794"),
    ("e", "78, Vundentisk Road, Domanagari 308794"), ("f", "78 Vundetnisk Rd, 308794"), ("g", None), ("h", ""), ("i", "78, Vundentisk Road, Elsewhere 999999"), ("j", "no number here"),
    *((f"z{i}", f"{i}, Lake Cross Road, Gurum Nagar, Domanagari 308794") for i in range(100, 130)),
]


def test_places(spark):
    df = spark.createDataFrame(ADDRESSES, "entity_id string, address string").selectExpr("*", "1 AS num", "2 AS w", "3 AS v", "4 AS street")
    got = {r["id"]: (r["postal"], r["num"], r["street"]) for r in places.places(df, "entity_id", "address").collect()}
    assert len(got) == len(ADDRESSES)
    assert got["a"] == got["b"] == got["c"] != got["d"] and got["e"] == got["f"] != got["a"] and got["i"] != got["e"]
    assert "" in got["g"] and "" in got["h"] and "" in got["j"]
    assert places.places(df.limit(0), "entity_id", "address").collect() == []


@pytest.mark.parametrize("most,part", [(1000, 1000), (1000, 7), (30, 1000)])
def test_words_of_a_code_meet_in_one_task_or_by_the_join(spark, monkeypatch, most, part):
    monkeypatch.setattr(places, "PART", part)
    r = random.Random(4)
    base = ["vundentisk", "gardenwala", "hill", "church", "lake"]
    words = sorted({(p, "".join(c for c in w if r.random() > 0.1)) for p in ("1", "2") for w in base for _ in range(20 if p == "1" else 3)} - {("1", ""), ("2", "")})
    rows = [(p, w, r.randint(1, 9), r.randint(9, 40)) for p, w in words]
    df = spark.createDataFrame(rows, "postal string, w string, n long, all long")
    want = set()
    for (p, w, n, all_), (q, c, bn, ball) in permutations(rows, 2):
        rarer = ball > 4 * all_ or (all_ <= 2 * n and (bn > n or (bn == n and c < w)) and len(w) > 5)
        if p == q and places.deletions(w) & places.deletions(c) and rarer and bn >= n:
            want.add((p, w, c, bn))
    assert sum(p == "1" for p, _ in words) > 30 > sum(p == "2" for p, _ in words)
    assert {tuple(x) for x in places._near_in_code(df, most).collect()} == want


def test_settling_leaves_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {x.getName() for x in (lambda files: [files.apply(i) for i in range(files.size())])(disk.getAllFiles()) if x.getName().startswith("shuffle_")}
    before = shuffled()
    settle(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    end = time.time() + 20
    while shuffled() - before and time.time() < end:  # the files go in the background
        time.sleep(0.2)
    assert not shuffled() - before


def naive_average_linkage(n, sims, least):
    clusters = {i: [i] for i in range(n)}
    while True:
        best = None
        for a, b in combinations(sorted(clusters), 2):
            s = sum(sims.get((min(x, y), max(x, y)), 0) for x in clusters[a] for y in clusters[b]) / len(clusters[a]) / len(clusters[b])
            if s >= least and (best is None or s > best[0]):
                best = (s, a, b)
        if best is None:
            return {x: a for a, v in clusters.items() for x in v}
        clusters[best[1]] += clusters.pop(best[2])


@pytest.mark.parametrize("seed", range(3))
def test_average_linkage_is_the_naive_one(spark, seed):
    r = random.Random(seed)
    sims = {p: r.random() for p in combinations(range(12), 2) if r.random() < 0.6}
    want = naive_average_linkage(12, sims, 0.4)
    df = spark.createDataFrame([(f"{a:02}", f"{b:02}", s) for (a, b), s in sims.items()], "a string, b string, s double")
    got = {int(x["id"]): int(x["cluster"]) for x in linkage.average_linkage(df, 0.4).collect()}
    assert got == {i: c for i, c in want.items() if i in got}


def test_average_linkage_of_nothing(spark):
    assert linkage.average_linkage(spark.createDataFrame([], "a string, b string, s double"), 0.5).collect() == []


def test_average_linkage_keeps_marks_apart(spark):
    edges = spark.createDataFrame([("a", "b", 1.0), ("b", "c", 1.0)], "a string, b string, s double")
    sizes = spark.createDataFrame([("a", 1), ("b", 9), ("c", 1)], "id string, n int")
    marks = spark.createDataFrame([("a", 5, None), ("b", None, None), ("c", 9, None)], "id string, x long, y long")
    of = lambda m: {r["id"]: r["cluster"] for r in linkage.average_linkage(edges, 0.75, sizes, m).collect()}
    assert of(None) == {"a": "a", "b": "a", "c": "a"} and of(marks) == {"a": "a", "b": "a", "c": "c"}


def test_variants_without_a_place(spark):
    name = "New Star Gridirippan Consultants Limited"
    rows = [("a", name, "5"), ("b", name, None), ("c", name, "9, Unknown")]
    rows += [(f"z{i}", f"Business{chr(97 + i)} Of{chr(97 + i) * 3} Trade", None) for i in range(20)]
    df = spark.createDataFrame(rows, "entity_id string, business_name string, business_address string")
    got = {r["id"]: r["cluster"] for r in name_variants.variants(df, "entity_id", "business_name", "business_address").collect()}
    assert got["a"] == got["b"] != got["c"]


def words_table():
    r = random.Random(5)
    base = ["gridirippan consultants", "new star traders", "new star sweets", "royal printing press", "lakeside dental centre"]
    words = [*base, *("".join(c for c in w if r.random() > 0.06) for w in base for _ in range(12)), "zz", "", "new star", "x" * 3000]
    cores = sorted({names.core(w) for w in words})
    table = {-1: len(cores)}
    for c in cores:
        for g in set(names.grams(c)):
            table[g] = table.get(g, 0) + 1
    return cores, table


@pytest.mark.parametrize("least", [0.2, 0.75])
def test_sparse_join_is_the_full_comparison(spark, least):
    cores, table = words_table()
    v = names.Vectors(table)
    want = {(i, j) for i, j in permutations(range(len(cores)), 2) if v.cosine(cores[i], cores[j]) >= least}
    df = spark.createDataFrame([(i, "", c) for i, c in enumerate(cores)], "id long, block string, core string")
    freq = spark.sparkContext.broadcast(table)
    assert {(r["a"], r["b"]) for r in names.similar(df, df, freq, least).collect()} == want
    assert {(r["a"], r["b"]) for r in names.similar(df, df, freq, least, once=True).collect()} == {p for p in want if p[0] < p[1]}
    m = v.cosines(cores)
    assert all(abs(m[i, j] - v.cosine(cores[i], cores[j])) < 1e-9 for i, j in combinations(range(len(cores)), 2))


def test_sparse_join_keeps_none_of_its_candidates(spark, monkeypatch):
    cores, table = words_table()
    df = spark.createDataFrame([(i, "", c) for i, c in enumerate(cores)], "id long, block string, core string")
    made = []
    monkeypatch.setattr(names, "settle", lambda x: (made.append(t := settle(x)), t)[1])
    got = names.similar(df, df, spark.sparkContext.broadcast(table), 0.75).count()
    left = [t for t in made if Path(t.settled_at.removeprefix("file://")).exists()]
    assert len(left) < len(made) and sum(t.count() for t in left) == got


def test_one_task_and_rounds_give_the_same_clusters(spark):
    r = random.Random(9)
    base = ["Gridirippan Consultants", "New Star Traders", "New Star Sweets", "Royal Printing Press"]
    rows = [(f"e{i:03}", "".join(c for c in r.choice(base) if r.random() > 0.05), f"{78 + i % 2}, Lake Road, Domanagari 308794") for i in range(60)]
    df = spark.createDataFrame(rows, "entity_id string, business_name string, business_address string")
    of = lambda n: {tuple(x) for x in name_variants.variants(df, "entity_id", "business_name", "business_address", at_once=n).collect()}
    assert of(3) == of(500)


@pytest.mark.parametrize("seed", range(4))
def test_assignment_is_the_best(seed):
    r = random.Random(seed)
    for _ in range(200):
        n, m = r.randint(1, 5), r.randint(1, 5)
        s = [[r.choice([0, -0.2, r.random(), 0.5]) for _ in range(m)] for _ in range(n)]
        wide = s if n <= m else [list(c) for c in zip(*s)]
        want = max(sum(max(0, row[j]) for row, j in zip(wide, p)) for p in permutations(range(max(n, m)), min(n, m)))
        total, cols = places.assignment(s)
        used = [j for j in cols if j >= 0]
        assert total == pytest.approx(want) and len(used) == len(set(used))
    assert places.assignment([]) == (0.0, []) and places.assignment([[]]) == (0.0, [-1])


def test_agreement_of_components():
    assert places.agreement("vundentisk", ["gurum"], "vudnentsk", ["gurum"]) > places.NEAR
    assert places.agreement("hill", ["gurum"], "vundentisk", ["gurum"]) == 0
    assert places.agreement("", ["gurum"], "hill", ["gurum"]) >= places.NEAR and places.agreement("", [], "hill", []) == 0


def test_chains_of_spellings_end_at_one(spark):
    names_ = ["gardenwalahill", "gardenwlahhil", "grdenwlahhi"]
    rows = [(f"{k}{i}", f"5, {w.title()} Road, Gurum Nagar, Domanagari 308794") for k, (w, n) in enumerate(zip(names_, (9, 5, 1))) for i in range(n)]
    df = spark.createDataFrame(rows, "id string, address string")
    assert places.places(df, "id", "address").select("street").distinct().count() == 1


def test_units_are_a_veto_only_if_asked(spark):
    df = spark.createDataFrame([("a", "Shop No 5, 78, Lake Road, Domanagari 308794"), ("b", "Shop No 6, 78, Lake Road, Domanagari 308794")], "id string, address string")
    count = lambda u: places.places(df, "id", "address", u).select("num", "postal", "street").distinct().count()
    assert count(False) == 1 and count(True) == 2


def test_addresses_without_any_code(spark):
    df = spark.createDataFrame([("a", "7, Hidden Road, Lostplace"), ("b", "LOSTPLACE 7 hidden rd"), ("c", "8, Hidden Road, Lostplace"), ("d", "7, Other Road, Lostplace")], "id string, address string")
    got = {r["id"]: tuple(r)[1:] for r in places.places(df, "id", "address").collect()}
    assert got["a"] == got["b"] and len({got["a"], got["c"], got["d"]}) == 3 and "" not in got["a"]


def test_code_of_common_words_only(spark):
    # every word stands in many codes; only one code has them all
    rows = [(f"t{i}", f"{i}, Mill Road, Middletown {100000 + i}") for i in range(40)] + [(f"u{i}", f"{i}, Church Road, Middletown {200000 + i}") for i in range(40)]
    rows += [(f"m{i}", f"{i}, Mill Road, Bridgeton {100100 + i}") for i in range(40)] + [("x", "9, Mill Road, Church Lane, Bridgeton 555555"), ("y", "9 Mill Road, Church Lane, Bridgeton")]
    df = spark.createDataFrame(rows, "id string, address string")
    got = {r["id"]: r["postal"] for r in places.places(df, "id", "address").collect()}
    assert got["y"] == "555555"


PEOPLE = [
    ("S2-1", "New Star Gridirippan Consultants Limited", "78, Lake Cross Road, Gurum Nagar, Domanagari 308794"), ("S2-2", "Consultants - New Star Gridiripan Ltd", "78 Lake Cross Rd, Domanagari 308794"),
    ("S2-3", "New Star Gridirippan Consultants Limited", None), ("S2-4", "New Star Gridirippan Consultants Limited", "12, Hill Road, Otherplace 111222"), ("S2-5", "Vrilanordi Printing Press", "78, Lake Cross Road, Domanagari 308794"),
    ("S2-6", None, "78, Lake Cross Road, Domanagari 308794"), ("S2-7", "", None), ("S2-1", "new star  gridirippan consultants limited", "78, Lake Cross Road, Gurum Nagar, Domanagari 308794"),
    *((f"S2-9{i:02}", f"Business{chr(97 + i)} Of{chr(97 + i) * 3} Trade", f"{i + 100}, Lake Cross Road, Gurum Nagar, Domanagari 308794") for i in range(20)),
]


def test_variants(spark):
    df = spark.createDataFrame(PEOPLE, "entity_id string, business_name string, business_address string").selectExpr("*", "1 AS id", "2 AS name", "3 AS cluster", "4 AS n")
    got = {r["id"]: r["cluster"] for r in name_variants.variants(df, "entity_id", "business_name", "business_address").collect()}
    assert got["S2-1"] == got["S2-2"] and len({got["S2-1"], got["S2-4"], got["S2-5"]}) == 3
    assert "S2-6" not in got and "S2-7" not in got
    assert got["S2-3"] not in (got["S2-1"], got["S2-4"])  # two places have that name: none stands out
    pairs = name_variants.cluster_pairs(name_variants.variants(df, "entity_id", "business_name", "business_address")).collect()
    assert all(r[0] < r[1] for r in pairs) and ("S2-1", "S2-2") in {tuple(r) for r in pairs}
    assert name_variants.variants(df.limit(0), "entity_id", "business_name", "business_address").collect() == []


def match(first, others, **more):
    return record_match.match(first, others, "entity_id", "business_name", "business_address", "country", **more)


COLS = "entity_id string, business_name string, business_address string"


def test_match(spark):
    first = spark.createDataFrame([(i.replace("S2", "S1"), n, a) for i, n, a in PEOPLE], COLS).filter("entity_id IN ('S1-1', 'S1-4', 'S1-5') OR entity_id LIKE 'S1-9%'")
    others = spark.createDataFrame([("S2-a", "New Star Gridiripan Consultant", "78 Lake Cross Rd, Domanagari 308794"), ("S2-b", "Vrilanordi Ptg Press", "78 lake cross road 308794"), ("S2-c", None, None), ("S2-d", "Unknown Thing", "5, Far Road, Nowhere 999888"), ("S2-e", "Businessa Ofaaa Trade", None)], COLS)
    first, others = first.selectExpr("*", "' India' AS country", "1 AS own", "2 AS block"), others.selectExpr("*", "CASE WHEN entity_id = 'S2-b' THEN '' ELSE 'INDIA ' END AS country", "3 AS confidence")
    m = [r for r in match(first, others).collect() if r["confidence"] >= record_match.LEAST]
    assert {(r["a"], r["b"]) for r in m} == {("S1-1", "S2-a"), ("S1-5", "S2-b"), ("S1-900", "S2-e")}
    assert all(0 <= r["confidence"] <= 1 for r in m)
    assert match(first.limit(0), others).collect() == [] and match(first.limit(0), others.limit(0)).collect() == []
    elsewhere = {(r["a"], r["b"]): r["confidence"] for r in match(first, others.withColumn("country", F.lit("US"))).collect()}
    assert elsewhere[("S1-1", "S2-a")] < {(r["a"], r["b"]): r["confidence"] for r in m}[("S1-1", "S2-a")]


def test_matches_do_not_depend_on_the_blocks(spark):
    first = spark.createDataFrame([(i.replace("S2", "S1"), n, a) for i, n, a in PEOPLE if i in ("S2-1", "S2-4", "S2-5") or i >= "S2-9"], COLS).withColumn("country", F.lit(None).cast("string"))
    copies = [(f"S2-x{i:03}", "Vrilanordi Printing Press", "78, Lake Cross Road, Domanagari 308794", "India") for i in range(120)]
    others = spark.createDataFrame(copies, COLS + ", country string").unionByName(first.withColumn("entity_id", F.regexp_replace("entity_id", "S1", "S2")))
    of = lambda n: {tuple(r) for r in match(first, others, capacity=None, blocks=n).collect()}
    small, whole = of(24), of(1)  # the run of copies is longer than three blocks
    assert small == whole and {(a, b) for a, b, _ in whole} >= {("S1-5", b) for b, *_ in copies}


def test_a_range_streams_by_and_meets_all_neighbours():
    r = random.Random(3)
    rows = [(0, f"{i:06}", f"r{i:06}", r.random() < 0.2 and not 9_000 < i < 40_000, "newstar", "", "", "", "") for i in range(120_000)]
    table = pa.table({c: list(x) for c, x in zip(("block", "key", "id", "own", *record_match._FIELDS), zip(*rows))})
    table = table.set_column(0, "block", table["block"].cast(pa.int32()))
    read, held, got, edge = 0, 0, set(), []

    def batches():
        nonlocal read
        for b in table.to_batches(max_chunksize=5_000):
            read += len(b)
            yield b

    for out in record_match._inside(2, SimpleNamespace(value={-1: 1}))(batches()):
        for x in out.to_pylist():
            got |= {(x["a"], x["b"])} if x["a"] else set()
            edge += [] if x["a"] else [x["id"]]
            at = int((x["b"] or x["id"])[1:])
            if at > 50_000:
                held = max(held, read - at)
    mine = [x[2] for x in rows if x[3]]
    before = 0
    want = set()
    for x in rows:
        before += x[3]
        if not x[3] and 2 <= before <= len(mine) - 2:
            want |= {(a, x[2]) for a in mine[before - 2 : before + 2]}
    assert got == want and len(edge) == len(set(edge)) < 100 and set(edge) >= {*mine[:4], *mine[-4:]}
    assert held <= 2 * record_match.AT_ONCE + 5_000  # of a long range, no more is kept at a time


@pytest.mark.parametrize("seed,capacity", [(0, 1), (2, 2)])
def test_assignment_of_records_is_near_the_greatest_total(spark, seed, capacity):
    r = random.Random(seed)
    firsts, others = "pqr", "uvwxyz"
    pairs = {(a, b): round(r.random(), 3) for a in firsts for b in others if r.random() < 0.7}
    want = 0.0
    for pick in product([None, *firsts], repeat=len(others)):
        if all(pick.count(a) <= capacity for a in firsts) and all(a is None or (a, b) in pairs for a, b in zip(pick, others)):
            want = max(want, sum(pairs[a, b] for a, b in zip(pick, others) if a))
    got = record_match.assign(spark.createDataFrame([(a, b, c) for (a, b), c in pairs.items()], "a string, b string, confidence double"), capacity).collect()
    assert len({x["b"] for x in got}) == len(got) and all(sum(x["a"] == a for x in got) <= capacity for a in firsts)
    assert 0.75 * want <= sum(x["confidence"] for x in got) <= want + 1e-9


def test_the_greatest_total_where_the_next_choice_has_room(spark):
    pairs = [("p", "u", 0.9), ("q", "u", 0.8), ("p", "v", 0.85), ("q", "v", 0.1), ("p", "w", 0.7), ("r", "w", 0.69)]
    got = record_match.assign(spark.createDataFrame(pairs, "a string, b string, confidence double"), 1).collect()
    assert {(x["a"], x["b"]) for x in got} == {("q", "u"), ("p", "v"), ("r", "w")}


def test_rounds_of_the_assignment_keep_few_tables(spark, monkeypatch):
    made, alive = [], []
    there = lambda t: Path(t.settled_at.removeprefix("file://")).exists()

    def watched(df):
        made.append(settle(df))
        alive.append(sum(there(t) for t in made))
        return made[-1]

    monkeypatch.setattr(record_match, "settle", watched)
    pairs = [(f"a{i}", f"b{j}", 1.0 - i / 10) for i in range(4) for j in range(4)]
    got = record_match.assign(spark.createDataFrame(pairs, "a string, b string, confidence double"), 1).collect()
    assert len({r["a"] for r in got}) == len({r["b"] for r in got}) == len(got) == 4
    assert len(made) > 8 and max(alive) <= 4


def test_carried_rows_are_the_nearest():
    r = random.Random(1)
    counts = [("k", b, r.choice((0, 0, 0, 1, 3, 9)), 1) for b in range(60)]
    got = record_match.carried(counts, 6)
    for ahead in (False, True):
        for _, at, _, _ in counts:
            rows = [(b, i) for _, b, n, _ in (counts if ahead else counts[::-1]) if (b > at if ahead else b < at) for i in range(n)]
            assert [(b, i) for _, b, to, need, x in got if to == at and x == ahead for i in range(min(need, counts[b][2]))] == rows[:6]


def links_of(d):
    import pandas as pd

    from weftlink.operators.packed_values import parse

    return {(r.source1_entity_id, v) for r in pd.read_parquet(f"{d}/train_matches.parquet").itertuples() for v, _ in parse(r.matched_entity_ids)}


def test_matches_agree_with_the_known_ones(spark):
    truth = links_of(SMALL)
    rows = {(r["s1_id"], r["other_id"]) for r in QUERIES["p6_matches"](spark, SMALL).filter(f"confidence >= {record_match.LEAST}").collect()}
    ids = {a for a, _ in truth}
    got = {p for p in rows if p[0] in ids}
    sources = {r[0] for k in (2, 3) for r in spark.read.parquet(f"{SMALL}/train_source{k}.parquet").select("entity_id").collect()}
    want = {p for p in truth if p[1] in sources}
    assert len(got & want) >= 0.9 * len(want) and len(got & want) >= 0.95 * len(got)


def test_pairs_agree_with_the_known_ones(spark):
    owner = {b: a for a, b in links_of(SMALL)}
    found = {tuple(r) for r in QUERIES["p2_found"](spark, SMALL).collect()}
    ids = sorted(r[0] for r in spark.read.parquet(f"{SMALL}/train_source2.parquet").select("entity_id").distinct().collect() if r[0] in owner)
    want = {p for p in combinations(ids, 2) if owner[p[0]] == owner[p[1]]}
    got = {p for p in found if p[0] in owner and p[1] in owner}
    assert len(got & want) >= 0.9 * len(want) and len(got & want) >= 0.95 * len(got)


def test_places_agree_with_the_known_ones(spark):
    """Records of source 3 that belong to one record of source 1 are at one place."""
    owner = {b: a for a, b in links_of(SMALL)}
    found = {tuple(r) for r in QUERIES["p4_found"](spark, SMALL).collect()}
    some = spark.read.parquet(f"{SMALL}/train_source3.parquet").filter("trim(business_address) <> ''").select("entity_id").distinct()
    ids = sorted(r[0] for r in some.collect() if r[0] in owner)
    want = {p for p in combinations(ids, 2) if owner[p[0]] == owner[p[1]]}
    assert all(a < b for a, b in found) and len(found & want) >= 0.95 * len(want)

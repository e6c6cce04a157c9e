import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftlink.functions import normalize as nz
from weftlink.functions import similarity as sim

text = st.text(alphabet="ab c1", max_size=12)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


@given(text, text)
@settings(max_examples=300, deadline=None)
def test_indel_is_plain_dynamic_programming(a, b):
    n = len(a) + len(b)
    assert sim.indel_ratio(a, b) == (2 * lcs(a, b) / n if n else 1.0) == sim.indel_ratio(b, a)


@given(text, text)
@settings(max_examples=300, deadline=None)
def test_set_ratio_range_and_symmetry(a, b):
    r = sim.set_ratio(a, b)
    assert 0 <= r <= 1 and r == sim.set_ratio(b, a)
    assert r == (1.0 if a.split() and set(a.split()) == set(b.split()) else r)


def test_set_ratio_cases():
    assert sim.set_ratio("", "a") == 0 and sim.set_ratio("", "") == 0
    assert sim.set_ratio("new york mets", "new york mets vs atlanta") == 1


def one(spark, col, *values):
    names = "abcdef"[: len(values)]
    return spark.createDataFrame([values], ", ".join(f"{n} string" for n in names)).select(col).first()[0]


@pytest.mark.parametrize("a,b,expected", [("", "", 1.0), ("a", "", 0.0), ("a b", "b c", 1 / 3), ("a a", "a", 1.0)])
def test_jaccard(spark, a, b, expected):
    assert one(spark, sim.jaccard(sim.words(F.col("a")), sim.words(F.col("b"))), a, b) == expected


@pytest.mark.parametrize("a,b,expected", [("", "", 0.0), ("a", "", 0.0), ("a b", "b c d", 0.5)])
def test_overlap(spark, a, b, expected):
    assert one(spark, sim.overlap(sim.words(F.col("a")), sim.words(F.col("b"))), a, b) == expected


def test_ngrams(spark):
    assert one(spark, sim.ngrams(F.col("a"), 3), "ab") == ["ab"]
    assert one(spark, sim.ngrams(F.col("a"), 3), "abab") == ["aba", "bab"]
    assert one(spark, sim.ngrams(F.col("a"), 3), "") == []


@pytest.mark.parametrize("raw,expected", [("no 1234567", "123456"), ("none", ""), (None, ""), ("1234 56789", "56789")])
def test_postal(spark, raw, expected):
    assert one(spark, nz.postal(F.col("a")), raw) == expected


@pytest.mark.parametrize("raw,expected", [("ACME Pvt. Ltd", "acme private limited"), (None, ""), ("  ", ""), ("Pvt", "private"), ("accord", "accord"), ("Société", "soci t")])
def test_name_norm(spark, raw, expected):
    assert one(spark, nz.name_norm(F.col("a")), raw) == expected


def test_name_norm_options(spark):
    assert one(spark, nz.name_norm(F.col("a"), expand=False), "ACME pvt") == "acme pvt"
    assert one(spark, nz.name_norm(F.col("a"), fold_accents=True), "Société") == "societe"


def test_first2(spark):
    assert one(spark, nz.first2(F.col("a")), "acme") == "acme" and one(spark, nz.first2(F.col("a")), "a b c") == "a b"

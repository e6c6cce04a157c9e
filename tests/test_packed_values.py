import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weftlink.operators.packed_values import parse, unpack

CASES = {
    None: [], "": [], "  ": [], "none": [], "N/A": [], "NULL": [], "-": [], '""': [], "[]": [], ",": [], ";": [], "no match": [],
    "S2-1;S3-2": ["S2-1", "S3-2"], "S2-1 , ,S3-2,": ["S2-1", "S3-2"], "S2-1\tS3-2\nS3-2": ["S2-1", "S3-2", "S3-2"], "UNK:7,S2-1": ["UNK:7", "S2-1"],
    "'S3-1';'S2-2';S2-3": ["S3-1", "S2-2", "S2-3"], '"S3-1;01"|S3-2': ["S3-1;01", "S3-2"], '"N""07"': ['N"07'], "\"D'07\",S2-1": ["D'07", "S2-1"], "'N\"07'": ['N"07'],
    '["S2-1", "S3-2"]': ["S2-1", "S3-2"], "{'S2-1' S3-2}": ["S2-1", "S3-2"], '"BR|07|7"; S3-1': ["BR|07|7", "S3-1"], "S2-1 / S3-2//S3-3": ["S2-1", "S3-2", "S3-3"],
    '"S2-1, S2-2': ["S2-1", "S2-2"], '"S2-1, "S2-2"': ["S2-1", "S2-2"], "S2-1', S2-2": ["S2-1", "S2-2"], "[S2-1, S2-2": ["S2-1", "S2-2"], "none, S2-1": ["S2-1"], "nonesuch": ["nonesuch"],
}


@pytest.mark.parametrize("text", CASES)
def test_parse(text):
    assert [v for v, _ in parse(text)] == CASES[text]


def test_flags():
    assert parse('"S2-1, S2-2') == [("S2-1", "quote"), ("S2-2", "quote")]
    assert parse("[S2-1") == [("S2-1", "bracket")] and parse("S2-1}") == [("S2-1", "bracket")]
    assert parse('["S2-1"]') == [("S2-1", None)]


def test_long_and_hostile_texts():
    assert len(parse(",".join(f"S2-{i}" for i in range(50_000)))) == 50_000
    assert parse('"' * 50_001 + "[" * 50_000 + "S2-1")[0][0] == "S2-1"
    assert [v for v, _ in parse('"a' * 20_000)] == ["a"] * 20_000


@given(st.lists(st.from_regex(re.compile(r"S[23]-[0-9]{1,9}([,;/][0-9]{2})?", re.A), fullmatch=True), max_size=8), st.sampled_from([",", ";", " | ", "\t", " ; "]), st.sampled_from(['"', "'"]))
@settings(max_examples=200, deadline=None)
def test_quoted_round_trip(values, sep, quote):
    assert [v for v, _ in parse(sep.join(quote + v + quote for v in values))] == values


def test_unpack(spark):
    rows = [("a", "x1,x2"), ("a", "x1;x2"), ("b", None), ("c", "none"), (None, "y"), ("d", "x,x")]
    df = spark.createDataFrame(rows, "id string, packed string").selectExpr("id", "packed", "1 AS pos", "2 AS value", "3 AS items")
    got = sorted(map(tuple, unpack(df, ["id"], "packed").collect()), key=str)
    assert got == sorted([("a", 1, "x1", None), ("a", 2, "x2", None), (None, 1, "y", None), ("d", 1, "x", None), ("d", 2, "x", None)], key=str)
    assert unpack(df.limit(0), ["id"], "packed").collect() == []

"""Every core query against its SQL, over the smallest tables."""

import oracle
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from weftlink.operators import features
from weftlink.queries import FLAGSHIP, ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SMALL)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES) and FLAGSHIP in QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, con, name):
    assert oracle.differences(spark, con, QUERIES[name], ORACLE[name], SMALL) == ""


def test_only_models_and_flags_have_no_sql():
    assert set(QUERIES) - set(ORACLE) == {"gbt_scores", "pair_features_all", "p7_values"}


def test_all_features_in_one_table(spark):
    """The whole feature table holds what the single feature queries give."""
    every = QUERIES["pair_features_all"](spark, SMALL)
    assert every.columns == ["s1_id", "other_id", "source", *features.FEATURES]
    key, names = ["s1_id", "other_id", "source"], ["name_lev", "addr_lev"]
    one = QUERIES["feat_indel"](spark, SMALL)
    assert every.select(*key, *[F.round(c, 6).alias(c) for c in names]).exceptAll(one).isEmpty()


def test_packed_values_with_flags(spark):
    rows = QUERIES["p7_values"](spark, SMALL)
    assert rows.select("source1_entity_id", "pos", "matched_id").exceptAll(QUERIES["p7_found"](spark, SMALL)).isEmpty() and rows.filter("error IS NOT NULL AND error NOT IN ('quote', 'bracket', 'bracket,quote')").isEmpty()


def test_model_on_held_out_pairs(spark):
    """Scores of pairs the model has not seen tell matches from others."""
    links = QUERIES["truth_links"](spark, SMALL).withColumn("y", F.lit(1))
    rows = QUERIES["gbt_scores"](spark, SMALL).join(links, ["s1_id", "other_id"], "left").toPandas().fillna({"y": 0})
    assert len(rows) and ((rows.proba >= 0.5) == (rows.y == 1)).mean() > 0.9


def test_normalized_table_is_what_we_compute(spark):
    """The given normalised table, from the raw sources."""
    cols = ["entity_id", "name_norm", "addr_norm", "postal", "name_first2", "addr_first2"]
    given = spark.read.parquet(f"{SMALL}/normalized_entity.parquet").select(*cols)
    ours = QUERIES["normalize_entities"](spark, SMALL).select(*cols)
    assert given.exceptAll(ours).count() == 0 and ours.exceptAll(given).count() == 0

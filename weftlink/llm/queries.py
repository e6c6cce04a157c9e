"""Queries of the training-data operators and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.llm import abuse, corpus_tokens, name_variants, packing, places, record_match, topn, value_counts
from weftlink.session import settle, table

Query = Callable[[SparkSession, str], DataFrame]


def p2_variants(spark: SparkSession, d: str) -> DataFrame:
    """The business of every record of source 2, named by its smallest id."""
    return name_variants.variants(table(spark, d, "train_source2"), "entity_id", "business_name", "business_address")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return name_variants.cluster_pairs(p2_variants(spark, d))


def p3_topn(spark: SparkSession, d: str) -> DataFrame:
    pairs = topn.fold_pairs(table(spark, d, "candidates"))
    return topn.top_n(pairs, ["s1_id", "source"], "other_id", "score", 5)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_topn(spark, d).select("s1_id", "other_id")


def p4_places(spark: SparkSession, d: str) -> DataFrame:
    """The place of every record of source 3 that has one."""
    rows = table(spark, d, "train_source3")
    some = F.max(F.when(F.trim("business_address") != "", F.col("business_address")))
    one = rows.groupBy("entity_id").agg(some.alias("address")).filter("address IS NOT NULL")
    return places.places(one, "entity_id", "address").filter("num <> '' AND postal <> '' AND street <> ''").withColumnRenamed("id", "entity_id")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    placed = settle(p4_places(spark, d))
    return name_variants.cluster_pairs(placed.select(F.col("entity_id").alias("id"), F.concat_ws("|", "postal", "num", "street").alias("cluster")))


def p5_counts(spark: SparkSession, d: str) -> DataFrame:
    tokens = table(spark, d, "tokens")
    n = tokens.agg(F.countDistinct("entity_id")).first()[0]
    counts = value_counts.marked(value_counts.value_counts(tokens, "token", "entity_id"), n)
    return counts.select(F.col("value").alias("token"), "n_rows", F.col("n_records").alias("n_entities"), F.coalesce("mark", F.lit("")).alias("mark"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_counts(spark, d).filter(F.col("mark") != "").select("token", "mark")


def p6_matches(spark: SparkSession, d: str) -> DataFrame:
    """Every assigned pair of source 1 and sources 2 and 3, with its confidence. A record of source 1 has at most 11 records in the others (TESTDATA)."""
    others = table(spark, d, "train_source2").unionByName(table(spark, d, "train_source3"))
    pairs = record_match.match(table(spark, d, "train_source1"), others, "entity_id", "business_name", "business_address", "country", capacity=11)
    return pairs.withColumnsRenamed({"a": "s1_id", "b": "other_id"})


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "train_matches").select(F.col("source1_entity_id").alias("s1_id"))
    sure = p6_matches(spark, d).filter(F.col("confidence") >= record_match.LEAST)
    return sure.join(known, "s1_id", "left_anti").select("s1_id", "other_id")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return corpus_tokens.encode(table(spark, d, "documents"))


def p8_decoded(spark: SparkSession, d: str) -> DataFrame:
    """The texts again, from their ids."""
    return corpus_tokens.decode(p8_ids(spark, d))


def p9_packed(spark: SparkSession, d: str) -> DataFrame:
    sizes = settle(corpus_tokens.token_counts(table(spark, d, "documents"), dims=3))
    return packing.pack(sizes, "doc_id", "n_tokens", "vector", 3, 2048)


def p9_fill(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers are."""
    each = p9_packed(spark, d).groupBy("container").agg(F.sum("n_tokens").alias("n"))
    return each.agg(F.count(F.lit(1)).alias("containers"), F.sum("n").alias("tokens"), F.max("n").alias("fullest"), F.round(F.sum("n") / F.count(F.lit(1)) / 2048, 6).alias("filled"))


def p9_checks(spark: SparkSession, d: str) -> DataFrame:
    """(check, n): documents packed, containers above the capacity, documents cut that fit in one, documents whose pieces leave a gap."""
    rows = settle(p9_packed(spark, d))
    doc = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("pieces"), F.sum("n_tokens").alias("n"), F.max(F.col("start") + F.col("n_tokens")).alias("end"))
    over = rows.groupBy("container").agg(F.sum("n_tokens").alias("n")).filter("n > 2048")
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n")
    parts = [count(doc, "documents"), count(over, "over_capacity"), count(doc.filter("n <= 2048 AND pieces > 1"), "cut"), count(doc.filter("n <> end"), "gap")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    return abuse.scores(table(spark, d, "documents"), table(spark, d, "page_labels"))


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    return abuse.rates(p10_scores(spark, d), table(spark, d, "documents"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_scores(spark, d).filter("score >= 0.5").select("doc_id")


QUERIES: dict[str, Query] = {
    "p2_variants": p2_variants, "p2_found": p2_found, "p4_places": p4_places, "p4_found": p4_found,
    "p3_topn": p3_topn, "p3_found": p3_found, "p5_counts": p5_counts, "p5_found": p5_found, "p6_matches": p6_matches, "p6_found": p6_found, "p8_ids": p8_ids, "p8_decoded": p8_decoded, "p9_packed": p9_packed, "p9_fill": p9_fill, "p9_checks": p9_checks, "p10_scores": p10_scores, "p10_rates": p10_rates, "p10_found": p10_found}

# Flags and weights, written out so that the SQL doesn't share the code's.
_WEIGHTS = {"exact_name": 100, "exact_address": 95, "name_postal": 90, "addr_postal": 85, "postal": 70, "name_token": 65, "address_token": 60, "first2": 40}
_FLAGS = " , ".join(f"max(coalesce({c},0)) AS {c}" for c in _WEIGHTS)
_SCORE = " + ".join(f"{w}*{c}" for c, w in _WEIGHTS.items()) + " + 20*greatest(" + "+".join(_WEIGHTS) + " - 1, 0)"
_TOPN = f"""
WITH p AS (SELECT s1_id, source, other_id, {_FLAGS} FROM candidates WHERE other_id IS NOT NULL GROUP BY ALL),
s AS (SELECT s1_id, source, other_id, CAST({_SCORE} AS INTEGER) AS score FROM p),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY s1_id, source ORDER BY score DESC, other_id) AS INTEGER) AS rank FROM s)
"""
_COUNTS = """
WITH n AS (SELECT count(DISTINCT entity_id) AS n FROM tokens),
c AS (SELECT token, count(*) AS n_rows, count(DISTINCT entity_id) AS n_entities FROM tokens WHERE token IS NOT NULL GROUP BY token),
m AS (SELECT c.*, CASE WHEN n_entities < 3 THEN 'rare' WHEN n_entities > n * 0.01 THEN 'common' ELSE '' END AS mark FROM c, n)
"""
ORACLE: dict[str, str] = {
    "p8_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p9_checks": "SELECT 'documents' AS \"check\", count(*) AS n FROM documents UNION ALL SELECT 'over_capacity', 0 UNION ALL SELECT 'cut', 0 UNION ALL SELECT 'gap', 0",
    "p3_topn": _TOPN + "SELECT s1_id, source, other_id, score, rank FROM r WHERE rank <= 5",
    "p3_found": _TOPN + "SELECT s1_id, other_id FROM r WHERE rank <= 5",
    "p5_counts": _COUNTS + "SELECT token, n_rows, n_entities, mark FROM m",
    "p5_found": _COUNTS + "SELECT token, mark FROM m WHERE mark <> ''",
}

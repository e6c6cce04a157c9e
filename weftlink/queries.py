"""Queries of the core: one entry for each operator, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.functions import normalize as nz
from weftlink.functions import similarity as sim
from weftlink.operators import blocking, entities, features, heavy_keys, matching, packed_values
from weftlink.oracle import ORACLE  # noqa: F401
from weftlink.session import settle, shared_dir, table
from weftlink.sources.tables import TRUTH, Store, links, read_tsv, write_tsv
from weftlink.streaming.incremental import linked

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# -- inputs
def _sources(spark: SparkSession, d: str) -> DataFrame:
    parts = [table(spark, d, f"train_source{k}").withColumn("source", F.lit(f"S{k}")) for k in (1, 2, 3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _entities(spark: SparkSession, d: str) -> DataFrame:
    return entities.keyed(table(spark, d, "normalized_entity"))


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = _entities(spark, d)
    return e.filter("source = 'S1'"), e.filter("source <> 'S1'")


def _links(spark: SparkSession, d: str) -> DataFrame:
    return links(table(spark, d, "train_matches"))


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return blocking.consolidate(table(spark, d, "candidates"))


def _paired(spark: SparkSession, d: str) -> DataFrame:
    return features.paired(_pairs(spark, d), _entities(spark, d))


_KEY = ["s1_id", "other_id", "source"]


# -- normalisation
def _normalized(expand: bool, columns: list[str]) -> Query:
    return lambda spark, d: entities.normalize(_sources(spark, d), expand).select("entity_id", *columns)


QUERIES |= {
    "normalize_entities": _normalized(True, ["name_norm", "name_alnum", "addr_norm", "postal", "name_first", "name_first2", "addr_first", "addr_first2"]),
    "normalize_name": _normalized(True, ["name_norm", "name_alnum"]),
    "normalize_address": _normalized(True, ["addr_norm"]),
    "normalize_raw_variant": _normalized(False, ["name_norm", "addr_norm"]),
    "postal_extract": _normalized(True, ["postal"]),
    "first_tokens": _normalized(True, ["name_first", "name_first2", "addr_first", "addr_first2"]),
}


@query
def normalize_folded(spark: SparkSession, d: str) -> DataFrame:
    """Names with accents folded before punctuation goes."""
    return _sources(spark, d).select("entity_id", nz.name_norm(F.col("business_name"), fold_accents=True).alias("name_folded"))


# -- tokens
def _tokens(col: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = entities.tokens(_entities(spark, d), col)
        return rows.groupBy("entity_id", "token").agg(F.count(F.lit(1)).alias("tf"))

    return run


QUERIES |= {"tokens_name": _tokens("name_norm"), "tokens_addr": _tokens("addr_norm")}


@query
def token_freq(spark: SparkSession, d: str) -> DataFrame:
    rows = entities.tokens(_sides(spark, d)[1], "name_norm", carry=("source",))
    return rows.groupBy("source", "token").agg(F.count(F.lit(1)).alias("postings"), F.countDistinct("entity_id").alias("n_entities"))


@query
def rare_tokens_cap(spark: SparkSession, d: str) -> DataFrame:
    return token_freq(spark, d).filter("postings <= 500").select("source", "token", "postings")


@query
def rare_tokens_df(spark: SparkSession, d: str) -> DataFrame:
    others = _sides(spark, d)[1]
    size = others.groupBy("source").agg((F.count(F.lit(1)) * F.lit(0.0015)).alias("most"))
    return token_freq(spark, d).join(F.broadcast(size), "source").filter("postings <= most").select("source", "token", "postings")


# -- audits
@query
def audit_sources(spark: SparkSession, d: str) -> DataFrame:
    return entities.audit(_sources(spark, d))


@query
def audit_countries(spark: SparkSession, d: str) -> DataFrame:
    return _sources(spark, d).groupBy("source", nz.country_key(F.col("country")).alias("ckey")).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def audit_missing(spark: SparkSession, d: str) -> DataFrame:
    return entities.audit_missing(_sources(spark, d))


@query
def audit_dup_ids(spark: SparkSession, d: str) -> DataFrame:
    return _sources(spark, d).groupBy("source", "entity_id").agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


@query
def gt_cardinality(spark: SparkSession, d: str) -> DataFrame:
    c = entities.cardinality(table(spark, d, "train_matches"), _links(spark, d))
    return c.groupBy("n_matches").agg(F.count(F.lit(1)).alias("n_entities"))


@query
def gt_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "train_matches").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("source1_entity_id").alias("n_ids"))
    c = entities.cardinality(table(spark, d, "train_matches"), _links(spark, d))
    sums = c.agg(F.sum("n_matches").alias("links"), F.max("n_matches").alias("most"), F.count_if(F.col("n_matches") == 0).alias("without"), F.count_if(F.col("n_matches") > 0).alias("with_match"))
    return rows.crossJoin(sums).select("n_rows", "n_ids", (F.col("n_rows") - F.col("n_ids")).alias("n_repeated"), "links", "most", "without", "with_match")  # one row each


@query
def gt_source_split(spark: SparkSession, d: str) -> DataFrame:
    part = F.when(F.col("other_id").startswith("S2-"), "S2").when(F.col("other_id").startswith("S3-"), "S3").otherwise("other")
    return _links(spark, d).groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("links"), F.countDistinct("s1_id").alias("n_entities"))


# -- work set
@query
def split_workset(spark: SparkSession, d: str) -> DataFrame:
    return entities.workset(table(spark, d, "train_source1"), 40_000, 10_000)


@query
def entity_split(spark: SparkSession, d: str) -> DataFrame:
    return entities.entity_split(table(spark, d, "train_source1"))


# -- blocks
def _block(name: str) -> Query:
    make = blocking.key_block if name in blocking.KEYS else blocking.token_block
    return lambda spark, d: make(*_sides(spark, d), name)


QUERIES |= {f"block_{b}": _block(b) for b in [*blocking.KEYS, *blocking.TOKEN_FIELDS]}


@query
def block_any_country(spark: SparkSession, d: str) -> DataFrame:
    return blocking.key_block(*_sides(spark, d), "exact_name", replace(blocking.TRAIN, country=False))


@query
def block_distinct_tokens(spark: SparkSession, d: str) -> DataFrame:
    return blocking.token_block(*_sides(spark, d), "name_token", replace(blocking.TRAIN, distinct_tokens=True))


# -- candidates
@query
def candidates_consolidated(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d)


@query
def candidates_strength(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).select(*_KEY, blocking.strength().alias("strength"))


@query
def candidates_bounded(spark: SparkSession, d: str) -> DataFrame:
    """The 20 strongest of each entity and source: a cap that binds at test sizes."""
    return blocking.bounded(_pairs(spark, d), replace(blocking.TRAIN, final=20)).select(*_KEY, "strength")


@query
def candidates_final(spark: SparkSession, d: str) -> DataFrame:
    return blocking.candidates(*_sides(spark, d)).select(*_KEY, *blocking.FLAGS, "strength")


@query
def candidates_test_mode(spark: SparkSession, d: str) -> DataFrame:
    return blocking.candidates(*_sides(spark, d), blocking.TEST_AS_WRITTEN).select(*_KEY, *blocking.TEST_ORDER)


@query
def candidates_no_extended(spark: SparkSession, d: str) -> DataFrame:
    return blocking.candidates(*_sides(spark, d), replace(blocking.TRAIN, extended=False)).select(*_KEY, "strength")


@query
def candidate_stats(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("pairs"), F.countDistinct("s1_id").alias("n_entities"))


# -- truth and recall
@query
def truth_links(spark: SparkSession, d: str) -> DataFrame:
    return _links(spark, d)


@query
def truth_attribution(spark: SparkSession, d: str) -> DataFrame:
    known = _sides(spark, d)[1].select(F.col("entity_id").alias("other_id"), "source")
    return _links(spark, d).join(known, "other_id", "left").select("s1_id", "other_id", F.coalesce("source", F.lit("UNK")).alias("src"))


@query
def candidate_recall(spark: SparkSession, d: str) -> DataFrame:
    return matching.recall(_pairs(spark, d), _links(spark, d), _sides(spark, d)[1])


@query
def recall_by_block(spark: SparkSession, d: str) -> DataFrame:
    flags = F.explode(F.array(*[F.struct(F.lit(f).alias("block"), F.col(f).alias("flag")) for f in blocking.FLAGS]))
    hits = _pairs(spark, d).join(_links(spark, d), ["s1_id", "other_id"], "left_semi").select(flags.alias("x"))
    return hits.groupBy(F.col("x.block").alias("block")).agg(F.sum("x.flag").alias("hits"), F.count(F.lit(1)).alias("found"))


# -- features
@query
def feat_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return features.native(_paired(spark, d)).select(*_KEY, "name_jaccard", "addr_jaccard")


@query
def feat_overlap(spark: SparkSession, d: str) -> DataFrame:
    return features.native(_paired(spark, d)).select(*_KEY, "name_overlap", "addr_overlap")


@query
def feat_ngrams(spark: SparkSession, d: str) -> DataFrame:
    return features.native(_paired(spark, d)).select(*_KEY, "name_char3_jaccard", "name_char4_jaccard")


@query
def feat_exact(spark: SparkSession, d: str) -> DataFrame:
    return features.native(_paired(spark, d)).select(*_KEY, "name_exact", "addr_exact", "postal_match", "name_first_token", "same_name_first2", "same_address_first2", "same_country")


@query
def feat_house(spark: SparkSession, d: str) -> DataFrame:
    return features.native(_paired(spark, d)).select(*_KEY, "house_overlap")


@query
def feat_flags(spark: SparkSession, d: str) -> DataFrame:
    return features.native(_paired(spark, d)).select(*_KEY, *[f"block_{b}" for b in features.BLOCK_FEATURES])


def _edits(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Edit similarities, rounded to what two engines can agree on."""
    return features.edited(_paired(spark, d)).select(*_KEY, *[F.round(c, 6).alias(c) for c in columns])


@query
def feat_indel(spark: SparkSession, d: str) -> DataFrame:
    return _edits(spark, d, "name_lev", "addr_lev")


@query
def feat_cross(spark: SparkSession, d: str) -> DataFrame:
    return _edits(spark, d, "name_addr_product", "name_addr_mean", "name_addr_gap")


@query
def feat_token_sort(spark: SparkSession, d: str) -> DataFrame:
    return _edits(spark, d, "name_token_sort", "addr_token_sort")


@query
def feat_token_set(spark: SparkSession, d: str) -> DataFrame:
    return _edits(spark, d, "name_token_set", "addr_token_set")


@query
def feat_sorted_words(spark: SparkSession, d: str) -> DataFrame:
    return _entities(spark, d).select("entity_id", sim.sorted_words(F.col("name_norm")).alias("name_sorted"), sim.sorted_words(F.col("addr_norm")).alias("addr_sorted"))


@query
def feat_tfidf_cosine(spark: SparkSession, d: str) -> DataFrame:
    return features.tfidf_cosine(_pairs(spark, d), _entities(spark, d), "name_norm")


@query
def feat_tfidf_address(spark: SparkSession, d: str) -> DataFrame:
    return features.tfidf_cosine(_pairs(spark, d), _entities(spark, d), "addr_norm")


@query
def feat_tfidf_train(spark: SparkSession, d: str) -> DataFrame:
    """Names, with weights fitted on the training split of source 1 alone."""
    split = entities.entity_split(table(spark, d, "train_source1")).filter("split = 'train'")
    e = _entities(spark, d)
    return features.tfidf_cosine(_pairs(spark, d), e, "name_norm", fitted_on=e.join(split, "entity_id", "left_semi"))


@query
def pair_features_all(spark: SparkSession, d: str) -> DataFrame:
    return features.features(_pairs(spark, d), _entities(spark, d))


# -- labels, sample, scores
#: Features without the edit similarities, so that any engine can check what is built on them.
_PLAIN = {"name_exact": 100, "addr_exact": 90, "postal_match": 80, "name_jaccard": 30, "addr_jaccard": 20}


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of entities that have truth, with plain features and label."""
    known = table(spark, d, "train_matches").select(F.col("source1_entity_id").alias("s1_id")).distinct()
    pairs = _pairs(spark, d).join(known, "s1_id", "left_semi")
    rows = features.native(features.paired(pairs, _entities(spark, d))).select(*_KEY, *_PLAIN)
    return matching.label(rows, _links(spark, d))


@query
def labels(spark: SparkSession, d: str) -> DataFrame:
    return _labelled(spark, d).select(*_KEY, "label")


@query
def hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    return matching.hard_negatives(_labelled(spark, d), 6, _PLAIN).select(*_KEY, "hard")


@query
def train_sample(spark: SparkSession, d: str) -> DataFrame:
    return matching.train_sample(_labelled(spark, d), 6, 1_500_000, _PLAIN).select(*_KEY, "label", "hard")


def _scored(spark: SparkSession, d: str) -> DataFrame:
    rows = _labelled(spark, d)
    return matching.plain_score(rows).join(rows.select("s1_id", "other_id", "label"), ["s1_id", "other_id"])


@query
def mined_negatives(spark: SparkSession, d: str) -> DataFrame:
    return matching.mined(_scored(spark, d))


@query
def sample_weights(spark: SparkSession, d: str) -> DataFrame:
    return matching.sample_weights(_labelled(spark, d), mined_negatives(spark, d), "name_jaccard").select(*_KEY, "weight")


@query
def plain_scores(spark: SparkSession, d: str) -> DataFrame:
    return matching.plain_score(_labelled(spark, d))


# -- metrics
def _truth_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "train_matches").select(F.col("source1_entity_id").alias("s1_id")).distinct()


@query
def f05_entity(spark: SparkSession, d: str) -> DataFrame:
    return matching.f05_by_entity(_truth_ids(spark, d), _links(spark, d), plain_scores(spark, d).filter("proba >= 0.5"))


@query
def f05_macro(spark: SparkSession, d: str) -> DataFrame:
    return f05_entity(spark, d).agg(F.round(F.avg("f05"), 6).alias("macro_f05"), F.count(F.lit(1)).alias("n_entities"))


@query
def threshold_curve(spark: SparkSession, d: str) -> DataFrame:
    c = matching.threshold_curve(_truth_ids(spark, d), _links(spark, d), plain_scores(spark, d))
    return c.select("threshold", F.round("macro_f05", 6).alias("macro_f05"))


@query
def best_threshold(spark: SparkSession, d: str) -> DataFrame:
    return matching.best_threshold(threshold_curve(spark, d))


# -- outputs
@query
def matching_results(spark: SparkSession, d: str) -> DataFrame:
    return matching.listed(_truth_ids(spark, d), plain_scores(spark, d).filter("proba >= 0.5"), "matched_entity_ids")


@query
def candidate_pairs(spark: SparkSession, d: str) -> DataFrame:
    return matching.listed(_sides(spark, d)[0].select(F.col("entity_id").alias("s1_id")), _pairs(spark, d), "candidate_entity_ids")


@query
def validate_outputs(spark: SparkSession, d: str) -> DataFrame:
    predicted = plain_scores(spark, d).filter("proba >= 0.5")
    return matching.output_checks(matching_results(spark, d), _truth_ids(spark, d), predicted, _pairs(spark, d))


# -- files, stages and arrivals
def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/weftlink/{uuid.uuid4().hex}"


@query
def tsv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The sources written as tab-separated text and read again by schema, an empty field as null."""
    path = _folder(spark)
    cols = ["entity_id", "business_name", "business_address", "country"]
    write_tsv(_sources(spark, d).select(*cols), path, "entity_id")
    return read_tsv(spark, path, multi_line=True)


@query
def tsv_results(spark: SparkSession, d: str) -> DataFrame:
    """The match lists written in order and read again with empty lists as they are."""
    path = _folder(spark)
    write_tsv(matching_results(spark, d), path, "source1_entity_id")
    return read_tsv(spark, path, TRUTH, False)


@query
def stored_entities(spark: SparkSession, d: str) -> DataFrame:
    """Entities through the store: made once, then read by the key of their configuration."""
    store = Store(spark, _folder(spark))
    make = lambda: _entities(spark, d)
    store.table("entities", {"data": d}, make)
    return store.table("entities", {"data": d}, make).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("ckey").alias("n_countries"))


@query
def incremental_links(spark: SparkSession, d: str) -> DataFrame:
    """Records of source 2 arriving in a stream, linked to the stored entities of source 1 by equal name and the countries of their id."""
    path = _folder(spark)
    rows = table(spark, d, "train_source2")
    rows.write.parquet(f"{path}/in")
    arrivals = linked(spark.readStream.schema(rows.schema).parquet(f"{path}/in"), _sides(spark, d)[0], countries=rows)
    run = arrivals.writeStream.format("parquet").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start(f"{path}/out")
    run.awaitTermination()
    return spark.read.schema("entity_id string, s1_id string, block string").parquet(f"{path}/out")


# -- classifier
@query
def gbt_scores(spark: SparkSession, d: str) -> DataFrame:
    """Scores of a boosted-tree model on the pairs of held-out entities, which it has not seen (a model has no SQL)."""
    pairs = _pairs(spark, d).join(_truth_ids(spark, d), "s1_id", "left_semi")
    rows = settle(matching.label(features.features(pairs, _entities(spark, d)), _links(spark, d)))
    held = entities.entity_split(rows.select(F.col("s1_id").alias("entity_id"))).filter("split = 'val'").select(F.col("entity_id").alias("s1_id"))
    sample = matching.sample_weights(matching.train_sample(rows.join(held, "s1_id", "left_anti")))
    return matching.score(matching.fit(sample), rows.join(held, "s1_id", "left_semi"))


# -- problem 1: a few keys holding most records
def _fields(spark: SparkSession, d: str) -> DataFrame:
    """(key_field, key_value, entity_id) of the three fields, every stored row."""
    e, t = table(spark, d, "normalized_entity"), table(spark, d, "tokens")
    both = e.select("entity_id", F.explode(F.create_map(F.lit("postal"), F.col("postal"), F.lit("name_first2"), F.col("name_first2"))).alias("key_field", "key_value"))
    return both.unionByName(t.select("entity_id", F.lit("token").alias("key_field"), F.col("token").alias("key_value")))


@query
def p1_key_stats(spark: SparkSession, d: str) -> DataFrame:
    return heavy_keys.key_stats(_fields(spark, d), ["key_field", "key_value"], "entity_id").drop("n_shards")


@query
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    share = 0.02
    n = {t: table(spark, d, t).count() for t in ("tokens", "normalized_entity")}
    least = F.when(F.col("key_field") == "token", F.lit(share * n["tokens"])).otherwise(F.lit(share * n["normalized_entity"]))
    stats = heavy_keys.key_stats(_fields(spark, d), ["key_field", "key_value"], "entity_id")
    return stats.filter(F.col("key_value").isNotNull() & (F.col("key_value") != "") & (F.col("n_rows") >= least)).select("key_field", "key_value")


@query
def p1_join(spark: SparkSession, d: str) -> DataFrame:
    """Token rows joined with the rows of their token, for tokens of two entities and more, summed by entity."""
    t = table(spark, d, "tokens")
    freq = heavy_keys.key_stats(t, ["token"], "entity_id").filter("n_entities > 1").select("token", F.col("n_rows").alias("token_rows"))
    j = heavy_keys.fragment_replicate_join(t.select("entity_id", "token"), freq, ["token"], "entity_id")
    return j.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n_tokens"), F.max("token_rows").alias("most"), F.min("token_rows").alias("least"))


# -- problem 7: several values packed in one field
@query
def p7_values(spark: SparkSession, d: str) -> DataFrame:
    return packed_values.unpack(table(spark, d, "train_matches"), ["source1_entity_id"], "matched_entity_ids", value="matched_id")


@query
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_values(spark, d).select("source1_entity_id", "pos", "matched_id").distinct()


FLAGSHIP = "candidates_final"

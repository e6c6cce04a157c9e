"""Features of candidate pairs: set and edit similarities, predicates, block flags, corpus-weighted cosine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftlink.functions import similarity as sim
from weftlink.operators.blocking import FLAGS
from weftlink.session import settle

TEXT = ["name_norm", "addr_norm", "postal", "name_first2", "addr_first2", "ckey"]
# Names and order of the features.
BLOCK_FEATURES = ["exact_name", "exact_address", "postal", "name_token", "address_token", "first2", "name_postal", "addr_postal"]
FEATURES = [
    "name_lev", "name_token_sort", "name_token_set", "name_jaccard", "name_overlap", "name_exact", "name_first_token", "name_char3_jaccard", "name_char4_jaccard",
    "addr_lev", "addr_token_sort", "addr_token_set", "addr_jaccard", "addr_overlap", "addr_exact", "postal_match", "house_overlap", "same_country",
    "name_addr_product", "name_addr_mean", "name_addr_gap", "same_name_first2", "same_address_first2", *[f"block_{b}" for b in BLOCK_FEATURES],
]


def paired(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    """``pairs`` with the texts of both sides as l_* and r_*, block flags as blk_*. One join a side, whatever the source."""
    left = entities.select(F.col("entity_id").alias("s1_id"), *[F.col(c).alias(f"l_{c}") for c in TEXT])
    right = entities.select(F.col("entity_id").alias("other_id"), *[F.col(c).alias(f"r_{c}") for c in TEXT])
    flags = [F.col(f).alias(f"blk_{f}") if f in pairs.columns else F.lit(0).alias(f"blk_{f}") for f in FLAGS]
    return pairs.select("s1_id", "other_id", "source", *flags).join(left, "s1_id").join(right, "other_id")


def _same(c: str) -> Column:
    return ((F.col(f"l_{c}") != "") & (F.col(f"l_{c}") == F.col(f"r_{c}"))).cast("double")


def native(p: DataFrame) -> DataFrame:
    """The features that are plain column expressions."""
    n1, n2, a1, a2 = F.col("l_name_norm"), F.col("r_name_norm"), F.col("l_addr_norm"), F.col("r_addr_norm")
    sets = p.withColumns({"nw1": sim.words(n1), "nw2": sim.words(n2), "aw1": sim.words(a1), "aw2": sim.words(a2)})
    nw1, nw2, aw1, aw2 = (F.col(c) for c in ("nw1", "nw2", "aw1", "aw2"))
    digits = lambda c: F.filter(c, lambda w: w.rlike("^[0-9]+$"))
    return sets.withColumns(
        {
            "name_jaccard": sim.jaccard(nw1, nw2), "name_overlap": sim.overlap(nw1, nw2), "addr_jaccard": sim.jaccard(aw1, aw2), "addr_overlap": sim.overlap(aw1, aw2),
            "name_exact": _same("name_norm"), "addr_exact": _same("addr_norm"), "postal_match": _same("postal"), "same_name_first2": _same("name_first2"), "same_address_first2": _same("addr_first2"),
            "name_first_token": ((n1 != "") & (F.split_part(n1, F.lit(" "), F.lit(1)) == F.split_part(n2, F.lit(" "), F.lit(1)))).cast("double"),
            "name_char3_jaccard": sim.jaccard(sim.ngrams(n1, 3), sim.ngrams(n2, 3)), "name_char4_jaccard": sim.jaccard(sim.ngrams(n1, 4), sim.ngrams(n2, 4)),
            "house_overlap": sim.jaccard(digits(aw1), digits(aw2)), "same_country": (F.col("l_ckey") == F.col("r_ckey")).cast("double"),
            **{f"block_{b}": F.col(f"blk_{b}").cast("double") for b in BLOCK_FEATURES},
        }
    ).drop("nw1", "nw2", "aw1", "aw2")


def edited(p: DataFrame) -> DataFrame:
    """The edit similarities, in one Arrow crossing for names and one for addresses, and what is built on them."""
    out = p
    for short, col in (("name", "name_norm"), ("addr", "addr_norm")):
        a, b = F.col(f"l_{col}"), F.col(f"r_{col}")
        out = out.withColumn(f"e_{short}", sim.edit_scores(a, b, sim.sorted_words(a), sim.sorted_words(b)))
    for short in ("name", "addr"):
        out = out.withColumns({f"{short}_lev": F.col(f"e_{short}.lev"), f"{short}_token_sort": F.col(f"e_{short}.sort"), f"{short}_token_set": F.col(f"e_{short}.set")})
    n, a = F.col("name_lev"), F.col("addr_lev")
    return out.withColumns({"name_addr_product": n * a, "name_addr_mean": (n + a) / 2, "name_addr_gap": F.abs(n - a)}).drop("e_name", "e_addr")


def features(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    """(s1_id, other_id, source, *FEATURES)."""
    return edited(native(paired(pairs, entities))).select("s1_id", "other_id", "source", *FEATURES)


def tfidf_cosine(pairs: DataFrame, entities: DataFrame, col: str, n: int = 3, fitted_on: DataFrame | None = None) -> DataFrame:
    """(s1_id, other_id, source, cosine): letter n-gram vectors weighted by tf * (ln((1 + N) / (1 + df)) + 1).

    The weights are fitted on ``entities`` or, if given, on ``fitted_on`` (a training split); vectors are made only of the entities that stand in pairs.
    """
    spans = F.when(F.length("t") < n, F.array("t")).otherwise(F.transform(F.sequence(F.lit(1), F.length("t") - n + 1), lambda i: F.substring(F.col("t"), i, n)))
    text = lambda df: df.filter(F.col(col) != "").select("entity_id", F.col(col).alias("t"))
    base = text(entities if fitted_on is None else fitted_on)
    df = base.select(F.explode(F.array_distinct(spans)).alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("df"))
    total = F.lit(base.count())
    used = pairs.select(F.col("s1_id").alias("entity_id")).union(pairs.select("other_id")).distinct()
    tf = text(entities).join(used, "entity_id", "left_semi").select("entity_id", F.explode(spans).alias("g")).groupBy("entity_id", "g").agg(F.count(F.lit(1)).alias("tf"))
    w = tf.join(df, "g", "left").select("entity_id", "g", (F.col("tf") * (F.log((total + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1)).alias("w"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x["w"] * x["w"]))
    vec = settle(w.groupBy("entity_id").agg(F.array_sort(F.collect_list(F.struct("g", "w"))).alias("v")).select("entity_id", F.col("v.g").alias("g"), F.transform("v", lambda x: x["w"] / norm).alias("w")))  # a text's own grams: bounded by its length
    left, right = vec.toDF("s1_id", "g1", "w1"), vec.toDF("other_id", "g2", "w2")
    both = pairs.select("s1_id", "other_id", "source").join(left, "s1_id", "left").join(right, "other_id", "left")
    # products in the order of the grams, so that sums are the same on every run
    shared = F.array_intersect("g1", "g2")
    at = lambda g, w, x: F.element_at(w, F.array_position(g, x).cast("int"))
    dot = F.aggregate(shared, F.lit(0.0), lambda acc, x: acc + at("g1", F.col("w1"), x) * at("g2", F.col("w2"), x))
    return both.select("s1_id", "other_id", "source", F.round(F.coalesce(dot, F.lit(0.0)), 6).alias("cosine"))

"""Normalised entities, their tokens, the work set, and audits of the inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftlink.functions import normalize as nz


def normalize(df: DataFrame, expand: bool = True, fold_accents: bool = False) -> DataFrame:
    """The 12 columns of a normalised entity, one row for each input row; nothing is null."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    name, address = nz.name_norm(F.col("business_name"), expand, fold_accents), nz.address_norm(F.col("business_address"), expand, fold_accents)
    raw = df.select(F.col("entity_id"), text("business_name").alias("business_name"), text("business_address").alias("business_address"), text("country").alias("country"))
    out = raw.withColumns({"name_norm": name, "addr_norm": address})
    return out.select(
        "entity_id", "business_name", "business_address", "country", "name_norm", nz.alnum(F.col("name_norm")).alias("name_alnum"), "addr_norm", nz.postal(F.col("business_address")).alias("postal"),
        nz.first(F.col("name_norm")).alias("name_first"), nz.first2(F.col("name_norm")).alias("name_first2"), nz.first(F.col("addr_norm")).alias("addr_first"), nz.first2(F.col("addr_norm")).alias("addr_first2"),
    )


def keyed(normalized: DataFrame) -> DataFrame:
    """One row for each entity_id (the least value of each column where rows repeat it), with ``source`` S1, S2 or S3 and ``ckey``, the country as compared."""
    cols = ["name_norm", "addr_norm", "postal", "name_first2", "addr_first2"]
    one = normalized.groupBy("entity_id").agg(*[F.min(c).alias(c) for c in cols], F.min(nz.country_key(F.col("country"))).alias("ckey"))
    return one.withColumn("source", F.substring("entity_id", 1, 2))


def tokens(normalized: DataFrame, field: str, distinct: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """(entity_id, token, *carry): words of ``field`` of three letters and more that are no stopwords; a bag unless ``distinct``."""
    rows = normalized.select("entity_id", *carry, F.explode(F.split(field, " ")).alias("token"))
    kept = rows.filter((F.length("token") >= 3) & ~F.col("token").isin(nz.STOPWORDS))
    return kept.distinct() if distinct else kept


def workset(s1: DataFrame, total: int, val: int, val_share: int = 20) -> DataFrame:
    """(entity_id, split): md5 buckets below ``val_share`` are 'val', the others 'train'; of each the first by md5, ``val`` and ``total - val``."""
    split = s1.select("entity_id").distinct().withColumn("split", F.when(nz.md5_bucket(F.col("entity_id")) < val_share, "val").otherwise("train"))
    order = Window.partitionBy("split").orderBy(F.md5("entity_id"), "entity_id")
    most = F.when(F.col("split") == "val", val).otherwise(total - val)
    # the constant bound lets the plan keep only that many rows a task before the shuffle
    return split.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= max(val, total - val)).filter(F.col("rn") <= most).select("entity_id", "split")


def entity_split(s1: DataFrame, share: float = 0.2) -> DataFrame:
    """(entity_id, split): a validation set of ``max(1, int(n * share))`` entities, the first by md5.

    Counts by the first three hex digits of the md5 (4,096 numbers) tell the range in which the cut lies; only that range is ranked.
    """
    ids = s1.select("entity_id").distinct().withColumns({"h": F.md5("entity_id"), "r": F.substring(F.md5("entity_id"), 1, 3)})
    counts = sorted((r["r"], r["count"]) for r in ids.groupBy("r").count().collect())
    left, edge = max(1, int(sum(n for _, n in counts) * share)), ""
    for edge, n in counts:
        if n >= left:
            break
        left -= n
    last = ids.filter(F.col("r") == edge).withColumn("rn", F.row_number().over(Window.partitionBy("r").orderBy("h", "entity_id")))
    ranked = last.select("entity_id", F.when(F.col("rn") <= left, "val").otherwise("train").alias("split"))
    return ids.filter(F.col("r") != edge).select("entity_id", F.when(F.col("r") < edge, "val").otherwise("train").alias("split")).unionByName(ranked)


def audit(sources: DataFrame) -> DataFrame:
    """Per source: rows, distinct ids, repeated ids, blank countries, countries. ``sources`` has ``source`` besides the raw columns."""
    blank = F.trim(F.coalesce("country", F.lit(""))) == ""
    return sources.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("entity_id").alias("n_ids"),
        (F.count(F.lit(1)) - F.countDistinct("entity_id")).alias("n_repeated"),
        F.count_if(blank).alias("blank_country"),
        F.countDistinct(F.when(~blank, F.col("country"))).alias("n_countries"),
    )


def audit_missing(sources: DataFrame) -> DataFrame:
    """(source, field, missing): null or blank fields."""
    fields = ["business_name", "business_address", "country"]
    flags = [F.struct(F.lit(c).alias("field"), (F.trim(F.coalesce(c, F.lit(""))) == "").cast("int").alias("m")) for c in fields]
    each = sources.select("source", F.explode(F.array(*flags)).alias("f"))
    return each.groupBy("source", F.col("f.field").alias("field")).agg(F.sum("f.m").alias("missing"))


def cardinality(truth: DataFrame, linked: DataFrame) -> DataFrame:
    """(s1_id, n_matches) of every entity of the ground truth, 0 where it has no match."""
    ids = truth.select(F.col("source1_entity_id").alias("s1_id")).distinct()
    n = linked.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n"))
    return ids.join(n, "s1_id", "left").select("s1_id", F.coalesce("n", F.lit(0)).alias("n_matches"))

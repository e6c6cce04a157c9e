"""Records that arrive in a stream, linked to stored entities by capped key blocks (a stream-static join)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.functions.normalize import country_key
from weftlink.operators.blocking import KEYS, TRAIN, BlockConfig
from weftlink.operators.entities import normalize


def linked(arrivals: DataFrame, stored: DataFrame, block: str = "exact_name", config: BlockConfig = TRAIN, countries: DataFrame | None = None) -> DataFrame:
    """(entity_id, s1_id, block) for each arriving raw record and stored entity (see ``keyed``) with an equal key and country.

    ``arrivals`` may be a stream: the only state is the static side. Keys with more stored postings than the cap are
    left out on that side, before the join. Records without a key meet nothing. ``countries`` (entity_id, country) are the
    rows of the arrivals as they are registered: an id in several rows is one entity, so each of its records is linked under
    the country of each of its rows, once a row. Without it a record has its own country only.
    """
    cols = list(KEYS[block][0])
    s = stored.select(F.col("entity_id").alias("s1_id"), "ckey", *cols)
    cap = config.posting.get(block)
    if cap is not None:
        few = s.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= cap).drop("n")
        s = s.join(few, cols, "left_semi")
    a = normalize(arrivals)
    for c in cols:
        a = a.filter(F.col(c) != "")
    if countries is None:
        a = a.withColumn("ckey", country_key(F.col("country")))
    else:
        a = a.select("entity_id", *cols).join(countries.select("entity_id", country_key(F.col("country")).alias("ckey")).hint("merge"), "entity_id")
    return a.select("entity_id", "ckey", *cols).join(s, [*cols, "ckey"]).select("entity_id", "s1_id", F.lit(block).alias("block"))

"""Variants of names that stand for one business: sparse cosine join, threshold, average linkage.

A business has one name at one place, so the same name elsewhere is another business. Names become weighted letter-n-gram vectors:

* Names at a whole place (postal code, house number, street) are joined inside it and clustered by average linkage: a place
  of up to ``AT_ONCE`` names in one task, a larger one by the distributed join and rounds. Both give the same clusters.
* A record whose address tells no whole place is joined with all names wherever they are. The join is exact: two names of
  the asked cosine share a prefix gram (rare grams first), and none is capped. Where parts of the place are known and
  agree, a lower cosine is asked for; where parts differ, nothing is. Of the businesses it comes near, the two nearest are kept
  (top-n with n = 2, which is all the decision needs), and it joins the first if that is clearly nearer than the second. Such records
  that meet no business are clustered with each other, with house number and code as vetoes.

Rows of equal name and place are folded into one before all joins and unfolded at the end.

Nulls: a record without name is in no pair. Rows that repeat an id are one record. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftlink.llm import names
from weftlink.llm.linkage import average_linkage, grouped
from weftlink.llm.places import places
from weftlink.operators.heavy_keys import fragment_replicate_join
from weftlink.session import Scope, release, settle

#: Average cosine of the names of a business at one place; cosine of two names of which one has no place; least cosine of a pair that counts in an average.
AT_PLACE, FREE, PAIR = 0.27, 0.75, 0.15
#: Names of a place that are clustered in one task; a larger place is clustered by joins.
AT_ONCE = 500
#: How much nearer the nearest business must be than the second for a record without place.
MARGIN = 0.1


def records(df: DataFrame, key: str, name: str, address: str, country: str | None = None) -> DataFrame:
    """(id, name, address, country if asked for): one row for each id that has a name."""
    some = lambda c: F.max(F.when(F.trim(F.col(c)) != "", F.col(c)))
    cols = [some(name).alias("name"), some(address).alias("address"), *([some(country).alias("country")] if country else [])]
    return df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(*cols).filter(F.regexp_replace(F.coalesce("name", F.lit("")), r"[\s\p{Punct}]", "") != "")


def variants(df: DataFrame, key: str, name: str, address: str, at_place: float = AT_PLACE, free: float = FREE, at_once: int = AT_ONCE) -> DataFrame:
    """(id, cluster): the business of each record, named by its smallest id; records on their own have their own id."""
    spark = df.sparkSession
    with Scope() as scope:
        r = settle(names.cores(records(df, key, name, address), "name").drop("name"))
        p = places(r, "id", "address")
        place = [F.coalesce(c, F.lit("")).alias(c) for c in ("num", "postal", "street")]
        placed = r.join(p.withColumnRenamed("id", "pid"), r["id"] == F.col("pid"), "left").select("id", "core", *place)
        # the words of an address stand for its code only where they tell a whole place
        part = F.when(F.col("postal").startswith("?") & ((F.col("num") == "") | (F.col("street") == "")), "").otherwise(F.col("postal"))
        placed = settle(placed.withColumn("postal", part))
        for done in (r, p):
            release(done)
        same = ["core", "num", "postal", "street"]
        classes = settle(placed.groupBy(*same).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")).withColumn("cid", F.monotonically_increasing_id()))
        freq = spark.sparkContext.broadcast(names.frequencies(classes))
        whole = (F.col("num") != "") & (F.col("postal") != "") & (F.col("street") != "")
        at = classes.filter(whole).select(F.col("cid").alias("id"), F.concat_ws("|", "postal", "num", "street").alias("block"), "core", "n")
        solved = settle(grouped(at, freq, at_place, PAIR, at_once))
        known = solved.filter("cluster IS NOT NULL").select("id", "cluster")
        large = solved.filter("cluster IS NULL").select("id", "block", "core", "n")
        if not large.isEmpty():
            edges = names.similar(large, large, freq, PAIR, once=True).withColumnRenamed("cos", "s")
            rest = average_linkage(edges, at_place, large.select("id", "n"))
            known = known.unionByName(large.join(rest, "id", "left").select("id", F.coalesce("cluster", "id").alias("cluster")))
        known = settle(known)
        release(solved)
        far = settle(_without_place(classes.withColumn("whole", whole), freq, at_place, free))
        # of the businesses that fit, the nearest two
        lone = classes.filter(~whole)
        fits = far.join(known.select(F.col("id").alias("b"), "cluster"), "b").groupBy("a", "cluster").agg(F.max("cos").alias("cos"))
        order = Window.partitionBy("a").orderBy(F.desc("cos"), "cluster")
        two = fits.withColumn("rn", F.row_number().over(order)).filter("rn <= 2")
        nth = lambda k, c: F.max(F.when(F.col("rn") == k, F.col(c)))
        best = two.groupBy("a").agg(nth(1, "cluster").alias("cluster"), nth(1, "cos").alias("top"), nth(2, "cos").alias("second"))
        joined = settle(best.filter(f"second IS NULL OR top > second + {MARGIN}").select(F.col("a").alias("id"), "cluster"))
        # those that fit none, with each other
        marks = lone.select(F.col("cid").alias("id"), *[F.when(F.col(c) != "", F.xxhash64(c)).alias(m) for c, m in (("num", "x"), ("postal", "y"))])
        among = far.join(marks.select(F.col("id").alias("b")), "b", "left_semi").filter("a < b").select("a", "b", F.col("cos").alias("s"))
        groups = average_linkage(among, free, lone.select(F.col("cid").alias("id"), "n"), marks)
        apart = lone.select(F.col("cid").alias("id")).join(joined.hint("merge"), "id", "left_anti").join(groups, "id", "left")
        every = settle(known.unionByName(joined).unionByName(apart.select("id", F.coalesce("cluster", "id").alias("cluster"))))
        # the smallest id of each cluster, over narrow rows
        named = every.withColumnRenamed("id", "cid").join(classes.select("cid", "rep"), "cid")
        named = settle(named.join(named.groupBy("cluster").agg(F.min("rep").alias("name")).hint("merge"), "cluster").select("cid", F.col("name").alias("cluster")))
        # a class of very many copies is one row on this side, so its join can be split
        named = settle(classes.select("cid", *same).join(named, "cid").drop("cid"))
        release(classes)
        return scope.keep(placed.join(named.hint("merge"), same).select("id", "cluster"))


def _without_place(classes: DataFrame, freq, at_place: float, free: float) -> DataFrame:
    """(a, b, cos): classes ``a`` without a whole place and the classes ``b`` their names come near to; ``cos`` is raised where parts of the place agree."""
    # over distinct names first: a name at very many places is one row
    core = settle(classes.groupBy("core").agg((~F.min("whole")).alias("lone")).withColumn("id", F.monotonically_increasing_id()).withColumn("block", F.lit("")))
    alike = names.similar(core.filter("lone"), core, freq, free)
    alike = settle(alike.unionByName(core.filter("lone").select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("cos"))))
    of = core.select("id", "core")
    text = alike.join(of.withColumnsRenamed({"id": "a", "core": "ca"}), "a").join(of.withColumnsRenamed({"id": "b", "core": "cb"}), "b").select("ca", "cb", "cos")
    x, y = (classes.select(*[F.col(c).alias(f"{c}_{k}") for c in ("cid", "core", "num", "postal", "street", "whole")]) for k in "ab")
    differ = lambda c: (F.col(f"{c}_a") != "") & (F.col(f"{c}_b") != "") & (F.col(f"{c}_a") != F.col(f"{c}_b"))
    agree = lambda c: (F.col(f"{c}_a") != "") & (F.col(f"{c}_a") == F.col(f"{c}_b"))
    pairs = x.filter("NOT whole_a").join(text.hint("merge"), F.col("core_a") == F.col("ca")).join(y, F.col("core_b") == F.col("cb"))
    near = pairs.filter((F.col("cid_a") != F.col("cid_b")) & ~differ("num") & (~differ("postal") | F.col("postal_b").startswith("?")))
    lift = free - at_place
    partly = agree("num") & (agree("postal") | agree("street"))
    far = near.select(F.col("cid_a").alias("a"), F.col("cid_b").alias("b"), F.least(F.lit(1.0), F.col("cos") + F.when(partly, lift).otherwise(0.0)).alias("cos"))
    # half a place in common: house number and code, or house number and street
    halves = F.array_compact(F.array(F.when(F.col("postal") != "", F.concat(F.lit("c"), "postal")), F.when(F.col("street") != "", F.concat(F.lit("s"), "street"))))
    half = classes.filter("num <> ''").select(F.col("cid").alias("id"), "core", "num", "postal", "whole", F.explode(halves).alias("h")).withColumn("block", F.concat_ws("|", "num", "h"))
    asked = half.filter("NOT whole")
    met = half.join(asked.select("block").distinct().hint("merge"), "block", "left_semi")
    close = names.similar(asked, met, freq, at_place)
    codes = classes.select("cid", "postal")
    close = close.join(codes.toDF("a", "pa"), "a").join(codes.toDF("b", "pb"), "b").filter("pa = '' OR pb = '' OR pa = pb OR startswith(pb, '?')")
    return far.unionByName(close.select("a", "b", F.least(F.lit(1.0), F.col("cos") + lift).alias("cos"))).groupBy("a", "b").agg(F.max("cos").alias("cos"))


def cluster_pairs(clusters: DataFrame, a: str = "entity_id_a", b: str = "entity_id_b") -> DataFrame:
    """All pairs of a cluster, the smaller id first: what is asked for where every pair is a result. A cluster of very many records is split over tasks."""
    x = clusters.select("cluster", F.col("id").alias(a))
    pairs = fragment_replicate_join(x, clusters.select("cluster", F.col("id").alias(b)), ["cluster"], a)
    return pairs.filter(F.col(a) < F.col(b)).select(a, b)

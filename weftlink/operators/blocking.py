"""Candidate pairs: capped key and token blocks, evidence strength, bounded candidates.

All other sources are blocked in one pass: ``source`` is part of every key, count and ranking, so each source
keeps its own caps. Posting caps are applied before a join; they bound what a key can produce, so no key is hot. The
per-entity caps are row numbers with a constant bound, which Spark applies before the shuffle too.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftlink.operators.entities import tokens
from weftlink.operators.heavy_keys import fragment_replicate_join
from weftlink.session import settle

# Flags, the columns of their keys and the posting caps; weights of the flags; bonus for each flag after the first.
KEYS = {
    "exact_name": (("name_norm",), 1000), "exact_address": (("addr_norm",), 2000), "postal": (("postal",), 5000), "first2": (("name_first2",), 1000),
    "name_postal": (("name_norm", "postal"), 3000), "addr_postal": (("addr_norm", "postal"), 3000),
}
TOKEN_FIELDS = {"name_token": ("name_norm", 2), "address_token": ("addr_norm", 1)}
STRENGTH = {"exact_name": 100, "exact_address": 95, "name_postal": 90, "addr_postal": 85, "postal": 70, "name_token": 65, "address_token": 60, "first2": 40}
BONUS = 20
FLAGS = ["exact_name", "exact_address", "postal", "first2", "name_postal", "addr_postal", "name_token", "address_token"]
TEST_ORDER = ["exact_name", "exact_address", "postal", "name_token", "address_token", "first2"]


@dataclass(frozen=True)
class BlockConfig:
    """Caps of blocking. ``None`` lifts a cap."""

    posting: dict[str, int | None] = field(default_factory=lambda: {k: cap for k, (_, cap) in KEYS.items()})
    token_posting: int | None = 500
    token_share: float | None = None  # of the other source's entities
    min_shared: dict[str, int] = field(default_factory=lambda: {k: n for k, (_, n) in TOKEN_FIELDS.items()})
    per_block: int | None = 40
    final: int = 150
    keys: tuple[str, ...] = tuple(KEYS)
    extended: bool = True
    distinct_tokens: bool = False
    country: bool = True  # equality required; else countries are left to the features
    order: str = "strength"  # or "flags": by TEST_ORDER


TRAIN = BlockConfig()
TEST_AS_WRITTEN = replace(TRAIN, posting=dict.fromkeys(KEYS), token_posting=None, token_share=0.0015, min_shared=dict.fromkeys(TOKEN_FIELDS, 1), per_block=None, keys=("exact_name", "exact_address", "postal", "first2"), order="flags")


def _top(df: DataFrame, n: int | None, *order: Column) -> DataFrame:
    if n is None:
        return df
    w = Window.partitionBy("s1_id", "source").orderBy(*order)
    return df.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n).drop("rn")


def _on(config: BlockConfig) -> list[str]:
    return ["ckey"] if config.country else []


def key_block(s1: DataFrame, others: DataFrame, block: str, config: BlockConfig = TRAIN) -> DataFrame:
    """(s1_id, other_id, source) of pairs with an equal, non-empty key in few enough postings."""
    cols = list(KEYS[block][0])
    filled = reduce(lambda a, b: a & b, [F.col(c) != "" for c in cols])
    o = others.filter(filled).select(F.col("entity_id").alias("other_id"), "source", "ckey", *cols)
    cap = config.posting.get(block)
    if cap is not None:  # postings are counted whatever the country
        few = o.groupBy("source", *cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= cap).drop("n")
        o = o.join(few, ["source", *cols], "left_semi")
    s = s1.filter(filled).select(F.col("entity_id").alias("s1_id"), "ckey", *cols)
    if config.per_block is None:  # nothing bounds a key here, so the frequent ones are split
        return fragment_replicate_join(o, s, [*cols, *_on(config)], "other_id").select("s1_id", "other_id", "source")
    # of a key only the first few by other_id can be kept by anyone, so the others go before the join
    first = Window.partitionBy("source", *cols, *_on(config)).orderBy("other_id")
    o = o.withColumn("rn", F.row_number().over(first)).filter(F.col("rn") <= config.per_block).drop("rn")
    return _top(s.join(o, [*cols, *_on(config)]).select("s1_id", "other_id", "source"), config.per_block, F.col("other_id"))


def _rare(o: DataFrame, others: DataFrame, config: BlockConfig) -> DataFrame:
    """(source, token) of the tokens in ``o`` that have few enough postings."""
    few = o.groupBy("source", "token").agg(F.count(F.lit(1)).alias("n"))
    if config.token_posting is not None:
        few = few.filter(F.col("n") <= config.token_posting)
    if config.token_share is not None:
        size = others.groupBy("source").agg((F.count(F.lit(1)) * F.lit(config.token_share)).alias("most"))
        few = few.join(F.broadcast(size), "source").filter(F.col("n") <= F.col("most"))  # one row a source
    return few.select("source", "token")


def token_block(s1: DataFrame, others: DataFrame, block: str, config: BlockConfig = TRAIN) -> DataFrame:
    """(s1_id, other_id, source) of pairs that share enough rare tokens, the most first; repeated tokens count each time."""
    col = TOKEN_FIELDS[block][0]
    a = tokens(s1, col, config.distinct_tokens, ("ckey",)).withColumnRenamed("entity_id", "s1_id")
    o = tokens(others, col, config.distinct_tokens, ("ckey", "source")).withColumnRenamed("entity_id", "other_id")
    o = o.join(_rare(o, others, config), ["source", "token"], "left_semi")
    pairs = a.join(o, ["token", *_on(config)]).groupBy("s1_id", "other_id", "source").agg(F.count(F.lit(1)).alias("shared")).filter(F.col("shared") >= config.min_shared[block])
    return _top(pairs, config.per_block, F.desc("shared"), F.col("other_id")).select("s1_id", "other_id", "source")


def raw_blocks(s1: DataFrame, others: DataFrame, config: BlockConfig = TRAIN) -> DataFrame:
    """All block hits, one flag set in each. Both sides are read once for each block, so they are written down first."""
    s1, others = settle(s1), settle(others)
    hits = [(b, key_block(s1, others, b, config)) for b in config.keys]
    if config.extended:
        hits += [(b, token_block(s1, others, b, config)) for b in TOKEN_FIELDS]
    return reduce(DataFrame.unionByName, [df.select("s1_id", "other_id", "source", *[F.lit(int(f == b)).alias(f) for f in FLAGS]) for b, df in hits])


def consolidate(raw: DataFrame) -> DataFrame:
    """One row a pair, flags OR-ed; an unset or null flag is 0, rows without other_id are left out."""
    return raw.filter("other_id IS NOT NULL").groupBy("s1_id", "other_id", "source").agg(*[F.max(F.coalesce(f, F.lit(0))).alias(f) for f in FLAGS])


def strength() -> Column:
    total = reduce(lambda a, b: a + b, [F.col(f) for f in FLAGS])
    return (reduce(lambda a, b: a + b, [F.col(f) * w for f, w in STRENGTH.items()]) + BONUS * F.greatest(total - 1, F.lit(0))).cast("int")


def bounded(pairs: DataFrame, config: BlockConfig = TRAIN) -> DataFrame:
    """The strongest candidates of each entity and source, at most ``final``."""
    if config.order == "flags":
        return _top(pairs, config.final, *[F.desc(f) for f in TEST_ORDER], F.col("other_id"))
    return _top(pairs.withColumn("strength", strength()), config.final, F.desc("strength"), F.col("other_id"))


#: Added to the ids of frequent keys, so that the least of some ids is one of a key that is not, if there is any.
_FREQUENT = 1 << 60


def _keys(df: DataFrame, config: BlockConfig, *carry: str) -> DataFrame:
    """(entity_id, ckey, *carry, block, key): the filled keys of each entity, ``block`` by place in TEST_ORDER; each token once."""
    country = F.col("ckey") if config.country else F.lit("")
    fields = F.array(*[F.struct(F.lit(TEST_ORDER.index(b)).alias("block"), F.col(KEYS[b][0][0]).alias("key")) for b in config.keys])
    return df.select("entity_id", country.alias("ckey"), *carry, F.inline(fields)).filter(F.col("key") != "")


def _token_keys(df: DataFrame, config: BlockConfig, block: str, *carry: str) -> DataFrame:
    country = F.col("ckey") if config.country else F.lit("")
    rows = tokens(df, TOKEN_FIELDS[block][0], config.distinct_tokens, ("ckey", *carry))
    return rows.select("entity_id", country.alias("ckey"), *carry, F.lit(TEST_ORDER.index(block)).alias("block"), F.col("token").alias("key"))


def _each_with_each(sets: Column, more: Column) -> Column:
    return F.flatten(F.transform(sets, lambda a: F.transform(more, lambda b: F.concat(a, b))))


def _postings(rows: DataFrame, ids: DataFrame, *entity: str) -> DataFrame:
    """Each entity with the ids of its keys by block (an array where a block has several) and ``at``, the sets of keys it is posted at.
    ``filled`` is the first block of a key with ``full``, ``first_block`` that of the set, which is ``frequent`` or one other key.

    It is posted at each key that is not frequent, and at each choice of at most one frequent key a block.
    """
    of = lambda j: F.when(F.col("block") == j, F.col("id"))
    several = {TEST_ORDER.index(b) for b in TOKEN_FIELDS}
    filled = F.coalesce(F.min(F.when(F.col("full"), F.col("block"))), F.lit(len(TEST_ORDER))).alias("filled")
    known = rows.join(ids, ["ckey", "block", "key"]).groupBy(*entity).agg(filled, *[(F.collect_set(of(j)) if j in several else F.max(of(j))).alias(f"k{j}") for j in range(len(TEST_ORDER))])
    every = [F.col(f"k{j}") if j in several else F.array_compact(F.array(f"k{j}")) for j in range(len(TEST_ORDER))]
    alone = F.transform(F.filter(F.flatten(F.array(*every)), lambda x: x < _FREQUENT), lambda x: F.array(x))
    sets = F.array(F.array().cast("array<bigint>"))
    for k in every:
        more = F.concat(F.array(F.array().cast("array<bigint>")), F.transform(F.filter(k, lambda x: x >= _FREQUENT), lambda x: F.array(x)))
        sets = _each_with_each(sets, more)
    at = F.filter(F.concat(alone, sets), lambda x: F.size(x) > 0)
    block = reduce(lambda rest, j: F.when(F.array_contains(every[j], F.col("ids")[0]), F.lit(j)).otherwise(rest), reversed(range(len(every))), F.lit(len(every)))
    rows = known.select("*", F.explode(at).alias("ids")).withColumns({"first_block": block, "frequent": F.col("ids")[0] >= _FREQUENT})
    return rows.withColumn("at", F.array_join(F.col("ids").cast("array<string>"), ",")).drop("ids")


def ranked_by_flags(s1: DataFrame, others: DataFrame, config: BlockConfig = TEST_AS_WRITTEN) -> DataFrame:
    """The candidates of blocks without any cap, ranked by flags and bounded, without all pairs of a frequent key.

    A pair's flags are a set of equal keys. Whatever shares this set ranks no lower by flags, so of the entities posted at the
    set only the first ``final`` by other_id can be among the candidates. Frequent keys (more than ``final`` postings in a
    source) are therefore posted in sets, of which only those first ones are kept; other keys keep all postings. Every pair
    counts at one place: its least key that is not frequent, else the set of all its keys.
    """
    s1, others = settle(s1), settle(others)
    o, s = _keys(others, config, "source"), _keys(s1, config)
    for b in TOKEN_FIELDS if config.extended else ():
        t = tokens(others, TOKEN_FIELDS[b][0], config.distinct_tokens, ("source",))
        rare = _rare(t, others, config).withColumnRenamed("token", "key")
        o = o.unionByName(_token_keys(others, config, b, "source").distinct().join(rare, ["source", "key"], "left_semi"))
        s = s.unionByName(_token_keys(s1, config, b).distinct())
    o, s = settle(o), settle(s)
    key = ["ckey", "block", "key"]
    most, sources = F.count_if(F.col("n") >= config.final), others.select("source").distinct().count()
    n = o.groupBy(*key, "source").agg(F.count(F.lit(1)).alias("n")).groupBy(*key).agg(F.max("n").alias("n"), (most == sources).alias("full"))
    number = F.monotonically_increasing_id() + F.when(F.col("n") > config.final, F.lit(_FREQUENT)).otherwise(F.lit(0))
    ids = settle(n.join(s.select(*key).distinct(), key, "left_semi").select(*key, number.alias("id"), "full"))  # settled, since numbers change when rows are computed anew
    first = Window.partitionBy("source", "at").orderBy("other_id")
    right = _postings(o.withColumnRenamed("entity_id", "other_id"), ids, "other_id", "source")
    right = right.drop("filled", "first_block", "frequent")
    right = settle(right.withColumn("rn", F.row_number().over(first)).filter(F.col("rn") <= config.final).drop("rn"))
    # a key with ``final`` postings in every source fills the ranks, so pairs whose first flag comes after it are no candidates
    left = _postings(s.withColumnRenamed("entity_id", "s1_id"), ids, "s1_id")
    left = settle(left.filter((F.col("first_block") <= F.col("filled")) | ~F.col("frequent")).drop("first_block", "frequent"))
    pairs = fragment_replicate_join(left, right, ["at"], "s1_id")
    tokens_at = {TEST_ORDER.index(b) for b in TOKEN_FIELDS}
    same = [F.array_min(F.array_intersect(f"k{j}", f"k{j}_r")) if j in tokens_at else F.when(F.col(f"k{j}") == F.col(f"k{j}_r"), F.col(f"k{j}")) for j in range(len(TEST_ORDER))]
    pairs = pairs.select("s1_id", "other_id", "source", "at", "filled", *[x.alias(f"x{j}") for j, x in enumerate(same)])
    each = [F.col(f"x{j}") for j in range(len(TEST_ORDER))]
    in_reach = reduce(lambda a, b: a | b, [each[j].isNotNull() & (F.col("filled") >= j) for j in range(len(each))])
    home = F.when(F.least(*each) < _FREQUENT, F.least(*each).cast("string")).otherwise(F.concat_ws(",", *[x.cast("string") for x in each]))
    rank = reduce(lambda a, b: a + b, [x.isNotNull().cast("int") * (1 << len(each) - 1 - j) for j, x in enumerate(each)])  # the flags in one number
    pairs = pairs.filter(F.col("at") == home).filter(in_reach).select("s1_id", "other_id", "source", rank.alias("rank"))
    flag = lambda f: F.col("rank").bitwiseAND(1 << len(each) - 1 - TEST_ORDER.index(f)).cast("boolean").cast("int") if f in TEST_ORDER else F.lit(0)
    return _top(pairs, config.final, F.desc("rank"), F.col("other_id")).select("s1_id", "other_id", "source", *[flag(f).alias(f) for f in FLAGS])


def candidates(s1: DataFrame, others: DataFrame, config: BlockConfig = TRAIN) -> DataFrame:
    uncapped = config.per_block is None and not any(config.posting.get(b) for b in config.keys) and max(config.min_shared.values()) == 1
    if config.order == "flags" and uncapped and set(config.keys) <= set(TEST_ORDER):
        return ranked_by_flags(s1, others, config)
    return bounded(consolidate(raw_blocks(s1, others, config)), config)

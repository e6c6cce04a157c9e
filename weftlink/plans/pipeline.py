"""The stages of a linkage run, each a plan over stored tables: audit, prepare, block, validate, predict.

Stored tables are keyed by the configuration and the tables they come from, so a changed setting never meets a stale table.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.operators import blocking, entities, features, matching
from weftlink.sources.tables import TRUTH, Store, links, read_source, read_tsv, write_tsv


@dataclass
class Config:
    data: str  # has train/ and test/
    artifacts: str
    out: str
    train_entities: int = 40_000
    val_entities: int = 10_000
    trees: int = 300
    depth: int = 7
    train_blocks: blocking.BlockConfig = field(default_factory=blocking.BlockConfig)
    test_blocks: blocking.BlockConfig = field(default_factory=blocking.BlockConfig)  # the same as in training; TEST_AS_WRITTEN is the other choice
    refit_mined: bool = False  # weigh negatives that the first model takes for matches, and fit again


class Run:
    def __init__(self, spark: SparkSession, config: Config):
        self.spark, self.config, self.store = spark, config, Store(spark, config.artifacts)

    # -- inputs
    def raw(self, part: str) -> DataFrame:
        frames = [read_source(self.spark, f"{self.config.data}/{part}/{part}_source{k}.tsv").withColumn("source", F.lit(f"S{k}")) for k in (1, 2, 3)]
        return reduce(DataFrame.unionByName, frames)

    def truth(self) -> DataFrame:
        return read_tsv(self.spark, f"{self.config.data}/train/train_ground_truth.tsv", TRUTH, False)

    def normalized(self, part: str) -> DataFrame:
        """One row for each entity of all sources, keyed for blocking."""
        return self.store.table(f"{part}_entities", {"data": self.config.data}, lambda: entities.keyed(entities.normalize(self.raw(part))))

    def workset(self) -> DataFrame:
        c = self.config
        return self.store.table("workset", {"data": c.data, "n": [c.train_entities, c.val_entities]}, lambda: entities.workset(self.normalized("train").filter("source = 'S1'"), c.train_entities, c.val_entities))

    # -- stages
    def audit(self) -> dict:
        """Rows, ids, blank countries and cardinalities of the inputs, also as JSON."""
        truth = self.truth()
        c = entities.cardinality(truth, links(truth))
        rows = truth.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("source1_entity_id").alias("ids")).first().asDict()
        stats = c.agg(F.sum("n_matches").alias("links"), F.max("n_matches").alias("most"), F.count_if(F.col("n_matches") == 0).alias("without")).first().asDict()
        out = {"sources": {p: [r.asDict() for r in entities.audit(self.raw(p)).orderBy("source").collect()] for p in ("train", "test")}, "ground_truth": rows | stats}
        self.store.write_json("audit", out)
        return out

    def block(self, part: str) -> DataFrame:
        """Candidates of the work set's entities (train) or of all entities (test)."""
        c = self.config
        config = c.train_blocks if part == "train" else c.test_blocks
        key = {"data": c.data, "blocks": asdict(config), "n": [c.train_entities, c.val_entities] if part == "train" else None}

        def make() -> DataFrame:
            e = self.normalized(part)
            s1 = e.filter("source = 'S1'")
            if part == "train":
                s1 = s1.join(self.workset(), "entity_id", "left_semi")
            return blocking.candidates(s1, e.filter("source <> 'S1'"), config)

        return self.store.table(f"{part}_candidates", key, make)

    def pair_features(self, part: str) -> DataFrame:
        c = self.config
        config = c.train_blocks if part == "train" else c.test_blocks
        key = {"data": c.data, "blocks": asdict(config), "n": [c.train_entities, c.val_entities] if part == "train" else None}
        return self.store.table(f"{part}_features", key, lambda: features.features(self.block(part), self.normalized(part)))

    def validate(self) -> dict:
        """Fit on the training split, choose the threshold on the validation split; saves model, curve and threshold."""
        truth = links(self.truth())
        split = self.workset().withColumnRenamed("entity_id", "s1_id")
        rows = matching.label(self.pair_features("train"), truth).join(split, "s1_id")
        sample = matching.sample_weights(matching.train_sample(rows.filter("split = 'train'")))
        model = matching.fit(sample, self.config.trees, self.config.depth)
        val = rows.filter("split = 'val'")
        scored = matching.score(model, val).join(val.select("s1_id", "other_id", "label"), ["s1_id", "other_id"])
        if self.config.refit_mined:
            sample = matching.sample_weights(matching.train_sample(rows), matching.mined(scored))
            model_out = matching.fit(sample, self.config.trees, self.config.depth)
        else:
            model_out = model
        ids = split.filter("split = 'val'").select("s1_id")
        own_truth = truth.join(ids, "s1_id", "left_semi")
        curve = matching.threshold_curve(ids, own_truth, scored)
        best = matching.best_threshold(curve).first()
        found = matching.recall(self.block("train").join(ids, "s1_id", "left_semi"), own_truth, self.normalized("train").filter("source <> 'S1'"))
        model_out.write().overwrite().save(f"{self.config.artifacts}/model")
        write_tsv(curve, f"{self.config.artifacts}/threshold_curve", "threshold")
        out = {"threshold": best["threshold"], "macro_f05": best["macro_f05"], "candidate_recall": {r["part"]: r["recall"] for r in found.collect()}}
        self.store.write_json("best_threshold", out)
        return out

    def predict(self) -> dict[str, int]:
        """Score the test candidates and write both lists; raises if a check of the outputs fails."""
        model = PipelineModel.load(f"{self.config.artifacts}/model")
        least = self.store.read_json("best_threshold")["threshold"]
        scored = matching.score(model, self.pair_features("test"))
        predicted = scored.filter(F.col("proba") >= least)
        ids = self.normalized("test").filter("source = 'S1'").select(F.col("entity_id").alias("s1_id"))
        candidates = self.block("test")
        results = matching.listed(ids, predicted, "matched_entity_ids")
        bad = {r["check"]: r["bad"] for r in matching.output_checks(results, ids, predicted, candidates).collect()}
        if any(bad.values()):
            raise ValueError(f"outputs are not valid: {bad}")
        write_tsv(results, f"{self.config.out}/matching_results", "source1_entity_id")
        write_tsv(matching.listed(ids, candidates, "candidate_entity_ids"), f"{self.config.out}/candidate_pairs", "source1_entity_id")
        return bad

    def all(self) -> dict:
        self.audit()
        out = self.validate()
        self.predict()
        return out

import json

import oracle
import pandas as pd
from conftest import SMALL

from weftlink.__main__ import main
from weftlink.operators.entities import keyed, normalize
from weftlink.plans.pipeline import Config, Run
from weftlink.queries import ORACLE, QUERIES
from weftlink.streaming.incremental import linked


def tsv(spark, tmp_path):
    for part in ("train", "test"):
        (tmp_path / part).mkdir()
        for k in (1, 2, 3):
            pd.read_parquet(f"{SMALL}/train_source{k}.parquet").drop_duplicates("entity_id").to_csv(tmp_path / part / f"{part}_source{k}.tsv", sep="\t", index=False)
    t = pd.read_parquet(f"{SMALL}/train_matches.parquet").drop_duplicates("source1_entity_id")
    t["matched_entity_ids"] = t.matched_entity_ids.fillna("").str.findall(r"S[23]-\d{9}").str.join(",")
    t.to_csv(tmp_path / "train" / "train_ground_truth.tsv", sep="\t", index=False)


def test_all_stages(spark, tmp_path):
    tsv(spark, tmp_path)
    base = f"file://{tmp_path}"
    common = ["--data", base, "--artifacts", f"{base}/a", "--out", f"{base}/out", "--train-entities", "200", "--val-entities", "60"]
    main([*common, "--stage", "audit"])
    small = Config(base, f"{base}/a", f"{base}/out", 200, 60, trees=20, depth=4, refit_mined=True)
    Run(spark, small).all()
    ids = pd.read_parquet(f"{SMALL}/train_source1.parquet").entity_id.nunique()
    parts = [f.read_text().splitlines() for f in sorted((tmp_path / "out" / "matching_results").glob("part-*"))]
    results = [line for lines in parts for line in lines[1:]]
    assert len(results) == ids and results == sorted(results) and parts[0][0] == "source1_entity_id\tmatched_entity_ids"
    best = json.loads("".join(f.read_text() for f in (tmp_path / "a" / "best_threshold.json").glob("part-*")))
    assert 0.3 <= best["threshold"] <= 0.98 and best["macro_f05"] > 0.3


def test_stream_equals_batch(spark, tmp_path):
    src = spark.read.parquet(f"{SMALL}/train_source2.parquet")
    src.repartition(2).write.parquet(str(tmp_path / "in"))
    stored = keyed(spark.read.parquet(f"{SMALL}/normalized_entity.parquet")).filter("source = 'S1'")
    q = linked(spark.readStream.schema(src.schema).parquet(str(tmp_path / "in")), stored).writeStream.format("memory").queryName("arrived").start()
    q.processAllAvailable()
    q.stop()
    got, batch = spark.table("arrived"), linked(src, stored)
    assert got.count() == batch.count() > 0 and got.exceptAll(batch).count() == 0


def test_repeated_ids_in_a_stream_equal_sql(spark, tmp_path):
    """An id in two rows is linked by each of its names under the country of each of its rows."""
    cols = ["entity_id", "business_name", "business_address", "country"]
    arriving = [("S2-1", "Acme Ltd", "1 A st", "US"), ("S2-1", "Acme Ltd", "1 A st", " us"), ("S2-2", "Acme Ltd", "", "IN"), ("S2-2", "Bolt Co", "", "US"), ("S2-3", "Bolt Co", "", None), ("S2-4", None, "", "US")]
    stored = [("S1-1", "Acme Ltd", "", "us"), ("S1-2", "Bolt Co", "", "US"), ("S1-3", "bolt company", "", None)]
    for k, rows in ((1, stored), (2, arriving), (3, [("S3-1", "Acme Ltd", "", "US")])):
        pd.DataFrame(rows, columns=cols).to_parquet(tmp_path / f"train_source{k}.parquet")
    raw = spark.createDataFrame(stored + arriving, "entity_id string, business_name string, business_address string, country string")
    normalize(raw).toPandas().to_parquet(tmp_path / "normalized_entity.parquet")
    assert oracle.differences(spark, oracle.connect(str(tmp_path)), QUERIES["incremental_links"], ORACLE["incremental_links"], str(tmp_path)) == ""
    assert QUERIES["incremental_links"](spark, str(tmp_path)).count() == 7

"""python -m weftlink --data DIR --artifacts DIR --out DIR [--stage STAGE]"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession

from weftlink.operators.blocking import TEST_AS_WRITTEN, TRAIN
from weftlink.plans.pipeline import Config, Run
from weftlink.session import ship

STAGES = ["audit", "prepare-train", "block-train", "validate", "prepare-test", "predict", "all"]


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="weftlink", description=__doc__)
    p.add_argument("--data", required=True)
    p.add_argument("--artifacts", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--stage", choices=STAGES, default="all")
    p.add_argument("--train-entities", type=int, default=40_000)
    p.add_argument("--val-entities", type=int, default=10_000)
    p.add_argument("--no-extended-blocks", action="store_true", help="key blocks only, no token blocks")
    p.add_argument("--test-blocks-as-written", action="store_true", help="block the test set by the other rules")
    p.add_argument("--refit-mined", action="store_true")
    a = p.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    ship(spark)
    train = replace(TRAIN, extended=not a.no_extended_blocks)
    test = replace(TEST_AS_WRITTEN, extended=not a.no_extended_blocks) if a.test_blocks_as_written else train
    run = Run(spark, Config(a.data, a.artifacts, a.out, a.train_entities, a.val_entities, train_blocks=train, test_blocks=test, refit_mined=a.refit_mined))
    steps = {
        "audit": run.audit,
        "prepare-train": lambda: (run.normalized("train").count(), run.workset().count()),
        "block-train": lambda: run.block("train").count(),
        "validate": run.validate,
        "prepare-test": lambda: run.normalized("test").count(),
        "predict": run.predict,
        "all": run.all,
    }
    print(a.stage, steps[a.stage]())


if __name__ == "__main__":
    main()

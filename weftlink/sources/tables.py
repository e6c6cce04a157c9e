"""Reading and writing of the tab-separated inputs and outputs, and of stored intermediate tables."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftlink.operators.packed_values import unpack

SOURCE = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
TRUTH = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])
SCORED = T.StructType([*(T.StructField(c, T.StringType()) for c in ("s1_id", "other_id", "source")), T.StructField("proba", T.DoubleType())])


def read_tsv(spark: SparkSession, path: str, schema: T.StructType = SOURCE, empty_as_null: bool = True, multi_line: bool = False) -> DataFrame:
    """A tab-separated file with header. All columns come by the schema, none is inferred; quotes are doubled inside quotes.

    ``multi_line`` reads line ends inside quotes as text; a file is then one task.
    """
    options = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "multiLine": multi_line} | ({"nullValue": ""} if empty_as_null else {"nullValue": "\u0000", "emptyValue": ""})
    df = spark.read.schema(schema).options(**options).csv(path)
    return df if empty_as_null else df.na.fill("")


def read_source(spark: SparkSession, path: str) -> DataFrame:
    """A source as text without nulls."""
    return read_tsv(spark, path).na.fill("")


def links(truth: DataFrame) -> DataFrame:
    """(s1_id, other_id): the distinct ids of the packed lists, whatever their delimiters, quotes and brackets."""
    items = unpack(truth, ["source1_entity_id"], "matched_entity_ids", value="other_id")
    return items.select(F.col("source1_entity_id").alias("s1_id"), "other_id").distinct()


def write_tsv(df: DataFrame, path: str, *order: str) -> None:
    """Tab-separated files with header; with ``order`` each holds a range, and the part numbers follow it. Empty strings are written as nothing."""
    (df.orderBy(*order) if order else df).write.mode("overwrite").options(sep="\t", header=True, emptyValue="", quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


class Store:
    """Intermediate tables under one folder, keyed by what they were made from, so that nothing stale is reused."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def path(self, name: str, config: dict) -> str:
        key = hashlib.sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()[:16]
        return f"{self.root}/{name}-{key}"

    def exists(self, path: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def table(self, name: str, config: dict, make) -> DataFrame:
        """The stored table, made first if it isn't there."""
        path = self.path(name, config)
        if not self.exists(path):
            make().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def write_json(self, name: str, value: dict) -> None:
        row = self.spark.createDataFrame([(json.dumps(value, sort_keys=True),)], "value string")
        row.coalesce(1).write.mode("overwrite").text(f"{self.root}/{name}.json")

    def read_json(self, name: str) -> dict:
        return json.loads(self.spark.read.text(f"{self.root}/{name}.json").first()[0])

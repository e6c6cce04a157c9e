"""Occurrences and records of every distinct value, with a mark on the rare and the common ones.

1. A global integer dictionary: the distinct values, range-partitioned and sorted, get dense ids from
   their place in the partition plus the sizes of the partitions before it (one number a partition).
2. Rows are folded by (block, value), a block being a hash range of records, so that every record lies in one block
   and record presence adds up; a value in a tenth of all rows leaves at most one row a block. The folded
   rows are encoded by a join with the dictionary.
3. The encoded rows are partitioned by identifier range of ``WIDTH`` ids and sorted by it, so that a range lies in one task, with at most one
   row for each of its ids and blocks. A task adds the blocks' rows of a range into one pair of count arrays (occurrences, records),
   and turns it back into (id, value, n_rows, n_records) when the range ends: it never holds more than one pair.

Nulls: a null value is counted in no case and has no id; a null record counts as a row, not as a record. The empty
string is a value. Repeated rows count as rows and once as a record. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.session import Scope, settle, task_count

#: Ids in one count array.
WIDTH = 4096


def dictionary(df: DataFrame, value: str) -> DataFrame:
    """(id, value): dense ids from 0 in the order of the values' bytes."""
    values = df.select(F.col(value).alias("value")).filter(F.col("value").isNotNull()).distinct()
    parts = settle(values.repartitionByRange(task_count(df.sparkSession), "value").sortWithinPartitions("value").select("value", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("m")))
    sizes = dict(parts.groupBy("part").count().collect())  # one number a partition
    before, at = {}, 0
    for p in sorted(sizes):
        before[p], at = at, at + sizes[p]
    if not before:
        return parts.select(F.col("m").alias("id"), "value")
    # the low 33 bits of m number the rows of a partition
    start = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])
    return parts.select((F.col("m").bitwiseAND(F.lit((1 << 33) - 1)) + F.element_at(start, F.col("part"))).cast("long").alias("id"), "value")


def _summed(width: int):
    """Encoded rows (range, id, occ, rec), sorted by range, to the sums of each id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = -1, np.zeros((2, width), np.int64)

        def out() -> pa.RecordBatch:
            seen = np.flatnonzero(total[0])
            rows = pa.RecordBatch.from_arrays([pa.array(seen + at * width), pa.array(total[0][seen]), pa.array(total[1][seen])], ["id", "n_rows", "n_records"])
            total[:] = 0
            return rows

        for b in batches:
            spans, ids, occ, rec = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            cuts = np.flatnonzero(np.diff(spans)) + 1
            for part in np.split(np.arange(len(ids)), cuts) if len(ids) else ():
                if spans[part[0]] != at:
                    if at >= 0:
                        yield out()
                    at = int(spans[part[0]])
                place = ids[part] - at * width
                total[0] += np.bincount(place, occ[part], width).astype(np.int64)
                total[1] += np.bincount(place, rec[part], width).astype(np.int64)
        if at >= 0:
            yield out()

    return run


def value_counts(df: DataFrame, value: str, record: str, blocks: int | None = None, width: int = WIDTH) -> DataFrame:
    """(id, value, n_rows, n_records) of every distinct value."""
    tasks = task_count(df.sparkSession)
    blocks = blocks or 4 * tasks
    rows = df.select(F.col(value).alias("value"), F.col(record).alias("r")).filter(F.col("value").isNotNull())
    with Scope() as scope:
        words = settle(dictionary(rows, "value"))
        folded = (
            rows.groupBy("value", "r").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("value", F.pmod(F.xxhash64("r"), F.lit(blocks)).alias("block"))
            .agg(F.sum("n").alias("occ"), F.count("r").alias("rec"))
        )
        encoded = folded.join(words, "value").select((F.col("id") / width).cast("long").alias("range"), "id", "occ", "rec")
        counts = encoded.repartition(tasks, "range").sortWithinPartitions("range").mapInArrow(_summed(width), "id long, n_rows long, n_records long")
        return scope.keep(counts.hint("merge").join(words, "id").select("id", "value", "n_rows", "n_records"))


def marked(counts: DataFrame, n_records: int, rarest: int = 3, share: float = 0.01) -> DataFrame:
    """``counts`` with ``mark``: 'rare' below ``rarest`` records, 'common' above ``share`` of ``n_records``, else null."""
    limit = F.lit(n_records) * F.lit(share)
    return counts.withColumn("mark", F.when(F.col("n_records") < rarest, "rare").when(F.col("n_records") > limit, "common"))

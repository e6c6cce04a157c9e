"""Session settings and lineage cuts."""

from __future__ import annotations

import atexit
import os
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, memory: str = "12g", app: str = "weftlink") -> SparkSession:
    """A session for tests and benches on one machine."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, so that Python workers can import it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    here = Path(__file__).resolve().parent
    if not here.is_dir():  # already running from an archive
        return
    fd, archive = tempfile.mkstemp(prefix="weftlink-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, Path(here.name) / f.relative_to(here))
    kept = list(sys.path)
    sc.addPyFile(archive)
    sys.path[:] = kept  # the driver keeps importing the source tree
    atexit.register(lambda: Path(archive).unlink(missing_ok=True))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``. Where that is unset, a local session gets a temporary one; a cluster must set it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="weftlink-")
        spark.conf.set("spark.checkpoint.dir", root)
        atexit.register(_remove, spark, root)
    return root


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may be gone already
        pass


class Scope:
    """Tables settled within a ``with`` block; they are deleted at its end, but for the one that is kept.

    A scope inside another keeps its table for the outer one to delete.
    """

    open: list[Scope] = []

    def __init__(self) -> None:
        self.paths: dict[str, SparkSession] = {}
        self.kept = ""

    def __enter__(self) -> Scope:
        Scope.open.append(self)
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` settled as the result of the block."""
        out = settle(df)
        self.kept = out.settled_at
        return out

    def __exit__(self, *_) -> None:
        Scope.open.remove(self)
        for path, spark in self.paths.items():
            if path != self.kept:
                _remove(spark, path)
            elif Scope.open:
                Scope.open[-1].paths[path] = spark
            else:
                atexit.register(_remove, spark, path)


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries within are deleted as each query ends. Else they stay until the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def settle(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder as parquet and read it back: a lineage cut that outlives lost executors.

    Preferred to ``checkpoint()`` because the files are columnar and compressed, so later steps
    read only the columns and partitions they need. The size of compressed files says little about the memory their rows
    take, so the result asks for merge joins: it is never broadcast unless a join says so.
    """
    spark = df.sparkSession
    ship(spark)
    path = f"{shared_dir(spark)}/weftlink/{uuid.uuid4().hex}"
    out = df.write.option("compression", "zstd")
    if partition_by:
        out = out.partitionBy(*partition_by)
    with swept(spark):
        out.parquet(path)
    if Scope.open:
        Scope.open[-1].paths[path] = spark
    else:
        atexit.register(_remove, spark, path)
    back = spark.read.schema(df.schema).parquet(path).hint("merge")
    back.settled_at = path
    return back


def release(df: DataFrame) -> None:
    """Delete a settled table that no later step reads."""
    _remove(df.sparkSession, df.settled_at)


def task_count(spark: SparkSession) -> int:
    """Tasks of a wide stage: the session's shuffle partitions."""
    ship(spark)
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

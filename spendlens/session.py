"""Session helpers: a local session for tests and benchmarks, shared storage, scratch relations."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "spendlens",
    warehouse_dir: str | None = None,
) -> SparkSession:
    """A local[N] session with AQE, no UI, UTC, sized for tests and the benchmark."""
    builder = SparkSession.builder
    if warehouse_dir:
        builder = builder.config("spark.sql.warehouse.dir", warehouse_dir)
    spark = (
        builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small inputs: partitions of rebalanced writes small enough to fill the cores
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, for relations written between jobs.

    It is the one ``spark.checkpoint.dir`` names. A ``local[...]`` session without that setting
    (tests, one process on one machine) gets a scratch folder of its own; on a cluster a
    missing setting is an error, never a machine-local folder.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="spendlens-shared-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


class Scratch:
    """Relations written once for several readers, in a folder of their own in shared storage.

    Writing cuts the lineage: the files survive executor loss, later plans start from them (with
    exact size statistics for adaptive planning and column pruning on read), and a relation is
    computed exactly once (an eager ``checkpoint()`` of an uncached plan computes it twice).
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/spendlens-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def release(self) -> None:
        """Delete everything written; relations read from here can no longer be used."""
        delete_path(self.spark, self.root)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of the Hadoop API, whatever store the path is in."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def require_ansi(spark: SparkSession) -> None:
    """Fail where an overflowing cast or sum would give NULL (and a clamp then 0) unnoticed."""
    if str(spark.conf.get("spark.sql.ansi.enabled")).lower() != "true":
        raise RuntimeError("spark.sql.ansi.enabled must be true: without it overflows become NULL silently")

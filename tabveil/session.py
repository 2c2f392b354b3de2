"""Where intermediate tables live, and which sides may be broadcast."""

from __future__ import annotations

import gc
import hashlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only after its row count is known and at most this.
BROADCAST_ROWS = 500_000

_LOCAL_SCRATCH: dict[str, str] = {}


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="tabveil-")
    return _LOCAL_SCRATCH[app]


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives later steps column pruning. ``drop`` removes it.
    """
    kept, path = stage_at(df, label)
    kept.staged_path = path
    return kept


def stage_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/tabveil/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_staged(spark: SparkSession, path: str) -> None:
    """Remove one table written by ``stage_at`` that no later step reads."""
    if "/tabveil/" not in path:
        raise ValueError("not a staged table")
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(target, True)


def drop(*tables: DataFrame) -> None:
    """Remove tables of ``stage`` that nothing reads any more, and with them the shuffle files of jobs that are over."""
    for df in tables:
        drop_staged(df.sparkSession, df.staged_path)
    let_go(tables[0].sparkSession)


def let_go(spark: SparkSession) -> None:
    """Remove the shuffle files of jobs that are over.

    Spark removes those when the driver's garbage is collected, which a driver with little to do may not do for hours.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fingerprint(df: DataFrame) -> str:
    """Rows and the sum of their hashes: the same for the same rows in any order."""
    total = F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))
    return ":".join(map(str, df.agg(F.count(F.lit(1)), total).first()))


class Journal:
    """The finished rounds of a loop in a shared folder, from which a stopped job goes on.

    The place depends on what the loop is run with, so other settings or another input begin anew. A round counts once its write
    has been committed; the round before is removed then.
    """

    def __init__(self, spark: SparkSession, folder: str, loop: str, *run_with) -> None:
        key = hashlib.sha256("|".join(map(str, run_with)).encode()).hexdigest()[:32]
        self.spark, self.base = spark, f"{folder.rstrip('/')}/tabveil/{loop}-{key}"

    def _path(self, number: int) -> str:
        return f"{self.base}/round-{number}"

    def _exists(self, path: str) -> bool:
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(target)

    def last(self, rounds: int, schema) -> tuple[int, DataFrame] | None:
        """The number and table of the last finished one of ``rounds`` rounds."""
        for number in range(rounds, 0, -1):
            if self._exists(f"{self._path(number)}/_SUCCESS"):
                return number, self.spark.read.schema(schema).parquet(self._path(number))
        return None

    def write(self, df: DataFrame, number: int) -> DataFrame:
        df.write.mode("overwrite").parquet(self._path(number))
        if number > 1 and self._exists(self._path(number - 1)):
            drop_staged(self.spark, self._path(number - 1))
        return self.spark.read.schema(df.schema).parquet(self._path(number))


def lookup_side(df: DataFrame, rows: int) -> DataFrame:
    """Mark the small side of a lookup join for broadcast when its size is proven.

    Beyond the bound the hint is left off: Spark then shuffles both sides and adaptive execution
    splits skewed partitions.
    """
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def in_parallel(df: DataFrame) -> DataFrame:
    """Spread a plain scan that has fewer input splits than cores; a no-op on any large table.

    By hash of the row, which unlike round-robin needs no sort to be repeatable.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *df.columns) if df.rdd.getNumPartitions() < cores else df

"""Session defaults and the shared folder for tables that cut lineage."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on; all of them may be set on a live session.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


_shipped: set[str] = set()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings and make this package importable in the tasks."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send the package's source to the executors once per application, as ``--py-files`` would."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="spark-"), os.path.basename(package))
    archive = shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session without one falls back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


class Workspace:
    """Written intermediate tables of one run.

    A saved table is read back from the shared folder, so a lost executor costs a re-read and never a
    replay of the fits behind it; Parquet keeps column pruning and pushdown for later stages.
    """

    def __init__(self, spark: SparkSession, label: str = "run"):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/exprspark-{label}-{uuid.uuid4().hex}"

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        target = self.folder(name)
        df.write.mode("errorifexists").parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def drop(self, *names: str) -> None:
        """Remove tables that nothing reads any more, or the whole workspace."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for target in [self.folder(n) for n in names] or [self.path]:
            path = jvm.org.apache.hadoop.fs.Path(target)
            path.getFileSystem(conf).delete(path, True)

    def release(self) -> None:
        """Let shuffle files of finished jobs go: Spark removes them once the driver has collected what referred to them."""
        gc.collect()
        self.spark._jvm.System.gc()

    def save_text(self, df: DataFrame, name: str, compression: str = "none") -> str:
        """A compressed file is read by one task, so it suits parts as large as a task's share of the input."""
        target = self.folder(name)
        df.write.mode("errorifexists").text(target, compression=compression)
        return target

"""Session defaults and lineage-cutting writes."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int = 8, shuffle_partitions: int | None = None, memory: str = "8g") -> SparkSession:
    """A local[cpus] session for tests and the bench; a cluster passes its own session instead."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName("pairloom").config("spark.driver.memory", memory)
    for k, v in LOCAL_CONF.items():
        b = b.config(k, v)
    return b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus)).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and written tables: spark.checkpoint.dir of the session, which all executors share.

    Only where the session names none (tests on one machine) a temporary folder is made and set.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not d:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = current.get() if current.isDefined() else None
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="pairloom-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


class Workspace:
    """Written tables of one operator run, in the shared folder.

    write() materialises a frame as Parquet and returns a frame that reads it, so that lineage ends there and a lost
    executor costs only the tasks it ran. drop() deletes a table that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0

    def write(self, df: DataFrame, name: str = "t", partition_by: list[str] | None = None) -> DataFrame:
        path = self.save(df, name, partition_by)
        return self.spark.read.schema(df.schema).parquet(path) if not partition_by else self.spark.read.parquet(path)

    def save(self, df: DataFrame, name: str = "t", partition_by: list[str] | None = None) -> str:
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        w = df.write.mode("overwrite")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
        return path

    def drop(self, df_or_path: DataFrame | str) -> None:
        """Deletes the files of a table written here."""
        paths = [df_or_path] if isinstance(df_or_path, str) else sorted({os.path.dirname(f) for f in df_or_path.inputFiles()})
        for p in paths:
            if self.root.split(":", 1)[-1].lstrip("/") not in p:
                continue
            path = self.spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def finish(self, df: DataFrame, *others: DataFrame) -> DataFrame:
        """Writes the result and deletes every other table of this workspace, but for those of `others`."""
        path = self.save(df, "result")
        kept = {path.rsplit("/", 1)[-1]} | {os.path.basename(os.path.dirname(f)) for o in others for f in o.inputFiles()}
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for status in fs.listStatus(root):
            if status.getPath().getName() not in kept:
                fs.delete(status.getPath(), True)
        return self.spark.read.schema(df.schema).parquet(path)

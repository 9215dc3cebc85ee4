"""Session construction and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that hold on a laptop and on a cluster alike. Sizes of shuffles are left to AQE;
# stateful streams cannot be re-planned at run time, so they take `spark.sql.shuffle.partitions`
# as it stands when their checkpoint is first written.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "millrace", master: str | None = None, **conf: str
) -> SparkSession:
    """Session with the defaults above; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's `spark.checkpoint.dir`.

    Only on one machine (a `local` master, as in tests) a temporary folder is made and set where the
    session names none, so that `DataFrame.checkpoint` works too; on a cluster that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="millrace-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that nobody else uses."""
    return f"{shared_root(spark)}/millrace/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared folder, so that later steps read one fixed copy.

    Written as a table, not kept on executors: losing an executor costs nothing, and
    values such as `spark_partition_id()` cannot change between two uses.
    """
    path = new_folder(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give work per row to all cores when a source comes in fewer pieces than there are cores.

    A table of one file and row group is read by one task. Only such tables are redistributed;
    one with enough splits, as every large one has, is passed on without a shuffle.
    """
    return df if fills_cores(df) else df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def fills_cores(df: DataFrame) -> bool:
    """Whether a table is read in at least as many pieces as there are cores."""
    return df.rdd.getNumPartitions() >= df.sparkSession.sparkContext.defaultParallelism

"""Session settings and the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# State that outgrows the heap stays on disk; adaptive plans split hot keys.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def local_session(cores: int | str = 8, memory: str = "8g", **settings: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("weirstone")
    defaults = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": str(cores),
        **SETTINGS,
        **settings,
    }
    for name, value in defaults.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder every executor can reach, below ``spark.checkpoint.dir``.

    Only a local session, all of whose tasks share one machine, may fall back
    to a temporary folder.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="weirstone-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/weirstone/{context.applicationId}/{purpose}-{uuid.uuid4().hex}"


def remove_shared(spark: SparkSession) -> None:
    """Remove what this application wrote to the shared folder; nothing that was read from it can be used after."""
    context = spark.sparkContext
    if not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()):
        return
    own = context._jvm.org.apache.hadoop.fs.Path(shared_folder(spark, "none")).getParent()
    own.getFileSystem(context._jsc.hadoopConfiguration()).delete(own, True)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, lineage cut."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Remove the folder of a table that ``written`` made and nothing reads again."""
    context = df.sparkSession.sparkContext
    for file in df.inputFiles()[:1]:
        folder = context._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)

"""File tables and sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sequence(spark: SparkSession, first: int, last: int) -> DataFrame:
    """Whole numbers ``first..last`` in column ``id``."""
    return spark.range(first, last + 1)


def spread(df: DataFrame) -> DataFrame:
    """Give a read of fewer splits than cores one partition per core.

    For a small file of one row group, whose parse would run in one task. A
    read that already has a split per core is returned as it is, so a large
    input is never shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def file_count(spark: SparkSession, path: str, suffix: str) -> int:
    """Files of a folder whose names end so, not those of folders in it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sum(f.isFile() and f.getPath().getName().endswith(suffix) for f in files.listStatus(folder))


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files_per_trigger: int | None = None,
    ignore_missing: bool = False,
) -> DataFrame:
    """Stream a folder of parquet files, bounded per trigger if asked.

    With ``ignore_missing`` a file that went away after it was listed is passed over.
    """
    reader = spark.readStream.schema(schema)
    if ignore_missing:
        reader = reader.option("ignoreMissingFiles", "true")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)

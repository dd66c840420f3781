"""A target kept in buckets of its key, so that an upsert moves the stage alone."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import first_per_key
from .targets import path_exists

VERSION = "version="

# Rows of target and stage that a task merges, on average.
BUCKET_ROWS = 500_000


def buckets_for(rows: int, least: int = 1) -> int:
    """Buckets for so many rows of a target and a stage, so that what a task sorts does not grow with them."""
    return max(least, -(-rows // BUCKET_ROWS))


@dataclass(frozen=True)
class BucketedTable:
    """Numbered versions of a table, each in buckets by ``keys`` and sorted inside them; the newest counts.

    For targets of which a load touches most partitions. The bucket of a row
    is known from its key, so an upsert reads the target once, shuffles the
    stage to its buckets, merges both in the order they are in, and writes the
    next version bucket by bucket. ``Upsert`` is for loads that touch few
    partitions. A version counts once it is complete; ``keep`` of them stay
    for readers of the one before. A task sorts a bucket of the target and of
    the stage, so their number, which stays that of the first version, is
    chosen by the rows there will be (:func:`buckets_for`).
    """

    path: str
    keys: tuple[str, ...]
    buckets: int
    keep: int = 2

    def _files(self, spark: SparkSession, path: str):
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self, spark: SparkSession) -> list[int]:
        if not path_exists(spark, self.path):
            return []
        folder, files = self._files(spark, self.path)
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return sorted(int(n.removeprefix(VERSION)) for n in names if n.startswith(VERSION))

    def _folder(self, number: int) -> str:
        return f"{self.path}/{VERSION}{number:09d}"

    def _name(self, number: int) -> str:
        """The catalog knows the buckets of a version under a name made of its path."""
        return f"weirstone_{hashlib.sha256(self._folder(number).encode()).hexdigest()[:32]}"

    def _current(self, spark: SparkSession) -> int | None:
        done = [n for n in self._versions(spark) if path_exists(spark, f"{self._folder(n)}/_SUCCESS")]
        return done[-1] if done else None

    def _write(self, rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        (
            rows.write.format("parquet")
            .option("path", self._folder(number))
            .bucketBy(self.buckets, *self.keys)
            .sortBy(*self.keys)
            .saveAsTable(self._name(number))
        )
        for old in [n for n in self._versions(spark) if n <= number - self.keep]:
            spark.sql(f"DROP TABLE IF EXISTS {self._name(old)}")
            folder, files = self._files(spark, self._folder(old))
            files.delete(folder, True)

    def create(self, rows: DataFrame) -> None:
        """The first version."""
        self._write(rows.repartition(self.buckets, *self.keys), 1)

    def read(self, spark: SparkSession) -> DataFrame:
        number = self._current(spark)
        if number is None:
            raise ValueError(f"no table at {self.path}")
        if not spark.catalog.tableExists(self._name(number)):  # another session wrote it
            schema = spark.read.parquet(self._folder(number)).schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            keys = ", ".join(f"`{k}`" for k in self.keys)
            spark.sql(
                f"CREATE TABLE {self._name(number)} ({columns}) USING parquet"
                f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self._folder(number)}'"
            )
        return spark.table(self._name(number))

    def merged(self, target: DataFrame, stage: DataFrame, newest_first: Sequence[str]) -> DataFrame:
        """The target with the rows of the stage's keys replaced, unless the target's are newer."""
        if sorted(target.columns) != sorted(stage.columns):
            raise ValueError(f"target and stage differ in columns: {sorted(set(target.columns) ^ set(stage.columns))}")
        order = [F.col(c).desc() for c in newest_first]
        known = reduce(and_, [F.col(k).isNotNull() for k in self.keys])
        # Dealt to the buckets first: what follows keeps them, and the join asks for nothing else.
        latest = first_per_key(stage.where(known).repartition(self.buckets, *self.keys), self.keys, order)
        old = target.where(known).select(*self.keys, F.struct(*target.columns).alias("__old"))
        new = latest.select(*self.keys, F.struct(*target.columns).alias("__new"))
        both = old.join(new, list(self.keys), "full")
        keep = F.when(F.col("__new").isNull() | _newer("__old", "__new", newest_first), F.col("__old")).otherwise(F.col("__new"))
        rows = both.select(keep.alias("__row")).select("__row.*")
        # Buckets cannot join rows without a key: they are few, and merged by themselves.
        rest = target.where(~known).withColumn("__rank", F.lit(0)).unionByName(stage.where(~known).withColumn("__rank", F.lit(1)))
        rest = first_per_key(rest, self.keys, [*order, F.col("__rank").desc()]).drop("__rank")
        return rows.unionByName(rest).select(*target.columns)

    def upsert(self, stage: DataFrame, newest_first: Sequence[str]) -> None:
        """Write the next version; the same again changes nothing."""
        spark = stage.sparkSession
        rows = self.merged(self.read(spark), stage, newest_first)
        self._write(rows, self._versions(spark)[-1] + 1)


def _newer(left: str, right: str, columns: Sequence[str]) -> Column:
    """Whether the first struct comes before the second where the largest values come first and nulls last."""
    found, same = [], F.lit(True)
    for c in columns:
        a, b = F.col(f"{left}.{c}"), F.col(f"{right}.{c}")
        found.append(same & F.coalesce(a > b, a.isNotNull() & b.isNull()))
        same = same & a.eqNullSafe(b)
    return F.col(left).isNotNull() & reduce(or_, found)

"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for every node of ``links``.

    ``links`` has two columns of whole numbers, ``a`` and ``b``, in any
    direction, with repeats. Large and small stars alternate: each node's
    larger neighbours, then its smaller ones, are hung below its smallest. The
    number of rounds grows with the logarithm of a component's size. A node
    with any share of the links is summed up before the shuffle and its links
    are an adaptive join's, never a list. Each round is a written table.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    edges = written(edges, "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        # edges has a > b, so each edge once: the larger end goes below the smallest neighbour of the smaller.
        large = edges.join(least, F.col("b") == F.col("n")).select("a", F.col("m").alias("b")).where("a != b").distinct()
        large = written(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least.withColumnRenamed("a", "n"), F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = hung.unionByName(least.withColumnRenamed("m", "b")).where("a != b").distinct()
        edges = written(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "small-star")
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)

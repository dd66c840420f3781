"""Exact top-k inner products: long vectors first, pruned by bounds on rotated partial sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .common import ranked

SCALE = 1024
TOP = 10
# Vectors of one block of candidates and of queries, and candidates looked at together.
BLOCK, QUERIES, STEP = 4096, 1024, 256
# Vectors the rotation is made of.
ROTATED = 65_536
# Share of the rotated space's energy in the partial sums.
ENERGY = 0.7
_EXACT = float(1 << 53)
_LONG = 1 << 63


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of whole numbers, filled up with zeros."""
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), width))
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; ``OverflowError`` if one does not fit a long."""
    if a.size and b.size and np.abs(a).max() * np.abs(b).max() * a.shape[1] >= _EXACT:
        whole = lambda m: np.array([[int(x) for x in row] for row in m], object)
        products = whole(a) @ whole(b).T
        if products.size and not -_LONG <= products.min() <= products.max() < _LONG:
            raise OverflowError("an inner product does not fit a long")
        return products
    return (a @ b.T).astype(np.int64)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score if score.dtype != object else np.array([-s for s in score])))[:k]


def search_block(
    queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, vectors: np.ndarray, ids: np.ndarray,
    rotation: np.ndarray, split: int, k: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query number, ids, scores) of the best k of a block for each query, above its floor or equal.

    Candidates come by descending length; a query stops when length times
    length is below its kth score, and skips those whose product of the first
    rotated components plus the lengths of what is left is below it.
    """
    length = np.sqrt((vectors**2).sum(axis=1))
    order = np.lexsort((ids, -length))
    vectors, ids, length = vectors[order], ids[order], length[order]
    q_rotated, v_rotated = queries @ rotation, vectors @ rotation
    q_rest = np.sqrt((q_rotated[:, split:] ** 2).sum(axis=1))
    v_rest = np.sqrt((v_rotated[:, split:] ** 2).sum(axis=1))
    q_length = np.sqrt((queries**2).sum(axis=1))
    # Bounds are floating-point sums: they are kept a little too high.
    loose = lambda bound, size: bound + 1e-9 * (size + 1)
    least = floor.astype(float).copy()
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
    for at in range(0, len(vectors), STEP):
        part = slice(at, at + STEP)
        reach = q_length * length[at]
        active = np.flatnonzero(loose(reach, reach) >= least)
        if not len(active):
            break
        bound = q_rotated[active, :split] @ v_rotated[part, :split].T + np.outer(q_rest[active], v_rest[part])
        size = np.outer(q_length[active], length[part])
        may = (loose(bound, size) >= least[active, None]) & (query_ids[active, None] != ids[None, part])
        columns = np.flatnonzero(may.any(axis=0))
        if not len(columns):
            continue
        exact = _products(queries[active], vectors[part][columns])
        for row, q in enumerate(active):
            own = np.flatnonzero(may[row, columns])
            if not len(own):
                continue
            score = np.concatenate([best[q][1], exact[row, own]])
            found = np.concatenate([best[q][0], ids[part][columns[own]]])
            top = _best(score, found, k)
            best[q] = found[top], score[top]
            if len(top) == k:
                least[q] = max(least[q], float(score[top[-1]]))
    for q, (found, score) in enumerate(best):
        if len(found):
            yield q, found, score


def clean_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, v (whole numbers as doubles) and length of the vectors that take part; repeated rows once."""
    v = F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("double"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(False)))
    rows = rows.select("vec_id", v.alias("v")).distinct()
    return rows.withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))


def _gram(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros((width, width))
    for batch in batches:
        m = _matrix(pa.chunked_array([batch.column(0)]), width)
        total += m.T @ m
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(list(total))], names=["i", "row"])


def _rotation(rows: DataFrame, n: int, width: int) -> tuple[np.ndarray, int]:
    """Right singular vectors of about ROTATED vectors, largest first, and how many hold ENERGY of the squared lengths.

    From the sum of outer products: width rows of width numbers, added up by
    Spark. Results do not depend on the rotation, only how early sums are cut:
    so the vectors it is made of are a sample by hash.
    """
    rows = rows.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(max(n, 1))) < ROTATED).coalesce(8)
    parts = rows.select("v").mapInArrow(lambda b: _gram(b, width), "i long, row array<double>")
    cells = parts.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    gram = np.zeros((width, width))
    for i, j, x in cells.collect():
        gram[i, j] = x
    if not np.isfinite(gram).all():
        return np.eye(width), width
    values, rotation = np.linalg.eigh((gram + gram.T) / 2)
    share = np.cumsum(np.maximum(values[::-1], 0))
    split = int(np.searchsorted(share, ENERGY * share[-1])) + 1 if width and share[-1] > 0 else width
    return rotation[:, ::-1], min(split, width)


def top_products(vectors: DataFrame, every: int = 100, k: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest integer inner products of each query with all other rows.

    Queries are the rows whose vec_id is divisible by ``every``. Ties go to
    the smaller vec_id; a query with fewer candidates has them all. Only
    vec_id and embedding are read. Vectors that are null or hold nulls or
    non-finite numbers, and rows without an id, take no part; shorter vectors
    are filled up with zeros; repeated rows count once, different vectors of
    one id each; an empty table gives an empty result.

    Candidates are dealt into blocks by ranges of their length, queries into
    blocks by hash. The block of the longest vectors gives each query a kth
    score to start from; then only those pairs of blocks meet whose lengths
    can still reach it. Scores beyond a long raise ``OverflowError``.
    """
    rows = written(clean_vectors(vectors), "vectors")
    n, width, n_queries = rows.agg(
        F.count(F.lit(1)), F.max(F.size("v")), F.sum((F.col("vec_id") % every == 0).cast("bigint"))
    ).first()
    width, blocks = max(1, width or 0), max(1, -(-n // BLOCK))
    parts = max(1, -(-(n_queries or 0) // QUERIES))
    rotation, split = _rotation(rows, n, width)
    sent = rows.sparkSession.sparkContext.broadcast((rotation, split))  # width squared numbers
    dealt = rows.repartitionByRange(blocks, F.desc("length"), "vec_id").withColumn("block", F.spark_partition_id())
    dealt = written(dealt, "blocks")
    first = dealt.agg(F.min("block")).first()[0]
    part = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
    queries = rows.where(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.col("length").alias("q_length"), part.alias("part")
    )

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            names = left.column("query_id").to_numpy()
            floor = np.array([-np.inf if x is None else x for x in left.column("floor").to_pylist()])
            args = _matrix(left.column("q"), width), names, floor, _matrix(right.column("v"), width)
            for q, ids, scores in search_block(*args, right.column("vec_id").to_numpy(), *sent.value, k):
                found["query_id"].append(np.full(len(ids), names[q]))
                found["vec_id"].append(ids)
                found["score"].append(scores.astype(np.int64))
        joined = {c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in found.items()}
        return pa.table({c: pa.array(v, pa.int64()) for c, v in joined.items()})

    def search(asked: DataFrame, candidates: DataFrame) -> DataFrame:
        keys = ["part", "block"]
        both = asked.groupBy(*keys).cogroup(candidates.groupBy(*keys))
        return both.applyInArrow(run, "query_id long, vec_id long, score long")

    every_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    seeds = written(
        search(
            queries.withColumn("floor", F.lit(None).cast("long")).withColumn("block", F.lit(first)),
            dealt.where(F.col("block") == F.lit(first)).select("*", every_part),
        ),
        "seeds",
    )
    # The seeds' kth score is a floor; nothing below it can be among the best k.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = seeds.withColumn("n", F.row_number().over(order)).where(F.col("n") == k)
    kth = kth.select(F.col("query_id").alias("__id"), F.col("score").alias("floor"))
    need = F.coalesce(F.when(F.col("floor") > 0, F.col("floor") / F.col("q_length") * (1 - 1e-9)), F.lit(0.0))
    asked = queries.join(kth, F.col("query_id") == F.col("__id"), "left").drop("__id", "part").withColumn("need", need)
    # Queries that need equally long vectors go together: one that needs short ones too makes no other part meet them.
    asked = ranked(asked, [F.desc("need"), F.col("query_id"), F.xxhash64("q")], "at").withColumn("part", F.floor((F.col("at") - 1) / QUERIES).cast("int"))
    asked = written(asked.drop("at"), "asked")
    lowest = asked.groupBy("part").agg(F.min("need").alias("need"))
    longest = dealt.where(F.col("block") != F.lit(first)).groupBy("block").agg(F.max("length").alias("longest"))
    meet = longest.select("block", "longest", every_part).join(lowest, "part")
    meet = written(meet.where(F.col("longest") >= F.col("need")).select("part", "block"), "meet")
    rest = search(asked.drop("need").join(meet, "part"), dealt.join(meet, "block"))
    best = seeds.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")

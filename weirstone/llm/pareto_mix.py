"""Mix sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keyjoin import fits_broadcast, join_right
from ..session import written
from .common import n_words, ranked

WEIGHTS = (1.0, 2.0, 3.0)
MAX_COPIES = 3
# A rank is a number of 52 bits; two rounds of 13 bits find where a source's cut lies.
RANK_BITS = 52
ROUND_BITS = 13
# Documents past the cut that fill what is left of a target, one after the other.
FILLS = 3


def _targets(sources: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """Sources with ``__weight`` and ``__target``: a share of all words by weight, capped.

    The excess over a cap goes to the others by weight until no source is
    above its own. Each round is one aggregate of three numbers; the level
    only rises, so there are no more rounds than sources.
    """
    values = F.array(*[F.lit(float(w)) for w in weights])
    order = [F.col("__source").asc_nulls_last()]
    weighed = ranked(sources, order, "__no").withColumn(
        "__weight", F.element_at(values, F.pmod(F.col("__no") - 1, F.lit(len(weights))).cast("int") + 1)
    )
    weighed = written(weighed, "sources")
    cap = F.col("__source_size") * F.lit(float(most))
    total = weighed.agg(F.sum("__source_size")).first()[0] or 0
    level, held = 0.0, -1
    while True:
        full = cap <= F.col("__weight") * F.lit(level)
        row = weighed.agg(
            F.coalesce(F.sum(F.when(full, F.lit(1))), F.lit(0)),
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("__weight"))), F.lit(0.0)),
        ).first()
        if row[0] == held or not row[2]:
            break
        held, level = row[0], (total - row[1]) / row[2]
    target = F.least(F.col("__weight") * F.lit(level), cap)
    return weighed.withColumn("__target", target)


def _rank(size: Column) -> Column:
    """Random odds divided by inclusion odds, as a number of 52 bits that grows with it.

    Inclusion odds grow with a document's size: those of the source's rest
    ``f`` times size over mean size. The random number is a hash of the row.
    """
    u = (F.shiftrightunsigned("__draw", 11).cast("double") + 0.5) / F.lit(float(2**53))
    share = F.col("__rest") / F.col("__source_size")
    odds = share / (1 - share) * size / (F.col("__source_size") / F.col("__source_rows"))
    random = u / (1 - u)
    rank = F.floor(random / (random + odds) * F.lit(float(2**RANK_BITS)))
    return F.when((size > 0) & (share > 0) & (share < 1), rank).otherwise(F.lit(2**RANK_BITS)).cast("bigint")


def sized(docs: DataFrame, seed: int) -> DataFrame:
    """The columns a mix works on: id, source, size, a random draw from the row alone."""
    draw = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source"), F.col("text"))
    return docs.select(
        F.col("doc_id").alias("__doc"), F.col("source").alias("__source"),
        n_words("text").alias("__size"), draw.alias("__draw"),
    )


def mix_plan(
    rows: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MAX_COPIES
) -> tuple[DataFrame, bool]:
    """One row per source with its target, whole copies and the cut of its ranks.

    Every document of a source gets the whole copies of its target over its
    size; the rest of the target is a Pareto sample of fixed size in words:
    documents in order of rank while half of the next still fits, then up to
    FILLS documents that fill what remains best. The cut is found from sums over
    13 bits of the rank at a time, so no task sorts a source.
    Returns the plan and whether it is small enough to broadcast.
    """
    units = written(
        rows.groupBy("__source", "__doc", "__size", "__draw").agg(F.count(F.lit(1)).alias("__n")), "units"
    ).withColumn("__words", F.col("__size") * F.col("__n"))
    sources = units.groupBy("__source").agg(
        F.sum("__words").alias("__source_size"), F.sum("__n").alias("__source_rows")
    )
    plan = _targets(sources, weights, most)
    ratio = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(0.0)
    plan = plan.withColumn("__copies", F.floor(ratio).cast("bigint"))
    plan = written(
        plan.withColumn("__rest", F.greatest(F.lit(0.0), F.col("__target") - F.col("__copies") * F.col("__source_size"))),
        "plan",
    )
    small = fits_broadcast(plan)
    facts = plan.select(
        F.col("__source").alias("__of"), "__no", "__rest", "__source_size", "__source_rows"
    ).where(F.col("__rest") > 0)
    ranks = written(
        join_right(units, ["__source"], facts, ["__of"], "inner", broadcast=small).select(
            "__no", "__rest", "__words", _rank(F.col("__size")).alias("__rank"),
            F.xxhash64("__draw", "__doc", "__size").alias("__tie"),
        ),
        "ranks",
    )

    def cut(inside: DataFrame, bits: int) -> DataFrame:
        """Per source the bucket of ``bits`` fewer bits in which the rest runs out, and the words before."""
        bucket = F.shiftright("__rank", bits)
        sums = inside.groupBy("__no", "__rest", "__base", bucket.alias("__bucket")).agg(F.sum("__words").alias("__in"))
        upto = F.sum("__in").over(Window.partitionBy("__no").orderBy("__bucket"))
        ends = sums.withColumn("__upto", upto + F.col("__base")).where(F.col("__upto") > F.col("__rest"))
        first = ends.groupBy("__no").agg(F.min(F.struct("__bucket", F.col("__upto") - F.col("__in"))).alias("__c"))
        return written(first.select(F.col("__no").alias("__cut_no"), "__c.*").toDF("__cut_no", "__cut", "__before"), "cut")

    def within(inside: DataFrame, cuts: DataFrame, bits: int) -> DataFrame:
        held = join_right(inside.drop("__base"), ["__no"], cuts, ["__cut_no"], "inner", broadcast=small)
        held = held.where(F.shiftright("__rank", bits) == F.col("__cut"))
        return held.withColumnRenamed("__before", "__base").drop("__cut", "__cut_no")

    high, low = RANK_BITS - ROUND_BITS, RANK_BITS - 2 * ROUND_BITS
    inside = ranks.withColumn("__base", F.lit(0).cast("bigint"))
    inside = within(inside, cut(inside, high), high)
    last = cut(inside, low)
    inside = within(inside, last, low)
    ordered = Window.partitionBy("__no").orderBy("__rank", "__tie")
    before = F.col("__base") + F.sum("__words").over(ordered) - F.col("__words")
    edge = inside.withColumn("__before", before)
    edge = edge.where(F.col("__before") + F.col("__words") / 2 <= F.col("__rest"))
    edge = edge.groupBy("__no").agg(
        F.max(F.struct("__rank", "__tie", (F.col("__before") + F.col("__words")).alias("__got"))).alias("__e")
    )
    # Without a whole document in the last bucket the cut is the start of that bucket.
    start = F.shiftleft("__cut", low) - 1
    edges = last.join(edge, last["__cut_no"] == edge["__no"], "left").select(
        "__cut_no",
        F.coalesce("__e.__rank", start).alias("__cut_rank"),
        F.coalesce("__e.__tie", F.lit(2**63 - 1)).alias("__cut_tie"),
        F.coalesce("__e.__got", "__before").alias("__got"),
    )
    edges = written(edges, "edges")
    for n in range(FILLS):
        left = join_right(ranks, ["__no"], edges, ["__cut_no"], "inner", broadcast=small)
        missing = F.col("__rest") - F.col("__got")
        over = (F.col("__rank") > F.col("__cut_rank")) | (
            (F.col("__rank") == F.col("__cut_rank")) & (F.col("__tie") > F.col("__cut_tie"))
        )
        for m in range(n):
            over = over & ~F.coalesce(F.struct("__rank", "__tie") == F.col(f"__fill_{m}"), F.lit(False))
        best = F.min(F.struct(F.abs(F.col("__words") - missing), "__rank", "__tie", "__words"))
        fill = (
            left.where(over & (F.col("__words") > 0) & (F.abs(F.col("__words") - missing) < missing))
            .groupBy(F.col("__no").alias("__fill_no"))
            .agg(best.alias("__f"))
        )
        edges = edges.join(fill, F.col("__cut_no") == F.col("__fill_no"), "left")
        rank = F.when(F.col("__f").isNotNull(), F.struct(F.col("__f.__rank").alias("__rank"), F.col("__f.__tie").alias("__tie")))
        edges = edges.withColumn(f"__fill_{n}", rank).withColumn(
            "__got", F.col("__got") + F.coalesce(F.col("__f.__words"), F.lit(0))
        )
        edges = written(edges.drop("__fill_no", "__f"), "edges")
    full = plan.join(edges, plan["__no"] == edges["__cut_no"], "left")
    plan = full.drop("__cut_no", "__got").withColumnRenamed("__source", "__of")
    return written(plan, "plan"), small


def _copies() -> Column:
    rank, tie = _rank(F.col("__size")), F.xxhash64("__draw", "__doc", "__size")
    below = (rank < F.col("__cut_rank")) | ((rank == F.col("__cut_rank")) & (tie <= F.col("__cut_tie")))
    chosen = F.coalesce(below, F.lit(False))
    for n in range(FILLS):
        chosen = chosen | F.coalesce(F.struct(rank, tie) == F.col(f"__fill_{n}"), F.lit(False))
    return F.col("__copies") + F.when(chosen & (F.col("__rest") > 0) & (F.col("__size") > 0), 1).otherwise(0)


def mix_report(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MAX_COPIES, seed: int = 42) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, copies and taken.

    Needs the columns doc_id, source and text; others are ignored, whatever
    their names. A null text has size 0 and takes nothing; a null source is a
    source of its own, the last; rows equal in id, source and text are one
    document and share its fate. An empty table gives an empty result.
    """
    rows = written(sized(docs, seed), "sizes")
    plan, small = mix_plan(rows, weights, most)
    mixed = join_right(rows, ["__source"], plan, ["__of"], "inner", broadcast=small).withColumn("copies", _copies())
    return mixed.select(
        F.col("__doc").alias("doc_id"), F.col("__source").alias("source"), F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), "copies",
        (F.col("__size") * F.col("copies")).alias("taken"),
    )


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MAX_COPIES, seed: int = 42) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it was taken, all its columns unchanged.

    Cases as :func:`mix_report`; documents of size 0 get their source's whole copies.
    """
    plan, small = mix_plan(written(sized(docs, seed), "sizes"), weights, most)
    # The row is carried as one struct, so its columns may have any names.
    packed = docs.select(F.struct("*").alias("__row"))
    inner = ("doc_id", "source", "text")
    keyed = packed.select("__row", *[F.col("__row")[c].alias(c) for c in inner])
    draw = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source"), F.col("text"))
    rows = keyed.select(
        "__row", F.col("doc_id").alias("__doc"), F.col("source").alias("__source"),
        n_words("text").alias("__size"), draw.alias("__draw"),
    )
    mixed = join_right(rows, ["__source"], plan, ["__of"], "inner", broadcast=small)
    repeated = mixed.withColumn("__copies", _copies()).where(F.col("__copies") > 0)
    copies = F.explode(F.array_repeat(F.lit(0), F.col("__copies").cast("int")))
    return repeated.select("__row", copies.alias("__copy")).select("__row.*")

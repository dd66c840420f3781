"""The trie of conversation prefixes, rolled up by bands of depth."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keyjoin import join_right
from ..session import written
from .common import n_words, ranked

# Depths a band has: a node meets at most so many ancestors at a time.
BAND = 8
# Turns of a conversation that one task chains.
BLOCK = 4_096
# Ids in one piece of text on the way to a digest.
PIECE = 256
# Fixed values of the contract: conversations of one family share the first turns of its first one.
FAMILY, HEADS = 20, 4

_KEY = ["ka", "kb"]
_SUMS = ["leaves", "saved"]


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), a, b, words of each turn: its place, 128 bits of role and text, words of the text.

    Turns of a conversation are in order of turn (null first); those of equal
    turn in order of role, then of the text's hash. Places come from a sort by
    ranges, which part a long conversation too.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"),
        F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), role, text).alias("b"), n_words(text).alias("words"),
        # Parts equal rows; whichever of them comes first, the places are the same.
        F.monotonically_increasing_id().alias("copy"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "a", "b", "copy"]
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    rows = written(ranked(rows, order, "at").select("conv_id", "at", "a", "b", "words"), "turns")
    firsts = rows.groupBy(F.col("conv_id").alias("__conv")).agg(F.min("at").alias("__first"))
    joined = join_right(rows, ["conv_id"], firsts, ["__conv"], "inner")
    return joined.select("conv_id", (F.col("at") - F.col("__first") + 1).alias("place"), "a", "b", "words")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, lengths): the rebuilt conversations as conv_id, depth, a, b, words, and every conv_id with its length.

    Conversation c has the first h turns of conversation ``c - c % 20``, with h
    the crc32 of its decimal id modulo 4, then its own turns after the first h.
    """
    own = written(turns_of(conversations), "own-turns")
    known = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    base = known.where(F.col("conv_id") % FAMILY == 0)
    base = base.select(F.col("conv_id").alias("base"), F.least("n", F.lit(HEADS)).alias("has"))
    family = known.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
    family = family.join(base, "base", "left").withColumn("took", F.least("h", F.coalesce("has", F.lit(0))))
    length = F.col("took") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    family = written(family.select("conv_id", "base", "h", "took", length.alias("length")), "families")

    mine = family.select(F.col("conv_id").alias("__conv"), "h", "took")
    later = join_right(own, ["conv_id"], mine, ["__conv"], "inner", also=F.col("place") > F.col("h"))
    later = later.select("conv_id", (F.col("took") + F.col("place") - F.col("h")).alias("depth"), "a", "b", "words")
    # A family's first turns are fewer than HEADS, its members no more than FAMILY.
    heads = own.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < HEADS)).withColumnRenamed("conv_id", "base")
    heads = family.select("conv_id", "base", "took").join(heads, "base").where("place <= took")
    turns = later.unionByName(heads.select("conv_id", F.col("place").alias("depth"), "a", "b", "words"))
    return turns, family.select("conv_id", "length")


def chained(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """conv_id, depth, ka, kb, pa, pb, words: the prefixes of each conversation, of depth 0 too.

    A prefix is named by 128 bits: the hashes of its turns with their depths,
    combined by exclusive or. Combining has no order, so a long conversation is
    chained in blocks, each starting with what the blocks before come to.
    """
    mixed = [F.xxhash64(F.lit(n), "depth", "a", "b").alias(name) for n, name in ((3, "ma"), (4, "mb"))]
    block = F.floor((F.col("depth") - 1) / BLOCK).alias("block")
    rows = written(turns.select("conv_id", "depth", *mixed, "words", block), "mixed")
    long = rows.where(F.col("block") > 0).select(F.col("conv_id").alias("__conv")).distinct()
    sums = join_right(rows, ["conv_id"], long, ["__conv"], "left_semi").groupBy("conv_id", "block")
    sums = sums.agg(F.bit_xor("ma").alias("ma"), F.bit_xor("mb").alias("mb"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        F.col("conv_id").alias("__conv"), F.col("block").alias("__block"),
        F.bit_xor("ma").over(before).alias("ca"), F.bit_xor("mb").over(before).alias("cb"),
    )
    rows = join_right(rows, ["conv_id", "block"], carried, ["__conv", "__block"], "left", hot_rows=None)
    so_far = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)

    def name(own: str, carry: str) -> Column:
        return F.bit_xor(own).over(so_far).bitwiseXOR(F.coalesce(carry, F.lit(0)))

    rows = rows.withColumn("ka", name("ma", "ca")).withColumn("kb", name("mb", "cb"))
    rows = rows.select(
        "conv_id", "depth", "ka", "kb", F.col("ka").bitwiseXOR(F.col("ma")).alias("pa"),
        F.col("kb").bitwiseXOR(F.col("mb")).alias("pb"), "words",
    )
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    roots = lengths.select(
        "conv_id", zero.alias("depth"), zero.alias("ka"), zero.alias("kb"), none.alias("pa"), none.alias("pb"), zero.alias("words")
    )
    return written(rows.unionByName(roots), "prefixes")


def _totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*_KEY).agg(*[F.sum(c).alias(c) for c in _SUMS])


def rolled_up(nodes: DataFrame, chain: DataFrame, deepest: int, step: int = 1) -> DataFrame:
    """ka, kb, leaves, saved: sums over the subtree of each node whose depth is a multiple of ``step``.

    ``nodes`` has ka, kb, conv_id, depth and what each adds. Bands have BAND
    such depths. Inside each, a node adds to its ancestors, found as the
    prefixes of its conversation. The roots of bands with these totals are a
    trie BAND times less deep, rolled up in the same way; a completed band root
    then adds to the band above it. So a row meets no more than BAND ancestors,
    and the rounds grow with the logarithm of the depth.
    """
    band = F.floor(F.col("depth") / (step * BAND))
    paths = chain.where(F.col("depth") % step == 0).groupBy("conv_id", band.alias("band"))
    paths = written(paths.agg(F.collect_list(F.struct("depth", *_KEY)).alias("path")), "paths")

    def onto(rows: DataFrame, band: Column) -> DataFrame:
        found = rows.withColumn("band", band).join(paths, ["conv_id", "band"])
        above = F.filter("path", lambda p: p["depth"] <= F.col("depth"))
        return _totals(found.select(F.explode(above).alias("p"), *_SUMS).select(*[f"p.{k}" for k in _KEY], *_SUMS))

    inside = onto(nodes.where("leaves > 0 OR saved > 0"), band)
    if deepest < step * BAND:
        return inside
    inside = written(inside, "bands")
    tops = nodes.where(F.col("depth") % (step * BAND) == 0).drop(*_SUMS)
    summed = [F.coalesce(c, F.lit(0)).alias(c) for c in _SUMS]
    named = written(tops.join(inside, _KEY, "left").select(*tops.columns, *summed), "band-roots")
    done = rolled_up(named, chain, deepest, step * BAND)
    done = tops.where("depth > 0").join(done, _KEY).select(*tops.columns, *_SUMS)
    return _totals(inside.unionByName(onto(done, band - 1)))


def _digests(ends: DataFrame) -> DataFrame:
    """ka, kb, ends_sha256 of conv_ids by node, ascending.

    Ids are sorted by ranges, so many of one node lie in several tasks, which
    join them to pieces of text. The pieces of a node pass through its digest
    one after the other: that is all a task holds.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["ka", "kb", "least", "ids"]
        for batch in batches:
            ka, kb, ids = (batch.column(i).to_pylist() for i in range(3))
            out, start = [], 0
            for at in range(1, len(ids) + 1):
                if at == len(ids) or at - start == PIECE or (ka[at], kb[at]) != (ka[start], kb[start]):
                    out.append((ka[start], kb[start], ids[start], ",".join(map(str, ids[start:at]))))
                    start = at
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running = None, None
        for batch in batches:
            out = []
            for ka, kb, ids in zip(*(batch.column(n).to_pylist() for n in ("ka", "kb", "ids"))):
                if (ka, kb) == key:
                    running.update(b"," + ids.encode())
                    continue
                if key is not None:
                    out.append((*key, running.hexdigest()))
                key, running = (ka, kb), hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=[*_KEY, "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, running.hexdigest())], names=[*_KEY, "ends_sha256"])

    order = [*_KEY, "conv_id"]
    dealt = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    texts = dealt.mapInArrow(pieces, "ka long, kb long, least long, ids string")
    texts = texts.repartition(*_KEY).sortWithinPartitions(*_KEY, "least")
    return texts.mapInArrow(digests, "ka long, kb long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows without a conv_id belong to no conversation. A null turn comes first,
    a null role or text is empty; turns that repeat, and rows that do, count
    each. Texts are hashed and counted whole, however long. A conversation may
    be of any length, and any share of all conversations may pass a node or end
    in it. Remainders of negative ids are negative. An empty table has no
    nodes; other columns are not read.
    """
    turns, lengths = rebuilt(conversations)
    chain = chained(turns, lengths)
    nodes = chain.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"),
        *[F.max(c).alias(c) for c in ("pa", "pb", "words")],
    )
    nodes = written(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("pa").alias("ka"), F.col("pb").alias("kb"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = written(nodes, "trie")
    adds = nodes.select(
        *_KEY, "conv_id", "depth", (F.col("n_children") == 0).cast("bigint").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    totals = rolled_up(adds, chain, deepest).withColumnRenamed("leaves", "n_leaves").withColumnRenamed("saved", "saved_tokens")
    last = chain.select("conv_id", "depth", *_KEY)
    ends = last.join(lengths.withColumnRenamed("length", "depth"), ["conv_id", "depth"])
    found = nodes.join(totals, _KEY, "left").join(_digests(ends), _KEY, "left")
    parents = nodes.where("n_children > 0").select(
        F.col("ka").alias("__pa"), F.col("kb").alias("__pb"), F.col("conv_id").alias("parent_conv_id")
    )
    found = join_right(found, ["pa", "pb"], parents, ["__pa", "__pb"], "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )

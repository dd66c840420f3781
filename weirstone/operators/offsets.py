"""Offset algebra on envelope frames: ranges, bounds, gaps, stored offsets."""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce
from heapq import heapify, heappop, heappush
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .keyjoin import join_right

# Fixed values of the offset format.
LATEST = -1
EARLIEST = -2

Offsets = Mapping[str, Mapping[int | str, int]]

# Above this many topic partitions a range is joined; the scan then gets ranges of
# near bounds in so many clusters.
FILTER_PARTITIONS = 64
CLUSTERS = 64

OFFSETS_JSON_TYPE = "map<string,map<string,bigint>>"

# Offsets per presence word, and per block of words.
_WORD_BITS = 6
_BLOCK_BITS = 24


def parse_offsets(offsets: Offsets | str) -> dict[str, dict[int, int]]:
    """An offset map, or its JSON text, with partitions and offsets as numbers."""
    given = json.loads(offsets) if isinstance(offsets, str) else offsets
    return {t: {int(p): int(o) for p, o in parts.items()} for t, parts in given.items()}


def select_range(
    envelope: DataFrame,
    starts: Offsets | str,
    ends: Offsets | str | None = None,
    *,
    unlisted: str = "all",
) -> DataFrame:
    """Rows from each start (inclusive) to each end (exclusive).

    A start of -2 and an end of -1 leave that side open. A row without an
    offset is outside any bound; one without a topic or partition is of no
    listed partition. Partitions without a
    start are read whole, as new partitions of a topic must be; ``unlisted=
    "none"`` leaves them out. Up to 64 partitions become a filter that reaches
    the file scan. Of more, those of near bounds make up to 64 clusters, each
    with its own bounds in the filter, and every row is then held against its
    own range in a broadcast list, whose size is that of the map the caller holds.
    """
    if unlisted not in ("all", "none"):
        raise ValueError(f"unlisted must be 'all' or 'none', not {unlisted!r}")
    lower, upper = parse_offsets(starts), parse_offsets(ends or {})
    listed = sorted(
        {(t, p) for m in (lower, upper) for t, parts in m.items() for p in parts}
    )
    ranges = []
    for topic, part in listed:
        start = lower.get(topic, {}).get(part, EARLIEST if unlisted == "all" else None)
        if start is None:
            continue
        if start == LATEST:
            raise ValueError(f"{topic}/{part}: a bounded read cannot start at the latest offset")
        end = upper.get(topic, {}).get(part, LATEST)
        if end == EARLIEST:
            raise ValueError(f"{topic}/{part}: a bounded read cannot end at the earliest offset")
        ranges.append(
            (topic, part, None if start == EARLIEST else start, None if end == LATEST else end)
        )
    if len(ranges) <= FILTER_PARTITIONS:
        return _filter_ranges(envelope, ranges, unlisted)
    return _join_ranges(envelope, ranges, unlisted)


def _filter_ranges(envelope: DataFrame, ranges: list[tuple], unlisted: str) -> DataFrame:
    offset = F.col("offset")

    def here(topic: str, part: int) -> Column:
        return (F.col("topic") == topic) & (F.col("partition") == part)

    if unlisted == "all":
        bounds = []
        for topic, part, start, end in ranges:
            other = ~F.col("topic").eqNullSafe(topic) | ~F.col("partition").eqNullSafe(part)
            if start is not None:
                bounds.append(other | (offset >= start))
            if end is not None:
                bounds.append(other | (offset < end))
        return envelope.where(reduce(and_, bounds)) if bounds else envelope
    wanted = []
    for topic, part, start, end in ranges:
        span = here(topic, part)
        if start is not None:
            span = span & (offset >= start)
        if end is not None:
            span = span & (offset < end)
        wanted.append(span)
    return envelope.where(reduce(or_, wanted) if wanted else F.lit(False))


def _join_ranges(envelope: DataFrame, ranges: list[tuple], unlisted: str) -> DataFrame:
    rows = envelope.sparkSession.createDataFrame(
        ranges, "__topic string, __partition int, __start bigint, __end bigint"
    )
    same = (F.col("topic") == F.col("__topic")) & (F.col("partition") == F.col("__partition"))
    inside = (F.col("__start").isNull() | (F.col("offset") >= F.col("__start"))) & (
        F.col("__end").isNull() | (F.col("offset") < F.col("__end"))
    )
    # A file scan can use this; the join then holds each row against its own range.
    near = reduce(or_, [_within(c) for c in cluster_ranges(ranges, CLUSTERS)], F.lit(False))
    if unlisted == "all":
        joined = envelope.where(near | _unlisted(ranges)).join(F.broadcast(rows), same, "left")
    else:
        joined = envelope.where(near).join(F.broadcast(rows), same, "inner")
    return joined.where(inside).select(*envelope.columns)


def cluster_ranges(ranges: list[tuple], most: int) -> list[tuple]:
    """Ranges of near bounds together: ``(topics and their partitions, start, end)``, at most ``most``.

    A range is ``(topic, partition, start, end)``, a bound that is null is
    open. Neighbours in the order of their bounds are joined, always those
    that add the fewest offsets to what is read, first inside a topic. An open
    bound and a closed one come together only where ``most`` asks for it.
    """
    clusters = sorted(
        ([{t: [p]}, s, e] for t, p, s, e in ranges),
        key=lambda c: (c[1] is not None, c[2] is not None, *c[0], c[1] or 0, c[2] or 0),
    )
    after = [*range(1, len(clusters)), None]
    before = [None, *range(len(clusters) - 1)]
    version = [0] * len(clusters)

    def members(c: list) -> int:
        return sum(map(len, c[0].values()))

    def cost(x: list, y: list) -> tuple:
        """How unlike the bounds are in kind, whether topics differ, offsets read besides."""
        kinds = ((x[1] is None) != (y[1] is None)) + ((x[2] is None) != (y[2] is None))
        more = 0
        for at, widest in ((1, min), (2, max)):
            if x[at] is not None and y[at] is not None:
                edge = widest(x[at], y[at])
                more += abs(edge - x[at]) * members(x) + abs(edge - y[at]) * members(y)
        return kinds, x[0].keys() != y[0].keys(), more

    heap = [(cost(clusters[i], clusters[i + 1]), i, 0, i + 1, 0) for i in range(len(clusters) - 1)]
    heapify(heap)
    left = len(clusters)
    while left > most and heap:
        _, i, seen, j, seen_too = heappop(heap)
        if version[i] != seen or version[j] != seen_too:  # one of the two has changed since
            continue
        x, y = clusters[i], clusters[j]
        for topic, parts in y[0].items():
            x[0].setdefault(topic, []).extend(parts)
        x[1] = None if x[1] is None or y[1] is None else min(x[1], y[1])
        x[2] = None if x[2] is None or y[2] is None else max(x[2], y[2])
        clusters[j], left = None, left - 1
        version[i] += 1
        version[j] += 1
        after[i] = after[j]
        if after[j] is not None:
            before[after[j]] = i
            heappush(heap, (cost(x, clusters[after[j]]), i, version[i], after[j], version[after[j]]))
        if before[i] is not None:
            heappush(heap, (cost(clusters[before[i]], x), before[i], version[before[i]], i, version[i]))
    return [(c[0], c[1], c[2]) for c in clusters if c is not None]


def _within(cluster: tuple) -> Column:
    """Rows of a cluster's partitions inside its bounds, as a filter a scan takes."""
    parts, start, end = cluster
    here = reduce(or_, [(F.col("topic") == t) & F.col("partition").isin(sorted(p)) for t, p in sorted(parts.items())])
    if start is not None:
        here = here & (F.col("offset") >= start)
    if end is not None:
        here = here & (F.col("offset") < end)
    return here


def _unlisted(ranges: list[tuple]) -> Column:
    """Rows of no listed partition: of another topic, of another partition of a listed topic, or without either."""
    listed: dict[str, list[int]] = {}
    for topic, part, _, _ in ranges:
        listed.setdefault(topic, []).append(part)
    topic, part = F.col("topic"), F.col("partition")
    other = [topic.isNull() | part.isNull() | ~topic.isin(sorted(listed))]
    other += [(topic == t) & ~part.isin(sorted(parts)) for t, parts in sorted(listed.items())]
    return reduce(or_, other)


def prorate(ranges: DataFrame, limit: int) -> DataFrame:
    """Ends that bound each topic to about ``limit`` offsets.

    ``ranges`` has one row per topic partition: ``topic, partition, start,
    end`` (end exclusive). The limit is shared in proportion to the sizes,
    rounded down, but at least one offset each, as a stream's per-trigger
    bound does it.
    """
    size = F.col("end") - F.col("start")
    total = F.sum(size).over(Window.partitionBy("topic"))
    share = F.lit(limit) * (size / total)
    quota = F.when(share < 1, F.ceil(share)).otherwise(F.floor(share)).cast("bigint")
    bounded = F.least("end", F.col("start") + quota)
    return ranges.withColumn("end", F.when(total > 0, bounded).otherwise(F.col("end")))


def batch_ends(envelope: DataFrame, limit: int) -> DataFrame:
    """Where a batch of about ``limit`` rows per topic ends: ``topic, partition, offset`` (exclusive)."""
    span = envelope.groupBy("topic", "partition").agg(
        F.min("offset").alias("start"), (F.max("offset") + 1).alias("end")
    )
    return prorate(span, limit).select("topic", "partition", F.col("end").alias("offset"))


def bound_batch(envelope: DataFrame, limit: int) -> DataFrame:
    """The first offsets of every partition, about ``limit`` per topic.

    The cut is an offset per partition, found from the smallest and largest
    one, so no partition is sorted or gathered and the rows are not shuffled.
    The cuts are found once, by a scan of the positions alone; the scan of the
    whole rows gets the highest of them as a filter.
    """
    cuts = written(
        batch_ends(envelope, limit).select(
            F.col("topic").alias("__topic"),
            F.col("partition").alias("__partition"),
            F.col("offset").alias("__end"),
        ),
        "cuts",
    )
    highest = cuts.agg(F.max("__end")).first()[0]
    envelope = envelope.where(F.lit(False) if highest is None else F.col("offset") < highest)
    return join_right(
        envelope,
        ["topic", "partition"],
        cuts,
        ["__topic", "__partition"],
        "left_semi",
        also=F.col("offset") < F.col("__end"),
    )


def offset_gaps(envelope: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """Missing offsets inside each partition, as ``gap_start`` to ``gap_end``.

    With ``starts`` (``topic, partition, offset``, where a read began), what is
    missing between a start and the first offset read is a gap too, which is
    how expired messages show. A partition nothing was read of has no gap.

    Presence is kept as one 64-bit word per 64 offsets, combined before the
    shuffle, so copies of a message cost nothing. Words are compared with
    their neighbours inside blocks, and only the edges of the blocks across a
    whole partition, so one that holds a third of all rows is spread out.
    """
    at = ["topic", "partition"]
    seen = envelope.select(*at, "offset", F.shiftright("offset", _BLOCK_BITS).alias("block"))
    edge = [F.min("offset").alias("lo"), F.max("offset").alias("hi")]

    bit = F.expr("shiftleft(1L, int(offset & 63))")
    words = seen.groupBy(*at, "block", F.shiftright("offset", _WORD_BITS).alias("word")).agg(
        F.bit_or(bit).alias("bits"), *edge
    )
    present = F.filter(
        F.sequence("lo", "hi"), lambda o: F.getbit("bits", o.bitwiseAND(F.lit(63))) == 1
    )
    pairs = F.arrays_zip(
        F.slice("present", 1, F.size("present") - 1).alias("before"),
        F.slice("present", 2, F.size("present") - 1).alias("after"),
    )
    holes = F.transform(pairs, lambda p: _gap(p["before"], p["after"]))
    full = F.bit_count("bits") == F.col("hi") - F.col("lo") + 1
    in_block = Window.partitionBy(*at, "block").orderBy("word")
    inside = (
        words.withColumn("before", F.lag("hi").over(in_block))
        .where(~full | (F.col("lo") - F.col("before") > 1))
        .withColumn("present", F.when(full, F.array("lo")).otherwise(present))
        .select(*at, F.explode(F.concat(F.array(_gap(F.col("before"), F.col("lo"))), holes)).alias("g"))
        .select(*at, "g.*")
    )
    across = Window.partitionBy(*at).orderBy(F.col("block").asc_nulls_first())
    # Edges of blocks come from the same words (no word is empty), so their shuffle is used again.
    edges = words.where("bits <> 0").groupBy(*at, "block").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    if starts is not None:
        nothing = F.lit(None).cast("bigint")
        before = starts.groupBy(*at).agg((F.max("offset") - 1).alias("hi"))
        edges = edges.unionByName(before.select(*at, nothing.alias("block"), nothing.alias("lo"), "hi"))
    between = (
        edges.select(*at, _gap(F.lag("hi").over(across), F.col("lo")).alias("g"))
        .select(*at, "g.*")
    )
    return inside.unionByName(between).where("gap_end >= gap_start")


def _gap(before: Column, after: Column) -> Column:
    """What lies between two offsets; empty or null if nothing does."""
    return F.struct((before + 1).alias("gap_start"), (after - 1).alias("gap_end"))


def next_offsets(envelope: DataFrame, store: DataFrame | None = None) -> DataFrame:
    """Where the next read starts: ``topic, partition, offset``.

    The largest offset seen plus one; partitions with no new row keep the
    stored offset, and a stored offset never goes back.
    """
    at = ["topic", "partition"]
    seen = envelope.groupBy(*at).agg((F.max("offset") + 1).alias("offset"))
    if store is None:
        return seen
    return seen.unionByName(store.select(*at, "offset")).groupBy(*at).agg(
        F.max("offset").alias("offset")
    )


def encode_offsets(rows: DataFrame) -> DataFrame:
    """One row per call: column ``offsets`` with ``{"topic":{"partition":offset}}``.

    ``rows`` has one row per topic partition, as :func:`next_offsets` gives.
    """
    per_topic = rows.groupBy("topic").agg(
        F.sort_array(F.collect_list(F.struct("partition", "offset"))).alias("parts")
    )
    all_topics = per_topic.agg(F.sort_array(F.collect_list(F.struct("topic", "parts"))).alias("t"))
    as_map = F.map_from_entries(
        F.transform(
            "t",
            lambda t: F.struct(
                t["topic"].alias("key"),
                F.map_from_entries(
                    F.transform(
                        t["parts"],
                        lambda p: F.struct(p["partition"].cast("string"), p["offset"]),
                    )
                ).alias("value"),
            ),
        )
    )
    return all_topics.select(F.to_json(as_map).alias("offsets"))


def decode_offsets(df: DataFrame, column: str = "offsets") -> DataFrame:
    """Offset JSON text to rows ``topic, partition, offset``."""
    return (
        df.select(F.explode(F.from_json(column, OFFSETS_JSON_TYPE)).alias("topic", "parts"))
        .select("topic", F.explode("parts").alias("partition", "offset"))
        .withColumn("partition", F.col("partition").cast("int"))
    )


def start_offsets(store: DataFrame, topic: str) -> DataFrame:
    """The stored offsets of one topic as JSON text, one row, column ``offsets``."""
    mine = store.where(F.col("topic") == topic).groupBy("topic", "partition")
    return encode_offsets(mine.agg(F.max("offset").alias("offset")))


def start_offsets_text(store: DataFrame, topic: str, partitions: int | None = None) -> str:
    """:func:`start_offsets` as a reader option; ``earliest`` for an unknown topic.

    A reader wants all partitions of the topic named. Partitions are numbered
    from 0, so those below the highest known one, and with ``partitions`` all
    up to that number, start at the earliest if the store does not know them.
    """
    text = start_offsets(store, topic).first()["offsets"]
    known = parse_offsets(text).get(topic, {})
    if not known:
        return "earliest"
    full = {p: known.get(p, EARLIEST) for p in {*known, *range(max(partitions or 0, *known))}}
    return json.dumps(
        {topic: {str(p): full[p] for p in sorted(full)}}, separators=(",", ":")
    )

"""Near duplicates by SimHash, joined on indices of nearby Golay codewords."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keyjoin import join_right
from ..session import written
from .common import text_words
from .components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 3
# Fixed values of the (23, 12, 7) Golay code: length, check bits, generator x^11+x^10+x^6+x^5+x^4+x^2+1.
LENGTH, CHECK, GENERATOR = 23, 11, 0xC75
# First bit and width of the three parts of a fingerprint; the last is filled up with zeros.
PARTS = ((0, 23), (23, 23), (46, 18))
# Members of a key one task compares at a time; a larger key is dealt anew by more bits.
GROUP = 1 << 16
# Fingerprints whose keys one task makes.
EXPANDED = 32_768
SMALL = 32


def fingerprint(words: list[bytes]) -> int:
    """64-bit SimHash of 3-word shingles, repeats included; 0 without words.

    Fewer than three words are one shingle. A bit is set if it is in over half of the hashes.
    """
    n = len(words)
    if not n:
        return 0
    one = xxhash.xxh64_intdigest
    if n < SHINGLE:
        return one(b" ".join(words), SEED)
    total, ones = n - SHINGLE + 1, np.zeros(64, np.int64)
    for at in range(0, total, 1 << 16):  # a bounded block of a very long text at a time
        part = words[at : at + (1 << 16) + SHINGLE - 1]
        hashes = [one(b" ".join(s), SEED) for s in zip(*(part[i:] for i in range(SHINGLE)))]
        bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint([w.lower() for w in text_words(t.as_py())]) for t in batch.column(1)]
        values = np.array(found, np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["doc", "fp"])


def _syndrome(word: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator polynomial."""
    rest = word.copy()
    for bit in range(LENGTH - 1, CHECK - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - CHECK)), rest)
    return rest


def _nearby() -> np.ndarray:
    """For each of 2,048 syndromes the errors of weight up to 4 that cause it, lightest first, else -1.

    The first has weight 3 at most (the code is perfect); weights 3 come with
    five of weight 4, lighter ones with none.
    """
    table = np.full((1 << CHECK, 6), -1, np.int64)
    filled = np.zeros(1 << CHECK, np.int64)
    for weight in range(5):
        errors = np.array([sum(1 << b for b in c) for c in combinations(range(LENGTH), weight)], np.int64)
        for error, s in zip(errors, _syndrome(errors)):
            table[s, filled[s]] = error
            filled[s] += 1
    return table


_TABLE: list[np.ndarray] = []


def codeword_indices(words: np.ndarray) -> np.ndarray:
    """Six columns per word: 12-bit indices of the codewords within 4 bits, nearest first, else -1."""
    if not _TABLE:
        _TABLE.append(_nearby())
    errors = _TABLE[0][_syndrome(words)]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> CHECK)


def keys_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints such that any two within 3 bits share one: (key, row number).

    Over three parts, three errors leave two parts equal (a), or one equal and
    one with a single error (b), or one error in each (c). Words one bit apart
    differ in parity, so of two the even one gives its nearest codeword and
    the odd one all within 4 bits, among which that codeword is.
    """
    rows = np.arange(len(fps))
    parts = [(fps.astype(np.uint64) >> np.uint64(at)).astype(np.int64) & ((1 << width) - 1) for at, width in PARTS]
    near = [codeword_indices(p) for p in parts]
    odd = [np.bitwise_count(p).astype(np.int64) & 1 for p in parts]
    keys, owners = [], []

    def add(tag: int, key: np.ndarray, row: np.ndarray) -> None:
        keys.append(key | (tag << 50))
        owners.append(row)

    for tag, (i, j) in enumerate(combinations(range(3), 2)):
        add(tag, parts[i] << 23 | parts[j], rows)
    for tag, (i, j) in enumerate(permutations(range(3), 2), 3):
        even = rows[odd[j] == 0]
        add(tag, parts[i][even] << 12 | near[j][even, 0], even)
        for n in range(6):
            probe = rows[(odd[j] == 1) & (near[j][:, n] >= 0)]
            add(tag, parts[i][probe] << 12 | near[j][probe, n], probe)
    parity = (odd[0] ^ odd[1]) << 37 | (odd[0] ^ odd[2]) << 36
    even = rows[odd[0] == 0]
    add(9, parity[even] | near[0][even, 0] << 24 | near[1][even, 0] << 12 | near[2][even, 0], even)
    probe = rows[odd[0] == 1]
    x, y, z = (n[probe] for n in near)
    mixed = x[:, :, None, None] << 24 | y[:, None, :, None] << 12 | z[:, None, None, :]
    valid = (x >= 0)[:, :, None, None] & (y >= 0)[:, None, :, None] & (z >= 0)[:, None, None, :]
    owner = np.broadcast_to(probe[:, None, None, None], mixed.shape)[valid]
    add(9, mixed[valid] | parity[owner], owner)
    return np.concatenate(keys), np.concatenate(owners)


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(fps), 2000):
            part = fps[at : at + 2000]
            key, owner = keys_of(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[owner])], names=["key", "fp"])


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    # Of a signed number numpy counts the bits of its absolute value.
    return np.bitwise_count((a ^ b).view(np.uint64)) <= MAX_BITS


def _links(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is within 3 bits inside each run of equal keys, not all pairs.

    A run of up to 32 is compared shift by shift. In a longer one each newly
    reached member takes all within 3 bits out of those not yet reached, so a
    cluster of near copies gives one link for each member.
    """
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    left, right = [], []
    small = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
    k, f = key[small], fp[small]
    for shift in range(1, SMALL):
        same = k[shift:] == k[:-shift]
        if not same.any():
            break
        hit = same & _near(f[shift:], f[:-shift]) & (f[shift:] != f[:-shift])
        left.append(f[:-shift][hit])
        right.append(f[shift:][hit])
    for start, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
        rest = np.unique(fp[start : start + size])
        while len(rest):
            root, rest = rest[0], rest[1:]
            reached = [root]
            while reached and len(rest):
                hit = _near(rest, reached.pop())
                found, rest = rest[hit], rest[~hit]
                reached.extend(found)
                left.append(np.full(len(found), root))
                right.append(found)
    if not left:
        return fp[:0], fp[:0]
    pairs = np.unique(np.stack([np.concatenate(left), np.concatenate(right)]), axis=1)
    return pairs[0], pairs[1]


def _link_rows(batches: Iterator[pa.RecordBatch], most: int | None) -> Iterator[pa.RecordBatch]:
    """Links of rows that come sorted by key; a key of more than ``most`` members is passed on as it is."""
    held_key, held = np.zeros(0, np.int64), np.zeros(0, np.int64)
    passing, seen = None, set()

    def out(a: np.ndarray, b: np.ndarray, later: bool) -> pa.RecordBatch:
        flag = pa.array(np.full(len(a), later))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), flag], names=["a", "b", "later"])

    def new(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        pairs = [p for p in zip(a.tolist(), b.tolist()) if p not in seen]
        if len(seen) > 1_000_000:
            seen.clear()
        seen.update(pairs)
        both = np.array(pairs, np.int64).reshape(-1, 2)
        return out(both[:, 0], both[:, 1], False)

    for batch in batches:
        key = np.r_[held_key, batch.column(0).to_numpy(zero_copy_only=False)]
        fp = np.r_[held, batch.column(1).to_numpy(zero_copy_only=False)]
        if passing is not None:
            more = key == passing
            if more.any():
                yield out(fp[more], key[more], True)
            key, fp = key[~more], fp[~more]
            if not len(key):
                held_key, held = key, fp
                continue
            passing = None
        last = np.searchsorted(key, key[-1])
        yield new(*_links(key[:last], fp[:last]))
        held_key, held = key[last:], fp[last:]
        if most is not None and len(held) > most:
            passing = held_key[0]
            yield out(held, held_key, True)
            held_key, held = held[:0], held[:0]
    if len(held):
        yield new(*_links(held_key, held))


def _finer(batches: Iterator[pa.RecordBatch], level: int) -> Iterator[pa.RecordBatch]:
    """Rows of too large keys under four finer ones: of four quarters of 16 bits, three errors leave one equal."""
    spread = np.arange(64) % 4 if level == 0 else np.arange(64) // 16
    for batch in batches:
        fp, key = (batch.column(n).to_numpy(zero_copy_only=False) for n in (0, 1))
        for quarter in range(4):
            mask = np.uint64(sum(1 << int(b) for b in np.flatnonzero(spread == quarter)))
            mixed = (fp.view(np.uint64) & mask) * np.uint64(0x9E3779B97F4A7C15) ^ key.view(np.uint64)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(quarter)
            yield pa.RecordBatch.from_arrays([pa.array(mixed.view(np.int64)), pa.array(fp)], names=["key", "fp"])


def _blocks(later: DataFrame, group: int) -> DataFrame:
    """Members (a) of keys (b) that stay too large, under a key for each pair of blocks of ``group`` of them.

    Any two members meet in the pair of their blocks, and no pair has more
    than about twice ``group``: exact at any size, at the price of comparing all.
    """
    sizes = later.groupBy(F.col("b").alias("__key")).agg(F.ceil(F.count(F.lit(1)) / group).alias("blocks"))
    rows = join_right(later, ["b"], written(sizes, "key-sizes"), ["__key"], "inner")
    block = F.pmod(F.xxhash64("a"), F.col("blocks"))
    rows = rows.select("a", "b", block.alias("own"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other"))
    return rows.select(F.xxhash64("b", F.least("own", "other"), F.greatest("own", "other")).alias("key"), F.col("a").alias("fp"))


def fingerprint_links(fps: DataFrame, group: int = GROUP) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of ``fp`` within 3 bits.

    ``fps`` is a stored table of different fingerprints. They are dealt to
    tasks of EXPANDED each before their keys are made, each of which takes
    about a hundred times the room. Keys of over ``group`` members are dealt by
    finer ones, twice; where that does not part them, in blocks.
    """
    tasks = -(-fps.count() // EXPANDED)
    rows = (fps.repartition(tasks, "fp") if tasks > 1 else fps).mapInArrow(_key_rows, "key long, fp long")
    links = None
    for level in range(4):
        most = group if level < 3 else None
        sorted_rows = rows.repartition("key").sortWithinPartitions("key")
        found = written(
            sorted_rows.mapInArrow(lambda b, most=most: _link_rows(b, most), "a long, b long, later boolean"), "pairs"
        )
        own = found.where(~F.col("later")).select("a", "b")
        links = own if links is None else links.unionByName(own)
        later = found.where("later").select("a", "b")
        if later.isEmpty():
            break
        if level < 2:
            rows = later.mapInArrow(lambda b, level=level: _finer(b, level), "key long, fp long").distinct()
        else:
            rows = _blocks(later, group)
    return links


def near_duplicates(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints that differ in at most 3 of 64 bits are linked, components
    are closed over links, and a component's id is its smallest doc_id. Only
    doc_id and text are read. Null, empty and blank texts have fingerprint
    zero and link like any other; repeated rows give repeated results; a null
    doc_id never names a component unless all its ids are null; an empty table
    gives an empty result.
    """
    return _rooted(docs, group).select(
        F.col("doc").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _rooted(docs: DataFrame, group: int) -> DataFrame:
    """doc, fp, root (a fingerprint that names the component, whatever its ids) and component_id of each row."""
    rows = written(docs.select("doc_id", "text").mapInArrow(_fingerprints, "doc long, fp long"), "fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.min("doc").alias("first")), "distinct")
    roots = components(fingerprint_links(distinct.select("fp"), group))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first"
    )
    rooted = written(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root").select(F.col("fp").alias("__fp"), "root", "component_id")
    return join_right(rows, ["fp"], named, ["__fp"], "inner").drop("__fp")


def first_of_each(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """``docs`` without near duplicates: the row of the smallest doc_id of each component stays.

    All columns are kept unchanged. Of several rows with that doc_id in the
    component the one of the least text hash stays, also where rows of that
    id are in other components; of documents without an id, which no
    component can name, all stay.
    """
    marked = written(_rooted(docs, group), "marked")
    keep = marked.where(F.col("doc") == F.col("component_id")).groupBy("doc", "root").agg(F.count(F.lit(1)).alias("rows"))
    # An id is alone if all its rows are one; else its rows are told apart by fingerprint.
    own = marked.groupBy("doc").agg(F.count(F.lit(1)).alias("__rows"))
    keep = written(keep.join(own, "doc").select(F.col("doc").alias("__keep"), "root", "__rows"), "keep")
    packed = docs.select(F.struct("*").alias("__row"), F.col("doc_id").alias("__id"))
    once = keep.where("__rows = 1").select("__keep")
    kept = join_right(packed, ["__id"], once, ["__keep"], "left_semi").select("__row")
    kept = kept.unionByName(packed.where(F.col("__id").isNull()).select("__row"))
    repeated = written(keep.where("__rows > 1"), "repeated")
    if not repeated.isEmpty():  # only their rows are shuffled
        ids = repeated.select("__keep").distinct()
        held = join_right(packed, ["__id"], ids, ["__keep"], "left_semi")

        @F.pandas_udf("long")
        def print_of(texts: pd.Series) -> pd.Series:
            found = [fingerprint([w.lower() for w in text_words(t)]) for t in texts]
            return pd.Series(np.array(found, np.uint64).view(np.int64))

        held = held.withColumn("__fp", print_of(F.col("__row.text")))
        roots = marked.where(F.col("doc") == F.col("component_id")).select(F.col("doc").alias("__doc"), F.col("fp").alias("__of"), "root")
        roots = join_right(roots.distinct(), ["__doc"], ids, ["__keep"], "left_semi")
        held = join_right(held, ["__id", "__fp"], roots, ["__doc", "__of"], "inner")
        first = Window.partitionBy("__id", "root").orderBy(F.xxhash64(F.col("__row.text")))
        held = held.withColumn("__n", F.row_number().over(first)).where("__n = 1")
        kept = kept.unionByName(held.select("__row"))
    return kept.select("__row.*")

"""Remove repeated passages found by recompression of word sequences."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keyjoin import join_right
from ..session import written
from .common import text_words

WINDOW = 50
ROUNDS = 6
# Order of symbols by how many words they are: eight or more, five, three, fewer.
_RANK = np.array([3, 3, 3, 2, 2, 1, 1, 1, 0], np.uint64) << np.uint64(62)
_FAR = 1 << 40
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def word_names(words: list[bytes]) -> np.ndarray:
    one = xxhash.xxh3_64_intdigest
    return np.fromiter(map(one, words), np.uint64, len(words))


def recompressed(names: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the symbols after some rounds, and the words [lo, hi) that decide on each.

    A round names every run of one symbol, then every pair of a left and a
    right symbol, where a bit of the name says which it is, so pairs never
    overlap. A name is a hash of what it stands for: equal runs and pairs get
    equal names in all documents, with no table to look them up in. Whether a
    symbol comes about depends on itself and on the neighbours it might have
    joined; [lo, hi) are all words that had a say, so whoever has these words
    has the symbol, whatever stands around them.
    """
    lo = np.arange(len(names), dtype=np.int64)
    hi, width = lo + 1, np.ones(len(names), np.int64)
    for step in range(rounds):
        if step % 3 == 0:
            first = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
            last = np.r_[first[1:], len(names)] - 1
            size = (last - first + 1).astype(np.uint64)
            lo, hi = np.r_[-_FAR, lo][first], np.r_[hi, _FAR][last + 1]
            width = np.add.reduceat(width, first)
            names = np.where(size > 1, _mixed(names[first] + size * _B), names[first])
        right = (_mixed(names + np.uint64(step + 1)) & np.uint64(1)).astype(bool)
        pair = np.flatnonzero(~right[:-1] & right[1:])
        before, after = np.r_[-_FAR, lo[:-1]], np.r_[hi[1:], _FAR]
        new_lo, new_hi = np.where(right, before, lo), np.where(right, hi, after)
        new_lo[pair], new_hi[pair] = lo[pair], hi[pair + 1]
        names = names.copy()
        names[pair] = _mixed(names[pair] * _A + names[pair + 1])
        width[pair] += width[pair + 1]
        keep = np.ones(len(names), bool)
        keep[pair + 1] = False
        names, lo, hi, width = names[keep], new_lo[keep], new_hi[keep], width[keep]
    # Of short symbols many texts have the same, so they come last in the order of names.
    return names >> np.uint64(2) | _RANK[np.minimum(width, len(_RANK) - 1)], lo, hi


def window_names(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each window of 50 words, by doubling."""
    out = []
    for seed in (_A, _B):
        parts, size, have, at = {1: _mixed(names ^ seed)}, 1, None, 0
        while size * 2 <= WINDOW:
            x = parts[size]
            parts[size * 2] = _mixed(x[:-size] * seed + x[size:])
            size *= 2
        count = len(names) - WINDOW + 1
        for size in sorted(parts, reverse=True):
            if WINDOW & size:
                x = parts[size][at : at + count]
                have = x if have is None else _mixed(have * seed + x)
                at += size
        out.append(have)
    return out[0], out[1]


def anchors(names: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each window the smallest name of the symbols it decides on alone, else its own hash.

    Equal windows have equal anchors.
    """
    symbols, lo, hi = recompressed(names)
    at = np.arange(len(windows))
    start, stop = np.searchsorted(lo, at, "left"), np.searchsorted(hi, at + WINDOW, "right")
    found = stop > start
    out = windows.copy()
    if found.any():
        size = stop[found] - start[found]
        tables, width = [symbols], 1
        while width * 2 <= size.max():
            x = tables[-1]
            tables.append(np.minimum(x[:-width], x[width:]))
            width *= 2
        level = np.log2(size).astype(np.int64)
        best = np.empty(len(size), np.uint64)
        for n in np.unique(level):
            own = level == n
            x = tables[n]
            best[own] = np.minimum(x[start[found][own]], x[stop[found][own] - (1 << n)])
        out[found] = best
    return out


def _chunks(batches: Iterator[pa.RecordBatch], column: int, most: int = 200_000) -> Iterator[tuple[list[int], pa.RecordBatch, list[list[bytes]]]]:
    """Slices of rows with their words, of a bounded number of words (or a single text)."""
    for batch in batches:
        first, held, size = 0, [], 0
        for n in range(batch.num_rows):
            words = text_words(batch.column(column)[n].as_py())
            if held and size + len(words) > most:
                yield batch.slice(first, len(held)), held
                first, held, size = n, [], 0
            held.append(words)
            size += len(words)
        if held:
            yield batch.slice(first, len(held)), held


def _windows(lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of some texts: number of the text, first word, anchor, both hashes (as columns).

    The texts are handled as one sequence with a mark after each, which no window holds.
    """
    sizes = np.array([len(x) for x in lists], np.int64)
    starts = np.r_[0, np.cumsum(sizes + 1)]
    total = int(starts[-1])
    names = np.zeros(max(total, WINDOW), np.uint64)
    names[: starts[-1]] = _mixed(np.arange(total, dtype=np.uint64) + _B)
    for words, start in zip(lists, starts):
        names[start : start + len(words)] = word_names(words)
    one, two = window_names(names)
    fits = np.maximum(sizes - WINDOW + 1, 0)
    owner = np.repeat(np.arange(len(lists)), fits)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(fits) - fits, fits)
    at = starts[owner] + place
    return owner, place, anchors(names, one)[at], np.stack([one[at], two[at]])


def _distinct(owner: np.ndarray, *values: np.ndarray) -> np.ndarray:
    """Places of the first of equal rows."""
    order = np.lexsort((*values, owner))
    same = owner[order][1:] == owner[order][:-1]
    for v in values:
        same &= v[order][1:] == v[order][:-1]
    return order[np.r_[True, ~same]] if len(order) else order


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(content, text) to one row (anchor, content) for each anchor of the text."""
    for part, lists in _chunks(batches, 1):
        owner, _, anchor, _ = _windows(lists)
        first = _distinct(owner, anchor)
        content = part.column(0).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor[first].view(np.int64)), pa.array(content[owner[first]])], names=["anchor", "content"]
        )


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text, anchors) to one row (a, b, doc) for each different window with such an anchor."""
    for part, lists in _chunks(batches, 1):
        owner, _, anchor, hashes = _windows(lists)
        keys = part.column(2)
        sets = [np.array(keys[n].as_py(), np.int64).view(np.uint64) for n in range(part.num_rows)]
        which = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        # A pair of text and anchor is looked up as one mixed number; a chance hit only adds a window.
        wanted = np.isin(_mixed(anchor + owner.astype(np.uint64) * _A), _mixed(flat + which.astype(np.uint64) * _A))
        owner, hashes = owner[wanted], hashes[:, wanted]
        first = _distinct(owner, hashes[0], hashes[1])
        doc = part.column(0).to_numpy(zero_copy_only=False)
        arrays = [hashes[0][first].view(np.int64), hashes[1][first].view(np.int64), doc[owner[first]]]
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["a", "b", "doc"])


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _kept(lists: list[list[bytes]], gone: list[np.ndarray | None], whole: list[bool]) -> list[list[bytes]]:
    """The words that are covered by no window whose hash is gone."""
    owner, place, _, hashes = _windows(lists) if any(g is not None for g in gone) else (None,) * 4
    out = []
    for n, words in enumerate(lists):
        if whole[n] and len(words) >= WINDOW:
            out.append([])
        elif gone[n] is None:
            out.append(words)
        else:
            own = owner == n
            starts = place[own][np.isin(hashes[0][own], gone[n])]
            edge = np.zeros(len(words) + 1, np.int64)
            edge[starts] += 1
            np.subtract.at(edge, starts + WINDOW, 1)
            covered = np.cumsum(edge[:-1]) > 0
            out.append([w for w, c in zip(words, covered.tolist()) if not c])
    return out


def _result_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text, first, windows) to the result; whole texts go where a smaller document has the same text."""
    for part, lists in _chunks(batches, 1):
        doc, first, gone = (part.column(n).to_pylist() for n in (0, 2, 3))
        whole = [f is not None and d is not None and f < d for d, f in zip(doc, first)]
        sets = [None if g is None else np.array(g, np.int64).view(np.uint64) for g in gone]
        kept = _kept(lists, sets, whole)
        arrays = [
            pa.array(doc, pa.int64()),
            pa.array([len(x) for x in lists], pa.int64()),
            pa.array([len(x) - len(k) for x, k in zip(lists, kept)], pa.int64()),
            pa.array([_sha(k) for k in kept], pa.string()),
            pa.array([b" ".join(k).decode("utf-8", "surrogatepass") for k in kept], pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, kept (the words that stay, joined by a space).

    A word goes if a window of 50 words that covers it also starts in a
    document with a smaller doc_id. Texts equal to one of a smaller document
    are settled by a digest of the text. Of the others, each window is named
    by its anchor, the smallest high-level symbol that it decides on alone;
    only windows whose anchor occurs in two different texts are looked at, and
    128 bits of hash verify them.

    Only doc_id and text are read. Null and empty texts have no words and the
    digest of none; texts of under 50 words stay; rows of one doc_id do not
    take words from each other; rows without an id stay and take none;
    repeated rows give repeated results; an empty table an empty result.
    """
    rows = docs.select(F.col("doc_id").alias("doc"), "text", F.xxhash64("text").alias("content"))
    digest = F.unhex(F.md5(F.encode("text", "utf-8")))
    equal = (
        rows.where(F.col("text").isNotNull())
        .groupBy(digest.alias("digest"))
        .agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.min("content").alias("__copy"))
    )
    equal = written(equal.where(F.col("first") < F.col("last")).select("__copy", "first"), "copies")
    occurrences = written(
        rows.where(F.col("doc").isNotNull() & F.col("text").isNotNull())
        .select("content", "text").mapInArrow(_anchor_rows, "anchor long, content long"),
        "anchors",
    )
    shared = occurrences.groupBy("anchor").agg(F.min("content").alias("a"), F.max("content").alias("b"))
    shared = shared.where(F.col("a") != F.col("b")).select(F.col("anchor").alias("__anchor"))
    held = occurrences.join(shared, F.col("anchor") == F.col("__anchor"), "left_semi")
    # As many as the text has windows at most.
    of_text = written(
        held.groupBy(F.col("content").alias("__content")).agg(F.collect_set("anchor").alias("__anchors")), "shared"
    )
    known = join_right(rows.where(F.col("doc").isNotNull()), ["content"], of_text, ["__content"], "inner")
    known = join_right(known, ["content"], equal, ["__copy"], "left")
    known = known.where(F.col("first").isNull() | (F.col("first") == F.col("doc")))
    windows = written(
        known.select("doc", "text", "__anchors").mapInArrow(_window_rows, "a long, b long, doc long"),
        "windows",
    )
    least = windows.groupBy("a", "b").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    least = least.where(F.col("least") < F.col("most")).select(F.col("a").alias("__a"), F.col("b").alias("__b"), "least")
    gone = windows.join(least, (F.col("a") == F.col("__a")) & (F.col("b") == F.col("__b")))
    # Texts of one doc_id may share the set: a window that goes in one of them goes in each.
    gone = gone.where(F.col("least") < F.col("doc")).groupBy(F.col("doc").alias("__doc"))
    gone = written(gone.agg(F.collect_set("a").alias("windows")), "gone")
    marked = join_right(rows, ["content"], equal, ["__copy"], "left")
    # Only the texts that lose words are shuffled.
    some = gone.select("__doc")
    without = join_right(marked, ["doc"], some, ["__doc"], "left_anti")
    losing = join_right(marked, ["doc"], some, ["__doc"], "left_semi")
    losing = join_right(losing, ["doc"], gone, ["__doc"], "inner").select("doc", "text", "first", "windows")
    none = F.lit(None).cast("array<bigint>").alias("windows")
    both = without.select("doc", "text", "first", none).unionByName(losing)
    return both.mapInArrow(_result_rows, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")

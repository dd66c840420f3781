"""Quality rules with perplexity bands of a modified Kneser-Ney model of characters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keyjoin import join_right
from ..session import written
from .common import Batches, slices, tidy

ORDER = 5
# Half width of a language's band in robust standard deviations, and what the
# mean of n words may stray by chance besides, in units of 1 / sqrt(n).
BAND, CHANCE = 5.0, 6.0
SYMBOLS = b"#*$%&|<>"
# Characters counted together, and bytes of a part of the model that is sent to tasks at a time.
PIECE = 1 << 20
MODEL_BYTES = 64 << 20
ROW_BYTES = 16
# Bits of the names that a task's table of n-grams it met goes by.
NEAR_BITS = 20
_PRIME, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
# A line end stands before a text so often; a code point 0 counts as 1.
_START = "\n" * (ORDER - 1)


def codes(text: str) -> np.ndarray:
    """Code points of a text after the line ends that start it."""
    code = np.frombuffer((_START + text).encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.maximum(code, 1)


def seed(lang: str | None) -> np.uint64:
    """A number of its own for each language, null too."""
    value = 14695981039346656037
    for byte in b"" if lang is None else b"=" + lang.encode("utf-8", "surrogatepass"):
        value = (value ^ byte) * 0x100000001B3 % (1 << 64)
    return np.uint64(value)


def grams(code: np.ndarray, start: np.uint64) -> np.ndarray:
    """64-bit names of the n-grams of a language that start at each code point but the last ones."""
    key = np.full(max(0, len(code) - ORDER + 1), start, np.uint64)
    for i in range(ORDER):
        key ^= code[i : len(code) - ORDER + 1 + i]
        key *= _PRIME
    key ^= key >> np.uint64(29)
    key *= _MIX
    key ^= key >> np.uint64(32)
    return key.view(np.int64)


class _Counts:
    """Counts of the n-grams of one language in a task: names, how often, and the code points."""

    def __init__(self, lang: str | None) -> None:
        self.start = seed(lang)
        self.waiting: list[np.ndarray] = []
        self.size = 0
        self.names, self.often = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.windows = np.zeros((0, ORDER), np.uint32)

    def add(self, text: str) -> None:
        code = codes(text)
        for at in range(0, len(code) - ORDER + 1, PIECE):
            part = code[at : at + PIECE + ORDER - 1]
            self.waiting.append(part)
            self.size += len(part)
            if self.size > PIECE:
                self.fold()

    def fold(self) -> None:
        if not self.waiting:
            return
        names = np.concatenate([grams(c, self.start) for c in self.waiting])
        order = np.argsort(names)
        names = names[order]
        starts = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
        new, first, often = names[starts], order[starts], np.diff(np.r_[starts, len(names)])
        # Each text has ORDER - 1 more code points than n-grams.
        before = np.cumsum([len(c) - ORDER + 1 for c in self.waiting])
        place = first + (ORDER - 1) * np.searchsorted(before, first, side="right")
        windows = np.concatenate(self.waiting)[place[:, None] + np.arange(ORDER)]
        names, where = np.unique(np.r_[self.names, new], return_inverse=True)
        counts = np.zeros(len(names), np.int64)
        np.add.at(counts, where, np.r_[self.often, often])
        kept = np.zeros((len(names), ORDER), np.uint32)
        kept[where] = np.concatenate([self.windows, windows])
        self.names, self.often, self.windows = names, counts, kept
        self.waiting, self.size = [], 0


@tidy
def _count(batches: Batches) -> Batches:
    """lang, gram, key, n of the task's texts; a bounded table is sent on and begun anew."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("key", pa.int64()), ("n", pa.int64())])
    held: dict[str | None, _Counts] = {}

    def out() -> Batches:
        for lang, counts in held.items():
            counts.fold()
            texts = np.ascontiguousarray(counts.windows).view(f"<U{ORDER}").ravel().tolist()
            arrays = [pa.array([lang] * len(texts), pa.string()), pa.array(texts, pa.string()), pa.array(counts.names), pa.array(counts.often)]
            yield from pa.Table.from_arrays(arrays, schema=schema).to_batches(1 << 16)
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if value := text.as_py():
                held.setdefault(lang, _Counts(lang)).add(value)
                if sum(len(c.names) for c in held.values()) > 4 * PIECE:
                    yield from out()
    yield from out()


def count_grams(docs: DataFrame) -> DataFrame:
    """lang, gram, key, n: how often each n-gram of ORDER characters occurs in all texts of a language."""
    counted = docs.select("lang", "text").mapInArrow(_count, "lang string, gram string, key long, n long")
    return counted.groupBy("lang", "gram").agg(F.first("key").alias("key"), F.sum("n").alias("n"))


def _discounts(level: DataFrame) -> DataFrame:
    """lang, d1, d2, d3 of one order: by how many n-grams have counts 1 to 4, each taken as one more."""
    n = {i: F.count_if(F.col("n") == i) + 1 for i in range(1, 5)}
    share = n[1] / (n[1] + 2 * n[2])
    cut = [F.greatest(F.lit(0.0), i - (i + 1) * share * n[i + 1] / n[i]).alias(f"d{i}") for i in range(1, 4)]
    return level.groupBy("lang").agg(*cut)


def kneser_ney(counts: DataFrame) -> DataFrame:
    """lang, key, log: log probabilities of the last character of each n-gram after the others.

    Interpolated modified Kneser-Ney, order by order as joins of tables of
    n-grams: the highest order has counts, the lower ones numbers of different
    n-grams they end. Nothing of it passes the driver.
    """
    known = F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))  # a null language is one of its own
    levels = [counts.select(known.alias("lang"), "gram", "key", "n")]
    for size in range(ORDER - 1, 0, -1):
        ends = levels[0].select("lang", F.substring("gram", 2, size).alias("gram"))
        levels.insert(0, written(ends.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n")), "ends"))
    letters = levels[0].groupBy("lang").agg((1 / (F.count(F.lit(1)) + 1)).alias("lower"))
    below = None
    for size, level in enumerate(levels, 1):
        cuts = _discounts(level)
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = level.join(cuts, "lang").withColumn("cut", F.least(cut, F.col("n"))).withColumn("context", F.substring("gram", 1, size - 1))
        contexts = rows.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum("cut").alias("left"))
        rows = rows.join(contexts, ["lang", "context"])
        if below is None:
            rows = rows.join(letters, "lang")
        else:
            lower = below.select("lang", F.col("gram").alias("shorter"), F.col("p").alias("lower"))
            rows = rows.withColumn("shorter", F.substring("gram", 2, size - 1)).join(lower, ["lang", "shorter"])
        p = (F.col("n") - F.col("cut") + F.col("left") * F.col("lower")) / F.col("total")
        last = [F.col("key")] if size == ORDER else []
        below = written(rows.select("lang", "gram", *last, p.alias("p")), "probabilities")
    return below.select("lang", "key", F.log("p").alias("log"))


def n_repeat_words(words: list[bytes]) -> int:
    """Words in windows of five words that occur twice or more in the text."""
    n = len(words)
    if n < 6:
        return 0
    rough = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    mixed = rough[: n - 4].copy()
    for i in range(1, 5):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + rough[i : n - 4 + i]
    mixed.sort()
    if not (mixed[1:] == mixed[:-1]).any():  # different hashes are different windows
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    # Windows are named by pairs of names of shorter windows, so equal names are equal words.
    two = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1]
    four = np.unique(two[:-2] * n + two[2:], return_inverse=True)[1]
    _, five, often = np.unique(four[:-1] * n + ids[4:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(often[five] > 1)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + 5, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    # A code point is a byte that continues none; white space is no part of a word.
    chars = len(text) - len(data) + len(data.translate(None, b" \t\n\x0b\x0c\r"))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), n_repeat_words(words)




# Signs: neither letter nor digit nor white space; bytes of longer characters are letters.
_SIGNS = bytes(i for i in range(128) if not chr(i).isalnum() and not chr(i).isspace())


def spoken(text: str | None) -> int:
    """Words that have a letter or digit: rows of signs and table bars count for no word."""
    return len(text.encode("utf-8", "surrogatepass").translate(None, _SIGNS).split()) if text else 0


class Part:
    """A part of the model: names of n-grams in order, and their log probabilities.

    Those met last stay in a small table of a place for each head of a name,
    which most n-grams of a text are found in.
    """

    def __init__(self, names: np.ndarray, logs: np.ndarray) -> None:
        self.names, self.logs, self.seeds = names, logs, {}
        self.near = np.zeros(1 << NEAR_BITS, np.int64)
        self.near[0] = -1  # a name that belongs elsewhere: nothing is known yet
        self.near_logs = np.zeros(1 << NEAR_BITS)

    def logs_of(self, used: np.ndarray) -> np.ndarray:
        """Log probabilities by name, 0 for names of other parts."""
        place = (used.view(np.uint64) >> np.uint64(64 - NEAR_BITS)).astype(np.int64)
        out = self.near_logs[place]
        far = np.flatnonzero(self.near[place] != used)
        if len(far):
            names = used[far]
            at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
            out[far] = np.where(self.names[at] == names, self.logs[at], 0.0)
            self.near[place[far]] = names
            self.near_logs[place[far]] = out[far]
        return out

    def surprise(self, lang: str | None, text: str | None) -> float:
        """Sum of the negative logs of those n-grams of a text that are in this part."""
        if not text or not len(self.names):
            return 0.0
        if lang not in self.seeds:
            self.seeds[lang] = seed(lang)
        key = np.sort(grams(codes(text), self.seeds[lang]))
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        return float(-(self.logs_of(key[starts]) * np.diff(np.r_[starts, len(key)])).sum())


_COUNTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_spoken")


def _facts(sent):
    """Rows (doc_id, lang, text, k1, k2) to doc_id, lang, counts, the surprise of one part, k1, k2."""

    @tidy
    def run(batches: Batches) -> Batches:
        part = Part(*sent.value)
        names = ["doc_id", "lang", *_COUNTED, "surprise", "k1", "k2"]
        for batch in batches:
            for few in slices(batch, 2, 256, 1 << 22):
                rows = []
                for lang, value in zip(few.column(1).to_pylist(), few.column(2)):
                    text = value.as_py()
                    rows.append((*base_counts(text), spoken(text), part.surprise(lang, text)))
                counted = [pa.array(c, pa.int64()) for c in list(zip(*rows))[:-1]]
                surprise = pa.array([r[-1] for r in rows], pa.float64())
                arrays = [few.column(0), few.column(1), *counted, surprise, few.column(3), few.column(4)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def _surprises(sent):
    """Rows (lang, text, k1, k2) to k1, k2 and the surprise of one part."""

    @tidy
    def run(batches: Batches) -> Batches:
        part = Part(*sent.value)
        for batch in batches:
            for few in slices(batch, 1, 256, 1 << 22):
                found = [part.surprise(lang, v.as_py()) for lang, v in zip(few.column(0).to_pylist(), few.column(1))]
                arrays = [few.column(2), few.column(3), pa.array(found, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["k1", "k2", "more"])

    return run


def _send(spark: SparkSession, rows: DataFrame):
    """A part of the model to all tasks, in the order of its names."""
    table = rows.select("key", "log").toArrow()
    keys, logs = table.column(0).to_numpy(), table.column(1).to_numpy()
    order = np.argsort(keys, kind="stable")
    return spark.sparkContext.broadcast((keys[order], logs[order]))


def document_facts(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, lang, the base counts, n_spoken and surprise (negative log probability of the text).

    The model is made of all texts, so it has every n-gram of a document, and
    a document's surprise is a sum over its n-grams. It is sent to the tasks
    in parts of about MODEL_BYTES, by ranges of the hashed names: as many as it
    takes, each met by all documents in a pass of its own, and what the parts
    give is added up by text.
    """
    spark = docs.sparkSession
    model = written(kneser_ney(written(count_grams(docs), "grams")), "model")
    parts = max(1, -(-model.count() * ROW_BYTES // MODEL_BYTES))
    at = F.floor((F.shiftright("key", 32) + (1 << 31)) * parts / float(1 << 32))
    lang = F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))
    content = [F.xxhash64(F.lit(n), lang, "text").alias(f"k{n}") for n in (1, 2)]
    texts = docs.select("doc_id", "lang", "text", *content)
    counted = ", ".join(f"{c} long" for c in _COUNTED)
    first = _send(spark, model.where(at == 0))
    facts = texts.mapInArrow(_facts(first), f"doc_id long, lang string, {counted}, surprise double, k1 long, k2 long")
    if parts == 1:
        return facts.drop("k1", "k2")
    rest = None
    for n in range(1, parts):
        sent = _send(spark, model.where(at == n))
        found = texts.select("lang", "text", "k1", "k2").mapInArrow(_surprises(sent), "k1 long, k2 long, more double")
        found = found.groupBy("k1", "k2").agg(F.max("more").alias("more"))  # copies of a text agree
        rest = found if rest is None else rest.unionByName(found)
        rest = written(rest.groupBy("k1", "k2").agg(F.sum("more").alias("more")), "surprises")
        sent.destroy()
    rest = rest.select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), "more")
    facts = join_right(facts, ["k1", "k2"], rest, ["__k1", "__k2"], "left")
    return facts.withColumn("surprise", F.col("surprise") + F.coalesce("more", F.lit(0.0))).select(
        "doc_id", "lang", *_COUNTED, "surprise"
    )


def _limits(passed: DataFrame) -> DataFrame:
    """__of, __median, __mad: the middle and the median distance from it of each language's own documents."""
    middle = passed.groupBy("lang").agg(F.percentile_approx("bits", 0.5, 10000).alias("__median"))
    middle = written(middle.withColumnRenamed("lang", "__of"), "medians")
    joined = join_right(passed, ["lang"], middle, ["__of"], "inner")
    far = F.abs(F.col("bits") - F.col("__median"))
    return written(joined.groupBy("__of", "__median").agg(F.percentile_approx(far, 0.5, 10000).alias("__mad")), "bands")


def judge(docs: DataFrame, band: float = BAND, chance: float = CHANCE) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, bits.

    A document fails the base rules with under ten words or with over a fifth
    of its words in repeated windows. Of the others those are kept whose
    perplexity lies in the band of their language, up and down alike. It is
    taken per word that has a letter or digit, as ``bits``, its logarithm to
    base two: so bars and rows of signs, each easy to foresee, raise it. The
    band is the median of the language's documents that pass the base rules,
    ``band`` robust deviations (1.4826 times the median distance) wide to both
    sides, and wider by ``chance`` over the root of the number of words.

    Only doc_id, lang and text are read, texts whole, however long. Null and
    empty texts count no words and fail; a null language is one of its own;
    repeated rows give repeated results and count each; languages of few
    documents have bands of their own all the same; equal distances are
    inside; an empty table gives an empty result.
    """
    facts = written(document_facts(docs), "facts")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    words = F.greatest(F.col("n_spoken"), F.lit(1))
    bits = F.when(F.col("n_words") > 0, F.col("surprise") / (words * float(np.log(2))))
    facts = facts.withColumn("base_failed", failed).withColumn("bits", bits)
    passed = facts.where(~F.col("base_failed")).select("lang", "bits")
    judged = join_right(facts, ["lang"], _limits(passed), ["__of"], "left")
    wide = band * 1.4826 * F.col("__mad") + chance / F.sqrt(words)
    inside = F.abs(F.col("bits") - F.col("__median")) <= wide
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        kept.alias("kept"), "bits",
    )

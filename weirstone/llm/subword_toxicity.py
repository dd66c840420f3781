"""Toxicity by averaged subword embeddings under a linear softmax, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Batches, slices, tidy

# The labelled rows a model is fitted on: so many of each label at most, of so
# many characters each, the smallest hashes of their ids.
TOXIC_ROWS, CLEAN_ROWS, ROW_CHARS = 1200, 2000, 4000
BUCKET_BITS, DIM, GRAMS = 16, 4, (3, 4, 5)
ROUNDS, RATE, DECAY, SHARPNESS, RIDGE = 20, 0.1, 1e-6, 30.0, 0.01
# Refits to the highest windows, and how many of them a clean and a toxic document gives.
REFITS, HARD = 4, (6, 2)
BUCKETS = 1 << BUCKET_BITS
THRESHOLD = 0.3
REMEMBERED = 100_000
# Texts scored together, and their bytes.
PART_ROWS, PART_BYTES = 256, 1 << 22
# Words per window: a document scores as its window of the highest mean.
WINDOW = 2
# Signs that end a word, as white space does.
_CLEAN = bytes(32 if chr(i) in ".,;:!?\"'()[]{}*#$%&|<>-_" else i for i in range(256))
_PRIME, _MIX = np.uint64(1_000_003), np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str | None) -> list[bytes]:
    """Lower-case words of a text without signs."""
    return text.lower().encode("utf-8", "replace").translate(_CLEAN).split() if text else []


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and of their n-grams of 3 to 5 characters, with marked ends, and where each word's start.

    All words are hashed together: a polynomial of the code points from each place on.
    """
    text = f"<{b'><'.join(words).decode('utf-8', 'replace')}>"
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    starts = np.flatnonzero(code == ord("<"))
    sizes = np.diff(np.r_[starts, len(code)])
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(code)) - starts[owner]
    powers = np.cumprod(np.full(int(sizes.max()) + 1, _PRIME))
    hashes = [np.add.reduceat(code * powers[place], starts)]
    owners = [np.arange(len(words))]
    for n in GRAMS:
        rolled = np.full(max(0, len(code) - n + 1), n, np.uint64)
        for i in range(n):
            rolled = rolled * _PRIME + code[i : len(code) - n + 1 + i]
        inside = place[: len(rolled)] + n <= sizes[owner[: len(rolled)]]
        hashes.append(rolled[inside])
        owners.append(owner[: len(rolled)][inside])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    buckets = ((np.concatenate(hashes) * _MIX) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)[order]
    return buckets, np.searchsorted(owner[order], np.arange(len(words)))


def _of_words(words: list[bytes]) -> list[np.ndarray]:
    buckets, starts = subwords(words)
    return np.split(buckets, starts[1:])


class _Mean:
    """Means of chosen rows, as a linear map with its transpose."""

    def __init__(self, lists: list[np.ndarray], columns: int) -> None:
        sizes = np.array([len(x) for x in lists])
        self.index = np.concatenate(lists)
        self.starts = np.r_[0, np.cumsum(sizes)[:-1]]
        self.share = (1 / sizes).astype(np.float32)[:, None]
        row = np.repeat(np.arange(len(lists)), sizes)
        order = np.argsort(self.index, kind="stable")
        self.row = row[order]
        used = self.index[order]
        self.first = np.flatnonzero(np.r_[True, used[1:] != used[:-1]])
        self.used, self.columns = used[self.first], columns

    def apply(self, matrix: np.ndarray) -> np.ndarray:
        return np.add.reduceat(matrix[self.index], self.starts, axis=0) * self.share

    def transposed(self, grads: np.ndarray) -> np.ndarray:
        out = np.zeros((self.columns, grads.shape[1]), np.float32)
        out[self.used] = np.add.reduceat((grads * self.share)[self.row], self.first, axis=0)
        return out


class ToxicModel:
    """A number for each bucket and an offset: what the embeddings and the softmax come to for one label.

    A word's vector is the mean of its subwords' vectors, so a misspelling
    shares most of it; a window's is the mean of its words'.
    """

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights, self.bias = weights, bias
        self.known: dict[bytes, float] = {}

    def learn(self, words: Iterable[bytes]) -> None:
        """Make the words' values known; they are computed together, the memory of them is bounded."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = list(set(words) - self.known.keys())
        for at in range(0, len(new), 50_000):
            part = new[at : at + 50_000]
            buckets, starts = subwords(part)
            sizes = np.diff(np.r_[starts, len(buckets)])
            self.known.update(zip(part, (np.add.reduceat(self.weights[buckets], starts) / sizes).tolist()))

    def scores(self, texts: list[str | None]) -> list[float]:
        """Probabilities of label 1: of the highest window; of an empty text, of the offset alone."""
        lists = [tokens(t) for t in texts]
        self.learn(w for words in lists for w in words)
        best = np.array([self.margin(words) for words in lists]) + self.bias
        return (1 / (1 + np.exp(-np.clip(best, -30, 30)))).tolist()

    def windows(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
        """Means and starts of the windows of a list of words, and their size."""
        total = np.r_[0.0, np.cumsum(np.fromiter(map(self.known.__getitem__, words), np.float64, len(words)))]
        size = min(WINDOW, len(words))
        start = np.arange(len(words) - size + 1)
        return (total[start + size] - total[start]) / size, start, size

    def margin(self, words: list[bytes]) -> float:
        """Mean of the highest window; 0 without words."""
        return float(self.windows(words)[0].max()) if words else 0.0


def _softmax(logits: np.ndarray) -> np.ndarray:
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _descend(
    values: dict, known: dict, lists: list[list[bytes]], labels: np.ndarray, sharpness: float, rounds: int
) -> None:
    """Fit embeddings, softmax and offset jointly (Adam) to lists of words with labels of equal weight."""
    vocabulary: dict[bytes, int] = {}
    chosen = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words]) for words in lists]
    new = [w for w in vocabulary if w not in known]
    if new:
        known.update(zip(new, _of_words(new)))
    of_words = _Mean([known[w] for w in vocabulary], BUCKETS)
    of_lists = _Mean(chosen, len(vocabulary))
    balance = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    weight = (balance / len(lists)).astype(np.float32)[:, None]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in values.items()}
    for step in range(1, rounds + 1):
        vectors = of_lists.apply(of_words.apply(values["e"])) * sharpness
        p = _softmax(vectors @ values["w"] + values["b"])
        p[np.arange(len(lists)), labels] -= 1
        p = (p * weight).astype(np.float32)
        grads = {
            "e": of_words.transposed(of_lists.transposed(p @ values["w"].T * sharpness)) + DECAY * values["e"],
            "w": vectors.T @ p,
            "b": p.sum(axis=0),
        }
        for k, g in grads.items():
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            values[k] -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)


def _logistic(x: np.ndarray, labels: np.ndarray, balance: np.ndarray) -> tuple[float, float]:
    """Factor and offset of a one-dimensional logistic fit by Newton's method; the ridge keeps it finite."""
    centre, width = x.mean(), x.std() + 1e-9
    x = np.stack([(x - centre) / width, np.ones(len(x))], axis=1)
    fitted = np.zeros(2)
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ fitted, -30, 30)))
        slope = x.T @ (balance * (labels - q)) - RIDGE * fitted
        curve = x.T @ (x * (balance * q * (1 - q))[:, None]) + RIDGE * np.eye(2)
        fitted += np.clip(np.linalg.solve(curve, slope), -2, 2)
    return fitted[0] / width, fitted[1] - centre * fitted[0] / width


def train(rows: Iterable[tuple[str, int]], seed: int = 7) -> ToxicModel:
    """Fit a model to texts with labels; without both labels it knows only their share.

    The first fit takes each document as the mean of all its words, where
    SHARPNESS makes up for how few of them decide. The next ones take the
    windows that then score highest: of a toxic document those that carry its
    label, of a clean one those most easily mistaken. A last fit of two
    numbers maps a document's highest window to a probability.
    """
    rows = [(tokens(t), int(y)) for t, y in rows]
    rows = [(w, y) for w, y in rows if w]
    labels = np.array([y for _, y in rows], np.int64)
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    if not len(labels) or labels.min() == labels.max():
        return ToxicModel(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    random, known = np.random.default_rng(seed), {}
    values = {
        "e": random.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32),
        "w": random.normal(0, 0.5, (DIM, 2)).astype(np.float32),
        "b": np.zeros(2, np.float32),
    }
    _descend(values, known, [w for w, _ in rows], labels, SHARPNESS, ROUNDS)
    for _ in range(REFITS):
        plain = ToxicModel(values["e"] @ (values["w"][:, 1] - values["w"][:, 0]), 0.0)
        plain.learn(known)
        lists, owners = [], []
        for n, (words, label) in enumerate(rows):
            means, starts, size = plain.windows(words)
            for at in np.argsort(-means, kind="stable")[: HARD[label]]:
                lists.append(words[starts[at] : starts[at] + size])
                owners.append(n)
        _descend(values, known, lists, labels[np.array(owners)], 3.0, ROUNDS // 2)
    weights = values["e"] @ (values["w"][:, 1] - values["w"][:, 0])
    plain = ToxicModel(weights, 0.0)
    plain.learn(known)
    highest = np.array([plain.margin(words) for words, _ in rows])
    factor, bias = _logistic(highest, labels, np.ones(len(rows)))
    return ToxicModel((weights * factor).astype(np.float32), float(bias))


def held_out(doc_id: Column) -> Column:
    """Whether labels of an id are kept from training: crc32 of its text mod 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> ToxicModel:
    """A model of the labelled rows that are not held out, at most the sample stated above."""
    known = labels.select(F.col("doc_id").alias("__id"), F.col("toxic").alias("__toxic"))
    known = known.where(F.col("__toxic").isin(0, 1) & F.col("__id").isNotNull() & ~held_out(F.col("__id")))
    known = known.groupBy("__id").agg(F.max("__toxic").alias("__toxic"))
    short = docs.select("doc_id", "text").where(F.length("text").between(1, ROW_CHARS))
    sampled = []
    for value, most in ((1, TOXIC_ROWS), (0, CLEAN_ROWS)):
        own = known.where(F.col("__toxic") == value)
        # The ids are chosen first, so only the texts of the sample move.
        ids = short.select("doc_id").join(own, F.col("doc_id") == F.col("__id")).select("__id").distinct()
        ids = ids.orderBy(F.xxhash64("__id"), "__id").limit(most)
        rows = short.join(F.broadcast(ids), F.col("doc_id") == F.col("__id"))
        rows = rows.groupBy("__id").agg(F.min("text").alias("text"))
        sampled += [(r["__id"], r["text"], value) for r in rows.collect()]
    return train([(t, y) for _, t, y in sorted(sampled, key=lambda r: r[0])])


def _scored(own: ToxicModel, batches: Batches, column: int) -> Iterator[tuple[pa.RecordBatch, list[float]]]:
    """Parts of batches, few and bounded in bytes, with the scores of a text column."""
    for batch in batches:
        for part in slices(batch, column, PART_ROWS, PART_BYTES):
            yield part, own.scores(part.column(column).to_pylist())


def score(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    Only doc_id and text are read, and only the text decides the score. Null,
    empty and blank texts score the model's offset; long texts are scored
    whole, by their highest window; repeated rows score alike; an empty table
    gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    @tidy
    def run(batches: Batches) -> Batches:
        for part, scores in _scored(ToxicModel(*sent.value), batches, 1):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose text is not predicted toxic, all columns unchanged; cases as :func:`score`.

    Rows are scored where they lie, in one pass, a few at a time.
    """
    model = fit(docs, labels)
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    column = docs.columns.index("text")

    @tidy
    def run(batches: Batches) -> Batches:
        for part, scores in _scored(ToxicModel(*sent.value), batches, column):
            kept = part.filter(pa.array([s < THRESHOLD for s in scores], pa.bool_()))
            if kept.num_rows:
                yield kept

    return docs.mapInArrow(run, docs.schema)

"""The prefix trie and whitening against plain computations, on whole tables and odd ones."""

import os
import random
import sys

import numpy as np
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from weirstone.llm import prefix_trie, whitening  # noqa: E402
from weirstone.llm import queries as q  # noqa: E402

FOLDER = os.environ.get("TEST_LLM_DIR", "/root/testdata/sf0.01")
TURNS = "conv_id long, turn long, role string, text string, depth int, ka string, words long, at long"


def turns(spark, rows):
    return spark.createDataFrame([(*r, 7, "k", 1, 2) for r in rows], TURNS).repartition(5)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[1]))


def test_trie_of_the_given_conversations(spark):
    found = pq.read_table(f"{FOLDER}/conversations.parquet").to_pydict()
    rows = list(zip(*(found[c] for c in ("conv_id", "turn", "role", "text"))))
    assert rows_of(q.op12_prefix_trie(spark, FOLDER)) == sorted(brute.prefix_trie(rows), key=lambda r: r[:2])


def odd_turns():
    """Nulls, ties, copies, a long conversation, many equal ones, families without a first one, negative ids."""
    pick = random.Random(5)
    rows = [(c, t, pick.choice(["user", None]), pick.choice(["a b", "c", "", None])) for c in range(90) if c != 40 for t in range(c % 6)]
    rows += [(c, t, "user", f"same {t}") for c in range(200, 420) for t in range(3)]
    rows += [(7, t, "user", f"turn {t % 5}") for t in range(100, 400)]
    rows += [(27, t, "user", f"turn {t % 5}") for t in range(100, 350)]
    rows += [(3, None, "system", "first"), (3, 1, "b", "tie"), (3, 1, "a", "tie"), (3, 1, "a", "tie"), (3, 1, "a", "tie 2")]
    rows += [(None, 1, "user", "nobody"), (-5, 0, "user", "x y z"), (-20, 0, "user", "p"), (-25, 3, "user", "q")]
    return [*rows, (500, 0, "user", "word " * 20_000)]


@pytest.mark.parametrize("sizes", [(8, 4096, 256), (2, 16, 3)])
def test_trie_of_odd_conversations(spark, monkeypatch, sizes):
    for name, size in zip(("BAND", "BLOCK", "PIECE"), sizes):
        monkeypatch.setattr(prefix_trie, name, size)
    rows = [r for r in odd_turns() if r[3] not in ("tie", "tie 2")] + [(3, 1, "a", "tie"), (3, 1, "b", "tie"), (3, 1, "a", "tie")]
    found = prefix_trie.prefix_trie(turns(spark, rows))
    assert [d for _, d in found.dtypes] == ["bigint"] * 7 + ["string"]
    assert rows_of(found) == sorted(brute.prefix_trie(rows), key=lambda r: r[:2])


def test_trie_of_equal_turns_is_the_same_in_any_order(spark):
    rows = odd_turns()
    one, two = (rows_of(prefix_trie.prefix_trie(turns(spark, given))) for given in (rows, rows[::-1]))
    assert one == two


def test_trie_of_an_empty_table(spark):
    assert prefix_trie.prefix_trie(turns(spark, odd_turns()).limit(0)).count() == 0


def test_bands_bound_what_a_row_meets(spark, monkeypatch):
    """A conversation of 100 turns in bands of 3: four rounds, each row among three ancestors at most."""
    monkeypatch.setattr(prefix_trie, "BAND", 3)
    rounds = []
    plain = prefix_trie.rolled_up

    def counted(nodes, chain, deepest, step=1):
        rounds.append(step)
        return plain(nodes, chain, deepest, step)

    monkeypatch.setattr(prefix_trie, "rolled_up", counted)
    rows = [(0, t, "user", f"w{t}") for t in range(100)]
    found = {r.depth: r for r in prefix_trie.prefix_trie(turns(spark, rows)).collect()}
    assert rounds == [1, 3, 9, 27, 81]
    assert len(found) == 101 and all(r.n_leaves == 1 for r in found.values())


def plain_whitening(vectors, components=32):
    x = np.floor(64 * np.array(vectors, float)) + 1_000_000
    mean, n = x.mean(axis=0), len(x)
    covariance = (x - mean).T @ (x - mean) / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    exact = x.astype(np.int64).astype(object)
    deviation = ((n * exact - exact.sum(axis=0)) ** 2).sum(axis=1)
    return (x - mean) @ axes / np.sqrt(values), values / np.trace(covariance), deviation


def check_whitening(rows, ids, vectors, components=32):
    white, explained, deviation = plain_whitening(vectors, components)
    found = {(r.vec_id, r.component): r for r in rows}
    width = white.shape[1]
    assert len(found) == len(rows) == len(ids) * width
    for k in range(width):
        own = np.array([found[i, k + 1].whitened for i in ids])
        assert np.abs(own - np.sign(own @ white[:, k]) * white[:, k]).max() < 1e-7
        assert found[ids[0], k + 1].explained == pytest.approx(explained[k], rel=1e-9)
    assert [found[i, 1].deviation for i in ids] == list(deviation)
    assert {r.n for r in rows} == {len(ids)} and max(r.identity_error for r in rows) < 1e-9


def test_whitening_of_the_given_vectors(spark):
    found = pq.read_table(f"{FOLDER}/embeddings.parquet").to_pydict()
    check_whitening(q.op13_whitening(spark, FOLDER).collect(), found["vec_id"], found["embedding"])


def test_whitening_of_odd_vectors(spark):
    random = np.random.default_rng(3)
    good = (random.normal(size=(60, 5)) * [1e5, 300.0, 2, 1, 0.1] + [0, 5e5, 0, -7, 0]).astype(np.float32).tolist()
    odd = [None, [], [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [float("inf")] * 5, [1.0, 2.0]]
    schema = "vec_id long, embedding array<float>, component int, n string, white int"
    rows = [(i, v, 1, "n", 2) for i, v in enumerate(good + good[:3] + odd)]
    df = spark.createDataFrame(rows, schema).repartition(4)
    check_whitening(whitening.whiten(df).collect(), list(range(63)), good + good[:3])
    check_whitening(whitening.whiten(df, 2).collect(), list(range(63)), good + good[:3], 2)
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.where("vec_id = 1")).count() == 0
    assert whitening.whiten(df.where("vec_id >= 63 AND vec_id < 65")).count() == 0
    assert {r.component for r in whitening.whiten(df.where("vec_id < 3")).collect()} == {1, 2}  # rank two
    large = spark.createDataFrame([(1, [1e30]), (2, [0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit a long"):
        whitening.whiten(large).collect()


def test_factor_and_rotations():
    random = np.random.default_rng(1)
    for width, rank in ((1, 1), (6, 6), (7, 4), (64, 64)):
        half = random.normal(size=(width, rank)) * 10.0 ** -np.arange(rank)[:rank].clip(max=5)
        matrix = half @ half.T
        factor, order = whitening.pivoted_cholesky(matrix)
        assert factor.shape[1] == rank
        assert np.allclose(factor @ factor.T, matrix[np.ix_(order, order)], atol=1e-12 * np.trace(matrix))
        values, vectors = whitening.eigenpairs(matrix)
        assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:rank], rtol=1e-6, atol=1e-13 * values[0])
        assert np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-9)
        assert np.allclose(matrix @ vectors, vectors * values, atol=1e-12 * values[0])

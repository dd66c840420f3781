"""Vectors linked by cosine against all pairs: near copies, scaled copies, dense groups, odd vectors."""

import os
import sys

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from weirstone.llm import cover_tree  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int, node string, rep long, k1 long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "n", 1, 2) for i, v in rows], SCHEMA).repartition(4)


def plain(vectors, least=0.95):
    """(n_links, component) of rows of doubles, by all products at once."""
    x = np.array(vectors, np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= least
    np.fill_diagonal(link, False)
    label = np.arange(len(x))
    while True:
        new = np.minimum(label, np.where(link, label[None, :], len(x)).min(axis=1))
        if (new == label).all():
            return link.sum(axis=1), label
        label = new


def check(spark, vectors, least=0.95):
    rows = sorted(cover_tree.near_vectors(frame(spark, list(enumerate(vectors))), least).collect())
    links, label = plain(vectors, least)
    assert [tuple(r) for r in rows] == [(i, links[i], label[i], label[i] == i) for i in range(len(vectors))]


def crowded(seed, centres, copies, spread, width=16):
    """Groups of near copies of all tightnesses, with exact and scaled copies."""
    random = np.random.default_rng(seed)
    middle = random.normal(size=(centres, width))
    rows = [m + random.normal(size=width) * spread * random.random() for m in middle for _ in range(random.integers(1, copies))]
    rows += [2 * r for r in rows[:9]] + rows[:20] + rows[:20] + [rows[0]] * 30
    rows += [r * random.uniform(0.1, 9) for r in rows[:9]]
    return [rows[i].astype(np.float32).tolist() for i in random.permutation(len(rows))]


@pytest.mark.parametrize("sizes", [(2048, 32, 64), (60, 4, 2)])
def test_groups(spark, monkeypatch, sizes):
    for name, size in zip(("LEAF", "FAN", "PARTNERS"), sizes):
        monkeypatch.setattr(cover_tree, name, size)
    check(spark, crowded(3, 60, 12, 0.8))


def test_one_dense_group_in_small_leaves(spark, monkeypatch):
    for name, size in (("LEAF", 100), ("FAN", 4), ("GROUP", 100)):
        monkeypatch.setattr(cover_tree, name, size)
    random = np.random.default_rng(9)
    middle = random.normal(size=24)
    check(spark, [(middle + random.normal(size=24) * 0.25).astype(np.float32).tolist() for _ in range(400)])


def test_many_vectors_of_one_direction(spark, monkeypatch):
    for name, size in (("LEAF", 40), ("FAN", 4)):
        monkeypatch.setattr(cover_tree, name, size)
    check(spark, [[float(n), 2.0 * n, -3.0 * n] for n in range(1, 120)] + [[1.0, 0.0, 0.0]])


def test_levels_of_one_direction_end(spark, monkeypatch):
    """Rows no centre tells apart are parted at every level, whatever numbers they have."""
    for name, size in (("LEAF", 40), ("FAN", 4)):
        monkeypatch.setattr(cover_tree, name, size)
    tables, written = [], cover_tree.written

    def few(df, purpose):
        tables.append(purpose)
        assert len(tables) < 40, "the levels do not end"
        return written(df, purpose)

    monkeypatch.setattr(cover_tree, "written", few)
    rows = [((n % 8 << 33) + n // 8, 1, [float(n), 2.0 * n, -3.0 * n]) for n in range(1, 601)]
    leaves, _ = cover_tree._upper_levels(spark.createDataFrame(rows, "rep long, w long, v array<double>"))
    sizes = [r["count"] for r in leaves.groupBy("node").count().collect()]
    assert sum(sizes) == 600 and max(sizes) <= 40


def test_nodes_that_are_all_links_are_not_opened(spark, monkeypatch):
    """Near copies over many leaves are counted by the radii of the nodes: no leaf of theirs meets another."""
    for name, size in (("LEAF", 40), ("FAN", 4)):
        monkeypatch.setattr(cover_tree, name, size)
    tables, written = {}, cover_tree.written

    def kept(df, purpose):
        tables[purpose] = written(df, purpose)
        return tables[purpose]

    monkeypatch.setattr(cover_tree, "written", kept)
    random = np.random.default_rng(6)
    ones = [(n * np.array([1.0, 2.0, -3.0])).astype(np.float32).tolist() for n in range(1, 201)]
    near = [(np.array([5.0, -1.0, 0.5]) + random.normal(size=3) * 0.02).astype(np.float32).tolist() for _ in range(200)]
    check(spark, ones + near + near[:7] + [[0.0, 1.0, 1.0]])
    leaves = tables["leaves"].select("node").distinct().count()
    assert leaves > 8 and tables["leaf-pairs"].where("a != b").count() < leaves


@pytest.mark.parametrize("least", [0.3, 0.9])
def test_some_nodes_are_all_links_and_others_are_opened(spark, monkeypatch, least):
    for name, size in (("LEAF", 30), ("FAN", 3), ("PARTNERS", 2)):
        monkeypatch.setattr(cover_tree, name, size)
    random = np.random.default_rng(8)
    middle = random.normal(size=(6, 4))
    rows = [m + random.normal(size=4) * spread for m, spread in zip(middle, (0.02, 0.05, 0.1, 0.2, 0.4, 0.8)) for _ in range(45)]
    check(spark, [r.astype(np.float32).tolist() for r in rows + rows[:40:3]], least)


def test_leaves_that_are_all_links_are_not_gone_through(monkeypatch):
    monkeypatch.setattr(cover_tree.Meeting, "visit", lambda *_: pytest.fail("the rows were looked at one by one"))
    x = np.random.default_rng(1).normal(size=(300, 4)) * 0.01 + 1
    paths, weights = cover_tree.nested(cover_tree._unit(x)), np.arange(1, 301)
    one, two = (cover_tree.Leaf(np.arange(300) + shift, weights, x, paths, np.arange(300, dtype=np.int32)) for shift in (0, 300))
    for other, extra in ((None, 0), (two, weights.sum())):
        found = cover_tree.Meeting(one, other, 0.95).found().to_pydict()
        expected = {int(i): int(weights.sum() - (0 if extra else w)) for i, w in zip(one.reps, one.weights)}
        assert {r: n for r, n in zip(found["rep"], found["n_links"]) if r < 300} == expected


def shuffled_rows(plan):
    """Rows that the exchanges of an executed plan wrote."""
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if node.nodeName().startswith("Exchange"):
            found += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(n) for n in range(children.size())]
    return found


def test_vectors_are_not_shuffled_for_their_partners(spark, monkeypatch):
    """All leaves meet, but what is shuffled for that grows with the leaves, not with vectors times leaves."""
    for name, size in (("LEAF", 20), ("FAN", 16)):
        monkeypatch.setattr(cover_tree, name, size)
    tables, written = {}, cover_tree.written

    def kept(df, purpose):
        tables[purpose] = written(df, purpose)
        return tables[purpose]

    monkeypatch.setattr(cover_tree, "written", kept)
    random = np.random.default_rng(11)
    rows = [(n, 1, v) for n, v in enumerate(random.normal(size=(160, 64)).tolist())]
    met = cover_tree.linked_pairs(spark.createDataFrame(rows, "rep long, w long, v array<double>"))
    leaves = tables["leaves"].select("node").distinct().count()
    assert leaves >= 10 and tables["leaf-pairs"].count() > leaves * leaves // 3
    plan = met._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    assert shuffled_rows(plan) < 4 * 160


@pytest.mark.parametrize("few, kind", [(0, "float"), (1 << 21, "int")])
def test_levels_dealt_by_a_shuffle_or_by_a_broadcast(spark, monkeypatch, few, kind):
    """Numbers of either precision, several levels, files and leaves a task keeps, vectors of several lengths."""
    for name, size in (("LEAF", 30), ("FAN", 4), ("FEW_CELLS", few), ("PARTNERS", 3), ("GUEST_CELLS", 200), ("GROUP", 50)):
        monkeypatch.setattr(cover_tree, name, size)
    random = np.random.default_rng(12)
    middle = random.normal(size=(12, 6)) * 100
    rows = [(m + random.normal(size=6) * 8 * random.random()).tolist() for m in middle for _ in range(15)]
    rows = [[int(c) for c in r] for r in rows] if kind == "int" else rows
    rows = [[float(np.float32(c)) for c in r] for r in rows] if kind == "float" else rows
    short = [r[:2] for r in rows[:50]]
    frame = spark.createDataFrame(list(enumerate(rows + short)), f"vec_id long, embedding array<{kind}>").repartition(4)
    found = sorted(tuple(r) for r in cover_tree.near_vectors(frame).collect())
    assert found == brute.cosine_groups([(i, [float(c) for c in v]) for i, v in enumerate(rows + short)], 0.95)


def test_tables_of_levels_are_dropped_when_all_rows_went_on(spark, monkeypatch):
    for name, size in (("LEAF", 20), ("FAN", 4)):
        monkeypatch.setattr(cover_tree, name, size)
    tables, written = [], cover_tree.written

    def kept(df, purpose):
        df = written(df, purpose)
        tables.append((purpose, df))
        return df

    monkeypatch.setattr(cover_tree, "written", kept)
    random = np.random.default_rng(13)
    rows = [(n, 1, v) for n, v in enumerate(random.normal(size=(400, 8)).tolist())]
    leaves, tree = cover_tree._upper_levels(spark.createDataFrame(rows, "rep long, w long, v array<double>"))
    assert leaves.count() == 400 and tree.count() > 0
    moved = [df.inputFiles()[0].removeprefix("file:") for purpose, df in tables if purpose == "moved"]
    assert len(moved) > 1 and not os.path.exists("/" + moved[0].lstrip("/")) and os.path.exists("/" + moved[-1].lstrip("/"))


@pytest.mark.parametrize("least", [0.0, 0.5, 0.999])
def test_other_thresholds(spark, least):
    check(spark, crowded(5, 30, 8, 1.0, 6), least)


def test_leaves_count_what_all_pairs_count():
    """The traversal alone, also where it has rows of a leaf without its centres."""
    random = np.random.default_rng(2)
    for width, spread in ((2, 0.3), (8, 0.3), (32, 0.2)):
        x = np.repeat(random.normal(size=(40, width)), 25, axis=0) + random.normal(size=(1000, width)) * spread
        paths = cover_tree.nested(cover_tree._unit(x))
        reps, weights, place = np.arange(1000), random.integers(1, 4, 1000), np.arange(1000, dtype=np.int32)
        units = cover_tree._unit(x)
        link = units @ units.T >= 0.95
        np.fill_diagonal(link, False)
        whole = cover_tree.Leaf(reps, weights, x, paths, place)
        found = cover_tree.Meeting(whole, None, 0.95).found().to_pydict()
        expected = link @ weights
        assert dict(zip(found["rep"], found["n_links"])) == {i: n for i, n in enumerate(expected) if n}
        one, two = (np.flatnonzero(pick) for pick in (np.arange(1000) % 3 > 0, np.arange(1000) % 3 == 0))
        a, b = (cover_tree.Leaf(reps[p], weights[p], x[p], paths[p], place[p]) for p in (one, two))
        found = cover_tree.Meeting(a, b, 0.95).found().to_pydict()
        expected = {int(i): int(link[i, o] @ weights[o]) for p, o in ((one, two), (two, one)) for i in p if link[i, o].any()}
        assert dict(zip(found["rep"], found["n_links"])) == expected


def test_levels_nest_and_halve():
    units = cover_tree._unit(np.random.default_rng(4).normal(size=(500, 3)))
    paths = cover_tree.nested(units)
    apart = np.sqrt(np.maximum(0, 2 - 2 * units @ units.T))
    radius = apart[0].max()
    for k in range(paths.shape[1]):
        chosen = np.unique(paths[:, k])
        if k:
            assert set(np.unique(paths[:, k - 1])) <= set(chosen)
            radius /= 2
            assert (apart[np.ix_(chosen, chosen)] + 9 * np.eye(len(chosen)) > radius).all()
            assert apart[:, chosen].min(axis=1).max() <= radius
        assert (paths[chosen, k] == chosen).all()


def test_odd_vectors(spark):
    near = [[1.0, 0.1, 0.0], [1.0, 0.0, 0.0], [1.0, 0.0, 0.0], [3e38, 3e37, 0.0], [1e-38, 0.0, 0.0], [-1.0, 0.0, 0.0]]
    odd = [None, [], [0.0, 0.0, 0.0], [1.0, None, 0.0], [float("nan"), 1.0, 1.0], [float("inf"), 1.0, 1.0], [1.0, 0.1], [0.0, -0.0, 0.0]]
    rows = [(5 * i + 2, v) for i, v in enumerate(near + odd)]
    found = sorted(tuple(r) for r in cover_tree.near_vectors(frame(spark, rows)).collect())
    assert found == brute.cosine_groups([(i, v and [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows], 0.95)
    assert cover_tree.near_vectors(frame(spark, rows).limit(0)).count() == 0
    assert [tuple(r) for r in cover_tree.near_vectors(frame(spark, rows[:1])).collect()] == [(2, 0, 2, True)]
    assert cover_tree.near_vectors(frame(spark, [(i, v) for i, v in rows if v in odd])).where("kept AND n_links = 0").count() == len(odd)


def test_repeated_and_null_ids(spark):
    a, b = [1.0, 0.0], [0.0, 1.0]
    rows = [(4, a), (4, b), (2, b), (None, a), (None, [-1.0, 0.0])]
    found = sorted((tuple(r) for r in cover_tree.near_vectors(frame(spark, rows)).collect()), key=str)
    assert found == sorted([(4, 1, 4, True), (4, 1, 2, False), (2, 1, 2, True), (None, 1, 4, False), (None, 0, None, False)], key=str)


def test_messages_are_bounded():
    """A row of the result for each row with links, whatever the number of pairs."""
    x = np.random.default_rng(1).normal(size=(300, 4)) * 0.01 + 1
    leaf = cover_tree.Leaf(np.arange(300), np.ones(300, int), x, cover_tree.nested(cover_tree._unit(x)), np.arange(300, dtype=np.int32))
    found = cover_tree.Meeting(leaf, None, 0.95).found()
    assert isinstance(found, pa.RecordBatch) and found.num_rows == 300
    assert found.column("n_links").to_pylist() == [299] * 300 and len(set(found.column("other").to_pylist())) == 1

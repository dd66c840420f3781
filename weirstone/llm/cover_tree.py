"""Vectors linked by cosine: a cover tree, and pairs of its nodes pruned by covering radii.

Lengths are taken away, so a cosine is a distance: d * d = 2 - 2 * cosine. The
upper levels of the tree are tables, one node a row; each leaf's own levels are
built in one task, and a leaf is one row. Leaves that may hold links meet in a
nested loop over the written table, so no vector is shuffled for a pair. Pairs
of nodes go down together. A pair whose centres are
further apart than the distance asked for and both covering radii holds no
link, one whose centres and radii together stay within it holds nothing else.
Radii are those measured, so both tests are certain.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keyjoin import join_right
from ..session import dropped, written
from .components import components

LEAST = 0.95
# Vectors of a leaf, children of a node, vectors its centres are chosen from, and
# vectors one task deals to them.
LEAF, FAN, SAMPLE, GROUP = 2_048, 32, 1_024, 8_192
# Leaves of one file: those of two files, or of a few small ones, meet in one task.
# A file has about so many numbers at most, and few leaves are parted into so many files.
PARTNERS, FILE_CELLS, FILES = 64, 1 << 22, 16
# Levels inside a leaf; centres this close are one.
LEVELS, SAME = 8, 1e-7
# What rounding may do to a distance, and to a cosine.
SLACK, CLOSE = 1e-7, 1e-12
# Nodes whose names and sizes are broadcast without a further count.
FEW_NODES = 100_000
# Numbers of the leaves a task keeps to meet its next one.
GUEST_CELLS = 1 << 22
# Numbers in the centres of a level that are sent to the tasks whole.
FEW_CELLS = 1 << 21
# Cells of a block of products.
CELLS = 1 << 20


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of equal length as rows of doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), len(values) // max(len(column), 1))


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True, initial=1e-320)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _apart(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * cosines))


def _lists(rows: np.ndarray) -> pa.ListArray:
    starts = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(starts), pa.array(rows.ravel()))


def nested(units: np.ndarray) -> np.ndarray:
    """For each row the centres it is below, from the coarsest level on.

    The centres of a level are those of the one before and any row further
    than half the radius from all of them; the parent of a new one is the
    nearest centre of the level before. Levels end when most rows are centres.
    """
    apart = _apart(units @ units.T)
    radius, chosen = float(apart[0].max()), [0]
    nearest = apart[0].copy()
    parents: list[dict[int, int]] = []
    for _ in range(LEVELS - 1):
        radius /= 2
        if radius < SAME or len(chosen) > len(units) // 2:
            break
        before, above = list(chosen), {c: c for c in chosen}
        while True:
            far = int(np.argmax(nearest > radius))
            if nearest[far] <= radius:
                break
            above[far] = before[int(np.argmin(apart[far, before]))]
            chosen.append(far)
            nearest = np.minimum(nearest, apart[far])
        parents.append(above)
    at = np.array(chosen)[np.argmin(apart[:, chosen], axis=1)]
    path = [at]
    for above in reversed(parents):
        at = np.array([above[int(c)] for c in at])
        path.append(at)
    return np.stack(path[::-1], axis=1).astype(np.int32)


class Leaf:
    """Rows of a leaf in the order of their paths, so that every node is a range of them."""

    def __init__(self, reps: np.ndarray, weights: np.ndarray, vectors: np.ndarray, paths: np.ndarray, place: np.ndarray) -> None:
        order = np.lexsort(paths.T[::-1])
        self.reps, self.weights, self.raw = reps[order], weights[order], vectors[order]
        self.units, self.paths, self.place = _unit(self.raw), paths[order], place[order]
        paths, place = self.paths, self.place
        self.rough = self.units.astype(np.float32)
        rows = np.arange(len(order))
        self.levels = []  # starts, centres and covering radii of the nodes of a level
        for k in range(paths.shape[1]):
            new = np.r_[True, (paths[1:, : k + 1] != paths[:-1, : k + 1]).any(axis=1)]
            starts = np.flatnonzero(new)
            owner = np.cumsum(new) - 1
            centres = starts.copy()  # the centre may have stayed away: then the first row stands for it
            own = place == paths[:, k]
            centres[owner[own]] = rows[own]
            far = _apart(np.einsum("ij,ij->i", self.units, self.units[centres[owner]]))
            self.levels.append((np.r_[starts, len(rows)], centres, np.maximum.reduceat(far, starts)))
        self.levels.append((np.r_[rows, len(rows)], rows, np.zeros(len(rows))))
        self.sums = np.r_[0, np.cumsum(self.weights)]

    def within_reach(self, host: Leaf, within: float) -> Leaf | None:
        """The rows that may have a link to one of the host's."""
        _, centres, radii = host.levels[0]
        own = np.flatnonzero(_apart(self.units @ host.units[centres[0]]) <= within + radii[0] + SLACK)
        if len(own) == len(self.reps):
            return self
        return Leaf(self.reps[own], self.weights[own], self.raw[own], self.paths[own], self.place[own]) if len(own) else None

    def level(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.levels[min(k, len(self.levels) - 1)]

    def below(self, k: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end of the children of nodes of level k."""
        starts, children = self.level(k)[0], self.level(k + 1)[0]
        return np.searchsorted(children, starts[nodes]), np.searchsorted(children, starts[nodes + 1])


class Meeting:
    """A dual traversal of two leaves, or of one with itself: links counted, components joined."""

    def __init__(self, a: Leaf, b: Leaf | None, least: float) -> None:
        self.a, self.b, self.same = a, a if b is None else b, b is None
        self.least, self.within = least, math.sqrt(max(0.0, 2 - 2 * least))
        self.shift = 0 if self.same else len(a.reps)
        self.links = np.zeros(self.shift + len(self.b.reps), np.int64)
        self.label = np.arange(len(self.links))
        self.last = max(len(a.levels), len(self.b.levels)) - 1
        top = np.zeros(1, np.int64)
        self.judge(0, top, top, self.a.units[self.a.level(0)[1]] @ self.b.units[self.b.level(0)[1][0]])

    def unite(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while len(i):
            x, y = label[i], label[j]
            differ = x != y
            if not differ.any():
                return
            i, j, x, y = i[differ], j[differ], x[differ], y[differ]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (label[label] != label).any():
                label[:] = label[label]

    def linked(self, i: np.ndarray, j: np.ndarray) -> None:
        """Pairs of rows that are links."""
        if len(i):
            np.add.at(self.links, i, self.b.weights[j])
            np.add.at(self.links, j + self.shift, self.a.weights[i])
            self.unite(i, j + self.shift)

    def all_linked(self, k: int, u: np.ndarray, v: np.ndarray) -> None:
        """Pairs of nodes all of whose rows are links."""
        first, second = self.a.level(k)[0], self.b.level(k)[0]
        for x, y in zip(u.tolist(), v.tolist()):
            s, e, p, q = first[x], first[x + 1], second[y], second[y + 1]
            if self.same and x == y:
                self.links[s:e] += self.a.sums[e] - self.a.sums[s] - self.a.weights[s:e]
                self.unite(np.arange(s, e), np.full(e - s, s))
                continue
            self.links[s:e] += self.b.sums[q] - self.b.sums[p]
            self.links[self.shift + p : self.shift + q] += self.a.sums[e] - self.a.sums[s]
            self.unite(np.arange(s, e), np.full(e - s, self.shift + p))
            self.unite(np.arange(p, q) + self.shift, np.full(q - p, s))

    def judge(self, k: int, u: np.ndarray, v: np.ndarray, cosines: np.ndarray) -> None:
        """Decide on pairs of nodes of level k, and go down with those that remain."""
        radii = self.a.level(k)[2][u] + self.b.level(k)[2][v]
        if k >= self.last:
            link = cosines >= self.least
            for n in np.flatnonzero(np.abs(cosines - self.least) < CLOSE):
                link[n] = self.exact(int(u[n]), int(v[n]))
            link &= ~(self.same & (u == v))
            self.linked(u[link], v[link])
            return
        apart = _apart(cosines)
        sure = apart + radii <= self.within - SLACK
        self.all_linked(k, u[sure], v[sure])
        left = ~sure & (apart <= self.within + radii + SLACK)
        if left.any():
            self.visit(k, u[left], v[left])

    def exact(self, i: int, j: int) -> bool:
        x, y = self.a.raw[i].tolist(), self.b.raw[j].tolist()
        most = max(map(abs, x)), max(map(abs, y))
        x, y = [c / most[0] for c in x], [c / most[1] for c in y]
        return math.sumprod(x, y) / math.sqrt(math.sumprod(x, x) * math.sumprod(y, y)) >= self.least

    def visit(self, k: int, u: np.ndarray, v: np.ndarray) -> None:
        """The children of pairs of nodes of level k: many children by blocks of products, few all together."""
        (fu, eu), (fv, ev) = self.a.below(k, u), self.b.below(k, v)
        many = (eu - fu) * (ev - fv)
        mine, theirs = self.a.level(k + 1)[1], self.b.level(k + 1)[1]
        width = self.a.units.shape[1]
        rounded = CLOSE + (width + 4) * 2.0**-23  # what single precision may do to a cosine
        for n in np.flatnonzero(many > 1024):
            height = max(1, CELLS // int(ev[n] - fv[n]))
            others, far = theirs[fv[n] : ev[n]], self.b.level(k + 1)[2][fv[n] : ev[n]]
            for top in range(int(fu[n]), int(eu[n]), height):
                end = min(top + height, int(eu[n]))
                own, radii = mine[top:end], self.within + self.a.level(k + 1)[2][top:end] + SLACK
                # Here already: most pairs go, and no list is made of them.
                block = self.a.rough[own] @ self.b.rough[others].T
                least = (1 - (radii + far.max()) ** 2 / 2 - rounded).astype(np.float32)
                i, j = np.divmod(np.flatnonzero(block >= least[:, None]), len(others))
                left = block[i, j] >= 1 - (radii[i] + far[j]) ** 2 / 2 - rounded
                i, j = i[left], j[left]
                if self.same and u[n] == v[n]:
                    upper = i + top <= j + fv[n]
                    i, j = i[upper], j[upper]
                if 4 * len(i) * width > CELLS:
                    cosines = (self.a.units[own] @ self.b.units[others].T)[i, j]
                else:
                    cosines = np.einsum("ij,ij->i", self.a.units[own[i]], self.b.units[others[j]])
                self.judge(k + 1, i + top, j + fv[n], cosines)
        few = np.flatnonzero(many <= 1024)
        sizes = many[few]
        for part in np.split(few, np.flatnonzero(np.diff(np.cumsum(sizes) // (CELLS // 16))) + 1) if len(few) else ():
            number = many[part]
            own = np.repeat(part, number)
            at = np.arange(len(own)) - np.repeat(np.cumsum(number) - number, number)
            wide = (ev - fv)[own]
            x, y = fu[own] + at // wide, fv[own] + at % wide
            if self.same:
                keep = (u[own] != v[own]) | (x <= y)
                x, y = x[keep], y[keep]
            self.judge(k + 1, x, y, np.einsum("ij,ij->i", self.a.units[mine[x]], self.b.units[theirs[y]]))

    def found(self) -> pa.RecordBatch:
        """rep, n_links (of this meeting), other: a row all of the component are joined to."""
        reps = self.a.reps if self.same else np.r_[self.a.reps, self.b.reps]
        own = np.flatnonzero(self.links)
        arrays = [pa.array(x[own]) for x in (reps, self.links, reps[self.label])]
        return pa.RecordBatch.from_arrays(arrays, names=["rep", "n_links", "other"])


def _centres(table: pa.Table) -> pa.Table:
    """The centres a node's sample gives its children: apart by half the covering radius, or by less if these are too few."""
    node, n = table.column("node")[0].as_py(), table.column("n")[0].as_py()
    order = np.argsort(table.column("rep").to_numpy(), kind="stable")
    units = _unit(_matrix(table.column("v")))[order]
    wanted = int(min(FAN, max(2, -(-2 * n // LEAF))))
    first = _apart(units @ units[0])
    radius, chosen, nearest = float(first.max()), [0], first
    while len(chosen) < wanted and radius > SAME:
        radius /= 2
        while len(chosen) < wanted:
            far = int(np.argmax(nearest > radius))
            if nearest[far] <= radius:
                break
            chosen.append(far)
            nearest = np.minimum(nearest, _apart(units @ units[far]))
    # Rows of one direction have no other centres: they are dealt by their numbers.
    chosen = np.resize(chosen, wanted) if radius <= SAME else chosen
    names = [f"{node}.{i}" for i in range(len(chosen))]
    return pa.table({"node": [node] * len(names), "child": names, "centre": _lists(units[chosen])})


def _nearest(units: np.ndarray, centres: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row and how far it is, of equally near ones any by ``pick``."""
    apart = _apart(units @ centres.T)
    near = apart <= apart.min(axis=1, keepdims=True) + SAME
    chosen = np.argmax(np.cumsum(near, axis=1) > (pick % near.sum(axis=1))[:, None], axis=1)
    return chosen, apart[np.arange(len(units)), chosen]


def _children(centres: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Names and centres of the children of a node, by name."""
    names = np.array(centres.column("child").to_pylist(), object)
    order = np.argsort(names.astype(str), kind="stable")
    return names[order], _matrix(centres.column("centre"))[order]


def _deal(rows: pa.Table, centres: pa.Table) -> pa.Table:
    """Rows of a node at the nearest of its centres."""
    names, places = _children(centres)
    chosen, far = _nearest(_unit(_matrix(rows.column("v"))), places, rows.column("pick").to_numpy())
    return pa.table({
        "rep": rows.column("rep"), "w": rows.column("w"), "v": rows.column("v"), "node": pa.array(names[chosen], pa.string()),
        "far": pa.array(far),
    })


def _deal_all(sent: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of many nodes at the nearest of their node's centres, all of which the task has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy(zero_copy_only=False).astype(str)
            order = np.argsort(nodes, kind="stable")
            table, nodes = pa.Table.from_batches([batch]).take(pa.array(order)), nodes[order]
            starts = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]]) if len(nodes) else []
            pick = table.column("pick").to_numpy()
            found, far = np.empty(len(nodes), object), np.empty(len(nodes))
            for start, end in zip(starts, [*starts[1:], len(nodes)]):
                names, places = sent.value[nodes[start]]
                units = _unit(_matrix(table.column("v").slice(start, end - start)))
                chosen, far[start:end] = _nearest(units, places, pick[start:end])
                found[start:end] = names[chosen]
            moved = table.select(["rep", "w", "v"]).append_column("node", pa.array(found, pa.string()))
            yield from moved.append_column("far", pa.array(far)).to_batches()

    return run


def _rows(reps: DataFrame) -> str:
    return f"rep long, w long, v {reps.schema['v'].dataType.simpleString()}, node string"


def _upper_levels(reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(leaves, tree): rows with their leaf, and parent, node, centre, radius of all nodes but the roots."""
    spark = reps.sparkSession
    dealt = reps.select("rep", "w", "v", F.size("v").cast("string").alias("node"))
    before, leaves, tree = None, None, spark.createDataFrame([], "parent string, node string, centre array<double>, radius double")
    while True:
        counts = dealt.groupBy(F.col("node").alias("__node")).agg(F.count(F.lit(1)).alias("n"))
        counts = written(counts, "node-sizes")
        full = counts.where(F.col("n") > LEAF)
        nodes, over = counts.agg(F.count(F.lit(1)), F.count_if(F.col("n") > LEAF)).first()
        few = True if nodes <= FEW_NODES else None
        if over < nodes or not nodes:
            done = join_right(dealt, ["node"], counts.where(F.col("n") <= LEAF).select("__node"), ["__node"], "left_semi", broadcast=few)
            leaves = done if leaves is None else leaves.unionByName(done)
        if not over:
            return leaves, tree
        rows = join_right(dealt, ["node"], full, ["__node"], "inner", broadcast=few).drop("__node")
        # About SAMPLE rows of each node, chosen by their numbers.
        sample = rows.where(F.pmod(F.xxhash64("rep", F.lit(7)), F.col("n")) < SAMPLE)
        centres = sample.groupBy("node").applyInArrow(_centres, "node string, child string, centre array<double>")
        centres = written(centres, "centres")
        # Another number in each node: rows that one level left together are parted by the next.
        rows = rows.withColumn("pick", F.xxhash64("rep", "node"))
        schema = f"{_rows(reps)}, far double"
        if centres.agg(F.sum(F.size("centre"))).first()[0] <= FEW_CELLS:
            table = centres.toArrow()
            parents = np.array(table.column("node").to_pylist(), object)
            sent = spark.sparkContext.broadcast({n: _children(table.filter(pa.array(parents == n))) for n in set(parents)})
            moved = rows.select("rep", "w", "v", "node", "pick").mapInArrow(_deal_all(sent), schema)
            moved = written(moved, "moved")
            sent.destroy()
        else:
            salts = F.ceil(F.col("n") / GROUP)
            rows = rows.withColumn("salt", F.pmod(F.xxhash64("rep", F.lit(8)), salts))
            copies = full.select(F.col("__node").alias("node"), F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)).alias("salt"))
            shared = centres.join(copies, "node").groupBy("node", "salt")
            moved = written(rows.groupBy("node", "salt").cogroup(shared).applyInArrow(_deal, schema), "moved")
        radii = moved.groupBy("node").agg(F.max("far").alias("radius"))
        level = centres.select(F.col("node").alias("parent"), F.col("child").alias("node"), "centre").join(radii, "node")
        tree = tree.unionByName(written(level.select("parent", "node", "centre", "radius"), "level"))
        if before is not None and over == nodes:
            dropped(before)  # all its rows are in the next one
        before, dealt = moved, moved.drop("far")


def _leaf_pairs(leaves: DataFrame, tree: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Two tables of a, b: pairs of leaves that may hold links, and pairs of nodes all of whose rows are links.

    Both have pairs of a leaf or node with itself. Each two rows are in one pair at most.
    """
    spark = tree.sparkSession
    within = math.sqrt(max(0.0, 2 - 2 * least))
    tree = written(tree, "tree")
    inner = tree.select(F.col("parent").alias("node")).distinct()
    # A leaf stays as it is while others go down.
    ends = tree.join(inner, "node", "left_anti")
    steps = tree.withColumn("leaf", F.lit(False)).join(ends.select("node", F.lit(True).alias("end")), "node", "left")
    steps = steps.withColumn("leaf", F.coalesce("end", F.lit(False))).drop("end")
    steps = steps.unionByName(ends.withColumn("parent", F.col("node")).withColumn("leaf", F.lit(True)))
    steps = written(steps, "steps")
    roots = leaves.select(F.col("width").cast("string").alias("a")).distinct()
    pairs = roots.join(inner.withColumnRenamed("node", "a"), "a", "left_anti")
    found = pairs.select("a", F.col("a").alias("b"))
    whole = spark.createDataFrame([], "a string, b string")
    open_pairs = inner.join(roots, F.col("node") == F.col("a"), "left_semi").select(F.col("node").alias("a"), F.col("node").alias("b"))

    def side(name: str) -> DataFrame:
        return steps.select(F.col("parent").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("node", "centre", "radius", "leaf")])

    square = F.zip_with("a_centre", "b_centre", lambda x, y: (x - y) * (x - y))
    apart = F.sqrt(F.aggregate(square, F.lit(0.0), lambda s, x: s + x))
    while not open_pairs.isEmpty():
        both = open_pairs.join(side("a"), "a").join(side("b"), "b")
        both = both.where((F.col("a") != F.col("b")) | (F.col("a_node") <= F.col("b_node")))
        both = both.withColumn("apart", apart).withColumn("radii", F.col("a_radius") + F.col("b_radius"))
        both = both.where(F.col("apart") <= within + F.col("radii") + SLACK)
        sure = F.col("apart") + F.col("radii") <= within - 4 * SLACK  # two radii and a distance, each rounded
        end = F.col("a_leaf") & F.col("b_leaf")
        both = written(both.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"), sure.alias("sure"), end.alias("end")), "node-pairs")
        whole = whole.unionByName(both.where("sure").select("a", "b"))
        found = found.unionByName(both.where("NOT sure AND end").select("a", "b"))
        open_pairs = both.where("NOT sure AND NOT end").select("a", "b")
    return found, whole


def _whole_links(leaves: DataFrame, whole: DataFrame) -> DataFrame:
    """rep, n_links, other: what pairs of nodes give all of whose rows are links, by the weights of the nodes."""
    size = F.aggregate("weights", F.lit(0).cast("bigint"), lambda s, w: s + w)
    sizes = written(leaves.select("node", size.alias("size"), F.array_min("reps").alias("first")), "leaf-sizes")
    parts = F.split("node", r"\.")
    names = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "."))
    above = sizes.select("node", "size", "first", F.posexplode(names).alias("depth", "above"))
    nodes = above.groupBy("above").agg(F.sum("size").alias("size"), F.min("first").alias("first"))
    sides = whole.unionByName(whole.where("a != b").select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = sides.join(nodes, F.col("b") == F.col("above")).groupBy("a")
    linked = linked.agg(F.sum("size").alias("links"), F.bool_or(F.col("a") == F.col("b")).alias("own"))
    linked = linked.join(nodes.select(F.col("above").alias("a"), "first"), "a")
    # Rows of a node with a partner are one component, so those below it need no other row to be joined to.
    own = above.drop("first").join(linked, F.col("above") == F.col("a")).groupBy("node").agg(
        F.sum("links").alias("links"), F.bool_or("own").alias("own"), F.min_by("first", "depth").alias("other")
    )
    # A row is no link of itself.
    members = leaves.select("node", F.explode(F.arrays_zip(F.col("reps").alias("rep"), F.col("weights").alias("w"))).alias("r"))
    rows = members.select("node", "r.*").join(own, "node").select("rep", (F.col("links") - F.when(F.col("own"), F.col("w")).otherwise(0)).alias("n_links"), "other")
    ends = [nodes.select(F.col("above").alias(side), F.col("first").alias(name)) for side, name in (("a", "rep"), ("b", "other"))]
    joined = whole.where("a != b").join(ends[0], "a").join(ends[1], "b")
    return rows.unionByName(joined.select("rep", F.lit(0).cast("bigint").alias("n_links"), "other"))


_LEAF = "node string, width int, reps array<bigint>, weights array<bigint>, levels int, path binary, vectors binary"


def _plant(table: pa.Table) -> pa.Table:
    """The rows of a leaf as one: by rep, with their path through its levels, in single precision if that is all they have."""
    table = table.take(pa.array(np.argsort(table.column("rep").to_numpy(), kind="stable")))
    vectors = _matrix(table.column("v"))
    path = nested(_unit(vectors))
    with np.errstate(over="ignore"):
        single = vectors.astype(np.float32)
    return pa.table({
        "node": pa.array([table.column("node")[0].as_py()], pa.string()), "width": pa.array([vectors.shape[1]], pa.int32()),
        "reps": pa.array([table.column("rep").to_numpy()], pa.list_(pa.int64())),
        "weights": pa.array([table.column("w").to_numpy()], pa.list_(pa.int64())),
        "levels": pa.array([path.shape[1]], pa.int32()), "path": pa.array([path.tobytes()], pa.binary()),
        "vectors": pa.array([(single if (single == vectors).all() else vectors).tobytes()], pa.binary()),
    })


def _leaf(batch: pa.RecordBatch, n: int, side: str) -> Leaf:
    """A leaf in a row of pairs of leaves."""
    reps, weights = (batch.column(f"{side}_{c}")[n].values.to_numpy() for c in ("reps", "weights"))
    path = np.frombuffer(batch.column(f"{side}_path")[n].as_buffer(), np.int32).reshape(len(reps), -1)
    flat, width = batch.column(f"{side}_vectors")[n].as_buffer(), batch.column(f"{side}_width")[n].as_py()
    vectors = np.frombuffer(flat, np.float32 if flat.size == 4 * width * len(reps) else np.float64).reshape(len(reps), width)
    return Leaf(reps, weights, vectors.astype(np.float64), path, np.arange(len(reps), dtype=np.int32))


def _meet(least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of pairs of leaves, a and b, what they find in each other; of a leaf with itself, what it finds there."""
    within = math.sqrt(max(0.0, 2 - 2 * least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, host, guests, room = None, None, {}, GUEST_CELLS
        for batch in batches:
            for n, (a, b) in enumerate(zip(batch.column("a_node").to_pylist(), batch.column("b_node").to_pylist())):
                if a != name:
                    name, host = a, _leaf(batch, n, "a")
                if a == b:
                    yield Meeting(host, None, least).found()
                    continue
                guest = guests.get(b) or _leaf(batch, n, "b")
                if b not in guests and guest.raw.size <= room:
                    guests[b], room = guest, room - guest.raw.size
                guest = guest.within_reach(host, within)
                if guest is not None:
                    yield Meeting(host, guest, least).found()

    return run


def linked_pairs(reps: DataFrame, least: float = LEAST) -> DataFrame:
    """rep, n_links, other: parts of each row's links (weights of the others), and a row it is joined to.

    ``reps`` has rep (a number of its own), w and v. A link is a cosine of at
    least ``least``. Vectors of different length have none.
    """
    rows, tree = _upper_levels(reps)
    sizes = rows.groupBy("node").agg(F.sum(F.size("v").cast("bigint")).alias("cells"))
    number, cells = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("cells"), F.lit(0))).first()
    files = max(1, min(number, FILES), -(-number // PARTNERS), -(-cells // FILE_CELLS))
    leaves = written(rows.repartition(files, "node").groupBy("node").applyInArrow(_plant, _LEAF), "leaves")
    pairs, whole = _leaf_pairs(leaves, tree, least)
    pairs, whole = written(pairs, "leaf-pairs"), written(whole, "whole-pairs")

    # Which of two leaves has the other in its list is left to a hash, so none has all.
    to_a = F.pmod(F.xxhash64("a", "b"), F.lit(2)) == 0
    lists = pairs.select(
        F.when(to_a, F.col("a")).otherwise(F.col("b")).alias("host"), F.when(to_a, F.col("b")).otherwise(F.col("a")).alias("guest")
    ).groupBy("host").agg(F.collect_list("guest").alias("guests"))
    hosts, guests = (leaves.select(*[F.col(c).alias(f"{side}_{c}") for c in leaves.columns]) for side in "ab")
    hosts = join_right(hosts, ["a_node"], written(lists, "partners"), ["host"], "inner", hot_rows=None).drop("host")
    # Each task reads its files of leaves again; a shuffle would carry a leaf once for each of its partners.
    both = hosts.hint("shuffle_replicate_nl").join(guests, F.expr("array_contains(guests, b_node)")).drop("guests")
    met = both.mapInArrow(_meet(least), "rep long, n_links long, other long")
    return met.unionByName(_whole_links(leaves, whole))


def near_vectors(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept.

    ``n_links`` counts the other rows whose cosine is at least ``least``;
    component_id is the smallest vec_id reachable by links. Equal vectors are
    one in the tree, with their number as weight: copies are never paired.
    Vectors that are null, zero, or hold null or non-finite entries have no
    links and are their own component, as do vectors of a length of their own;
    those of different length never link. Rows of one vec_id are vectors each.
    A null vec_id takes part, but names no component unless it is alone. Only
    vec_id and the vector are read. An empty table gives an empty result.
    """
    # Single numbers are kept as such: half as much to write.
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    kept = F.col("embedding") if single else F.transform("embedding", lambda c: c.cast("double"))
    rows = vectors.select("vec_id", kept.alias("v"))
    entry = F.transform("v", lambda c: c.cast("double"))
    good = F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(entry, lambda c: c != 0)
    rows = rows.withColumn("v", F.when(F.coalesce(good, F.lit(False)), F.col("v")))
    keys = [F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(n), entry)).alias(f"k{n}") for n in (1, 2)]
    rows = rows.select("vec_id", "v", *keys)
    reps = rows.where("v IS NOT NULL").groupBy("k1", "k2")
    reps = reps.agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("w"), F.first("v").alias("v"))
    reps = written(reps.withColumn("rep", F.monotonically_increasing_id()), "vectors")
    met = written(linked_pairs(reps.select("rep", "w", "v"), least), "met")
    links = met.groupBy("rep").agg(F.sum("n_links").alias("links"))
    groups = components(met.where("rep != other").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    found = reps.drop("v").join(links, "rep", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    found = written(found.withColumn("root", F.coalesce("root", "rep")), "linked")
    named = found.groupBy(F.col("root").alias("__root")).agg(F.min("least").alias("component_id"))
    found = join_right(found, ["root"], named, ["__root"], "inner")
    found = found.select(
        F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    rows = join_right(rows.drop("v"), ["k1", "k2"], written(found, "by-vector"), ["__k1", "__k2"], "left")
    component = F.coalesce("component_id", "vec_id").cast("bigint")
    return rows.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )

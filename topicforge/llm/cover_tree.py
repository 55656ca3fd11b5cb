"""Embedding near-duplicates: exact threshold pairs by cover-tree traversal.

Cosine >= t on unit vectors is Euclidean distance <= r = sqrt(2 - 2 t).

1. Equal vectors become one class (its smallest id, and their number), so a
   vector that a third of the rows share is one point.
2. Classes are dealt to the nearest of a bounded number of pivots (a net over
   a bounded sample) and large cells are cut into blocks of about
   ``BLOCK`` points by a hash of the id.  Pairs of cells farther apart than
   their covering radii and r are dropped; the points of the other pairs of
   blocks meet in one task a pair, at most two blocks of points each.
3. Each block gets a cover tree: nested nets whose radius is halved from level
   to level, each node with its exact covering radius; it is built once and
   travels as each point's path.  The two trees of a pair of blocks are
   traversed together.  A pair of nodes is dropped if their
   centres are farther apart than both radii and r; if centres, radii and all
   lie within r, every pair below is a link and is counted without being
   listed; else the nodes are opened.  Pairs of points are decided by
   their cosine in double precision.
4. What leaves a task is one row for each linked point: its number of links
   there and the smallest member of its local component.  Sums of the numbers
   and components of these links give the result.

Vectors are scaled by a power of two first, so that neither very large nor very
small ones lose their norm; parallel vectors of that scale are one class.  Each
dimension of a table is searched by itself.

Defined results: a row that takes no part (null, zero, null or non-finite
component) has no link and is its own component; vectors of different
dimensions don't link; a null id has a null component and isn't kept; rows that
repeat an id are vectors of their own with that id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.llm.common import scratch_table
from topicforge.llm.components import connected
from topicforge.llm.vectors import dimensions, matrix, sampled, scaled, takes_part, usable

BLOCK = 4096
MOST_PIVOTS = 1024
SAMPLE = 8192
SLACK = 1e-9
#: What single precision may be off by.
ROOM = 1e-4


def net(x: np.ndarray, points: np.ndarray, radius: float) -> list[np.ndarray]:
    """Groups of ``points`` within ``radius`` of their first member; the first
    members are farther apart than that."""
    groups, limit = [], radius * radius
    while len(points):
        some = points[:256]
        near = 2 - 2 * (x[some] @ x[points].T) <= limit
        near[np.arange(len(some)), np.arange(len(some))] = True  # rounding may part a point from itself
        among = near[:, :len(some)]
        chosen = np.arange(len(some))
        if np.triu(among, 1).any():
            kept: list[int] = []
            for i in range(len(some)):
                if not among[kept, i].any():
                    kept.append(i)
            chosen = np.asarray(kept)
        near = near[chosen]
        taken = near.any(0)
        first = near[:, taken].argmax(0)
        first[np.searchsorted(np.flatnonzero(taken), chosen)] = np.arange(len(chosen))
        members = points[taken]
        order = np.lexsort((members != some[chosen][first], first))  # the centre comes first in its group
        groups += np.split(members[order], np.cumsum(np.bincount(first, minlength=len(chosen)))[:-1])
        points = points[~taken]
    return groups


def nested_nets(x: np.ndarray) -> list[list[int]]:
    """The cover tree over the rows of ``x`` as each row's path: the number
    of its child node on each level, down to a node of its own.  A node's
    centre is the row whose path goes on with zeros."""
    paths: list[list[int]] = [[] for _ in range(len(x))]
    todo = [(np.arange(len(x)), 2.0)]
    while todo:
        points, radius = todo.pop()
        if len(points) < 2:
            continue
        far = np.sqrt(max(0.0, 2 - 2 * float((x[points] @ x[points[0]]).min())))
        radius = min(radius, far)  # halved from what the node covers
        while True:
            radius /= 2
            groups = net(x, points, radius) if radius > SLACK else np.split(points, len(points))
            if len(groups) > 1:
                break
        for i, group in enumerate(groups):
            for p in group.tolist():
                paths[p].append(i)
            todo.append((group, radius))
    return paths


class Tree:
    """Nodes in arrays: covering radius, range of points, children.  The rows
    are kept in path order, so a node's centre is the first of its range."""

    def __init__(self, x: np.ndarray, weight: np.ndarray, paths: list[list[int]]):
        self.order = np.asarray(sorted(range(len(x)), key=paths.__getitem__), np.int64)
        self.x = x = x[self.order]
        self.x32 = x.astype(np.float32)
        self.weight = weight[self.order]
        self.total = np.concatenate([[0], np.cumsum(self.weight)])
        paths = [paths[i] for i in self.order]
        start, stop, radius, self.children = [], [], [], []

        def add(at: int, to: int, depth: int) -> int:
            node = len(start)
            start.append(at)
            stop.append(to)
            self.children.append([])
            radius.append(0.0 if to - at == 1 else
                          float(np.sqrt(max(0.0, 2 - 2 * float((x[at:to] @ x[at]).min())))) + SLACK)
            if to - at > 1:
                children, from_ = [], at
                for i in range(at + 1, to + 1):
                    if i == to or paths[i][depth] != paths[from_][depth]:
                        children.append(add(from_, i, depth + 1))
                        from_ = i
                self.children[node] = children
            return node

        add(0, len(x), 0)
        self.start, self.stop, self.radius = np.asarray(start), np.asarray(stop), np.asarray(radius)


class Links:
    """Numbers of links, and local components, over the points of all trees."""

    def __init__(self, n: int):
        self.step, self.own, self.parent = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64), list(range(n))

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)


def _near(a: Tree, us: np.ndarray, b: Tree, vs: np.ndarray, r: float):
    """Pairs of nodes that the covering-radius bound doesn't part: by single
    precision with some room, then in double precision with the distance of
    the centres."""
    ra, rb = a.radius[us], b.radius[vs]
    dots = a.x32[a.start[us]] @ b.x32[b.start[vs]].T
    keep = dots >= 1 - (r + SLACK) ** 2 / 2 - ROOM
    wide_a, wide_b = np.flatnonzero(ra), np.flatnonzero(rb)
    bound = lambda wide: 1 - (wide + r + SLACK) ** 2 / 2 - ROOM
    keep[wide_a] = dots[wide_a] >= bound(ra[wide_a, None] + rb[None, :])
    keep[:, wide_b] = dots[:, wide_b] >= bound(ra[:, None] + rb[None, wide_b])
    i, j = np.nonzero(keep)
    x, y = a.x[a.start[us[i]]], b.x[b.start[vs[j]]]
    apart = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", x, y), 0))
    near = apart - ra[i] - rb[j] <= r + SLACK
    return i[near], j[near], apart[near]


def traverse(a: Tree, b: Tree | None, r: float, cosine) -> tuple[np.ndarray, list[int]]:
    """Links between the points of two trees, or of one with itself: for each
    point in path order (the second tree's after the first's) the weight
    linked to it, and the first point of its local component.  ``cosine(i,
    j)`` decides pairs of points near the threshold."""
    same = b is None
    b = a if same else b
    shift = 0 if same else len(a.x)
    links = Links(shift + len(b.x))

    def all_linked(u: int, v: int) -> None:
        """Every point below u with every point below v."""
        us, ue, vs, ve = a.start[u], a.stop[u], b.start[v] + shift, b.stop[v] + shift
        above, below = a.total[ue] - a.total[us], b.total[ve - shift] - b.total[vs - shift]
        links.step[us] += below
        links.step[ue] -= below
        if same and u == v:
            links.own[us] += 1
            links.own[ue] -= 1
        else:
            links.step[vs] += above
            links.step[ve] -= above
        for i in range(us, ue):
            links.join(i, vs)
        for j in range(vs, ve):
            links.join(us, j)

    stack = [([0], [0], same)]
    while stack:
        some, others, itself = stack.pop()  # itself: one list of nodes with itself, each pair once
        others = np.asarray(others)
        for at in range(0, len(some), 1024):
            us = np.asarray(some[at:at + 1024])
            vs = others[at:] if itself else others
            for i, j, apart in zip(*_near(a, us, b, vs, r)):
                p, q = int(us[i]), int(vs[j])
                if itself and p >= q:
                    if p == q and a.children[p]:
                        if 2 * a.radius[p] <= r - SLACK:
                            all_linked(p, q)
                        else:
                            stack.append((a.children[p], a.children[p], True))
                elif apart + a.radius[p] + b.radius[q] <= r - SLACK:
                    all_linked(p, q)
                elif not a.children[p] and not b.children[q]:
                    if cosine(a.start[p], b.start[q]):
                        all_linked(p, q)
                else:
                    stack.append((a.children[p] or [p], b.children[q] or [q], False))
    weight = np.concatenate([a.weight, b.weight]) if shift else a.weight
    linked = np.cumsum(links.step)[:-1] - np.cumsum(links.own)[:-1] * weight
    return linked, [links.find(i) for i in range(len(links.parent))]


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.linalg.norm(v, axis=1)[:, None]


def _build_task(table: pa.Table) -> pa.Table:
    """Paths of a block's points."""
    table = table.sort_by("rep")
    paths = nested_nets(_unit(matrix(_column(table, "_v"))))
    return table.append_column("path", pa.array(paths, pa.list_(pa.int32())))


def _pair_task(threshold: float):
    r = float(np.sqrt(2 - 2 * threshold))

    def run(table: pa.Table) -> pa.Table:
        side = _column(table, "side").to_numpy()
        rep, n = _column(table, "rep").to_numpy(zero_copy_only=False), _column(table, "n").to_numpy()
        v, paths = matrix(_column(table, "_v")), _column(table, "path").to_pylist()
        trees, given, reps = [], [], []
        for s in np.unique(side):
            rows = np.flatnonzero(side == s)
            trees.append(Tree(_unit(v[rows]), n[rows], [paths[i] for i in rows]))
            given.append(v[rows][trees[-1].order])
            reps.append(rep[rows][trees[-1].order])
        alone = table.column("_a")[0] == table.column("_b")[0]

        def cosine(i: int, j: int) -> bool:
            x, y = given[0][i], given[-1][j]
            return x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold

        some, roots, linked = np.zeros(0, int), [], np.zeros(0, np.int64)
        if alone or len(trees) == 2:
            linked, top = traverse(trees[0], None if alone else trees[1], r, cosine)
            every = np.concatenate(reps).tolist()
            smallest: dict[int, int] = {}
            for id_, t in zip(every, top):
                smallest[t] = min(id_, smallest.get(t, id_))
            some = np.flatnonzero(linked)
            roots = [smallest[top[i]] for i in some]
        kind = table.schema.field("rep").type
        return pa.table({"rep": pa.array(np.concatenate(reps)[some], kind), "links": pa.array(linked[some], pa.int64()),
                         "root": pa.array(roots, kind)})

    return run


def _pivots(classes: DataFrame, n: int) -> np.ndarray:
    """A net of unit vectors over a bounded sample, as wide as it can be for
    the number of blocks."""
    sample = matrix(sampled(classes.select("rep", "_v"), n, SAMPLE, "pivots").orderBy("rep").select("_v")
                    .toArrow().column(0).combine_chunks())
    want = min(MOST_PIVOTS, max(1, -(-n // BLOCK)))
    if not len(sample):
        sample = matrix(classes.orderBy("rep").limit(1).select("_v").toArrow().column(0).combine_chunks())
    x = sample / np.linalg.norm(sample, axis=1)[:, None]
    radius, groups = 2.0, [np.arange(len(x))]
    while len(groups) < want and radius > 0.01:
        radius *= 0.9
        groups = net(x, np.arange(len(x)), radius)
    # the most populous ones: lonely points make poor pivots
    groups.sort(key=lambda g: (-len(g), g[0]))
    return x[[g[0] for g in groups[:want]]]


def _found(classes: DataFrame, threshold: float, kind: str) -> DataFrame:
    """``(rep, links, root)`` rows of the linked classes, all of one dimension."""
    spark, n = classes.sparkSession, classes.count()
    pivots = _pivots(classes, n)
    sent = spark.sparkContext.broadcast(pivots)  # MOST_PIVOTS vectors

    def deal(batches):
        for batch in batches:
            if batch.num_rows:
                v = matrix(batch.column(batch.schema.get_field_index("_v")))
                apart = np.sqrt(np.maximum(2 - 2 * (v / np.linalg.norm(v, axis=1)[:, None]) @ sent.value.T, 0))
                cell = apart.argmin(1)
                yield batch.append_column("cell", pa.array(cell, pa.int32())).append_column(
                    "far", pa.array(apart[np.arange(len(cell)), cell]))

    dealt = scratch_table(classes.mapInArrow(
        deal, f"_v array<double>, rep {kind}, n bigint, cell int, far double"), "dealt")
    cells = {c["cell"]: c for c in dealt.groupBy("cell").agg(F.max("far").alias("far"),
                                                             F.count("*").alias("n")).collect()}
    r = float(np.sqrt(2 - 2 * threshold))
    apart = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))
    parts = {c: -(-x["n"] // BLOCK) for c, x in cells.items()}
    sizes = spark.createDataFrame(list(parts.items()), "cell int, parts int")
    block = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int").alias("_block")
    built = scratch_table(
        dealt.join(F.broadcast(sizes), "cell").select("cell", block, "rep", "n", "_v")
        .groupBy("cell", "_block").applyInArrow(
            _build_task, f"cell int, _block int, rep {kind}, n bigint, _v array<double>, path array<int>"), "trees")
    meet = [(c, d) for c in cells for d in cells
            if c <= d and apart[c, d] <= cells[c]["far"] + cells[d]["far"] + r + SLACK]
    sides = ([(c, d, 0, c == d, parts[c], parts[d]) for c, d in meet]
             + [(d, c, 1, False, parts[d], parts[c]) for c, d in meet if c != d])
    near = spark.createDataFrame(sides, "cell int, other int, side int, itself boolean, parts int, others int")
    met = (built.join(F.broadcast(near), "cell")
           .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("others") - 1))))
    mine, theirs = F.struct("cell", F.col("_block").alias("b")), F.struct(F.col("other").alias("cell"), F.col("_o").alias("b"))
    # within a cell, the lower block is side 0; a block with itself comes once
    side = F.when(F.col("itself"), F.when(F.col("_block") <= F.col("_o"), 0).otherwise(1)).otherwise(F.col("side"))
    met = (met.withColumn("side", side)
           .withColumn("_a", F.when(F.col("side") == 0, mine).otherwise(theirs))
           .withColumn("_b", F.when(F.col("side") == 0, theirs).otherwise(mine)))
    return scratch_table(
        met.select(F.concat_ws(":", "_a.cell", "_a.b").alias("_a"), F.concat_ws(":", "_b.cell", "_b.b").alias("_b"),
                   "side", "rep", "n", "_v", "path")
        .groupBy("_a", "_b").applyInArrow(_pair_task(threshold), f"rep {kind}, links bigint, root {kind}"), "links")


def link_near(frame: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
              threshold: float = 0.95) -> DataFrame:
    """``(<id>, n_links, component_id, kept)``, one row for each row."""
    rows = usable(frame, id_col, vector_col).select("_id", scaled(F.col("_v")).alias("_v"))
    classes = scratch_table(rows.groupBy("_v").agg(F.min("_id").alias("rep"), F.count("*").alias("n")), "classes")
    kind = frame.schema[id_col].dataType.simpleString()
    found = frame.sparkSession.createDataFrame([], f"rep {kind}, links bigint, root {kind}")
    for d in dimensions(classes):
        found = found.union(_found(classes.where(F.size("_v") == d), threshold, kind))
    number = found.groupBy("rep").agg(F.sum("links").alias("links"))
    component = connected(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    by_class = (classes.join(number, "rep", "left").join(component.withColumnRenamed("node", "rep"), "rep", "left")
                .select("_v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                        F.coalesce("component", "rep").alias("component_id")))
    every = frame.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"))
    every = every.withColumn("_v", F.when(F.col("_id").isNotNull() & takes_part(F.col("_v")), scaled(F.col("_v"))))
    return every.join(by_class, "_v", "left").select(
        F.col("_id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "_id").alias("component_id"),
        F.coalesce(F.col("_id") == F.coalesce("component_id", "_id"), F.lit(False)).alias("kept"))

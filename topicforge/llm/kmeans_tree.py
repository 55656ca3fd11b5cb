"""Approximate nearest neighbours: hierarchical k-means tree, best bin first.

1. Equal vectors become one class with its ``k + 1`` smallest ids (more can't
   be among anyone's nearest), so a vector that a third of the rows share is
   one point.
2. A tree of k-means splits is fitted on a bounded sample of the classes; every
   class then descends to its leaf.  The tree has at most ``MOST_LEAVES``
   leaves and is broadcast.
3. A query walks the tree with a priority queue: the open branch whose centre
   is nearest comes next, and leaves are visited in the order they come up.
   How many leaves are visited is calibrated: ``calibrated`` queries are
   answered by brute force over all classes, and visits widen until the mean
   share of their true neighbours found reaches ``recall``.  A query goes on
   until its leaves hold ``k + 1`` classes, so none gets fewer neighbours than
   there are.
4. Leaves are cut into parts of about ``PART`` classes; a part and the queries
   that visit its leaf meet in one task, which keeps each query's ``k + 1``
   nearest there by distance in double precision.  The best over all parts
   are kept for each query.

Queries with equal vectors are answered once and share the answer.

Defined results: rows that take no part (null id or vector, zero, null or
non-finite component) neither ask nor answer; a query's candidates are the
vectors of its dimension, each dimension having its own tree; repeated rows count once; a row is never its own neighbour but equal
vectors of other ids are, at distance 0; ties go to the smaller id; with fewer
candidates than ``k`` all are returned.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicforge.llm.common import scratch_table
from topicforge.llm.vectors import dimensions, matrix, sampled, usable

BRANCHES = 16
LEAF = 256
MOST_LEAVES = 4096
SAMPLE = 32_768
PART = 4096


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances, to a rounding error."""
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * x @ y.T, 0)


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    """Centres by Lloyd's rounds from distinct random rows."""
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        to = _distances(x, centres).argmin(1)
        size = np.bincount(to, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, to, x)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres)
    return centres


class Tree:
    """Centres of each node's children; a child without children is a leaf."""

    def __init__(self, x: np.ndarray, leaves: int, seed: int = 11):
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaf: dict[int, int] = {}
        rng = np.random.default_rng(seed)
        points = max(1, len(x) // max(1, leaves))

        def grow(members: np.ndarray) -> int:
            node = len(self.children)
            self.centres.append(np.zeros((0, x.shape[1])))
            self.children.append([])
            k = min(BRANCHES, round(len(members) / points))
            if k >= 2:
                centres = kmeans(x[members], k, rng)
                to = _distances(x[members], centres).argmin(1)
                if np.bincount(to, minlength=k).max() < len(members):
                    kept = [i for i in range(k) if (to == i).any()]
                    self.centres[node] = centres[kept]
                    self.children[node] = [grow(members[to == i]) for i in kept]
            if not self.children[node]:
                self.leaf[node] = len(self.leaf)
            return node

        grow(np.arange(len(x)))

    def descend(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        out = np.zeros(len(x), np.int32)

        def go(node: int, rows: np.ndarray) -> None:
            if not len(rows):
                return
            if node in self.leaf:
                out[rows] = self.leaf[node]
                return
            to = _distances(x[rows], self.centres[node]).argmin(1)
            for i, child in enumerate(self.children[node]):
                go(child, rows[to == i])

        go(0, np.arange(len(x)))
        return out

    def best_bins(self, q: np.ndarray):
        """Leaves in the order in which a best-bin-first search visits them."""
        heap = [(0.0, 0)]
        while heap:
            _, node = heapq.heappop(heap)
            if node in self.leaf:
                yield self.leaf[node]
                continue
            apart = self.centres[node] - q
            for d, child in zip((apart * apart).sum(1).tolist(), self.children[node]):
                heapq.heappush(heap, (d, child))


def visits(tree: Tree, q: np.ndarray, held: np.ndarray, wide: int, least: int) -> list[int]:
    """The leaves that a query visits: ``wide`` of them, and more until they
    hold ``least`` classes; leaves that hold nothing aren't counted."""
    out, classes = [], 0
    for leaf in tree.best_bins(q):
        if len(out) >= wide and classes >= least:
            break
        if held[leaf]:
            out.append(leaf)
            classes += int(held[leaf])
    return out


def nearest(queries: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int):
    """For each query the rows of its ``k`` nearest (ties to smaller ids) and
    the distances."""
    for q in queries:
        apart = x - q
        d = np.sqrt((apart * apart).sum(1))
        large = np.abs(apart).max(1, initial=0)
        odd = (large > 1e150) | ((large < 1e-150) & (large > 0))  # squares overflow or vanish
        if odd.any():
            d[odd] = large[odd] * np.sqrt(((apart[odd] / large[odd, None]) ** 2).sum(1))
        some = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1]) if len(d) > k else np.arange(len(d))
        some = some[np.lexsort((ids[some], d[some]))][:k]
        yield some, d[some]


def _top(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("asks").orderBy("score", "rep")
    return found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k).drop("_n")


def _calibrate(tree: Tree, asked: DataFrame, leafed: DataFrame, held: np.ndarray, k: int, recall: float,
               calibrated: int, n: int, unit: float) -> int:
    """Leaf visits that find the wanted share of true neighbours."""
    spark, kind = asked.sparkSession, asked.schema["asks"].dataType.simpleString()
    chosen = sampled(asked, n, calibrated, "calibrate").orderBy("asks").toPandas()
    if chosen.empty:
        chosen = asked.orderBy("asks").limit(calibrated).toPandas()
    names, vectors = chosen["asks"].to_numpy(), np.stack(chosen["_v"].to_numpy())
    sent = spark.sparkContext.broadcast((names, vectors))  # about ``calibrated`` vectors

    def run(batches):
        names, vectors = sent.value
        for b in batches:
            if not b.num_rows:
                continue
            ids, leaf = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("rep", "leaf"))
            rows = [(name, i, s, lf) for name, (some, d) in
                    zip(names, nearest(vectors, ids, matrix(b.column(b.schema.get_field_index("_v"))), k + 1))
                    for i, s, lf in zip(ids[some], d, leaf[some]) if i != name]
            yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=["asks", "rep", "score", "leaf"]),
                                             preserve_index=False)

    truth = _top(leafed.mapInArrow(run, f"asks {kind}, rep {kind}, score double, leaf int"), k).toPandas()
    if truth.empty:
        return 1
    depth = []
    for name, q in zip(names, vectors):
        place = {leaf: i for i, leaf in enumerate(x for x in tree.best_bins(q * unit) if held[x])}
        depth += [place[leaf] for leaf in truth.loc[truth["asks"] == name, "leaf"]]
    return int(np.quantile(depth, recall, method="higher")) + 1


def _found(classes: DataFrame, asked: DataFrame, kind: str, k: int, recall: float, calibrated: int) -> DataFrame:
    """``(asks, rep, score)``: the nearest classes of each asked vector, all of
    one dimension."""
    spark, n, asks = classes.sparkSession, classes.count(), asked.count()
    # the tree works on values near one, however large or small the vectors are
    largest = classes.agg(F.max(F.array_max(F.transform("_v", F.abs)))).first()[0]
    unit = 2.0 ** min(1000.0, -np.floor(np.log2(largest))) if not 1e-100 < largest < 1e100 else 1.0
    sample = matrix(sampled(classes, n, SAMPLE, "tree").orderBy("rep").select("_v").toArrow().column(0).combine_chunks())
    if not len(sample):
        sample = matrix(classes.orderBy("rep").limit(1).select("_v").toArrow().column(0).combine_chunks())
    tree = Tree(sample * unit, min(MOST_LEAVES, max(1, n // LEAF)))
    sent = spark.sparkContext.broadcast(tree)  # MOST_LEAVES centres and their parents

    def descend(batches):
        for b in batches:
            if b.num_rows:
                leaf = sent.value.descend(matrix(b.column(b.schema.get_field_index("_v"))) * unit)
                yield b.append_column("leaf", pa.array(leaf, pa.int32()))

    leafed = scratch_table(classes.select("rep", "_v").mapInArrow(
        descend, f"rep {kind}, _v array<double>, leaf int"), "leaves")
    held = np.zeros(len(tree.leaf), np.int64)
    for r in leafed.groupBy("leaf").agg(F.count("*").alias("n")).collect():
        held[r["leaf"]] = r["n"]
    wide = _calibrate(tree, asked, leafed, held, k, recall, calibrated, asks, unit)
    parts = np.maximum(1, -(-held // PART))
    plan = spark.sparkContext.broadcast((tree, held, wide, parts))

    def visit(batches):
        tree, held, wide, parts = plan.value
        for b in batches:
            asks = b.column(0).to_pylist()
            for at, q in enumerate(matrix(b.column(1))):
                leaves = visits(tree, q * unit, held, wide, k + 1)
                both = [(leaf, p) for leaf in leaves for p in range(parts[leaf])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([asks[at]] * len(both), b.column(0).type), pa.array([q.tolist()] * len(both), pa.list_(pa.float64())),
                     pa.array([x for x, _ in both], pa.int32()), pa.array([x for _, x in both], pa.int32())],
                    ["asks", "q", "leaf", "part"])

    visited = asked.mapInArrow(visit, f"asks {kind}, q array<double>, leaf int, part int")
    sizes = spark.createDataFrame([(i, int(p)) for i, p in enumerate(parts)], "leaf int, _parts int")
    parted = (leafed.join(F.broadcast(sizes), "leaf")
              .select("rep", "_v", "leaf", F.pmod(F.xxhash64("rep"), F.col("_parts")).cast("int").alias("part")))

    def match(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"asks": [], "rep": [], "score": []})
        ids = left["rep"].to_numpy()
        got = [(a, i, s) for a, (some, d) in
               zip(right["asks"], nearest(np.stack(right["q"].to_numpy()), ids, np.stack(left["_v"].to_numpy()), k + 1))
               for i, s in zip(ids[some], d)]
        return pd.DataFrame(got, columns=["asks", "rep", "score"])

    return _top(parted.groupBy("leaf", "part").cogroup(visited.groupBy("leaf", "part"))
                .applyInPandas(match, f"asks {kind}, rep {kind}, score double"), k + 1)


def search(frame: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id",
           vector_col: str = "embedding", recall: float = 0.96, calibrated: int = 200) -> DataFrame:
    """``(query_id, rank, <id>, score)``: each query's ``k`` nearest other rows
    by Euclidean distance.  ``is_query`` is a condition on the id column."""
    spark = frame.sparkSession
    kind = frame.schema[id_col].dataType.simpleString()
    rows = usable(frame, id_col, vector_col)
    # no more than k + 1 ids of a vector leave a task
    smallest = rows.withColumn("_n", F.dense_rank().over(Window.partitionBy("_v").orderBy("_id"))).where(F.col("_n") <= k + 1)
    classes = scratch_table(smallest.groupBy("_v").agg(F.array_sort(F.collect_set("_id")).alias("ids"))
                            .withColumn("rep", F.element_at("ids", 1)), "classes")
    queries = scratch_table(rows.withColumnRenamed("_id", id_col).where(is_query).withColumnRenamed(id_col, "_id").distinct()
                            .join(classes.select("_v", "rep"), "_v")
                            .select(F.col("_id").alias("query_id"), F.col("rep").alias("asks"), "_v"), "queries")
    shape = f"asks {kind}, rep {kind}, score double"
    found = spark.createDataFrame([], shape)
    for d in dimensions(queries):
        of = F.size("_v") == d
        found = found.union(_found(classes.where(of), queries.where(of).select("asks", "_v").distinct(), kind, k, recall, calibrated))
    neighbours = found.join(classes.select("rep", "ids"), "rep").select("asks", "score", F.explode("ids").alias("_id"))
    order = Window.partitionBy("query_id").orderBy("score", "_id")
    return (queries.select("query_id", "asks").join(neighbours, "asks").where(F.col("query_id") != F.col("_id"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("_id").alias(id_col), "score"))

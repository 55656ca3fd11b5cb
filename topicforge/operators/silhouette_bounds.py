"""Silhouette between two proven bounds, with work linear in the points (A5).

The exact score (``silhouette.py``) needs every pair distance.  This one reads
the points twice and returns an interval that always holds the exact score.

A cluster, or a cell of it, is described by the moments of its members ``x``
about their mean ``m`` (``y = x - m``): their number, ``V = E|y|^2``,
``W = E|y|^4``, ``t = E(|y|^2 y)`` and the covariance ``C``.  For any point p
with ``u = p - m`` they give the mean squared and fourth-power distance exactly::

    E d^2 = |u|^2 + V
    E d^4 = |u|^4 + 2 |u|^2 V + W + 4 u'Cu - 4 u.t

and from these two the mean distance lies between

    max( (E d^2)^(3/2) / (E d^4)^(1/2),  |u| )   (Hoelder; convexity of the norm)
    (E d^2)^(1/2)                                (concavity of the root)

The silhouette rises with b and falls with a, so bounds of both give bounds of
each point's score, and their means bound the score.  The first bound is tight
where distances concentrate (many dimensions), both are where cells are small;
with ``cell_col`` a cluster is described by several cells, and cells of equal
points make the interval a single number (up to rounding).

Each task sends its sums once per cell (dims + 2 rows), summed by the JVM; the
driver holds cells x dims^2 numbers.  Beyond ``COVARIANCE_CELLS`` of them the
covariances are left out and ``u'Cu`` is replaced by its bound ``|u|^2 V``: a
wider interval, still one that holds the exact score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.operators import vectors as vx

#: Most numbers of covariances that are sent to the tasks (256 MB).
COVARIANCE_CELLS = 1 << 25
#: Most numbers of means; a model with more is refused.
MEAN_CELLS = 1 << 25
#: Tasks whose partial sums of a cell are added before they meet the others.
REDUCE_TASKS = 32

_BOUNDS = ("a_low", "a_high", "b_low", "b_high", "s_low", "s_high")


def _rows(column) -> np.ndarray:
    """Arrow list column -> matrix with one row per list."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1)


class _Cells:
    """The cells' clusters, sizes and moments, in the order of their numbers."""

    def __init__(self, clusters, sizes, means):
        self.clusters, self.sizes, self.means = clusters, sizes, means
        self.v = self.w = self.t = self.cov = None


def _find_cells(points: DataFrame) -> tuple[list, _Cells]:
    """One row per cell (bounded by ``MEAN_CELLS``): its key, size and mean."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    dims = points.select(F.max(F.size("vec")).alias("d")).first()["d"] or 1
    most = MEAN_CELLS // max(1, dims)
    means = (points.select("cluster", "cell", array_to_vector("vec").alias("_v")).groupBy("cluster", "cell")
             .agg(F.count(F.lit(1)).alias("n"), Summarizer.mean(F.col("_v")).alias("_m"))
             .select("cluster", "cell", "n", vector_to_array("_m").alias("m")))
    rows = means.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} cells of {dims} dimensions")
    rows.sort(key=lambda r: (r["cluster"], r["cell"]))
    cells = _Cells(np.array([r["cluster"] for r in rows], dtype=np.int64),
                   np.array([r["n"] for r in rows], dtype=np.float64),
                   np.array([r["m"] for r in rows], dtype=np.float64))
    return [(r["cluster"], r["cell"]) for r in rows], cells


def _add_moments(numbered: DataFrame, cells: _Cells, covariances: bool) -> None:
    """Second pass: moments of every cell about its mean."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    sent = numbered.sparkSession.sparkContext.broadcast(cells.means)
    n_cells, dims = cells.means.shape

    def part(batches):
        means = sent.value
        sums = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            at = batch.column(0).to_numpy(zero_copy_only=False)
            x = _rows(batch.column(1))
            for c in np.unique(at):
                y = x[at == c] - means[c]
                sq = np.einsum("ij,ij->i", y, y)
                total = sums.setdefault(c, [np.zeros(2), np.zeros(dims), np.zeros((dims, dims)) if covariances else None])
                total[0] += (sq.sum(), (sq * sq).sum())
                total[1] += sq @ y
                if covariances:
                    total[2] += y.T @ y
        for c, (scalars, third, cov) in sums.items():
            lists = [scalars.tolist(), third.tolist()] + (cov.tolist() if covariances else [])
            yield pa.RecordBatch.from_arrays(
                [pa.array([c] * len(lists), pa.int32()), pa.array(range(len(lists)), pa.int32()),
                 pa.array(lists, pa.list_(pa.float64()))], ["at", "line", "z"])

    spread = F.floor(F.spark_partition_id() / REDUCE_TASKS).alias("part")
    table = (numbered.select("at", "vec").mapInArrow(part, "at int, line int, z array<double>")
             .select("at", "line", spread, array_to_vector("z").alias("z"))
             .groupBy("at", "line", "part").agg(Summarizer.sum(F.col("z")).alias("z"))
             .groupBy("at", "line").agg(Summarizer.sum(F.col("z")).alias("z"))
             .select("at", "line", vector_to_array("z").alias("z"))).toArrow()
    sent.unpersist()
    scalars, cells.t = np.zeros((n_cells, 2)), np.zeros((n_cells, dims))
    cells.cov = np.zeros((n_cells, dims, dims)) if covariances else None
    lists = table.column("z").combine_chunks() if table.num_rows else []
    for at, line, z in zip(table.column("at").to_pylist(), table.column("line").to_pylist(), lists):
        z = z.values.to_numpy(zero_copy_only=False) / cells.sizes[at]
        if line == 0:
            scalars[at] = z
        elif line == 1:
            cells.t[at] = z
        else:
            cells.cov[at, line - 2] = z
    cells.v, cells.w = scalars[:, 0], scalars[:, 1]


def _distance_sums(x: np.ndarray, own: np.ndarray, cells: _Cells, c: int):
    """Bounds of the sum of distances from the rows of ``x`` to the members of
    cell ``c``; a row of the cell itself (``own``) is not its own partner."""
    u = x - cells.means[c]
    uu = np.einsum("ij,ij->i", u, u)
    spread = uu * cells.v[c] if cells.cov is None else np.einsum("ij,ij->i", u @ cells.cov[c], u)
    second = uu + cells.v[c]
    fourth = np.maximum(uu * uu + 2 * uu * cells.v[c] + cells.w[c] + 4 * spread - 4 * (u @ cells.t[c]), second * second)
    n = cells.sizes[c]
    others = np.where(own, n - 1, n)
    share = n / np.maximum(others, 1)      # a row's distance to itself is 0: the sums stay, their number changes
    second, fourth = second * share, fourth * share
    high = np.sqrt(second)
    low = np.divide(second * high, np.sqrt(fourth), out=np.zeros_like(high), where=fourth > 0)
    low = np.minimum(np.maximum(low, np.sqrt(uu) * share), high)
    return others * low, others * high


def _score(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    top = np.maximum(a, b)
    return np.divide(b - a, top, out=np.zeros_like(top), where=top > 0)


def _point_bounds(x: np.ndarray, at: np.ndarray, cells: _Cells) -> np.ndarray:
    """The columns ``_BOUNDS`` for rows ``x`` of the cells ``at``."""
    mine = cells.clusters[at]
    out = np.full((len(x), 6), np.nan)
    out[:, 2:4] = np.inf
    alone = np.zeros(len(x), dtype=bool)
    for cluster in np.unique(cells.clusters):
        low, high = np.zeros(len(x)), np.zeros(len(x))
        members = np.flatnonzero(cells.clusters == cluster)
        for c in members:
            part_low, part_high = _distance_sums(x, at == c, cells, c)
            low += part_low
            high += part_high
        n = cells.sizes[members].sum()
        own = mine == cluster
        out[~own, 2] = np.minimum(out[~own, 2], low[~own] / n)
        out[~own, 3] = np.minimum(out[~own, 3], high[~own] / n)
        if n > 1:
            out[own, 0], out[own, 1] = low[own] / (n - 1), high[own] / (n - 1)
        else:
            alone |= own
    out[:, 4], out[:, 5] = _score(out[:, 1], out[:, 2]), _score(out[:, 0], out[:, 3])
    out[alone, 4:] = 0.0
    return out


def silhouette_bounds(points: DataFrame, id_col: str = "vec_id", vec_col: str = "vec",
                      cluster_col: str = "cluster", cell_col: str | None = None,
                      covariance_cells: int = COVARIANCE_CELLS) -> DataFrame:
    """Bounds of every point: ``(id, cluster, a_low, a_high, b_low, b_high,
    s_low, s_high)``.  A point alone in its cluster scores 0 and has no ``a``.

    ``cell_col`` splits clusters into cells (any column; null is a cell).
    Vectors have one dimension.  Raises ``ValueError`` as the exact score does:
    fewer than 2 clusters, or as many clusters as points.
    """
    cell = F.lit("") if cell_col is None else F.coalesce(F.col(cell_col).cast("string"), F.lit(""))
    pts = points.select(F.col(id_col).alias("pid"), F.col(cluster_col).cast("int").alias("cluster"),
                        cell.alias("cell"), vx.as_double(F.col(vec_col)).alias("vec"))
    keys, cells = _find_cells(pts)
    n_points, n_clusters = int(cells.sizes.sum()), len(set(cells.clusters.tolist()))
    if not 2 <= n_clusters <= n_points - 1:
        raise ValueError(f"silhouette needs 2 <= clusters <= n-1, got {n_clusters} for {n_points}")
    n_cells, dims = cells.means.shape
    numbers = pts.sparkSession.createDataFrame([(*key, i) for i, key in enumerate(keys)],
                                               "cluster int, cell string, at int")
    numbered = pts.join(F.broadcast(numbers), ["cluster", "cell"])      # one row per cell, counted above
    _add_moments(numbered, cells, n_cells * dims * dims <= covariance_cells)
    sent = pts.sparkSession.sparkContext.broadcast(cells)

    def part(batches):
        for batch in batches:
            if batch.num_rows:
                bounds = _point_bounds(_rows(batch.column(3)), batch.column(2).to_numpy(zero_copy_only=False), sent.value)
                columns = [pa.array(bounds[:, i], mask=np.isnan(bounds[:, i])) for i in range(6)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], ["pid", "cluster", *_BOUNDS])

    kind = pts.schema["pid"].dataType.simpleString()
    shape = f"pid {kind}, cluster int, " + ", ".join(f"{c} double" for c in _BOUNDS)
    return (numbered.select("pid", "cluster", "at", "vec").mapInArrow(part, shape)
            .withColumnRenamed("pid", id_col))


def score_bounds(bounds: DataFrame, by: str | None = None) -> DataFrame:
    """Bounds of the mean silhouette ``(n_points, silhouette_low,
    silhouette_high)``, of all points or of each cluster."""
    grouped = bounds.groupBy(by) if by else bounds.groupBy()
    return grouped.agg(F.count(F.lit(1)).alias("n_points"), F.avg("s_low").alias("silhouette_low"),
                       F.avg("s_high").alias("silhouette_high"))

"""Exact silhouette with plain Euclidean distance (A5) and its sampled form
(A5s).

s(i) = (b - a) / max(a, b), where a is the mean distance from i to the other
members of its cluster and b the smallest mean distance to another cluster;
a point alone in its cluster scores 0.  Needs every pairwise distance: the
blocked layout of ``pairs.py`` emits per-(point, cluster) distance sums,
never pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.operators import pairs as pr

_SUMS_SCHEMA = "pid long, other int, dsum double"


def _cluster_sums(batches):
    """Per point of a block: the distance sums to each cluster's members among
    the others of the task."""
    now, ids, x, sums = None, None, None, {}

    def rows():
        for label, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.full(len(ids), label, dtype=np.int32)), pa.array(total)], ["pid", "other", "dsum"])

    for blk, left, right in pr.sides(batches):
        if blk != now:
            yield from rows()
            now, ids, x, sums = blk, left.field("pid"), pr.matrix(left.field("vec")), {}
        d = pr.pair_distances(x, pr.matrix(right.field("vec")))
        labs, inv = np.unique(right.field("cluster").to_numpy(zero_copy_only=False), return_inverse=True)
        onehot = np.zeros((len(inv), len(labs)))
        onehot[np.arange(len(inv)), inv] = 1.0
        for label, total in zip(labs.astype(np.int32).tolist(), (d @ onehot).T):
            sums[label] = sums[label] + total if label in sums else np.ascontiguousarray(total)
    yield from rows()


def silhouette_samples(points: DataFrame, id_col: str = "vec_id", vec_col: str = "vec",
                       cluster_col: str = "cluster",
                       block_rows: int = pr.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Per-point silhouette ``(id, cluster, a, b, s)``.

    Raises ``ValueError`` when there are fewer than 2 clusters or as many
    clusters as points (the score is undefined there).
    """
    pts = points.select(F.col(id_col).cast("long").alias("pid"),
                        F.col(vec_col).cast("array<double>").alias("vec"),
                        F.col(cluster_col).cast("int").alias("cluster"))
    sizes = pts.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_c"))
    n_points = pts.count()
    n_clusters = sizes.count()
    if not 2 <= n_clusters <= n_points - 1:
        raise ValueError(f"silhouette needs 2 <= clusters <= n-1, got {n_clusters} for {n_points}")
    nb = pr.n_blocks(n_points, block_rows)
    sums = (pr.meet(pr.blocks(pts, "pid", nb), nb, _cluster_sums, _SUMS_SCHEMA)
            .groupBy("pid", "other").agg(F.sum("dsum").alias("dsum")))
    means = (sums.join(sizes.withColumnRenamed("cluster", "other"), "other")
             .join(pts.select("pid", "cluster"), "pid"))
    per_point = means.groupBy("pid", "cluster").agg(
        F.max(F.when(F.col("other") == F.col("cluster"), F.col("n_c"))).alias("n_own"),
        F.max(F.when(F.col("other") == F.col("cluster"), F.col("dsum"))).alias("own_sum"),
        F.min(F.when(F.col("other") != F.col("cluster"),
                     F.col("dsum") / F.col("n_c"))).alias("b"))
    a = F.when(F.col("n_own") > 1, F.col("own_sum") / (F.col("n_own") - 1))
    top = F.greatest(a, F.col("b"))  # 0 where a point equals all it is compared with
    s = F.when((F.col("n_own") > 1) & (top > 0), (F.col("b") - a) / top).otherwise(F.lit(0.0))
    return per_point.select(F.col("pid").alias(id_col), "cluster",
                            a.alias("a"), "b", F.coalesce(s, F.lit(0.0)).alias("s"))


def silhouette_score(points: DataFrame, **kw) -> DataFrame:
    """A5: mean silhouette over all points, one row ``(n_points, silhouette)``."""
    ss = silhouette_samples(points, **kw)
    return ss.agg(F.count(F.lit(1)).alias("n_points"), F.avg("s").alias("silhouette"))


def sample_points(points: DataFrame, id_col: str, sample_size: int = 2000,
                  seed: int = 42) -> DataFrame:
    """A5s: a deterministic sample of ``sample_size`` points (order of a
    seeded md5 of the id).  The limit *is* the operator here: the reference
    suggests scoring a 2000-point sample when the exact score is too slow."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return points.orderBy(key, F.col(id_col)).limit(sample_size)


def per_cluster(ss: DataFrame) -> DataFrame:
    """Mean silhouette and size of each cluster."""
    return ss.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg("s").alias("silhouette"))



def silhouette_sq_euclidean(points: DataFrame, vec_col: str = "vec",
                            cluster_col: str = "cluster") -> float:
    """The scalable variant: silhouette with *squared* Euclidean distance via
    Spark ML's ``ClusteringEvaluator``, O(n * k) from per-cluster sums instead
    of all pairs.  A different number from the plain Euclidean score (A5)."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector
    data = points.select(array_to_vector(F.col(vec_col).cast("array<double>")).alias("_fv"),
                         F.col(cluster_col).cast("double").alias("_c"))
    ev = ClusteringEvaluator(featuresCol="_fv", predictionCol="_c", metricName="silhouette",
                             distanceMeasure="squaredEuclidean")
    return float(ev.evaluate(data))

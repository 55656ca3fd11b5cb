"""Dense-vector helpers: casting, norms, centroid assignment.

Vectors are ``array<double>`` columns.  Assigning points to a fixed set of
centroids keeps the centroids (k x dims, bounded by the model) as one
constant inside the expression, so assignment is a map-only projection of
(interpreted) higher-order functions: no join, no shuffle, no Python worker.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_double(c: Column) -> Column:
    """float arrays -> double arrays (distances are computed in double)."""
    return c.cast("array<double>")


def sq_dist(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two equal-length arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)),
                       F.lit(0.0), lambda acc, x: acc + x)


def centers_literal(centers) -> Column:
    """A k x dims matrix as one constant (folded by the optimiser), not k x
    dims expressions."""
    return F.from_json(F.lit(json.dumps(np.asarray(centers, dtype=np.float64).tolist())), "array<array<double>>")


def assign_nearest(df: DataFrame, vec_col: str, centers, cluster_col: str = "cluster",
                   dist_col: str | None = "dist2") -> DataFrame:
    """Nearest centroid of each row; ties go to the lowest cluster id.

    ``centers`` is a k x dims matrix held by the driver (a fitted model's
    centroids).  Output adds ``cluster`` (int) and the squared distance.
    """
    cents = centers_literal(centers)
    d = F.transform(cents, lambda c: sq_dist(F.col(vec_col), c))
    out = df.withColumn("_d", d)
    out = out.withColumn(cluster_col, (F.array_position("_d", F.array_min("_d")) - 1).cast("int"))
    if dist_col:
        out = out.withColumn(dist_col, F.array_min("_d"))
    return out.drop("_d")


def group_means(df: DataFrame, group_col: str, vec_col: str) -> DataFrame:
    """Mean vector per group ``(group, center array<double>)``.

    Uses the ML ``Summarizer`` (a JVM aggregate with map-side partial
    aggregation), so a group holding a third of the rows is still combined
    per task before the shuffle.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    return (df.select(group_col, array_to_vector(F.col(vec_col)).alias("_v"))
            .groupBy(group_col).agg(Summarizer.mean(F.col("_v")).alias("_m"))
            .select(group_col, vector_to_array("_m").alias("center")))


def collect_centers(centers_df: DataFrame, key_col: str, max_rows: int = 100_000):
    """Bring a centroid table (bounded by the model's k) to the driver as
    (keys, matrix), ordered by key.  Refuses tables above ``max_rows``."""
    rows = centers_df.orderBy(key_col).limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"centroid table has more than {max_rows} rows")
    keys = [r[key_col] for r in rows]
    mat = np.array([r["center"] for r in rows], dtype=np.float64)
    return keys, mat


def inertia(assigned: DataFrame, dist_col: str = "dist2") -> DataFrame:
    """A4 (one K): number of points and sum of squared distances to the
    assigned centroid."""
    return assigned.agg(F.count(F.lit(1)).alias("n_points"), F.sum(dist_col).alias("inertia"))

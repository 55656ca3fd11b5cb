"""K-Means fit / predict / store.

Spark ML's ``KMeans`` (k-means|| initialisation, distributed Lloyd
iterations) on a cached ``VectorUDT`` column.  Labels match the reference's
library only up to cluster permutation and local optimum (different
initialiser); the invariants kept are: every point sits at its nearest
centroid, ties go to the lowest id, inertia is the sum of squared distances.
"""

from __future__ import annotations

import os

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.sources.tables import path_exists


def as_vectors(df: DataFrame, vec_col: str = "features") -> DataFrame:
    return df.withColumn("_fv", array_to_vector(F.col(vec_col)))


def center_tolerance(data: DataFrame, features_col: str = "_fv", rel_tol: float = 1e-4) -> float:
    """The reference's K-Means tolerance is *relative*: iterations stop when
    the squared centre shift summed over centres is at most ``rel_tol`` times
    the mean per-feature (population) variance of the data.  Spark's ``tol``
    bounds each centre's shift, so we pass the square root of that amount.
    One summary pass (JVM ``Summarizer``)."""
    from pyspark.ml.stat import Summarizer
    r = data.select(Summarizer.metrics("variance", "count").summary(F.col(features_col)).alias("s")).first()
    n = r["s"]["count"]
    var = r["s"]["variance"].toArray()
    pop = float(var.mean()) * (n - 1) / n if n > 1 else 0.0
    return max(pop * rel_tol, 0.0) ** 0.5 or 1e-12


def fit_kmeans(df: DataFrame, k: int, vec_col: str = "features", seed: int = 42,
               max_iter: int = 300, rel_tol: float = 1e-4) -> KMeansModel:
    """Fit on ``vec_col`` (array<double>).  Raises for k < 1 or k > n."""
    data = as_vectors(df.select(vec_col), vec_col).select("_fv")
    if k < 1:
        raise ValueError("k must be >= 1")
    n = data.count()
    if k > n:
        raise ValueError(f"k={k} exceeds the number of points ({n})")
    km = KMeans(k=k, seed=seed, maxIter=max_iter, tol=center_tolerance(data, "_fv", rel_tol),
                featuresCol="_fv", predictionCol="_cluster")
    return km.fit(data)


def predict(model: KMeansModel, df: DataFrame, vec_col: str = "features",
            cluster_col: str = "cluster") -> DataFrame:
    """Attach the nearest-centroid label (map-only: the model's
    centroids travel with the task closure, bounded by k)."""
    out = model.transform(as_vectors(df, vec_col))
    return out.withColumn(cluster_col, F.col("_cluster").cast("int")).drop("_fv", "_cluster")


def fingerprint(df: DataFrame, id_col: str, vec_col: str) -> str:
    """Order-free content hash of a feature table (sum of row hashes)."""
    h = df.select(F.xxhash64(F.col(id_col), F.col(vec_col)).alias("h")).agg(
        F.sum(F.col("h").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")).first()
    return f"{int(h['n'])}-{int(h['s'] or 0) & 0xFFFFFFFFFFFF:x}"


def load_or_train(df: DataFrame, k: int, store_dir: str, id_col: str = "doc_id",
                  vec_col: str = "features", seed: int = 42) -> tuple[KMeansModel, bool]:
    """Reuse a stored model for the same k *and* the same features, else
    fit and store.  Returns (model, loaded?).  The reference keys by k only
    and silently reuses a stale model; we also key by a feature fingerprint."""
    fp = fingerprint(df, id_col, vec_col)
    path = os.path.join(store_dir, f"kmeans_k{k}_{fp}")
    if path_exists(df.sparkSession, path):  # an unreadable store is an error
        return KMeansModel.load(path), True
    model = fit_kmeans(df, k, vec_col, seed)
    model.save(path)
    return model, False


def cluster_sizes(labels: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """Rows per cluster."""
    return labels.groupBy(cluster_col).agg(F.count(F.lit(1)).alias("n_points"))


def model_summary(model: KMeansModel) -> dict:
    """Number of centroids and their dimension."""
    centers = model.clusterCenters()
    return {"n_centroids": len(centers), "dims": int(len(centers[0])) if centers else 0}

"""Topic interpretation.

A topic is a centroid in term space; its keywords are the terms with the
largest centroid weights.  Centroids are either means of member TF-IDF rows
(the keyword-weight form) or LSA centroids mapped back through the
components (``centroids @ components``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicforge.operators.common import bounded_broadcast


def group_centroids(weights: DataFrame, membership: DataFrame,
                    group_col: str = "cluster") -> DataFrame:
    """Mean TF-IDF row per group ``(group, idx, term, weight)``.

    ``membership`` is ``(doc_id, group)`` over *all* documents of the corpus,
    so documents without vocabulary terms count in the mean as zero rows.
    The sum is a partial (map-side) aggregate, so a group holding a third of
    the corpus still reduces to at most one row per term per map task.
    """
    sizes = membership.groupBy(group_col).agg(F.count(F.lit(1)).alias("_n"))
    sums = (weights.join(membership, "doc_id")
            .groupBy(group_col, "idx", "term").agg(F.sum("weight").alias("_s")))
    return (sums.join(sizes, group_col)
            .select(group_col, "idx", "term", (F.col("_s") / F.col("_n")).alias("weight")))


def carried_centroids(weights: DataFrame, docs: DataFrame, group_col: str) -> DataFrame:
    """The same from ``weights`` rows that carry their document's group, with
    the group of every document in ``docs``: no join on the document, one
    partial sum per group and term."""
    sizes = docs.groupBy(group_col).agg(F.count(F.lit(1)).alias("_n"))
    sums = weights.groupBy(group_col, "idx", "term").agg(F.sum("weight").alias("_s"))
    same = F.col(group_col).eqNullSafe(F.col("_g"))
    return (sums.join(sizes.withColumnRenamed(group_col, "_g"), same)
            .select(group_col, "idx", "term", (F.col("_s") / F.col("_n")).alias("weight")))


def top_terms(centroids: DataFrame, n: int = 15, group_col: str = "cluster") -> DataFrame:
    """A2/A3: the ``n`` heaviest terms per group with their rank (1-based)
    and the weight relative to the group's largest weight.

    A group whose weights are all 0 has null relative weights.  Ties are
    broken by term (the reference leaves them arbitrary).  The
    window partitions by group; a group holds at most one row per vocabulary
    term, so the per-group sort is bounded by the vocabulary size.
    """
    w = Window.partitionBy(group_col).orderBy(F.desc("weight"), F.asc("term"))
    ranked = centroids.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    top = F.max("weight").over(Window.partitionBy(group_col))
    return ranked.select(group_col, F.col("rank").cast("int").alias("rank"), "term",
                         "weight", (F.col("weight") / F.nullif(top, F.lit(0.0))).alias("rel_weight"))


def keyword_lists(top: DataFrame, group_col: str = "cluster") -> DataFrame:
    """A2 printout form: one row per group with its keywords in rank order."""
    return (top.groupBy(group_col)
            .agg(F.array_join(F.transform(
                F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda s: s["term"]),
                ", ").alias("keywords")))


def back_project(components: DataFrame, centers, vocab: DataFrame,
                 vocab_bound: int | None = 5000) -> DataFrame:
    """A1: map LSA centroids back to term space (``centroids @ components``).

    ``components`` is ``(idx, loading array<double>)``, one row per term, and
    ``centers`` the k x dims centroid matrix of a fitted model (bounded by the
    model: k rows).  Each task multiplies its term rows by the broadcast
    centroids with numpy: no shuffle, and no pair of rows is formed.
    Output ``(cluster, idx, term, weight)``.
    """
    import numpy as np
    import pandas as pd

    spark = components.sparkSession
    bc = spark.sparkContext.broadcast(np.asarray(centers, dtype=np.float64))

    def project(batches):
        c = bc.value
        k = c.shape[0]
        for pdf in batches:
            if pdf.empty:
                continue
            load = np.stack(pdf["loading"].to_numpy())          # terms x dims
            wts = load @ c.T                                     # terms x k
            yield pd.DataFrame({
                "cluster": np.tile(np.arange(k, dtype=np.int32), len(pdf)),
                "idx": np.repeat(pdf["idx"].to_numpy().astype(np.int32), k),
                "weight": wts.reshape(-1)})

    proj = components.select("idx", "loading").mapInPandas(
        project, "cluster int, idx int, weight double")
    return proj.join(bounded_broadcast(vocab.select("idx", "term"), vocab_bound), "idx")


def vocabulary_head(vocab: DataFrame, n_head: int = 50) -> DataFrame:
    """The first ``n_head`` terms in code-point order with their position
    (1-based).  A top-k (``TakeOrderedAndProject``), bounded by ``n_head``."""
    w = Window.orderBy("term")
    return (vocab.select("term").orderBy("term").limit(n_head)
            .withColumn("rank", F.row_number().over(w).cast("int")))

"""Blocked all-pairs layout for exact distance work.

Exact DBSCAN neighbourhoods and exact silhouettes need every pair distance.
We never materialise pair rows.  Points are hashed into ``B`` blocks of about
``block_rows`` points; each point is replicated to the ``B`` unordered block
pairs it belongs to, and one ``applyInPandas`` task per block pair computes
the block-by-block distance matrix with numpy and emits only *aggregates*
(per-point sums, counts, local forests).  Memory per task is bounded by
``2 * block_rows`` points whatever the data size; hashing on the point id
spreads a hot cluster evenly over the blocks (no key holds more than its
share).  Total work is the inherent n^2/2 distance evaluations.

``blocks`` and ``meet`` are the layout for sums over all other points: a block
is one written row, and each task reads one block against all blocks of a run
of ``RIGHT_BLOCKS``.  Points cross the shuffle once, when they are packed; what
a task returns is already summed over the run.  A distance is computed from
both of its ends.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.session import checkpoint_dir

DEFAULT_BLOCK_ROWS = 1024

#: Blocks that a task holds to read its own against.
RIGHT_BLOCKS = 64
#: Most partitions of packed blocks.
MOST_PARTITIONS = 4096


def n_blocks(n_points: int, block_rows: int = DEFAULT_BLOCK_ROWS) -> int:
    return max(1, math.ceil(n_points / block_rows))


def replicate(points: DataFrame, id_col: str, n_block: int) -> DataFrame:
    """Add ``blk`` (this point's block) and replicate each row to every
    unordered block pair ``(bi, bj)``, ``bi <= bj``, that contains its block."""
    blk = F.pmod(F.xxhash64(F.col(id_col)), F.lit(n_block)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(n_block - 1))).alias("_o")
    df = points.withColumn("blk", blk).select("*", other)
    return (df.withColumn("bi", F.least("blk", "_o")).withColumn("bj", F.greatest("blk", "_o"))
            .drop("_o"))


def blocks(points: DataFrame, id_col: str, n_block: int) -> DataFrame:
    """``(blk, rows)``: the points of each block as one row, written once."""
    checkpoint_dir(points.sparkSession)
    blk = F.pmod(F.xxhash64(F.col(id_col)), F.lit(n_block)).cast("int")
    return (points.select(blk.alias("blk"), F.struct(*points.columns).alias("row"))
            .repartition(min(n_block, MOST_PARTITIONS), "blk")
            .groupBy("blk").agg(F.collect_list("row").alias("rows")).checkpoint())


def meet(packed: DataFrame, n_block: int, fn, schema: str) -> DataFrame:
    """``fn`` over ``(blk, rows, others)`` of every block against every block
    (itself too), read with ``sides``.  Nothing is shuffled: each task reads
    its block and its run of others from where they were written."""
    others = packed.coalesce(-(-n_block // RIGHT_BLOCKS)).select(F.col("rows").alias("others"))
    return packed.hint("shuffle_replicate_nl").crossJoin(others).mapInArrow(fn, schema)


def sides(batches):
    """``(block, left, right)`` of each pair of blocks, as struct arrays; the
    pairs of one block follow each other."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield (batch.column(0)[i].as_py(), batch.column(1).slice(i, 1).flatten(),
                   batch.column(2).slice(i, 1).flatten())


def matrix(col) -> np.ndarray:
    """A list array of one dimension as rows of a matrix."""
    sizes = np.unique(np.asarray(col.value_lengths().fill_null(-1)))
    if len(sizes) > 1 or (sizes < 0).any():
        raise ValueError("vectors are null or of several dimensions")
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(col), -1)


def pair_distances(a: np.ndarray, b: np.ndarray, squares: np.ndarray | None = None) -> np.ndarray:
    """Euclidean distances between the rows of ``a`` and ``b``; ``squares``: the
    squared lengths of ``a`` as a column, if they are known."""
    aa = np.einsum("ij,ij->i", a, a)[:, None] if squares is None else squares
    bb = np.einsum("ij,ij->i", b, b)[None, :]
    d2 = aa + bb - 2.0 * (a @ b.T)
    np.maximum(d2, 0.0, out=d2)
    return np.sqrt(d2)


def split_sides(pdf: pd.DataFrame):
    """(left rows, right rows, same_block) of one block-pair group."""
    bi, bj = int(pdf["bi"].iloc[0]), int(pdf["bj"].iloc[0])
    if bi == bj:
        return pdf, pdf, True
    left = pdf[pdf["blk"] == bi]
    right = pdf[pdf["blk"] == bj]
    return left, right, False


def stack(col: pd.Series) -> np.ndarray:
    if len(col) == 0:
        return np.zeros((0, 0))
    return np.stack(col.to_numpy()).astype(np.float64, copy=False)

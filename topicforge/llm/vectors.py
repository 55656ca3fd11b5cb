"""What the operators on vectors share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def takes_part(vector: Column) -> Column:
    """Not null, not zero, without null or non-finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def usable(frame: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(_id, _v)``: rows that take part, whatever their dimension."""
    return frame.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_v")).where(
        F.col("_id").isNotNull() & takes_part(F.col("_v")))


def dimensions(rows: DataFrame) -> list[int]:
    """The dimensions of ``_v``, of which a table has few; vectors of different
    dimensions have nothing to do with each other."""
    return sorted(r[0] for r in rows.select(F.size("_v")).distinct().collect())


def scaled(vector: Column) -> Column:
    """The vector times the power of two that brings its largest component to
    about one: exact, and its norm neither overflows nor vanishes."""
    largest = F.array_max(F.transform(vector, F.abs))
    return F.transform(vector, lambda x: x / F.pow(F.lit(2.0), F.floor(F.log2(largest))))


def matrix(column: pa.Array) -> np.ndarray:
    """A column of lists of doubles as the rows of a matrix."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def sampled(rows: DataFrame, n: int, most: int, word: str) -> DataFrame:
    """About ``most`` of ``n`` rows, by a hash of the vector."""
    place = F.pmod(F.xxhash64("_v", F.lit(word)), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(place < most / max(n, 1))

"""Table profiling and checks.

All single-pass aggregates: one scan, conditional sums, no driver loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Number of nulls in each column, one row ``null_<col>`` + ``n_rows``."""
    cols = cols or df.columns
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.sum(F.col(c).isNull().cast("long")).alias(f"null_{c}") for c in cols])


def filter_stats(df: DataFrame, kept: Column) -> DataFrame:
    """Rows before and after a filter on ``kept``, and rows removed."""
    return df.select(F.coalesce(kept, F.lit(False)).alias("_kept")).agg(
        F.count(F.lit(1)).alias("n_before"), F.count_if("_kept").alias("n_after"),
        F.count_if(~F.col("_kept")).alias("n_removed"))


def alignment(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """P5: distinct keys present on one side only, both ways (0/0 =
    aligned), from one full outer join.  The reference only compares row
    counts; comparing keys also catches equal counts with different keys."""
    lk = left.select(key).distinct().withColumn("_l", F.lit(1))
    rk = right.select(key).distinct().withColumn("_r", F.lit(1))
    both = lk.join(rk, key, "full_outer")
    return both.agg(F.sum(F.col("_r").isNull().cast("long")).alias("left_only"),
                    F.sum(F.col("_l").isNull().cast("long")).alias("right_only"))


def preview(df: DataFrame, order_col: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``order_col`` (a top-k, bounded by n)."""
    return df.orderBy(order_col).limit(n)

"""Driver tables and generic Parquet sources/sinks.

Tables are read with ``spark.read.parquet`` only; column pruning and filter
pushdown reach the scan because every caller selects/filters declaratively.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str, spread_key: str | None = None) -> DataFrame:
    """Read one driver table ``<sf_dir>/<name>.parquet``.

    With ``spread_key`` the scan is hash-partitioned on that key when it
    yields fewer splits than the cluster has cores (a file written as one
    row group is one task).  Partitioning on the document key also satisfies
    the later per-document aggregations, so they need no shuffle of their own.
    Large inputs already have many splits and are left as they are.
    """
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    if spread_key is not None:
        df = spread(df, spread_key)
    return df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition ``df`` on ``key`` if it has fewer partitions than the
    default parallelism; otherwise return it unchanged."""
    sc = df.sparkSession.sparkContext
    want = sc.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want, key)
    return df


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, on whatever file system it names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Write a derived table.  ``partition_by`` routes rows to
    folders (S6 uses (site_key, category))."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Re-read a stored table."""
    return spark.read.format(fmt).load(path)


def read_processed(spark: SparkSession, path: str, text_col: str = "processed_content",
                   fmt: str = "parquet") -> DataFrame:
    """Re-read a stored processed table and re-apply the blank filter
    (P3), as every modelling step of the reference does on load."""
    from topicforge.functions.text import not_blank
    return read_table(spark, path, fmt).where(not_blank(F.col(text_col)))

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicforge.session import checkpoint_dir
from topicforge.sources import tables

#: Rows that a task turns into Python objects at a time.
SLICE_ROWS = 256

LETTERS = re.compile(r"[^\W\d_]+")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.table(spark, sf_dir, name)


def scratch_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new folder of the cluster's shared checkpoint folder
    and read it back: lineage is cut, and a lost executor costs nothing that
    was already written."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def named_rows(docs: DataFrame, keys: list[Column], names: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``keys`` (columns over ``docs``) are a row of
    ``names``, with all their columns, whatever these are called.  Of rows that
    share a key, one is taken, or all where ``names`` has as many."""
    at = [f"_{n}" for n in range(len(keys))]
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.struct(*[k.alias(a) for k, a in zip(keys, at)]).alias("key"))
    wanted = names.toDF(*at).groupBy(F.struct(*at).alias("name")).agg(F.count("*").alias("times"))
    there = marked.groupBy("key").agg(F.count("*").alias("found"))
    several = there.where("found > 1").join(wanted, F.col("key").eqNullSafe(F.col("name"))).where("found > times").select(
        F.col("name").alias("again"))
    plain = wanted.join(several, F.col("name").eqNullSafe(F.col("again")), "left_anti")
    once = marked.join(plain, F.col("key").eqNullSafe(F.col("name")), "left_semi").select("row.*")
    first = (marked.join(several, F.col("key").eqNullSafe(F.col("again")), "left_semi").groupBy("key")
             .agg(F.first("row").alias("row")).select("row.*"))
    return once.union(first)


def crc_mod(col: str, modulus: int) -> Column:
    """crc32 of the id's text modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(col).cast("string")) % modulus


def python_crc_mod(value, modulus: int) -> int | None:
    return None if value is None else zlib.crc32(str(value).encode()) % modulus


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to few rows, so that only those are Python objects
    at any time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


class WordCache(dict):
    """``word -> make(word)`` that is emptied when it holds ``most`` entries;
    words of more than ``longest`` characters are computed each time."""

    def __init__(self, make, most: int = 200_000, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest = make, most, longest

    def __missing__(self, word):
        value = self.make(word)
        if len(word) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[word] = value
        return value

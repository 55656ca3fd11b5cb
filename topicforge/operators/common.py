"""Small plan helpers shared by the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicforge.session import checkpoint_dir

# Largest side we broadcast on a *static* bound (rows).  Beyond it we leave
# the join to Catalyst/AQE, which broadcasts only after measuring the side.
BROADCAST_ROW_LIMIT = 200_000


#: Rows of which a task holds Python objects at a time.
SLICE_ROWS = 128


def slices(batches, rows: int = SLICE_ROWS):
    """Arrow batches cut to few rows, so that a task holds Python objects of
    only those, however long their texts are."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as compressed Parquet into the cluster's shared
    checkpoint folder, and read from there."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Broadcast ``df`` only when its row count has a proven upper bound
    (e.g. a vocabulary capped at ``max_features`` or ``k`` centroids) below
    the limit; otherwise return it unchanged for a shuffle join."""
    if max_rows is not None and max_rows <= BROADCAST_ROW_LIMIT:
        return F.broadcast(df)
    return df


def dense_index(df: DataFrame, order_cols: list, index_col: str = "idx",
                bound: int | None = None) -> DataFrame:
    """Number rows 0..n-1 in ``order_cols`` order.

    With a small proven ``bound`` a single-partition window is fine.  Without
    one, rows are range-partitioned and written out with the number of their
    range (a second evaluation could draw other range bounds); the ranges are
    counted (one row per range reaches the driver) and offset, so no task
    holds everything.
    """
    if bound is not None and bound <= BROADCAST_ROW_LIMIT:
        w = Window.orderBy(*order_cols)
        return df.withColumn(index_col, (F.row_number().over(w) - 1).cast("int"))
    checkpoint_dir(df.sparkSession)
    ranged = (df.repartitionByRange(*order_cols).withColumn("_pid", F.spark_partition_id())
              .checkpoint())
    counts = sorted((r["_pid"], r["n"]) for r in
                    ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, acc = {}, 0
    for pid, n in counts:
        offsets[pid] = acc
        acc += n
    spark = df.sparkSession
    off = spark.createDataFrame(list(offsets.items()), "_pid int, _off long")
    w = Window.partitionBy("_pid").orderBy(*order_cols)
    return (ranged.join(F.broadcast(off), "_pid")
            .withColumn(index_col, (F.col("_off") + F.row_number().over(w) - 1).cast("long"))
            .drop("_pid", "_off"))


def keep_where(df: DataFrame, cond) -> DataFrame:
    """Filter on a condition over *computed* columns, evaluated once.

    A plain ``where`` on a derived column is pushed by Catalyst below the
    projection that derives it (the expression is copied into the filter),
    and further below any repartition; for the regex cleaning chain that
    means running it twice, the first time before the data is spread.  A
    0-or-1-row generator keeps the test above the projection.
    """
    keep = F.explode(F.array_repeat(F.lit(True), F.when(cond, 1).otherwise(0)))
    return df.select("*", keep.alias("_keep")).drop("_keep")

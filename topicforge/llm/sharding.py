"""Sharding by sampled splitters (native: DataFrame functions only).

Records are put in the order of their key and cut into shards of near equal
bytes:

1. a size-weighted sample of the keys is drawn by a hash of the key (a row's
   weight is its size plus the mean size, so ranges are bounded in bytes and in
   rows; the expected sample is ``SAMPLES_PER_RANGE`` rows a range, at least
   ``sample_size``);
2. the sample's quantiles become the splitters of ``n_shards *
   ranges_per_shard`` ranges, or of one range for each ``range_rows`` rows where
   that is more, and the weight of every range is counted over all rows;
3. ranges that hold more than ``overfull`` times their share are subdivided by
   splitters drawn from each of them, all in one pass over the rows, until none
   is overfull or what is left is a single key;
4. inside each range a window sums sizes in key order.  With the ranges'
   totals that gives each record its exact place in the whole order, hence its
   shard (by the middle of its bytes) and its slot.

The result does not depend on the sample: splitters only decide how the work
is dealt out.  The last key column should be a record id, so that a group of
equal values (a third of all rows, say) is cut by id like any other run of
keys; such a group stays together as far as the byte law permits.

Defined results: an empty table gives an empty table; null key columns sort
first; a null size counts as 0; rows equal in all key columns get neighbouring
places in any order; extra columns are kept, and columns named like this
operator's results (``law shard slot grown_shard``) are replaced.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicforge.llm.common import scratch_table

LAW = "bytes"
RESULTS = ("law", "shard", "slot", "grown_shard")
#: Expected sampled keys of a range.
SAMPLES_PER_RANGE = 16
#: Subdivision rounds; each multiplies the number of ranges in an overfull one
#: by up to 64, so eight rounds tell 2**48 keys apart.
ROUNDS = 8


def _below(splitters: list, key: Column, types: list) -> Column:
    """How many of the sorted ``splitters`` are at or below ``key``, found in
    two steps of about the square root of their number."""
    if not splitters:
        return F.lit(0)
    shape = T.ArrayType(T.StructType([T.StructField(f"k{i}", t) for i, t in enumerate(types)]))

    def literal(keys: list) -> Column:  # one expression, folded to a constant by the optimiser
        return F.from_json(F.lit(json.dumps([{f"k{i}": v for i, v in enumerate(k)} for k in keys])), shape)

    step = max(1, int(len(splitters) ** 0.5))
    coarse, every = literal(splitters[::step]), literal(splitters)
    block = F.size(F.filter(coarse, lambda s: s <= key))
    inside = F.slice(every, (block - 1) * step + 1, F.lit(step))
    return F.when(block == 0, F.lit(0)).otherwise(
        (block - 1) * step + F.size(F.filter(inside, lambda s: s <= key)))


def _sample(rows: DataFrame, key: Column, rate: Column) -> DataFrame:
    """Rows drawn with probability ``size * rate``; ``weight`` is the size in
    units of the mean distance of two draws."""
    place = F.pmod(F.xxhash64(key, F.lit("splitter")), F.lit(1 << 30)) / float(1 << 30)
    share = F.col("_size") * rate
    return rows.where(place < share).withColumn("weight", F.greatest(F.lit(1.0), share))


def _quantiles(sample: DataFrame, parts: int, *by: str) -> list:
    """Keys at the ``parts``-quantiles of a bounded sample's weight, of each
    group of the sample."""
    whole = Window.partitionBy(*by)
    order = whole.orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    part = F.floor(F.sum("weight").over(order) * parts / F.sum("weight").over(whole))
    cut = (sample.select(*by, "_key", part.alias("part")).groupBy(*by, "part")
           .agg(F.min("_key").alias("_key")).where(f"part between 1 and {parts - 1}"))
    return [tuple(r["_key"]) for r in cut.collect()]


def _order(key: tuple) -> tuple:
    return tuple((v is not None, v) for v in key)


def find_splitters(rows: DataFrame, types: list, n_ranges: int, sample_size: int,
                   overfull: float) -> list:
    """Splitters for ``rows(_key, _size)``, sizes above 0."""
    total = rows.agg(F.sum("_size")).first()[0] or 0
    if not total:
        return []
    splitters = sorted(set(_quantiles(_sample(rows, F.col("_key"), F.lit(sample_size / total)), n_ranges)), key=_order)
    for _ in range(ROUNDS):
        ranged = rows.withColumn("_range", _below(splitters, F.col("_key"), types))
        full = [(r["_range"], 1024.0 / r["n"]) for r in ranged.groupBy("_range").agg(
            F.sum("_size").alias("n"), F.min("_key").alias("lo"), F.max("_key").alias("hi"),
            F.max("_size").alias("largest")).where(
            (F.col("n") > overfull * total / n_ranges) & (F.col("lo") < F.col("hi"))
            & (F.col("n") > 2 * F.col("largest"))).collect()]
        if not full:
            break
        rates = rows.sparkSession.createDataFrame(full, "_range int, rate double")   # fewer than n_ranges rows
        drawn = _sample(ranged.join(F.broadcast(rates), "_range"), F.col("_key"), F.col("rate"))
        new = set(_quantiles(drawn, 64, "_range"))
        if not new - set(splitters):
            break
        splitters = sorted({*splitters, *new}, key=_order)
    return splitters


def shard_records(records: DataFrame, key: list[str], size: str, n_shards: int = 16,
                  ranges_per_shard: int = 32, sample_size: int = 8192,
                  overfull: float = 3.0, range_rows: int = 1 << 20) -> DataFrame:
    """``records`` with ``law``, ``shard``, ``slot`` and ``grown_shard`` (null
    under this law).  ``key``: columns that order the records (numbers or
    strings), a record id last; ``size``: a column of bytes."""
    records = records.drop(*RESULTS)
    names = records.columns
    types = [records.schema[c].dataType for c in key]
    rows = scratch_table(records.select(
        F.struct(*names).alias("_record"),
        F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(key)]).alias("_key"),
        F.coalesce(F.col(size).cast("bigint"), F.lit(0)).alias("_size")), "records")
    n_rows, total = rows.agg(F.count("*"), F.coalesce(F.sum("_size"), F.lit(0))).first()
    n_ranges = max(n_shards * ranges_per_shard, -(-n_rows // range_rows))
    mean = total // max(n_rows, 1) + 1
    splitters = find_splitters(rows.select("_key", (F.col("_size") + mean).alias("_size")), types, n_ranges,
                               max(sample_size, SAMPLES_PER_RANGE * n_ranges), overfull)
    ranged = rows.withColumn("_range", _below(splitters, F.col("_key"), types))
    # a row for each range: bounded by the number of splitters
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranged.groupBy("_range").agg(F.sum("_size").alias("bytes"), F.count("*").alias("rows"))
              .select("_range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("_bytes"),
                      F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_rows")))
    inside = Window.partitionBy("_range").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("_bytes") + F.sum("_size").over(inside) - F.col("_size") / 2
    placed = scratch_table(
        ranged.join(F.broadcast(starts), "_range").select(
            "_record", (F.col("_rows") + F.count("*").over(inside) - 1).alias("_rank"),
            F.least(F.lit(n_shards - 1), F.floor(middle * n_shards / F.lit(float(max(total, 1)))).cast("int")).alias("_shard")),
        "placed")
    first = placed.groupBy("_shard").agg(F.min("_rank").alias("_first"))  # n_shards rows
    return placed.join(F.broadcast(first), "_shard").select(
        *[F.col("_record")[c].alias(c) for c in names], F.lit(LAW).alias("law"),
        F.col("_shard").alias("shard"), (F.col("_rank") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder of Parquet files a shard, in slot order."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))

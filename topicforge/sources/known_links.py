"""Links already stored, kept as a bucketed table (W6 at any store size).

``exclude_known`` over the article store shuffles the keys of every category
that is crawled.  This table holds only those keys, hashed once, when they are
written, into buckets by (site_key, category, link): a later run hashes its own
new links into the same buckets and joins bucket by bucket, so nothing of the
store is shuffled again however large it grows.  The link is part of the hash,
so a category with a third of all links fills all buckets alike.

An append writes one file a bucket; the number of buckets is fixed when the
table is made and stored beside it.  Repeated keys do no harm.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from topicforge.sources.tables import path_exists

KEYS = ("site_key", "category", "link")


class KnownLinks:
    """The table under ``path``; ``buckets`` matters only where it is new."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark = spark
        spec = f"{path}/spec"
        if not path_exists(spark, spec):
            spark.createDataFrame([(buckets,)], "buckets int").write.parquet(spec)
        self.buckets = spark.read.parquet(spec).first()["buckets"]
        self.name = "known_links_" + hashlib.md5(path.encode()).hexdigest()
        location = f"{path}/keys".replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (site_key string, category string, link string) USING parquet "
                  f"CLUSTERED BY ({', '.join(KEYS)}) INTO {self.buckets} BUCKETS LOCATION '{location}'")

    def append(self, links: DataFrame) -> None:
        """Keys of ``links`` (columns ``KEYS``) that are stored from now on;
        rows without one of them are never matched and not kept."""
        keys = links.select(*KEYS).dropna().distinct()
        keys.repartition(self.buckets, *KEYS).write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def exclude(self, links: DataFrame) -> DataFrame:
        """The rows of ``links`` whose keys aren't in the table."""
        return links.join(self.table(), list(KEYS), "left_anti").select(*links.columns)

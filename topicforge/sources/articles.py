"""Article CSV folders and the stopword source.

Raw article CSVs hold ``url,title,description,content`` with multi-line quoted
fields, doubled quotes as the escape, and a UTF-8 byte-order mark.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicforge.operators.common import bounded_broadcast, written
from topicforge.session import checkpoint_dir
from topicforge.sources.tables import path_exists

REQUIRED = ("url", "title", "content")

RAW_SCHEMA = T.StructType([
    T.StructField("url", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("content", T.StringType(), True),
])

_CSV_OPTS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"',
             "encoding": "UTF-8", "mode": "PERMISSIVE"}


def _csv_reader(spark: SparkSession):
    r = spark.read
    for k, v in _CSV_OPTS.items():
        r = r.option(k, v)
    return r


def article_headers(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, cols)`` of the ``*.csv`` files in ``folder`` whose header
    has url, title and content.

    The files are read as lines, split like any text, so neither their size
    nor the header's is bounded; of a file's first block the earliest line is
    kept, one row a file and task.  Empty files have no line and files of
    another header don't pass: both are left out, as in the reference.
    """
    lines = (spark.read.option("pathGlobFilter", "*.csv").text(folder)
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value")
             .where("at = 0").withColumn("at", F.monotonically_increasing_id()))
    first = lines.groupBy("path").agg(F.min_by("value", "at").alias("line"))

    def named(batches):
        for pdf in batches:
            pdf["cols"] = [[c.strip() for c in next(csv.reader([line.removeprefix("\ufeff")]), [])]
                           for line in pdf["line"]]
            yield pdf[["path", "cols"]]

    found = first.mapInPandas(named, "path string, cols array<string>")
    return found.where(F.size(F.array_intersect("cols", F.array(*map(F.lit, REQUIRED)))) == len(REQUIRED))


def read_articles(spark: SparkSession, folder: str, with_source: bool = True) -> DataFrame:
    """Bag union of every valid article CSV in ``folder`` as
    ``url, title, content`` (+ ``source_file``).  Fails when no file is valid.

    One read of the folder, as wide as the widest header, whatever the number
    of files and headers; each row takes its columns from the places that its
    file's header gives them.  The headers stay a table: at most
    ``BROADCAST_ROW_LIMIT`` of them are broadcast, more are joined by shuffle.
    """
    missing = FileNotFoundError(f"no readable article CSV with {REQUIRED} in {folder!r}")
    if not path_exists(spark, folder):
        raise missing
    checkpoint_dir(spark)
    headers = article_headers(spark, folder).checkpoint()
    files, width = headers.agg(F.count(F.lit(1)), F.max(F.size("cols"))).first()
    if not files:
        raise missing
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(width)])
    rows = (_csv_reader(spark).schema(schema).option("pathGlobFilter", "*.csv").csv(folder)
            .select(F.array(*[f"_c{i}" for i in range(width)]).alias("cells"),
                    F.col("_metadata.file_path").alias("path")))
    places = headers.select("path", *[F.array_position("cols", c).cast("int").alias(f"_{c}") for c in REQUIRED])
    out = rows.join(bounded_broadcast(places, files), "path").select(
        *[F.element_at("cells", F.col(f"_{c}")).alias(c) for c in REQUIRED], F.col("path").alias("source_file"))
    return out if with_source else out.drop("source_file")


def source_counts(articles: DataFrame, source_col: str = "source_file") -> DataFrame:
    """Rows per source file (the reference prints one count per file)."""
    return articles.groupBy(source_col).agg(F.count(F.lit(1)).alias("n_rows"))


def read_stopwords(spark: SparkSession, path: str | None) -> list[str]:
    """Strip each line, drop blanks, distinct.  A missing file gives an
    empty list.  Stopword lists are small dimension data (a few thousand
    words); the size is checked before the list is taken to the driver."""
    if not path or not path_exists(spark, path):
        return []
    from topicforge.functions.text import WS
    strip = F.regexp_replace(F.col("value"), f"^[{WS}]+|[{WS}]+$", "")
    words = (spark.read.text(path)
             .select(strip.alias("term"))
             .where(F.col("term") != "").distinct())
    n = words.count()
    if n > 1_000_000:
        raise ValueError(f"stopword list has {n} entries; expected a small dimension")
    return sorted(r.term for r in words.collect())


#: Folder name of the empty category, which a partition folder can't have; no
#: category holds a slash.
EMPTY_CATEGORY = "/"
#: Most (site_key, category) folders that a run writes into, and the folders of a
#: site that the categories of a run with more share.
MOST_FOLDERS, SHARED_FOLDERS = 1000, 64
STORED_SCHEMA = ("url string, title string, description string, content string, page_id long, "
                 "own_category string, site_key string, category string")


def own_folder(category):
    """The folder that a category has for itself."""
    return F.when(category == "", EMPTY_CATEGORY).otherwise(category)


def shared_folder(category):
    """The folder that a category shares with others."""
    return F.concat(F.lit("/"), F.pmod(F.xxhash64(category), F.lit(SHARED_FOLDERS)).cast("string"))


def write_articles(df: DataFrame, root: str) -> None:
    """Append-or-create sink per (site_key, category).  Appending to a
    partitioned Parquet table creates the folder on first write.  The rows of a
    folder are brought together first (a very large one is split again): else
    each task would write a file into each folder that it has a row of.

    Where a run has more than ``MOST_FOLDERS`` categories (each page can be one),
    they share folders by their hash and the rows keep their category: a folder
    and a file for a few rows each take longer than the articles."""
    df = written(df, "new-articles")
    category = F.col("category")
    if df.select("site_key", "category").distinct().limit(MOST_FOLDERS + 1).count() > MOST_FOLDERS:
        df = df.withColumn("own_category", category).withColumn("category", shared_folder(category))
    else:
        df = df.withColumn("category", own_folder(category))
    df.hint("rebalance", "site_key", "category").write.mode("append").partitionBy("site_key", "category").parquet(root)


def read_stored_articles(spark: SparkSession, root: str) -> DataFrame | None:
    """Stored article table for incremental loads, or None when absent.  The
    schema is given, so categories stay text (``007``) and a store that no
    run has added an article to is an empty table.  ``folder`` is the partition
    that a row lies in."""
    if not path_exists(spark, root):
        return None
    rows, folder = spark.read.schema(STORED_SCHEMA).parquet(root), F.col("folder")
    return (rows.withColumnRenamed("category", "folder")
            .withColumn("category", F.when(folder == EMPTY_CATEGORY, "").when(folder.startswith("/"), F.col("own_category"))
                        .otherwise(folder)).drop("own_category"))

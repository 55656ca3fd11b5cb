"""topicforge: topic discovery over article tables, as Spark DataFrame jobs.

Layout
------
sources/    scans and sinks (article CSV folders, stopwords, site dimension,
            driver tables, Parquet sinks)
functions/  column-expression builders (text cleaning, URL parts) and the
            small per-row HTML helpers used inside ``mapInPandas``
operators/  distributed operators (profiling, TF-IDF, LSA, K-Means, DBSCAN,
            blocked pairs, components, silhouette, topics, page ingest, phrases)
plans/      named queries over the driver tables and their SQL oracles
streaming/  incremental article ingest as a Structured Streaming job
"""

from topicforge.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]

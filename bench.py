"""Benchmark: run the headline queries on the driver tables and print one
JSON line ``{"metric", "value", "unit", "queries", "sf"}``.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_QUERIES`` (comma list, default the headline set).
Each query is executed in full with the ``noop`` sink (no collect to the
driver); fitted models are not shared between timed queries.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_text",        # T1-T13 over every document
    "tfidf_weights",     # F2-F7
    "topic_terms",       # A1-A3 (tf-idf centroids per source)
    "phrase_apply",      # T9a/T9b
    "lsa_vectors",       # F9/F10: randomized SVD + projection
    "kmeans_labels",     # C1-C4 (k=34 on LSA vectors)
    "topic_terms_lsa",   # A1/A2 through the LSA components
    "silhouette_exact",  # A5
    "dbscan_labels",     # C6
    "page_links",        # W1-W2
    "page_articles",     # W8-W9
    "k_sweep",           # A4-A6 (K=5..50, best of 3)
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]

    from topicforge.plans import catalog
    from topicforge.session import get_spark

    spark = get_spark(f"local[{cpus}]", max(8, cpus))
    spark.sparkContext.setLogLevel("ERROR")
    reg = catalog.registry()
    times: dict[str, float] = {}
    for name in names:
        catalog._FITTED.clear()          # each query pays for its own models
        spark.catalog.clearCache()
        t0 = time.time()
        reg[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()

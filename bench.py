"""Time the headline queries; prints one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
Every query is run in full into the no-op sink; the second of two runs counts.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from marlstone.catalog import all_queries

HEADLINE = (
    "order_basetable",
    "payment_features",
    "item_features",
    "rfm_features",
    "campaign_table",
    "lift_table",
    "segment_measures",
    "numeric_summary",
    "gift_gaps",
    "quantity_ranks",
    "lag_sequences",
    "normalized_documents",
    "climate_aspects",
    "aspect_sentiment_counts",
    "lemmatized_documents",
    "top_terms",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = all_queries()
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()

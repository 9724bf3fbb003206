"""Seconds per headline query, printed as one JSON line.

``BENCH_SF_DIR`` is the folder of parquet files, ``BENCH_CPUS`` the number of local cores. Every
query is built and run to the last row of its result; nothing is kept between queries.
"""

from __future__ import annotations

import json
import os
import time

from testbed.compare import session
from testbed.queries import QUERIES

HEADLINE = (
    "clean_transactions",
    "clean_customers",
    "star_join",
    "favorite_category",
    "customer_features",
    "item_popularity",
    "purchase_recency",
    "ranking_interactions",
    "two_tower_interactions",
    "temporal_split",
    "user_features",
    "item_features",
    "ranking_features",
    "purchase_gap_events",
    "stats_numeric",
    "stats_categorical",
    "item_index",
    "negative_samples",
    "ranking_dataset",
    "two_tower_dataset",
    "retrieval_dataset",
    "vec_topk",
    "batch_recommendations",
    "binary_metrics",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    # Start the executor threads and the code generator before the clock runs.
    QUERIES["item_popularity"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(folder)).removeprefix("sf"),
            }
        ),
        flush=True,
    )


if __name__ == "__main__":
    main()

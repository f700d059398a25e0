"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Each query runs once to warm up code and file caches, then once timed, into a sink that
evaluates every row and keeps none.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from aislewise.plans.queries import QUERIES  # noqa: E402
from aislewise.session import build_session  # noqa: E402

HEADLINE = (
    "page_view_hits", "category_page_views", "order_vs_page_views", "uid_eid_sets",
    "store_page_rank", "store_page_rank_daily", "store_page_rank_month", "api_traffic_per_minute",
    "most_view_store", "most_view_store_orders", "also_view_item", "also_view_store",
    "also_view_region", "also_view_item_orders", "also_view_store_orders", "item_similarity_orders",
    "user_item_daily", "user_vector_orders", "item_vector_merge", "user_recommend",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", master=f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

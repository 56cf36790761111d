"""Time the headline queries. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tariffloom.plans.registry import QUERIES  # noqa: E402
from tariffloom.session import build_session  # noqa: E402
from tariffloom.sources.sinks import release  # noqa: E402

HEADLINE = (
    "stay_availability", "coverage_having", "pax_classify", "board_rules", "discount_rules", "or_join", "room_types",
    "board_grouping_sets", "cache_build", "cached_search", "rule_union", "drop_incompatible", "price_fold",
    "running_price", "reconcile_prices",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        # every row and column is produced, none is brought to the driver
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    release(spark)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

"""Time the reports and the heavier operators; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.registry import all_queries
from checks.reports import REPORTS
from starmart.session import builder

# Operators timed besides the reports: the shuffle-heavy ones and the load jobs.
OPERATORS = (
    "load_dedupe", "load_surrogate_key", "load_enrich", "load_fk_redirect", "agg_median", "agg_multi_distinct",
    "agg_cube", "win_ntile", "win_dense_rank", "join_star", "join_either_role", "join_preagg_children",
    "dq_orphans", "dq_reject_classes", "dq_key_check", "job_dim_games", "job_fact_games", "job_fact_appearances",
    "job_fact_game_events", "job_fact_transfers", "job_fact_valuations", "job_all",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    keys = [k for k in REPORTS if k.startswith("q")] + list(OPERATORS)
    queries[keys[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm up the JVM
    seconds = {}
    for key in keys:
        start = time.perf_counter()
        queries[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[key] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

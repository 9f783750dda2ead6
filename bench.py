"""Times the headline queries. Prints one JSON line.

BENCH_SF_DIR: the tables (default sf0.1). BENCH_CPUS: local cores (default all). Each query runs once to
warm up, then BENCH_RUNS times (default 2); the least time counts. Results go to a sink that drops them,
so that every row and column is made.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from lamina.plans import shapes
from lamina.plans.catalogue import REGISTRY, run_users_pipeline
from lamina.schemas import CHANGE_COLUMNS
from lamina.session import local_session, work_dir
from lamina.sources.changelog import write_commit, write_commits

HEADLINE = (
    "cust_tran_profile",
    "cust_tran_profile_sql",
    "cust_tran_profile_cdc",
    "ticker_dist_geo",
    "latest_per_group",
    "scd2_history",
    "scd2_hot_keys",
    "scd2_tx",
    "cdf_diff",
    "bronze_tx",
    "append_tx",
    "expect_tx_append",
    "val_orphan_tx",
    "val_tx_count_spread",
    "synth_transactions",
)
# Streams run once, without a warm-up of their own.
STREAMS = ("stream_append_silver", "stream_scd2")


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def incremental(spark, sf_dir: str) -> dict[str, float]:
    """The whole feed into an SCD2 table in one go; then a commit that changes one user in a hundred."""
    base = work_dir(spark, "bench_incremental")
    feed = shapes.change_feed(spark, sf_dir)
    columns = feed.drop(*CHANGE_COLUMNS).schema
    write_commits(feed.withColumn("_commit_version", F.lit(0).cast("bigint")), f"{base}/log")

    def run():
        run_users_pipeline(spark, base, columns, 1000, 1000)

    whole = timed(run)
    touched = feed.where("pmod(xxhash64(user_id), 100) = 0").drop(
        "_commit_version", "_commit_timestamp"
    )
    write_commit(touched, f"{base}/log", 1, "2024-01-31 06:00:00")
    return {"scd2_stream_whole": round(whole, 3), "scd2_stream_1pct": round(timed(run), 3)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "*")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, "lamina-bench")
    spark.sparkContext.setLogLevel("ERROR")

    def execute(name: str):
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    # The first queries of a JVM pay for all others.
    for name in ("bronze_tx", "cust_tran_profile"):
        execute(name)
    seconds = {}
    for name in HEADLINE:
        execute(name)
        seconds[name] = round(min(timed(lambda: execute(name)) for _ in range(runs)), 3)
    for name in STREAMS:
        seconds[name] = round(timed(lambda: execute(name)), 3)
    seconds.update(incremental(spark, sf_dir))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

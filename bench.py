"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the input tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tierwright.plans import catalog, layers  # noqa: E402
from tierwright.session import build_session, work_path  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
WARM_DIR = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Star-table checks read the tables that fact_star's build publishes.
HEADLINE = (
    "silver_transactions dedup_first dedup_losers fact_star q1_volume q2_unlinked q3_province "
    "fk_check surrogate_key dq_report dq_apply contract_check recent_50 jsonl_bronze"
).split()


def finish(df) -> None:
    """Compute every row and column."""
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "8g",
            # throughput rather than pause times
            "spark.driver.extraJavaOptions": "-XX:+UseParallelGC",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog.pin_utc(spark)

    # one untimed pass over the smallest tables loads and compiles the code paths
    if WARM_DIR:
        layers.run_layers(
            spark,
            catalog.write_inputs(spark, WARM_DIR),
            work_path(spark, "warm"),
            catalog.RUN_DATE,
        )
        for name in HEADLINE:
            finish(catalog.QUERIES[name](spark, WARM_DIR))

    # source files and shared tables are inputs here, not part of what is timed
    inputs = catalog.write_inputs(spark, SF_DIR)
    seconds: dict[str, float] = {}
    log = None

    def end_to_end():
        nonlocal log
        log = layers.run_layers(spark, inputs, work_path(spark, "bench"), catalog.RUN_DATE)

    seconds["layers_end_to_end"] = timed(end_to_end)
    catalog.star_tables(spark, SF_DIR)
    catalog.marked_transactions(spark, SF_DIR)
    for name in HEADLINE:
        run = catalog.QUERIES[name]
        seconds[name] = timed(lambda: finish(run(spark, SF_DIR)))

    source_rows = sum(r for layer, _, r, _ in log.tables if layer == "raw")
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rsplit("sf", 1)[-1],
        "stages": log.seconds,
        "warmed_up": bool(WARM_DIR),
        "source_rows": source_rows,
        "end_to_end_rows_per_sec": round(source_rows / seconds["layers_end_to_end"]),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()

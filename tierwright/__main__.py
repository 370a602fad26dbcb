"""Run a batch from the command line; the exit code says whether it was published.

    spark-submit … -m tierwright --customers c.csv --accounts a.csv --transactions t.jsonl --root s3a://…/tables
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from tierwright.plans.layers import Inputs, run_layers
from tierwright.plans.quality_run import run_with_rules
from tierwright.plans.settings import Settings, load_settings
from tierwright.session import build_session, pin_utc

logger = logging.getLogger("tierwright")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """0: published; 1: a check, a contract or a source stopped the run; 2: arguments or settings are wrong."""
    parser = argparse.ArgumentParser(prog="tierwright")
    for name in ("customers", "accounts", "transactions", "root"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--settings", help="JSON file; defaults otherwise")
    parser.add_argument("--run-date", help="ISO date for ages; today otherwise")
    parser.add_argument("--clean", action="store_true", help="any irregular row stops the run")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s", stream=sys.stderr)
    try:
        given = parser.parse_args(argv)
    except SystemExit as stop:
        return int(stop.code or 0)
    try:
        settings = load_settings(given.settings) if given.settings else Settings()
    except (OSError, ValueError, TypeError) as error:
        logger.error("settings: %s", error)
        return 2
    session = pin_utc(spark or build_session("tierwright"))
    inputs = Inputs(given.customers, given.accounts, given.transactions)
    run = run_layers if given.clean else run_with_rules
    try:
        log = run(session, inputs, given.root, given.run_date, settings=settings)
    except Exception as error:  # noqa: BLE001 - whatever stops a run is reported by the exit code
        logger.error("run stopped: %s: %s", type(error).__name__, error)
        return 1
    logger.info("published batch %s with %d warnings", log.batch_id, len(log.warnings))
    return 0


if __name__ == "__main__":
    sys.exit(main())

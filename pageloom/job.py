"""Batch entry: ``spark-submit job.py --config c.json --table t --env prod``."""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable
from datetime import date
from typing import Any

from pyspark.sql import SparkSession

from pageloom.plans.run import Ingest


def run(
    spark: SparkSession,
    config: dict[str, Any],
    table: str,
    env: str,
    mode: str = "once",
    start: str | None = None,
    end: str | None = None,
    fetch: Callable | None = None,
) -> dict[str, Any]:
    """One run, or a backfill between two days given as ``YYYY-MM-DD``."""
    if not table or not env:
        raise ValueError("a run needs a table and an environment")
    ingest = Ingest(spark, config, fetch)
    if (mode or "once").lower() != "backfill":
        return ingest.run_once(table, env)
    if not start or not end:
        raise ValueError("a backfill needs a start and an end day")
    return ingest.run_backfill(table, env, date.fromisoformat(start), date.fromisoformat(end))


def main(argv: list[str] | None = None) -> None:
    options = argparse.ArgumentParser(description=__doc__)
    options.add_argument("--config", required=True, help="JSON file with envs and apis")
    options.add_argument("--table", required=True)
    options.add_argument("--env", required=True)
    options.add_argument("--mode", default="once", choices=["once", "backfill"])
    options.add_argument("--start")
    options.add_argument("--end")
    given = options.parse_args(argv)
    spark = SparkSession.builder.appName(f"pageloom-{given.table}").getOrCreate()
    # Read through Spark, so the file may lie on any storage the cluster can reach.
    text = spark.read.text(given.config, wholetext=True).first()[0]
    told = run(
        spark, json.loads(text), given.table, given.env, given.mode, given.start, given.end
    )
    print(json.dumps(told, default=str))


if __name__ == "__main__":
    main()

"""What the jobs share: their command line, their configuration, their log."""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Callable

from pyspark.sql import SparkSession


def settings(given: dict | None, defaults: dict) -> dict:
    """The defaults with what a configuration gives; a name that the job doesn't know is an error."""
    unknown = set(given or {}) - set(defaults)
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}; known are {', '.join(sorted(defaults))}")
    return defaults | (given or {})


def main(run: Callable[..., dict], about: str, paths: dict[str, str], config: str, argv: list[str] | None = None) -> int:
    """Runs a job from the command line: it alone creates the session and stops it. paths: an argument each, with its help."""
    parser = argparse.ArgumentParser(description=about)
    for name, text in paths.items():
        parser.add_argument(f"--{name}", required=True, help=text)
    parser.add_argument("--config", default=config, help="a JSON file of settings (default: %(default)s)")
    given = parser.parse_args(argv)
    logging.basicConfig(stream=sys.stderr, level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    with open(given.config, encoding="utf-8") as file:
        chosen = json.load(file)
    spark = SparkSession.builder.appName(about.split(":")[0]).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        run(spark, *[getattr(given, name) for name in paths], chosen)
    finally:
        spark.stop()
    return 0

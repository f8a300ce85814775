"""Run the batch job: spark-submit or python -m salesloom RAW_FOLDER OUT_FOLDER [etl|warehouse] [--setting value ...]

Every field of `Settings` is an option: --calendar-start 2022-01-01, --yoy-years 2022,2023,2024, --as-of 2024-12-31,
--single-line orders,order_items.
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import fields
from datetime import date

from pyspark.sql import SparkSession

from salesloom.config import Settings
from salesloom.plans.pipeline import PHASES, run_pipeline
from salesloom.session import SPARK_CONF


def _numbers(text: str) -> tuple[int, ...]:
    return tuple(int(x) for x in text.split(","))


def _reader(annotation: str):
    if "date" in annotation:
        return date.fromisoformat
    if "tuple[str" in annotation:
        return lambda text: tuple(filter(None, text.split(",")))
    return _numbers if "tuple" in annotation else {"float": float, "str": str}[annotation]


def parse(arguments: list[str]) -> tuple[argparse.Namespace, Settings]:
    parser = argparse.ArgumentParser(prog="salesloom", description=__doc__)
    parser.add_argument("raw"), parser.add_argument("out"), parser.add_argument("phase", nargs="?", choices=PHASES)
    for f in fields(Settings):
        parser.add_argument(f"--{f.name.replace('_', '-')}", type=_reader(f.type), default=f.default)
    given = parser.parse_args(arguments)
    return given, Settings(**{f.name: getattr(given, f.name) for f in fields(Settings)})


def main(arguments: list[str]) -> None:
    given, settings = parse(arguments)
    builder = SparkSession.builder.appName("salesloom")
    for key, value in SPARK_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        run = run_pipeline(spark, given.raw, given.out, settings, given.phase)
        for name, report in run.reports.items():
            print(name)
            report.show(truncate=False)
        print(f"complete in {run.seconds:.1f} s")
    finally:
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])

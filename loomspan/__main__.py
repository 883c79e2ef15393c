"""python -m loomspan mapping.ttl: run a mapping with the settings of the environment."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import SparkSession

from .config import Config
from .run import update


def main() -> None:
    parser = argparse.ArgumentParser(prog="loomspan")
    parser.add_argument("mapping")
    given = parser.parse_args()
    spark = SparkSession.builder.appName("loomspan").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    outcome = update(spark, Path(given.mapping).read_text(encoding="utf-8"), Config.from_env())
    for name, df in vars(outcome.store).items():
        print(f"{name}: {df.count()} rows")


if __name__ == "__main__":
    main()

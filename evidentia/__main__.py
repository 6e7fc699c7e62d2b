"""Command line: build a case from a folder of tool output, or show the timeline of a built one."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from evidentia.plans import build
from evidentia.sources import discover


def main() -> int:
    parser = argparse.ArgumentParser(prog="evidentia")
    verbs = parser.add_subparsers(dest="verb", required=True)
    one = verbs.add_parser("build", help="folder/<source>/.../<file> to tables of events and edges")
    one.add_argument("folder")
    one.add_argument("out")
    two = verbs.add_parser("timeline", help="ordered entries of a built case, as JSON lines")
    two.add_argument("out")
    two.add_argument("to")
    for option in ("--host", "--after", "--before"):
        two.add_argument(option)
    given = parser.parse_args()
    spark = SparkSession.builder.appName("evidentia").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if given.verb == "build":
        build.build(spark, discover.files(spark, given.folder), given.out)
    else:
        events, edges = spark.read.parquet(f"{given.out}/events"), spark.read.parquet(f"{given.out}/edges")
        build.timeline(events, edges, given.host, given.after, given.before).write.mode("overwrite").json(given.to)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

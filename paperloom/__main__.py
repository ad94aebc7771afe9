"""python -m paperloom run|report|eval|export"""

import argparse
import json
import sys

from pyspark.sql import SparkSession

from paperloom import config
from paperloom.operators import records
from paperloom.sources import models, sqlite


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="paperloom")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="process a folder or zip")
    run.add_argument("--input", required=True)
    run.add_argument("--workers", type=int, default=1)
    run.add_argument("--limit", type=int)
    run.add_argument("--budget", type=int)
    run.add_argument("--config")
    shown = commands.add_parser("report", help="print the report")
    shown.add_argument("--json", action="store_true")
    against = commands.add_parser("eval", help="compare with expected records")
    against.add_argument("--expected", required=True)
    export = commands.add_parser("export", help="write the tables to a SQLite file")
    export.add_argument("--sqlite", required=True)
    for command in (run, shown, against, export):
        command.add_argument("--db", required=True, help="folder of the tables")
    said = parser.parse_args(args)
    if said.command == "run" and said.workers < 1:
        print("error: --workers must be >= 1", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("paperloom").getOrCreate()
    if said.command == "run":
        try:
            reason = records.run(spark, said.input, said.db, config.load(said.config), said.workers, said.limit, said.budget)
        except (models.ModelError, ValueError) as e:
            print(f"error: {e}", file=sys.stderr)
            return 3
        print(f"stopped: {reason}", file=sys.stderr)
        return 0
    tables = records.Records(spark, said.db)
    if said.command == "export":
        sqlite.export(tables.as_tables(), said.sqlite)
        return 0
    if said.command == "eval":
        print(json.dumps(records.evaluate(tables, said.expected), ensure_ascii=False))
        return 0
    found = tables.report().first().asDict()
    print(json.dumps(found, ensure_ascii=False) if said.json else "\n".join(f"{k}: {v}" for k, v in found.items()))
    return 0


if __name__ == "__main__":
    sys.exit(main())

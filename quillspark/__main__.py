"""python -m quillspark drug-export | indication-export | metrics | clean-firms"""

from __future__ import annotations

import argparse
import json

from quillspark.plans import export, layouts
from quillspark.session import session
from quillspark.sources.cleaning import clean_csv
from quillspark.sources.sinks import write_csv
from quillspark.sources.tables import field, read_csv


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="quillspark")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("drug-export", "indication-export"):
        one = commands.add_parser(name)
        one.add_argument("--input", required=True)
        one.add_argument("--data_dir", required=True)
    commands.add_parser("metrics").add_argument("--data_dir", required=True)
    commands.add_parser("clean-firms").add_argument("--input", required=True)
    for one in commands.choices.values():
        one.add_argument("--output", required=True)
        one.add_argument("--limit", type=int, default=0)
    args = parser.parse_args(argv)
    spark = session("quillspark")
    if args.command == "clean-firms":
        print(json.dumps(clean_csv(spark, args.input, args.output, limit=args.limit)))
        return
    if args.command == "metrics":
        rows = export.metrics_export(*layouts.status_tables(spark, args.data_dir)).orderBy("abstract_id")
    else:
        rows = read_csv(spark, args.input)
        rows = rows.limit(args.limit) if args.limit else rows
        rows = rows.withColumn("abstract_id", field(rows.columns, "abstract_id"))
        if args.command == "drug-export":
            rows = export.drug_export(rows, layouts.workflow_documents(spark, args.data_dir))
        else:
            rows = export.indication_export(rows.where("abstract_id <> ''"), *layouts.indication_documents(spark, args.data_dir))
    if args.command == "metrics" and args.limit:
        rows = rows.limit(args.limit)
    write_csv(rows, args.output)


if __name__ == "__main__":
    main()

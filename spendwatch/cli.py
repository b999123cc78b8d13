"""Command line: load the four CSV tables, run the reports and evaluations.

    python -m spendwatch.cli load      --input DIR --warehouse DIR
    python -m spendwatch.cli reports   --warehouse DIR --output DIR [--format csv]
    python -m spendwatch.cli evaluate  --warehouse DIR --output DIR [--format csv]

The session comes from ``spark-submit``/the platform; run locally it uses
``local[*]``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from spendwatch.sources import sinks, tables


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="spendwatch")
    ap.add_argument("command", choices=["load", "reports", "evaluate"])
    ap.add_argument("--input", help="directory with companies/employees/merchants/transactions .csv")
    ap.add_argument("--warehouse", required=True, help="Parquet tables directory")
    ap.add_argument("--output", help="report output directory")
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("spendwatch").getOrCreate()
    if args.command == "load":
        loaded = tables.load_tables(spark, args.input, "csv")
        tables.save_tables(loaded, args.warehouse)
        tables.table_row_counts(tables.load_tables(spark, args.warehouse, "parquet")).show()
        return
    t = tables.load_tables(spark, args.warehouse, "parquet")
    if args.command == "reports":
        written = sinks.run_reports(t, args.output, args.format)
    else:
        written = sinks.run_evaluations(spark, t, args.output, args.format)
    for name, path in written.items():
        print(f"{name} -> {path}")


if __name__ == "__main__":
    main()

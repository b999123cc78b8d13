"""Loading the four input tables (P12) with explicit schemas."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendwatch.schemas import TABLES

#: Zone-less timestamps in CSV: up to six fraction digits read, as many as there are written.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
TABLE_NAMES = ("companies", "employees", "merchants", "transactions")


def load_table(spark: SparkSession, directory: str, name: str, fmt: str = "csv") -> DataFrame:
    """One table by name; CSV with a header (the reference's format) or Parquet.

    The schema is declared, never inferred: inference costs a pass over the
    data and can change with the data.
    """
    schema = TABLES[name]
    path = os.path.join(directory, f"{name}.{fmt}")
    if fmt == "csv":
        return (
            spark.read.schema(schema)
            .option("header", True)
            .option("mode", "FAILFAST")
            .option("timestampNTZFormat", TIMESTAMP_FORMAT)
            .csv(path)
        )
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    raise ValueError(f"unsupported format: {fmt}")


def load_tables(spark: SparkSession, directory: str, fmt: str = "csv",
                names: tuple[str, ...] = TABLE_NAMES) -> dict[str, DataFrame]:
    """All four tables, lazily: nothing is read until an action runs."""
    return {name: load_table(spark, directory, name, fmt) for name in names}


def register_views(tables: dict[str, DataFrame]) -> None:
    """Replace-register each table as a temp view under its name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def save_tables(tables: dict[str, DataFrame], directory: str) -> None:
    """Drop-and-create by name: overwrite each table as Parquet under ``directory``."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(os.path.join(directory, f"{name}.parquet"))


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for each table.

    Each count is its own aggregate (Parquet answers it from footers); the
    one-row results are unioned.
    """
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

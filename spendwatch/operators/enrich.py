"""Denormalisation of raw card transactions (P15) and label helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendwatch.functions.exprs import is_declined
from spendwatch.params import HOME_COUNTRY

TRANSACTION_COLUMNS = [
    "transaction_id",
    "company_id",
    "employee_id",
    "merchant_id",
    "transaction_timestamp",
    "amount",
    "transaction_status",
    "decline_reason",
    "is_international",
    "merchant_country",
    "is_fraud",
    "fraud_type",
]


def enrich_transactions(
    raw: DataFrame,
    employees: DataFrame,
    merchants: DataFrame,
    home_country: str = HOME_COUNTRY,
    international: Column | None = None,
) -> DataFrame:
    """The transactions fact table from raw card events.

    ``raw`` carries transaction_id, employee_id, merchant_id,
    transaction_timestamp, amount, transaction_status, decline_reason (a
    candidate, kept only on declined rows), is_fraud, fraud_type.  The company
    comes from the employee, the country from the merchant, and
    ``is_international`` is ``country <> home_country`` unless another
    expression over the merchant columns is given.

    Both joins are plain equi-joins: the optimizer broadcasts a dimension only
    when its measured size is under the broadcast threshold and otherwise
    shuffles both sides on the key.
    """
    intl = international if international is not None else (F.col("country") != F.lit(home_country))
    emp = employees.select("employee_id", "company_id")
    mer = merchants.select("merchant_id", F.col("country").alias("merchant_country"),
                           intl.alias("is_international"))
    out = raw.join(emp, "employee_id").join(mer, "merchant_id")
    out = out.withColumn(
        "decline_reason", F.when(is_declined(), F.col("decline_reason"))
    )
    return out.select(*TRANSACTION_COLUMNS)


def fraud_label_distribution(txn: DataFrame) -> DataFrame:
    """Rows and labeled rows per ``fraud_type``, largest first."""
    return (
        txn.groupBy("fraud_type")
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            F.sum("is_fraud").alias("labeled_transactions"),
        )
        .orderBy(F.desc("transaction_count"), F.asc_nulls_last("fraud_type"))
    )


def eligible_employees(txn: DataFrame, min_rows: int = 4) -> DataFrame:
    """Employees with at least ``min_rows`` unlabeled transactions."""
    return (
        txn.where(F.col("is_fraud") == 0)
        .groupBy("employee_id")
        .agg(F.count(F.lit(1)).alias("unlabeled_transactions"))
        .where(F.col("unlabeled_transactions") >= min_rows)
    )

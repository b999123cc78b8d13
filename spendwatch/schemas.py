"""Explicit schemas of the four input tables (no inference at load)."""

from __future__ import annotations

from pyspark.sql import types as T

COMPANIES = T.StructType(
    [
        T.StructField("company_id", T.LongType()),
        T.StructField("company_name", T.StringType()),
        T.StructField("industry", T.StringType()),
        T.StructField("created_at", T.DateType()),
    ]
)

EMPLOYEES = T.StructType(
    [
        T.StructField("employee_id", T.LongType()),
        T.StructField("company_id", T.LongType()),
        T.StructField("employee_name", T.StringType()),
        T.StructField("department", T.StringType()),
        T.StructField("monthly_budget", T.LongType()),
    ]
)

MERCHANTS = T.StructType(
    [
        T.StructField("merchant_id", T.LongType()),
        T.StructField("merchant_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)

TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("company_id", T.LongType()),
        T.StructField("employee_id", T.LongType()),
        T.StructField("merchant_id", T.LongType()),
        T.StructField("transaction_timestamp", T.TimestampNTZType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("transaction_status", T.StringType()),
        T.StructField("decline_reason", T.StringType()),
        T.StructField("is_international", T.BooleanType()),
        T.StructField("merchant_country", T.StringType()),
        T.StructField("is_fraud", T.LongType()),
        T.StructField("fraud_type", T.StringType()),
    ]
)

TABLES = {
    "companies": COMPANIES,
    "employees": EMPLOYEES,
    "merchants": MERCHANTS,
    "transactions": TRANSACTIONS,
}

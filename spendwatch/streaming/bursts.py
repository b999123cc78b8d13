"""The burst velocity rule (T2-T5, P9) over a stream of transactions.

A burst is a session of one employee's approved transactions in which no gap
exceeds ``burst_gap_minutes``: exactly Spark's ``session_window`` with that
gap (a gap of exactly the limit keeps the session open, one microsecond more
closes it, as in the batch rule).  State is one open session per employee;
the watermark bounds how long a session waits for late rows, and a session
is emitted once the watermark passes its end.

Differences from the batch operator, by construction of a stream: a row
arriving later than the watermark is dropped by Spark, and rows sharing a
timestamp are peers of one session (no transaction-id order is needed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.functions.exprs import epoch_micros, is_approved, minutes_to_micros, money_sum
from spendwatch.params import DEFAULT_RULES, RuleParams

BURST_COLUMNS = [
    "employee_id",
    "burst_start",
    "burst_end",
    "transactions_in_burst",
    "burst_amount",
    "predicted_velocity_fraud",
]


def burst_sessions(txn: DataFrame, rules: RuleParams = DEFAULT_RULES,
                   watermark: str | None = "1 hour") -> DataFrame:
    """One row per burst: first and last transaction time, size, amount and
    the velocity prediction (size >= ``burst_min_transactions``).

    Works on a streaming or a static DataFrame; ``watermark=None`` skips the
    watermark (static input).
    """
    gap = f"{minutes_to_micros(rules.burst_gap_minutes)} microseconds"
    # Watermarks need a zoned timestamp: read the zone-less wall clock as UTC
    # (independent of the session zone); outputs stay zone-less.
    approved = txn.where(is_approved()).select(
        "employee_id",
        "transaction_timestamp",
        "amount",
        F.timestamp_micros(epoch_micros("transaction_timestamp")).alias("_event_time"),
    )
    if watermark is not None:
        approved = approved.withWatermark("_event_time", watermark)
    sessions = approved.groupBy("employee_id", F.session_window("_event_time", gap)).agg(
        F.min("transaction_timestamp").alias("burst_start"),
        F.max("transaction_timestamp").alias("burst_end"),
        F.count(F.lit(1)).alias("transactions_in_burst"),
        money_sum("amount").alias("burst_amount"),
    )
    return sessions.select(
        "employee_id",
        "burst_start",
        "burst_end",
        "transactions_in_burst",
        "burst_amount",
        F.when(F.col("transactions_in_burst") >= rules.burst_min_transactions, 1)
        .otherwise(0)
        .alias("predicted_velocity_fraud"),
    )


def velocity_alert_stream(txn_stream: DataFrame, rules: RuleParams = DEFAULT_RULES,
                          watermark: str = "1 hour") -> DataFrame:
    """Bursts that meet the velocity rule, as they close."""
    return burst_sessions(txn_stream, rules, watermark).where(F.col("predicted_velocity_fraud") == 1)


def start_alerts(txn_stream: DataFrame, sink_path: str, checkpoint: str,
                 rules: RuleParams = DEFAULT_RULES, watermark: str = "1 hour",
                 trigger: dict | None = None):
    """Append closed velocity bursts to Parquet at ``sink_path``.

    ``checkpoint`` must be on storage every executor and the driver share;
    with it, a restarted query resumes from its offsets and state.
    """
    writer = (
        velocity_alert_stream(txn_stream, rules, watermark)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()

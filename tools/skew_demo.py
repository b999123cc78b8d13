"""Skew demonstration: one employee holds a third of all transactions.

Builds a synthetic transactions table (Spark-generated, written as Parquet to
a scratch folder), then runs fraud scoring (P5) twice: with hot-key splitting
and with splitting disabled.  Reads Spark's event log to report, for the
stage that runs the per-employee windows, the largest number of shuffle
records a single task read, and checks that both runs give identical rows.

Usage: python tools/skew_demo.py SCRATCH_DIR [ROWS]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from spendwatch.operators import rules  # noqa: E402
from spendwatch.params import SkewParams  # noqa: E402
from spendwatch.schemas import TRANSACTIONS  # noqa: E402
from spendwatch.session import local_session  # noqa: E402


def build(spark, path: str, n: int) -> None:
    ids = spark.range(n)
    hot = (F.col("id") % 3) == 0
    emp = F.when(hot, F.lit(1)).otherwise(F.col("id") % 50_000 + 2).cast("long")
    # 30 days; the hot employee's rows are dense, the others sparse.
    secs = (F.rand(7) * 30 * 86400).cast("decimal(18,6)")
    df = ids.select(
        F.col("id").alias("transaction_id"),
        (emp % 100).alias("company_id"),
        emp.alias("employee_id"),
        (F.col("id") % 300).alias("merchant_id"),
        (F.lit("2025-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=secs))
        .alias("transaction_timestamp"),
        F.round(F.exp(F.randn(11) + 4.2), 2).alias("amount"),
        F.when(F.rand(13) < 0.92, "approved").otherwise("declined").alias("transaction_status"),
        F.lit(None).cast("string").alias("decline_reason"),
        (F.rand(17) < 0.25).alias("is_international"),
        F.lit("US").alias("merchant_country"),
        F.lit(0).alias("is_fraud"),
        F.lit("none").alias("fraud_type"),
    )
    df.select(*[F.col(f.name).cast(f.dataType) for f in TRANSACTIONS.fields]).write.mode("overwrite").parquet(path)


def window_stage_max_records(log_dir: str, since_ms: float) -> tuple[int, int, float]:
    """(max shuffle records read by one task, tasks, stage seconds) of the
    slowest shuffle-reading stage after ``since_ms``."""
    files = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]
    per_stage: dict[tuple[int, int], list[int]] = {}
    times: dict[tuple[int, int], float] = {}
    for f in files:
        for line in open(f):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerTaskEnd" and e["Task Info"]["Launch Time"] >= since_ms:
                m = e.get("Task Metrics") or {}
                rec = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                key = (e["Stage ID"], e["Stage Attempt ID"])
                per_stage.setdefault(key, []).append(rec)
            if e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                if si.get("Submission Time", 0) >= since_ms:
                    times[(si["Stage ID"], si["Stage Attempt ID"])] = (
                        si["Completion Time"] - si["Submission Time"]) / 1000
    best = max(per_stage.items(), key=lambda kv: max(kv[1]))
    return max(best[1]), len(best[1]), times.get(best[0], float("nan"))


def main() -> None:
    scratch = sys.argv[1]
    n = int(sys.argv[2]) if len(sys.argv) > 2 else 9_000_000
    logs = os.path.join(scratch, "eventlog")
    os.makedirs(logs, exist_ok=True)
    spark = local_session(cores=8, shuffle_partitions=32, driver_memory="12g", extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.compress": "false", "spark.eventLog.dir": logs,
    })
    data = os.path.join(scratch, "transactions")
    if not os.path.exists(os.path.join(data, "_SUCCESS")):
        build(spark, data, n)
    txn = spark.read.parquet(data)
    results = {}
    outputs = {}
    # warm-up (JIT, file listing) so the two timed runs compare fairly
    rules.fraud_scored_transactions(txn).write.format("noop").mode("overwrite").save()
    for label, skew in (
        ("unsplit", SkewParams(sample_fraction=0.01, rows_per_bucket=10**12)),
        ("split", SkewParams(sample_fraction=0.01, rows_per_bucket=200_000)),
    ):
        t0 = time.time()
        scored = rules.fraud_scored_transactions(txn, skew=skew)
        out = os.path.join(scratch, f"scored_{label}")
        scored.write.mode("overwrite").parquet(out)
        secs = time.time() - t0
        time.sleep(2)  # let the event log flush
        max_rec, tasks, stage_s = window_stage_max_records(logs, t0 * 1000)
        results[label] = {"seconds": round(secs, 2), "max_records_one_task": max_rec, "tasks": tasks,
                          "stage_seconds": round(stage_s, 2)}
        outputs[label] = spark.read.parquet(out)
    a, b = outputs["split"], outputs["unsplit"]
    diff = a.exceptAll(b).count() + b.exceptAll(a).count()  # every column, unrounded
    print(json.dumps({"rows": n, "hot_employee_rows": n // 3 + (1 if n % 3 else 0), "runs": results, "rows_differing": diff}))
    spark.stop()


if __name__ == "__main__":
    main()

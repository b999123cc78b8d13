"""Evaluation tables."""

import pytest

from spendwatch.operators import evaluation as E
from spendwatch.operators import rules as R
from spendwatch.operators import velocity as V
from spendwatch.params import RuleParams, SweepParams

from .helpers import at, txn_df

P = RuleParams()


def test_empty_input_gives_zero_counts_and_rates(spark):
    empty = txn_df(spark, [{"transaction_status": "declined"}])  # nothing approved
    s = E.fraud_evaluation_summary(R.fraud_scored_transactions(empty, P)).collect()[0]
    assert s["approved_transactions_scored"] == 0 and s["true_positive"] == 0
    assert (s["precision"], s["recall"], s["false_positive_rate"]) == (0.0, 0.0, 0.0)
    assert s["fraud_dollars"] == 0.0 and s["fraud_dollar_capture_rate"] == 0.0
    sweep = E.velocity_threshold_experiment(empty, SweepParams()).collect()
    assert len(sweep) == 6 and all(r["total_alerts"] == 0 and r["recall"] == 0.0 for r in sweep)


def _labeled(spark):
    attack = [{"employee_id": 1, "transaction_timestamp": at(m), "amount": 1500.0, "is_fraud": 1,
               "fraud_type": "velocity_attack"} for m in (0, 2, 4, 7)]
    big = [{"employee_id": 2, "transaction_timestamp": at(1000), "amount": 7000.0, "is_fraud": 1,
            "fraud_type": "large_amount"}]
    normal = [{"employee_id": 3, "transaction_timestamp": at(100 * i), "amount": 20.0} for i in range(6)]
    fp = [{"employee_id": 4, "transaction_timestamp": at(5000), "amount": 6000.0}]
    return txn_df(spark, attack + big + normal + fp)


def test_summary_confusion_and_dollars(spark):
    scored = R.fraud_scored_transactions(_labeled(spark), P)
    s = E.fraud_evaluation_summary(scored).collect()[0]
    assert (s["true_positive"], s["false_positive"], s["true_negative"], s["false_negative"]) == (5, 1, 6, 0)
    assert s["precision"] == 0.8333 and s["recall"] == 1.0 and s["false_positive_rate"] == 0.1429
    assert s["alert_rate"] == 0.5 and s["fraud_dollars"] == 13000.0 and s["fraud_dollar_capture_rate"] == 1.0
    cm = E.fraud_confusion_matrix(scored).collect()[0]
    assert (cm["true_positive"], cm["false_negative"]) == (5, 0)
    by_type = {r["fraud_type"]: r for r in E.fraud_evaluation_by_type(scored).collect()}
    assert set(by_type) == {"large_amount", "velocity_attack"}
    assert by_type["velocity_attack"]["fraud_transactions"] == 4 and by_type["velocity_attack"]["recall"] == 1.0
    assert by_type["large_amount"]["average_amount"] == 7000.0


def test_burst_evaluation_and_sweep(spark):
    txn = _labeled(spark)
    ev = E.velocity_burst_evaluation(V.velocity_burst_scored(txn, P), P).collect()[0]
    assert ev["method"] == "burst_level_3_transactions_10_minutes"
    assert (ev["true_positive"], ev["false_positive"], ev["false_negative"], ev["alerts_generated"]) == (4, 0, 0, 4)
    sweep = {(r["window_minutes"], r["minimum_transactions"]): r
             for r in E.velocity_threshold_experiment(txn, SweepParams()).collect()}
    assert sweep[(10, 3)]["true_positive"] == 2 and sweep[(10, 3)]["recall"] == 0.5
    assert sweep[(10, 4)]["true_positive"] == 1 and sweep[(10, 5)]["total_alerts"] == 0
    best = E.best_velocity_config(E.velocity_threshold_experiment(txn, SweepParams())).collect()
    assert [(best[0]["window_minutes"], best[0]["minimum_transactions"])] == [(10, 3)]


def test_null_fraud_type_counts_as_alert_only(spark):
    specs = [{"transaction_timestamp": at(m), "fraud_type": None} for m in (0, 1, 2)]
    r = {(x["window_minutes"], x["minimum_transactions"]): x
         for x in E.velocity_threshold_experiment(txn_df(spark, specs), SweepParams(((10, 3),))).collect()}[(10, 3)]
    assert (r["true_positive"], r["false_positive"], r["false_negative"], r["true_negative"], r["total_alerts"]) == (
        0, 0, 0, 0, 1)
    ev = E.velocity_burst_evaluation(V.velocity_burst_scored(txn_df(spark, specs), P), P).collect()[0]
    assert (ev["false_positive"], ev["alerts_generated"]) == (3, 3)


def test_sweep_of_many_configs_matches_single_ones(spark):
    """Every config of a wide grid, repeated and unreached minimums included, has the cells of its own rule."""
    from spendwatch.operators import evaluation as E
    from spendwatch.operators import velocity as V
    from spendwatch.params import SweepParams

    from .helpers import at, txn_df

    kinds = ["velocity_attack", "none", None, "large_amount"]
    specs = [{"employee_id": i % 2, "transaction_timestamp": at((i * i) % 50), "fraud_type": kinds[i % 4]} for i in range(40)]
    df = txn_df(spark, specs)
    configs = tuple((w, k) for w in (1, 7, 30) for k in (0, 1, 2, 5, 9, 1000)) + ((7, 2),)
    got = E.velocity_threshold_experiment(df, SweepParams(configs=configs)).collect()
    assert len(got) == len(configs)
    for r in got:
        flags = V.rolling_velocity_flags(df, r["window_minutes"], r["minimum_transactions"]).collect()
        cells = [0, 0, 0, 0]
        for f in flags:
            if f["fraud_type"] is not None:
                cells[2 * (1 - f["predicted_velocity_fraud"]) + (f["fraud_type"] != "velocity_attack")] += 1
        assert [r["true_positive"], r["false_positive"], r["false_negative"], r["true_negative"]] == cells
        assert r["total_alerts"] == sum(f["predicted_velocity_fraud"] for f in flags)


def test_tables_from_cells_match_direct_ones(spark):
    """P6 and P7 from one pass, odd amounts, NULLs and no rows included."""
    from spendwatch.operators import evaluation as E

    kinds = ["velocity_attack", "none", None, "large_amount"]
    rows = [(kinds[i % 4], i % 3 % 2 if i % 11 else None, i % 2 if i % 7 else None, None if i % 13 == 0 else i * 0.37) for i in range(200)]
    rows += [("large_amount", 1, 1, 1e-9), ("none", 1, 0, 12345678901234.5)]
    schema = "fraud_type string, is_fraud int, predicted_fraud int, amount double"
    for part in (rows, rows[:1], []):
        df = spark.createDataFrame(part, schema)
        cells = E.evaluation_cells(df)
        assert E.summary_from_cells(cells).collect() == E.fraud_evaluation_summary(df).collect()
        close = [[pytest.approx(v, rel=1e-12) if isinstance(v, float) else v for v in r] for r in E.fraud_evaluation_by_type(df).collect()]
        assert [list(r) for r in E.by_type_from_cells(cells).collect()] == close

"""Cross-product invariants on the sf0.01 test tables."""

from pyspark.sql import functions as F

from spendwatch.operators import evaluation as E
from spendwatch.operators import reports as Rp
from spendwatch.operators import rules as R
from spendwatch.operators import velocity as V
from spendwatch.params import TESTDATA_RULES, RuleParams, SweepParams
from spendwatch.sources import testdata as td

from .conftest import SF001


def test_report_totals_agree(spark):
    txn = td.event_transactions(spark, SF001)
    monthly = Rp.monthly_spend_overview(txn).agg(F.sum("transaction_count"), F.sum("total_spend")).collect()[0]
    merchants = Rp.merchant_transaction_metrics(txn, td.merchants(spark, SF001))
    m = merchants.agg(F.sum("total_transactions"), F.sum("approved_transactions"),
                      F.sum("total_transaction_value")).collect()[0]
    assert monthly[0] == m[0] == txn.count()
    assert round(monthly[1], 2) == round(m[2], 2) == round(txn.agg(F.sum("amount")).collect()[0][0], 2)
    scored = R.fraud_scored_transactions(txn, TESTDATA_RULES)
    s = E.fraud_evaluation_summary(scored).collect()[0]
    assert m[1] == s["approved_transactions_scored"] == (
        s["true_positive"] + s["false_positive"] + s["true_negative"] + s["false_negative"])
    by_type = E.fraud_evaluation_by_type(scored).agg(F.sum("fraud_transactions"), F.sum("fraud_dollars")).collect()[0]
    assert by_type[0] == s["ground_truth_fraud_transactions"]
    assert round(by_type[1], 2) == s["fraud_dollars"]


def test_sweep_cells_and_monotonicity(spark):
    txn = td.event_transactions(spark, SF001)
    grid = tuple((w, k) for w in (30, 60, 120) for k in (2, 3, 4))
    rows = {(r["window_minutes"], r["minimum_transactions"]): r
            for r in E.velocity_threshold_experiment(txn, SweepParams(grid)).collect()}
    pos = {r["true_positive"] + r["false_negative"] for r in rows.values()}
    neg = {r["false_positive"] + r["true_negative"] for r in rows.values()}
    assert len(pos) == 1 and len(neg) == 1
    for w in (30, 60, 120):
        alerts = [rows[(w, k)]["total_alerts"] for k in (2, 3, 4)]
        assert alerts == sorted(alerts, reverse=True)
    for k in (2, 3, 4):
        alerts = [rows[(w, k)]["total_alerts"] for w in (30, 60, 120)]
        assert alerts == sorted(alerts)


def test_rolling_alert_implies_burst_alert(spark):
    txn = td.event_transactions(spark, SF001)
    for w, k in ((60, 2), (60, 3), (120, 3)):
        rolling = V.rolling_velocity_flags(txn, w, k).where("predicted_velocity_fraud = 1").select("transaction_id")
        burst = V.velocity_burst_scored(txn, RuleParams(burst_gap_minutes=w, burst_min_transactions=k))
        burst = burst.where("predicted_velocity_fraud = 1").select("transaction_id")
        assert rolling.join(burst, "transaction_id", "left_anti").count() == 0


def test_alert_rows_equal_predicted_rows(spark):
    txn = td.event_transactions(spark, SF001)
    alerts = R.fraud_alerts(txn, td.employees(spark, SF001), td.merchants(spark, SF001), TESTDATA_RULES)
    predicted = R.fraud_scored_transactions(txn, TESTDATA_RULES).where("predicted_fraud = 1")
    a = alerts.select("transaction_id")
    p = predicted.select("transaction_id")
    assert a.count() == p.count() == 506
    assert a.join(p, "transaction_id", "left_anti").count() == 0

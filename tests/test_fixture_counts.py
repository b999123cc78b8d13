"""The expected counts of FIXTURES.md §3, at all three scales."""

import pytest
from pyspark.sql import functions as F

from spendwatch.operators import evaluation as E
from spendwatch.operators import reports as Rp
from spendwatch.operators import rules as R
from spendwatch.operators import velocity as V
from spendwatch.params import TESTDATA_BUDGET, TESTDATA_DECLINE, TESTDATA_RULES, TESTDATA_SWEEP
from spendwatch.sources import testdata as td

EXPECTED = {
    "/root/testdata/sf0.001": dict(
        budget=(781, 77, 553), health=(3, 3, 4), approved=799, flags=(13, 14, 9, 25), alerts=(45, 13),
        labeled_tp=(28, 1), bursts={1: 686, 2: 52, 3: 3}, rolling=(58, 3, 6, 15, 1)),
    "/root/testdata/sf0.01": dict(
        budget=(7807, 876, 5377), health=(21, 49, 30), approved=7986, flags=(132, 142, 95, 292),
        alerts=(506, 130), labeled_tp=(435, 32), bursts={1: 6899, 2: 496, 3: 29, 4: 2},
        rolling=(560, 16, 75, 170, 9)),
    "/root/testdata/sf0.1": dict(
        budget=(79177, 8688, 52872), health=(283, 390, 327), approved=80190, flags=(1393, 1489, 1212, 2169),
        alerts=(4743, 1267), labeled_tp=(4060, 224), bursts={1: 69180, 2: 4899, 3: 366, 4: 26, 5: 2},
        rolling=(5717, 225, 798, 1716, 136)),
}


@pytest.mark.parametrize("sf", sorted(EXPECTED))
def test_fixture_counts(spark, sf):
    want = EXPECTED[sf]
    orders = td.order_transactions(spark, sf)
    budget = {r[0]: r[1] for r in Rp.budget_status_counts(orders, td.employees(spark, sf), TESTDATA_BUDGET).collect()}
    assert (budget["within_budget"], budget["at_risk"], budget["over_budget"]) == want["budget"]

    txn = td.event_transactions(spark, sf)
    health = {r[0]: r[1] for r in Rp.merchant_health_counts(txn, td.merchants(spark, sf), TESTDATA_DECLINE).collect()}
    assert (health["healthy"], health["monitor"], health["high_decline_risk"]) == want["health"]

    scored = R.fraud_scored_transactions(txn, TESTDATA_RULES)
    agg = scored.agg(
        F.count(F.lit(1)), *[F.sum(c) for c in R.FLAGS], F.sum("predicted_fraud"),
        F.sum(F.when(F.col("fraud_risk_score") >= 2, 1).otherwise(0)), F.sum("is_fraud"),
        F.sum(F.when((F.col("is_fraud") == 1) & (F.col("predicted_fraud") == 1), 1).otherwise(0)),
    ).collect()[0]
    assert agg[0] == want["approved"]
    assert tuple(agg[1:5]) == want["flags"]
    assert (agg[5], agg[6]) == want["alerts"]
    assert (agg[7], agg[8]) == want["labeled_tp"]

    sizes = V.burst_sizes(txn, TESTDATA_RULES.burst_gap_minutes).groupBy("transactions_in_burst").count().collect()
    assert {r[0]: r[1] for r in sizes} == want["bursts"]

    sweep = {(r["window_minutes"], r["minimum_transactions"]): r["total_alerts"]
             for r in E.velocity_threshold_experiment(txn, TESTDATA_SWEEP).collect()}
    assert tuple(sweep[c] for c in TESTDATA_SWEEP.configs) == want["rolling"]

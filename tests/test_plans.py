"""Plan shape: no Python in any plan, filters and columns reach the scan, the
burst pipeline shuffles the fact rows once, the sweep scans once."""

import re

import pytest

from spendwatch.plans.registry import queries
from spendwatch.plans.inspect import physical_plan, python_nodes, scans

from .conftest import SF0001


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_udfs(spark, name):
    assert python_nodes(queries()[name](spark, SF0001)) == []


def _final(df):
    df.collect()
    return physical_plan(df, "simple").split("== Initial Plan ==")[0]


HOT = "Join [_sw_key"  # rows meet a hot employee's segments


def test_burst_pipeline_without_hot_keys(spark):
    """The empty hot branch is dropped at run time; the fact rows are shuffled once, by employee and segment."""
    text = _final(queries()["fraud_scored_transactions"](spark, SF0001))
    assert HOT not in text, text
    assert "SortMergeJoin" not in text  # nothing joins the rows
    assert len(re.findall(r"Window \[", text)) >= 3
    assert len(re.findall(r"(?<!Reused)Exchange hashpartitioning\(_sw_key", text)) == 1, text


def test_burst_pipelines_with_hot_keys(spark):
    from spendwatch.operators import rules as R
    from spendwatch.params import TESTDATA_RULES, SkewParams
    from spendwatch.sources import testdata as td

    skew = SkewParams(sample_fraction=1.0, rows_per_bucket=5, min_bucket_minutes=60)
    scored = R.fraud_scored_transactions(td.event_transactions(spark, SF0001), TESTDATA_RULES, skew)
    assert HOT in _final(scored)


def _stored(spark, tmp_path):
    """Transactions as a stored table, so that scans and shuffles of the fact can be told."""
    from spendwatch.schemas import TRANSACTIONS
    from spendwatch.sources import tables

    from .helpers import at, txn_rows

    rows = txn_rows([{"amount": float(i), "employee_id": i % 3, "transaction_timestamp": at(i)} for i in range(30)])
    tables.save_tables({"transactions": spark.createDataFrame(rows, TRANSACTIONS)}, str(tmp_path / "wh"))
    return tables.load_table(spark, str(tmp_path / "wh"), "transactions", "parquet")


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_fraud_scoring_shuffles_the_fact_once(spark, tmp_path, threshold):
    """In the initial plan: one exchange carries the rows' columns, no join sits below it, and every other exchange is behind
    an aggregate (of the sample, or of hot employees' segments)."""
    from spendwatch.operators import rules as R

    txn = _stored(spark, tmp_path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        lines = physical_plan(R.fraud_scored_transactions(txn), "simple").splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    depth = [len(re.match(r"[\s:|+-]*", line).group()) for line in lines]
    carrying = []
    for k, line in enumerate(lines):
        if re.search(r"\bExchange hashpartitioning", line):
            below, skipped = [], None
            for d, other in zip(depth[k + 1 :], lines[k + 1 :]):
                if d <= depth[k]:
                    break
                if skipped is not None and d > skipped:
                    continue
                skipped = d if "Subquery" in other[d : d + 20] else None
                below += [] if skipped is not None else [other]
            nearest = next(x for x in below if re.search(r"Aggregate|Join|Window|FileScan|Generate", x))
            if "FileScan" in nearest:
                carrying.append((line, below))
    assert len(carrying) == 1 and "_sw_segment" in carrying[0][0], lines
    scans_of_rows = [x for x in lines if "FileScan" in x and "company_id" in x]
    assert len(scans_of_rows) == 1  # the other reads take only what the sample and the segments need


def test_rolling_events_are_made_behind_the_exchange(spark, tmp_path):
    from spendwatch.operators import velocity as V

    lines = physical_plan(V.with_rolling_counts(V.approved_only(_stored(spark, tmp_path)), [10, 20, 30]), "simple").splitlines()
    made = next(k for k, x in enumerate(lines) if "Generate explode" in x and "_sw_key" in x and "merchant_id" in x)
    moved = next(k for k, x in enumerate(lines) if "Exchange hashpartitioning(_sw_key" in x)
    assert made < moved, lines  # nearer to the result
    assert sum("REPARTITION_BY_COL" in x for x in lines) == 1


def test_previous_gap_plans_no_burst_work(spark):
    df = queries()["previous_transaction_gap"](spark, SF0001)
    assert "burst" not in physical_plan(df, "simple")


def test_merchant_metrics_aggregate_once(spark):
    text = physical_plan(queries()["merchant_transaction_metrics"](spark, SF0001), "simple")
    assert len(re.findall(r"Exchange hashpartitioning\(merchant_id#\d+L, \d+\)", text)) <= 2  # the aggregate and the dimension
    assert "decline_reason" not in text.split("FileScan")[0]


def test_filters_and_columns_reach_the_scan(spark):
    df = queries()["fraud_evaluation_by_type"](spark, SF0001)
    ev = [s for s in scans(df) if "events.parquet" in s]
    assert ev and all("props" in s or "value" in s or "ts" in s for s in ev)
    assert all("documents" not in s for s in scans(df))
    monthly = scans(queries()["monthly_spend_overview"](spark, SF0001))
    orders = [s for s in monthly if "orders.parquet" in s]
    assert orders and all("o_orderkey" in s and "o_totalprice" in s for s in orders)


def test_sweep_counts_all_widths_in_one_window(spark):
    text = _final(queries()["velocity_threshold_experiment"](spark, SF0001))
    assert len(re.findall(r"Window \[sum\(_sw_d0", text)) == 1


def test_status_filter_and_pruning_reach_parquet_on_stored_tables(spark, tmp_path):
    """On the reference layout (transactions stored as Parquet) the approved
    filter is a pushed Parquet filter and unused columns are not read."""
    from spendwatch.operators import rules as R
    from spendwatch.schemas import TRANSACTIONS
    from spendwatch.sources import tables

    from .helpers import txn_rows

    path = str(tmp_path / "wh")
    df = spark.createDataFrame(txn_rows([{"amount": 1.0}, {"amount": 2.0, "transaction_status": "declined"}]),
                               TRANSACTIONS)
    tables.save_tables({"transactions": df}, path)
    txn = tables.load_table(spark, path, "transactions", "parquet")
    scored = R.fraud_scored_transactions(txn)
    found = [s for s in scans(scored) if "transactions.parquet" in s]
    assert found
    for scan in found:
        assert "EqualTo(transaction_status,approved)" in scan
        assert "decline_reason" not in scan and "merchant_id" not in scan
    assert scored.count() == 1


@pytest.mark.parametrize("name", ["monthly_spend_overview", "budget_risk_alerts", "merchant_decline_analysis"])
def test_reports_read_the_fact_once(spark, name):
    text = _final(queries()[name](spark, SF0001))
    assert len(re.findall(r"FileScan parquet [^\n]*(?:events|orders)\.parquet", text)) == 1, text


@pytest.mark.parametrize("name", ["fraud_alerts", "fraud_scored_transactions", "fraud_evaluation_by_type",
                                  "velocity_threshold_experiment", "velocity_burst_evaluation"])
def test_ordered_products_read_the_fact_and_its_sample(spark, name):
    """One scan of the rows and one of the sample that finds hot employees; the empty hot branch is not read."""
    text = _final(queries()[name](spark, SF0001))
    assert len(re.findall(r"FileScan parquet [^\n]*events\.parquet", text)) <= 3, text

"""Named queries over the test tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each entry runs one operator of the inventory over whole tables with the
test-table parameters (see ``spendwatch.params``).  ``oracle.py`` holds the
equivalent SQL for each name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spendwatch.functions.exprs import round_half_away
from spendwatch.operators import enrich, evaluation, reports, rules, velocity
from spendwatch.params import (
    TESTDATA_BUDGET,
    TESTDATA_DECLINE,
    TESTDATA_ROLLING_MINIMUM,
    TESTDATA_ROLLING_WINDOW_MINUTES,
    TESTDATA_RULES,
    TESTDATA_SWEEP,
    SkewParams,
)
from spendwatch.sources import tables as tables_src
from spendwatch.sources import testdata as td

Query = Callable[[SparkSession, str], DataFrame]

# Unrounded averages/deviations of building-block outputs are shown with this
# many decimals (the reference rounds them only in its final reports).
STAT_DIGITS = 6

_SKEW = SkewParams()


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return td.event_transactions(spark, sf)


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return td.order_transactions(spark, sf)


def _round_stats(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "employee_avg_amount", round_half_away("employee_avg_amount", STAT_DIGITS)
    ).withColumn("employee_amount_stddev", round_half_away("employee_amount_stddev", STAT_DIGITS))


FEATURE_COLUMNS = [
    "transaction_id", "company_id", "employee_id", "employee_name", "merchant_id", "merchant_name",
    "category", "transaction_timestamp", "amount", "is_international", "merchant_country",
    "employee_avg_amount", "employee_amount_stddev", "transactions_in_burst",
]


def _features(spark: SparkSession, sf: str) -> DataFrame:
    f = rules.transaction_features(
        _events(spark, sf), TESTDATA_RULES, _SKEW, td.employees(spark, sf), td.merchants(spark, sf)
    )
    return _round_stats(f.select(*FEATURE_COLUMNS))


def _rule(flag_fn, name: str) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return _features(spark, sf).withColumn(name, flag_fn(TESTDATA_RULES))
    return q


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return rules.fraud_scored_transactions(_events(spark, sf), TESTDATA_RULES, _SKEW)


def _burst_scored(spark: SparkSession, sf: str) -> DataFrame:
    return velocity.velocity_burst_scored(_events(spark, sf), TESTDATA_RULES, _SKEW)


def _experiment(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.velocity_threshold_experiment(_events(spark, sf), TESTDATA_SWEEP, _SKEW)


GAP = TESTDATA_RULES.burst_gap_minutes

QUERIES: dict[str, Query] = {
    # P1, T14-T16, P2 (orders as the fact: 80 months)
    "monthly_spend_overview": lambda s, sf: reports.monthly_spend_overview(_orders(s, sf)),
    "monthly_employee_spend": lambda s, sf: reports.monthly_employee_spend(_orders(s, sf)).withColumn(
        "monthly_spend", round_half_away("monthly_spend", 2)
    ),
    "employee_budget_usage": lambda s, sf: reports.employee_budget_usage(_orders(s, sf), td.employees(s, sf)),
    "budget_risk_alerts": lambda s, sf: reports.budget_risk_alerts(
        _orders(s, sf), td.employees(s, sf), TESTDATA_BUDGET
    ),
    "budget_status_counts": lambda s, sf: reports.budget_status_counts(
        _orders(s, sf), td.employees(s, sf), TESTDATA_BUDGET
    ),
    # T10-T13, P4 (events as the fact)
    "merchant_transaction_metrics": lambda s, sf: reports.merchant_transaction_metrics(
        _events(s, sf), td.merchants(s, sf)
    ),
    "decline_reason_metrics": lambda s, sf: reports.decline_reason_metrics(_events(s, sf), td.merchants(s, sf)),
    "top_decline_reason": lambda s, sf: reports.top_decline_reason(
        reports.decline_reason_metrics(_events(s, sf), td.merchants(s, sf))
    ),
    "merchant_decline_analysis": lambda s, sf: reports.merchant_decline_analysis(
        _events(s, sf), td.merchants(s, sf), TESTDATA_DECLINE
    ),
    "merchant_health_counts": lambda s, sf: reports.merchant_health_counts(
        _events(s, sf), td.merchants(s, sf), TESTDATA_DECLINE
    ),
    # T1-T5, P9, T22, T23
    "employee_transaction_stats": lambda s, sf: _round_stats(rules.employee_transaction_stats(_events(s, sf))),
    "previous_transaction_gap": lambda s, sf: velocity.previous_transaction_gap(_events(s, sf), _SKEW),
    "burst_boundaries": lambda s, sf: velocity.burst_boundaries(_events(s, sf), GAP, _SKEW),
    "burst_groups": lambda s, sf: velocity.burst_groups(_events(s, sf), GAP, _SKEW),
    "burst_sizes": lambda s, sf: velocity.burst_sizes(_events(s, sf), GAP, _SKEW),
    "velocity_burst_scored": _burst_scored,
    "rolling_transaction_count": lambda s, sf: velocity.rolling_transaction_count(
        _events(s, sf), TESTDATA_ROLLING_WINDOW_MINUTES, _SKEW
    ),
    "rolling_velocity_flags": lambda s, sf: velocity.rolling_velocity_flags(
        _events(s, sf), TESTDATA_ROLLING_WINDOW_MINUTES, TESTDATA_ROLLING_MINIMUM, _SKEW
    ),
    # T6-T9, P3, P5
    "transaction_features": _features,
    "rule_large_transaction": _rule(rules.large_transaction_flag, "large_transaction_flag"),
    "rule_unusual_amount": _rule(rules.unusual_amount_flag, "unusual_amount_flag"),
    "rule_velocity_burst": _rule(rules.velocity_flag, "velocity_flag"),
    "rule_international_risk": _rule(rules.international_risk_flag, "international_risk_flag"),
    "fraud_risk_levels": lambda s, sf: evaluation.fraud_risk_level_counts(
        rules.scored_with_dimensions(_events(s, sf), td.employees(s, sf), td.merchants(s, sf), TESTDATA_RULES, _SKEW)
    ),
    "fraud_alerts": lambda s, sf: rules.fraud_alerts(
        _events(s, sf), td.employees(s, sf), td.merchants(s, sf), TESTDATA_RULES, _SKEW
    ),
    "fraud_scored_transactions": lambda s, sf: _round_stats(_scored(s, sf)),
    # T17-T21, P6-P8, P10, P11
    "fraud_confusion_matrix": lambda s, sf: evaluation.fraud_confusion_matrix(_scored(s, sf)),
    "fraud_evaluation_summary": lambda s, sf: evaluation.fraud_evaluation_summary(_scored(s, sf)),
    "fraud_evaluation_by_type": lambda s, sf: evaluation.fraud_evaluation_by_type(_scored(s, sf), amount_digits=4),
    "velocity_burst_evaluation": lambda s, sf: evaluation.velocity_burst_evaluation(
        _burst_scored(s, sf), TESTDATA_RULES
    ),
    "velocity_threshold_experiment": _experiment,
    "best_velocity_config": lambda s, sf: evaluation.best_velocity_config(_experiment(s, sf)),
    # P12-P15
    "table_row_counts": lambda s, sf: tables_src.table_row_counts(td.tables(s, sf)),
    "fraud_label_distribution": lambda s, sf: enrich.fraud_label_distribution(_events(s, sf)),
    "eligible_employees": lambda s, sf: enrich.eligible_employees(_events(s, sf), 4),
    "enriched_transactions": _events,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)

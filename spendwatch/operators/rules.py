"""Rule-based fraud scoring.

Plan shape: the approved rows are shuffled once, by (employee, segment), see ``velocity``:
the burst windows and the per-employee statistics (window aggregates) run on that partitioning,
and rows of hot employees take both from their segments.  The burst self-joins of the SQL
formulation disappear: the burst size travels with each row.  Names are joined to the rows that are left
after the alert filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendwatch.functions.exprs import money_moments, money_statistics, round_half_away
from spendwatch.operators.velocity import annotate_bursts, approved_only
from spendwatch.params import (
    DEFAULT_RULES,
    DEFAULT_SKEW,
    RISK_HIGH,
    RISK_LOW,
    RISK_MEDIUM,
    RuleParams,
    SkewParams,
)

FLAGS = ["large_transaction_flag", "unusual_amount_flag", "velocity_flag", "international_risk_flag"]


_MOMENTS = "_sw_m_"


def _with_statistics(df: DataFrame) -> DataFrame:
    """The moment columns turned into the T1 mean and deviation."""
    mean, sd = money_statistics(_MOMENTS)
    out = df.select("*", mean.alias("employee_avg_amount"), sd.alias("employee_amount_stddev"))
    return out.drop(*money_moments("amount", _MOMENTS))


def employee_transaction_stats(txn: DataFrame) -> DataFrame:
    """Mean and *population* standard deviation of approved amounts per
    employee (over the whole sample, as the reference SQL does).  A partial
    aggregate, so a hot employee is combined map-side; computed from exact
    totals, so the window form in ``transaction_features`` gives the same
    doubles."""
    aggs = money_moments("amount", _MOMENTS)
    return _with_statistics(approved_only(txn).groupBy("employee_id").agg(*[a(None).alias(n) for n, a in aggs.items()]))


def transaction_features(
    txn: DataFrame,
    rules: RuleParams = DEFAULT_RULES,
    skew: SkewParams = DEFAULT_SKEW,
    employees: DataFrame | None = None,
    merchants: DataFrame | None = None,
) -> DataFrame:
    """Approved rows with employee statistics and burst size.

    With ``employees``/``merchants`` (the P3 form) the rows gain
    ``employee_name``, ``merchant_name`` and ``category`` and rows without a
    matching dimension row are dropped (inner joins).
    """
    cols = [
        "transaction_id", "company_id", "employee_id", "merchant_id", "transaction_timestamp",
        "amount", "is_international", "merchant_country", "is_fraud", "fraud_type",
    ]
    # The statistics join on employee_id in the SQL form drops rows without
    # an employee; the filter keeps that (and reaches the scan).
    approved = approved_only(txn).where(F.col("employee_id").isNotNull()).select(*cols)
    # T1 statistics over the same approved rows, computed inside the burst plan
    rows = annotate_bursts(approved, rules.burst_gap_minutes, skew,
                           key_aggregates=money_moments("amount", _MOMENTS), need_previous=False)
    rows = _with_statistics(rows)
    if employees is not None:
        rows = rows.join(employees.select("employee_id", "employee_name"), "employee_id")
    if merchants is not None:
        rows = rows.join(merchants.select("merchant_id", "merchant_name", "category"), "merchant_id")
    return rows


def large_transaction_flag(rules: RuleParams = DEFAULT_RULES) -> Column:
    """``amount >= large_amount``."""
    return F.when(F.col("amount") >= rules.large_amount, 1).otherwise(0)


def unusual_amount_flag(rules: RuleParams = DEFAULT_RULES) -> Column:
    """``stddev > 0 and amount > avg + k * stddev`` (strict)."""
    sd = F.col("employee_amount_stddev")
    return F.when(
        (sd > 0) & (F.col("amount") > F.col("employee_avg_amount") + F.lit(rules.stddev_multiplier) * sd), 1
    ).otherwise(0)


def velocity_flag(rules: RuleParams = DEFAULT_RULES) -> Column:
    """The row's burst has at least ``burst_min_transactions`` rows."""
    return F.when(F.col("transactions_in_burst") >= rules.burst_min_transactions, 1).otherwise(0)


def international_risk_flag(rules: RuleParams = DEFAULT_RULES) -> Column:
    """T7d: international and ``amount >= international_amount``; NULL -> 0."""
    return F.when(
        (F.col("is_international") == F.lit(True)) & (F.col("amount") >= rules.international_amount), 1
    ).otherwise(0)


def with_rule_flags(features: DataFrame, rules: RuleParams = DEFAULT_RULES) -> DataFrame:
    """T7a-d as four 0/1 columns."""
    return features.select(
        "*",
        large_transaction_flag(rules).alias("large_transaction_flag"),
        unusual_amount_flag(rules).alias("unusual_amount_flag"),
        velocity_flag(rules).alias("velocity_flag"),
        international_risk_flag(rules).alias("international_risk_flag"),
    )


def with_risk_score(flagged: DataFrame, rules: RuleParams = DEFAULT_RULES) -> DataFrame:
    """``fraud_risk_score`` (sum of flags) and ``fraud_risk_level``."""
    score = F.col(FLAGS[0]) + F.col(FLAGS[1]) + F.col(FLAGS[2]) + F.col(FLAGS[3])
    out = flagged.withColumn("fraud_risk_score", score)
    s = F.col("fraud_risk_score")
    return out.withColumn(
        "fraud_risk_level",
        F.when(s >= rules.high_risk_score, F.lit(RISK_HIGH))
        .when(s >= rules.alert_min_score, F.lit(RISK_MEDIUM))
        .otherwise(F.lit(RISK_LOW)),
    )


def scored_with_dimensions(txn: DataFrame, employees: DataFrame, merchants: DataFrame,
                           rules: RuleParams = DEFAULT_RULES,
                           skew: SkewParams = DEFAULT_SKEW) -> DataFrame:
    """T6-T8 in the P3 form (with the dimension joins), before the alert filter."""
    feats = transaction_features(txn, rules, skew, employees, merchants)
    return with_risk_score(with_rule_flags(feats, rules), rules)


FRAUD_ALERT_COLUMNS = [
    "transaction_id", "company_id", "employee_id", "employee_name", "merchant_name", "category",
    "transaction_timestamp", "amount", "is_international", "merchant_country",
    "employee_avg_amount", "employee_amount_stddev", "transactions_in_burst",
    *FLAGS, "fraud_risk_score", "fraud_risk_level",
]


def fraud_alerts(txn: DataFrame, employees: DataFrame, merchants: DataFrame,
                 rules: RuleParams = DEFAULT_RULES, skew: SkewParams = DEFAULT_SKEW) -> DataFrame:
    """Approved rows with score >= ``alert_min_score``, highest score and
    amount first; the employee statistics are shown rounded to 2 decimals."""
    scored = scored_with_dimensions(txn, employees, merchants, rules, skew)
    alerts = scored.where(F.col("fraud_risk_score") >= rules.alert_min_score)
    alerts = alerts.withColumn(
        "employee_avg_amount", round_half_away("employee_avg_amount", 2)
    ).withColumn("employee_amount_stddev", round_half_away("employee_amount_stddev", 2))
    # a shuffle of the few alerts ends the stage of windows and joins, which the sampling of the range sort would run again
    return alerts.select(*FRAUD_ALERT_COLUMNS).repartition("transaction_id").orderBy(
        F.desc("fraud_risk_score"), F.desc("amount"), F.asc("transaction_id")
    )


SCORED_COLUMNS = [
    "transaction_id", "company_id", "employee_id", "transaction_timestamp", "amount",
    "is_international", "is_fraud", "fraud_type", "employee_avg_amount",
    "employee_amount_stddev", "transactions_in_burst", *FLAGS, "fraud_risk_score", "predicted_fraud",
]


def fraud_scored_transactions(txn: DataFrame, rules: RuleParams = DEFAULT_RULES,
                              skew: SkewParams = DEFAULT_SKEW) -> DataFrame:
    """P5: every approved row with labels, flags, score and ``predicted_fraud``
    (score >= ``alert_min_score``); no dimension joins."""
    feats = transaction_features(txn, rules, skew)
    scored = with_risk_score(with_rule_flags(feats, rules), rules)
    return scored.withColumn(
        "predicted_fraud", F.when(F.col("fraud_risk_score") >= rules.alert_min_score, 1).otherwise(0)
    ).select(*SCORED_COLUMNS)

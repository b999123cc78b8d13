"""Spend, budget and merchant reports.

Every report aggregates the fact table first (partial + final aggregation, so
a hot key is combined map-side) and joins dimensions to the aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendwatch.functions.exprs import (
    exact_units,
    is_approved,
    is_declined,
    money_avg,
    money_rest,
    money_sum,
    money_total,
    month_start,
    round_half_away,
)
from spendwatch.params import (
    BUDGET_AT_RISK,
    BUDGET_OVER,
    BUDGET_WITHIN,
    DEFAULT_BUDGET,
    DEFAULT_DECLINE,
    HEALTH_HIGH,
    HEALTH_MONITOR,
    HEALTH_OK,
    BudgetParams,
    DeclineParams,
)

TS = "transaction_timestamp"


# --------------------------------------------------------------------------
# P1 monthly spend
# --------------------------------------------------------------------------


def monthly_spend_overview(txn: DataFrame) -> DataFrame:
    """Per month, all rows (declined included): count, total and mean
    amount, and the approved share in percent; ordered by month."""
    return (
        txn.groupBy(month_start(TS).alias("transaction_month"))
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            round_half_away(money_sum("amount"), 2).alias("total_spend"),
            round_half_away(money_avg("amount"), 2).alias("average_transaction_amount"),
            round_half_away(
                F.lit(100.0) * F.avg(F.when(is_approved(), 1).otherwise(0)), 2
            ).alias("approval_rate_pct"),
        )
        .orderBy(F.asc_nulls_last("transaction_month"))
    )


# --------------------------------------------------------------------------
# T14-T16, P2 budget risk
# --------------------------------------------------------------------------


def monthly_employee_spend(txn: DataFrame) -> DataFrame:
    """Approved spend per (month, employee, company); a month with only
    declined rows gives 0, a month without rows is absent."""
    return txn.groupBy(
        month_start(TS).alias("spend_month"), "employee_id", "company_id"
    ).agg(money_sum(F.when(is_approved(), F.col("amount")).otherwise(F.lit(0.0))).alias("monthly_spend"))


def employee_budget_usage(txn: DataFrame, employees: DataFrame) -> DataFrame:
    """Monthly spend against the employee's budget (no filter).

    The join runs after the aggregation, so it sees one row per
    (month, employee) rather than one per transaction.
    """
    spend = monthly_employee_spend(txn)
    emp = employees.select("employee_id", "employee_name", "department", "monthly_budget")
    j = spend.join(emp, "employee_id")
    return j.select(
        "spend_month",
        "company_id",
        "employee_id",
        "employee_name",
        "department",
        "monthly_budget",
        round_half_away("monthly_spend", 2).alias("monthly_spend"),
        round_half_away(
            F.try_divide(F.lit(100.0) * F.col("monthly_spend"), F.col("monthly_budget")), 2
        ).alias("budget_used_pct"),
        round_half_away(F.col("monthly_spend") - F.col("monthly_budget"), 2).alias("budget_overage"),
    )


def with_budget_status(usage: DataFrame, params: BudgetParams = DEFAULT_BUDGET) -> DataFrame:
    """Status from the *rounded* percentage."""
    pct = F.col("budget_used_pct")
    return usage.withColumn(
        "budget_status",
        F.when(pct >= params.over_pct, F.lit(BUDGET_OVER))
        .when(pct >= params.at_risk_pct, F.lit(BUDGET_AT_RISK))
        .otherwise(F.lit(BUDGET_WITHIN)),
    )


def budget_risk_alerts(txn: DataFrame, employees: DataFrame,
                       params: BudgetParams = DEFAULT_BUDGET) -> DataFrame:
    """Employee-months at or above the at-risk band, newest and fullest first."""
    usage = with_budget_status(employee_budget_usage(txn, employees), params)
    return usage.where(F.col("budget_used_pct") >= params.at_risk_pct).orderBy(
        F.desc_nulls_last("spend_month"), F.desc_nulls_last("budget_used_pct"), F.asc("employee_id")
    )


def budget_status_counts(txn: DataFrame, employees: DataFrame,
                         params: BudgetParams = DEFAULT_BUDGET) -> DataFrame:
    """Employee-months per budget status, ``within_budget`` included."""
    usage = with_budget_status(employee_budget_usage(txn, employees), params)
    return usage.groupBy("budget_status").agg(F.count(F.lit(1)).alias("employee_months"))


# --------------------------------------------------------------------------
# T10-T13, P4 merchant declines
# --------------------------------------------------------------------------


def _merchant_dim(merchants: DataFrame) -> DataFrame:
    return merchants.select(
        "merchant_id", "merchant_name", "category", F.col("country").alias("merchant_country")
    )


def merchant_status_counts(txn: DataFrame) -> DataFrame:
    """Rows and amounts per (merchant, status, reason): the one pre-aggregate
    both merchant tables are derived from, so the fact table is scanned and
    shuffled once (partial aggregation map-side; at most merchants x (1 +
    reasons) rows after it)."""
    return txn.groupBy("merchant_id", "transaction_status", "decline_reason").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count("amount").alias("_n_amount"),
        F.sum(exact_units("amount")).alias("_units"),  # see money_sum
        F.sum(money_rest("amount")).alias("_rest"),
    )


def _per_merchant(counts: DataFrame) -> DataFrame:
    approved_n = F.sum(F.when(is_approved(), F.col("_n")).otherwise(0))
    aggs = [
        F.sum("_n").alias("total_transactions"),
        approved_n.alias("approved_transactions"),
        F.sum(F.when(is_declined(), F.col("_n")).otherwise(0)).alias("declined_transactions"),
        money_total(F.sum("_units"), F.sum("_rest")).alias("_total_value"),
        F.try_divide(
            money_total(F.sum(F.when(is_approved(), F.col("_units"))), F.sum(F.when(is_approved(), F.col("_rest")))),
            F.sum(F.when(is_approved(), F.col("_n_amount"))),
        ).alias("_avg_approved"),
    ]
    # T12 as an aggregate: the declined (merchant, reason) group with the
    # smallest (-count, reason is null, reason), i.e. the largest count,
    # ties to the alphabetically first reason, NULL last -- the row that
    # row_number() = 1 picks.  Approved groups have no ranking value and
    # are skipped; a merchant without declines gets NULL.
    rank = F.when(
        is_declined(),
        F.struct(
            (-F.col("_n")).alias("neg_count"),
            F.col("decline_reason").isNull().alias("null_last"),
            F.col("decline_reason").alias("reason"),
        ),
    )
    aggs.append(F.min_by("decline_reason", rank).alias("most_common_decline_reason"))
    return counts.groupBy("merchant_id").agg(*aggs)


_METRIC_COLUMNS = [
    "merchant_id",
    "merchant_name",
    "category",
    "merchant_country",
    "total_transactions",
    "approved_transactions",
    "declined_transactions",
]


def merchant_transaction_metrics(txn: DataFrame, merchants: DataFrame) -> DataFrame:
    """Per merchant: total/approved/declined counts, total value of all
    rows, mean of approved amounts only (NULL without approved rows).

    One aggregate by merchant_id (it determines name, category and country)
    with conditional counts and sums, then the join to the dimension.
    """
    approved_amount = F.when(is_approved(), F.col("amount"))
    per_merchant = txn.groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(F.when(is_approved(), 1).otherwise(0)).alias("approved_transactions"),
        F.sum(F.when(is_declined(), 1).otherwise(0)).alias("declined_transactions"),
        money_sum("amount").alias("_total_value"),
        money_avg(approved_amount).alias("_avg_approved"),
    )
    j = per_merchant.join(_merchant_dim(merchants), "merchant_id")
    return j.select(
        *_METRIC_COLUMNS,
        round_half_away("_total_value", 2).alias("total_transaction_value"),
        round_half_away("_avg_approved", 2).alias("avg_approved_transaction_amount"),
    )


def decline_reason_metrics(txn: DataFrame, merchants: DataFrame,
                           counts: DataFrame | None = None) -> DataFrame:
    """Declined rows per (merchant, reason), for known merchants only.

    The dimension is only an existence check, so it is a semi-join.
    """
    c = counts if counts is not None else merchant_status_counts(txn)
    declined = c.where(is_declined()).select(
        "merchant_id", "decline_reason", F.col("_n").alias("decline_count")
    )
    return declined.join(merchants.select("merchant_id"), "merchant_id", "left_semi")


def top_decline_reason(reasons: DataFrame) -> DataFrame:
    """The most frequent reason per merchant, ties to the alphabetically
    first reason (NULL last).  ``row_number = 1`` plans as a per-group limit."""
    w = Window.partitionBy("merchant_id").orderBy(
        F.desc("decline_count"), F.asc_nulls_last("decline_reason")
    )
    return (
        reasons.withColumn("reason_rank", F.row_number().over(w).cast("long"))
        .where(F.col("reason_rank") == 1)
        .select(
            "merchant_id",
            F.col("decline_reason").alias("most_common_decline_reason"),
            "decline_count",
            "reason_rank",
        )
    )


def merchant_decline_analysis(txn: DataFrame, merchants: DataFrame,
                              params: DeclineParams = DEFAULT_DECLINE) -> DataFrame:
    """P4 (T10 + T12 + T13): rates, top reason and a payment-health band.

    The band compares the *unrounded* decline rate; the shown rates are
    rounded to 2 decimals.
    """
    # One pass over the fact: (merchant, status, reason) partial aggregate,
    # then one row per merchant carrying the metrics and the top reason.
    per_merchant = _per_merchant(merchant_status_counts(txn))
    j = per_merchant.join(_merchant_dim(merchants), "merchant_id")
    total = F.col("total_transactions")
    approval = F.try_divide(F.lit(100.0) * F.col("approved_transactions"), total)
    decline = F.try_divide(F.lit(100.0) * F.col("declined_transactions"), total)
    out = j.select(
        "merchant_id",
        "merchant_name",
        "category",
        "merchant_country",
        "total_transactions",
        "approved_transactions",
        "declined_transactions",
        round_half_away(approval, 2).alias("approval_rate_pct"),
        round_half_away(decline, 2).alias("decline_rate_pct"),
        round_half_away("_total_value", 2).alias("total_transaction_value"),
        round_half_away("_avg_approved", 2).alias("avg_approved_transaction_amount"),
        "most_common_decline_reason",
        F.when(decline >= params.high_pct, F.lit(HEALTH_HIGH))
        .when(decline >= params.monitor_pct, F.lit(HEALTH_MONITOR))
        .otherwise(F.lit(HEALTH_OK))
        .alias("merchant_payment_health"),
    )
    return out.orderBy(
        F.desc_nulls_last("decline_rate_pct"), F.desc_nulls_last("total_transactions"), F.asc("merchant_id")
    )


def merchant_health_counts(txn: DataFrame, merchants: DataFrame,
                           params: DeclineParams = DEFAULT_DECLINE) -> DataFrame:
    """Merchants per payment-health band."""
    return (
        merchant_decline_analysis(txn, merchants, params)
        .groupBy("merchant_payment_health")
        .agg(F.count(F.lit(1)).alias("merchants"))
    )

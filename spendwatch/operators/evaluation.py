"""Evaluation of the rules against labels.

Every metric table is one aggregate over the scored rows (partial sums on
each partition, one tiny final merge); ratios are computed on the merged
row.  Nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendwatch.functions.exprs import (
    exact_units,
    money_avg,
    money_rest,
    money_sum,
    money_total,
    round_half_away,
    safe_divide,
    zero_if_null,
)
from spendwatch.operators.velocity import approved_only, window_count_column, with_rolling_counts
from spendwatch.params import (
    BURST_METHOD_FORMAT,
    DEFAULT_SKEW,
    DEFAULT_SWEEP,
    FRAUD_NONE,
    FRAUD_VELOCITY,
    RuleParams,
    SkewParams,
    SweepParams,
)

VELOCITY_LABEL = FRAUD_VELOCITY


def _count_if(cond: Column) -> Column:
    return zero_if_null(F.sum(F.when(cond, 1).otherwise(0))).cast("long")


def confusion_aggregates(label: Column, predicted: Column) -> list[Column]:
    """TP / FP / TN / FN as aggregate expressions (NULL label or
    prediction falls in no cell)."""
    return [
        _count_if(label & predicted).alias("true_positive"),
        _count_if(~label & predicted).alias("false_positive"),
        _count_if(~label & ~predicted).alias("true_negative"),
        _count_if(label & ~predicted).alias("false_negative"),
    ]


def rate_columns(digits: int = 4) -> list[Column]:
    """Precision, recall, false-positive rate from the confusion cells."""
    tp, fp = F.col("true_positive"), F.col("false_positive")
    tn, fn = F.col("true_negative"), F.col("false_negative")
    return [
        round_half_away(safe_divide(tp, tp + fp), digits).alias("precision"),
        round_half_away(safe_divide(tp, tp + fn), digits).alias("recall"),
        round_half_away(safe_divide(fp, fp + tn), digits).alias("false_positive_rate"),
    ]


def fraud_confusion_matrix(scored: DataFrame) -> DataFrame:
    """T17 on P5 output: ``is_fraud`` against ``predicted_fraud``."""
    return scored.agg(
        *confusion_aggregates(F.col("is_fraud") == 1, F.col("predicted_fraud") == 1)
    )


def fraud_evaluation_summary(scored: DataFrame) -> DataFrame:
    """P6 (T17-T21): one row of counts, rates and dollar capture."""
    fraud = F.col("is_fraud") == 1
    pred = F.col("predicted_fraud") == 1
    agg = scored.agg(
        F.count(F.lit(1)).alias("approved_transactions_scored"),
        zero_if_null(F.sum("is_fraud")).cast("long").alias("ground_truth_fraud_transactions"),
        zero_if_null(F.sum("predicted_fraud")).cast("long").alias("alerts_generated"),
        *confusion_aggregates(fraud, pred),
        F.avg("predicted_fraud").alias("_alert_rate"),
        F.coalesce(money_sum(F.when(fraud, F.col("amount"))), F.lit(0.0)).alias("_fraud_dollars"),
        F.coalesce(money_sum(F.when(fraud & pred, F.col("amount"))), F.lit(0.0)).alias("_captured"),
    )
    return _summary_row(agg)


def _summary_row(agg: DataFrame) -> DataFrame:
    """Rates and rounded amounts of the summary's aggregate."""
    return agg.select(
        "approved_transactions_scored",
        "ground_truth_fraud_transactions",
        "alerts_generated",
        "true_positive",
        "false_positive",
        "true_negative",
        "false_negative",
        *rate_columns(4),
        round_half_away("_alert_rate", 4).alias("alert_rate"),
        round_half_away("_fraud_dollars", 2).alias("fraud_dollars"),
        round_half_away("_captured", 2).alias("fraud_dollars_captured"),
        round_half_away(safe_divide("_captured", "_fraud_dollars"), 4).alias("fraud_dollar_capture_rate"),
    )


def fraud_evaluation_by_type(scored: DataFrame, amount_digits: int | None = None) -> DataFrame:
    """Per labeled fraud type: labels, detections, mean and total amount,
    recall (NULL when a type has no labels).

    ``amount_digits`` optionally rounds the two amount columns (the reference
    leaves them unrounded).
    """
    per_type = (
        scored.where((F.col("fraud_type") != F.lit(FRAUD_NONE)) & F.col("fraud_type").isNotNull())
        .groupBy("fraud_type")
        .agg(
            F.sum("is_fraud").cast("long").alias("fraud_transactions"),
            F.sum("predicted_fraud").cast("long").alias("detected_transactions"),
            money_avg("amount").alias("average_amount"),
            money_sum("amount").alias("fraud_dollars"),
        )
    )
    if amount_digits is not None:
        per_type = per_type.withColumn(
            "average_amount", round_half_away("average_amount", amount_digits)
        ).withColumn("fraud_dollars", round_half_away("fraud_dollars", 2))
    return _with_recall(per_type)


def _with_recall(per_type: DataFrame) -> DataFrame:
    return per_type.withColumn(
        "recall",
        round_half_away(
            F.try_divide(F.col("detected_transactions").cast("double"), F.col("fraud_transactions")), 4
        ),
    ).orderBy("fraud_type")


def evaluation_cells(scored: DataFrame) -> DataFrame:
    """What P6 and P7 need of the scored rows, in one pass: counts and exact totals per (type, label, prediction).

    A few rows per fraud type, made map-side.
    """
    return scored.groupBy("fraud_type", "is_fraud", "predicted_fraud").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("amount").alias("amounts"),
        F.sum(exact_units("amount")).alias("units"),
        F.sum(money_rest("amount")).alias("rest"),
    )


def _cell_total(where: Column | None = None) -> Column:
    """Total amount of the cells (that ``where`` holds for)."""
    units, rest = F.col("units"), F.col("rest")
    if where is not None:
        units, rest = F.when(where, units), F.when(where, rest)
    return money_total(F.sum(units), F.sum(rest))


def summary_from_cells(cells: DataFrame) -> DataFrame:
    """``fraud_evaluation_summary`` from ``evaluation_cells``."""
    fraud, pred, n = F.col("is_fraud") == 1, F.col("predicted_fraud") == 1, F.col("rows")
    count = lambda cond: zero_if_null(F.sum(F.when(cond, n))).cast("long")
    agg = cells.agg(
        zero_if_null(F.sum(n)).cast("long").alias("approved_transactions_scored"),
        zero_if_null(F.sum(F.col("is_fraud") * n)).cast("long").alias("ground_truth_fraud_transactions"),
        zero_if_null(F.sum(F.col("predicted_fraud") * n)).cast("long").alias("alerts_generated"),
        count(fraud & pred).alias("true_positive"),
        count(~fraud & pred).alias("false_positive"),
        count(~fraud & ~pred).alias("true_negative"),
        count(fraud & ~pred).alias("false_negative"),
        F.try_divide(F.sum(F.col("predicted_fraud") * n).cast("double"), F.sum(F.when(F.col("predicted_fraud").isNotNull(), n))).alias("_alert_rate"),
        F.coalesce(_cell_total(fraud), F.lit(0.0)).alias("_fraud_dollars"),
        F.coalesce(_cell_total(fraud & pred), F.lit(0.0)).alias("_captured"),
    )
    return _summary_row(agg)


def by_type_from_cells(cells: DataFrame) -> DataFrame:
    """``fraud_evaluation_by_type`` from ``evaluation_cells``."""
    n = F.col("rows")
    per_type = (
        cells.where((F.col("fraud_type") != F.lit(FRAUD_NONE)) & F.col("fraud_type").isNotNull())
        .groupBy("fraud_type")
        .agg(
            F.sum(F.col("is_fraud") * n).cast("long").alias("fraud_transactions"),
            F.sum(F.col("predicted_fraud") * n).cast("long").alias("detected_transactions"),
            F.try_divide(_cell_total(), F.sum("amounts")).alias("average_amount"),
            _cell_total().alias("fraud_dollars"),
        )
    )
    return _with_recall(per_type)


def fraud_risk_level_counts(scored: DataFrame) -> DataFrame:
    """Rows per ``fraud_risk_level`` (low_risk included)."""
    return scored.groupBy("fraud_risk_level").agg(F.count(F.lit(1)).alias("transactions"))


def burst_method_name(rules: RuleParams) -> str:
    gap = rules.burst_gap_minutes
    gap_txt = str(int(gap)) if float(gap).is_integer() else str(gap)
    return BURST_METHOD_FORMAT.format(minimum=rules.burst_min_transactions, gap=gap_txt)


def velocity_burst_evaluation(burst_scored: DataFrame, rules: RuleParams) -> DataFrame:
    """P10: the burst rule against ``fraud_type = 'velocity_attack'``; a NULL
    type counts as not velocity fraud."""
    label = F.coalesce(F.col("fraud_type") == F.lit(VELOCITY_LABEL), F.lit(False))
    pred = F.col("predicted_velocity_fraud") == 1
    agg = burst_scored.agg(*confusion_aggregates(label, pred))
    return agg.select(
        F.lit(burst_method_name(rules)).alias("method"),
        "true_positive",
        "false_positive",
        "false_negative",
        "true_negative",
        *rate_columns(4),
        (F.col("true_positive") + F.col("false_positive")).alias("alerts_generated"),
    )


def velocity_threshold_experiment(txn: DataFrame, sweep: SweepParams = DEFAULT_SWEEP,
                                  skew: SkewParams = DEFAULT_SKEW) -> DataFrame:
    """The rolling-count rule for every (window, minimum) config.

    One scan and one exchange give a count column per distinct window width.  The rows are then a
    histogram (width, count up to the width's largest minimum, label), made map-side, and sums from
    the highest count down answer every minimum of a width at once: the cost does not
    depend on the number of configs of a width.  The SQL semantics of ``fraud_type !=
    'velocity_attack'`` are kept (a NULL type lands in no cell but still counts as an alert).
    """
    configs = list(sweep.configs)
    base = approved_only(txn).select(
        "transaction_id", "employee_id", "transaction_timestamp", "fraud_type"
    )
    counted = with_rolling_counts(base, [w for w, _ in configs], skew)
    widths = sorted({window_count_column(w) for w, _ in configs})
    most = {c: max(k for w, k in configs if window_count_column(w) == c) for c in widths}
    cells = ", ".join(f"struct({i} AS width, CAST(least({c}, {most[c]}) AS BIGINT) AS held)" for i, c in enumerate(widths))
    found = counted.selectExpr(
        f"inline(array({cells}))",
        f"if(fraud_type = '{VELOCITY_LABEL}', 1L, 0L) AS vel",
        f"if(fraud_type != '{VELOCITY_LABEL}', 1L, 0L) AS other",
    ).groupBy("width", "held").agg(F.sum("vel").alias("vel"), F.sum("other").alias("other"), F.count(F.lit(1)).alias("n"))
    # the asked minimums are rows too, so that each has its sums even if no row has that count
    asked = F.array(*[
        F.struct(F.lit(widths.index(window_count_column(w))).alias("width"), F.lit(k).cast("long").alias("held"),
                 F.struct(F.lit(w).alias("window_minutes"), F.lit(k).alias("minimum_transactions")).alias("config"))
        for w, k in configs
    ])
    zero = F.lit(0).cast("long")
    grid = txn.sparkSession.range(1).select(F.inline(asked)).select(
        "width", "held", zero.alias("vel"), zero.alias("other"), zero.alias("n"), "config"
    )
    histogram = grid.unionByName(found, allowMissingColumns=True).groupBy("width", "held").agg(
        *[F.sum(c).alias(c) for c in ("vel", "other", "n")], F.collect_list("config").alias("configs")
    )
    above = "PARTITION BY width ORDER BY held DESC"
    sums = [f"sum({c}) OVER ({above}) AS {c}_above" for c in ("vel", "other", "n")]
    totals = [f"sum({c}) OVER (PARTITION BY width) AS {c}_all" for c in ("vel", "other")]
    rows = histogram.selectExpr("configs", *sums, *totals).selectExpr("inline(configs)", "*")
    out = rows.select(
        "window_minutes",
        "minimum_transactions",
        F.col("vel_above").alias("true_positive"),
        F.col("other_above").alias("false_positive"),
        (F.col("vel_all") - F.col("vel_above")).alias("false_negative"),
        (F.col("other_all") - F.col("other_above")).alias("true_negative"),
        F.col("n_above").alias("total_alerts"),
    )
    out = out.select("*", *rate_columns(4)).select(
        "window_minutes", "minimum_transactions", "true_positive", "false_positive", "false_negative", "true_negative",
        "total_alerts", "precision", "recall", "false_positive_rate",
    )
    return out.orderBy(
        F.desc("recall"), F.desc("precision"), F.asc("window_minutes"), F.asc("minimum_transactions")
    )


def best_velocity_config(experiment: DataFrame) -> DataFrame:
    """The config with the highest recall, then precision (ties to the
    smaller window, then the smaller minimum)."""
    return experiment.orderBy(
        F.desc("recall"), F.desc("precision"), F.asc("window_minutes"), F.asc("minimum_transactions")
    ).limit(1)

"""Report writers and the report registry (the reference's run-all step).

Reports are written by the executors, never collected.  Small reports whose
size is bounded by construction (one row, one row per config or fraud type)
may be written as a single file; everything else keeps its partitioning.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from spendwatch.operators import evaluation, reports, rules, velocity
from spendwatch.params import (
    DEFAULT_BUDGET,
    DEFAULT_DECLINE,
    DEFAULT_RULES,
    DEFAULT_SKEW,
    DEFAULT_SWEEP,
    BudgetParams,
    DeclineParams,
    RuleParams,
    SkewParams,
    SweepParams,
)
from spendwatch.sources.tables import TIMESTAMP_FORMAT


def write_report(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False,
                 mode: str = "overwrite") -> str:
    """Write ``df`` to ``path`` (CSV with a header, or Parquet); overwrite by default."""
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        # six fraction digits, the pattern that ``tables.load_table`` reads
        writer = writer.option("header", True).option("timestampNTZFormat", TIMESTAMP_FORMAT)
    writer.save(path)
    return path


def read_report(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """A written report, with its declared schema."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST").option("timestampNTZFormat", TIMESTAMP_FORMAT)
    return reader.format(fmt).load(path)


Report = Callable[[dict[str, DataFrame]], DataFrame]


def report_registry(rule_params: RuleParams = DEFAULT_RULES, budget: BudgetParams = DEFAULT_BUDGET,
                    decline: DeclineParams = DEFAULT_DECLINE,
                    skew: SkewParams = DEFAULT_SKEW) -> dict[str, tuple[Report, bool]]:
    """The four reports: name -> (function of the tables, bounded size)."""
    return {
        "monthly_spend_overview": (lambda t: reports.monthly_spend_overview(t["transactions"]), True),
        "budget_risk_alerts": (
            lambda t: reports.budget_risk_alerts(t["transactions"], t["employees"], budget), False),
        "fraud_alerts": (
            lambda t: rules.fraud_alerts(t["transactions"], t["employees"], t["merchants"], rule_params, skew),
            False),
        "merchant_decline_analysis": (
            lambda t: reports.merchant_decline_analysis(t["transactions"], t["merchants"], decline), False),
    }


def run_reports(tables: dict[str, DataFrame], out_dir: str, fmt: str = "parquet",
                **params) -> dict[str, str]:
    """Write every report under ``out_dir``; returns name -> path."""
    written = {}
    for name, (fn, bounded) in report_registry(**params).items():
        written[name] = write_report(fn(tables), os.path.join(out_dir, name), fmt, single_file=bounded)
    return written


def run_evaluations(spark: SparkSession, tables: dict[str, DataFrame], out_dir: str, fmt: str = "parquet",
                    rule_params: RuleParams = DEFAULT_RULES, sweep: SweepParams = DEFAULT_SWEEP,
                    skew: SkewParams = DEFAULT_SKEW) -> dict[str, str]:
    """The three evaluations.  The scored rows are an output anyway: they are
    written first, in the asked format, and the summary and per-type tables are
    computed from the written files, which cuts the lineage instead of
    recomputing the scoring.  Both come from one pass over them (``evaluation_cells``, a few
    rows per fraud type, which are kept).  CSV is read
    back with the declared schema; doubles are written in their shortest exact
    form, so both formats give the same summaries."""
    txn = tables["transactions"]
    out = {}
    scored_path = os.path.join(out_dir, "fraud_rule_scored_transactions")
    scored = rules.fraud_scored_transactions(txn, rule_params, skew)
    out["fraud_rule_scored_transactions"] = write_report(scored, scored_path, fmt)
    scored = read_report(spark, scored_path, scored.schema, fmt)
    cells = evaluation.evaluation_cells(scored).persist()
    small = {
        "fraud_rule_evaluation_summary": evaluation.summary_from_cells(cells),
        "fraud_rule_evaluation_by_type": evaluation.by_type_from_cells(cells),
        "velocity_threshold_experiment": evaluation.velocity_threshold_experiment(txn, sweep, skew),
        "velocity_burst_evaluation": evaluation.velocity_burst_evaluation(
            velocity.velocity_burst_scored(txn, rule_params, skew), rule_params),
    }
    for name, df in small.items():
        out[name] = write_report(df, os.path.join(out_dir, name), fmt, single_file=True)
    cells.unpersist()
    return out

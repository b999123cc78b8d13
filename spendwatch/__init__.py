"""spendwatch — card-spend analytics on Spark DataFrames.

Monthly spend reports, employee budget alerts, merchant decline analysis,
rule-based fraud scoring (large amount, per-employee outlier, international,
burst velocity) and the evaluation that goes with it, all written as
DataFrame plans so Catalyst and AQE choose the physical strategy.
"""

from spendwatch.params import (  # noqa: F401
    BudgetParams,
    DeclineParams,
    RuleParams,
    SkewParams,
    SweepParams,
)

__all__ = ["BudgetParams", "DeclineParams", "RuleParams", "SkewParams", "SweepParams"]

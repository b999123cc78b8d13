"""Tunable thresholds as frozen dataclasses.

Defaults are the reference's fixed values; every operator takes its params
as an argument so the same code runs on data of any scale.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# These must equal the reference's outputs exactly.
# ---------------------------------------------------------------------------
# Transaction status values.
STATUS_APPROVED = "approved"
STATUS_DECLINED = "declined"
# Fraud labels: no fraud, then the three injected kinds.
FRAUD_NONE = "none"
FRAUD_LARGE_AMOUNT = "large_amount"
FRAUD_INTERNATIONAL = "international_purchase"
FRAUD_VELOCITY = "velocity_attack"
# Fraud risk levels, highest first.
RISK_HIGH = "high_risk"
RISK_MEDIUM = "medium_risk"
RISK_LOW = "low_risk"
# Budget statuses, highest first.
BUDGET_OVER = "over_budget"
BUDGET_AT_RISK = "at_risk"
BUDGET_WITHIN = "within_budget"
# Merchant payment-health bands, worst first.
HEALTH_HIGH = "high_decline_risk"
HEALTH_MONITOR = "monitor"
HEALTH_OK = "healthy"
# Name of the burst method in its evaluation row.
BURST_METHOD_FORMAT = "burst_level_{minimum}_transactions_{gap}_minutes"
# Country of the card programme: other merchant countries are international.
HOME_COUNTRY = "US"
# Rule thresholds, bands and the sweep grid are the defaults of the
# dataclasses below; they are fixed values too.


@dataclass(frozen=True)
class RuleParams:
    """Fraud rules (T7a-d) and scoring."""

    large_amount: float = 5000.0            # amount >= this -> large_transaction_flag
    stddev_multiplier: float = 3.0          # amount > avg + k * stddev_pop -> unusual
    burst_gap_minutes: float = 10.0         # gap strictly greater than this starts a new burst
    burst_min_transactions: int = 3         # burst size >= this -> velocity_flag
    international_amount: float = 1000.0    # international and amount >= this
    high_risk_score: int = 2                # score >= this -> high_risk
    alert_min_score: int = 1                # score >= this -> alert / medium_risk


@dataclass(frozen=True)
class BudgetParams:
    """Budget status bands (T16), compared against the rounded percentage."""

    at_risk_pct: float = 80.0
    over_pct: float = 100.0


@dataclass(frozen=True)
class DeclineParams:
    """Merchant payment-health bands (T13), compared against the raw rate."""

    monitor_pct: float = 8.0
    high_pct: float = 12.0


@dataclass(frozen=True)
class SweepParams:
    """Rolling-velocity sweep grid: (window_minutes, minimum_transactions)."""

    configs: tuple[tuple[float, int], ...] = (
        (10, 3),
        (10, 4),
        (10, 5),
        (15, 3),
        (15, 4),
        (20, 4),
    )


@dataclass(frozen=True)
class SkewParams:
    """How per-employee ordered work is split when one employee is hot.

    A sample of ``sample_fraction`` of the rows estimates rows per employee;
    employees estimated above ``rows_per_bucket`` rows are split into time
    buckets sized to hold about ``rows_per_bucket`` rows each (never narrower
    than ``min_bucket_minutes``).  Every other employee stays one group.  The
    bucketing only changes the physical split; results are exact for any
    choice.  The hot-key table has at most N / rows_per_bucket entries.
    """

    sample_fraction: float = 0.01
    rows_per_bucket: int = 2_000_000
    min_bucket_minutes: float = 1.0 / 60  # one second
    seed: int = 17


# Reference defaults.
DEFAULT_RULES = RuleParams()
DEFAULT_BUDGET = BudgetParams()
DEFAULT_DECLINE = DeclineParams()
DEFAULT_SWEEP = SweepParams()
DEFAULT_SKEW = SkewParams()

# Parameters that exercise every branch on the driver's test tables
# (their amounts and time gaps are on a different scale from the reference).
TESTDATA_RULES = RuleParams(
    large_amount=200.0,
    stddev_multiplier=3.0,
    burst_gap_minutes=60.0,
    burst_min_transactions=3,
    international_amount=100.0,
)
TESTDATA_BUDGET = BudgetParams(at_risk_pct=80.0, over_pct=100.0)
TESTDATA_DECLINE = DeclineParams(monitor_pct=18.0, high_pct=22.0)
TESTDATA_SWEEP = SweepParams(configs=((60, 2), (60, 3), (120, 3), (180, 3), (180, 4)))
TESTDATA_ROLLING_WINDOW_MINUTES = 60
TESTDATA_ROLLING_MINIMUM = 3

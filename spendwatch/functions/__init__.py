"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from spendwatch.functions.exprs import (  # noqa: F401
    APPROVED,
    DECLINED,
    epoch_micros,
    is_approved,
    is_declined,
    minutes_to_micros,
    money_avg,
    money_sum,
    money_units,
    month_start,
    round_half_away,
    safe_divide,
    zero_if_null,
)

"""Scalar expression helpers shared by every operator.

Each helper returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from spendwatch.params import STATUS_APPROVED, STATUS_DECLINED

APPROVED = STATUS_APPROVED
DECLINED = STATUS_DECLINED

_MICROS_PER_DAY = 86_400_000_000


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_half_away(col: Column | str, digits: int) -> Column:
    """Round a double half away from zero at ``digits`` decimals.

    Scales, rounds to an integer and scales back, so 1.005 -> 1.0 and
    0.285 -> 0.28 (the binary value decides), as a SQL engine rounding
    doubles does.  Spark's own ``round`` rounds the decimal text instead
    (1.005 -> 1.01).
    """
    scale = float(10**digits)
    return F.round(_c(col) * F.lit(scale), 0) / F.lit(scale)


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator / denominator`` as double, 0.0 when the denominator is 0."""
    return F.coalesce(
        F.try_divide(_c(numerator).cast("double"), _c(denominator).cast("double")),
        F.lit(0.0),
    )


# Money is summed exactly and converted to double once.  A double sum depends
# on the order rows are added in, i.e. on partitioning; near a rounding tie (a
# mean of exactly x.xx5) that decides the rounded report value.
#
# Rule: an amount that is a whole number of micro-units within 2^53 of them
# (any amount with up to 6 decimals below 9.0e9) enters as that integer; the
# integers add up as decimal(38,0), exactly and in any order.  Every other
# amount (finer, larger, infinite, NaN) enters a double sum beside it, as in
# SQL: nothing is rounded or refused, NaN and infinities show in the result,
# and only the last bits of such a sum can depend on the order of rows.
MICRO_UNITS = 1_000_000
_MOST_UNITS = float(2**53)


def money_units(col: Column | str) -> Column:
    """An amount as a whole number of micro-units (bigint); NULL if it is not one."""
    scaled = F.rint(_c(col) * F.lit(float(MICRO_UNITS)))
    whole = (F.abs(scaled) <= F.lit(_MOST_UNITS)) & (scaled / F.lit(float(MICRO_UNITS)) == _c(col))
    return F.when(whole, scaled.cast("long"))


def money_rest(col: Column | str) -> Column:
    """The amount if it is not a whole number of micro-units, else NULL."""
    return F.when(money_units(col).isNull(), _c(col))


def exact_units(col: Column | str) -> Column:
    """``money_units`` in the type they are summed in."""
    return money_units(col).cast("decimal(38,0)")


def money_total(units: Column, rest: Column) -> Column:
    """Total of the summed units and the summed rest, as double; NULL over no amounts."""
    exact = units.cast("double") / F.lit(float(MICRO_UNITS))
    return F.when(rest.isNull(), exact).when(exact.isNull(), rest).otherwise(exact + rest)


def _over(agg: Column, window: WindowSpec | None) -> Column:
    return agg if window is None else agg.over(window)


def money_sum(col: Column | str, window: WindowSpec | None = None) -> Column:
    """Exact sum of an amount column, as double (NULL over no rows); a window
    aggregate when ``window`` is given."""
    return money_total(_over(F.sum(exact_units(col)), window), _over(F.sum(money_rest(col)), window))


def money_avg(col: Column | str, window: WindowSpec | None = None) -> Column:
    """Mean of an amount column from its exact sum (NULLs ignored, as AVG)."""
    return F.try_divide(money_sum(col, window), _over(F.count(_c(col)), window))


# Mean and deviation from exact totals, so that a grouped and a window
# aggregate give the same doubles.
def money_moments(col: str, prefix: str) -> dict[str, Callable[[WindowSpec | None], Column]]:
    """Aggregates behind ``money_statistics``: name -> function of a window spec or None."""
    c = f"`{col}`"
    scaled = f"rint({c} * {float(MICRO_UNITS)!r}D)"
    whole = f"abs({scaled}) <= {_MOST_UNITS!r}D AND {scaled} / {float(MICRO_UNITS)!r}D = {c}"
    units, rest = f"if({whole}, CAST({scaled} AS BIGINT), NULL)", f"if({whole}, NULL, {c})"
    raw = {
        "n": f"count({c})",
        "units": f"sum(CAST({units} AS DECIMAL(38,0)))",
        "squares": f"try_sum(CAST(CAST({units} AS DECIMAL(19,0)) * CAST({units} AS DECIMAL(19,0)) AS DECIMAL(38,0)))",
        "rest": f"sum({rest})",
        "rest_n": f"count({rest})",
        "sd": f"stddev_pop({c})",
    }
    return {f"{prefix}{name}": (lambda w, a=F.expr(agg): _over(a, w)) for name, agg in raw.items()}


def money_statistics(prefix: str) -> tuple[Column, Column]:
    """(mean, population standard deviation) from the columns of ``money_moments``.

    With S units over n amounts, S = n m + r for the whole number m, and
    n var = (Q - m S - r m) - r^2 / n: the bracket is exact in decimal and the
    last term is below n, so equal amounts give exactly 0 and exact ties stay
    exact.  Where amounts are not all whole units, or the squares leave
    decimal(38,0), the double aggregate stands in.
    """
    n, units = F.col(f"{prefix}n"), F.col(f"{prefix}units")
    mean = F.try_divide(money_total(units, F.col(f"{prefix}rest")), n)
    whole = F.expr(f"CAST({prefix}units div nullif({prefix}n, 0) AS DECIMAL(20,0))")
    left = units - whole * n.cast("decimal(18,0)")
    exact = F.try_subtract(
        F.try_subtract(F.col(f"{prefix}squares"), F.try_multiply(whole, units)), F.try_multiply(whole, left.cast("decimal(18,0)"))
    ).cast("double")
    spread = exact - left.cast("double") * left.cast("double") / n
    sd = F.sqrt(F.greatest(spread, F.lit(0.0)) / n) / F.lit(float(MICRO_UNITS))
    double = (F.col(f"{prefix}rest_n") > 0) | exact.isNull()
    return mean, F.when(double, F.col(f"{prefix}sd")).otherwise(sd)


def zero_if_null(col: Column | str) -> Column:
    """An aggregate over no rows gives NULL; report it as 0."""
    return F.coalesce(_c(col), F.lit(0))


def is_approved(status: str = "transaction_status") -> Column:
    return F.col(status) == F.lit(APPROVED)


def is_declined(status: str = "transaction_status") -> Column:
    return F.col(status) == F.lit(DECLINED)


def month_start(ts: Column | str) -> Column:
    """First instant of the month of a zone-less timestamp, as timestamp_ntz.

    Goes through ``date`` so the result does not depend on the session zone.
    """
    return F.trunc(_c(ts).cast("date"), "month").cast("timestamp_ntz")


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a zone-less timestamp (bigint).

    Built from the wall-clock fields, so daylight-saving changes of the
    session zone cannot shift a gap.
    """
    if isinstance(ts, str):
        t = f"CAST(`{ts}` AS TIMESTAMP_NTZ)"
        days = f"CAST(datediff(CAST({t} AS DATE), DATE '1970-01-01') AS BIGINT) * {_MICROS_PER_DAY}L"
        clock = f"(hour({t}) * 3600L + minute({t}) * 60L) * 1000000L"
        return F.expr(f"{days} + {clock} + CAST(extract(SECOND FROM {t}) * 1000000 AS BIGINT)")
    t = _c(ts).cast("timestamp_ntz")
    days = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    clock = (F.hour(t).cast("long") * 3600 + F.minute(t).cast("long") * 60) * 1_000_000
    seconds = (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("long")
    return days * _MICROS_PER_DAY + clock + seconds


def minutes_to_micros(minutes: float) -> int:
    return int(round(minutes * 60_000_000))

"""Per-employee ordered work: burst segmentation (T2-T5, P9) and rolling counts.

Both rules order an employee's approved transactions in time.  A plain
``Window.partitionBy("employee_id")`` puts each employee in one task, so an
employee holding a large share of all rows would serialize the job.  One plan
serves all employees:

* ``hot_key_buckets`` is a sampled aggregate that estimates rows per employee and,
  for employees above ``SkewParams.rows_per_bucket``, picks a time-bucket width that
  gives buckets of about that many rows.  ``hot_widths`` folds it into one
  value (at most N / rows_per_bucket entries) that the rows look up as a scalar
  subquery: no join touches the fact, no job runs while a plan is built.
* Every row gets a segment: 0 if its employee is not hot, else its gap-wide
  bucket or its instant, dealt to ``SALTS`` parts.  The fact is shuffled once,
  by (employee, segment, part), and sorted once; lag, running sums and burst
  sizes are windows there, which are right as they stand for employees that are not hot.
* What a hot employee's windows cannot see is computed on mergeable segments
  (first, last, count), made by a partial aggregate over the hot rows alone, and
  combined by a prefix scan over the segments (bursts), or over time buckets and
  then within them (instants).  The result joins the rows on the partitioning they have;
  without hot employees it is empty, and adaptive execution drops it.
* Bursts (T5, P9 and the fraud scoring) use gap-wide buckets: two rows of a
  ``gap + 1 µs`` bucket are never more than a gap apart, so nothing is ordered inside one.
* Previous timestamps (T2-T4) use instants: a row's predecessor shares its instant
  unless it has the smallest id there, else it is the previous distinct instant.
* Rolling counts are differences of running totals: a row adds one at its
  time and takes it away just after its window, so each count is one
  growing sum over these events, whose cost does not depend on how many rows a
  window holds.  Events are made behind the exchange.  For hot employees the rows are first counted per
  instant, events are dealt to the time bucket they fall in, summed there, and
  shifted by the totals of the buckets before, for any bucket width.

Rows that share a timestamp are ordered by ``transaction_id`` everywhere, so
``lag`` and the running sum agree on peer order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from spendwatch.functions.exprs import epoch_micros, is_approved, minutes_to_micros
from spendwatch.params import DEFAULT_SKEW, RuleParams, SkewParams

KEY = "employee_id"
TS = "transaction_timestamp"
TID = "transaction_id"

_US = "_sw_us"          # epoch microseconds of TS
_BW = "_sw_bucket_us"   # bucket width of a hot employee (NULL: not hot)
_BKT = "_sw_bucket"     # time bucket of a hot employee, non-decreasing in time
_K = "_sw_key"          # the key, and whether it is NULL: plain columns that joins and windows share
_KN = "_sw_no_key"
_SEG = "_sw_segment"    # 0, or the bucket or instant of a hot employee's row
_PART = "_sw_part"      # part of a segment that many rows can share
_PLACE = [_K, _KN, _SEG, _PART]
_NULL_TIME_BUCKET = 2**63 - 1
#: Parts of a hot employee's segment (bits of a bigint).
SALTS = 32
#: Slots of the hot list, so that a look-up does not walk through all of it.
_SLOTS = 256


# --------------------------------------------------------------------------
# Hot-key splitting
# --------------------------------------------------------------------------


def hot_key_buckets(df: DataFrame, skew: SkewParams = DEFAULT_SKEW, key: str = KEY,
                    ts: str = TS) -> DataFrame:
    """``(key, bucket width in µs)`` for keys estimated above ``rows_per_bucket`` rows.

    Estimated from a sample; the estimate only steers the physical split, the
    results do not depend on it.
    """
    f = min(float(skew.sample_fraction), 1.0)
    sampled = df.select(key, epoch_micros(ts).alias(_US))
    if f < 1.0:
        sampled = sampled.sample(fraction=f, seed=skew.seed)
    per_key = sampled.groupBy(key).agg(F.expr(f"struct(count(1) AS n, min({_US}) AS low, max({_US}) AS high)").alias("s"))
    threshold = max(skew.rows_per_bucket * f, 1.0)
    least = max(minutes_to_micros(skew.min_bucket_minutes), 1)
    width = f"CAST(CAST(s.high - s.low + 1 AS DOUBLE) * {threshold!r}D / s.n AS BIGINT)"
    return per_key.where(f"s.n >= {threshold!r}D").selectExpr(f"`{key}`", f"greatest({least}L, coalesce({width}, 1L)) AS {_BW}")


def hot_widths(hot: DataFrame, key: str) -> Column:
    """The hot list (key, width) as one value: maps of the keys dealt to slots, the last for the NULL key."""
    entry = f"struct({_slot(key)} AS slot, {_plain(hot, key)} AS key, {_BW} AS width)"
    slot_map = "map_from_entries(transform(filter(_sw_all, e -> e.slot = s), e -> struct(e.key, e.width)))"
    one = hot.agg(F.expr(f"collect_list({entry})").alias("_sw_all"))
    return one.select(F.expr(f"transform(sequence(0, {_SLOTS}), s -> {slot_map})").alias("_sw_widths")).scalar()


def _slot(key: str) -> str:
    return f"if(`{key}` IS NULL, {_SLOTS}, CAST(pmod(xxhash64(`{key}`), {_SLOTS}L) AS INT))"


def _plain(rows: DataFrame, key: str) -> str:
    """The key without NULL; a slot or flag beside it tells a NULL."""
    return f"coalesce(`{key}`, CAST('0' AS {rows.schema[key].dataType.simpleString()}))"


def _with_width(rows: DataFrame, skew: SkewParams, key: str, ts: str) -> DataFrame:
    """Adds the bucket width of each row's key, NULL unless the key is hot (a NULL key can be)."""
    widths = hot_widths(hot_key_buckets(rows, skew, key, ts), key)
    return rows.select("*", F.get(widths, F.expr(_slot(key)))[F.expr(_plain(rows, key))].alias(_BW))


def _bucket(us: Column, width: Column) -> Column:
    """Number of the time bucket; a NULL time has the last bucket (SQL sorts NULL times last)."""
    return F.when(us.isNull(), F.lit(_NULL_TIME_BUCKET)).otherwise(F.floor((us - F.pmod(us, width)) / width).cast("long"))


def _bucket_sql(us: str, width: str) -> str:
    """``_bucket`` as SQL text."""
    return f"if({us} IS NULL, {_NULL_TIME_BUCKET}L, CAST(floor(({us} - pmod({us}, {width})) / {width}) AS BIGINT))"


def _placed(rows: DataFrame, skew: SkewParams, key: str, ts: str, tid: str, segment: str, alone: bool) -> DataFrame:
    """Adds microseconds, width, the plain key columns, and the row's segment and part.

    ``segment`` is that of a hot employee's row with a time.  Rows without a time follow all others;
    each is a segment of its own if they stand ``alone``, else they share an instant.
    """
    plain = _plain(rows, key)
    rows = _with_width(rows, skew, key, ts).select("*", epoch_micros(ts).alias(_US))
    part = f"CAST(pmod(xxhash64(`{tid}`), {SALTS}L) AS STRING)"
    if alone:
        part = f"if({_US} IS NULL, concat('t', coalesce(CAST(`{tid}` AS STRING), '')), {part})"
    at = f"if({_US} IS NULL, {_NULL_TIME_BUCKET}L, {segment})"
    return rows.selectExpr(
        "*",
        f"{plain} AS {_K}",
        f"`{key}` IS NULL AS {_KN}",
        f"if({_BW} IS NULL, 0L, {at}) AS {_SEG}",
        f"if({_BW} IS NULL, '', {part}) AS {_PART}",
    )


#: Which parts of a segment hold rows, as bits; a segment of a row without a time can be one named part.
_PARTS_HELD = [
    f"bit_or(if({_PART} LIKE 't%', NULL, shiftleft(1L, CAST({_PART} AS INT)))) AS _sw_bits",
    f"max(if({_PART} LIKE 't%', {_PART}, NULL)) AS _sw_named",
]


def _grouped(rows: DataFrame, keys: list[str], aggregates: list[str]) -> DataFrame:
    return rows.groupBy(*map(F.expr, keys)).agg(*map(F.expr, aggregates))


def _met(rows: DataFrame, segments: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with the columns of their segment and part; a plain join on the partitioning that the rows have.

    A segment becomes one row for each of its parts that holds rows.
    """
    salts = f"filter(sequence(0, {SALTS - 1}), k -> getbit(coalesce(_sw_bits, 0L), k) = 1)"
    parts = f"concat(transform({salts}, k -> CAST(k AS STRING)), array_compact(array(_sw_named)))"
    per_part = segments.selectExpr(_K, _KN, _SEG, f"explode({parts}) AS {_PART}", *columns)
    return rows.join(per_part, _PLACE, "left")


# --------------------------------------------------------------------------
# Bursts (gap-based sessionisation), T2-T5
# --------------------------------------------------------------------------

BURST_COLUMNS = ["previous_transaction_timestamp", "starts_new_burst", "burst_id", "transactions_in_burst"]


def _starts(us: str, previous_us: str, gap_us: int) -> str:
    """1 without a timed predecessor or if it is more than the gap before."""
    return f"CASE WHEN {previous_us} IS NULL OR {us} - {previous_us} > {gap_us} THEN 1 ELSE 0 END"


_SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_OF_PLACE = f"PARTITION BY {', '.join(_PLACE)}"


def annotate_bursts(
    approved: DataFrame,
    gap_minutes: float,
    skew: SkewParams = DEFAULT_SKEW,
    key: str = KEY,
    ts: str = TS,
    tid: str = TID,
    key_aggregates: dict[str, Callable[[WindowSpec | None], Column]] | None = None,
    need_previous: bool = True,
    need_sizes: bool = True,
) -> DataFrame:
    """Every input row plus ``previous_transaction_timestamp``,
    ``starts_new_burst``, ``burst_id`` (1-based per key) and
    ``transactions_in_burst``.

    With ``need_previous=False`` the previous timestamp of hot employees is
    NULL: gap-wide buckets need no ordering, so even a hot employee
    packed into one instant is spread over tasks.  With ``need_sizes=False`` sizes are NULL.

    A row starts a new burst when it has no predecessor or its timestamp is
    strictly more than ``gap_minutes`` after the predecessor's.

    ``key_aggregates`` (name -> function of a window spec, or None, returning
    an aggregate over the rows of a key) adds per-key aggregates to every
    row: window aggregates over the rows' partition, or for hot employees a partial aggregate
    joined to their segments.  They must give the same value in both forms (see ``exprs.money_moments``).
    """
    gap_us = minutes_to_micros(gap_minutes)
    aggs = dict(key_aggregates or {})
    segment = _US if need_previous else _bucket_sql(_US, f"{gap_us + 1}L")
    rows = _placed(approved, skew, key, ts, tid, segment, alone=True)
    hot = rows.where(f"{_BW} IS NOT NULL")
    segments = _instants(hot, gap_us, ts, tid, need_sizes) if need_previous else _gap_buckets(hot, gap_us, tid)
    names = ["_sw_hot_first", "_sw_hot_starts", "_sw_hot_burst", *["_sw_hot_previous"] * need_previous, *["_sw_hot_size"] * need_sizes]
    if aggs:
        totals = hot.groupBy(_K, _KN).agg(*[agg(None).alias(f"_sw_hot_{n}") for n, agg in aggs.items()])
        segments = segments.join(totals, [_K, _KN])
        names += [f"_sw_hot_{n}" for n in aggs]

    # windows over the rows' one exchange and one sort
    ordered = f"{_OF_PLACE} ORDER BY {_US} ASC NULLS LAST, `{tid}` ASC NULLS LAST"
    rows = rows.selectExpr(
        "*", f"lag({_US}) OVER ({ordered}) AS _sw_prev_us", f"lag(`{ts}`) OVER ({ordered}) AS _sw_prev", f"row_number() OVER ({ordered}) AS _sw_row"
    )
    rows = rows.selectExpr("*", f"{_starts(_US, '_sw_prev_us', gap_us)} AS _sw_starts")
    running = [f"sum(_sw_starts) OVER ({ordered} {_SO_FAR}) AS _sw_burst"]
    if need_sizes:
        # a burst's rows go from its first row to the next burst's, or to the end
        opening = "if(_sw_starts = 1, _sw_row, NULL)"
        running.append(f"max({opening}) OVER ({ordered} {_SO_FAR}) AS _sw_first")
        running.append(f"lead({opening}, 1) IGNORE NULLS OVER ({ordered}) AS _sw_next")
    rows = rows.selectExpr("*", *running)
    place = Window.partitionBy(*_PLACE)
    whole = [F.expr(f"count(1) OVER ({_OF_PLACE})").alias("_sw_rows")] if need_sizes else []
    whole += [agg(place).alias(f"_sw_cold_{n}") for n, agg in aggs.items()]
    if whole:
        rows = rows.select("*", *whole)
    rows = _met(rows, segments, names)
    opens = f"({_US} <=> _sw_hot_first.us AND `{tid}` <=> _sw_hot_first.tid)"
    previous = f"if({opens}, _sw_hot_previous, `{ts}`)" if need_previous else "NULL"
    size = f"if({_BW} IS NULL, coalesce(_sw_next, _sw_rows + 1) - _sw_first, _sw_hot_size)" if need_sizes else "NULL"
    return rows.selectExpr(
        *[f"`{c}`" for c in approved.columns],
        *[f"if({_BW} IS NULL, _sw_cold_{n}, _sw_hot_{n}) AS {n}" for n in aggs],
        f"if({_BW} IS NULL, _sw_prev, {previous}) AS previous_transaction_timestamp",
        f"CAST(if({_BW} IS NULL, _sw_starts, if({opens}, _sw_hot_starts, 0)) AS INT) AS starts_new_burst",
        f"CAST(if({_BW} IS NULL, _sw_burst, _sw_hot_burst) AS BIGINT) AS burst_id",
        f"CAST({size} AS BIGINT) AS transactions_in_burst",
    )


_OF_KEY = f"PARTITION BY {_K}, {_KN}"


def _gap_buckets(hot: DataFrame, gap_us: int, tid: str) -> DataFrame:
    """Segments of hot employees that are gap-wide buckets, with the burst each belongs to.

    Rows of one bucket are at most a gap apart, so every burst boundary falls between buckets: a scan over
    (first, last, count) of the buckets, at most one per gap of time, numbers the bursts and totals their sizes.
    A row without a time is a bucket of its own after all others, by id, which reproduces the SQL rule for them.
    """
    buckets = _grouped(
        hot,
        [_K, _KN, _SEG, f"if({_US} IS NULL, {_PART}, NULL) AS _sw_alone"],
        [
            f"min({_US}) AS _sw_from", f"max({_US}) AS _sw_to", "count(1) AS _sw_n",
            f"min(struct({_US} AS us, `{tid}` AS tid)) AS _sw_hot_first", *_PARTS_HELD,
        ],
    )
    ordered = f"{_OF_KEY} ORDER BY {_SEG}, _sw_hot_first.tid ASC NULLS LAST"
    buckets = buckets.selectExpr("*", f"lag(_sw_to) OVER ({ordered}) AS _sw_prev_us")
    buckets = buckets.selectExpr("*", f"{_starts('_sw_from', '_sw_prev_us', gap_us)} AS _sw_hot_starts")
    buckets = buckets.selectExpr("*", f"sum(_sw_hot_starts) OVER ({ordered} {_SO_FAR}) AS _sw_hot_burst")
    return buckets.selectExpr("*", f"sum(_sw_n) OVER ({_OF_KEY}, _sw_hot_burst) AS _sw_hot_size")


def _instants(hot: DataFrame, gap_us: int | None, ts: str, tid: str, need_sizes: bool) -> DataFrame:
    """Segments of hot employees that are instants, with the previous instant and, given a gap, their bursts.

    Rows that share an instant become one; a lag runs over the instants of each time bucket, and a scan over the buckets
    (first, last, bursts begun inside) gives each the last instant and the number of bursts before it.
    """
    instants = _grouped(
        hot,
        [_K, _KN, _SEG, _US, f"if({_US} IS NULL AND {_PART} LIKE 't%', {_PART}, NULL) AS _sw_alone"],
        [
            f"min(struct({_US} AS us, `{tid}` AS tid)) AS _sw_hot_first", f"max(`{ts}`) AS _sw_at", "count(1) AS _sw_n",
            f"max({_BW}) AS {_BW}", *_PARTS_HELD,
        ],
    )
    instants = instants.selectExpr("*", f"{_bucket_sql(_US, _BW)} AS {_BKT}")
    within = f"PARTITION BY {_K}, {_KN}, {_BKT} ORDER BY {_SEG}, _sw_hot_first.tid ASC NULLS LAST"
    instants = instants.selectExpr(
        "*", f"lag({_US}) OVER ({within}) AS _sw_prev_us", f"lag(_sw_at) OVER ({within}) AS _sw_prev", f"row_number() OVER ({within}) AS _sw_row"
    )
    gap = "0" if gap_us is None else _starts(_US, "_sw_prev_us", gap_us)
    instants = instants.selectExpr("*", f"if(_sw_row > 1, {gap}, 0) AS _sw_inner")
    ends = _grouped(instants, [_K, _KN, _BKT], [
        f"min({_US}) AS _sw_from", f"max({_US}) AS _sw_to", "max(_sw_at) AS _sw_last", "sum(_sw_inner) AS _sw_begun",
    ])
    across = f"{_OF_KEY} ORDER BY {_BKT}"
    ends = ends.selectExpr("*", f"lag(_sw_last) OVER ({across}) AS _sw_carried", f"lag(_sw_to) OVER ({across}) AS _sw_prev_to")
    ends = ends.selectExpr(_K, _KN, _BKT, "_sw_begun", "_sw_carried", f"{_starts('_sw_from', '_sw_prev_to', gap_us or 0)} AS _sw_opens")
    earlier = f"{across} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    ends = ends.selectExpr(
        _K, _KN, _BKT, "_sw_carried", "_sw_opens", f"coalesce(sum(_sw_begun + _sw_opens) OVER ({earlier}), 0) AS _sw_before"
    )
    met = instants.join(ends, [_K, _KN, _BKT]).selectExpr(
        "*", "if(_sw_row = 1, _sw_opens, _sw_inner) AS _sw_hot_starts", "if(_sw_row = 1, _sw_carried, _sw_prev) AS _sw_hot_previous"
    )
    met = met.selectExpr("*", f"_sw_before + sum(_sw_hot_starts) OVER ({within} {_SO_FAR}) AS _sw_hot_burst")
    if not need_sizes:
        return met
    sizes = _grouped(met, [_K, _KN, "_sw_hot_burst"], ["sum(_sw_n) AS _sw_hot_size"])
    return met.join(sizes, [_K, _KN, "_sw_hot_burst"])


def approved_only(txn: DataFrame) -> DataFrame:
    return txn.where(is_approved())


def previous_transaction_gap(txn: DataFrame, skew: SkewParams = DEFAULT_SKEW) -> DataFrame:
    """Previous approved timestamp of the same employee (no burst work)."""
    base = approved_only(txn).select(TID, KEY, TS)
    rows = _placed(base, skew, KEY, TS, TID, _US, alone=False)
    segments = _instants(rows.where(f"{_BW} IS NOT NULL"), None, TS, TID, need_sizes=False)
    rows = rows.selectExpr("*", f"lag({TS}) OVER ({_OF_PLACE} ORDER BY {_US} ASC NULLS LAST, {TID} ASC NULLS LAST) AS _sw_prev")
    hot = f"if({TID} <=> _sw_hot_first.tid, _sw_hot_previous, {TS})"
    return _met(rows, segments, ["_sw_hot_first", "_sw_hot_previous"]).selectExpr(
        TID, KEY, TS, f"if({_BW} IS NULL, _sw_prev, {hot}) AS previous_transaction_timestamp"
    )


def burst_boundaries(txn: DataFrame, gap_minutes: float, skew: SkewParams = DEFAULT_SKEW) -> DataFrame:
    """T2 plus ``starts_new_burst`` (1 when no predecessor or gap > limit)."""
    base = approved_only(txn).select(TID, KEY, TS)
    return annotate_bursts(base, gap_minutes, skew, need_sizes=False).select(
        TID, KEY, TS, "previous_transaction_timestamp", "starts_new_burst"
    )


def burst_groups(txn: DataFrame, gap_minutes: float, skew: SkewParams = DEFAULT_SKEW) -> DataFrame:
    """T4: T3 plus the running burst number ``burst_id``."""
    base = approved_only(txn).select(TID, KEY, TS)
    return annotate_bursts(base, gap_minutes, skew, need_sizes=False).select(
        TID, KEY, TS, "previous_transaction_timestamp", "starts_new_burst", "burst_id"
    )


def burst_sizes(txn: DataFrame, gap_minutes: float, skew: SkewParams = DEFAULT_SKEW) -> DataFrame:
    """T5: one row per (employee, burst) with its size.

    Aggregated from the annotated rows with a partial (map-side) count.
    """
    base = approved_only(txn).select(TID, KEY, TS)
    return (
        annotate_bursts(base, gap_minutes, skew, need_previous=False, need_sizes=False)
        .groupBy(KEY, "burst_id")
        .agg(F.count(F.lit(1)).alias("transactions_in_burst"))
    )


def velocity_burst_scored(txn: DataFrame, rules: RuleParams = RuleParams(),
                          skew: SkewParams = DEFAULT_SKEW) -> DataFrame:
    """Burst size per approved row and ``predicted_velocity_fraud``.

    Rows without an employee are left out: the SQL form attaches burst sizes
    with an equi-join on employee_id, which no NULL matches.
    """
    base = approved_only(txn).where(F.col(KEY).isNotNull()).select(
        TID, KEY, TS, "amount", "is_fraud", "fraud_type")
    out = annotate_bursts(base, rules.burst_gap_minutes, skew, need_previous=False)
    return out.select(
        TID,
        KEY,
        TS,
        "amount",
        "is_fraud",
        "fraud_type",
        "transactions_in_burst",
        F.when(F.col("transactions_in_burst") >= rules.burst_min_transactions, 1)
        .otherwise(0)
        .alias("predicted_velocity_fraud"),
    )


# --------------------------------------------------------------------------
# Rolling RANGE counts, T22 / T23
# --------------------------------------------------------------------------


def window_count_column(window_minutes: float) -> str:
    """Column name of a window width; fractions of a minute keep their digits."""
    m = float(window_minutes)
    return f"transactions_in_{int(m) if m.is_integer() else str(m).replace('.', '_')}_minutes"


def _rolling_events(rows: DataFrame, widths: Sequence[int], n: str, keep: list[str], leaving: str = "true") -> DataFrame:
    """Each row as events: at its time ``n`` is added for all widths; just after its window ``n`` is taken away for one.

    ``_sw_at`` is the event's time, ``_sw_after`` 1 for those that follow all rows of their time, ``_sw_d<i>`` the change for width i.
    """
    def event(at: str, after: int, which: int | None) -> str:
        change = [f"CAST({n if which is None else f'-{n}' if which == i else 0} AS BIGINT) AS _sw_d{i}" for i in range(len(widths))]
        return f"struct({at} AS _sw_at, {after} AS _sw_after, {', '.join(change)})"

    events = [event(_US, 0, None)] + [event(f"{_US} + {w}L", 1, i) for i, w in enumerate(widths)]
    # a row without a time has no window to leave, and a hot employee's rows are counted elsewhere
    made = f"explode(if({_US} IS NOT NULL AND {leaving}, array({', '.join(events)}), array({events[0]}))) AS _sw_e"
    return rows.selectExpr(*keep, made).selectExpr(*keep, "_sw_e.*")


def with_rolling_counts(
    approved: DataFrame,
    windows_minutes: Sequence[float],
    skew: SkewParams = DEFAULT_SKEW,
    key: str = KEY,
    ts: str = TS,
    tid: str = TID,
) -> DataFrame:
    """Adds one count column per distinct width: rows of the same key with a
    timestamp in ``[ts - window, ts]``, both ends inclusive, the row itself and
    its timestamp peers included; rows without a time count each other.

    A count is a running total over events (see ``_rolling_events``), so it costs
    the same however many rows a window holds.  All widths share one
    exchange and one sort.
    """
    widths = sorted({minutes_to_micros(m): window_count_column(m) for m in windows_minutes}.items())
    if widths[0][0] < 0:
        raise ValueError("a window cannot be negative")
    micros, names = [w for w, _ in widths], [c for _, c in widths]
    many = range(len(names))

    def totals(events: DataFrame, by: list[str]) -> DataFrame:
        # NULL times are a partition of their own
        w = f"PARTITION BY {', '.join(by)}, _sw_at IS NULL ORDER BY _sw_at, _sw_after RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
        return events.selectExpr("*", *[f"sum(_sw_d{i}) OVER ({w}) AS _sw_c{i}" for i in many]).where("_sw_after = 0")

    rows = _placed(approved, skew, key, ts, tid, _US, alone=False)
    whole = [f"`{c}`" for c in approved.columns]
    # one exchange of the rows; their events are made behind it
    plain = totals(_rolling_events(rows.repartition(*_PLACE), micros, "1", [*whole, *_PLACE, _BW], f"{_BW} IS NULL"), _PLACE)

    # hot keys: instants, dealt to buckets by event time
    carry = [_K, _KN, _SEG, _US, _BW]
    instants = _grouped(rows.where(f"{_BW} IS NOT NULL"), carry, ["count(1) AS _sw_n", *_PARTS_HELD])
    carry += ["_sw_bits", "_sw_named"]
    dealt = _rolling_events(instants, micros, "_sw_n", carry).selectExpr("*", f"{_bucket_sql('_sw_at', _BW)} AS {_BKT}")
    local = totals(dealt, [_K, _KN, _BKT])
    before = f"{_OF_KEY} ORDER BY {_BKT} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    carried = _grouped(dealt, [_K, _KN, _BKT], [f"sum(_sw_d{i}) AS _sw_s{i}" for i in many])
    carried = carried.selectExpr(_K, _KN, _BKT, *[f"coalesce(sum(_sw_s{i}) OVER ({before}), 0) AS _sw_b{i}" for i in many])
    # all that came before rows without a time has left: only they count each other
    shifted = [f"_sw_c{i} + if({_US} IS NULL, 0, _sw_b{i}) AS _sw_h{i}" for i in many]
    counted = local.join(carried, [_K, _KN, _BKT]).selectExpr(*carry, *shifted)
    met = _met(plain, counted, [f"_sw_h{i}" for i in many])
    return met.selectExpr(*whole, *[f"if({_BW} IS NULL, _sw_c{i}, _sw_h{i}) AS {c}" for i, c in enumerate(names)])


def rolling_transaction_count(txn: DataFrame, window_minutes: float,
                              skew: SkewParams = DEFAULT_SKEW) -> DataFrame:
    """``transactions_in_window`` per approved row."""
    base = approved_only(txn).select(TID, KEY, TS, "is_fraud", "fraud_type")
    out = with_rolling_counts(base, [window_minutes], skew)
    return out.select(
        TID, KEY, TS, "is_fraud", "fraud_type",
        F.col(window_count_column(window_minutes)).alias("transactions_in_window"),
    )


def rolling_velocity_rule(window_minutes: float, minimum_transactions: int) -> Column:
    """T23's condition on the column of ``with_rolling_counts``."""
    return F.col(window_count_column(window_minutes)) >= minimum_transactions


def rolling_velocity_flags(txn: DataFrame, window_minutes: float, minimum_transactions: int,
                           skew: SkewParams = DEFAULT_SKEW) -> DataFrame:
    """T22 plus ``predicted_velocity_fraud`` (count >= minimum)."""
    base = approved_only(txn).select(TID, KEY, TS, "is_fraud", "fraud_type")
    out = with_rolling_counts(base, [window_minutes], skew)
    return out.select(
        TID, KEY, TS, "is_fraud", "fraud_type",
        F.col(window_count_column(window_minutes)).alias("transactions_in_window"),
        F.when(rolling_velocity_rule(window_minutes, minimum_transactions), 1).otherwise(0).alias("predicted_velocity_fraud"),
    )

"""Bursts (T2-T5, P9) and rolling counts (T22, T23): boundary fixtures, plus
a property test of the hot-key split paths against a brute-force reference."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from spendwatch.operators import velocity as V
from spendwatch.params import RuleParams, SkewParams

from .helpers import at, brute_bursts, brute_rolling, txn_df

UNSPLIT = SkewParams()
# Every employee is "hot": 5-minute buckets, so bursts cross many buckets.
SPLIT = SkewParams(sample_fraction=1.0, rows_per_bucket=1, min_bucket_minutes=5)
SKEWS = [UNSPLIT, SPLIT]


def _sizes(df):
    return {r["transaction_id"]: r["transactions_in_burst"] for r in df.collect()}


@pytest.mark.parametrize("skew", SKEWS)
def test_gap_exactly_ten_minutes_stays_in_burst(spark, skew):
    # 00:00, 00:10:00 (gap == 10 min, same burst), 00:20:00.000001 (gap > 10 min).
    df = txn_df(spark, [{"transaction_timestamp": at(0)}, {"transaction_timestamp": at(10)},
                        {"transaction_timestamp": at(20, 1)}])
    out = {r["transaction_id"]: r for r in V.burst_groups(df, 10, skew).collect()}
    assert [out[i]["starts_new_burst"] for i in (1, 2, 3)] == [1, 0, 1]
    assert [out[i]["burst_id"] for i in (1, 2, 3)] == [1, 1, 2]
    assert _sizes(V.velocity_burst_scored(df, RuleParams(), skew)) == {1: 2, 2: 2, 3: 1}


@pytest.mark.parametrize("skew", SKEWS)
def test_attack_burst_and_rolling(spark, skew):
    df = txn_df(spark, [{"transaction_timestamp": at(m)} for m in (0, 2, 4, 7)])
    scored = {r["transaction_id"]: r for r in V.velocity_burst_scored(df, RuleParams(), skew).collect()}
    assert all(r["transactions_in_burst"] == 4 and r["predicted_velocity_fraud"] == 1 for r in scored.values())
    flags = V.rolling_velocity_flags(df, 10, 3, skew).collect()
    assert sum(r["predicted_velocity_fraud"] for r in flags) == 2


@pytest.mark.parametrize("skew", SKEWS)
def test_chain_is_one_burst_but_no_rolling_alert(spark, skew):
    df = txn_df(spark, [{"transaction_timestamp": at(9 * i)} for i in range(5)])
    assert set(_sizes(V.velocity_burst_scored(df, RuleParams(), skew)).values()) == {5}
    flags = V.rolling_velocity_flags(df, 10, 3, skew).collect()
    assert sum(r["predicted_velocity_fraud"] for r in flags) == 0


@pytest.mark.parametrize("skew", SKEWS)
def test_tied_timestamps_are_peers(spark, skew):
    df = txn_df(spark, [{"transaction_timestamp": at(0)} for _ in range(3)])
    assert set(_sizes(V.velocity_burst_scored(df, RuleParams(), skew)).values()) == {3}
    counts = [r["transactions_in_window"] for r in V.rolling_transaction_count(df, 10, skew).collect()]
    assert counts == [3, 3, 3]
    groups = sorted((r["transaction_id"], r["starts_new_burst"]) for r in V.burst_groups(df, 10, skew).collect())
    assert groups == [(1, 1), (2, 0), (3, 0)]  # ties ordered by transaction_id


@pytest.mark.parametrize("skew", SKEWS)
def test_declined_rows_are_invisible(spark, skew):
    df = txn_df(spark, [
        {"transaction_timestamp": at(0)},
        {"transaction_timestamp": at(4), "transaction_status": "declined"},
        {"transaction_timestamp": at(8)},
    ])
    assert _sizes(V.velocity_burst_scored(df, RuleParams(), skew)) == {1: 2, 3: 2}


@pytest.mark.parametrize("skew", SKEWS)
def test_single_row(spark, skew):
    df = txn_df(spark, [{"transaction_timestamp": at(0)}])
    row = V.burst_groups(df, 10, skew).collect()[0]
    assert (row["previous_transaction_timestamp"], row["starts_new_burst"], row["burst_id"]) == (None, 1, 1)


def test_burst_sizes_table(spark):
    df = txn_df(spark, [{"transaction_timestamp": at(m)} for m in (0, 5, 30, 31, 32, 100)])
    got = sorted((r["burst_id"], r["transactions_in_burst"]) for r in V.burst_sizes(df, 10, SPLIT).collect())
    assert got == [(1, 2), (2, 3), (3, 1)]


_minutes = st.lists(st.integers(min_value=0, max_value=240), min_size=1, max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    emp_a=_minutes,
    emp_b=_minutes,
    gap=st.sampled_from([3, 10, 25]),
    width=st.sampled_from([5, 15]),
    bucket=st.sampled_from([1, 7, 60]),
)
def test_split_paths_match_brute_force(spark, emp_a, emp_b, gap, width, bucket):
    specs = [{"employee_id": 1, "transaction_timestamp": at(m)} for m in emp_a]
    specs += [{"employee_id": 2, "transaction_timestamp": at(m)} for m in emp_b]
    df = txn_df(spark, specs)
    rows = [(i, s["employee_id"], s["transaction_timestamp"]) for i, s in enumerate(specs, start=1)]
    skew = SkewParams(sample_fraction=1.0, rows_per_bucket=1, min_bucket_minutes=bucket)

    want = brute_bursts(rows, gap)
    got = {
        r["transaction_id"]: (r["previous_transaction_timestamp"], r["starts_new_burst"], r["burst_id"])
        for r in V.burst_groups(df, gap, skew).collect()
    }
    assert got == {k: v[:3] for k, v in want.items()}
    sizes = _sizes(V.velocity_burst_scored(df, RuleParams(burst_gap_minutes=gap), skew))
    assert sizes == {k: v[3] for k, v in want.items()}

    counts = {r["transaction_id"]: r["transactions_in_window"]
              for r in V.rolling_transaction_count(df, width, skew).collect()}
    assert counts == brute_rolling(rows, width)


def test_hot_key_table_is_bounded(spark):
    # 40 rows for employee 1, 2 rows for employee 2: only employee 1 is hot.
    specs = [{"employee_id": 1, "transaction_timestamp": at(i)} for i in range(40)]
    specs += [{"employee_id": 2, "transaction_timestamp": at(i)} for i in range(2)]
    hot = V.hot_key_buckets(txn_df(spark, specs), SkewParams(sample_fraction=1.0, rows_per_bucket=10,
                                                              min_bucket_minutes=1)).collect()
    assert [r["employee_id"] for r in hot] == [1]
    # about 10 rows per bucket: 40 minutes of data / 4 buckets
    assert 9 * 60_000_000 <= hot[0][V._BW] <= 11 * 60_000_000


def test_building_a_plan_runs_no_job(spark):
    """Hot-key detection is part of the plan."""
    df = txn_df(spark, [{"transaction_timestamp": at(i)} for i in range(5)])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "building plans")
    try:
        V.burst_groups(df, 10, SPLIT)
        V.rolling_velocity_flags(df, 10, 3, SPLIT)
        V.previous_transaction_gap(df, SPLIT)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(tracker.getJobIdsForGroup("build")) == []


def test_hot_null_employee_is_split_exactly(spark):
    """Rows without an employee are one group; a hot one gets several buckets and keeps every row."""
    from pyspark.sql import functions as F

    specs = [{"employee_id": None, "transaction_timestamp": at((i * 7) % 90)} for i in range(60)]
    specs += [{"employee_id": 1, "transaction_timestamp": at(i)} for i in range(3)]
    df = txn_df(spark, specs)
    rows = [(i, s["employee_id"], s["transaction_timestamp"]) for i, s in enumerate(specs, start=1)]
    skew = SkewParams(sample_fraction=1.0, rows_per_bucket=10, min_bucket_minutes=1)
    tagged = V._with_width(V.approved_only(df), skew, "employee_id", "transaction_timestamp")
    buckets = tagged.where(F.col(V._BW).isNotNull()).select(
        "employee_id", V._bucket(V.epoch_micros("transaction_timestamp"), F.col(V._BW)).alias("b")).distinct().collect()
    assert len(buckets) >= 4 and {r["employee_id"] for r in buckets} == {None}
    want = brute_bursts(rows, 10)
    got = {r["transaction_id"]: (r["previous_transaction_timestamp"], r["starts_new_burst"], r["burst_id"])
           for r in V.burst_groups(df, 10, skew).collect()}
    assert got == {k: v[:3] for k, v in want.items()}
    gaps = {r["transaction_id"]: r["previous_transaction_timestamp"] for r in V.previous_transaction_gap(df, skew).collect()}
    assert gaps == {k: v[0] for k, v in want.items()}
    counts = {r["transaction_id"]: r["transactions_in_window"] for r in V.rolling_transaction_count(df, 15, skew).collect()}
    assert counts == brute_rolling(rows, 15)


@pytest.mark.parametrize("skew", SKEWS)
def test_fractional_windows(spark, skew):
    specs = [{"transaction_timestamp": at(0.5 * i)} for i in range(8)]
    df = txn_df(spark, specs)
    rows = [(i, 1, s["transaction_timestamp"]) for i, s in enumerate(specs, start=1)]
    out = V.with_rolling_counts(V.approved_only(df), [2.5, 0.5, 2], skew).collect()
    assert V.window_count_column(2.5) == "transactions_in_2_5_minutes"
    for width in (2.5, 0.5, 2):
        assert {r["transaction_id"]: r[V.window_count_column(width)] for r in out} == brute_rolling(rows, width)


def test_rolling_counts_use_no_sliding_frame(spark):
    from spendwatch.plans.inspect import physical_plan

    df = txn_df(spark, [{"transaction_timestamp": at(i)} for i in range(5)])
    text = physical_plan(V.rolling_transaction_count(df, 10), "simple")
    assert "RangeFrame, -" not in text and "unboundedpreceding$(), currentrow$()" in text


def test_hot_employee_is_spread_over_partitions(spark):
    """One employee with over a third of all rows: with splitting, no
    partition of the (employee, bucket) shuffle holds most of the data."""
    from pyspark.sql import functions as F

    n = 30_000
    base = spark.range(n).select(
        F.col("id").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 500 + 2).cast("long").alias("employee_id"),
        (F.lit(at(0)).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)")))
        .alias("transaction_timestamp"),
    )
    skew = SkewParams(sample_fraction=0.1, rows_per_bucket=500, min_bucket_minutes=1)
    assert [r["employee_id"] for r in V.hot_key_buckets(base, skew).collect()] == [1]
    bucketed = V._with_width(base, skew, "employee_id", "transaction_timestamp").withColumn(
        "b", F.coalesce(V._bucket(V.epoch_micros("transaction_timestamp"), F.col(V._BW)), F.lit(0)))
    sizes = (bucketed.repartition(8, "employee_id", "b")
             .groupBy(F.spark_partition_id().alias("p")).count().collect())
    assert max(r["count"] for r in sizes) < 0.3 * n  # unsplit, one partition would hold >= n / 3
    # and the bursts are still exact
    rows = [(r[0], r[1], r[2]) for r in base.where("employee_id = 1 or employee_id = 2").collect()]
    sub = base.where("employee_id = 1 or employee_id = 2").select(
        "*", F.lit(1).alias("company_id"), F.lit(1).cast("long").alias("merchant_id"), F.lit(1.0).alias("amount"),
        F.lit("approved").alias("transaction_status"), F.lit(None).cast("string").alias("decline_reason"),
        F.lit(False).alias("is_international"), F.lit("US").alias("merchant_country"), F.lit(0).alias("is_fraud"),
        F.lit("none").alias("fraud_type"))
    small = SkewParams(sample_fraction=1.0, rows_per_bucket=100, min_bucket_minutes=1)
    got = _sizes(V.velocity_burst_scored(sub, RuleParams(burst_gap_minutes=0.05), small))
    want = {k: v[3] for k, v in brute_bursts(rows, 0.05).items()}
    assert got == want


@pytest.mark.parametrize("skew", SKEWS)
def test_null_timestamps_match_sql_semantics(spark, skew):
    minutes = [0, 3, None, 7, None, 30, 31, None]
    specs = [{"employee_id": 1, "transaction_timestamp": None if m is None else at(m)} for m in minutes]
    specs += [{"employee_id": 2, "transaction_timestamp": at(m)} for m in (1, 2)]
    df = txn_df(spark, specs)
    rows = [(i, s["employee_id"], s["transaction_timestamp"]) for i, s in enumerate(specs, start=1)]
    want_b, want_r = brute_bursts(rows, 10), brute_rolling(rows, 15)
    got = {r["transaction_id"]: (r["previous_transaction_timestamp"], r["starts_new_burst"], r["burst_id"])
           for r in V.burst_groups(df, 10, skew).collect()}
    assert got == {k: v[:3] for k, v in want_b.items()}
    assert _sizes(V.velocity_burst_scored(df, RuleParams(), skew)) == {k: v[3] for k, v in want_b.items()}
    counts = {r["transaction_id"]: r["transactions_in_window"] for r in V.rolling_transaction_count(df, 15, skew).collect()}
    assert counts == want_r  # no row is lost, NULL times count each other


_nullable_minutes = st.lists(st.one_of(st.none(), st.integers(min_value=0, max_value=180)), min_size=1, max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(emp_a=_nullable_minutes, emp_b=_nullable_minutes, gap=st.sampled_from([5, 20]),
       width=st.sampled_from([10, 30]), bucket=st.sampled_from([1, 15]))
def test_split_paths_match_sql_with_null_times(spark, emp_a, emp_b, gap, width, bucket):
    specs = [{"employee_id": 1, "transaction_timestamp": None if m is None else at(m)} for m in emp_a]
    specs += [{"employee_id": 2, "transaction_timestamp": None if m is None else at(m)} for m in emp_b]
    df = txn_df(spark, specs)
    rows = [(i, s["employee_id"], s["transaction_timestamp"]) for i, s in enumerate(specs, start=1)]
    want_b, want_r = brute_bursts(rows, gap), brute_rolling(rows, width)
    for skew in (UNSPLIT, SkewParams(sample_fraction=1.0, rows_per_bucket=1, min_bucket_minutes=bucket)):
        got = {r["transaction_id"]: (r["previous_transaction_timestamp"], r["starts_new_burst"], r["burst_id"])
               for r in V.burst_groups(df, gap, skew).collect()}
        assert got == {k: v[:3] for k, v in want_b.items()}
        assert _sizes(V.velocity_burst_scored(df, RuleParams(burst_gap_minutes=gap), skew)) == {
            k: v[3] for k, v in want_b.items()}
        counts = {r["transaction_id"]: r["transactions_in_window"]
                  for r in V.rolling_transaction_count(df, width, skew).collect()}
        assert counts == want_r


@pytest.mark.parametrize("skew", SKEWS)
def test_null_employee_rows(spark, skew):
    from spendwatch.operators import rules as R

    specs = [{"employee_id": None, "transaction_timestamp": at(m)} for m in (0, 4, 8)]
    specs += [{"employee_id": 1, "transaction_timestamp": at(m)} for m in (0, 50)]
    df = txn_df(spark, specs)
    groups = {r["transaction_id"]: (r["starts_new_burst"], r["burst_id"]) for r in V.burst_groups(df, 10, skew).collect()}
    assert groups == {1: (1, 1), 2: (0, 1), 3: (0, 1), 4: (1, 1), 5: (1, 2)}  # NULL employees: one group
    sizes = sorted((r["employee_id"], r["burst_id"], r["transactions_in_burst"])
                   for r in V.burst_sizes(df, 10, skew).collect() if r["employee_id"] is not None)
    assert sizes == [(1, 1, 1), (1, 2, 1)]
    assert V.burst_sizes(df, 10, skew).where("employee_id is null").collect()[0]["transactions_in_burst"] == 3
    assert set(_sizes(V.velocity_burst_scored(df, RuleParams(), skew))) == {4, 5}  # dropped, as by the SQL join
    assert {r["transaction_id"] for r in R.fraud_scored_transactions(df, skew=skew).collect()} == {4, 5}


def test_hot_employee_packed_into_one_instant(spark):
    """Time buckets cannot split one instant; the gap-wide bucket plan of the
    burst products needs no order inside a bucket, so it still gives exact
    sizes (and the join back is what AQE can split or broadcast)."""
    specs = [{"employee_id": 1, "transaction_timestamp": at(0)} for _ in range(40)]
    specs += [{"employee_id": 1, "transaction_timestamp": at(m)} for m in (5, 30)]
    specs += [{"employee_id": 2, "transaction_timestamp": at(m)} for m in (0, 1)]
    df = txn_df(spark, specs)
    rows = [(i, s["employee_id"], s["transaction_timestamp"]) for i, s in enumerate(specs, start=1)]
    skew = SkewParams(sample_fraction=1.0, rows_per_bucket=5, min_bucket_minutes=1)
    want = brute_bursts(rows, 10)
    assert _sizes(V.velocity_burst_scored(df, RuleParams(), skew)) == {k: v[3] for k, v in want.items()}
    assert sorted(r["transactions_in_burst"] for r in V.burst_sizes(df, 10, skew).collect()) == [1, 2, 41]
    groups = {r["transaction_id"]: (r["previous_transaction_timestamp"], r["starts_new_burst"], r["burst_id"])
              for r in V.burst_groups(df, 10, skew).collect()}
    assert groups == {k: v[:3] for k, v in want.items()}
    # rolling counts run on per-instant counts, so the instant is one row there
    counts = {r["transaction_id"]: r["transactions_in_window"]
              for r in V.rolling_transaction_count(df, 10, skew).collect()}
    assert counts == brute_rolling(rows, 10)

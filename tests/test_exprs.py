"""Expression helpers: rounding parity, safe division, month start, epoch micros."""

from datetime import datetime

from pyspark.sql import functions as F

from spendwatch.functions.exprs import epoch_micros, month_start, round_half_away, safe_divide


def test_round_half_away_follows_binary_value(spark):
    df = spark.createDataFrame([(1.005,), (0.285,), (2.675,), (8.125,), (-2.675,), (12.5,)], "x double")
    got = [r[0] for r in df.select(round_half_away("x", 2)).collect()]
    assert got == [1.0, 0.28, 2.68, 8.13, -2.68, 12.5]
    assert [r[0] for r in df.select(round_half_away("x", 0)).collect()][-1] == 13.0


def test_round_matches_duckdb(spark):
    import duckdb

    vals = [i / 1000 for i in range(0, 20000, 5)] + [1.005, 0.285, 2.675, 8.125, 1234.565]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    ours = [r[0] for r in df.select(round_half_away("x", 2)).collect()]
    con = duckdb.connect()
    theirs = [con.execute("SELECT ROUND(?::DOUBLE, 2)", [v]).fetchone()[0] for v in vals]
    assert ours == theirs


def test_safe_divide(spark):
    row = spark.range(1).select(safe_divide(F.lit(1), F.lit(0)).alias("a"),
                                safe_divide(F.lit(3), F.lit(4)).alias("b")).collect()[0]
    assert (row["a"], row["b"]) == (0.0, 0.75)


def test_month_start_and_epoch_micros_ignore_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(datetime(2024, 3, 10, 3, 30, 0, 123456),)], "ts timestamp_ntz")
        row = df.select(month_start("ts").alias("m"), epoch_micros("ts").alias("us")).collect()[0]
        assert row["m"] == datetime(2024, 3, 1)
        expected = int((datetime(2024, 3, 10, 3, 30, 0, 123456) - datetime(1970, 1, 1)).total_seconds()) * 1_000_000
        assert row["us"] == expected + 123456
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)

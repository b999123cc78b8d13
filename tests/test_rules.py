"""Fraud rules, score and levels (T1, T7a-d, T8, T9, P3, P5) on inline rows."""

from spendwatch.operators import rules as R
from spendwatch.params import RuleParams, SkewParams

from .helpers import at, employees_df, merchants_df, txn_df

P = RuleParams()


def _scored(spark, specs, rules=P):
    return {r["transaction_id"]: r for r in R.fraud_scored_transactions(txn_df(spark, specs), rules).collect()}


def test_nine_rows_outlier_is_not_unusual_but_large(spark):
    # z of the outlier is at most sqrt(n - 1) = 2.83 < 3 for n = 9.
    specs = [{"amount": 10.0, "transaction_timestamp": at(60 * i)} for i in range(8)]
    specs.append({"amount": 10_000.0, "transaction_timestamp": at(60 * 9)})
    out = _scored(spark, specs)
    assert out[9]["unusual_amount_flag"] == 0
    assert out[9]["large_transaction_flag"] == 1
    assert sum(r["unusual_amount_flag"] for r in out.values()) == 0


def test_unusual_amount_on_larger_group(spark):
    specs = [{"amount": 10.0 + (i % 2), "transaction_timestamp": at(60 * i)} for i in range(30)]
    specs.append({"amount": 500.0, "transaction_timestamp": at(60 * 31)})
    out = _scored(spark, specs)
    assert out[31]["unusual_amount_flag"] == 1
    assert sum(r["unusual_amount_flag"] for r in out.values()) == 1


def test_single_row_stddev_zero(spark):
    out = _scored(spark, [{"amount": 123.0}])
    assert out[1]["employee_amount_stddev"] == 0.0 and out[1]["unusual_amount_flag"] == 0


def test_thresholds_and_null_international(spark):
    specs = [
        {"amount": 4999.99, "transaction_timestamp": at(0)},
        {"amount": 5000.0, "transaction_timestamp": at(100)},
        {"amount": 999.99, "is_international": True, "transaction_timestamp": at(200)},
        {"amount": 1000.0, "is_international": True, "transaction_timestamp": at(300)},
        {"amount": 2000.0, "is_international": None, "transaction_timestamp": at(400)},
    ]
    out = _scored(spark, specs)
    assert [out[i]["large_transaction_flag"] for i in (1, 2)] == [0, 1]
    assert [out[i]["international_risk_flag"] for i in (3, 4, 5)] == [0, 1, 0]


def test_score_levels_and_alert_filter(spark):
    specs = [
        {"amount": 6000.0, "is_international": True, "transaction_timestamp": at(0)},   # large + intl
        {"amount": 6000.0, "transaction_timestamp": at(100)},                          # large
        {"amount": 50.0, "transaction_timestamp": at(200)},                            # nothing
        {"amount": 20.0, "transaction_timestamp": at(300), "transaction_status": "declined"},
    ]
    txn = txn_df(spark, specs)
    emp = employees_df(spark, [(1, 1, "Ann", "Sales", 5000)])
    mer = merchants_df(spark, [(1, "Shop", "Meals", "US")])
    scored = {r["transaction_id"]: r for r in R.scored_with_dimensions(txn, emp, mer, P).collect()}
    assert {k: v["fraud_risk_level"] for k, v in scored.items()} == {1: "high_risk", 2: "medium_risk", 3: "low_risk"}
    alerts = R.fraud_alerts(txn, emp, mer, P).collect()
    assert [r["transaction_id"] for r in alerts] == [1, 2]
    assert alerts[0]["fraud_risk_score"] == 2 and alerts[0]["employee_name"] == "Ann"
    assert list(alerts[0].asDict()) == R.FRAUD_ALERT_COLUMNS
    pred = {k: v["predicted_fraud"] for k, v in _scored(spark, specs).items()}
    assert pred == {1: 1, 2: 1, 3: 0}


def test_alerts_drop_rows_without_dimension_match(spark):
    specs = [{"amount": 6000.0, "employee_id": 1}, {"amount": 6000.0, "employee_id": 2, "transaction_timestamp": at(5)}]
    txn = txn_df(spark, specs)
    emp = employees_df(spark, [(1, 1, "Ann", "Sales", 5000)])
    mer = merchants_df(spark, [(1, "Shop", "Meals", "US")])
    assert [r["transaction_id"] for r in R.fraud_alerts(txn, emp, mer, P).collect()] == [1]


def test_statistics_are_population_and_whole_sample(spark):
    specs = [{"amount": a, "transaction_timestamp": at(i)} for i, a in enumerate([2.0, 4.0, 4.0, 4.0, 5.0, 5.0, 7.0, 9.0])]
    specs.append({"amount": 1000.0, "transaction_status": "declined", "transaction_timestamp": at(50)})
    row = R.employee_transaction_stats(txn_df(spark, specs)).collect()[0]
    assert row["employee_avg_amount"] == 5.0 and row["employee_amount_stddev"] == 2.0


def test_split_and_unsplit_scoring_agree(spark):
    specs = [{"employee_id": 1 + i % 3, "amount": float(5 + (i * 37) % 300),
              "transaction_timestamp": at((i * 13) % 400)} for i in range(120)]
    txn = txn_df(spark, specs)
    split = SkewParams(sample_fraction=1.0, rows_per_bucket=4, min_bucket_minutes=3)
    a = sorted(R.fraud_scored_transactions(txn, P).collect())
    assert a == sorted(R.fraud_scored_transactions(txn, P, split).collect())  # every column, unrounded


def test_exact_three_sigma_rows_agree_in_both_plans(spark):
    """Nine equal amounts and one larger are exactly three deviations apart: a strict limit flags none, in either plan."""
    specs = [{"employee_id": e, "amount": round(10.1 * e, 2) if i < 9 else round(110.1 * e + 7, 2), "transaction_timestamp": at(100 * i + e)}
             for e in range(1, 41) for i in range(10)]
    txn = txn_df(spark, specs)
    plain = sorted(R.fraud_scored_transactions(txn, P).collect())
    split = SkewParams(sample_fraction=1.0, rows_per_bucket=2, min_bucket_minutes=3)
    assert plain == sorted(R.fraud_scored_transactions(txn, P, split).collect())
    table = {r["employee_id"]: (r["employee_avg_amount"], r["employee_amount_stddev"])
             for r in R.employee_transaction_stats(txn).collect()}
    assert {(r["employee_id"], (r["employee_avg_amount"], r["employee_amount_stddev"])) for r in plain} == set(table.items())


def test_amounts_that_are_not_whole_micro_units(spark):
    """Finer and larger amounts are summed as doubles: nothing is cut or refused, and NaN shows."""
    from spendwatch.operators import reports as Rp

    def total(*amounts):
        df = txn_df(spark, [{"amount": a} for a in amounts])
        return Rp.monthly_employee_spend(df).collect()[0]["monthly_spend"]

    assert total(1e-7) == 1e-7
    assert total(9.3e12) == 9.3e12
    assert total(9.3e12, 0.25) == 9.3e12 + 0.25
    assert total(float("inf"), 1.0) == float("inf")
    nan = total(float("nan"), 1.0)
    assert nan != nan
    stats = R.employee_transaction_stats(txn_df(spark, [{"amount": a} for a in (1e-7, 3e-7)])).collect()[0]
    assert abs(stats["employee_amount_stddev"] - 1e-7) < 1e-12


def test_split_and_unsplit_alerts_agree(spark):
    specs = [{"employee_id": 1 + i % 4, "merchant_id": 1 + i % 2, "amount": float(5 + (i * 53) % 7000),
              "is_international": i % 5 == 0, "transaction_timestamp": at((i * 11) % 500)} for i in range(160)]
    txn = txn_df(spark, specs)
    emp = employees_df(spark, [(e, 1, f"E{e}", "Ops", 1000) for e in (1, 2, 3)])  # employee 4 unknown
    mer = merchants_df(spark, [(1, "Shop", "Meals", "US"), (2, "Air", "Travel", "CA")])
    split = SkewParams(sample_fraction=1.0, rows_per_bucket=5, min_bucket_minutes=2)

    def rows(skew):
        return sorted(R.fraud_alerts(txn, emp, mer, P, skew).collect())

    plain = rows(SkewParams())
    assert plain and plain == rows(split)
    assert all(r[2] != 4 for r in plain)  # inner join with employees

"""Denormalisation (P15), label distribution (P13), eligible employees."""

from pyspark.sql import functions as F

from spendwatch.operators import enrich

from .helpers import employees_df, merchants_df


def _raw(spark, rows):
    schema = ("transaction_id long, employee_id long, merchant_id long, transaction_timestamp timestamp_ntz, "
              "amount double, transaction_status string, decline_reason string, is_fraud int, fraud_type string")
    return spark.createDataFrame(rows, schema)


def test_enrich_transactions(spark):
    from datetime import datetime

    t = datetime(2025, 1, 1)
    raw = _raw(spark, [
        (1, 10, 100, t, 5.0, "approved", "card_expired", 0, "none"),
        (2, 10, 200, t, 6.0, "declined", "card_expired", 0, "none"),
        (3, 11, 100, t, 7.0, "approved", None, 1, "large_amount"),
        (4, 99, 100, t, 8.0, "approved", None, 0, "none"),  # unknown employee: dropped
    ])
    emp = employees_df(spark, [(10, 7, "Ann", "Sales", 1000), (11, 8, "Bob", "Ops", 2000)])
    mer = merchants_df(spark, [(100, "Shop", "Meals", "US"), (200, "Air", "Travel", "CA")])
    out = {r["transaction_id"]: r for r in enrich.enrich_transactions(raw, emp, mer).collect()}
    assert set(out) == {1, 2, 3}
    assert [out[i]["company_id"] for i in (1, 2, 3)] == [7, 7, 8]
    assert [out[i]["is_international"] for i in (1, 2, 3)] == [False, True, False]
    assert [out[i]["merchant_country"] for i in (1, 2, 3)] == ["US", "CA", "US"]
    # the reason survives only on declined rows
    assert [out[i]["decline_reason"] for i in (1, 2, 3)] == [None, "card_expired", None]
    assert list(out[1].asDict()) == enrich.TRANSACTION_COLUMNS


def test_label_distribution_and_eligibility(spark):
    from datetime import datetime

    t = datetime(2025, 1, 1)
    rows = [(i, 1 + (i % 3 == 0), 100, t, 1.0, "approved", None, int(i % 5 == 0),
             "large_amount" if i % 5 == 0 else "none") for i in range(1, 16)]
    txn = _raw(spark, rows).withColumn("company_id", F.lit(1).cast("long"))
    dist = [(r["fraud_type"], r["transaction_count"], r["labeled_transactions"])
            for r in enrich.fraud_label_distribution(txn).collect()]
    assert dist == [("none", 12, 0), ("large_amount", 3, 3)]
    # employee 1: 10 rows, 8 unlabeled; employee 2: 5 rows (i % 3 == 0), 4 unlabeled
    elig = {r["employee_id"]: r["unlabeled_transactions"] for r in enrich.eligible_employees(txn, 5).collect()}
    assert elig == {1: 8}
    elig4 = {r["employee_id"]: r["unlabeled_transactions"] for r in enrich.eligible_employees(txn, 4).collect()}
    assert elig4 == {1: 8, 2: 4}

"""P4 on random transactions against the oracle's SQL run by DuckDB on the
same rows (NULL and tied reasons, merchants without declines or approvals,
unknown merchants, cent amounts)."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from spendwatch.operators import reports as Rp
from spendwatch.params import TESTDATA_DECLINE
from spendwatch.plans import oracle

from .helpers import merchants_df, txn_df

_row = st.tuples(
    st.integers(min_value=1, max_value=4),                      # merchant (4 is unknown)
    st.sampled_from(["approved", "declined"]),
    st.sampled_from([None, "a_reason", "b_reason", "c_reason"]),
    st.integers(min_value=1, max_value=500_000),                # cents
)

MERCHANTS = [(1, "Shop", "Meals", "US"), (2, "Air", "Travel", "CA"), (3, "Cab", "Travel", "US")]


def _norm(v):
    return float(f"{v:.9g}") if isinstance(v, float) and not math.isnan(v) else v


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_row, min_size=1, max_size=60))
def test_merchant_analysis_matches_sql(spark, rows):
    import duckdb
    import pandas as pd

    specs = [{"merchant_id": m, "transaction_status": s, "decline_reason": r if s == "declined" else None,
              "amount": c / 100.0} for m, s, r, c in rows]
    got_df = Rp.merchant_decline_analysis(txn_df(spark, specs), merchants_df(spark, MERCHANTS), TESTDATA_DECLINE)
    cols = sorted(got_df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in got_df.collect()), key=repr)

    con = duckdb.connect()
    con.register("transactions", pd.DataFrame(
        [(s["merchant_id"], s["transaction_status"], s["decline_reason"], s["amount"]) for s in specs],
        columns=["merchant_id", "transaction_status", "decline_reason", "amount"]))
    con.register("merchants", pd.DataFrame(MERCHANTS, columns=["merchant_id", "merchant_name", "category", "country"]))
    res = con.execute("WITH " + oracle.SHOPS + "\nSELECT * FROM health")
    oc = [d[0] for d in res.description]
    want = sorted((tuple(_norm(dict(zip(oc, r))[c]) for c in cols) for r in res.fetchall()), key=repr)
    assert sorted(oc) == cols
    assert got == want


_spend = st.tuples(
    st.integers(min_value=1, max_value=4),                      # employee (4 is unknown)
    st.integers(min_value=0, max_value=2),                      # month offset
    st.sampled_from(["approved", "approved", "declined"]),
    st.integers(min_value=1, max_value=150_000),                # cents
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_spend, min_size=1, max_size=40), st.sampled_from([1000, 1234, 2000]))
def test_budget_alerts_match_sql(spark, rows, budget):
    from datetime import datetime

    import duckdb
    import pandas as pd

    from spendwatch.params import TESTDATA_BUDGET

    from .helpers import employees_df

    specs = [{"employee_id": e, "company_id": 9, "transaction_status": s, "amount": c / 100.0,
              "transaction_timestamp": datetime(2025, 1 + mo, 3, 12, 0)} for e, mo, s, c in rows]
    emps = [(e, 9, f"E{e}", "Ops", budget * e) for e in (1, 2, 3)]
    got_df = Rp.budget_risk_alerts(txn_df(spark, specs), employees_df(spark, emps), TESTDATA_BUDGET)
    cols = sorted(got_df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in got_df.collect()), key=repr)

    con = duckdb.connect()
    frame = pd.DataFrame([(s["transaction_timestamp"], s["employee_id"], s["company_id"], s["transaction_status"],
                           s["amount"]) for s in specs],
                         columns=["transaction_timestamp", "employee_id", "company_id", "transaction_status", "amount"])
    con.register("order_transactions", frame)
    con.register("employees", pd.DataFrame(emps, columns=["employee_id", "company_id", "employee_name", "department",
                                                          "monthly_budget"]))
    res = con.execute("WITH " + oracle.BUDGET + "\nSELECT * FROM bands WHERE budget_status <> 'within_budget'")
    oc = [d[0] for d in res.description]
    want = sorted((tuple(_norm(dict(zip(oc, r))[c]) for c in cols) for r in res.fetchall()), key=repr)
    assert sorted(oc) == cols
    assert got == want


_txn = st.tuples(
    st.integers(min_value=1, max_value=3),                      # employee
    st.integers(min_value=0, max_value=600),                    # minute
    st.sampled_from(["approved", "approved", "approved", "declined"]),
    st.integers(min_value=100, max_value=60_000),               # cents
    st.booleans(),                                              # international
    st.sampled_from(["none", "none", "large_amount", "velocity_attack"]),
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_txn, min_size=1, max_size=50))
def test_fraud_scoring_matches_sql(spark, rows):
    from datetime import datetime, timedelta

    import duckdb
    import pandas as pd

    from spendwatch.operators import rules as R
    from spendwatch.params import TESTDATA_RULES

    t0 = datetime(2025, 3, 1)
    specs = [{"employee_id": e, "company_id": 5, "transaction_timestamp": t0 + timedelta(minutes=m),
              "transaction_status": s, "amount": c / 100.0, "is_international": i,
              "fraud_type": f, "is_fraud": int(f != "none")} for e, m, s, c, i, f in rows]
    df = txn_df(spark, specs)

    def rounded(v):
        return round(v, 6) if isinstance(v, float) else v

    got_df = R.fraud_scored_transactions(df, TESTDATA_RULES)
    cols = sorted(got_df.columns)
    got = sorted((tuple(rounded(r[c]) for c in cols) for r in got_df.collect()), key=repr)

    frame = pd.DataFrame(
        [(i, s["company_id"], s["employee_id"], s["transaction_timestamp"], s["amount"], s["transaction_status"],
          s["is_international"], s["is_fraud"], s["fraud_type"]) for i, s in enumerate(specs, start=1)],
        columns=["transaction_id", "company_id", "employee_id", "transaction_timestamp", "amount",
                 "transaction_status", "is_international", "is_fraud", "fraud_type"])
    con = duckdb.connect()
    con.register("transactions", frame)
    res = con.execute("WITH " + oracle.SCORED + "\nSELECT * EXCLUDE (transaction_status) FROM scores")
    oc = [d[0] for d in res.description]
    want = sorted((tuple(rounded(dict(zip(oc, r))[c]) for c in cols) for r in res.fetchall()), key=repr)
    assert sorted(oc) == cols
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(min_value=1, max_value=3), st.integers(min_value=0, max_value=400),
                          st.sampled_from(["none", "velocity_attack", None]),
                          st.sampled_from(["approved", "approved", "declined"])), min_size=1, max_size=50))
def test_sweep_matches_sql(spark, rows):
    from datetime import datetime, timedelta

    import duckdb
    import pandas as pd

    from spendwatch.operators import evaluation as E
    from spendwatch.params import TESTDATA_SWEEP

    t0 = datetime(2025, 3, 1)
    specs = [{"employee_id": e, "transaction_timestamp": t0 + timedelta(minutes=m), "fraud_type": f,
              "transaction_status": s} for e, m, f, s in rows]
    got_df = E.velocity_threshold_experiment(txn_df(spark, specs), TESTDATA_SWEEP)
    cols = sorted(got_df.columns)
    got = sorted(tuple(r[c] for c in cols) for r in got_df.collect())
    frame = pd.DataFrame([(i, s["employee_id"], s["transaction_timestamp"], s["fraud_type"], s["transaction_status"])
                          for i, s in enumerate(specs)],
                         columns=["transaction_id", "employee_id", "transaction_timestamp", "fraud_type", "transaction_status"])
    frame["fraud_type"] = frame["fraud_type"].astype("string")
    con = duckdb.connect()
    con.register("transactions", frame)
    res = con.execute("WITH " + oracle.APPROVED + ",\n" + oracle.sweep(oracle.GRID) + "\nSELECT * FROM experiment")
    oc = [d[0] for d in res.description]
    want = sorted(tuple(dict(zip(oc, r))[c] for c in cols) for r in res.fetchall())
    assert got == want

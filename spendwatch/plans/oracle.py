"""Oracle SQL (DuckDB) for every registered query, from definitions.

The statements share no formulation with the Spark plans and no constant with the
code under test: bursts come from "no earlier row within the gap", rolling counts from a
join of each row with the rows in its window, deviations from a second pass around
the mean, top reasons from an ordered pick, money from compensated sums of the plain column, and
dimensions are joined after aggregation. Thresholds are written out here, as
FIXTURES.md states them for the test tables.
"""

from __future__ import annotations

# Fixed values for the test tables.
GAP = 60
BURST_ROWS = 3
LARGE = 200
SIGMAS = 3
ABROAD = 100
HIGH_SCORE = 2
ALERT_SCORE = 1
AT_RISK, OVER = 80, 100
MONITOR, HIGH = 18, 22
GRID = [(60, 2), (60, 3), (120, 3), (180, 3), (180, 4)]
WINDOW, WINDOW_ROWS = 60, 3
DIGITS = 6


# The test-table adapter (see spendwatch.sources.testdata), as CTEs.
ADAPTER = f"""
employees AS (
    SELECT c_custkey AS employee_id, CAST(c_nationkey AS BIGINT) AS company_id,
           c_name AS employee_name, c_mktsegment AS department,
           1000 + 50 * abs(c_acctbal) AS monthly_budget
    FROM customer
),
merchants AS (
    SELECT s.s_suppkey AS merchant_id, s.s_name AS merchant_name,
           'cat_' || CAST(s.s_suppkey % 8 AS VARCHAR) AS category,
           n.n_name AS country, n.n_regionkey
    FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
),
companies AS (
    SELECT CAST(n_nationkey AS BIGINT) AS company_id, n_name AS company_name,
           r_name AS industry, CAST(NULL AS DATE) AS created_at
    FROM nation JOIN region ON n_regionkey = r_regionkey
),
event_src AS (
    SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
    FROM events
),
transactions AS (
    SELECT e.event_id AS transaction_id, emp.company_id, e.user_id AS employee_id,
           e.event_id % (SELECT COUNT(*) FROM supplier) AS merchant_id,
           e.ts AS transaction_timestamp, e.value AS amount,
           CASE WHEN e.event_type = 'error' THEN 'declined' ELSE 'approved' END AS transaction_status,
           CASE WHEN e.event_type = 'error' THEN 'reason_' || CAST(e.k % 4 AS VARCHAR) END AS decline_reason,
           m.n_regionkey = 4 AS is_international,
           m.country AS merchant_country,
           CASE WHEN e.event_type <> 'error' AND e.k >= 95 THEN 1 ELSE 0 END AS is_fraud,
           CASE WHEN e.event_type = 'error' OR e.k < 95 THEN 'none'
                WHEN e.k <= 96 THEN 'large_amount'
                WHEN e.k <= 98 THEN 'international_purchase'
                ELSE 'velocity_attack' END AS fraud_type
    FROM event_src e
    JOIN employees emp ON e.user_id = emp.employee_id
    JOIN merchants m ON e.event_id % (SELECT COUNT(*) FROM supplier) = m.merchant_id
),
order_transactions AS (
    SELECT o.o_orderkey AS transaction_id, emp.company_id, o.o_custkey AS employee_id,
           o.o_orderkey % (SELECT COUNT(*) FROM supplier) AS merchant_id,
           CAST(o.o_orderdate AS TIMESTAMP) AS transaction_timestamp, o.o_totalprice AS amount,
           CASE WHEN o.o_orderstatus = 'F' THEN 'declined' ELSE 'approved' END AS transaction_status,
           CASE WHEN o.o_orderstatus = 'F' THEN o.o_orderpriority END AS decline_reason,
           m.n_regionkey = 4 AS is_international,
           m.country AS merchant_country,
           0 AS is_fraud, 'none' AS fraud_type
    FROM orders o
    JOIN employees emp ON o.o_custkey = emp.employee_id
    JOIN merchants m ON o.o_orderkey % (SELECT COUNT(*) FROM supplier) = m.merchant_id
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([ADAPTER, *ctes]) + "\n"


# ---------------------------------------------------------------- budget ---

BUDGET = f"""months AS (
    SELECT employee_id, company_id, date_trunc('month', transaction_timestamp)::TIMESTAMP AS spend_month,
           coalesce(fsum(amount) FILTER (transaction_status = 'approved'), 0.0) AS spent
    FROM order_transactions GROUP BY ALL
),
budgets AS (
    SELECT months.*, employee_name, department, monthly_budget,
           round(100.0 * spent / monthly_budget, 2) AS budget_used_pct
    FROM months JOIN employees USING (employee_id)
),
bands AS (
    SELECT budgets.* EXCLUDE (company_id, spent), budgets.company_id, round(spent, 2) AS monthly_spend,
           round(spent - monthly_budget, 2) AS budget_overage,
           ['within_budget', 'at_risk', 'over_budget'][1 + (budget_used_pct >= {AT_RISK})::INT + (budget_used_pct >= {OVER})::INT]
               AS budget_status
    FROM budgets
)"""

# -------------------------------------------------------------- merchant ---

SHOPS = f"""totals AS (
    SELECT merchant_id, count(*) AS total_transactions,
           count(*) FILTER (transaction_status = 'approved') AS approved_transactions,
           count(*) FILTER (transaction_status = 'declined') AS declined_transactions,
           round(fsum(amount), 2) AS total_transaction_value,
           round(fsum(amount) FILTER (transaction_status = 'approved')
                 / count(amount) FILTER (transaction_status = 'approved'), 2) AS avg_approved_transaction_amount
    FROM transactions GROUP BY merchant_id
),
shops AS (
    SELECT merchant_id, merchant_name, category, country AS merchant_country, totals.* EXCLUDE (merchant_id)
    FROM merchants JOIN totals USING (merchant_id)
),
reasons AS (
    SELECT merchant_id, decline_reason, count(*) AS decline_count
    FROM transactions SEMI JOIN merchants USING (merchant_id)
    WHERE transaction_status = 'declined' GROUP BY ALL
),
favourite AS (
    SELECT merchant_id, first(decline_reason ORDER BY decline_count DESC, decline_reason NULLS LAST) AS most_common_decline_reason,
           max(decline_count) AS decline_count, 1::BIGINT AS reason_rank
    FROM reasons GROUP BY merchant_id
),
health AS (
    SELECT shops.* EXCLUDE (total_transaction_value, avg_approved_transaction_amount),
           round(100.0 * approved_transactions / total_transactions, 2) AS approval_rate_pct,
           round(100.0 * declined_transactions / total_transactions, 2) AS decline_rate_pct,
           total_transaction_value, avg_approved_transaction_amount, most_common_decline_reason,
           ['healthy', 'monitor', 'high_decline_risk'][1 + (100.0 * declined_transactions / total_transactions >= {MONITOR})::INT
               + (100.0 * declined_transactions / total_transactions >= {HIGH})::INT] AS merchant_payment_health
    FROM shops LEFT JOIN favourite USING (merchant_id)
)"""

# ----------------------------------------------------------------- fraud ---

APPROVED = "good AS (SELECT * FROM transactions WHERE transaction_status = 'approved')"

# The deviation needs the mean first.
SPREAD = """centre AS (
    SELECT employee_id, fsum(amount) / count(amount) AS employee_avg_amount FROM good GROUP BY employee_id
),
spread AS (
    SELECT employee_id, employee_avg_amount,
           sqrt(fsum((amount - employee_avg_amount) ** 2) / count(amount)) AS employee_amount_stddev
    FROM good JOIN centre USING (employee_id) GROUP BY ALL
)"""

# A burst is opened by a row that no earlier row of the employee precedes within the gap;
# a row belongs to as many-th a burst as openers lie at or before it.
BURSTS = f"""openers AS (
    SELECT employee_id, transaction_timestamp, transaction_id FROM good AS row
    WHERE NOT EXISTS (
        FROM good AS other WHERE other.employee_id = row.employee_id
          AND other.transaction_timestamp BETWEEN row.transaction_timestamp - INTERVAL {GAP} MINUTE AND row.transaction_timestamp
          AND (other.transaction_timestamp < row.transaction_timestamp OR other.transaction_id < row.transaction_id))
),
members AS (
    SELECT row.transaction_id, row.employee_id, row.transaction_timestamp, count(*) AS burst_id,
           bool_or(opener.transaction_id = row.transaction_id)::INT AS starts_new_burst
    FROM good AS row JOIN openers AS opener ON opener.employee_id = row.employee_id
     AND (opener.transaction_timestamp < row.transaction_timestamp
          OR opener.transaction_timestamp = row.transaction_timestamp AND opener.transaction_id <= row.transaction_id)
    GROUP BY ALL
),
crowd AS (SELECT employee_id, burst_id, count(*) AS transactions_in_burst FROM members GROUP BY ALL),
earlier AS (
    SELECT row.transaction_id, max(other.transaction_timestamp) AS previous_transaction_timestamp
    FROM good AS row LEFT JOIN good AS other ON other.employee_id = row.employee_id
     AND (other.transaction_timestamp < row.transaction_timestamp
          OR other.transaction_timestamp = row.transaction_timestamp AND other.transaction_id < row.transaction_id)
    GROUP BY row.transaction_id
)"""

RULES = {
    "large_transaction_flag": f"amount >= {LARGE}",
    "unusual_amount_flag": f"employee_amount_stddev > 0 AND (amount - employee_avg_amount) > {SIGMAS} * employee_amount_stddev",
    "velocity_flag": f"transactions_in_burst >= {BURST_ROWS}",
    "international_risk_flag": f"is_international AND amount >= {ABROAD}",
}
_FLAG_LIST = ", ".join(f"coalesce({test}, false)::INT AS {name}" for name, test in RULES.items())

SCORES = f"""judged AS (
    SELECT good.*, employee_avg_amount, employee_amount_stddev, transactions_in_burst, {_FLAG_LIST}
    FROM good JOIN members USING (transaction_id, employee_id, transaction_timestamp)
    JOIN crowd USING (employee_id, burst_id) JOIN spread USING (employee_id)
),
scores AS (
    SELECT *, list_sum([{", ".join(RULES)}])::INT AS fraud_risk_score,
           (list_sum([{", ".join(RULES)}]) >= {ALERT_SCORE})::INT AS predicted_fraud
    FROM judged
)"""

NAMED = f"""named AS (
    SELECT scores.*, employee_name, merchant_name, category,
           CASE WHEN fraud_risk_score < {ALERT_SCORE} THEN 'low_risk' WHEN fraud_risk_score < {HIGH_SCORE} THEN 'medium_risk'
                ELSE 'high_risk' END AS fraud_risk_level
    FROM scores JOIN (SELECT employee_id, employee_name FROM employees) USING (employee_id)
    JOIN (SELECT merchant_id, merchant_name, category FROM merchants) USING (merchant_id)
)"""

SCORED = ",\n".join([APPROVED, SPREAD, BURSTS, SCORES])
_STATS = f"round(employee_avg_amount, {DIGITS}) AS employee_avg_amount, round(employee_amount_stddev, {DIGITS}) AS employee_amount_stddev"
_SHOWN = f"""transaction_id, company_id, employee_id, employee_name, merchant_id, merchant_name, category, transaction_timestamp,
    amount, is_international, merchant_country, {_STATS}, transactions_in_burst"""

BURST_LABELS = f"""labelled AS (
    SELECT transaction_id, employee_id, transaction_timestamp, amount, is_fraud, fraud_type, transactions_in_burst,
           (transactions_in_burst >= {BURST_ROWS})::INT AS predicted_velocity_fraud
    FROM good JOIN members USING (transaction_id, employee_id, transaction_timestamp) JOIN crowd USING (employee_id, burst_id)
)"""


def _cells(label: str, alert: str) -> str:
    """The four cells of a confusion matrix; rows with an unknown label are in none."""
    return f"""count(*) FILTER ({label} AND {alert}) AS true_positive, count(*) FILTER (NOT ({label}) AND {alert}) AS false_positive,
    count(*) FILTER ({label} AND NOT ({alert})) AS false_negative, count(*) FILTER (NOT ({label}) AND NOT ({alert})) AS true_negative"""


def _ratio(part: str, whole: str) -> str:
    return f"coalesce(round(({part})::DOUBLE / nullif({whole}, 0), 4), 0.0)"


_RATES = f"""{_ratio("true_positive", "true_positive + false_positive")} AS precision,
    {_ratio("true_positive", "true_positive + false_negative")} AS recall,
    {_ratio("false_positive", "false_positive + true_negative")} AS false_positive_rate"""


def rolling(minutes: int | str) -> str:
    """Each approved row with the rows of its employee in the window that ends at it."""
    return f"""SELECT row.transaction_id, count(*) AS near
    FROM good AS row JOIN good AS other ON other.employee_id = row.employee_id
     AND other.transaction_timestamp BETWEEN row.transaction_timestamp - to_minutes({minutes}) AND row.transaction_timestamp
    GROUP BY ALL"""


def sweep(grid: list[tuple[int, int]]) -> str:
    """The rolling rule's cells for each (window, minimum) of the grid."""
    widths = sorted({w for w, _ in grid})
    near = " UNION ALL ".join(f"SELECT {w} AS window_minutes, * FROM ({rolling(w)})" for w in widths)
    values = ", ".join(f"({w}, {k})" for w, k in grid)
    return f"""grid(window_minutes, minimum_transactions) AS (VALUES {values}),
near AS ({near}),
cells AS (
    SELECT window_minutes, minimum_transactions, {_cells("fraud_type = 'velocity_attack'", "near >= minimum_transactions")},
           count(*) FILTER (near >= minimum_transactions) AS total_alerts
    FROM grid LEFT JOIN (near JOIN good USING (transaction_id)) USING (window_minutes) GROUP BY ALL
),
experiment AS (SELECT *, {_RATES} FROM cells)"""


_BEST_FIRST = "ORDER BY recall DESC, precision DESC, window_minutes, minimum_transactions"


def _rule(name: str) -> str:
    return _with(SCORED, NAMED) + f"SELECT {_SHOWN}, {name} FROM named"


ORACLE: dict[str, str] = {
    "monthly_spend_overview": _with() + """
SELECT date_trunc('month', transaction_timestamp)::TIMESTAMP AS transaction_month, count(*) AS transaction_count,
       round(fsum(amount), 2) AS total_spend, round(fsum(amount) / count(amount), 2) AS average_transaction_amount,
       round(100.0 * count(*) FILTER (transaction_status = 'approved') / count(*), 2) AS approval_rate_pct
FROM order_transactions GROUP BY ALL ORDER BY transaction_month""",
    "monthly_employee_spend": _with(BUDGET) + "SELECT spend_month, employee_id, company_id, round(spent, 2) AS monthly_spend FROM months",
    "employee_budget_usage": _with(BUDGET) + "SELECT * EXCLUDE (budget_status) FROM bands",
    "budget_risk_alerts": _with(BUDGET) + """SELECT * FROM bands WHERE budget_status <> 'within_budget'
ORDER BY spend_month DESC, budget_used_pct DESC, employee_id""",
    "budget_status_counts": _with(BUDGET) + "SELECT budget_status, count(*) AS employee_months FROM bands GROUP BY ALL",
    "merchant_transaction_metrics": _with(SHOPS) + "SELECT * FROM shops",
    "decline_reason_metrics": _with(SHOPS) + "SELECT * FROM reasons",
    "top_decline_reason": _with(SHOPS) + "SELECT * FROM favourite",
    "merchant_decline_analysis": _with(SHOPS) + "SELECT * FROM health ORDER BY decline_rate_pct DESC, total_transactions DESC, merchant_id",
    "merchant_health_counts": _with(SHOPS) + "SELECT merchant_payment_health, count(*) AS merchants FROM health GROUP BY ALL",
    "employee_transaction_stats": _with(APPROVED, SPREAD) + f"SELECT employee_id, {_STATS} FROM spread",
    "previous_transaction_gap": _with(APPROVED, BURSTS) + """
SELECT transaction_id, employee_id, transaction_timestamp, previous_transaction_timestamp FROM good JOIN earlier USING (transaction_id)""",
    "burst_boundaries": _with(APPROVED, BURSTS) + "SELECT members.* EXCLUDE (burst_id), previous_transaction_timestamp FROM members JOIN earlier USING (transaction_id)",
    "burst_groups": _with(APPROVED, BURSTS) + "SELECT members.*, previous_transaction_timestamp FROM members JOIN earlier USING (transaction_id)",
    "burst_sizes": _with(APPROVED, BURSTS) + "SELECT * FROM crowd",
    "velocity_burst_scored": _with(APPROVED, BURSTS, BURST_LABELS) + "SELECT * FROM labelled",
    "rolling_transaction_count": _with(APPROVED) + f"""
SELECT transaction_id, employee_id, transaction_timestamp, is_fraud, fraud_type, near AS transactions_in_window
FROM good JOIN ({rolling(WINDOW)}) USING (transaction_id)""",
    "rolling_velocity_flags": _with(APPROVED) + f"""
SELECT transaction_id, employee_id, transaction_timestamp, is_fraud, fraud_type, near AS transactions_in_window,
       (near >= {WINDOW_ROWS})::INT AS predicted_velocity_fraud
FROM good JOIN ({rolling(WINDOW)}) USING (transaction_id)""",
    "transaction_features": _with(SCORED, NAMED) + f"SELECT {_SHOWN} FROM named",
    "rule_large_transaction": _rule("large_transaction_flag"),
    "rule_unusual_amount": _rule("unusual_amount_flag"),
    "rule_velocity_burst": _rule("velocity_flag"),
    "rule_international_risk": _rule("international_risk_flag"),
    "fraud_risk_levels": _with(SCORED, NAMED) + "SELECT fraud_risk_level, count(*) AS transactions FROM named GROUP BY ALL",
    "fraud_alerts": _with(SCORED, NAMED) + """
SELECT named.* EXCLUDE (merchant_id, transaction_status, decline_reason, is_fraud, fraud_type, predicted_fraud)
    REPLACE (round(employee_avg_amount, 2) AS employee_avg_amount, round(employee_amount_stddev, 2) AS employee_amount_stddev)
FROM named WHERE fraud_risk_level <> 'low_risk' ORDER BY fraud_risk_score DESC, amount DESC, transaction_id""",
    "fraud_scored_transactions": _with(SCORED) + f"""
SELECT scores.* EXCLUDE (merchant_id, transaction_status, decline_reason, merchant_country, employee_avg_amount, employee_amount_stddev),
       {_STATS}
FROM scores""",
    "fraud_confusion_matrix": _with(SCORED) + f"SELECT {_cells('is_fraud = 1', 'predicted_fraud = 1')} FROM scores",
    "fraud_evaluation_summary": _with(SCORED) + f"""
, cells AS (
    SELECT count(*) AS approved_transactions_scored, count(*) FILTER (is_fraud = 1) AS ground_truth_fraud_transactions,
           count(*) FILTER (predicted_fraud = 1) AS alerts_generated, {_cells("is_fraud = 1", "predicted_fraud = 1")},
           coalesce(fsum(amount) FILTER (is_fraud = 1), 0.0) AS lost,
           coalesce(fsum(amount) FILTER (is_fraud = 1 AND predicted_fraud = 1), 0.0) AS caught
    FROM scores
)
SELECT cells.* EXCLUDE (lost, caught), {_RATES}, round(alerts_generated::DOUBLE / approved_transactions_scored, 4) AS alert_rate,
       round(lost, 2) AS fraud_dollars, round(caught, 2) AS fraud_dollars_captured,
       {_ratio("caught", "lost")} AS fraud_dollar_capture_rate
FROM cells""",
    "fraud_evaluation_by_type": _with(SCORED) + """
SELECT fraud_type, count(*) FILTER (is_fraud = 1) AS fraud_transactions, count(*) FILTER (predicted_fraud = 1) AS detected_transactions,
       round(fsum(amount) / count(amount), 4) AS average_amount, round(fsum(amount), 2) AS fraud_dollars,
       round(count(*) FILTER (predicted_fraud = 1)::DOUBLE / nullif(count(*) FILTER (is_fraud = 1), 0), 4) AS recall
FROM scores WHERE fraud_type <> 'none' GROUP BY fraud_type ORDER BY fraud_type""",
    "velocity_burst_evaluation": _with(APPROVED, BURSTS, BURST_LABELS) + f"""
, cells AS (
    SELECT {_cells("fraud_type IS NOT DISTINCT FROM 'velocity_attack'", "predicted_velocity_fraud = 1")},
           count(*) FILTER (predicted_velocity_fraud = 1) AS alerts_generated
    FROM labelled
)
SELECT 'burst_level_{BURST_ROWS}_transactions_{GAP}_minutes' AS method, *, {_RATES} FROM cells""",
    "velocity_threshold_experiment": _with(APPROVED, sweep(GRID)) + f"SELECT * FROM experiment {_BEST_FIRST}",
    "best_velocity_config": _with(APPROVED, sweep(GRID)) + f"SELECT * FROM experiment {_BEST_FIRST} LIMIT 1",
    "table_row_counts": _with() + """
SELECT unnest(['companies', 'employees', 'merchants', 'transactions']) AS table_name,
       unnest([(SELECT count(*) FROM companies), (SELECT count(*) FROM employees),
               (SELECT count(*) FROM merchants), (SELECT count(*) FROM transactions)]) AS row_count""",
    "fraud_label_distribution": _with() + """
SELECT fraud_type, count(*) AS transaction_count, count(*) FILTER (is_fraud = 1) AS labeled_transactions
FROM transactions GROUP BY ALL ORDER BY transaction_count DESC, fraud_type""",
    "eligible_employees": _with() + """
SELECT * FROM (SELECT employee_id, count(*) AS unlabeled_transactions FROM transactions WHERE is_fraud = 0 GROUP BY ALL)
WHERE unlabeled_transactions >= 4""",
    "enriched_transactions": _with() + "SELECT * FROM transactions",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)

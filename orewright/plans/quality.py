"""Data-quality queries: the violating rows, or a count per check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orewright.operators import grains
from orewright.operators import quality as op
from orewright.plans import ledger, retail, workforce
from orewright.plans.registry import query
from orewright.sources import adapters as given
from orewright.sources.adapters import Given


@query("D-01", sql="SELECT customer_id, last_name FROM r_customers_all WHERE email IS NULL")
def not_null(g: Given) -> DataFrame:
    people = retail.op.conform_customers(given.retail_customers(g))
    return op.not_null(people, "email").select("customer_id", "last_name")


@query("D-02", "A-26", sql="""
    SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicates(g: Given) -> DataFrame:
    return op.duplicates(g.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("D-03", "J-17", sql="""
    SELECT employee_id, department_id FROM h_employees
    WHERE department_id IS NOT NULL AND department_id NOT IN (SELECT department_id FROM h_departments)""")
def relationships(g: Given) -> DataFrame:
    staff = workforce.employees(g).select("employee_id", "department_id")
    return op.relationships(staff, "department_id", workforce.departments(g), "department_id")


@query("J-17", sql="""
    SELECT review_id, employee_id FROM h_reviews
    WHERE employee_id IS NOT NULL AND employee_id NOT IN (SELECT employee_id FROM h_employees)""")
def fk_orphans(g: Given) -> DataFrame:
    reviews = workforce.reviews(g).select("review_id", "employee_id")
    return grains.fk_orphans(reviews, workforce.employees(g), "employee_id", "employee_id")


@query("D-04", sql="""
    SELECT order_status AS value_field, count(*) AS n_records FROM r_orders
    WHERE order_status NOT IN ('placed', 'delivered') GROUP BY 1""")
def accepted_values(g: Given) -> DataFrame:
    return op.accepted_values(retail.orders(g), "order_status", ["placed", "delivered"])


@query("D-05", sql="""
    SELECT * FROM (
      SELECT journal_entry_id, sum(debit_amount) AS total_debits, sum(credit_amount) AS total_credits,
        abs(sum(debit_amount) - sum(credit_amount)) AS imbalance FROM g_lines GROUP BY 1)
    WHERE imbalance > 0.05""", real=["total_debits", "total_credits", "imbalance"])
def je_balanced(g: Given) -> DataFrame:
    return op.je_balanced(ledger.lines(g))


@query("D-06", sql="""
    SELECT * FROM (
      SELECT fiscal_period_id, sum(total_debits) AS period_debits, sum(total_credits) AS period_credits,
        abs(sum(total_debits) - sum(total_credits)) AS period_imbalance FROM g_trial GROUP BY 1)
    WHERE period_imbalance > 0.10""", real=["period_debits", "period_credits", "period_imbalance"])
def trial_balance_nets_to_zero(g: Given) -> DataFrame:
    return op.trial_balance_nets_to_zero(ledger.trial_balance(g))


@query("D-07", sql="""
    SELECT journal_entry_id, posting_date, fiscal_period_id, period_is_closed AS is_closed FROM gl WHERE 1 = 0""",
       text=["posting_date"])
def no_postings_to_closed_periods(g: Given) -> DataFrame:
    return op.no_postings_to_closed_periods(ledger.rows(g), ledger.periods(g))


@query("D-07", sql="""
    SELECT journal_entry_id, posting_date, fiscal_period_id, period_is_closed AS is_closed
    FROM gl WHERE period_is_closed = 1 AND je_status = 'Posted'""", text=["posting_date"])
def closed_periods_enforced(g: Given) -> DataFrame:
    return op.no_postings_to_closed_periods(ledger.rows(g), ledger.periods(g), enforce=True)


@query(
    "D-08",
    sql="""
    SELECT CAST(event_id AS VARCHAR) AS journal_entry_id, value AS amount, event_type AS description, ts AS created_at
    FROM events
    WINDOW same AS (PARTITION BY value, event_type ORDER BY ts, event_id)
    QUALIFY ts - lag(ts) OVER same <= INTERVAL 120 MINUTE OR lead(ts) OVER same - ts <= INTERVAL 120 MINUTE""",
    text=["created_at"],
)
def suspected_duplicates(g: Given) -> DataFrame:
    """Events read as entries: the same amount and text again within two hours."""
    entries = g.table("events").select(
        F.col("event_id").cast("string").alias("journal_entry_id"), F.col("value").alias("amount"),
        F.col("event_type").alias("description"), F.col("ts").alias("created_at"),
    )
    return op.suspected_duplicates(entries, minutes=120)


@query(
    "D-08",
    sql="""
    SELECT journal_entry_id, amount, description, created_at
    FROM (SELECT e.journal_entry_id, e.description, e.created_at, sum(l.debit_amount) AS amount
      FROM g_entries e JOIN g_lines l ON l.journal_entry_id = e.journal_entry_id GROUP BY ALL)
    WINDOW same AS (PARTITION BY amount, description ORDER BY created_at, journal_entry_id)
    QUALIFY created_at - lag(created_at) OVER same <= INTERVAL 30 DAY OR lead(created_at) OVER same - created_at <= INTERVAL 30 DAY""",
    text=["created_at"], real=["amount"],
)
def suspected_duplicate_entries(g: Given) -> DataFrame:
    """Ledger entries that were entered with the same total and text as another one in the 30 days around."""
    return op.suspected_duplicates(op.entry_amounts(ledger.entries(g), ledger.lines(g)), minutes=30 * 24 * 60)


def _ledger_layers(g: Given):
    raw = {"entries": given.ledger_entries(g), "lines": given.ledger_lines(g)}
    stg = {
        "entries": ledger.entries(g), "lines": ledger.lines(g), "accounts": ledger.accounts(g),
        "centers": ledger.centers(g), "periods": ledger.periods(g),
    }
    marts = {
        "accounts": ledger.op.dim_accounts(stg["accounts"]), "centers": ledger.op.dim_cost_centers(stg["centers"]),
        "periods": ledger.op.dim_fiscal_periods(stg["periods"]), "fact": ledger.fact(g),
    }
    return {"raw": raw, "stg": stg, "marts": marts}


@query("D-01", "D-02", "D-03", "D-04", sql="""
    SELECT check_name, CASE WHEN check_name = 'relationships stg.lines.journal_entry_id'
      THEN (SELECT count(*) FROM g_lines WHERE journal_entry_id NOT IN (SELECT journal_entry_id FROM g_entries))
      ELSE 0 END AS violations
    FROM (SELECT unnest(['not_null raw.entries.journal_entry_id', 'not_null raw.lines.journal_entry_id',
      'not_null stg.entries.journal_entry_id', 'not_null stg.lines.journal_entry_id', 'not_null stg.lines.account_id',
      'not_null stg.lines.cost_center_id', 'not_null stg.accounts.account_id', 'not_null stg.centers.cost_center_id',
      'not_null stg.periods.fiscal_period_id', 'not_null marts.accounts.account_key', 'not_null marts.accounts.account_id',
      'not_null marts.centers.cost_center_key', 'not_null marts.periods.fiscal_period_key', 'not_null marts.fact.account_key',
      'not_null marts.fact.cost_center_key', 'not_null marts.fact.fiscal_period_key', 'unique raw.entries.journal_entry_id',
      'unique stg.entries.journal_entry_id', 'unique stg.accounts.account_id', 'unique stg.centers.cost_center_id',
      'unique stg.periods.fiscal_period_id', 'unique marts.accounts.account_key', 'unique marts.accounts.account_id',
      'unique marts.centers.cost_center_key', 'unique marts.periods.fiscal_period_key',
      'relationships stg.lines.journal_entry_id', 'relationships stg.lines.account_id', 'relationships stg.lines.cost_center_id',
      'relationships marts.fact.account_key', 'relationships marts.fact.cost_center_key',
      'relationships marts.fact.fiscal_period_key', 'accepted_values stg.accounts.account_type']) AS check_name)""")
def declared_checks(g: Given) -> DataFrame:
    """All 32 declared column checks of the ledger with their violation counts."""
    return op.ledger_check_counts(_ledger_layers(g))

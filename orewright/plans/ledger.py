"""General-ledger queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orewright.functions.dates import fiscal_quarter as quarter_of
from orewright.operators import grains
from orewright.operators import ledger as op
from orewright.plans.registry import query
from orewright.sources import adapters as given
from orewright.sources.adapters import Given, shared

AMOUNTS = ["debit_amount", "credit_amount", "net_amount"]
TOTALS = ["total_debits", "total_credits", "net_activity"]
STATEMENT = [
    "operating_revenue", "other_revenue", "cost_of_revenue", "operating_expenses",
    "non_operating_expenses", "total_revenue", "gross_profit", "operating_income", "net_income",
]
MARGINS = ["gross_margin_pct", "operating_margin_pct"]


@shared
def entries(g: Given) -> DataFrame:
    return op.stg_journal_entries(given.ledger_entries(g))


@shared
def lines(g: Given) -> DataFrame:
    return op.stg_journal_entry_lines(given.ledger_lines(g))


@shared
def accounts(g: Given) -> DataFrame:
    return op.stg_chart_of_accounts(given.ledger_accounts(g))


@shared
def centers(g: Given) -> DataFrame:
    return op.stg_cost_centers(given.ledger_centers(g))


@shared
def periods(g: Given) -> DataFrame:
    return op.stg_fiscal_periods(given.ledger_periods(g))


@shared
def budgets(g: Given) -> DataFrame:
    return op.stg_budget_allocations(given.ledger_budgets(g))


@shared
def rows(g: Given) -> DataFrame:
    return op.gl_transactions(lines(g), entries(g), accounts(g), centers(g), periods(g))


@shared
def totals(g: Given) -> DataFrame:
    return op.gl_totals(lines(g), entries(g), accounts(g), centers(g), periods(g))


@shared
def trial_balance(g: Given) -> DataFrame:
    return op.rpt_trial_balance(op.account_balances(op.period_activity(totals(g))))


@shared
def statement(g: Given) -> DataFrame:
    return op.income_statement(totals(g))


@shared
def variance(g: Given) -> DataFrame:
    return op.budget_vs_actuals(budgets(g), op.actuals(totals(g)), accounts(g), centers(g), periods(g))


@shared
def fact(g: Given) -> DataFrame:
    """The keys come along in the joins that build the transactions."""
    dims = op.dim_accounts(accounts(g)), op.dim_cost_centers(centers(g)), op.dim_fiscal_periods(periods(g))
    return op.fact_gl_activity(op.gl_transactions(lines(g), entries(g), *dims), *dims)


@query("P-12", sql="SELECT * FROM g_entries", text=["posting_date", "created_at"])
def stg_journal_entries(g: Given) -> DataFrame:
    return entries(g)


@query("P-13", sql="SELECT * FROM g_lines", real=AMOUNTS)
def stg_journal_entry_lines(g: Given) -> DataFrame:
    return op.stg_journal_entry_lines(given.ledger_lines(g, as_text=True))


@query("P-14", sql="SELECT * FROM g_accounts")
def stg_chart_of_accounts(g: Given) -> DataFrame:
    return accounts(g)


@query("P-14", sql="SELECT * FROM g_centers")
def stg_cost_centers(g: Given) -> DataFrame:
    return centers(g)


@query("P-15", sql="SELECT * FROM g_periods", text=["period_start_date", "period_end_date"])
def stg_fiscal_periods(g: Given) -> DataFrame:
    return periods(g)


@query("P-16", sql="SELECT * FROM g_budgets", real=["budget_amount"])
def stg_budget_allocations(g: Given) -> DataFrame:
    return budgets(g)


@query(
    "P-23", "F-06",
    sql="""
    SELECT md5(account_id) AS account_key, *, CASE WHEN account_type IN ('Asset', 'Expense') THEN 'Debit'
      WHEN account_type IN ('Liability', 'Equity', 'Revenue') THEN 'Credit' END AS normal_balance_type
    FROM g_accounts""",
)
def dim_accounts(g: Given) -> DataFrame:
    return op.dim_accounts(accounts(g))


@query("P-24", "F-06", sql="SELECT md5(cost_center_id) AS cost_center_key, * FROM g_centers")
def dim_cost_centers(g: Given) -> DataFrame:
    return op.dim_cost_centers(centers(g))


@query(
    "P-24", "F-04", "F-06",
    sql="""
    SELECT md5(fiscal_period_id) AS fiscal_period_key, *,
      'FY' || fiscal_year || ' ' || fiscal_quarter || ' - M' || fiscal_month AS period_display_name
    FROM g_periods""",
    text=["period_start_date", "period_end_date"],
)
def dim_fiscal_periods(g: Given) -> DataFrame:
    return op.dim_fiscal_periods(periods(g))


@query("J-07", sql="SELECT * FROM gl", text=["posting_date"], real=AMOUNTS)
def gl_transactions(g: Given) -> DataFrame:
    return rows(g)


@query(
    "J-07", "A-07",
    sql="""
    SELECT je_status, fiscal_period_id, fiscal_year, fiscal_month, fiscal_quarter, period_is_closed, account_id,
      account_name, account_type, financial_statement, account_subgroup, cost_center_id, cost_center_name,
      department_group, sum(debit_amount) AS debit_amount, sum(credit_amount) AS credit_amount,
      sum(net_amount) AS net_amount
    FROM gl GROUP BY ALL""",
    real=AMOUNTS,
)
def gl_totals(g: Given) -> DataFrame:
    return totals(g)


@query(
    "J-08",
    sql="""
    SELECT e.journal_entry_id, e.posting_date, p.fiscal_period_id FROM g_entries_raw e
    JOIN g_periods p ON e.posting_date BETWEEN p.period_start_date AND p.period_end_date""",
    text=["posting_date"],
)
def assign_period(g: Given) -> DataFrame:
    """The range join over the headers of every status."""
    dated = given.ledger_entries(g).select("journal_entry_id", F.col("posting_date").cast("date"))
    spans = periods(g).select("fiscal_period_id", "period_start_date", "period_end_date")
    return grains.assign_period(dated, spans, "posting_date")


@query(
    "J-08",
    sql="""
    SELECT e.journal_entry_id, e.created_at, p.span FROM g_entries_raw e JOIN (
      SELECT fiscal_period_id AS span, CAST(period_start_date AS TIMESTAMP) AS a, CAST(period_end_date AS TIMESTAMP) + INTERVAL '17 hours' AS b FROM g_periods
      UNION ALL SELECT 'FY' || fiscal_year, CAST(min(period_start_date) AS TIMESTAMP), CAST(max(period_end_date) AS TIMESTAMP) + INTERVAL '17 hours' FROM g_periods GROUP BY fiscal_year
      UNION ALL SELECT 'century', TIMESTAMP '1950-01-01 00:00:00', TIMESTAMP '2049-12-31 23:59:59'
    ) p ON e.created_at BETWEEN p.a AND p.b""",
    text=["created_at"],
)
def assign_spans(g: Given) -> DataFrame:
    """Times of entry within months, years and a century at once: spans that overlap and end at times of day."""
    entered = given.ledger_entries(g).select("journal_entry_id", F.col("created_at").cast("timestamp"))
    first, last = F.col("period_start_date").cast("timestamp"), F.col("period_end_date").cast("timestamp") + F.expr("INTERVAL 17 HOURS")
    months = periods(g).select("fiscal_period_id", "fiscal_year", first.alias("a"), last.alias("b"))
    years = months.groupBy(F.concat(F.lit("FY"), F.col("fiscal_year").cast("string")).alias("span")).agg(F.min("a").alias("a"), F.max("b").alias("b"))
    century = g.spark.range(1).select(
        F.lit("century").alias("span"), F.lit("1950-01-01 00:00:00").cast("timestamp").alias("a"), F.lit("2049-12-31 23:59:59").cast("timestamp").alias("b")
    )
    spans = months.select(F.col("fiscal_period_id").alias("span"), "a", "b").unionByName(years).unionByName(century)
    return grains.within_spans(entered, "created_at", spans, "a", "b").select("journal_entry_id", "created_at", "span")


@query("J-09", "F-06", sql="""
    SELECT md5(account_id) AS account_key, md5(cost_center_id) AS cost_center_key,
      md5(fiscal_period_id) AS fiscal_period_key, journal_entry_id, line_number, posting_date, je_description,
      source_system, je_status, debit_amount, credit_amount, net_amount FROM gl""",
       text=["posting_date"], real=AMOUNTS)
def fact_gl_activity(g: Given) -> DataFrame:
    return fact(g)


@query("A-07", sql="SELECT * FROM g_activity", real=TOTALS)
def period_activity(g: Given) -> DataFrame:
    return op.period_activity(totals(g))


@query("W-03", sql="SELECT * FROM g_balances", real=[*TOTALS, "ending_balance"])
def account_balances(g: Given) -> DataFrame:
    return op.account_balances(op.period_activity(totals(g)))


@query("P-25", sql="SELECT * FROM g_trial", real=[*TOTALS, "ending_balance", "reported_balance"])
def rpt_trial_balance(g: Given) -> DataFrame:
    return trial_balance(g)


@query("A-08", sql="SELECT * FROM g_monthly", real=["revenue_amount", "expense_amount"])
def pl_monthly(g: Given) -> DataFrame:
    return op.pl_monthly(totals(g))


@query("A-09", sql="SELECT * FROM g_pivot", real=STATEMENT[:5])
def pl_pivot(g: Given) -> DataFrame:
    return op.pl_pivot(op.pl_monthly(totals(g)))


@query("A-10", sql="SELECT * FROM g_statement", real=STATEMENT, ratios=MARGINS)
def income_statement(g: Given) -> DataFrame:
    return statement(g)


@query("A-11", sql="SELECT * FROM g_actuals", real=["actual_debits", "actual_credits", "actual_net"])
def actuals(g: Given) -> DataFrame:
    return op.actuals(totals(g))


@query(
    "J-10",
    sql="""
    SELECT fiscal_period_id, account_id, cost_center_id, budget_amount, budget_type,
      actual_debits, actual_credits, actual_net
    FROM g_budgets FULL OUTER JOIN g_actuals USING (fiscal_period_id, account_id, cost_center_id)""",
    real=["budget_amount", "actual_debits", "actual_credits", "actual_net"],
)
def budget_join(g: Given) -> DataFrame:
    return op.budget_join(budgets(g), op.actuals(totals(g)))


@query("A-12", "J-10", "J-11", sql="SELECT * FROM g_variance",
       real=["budget_amount", "actual_amount", "variance_amount"], ratios=["variance_pct"])
def budget_vs_actuals(g: Given) -> DataFrame:
    return variance(g)


@query(
    "A-25",
    sql="""
    SELECT journal_entry_id, sum(debit_amount) AS total_debits, sum(credit_amount) AS total_credits,
      abs(sum(debit_amount) - sum(credit_amount)) AS imbalance
    FROM g_lines GROUP BY journal_entry_id""",
    real=["total_debits", "total_credits", "imbalance"],
)
def je_totals(g: Given) -> DataFrame:
    return op.je_totals(lines(g))


@query(
    "A-25",
    sql="""
    SELECT fiscal_period_id, sum(total_debits) AS period_debits, sum(total_credits) AS period_credits,
      abs(sum(total_debits) - sum(total_credits)) AS period_imbalance
    FROM g_trial GROUP BY fiscal_period_id""",
    real=["period_debits", "period_credits", "period_imbalance"],
)
def period_totals(g: Given) -> DataFrame:
    return op.period_totals(trial_balance(g))


@query(
    "J-18",
    sql="""
    SELECT journal_entry_id, posting_date, fiscal_period_id, period_is_closed AS is_closed
    FROM gl WHERE period_is_closed = 1 AND je_status = 'Posted'""",
    text=["posting_date"],
)
def closed_period_postings(g: Given) -> DataFrame:
    return op.closed_period_postings(rows(g), periods(g))


@query("F-14", sql="""
    SELECT CAST(o_orderkey AS BIGINT) AS order_key, CAST(month(o_orderdate) AS INTEGER) AS month,
      'Q' || quarter(o_orderdate) AS fiscal_quarter FROM orders""")
def fiscal_quarter(g: Given) -> DataFrame:
    return g.table("orders").select(
        F.col("o_orderkey").alias("order_key"), F.month("o_orderdate").alias("month")
    ).withColumn("fiscal_quarter", quarter_of(F.col("month")))

"""General ledger: staging, transactions, balances, statements, budget variance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orewright.functions.bands import ladder
from orewright.functions.dates import day, stamp
from orewright.functions.keys import surrogate_key
from orewright.functions.numbers import exact_ratio, ledger_money, whole
from orewright.functions.text import fixed_width, pieces, trimmed, truth_flag
from orewright.operators.grains import assign_period
from orewright.operators.shaping import conform


def _id(size: int):
    return lambda col: fixed_width(col, size)


# Entry statuses that count as postings.
POSTED_STATUSES = ("Posted", "Reversed")

# Account types and the side their balance normally falls on.
DEBIT_TYPES = ("Asset", "Expense")
CREDIT_TYPES = ("Liability", "Equity", "Revenue")

# Account subgroups of the income statement and the columns they become.
STATEMENT_LINES = {
    "Operating Revenue": ("operating_revenue", "revenue_amount"),
    "Non-operating Revenue": ("other_revenue", "revenue_amount"),
    "Cost of Revenue": ("cost_of_revenue", "expense_amount"),
    "Operating Expenses": ("operating_expenses", "expense_amount"),
    "Non-operating Expenses": ("non_operating_expenses", "expense_amount"),
}

ACCOUNT_COLUMNS = ("account_name", "account_type", "financial_statement", "account_subgroup")
PERIOD_COLUMNS = ("fiscal_period_id", "fiscal_year", "fiscal_month", "fiscal_quarter")


# --- staging -------------------------------------------------------------------------


def stg_journal_entries(raw: DataFrame) -> DataFrame:
    """Typed headers of posted and reversed entries.

    The status is compared as it arrived, before trimming: padded statuses drop out.
    """
    kept = raw.filter(F.col("status").isin(*POSTED_STATUSES))
    rules = {
        "journal_entry_id": _id(20), "posting_date": day, "description": trimmed,
        "source_system": trimmed, "created_by": trimmed, "status": trimmed, "created_at": stamp,
    }
    return conform(kept, rules).select(*rules)


def stg_journal_entry_lines(raw: DataFrame) -> DataFrame:
    rules = {
        "journal_entry_id": _id(20), "line_number": whole, "account_id": _id(10),
        "cost_center_id": _id(10), "debit_amount": ledger_money, "credit_amount": ledger_money,
    }
    net = F.col("debit_amount") - F.col("credit_amount")
    return conform(raw, rules).select(
        *rules, net.alias("net_amount"), F.trim("line_description").alias("line_description")
    )


def stg_chart_of_accounts(raw: DataFrame) -> DataFrame:
    rules = {"account_id": _id(10), **dict.fromkeys(ACCOUNT_COLUMNS, trimmed), "is_active": truth_flag}
    return conform(raw, rules).select(*rules)


def stg_cost_centers(raw: DataFrame) -> DataFrame:
    rules = {
        "cost_center_id": _id(10), "cost_center_name": trimmed, "department_group": trimmed,
        "manager_name": trimmed, "is_active": truth_flag,
    }
    return conform(raw, rules).select(*rules)


def stg_fiscal_periods(raw: DataFrame) -> DataFrame:
    rules = {
        "fiscal_period_id": _id(10), "fiscal_year": whole, "fiscal_month": whole,
        "fiscal_quarter": trimmed, "period_start_date": day, "period_end_date": day,
        "is_closed": truth_flag,
    }
    return conform(raw, rules).select(*rules)


def stg_budget_allocations(raw: DataFrame) -> DataFrame:
    rules = {
        "fiscal_period_id": _id(10), "account_id": _id(10), "cost_center_id": _id(10),
        "budget_amount": ledger_money, "budget_type": trimmed,
    }
    return conform(raw, rules).select(*rules)


# --- dimensions ----------------------------------------------------------------------


def dim_accounts(accounts: DataFrame) -> DataFrame:
    kind = F.col("account_type")
    side = ladder([(kind.isin(*DEBIT_TYPES), "Debit"), (kind.isin(*CREDIT_TYPES), "Credit")])
    return accounts.select(
        surrogate_key(F.col("account_id")).alias("account_key"),
        "account_id", *ACCOUNT_COLUMNS, "is_active", side.alias("normal_balance_type"),
    )


def dim_cost_centers(centers: DataFrame) -> DataFrame:
    return centers.select(
        surrogate_key(F.col("cost_center_id")).alias("cost_center_key"),
        "cost_center_id", "cost_center_name", "department_group", "manager_name", "is_active",
    )


def dim_fiscal_periods(periods: DataFrame) -> DataFrame:
    name = pieces(
        "FY", F.col("fiscal_year"), " ", F.col("fiscal_quarter"), " - M", F.col("fiscal_month")
    )
    return periods.select(
        surrogate_key(F.col("fiscal_period_id")).alias("fiscal_period_key"),
        *PERIOD_COLUMNS, "period_start_date", "period_end_date", "is_closed",
        name.alias("period_display_name"),
    )


# --- transactions --------------------------------------------------------------------


def gl_transactions(
    lines: DataFrame, headers: DataFrame, accounts: DataFrame, centers: DataFrame, periods: DataFrame
) -> DataFrame:
    """One row per entry line with account, cost center and period attributes.

    Periods meet the headers, which are fewer than the lines; the one large join is lines
    to headers; names are attached after it so they are not shuffled. Both sides of that
    join grow with the ledger, so it is asked to be a sort-merge join whatever its files
    look like to the planner.
    """
    keys = [c for c in ("fiscal_period_key",) if c in periods.columns]
    spans = periods.select(
        *PERIOD_COLUMNS, *keys, "period_start_date", "period_end_date",
        F.col("is_closed").alias("period_is_closed"),
    )
    dated = assign_period(headers, spans, "posting_date").select(
        "journal_entry_id", "posting_date", F.col("description").alias("je_description"),
        "source_system", "created_by", F.col("status").alias("je_status"),
        *PERIOD_COLUMNS, *keys, "period_is_closed",
    )
    return (
        lines.join(dated.hint("merge"), "journal_entry_id")
        .join(accounts.drop("is_active", "normal_balance_type"), "account_id")
        .join(centers.drop("is_active", "manager_name"), "cost_center_id")
    )


def gl_totals(
    lines: DataFrame, headers: DataFrame, accounts: DataFrame, centers: DataFrame, periods: DataFrame
) -> DataFrame:
    """The transactions summed to status x period x account x cost center.

    Every statement is a sum over this, so it is what they are built from: the join to the
    headers carries keys and amounts only, partial sums collapse it, and the attributes
    join the few totals. The amount columns keep their names; a row-level frame from
    ``gl_transactions`` may be passed wherever this one is.
    """
    spans = periods.select("fiscal_period_id", "period_start_date", "period_end_date")
    dated = assign_period(headers, spans, "posting_date").select(
        "journal_entry_id", F.col("status").alias("je_status"), "fiscal_period_id"
    )
    amounts = ("debit_amount", "credit_amount", "net_amount")
    summed = (
        lines.select("journal_entry_id", "account_id", "cost_center_id", *amounts)
        .join(dated.hint("merge"), "journal_entry_id")
        .groupBy("je_status", "fiscal_period_id", "account_id", "cost_center_id")
        .agg(*[F.sum(a).alias(a) for a in amounts])
    )
    named = periods.select(*PERIOD_COLUMNS, F.col("is_closed").alias("period_is_closed"))
    return (
        summed.join(accounts.drop("is_active"), "account_id")
        .join(centers.drop("is_active", "manager_name"), "cost_center_id")
        .join(named, "fiscal_period_id")
    )


def fact_gl_activity(
    gl: DataFrame, accounts: DataFrame, centers: DataFrame, periods: DataFrame
) -> DataFrame:
    """Row-level fact on surrogate keys, every status kept.

    Transactions that were built from the dimensions carry the keys already; others look them up.
    """
    for dim, name, key in (
        (accounts, "account_id", "account_key"), (centers, "cost_center_id", "cost_center_key"),
        (periods, "fiscal_period_id", "fiscal_period_key"),
    ):
        if key not in gl.columns:
            gl = gl.join(dim.select(name, key), name)
    return gl.select(
        "account_key", "cost_center_key", "fiscal_period_key", "journal_entry_id", "line_number",
        "posting_date", "je_description", "source_system", "je_status", "debit_amount",
        "credit_amount", "net_amount",
    )


def posted(gl: DataFrame) -> DataFrame:
    return gl.filter(F.col("je_status") == "Posted")


# --- balances ------------------------------------------------------------------------


def period_activity(gl: DataFrame) -> DataFrame:
    return posted(gl).groupBy(*PERIOD_COLUMNS, "account_id", *ACCOUNT_COLUMNS).agg(
        F.sum("debit_amount").alias("total_debits"),
        F.sum("credit_amount").alias("total_credits"),
        F.sum("net_amount").alias("net_activity"),
    )


def account_balances(activity: DataFrame) -> DataFrame:
    """Running balance for balance-sheet accounts, period activity for the others.

    The window sees one row per account and period that had activity, so a partition is at
    most as long as the calendar has periods. Periods without activity are not added.
    """
    so_far = Window.partitionBy("account_id").orderBy("fiscal_year", "fiscal_month").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = F.sum("net_activity").over(so_far)
    carried = F.col("financial_statement") == "Balance Sheet"
    return activity.withColumn(
        "ending_balance", F.when(carried, running).otherwise(F.col("net_activity"))
    )


def rpt_trial_balance(balances: DataFrame) -> DataFrame:
    """Balances with credit-normal accounts shown as positive."""
    flipped = F.col("account_type").isin(*CREDIT_TYPES)
    shown = F.when(flipped, -F.col("ending_balance")).otherwise(F.col("ending_balance"))
    return balances.withColumn("reported_balance", shown)


# --- income statement ----------------------------------------------------------------


def _signed(kind: str) -> Column:
    """Amount of an account type with its normal side positive; 0 for other types."""
    sides = ("credit_amount", "debit_amount") if kind in CREDIT_TYPES else ("debit_amount", "credit_amount")
    amount = F.col(sides[0]) - F.col(sides[1])
    return F.when(F.col("account_type") == kind, amount).otherwise(0)


def pl_monthly(gl: DataFrame) -> DataFrame:
    return posted(gl).groupBy(*PERIOD_COLUMNS, "account_subgroup").agg(
        F.sum(_signed("Revenue")).alias("revenue_amount"),
        F.sum(_signed("Expense")).alias("expense_amount"),
    )


def pl_pivot(monthly: DataFrame) -> DataFrame:
    """One column per statement line; 0 where a period has no such account."""
    picked = [
        F.sum(F.when(F.col("account_subgroup") == group, F.col(source)).otherwise(0)).alias(name)
        for group, (name, source) in STATEMENT_LINES.items()
    ]
    return monthly.groupBy(*PERIOD_COLUMNS).agg(*picked)


def income_statement(gl: DataFrame) -> DataFrame:
    lines = pl_pivot(pl_monthly(gl))
    revenue, cost = F.col("operating_revenue"), F.col("cost_of_revenue")
    gross = revenue - cost
    operating = gross - F.col("operating_expenses")

    def margin(amount: Column) -> Column:
        return F.when(revenue > 0, exact_ratio(amount, revenue)).otherwise(0)

    return lines.withColumns(
        {
            "total_revenue": revenue + F.col("other_revenue"),
            "gross_profit": gross,
            "operating_income": operating,
            "net_income": operating + F.col("other_revenue") - F.col("non_operating_expenses"),
            "gross_margin_pct": margin(gross),
            "operating_margin_pct": margin(operating),
        }
    )


# --- budget --------------------------------------------------------------------------

BUDGET_KEYS = ("fiscal_period_id", "account_id", "cost_center_id")


def actuals(gl: DataFrame) -> DataFrame:
    return posted(gl).groupBy(*BUDGET_KEYS).agg(
        F.sum("debit_amount").alias("actual_debits"),
        F.sum("credit_amount").alias("actual_credits"),
        F.sum("net_amount").alias("actual_net"),
    )


def budget_join(budgets: DataFrame, actual: DataFrame) -> DataFrame:
    """Full outer join on the three keys; both sides are aggregates of one row per key."""
    return budgets.join(actual, list(BUDGET_KEYS), "full_outer")


def budget_vs_actuals(
    budgets: DataFrame, actual: DataFrame, accounts: DataFrame, centers: DataFrame, periods: DataFrame
) -> DataFrame:
    both = (
        budget_join(budgets.drop("budget_type"), actual)
        .join(accounts.select("account_id", "account_name", "account_type", "account_subgroup"),
              "account_id", "left")
        .join(centers.select("cost_center_id", "cost_center_name", "department_group"),
              "cost_center_id", "left")
        .join(periods.select(*PERIOD_COLUMNS), "fiscal_period_id", "left")
    )
    kind = F.col("account_type")
    earned = F.col("actual_credits") - F.col("actual_debits")
    signed = F.when(kind == "Revenue", earned).otherwise(-earned)
    sized = both.select(
        *BUDGET_KEYS,
        F.coalesce("budget_amount", F.lit(0)).alias("budget_amount"),
        F.coalesce(signed, F.lit(0)).alias("actual_amount"),
        "account_name", "account_type", "account_subgroup", "cost_center_name", "department_group",
        "fiscal_year", "fiscal_month", "fiscal_quarter",
    )
    planned, done = F.col("budget_amount"), F.col("actual_amount")
    good = F.when(kind == "Revenue", done >= planned).when(kind == "Expense", done <= planned)
    return sized.withColumns(
        {
            "variance_amount": done - planned,
            "variance_pct": exact_ratio(done - planned, planned),
            "variance_status": ladder([(good, "Favorable"), (~good, "Unfavorable")], "N/A"),
        }
    )


# --- control totals ------------------------------------------------------------------


def je_totals(lines: DataFrame) -> DataFrame:
    """Debits, credits and their distance per entry, over lines of every status."""
    debits, credits = F.sum("debit_amount"), F.sum("credit_amount")
    return lines.groupBy("journal_entry_id").agg(
        debits.alias("total_debits"), credits.alias("total_credits"),
        F.abs(debits - credits).alias("imbalance"),
    )


def period_totals(trial_balance: DataFrame) -> DataFrame:
    debits, credits = F.sum("total_debits"), F.sum("total_credits")
    return trial_balance.groupBy("fiscal_period_id").agg(
        debits.alias("period_debits"), credits.alias("period_credits"),
        F.abs(debits - credits).alias("period_imbalance"),
    )


def closed_period_postings(gl: DataFrame, periods: DataFrame) -> DataFrame:
    """Posted lines whose period is closed."""
    closed = periods.filter(F.col("is_closed") == 1).select("fiscal_period_id", "is_closed")
    return posted(gl).select("journal_entry_id", "posting_date", "fiscal_period_id").join(
        closed, "fiscal_period_id"
    )


def drill_through(fact: DataFrame, accounts: DataFrame, centers: DataFrame) -> DataFrame:
    """Fact lines with the names of their account and cost center."""
    return fact.join(
        accounts.select("account_key", "account_id", "account_name", "account_type"), "account_key"
    ).join(centers.select("cost_center_key", "cost_center_name"), "cost_center_key")


def revenue_by_year(statement: DataFrame, this_year: Column) -> DataFrame:
    """Revenue per month, the given fiscal year beside the one before."""
    year, revenue = F.col("fiscal_year"), F.col("total_revenue")
    return (
        statement.withColumn("_this", this_year)
        .groupBy("fiscal_month")
        .agg(
            F.sum(F.when(year == F.col("_this"), revenue)).alias("revenue_this_year"),
            F.sum(F.when(year == F.col("_this") - 1, revenue)).alias("revenue_prior_year"),
        )
    )

from datetime import date
from decimal import Decimal as D

import pytest
from conftest import values

from orewright.operators import ledger, quality
from orewright.operators.grains import assign_period

ACCOUNTS = [
    ("1010", "Cash", "Asset", "Balance Sheet", "Current Assets", "TRUE"),
    ("2010", "Payables", "Liability", "Balance Sheet", "Current Liabilities", "true"),
    ("4010", "Sales", "Revenue", "Income Statement", "Operating Revenue", "TRUE"),
    ("4910", "Interest", "Revenue", "Income Statement", "Non-operating Revenue", "FALSE"),
    ("5010", "Goods", "Expense", "Income Statement", "Cost of Revenue", None),
    ("6010", "Pay", "Expense", "Income Statement", "Operating Expenses", "TRUE"),
]
PERIODS = [
    ("FY2024-01", "2024", "1", "Q1", "2024-01-01", "2024-01-31", "TRUE"),
    ("FY2024-02", "2024", "2", "Q1", "2024-02-01", "2024-02-29", "TRUE"),
    ("FY2024-03", "2024", "3", "Q1", "2024-03-01", "2024-03-31", "FALSE"),
]
CENTERS = [("CC1", " North ", "G&A", "Bo", "TRUE")]
ENTRY = ("journal_entry_id string, posting_date string, description string, source_system string, created_by string, "
         "status string, created_at string")
LINE = ("journal_entry_id string, line_number string, account_id string, cost_center_id string, debit_amount string, "
        "credit_amount string, line_description string")


def entry(i, day, status="Posted"):
    return (i, day, " d ", "ERP", "u", status, f"{day} 08:00:00")


def pair(i, debit, credit, amount, other=None):
    return [(i, "1", debit, "CC1", amount, "0", "x"), (i, "2", credit, "CC1", "0", other or amount, "x")]


@pytest.fixture
def books(spark):
    def make(entries, lines):
        acct = spark.createDataFrame(ACCOUNTS, "account_id string, account_name string, account_type string, "
                                     "financial_statement string, account_subgroup string, is_active string")
        per = spark.createDataFrame(PERIODS, "fiscal_period_id string, fiscal_year string, fiscal_month string, "
                                    "fiscal_quarter string, period_start_date string, period_end_date string, is_closed string")
        cc = spark.createDataFrame(CENTERS, "cost_center_id string, cost_center_name string, department_group string, "
                                   "manager_name string, is_active string")
        return dict(
            lines=ledger.stg_journal_entry_lines(spark.createDataFrame(lines, LINE)),
            headers=ledger.stg_journal_entries(spark.createDataFrame(entries, ENTRY)),
            accounts=ledger.stg_chart_of_accounts(acct), centers=ledger.stg_cost_centers(cc),
            periods=ledger.stg_fiscal_periods(per))

    return make


@pytest.fixture
def ledger_books(books):
    entries = [entry("a", "2024-01-01"), entry("b", "2024-01-31"), entry("c", "2024-03-15"),
               entry("r", "2024-02-10", "Reversed"), entry("d", "2024-02-10", "Draft"),
               entry("p", "2024-02-10", " Posted "), entry("o", "2025-01-01")]
    lines = (pair("a", "1010", "4010", "100.00") + pair("b", "5010", "1010", "30.00")
             + pair("c", "1010", "4910", "7.00") + pair("r", "1010", "4010", "50.00")
             + pair("d", "1010", "4010", "1.00") + pair("p", "1010", "4010", "1.00")
             + pair("o", "1010", "4010", "1.00") + [("a", "3", "9999", "CC1", "5", "0", "x")])
    return books(entries, lines)


def test_status_is_compared_before_trimming(ledger_books):
    assert values(ledger_books["headers"], "journal_entry_id") == [("a",), ("b",), ("c",), ("o",), ("r",)]


def test_bad_amounts_become_null_and_flags_are_numbers(books):
    b = books([entry("a", "2024-01-01")], [("a", "x", "1010", "CC1", "abc", "1", " t ")])
    row = b["lines"].first()
    assert (row.line_number, row.debit_amount, row.net_amount, row.line_description) == (None, None, None, "t")
    assert values(b["accounts"], "account_id", "is_active") == [
        ("1010", 1), ("2010", 1), ("4010", 1), ("4910", 0), ("5010", 0), ("6010", 1)]


def test_transactions_hold_both_ends_of_a_period_and_drop_what_is_outside(ledger_books):
    gl = ledger.gl_transactions(**ledger_books)
    got = {(r.journal_entry_id, r.fiscal_period_id) for r in gl.collect()}
    assert got == {("a", "FY2024-01"), ("b", "FY2024-01"), ("c", "FY2024-03"), ("r", "FY2024-02")}
    # The line on an unknown account is gone.
    assert gl.count() == 8


def test_statements_are_the_same_from_rows_and_from_totals(ledger_books):
    rows, totals = ledger.gl_transactions(**ledger_books), ledger.gl_totals(**ledger_books)
    for report in (ledger.period_activity, ledger.income_statement, ledger.actuals, ledger.pl_monthly):
        a, b = report(rows), report(totals)
        assert values(a, *sorted(a.columns)) == values(b, *sorted(a.columns))


def test_running_balance_is_for_balance_sheet_accounts_and_is_not_densified(ledger_books):
    balances = ledger.rpt_trial_balance(
        ledger.account_balances(ledger.period_activity(ledger.gl_totals(**ledger_books))))
    got = values(balances, "account_id", "fiscal_month", "ending_balance", "reported_balance")
    assert got == [("1010", 1, D("70.00"), D("70.00")), ("1010", 3, D("77.00"), D("77.00")),
                   ("4010", 1, D("-100.00"), D("100.00")), ("4910", 3, D("-7.00"), D("7.00")),
                   ("5010", 1, D("30.00"), D("30.00"))]


def test_income_statement_lines_and_margins(ledger_books):
    got = {r.fiscal_period_id: r for r in ledger.income_statement(ledger.gl_totals(**ledger_books)).collect()}
    jan, mar = got["FY2024-01"], got["FY2024-03"]
    assert set(got) == {"FY2024-01", "FY2024-03"}
    assert (jan.total_revenue, jan.gross_profit, jan.operating_income, jan.net_income) == (
        D("100.00"), D("70.00"), D("70.00"), D("70.00"))
    assert (float(jan.gross_margin_pct), float(mar.gross_margin_pct), mar.net_income) == (0.7, 0.0, D("7.00"))


def test_budget_variance_over_a_full_outer_join(ledger_books, frame):
    budgets = ledger.stg_budget_allocations(frame(
        [("FY2024-01", "4010", "CC1", "120", "R"), ("FY2024-01", "5010", "CC1", "30", "E"),
         ("FY2024-02", "6010", "CC1", "10", "E"), ("FY2024-03", "4910", "CC1", "0", "R"),
         ("FY2030-01", "7777", "CC9", "4", "E")],
        "fiscal_period_id string, account_id string, cost_center_id string, budget_amount string, budget_type string"))
    report = ledger.budget_vs_actuals(
        budgets, ledger.actuals(ledger.gl_totals(**ledger_books)), ledger_books["accounts"],
        ledger_books["centers"], ledger_books["periods"])
    got = {(r.fiscal_period_id, r.account_id): r for r in report.collect()}
    assert len(got) == 7
    sales = got["FY2024-01", "4010"]
    assert (sales.variance_amount, float(sales.variance_pct), sales.variance_status) == (
        D("-20.00"), pytest.approx(-1 / 6), "Unfavorable")
    assert got["FY2024-01", "5010"].variance_status == "Favorable"
    # A budget without actuals, actuals on a zero budget, a balance-sheet account, unknown keys.
    assert (got["FY2024-02", "6010"].actual_amount, got["FY2024-02", "6010"].variance_status) == (0, "Favorable")
    assert (got["FY2024-03", "4910"].variance_pct, got["FY2024-03", "4910"].variance_status) == (None, "Favorable")
    assert (got["FY2024-01", "1010"].budget_amount, got["FY2024-01", "1010"].variance_status) == (0, "N/A")
    assert (got["FY2030-01", "7777"].fiscal_year, got["FY2030-01", "7777"].variance_status) == (None, "N/A")


def test_star_fact_keeps_reversed_entries_and_joins_on_surrogate_keys(ledger_books):
    da, dc, dp = (ledger.dim_accounts(ledger_books["accounts"]), ledger.dim_cost_centers(ledger_books["centers"]),
                  ledger.dim_fiscal_periods(ledger_books["periods"]))
    fact = ledger.fact_gl_activity(ledger.gl_transactions(**ledger_books), da, dc, dp)
    assert {r.je_status for r in fact.collect()} == {"Posted", "Reversed"}
    assert values(da, "account_id", "normal_balance_type")[:3] == [
        ("1010", "Debit"), ("2010", "Credit"), ("4010", "Credit")]
    assert values(dp, "period_display_name")[0] == ("FY2024 Q1 - M1",)
    for column, dim in (("account_key", da), ("cost_center_key", dc), ("fiscal_period_key", dp)):
        assert quality.relationships(fact, column, dim, column).count() == 0


def test_the_range_join_is_a_hash_join_on_days(ledger_books):
    joined = assign_period(ledger_books["headers"], ledger_books["periods"], "posting_date")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert joined.count() == 4


def test_overlapping_periods_give_a_row_each(frame):
    dates = frame([(date(2024, 1, 2),)], "d date")
    spans = frame([("x", date(2024, 1, 1), date(2024, 1, 2)), ("y", date(2024, 1, 2), date(2024, 1, 3))],
                  "p string, period_start_date date, period_end_date date")
    assert values(assign_period(dates, spans, "d"), "p") == [("x",), ("y",)]


def test_entry_balance_tolerance(books):
    lines = (pair("ok", "1010", "4010", "10.00") + pair("near", "1010", "4010", "10.02", "10.00")
             + pair("edge", "1010", "4010", "10.05", "10.00") + pair("off", "1010", "4010", "10.06", "10.00"))
    b = books([entry("ok", "2024-01-01", "Draft")], lines)
    assert values(quality.je_balanced(b["lines"]), "journal_entry_id") == [("off",)]
    assert values(quality.je_balanced(b["lines"], "0.01"), "journal_entry_id") == [("edge",), ("near",), ("off",)]


def test_closed_periods_report_only_when_enforced(ledger_books):
    gl = ledger.gl_transactions(**ledger_books)
    assert quality.no_postings_to_closed_periods(gl, ledger_books["periods"]).count() == 0
    found = quality.no_postings_to_closed_periods(gl, ledger_books["periods"], enforce=True)
    assert {r.journal_entry_id for r in found.collect()} == {"a", "b"}

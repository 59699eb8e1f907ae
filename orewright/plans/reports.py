"""Report queries: metric by dimension, with the report's filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orewright.functions.numbers import safe_divide
from orewright.operators import grains
from orewright.operators import ledger as gl
from orewright.operators import metrics as op
from orewright.operators import retail as retail_op
from orewright.operators.shaping import slice_rows
from orewright.plans import integrate, ledger, metrics, retail, workforce
from orewright.plans.checks import COUNTED
from orewright.plans.registry import query
from orewright.sources.adapters import Given, calendar_bounds


@query("V-01", "M-01", "M-09", "P-22", sql=f"""
    SELECT "Order_Bucket", recognized_revenue,
      CAST(recognized_revenue AS DOUBLE) / CAST(sum(recognized_revenue) OVER () AS DOUBLE) AS revenue_pct_of_total
    FROM (SELECT "Order_Bucket", sum(CASE WHEN {COUNTED} THEN net_sales END) AS recognized_revenue
          FROM r_fact f LEFT JOIN r_dim_customer c ON f.customer_id = c.customer_id GROUP BY ALL)
    WHERE "Order_Bucket" IS NOT NULL""", real=["recognized_revenue"], ratios=["revenue_pct_of_total"])
def report_revenue_by_bucket(g: Given) -> DataFrame:
    totals = slice_rows(op.bucket_revenue(retail.sales(g), retail.customers(g)), not_null=["Order_Bucket"])
    shared = grains.pct_of_total(totals, "recognized_revenue", "Order_Bucket", name="revenue_pct_of_total")
    return shared.orderBy("Order_Bucket")


@query("V-02", "M-01", sql=f"""
    SELECT CAST(month(order_date) AS INTEGER) AS month, sum(CASE WHEN {COUNTED} THEN net_sales END) AS recognized_revenue
    FROM r_fact WHERE order_date < DATE '2027-01-01' GROUP BY 1""", real=["recognized_revenue"])
def report_revenue_by_month(g: Given) -> DataFrame:
    """Months of all years together, through the date dimension; days are totalled before they meet it."""
    days = slice_rows(
        op.evaluate(retail.sales(g), ["recognized_revenue"], ["order_date"]), below={"order_date": "2027-01-01"}
    )
    calendar = retail_op.date_dim(calendar_bounds(g)).select(F.col("date_key").alias("order_date"), "month")
    months = days.join(calendar, "order_date").groupBy("month").agg(
        F.sum("recognized_revenue").alias("recognized_revenue")
    )
    return months.orderBy(F.desc("recognized_revenue"))


@query("V-03", "M-01", sql=f"""
    SELECT channel, sum(CASE WHEN {COUNTED} THEN net_sales END) AS recognized_revenue FROM r_fact GROUP BY channel""",
       real=["recognized_revenue"])
def report_revenue_by_channel(g: Given) -> DataFrame:
    return op.evaluate(retail.sales(g), ["recognized_revenue"], ["channel"]).orderBy(F.desc("recognized_revenue"))


@query("V-03", "M-01", sql=f"""
    SELECT category, sum(CASE WHEN {COUNTED} THEN net_sales END) AS recognized_revenue
    FROM r_fact f LEFT JOIN r_products p ON f.product_id = p.product_id GROUP BY category""", real=["recognized_revenue"])
def report_revenue_by_category(g: Given) -> DataFrame:
    return op.evaluate(metrics.lines(g), ["recognized_revenue"], ["category"]).orderBy(F.desc("recognized_revenue"))


@query("V-04", "M-01", "M-04", "M-06", "M-07", sql=f"SELECT {metrics.RETAIL_SQL}",
       real=metrics.RETAIL_REAL, ratios=["aov"])
def report_kpi_cards(g: Given) -> DataFrame:
    return op.evaluate(op.order_grain(metrics.lines(g), []), metrics.RETAIL, one_row_per_key=True)


@query("V-05", "A-24", sql="""SELECT "Order_Bucket", count(customer_id) AS customers FROM r_dim_customer GROUP BY 1""")
def customers_by_bucket(g: Given) -> DataFrame:
    return retail.dim_customer_of(g).groupBy("Order_Bucket").agg(F.count("customer_id").alias("customers"))


@query("V-06", "M-10", "M-15", sql="""
    SELECT department_name, max(budgeted_headcount) AS budgeted_headcount, max(n) AS total_headcount, max(active) AS active_employees
    FROM (SELECT department_name, CAST(sum(head_count_budget) AS BIGINT) AS budgeted_headcount, 0 AS n, 0 AS active
        FROM h_departments GROUP BY 1
      UNION ALL SELECT department_name, NULL, count(DISTINCT employee_id),
        count(DISTINCT CASE WHEN is_active THEN employee_id END)
      FROM h_employees e LEFT JOIN h_departments d ON e.department_id = d.department_id GROUP BY 1)
    GROUP BY department_name""")
def report_headcount_vs_budget(g: Given) -> DataFrame:
    held = op.workforce_by(workforce.employees(g), workforce.departments(g), "department_name")
    return held.select("department_name", "budgeted_headcount", "total_headcount", "active_employees")


@query("V-06", "M-30", sql="SELECT gender, count(DISTINCT employee_id) AS total_headcount FROM h_employees GROUP BY gender")
def report_gender_split(g: Given) -> DataFrame:
    return op.evaluate(workforce.employees(g), ["total_headcount"], ["gender"])


@query("V-06", "M-18", sql="""
    SELECT r.review_cycle, avg(overall_rating) AS average_rating, count(*) AS review_count
    FROM h_reviews r JOIN h_employees e ON r.employee_id = e.employee_id GROUP BY 1""", ratios=["average_rating"])
def report_rating_trend(g: Given) -> DataFrame:
    facts = workforce.op.fact_performance(workforce.reviews(g), workforce.employees(g))
    return op.evaluate(facts, ["average_rating", "review_count"], ["review_cycle"]).orderBy("review_cycle")


@query("V-06", "M-23", "M-26", sql="""
    SELECT tenure_years, count(DISTINCT employee_id) AS total_headcount, avg(salary) AS average_salary
    FROM h_employees GROUP BY tenure_years""", ratios=["average_salary"])
def report_salary_vs_tenure(g: Given) -> DataFrame:
    return op.evaluate(workforce.employees(g), ["total_headcount", "average_salary"], ["tenure_years"])


@query("V-07", sql="""
    SELECT journal_entry_id, account_id, account_name, account_type, cost_center_name, sum(debit_amount) AS debits,
      sum(credit_amount) AS credits FROM gl GROUP BY ALL""", real=["debits", "credits"])
def report_gl_drill_through(g: Given) -> DataFrame:
    """Entry totals by account and cost center, from the star fact and its dimensions.

    Summed once, under what is shown: hardly a line shares its entry, account and center with another, so sums by key
    in between would hold every line once more.
    """
    named = gl.drill_through(ledger.fact(g), gl.dim_accounts(ledger.accounts(g)), gl.dim_cost_centers(ledger.centers(g)))
    shown = ["journal_entry_id", "account_id", "account_name", "account_type", "cost_center_name"]
    return named.groupBy(*shown).agg(F.sum("debit_amount").alias("debits"), F.sum("credit_amount").alias("credits"))


@query("V-09", "A-10", sql="""
    SELECT fiscal_month, sum(total_revenue) FILTER (fiscal_year = y) AS revenue_this_year,
      sum(total_revenue) FILTER (fiscal_year = y - 1) AS revenue_prior_year
    FROM g_statement, (SELECT max(fiscal_year) AS y FROM g_periods) GROUP BY fiscal_month""",
       real=["revenue_this_year", "revenue_prior_year"])
def report_executive_summary(g: Given) -> DataFrame:
    """Monthly revenue of the last fiscal year beside the year before."""
    last = ledger.periods(g).agg(F.max("fiscal_year").alias("y")).scalar()
    return gl.revenue_by_year(ledger.statement(g), last).orderBy("fiscal_month")


@query("V-09", "A-10", sql="""
    SELECT fiscal_year, sum(total_revenue) AS total_revenue, sum(gross_profit) AS gross_profit, sum(net_income) AS net_income,
      coalesce(CAST(sum(gross_profit) AS DOUBLE) / nullif(CAST(sum(operating_revenue) AS DOUBLE), 0), 0) AS gross_margin_pct
    FROM g_statement GROUP BY fiscal_year""",
       real=["total_revenue", "gross_profit", "net_income"], ratios=["gross_margin_pct"])
def report_year_kpis(g: Given) -> DataFrame:
    sums = ("total_revenue", "gross_profit", "net_income")
    return ledger.statement(g).groupBy("fiscal_year").agg(
        *[F.sum(c).alias(c) for c in sums],
        safe_divide(F.sum("gross_profit"), F.sum("operating_revenue"), 0).alias("gross_margin_pct"),
    )


BUDGET_SUMS = """sum(budget_amount) AS budget_amount, sum(actual_amount) AS actual_amount,
      sum(variance_amount) AS variance_amount FROM g_variance"""
BUDGET_COLUMNS = ["budget_amount", "actual_amount", "variance_amount"]


@query("V-10", "A-12", sql=f"SELECT cost_center_name, {BUDGET_SUMS} GROUP BY cost_center_name", real=BUDGET_COLUMNS)
def report_budget_by_cost_center(g: Given) -> DataFrame:
    return ledger.variance(g).groupBy("cost_center_name").agg(*[F.sum(c).alias(c) for c in BUDGET_COLUMNS])


@query("V-10", "A-12", sql=f"""
    SELECT fiscal_period_id, variance_status, count(*) AS lines, {BUDGET_SUMS} GROUP BY fiscal_period_id, variance_status""",
       real=BUDGET_COLUMNS)
def report_variance_detail(g: Given) -> DataFrame:
    return ledger.variance(g).groupBy("fiscal_period_id", "variance_status").agg(
        F.count(F.lit(1)).alias("lines"), *[F.sum(c).alias(c) for c in BUDGET_COLUMNS]
    )


@query("V-11", "J-14", sql="""
    SELECT region, count(crm_customer_id) AS customers, CAST(sum(total_orders) AS BIGINT) AS total_orders,
      sum(total_spend) AS total_spend FROM x_360 GROUP BY region""", real=["total_spend"])
def report_customer_360(g: Given) -> DataFrame:
    return integrate.c360(g).groupBy("region").agg(
        F.count("crm_customer_id").alias("customers"), F.sum("total_orders").alias("total_orders"),
        F.sum("total_spend").alias("total_spend"),
    )

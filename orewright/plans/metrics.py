"""Named-metric queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orewright.functions.numbers import safe_divide
from orewright.operators import grains
from orewright.operators import metrics as op
from orewright.plans import ledger, retail, workforce
from orewright.plans.checks import COUNTED
from orewright.plans.registry import query
from orewright.session import work_folder
from orewright.sources.adapters import Given, shared

RETAIL = [
    "recognized_revenue", "gross_revenue", "orders", "recognized_orders", "units", "aov", "estimated_gross_profit",
]
RETAIL_SQL = f"""
    sum(CASE WHEN {COUNTED} THEN net_sales END) AS recognized_revenue, sum(gross_sales) AS gross_revenue,
    count(DISTINCT order_id) AS orders, count(DISTINCT CASE WHEN {COUNTED} THEN order_id END) AS recognized_orders,
    CAST(sum(quantity) AS BIGINT) AS units,
    CAST(sum(CASE WHEN {COUNTED} THEN net_sales END) AS DOUBLE) / nullif(count(DISTINCT CASE WHEN {COUNTED} THEN order_id END), 0) AS aov,
    sum(coalesce(net_sales, 0) - coalesce(unit_cost * quantity, 0)) AS estimated_gross_profit
    FROM r_fact f LEFT JOIN r_products p ON f.product_id = p.product_id"""
RETAIL_REAL = ["recognized_revenue", "gross_revenue", "estimated_gross_profit"]


@shared
def lines(g: Given) -> DataFrame:
    return op.profit_lines(retail.fact(g), retail.products(g))


@shared
def review_facts(g: Given) -> DataFrame:
    """Reviews with their employee's status and department name, blank for an unknown department."""
    staff = workforce.employees(g).select("employee_id", "is_active")
    placed = workforce.op.fact_performance(workforce.reviews(g), workforce.employees(g)).join(staff, "employee_id")
    return placed.join(workforce.departments(g).select("department_id", "department_name"), "department_id", "left")


@query("M-01", "M-02", "M-03", "M-04", "M-05", "M-06", "M-07", "J-16", "F-18",
       sql=f"SELECT channel, {RETAIL_SQL} GROUP BY channel", real=RETAIL_REAL, ratios=["aov"])
def retail_metrics(g: Given) -> DataFrame:
    return op.evaluate(op.order_grain(lines(g), ["channel"]), RETAIL, ["channel"], one_row_per_key=True)


@query("M-01", "M-03", "M-06", "M-07", "V-03",
       sql=f"SELECT category, {RETAIL_SQL} GROUP BY category", real=RETAIL_REAL, ratios=["aov"])
def retail_metrics_by_category(g: Given) -> DataFrame:
    return op.evaluate(op.order_grain(lines(g), ["category"]), RETAIL, ["category"], one_row_per_key=True)


@query("J-16", sql="""
    SELECT f.order_item_id, f.product_id, f.net_sales, p.unit_cost, p.category
    FROM r_fact f LEFT JOIN r_products p ON f.product_id = p.product_id""", real=["net_sales", "unit_cost"])
def related(g: Given) -> DataFrame:
    rows = retail.fact(g).select("order_item_id", "product_id", "net_sales")
    return grains.related(rows, retail.products(g), "product_id", ["unit_cost", "category"])


@query("M-08", "W-06", sql="""
    SELECT order_id, customer_id, count(*) OVER (PARTITION BY customer_id) AS lifetime_orders
    FROM (SELECT DISTINCT order_id, customer_id FROM r_fact)""")
def lifetime_orders(g: Given) -> DataFrame:
    """Orders with the number of orders of their customer."""
    rows = retail.sales(g).select("order_id", "customer_id")
    return grains.at_grain(rows, ["customer_id"], {"lifetime_orders": F.countDistinct("order_id")})


@query("M-09", "W-05", sql=f"""
    SELECT "Order_Bucket", channel, recognized_revenue,
      CAST(recognized_revenue AS DOUBLE) / CAST(sum(recognized_revenue) OVER (PARTITION BY channel) AS DOUBLE) AS revenue_pct_of_total
    FROM (SELECT "Order_Bucket", channel, sum(CASE WHEN {COUNTED} THEN net_sales END) AS recognized_revenue
          FROM r_fact f LEFT JOIN r_dim_customer c ON f.customer_id = c.customer_id GROUP BY ALL)""",
       real=["recognized_revenue"], ratios=["revenue_pct_of_total"])
def revenue_pct_of_total(g: Given) -> DataFrame:
    totals = op.bucket_revenue(retail.sales(g), retail.customers(g), ["channel"])
    return grains.pct_of_total(totals, "recognized_revenue", "Order_Bucket", ["channel"], "revenue_pct_of_total")


@query("M-10", "M-11", "M-12", "M-13", "M-14", "M-15", "M-16", "M-33", sql="""
    WITH heads AS (
      SELECT d.division, count(DISTINCT employee_id) AS total_headcount,
        count(DISTINCT CASE WHEN is_active THEN employee_id END) AS active_employees
      FROM h_employees e LEFT JOIN h_departments d ON e.department_id = d.department_id GROUP BY 1),
    budget AS (SELECT division, CAST(sum(head_count_budget) AS BIGINT) AS budgeted_headcount FROM h_departments GROUP BY 1)
    SELECT division, budgeted_headcount, n AS total_headcount, active AS active_employees, active AS active_employees_2,
      n - active AS inactive_employees,
      CASE WHEN n > 0 THEN CAST(n - active AS DOUBLE) / n END AS turnover_rate,
      n - coalesce(budgeted_headcount, 0) AS headcount_variance,
      CAST(n - budgeted_headcount AS DOUBLE) / budgeted_headcount AS headcount_variance_pct,
      CAST(n AS DOUBLE) / budgeted_headcount AS headcount_to_budget_ratio
    FROM (SELECT division, max(budgeted_headcount) AS budgeted_headcount, max(n) AS n, max(active) AS active
      FROM (SELECT division, budgeted_headcount, 0 AS n, 0 AS active FROM budget
        UNION ALL SELECT division, NULL, total_headcount, active_employees FROM heads) GROUP BY division)""",
       ratios=["turnover_rate", "headcount_variance_pct", "headcount_to_budget_ratio"])
def workforce_metrics(g: Given) -> DataFrame:
    return op.workforce_by(workforce.employees(g), workforce.departments(g), "division")


@query("M-17", "M-18", "M-19", "M-20", "M-21", "M-32", "F-15", sql="""
    SELECT d.department_name, count(*) AS review_count, count(DISTINCT r.employee_id) AS reviewed_employees,
      avg(goals_met_pct) AS average_goals_met_pct, avg(overall_rating) AS average_rating,
      count(DISTINCT CASE WHEN overall_rating >= 4 THEN r.employee_id END) AS high_performers,
      count(DISTINCT CASE WHEN coalesce(overall_rating, 0) < 3 THEN r.employee_id END) AS low_performers,
      CAST(count(DISTINCT CASE WHEN overall_rating >= 4 THEN r.employee_id END) AS DOUBLE) / count(DISTINCT r.employee_id) AS high_performer_pct,
      CAST(count(DISTINCT CASE WHEN coalesce(overall_rating, 0) < 3 THEN r.employee_id END) AS DOUBLE) / count(DISTINCT r.employee_id) AS low_performer_pct,
      CASE WHEN avg(overall_rating) >= 4.5 THEN 'Top Tier' WHEN avg(overall_rating) >= 3.5 THEN 'Strong'
           WHEN avg(overall_rating) >= 2.5 THEN 'Needs Development' ELSE 'Low' END AS performance_band_label,
      avg(CASE WHEN is_active THEN overall_rating END) AS average_rating_active
    FROM h_reviews r JOIN h_employees e ON r.employee_id = e.employee_id
    LEFT JOIN h_departments d ON e.department_id = d.department_id GROUP BY d.department_name""",
       ratios=["average_goals_met_pct", "average_rating", "high_performer_pct", "low_performer_pct", "average_rating_active"])
def performance_metrics(g: Given) -> DataFrame:
    return op.review_scores(review_facts(g), ["department_name"])


@query("M-22", "W-04", sql="""
    SELECT department_name, average_rating, CAST(rank() OVER (ORDER BY average_rating DESC NULLS LAST) AS INTEGER) AS department_rank
    FROM (SELECT d.department_name, avg(overall_rating) AS average_rating
      FROM h_departments d LEFT JOIN h_employees e ON e.department_id = d.department_id
      LEFT JOIN h_reviews r ON r.employee_id = e.employee_id GROUP BY 1)""", ratios=["average_rating"])
def department_rank(g: Given) -> DataFrame:
    """All departments; those without a rating share the last rank."""
    rated = op.evaluate(review_facts(g), ["average_rating"], ["department_name"])
    rated = workforce.departments(g).select("department_name").distinct().join(rated, "department_name", "left")
    # Ranking reads its input twice; a row for each department is stored rather than built again.
    path = work_folder(g.spark, "rated")
    rated.write.parquet(path)
    rated = g.spark.read.parquet(path)
    return grains.distributed_rank(rated, "average_rating", 0.0, 5.0, 100, "department_rank")


PAY = [
    "average_salary", "median_salary", "min_salary", "max_salary", "salary_range", "average_tenure",
    "salary_per_tenure_year",
]


@query("M-23", "M-24", "M-25", "M-26", sql="""
    SELECT department_id, avg(salary) AS average_salary, CAST(median(salary) AS DOUBLE) AS median_salary,
      min(salary) AS min_salary, max(salary) AS max_salary, max(salary) - min(salary) AS salary_range,
      avg(tenure_years) AS average_tenure, CASE WHEN avg(tenure_years) <> 0 THEN avg(salary) / avg(tenure_years) END AS salary_per_tenure_year
    FROM h_employees GROUP BY department_id""",
       ratios=["average_salary", "average_tenure", "salary_per_tenure_year"])
def compensation_metrics(g: Given) -> DataFrame:
    rest = op.evaluate(workforce.employees(g), [n for n in PAY if n != "median_salary"], ["department_id"])
    middle = op.exact_median(workforce.employees(g), "salary", ["department_id"], "median_salary")
    middle = middle.withColumnRenamed("department_id", "_department")
    return rest.join(middle, F.col("department_id").eqNullSafe(F.col("_department")), "left").drop("_department")


@query("M-27", "M-28", "W-06", sql="""
    SELECT department_id, job_title, average_salary, department_avg_salary,
      average_salary - department_avg_salary AS salary_variance_from_dept_avg
    FROM (SELECT department_id, job_title, avg(salary) AS average_salary FROM h_employees GROUP BY 1, 2)
    JOIN (SELECT department_id, avg(salary) AS department_avg_salary FROM h_employees GROUP BY 1) USING (department_id)""",
       ratios=["average_salary", "department_avg_salary", "salary_variance_from_dept_avg"])
def salary_variance(g: Given) -> DataFrame:
    """Average pay per job against its department's; both averages come from one pass of sums."""
    jobs = workforce.employees(g).groupBy("department_id", "job_title").agg(
        F.sum("salary").alias("_sum"), F.count("salary").alias("_n")
    )
    placed = grains.at_grain(
        jobs, ["department_id"], {"department_avg_salary": safe_divide(F.sum("_sum"), F.sum("_n"))}
    )
    average = safe_divide(F.col("_sum"), F.col("_n"))
    return placed.select(
        "department_id", "job_title", average.alias("average_salary"), "department_avg_salary",
        (average - F.col("department_avg_salary")).alias("salary_variance_from_dept_avg"),
    )


@query("M-29", "M-30", sql="""
    SELECT department_id, CAST(count(DISTINCT CASE WHEN is_active THEN employee_id END) AS DOUBLE) / count(DISTINCT employee_id) AS active_employee_pct,
      count(DISTINCT CASE WHEN gender = 'Female' THEN employee_id END) AS female_employees,
      CAST(count(DISTINCT CASE WHEN gender = 'Female' THEN employee_id END) AS DOUBLE) / count(DISTINCT employee_id) AS female_employee_pct
    FROM h_employees GROUP BY department_id""", ratios=["active_employee_pct", "female_employee_pct"])
def diversity_metrics(g: Given) -> DataFrame:
    names = ["active_employee_pct", "female_employees", "female_employee_pct"]
    staff = op.staff_grain(workforce.employees(g), ["department_id"])
    return op.evaluate(staff, names, ["department_id"], one_row_per_key=True)


@query("M-31", sql="""
    SELECT h.department_id, total_headcount, employees_with_reviews,
      CAST(employees_with_reviews AS DOUBLE) / total_headcount AS review_coverage_pct
    FROM (SELECT department_id, count(DISTINCT employee_id) AS total_headcount FROM h_employees GROUP BY 1) h
    LEFT JOIN (SELECT e.department_id, count(DISTINCT r.employee_id) AS employees_with_reviews
      FROM h_reviews r JOIN h_employees e ON r.employee_id = e.employee_id GROUP BY 1) s ON h.department_id IS NOT DISTINCT FROM s.department_id""",
       ratios=["review_coverage_pct"])
def review_coverage(g: Given) -> DataFrame:
    facts = workforce.op.fact_performance(workforce.reviews(g), workforce.employees(g))
    return op.review_coverage(workforce.employees(g), facts, "department_id")


@query("M-34", "M-35", sql="""
    SELECT fiscal_period_id, total_revenue, total_expenses,
      coalesce(CAST(total_revenue - coalesce(cost, 0) AS DOUBLE) / nullif(CAST(total_revenue AS DOUBLE), 0), 0) AS gross_margin_pct
    FROM (SELECT fiscal_period_id, sum(CASE WHEN account_type = 'Revenue' THEN credit_amount - debit_amount END) AS total_revenue,
        sum(CASE WHEN account_type = 'Expense' THEN debit_amount - credit_amount END) AS total_expenses,
        sum(CASE WHEN account_type = 'Expense' AND account_subgroup = 'Cost of Revenue' THEN debit_amount - credit_amount END) AS cost
      FROM gl GROUP BY 1)""", real=["total_revenue", "total_expenses"], ratios=["gross_margin_pct"])
def ledger_metrics(g: Given) -> DataFrame:
    """Over postings of every status, unlike the statements."""
    names = ["total_revenue", "total_expenses", "gross_margin_pct"]
    return op.evaluate(ledger.totals(g), names, ["fiscal_period_id"])


@query("M-38", sql="""
    SELECT channel, CAST(sum(quantity) AS BIGINT) AS sum_quantity, sum(gross_sales) AS sum_gross_sales,
      sum(net_sales) AS sum_net_sales FROM r_fact GROUP BY channel""", real=["sum_gross_sales", "sum_net_sales"])
def default_sum(g: Given) -> DataFrame:
    return op.default_sum(retail.fact(g), ["quantity", "gross_sales", "net_sales"], ["channel"])

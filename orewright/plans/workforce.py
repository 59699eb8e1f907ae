"""Workforce queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orewright.functions.numbers import fix_negative as fixed
from orewright.operators import shaping
from orewright.operators import workforce as op
from orewright.plans.checks import rounded
from orewright.plans.registry import query
from orewright.sources import adapters as given
from orewright.sources.adapters import Given, shared

AS_OF = "2026-01-01"
DATES = ["hire_date", "termination_date"]


@shared
def employees(g: Given) -> DataFrame:
    return op.clean_employees(given.hr_employees(g), AS_OF)


@shared
def departments(g: Given) -> DataFrame:
    return given.hr_departments(g)


@shared
def reviews(g: Given) -> DataFrame:
    return op.clean_reviews(given.hr_reviews(g))


@shared
def history(g: Given) -> DataFrame:
    return op.clean_salary_history(given.hr_salary_history(g))


@shared
def summary(g: Given) -> DataFrame:
    return op.dept_summary(departments(g), employees(g))


@query("P-08", "P-09", "P-10", "P-11", "F-02", "F-03", "F-10", sql="SELECT * FROM h_employees", text=DATES)
def clean_employees(g: Given) -> DataFrame:
    return employees(g)


@query("P-08", sql="""
    SELECT employee_id, salary AS as_coded, abs(salary) AS flipped FROM h_employees_raw""")
def fix_negative(g: Given) -> DataFrame:
    """Both readings of the sign rule."""
    salary = F.col("salary")
    return given.hr_employees(g).select(
        "employee_id", fixed(salary).alias("as_coded"), fixed(salary, "abs").alias("flipped")
    )


@query("P-09", sql="SELECT employee_id, salary FROM h_employees_raw WHERE salary NOT IN (-78000, -71000)")
def exclude_values(g: Given) -> DataFrame:
    rows = given.hr_employees(g).select("employee_id", "salary")
    return shaping.exclude_values(rows, "salary", op.EXCLUDED_SALARIES)


@query("P-10", sql="SELECT employee_id, hire_date FROM h_employees_raw WHERE hire_date < DATE '2026-01-01'",
       text=["hire_date"])
def before(g: Given) -> DataFrame:
    return shaping.before(given.hr_employees(g), "hire_date", op.HIRED_BEFORE).select("employee_id", "hire_date")


@query("P-11", sql="SELECT employee_id, job_title AS title, salary FROM h_employees_raw")
def reshape(g: Given) -> DataFrame:
    order = ["employee_id", "job_title", "email", "salary"]
    return shaping.reshape(given.hr_employees(g), order, drop=["email"], rename={"job_title": "title"})


@query("F-12", "P-11", sql="SELECT * FROM h_reviews", text=["review_date"])
def clean_reviews(g: Given) -> DataFrame:
    return reviews(g)


@query("F-12", sql="""
    SELECT review_id, overall_rating,
      CASE overall_rating WHEN 5 THEN 'Exceptional' WHEN 4 THEN 'Exceeds Expectations'
        WHEN 3 THEN 'Meets Expectations' WHEN 2 THEN 'Needs Improvement' ELSE 'Unsatisfactory' END AS performance_band
    FROM h_reviews""")
def performance_band(g: Given) -> DataFrame:
    """The bands as the labels suggest they were meant."""
    banded = op.clean_reviews(given.hr_reviews(g), mode="intended")
    return banded.select("review_id", "overall_rating", "performance_band")


@query("P-08", "P-09", "P-11", sql="SELECT * FROM h_history", text=["effective_date"])
def clean_salary_history(g: Given) -> DataFrame:
    return history(g)


@query("P-06", sql="SELECT * FROM h_departments")
def dim_department(g: Given) -> DataFrame:
    return op.dim_department(departments(g))


@query(
    "J-04", "F-11",
    sql="""
    SELECT e.employee_id, e.full_name, e.first_name, e.last_name, e.email, e.job_title, e.department_id,
      d.department_name, d.division, e.hire_date, e.termination_date, e.termination_reason, e.employment_type,
      e.salary, e.gender, e.ethnicity, e.education_level, e.manager_id, e.is_active, e.location, e.tenure_years,
      CASE WHEN tenure_years < 1 THEN 'New (<1 yr)' WHEN tenure_years < 3 THEN 'Developing (1-3 yrs)'
           WHEN tenure_years < 5 THEN 'Experienced (3-5 yrs)' ELSE 'Veteran (5+ yrs)' END AS tenure_band
    FROM h_employees e LEFT JOIN h_departments d ON e.department_id = d.department_id""",
    text=DATES,
)
def dim_employee(g: Given) -> DataFrame:
    return op.dim_employee(employees(g), departments(g))


@query(
    "J-05",
    sql="""
    SELECT r.review_id, r.employee_id, r.review_cycle, r.overall_rating, r.goals_met_pct, r.performance_band,
      r.reviewer_id, r.review_date, e.department_id, e.job_title, e.tenure_years
    FROM h_reviews r JOIN h_employees e ON r.employee_id = e.employee_id""",
    text=["review_date"],
)
def fact_performance(g: Given) -> DataFrame:
    return op.fact_performance(reviews(g), employees(g))


@query(
    "J-06",
    sql="""
    SELECT s.*, e.department_id, e.job_title FROM h_history s JOIN h_employees e ON s.employee_id = e.employee_id""",
    text=["effective_date"],
)
def fact_salary_history(g: Given) -> DataFrame:
    return op.fact_salary_history(history(g), employees(g))


@query("A-05", sql="SELECT * FROM h_summary")
def dept_summary(g: Given) -> DataFrame:
    return summary(g)


@query(
    "A-06",
    sql=f"""
    SELECT e.department_id, d.department_name, r.review_cycle, count(*) AS review_count,
      {rounded('avg(r.overall_rating)', 2)} AS avg_rating, {rounded('avg(r.goals_met_pct)', 1)} AS avg_goals_met_pct,
      count(*) FILTER (r.overall_rating >= 4) AS high_performers, count(*) FILTER (r.overall_rating <= 2) AS low_performers
    FROM h_reviews r JOIN h_employees e ON r.employee_id = e.employee_id
    JOIN h_departments d ON e.department_id = d.department_id
    GROUP BY e.department_id, d.department_name, r.review_cycle""",
)
def performance_by_dept(g: Given) -> DataFrame:
    return op.performance_by_dept(reviews(g), employees(g), departments(g))

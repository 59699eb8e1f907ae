"""Workforce: employee cleaning, dimensions, facts and department aggregates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orewright.functions.bands import performance_band, tenure_band
from orewright.functions.dates import tenure_years
from orewright.functions.numbers import fix_negative, stable_round
from orewright.functions.text import joined, without_controls
from orewright.operators.shaping import before, conform, exclude_values, reshape, select_dim

# Amounts taken out by hand, and the first hire date that is out of range.
EXCLUDED_SALARIES = (-78000, -71000)
EXCLUDED_HISTORY = (-78000, -75000, -72000, -71000, -69000, -68000, -67000, -64000)
HIRED_BEFORE = "2026-01-01"

DEPARTMENT_COLUMNS = (
    "department_id", "department_name", "division", "location", "cost_center", "head_count_budget",
)
EMPLOYEE_ORDER = (
    "employee_id", "first_name", "last_name", "full_name", "email", "department_id", "job_title",
    "hire_date", "termination_date", "termination_reason", "employment_type", "salary", "gender",
    "ethnicity", "education_level", "manager_id", "is_active", "location", "tenure_years",
)


def clean_employees(raw: DataFrame, as_of: date | str, mode: str = "as_coded") -> DataFrame:
    texts = ("first_name", "last_name", "email", "job_title")
    kept = before(raw, "hire_date", HIRED_BEFORE).withColumn(
        "salary", fix_negative(F.col("salary"), mode)
    )
    tidy = conform(
        exclude_values(kept, "salary", EXCLUDED_SALARIES), dict.fromkeys(texts, without_controls)
    )
    full = tidy.withColumns(
        {
            "full_name": joined(F.col("last_name"), F.col("first_name")),
            "tenure_years": tenure_years(F.col("hire_date"), as_of),
        }
    )
    return reshape(full, order=EMPLOYEE_ORDER)


def clean_reviews(raw: DataFrame, mode: str = "as_coded") -> DataFrame:
    banded = raw.withColumn("performance_band", performance_band(F.col("overall_rating"), mode))
    return reshape(banded, drop=["comments"])


def clean_salary_history(raw: DataFrame, mode: str = "as_coded") -> DataFrame:
    kept = exclude_values(raw, "salary_amount", EXCLUDED_HISTORY).withColumn(
        "salary_cleaned", fix_negative(F.col("salary_amount"), mode)
    )
    order = ("salary_history_id", "employee_id", "effective_date", "salary_amount",
             "salary_cleaned", "change_type", "change_pct")
    return reshape(kept, order, drop=["salary_amount"], rename={"salary_cleaned": "salary_amount"})


def dim_department(departments: DataFrame) -> DataFrame:
    return select_dim(departments, DEPARTMENT_COLUMNS)


def dim_employee(employees: DataFrame, departments: DataFrame) -> DataFrame:
    """Employees with their department; unknown departments leave NULLs."""
    names = departments.select("department_id", "department_name", "division")
    return (
        employees.join(names, "department_id", "left")
        .withColumn("tenure_band", tenure_band(F.col("tenure_years")))
        .select(
            "employee_id", "full_name", "first_name", "last_name", "email", "job_title",
            "department_id", "department_name", "division", "hire_date", "termination_date",
            "termination_reason", "employment_type", "salary", "gender", "ethnicity",
            "education_level", "manager_id", "is_active", "location", "tenure_years", "tenure_band",
        )
    )


def fact_performance(reviews: DataFrame, employees: DataFrame) -> DataFrame:
    """Reviews of known employees."""
    who = employees.select("employee_id", "department_id", "job_title", "tenure_years")
    return reviews.join(who, "employee_id").select(
        "review_id", "employee_id", "review_cycle", "overall_rating", "goals_met_pct",
        "performance_band", "reviewer_id", "review_date", "department_id", "job_title", "tenure_years",
    )


def fact_salary_history(history: DataFrame, employees: DataFrame) -> DataFrame:
    who = employees.select("employee_id", "department_id", "job_title")
    return history.join(who, "employee_id").select(
        "salary_history_id", "employee_id", "effective_date", "salary_amount", "change_type",
        "change_pct", "department_id", "job_title",
    )


def dept_summary(departments: DataFrame, employees: DataFrame) -> DataFrame:
    """Headcount, pay, tenure and turnover per department.

    Employees shrink to one row per department before the join. A department without
    employees counts as one (empty) row, so its turnover is 0 and not NULL.
    """
    active, left = F.col("is_active"), ~F.col("is_active")
    staff = employees.groupBy("department_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(active).alias("_active"),
        F.count_if(left).alias("_left"),
        F.avg(F.when(active, F.col("salary"))).alias("_avg"),
        F.min(F.when(active, F.col("salary"))).alias("min_salary"),
        F.max(F.when(active, F.col("salary"))).alias("max_salary"),
        F.avg(F.when(active, F.col("tenure_years"))).alias("_tenure"),
    )
    count_active = F.coalesce("_active", F.lit(0))
    count_left = F.coalesce("_left", F.lit(0))
    share = count_left * 100 / F.coalesce("_rows", F.lit(1))
    return departments.join(staff, "department_id", "left").select(
        "department_id",
        "department_name",
        "division",
        "head_count_budget",
        count_active.alias("active_headcount"),
        (F.col("head_count_budget") - count_active).alias("headcount_variance"),
        stable_round(F.col("_avg"), 0).alias("avg_salary"),
        "min_salary",
        "max_salary",
        stable_round(F.col("_tenure"), 1).alias("avg_tenure_years"),
        count_left.alias("terminated_count"),
        stable_round(share, 1).alias("turnover_pct"),
    )


def performance_by_dept(
    reviews: DataFrame, employees: DataFrame, departments: DataFrame
) -> DataFrame:
    """Review counts and averages per department and cycle; the names join the totals."""
    placed = reviews.join(employees.select("employee_id", "department_id"), "employee_id")
    rating = F.col("overall_rating")
    totals = placed.groupBy("department_id", "review_cycle").agg(
        F.count(F.lit(1)).alias("review_count"),
        stable_round(F.avg(rating), 2).alias("avg_rating"),
        stable_round(F.avg("goals_met_pct"), 1).alias("avg_goals_met_pct"),
        F.count_if(rating >= 4).alias("high_performers"),
        F.count_if(rating <= 2).alias("low_performers"),
    )
    return totals.join(departments.select("department_id", "department_name"), "department_id")

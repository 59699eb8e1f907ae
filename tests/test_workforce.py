from datetime import date

from conftest import values
from pyspark.sql import functions as F

from orewright.functions.bands import performance_band, rating_label, tenure_band
from orewright.functions.dates import tenure_years
from orewright.operators import workforce

EMPLOYEE = ("employee_id string, first_name string, last_name string, email string, department_id string, "
            "job_title string, hire_date date, termination_date date, termination_reason string, "
            "employment_type string, salary long, gender string, ethnicity string, education_level string, "
            "manager_id string, is_active boolean, location string")


def person(i, salary=50000, hired=date(2020, 1, 1), dept="D1", active=True, first=" Al\x07 "):
    return (i, first, "Bo\tb", "e ", dept, "J", hired, None, None, "F", salary, "Female", "x", "y", "m", active, "l")


def people(frame, *rows, **kw):
    return workforce.clean_employees(frame(list(rows), EMPLOYEE), "2026-01-01", **kw)


def test_sign_rule_as_coded_and_flipped(frame):
    rows = [person("a", -78000), person("b", -50000), person("c", None), person("d", -71000)]
    assert values(people(frame, *rows), "employee_id", "salary") == [("b", -50000), ("c", None)]
    assert values(people(frame, *rows, mode="abs"), "employee_id", "salary") == [
        ("a", 78000), ("b", 50000), ("c", None), ("d", 71000)]


def test_hires_from_the_cutoff_on_are_dropped(frame):
    rows = [person("a", hired=date(2025, 12, 31)), person("b", hired=date(2026, 1, 1)), person("c", hired=None)]
    assert values(people(frame, *rows), "employee_id") == [("a",)]


def test_text_is_trimmed_then_stripped_of_controls_and_names_skip_nulls(frame):
    got = values(people(frame, person("a"), person("b", first=None)), "employee_id", "first_name", "full_name")
    assert got == [("a", "Al", "Bob Al"), ("b", None, "Bob")]


def test_tenure_rounds_half_to_even_twice(spark):
    days = [146, 183, 548, 913, 1644, 2009]  # 0.4, 0.5, 1.5, 2.5, 4.5, 5.5 years
    df = spark.createDataFrame([(d,) for d in days], "d int").select(
        "d", F.date_sub(F.lit("2026-01-01").cast("date"), F.col("d")).alias("hired"))
    got = [r.t for r in df.orderBy("d").select(tenure_years(F.col("hired"), "2026-01-01").alias("t")).collect()]
    assert got == [0, 0, 2, 2, 4, 6]


def test_bands(spark):
    df = spark.createDataFrame([(i,) for i in range(0, 7)], "n int")
    n = F.col("n")
    got = [tuple(r) for r in df.orderBy("n").select(
        tenure_band(n), performance_band(n), performance_band(n, "intended")).collect()]
    assert [g[0] for g in got] == ["New (<1 yr)"] + ["Developing (1-3 yrs)"] * 2 + ["Experienced (3-5 yrs)"] * 2 + [
        "Veteran (5+ yrs)"] * 2
    assert [g[1] for g in got] == ["Exceptional"] * 6 + ["Needs Improvement"]
    assert [g[2] for g in got] == ["Unsatisfactory"] * 2 + [
        "Needs Improvement", "Meets Expectations", "Exceeds Expectations", "Exceptional", "Exceptional"]
    rated = spark.createDataFrame([(4.5,), (3.5,), (2.5,), (2.4,), (None,)], "r double")
    assert [r[0] for r in rated.select(rating_label(F.col("r"))).collect()] == [
        "Top Tier", "Strong", "Needs Development", "Low", "Low"]


DEPT = "department_id string, department_name string, division string, location string, cost_center string, head_count_budget long"


def test_department_summary_with_an_empty_department_and_orphans(frame):
    staff = people(frame, person("a", 100), person("b", 201), person("c", 900, active=False), person("d", dept="D9"))
    depts = frame([("D1", "One", "X", "l", "c", 5), ("D2", "Two", "X", "l", "c", 3)], DEPT)
    got = {r.department_id: r for r in workforce.dept_summary(depts, staff).collect()}
    one, two = got["D1"], got["D2"]
    assert (one.active_headcount, one.headcount_variance, one.avg_salary, one.min_salary, one.max_salary,
            one.terminated_count, one.turnover_pct) == (2, 3, 151.0, 100, 201, 1, 33.3)
    assert (two.active_headcount, two.headcount_variance, two.avg_salary, two.turnover_pct) == (0, 3, None, 0.0)
    dim = {r.employee_id: r.department_name for r in workforce.dim_employee(staff, depts).collect()}
    assert dim == {"a": "One", "b": "One", "c": "One", "d": None}


def test_facts_drop_unknown_employees(frame):
    staff = people(frame, person("a"))
    reviews = workforce.clean_reviews(frame(
        [("r1", "a", "2025", 4, 90, "m", date(2025, 1, 1), "fine"), ("r2", "z", "2025", 1, 10, "m", date(2025, 1, 1), "x")],
        "review_id string, employee_id string, review_cycle string, overall_rating long, goals_met_pct long, "
        "reviewer_id string, review_date date, comments string"))
    assert "comments" not in reviews.columns
    assert values(workforce.fact_performance(reviews, staff), "review_id") == [("r1",)]
    history = workforce.clean_salary_history(frame(
        [("s1", "a", date(2025, 1, 1), -64000, "c", 1.0), ("s2", "a", date(2025, 1, 1), -100, "c", 1.0),
         ("s3", "z", date(2025, 1, 1), 100, "c", 1.0), ("s4", "a", date(2025, 1, 1), None, "c", 1.0)],
        "salary_history_id string, employee_id string, effective_date date, salary_amount long, change_type string, change_pct double"))
    assert values(workforce.fact_salary_history(history, staff), "salary_history_id", "salary_amount") == [
        ("s2", -100), ("s4", None)]

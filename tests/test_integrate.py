import random
from decimal import Decimal as D

from conftest import values
from pyspark.sql import functions as F

from orewright.functions.text import as_millions, with_thousands
from orewright.operators import integrate, metrics
from orewright.sources import tables

SUMMARY = "department_id string, active_headcount long, avg_salary double"


def company(frame):
    depts = frame([("d1", "One", "A"), ("d2", "Two", "A"), ("d3", "One", "A"), ("d4", "Four", "B")],
                  "department_id string, department_name string, division string")
    summary = frame([("d1", 2, 100.0), ("d2", 0, None), ("d3", 2, 50.0), ("d4", 5, 10.0)], SUMMARY)
    return depts, summary


def test_revenue_by_department_equals_the_cross_join(frame):
    depts, summary = company(frame)
    sales = frame([(1, D("10.00")), (2, D("5.50")), (3, None)], "order_id long, net_sales decimal(12,2)")
    paired = sales.crossJoin(depts.join(summary, "department_id")).filter("division = 'A'")
    naive = paired.groupBy("department_name", "division", "active_headcount").agg(
        F.countDistinct("order_id").alias("o"), F.round(F.sum("net_sales"), 2).alias("r"))
    got = integrate.revenue_by_dept(sales, summary, depts, "A")
    columns = ["department_name", "division", "active_headcount"]
    assert values(got, *columns, "total_orders", "total_revenue") == values(naive, *columns, "o", "r")
    per_head = {(r.department_name): r.revenue_per_employee for r in got.collect()}
    assert per_head["Two"] is None and float(per_head["One"]) == 15.5
    assert integrate.revenue_by_dept(sales.filter("false"), summary, depts, "A").count() == 0
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_efficiency_equals_the_cross_join(frame):
    depts, summary = company(frame)
    orders = frame([(1, D("10.00")), (2, D("5.50")), (2, D("1.00"))], "order_id long, order_total decimal(12,2)")
    naive = depts.join(summary, "department_id").crossJoin(orders).groupBy("division").agg(
        F.sum("active_headcount").alias("h"), F.sum(F.col("avg_salary") * F.col("active_headcount")).alias("c"),
        F.countDistinct("order_id").alias("o"), F.round(F.sum("order_total"), 2).alias("r"))
    got = integrate.efficiency_metrics(depts, summary, orders)
    assert values(got) == values(naive)
    assert integrate.efficiency_metrics(depts, summary, orders.filter("false")).count() == 0


def test_customer_360_keeps_customers_without_completed_orders(frame):
    people = frame([(1, "a", "b", "c", "i", "r", D("1.00")), (2, "a", "b", "c", "i", "r", None)],
                   "customer_id long, first_name string, last_name string, company_name string, industry string, "
                   "region string, lifetime_value decimal(12,2)")
    orders = frame([(10, 1, D("3.00"), "2024-01-01", "Completed"), (11, 1, D("4.01"), "2024-01-02", "Completed"),
                    (12, 2, D("9.00"), "2024-01-02", "Open")],
                   "order_id long, customer_id long, order_total decimal(12,2), order_date string, order_status string")
    got = values(integrate.customer_360(people, orders), "crm_customer_id", "total_orders", "total_spend", "avg_order_value")
    assert [(g[0], g[1], g[2], None if g[3] is None else float(g[3])) for g in got] == [
        (1, 2, D("7.01"), 3.51), (2, None, None, None)]


def test_changes_match_a_dictionary(frame):
    rng = random.Random(11)
    held = {k: f"v{k}" for k in range(8)}
    # A third of the feed is one key.
    feed = [(rng.choice([3, 3, 3] + list(range(12))), f"n{i}", i, rng.choice(["upsert", "upsert", "delete", None]))
            for i in range(60)]
    target = frame(list(held.items()), "k int, v string")
    rows = frame(rng.sample(feed, len(feed)), "k int, v string, seq int, _op string")
    for k, v, _, op in feed:
        held.pop(k, None) if op == "delete" else held.update({k: v})
    assert values(integrate.apply_changes(target, rows, ["k"], ["seq"])) == sorted(held.items(), key=repr)


def test_source_map_labels_and_formats(spark, frame):
    kpis = frame([(100, 500, D("12600000.00"), 7500)],
                 "total_customers long, total_orders long, retail_revenue decimal(20,2), total_headcount long")
    got = {r.data_source: r for r in integrate.integration_metrics(tables.source_map(spark), kpis).collect()}
    assert got["Retail Sales"].integration_metric_formatted == "13M"
    assert (got["HR Workforce"].integration_metric_formatted, got["HR Workforce"].metric) == ("7,500", "Employee Count")
    assert got["CRM Customers"].integration_metric == 100.0
    row = frame([(1234567.6,)], "x double").select(as_millions(F.col("x")), with_thousands(F.col("x"))).first()
    assert tuple(row) == ("1M", "1,234,568")


def test_counts_per_source(frame):
    df = frame([(1,), (2,)], "a int")
    assert values(integrate.source_counts({"x": df, "y": df.filter("a > 1")})) == [("x", 2), ("y", 1)]


def test_retail_metrics_agree_on_lines_and_on_orders(frame):
    fact = frame([(1, "placed", 1, 2, D("20.00"), D("19.00"), "w"), (1, "placed", 2, 1, D("5.00"), None, "w"),
                  (2, "cancelled", 1, 1, D("7.00"), D("7.00"), "w"), (3, None, 9, 1, D("1.00"), D("1.00"), "s")],
                 "order_id long, order_status string, product_id long, quantity int, gross_sales decimal(12,2), "
                 "net_sales decimal(12,2), channel string")
    products = frame([(1, "c", D("4.00")), (2, "c", D("1.00"))], "product_id long, category string, unit_cost decimal(12,2)")
    lines = metrics.profit_lines(fact, products)
    names = ["recognized_revenue", "gross_revenue", "orders", "recognized_orders", "units", "aov", "estimated_gross_profit"]
    direct = metrics.evaluate(lines, names, ["channel"])
    per_order = metrics.order_grain(lines, ["channel"])
    assert values(direct) == values(metrics.evaluate(per_order, names, ["channel"]))
    plain = metrics.evaluate(per_order, names, ["channel"], one_row_per_key=True)
    assert values(direct) == values(plain)
    assert "Expand" not in plain._jdf.queryExecution().executedPlan().toString()
    got = {r.channel: r for r in direct.collect()}
    assert (got["w"].orders, got["w"].recognized_orders, got["w"].aov, got["w"].estimated_gross_profit) == (
        2, 1, 19.0, D("13.00"))
    # A blank status is not an excluded one, and an unknown product costs nothing.
    assert (got["s"].recognized_orders, got["s"].aov, got["s"].estimated_gross_profit) == (1, 1.0, D("1.00"))


def test_low_performers_have_two_definitions(frame):
    reviews = frame([("a", 2), ("b", 3), ("c", 1), ("c", 5)], "employee_id string, overall_rating long")
    blank = frame([("a", None), ("b", 3)], "employee_id string, overall_rating long")
    assert metrics.evaluate(blank, ["low_performers", "high_performers"]).first() == (1, 0)
    row = metrics.evaluate(reviews, ["low_performers", "high_performers", "average_rating", "performance_band_label"]).first()
    assert tuple(row) == (2, 1, 2.75, "Needs Development")


def test_review_scores_equal_the_named_metrics(frame):
    reviews = frame([("x", "a", 2, 10, True), ("x", "a", 5, None, True), ("x", "b", 3, 20, False), ("x", "c", None, 30, None),
                     ("y", "a", None, None, True), ("y", "d", 4, 99, False)],
                    "d string, employee_id string, overall_rating long, goals_met_pct long, is_active boolean")
    scores = metrics.review_scores(reviews, ["d"])
    assert values(scores) == values(metrics.evaluate(reviews, scores.columns[1:], ["d"]))


def test_buckets_count_the_orders_of_all_channels(frame):
    sales = frame([(1, 1, "w", "placed", D("1.00")), (1, 2, "s", "cancelled", D("2.00")), (2, 3, "w", "placed", D("4.00")),
                   (9, 4, "w", "placed", D("8.00"))],
                  "customer_id long, order_id long, channel string, order_status string, net_sales decimal(12,2)")
    known = frame([(1,), (2,), (3,)], "customer_id long")
    assert values(metrics.bucket_revenue(sales, known)) == [("1", D("4.00")), ("2-3", D("1.00")), (None, D("8.00"))]
    assert values(metrics.bucket_revenue(sales, known, ["channel"])) == [
        ("1", "w", D("4.00")), ("2-3", "s", None), ("2-3", "w", D("1.00")), (None, "w", D("8.00"))]


def test_budget_is_not_repeated_by_the_join(frame):
    staff = frame([("a", "d1", True, "F"), ("b", "d1", False, "M"), ("c", "d2", True, "F")],
                  "employee_id string, department_id string, is_active boolean, gender string")
    depts = frame([("d1", "X", 10), ("d2", "X", 5), ("d3", "Y", 0)],
                  "department_id string, division string, head_count_budget long")
    got = {r.division: r for r in metrics.workforce_by(staff, depts, "division").collect()}
    assert (got["X"].budgeted_headcount, got["X"].total_headcount, got["X"].headcount_variance) == (15, 3, -12)
    assert got["X"].active_employees == got["X"].active_employees_2 == 2
    assert (got["Y"].total_headcount, got["Y"].headcount_variance, got["Y"].turnover_rate) == (0, 0, None)
    assert got["Y"].headcount_variance_pct is None


def test_staff_of_unknown_departments_have_a_blank_member(frame):
    staff = frame([("a", "d1", True, "F"), ("b", "d9", False, "M"), ("c", None, True, "F")],
                  "employee_id string, department_id string, is_active boolean, gender string")
    depts = frame([("d1", "X", 10), ("d2", "Y", 5)], "department_id string, division string, head_count_budget long")
    for by in ("division", "department_id"):
        rows = {r[by]: r for r in metrics.workforce_by(staff, depts, by).collect()}
        assert len(rows) == 3 and sum(r.total_headcount for r in rows.values()) == 3
        assert (rows[None].total_headcount, rows[None].budgeted_headcount, rows[None].headcount_variance) == (2, None, 2)
    assert rows["d2"].headcount_variance == -5


def test_margin_is_zero_without_revenue(frame):
    gl = frame([("p", "Expense", "Cost of Revenue", D("5.00"), D("0.00")), ("q", "Revenue", "Operating Revenue", D("0.00"), D("10.00")),
                ("q", "Expense", "Cost of Revenue", D("4.00"), D("0.00"))],
               "p string, account_type string, account_subgroup string, debit_amount decimal(18,2), credit_amount decimal(18,2)")
    got = values(metrics.evaluate(gl, ["total_revenue", "total_expenses", "gross_margin_pct"], ["p"]))
    assert got == [("p", None, D("5.00"), 0.0), ("q", D("10.00"), D("4.00"), 0.6)]


def test_exact_median_equals_the_middle(frame):
    rows = [("a", 5), ("a", 1), ("a", 1), ("a", None), ("b", 2), ("b", 9), ("b", 4), ("b", 4), (None, 7), ("c", None)]
    df = frame(rows, "d string, v long")
    got = {r.d: r.m for r in metrics.exact_median(df, "v", ["d"], "m").collect()}
    assert got == {"a": 1.0, "b": 4.0, None: 7.0}
    assert got == {r.d: r.m for r in df.groupBy("d").agg(F.median("v").alias("m")).filter("m is not null").collect()}


def test_headcounts_count_people_not_rows(frame):
    staff = frame([("a", "d", True, "Female"), ("a", "d", False, "Female"), ("b", "d", None, None), ("c", "e", False, "Male")],
                  "employee_id string, department_id string, is_active boolean, gender string")
    names = ["total_headcount", "active_employees", "active_employees_2", "turnover_rate", "female_employee_pct"]
    grain = metrics.staff_grain(staff, ["department_id"])
    assert values(metrics.evaluate(grain, names, ["department_id"], one_row_per_key=True)) == values(
        metrics.evaluate(staff, names, ["department_id"]))

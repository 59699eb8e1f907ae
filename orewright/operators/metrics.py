"""Named metrics: aggregate expressions evaluated under any grouping and filter.

``metric(name)`` gives the expression, ``evaluate(df, names, by)`` groups and computes.
The frame is the fact with the dimension columns a metric names already joined.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orewright.functions.bands import order_bucket, rating_label
from orewright.functions.numbers import safe_divide
from orewright.operators.grains import related
from orewright.operators.retail import recognized

METRICS: dict[str, Callable[[], Column]] = {}


def _metric(name: str):
    def keep(make: Callable[[], Column]) -> Callable[[], Column]:
        METRICS[name] = make
        return make

    return keep


def metric(name: str) -> Column:
    if name not in METRICS:
        raise KeyError(f"unknown metric {name!r}")
    return METRICS[name]().alias(name)


def evaluate(
    df: DataFrame, names: Sequence[str], by: Sequence[str] = (), one_row_per_key: bool = False
) -> DataFrame:
    """The named metrics under a grouping.

    With ``one_row_per_key`` a group has at most one row for each order or employee, and distinct
    counts are plain ones: several of them would otherwise repeat every row once for each.
    """
    made = {**METRICS, **ROW_COUNTS} if one_row_per_key else METRICS
    return df.groupBy(*by).agg(*[made[n]().alias(n) for n in names])


def _simple(name: str, make: Callable[[], Column]) -> None:
    METRICS[name] = make


def _ratio(name: str, top: str, bottom: str, otherwise: float | None = None) -> None:
    METRICS[name] = lambda: safe_divide(METRICS[top](), METRICS[bottom](), otherwise)


def _minus(name: str, left: str, right: str) -> None:
    METRICS[name] = lambda: METRICS[left]() - METRICS[right]()


# --- retail: over the item-level fact with ``est_profit``, or its order-level sums -------
def _recognized(col: str) -> Column:
    # A metric is not SQL: a blank status is none of the excluded ones, so it counts.
    return F.when(F.coalesce(recognized(F.col("order_status")), F.lit(True)), F.col(col))


_simple("recognized_revenue", lambda: F.sum(_recognized("net_sales")))
_simple("gross_revenue", lambda: F.sum("gross_sales"))
_simple("units", lambda: F.sum("quantity"))
_simple("estimated_gross_profit", lambda: F.sum("est_profit"))

# --- workforce: over employees ----------------------------------------------------------
_simple("budgeted_headcount", lambda: F.sum("head_count_budget"))


# --- counts of orders and of employees --------------------------------------------------
def _counting(distinct: Callable[[Column], Column]) -> dict[str, Callable[[], Column]]:
    """Metrics that count keys, by a distinct count or, over one row for each key, a plain one."""
    def staff(test: Callable[[], Column] | None = None) -> Column:
        who = F.col("employee_id")
        return distinct(who if test is None else F.when(test(), who))

    m: dict[str, Callable[[], Column]] = {
        "orders": lambda: distinct(F.col("order_id")),
        "recognized_orders": lambda: distinct(_recognized("order_id")),
        "aov": lambda: safe_divide(METRICS["recognized_revenue"](), m["recognized_orders"]()),
        "total_headcount": staff,
        "active_employees": lambda: staff(lambda: F.col("is_active")),
        "active_employees_2": lambda: staff(lambda: F.upper(F.col("is_active").cast("string")) == "TRUE"),
        "inactive_employees": lambda: m["total_headcount"]() - m["active_employees"](),
        "turnover_rate": lambda: safe_divide(m["inactive_employees"](), m["total_headcount"]()),
        "active_employee_pct": lambda: safe_divide(m["active_employees"](), m["total_headcount"]()),
        "female_employees": lambda: staff(lambda: F.col("gender") == "Female"),
        "female_employee_pct": lambda: safe_divide(m["female_employees"](), m["total_headcount"]()),
    }
    return m


METRICS.update(_counting(F.countDistinct))
ROW_COUNTS = _counting(F.count)
# Over rows of which ``_first`` marks one for each key.
FIRST_COUNTS = _counting(lambda key: F.count(F.when(F.col("_first"), key)))

# --- pay: over employees ----------------------------------------------------------------
_simple("average_salary", lambda: F.avg("salary"))
# Exact, with a counter per distinct salary in the buffer; ``exact_median`` holds no buffer.
_simple("median_salary", lambda: F.median("salary"))
_simple("min_salary", lambda: F.min("salary"))
_simple("max_salary", lambda: F.max("salary"))
_minus("salary_range", "max_salary", "min_salary")
_simple("average_tenure", lambda: F.avg("tenure_years"))
_ratio("salary_per_tenure_year", "average_salary", "average_tenure")

# --- performance: over reviews ----------------------------------------------------------
def _low(rating: Column) -> Column:
    """Below three; a blank rating compares as zero."""
    return F.coalesce(rating, F.lit(0)) < 3


_simple("review_count", lambda: F.count(F.lit(1)))
_simple("reviewed_employees", lambda: F.countDistinct("employee_id"))
_simple("average_goals_met_pct", lambda: F.avg("goals_met_pct"))
_simple("average_rating", lambda: F.avg("overall_rating"))
_simple(
    "high_performers",
    lambda: F.countDistinct(F.when(F.col("overall_rating") >= 4, F.col("employee_id"))),
)
_simple(
    "low_performers",
    lambda: F.countDistinct(F.when(_low(F.col("overall_rating")), F.col("employee_id"))),
)
_ratio("high_performer_pct", "high_performers", "reviewed_employees")
_ratio("low_performer_pct", "low_performers", "reviewed_employees")
_simple("performance_band_label", lambda: rating_label(F.avg("overall_rating")))
_simple(
    "average_rating_active",
    lambda: F.avg(F.when(F.col("is_active"), F.col("overall_rating"))),
)

# --- ledger: over transactions of every status ------------------------------------------


def _of_type(kind: str, sign: int, subgroup: str | None = None) -> Column:
    test = F.col("account_type") == kind
    if subgroup:
        test = test & (F.col("account_subgroup") == subgroup)
    net = F.col("credit_amount") - F.col("debit_amount")
    return F.sum(F.when(test, net if sign > 0 else -net))


_simple("total_revenue", lambda: _of_type("Revenue", 1))
_simple("total_expenses", lambda: _of_type("Expense", -1))


@_metric("gross_margin_pct")
def _gross_margin() -> Column:
    # A period without cost of revenue has its whole revenue as margin, as a blank counts as 0.
    revenue = METRICS["total_revenue"]()
    cost = F.coalesce(_of_type("Expense", -1, "Cost of Revenue"), F.lit(0))
    return safe_divide(revenue - cost, revenue, 0)


def profit_lines(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Fact rows with category, and sales less estimated cost; a blank on either side counts as zero."""
    looked = related(fact, products, "product_id", ["category", "unit_cost"])
    cost = F.coalesce(F.col("unit_cost") * F.col("quantity"), F.lit(0))
    return looked.withColumn("est_profit", F.coalesce("net_sales", F.lit(0)) - cost)


def order_grain(lines: DataFrame, by: Sequence[str]) -> DataFrame:
    """Fact rows summed per order under the given grouping.

    The sums add up further and the order ids stay countable, so every retail metric gives
    the same value on this smaller frame; distinct counts then run over orders, not lines.
    """
    sums = ("net_sales", "gross_sales", "quantity", "est_profit")
    return lines.groupBy(*by, "order_id", "order_status").agg(*[F.sum(c).alias(c) for c in sums])


def bucket_revenue(sales: DataFrame, customers: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    """Recognized revenue by order-count bucket of the customer, and by order dimensions.

    Revenue and order counts come from the same per-customer sums, so the sales are read
    once. A customer that is not in the dimension has no bucket.
    """
    per = sales.groupBy("customer_id", *dims).agg(
        METRICS["recognized_revenue"]().alias("_revenue"), F.count("order_id").alias("_n")
    )
    # A customer has at most one row per combination of the dimensions here.
    orders = F.sum("_n").over(Window.partitionBy("customer_id")) if dims else F.col("_n")
    known = customers.select("customer_id", F.lit(True).alias("_known"))
    placed = per.withColumn("_n", orders).join(known, "customer_id", "left")
    bucket = F.when(F.col("_known"), order_bucket(F.col("_n")))
    return placed.groupBy(bucket.alias("Order_Bucket"), *dims).agg(
        F.sum("_revenue").alias("recognized_revenue")
    )


def review_scores(reviews: DataFrame, by: Sequence[str]) -> DataFrame:
    """All review metrics under one grouping, over one row per employee.

    The same values as ``evaluate`` gives for these names. Reviews shrink to an employee's
    sums and extremes first; who scored high or low is then a plain count, where several
    distinct counts would repeat every review once for each.
    """
    rating, active = F.col("overall_rating"), F.col("is_active")
    per = reviews.groupBy(*by, "employee_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("goals_met_pct").alias("_goals"), F.count("goals_met_pct").alias("_goals_n"),
        F.sum(rating).alias("_rating"), F.count(rating).alias("_rating_n"),
        F.max(rating).alias("_best"), F.bool_or(_low(rating)).alias("_low"),
        F.sum(F.when(active, rating)).alias("_active"), F.count(F.when(active, rating)).alias("_active_n"),
    )
    totals = per.groupBy(*by).agg(
        F.sum("_n").alias("review_count"),
        F.count("employee_id").alias("reviewed_employees"),
        safe_divide(F.sum("_goals"), F.sum("_goals_n")).alias("average_goals_met_pct"),
        safe_divide(F.sum("_rating"), F.sum("_rating_n")).alias("average_rating"),
        F.count(F.when(F.col("_best") >= 4, F.col("employee_id"))).alias("high_performers"),
        F.count(F.when(F.col("_low"), F.col("employee_id"))).alias("low_performers"),
        safe_divide(F.sum("_active"), F.sum("_active_n")).alias("average_rating_active"),
    )
    reviewed = F.col("reviewed_employees")
    return totals.withColumns(
        {
            "high_performer_pct": safe_divide(F.col("high_performers"), reviewed),
            "low_performer_pct": safe_divide(F.col("low_performers"), reviewed),
            "performance_band_label": rating_label(F.col("average_rating")),
        }
    )


def exact_median(df: DataFrame, value: str, by: Sequence[str], name: str) -> DataFrame:
    """Median of a column per group, from running counts of its distinct values, which spill.

    Rows of equal value are counted before they are put in order; NULLs count for nothing.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*by)
    placed = counts.withColumns(
        {"_upto": F.sum("_n").over(group.orderBy(value)), "_all": F.sum("_n").over(group)}
    )

    def at(place: Column) -> Column:
        return F.max(F.when((F.col("_upto") >= place) & (F.col("_upto") - F.col("_n") < place), F.col(value)))

    low, high = F.floor((F.col("_all") + 1) / 2), F.floor(F.col("_all") / 2) + 1
    return placed.groupBy(*by).agg(((at(low) + at(high)).cast("double") / 2).alias(name))


def staff_grain(employees: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row for each employee of a group: whether any of their rows is active, and is female."""
    return employees.groupBy(*by, "employee_id").agg(
        F.bool_or("is_active").alias("is_active"),
        F.max(F.when(F.col("gender") == "Female", "Female")).alias("gender"),
    )


def default_sum(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """What a numeric column shows when no metric is named: its sum."""
    return df.groupBy(*by).agg(*[F.sum(c).alias(f"sum_{c}") for c in columns])


def workforce_by(employees: DataFrame, departments: DataFrame, by: str) -> DataFrame:
    """Headcounts against budget per value of a department column.

    The budget is summed on the departments, never on the joined rows, which would repeat it.
    Employees of an unknown department are a blank member's, a department without staff has
    counts of zero, and a blank budget counts as zero in the variance.
    """
    names = departments.select("department_id", F.col(by).alias("_by"))
    placed = employees.join(names, "department_id", "left").drop(by).withColumnRenamed("_by", by)
    heads = evaluate(
        staff_grain(placed, [by]),
        ["total_headcount", "active_employees", "active_employees_2", "inactive_employees", "turnover_rate"],
        [by], one_row_per_key=True,
    )
    budget = evaluate(departments, ["budgeted_headcount"], [by])
    counts = ["total_headcount", "active_employees", "active_employees_2", "inactive_employees"]
    held = heads.withColumnRenamed(by, "_by")
    both = budget.join(held, F.col(by).eqNullSafe(F.col("_by")), "full").withColumns(
        {by: F.coalesce(by, "_by"), **{c: F.coalesce(c, F.lit(0)) for c in counts}}
    )
    gap = F.col("total_headcount") - F.coalesce("budgeted_headcount", F.lit(0))
    return both.drop("_by").withColumns(
        {
            "headcount_variance": gap,
            "headcount_variance_pct": safe_divide(gap, F.col("budgeted_headcount")),
            "headcount_to_budget_ratio": safe_divide(
                F.col("total_headcount"), F.col("budgeted_headcount")
            ),
        }
    )


def review_coverage(employees: DataFrame, reviews: DataFrame, by: str) -> DataFrame:
    """Employees with a review against headcount, from two facts brought to one grain; a blank group is a group too."""
    heads = evaluate(employees, ["total_headcount"], [by])
    seen = evaluate(reviews, ["reviewed_employees"], [by]).toDF("_by", "employees_with_reviews")
    return heads.join(seen, F.col(by).eqNullSafe(F.col("_by")), "left").drop("_by").withColumn(
        "review_coverage_pct",
        safe_divide(F.col("employees_with_reviews"), F.col("total_headcount")),
    )

"""Cross-source queries: counts, revenue per department, efficiency, customer 360, upserts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orewright.functions.text import as_millions, looked_up, with_thousands
from orewright.operators.dedupe import dedupe_latest


def source_counts(sources: Mapping[str, DataFrame]) -> DataFrame:
    """UNION ALL of one count per named source."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("source"), "row_count")
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def revenue_by_dept(
    sales: DataFrame, summary: DataFrame, departments: DataFrame, division: str
) -> DataFrame:
    """All sales set against each department of a division.

    The definition pairs every sale with every department. As each department meets the
    same sales, their totals are computed once and read as a scalar subquery. No sales, no rows.
    """
    totals = sales.agg(
        F.struct(F.count("order_id").alias("orders"), F.sum("net_sales").alias("net")).alias("t")
    ).scalar()
    paired = departments.filter(F.col("division") == division).select(
        "department_id", "department_name", "division"
    ).join(summary.select("department_id", "active_headcount"), "department_id")
    grain = ("department_name", "division", "active_headcount")
    # Departments sharing name, division and headcount form one group and add up.
    groups = paired.groupBy(*grain).agg(F.count(F.lit(1)).alias("_copies")).withColumn("_t", totals)
    revenue = F.col("_t.net") * F.col("_copies")
    return groups.filter(F.col("_t.orders") > 0).select(
        *grain,
        F.col("_t.orders").alias("total_orders"),
        F.round(revenue, 2).alias("total_revenue"),
        F.round(F.try_divide(revenue, F.col("active_headcount")), 2).alias("revenue_per_employee"),
    )


def efficiency_metrics(departments: DataFrame, summary: DataFrame, orders: DataFrame) -> DataFrame:
    """Headcount, pay and order totals per division.

    The definition crosses departments with orders, so headcount and pay are counted once
    per order and order totals once per department. Two aggregates give the same numbers.
    """
    totals = orders.agg(
        F.struct(
            F.count(F.lit(1)).alias("rows"),
            F.countDistinct("order_id").alias("orders"),
            F.sum("order_total").alias("total"),
        ).alias("t")
    ).scalar()
    pay = F.col("avg_salary") * F.col("active_headcount")
    divisions = (
        departments.select("department_id", "division")
        .join(summary.select("department_id", "active_headcount", "avg_salary"), "department_id")
        .groupBy("division")
        .agg(
            F.count(F.lit(1)).alias("_departments"),
            F.sum("active_headcount").alias("_heads"),
            F.sum(pay).alias("_pay"),
        )
        .withColumn("_t", totals)
    )
    return divisions.filter(F.col("_t.rows") > 0).select(
        "division",
        # Heads times orders outgrows 64 bits long before either does.
        (F.col("_heads").cast("decimal(19,0)") * F.col("_t.rows")).alias("total_headcount"),
        (F.col("_pay") * F.col("_t.rows")).alias("total_compensation"),
        F.col("_t.orders").alias("mirrored_order_count"),
        F.round(F.col("_t.total") * F.col("_departments"), 2).alias("mirrored_revenue"),
    )


def completed_order_summary(orders: DataFrame, done: str = "Completed") -> DataFrame:
    return orders.filter(F.col("order_status") == done).groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.round(F.sum("order_total"), 2).alias("total_spend"),
        F.round(F.avg("order_total"), 2).alias("avg_order_value"),
        F.max("order_date").alias("last_order_date"),
    )


def customer_360(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers with their completed orders; NULLs stay where there are none."""
    people = customers.select(
        F.col("customer_id").alias("crm_customer_id"), "first_name", "last_name", "company_name",
        "industry", "region", F.col("lifetime_value").alias("crm_lifetime_value"),
    )
    bought = completed_order_summary(orders).withColumnRenamed("customer_id", "crm_customer_id")
    return people.join(bought, "crm_customer_id", "left")


def apply_changes(
    target: DataFrame, feed: DataFrame, keys: Sequence[str], order_by: Sequence[str], op: str = "_op"
) -> DataFrame:
    """Target after the feed: per key the last change wins, and a delete removes the row.

    The feed has the target's columns plus the ordering columns and ``op``. It shrinks to
    one row per key before it meets the target.
    """
    keys = list(keys)
    last = dedupe_latest(feed, keys, list(order_by))
    untouched = target.join(last.select(*keys), keys, "left_anti")
    kept = last.filter(F.coalesce(F.col(op), F.lit("")) != "delete").select(*target.columns)
    return untouched.unionByName(kept)


# Data sources, how each is attached, its unified table and its metric's label.
DATA_SOURCES = (
    ("CRM Customers", "Mirrored", "unified_customer_360", "Customer Records"),
    ("ERP Orders", "Mirrored", "unified_customer_360", "Total Orders"),
    ("HR Workforce", "Shortcut", "unified_efficiency_metrics", "Employee Count"),
    ("Retail Sales", "Shortcut", "unified_revenue_by_dept", "Total Revenue"),
)


def metric_label(source):
    return looked_up(source, {row[0]: row[3] for row in DATA_SOURCES})


def cross_source_kpis(c360: DataFrame, efficiency: DataFrame, revenue: DataFrame) -> DataFrame:
    """The four headline numbers, one row."""
    people = c360.agg(
        F.count("crm_customer_id").alias("total_customers"), F.sum("total_orders").alias("total_orders")
    )
    return people.withColumns(
        {
            "retail_revenue": revenue.agg(F.sum("total_revenue").alias("x")).scalar(),
            "total_headcount": efficiency.agg(F.sum("total_headcount").alias("x")).scalar(),
        }
    )


def integration_metrics(sources: DataFrame, kpis: DataFrame) -> DataFrame:
    """One metric per data source: its value, its formatted form and its label."""
    v = kpis.select(
        F.struct("total_customers", "total_orders", "total_headcount", "retail_revenue").alias("k")
    ).scalar()
    source = F.col("data_source")
    held = sources.withColumn("_k", v)
    value = looked_up(
        source,
        {
            "CRM Customers": F.col("_k.total_customers").cast("double"),
            "ERP Orders": F.col("_k.total_orders").cast("double"),
            "HR Workforce": F.col("_k.total_headcount").cast("double"),
            "Retail Sales": F.col("_k.retail_revenue").cast("double"),
        },
    )
    shown = F.when(source == "Retail Sales", as_millions(F.col("integration_metric"))).otherwise(
        with_thousands(F.col("integration_metric"))
    )
    return (
        held.withColumn("integration_metric", value)
        .withColumn("integration_metric_formatted", shown)
        .withColumn("metric", metric_label(source))
        .drop("_k")
    )

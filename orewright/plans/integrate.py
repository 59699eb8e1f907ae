"""Cross-source queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orewright.operators import integrate as op
from orewright.plans import retail, workforce
from orewright.plans.registry import query
from orewright.sources import adapters as given
from orewright.sources import tables
from orewright.sources.adapters import Given, shared

DIVISION = "ASIA"
KPI_SQL = """
    SELECT (SELECT count(crm_customer_id) FROM x_360) AS total_customers,
      (SELECT CAST(sum(total_orders) AS BIGINT) FROM x_360) AS total_orders,
      (SELECT sum(total_revenue) FROM x_revenue) AS retail_revenue,
      (SELECT CAST(sum(total_headcount) AS BIGINT) FROM x_efficiency) AS total_headcount"""


@shared
def c360(g: Given) -> DataFrame:
    return op.customer_360(given.crm_customers(g), given.erp_orders(g))


@shared
def revenue(g: Given) -> DataFrame:
    return op.revenue_by_dept(
        retail.sales(g), workforce.summary(g), workforce.departments(g), DIVISION
    )


@shared
def efficiency(g: Given) -> DataFrame:
    return op.efficiency_metrics(workforce.departments(g), workforce.summary(g), given.erp_orders(g))


@shared
def kpis(g: Given) -> DataFrame:
    return op.cross_source_kpis(c360(g), efficiency(g), revenue(g))


@query(
    "U-01",
    sql="""
    SELECT 'Retail - Sales Facts' AS source, count(*) AS row_count FROM r_fact
    UNION ALL SELECT 'Retail - Customers', count(*) FROM r_dim_customer
    UNION ALL SELECT 'HR - Employees', count(*) FROM h_employees
    UNION ALL SELECT 'HR - Departments', count(*) FROM h_departments
    UNION ALL SELECT 'CRM - Customers (Mirrored)', count(*) FROM x_crm
    UNION ALL SELECT 'ERP - Orders (Mirrored)', count(*) FROM x_orders""",
)
def source_counts(g: Given) -> DataFrame:
    # Names of the sources in the connectivity check.
    return op.source_counts(
        {
            "Retail - Sales Facts": retail.fact(g),
            "Retail - Customers": retail.customers(g),
            "HR - Employees": workforce.employees(g),
            "HR - Departments": workforce.departments(g),
            "CRM - Customers (Mirrored)": given.crm_customers(g),
            "ERP - Orders (Mirrored)": given.erp_orders(g),
        }
    )


@query(
    "S-14",
    sql="""
    SELECT 'customer' AS table_name, count(*) AS row_count FROM customer
    UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem""",
)
def table_counts(g: Given) -> DataFrame:
    return tables.table_counts({n: g.table(n) for n in ("customer", "part", "orders", "lineitem")})


@query("J-12", "O-03", sql="SELECT * FROM x_revenue", real=["total_revenue", "revenue_per_employee"])
def revenue_by_dept(g: Given) -> DataFrame:
    return revenue(g)


@query("J-13", sql="SELECT * FROM x_efficiency",
       real=["total_headcount", "total_compensation", "mirrored_revenue"])
def efficiency_metrics(g: Given) -> DataFrame:
    return efficiency(g)


@query("J-14", "A-13", sql="SELECT * FROM x_360", text=["last_order_date"],
       real=["crm_lifetime_value", "total_spend"])
def customer_360(g: Given) -> DataFrame:
    return c360(g)


@query("M-36", "V-11", sql=KPI_SQL, real=["retail_revenue", "total_headcount"])
def report_cross_source_kpis(g: Given) -> DataFrame:
    return kpis(g)


@query(
    "M-37", "S-15", "F-05", "F-16", "V-11",
    sql=f"""
    SELECT data_source, integration_type, unified_table, integration_metric,
      CASE WHEN data_source = 'Retail Sales' THEN CAST(CAST(round(integration_metric / 1000000) AS BIGINT) AS VARCHAR) || 'M'
           ELSE format('{{:,}}', CAST(round(integration_metric) AS BIGINT)) END AS integration_metric_formatted, metric
    FROM (
      SELECT 'CRM Customers' AS data_source, 'Mirrored' AS integration_type, 'unified_customer_360' AS unified_table,
        CAST(total_customers AS DOUBLE) AS integration_metric, 'Customer Records' AS metric FROM ({KPI_SQL})
      UNION ALL SELECT 'ERP Orders', 'Mirrored', 'unified_customer_360', total_orders, 'Total Orders' FROM ({KPI_SQL})
      UNION ALL SELECT 'HR Workforce', 'Shortcut', 'unified_efficiency_metrics', total_headcount, 'Employee Count' FROM ({KPI_SQL})
      UNION ALL SELECT 'Retail Sales', 'Shortcut', 'unified_revenue_by_dept', retail_revenue, 'Total Revenue' FROM ({KPI_SQL}))""",
)
def integration_metrics(g: Given) -> DataFrame:
    return op.integration_metrics(tables.source_map(g.spark), kpis(g))


@query("S-10", sql="""
    SELECT n_nationkey, count(*) AS customers FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY 1""")
def register_refs(g: Given) -> DataFrame:
    """References by name, then a query that uses only the names."""
    tables.register_refs(g.spark, {"ref_nation": g.path("nation"), "ref_customer": g.path("customer")})
    return g.spark.sql(
        "SELECT n_nationkey, count(*) AS customers FROM ref_nation JOIN ref_customer"
        " ON n_nationkey = c_nationkey GROUP BY n_nationkey"
    )


def mirror_target(g: Given) -> DataFrame:
    """What the replica holds before the feed: customers, with no order seen yet."""
    return g.table("customer").select(
        F.col("c_custkey").alias("customer_id"), F.lit(None).cast("long").alias("last_order"),
        F.lit(None).cast("string").alias("last_status"),
    )


def mirror_feed(orders: DataFrame) -> DataFrame:
    """Orders as changes to their customer, batch or stream; a pending order deletes it."""
    return orders.select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("last_order"),
        F.col("o_orderstatus").alias("last_status"), F.col("o_orderdate").alias("_at"),
        F.col("o_orderkey").alias("_seq"),
        F.when(F.col("o_orderstatus") == "P", "delete").otherwise("upsert").alias("_op"),
    )


MIRROR_SQL = """
    WITH last AS (
      SELECT o_custkey, o_orderkey, o_orderstatus FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    SELECT o_custkey AS customer_id, o_orderkey AS last_order, o_orderstatus AS last_status FROM last WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT c_custkey, NULL, NULL FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM last)"""


@query("S-11", sql=MIRROR_SQL)
def apply_changes(g: Given) -> DataFrame:
    return op.apply_changes(
        mirror_target(g), mirror_feed(g.table("orders")), ["customer_id"], ["_at", "_seq"]
    )

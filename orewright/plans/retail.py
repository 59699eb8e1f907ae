"""Retail queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orewright.operators import retail as op
from orewright.operators.dedupe import dedupe_latest as keep_latest
from orewright.operators.shaping import head, slice_rows
from orewright.plans.checks import RECOGNIZED
from orewright.plans.registry import query
from orewright.sources import adapters as given
from orewright.sources.adapters import Given, shared


@shared
def items(g: Given) -> DataFrame:
    return op.clean_items(given.retail_items(g))


@shared
def orders(g: Given) -> DataFrame:
    return op.clean_orders(given.retail_orders(g))


@shared
def customers(g: Given) -> DataFrame:
    return op.clean_customers(given.retail_customers(g))


@shared
def products(g: Given) -> DataFrame:
    return op.conform_products(given.retail_products(g))


@shared
def sales(g: Given) -> DataFrame:
    """Order-level sales, what most aggregates start from."""
    return op.order_sales(items(g), orders(g))


@shared
def fact(g: Given) -> DataFrame:
    return op.fact_sales(items(g), orders(g))


@shared
def value(g: Given) -> DataFrame:
    return op.customer_value(sales(g), customers(g))


@shared
def dim_customer_of(g: Given) -> DataFrame:
    return op.dim_customer(customers(g), sales(g))


@query(
    "A-01", "P-07", "F-19", "F-20",
    sql=f"""
    SELECT order_date, channel, count(DISTINCT order_id) AS orders, sum(gross_sales) AS gross_sales,
      sum(net_sales) AS net_sales, sum(tax_amount) AS tax_amount,
      sum(CASE WHEN order_status IN ('cancelled', 'refunded') THEN net_sales ELSE 0 END) AS cancelled_refunded_net_sales,
      sum(CASE WHEN {RECOGNIZED} THEN net_sales ELSE 0 END) AS recognized_net_sales
    FROM r_fact GROUP BY order_date, channel""",
    text=["order_date"],
    real=["gross_sales", "net_sales", "tax_amount", "cancelled_refunded_net_sales", "recognized_net_sales"],
)
def daily_sales(g: Given) -> DataFrame:
    return op.daily_sales(sales(g))


@query("P-01", "F-01", "F-07", sql="SELECT * FROM r_customers_all", text=["created_at"])
def conform_customers(g: Given) -> DataFrame:
    return op.conform_customers(given.retail_customers(g))


@query("P-02", "F-01", "F-07", sql="SELECT * FROM r_products",
       text=["effective_from", "effective_to"], real=["unit_cost", "list_price"])
def conform_products(g: Given) -> DataFrame:
    return op.conform_products(given.retail_products(g))


@query("P-03", "F-01", "F-07", sql="SELECT * FROM r_orders", text=["order_datetime", "updated_at"])
def conform_orders(g: Given) -> DataFrame:
    return op.conform_orders(given.retail_orders(g))


@query("P-04", sql="SELECT * FROM r_items_typed WHERE quantity > 0 AND unit_price IS NOT NULL",
       text=["created_at"], real=["unit_price", "discount_amount", "tax_amount"])
def conform_items(g: Given) -> DataFrame:
    return op.conform_items(given.retail_items(g))


@query("P-05", "F-17", sql="SELECT * FROM r_items", text=["created_at"],
       real=["unit_price", "discount_amount", "tax_amount", "gross_sales", "net_sales"])
def enrich_items(g: Given) -> DataFrame:
    return items(g)


@query("W-01", sql="SELECT * FROM r_customers", text=["created_at"])
def dedupe_customers(g: Given) -> DataFrame:
    return customers(g)


@query(
    "W-02",
    sql="""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""",
    text=["l_shipdate"],
)
def dedupe_latest(g: Given) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    return keep_latest(
        g.table("lineitem").select(*columns), ["l_orderkey", "l_linenumber"], "l_shipdate",
        ties=["l_partkey", "l_suppkey", "l_extendedprice"],
    )


@query("W-02", sql="SELECT * FROM r_orders", text=["order_datetime", "updated_at"])
def dedupe_orders(g: Given) -> DataFrame:
    return orders(g)


@query("J-01", sql="SELECT * FROM r_fact", text=["order_date", "order_datetime"],
       real=["unit_price", "discount_amount", "tax_amount", "gross_sales", "net_sales"])
def fact_sales(g: Given) -> DataFrame:
    return fact(g)


@query(
    "A-01", "J-01",
    sql="""
    SELECT order_id, customer_id, order_date, order_datetime, order_status, channel, count(*) AS lines,
      count(net_sales) AS net_lines, CAST(sum(quantity) AS BIGINT) AS units, sum(gross_sales) AS gross_sales,
      sum(net_sales) AS net_sales, sum(tax_amount) AS tax_amount
    FROM r_fact GROUP BY ALL""",
    text=["order_date", "order_datetime"], real=["gross_sales", "net_sales", "tax_amount"],
)
def order_sales(g: Given) -> DataFrame:
    return sales(g)


@query(
    "F-08", "F-23",
    sql="""
    SELECT d AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
      CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name, CAST(day(d) AS INTEGER) AS day,
      strftime(d, '%a') AS day_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year
    FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM g_bounds)""",
    text=["date_key"],
)
def date_dim(g: Given) -> DataFrame:
    return op.date_dim(given.calendar_bounds(g))


@query("P-06", sql="SELECT * FROM r_products",
       text=["effective_from", "effective_to"], real=["unit_cost", "list_price"])
def select_dim(g: Given) -> DataFrame:
    return op.dim_product(products(g))


@query("J-03", "A-04", "F-13", sql="SELECT * FROM r_dim_customer", text=["created_at"])
def dim_customer(g: Given) -> DataFrame:
    return dim_customer_of(g)


@query("J-02", "A-03", sql="SELECT * FROM r_value", text=["last_order_datetime"],
       real=["lifetime_net_sales"], ratios=["avg_order_value"])
def customer_value(g: Given) -> DataFrame:
    return value(g)


@query(
    "J-15", "A-02",
    sql=f"""
    SELECT f.order_date, p.category, count(DISTINCT f.order_id) AS orders, CAST(sum(f.quantity) AS BIGINT) AS units,
      sum(f.net_sales) AS net_sales, sum(f.quantity * p.unit_cost) AS est_cogs,
      sum(f.net_sales) - sum(f.quantity * p.unit_cost) AS est_gross_profit
    FROM r_fact f JOIN r_products p ON f.product_id = p.product_id WHERE {RECOGNIZED} GROUP BY ALL""",
    text=["order_date"], real=["net_sales", "est_cogs", "est_gross_profit"],
)
def category_performance(g: Given) -> DataFrame:
    return op.category_performance(fact(g), products(g))


@query(
    "A-14",
    sql=f"""
    SELECT count(DISTINCT customer_id) AS customers_any,
      count(DISTINCT CASE WHEN {RECOGNIZED} THEN customer_id END) AS customers_recognized FROM r_fact""",
)
def distinct_customers(g: Given) -> DataFrame:
    return op.distinct_customers(sales(g))


@query(
    "A-15",
    sql="""SELECT min(lifetime_orders) AS min_orders, max(lifetime_orders) AS max_orders,
      avg(lifetime_orders) AS avg_orders FROM r_value""",
    ratios=["avg_orders"],
)
def lifetime_order_stats(g: Given) -> DataFrame:
    return op.lifetime_order_stats(value(g))


@query("A-16", sql="SELECT quantile_disc(lifetime_orders, 0.5) AS median_orders FROM r_value")
def median_orders(g: Given) -> DataFrame:
    return op.median_orders(value(g))


@query("A-17", "O-01", sql="SELECT order_status, count(*) AS cnt FROM r_fact GROUP BY order_status")
def status_counts(g: Given) -> DataFrame:
    return op.status_counts(sales(g))


@query("A-17", "O-01",
       sql="SELECT channel, count(DISTINCT order_id) AS orders FROM r_fact GROUP BY channel")
def channel_orders(g: Given) -> DataFrame:
    return op.channel_orders(sales(g))


@query("A-15", sql="SELECT min(order_date) AS min_date, max(order_date) AS max_date FROM r_fact",
       text=["min_date", "max_date"])
def sales_date_range(g: Given) -> DataFrame:
    return op.sales_date_range(sales(g))


@query("P-07", sql=f"SELECT order_id, order_status FROM r_orders WHERE {RECOGNIZED}")
def recognized(g: Given) -> DataFrame:
    kept = orders(g).filter(op.recognized(F.col("order_status")))
    return kept.select("order_id", "order_status")


@query(
    "P-22",
    sql="""
    SELECT order_id, order_date, channel, net_sales FROM r_fact
    WHERE channel IS NOT NULL AND order_date < DATE '2000-01-01' AND channel IN ('1-urgent', '5-low')""",
    text=["order_date"], real=["net_sales"],
)
def slice_report(g: Given) -> DataFrame:
    picked = slice_rows(
        fact(g), not_null=["channel"], below={"order_date": "2000-01-01"},
        one_of={"channel": ["1-urgent", "5-low"]},
    )
    return picked.select("order_id", "order_date", "channel", "net_sales")


@query("O-04", sql="""
    SELECT order_status, count(*) AS cnt FROM r_fact GROUP BY order_status
    ORDER BY cnt DESC, order_status LIMIT 50""")
def head_report(g: Given) -> DataFrame:
    """The printed status table, which shows at most 50 rows."""
    return head(op.status_counts(sales(g)), 50)

"""Retail: conform, order-level sales, star schema and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orewright.functions.bands import order_bucket
from orewright.functions.dates import day, stamp
from orewright.functions.numbers import RETAIL_MONEY, money, whole
from orewright.functions.text import lowered, titled, trimmed, uppered
from orewright.operators.dedupe import dedupe_latest
from orewright.operators.shaping import conform, select_dim

# One cleaning rule per column; columns not listed pass through.
CUSTOMER_RULES = {
    "created_at": stamp,
    "email": lowered,
    "phone": trimmed,
    "first_name": titled,
    "last_name": titled,
    "city": titled,
    "state": uppered,
    "postal_code": trimmed,
}
PRODUCT_RULES = {
    "sku": trimmed,
    "product_name": trimmed,
    "category": titled,
    "brand": titled,
    "unit_cost": money,
    "list_price": money,
    "effective_from": day,
    "effective_to": day,
}
ORDER_RULES = {
    "order_datetime": stamp,
    "updated_at": stamp,
    "order_status": lowered,
    "channel": lowered,
    "payment_method": lowered,
    "ship_city": titled,
    "ship_state": uppered,
    "ship_postal_code": trimmed,
}
ITEM_RULES = {
    "created_at": stamp,
    "quantity": whole,
    "unit_price": money,
    "discount_amount": money,
    "tax_amount": money,
}

# Statuses whose sales are not recognized.
UNRECOGNIZED = ("cancelled", "refunded")

CUSTOMER_COLUMNS = (
    "customer_id", "created_at", "first_name", "last_name", "email", "phone",
    "city", "state", "postal_code", "country", "loyalty_tier", "is_active",
)
PRODUCT_COLUMNS = (
    "product_id", "sku", "product_name", "category", "brand", "unit_cost",
    "list_price", "is_discontinued", "effective_from", "effective_to",
)


def conform_customers(raw: DataFrame) -> DataFrame:
    return conform(raw, CUSTOMER_RULES)


def conform_products(raw: DataFrame) -> DataFrame:
    return conform(raw, PRODUCT_RULES)


def conform_orders(raw: DataFrame) -> DataFrame:
    return conform(raw, ORDER_RULES)


def conform_items(raw: DataFrame) -> DataFrame:
    """Typed items; rows without a positive quantity or without a price are dropped."""
    typed = conform(raw, ITEM_RULES)
    return typed.filter((F.col("quantity") > 0) & F.col("unit_price").isNotNull())


def enrich_items(items: DataFrame) -> DataFrame:
    """Add gross and net sales; a NULL discount or an amount out of range leaves NULL."""
    gross = F.col("quantity") * F.col("unit_price")
    return items.withColumns(
        {
            "gross_sales": gross.try_cast(RETAIL_MONEY),
            "net_sales": (gross - F.col("discount_amount")).try_cast(RETAIL_MONEY),
        }
    )


def clean_customers(raw: DataFrame) -> DataFrame:
    """One row per email, the newest; rows without an email all stay."""
    return dedupe_latest(
        conform_customers(raw), "email", "created_at", ties=["customer_id"], nulls="keep"
    )


def clean_orders(raw: DataFrame) -> DataFrame:
    """One row per order, the last updated."""
    return dedupe_latest(
        conform_orders(raw), "order_id", "updated_at",
        ties=["order_datetime", "customer_id", "order_status", "channel", "payment_method"],
    )


def clean_items(raw: DataFrame) -> DataFrame:
    return enrich_items(conform_items(raw))


def recognized(status: Column) -> Column:
    """True for statuses that count as sales. NULL status: neither this nor its opposite."""
    return ~status.isin(*UNRECOGNIZED)


def fact_sales(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Item-level fact. A hot order id is split by the adaptive skew join."""
    header = orders.select(
        "order_id",
        "customer_id",
        F.to_date("order_datetime").alias("order_date"),
        "order_datetime",
        *[lowered(F.col(c)).alias(c) for c in ("order_status", "channel", "payment_method")],
    )
    return items.join(header, "order_id").select(
        "order_item_id", "order_id", "customer_id", "product_id", "order_date", "order_datetime",
        "order_status", "channel", "payment_method", "quantity", "unit_price", "discount_amount",
        "tax_amount", "gross_sales", "net_sales",
    )


def _order_sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("lines"),
        F.count("net_sales").alias("net_lines"),
        F.sum("quantity").alias("units"),
        F.sum("gross_sales").alias("gross_sales"),
        F.sum("net_sales").alias("net_sales"),
        F.sum("tax_amount").alias("tax_amount"),
    ]


ORDER_ATTRIBUTES = ("customer_id", "order_date", "order_datetime", "order_status", "channel")


def order_sales(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Order-level sales: one row per order that has items.

    Items shrink to one row per order before they meet the orders, on the key the join
    needs anyway: partial sums leave each map task, the exchange serves aggregate and join,
    and an order holding a third of the items is already a single row when joined. What
    needs distinct orders afterwards is a plain count of rows.
    """
    return items.groupBy("order_id").agg(*_order_sums()).join(order_header(orders), "order_id")


def order_header(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id",
        "customer_id",
        F.to_date("order_datetime").alias("order_date"),
        "order_datetime",
        *[lowered(F.col(c)).alias(c) for c in ("order_status", "channel")],
    )


def order_sales_of(fact: DataFrame) -> DataFrame:
    """The same order-level rows from a stored item-level fact."""
    return fact.groupBy("order_id", *ORDER_ATTRIBUTES).agg(*_order_sums())


def daily_sales(sales: DataFrame) -> DataFrame:
    """Date x channel totals from order-level sales."""
    ok = recognized(F.col("order_status"))
    return sales.groupBy("order_date", "channel").agg(
        F.count("order_id").alias("orders"),
        F.sum("gross_sales").alias("gross_sales"),
        F.sum("net_sales").alias("net_sales"),
        F.sum("tax_amount").alias("tax_amount"),
        F.sum(F.when(~ok, F.col("net_sales")).otherwise(0)).alias("cancelled_refunded_net_sales"),
        F.sum(F.when(ok, F.col("net_sales")).otherwise(0)).alias("recognized_net_sales"),
    )


def category_performance(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Date x category totals over recognized sales, with estimated cost and profit."""
    sold = fact.filter(recognized(F.col("order_status"))).select(
        "order_date", "order_id", "product_id", "quantity", "net_sales"
    )
    priced = sold.join(products.select("product_id", "category", "unit_cost"), "product_id")
    cost = F.sum(F.col("quantity") * F.col("unit_cost"))
    return priced.groupBy("order_date", "category").agg(
        F.countDistinct("order_id").alias("orders"),
        F.sum("quantity").alias("units"),
        F.sum("net_sales").alias("net_sales"),
        cost.alias("est_cogs"),
        (F.sum("net_sales") - cost).alias("est_gross_profit"),
    )


def customer_value(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Lifetime value of every customer; orders and sales are 0 for one who bought nothing.

    ``avg_order_value`` is the mean over item lines, under the name the reports use.
    """
    bought = (
        sales.filter(recognized(F.col("order_status")))
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("_orders"),
            F.sum("net_sales").alias("_net"),
            F.sum("net_lines").alias("_lines"),
            F.max("order_datetime").alias("last_order_datetime"),
        )
    )
    return customers.select("customer_id").join(bought, "customer_id", "left").select(
        "customer_id",
        F.coalesce("_orders", F.lit(0)).alias("lifetime_orders"),
        F.coalesce("_net", F.lit(0)).alias("lifetime_net_sales"),
        F.try_divide("_net", "_lines").alias("avg_order_value"),
        "last_order_datetime",
    )


def orders_per_customer(sales: DataFrame) -> DataFrame:
    """Orders of every status."""
    return sales.groupBy("customer_id").agg(F.count("order_id").alias("order_count"))


def dim_customer(customers: DataFrame, sales: DataFrame) -> DataFrame:
    return (
        select_dim(customers, CUSTOMER_COLUMNS)
        .join(orders_per_customer(sales), "customer_id", "left")
        .withColumn("Order_Bucket", order_bucket(F.col("order_count")))
        .drop("order_count")
    )


def dim_product(products: DataFrame) -> DataFrame:
    return select_dim(products, PRODUCT_COLUMNS)


def date_dim(bounds: DataFrame) -> DataFrame:
    """Calendar rows for each day from ``first_day`` to ``last_day`` of a one-row frame."""
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date_key"))
    d = F.col("date_key")
    return days.select(
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.day(d).alias("day"),
        F.date_format(d, "E").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
    )


def distinct_customers(sales: DataFrame) -> DataFrame:
    """Customers with any order and with a recognized one.

    One row per customer first, so the two distinct counts become plain counts.
    """
    ok = F.coalesce(recognized(F.col("order_status")), F.lit(False))
    per_customer = sales.groupBy("customer_id").agg(F.max(ok).alias("_ok"))
    return per_customer.agg(
        F.count("customer_id").alias("customers_any"),
        F.count(F.when(F.col("_ok"), F.col("customer_id"))).alias("customers_recognized"),
    )


def lifetime_order_stats(value: DataFrame) -> DataFrame:
    return value.agg(
        F.min("lifetime_orders").alias("min_orders"),
        F.max("lifetime_orders").alias("max_orders"),
        F.avg("lifetime_orders").alias("avg_orders"),
    )


def median_orders(value: DataFrame) -> DataFrame:
    return value.agg(F.approx_percentile("lifetime_orders", 0.5).alias("median_orders"))


def status_counts(sales: DataFrame) -> DataFrame:
    """Fact rows per status, most frequent first."""
    counted = sales.groupBy("order_status").agg(F.sum("lines").alias("cnt"))
    return counted.orderBy(F.desc("cnt"), F.asc("order_status"))


def channel_orders(sales: DataFrame) -> DataFrame:
    counted = sales.groupBy("channel").agg(F.count("order_id").alias("orders"))
    return counted.orderBy(F.desc("orders"), F.asc("channel"))


def sales_date_range(sales: DataFrame) -> DataFrame:
    return sales.agg(F.min("order_date").alias("min_date"), F.max("order_date").alias("max_date"))

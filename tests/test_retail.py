from datetime import datetime
from decimal import Decimal as D

from conftest import values
from pyspark.sql import functions as F

from orewright.operators import retail
from orewright.operators.dedupe import dedupe_latest

CUSTOMER = ("customer_id long, created_at string, first_name string, last_name string, email string, phone string, "
            "city string, state string, postal_code string, country string, loyalty_tier string, is_active int")
ORDER = ("order_id long, customer_id long, order_datetime string, order_status string, channel string, "
         "payment_method string, ship_city string, ship_state string, ship_postal_code string, updated_at string")
ITEM = ("order_item_id long, order_id long, product_id long, quantity string, unit_price string, "
        "discount_amount string, tax_amount string, created_at string")


def customer(i, email, at="2024-01-01 00:00:00"):
    return (i, at, " ann ", "o'neil SMITH", email, " 1 ", " new york ", " ny ", " 01 ", "US", "Gold", 1)


def order(i, c=1, status="placed", at="2024-01-05 10:00:00", updated="2024-01-06"):
    return (i, c, at, status, " WEB ", "Card ", " paris ", " tx", " 9 ", updated)


def item(i, o, q="2", price="10.00", disc="1.00", product=1):
    return (i, o, product, q, price, disc, "0.50", "2024-01-05")


def test_customers_are_conformed_and_kept_once_per_email(frame):
    raw = frame(
        [customer(1, " A@x.com "), customer(2, "a@X.com", "2024-02-01"), customer(3, None), customer(4, None),
         customer(5, "b@x.com", "not a time"), customer(6, "b@x.com", None)],
        CUSTOMER,
    )
    clean = retail.clean_customers(raw)
    # Ids 5 and 6 tie on a NULL time; the higher id wins.
    assert values(clean, "customer_id", "email") == [(2, "a@x.com"), (3, None), (4, None), (6, "b@x.com")]
    first = clean.filter("customer_id = 2").first()
    assert (first.first_name, first.last_name, first.city, first.state, first.phone, first.postal_code) == (
        "Ann", "O'neil Smith", "New York", "NY", "1", "01")


def test_ties_fall_the_same_way_whatever_the_row_order(frame):
    rows = [("k", 1, 3), ("k", 1, 9), ("k", 1, 5), ("j", None, 1), ("j", 0, 0)]
    for given in (rows, rows[::-1]):
        out = dedupe_latest(frame(given, "k string, at int, tie int"), "k", "at", ties=["tie"])
        assert values(out) == [("j", 0, 0), ("k", 1, 9)]


def test_orders_keep_the_last_update(frame):
    raw = frame([order(1, status="placed", updated="2024-01-06"), order(1, status=" Shipped ", updated="2024-01-07"),
                 order(1, status="cancelled", updated=None)], ORDER)
    assert values(retail.clean_orders(raw), "order_id", "order_status", "channel") == [(1, "shipped", "web")]


def test_items_drop_bad_rows_and_a_null_discount_leaves_net_null(frame):
    raw = frame([item(1, 1), item(2, 1, q="0"), item(3, 1, q="-1"), item(4, 1, price=None), item(5, 1, q=None),
                 item(6, 1, disc=None), item(7, 1, price="junk")], ITEM)
    clean = retail.clean_items(raw)
    assert values(clean, "order_item_id", "gross_sales", "net_sales") == [
        (1, D("20.00"), D("19.00")), (6, D("20.00"), None)]
    assert dict(clean.dtypes)["net_sales"] == "decimal(12,2)"


def shop(frame):
    orders = [order(1, 1), order(2, 1, "cancelled"), order(3, 2, "refunded"), order(4, 3, None), order(5, 4)]
    items = [item(1, 1), item(2, 1, q="1", product=2), item(3, 2), item(4, 3), item(5, 4), item(6, 99)]
    return (retail.clean_items(frame(items, ITEM)), retail.clean_orders(frame(orders, ORDER)))


def test_fact_is_an_inner_join_of_items_and_orders(frame):
    items, orders = shop(frame)
    assert values(retail.fact_sales(items, orders), "order_item_id") == [(1,), (2,), (3,), (4,), (5,)]


def test_order_sales_from_items_equal_those_from_the_fact(frame):
    items, orders = shop(frame)
    direct = retail.order_sales(items, orders)
    again = retail.order_sales_of(retail.fact_sales(items, orders))
    assert values(direct, *sorted(direct.columns)) == values(again, *sorted(direct.columns))


def test_a_null_status_is_in_neither_conditional_sum(frame):
    row = retail.daily_sales(retail.order_sales(*shop(frame))).first()
    assert row.orders == 4
    assert row.net_sales == D("19.00") * 4 + D("9.00")
    assert row.cancelled_refunded_net_sales == D("38.00")
    assert row.recognized_net_sales == D("28.00")


def test_customer_value_keeps_customers_without_recognized_orders(frame):
    customers = frame([(i,) for i in (1, 2, 3, 7)], "customer_id long")
    value = retail.customer_value(retail.order_sales(*shop(frame)), customers)
    got = {r.customer_id: r for r in value.collect()}
    assert (got[1].lifetime_orders, got[1].lifetime_net_sales) == (1, D("28.00"))
    # The mean is over the two item lines, not over the order.
    assert got[1].avg_order_value == D("14.00")
    for i in (2, 3, 7):
        assert (got[i].lifetime_orders, got[i].lifetime_net_sales, got[i].avg_order_value,
                got[i].last_order_datetime) == (0, 0, None, None)


def test_order_buckets_count_every_status(frame):
    counts = {1: 0, 2: 1, 3: 2, 4: 3, 5: 4, 6: 5, 7: 6, 8: 10, 9: 11, 10: 20, 11: 21}
    sales = frame([(c, n) for c, k in counts.items() for n in range(k)], "customer_id long, order_id long")
    columns = ", ".join(f"{c} string" for c in retail.CUSTOMER_COLUMNS if c != "customer_id")
    blank = (None,) * (len(retail.CUSTOMER_COLUMNS) - 1)
    customers = frame([(c, *blank) for c in counts], f"customer_id long, {columns}")
    got = {r.customer_id: r.Order_Bucket for r in retail.dim_customer(customers, sales).collect()}
    assert list(got[c] for c in sorted(got)) == ["0", "1", "2-3", "2-3", "4-5", "4-5", "6-10", "6-10", "11-20",
                                                 "11-20", "20+"]


def test_category_performance_leaves_out_unknown_products_and_unrecognized_sales(frame):
    items, orders = shop(frame)
    products = frame([(1, "Toys", D("4.00"))], "product_id long, category string, unit_cost decimal(12,2)")
    row = retail.category_performance(retail.fact_sales(items, orders), products).collect()
    assert len(row) == 1 and row[0].orders == 1 and row[0].units == 2
    assert (row[0].est_cogs, row[0].est_gross_profit) == (D("8.00"), D("11.00"))


def test_distinct_customers_any_and_recognized(frame):
    row = retail.distinct_customers(retail.order_sales(*shop(frame))).first()
    assert tuple(row) == (3, 1)


def test_date_dim_has_iso_weeks(spark):
    bounds = spark.sql("SELECT DATE '2024-12-29' AS first_day, DATE '2025-01-02' AS last_day")
    got = values(retail.date_dim(bounds), "date_key", "week_of_year", "month_name", "day_name", "quarter")
    assert [(str(r[0]), *r[1:]) for r in got] == [
        ("2024-12-29", 52, "December", "Sun", 4), ("2024-12-30", 1, "December", "Mon", 4),
        ("2024-12-31", 1, "December", "Tue", 4), ("2025-01-01", 1, "January", "Wed", 1),
        ("2025-01-02", 1, "January", "Thu", 1)]


def test_hot_keys_are_cut_down_before_the_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("at"))
    plan = dedupe_latest(df, "k", "at")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_timestamps_are_read_without_failing_the_job(frame):
    raw = frame([order(1, at="2024-13-45", updated="yes")], ORDER)
    row = retail.conform_orders(raw).first()
    assert row.order_datetime is None and row.updated_at is None
    assert retail.conform_orders(frame([order(1)], ORDER)).first().order_datetime == datetime(2024, 1, 5, 10)

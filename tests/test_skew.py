"""One key holding a third of all rows: joins are split, aggregates shrink before the exchange, no row is lost."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from orewright.operators import ledger, retail


@contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# Sizes a cluster would reach, brought down to the size of a test.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}
ROWS = 60_000


def hot(column):
    """A third of the rows on key 7, the others spread."""
    return F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).cast("long")


@pytest.fixture
def shop(spark):
    # Several input splits, as a split join reads whole map outputs.
    items = spark.range(0, ROWS, 1, 12).select(
        F.col("id").alias("order_item_id"), hot("id").alias("order_id"), (F.col("id") % 10).alias("product_id"),
        F.lit(2).alias("quantity"), F.lit("3.00").alias("unit_price"), F.lit("1.00").alias("discount_amount"),
        F.lit("0.10").alias("tax_amount"), F.sha2(F.col("id").cast("string"), 256).alias("created_at"))
    orders = spark.range(5000).select(
        F.col("id").alias("order_id"), (F.col("id") % 9).alias("customer_id"), F.lit("2024-01-05").alias("order_datetime"),
        F.lit("placed").alias("order_status"), F.lit("web").alias("channel"), F.lit("card").alias("payment_method"),
        *[F.lit("x").alias(c) for c in ("ship_city", "ship_state", "ship_postal_code")], F.lit("2024-01-06").alias("updated_at"))
    return retail.clean_items(items), retail.clean_orders(orders)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_the_join_of_a_hot_order_is_split(spark, shop):
    with settings(spark, SMALL):
        fact = retail.fact_sales(*shop)
        assert len(fact.select("order_item_id", "order_date").collect()) == ROWS
        wide = fact.select(F.xxhash64(*fact.columns).alias("h"))
        wide.collect()
        assert "skew=true" in final_plan(wide)


def test_a_hot_order_is_one_row_before_its_join(spark, shop):
    with settings(spark, SMALL):
        sales = retail.order_sales(*shop)
        rows = sales.collect()
        assert sum(r.lines for r in rows) == ROWS and "skew=true" not in final_plan(sales)
        assert retail.daily_sales(sales).first().orders == len(rows)


def test_a_hot_entry_is_split_and_its_lines_all_count(spark):
    lines = spark.range(0, ROWS, 1, 12).select(
        hot("id").cast("string").alias("journal_entry_id"), (F.col("id") % 100).cast("string").alias("line_number"),
        F.lit("1010").alias("account_id"), F.lit("CC1").alias("cost_center_id"), F.lit("1.00").alias("debit_amount"),
        F.lit("0.25").alias("credit_amount"), F.sha2(F.col("id").cast("string"), 256).alias("line_description"))
    headers = spark.range(5000).select(
        F.col("id").cast("string").alias("journal_entry_id"), F.lit("2024-01-05").alias("posting_date"),
        *[F.lit("x").alias(c) for c in ("description", "source_system", "created_by")], F.lit("Posted").alias("status"),
        F.lit("2024-01-05 01:00:00").alias("created_at"))
    one = dict(
        accounts=spark.sql("SELECT '1010' account_id, 'Cash' account_name, 'Asset' account_type, 'Balance Sheet' "
                           "financial_statement, 'Current Assets' account_subgroup, 'TRUE' is_active"),
        centers=spark.sql("SELECT 'CC1' cost_center_id, 'N' cost_center_name, 'G' department_group, 'B' manager_name, 'TRUE' is_active"),
        periods=spark.sql("SELECT 'FY2024-01' fiscal_period_id, '2024' fiscal_year, '1' fiscal_month, 'Q1' fiscal_quarter, "
                          "'2024-01-01' period_start_date, '2024-01-31' period_end_date, 'TRUE' is_closed"))
    books = dict(lines=ledger.stg_journal_entry_lines(lines), headers=ledger.stg_journal_entries(headers),
                 accounts=ledger.stg_chart_of_accounts(one["accounts"]), centers=ledger.stg_cost_centers(one["centers"]),
                 periods=ledger.stg_fiscal_periods(one["periods"]))
    with settings(spark, SMALL):
        totals = ledger.gl_totals(**books)
        row = totals.collect()
        assert len(row) == 1 and row[0].debit_amount == ROWS and row[0].net_amount == ROWS * 3 // 4
        rows = ledger.gl_transactions(**books)
        wide = rows.select(F.xxhash64("journal_entry_id", "line_description", "je_status").alias("h"))
        assert len(wide.collect()) == ROWS
        assert "skew=true" in final_plan(wide)

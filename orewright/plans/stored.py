"""Queries over tables stored in a form that later reads profit from: buckets, mergeable sets, rollups, counts, balances."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orewright.functions.numbers import safe_divide
from orewright.operators import distinct, ledger, quantiles, retail, rollups
from orewright.operators import metrics as metric
from orewright.operators.balances import Balances
from orewright.plans import ledger as ledger_plans
from orewright.plans import metrics as metric_plans
from orewright.plans import retail as retail_plans
from orewright.plans import workforce as workforce_plans
from orewright.plans.checks import COUNTED, RECOGNIZED
from orewright.plans.ledger import AMOUNTS
from orewright.plans.registry import REGISTRY, query
from orewright.session import work_folder
from orewright.sources import folders, tables
from orewright.sources.adapters import Given, shared

BUCKETS = 8
BUCKET_BYTES = 16 << 20


def bucket_count(sizes: int) -> int:
    """Buckets for given files of so many bytes: one task reads a bucket, so it holds ``BUCKET_BYTES`` of them at most."""
    count = BUCKETS
    while count * BUCKET_BYTES < sizes:
        count *= 2
    return count


def bucketed(g: Given, key: str, sources: dict[str, tuple[str, Callable[[Given], DataFrame]]]) -> list[DataFrame]:
    """Tables stored in buckets of a key that they share, as many for each, kept for as long as the given table it comes from."""
    buckets = bucket_count(sum(folders.signature(g.spark, g.path(source))[0] for source, _ in sources.values()))

    def stored(name: str, source: str, build: Callable[[Given], DataFrame]) -> DataFrame:
        def write(path: str) -> None:
            tables.write_bucketed(build(g), _named(g, path, name), key, buckets)

        return tables.table(g.spark, _named(g, g.kept(f"{name}-{buckets}-buckets", [source], write), name))

    return [stored(name, source, build) for name, (source, build) in sources.items()]


def _named(g: Given, path: str, name: str) -> str:
    """A table in a database that lies at a path."""
    database = f"orewright_{path.rsplit('-', 1)[1]}"
    g.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{path}'")
    return f"{database}.{name}"


@query("J-01", sql="SELECT * FROM r_fact", text=["order_date", "order_datetime"],
       real=["unit_price", "discount_amount", "tax_amount", "gross_sales", "net_sales"])
def fact_sales_bucketed(g: Given) -> DataFrame:
    """The fact from items and orders that lie in buckets of the order: neither side is shuffled."""
    items, orders = bucketed(g, "order_id", {"items": ("lineitem", retail_plans.items), "orders": ("orders", retail_plans.orders)})
    return retail.fact_sales(items, orders.hint("merge"))


@query(
    "J-07", "A-07",
    sql="""
    SELECT je_status, fiscal_period_id, fiscal_year, fiscal_month, fiscal_quarter, period_is_closed, account_id,
      account_name, account_type, financial_statement, account_subgroup, cost_center_id, cost_center_name,
      department_group, sum(debit_amount) AS debit_amount, sum(credit_amount) AS credit_amount,
      sum(net_amount) AS net_amount
    FROM gl GROUP BY ALL""",
    real=AMOUNTS,
)
def gl_totals_bucketed(g: Given) -> DataFrame:
    """Ledger totals from lines and headers in buckets of the entry: only partial sums are shuffled."""
    lines, headers = _ledger(g)
    return ledger.gl_totals(lines, headers, ledger_plans.accounts(g), ledger_plans.centers(g), ledger_plans.periods(g))


@query("J-07", "J-09", sql=REGISTRY["fact_gl_activity"].sql)
def fact_gl_activity_bucketed(g: Given) -> DataFrame:
    lines, headers = _ledger(g)
    dims = (ledger.dim_accounts(ledger_plans.accounts(g)), ledger.dim_cost_centers(ledger_plans.centers(g)),
            ledger.dim_fiscal_periods(ledger_plans.periods(g)))
    return ledger.fact_gl_activity(ledger.gl_transactions(lines, headers, *dims), *dims)


def _ledger(g: Given) -> list[DataFrame]:
    return bucketed(
        g, "journal_entry_id", {"lines": ("lineitem", ledger_plans.lines), "headers": ("orders", ledger_plans.entries)}
    )


# --- distinct counts at any grain ------------------------------------------------------------------------

# What is counted: which ids, and the classes of status that count. A metric takes a blank status as recognized, SQL does not.
COUNTS = {
    "customers": ("customers", ["yes", "no", "blank"]), "customers_recognized": ("customers", ["yes"]),
    "orders": ("orders", ["yes", "no", "blank"]), "recognized_orders": ("orders", ["yes", "blank"]),
}
GRAINS = {
    "all": [], "day": ["order_date"], "month": ["order_month"], "channel": ["channel"], "month x channel": ["order_month", "channel"],
}
FINE = ["order_date", "channel", "status"]
SHOWN = ["order_date", "order_month", "channel"]
_MONTH = "strftime(order_date, '%Y-%m')"


def month_of_day() -> Column:
    return F.date_format("order_date", "yyyy-MM")


def sales_sets(g: Given) -> DataFrame:
    """Customers and orders as sets per day, channel and class of status: the one table all counts come from."""
    def write(path: str) -> None:
        ok = retail.recognized(F.col("order_status"))
        sold = retail_plans.sales(g).withColumn("status", F.when(ok, "yes").when(~ok, "no").otherwise("blank"))
        sets = [
            distinct.id_sets(sold, column, FINE).withColumn("kind", F.lit(kind))
            for kind, column in (("customers", "customer_id"), ("orders", "order_id"))
        ]
        sets[0].unionByName(sets[1]).write.partitionBy("kind").parquet(path)

    return g.spark.read.parquet(g.kept("sales-sets", ["lineitem", "orders"], write))


def customer_sets_by_month(g: Given) -> DataFrame:
    """The sets of customers per month, channel and class of status, which all grains coarser than a day are merged from."""
    def write(path: str) -> None:
        sets = sales_sets(g).filter("kind = 'customers'").withColumn("order_month", month_of_day())
        distinct.merged_sets(sets, ["order_month", "channel", "status"]).write.parquet(path)

    held = g.spark.read.parquet(g.kept("customer-sets-by-month", ["lineitem", "orders"], write))
    return held.withColumns({"kind": F.lit("customers"), "order_date": F.lit(None).cast("date")})


def _grain_sql(name: str, columns: list[str]) -> str:
    shown = {"order_date": "CAST(order_date AS VARCHAR)", "order_month": _MONTH, "channel": "channel"}
    keys = ", ".join(f"{shown[c] if c in columns else 'CAST(NULL AS VARCHAR)'} AS {c}" for c in shown)
    return f"""SELECT '{name}' AS grain, {keys}, count(DISTINCT customer_id) AS customers,
      count(DISTINCT CASE WHEN {RECOGNIZED} THEN customer_id END) AS customers_recognized, count(DISTINCT order_id) AS orders,
      count(DISTINCT CASE WHEN {COUNTED} THEN order_id END) AS recognized_orders FROM r_fact GROUP BY ALL"""


@query("A-14", "M-03", "M-04", sql="\nUNION ALL ".join(_grain_sql(n, c) for n, c in GRAINS.items()))
def distinct_by_grain(g: Given) -> DataFrame:
    """Distinct customers and orders at five grains from one stored table of sets."""
    by_day = sales_sets(g).withColumn("order_month", month_of_day())
    customers = [
        distinct.set_sizes(_asked(sets, "customers", grains, ["block", "places", "bits"]), ["grain", *SHOWN, "name"], "n")
        for sets, grains in ((by_day, ["day"]), (customer_sets_by_month(g), ["all", "month", "channel", "month x channel"]))
    ]
    # An order has one day, channel and status, so it is in one set and sizes of sets add up.
    held = by_day.filter("kind = 'orders'").groupBy("kind", *FINE, "order_month").agg(F.sum(distinct.size()).alias("n"))
    sizes = customers[0].unionByName(customers[1]).unionByName(_asked(held, "orders", list(GRAINS), ["n"]))
    shown = [F.coalesce(F.sum(F.when(F.col("name") == c, F.col("n"))), F.lit(0)).alias(c) for c in COUNTS]
    return sizes.groupBy("grain", *SHOWN).agg(*shown)


def _asked(rows: DataFrame, kind: str, grains: list[str], columns: list[str]) -> DataFrame:
    """Rows of a kind once for each of the grains and each count that takes their status: grain, ``SHOWN``, name and the columns."""
    nothing = F.lit(None).cast("string")
    grain = F.explode(F.array(*[
        F.struct(F.lit(n).alias("grain"), *[(F.col(c).cast("string") if c in GRAINS[n] else nothing).alias(c) for c in SHOWN]) for n in grains
    ])).alias("g")
    counted = [F.when(F.col("status").isin(*classes), name) for name, (of, classes) in COUNTS.items() if of == kind]
    names = F.filter(F.array(*counted), lambda c: c.isNotNull()).alias("names")
    asked = rows.filter(F.col("kind") == kind).select(*columns, names, grain)
    return asked.select(*columns, "g.*", F.explode("names").alias("name"))


@query("J-17", "D-03", sql="""
    SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def orphans_by_set(g: Given) -> DataFrame:
    """Lines of orders that are unknown or pending, by the stored set of the others' keys: the lines are not shuffled."""
    def write(path: str) -> None:
        known = g.table("orders").filter("o_orderstatus <> 'P'")
        distinct.id_sets(known, "o_orderkey", []).write.parquet(path)

    known = g.spark.read.parquet(g.kept("known-orders", ["orders"], write))
    return distinct.not_in_set(g.table("lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", known)


# --- rollups and their router ----------------------------------------------------------------------------

# An order has one day, month and channel, but lines of many categories.
_PER_ORDER = frozenset({"category"})
SALES = rollups.Cube(
    measures={
        "recognized_revenue": rollups.Measure(metric.METRICS["recognized_revenue"]),
        "gross_revenue": rollups.Measure(metric.METRICS["gross_revenue"]),
        "units": rollups.Measure(metric.METRICS["units"]),
        "estimated_gross_profit": rollups.Measure(metric.METRICS["estimated_gross_profit"]),
        "orders": rollups.Measure(metric.METRICS["orders"], _PER_ORDER),
        "recognized_orders": rollups.Measure(metric.METRICS["recognized_orders"], _PER_ORDER),
    },
    metrics={"aov": (("recognized_revenue", "recognized_orders"), safe_divide)},
)
DAY = ("order_date", "month", "channel")
# Each with the rollup it is summed from; none: the fact, which is read once for all of them.
ROLLUPS = {
    "day-category": ((*DAY, "category"), None), "day": (DAY, "day-category"), "channel": (("month", "channel"), "day"),
    "category": (("category",), "day-category"),
}


@shared
def sales_lines(g: Given) -> DataFrame:
    """Lines with what they have from products and orders. Orders come last, so an order's rows lie together afterwards."""
    used = ["order_id", "category", "quantity", "gross_sales", "net_sales", "est_profit"]
    lines = metric.profit_lines(retail_plans.items(g), retail_plans.products(g)).select(*used)
    header = retail.order_header(retail_plans.orders(g)).drop("customer_id", "order_datetime")
    return lines.join(header, "order_id").withColumn("month", F.month("order_date"))


def finest_rollup(g: Given) -> DataFrame:
    """Sums by day and category. Orders are counted in each of their categories and, in ``…_once``, in the first only.

    Lines shrink to one row for an order and category where the join left them; counts are plain ones then, where
    distinct ones would repeat every line for each of them on its way through the exchange.
    """
    dims, _ = ROLLUPS["day-category"]
    rows = metric.order_grain(sales_lines(g), dims)
    rows = rows.withColumn("_first", F.row_number().over(Window.partitionBy("order_id").orderBy("category")) == 1)
    made = {**metric.METRICS, **metric.ROW_COUNTS}
    once = [metric.FIRST_COUNTS[m]().alias(f"{m}_once") for m in SALES.measures if SALES.measures[m].fixed]
    return rows.groupBy(*dims).agg(*[made[m]().alias(m) for m in SALES.measures], *once)


@shared
def sales_rollups(g: Given) -> list[rollups.Rollup]:
    """The stored rollups, written once: the finest from the fact, every other one from a finer one."""
    found: dict[str, rollups.Rollup] = {}
    measures = tuple(SALES.measures)
    for name, (dims, source) in ROLLUPS.items():
        def write(path: str, dims=dims, source=source) -> None:
            table = finest_rollup(g) if source is None else rollups.coarser(SALES, found[source], dims)
            table.write.parquet(path)

        table = g.spark.read.parquet(g.kept(f"rollup-{name}", ["lineitem", "orders", "part"], write))
        found[name] = rollups.Rollup(table, dims, measures, table.count())
    return list(found.values())


def rolled(g: Given, names: list[str], by: list[str], where=None) -> DataFrame:
    return rollups.answer(SALES, sales_rollups(g), names, by, lambda: sales_lines(g), where)


@query("V-02", "M-01", sql=f"""
    SELECT CAST(month(order_date) AS INTEGER) AS month, sum(CASE WHEN {COUNTED} THEN net_sales END) AS recognized_revenue
    FROM r_fact WHERE order_date < DATE '2027-01-01' GROUP BY 1""", real=["recognized_revenue"])
def rolled_revenue_by_month(g: Given) -> DataFrame:
    """The filter is on days, so the smallest rollup with days answers."""
    return rolled(g, ["recognized_revenue"], ["month"], {"order_date": lambda d: d < F.lit("2027-01-01").cast("date")}).orderBy(F.desc("recognized_revenue"))


@query("V-03", "M-01", sql=f"""
    SELECT channel, sum(CASE WHEN {COUNTED} THEN net_sales END) AS recognized_revenue FROM r_fact GROUP BY channel""", real=["recognized_revenue"])
def rolled_revenue_by_channel(g: Given) -> DataFrame:
    return rolled(g, ["recognized_revenue"], ["channel"]).orderBy(F.desc("recognized_revenue"))


@query("V-03", "M-01", "M-06", "M-07", sql=f"SELECT category, {metric_plans.RETAIL_SQL} GROUP BY category",
       real=metric_plans.RETAIL_REAL, ratios=["aov"])
def rolled_metrics_by_category(g: Given) -> DataFrame:
    """Distinct orders are asked for by category here, so the rollup that has only categories may answer."""
    return rolled(g, metric_plans.RETAIL, ["category"])


@query("V-04", "M-01", "M-02", "M-03", "M-04", "M-05", "M-06", "M-07", sql=f"SELECT {metric_plans.RETAIL_SQL}",
       real=metric_plans.RETAIL_REAL, ratios=["aov"])
def rolled_kpi_cards(g: Given) -> DataFrame:
    """Totals of distinct orders come from a rollup without categories."""
    return rolled(g, metric_plans.RETAIL, [])


@query("V-03", "M-03", "M-05", sql="""
    SELECT CAST(month(order_date) AS INTEGER) AS month, channel, count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units
    FROM r_fact GROUP BY ALL""")
def rolled_orders_by_month_and_channel(g: Given) -> DataFrame:
    return rolled(g, ["orders", "units"], ["month", "channel"])


# --- medians from stored counts --------------------------------------------------------------------------


@query("M-24", "A-16", sql="""
    SELECT 'department' AS grain, department_id AS value, CAST(median(salary) AS DOUBLE) AS median_salary FROM h_employees GROUP BY ALL
    UNION ALL SELECT 'year hired', CAST(year(hire_date) AS VARCHAR), CAST(median(salary) AS DOUBLE) FROM h_employees GROUP BY ALL
    UNION ALL SELECT 'all', NULL, CAST(median(salary) AS DOUBLE) FROM h_employees""")
def medians_by_grain(g: Given) -> DataFrame:
    """Median salaries at three grains from one table of counts by department and day of hire."""
    def write(path: str) -> None:
        quantiles.value_counts(workforce_plans.employees(g), "salary", ["department_id", "hire_date"]).write.parquet(path)

    counts = g.spark.read.parquet(g.kept("salary-counts", ["customer"], write))
    grains = {
        "department": F.col("department_id"), "year hired": F.year("hire_date").cast("string"), "all": F.lit(None).cast("string"),
    }
    asked = F.explode(F.array(*[F.struct(F.lit(n).alias("grain"), v.alias("value")) for n, v in grains.items()])).alias("g")
    asked = counts.select("salary", "n", asked).select("g.*", "salary", "n")
    return quantiles.median_of_counts(asked, "salary", ["grain", "value"], "median_salary")


# --- balances in blocks ----------------------------------------------------------------------------------


@query("W-03", "A-07", sql="""
    SELECT account_id, CAST(fiscal_year * 12 + fiscal_month - 1 AS BIGINT) AS period, net_activity AS amount,
      sum(net_activity) OVER (PARTITION BY account_id ORDER BY fiscal_year, fiscal_month ROWS UNBOUNDED PRECEDING) AS balance
    FROM g_activity""", real=["amount", "balance"])
def balances_from_blocks(g: Given) -> DataFrame:
    """Postings that came in three updates, the last one late by years, as running balances of every account."""
    totals = ledger.posted(ledger_plans.totals(g))
    number = (F.col("fiscal_year") * 12 + F.col("fiscal_month") - 1).cast("long")
    postings = totals.select("account_id", "cost_center_id", number.alias("period"), F.col("net_amount").alias("amount"))
    came = work_folder(g.spark, "postings")
    postings.write.parquet(came)
    postings = g.spark.read.parquet(came)
    kind = postings.schema["amount"].dataType
    book = Balances(g.spark, work_folder(g.spark, "balances"), ["account_id"], kind)
    late = F.crc32(F.concat("account_id", "cost_center_id")) % 10 == 0
    last = F.col("period") >= postings.agg(F.max("period")).scalar() - 11
    for number, part in enumerate((~late & ~last, ~late & last, late)):
        book.add(postings.filter(part).drop("cost_center_id"), number)
    return book.all()

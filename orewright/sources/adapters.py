"""The given tables, read as the inputs of each workload.

Every frame is a projection of whole tables (plus unions and one-row aggregates), built so
that the edge cases the operators handle occur: padded text, shared and missing emails,
customers without orders, orphan keys, listed amounts, unbalanced entries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orewright.session import work_folder
from orewright.sources import folders
from orewright.sources.timed import Timed, open_timed, write_timed

# Folders of derived tables that an application has written, by application, kind and state of the files they come from.
_KEPT: dict[tuple, str] = {}


class Given:
    """The given tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.frames: dict = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        if name not in self.frames:
            self.frames[name] = self.spark.read.parquet(self.path(name))
        return self.frames[name]

    def kept(self, kind: str, sources: Sequence[str], write: Callable[[str], None]) -> str:
        """The folder of a table derived from given ones: written once for as long as the given files stay as they are."""
        state = tuple((self.path(s), *folders.signature(self.spark, self.path(s))) for s in sources)
        key = (self.spark.sparkContext.applicationId, kind, state)
        if key not in _KEPT:
            path = work_folder(self.spark, kind)
            write(path)
            _KEPT[key] = path
        return _KEPT[key]

    def pattern(self, name: str) -> str:
        """A glob for the same table: a stream reads a single file or a folder through it."""
        return f"{self.folder}/{{{name}}}.parquet"


def shared(build: Callable[[Given], DataFrame]) -> Callable[[Given], DataFrame]:
    """Build a frame once per set of given tables, so a query that uses it twice plans it once."""

    @wraps(build)
    def held(g: Given) -> DataFrame:
        if build not in g.frames:
            g.frames[build] = build(g)
        return g.frames[build]

    return held


def _money(col: Column | str, size: str = "decimal(12,2)") -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast(size)


def _number(text: str, col: str) -> Column:
    return F.concat(F.lit(text), F.col(col).cast("string"))


# --- retail --------------------------------------------------------------------------


def retail_customers(g: Given) -> DataFrame:
    """Customers, and suppliers as customers that never ordered."""
    people = g.table("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.lower("c_mktsegment").alias("segment"),
    )
    firms = g.table("supplier").select(
        (-1 - F.col("s_suppkey")).alias("id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("segment"),
    )
    n = F.abs("id")
    shared = F.when(n % 10 == 9, F.concat(F.lit(" User"), (n - 1).cast("string"), F.lit("@Example.com ")))
    email = F.when(n % 25 != 0, F.coalesce(shared, F.concat(F.lit("user"), n.cast("string"), F.lit("@example.com"))))
    return people.unionByName(firms).select(
        F.col("id").alias("customer_id"),
        F.date_add(F.lit("1995-01-01").cast("date"), (n % 700).cast("int")).cast("timestamp").alias("created_at"),
        F.concat(F.lit(" "), F.col("segment"), F.lit(" ")).alias("first_name"),
        F.col("name").alias("last_name"),
        F.when(F.col("id") < 0, F.concat(F.lit("f"), F.col("id"), F.lit("@example.com"))).otherwise(email).alias("email"),
        F.concat(F.lit(" 555-"), n.cast("string")).alias("phone"),
        F.concat(F.lit("street "), F.col("nation").cast("string")).alias("street"),
        F.concat(F.lit(" town"), F.col("nation").cast("string")).alias("city"),
        F.substring("segment", 1, 2).alias("state"),
        F.concat(F.lpad(F.col("nation").cast("string"), 5, "0"), F.lit(" ")).alias("postal_code"),
        F.concat(F.lit("C"), F.col("nation").cast("string")).alias("country"),
        F.when(F.col("nation") < 10, "Bronze").when(F.col("nation") < 20, "Silver").otherwise("Gold").alias("loyalty_tier"),
        F.when(n % 10 == 0, 0).otherwise(1).alias("is_active"),
    )


def retail_products(g: Given) -> DataFrame:
    price = _money("p_retailprice")
    return g.table("part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit(" SKU-"), F.col("p_partkey").cast("string"), F.lit(" ")).alias("sku"),
        F.col("p_name").alias("product_name"),
        F.lower("p_type").alias("category"),
        F.upper("p_brand").alias("brand"),
        (price * F.lit("0.6").cast("decimal(2,1)")).alias("unit_cost"),
        price.alias("list_price"),
        F.when(F.col("p_size") > 45, 1).otherwise(0).alias("is_discontinued"),
        F.lit("1995-01-01").alias("effective_from"),
        F.lit(None).cast("string").alias("effective_to"),
    )


def retail_orders(g: Given) -> DataFrame:
    state = F.col("o_orderstatus")
    return g.table("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_datetime"),
        F.when(F.col("o_orderkey") % 41 == 0, None).when(state == "F", " Delivered").when(state == "O", "placed ")
        .otherwise("CANCELLED").alias("order_status"),
        F.col("o_orderpriority").alias("channel"),
        F.concat(F.lit("Card "), F.substring("o_orderpriority", 1, 1)).alias("payment_method"),
        F.concat(F.lit(" town"), F.substring("o_orderpriority", 1, 1)).alias("ship_city"),
        F.lower("o_orderstatus").alias("ship_state"),
        F.concat(F.lit(" "), F.substring("o_orderpriority", 1, 1)).alias("ship_postal_code"),
        F.lit("US").alias("ship_country"),
        F.col("o_orderdate").alias("updated_at"),
    )


def retail_items(g: Given) -> DataFrame:
    price = _money("l_extendedprice")
    return g.table("lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        price.alias("unit_price"),
        (price * _money("l_discount", "decimal(3,2)")).alias("discount_amount"),
        (price * _money("l_tax", "decimal(3,2)")).alias("tax_amount"),
        F.col("l_shipdate").alias("created_at"),
    )


def calendar_bounds(g: Given) -> DataFrame:
    """First and last order day, one row."""
    when = F.to_date("o_orderdate")
    return g.table("orders").agg(F.min(when).alias("first_day"), F.max(when).alias("last_day"))


# --- workforce -----------------------------------------------------------------------


def hr_departments(g: Given) -> DataFrame:
    nation, region = g.table("nation"), g.table("region")
    key = F.lpad(F.col("n_nationkey").cast("string"), 2, "0")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("D"), key).alias("department_id"),
        F.col("n_name").alias("department_name"),
        F.col("r_name").alias("division"),
        F.concat(F.lit("Site "), F.col("n_regionkey").cast("string")).alias("location"),
        F.concat(F.lit("CC"), key).alias("cost_center"),
        (F.lit(40) + F.col("n_nationkey")).cast("long").alias("head_count_budget"),
    )


def hr_employees(g: Given) -> DataFrame:
    """Customers as employees, one department further on: the last one is unknown, the first is empty."""
    n = F.col("c_custkey")
    hired = F.date_add(F.lit("2010-01-01").cast("date"), (n * 37 % 5900).cast("int"))
    stays = F.col("c_acctbal") >= 500
    return g.table("customer").select(
        _number("E", "c_custkey").alias("employee_id"),
        F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit("\t")).alias("first_name"),
        F.concat(F.substring("c_name", 1, 8), F.lit("\u0007"), F.substring("c_name", 9, 20)).alias("last_name"),
        F.concat(F.lit("e"), n.cast("string"), F.lit("@example.com ")).alias("email"),
        F.concat(F.lit("D"), F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0")).alias("department_id"),
        F.concat(F.lit("Job "), F.substring("c_mktsegment", 1, 1)).alias("job_title"),
        hired.alias("hire_date"),
        F.when(~stays, F.date_add(hired, 400)).alias("termination_date"),
        F.when(~stays, "Resigned").alias("termination_reason"),
        F.when(n % 7 == 0, "Part-time").otherwise("Full-time").alias("employment_type"),
        (F.floor(F.col("c_acctbal") / 10).cast("long") * 1000).alias("salary"),
        F.when(n % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.concat(F.lit("G"), (n % 5).cast("string")).alias("ethnicity"),
        F.concat(F.lit("L"), (n % 4).cast("string")).alias("education_level"),
        F.concat(F.lit("E"), F.floor(n / 10).cast("string")).alias("manager_id"),
        stays.alias("is_active"),
        F.concat(F.lit("Site "), F.col("c_nationkey").cast("string")).alias("location"),
    )


def hr_reviews(g: Given) -> DataFrame:
    when = F.to_date("o_orderdate")
    half = F.when(F.month(when) <= 6, "-H1").otherwise("-H2")
    return g.table("orders").select(
        _number("R", "o_orderkey").alias("review_id"),
        _number("E", "o_custkey").alias("employee_id"),
        F.concat(F.year(when).cast("string"), half).alias("review_cycle"),
        F.when(F.col("o_orderkey") % 37 != 0, F.substring("o_orderpriority", 1, 1).cast("long")).alias("overall_rating"),
        (F.floor("o_totalprice").cast("long") % 101).alias("goals_met_pct"),
        F.concat(F.lit("E"), (F.col("o_custkey") % 50).cast("string")).alias("reviewer_id"),
        when.alias("review_date"),
        F.col("o_orderpriority").alias("comments"),
    )


def hr_salary_history(g: Given) -> DataFrame:
    amount = F.floor(F.col("o_totalprice") / 1000).cast("long") * 1000
    return g.table("orders").select(
        _number("SH", "o_orderkey").alias("salary_history_id"),
        _number("E", "o_custkey").alias("employee_id"),
        F.to_date("o_orderdate").alias("effective_date"),
        F.when(F.col("o_orderstatus") == "P", -amount).otherwise(amount).alias("salary_amount"),
        F.col("o_orderpriority").alias("change_type"),
        (F.col("o_orderkey") % 10).cast("double").alias("change_pct"),
    )


# --- sensors -------------------------------------------------------------------------


def sensor_readings(events: DataFrame) -> DataFrame:
    """Readings from the events table, batch or stream."""
    at = F.col("ts").cast("timestamp")
    value = F.col("value")
    return events.select(
        F.col("event_id").alias("reading_id"),
        at.alias("event_time"),
        F.concat(F.lit("SENSOR-"), F.lpad(F.col("user_id").cast("string"), 3, "0")).alias("device_id"),
        F.col("event_type").alias("zone"),
        F.concat(F.lit("Kind "), (F.col("user_id") % 5).cast("string")).alias("equipment_type"),
        value.alias("temperature_celsius"),
        (F.lit(20.0) + value / 10).alias("pressure_psi"),
        (value / 20).alias("vibration_mms"),
        F.from_json("props", "k double").getField("k").alias("humidity_percent"),
        ((F.col("event_type") == "error") & (value > 20)).alias("is_anomaly"),
        _ingested_at(at).alias("_ingested_at"),
    )


def _ingested_at(event_time: Column) -> Column:
    """Some seconds after the event."""
    return event_time + F.make_dt_interval(secs=(F.col("event_id") % 7).cast("decimal(18,6)"))


def sensor_bodies(g: Given) -> DataFrame:
    """Events as JSON text, as they come from the wire; one kind is cut short and does not parse."""
    r = sensor_readings(g.table("events"))
    fields = ["device_id", "zone", "equipment_type", "temperature_celsius", "pressure_psi",
              "vibration_mms", "humidity_percent", "is_anomaly"]
    text = F.to_json(F.struct(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("event_time"), *fields))
    cut = F.when(F.col("zone") == "error", F.substring(text, 1, 20)).otherwise(text)
    return r.select("reading_id", cut.alias("body"))


def write_events(g: Given, path: str) -> None:
    """The events as an ingest job stores them: by day of their clock, with the ingestion clock's facts beside them."""
    events = g.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
    write_timed(events, path, "ts", {"_ingested_at": _ingested_at(F.col("ts"))})


def events_by_day(g: Given, path: str | None = None) -> Timed:
    """The stored events; by default those that this application keeps for all its reports."""
    path = path or g.kept("events", ["events"], lambda to: write_events(g, to))
    schema = g.table("events").withColumn("ts", F.col("ts").cast("timestamp")).schema
    return open_timed(g.spark, path, schema, "ts")


# --- ledger --------------------------------------------------------------------------


def ledger_entries(g: Given) -> DataFrame:
    """Raw headers, every column text."""
    state = F.col("o_orderstatus")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return g.table("orders").select(
        F.col("o_orderkey").cast("string").alias("journal_entry_id"),
        day.alias("posting_date"),
        F.concat(F.lit(" Priority "), F.col("o_orderpriority")).alias("description"),
        F.lit("ERP ").alias("source_system"),
        _number("clerk", "o_custkey").alias("created_by"),
        F.when(state == "F", "Posted").when(state == "O", "Reversed").otherwise("Draft").alias("status"),
        F.concat(day, F.lit(" 08:30:00")).alias("created_at"),
    )


def ledger_lines(g: Given, as_text: bool = False) -> DataFrame:
    """Raw lines: a debit and a credit line per order line.

    As they land, every column is text; numbers keep their types otherwise, as in a stored
    staging table, and staging accepts both. Returned lines are credited short by their
    line number in cents, so some entries do not balance.
    """
    shape = (lambda c: c.cast("string")) if as_text else (lambda c: c)
    returned = F.col("l_returnflag") == "R"
    cents = F.when(returned, F.col("l_linenumber")).otherwise(0).cast("decimal(10,0)")
    amount = _money("l_extendedprice", "decimal(18,2)")
    # The side is all that is exploded; what depends on it is picked afterwards.
    sides = g.table("lineitem").select(
        F.col("l_orderkey").cast("string").alias("journal_entry_id"),
        F.expr("CASE WHEN l_partkey % 2 = 0 THEN 0 ELSE 4 END + l_partkey div 2 % 5 * 5").alias("debit_to"),
        F.expr("1 + l_suppkey % 3 + l_suppkey div 3 % 5 * 5").alias("credit_to"),
        (F.col("l_suppkey") % 25).alias("center"),
        F.col("l_linenumber").alias("nr"),
        amount.alias("debit"),
        (amount - cents * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)").alias("credit"),
        F.col("l_returnflag").alias("line_description"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("side"),
    )
    is_debit, nothing = F.col("side") == 1, F.lit(0).cast("decimal(18,2)")

    def numbered(prefix: str, number: Column) -> Column:
        return F.concat(F.lit(prefix), F.lpad(number.cast("string"), 2, "0"))

    return sides.select(
        "journal_entry_id",
        shape(F.col("nr") * 2 - 2 + F.col("side")).alias("line_number"),
        numbered("A", F.when(is_debit, F.col("debit_to")).otherwise(F.col("credit_to"))).alias("account_id"),
        numbered("CC", F.col("center")).alias("cost_center_id"),
        shape(F.when(is_debit, F.col("debit")).otherwise(nothing)).alias("debit_amount"),
        shape(F.when(is_debit, nothing).otherwise(F.col("credit"))).alias("credit_amount"),
        "line_description",
    )


# Class of an account by its number modulo 5: type, statement, and subgroups of the first
# three and the last two accounts of the class.
ACCOUNT_CLASSES = (
    ("Asset", "Balance Sheet", "Current Assets", "Fixed Assets"),
    ("Liability", "Balance Sheet", "Current Liabilities", "Long-term Liabilities"),
    ("Equity", "Balance Sheet", "Shareholders Equity", "Shareholders Equity"),
    ("Revenue", "Income Statement", "Operating Revenue", "Non-operating Revenue"),
    ("Expense", "Income Statement", "Operating Expenses", "Non-operating Expenses"),
)


def ledger_accounts(g: Given) -> DataFrame:
    """One account per nation."""
    kind, place = F.col("n_nationkey") % 5, F.floor(F.col("n_nationkey") / 5)

    def by_class(i: int) -> Column:
        return F.element_at(F.array(*[F.lit(c[i]) for c in ACCOUNT_CLASSES]), kind + 1)

    group = F.when((kind == 4) & (place == 0), "Cost of Revenue").when(place < 3, by_class(2)).otherwise(by_class(3))
    return g.table("nation").select(
        F.concat(F.lit("A"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("account_id"),
        F.concat(F.lit(" Account "), F.col("n_name")).alias("account_name"),
        by_class(0).alias("account_type"),
        by_class(1).alias("financial_statement"),
        group.alias("account_subgroup"),
        F.when(F.col("n_nationkey") == 24, "False").otherwise("True").alias("is_active"),
    )


def ledger_centers(g: Given) -> DataFrame:
    nation, region = g.table("nation"), g.table("region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("CC"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("cost_center_id"),
        F.concat(F.lit("Center "), F.col("n_name")).alias("cost_center_name"),
        F.col("r_name").alias("department_group"),
        F.concat(F.lit("Manager "), F.col("n_nationkey").cast("string")).alias("manager_name"),
        F.lit("TRUE").alias("is_active"),
    )


def ledger_periods(g: Given) -> DataFrame:
    """A period per month from the first to the last posting; all but the last year are closed."""
    months = calendar_bounds(g).select(
        F.year("last_day").alias("_last"),
        F.explode(
            F.expr("sequence(trunc(first_day, 'MM'), trunc(last_day, 'MM'), interval 1 month)")
        ).alias("start"),
    )
    y, m = F.year("start").cast("string"), F.month("start")
    return months.select(
        F.concat(F.lit("FY"), y, F.lit("-"), F.lpad(m.cast("string"), 2, "0")).alias("fiscal_period_id"),
        y.alias("fiscal_year"),
        m.cast("string").alias("fiscal_month"),
        F.concat(F.lit("Q"), F.quarter("start").cast("string")).alias("fiscal_quarter"),
        F.col("start").alias("period_start_date"),
        F.last_day("start").alias("period_end_date"),
        F.when(F.year("start") < F.col("_last"), "True").otherwise("False").alias("is_closed"),
    )


def ledger_budgets(g: Given) -> DataFrame:
    """Supplier balances as budgets, one row per period, account and cost center; negative ones are 0."""
    key = F.col("s_suppkey")
    month = F.add_months(F.lit("1995-01-01").cast("date"), (key % 96).cast("int"))
    account = F.when(key % 2 == 0, 3).otherwise(4) + F.floor(key / 2) % 5 * 5
    amount = F.greatest(_money("s_acctbal", "decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))
    keyed = g.table("supplier").select(
        F.date_format(month, "'FY'yyyy-MM").alias("fiscal_period_id"),
        F.concat(F.lit("A"), F.lpad(account.cast("string"), 2, "0")).alias("account_id"),
        F.concat(F.lit("CC"), F.lpad((key % 25).cast("string"), 2, "0")).alias("cost_center_id"),
        amount.alias("amount"),
    )
    return keyed.groupBy("fiscal_period_id", "account_id", "cost_center_id").agg(
        F.sum("amount").cast("decimal(18,2)").alias("budget_amount"), F.lit("Original ").alias("budget_type")
    )


# --- cross-source --------------------------------------------------------------------


def crm_customers(g: Given) -> DataFrame:
    return g.table("customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.lit("Crm").alias("first_name"),
        F.col("c_name").alias("last_name"),
        _number("Company ", "c_nationkey").alias("company_name"),
        F.col("c_mktsegment").alias("industry"),
        F.concat(F.lit("R"), (F.col("c_nationkey") % 5).cast("string")).alias("region"),
        _money("c_acctbal").alias("lifetime_value"),
    )


def erp_orders(g: Given) -> DataFrame:
    state = F.col("o_orderstatus")
    return g.table("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _money("o_totalprice").alias("order_total"),
        F.to_date("o_orderdate").alias("order_date"),
        F.when(state == "F", "Completed").when(state == "O", "Open").otherwise("Pending").alias("order_status"),
    )

"""Scans and sinks: each query writes rows of the given tables and reads them back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orewright.plans.registry import query
from orewright.session import work_folder
from orewright.sources import adapters as given
from orewright.sources import audit, files, tables
from orewright.sources.adapters import Given

RUN_DATE = "2026-01-02"
CLOCK = "2026-01-02 03:04:05"


def _csv(g: Given, df: DataFrame, name: str, **options) -> str:
    """The folder of a CSV copy of ``df``; ``name`` ends in .csv as a file would."""
    base = work_folder(g.spark, "csv")
    df.write.options(header=True, **options).csv(f"{base}/{name}.csv")
    return base


def _table_name(g: Given, purpose: str) -> str:
    """A new table name in a database kept under the shared folder, where every executor can read it."""
    database = f"orewright_{uuid.uuid4().hex}"
    g.spark.sql(f"CREATE DATABASE {database} LOCATION '{work_folder(g.spark, 'database')}'")
    return f"{database}.{purpose}"


@query("S-01", sql="SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def read_csv(g: Given) -> DataFrame:
    source = g.table("customer")
    base = _csv(g, source, "customers")
    return files.read_csv(g.spark, base, "customers", source.schema)


@query("S-02", sql="""
    SELECT CAST(c_custkey AS VARCHAR) AS employee_id, '"' || c_mktsegment || '"' AS job_title,
      CASE WHEN c_nationkey <> 0 THEN CAST(c_nationkey AS BIGINT) END AS salary FROM customer""")
def read_typed_csv(g: Given) -> DataFrame:
    """Quote characters are text, and an amount that is no number becomes NULL."""
    source = g.table("customer").select(
        F.col("c_custkey").cast("string").alias("employee_id"),
        F.concat(F.lit('"'), F.col("c_mktsegment"), F.lit('"')).alias("job_title"),
        F.when(F.col("c_nationkey") == 0, "n/a").otherwise(F.col("c_nationkey").cast("string")).alias("salary"),
    )
    base = _csv(g, source, "employees", quote="")
    schema = T.StructType(
        [T.StructField("employee_id", T.StringType()), T.StructField("job_title", T.StringType()),
         T.StructField("salary", T.LongType())]
    )
    return files.read_typed_csv(g.spark, f"{base}/employees.csv", schema)


@query("S-03", sql="""
    SELECT CAST(o_orderkey AS VARCHAR) AS journal_entry_id, o_orderpriority || ', "as said"' AS description,
      CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount FROM orders""")
def land_raw(g: Given) -> DataFrame:
    """Everything lands as text, with embedded commas and escaped quotes intact."""
    source = g.table("orders").select(
        F.col("o_orderkey").cast("string").alias("journal_entry_id"),
        F.concat(F.col("o_orderpriority"), F.lit(', "as said"')).alias("description"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )
    base = _csv(g, source, "journal_entries", quote='"', escape="\\")
    return files.land_raw(g.spark, f"{base}/journal_entries.csv", source.columns)


@query("S-02", "S-03", sql="""
    SELECT CAST(o_orderkey AS VARCHAR) AS journal_entry_id, NULL AS line, 'landed' AS outcome, CAST(o_totalprice AS DECIMAL(18,2)) AS amount
    FROM orders WHERE o_orderkey % 20 NOT IN (1, 2, 3)
    UNION ALL SELECT NULL, concat_ws(',', o_orderkey, CASE o_orderkey % 20 WHEN 1 THEN o_orderpriority || ',more' WHEN 3 THEN o_orderpriority END,
      CASE WHEN o_orderkey % 20 = 2 THEN o_orderpriority || ',n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END),
      CASE WHEN o_orderkey % 20 = 2 THEN 'value' ELSE 'width' END, NULL
    FROM orders WHERE o_orderkey % 20 IN (1, 2)
    UNION ALL SELECT NULL, CAST(o_orderkey AS VARCHAR) || ',' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), 'width', NULL
    FROM orders WHERE o_orderkey % 20 = 3""", real=["amount"])
def land_with_rejects(g: Given) -> DataFrame:
    """Orders as lines, some with a field too many, one too few or no number: every line lands or is set aside."""
    key, amount = F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    kind = F.col("o_orderkey") % 20
    line = F.concat_ws(
        ",", key, F.when(kind != 3, F.col("o_orderpriority")), F.when(kind == 1, "more"), F.when(kind == 2, "n/a").otherwise(amount)
    )
    columns = ["journal_entry_id", "description", "amount"]
    base = work_folder(g.spark, "lines")
    # One unquoted column whose name is the header.
    g.table("orders").select(line.alias(",".join(columns))).write.options(header=True, quote="", sep="\u0001").csv(base)
    landed = files.land(g.spark, base, columns, {"amount": "decimal(18,2)"})
    nothing = F.lit(None).cast("string")
    return landed.rows.select("journal_entry_id", nothing.alias("line"), F.lit("landed").alias("outcome"), "amount").unionByName(
        landed.rejected.select(nothing.alias("journal_entry_id"), "line", F.col("reason").alias("outcome"), F.lit(None).cast("decimal(18,2)").alias("amount"))
    )


@query("S-04", sql="""
    SELECT fiscal_period_id, account_id, cost_center_id, budget_amount, 'Original' AS budget_type FROM g_budgets""",
       real=["budget_amount"])
def load_seed(g: Given) -> DataFrame:
    source = given.ledger_budgets(g).withColumn("budget_type", F.trim("budget_type"))
    base = _csv(g, source, "budget_allocations")
    return files.load_seed(
        g.spark, f"{base}/budget_allocations.csv", source.columns, {"budget_amount": "decimal(18,2)"}
    )


@query("S-05", "S-07", sql="SELECT n_nationkey, n_name FROM nation")
def table(g: Given) -> DataFrame:
    name = _table_name(g, "scanned")
    tables.write_table(g.table("nation").select("n_nationkey", "n_name"), name)
    return tables.table(g.spark, name)


@query("S-06", "F-09", sql="""
    SELECT c_custkey, TIMESTAMP '2026-01-02 03:04:05' AS _ingested_at, 'customers.csv' AS _source_file,
      '20260102030405' AS _batch_id, '2026-01-02' AS _run_date FROM customer""", text=["_ingested_at"])
def add_meta(g: Given) -> DataFrame:
    return tables.add_meta(g.table("customer").select("c_custkey"), "customers.csv", RUN_DATE, CLOCK)


@query("S-07", sql="""
    SELECT s_suppkey, s_name, CAST(NULL AS INTEGER) AS s_nationkey FROM supplier
    UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier""")
def write_table(g: Given) -> DataFrame:
    """An overwrite, then an append that brings a new column."""
    name = _table_name(g, "grown")
    source = g.table("supplier")
    tables.write_table(source.select("s_suppkey", "s_name"), name)
    return tables.write_table(
        source.select("s_suppkey", "s_name", "s_nationkey"), name, mode="append", merge_schema=True
    )


@query("S-08", sql="SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY 1")
def replace_table(g: Given) -> DataFrame:
    """A derived table rebuilt twice, the second time from itself; the result stays the same."""
    name = _table_name(g, "derived")
    counts = g.table("supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("suppliers"))
    first = tables.replace_table(g.spark, name, counts)
    return tables.replace_table(g.spark, name, first.select("s_nationkey", "suppliers"))


@query("S-09", sql="""
    SELECT 'load_orders' AS pipeline_name, CAST(o_orderkey AS VARCHAR) AS pipeline_run_id,
      CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS run_date, 'gold' AS layer,
      CASE WHEN o_orderstatus = 'P' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
      CASE WHEN o_orderstatus = 'P' THEN 'pending' END AS error_message,
      CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderkey % 100 AS INTEGER) END AS duration_seconds,
      '2026-01-02 03:04:05' AS logged_at
    FROM orders""")
def append_audit(g: Given) -> DataFrame:
    """Every order as the run that loaded it."""
    failed = F.col("o_orderstatus") == "P"
    runs = g.table("orders").select(
        F.lit("load_orders").alias("pipeline_name"),
        F.col("o_orderkey").cast("string").alias("pipeline_run_id"),
        F.to_date("o_orderdate").cast("string").alias("run_date"),
        F.lit("gold").alias("layer"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(failed, "pending").otherwise("").alias("error_message"),
        F.when(failed, "").otherwise((F.col("o_orderkey") % 100).cast("string")).alias("duration_seconds"),
        F.lit(CLOCK).alias("logged_at"),
    )
    return audit.append_audit(audit.audit_log(runs), work_folder(g.spark, "audit"))

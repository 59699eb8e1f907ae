"""Check SQL: the canonical inputs as CTEs, and the wrapper that evens out result types."""

from __future__ import annotations

import re
from collections.abc import Sequence


def title(x: str) -> str:
    """Trimmed single word with a capital first letter."""
    return f"upper(substr(trim({x}), 1, 1)) || lower(substr(trim({x}), 2))"


def rounded(x: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


def key2(text: str, x: str) -> str:
    return f"'{text}' || lpad(CAST({x} AS VARCHAR), 2, '0')"


RECOGNIZED = "order_status NOT IN ('cancelled', 'refunded')"
# The metric layer's rule: a blank status is none of the excluded ones.
COUNTED = "(order_status IS NULL OR order_status NOT IN ('cancelled', 'refunded'))"
BREACH3 = "(temperature_celsius > 100 OR pressure_psi > 42 OR vibration_mms > 5.5)"
BREACH4 = "(temperature_celsius > 100 OR pressure_psi > 42 OR vibration_mms > 5.5 OR humidity_percent > 75)"

# In order of use: a CTE may name those above it.
CTES: dict[str, str] = {
    "r_people": """
        SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, lower(c_mktsegment) AS segment FROM customer
        UNION ALL SELECT -1 - s_suppkey, s_name, s_nationkey, 'supplier' FROM supplier""",
    "r_customers_raw": """
        SELECT id AS customer_id,
          CAST(DATE '1995-01-01' + CAST(abs(id) % 700 AS INTEGER) AS TIMESTAMP) AS created_at,
          ' ' || segment || ' ' AS first_name, name AS last_name,
          CASE WHEN id < 0 THEN 'f' || id || '@example.com'
               WHEN abs(id) % 25 = 0 THEN NULL
               WHEN abs(id) % 10 = 9 THEN ' User' || (abs(id) - 1) || '@Example.com '
               ELSE 'user' || abs(id) || '@example.com' END AS email,
          ' 555-' || abs(id) AS phone, 'street ' || nation AS street, ' town' || nation AS city,
          substr(segment, 1, 2) AS state, lpad(CAST(nation AS VARCHAR), 5, '0') || ' ' AS postal_code,
          'C' || nation AS country,
          CASE WHEN nation < 10 THEN 'Bronze' WHEN nation < 20 THEN 'Silver' ELSE 'Gold' END AS loyalty_tier,
          CASE WHEN abs(id) % 10 = 0 THEN 0 ELSE 1 END AS is_active
        FROM r_people""",
    "r_customers_all": f"""
        SELECT customer_id, created_at, {title('first_name')} AS first_name, {title('last_name')} AS last_name,
          lower(trim(email)) AS email, trim(phone) AS phone, street, {title('city')} AS city,
          upper(trim(state)) AS state, trim(postal_code) AS postal_code, country, loyalty_tier, is_active
        FROM r_customers_raw""",
    "r_customers": """
        SELECT * FROM r_customers_all
        QUALIFY email IS NULL
          OR row_number() OVER (PARTITION BY email ORDER BY created_at DESC NULLS LAST, customer_id DESC) = 1""",
    "r_products": f"""
        SELECT p_partkey AS product_id, 'SKU-' || p_partkey AS sku, p_name AS product_name,
          {title('p_type')} AS category, {title('p_brand')} AS brand,
          CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 0.6 AS DECIMAL(12,2)) AS unit_cost,
          CAST(p_retailprice AS DECIMAL(12,2)) AS list_price,
          CASE WHEN p_size > 45 THEN 1 ELSE 0 END AS is_discontinued,
          DATE '1995-01-01' AS effective_from, CAST(NULL AS DATE) AS effective_to
        FROM part""",
    "r_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_datetime,
          CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'delivered'
               WHEN o_orderstatus = 'O' THEN 'placed' ELSE 'cancelled' END AS order_status,
          lower(o_orderpriority) AS channel, 'card ' || substr(o_orderpriority, 1, 1) AS payment_method,
          'Town' || substr(o_orderpriority, 1, 1) AS ship_city, upper(o_orderstatus) AS ship_state,
          substr(o_orderpriority, 1, 1) AS ship_postal_code, 'US' AS ship_country, o_orderdate AS updated_at
        FROM orders""",
    "r_items_typed": """
        SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id,
          CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price,
          CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS discount_amount,
          CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS tax_amount,
          l_shipdate AS created_at
        FROM lineitem""",
    "r_items": """
        SELECT *, CAST(quantity * unit_price AS DECIMAL(12,2)) AS gross_sales,
          CAST(quantity * unit_price - discount_amount AS DECIMAL(12,2)) AS net_sales
        FROM r_items_typed WHERE quantity > 0 AND unit_price IS NOT NULL""",
    "r_fact": """
        SELECT i.order_item_id, o.order_id, o.customer_id, i.product_id, CAST(o.order_datetime AS DATE) AS order_date,
          o.order_datetime, o.order_status, o.channel, o.payment_method, i.quantity, i.unit_price,
          i.discount_amount, i.tax_amount, i.gross_sales, i.net_sales
        FROM r_items i JOIN r_orders o ON i.order_id = o.order_id""",
    "r_value": f"""
        SELECT c.customer_id, coalesce(a.n, 0) AS lifetime_orders, coalesce(a.s, 0) AS lifetime_net_sales,
          a.m AS avg_order_value, a.t AS last_order_datetime
        FROM r_customers c LEFT JOIN (
          SELECT customer_id, count(DISTINCT order_id) AS n, sum(net_sales) AS s, avg(net_sales) AS m, max(order_datetime) AS t
          FROM r_fact WHERE {RECOGNIZED} GROUP BY customer_id) a ON c.customer_id = a.customer_id""",
    "r_dim_customer": """
        SELECT c.customer_id, c.created_at, c.first_name, c.last_name, c.email, c.phone, c.city, c.state,
          c.postal_code, c.country, c.loyalty_tier, c.is_active,
          CASE WHEN n IS NULL THEN '0' WHEN n = 1 THEN '1' WHEN n BETWEEN 2 AND 3 THEN '2-3'
               WHEN n BETWEEN 4 AND 5 THEN '4-5' WHEN n BETWEEN 6 AND 10 THEN '6-10'
               WHEN n BETWEEN 11 AND 20 THEN '11-20' ELSE '20+' END AS "Order_Bucket"
        FROM r_customers c LEFT JOIN (
          SELECT customer_id, count(DISTINCT order_id) AS n FROM r_fact GROUP BY customer_id) k
        ON c.customer_id = k.customer_id""",
    "h_departments": f"""
        SELECT {key2('D', 'n_nationkey')} AS department_id, n_name AS department_name, r_name AS division,
          'Site ' || n_regionkey AS location, {key2('CC', 'n_nationkey')} AS cost_center,
          CAST(40 + n_nationkey AS BIGINT) AS head_count_budget
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "h_employees_raw": f"""
        SELECT 'E' || c_custkey AS employee_id, lower(c_mktsegment) AS first_name, c_name AS last_name,
          'e' || c_custkey || '@example.com' AS email, {key2('D', 'c_nationkey + 1')} AS department_id,
          'Job ' || substr(c_mktsegment, 1, 1) AS job_title,
          DATE '2010-01-01' + CAST(c_custkey * 37 % 5900 AS INTEGER) AS hire_date,
          CASE WHEN c_acctbal < 500 THEN DATE '2010-01-01' + CAST(c_custkey * 37 % 5900 + 400 AS INTEGER) END AS termination_date,
          CASE WHEN c_acctbal < 500 THEN 'Resigned' END AS termination_reason,
          CASE WHEN c_custkey % 7 = 0 THEN 'Part-time' ELSE 'Full-time' END AS employment_type,
          CAST(floor(c_acctbal / 10) AS BIGINT) * 1000 AS salary,
          CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender, 'G' || (c_custkey % 5) AS ethnicity,
          'L' || (c_custkey % 4) AS education_level, 'E' || (c_custkey // 10) AS manager_id,
          c_acctbal >= 500 AS is_active, 'Site ' || c_nationkey AS location
        FROM customer""",
    "h_employees": """
        SELECT employee_id, first_name, last_name, last_name || ' ' || first_name AS full_name, email,
          department_id, job_title, hire_date, termination_date, termination_reason, employment_type, salary,
          gender, ethnicity, education_level, manager_id, is_active, location,
          CAST(round_even(round_even((DATE '2026-01-01' - hire_date) / 365.25, 2), 0) AS BIGINT) AS tenure_years
        FROM h_employees_raw WHERE hire_date < DATE '2026-01-01' AND salary NOT IN (-78000, -71000)""",
    "h_reviews": """
        SELECT 'R' || o_orderkey AS review_id, 'E' || o_custkey AS employee_id,
          year(o_orderdate) || CASE WHEN month(o_orderdate) <= 6 THEN '-H1' ELSE '-H2' END AS review_cycle,
          CASE WHEN o_orderkey % 37 <> 0 THEN CAST(substr(o_orderpriority, 1, 1) AS BIGINT) END AS overall_rating,
          CAST(floor(o_totalprice) AS BIGINT) % 101 AS goals_met_pct, 'E' || (o_custkey % 50) AS reviewer_id,
          CAST(o_orderdate AS DATE) AS review_date, CASE WHEN o_orderkey % 37 = 0 THEN 'Unsatisfactory' ELSE 'Exceptional' END AS performance_band
        FROM orders""",
    "h_history": """
        SELECT 'SH' || o_orderkey AS salary_history_id, 'E' || o_custkey AS employee_id,
          CAST(o_orderdate AS DATE) AS effective_date,
          CAST(floor(o_totalprice / 1000) AS BIGINT) * 1000 * CASE WHEN o_orderstatus = 'P' THEN -1 ELSE 1 END AS salary_amount,
          o_orderpriority AS change_type, CAST(o_orderkey % 10 AS DOUBLE) AS change_pct
        FROM orders
        WHERE CAST(floor(o_totalprice / 1000) AS BIGINT) * 1000 * CASE WHEN o_orderstatus = 'P' THEN -1 ELSE 1 END
          NOT IN (-78000, -75000, -72000, -71000, -69000, -68000, -67000, -64000)""",
    "h_summary": f"""
        SELECT d.department_id, d.department_name, d.division, d.head_count_budget,
          count(CASE WHEN e.is_active THEN 1 END) AS active_headcount,
          d.head_count_budget - count(CASE WHEN e.is_active THEN 1 END) AS headcount_variance,
          {rounded('avg(CASE WHEN e.is_active THEN e.salary END)', 0)} AS avg_salary,
          min(CASE WHEN e.is_active THEN e.salary END) AS min_salary,
          max(CASE WHEN e.is_active THEN e.salary END) AS max_salary,
          {rounded('avg(CASE WHEN e.is_active THEN e.tenure_years END)', 1)} AS avg_tenure_years,
          count(CASE WHEN NOT e.is_active THEN 1 END) AS terminated_count,
          {rounded('count(CASE WHEN NOT e.is_active THEN 1 END) * 100.0 / count(*)', 1)} AS turnover_pct
        FROM h_departments d LEFT JOIN h_employees e ON d.department_id = e.department_id
        GROUP BY d.department_id, d.department_name, d.division, d.head_count_budget""",
    "s_readings": """
        SELECT event_id AS reading_id, ts AS event_time, 'SENSOR-' || lpad(CAST(user_id AS VARCHAR), 3, '0') AS device_id,
          event_type AS zone, 'Kind ' || (user_id % 5) AS equipment_type, value AS temperature_celsius,
          20.0 + value / 10 AS pressure_psi, value / 20 AS vibration_mms,
          CAST(json_extract(props, '$.k') AS DOUBLE) AS humidity_percent,
          event_type = 'error' AND value > 20 AS is_anomaly,
          ts + INTERVAL 1 SECOND * CAST(event_id % 7 AS INTEGER) AS _ingested_at
        FROM events""",
    "s_now": "SELECT max(_ingested_at) AS as_of FROM s_readings",
    "s_day": "SELECT r.* FROM s_readings r, s_now n WHERE r._ingested_at > n.as_of - INTERVAL 24 HOUR",
    "g_entries_raw": """
        SELECT CAST(o_orderkey AS VARCHAR) AS journal_entry_id, CAST(o_orderdate AS DATE) AS posting_date,
          'Priority ' || o_orderpriority AS description, 'ERP' AS source_system, 'clerk' || o_custkey AS created_by,
          CASE o_orderstatus WHEN 'F' THEN 'Posted' WHEN 'O' THEN 'Reversed' ELSE 'Draft' END AS status,
          CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL '8 hours 30 minutes' AS created_at
        FROM orders""",
    "g_entries": "SELECT * FROM g_entries_raw WHERE status IN ('Posted', 'Reversed')",
    "g_lines": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS journal_entry_id, l_linenumber * 2 - 1 AS line_number,
          {key2('A', '(CASE WHEN l_partkey % 2 = 0 THEN 0 ELSE 4 END + (l_partkey // 2) % 5 * 5)')} AS account_id,
          {key2('CC', 'l_suppkey % 25')} AS cost_center_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS debit_amount,
          CAST(0 AS DECIMAL(18,2)) AS credit_amount, CAST(l_extendedprice AS DECIMAL(18,2)) AS net_amount,
          l_returnflag AS line_description
        FROM lineitem
        UNION ALL
        SELECT CAST(l_orderkey AS VARCHAR), l_linenumber * 2,
          {key2('A', '(1 + l_suppkey % 3 + (l_suppkey // 3) % 5 * 5)')}, {key2('CC', 'l_suppkey % 25')},
          CAST(0 AS DECIMAL(18,2)),
          CAST(CAST(l_extendedprice AS DECIMAL(18,2)) - 0.01 * CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE 0 END AS DECIMAL(18,2)),
          -CAST(CAST(l_extendedprice AS DECIMAL(18,2)) - 0.01 * CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE 0 END AS DECIMAL(18,2)),
          l_returnflag
        FROM lineitem""",
    "g_accounts": f"""
        SELECT {key2('A', 'n_nationkey')} AS account_id, 'Account ' || n_name AS account_name,
          CASE n_nationkey % 5 WHEN 0 THEN 'Asset' WHEN 1 THEN 'Liability' WHEN 2 THEN 'Equity' WHEN 3 THEN 'Revenue' ELSE 'Expense' END AS account_type,
          CASE WHEN n_nationkey % 5 < 3 THEN 'Balance Sheet' ELSE 'Income Statement' END AS financial_statement,
          CASE WHEN n_nationkey % 5 = 0 THEN CASE WHEN n_nationkey < 15 THEN 'Current Assets' ELSE 'Fixed Assets' END
               WHEN n_nationkey % 5 = 1 THEN CASE WHEN n_nationkey < 15 THEN 'Current Liabilities' ELSE 'Long-term Liabilities' END
               WHEN n_nationkey % 5 = 2 THEN 'Shareholders Equity'
               WHEN n_nationkey % 5 = 3 THEN CASE WHEN n_nationkey < 15 THEN 'Operating Revenue' ELSE 'Non-operating Revenue' END
               WHEN n_nationkey < 5 THEN 'Cost of Revenue'
               WHEN n_nationkey < 15 THEN 'Operating Expenses' ELSE 'Non-operating Expenses' END AS account_subgroup,
          CASE WHEN n_nationkey = 24 THEN 0 ELSE 1 END AS is_active
        FROM nation""",
    "g_centers": f"""
        SELECT {key2('CC', 'n_nationkey')} AS cost_center_id, 'Center ' || n_name AS cost_center_name,
          r_name AS department_group, 'Manager ' || n_nationkey AS manager_name, 1 AS is_active
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "g_bounds": "SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders",
    "g_months": """
        SELECT CAST(unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH)) AS DATE) AS m, hi
        FROM g_bounds""",
    "g_periods": """
        SELECT 'FY' || year(m) || '-' || lpad(CAST(month(m) AS VARCHAR), 2, '0') AS fiscal_period_id,
          CAST(year(m) AS INTEGER) AS fiscal_year, CAST(month(m) AS INTEGER) AS fiscal_month,
          'Q' || quarter(m) AS fiscal_quarter, m AS period_start_date, last_day(m) AS period_end_date,
          CASE WHEN year(m) < year(hi) THEN 1 ELSE 0 END AS is_closed
        FROM g_months""",
    "g_budgets": f"""
        SELECT strftime(CAST(DATE '1995-01-01' + INTERVAL 1 MONTH * CAST(s_suppkey % 96 AS INTEGER) AS DATE), 'FY%Y-%m') AS fiscal_period_id,
          {key2('A', '(CASE WHEN s_suppkey % 2 = 0 THEN 3 ELSE 4 END + (s_suppkey // 2) % 5 * 5)')} AS account_id,
          {key2('CC', 's_suppkey % 25')} AS cost_center_id,
          CAST(sum(greatest(CAST(s_acctbal AS DECIMAL(18,2)), 0)) AS DECIMAL(18,2)) AS budget_amount, 'Original' AS budget_type
        FROM supplier GROUP BY 1, 2, 3""",
    "gl": """
        SELECT l.journal_entry_id, l.line_number, e.posting_date, e.description AS je_description, l.line_description,
          e.source_system, e.created_by, e.status AS je_status, l.debit_amount, l.credit_amount, l.net_amount,
          l.account_id, a.account_name, a.account_type, a.financial_statement, a.account_subgroup,
          l.cost_center_id, c.cost_center_name, c.department_group,
          p.fiscal_period_id, p.fiscal_year, p.fiscal_month, p.fiscal_quarter, p.is_closed AS period_is_closed
        FROM g_lines l JOIN g_entries e ON l.journal_entry_id = e.journal_entry_id
        JOIN g_accounts a ON l.account_id = a.account_id
        JOIN g_centers c ON l.cost_center_id = c.cost_center_id
        JOIN g_periods p ON e.posting_date BETWEEN p.period_start_date AND p.period_end_date""",
    "g_activity": """
        SELECT fiscal_period_id, fiscal_year, fiscal_month, fiscal_quarter, account_id, account_name, account_type,
          financial_statement, account_subgroup, sum(debit_amount) AS total_debits,
          sum(credit_amount) AS total_credits, sum(net_amount) AS net_activity
        FROM gl WHERE je_status = 'Posted' GROUP BY ALL""",
    "g_balances": """
        SELECT *, CASE WHEN financial_statement = 'Balance Sheet'
            THEN sum(net_activity) OVER (PARTITION BY account_id ORDER BY fiscal_year, fiscal_month
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            ELSE net_activity END AS ending_balance
        FROM g_activity""",
    "g_trial": """
        SELECT *, CASE WHEN account_type IN ('Revenue', 'Liability', 'Equity') THEN -ending_balance ELSE ending_balance END AS reported_balance
        FROM g_balances""",
    "g_monthly": """
        SELECT fiscal_period_id, fiscal_year, fiscal_month, fiscal_quarter, account_subgroup,
          sum(CASE WHEN account_type = 'Revenue' THEN credit_amount - debit_amount ELSE 0 END) AS revenue_amount,
          sum(CASE WHEN account_type = 'Expense' THEN debit_amount - credit_amount ELSE 0 END) AS expense_amount
        FROM gl WHERE je_status = 'Posted' GROUP BY ALL""",
    "g_pivot": """
        SELECT fiscal_period_id, fiscal_year, fiscal_month, fiscal_quarter,
          coalesce(sum(revenue_amount) FILTER (account_subgroup = 'Operating Revenue'), 0) AS operating_revenue,
          coalesce(sum(revenue_amount) FILTER (account_subgroup = 'Non-operating Revenue'), 0) AS other_revenue,
          coalesce(sum(expense_amount) FILTER (account_subgroup = 'Cost of Revenue'), 0) AS cost_of_revenue,
          coalesce(sum(expense_amount) FILTER (account_subgroup = 'Operating Expenses'), 0) AS operating_expenses,
          coalesce(sum(expense_amount) FILTER (account_subgroup = 'Non-operating Expenses'), 0) AS non_operating_expenses
        FROM g_monthly GROUP BY ALL""",
    "g_statement": """
        SELECT *, operating_revenue + other_revenue AS total_revenue, operating_revenue - cost_of_revenue AS gross_profit,
          operating_revenue - cost_of_revenue - operating_expenses AS operating_income,
          operating_revenue + other_revenue - cost_of_revenue - operating_expenses - non_operating_expenses AS net_income,
          CASE WHEN operating_revenue > 0 THEN CAST(operating_revenue - cost_of_revenue AS DOUBLE) / CAST(operating_revenue AS DOUBLE) ELSE 0 END AS gross_margin_pct,
          CASE WHEN operating_revenue > 0 THEN CAST(operating_revenue - cost_of_revenue - operating_expenses AS DOUBLE) / CAST(operating_revenue AS DOUBLE) ELSE 0 END AS operating_margin_pct
        FROM g_pivot""",
    "g_actuals": """
        SELECT fiscal_period_id, account_id, cost_center_id, sum(debit_amount) AS actual_debits,
          sum(credit_amount) AS actual_credits, sum(net_amount) AS actual_net
        FROM gl WHERE je_status = 'Posted' GROUP BY ALL""",
    "g_variance": """
        SELECT *, actual_amount - budget_amount AS variance_amount,
          CASE WHEN budget_amount <> 0 THEN CAST(actual_amount - budget_amount AS DOUBLE) / CAST(budget_amount AS DOUBLE) END AS variance_pct,
          CASE WHEN account_type = 'Revenue' THEN CASE WHEN actual_amount >= budget_amount THEN 'Favorable' ELSE 'Unfavorable' END
               WHEN account_type = 'Expense' THEN CASE WHEN actual_amount <= budget_amount THEN 'Favorable' ELSE 'Unfavorable' END
               ELSE 'N/A' END AS variance_status
        FROM (
          SELECT coalesce(b.fiscal_period_id, x.fiscal_period_id) AS fiscal_period_id,
            coalesce(b.account_id, x.account_id) AS account_id, coalesce(b.cost_center_id, x.cost_center_id) AS cost_center_id,
            coalesce(b.budget_amount, 0) AS budget_amount,
            coalesce(CASE WHEN a.account_type = 'Revenue' THEN x.actual_credits - x.actual_debits ELSE x.actual_debits - x.actual_credits END, 0) AS actual_amount,
            a.account_name, a.account_type, a.account_subgroup, c.cost_center_name, c.department_group,
            p.fiscal_year, p.fiscal_month, p.fiscal_quarter
          FROM g_budgets b FULL OUTER JOIN g_actuals x
            ON b.fiscal_period_id = x.fiscal_period_id AND b.account_id = x.account_id AND b.cost_center_id = x.cost_center_id
          LEFT JOIN g_accounts a ON coalesce(b.account_id, x.account_id) = a.account_id
          LEFT JOIN g_centers c ON coalesce(b.cost_center_id, x.cost_center_id) = c.cost_center_id
          LEFT JOIN g_periods p ON coalesce(b.fiscal_period_id, x.fiscal_period_id) = p.fiscal_period_id)""",
    "x_crm": """
        SELECT c_custkey AS customer_id, 'Crm' AS first_name, c_name AS last_name, 'Company ' || c_nationkey AS company_name,
          c_mktsegment AS industry, 'R' || (c_nationkey % 5) AS region, CAST(c_acctbal AS DECIMAL(12,2)) AS lifetime_value
        FROM customer""",
    "x_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(12,2)) AS order_total,
          CAST(o_orderdate AS DATE) AS order_date,
          CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Open' ELSE 'Pending' END AS order_status
        FROM orders""",
    "x_revenue": f"""
        SELECT d.department_name, d.division, s.active_headcount, count(DISTINCT f.order_id) AS total_orders,
          sum(f.net_sales) AS total_revenue,
          CASE WHEN s.active_headcount <> 0 THEN {rounded('CAST(sum(f.net_sales) AS DOUBLE) / s.active_headcount', 2)} END AS revenue_per_employee
        FROM r_fact f CROSS JOIN h_summary s JOIN h_departments d ON s.department_id = d.department_id
        WHERE d.division = 'ASIA' GROUP BY d.department_name, d.division, s.active_headcount""",
    "x_efficiency": """
        SELECT d.division, CAST(sum(s.active_headcount) AS HUGEINT) AS total_headcount,
          sum(s.avg_salary * s.active_headcount) AS total_compensation,
          count(DISTINCT o.order_id) AS mirrored_order_count, sum(o.order_total) AS mirrored_revenue
        FROM h_departments d JOIN h_summary s ON d.department_id = s.department_id CROSS JOIN x_orders o
        GROUP BY d.division""",
    "x_360": f"""
        SELECT c.customer_id AS crm_customer_id, c.first_name, c.last_name, c.company_name, c.industry, c.region,
          c.lifetime_value AS crm_lifetime_value, o.total_orders, o.total_spend, o.avg_order_value, o.last_order_date
        FROM x_crm c LEFT JOIN (
          SELECT customer_id, count(DISTINCT order_id) AS total_orders, sum(order_total) AS total_spend,
            {rounded('avg(order_total)', 2)} AS avg_order_value, max(order_date) AS last_order_date
          FROM x_orders WHERE order_status = 'Completed' GROUP BY customer_id) o ON c.customer_id = o.customer_id""",
}


def _used(text: str) -> list[str]:
    return [name for name in CTES if re.search(rf"\b{name}\b", text)]


def over(
    body: str, text: Sequence[str] = (), real: Sequence[str] = (), ratios: Sequence[str] = (), digits: int = 6
) -> str:
    """``body`` with the CTEs it needs, dates as text, decimals as doubles, ratios rounded."""
    needed, fresh = set(), set(_used(body))
    while fresh:
        needed |= fresh
        fresh = {d for n in fresh for d in _used(CTES[n])} - needed
    ctes = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in CTES if name in needed)
    swaps = [f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in text]
    swaps += [f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in real]
    swaps += [f'{rounded(chr(34) + c + chr(34), digits)} AS "{c}"' for c in ratios]
    shown = f"* REPLACE ({', '.join(swaps)})" if swaps else "*"
    prefix = f"WITH {ctes}\n" if ctes else ""
    return f"{prefix}SELECT {shown} FROM (\n{body.strip()}\n) AS result"

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import compare, database

import __spark_entry__ as entry_points
from orewright.plans.catalog import QUERIES

# Number of inventory lines per section letter.
INVENTORY = {"S": 15, "P": 25, "J": 18, "A": 26, "W": 6, "O": 4, "U": 1, "F": 25, "T": 8, "D": 8, "M": 38, "V": 12}


def test_every_inventory_line_has_a_query():
    covered = {i for q in QUERIES.values() for i in q.ids}
    wanted = {f"{letter}-{n:02d}" for letter, last in INVENTORY.items() for n in range(1, last + 1)}
    assert wanted - covered == set()
    assert covered - wanted == set()


def test_every_query_has_its_check():
    assert [name for name, q in QUERIES.items() if q.sql is None] == []
    assert set(QUERIES) <= set(entry_points.queries()) and set(QUERIES) <= set(entry_points.oracle_sql())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_other_queries_do_without_a_package_that_is_not_there(monkeypatch):
    import builtins

    real = builtins.__import__

    def missing(name, *args, **named):
        if name == "public_tokenizers":
            raise ImportError(name)
        return real(name, *args, **named)

    for module in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("orewright.llm")]:
        monkeypatch.delitem(sys.modules, module)
    monkeypatch.setattr(builtins, "__import__", missing)
    assert set(entry_points.queries()) == set(QUERIES) == set(entry_points.oracle_sql())


def test_no_query_is_cut_to_make_its_check_cheap():
    for name, sql in entry_points.oracle_sql().items():
        if name not in ("critical_alerts", "head_report"):
            assert not re.search(r"\bLIMIT\b|\bSAMPLE\b", sql), name


def test_entry_has_rows_and_a_stable_schema(spark, sample):
    df = entry_points.entry(spark)
    assert df.count() > 0
    assert df.columns == ["order_date", "channel", "orders", "gross_sales", "net_sales", "tax_amount",
                          "cancelled_refunded_net_sales", "recognized_net_sales"]


@pytest.fixture(scope="module")
def con(sample):
    return database(sample)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_check(spark, sample, con, name):
    ok, note = compare(spark, con, sample, name)
    assert ok, note


def test_plans_stay_in_the_jvm_and_pair_no_rows(spark, sample):
    for name, q in QUERIES.items():
        if name.startswith("stream_"):
            continue
        plan = q.run(spark, sample)._jdf.queryExecution().executedPlan().toString()
        for part in ("CartesianProduct", "NestedLoop", "Python", "ArrowEval"):
            assert part not in plan, (name, part)

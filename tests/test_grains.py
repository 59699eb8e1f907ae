import random

from conftest import values
from pyspark.sql import functions as F

from orewright.operators import grains, shaping


def test_rank_over_all_rows_matches_brute_force(frame):
    rng = random.Random(3)
    scores = [rng.choice([1.0, 2.5, 3.0, 3.004, 4.999, 5.0, 0.0]) for _ in range(60)] + [None, None]
    df = frame(list(enumerate(scores)), "i int, s double")
    got = {r.i: r.rk for r in grains.distributed_rank(df, "s", 0, 5, 100, "rk").collect()}
    known = [s for s in scores if s is not None]
    for i, s in enumerate(scores):
        assert got[i] == 1 + (len(known) if s is None else sum(k > s for k in known))


def test_at_grain_keeps_rows_with_a_null_key(frame):
    df = frame([("a", 1), ("a", 2), (None, 5)], "k string, v int")
    assert values(grains.at_grain(df, ["k"], {"m": F.sum("v")})) == [("a", 1, 3), ("a", 2, 3), (None, 5, 5)]


def test_at_grain_gathers_no_rows_of_a_key(frame):
    plan = grains.at_grain(frame([("a", 1)], "k string, v int"), ["k"], {"m": F.avg("v")})
    assert "Window" not in plan._jdf.queryExecution().executedPlan().toString()


def test_share_of_total(frame):
    df = frame([("a", "x", 1), ("b", "x", 3), ("a", "y", 2), ("b", None, 0)], "d string, o string, m int")
    got = values(grains.pct_of_total(df, "m", "d", ["o"]), "d", "o", "pct_of_total")
    assert got == [("a", "x", 0.25), ("a", "y", 1.0), ("b", "x", 0.75), ("b", None, None)]
    assert values(grains.pct_of_total(df.filter("o = 'x'"), "m", "d"), "d", "pct_of_total") == [("a", 0.25), ("b", 0.75)]


def test_related_leaves_null_for_unknown_keys(frame):
    fact, dim = frame([(1,), (2,)], "k int"), frame([(1, "a")], "k int, n string")
    assert values(grains.related(fact, dim, "k", ["n"])) == [(1, "a"), (2, None)]


def test_orphans_ignore_null_keys(frame):
    child, parent = frame([(1,), (2,), (None,)], "k int"), frame([(1,), (None,)], "p int")
    assert values(grains.fk_orphans(child, parent, "k", "p")) == [(2,)]


def test_shaping(frame):
    df = frame([(1, "a"), (2, None), (None, "b")], "n int, s string")
    assert values(shaping.exclude_values(df, "n", [1])) == [(2, None), (None, "b")]
    assert values(shaping.slice_rows(df, not_null=["s"], below={"n": 5}, one_of={"s": ["a"]})) == [(1, "a")]
    assert shaping.slice_rows(df).count() == 3
    assert shaping.reshape(df, ["s", "n"], drop=["n"], rename={"s": "t"}).columns == ["t"]
    assert values(shaping.top(df, 1, F.desc_nulls_last("n"))) == [(2, None)]
    assert shaping.head(df, 2).count() == 2
    assert shaping.project_as(df, {"n": "N (x)"}).columns == ["N (x)"]


def test_ranks_hold_beyond_the_expected_range(frame):
    df = frame([(1, 2.0), (2, 1.0), (3, None), (4, -0.2), (5, -7.0), (6, 9.0), (7, 8.0), (8, None)], "i int, s double")
    got = {r.i: r.rk for r in grains.distributed_rank(df, "s", 0.0, 5.0, 100, "rk").collect()}
    assert got == {6: 1, 7: 2, 1: 3, 2: 4, 4: 5, 5: 6, 3: 7, 8: 7}


def test_a_period_that_ends_before_it_starts_holds_no_day(frame):
    from datetime import date

    dates = frame([(date(2024, 1, d),) for d in (1, 2, 3)], "d date")
    spans = frame([("back", date(2024, 1, 3), date(2024, 1, 1)), ("day", date(2024, 1, 2), date(2024, 1, 2))],
                  "p string, period_start_date date, period_end_date date")
    assert [r.p for r in grains.assign_period(dates, spans, "d").collect()] == ["day"]


def test_white_space_of_any_kind_is_trimmed_before_controls_go(frame):
    from pyspark.sql import functions as F

    from orewright.functions.text import without_controls

    df = frame([("abc \t",), ("\t abc",), ("\u00a0abc\u2003\n",), ("a\tb c",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(without_controls(F.col("t"))).collect()] == ["abc", "abc", "abc", "ab c", None, ""]


def test_a_flag_may_be_sent_as_text(frame):
    from orewright.sources.events import parse_events

    df = frame([('{"device_id": "d", "is_anomaly": "true"}',), ('{"device_id": "d", "is_anomaly": false}',),
                ('{"device_id": "d", "is_anomaly": "maybe"}',)], "body string")
    assert [r.is_anomaly for r in parse_events(df).collect()] == [True, False, None]

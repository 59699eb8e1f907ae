import random
from datetime import datetime, timedelta

from conftest import values

from pyspark.sql import functions as F

from orewright.operators import quality


def test_simple_checks(frame):
    df = frame([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, None)], "k int, v string")
    assert quality.not_null(df, "k").count() == 2
    assert values(quality.duplicates(df, ["k"])) == [(1, 2)]
    assert values(quality.accepted_values(df, "v", ["a", "b", "c"])) == [("d", 1)]
    parent = frame([(1,)], "k int")
    assert values(quality.relationships(df, "k", parent, "k")) == [(2, None)]


def test_counts_of_a_table_agree_with_the_single_checks(frame):
    df = frame([(1, "a"), (None, "b"), (3, None), (3, "zz")], "k int, v string")
    parents = frame([(1, "a"), (1, "b")], "k int, v string")
    nulls = quality.null_counts(df, {"k": "k", "v": "v"})
    assert values(nulls) == [("k", 1), ("v", 1)]
    orphans = quality.orphan_counts(df, {"k": ("k", parents), "v": ("v", parents)})
    assert values(orphans) == [("k", 2), ("v", 1)]
    assert values(quality.check_summary({"empty": df.filter("k > 9")})) == [("empty", 0)]


def brute(rows, minutes):
    reach = timedelta(minutes=minutes)
    return sorted(a[0] for a in rows for b in rows
                  if a[0] != b[0] and a[1] == b[1] and a[2] == b[2] and abs(a[3] - b[3]) <= reach)


def test_suspected_duplicates_match_brute_force(frame):
    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    rows = [(f"e{i}", rng.choice([10.0, 20.0]), rng.choice(["x", "y"]), start + timedelta(seconds=rng.randrange(200_000)))
            for i in range(160)]
    # A hot amount and text: a third of all rows, in one burst; and a pair exactly at the limit.
    rows += [(f"h{i}", 5.0, "hot", start + timedelta(seconds=i)) for i in range(80)]
    rows += [("p", 1.0, "z", start), ("q", 1.0, "z", start + timedelta(minutes=10)),
             ("s", 2.0, "z", start), ("t", 2.0, "z", start + timedelta(minutes=10, seconds=1))]
    df = frame(rows, "journal_entry_id string, amount double, description string, created_at timestamp")
    got = [r.journal_entry_id for r in quality.suspected_duplicates(df, minutes=10).collect()]
    assert sorted(got) == sorted(set(brute(rows, 10)))
    assert {"p", "q"} <= set(got) and not {"s", "t"} & set(got)


def test_rows_without_amount_text_or_clock_are_not_suspected(frame):
    at = datetime(2024, 1, 1)
    df = frame([("a", None, "x", at), ("b", None, "x", at), ("c", 1.0, "x", None), ("d", 1.0, "x", None)],
               "journal_entry_id string, amount double, description string, created_at timestamp")
    assert quality.suspected_duplicates(df).count() == 0


def test_32_checks_are_declared():
    n = sum(len(c) for t in quality.REQUIRED.values() for c in t.values())
    n += sum(len(c) for t in quality.DISTINCT.values() for c in t.values())
    n += sum(len(c) for t in quality.LINKS.values() for c in t.values())
    assert n + 1 == 32


def test_a_key_is_checked_in_one_pass(frame):
    df = frame([(1, "a"), (1, None), (2, "b"), (None, None), (None, "c"), (3, "d"), (3, "d")], "k int, v string")
    got = quality.key_counts(df, "k", {"unique": "u", "not_null": "n"}, {"v": F.col("v").isNull()})
    assert values(got) == [("n", 2), ("u", 2), ("v", 2)]
    assert values(quality.key_counts(df.limit(0), "k", {"unique": "u"}, {"v": F.col("v").isNull()})) == [("u", 0), ("v", 0)]
    parents = frame([(1,), (9,)], "k int")
    assert values(quality.orphan_counts(df, {"o": ("k", parents)}, {"v": F.col("v").isNull()})) == [("o", 3), ("v", 2)]

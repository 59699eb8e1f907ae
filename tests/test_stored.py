"""Tables in stored forms: what a reader opens, and that it finds the same rows as without them."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import values
from pyspark.sql import Window
from pyspark.sql import functions as F

from orewright.operators import distinct, grains, quantiles, rollups
from orewright.operators.balances import Balances
from orewright.plans import stored
from orewright.plans.catalog import QUERIES
from orewright.sources import files, folders, tables
from orewright.sources.adapters import Given
from orewright.sources.timed import open_timed, write_timed
from orewright.streaming import sinks
from orewright.streaming.levels import Levels

T0 = datetime(2024, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_read(df):
    """How many files the scans of a query opened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves, found, todo = [], 0, [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        elif name == "FileSourceScanExec":
            leaves.append(node)
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    for leaf in leaves:
        found += leaf.metrics().apply("numFiles").value()
    return found


# --- rows by day ---------------------------------------------------------------------------------------------

EVENTS = "id int, at timestamp, lag int"


def arrived():
    return F.col("at") + F.make_dt_interval(secs=F.col("lag").cast("decimal(18,6)"))


@pytest.fixture
def timed(spark, tmp_path):
    rows = [(i, T0 + timedelta(hours=i), i % 7) for i in range(240)]
    for number, part in enumerate((rows[:150], rows[150:])):
        write_timed(spark.createDataFrame(part, EVENTS), str(tmp_path / "t"), "at", {"arrived": arrived()}, str(number))
    schema = spark.createDataFrame([], EVENTS).schema
    return open_timed(spark, str(tmp_path / "t"), schema, "at"), rows


def test_reads_of_the_last_hours_open_their_days(spark, timed):
    table, rows = timed
    last = rows[-1][1] + timedelta(seconds=rows[-1][2])
    assert spark.range(1).select(table.as_of("arrived")).first()[0] == last
    for clock, hours in (("at", 1), ("arrived", 1), ("at", 30), ("arrived", 100)):
        read = table.since(clock, f"{hours} hours", table.as_of("arrived"))
        exact = read.withColumn("arrived", arrived()).filter(F.col(clock) > F.lit(last - timedelta(hours=hours)))
        when = {"at": lambda r: r[1], "arrived": lambda r: r[1] + timedelta(seconds=r[2])}[clock]
        want = [r[0] for r in rows if when(r) > last - timedelta(hours=hours)]
        assert sorted(r.id for r in exact.collect()) == want
        first = last - timedelta(hours=hours, seconds=6 if clock == "arrived" else 0)
        days = {r[1].date() for r in rows if r[1].date() >= first.date()}
        stored_files = {f for f in table.rows().inputFiles() if any(f"_day={d}" in f for d in days)}
        assert files_read(read) == len(stored_files) < len(table.rows().inputFiles())


def test_broken_writes_are_not_seen_and_repeated_ones_count_once(spark, timed, tmp_path):
    table, rows = timed
    again = spark.createDataFrame(rows[150:], EVENTS)
    write_timed(again, table.path, "at", {"arrived": arrived()}, "1")
    spark.createDataFrame([(999, T0, 0)], EVENTS).withColumn("_day", F.to_date("at")).write.partitionBy("_day").parquet(f"{table.path}/rows/write=2")
    reopened = open_timed(spark, table.path, table.schema, "at")
    assert sorted(r.id for r in reopened.rows().collect()) == list(range(240))
    assert open_timed(spark, str(tmp_path / "none"), table.schema, "at").since("at", "1 hour").count() == 0
    write_timed(spark.createDataFrame([], EVENTS), str(tmp_path / "empty"), "at", {"arrived": arrived()})
    empty = open_timed(spark, str(tmp_path / "empty"), table.schema, "at")
    assert empty.since("arrived", "1 hour").count() == 0 and empty.expire("at", "1 day") == 0


def test_expired_days_go_and_rows_without_the_clock_stay(spark, tmp_path):
    path = str(tmp_path / "e")
    rows = [(i, T0 + timedelta(days=i), 5) for i in range(10)] + [(99, None, 1)]
    write_timed(spark.createDataFrame(rows, EVENTS), path, "at", {"seen": F.coalesce(arrived(), F.lit(T0 + timedelta(days=8)))})
    table = open_timed(spark, path, spark.createDataFrame([], EVENTS).schema, "at")
    assert sorted(r.id for r in table.since("seen", "2 days").collect()) == [7, 8, 9, 99]
    assert table.expire("seen", "2 days") == 7
    assert sorted(r.id for r in table.rows().collect()) == [7, 8, 9, 99] and table.expire("seen", "2 days") == 0


REPORTS = ["since", "between_range", "sensor_averages", "zone_bins", "vibration_card", "anomalies_by_zone", "report_device_temperature", "retain"]


@pytest.mark.parametrize("name", REPORTS)
def test_recent_reports_prune_days_and_push_the_clock(spark, sample, name):
    held = spark.conf.get("spark.sql.maxMetadataStringLength")
    try:
        spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
        plan = plan_of(QUERIES[name].run(spark, sample))
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", held)
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 1
    assert "PartitionFilters: [isnotnull(_day" in scans[0] and "_day#" in scans[0]
    assert "GreaterThanOrEqual(ts," in scans[0]


# --- buckets -------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["fact_sales_bucketed", "gl_totals_bucketed", "fact_gl_activity_bucketed"])
def test_no_exchange_under_the_large_join(spark, sample, name):
    plan = plan_of(QUERIES[name].run(spark, sample)).split("Initial Plan")[-1]
    lines = plan.splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    depth = lines[join].index("SortMergeJoin")
    below = []
    for line in lines[join + 1 :]:
        if len(line) - len(line.lstrip(" :+-")) <= depth and "SortMergeJoin" not in line and line.strip(" :+-") and line.index(line.strip(" :+-")[0]) <= depth:
            break
        below.append(line)
    assert "Exchange hashpartitioning" not in "\n".join(below)
    assert plan.count("SelectedBucketsCount: 8 out of 8") == 2
    if name == "fact_sales_bucketed":
        assert "Exchange" not in plan
    assert plan.count("BroadcastHashJoin") <= 5


def test_exchanges_start_with_partitions_by_size(spark, sample, monkeypatch):
    monkeypatch.setattr("orewright.session.PARTITION_BYTES", 16 << 10)
    size = folders.signature(spark, sample)[0]
    plan = plan_of(QUERIES["report_gl_drill_through"].run(spark, sample))
    assert f", {size >> 14}), ENSURE_REQUIREMENTS" in plan and size >> 14 > int(spark.conf.get("spark.sql.shuffle.partitions"))
    # One sum, in two steps; the dates' join has none.
    assert plan.count("sum(debit_amount") == 2
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16MB"
    monkeypatch.undo()
    QUERIES["report_gl_drill_through"].run(spark, sample)
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None


def test_buckets_grow_in_number_not_in_size(spark, sample, monkeypatch):
    assert [stored.bucket_count(n << 20) for n in (0, 128, 129, 1024, 6144)] == [8, 8, 16, 64, 512]
    names = ["fact_sales_bucketed", "gl_totals_bucketed", "fact_gl_activity_bucketed"]
    before = {n: values(QUERIES[n].run(spark, sample)) for n in names}
    monkeypatch.setattr(stored, "BUCKET_BYTES", 8 << 10)
    for name in names:
        df = QUERIES[name].run(spark, sample)
        plan = plan_of(df)
        assert plan.count("SelectedBucketsCount: 32 out of 32") == 2
        assert values(df) == before[name]


# --- distinct counts -----------------------------------------------------------------------------------------


def test_sets_merge_to_any_grain(spark, monkeypatch):
    draw = random.Random(6)
    rows = [(draw.choice("ab"), draw.choice([1, 2, None]), draw.choice([draw.randint(-70_000, 70_000), draw.randint(1, 900)])) for _ in range(5000)]
    rows += [("hot", 1, k) for k in range(40_000)] + [("hot", 2, 5)] * 50 + [("a", 1, None)]
    df = spark.createDataFrame(rows, "x string, y int, id long")
    sets = distinct.id_sets(df, "id", ["x", "y"])
    held = sets.agg(F.count("places"), F.count("bits")).first()
    assert held[0] and held[1]
    for by in ([], ["x"], ["y"], ["x", "y"]):
        got = distinct.set_sizes(sets, by, "n")
        assert values(got) == values(df.groupBy(*by).agg(F.countDistinct("id").alias("n")).filter("n > 0"))
    child = spark.createDataFrame([(1, 5), (2, None), (3, -70_001), (4, 39_999), (5, 1 << 40), (6, 0)], "k int, id long")
    known = distinct.merged_sets(sets, [])
    want = {r.id for r in df.select("id").distinct().collect()}
    assert values(distinct.not_in_set(child, "id", known), "k") == [(k,) for k, i in ((3, -70_001), (4, 39_999), (5, 1 << 40), (6, 0)) if i not in want]


def test_lists_travel_once_and_spelled_out_ids_never(spark, sample):
    sets = spark.createDataFrame([("a", 0, [1, 2], None), ("b", 0, [2, 3], None)], "x string, block long, places array<smallint>, bits binary")
    merged = distinct.merged_sets(sets, ["x"])
    assert [line for line in plan_of(merged).splitlines() if "Exchange" in line and "place#" in line.split("ENSURE")[0]] == []
    assert values(distinct.set_sizes(sets, [], "n")) == [(3,)]
    df = QUERIES["distinct_by_grain"].run(spark, sample)
    assert any("/customer-sets-by-month-" in f for f in df.inputFiles())


# --- folders of batches --------------------------------------------------------------------------------------

ROWS = "k string, at timestamp, n long"


def add_up(rows):
    return rows.groupBy("k", "at").agg(F.sum("n").alias("n"))


def test_readers_open_few_folders_after_many_batches(spark, tmp_path):
    levels = Levels(spark, str(tmp_path / "l"), spark.createDataFrame([], ROWS).schema, add_up, "at", "20 minutes")
    whole = []
    for b in range(50):
        rows = [(f"k{b % 3}", T0 + timedelta(minutes=b), 1), ("late", T0 + timedelta(minutes=max(0, b - 9)), b), ("none", None, 1)]
        whole += rows
        levels.append(spark.createDataFrame(rows, ROWS), b)
        if b in (7, 20, 31):  # the batch runs again
            levels.append(spark.createDataFrame(rows, ROWS), b)
    assert len(levels.spans()) <= 2 + 6
    assert [(s.first, s.last) for s in levels.spans()] == [(0, 31), (32, 47), (48, 49)]
    young = spark.createDataFrame(whole, ROWS).filter(F.col("at").isNull() | (F.col("at") > F.lit(T0 + timedelta(minutes=29))))
    assert values(levels.merged(), "k", "at", "n") == values(add_up(young), "k", "at", "n")
    assert len(folders.names(spark, levels.path)) <= 8


def test_a_folder_with_nothing_young_goes(spark, tmp_path):
    levels = Levels(spark, str(tmp_path / "l"), spark.createDataFrame([], ROWS).schema, add_up, "at", "1 hour")
    for b in range(6):
        levels.append(spark.createDataFrame([("k", T0 + timedelta(hours=3 * b), 1)], ROWS), b)
    assert [(s.first, s.last) for s in levels.spans()] == [(4, 5)]
    assert values(levels.merged()) == [("k", T0 + timedelta(hours=15), 1)]
    assert not any(n.startswith("span-0") for n in folders.names(spark, levels.path))


def test_a_merge_that_broke_off_is_done_again(spark, tmp_path):
    levels = Levels(spark, str(tmp_path / "l"), spark.createDataFrame([], ROWS).schema, add_up)
    for b in range(3):
        levels.append(spark.createDataFrame([("k", T0, 1)], ROWS), b)
    torn = str(tmp_path / "l" / "span-0-3")
    spark.createDataFrame([("torn", T0, 1)], ROWS).write.parquet(torn)
    folders.remove(spark, f"{torn}/_SUCCESS")
    assert values(levels.merged()) == [("k", T0, 3)]
    levels.append(spark.createDataFrame([("k", T0, 1)], ROWS), 3)
    assert values(levels.merged()) == [("k", T0, 4)] and len(levels.spans()) == 1


def test_folding_rewrites_only_changed_folders(spark, tmp_path):
    path, feed = str(tmp_path / "m"), "k long, v string, seq long, _op string"
    schema = spark.createDataFrame([], feed).schema
    sinks.start_mirror(spark.range(20_000).select(F.col("id").alias("k"), F.lit("old").alias("v")), path, ["k"])
    base = {n: folders.names(spark, f"{path}/base/{n}") for n in folders.names(spark, f"{path}/base")}
    assert len([b for b in base["fold-0-0-64"] if b.startswith("_bucket=")]) == 64
    log = sinks._log(spark, path, schema, ["k"], ["seq"])
    changes = [(7 * i, "new", i, "upsert" if i % 4 else "delete") for i in range(20)]
    log.append(spark.createDataFrame(changes, feed).withColumn("_batch", F.lit(0).cast("long")), 0)
    target = "k long, v string"
    table = spark.createDataFrame([], target).schema
    read = sinks.read_mirror(spark, path, table, schema, ["k"], ["seq"])
    want = sorted([(k, "new") for k, _, _, o in changes if o == "upsert"] + [(k, "old") for k in range(20_000) if k not in {c[0] for c in changes}])
    assert values(read) == sorted(want, key=repr)
    written = sinks.fold_mirror(spark, path, schema, ["k"], ["seq"])
    assert 1 <= written <= 20
    assert len([b for b in folders.names(spark, f"{path}/base/fold-1-1-64") if b.startswith("_bucket=")]) == written
    assert values(sinks.read_mirror(spark, path, table, schema, ["k"], ["seq"])) == sorted(want, key=repr)
    # Untouched folders are not shuffled, and a fold that broke off is not seen.
    late = spark.createDataFrame([(7, "newer", 99, "upsert"), (14, "stale", 0, "upsert")], feed)
    log.append(late.withColumn("_batch", F.lit(1).cast("long")), 1)
    torn = f"{path}/base/fold-2-2-64"
    spark.createDataFrame([(1, "torn", 1, "upsert", 5)], feed + ", _bucket int").write.partitionBy("_bucket").parquet(torn)
    folders.remove(spark, f"{torn}/_SUCCESS")
    held = dict(values(sinks.read_mirror(spark, path, table, schema, ["k"], ["seq"])))
    assert held[7] == "newer" and held[14] == "new" and len(held) == len(want)
    assert sinks.fold_mirror(spark, path, schema, ["k"], ["seq"]) <= 2
    assert dict(values(sinks.read_mirror(spark, path, table, schema, ["k"], ["seq"]))) == held


# --- rebuilds, files, spans ----------------------------------------------------------------------------------


@pytest.mark.parametrize("step", ["_write_version", "_point", "_drop_versions"])
def test_a_rebuild_that_stops_is_done_again_and_the_name_never_goes(spark, monkeypatch, step):
    name = f"rebuilt_{step.strip('_')}"
    tables.replace_table(spark, name, spark.range(3))
    real = getattr(tables, step)
    for after in (False, True):

        def stop(*args, **named):
            if after:
                real(*args, **named)
            raise RuntimeError("stopped")

        monkeypatch.setattr(tables, step, stop)
        with pytest.raises(RuntimeError):
            tables.replace_table(spark, name, spark.table(name).union(spark.range(100, 101)))
        monkeypatch.setattr(tables, step, real)
        assert spark.table(name).count() in (3, 4, 5)
    before = spark.table(name).count()
    held = tables.replace_table(spark, name, spark.table(name).union(spark.range(200, 201)))
    assert held.count() == before + 1
    assert len(tables._versions(spark, name)) <= 2
    spark.sql(f"DROP VIEW {name}")


def test_a_plain_table_becomes_a_version(spark):
    spark.range(2).write.mode("overwrite").saveAsTable("plain_before")
    assert tables.replace_table(spark, "plain_before", spark.table("plain_before").selectExpr("id", "id * 2 AS twice")).columns == ["id", "twice"]
    assert spark.table("plain_before").count() == 2
    spark.sql("DROP VIEW plain_before")


def test_every_line_lands_or_is_set_aside(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text('id,name,n\n1,one,1\n2,two\n3,"th,ree",3\n4,four,4,extra\n5,five,n/a\n6,,6\n')
    (folder / "b.csv").write_text("id,name,n\n7,seven,\n8\n")
    got = files.land(spark, str(folder), ["n", "id", "name"], {"n": "int"})
    assert values(got.rows, "id", "name", "n") == sorted([("1", "one", 1), ("3", "th,ree", 3), ("6", None, 6), ("7", "seven", None)], key=repr)
    rejected = values(got.rejected.select(F.element_at(F.split("file", "/"), -1).alias("file"), "line", "reason"))
    assert rejected == sorted([("a.csv", "2,two", "width"), ("a.csv", "4,four,4,extra", "width"), ("a.csv", "5,five,n/a", "value"), ("b.csv", "8", "width")], key=repr)
    assert got.rows.count() == 4 and got.rejected.count() == 4 and got.rows.select("id").count() == 4
    with pytest.raises(ValueError):
        files.land(spark, str(folder), ["id", "name"])


def test_spans_of_any_length_equal_between(spark):
    draw = random.Random(8)
    micro = timedelta(microseconds=1)
    spans = [(f"c{i}", datetime(1930 + 20 * i, 1, 1), datetime(2030, 1, 1, 0, 0, 0, 1)) for i in range(5)]
    spans += [(f"d{i}", T0 + timedelta(days=i), T0 + timedelta(days=i + 1) - micro) for i in range(40)]
    spans += [(f"r{i}", a, a + timedelta(seconds=draw.randint(0, 10**6))) for i in range(40) for a in [T0 + timedelta(seconds=draw.randint(0, 10**7))]]
    spans += [("point", T0, T0), ("back", T0, T0 - micro), ("open", T0, None), ("old", datetime(1960, 1, 1), datetime(1960, 1, 2))]
    times = [T0 + timedelta(seconds=draw.randint(-10**6, 10**7), microseconds=draw.randint(0, 999_999)) for _ in range(300)]
    times += [x for _, a, b in spans for x in (a, b, a - micro, a + micro, (b or a) + micro) if x] + [None, datetime(1900, 1, 1)]
    df = spark.createDataFrame(list(enumerate(times)), "i int, at timestamp")
    held = spark.createDataFrame(spans, "span string, a timestamp, b timestamp")
    got = grains.within_spans(df, "at", held, "a", "b")
    want = sorted((i, s) for i, t in enumerate(times) for s, a, b in spans if t and b and a <= t <= b)
    assert values(got, "i", "span") == sorted(want, key=repr)
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)
    assert grains.within_spans(df, "at", held.limit(0), "a", "b").count() == 0


# --- rollups, medians, balances ------------------------------------------------------------------------------


def test_reports_read_rollups_only(spark, sample):
    for name in ("rolled_revenue_by_month", "rolled_revenue_by_channel", "rolled_metrics_by_category", "rolled_kpi_cards", "rolled_orders_by_month_and_channel"):
        df = QUERIES[name].run(spark, sample)
        assert df.inputFiles() and all("/rollup-" in f for f in df.inputFiles()), name
    g = Given(spark, sample)
    held = {r.dims: r for r in stored.sales_rollups(g)}
    picked = lambda names, by, tested=(): rollups.pick(stored.SALES, list(held.values()), names, by, tested)
    assert picked(["units"], ["channel"]).dims == ("month", "channel")
    assert picked(["units"], ["channel"], ["order_date"]).dims == stored.DAY
    assert picked(["orders"], ["category"]).dims == ("category",)
    assert picked(["orders"], ["month", "category"]).dims == (*stored.DAY, "category")
    # Orders of several categories do not add up over them.
    assert picked(["units"], ["channel"], ["category"]).dims == (*stored.DAY, "category")
    assert picked(["orders"], ["channel"], ["category"]) is None
    some = lambda c: c < "m"
    fallback = stored.rolled(g, ["orders"], ["channel"], {"category": some})
    assert not any("/rollup-" in f for f in fallback.inputFiles())
    want = stored.sales_lines(g).filter(some(F.col("category"))).groupBy("channel").agg(F.countDistinct("order_id").alias("orders"))
    assert values(fallback) == values(want)


def test_rollups_read_the_fact_once_and_repeat_no_line(spark, sample):
    g = Given(spark, sample)
    table = stored.finest_rollup(g)
    plan = plan_of(table)
    assert "Expand" not in plan and plan.count("lineitem.parquet") == 1
    finest = rollups.Rollup(table, (*stored.DAY, "category"), tuple(stored.SALES.measures), 0)
    for dims in (["category"], stored.DAY, ["month", "channel"], []):
        want = rollups.roll_up(stored.SALES, stored.sales_lines(g), dims, finest.measures)
        assert values(rollups.coarser(stored.SALES, finest, dims)) == values(want)
    assert [n for n, (_, source) in stored.ROLLUPS.items() if source is None] == ["day-category"]


def test_medians_from_counts_and_sketches(spark):
    draw = random.Random(3)
    rows = [(draw.choice("ab"), date(2024, 1, 1) + timedelta(days=draw.randint(0, 20)), draw.choice([None, *range(30)])) for _ in range(3000)]
    rows += [("even", date(2024, 1, 1), 1), ("even", date(2024, 1, 2), 4), ("blank", date(2024, 1, 1), None)]
    df = spark.createDataFrame(rows, "x string, day date, v int")
    counts = quantiles.value_counts(df, "v", ["x", "day"])
    want = df.filter("v is not null").groupBy("x").agg(F.median("v").alias("m"))
    assert values(quantiles.median_of_counts(counts, "v", ["x"], "m")) == values(want)
    assert ("even", 2.5) in values(want)
    wide = spark.range(60_000).select(F.col("id").alias("v"), (F.col("id") % 30).alias("day"), (F.col("id") % 3).alias("x"))
    sketches = quantiles.value_sketches(wide, "v", ["day", "x"])
    for q in (0.1, 0.5, 0.99):
        for row in quantiles.quantile_of_sketches(sketches, ["x"], q, "at").collect():
            assert abs(row["at"] / 60_000 - q) < 0.02


def test_balances_equal_the_full_window_after_late_postings(spark, tmp_path):
    draw = random.Random(9)
    money = spark.createDataFrame([], "m decimal(18,2)").schema["m"].dataType
    book = Balances(spark, str(tmp_path / "b"), ["account"], money, 4)
    post = lambda n, lo, hi: [(draw.choice("abc"), draw.randint(lo, hi), Decimal(draw.randint(-500, 500)) / 100) for _ in range(n)]
    schema = "account string, period long, amount decimal(18,2)"
    parts = [post(60, 0, 11), post(10, 12, 12), post(5, 2, 3), [("new", 5, Decimal(1))], []]
    written = [book.add(spark.createDataFrame(p, schema), i) for i, p in enumerate(parts)]
    assert written == [[0, 1, 2], [3], [0, 1, 2, 3], [1, 2, 3], []]
    assert book.add(spark.createDataFrame(parts[2], schema), 2) == []  # it has run
    # One that broke off before its mark leaves things as they were.
    spark.createDataFrame([("a", Decimal(9))], "account string, closing decimal(18,2)").write.parquet(f"{book.path}/update-7/closing/block=0")
    everything = spark.createDataFrame([r for p in parts for r in p], schema).groupBy("account", "period").agg(F.sum("amount").alias("amount"))
    so_far = Window.partitionBy("account").orderBy("period")
    want = everything.withColumn("balance", F.sum("amount").over(so_far))
    assert values(book.all(), "account", "period", "amount", "balance") == values(want, "account", "period", "amount", "balance")
    # The last block is read with one opening row an account.
    assert all("/closing/block=2/" in f or "/activity/block=3/" in f for f in book.of([3]).inputFiles())

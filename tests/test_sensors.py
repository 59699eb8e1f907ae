from datetime import datetime, timedelta

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orewright.operators import sensors
from orewright.operators.dedupe import dedupe_latest
from orewright.sources.events import parse_events
from orewright.streaming import sinks, windows

T0 = datetime(2024, 1, 1, 12, 0, 0)
SCHEMA = ("reading_id long, event_time timestamp, device_id string, zone string, equipment_type string, "
          "temperature_celsius double, pressure_psi double, vibration_mms double, humidity_percent double, "
          "is_anomaly boolean, _ingested_at timestamp")


def reading(i, sec=0, dev="d1", zone="z1", temp=60.0, psi=30.0, vib=1.0, hum=40.0, odd=False, ingest=None):
    at = None if sec is None else T0 + timedelta(seconds=sec)
    return (i, at, dev, zone, "k", temp, psi, vib, hum, odd, ingest or (at or T0))


def test_limits_are_exceeded_strictly_and_null_metrics_do_not_count(frame):
    df = frame([reading(1, temp=100.0), reading(2, temp=100.1), reading(3, psi=42.5), reading(4, vib=5.6),
                reading(5, hum=75.5), reading(6, temp=None, hum=80.0), reading(7, temp=None)], SCHEMA)
    assert values(sensors.breaches(df), "reading_id") == [(2,), (3,), (4,), (5,), (6,)]
    assert values(sensors.breaches(df, hum=None), "reading_id") == [(2,), (3,), (4,)]
    assert values(sensors.filter_temp(frame([reading(1, temp=50.0), reading(2, temp=50.1)], SCHEMA)), "reading_id") == [(2,)]


def test_severity_has_two_levels(frame):
    df = sensors.with_severity(frame([reading(1, temp=90.0), reading(2, temp=90.5), reading(3, temp=101.0),
                                      reading(4, temp=None)], SCHEMA))
    assert [r[0] for r in df.orderBy("reading_id").select("temperature_celsius_severity").collect()] == [
        "normal", "warning", "critical", None]


def test_clock_filters_bins_and_zero_counts(frame):
    df = frame([reading(1, 0, odd=True), reading(2, 29), reading(3, 30, zone="z2"), reading(4, -90_000, zone="old")], SCHEMA)
    as_of = T0 + timedelta(seconds=60)
    assert values(sensors.anomalies_by_zone(df, as_of)) == [("z1", 1), ("z2", 0)]
    trend = sensors.temp_trend(df.filter("zone <> 'old'"))
    assert values(trend) == [(T0, 60.0), (T0 + timedelta(seconds=30), 60.0)]
    assert sensors.vibration_card(df, as_of).first()[0] == "Avg: 1.0 mm/s  |  Max: 1.0 mm/s"
    assert values(sensors.zone_bins(df, as_of), "zone", "alert_count") == [("z1", 0), ("z2", 0)]
    assert sensors.sensor_averages(df, as_of).first().avg_humidity == 40.0


def test_latest_per_device_breaks_ties_by_reading(frame):
    df = frame([reading(1, 5, temp=1.0), reading(9, 5, temp=9.0), reading(3, 5, temp=3.0), reading(4, None, "d2")], SCHEMA)
    got = sensors.latest_per_device(df).select("Device", "`Temp (°C)`")
    assert values(got) == [("d1", 9.0), ("d2", 60.0)]


def test_alerts_are_the_newest_twenty(frame):
    df = frame([reading(i, i, temp=150.0) for i in range(30)] + [reading(99, 99)], SCHEMA)
    got = sensors.critical_alerts(df)
    assert [r["Time"] for r in got.collect()] == [T0 + timedelta(seconds=29 - i) for i in range(20)]
    assert "TakeOrderedAndProject" in got._jdf.queryExecution().executedPlan().toString()


def test_bad_json_keeps_its_row(frame):
    body = '{"event_time": "2024-01-01T12:00:00.250000Z", "device_id": "d", "temperature_celsius": 1.5, "is_anomaly": true}'
    got = parse_events(frame([(1, body), (2, "{oops"), (3, '{"event_time": "soon"}')], "i int, body string"))
    rows = {r.i: r for r in got.collect()}
    assert rows[1].event_time == T0 + timedelta(milliseconds=250) and rows[1].is_anomaly is True
    assert (rows[1]._corrupt_record, rows[2]._corrupt_record) == (None, "{oops")
    assert rows[3].event_time is None and rows[2].device_id is None


@pytest.fixture
def feed(spark, tmp_path):
    """Readings in three files, read one file per batch."""
    def make(batches, schema=SCHEMA):
        folder = str(tmp_path / "in")
        for rows in batches:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        return sinks.read_files(spark, folder, spark.read.parquet(folder).schema, per_batch=1), spark.read.parquet(folder)

    return make


BATCHES = [
    [reading(1, 0), reading(2, 29, temp=80.0, vib=3.0), reading(3, 30)],
    [reading(4, 45, temp=100.0), reading(5, 61, "d2"), reading(6, 62, temp=10.0)],
    [reading(7, 75, "d2", vib=9.0), reading(8, 90)],
]


def test_stream_windows_equal_the_batch_aggregate(spark, feed, tmp_path):
    stream, table = feed(BATCHES)

    def partials(df):
        return windows.tumbling_partials(sensors.filter_temp(df))

    queries = sinks.route(stream, partials, str(tmp_path / "raw"), str(tmp_path / "agg"), str(tmp_path / "cp"), once=True)
    sinks.finish(*queries)
    got = windows.merged_stats(sinks.read_partials(spark, str(tmp_path / "agg"), partials(stream).schema))
    want = windows.tumbling_stats(sensors.filter_temp(table))
    assert values(got, *want.columns) == values(want)
    # The raw branch is not filtered.
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 8
    # A reading on the edge belongs to the window it starts.
    assert ("d1", "z1", 70.0, 3.0, T0 + timedelta(seconds=30)) in values(want)


def test_late_readings_reach_their_window(spark, feed, tmp_path):
    """Batches out of order by hours give the windows of all rows at once, none lost."""
    stream, table = feed([[reading(1, 0)], [reading(2, 7200)], [reading(3, 1, temp=99.0, vib=8.0)], [reading(4, 7201)]])
    out = str(tmp_path / "agg")
    sinks.finish(sinks.partial_sink(stream, windows.tumbling_partials, out, str(tmp_path / "cp"), once=True))
    got = windows.merged_stats(sinks.read_partials(spark, out, windows.tumbling_partials(stream).schema))
    assert values(got) == values(windows.tumbling_stats(table))
    counted = sinks.read_partials(spark, out, windows.tumbling_partials(stream).schema).groupBy().sum("_n").first()[0]
    assert counted == 4
    assert sinks.read_partials(spark, str(tmp_path / "none"), got.schema).count() == 0


def test_latest_state_follows_the_stream(spark, feed, tmp_path):
    stream, table = feed(BATCHES + [[reading(20, 3, temp=0.0)]])
    state = windows.latest_state(stream)
    sinks.finish(sinks.update_sink(state, str(tmp_path / "out"), str(tmp_path / "cp"), ["device_id"], once=True))
    got = sinks.read_updates(spark, str(tmp_path / "out"), state.schema, ["device_id"])
    want = dedupe_latest(table, "device_id", "event_time", ties=["reading_id"])
    assert values(got, "device_id", "reading_id") == values(want, "device_id", "reading_id")


def test_a_followed_table_takes_upserts_and_deletes_across_batches(spark, feed, tmp_path):
    feed_schema = "k int, v string, seq int, _op string"
    stream, _ = feed([[(1, "a2", 1, "upsert"), (2, "b2", 2, "upsert")], [(1, "x", 3, "delete"), (5, "e", 4, "upsert")],
                      [(5, "e2", 6, None), (5, "late", 5, "delete")]], feed_schema)
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    path = str(tmp_path / "table")
    sinks.start_mirror(target, path, ["k"], buckets=4)
    sinks.finish(sinks.follow_changes(stream, path, str(tmp_path / "cp"), ["k"], ["seq"], once=True))
    held = sinks.read_mirror(spark, path, target.schema, stream.schema, ["k"], ["seq"])
    assert values(held) == [(2, "b2"), (3, "c"), (5, "e2")]
    # A folded table starts over without a log, and still knows what came before a late change.
    assert 1 <= sinks.fold_mirror(spark, path, stream.schema, ["k"], ["seq"]) <= 3
    assert sinks.fold_mirror(spark, path, stream.schema, ["k"], ["seq"]) == 0
    assert values(sinks.read_mirror(spark, path, target.schema, stream.schema, ["k"], ["seq"])) == values(held)
    rows = [(5, "stale", 5, "upsert"), (1, "undead", 2, "upsert"), (2, "b3", 7, "upsert")]
    spark.createDataFrame(rows, feed_schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    sinks.finish(sinks.follow_changes(stream, path, str(tmp_path / "cp"), ["k"], ["seq"], once=True, fold_every=2))
    held = sinks.read_mirror(spark, path, target.schema, stream.schema, ["k"], ["seq"])
    assert values(held) == [(2, "b3"), (3, "c"), (5, "e2")]


def test_missing_event_clock_falls_back_to_ingestion(frame):
    from orewright.functions.dates import effective_time
    df = frame([reading(1, None, ingest=T0 + timedelta(seconds=9)), reading(2, 3)], SCHEMA)
    got = df.select("reading_id", effective_time(F.col("event_time"), F.col("_ingested_at")).alias("t"))
    assert values(got) == [(1, T0 + timedelta(seconds=9)), (2, T0 + timedelta(seconds=3))]
    assert values(sensors.retain(df, "_ingested_at", T0 + timedelta(days=1, seconds=5)), "reading_id") == [(1,)]

"""Streams give what the batch form gives, in any order of files."""

import os
from datetime import datetime, timedelta
from time import sleep
from time import time as clock

import pytest

from wayfare.plans import clicks as click_plans
from wayfare.plans import rides as ride_plans
from wayfare.plans import spend
from wayfare.schemas import FARE, RIDE
from wayfare.session import settings
from wayfare.sinks import streams
from wayfare.sinks.keyed import KeyedTable
from wayfare.sources import files
from wayfare.streaming import alarms, averages, time


@pytest.fixture(autouse=True)
def few_partitions(spark):
    with settings(spark, {"spark.sql.shuffle.partitions": "2"}):
        yield


@pytest.fixture
def late(spark):
    listener = streams.LateRows()
    spark.streams.addListener(listener)
    yield listener
    spark.streams.removeListener(listener)


def heard(listener, query, want):
    """What the listener counted, once it has had time to hear of the last batch."""
    deadline = clock() + 10
    while listener.of(query) != want and clock() < deadline:
        sleep(0.1)
    return listener.of(query)


T0 = datetime(2020, 1, 1, 12)
CLICKS = "page string, userId bigint, duration bigint, event_time timestamp, id bigint"


def ride(ride_id, is_start, at, start=None, lon=-73.9):
    """An event ``at`` seconds after noon; an END carries its start."""
    when = T0 + timedelta(seconds=at)
    began = when if is_start else T0 + timedelta(seconds=start or 0)
    end = datetime(1970, 1, 1) if is_start else when
    return (ride_id, is_start, began, end, lon, 40.7, -73.8, 40.8, 2, ride_id + 100, ride_id + 200)


def fare(ride_id, at, total=10.0, driver=1):
    return (ride_id, 100, driver, T0 + timedelta(seconds=at), "CASH", 0.0, 0.0, total)


def put(spark, folder, batches, schema):
    """Write each batch as one file, so that each is a micro-batch."""
    for i, batch in enumerate(batches):
        df = spark.createDataFrame(batch, schema)
        df.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        # The source takes files by age.
        for name in os.listdir(f"{folder}/in"):
            path = f"{folder}/in/{name}"
            if os.path.getmtime(path) > clock() - 3600:
                os.utime(path, (clock() - 7200 + i * 60,) * 2)
    return f"{folder}/in"


def run(df, folder, mode="append"):
    """Run to the end, and give the rows handed over and the query."""
    got = []
    query = streams.to_batches(
        df, lambda batch, n: got.extend((n, *row) for row in batch.collect()),
        f"{folder}/checkpoint", mode, streams.ONCE,
    )
    query.awaitTermination()
    return got, query


# --- long rides -------------------------------------------------------------

HOUR = 3600
CASES = {
    "ended in time": ([[ride(1, True, 0)], [ride(1, False, 2 * HOUR - 1)]], []),
    "ended at the deadline": ([[ride(1, True, 0)], [ride(1, False, 2 * HOUR)]], []),
    "ended just late": ([[ride(1, True, 0)], [ride(1, False, 2 * HOUR + 0.001)]], [1]),
    "never ended": ([[ride(1, True, 0)]], [1]),
    "end before start, same batch": ([[ride(1, False, 60), ride(1, True, 0)]], []),
    "end before start, earlier batch": (
        [[ride(1, False, 60), ride(9, True, 0)], [ride(1, True, 61 - 1, 0), ride(9, False, 61)]], []),
    "late end after the watermark": (
        [[ride(1, True, 0)], [ride(2, True, 3 * HOUR), ride(2, False, 3 * HOUR + 9, 3 * HOUR)],
         [ride(1, False, 2.5 * HOUR)]], [1]),
    "two rides, one long": (
        [[ride(1, True, 0), ride(2, True, 10)], [ride(2, False, 100, 10)]], [1]),
}


@pytest.mark.parametrize("stateful", [False, True])
def test_long_ride_alarm(spark, folder, stateful):
    batches = [
        # 5 ends before its start in one batch, 6 in an earlier batch.
        [ride(n, True, 0) for n in (1, 2, 3, 4)] + [ride(5, False, 60), ride(5, True, 0)]
        + [ride(6, False, 60, 60)],
        [ride(6, True, 60)],
        # In time, at the deadline, just late.
        [ride(1, False, 2 * HOUR - 1), ride(2, False, 2 * HOUR), ride(3, False, 2 * HOUR + 0.001)],
        [ride(7, True, 3 * HOUR), ride(7, False, 3 * HOUR + 9, 3 * HOUR)],
        # Too late: the alarm for 4 is out already.
        [ride(4, False, 2.5 * HOUR)],
        [ride(8, True, 10 * HOUR)],
    ]
    rides = files.ride_stream(spark, put(spark, folder, batches, RIDE), 1)
    form = alarms.long_rides_stateful if stateful else alarms.long_rides_stream
    got, _ = run(form(rides), folder)
    assert sorted(row[1] for row in got) == [3, 4]
    for row in got:
        assert row[2:5] == (True, T0, datetime(1970, 1, 1))
        assert row[9:] == (2, row[1] + 100, row[1] + 200)


@pytest.mark.parametrize(("stateful", "at_deadline"), [(False, []), (True, [1])])
def test_watermark_at_the_deadline(spark, folder, stateful, at_deadline):
    batches = [[ride(1, True, 0)], [ride(2, True, 2 * HOUR)]]
    path = put(spark, folder, batches, RIDE)
    form = alarms.long_rides_stateful if stateful else alarms.long_rides_stream
    got, _ = run(form(files.ride_stream(spark, path, 1)), folder)
    assert [row[1] for row in got] == at_deadline
    put(spark, folder, [[ride(3, True, 2 * HOUR + 1)]], RIDE)
    later, _ = run(form(files.ride_stream(spark, path, 1)), folder)
    assert [row[1] for row in got + later] == [1]
    assert [r["ride_id"] for r in ride_plans.long_rides(spark.read.schema(RIDE).parquet(path)).collect()] == [1]


@pytest.mark.parametrize("stateful", [False, True])
def test_no_alarm_before_the_deadline(spark, folder, stateful):
    batches = [[ride(1, True, 0)], [ride(2, True, 2 * HOUR - 60)]]
    rides = files.ride_stream(spark, put(spark, folder, batches, RIDE), 1)
    form = alarms.long_rides_stateful if stateful else alarms.long_rides_stream
    got, _ = run(form(rides), folder)
    assert got == []
    batch = ride_plans.long_rides(spark.read.schema(RIDE).parquet(f"{folder}/in"))
    assert batch.count() == 0


def test_batch_alarms(spark):
    for name, (batches, want) in CASES.items():
        events = [row for batch in batches for row in batch] + [ride(50, True, 10 * HOUR)]
        df = spark.createDataFrame(events, RIDE)
        assert [r["ride_id"] for r in ride_plans.long_rides(df).collect()] == want, name


def test_alarm_state_resumes_after_a_restart(spark, folder):
    path = put(spark, folder, [[ride(1, True, 0), ride(2, True, 0)]], RIDE)
    form = lambda: alarms.long_rides_stream(files.ride_stream(spark, path, 1))
    assert run(form(), folder)[0] == []
    put(spark, folder, [[ride(1, False, 60), ride(3, True, 3 * HOUR)]], RIDE)
    got, _ = run(form(), folder)
    assert [row[1] for row in got] == [2]


REPEATS = {
    "start again with its end": [[ride(1, True, 0)], [ride(1, True, 0), ride(1, False, 60, 0)]],
    "start again after its end": [[ride(1, True, 0), ride(1, False, 60, 0)], [ride(1, True, 0)]],
    "end first, twice": [[ride(1, False, 60, 0)], [ride(1, False, 60, 0), ride(1, True, 0)], [ride(1, False, 60, 0)]],
    "never ended, twice": [[ride(2, True, 0)], [ride(2, True, 0)]],
    "ended late, twice": [[ride(2, True, 0)], [ride(2, False, 3 * HOUR, 0)], [ride(2, False, 3 * HOUR, 0)]],
    "never ended, twice in a batch": [[ride(2, True, 0), ride(2, True, 0)], [ride(2, True, 0), ride(3, True, 60)]],
    "long after": [[ride(1, True, 0), ride(1, False, 60, 0)], [ride(9, True, 4 * HOUR)], [ride(8, True, 5 * HOUR)], [ride(1, True, 0)]],
}


@pytest.mark.parametrize("form", [alarms.long_rides_stream, alarms.long_rides_stateful])
@pytest.mark.parametrize("name", REPEATS)
def test_repeated_events_raise_no_other_alarms(spark, folder, name, form):
    batches = [*REPEATS[name], [ride(50, True, 10 * HOUR)]]
    path = put(spark, folder, batches, RIDE)
    got, _ = run(form(files.ride_stream(spark, path, 1)), folder)
    batch = ride_plans.long_rides(spark.read.schema(RIDE).parquet(path))
    assert sorted(row[1] for row in got) == sorted(row["ride_id"] for row in batch.collect())


def test_alarm_state_is_asked_for_by_bucket_not_by_ride(spark, folder):
    first = [ride(n, True, n % 50) for n in range(400)]
    second = [ride(n, False, 3000, n % 50) for n in range(0, 400, 2)] + [ride(900, True, 3000)]
    path = put(spark, folder, [first, second, [ride(901, True, 10 * HOUR)]], RIDE)
    got, query = run(alarms.long_rides_stateful(files.ride_stream(spark, path, 1), buckets=4), folder)
    # A bucket is one value and has one timer, so state is changed a few times for it.
    changed = [p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress]
    assert max(changed) <= 4 * 6
    batch = ride_plans.long_rides(spark.read.schema(RIDE).parquet(path))
    fields = [name for name in batch.columns if name != "end_time"]
    want = sorted(tuple(row) for row in batch.select(*fields).collect())
    assert len(want) == 201
    at = [1 + batch.columns.index(name) for name in fields]
    assert sorted(tuple(row[n] for n in at) for row in got) == want


def test_alarms_of_large_ids_and_of_rides_without_one(spark, folder):
    big = (1 << 62) + 1
    nobody = [(None, *ride(0, True, at)[1:]) for at in (5, 3)]  # one ride, with its first START
    batches = [[ride(big, True, 0), ride(big - 1, True, 0)], nobody, [ride(big - 1, False, 60, 0)], [ride(1, True, 10 * HOUR)]]
    path = put(spark, folder, batches, RIDE)
    got, _ = run(alarms.long_rides_stateful(files.ride_stream(spark, path, 1)), folder)
    assert sorted((str(row[1]), row[3]) for row in got) == [(str(big), T0), ("None", T0 + timedelta(seconds=3))]


# --- windows and joins ------------------------------------------------------


def test_rides_meet_fares_in_the_same_window(spark, folder):
    rides = [ride(1, True, 0), ride(2, True, 0.001), ride(3, True, 0.0015), ride(4, True, 1),
             ride(5, False, 2)]
    fares = [fare(1, 0), fare(2, 0.002), fare(3, 0), fare(5, 2), fare(6, 0)]
    ride_df, fare_df = spark.createDataFrame(rides, RIDE), spark.createDataFrame(fares, FARE)
    batch = ride_plans.rides_with_fares(ride_df, fare_df).collect()
    assert sorted(r["ride_id"] for r in batch) == [1, 3]
    first = next(r for r in batch if r["ride_id"] == 1)
    assert first["pair"] == (
        "1,START,2020-01-01T12:00:00Z,1970-01-01T00:00:00Z,-73.9,40.7,-73.8,40.8,2,101,201,"
        "1,100,1,2020-01-01T12:00:00Z,CASH,0.0,0.0,10.0"
    )
    ride_path = put(spark, f"{folder}/r", [rides[:2], rides[2:]], RIDE)
    fare_path = put(spark, f"{folder}/f", [fares[:1], fares[1:]], FARE)
    stream = ride_plans.rides_with_fares(
        time.timed_rides(files.ride_stream(spark, ride_path)),
        time.timed_fares(files.fare_stream(spark, fare_path)),
        ride_time="event_time",
    )
    got, _ = run(stream, folder)
    assert sorted(tuple(row[1:]) for row in got) == sorted(map(tuple, batch))


def test_hourly_fares_close_with_the_watermark(spark, folder):
    batches = [[fare(1, 0, 1.5), fare(2, HOUR - 1, 2.0)], [fare(3, HOUR, 4.0), fare(4, HOUR, 8.0, 2)],
               [fare(5, 3 * HOUR, 1.0)]]
    path = put(spark, folder, batches, FARE)
    stream = spend.hourly_fares(time.timed_fares(files.fare_stream(spark, path, 1)))
    got, _ = run(stream, folder)
    end = T0 + timedelta(hours=1)
    # Append mode: the last hour is still open.
    assert sorted(row[1:] for row in got) == [
        (end, 1, 3.5), (end + timedelta(hours=1), 1, 4.0), (end + timedelta(hours=1), 2, 8.0),
    ]


def click(i, page, at, duration=10, user=1):
    return (page, user, duration, T0 + timedelta(seconds=at), i)


def click_stream(spark, folder, batches, files_per_batch=1):
    return files.file_stream(spark, put(spark, folder, batches, CLICKS), CLICKS, files_per_batch)


def test_late_clicks_are_dropped_and_counted(spark, folder, late):
    # A batch is measured by the watermark of the batch before the last one.
    batches = [[click(1, "/a", 0)], [click(2, "/a", 100)], [click(5, "/c", 100)],
               [click(3, "/a", 1), click(4, "/b", 99.9)]]
    stream = click_plans.page_counts(time.timed_clicks(click_stream(spark, folder, batches)))
    got, query = run(stream, folder, "update")
    assert heard(late, query, 1) == 1
    # /b is 0.1 s behind the newest click, inside the allowed 0.2 s.
    assert sorted((row[3], row[4]) for row in got) == [
        ("/a", 1), ("/a", 1), ("/b", 1), ("/c", 1),
    ]


def test_arrival_time_instead_of_event_time(spark, folder, late):
    batches = [[click(1, "/a", 100)], [click(2, "/a", 0)]]
    stream = click_plans.page_counts(
        time.timed_clicks(click_stream(spark, folder, batches), use_event_time=False), "1 day"
    )
    got, query = run(stream, folder, "update")
    assert heard(late, query, 0) == 0
    assert all(row[1].year > 2020 for row in got)


@pytest.mark.parametrize("form", [click_plans.average_duration, averages.average_duration_stateful])
def test_running_average_over_batches(spark, folder, form):
    batches = [[click(1, "/a", 0, 10), click(2, "/a", 1, 20), click(3, "/b", 1, 7)],
               [click(4, "/a", 2, 60)]]
    got, _ = run(form(click_stream(spark, folder, batches)), folder, "update")
    assert sorted(got) == [(0, "/a", 15.0), (0, "/b", 7.0), (1, "/a", 30.0)]


# --- sinks ------------------------------------------------------------------


def test_last_write_wins_and_replays_change_nothing(spark, folder):
    table = KeyedTable(f"{folder}/t", CLICKS, ["userId"], ["event_time", "id"])
    frame = lambda *batch: spark.createDataFrame(list(batch), CLICKS)
    table.upsert(frame(click(1, "/a", 0), click(2, None, 0), click(3, "/c", 0, user=2)), 0)
    table.upsert(frame(click(4, "/old", -5)), 1)
    want = [(None, 1), ("/c", 2)]
    current = lambda t: sorted(((r["page"], r["userId"]) for r in t.current(spark).collect()), key=str)
    assert current(table) == sorted(want, key=str)
    table.upsert(frame(click(4, "/old", -5)), 1)
    assert current(table) == sorted(want, key=str)
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{folder}/t/rows").count() == 3
    folded = KeyedTable(f"{folder}/t2", CLICKS, ["userId"], ["event_time", "id"])
    table.fold_into(folded, spark)
    assert current(folded) == sorted(want, key=str)


def test_without_version_the_later_batch_wins(spark, folder):
    table = KeyedTable(f"{folder}/t", "page string, n bigint", ["page"])
    for batch_id, n in ((9, 1), (10, 2)):
        table.upsert(spark.createDataFrame([("/a", n)], "page string, n bigint"), batch_id)
    assert [tuple(r) for r in table.current(spark).collect()] == [("/a", 2)]


def test_upserts_from_a_stream(spark, folder):
    batches = [[click(1, "/a", 0), click(2, "/b", 5)], [click(3, "/c", 1), click(4, "/d", 0, user=2)]]
    table = KeyedTable(f"{folder}/t", CLICKS, ["userId"], ["event_time", "id"])
    stream = click_stream(spark, folder, batches)
    streams.to_keyed_table(stream, table, f"{folder}/cp", "append", streams.ONCE).awaitTermination()
    assert sorted((r["userId"], r["page"]) for r in table.current(spark).collect()) == [
        (1, "/b"), (2, "/d"),
    ]


def test_parquet_sink_writes_each_row_once_over_restarts(spark, folder):
    stream = click_stream(spark, folder, [[click(1, "/a", 0)]])
    for _ in range(2):
        streams.to_parquet(stream, f"{folder}/out", f"{folder}/cp", streams.ONCE).awaitTermination()
    put(spark, folder, [[click(2, "/a", 0)]], CLICKS)
    streams.to_parquet(stream, f"{folder}/out", f"{folder}/cp", streams.ONCE).awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 2


def test_batches_are_no_streams(spark, folder):
    stream = click_stream(spark, folder, [[click(1, "/a", 0)]])
    assert stream.isStreaming
    seen = []
    streams.to_batches(
        stream, lambda batch, _: seen.append(batch.isStreaming), f"{folder}/cp", trigger=streams.ONCE
    ).awaitTermination()
    assert seen == [False]


def test_console_sink_and_its_trigger(spark, folder):
    query = streams.to_console(click_stream(spark, folder, [[click(1, "/a", 0)]]))
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None
    assert streams.every("1 second") == {"processingTime": "1 second"}


def test_topic_sink_needs_its_connector(spark, folder):
    stream = click_stream(spark, folder, [[click(1, "/a", 0)]])
    body = click_plans.click_messages(stream)
    with pytest.raises(Exception, match="kafka"):
        streams.to_topic(body, "host:9092", "output", f"{folder}/cp")


def test_log_order_puts_start_before_end(spark):
    events = [ride(2, False, 10, 0), ride(1, True, 10), ride(3, True, 5), ride(2, True, 0)]
    log = ride_plans.event_log(spark.createDataFrame(events, RIDE)).orderBy("position")
    assert [(r["ride_id"], r["is_start"]) for r in log.collect()] == [
        (2, True), (3, True), (1, True), (2, False),
    ]

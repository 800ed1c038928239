"""The registered queries: name -> (session, folder of tables) -> result."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.codec import decode_transactions, split_json
from wayfare.functions.text import register_strlen
from wayfare.operators import joins
from wayfare.operators.collections import records_from_pairs
from wayfare.operators.nearest import nearest
from wayfare.operators.slicing import By
from wayfare.plans import clicks as click_plans
from wayfare.plans import marts, selection, spend, workforce
from wayfare.plans import rides as ride_plans
from wayfare.schemas import CLICK, conform
from wayfare.session import ROCKSDB_STATE, scratch_path, settings, written
from wayfare.sinks import files as sink
from wayfare.sinks.keyed import KeyedTable
from wayfare.sinks.late import LateSplit
from wayfare.sinks.streams import ONCE, to_batches, to_keyed_table, to_parquet
from wayfare.sinks.totals import RunningTotals
from wayfare.sources import files
from wayfare.sources.tables import table, view
from wayfare.streaming import alarms, averages, time
from wayfare.workload import inputs
from wayfare.workload.inputs import in_turn, naive, read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


# So many parts that every large group is cut, also on small tables.
MANY_PARTS = {
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def query(function: Query) -> Query:
    @functools.wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return run


# --- running a stream to its end -------------------------------------------


def ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def appended(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Run an append stream over what is there and read its output."""
    place = scratch_path(spark, "stream")
    to_parquet(df, f"{place}/out", f"{place}/checkpoint", ONCE).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{place}/out")


def upserted(
    df: DataFrame,
    spark: SparkSession,
    keys: Sequence[str],
    version: Sequence[str] = (),
    mode: str = "update",
) -> DataFrame:
    """Run a stream into a keyed table and read the table."""
    place = scratch_path(spark, "stream")
    table = KeyedTable(f"{place}/table", ddl(df), keys, version)
    to_keyed_table(df, table, f"{place}/checkpoint", mode, ONCE).awaitTermination()
    return table.current(spark)


# --- trips and zones: orders and customers ---------------------------------


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "orders")


@query
def borough_popularity(spark, folder):
    return marts.borough_popularity(
        _orders(spark, folder), read(spark, folder, "customer"),
        "o_custkey", "c_custkey", "c_mktsegment",
    )


@query
def borough_popularity_large_zones(spark, folder):
    return marts.borough_popularity(
        _orders(spark, folder), read(spark, folder, "customer"),
        "o_custkey", "c_custkey", "c_mktsegment",
    )


@query
def distance_by_borough_large_zones(spark, folder):
    return marts.distance_by_borough(
        _orders(spark, folder), read(spark, folder, "customer"),
        "o_custkey", "c_custkey", "c_mktsegment", "o_totalprice", "left",
    )


@query
def distance_by_borough(spark, folder):
    return marts.distance_by_borough(
        _orders(spark, folder), read(spark, folder, "customer"),
        "o_custkey", "c_custkey", "c_mktsegment", "o_totalprice",
    )


@query
def distance_by_borough_left(spark, folder):
    # Not every document has a label: those without are the null group.
    documents = marts.with_known_destination(read(spark, folder, "documents"), "doc_id")
    labels = read(spark, folder, "labels")
    return marts.distance_by_borough(
        documents, labels.withColumnRenamed("doc_id", "label_doc"),
        "doc_id", "label_doc", "quality", "n_chars", "left",
    )


@query
def distance_by_borough_sql(spark, folder):
    facts = _orders(spark, folder).select(
        F.col("o_custkey").alias("PULocationID"), F.col("o_totalprice").alias("trip_distance")
    )
    zones = read(spark, folder, "customer").select(
        F.col("c_custkey").alias("LocationID"), F.col("c_mktsegment").alias("Borough")
    )
    return marts.distance_by_borough_sql(
        spark, view(facts, "taxi_facts"), view(zones, "taxi_zones")
    )


@query
def distance_global(spark, folder):
    found = marts.distribution(_orders(spark, folder), "o_totalprice")
    return found.withColumns({name: F.round(name, 4) for name in ("mean", "stddev")})


@query
def trips_per_hour(spark, folder):
    return marts.trips_per_hour(read(spark, folder, "events"), "ts")


@query
def trips_per_hour_from_text(spark, folder):
    trips = read(spark, folder, "events").select(F.col("ts").cast("string").alias("pickup"))
    return marts.trips_per_hour(trips, "pickup")


@query
def trips_per_hour_text(spark, folder):
    return marts.hour_lines(marts.trips_per_hour(read(spark, folder, "events"), "ts"))


@query
def trips_per_hour_text_file(spark, folder):
    path = scratch_path(spark, "lines")
    sink.text(trips_per_hour_text(spark, folder), path)
    return spark.read.text(path)


@query
def borough_popularity_file(spark, folder):
    path = scratch_path(spark, "mart")
    sink.parquet(borough_popularity(spark, folder), path, files=1)
    return files.parquet(spark, path)


@query
def busiest_hour_top1(spark, folder):
    hours = marts.trips_per_hour(read(spark, folder, "events"), "ts")
    return marts.top(hours, 1, F.desc("trips"), "hour")


@query
def top_n(spark, folder):
    events = read(spark, folder, "events").select("event_id", "user_id", "value")
    return marts.top(events, 3, F.desc("value"), "event_id")


@query
def zones_uppercase_only(spark, folder):
    parts = read(spark, folder, "part").select(
        "p_brand",
        F.when(F.col("p_size") < 8, F.lower("p_type")).otherwise(F.col("p_type")).alias("service"),
    )
    return marts.zones_per_borough(parts, "p_brand", "service")


@query
def amount_over_threshold(spark, folder):
    return selection.amounts_over(
        _orders(spark, folder), 100_000, ("o_custkey", "o_totalprice"), "o_totalprice"
    )


@query
def cache_reuse(spark, folder):
    orders = _orders(spark, folder)
    columns = ("o_orderpriority", "o_totalprice")

    def chosen() -> DataFrame:
        return selection.amounts_over(orders, 100_000, columns, "o_totalprice")

    # Both aggregates are built anew and find the cached plan.
    with selection.kept(chosen()):
        per_priority = chosen().groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"))
        all_orders = chosen().agg(F.count(F.lit(1))).scalar()
        return written(per_priority.withColumn("all_orders", all_orders), "cached")


@query
def strlen_filter(spark, folder):
    return selection.long_names(
        read(spark, folder, "part"), "LARGE", 9, "p_type", "p_name"
    )


@query
def strlen_filter_udf(spark, folder):
    register_strlen(spark)
    name = view(read(spark, folder, "part"), "zone_names")
    return selection.long_names_sql(spark, name, "LARGE", 9, "p_type", "p_name")


# --- employees: customers ---------------------------------------------------


def _employees(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.employees(read(spark, folder, "customer"))


@query
def dense_rank_salary(spark, folder):
    return workforce.salary_rank(_employees(spark, folder))


@query
def dense_rank_salary_sql(spark, folder):
    employees = _employees(spark, folder).withColumnRenamed("employee", "employee_name")
    return workforce.salary_rank_sql(spark, view(employees, "employee"))


@query
def dense_rank_salary_sliced(spark, folder):
    # By the exact balance, thousands of values per segment, cut into many parts.
    customers = read(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    with settings(spark, MANY_PARTS):
        return workforce.salary_rank(customers, "c_mktsegment", "c_acctbal")


@query
def rank_salary(spark, folder):
    return workforce.salary_rank(_employees(spark, folder), kind="rank")


@query
def rank_salary_sliced(spark, folder):
    with settings(spark, MANY_PARTS):
        return rank_salary(spark, folder)


@query
def second_highest(spark, folder):
    return workforce.nth_salary(_employees(spark, folder), 2)


@query
def second_highest_sliced(spark, folder):
    # The plan of second_highest by the window group limit: nth_salary writes nothing
    # inside the block, so these settings do not reach it and nothing is cut.
    with settings(spark, MANY_PARTS):
        return second_highest(spark, folder)


@query
def join_using(spark, folder):
    orders = _orders(spark, folder).select(
        F.col("o_orderkey").alias("order_key"), "o_custkey", "o_totalprice"
    )
    lines = read(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_key"), "l_linenumber", "l_extendedprice"
    )
    return joins.join_using(lines, orders, "order_key")


@query
def employee_titles(spark, folder):
    suppliers = read(spark, folder, "supplier").select(
        F.col("s_nationkey").alias("emp_no"), F.col("s_name").alias("last_name")
    )
    nations = read(spark, folder, "nation").select(
        F.col("n_nationkey").alias("emp_no"), F.col("n_name").alias("title")
    )
    return workforce.titles(suppliers, nations)


# --- text and CSV scans: customers written out and read back ----------------


def _zone_file(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "zones")
    rows = inputs.zone_rows(read(spark, folder, "customer"))
    rows.write.option("header", True).option("quoteAll", True).csv(path)
    return path


@query
def zone_counts_text_scan(spark, folder):
    lines = files.text_fields(
        spark, _zone_file(spark, folder), ["LocationID", "Borough", "Zone", "service_zone"]
    )
    return marts.zones_per_borough(lines)


@query
def csv_typed_schema(spark, folder):
    return files.csv(spark, _zone_file(spark, folder))


@query
def csv_inferred_schema(spark, folder):
    return files.csv_inferred(spark, _zone_file(spark, folder))


@query
def csv_string_schema(spark, folder):
    zones = files.csv_strings(spark, _zone_file(spark, folder))
    return marts.zones_per_borough(zones)


# --- clicks: events ---------------------------------------------------------


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.click_messages(read(spark, folder, "events"))


def _clicks(spark: SparkSession, folder: str) -> DataFrame:
    return click_plans.clicks(_messages(spark, folder), keep=("event_id",))


def _events_in_turn(spark: SparkSession, folder: str) -> DataFrame:
    return in_turn(read(spark, folder, "events"), F.col("ts"))


def _click_stream(spark: SparkSession, folder: str) -> DataFrame:
    messages = inputs.click_messages(_events_in_turn(spark, folder))
    return click_plans.clicks(messages, keep=("event_id",))


@query
def clicks_decoded(spark, folder):
    return click_plans.click_times(_messages(spark, folder))


@query
def clicks_decoded_stream(spark, folder):
    messages = inputs.click_messages(_events_in_turn(spark, folder))
    return appended(click_plans.click_times(messages), spark)


@query
def clicks_decoded_strict(spark, folder):
    return naive(_clicks(spark, folder), "event_time")


@query
def clicks_readable(spark, folder):
    messages = inputs.broken_click_messages(read(spark, folder, "events"))
    return split_json(messages, CLICK)[0]


@query
def clicks_dead_letters(spark, folder):
    messages = inputs.broken_click_messages(read(spark, folder, "events"))
    return split_json(messages, CLICK)[1]


@query
def clicks_nested_json(spark, folder):
    return click_plans.user_devices(inputs.user_messages(read(spark, folder, "events")))


@query
def clicks_json_out(spark, folder):
    return click_plans.click_messages(_clicks(spark, folder))


@query
def stats_json_out(spark, folder):
    return click_plans.statistics_messages(click_plans.page_counts(_clicks(spark, folder)))


@query
def avg_duration_per_page(spark, folder):
    return click_plans.average_duration(_clicks(spark, folder))


@query
def avg_duration_per_page_stream(spark, folder):
    averages_so_far = click_plans.average_duration(_click_stream(spark, folder))
    return upserted(averages_so_far, spark, ["page"])


@query
def avg_duration_per_page_stateful(spark, folder):
    averages_so_far = averages.average_duration_stateful(_click_stream(spark, folder))
    return upserted(averages_so_far, spark, ["page"])


@query
def page_count_15s(spark, folder):
    counts = click_plans.page_counts(_clicks(spark, folder))
    return naive(counts, "windowStart", "windowEnd")


@query
def page_count_15s_stream(spark, folder):
    counts = click_plans.page_counts(time.timed_clicks(_click_stream(spark, folder)))
    table = upserted(counts, spark, ["windowStart", "windowEnd", "page"])
    return naive(table, "windowStart", "windowEnd")


@query
def late_clicks_stream(spark, folder):
    """Clicks of three batches with the batch and whether they came late."""
    events = inputs.thirds_with_stragglers(read(spark, folder, "events"))
    clicks = click_plans.clicks(inputs.click_messages(events), keep=("event_id",))
    place = scratch_path(spark, "late")
    split = LateSplit(f"{place}/clicks", ddl(clicks), "event_time", time.CLICK_DELAY)
    to_batches(clicks, split.write, f"{place}/checkpoint", trigger=ONCE).awaitTermination()
    return split.rows(spark).select("event_id", "batch_id", "late")


@query
def latest_click_per_user(spark, folder):
    latest = click_plans.latest_clicks(_clicks(spark, folder), ["event_time", "event_id"])
    return naive(latest, "event_time")


@query
def latest_click_upsert(spark, folder):
    rows = _click_stream(spark, folder)
    table = upserted(rows, spark, ["userId"], ["event_time", "event_id"], "append")
    return click_plans.click_row(table)


@query
def narrow_click_upsert(spark, folder):
    rows = click_plans.narrow_clicks(_click_stream(spark, folder))
    rows = rows.withColumn("written", F.col("timestamp"))
    table = upserted(rows, spark, ["timestamp", "page"], ["written"], "append")
    return naive(table.select("timestamp", "page"), "timestamp")


@query
def consecutive_dedup(spark, folder):
    clicks = _clicks(spark, folder).select("event_id", "userId", "page", "event_time")
    order = [By("event_time"), By("event_id")]
    return naive(click_plans.page_changes(clicks, order), "event_time")


@query
def consecutive_dedup_sliced(spark, folder):
    with settings(spark, MANY_PARTS):
        return consecutive_dedup(spark, folder)


@query
def map_to_record(spark, folder):
    rows = inputs.attribute_rows(read(spark, folder, "customer"))
    return records_from_pairs(rows, "c_custkey", "key", "value", ["name", "surname"])


# --- rides and fares: events ------------------------------------------------


def _rides(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.rides(read(spark, folder, "events"))


def _ride_stream(spark: SparkSession, folder: str) -> DataFrame:
    rides = inputs.rides(read(spark, folder, "events"))
    return in_turn(rides, F.when(F.col("is_start"), F.col("start_time")).otherwise(F.col("end_time")))


def _plain(rides: DataFrame) -> DataFrame:
    return naive(rides, "start_time", "end_time")


@query
def rides_in_city(spark, folder):
    return _plain(ride_plans.rides_in_city(_rides(spark, folder)))


@query
def rides_in_city_stream(spark, folder):
    return _plain(appended(ride_plans.rides_in_city(_ride_stream(spark, folder)), spark))


@query
def hourly_fare_per_driver(spark, folder):
    fares = inputs.fares(read(spark, folder, "events"))
    return naive(spend.hourly_fares(fares, scale=2), "window_end")


@query
def hourly_fare_per_driver_stream(spark, folder):
    fares = time.timed_fares(inputs.fares(_events_in_turn(spark, folder)))
    sums = upserted(spend.hourly_fares(fares, scale=2), spark, ["window_end", "driver_id"])
    return naive(sums, "window_end")


@query
def rides_join_fares(spark, folder):
    events = read(spark, folder, "events")
    pairs = ride_plans.rides_with_fares(inputs.rides(events), inputs.fares(events))
    return naive(pairs, "window_end")


@query
def rides_join_fares_stream(spark, folder):
    rides = time.timed_rides(_ride_stream(spark, folder))
    fares = time.timed_fares(inputs.fares(_events_in_turn(spark, folder)))
    pairs = ride_plans.rides_with_fares(rides, fares, ride_time="event_time")
    return naive(appended(pairs, spark), "window_end")


@query
def long_rides(spark, folder):
    return _plain(ride_plans.long_rides(_rides(spark, folder)))


@query
def long_rides_stream(spark, folder):
    return _plain(appended(alarms.long_rides_stream(_ride_stream(spark, folder)), spark))


@query
def long_rides_repeated_stream(spark, folder):
    """The alarms of a source that sends its events again."""
    sent = inputs.sent_twice(inputs.rides(read(spark, folder, "events")))
    rides = in_turn(sent, F.col("sent")).drop("sent")
    return _plain(appended(alarms.long_rides_stream(rides), spark))


@query
def long_rides_stateful(spark, folder):
    with settings(spark, {"spark.sql.streaming.stateStore.providerClass": ROCKSDB_STATE}):
        found = alarms.long_rides_stateful(_ride_stream(spark, folder))
        return _plain(appended(found, spark))


@query
def event_log_order(spark, folder):
    log = ride_plans.event_log(_rides(spark, folder))
    return naive(log.select("position", "event_time", "is_start", "ride_id"), "event_time")


@query
def event_log_order_sliced(spark, folder):
    with settings(spark, MANY_PARTS):
        return event_log_order(spark, folder)


@query
def pickup_heatmap(spark, folder):
    return ride_plans.pickup_heatmap(_rides(spark, folder)).select("cell", "pickups")


@query
def busiest_pickup_cells(spark, folder):
    cells = ride_plans.pickup_heatmap(_rides(spark, folder)).select("cell", "pickups")
    return marts.top(cells, 10, F.desc("pickups"), "cell")


@query
def cell_centres(spark, folder):
    return ride_plans.pickup_heatmap(_rides(spark, folder)).select(
        "cell",
        F.round(F.col("centre_lon").cast("double"), 4).alias("centre_lon"),
        F.round(F.col("centre_lat").cast("double"), 4).alias("centre_lat"),
    )


@query
def route_cells(spark, folder):
    return ride_plans.route_coverage(_rides(spark, folder))


def _trip_lengths(spark: SparkSession, folder: str, compat: bool) -> DataFrame:
    found = marts.distribution(ride_plans.trip_lengths(_rides(spark, folder), compat))
    return found.withColumns(
        {name: F.round(name, 4) for name in ("mean", "stddev", "min", "max")}
    )


@query
def trip_length_km(spark, folder):
    return _trip_lengths(spark, folder, False)


@query
def trip_length_km_compat(spark, folder):
    return _trip_lengths(spark, folder, True)


@query
def nearest_to_point(spark, folder):
    events = ride_plans.distance_to_point(_rides(spark, folder), -73.9857, 40.7484)
    near = events.select("ride_id", "is_start", F.round("distance", 6).alias("distance"))
    return marts.top(near, 10, "distance", "ride_id", "is_start")


@query
def nearest_per_customer(spark, folder):
    homes = inputs.homes(read(spark, folder, "customer"))
    starts = _rides(spark, folder).where("is_start").selectExpr(
        "ride_id", "start_lon AS lon", "start_lat AS lat"
    )
    return nearest(homes, starts, 3, "c_custkey", "ride_id")


@query
def direction_histogram(spark, folder):
    return ride_plans.direction_histogram(_rides(spark, folder))


@query
def direction_histogram_compat(spark, folder):
    return ride_plans.direction_histogram(_rides(spark, folder), compat=True)


# --- account spending: orders -----------------------------------------------


@query
def spend_by_account(spark, folder):
    messages = inputs.transaction_messages(_orders(spark, folder))
    return spend.spend_by_account(decode_transactions(messages))


@query
def mean_spend(spark, folder):
    messages = inputs.transaction_messages(_orders(spark, folder))
    return spend.mean_spend(spend.spend_by_account(decode_transactions(messages)))


@query
def spend_report_upsert(spark, folder):
    orders = in_turn(_orders(spark, folder), F.col("o_orderdate"))
    messages = inputs.transaction_messages(orders)
    transactions = decode_transactions(messages, keep=["o_orderkey"]).select(
        "account_id", F.col("ts").alias("log_ts"), F.col("amount").cast("bigint").alias("amount"),
        "o_orderkey",
    )
    table = upserted(
        transactions, spark, ["account_id", "log_ts"], ["o_orderkey"], "append"
    )
    return naive(table.drop("o_orderkey"), "log_ts")


@query
def spend_by_account_incremental(spark, folder):
    """Spending kept up to date while amounts are corrected."""
    amounts = in_turn(inputs.corrected_amounts(_orders(spark, folder)), F.col("sent")).drop("sent")
    place = scratch_path(spark, "spend")
    table = KeyedTable(f"{place}/amounts", ddl(amounts), ["o_orderkey"], ["step"], fold_after=2)
    totals = RunningTotals(table, f"{place}/totals", "o_custkey", "amount", "bigint")
    to_batches(amounts, totals.upsert, f"{place}/checkpoint", trigger=ONCE).awaitTermination()
    return totals.current(spark).select(F.col("group").cast("string").alias("metric"), "value")


# --- catalog and types -------------------------------------------------------


@query
def popularity_table(spark, folder):
    """A mart as a table of the catalog, read by its name."""
    name = f"popularity_{uuid.uuid4().hex}"
    sink.managed_table(borough_popularity(spark, folder), name)
    return table(spark, name)


@query
def cached_priorities(spark, folder):
    """Two queries of one table that SQL caches."""
    name = f"large_orders_{uuid.uuid4().hex}"
    view(_orders(spark, folder), f"{name}_of")
    cached = selection.cache_table(spark, name, f"SELECT * FROM {name}_of WHERE o_totalprice > 100000")
    by_priority = cached.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"))
    by_status = cached.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    both = by_priority.unionAll(by_status).toDF("kind", "orders")
    found = written(both, "priorities")
    spark.sql(f"UNCACHE TABLE {name}")
    return found


@query
def typed_orders(spark, folder):
    """Orders in a declared schema that is wider than the table's."""
    narrow = _orders(spark, folder).select("o_orderkey", F.col("o_custkey").cast("int"), F.col("o_totalprice").cast("float"))
    return conform(narrow, "o_orderkey string, o_custkey bigint, o_totalprice double")

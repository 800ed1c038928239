"""The test tables in the shapes of the reports' inputs.

The tables hold no rides or clicks, so ``events`` stands in: each event is a
ride by its user, or a click. All rows are used; but a ride of an error has no
END and an attribute without a value no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.clock import CONSUMER_CLOCK
from wayfare.functions.codec import encode_transaction
from wayfare.session import scratch_path
from wayfare.sources.files import file_stream, parquet

def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return parquet(spark, f"{folder}/{name}.parquet")


def in_turn(rows: DataFrame, at: Column, batches: int = 3) -> DataFrame:
    """``rows`` as a stream that brings them in several batches, in order of ``at``.

    They are cut at quantiles of the time. Rows without a time come with the first.
    """
    micros = F.unix_micros(at.cast("timestamp"))
    shares = [n / batches for n in range(1, batches)]
    cuts = sorted(set(rows.select(F.percentile_approx(micros, shares)).first()[0] or []))
    number = F.lit(0)
    for cut in cuts:
        number += F.coalesce(micros > cut, F.lit(False)).cast("int")
    return in_batches(rows, number, len(cuts) + 1)


def in_batches(rows: DataFrame, number: Column, batches: int, rows_a_file: int = 50_000) -> DataFrame:
    """``rows`` as a stream of the batches ``number``, from 0 to ``batches - 1``.

    They are written one batch after the other, each into as many files, by the
    number of rows and at most four for each core of the cluster; so many files are taken at a time.
    """
    spark = rows.sparkSession
    place = scratch_path(spark, "turns")
    most = 4 * spark.sparkContext.defaultParallelism
    count = max(1, min(most, rows.count() // batches // rows_a_file))
    numbered = rows.withColumn("turn__", number)
    for n in range(batches):
        part = numbered.where(F.col("turn__") == n).drop("turn__")
        part.repartition(count).write.mode("append").parquet(place)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return file_stream(spark, place, schema, count)


def thirds_with_stragglers(events: DataFrame) -> DataFrame:
    """Events as a stream of three batches, thirds of the time that they span.

    Every tenth comes with the batch after its own.
    """
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.select(F.min(micros), F.max(micros)).first()
    third = F.floor((micros - F.lit(low or 0)) * 3 / F.lit((high or 0) - (low or 0) + 1)).cast("int")
    straggles = (F.col("event_id") % 10 == 0).cast("int")
    return in_batches(events, F.least(F.lit(2), F.coalesce(third, F.lit(0)) + straggles), 3)


def naive(df: DataFrame, *columns: str) -> DataFrame:
    """The given timestamps without a zone, for comparison."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in columns})


# Coordinates spread over a box somewhat larger than the city.
_LON = "CAST(-74.1D + (((event_id % 4501) * {step}) % 4501) / 10000.0D AS FLOAT)"
_LAT = "CAST(40.45D + (((event_id % 6001) * {step}) % 6001) / 10000.0D AS FLOAT)"


def homes(customer: DataFrame) -> DataFrame:
    """A place to live for each customer, spread like the ends of rides."""
    east, north = "(c_custkey * 1777) % 4501", "(c_custkey * 2311) % 6001"
    return customer.selectExpr(
        "c_custkey",
        f"CAST(-74.1D + {east} / 10000.0D AS FLOAT) AS lon",
        f"CAST(40.45D + {north} / 10000.0D AS FLOAT) AS lat",
    )


def rides(events: DataFrame) -> DataFrame:
    """A START per event, and an END ``value`` minutes later unless it is an error."""
    events = events.withColumn("is_start", F.explode(F.array(F.lit(True), F.lit(False))))
    return events.where("is_start OR event_type <> 'error'").selectExpr(
        "event_id AS ride_id",
        "is_start",
        "CAST(ts AS TIMESTAMP) AS start_time",
        """CASE WHEN is_start THEN timestamp_micros(0)
           ELSE CAST(ts AS TIMESTAMP) + make_dt_interval(0, 0, CAST(floor(value) AS INT), 0)
           END AS end_time""",
        f"{_LON.format(step=2749)} AS start_lon",
        f"{_LAT.format(step=3571)} AS start_lat",
        f"{_LON.format(step=1013)} AS end_lon",
        f"{_LAT.format(step=5737)} AS end_lat",
        "CAST(event_id % 4 + 1 AS SMALLINT) AS passenger_cnt",
        "user_id + 2013000000 AS taxi_id",
        "user_id AS driver_id",
    )


def fares(events: DataFrame) -> DataFrame:
    """A fare of ``value`` per event."""
    return events.selectExpr(
        "event_id AS ride_id",
        "user_id + 2013000000 AS taxi_id",
        "user_id AS driver_id",
        "CAST(ts AS TIMESTAMP) AS start_time",
        "CASE WHEN event_id % 2 = 0 THEN 'CARD' ELSE 'CASH' END AS payment_type",
        "CAST(floor(value / 10) AS FLOAT) AS tip",
        "CAST(CASE WHEN event_id % 10 = 0 THEN 2.5D ELSE 0D END AS FLOAT) AS tolls",
        "CAST(value AS FLOAT) AS total_fare",
    )


def _click_body() -> Column:
    return F.to_json(
        F.struct(
            F.date_format("ts", CONSUMER_CLOCK).alias("timestamp"),
            F.concat(F.lit("/"), "event_type").alias("page"),
            F.col("user_id").alias("userId"),
            F.floor("value").cast("bigint").alias("duration"),
        )
    )


def sent_twice(rides: DataFrame) -> DataFrame:
    """Ride events from a source that repeats them, with the time ``sent``.

    Every START comes twice, every other one 40 minutes later, and every third END too.
    """
    own = F.when(F.col("is_start"), F.col("start_time")).otherwise(F.col("end_time"))
    again = F.when(F.col("ride_id") % 2 == 0, own).otherwise(own + F.expr("INTERVAL 40 MINUTES"))
    repeated = rides.where(F.col("is_start") | (F.col("ride_id") % 3 == 0))
    return rides.withColumn("sent", own).unionAll(repeated.withColumn("sent", again))


def corrected_amounts(orders: DataFrame) -> DataFrame:
    """Each order's amount twice: first half of it, and 200 days later the whole."""
    whole = F.floor("o_totalprice").cast("bigint")
    first = orders.select("o_orderkey", "o_custkey", F.floor(whole / 2).alias("amount"), F.lit(0).alias("step"),
                          F.col("o_orderdate").alias("sent"))
    then = orders.select("o_orderkey", "o_custkey", whole.alias("amount"), F.lit(1).alias("step"),
                         (F.col("o_orderdate") + F.expr("INTERVAL 200 DAYS")).alias("sent"))
    return first.unionAll(then)


def click_messages(events: DataFrame) -> DataFrame:
    """A JSON click per event as bytes, with the event's id beside it."""
    return events.select("event_id", _click_body().cast("binary").alias("value"))


def broken_click_messages(events: DataFrame) -> DataFrame:
    """The same, but those of errors lack the closing brace."""
    body = _click_body()
    ending = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.lit("}"))
    whole = F.concat(F.rtrim(body, F.lit("}")), ending)
    return events.select(whole.cast("binary").alias("value"))


def user_messages(events: DataFrame) -> DataFrame:
    """A JSON user per event; the device comes from ``props``, errors have none."""
    devices = F.when(
        F.col("event_type") != "error",
        F.array(
            F.struct(
                F.get_json_object("props", "$.k").cast("int").alias("id"),
                F.col("event_type").alias("model"),
            )
        ),
    ).otherwise(F.array())
    body = F.to_json(F.struct(F.col("user_id").cast("string").alias("name"), devices.alias("devices")))
    return events.select(body.alias("value"))


def transaction_messages(orders: DataFrame) -> DataFrame:
    """A CSV transaction per order, with the order's key beside it."""
    body = encode_transaction(
        F.col("o_custkey"), F.floor("o_totalprice").cast("int"), F.col("o_orderdate")
    )
    return orders.select("o_orderkey", body.cast("binary").alias("value"))


def employees(customer: DataFrame) -> DataFrame:
    """Customers as employees: the segment is the department, thousands the salary."""
    return customer.select(
        F.col("c_custkey").alias("employee"),
        F.col("c_mktsegment").alias("department"),
        F.floor(F.col("c_acctbal") / 1000).cast("bigint").alias("salary"),
    )


def zone_rows(customer: DataFrame) -> DataFrame:
    """Customers in the shape of the zone file; debtors have a lower-case service zone."""
    return customer.select(
        F.col("c_custkey").cast("int").alias("LocationID"),
        F.col("c_mktsegment").alias("Borough"),
        F.col("c_name").alias("Zone"),
        F.when(F.col("c_acctbal") < 0, F.lower("c_mktsegment"))
        .otherwise(F.col("c_mktsegment"))
        .alias("service_zone"),
    )


def attribute_rows(customer: DataFrame) -> DataFrame:
    """Customers as key/value rows; debtors have no surname."""
    pairs = F.create_map(
        F.lit("name"), F.col("c_name"),
        F.lit("surname"), F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")),
        F.lit("nation"), F.col("c_nationkey").cast("string"),
    )
    rows = customer.select("c_custkey", F.explode(pairs))
    return rows.where(F.col("value").isNotNull())

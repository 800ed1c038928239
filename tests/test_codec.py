from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wayfare.functions import clock, codec, text
from wayfare.plans import clicks as plans
from wayfare.plans import selection, spend
from wayfare.schemas import CLICK, USER_DEVICES
from wayfare.sources.tables import rows, view

GOOD = '{"timestamp":"01-01-1970 01:00:00:015","page":"/help","userId":2013000000,"duration":100}'


def messages(spark, *bodies):
    return spark.createDataFrame([(b,) for b in bodies], "value string").select(
        F.col("value").cast("binary")
    )


def test_click_times(spark):
    df = messages(
        spark, GOOD, "{broken", None, '{"page":"/x"}',
        '{"timestamp":"31-12-2020 23:59:59:999","page":"/y","more":1}',
        '{"timestamp":"yesterday","page":"/z"}',
    )
    assert [tuple(r) for r in plans.click_times(df).collect()] == [
        ("01:00:00:015", "/help"), (None, None), (None, None), (None, "/x"),
        ("23:59:59:999", "/y"), (None, "/z"),
    ]


def test_strict_decoding_fails_on_a_broken_message(spark):
    assert plans.clicks(messages(spark, GOOD)).first()["userId"] == 2013000000
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        plans.clicks(messages(spark, GOOD, "{broken")).collect()


def test_dead_letters(spark):
    good, dead = codec.split_json(messages(spark, GOOD, "{broken", '{"page":7,"userId":"x"}'), CLICK)
    assert [r["page"] for r in good.collect()] == ["/help"]
    assert sorted(r["value"] for r in dead.collect()) == ['{"page":7,"userId":"x"}', "{broken"]
    assert good.columns == ["timestamp", "page", "userId", "duration"]


def test_nested_users(spark):
    bodies = ['{"name":"Marta","devices":[{"id":7,"model":"Kelp 4"},{"id":2,"model":"B"}]}',
              '{"name":"Ann","devices":[]}', '{"name":"Bob","devices":null}']
    decoded = codec.decode_json(messages(spark, bodies[0]), USER_DEVICES).first()
    assert decoded["name"] == "Marta" and decoded["devices"][0]["model"] == "Kelp 4"
    assert [tuple(r) for r in plans.user_devices(messages(spark, *bodies)).collect()] == [
        ("Marta", 7, "Kelp 4"), ("Marta", 2, "B"), ("Ann", None, None), ("Bob", None, None),
    ]


def test_twelve_hour_clock_loses_the_afternoon(spark):
    df = spark.createDataFrame(
        [(datetime(2020, 1, 1, 13, 0), "/a", 1, 2)], "event_time timestamp, page string, userId bigint, duration bigint"
    )
    body = plans.click_messages(df).first()["value"]
    assert body == '{"timestamp":"01-01-2020 01:00:00:000","page":"/a","userId":1,"duration":2}'
    noon = spark.createDataFrame([("01-01-2020 12:00:00:000",)], "t string")
    read = noon.select(
        clock.parsed(F.col("t")), clock.parsed(F.col("t"), clock.PRODUCER_CLOCK)
    ).first()
    assert [x.hour for x in read] == [12, 0]


def test_transactions(spark):
    line = spark.createDataFrame([("1, 250, 2000-01-01 01:00:00",)], "value string")
    decoded = codec.decode_transactions(line)
    assert tuple(decoded.first()) == (1, 250, datetime(2000, 1, 1, 1))
    again = decoded.select(
        codec.encode_transaction(F.col("account_id"), F.col("amount"), F.col("ts")).alias("value")
    )
    assert again.first() == line.first()


def test_spend(spark):
    report = rows(
        spark, [(1, datetime(2000, 1, 1), 5), (1, datetime(2000, 1, 2), 6), (2, datetime(2000, 1, 1), 1)],
        "account_id bigint, log_ts timestamp, amount bigint",
    )
    spent = spend.spend_by_account(report, stamped=True)
    assert spent.columns == ["time", "metric", "value"]
    assert {r["metric"]: r["value"] for r in spent.collect()} == {"1": 11, "2": 1}
    assert spend.mean_spend(spent).first()[0] == 6.0


def test_lengths(spark):
    df = spark.createDataFrame([("Queens", "abcdefghij"), ("Queens", None), (None, "abcdefghijk"),
                                ("Bronx", "abcdefghijk"), ("Queens", "a\U0001f600")], "Borough string, Zone string")
    found = df.select(text.length_or_zero(F.col("Zone"))).collect()
    assert [r[0] for r in found] == [10, 0, 11, 11, 2]
    long = selection.long_names(df, longer_than=9)
    text.register_strlen(spark)
    by_sql = selection.long_names_sql(spark, view(df, "names"), longer_than=9)
    assert by_sql.collect() == long.collect()
    assert [tuple(r) for r in long.collect()] == [("Queens", "abcdefghij", 10)]
    spark.sql("SELECT strlen(Zone) AS n FROM names").collect() == found


def test_instants(spark):
    times = ["2020-01-01 12:00:00", "2020-01-01 12:00:00.25", "2020-01-01 12:00:00.000001"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp"))
    assert [r[0] for r in df.select(clock.iso_instant(F.col("t"))).collect()] == [
        "2020-01-01T12:00:00Z", "2020-01-01T12:00:00.250Z", "2020-01-01T12:00:00.000001Z",
    ]
    assert df.select(clock.epoch_millis(F.col("t"))).first()[0] == 1577880000000

from pyspark.sql import functions as F

from wayfare.operators.joins import join_back, join_keys, join_using
from wayfare.plans import workforce
from wayfare.session import settings

SMALL_BLOCKS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def facts(spark, n=120_000):
    """A third of the rows have key 0, and come from several tasks."""
    return spark.range(0, n, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 1000 END AS k", "id", "md5(CAST(id AS string)) AS x"
    )


def test_join_using(spark):
    left = spark.createDataFrame([(1, "1"), (2, "2"), (3, "3")], "int int, str string")
    right = spark.createDataFrame([(1, "2"), (2, "3"), (3, "4")], "int int, str2 string")
    joined = join_using(left, right, "int")
    assert joined.columns == ["int", "str", "str2"]
    assert sorted(map(tuple, joined.collect())) == [(1, "1", "2"), (2, "2", "3"), (3, "3", "4")]


def test_hot_key_is_split_over_tasks(spark, plan):
    dimension = spark.range(1000).withColumnRenamed("id", "k").withColumn("name", F.col("k") * 2)
    with settings(spark, SMALL_BLOCKS):
        joined = join_using(facts(spark), dimension, "k")
        result = joined.groupBy().agg(F.count(F.lit(1)), F.sum(F.col("name") - 2 * F.col("k")))
        rows = joined.collect()
        text = plan(joined)
        assert "skew=true" in text
        assert len(rows) == 120_000 and tuple(result.first()) == (120_000, 0)


def test_hot_value_is_split_when_ranks_are_joined_back(spark, plan):
    with settings(spark, SMALL_BLOCKS):
        found = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("rank"))
        joined = join_back(facts(spark), found, ["k"])
        assert len(joined.collect()) == 120_000
        assert "skew=true" in plan(joined)


def test_join_back_matches_nulls(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    found = spark.createDataFrame([(None, 7), ("a", 8)], "k string, rank int")
    assert sorted(map(tuple, join_back(df, found, ["k"]).collect()), key=str) == [
        ("a", 2, 8), (None, 1, 7),
    ]


def test_no_side_is_marked_for_broadcast(spark, plan):
    fact, dimension = spark.range(10), spark.range(9).withColumnRenamed("id", "key")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert "SortMergeJoin" in plan(join_keys(fact, dimension, "id", "key", "left"))
        assert "SortMergeJoin" in plan(join_back(fact, dimension.withColumnRenamed("key", "id"), ["id"]))


def test_titles(spark):
    people = spark.createDataFrame([(2, "Bell"), (1, "Ash"), (3, "Cole")], "emp_no int, last_name string")
    jobs = spark.createDataFrame([(1, "Engineer"), (2, "Staff"), (2, "Manager")], "emp_no int, title string")
    assert [tuple(r) for r in workforce.titles(people, jobs).collect()] == [
        ("Ash", "Engineer"), ("Bell", "Manager"), ("Bell", "Staff"),
    ]

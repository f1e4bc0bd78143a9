"""left_lookup against a plain dictionary, on keys of which one holds half of
all rows, a third has no key, and one hot key is in no dimension row."""

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tenantlens.operators.history import new_rows
from tenantlens.operators.joins import _crowded_keys, left_lookup, stored_bytes, without_match

HOT, LOST = "k0", "lost"


@pytest.fixture(scope="module")
def facts(spark):
    key = (
        F.when(F.col("id") % 6 < 2, F.lit(None).cast("string"))
        .when(F.col("id") % 6 < 4, F.lit(HOT))
        .when(F.col("id") % 6 == 4, F.lit(LOST))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 40))
    )
    return spark.range(0, 6000, 1, 6).select("id", key.alias("key"))


@pytest.fixture(scope="module")
def dimension(spark):
    name = F.when(F.col("id") % 5 != 0, F.concat(F.lit("name "), "id"))
    key = F.concat(F.lit("k"), "id")
    return spark.range(30).select(key.alias("key"), name.alias("name"), F.col("id").alias("no"))


def expected(facts, dimension):
    known = {r["key"]: (r["name"], r["no"]) for r in dimension.collect()}
    found = [(r["id"], r["key"], *known.get(r["key"], (None, None))) for r in facts.collect()]
    return sorted(found)


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"broadcast_bytes": 0},
        {"broadcast_bytes": 0, "hot_key_rows": 500},
        {"broadcast_bytes": 0, "hot_key_rows": 2, "hot_bytes": 1},
        {"broadcast_bytes": 0, "hot_key_rows": 1, "hot_bytes": 10**5},
    ],
)
def test_every_way_gives_the_same_rows(facts, dimension, options):
    result = left_lookup(facts, dimension, "key", "key", **options)
    assert result.columns == ["id", "key", "name", "no"]
    assert sorted(tuple(r) for r in result.collect()) == expected(facts, dimension)


def test_hot_and_missing_keys_are_spread_over_the_tasks(spark, facts, dimension):
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        result = left_lookup(
            facts, dimension, "key", "key", broadcast_bytes=0, hot_key_rows=500
        )
        sizes = [r["count"] for r in result.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 6000
    assert max(sizes) < 6000 / 8 * 1.5


def test_small_dimension_is_broadcast_and_facts_stay(facts, dimension):
    plan = left_lookup(facts, dimension, "key", "key")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan


def test_columns_of_both_sides_must_differ(facts, dimension):
    with pytest.raises(ValueError, match="both sides"):
        left_lookup(facts, dimension.withColumnRenamed("no", "id"), "key", "key")


def test_stored_bytes_counts_text_length(spark):
    one = spark.createDataFrame([("x" * 1000, 1)], "a STRING, b INT")
    assert 1000 < stored_bytes(one) < 1100
    assert stored_bytes(one.where("false")) == 0


def test_bigint_keys(spark):
    facts = spark.range(10).withColumnRenamed("id", "k")
    dimension = spark.range(5).select("id", (F.col("id") * 2).alias("twice"))
    result = left_lookup(facts, dimension, "k", "id", broadcast_bytes=0, hot_key_rows=1)
    assert rows(result) == sorted([(i, i * 2 if i < 5 else None) for i in range(10)], key=lambda t: str(t[0]))


def test_keys_of_different_integer_types(spark):
    facts = spark.createDataFrame([(1, 3), (2, 2**40), (3, None)], "f INT, k BIGINT")
    dimension = spark.createDataFrame([(3, "three"), (4, "four")], "id INT, name STRING")
    for options in ({}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "hot_key_rows": 1}):
        result = left_lookup(facts, dimension, "k", "id", **options)
        assert rows(result, "f", "name") == [(1, "three"), (2, None), (3, None)]


def test_sampled_search_finds_a_key_with_a_third_of_the_rows(spark):
    keys = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("_key")
    )
    assert [r["_key"] for r in _crowded_keys(keys, 50_000, 10)] == ["hot"]
    assert _crowded_keys(keys, 200_000, 10) == []


def test_without_match_on_hot_copies_of_two_part_keys(spark):
    rows_of = spark.range(400).select(
        "id",
        F.when(F.col("id") % 4 < 2, 1).when(F.col("id") % 4 == 2, 2).alias("a"),
        F.when(F.col("id") % 40 != 0, "x").alias("b"),
    )
    present = spark.range(50).select(F.lit(1).cast("bigint").alias("a"), F.lit("x").alias("b"))
    expected = sorted(i for i in range(400) if i % 4 >= 2 or i % 40 == 0)
    for hot_key_rows in (1, 50, 10**6):
        left = without_match(rows_of, present, ["a", "b"], hot_key_rows=hot_key_rows)
        assert left.columns == rows_of.columns
        assert sorted(r["id"] for r in left.collect()) == expected


def test_keys_of_other_types_are_refused_both_ways(spark):
    facts = spark.createDataFrame([(1.5,)], "k DOUBLE")
    dimension = spark.createDataFrame([(1, "one")], "id INT, name STRING")
    texts = spark.createDataFrame([("1",), ("abc",)], "id STRING")
    for broadcast_bytes in (0, 10**6):
        with pytest.raises(TypeError):
            left_lookup(facts, dimension, "k", "id", broadcast_bytes=broadcast_bytes)
        with pytest.raises(TypeError):
            new_rows(texts, dimension, ["id"], broadcast_bytes=broadcast_bytes)

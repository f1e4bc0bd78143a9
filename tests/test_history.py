"""Insert-only merge, its keys, its repair, and the moving windows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tenantlens.operators.history import (
    activity_window,
    capacity_window,
    in_window,
    merge_insert_only,
    new_rows,
)
from tenantlens.operators.key_index import KeyIndex
from tenantlens.sources.tables import TableStore


@pytest.fixture()
def empty(spark, tmp_path):
    return TableStore(spark, str(tmp_path))


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k STRING, v STRING")


@pytest.mark.parametrize("broadcast_bytes", [0, 10**6])
def test_only_rows_with_new_keys_are_added(spark, empty, broadcast_bytes):
    options = {"broadcast_bytes": broadcast_bytes}
    assert merge_insert_only(empty, "t", frame(spark, ("a", "1"), ("b", "1")), ["k"], **options) == 2
    batch = frame(spark, ("b", "2"), ("c", "2"))
    assert merge_insert_only(empty, "t", batch, ["k"], **options) == 1
    assert merge_insert_only(empty, "t", batch, ["k"], **options) == 0
    assert rows(empty.read("t")) == [("a", "1"), ("b", "1"), ("c", "2")]


@pytest.mark.parametrize("broadcast_bytes", [0, 10**6])
def test_a_missing_key_equals_nothing(spark, empty, broadcast_bytes):
    batch = frame(spark, (None, "1"), (None, "1"), ("a", "1"))
    for added in (3, 2):
        assert merge_insert_only(empty, "t", batch, ["k"], broadcast_bytes=broadcast_bytes) == added


def test_copies_inside_a_batch(spark, empty):
    batch = frame(spark, ("a", "1"), ("a", "1"), (None, "1"), (None, "1"))
    assert merge_insert_only(empty, "kept", batch, ["k"]) == 4
    assert merge_insert_only(empty, "merged", batch, ["k"], merge_copies=True) == 3


@pytest.mark.parametrize("broadcast_bytes", [0, 10**6])
def test_hot_copies_and_missing_keys_are_spread(spark, broadcast_bytes):
    """A third of the batch is one known key, a third one new key, a third has
    no key; the target holds the known key many times."""
    third = F.col("id") % 3
    batch = spark.range(0, 6000, 1, 6).select(
        "id", F.when(third == 0, "known").when(third == 1, "new").alias("k")
    )
    target = spark.range(3000).select(F.lit("known").alias("k"))
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        options = {"broadcast_bytes": broadcast_bytes, "hot_key_rows": 500}
        added = new_rows(batch, target, ["k"], **options)
        counts = {r["k"]: r["count"] for r in added.groupBy("k").count().collect()}
        sizes = [r["count"] for r in added.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert counts == {"new": 2000, None: 2000}
    assert max(sizes) < 4000 / 8 * 1.5


def test_empty_batch(spark, empty):
    nothing = frame(spark, ("a", "1")).where("false")
    assert merge_insert_only(empty, "t", frame(spark, ("a", "1")), ["k"]) == 1
    assert merge_insert_only(empty, "t", nothing, ["k"]) == 0


def metrics(spark, *data):
    return spark.createDataFrame(
        [(c, dt.date(2026, 8, 2), dt.datetime(2026, 8, 2, h), p) for c, h, p in data],
        "capacity_id STRING, date DATE, start_of_hour TIMESTAMP, background_pct DOUBLE",
    )


@pytest.mark.parametrize(
    "keys, added",
    [
        (["date", "start_of_hour"], [("c1", 9)]),
        (["capacity_id", "date", "start_of_hour"], [("c1", 9), ("c2", 11)]),
    ],
)
def test_composite_key(spark, empty, keys, added):
    merge_insert_only(empty, "m", metrics(spark, ("c1", 11, 10.0)), keys)
    batch = metrics(spark, ("c1", 9, 120.5), ("c1", 11, 99.0), ("c2", 11, 30.0))
    assert merge_insert_only(empty, "m", batch, keys) == len(added)
    table = empty.read("m")
    assert rows(table, "capacity_id", F.hour("start_of_hour")) == sorted([("c1", 11), *added], key=str)
    assert table.where("background_pct = 99.0").count() == 0


def test_pruned_merge_reads_the_days_of_the_batch_only(spark, empty):
    def events(*data):
        return spark.createDataFrame(
            [(k, dt.date(2026, 8, d) if d else None) for k, d in data], "k STRING, day DATE"
        )

    options = {"partition_by": ["day"], "prune_by": "day"}
    first = events(("a", 1), ("b", 2), ("n", None))
    assert merge_insert_only(empty, "t", first, ["k"], **options) == 3
    second = events(("b", 2), ("c", 2), ("n", None), ("d", 3))
    assert merge_insert_only(empty, "t", second, ["k"], **options) == 2
    assert rows(empty.read("t"), "k") == [("a",), ("b",), ("c",), ("d",), ("n",)]
    seen = empty.read("t").where(F.col("day").between("2026-08-02", "2026-08-03"))
    assert "PartitionFilters: [isnotnull(day" in seen._jdf.queryExecution().toString()


def dated(spark, *data):
    rows_ = [(k, v, dt.date(2026, 8, d) if d else None) for k, v, d in data]
    return spark.createDataFrame(rows_, "k STRING, v STRING, day DATE")


@pytest.mark.parametrize("broadcast_bytes", [0, 10**6])
def test_key_index_gives_what_the_history_gives(spark, empty, broadcast_bytes):
    """Known keys of the same day, of other days and new ones, missing keys, copies; the
    index lost, behind and grown out of its buckets."""
    import random
    import shutil

    rng = random.Random(4)
    options = {"partition_by": ["day"], "merge_copies": True, "broadcast_bytes": broadcast_bytes}
    for n in range(5):
        batch = dated(spark, *[(rng.choice([f"k{rng.randint(0, 300)}"] * 9 + [None]), str(n), rng.choice([1, 2, 3, None])) for _ in range(90)])
        index = KeyIndex(empty, "indexed", ["k"], near="day", bucket_keys=16, broadcast_bytes=broadcast_bytes)
        batch = batch.persist()
        merge_insert_only(empty, "plain", batch, ["k"], **options)
        merge_insert_only(empty, "indexed", batch, ["k"], index=index, **options)
        assert rows(empty.read("indexed"), "k", "v") == rows(empty.read("plain"), "k", "v")
        batch.unpersist()
        if n == 2:
            shutil.rmtree(empty.index.path("indexed"))
        if n == 3:  # an append that the index has not seen
            for table in ("plain", "indexed"):
                empty.append(table, dated(spark, ("late", "x", 2)), ["day"])
    state = KeyIndex(empty, "indexed", ["k"], bucket_keys=16)._state()
    assert state["buckets"] > 1 and state["rows"] == empty.read("indexed").count()


def test_key_index_reads_only_buckets_that_its_filter_names(spark, empty):
    empty.append("t", dated(spark, *[(f"k{i}", "1", 1) for i in range(4000)]), ["day"])
    index = KeyIndex(empty, "t", ["k"], near="day", bucket_keys=100)
    state = index.ready()
    assert state == index.ready() and state["buckets"] == 40
    found = index.known(dated(spark, ("k7", "2", 9), ("new", "2", 9)), state)
    assert rows(found, "k") == [("k7",)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    buckets = [p for p in plan.split("PartitionFilters: [")[1:] if p.startswith("bucket") or "bucket#" in p[:40]]
    assert buckets and all(p[: p.index("]")].count(",") < 4 for p in buckets)
    index.release()


def test_broken_first_load_is_repaired(spark, empty):
    """Some files of a load are there, its job never committed."""
    import pathlib

    whole = frame(spark, *[(f"k{i}", "1") for i in range(100)]).repartition(4)
    whole.write.parquet(empty.path("t"))
    folder = pathlib.Path(empty.path("t"))
    data = sorted(folder.glob("part-*.parquet"))
    for path in [data[0], folder / "_SUCCESS"]:
        path.unlink()
    for crc in folder.glob(".*.crc"):
        crc.unlink()
    lost = 100 - empty.read("t").count()
    assert lost > 0
    assert merge_insert_only(empty, "t", whole, ["k"]) == lost
    assert empty.read("t").select("k").distinct().count() == empty.read("t").count() == 100


def test_folder_without_data_files_is_no_table(spark, empty):
    import pathlib

    pathlib.Path(empty.path("t"), "_temporary").mkdir(parents=True)
    assert not empty.exists("t")
    assert not empty.exists("other")


def test_only_key_columns_of_the_history_are_read(spark, empty):
    merge_insert_only(empty, "t", frame(spark, ("a", "1")), ["k"])
    plan = new_rows(frame(spark, ("b", "1")), empty.read("t"), ["k"])._jdf.queryExecution().toString()
    scan = plan[plan.index("FileScan"):]
    assert "ReadSchema: struct<k:string>" in scan


def test_windows_are_whole_days():
    today = dt.date(2026, 8, 30)
    assert activity_window(today) == (dt.datetime(2026, 8, 3), dt.datetime(2026, 8, 31))
    assert capacity_window(today) == (dt.datetime(2026, 8, 16), dt.datetime(2026, 8, 30))


def test_window_is_half_open(spark):
    times = spark.createDataFrame(
        [(dt.datetime(2026, 8, 15, 23, 59),), (dt.datetime(2026, 8, 16),), (dt.datetime(2026, 8, 30),)],
        "ts TIMESTAMP",
    )
    inside = times.where(in_window(F.col("ts"), capacity_window(dt.date(2026, 8, 30))))
    assert rows(inside) == [(dt.datetime(2026, 8, 16),)]


def test_only_repeated_keys_are_compared_whole(spark):
    """Rows of keys that come once are neither sorted nor moved to merge copies."""
    from tenantlens.operators.history import _without_copies, one_per_key

    batch = spark.createDataFrame(
        [("a", 2), ("a", 1), ("b", 3), (None, 4), (None, 4), ("c", None)], "Id STRING, v INT"
    )
    expected = sorted(map(str, one_per_key(batch, ["Id"]).collect()))
    for limit in (1 << 20, 1):
        assert sorted(map(str, _without_copies(batch, ["Id"], limit).collect())) == expected
    single = batch.where("Id IS NULL OR Id <> 'a'")
    assert "Aggregate" not in _without_copies(single, ["Id"])._jdf.queryExecution().executedPlan().toString()

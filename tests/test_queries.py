"""Every registered query against its SQL on the smallest test tables."""

import gzip
import pathlib

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, difference
from tenantlens.operators import history, joins
from workload import queries as workload_queries
from workload import standins
from workload.oracles import ORACLES
from workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)

pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert NAMES == sorted(ORACLES)
    assert set(NAMES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, con, name):
    assert difference(queries()[name](spark, FOLDER), con, oracle_sql()[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0


def test_build_since_lands_packed_files_that_several_tasks_read(spark, con, monkeypatch, tmp_path):
    monkeypatch.setattr(workload_queries, "scratch_dir", lambda session, label: str(tmp_path / label))
    monkeypatch.setattr(workload_queries, "LANDED_RECORDS", 1_000, raising=False)
    assert difference(queries()["build_since"](spark, FOLDER), con, oracle_sql()["build_since"]) is None
    files = sorted((tmp_path / "landing" / "item_access").glob("part-*"))
    assert len(files) > 5 and {f.suffix for f in files} == {".gz"}
    text = [gzip.decompress(f.read_bytes()) for f in files]
    assert max(t.count(b"\n") for t in text) <= 1_000
    assert 5 * sum(f.stat().st_size for f in files) < sum(map(len, text))


JOINED = [
    "dim_inventory",
    "dim_workspace",
    "resolve_actor",
    "lineage_targets",
    "star_item_access",
    "report_activity",
    "report_lineage",
    "report_workspace_access",
    "merge_insert_only",
    "merge_composite_key",
    "measure_by_principal_type",
    "activity_stream",
]


@pytest.mark.parametrize("hot_key_rows", [3, 10**6])
@pytest.mark.parametrize("name", JOINED)
def test_query_equals_its_sql_without_broadcast(spark, con, monkeypatch, name, hot_key_rows):
    """The way large tables go: shuffled joins, with many hot keys and with none."""
    for function in (joins.left_lookup, joins.without_match, history.new_rows):
        for option, value in (("broadcast_bytes", 0), ("hot_key_rows", hot_key_rows)):
            if option in function.__kwdefaults__:
                monkeypatch.setitem(function.__kwdefaults__, option, value)
    monkeypatch.setattr(standins, "_BUILT", {})
    assert difference(queries()[name](spark, FOLDER), con, oracle_sql()[name]) is None

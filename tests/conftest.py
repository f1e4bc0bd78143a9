import datetime as dt
import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from tenantlens.plans.build import build_all, star_model  # noqa: E402
from tenantlens.session import build_session  # noqa: E402
from tenantlens.sources.tables import TableStore  # noqa: E402

LANDING = ROOT / "tests" / "landing"
TODAY = dt.date(2026, 8, 3)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.maxMetadataStringLength": "10000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def store(spark, tmp_path_factory):
    """All layers built from the landed fixture files."""
    built = TableStore(spark, str(tmp_path_factory.mktemp("tables")))
    build_all(spark, str(LANDING), built, TODAY)
    return built


@pytest.fixture(scope="session")
def model(store):
    return star_model(store)


@pytest.fixture(scope="session")
def landing():
    return LANDING

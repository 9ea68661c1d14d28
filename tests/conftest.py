import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(home / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


EVENT_DDL = (
    "batch string, event_id string, customer_id string, event_type string, "
    "segment_at_event string, amount_cents bigint, ts string"
)
COLUMNS = [c.split()[0] for c in EVENT_DDL.split(", ")]
PASSES = ("2024-01", "ev-7", "cust_000001", "card_txn", "mass", 2599, "2024-01-19T08:30:00Z")


def event(**changed):
    """An event that passes every gate of the January batch, but for what is changed."""
    return {column: changed.get(column, value) for column, value in zip(COLUMNS, PASSES, strict=True)} | changed


@pytest.fixture
def events(spark):
    def build(rows):
        return spark.createDataFrame([tuple(r.get(c.split()[0]) for c in EVENT_DDL.split(", ")) for r in rows], EVENT_DDL)

    return build


@pytest.fixture
def known(spark):
    def build(*ids):
        return spark.createDataFrame([(i,) for i in ids], "customer_id string")

    return build

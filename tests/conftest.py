import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from revcat.schema import EVENTS  # noqa: E402
from revcat.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session(
        "tests",
        spark_master="local[8]",
        spark_sql_shuffle_partitions="4",
        spark_ui_enabled="false",
        spark_driver_memory="6g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def utc(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


@pytest.fixture
def event():
    """A catalog row; only what matters to the test is given."""

    def make(id, event_time="2024-01-10 00:00:00", updated="2024-01-10 01:00:00", **rest):
        row = dict.fromkeys(EVENTS.names) | {"tsunami": False, "source": "feed"}
        row |= {"id": id, "event_time": utc(event_time), "updated": updated and utc(updated)}
        row |= {"ingested_at": utc("2024-02-01 00:00:00")} | rest
        return row

    return make


@pytest.fixture
def events(spark):
    """Rows as a DataFrame; nullable columns, as after a file read."""
    from revcat.schema import as_nullable

    return lambda rows: spark.createDataFrame(rows, as_nullable(EVENTS))

import pytest
from pyspark.sql import functions as F

from revcat.schema import EVENTS, RUNS, conform, enforce_required, null_report, required, split_required


def test_columns_and_required():
    assert len(EVENTS) == 25 and len(RUNS) == 14
    assert EVENTS.names[6:8] == ["latitude", "longitude"]
    assert required(EVENTS) == ["id", "event_time", "ingested_at"]
    assert required(RUNS) == ["run_id", "started_at", "status"]


def test_conform_goes_by_name_not_position(spark, event, events):
    rows = events([event("a", latitude=1.0, longitude=2.0)])
    shuffled = rows.select(*reversed(rows.columns)).drop("mag").withColumn("extra", F.lit(1))
    got = conform(shuffled)
    assert got.columns == EVENTS.names
    row = got.first()
    assert (row.latitude, row.longitude, row.mag) == (1.0, 2.0, None)


def test_required_rows_fail_or_split(event, events):
    rows = events([event("a"), event("b") | {"event_time": None}])
    good, bad = split_required(rows)
    assert [r.id for r in good.collect()] == ["a"] and [r.id for r in bad.collect()] == ["b"]
    with pytest.raises(Exception, match="event_time is NULL"):
        enforce_required(rows).collect()
    report = {r.column_name: (r.total_rows, r.null_rows) for r in null_report(rows).collect()}
    assert report == {"id": (2, 0), "event_time": (2, 1), "ingested_at": (2, 0)}

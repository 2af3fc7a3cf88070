from pyspark.sql import functions as F

from revcat.operators.revisions import (
    integrity, latest_revision, latest_revision_state, latest_revision_window, merge_probe, outcome,
)

ROWS = [
    ("a", 2, 0, "old"), ("a", 5, 1, "new"), ("a", None, 2, "none"),
    ("tie", 3, 0, "first"), ("tie", 3, 1, "last"),
    ("null", None, 0, "n0"), ("null", None, 1, "n1"),
]


def frame(spark):
    return spark.createDataFrame(ROWS, "id string, updated int, position int, mark string")


def test_latest_revision_forms_agree(spark):
    expected = {"a": "new", "tie": "last", "null": "n1"}
    for form in (latest_revision, latest_revision_state):
        assert {r.id: r.mark for r in form(frame(spark), then=["position"]).collect()} == expected
    order = [F.col("updated").desc_nulls_last(), F.col("position").desc()]
    assert {r.id: r.mark for r in latest_revision_window(frame(spark), order).collect()} == expected


def test_hot_key_leaves_one_row_per_map_task(spark):
    plan = latest_revision(frame(spark))._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("WindowGroupLimit", plan.index("Exchange hashpartitioning"))
    assert "Partial" in plan[partial:]


def test_outcomes(spark):
    cases = [
        (None, 5, None, "insert"), (None, None, None, "insert"), ("x", 5, 5, "keep"), ("x", 4, 5, "keep"),
        ("x", 6, 5, "update"), ("x", None, 5, "keep"), ("x", 5, None, "keep"), ("x", None, None, "keep"),
    ]
    rows = spark.createDataFrame([c[:3] for c in cases], "stored string, b int, s int")
    got = rows.select(outcome(F.col("stored"), F.col("b"), F.col("s"))).collect()
    assert [r[0] for r in got] == [c[3] for c in cases]
    oldest = rows.select(outcome(F.col("stored"), F.col("b"), F.col("s"), null_is_oldest=True)).collect()
    assert [r[0] for r in oldest][6:] == ["update", "keep"]


def test_probe_and_integrity(spark, event, events):
    target = events([event("a"), event("b")])
    batch = events([event("a", updated="2024-01-10 02:00:00"), event("b"), event("c", "2024-01-12 00:00:00")])
    row = merge_probe(batch, target).first()
    assert (row.to_insert, row.to_update) == (1, 1)
    assert merge_probe(batch.where("false"), target).first().min_time is None
    assert integrity(target).first().unique_ids is True
    assert integrity(target.unionByName(target)).first().unique_ids is False

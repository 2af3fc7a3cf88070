import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from revcat.functions import lenient
from revcat.functions.numbers import ratio, round_half_away
from revcat.functions.times import rfc3339, whole
from revcat.operators.normalize import normalize
from revcat.sources.documents import broken_documents, features, read_documents

NOW = "2024-01-31 00:00:00"


def feature(id, time=0, updated=None, place=(10.25, -3.5, 71.0), **properties):
    known = {"time": time, "updated": updated, "magType": "mw", "net": "zz", "tsunami": 1, "sig": 7}
    return {"id": id, "properties": known | properties, "geometry": {"coordinates": list(place)}}


@pytest.fixture
def normalized(spark, tmp_path):
    def run(*documents):
        for number, document in enumerate(documents):
            text = document if isinstance(document, str) else json.dumps(document, indent=1)
            (tmp_path / f"doc{number}.json").write_text(text)
        return normalize(read_documents(spark, str(tmp_path)), "t", NOW).collect()

    return run


def test_coordinates_are_lon_lat_depth(normalized):
    rows = normalized({"features": [feature("p", place=(179.5, -89.0, 0.0)), feature("q", place=(-0.5, 45.0))]})
    assert {r.id: (r.longitude, r.latitude, r.depth_km) for r in rows} == {"p": (179.5, -89.0, 0.0), "q": (-0.5, 45.0, None)}
    assert {(r.mag_type, r.source, r.tsunami, r.sig) for r in rows} == {("mw", "t", True, 7)}


def test_newest_of_many_revisions(normalized):
    shuffled = [40, 10, 50, 20, None, 30]
    (row,) = normalized({"features": [feature("many", updated=u, mag=(u or 0) / 10) for u in shuffled]})
    assert row.mag == 5.0


def test_later_of_equal_revisions_wins(normalized):
    ties = [feature("tie", updated=9, mag=m) for m in (0.5, 6.5, 2.5)]
    assert normalized({"features": ties})[0].mag == 2.5


def test_ties_across_lines_and_files(spark, tmp_path):
    """The later line, then the later file; a document that states its time goes by that."""

    def line(mag, generated=None):
        return json.dumps({"metadata": {"generated": generated}, "features": [feature("tie", updated=9, mag=mag)]})

    def winner():
        return normalize(read_documents(spark, str(tmp_path), whole_files=False), "t", NOW).first().mag

    (tmp_path / "a.json").write_text("\n".join(line(m) for m in (3.5, 0.5, 7.5, 1.5)))
    assert winner() == 1.5
    (tmp_path / "b.json").write_text(line(2.5) + "\n" + line(4.5))
    assert winner() == 4.5
    (tmp_path / "0.json").write_text(line(6.5, generated=20) + "\n" + line(5.5, generated=10))
    assert winner() == 6.5


def test_no_id_no_row(normalized):
    odd = [{"id": i, "properties": {"time": 1}} for i in (None, "", 0, False)]
    assert normalized({"features": [{"properties": {"time": 1}, "geometry": {}}, *odd]}) == []


def test_missing_fields_survive(normalized):
    rows = normalized({"features": [{"id": "bare"}, {"id": "timed", "properties": {"time": 86_400_000}, "geometry": None}]})
    at = {r.id: r.event_time for r in rows}
    assert at["bare"] is None and at["timed"].day == 2
    assert {(r.mag, r.latitude, r.sig) for r in rows} == {(None, None, None)}


def test_odd_documents(normalized):
    assert normalized({}, {"features": None}, {"features": {}}, [1, 2], {"features": []}) == []
    (row,) = normalized({"features": [{"id": "n", "properties": None, "geometry": None}]})
    assert row.event_time is None and row.tsunami is False


def test_broken_document_is_set_aside(spark, tmp_path):
    (tmp_path / "good.json").write_text(json.dumps({"features": [feature("a", 1, 2)]}))
    (tmp_path / "bad.json").write_text('{"features": [ {broken')
    docs = read_documents(spark, str(tmp_path))
    assert [r.file.split("/")[-1] for r in broken_documents(docs).collect()] == ["bad.json"]
    assert features(docs, on_broken="skip").count() == 1
    with pytest.raises(Exception, match="not a JSON document: .*bad.json"):
        features(docs).collect()


@pytest.mark.parametrize(
    "json_text, integer, truth",
    [
        ("100.9", 100, True), ('"100.9"', None, True), ('"100"', 100, True), ("-5.9", -5, True),
        ("true", 1, True), ('""', None, False), ("null", None, False), ("0", 0, False), ('"0"', 0, True),
        ("1e400", None, True), ("[]", None, False), ("[null]", None, True), ("{}", None, False), ('{"a":1}', None, True),
        ("0.0", 0, False), ("false", 0, False), ('"1.5f"', None, True),
    ],
)
def test_lenient_integer_and_truth(spark, json_text, integer, truth):
    value = spark.range(1).select(F.try_parse_json(F.lit('{"x":' + json_text + "}")).alias("v"))
    row = value.select(
        lenient.integer(F.col("v"), "$.x").alias("i"), lenient.truthy(F.col("v"), "$.x").alias("b")
    ).first()
    assert (row.i, row.b) == (integer, truth)


@pytest.mark.parametrize(
    "json_text, expected",
    [
        ("1700000000000", "2023-11-14 22:13:20"), ('"1700000000000"', "2023-11-14 22:13:20"),
        ("1700000000000.9", "2023-11-14 22:13:20"), ("-1", "1969-12-31 23:59:59.999"),
        ("1000000000000000000", None), ('"not-a-number"', None), ("null", None),
        ("253402300799999", "9999-12-31 23:59:59.999"), ("253402300800000", None),
    ],
)
def test_lenient_instant(spark, json_text, expected):
    value = spark.range(1).select(F.try_parse_json(F.lit('{"x":' + json_text + "}")).alias("v"))
    assert value.select(lenient.instant_ms(F.col("v"), "$.x").cast("string")).first()[0] == expected


def test_lenient_real(spark):
    texts = ['"3.5"', "3", '"junk"', '"1.5d"', "true", "[1]", "null"]
    rows = spark.createDataFrame([(f'{{"x":{t}}}',) for t in texts], "t string")
    got = rows.select(lenient.real(F.try_parse_json("t"), "$.x")).collect()
    assert [r[0] for r in got] == [3.5, 3.0, None, None, 1.0, None, None]


def test_whole_units_rounding_and_text(spark):
    def one(column):
        return spark.range(1).select(column).first()[0]

    def at(text):
        return F.lit(text).cast("timestamp")

    assert one(whole("MINUTE", at("2024-01-01 00:00:59"), at("2024-01-01 00:02:00"))) == 1
    assert one(whole("MINUTE", at("2024-01-01 00:02:00"), at("2024-01-01 00:00:59"))) == -1
    assert one(round_half_away(F.lit(0.285), 2)) == 0.29
    assert one(round_half_away(F.lit(-2.25), 1)) == -2.3
    assert one(round_half_away(F.lit(float("inf")), 1)) == float("inf")
    assert one(ratio(F.lit(1), F.lit(0))) is None
    assert one(rfc3339(at("2024-01-01 00:00:00"))) == "2024-01-01T00:00:00+00:00"
    for text in ("2024-01-01 00:00:00.25", "1969-12-31 23:59:59.5"):
        expected = dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc).isoformat()
        assert one(rfc3339(at(text))) == expected

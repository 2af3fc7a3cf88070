"""Feature -> flat event row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revcat.functions import lenient
from revcat.functions.times import instant
from revcat.operators.revisions import latest_revision
from revcat.schema import EVENTS, conform
from revcat.sources.documents import features

# The feed's property names for each column, by kind of reading.
TEXT = {
    "mag_type": "magType",
    "place": "place",
    "status": "status",
    "event_type": "type",
    "net": "net",
    "alert": "alert",
    "url": "url",
}
REAL = ["mag", "cdi", "mmi", "dmin", "rms", "gap"]
INTEGER = ["sig", "felt", "nst"]
INSTANT = {"event_time": "time", "updated": "updated"}
COORDINATES = {"longitude": 0, "latitude": 1, "depth_km": 2}

#: Where a feature stands in the delivery, the later the greater: of equal revisions the last one wins.
DELIVERY = ["generated", "file", "line", "position"]


def _feature_type() -> str:
    """Shape a feature is read in: one walk over the document; what does not fit is NULL."""
    kinds = dict.fromkeys(TEXT.values(), "string") | dict.fromkeys([*INTEGER, *INSTANT.values()], "bigint")
    kinds |= dict.fromkeys([*REAL, "tsunami"], "variant")
    properties = ",".join(f"`{name}`:{kind}" for name, kind in kinds.items())
    return f"struct<id:variant,properties:struct<{properties}>,geometry:struct<coordinates:array<variant>>>"


def flatten(feature_rows: DataFrame, source: str, ingested_at: dt.datetime | str) -> DataFrame:
    """One event row per feature that has an id, with its place in the delivery kept.

    ``ingested_at`` is passed in, so that a retried batch gets the same value.
    """
    named = feature_rows.where(lenient.truthy(F.col("feature"), "$.id")).select(
        *DELIVERY, F.try_variant_get("feature", "$", _feature_type()).alias("f")
    )
    columns = {"id": lenient.text(F.col("f.id")), "tsunami": lenient.truthy(F.col("f.properties.tsunami"))}
    columns |= {name: F.col(f"f.properties.{key}") for name, key in TEXT.items()}
    columns |= {name: F.col(f"f.properties.{name}") for name in INTEGER}
    columns |= {name: lenient.instant_of(F.col(f"f.properties.{key}")) for name, key in INSTANT.items()}
    columns |= {name: lenient.real(F.col(f"f.properties.{name}")) for name in REAL}
    columns |= {name: lenient.real(F.get("f.geometry.coordinates", F.lit(at))) for name, at in COORDINATES.items()}
    columns |= {"source": F.lit(source), "ingested_at": instant(ingested_at)}
    return named.select(*DELIVERY, *[columns[f.name].cast(f.dataType).alias(f.name) for f in EVENTS])


def normalize(
    docs: DataFrame, source: str, ingested_at: dt.datetime | str, on_broken: str = "fail"
) -> DataFrame:
    """Documents -> event rows, newest revision per id; of equals the later in the batch wins."""
    rows = flatten(features(docs, on_broken), source, ingested_at)
    return conform(latest_revision(rows, then=DELIVERY))

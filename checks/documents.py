"""Feed documents derived from the catalog view, with flaws at known places."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from checks import views as V
from revcat.session import scratch_dir

PAGE = 500  # features per document

# Flaws by key: no id, two coordinates, quoted sig, junk mag, no time; and a
# stale second delivery of every sixth event.
NO_ID, SHORT, QUOTED, JUNK, NO_TIME, AGAIN = 13, 19, 23, 29, 31, 6

STALE = V.EVENT_COLUMNS.replace("updated,", "updated - interval '1' hour AS updated,").replace(
    "status,", "'stale' AS status,"
)

FEATURES = f"""
WITH delivered AS (
  SELECT {V.EVENT_COLUMNS}, event_id, 0 AS copy FROM ({V.CATALOG}) AS c
  UNION ALL
  SELECT {STALE}, event_id, 1 AS copy FROM ({V.CATALOG}) AS c WHERE event_id % {AGAIN} = 0
)
SELECT event_id, copy, event_id div {PAGE} AS page, concat_ws(',',
  if(event_id % {NO_ID} = 0, null, concat('"id":"', id, '"')),
  '"type":"Feature"',
  concat('"geometry":{{{{"coordinates":[', longitude, ',', latitude,
         if(event_id % {SHORT} = 0, '', concat(',', depth_km)), ']}}}}'),
  concat('"properties":{{{{', concat_ws(',',
    concat('"page":', event_id div {PAGE}),
    if(event_id % {NO_TIME} = 0, null, concat('"time":', unix_millis(event_time))),
    concat('"updated":', coalesce(cast(unix_millis(updated) AS string), 'null')),
    if(event_id % {JUNK} = 0, '"mag":"junk"', concat('"mag":', coalesce(cast(mag AS string), 'null'))),
    concat('"magType":"', mag_type, '"'), concat('"place":"', place, '"'),
    concat('"status":"', status, '"'), concat('"type":"', event_type, '"'), concat('"net":"', net, '"'),
    concat('"tsunami":', cast(tsunami AS int)),
    concat('"sig":', if(event_id % {QUOTED} = 0, concat('"', sig, '"'), cast(sig AS string))),
    concat('"felt":', felt), concat('"cdi":', cdi), concat('"mmi":', mmi),
    concat('"alert":"', alert, '"'), concat('"nst":', nst), concat('"dmin":', dmin),
    concat('"rms":', rms), concat('"gap":', gap), concat('"url":"', url, '"')), '}}}}')) AS feature
FROM delivered
"""

# Values of every JSON kind, by key; ``t`` is a time in ms, at times out of range.
MESSY_VALUES = """
SELECT event_id, concat('{{"x":', CASE event_id % 14
    WHEN 0 THEN concat(CAST(event_id AS string), '.9')
    WHEN 1 THEN concat('"', CAST(event_id AS string), '.9"')
    WHEN 2 THEN concat('"', CAST(event_id AS string), '"')
    WHEN 3 THEN concat('-', CAST(event_id AS string), '.9')
    WHEN 4 THEN 'true'
    WHEN 5 THEN '""'
    WHEN 6 THEN 'null'
    WHEN 7 THEN '0'
    WHEN 8 THEN '"0"'
    WHEN 9 THEN '"junk"'
    WHEN 10 THEN '[]'
    WHEN 11 THEN '[0]'
    WHEN 12 THEN 'false'
    ELSE CAST(event_id AS string) END,
  ',"t":', CASE event_id % 5
    WHEN 0 THEN '1000000000000000000'
    WHEN 1 THEN concat('-', CAST(event_id AS string))
    WHEN 2 THEN concat('"', CAST(event_id * 1000 AS string), '"')
    WHEN 3 THEN '"not-a-number"'
    ELSE concat(CAST(event_id AS string), '000.7') END, '}}') AS body
FROM {events}
"""


def written(spark: SparkSession, sf_dir: str) -> str:
    """Write the documents, one per line; a page holds at most 2 * PAGE features."""
    path = scratch_dir(spark, "documents")
    listed = (
        V.view(spark, sf_dir, FEATURES)
        .groupBy("page")
        .agg(F.array_sort(F.collect_list(F.struct("event_id", "copy", "feature"))).alias("features"))
    )
    body = F.concat_ws(",", F.transform("features", lambda f: F.concat(F.lit("{"), f["feature"], F.lit("}"))))
    text = F.concat(F.lit('{"type":"FeatureCollection","features":['), body, F.lit("]}"))
    listed.select(text.alias("value")).write.mode("overwrite").text(path)
    return path

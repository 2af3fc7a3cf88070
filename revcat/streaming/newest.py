"""The newest revision per id as keyed state that expires.

The state of an id is the version it last let through, not the row, and goes
when the id has been silent for the time to live. So state is in proportion to the
ids seen within that time, and only rows that change something are put out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Micros of a version that is missing: older than any.
MISSING = -(1 << 63)
#: Groups of ids; a micro-batch of a hundred million rows gives each some ten thousand.
BUCKETS = 4096


class _Newest(StatefulProcessor):
    """Lets a row through if its version is greater than the one last let through for its id.

    A group is a bucket of ids, and the version is kept per id: what a group costs (frames,
    batches, its place in the state) is paid per bucket, and an id costs one look and one
    update. Memory is in proportion to a bucket's ids in one micro-batch.
    """

    def __init__(self, columns: list[str], key: T.StructField, versions: list[str], ttl_ms: int):
        self.columns, self.key, self.versions, self.ttl_ms = columns, key, versions, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        layout = T.StructType([T.StructField(v, T.LongType()) for v in self.versions])
        of = T.StructType([T.StructField("id", self.key.dataType)])
        self.seen = handle.getMapState("seen", of, layout, ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # By place: names that start with an underscore do not arrive.
        at, n, end = self.columns.index(self.key.name), len(self.columns), len(self.columns) + len(self.versions)
        best: dict[object, tuple] = {}
        for some in rows:
            for row in some.itertuples(index=False, name=None):
                if (held := best.get(row[at])) is None or row[n:end] > held[n:end]:
                    best[row[at]] = row
        fresh = []
        for one, row in best.items():
            seen = self.seen.getValue((one,))
            if seen is None or row[n:end] > tuple(seen):
                self.seen.updateValue((one,), row[n:end])
                fresh.append(row[:n])
        if fresh:
            yield pd.DataFrame(fresh, columns=self.columns)

    def close(self) -> None:
        pass


def newest_changes(
    rows: DataFrame,
    key: str = "id",
    version: str = "updated",
    then: Sequence[str] = (),
    ttl: str = "30 days",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Rows of a stream that are newer than all that came for their id within ``ttl``; one per id and micro-batch.

    Newer by (version, *then), instants or whole numbers; a missing one is oldest.
    Equal versions are no change. After ``ttl`` without a change an id counts as new, and
    the upsert that follows ignores what is stored already. Rows without a key are dropped.
    ``buckets`` of ids are the groups of the state, so their number is fixed for the life of a checkpoint.
    """
    names = [f"_version_{i}" for i in range(1 + len(then))]
    versions = {
        name: F.coalesce(
            F.unix_micros(c) if isinstance(rows.schema[c].dataType, T.TimestampType) else F.col(c).cast("bigint"),
            F.lit(MISSING).cast("bigint"),
        )
        for name, c in zip(names, (version, *then))
    }
    days, unit = ttl.split()
    ttl_ms = int(days) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")] * 1000
    processor = _Newest(rows.columns, rows.schema[key], names, ttl_ms)
    keyed = rows.where(F.col(key).isNotNull()).withColumns(versions)
    keyed = keyed.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets))).groupBy("_bucket")
    return keyed.transformWithStateInPandas(processor, rows.schema, outputMode="Update", timeMode="ProcessingTime")

"""Session settings the library relies on, and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from revcat.sources import files


def session(app_name: str = "revcat", **conf: str) -> SparkSession:
    """A session with the settings the library wants; ``conf`` keys use ``_`` for ``.``."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "zstd")
        # Longer IN lists reach Parquet only as their smallest and largest value.
        .config("spark.sql.parquet.pushdown.inFilterThreshold", "1000")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return pin_utc(builder.getOrCreate())


def pin_utc(spark: SparkSession) -> SparkSession:
    """All instants are UTC, so calendar functions must be too."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_scratch: list[str] = []


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a machine-local folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        path = f"{shared.rstrip('/')}/revcat/{label}-{uuid.uuid4().hex}"
    elif spark.sparkContext.master.startswith("local"):
        path = tempfile.mkdtemp(prefix=f"run-{label}-")
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    _scratch.append(path)
    return path


def clean_scratch(spark: SparkSession) -> int:
    """Remove the scratch folders this process made; results that read them are gone too."""
    gone = [files.remove(spark, _scratch.pop()) for _ in range(len(_scratch))]
    return sum(gone)


def written(df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` as a table in shared scratch space: computed once, safe if executors are lost. ``options`` are the writer's."""
    path = scratch_dir(df.sparkSession, label)
    df.write.mode("overwrite").options(**options or {}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

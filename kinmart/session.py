"""Session defaults for running a mart outside a session somebody else made."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app_name: str = "kinmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the mart relies on; ``conf`` overrides any of them.

    Adaptive execution picks the number of reduce tasks, splits skewed joins and turns a
    join into a broadcast only when the measured size is under the threshold.
    """
    settings = {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

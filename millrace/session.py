"""Session settings the package is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE does the size-dependent work: it picks join sides from measured sizes, merges
# small shuffle partitions and splits the partitions of a hot key.  Forcing the skew
# split accepts one more shuffle where a later stage wanted the join's partitioning.
# Concurrent writers spare a partitioned write the sort by partition value.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; keyword names use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {name.replace("__", "."): str(value) for name, value in conf.items()}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()

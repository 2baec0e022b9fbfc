"""Session settings used by the tests, the bench and stand-alone runs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "tillwise", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are designed for.

    On a cluster the master, memory sizes, shuffle partitions and
    ``spark.checkpoint.dir`` come from spark-submit; nothing here overrides them.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

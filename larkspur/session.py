"""Session settings that the library's results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "larkspur", **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; later map entries win over earlier ones."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    } | conf
    return SparkSession.builder.appName(name).config(map=settings).getOrCreate()

"""Session settings this engine is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE sizes shuffles and splits skewed partitions; dynamic overwrite replaces only the
# slices that are written.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str, **settings: str) -> SparkSession:
    """Session with the engine's settings; keyword ``spark__a__b`` sets ``spark.a.b``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

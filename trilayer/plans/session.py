"""Session for the command line. Library code takes whatever session it is given."""

from __future__ import annotations

from pyspark.sql import SparkSession

from trilayer.fixed_values import TIME_ZONE


def create_session(
    app_name: str = "trilayer", time_zone: str = TIME_ZONE, shuffle_partitions: int | None = None
) -> SparkSession:
    """Adaptive execution sizes the shuffles unless a count is given."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", time_zone)
        .config("spark.sql.adaptive.enabled", True)
        .config("spark.sql.adaptive.skewJoin.enabled", True)
        # Above 8000 bytes the JVM interprets a method; generate smaller ones instead.
        .config("spark.sql.codegen.hugeMethodLimit", 8000)
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
    return builder.getOrCreate()

"""Landed payloads: one file per response, foldered by source type and key.

``<root>/source_type=newsapi/source_key=technology/<any name>``
``<root>/source_type=rss/source_key=<feed url, percent-encoded>/<any name>``

The two folder levels are partition columns, so reading one type or one feed
never opens the files of another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions.fields import iso_text

LANDING_SCHEMA = "value string, source_type string, source_key string"


def read_landing(spark: SparkSession, path: str, after: str | None = None, before: str | None = None) -> DataFrame:
    """All payloads, or those that landed within the session's times ``after`` and ``before`` (ISO)."""
    reader = spark.read.format("text").option("wholetext", True).schema(LANDING_SCHEMA)
    if after:
        reader = reader.option("modifiedAfter", after)
    if before:
        reader = reader.option("modifiedBefore", before)
    return _stamped(reader.load(path))


def stream_landing(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text").option("wholetext", True).schema(LANDING_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _stamped(reader.load(path))


def _stamped(payloads: DataFrame) -> DataFrame:
    # The landing time, not the clock: a re-run stamps the same value.
    landed = F.to_utc_timestamp(F.col("_metadata.file_modification_time"), F.current_timezone())
    return payloads.withColumn("fetched_at", iso_text(landed))

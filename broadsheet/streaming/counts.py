"""Articles per source and interval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interval_counts(df: DataFrame, width: str = "1 hour", ts: str = "fetched_ts", late: str = "1 hour") -> DataFrame:
    """Streaming counts; an interval is final ``late`` after its end.

    Distinct urls are approximate: an exact set would be unbounded state.
    """
    return (
        df.withWatermark(ts, late)
        .groupBy(F.window(ts, width).alias("interval"), "source")
        .agg(F.count("*").alias("n_rows"), F.approx_count_distinct("url").alias("n_unique"))
        .select(F.col("interval.start").alias("interval_start"), "source", "n_rows", "n_unique")
    )


def hourly_collection(df: DataFrame, ts: str = "fetched_ts", width: str = "1 hour") -> DataFrame:
    """The batch form, with exact distinct urls."""
    return (
        df.groupBy(F.window(ts, width)["start"].alias("interval_start"), "source")
        .agg(F.count("*").alias("n_rows"), F.countDistinct("url").alias("n_unique"))
    )

"""Url dedup of an article stream with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_dedup(df: DataFrame, key: str = "url", ts: str = "fetched_ts", within: str = "1 day", salts: int = 16) -> DataFrame:
    """Keep the first arrival of each key within a sliding span of event time.

    Keys are forgotten once the watermark has passed them by ``within``, and rows
    later than that are dropped; ``start_collect`` is the form that keeps all.
    The first of the two steps thins out a repeated key where it was read, so a
    key that fills a third of a batch reaches the second step ``salts`` times at
    most. ``salts=1`` leaves that step out. Of rows that arrive in one micro-batch any
    may stay: arrival tells batches apart, not rows. ``dedup_url`` orders rows.
    """
    marked = df.withWatermark(ts, within)
    if salts > 1:
        salted = marked.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        marked = salted.dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
    return marked.dropDuplicatesWithinWatermark([key])

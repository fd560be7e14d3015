"""Collecting: union of sources, validity, first-wins dedup, daily merge, counts."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions.fields import ingest_date
from broadsheet.schema import ARTICLE_COLUMNS, DAILY_SCHEMA, ORDINALS


def valid_articles(df: DataFrame) -> DataFrame:
    """Drop rows whose url or title is null or empty; a blank one stays."""
    return df.filter((F.col("url") != "") & (F.col("title") != ""))


def collect_union(*sources: DataFrame) -> DataFrame:
    """All rows of all sources; the ordinals tell them apart."""
    return reduce(DataFrame.unionByName, sources)


def dedup_url(df: DataFrame, order: list[str] | None = None, scope: list[str] | None = None) -> DataFrame:
    """The first row of every url, within ``scope`` if given.

    ``row_number() = 1`` lets Spark prune each map task to one row per url before
    the shuffle, so a url that fills a third of the input sends one row per task.
    """
    keys = ["url", *(scope or [])]
    order = order or [c for c in ORDINALS if c in df.columns]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", first).filter(F.col("_rank") == 1).drop("_rank")


def collection_stats(df: DataFrame) -> DataFrame:
    """Rows and distinct urls per source.

    Spark counts in two steps, first by (source, url), so one large source or one
    much-repeated url does not end up in a single task.
    """
    return df.groupBy("source").agg(F.count("*").alias("n_rows"), F.countDistinct("url").alias("n_unique"))


def collection_totals(df: DataFrame) -> DataFrame:
    """Rows and distinct urls of a whole run."""
    return df.agg(F.count("*").alias("n_rows"), F.countDistinct("url").alias("n_unique"))


# -- the daily table --------------------------------------------------------


def new_for_day(batch: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows of ``batch`` whose url the same day's table does not hold yet."""
    known = existing.select("ingest_date", "url").distinct()
    return batch.join(known, ["ingest_date", "url"], "left_anti")


def with_ingest_date(df: DataFrame) -> DataFrame:
    return df.withColumn("ingest_date", ingest_date("fetched_at"))


def daily_batch(articles: DataFrame) -> DataFrame:
    """Valid articles, the first of each url and UTC day."""
    dated = with_ingest_date(valid_articles(articles))
    return dedup_url(dated, scope=["ingest_date"]).select(*ARTICLE_COLUMNS, "ingest_date")


def read_daily(spark, path: str) -> DataFrame:
    """The daily table, or an empty one where nothing was written yet."""
    try:
        return spark.read.schema(DAILY_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], DAILY_SCHEMA)


def batch_days(df: DataFrame) -> list:
    """The UTC days of a batch: a handful of dates, counted off on the executors."""
    return [row.ingest_date for row in with_ingest_date(df).select("ingest_date").distinct().collect()]


def merge_daily(articles: DataFrame, path: str, days: list | None = None) -> None:
    """Append the articles the daily table lacks, one folder per UTC day.

    Only the days of the batch are read, and only new rows are written. Running
    the same batch again, or after a half-finished run, adds what is missing and
    nothing twice. An unreadable fetch time makes it fail before anything is written.
    ``days`` spares a pass over the batch where they are known.
    """
    days = batch_days(articles) if days is None else days
    if not days:
        return
    existing = read_daily(articles.sparkSession, path).filter(F.col("ingest_date").isin(days))
    # a day's rows meet in few tasks, and so in few files; a large day is split
    fresh = new_for_day(daily_batch(articles), existing).hint("rebalance", "ingest_date")
    fresh.write.mode("append").partitionBy("ingest_date").parquet(path)

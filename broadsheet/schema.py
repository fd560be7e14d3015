"""The article record and the column names shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field names and order of the article record.
ARTICLE_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("published_at", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
        T.StructField("fetched_at", T.StringType()),
    ]
)
ARTICLE_COLUMNS = ARTICLE_SCHEMA.fieldNames()

# Where an article came from: which run, which source, which feed or category of
# it, and the position there. "First" always means first in this order.
ORDINALS = ["fetched_at", "source_ord", "feed_ord", "pos"]

# The stored daily table: the article plus its partition.
DAILY_SCHEMA = T.StructType(ARTICLE_SCHEMA.fields + [T.StructField("ingest_date", T.DateType())])


def article_columns(df: DataFrame) -> DataFrame:
    """Keep the article fields only, in schema order."""
    return df.select(*ARTICLE_COLUMNS)

"""Raw daily files: each one JSON array of article objects.

This is the import format. A JSON array cannot be split, so one file is one
task; after import the articles live in the partitioned Parquet table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions.fields import fetched_at_now, json_field
from broadsheet.schema import ARTICLE_COLUMNS


def scan_raw_articles(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """All articles of all ``*.json`` files below ``path``, and the rejects."""
    files = (
        spark.read.format("text")
        .option("wholetext", True)
        .option("pathGlobFilter", "*.json")
        .load(path)
        .select(F.col("_metadata.file_path").alias("path"), "value")
    )
    return parse_raw_files(files)


def parse_raw_files(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(articles, rejects) of ``path, value`` rows, one row per file.

    A file that is not a JSON array is rejected whole; an element that is not an
    object is rejected alone. A key an article lacks becomes '', a null stays null.
    """
    is_array = F.json_array_length("value").isNotNull()
    elements = files.filter(is_array).select(
        "path", F.posexplode(F.from_json("value", "array<variant>")).alias("pos", "item")
    )
    # only an object can be read as a map
    is_object = F.try_variant_get("item", "$", "map<string,variant>").isNotNull()

    fields = _article_fields(F.col("item"), {name: "" for name in ARTICLE_COLUMNS})
    articles = elements.filter(is_object).select("path", "pos", *fields)

    bad_files = files.filter(~is_array).select(
        "path", F.lit(None).cast("int").alias("pos"), F.col("value").alias("content")
    )
    bad_items = elements.filter(~is_object).select("path", "pos", F.to_json("item").alias("content"))
    return articles, bad_files.unionByName(bad_items)


def _article_fields(item: Column, absent: dict[str, str | None]) -> list[Column]:
    """The article fields of a VARIANT object, in schema order; other keys vanish."""
    empty = F.create_map().cast("map<string,string>")
    fields = {name: json_field(item, name, absent.get(name)) for name in ARTICLE_COLUMNS}
    fields["metadata"] = F.coalesce(F.try_variant_get(item, "$.metadata", "map<string,string>"), empty)
    return [column.alias(name) for name, column in fields.items()]


def article_from_json(df: DataFrame, json_col: str) -> DataFrame:
    """Replace a column of article JSON by the article fields.

    Absent optional fields get the record's defaults, which for the fetch time is
    now. An absent title, body, url or source is null: such a record is not valid.
    """
    fields = _article_fields(F.col("_item"), {"published_at": "", "author": ""})
    stamped = F.try_variant_get("_item", "$.fetched_at", "variant").isNotNull()
    fields = [F.when(stamped, c).otherwise(fetched_at_now()).alias(n) if n == "fetched_at" else c for n, c in zip(ARTICLE_COLUMNS, fields)]
    parsed = df.withColumn("_item", F.try_parse_json(json_col))
    return parsed.select(*[c for c in df.columns if c != json_col], *fields)

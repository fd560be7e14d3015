"""Stored tables: the processed dataset, reports, the labelled corpus, the vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Cells a CSV reader in the notebooks' tool set takes as missing.
CSV_MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def save_dataset(df: DataFrame, path: str) -> bool:
    """Overwrite the dataset at ``path``; an empty one is not written. True if written.

    Rows that carry a ``split`` go to one folder per split.
    """
    if df.isEmpty():
        return False
    writer = df.write.mode("overwrite")
    if "split" in df.columns:
        writer = writer.partitionBy("split")
    writer.parquet(path)
    return True


def load_dataset(spark: SparkSession, path: str, spread_by: str | None = None) -> DataFrame:
    """The stored table; with ``spread_by``, on all cores however few files it has.

    A scan has no more tasks than the files have row groups. Where that leaves
    cores idle, rows are hashed by their id, which also puts later per-row-id
    windows in place. A large table has splits enough and is read as it lies.
    """
    table = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if spread_by and table.rdd.getNumPartitions() < cores:
        return table.repartition(cores, spread_by)
    return table


def write_reports(reports: DataFrame, path: str) -> None:
    """Append reports as JSON lines in one folder per run (UTC stamp of the job)."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    stamped = reports.withColumn("report_ts", F.date_format(now, "yyyy-MM-dd_HHmmss"))
    stamped.write.mode("append").partitionBy("report_ts").option("ignoreNullFields", False).json(path)


def labelled_corpus(
    source: DataFrame | SparkSession, path: str | None = None, label_type: str | None = None, multi_line: bool = True
) -> DataFrame:
    """``text, label`` rows with neither missing, from a frame or from CSV files.

    A label in a file is text unless ``label_type`` asks for a type; one that is not of
    that type makes the job fail, it is not dropped.

    Quoted line breaks need ``multi_line``, and then one file is one task. Files
    without them should be read with ``multi_line=False``, which Spark splits.
    """
    if path is not None:
        raw = source.read.csv(path, header=True, multiLine=multi_line, quote='"', escape='"')
        text, label = (F.when(~F.col(c).isin(CSV_MISSING), F.col(c)) for c in ("text", "label"))
        if label_type:
            wrong = F.raise_error(F.concat(F.lit(f"label is no {label_type}: "), label)).cast(label_type)
            label = F.when(label.isNotNull(), F.coalesce(label.try_cast(label_type), wrong))
        source = raw.select(text.alias("text"), label.alias("label"))
    return labelled_rows(source).select("text", "label")


def labelled_rows(df: DataFrame) -> DataFrame:
    """Rows with both a text and a label.

    Plain null tests, unlike ``na.drop``, reach the scan and turn an outer join
    for the label into an inner one.
    """
    kept = df.filter(F.col("text").isNotNull() & F.col("label").isNotNull())
    is_float = df.schema["label"].dataType.typeName() in ("float", "double")
    return kept.filter(~F.isnan("label")) if is_float else kept


def write_corpus(df: DataFrame, path: str) -> None:
    """CSV with a header; quotes are doubled, missing and empty cells are blank."""
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', nullValue="", emptyValue="")


def save_vocab(vocab: DataFrame, path: str) -> None:
    vocab.write.mode("overwrite").parquet(path)


def load_vocab(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)

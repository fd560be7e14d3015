"""What the operators of this package share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have yet, Spark's case rules in mind."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def own_folder(master: str) -> str:
    """A folder of this machine, which is all there is under a local master."""
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"set {CHECKPOINT_DIR} to storage that every executor can reach")
    return tempfile.mkdtemp(prefix="broadsheet-")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; one of this machine's own only where none is named and nothing runs elsewhere."""
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None)
    current = context._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        context.setCheckpointDir(root or own_folder(context.master))
        current = context._jsc.sc().getCheckpointDir()
    return current.get()


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored in the shared folder: it survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, bucket_by: str | None = None, buckets: int = 0) -> DataFrame:
    """``df`` as a compressed Parquet table of its own in the shared folder, bucketed if a column is named."""
    spark, name = df.sparkSession, f"stored_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{name}"
    writer = df.write.option("compression", "zstd")
    if bucket_by is None:
        writer.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    writer.format("parquet").bucketBy(buckets, bucket_by).option("path", path).saveAsTable(name)
    return spark.table(name)


def utf8(texts: pa.Array) -> pa.Array:
    """Texts as their bytes, without decoding them."""
    return texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())


def word_blocks(data: bytes, limit: int = 1 << 21) -> Iterator[list[bytes]]:
    """The words between ASCII white space, in lists of about ``limit`` bytes of text.

    A cut falls on white space only, so no word is split.
    """
    if len(data) <= limit:
        yield data.split()
        return
    at = 0
    while at < len(data):
        end = at + limit
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield data[at:end].split()
        at = end

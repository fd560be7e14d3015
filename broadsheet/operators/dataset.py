"""Working with the processed dataset: clean, count, pick, split, shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions.fields import article_uid
from broadsheet.functions.text import clean_columns

# Buckets are the first four hex digits of a hash: 65,536 at most, of even size
# because the hash is uniform, and already in hash order.
_BUCKET_HEX = 4


def preprocess_articles(df: DataFrame) -> DataFrame:
    """Clean title and body; clean the author unless null or empty."""
    cleaned = clean_columns(df.withColumn("_author", F.col("author")), "title", "body", "_author")
    author = F.when(F.col("author") != "", F.col("_author")).otherwise(F.col("author"))
    return cleaned.withColumn("author", author).drop("_author")


def dataset_counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), (F.count("*") == 0).alias("is_empty"))


def limit_articles(df: DataFrame, n: int | None, order: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows; None and 0 mean all, a negative number means none.

    Rows are ordered by url, fetch time and a hash of the whole row, nulls first; an
    ``order`` that is given must be total. Only these keys are ranked, ``n`` of them, when
    the result is asked for; the rows are then filtered in place, so they stay in as many partitions as they were.
    Rows equal in all keys are copies, and as many of them are given as still fit.
    """
    if not n:
        return df
    if n < 0:
        return df.limit(0)
    if order is None:
        whole = F.xxhash64(F.to_json(F.struct(*df.columns)))
        times = [F.col("fetched_at")] if "fetched_at" in df.columns else []
        keys = [F.col("url"), *times, whole]
    else:
        keys = [F.col(c) for c in order]
    key = F.struct(*(k.alias(f"k{i}") for i, k in enumerate(keys))).alias("_key")
    firsts = df.select(key).orderBy("_key").limit(n).groupBy("_key").agg(F.count("*").alias("_copies"))
    last = firsts.agg(F.max(F.struct("_key", "_copies"))).scalar()
    keyed = df.select("*", key)
    before = keyed.filter(F.col("_key") < last["_key"])
    one = keyed.filter(F.col("_key") == last["_key"]).limit(1)
    copies = one.withColumn("_copy", F.explode(F.array_repeat(F.lit(True), last["_copies"].cast("int")))).drop("_copy")
    return before.unionByName(copies).drop("_key")


def by_uid(df: DataFrame, uid: str) -> DataFrame:
    """The rows of one article."""
    return df.filter(article_uid("url") == uid)


def _hash_key(id_col: Column | str, seed: int) -> Column:
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), col.cast("string")).cast("binary"))


def _bucket_offsets(keyed: DataFrame) -> DataFrame:
    """Rows before each hash bucket. At most 65,536 rows, so one task may order them."""
    counts = keyed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    return counts.withColumn("_before", F.coalesce(before, F.lit(0)))


def shuffled(df: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """Add ``row_idx``, each row's place in a seeded random order, counted from 0.

    ``id_col`` must be unique; rows without an id are placed by what else they hold, so many of them
    spread like the others. No task sees more than one bucket: the place is the
    number of rows in earlier buckets plus the rank inside the bucket.
    """
    hashed = F.coalesce(_hash_key(id_col, seed), _hash_key(F.to_json(F.struct(*df.columns)), seed))
    keyed = df.withColumn("_hash", hashed).withColumn("_bucket", F.substring("_hash", 1, _BUCKET_HEX))
    offsets = _bucket_offsets(keyed).select("_bucket", "_before")
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", id_col))
    return (
        keyed.withColumn("_rank", rank)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn("row_idx", F.col("_before") + F.col("_rank") - 1)
        .drop("_hash", "_bucket", "_before", "_rank")
    )


def train_test_split(
    df: DataFrame, test_size: float = 0.1, seed: int = 42, id_col: str = "uid", exact: bool = False
) -> DataFrame:
    """Add ``split``, 'test' or 'train'; a frame that has one is returned as it is.

    By default each row is placed by a hash of its id alone: no shuffle, and a row
    keeps its side when others are added. ``exact`` makes the test side hold
    ceil(test_size * n) rows; equal ids stay together, so repeated ids can carry
    it over by the copies of one id.
    """
    if "split" in df.columns:
        return df
    keyed = df.withColumn("_hash", _hash_key(id_col, seed))
    if exact:
        return _exact_split(keyed, test_size, id_col)
    number = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("bigint")
    if 0 < test_size < 0.0001:  # finer than the ten thousand parts below
        is_test = number < F.lit(round(test_size * (1 << 32)))
    else:
        is_test = F.pmod(number, F.lit(10_000)) < F.lit(round(test_size * 10_000))
    return keyed.withColumn("split", _side(is_test)).drop("_hash")


def _exact_split(keyed: DataFrame, test_size: float, id_col: str) -> DataFrame:
    """Find the hash at the cut, then compare every row with it."""
    keyed = keyed.withColumn("_bucket", F.substring("_hash", 1, _BUCKET_HEX))
    offsets = _bucket_offsets(keyed)
    # test_size is a decimal as written: 0.1 of 10 rows is 1 row, not 2
    wanted = F.ceil(F.lit(str(test_size)).cast("decimal(12,10)") * F.sum("_size").over(Window.partitionBy()))
    cut = (
        offsets.withColumn("_wanted", wanted)
        .filter((F.col("_before") < F.col("_wanted")) & (F.col("_before") + F.col("_size") >= F.col("_wanted")))
        .select("_bucket", (F.col("_wanted") - F.col("_before")).alias("_inside"))
    )
    # Copies are counted before they are ordered, so the one bucket that is
    # ordered here holds its distinct hashes only.
    running = F.sum("_copies").over(Window.partitionBy("_bucket").orderBy("_hash"))
    last = (
        keyed.join(F.broadcast(cut), "_bucket")
        .groupBy("_bucket", "_inside", "_hash")
        .agg(F.count("*").alias("_copies"))
        .withColumn("_running", running)
        .filter(F.col("_running") >= F.col("_inside"))
        .agg(F.min("_hash"))
        .scalar()
    )
    is_test = F.coalesce(F.col("_hash") <= last, F.lit(False))
    return keyed.withColumn("split", _side(is_test)).drop("_hash", "_bucket")


def _side(is_test: Column) -> Column:
    return F.when(is_test, "test").otherwise("train")

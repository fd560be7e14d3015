"""Sharding by a two-pass external shuffle.

Pass one scatters every record into a bucket by a seeded hash; there are as many buckets
as it takes for one to fit in a task's memory. Pass two shuffles each bucket by
Fisher-Yates and writes it. Buckets follow each other, so a record's rank is the number
of records in earlier buckets plus its place in its own, and a shard is an even share of
the ranks. Native functions only: ``shuffle`` draws the permutation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import fresh

SHARDS = 40
SEED = 42
BUCKET_BYTES = 32 << 20
ROW_BYTES = 16


def row_size(text_col: str = "text"):
    """UTF-8 bytes of the text, none if null, and a constant for the rest of the row."""
    return F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + ROW_BYTES


def external_shuffle(
    docs: DataFrame,
    rank: str = "rank",
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``docs`` with ``rank``, each record's place in a seeded random order, from 0.

    Nulls hash like any value and repeated rows are records of their own; an empty
    table stays empty. Equal records share a hash, so those that would fill a bucket by
    themselves are found first and dealt over all buckets by their place in the input;
    a bucket passes its bound only by a record that is itself that large. Reading the input
    again must give the same order, as files and stored tables do.
    """
    digest, salt, bucket, place, record, before = fresh(docs, "digest", "salt", "bucket", "place", "record", "before")
    total = docs.agg(F.sum(row_size(text_col))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    keyed = docs.withColumn(digest, F.xxhash64(F.lit(seed), id_col, text_col))
    if buckets > 1:
        # each holds a quarter of a bucket or more: at most 4 * buckets rows are broadcast
        heavy = keyed.groupBy(digest).agg(F.sum(row_size(text_col)).alias(salt)).filter(F.col(salt) * 4 > bucket_bytes)
        keyed = keyed.withColumn(place, F.monotonically_increasing_id()).join(F.broadcast(heavy), digest, "left")
        salted = F.xxhash64(F.lit(seed), digest, F.when(F.col(salt).isNotNull(), F.col(place)))
    else:
        salted = F.lit(0)
    scattered = keyed.withColumn(bucket, F.pmod(salted, F.lit(buckets)).cast("int"))

    # one row per bucket
    sizes = scattered.groupBy(bucket).agg(F.count("*").alias(before))
    earlier = F.sum(before).over(Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(bucket, F.coalesce(earlier, F.lit(0)).alias(before))

    held = F.collect_list(F.struct(*docs.columns)).alias(record)
    gathered = scattered.repartitionById(buckets, F.col(bucket)).sortWithinPartitions(bucket, digest).groupBy(bucket).agg(held)
    drawn = gathered.select(bucket, F.posexplode(F.shuffle(record, F.lit(seed))).alias(place, record))
    return drawn.join(F.broadcast(offsets), bucket).select(
        *(F.col(f"{record}.{c}").alias(c) for c in docs.columns), (F.col(before) + F.col(place)).alias(rank)
    )


def shuffle_into_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``: counts of the shards differ by one at most.

    The first ``n % shards`` shards hold one record more. With fewer records than shards
    the last shards are empty.
    """
    (rank,) = fresh(docs, "rank")
    n = docs.count()
    each, more = divmod(n, shards)
    at = F.col(rank)
    long_ones = F.lit(more * (each + 1))
    in_long = at < long_ones
    shard = F.when(in_long, F.floor(at / (each + 1))).otherwise(more + F.floor((at - long_ones) / max(each, 1)))
    slot = F.when(in_long, at % (each + 1)).otherwise((at - long_ones) % max(each, 1))
    ranked = external_shuffle(docs, rank, id_col, text_col, seed, bucket_bytes)
    return ranked.select(*docs.columns, shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard. Ranks of a task follow each other, so it opens few files."""
    sharded.write.mode("overwrite").partitionBy("shard").parquet(path)

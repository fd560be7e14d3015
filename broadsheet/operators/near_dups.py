"""Near-duplicate articles: an exact similarity join of word shingles.

Texts equal but for case and white space are one class, so a text that a third of all rows share is
compared once. Two sets of n shingles with a similarity of ``pct`` percent share at
least ceil(pct * n / 100) of them. So if all sets are sorted alike, each pair has a shingle in common among the first
n - ceil(pct * n / 100) + 1 of both: only these leave the row. Any order will do for that; here frequent shingles come
last, so far as counts by hash bucket tell. Candidates go whose sizes, places of the shingle that met, or
histograms rule them out, and what is left is compared on whole sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The similarity, in percent, and the words of a shingle.
PERCENT = 85
WORDS = 3
# Shingles are counted in so many buckets, which order them; results do not depend on it.
BUCKETS = 1 << 20
_BLOCK = 1 << 10
# Hash classes of the histograms that candidates are compared by first; a power of two.
CELLS = 64


def words_of(text: Column | str) -> Column:
    """Lower-cased words between ASCII white space; a null text has none."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[^ \t\n\x0B\f\r]+"), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def word_shingles(words: str, size: int = WORDS) -> Column:
    """The distinct runs of ``size`` words as 64-bit hashes; of fewer words, all of them are one run."""
    n = F.size(words)
    runs = F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(size))))
    return (
        F.when(n == 0, F.array().cast("array<bigint>"))
        .when(n < size, F.array(F.xxhash64(F.array_join(words, " "))))
        .otherwise(F.array_distinct(runs))
    )


def _classes(df: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(key, id, n, shingles): one row per text that differs in its words, under its smallest id."""
    normal = F.array_join(words_of(text_col), " ").alias("normal")
    texts = df.select(F.col(id_col).alias("id"), normal).filter(F.col("normal") != "").withColumn("key", _key("normal"))
    # a test that joins would add to their side only, which then were shuffled by itself
    texts = texts.filter(F.col("key").isNotNull())
    # one value, so that every use reads all of it and Spark shuffles the texts once; null ids come last
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "normal")).alias("least")
    folded = texts.groupBy("key").agg(least).select("key", "least.id", "least.normal")
    # a column of its own: inside the expression the text would be split once for every shingle
    split = folded.select("key", "id", F.split("normal", " ").alias("words"))
    sets = split.select("key", "id", word_shingles("words", size).alias("shingles"))
    return sets.withColumn("n", F.size("shingles"))


def _key(normal: str) -> Column:
    return F.unhex(F.md5(F.col(normal).cast("binary")))


def _levels(sets: DataFrame) -> Column:
    """An array: four times the binary logarithm of how often shingles of each bucket occur, plus one."""
    met = sets.select(F.explode("shingles").alias("shingle")).select(F.col("shingle").bitwiseAND(BUCKETS - 1).alias("bucket"))
    every = sets.sparkSession.range(BUCKETS).select(F.col("id").alias("bucket"))
    counts = met.unionByName(every).groupBy("bucket").agg(F.count("*").alias("n"))
    level = F.floor(F.log2("n") * 4).cast("tinyint").alias("level")
    in_order = lambda at, name: F.transform(F.sort_array(F.collect_list(F.struct(at, name))), lambda s: s[name])
    blocks = counts.select("bucket", level).groupBy(F.floor(F.col("bucket") / _BLOCK).alias("block")).agg(in_order("bucket", "level").alias("levels"))
    return blocks.agg(F.flatten(in_order("block", "levels"))).scalar()


def _prefixes(sets: DataFrame, pct: int) -> DataFrame:
    """(shingle, key, n, place): the first shingles of each class, as far as its prefix goes, that others post too.

    A shingle is its level and 56 bits of its hash, in this order. Should two of a set be the same, they are posted
    twice, which loses no pair.
    """
    level = lambda s: F.get("levels", s.bitwiseAND(BUCKETS - 1).cast("int")).cast("bigint")
    ranked = F.sort_array(F.transform("shingles", lambda s: F.shiftleft(level(s), 56).bitwiseOR(F.shiftrightunsigned(s, 8))))
    room = F.col("n") - F.floor((F.col("n") * pct + 99) / 100).cast("int") + 1
    posted = sets.withColumn("levels", _levels(sets)).select("key", "n", F.posexplode(F.slice(ranked, 1, room)).alias("place", "shingle"))
    return posted.withColumn("posts", F.count("*").over(Window.partitionBy("shingle"))).filter("posts > 1").drop("posts")


def _class_pairs(sets: DataFrame, pct: int) -> DataFrame:
    """(key_a, key_b, id_a, id_b, n_common, n_all) of similar classes, each pair once."""
    prefixes = _prefixes(sets, pct)
    one, other = (prefixes.select("shingle", *(F.col(c).alias(f"{c}_{x}") for c in ("key", "n", "place"))) for x in "ab")
    near = (F.col("n_a") * 100 >= F.col("n_b") * pct) & (F.col("n_b") * 100 >= F.col("n_a") * pct)
    # behind the first shingle that two sets share there must be room for the others
    most = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    room = most * (100 + pct) >= (F.col("n_a") + F.col("n_b")) * pct
    met = one.join(other, "shingle").filter((F.col("key_a") < F.col("key_b")) & near & room).select("key_a", "key_b").distinct()
    met = _not_far(met, sets, pct)
    for x in "ab":
        met = met.join(sets.select(F.col("key").alias(f"key_{x}"), F.col("id").alias(f"id_{x}"), F.col("shingles").alias(f"set_{x}")), f"key_{x}")
    common = F.size(F.array_intersect("set_a", "set_b"))
    sized = met.select("key_a", "key_b", "id_a", "id_b", common.alias("n_common"), (F.size("set_a") + F.size("set_b")).alias("both"))
    sized = sized.withColumn("n_all", F.col("both") - F.col("n_common"))
    return sized.filter(F.col("n_common") * 100 >= F.col("n_all") * pct).drop("both")


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _histogram(sets: pa.Array) -> pa.Array:
    """How many shingles of a set fall into each of ``CELLS`` hash classes; of a batch of sets at once."""
    rows = np.repeat(np.arange(len(sets)), pc.list_value_length(sets).to_numpy(zero_copy_only=False))
    cells = rows * CELLS + (sets.flatten().to_numpy(zero_copy_only=False) & (CELLS - 1))
    counts = pa.array(np.bincount(cells, minlength=len(sets) * CELLS).astype(np.int32))
    return pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * CELLS), counts)


def _not_far(met: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """The candidates (key_a, key_b) whose histograms do not rule them out, so that few whole sets travel.

    Histograms differ by at most as many shingles as the sets do, and similar sets by
    (100 - pct) / (100 + pct) of both sizes.
    """
    cells = sets.select("key", _histogram("shingles").alias("cells")).repartition("key")
    for x in "ab":
        met = met.join(cells.select(F.col("key").alias(f"key_{x}"), F.col("cells").alias(f"cells_{x}")), f"key_{x}")
    total = lambda col: F.aggregate(col, F.lit(0).cast("bigint"), lambda n, x: n + x)
    apart = total(F.zip_with("cells_a", "cells_b", lambda x, y: F.abs(x - y).cast("bigint")))
    both = total(F.concat("cells_a", "cells_b"))
    return met.filter(apart * (100 + pct) <= both * (100 - pct)).select("key_a", "key_b")


def near_dup_pairs(df: DataFrame, pct: int = PERCENT, id_col: str = "doc_id", text_col: str = "body", size: int = WORDS) -> DataFrame:
    """(id_a, id_b, n_common, n_all): similar texts under the smallest id that has each, ``id_a`` the smaller.

    ``near_dup_classes`` tells which rows have the same text. A text without a word is like no other. Texts
    that only rows without an id have are left out, since nothing could name them.
    """
    _checked(pct)
    pairs = _class_pairs(_classes(df, id_col, text_col, size), pct)
    return pairs.filter(F.col("id_a").isNotNull() & F.col("id_b").isNotNull()).select(
        F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), F.col("n_common").cast("bigint"), F.col("n_all").cast("bigint")
    )


def near_dup_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "body") -> DataFrame:
    """(id, class_id): the smallest id with the same words, for each row of ``df`` that has any."""
    normal = F.array_join(words_of(text_col), " ").alias("normal")
    rows = df.select(F.col(id_col).alias("id"), normal).filter(F.col("normal") != "").select("id", _key("normal").alias("key"))
    firsts = rows.groupBy("key").agg(F.min("id").alias("class_id"))
    return rows.join(firsts, "key").select(F.col("id").alias(id_col), "class_id")


def near_dedup(df: DataFrame, pct: int = PERCENT, id_col: str = "doc_id", text_col: str = "body", size: int = WORDS) -> DataFrame:
    """The rows of ``df`` without a similar one of a smaller id; all their columns, in place.

    Rows without a word stay. A row without an id is later than all that have one. Rows of
    one id are one article and go or stay together.
    """
    _checked(pct)
    sets = _classes(df, id_col, text_col, size)
    pairs = _class_pairs(sets, pct)
    both_ways = F.array(*(F.struct(F.col(f"key_{x}").alias("key"), F.col(f"id_{y}").alias("other")) for x, y in ("ab", "ba")))
    met = pairs.select(F.inline(both_ways))
    # min ignores nulls: the first of the class itself and of the classes like it
    firsts = sets.select("key", F.col("id").alias("other")).unionByName(met).groupBy("key").agg(F.min("other").alias("_first"))
    key = _key("_normal")
    keyed = df.withColumn("_normal", F.array_join(words_of(text_col), " ")).withColumn("_key", F.when(F.col("_normal") != "", key))
    found = keyed.drop("_normal").join(firsts.withColumnRenamed("key", "_key"), "_key", "left")
    earlier = F.col("_first").isNotNull() & (F.col(id_col).isNull() | (F.col("_first") < F.col(id_col)))
    return found.filter(~earlier).select(*df.columns)


def _checked(pct: int) -> None:
    if not 0 < pct <= 100:
        raise ValueError("pct must be in 1..100")

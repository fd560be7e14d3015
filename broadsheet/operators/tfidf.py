"""Vocabulary and TF-IDF weights as tables.

Terms of a document are counted inside its row, so no shuffle carries the text:
the vocabulary shuffles one pre-aggregated row per term and map task, and the
weights shuffle numbers of vocabulary terms only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A vocabulary of at most so many terms is picked in one task.
ONE_TASK_TERMS = 1_000_000
_PREFIX = 3


def doc_terms(tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, term, tf) of terms of two letters or more, each row's by itself."""
    return tokens.select(id_col, F.inline(_counted("tokens")))


@F.arrow_udf(T.ArrayType(T.StructType().add("term", "string").add("tf", "long")))
def _counted(lists: pa.Array) -> pa.Array:
    """The distinct terms of each list and how often it has them; a batch of lists is counted at once."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    words = lists.flatten()
    long = pc.fill_null(pc.greater_equal(pc.utf8_length(words), 2), False)
    rows = np.repeat(np.arange(len(lists)), sizes)[long.to_numpy(zero_copy_only=False)]
    coded = words.filter(long).dictionary_encode()
    n_terms = max(1, len(coded.dictionary))
    cells, tf = np.unique(rows * n_terms + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
    ends = np.searchsorted(cells, np.arange(len(lists) + 1) * n_terms).astype(np.int32)
    counted = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(cells % n_terms)), pa.array(tf, pa.int64())], ["term", "tf"])
    return pa.ListArray.from_arrays(pa.array(ends), counted)


def term_stats(tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Document frequency and corpus frequency of every term."""
    return doc_terms(tokens, id_col).groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("tf_total"))


def fit_vocab(tokens: DataFrame, k: int = 5000, id_col: str = "doc_id") -> DataFrame:
    """The ``k`` most frequent terms with index and idf.

    Ties go to the term that sorts first; indexes follow alphabetical order. The
    document count includes documents without any term.
    """
    if k <= 0:
        raise ValueError("vocabulary size must be positive")
    n_docs = tokens.agg(F.count("*")).scalar()
    stats = term_stats(tokens, id_col)
    if k <= ONE_TASK_TERMS:
        # at most k rows, in one task already: ranked where they are, so that terms are counted once
        top = stats.orderBy(F.desc("tf_total"), "term").limit(k)
        ranked = top.withColumn("_rank", F.row_number().over(Window.orderBy("term")).cast("bigint") - 1)
    else:
        ranked = _ranked(_most_frequent(stats, k))
    return ranked.select(
        "term",
        F.col("_rank").alias("term_idx"),
        "df",
        "tf_total",
        (F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("idf"),
    )


def _ranked(terms: DataFrame) -> DataFrame:
    """Add ``_rank``, each term's place in alphabetical order from 0, without one task for all.

    Terms are ranked among those with the same first letters, behind the terms of
    earlier letters; only one count per beginning is summed in one place.
    """
    cut = terms.withColumn("_prefix", F.substring("term", 1, _PREFIX))
    sizes = cut.groupBy("_prefix").agg(F.count("*").alias("_size"))
    earlier = F.sum("_size").over(Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1))
    before = sizes.select("_prefix", F.coalesce(earlier, F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_prefix").orderBy("term"))
    ranked = cut.withColumn("_inside", inside).join(before, "_prefix")
    return ranked.withColumn("_rank", F.col("_before") + F.col("_inside") - 1).drop("_prefix", "_inside", "_before")


def _most_frequent(stats: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent terms by a cut on the frequency; one count per frequency is summed in one place."""
    sizes = stats.groupBy("tf_total").agg(F.count("*").alias("_size"))
    higher = F.sum("_size").over(Window.orderBy(F.desc("tf_total")).rowsBetween(Window.unboundedPreceding, -1))
    placed = sizes.withColumn("_before", F.coalesce(higher, F.lit(0)))
    last = placed.filter((F.col("_before") < k) & (F.col("_before") + F.col("_size") >= k)).first()
    if last is None:
        return stats
    ties = _ranked(stats.filter(F.col("tf_total") == last.tf_total)).filter(F.col("_rank") < k - last["_before"]).drop("_rank")
    return stats.filter(F.col("tf_total") > last.tf_total).unionByName(ties)


def tfidf(tokens: DataFrame, vocab: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, term_idx, weight), each document's weights of unit length.

    ``vocab`` comes from ``fit_vocab`` or was saved from it. Spark sends it to every
    executor if it is as small as it should be, and else joins by shuffle.
    """
    lookup = vocab.select("term", "term_idx", "idf")
    found = doc_terms(tokens, id_col).join(lookup, "term")
    weighted = found.select(id_col, "term_idx", (F.col("tf") * F.col("idf")).alias("_w"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_col)))
    return weighted.select(id_col, "term_idx", (F.col("_w") / norm).alias("weight"))

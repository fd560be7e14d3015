"""Token columns of the labelled corpus."""

from __future__ import annotations

import string
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The purely alphabetic English stop words of Spark's own
# StopWordsRemover. Pass another list to use another library's.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs themselves
what which who whom this that these those am is are was were be been being have
has had having do does did doing a an the and but if or because as until while
of at by for with about against between into through during before after above
below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor
not only own same so than too very s t can will just don should now could would
cannot ought
""".split()

# UTF-8 of what lower-cases to an ASCII letter, and of white space beyond ASCII (as Python counts it).
_TO_ASCII = {"\u0130": b"i", "\u212a": b"k"} | dict.fromkeys("\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B))), b" ")
_TO_ASCII = [(char.encode(), plain) for char, plain in _TO_ASCII.items()]
_SPACE = b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
_LOWER = bytes.maketrans(string.ascii_uppercase.encode() + _SPACE, string.ascii_lowercase.encode() + b" " * len(_SPACE))
_DROPPED = bytes(set(range(256)) - set(string.ascii_letters.encode()) - set(string.digits.encode()) - set(_SPACE))


def tokens_of(text: Column | str, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Purely alphabetic words of a cleaned text, stop words left out, in order."""
    words = F.split(F.col(text) if isinstance(text, str) else text, " ")
    stop = list(stop_words)
    return F.filter(words, lambda w: w.rlike("^[a-z]+$") & ~w.isin(stop))


def clean_tokens(text: Column | str, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """``tokens_of(corpus_clean(text))`` in one pass over the text's bytes; a null text gives null."""
    stop = pa.array(sorted(set(stop_words)), pa.string())

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def run(texts: pa.Array) -> pa.Array:
        cleaned = pa.array([_cleaned(t) for t in texts.cast(pa.binary()).to_pylist()], pa.binary())
        pieces = pc.split_pattern(cleaned.cast(pa.string()), " ")
        words = pieces.flatten()
        kept = pc.and_(pc.ascii_is_alpha(words), pc.invert(pc.is_in(words, stop)))
        before = np.concatenate(([0], np.cumsum(kept.to_numpy(zero_copy_only=False), dtype=np.int32))).astype(np.int32)
        ends = before[pieces.offsets.to_numpy() - pieces.offsets[0].as_py()]
        return pa.ListArray.from_arrays(pa.array(ends), words.filter(kept), mask=texts.is_null())

    return run(text)


def _cleaned(text: bytes | None) -> bytes:
    """Lower-case ASCII letters, digits and single-byte spaces of a UTF-8 text; runs of spaces stay."""
    if text is None:
        return b""
    if not text.isascii():
        for char, plain in _TO_ASCII:
            text = text.replace(char, plain)
    return text.translate(_LOWER, _DROPPED)


def corpus_tokens(df: DataFrame, stop_words: Iterable[str] = STOP_WORDS, lemma: DataFrame | None = None) -> DataFrame:
    """Clean ``text`` and add its ``tokens``; with a lemma table, as base forms."""
    tokens = df.withColumn("tokens", clean_tokens("text", stop_words))
    return tokens if lemma is None else lemmatize(tokens, lemma)


def lemmatize(df: DataFrame, lemma: DataFrame) -> DataFrame:
    """Replace each token by its ``lemma`` where the (term, lemma) table has one.

    Lists of tokens are looked up, not rows: copies of a list share one entry, so ids may repeat or be
    null and need not exist. Null tokens, and a null list, stay what they are; of several lemmas of a term
    the one that sorts first is taken. All other columns stay.
    """
    key = [F.xxhash64("tokens").alias("_key_a"), F.xxhash64(F.lit(1), "tokens").alias("_key_b")]
    # of an expression, not of the column itself: Spark would push a test of the
    # column's size to the scan and tokenise there a second time
    distinct = F.filter(F.array_distinct("tokens"), lambda t: t.isNotNull())
    forms = lemma.filter(F.col("lemma").isNotNull()).groupBy("term").agg(F.min("lemma").alias("lemma"))
    # words without a lemma end in this join, whichever way Spark does it
    keyed = df.select("*", *key)
    # keys are columns by then: in one step with the explode they would be taken once for every token
    found = keyed.select("_key_a", "_key_b", F.explode(distinct).alias("term")).join(forms, "term")
    # a set: each map task sends the entries of a list once, however many copies it has read
    entries = F.map_from_entries(F.collect_set(F.struct("term", "lemma"))).alias("_forms")
    kept = keyed.join(found.groupBy("_key_a", "_key_b").agg(entries), ["_key_a", "_key_b"], "left")
    base = F.transform("tokens", lambda t: F.coalesce(F.try_element_at("_forms", t), t))
    lemmas = F.when(F.col("_forms").isNull(), F.col("tokens")).otherwise(base)
    return kept.withColumn("tokens", lemmas).select(*df.columns)


def processed_text(tokens: Column | str = "tokens") -> Column:
    """Tokens joined by single spaces."""
    return F.array_join(tokens, " ")

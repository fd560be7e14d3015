"""Packing by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are the powers of two that add up to
its length: as many of the longest as fit, then each binary digit once, longest first.
Every piece is a sequence of its own, so no sequence crosses documents and none needs
padding; ``bucket`` is its length, and batches are drawn from one bucket.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from broadsheet.llm.common import utf8

SEQUENCE = 2048
END_ID = 1
PIECE = "start long, length long, ids array<int>, ids_crc32 long, doc_tokens long"
_IDS = "ids array<int>, "
# Words kept with their ids in a worker, bytes of text looked up at a time, and new words encoded as one text.
CACHED_WORDS = 400_000
_TEXT_BYTES = 4 << 20
_PART_WORDS = 1 << 12
_LONGEST_FIRST = 64


def piece_lengths(n: int, longest: int = SEQUENCE) -> list[int]:
    """Powers of two of at most ``longest`` that add up to ``n``, longest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


class WordTokenizer:
    """Ids of whole texts by a byte-level BPE, each different word encoded once.

    The tokenizer never joins a space with a character before it, so a text may be cut
    before each space that follows something else than white space; the ids of the parts are
    the ids of the text. Texts where a space follows white space are encoded whole, and so
    are those that hold the name of an added token, unless special ones are plain text.
    """

    def __init__(self, path: str, cached_words: int = CACHED_WORDS, encode_special_tokens: bool = True):
        self.tokenizer = Tokenizer.from_file(path)
        # whether the names of special tokens in a text are plain text
        self.tokenizer.encode_special_tokens = encode_special_tokens
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added if not (t.special and encode_special_tokens)]
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for word, i in vocabulary.items() if word.startswith("Ġ")]] = True
        self.cached_words = cached_words
        self._clear()

    def _clear(self) -> None:
        self.words: dict[str, int] = {}
        self.firsts: dict[str, np.ndarray] = {}
        self.ids, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)
        # in how many calls a word was met
        self.met = np.empty(0, np.int32)

    def _forget(self) -> None:
        """Drop the words that were met once, and the rarer ones of the rest if they are too many."""
        words, sizes = list(self.words), np.diff(self.ends)
        kept = np.argsort(-self.met, kind="stable")[: self.cached_words // 2]
        kept = np.sort(kept[self.met[kept] > 1])
        ids = self.ids[_ranges(self.ends[kept], sizes[kept])]
        self._clear()
        self.words = {words[i]: n for n, i in enumerate(kept.tolist())}
        self.ids, self.ends = ids, np.concatenate(([0], np.cumsum(sizes[kept])))
        self.met = np.ones(len(kept), np.int32)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)

    def encode_many(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """The ids of each text; none may be null."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not len(texts):
            return []
        if len(self.words) + len(self.firsts) > self.cached_words:
            self._forget()
        split = pc.split_pattern(texts, " ")
        ends = split.offsets.to_numpy()
        coded = split.values.dictionary_encode()
        word, distinct = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = np.fromiter(map(self.words.get, distinct, repeat(-1)), np.int64, len(distinct))
        unknown = np.flatnonzero(number < 0)
        # an empty word or white space at its end, which no known word has: a space behind white space
        spaced = np.zeros(len(distinct), bool)
        spaced[unknown] = [not distinct[i] or distinct[i][-1].isspace() for i in unknown.tolist()]
        whole = np.logical_or.reduceat(spaced[word], ends[:-1])
        for name in self.added:
            whole |= pc.match_substring(texts, name).to_numpy(zero_copy_only=False)
        behind = np.repeat(~whole, np.diff(ends))
        behind[ends[:-1]] = False
        needed = np.zeros(len(distinct), bool)
        needed[word[behind]] = True
        missing = np.flatnonzero(needed & (number < 0))
        number[missing] = len(self.words) + np.arange(len(missing))
        self._learn([distinct[i] for i in missing.tolist()])
        self.met[number[needed]] += 1

        # ids of all words behind a first one, text after text
        own = number[word[behind]]
        sizes = self.ends[own + 1] - self.ends[own]
        ids = self.ids[_ranges(self.ends[own], sizes)]
        upto = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(behind)))[ends]].tolist()
        firsts = word[ends[:-1]].tolist()
        return [
            self.encode(texts[i].as_py()) if whole[i] else np.concatenate((self._first(distinct[firsts[i]]), ids[upto[i] : upto[i + 1]]))
            for i in range(len(texts))
        ]

    def _first(self, word: str) -> np.ndarray:
        found = self.firsts.get(word)
        if found is None:
            found = self.encode(word)
            if len(word) <= _LONGEST_FIRST:
                self.firsts[word] = found
        return found

    def _learn(self, words: list[str]) -> None:
        """Encode words, each behind a space, many in one text; a new word's first id opens with a space."""
        parts = [words[at : at + _PART_WORDS] for at in range(0, len(words), _PART_WORDS)]
        found = self.tokenizer.encode_batch_fast([" " + " ".join(p) for p in parts], add_special_tokens=False)
        ids, ends = [self.ids], [self.ends]
        last = int(self.ends[-1])
        for part, encoding in zip(parts, found):
            new = np.array(encoding.ids, np.int32)
            opening = np.flatnonzero(self.opens[new])
            if len(opening) != len(part):
                raise ValueError("the tokenizer joins a space with what stands before it")
            ends.append(last + np.append(opening[1:], len(new)))
            ids.append(new)
            last += len(new)
        known = len(self.words)
        self.words.update(zip(words, range(known, known + len(words))))
        self.ids, self.ends = np.concatenate(ids), np.concatenate(ends)
        self.met = np.append(self.met, np.zeros(len(words), np.int32))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``starts[i]``, ``starts[i] + 1`` and so on, ``sizes[i]`` of them, for each ``i`` in turn."""
    behind = np.cumsum(sizes)
    return np.arange(behind[-1] if len(behind) else 0) + np.repeat(starts - behind + sizes, sizes)


@lru_cache(maxsize=1)
def word_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer as its file gives it: the name of an added token is that token.

    A task has one core, so words are encoded in its own thread: threads of the tokenizer's
    own make it no faster and each holds on to memory as long as the worker lives.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordTokenizer(path, encode_special_tokens=False)


def pack_power_of_two(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """(id, start, length, ids, ids_crc32, doc_tokens, bucket, sequence_id, offset) per piece; ``ids`` only if asked for.

    ``tokenizer`` is the path of a byte-level BPE file that every executor has. A null text
    is an empty one: its only id is ``end_id``. Repeated rows are packed each by itself, null ids
    stay null, an empty table gives no pieces. ``sequence_id`` numbers pieces within the
    partition they are made in, so nothing is shuffled; ``offset`` is always 0.
    """
    if sequence < 1 or sequence & (sequence - 1):
        raise ValueError("a sequence's length must be a power of two")

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokenizer(tokenizer)
        try:
            for batch in batches:
                for at, texts in _slices(batch.column("text")):
                    yield from _pieces(batch.column("id"), at, encoder.encode_many(texts), sequence, end_id, with_ids)
        finally:
            # the worker lives on, beside those of later stages
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    pieces = rows.mapInArrow(cut_up, f"id {kind}, {PIECE if with_ids else PIECE.replace(_IDS, '')}")
    return pieces.select(
        F.col("id").alias(id_col),
        "start",
        "length",
        *(["ids"] if with_ids else []),
        "ids_crc32",
        "doc_tokens",
        F.col("length").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def _slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Texts in slices of bounded size: (number of the first, texts). A null text is empty, bytes that are no UTF-8 are replaced."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    first, size = 0, 0
    for i, n in enumerate(sizes.tolist(), 1):
        size += n
        if size > _TEXT_BYTES or i == len(sizes):
            yield first, _valid(texts.slice(first, i - first))
            first, size = i, 0


def _valid(texts: pa.Array) -> pa.Array:
    try:
        texts.validate(full=True)
    except pa.ArrowInvalid:
        texts = pa.array([(t.as_py() or b"").decode("utf-8", "replace") for t in utf8(texts)], texts.type)
    return pc.fill_null(texts, "")


def _pieces(ids: pa.Array, at: int, encoded: list[np.ndarray], sequence: int, end_id: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    doc, start, length, crc, tokens, all_ids = [], [], [], [], [], []
    for i, found in enumerate(encoded, at):
        own = np.append(found, np.int32(end_id))
        data, here = own.astype("<u4").tobytes(), 0
        for n in piece_lengths(len(own), sequence):
            doc.append(i)
            start.append(here)
            length.append(n)
            crc.append(zlib.crc32(data[4 * here : 4 * (here + n)]))
            tokens.append(len(own))
            here += n
        if with_ids:
            all_ids.append(own)
    if not doc:
        return
    columns = {"id": ids.take(pa.array(doc)), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64())}
    if with_ids:
        ends = pa.array(np.concatenate(([0], np.cumsum(length))).astype(np.int32))
        columns["ids"] = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(all_ids).astype(np.int32)))
    columns |= {"ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": pa.array(tokens, pa.int64())}
    yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder per piece length, so that a reader's batches need no padding."""
    pieces.write.mode("overwrite").partitionBy("bucket").parquet(path)

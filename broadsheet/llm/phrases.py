"""Phrase collocations, counted in quotient filters.

1. Every word is a number: the first bits of a 64-bit hash, under a seed for which no two words of
   the corpus share one. That is tested over all words, so the number stands for the word.
2. The n-grams of a task are counted as packed word numbers. An invertible permutation spreads
   them; its leading bits choose a shard, the next are the quotient, all others the remainder.
   A sorted filter holds runs of quotients as one bit string, whole remainders, and counters of one byte
   that spill where they must: compact, and nothing is lost.
3. A shard merges the sorted filters of all tasks. Shards are even however frequent a phrase is,
   and a task sends one counter of it.
4. Sizes are counted one after the other. A phrase can reach the bound only if both phrases one
   word shorter did, so positions are tested in a bit set of those first. The bit set has a fixed
   greatest size; chance hits in it cost counters, not results.

Scores, covered phrases and ranks are joins of the frequent phrases, which are few.
"""

from __future__ import annotations

import re
import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import cut, utf8

LONGEST = 4
LEAST = 30
TOP = 2000
COVERED_PERCENT = 80
SCALE = 2_000_000
UNKNOWN = "und"

# A task holds so many rows before it counts or sends them; a bit set has at most so many bits.
HELD_ROWS = 1 << 20
MOST_BITS = 28
_LEAST_SHARD_BITS, _MOST_SHARD_BITS, _SHARD_WORDS = 7, 20, 1 << 21

_BLOCK = 1 << 20
_BREAK = b"\xff"  # never in UTF-8
_BORDER = re.compile(rb"[ \t\n\r\x0b\x0c.,;:!?]")
_FOLD = bytes(
    0xFF if c in b".,;:!?\n\r\x0b\x0c" else 0x20 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256)
)


# -- words and their numbers ------------------------------------------------


def word_blocks(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Lower-cased words in order, with a break between pieces and behind each text.

    A block has about a megabyte of text; a long text goes on in the next one.
    """
    held, size = [], 0
    for text in texts:
        at = 0
        while at < len(text):
            end = at + _BLOCK
            if end < len(text):
                border = _BORDER.search(text, end)
                end = border.start() if border else len(text)
            held.append(text[at:end])
            size += len(held[-1])
            at = end
            if size >= _BLOCK:
                last = _BREAK if at >= len(text) else b""
                yield _split(b"".join(held) + last)
                held, size = [], 0
        if held:
            held.append(b".")
    if held:
        yield _split(b"".join(held))


def _split(data: bytes) -> list[bytes]:
    return data.translate(_FOLD).replace(_BREAK, b" \xff ").split()


def word_seed(seed: int) -> int:
    """The seed of the hash of a word in ``word_number``, and in Spark of ``xxhash64(seed, word)``."""
    return xxhash.xxh64_intdigest(struct.pack("<q", seed), 42)


class Numbers(dict):
    """Word numbers of ``width`` bits, remembered; a break is 0."""

    def __init__(self, seed: int, width: int):
        super().__init__()
        self.seed, self.shift = word_seed(seed), 64 - width

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        number = 0 if word == _BREAK else xxhash.xxh64_intdigest(word, self.seed) >> self.shift
        self[word] = number
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def by_language(batch: pa.RecordBatch) -> dict[str, list[bytes]]:
    out: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), utf8(batch.column("text"))):
        out.setdefault(lang, []).append(text.as_py())
    return out


def count_words(rows: DataFrame) -> DataFrame:
    """(lang, word, n) of all words; a task adds up its own before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        for batch in batches:
            for lang, texts in by_language(batch).items():
                own = held.setdefault(lang, Counter())
                for words in word_blocks(texts):
                    own.update(words)
                del own[_BREAK]
            if sum(map(len, held.values())) > HELD_ROWS:
                yield from _word_batches(held)
                held = {}
        yield from _word_batches(held)

    return rows.mapInArrow(run, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _word_batches(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    for lang, own in held.items():
        words = list(own)
        for at in range(0, len(words), 1 << 16):
            some = words[at : at + (1 << 16)]
            columns = [pa.array([lang] * len(some)), pa.array(some, pa.binary()), pa.array([own[w] for w in some], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])


def number_column(word: Column | str, seed: int, width: int) -> Column:
    """``Numbers`` as a column."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed).cast("long"), word), 64 - width)


def choose_numbers(words: DataFrame) -> tuple[int, int]:
    """(seed, width) under which all words have numbers of their own, none of them 0."""
    distinct = words.groupBy("word").agg(F.lit(1).alias("one"))
    bits = 2 * (distinct.count() + 2).bit_length() + 4
    width = min(64, 8 * -(-bits // 8))
    for seed in range(64):
        numbered = distinct.select("word", number_column("word", seed, width).alias("number"))
        shared = numbered.groupBy("number").agg(F.min("word").alias("a"), F.max("word").alias("b"))
        if shared.filter((F.col("a") != F.col("b")) | (F.col("number") == 0)).isEmpty():
            return seed, width
        width = min(64, width + 8 * (seed % 8 == 7))
    raise ValueError("no seed tells the words of this corpus apart")


# -- quotient filters -------------------------------------------------------


def _round(lanes: list[np.ndarray], i: int, mask: np.uint64) -> None:
    h = np.full(len(lanes[0]), 0x9E3779B97F4A7C15 * (i + 1) & (1 << 64) - 1, np.uint64)
    for j, lane in enumerate(lanes):
        if j != i:
            h = (h ^ lane) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
    lanes[i] = lanes[i] ^ (h >> np.uint64(7) & mask)


def permuted(lanes: list[np.ndarray], width: int) -> list[np.ndarray]:
    """Word numbers of n-grams, mixed so that the first is uniform; ``unpermuted`` undoes it."""
    lanes, mask = list(lanes), np.uint64((1 << width) - 1)
    for i in _rounds(len(lanes)):
        _round(lanes, i, mask)
    return lanes


def unpermuted(lanes: list[np.ndarray], width: int) -> list[np.ndarray]:
    lanes, mask = list(lanes), np.uint64((1 << width) - 1)
    for i in reversed(_rounds(len(lanes))):
        _round(lanes, i, mask)
    return lanes


def _rounds(size: int) -> list[int]:
    return [*range(size), *range(size)]


_HEADER = "<IBB"


def write_filter(lanes: list[np.ndarray], counts: np.ndarray, width: int, shard_bits: int) -> bytes:
    """A filter of permuted n-grams of one shard, sorted by their first lane."""
    n = len(counts)
    quotient_bits = min(max(0, n.bit_length() - 1), width - shard_bits)
    rest = width - shard_bits - quotient_bits
    quotient = (lanes[0] >> np.uint64(rest) & np.uint64((1 << quotient_bits) - 1)).astype(np.int64)
    runs = np.zeros(n + (1 << quotient_bits), bool)
    runs[quotient + np.arange(n)] = True
    remainder = lanes[0] & np.uint64((1 << rest) - 1)
    large = counts >= 255
    return b"".join(
        [
            struct.pack(_HEADER, n, quotient_bits, len(lanes)),
            np.packbits(runs).tobytes(),
            _low_bytes(remainder, -(-rest // 8)),
            *(_low_bytes(lane, width // 8) for lane in lanes[1:]),
            np.where(large, 255, counts).astype(np.uint8).tobytes(),
            counts[large].astype("<u8").tobytes(),
        ]
    )


def read_filter(data: bytes, width: int, shard_bits: int, shard: int) -> tuple[list[np.ndarray], np.ndarray]:
    n, quotient_bits, size = struct.unpack_from(_HEADER, data)
    rest, at = width - shard_bits - quotient_bits, struct.calcsize(_HEADER)
    slots = n + (1 << quotient_bits)
    view = np.frombuffer(data, np.uint8)
    runs = np.unpackbits(view[at : at + -(-slots // 8)])[:slots]
    at += -(-slots // 8)
    quotient = (np.flatnonzero(runs) - np.arange(n)).astype(np.uint64)
    head = np.uint64(shard << (width - shard_bits)) | quotient << np.uint64(rest)
    lanes = []
    for nbytes in (-(-rest // 8), *[width // 8] * (size - 1)):
        lanes.append(_from_low_bytes(view[at : at + n * nbytes], n, nbytes))
        at += n * nbytes
    lanes[0] = lanes[0] | head
    counts = view[at : at + n].astype(np.int64)
    large = counts == 255
    counts[large] = np.frombuffer(data, "<u8", int(large.sum()), at + n).astype(np.int64)
    return lanes, counts


def _low_bytes(values: np.ndarray, nbytes: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :nbytes]).tobytes()


def _from_low_bytes(data: np.ndarray, n: int, nbytes: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :nbytes] = data.reshape(n, nbytes)
    return out.reshape(-1).view("<u8").astype(np.uint64)


class Counts:
    """N-grams of one size and their numbers of occurrences, added up now and then."""

    def __init__(self, size: int):
        self.names = [f"w{i}" for i in range(size)]
        self.parts: list[pa.Table] = []
        self.rows = self.known = 0

    def add(self, lanes: list[np.ndarray], counts: np.ndarray) -> None:
        self.parts.append(pa.table([*map(pa.array, lanes), pa.array(counts)], [*self.names, "n"]))
        self.rows += len(counts)
        if self.rows > 2 * self.known + HELD_ROWS:
            self.whole()

    def whole(self) -> pa.Table:
        if len(self.parts) > 1 or self.parts and self.rows != self.known:
            summed = pa.concat_tables(self.parts).group_by(self.names, use_threads=False).aggregate([("n", "sum")])
            self.parts = [summed.rename_columns({"n_sum": "n"})]
            self.rows = self.known = summed.num_rows
        return self.parts[0] if self.parts else pa.table({n: pa.array([], pa.uint64()) for n in self.names} | {"n": pa.array([], pa.int64())})

    def arrays(self) -> tuple[list[np.ndarray], np.ndarray]:
        table = self.whole()
        return [table.column(n).to_numpy() for n in self.names], table.column("n").to_numpy()


# -- bit sets of frequent phrases -------------------------------------------


def mark(lang: str, lanes: list[np.ndarray]) -> np.ndarray:
    """A hash of phrases of a language."""
    h = np.full(len(lanes[0]), xxhash.xxh64_intdigest(lang.encode()), np.uint64)
    for lane in lanes:
        h = (h ^ lane) * np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(29)
    return h ^ h >> np.uint64(37)


def to_keys(lanes: list[np.ndarray], width: int) -> pa.Array:
    """Word numbers one behind the other, highest byte first."""
    nbytes, n = width // 8, len(lanes[0])
    data = np.concatenate([lane.astype(">u8").view(np.uint8).reshape(n, 8)[:, 8 - nbytes :] for lane in lanes], axis=1)
    fixed = pa.binary(nbytes * len(lanes))
    return pa.Array.from_buffers(fixed, n, [None, pa.py_buffer(np.ascontiguousarray(data).tobytes())]).cast(pa.binary())


def from_keys(keys: list[bytes], size: int, width: int) -> list[np.ndarray]:
    nbytes = width // 8
    data = np.frombuffer(b"".join(keys), np.uint8).reshape(len(keys), size, nbytes)
    out = np.zeros((len(keys), size, 8), np.uint8)
    out[:, :, 8 - nbytes :] = data
    return [np.ascontiguousarray(out[:, i]).reshape(-1).view(">u8").astype(np.uint64) for i in range(size)]


def frequent_bits(phrases: DataFrame, size: int, width: int) -> np.ndarray:
    """A bit set of the phrases (lang, key), some 16 bits each and 2**MOST_BITS at most, as 64-bit words."""
    bits = min(MOST_BITS, max(16, (16 * phrases.count()).bit_length()))

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(1 << bits >> 6, np.uint64)
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for lang, key in zip(batch.column("lang").to_pylist(), batch.column("key").to_pylist()):
                by_lang.setdefault(lang, []).append(key)
            for lang, keys in by_lang.items():
                at = mark(lang, from_keys(keys, size, width)) & np.uint64((1 << bits) - 1)
                np.bitwise_or.at(own, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        place = np.flatnonzero(own)
        for at in range(0, len(place), 1 << 16):
            some = place[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(own[some].view(np.int64))], ["place", "word"])

    rows = phrases.select("lang", "key").mapInArrow(set_bits, "place long, word long").groupBy("place").agg(F.bit_or("word").alias("word")).toArrow()
    out = np.zeros(1 << bits >> 6, np.uint64)
    out[rows.column("place").to_numpy()] = rows.column("word").to_numpy().view(np.uint64)
    return out


def _among(bits: np.ndarray, marks: np.ndarray) -> np.ndarray:
    at = marks & np.uint64(64 * len(bits) - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


# -- counting phrases of one size -------------------------------------------


def count_phrases(rows: DataFrame, size: int, shorter: DataFrame, seed: int, width: int, shard_bits: int, least: int) -> DataFrame:
    """(lang, key, f) of all phrases of ``size`` words that occur ``least`` times; ``shorter`` has those of one word less."""
    session = rows.sparkSession
    shared = session.sparkContext.broadcast(frequent_bits(shorter, size - 1, width))

    def filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, bits = Numbers(seed, width), shared.value
        held: dict[str, Counts] = {}
        for batch in batches:
            for lang, texts in by_language(batch).items():
                own, before = held.setdefault(lang, Counts(size)), np.empty(0, np.uint64)
                for words in word_blocks(texts):
                    ids = np.concatenate((before, numbers.of(words)))
                    before = ids[len(ids) - min(len(ids), size - 1) :]
                    lanes = _phrases(lang, ids, size, bits)
                    own.add(lanes, np.ones(len(lanes[0]), np.int64))
            if sum(c.known for c in held.values()) > 2 * HELD_ROWS:
                yield from _filter_batches(held, width, shard_bits)
                held = {}
        yield from _filter_batches(held, width, shard_bits)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, Counts(size)
        for batch in batches:
            for lang, shard, data in zip(*(batch.column(c).to_pylist() for c in ("lang", "shard", "filter"))):
                if (lang, shard) != now:
                    if now:
                        yield from _frequent(now[0], counts, width, least)
                    now, counts = (lang, shard), Counts(size)
                counts.add(*read_filter(data, width, shard_bits, shard))
        if now:
            yield from _frequent(now[0], counts, width, least)

    n = int(session.conf.get("spark.sql.shuffle.partitions"))
    sent = rows.mapInArrow(filters, "lang string, shard long, filter binary")
    dealt = sent.repartition(n, "lang", "shard").sortWithinPartitions("lang", "shard")
    return dealt.mapInArrow(merged, "lang string, key binary, f long")


def _phrases(lang: str, ids: np.ndarray, size: int, bits: np.ndarray) -> list[np.ndarray]:
    """Runs of ``size`` words whose first and last ``size - 1`` are in the bit set."""
    inner = size - 1
    parts = [ids[i : len(ids) - inner + 1 + i] for i in range(inner)] if len(ids) >= inner else [ids[:0]] * inner
    good = np.all([p != 0 for p in parts], axis=0) if len(parts[0]) else np.empty(0, bool)
    at = np.flatnonzero(good)
    good[at] = _among(bits, mark(lang, [p[at] for p in parts]))
    at = np.flatnonzero(good[:-1] & good[1:])
    return [ids[at + i] for i in range(size)]


def _filter_batches(held: dict[str, Counts], width: int, shard_bits: int) -> Iterator[pa.RecordBatch]:
    for lang, own in held.items():
        lanes, counts = own.arrays()
        lanes = permuted(lanes, width)
        order = np.argsort(lanes[0])
        lanes, counts = [lane[order] for lane in lanes], counts[order]
        shard = (lanes[0] >> np.uint64(width - shard_bits)).astype(np.int64)
        starts = np.flatnonzero(np.diff(shard, prepend=-1))
        rows = [(int(shard[a]), write_filter([lane[a:b] for lane in lanes], counts[a:b], width, shard_bits)) for a, b in zip(starts, [*starts[1:], len(shard)])]
        for at in range(0, len(rows), 256):
            numbers, data = zip(*rows[at : at + 256])
            columns = [pa.array([lang] * len(data)), pa.array(numbers, pa.int64()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "shard", "filter"])


def _frequent(lang: str, own: Counts, width: int, least: int) -> Iterator[pa.RecordBatch]:
    lanes, counts = own.arrays()
    at = np.flatnonzero(counts >= least)
    keys = to_keys(unpermuted([lane[at] for lane in lanes], width), width)
    for i in range(0, len(at), 1 << 16):
        some = keys.slice(i, 1 << 16)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some)), some, pa.array(counts[at][i : i + (1 << 16)])], ["lang", "key", "f"])


# -- the operator -----------------------------------------------------------


def mine_phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = TOP,
    covered_percent: int = COVERED_PERCENT,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    A phrase has 2 to ``longest`` words inside one piece and occurs at least ``least`` times (a);
    ``score`` is that of its worst cut into l and r, the earliest of equals; one whose words stand
    in a longer candidate with ``covered_percent`` of its occurrences is left out. A null
    language is ``und``, a null text is empty, repeated rows count again. Ties are broken by occurrences,
    then by the phrase's bytes. No phrase, or an empty table, gives no rows.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text")).filter(
        F.col("text").isNotNull()
    )
    words = cut(count_words(rows))
    seed, width = choose_numbers(words)
    total = words.agg(F.sum("n")).first()[0] or 0
    shard_bits = min(_MOST_SHARD_BITS, max(_LEAST_SHARD_BITS, (total // _SHARD_WORDS).bit_length()), width)

    number = F.lpad(F.hex(number_column("word", seed, width)), width // 4, "0")
    vocabulary = words.filter(F.col("n") >= least).select("lang", F.unhex(number).alias("key"), "word", F.col("n").alias("f"))
    by_size = [vocabulary.select("lang", "key", "f")]
    for size in range(2, longest + 1):
        by_size.append(cut(count_phrases(rows, size, by_size[-1], seed, width, shard_bits, least)))
    return _ranked(words, vocabulary, by_size, width // 8, top, covered_percent)


def _ranked(words: DataFrame, vocabulary: DataFrame, by_size: list[DataFrame], nbytes: int, top: int, covered_percent: int) -> DataFrame:
    phrases = by_size[0].withColumn("size", F.lit(1))
    for size, own in enumerate(by_size[1:], 2):
        phrases = phrases.unionByName(own.withColumn("size", F.lit(size)))
    candidates = phrases.filter("size > 1")
    part = lambda first, size: F.substring("key", first * nbytes + 1, size * nbytes)
    exact = lambda x: F.col(x).cast("decimal(20,0)") if isinstance(x, str) else x.cast("decimal(20,0)")

    known = phrases.select(F.col("lang").alias("in_lang"), F.col("key").alias("part"), F.col("f").alias("part_f"))

    def with_count(df: DataFrame, key: str, name: str) -> DataFrame:
        found = known.withColumnRenamed("part_f", name)
        return df.join(found, (F.col("lang") == F.col("in_lang")) & (F.col(key) == F.col("part"))).drop("in_lang", "part")

    cuts = candidates.select("lang", "key", F.col("f").alias("a"), "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "key", "a", "k", part(F.lit(0), F.col("k")).alias("head"), part(F.col("k"), F.col("size") - F.col("k")).alias("tail"))
    cuts = with_count(with_count(cuts, "head", "l"), "tail", "r").withColumn("both", exact("l") + exact("r"))
    score = F.expr(f"CAST(CAST({SCALE} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0)) DIV both AS BIGINT)")
    scored = cuts.groupBy("lang", "key", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    inner = candidates.filter("size > 2").select(
        "lang",
        "f",
        F.explode(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(2), F.col("size") - 1),
                    lambda k: F.transform(F.sequence(F.lit(0), F.col("size") - k), lambda i: part(i, k)),
                )
            )
        ).alias("key"),
    )
    longer = inner.groupBy("lang", "key").agg(F.max("f").alias("longer"))
    covered = F.coalesce(exact("longer") * 100 >= exact("a") * covered_percent, F.lit(False))
    left = scored.join(longer, ["lang", "key"], "left").filter(~covered).select("lang", "key", "a", "cut.score", "cut.l", "cut.r")

    # ties at the border stay until the phrases are written out, which decides them
    by_lang = Window.partitionBy("lang")
    best = left.withColumn("place", F.rank().over(by_lang.orderBy(F.desc("score"), F.desc("a")))).filter(F.col("place") <= top).drop("place")
    spelled = best.select("lang", "key", F.posexplode(F.transform(F.sequence(F.lit(0), (F.length("key") / nbytes).cast("int") - 1), lambda i: part(i, F.lit(1)))).alias("at", "one"))
    texts = vocabulary.select(F.col("lang"), F.col("key").alias("one"), F.col("word").cast("string").alias("word"))
    spelled = spelled.join(texts, ["lang", "one"]).groupBy("lang", "key").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
    spelled = spelled.select("lang", "key", F.array_join(F.transform("words", lambda w: w["word"]), " ").alias("phrase"))

    sums = words.groupBy("lang").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(by_lang.orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = best.join(spelled, ["lang", "key"]).withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    return ranked.join(sums, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

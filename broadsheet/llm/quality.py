"""Quality rules by n-gram perplexity under modified Kneser-Ney models.

Spark counts, for every language and over all its texts, the ``ORDER``-grams of symbols. Bytes are
read as 64 symbols: letters in one case, white space, a digit, some punctuation, the rest,
and 32 for bytes of other alphabets. So a model has at most ``64 ** ORDER`` entries however
much it has read, and may be handed to every executor. Lower orders are continuation
counts; three discounts per order come from the counts of counts. A model is stored as sorted arrays
of gram numbers, perfect hashes of the grams, with the interpolated probability beside
each and the back-off weight beside each context.

What the symbols fold is priced by a second model of the same kind, from grams of three bytes as
they are: the chance of a byte among the bytes of its symbol, behind the two bytes before it. The two
chances multiply to the chance of the byte, so the case of a letter, the digit and every byte of other
alphabets count. It has at most ``256 ** 3`` entries a language, as many as the first.

A text's score is its mean code length, the logarithm of the perplexity, drawn a little to
its language's median if it is short. A language's band is as wide as ``FENCE`` quartile
distances below the first quartile and above the third; a text is kept if it lies in the band of its
symbols and in that of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import cut, utf8

ORDER = 4
FENCE = 3.0
# A text is scored as if so many symbols of median code length stood before it.
PRIOR_SYMBOLS = 100
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT = 5
# Code lengths are counted in steps of so many parts of a bit.
STEPS = 1000
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"

_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\v\f\r"
_PAD = b"\n" * (ORDER - 1)
_PART = 1 << 20
# Grams of bytes are numbered above those of symbols.
_BYTE_GRAMS = 64**ORDER
_PAGES = 1 << 12


# -- base rules -------------------------------------------------------------


def base_stats(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated windows."""
    words = text.split()
    data = np.frombuffer(text, np.uint8)
    starts = int(((data & 0xC0) != 0x80).sum())
    blank = sum(text.count(bytes([b])) for b in _SPACE)
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(words), starts - blank, symbols, len(lines) - len(set(lines)), _repeat_words(words)


def _repeat_words(words: list[bytes], size: int = REPEAT) -> int:
    """Words inside a window of ``size`` words that the text has twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    # window numbers, exact: pairs of neighbours are numbered again at each step
    key = ids
    for step in range(1, size):
        key = np.unique(key[:-1] * len(number) + ids[step:], return_inverse=True)[1]
    again = np.bincount(key)[key] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    where = np.flatnonzero(again)
    np.add.at(edges, where, 1)
    np.add.at(edges, where + size, -1)
    return int((np.cumsum(edges) > 0).sum())


def text_stats(text: Column | str) -> Column:
    """A struct of ``STATS``; a null text has no words."""

    @F.arrow_udf(STATS)
    def run(texts: pa.Array) -> pa.Array:
        rows = np.array([base_stats(t.as_py() or b"") for t in utf8(texts)], np.int64).reshape(-1, 5)
        names = [field.split()[0] for field in STATS.split(", ")]
        return pa.StructArray.from_arrays([pa.array(c) for c in rows.T], names)

    return run.asNondeterministic()(text)


# -- counting ---------------------------------------------------------------


def _symbol_table() -> np.ndarray:
    table = np.full(256, 31, np.uint64)
    table[list(_SPACE)] = 0
    for i in range(26):
        table[[0x41 + i, 0x61 + i]] = 1 + i
    table[list(b"0123456789")] = 27
    table[list(b".")] = 28
    table[list(b",;:")] = 29
    table[list(b"'\"()-!?")] = 30
    table[128:] = 32 + (np.arange(128, 256) & 31)
    return table


_TABLE = _symbol_table()


def grams_of(text: bytes) -> Iterator[np.ndarray]:
    """Numbers of the grams that end at each byte, the last symbol lowest; some megabytes at a time."""
    padded = np.frombuffer(_PAD + text, np.uint8)
    for at in range(0, len(text), _PART):
        data = _TABLE[padded[at : at + _PART + ORDER - 1]]
        gram = np.zeros(len(data) - ORDER + 1, np.uint64)
        for i in range(ORDER):
            gram = gram << np.uint64(6) | data[i : len(data) - ORDER + 1 + i]
        yield gram


def _behind_pairs(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The number of the two bytes before each byte, and the byte; some megabytes at a time."""
    padded = np.frombuffer(_PAD[:2] + text, np.uint8)
    for at in range(0, len(text), _PART):
        data = padded[at : at + _PART + 2]
        yield data[:-2].astype(np.int32) << 8 | data[1:-1], data[2:]


def byte_grams_of(text: bytes) -> Iterator[np.ndarray]:
    """Numbers of the three bytes that end at each byte, the last lowest."""
    for pair, last in _behind_pairs(text):
        yield (pair << 8 | last).astype(np.uint64)


def count_grams(docs: DataFrame, lang: Column, text_col: str = "text") -> DataFrame:
    """(lang, gram, n) over all texts, grams of bytes from ``64 ** ORDER`` on; a task adds up its own counts before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        waiting = 0
        for batch in batches:
            for name, text in zip(batch.column("lang").to_pylist(), utf8(batch.column("text"))):
                own, text = held.setdefault(name, []), text.as_py()
                for symbols, raw in zip(grams_of(text), byte_grams_of(text)):
                    own += symbols, raw + np.uint64(_BYTE_GRAMS)
                    waiting += 2 * len(raw)
                # of all languages together, however many there are
                if waiting > 1 << 22:
                    held, waiting = {k: [_counted(v)] for k, v in held.items()}, 0
        for name, parts in held.items():
            grams, n = _counted(parts)
            for at in range(0, len(grams), 1 << 16):
                part = grams[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(part)), pa.array(part.astype(np.int64)), pa.array(n[at : at + (1 << 16)])], ["lang", "gram", "n"]
                )

    rows = docs.select(lang.alias("lang"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    return rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _counted(parts: list) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams and their counts, from arrays of grams and such pairs."""
    plain = [p for p in parts if not isinstance(p, tuple)]
    grams, n = np.unique(np.concatenate(plain), return_counts=True) if plain else (np.empty(0, np.uint64), np.empty(0, np.int64))
    for more, count in (p for p in parts if isinstance(p, tuple)):
        both, where = np.unique(np.concatenate((grams, more)), return_inverse=True)
        grams, n = both, np.bincount(where, np.concatenate((n, count)), len(both)).astype(np.int64)
    return grams, n


# -- models -----------------------------------------------------------------


class KneserNey:
    """One language's model, from its distinct grams and their counts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        levels = [(grams, counts)]
        for order in range(ORDER - 1, 0, -1):
            # how many different symbols stand before a gram
            levels.append(np.unique(levels[-1][0] & np.uint64((1 << 6 * order) - 1), return_counts=True))
        self.grams, self.chance, self.contexts, self.weight = [], [], [], []
        for order, (keys, n) in enumerate(reversed(levels), 1):
            discount = _discounts(n)[np.minimum(n, 3)]
            contexts, where = np.unique(keys >> np.uint64(6), return_inverse=True)
            total = np.bincount(where, n)
            weight = np.bincount(where, discount) / total
            shorter = self._known(order - 1, keys & np.uint64((1 << 6 * (order - 1)) - 1))
            self.grams.append(keys)
            self.chance.append((n - discount) / total[where] + weight[where] * shorter)
            self.contexts.append(contexts)
            self.weight.append(weight)

    def _known(self, order: int, keys: np.ndarray) -> np.ndarray:
        """Chances of grams of ``order``; those never seen back off."""
        if order == 0:
            return np.full(len(keys), 1 / 64)
        at, seen = _find(self.grams[order - 1], keys)
        out = self.chance[order - 1][at]
        rest = np.flatnonzero(~seen)
        if len(rest):
            keys = keys[rest]
            above, known = _find(self.contexts[order - 1], keys >> np.uint64(6))
            weight = np.where(known, self.weight[order - 1][above], 1.0)
            out[rest] = weight * self._known(order - 1, keys & np.uint64((1 << 6 * (order - 1)) - 1))
        return out

    def code_length(self, text: bytes) -> float:
        """Bits of a whole text."""
        return float(sum(-np.log2(self._known(ORDER, gram)).sum() for gram in grams_of(text)))


_BY_SYMBOL = np.argsort(_TABLE, kind="stable")
_SYMBOL_STARTS = np.searchsorted(_TABLE[_BY_SYMBOL], np.arange(64))


def _sums(rows: np.ndarray) -> np.ndarray:
    """For each of 256 columns the sum over the columns of the same symbol."""
    return np.add.reduceat(rows[:, _BY_SYMBOL], _SYMBOL_STARTS, axis=1)[:, _TABLE.astype(np.intp)]


def _smoothed(n: np.ndarray, discounts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Chances of bytes among those of their symbol; a row of counts is a context."""
    lost = discounts[np.minimum(n, 3)]
    total = _sums(n)
    return np.where(total > 0, (n - lost + _sums(lost) * shorter) / np.maximum(total, 1), shorter)


class ByteChoice:
    """One language's chances of a byte if its symbol is known, from its distinct grams of three bytes and their counts.

    A page holds the bits of all 256 bytes behind one context: 256 pages for one byte before, then a page per
    known pair of bytes. A pair never seen has the page of its last byte.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        grams = grams.astype(np.int64)
        pairs, page = np.unique(grams >> 8, return_inverse=True)
        two = np.bincount(grams & 0xFFFF, minlength=1 << 16).reshape(256, 256)
        one = (two > 0).sum(0, keepdims=True)
        chance = _smoothed(one, _discounts(one[one > 0]), 1 / _sums(np.ones((1, 256))))
        chance = _smoothed(two, _discounts(two[two > 0]), chance)
        self.bits = np.empty((256 + len(pairs), 256), np.float32)
        discounts = _discounts(counts)
        with np.errstate(divide="ignore"):
            self.bits[:256] = -np.log2(chance)
            for at in range(0, len(pairs), _PAGES):
                some = pairs[at : at + _PAGES]
                own = slice(*np.searchsorted(page, (at, at + len(some))))
                three = np.zeros((len(some), 256), np.int64)
                three[page[own] - at, grams[own] & 255] = counts[own]
                self.bits[256 + at : 256 + at + len(some)] = -np.log2(_smoothed(three, discounts, chance[some & 255]))
        self.start = (np.arange(1 << 16, dtype=np.int32) & 255) << 8
        self.start[pairs] = np.arange(256, 256 + len(pairs)) << 8

    def code_length(self, text: bytes) -> float:
        """Bits of a whole text whose symbols are known."""
        bits = self.bits.reshape(-1)
        return float(sum(bits[self.start[pair] + last].sum(dtype=np.float64) for pair, last in _behind_pairs(text)))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _discounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and more; half the count's share where too few are seen."""
    seen = [int((n == i).sum()) for i in range(1, 5)]
    share = seen[0] / (seen[0] + 2 * seen[1]) if seen[0] else 0.5
    out = [0.0]
    for i in (1, 2, 3):
        found = i - (i + 1) * share * seen[i] / seen[i - 1] if seen[i - 1] else share
        out.append(min(max(found, 0.0), i - 0.01))
    return np.array(out)


@dataclass(frozen=True, eq=False)
class Models:
    """Grams and counts by language, as they came from Spark."""

    counts: dict[str, tuple[np.ndarray, np.ndarray]]
    token: str


_BUILT: dict[str, dict[str, tuple[KneserNey, ByteChoice]]] = {}


def _model(models: Models, lang: str) -> tuple[KneserNey, ByteChoice]:
    """A worker builds a language's two models when it first needs them."""
    if models.token not in _BUILT:
        _BUILT.clear()
        _BUILT[models.token] = {}
    built = _BUILT[models.token]
    if lang not in built:
        grams, n = models.counts[lang]
        first = np.searchsorted(grams, np.uint64(_BYTE_GRAMS))
        built[lang] = KneserNey(grams[:first], n[:first]), ByteChoice(grams[first:] - np.uint64(_BYTE_GRAMS), n[first:])
    return built[lang]


def _code_lengths(models: Models, lang: str, text: bytes) -> tuple[float, float]:
    """Bits of a whole text as symbols and as bytes."""
    symbols, choice = _model(models, lang)
    total = symbols.code_length(text)
    return total, total + choice.code_length(text)


def train_models(docs: DataFrame, lang: Column, text_col: str = "text") -> Models:
    """Models of all languages. An entry per distinct gram is gathered, at most 64**ORDER + 256**3 a language."""
    rows = count_grams(docs, lang, text_col).toArrow()
    names = rows.column("lang").combine_chunks().dictionary_encode()
    if isinstance(names, pa.ChunkedArray):
        names = names.combine_chunks()
    codes = names.indices.to_numpy(zero_copy_only=False)
    grams, n = rows.column("gram").to_numpy().astype(np.uint64), rows.column("n").to_numpy()
    counts = {}
    for code, name in enumerate(names.dictionary.to_pylist()):
        own = np.flatnonzero(codes == code)
        own = own[np.argsort(grams[own])]
        counts[name] = grams[own], n[own]
    return Models(counts, uuid4().hex)


# -- the operator -----------------------------------------------------------


def judge_quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    fence: float = FENCE,
    prior_symbols: int = PRIOR_SYMBOLS,
) -> DataFrame:
    """(id, ``STATS``, base_failed, lang, bits, low, high, byte_bits, byte_low, byte_high, kept), one row per row of ``docs``.

    ``bits`` is the score by symbols, ``low`` and ``high`` the band of the text's language, both from texts that pass
    the base rules; the byte columns are the same by bytes as they are. A null text has no words and fails. A null language is a
    language of its own, ''. Where no text of a language passes the base rules there is no
    band, and none is needed. Repeated rows are judged each by itself, an empty table gives no rows.
    """
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(""))
    models = train_models(docs, lang, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(models)

    @F.arrow_udf("total double, byte_total double")
    def code_lengths(langs: pa.Array, texts: pa.Array) -> pa.Array:
        pairs = zip(langs.to_pylist(), utf8(texts))
        rows = [_code_lengths(shared.value, name, t.as_py()) if t.is_valid else (None, None) for name, t in pairs]
        return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], pa.float64()) for i in (0, 1)], ["total", "byte_total"])

    marked = docs.select(
        F.col(id_col).alias("id"),
        lang.alias("lang"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("size"),
        text_stats(text_col).alias("stats"),
        code_lengths.asNondeterministic()(lang, F.col(text_col)).alias("length"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    marked = cut(marked.select("id", "lang", "size", "length.*", "stats.*").withColumn("base_failed", failed))
    judged, kept, scores = marked, ~F.col("base_failed"), []
    for prefix in ("", "byte_"):
        total, median, bits, low, high = (prefix + name for name in ("total", "median", "bits", "low", "high"))
        bands = language_bands(marked.filter(~F.col("base_failed")), fence, total)
        bands = bands.select("lang", F.col("median").alias(median), F.col("low").alias(low), F.col("high").alias(high))
        # one row per language, of which train_models has a model in memory
        judged = judged.join(F.broadcast(bands), "lang", "left")
        score = (F.col(total) + prior_symbols * F.col(median)) / (F.col("size") + prior_symbols)
        judged = judged.withColumn(bits, F.when(~F.col("base_failed"), score))
        kept = kept & F.coalesce(F.col(bits).between(F.col(low), F.col(high)), F.lit(False))
        scores += bits, low, high
    names = [field.split()[0] for field in STATS.split(", ")]
    return judged.select(F.col("id").alias(id_col), *names, "base_failed", "lang", *scores, kept.alias("kept"))


def language_bands(scored: DataFrame, fence: float = FENCE, total: str = "total") -> DataFrame:
    """(lang, median, low, high) of (lang, size, ``total``), to a thousandth of a bit.

    Texts are counted by rounded code length before the shuffle; a language has some
    thousands of such counts, and its quartiles are exact on them.
    """
    step = F.round(F.col(total) / F.col("size") * STEPS).cast("long")
    counts = scored.groupBy("lang", step.alias("step")).agg(F.count("*").alias("n"))
    own = Window.partitionBy("lang")
    placed = counts.withColumn("upto", F.sum("n").over(own.orderBy("step"))).withColumn("all", F.sum("n").over(own))
    quartile = lambda k: F.min(F.when(4 * F.col("upto") >= k * F.col("all"), F.col("step"))) / STEPS
    found = placed.groupBy("lang").agg(*(quartile(k).alias(f"q{k}") for k in (1, 2, 3)))
    # at least a step, where all texts are alike
    width = fence * F.greatest(F.col("q3") - F.col("q1"), F.lit(1 / STEPS))
    return found.select("lang", F.col("q2").alias("median"), (F.col("q1") - width).alias("low"), (F.col("q3") + width).alias("high"))

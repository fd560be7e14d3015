"""Language ID by prediction by partial matching.

Every language has a byte context tree of up to ``ORDER`` bytes, counted by Spark over
all labelled texts. A byte's code length under a language is exact: the longest known
context codes it, or escapes (method C: as many escapes as distinct bytes seen) to the
next shorter one, which codes it among the bytes not excluded so far, down to 256 equal
bytes. The statistics are frozen.

Every context of every language counts: the counts are a stored Spark table. The rows to be
judged are stored once, as compressed blocks in parts of some 32 MB of text, with the distinct
grams of each part, in a table bucketed by part. Every gram that is asked for is priced once,
joined back to the parts that ask for it and shuffled to their buckets; the texts are not shuffled.

The language with the shortest code wins; ties go to the name that sorts first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from broadsheet.llm.common import store, utf8

ORDER = 4
UNKNOWN = "und"
PREDICTION = "lang_pred string, score double, bits_per_byte double, rejected boolean"

# Texts are scored in parts of about so many bytes, stored in blocks of so many, and about so
# many grams of the tree meet at once.
PART_BYTES = 32 << 20
BLOCK_BYTES = 1 << 20
TREE_ROWS = 200_000
# The stored parts are dealt over two buckets a task, at most so many.
BUCKETS = 50_000

_PAD = b"\n" * ORDER
_BLOCK = 1 << 16
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


# -- training ---------------------------------------------------------------


def count_grams(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n): how often ``ORDER`` bytes and a next one occur in a language.

    A text starts behind line ends. A task adds up its own counts before the shuffle.
    """
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), utf8(batch.column("text"))):
                by_lang.setdefault(lang, []).append(text.as_py())
            for lang, texts in by_lang.items():
                for grams in _grams(texts):
                    held.setdefault(lang, []).append(np.unique(grams, return_counts=True))
                    if len(held[lang]) > 16:
                        held[lang] = [_added(held[lang])]
        for lang, parts in held.items():
            grams, n = _added(parts)
            for at in range(0, len(grams), 1 << 16):
                here = grams[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(here)), pa.array(here.astype(np.int64)), pa.array(n[at : at + (1 << 16)])], ["lang", "gram", "n"]
                )

    return rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _grams(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Every byte behind its ``ORDER`` predecessors, half a megabyte of text at a time."""
    parts, size = [], 0
    for text in texts:
        padded = _PAD + text
        for at in range(0, len(text), _BLOCK):
            data = np.frombuffer(padded, np.uint8)[at : at + _BLOCK + ORDER].astype(np.uint64)
            gram = np.zeros(len(data) - ORDER, np.uint64)
            for i in range(ORDER + 1):
                gram = gram << np.uint64(8) | data[i : len(data) - ORDER + i]
            parts.append(gram)
            size += len(gram)
            if size > 1 << 19:
                yield np.concatenate(parts)
                parts, size = [], 0
    if size:
        yield np.concatenate(parts)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    n = np.zeros(len(grams), np.int64)
    np.add.at(n, where, np.concatenate([c for _, c in parts]))
    return grams, n


# -- prediction -------------------------------------------------------------


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode("utf-8", "replace"))


def _predicted(text: bytes | None, tables: _Priced | None, languages: tuple[str, ...]) -> tuple:
    if not text or not has_letter(text):
        return UNKNOWN, 0.0, None, True
    if tables is None:
        return UNKNOWN, 0.0, None, False
    bits = tables.code_lengths(text)
    best = int(np.argmin(bits))
    each = float(bits[best]) / len(text)
    return languages[best], float(1 / np.exp2(np.maximum(bits[best] - bits, -1074)).sum()), each, each >= 8


class PpmLevels:
    """Code lengths of one language's grams, from whole counts.

    A byte that a context has seen costs the same whatever the shorter contexts are. Any
    other costs what it costs there and the context's escape, which is spread over what the
    shorter one leaves.
    """

    def __init__(self, levels: list | None = None):
        # by order: grams, their chances, contexts, bits of their escapes
        self.levels = list(levels or ())

    def add(self, grams: np.ndarray, n: np.ndarray) -> None:
        """The next order, from grams that hold it at their ends."""
        order = len(self.levels)
        keys, where = np.unique(grams & _ends(order), return_inverse=True)
        counts = np.bincount(where, n, len(keys))
        contexts, where = np.unique(keys >> 8, return_inverse=True)
        total = np.bincount(where, counts, len(contexts))
        distinct = np.bincount(where, minlength=len(contexts))
        escape = np.where(distinct < 256, distinct, 0)
        chance = counts / (total + escape)[where]
        if order:
            shorter, known, *_ = self.levels[-1]
            below = known[_found(shorter, keys & _ends(order - 1))[0]] if len(keys) else np.empty(0)
        else:
            below = np.full(len(keys), 1 / 256)
        left = np.maximum(1 - np.bincount(where, below, len(contexts)), 1e-300)
        with np.errstate(divide="ignore"):
            bits = np.where(escape > 0, np.log2(left) - np.log2(escape / (total + escape)), 0.0)
        self.levels.append((keys, chance, contexts, bits))

    def bits(self, grams: np.ndarray) -> np.ndarray:
        out = np.full(len(grams), 8.0)
        for order, (keys, chance, contexts, escape) in enumerate(self.levels):
            own = grams & _ends(order)
            if len(keys):
                at, known = _found(contexts, own >> 8)
                out += np.where(known, escape[at], 0.0)
                at, seen = _found(keys, own)
                out = np.where(seen, -np.log2(chance[at]), out)
        return out


def _ends(order: int) -> np.int64:
    return np.int64((1 << 8 * (order + 1)) - 1)


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def judge_languages(
    docs: DataFrame,
    learned: DataFrame,
    out: str,
    text_col: str = "text",
    lang_col: str = "lang",
    columns: list[str] | None = None,
    part_bytes: int = PART_BYTES,
    tree_rows: int = TREE_ROWS,
) -> DataFrame:
    """``columns`` of ``docs`` (all if none are named) with a struct ``out`` of ``PREDICTION``.

    A null text or one without a letter is ``und`` at score 0 and rejected. ``score`` is the
    chance of the language if all are equally likely before. A text that no language codes
    in less than 8 bits a byte, which needs no model, is rejected too, under the name of
    the nearest one. Without any learned language every text is ``und``; only those without a
    letter are rejected then. Repeated rows are judged each by itself, an empty table stays empty,
    and rows of ``learned`` with a null text or language teach nothing.

    Every context of up to ``ORDER`` bytes in the rows of ``learned`` counts, however many there are
    and however rare its language is. Only orders 0 and 1, at most 65,536 counts a language,
    are held in one place.
    """
    counted = store(count_grams(learned, text_col, lang_col))
    pairs = counted.groupBy("lang", F.col("gram").bitwiseAND(F.lit(0xFFFF)).alias("gram")).agg(F.sum("n").alias("n")).toArrow()
    names = np.array(pairs.column("lang").to_pylist(), object)
    languages = tuple(sorted(set(names.tolist())))
    short: list[PpmLevels] = []
    for lang in languages:
        own = names == lang
        short.append(PpmLevels())
        for _ in range(2):
            short[-1].add(pairs.column("gram").to_numpy()[own], pairs.column("n").to_numpy()[own])
    shared = docs.sparkSession.sparkContext.broadcast((languages, short))

    columns = columns or docs.columns
    kept = docs.select(*(f"`{c}`" for c in dict.fromkeys([*columns, text_col])))
    buckets = min(BUCKETS, max(8, 2 * kept.rdd.getNumPartitions()))
    stored = store(kept.mapInArrow(_stored(text_col, part_bytes), "part long, block binary, grams array<bigint>"), "part", buckets)

    asked = stored.filter(F.col("grams").isNotNull()).select(F.col("part").alias("to"), F.explode("grams").alias("gram"))
    # grams whose contexts end alike meet: they share all orders but 0 and 1
    meets = max(16, -(-counted.count() // tree_rows))
    ends = F.pmod(F.xxhash64(F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF))), F.lit(meets)).alias("ends")

    def priced(tree: pa.Table, wanted: pa.Table) -> pa.Table:
        languages, short = shared.value
        grams = wanted.column("gram").to_numpy()
        bits = np.empty((len(grams), len(languages)), np.float32)
        lang = np.array(tree.column("lang").to_pylist(), object)
        for i, name in enumerate(languages):
            own = np.flatnonzero(lang == name)
            model = PpmLevels(short[i].levels)
            for _ in range(2, ORDER + 1):
                model.add(tree.column("gram").to_numpy()[own], tree.column("n").to_numpy()[own])
            bits[:, i] = model.bits(grams)
        width = bits.shape[1] * 4
        packed = pa.Array.from_buffers(pa.binary(width), len(grams), [None, pa.py_buffer(bits.tobytes())]).cast(pa.binary())
        return pa.table({"gram": wanted.column("gram"), "bits": packed})

    once = asked.select("gram").distinct().select(ends, "gram")
    prices = counted.select(ends, "lang", "gram", "n").groupBy("ends").cogroup(once.groupBy("ends")).applyInArrow(priced, "gram long, bits binary")
    # the files' sizes say little of the rows that come out of them, so no side is to be broadcast
    prices = asked.hint("merge").join(prices if languages else prices.limit(0), "gram").select("to", "gram", "bits")
    schema = docs.select(*(f"`{c}`" for c in columns)).schema.add(out, StructType.fromDDL(PREDICTION))
    empty = to_arrow_schema(schema).empty_table()

    def judged(blocks: pa.Table, prices: pa.Table) -> pa.Table:
        languages, _ = shared.value
        prices = prices.sort_by("gram")
        bits = np.frombuffer(b"".join(prices.column("bits").to_pylist()), np.float32)
        table = _Priced.of([(prices.column("gram").to_numpy(), bits)], len(languages)) if languages else None
        rows = (rows for block in blocks.column("block") for rows in pa.ipc.open_stream(block.as_buffer()))
        batches = [_with_verdicts(some, columns, text_col, table, languages, out) for some in rows]
        return pa.Table.from_batches(batches) if batches else empty

    blocks = stored.filter(F.col("block").isNotNull()).select("part", "block")
    # the blocks stay where they are stored: only prices are shuffled to them
    return blocks.groupBy("part").cogroup(prices.groupBy("to")).applyInArrow(judged, schema)


def _stored(text_col: str, part_bytes: int):
    """Rows as compressed blocks, each part of a task followed by its distinct grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packing = pa.ipc.IpcWriteOptions(compression="zstd")
        # numbers of parts are the task's in the low half, a count of its own in the high one
        part, size, seen = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            texts = utf8(batch.column(text_col))
            lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            for low, high in _slices(lengths, min(BLOCK_BYTES, part_bytes)):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=packing) as writer:
                    writer.write_batch(batch.slice(low, high - low))
                yield _stored_row(part, sink.getvalue().to_pybytes(), None)
                seen += map(np.unique, _grams([t.as_py() or b"" for t in texts[low:high]]))
                size += int(lengths[low:high].sum())
                if len(seen) > 16:
                    seen = [np.unique(np.concatenate(seen))]
                if size >= part_bytes:
                    yield from _gram_rows(part, seen)
                    part, size, seen = part + (1 << 32), 0, []
        yield from _gram_rows(part, seen)

    return run


def _slices(lengths: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``limit`` bytes, one row at least."""
    total, low = np.cumsum(lengths), 0
    while low < len(lengths):
        before = total[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(total, before + limit, "right")))
        yield low, high
        low = high


def _gram_rows(part: int, seen: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    grams = np.unique(np.concatenate(seen)).astype(np.int64) if seen else np.empty(0, np.int64)
    for at in range(0, len(grams), _BLOCK):
        yield _stored_row(part, None, grams[at : at + _BLOCK])


def _stored_row(part: int, block: bytes | None, grams: np.ndarray | None) -> pa.RecordBatch:
    listed = pa.array([None], pa.list_(pa.int64())) if grams is None else pa.ListArray.from_arrays(pa.array([0, len(grams)], pa.int32()), pa.array(grams))
    return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([block], pa.binary()), listed], ["part", "block", "grams"])


def _with_verdicts(
    rows: pa.RecordBatch, columns: list[str], text_col: str, table: _Priced | None, languages: tuple[str, ...], out: str
) -> pa.RecordBatch:
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("bits_per_byte", pa.float64()), ("rejected", pa.bool_())])
    names = [field.name for field in kind]
    found = [dict(zip(names, _predicted(t.as_py(), table, languages))) for t in utf8(rows.column(text_col))]
    return pa.RecordBatch.from_arrays([*(rows.column(c) for c in columns), pa.array(found, kind)], [*columns, out])


@dataclass(frozen=True, eq=False)
class _Priced:
    """Sorted grams with their bits under every language."""

    grams: np.ndarray
    bits: np.ndarray

    @classmethod
    def of(cls, held: list[tuple[np.ndarray, np.ndarray]], width: int) -> _Priced:
        grams = np.concatenate([g for g, _ in held]) if held else np.empty(0, np.int64)
        bits = np.concatenate([b for _, b in held]) if held else np.empty(0, np.float32)
        return cls(grams, bits.reshape(len(grams), width))

    def code_lengths(self, text: bytes) -> np.ndarray:
        total = np.zeros(self.bits.shape[1])
        for some in _grams([text]):
            at, seen = _found(self.grams, some.astype(np.int64))
            if not seen.all():
                raise ValueError("a gram of the text has no price")
            total += self.bits[at].sum(axis=0, dtype=np.float64)
        return total

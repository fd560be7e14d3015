"""Benchmark passages in documents, by Wu-Manber search over words.

The strings searched for are the windows of ``WINDOW`` consecutive words of every item.
Strings of one length share a table: the last ``BLOCK`` words under the reading place
tell how far the next place that can end a string is (its shift). A block that ends
some string has shift zero; it selects a bucket, and each string in it is compared
word by word. Most places are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import cut, fresh, utf8, word_blocks

WINDOW = 10
BLOCK = 3
# Items are searched for in rounds of at most so many bytes of text.
ROUND_BYTES = 16 << 20
LEAK = "n_words long, n_hit long, items array<string>, spans array<struct<first: long, last: long>>"

# What is no word becomes a space; A-Z become a-z.
_WORD = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TABLE = bytes(b if b in _WORD else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class WuManber:
    """All windows of some items, one table for each length of window."""

    def __init__(self, items: Iterable[tuple[str, bytes]], window: int = WINDOW, block: int = BLOCK):
        owners: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            words = words_of(text)
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                owners.setdefault(tuple(words[i : i + size]), set()).add(item)
        self.tables = []
        for size in sorted({len(w) for w in owners}):
            width = min(block, size)
            shift: dict[tuple[bytes, ...], int] = {}
            buckets: dict[tuple[bytes, ...], list] = {}
            for string, names in owners.items():
                if len(string) != size:
                    continue
                for end in range(width, size + 1):
                    part = string[end - width : end]
                    shift[part] = min(shift.get(part, size), size - end)
                buckets.setdefault(string[size - width :], []).append((string, names))
            self.tables.append((size, width, shift, buckets))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int, set[str]]]:
        """(first word, word behind the last, items) of every occurrence, table by table."""
        for size, width, shift, buckets in self.tables:
            far, end, n = size - width + 1, size, len(words)
            while end <= n:
                part = tuple(words[end - width : end])
                step = shift.get(part, far)
                if not step:
                    place = tuple(words[end - size : end])
                    for string, names in buckets[part]:
                        if string == place:
                            yield end - size, end, names
                    step = 1
                end += step

    def leaks(self, text: bytes) -> tuple[int, set[str], list[tuple[int, int]]]:
        """Number of words, items found, and the hit words as disjoint spans."""
        longest = max((t[0] for t in self.tables), default=1)
        held: list[bytes] = []
        seen, items, spans = 0, set(), []
        for block in word_blocks(text.translate(_TABLE)):
            words, at = held + block, seen - len(held)
            for first, last, names in self.search(words):
                items |= names
                spans.append((at + first, at + last))
            seen += len(block)
            held = words[max(0, len(words) - longest + 1) :] if longest > 1 else []
        return seen, items, merged(spans)


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def item_rounds(items: DataFrame, id_col: str, text_col: str, round_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items in rounds of bounded size, read one partition at a time."""
    held, size = [], 0
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.encode(text_col, "utf-8").alias("text"))
    for row in rows.filter(F.col("text").isNotNull()).toLocalIterator():
        held.append((row.id, bytes(row.text)))
        size += len(row.text)
        if size >= round_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def mark_leaks(
    docs: DataFrame,
    items: DataFrame,
    out: str,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """``docs`` with a struct ``out`` of ``LEAK``: words, hit words, items found, hit spans.

    A null text has no words. Items without a word, or with a null text, match nothing;
    a null item id counts as ''. Repeated items count once. Without items nothing is hit.
    Items beyond ``round_bytes`` are searched for in further rounds over the documents, so
    that the table on an executor stays bounded; the rounds' spans are merged.
    """
    base = docs.columns
    found = docs
    rounds = 0
    for rounds, part in enumerate(item_rounds(items, item_id, item_text, round_bytes), 1):
        if rounds > 1:
            found = cut(found)
        found = _searched(found, WuManber(part, window), out, text_col)
    if not rounds:
        found = _searched(found, WuManber(()), out, text_col)
    return found.select(*base, out)


def _searched(docs: DataFrame, automaton: WuManber, out: str, text_col: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(automaton)
    kind = pa.struct(
        [
            ("n_words", pa.int64()),
            ("n_hit", pa.int64()),
            ("items", pa.list_(pa.string())),
            ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
        ]
    )

    @F.arrow_udf(LEAK)
    def run(texts: pa.Array, *before: pa.Array) -> pa.Array:
        rows = []
        earlier = before[0].to_pylist() if before else [None] * len(texts)
        for text, old in zip(utf8(texts), earlier):
            n, items, spans = shared.value.leaks(text.as_py() or b"")
            if old:
                items |= set(old["items"])
                spans = merged([*spans, *((s["first"], s["last"]) for s in old["spans"])])
            rows.append(
                {"n_words": n, "n_hit": sum(b - a for a, b in spans), "items": sorted(items), "spans": [{"first": a, "last": b} for a, b in spans]}
            )
        return pa.array(rows, kind)

    inputs: list[Column | str] = [text_col, *([out] if out in docs.columns else [])]
    return docs.withColumn(out, run.asNondeterministic()(*inputs))


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without any hit word."""
    (leak,) = fresh(docs, "leak")
    return mark_leaks(docs, items, leak, text_col, **options).filter(F.col(f"{leak}.n_hit") == 0).select(*docs.columns)

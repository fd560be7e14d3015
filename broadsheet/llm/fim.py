"""Fill-in-the-middle with piece tables.

A document is never rewritten. It is a list of descriptors (buffer, start, length) over two
buffers that do not change: the bytes of its text and the bytes of the sentinels. Cutting splits
descriptors, an arrangement permutes them together with their sentinels, the inverse permutation
over the descriptors of an output restores the text, and a hash streams what they describe.

Units are words of ASCII letters and single other characters. Both cuts and the form are drawn
from a hash of the document's id, so a row has the same outcome wherever and whenever it is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import utf8

SEED = 1
ARRANGED_PERCENT = 90
SPM_PERCENT = 20

TEXT, SENTINEL = 0, 1
SENTINELS = (b"<P>", b"<M>", b"<S>")  # of prefix, middle and suffix
_SENTINEL_BUFFER = b"".join(SENTINELS)
_WIDTH = len(SENTINELS[0])

# Which of prefix, middle and suffix comes first, second and third.
ORDERS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
PLAIN = "plain"

_PIECES = "array<struct<buffer: int, start: long, length: long>>"
_CUT = f"n long, form string, prefix_chars long, middle_chars long, pieces {_PIECES}, sha256 string"
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


@dataclass(frozen=True)
class PieceTable:
    """Descriptors (buffer number, start, length) over immutable buffers."""

    buffers: tuple[bytes, ...]
    pieces: tuple[tuple[int, int, int], ...]

    @classmethod
    def of(cls, text: bytes) -> PieceTable:
        return cls((text, _SENTINEL_BUFFER), ((TEXT, 0, len(text)),))

    def cut(self, at: int) -> PieceTable:
        """The same bytes, with a border ``at`` bytes from the start; a cut at a border adds an empty piece."""
        out, before, done = [], 0, False
        for buffer, start, length in self.pieces:
            here = at - before
            if not done and 0 <= here <= length:
                out += [(buffer, start, here), (buffer, start + here, length - here)]
                done = True
            else:
                out.append((buffer, start, length))
            before += length
        if not done:
            raise ValueError("a cut must be inside the document")
        return PieceTable(self.buffers, tuple(out))

    def permuted(self, order: tuple[int, ...]) -> PieceTable:
        return PieceTable(self.buffers, tuple(self.pieces[i] for i in order))

    def restored(self, order: tuple[int, ...]) -> PieceTable:
        """Undo ``permuted(order)``."""
        inverse = np.argsort(order).tolist()
        return self.permuted(tuple(inverse))

    def stream(self) -> Iterator[memoryview]:
        views = [memoryview(b) for b in self.buffers]
        return (views[buffer][start : start + length] for buffer, start, length in self.pieces)

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for view in self.stream():
            digest.update(view)
        return digest.hexdigest()

    def __bytes__(self) -> bytes:
        return b"".join(self.stream())


def units(text: bytes) -> np.ndarray:
    """Where each unit of a text starts, in bytes of its UTF-8."""
    data = np.frombuffer(text, np.uint8)
    letter = _LETTER[data]
    starts = (data & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(starts)


def arranged(table: PieceTable, form: str) -> PieceTable:
    """Prefix, middle and suffix in the order of ``form``, each behind its sentinel."""
    order = ORDERS[form]
    moved = table.permuted(order).pieces
    marks = [(SENTINEL, _WIDTH * part, _WIDTH) for part in order]
    return PieceTable(table.buffers, tuple(p for pair in zip(marks, moved) for p in pair))


def taken_apart(output: bytes, form: str) -> PieceTable:
    """The text that an output of ``form`` was made from, as descriptors over the output."""
    table = PieceTable.of(output)
    if form == PLAIN:
        return table
    order = ORDERS[form]
    borders = [output.index(SENTINELS[part]) for part in order]
    pieces = tuple((TEXT, a + _WIDTH, b - a - _WIDTH) for a, b in zip(borders, [*borders[1:], len(output)]))
    return PieceTable(table.buffers, pieces).restored(order)


# -- as columns -------------------------------------------------------------


def draws(id_col: str, seed: int = SEED) -> list[Column]:
    """Four numbers below 2**32 from the hash of a row's id; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame,
    out: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    arranged_percent: int = ARRANGED_PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """``docs`` with a struct ``out``: units, form, cut sizes, descriptors and hash of the output.

    ``pieces`` describe the output over (text, sentinels); ``rendered`` writes it out. Empty texts
    and texts that hold a sentinel stay plain, one piece, with null sizes; a null text is an empty
    one. Rows with the same id draw the same numbers. One narrow stage: nothing is shuffled, long
    texts are cut like short ones, and an empty table gives no rows.
    """

    @F.arrow_udf(_CUT)
    def cut(texts: pa.Array, *drawn: pa.Array) -> pa.Array:
        numbers = [d.to_pylist() for d in drawn]
        rows = [_cut_row(t.as_py() or b"", h, arranged_percent, spm_percent) for t, h in zip(utf8(texts), zip(*numbers))]
        piece = pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())])
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(piece), pa.string())
        names = ("n", "form", "prefix_chars", "middle_chars", "pieces", "sha256")
        columns = zip(*rows) if rows else [()] * len(names)
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return docs.withColumn(out, cut.asNondeterministic()(text_col, *draws(id_col, seed)))


def _cut_row(text: bytes, drawn: tuple[int, ...], arranged_percent: int, spm_percent: int) -> tuple:
    starts = units(text)
    n, table = len(starts), PieceTable.of(text)
    form, sizes = PLAIN, (None, None)
    if text and not any(s in text for s in SENTINELS) and drawn[2] % 100 < arranged_percent:
        form = "spm" if drawn[3] % 100 < spm_percent else "psm"
        first, last = sorted((drawn[0] % (n + 1), drawn[1] % (n + 1)))
        borders = np.append(starts, len(text))
        a, b = int(borders[first]), int(borders[last])
        table = table.cut(a).cut(b)
        sizes = tuple(_chars(text, *border) for border in ((0, a), (a, b)))
        table = arranged(table, form)
    pieces = [{"buffer": p[0], "start": p[1], "length": p[2]} for p in table.pieces]
    return n, form, *sizes, pieces, table.sha256()


def _chars(text: bytes, start: int, end: int) -> int:
    data = np.frombuffer(text, np.uint8)[start:end]
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def rendered(text: Column | str, pieces: Column | str) -> Column:
    """The output that ``pieces`` describe over ``text``, written out by Spark."""
    text = F.col(text) if isinstance(text, str) else text
    own, marks = F.encode(F.coalesce(text, F.lit("")), "utf-8"), F.encode(F.lit(_SENTINEL_BUFFER.decode()), "utf-8")

    def described(p: Column) -> Column:
        start, length = (p["start"] + 1).cast("int"), p["length"].cast("int")
        return F.when(p["buffer"] == TEXT, F.substring(own, start, length)).otherwise(F.substring(marks, start, length))

    joined = F.aggregate(F.transform(pieces, described), F.encode(F.lit(""), "utf-8"), lambda done, p: F.concat(done, p))
    return joined.cast("string")


def restored(output: Column | str, form: Column | str) -> Column:
    """The text that an output and its form stand for."""

    @F.arrow_udf("string")
    def run(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        texts = [bytes(taken_apart(t.as_py(), f)) for t, f in zip(utf8(outputs), forms.to_pylist())]
        return pa.array(texts, pa.binary()).cast(pa.string())

    return run.asNondeterministic()(output, form)

"""SimHash near-duplicates: fingerprints, pigeonring candidates, components.

Two fingerprints of 64 bits within ``d`` differ in at most ``d`` bits over ``d + 1``
segments laid on a ring. The pigeonring principle: from some segment on, the first
``l`` segments of the ring differ in at most ``l - 1`` bits together, for every ``l``.
So the first is equal, the second differs in at most one bit, the third in two.

* A segment that differs in at most ``l - 1`` bits keeps one of ``l`` parts unchanged,
  so the first ``depth`` segments give equality keys: ``(d + 1) * depth!`` a fingerprint
  (24 of 29 bits at 3 and 3). Every link shares a key.
* Of the pairs with a common key, those go on whose whole chain stays in its budgets;
  the Hamming distance is counted last.

Fingerprints are folded before, so copies never meet. A key that many fingerprints share
is dealt over cells of bounded size, and a cell gives the links of a spanning forest
only: same components, no square of a group's size. No candidate is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import cut, fresh, store, utf8, word_blocks
from broadsheet.llm.components import connected_components

SHINGLE = 3
MAX_DISTANCE = 3
DEPTH = 3
CELL = 4096
_BITS = 64


# -- fingerprints -----------------------------------------------------------


def fingerprint_of(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text, unsigned; zero if it has no word."""
    ones, total, held = np.zeros(_BITS, np.int64), 0, []
    for block in word_blocks((text or b"").lower()):
        words = held + block
        held = words[-(shingle - 1) :] if shingle > 1 else []
        if len(words) >= shingle:
            ones, total = ones + _count_bits(words, shingle), total + len(words) - shingle + 1
    if not total and held:
        ones, total = _count_bits(held, len(held)), 1
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def _count_bits(words: list[bytes], shingle: int) -> np.ndarray:
    """How many shingles of ``words`` set each bit of their hash, highest bit first."""
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - shingle + 1
    pieces = (joined[a:b] for a, b in zip(starts[:n].tolist(), ends[shingle - 1 :].tolist()))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(42)), ">u8", n)
    ones = np.zeros(_BITS, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1).sum(axis=0, dtype=np.int64)
    return ones


def fingerprint(text: Column | str, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text as a long with the same bits; null text is empty text."""

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        found = np.fromiter((fingerprint_of(t.as_py(), shingle) for t in utf8(texts)), np.uint64, len(texts))
        return pa.array(found.view(np.int64))

    return run.asNondeterministic()(text)


def fingerprint_hex(fp: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# -- candidates and links ---------------------------------------------------


def segments(max_distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment of the ring; widths differ by one at most."""
    return _split(0, _BITS, max_distance + 1)


def _split(first: int, width: int, parts: int) -> list[tuple[int, int]]:
    edges = [first + width * i // parts for i in range(parts + 1)]
    return list(zip(edges, (b - a for a, b in zip(edges, edges[1:]))))


def ring_keys(fp: Column, max_distance: int, depth: int) -> Column:
    """An array of (start, key): where the chain starts, and the bits that must be equal."""
    ring = segments(max_distance)
    depth = min(depth, len(ring))
    bits = lambda first, width: F.shiftleft(F.shiftrightunsigned(fp, first), _BITS - width)
    keys = []
    for start in range(len(ring)):
        chain = [ring[(start + i) % len(ring)] for i in range(depth)]
        choices = product(*(_split(first, width, i + 1) for i, (first, width) in enumerate(chain)))
        for number, chosen in enumerate(choices):
            key = F.xxhash64(F.lit(number), *(bits(first, width) for first, width in chosen))
            keys.append(F.struct(F.lit(start).alias("start"), key.alias("key")))
    return F.array(*keys)


def simhash_links(fps: DataFrame, max_distance: int = MAX_DISTANCE, depth: int = DEPTH, cell: int = CELL) -> DataFrame:
    """(u, v) links that connect the distinct fingerprints ``fp`` within ``max_distance``.

    A spanning forest of every cell's links: enough for components. ``cell`` bounds
    the fingerprints of a cell; a key with more is dealt over all pairs of its parts.
    """
    if not 0 <= max_distance <= 7:
        raise ValueError("max_distance must be in 0..7")
    keyed = fps.select("fp", F.inline(ring_keys(F.col("fp"), max_distance, depth)))
    sizes = keyed.groupBy("start", "key").agg(F.count("*").alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / cell)
    own = F.pmod(F.xxhash64("fp"), parts)
    cells = F.transform(
        F.sequence(F.lit(0).cast("long"), parts - 1), lambda j: F.least(own, j) * parts + F.greatest(own, j)
    )
    dealt = keyed.join(sizes, ["start", "key"]).select("start", "key", "fp", F.explode(cells).alias("cell"))
    order = ["start", "key", "cell"]
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(n, *order).sortWithinPartitions(*order)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for start, group, fp in _whole_groups(batches):
            u, v = _forest(start, group, fp, max_distance)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return dealt.mapInArrow(link, "u long, v long")


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sorted rows in slices that hold whole cells: starts, group numbers, fingerprints."""
    held: list[np.ndarray] = [np.empty(0, np.int64)] * 4
    for batch in batches:
        rows = [np.concatenate((h, batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64))) for h, c in zip(held, ("start", "key", "cell", "fp"))]
        if not len(rows[0]):
            continue
        new = np.flatnonzero(np.any([r[1:] != r[:-1] for r in rows[:3]], axis=0)) + 1
        last = int(new[-1]) if len(new) else 0
        held = [r[last:] for r in rows]
        if last:
            yield rows[0][:last], _numbers(new[:-1], last), rows[3][:last]
    if len(held[0]):
        yield held[0], np.zeros(len(held[0]), np.int64), held[3]


def _numbers(borders: np.ndarray, n: int) -> np.ndarray:
    marks = np.zeros(n, np.int64)
    marks[borders] = 1
    return np.cumsum(marks)


def _forest(start: np.ndarray, group: np.ndarray, fp: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of each group, rows sorted by group.

    Rows are compared with the row one further, then two, as long as groups reach.
    """
    n = len(fp)
    size = np.bincount(group)
    end = np.cumsum(size)[group]
    ring = segments(max_distance)
    masks = np.array([((1 << width) - 1) << first for first, width in ring], np.uint64)
    bits, root = fp.view(np.uint64), np.arange(n)
    u, v = [], []
    alive, lag = np.arange(n), 0
    while True:
        lag += 1
        alive = alive[alive + lag < end[alive]]
        if not len(alive):
            break
        pair = alive[root[alive] != root[alive + lag]]
        differ, spent = bits[pair] ^ bits[pair + lag], np.zeros(len(pair), np.int64)
        for i in range(len(ring)):
            spent = spent + np.bitwise_count(differ & masks[(start[pair] + i) % len(ring)])
            ok = spent <= i
            pair, differ, spent = pair[ok], differ[ok], spent[ok]
        pair = pair[np.bitwise_count(differ) <= max_distance]
        for a in pair.tolist():
            x, y = _find(root, a), _find(root, a + lag)
            if x != y:
                root[max(x, y)] = min(x, y)
                u.append(fp[a])
                v.append(fp[a + lag])
        if len(pair):
            while not np.array_equal(up := root[root], root):
                root = up
    return np.array(u, np.int64), np.array(v, np.int64)


def _find(root: np.ndarray, a: int) -> int:
    while root[a] != a:
        a = root[a]
    return int(a)


# -- the operator -----------------------------------------------------------


def fingerprint_groups(
    marked: DataFrame, id_col: str = "doc_id", max_distance: int = MAX_DISTANCE, depth: int = DEPTH, cell: int = CELL
) -> DataFrame:
    """(fp, component_id, kept) of the distinct fingerprints of ``marked`` (id, fp).

    ``component_id`` is the smallest id of the component (null if all its ids are);
    ``kept`` marks the one fingerprint of the component that holds it.
    """
    fps = cut(marked.groupBy("fp").agg(F.min(id_col).alias("first")))
    found = connected_components(simhash_links(fps, max_distance, depth, cell)).withColumnRenamed("node", "fp")
    named = fps.join(found, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    best = F.min(F.struct(F.col("first").isNull(), F.col("first"), F.col("fp")))
    heads = named.groupBy("component").agg(best.alias("best"))
    return named.join(heads, "component").select(
        "fp", F.col("best.first").alias("component_id"), (F.col("fp") == F.col("best.fp")).alias("kept")
    )


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_distance: int = MAX_DISTANCE,
    depth: int = DEPTH,
    cell: int = CELL,
) -> DataFrame:
    """(id, fp, component_id), one row per row of ``docs``.

    A null text is an empty one. Texts without a word have fingerprint zero and are
    linked like any other. Repeated rows stay, each with the same component. Rows
    with a null id keep it; the component's id is then the smallest other one. An
    empty table gives no rows; other columns are not looked at.
    """
    marked = cut(docs.select(F.col(id_col).alias("id"), fingerprint(text_col, shingle).alias("fp")))
    groups = fingerprint_groups(marked, "id", max_distance, depth, cell)
    return marked.join(groups.select("fp", "component_id"), "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_distance: int = MAX_DISTANCE,
    depth: int = DEPTH,
    cell: int = CELL,
) -> DataFrame:
    """The rows of ``docs`` with one row per component: that of the smallest id.

    Of repeated ids or rows one stays, the one whose text hashes lowest. The rows are
    stored with their fingerprints, which are computed once, so the pass that picks rows needs no
    Python. Each map task of it sends one row per fingerprint, however many copies it has read.
    """
    fp, rank = fresh(docs, "fp", "fp_rank")
    marked = store(docs.withColumn(fp, fingerprint(text_col, shingle)))
    light = cut(marked.select(F.col(id_col).alias("id"), F.col(fp).alias("fp")))
    kept = fingerprint_groups(light, "id", max_distance, depth, cell).filter("kept").select(F.col("fp").alias(fp))
    order = F.row_number().over(Window.partitionBy(fp).orderBy(F.col(id_col).asc_nulls_last(), F.xxhash64(text_col)))
    firsts = marked.withColumn(rank, order).filter(F.col(rank) == 1)
    return firsts.join(kept, fp, "left_semi").select(*docs.columns)


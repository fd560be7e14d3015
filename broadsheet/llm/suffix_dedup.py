"""Repeated strings of ``WINDOW`` bytes, by a depth-limited radix sort of suffixes.

Suffixes are told apart through their first ``WINDOW`` bytes only, in most-significant-digit
passes; suffixes that are equal after the last pass are exactly the repeated windows.

1. The first digit is the window's minimizer: the ``GRAM`` bytes in it that hash lowest, the
   leftmost of equals. Equal windows have the same one at the same place, and all
   windows that share one minimizer in a text follow each other and make a stretch, so a text
   sends a row per stretch and not per suffix: numbers only, among them a hash of the
   stretch. Minimizers that stand in one place of one text only end here. Stretches of a
   minimizer that are equal as a whole end here too, all their windows repeated; one of them
   stands for the others where the minimizer has stretches that equal no other.
2. What is left goes with its bytes to the task of its minimizer. The second digit is the
   minimizer's distance from the window's start; then follow the window's bytes, ``DIGIT`` at
   a time, each as a 64-bit number of its bytes. A suffix alone in its class drops out after
   each pass.
3. A minimizer with more than ``CELL`` different stretches does not go to one task: each of its
   windows becomes a row with a 128-bit hash, and Spark groups those.

Texts are told by a 128-bit hash, and copies of a text count as one from the start; equal
stretches are told by the 64-bit hashes of their minimizers and of themselves. The
text itself is shuffled once, for the two steps that read it. Joins are merge joins at any
size, so what is shuffled follows the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import cut, store

WINDOW = 400
GRAM = 100
DIGIT = 100
CELL = 32_768
_PART = 1 << 20
_PLACE_BITS = 21
_WINDOWS = 1 << 20
# Texts that a task knows again, so that it sends the stretches of copies once.
_KNOWN = 1 << 16
_EMPTY_SHA = hashlib.sha256(b"").digest()
_ANCHORS = {"gram": pa.int64(), "stretch": pa.int64(), "distance": pa.int32(), "first": pa.int32(), "last": pa.int32()}
_KEY = ["key_a", "key_b"]
_SPANS = "array<struct<first: long, last: long>>"


# -- hashes of runs of bytes ------------------------------------------------


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number per byte; powers of an odd number modulo 2**64 and their inverses."""
    base = 0x9E3779B97F4A7C15
    size = _PART + WINDOW + 1
    up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    numbers = np.random.default_rng(0).integers(0, 1 << 64, 256, np.uint64)
    return numbers, np.multiply.accumulate(up), np.multiply.accumulate(down)


def _prefix(data: np.ndarray) -> np.ndarray:
    numbers, up, _ = _powers()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(numbers[data] * up[: len(data)], out=sums[1:])
    return sums


def _run_hash(sums: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Equal for equal runs of ``size`` bytes, wherever they start."""
    h = (sums[starts + size] - sums[starts]) * _powers()[2][starts]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(29)


# -- first digit: minimizers ------------------------------------------------


def minimizers(text: bytes, window: int = WINDOW, gram: int = GRAM) -> list[np.ndarray]:
    """(hash, distance of the minimizer from the first window, first and last window start) by runs."""
    out = []
    for at in range(0, len(text) - window + 1, _PART):
        data = np.frombuffer(text, np.uint8)[at : at + _PART + window - 1]
        grams = _run_hash(_prefix(data), np.arange(len(data) - gram + 1), gram)
        low = np.uint64((1 << _PLACE_BITS) - 1)
        ranked = grams & ~low | np.arange(len(grams), dtype=np.uint64)
        place = (_sliding_min(ranked, window - gram + 1) & low).astype(np.int64)
        starts = np.concatenate(([0], np.flatnonzero(place[1:] != place[:-1]) + 1))
        ends = np.append(starts[1:], len(place)) - 1
        where = place[starts]
        out.append(np.stack((grams[where].view(np.int64), where - starts, at + starts, at + ends)))
    return out


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _scan(window: int, gram: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[tuple[int, int]] = set()
        for batch in batches:
            sizes, digests, parts, counts = [], [], [], [0]
            for text, *key in zip(batch.column("text"), *(batch.column(c).to_pylist() for c in _KEY)):
                data, found = text.as_py(), []
                if len(data) >= window and tuple(key) not in known:
                    if len(known) >= _KNOWN:
                        known.clear()
                    known.add(tuple(key))
                    found = [_with_hashes(data, m, window) for m in minimizers(data, window, gram)]
                parts += found
                sizes.append(len(data))
                digests.append(hashlib.sha256(data).digest())
                counts.append(counts[-1] + sum(p.shape[1] for p in found))
            rows = np.concatenate(parts, axis=1) if parts else np.empty((len(_ANCHORS), 0), np.int64)
            ends = pa.array(counts, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(c, t)) for c, t in zip(rows, _ANCHORS.values())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", *_KEY)), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), *lists],
                ["id", *_KEY, "n_bytes", "sha256", *_ANCHORS],
            )

    return scan


def _with_hashes(data: bytes, found: np.ndarray, window: int) -> np.ndarray:
    """The rows of ``minimizers`` with a hash of the stretch and the minimizer's place in it behind the first."""
    gram, distance, first, last = found
    runs = zip(first.tolist(), (last + window).tolist(), distance.tolist())
    stretch = np.array([xxhash.xxh3_64_intdigest(data[a:b], d) for a, b, d in runs], np.uint64).view(np.int64)
    return np.stack((gram, stretch, distance, first, last))


# -- the other digits -------------------------------------------------------


def _stretches(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """One row per minimizer of a text, with the bytes of its windows."""
    for batch in batches:
        keys, rows, data = [], [], []
        texts = zip(*(batch.column(c).to_pylist() for c in _KEY), batch.column("text"), batch.column("anchors").to_pylist())
        for key_a, key_b, text, anchors in texts:
            text, key = text.as_py(), (key_a, key_b)
            for a in anchors:
                keys.append(key)
                rows.append((a["gram"], a["places"], a["distance"], a["first"]))
                data.append(text[a["first"] : a["last"] + window])
            if len(rows) > 1 << 14:
                yield _stretch_batch(keys, rows, data)
                keys, rows, data = [], [], []
        if rows:
            yield _stretch_batch(keys, rows, data)


def _stretch_batch(keys: list, rows: list, data: list) -> pa.RecordBatch:
    gram, places, distance, first = zip(*rows)
    numbers = [pa.array(c, pa.int64()) for c in (gram, places, first, *zip(*keys))]
    return pa.RecordBatch.from_arrays(
        [*numbers, pa.array(distance, pa.int32()), pa.array(data, pa.binary())], ["gram", "places", "first", *_KEY, "distance", "data"]
    )


class _Stretch:
    __slots__ = ("gram", "distance", "key", "first", "data", "whole", "repeated")

    def __init__(self, gram, distance, key, first, data):
        self.gram, self.distance, self.key, self.first, self.data = gram, distance, key, first, data
        self.whole, self.repeated = False, None


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[_Stretch]]:
    """Whole groups of a minimizer from rows sorted by it, some groups at a time."""
    held, size = [], 0
    for batch in batches:
        gram, distance, key_a, key_b, first, data = (batch.column(c).to_pylist() for c in ("gram", "distance", *_KEY, "first", "data"))
        for row in map(_Stretch, gram, distance, zip(key_a, key_b), first, data):
            if size > _PART and row.gram != held[-1].gram:
                yield held
                held, size = [], 0
            held.append(row)
            size += len(row.data)
    if held:
        yield held


def _repeats(window: int, digit: int):
    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _sorted_groups(batches):
            mark_repeated(group, window, digit)
            yield _span_batch(group, window)

    return repeats


def mark_repeated(group: list[_Stretch], window: int, digit: int) -> None:
    """Set ``whole``, or ``repeated`` by window, of stretches; groups of a minimizer are whole."""
    first_of: dict[tuple, _Stretch] = {}
    members: dict[int, list[_Stretch]] = {}
    for s in group:
        twin = first_of.setdefault((s.gram, s.distance, s.data), s)
        if twin is s:
            members.setdefault(s.gram, []).append(s)
        else:
            s.whole = twin.whole = True
    ready, size = [], 0
    for own in members.values():
        if len(own) > 1:
            ready += own
            size += sum(len(s.data) - window + 1 for s in own)
        if size > _WINDOWS:
            _radix(ready, window, digit)
            ready, size = [], 0
    if ready:
        _radix(ready, window, digit)


def _radix(stretches: list[_Stretch], window: int, digit: int) -> None:
    """The passes, over a range of distances at a time so that few windows are at hand."""
    distance = np.array([s.distance for s in stretches])
    n = np.array([len(s.data) - window + 1 for s in stretches])
    gram = np.unique(np.array([s.gram for s in stretches]), return_inverse=True)[1]
    for s, k in zip(stretches, n):
        s.repeated = np.zeros(k, bool)
    lowest, highest = int((distance - n + 1).min()), int(distance.max())
    step = max(1, (highest - lowest + 1) * _WINDOWS // max(int(n.sum()), 1))
    for low in range(lowest, highest + 1, step):
        # windows whose minimizer is low..low+step-1 bytes from their start
        begin = np.maximum(distance - (low + step - 1), 0)
        end = np.minimum(distance - low + 1, n)
        _pass_range(stretches, distance, gram, begin, end, window, digit)


def _pass_range(stretches, distance, gram, begin, end, window, digit) -> None:
    owners, starts, classes, digits = [], [], [], []
    batch, size = [], 0

    def hashed():
        data = np.frombuffer(b"".join(stretches[i].data[begin[i] : end[i] + window - 1] for i in batch), np.uint8)
        sums, at = _prefix(data), 0
        where = []
        for i in batch:
            count = int(end[i] - begin[i])
            where.append(at + np.arange(count))
            owners.append(np.full(count, i))
            starts.append(np.arange(begin[i], end[i]))
            classes.append((gram[i] << 32) + distance[i] - np.arange(begin[i], end[i]))
            at += count + window - 1
        where = np.concatenate(where)
        digits.append(np.stack([_run_hash(sums, where + d, min(digit, window - d)) for d in range(0, window, digit)]))

    for i in range(len(stretches)):
        if end[i] <= begin[i]:
            continue
        length = int(end[i] - begin[i]) + window - 1
        if batch and size + length > _PART:
            hashed()
            batch, size = [], 0
        batch.append(i)
        size += length
    if batch:
        hashed()
    if not owners:
        return
    owner, start, group, digits = np.concatenate(owners), np.concatenate(starts), np.concatenate(classes), np.concatenate(digits, axis=1)
    left = np.arange(len(owner))
    for values in [None, *digits]:
        keys = (group[left],) if values is None else (values[left], group[left])
        order = np.lexsort(keys)
        new = np.concatenate(([True], np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0))) if len(order) else np.empty(0, bool)
        number = np.cumsum(new) - 1
        shared = np.bincount(number)[number] > 1 if len(order) else new
        group[left[order]] = number
        left = left[order[shared]]
    for i, place in zip(owner[left].tolist(), start[left].tolist()):
        stretches[i].repeated[place] = True


def _span_batch(group: list[_Stretch], window: int) -> pa.RecordBatch:
    keys, firsts, lasts = [], [], []
    for s in group:
        if s.whole:
            runs = [(0, len(s.data) - window)]
        elif s.repeated is None:
            continue
        else:
            edges = np.flatnonzero(np.diff(np.concatenate(([0], s.repeated.view(np.int8), [0]))))
            runs = zip(edges[::2].tolist(), (edges[1::2] - 1).tolist())
        for a, b in runs:
            keys.append(s.key)
            firsts.append(s.first + a)
            lasts.append(s.first + b + window)
    key_a, key_b = zip(*keys) if keys else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (key_a, key_b, firsts, lasts)], [*_KEY, "first", "last"])


def _windows(window: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key_a, key_b, first, data in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "first", "data"))):
                n = len(data) - window + 1
                hashes = [xxhash.xxh3_128_digest(data[i : i + window]) for i in range(n)]
                numbers = [pa.array(c, pa.int64()) for c in ([key_a] * n, [key_b] * n, range(first, first + n))]
                yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.binary()), *numbers], ["hash", *_KEY, "first"])

    return windows


# -- the operator -----------------------------------------------------------


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, digit: int = DIGIT, cell: int = CELL
) -> DataFrame:
    """(id, n_bytes, spans, kept_sha256), one row per row of ``docs``.

    ``spans`` are the maximal runs (first, last) of bytes, ``last`` exclusive, that some string of
    ``window`` bytes covers which also starts elsewhere, in the same text or another; overlaps
    count. ``kept_sha256`` is of the other bytes. A null text is an empty one; a text shorter
    than ``window`` keeps everything; a repeated row of ``window`` bytes or more loses
    everything, as its copy does. Null ids stay null. An empty table gives no rows.
    """
    if not 0 < gram <= window:
        raise ValueError("gram must be in 1..window")
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8")
    keyed = docs.select(F.col(id_col).alias("id"), text.alias("text")).select(
        "*", F.xxhash64("text").alias("key_a"), F.xxhash64(F.lit(1), "text").alias("key_b")
    )
    kind = keyed.schema["id"].dataType.simpleString()
    lists = "gram array<long>, stretch array<long>, distance array<int>, first array<int>, last array<int>"
    scan = store(keyed.mapInArrow(_scan(window, gram), f"id {kind}, key_a long, key_b long, n_bytes long, sha256 binary, {lists}"))
    shared = store(shared_stretches(scan.select(*_KEY, F.inline(F.arrays_zip(*_ANCHORS)))))
    sent = shared.filter("sent")
    # of one text, so no longer than the text
    entries = F.collect_list(F.struct("gram", "places", "distance", "first", "last")).alias("anchors")
    anchors = sent.groupBy(*_KEY).agg(entries)
    texts = keyed.select(*_KEY, "text").dropDuplicates(_KEY)

    stretches = texts.join(anchors.hint("merge"), _KEY).mapInArrow(
        lambda batches: _stretches(batches, window), "gram long, places long, first long, key_a long, key_b long, distance int, data binary"
    )
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    span = "key_a long, key_b long, first long, last long"
    few = stretches.filter(F.col("places") <= cell).drop("places").repartition(n, "gram").sortWithinPartitions("gram")
    spans = few.mapInArrow(_repeats(window, digit), span)
    if sent.filter(F.col("places") > cell).limit(1).count():
        many = stretches.filter(F.col("places") > cell)
        windows = cut(many.mapInArrow(_windows(window), "hash binary, key_a long, key_b long, first long"))
        place = F.struct(*_KEY, "first")
        again = windows.groupBy("hash").agg(F.min(place).alias("a"), F.max(place).alias("b")).filter("a < b").select("hash")
        more = windows.join(again, "hash", "left_semi").select(*_KEY, "first", (F.col("first") + window).alias("last"))
        spans = spans.unionByName(more)

    spans = spans.unionByName(shared.filter("whole").select(*_KEY, F.col("first").cast("long"), (F.col("last") + window).cast("long").alias("last")))
    by_text = spans.groupBy(*_KEY).agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    kept = texts.join(by_text.hint("merge"), _KEY).mapInArrow(_kept, f"key_a long, key_b long, spans {_SPANS}, kept_sha256 binary")
    copies = scan.groupBy(*_KEY).agg(F.count("*").alias("copies"))
    by_key = copies.join(kept.hint("merge"), _KEY, "left")
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= window)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n_bytes").alias("last")))
    kept_sha = F.lower(F.hex(F.when(gone, F.lit(_EMPTY_SHA)).otherwise(F.coalesce("kept_sha256", "sha256"))))
    return scan.select("id", *_KEY, "n_bytes", "sha256").join(by_key.hint("merge"), _KEY).select(
        F.col("id").alias(id_col),
        "n_bytes",
        F.when(gone, whole).otherwise(F.coalesce("spans", F.array().cast(_SPANS))).alias("spans"),
        kept_sha.alias("kept_sha256"),
    )


def shared_stretches(places: DataFrame) -> DataFrame:
    """Rows of ``places`` whose gram stands in more than one place, copies of a text as one, with three columns.

    ``whole``: an equal stretch stands in another place. ``sent``: its bytes are needed, as it is unlike all others or
    stands for those equal to it beside such a one. ``places``: how many rows of the gram are sent.
    """
    gram, stretch = Window.partitionBy("gram"), Window.partitionBy("gram", "stretch")
    alike, nth = F.count("*").over(stretch), F.row_number().over(stretch.orderBy(*_KEY, "first"))
    rows = places.repartition("gram").distinct().withColumn("nth", nth).withColumn("alike", alike)
    rows = rows.withColumn("all", F.count("*").over(gram)).withColumn("lone", F.count(F.when(F.col("alike") == 1, 1)).over(gram))
    rows = rows.filter("all > 1").withColumn("whole", F.col("alike") > 1).withColumn("sent", F.expr("lone > 0 AND nth = 1"))
    rows = rows.withColumn("places", F.count(F.when(F.col("sent"), 1)).over(gram))
    return rows.filter("whole OR sent").select(*_KEY, "gram", "distance", "first", "last", "whole", "sent", "places")


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of a text as disjoint runs, and the hash of what stands between them."""
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    for batch in batches:
        runs, digests = [], []
        for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist()):
            text, at, own, rest = text.as_py(), 0, [], hashlib.sha256()
            for first, last in sorted((s["first"], s["last"]) for s in spans):
                if own and first <= own[-1]["last"]:
                    own[-1]["last"] = max(own[-1]["last"], last)
                else:
                    own.append({"first": first, "last": last})
            for run in own:
                rest.update(text[at : run["first"]])
                at = run["last"]
            rest.update(text[at:])
            runs.append(own)
            digests.append(rest.digest())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in _KEY), pa.array(runs, kind), pa.array(digests, pa.binary())], [*_KEY, "spans", "kept_sha256"]
        )

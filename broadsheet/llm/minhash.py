"""MinHash near-duplicates: an inverted join on coordinates of signatures.

1. A text's set is its distinct shingles, its signature the least value of each of ``coordinates`` hash functions.
   Equal texts are one text from here on.
2. Texts are posted under pairs of (coordinate, value). The coordinates are dealt over matches - 1 groups: two
   signatures that agree in ``matches`` of them agree in two of one group, so only the pairs inside a group are posted.
   Only postings that two texts share go on. Their
   texts, in the order of their sets' sizes, are compared; a pair is skipped if the sizes alone rule it out, if both texts are linked already,
   if the parities of the shingles in 64 buckets differ too often for sets that alike, or if of ``CHECKED`` coordinates the last
   bits or the last bytes agree too seldom. A posting gives a
   spanning forest. One that many texts share is dealt over cells of bounded size; more than a few cells share some of its texts as pivots, and what the pivots
   leave apart is then compared with the whole posting, cell by cell.
3. The forests' components are candidate clusters: every pair above the bound lies inside one. The
   texts of a cluster, no others, are read again and compared on whole sets, by an index of their
   shingles. A large cluster is dealt over blocks that share some of its texts as pivots; what the
   pivots leave apart is then compared with the whole cluster, block by block.

Pairs at similarity 0.8 agree in fewer than 6 of 20 coordinates in 2 of 10 million cases, and each of the tests on all coordinates
loses 1 of 100 million; the parities lose none. Links are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import cut, utf8, word_blocks
from broadsheet.llm.components import connected_components

SHINGLE = 2
PERCENT = 80
COORDINATES = 20
MATCHES = 6
# Coordinates that candidates are tested on, the posted ones among them, and the share of links that a test may lose.
CHECKED = 64
LOST = 1e-8

# Texts of a posting's cell, cells that meet in pairs, shingles of a cluster's block, and texts that all cells of a posting and all blocks of a cluster share.
CELL = 2048
FEW_CELLS = 4
BLOCK_SHINGLES = 200_000
PIVOTS = 8

# Links left of all tasks' forests that one task still joins; more are joined by all.
ONE_TASK_LINKS = 1 << 20

_KEY = ["key_a", "key_b"]
_LINK = "u long, v long"


# -- sets and signatures ----------------------------------------------------


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = number = xxhash.xxh3_64_intdigest(word)
        return number


def shingle_set(text: bytes | None, shingle: int, hashes: WordHashes) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; of fewer words, the sequence is the one shingle."""
    parts, held = [], np.empty(0, np.uint64)
    for words in word_blocks((text or b"").lower()):
        ids = np.concatenate((held, np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))))
        held = ids[max(0, len(ids) - shingle + 1) :] if shingle > 1 else ids[:0]
        if len(ids) >= shingle:
            parts.append(np.unique(_runs(ids, shingle)))
    if parts:
        return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
    return _runs(held, len(held)) if len(held) else held


def _runs(ids: np.ndarray, size: int) -> np.ndarray:
    n = len(ids) - size + 1
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = (out ^ ids[i : i + n]) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(32)
    return out


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """The least 32-bit value of the shingles under each hash function."""
    factors = np.random.default_rng(13).integers(0, 1 << 63, coordinates, np.uint64) * np.uint64(2) + np.uint64(1)
    shift = np.uint64(32)
    if coordinates * len(shingles) <= 1 << 16:
        return ((shingles * factors[:, None]) >> shift).min(axis=1).astype(np.uint32)
    return np.array([((shingles * f) >> shift).min() for f in factors], np.uint32)


def parities(shingles: np.ndarray) -> int:
    """Whether the number of shingles is odd, for 64 buckets of shingles; sets differ in no fewer shingles than bits."""
    return int(np.bitwise_xor.reduce(np.uint64(1) << (shingles & np.uint64(63))).view(np.int64))


def least_agreeing(n: int, chance: float) -> int:
    """The most that ``n`` coordinates of one ``chance`` reach in all but ``LOST`` of cases."""
    lost, m = (1 - chance) ** n, 0
    while lost <= LOST and m < n:
        m += 1
        lost += comb(n, m) * chance**m * (1 - chance) ** (n - m)
    return m


def _signatures(shingle: int, coordinates: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, values, short, odd = [], [], [], []
            for text in utf8(batch.column("text")):
                found = shingle_set(text.as_py(), shingle, hashes)
                sizes.append(len(found))
                own = signature(found, max(coordinates, CHECKED)) if len(found) else np.empty(0, np.uint32)
                values.append(own[:coordinates].view(np.int32))
                short.append((own[:CHECKED] & 255).astype(np.uint8).tobytes())
                odd.append(parities(found))
            columns = [pa.array(sizes, pa.int64()), pa.array(values, pa.list_(pa.int32())), pa.array(short, pa.binary()), pa.array(odd, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", *_KEY)), *columns], ["id", *_KEY, "n_shingles", "sig", "short", "odd"]
            )

    return run


# -- candidates -------------------------------------------------------------


def posted_coordinates(coordinates: int, matches: int) -> list[tuple[int, ...]]:
    """Runs of coordinates, of which signatures that agree in ``matches`` coordinates agree in one."""
    if matches < 3:
        return [(i,) for i in range(coordinates - matches + 1)]
    return [pair for group in np.array_split(np.arange(coordinates), matches - 1) for pair in combinations(group.tolist(), 2)]


def candidate_links(
    signed: DataFrame, coordinates: int, matches: int, percent: int, cell: int = CELL, pivots: int = PIVOTS
) -> DataFrame:
    """(u, v) links that connect the ``node``s whose signatures agree in ``matches`` coordinates and whose sets may be similar.

    Sets of which one has less than ``percent`` of the other's ``n_shingles``, or that ``odd`` tells apart, cannot be similar and are not linked.

    ``sig`` holds the values, ``short`` the last byte of each of ``CHECKED`` coordinates: of two texts, those that agree are
    counted by it, so chance may add a link but only ``LOST`` of them are lost.
    """
    keys = [F.xxhash64(F.lit(i), *(F.get("sig", F.lit(c)) for c in own)) for i, own in enumerate(posted_coordinates(coordinates, matches))]
    posted = signed.select("node", F.explode(F.array(*keys)).alias("posting"))
    sizes = posted.groupBy("posting").agg(F.count("*").alias("n")).filter("n > 1")
    shared = cut(posted.join(sizes, "posting"))
    sets = signed.select("node", "n_shingles", "short", "odd")
    n = int(signed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    enough = least_agreeing(CHECKED, percent / 100)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["posting", "cell"]):
            group, node, size, odd, label = (rows.column(c).to_numpy() for c in ("group", "node", "n_shingles", "odd", "label"))
            short = np.frombuffer(b"".join(rows.column("short").to_pylist()), np.uint8).reshape(len(node), CHECKED)
            u, v = _forest(group, node, size, short, enough, percent, odd, None if np.array_equal(label, node) else label)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    def linked_in(cells: Column, rows: DataFrame) -> DataFrame:
        dealt = rows.join(sets, "node").select("posting", "node", "label", "n_shingles", "short", "odd", F.explode(cells).alias("cell"))
        return dealt.repartition(n, "posting", "cell").sortWithinPartitions("posting", "cell").mapInArrow(link, _LINK)

    parts = F.ceil(F.col("n") / cell)
    own = F.pmod(F.xxhash64("node"), parts)
    everywhere = F.sequence(F.lit(0).cast("long"), parts - 1)
    # few cells: each pair of them meets at once
    paired = F.transform(everywhere, lambda j: F.least(own, j) * parts + F.greatest(own, j))
    pivot = F.pmod(F.xxhash64("posting", "node"), F.col("n")) < pivots
    cells = F.when(parts <= FEW_CELLS, paired).when(pivot, everywhere).otherwise(F.array(own))
    links = linked_in(cells, shared.withColumn("label", F.col("node")))
    crowded = shared.filter(parts > FEW_CELLS)
    if crowded.isEmpty():
        return links

    # what is not in the largest group of its posting meets the whole posting, cell by cell
    links = cut(links)
    labelled = crowded.join(components_of(links), "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
    by_label = labelled.groupBy("posting", "label").agg(F.count("*").alias("size"))
    main = by_label.groupBy("posting").agg(F.max(F.struct("size", "label")).alias("main"))
    split = labelled.join(main, "posting").withColumn("columns", F.ceil((F.col("n") - F.col("main.size")) / cell)).filter("columns > 0")
    column = F.pmod(F.xxhash64(F.lit(3), "node"), F.col("columns"))
    to_rows = F.transform(F.sequence(F.lit(0).cast("long"), F.col("columns") - 1), lambda j: own * F.col("columns") + j)
    to_columns = F.transform(everywhere, lambda i: i * F.col("columns") + column)
    crossed = F.when(F.col("label") == F.col("main.label"), to_rows).otherwise(F.array_union(to_rows, to_columns))
    split = split.select("posting", "node", "label", crossed.alias("cells"))
    return links.unionByName(linked_in(F.col("cells"), split))


def whole_groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``key`` in slices that hold whole groups, with their number as ``group``."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        rows = rows.combine_chunks()
        if not len(rows):
            continue
        values = [rows.column(c).to_numpy() for c in key]
        new = np.flatnonzero(np.any([v[1:] != v[:-1] for v in values], axis=0)) + 1
        last = int(new[-1]) if len(new) else 0
        if last:
            yield _numbered(rows.slice(0, last), new[:-1])
        held = rows.slice(last)
    if held is not None:
        yield _numbered(held, np.empty(0, np.int64))


def _numbered(rows: pa.Table, borders: np.ndarray) -> pa.RecordBatch:
    marks = np.zeros(len(rows), np.int64)
    marks[borders] = 1
    return rows.append_column("group", pa.array(np.cumsum(marks))).combine_chunks().to_batches()[0]


def _forest(
    group: np.ndarray, node: np.ndarray, size: np.ndarray, short: np.ndarray, matches: int, percent: int,
    odd: np.ndarray | None = None, label: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of each group's pairs above the bound; rows are sorted by group.

    With ``odd``, the parities of the sets, pairs that they tell apart are left out, and those whose last bits agree too seldom.
    Rows of one ``label`` are linked already.
    """
    n, coordinates = short.shape
    # by size, and among equals alike signatures side by side
    order = np.lexsort((short[:, 1], short[:, 0], size, group))
    group, node, size, short = group[order], node[order], size[order], short[order]
    if odd is not None:
        odd, last = odd[order].view(np.uint64), np.packbits(short & 1, axis=1).view(np.uint64)
        unlike = coordinates - least_agreeing(coordinates, (100 + percent) / 200)
    end = np.cumsum(np.bincount(group))[group]
    root, u, v = np.arange(n), [], []
    if label is not None:
        first, where = np.unique(np.stack((group, label[order])), axis=1, return_index=True, return_inverse=True)[1:]
        root = first[where]
    alive, lag = np.arange(n), 0
    while True:
        lag += 1
        alive = alive[alive + lag < end[alive]]
        alive = alive[100 * size[alive] >= percent * size[alive + lag]]
        if not len(alive):
            break
        pair = alive[root[alive] != root[alive + lag]]
        for at in range(0, len(pair), 1 << 17):
            some = pair[at : at + (1 << 17)]
            if odd is not None:
                some = some[np.bitwise_count(last[some] ^ last[some + lag]).sum(axis=1) <= unlike]
                differ = np.bitwise_count(odd[some] ^ odd[some + lag]).astype(np.int64)
                some = some[(100 + percent) * differ <= (100 - percent) * (size[some] + size[some + lag])]
            half = matches + coordinates >> 1
            same = (short[some, :half] == short[some + lag, :half]).sum(axis=1)
            ok = same + coordinates - half >= matches
            some, same = some[ok], same[ok] + (short[some[ok], half:] == short[some[ok] + lag, half:]).sum(axis=1)
            for a in some[same >= matches].tolist():
                x, y = _find(root, a), _find(root, a + lag)
                if x != y:
                    root[max(x, y)] = min(x, y)
                    u.append(node[a])
                    v.append(node[a + lag])
        if len(pair):
            while not np.array_equal(up := root[root], root):
                root = up
    return np.array(u, np.int64), np.array(v, np.int64)


def _find(root: np.ndarray | list, a: int) -> int:
    while root[a] != a:
        a = root[a]
    return int(a)


# -- components -------------------------------------------------------------


def components_of(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links``; a component is its smallest node.

    Every task first keeps a spanning forest of its own links, and what many tasks found counts once. A few forests are joined in one task, which spares
    the rounds that many need; both ways give the same rows.
    """
    forests = cut(links.mapInArrow(_spanning, _LINK).distinct())
    if forests.count() > ONE_TASK_LINKS:
        return connected_components(forests)
    return forests.coalesce(1).mapInArrow(_stars, "node long, component long")


def _spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    u, v = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        u, v = (np.concatenate((a, batch.column(c).to_numpy())) for a, c in ((u, "u"), (v, "v")))
        if len(u) > ONE_TASK_LINKS:
            u, v = _stars_of(u, v)
            if 2 * len(u) > ONE_TASK_LINKS:
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
                u, v = u[:0], v[:0]
    u, v = _stars_of(u, v)
    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
    if parts:
        least, node = _stars_of(*map(np.concatenate, zip(*parts)))
        own = np.unique(least)
        node, least = np.concatenate((node, own)), np.concatenate((least, own))
        for at in range(0, len(node), 1 << 16):
            columns = [pa.array(c[at : at + (1 << 16)]) for c in (node, least)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "component"])


def _stars_of(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(smallest node, node) of every other node of each component."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    root = list(range(len(nodes)))
    for a, b in zip(at[: len(u)].tolist(), at[len(u) :].tolist()):
        while root[a] != a:
            root[a] = a = root[root[a]]
        while root[b] != b:
            root[b] = b = root[root[b]]
        root[max(a, b)] = min(a, b)
    least = np.array(root, np.int64)
    while not np.array_equal(up := least[least], least):
        least = up
    other = np.flatnonzero(least != np.arange(len(nodes)))
    return nodes[least[other]], nodes[other]


# -- links on whole sets ----------------------------------------------------


class _Index:
    """Postings of the shingles of some sets."""

    def __init__(self, sets: list[np.ndarray], rows: np.ndarray):
        self.rows, self.sizes = rows, np.array([len(sets[r]) for r in rows], np.int64)
        shingles = np.concatenate([sets[r] for r in rows]) if len(rows) else np.empty(0, np.uint64)
        order = np.argsort(shingles, kind="stable")
        self.shingles, self.owner = shingles[order], np.repeat(np.arange(len(rows)), self.sizes)[order]

    def alike(self, own: np.ndarray, percent: int) -> np.ndarray:
        """The rows whose set is similar to ``own``."""
        first, last = np.searchsorted(self.shingles, own, "left"), np.searchsorted(self.shingles, own, "right")
        n = last - first
        at = np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        common = np.bincount(self.owner[at], minlength=len(self.rows))
        return self.rows[100 * common >= percent * (len(own) + self.sizes - common)]


def linked(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the similar pairs."""
    left = np.ones(len(sets), bool)
    index, out = _Index(sets, np.arange(len(sets))), []
    for first in range(len(sets)):
        queue = [first] if left[first] else []
        left[first] = False
        while queue:
            # what is linked already leaves the index once it is half of it
            if 2 * np.count_nonzero(left[index.rows]) <= len(index.rows):
                index = _Index(sets, index.rows[left[index.rows]])
            if not len(index.rows):
                return out
            a = queue.pop()
            found = index.alike(sets[a], percent)
            for b in found[left[found]].tolist():
                left[b] = False
                queue.append(b)
                out.append((a, b))
    return out


def _block_links(shingle: int, percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for rows in _slices(batches, ["cluster", "block"]):
            node = rows.column("node").to_numpy()
            sets = [shingle_set(t.as_py(), shingle, hashes) for t in utf8(rows.column("text"))]
            yield _link_batch([(node[a], node[b]) for a, b in linked(sets, percent)])

    return run


def _cross_links(shingle: int, percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for rows in _slices(batches, ["cluster", "block"]):
            node, label, apart = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("node", "label", "apart"))
            sets = [shingle_set(t.as_py(), shingle, hashes) for t in utf8(rows.column("text"))]
            index, root, out = _Index(sets, np.flatnonzero(~apart)), {x: x for x in label.tolist()}, []
            for a in np.flatnonzero(apart).tolist():
                for b in index.alike(sets[a], percent).tolist():
                    x, y = _find(root, label[a]), _find(root, label[b])
                    if x != y:
                        root[max(x, y)] = min(x, y)
                        out.append((node[a], node[b]))
            yield _link_batch(out)

    return run


def _slices(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.RecordBatch]:
    """One group at a time."""
    for rows in whole_groups(batches, key):
        group = rows.column("group").to_numpy()
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(group)]):
            yield rows.slice(a, b - a)


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    u, v = zip(*links) if links else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def exact_links(
    texts: DataFrame, shingle: int, percent: int, block_shingles: int = BLOCK_SHINGLES, pivots: int = PIVOTS
) -> DataFrame:
    """(u, v) links that connect what is similar inside the clusters of (cluster, node, n_shingles, text).

    The node that gives a cluster its name is one of its pivots.
    """
    spark = texts.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    totals = texts.groupBy("cluster").agg(F.sum("n_shingles").alias("total"), F.count("*").alias("members"))
    blocks = cut(totals.select("cluster", "members", F.ceil(F.col("total") / block_shingles).alias("blocks")))
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    pivot = (F.col("node") == F.col("cluster")) | (F.pmod(F.xxhash64(F.lit(7), "node"), F.col("members")) < pivots)
    everywhere = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    sized = texts.join(blocks, "cluster")
    dealt = sized.select("cluster", "node", "text", F.explode(F.when(pivot, everywhere).otherwise(F.array(own))).alias("block"))
    dealt = dealt.repartition(n, "cluster", "block").sortWithinPartitions("cluster", "block")
    links = cut(dealt.mapInArrow(_block_links(shingle, percent), _LINK))
    large = blocks.filter("blocks > 1")
    if large.isEmpty():
        return links

    # what is not in the largest group of its cluster meets the whole cluster, block by block
    groups = components_of(links)
    members = texts.join(large, "cluster").join(groups, "node", "left")
    members = cut(members.select("cluster", "node", "n_shingles", "blocks", F.coalesce("component", "node").alias("label")))
    by_label = members.groupBy("cluster", "label").agg(F.count("*").alias("size"))
    main = by_label.groupBy("cluster").agg(F.max(F.struct("size", "label")).alias("main")).select("cluster", F.col("main.label").alias("main"))
    split = members.join(main, "cluster").withColumn("apart", F.col("label") != F.col("main"))
    parts = split.filter("apart").groupBy("cluster").agg(F.ceil(F.sum("n_shingles") / block_shingles).alias("parts"))
    placed = split.drop("n_shingles").join(parts, "cluster").join(texts.select("node", "text"), "node")
    part = F.pmod(F.xxhash64(F.lit(3), "node"), F.col("parts"))
    to_rows = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda j: own * F.col("parts") + j)
    to_columns = F.transform(everywhere, lambda i: i * F.col("parts") + part)
    columns = ["cluster", "node", "label", "text"]
    crossed = placed.select(*columns, F.lit(False).alias("apart"), F.explode(to_rows).alias("block")).unionByName(
        placed.filter("apart").select(*columns, "apart", F.explode(to_columns).alias("block"))
    )
    crossed = crossed.repartition(n, "cluster", "block").sortWithinPartitions("cluster", "block")
    return links.unionByName(crossed.mapInArrow(_cross_links(shingle, percent), _LINK))


# -- the operator -----------------------------------------------------------


def minhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    coordinates: int = COORDINATES,
    matches: int = MATCHES,
    cell: int = CELL,
    block_shingles: int = BLOCK_SHINGLES,
    pivots: int = PIVOTS,
) -> DataFrame:
    """(id, n_shingles, component_id, kept), one row per row of ``docs``.

    Texts with 100 * common shingles >= ``percent`` * all shingles are linked; a component goes by its smallest id.
    Null texts and texts without a word have no shingle and are linked with nothing, copies of
    them neither. Repeated rows stay, each with the same component. A row with a null id
    has the smallest other id of its component, null if there is none, and is never ``kept``. An empty
    table gives no rows; other columns are not looked at.
    """
    if not 0 < matches <= coordinates:
        raise ValueError("matches must be in 1..coordinates")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), text.alias("text")).select(
        "*", F.xxhash64("text").alias("key_a"), F.xxhash64(F.lit(1), "text").alias("key_b")
    )
    kind = keyed.schema["id"].dataType.simpleString()
    schema = f"id {kind}, key_a long, key_b long, n_shingles long, sig array<int>, short binary, odd long"
    scan = cut(keyed.mapInArrow(_signatures(shingle, coordinates), schema))
    light = scan.select("id", *_KEY, "n_shingles")

    own = scan.filter("n_shingles > 0").groupBy(*_KEY)
    folded = own.agg(F.min("id").alias("least"), *(F.first(c).alias(c) for c in ("n_shingles", "sig", "short", "odd")))
    # numbered once: the stored rows keep their numbers
    classes = cut(folded.withColumn("node", F.monotonically_increasing_id()))

    clusters = components_of(candidate_links(classes, coordinates, matches, percent, cell, pivots))
    named = classes.select("node", "n_shingles", *_KEY).join(clusters.withColumnRenamed("component", "cluster"), "node")
    texts = keyed.select(*_KEY, "text").join(named, _KEY).groupBy("node", "cluster", "n_shingles").agg(F.first("text").alias("text"))
    found = components_of(exact_links(cut(texts), shingle, percent, block_shingles, pivots))

    labelled = classes.select("node", "least", *_KEY).join(found, "node", "left").withColumn("label", F.coalesce("component", "node"))
    firsts = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    by_text = labelled.join(firsts, "label").select(*_KEY, "component_id")
    out = light.join(by_text, _KEY, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select("id", "n_shingles", component.alias("component_id")).select(
        F.col("id").alias(id_col), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    )

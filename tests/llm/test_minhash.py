import math
import random
import re

import numpy as np
import pytest

from broadsheet.llm import common, minhash
from broadsheet.llm.queries import QUERIES

LOWER = {i: i + 32 for i in range(65, 91)}


def plain_set(text, shingle=2):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + shingle]) for i in range(len(words) - shingle + 1)) or frozenset([tuple(words)])


def plain(rows, shingle=2, percent=80):
    """(n_shingles, component) of every (id, text), by comparing all that share a shingle."""
    sets = [plain_set(text, shingle) for _, text in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    seen, first = {}, {}
    for a, own in enumerate(sets):
        twin = first.setdefault(own, a) if own else a
        if twin != a:
            root[find(a)] = find(twin)
            continue
        common_with = {}
        for s in own:
            for b in seen.setdefault(s, []):
                common_with[b] = common_with.get(b, 0) + 1
            seen[s].append(a)
        for b, n in common_with.items():
            if 100 * n >= percent * (len(own) + len(sets[b]) - n):
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if sets[a] and i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    return [(i, len(sets[a]), least.get(find(a)) if sets[a] else i) for a, (i, _) in enumerate(rows)]


def found(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr)


def test_query_equals_brute_force(spark, sf, documents):
    query = QUERIES["op13_minhash_near_dedup"](spark, sf)
    assert query.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    want = sorted(plain([(d.doc_id, d.text) for d in documents.values()]), key=repr)
    assert found(query) == want and any(i != c for i, _, c in want)


@pytest.fixture(scope="module")
def crowd():
    """A chain of small edits, a crowd around one text, families that only look alike, short texts, copies."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = [[word() for _ in range(60)]]
    for _ in range(150):
        own = list(rng.choice(texts[-10:]))
        for _ in range(rng.randint(1, 4)):
            own[rng.randrange(60)] = word()
        texts.append(own)
    frame = [word() for _ in range(42)]
    texts += [frame + [word() for _ in range(rng.choice([9, 10, 11, 14]))] for _ in range(80)]
    texts += [[rng.choice("ab") for _ in range(rng.randint(0, 5))] for _ in range(60)]
    texts += [["one", "very", "common", "line"] * 5 + [word() for _ in range(rng.randint(0, 3))] for _ in range(60)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(1000 + i, rows[i % 7][1].upper()) for i in range(60)] + rows[:5] + [(None, rows[3][1]), (None, "lonely text"), (None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    ("shingle", "percent", "cell", "block", "pivots"), [(2, 80, 2048, 200_000, 8), (2, 80, 7, 300, 2), (2, 80, 3, 900, 1), (1, 60, 16, 500, 0), (3, 90, 5, 100, 3)]
)
def test_cells_and_blocks_lose_no_link(spark, crowd, shingle, percent, cell, block, pivots):
    docs = spark.createDataFrame(crowd, "doc_id long, text string").repartition(3)
    got = minhash.minhash_components(docs, shingle=shingle, percent=percent, cell=cell, block_shingles=block, pivots=pivots, matches=5, coordinates=24)
    assert found(got) == sorted(plain(crowd, shingle, percent), key=repr)


def test_forest_equals_comparing_all():
    rng = np.random.default_rng(1)
    short = rng.integers(0, 3, (200, 8)).astype(np.uint8)
    group = np.sort(rng.integers(0, 4, 200))
    node = rng.permutation(200)
    size = rng.integers(5, 12, 200)
    u, v = minhash._forest(group, node, size, short, 5, 80)
    of = {int(n): i for i, n in enumerate(node)}

    def classes(pairs):
        root = list(range(200))
        for a, b in pairs:
            x, y = minhash._find(root, a), minhash._find(root, b)
            root[max(x, y)] = min(x, y)
        return [minhash._find(root, i) for i in range(200)]

    all_pairs = [(a, b) for a in range(200) for b in range(a) if group[a] == group[b] and (short[a] == short[b]).sum() >= 5 and min(size[a], size[b]) >= 0.8 * max(size[a], size[b])]
    assert classes([(of[int(a)], of[int(b)]) for a, b in zip(u, v)]) == classes(all_pairs)
    assert len(u) == 200 - len(set(classes(all_pairs)))


def test_components_in_one_task_and_in_many(spark, monkeypatch):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(260, 200, -1)] + [(9, 9), (7, 201)]
    want = {(i, 100) for i in range(100, 141)} | {(i, 7) for i in range(201, 261)} | {(7, 7)}
    frame = spark.createDataFrame(links, "u long, v long").repartition(3)
    assert {tuple(r) for r in minhash.components_of(frame).collect()} == want
    assert minhash.components_of(frame.limit(0)).collect() == []
    monkeypatch.setattr(minhash, "ONE_TASK_LINKS", 5)
    assert {tuple(r) for r in minhash.components_of(frame).collect()} == want


def test_long_text_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 977} v{i % 31}" for i in range(3000)).encode()
    hashes = minhash.WordHashes()
    whole = minhash.shingle_set(text, 2, hashes)
    monkeypatch.setattr(minhash, "word_blocks", lambda data: common.word_blocks(data, 100))
    assert np.array_equal(minhash.shingle_set(text, 2, hashes), whole) and len(whole) == len(plain_set(text.decode()))
    assert len(minhash.shingle_set(b"one", 2, hashes)) == 1 and len(minhash.shingle_set(b" \n", 2, hashes)) == 0
    big = np.arange(200_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    parts = np.minimum.reduce([minhash.signature(p, 20) for p in np.array_split(big, 100)])
    assert np.array_equal(minhash.signature(big, 20), parts)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    assert found(minhash.minhash_components(odd_docs)) == sorted(plain([r[:2] for r in odd_rows]), key=repr)
    assert minhash.minhash_components(no_docs).collect() == []
    with pytest.raises(ValueError, match="matches"):
        minhash.minhash_components(no_docs, matches=0)


def test_posted_coordinates_miss_no_agreement():
    rng = random.Random(3)
    for coordinates, matches in ((20, 6), (24, 5), (7, 3), (6, 6), (9, 2), (5, 1)):
        posted = minhash.posted_coordinates(coordinates, matches)
        assert len(set(posted)) == len(posted)
        for _ in range(300):
            agree = set(rng.sample(range(coordinates), matches))
            assert any(agree.issuperset(own) for own in posted)
    assert len(minhash.posted_coordinates(20, 6)) == 30


def test_tests_of_candidates_lose_no_link():
    rng = np.random.default_rng(7)
    for n in (1, 4, 9, 40, 300, 2000):
        a = rng.integers(0, 1 << 63, n, np.uint64)
        for common in range(n * 4 // 5, n + 1):
            b = np.concatenate((a[:common], rng.integers(0, 1 << 63, n - common, np.uint64)))
            differ = (minhash.parities(a) ^ minhash.parities(b)) & (1 << 64) - 1
            assert differ.bit_count() <= 2 * (n - common)
    for chance in (0.6, 0.8, 0.9):
        m = minhash.least_agreeing(64, chance)
        below = lambda k: sum(math.comb(64, i) * chance**i * (1 - chance) ** (64 - i) for i in range(k))
        assert below(m) <= minhash.LOST < below(m + 1)
    assert minhash.least_agreeing(64, 1.0) == 64


def test_texts_that_only_look_alike_are_no_candidates(spark):
    """Sets with a third in common agree in some coordinates; a cluster of them all would be compared pair by pair."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(5))
    texts = []
    for _ in range(30):
        frame = [word() for _ in range(31)]
        texts += [frame + [word() for _ in range(30)] for _ in range(20)]
    texts += [[*t[:60], word()] for t in texts[:25]]
    docs = spark.createDataFrame([(i, " ".join(t), i, i) for i, t in enumerate(texts)], "id long, text string, key_a long, key_b long")
    schema = "node long, key_a long, key_b long, n_shingles long, sig array<int>, short binary, odd long"
    signed = common.cut(docs.mapInArrow(minhash._signatures(2, 20), schema.replace("node", "id"))).withColumnRenamed("id", "node")
    links = {(min(r), max(r)) for r in minhash.candidate_links(signed, 20, 6, 80).collect()}
    assert links == {(i, 600 + i) for i in range(25)}

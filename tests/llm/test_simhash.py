import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from broadsheet.llm import common, simhash
from broadsheet.llm.components import connected_components
from broadsheet.llm.queries import QUERIES

LOWER = {i: i + 32 for i in range(65, 91)}


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, distance):
    """Smallest index reachable, by comparing all."""
    root = list(range(len(values)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    bits = np.array(values, np.uint64)
    for a in range(len(values)):
        for b in np.flatnonzero(np.bitwise_count(bits ^ bits[a]) <= distance).tolist():
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return [find(a) for a in range(len(values))]


def test_query_equals_brute_force(spark, sf, documents):
    rows = QUERIES["op1_simhash_near_dedup"](spark, sf).collect()
    ids = sorted(documents)
    prints = [plain_fingerprint(documents[i].text) for i in ids]
    want = {i: (f"{p:016x}", ids[c]) for i, p, c in zip(ids, prints, components(prints, 3))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == want and len(rows) == len(ids)


@pytest.mark.parametrize(("distance", "depth", "cell"), [(3, 3, 4096), (3, 1, 7), (3, 4, 5), (0, 3, 9), (1, 2, 64), (5, 2, 3)])
def test_links_keep_every_component(spark, distance, depth, cell):
    rng = np.random.default_rng(distance)
    near = [0x0123456789ABCDEF]
    for _ in range(150):  # a crowd around one fingerprint, chains of small steps
        flips = rng.choice(64, rng.integers(0, distance + 3), replace=False)
        near.append(int(near[rng.integers(len(near))]) ^ sum(1 << int(b) for b in flips))
    values = sorted({*near, *(int(x) for x in rng.integers(0, 1 << 63, 200))})
    signed = [(int(np.uint64(v).view(np.int64)),) for v in values]
    links = simhash.simhash_links(spark.createDataFrame(signed, "fp long"), distance, depth, cell)
    pairs = links.collect()
    assert all(bin((p.u ^ p.v) & (1 << 64) - 1).count("1") <= distance for p in pairs)
    found = {r.node: r.component for r in connected_components(links).collect()}
    want = components(values, distance)
    groups = {}
    for i, (s,) in enumerate(signed):
        groups.setdefault(found.get(s, s), set()).add(want[i])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want))


def test_long_text_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 977} v{i % 31}" for i in range(3000))
    whole = simhash.fingerprint_of(text.encode())
    monkeypatch.setattr(simhash, "word_blocks", lambda data: common.word_blocks(data, 100))
    assert simhash.fingerprint_of(text.encode()) == whole == plain_fingerprint(text)
    assert simhash.fingerprint_of(b"one  two") == plain_fingerprint("one two")


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    rows = simhash.simhash_components(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert {r.component_id for r in by[1] + by[2]} == {1}
    assert {r.fp for r in by[3] + by[4] + by[5]} == {0} and {r.component_id for r in by[3] + by[4] + by[5]} == {3}
    assert {r.component_id for r in by[None]} == {None, 3}
    assert simhash.simhash_components(no_docs).collect() == []


def test_one_document_of_a_group_stays(spark, odd_docs, no_docs):
    kept = simhash.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(ids, key=str) == sorted([1, 3, None, 6, 7, 8, 9, 10, 11], key=str)
    assert simhash.drop_near_duplicates(no_docs).count() == 0


def test_rows_are_picked_without_a_second_pass_in_python(spark, odd_docs):
    kept = simhash.drop_near_duplicates(odd_docs)
    assert "ArrowEvalPython" in odd_docs.select(simhash.fingerprint("text"))._jdf.queryExecution().toString()
    assert "ArrowEvalPython" not in kept._jdf.queryExecution().toString()


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 260)] + [(7, 7)]
    found = connected_components(spark.createDataFrame(chain + star + star, "u long, v long")).collect()
    assert {(r.node, r.component) for r in found} == {(i, 100) for i in range(100, 141)} | {(7, 7)} | {(i, 7) for i in range(200, 260)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_hex(spark):
    row = spark.range(1).select(simhash.fingerprint_hex(F.lit(-1)).alias("a"), simhash.fingerprint_hex(F.lit(10)).alias("b")).first()
    assert (row.a, row.b) == ("f" * 16, "0" * 15 + "a")

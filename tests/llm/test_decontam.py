import hashlib
import random
import re

import pytest

from broadsheet.llm import common, decontam
from broadsheet.llm.queries import QUERIES

LOWER = {i: i + 32 for i in range(65, 91)}


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_leaks(text, items):
    words, hit, names = plain_words(text), set(), set()
    for name, other in items:
        own = plain_words(other)
        size = min(10, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                names.add(name)
    return len(words), len(hit), names


def test_query_equals_brute_force(spark, sf, documents):
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for r in QUERIES["op5_decontamination"](spark, sf).collect():
        n, hit, names = plain_leaks(documents[r.doc_id].text, items)
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(names), digest, hit > 0)


@pytest.mark.parametrize("seed", range(8))
def test_search_equals_brute_force(seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("ab") for _ in range(n))
    items = [(str(i), text(rng.choice([1, 2, 3, 5, 9, 10, 11, 14]))) for i in range(6)] + [("e", ""), ("s", "?!")]
    found = decontam.WuManber((name, t.encode()) for name, t in items)
    for n in (0, 1, 5, 60, 400):
        doc = text(n)
        words, names, spans = found.leaks(doc.encode())
        assert (words, sum(b - a for a, b in spans), names) == plain_leaks(doc, items)


def test_blocks_of_a_long_text(monkeypatch):
    item = "the quick brown fox jumps over the lazy dog and then rests a while"
    text = ("filler words here " * 40 + item + " ") * 3
    found = decontam.WuManber([("x", item.encode())])
    want = found.leaks(text.encode())
    monkeypatch.setattr(decontam, "word_blocks", lambda data: common.word_blocks(data, 37))
    assert found.leaks(text.encode()) == want and len(want[2]) == 3


@pytest.mark.parametrize("first", range(1, 10))
def test_passage_across_a_block_of_few_words(monkeypatch, first):
    item = [f"w{i}" for i in range(10)]
    found = decontam.WuManber([("x", " ".join(item).encode())])
    monkeypatch.setattr(decontam, "word_blocks", lambda data: iter([data.split()[:first], data.split()[first:]]))
    assert found.leaks(" ".join([*item, "end"]).encode()) == (11, {"x"}, [(0, 10)])


def test_rounds_over_many_items(spark, odd_docs):
    items = spark.createDataFrame([(i, f"{w} one two three four five six seven eight nine") for i, w in enumerate("abc")] + [(None, "one"), (9, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "b one two three four five six seven eight nine; c One two three four five six seven eight NINE!", "x")], "doc_id long, text string, leak string")
    for size in (1, 1 << 20):
        row = decontam.mark_leaks(docs, items, "out", round_bytes=size).first()
        assert (row.out.n_words, row.out.n_hit, row.out["items"]) == (20, 20, ["", "1", "2"]) and row.leak == "x"


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    items = spark.createDataFrame([(1, "one"), (2, " ".join(odd_rows[0][1].split()[20:40]))], "item_id long, text string")
    marked = decontam.mark_leaks(odd_docs, items, "out").collect()
    assert len(marked) == len(odd_rows)
    assert {r.doc_id for r in marked if r.out.n_hit} >= {1, 2, 7} and not any(r.out.n_hit for r in marked if r.doc_id in (3, 4, 5, 9))
    kept = decontam.drop_contaminated(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == sum(not r.out.n_hit for r in marked)
    assert decontam.mark_leaks(no_docs, items, "out").collect() == []
    assert decontam.drop_contaminated(odd_docs, items.limit(0)).count() == len(odd_rows)

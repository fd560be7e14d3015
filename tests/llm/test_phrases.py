import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from broadsheet.llm import phrases
from broadsheet.llm.queries import QUERIES

LOWER = {i: i + 32 for i in range(65, 91)}


def plain(rows, longest=4, least=30, top=2000, percent=80):
    """The contract, literally, over (lang, text)."""
    f, n = {}, Counter()
    for lang, text in rows:
        own = f.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            own.update(tuple(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    out = []
    for lang, own in f.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        dropped = set()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                dropped |= {q for i in range(len(p) - k + 1) if 100 * a >= percent * own[q := p[i : i + k]]}
        found = []
        for p, a in candidates.items():
            if p not in dropped:
                score, _, l, r = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.collect()))


def test_query_equals_the_contract(spark, sf, documents):
    query = QUERIES["op12_phrase_collocations"](spark, sf)
    assert query.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain((d.lang, d.text) for d in documents.values())
    assert found(query) == want and len(want) >= 50


@pytest.fixture(scope="module")
def texts():
    """A frequent passage that holds all phrase lengths, words of many kinds, ties, languages with few rows."""
    rng = random.Random(3)
    stems = ["the", "Of", "x<y", "été", "\U0001f600", "\x00z", "a\x1cb", "\xff", "foo"]
    rows = []
    for i in range(120):
        words = [rng.choice(stems) + rng.choice(["", "", "", ".", ",\n", "!", "\t", "\r"]) for _ in range(rng.randint(0, 60))]
        rows.append((i, rng.choice(["en", "fr", None]), " ".join(words) + " to be or Not to be " * rng.randint(0, 4)))
    return [*rows, *rows[:40], (500, "en", None), (501, "xx", ""), (502, "xx", "one two"), (503, None, " \t "), (None, "en", "the of " * 50)]


@pytest.mark.parametrize(("longest", "least", "top", "percent"), [(4, 30, 2000, 80), (4, 2, 10, 100), (3, 5, 7, 1), (2, 1, 2000, 80), (5, 3, 100, 90)])
def test_parameters_against_the_contract(spark, texts, longest, least, top, percent):
    docs = spark.createDataFrame(texts, "doc_id long, lang string, text string").repartition(3)
    assert found(phrases.mine_phrases(docs, longest=longest, least=least, top=top, covered_percent=percent)) == plain(
        ((lang, text) for _, lang, text in texts), longest, least, top, percent
    )


def test_small_buffers_change_nothing(spark, texts, monkeypatch):
    """Many filters a task and shard, breaks inside long texts, a bit set full of chance hits."""
    monkeypatch.setattr(phrases, "_BLOCK", 40)
    monkeypatch.setattr(phrases, "HELD_ROWS", 50)
    monkeypatch.setattr(phrases, "MOST_BITS", 6)
    blocks = [w for b in phrases.word_blocks([t.encode() for _, _, t in texts if t]) for w in b]
    whole = "\n".join(t for _, _, t in texts if t).translate(LOWER)
    assert [w for w in blocks if w != b"\xff"] == [w.encode() for w in re.findall(r"[^\x20\x09.,;:!?\x0A-\x0D]+", whole)]
    held = phrases.Counts(2)
    for _ in range(30):
        held.add([np.arange(9, dtype=np.uint64), np.ones(9, np.uint64)], np.ones(9, np.int64))
    assert held.arrays()[1].tolist() == [30] * 9


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    assert found(phrases.mine_phrases(odd_docs, least=10)) == plain(((r[2], r[1]) for r in odd_rows), least=10)
    assert phrases.mine_phrases(no_docs).collect() == []
    assert phrases.mine_phrases(odd_docs.select(F.lit(None).cast("string").alias("text"), "lang")).collect() == []


def test_scores_beyond_64_bits(spark):
    words = spark.createDataFrame([("en", bytearray(b"a"), 9 * 10**18), ("en", bytearray(b"b"), 9 * 10**18)], "lang string, word binary, n long")
    counts = spark.createDataFrame([("en", bytearray(b"\1"), 9 * 10**18), ("en", bytearray(b"\2"), 9 * 10**18 - 1)], "lang string, key binary, f long")
    vocabulary = counts.join(spark.createDataFrame([(bytearray(b"\1"), "a"), (bytearray(b"\2"), "b")], "key binary, word string"), "key")
    pairs = spark.createDataFrame([("en", bytearray(b"\1\2"), 8 * 10**18)], "lang string, key binary, f long")
    with pytest.raises(Exception):  # noqa: B017 - n itself passes 64 bits here
        phrases._ranked(words, vocabulary, [counts, pairs], 1, 5, 80).collect()
    row = phrases._ranked(words.limit(1), vocabulary, [counts, pairs], 1, 5, 80).first()
    assert (row.phrase, row.score) == ("a b", 2_000_000 * 8 * 10**18 // (18 * 10**18 - 1))


def test_number_column_is_numbers(spark):
    words = ["a", "zebra", "é\U0001f600", "x" * 100]
    rows = spark.createDataFrame([(w,) for w in words], "word string")
    for seed, width in ((0, 40), (3, 64), (7, 8)):
        got = [r[0] & (1 << 64) - 1 for r in rows.select(phrases.number_column(F.col("word").cast("binary"), seed, width)).collect()]
        assert got == phrases.Numbers(seed, width).of([w.encode() for w in words]).tolist()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5), st.sampled_from([8, 16, 40, 64]), st.integers(0, 6), st.integers(0, 400), st.integers(0, 99))
def test_filters_are_lossless(size, width, shard_bits, n, seed):
    rng = np.random.default_rng(seed)
    lanes = [rng.integers(0, 1 << width, n, np.uint64, endpoint=False) if width < 64 else rng.integers(0, 1 << 64, n, np.uint64) for _ in range(size)]
    mixed = phrases.permuted(lanes, width)
    assert all(np.array_equal(a, b) for a, b in zip(phrases.unpermuted(mixed, width), lanes))
    assert all(int(m.max(initial=0)) < 1 << width for m in mixed)
    shard = 5 % (1 << shard_bits)
    mixed[0] = mixed[0] & np.uint64((1 << width - shard_bits) - 1) | np.uint64(shard << width - shard_bits)
    order = np.argsort(mixed[0])
    mixed = [m[order] for m in mixed]
    counts = rng.choice([1, 2, 254, 255, 256, 10**12], n).astype(np.int64)
    back, again = phrases.read_filter(phrases.write_filter(mixed, counts, width, shard_bits), width, shard_bits, shard)
    assert np.array_equal(counts, again) and all(np.array_equal(a, b) for a, b in zip(mixed, back))
    keys = phrases.to_keys(lanes, width).to_pylist()
    if n:
        assert all(np.array_equal(a, b) for a, b in zip(phrases.from_keys(keys, size, width), lanes))

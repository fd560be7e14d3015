import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import quality
from broadsheet.llm.queries import QUERIES


def plain_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(again)


def plain_model(texts):
    """Chance of a symbol behind a context under modified Kneser-Ney, from dictionaries."""
    table = quality._TABLE.tolist()
    counts = [Counter() for _ in range(quality.ORDER + 1)]
    for text in texts:
        symbols = [table[b] for b in b"\n" * (quality.ORDER - 1) + text.encode()]
        for i in range(len(symbols) - quality.ORDER + 1):
            counts[quality.ORDER][tuple(symbols[i : i + quality.ORDER])] += 1
    for k in range(quality.ORDER - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discounts = [None]
    for k in range(1, quality.ORDER + 1):
        n = [sum(c == i for c in counts[k].values()) for i in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        d = [min(max(i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] else y, 0.0), i - 0.01) for i in (1, 2, 3)]
        discounts.append(d)
    after = [None] + [{} for _ in range(quality.ORDER)]
    for k in range(1, quality.ORDER + 1):
        for g, c in counts[k].items():
            after[k].setdefault(g[:-1], []).append(c)

    def chance(g):
        if not g:
            return 1 / 64
        k, lower = len(g), chance(g[1:])
        own = after[k].get(g[:-1])
        if not own:
            return lower
        cut = lambda c: discounts[k][min(c, 3) - 1] if c else 0.0
        c = counts[k].get(g, 0)
        return (c - cut(c)) / sum(own) + sum(map(cut, own)) / sum(own) * lower

    def bits(text):
        symbols = [table[b] for b in b"\n" * (quality.ORDER - 1) + text.encode()]
        return -sum(math.log2(chance(tuple(symbols[i : i + quality.ORDER]))) for i in range(len(symbols) - quality.ORDER + 1))

    return bits


@pytest.fixture(scope="module")
def judged(spark, sf):
    return {r.doc_id: r for r in QUERIES["op2_quality_perplexity"](spark, sf).collect()}


def test_query_equals_brute_force(judged, documents):
    assert judged.keys() == documents.keys()
    own = {}
    for r in documents.values():
        own.setdefault(r.lang, []).append(r)
    for lang, docs in own.items():
        bits = plain_model([r.text for r in docs])
        size = {r.doc_id: len(r.text.encode()) for r in docs}
        total = {r.doc_id: bits(r.text) for r in docs}
        good = []
        for r in docs:
            got, stats = judged[r.doc_id], plain_stats(r.text)
            assert (got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words) == stats
            assert got.base_failed == (stats[0] < 10 or 100 * stats[4] > 20 * stats[0])
            good += [] if got.base_failed else [r.doc_id]
        steps = sorted(math.floor(total[i] / size[i] * 1000 + 0.5) for i in good)
        q1, q2, q3 = (steps[math.ceil(len(steps) * k / 4) - 1] / 1000 for k in (1, 2, 3))
        width = quality.FENCE * max(q3 - q1, 0.001)
        for i in good:
            score = (total[i] + 100 * q2) / (size[i] + 100)
            got = judged[i]
            assert math.isclose(got.bits, score, rel_tol=1e-6)
            assert np.allclose((got.low, got.high), (q1 - width, q3 + width))
            assert got.kept == (got.low <= got.bits <= got.high)


def test_bands_keep_clean_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op2_quality_perplexity"](spark, sf).collect() if r.doc_id in labels and not r.base_failed]
    clean = [r.kept for r in rows if labels[r.doc_id] == 1]
    poor = [r.kept for r in rows if labels[r.doc_id] == 0]
    assert sum(clean) >= 0.97 * len(clean) and sum(poor) < 0.6 * len(poor)


def test_model_is_a_distribution():
    rng = np.random.default_rng(1)
    grams, n = np.unique(rng.integers(0, 1 << 24, 500).astype(np.uint64) & np.uint64(0x1C71C7), return_counts=True)
    model = quality.KneserNey(grams, n)
    for context in (grams[0] >> np.uint64(6), np.uint64(0x3FFFF), np.uint64(0)):
        keys = (context << np.uint64(6)) + np.arange(64, dtype=np.uint64)
        assert math.isclose(model._known(quality.ORDER, keys).sum(), 1, rel_tol=1e-9)


def test_repeat_words_by_hand():
    for text in ("", "a b c d e", "a b c d e f a b c d e", "x " * 30, "a a a a a b a a a a a"):
        assert quality.base_stats(text.encode()) == plain_stats(text)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    rows = quality.judge_quality(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    by = {r.doc_id: r for r in rows}
    assert all(by[i].base_failed and not by[i].kept for i in (3, 4, 5, 7, 9)) and by[3].n_words == 0
    assert by[6].n_words == 200_000 and not by[6].base_failed
    assert quality.judge_quality(no_docs).count() == 0
    alike = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(20)), None) for i in range(5)], "doc_id long, text string, lang string")
    assert {(r.lang, r.kept) for r in quality.judge_quality(alike).collect()} == {("", True)}
    assert quality.judge_quality(alike.withColumn("text", F.lit("too short"))).filter("kept").count() == 0


def scrambled_case(text, rng):
    return "".join(rng.choice((c.lower(), c.upper())) for c in text)


def other_characters(text, rng):
    """Characters of three bytes, of which the last two lose a bit that the symbols do not have."""
    flip = lambda b: bytes((b[0], b[1] ^ 32, b[2] ^ 32)) if len(b) == 3 else b
    return b"".join(flip(c.encode()) for c in text).decode()


@pytest.mark.parametrize(("letters", "change"), [("abcdefghilmnoprstu", scrambled_case), ("中文字典書本語言學校生活", other_characters)])
def test_what_symbols_fold_is_judged(spark, letters, change):
    rng = random.Random(5)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(150)]
    odd = change(texts[0], rng)
    assert quality._TABLE[list(odd.encode())].tolist() == quality._TABLE[list(texts[0].encode())].tolist() and odd != texts[0]
    docs = spark.createDataFrame([*((i, t, "xx") for i, t in enumerate(texts)), (999, odd, "xx")], "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in quality.judge_quality(docs).collect()}
    assert not kept.pop(999) and all(kept.values())


def test_byte_choice_equals_brute_force():
    rng = random.Random(8)
    texts = ["".join(rng.choice("aAbB 019.é中\t") for _ in range(rng.randint(1, 300))).encode() for _ in range(12)]
    table = quality._TABLE.tolist()
    threes = Counter(bytes(t[i : i + 3]) for t in (b"\n\n" + t for t in texts) for i in range(len(t) - 2))
    counts = [None, None, None, threes]
    for k in (2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    off = [None] + [quality._discounts(np.array(list(c.values()))) for c in counts[1:]]

    def chance(gram):
        k, symbol = len(gram), table[gram[-1]]
        shorter = chance(gram[1:]) if k > 1 else 1 / table.count(symbol)
        own = [c for g, c in counts[k].items() if g[:-1] == gram[:-1] and table[g[-1]] == symbol]
        if not own:
            return shorter
        n = counts[k][gram]
        return (n - off[k][min(n, 3)] + sum(off[k][min(c, 3)] for c in own) * shorter) / sum(own)

    grams, n = quality._counted([g for t in texts for g in quality.byte_grams_of(t)])
    model = quality.ByteChoice(grams, n)
    for text in [*texts[:4], b"", b"Bab 9.1 Aa\t0b", b"\x00zz\v"]:
        padded = b"\n\n" + text
        chances = [chance(padded[i : i + 3]) for i in range(len(text))]
        want = sum(-math.log2(c) if c else math.inf for c in chances)
        assert math.isclose(model.code_length(text), want, rel_tol=1e-5, abs_tol=1e-9)
    for row in (0, ord("a"), len(model.bits) - 1):  # a distribution over the bytes of each symbol
        assert np.allclose(np.bincount(quality._TABLE.astype(int), 2.0 ** -model.bits[row].astype(float)), 1, atol=1e-5)

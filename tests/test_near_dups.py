import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from broadsheet.operators import near_dups

ROWS = "doc_id long, body string, key string, n int"


def plain_set(text, size=3):
    words = [w for w in (text or "").lower().replace("\x0b", " ").replace("\f", " ").split() if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) or frozenset([tuple(words)])


def alike(a, b, pct):
    return bool(a) and bool(b) and 100 * len(a & b) >= pct * len(a | b)


def plain_kept(rows, pct=85, size=3):
    sets = [(i, plain_set(t, size)) for i, t in rows]
    order = lambda i: (i is None, i or 0)
    return sorted((i for i, s in sets if not any(alike(s, t, pct) and order(j) < order(i) for j, t in sets)), key=repr)


def plain_pairs(rows, pct=85, size=3):
    first = {}
    for i, text in rows:
        normal = " ".join((text or "").lower().split())
        if normal and i is not None:
            first[normal] = min(i, first.get(normal, i))
    sets = sorted((i, plain_set(n, size)) for n, i in first.items())
    return sorted((i, j, len(s & t), len(s | t)) for x, (i, s) in enumerate(sets) for j, t in sets[x + 1 :] if alike(s, t, pct))


@pytest.fixture(scope="module")
def crowd():
    """Edited copies in chains, templates that are not quite alike, short texts, exact copies."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(4))
    texts = [[word() for _ in range(80)]]
    for _ in range(60):
        own = list(rng.choice(texts[-6:]))
        own[rng.randrange(80)] = word()
        texts.append(own)
    frame = [word() for _ in range(50)]
    texts += [frame + [word() for _ in range(rng.randint(1, 8))] for _ in range(40)]
    texts += [[rng.choice("ab") for _ in range(rng.randint(0, 6))] for _ in range(40)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(500 + i, rows[70][1].upper().replace(" ", "\n ")) for i in range(60)]
    rows += [(None, rows[5][1]), (None, "only here and nowhere else"), (None, None), (900, ""), (901, " \t"), (902, None)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], ROWS).repartition(3)


@pytest.mark.parametrize(("pct", "size"), [(85, 3), (100, 3), (60, 2), (1, 1)])
def test_equals_brute_force(spark, crowd, pct, size):
    df = frame(spark, crowd)
    pairs = near_dups.near_dup_pairs(df, pct, size=size)
    assert pairs.columns == ["id_a", "id_b", "n_common", "n_all"]
    assert sorted(map(tuple, pairs.collect())) == plain_pairs(crowd, pct, size)
    kept = near_dups.near_dedup(df, pct, size=size)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == plain_kept(crowd, pct, size)


def test_a_third_of_all_rows_one_text(spark):
    rows = [(i, "the same old story told over and over again") for i in range(3, 400)] + [(400 + i, f"something new number {i} {i + 1}") for i in range(800)]
    df = frame(spark, rows)
    kept = {r.doc_id for r in near_dups.near_dedup(df).select("doc_id").collect()}
    assert kept == {3, *range(400, 1200)}
    assert near_dups.near_dup_pairs(df).count() == 0
    classes = {r.doc_id: r.class_id for r in near_dups.near_dup_classes(df).collect()}
    assert classes[399] == 3 and classes[450] == 450 and len(classes) == len(rows)


def test_empty_and_repeated(spark):
    df = frame(spark, [(1, "a b c d"), (1, "a b c d"), (2, "A  b c D")])
    assert [r.doc_id for r in near_dups.near_dedup(df).collect()] == [1, 1]
    assert near_dups.near_dedup(df.limit(0)).collect() == [] and near_dups.near_dup_pairs(df.limit(0)).collect() == []
    with pytest.raises(ValueError, match="pct"):
        near_dups.near_dup_pairs(df, 0)


def test_prefix_leaves_out_what_no_other_text_has(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(50)) + " one common line") for i in range(20)]
    sets = near_dups._classes(frame(spark, rows), "doc_id", "body", 3)
    assert near_dups._prefixes(sets, 85).count() == 0


@pytest.mark.parametrize("buckets", [1, 8, 1 << 14])
def test_buckets_only_order_the_shingles(spark, crowd, monkeypatch, buckets):
    monkeypatch.setattr(near_dups, "BUCKETS", buckets)
    df = frame(spark, crowd)
    assert sorted(map(tuple, near_dups.near_dup_pairs(df).collect())) == plain_pairs(crowd)


def test_only_prefixes_leave_the_row_and_texts_are_shuffled_once(spark):
    rows = [(i, " ".join(f"w{(i + k) % 90}" for k in range(60))) for i in range(50)]
    df = frame(spark, rows)
    prefixes = near_dups._prefixes(near_dups._classes(df, "doc_id", "body", 3), 85)
    assert "Join" not in prefixes._jdf.queryExecution().optimizedPlan().toString()
    assert prefixes.groupBy("key").count().agg({"count": "max"}).first()[0] <= 58 - 50 + 1
    pairs = near_dups.near_dup_pairs(df)
    assert sorted(map(tuple, pairs.collect())) == plain_pairs(rows)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange [key" in plan


def test_histograms_rule_out_only_pairs_that_are_not_alike(spark):
    shared = " ".join(f"s{k}" for k in range(30))
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(170)) + " " + shared) for i in range(6)]
    rows += [(10 + i, rows[0][1] + " " + " ".join(f"z{i}{k}" for k in range(8 * i))) for i in range(6)]
    sets = near_dups._classes(frame(spark, rows), "doc_id", "body", 3).select("key", "id", "shingles")
    every = sets.select(F.col("key").alias("key_a"), F.col("id").alias("i")).crossJoin(sets.select(F.col("key").alias("key_b"), F.col("id").alias("j")))
    names = every.filter("i < j")
    left = near_dups._not_far(names.select("key_a", "key_b"), sets, 85).join(names, ["key_a", "key_b"])
    got = {(r.i, r.j) for r in left.collect()}
    assert got >= {p[:2] for p in plain_pairs(rows)} and not any(j < 10 or 0 < i < 10 for i, j in got)


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 30), min_size=1), st.sets(st.integers(0, 30), min_size=1), st.integers(1, 100))
def test_prefixes_of_similar_sets_meet(a, b, pct):
    prefix = lambda s: set(sorted(s)[: len(s) - (pct * len(s) + 99) // 100 + 1])
    assert not alike(a, b, pct) or prefix(a) & prefix(b)

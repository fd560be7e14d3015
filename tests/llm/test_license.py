import random
import re

from pyspark.sql import functions as F

from broadsheet.llm import license_scan
from broadsheet.llm.queries import QUERIES


def plain_shingles(text):
    words = [w for w in re.split(r"[^a-z0-9\x80-\U0010ffff]+", (text or "").lower()) if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def plain_licenses(text, templates):
    own = plain_shingles(text)
    shares = {name: len(s & own) / len(s) for name, t in templates.items() if (s := plain_shingles(t))}
    return sorted(n for n, share in shares.items() if share >= license_scan.CONTAINMENT)


def test_query_equals_brute_force(spark, sf, documents):
    rows = QUERIES["op10_license_scan"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    for r in rows:
        want = plain_licenses(documents[r.doc_id].text, license_scan.TEMPLATES)
        assert (r.licenses, r.n_licenses) == (",".join(want), len(want)) and (r.containment >= 0.8) == bool(want)
    assert sum(r.n_licenses for r in rows)


def test_edited_and_embedded_templates(spark):
    rng = random.Random(2)
    filler = lambda n: " ".join(rng.choice("lorem ipsum dolor sit amet elit sed do".split()) + str(rng.randint(0, 99)) for _ in range(n))
    rows, names = [], list(license_scan.TEMPLATES)
    for i in range(60):
        words = license_scan.TEMPLATES[names[i % len(names)]].split()
        if i % 3 == 1 and len(words) > 40:  # a word changed: five shingles of many
            words[rng.randrange(len(words))] = "changed"
        if i % 3 == 2:
            words = words[: len(words) // 2]
        rows.append((i, filler(rng.randint(0, 300)) + "\n" + " ".join(words).upper() + "\n" + filler(rng.randint(0, 300))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    templates = spark.createDataFrame(list(license_scan.TEMPLATES.items()), "license_id string, text string")
    found = {r.doc_id: r.out for r in license_scan.find_licenses(docs, templates, "out").collect()}
    missed = sum(plain_licenses(t, license_scan.TEMPLATES) != [x.license_id for x in found[i]] for i, t in rows)
    assert missed == 0
    # a round's bands follow its templates, so another window may be the first
    plain = lambda matches: [(m.license_id, m.containment) for m in matches]
    rounds = license_scan.find_licenses(docs, templates, "out", round_size=4).collect()
    assert {r.doc_id: plain(r.out) for r in rounds} == {i: plain(m) for i, m in found.items()}


def test_band_settings_guarantee_retrieval():
    for n in range(1, 400):
        held = -(-n * 8 // 10)
        similar = 1.0 if n == 1 else held / (2 * license_scan.tier_of(n) + n - held)
        assert 1 - (1 - similar) ** license_scan.band_count(n) >= license_scan.CERTAINTY


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    templates = spark.createDataFrame([("a", "one"), (None, "12345 67890"), ("e", ""), ("n", None)], "license_id string, text string")
    found = license_scan.find_licenses(odd_docs, templates, "out")
    assert found.columns == [*odd_docs.columns, "out"]
    rows = found.collect()
    assert len(rows) == len(odd_rows)
    by = {r.doc_id: [x.license_id for x in r.out] for r in rows}
    assert by[7] == ["a"] and by[9] == [""] and by[3] == by[4] == by[5] == []
    assert license_scan.find_licenses(no_docs, templates, "out").count() == 0
    assert found.select(F.size("out")).count() == license_scan.find_licenses(odd_docs, templates.limit(0), "out").count()


def test_native_plan(spark, sf):
    plan = QUERIES["op10_license_scan"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan

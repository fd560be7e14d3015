import zlib

import numpy as np

from broadsheet.llm import langid
from broadsheet.llm.queries import QUERIES


def plain_bits(counts, known, text):
    """Code length byte by byte, escaping from the longest context."""

    def chances(context):
        shorter = chances(context[1:]) if context else [1 / 256] * 256
        own = counts.get(context)
        if not own:
            return shorter
        n, d = sum(own.values()), len(own)
        left = sum(p for b, p in enumerate(shorter) if b not in own)
        if left <= 0:
            return [own.get(b, 0) / n for b in range(256)]
        return [own[b] / (n + d) if b in own else p / left * d / (n + d) for b, p in enumerate(shorter)]

    padded, bits = b"\n" * langid.ORDER + text, 0.0
    for i in range(len(text)):
        context = padded[i : i + langid.ORDER]
        while context not in known:
            context = context[1:]
        bits -= np.log2(chances(context)[padded[i + langid.ORDER]])
    return bits


def test_chances_add_up(spark, odd_docs):
    rows = langid.count_grams(odd_docs).filter("lang = 'en'").collect()
    levels = langid.PpmLevels()
    for _ in range(langid.ORDER + 1):
        levels.add(np.array([r.gram for r in rows]), np.array([r.n for r in rows]))
    for context in (b"\n\n\n\n", b"word", b"zzzz", b"\x00\xff\x01\x02"):
        grams = (int.from_bytes(context, "big") << 8) + np.arange(256)
        assert np.isclose((2.0 ** -levels.bits(grams)).sum(), 1)


def test_counts_cover_all_texts(spark, odd_docs, odd_rows):
    total = {r.lang: r["sum(n)"] for r in langid.count_grams(odd_docs).groupBy("lang").sum("n").collect()}
    want = {}
    for r in odd_rows:
        if r[1] is not None and r[2] is not None:
            want[r[2]] = want.get(r[2], 0) + len(r[1].encode())
    assert total == {k: v for k, v in want.items() if v}


def test_held_out_accuracy(spark, sf, documents):
    rows = QUERIES["op4_language_id"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [documents[r.doc_id].lang == r.lang_pred for r in rows if r.held_out]
    assert sum(held) >= 0.97 * len(held)
    assert not any(r.rejected for r in rows)


def test_a_rare_language_keeps_every_context(spark):
    rng = np.random.default_rng(3)
    big = ["".join(map(chr, rng.integers(97, 123, 30_000))) for _ in range(4)]
    rare = ["Ελληνικά λόγια, σπάνια εδώ, με δικά τους γράμματα.", "big words, too"]
    rows = [(i, t, "big") for i, t in enumerate(big)] + [(i, t, "rare") for i, t in enumerate(rare, 10)] + [(20, None, "big"), (21, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counts = {}
    for _, text, lang in rows:
        padded = b"\n" * langid.ORDER + (text or "").encode()
        for i in range(langid.ORDER, len(padded)):
            for k in range(langid.ORDER + 1):
                own = counts.setdefault(lang, {}).setdefault(padded[i - k : i], {})
                own[padded[i]] = own.get(padded[i], 0) + 1
    known = {c for by in counts.values() for c in by} | {b""}
    assert len(known) > 16_384
    asked = [*rare, "unseen Ελλ λόγια \U0001f600 zq", big[0][:2000], None, "", "12"]
    texts = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    for part_bytes in (langid.PART_BYTES, 500):
        found = langid.judge_languages(texts, docs, "found", part_bytes=part_bytes)
        assert found.columns == ["doc_id", "text", "found"]
        got = {r.doc_id: r.found for r in found.collect()}
        assert got.keys() == set(range(len(asked))) and all(got[i].rejected and got[i].lang_pred == "und" for i in (4, 5, 6))
        for i in range(4):
            data = asked[i].encode()
            want = {lang: plain_bits(counts[lang], known, data) for lang in ("big", "rare")}
            assert got[i].lang_pred == min(want, key=want.get)
            assert np.isclose(got[i].bits_per_byte * len(data), min(want.values()), rtol=1e-5)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    rows = langid.judge_languages(odd_docs, odd_docs, "p").collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in rows) == sorted((r[0] or 0, r[1] or "") for r in odd_rows)
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.p.lang_pred == "und") == (not letters) and (r.p.score == 0) == (not letters)
        assert r.p.rejected or letters
    assert langid.judge_languages(no_docs, odd_docs, "p").count() == 0
    rows = langid.judge_languages(odd_docs, no_docs, "p").collect()
    assert {r.p.lang_pred for r in rows} == {"und"}
    assert all(r.p.rejected == (not any(c.isalpha() for c in r.text or "")) for r in rows)


def test_repeated_rows_and_small_parts(spark):
    texts = ["the cat sat on the mat"] * 40 + ["le chat est sur le tapis"] * 20 + [None, ""]
    docs = spark.createDataFrame([(None, t, "en" if t and t[0] == "t" else "fr") for t in texts], "doc_id long, text string, lang string").repartition(7)
    for part_bytes in (1, 100, langid.PART_BYTES):
        rows = langid.judge_languages(docs, docs, "p", part_bytes=part_bytes, tree_rows=5).collect()
        assert len(rows) == len(texts) and all(r.p.lang_pred == (r.lang if r.text else "und") for r in rows)


def test_strange_text_is_rejected(spark, odd_docs):
    docs = spark.createDataFrame([("漢字仮名交じり文" * 30,), ("plain words of text",)], "text string")
    found = langid.judge_languages(docs, odd_docs.filter("doc_id != 6"), "p").collect()
    assert {r.text[0]: r.p.rejected for r in found} == {"漢": True, "p": False}

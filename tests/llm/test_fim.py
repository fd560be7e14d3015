import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from broadsheet.llm import fim
from broadsheet.llm.queries import QUERIES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc_id, text):
    """The contract, literally: (n, form, prefix_chars, middle_chars, output)."""
    text = text or ""
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    parts = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(parts)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_query_equals_the_contract(spark, sf, documents):
    rows = QUERIES["op11_fill_in_middle"](spark, sf).collect()
    assert len(rows) == len(documents) and {r.form for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        text = documents[r.doc_id].text
        *want, output = plain(r.doc_id, text)
        assert [r.n, r.form, r.prefix_chars, r.middle_chars] == want
        assert r.output_sha256 == sha(output) and r.restored_sha256 == sha(text)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    more = [(20, "<P>"), (21, "a <S> b"), (22, "<"), (23, "<M"), (24, "x" * 1_000_000), (25, "<P" * 500), (26, "\U0001f600é" * 99), (27, "S>P>M><<<S")]
    docs = odd_docs.select("doc_id", "text", "fp", "spans").unionByName(
        spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True
    )
    cut = fim.fill_in_middle(docs, "fim")
    assert cut.columns == ["doc_id", "text", "fp", "spans", "fim"]
    output = fim.rendered("text", "fim.pieces")
    rows = cut.select("doc_id", "text", "fim", output.alias("output"), fim.restored(output, "fim.form").alias("back")).collect()
    assert len(rows) == len(odd_rows) + len(more)
    for r in rows:
        n, form, prefix, middle, want = plain(r.doc_id, r.text)
        assert (r.fim.n, r.fim.form, r.fim.prefix_chars, r.fim.middle_chars, r.output) == (n, form, prefix, middle, want)
        assert r.fim.sha256 == sha(want) and r.back == (r.text or "")
    assert fim.fill_in_middle(no_docs, "fim").collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab Z<>PSMé\U0001f600\n", max_size=60), st.integers(0, 10**6), st.integers(0, 10**6), st.sampled_from(["psm", "spm"]))
def test_descriptors_round_trip(text, x, y, form):
    data = text.encode()
    parts = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    starts = fim.units(data)
    assert len(starts) == len(parts) and [data[a:b].decode() for a, b in zip(starts, [*starts[1:], len(data)])] == parts
    borders = [*starts.tolist(), len(data)]
    a, b = sorted((borders[x % len(borders)], borders[y % len(borders)]))
    table = fim.PieceTable.of(data)
    twice = table.cut(a).cut(b)
    assert [p[1] for p in twice.pieces] == [0, a, b] and bytes(twice) == data and twice.sha256() == table.sha256()
    for order in fim.ORDERS.values():
        assert twice.permuted(order).restored(order) == twice
    moved = fim.arranged(twice, form)
    assert sum(p[2] for p in moved.pieces) == len(data) + 9
    if not any(s in data for s in fim.SENTINELS):
        assert bytes(fim.taken_apart(bytes(moved), form)) == data


def test_a_cut_outside_fails():
    with pytest.raises(ValueError, match="inside"):
        fim.PieceTable.of(b"abc").cut(4)
    assert fim.PieceTable.of(b"").cut(0).pieces == ((0, 0, 0), (0, 0, 0))

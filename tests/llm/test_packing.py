import os
import random
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from broadsheet.llm import packing
from broadsheet.llm.queries import QUERIES, tokenizer_path


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(tokenizer_path())


def check(pieces, texts, plain, longest=2048):
    """``texts`` by id; ``pieces`` must be those of each, whole and in order."""
    by = {}
    for p in pieces:
        by.setdefault(p.doc_id, []).append(p)
    assert by.keys() == texts.keys()
    assert len({p.sequence_id for p in pieces}) == len(pieces) and all(p.offset == 0 for p in pieces)
    for i, text in texts.items():
        ids, at = plain.encode(text or "", add_special_tokens=False).ids + [1], 0
        for p in sorted(by[i], key=lambda p: p.start):
            part = ids[at : at + p.length]
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(np.array(part, "<u4").tobytes()))
            assert p.length <= longest and p.length & (p.length - 1) == 0
            at += p.length
        assert at == len(ids)


def test_query_equals_plain_encoding(spark, sf, documents, plain):
    check(QUERIES["op3_power_of_two_packing"](spark, sf).collect(), {i: r.text for i, r in documents.items()}, plain)


def test_piece_lengths():
    assert packing.piece_lengths(1) == [1] and packing.piece_lengths(0) == []
    assert packing.piece_lengths(2 * 2048 + 1024 + 5) == [2048, 2048, 1024, 4, 1]
    assert all(sum(packing.piece_lengths(n, 8)) == n for n in range(100))


def test_words_encode_as_whole_texts(plain):
    rng = random.Random(5)
    bits = ["word", "Wörd", "don't", "12,5", "\n", "\n\n", "\t", "  ", "", " ", "\x1c", "😀", "<|endoftext|>", "...", "'s", "漢字", "\r\n", "x "]
    texts = [" ".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(600)]
    texts += ["".join(rng.choice(bits + [" "]) for _ in range(12)) for _ in range(600)]
    plain.encode_special_tokens = True
    encoder = packing.WordTokenizer(tokenizer_path(), cached_words=50)
    for at in range(0, len(texts), 100):
        some = texts[at : at + 100]
        for text, ids in zip(some, encoder.encode_many(some)):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_names_of_added_tokens_are_those_tokens(spark):
    unchanged = Tokenizer.from_file(tokenizer_path())
    texts = ["one two <|endoftext|> three", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "one two three", "<|endoftext |> x"]
    assert [unchanged.encode(t, add_special_tokens=False).ids.count(50256) for t in texts] == [1, 1, 2, 0, 0]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(packing.pack_power_of_two(docs, tokenizer_path()).collect(), dict(enumerate(texts)), unchanged)


def test_common_words_stay_known_when_rare_ones_are_dropped(plain):
    encoder, learned = packing.WordTokenizer(tokenizer_path(), cached_words=40), []
    learn = encoder._learn
    encoder._learn = lambda words: (learned.extend(words), learn(words))
    for call in range(8):
        texts = [f"In {call} common words " + " ".join(f"rare{call}x{i}" for i in range(30)), "of common  space", "two common words"]
        assert [x.tolist() for x in encoder.encode_many(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(encoder.words) <= 40 + 33
    assert learned.count("common") == learned.count("words") == 1


def test_words_are_encoded_in_the_task_s_own_thread():
    code = """
import os
from broadsheet.llm import packing
from broadsheet.llm.queries import tokenizer_path

encoder = packing.word_tokenizer(tokenizer_path())
before = set(os.listdir("/proc/self/task"))
encoder.encode_many([" ".join(f"w{i}" for i in range(20_000))])
print("threads", len(set(os.listdir("/proc/self/task")) - before))
"""
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"}
    root = Path(__file__).resolve().parents[2]
    done = subprocess.run([sys.executable, "-c", code], cwd=root, env=env | {"PYTHONPATH": str(root)}, capture_output=True, text=True, check=True)
    assert done.stdout.split() == ["threads", "0"]


def test_slices_hold_whole_texts(monkeypatch):
    monkeypatch.setattr(packing, "_TEXT_BYTES", 5)
    texts = pa.array(["abc", None, "déf", "", "0123456789", "x"])
    got = [(at, some.to_pylist()) for at, some in packing._slices(texts)]
    assert got == [(0, ["abc", "", "déf"]), (3, ["", "0123456789"]), (5, ["x"])]
    broken = pa.Array.from_buffers(pa.string(), 1, pa.array([b"a\xffb"], pa.binary()).buffers())
    assert [some.to_pylist() for _, some in packing._slices(broken)] == [["a\ufffdb"]]
    assert list(packing._slices(pa.array([], pa.string()))) == []


def test_odd_rows(spark, odd_docs, odd_rows, no_docs, plain, tmp_path):
    pieces = packing.pack_power_of_two(odd_docs, tokenizer_path())
    rows = pieces.collect()
    assert sum(p.start == 0 for p in rows) == len(odd_rows)
    check([p for p in rows if p.doc_id not in (None, 1)], {r[0]: r[1] for r in odd_rows if r[0] not in (None, 1)}, plain)
    assert [p.length for p in rows if p.doc_id == 3] == [1]
    assert all(len(p.ids) == p.length == p.bucket for p in rows)
    assert packing.pack_power_of_two(no_docs, tokenizer_path()).count() == 0
    packing.write_buckets(pieces, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "bucket=2048")).count() == sum(p.bucket == 2048 for p in rows)
    with pytest.raises(ValueError):
        packing.pack_power_of_two(odd_docs, tokenizer_path(), sequence=1000)


def test_without_ids(spark, odd_docs):
    whole = packing.pack_power_of_two(odd_docs, tokenizer_path())
    bare = packing.pack_power_of_two(odd_docs, tokenizer_path(), with_ids=False)
    assert bare.columns == [c for c in whole.columns if c != "ids"]
    assert sorted(map(str, bare.drop("sequence_id").collect())) == sorted(map(str, whole.drop("ids", "sequence_id").collect()))

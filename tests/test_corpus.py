import csv
import math
import re
from collections import Counter

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from broadsheet.functions import corpus_clean
from broadsheet.operators import tfidf as weights
from broadsheet.operators.corpus import STOP_WORDS, clean_tokens, corpus_tokens, lemmatize, processed_text, tokens_of
from broadsheet.operators.tfidf import doc_terms, fit_vocab, term_stats, tfidf
from broadsheet.plans import stages
from broadsheet.sources import labelled_corpus, load_vocab


def py_tokens(text):
    text = re.sub(r"\s+", " ", re.sub(r"[^a-zA-Z0-9\s]", "", text.lower())).strip()
    return [w for w in text.split(" ") if re.fullmatch("[a-z]+", w) and w not in STOP_WORDS]


def py_tfidf(token_lists, k):
    docs = [Counter(t for t in ts if len(t) >= 2) for ts in token_lists]
    total, df = Counter(), Counter()
    for d in docs:
        total.update(d)
        df.update(d.keys())
    vocab = sorted(sorted(total, key=lambda t: (-total[t], t))[:k])
    idf = {t: math.log((1 + len(docs)) / (1 + df[t])) + 1 for t in vocab}
    cells = {}
    for i, d in enumerate(docs):
        w = {t: n * idf[t] for t, n in d.items() if t in idf}
        norm = math.sqrt(sum(x * x for x in w.values()))
        cells.update({(i, t): x / norm for t, x in w.items()})
    return vocab, idf, cells


def tokens_frame(spark, lists):
    return spark.createDataFrame(list(enumerate(lists)), "doc_id bigint, tokens array<string>")


def test_stop_words_are_those_of_spark(spark):
    listed = StopWordsRemover.loadDefaultStopWords("english")
    assert set(STOP_WORDS) == {w for w in listed if w.isalpha()}


def test_tokens(spark):
    texts = ["The Cats, the cats; don't 4ever café é x2 a", "", "the and of", "one two three"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r.doc_id: r.tokens for r in corpus_tokens(df).collect()}
    assert rows == {i: py_tokens(t) for i, t in enumerate(texts)}
    own = corpus_tokens(df, stop_words=["cats"]).select(processed_text().alias("t")).collect()[0].t
    assert own == "the the dont caf a"


def test_doc_terms(spark):
    lists = [["b", "aa", "bb", "aa", "aa"], [], ["x"], ["zz"], ["bb"] * 5]
    got = {(r.doc_id, r.term): r.tf for r in doc_terms(tokens_frame(spark, lists)).collect()}
    assert got == {(0, "aa"): 3, (0, "bb"): 1, (3, "zz"): 1, (4, "bb"): 5}


def test_counting_terms_of_a_document_needs_no_shuffle(spark):
    plan = doc_terms(tokens_frame(spark, [["a"]]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_tfidf_equals_brute_force(spark, sf):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    lists = [py_tokens(t) for _, t in sorted(texts)]
    tokens = tokens_frame(spark, lists).repartition(3)
    for k in (50, 5000):
        vocab, idf, cells = py_tfidf(lists, k)
        model = fit_vocab(tokens, k).collect()
        assert [r.term for r in sorted(model, key=lambda r: r.term_idx)] == vocab
        assert all(math.isclose(r.idf, idf[r.term], rel_tol=1e-12) for r in model)
        got = {(r.doc_id, vocab[r.term_idx]): r.weight for r in tfidf(tokens, fit_vocab(tokens, k)).collect()}
        assert got.keys() == cells.keys()
        assert all(math.isclose(w, cells[c], rel_tol=1e-9) for c, w in got.items())


def test_vocabulary_ties_and_bounds(spark):
    tokens = tokens_frame(spark, [["dd", "cc", "bb", "aa", "aa"], []])
    rows = {r.term: (r.term_idx, r.df, r.tf_total) for r in fit_vocab(tokens, 2).collect()}
    assert rows == {"aa": (0, 1, 2), "bb": (1, 1, 1)}
    for k in (0, -1):
        try:
            fit_vocab(tokens, k)
        except ValueError:
            continue
        raise AssertionError(k)
    assert fit_vocab(tokens, 10**9).count() == 4


def test_large_vocabularies_are_picked_alike(spark, sf, monkeypatch):
    tokens = corpus_tokens(spark.read.parquet(f"{sf}/documents.parquet"))
    for k in (1, 7, 300, 10**7):
        want = sorted(map(tuple, fit_vocab(tokens, k).collect()))
        monkeypatch.setattr(weights, "ONE_TASK_TERMS", 0)
        assert sorted(map(tuple, fit_vocab(tokens, k).collect())) == want
        monkeypatch.undo()
        assert [r[1] for r in sorted(want)] == list(range(len(want)))


def test_hot_term_is_counted_before_the_shuffle(spark):
    plan = term_stats(tokens_frame(spark, [["aa"]]))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan[plan.index("Exchange") :]


def test_lemmas_by_broadcast_and_by_shuffle(spark):
    lists = [["cats", "sat", "cats", "mice"], [], ["sat"]]
    lemma = spark.createDataFrame([("cats", "cat"), ("mice", "mouse")], "term string, lemma string")
    want = {0: ["cat", "sat", "cat", "mouse"], 1: [], 2: ["sat"]}
    tokens = tokens_frame(spark, lists)
    assert {r.doc_id: r.tokens for r in lemmatize(tokens, lemma).collect()} == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert {r.doc_id: r.tokens for r in lemmatize(tokens, lemma).collect()} == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


CSV_ROWS = [
    ["id", "text", "extra", "label"],
    ["1", 'He said "hi",\nthen left', "x", "1"],
    ["2", "", "x", "1"],
    ["3", "NA", "x", "0"],
    ["4", "no label", "x", ""],
    ["5", "Café 99 dogs", "x", "0"],
    ["6", "the and", "x", "1"],
]


def write_csv(path):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows(CSV_ROWS)


def test_csv_scan(spark, tmp_path):
    write_csv(tmp_path / "in.csv")
    rows = labelled_corpus(spark, str(tmp_path / "in.csv"), "int")
    assert rows.columns == ["text", "label"]
    assert sorted(map(tuple, rows.collect())) == [("Café 99 dogs", 0), ('He said "hi",\nthen left', 1), ("the and", 1)]


def test_labels_are_kept_as_they_are(spark, tmp_path):
    with open(tmp_path / "in.csv", "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([["text", "label"], ["a", "real"], ["b", "fake"], ["c", "1"]])
    rows = labelled_corpus(spark, str(tmp_path / "in.csv"))
    assert sorted(map(tuple, rows.collect())) == [("a", "real"), ("b", "fake"), ("c", "1")]
    with pytest.raises(Exception, match="label is no int"):
        labelled_corpus(spark, str(tmp_path / "in.csv"), "int").collect()


def test_corpus_stage(spark, tmp_path):
    write_csv(tmp_path / "in.csv")
    out = str(tmp_path / "out")
    stages.prepare_corpus(spark, str(tmp_path / "in.csv"), out)
    (part,) = (tmp_path / "out" / "corpus").glob("part-*.csv")
    with open(part, newline="", encoding="utf-8") as f:
        assert sorted(csv.reader(f)) == sorted([["text", "label"], ["said hi left", "1"], ["caf dogs", "0"], ["", "1"]])
    vocab = {r.term: r.term_idx for r in load_vocab(spark, f"{out}/vocabulary").collect()}
    assert vocab == {t: i for i, t in enumerate(sorted(["said", "hi", "left", "caf", "dogs"]))}
    weights = spark.read.parquet(f"{out}/weights").groupBy("doc_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("n"))
    assert all(math.isclose(r.n, 1.0) for r in weights.collect()) and weights.count() == 2


def test_lemmas_need_no_ids(spark):
    lemma = spark.createDataFrame([("cats", "cat"), ("cats", "cab"), ("mice", "mouse"), ("mice", None), (None, "x")], "term string, lemma string")
    rows = [(1, ["cats", "sit"], "a"), (1, ["cats", "sit"], "b"), (1, ["mice"], "c"), (None, ["mice", None, "cats"], "d"), (None, None, "e"), (3, [], "f"), (4, ["sit"], "g")]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>, term string")
    got = lemmatize(df, lemma)
    assert got.columns == df.columns
    assert {r.term: (r.doc_id, r.tokens) for r in got.collect()} == {
        "a": (1, ["cab", "sit"]), "b": (1, ["cab", "sit"]), "c": (1, ["mouse"]), "d": (None, ["mouse", None, "cab"]),
        "e": (None, None), "f": (3, []), "g": (4, ["sit"]),
    }
    assert got.count() == len(rows) and lemmatize(df.limit(0), lemma).count() == 0


def test_tokens_in_one_pass_are_those_of_the_expressions(spark):
    spaces = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
    texts = [None, "", " ", "x".join(spaces), "İstanbul Kelvin KELVIN ﬁx café ​zero​width", "a1 1a b_c d\x00e \x7f\x1bend", "The THE thé", "😀ab😀 Ābc"]
    texts += [f"{a}{chr(c)}{b}" for c in [*range(1, 0x250), *range(0x1E00, 0x2200), *range(0x3000, 0x3010), 0xFEFF] for a, b in [("ab", "cd")]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    got = df.select("doc_id", clean_tokens("text").alias("one"), tokens_of(corpus_clean("text")).alias("two")).collect()
    assert len(got) == len(texts) and all(r.one == r.two for r in got)
    plan = corpus_tokens(df)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "lambda" not in plan


def test_terms_of_null_lists_and_null_tokens(spark):
    rows = [(1, ["aa", None, "aa", "é", "éé"]), (None, None), (1, ["aa"]), (None, []), (None, ["zz", "zz"])]
    df = spark.createDataFrame(rows, "doc_id int, tokens array<string>")
    assert sorted(map(tuple, doc_terms(df).collect()), key=repr) == sorted([(1, "aa", 2), (1, "éé", 1), (1, "aa", 1), (None, "zz", 2)], key=repr)
    assert doc_terms(df.limit(0)).count() == 0 and doc_terms(df.filter("tokens IS NULL")).count() == 0


def test_vocabulary_counts_the_terms_once(spark):
    plan = fit_vocab(tokens_frame(spark, [["aa", "bb"]]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") == 1

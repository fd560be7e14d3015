import corpus_pipeline
from broadsheet.llm.queries import QUERIES, SQL

import __spark_entry__


def test_registered():
    names = __spark_entry__.queries()
    assert names.keys() >= {"pipeline", *QUERIES} and SQL.keys() <= QUERIES.keys()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "secrets", "packing"]


def test_stages_take_effect_one_after_the_other(spark, sf, documents, tmp_path):
    """Each stage against what the operators' queries, tested by themselves, say of the same rows."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, set(documents)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == columns
        seen[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    assert seen["language_id"] == kept
    groups = QUERIES["op1_simhash_near_dedup"](spark, sf).collect()
    assert seen["near_dedup"] == {r.component_id for r in groups} and len(seen["near_dedup"]) < len(kept)
    leaked = {r.doc_id for r in QUERIES["op5_decontamination"](spark, sf).filter("contaminated").collect()}
    assert seen["decontamination"] == seen["near_dedup"] - leaked and leaked & seen["near_dedup"]
    assert seen["secrets"] == seen["packing"] == seen["decontamination"]
    masked = {r.doc_id: r for r in spark.read.parquet(str(tmp_path / "secrets")).collect()}
    found = {r.doc_id: r for r in QUERIES["op8_secret_scan"](spark, sf).collect()}
    hidden = {i for i, r in masked.items() if r.text != documents[i].text}
    assert hidden == {i for i in masked if found[i].n_assign + found[i].n_access + found[i].n_hex} | (hidden & {i for i in masked if found[i].spans})
    assert all(r.n_chars == len(r.text) for r in masked.values())
    run = corpus_pipeline.run(spark, sf).select("doc_id", "start", "ids_crc32").collect()
    assert sorted(map(tuple, run)) == sorted(map(tuple, docs.select("doc_id", "start", "ids_crc32").collect()))


def test_odd_rows_and_empty_tables(spark, sf, odd_docs, no_docs):
    docs = empty = None
    for name, stage in corpus_pipeline.STAGES:
        docs, empty = stage(spark, odd_docs if docs is None else docs, sf), stage(spark, no_docs if empty is None else empty, sf)
        if name != "packing":
            assert docs.columns == empty.columns == odd_docs.columns
    assert empty.count() == 0
    # 8 is in letters that no labelled text has, 3, 4, 5 and 9 have none at all, 2 is a copy of 1
    assert {r.doc_id for r in docs.select("doc_id").collect()} == {1, 6, 7, 10, 11, None}

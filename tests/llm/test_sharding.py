import zlib
from collections import Counter

from pyspark.sql import functions as F

from broadsheet.llm import sharding
from broadsheet.llm.queries import QUERIES


def even_and_gapless(rows, shards):
    counts = Counter(r.shard for r in rows)
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True) and not counts.keys() - set(range(shards))
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query(spark, sf, documents):
    rows = QUERIES["op6_two_pass_sharding"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    even_and_gapless(rows, 40)
    for r in rows:
        data = (documents[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "rows", None)


def test_many_buckets_and_a_hot_record(spark):
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot " * 50).otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text"),
    )
    ranked = sharding.external_shuffle(docs, bucket_bytes=4000)
    rows = ranked.collect()
    assert sorted(r["rank"] for r in rows) == list(range(3000))
    key = lambda r: (r.doc_id, r.text)
    assert Counter(map(key, rows)) == Counter(map(key, docs.collect()))
    assert rows != sorted(rows, key=lambda r: r.doc_id)
    again = {r["rank"]: key(r) for r in ranked.collect()}
    assert again == {r["rank"]: key(r) for r in rows}
    other = {r["rank"]: key(r) for r in sharding.external_shuffle(docs, bucket_bytes=4000, seed=1).collect()}
    assert other != again
    # the hot record does not fill one stretch of the order
    hot = sorted(r["rank"] for r in rows if r.doc_id == 7)
    assert hot[-1] - hot[0] > 2000
    even_and_gapless(sharding.shuffle_into_shards(docs, 7, bucket_bytes=4000).collect(), 7)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs, tmp_path):
    sharded = sharding.shuffle_into_shards(odd_docs, 4)
    rows = sharded.collect()
    assert sharded.columns == [*odd_docs.columns, "shard", "slot"]
    even_and_gapless(rows, 4)
    assert Counter((r.doc_id, r.text, r.lang) for r in rows) == Counter((r[0], r[1], r[2]) for r in odd_rows)
    even_and_gapless(sharding.shuffle_into_shards(odd_docs, 40).collect(), 40)
    assert sharding.shuffle_into_shards(no_docs, 4).count() == 0
    sharding.write_shards(sharded, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(odd_rows)


def test_native_plan(spark, sf):
    plan = QUERIES["op6_two_pass_sharding"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan

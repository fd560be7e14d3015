import json

from pyspark.sql import functions as F

from broadsheet.operators.collect import read_daily
from broadsheet.plans import stages
from broadsheet.sources import descriptor_frame
from broadsheet.streaming import hourly_collection, interval_counts, start_collect, stream_dedup

ONCE = {"availableNow": True}
SOURCES = [{"type": "rss", "feeds": ["http://f"]}, {"type": "newsapi", "categories": ["tech"]}]


def land(root, kind, key, name, text):
    folder = root / f"source_type={kind}" / f"source_key={key}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def response(*urls):
    return json.dumps({"status": "ok", "articles": [{"url": u, "title": f"rest {u}"} for u in urls]})


def feed(*urls):
    items = "".join(f"<item><title>feed {u}</title><link>{u}</link></item>" for u in urls)
    return f"<rss><channel><title>F</title>{items}</channel></rss>"


def stored(spark, table):
    return sorted((r.url, r.title) for r in read_daily(spark, table).collect())


def test_start_collect(spark, tmp_path):
    landing, table, checkpoint = tmp_path / "landing", str(tmp_path / "daily"), str(tmp_path / "check")
    sources = descriptor_frame(spark, SOURCES)

    def collect(where=checkpoint):
        query = start_collect(spark, str(landing), table, sources, where, ONCE)
        query.awaitTermination()

    land(landing, "rss", "http%3A%2F%2Ff", "1", feed("a", "b", "b"))
    land(landing, "newsapi", "tech", "1", response("c", "d"))
    land(landing, "newsapi", "sport", "1", response("not asked for"))
    collect()
    want = [("a", "feed a"), ("b", "feed b"), ("c", "rest c"), ("d", "rest d")]
    assert stored(spark, table) == want

    land(landing, "newsapi", "tech", "2", response("a", "e"))
    land(landing, "rss", "http%3A%2F%2Ff", "2", "<rss><channel>torn")
    collect()
    want.append(("e", "rest e"))
    assert stored(spark, table) == want

    collect(str(tmp_path / "lost checkpoint"))  # everything is read again
    assert stored(spark, table) == want


def test_checkpoint_defaults_to_the_shared_folder(spark, tmp_path):
    land(tmp_path / "landing", "newsapi", "tech", "1", response("a"))
    query = start_collect(spark, str(tmp_path / "landing"), str(tmp_path / "daily"), descriptor_frame(spark, SOURCES), trigger=ONCE)
    query.awaitTermination()
    assert stored(spark, str(tmp_path / "daily")) == [("a", "rest a")]


def test_batch_stage_collects_the_same(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "rss", "http%3A%2F%2Ff", "1", feed("a", "b"))
    land(landing, "newsapi", "tech", "1", response("b", "c"))
    found = stages.collect(spark, str(landing), str(tmp_path / "daily"), descriptor_frame(spark, SOURCES))
    assert sorted((r.url, r.title) for r in found.collect()) == [("a", "feed a"), ("b", "feed b"), ("c", "rest c")]
    urls = [u for u, _ in stored(spark, str(tmp_path / "daily"))]
    assert urls == ["a", "b", "c"]


def events(spark, sf, tmp_path, files=3):
    source = spark.read.parquet(f"{sf}/events.parquet").select(
        F.col("ts").cast("timestamp").alias("fetched_ts"), F.col("event_type").alias("source"), F.col("user_id").cast("string").alias("url")
    )
    path = str(tmp_path / "events")
    source.repartitionByRange(files, "fetched_ts").write.parquet(path)
    return source, spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(path)


def drain(df, tmp_path, name):
    out = str(tmp_path / name)
    query = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-check").trigger(**ONCE).start()
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(out)


def test_stream_dedup(spark, sf, tmp_path):
    source, stream = events(spark, sf, tmp_path)
    users = {r.url for r in source.select("url").distinct().collect()}
    for salts in (1, 16):
        kept = drain(stream_dedup(stream, within="60 days", salts=salts), tmp_path, f"dedup{salts}").collect()
        assert len(kept) == len(users) and {r.url for r in kept} == users


def test_interval_counts_equal_the_batch_form(spark, sf, tmp_path):
    source, stream = events(spark, sf, tmp_path, files=1)
    final = drain(interval_counts(stream, late="0 seconds"), tmp_path, "counts").collect()
    batch = {(r.interval_start, r.source): r for r in hourly_collection(source).collect()}
    assert final
    for r in final:
        exact = batch[r.interval_start, r.source]
        assert r.n_rows == exact.n_rows and abs(r.n_unique - exact.n_unique) <= 1
    assert len(final) >= len(batch) * 0.9

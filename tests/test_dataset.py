import hashlib
import math

from pyspark.sql import functions as F

from broadsheet.operators.dataset import (
    by_uid,
    dataset_counts,
    limit_articles,
    preprocess_articles,
    shuffled,
    train_test_split,
)
from broadsheet.plans import stages
from broadsheet.schema import ARTICLE_COLUMNS
from broadsheet.sources import load_dataset, save_dataset


def ids(spark, n, parts=3):
    return spark.range(0, n, 1, parts).select(F.col("id").alias("doc_id"), F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"))


def key(i, seed=42):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest()


def test_limit(spark):
    df = ids(spark, 7)
    counts = {n: limit_articles(df, n).count() for n in (None, 0, 5, 99, -1)}
    assert counts == {None: 7, 0: 7, 5: 5, 99: 7, -1: 0}
    assert [r.url for r in limit_articles(df, 2).collect()] == ["u0", "u1"]


def test_limit_is_exact_and_stays_parallel(spark):
    rows = [("u", "t1", i % 3) for i in range(9)] + [("u", "t0", 5), (None, "t9", 1), ("a", None, 2)]
    df = spark.createDataFrame(rows, "url string, fetched_at string, x int").repartition(4)
    assert sorted(map(str, limit_articles(df, 3).collect())) == sorted(
        map(str, df.filter("url IS NULL OR url = 'a' OR fetched_at = 't0'").collect())
    )
    for n in range(1, 14):
        assert limit_articles(df, n).count() == min(n, 12)
    big = limit_articles(ids(spark, 100, 8), 60)
    assert big.rdd.getNumPartitions() > 4


def test_limit_runs_nothing_until_it_is_asked(spark):
    context = spark.sparkContext
    context.setJobGroup("building", "no job")
    late = limit_articles(ids(spark, 20), 5)
    assert list(context.statusTracker().getJobIdsForGroup("building")) == []
    context.setJobGroup("done", "")
    assert late.count() == 5
    assert limit_articles(ids(spark, 0), 5).count() == 0


def test_shuffled_spreads_rows_without_id(spark):
    df = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.col("id").alias("x"))
    rows = shuffled(df, "doc_id").collect()
    assert sorted(r.row_idx for r in rows) == list(range(3000))
    assert [r.x for r in sorted(rows, key=lambda r: r.row_idx)] != list(range(3000))
    assert sorted((r.row_idx, r.x) for r in shuffled(df.repartition(5), "doc_id").collect()) == sorted((r.row_idx, r.x) for r in rows)


def test_shuffled_keeps_a_row_without_id(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "doc_id long")
    assert sorted(r.row_idx for r in shuffled(df, "doc_id").collect()) == [0, 1, 2]


def test_very_small_test_side(spark):
    df = spark.range(1_000_000).select(F.col("id").alias("uid"))
    assert 15 <= train_test_split(df, 0.00004).filter("split = 'test'").count() <= 70


def test_counts(spark):
    assert [tuple(r) for r in dataset_counts(ids(spark, 3)).collect()] == [(3, False)]
    assert [tuple(r) for r in dataset_counts(ids(spark, 0)).collect()] == [(0, True)]


def test_by_uid(spark):
    uid = hashlib.sha256(b"u5").hexdigest()[:16]
    assert [r.doc_id for r in by_uid(ids(spark, 9), uid).collect()] == [5]


def test_shuffled_is_a_seeded_permutation(spark):
    for n, parts in ((0, 1), (1, 1), (500, 1), (500, 6)):
        rows = shuffled(ids(spark, n, parts), "doc_id").collect()
        assert [r.doc_id for r in sorted(rows, key=lambda r: r.row_idx)] == sorted(range(n), key=key)
        assert sorted(r.row_idx for r in rows) == list(range(n))
    other = {r.doc_id: r.row_idx for r in shuffled(ids(spark, 50), "doc_id", seed=7).collect()}
    assert sorted(other, key=other.get) == sorted(range(50), key=lambda i: key(i, 7))


def test_split_by_hash(spark):
    df = ids(spark, 3000)
    sides = {r.doc_id: r.split for r in train_test_split(df, id_col="doc_id").collect()}
    assert sides == {i: "test" if int(key(i)[:8], 16) % 10_000 < 1000 else "train" for i in range(3000)}
    more = {r.doc_id: r.split for r in train_test_split(ids(spark, 4000), id_col="doc_id").collect()}
    assert all(more[i] == side for i, side in sides.items())


def test_split_once_only(spark):
    split = train_test_split(ids(spark, 10), id_col="doc_id")
    assert train_test_split(split, 0.9) is split


def test_exact_split(spark):
    for n, size in ((0, 0.1), (1, 0.1), (10, 0.1), (11, 0.1), (1000, 0.25), (70, 1.0)):
        rows = train_test_split(ids(spark, n), size, id_col="doc_id", exact=True).collect()
        test = {r.doc_id for r in rows if r.split == "test"}
        assert len(rows) == n
        assert test == set(sorted(range(n), key=key)[: math.ceil(round(size * n, 9))])


def test_exact_split_keeps_copies_together(spark):
    """A third of the rows share one id."""
    df = ids(spark, 600).withColumn("uid", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("url")))
    rows = train_test_split(df, 0.2, exact=True).collect()
    assert len({r.split for r in rows if r.uid == "hot"}) == 1
    n_test = sum(r.split == "test" for r in rows)
    assert n_test >= 120 and (n_test == 120 or any(r.uid == "hot" and r.split == "test" for r in rows))


def test_preprocess_author(spark):
    rows = [("<b>t</b>", "b  b", "A<br>B"), (None, None, ""), ("", "x", None)]
    df = spark.createDataFrame([(*r, "left  alone") for r in rows], "title string, body string, author string, source string")
    assert {tuple(r) for r in preprocess_articles(df).collect()} == {
        ("t", "b b", "A B", "left  alone"),
        ("", "", "", "left  alone"),
        ("", "x", None, "left  alone"),
    }
    assert preprocess_articles(df).columns == df.columns


def test_save_and_load(spark, tmp_path):
    path = str(tmp_path / "data")
    assert save_dataset(ids(spark, 0), path) is False and not (tmp_path / "data").exists()
    assert save_dataset(ids(spark, 9), path) and load_dataset(spark, path).count() == 9
    split = train_test_split(ids(spark, 40), 0.3, id_col="doc_id")
    save_dataset(split, path)
    assert {p.name for p in (tmp_path / "data").iterdir() if p.is_dir()} == {"split=test", "split=train"}
    assert load_dataset(spark, path).filter("split = 'test'").count() == split.filter("split = 'test'").count()


def test_spread_only_where_cores_would_idle(spark, tmp_path):
    ids(spark, 100, 1).write.parquet(str(tmp_path / "one"))
    assert load_dataset(spark, str(tmp_path / "one"), "doc_id").rdd.getNumPartitions() == 4
    assert load_dataset(spark, str(tmp_path / "one")).rdd.getNumPartitions() == 1


def test_preprocess_stage_is_one_narrow_step(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "2024-01-01_articles.json").write_text('[{"title": "<i>a</i>", "body": "x &amp; y", "url": "u"}, {"title": "b", "url": "u"}]')
    assert stages.preprocess_raw_files(spark, str(raw), str(tmp_path / "out"))
    rows = load_dataset(spark, str(tmp_path / "out"))
    assert rows.columns == ARTICLE_COLUMNS
    assert sorted((r.title, r.body, r.url) for r in rows.collect()) == [("a", "x & y", "u"), ("b", "", "u")]
    plan = preprocess_articles(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1

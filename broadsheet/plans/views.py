"""The driver's tables seen as articles, payloads, pages and a labelled corpus.

A payload gathers the documents of one id range (100 or 1,000 ids), so no group
grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.sources.tables import load_dataset

LONG_TITLE = 300


def table(spark: SparkSession, sf_dir: str, name: str, spread_by: str | None = None) -> DataFrame:
    return load_dataset(spark, f"{sf_dir}/{name}.parquet", spread_by)


def v_articles(spark: SparkSession, sf_dir: str, spread_by: str | None = None) -> DataFrame:
    """One article per document; copies of a text share its url.

    Sources with a one-digit number come from the REST source, others from feeds.
    """
    number = F.regexp_extract("source", "[0-9]+", 0).cast("int")
    return table(spark, sf_dir, "documents", spread_by).select(
        "doc_id",
        "lang",
        F.regexp_extract("text", r"^[^.\n]*", 0).alias("title"),
        F.col("text").alias("body"),
        F.concat(F.lit("https://news.example.com/"), F.substring(F.sha2(F.col("text").cast("binary"), 256), 1, 16)).alias("url"),
        "source",
        F.concat(F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("n_chars", F.lit(365)).cast("int")).cast("string"), F.lit("T00:00:00Z")).alias("published_at"),
        F.concat(F.lit("Desk "), "lang").alias("author"),
        F.create_map(F.lit("category"), F.col("lang"), F.lit("provider"), F.lit("newsapi")).alias("metadata"),
        F.concat(F.lit("2024-01-0"), (F.pmod(number, F.lit(3)) + 1).cast("string"), F.lit("T06:00:00")).alias("fetched_at"),
        F.when(number < 10, 0).otherwise(1).alias("source_ord"),
        number.alias("feed_ord"),
        F.col("doc_id").alias("pos"),
    )


# Model answers in every shape, also outside the format that was asked for. The text is SQL
# that both engines read.
ANSWERS = {
    "sentiment": "CASE doc_id % 4 WHEN 0 THEN 'Sentiment: Bullish | Reasoning: ' || title WHEN 1 THEN 'Sentiment: Bearish|Reasoning:' "
    "|| source WHEN 2 THEN 'I would say ' || title ELSE 'Well. Sentiment: Neutral | Reasoning: a | b' || chr(10) || 'c' END",
    "impact": "CASE WHEN doc_id % 5 = 0 THEN 'High: ' || title ELSE 'Impact Score: ' || CAST(doc_id % 13 AS STRING) || ' | Description: ' "
    "|| title END",
    "entities": "CASE WHEN doc_id % 7 = 0 THEN ',' ELSE replace(title, ' ', ' , ') END",
}


def v_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document and task with what a model might have answered."""
    answers = F.array(*(F.struct(F.lit(t).alias("task"), F.expr(a).alias("answer")) for t, a in ANSWERS.items()))
    return v_articles(spark, sf_dir).select("doc_id", "lang", "url", "title", F.inline(answers))


def v_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as articles: closed ones have their heading as author, others none."""
    heading = F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1)
    return table(spark, sf_dir, "pages", "page_id").select(
        "page_id",
        "url",
        F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"),
        F.col("html").alias("body"),
        F.when(F.col("html").endswith("</html>"), heading).alias("author"),
    )


def v_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its label, which is null where there is none."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return table(spark, sf_dir, "documents").select("doc_id", "text").join(labels, "doc_id", "left")


def v_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("fetched_ts"), F.col("event_type").alias("source"), F.col("user_id").cast("string").alias("url")
    )


# -- payloads built from articles -------------------------------------------


def _title(articles_title: Column) -> Column:
    """No title where the first sentence runs on."""
    return F.when(F.length(articles_title) <= LONG_TITLE, articles_title)


def v_untitled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v_articles(spark, sf_dir).withColumn("title", _title(F.col("title")))


def _gathered(df: DataFrame, keys: list[str], ids: int, item: Column) -> DataFrame:
    """Items of one key and id range, in id order."""
    items = F.sort_array(F.collect_list(F.struct("doc_id", item.alias("item"))))
    return (
        df.withColumn("chunk", F.expr(f"doc_id div {ids}"))
        .groupBy(*keys, "chunk")
        .agg(F.transform(items, lambda s: s["item"]).alias("items"))
    )


def newsapi_payloads(articles: DataFrame) -> DataFrame:
    """A response per language and 100 ids, each followed by a failed one.

    Fields are spelled in every way the source has: present, null and absent.
    """
    lang = F.col("lang")
    common = [F.col("url"), F.col("title"), F.lit("x").alias("urlToImage"), F.col("body").alias("description")]
    plain = F.to_json(
        F.struct(
            *common,
            F.when(lang == "es", "").otherwise(F.col("body")).alias("content"),
            F.when(lang != "es", F.struct(F.when(lang == "en", F.col("source")).alias("name"))).alias("source"),
            F.when(lang == "en", F.col("author")).alias("author"),
            F.when(lang.isin("en", "fr"), F.col("published_at")).alias("publishedAt"),
        )
    )
    nulls = F.to_json(
        F.struct(*common, *[F.lit(None).cast("string").alias(n) for n in ("content", "source", "author", "publishedAt")]),
        {"ignoreNullFields": "false"},
    )
    item = F.when(lang == "de", nulls).otherwise(plain)
    envelope = F.concat(F.lit('{"status":"ok","articles":['), F.array_join("items", ","), F.lit("]}"))
    failed = F.lit('{"status":"error","message":"rate limited"}')
    return _gathered(articles, ["lang"], 100, item).select(
        F.col("lang").alias("source_key"),
        F.lit("2024-01-01T06:00:00").alias("fetched_at"),
        F.lit(0).alias("source_ord"),
        F.lit(0).alias("feed_ord"),
        F.explode(F.array(envelope, failed)).alias("value"),
    )


def _xml(col: Column) -> Column:
    for char, entity in {"&": "&amp;", "<": "&lt;", ">": "&gt;"}.items():
        col = F.replace(col, F.lit(char), F.lit(entity))
    return col


def _element(name: str, col: Column) -> Column:
    """An element, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"<{name}>"), _xml(col), F.lit(f"</{name}>")), F.lit(""))


def rss_payloads(articles: DataFrame) -> DataFrame:
    """A feed per source and 1,000 ids: RSS for one-digit sources, Atom for others.

    Full content and summary, full content only, or summary only, by language;
    Atom feeds have no title of their own. Some feeds are faulty; every item is whole.
    """
    lang = F.col("lang")
    whole = F.when(lang != "fr", F.when(lang == "es", "").otherwise(F.col("body")))
    short = F.when(lang != "de", F.col("body"))
    rss = F.concat(
        F.lit("<item>"),
        _element("title", F.col("title")),
        _element("link", F.col("url")),
        _element("content:encoded", whole),
        _element("description", short),
        _element("dc:creator", F.when(lang == "en", F.col("author"))),
        _element("pubDate", F.when(lang != "es", F.col("published_at"))),
        F.lit("</item>"),
    )
    atom = F.concat(
        F.lit("<entry>"),
        _element("title", F.col("title")),
        F.lit('<link rel="self" href="https://feeds.example.com/self"/><link href="'),
        F.col("url"),
        F.lit('"/>'),
        _element("content", whole),
        _element("summary", short),
        F.coalesce(F.concat(F.lit("<author>"), _element("name", F.when(lang == "en", F.col("author"))), F.lit("</author>")), F.lit("")),
        _element("updated", F.when(lang != "es", F.col("published_at"))),
        F.lit("</entry>"),
    )
    joined = F.array_join("items", "")
    rss_feed = F.concat(
        F.lit('<rss version="2.0" xmlns:content="c" xmlns:dc="d"><channel><title>Feed '), "source", F.lit("</title>"), joined, F.lit("</channel></rss>")
    )
    atom_feed = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), joined, F.lit("</feed>"))
    # feeds as they come: one is cut off, one has blanks before its declaration
    rss_feed = F.when(F.col("source") == "src3", F.left(rss_feed, F.length(rss_feed) - 10)).when(
        F.col("source") == "src1", F.concat(F.lit("\n  <?xml version='1.0'?>"), rss_feed)
    ).otherwise(rss_feed)
    atom_feed = F.when(F.col("source") == "src12", F.left(atom_feed, F.length(atom_feed) - 3)).otherwise(atom_feed)
    gathered = _gathered(articles, ["source", "source_ord", "feed_ord"], 1000, F.when(F.col("source_ord") == 0, rss).otherwise(atom))
    return gathered.select(
        F.concat(F.lit("https://feeds.example.com/"), "source").alias("source_key"),
        F.lit("2024-01-01T06:00:00").alias("fetched_at"),
        "source_ord",
        "feed_ord",
        F.when(F.col("source_ord") == 0, rss_feed).otherwise(atom_feed).alias("value"),
    )


def article_texts() -> Column:
    """Article JSON with a key the schema does not know; author null or absent by language."""
    fields = ["title", "body", "url", "source", "published_at"]
    tail = ["metadata", "fetched_at"]
    author = F.when(F.col("lang").isin("en", "fr"), F.col("author")).alias("author")
    plain = F.to_json(F.struct(*fields, author, *tail, F.lit(1).alias("score")))
    null_author = F.to_json(F.struct(*fields, author, *tail), {"ignoreNullFields": "false"})
    return F.when(F.col("lang") == "de", null_author).otherwise(plain)


def raw_files(articles: DataFrame) -> DataFrame:
    """A JSON array per language and 100 ids, ending in a stray number, and a torn copy of it."""
    array = F.concat(F.lit("["), F.array_join("items", ","), F.lit(",7]"))
    torn = F.concat(F.lit("["), F.array_join("items", ","))
    name = F.concat_ws("-", "lang", "chunk")
    files = F.array(
        F.struct(F.concat(name, F.lit(".json")).alias("path"), array.alias("value")),
        F.struct(F.concat(name, F.lit("-torn.json")).alias("path"), torn.alias("value")),
    )
    return _gathered(articles, ["lang"], 100, article_texts()).select(F.inline(files))

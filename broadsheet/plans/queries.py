"""One query per operator over the driver's tables.

Each function takes (spark, sf_dir); its name is the key of the query. Counts and
positions are BIGINT so that they compare with the SQL of ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet import functions as text
from broadsheet import sources
from broadsheet.operators import answers, collect, corpus, dataset, near_dups, prompts, reports
from broadsheet.operators import tfidf as weights
from broadsheet.plans import views
from broadsheet.sources import newsapi
from broadsheet.streaming import counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

_FLAT = ["title", "body", "url", "source", "published_at", "author"]


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def _long(*names: str) -> list[Column]:
    return [F.col(n).cast("bigint").alias(n) for n in names]


def _metadata(*keys: str) -> list[Column]:
    return [F.col("metadata")[k].alias(k) for k in keys]


# -- collect ------------------------------------------------------------------


@query
def scan_raw_articles(spark, sf):
    articles, _ = sources.parse_raw_files(views.raw_files(views.v_articles(spark, sf)))
    return articles.select("path", *_long("pos"), *_FLAT, "fetched_at", *_metadata("category"))


@query
def raw_rejects(spark, sf):
    _, rejects = sources.parse_raw_files(views.raw_files(views.v_articles(spark, sf)))
    return rejects.select("path", *_long("pos"))


def _items(spark, sf) -> DataFrame:
    return newsapi.payload_items(views.newsapi_payloads(views.v_untitled(spark, sf)))


def _item_columns() -> list[Column]:
    url = F.try_variant_get("item", "$.url", "string").alias("url")
    return [F.col("source_key").alias("category"), *_long("pos"), url]


@query
def newsapi_items(spark, sf):
    return _items(spark, sf).select(*_item_columns())


@query
def page_capped(spark, sf):
    return sources.page_capped(_items(spark, sf), 50).select(*_item_columns())


@query
def newsapi_articles(spark, sf):
    articles = sources.newsapi_articles(views.newsapi_payloads(views.v_untitled(spark, sf)), page_size=100)
    return articles.select(*_FLAT, *_metadata("category", "provider"), *_long("pos"))


@query
def rss_articles(spark, sf):
    articles = sources.rss_articles(views.rss_payloads(views.v_untitled(spark, sf)))
    return articles.select(*_FLAT, *_metadata("feed_url", "provider"), *_long("source_ord", "feed_ord", "pos"))


DESCRIPTORS = [
    {"type": "rss", "feeds": ["src3", "src1", "src19"]},
    {"type": "newsapi", "categories": ["fr", "en"], "page_size": 500},
    {"type": "rss", "feeds": ["src2"], "enabled": False},
    {"type": "scraper", "feeds": ["src5"]},
    {"type": "rss", "feeds": ["src12", "src7"], "page_size": 20},
]


@query
def enabled_sources(spark, sf):
    """A document arrives twice: in its language's category and in its source's feed."""
    arrivals = F.array(
        F.struct(F.lit("newsapi").alias("source_type"), F.col("lang").alias("source_key")),
        F.struct(F.lit("rss").alias("source_type"), F.col("source").alias("source_key")),
    )
    payloads = views.table(spark, sf, "documents").select("doc_id", F.inline(arrivals))
    used = sources.enabled_sources(payloads, sources.descriptor_frame(spark, DESCRIPTORS))
    return used.select("doc_id", "source_type", "source_key", *_long("source_ord", "feed_ord", "page_size"))


@query
def collect_union(spark, sf):
    """REST sources through responses, feed sources through feeds, then one frame."""
    articles = views.v_untitled(spark, sf)
    rest = sources.newsapi_articles(views.newsapi_payloads(articles.filter("source_ord = 0")), page_size=100)
    feeds = sources.rss_articles(views.rss_payloads(articles.filter("source_ord = 1")))
    return collect.collect_union(rest, feeds).select(*_FLAT, *_long("source_ord", "feed_ord", "pos"))


@query
def valid_articles(spark, sf):
    return collect.valid_articles(views.v_untitled(spark, sf)).select("doc_id", "url", "title")


@query
def dedup_url(spark, sf):
    first = collect.dedup_url(views.v_articles(spark, sf), order=["source_ord", "feed_ord", "pos"])
    return first.select("url", "doc_id", "source", "title", "body")


@query
def daily_merge(spark, sf):
    """The REST sources' articles are stored already; the feeds' come as a batch."""
    articles = views.v_articles(spark, sf)
    stored = collect.daily_batch(articles.filter("source_ord = 0"))
    fresh = collect.new_for_day(collect.daily_batch(articles.filter("source_ord = 1")), stored)
    merged = stored.unionByName(fresh)
    return merged.select(F.col("ingest_date").cast("string").alias("ingest_date"), "url", "source", "title", "body")


@query
def collection_stats(spark, sf):
    return collect.collection_stats(views.v_articles(spark, sf))


@query
def collection_totals(spark, sf):
    return collect.collection_totals(views.v_articles(spark, sf))


@query
def hourly_collection(spark, sf):
    return counts.hourly_collection(views.v_arrivals(spark, sf))


# -- article fields -------------------------------------------------------------


@query
def article_uid(spark, sf):
    return views.v_articles(spark, sf).select("doc_id", "url", text.article_uid("url").alias("uid"))


@query
def article_from_json(spark, sf):
    stored = views.v_articles(spark, sf).select("doc_id", views.article_texts().alias("value"))
    parsed = sources.article_from_json(stored, "value")
    return parsed.select("doc_id", *_FLAT, "fetched_at", *_metadata("category", "provider"))


@query
def article_to_json(spark, sf):
    return views.v_articles(spark, sf).select("doc_id", text.article_json().alias("json"))


# -- text -------------------------------------------------------------------------


@query
def html_text(spark, sf):
    return views.table(spark, sf, "pages", "page_id").select("page_id", text.html_text("html").alias("text"))


@query
def nfkd_text(spark, sf):
    return views.table(spark, sf, "documents", "doc_id").select("doc_id", text.nfkd("text").alias("text"))


@query
def normalize_ws(spark, sf):
    return views.table(spark, sf, "documents", "doc_id").select("doc_id", text.normalize_ws("text").alias("text"))


@query
def clean_text(spark, sf):
    return views.table(spark, sf, "pages", "page_id").select("page_id", text.clean_text("html").alias("text"))


@query
def preprocess_articles(spark, sf):
    return dataset.preprocess_articles(views.v_pages(spark, sf))


@query
def preprocess_documents(spark, sf):
    cleaned = dataset.preprocess_articles(views.v_articles(spark, sf, "doc_id"))
    return cleaned.select("doc_id", "title", "body", "author")


# -- dataset ------------------------------------------------------------------------


@query
def dataset_counts(spark, sf):
    return dataset.dataset_counts(views.v_articles(spark, sf))


@query
def limit_articles(spark, sf):
    return dataset.limit_articles(views.v_articles(spark, sf), 100, ["url", "doc_id"]).select("doc_id", "url")


@query
def train_test_split(spark, sf):
    articles = views.v_articles(spark, sf).withColumn("uid", text.article_uid("url"))
    return dataset.train_test_split(articles).select("doc_id", "uid", "split")


@query
def train_test_split_exact(spark, sf):
    articles = views.v_articles(spark, sf)
    return dataset.train_test_split(articles, id_col="doc_id", exact=True).select("doc_id", "split")


# -- analyse ------------------------------------------------------------------------


@query
def task_fanout(spark, sf):
    return prompts.task_fanout(views.v_articles(spark, sf)).select("doc_id", *_long("task_ord"), "task")


@query
def build_prompts(spark, sf):
    made = prompts.build_prompts(views.v_articles(spark, sf), keep=["doc_id"])
    return made.select("doc_id", "uid", *_long("task_ord"), "task", "prompt")


def measuring_model():
    """A stand-in model: the length of the prompt, between blanks."""
    return lambda batch: [f" chars:{len(p)}\n" for p in batch]


@query
def generate_answers(spark, sf):
    made = prompts.build_prompts(views.v_articles(spark, sf, "doc_id"), keep=["doc_id"])
    return answers.generate_answers(made, measuring_model).select("doc_id", "task", "answer")


@query
def analysis_report(spark, sf):
    reports = answers.analysis_report(views.v_articles(spark, sf, "doc_id"), measuring_model, keep=["doc_id"])
    return reports.select("doc_id", "title", "url", F.explode("analysis").alias("task", "answer"))


# -- reports -----------------------------------------------------------------------


@query
def parsed_answers(spark, sf):
    parsed = reports.parsed_answers(views.v_answers(spark, sf))
    entities = F.array_join("entities", "|").alias("entities")
    return parsed.select("doc_id", "task", "answer", "sentiment", "reasoning", *_long("impact_score"), "description", entities)


@query
def length_filter(spark, sf):
    return reports.length_filter(views.v_articles(spark, sf)).select("doc_id", "body")


@query
def language_filter(spark, sf):
    return reports.language_filter(views.v_articles(spark, sf)).select("doc_id", "url")


@query
def near_dup_pairs(spark, sf):
    return near_dups.near_dup_pairs(views.v_articles(spark, sf))


@query
def near_dedup(spark, sf):
    return near_dups.near_dedup(views.v_articles(spark, sf).select("doc_id", "url", "body")).select("doc_id", "url")


def _scored(spark, sf) -> DataFrame:
    parsed = reports.parsed_answers(views.v_answers(spark, sf)).filter("task = 'impact'")
    return parsed.withColumn("uid", text.article_uid("url"))


@query
def top_articles(spark, sf):
    return reports.top_articles(_scored(spark, sf), ties=["uid", "doc_id"]).select("doc_id", "uid", *_long("impact_score"))


SECTIONS = [
    ("en", "Top Developments"),
    ("en", "Key Signals"),
    ("es", "Technology Highlights"),
    ("fr", "Market Signals"),
    ("de", "Geopolitical Events"),
    ("de", "Key Signals"),
]


@query
def report_sections(spark, sf):
    mapping = spark.createDataFrame(SECTIONS, "lang string, section string")
    placed = reports.report_sections(_scored(spark, sf), mapping, on="lang", ties=["uid", "doc_id"])
    return placed.select("section", *_long("place"), "doc_id", *_long("impact_score"))


# -- corpus -------------------------------------------------------------------------


def _documents(spark, sf) -> DataFrame:
    return views.table(spark, sf, "documents", "doc_id").select("doc_id", "text")


def _tokens(spark, sf) -> DataFrame:
    return corpus.corpus_tokens(_documents(spark, sf)).select("doc_id", "tokens")


@query
def labelled_corpus(spark, sf):
    return sources.labelled_corpus(views.v_corpus(spark, sf)).select("text", *_long("label"))


@query
def shuffled_corpus(spark, sf):
    labelled = sources.labelled_rows(views.v_corpus(spark, sf))
    return dataset.shuffled(labelled, "doc_id").select("doc_id", *_long("row_idx"))


@query
def corpus_clean(spark, sf):
    return _documents(spark, sf).select("doc_id", text.corpus_clean("text").alias("text"))


@query
def corpus_tokens(spark, sf):
    return _tokens(spark, sf).select(
        "doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), corpus.processed_text().alias("text")
    )


@query
def corpus_lemmas(spark, sf):
    """The lemma table maps a word in s to the corpus word it is the plural of."""
    term = F.col("term")
    plural = F.when(term.endswith("s"), F.struct(F.expr("left(term, length(term) - 1)").alias("lemma"), F.lit(True).alias("plural")))
    forms = F.array_compact(F.array(F.struct(term.alias("lemma"), F.lit(False).alias("plural")), plural))
    lemma = (
        weights.doc_terms(_tokens(spark, sf))
        .select(F.inline(forms))
        .groupBy("lemma")
        .agg(F.bool_or("plural").alias("has_plural"), F.bool_and("plural").alias("has_plural_only"))
        .filter("has_plural AND NOT has_plural_only")
        .select(F.concat("lemma", F.lit("s")).alias("term"), "lemma")
    )
    lemmas = corpus.lemmatize(_tokens(spark, sf), lemma)
    return lemmas.select("doc_id", corpus.processed_text().alias("text"))


@query
def term_stats(spark, sf):
    return weights.term_stats(_tokens(spark, sf))


@query
def tfidf_vocab(spark, sf):
    vocab = weights.fit_vocab(_tokens(spark, sf))
    return vocab.select("term", *_long("term_idx"), "df", "tf_total", F.round("idf", 6).alias("idf"))


@query
def tfidf(spark, sf):
    tokens = _tokens(spark, sf)
    cells = weights.tfidf(tokens, weights.fit_vocab(tokens))
    return cells.select("doc_id", *_long("term_idx"), F.round("weight", 6).alias("weight"))

from broadsheet.sources.descriptors import descriptor_frame, enabled_sources
from broadsheet.sources.feeds import rss_articles
from broadsheet.sources.landing import read_landing
from broadsheet.sources.newsapi import newsapi_articles, page_capped
from broadsheet.sources.raw_json import article_from_json, parse_raw_files, scan_raw_articles
from broadsheet.sources.tables import (
    labelled_corpus,
    labelled_rows,
    load_dataset,
    load_vocab,
    save_dataset,
    save_vocab,
    write_corpus,
    write_reports,
)

__all__ = [
    "article_from_json",
    "descriptor_frame",
    "enabled_sources",
    "labelled_corpus",
    "labelled_rows",
    "load_dataset",
    "load_vocab",
    "newsapi_articles",
    "page_capped",
    "parse_raw_files",
    "read_landing",
    "rss_articles",
    "save_dataset",
    "save_vocab",
    "scan_raw_articles",
    "write_corpus",
    "write_reports",
]

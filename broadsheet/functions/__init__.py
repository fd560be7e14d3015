from broadsheet.functions.fields import (
    article_json,
    article_uid,
    fetched_at_now,
    ingest_date,
    json_field,
    truthy,
)
from broadsheet.functions.text import (
    clean_columns,
    clean_text,
    corpus_clean,
    html_text,
    nfkd,
    normalize_ws,
    strip_ws,
)

__all__ = [
    "article_json",
    "article_uid",
    "clean_columns",
    "clean_text",
    "corpus_clean",
    "fetched_at_now",
    "html_text",
    "ingest_date",
    "json_field",
    "nfkd",
    "normalize_ws",
    "strip_ws",
    "truthy",
]

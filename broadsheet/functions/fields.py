"""Small column helpers for article fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.schema import ARTICLE_COLUMNS


def article_uid(url: Column | str = "url") -> Column:
    """First 16 hex digits of SHA-256 of the url."""
    return F.substring(F.sha2(_col(url).cast("binary"), 256), 1, 16)


def article_json() -> Column:
    """The article as one JSON object, null fields included."""
    return F.to_json(F.struct(*ARTICLE_COLUMNS), {"ignoreNullFields": "false"})


def fetched_at_now() -> Column:
    """The query's UTC time as ISO text; whole seconds carry no fraction."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return iso_text(now)


def iso_text(ts: Column) -> Column:
    text = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(text, r"\.000000$", "")


def ingest_date(fetched_at: Column | str = "fetched_at") -> Column:
    """UTC day of an ISO fetch time; one that cannot be read makes the job fail.

    Any day made up for it would differ between a run and its replay.
    """
    given = _col(fetched_at)
    day = F.substring(given, 1, 10).try_cast("date")
    return F.coalesce(day, F.raise_error(F.concat(F.lit("no fetch time: "), F.coalesce(given, F.lit("null")))).cast("date"))


def truthy(*cols: Column) -> Column:
    """The first column that is neither null nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def json_field(obj: Column, key: str, absent: str | None) -> Column:
    """A text field of a VARIANT object: ``absent`` if the key is missing, null if it says null."""
    path = f"$.{key}"
    missing = F.try_variant_get(obj, path, "variant").isNull()
    return F.when(missing, F.lit(absent)).otherwise(F.try_variant_get(obj, path, "string"))


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col

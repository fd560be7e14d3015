"""Typed fields of model answers, filters of the dataset, and what goes into a report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The answer formats that the prompts ask for, and the defaults of the filters.
SENTIMENT = r"(?s)Sentiment: *(Bullish|Bearish|Neutral) *\| *Reasoning: *(.*)"
IMPACT = r"(?s)Impact Score: *([0-9]+) *\| *Description: *(.*)"
MIN_LENGTH, MAX_LENGTH = 100, 10_000
LANGUAGE = "en"
TOP_N = 20


def _field(task: str, pattern: str, group: int) -> Column:
    """A group of the pattern in answers to ``task``; null for others and where it does not match."""
    return F.when(F.col("task") == task, F.nullif(F.regexp_extract("answer", pattern, group), F.lit("")))


def parsed_answers(answers: DataFrame, max_entities: int | None = None) -> DataFrame:
    """Add sentiment, reasoning, impact_score, description, entities to rows (task, answer).

    An answer that is not in its task's format, or a score outside 1..10, gives null
    fields; the answer itself stays. Entities are split at commas and trimmed, empty
    ones left out; ``max_entities`` keeps that many.
    """
    score = _field("impact", IMPACT, 1).try_cast("int")
    names = F.filter(F.transform(F.split("answer", ","), lambda e: F.trim(e)), lambda e: e != "")
    if max_entities is not None:
        names = F.slice(names, 1, max_entities)
    return answers.withColumns(
        {
            "sentiment": _field("sentiment", SENTIMENT, 1),
            "reasoning": _field("sentiment", SENTIMENT, 2),
            "impact_score": F.when(score.between(1, 10), score),
            "description": _field("impact", IMPACT, 2),
            "entities": F.when(F.col("task") == "entities", names),
        }
    )


def length_filter(df: DataFrame, low: int = MIN_LENGTH, high: int = MAX_LENGTH, column: str = "body") -> DataFrame:
    """Rows whose text has ``low`` to ``high`` characters; a null text has no length."""
    return df.filter(F.length(column).between(low, high))


def language_filter(df: DataFrame, language: str = LANGUAGE, column: str = "lang") -> DataFrame:
    """Rows in ``language``, by a stored column, so the test reaches the scan."""
    return df.filter(F.col(column) == language)


def _first(score: str, ties: list[str]) -> list[Column]:
    return [F.col(score).desc_nulls_last(), *map(F.col, ties)]


def top_articles(df: DataFrame, n: int = TOP_N, score: str = "impact_score", ties: list[str] | None = None) -> DataFrame:
    """The ``n`` rows of the highest score; ``ties``, by default the uid, make the order total."""
    return df.orderBy(*_first(score, ties or ["uid"])).limit(n)


def report_sections(
    df: DataFrame, mapping: DataFrame, n: int = TOP_N, on: str = "category", score: str = "impact_score", ties: list[str] | None = None
) -> DataFrame:
    """Rows of each section with their place in it, ``n`` at most.

    ``mapping`` is a table (``on``, section); a value may stand in several sections, and
    rows without one drop out. Each map task keeps its first ``n`` rows of a section
    before the shuffle, so a section with much of the input is no burden.
    """
    place = F.row_number().over(Window.partitionBy("section").orderBy(*_first(score, ties or ["uid"])))
    return df.join(mapping.select(on, "section"), on).withColumn("place", place).filter(F.col("place") <= n)

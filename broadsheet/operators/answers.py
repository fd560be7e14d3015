"""Running a model over prompts, and the report of one article.

A model is whatever the user's ``model_factory`` returns: a function from a list
of prompts to a list of answers. The factory runs once in each Python worker.
Sampling models answer differently each time, so write the result before using
it twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.functions.text import strip_ws
from broadsheet.operators.prompts import prompt, task_list

Model = Callable[..., Sequence[str]]

# Prompts per model call, and the message for an article without a body.
BATCH_SIZE = 8
# Answers are handed on after so many model calls.
SLICE_BATCHES = 4
NO_BODY = "Error: object of type 'NoneType' has no len()"


def _answer(model: Model, prompts: list[str], options: dict) -> list[str]:
    """Answers of one batch; if the batch fails, of each prompt or its error."""
    try:
        answers = list(model(prompts, **options))
        if len(answers) == len(prompts):
            return answers
        failure = f"Error: {len(answers)} answers to {len(prompts)} prompts"
    except Exception as error:  # noqa: BLE001 - whatever the model raises belongs in the report
        failure = f"Error: {error}"
    if len(prompts) == 1:
        return [failure]
    return [answer for p in prompts for answer in _answer(model, [p], options)]


def _slices(batches: Iterator[pa.Array], prompts: int) -> Iterator[pa.Array]:
    """Rows in slices of about so many prompts: what is answered leaves the task soon."""
    for rows in batches:
        at = 0
        while at < len(rows):
            some = rows.slice(at, max(1, prompts // max(1, len(rows[at].as_py() or []))))
            at += len(some)
            yield some


def _answers_udf(model_factory: Callable[[], Model], batch_size: int, options: dict):
    """Not deterministic, whatever the model: Spark must neither repeat nor move a call."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def answers(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = model_factory()
        for rows in _slices(batches, SLICE_BATCHES * batch_size):
            # the prompts of all rows in one flat list, so model batches span rows
            prompts = rows.flatten().to_pylist()
            asked = [i for i, p in enumerate(prompts) if p is not None]
            out: list[str | None] = [None] * len(prompts)
            for start in range(0, len(asked), batch_size):
                some = asked[start : start + batch_size]
                for i, text in zip(some, _answer(model, [prompts[i] for i in some], options)):
                    out[i] = text
            lengths = [0, *rows.value_lengths().fill_null(0).to_pylist()]
            offsets = pa.array(lengths, pa.int32()).to_numpy().cumsum().astype("int32")
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(out, pa.string()))

    return answers.asNondeterministic()


def _dealt(df: DataFrame, partitions: int | None) -> DataFrame:
    return df.repartition(partitions) if partitions else df


def generate_answers(
    prompts: DataFrame, model_factory: Callable[[], Model], batch_size: int = BATCH_SIZE, partitions: int | None = None, **options
) -> DataFrame:
    """Add ``answer`` to rows with a ``prompt``; an error becomes the answer's text.

    ``partitions`` deals the rows out anew before the model runs: a scan's splits can
    be far too long for one task of a slow model.
    """
    prompts = _dealt(prompts, partitions)
    answers = _answers_udf(model_factory, batch_size, options)
    answer = F.get(answers(F.array("prompt")), F.lit(0))
    return prompts.withColumn("answer", F.coalesce(strip_ws(answer), F.lit(NO_BODY)))


def analysis_report(
    articles: DataFrame,
    model_factory: Callable[[], Model],
    tasks: Sequence[str] | None = None,
    batch_size: int = BATCH_SIZE,
    keep: Sequence[str] = (),
    partitions: int | None = None,
    **options,
) -> DataFrame:
    """(title, url, analysis), one row per article; ``analysis`` maps task to answer.

    All prompts of an article travel in one row, so nothing is fanned out and
    gathered again: no shuffle, and copies of an article stay apart. ``partitions``
    is as in ``generate_answers``.
    """
    articles = _dealt(articles, partitions)
    for column, default in {"title": "No Title", "body": "", "url": "No URL"}.items():
        if column not in articles.columns:
            articles = articles.withColumn(column, F.lit(default))
    names = task_list(tasks)
    answers = _answers_udf(model_factory, batch_size, options)
    asked = articles.select(*keep, "title", "url", answers(F.array(*[prompt(t) for t in names])).alias("_answers"))
    texts = F.transform("_answers", lambda a: F.coalesce(strip_ws(a), F.lit(NO_BODY)))
    analysis = F.map_from_arrays(F.array(*[F.lit(t) for t in names]), texts)
    return asked.select(*keep, "title", "url", analysis.alias("analysis"))

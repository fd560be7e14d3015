"""Prompts per article and task."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.fields import article_uid

# Default tasks, body length, and the texts a prompt is made of.
DEFAULT_TASKS = ("summarize", "sentiment", "impact", "entities")
MAX_BODY = 2000
SYSTEM_TEXT = (
    "You are an expert financial and technology news analyst. "
    "Analyze the following article and provide a high-quality intelligence report. "
    "Respond ONLY in the requested format."
)
ENVELOPE = "<s>[INST] <<SYS>>\n{system}\n<</SYS>>\n\n{task} [/INST]"
TASK_TEXTS = {
    "summarize": """
Article:
{title}
{body}

Instruction: Provide a 2-3 sentence technical summary of the key developments in this article. Focus on 'the what' and 'the why'.
Summary:
""",
    "sentiment": """
Article:
{title}
{body}

Instruction: Classify the market sentiment of this news.
Options: [Bullish, Bearish, Neutral]
Reasoning: Briefly explain why.
Output format: Sentiment: <Option> | Reasoning: <Explanation>
""",
    "impact": """
Article:
{title}
{body}

Instruction: Assess the potential impact of this news on the relevant industry/market.
Scale: 1 (Minimal) to 10 (Critical)
Output format: Impact Score: <1-10> | Description: <One-sentence justification>
""",
    "entities": """
Article:
{title}
{body}

Instruction: Extract the top 5 key entities (Companies, People, Technologies, or Organizations) mentioned in this article.
Format: List them separated by commas.
Entities:
""",
}


def prompt_text(task: str) -> str:
    """A task's whole prompt with its places for title and body still open."""
    return ENVELOPE.format(system=SYSTEM_TEXT, task=TASK_TEXTS.get(task, TASK_TEXTS["summarize"]))


def task_list(tasks: Sequence[str] | None) -> list[str]:
    """The tasks in order, each once; none given means the default four."""
    return list(dict.fromkeys(tasks or DEFAULT_TASKS))


def prompt(task: str, title: Column | str = "title", body: Column | str = "body") -> Column:
    """The prompt text; an unknown task is a summary. Null if the body is null.

    Plain concatenation: braces and percent signs in an article stay as they are.
    """
    title = F.col(title) if isinstance(title, str) else title
    body = F.col(body) if isinstance(body, str) else body
    filled = {"title": F.coalesce(title, F.lit("None")), "body": F.left(body, F.lit(MAX_BODY))}
    pieces = re.split(r"\{(title|body)\}", prompt_text(task))
    return F.concat(*[filled[p] if i % 2 else F.lit(p) for i, p in enumerate(pieces)])


def task_fanout(df: DataFrame, tasks: Sequence[str] | None = None) -> DataFrame:
    """One row per article and task, with the task's place in the list."""
    listed = F.array(*[F.lit(t) for t in task_list(tasks)])
    return df.select("*", F.posexplode(listed).alias("task_ord", "task"))


def build_prompts(df: DataFrame, tasks: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """(uid, title, url, task_ord, task, prompt), one row per article and task."""
    made = F.array(*[F.struct(F.lit(t).alias("task"), prompt(t).alias("prompt")) for t in task_list(tasks)])
    return df.select(
        *keep, article_uid("url").alias("uid"), "title", "url", F.posexplode(made).alias("task_ord", "_made")
    ).select(*keep, "uid", "title", "url", "task_ord", "_made.*")

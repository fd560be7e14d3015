import json
import sys

import pytest
from conftest import as_dicts
from pyspark import cloudpickle

from broadsheet.operators.answers import NO_BODY, analysis_report, generate_answers
from broadsheet.operators.prompts import DEFAULT_TASKS, SYSTEM_TEXT, TASK_TEXTS, build_prompts, task_fanout
from broadsheet.plans import stages
from broadsheet.sources import save_dataset

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the models below
ARTICLE = "title string, body string, url string"


def py_prompt(task, title, body):
    text = TASK_TEXTS.get(task, TASK_TEXTS["summarize"]).format(title=title, body=body[:2000])
    return f"<s>[INST] <<SYS>>\n{SYSTEM_TEXT}\n<</SYS>>\n\n{text} [/INST]"


BODIES = ["", "short", "{title} %s {0} \\1 $1", "é😀" * 1001, "x" * 2000, "x" * 2001]


def test_prompts_equal_a_plain_formatter(spark):
    df = spark.createDataFrame([(f"t{i} {{body}}", b, f"u{i}") for i, b in enumerate(BODIES)], ARTICLE)
    tasks = [*DEFAULT_TASKS, "unheard of"]
    rows = build_prompts(df, tasks).collect()
    assert len(rows) == len(BODIES) * len(tasks)
    for r in rows:
        i = int(r.url[1:])
        assert r.task == tasks[r.task_ord]
        assert r.prompt == py_prompt(r.task, f"t{i} {{body}}", BODIES[i])


def test_missing_title_and_body(spark):
    df = spark.createDataFrame([(None, "b", "u"), ("t", None, "v")], ARTICLE)
    rows = {r.url: r.prompt for r in build_prompts(df, ["summarize"]).collect()}
    assert rows == {"u": py_prompt("summarize", None, "b"), "v": None}


def test_fanout(spark):
    df = spark.createDataFrame([("t", "b", "u")], ARTICLE)
    assert [(r.task_ord, r.task) for r in task_fanout(df).collect()] == list(enumerate(DEFAULT_TASKS))
    assert [r.task for r in task_fanout(df, []).collect()] == list(DEFAULT_TASKS)
    assert [r.task for r in task_fanout(df, ["a", "b", "a"]).collect()] == ["a", "b"]


def echo():
    return lambda prompts, **options: [f" {len(p)} {sorted(options.items())}\n" for p in prompts]


def fussy():
    """Fails a whole batch that holds a prompt about impact."""

    def model(prompts):
        if any("potential impact" in p for p in prompts):
            raise RuntimeError("too hard")
        return [f"fine {len(prompts)}" for _ in prompts]

    return model


def short():
    return lambda prompts: ["only one"]


def test_report(spark):
    df = spark.createDataFrame([("t", "b", "u"), ("t", None, "u"), (None, "c", "w")], ARTICLE).repartition(2)
    rows = as_dicts(analysis_report(df, echo, temperature=0.1))
    assert len(rows) == 3  # articles with one url stay two articles
    for r in rows:
        assert set(r["analysis"]) == set(DEFAULT_TASKS)
    by_body = {(r["title"], r["url"], r["analysis"]["impact"]) for r in rows}
    n = len(py_prompt("impact", "t", "b"))
    assert ("t", "u", f"{n} [('temperature', 0.1)]") in by_body
    assert ("t", "u", NO_BODY) in by_body
    assert (None, "w", f"{n + 3} [('temperature', 0.1)]") in by_body


def test_error_of_one_task_leaves_the_others(spark):
    df = spark.createDataFrame([(f"t{i}", "b", f"u{i}") for i in range(20)], ARTICLE)
    for r in as_dicts(analysis_report(df, fussy, batch_size=8)):
        assert r["analysis"]["impact"] == "Error: too hard"
        assert all(r["analysis"][t].startswith("fine") for t in DEFAULT_TASKS if t != "impact")


def test_model_that_answers_too_little(spark):
    df = spark.createDataFrame([("t", "b", "u")], ARTICLE)
    (r,) = as_dicts(analysis_report(df, short))
    assert set(r["analysis"].values()) == {"only one"}


@pytest.mark.parametrize("batch_size", [1, 3, 100])
def test_fanned_out_answers(spark, batch_size):
    df = spark.createDataFrame([(f"t{i}", "b" * i, f"u{i}") for i in range(30)], ARTICLE)
    made = build_prompts(df)
    rows = generate_answers(made, echo, batch_size).collect()
    assert len(rows) == 120 and all(r.answer == f"{len(r.prompt)} []" for r in rows)


def test_columns_the_dataset_lacks(spark):
    df = spark.createDataFrame([("b",)], "body string")
    (r,) = as_dicts(analysis_report(df, echo, ["summarize"]))
    assert (r["title"], r["url"]) == ("No Title", "No URL")


def test_report_needs_no_shuffle(spark):
    df = spark.createDataFrame([("t", "b", "u")], ARTICLE)
    assert "Exchange" not in analysis_report(df, echo)._jdf.queryExecution().executedPlan().toString()


def test_analyze_stage(spark, tmp_path):
    df = spark.createDataFrame([("é", "b", "u2"), (None, "b", "u1"), ("c", "b", "u3")], ARTICLE)
    save_dataset(df, str(tmp_path / "data"))
    stages.analyze(spark, str(tmp_path / "data"), str(tmp_path / "reports"), echo, ["entities"], limit=2)
    (folder,) = [p for p in (tmp_path / "reports").iterdir() if p.is_dir()]
    assert folder.name.startswith("report_ts=20")
    lines = [json.loads(line) for f in folder.glob("*.json") for line in f.read_text(encoding="utf-8").splitlines()]
    assert sorted((r["url"], r["title"]) for r in lines) == [("u1", None), ("u2", "é")]
    assert all(set(r) == {"title", "url", "analysis"} and list(r["analysis"]) == ["entities"] for r in lines)


def counting_factory(folder):
    """Each model call leaves a file that tells how many prompts it had."""

    def factory():
        import os
        import uuid

        def model(prompts):
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
                f.write(str(len(prompts)))
            return ["ok"] * len(prompts)

        return model

    return factory


def calls(folder):
    return [int(f.read_text()) for f in folder.iterdir()]


def test_each_prompt_is_asked_once(spark, tmp_path):
    df = spark.createDataFrame([(f"t{i}", "b", f"u{i}") for i in range(50)], ARTICLE)
    exploded = analysis_report(df, counting_factory(str(tmp_path))).selectExpr("url", "explode(analysis)")
    assert exploded.count() == 200 and len(exploded.columns) == 3
    for f in tmp_path.iterdir():
        f.unlink()
    rows = exploded.collect()
    assert len(rows) == 200 and sum(calls(tmp_path)) == 200


def test_answers_leave_in_slices_and_partitions_are_the_callers(spark, tmp_path):
    df = spark.createDataFrame([(f"t{i}", "b", f"u{i}") for i in range(70)], ARTICLE).coalesce(1)
    report = analysis_report(df, counting_factory(str(tmp_path)), ["summarize"], batch_size=4, partitions=5)
    assert report.rdd.getNumPartitions() == 5
    rows = report.collect()
    assert len(rows) == 70 and {r.analysis["summarize"] for r in rows} == {"ok"}
    assert sum(calls(tmp_path)) == 70 and max(calls(tmp_path)) == 4

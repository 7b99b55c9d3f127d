"""Native readers on tiny files in each format; validating loader on bad lines."""

import json
import os

import pandas as pd
import pytest

from mcqflow.sources.jsonl import load_validated
from mcqflow.sources.native import (read_arc, read_balacopa, read_boolean, read_logiqa, read_mcq_jsonl,
                                    read_race, read_reclor, read_tagged, read_winogrande)


def _lines(path, rows):
    with open(path, "w", encoding="utf-8") as f:
        for r in rows:
            f.write((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n")


def test_race_and_arc(spark, tmp_path):
    pd.DataFrame({"article": ["a1", "a2", "a3"], "question": ["q1", "q2", "q3"],
                  "options": ["['x', 'y']", '["u", "v"]', "[p, q]"], "answer": ["b", "A", "AB"]}
                 ).to_parquet(tmp_path / "race.parquet")
    r = read_race(spark, str(tmp_path / "race.parquet")).collect()
    assert [x.options for x in r] == [["x", "y"], ["u", "v"], ["p", " q"]]
    assert [x.label for x in r] == [1, 0, None]
    pd.DataFrame({"question": ["q"], "choices": [{"text": ["a", "b", "c"], "label": ["A", "B", "C"]}],
                  "answerKey": ["C"]}).to_parquet(tmp_path / "arc.parquet")
    a = read_arc(spark, str(tmp_path / "arc.parquet")).collect()[0]
    assert (a.text, a.options, a.label) == ("", ["a", "b", "c"], 2)


def test_json_formats(spark, tmp_path):
    _lines(tmp_path / "logiqa.txt", [{"text": "t", "question": "q", "options": ["a", "b"], "answer": 1}])
    assert read_logiqa(spark, str(tmp_path / "logiqa.txt")).collect()[0].label == 1
    (tmp_path / "reclor.json").write_text(json.dumps([{"context": "c", "question": "q", "answers": ["a", "b"],
                                                        "label": 0}] * 2))
    assert read_reclor(spark, str(tmp_path / "reclor.json")).count() == 2
    _lines(tmp_path / "wino.jsonl", [{"sentence": "s _", "option1": "a", "option2": "b", "answer": "2"}])
    w = read_winogrande(spark, str(tmp_path / "wino.jsonl")).collect()[0]
    assert (w.options, w.label) == (["a", "b"], 1)
    _lines(tmp_path / "bool.jsonl", [{"question": "is it", "passage": "p", "answer": False}])
    b = read_boolean(spark, str(tmp_path / "bool.jsonl")).collect()[0]
    assert (b.question, b.options, b.label) == ("Is it?", ["True", "False"], 1)


def test_balacopa_xml(spark, tmp_path):
    (tmp_path / "copa.xml").write_text(
        '<copa><item id="1" asks-for="cause" most-plausible-alternative="2">'
        "<p>The man fell.</p><a1>He slept.</a1><a2>He tripped.</a2></item></copa>")
    r = read_balacopa(spark, str(tmp_path / "copa.xml")).collect()[0]
    assert (r.text, r.question, r.options, r.label) == (
        "The man fell.", "Which may be the cause?", ["He slept.", "He tripped."], 1)


def test_validating_loader_reasons(spark, tmp_path):
    good = {"text": "t", "question": "q", "options": ["a", "b"], "label": 1}
    rows = ["", "bad", "[1]", {**good, "label": "1"}, {**good, "label": True}, {**good, "label": 1.0},
            {**good, "label": 1.5}, {**good, "options": ["a", None]}, {**good, "options": ["a", 3]},
            {**good, "options": "a,b"}, {**good, "options": ["a", "A"]}, {**good, "label": 2},
            {**good, "text": " ", "question": ""}, good]
    _lines(tmp_path / "d.jsonl", rows)
    got = {r.line_number: r.reason for r in load_validated(spark, str(tmp_path / "d.jsonl"), "d").collect()}
    assert got == {1: "json_parse_error", 2: "json_parse_error", 3: "missing_field", 4: "label_not_int",
                   5: "label_not_int", 6: "label_not_int", 7: "label_not_int",
                   8: "option_blank_or_not_string", 9: "option_blank_or_not_string",
                   10: "options_not_list_or_empty", 11: "duplicate_options", 12: "label_out_of_range",
                   13: "text_question_empty", 14: None}


def test_failfast_and_tagged(spark, tmp_path):
    _lines(tmp_path / "a.jsonl", [{"text": "t", "question": "q", "options": ["a", "b"], "label": 0}])
    _lines(tmp_path / "merged_dataset.jsonl", [{"text": "t", "question": "q", "options": ["a", "b"], "label": 0}])
    tagged = read_tagged(spark, str(tmp_path)).collect()
    assert [r.source for r in tagged] == ["a"]
    os.makedirs(tmp_path / "bad")
    _lines(tmp_path / "bad" / "x.jsonl", ["{oops"])
    with pytest.raises(Exception):
        read_mcq_jsonl(spark, str(tmp_path / "bad")).collect()


def test_read_by_suffix(spark, tmp_path):
    from mcqflow.sources.native import read_by_suffix
    row = {"text": "t", "question": "q", "options": ["a", "b"], "label": 1, "source": "s"}
    _lines(tmp_path / "d.jsonl", [row])
    pd.DataFrame([row]).to_parquet(tmp_path / "d.parquet")
    a = read_by_suffix(spark, str(tmp_path / "d.jsonl")).collect()[0]
    b = read_by_suffix(spark, str(tmp_path / "d.parquet")).collect()[0]
    assert a.label == b.label == 1 and list(a.options) == list(b.options) == ["a", "b"]


def test_positions_without_moving_rows(spark, tmp_path):
    """Files larger than a split: exact positions, and no exchange below them carries a text."""
    from mcqflow.sources.jsonl import read_lines
    from mcqflow.sources.native import place, with_positions
    for f, n in (("a", 4000), ("b", 1), ("c", 2500)):
        (tmp_path / f"{f}.txt").write_text("".join(f"{f} {k} {'x' * (k % 50)}\n" for k in range(n)))
    (tmp_path / "d.txt").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        lines = read_lines(spark, str(tmp_path))
        plan = lines._jdf.queryExecution().executedPlan().toString()
        rows = lines.collect()
        df = with_positions(spark.read.text(str(tmp_path)).select("value", *place()), "at")
        whole = df.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert all(int(r.raw.split()[1]) == r.line_number - 1 for r in rows) and len(rows) == 6501
    lines_of = lambda word: [x for x in plan.splitlines() if word in x]
    assert lines_of("BroadcastHashJoin") and not [x for x in lines_of("Sort") if "raw" in x or "value" in x]
    assert len(lines_of("Exchange")) == 2  # both of the map: its prefix sums, its broadcast
    first = {"a": 0, "b": 4000, "c": 4001}
    assert all(r.at == first[r.value.split()[0]] + int(r.value.split()[1]) for r in whole)


def test_bad_lines_and_cell_types(spark, tmp_path):
    """A source with broken lines stays whole, and so do the others."""
    from mcqflow.operators.clean import classify
    from mcqflow.sources.native import quarantine, read_catalogue
    (tmp_path / "logiqa.txt").write_text(
        '{"text": "t", "question": "q", "options": ["a", "b"], "answer": 1}\nnot json\n'
        '{"text": "t", "question": "q1", "options": [1, 2], "answer": 0}\n{"text": "t", "question": "q2", "options": "ab", "answer": 0}\n'
        '{"text": "t", "question": "q3", "options": ["a", null], "answer": 0}\n{"text": "t", "question": "q4", "options": ["a", "b"], "answer": "1"}\n'
        '{"text": "t", "question": "q5", "options": ["a", "b"], "answer": true}\n{"text": "t", "question": "q6"}\n')
    (tmp_path / "own.jsonl").write_text('{"text": "t", "question": "q", "options": ["a", "b"], "label": 0}\n{"text": \n')
    (tmp_path / "wino.jsonl").write_text('{"sentence": "s _", "option1": "a", "option2": 3, "answer": "1"}\n{"sentence": "s _", "option1": "a", "option2": "b", "answer": "2"}\n')
    rows = read_catalogue(spark, [("logiqa", "logiqa", f"{tmp_path}/logiqa.txt"), ("own", "mcq", f"{tmp_path}/own.jsonl", "g1"),
                                  ("wino", "winogrande", f"{tmp_path}/wino.jsonl"), ("gone", "race", f"{tmp_path}/none")])
    records, bad = quarantine(rows)
    assert sorted((r.dataset, r["index"], r.bad) for r in bad.collect()) == [("logiqa", 1, "not json"), ("own", 1, '{"text": ')]
    got = {(r.dataset, r["index"]): r.reason for r in classify(records, keep=["dataset", "index"]).collect()}
    assert got == {("logiqa", 0): None, ("logiqa", 2): "other_error", ("logiqa", 3): "other_error", ("logiqa", 4): "other_error",
                   ("logiqa", 5): "label_out_of_range", ("logiqa", 6): "label_out_of_range", ("logiqa", 7): "other_error",
                   ("own", 0): None, ("wino", 0): "other_error", ("wino", 1): None}
    assert {r.grp for r in rows.where("dataset = 'own'").collect()} == {"g1"}


def test_groups_lose_no_row(spark):
    from mcqflow.sources.native import assign_groups, group_audit
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4), (None, 5)], "dataset string, index long")
    groups = spark.createDataFrame([("a", "g1"), ("b", "lost"), ("c", None), (None, "g1")], "dataset string, grp string")
    ratios = spark.createDataFrame([("g1", 0.5, 0), ("g2", 0.5, 1)], "grp string, ratio double, grp_ord int")
    got = assign_groups(rows, groups, ratios)
    assert sorted((r["index"], r.grp, r.ratio, r.grp_ord) for r in got.collect()) == [
        (1, "g1", 0.5, 0), (2, "g1", 0.5, 0), (3, "unassigned", 0.0, 2), (4, "unassigned", 0.0, 2), (5, "unassigned", 0.0, 2)]
    assert {(r.dataset, r.grp, r.n) for r in group_audit(got).collect()} == {("a", "g1", 2), ("b", "unassigned", 1), ("c", "unassigned", 1), (None, "unassigned", 1)}


def test_parquet_options_in_text_form(spark, tmp_path):
    from mcqflow.sources.native import read_by_suffix
    spark.createDataFrame([("t", "['a', 'b']", 1)], "text string, options string, label int").write.parquet(f"{tmp_path}/x.parquet")
    r = read_by_suffix(spark, f"{tmp_path}/x.parquet").first()
    assert r.options == ["a", "b"] and r.label == 1 and r.question is None

"""Cleaning: golden counts, reject precedence, Python string rules."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from mcqflow.functions.text import WHITESPACE, is_valid_option, py_strip
from mcqflow.operators.clean import classify, reject_counts
from mcqflow.sources.fixtures import load_mcq

# Golden counts at sf 0.001 (FIXTURES.md).
GOLDEN = {"VALID": 179, "invalid_option": 4, "text_equals_question": 4, "label_out_of_range": 4,
          "too_few_options": 3, "duplicate_options": 2, "text_question_empty": 2, "duplicate_sample": 2}


def test_golden_reject_counts(spark):
    c = classify(load_mcq(spark, SF_SMALL), ["dataset"])
    got = {r.reason: r.n for r in reject_counts(c).collect()}
    assert got == GOLDEN
    assert c.where("reason is null and note is not null").count() == 3


def test_valid_plus_rejects_is_input(spark):
    m = load_mcq(spark, SF_SMALL)
    c = classify(m, ["dataset"])
    assert c.count() == m.count()


def test_strip_and_alnum_match_python(spark):
    samples = ["  a b　", "\x1c\x85x\t", " ", "  ", "①", "㉚", "?!", "é", "٣", "_"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = df.select(py_strip("s").alias("t"), is_valid_option(py_strip("s")).alias("ok")).collect()
    for s, r in zip(samples, got):
        assert r.t == s.strip()
        assert r.ok == any(ch.isalnum() for ch in s.strip())
    assert all(ch.isspace() for ch in WHITESPACE)


def test_precedence_on_hand_rows(spark):
    rows = [
        (0, "t", "q", ["a", " "], 0),          # blank option -> other_error
        (1, "t", "q", ["a", "?!"], 0),         # invalid_option
        (2, "t", "q", ["A", "a"], 0),          # one distinct left -> duplicate_options
        (3, "t", "q", ["a"], 0),               # too_few_options
        (4, "t", "q", ["a", "b"], 2),          # label_out_of_range
        (5, " ", "　", ["a", "b"], 0),     # text_question_empty
        (6, "Same", " same ", ["a", "b"], 0),  # text_equals_question
        (7, "t", "q", ["a", "b"], 1),          # valid
        (8, " t", "q ", ["a", "b"], 0),        # duplicate of 7 after strip
        (9, "t", "q", ["x", "X", "y"], 2),     # merged: [x, y], label -> 1
        (10, "t", "q", ["a", "b"], None),      # label missing -> label_out_of_range
    ]
    df = spark.createDataFrame(rows, "index bigint, text string, question string, options array<string>, label bigint")
    got = {r["index"]: r for r in classify(df.withColumn("dataset", F.lit("d")), ["dataset"]).collect()}
    expect = ["other_error", "invalid_option", "duplicate_options", "too_few_options", "label_out_of_range",
              "text_question_empty", "text_equals_question", None, "duplicate_sample", None, "label_out_of_range"]
    assert [got[i].reason for i in range(11)] == expect
    assert got[9].options == ["x", "y"] and got[9].label == 1 and got[9].original_label == 2
    assert got[9].note == "options_deduped_kept"

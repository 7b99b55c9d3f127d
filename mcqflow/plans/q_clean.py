"""Queries: converter cleaning (reject reasons, option merge, de-dup)."""

from __future__ import annotations

from pyspark.sql import functions as F

from mcqflow.operators.clean import (classify, mix_reason_typed, option_valid_flags,
                                     reject_counts, strict_reason)
from mcqflow.functions.text import blank_to_empty, py_strip
from mcqflow.plans.oracle_sql import CLASSIFIED, MCQ, STRIP, VALID, with_ctes
from mcqflow.plans.registry import register
from mcqflow.sources.fixtures import ROW_ID, load_mcq


def classified(spark, sf, keep=None, derive=None):
    """All columns (the text is scanned again, not written), or those of ``keep``
    and ``derive`` from one scan."""
    if keep is None and derive is None:
        return classify(load_mcq(spark, sf, row_id=True), ["dataset"], row_id=ROW_ID).drop(*ROW_ID)
    return classify(load_mcq(spark, sf), ["dataset"], keep=keep or [], derive=derive)


def valid(spark, sf, keep=None, derive=None):
    return classified(spark, sf, keep, derive).where(F.col("reason").isNull())


@register("clean_reject_counts", with_ctes(MCQ, CLASSIFIED) + """
SELECT coalesce(reason, 'VALID') AS reason, count(*) AS n FROM classified GROUP BY 1""")
def clean_reject_counts(spark, sf):
    return reject_counts(classified(spark, sf, keep=["index"]))


@register("clean_valid_rows", with_ctes(MCQ, CLASSIFIED) + """
SELECT "index", text, question, options, label, source, note FROM classified WHERE reason IS NULL""")
def clean_valid_rows(spark, sf):
    return valid(spark, sf).select("index", "text", "question", "options", "label", "source", "note")


@register("option_dedupe_remap", with_ctes(MCQ, CLASSIFIED) + """
SELECT "index", options, label, original_options, original_label, reason
FROM classified WHERE note IS NOT NULL""")
def option_dedupe_remap(spark, sf):
    return (classified(spark, sf, keep=["index", "options", "label", "original_options", "original_label", "note"])
            .where(F.col("note").isNotNull())
            .select("index", "options", "label", "original_options", "original_label", "reason"))


@register("option_valid_flag", with_ctes(MCQ) + """
SELECT "index", list_transform(options, lambda o: regexp_matches(o, '[\\pL\\pN]')) AS option_ok,
       len(list_filter(options, lambda o: NOT regexp_matches(o, '[\\pL\\pN]'))) = 0 AS all_ok
FROM mcq""")
def option_valid_flag(spark, sf):
    return option_valid_flags(load_mcq(spark, sf)).select("index", "option_ok", "all_ok")


@register("strict_validate", with_ctes(MCQ) + f"""
SELECT CASE
    WHEN text IS NULL OR question IS NULL OR options IS NULL OR label IS NULL THEN 'missing_field'
    WHEN {STRIP('text')} = '' OR {STRIP('question')} = '' THEN 'text_or_question_empty'
    WHEN len(options) = 0 THEN 'options_empty'
    WHEN len(list_filter(options, lambda o: o IS NULL OR {STRIP('o')} = '')) > 0 THEN 'option_blank'
    WHEN label < 0 OR label >= len(options) THEN 'label_out_of_range'
    ELSE 'VALID' END AS strict_reason,
  count(*) AS n, min("index") AS first_index
FROM mcq GROUP BY 1""")
def strict_validate(spark, sf):
    """P3 whole-set verdict: rows per outcome and the first offending index."""
    s = strict_reason(load_mcq(spark, sf))
    return (s.groupBy(F.coalesce("strict_reason", F.lit("VALID")).alias("strict_reason"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("index").alias("first_index")))


@register("mix_validate", with_ctes(MCQ) + f"""
SELECT CASE
    WHEN options IS NULL OR label IS NULL THEN 'missing_field'
    WHEN {STRIP("coalesce(text, '')")} = '' AND {STRIP("coalesce(question, '')")} = '' THEN 'text_question_empty'
    WHEN len(options) = 0 THEN 'options_not_list_or_empty'
    WHEN len(list_filter(options, lambda o: o IS NULL OR {STRIP('o')} = '')) > 0 THEN 'option_blank_or_not_string'
    WHEN len(list_distinct(list_transform(options, lambda o: lower({STRIP('o')})))) < len(options) THEN 'duplicate_options'
    WHEN label < 0 OR label >= len(options) THEN 'label_out_of_range'
    ELSE 'VALID' END AS mix_reason,
  count(*) AS n
FROM mcq GROUP BY 1""")
def mix_validate(spark, sf):
    """P4 on the adapter rows: counts per loader verdict."""
    s = mix_reason_typed(load_mcq(spark, sf))
    return (s.groupBy(F.coalesce("mix_reason", F.lit("VALID")).alias("mix_reason"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("sink_rejects", with_ctes(MCQ, CLASSIFIED) + """
SELECT dataset, reason, count(*) AS "count" FROM classified WHERE reason IS NOT NULL GROUP BY 1, 2""")
def q_sink_rejects(spark, sf):
    """K4: rejected rows written partitioned by dataset and reason, read back
    and counted per partition folder."""
    from mcqflow.session import scratch_path
    from mcqflow.sources.sinks import save_rejects
    back, _ = save_rejects(classified(spark, sf), scratch_path(spark, "rejects"))
    return back.groupBy("dataset", "reason").agg(F.count(F.lit(1)).alias("count"))


@register("reject_metrics", with_ctes(MCQ, CLASSIFIED) + """
SELECT reason, count(*) AS n FROM classified WHERE reason IS NOT NULL GROUP BY 1""")
def q_reject_metrics(spark, sf):
    """A2 + K4: the counts observed while the rejects were written."""
    from mcqflow.session import scratch_path
    from mcqflow.sources.sinks import save_rejects
    _, counts = save_rejects(classified(spark, sf), scratch_path(spark, "rejects"))
    return spark.createDataFrame(sorted(counts.items()), "reason string, n long")  # a row a reason


@register("clean_annotation_counts", with_ctes(MCQ, CLASSIFIED) + """
SELECT dataset, count(*) FILTER (WHERE note IS NOT NULL AND reason IS NULL) AS deduped_kept,
  count(*) FILTER (WHERE reason IS NULL) AS kept, count(*) FILTER (WHERE reason IS NOT NULL) AS invalid
FROM classified GROUP BY dataset""")
def q_clean_annotation_counts(spark, sf):
    """A2: kept rows, merged-and-kept rows (annotation), invalid rows."""
    from mcqflow.operators.clean import annotation_counts
    return annotation_counts(classified(spark, sf, keep=["dataset", "note"]), ["dataset"])


@register("source_value_counts", with_ctes(MCQ, CLASSIFIED, VALID) + """
SELECT source, n, CAST(row_number() OVER (ORDER BY n DESC, source) AS BIGINT) AS rank
FROM (SELECT source, count(*) AS n FROM valid GROUP BY source)""")
def q_source_value_counts(spark, sf):
    """Frequency-descending source counts with an explicit rank."""
    from mcqflow.operators.stats import value_counts
    return value_counts(valid(spark, sf, keep=["source"]), "source")


def _twice(m):
    """Every row twice, as where a folder is read twice."""
    return m.unionByName(m)


@register("clean_repeated_rows", with_ctes(MCQ, CLASSIFIED) + """
SELECT "index", CAST(2 AS BIGINT) AS n, CAST(CASE WHEN reason IS NULL THEN 1 ELSE 0 END AS BIGINT) AS valid,
  CAST(CASE WHEN reason IS NULL THEN 1 WHEN reason = 'duplicate_sample' THEN 2 ELSE 0 END AS BIGINT) AS duplicates
FROM classified""")
def q_clean_repeated_rows(spark, sf):
    """D1 on rows that repeat as a whole: one of two equal rows stays."""
    c = classify(_twice(load_mcq(spark, sf)), keep=["index"])
    return c.groupBy("index").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("reason").isNull()).alias("valid"),
                                  F.count_if(F.col("reason") == "duplicate_sample").alias("duplicates"))


_NULLED = """nulled AS (
  SELECT CASE WHEN "index" % 4 = 0 THEN NULL ELSE "index" END AS "index", text, question, options, label, source, grp,
    CASE WHEN "index" % 3 = 0 THEN NULL ELSE dataset END AS dataset, lang, "index" AS line FROM mcq),
twice AS (SELECT * FROM nulled UNION ALL SELECT * FROM nulled)"""


@register("dedupe_null_keys", with_ctes(MCQ, _NULLED) + f"""
SELECT line, dataset, count(*) AS n, CAST(max(f) AS BIGINT) AS firsts FROM (
  SELECT line, dataset, count(*) FILTER (WHERE rn = 1) OVER (PARTITION BY dataset, line) AS f FROM (
    SELECT line, dataset, row_number() OVER (PARTITION BY dataset, {STRIP("coalesce(text, '')")}, {STRIP("coalesce(question, '')")}, options
      ORDER BY "index" NULLS LAST, line) AS rn FROM twice)) GROUP BY 1, 2""")
def q_dedupe_null_keys(spark, sf):
    """W2 with NULL dataset and NULL position: NULLs are equal as keys, come last
    as positions, and one row of each sample is first."""
    from mcqflow.operators.dedup import first_wins
    m = load_mcq(spark, sf)
    nulled = m.select(F.when(F.col("index") % 4 != 0, F.col("index")).alias("index"), F.col("index").alias("line"),
                      F.when(F.col("index") % 3 != 0, F.col("dataset")).alias("dataset"),
                      py_strip(blank_to_empty("text")).alias("t"), py_strip(blank_to_empty("question")).alias("q"), "options")
    key = F.md5(F.to_json(F.struct("dataset", "t", "q", "options")))
    flagged = first_wins(_twice(nulled.select("index", "line", "dataset", key.alias("key"))), "key", ["index", "line"])
    return flagged.groupBy("line", "dataset").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_first").alias("firsts"))

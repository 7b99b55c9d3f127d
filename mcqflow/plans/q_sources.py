"""Queries: native-format round trips and the validating loader.

Each query writes the adapter rows in one native format to the shared
checkpoint folder (a derived table, partitioned like its input), reads it
back with the format's converter and returns canonical rows; the oracle
computes the same rows straight from ``documents``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from mcqflow.operators.clean import classify, reject_counts
from mcqflow.plans.oracle_sql import CLASSIFIED, MCQ, LOWER_STRIP, STRIP, with_ctes
from mcqflow.plans.registry import register
from mcqflow.session import materialize, scratch_path
from mcqflow.sources.fixtures import group_config, load_mcq
from mcqflow.sources.jsonl import load_validated, loader_report
from mcqflow.sources.native import (assign_groups, group_audit, quarantine, read_arc, read_balacopa,
                                    read_boolean, read_by_suffix, read_catalogue, read_logiqa, read_race, read_reclor, read_tagged,
                                    read_winogrande)
from mcqflow.sources.sinks import save_dataset

OUT = ["doc_id", "text", "question", "options", "label"]
ROWS_PER_ARRAY = 2_000  # a JSON array is read as one record
MCQ_OUT = 'SELECT "index" AS doc_id, text, question, options, label FROM mcq'


def _mcq(spark, sf):
    return load_mcq(spark, sf).withColumnRenamed("index", "doc_id")


def _py_list_string(col):
    """"['a', 'b']" -- a Python list literal as text."""
    return F.concat(F.lit("["), F.array_join(F.transform(col, lambda x: F.concat(F.lit("'"), x, F.lit("'"))),
                                             ", "), F.lit("]"))


@register("source_race", with_ctes(MCQ) + MCQ_OUT)
def q_source_race(spark, sf):
    """S1 + S14: RACE Parquet with options as Python-list text, letter answers."""
    p = scratch_path(spark, "race")
    (_mcq(spark, sf).select("doc_id", F.col("text").alias("article"), "question",
                            _py_list_string(F.col("options")).alias("options"),
                            F.char(F.lit(65) + F.col("label")).alias("answer"))
     .write.parquet(p))
    return read_race(spark, p, keep=["doc_id"]).select(*OUT)


@register("source_arc", with_ctes(MCQ) + 'SELECT "index" AS doc_id, \'\' AS text, question, options, label FROM mcq')
def q_source_arc(spark, sf):
    """ARC Parquet, choices struct, answerKey letter; text is ''."""
    p = scratch_path(spark, "arc")
    m = _mcq(spark, sf)
    (m.select("doc_id", "question",
              F.struct(F.col("options").alias("text"),
                       F.transform("options", lambda x, i: F.char(i + 65)).alias("label")).alias("choices"),
              F.char(F.lit(65) + F.col("label")).alias("answerKey"))
     .write.parquet(p))
    return read_arc(spark, p, keep=["doc_id"]).select(*OUT)


@register("source_logiqa", with_ctes(MCQ) + MCQ_OUT)
def q_source_logiqa(spark, sf):
    """S3: LogiQA JSON lines."""
    p = scratch_path(spark, "logiqa")
    _mcq(spark, sf).select("doc_id", "text", "question", "options", F.col("label").alias("answer")).write.json(p)
    return read_logiqa(spark, p, keep=["doc_id"], extra=", doc_id bigint").select(*OUT)


@register("source_reclor", with_ctes(MCQ) + MCQ_OUT)
def q_source_reclor(spark, sf):
    """ReClor JSON arrays (one array per file)."""
    p = scratch_path(spark, "reclor")
    m = _mcq(spark, sf)
    # one JSON array per file, at most ~ROWS_PER_ARRAY rows each: the number
    # of files grows with the row count (a scalar subquery), so no group is
    # larger than a file
    n_files = F.greatest(F.lit(1), F.ceil(m.agg(F.count(F.lit(1)).alias("c")).select("c").scalar()
                                          / ROWS_PER_ARRAY)).cast("bigint")
    part = F.pmod(F.xxhash64("doc_id"), n_files)
    arr = (m.select(part.alias("part"), F.to_json(F.struct(
                "doc_id", F.col("text").alias("context"), "question", F.col("options").alias("answers"),
                "label")).alias("j"))
           .groupBy("part")
           .agg(F.concat(F.lit("["), F.array_join(F.collect_list("j"), ",\n"), F.lit("]")).alias("value")))
    arr.write.partitionBy("part").text(p)  # one array per file
    return read_reclor(spark, p, keep=["doc_id"], extra=", doc_id bigint").select(*OUT)


def _two_options(m):
    """The chosen option (the first where the label points outside) and the
    next one; in even rows the chosen one comes first."""
    n = F.size("options")
    c = F.when(F.col("label").between(0, n - 1), F.col("label")).otherwise(F.lit(0)).cast("int")
    right, other = F.get("options", c), F.get("options", (c + 1) % n)
    even = F.col("doc_id") % 2 == 0
    return (m.withColumn("o1", F.when(even, right).otherwise(other)).withColumn("o2", F.when(even, other).otherwise(right))
            .withColumn("label", (F.col("doc_id") % 2).cast("bigint")))


@register("source_winogrande", with_ctes(MCQ) + """
SELECT "index" AS doc_id, text,
  'Which of the following options is the most appropriate one to fill in the blank?' AS question,
  CASE WHEN "index" % 2 = 0 THEN [options[c], options[c % len(options) + 1]] ELSE [options[c % len(options) + 1], options[c]] END AS options,
  CAST("index" % 2 AS BIGINT) AS label
FROM (SELECT *, CASE WHEN label >= 0 AND label < len(options) THEN CAST(label AS INTEGER) + 1 ELSE 1 END AS c FROM mcq)""")
def q_source_winogrande(spark, sf):
    """WinoGrande JSON lines (the chosen option and another, answer '1'/'2')."""
    p = scratch_path(spark, "winogrande")
    (_two_options(_mcq(spark, sf))
     .select("doc_id", F.col("text").alias("sentence"), F.col("o1").alias("option1"), F.col("o2").alias("option2"),
                            (F.col("label") + 1).cast("string").alias("answer"))
     .write.option("ignoreNullFields", "false").json(p))
    return read_winogrande(spark, p, keep=["doc_id"], extra=", doc_id bigint").select(*OUT)


@register("source_balacopa", with_ctes(MCQ) + """
SELECT "index" AS doc_id, text,
  'Which may be the ' || CASE WHEN "index" % 2 = 0 THEN 'cause' ELSE 'effect' END || '?' AS question,
  CASE WHEN "index" % 2 = 0 THEN [options[c], options[c % len(options) + 1]] ELSE [options[c % len(options) + 1], options[c]] END AS options,
  CAST("index" % 2 AS BIGINT) AS label
FROM (SELECT *, CASE WHEN label >= 0 AND label < len(options) THEN CAST(label AS INTEGER) + 1 ELSE 1 END AS c FROM mcq)""")
def q_source_balacopa(spark, sf):
    """BalaCOPA XML items (premise, two alternatives, attributes)."""
    p = scratch_path(spark, "balacopa")
    m = _two_options(_mcq(spark, sf))
    (m.select(F.when(F.col("doc_id") % 2 == 0, "cause").otherwise("effect").alias("_asks-for"),
              (F.col("label") + 1).cast("string").alias("_most-plausible-alternative"),
              F.col("doc_id").cast("string").alias("_id"),
              F.col("text").alias("p"), F.col("o1").alias("a1"), F.col("o2").alias("a2"))
     .write.format("xml").option("rowTag", "item").option("rootTag", "items").save(p))
    r = read_balacopa(spark, p, keep=[F.col("_id").cast("bigint").alias("doc_id")])
    return r.select(*OUT)


@register("source_boolean", with_ctes(MCQ) + """
SELECT "index" AS doc_id, text, upper(substr(question, 1, 1)) || substr(question, 2) || '?' AS question,
  ['True', 'False'] AS options, CAST(CASE WHEN label = 0 THEN 0 ELSE 1 END AS BIGINT) AS label FROM mcq""")
def q_source_boolean(spark, sf):
    """Boolean questions (question capitalised + '?', True/False)."""
    p = scratch_path(spark, "boolean")
    (_mcq(spark, sf).select("doc_id", "question", F.col("text").alias("passage"),
                            (F.col("label") == 0).alias("answer")).write.json(p))
    return read_boolean(spark, p, keep=["doc_id"], extra=", doc_id bigint").select(*OUT)


def loader_lines(m, *extra):
    """(extra columns, value): rows as JSON lines; doc_id % 97 = 0 lines are not
    JSON, doc_id % 89 = 0 lines carry the label as a string."""
    cols = ["doc_id", "text", "question", "options", "source", *[c for c in extra if c != "dataset"]]
    line = lambda label: F.to_json(F.struct(*cols, label.alias("label")))
    value = (F.when(F.col("doc_id") % 97 == 0, F.concat(F.lit("not json "), F.col("doc_id").cast("string")))
             .when(F.col("doc_id") % 89 == 0, line(F.col("label").cast("string"))).otherwise(line(F.col("label"))))
    return m.select(*[c for c in extra if c == "dataset"], "doc_id", value.alias("value")).sortWithinPartitions("doc_id").drop("doc_id")


def _loader_lines(spark, sf, line_numbers=False):
    """The adapter rows as lines; each file's in doc_id order, so line numbers can be checked."""
    p = scratch_path(spark, "loader")
    loader_lines(_mcq(spark, sf)).write.text(p)
    return load_validated(spark, p, "documents", line_numbers)


LOADER_REASON = f"""CASE WHEN "index" % 97 = 0 THEN 'json_parse_error'
    WHEN {STRIP('text')} = '' AND {STRIP('question')} = '' THEN 'text_question_empty'
    WHEN len(list_distinct(list_transform(options, lambda o: {LOWER_STRIP('o')}))) < len(options) THEN 'duplicate_options'
    WHEN "index" % 89 = 0 THEN 'label_not_int'
    WHEN label < 0 OR label >= len(options) THEN 'label_out_of_range' ELSE 'VALID' END"""


@register("loader_reject_counts", with_ctes(MCQ) + f"""
SELECT {LOADER_REASON} AS reason, count(*) AS n FROM mcq GROUP BY 1""")
def q_loader_reject_counts(spark, sf):
    """S8 + P4: per-line verdicts of the validating JSON-lines loader."""
    v = _loader_lines(spark, sf)
    return v.groupBy(F.coalesce("reason", F.lit("VALID")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@register("loader_report", with_ctes(MCQ) + f"""
SELECT 'documents' AS dataset, count(*) AS total_samples,
  count(*) FILTER (WHERE {LOADER_REASON} = 'VALID') AS valid_samples,
  count(*) FILTER (WHERE {LOADER_REASON} <> 'VALID') AS invalid_samples FROM mcq""")
def q_loader_report(spark, sf):
    return loader_report(_loader_lines(spark, sf))


@register("loader_line_numbers", with_ctes(MCQ) + f"""
SELECT "index" AS doc_id, {LOADER_REASON} AS reason, true AS line_ok FROM mcq WHERE {LOADER_REASON} <> 'VALID'""")
def q_loader_line_numbers(spark, sf):
    """Rejected lines with their 1-based line number; ``line_ok`` checks it
    against the line's rank by doc_id within its file (files are written in
    doc_id order), computed by an independent bucketed rank."""
    from mcqflow.operators.index import int_bucket, ranked
    v = _loader_lines(spark, sf, line_numbers=True)
    doc = F.coalesce(F.get_json_object("raw", "$.doc_id"),
                     F.regexp_extract("raw", r"^not json (\d+)$", 1)).cast("bigint")
    v = v.withColumn("doc_id", doc)
    r = ranked(v, ["doc_id"], int_bucket(v, "doc_id"), ["file"], "_expect", max_keys=None, n_buckets=None)
    return (r.where(F.col("reason").isNotNull())
            .select("doc_id", "reason", (F.col("line_number") == F.col("_expect")).alias("line_ok")))


@register("catalogue_read", with_ctes(MCQ) + """
SELECT 'race' AS dataset, count(*) AS n, count(*) AS n_index, 0 AS first_index, count(*) - 1 AS last_index FROM mcq
UNION ALL SELECT 'logiqa', count(*), count(*), 0, count(*) - 1 FROM mcq""")
def q_catalogue_read(spark, sf):
    """S13 + W1: two native sources by catalogue; the positions are gapless."""
    return (_catalogue(spark, sf).groupBy("dataset")
            .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("index").alias("n_index"),
                 F.min("index").alias("first_index"), F.max("index").alias("last_index")))


@register("pipeline_convert", with_ctes(MCQ, CLASSIFIED) + """
SELECT d.dataset, coalesce(reason, 'VALID') AS reason, count(*) AS n
FROM classified, (VALUES ('race'), ('logiqa')) AS d(dataset) GROUP BY 1, 2""")
def q_pipeline_convert(spark, sf):
    """E1 on native files: the adapter rows in two formats, read back by
    catalogue, cleaned and counted."""
    return reject_counts(classify(_catalogue(spark, sf), keep=["dataset"]), ["dataset"])


def _catalogue(spark, sf):
    """Adapter rows as RACE Parquet and LogiQA JSON lines, in doc_id order, read by catalogue.
    A negative label has no letter; RACE writes '?' for it, which reads as out of range too."""
    base, m = scratch_path(spark, "catalogue"), _mcq(spark, sf)
    m = m.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    (m.select(F.col("text").alias("article"), "question", "options",
              F.when(F.col("label") >= 0, F.char(F.lit(65) + F.col("label"))).otherwise(F.lit("?")).alias("answer"))
     .write.parquet(f"{base}/race"))
    m.select("text", "question", "options", F.col("label").alias("answer")).write.option("ignoreNullFields", "false").json(f"{base}/logiqa")
    return read_catalogue(spark, [("race", "race", f"{base}/race"), ("logiqa", "logiqa", f"{base}/logiqa")])


def _mixed_catalogue(spark, sf):
    """Adapter rows as RACE Parquet, as LogiQA lines of which every 97th is not JSON and every
    89th has numbers as options, and as canonical lines."""
    base, m = scratch_path(spark, "catalogue"), _mcq(spark, sf)
    (m.select(F.col("text").alias("article"), "question", "options",
              F.when(F.col("label") >= 0, F.char(F.lit(65) + F.col("label"))).otherwise(F.lit("?")).alias("answer"))
     .write.parquet(f"{base}/race"))
    d = F.col("doc_id")
    record = lambda options: F.to_json(F.struct("text", "question", options.alias("options"), F.col("label").alias("answer")))
    (m.select(F.when(d % 97 == 0, F.concat(F.lit("{not json "), d.cast("string")))
              .when(d % 89 == 0, record(F.array(F.lit(1), F.lit(2)))).otherwise(record(F.col("options"))).alias("value"))
     .write.text(f"{base}/logiqa"))
    m.select("text", "question", "options", "label").write.option("ignoreNullFields", "false").json(f"{base}/own")
    return read_catalogue(spark, [(n, f, f"{base}/{n}") for n, f in (("race", "race"), ("logiqa", "logiqa"), ("own", "mcq"), ("absent", "boolean"))])


@register("source_quarantine", with_ctes(MCQ) + """
SELECT d.dataset, count(*) AS n, count(*) AS n_positions, count(*) FILTER (WHERE d.dataset = 'logiqa' AND "index" % 97 = 0) AS bad,
  count(*) FILTER (WHERE d.dataset = 'logiqa' AND "index" % 89 = 0 AND "index" % 97 <> 0) AS not_strings
FROM mcq, (VALUES ('race'), ('logiqa'), ('own')) AS d(dataset) GROUP BY 1""")
def q_source_quarantine(spark, sf):
    """S9 + S13: bad lines are counted as rows of their source, the other sources
    and positions stay whole, and options that are no strings are rejected."""
    rows = materialize(_mixed_catalogue(spark, sf).select("dataset", "index", "bad", "text", "question", "options", "label"), "catalogue-rows")
    records, bad = quarantine(rows)
    c = classify(records, keep=["dataset", "index"])
    seen = c.select("dataset", "index", (F.col("reason") == "other_error").alias("no"), F.lit(0).alias("b")).unionByName(
        bad.select("dataset", "index", F.lit(False).alias("no"), F.lit(1).alias("b")))
    return seen.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("index").alias("n_positions"),
                                       F.sum("b").alias("bad"), F.count_if("no").alias("not_strings"))


@register("catalogue_groups", with_ctes(MCQ) + """
SELECT d.dataset, d.grp, count(*) AS n FROM mcq, (VALUES ('race', 'g0'), ('logiqa', 'unassigned'), ('own', 'unassigned')) AS d(dataset, grp) GROUP BY 1, 2""")
def q_catalogue_groups(spark, sf):
    """S13 + J1: dataset -> group -> ratio by configuration tables; a dataset
    without a group and a group without a ratio are counted, not lost."""
    groups = spark.createDataFrame([("race", "g0"), ("logiqa", "a group without a ratio"), ("own", None)], "dataset string, grp string")
    return group_audit(assign_groups(_mixed_catalogue(spark, sf), groups, group_config(spark)))


@register("source_tagged", with_ctes(MCQ) + """
SELECT source, lang AS own, count(*) AS n, min("index") AS first_id FROM (SELECT *, 'part_' || lang AS source FROM (SELECT "index", lang FROM mcq))
GROUP BY 1, 2""")
def q_source_tagged(spark, sf):
    """Files of a folder united, each row tagged with its file's stem (here the
    language and a number); an earlier merge output is left out."""
    base = scratch_path(spark, "tagged")
    m = load_mcq(spark, sf).select("lang", "text", F.col("lang").alias("question"), "options", F.col("index").alias("label"))
    m.write.partitionBy("lang").json(f"{base}/out")
    fs, path = _hadoop(spark, base)
    fs.mkdirs(path(f"{base}/in"))
    for k, f in enumerate(fs.globStatus(path(f"{base}/out/lang=*/part-*"))):  # names only
        lang = f.getPath().getParent().getName().split("=")[1]
        fs.rename(f.getPath(), path(f"{base}/in/part_{lang}-{k}.jsonl"))
    spark.read.parquet(f"{sf.rstrip('/')}/benchmark.parquet").select("text").write.json(f"{base}/merged")
    for f in fs.globStatus(path(f"{base}/merged/part-*"))[:1]:
        fs.rename(f.getPath(), path(f"{base}/in/merged_dataset.jsonl"))
    t = read_tagged(spark, f"{base}/in").withColumn("source", F.regexp_replace("source", r"-\d+$", ""))
    return t.groupBy("source", F.col("question").alias("own")).agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("first_id"))


def _hadoop(spark, base):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    return path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


@register("dataset_outputs", with_ctes(MCQ) + """
SELECT format, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(sum(label) AS BIGINT) AS labels, count(DISTINCT "index") AS ids
FROM mcq, (VALUES ('json'), ('parquet')) AS f(format) GROUP BY 1""")
def q_dataset_outputs(spark, sf):
    """K1 + S10: a dataset in both formats from one evaluation, each read back by its suffix."""
    p = scratch_path(spark, "dataset")
    save_dataset(load_mcq(spark, sf).select("index", "text", "question", "options", "label", "source"), p)
    out = None
    for fmt in ("json", "parquet"):
        x = read_by_suffix(spark, f"{p}/{fmt}" if fmt == "json" else f"{p}/data.parquet", extra=", index bigint")
        x = x.agg(F.lit(fmt).alias("format"), F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"), F.sum("label").alias("labels"),
                  F.count_distinct("index").alias("ids"))
        out = x if out is None else out.unionByName(x)
    return out

"""Queries: whole pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from mcqflow.functions.text import total_length
from mcqflow.operators.dedup import fingerprint
from mcqflow.operators.index import join_small
from mcqflow.plans.oracle_sql import CLASSIFIED, MCQ, classified_cte, with_ctes
from mcqflow.plans.pipelines import MixConfig, clean, mix
from mcqflow.plans.q_mix import DRAWN, LEN, POOL, mix_total, pool, pool_rows
from mcqflow.plans.registry import register
from mcqflow.plans.q_sources import LOADER_REASON, loader_lines
from mcqflow.session import scratch_path
from mcqflow.sources.fixtures import GROUP_RATIOS, ROW_ID, group_config, load_mcq, with_twins
from mcqflow.sources.jsonl import load_validated


@register("pipeline_clean", with_ctes(MCQ, CLASSIFIED) + """
SELECT dataset, coalesce(reason, 'VALID') AS reason, count(*) AS n FROM classified GROUP BY 1, 2""")
def q_pipeline_clean(spark, sf):
    """Documents -> mcq -> classify; counts per dataset and reason."""
    return clean(load_mcq(spark, sf), keep=["index"])["reject_counts"]


@register("pipeline_mix", with_ctes(MCQ, POOL, DRAWN) + """,
dl AS (SELECT *, CAST(""" + LEN + """ AS BIGINT) AS length FROM drawn),
f AS (SELECT q[2] + 1.5 * (q[2] - q[1]) AS upper FROM (SELECT quantile_cont(length, [0.25, 0.75]) AS q FROM dl)),
kept AS (SELECT * FROM dl WHERE length <= (SELECT upper FROM f)),
ranked AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || dataset || ':' || CAST("index" AS VARCHAR))) AS rn,
    count(*) OVER () AS n FROM kept),
fl AS (SELECT *, rn > n - floor(n * 0.1::DOUBLE) AS is_eval FROM ranked)
SELECT "index", dataset, grp, rn, is_eval, NOT is_eval AND rn <= floor(n * 0.9::DOUBLE) AS is_full,
  NOT is_eval AND rn <= floor(n * 0.45::DOUBLE) AS is_peft FROM fl""")
def q_pipeline_mix(spark, sf):
    """Adapter + twins -> clean -> fingerprint de-dup -> ratio draw ->
    fence -> seeded shuffle -> nested split."""
    cfg = MixConfig(total=mix_total(spark, sf))
    out = mix(pool(spark, sf), group_config(spark), cfg)
    return out["final"].select("index", "dataset", "grp", "rn", "is_eval", "is_full", "is_peft")


@register("mix_outputs", with_ctes(MCQ, POOL, DRAWN) + """,
dl AS (SELECT *, CAST(""" + LEN + """ AS BIGINT) AS length FROM drawn),
f AS (SELECT q[2] + 1.5 * (q[2] - q[1]) AS upper FROM (SELECT quantile_cont(length, [0.25, 0.75]) AS q FROM dl)),
kept AS (SELECT * FROM dl WHERE length <= (SELECT upper FROM f)),
ranked AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || dataset || ':' || CAST("index" AS VARCHAR))) AS rn,
    count(*) OVER () AS n FROM kept),
fl AS (SELECT *, rn > n - floor(n * 0.1::DOUBLE) AS is_eval FROM ranked),
sp AS (SELECT *, NOT is_eval AND rn <= floor(n * 0.9::DOUBLE) AS is_full,
    NOT is_eval AND rn <= floor(n * 0.45::DOUBLE) AS is_peft FROM fl)
SELECT 'full_train' AS output, rn - 1 AS "index", text, source FROM sp WHERE is_full
UNION ALL SELECT 'peft_train', rn - 1, text, source FROM sp WHERE is_peft
UNION ALL SELECT 'eval', rn - (SELECT min(rn) FROM sp WHERE is_eval), text, source FROM sp WHERE is_eval""")
def q_mix_outputs(spark, sf):
    """E2 + K2: the three outputs written as JSON lines with ``index``
    renumbered per output, read back."""
    from mcqflow.plans.pipelines import split_outputs
    from mcqflow.sources.sinks import save_mixed
    out = mix(pool(spark, sf), group_config(spark), MixConfig(total=mix_total(spark, sf)), pool_rows(spark, sf), ("dataset", *ROW_ID))
    base = scratch_path(spark, "mixed")
    frames = []
    for name, df in split_outputs(out["final"]).items():
        save_mixed(df, f"{base}/{name}")
        frames.append(spark.read.schema("index bigint, text string, question string, options array<string>, "
                                        "label bigint, source string").json(f"{base}/{name}")
                      .select(F.lit(name).alias("output"), "index", "text", "source"))
    r = frames[0]
    for f in frames[1:]:
        r = r.unionByName(f)
    return r


_LOADED = """ctw AS (SELECT *, CASE WHEN """ + LOADER_REASON + """ = 'VALID' THEN NULL ELSE 'rejected' END AS reason FROM twins)"""
LOADED_POOL = POOL.replace(classified_cte("twins", "ctw"), _LOADED)


@register("pipeline_mix_loader", with_ctes(MCQ, LOADED_POOL, DRAWN) + """,
dl AS (SELECT *, CAST(""" + LEN + """ AS BIGINT) AS length FROM drawn),
f AS (SELECT q[2] + 1.5 * (q[2] - q[1]) AS upper FROM (SELECT quantile_cont(length, [0.25, 0.75]) AS q FROM dl)),
kept AS (SELECT * FROM dl WHERE length <= (SELECT upper FROM f)),
ranked AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || dataset || ':' || CAST("index" AS VARCHAR))) AS rn,
    count(*) OVER () AS n FROM kept),
fl AS (SELECT *, rn > n - floor(n * 0.1::DOUBLE) AS is_eval FROM ranked)
SELECT "index", dataset, grp, rn, is_eval, NOT is_eval AND rn <= floor(n * 0.9::DOUBLE) AS is_full,
  NOT is_eval AND rn <= floor(n * 0.45::DOUBLE) AS is_peft FROM fl""")
def q_pipeline_mix_loader(spark, sf):
    """E2 from files: two JSON-lines sources with broken lines and wrong types go
    through the validating loader (S8, P4), then de-dup, draw, fence, shuffle, split."""
    base = scratch_path(spark, "mix-sources")
    m = with_twins(load_mcq(spark, sf)).withColumnRenamed("index", "doc_id")
    loader_lines(m, "grp", "dataset").write.partitionBy("dataset").text(base)
    rows = None
    for ordinal, name in enumerate(("documents", "src_twin")):
        x = load_validated(spark, f"{base}/dataset={name}", name, line_numbers=False).where(F.col("reason").isNull())
        x = x.withColumns({"index": F.get_json_object("raw", "$.doc_id").cast("bigint"), "grp": F.get_json_object("raw", "$.grp"),
                           "dataset_ord": F.lit(ordinal), "fp": fingerprint(), "length": total_length()})
        x = x.select("index", "dataset", "grp", "source", "label", "dataset_ord", "fp", "length")
        rows = x if rows is None else rows.unionByName(x)
    rows = join_small(rows, group_config(spark).select("grp", "grp_ord"), ["grp"], "left", bound=len(GROUP_RATIOS))
    out = mix(rows.withColumn("grp_ord", F.coalesce("grp_ord", F.lit(len(GROUP_RATIOS)))), group_config(spark), MixConfig(total=mix_total(spark, sf)))
    return out["final"].select("index", "dataset", "grp", "rn", "is_eval", "is_full", "is_peft")

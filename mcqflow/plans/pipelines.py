"""End-to-end plans: clean (E1), mix (E2), reasoning check.

Each stage is one lazy DataFrame plan; the only materialisation points are
where a result feeds several consumers (the cleaned pool, the draw, the
kept set), written once as Parquet under the shared checkpoint folder.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mcqflow.functions.text import total_length
from mcqflow.operators.clean import classify, reject_counts
from mcqflow.operators.dedup import duplicate_stats, fingerprint, fingerprint_dedupe
from mcqflow.operators.index import join_small
from mcqflow.operators.reasoning import validation_stats
from mcqflow.operators.sample import outlier_flag, ratio_mix, split_flags
from mcqflow.session import materialize


@dataclass
class MixConfig:
    total: int | Column = 30000
    seed: int = 42
    ratios: tuple = (0.9, 0.45, 0.1)  # full, peft, eval
    keys: tuple = ("dataset", "index")
    group_order: tuple = ("grp_ord", "dataset_ord", "index")
    extra: dict = field(default_factory=dict)


def clean(df: DataFrame, dataset=("dataset",), keep=None) -> dict[str, DataFrame]:
    """Classify every row; valid rows, rejects and reject counts.  The operator
    writes the verdicts once, with all columns or those of ``keep``."""
    c = classify(df, list(dataset), keep=None if keep is None else [*dataset, *keep])
    return {"classified": c, "valid": c.where(F.col("reason").isNull()),
            "rejects": c.where(F.col("reason").isNotNull()),
            "reject_counts": reject_counts(c, list(dataset))}


def mix(pool: DataFrame, groups: DataFrame, cfg: MixConfig, rows: DataFrame | None = None,
        row_keys: tuple = ()) -> dict[str, DataFrame]:
    """Fingerprint de-dup -> ratio draw -> length fence -> shuffle -> split.

    ``pool``: valid rows with grp, grp_ord, dataset_ord, dataset, index, and
    either ``fp`` and ``length`` or the text columns they come from.  Only narrow
    key rows travel through de-dup, draw, fence and split; those are the tables
    written in between.  ``rows`` with ``row_keys``, columns of both that tell
    rows apart, gives the texts: they are taken from there by the final rows,
    which are at most ``cfg.total`` (a proven bound for their broadcast).
    """
    narrow = pool
    if "fp" not in pool.columns:
        narrow = pool.withColumn("fp", fingerprint()).withColumn("length", total_length()).drop("text", "question", "options")
    flagged = materialize(fingerprint_dedupe(narrow, list(cfg.group_order)), "fingerprinted")
    drawn = materialize(ratio_mix(flagged.where("is_first"), groups, cfg.total, cfg.keys, cfg.seed), "drawn")
    fenced = outlier_flag(drawn)
    kept = materialize(fenced.where(~F.col("is_outlier")).drop("is_outlier"), "kept")
    final = split_flags(kept, cfg.keys, cfg.seed, cfg.ratios).drop("grp_ord", "dataset_ord")
    if rows is not None:
        final = materialize(final, "mixed")  # several outputs read it
        bound = cfg.total if isinstance(cfg.total, int) else None
        extra = [c for c in rows.columns if c in row_keys or c not in final.columns]
        final = join_small(rows.select(*extra), final, list(row_keys), bound=bound)
    return {"flagged": flagged, "duplicate_stats": duplicate_stats(flagged), "drawn": drawn,
            "outliers": fenced.where("is_outlier"), "final": final}


def split_outputs(final: DataFrame) -> dict[str, DataFrame]:
    """K2 inputs: full_train / peft_train / eval with ``pos`` = position in
    that output (shuffled order).  full and peft are prefixes of the shuffle;
    eval is its tail."""
    n_eval_start = final.agg(F.min(F.when(F.col("is_eval"), F.col("rn"))).alias("s")).select("s").scalar()
    return {"full_train": final.where("is_full").withColumn("pos", F.col("rn") - 1),
            "peft_train": final.where("is_peft").withColumn("pos", F.col("rn") - 1),
            "eval": final.where("is_eval").withColumn("pos", F.col("rn") - n_eval_start)}


def reasoning_check(df: DataFrame, **limits) -> DataFrame:
    """E3 (offline part): validation statistics over recorded reasoning."""
    return validation_stats(df, **limits)

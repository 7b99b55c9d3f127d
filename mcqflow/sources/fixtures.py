"""Adapters that turn the driver's tables into the engine's input tables.

The driver ships generic tables (``documents``, ``conversations`` ...), not
question sets.  ``mcq_from_documents`` maps every document to one question
row by fixed rules on ``doc_id``, so that every reject reason, option merge,
group and label layout occurs at a known rate.  No row is dropped: the
adapter is a projection, and its work grows with ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Adapter questions, option lists and group ratios.
Q_LANG = "Which language is this passage written in?"
Q_EN = "Is this passage written in English?"
OPTS_BAD = ["German", "?!", "Spanish", "French"]
OPTS_CASE_DUP = ["German", "german", "English", "Spanish", "French"]
OPTS_ONE = ["English"]
OPTS_TWO_SAME = ["English", "english"]
OPTS_BOOL = ["True", "False"]
OPTS_FIVE = ["German", "English", "Spanish", "French", "Italian"]
OPTS_FOUR = ["German", "English", "Spanish", "French"]
GROUP_RATIOS = [("g0", 0.10), ("g1", 0.18), ("g2", 0.27), ("g3", 0.15),
                ("g4", 0.15), ("g5", 0.05), ("g6", 0.05)]


def spread(df: DataFrame) -> DataFrame:
    """Round-robin repartition only when the input arrives in fewer splits
    than the session has cores (e.g. one Parquet row group); at scale the
    input has far more splits than cores and this is a no-op.  Column pruning
    and filters still reach the scan below the repartition."""
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        n = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 -- no RDD access (e.g. Spark Connect): leave as is
        return df
    return df.repartition(cores) if n < cores else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def _arr(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _lang_pick(lang: Column, mapping: dict, default: int) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(lang == k, F.lit(v)) if out is None else out.when(lang == k, F.lit(v))
    return out.otherwise(F.lit(default))


def source_number(source="source") -> Column:
    return F.regexp_extract(F.col(source), r"(\d+)", 1).cast("bigint")


def mcq_from_documents(docs: DataFrame) -> DataFrame:
    """documents(doc_id, text, lang, source) -> mcq + ``grp`` + ``dataset``."""
    d = F.col("doc_id")
    lang = F.col("lang")
    text = F.when((d % 79 == 0) | (d % 83 == 0), F.lit("")).otherwise(F.col("text"))
    question = (F.when(d % 83 == 0, F.lit(""))
                .when(d % 41 == 0, F.col("text"))
                .when(d % 5 == 0, F.lit(Q_EN))
                .otherwise(F.lit(Q_LANG)))
    options = (F.when(d % 53 == 0, _arr(OPTS_BAD))
               .when(d % 59 == 0, _arr(OPTS_CASE_DUP))
               .when(d % 61 == 0, _arr(OPTS_ONE))
               .when(d % 73 == 0, _arr(OPTS_TWO_SAME))
               .when(d % 5 == 0, _arr(OPTS_BOOL))
               .when(d % 5 == 1, _arr(OPTS_FIVE))
               .otherwise(_arr(OPTS_FOUR)))
    label = (F.when(d % 67 == 0, F.lit(9))
             .when(d % 71 == 0, F.lit(-1))
             .when((d % 61 == 0) | (d % 73 == 0), F.lit(0))
             .when(d % 59 == 0, _lang_pick(lang, {"de": 0, "en": 2, "es": 3}, 4))
             .when((d % 5 == 0) & (d % 53 != 0), F.when(lang == "en", 0).otherwise(1))
             .otherwise(_lang_pick(lang, {"de": 0, "en": 1, "es": 2}, 3)))
    return docs.select(
        d.alias("index"),
        text.alias("text"),
        question.alias("question"),
        options.alias("options"),
        label.cast("bigint").alias("label"),
        F.col("source"),
        F.concat(F.lit("g"), (source_number() % 7).cast("string")).alias("grp"),
        F.lit("documents").alias("dataset"),
        F.col("lang"),
        *[c for c in ROW_ID if c in docs.columns],
    )


# Which row of which file a row is: the same in every scan.
ROW_ID = ["_file", "_row"]


def load_mcq(spark: SparkSession, sf_dir: str, row_id: bool = False) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")] if row_id else []
    return mcq_from_documents(spread(docs.select("doc_id", "text", "lang", "source", *place)))


def group_config(spark: SparkSession) -> DataFrame:
    """Group -> ratio and group order (a 7-row table)."""
    return spark.createDataFrame(
        [(g, r, i) for i, (g, r) in enumerate(GROUP_RATIOS)],
        "grp string, ratio double, grp_ord int")


def with_twins(mcq: DataFrame) -> DataFrame:
    """Adds a twin of every row in dataset 'src_twin' (same group): ASCII
    letters of ``text`` upper-cased with a space on each side, so that its
    fingerprint (lower+strip) equals the original's.  French rows' twins also
    get their options reversed (label moved along), so they are not copies."""
    fr = F.col("lang") == "fr"
    twins = (mcq.withColumn("text", F.concat(F.lit(" "), F.translate(
                 "text", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.lit(" ")))
             .withColumn("label", F.when(fr, F.size("options") - 1 - F.col("label"))
                         .otherwise(F.col("label")).cast("bigint"))
             .withColumn("options", F.when(fr, F.reverse("options")).otherwise(F.col("options")))
             .withColumn("source", F.lit("src_twin"))
             .withColumn("dataset", F.lit("src_twin")))
    return mcq.unionByName(twins)


# Synthetic reasoning texts by doc_id % 12.  {L} = letter of the
# label, {W} = a wrong letter ('A', or 'B' when the label is 'A').
REASONING_TEMPLATES = [
    "First, read the passage. Second, compare. Therefore, the answer is: ({L}) ok",
    "Step 1: read. Step 2: decide. ANSWER: {L}",
    "the correct answer is: \\boxed{{{L}}}",
    "Thus the correct option is: so boxed{{{L}}}",
    "answer: {l}",
    "1. {L}",
    "首先看文。所以答案是 {L}。",
    "no conclusion here",
    "the answer is: ({W})",
    "",
    "first think. {L}: because",
    "the answer is Although {L}",
]


def _template_col(i: int, L: Column, W: Column) -> Column:
    t = REASONING_TEMPLATES[i]
    parts = []
    buf = ""
    j = 0
    while j < len(t):
        if t.startswith("{{", j):
            buf += "{"; j += 2
        elif t.startswith("}}", j):
            buf += "}"; j += 2
        elif t.startswith("{L}", j):
            parts += [F.lit(buf), L]; buf = ""; j += 3
        elif t.startswith("{l}", j):
            parts += [F.lit(buf), F.lower(L)]; buf = ""; j += 3
        elif t.startswith("{W}", j):
            parts += [F.lit(buf), W]; buf = ""; j += 3
        else:
            buf += t[j]; j += 1
    parts.append(F.lit(buf))
    return F.concat(*parts)


def _answer_letter() -> Column:
    label = F.col("label")
    return F.when(label.between(0, 4), F.char(F.lit(65) + label)).otherwise(F.lit("A"))


def with_reasoning(mcq: DataFrame) -> DataFrame:
    """Every row gets a synthetic ``reasoning`` text (letter A where the label
    is not 0..4, which a check must call wrong)."""
    L = _answer_letter()
    W = F.when(L == "A", F.lit("B")).otherwise(F.lit("A"))
    k = F.col("index") % 12
    expr = None
    for i in range(12):
        c = _template_col(i, L, W)
        expr = F.when(k == i, c) if expr is None else expr.when(k == i, c)
    return mcq.withColumn("reasoning", expr)


def recorded_responses(mcq: DataFrame) -> DataFrame:
    """Responses as their own table (index, attempt, response): none for every 11th
    request, a superseded first attempt for every 7th, and for every 13th one more
    under an index that no request has."""
    d = F.col("index")
    row = lambda i, a, r: F.struct(i.alias("index"), F.lit(a).alias("attempt"), r.alias("response"))
    rows = F.array(F.when(d % 11 != 0, row(d, 1, F.col("reasoning"))),
                   F.when((d % 11 != 0) & (d % 7 == 0), row(d, 0, F.lit("ANSWER: A"))),
                   F.when(d % 13 == 0, row(-d - 1, 0, F.col("reasoning"))))
    return with_reasoning(mcq).select(F.inline(F.filter(rows, lambda x: x.isNotNull())))


def with_analysis(mcq: DataFrame) -> DataFrame:
    """Recorded analysis responses: answered iff index % 10 != 9."""
    L = F.char(F.lit(65) + F.col("label"))
    W = F.when(L == "A", F.lit("B")).otherwise(F.lit("A"))
    d = F.col("index")
    resp = F.when(d % 10 != 9, F.to_json(F.struct(
        F.array(F.lit("read"), F.lit("decide")).alias("reasoning_process"),
        F.when(d % 4 != 0, L).otherwise(W).alias("correct_answer"),
        F.lit("medium").alias("difficulty_level"),
        F.lit("single_choice").alias("question_type"),
        F.element_at(F.array(F.lit("Deductive"), F.lit("Sequential"), F.lit("Causal")),
                     (d % 3 + 1).cast("int")).alias("reasoning_type"),
        F.lit(True).alias("is_valid"))))
    return mcq.withColumn("response", resp)


def with_json_response(mcq: DataFrame) -> DataFrame:
    """Recorded structured-reasoning responses (JSON text; letter A where the
    label is not 0..4): none when index % 10 = 9; 'reasoning_pattern' missing when
    index % 9 = 0; answer = wrong letter (index % 4 = 0), ' l ' lower case
    with spaces (index % 4 = 1), else the right letter."""
    L = _answer_letter()
    W = F.when(L == "A", F.lit("B")).otherwise(F.lit("A"))
    d = F.col("index")
    answer = (F.when(d % 4 == 0, W).when(d % 4 == 1, F.concat(F.lit(" "), F.lower(L), F.lit(" ")))
              .otherwise(L))
    base = [F.lit("deductive").alias("reasoning_type"),
            F.array(F.lit("fact")).alias("given_facts"),
            F.array(F.lit("step one"), F.lit("step two")).alias("logical_steps"),
            F.lit("so it is").alias("conclusion"), answer.alias("answer"),
            F.lit("high").alias("confidence")]
    full = F.to_json(F.struct(*base, F.lit("elimination").alias("reasoning_pattern")))
    part = F.to_json(F.struct(*base))
    resp = F.when(d % 10 == 9, F.lit(None).cast("string")).when(d % 9 == 0, part).otherwise(full)
    return mcq.withColumn("response", resp)

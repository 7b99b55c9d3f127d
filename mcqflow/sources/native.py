"""Readers for the native question-set formats -> canonical ``mcq`` rows.

Each converter is a DataFrameReader call plus a ``select``: no Python row
code, no ``eval``.  Extra columns named in ``keep`` are carried through.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mcqflow.functions.text import letter_label
from mcqflow.operators.index import join_small
from mcqflow.session import materialize

# The question text that the WinoGrande converter adds.
WINOGRANDE_QUESTION = "Which of the following options is the most appropriate one to fill in the blank?"
BOOLEAN_OPTIONS = ["True", "False"]


def letter_to_label(c: Column) -> Column:
    """'B' -> 1 (upper-cased); NULL unless exactly one character."""
    return letter_label(c.cast("string"))


def coerce_options(cell: Column) -> Column:
    """An options cell that may be a list, a JSON list string or a
    Python list string ("['a', 'b']", escaped quotes allowed); fallback:
    strip the brackets and split on commas.  A cell that holds a dict
    ("{'text': [...], ...}") gives its ``text`` list."""
    s = cell.cast("string")
    inner = F.from_json(s, T.StructType([T.StructField("text", T.ArrayType(T.StringType()))]),
                        {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true",
                         "mode": "PERMISSIVE"})["text"]
    parsed = F.from_json(s, T.ArrayType(T.StringType()),
                         {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true",
                          "mode": "PERMISSIVE"})
    fallback = F.split(F.regexp_replace(s, r"^\[|\]$", ""), ",")
    return F.when(F.ltrim(s).startswith("{"), inner).otherwise(F.coalesce(parsed, fallback))


def _out(df: DataFrame, text: Column, question: Column, options: Column, label: Column,
         keep: Sequence[str]) -> DataFrame:
    return df.select(text.cast("string").alias("text"), question.cast("string").alias("question"),
                     options.alias("options"), label.cast("bigint").alias("label"), *keep)


def read_race(spark: SparkSession, path: str, keep: Sequence[str] = ()) -> DataFrame:
    """Article -> text; options list or list-string; answer letter -> label."""
    df = spark.read.parquet(path)
    opts = (F.col("options") if isinstance(df.schema["options"].dataType, T.ArrayType)
            else coerce_options(F.col("options")))
    return _out(df, F.col("article"), F.col("question"), opts, letter_to_label(F.col("answer")), keep)


def read_arc(spark: SparkSession, path: str, keep: Sequence[str] = ()) -> DataFrame:
    """Text ''; options = choices.text (struct) or a list string; answerKey letter."""
    df = spark.read.parquet(path)
    ch = df.schema["choices"].dataType
    opts = F.col("choices.text") if isinstance(ch, T.StructType) else coerce_options(F.col("choices"))
    return _out(df, F.lit(""), F.col("question"), opts, letter_to_label(F.col("answerKey")), keep)


def string_list(cell: Column) -> Column:
    """A VARIANT list as strings; an element that is no string becomes NULL, which
    cleaning rejects, and so does a cell that is no list."""
    parts = F.transform(F.try_variant_get(cell, "$", "array<variant>"),
                        lambda v: F.when(F.schema_of_variant(v) == "STRING", F.variant_get(v, "$", "string")))
    return F.when(F.schema_of_variant(cell).startswith("ARRAY"), parts)


def whole_number(cell: Column) -> Column:
    """A VARIANT integer; a string, boolean or fraction gives NULL."""
    kind = F.schema_of_variant(cell)
    return F.when(kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.try_variant_get(cell, "$", "bigint"))


def _json(spark: SparkSession, path, fields: str, extra: str, lines: bool = True) -> DataFrame:
    """JSON records with the given fields; ``bad`` holds the raw text of a record
    that does not parse, so that one bad line costs one row and not its source."""
    r = spark.read.schema(f"{fields}{extra}, bad string").option("columnNameOfCorruptRecord", "bad")
    df = r.option("multiLine", not lines).json(path)
    # a bad record has no fields; naming one lets the bad ones be read alone
    return df.withColumn("bad", F.when(F.col(fields.split()[0]).isNull(), F.col("bad")))


def _kept(df: DataFrame, keep: Sequence) -> list:
    return [*keep, *(["bad"] if "bad" in df.columns else [])]


LOGIQA_FIELDS = "text string, question string, options variant, answer variant"


def read_logiqa(spark: SparkSession, path: str, keep: Sequence[str] = (), extra: str = "") -> DataFrame:
    """S3: JSON lines (.txt); answer -> label."""
    df = _json(spark, path, LOGIQA_FIELDS, extra)
    return _out(df, F.col("text"), F.col("question"), string_list(F.col("options")), whole_number(F.col("answer")), _kept(df, keep))


RECLOR_FIELDS = "context string, question string, answers variant, label variant"


def read_reclor(spark: SparkSession, path: str, keep: Sequence[str] = (), extra: str = "") -> DataFrame:
    """A JSON array per file: context -> text, answers -> options."""
    df = _json(spark, path, RECLOR_FIELDS, extra, lines=False)
    return _out(df, F.col("context"), F.col("question"), string_list(F.col("answers")), whole_number(F.col("label")), _kept(df, keep))


WINOGRANDE_FIELDS = "sentence string, option1 variant, option2 variant, answer string"


def read_winogrande(spark: SparkSession, path: str, keep: Sequence[str] = (), extra: str = "") -> DataFrame:
    """Sentence -> text, [option1, option2], answer '1'/'2' -> 0/1."""
    df = _json(spark, path, WINOGRANDE_FIELDS, extra)
    text = lambda c: F.when(F.schema_of_variant(c) == "STRING", F.try_variant_get(F.col(c), "$", "string"))
    return _out(df, F.col("sentence"), F.lit(WINOGRANDE_QUESTION), F.array(text("option1"), text("option2")),
                F.expr("try_cast(answer AS bigint)") - 1, _kept(df, keep))


def read_balacopa(spark: SparkSession, path: str, keep: Sequence[str] = ()) -> DataFrame:
    """XML <item asks-for=.. most-plausible-alternative=..><p/><a1/><a2/></item>."""
    df = (spark.read.format("xml").option("rowTag", "item").option("ignoreSurroundingSpaces", "false")
          .load(path))
    q = F.concat(F.lit("Which may be the "), F.col("`_asks-for`").cast("string"), F.lit("?"))
    return _out(df, F.col("p"), q, F.array(F.col("a1").cast("string"), F.col("a2").cast("string")),
                F.col("`_most-plausible-alternative`").cast("bigint") - 1, keep)


BOOLEAN_FIELDS = "question string, passage string, answer variant"


def read_boolean(spark: SparkSession, path: str, keep: Sequence[str] = (), extra: str = "") -> DataFrame:
    """Passage -> text; question first letter upper-cased + '?'; True/False."""
    df = _json(spark, path, BOOLEAN_FIELDS, extra)
    q = F.concat(F.upper(F.substring("question", 1, 1)), F.expr("substring(question, 2)"), F.lit("?"))
    return _out(df, F.col("passage"), q, F.array(*[F.lit(o) for o in BOOLEAN_OPTIONS]),
                F.when(F.try_variant_get(F.when(F.schema_of_variant("answer") == "BOOLEAN", F.col("answer")), "$", "boolean"), 0)
                .when(F.schema_of_variant("answer") == "BOOLEAN", 1), _kept(df, keep))  # missing or unparsable: NULL


MCQ_JSON_SCHEMA = "text string, question string, options array<string>, label bigint, source string"


def read_mcq_jsonl(spark: SparkSession, path: str, fail_fast: bool = True, extra: str = "") -> DataFrame:
    """Canonical JSON lines; a malformed line fails the job (FAILFAST)."""
    r = spark.read.schema(MCQ_JSON_SCHEMA + extra)
    if fail_fast:
        r = r.option("mode", "FAILFAST")
    return r.json(path)


MCQ_FIELDS = "text string, question string, options variant, label variant"


def read_mcq_lines(spark: SparkSession, path: str, keep: Sequence[str] = (), extra: str = "") -> DataFrame:
    """S9 as a source of a catalogue: typed cells, a malformed line is one bad row."""
    df = _json(spark, path, MCQ_FIELDS, extra)
    return _out(df, F.col("text"), F.col("question"), string_list(F.col("options")), whole_number(F.col("label")), _kept(df, keep))


def read_by_suffix(spark: SparkSession, path: str, extra: str = "") -> DataFrame:
    """Parquet when the path ends in .parquet, else JSON lines; the canonical
    fields (and those of ``extra``), an options cell in text form parsed (S14)."""
    if not path.rstrip("/").endswith(".parquet"):
        return read_mcq_jsonl(spark, path, extra=extra)
    df = spark.read.parquet(path)
    want = T.StructType.fromDDL(MCQ_JSON_SCHEMA + extra)
    cells = {}
    for f in want:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name == "options" and f.name in df.columns and isinstance(df.schema["options"].dataType, T.StringType):
            c = coerce_options(c)
        cells[f.name] = c.cast(f.dataType).alias(f.name)
    return df.select(*cells.values())


def read_tagged(spark: SparkSession, directory: str, glob: str = "*.jsonl",
                exclude_stem: str | None = "merged_dataset") -> DataFrame:
    """Every file of a folder, each row tagged ``source`` = file stem;
    the earlier merge output is left out."""
    df = (spark.read.schema(MCQ_JSON_SCHEMA).option("pathGlobFilter", glob).json(directory)
          .withColumn("source", F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")))
    if exclude_stem:
        df = df.where(F.col("source") != exclude_stem)
    return df


# Where a row stands in its source: file, split of the file, row of the split.
def place() -> list[Column]:
    return [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_blk"),
            F.monotonically_increasing_id().alias("_mid")]


def with_positions(df: DataFrame, name: str, per_file: bool = False) -> DataFrame:
    """Adds ``name``, the 0-based position of a row of a file scan over its
    files in path order (``per_file``: in its file), from the columns of ``place``.

    A split of a file is read by one task, which numbers its rows one after the
    other; so one aggregate over the scan, a row a split, gives each split's
    first number and, by a prefix sum, the rows before it.  The rows only meet
    that map, which is broadcast up to a checked size; they are not moved."""
    splits = materialize(df.groupBy("_file", "_blk").agg(F.min("_mid").alias("_m0"), F.count(F.lit(1)).alias("_n")), "splits")
    before = Window.partitionBy(*(["_file"] if per_file else [])).orderBy(*([] if per_file else ["_file"]), "_blk").rowsBetween(Window.unboundedPreceding, -1)
    bases = splits.select(F.col("_file").alias("_f"), F.col("_blk").alias("_b"),
                          (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_m0")).alias("_base"))
    joined = join_small(df, bases, (F.col("_file") == F.col("_f")) & (F.col("_blk") == F.col("_b")), bound=splits.count())
    return joined.withColumn(name, (F.col("_mid") + F.col("_base")).cast("bigint")).drop("_f", "_b", "_base", "_blk", "_mid")


def read_indexed(spark: SparkSession, fmt: str, path: str | Sequence[str], source: str | Column) -> DataFrame:
    """A source's rows with ``index`` (0-based position over its files in path
    order), ``source`` and ``bad`` (the raw text of a line that is no record,
    NULL on all others), as the cleaning step takes them."""
    df = READERS[fmt](spark, path, keep=place())
    if "bad" not in df.columns:
        df = df.withColumn("bad", F.lit(None).cast("string"))
    df = with_positions(df, "index")
    return df.select("index", "text", "question", "options", "label", (F.lit(source) if isinstance(source, str) else source).alias("source"), "bad")


READERS: dict[str, Callable[..., DataFrame]] = {
    "race": read_race,
    "arc": read_arc,
    "logiqa": read_logiqa,
    "reclor": read_reclor,
    "winogrande": read_winogrande,
    "balacopa": read_balacopa,
    "boolean": read_boolean,
    "mcq": read_mcq_lines,
}


def check_catalogue(spark: SparkSession, entries: Sequence[tuple[str, str, str]], mode: str = "skip"):
    """(name, format, path) entries; ``skip`` drops missing ones, ``fail``
    raises listing every missing path.  Checked through the Hadoop FS API."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    present, missing = [], []
    for name, fmt, path in entries:
        p = jvm.org.apache.hadoop.fs.Path(path)
        (present if p.getFileSystem(conf).exists(p) else missing).append((name, fmt, path))
    if missing and mode == "fail":
        raise FileNotFoundError("missing sources: " + ", ".join(m[2] for m in missing))
    return present, missing


CATALOGUE = "name string, format string, path string, grp string"


def read_catalogue(spark: SparkSession, entries: Sequence[tuple], mode: str = "skip") -> DataFrame:
    """S13 + U1: every present source read with its converter, with ``index``,
    ``source`` (its name), ``bad``, ``dataset`` (its name) and ``grp``.

    ``entries`` are (name, format, path) or (name, format, path, group).  A source
    is one scan of its own, since positions count within it; a line that does not
    parse is a row with its text in ``bad``, so no source can fail another."""
    present, _ = check_catalogue(spark, [e[:3] for e in entries], mode)
    group = {e[0]: e[3] if len(e) > 3 else None for e in entries}
    out = None
    for name, fmt, path in present:
        df = read_indexed(spark, fmt, path, name).withColumn("dataset", F.lit(name)).withColumn("grp", F.lit(group[name]).cast("string"))
        out = df if out is None else out.unionByName(df)
    return out


def quarantine(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, bad lines) of a catalogue reading; every row is in one of them."""
    return rows.where(F.col("bad").isNull()).drop("bad"), rows.where(F.col("bad").isNotNull()).select("dataset", "index", "bad")


UNASSIGNED = "unassigned"


def assign_groups(rows: DataFrame, groups: DataFrame, ratios: DataFrame) -> DataFrame:
    """Dataset -> group -> ratio.  ``groups`` (dataset, grp) and ``ratios`` (grp,
    ratio, grp_ord) are configuration tables.  A dataset without a group, and a
    group without a ratio, stay in as ``unassigned`` with ratio 0, last in order;
    ``group_audit`` counts them."""
    n_groups, n_ratios = groups.count(), ratios.count()  # configuration: their sizes bound the broadcasts
    known = groups.join(ratios, "grp", "left_semi").select(F.col("dataset").alias("_d"), "grp")
    x = join_small(rows.drop("grp", "ratio", "grp_ord"), known, F.col("dataset") == F.col("_d"), "left", bound=n_groups).drop("_d")
    x = join_small(x, ratios.select(F.col("grp").alias("_g"), "ratio", "grp_ord"), F.col("grp") == F.col("_g"), "left", bound=n_ratios).drop("_g")
    return x.withColumns({"grp": F.coalesce("grp", F.lit(UNASSIGNED)), "ratio": F.coalesce("ratio", F.lit(0.0)),
                          "grp_ord": F.coalesce("grp_ord", F.lit(n_ratios))})


def group_audit(assigned: DataFrame) -> DataFrame:
    """Rows by dataset and group, the unassigned ones among them."""
    return assigned.groupBy("dataset", "grp").agg(F.count(F.lit(1)).alias("n"))

"""Table schemas and reason codes."""

from pyspark.sql import types as T

MCQ = T.StructType([
    T.StructField("index", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("question", T.StringType()),
    T.StructField("options", T.ArrayType(T.StringType())),
    T.StructField("label", T.LongType()),
    T.StructField("source", T.StringType()),
])

MCQ_COLUMNS = ["index", "text", "question", "options", "label", "source"]

# Reject reasons of the converter's cleaning step, in
# precedence order (first match wins), then the annotation for rows whose
# repeated options were merged and which were kept.
REASONS = [
    "other_error",
    "invalid_option",
    "duplicate_options",
    "too_few_options",
    "label_out_of_range",
    "text_question_empty",
    "text_equals_question",
    "duplicate_sample",
]
NOTE_DEDUPED = "options_deduped_kept"

# Reject reasons of the mix loader's validator, in order.
MIX_REASONS = [
    "json_parse_error",
    "missing_field",
    "text_question_empty",
    "options_not_list_or_empty",
    "option_blank_or_not_string",
    "duplicate_options",
    "label_not_int",
    "label_out_of_range",
]

REASONING_STRUCT = T.StructType([
    T.StructField("reasoning_type", T.StringType()),
    T.StructField("given_facts", T.ArrayType(T.StringType())),
    T.StructField("logical_steps", T.ArrayType(T.StringType())),
    T.StructField("conclusion", T.StringType()),
    T.StructField("answer", T.StringType()),
    T.StructField("confidence", T.StringType()),
    T.StructField("reasoning_pattern", T.StringType()),
])
REASONING_FIELDS = [f.name for f in REASONING_STRUCT.fields]

ANALYSIS_STRUCT = T.StructType([
    T.StructField("reasoning_process", T.ArrayType(T.StringType())),
    T.StructField("correct_answer", T.StringType()),
    T.StructField("difficulty_level", T.StringType()),
    T.StructField("question_type", T.StringType()),
    T.StructField("reasoning_type", T.StringType()),
    T.StructField("is_valid", T.BooleanType()),
])

MESSAGE = T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
])

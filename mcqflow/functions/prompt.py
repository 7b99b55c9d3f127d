"""Prompt rendering, chat payloads and chat transcripts (all JVM expressions)."""

from __future__ import annotations

from typing import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mcqflow.functions.text import blank_to_empty, options_block, options_inline, py_strip

# Prompt layouts of the four prompt styles.
LENGTH_SUFFIX = "\nAnswer:"
STEPS_SUFFIX = "\nAnswer:\nTake a deep breath and work on this problem step-by-step."
ANALYSIS_TAIL = "\n\nLet's think step by step:"
# Chat template markers.
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def prompt_length_style(text="text", question="question", options="options") -> Column:
    """'{text}\\nQuestion: {q}\\nA. x\\nB. y\\nAnswer:' (length analysis)."""
    return F.concat(blank_to_empty(text), F.lit("\nQuestion: "), blank_to_empty(question), F.lit("\n"),
                    options_block(options), F.lit(LENGTH_SUFFIX))


def prompt_steps_style(text="text", question="question", options="options") -> Column:
    """Free-text reasoning request: options block and a step-by-step cue."""
    return F.concat(blank_to_empty(text), F.lit("\nQuestion: "), blank_to_empty(question),
                    F.lit("\nOptions:\n"), options_block(options), F.lit(STEPS_SUFFIX))


def prompt_json_style(text="text", question="question", options="options") -> Column:
    """Structured reasoning request: 'Text: ..\\nQuestion: ..\\nOptions:\\nA. ..'."""
    return F.concat(F.lit("Text: "), blank_to_empty(text), F.lit("\nQuestion: "), blank_to_empty(question),
                    F.lit("\nOptions:\n"), options_block(options))


def prompt_analysis_style(text="text", question="question", options="options") -> Column:
    """Analysis request: blank text/question omitted; '(A) x (B) y' options."""
    t = py_strip(blank_to_empty(text))
    q = py_strip(blank_to_empty(question))
    return F.concat(F.when(t != "", F.concat(t, F.lit("\n\n"))).otherwise(F.lit("")),
                    F.when(q != "", F.concat(q, F.lit("\n"))).otherwise(F.lit("")),
                    F.lit("\nOptions: "), options_inline(options), F.lit(ANALYSIS_TAIL))


STYLES: dict[str, Callable[..., Column]] = {
    "length": prompt_length_style,
    "steps": prompt_steps_style,
    "json": prompt_json_style,
    "analysis": prompt_analysis_style,
}


def messages(system_prompt, user: Column) -> Column:
    """array<struct<role, content>>: system + user."""
    sp = system_prompt if isinstance(system_prompt, Column) else F.lit(system_prompt)
    return F.array(F.struct(F.lit("system").alias("role"), sp.alias("content")),
                   F.struct(F.lit("user").alias("role"), user.alias("content")))


def request_payload(user: Column, system_prompt: str, model: str, temperature: float,
                    max_tokens: int, json_object: bool = False) -> Column:
    """Chat request body as JSON text."""
    fields = [F.lit(model).alias("model"), messages(system_prompt, user).alias("messages"),
              F.lit(float(temperature)).alias("temperature"), F.lit(int(max_tokens)).alias("max_tokens")]
    if json_object:
        fields.append(F.struct(F.lit("json_object").alias("type")).alias("response_format"))
    return F.to_json(F.struct(*fields))


def chat_transcript(turns: DataFrame, conv="conv_id", turn="turn", role="role", text="text",
                    add_generation_prompt: bool = True) -> DataFrame:
    """One row per conversation: '<|im_start|>role\\ntext<|im_end|>\\n' per
    turn in turn order, optionally followed by the assistant generation prompt.

    A conversation is one output string, so its turns are gathered per
    conversation (partial aggregation of the list per map task first)."""
    msg = F.concat(F.lit(IM_START), F.col(role), F.lit("\n"), F.coalesce(F.col(text), F.lit("")),
                   F.lit(IM_END + "\n"))
    g = turns.groupBy(conv).agg(F.array_sort(F.collect_list(F.struct(F.col(turn).alias("t"),
                                                                      msg.alias("m")))).alias("_ms"))
    out = F.array_join(F.transform("_ms", lambda s: s["m"]), "")
    if add_generation_prompt:
        out = F.concat(out, F.lit(IM_START + "assistant\n"))
    return g.select(conv, out.alias("transcript"))


def render_messages(msgs: Column, add_generation_prompt: bool = True) -> Column:
    """P12 on one row's message list (array<struct<role, content>>)."""
    out = F.array_join(F.transform(msgs, lambda m: F.concat(
        F.lit(IM_START), m["role"], F.lit("\n"), F.coalesce(m["content"], F.lit("")), F.lit(IM_END + "\n"))), "")
    return F.concat(out, F.lit(IM_START + "assistant\n")) if add_generation_prompt else out


# Built-in length measures for prompt-length analysis.  A real BPE tokenizer
# is pluggable through ``token_length_udf``.
# word characters of any script, spelled out so that every engine agrees
TOKEN_PATTERN = r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s]"


def char_length(prompt: Column) -> Column:
    return F.length(prompt).cast("bigint")


def regex_token_length(prompt: Column) -> Column:
    """Words and single punctuation marks (a JVM regex count)."""
    return F.regexp_count(prompt, F.lit(TOKEN_PATTERN)).cast("bigint")


def token_length_udf(tokenize: Callable[[str], list]):
    """P21 with a user-supplied tokenizer: an Arrow-batched pandas UDF that
    returns len(tokenize(prompt)).  The tokenizer object is created once per
    worker process by the callable's closure."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("bigint")
    def _len(s: pd.Series) -> pd.Series:
        return s.map(lambda p: len(tokenize(p)) if p is not None else None).astype("Int64")

    return _len

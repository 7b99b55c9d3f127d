"""Query: reasoning validation run as a Structured Streaming job."""

from __future__ import annotations

from mcqflow.plans.q_answers import MCQ, PROBLEMS_SQL, REASONING, reasoning
from mcqflow.plans.oracle_sql import with_ctes
from mcqflow.plans.registry import register
from mcqflow.session import scratch_path
from mcqflow.streaming.answers import reasoning_check_stream


@register("stream_reasoning_problems", with_ctes(MCQ, REASONING, PROBLEMS_SQL) + """
SELECT "index", problems, len(problems) = 0 AS valid FROM probs""")
def q_stream_reasoning_problems(spark, sf):
    """The reasoning fixture is written as JSON-lines files, consumed by a
    file stream (available-now trigger) and the Parquet sink is read back."""
    src, sink, ck = (scratch_path(spark, n) for n in ("stream_src", "stream_sink", "stream_ck"))
    reasoning(spark, sf).select("index", "text", "question", "options", "label", "reasoning").write.json(src)
    q = reasoning_check_stream(spark, src, sink, ck)
    q.awaitTermination()
    return spark.read.parquet(sink).select("index", "problems", "valid")

"""Structured Streaming entry points.

Every row-level check (answer extraction P13, answer checks P14, reasoning
problems P18) is a stateless column expression, so the same expressions run
on a file stream unchanged.  No operator of the source pipeline keeps state
across rows of a stream; aggregates (A15 totals) run per micro-batch or on
the sink table.
"""

from mcqflow.streaming.answers import reasoning_check_stream  # noqa: F401

"""Answer-letter extraction and reasoning checks as JVM regex expressions.

Extraction: the regexes are tried in order on the stripped text; for the
first one that matches, its group 1 is searched for the option letters in
letter order; the first letter contained wins, else the next regex is tried;
else ''.  One ``coalesce`` over per-regex ``CASE`` expressions: evaluation
stops at the first regex that yields a letter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mcqflow.functions.text import py_strip

# Answer patterns, in order ({o} = the option letters).  Written
# for Java regex: braces of 'boxed{..}' are escaped.  Group 1 of the
# eleventh pattern is white space, so that pattern never yields a letter.
ANSWER_PATTERNS = [
    r"(?i)ANSWER\s*:\s*([{o}])",
    r"[Tt]he answer is:?\s+\(?([{o}])\)?",
    r"[Tt]he answer is:?\s+\(?\*?\*?([{o}])\*?\*?\)?",
    r"[Tt]he answer is option:?\s+\(?([{o}])\)?",
    r"[Tt]he correct answer is:?\s+\(?([{o}])\)?",
    r"[Tt]he correct answer is option:?\s+\(?([{o}])\)?",
    r"[Tt]he correct answer is:?.*?boxed\{{([{o}])\}}",
    r"[Tt]he correct option is:?.*?boxed\{{([{o}])\}}",
    r"[Tt]he correct answer option is:?.*?boxed\{{([{o}])\}}",
    r"[Tt]he answer to the question is:?\s+\(?([{o}])\)?",
    r"(\s|^)[{o}][\s。，,：:\.$]",
    r"1.\s?(.*?)$",
    r"1.\s?([{o}])[.。$]?$",
]
# The two fallback ("cushion") patterns.
CUSHION_PATTERNS = [
    r"([{o}]):",
    r"([{o}])",
]

# Step-by-step markers, conclusion markers, step counters.
STEP_MARKERS = [
    r"[Ll]et's think step by step",
    r"步骤[：:]\s*\d+",
    r"[Ss]tep\s*\d+",
    r"首先",
    r"其次",
    r"最后",
    r"第[一二三四五]",
    r"[Ff]irst",
    r"[Ss]econd",
    r"[Tt]hird",
    r"[Ff]inally",
]
CONCLUSION_MARKERS = [
    r"[Tt]herefore",
    r"[Tt]hus",
    r"[Tt]he answer is",
    r"[Tt]he correct answer is",
    r"所以",
    r"因此",
    r"综上所述",
    r"答案[是为]",
    r"选择",
    r"选项",
]
STEP_COUNT_PATTERNS = [
    r"步骤\s*\d+",
    r"[Ss]tep\s*\d+",
    r"第[一二三四五]步",
    r"[Ff]irst",
    r"[Ss]econd",
    r"[Tt]hird",
    r"[Ff]ourth",
    r"[Ff]ifth",
]


def answer_patterns(letters: str = "ABCD", cushion: bool = True) -> list[str]:
    pats = ANSWER_PATTERNS + (CUSHION_PATTERNS if cushion else [])
    return [p.format(o=letters) for p in pats]


def _first_letter(g: Column, letters: str) -> Column:
    out = None
    for ch in letters:
        cond = F.instr(g, ch) > 0
        out = F.when(cond, F.lit(ch)) if out is None else out.when(cond, F.lit(ch))
    return out


# Literals each pattern cannot match without (by pattern position): the
# regex runs only when they occur, a plain substring search first.
_GUARDS = {0: [":"], 1: ["he answer is"], 2: ["he answer is"], 3: ["he answer is option"],
           4: ["he correct answer is"], 5: ["he correct answer is option"],
           6: ["he correct answer is", "boxed{"], 7: ["he correct option is", "boxed{"],
           8: ["he correct answer option is", "boxed{"], 9: ["he answer to the question is"],
           11: ["1"], 12: ["1"], 13: [":"]}
# Group 1 of pattern 10 is white space or empty: it never holds a letter, so
# evaluating it can never change the result.
_NEVER_YIELDS = {10}


def extract_answer(text, letters: str = "ABCD", cushion: bool = True) -> Column:
    """The extracted option letter, or ''."""
    t = py_strip(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
    parts = []
    for i, p in enumerate(answer_patterns(letters, cushion)):
        if i in _NEVER_YIELDS:
            continue
        letter = _first_letter(F.regexp_extract(t, "(?sU)" + p, 1), letters)
        guard = None
        for lit in _GUARDS.get(i, []):
            g = F.instr(t, lit) > 0
            guard = g if guard is None else guard & g
        parts.append(letter if guard is None else F.when(guard, letter))
    return F.coalesce(*parts, F.lit(""))


def answer_correct(extracted: Column, label: Column) -> Column:
    """P14a/b: extracted letter's index equals the label; '' is wrong."""
    return (extracted != "") & (F.ascii(extracted) - 65 == label)


def json_answer_correct(answer: Column, label: Column) -> Column:
    """upper(strip(answer)) equals the label letter."""
    return F.coalesce(F.upper(py_strip(answer)) == F.char(F.lit(65) + label), F.lit(False))


def exact_answer_correct(answer: Column, label: Column) -> Column:
    """P14d: exact string equality; a missing response is wrong."""
    return F.coalesce(answer == F.char(F.lit(65) + label), F.lit(False))


def _any_match(col: Column, pats: list[str]) -> Column:
    return col.rlike("(?U)(?:" + ")|(?:".join(pats) + ")")


def has_step_marker(col: Column) -> Column:
    """P15."""
    return _any_match(F.coalesce(col, F.lit("")), STEP_MARKERS)


def has_conclusion(col: Column) -> Column:
    """P16."""
    return _any_match(F.coalesce(col, F.lit("")), CONCLUSION_MARKERS)


def step_count(col: Column) -> Column:
    """Sum over patterns of non-overlapping matches (per pattern)."""
    c = F.coalesce(col, F.lit(""))
    out = None
    for p in STEP_COUNT_PATTERNS:
        k = F.regexp_count(c, F.lit("(?U)" + p))
        out = k if out is None else out + k
    return out.cast("bigint")


# Problem codes of the reasoning validator, in the order they are checked.
PROBLEMS = ["too_short", "too_long", "answer_wrong", "too_few_steps", "no_step_marker", "no_conclusion"]


def reasoning_problems(reasoning: Column, label: Column, letters: str = "ABCDEF",
                       min_len: int = 0, max_len: int = 200000, min_steps: int = 0) -> Column:
    """Array of problem codes (empty = valid)."""
    r = F.coalesce(reasoning, F.lit(""))
    n = F.length(r)
    ok = answer_correct(extract_answer(r, letters), label)
    arr = F.array(
        F.when(n < min_len, F.lit("too_short")).when(n > max_len, F.lit("too_long")),
        F.when(~ok, F.lit("answer_wrong")),
        F.when(step_count(r) < min_steps, F.lit("too_few_steps")),
        F.when(~has_step_marker(r), F.lit("no_step_marker")),
        F.when(~has_conclusion(r), F.lit("no_conclusion")))
    return F.filter(arr, lambda x: x.isNotNull())


def response_content(resp: Column) -> Column:
    """choices[0].message.content of a chat response body."""
    return F.get_json_object(resp, "$.choices[0].message.content")


def has_fields(json_text: Column, fields: list[str]) -> Column:
    """P20: every field is present as a top-level key (null values count as
    present); unparsable JSON is False."""
    keys = F.json_object_keys(json_text)
    return F.coalesce(F.forall(F.array(*[F.lit(f) for f in fields]),
                               lambda f: F.array_contains(keys, f)), F.lit(False))

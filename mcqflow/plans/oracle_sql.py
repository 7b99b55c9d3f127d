"""DuckDB SQL for the oracle check (the driver runs it on the same parquet).

Each function returns SQL text; CTEs are composed the same way the Spark
operators are.  Lists are 1-based in DuckDB.
"""

from __future__ import annotations

from mcqflow.functions.text import whitespace_sql
from mcqflow.sources.fixtures import (GROUP_RATIOS, OPTS_BAD, OPTS_BOOL, OPTS_CASE_DUP,
                                      OPTS_FIVE, OPTS_FOUR, OPTS_ONE, OPTS_TWO_SAME,
                                      Q_EN, Q_LANG)

WS = whitespace_sql()


def STRIP(x: str) -> str:
    return f"trim({x}, {WS})"


def LOWER_STRIP(x: str) -> str:
    return f"lower({STRIP(x)})"


def _lst(vals) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in vals) + "]"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


MCQ = f"""mcq AS (
  SELECT doc_id AS "index",
    CASE WHEN doc_id % 79 = 0 OR doc_id % 83 = 0 THEN '' ELSE text END AS text,
    CASE WHEN doc_id % 83 = 0 THEN '' WHEN doc_id % 41 = 0 THEN text
         WHEN doc_id % 5 = 0 THEN {_q(Q_EN)} ELSE {_q(Q_LANG)} END AS question,
    CASE WHEN doc_id % 53 = 0 THEN {_lst(OPTS_BAD)}
         WHEN doc_id % 59 = 0 THEN {_lst(OPTS_CASE_DUP)}
         WHEN doc_id % 61 = 0 THEN {_lst(OPTS_ONE)}
         WHEN doc_id % 73 = 0 THEN {_lst(OPTS_TWO_SAME)}
         WHEN doc_id % 5 = 0 THEN {_lst(OPTS_BOOL)}
         WHEN doc_id % 5 = 1 THEN {_lst(OPTS_FIVE)}
         ELSE {_lst(OPTS_FOUR)} END AS options,
    CAST(CASE WHEN doc_id % 67 = 0 THEN 9 WHEN doc_id % 71 = 0 THEN -1
         WHEN doc_id % 61 = 0 OR doc_id % 73 = 0 THEN 0
         WHEN doc_id % 59 = 0 THEN (CASE lang WHEN 'de' THEN 0 WHEN 'en' THEN 2 WHEN 'es' THEN 3 ELSE 4 END)
         WHEN doc_id % 5 = 0 AND doc_id % 53 <> 0 THEN (CASE WHEN lang = 'en' THEN 0 ELSE 1 END)
         ELSE (CASE lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 ELSE 3 END) END AS BIGINT) AS label,
    source,
    'g' || CAST(CAST(regexp_extract(source, '(\\d+)', 1) AS BIGINT) % 7 AS VARCHAR) AS grp,
    'documents' AS dataset, lang
  FROM documents)"""

TWINS = """twins AS (
  SELECT * FROM mcq UNION ALL
  SELECT "index", ' ' || translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') || ' ' AS text,
    question,
    CASE WHEN lang = 'fr' THEN list_reverse(options) ELSE options END AS options,
    CAST(CASE WHEN lang = 'fr' THEN len(options) - 1 - label ELSE label END AS BIGINT) AS label,
    'src_twin' AS source, grp, 'src_twin' AS dataset, lang
  FROM mcq)"""

GROUPS = "groups AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{g}', {r}::DOUBLE, {i})" for i, (g, r) in enumerate(GROUP_RATIOS)) + ") AS t(grp, ratio, grp_ord))"

# Converter cleaning: ordered reasons, option merge, in-dataset first wins.
_CLASSIFIED = f"""c0 AS (
  SELECT *, list_transform(options, lambda o: {STRIP('o')}) AS opts_s,
         {STRIP("coalesce(text, '')")} AS text_s, {STRIP("coalesce(question, '')")} AS question_s
  FROM @SRC),
c1 AS (SELECT *, list_transform(opts_s, lambda o: lower(o)) AS lows FROM c0),
c2 AS (SELECT *, len(list_distinct(lows)) AS n_uniq,
         len(list_distinct(lows)) < len(lows) AS has_dup,
         list_filter(opts_s, lambda o, i: list_position(lows, lower(o)) = i) AS uniq,
         list_filter(lows, lambda o, i: list_position(lows, o) = i) AS uniq_lows
       FROM c1),
c3 AS (SELECT *, CASE
    WHEN options IS NULL OR len(options) = 0
         OR len(list_filter(options, lambda o: o IS NULL OR {STRIP('o')} = '')) > 0 THEN 'other_error'
    WHEN len(list_filter(opts_s, lambda o: NOT regexp_matches(o, '[\\pL\\pN]'))) > 0 THEN 'invalid_option'
    WHEN has_dup AND n_uniq < 2 THEN 'duplicate_options'
    WHEN len(CASE WHEN has_dup THEN uniq ELSE options END) < 2 THEN 'too_few_options'
    WHEN label IS NULL OR label < 0 OR label >= len(options) THEN 'label_out_of_range'
    WHEN text_s = '' AND question_s = '' THEN 'text_question_empty'
    WHEN lower(text_s) = lower(question_s) THEN 'text_equals_question' END AS reason0
  FROM c2),
c4 AS (SELECT *, has_dup AND coalesce(reason0, '') IN ('', 'label_out_of_range', 'text_question_empty',
         'text_equals_question') AS deduped FROM c3),
c5 AS (SELECT "index", text, question, source, grp, dataset, lang, text_s, question_s, reason0,
    CASE WHEN deduped THEN uniq ELSE options END AS options,
    CASE WHEN deduped AND coalesce(reason0, '') <> 'label_out_of_range'
         THEN CAST(list_position(uniq_lows, lows[label + 1]) - 1 AS BIGINT) ELSE label END AS label,
    CASE WHEN deduped THEN opts_s END AS original_options,
    CASE WHEN deduped THEN label END AS original_label,
    CASE WHEN deduped THEN 'options_deduped_kept' END AS note
  FROM c4),
@NAME AS (SELECT * EXCLUDE (reason0, first_idx),
    CASE WHEN reason0 IS NULL AND "index" <> first_idx THEN 'duplicate_sample' ELSE reason0 END AS reason
  FROM (SELECT *, min("index") OVER (PARTITION BY reason0 IS NULL, dataset, text_s, question_s, options) AS first_idx
        FROM c5))"""



def classified_cte(src: str = "mcq", name: str = "classified") -> str:
    body = _CLASSIFIED.replace("@SRC", src).replace("@NAME", name)
    for c in ("c0", "c1", "c2", "c3", "c4", "c5"):
        body = body.replace(f"{c} AS (", f"{name}_{c} AS (").replace(f"FROM {c})", f"FROM {name}_{c})")
        body = body.replace(f"FROM {c}\n", f"FROM {name}_{c}\n")
    return body


CLASSIFIED = classified_cte()

VALID = "valid AS (SELECT \"index\", text, question, options, label, source, grp, dataset FROM classified WHERE reason IS NULL)"


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"

"""DuckDB SQL for the registered queries, built from common table expressions.

The SQL restates the meaning of each operator in plain SQL; it shares only fixed values with the library (snippets,
winners, time stamps of the derived tables and the word tables).
"""

from __future__ import annotations

from turnlake.functions.text import FENCE_LANGUAGES, KEYWORD_LANGUAGES, LANGUAGE_ALIASES, STOP_WORDS
from turnlake.operators.scoring import VARIANTS
from turnlake.plans import workload as W

BLANK_CLASS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
RUN = "TIMESTAMP '2024-02-01 12:30:00'"


def lit(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def chosen(values: tuple, number: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {lit(v)}" for i, v in enumerate(values))
    return f"(CASE ({number}) % {len(values)} {cases} END)"


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{BLANK_CLASS}+', ''), '{BLANK_CLASS}+$', '')"


def norm(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{BLANK_CLASS}+', ' ', 'g'))"


def count(x: str, pattern: str) -> str:
    return f"CAST(len(regexp_extract_all(coalesce({x}, ''), '{pattern}')) AS INTEGER)"


def has(x: str, pattern: str) -> str:
    return f"regexp_matches(coalesce({x}, ''), '{pattern}')"


def tokens(x: str) -> str:
    return f"CAST(ceil(length({x}) / 4.0) AS INTEGER)"


def words(x: str) -> str:
    return f"(CASE WHEN {x} = '' THEN 0 ELSE len(string_split({x}, ' ')) END)"


def code(x: str) -> str:
    return has(x, r"```[\w+-]*\n(?s:.)*?```")


def case_map(x: str, table: dict[str, str]) -> str:
    return "(CASE " + x + " " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in table.items()) + " END)"


def prog_lang(p: str, r: str) -> str:
    joined = f"concat_ws(chr(10), nullif({p}, ''), nullif({r}, ''))"
    labels = f"regexp_extract_all({joined}, '```([A-Za-z0-9_+#-]+)', 1)"
    mapped = f"list_filter(list_transform({labels}, lambda x: {case_map('lower(x)', FENCE_LANGUAGES)}), lambda y: y IS NOT NULL)[1]"
    keys = " ".join(f"WHEN contains(' ' || lower({joined}) || ' ', {lit(k)}) THEN {lit(v)}" for k, v in KEYWORD_LANGUAGES)
    return f"coalesce({mapped}, CASE {keys} END)"


def slug(x: str) -> str:
    return f"coalesce(nullif(trim(regexp_replace(lower({strip(x)}), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'unknown')"


def code_task(x: str) -> str:
    return (
        f"(CASE WHEN {has(x, r'(?i)\bsql\b')} THEN 'database' WHEN {has(x, r'(?i)\bdebug\b')} THEN 'debugging' "
        f"WHEN {has(x, r'(?i)\b(write|generate)\s+code\b')} THEN 'code_generation' "
        f"WHEN {has(x, r'(?i)\bexplain\b')} THEN 'explanation' ELSE 'unknown' END)"
    )


def task(label: str, x: str) -> str:
    return (
        f"(CASE WHEN lower({strip(label)}) NOT IN ('', 'unknown') THEN {slug(label)} "
        f"WHEN {has(x, r'(?i)(\bdebug|fix\b)')} THEN 'debugging' "
        f"WHEN {has(x, r'(?i)\b(write|generate|create)\b')} THEN 'code_generation' "
        f"WHEN {has(x, r'(?i)\bexplain\b')} THEN 'explanation' "
        f"WHEN {has(x, r'(?i)\bsql\b')} THEN 'database' ELSE 'unknown' END)"
    )


def prompt_type(x: str, label: str) -> str:
    return (
        f"(CASE WHEN {has(x, r'(?i)\bact as\b')} THEN 'roleplay' "
        f"WHEN {label} <> '' THEN replace(lower({norm(label)}), ' ', '_') ELSE 'standard' END)"
    )


def detected(n: str) -> str:
    """Most stop words, ties to the first code, nothing found is unknown. The tables hold no other scripts."""
    parts = []
    for lang, known in sorted(STOP_WORDS.items()):
        inside = ", ".join(lit(w) for w in known.split())
        parts.append((lang, f"len(list_filter(string_split(lower({n}), ' '), lambda w: w IN ({inside})))"))
    best = "greatest(" + ", ".join(p for _, p in parts) + ")"
    cases = " ".join(f"WHEN {p} = {best} THEN {lit(lang)}" for lang, p in parts)
    return f"(CASE WHEN {best} = 0 THEN 'unknown' {cases} END)"


def _trigrams(source: str, keys: str) -> str:
    """One row per trigram of each distinct word of (keys, text)."""
    points = " + ".join(f"unicode(substring(p, i + {k}, 1))::BIGINT * {factor}" for k, factor in enumerate((7919, 131, 1)))
    return f"""SELECT {keys}, ({points}) % 8191 AS bucket FROM (SELECT {keys}, p, unnest(range(1, length(p) - 1)) AS i FROM (
        SELECT {keys}, ' ' || w || ' ' AS p FROM (SELECT {keys}, unnest(list_distinct(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}]+'))) AS w FROM ({source}))
        WHERE length(w) BETWEEN 1 AND 40))"""


def language_profile(source: str) -> str:
    """CTEs up to `language_profile` (lang, bucket, weight) of the labelled texts (text, lang)."""
    return f"""
trigram_counts AS (SELECT lang, CAST(bucket AS INTEGER) AS bucket, count(*) AS n FROM ({_trigrams(source, 'lang')}) WHERE lang IS NOT NULL GROUP BY ALL),
trigram_totals AS (SELECT lang, sum(n) + 0.5 * 8191 AS total FROM trigram_counts GROUP BY lang),
language_profile AS (
  SELECT lang, bucket, CAST(round(1000 * ln((n + 0.5) / total)) AS BIGINT) AS weight FROM trigram_counts JOIN trigram_totals USING (lang)
  UNION ALL SELECT lang, -1, CAST(round(1000 * ln(0.5 / total)) AS BIGINT) FROM trigram_totals)"""


def profiled(source: str) -> str:
    """CTE `profiled` (id, detected) of texts (id, text) by the CTE `language_profile`; texts without letters have no row."""
    return f"""
profiled AS (
  SELECT id, lang AS detected FROM (
    SELECT id, r.lang, sum(coalesce(s.weight, r.weight)) AS score FROM ({_trigrams(source, 'id')}) g
    CROSS JOIN (SELECT lang, weight FROM language_profile WHERE bucket = -1) r
    LEFT JOIN language_profile s ON s.lang = r.lang AND s.bucket = g.bucket GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, lang) = 1)"""


def spoken(label: str, n: str) -> str:
    given = f"lower({norm(label)})"
    return (
        f"(CASE WHEN {label} <> '' THEN coalesce({case_map(given, LANGUAGE_ALIASES)}, nullif({given}, ''), 'unknown') "
        f"ELSE {detected(n)} END)"
    )


EXAMPLES = r"(?i)(\bexamples?\b|e\.g\.)"
CONSTRAINTS = r"(?i)\b(step by step|must|should|only|do not)\b"
VERBS = r"(?i)\b(create|generate|fix|write|improve|explain|optimize|convert)\b"


def features(source: str, name: str) -> str:
    """CTEs `<name>` = all columns of `source` with the prompt features."""
    return f"""
{name}_1 AS (
  SELECT * REPLACE ({strip('prompt_text')} AS prompt_text, {strip('response_text')} AS response_text) FROM {source}),
{name}_2 AS (
  SELECT *, {norm('prompt_text')} AS n_, {norm('response_text')} AS rn_,
    {count('prompt_text', EXAMPLES)} AS example_count, {count('prompt_text', CONSTRAINTS)} AS constraint_count
  FROM {name}_1),
{name} AS (
  SELECT * EXCLUDE (n_, rn_, language_label, type_label, task_label),
    sha256(n_) AS prompt_hash, CAST(length(prompt_text) AS INTEGER) AS prompt_length,
    {tokens('n_')} AS token_estimate, {prompt_type('prompt_text', 'type_label')} AS prompt_type,
    ({code('prompt_text')} OR {code('response_text')}) AS contains_code,
    example_count > 0 AS contains_examples, constraint_count > 0 AS contains_constraints,
    {spoken('language_label', 'n_')} AS language,
    round(CAST(0.4 AS DOUBLE) * {tokens('n_')} + CAST(0.3 AS DOUBLE) * constraint_count
      + CAST(0.3 AS DOUBLE) * example_count, 4) AS complexity_score,
    round({count('n_', VERBS)} / CAST(greatest({words('n_')}, 1) AS DOUBLE), 4) AS instruction_density,
    nullif({tokens('rn_')}, 0) AS response_tokens, {tokens('n_')} + {tokens('rn_')} AS tokens,
    {prog_lang('prompt_text', 'response_text')} AS programming_lang,
    {task('task_label', 'prompt_text')} AS task_type
  FROM {name}_2)"""


# --- derived raw tables ------------------------------------------------------------------------

ROLE_CASE = "(CASE WHEN lower({r}) IN ('human', 'user') THEN 'user' WHEN lower({r}) IN ('gpt', 'assistant', 'bot') THEN 'assistant' END)"

MESSAGES = f"""
messages AS (
  SELECT CAST(conv_id AS VARCHAR) AS conversation_id, turn, {ROLE_CASE.format(r="trim(role)")} AS side,
    {strip("text || (CASE WHEN role = 'user' THEN " + chosen(W.PROMPT_SNIPPETS, 'conv_id + turn')
           + " ELSE " + chosen(W.REPLY_SNIPPETS, 'conv_id + turn') + " END)")} AS body
  FROM conversations)"""

PAIRS = MESSAGES + """,
next_messages AS (
  SELECT *, lead(side) OVER w AS next_side, lead(body) OVER w AS next_body
  FROM messages WINDOW w AS (PARTITION BY conversation_id ORDER BY turn)),
pairs AS (
  SELECT conversation_id, CAST(row_number() OVER (PARTITION BY conversation_id ORDER BY turn) AS INTEGER) AS turn_number,
    body AS prompt_text, nullif(next_body, '') AS response_text
  FROM next_messages WHERE side = 'user' AND next_side = 'assistant' AND body <> '')"""

DOCS = f"""
docs AS (
  SELECT d.doc_id, d.lang, d.source, d.text || {chosen(W.PROMPT_SNIPPETS, 'd.doc_id')} AS text,
    (l.quality + 1 - l.toxic) / 2.0 AS success_score
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""

_ROLE = "(CASE (i + doc_id) % 7 " + " ".join(f"WHEN {k} THEN {lit(r)}" for k, r in enumerate(W.ROLES)) + " END)"
CODE_CHATS = DOCS + f""",
chat_lines AS (
  SELECT doc_id, string_split(text, chr(10)) AS lines FROM docs),
chat_ids AS (
  SELECT doc_id, lines, sha256('{W.CODE}:' || CAST(to_json(list_transform(range(len(lines)),
    lambda i: {{'from': {_ROLE}, 'value': lines[i + 1]}})) AS VARCHAR)) AS conversation_id FROM chat_lines),
chat_rows AS (
  SELECT doc_id, conversation_id, i, {ROLE_CASE.format(r="trim(" + _ROLE + ")")} AS side, {strip('lines[i + 1]')} AS body
  FROM (SELECT *, unnest(range(len(lines))) AS i FROM chat_ids)),
chat_next AS (
  SELECT *, lead(side) OVER w AS next_side, lead(body) OVER w AS next_body
  FROM chat_rows WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
code_pairs AS (
  SELECT conversation_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) AS INTEGER) AS turn_number,
    body AS prompt_text, nullif(next_body, '') AS response_text
  FROM chat_next WHERE side = 'user' AND next_side = 'assistant' AND body <> '')"""

_WINNER = chosen(W.WINNERS, "doc_id")
_STAMP = chosen(W.STAMPS, "doc_id")
_TIME = (
    f"(CASE doc_id % 6 WHEN 0 THEN TIMESTAMP '2024-01-23 08:53:20.25' WHEN 1 THEN TIMESTAMP '2024-01-20 10:11:12' "
    f"WHEN 4 THEN TIMESTAMP '2024-01-21 01:02:03' ELSE {RUN} END)"
)
BATTLES = DOCS + f""",
battle_rows AS (
  SELECT doc_id, CASE WHEN doc_id % 13 <> 5 THEN CAST(doc_id AS VARCHAR) END AS question_id,
    'm' || (doc_id % 7) AS model_a, ' m' || (doc_id % 5) || ' ' AS model_b, {_WINNER} AS winner,
    CASE WHEN doc_id % 3 > 0 THEN CAST(doc_id % 3 AS INTEGER) END AS turn,
    {case_map('lang', W.LABELS)} AS language, {_STAMP} AS tstamp, {_TIME} AS at_time,
    string_split(text, chr(10)) AS a_lines, list_reverse(string_split(text, chr(10))) AS b_lines,
    CASE WHEN doc_id % 9 = 4 THEN -1 ELSE 0 END AS a_user
  FROM docs),
battle_ids AS (
  SELECT *, coalesce(question_id, sha256('{W.ARENA}:' || CAST(to_json({{
    'conversation_a': list_transform(range(len(a_lines)), lambda i: {{'content': a_lines[i + 1],
       'role': CASE WHEN i = a_user THEN 'user' ELSE 'assistant' END}}),
    'conversation_b': list_transform(range(len(b_lines)), lambda i: {{'content': b_lines[i + 1],
       'role': CASE WHEN i = 0 THEN 'user' ELSE 'assistant' END}}),
    'language': language, 'model_a': model_a, 'model_b': model_b, 'question_id': question_id,
    'tstamp': tstamp, 'turn': turn, 'winner': winner}}) AS VARCHAR))) AS conversation_id,
    list_transform(a_lines, lambda x: {strip('x')}) AS a_clean, list_transform(b_lines, lambda x: {strip('x')}) AS b_clean
  FROM battle_rows),
battles AS (
  SELECT *, coalesce(CASE WHEN a_user = 0 THEN nullif(a_clean[1], '') END, nullif(b_clean[1], '')) AS prompt_text,
    array_to_string(list_filter(a_clean[2 + a_user:], lambda x: x <> ''), chr(10) || chr(10)) AS text_a,
    array_to_string(list_filter(b_clean[2:], lambda x: x <> ''), chr(10) || chr(10)) AS text_b,
    lower({strip("coalesce(winner, '')")}) AS side
  FROM battle_ids),
arena AS (
  SELECT conversation_id, coalesce(turn, 1) AS turn_number, prompt_text, at_time, language,
    unnest([{{'model_name': trim(model_a), 'response_text': nullif(text_a, ''),
       'quality_label': CASE WHEN side = 'model_a' THEN 'winner' WHEN side = 'model_b' THEN 'loser'
         WHEN side IN ('tie', 'draw') THEN 'tie' WHEN contains(replace(side, ' ', ''), 'bothbad') THEN 'both_bad' ELSE 'unknown' END,
       'success_score': CASE WHEN side = 'model_a' THEN 1.0 WHEN side = 'model_b' THEN 0.0 WHEN side IN ('tie', 'draw') THEN 0.5
         WHEN contains(replace(side, ' ', ''), 'bothbad') THEN 0.0 END}},
      {{'model_name': trim(model_b), 'response_text': nullif(text_b, ''),
       'quality_label': CASE WHEN side = 'model_b' THEN 'winner' WHEN side = 'model_a' THEN 'loser'
         WHEN side IN ('tie', 'draw') THEN 'tie' WHEN contains(replace(side, ' ', ''), 'bothbad') THEN 'both_bad' ELSE 'unknown' END,
       'success_score': CASE WHEN side = 'model_b' THEN 1.0 WHEN side = 'model_a' THEN 0.0 WHEN side IN ('tie', 'draw') THEN 0.5
         WHEN contains(replace(side, ' ', ''), 'bothbad') THEN 0.0 END}}], recursive := true)
  FROM battles WHERE prompt_text IS NOT NULL)"""

LIBRARY = DOCS + f""",
entries AS (
  SELECT '{W.LIBRARY}:' || sha256({norm(strip('text'))}) AS conversation_id, 1 AS turn_number, {strip('text')} AS prompt_text,
    {slug("'Act #' || source || ' (v1)!'")} AS task_type,
    CASE WHEN doc_id % 4 > 0 THEN 'Type ' || upper(lang) END AS prompt_type,
    CASE WHEN doc_id % 2 = 0 THEN 'developer' ELSE 'general' END AS task_category
  FROM docs WHERE {strip('text')} <> '')"""


def _after_docs(block: str) -> str:
    """A block that starts with DOCS, without it (for combining several)."""
    return block.removeprefix(DOCS + ",")


EVENTS = (
    PAIRS + "," + CODE_CHATS + "," + _after_docs(BATTLES) + "," + _after_docs(LIBRARY) + f""",
events_all AS (
  SELECT conversation_id, turn_number, prompt_text, response_text, {RUN} AS ts, '{W.CHAT}' AS dataset_name,
    CAST(NULL AS VARCHAR) AS model_name, CAST(NULL AS VARCHAR) AS task_label, CAST(NULL AS VARCHAR) AS type_label,
    CAST(NULL AS VARCHAR) AS language_label, CAST(NULL AS VARCHAR) AS task_category,
    CAST(NULL AS VARCHAR) AS quality_label, CAST(NULL AS DOUBLE) AS success_score FROM pairs
  UNION ALL
  SELECT conversation_id, turn_number, prompt_text, response_text, {RUN}, '{W.CODE}', NULL, {code_task('prompt_text')},
    NULL, NULL, NULL, NULL, NULL FROM code_pairs
  UNION ALL
  SELECT conversation_id, turn_number, prompt_text, response_text, at_time, '{W.ARENA}', model_name, NULL, NULL, language, NULL,
    quality_label, success_score FROM arena
  UNION ALL
  SELECT conversation_id, turn_number, prompt_text, NULL, {RUN}, '{W.LIBRARY}', NULL, task_type, prompt_type, NULL,
    task_category, NULL, NULL FROM entries)"""
)
STAGE = EVENTS + "," + features("events_all", "stage")

COMPARISONS = BATTLES + f""",
compared AS (
  SELECT conversation_id, prompt_text, CAST(NULL AS VARCHAR) AS response_text, trim(model_a) AS model_a,
    trim(model_b) AS model_b, {strip("coalesce(winner, '')")} AS winner, at_time AS ts, '{W.ARENA}' AS dataset_name,
    CAST(NULL AS VARCHAR) AS language_label, CAST(NULL AS VARCHAR) AS type_label, CAST(NULL AS VARCHAR) AS task_label
  FROM battles WHERE prompt_text IS NOT NULL)"""
COMPARISON_STAGE = COMPARISONS + "," + features("compared", "comparison_stage")

RUNS = """
runs AS (
  SELECT event_id AS execution_key, ts, user_id AS doc_id, k,
    CASE WHEN k % 10 > 0 THEN 'm' || (user_id % 7) END AS model_name,
    CASE event_type WHEN 'purchase' THEN 'Chatbot Arena' WHEN 'signup' THEN 'arena-extra' WHEN 'click' THEN 'sharegpt_chat'
      ELSE 'other' END AS dataset_name,
    CASE WHEN k % 4 > 0 THEN value END AS latency, k AS tokens,
    CASE WHEN k % 3 > 0 THEN k // 5 END AS response_tokens,
    CASE WHEN k % 11 > 0 THEN (k % 3) / 2.0 END AS success_score
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events))"""

DOC_EVENTS = DOCS + """,
doc_events AS (
  SELECT doc_id, text AS prompt_text, CAST(NULL AS VARCHAR) AS response_text, lang AS language_label,
    CAST(NULL AS VARCHAR) AS type_label, CAST(NULL AS VARCHAR) AS task_label, success_score FROM docs)"""
PROMPTS = DOC_EVENTS + "," + features("doc_events", "prompts")


def hash_order(key: str, seed: int = 42) -> str:
    return f"CAST('0x' || substr(sha256('{seed}:' || {key}), 1, 15) AS BIGINT)"


def split(source: str, key: str, shares: dict[str, float], keep: str, strata: str = "0") -> str:
    """`keep` and the split of every row: cuts of the hash order at the rounded-up cumulative shares."""
    names, sums = list(shares), [sum(list(shares.values())[: i + 1]) for i in range(len(shares))]
    cases = " ".join(f"WHEN place <= ceil(round(total * {s}, 6)) THEN '{n}'" for n, s in zip(names[:-1], sums))
    return f"""SELECT {keep}, CASE {cases} ELSE '{names[-1]}' END AS split FROM (SELECT *,
      row_number() OVER (PARTITION BY {strata} ORDER BY {hash_order(key)}, {key}) AS place,
      count(*) OVER (PARTITION BY {strata}) AS total FROM {source})"""


def with_(ctes: str, query: str) -> str:
    return "WITH " + ctes.strip() + "\n" + query


DAILY = RUNS + """,
daily AS (
  SELECT CAST(ts AS DATE) AS day, coalesce(model_name, 'unknown') AS model_name, count(*) AS attempts,
    avg(success_score) AS avg_success, quantile_cont(success_score, 0.5) AS median_success
  FROM runs WHERE success_score IS NOT NULL GROUP BY ALL)"""
ARENA_ROLLUP = RUNS + """,
arena_rollup AS (
  SELECT model_name, count(*) AS attempts, avg(success_score) AS avg_success,
    quantile_cont(success_score, 0.5) AS median_success
  FROM runs WHERE success_score IS NOT NULL AND model_name IS NOT NULL AND dataset_name ILIKE '%arena%' GROUP BY 1)"""
LANGUAGE_ROLLUP = PROMPTS + """,
language_rollup AS (
  SELECT programming_lang, count(*) AS prompts, avg(success_score) AS success_rate,
    quantile_cont(success_score, 0.5) AS median_success
  FROM prompts WHERE success_score IS NOT NULL AND programming_lang IS NOT NULL GROUP BY 1)"""
PROMPT_DIM = PROMPTS + """,
prompt_dim AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY prompt_hash ORDER BY prompt_length DESC, prompt_text) AS place
    FROM prompts) WHERE place = 1),
run_prompts AS (SELECT r.*, p.prompt_hash FROM runs r JOIN prompts p ON p.doc_id = r.doc_id)"""
IMPACT = RUNS + "," + PROMPT_DIM + """,
impact AS (
  SELECT p.contains_examples, p.contains_code, p.contains_constraints, count(*) AS cnt, avg(r.success_score) AS avg_success,
    quantile_cont(r.success_score, 0.5) AS median_success
  FROM run_prompts r JOIN prompt_dim p USING (prompt_hash) WHERE r.success_score IS NOT NULL GROUP BY 1, 2, 3)"""
TEMPLATES = RUNS + "," + PROMPT_DIM + """,
templates AS (
  SELECT p.prompt_hash, p.prompt_text, count(*) AS uses, avg(r.success_score) AS avg_success,
    quantile_cont(r.success_score, 0.5) AS median_success
  FROM run_prompts r JOIN prompt_dim p USING (prompt_hash) WHERE r.success_score IS NOT NULL GROUP BY 1, 2)"""
EFFICIENCY = RUNS + """,
efficiency AS (
  SELECT model_name, avg(latency) AS avg_latency, avg(tokens + coalesce(response_tokens, 0)) AS avg_tokens,
    avg(tokens) AS avg_tokens_once, avg(success_score) AS avg_success_score, count(*) AS execution_count,
    count(latency) AS latency_samples, count(success_score) AS success_samples
  FROM runs WHERE model_name IS NOT NULL GROUP BY 1)"""

R = 9  # decimals to which averages of inexact numbers are compared

COMBO_ID = (
    "concat_ws('_', CASE WHEN contains_examples THEN 'EX' ELSE 'NE' END, CASE WHEN contains_code THEN 'CO' ELSE 'NC' END, "
    "CASE WHEN contains_constraints THEN 'CT' ELSE 'NT' END)"
)
COMBO_LABEL = (
    "coalesce(nullif(concat_ws(' + ', CASE WHEN contains_examples THEN 'examples' END, CASE WHEN contains_code THEN 'code' END, "
    "CASE WHEN contains_constraints THEN 'constraints' END), ''), 'no features')"
)
FEATURE_BOARD = IMPACT + f""",
feature_board AS (
  SELECT contains_examples, contains_code, contains_constraints, cnt AS sample_count, avg_success, median_success,
    {COMBO_ID} AS feature_combination_id, {COMBO_LABEL} AS combination,
    CASE WHEN CAST(contains_examples AS INT) + CAST(contains_code AS INT) + CAST(contains_constraints AS INT) = 0 THEN 'BASELINE'
      ELSE (CAST(contains_examples AS INT) + CAST(contains_code AS INT) + CAST(contains_constraints AS INT)) || ' FEAT' END AS active_label,
    CAST(row_number() OVER (ORDER BY avg_success DESC, cnt DESC, contains_examples, contains_code, contains_constraints) AS INTEGER) AS position
  FROM impact WHERE cnt >= 10 ORDER BY position LIMIT 8)"""
MODEL_BOARD = """,
model_board AS (
  SELECT *, CAST(row_number() OVER (ORDER BY avg_success DESC, model_name) AS INTEGER) AS rank,
    round(avg_success * 100, 2) AS success_rate_pct
  FROM arena_rollup ORDER BY rank LIMIT 10)"""
LANGUAGE_BOARD = """,
language_board AS (
  SELECT programming_lang AS programming_language, prompts AS total_prompts, success_rate, median_success,
    CASE WHEN success_rate >= 0.75 THEN 'easy' WHEN success_rate >= 0.5 THEN 'medium' ELSE 'hard' END AS difficulty_level,
    CAST(row_number() OVER (ORDER BY success_rate DESC, programming_lang) AS INTEGER) AS position
  FROM language_rollup ORDER BY position LIMIT 20)"""

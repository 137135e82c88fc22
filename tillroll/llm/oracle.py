"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from tillroll.llm.quality import RULES, STOP_WORDS

_QUALITY = r"""
WITH parts AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT r, unnest(range(1, len(words) - 1)) AS place, words FROM parts WHERE len(words) >= 3
), keyed AS (
  SELECT r, place, words[place] || ' ' || words[place + 1] || ' ' || words[place + 2] AS w FROM windows
), repeated AS (
  SELECT r, place FROM keyed QUALIFY count(*) OVER (PARTITION BY r, w) > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM
    (SELECT r, unnest([place, place + 1, place + 2]) AS p FROM repeated) GROUP BY r
), counted AS (
  SELECT doc_id, len(words) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words,
         len(list_filter(words, lambda w: list_contains([{stop}], rtrim(lower(w), '.,;:!?')))) AS n_stop_words,
         len(list_filter(words, lambda w: NOT regexp_matches(w, '[\p{{L}}\p{{N}}]'))) AS n_wordless,
         len(lines) AS n_lines,
         len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines
  FROM parts LEFT JOIN covered USING (r)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT base_failed AND {rules} AS kept
FROM counted
"""

_LINES = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM documents WHERE text IS NOT NULL
), windows AS (
  SELECT doc_id, place, line,
         lead(line) OVER d AS second, lead(line, 2) OVER d AS third
  FROM lines WINDOW d AS (PARTITION BY doc_id ORDER BY place)
), later AS (
  SELECT doc_id, place FROM windows
  WHERE third IS NOT NULL AND regexp_matches(line || second || third, '[^\x20\x09-\x0D]')
  QUALIFY row_number() OVER (PARTITION BY line, second, third ORDER BY doc_id, place) > 1
), covered AS (
  SELECT DISTINCT doc_id, unnest([place, place + 1, place + 2]) AS place FROM later
), cut AS (
  SELECT doc_id, count(covered.place) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY lines.place) FILTER (covered.place IS NULL), '') AS kept
  FROM lines LEFT JOIN covered USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_removed, 0) AS n_removed, kept AS text
FROM documents LEFT JOIN cut USING (doc_id)
"""

_CHAT = r"""
WITH said AS (
  -- Every row is a turn. The mark's opening is doubled in texts and names, so neither can look like a mark.
  SELECT conv_id, turn, role AS speaker, coalesce(text, '') AS text, replace(coalesce(text, ''), '<|', '<||') AS shown,
         replace(replace(role, '<|', '<||'), chr(10), ' ') AS name
  FROM conversations
), people AS (
  SELECT DISTINCT conv_id, speaker AS participant FROM said
), rows AS (
  SELECT said.conv_id, participant, coalesce(floor(turn / 64), -1)::BIGINT AS block, turn, speaker, text,
         speaker IS NOT DISTINCT FROM participant AS own,
         CASE WHEN own THEN '<|assistant|>' || chr(10) ELSE '<|user|>' || coalesce(' ' || name, '') || chr(10) END AS head,
         shown || '<|end|>' || chr(10) AS body
  FROM said JOIN people ON said.conv_id IS NOT DISTINCT FROM people.conv_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, participant, block
                               ORDER BY turn NULLS FIRST, speaker NULLS FIRST, text) AS n
  FROM rows
), placed AS (
  SELECT *, (n - 1) // 64 AS part,
         sum(length(head || body)) OVER (PARTITION BY conv_id, participant, block, (n - 1) // 64 ORDER BY n)::BIGINT AS stop
  FROM ranked
)
SELECT conv_id, participant, block, part, count(*) AS n_turns,
       string_agg(head || body, '' ORDER BY n) AS rendered,
       coalesce(string_agg((stop - length(body)) || ':' || stop, ',' ORDER BY n) FILTER (own), '') AS masks
FROM placed GROUP BY conv_id, participant, block, part
"""

_TRIE = r"""
WITH bits AS (
  -- CRC-32 of the decimal id: start value, then per byte the byte itself and eight shifts (-1).
  SELECT DISTINCT conv_id, flatten([[4294967295]] || list_transform(range(1, len(conv_id::VARCHAR) + 1),
           lambda i: [ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])) AS steps
  FROM conversations WHERE conv_id IS NOT NULL
), heads AS (
  SELECT conv_id, conv_id - conv_id % 5 AS lender,
         xor(list_reduce(steps, lambda a, x: CASE WHEN x >= 0 THEN xor(a, x)
           WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295) % 9 AS h
  FROM bits
), said AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL
), rebuilt AS (
  SELECT heads.conv_id, 0 AS own, n, role, text FROM heads JOIN said ON said.conv_id = lender AND n <= h
  UNION ALL SELECT conv_id, 1, n, role, text FROM heads JOIN said USING (conv_id) WHERE n > h
), prefixes AS (
  SELECT conv_id, row_number() OVER w AS depth, list({'role': role, 'text': text}) OVER w AS path, strlen(text) AS bytes
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, n ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, [], 0 FROM heads
), ended AS (
  SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM prefixes
), nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved,
         bool_and(last)::BIGINT AS leaf,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM ended GROUP BY path, depth
), totals AS (
  SELECT above.path, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM nodes JOIN prefixes AS above ON above.conv_id = nodes.conv_id AND above.depth <= nodes.depth GROUP BY above.path
), families AS (
  SELECT parent.path, any_value(parent.conv_id) AS conv_id, count(*) AS n_children
  FROM nodes JOIN nodes AS parent ON parent.depth = nodes.depth - 1 AND parent.path = nodes.path[:nodes.depth - 1]
  GROUP BY parent.path
)
SELECT nodes.conv_id, nodes.depth, parent.conv_id AS parent_conv_id, nodes.n_convs,
       coalesce(families.n_children, 0) AS n_children, n_leaves, saved_tokens, nodes.ends_sha256
FROM nodes JOIN totals ON totals.path = nodes.path LEFT JOIN families ON families.path = nodes.path
LEFT JOIN nodes AS parent ON nodes.depth > 0 AND parent.depth = nodes.depth - 1 AND parent.path = nodes.path[:nodes.depth - 1]
"""

_AUDIT = r"""
WITH marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         {'A': len(words) < 200,
           'B': 100 * len(list_distinct(words)) < 50 * len(words),
           'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
           'D': regexp_matches(text, '[#$%&*|]'),
           'E': coalesce(texts.doc_id > min(texts.doc_id) OVER (PARTITION BY text), false)} AS fails
  FROM texts LEFT JOIN marks ON texts.doc_id = marks.doc_id
), failed AS (
  SELECT part, good, toxic,
         concat(CASE WHEN fails.A THEN 'A' END, CASE WHEN fails.B THEN 'B' END, CASE WHEN fails.C THEN 'C' END,
                CASE WHEN fails.D THEN 'D' END, CASE WHEN fails.E THEN 'E' END) AS failed
  FROM judged
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps AS (
  SELECT filter_order, step, filter_order[step] AS own, filter_order[1:step - 1] AS before
  FROM orders, (SELECT unnest(range(1, 6))::INTEGER AS step)
), sets AS (
  SELECT part, failed, count(*) AS n, count_if(good) AS n_good, count_if(toxic) AS n_toxic
  FROM failed GROUP BY part, failed
), counted AS (
  SELECT part, filter_order, step, own, sets.*,
         contains(failed, own) AS fails, translate(failed, before, '') <> failed AS gone
  FROM sets CROSS JOIN steps
), result AS (
  SELECT part, filter_order, step, any_value(own) AS own,
         coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (failed = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(n_good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost,
         coalesce(sum(n_toxic) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM counted GROUP BY part, filter_order, step
)
SELECT * EXCLUDE (own), sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM result
"""


def _rule(rule) -> str:
    whole = rule.whole or "1"
    low = [] if rule.low is None else [f"{rule.part} >= {whole} * {rule.low!r}::DOUBLE"]
    high = [] if rule.high is None else [f"{rule.part} <= {whole} * {rule.high!r}::DOUBLE"]
    return " AND ".join(low + high)


def oracles() -> dict[str, str]:
    stop = ", ".join(f"'{word}'" for word in STOP_WORDS)
    rules = " AND ".join(_rule(rule) for rule in RULES)
    return {
        "op1_quality_rules": _QUALITY.format(stop=stop, rules=rules),
        "op3_chat_rotation": _CHAT,
        "op10_line_dedup": _LINES,
        "op12_prefix_trie": _TRIE,
        "op13_filter_audit": _AUDIT,
    }

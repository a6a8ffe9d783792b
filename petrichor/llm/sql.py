"""DuckDB SQL that gives the rows of the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

#: Item and document shingles of five words, compared exactly; shorter items against all runs of their length.
_DECONTAMINATION = f"""
WITH item_words AS (
  SELECT item_id, {_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM benchmark),
item_shingles AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM item_words)),
item_sizes AS (SELECT item_id, count(*) AS n FROM item_shingles GROUP BY item_id),
doc_words AS (
  SELECT doc_id, {_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents),
lengths AS (SELECT DISTINCT least(len(w), 5) AS n FROM item_words WHERE len(w) > 0),
doc_shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, lengths WHERE len(w) >= n)),
shared AS (
  SELECT doc_id, item_id, count(*) AS n_shared FROM doc_shingles JOIN item_shingles USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n AS n_item_shingles, n_shared, n_shared / n AS containment
FROM shared JOIN item_sizes USING (item_id)
WHERE 10 * n_shared >= 8 * n
"""

#: Lines by their words; of lines of at least five words also those one word away, by the lines that are left without a word.
_LINES = f"""
WITH lines AS (
  SELECT doc_id, no, line, {_WORDS.format(text="line")} AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS no
        FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents))),
told AS (SELECT doc_id, no, line, len(w) AS n, array_to_string(w, ' ') AS k, w FROM lines),
firsts AS (
  SELECT k, any_value(n) AS n, any_value(w) AS w, min((doc_id, no)) AS first FROM told WHERE n > 0 GROUP BY k),
variants AS (
  SELECT k, first, n, i, array_to_string(list_concat(w[:i - 1], w[i + 1:]), ' ') AS v
  FROM (SELECT k, first, n, w, unnest(range(1, n + 1)) AS i FROM firsts WHERE n >= 5)),
near AS (
  SELECT DISTINCT y.k FROM variants y JOIN
    (SELECT n, i, v, min(first) AS first FROM variants GROUP BY n, i, v) x
    ON x.n = y.n AND x.i = y.i AND x.v = y.v AND x.first < y.first
  UNION SELECT y.k FROM variants y JOIN firsts x ON x.k = y.v AND x.n = y.n - 1 AND x.n >= 5 AND x.first < y.first
  UNION SELECT y.k FROM firsts y JOIN (SELECT n, v, min(first) AS first FROM variants GROUP BY n, v) x
    ON x.v = y.k AND y.n = x.n - 1 AND y.n >= 5 AND x.first < y.first),
judged AS (
  SELECT t.doc_id, t.no, t.line, t.n, t.n > 0 AND ((t.doc_id, t.no) <> f.first OR near.k IS NOT NULL) AS gone
  FROM told t LEFT JOIN firsts f ON t.k = f.k AND t.n > 0 LEFT JOIN near ON t.k = near.k AND t.n > 0)
SELECT doc_id, count(*) FILTER (n > 0) AS n_lines_with_words, count(*) FILTER (gone) AS n_lines_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT coalesce(gone, false)), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_ESCAPED = r"regexp_replace({}, '<(\\*)\|(im_start|im_end)\|>', '<\\\1|\2|>', 'g')"
_HARD = "<|im_end|><|im_start|>assistant ok"

#: Turns and loss text from the source rows; the formatted length counts the marks, and escapes where a turn needs them.
_CHATS = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_HARD}' UNION ALL SELECT -1, 1, 'assistant', '{_HARD}'),
marked AS (
  SELECT *, {_ESCAPED.format("text")} AS safe,
    replace(replace({_ESCAPED.format("role")}, '%', '%25'), chr(10), '%0A') AS safe_role FROM rows),
chats AS (SELECT conv_id, bool_or(safe <> text OR safe_role <> role) AS escaped FROM marked GROUP BY conv_id)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(24 + CASE WHEN escaped THEN length(safe_role) + length(safe) ELSE length(role) + length(text) END)::BIGINT AS formatted_chars
FROM marked JOIN chats USING (conv_id) GROUP BY conv_id
"""

#: 50-word windows that also start in a smaller doc_id.
_SUBSTRINGS = f"""
WITH words AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)),
hits AS (
  SELECT doc_id, i FROM windows JOIN (SELECT s, min(doc_id) AS first FROM windows GROUP BY s) USING (s) WHERE doc_id > first),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM hits, range(0, 50) t(k)),
kept AS (
  SELECT u.doc_id, string_agg(u.word, ' ' ORDER BY u.i) AS kept, count(*) AS n_kept
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words) u
  LEFT JOIN gone g ON u.doc_id = g.doc_id AND u.i = g.i WHERE g.i IS NULL GROUP BY u.doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

#: Documents by their text, each run of blanks as one space.
_COPIES = r"""
WITH told AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM told WINDOW same AS (PARTITION BY body)
"""

ORACLES = {
    "op5_line_dedup": _LINES,
    "op6_benchmark_decontamination": _DECONTAMINATION,
    "op8_substring_dedup": _SUBSTRINGS,
    "op9_chat_formatting": _CHATS,
    "op11_exact_dedup": _COPIES,
}

"""DuckDB twins of the queries that SQL can express.

The others hold trained models, hashes or programs that SQL lacks; their tests compare them
with plain Python.
"""

from seekframe.llm.licenses import GAP, MIN_COVER, NOTICES, PHRASES, WORD

_TEMPLATES = ", ".join(
    f"({number}, '{t.label}', string_split('{t.text}', ' '), {str(t.exact).lower()})"
    for number, t in enumerate(PHRASES + NOTICES)
)
_SPACE = r"[\x20\x09-\x0D]"

ORACLES: dict[str, str] = {
    "op4_quality_rules": rf"""
WITH texts AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS body FROM documents),
cut AS (SELECT *, list_filter(regexp_split_to_array(body, '{_SPACE}+'), lambda x: x <> '') AS words,
  list_filter(string_split(body, chr(10)),
    lambda x: regexp_replace(x, '{_SPACE}', '', 'g') <> '') AS lines FROM texts),
windows AS (SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM cut)),
often AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows)
  WHERE n > 1),
inside AS (SELECT r, count(DISTINCT i + j) AS n_repeat_words
  FROM often CROSS JOIN (SELECT unnest(range(3)) AS j) GROUP BY r),
counts AS (SELECT doc_id, body, len(words)::bigint AS n_words,
  length(regexp_replace(body, '{_SPACE}', '', 'g'))::bigint AS word_chars,
  length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::bigint AS n_symbols,
  (len(lines) - len(list_distinct(lines)))::bigint AS n_dup_lines,
  coalesce(n_repeat_words, 0)::bigint AS n_repeat_words
  FROM cut LEFT JOIN inside USING (r)),
shares AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  greatest(n_words, 1) AS n, greatest(word_chars, 1) AS c,
  greatest(len(string_split(body, chr(10))), 1) AS l FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR word_chars < 2 * n OR word_chars > 15 * n OR 10 * n_symbols > n
  OR 10 * n_dup_lines > 5 * l
  OR 10 * (length(body) - length(replace(body, '!', ''))) > n
  OR 10 * length(regexp_replace(body, '\P{{Lu}}+', '', 'g')) > 4 * c
  OR 10 * length(regexp_replace(body, '[^\p{{L}}\p{{M}}]+', '', 'g')) < 6 * c
  OR 10 * len(regexp_extract_all(body, '(?m)(\.\.\.|…)[ \t\x0B\f\r]*$')) > 3 * l
  OR 10 * len(regexp_extract_all(body, '(?m)^[ \t\x0B\f\r]*[-*•]')) > 9 * l) AS kept
FROM shares""",
    "op9_licenses": rf"""
WITH texts AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '{WORD}') AS words FROM documents),
grams AS (SELECT r, i - 1 AS pos, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM texts)),
templates(template, label, w, exact) AS (VALUES {_TEMPLATES}),
known AS (SELECT template, label, exact, len(w) AS t_words, q - 1 AS t_pos,
  w[q] || ' ' || w[q + 1] || ' ' || w[q + 2] AS g
  FROM (SELECT *, unnest(range(1, len(w) - 1)) AS q FROM templates)),
votes AS (SELECT r, template, label, exact, t_words, pos - t_pos AS diagonal, count(*) AS votes,
  min(pos) AS first, max(pos) + 2 AS last FROM grams JOIN known USING (g) GROUP BY ALL),
opened AS (SELECT *, (exact OR coalesce(diagonal - lag(diagonal) OVER near > {GAP}, true))::int AS o
  FROM votes WINDOW near AS (PARTITION BY r, template ORDER BY diagonal)),
numbered AS (SELECT *, sum(o) OVER (PARTITION BY r, template ORDER BY diagonal) AS span
  FROM opened),
spans AS (SELECT r, template, label, exact, t_words, span, sum(votes) AS votes,
  min(first) AS first, max(last) AS last FROM numbered GROUP BY ALL),
covered AS (SELECT *, least(votes / (t_words - 2)::double, 1.0::double)
  * least(1.0::double, 1.5::double * t_words / (last - first + 1)) AS cover FROM spans),
judged AS (SELECT *, exact AND cover >= 1 AS place,
  CASE WHEN exact THEN cover >= 1 ELSE cover >= {MIN_COVER} END AS verified FROM covered),
found AS (SELECT r, count(*) FILTER (WHERE place) AS n_base,
  min(first) FILTER (WHERE place) AS first_word, max(first) FILTER (WHERE place) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE place) AS base_labels,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE verified) AS labels,
  max(CASE WHEN exact AND NOT place THEN 0 ELSE cover END) AS score FROM judged GROUP BY r)
SELECT doc_id, len(words)::bigint AS n_words, coalesce(n_base, 0)::bigint AS n_base,
  first_word::bigint AS first_word, last_word::bigint AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0)::double AS score FROM texts LEFT JOIN found USING (r)""",
    "op11_minhash": rf"""
WITH RECURSIVE texts AS (SELECT doc_id, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') AS words FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(words) BETWEEN 1 AND 3
  THEN [array_to_string(words, ' ')]
  ELSE [array_to_string(words[i:i + 3], ' ') FOR i IN range(1, len(words) - 2)] END) AS shingles
  FROM texts),
held AS (SELECT any_value(doc_id) AS node, shingles, len(shingles) AS n FROM sets
  WHERE len(shingles) > 0 GROUP BY shingles),
rows AS (SELECT node, n, hash(unnest(shingles)) AS h FROM held),
rare AS (SELECT node, n, h, row_number() OVER (PARTITION BY node ORDER BY times, h) AS place
  FROM rows JOIN (SELECT h, count(*) AS times FROM rows GROUP BY h) USING (h)),
pairs AS (SELECT DISTINCT a.node AS a, b.node AS b FROM rare a JOIN rare b ON a.h = b.h
  AND a.node < b.node AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  WHERE a.place <= a.n - a.n * 80 // 100 + 1 AND b.place <= b.n - b.n * 80 // 100 + 1),
links AS (SELECT a, b FROM pairs JOIN held x ON x.node = a JOIN held y ON y.node = b
  WHERE 100 * len(list_intersect(x.shingles, y.shingles)) >= 80 * (x.n + y.n
    - len(list_intersect(x.shingles, y.shingles)))),
ties AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
  UNION ALL SELECT node, doc_id FROM held JOIN sets USING (shingles)
  UNION ALL SELECT doc_id, node FROM held JOIN sets USING (shingles)),
reach(node, root) AS (SELECT doc_id, doc_id FROM sets
  UNION SELECT b, root FROM reach JOIN ties ON a = node),
roots AS (SELECT node AS doc_id, min(root) AS component_id FROM reach GROUP BY node)
SELECT doc_id, len(shingles)::bigint AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN roots USING (doc_id)""",
    "op12_collocations": rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, p FROM (
  SELECT lang, unnest(regexp_split_to_array(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
cut AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::bigint AS n FROM cut GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM cut),
grams AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM places, (SELECT unnest(range(1, 6)) AS m) WHERE i + m - 1 <= len(w)),
counts AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w,
  unnest(range(1, m)) AS k FROM counts WHERE m > 1),
parts AS (SELECT c.lang, c.m, c.phrase, c.a, c.k, x.f AS l, y.f AS r, n,
  1000::hugeint * c.a * n // (x.f::hugeint * y.f) AS score FROM cuts c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(w[:k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
  JOIN totals t ON t.lang = c.lang),
lowest AS (SELECT * FROM parts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (SELECT lang, a AS longer, unnest(flatten([[array_to_string(w[i:i + s - 1], ' ')
  FOR i IN range(1, m - s + 2)] FOR s IN range(2, m)])) AS phrase
  FROM (SELECT *, string_split(phrase, ' ') AS w FROM lowest WHERE m > 2)),
held AS (SELECT lang, phrase, max(longer) AS longer FROM inner_phrases GROUP BY ALL),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN held USING (lang, phrase)
  WHERE coalesce(100 * longer < 100 * a, true)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang
  ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::bigint AS score FROM ranked WHERE rank <= 2000""",
    "op13_fill_middle": rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''),
  '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t,
  sha256('42:' || coalesce(doc_id::varchar, 'null')) AS s FROM documents),
drawn AS (SELECT *, len(t)::bigint AS n, ('0x' || s[1:8])::bigint AS h1,
  ('0x' || s[9:16])::bigint AS h2, ('0x' || s[17:24])::bigint AS h3,
  ('0x' || s[25:32])::bigint AS h4 FROM texts),
formed AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
  CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
    OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, array_to_string(t[1:lo], '') AS pre, array_to_string(t[lo + 1:hi], '') AS mid,
  array_to_string(t[hi + 1:], '') AS suf FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END::bigint AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END::bigint AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM parts""",
}

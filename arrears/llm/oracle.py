"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_ASSIGN = (
    "(" + "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
    r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)

ORACLE = {
    "op1_decontaminate": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
passages AS (
  SELECT DISTINCT item_id, CAST(least(13, len(w)) AS BIGINT) AS n, array_to_string(w[p:p + least(13, len(w)) - 1], ' ') AS g
  FROM i, unnest(range(1, greatest(2, len(w) - 11))) AS u(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM passages),
starts AS (
  SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT r, p, n, item_id FROM starts JOIN passages USING (n, g)),
per_word AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hits) GROUP BY r),
per_item AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN per_word USING (r) LEFT JOIN per_item USING (r)""",
    "op2_jaccard_join": f"""
WITH RECURSIVE d AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, {_WORDS} AS w FROM documents),
grams AS MATERIALIZED (
  SELECT DISTINCT r, array_to_string(w[p:p + least(5, len(w)) - 1], ' ') AS g
  FROM d, unnest(range(1, greatest(2, len(w) - 3))) AS u(p) WHERE len(w) > 0),
sizes AS (SELECT r, count(*) AS n FROM grams GROUP BY r),
shared AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM grams a JOIN grams b USING (g) WHERE a.r <> b.r GROUP BY ALL),
links AS MATERIALIZED (
  SELECT x, y FROM shared JOIN sizes sx ON sx.r = x JOIN sizes sy ON sy.r = y WHERE 5 * c >= 4 * (sx.n + sy.n - c)),
reach AS (SELECT r, r AS o FROM d UNION SELECT reach.r, y FROM reach JOIN links ON x = o),
classes AS (SELECT r, min(o) AS c FROM reach GROUP BY r),
partners AS (SELECT x AS r, count(*) AS n FROM links GROUP BY x)
SELECT d.doc_id, first_value(d.doc_id) OVER best AS class_id, count(*) OVER (PARTITION BY c) AS class_size,
  coalesce(n, 0) AS n_links, row_number() OVER best = 1 AS kept
FROM d JOIN classes USING (r) LEFT JOIN partners USING (r)
WINDOW best AS (PARTITION BY c ORDER BY d.doc_id)""",
    "op5_chat": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
c AS (
  SELECT *, len(regexp_extract_all(role || text, '\\|<\|\w{1,40}\|>|</?s>|<</?SYS>>|\[/?INST\]')) AS n FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(role) + length(text) + n + 24) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id""",
    "op8_warc": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest, sha256(coalesce(html, '')) AS content
  FROM pages),
m AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY content) END AS best FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN best <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN best <> page_id THEN best END AS refers_to
FROM m""",
    "op9_exact_dedup": """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER best = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW best AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST)""",
    # The given pages hold their article in one element; the operator does not go by that alone.
    "op11_html_text": r"""
WITH a AS (
  SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '</?b>|<br>', '', 'g') AS h
  FROM pages),
b AS (SELECT page_id, url, unnest(string_split_regex(h, '</?(?:p|h1)>')) AS t, generate_subscripts(string_split_regex(h, '</?(?:p|h1)>'), 1) AS i FROM a),
c AS (
  SELECT page_id, url, i,
    trim(regexp_replace(replace(replace(regexp_replace(t, '&quot;?', '"', 'g'), '&amp;', '&'), '&amp', '&'), '\s+', ' ', 'g')) AS t
  FROM b)
SELECT page_id, url, coalesce(string_agg(t, chr(10) ORDER BY i) FILTER (t <> ''), '') AS text,
  CAST(length(coalesce(string_agg(t, chr(10) ORDER BY i) FILTER (t <> ''), '')) AS BIGINT) AS n_chars
FROM c GROUP BY page_id, url""",
    "op12_divergence": f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
t AS MATERIALIZED (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 3),
sizes AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
totals AS (
  SELECT lang, source, coalesce(sum(c.n), 0) AS total FROM groups LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS MATERIALIZED (
  SELECT lang, source, term, coalesce(c.n, 0) AS n,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1)) // (total + v) AS p
  FROM totals JOIN sizes USING (lang) JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (kept.n + 1)) // (sizes.n + v) AS q FROM kept JOIN sizes USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
all_pairs AS (
  SELECT a.lang, a.source, b.source AS item FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source),
found AS (
  SELECT lang, source, 'pair' AS part, item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM all_pairs LEFT JOIN pairs USING (lang, source, item)
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 200""",
    "op13_interaction": r"""
WITH l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
  FROM d LEFT JOIN l USING (doc_id)),
n AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM m GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, s AS step, filter_order[s] AS own, filter_order[1:s - 1] AS before FROM orders, unnest(range(1, 6)) AS u(s)),
r AS (
  SELECT *, contains(fails, own) AS failed, translate(fails, before, '') <> fails AS gone FROM n, steps)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
  CAST(coalesce(sum(n) FILTER (NOT gone AND NOT failed), 0) AS BIGINT) AS kept,
  CAST(coalesce(sum(n) FILTER (failed AND NOT gone), 0) AS BIGINT) AS removed,
  CAST(coalesce(sum(n) FILTER (failed AND gone), 0) AS BIGINT) AS redundant,
  CAST(coalesce(sum(n) FILTER (fails = own), 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(sum(n_good) FILTER (failed AND NOT gone), 0) AS BIGINT) AS good_lost,
  CAST(coalesce(sum(n_toxic) FILTER (failed AND NOT gone), 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(n * 120 // greatest(len(fails), 1)) FILTER (failed), 0) AS BIGINT) AS shapley
FROM r GROUP BY part, filter_order, step""",
    "url_rules": f"""
WITH r AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS own FROM r),
p AS (SELECT page_id, translate(own, '{_UPPER}', '{_LOWER}') AS host, regexp_extract(substring(rest, length(own) + 1), '^[^?#]*') AS path FROM h),
rules(rule, rule_verdict) AS (VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'), ('org/fr/', 'allow')),
parts AS (SELECT *, split_part(rule, '/', 1) AS rule_host, substring(rule, strpos(rule, '/')) AS rule_path FROM rules),
fits AS (
  SELECT page_id, host, path, rule, rule_verdict,
    row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rule) DESC) AS place
  FROM p LEFT JOIN parts ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, rule_verdict FROM fits WHERE place = 1""",
    "base_scores": f"""
WITH steps AS (
  SELECT list_transform(range(0, 256), lambda x: list_reduce(list_concat([x], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))) AS crc),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
    xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) % 10 = 0 AS held_out,
    list_append(list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'),
                            lambda w: w <> ''), ' end') AS w
  FROM documents, steps),
t AS MATERIALIZED (SELECT r, held_out, unnest(w) AS w FROM d),
c AS (SELECT w, count(*) AS c FROM t WHERE NOT held_out GROUP BY w),
size AS (SELECT sum(c) AS n, count(*) AS v FROM c),
s AS (
  SELECT r, count(c) AS n_known, sum(log10((coalesce(c, 0) + 0.1E0) / (n + 0.1E0 * (v + 1)))) AS base_score
  FROM t LEFT JOIN c USING (w) CROSS JOIN size GROUP BY r)
SELECT doc_id, held_out, CAST(len(w) AS BIGINT) AS n_tokens, n_known, CAST((SELECT n FROM size) AS BIGINT) AS train_tokens,
  round(base_score, 3) AS base_score
FROM d JOIN s USING (r)""",
    "secret_counts": f"""
SELECT doc_id,
  CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '{_ASSIGN}', 2), lambda x: length(x) >= 6)) AS BIGINT) AS n_assign,
  CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 20)) AS BIGINT) AS n_access,
  CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: length(x) >= 24)) AS BIGINT) AS n_hex
FROM documents""",
}

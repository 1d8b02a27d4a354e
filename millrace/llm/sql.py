"""DuckDB SQL for the corpus queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), frequent AS (
  SELECT k AS f FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines,
       count(f)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent ON k = f GROUP BY doc_id
"""

DECONTAMINATION = r"""
WITH d AS (SELECT doc_id AS k, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT item_id AS k, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM benchmark),
bs AS (SELECT DISTINCT k, least(len(w), 5) AS z, unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda i: array_to_string(w[i:i+least(len(w), 5)-1], ' '))) AS s FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT z FROM bs),
ds AS (SELECT DISTINCT k, z, unnest(list_transform(range(1, len(w) - z + 2), lambda i: array_to_string(w[i:i+z-1], ' '))) AS s FROM d, sizes WHERE len(w) >= z),
n AS (SELECT k, count(*) AS q FROM bs GROUP BY 1)
SELECT ds.k AS doc_id, bs.k AS item_id, q AS n_item_shingles, count(*) AS n_common, count(*) / q AS containment
FROM ds JOIN bs ON ds.s = bs.s AND ds.z = bs.z JOIN n ON n.k = bs.k GROUP BY 1, 2, 3 HAVING count(*) / q >= 0.8
"""

QUALITY = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS p, w FROM t WHERE len(w) > 3),
grams AS (SELECT doc_id, p, w[p] AS a, w[p + 1] AS b, w[p + 2] AS c FROM win),
twice AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM grams) WHERE n > 1),
again AS (SELECT doc_id, count(DISTINCT p + i) AS n FROM twice, range(3) r(i) GROUP BY 1),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM t),
trimmed AS (SELECT doc_id, l, lower(trim(translate(l, chr(9) || chr(11) || chr(12) || chr(13), '    '))) AS x, regexp_matches(l, '[^\x20\x09-\x0D]') AS f FROM lines),
counted AS (SELECT *, len(regexp_split_to_array(x, ' +')) AS n, length(x) - length(translate(x, '{{symbols}}', '')) AS sy, length(x) - length(replace(x, '!!', '!')) AS bangs,
                   length(x) - length(replace(x, '|', '')) AS bars FROM trimmed),
judged AS (SELECT *, x <> '' AND ((n <= 40 AND regexp_matches(x, '{{boilerplate}}')) OR regexp_matches(x, '{{navigation}}') OR (2 * bars >= n AND n > 3)
                  OR NOT regexp_matches(x, '{{ends}}') OR (2 * sy > n AND n > 3) OR 3 * bangs > n) AS bad FROM counted),
per AS (SELECT doc_id, count(*) FILTER (WHERE f) AS n_lines, count(*) FILTER (WHERE f) - count(DISTINCT l) FILTER (WHERE f) AS dup, count(*) FILTER (WHERE bad) AS n_failed,
               coalesce(sum(length(l)) FILTER (WHERE f), 0) AS al, coalesce(sum(length(l)) FILTER (WHERE bad), 0) AS lost FROM judged GROUP BY 1),
base AS (SELECT t.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, (length(text) - length(translate(text, '{{symbols}}', '')))::BIGINT AS n_symbols,
                coalesce(again.n, 0)::BIGINT AS n_repeat_words FROM t LEFT JOIN again USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, dup AS n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       n_lines, n_failed AS n_failed_lines, (lost / greatest(al, 1))::DOUBLE AS lost_share,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost / greatest(al, 1) <= 0.5 AS kept
FROM base JOIN per USING (doc_id)
"""

WARC = r"""
WITH h AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS x FROM pages),
firsts AS (SELECT x, min(page_id) AS f FROM h GROUP BY 1)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s:
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((('0x' || substr(x, (5 * i + 1)::INT, 5))::INT >> s) & 31) + 1]), '')), '') AS payload_digest,
       CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> f THEN f END AS refers_to, NULL::VARCHAR AS problem
FROM h JOIN firsts USING (x)
"""

CHAT = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, len(regexp_extract_all(role, '\\|###|</turn>|: ')) + len(regexp_extract_all(text, '\\|###|</turn>|: ')) AS marks FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length(role) + length(text) + marks + 14)::BIGINT AS formatted_chars
FROM e GROUP BY 1
"""

PASSAGES = rf"""
WITH t AS (SELECT doc_id, {WORDS} AS w FROM documents),
win AS (SELECT doc_id, p, array_to_string(w[p : p + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM t WHERE len(w) >= 13)),
firsts AS (SELECT s, min(doc_id) AS f FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, p + i AS p FROM win JOIN firsts USING (s), range(13) r(i) WHERE f < doc_id),
spans AS (SELECT doc_id, count(*) AS n FROM gone a WHERE NOT EXISTS (SELECT 1 FROM gone b WHERE b.doc_id = a.doc_id AND b.p = a.p - 1) GROUP BY 1),
each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM t),
made AS (SELECT doc_id, count(*) AS n_words, count(g.p) AS n_removed, string_agg(word, ' ' ORDER BY each.p) FILTER (WHERE g.p IS NULL) AS kept
         FROM each LEFT JOIN gone g USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256, coalesce(spans.n, 0)::BIGINT AS n_spans
FROM t LEFT JOIN made USING (doc_id) LEFT JOIN spans USING (doc_id)
"""

RANKED_SEARCH = r"""
WITH t AS (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
w AS (SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM t),
q AS (SELECT DISTINCT id AS item_id, unnest(terms) AS term FROM w WHERE side = 'i'),
d AS (SELECT id AS doc_id, len(terms)::BIGINT AS n, terms FROM w WHERE side = 'd' AND len(terms) > 0),
g AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS nt FROM d),
tf AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM tf, g GROUP BY term, nd),
scored AS (SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // nt))))::BIGINT AS score
           FROM q JOIN tf USING (term) JOIN df USING (term), g GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def _quality() -> str:
    from . import quality

    quoted = {"symbols": quality.SYMBOLS, "boilerplate": quality.BOILERPLATE, "navigation": quality.NAVIGATION, "ends": quality.ENDS}
    made = QUALITY
    for name, text in quoted.items():
        made = made.replace("{" + name + "}", text.replace("'", "''"))
    return made


ORACLE_SQL = {"op2_decontamination": DECONTAMINATION, "op3_quality": _quality(), "op5_warc": WARC, "op6_line_dedup": LINE_DEDUP, "op9_chat_format": CHAT, "op11_passage_dedup": PASSAGES, "op12_ranked_search": RANKED_SEARCH}

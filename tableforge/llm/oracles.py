"""SQL that gives the same rows as those corpus queries that SQL can express."""

_WS = r"[ \t\n\x0B\x0C\r]"
_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOW = f"translate({{}}, '{_UPPER}', '{_SMALL}')"

LINE_RULES = rf"""WITH d AS (SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS t, coalesce('h' || source, '') AS h FROM documents),
w AS (SELECT uid, unnest(regexp_extract_all(t, '[^ \t\n\x0B\x0C\r]+')) AS w, generate_subscripts(regexp_extract_all(t, '[^ \t\n\x0B\x0C\r]+'), 1) AS i FROM d),
g AS (SELECT uid, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o AS g FROM w WINDOW o AS (PARTITION BY uid ORDER BY i)),
r AS (SELECT uid, i FROM (SELECT *, count(*) OVER (PARTITION BY uid, g) AS c FROM g WHERE g IS NOT NULL) WHERE c > 1),
twice AS (SELECT uid, count(DISTINCT i + k) AS n FROM r CROSS JOIN range(5) AS x(k) GROUP BY 1),
nw AS (SELECT uid, count(*) AS n FROM w GROUP BY 1),
l AS (SELECT uid, h, x FROM (SELECT uid, h, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^ \t\n\x0B\x0C\r]')),
dup AS (SELECT uid, count(*) - count(DISTINCT x) AS n FROM l GROUP BY 1),
k AS (SELECT uid, h, regexp_replace(trim(regexp_replace({_LOW.format('x')}, '{_WS}+', ' ', 'g')), '[0-9]+', '0', 'g') AS line, sum(octet_length(encode(regexp_replace(x, '{_WS}', '', 'g')))) AS chars FROM l GROUP BY 1, 2, 3),
c AS (SELECT *, count(*) OVER (PARTITION BY h, line) AS docs FROM k),
s AS (SELECT uid, sum(chars) AS line_bytes, count(*) FILTER (docs > 10) AS n_removed, coalesce(sum(chars) FILTER (docs > 10), 0) AS removed FROM c GROUP BY 1),
f AS (SELECT doc_id, coalesce(nw.n, 0) AS n_words, length(regexp_replace(t, '{_WS}', '', 'g')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
coalesce(dup.n, 0) AS n_dup_lines, coalesce(twice.n, 0) AS n_repeat_words, coalesce(n_removed, 0) AS n_removed_lines, CASE WHEN line_bytes > 0 THEN CAST(removed AS DOUBLE) / CAST(line_bytes AS DOUBLE) ELSE 0.0 END AS removed_share
FROM d LEFT JOIN nw USING (uid) LEFT JOIN dup USING (uid) LEFT JOIN twice USING (uid) LEFT JOIN s USING (uid))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND removed_share < 0.5 AS kept, CAST(n_removed_lines AS BIGINT) AS n_removed_lines, CAST(removed_share AS DOUBLE) AS removed_share FROM f"""

NEAR_DUPLICATES = rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOW.format('text')}, '[^ \t\n\x0B\x0C\r]+') AS ws FROM documents WHERE text IS NOT NULL),
s AS (SELECT DISTINCT doc_id, array_to_string(CASE WHEN len(ws) < 5 THEN ws ELSE list_slice(ws, i, i + 4) END, ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS held FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * held >= 75 * (x.n + y.n - held)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1)
SELECT c.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n ON n.doc_id = c.doc_id"""

_SHARE = "100 * held >= {} * (x.n + y.n - held)"
SIMILAR = NEAR_DUPLICATES.replace(_SHARE.format(75), _SHARE.format(80)).replace(", c.doc_id = component_id AS kept", "")

ORACLES = {"op6_line_frequency_rules": LINE_RULES, "op8_minhash_near_dedup": NEAR_DUPLICATES, "op13_parity_sketch_join": SIMILAR}

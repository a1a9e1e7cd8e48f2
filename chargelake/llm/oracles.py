"""DuckDB SQL for the corpus queries that SQL can express."""

# The patterns of the secret rules, in DuckDB's regex dialect.
_KEYS = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
# A private key's whole block: up to its last line, or over header and base64 lines with a shorter one at the end, which
# must not run into other text. What follows that line is matched besides; the span is made of the groups.
_BREAK, _LINE = "(?:\\\\[rn]|[\\x09-\\x0D\\x20])", "[A-Za-z0-9+/=]{16,}"
_HEADER = "[A-Za-z-]+: [^\\r\\n\\\\]*(?:\\\\[rn]|[\\r\\n])"
_FIRST = "-----BEGIN [A-Z ]*PRIVATE KEY-----"
_BODY = f"(?:{_BREAK}+{_HEADER}(?:{_BREAK}*{_HEADER})*{_BREAK}*|{_BREAK}+){_LINE}(?:{_BREAK}+{_LINE})*"
_KEY_BLOCK = (
    f"({_FIRST}(?:-{{0,4}}[^-])*-----END [A-Z ]*PRIVATE KEY-----)|({_FIRST}{_BODY})"
    f"(?:({_BREAK}+[A-Za-z0-9+/]{{1,15}}={{0,2}})(?:[\\x09-\\x0D\\x20\\\\\"'']|$))?|({_FIRST})"
)
_PATTERNS = (
    ("assign", _KEYS + """["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
    ("hosting", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("private_key", _KEY_BLOCK, 0, 1, (1, 2, 3, 4)),
)


def _spans(place: int, kind: str, pattern: str, group: int, least: int, of: tuple[int, ...] = (0,)) -> str:
    size = " + ".join(f"coalesce(length(part_{at}[i]), 0)" for at in of)
    parts = ", ".join(f"regexp_extract_all(text, '{pattern}', {at}) AS part_{at}" for at in of)
    return f"""
    SELECT n, {place} AS place, '{kind}' AS kind, i,
        list_sum([length(x) FOR x IN gaps[:i]]) + coalesce(list_sum([length(x) FOR x IN found[:i - 1]]), 0) AS s,
        {size} AS size, length(vals[i]) >= {least} AS ok
    FROM (SELECT n, unnest(range(1, len(found) + 1)) AS i, * FROM (
        SELECT n, regexp_split_to_array(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}') AS found,
            regexp_extract_all(text, '{pattern}', {group}) AS vals, {parts} FROM texts))"""


_ALL = " UNION ALL ".join(_spans(place, *rule) for place, rule in enumerate(_PATTERNS))

_SECRETS = f"""
WITH texts AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
hits AS (SELECT n, place, kind, CAST(s AS BIGINT) AS s, CAST(s + size AS BIGINT) AS e FROM ({_ALL}) WHERE ok),
per AS (SELECT n,
    count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) FILTER (place < 3) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) AS spans FROM hits GROUP BY n)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM texts LEFT JOIN per USING (n)"""

_WORDS = "[x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') IF x <> '']"

_DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
known AS (SELECT DISTINCT item_id, w[i:i + k - 1] AS win, k FROM (
    SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, CAST(len(w) - least(len(w), 10) + 2 AS BIGINT))) AS i FROM b WHERE len(w) > 0)),
runs AS (SELECT n, i, k, w[i:i + k - 1] AS win FROM (
    SELECT n, w, k, unnest(range(1, CAST(len(w) - k + 2 AS BIGINT))) AS i FROM d, (SELECT DISTINCT k FROM known) WHERE len(w) >= k)),
met AS (SELECT n, i, r.k, item_id FROM runs r JOIN known USING (win)),
hit AS (SELECT n, count(DISTINCT p) AS n_hit FROM (SELECT n, unnest(range(i, i + k)) AS p FROM met) GROUP BY n),
named AS (SELECT n, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT n, CAST(item_id AS VARCHAR) AS item FROM met WHERE item_id IS NOT NULL) GROUP BY n)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (n) LEFT JOIN named USING (n)"""

_TOKENS = "[x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') IF x <> '']"

_NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS n, doc_id, {_TOKENS} AS w FROM documents),
s AS (SELECT n, doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS own FROM d),
e AS (SELECT n, len(own) AS size, unnest(own) AS sh FROM s),
links AS (SELECT a.n AS x, b.n AS y FROM e a JOIN e b USING (sh) WHERE a.n <> b.n
    GROUP BY a.n, b.n, a.size, b.size HAVING 100 * count(*) >= 80 * (a.size + b.size - count(*))),
reach AS (SELECT n, n AS m FROM s UNION SELECT r.n, l.y FROM reach r JOIN links l ON l.x = r.m),
least AS (SELECT r.n, min(s.doc_id) AS component_id FROM reach r JOIN s ON s.n = r.m GROUP BY r.n)
SELECT doc_id, CAST(len(own) AS BIGINT) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM s JOIN least USING (n)"""

_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
s AS (SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
    max(page_id) OVER (PARTITION BY payload) AS head FROM p),
t AS (SELECT *, payload_bytes >= 1000 AND page_id IS DISTINCT FROM head AS again FROM s)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN again THEN head END AS refers_to FROM t"""

_RANKED = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, t FROM (SELECT doc_id, {_WORDS} AS t FROM documents) WHERE len(t) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(len(t)) AS BIGINT) AS terms FROM d),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM p, total GROUP BY term),
m AS (SELECT r, doc_id, 25 + (75 * CAST(len(t) AS BIGINT) * docs) // terms AS m FROM d, total),
q AS (SELECT n, item_id, term, count(*) AS times FROM (
    SELECT n, item_id, unnest(t) AS term FROM (SELECT row_number() OVER () AS n, item_id, {_WORDS} AS t FROM benchmark)) GROUP BY ALL),
s AS (SELECT n, item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, doc_id NULLS LAST) AS place FROM s WHERE score > 0) WHERE place <= 10"""

# CRC-32 of each distinct feature from the same linear rule: what a byte adds by its distance from the end, and a constant
# of the length. 3988292384 is the reversed polynomial.
_RESAMPLED = f"""
WITH RECURSIVE d AS (SELECT 0 AS side, row_number() OVER () AS n, doc_id, {_WORDS} AS t FROM documents),
b AS (SELECT 1 AS side, row_number() OVER () AS n, {_WORDS} AS t FROM benchmark),
f AS (SELECT side, n, array_to_string(t[i:i + k - 1], ' ') AS f FROM (
    SELECT side, n, t, k, unnest(range(1, CAST(len(t) - k + 2 AS BIGINT))) AS i FROM (
        SELECT side, n, t, unnest([1, 2, 3]) AS k FROM (SELECT side, n, t FROM d UNION ALL SELECT side, n, t FROM b)) WHERE len(t) >= k)),
u AS (SELECT f, hex(encode(f)) AS h, strlen(f) AS size FROM (SELECT DISTINCT f FROM f)),
bits(b, i, c) AS (SELECT x, 0, x FROM range(256) r(x) UNION ALL
    SELECT b, i + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE i < 8),
one AS (SELECT b, c FROM bits WHERE i = 8),
place(away, b, c) AS (SELECT CAST(0 AS BIGINT), b, c FROM one UNION ALL
    SELECT away + 1, place.b, xor(place.c >> 8, one.c) FROM place JOIN one ON one.b = place.c & 255 WHERE away + 1 < (SELECT max(size) FROM u)),
zeros(size, r) AS (SELECT CAST(0 AS BIGINT), CAST(4294967295 AS BIGINT) UNION ALL
    SELECT size + 1, xor(r >> 8, one.c) FROM zeros JOIN one ON one.b = r & 255 WHERE size < (SELECT max(size) FROM u)),
bytes AS (SELECT f, size, size - i AS away, 16 * (instr('0123456789ABCDEF', h[2 * i - 1]) - 1) + instr('0123456789ABCDEF', h[2 * i]) - 1 AS b
    FROM (SELECT f, size, h, unnest(range(1, CAST(size + 1 AS BIGINT))) AS i FROM u)),
lin AS (SELECT f, any_value(size) AS size, bit_xor(c) AS c FROM bytes JOIN place USING (away, b) GROUP BY f),
hashed AS (SELECT f, xor(xor(c, r), 4294967295) % 10000 AS bucket FROM lin JOIN zeros USING (size)),
many AS (SELECT side, n, bucket FROM f JOIN hashed USING (f)),
counts AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM many GROUP BY bucket),
total AS (SELECT CAST(sum(s) AS BIGINT) AS ss, CAST(sum(t) AS BIGINT) AS tt FROM counts),
gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (ss + 10000) AS DOUBLE) / CAST((s + 1) * (tt + 10000) AS DOUBLE))) AS BIGINT) AS g FROM counts, total),
w AS (SELECT n, count(*) AS n_features, CAST(sum(g) AS BIGINT) AS weight FROM many JOIN gain USING (bucket) WHERE side = 0 GROUP BY n),
h AS (SELECT n, doc_id, len(t) AS words, upper(substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS x FROM d),
drawn AS (SELECT n, doc_id, words, list_sum([(instr('0123456789ABCDEF', x[i]) - 1) * CAST(pow(16, 8 - i) AS BIGINT) FOR i IN range(1, 9)]) AS v FROM h),
scored AS (SELECT n, doc_id, words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((v + 0.5) / 4294967296))) AS BIGINT) AS score FROM drawn LEFT JOIN w USING (n)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS place,
    count(*) OVER (PARTITION BY words >= 20) AS fit FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN words >= 20 AND place <= 5 * fit // 100 THEN place END AS rank FROM ranked"""

ORACLES = {
    "op8_warc_bundles": _WARC,
    "op6_near_duplicates": _NEAR_DUPLICATES,
    "op7_secret_scan": _SECRETS,
    "op9_decontamination": _DECONTAMINATION,
    "op11_impact_search": _RANKED,
    "op12_importance_resampling": _RESAMPLED,
}

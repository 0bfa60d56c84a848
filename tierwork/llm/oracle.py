"""The queries of this package as SQL for DuckDB, where SQL can express them."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWERED = f"translate(text, '{UPPER}', '{UPPER.lower()}')"
WORDS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH item_words AS (SELECT item_id, {WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
    array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS span
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce({WORDS}, []) AS w FROM documents),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS span
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, lengths)),
found AS (SELECT p.r, p.i, p.n, x.item_id FROM places p JOIN windows x ON p.n = x.n AND p.span = x.span),
hit AS (
  SELECT r, count(DISTINCT word) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS word FROM (SELECT DISTINCT r, i, n FROM found)) GROUP BY r),
item_lists AS (
  SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit USING (r) LEFT JOIN item_lists USING (r)
"""



def _crc_of_nibble(value: int) -> int:
    for _ in range(4):
        value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
    return value


NIBBLES = (
    "list_transform(regexp_extract_all(regexp_replace(hex(encode(text)), '(.)(.)', '\\2\\1', 'g'), '.'), "
    "lambda x: strpos('0123456789ABCDEF', x) - 1)"
)
CRC32 = (
    f"xor(list_reduce(list_prepend(4294967295::BIGINT, {NIBBLES}), lambda a, x: "
    f"xor(a >> 4, {[_crc_of_nibble(i) for i in range(16)]}[(xor(a, x) & 15) + 1]::BIGINT)), 4294967295::BIGINT)"
)
SHARDING = f"""
WITH d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size, coalesce(text, '') AS text, source
  FROM documents),
crcs AS (SELECT text, {CRC32} AS crc FROM (SELECT DISTINCT text FROM d)),
drawn AS (
  SELECT d.*, crc, md5(concat_ws(':', 'interleave-1', coalesce(CAST(doc_id AS VARCHAR), ''), crc)) AS digest
  FROM d JOIN crcs USING (text)),
placed AS (
  SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY digest, size, crc) - 1)::DOUBLE
    / (2 * count(*) OVER (PARTITION BY source))::DOUBLE AS place FROM drawn),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY place, digest, size, crc) - 1 AS g, count(*) OVER () AS n FROM placed)
SELECT doc_id, CAST(size AS BIGINT) AS size, crc AS text_crc32, 'rows' AS law, CAST(g * 24 // n AS INTEGER) AS shard,
  CAST(g - ((g * 24 // n) * n + 23) // 24 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM ranked
"""

BASE32_OF_SHA1 = " || ".join(
    f"'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((('0x' || substr(h, {1 + 10 * (digit // 8)}, 10))::BIGINT "
    f">> {35 - 5 * (digit % 8)}) & 31) + 1]"
    for digit in range(32)
)
WARC = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, octet_length(encode(html)) AS payload_bytes, {BASE32_OF_SHA1} AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""


def components_of_shingles(shingle: int, percent: int) -> str:
    """Per row ``doc_id``, ``n_shingles`` and ``component_id``."""
    return rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
shingles AS (
  SELECT DISTINCT r, array_to_string(list_slice(w, i, i + least(len(w), {shingle}) - 1), ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - {shingle - 2}, 2))) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
pairs AS (
  SELECT a.r AS a, b.r AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.r < b.r
  GROUP BY a.r, b.r),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b
  WHERE 100 * common >= {percent} * (x.n + y.n - common)),
steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT r, r AS t FROM d UNION SELECT reached.r, steps.b FROM reached JOIN steps ON steps.a = reached.t),
least_of AS (SELECT reached.r, min(d.doc_id) AS component_id FROM reached JOIN d ON d.r = reached.t GROUP BY reached.r)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d JOIN least_of USING (r) LEFT JOIN sizes USING (r)
"""


NEAR_DUPLICATES = f"""
SELECT *, doc_id IS NOT DISTINCT FROM component_id AS kept FROM ({components_of_shingles(5, 75)})
"""


RESAMPLING = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({WORDS}, []) AS w FROM documents),
own AS (SELECT r, unnest(w) AS text FROM d),
target AS (SELECT unnest({WORDS}) AS text FROM benchmark WHERE text IS NOT NULL),
buckets AS (
  SELECT text, {CRC32} % 10000 AS b FROM (SELECT DISTINCT text FROM (SELECT text FROM own UNION ALL SELECT text FROM target))),
s AS (SELECT b, count(*) AS n FROM own JOIN buckets USING (text) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM target JOIN buckets USING (text) GROUP BY b),
totals AS (SELECT (SELECT count(*) FROM own) AS s_all, (SELECT count(*) FROM target) AS t_all),
gains AS (
  SELECT b, CAST(floor(1000 * ln(CAST((coalesce(t.n, 0) + 1) * (s_all + 10000) AS DOUBLE)
    / CAST((s.n + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (b), totals),
sums AS (SELECT r, CAST(sum(gain) AS BIGINT) AS in_all FROM own JOIN buckets USING (text) JOIN gains USING (b) GROUP BY r),
scored AS (
  SELECT r, doc_id, len(w) AS n_features,
    CASE WHEN len(w) = 0 THEN 0 ELSE (in_all - ((in_all % len(w)) + len(w)) % len(w)) // len(w) END AS weight,
    CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
      + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS drawn
  FROM d LEFT JOIN sums USING (r)),
able AS (
  SELECT r, row_number() OVER (ORDER BY weight + drawn DESC, doc_id ASC NULLS LAST, n_features) AS place, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight,
  CAST(weight + drawn AS BIGINT) AS score, CASE WHEN place <= 10 * n // 100 THEN CAST(place AS BIGINT) END AS rank
FROM scored LEFT JOIN able USING (r)
"""


COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWERED}, '[.,;:!?
-
]')) AS piece
    FROM documents WHERE text IS NOT NULL)),
f AS (
  SELECT lang, m, p, count(*) AS f FROM (
    SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS p FROM (
      SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, (VALUES (1), (2), (3)) lengths(m)))
  GROUP BY lang, m, p),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
candidates AS (SELECT lang, m, p, f AS a, string_split(p, ' ') AS w FROM f WHERE m > 1 AND f >= 10),
cuts AS (
  SELECT lang, m, p, a, k, array_to_string(list_slice(w, 1, k), ' ') AS lp, array_to_string(list_slice(w, k + 1, m), ' ') AS rp
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates)),
scores AS (
  SELECT c.lang, c.m, c.p, a, x.f AS l, y.f AS r, k,
    CAST((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.m = c.k AND x.p = lp JOIN f y ON y.lang = c.lang AND y.m = c.m - k AND y.p = rp),
lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS place FROM scores),
covers AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS p, a AS most
  FROM candidates WHERE m = 3),
cover AS (SELECT lang, p, max(most) AS most FROM covers GROUP BY lang, p),
left_over AS (
  SELECT s.* FROM lowest s LEFT JOIN cover c ON c.lang = s.lang AND c.p = s.p AND s.m = 2
  WHERE place = 1 AND coalesce(100 * most >= 50 * a, false) = false),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM left_over)
SELECT lang, rank, p AS phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": DECONTAMINATION,
        "op2_sharding": SHARDING,
        "op3_warc": WARC,
        "op5_minhash": NEAR_DUPLICATES,
        "op11_collocations": COLLOCATIONS,
        "op12_jaccard": components_of_shingles(3, 90),
        "op13_resampling": RESAMPLING,
    }

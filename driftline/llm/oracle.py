"""DuckDB SQL for the queries that SQL can express, written from the definitions:
exact joins on shingles and windows as text, no hashes, buckets or fingerprints."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MINHASH_NEARDUP = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
         GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
          WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT w.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(reach.b) AS component_id,
       w.doc_id = min(reach.b) AS kept
FROM w JOIN reach ON reach.a = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id
"""

DECONTAMINATION = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
ds AS (SELECT doc_id, unnest(range(0, len(w) - 4)) AS p, w FROM d WHERE len(w) > 4),
ds2 AS (SELECT doc_id, p, array_to_string(w[p + 1:p + 5], ' ') AS s FROM ds),
bs AS (SELECT item_id, len(w) - 4 AS m, len(w) AS n_words, unnest(range(0, len(w) - 4)) AS q, w FROM b WHERE len(w) > 4),
bs2 AS (SELECT item_id, m, n_words, q, array_to_string(w[q + 1:q + 5], ' ') AS s FROM bs),
hits AS (SELECT DISTINCT doc_id, m, p FROM ds2 JOIN bs2 USING (s)),
starts AS (SELECT DISTINCT doc_id, m, p - o AS start
           FROM (SELECT doc_id, m, p, unnest(range(0, m)) AS o FROM hits)),
win AS (SELECT doc_id, m, start, s, count(*) AS c FROM starts JOIN ds2 USING (doc_id)
        WHERE p >= start AND p < start + m GROUP BY ALL),
tot AS (SELECT doc_id, m, start, sum(c) AS c FROM win GROUP BY ALL),
item AS (SELECT item_id, m, n_words, s, count(*) AS c FROM bs2 GROUP BY ALL),
pairs AS (SELECT doc_id, item_id, m, start, n_words, sum(least(win.c, item.c)) AS both_c
          FROM win JOIN item USING (m, s) GROUP BY ALL),
short AS (SELECT item_id, len(w) AS n_words, array_to_string(w, ' ') AS t FROM b WHERE len(w) BETWEEN 1 AND 4),
runs AS (SELECT doc_id, n_words, unnest(range(0, len(w) - n_words + 1)) AS start, w
         FROM d, (SELECT DISTINCT n_words FROM short) WHERE len(w) >= n_words),
sim AS (SELECT doc_id, item_id, n_words, start, both_c / (tot.c + m - both_c) AS similarity
        FROM pairs JOIN tot USING (doc_id, m, start) WHERE 100 * both_c >= 80 * (tot.c + m - both_c)
        UNION ALL SELECT doc_id, item_id, runs.n_words, start, 1.0 FROM runs JOIN short
        ON short.n_words = runs.n_words AND t = array_to_string(runs.w[start + 1:start + runs.n_words], ' '))
SELECT doc_id, item_id, CAST(similarity AS DOUBLE) AS similarity, CAST(n_words AS INTEGER) AS n_words,
       CAST(greatest(start, 0) AS INTEGER) AS start
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) AS r FROM sim)
WHERE r = 1
"""

ARC_TO_WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS h FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h, payload_bytes) AS first FROM h)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((CAST('0x' || substr(h, CAST(10 * (i // 8) + 1 AS BIGINT), 10) AS BIGINT)
                 // CAST(pow(32, 7 - i % 8) AS BIGINT)) % 32 + 1 AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

SUBSTRING_DEDUP = rf"""
WITH w AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS k, w FROM w WHERE len(w) >= 35),
named AS (SELECT doc_id, k, md5(array_to_string(w[k:k + 34], ' ')) AS h FROM win),
again AS (SELECT h FROM named GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, k + o AS k FROM named SEMI JOIN again USING (h), range(35) t(o)),
kept AS (SELECT doc_id, k, word FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS word FROM w)
         ANTI JOIN gone USING (doc_id, k)),
texts AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS t, count(*) AS n FROM kept GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN texts USING (doc_id)
"""


def _jump(shards: int) -> str:
    """Rows (doc_id, shard) by the published loop of the jump hash."""
    return f"""(WITH RECURSIVE j AS (
    SELECT doc_id, CAST(coalesce(doc_id, 0) AS UHUGEINT) AS k, CAST(-1 AS BIGINT) AS b, CAST(0 AS BIGINT) AS j
    FROM documents
    UNION ALL
    SELECT doc_id, (k * 2862933555777941757 + 1) % 18446744073709551616, j,
           CAST(floor((j + 1) * (2147483648.0::DOUBLE / CAST((k * 2862933555777941757 + 1) % 18446744073709551616
                // 8589934592 + 1 AS DOUBLE))) AS BIGINT)
    FROM j WHERE j < {shards})
    SELECT doc_id, CAST(max(b) AS INTEGER) AS shard FROM j WHERE j >= {shards} GROUP BY doc_id)"""


SHARDING = f"""
WITH table_of AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda c, x:
        CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS c FROM range(256) r(i))),
d AS (SELECT doc_id, encode(coalesce(text, '')) AS body FROM documents),
crc AS (SELECT doc_id, octet_length(body) + 1 AS size, hex(body) AS h FROM d),
sums AS (SELECT doc_id, size, xor(4294967295, list_reduce(list_transform(range(size - 1),
        lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)), lambda c, x:
        xor(c // 256, t[xor(c, x) % 256 + 1]), 4294967295)) AS text_crc32 FROM crc, table_of)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, a.shard,
       row_number() OVER (PARTITION BY a.shard ORDER BY doc_id, text_crc32, size) - 1 AS slot,
       b.shard AS grown_shard
FROM sums JOIN {_jump(8)} a USING (doc_id) JOIN {_jump(9)} b USING (doc_id)
"""

# The pages hold one article of headings and paragraphs and no comments, forms or notices
# inside it, so that patterns can cut it out; other pages are left to the tests.
HTML_TEXT = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS h FROM pages),
b AS (SELECT page_id, url, list_transform(string_split_regex(h, '</?(?:p|h1)>'), lambda x:
      regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '<[^>]*>', '', 'g')) AS blocks FROM a),
d AS (SELECT page_id, url, list_transform(blocks, lambda x: trim(regexp_replace(regexp_replace(regexp_replace(
      regexp_replace(regexp_replace(x, '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g'),
      '\s+', ' ', 'g'))) AS blocks FROM b),
t AS (SELECT page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10)) AS text FROM d)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM t
"""

_TERMS = r"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

LEXICAL_SEARCH = rf"""
WITH d AS MATERIALIZED (SELECT doc_id, {_TERMS.format(text=_LOWER)} AS w FROM documents),
tot AS (SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_words FROM d),
q AS (SELECT item_id, t, count(*) AS q FROM (SELECT item_id, unnest({_TERMS.format(text=_LOWER)}) AS t FROM benchmark) GROUP BY ALL),
tf AS MATERIALIZED (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS t FROM d)
       SEMI JOIN (SELECT DISTINCT t FROM q) USING (t) GROUP BY ALL),
wt AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
       FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), tot),
parts AS (SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_words))) AS s
          FROM tf JOIN wt USING (t), tot),
scores AS (SELECT item_id, doc_id, CAST(sum(q * s) AS BIGINT) AS score FROM q JOIN parts USING (t) GROUP BY ALL HAVING sum(q * s) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores QUALIFY rank <= 20
"""

COLLOCATIONS = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(LOWERED, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
tot AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang HAVING sum(len(w)) > 0),
grams AS (SELECT lang, k, array_to_string(g, ' ') AS phrase, count(*) AS f FROM (
          SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
          FROM w, range(1, 6) r(k) WHERE len(w) >= k) GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, k, phrase, f AS a, c, array_to_string(string_split(phrase, ' ')[1:c], ' ') AS first,
         array_to_string(string_split(phrase, ' ')[c + 1:], ' ') AS rest FROM grams, range(1, 5) r(c) WHERE c < k),
scored AS (SELECT cuts.lang, cuts.k, cuts.phrase, a, c, x.f AS l, y.f AS r, n,
           CAST(CAST(1000 AS HUGEINT) * a * n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
           FROM cuts JOIN grams x ON x.lang = cuts.lang AND x.phrase = first JOIN grams y ON y.lang = cuts.lang AND y.phrase = rest
           JOIN tot ON tot.lang = cuts.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
gone AS (SELECT DISTINCT lang, part FROM (SELECT lang, f, array_to_string(string_split(phrase, ' ')[i:i + m - 1], ' ') AS part
         FROM grams, range(2, 5) s(m), range(1, 5) r(i) WHERE m < k AND i + m - 1 <= k) q
         JOIN grams USING (lang) WHERE grams.phrase = part AND q.f >= grams.f)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM best ANTI JOIN gone ON gone.lang = best.lang AND gone.part = best.phrase QUALIFY rank <= 2000
""".replace("LOWERED", _LOWER)

ORACLE_SQL = {
    "op3_minhash_neardup": MINHASH_NEARDUP,
    "op4_decontamination": DECONTAMINATION,
    "op6_arc_to_warc": ARC_TO_WARC,
    "op9_substring_dedup": SUBSTRING_DEDUP,
    "op10_sharding": SHARDING,
    "op11_html_text": HTML_TEXT,
    "op12_lexical_search": LEXICAL_SEARCH,
    "op13_collocations": COLLOCATIONS,
}

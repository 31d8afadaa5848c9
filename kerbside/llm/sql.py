"""SQL for DuckDB of the training-data operators whose whole result SQL can express.

Each takes the contract's plain reading, with windows, shingles and features as lists, so they suit tables of some
thousand documents.
"""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_TERMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Rows are told apart by their number, so that equal ids keep their own texts.
NEAR_DUPLICATES = f"""
    WITH RECURSIVE listed AS (
      SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
    sets AS (
      SELECT r, doc_id, list_sort(list_distinct(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s
      FROM listed),
    classes AS (SELECT s, min(r) AS c, min(doc_id) AS doc_id, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
    grams AS (SELECT c, n, unnest(s) AS g FROM classes),
    linked AS (
      SELECT x.c AS a, y.c AS b FROM grams x JOIN grams y ON x.g = y.g AND x.c <> y.c
      GROUP BY x.c, y.c, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
    reached(a, b) AS (SELECT c, c FROM classes UNION SELECT reached.a, linked.b FROM reached JOIN linked ON linked.a = reached.b),
    components AS (
      SELECT a AS c, min(classes.doc_id) AS component_id FROM reached JOIN classes ON classes.c = reached.b GROUP BY a)
    SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(component_id, sets.doc_id) AS component_id
    FROM sets LEFT JOIN classes ON classes.s = sets.s LEFT JOIN components ON components.c = classes.c"""

#: Five hexadecimal digits of the digest are four digits of base32.
WARC = """
    WITH paid AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    marked AS (
      SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS h,
             min(page_id) OVER (PARTITION BY payload) AS first FROM paid)
    SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr(
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             1 + ((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31), 1)), '')
             AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM marked"""

SUBSTRING_DEDUP = f"""
    WITH listed AS (
      SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
    starts AS (SELECT r, unnest(range(1, len(w) - 33)) AS i, w FROM listed),
    windows AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS g FROM starts),
    repeated AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY g) > 1),
    covered AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM repeated),
    placed AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM listed),
    kept AS (
      SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS words FROM placed ANTI JOIN covered USING (r, i) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
           sha256(coalesce(words, '')) AS kept_sha256
    FROM listed LEFT JOIN kept USING (r)"""

#: The table of the checksum follows from its polynomial; a checksum is worked out once for each distinct feature.
IMPORTANCE = f"""
    WITH RECURSIVE divided(i, k, v) AS (
      SELECT range, 0, range FROM range(256)
      UNION ALL
      SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM divided WHERE k < 8),
    checks AS (SELECT list(v ORDER BY i) AS t FROM divided WHERE k = 8),
    texts AS (
      SELECT 0 AS side, row_number() OVER () AS r, doc_id, {_TERMS.format(_LOWER)} AS w FROM documents
      UNION ALL SELECT 1, row_number() OVER (), NULL, {_TERMS.format(_LOWER)} FROM benchmark),
    starts AS (SELECT side, r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM texts, (VALUES (1), (2), (3)) sizes(k)),
    features AS (SELECT side, r, array_to_string(w[i:i + k - 1], ' ') AS f, count(*) AS n FROM starts GROUP BY ALL),
    named AS (SELECT DISTINCT f, hex(encode(f)) AS h FROM features),
    bytes AS (SELECT f, list_transform(range(0, len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)) AS b FROM named),
    buckets AS (
      SELECT f, xor(list_reduce(b, lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8), 4294967295), 4294967295) % 10000 AS bucket
      FROM bytes, checks),
    counted AS (
      SELECT bucket, sum(n) FILTER (side = 0) AS s, sum(n) FILTER (side = 1) AS t FROM features JOIN buckets USING (f) GROUP BY 1),
    sums AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM counted),
    gains AS (
      SELECT bucket, CAST(floor(1000 * ln(
        CAST((coalesce(t, 0) + 1) * (all_s + 10000) AS DOUBLE) / CAST((coalesce(s, 0) + 1) * (all_t + 10000) AS DOUBLE))) AS BIGINT) AS gain
      FROM counted, sums),
    weighed AS (
      SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight
      FROM features JOIN buckets USING (f) JOIN gains USING (bucket) WHERE side = 0 GROUP BY r),
    scored AS (
      SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
               (CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
      FROM texts LEFT JOIN weighed USING (r) WHERE side = 0),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
             5 * count(*) FILTER (n_words >= 20) OVER () // 100 AS wanted FROM scored)
    SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= wanted THEN place END AS rank FROM placed"""

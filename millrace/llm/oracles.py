"""The registered queries of this subpackage in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: ``crcs``: the unsigned CRC-32 of the UTF-8 bytes of each ``s`` in ``strings``.
_CRCS = """table_ AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i:
    list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
crcs AS MATERIALIZED (
  SELECT s, xor(4294967295, list_reduce(
    list_transform(range(0, CAST(length(hex(encode(s))) AS BIGINT), 2), lambda k: CAST('0x' || hex(encode(s))[k + 1:k + 2] AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT))) AS crc
  FROM strings, table_)"""

SPELLING_VARIANTS = f"""
WITH RECURSIVE runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY ALL),
strings AS (SELECT DISTINCT doc_id || ':' || run AS s FROM runs WHERE doc_id IS NOT NULL),
{_CRCS},
results AS (
  SELECT times, CASE WHEN crc % 97 = 0
    THEN substr(run, 1, CAST(crc % length(run) AS BIGINT)) || substr(run, CAST(crc % length(run) AS BIGINT) + 2) ELSE run END AS word
  FROM runs LEFT JOIN crcs ON s = doc_id || ':' || run),
words AS MATERIALIZED (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM results WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
places AS MATERIALIZED (
  SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS less
  FROM (SELECT word, n, unnest(range(1, CAST(length(word) AS BIGINT) + 1)) AS p FROM words)),
near AS MATERIALIZED (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM places a JOIN places b ON a.less = b.less AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM words a JOIN places b ON a.word = b.less
  UNION SELECT b.word, b.n, a.word, a.n FROM words a JOIN places b ON a.word = b.less),
best AS MATERIALIZED (
  SELECT word, n, CAST(count(*) AS BIGINT) AS n_near, min(struct_pack(k := -other_n, w := encode(other))) AS b FROM near GROUP BY word, n),
judged AS MATERIALIZED (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -b.k >= 2 * words.n THEN decode(b.w) END AS form, CASE WHEN -b.k >= 2 * words.n THEN -b.k END AS form_n
  FROM words LEFT JOIN best ON words.word = best.word),
steps AS (
  SELECT word, word AS last FROM judged
  UNION ALL SELECT steps.word, judged.form FROM steps JOIN judged ON judged.word = steps.last WHERE judged.form IS NOT NULL)
SELECT judged.word, form, last AS root, n, n_near, form_n
FROM judged JOIN steps ON judged.word = steps.word
WHERE last NOT IN (SELECT word FROM judged WHERE form IS NOT NULL)
"""

IMPORTANCE_RESAMPLING = f"""
WITH found AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
target AS (
  SELECT unnest(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM benchmark),
source AS MATERIALIZED (SELECT doc_id, unnest(words) AS word FROM found),
strings AS (SELECT word AS s FROM source UNION SELECT word FROM target),
{_CRCS},
buckets AS MATERIALIZED (SELECT s AS word, CAST(crc % 10000 AS BIGINT) AS bucket FROM crcs),
in_source AS (SELECT bucket, count(*) AS n FROM source JOIN buckets USING (word) GROUP BY bucket),
in_target AS (SELECT bucket, count(*) AS n FROM target JOIN buckets USING (word) GROUP BY bucket),
gains AS MATERIALIZED (
  SELECT in_source.bucket, CAST(floor(1000 * ln(
    (coalesce(in_target.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM source) + 10000)
    / ((in_source.n + 1)::DOUBLE * ((SELECT count(*) FROM target) + 10000)))) AS BIGINT) AS gain
  FROM in_source LEFT JOIN in_target USING (bucket)),
weights AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight
  FROM source JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS MATERIALIZED (
  SELECT doc_id, CAST(coalesce(length(words), 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM found LEFT JOIN weights USING (doc_id)),
drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scored WHERE n_features >= 20)
SELECT scored.*, CASE WHEN place <= (SELECT count(*) * 10 // 100 FROM drawn) THEN place END AS rank
FROM scored LEFT JOIN drawn USING (doc_id)
"""

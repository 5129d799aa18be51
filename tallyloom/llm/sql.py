"""DuckDB's SQL for the queries that SQL can express."""

from __future__ import annotations

from tallyloom.llm.importance import BUCKETS, LEAST_WORDS, PERCENT, SEED
from tallyloom.llm.licenses import AGREE, ALL, RARE, SLACK
from tallyloom.llm.spelling import LEAST, LENGTH, MODULUS, TIMES

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
b AS (SELECT item_id, {WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, w[i : i + least(13, len(w)) - 1] AS win
  FROM (SELECT *, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT len(win) AS n FROM windows),
grams AS (
  SELECT r, i, n, w[i : i + n - 1] AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
hits AS (SELECT r, i, n, item_id FROM grams JOIN windows USING (win)),
hit_words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
hit_items AS (
  SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


NOTICES = ", ".join(f"('{n.label}', {_list(n.words)}, {_list(n.phrases)}, {n.whole})" for n in ALL)
LICENSES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
notices AS (SELECT row_number() OVER () AS k, * FROM (VALUES {NOTICES}) AS v(label, words, phrases, whole)),
parts AS (SELECT k, unnest(words) AS word, unnest(range(len(words))) AS o FROM notices),
frequency AS (
  SELECT word, count(*) AS n FROM (SELECT r, unnest(list_distinct(w)) AS word FROM d)
  WHERE word IN (SELECT word FROM parts) GROUP BY word),
ranked AS (
  SELECT k, word, row_number() OVER (PARTITION BY k ORDER BY coalesce(n, 0), word) AS rank
  FROM (SELECT DISTINCT k, word FROM parts) LEFT JOIN frequency USING (word)),
postings AS (SELECT k, word, o FROM parts JOIN ranked USING (k, word) WHERE rank <= {RARE}),
needed AS (
  SELECT k, CASE WHEN whole THEN n ELSE least(n, {AGREE}) END AS n
  FROM notices JOIN (SELECT k, count(DISTINCT word) AS n FROM postings GROUP BY k) USING (k)),
places AS (
  SELECT r, word, i FROM (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS i FROM d)
  WHERE word IN (SELECT word FROM postings)),
starts AS (
  SELECT r, k, i - o AS s, count(DISTINCT word) AS votes FROM places JOIN postings USING (word) GROUP BY r, k, i - o),
near AS (
  SELECT r, k, s, d.w, words, phrases, whole, label,
    ' ' || array_to_string(d.w[greatest(s - {SLACK}, 0) + 1 : greatest(s + len(words) + {SLACK}, 0)], ' ') || ' ' AS around
  FROM starts JOIN needed USING (k) JOIN notices USING (k) JOIN d USING (r) WHERE votes >= n),
found AS (
  SELECT r, s, whole, label,
    list_sum([CASE WHEN s + x >= 0 AND w[s + x + 1] = words[x + 1] THEN 1 ELSE 0 END FOR x IN range(len(words))]) / len(words)::DOUBLE AS share
  FROM near
  WHERE CASE WHEN whole THEN s >= 0 AND w[s + 1 : s + len(words)] = words
    ELSE len([p FOR p IN phrases IF contains(around, ' ' || p || ' ')]) = len(phrases) END),
per_row AS (
  SELECT r, sum(whole::INT) AS n_base, min(CASE WHEN whole THEN s END) AS first_word, max(CASE WHEN whole THEN s END) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (whole) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN per_row USING (r)
"""

#: The CRC-32 of the bytes of a column ``s`` of the CTE ``hashed``, from the table of the 256 steps of a byte.
CRC = """
crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) ORDER BY b) AS steps
  FROM (SELECT unnest(range(256)) AS b)),
bytes AS (SELECT s, hex(encode(s)) AS h FROM hashed),
crcs AS (
  SELECT s, xor(list_reduce([('0x' || substr(h, 2 * i + 1, 2))::BIGINT FOR i IN range(len(h) // 2)],
    lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1]), 4294967295::BIGINT), 4294967295) AS crc
  FROM bytes, crc_table)
"""

IMPORTANCE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
raw AS (SELECT r, unnest(w) AS s FROM d),
wanted AS (SELECT unnest({WORDS}) AS s FROM benchmark),
hashed AS (SELECT s FROM raw UNION SELECT s FROM wanted),
{CRC},
buckets AS (SELECT s, crc % {BUCKETS} AS bucket FROM crcs),
raw_counts AS (SELECT bucket, count(*) AS n FROM raw JOIN buckets USING (s) GROUP BY bucket),
wanted_counts AS (SELECT bucket, count(*) AS n FROM wanted JOIN buckets USING (s) GROUP BY bucket),
totals AS (
  SELECT (SELECT count(*) FROM raw)::DOUBLE AS all_s, (SELECT count(*) FROM wanted)::DOUBLE AS all_t),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (all_s + {BUCKETS})
    / ((s.n + 1)::DOUBLE * (all_t + {BUCKETS})))) AS gain
  FROM raw_counts s LEFT JOIN wanted_counts t USING (bucket), totals),
weighed AS (
  SELECT r, count(*) AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight
  FROM raw JOIN buckets USING (s) JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT r, doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, len(w) AS n_words,
    coalesce(weight, 0)::BIGINT
      + floor(-1000 * ln(-ln((('0x' || sha256('{SEED}:' || coalesce(doc_id::VARCHAR, ''))[:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN weighed USING (r)),
placed AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS n
  FROM scored WHERE n_words >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * {PERCENT} // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (r)
"""

RUNS = f"regexp_extract_all({LOWER}, '[a-z\u00c0-\u00ff]+')"

SPELLING = f"""
WITH RECURSIVE runs AS (SELECT doc_id, unnest({RUNS}) AS run FROM documents),
long AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS s, run, count(*) AS n
  FROM runs WHERE len(run) >= {LENGTH} GROUP BY 1, 2),
hashed AS (SELECT DISTINCT s FROM long),
{CRC},
words AS (
  SELECT CASE WHEN crc % {MODULUS} = 0 THEN left(run, (crc % len(run))::INT) || substr(run, (crc % len(run))::INT + 2) ELSE run END AS word, n
  FROM long JOIN crcs USING (s)),
counts AS (SELECT word, sum(n)::BIGINT AS n FROM words WHERE len(word) >= {LENGTH} GROUP BY word HAVING sum(n) >= {LEAST}),
short AS (
  SELECT word, i, left(word, i::INT) || substr(word, i::INT + 2) AS rest
  FROM (SELECT word, unnest(range(len(word))) AS i FROM counts)),
near AS (
  SELECT DISTINCT a.word AS word, b.word AS other FROM short a JOIN short b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word FROM short a JOIN counts b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM short a JOIN counts b ON a.rest = b.word),
ranked AS (
  SELECT near.word, other, n, row_number() OVER (PARTITION BY near.word ORDER BY n DESC, other) AS place, count(*) OVER (PARTITION BY near.word) AS n_near
  FROM near JOIN counts ON other = counts.word),
known AS (
  SELECT c.word, c.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN r.n >= {TIMES} * c.n THEN other END AS form,
    CASE WHEN r.n >= {TIMES} * c.n THEN r.n END AS form_n
  FROM counts c LEFT JOIN ranked r ON c.word = r.word AND place = 1),
paths AS (
  SELECT word, form AS last FROM known WHERE form IS NOT NULL
  UNION ALL SELECT paths.word, known.form FROM paths JOIN known ON last = known.word WHERE known.form IS NOT NULL),
ends AS (SELECT paths.word, last FROM paths JOIN known ON last = known.word WHERE known.form IS NULL)
SELECT word, form, coalesce(last, word) AS root, n, n_near, form_n FROM known LEFT JOIN ends USING (word)
"""

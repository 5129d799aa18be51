"""The catalog's queries as plain SQL on the given tables.

The shared common tables state the rows of ``fixtures.py`` without the detour
over JSON text.
"""

from __future__ import annotations

from tallyloom import schema as S
from tallyloom.operators.latency import LATENCY_BOUNDS
from tallyloom.operators.metrics import DURATION_BOUNDS

AS_OF = "2024-01-30 12:00:00"
NEWEST = "(SELECT MAX(ts) FROM tr)"

POS, NEG, NEU = S.POSITIVE, S.NEGATIVE, S.NEUTRAL
LABELS = {"positive": POS, "negative": NEG, "neutral": NEU}

REVIEWS = """
ev AS (
  SELECT *, CAST(FLOOR(value) AS BIGINT) % 12 / 2.0e0 AS raw, regexp_extract(props, '[0-9]+') AS k FROM events),
sends AS (
  SELECT event_id, user_id, event_type, value, props, raw, k, ts, CAST(0 AS INTEGER) AS redelivery FROM ev
  UNION ALL
  SELECT event_id, user_id, event_type, value, props, raw, k, ts + INTERVAL '1' SECOND, CAST(1 AS INTEGER)
  FROM ev WHERE event_type = 'purchase'),
tr AS (
  SELECT 'job-' || user_id AS job_id, 'r' || event_id AS review_id, ts, redelivery,
         event_id, event_type, value, props, k,
         CASE WHEN event_type = 'error' THEN 0.0e0 ELSE raw END AS rating,
         CASE WHEN event_type IN ('click', 'signup') THEN raw ELSE 0.0e0 END AS own_rating,
         event_id % 11 <> 0 AS valid, event_id % 5 = 0 AS empty, event_id % 3 = 0 AS trial
  FROM sends)"""

ANALYSES = f"""
an AS (
  SELECT 'job-' || user_id AS job_id, 'r' || event_id AS review_id,
         ts + (event_id % 181) * INTERVAL '1' SECOND AS ts,
         CASE WHEN value < 10 THEN '{NEG}' WHEN value < 40 THEN '{POS}'
              WHEN value < 80 THEN '{NEU}' WHEN value < 100 THEN '혼합' END AS sentiment,
         event_type AS summary, (event_id % 3 = 0 OR event_type = 'click') AS trial
  FROM events WHERE event_type <> 'error')"""

COLLECTED = """
ctl AS (
  SELECT 'job-' || user_id AS job_id, ts,
         CASE user_id % 4 WHEN 1 THEN n WHEN 3 THEN n + 5 ELSE GREATEST(n - 30, 0) END AS expected_count
  FROM (SELECT user_id, COUNT(*) AS n, MAX(ts) AS ts FROM events GROUP BY user_id))"""

LOG = """
lk AS (SELECT *, CASE WHEN o_orderpriority LIKE '5%' THEN o_orderkey % 7 ELSE 7 END AS lacks FROM orders),
lg AS (
  SELECT 'job-' || o_custkey AS job_id,
         CASE WHEN lacks = 1 THEN NULL WHEN o_orderpriority LIKE '1%' THEN 'collection' WHEN o_orderpriority LIKE '2%' THEN 'transform'
              WHEN o_orderpriority LIKE '3%' THEN 'analysis' WHEN o_orderpriority LIKE '4%' THEN 'aggregation'
              ELSE 'publish' END AS step,
         CASE WHEN lacks IN (2, 6) THEN NULL WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'O' THEN 'failed' ELSE 'timeout' END AS status,
         CASE WHEN lacks = 3 THEN 0 ELSE CAST(FLOOR(o_totalprice / 100) AS BIGINT) END AS expected_count,
         CASE WHEN lacks = 4 THEN 0 ELSE CAST(FLOOR(o_totalprice / 100) AS BIGINT)
           - CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_custkey % 3 END END AS actual_count,
         lacks >= 6 AS complete, FLOOR(o_totalprice) / 2.0e0 AS processing_time,
         o_orderdate AS ts
  FROM lk)"""

LINES = """
li AS (
  SELECT 'job-' || l_suppkey AS job_id, l_orderkey || '-' || l_linenumber AS review_id, l_shipdate AS ts,
         FLOOR((l_quantity - 1) / 5) / 2.0e0 + 0.5e0 AS rating, l_linestatus = 'O' AS trial,
         l_quantity <= 3 AS empty, l_returnflag <> 'R' AS valid, l_partkey, l_extendedprice
  FROM lineitem)"""

TEXTS = """
dc AS (
  SELECT doc_id, source AS job_id, 'd' || doc_id AS review_id, doc_id % 11 / 2.0e0 AS rating,
         n_chars < 200 AS empty, lang <> 'en' AS trial, TRUE AS valid, lang, text
  FROM documents)"""

KEYWORDS = """
kw AS (
  SELECT job_id, empty, trial, '품질' AS keyword, event_type AS tag, TRUE AS textual FROM tr
  UNION ALL
  SELECT job_id, empty, trial, '배송', CASE WHEN value < 20 THEN 'fast' ELSE 'slow' END, TRUE
  FROM tr WHERE event_type <> 'view'
  UNION ALL
  SELECT job_id, empty, trial, '속성-' || k, '있음', TRUE FROM tr
  UNION ALL
  SELECT job_id, empty, trial, '점수', CAST(CAST(FLOOR(value) AS BIGINT) % 3 AS VARCHAR), FALSE FROM tr)"""

COUNTS = """
tc AS (SELECT job_id, COUNT(DISTINCT review_id) AS n FROM tr GROUP BY job_id),
ac AS (SELECT job_id, COUNT(DISTINCT review_id) AS n FROM an GROUP BY job_id)"""

LEDGER = """
led AS (
  SELECT ctl.job_id, ctl.ts AS collected_at, expected_count, tc.n AS transform_count, ac.n AS analysis_count,
         COALESCE(tc.n >= expected_count, FALSE) AS transform_done,
         COALESCE(ac.n >= expected_count, FALSE) AS analysis_done,
         CASE WHEN tc.n IS NOT NULL AND ac.n IS NOT NULL THEN LEAST(tc.n, ac.n) END AS min_count
  FROM ctl LEFT JOIN tc ON tc.job_id = ctl.job_id LEFT JOIN ac ON ac.job_id = ctl.job_id),
lg2 AS (
  SELECT *, transform_done AND analysis_done AND COALESCE(min_count >= expected_count, FALSE) AS aggregation_done
  FROM led)"""

BATCHES = """
bm AS (
  SELECT 'job-' || l_suppkey AS job_id, l_orderkey || '-' || l_linenumber AS review_id, l_quantity AS rating,
         l_linestatus, l_returnflag, l_tax, l_extendedprice FROM lineitem)"""


def with_tables(select: str, *tables: str) -> str:
    return "WITH " + ",".join(tables) + "\n" + select


def stars(rating: str) -> str:
    bucket = f"FLOOR({rating} + 0.5e0)"
    return f"CASE WHEN {bucket} BETWEEN 1 AND 5 THEN CAST({bucket} AS INTEGER) END"


def ratio(part: str, total: str) -> str:
    return f"COALESCE({part} / NULLIF(CAST({total} AS DOUBLE), 0), 0.0e0)"


def pct(part: str, total: str) -> str:
    return f"COALESCE({part} * 100.0e0 / NULLIF(CAST({total} AS DOUBLE), 0), 0.0e0)"


def share(part: str, total: str) -> str:
    return f"COALESCE({part} / NULLIF(CAST({total} AS DOUBLE), 0) * 100.0e0, 0.0e0)"


def quoted(text: str) -> str:
    return f"'{text}'"


def n_if(test: str) -> str:
    return f"COUNT(*) FILTER (WHERE {test})"


PUBLISHED = {"all": "TRUE", "coupang_trial": "trial", "regular": "NOT trial"}
TYPED = {
    "all": "TRUE",
    "coupang_trial": "NOT empty AND trial",
    "regular": "NOT empty AND NOT trial",
    "empty_review": "empty",
}


def histogram(groups: dict[str, str], source: str) -> str:
    """Rows (job, cohort, stars, n), zero counts included."""
    cells = " UNION ALL ".join(
        f"SELECT '{name}' AS cohort, CAST({star} AS INTEGER) AS stars" for name in groups for star in S.STARS
    )
    member = " ".join(f"WHEN '{name}' THEN {test}" for name, test in groups.items())
    return f"""
SELECT j.job_id, c.cohort, c.stars,
       (SELECT COUNT(*) FROM b WHERE b.job_id = j.job_id AND b.bucket = c.stars
          AND CASE c.cohort {member} END) AS n
FROM (SELECT DISTINCT job_id FROM {source}) j CROSS JOIN ({cells}) c"""


def wide_histogram(groups: dict[str, str]) -> str:
    return ",\n       ".join(
        f"{n_if(f'({test}) AND bucket = {star}')} AS stars_{name}_{star}"
        for name, test in groups.items()
        for star in S.STARS
    )


def profile(source: str) -> str:
    mean = lambda test: f"COALESCE(AVG(bucket) FILTER (WHERE {test}), 0.0e0)"
    return f"""
SELECT job_id, COUNT(*) AS total_reviews, {n_if('valid')} AS valid_reviews, {n_if('empty')} AS empty_reviews,
       {n_if('trial')} AS trial_reviews, {mean('TRUE')} AS avg_rating, {mean('trial')} AS avg_rating_trial,
       {mean('NOT trial')} AS avg_rating_regular,
       CASE WHEN {n_if('valid')} > 0 THEN {mean('TRUE')} ELSE 0.0e0 END AS avg_rating_excluding_empty,
       {wide_histogram(PUBLISHED)}
FROM {source} GROUP BY job_id"""


def bucketed(source: str, rating: str = "rating") -> str:
    return f"b AS (SELECT *, {stars(rating)} AS bucket FROM {source})"


def stats_columns(rounded: bool = False) -> str:
    def mean(test: str, name: str) -> str:
        value = f"COALESCE(AVG(own_rating) FILTER (WHERE {test}), 0.0e0)"
        return f"{f'ROUND({value}, 9)' if rounded else value} AS {name}"

    return f"""COUNT(*) AS total_reviews, {n_if('valid')} AS valid_reviews, {n_if('empty')} AS empty_reviews,
       {n_if('trial')} AS trial_reviews, {mean('TRUE', 'avg_rating')},
       {mean('NOT empty', 'avg_rating_excluding_empty')}, {mean('trial', 'avg_rating_trial')},
       {mean('NOT trial', 'avg_rating_regular')},
       {wide_histogram(TYPED)}"""


def sentiment(label: str, ratio_of) -> str:
    counts, shares = [], []
    for cohort, test in PUBLISHED.items():
        for name, text in LABELS.items():
            counts.append(f"{n_if(f'{test} AND {label} = {quoted(text)}')} AS {cohort}_{name}")
            total = " + ".join(f"{cohort}_{other}" for other in LABELS)
            shares.append(f"{ratio_of(f'{cohort}_{name}', f'({total})')} AS {cohort}_{name}_pct")
    joined = ",\n         ".join(counts)
    return f"""
SELECT *, {', '.join(shares)} FROM (
  SELECT job_id, COUNT(*) AS total_analyzed,
         {joined}
  FROM an GROUP BY job_id)"""


COMBINED = f"""
p AS (SELECT job_id, COUNT(*) AS total_reviews, COALESCE(AVG(bucket), 0.0e0) AS avg_rating FROM b GROUP BY job_id),
s AS ({sentiment('sentiment', pct)}),
cb AS (
  SELECT p.job_id, total_reviews, total_analyzed AS analyzed_reviews,
         {pct('total_analyzed', 'total_reviews')} AS analysis_coverage, avg_rating,
         list_extract(['{POS}', '{NEG}', '{NEU}'], list_position(
           [all_positive_pct, all_negative_pct, all_neutral_pct],
           list_max([all_positive_pct, all_negative_pct, all_neutral_pct]))) AS dominant_sentiment,
         avg_rating * all_positive_pct / 100.0e0 AS sentiment_rating_score
  FROM p JOIN s ON p.job_id = s.job_id)"""

ITEMS = f"""
it AS (
  SELECT *, {pct('n', 'SUM(n) OVER (PARTITION BY job_id, keyword)')} AS percentage,
         CAST(RANK() OVER (PARTITION BY job_id, keyword ORDER BY n DESC) AS INTEGER) AS tag_rank
  FROM (SELECT job_id, keyword, tag, COUNT(*) AS n FROM kw GROUP BY job_id, keyword, tag))"""

TAGS = f"""
tg AS (
  SELECT *, {share('n', 'SUM(n) OVER (PARTITION BY job_id, keyword, cohort)')} AS percentage,
         CAST(RANK() OVER (PARTITION BY job_id, keyword, cohort ORDER BY n DESC) AS INTEGER) AS tag_rank
  FROM (SELECT job_id, keyword, cohort, tag, COUNT(*) AS n
        FROM kw JOIN (SELECT 'all' AS cohort UNION ALL SELECT 'coupang_trial' UNION ALL SELECT 'regular') c
          ON CASE c.cohort WHEN 'all' THEN TRUE WHEN 'coupang_trial' THEN trial ELSE NOT trial END
        WHERE NOT empty AND textual
        GROUP BY job_id, keyword, cohort, tag))"""

TOP = f"""
tp AS (
  SELECT * FROM (
    SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY job_id ORDER BY total DESC, keyword) AS INTEGER) AS keyword_rank
    FROM (SELECT job_id, keyword, COUNT(*) AS total FROM kw WHERE NOT empty AND textual GROUP BY job_id, keyword))
  WHERE keyword_rank <= {S.TOP_KEYWORDS})"""

PAIRS = f"""
jn AS (
  SELECT t.*, a.ts AS analysis_ts, a.sentiment, a.summary
  FROM tr t JOIN an a ON a.job_id = t.job_id AND a.review_id = t.review_id
   AND a.ts BETWEEN t.ts - INTERVAL '{S.JOIN_WITHIN_SECONDS}' SECOND AND t.ts + INTERVAL '{S.JOIN_WITHIN_SECONDS}' SECOND)"""

HOURS = """
th AS (SELECT job_id, date_trunc('hour', ts) AS window_start, COUNT(*) AS n FROM tr GROUP BY ALL),
ah AS (SELECT job_id, date_trunc('hour', ts) AS window_start, COUNT(*) AS n FROM an GROUP BY ALL)"""

KST = "strftime({ts} + INTERVAL '9' HOUR, '%Y-%m-%dT%H:%M:%S') || '+09:00'"
UTC = (
    "strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN '' "
    "WHEN epoch_us({ts}) % 1000 = 0 THEN '.' || left(strftime({ts}, '%f'), 3) "
    "ELSE '.' || strftime({ts}, '%f') END || 'Z'"
)


def message(job, step, status, expected, actual, ts, stamp, error="") -> str:
    text = stamp.format(ts=ts)
    return (
        f"'{{\"job_id\":\"' || {job} || COALESCE('\",\"step\":\"' || {step}, '') || '\",\"status\":\"' || {status} || "
        f"'\",\"expected_count\":' || {expected} || ',\"actual_count\":' || {actual} || "
        f"',\"timestamp\":\"' || {text} || '\",\"metadata\":{{\"processing_time\":0.0,"
        f"\"worker_id\":\"tallyloom-worker\",\"batch_id\":\"batch-' || CAST(epoch_us({ts}) // 1000 AS VARCHAR) || "
        f"'\",\"server_info\":\"tallyloom\"}}{error}}}'"
    )


def events_sql(as_of: str | None) -> str:
    late = ""
    if as_of:
        late = f"""
UNION ALL
SELECT job_id || '|timeout', job_id, 'aggregation', 'failed', expected_count, CAST(0 AS BIGINT) FROM lg2
WHERE NOT aggregation_done AND collected_at + INTERVAL '{S.JOB_TIMEOUT_MINUTES}' MINUTE <= TIMESTAMP '{as_of}'"""
    return f"""
SELECT job_id || '|transform' AS event_key, job_id, 'transform' AS step, 'done' AS status, expected_count,
       transform_count AS actual_count FROM lg2 WHERE transform_done
UNION ALL
SELECT job_id || '|analysis', job_id, 'analysis', 'done', expected_count, analysis_count FROM lg2 WHERE analysis_done
UNION ALL
SELECT job_id || '|aggregation', job_id, 'aggregation', 'done', expected_count, min_count FROM lg2
WHERE aggregation_done{late}"""


def complete(counts: str) -> str:
    return f"""
SELECT c.job_id, c.n AS actual_count, expected_count, c.n >= expected_count AS is_complete,
       c.n = expected_count AS exact_match
FROM {counts} c JOIN ctl ON c.job_id = ctl.job_id"""


def numbers(source: str, parts: dict[str, str]) -> str:
    """Columns of one row per job as rows ``(job_id, part, value)``."""
    names = ", ".join(quoted(part) for part in parts)
    values = ", ".join(f"CAST({value} AS DOUBLE)" for value in parts.values())
    return f"SELECT job_id, unnest([{names}]) AS part, unnest([{values}]) AS value FROM ({source})"


REVIEW_FIGURES = {
    f"transform_stats.{name}": column
    for name, column in {
        "total_reviews": "total_reviews", "valid_reviews": "valid_reviews", "empty_reviews": "empty_reviews",
        "coupang_trial_reviews": "trial_reviews", "avg_rating": "avg_rating",
        "avg_rating_excluding_empty": "avg_rating_excluding_empty", "avg_rating_coupang_trial": "avg_rating_trial",
        "avg_rating_regular": "avg_rating_regular",
    }.items()
}


def star_figures(groups: dict[str, str]) -> dict[str, str]:
    return {f"rating_distribution.{c}.{star}": f"stars_{c}_{star}" for c in groups for star in S.STARS}


LABEL_FIGURES = {
    f"sentiment.{c}.{text}{end}": f"{c}_{name}{end}" for c in PUBLISHED for name, text in LABELS.items() for end in ("", "_pct")
}
TYPED_LABEL_FIGURES = {
    f"{c}_sentiment.{name}{end.replace('_pct', 'Pct')}": f"{c}_{name}{end}" for c in PUBLISHED for name in LABELS for end in ("", "_pct")
}
COMBINED_FIGURES = {
    "combined_stats.total_reviews": "total_reviews", "combined_stats.analyzed_reviews": "total_analyzed",
    "combined_stats.analysis_coverage": "analysis_coverage", "combined_stats.avg_rating": "avg_rating",
    "combined_stats.sentiment_rating_correlation": "sentiment_rating_score",
}
TYPED_SENTIMENT = sentiment(f"(CASE WHEN sentiment IN ('{POS}', '{NEG}') THEN sentiment ELSE '{NEU}' END)", share)

LEDGER_TABLES = (REVIEWS, ANALYSES, COLLECTED, COUNTS, LEDGER)

SQL: dict[str, str] = {
    # --- parsing
    "normalize_transform": with_tables(
        """SELECT job_id, review_id, ts, redelivery, rating, valid, empty, trial, event_type AS title,
       CAST(FLOOR(value) AS INTEGER) AS sales_price, CAST(EXTRACT(year FROM ts) AS INTEGER) AS year,
       props AS clean_text FROM tr""", REVIEWS),
    "rating_coalesce": with_tables("SELECT job_id, review_id, redelivery, rating, own_rating FROM tr", REVIEWS),
    "coerce_flags": with_tables("SELECT job_id, review_id, redelivery, valid, empty, trial FROM tr", REVIEWS),
    "flatten_analysis": with_tables(
        "SELECT job_id, review_id, ts, sentiment, summary, trial FROM an", ANALYSES),
    "flatten_array": with_tables("""
SELECT job_id, review_id, rating, l_extendedprice FROM bm WHERE l_linestatus = 'F'
UNION ALL
SELECT job_id, review_id || '-r', l_tax, l_extendedprice FROM bm
WHERE l_linestatus = 'F' AND l_returnflag = 'R'""", BATCHES),
    "first_review": with_tables("SELECT job_id, review_id, rating, l_extendedprice FROM bm", BATCHES),
    "first_analysis": with_tables(f"""
SELECT '' AS job_id, review_id, ts, sentiment FROM an
UNION ALL
SELECT CASE event_id % 5 WHEN 3 THEN '' WHEN 4 THEN '{S.ERROR_JOB}' ELSE '{S.UNKNOWN_JOB}' END,
       CASE event_id % 5 WHEN 3 THEN 'r' || event_id WHEN 4 THEN '{S.ERROR_JOB}' ELSE '{S.UNKNOWN_JOB}' END,
       ts + (event_id % 181) * INTERVAL '1' SECOND, CASE event_id % 5 WHEN 3 THEN 'odd' END
FROM events WHERE event_type = 'error'""", ANALYSES),
    "valid_records": "SELECT doc_id FROM documents WHERE lang NOT IN ('de', 'es')",
    "quarantine": "SELECT doc_id, 'not a JSON object' AS reason FROM documents WHERE lang IN ('de', 'es')",
    "parse_object": """
SELECT doc_id, CAST(CASE WHEN lang IN ('de', 'es') THEN 0 ELSE 6 END AS INTEGER) AS fields,
       CASE WHEN lang NOT IN ('de', 'es') THEN source END AS job_id FROM documents""",
    "encode_json": "SELECT doc_id, md5(text) AS text_md5, lang, n_chars FROM documents",
    "extract_job_id": "SELECT doc_id, CASE WHEN lang IN ('de', 'es') THEN '' ELSE source END AS job_id FROM documents",
    "valid_control": with_tables("SELECT job_id AS key, ts, complete AS is_valid FROM lg", LOG),
    "control_key": with_tables("SELECT job_id, ts, expected_count FROM ctl", COLLECTED),
    "explode_keywords": with_tables(
        "SELECT job_id, keyword, tag, COUNT(*) AS n FROM kw GROUP BY ALL", REVIEWS, KEYWORDS),
    # --- scalars
    "rating_bucket": with_tables(f"SELECT review_id, rating, {stars('rating')} AS bucket FROM li", LINES),
    "cohorts": with_tables(f"""
SELECT job_id, cohort, COUNT(*) AS n FROM (
  {' UNION ALL '.join(f"SELECT job_id, '{name}' AS cohort FROM tr WHERE {test}" for name, test in TYPED.items())}
) GROUP BY ALL""", REVIEWS),
    "composite_key": with_tables(
        "SELECT job_id || '|' || review_id AS event_key, job_id AS job_part FROM li", LINES),
    "kst_iso": f"SELECT event_id, {KST.format(ts='ts')} AS kst FROM events",
    "utc_iso": f"SELECT event_id, {UTC.format(ts='ts')} AS utc FROM events",
    "safe_double": """
SELECT doc_id, COALESCE(TRY_CAST(v AS DOUBLE), 0.0e0) AS number
FROM (SELECT doc_id, CASE lang WHEN 'en' THEN CAST(n_chars / 4.0e0 AS VARCHAR) WHEN 'fr' THEN source END AS v
      FROM documents)""",
    "pct": with_tables(
        f"SELECT job_id, {pct(n_if('trial'), n_if('empty'))} AS trial_per_empty FROM li GROUP BY job_id", LINES),
    "dominant_sentiment": with_tables("SELECT job_id, dominant_sentiment FROM cb", REVIEWS, ANALYSES, bucketed("tr"), COMBINED),
    "sentiment_rating_score": with_tables("SELECT job_id, sentiment_rating_score FROM cb", REVIEWS, ANALYSES, bucketed("tr"), COMBINED),
    "step_timeout": with_tables("""
SELECT step, COUNT(*) AS messages, CAST(MAX(CASE step WHEN 'collection' THEN 60 WHEN 'transform' THEN 30
  WHEN 'analysis' THEN 45 WHEN 'aggregation' THEN 15 ELSE 30 END * 60000) AS BIGINT) AS timeout_ms
FROM lg GROUP BY step""", LOG),
    "control_message": with_tables(
        f"SELECT job_id, {message('job_id', quoted('transform'), quoted('done'), 'expected_count', 'expected_count', 'ts', KST)} AS message FROM ctl",
        COLLECTED),
    "failure_message": with_tables(
        "SELECT job_id, " + message("job_id", "step", "'failed'", "expected_count", "actual_count", "ts", KST,
                                    error=',"error_message":"step failed"') + " AS message FROM lg WHERE status = 'failed'", LOG),
    "timeout_message": with_tables(
        "SELECT job_id, " + message("job_id", "step", "'timeout'", "expected_count", "actual_count", "ts", UTC,
                                    error=f',"error_message":"{S.TIMEOUT_TEXT}"') + " AS message FROM lg WHERE status = 'timeout'", LOG),
    # --- reviews
    "latest_by_key": with_tables("""
SELECT job_id, step, ts, status, expected_count, actual_count FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY job_id, step
    ORDER BY ts DESC, expected_count DESC, actual_count DESC, status DESC) AS rn FROM lg) WHERE rn = 1""", LOG),
    "latest_review": with_tables("""
SELECT job_id, review_id, ts, rating, trial, empty, valid, l_partkey, l_extendedprice FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY job_id, review_id
    ORDER BY ts DESC, l_partkey DESC, l_extendedprice DESC, rating DESC, trial DESC, empty DESC, valid DESC) AS rn
  FROM li) WHERE rn = 1""", LINES),
    "join_reviews": with_tables("""
SELECT job_id, review_id, ts, redelivery, analysis_ts, rating, event_type AS title, sentiment, summary
FROM jn""", REVIEWS, ANALYSES, PAIRS),
    "join_missing_ids": with_tables("""
SELECT job_id, review_id, ts, redelivery, analysis_ts, rating, event_type AS title, sentiment, summary
FROM jn WHERE event_id % 7 <> 0""", REVIEWS, ANALYSES, PAIRS),
    "joined_rows": with_tables(f"""
SELECT job_id, review_id,
       '{{' || CASE WHEN event_type <> 'view'
                   THEN '"배송":"' || CASE WHEN value < 20 THEN 'fast' ELSE 'slow' END || '",' ELSE '' END
         || '"빈값":"","속성-' || k || '":"있음","점수":' || CAST(FLOOR(value) AS BIGINT) % 3
         || ',"품질":"' || event_type || '"}}' AS keywords,
       rating, props AS clean_text, summary, sentiment,
       CAST(NULL AS VARCHAR) AS product_id, event_type AS title, CAST(NULL AS VARCHAR) AS category,
       CAST(NULL AS INTEGER) AS review_count, CAST(FLOOR(value) AS INTEGER) AS sales_price,
       CAST(NULL AS INTEGER) AS final_price, CAST(NULL AS VARCHAR) AS review_date,
       CAST(NULL AS VARCHAR) AS review_text, CAST(NULL AS INTEGER) AS review_help_count,
       CAST(NULL AS VARCHAR) AS crawled_at, CAST(trial AS INTEGER) AS is_coupang_trial,
       CAST(empty AS INTEGER) AS is_empty_review, CAST(NULL AS INTEGER) AS is_valid_rating,
       CAST(NULL AS INTEGER) AS is_valid_date, CAST(NULL AS INTEGER) AS has_content,
       CASE WHEN event_id % 11 = 0 THEN CAST(0 AS INTEGER) WHEN event_id % 2 = 0 THEN CAST(1 AS INTEGER) END AS is_valid,
       CASE WHEN event_id % 11 = 0 THEN 'rating' ELSE '' END AS invalid_reason,
       CAST(EXTRACT(year FROM ts) AS INTEGER) AS year,
       CAST(NULL AS INTEGER) AS month, CAST(NULL AS INTEGER) AS day, CAST(NULL AS INTEGER) AS quarter,
       CAST(NULL AS VARCHAR) AS yyyymm, CAST(NULL AS VARCHAR) AS yyyymmdd, CAST(NULL AS VARCHAR) AS weekday
FROM jn""", REVIEWS, ANALYSES, PAIRS),
    "joined_job_stats": with_tables(f"""
SELECT job_id, COUNT(*) AS joined_rows, {ratio('SUM(rating)', 'COUNT(*)')} AS avg_rating,
       {', '.join(f"{n_if(f'sentiment = {quoted(text)}')} AS {name}" for name, text in LABELS.items())},
       {ratio('CAST(SUM(epoch_us(analysis_ts) - epoch_us(ts)) AS DOUBLE)', '(COUNT(*) * 1000000)')} AS avg_lag_seconds
FROM jn GROUP BY job_id""", REVIEWS, ANALYSES, PAIRS),
    # --- profiles
    "transform_profile": with_tables(profile("b"), REVIEWS, bucketed("tr")),
    "transform_profile_lines": with_tables(profile("b"), LINES, bucketed("li")),
    "transform_profile_texts": with_tables(profile("b"), TEXTS, bucketed("dc")),
    "rating_distribution": with_tables(histogram(PUBLISHED, "tr"), REVIEWS, bucketed("tr")),
    "transform_stats": with_tables(
        f"SELECT job_id, {stats_columns()} FROM b GROUP BY job_id", REVIEWS, bucketed("tr", "own_rating")),
    "merge_stats": with_tables(
        f"SELECT job_id, {stats_columns(rounded=True)} FROM b GROUP BY job_id", REVIEWS, bucketed("tr", "own_rating")),
    "rating_distribution_4": with_tables(histogram(TYPED, "tr"), REVIEWS, bucketed("tr", "own_rating")),
    "sentiment_profile": with_tables(sentiment("sentiment", pct), ANALYSES),
    "sentiment_stats": with_tables(
        sentiment(f"(CASE WHEN sentiment IN ('{POS}', '{NEG}') THEN sentiment ELSE '{NEU}' END)", share), ANALYSES),
    "keyword_items": with_tables("SELECT job_id, keyword, tag, n, percentage, tag_rank FROM it", REVIEWS, KEYWORDS, ITEMS),
    "keyword_tags": with_tables(
        "SELECT job_id, keyword, cohort, tag, n, percentage, tag_rank FROM tg", REVIEWS, KEYWORDS, TAGS),
    "top_keywords": with_tables("SELECT job_id, keyword, total, keyword_rank FROM tp", REVIEWS, KEYWORDS, TOP),
    "combined_job_stats": with_tables("SELECT * FROM cb", REVIEWS, ANALYSES, bucketed("tr"), COMBINED),
    "job_document": with_tables(f"""
SELECT cb.job_id, {KST.format(ts=f"TIMESTAMP '{AS_OF}'")} AS stamp, cb.total_reviews, cb.avg_rating,
       h.five AS regular_five, h.trials, q.keywords, q.tags, q.tag_total, q.first_tag, q.first_pct, s.all_positive, s.regular_negative_pct,
       cb.analysis_coverage, cb.dominant_sentiment, cb.sentiment_rating_score
FROM cb JOIN s ON cb.job_id = s.job_id
JOIN (SELECT job_id, {n_if('NOT trial AND bucket = 5')} AS five, {n_if('trial')} AS trials FROM b GROUP BY job_id) h
  ON cb.job_id = h.job_id
JOIN (SELECT job_id, CAST(COUNT(DISTINCT keyword) AS INTEGER) AS keywords, CAST(COUNT(*) AS BIGINT) AS tags,
             CAST(SUM(n) AS BIGINT) AS tag_total,
             arg_min(tag, (keyword, -n, tag)) AS first_tag, arg_min(percentage, (keyword, -n, tag)) AS first_pct
      FROM it GROUP BY job_id) q ON cb.job_id = q.job_id""",
        REVIEWS, ANALYSES, KEYWORDS, bucketed("tr"), COMBINED, ITEMS),
    "job_document_spec": with_tables(f"""
SELECT st.job_id, st.avg_rating_excluding_empty, st.stars_empty_review_1, ss.regular_neutral, ss.all_neutral_pct,
       tp.keyword_rank, tp.keyword, l.all_tags, l.coupang_tags, l.all_first, l.all_first_pct
FROM (SELECT job_id, {stats_columns()} FROM b GROUP BY job_id) st
JOIN ({sentiment(f"(CASE WHEN sentiment IN ('{POS}', '{NEG}') THEN sentiment ELSE '{NEU}' END)", share)}) ss
  ON st.job_id = ss.job_id
JOIN tp ON st.job_id = tp.job_id
JOIN (SELECT job_id, keyword,
        string_agg(tag || ':' || n, ',' ORDER BY n DESC, tag) FILTER (WHERE cohort = 'all') AS all_tags,
        COALESCE(string_agg(tag || ':' || n, ',' ORDER BY n DESC, tag) FILTER (WHERE cohort = 'coupang_trial'), '') AS coupang_tags,
        arg_min(tag, (-n, tag)) FILTER (WHERE cohort = 'all') AS all_first,
        arg_min(percentage, (-n, tag)) FILTER (WHERE cohort = 'all') AS all_first_pct
      FROM tg GROUP BY job_id, keyword) l ON l.job_id = tp.job_id AND l.keyword = tp.keyword""",
        REVIEWS, ANALYSES, KEYWORDS, bucketed("tr", "own_rating"), TAGS, TOP),
    "job_document_values": with_tables(
        numbers(
            f"SELECT pr.*, s.* EXCLUDE (job_id), analysis_coverage, sentiment_rating_score "
            f"FROM ({profile('b')}) pr JOIN s ON s.job_id = pr.job_id JOIN cb ON cb.job_id = pr.job_id",
            REVIEW_FIGURES | star_figures(PUBLISHED) | {"total_analyzed": "total_analyzed"} | LABEL_FIGURES | COMBINED_FIGURES),
        REVIEWS, ANALYSES, bucketed("tr"), COMBINED),
    "job_document_tags": with_tables("""
SELECT job_id, keyword, CAST(row_number() OVER (PARTITION BY job_id, keyword ORDER BY n DESC, tag) - 1 AS INTEGER) AS place,
       tag, n, percentage
FROM it WHERE job_id IN (SELECT job_id FROM cb)""", REVIEWS, ANALYSES, KEYWORDS, bucketed("tr"), COMBINED, ITEMS),
    "job_document_spec_values": with_tables(
        numbers(
            f"SELECT st.*, ss.* EXCLUDE (job_id) FROM (SELECT job_id, {stats_columns()} FROM b GROUP BY job_id) st "
            f"JOIN ({TYPED_SENTIMENT}) ss ON ss.job_id = st.job_id",
            REVIEW_FIGURES | star_figures(TYPED) | {"total_analyzed": "total_analyzed"} | TYPED_LABEL_FIGURES),
        REVIEWS, ANALYSES, bucketed("tr", "own_rating")),
    "job_document_spec_tags": with_tables("""
SELECT tg.job_id, keyword_rank, tg.keyword, cohort,
       CAST(row_number() OVER (PARTITION BY tg.job_id, tg.keyword, cohort ORDER BY n DESC, tag) - 1 AS INTEGER) AS place,
       tag, n, percentage
FROM tg JOIN tp ON tg.job_id = tp.job_id AND tg.keyword = tp.keyword
WHERE tg.job_id IN (SELECT job_id FROM an)""", REVIEWS, ANALYSES, KEYWORDS, TAGS, TOP),
    # --- control
    "expected_counts": with_tables("SELECT job_id, expected_count, ts AS collected_at FROM ctl", COLLECTED),
    "collection_done": with_tables(
        "SELECT job_id, ts, expected_count FROM lg WHERE step = 'collection' AND status = 'done'", LOG),
    "step_done": with_tables(
        "SELECT job_id, step, ts FROM lg WHERE step IN ('transform', 'analysis') AND status = 'done'", LOG),
    "step_completion": with_tables("""
SELECT job_id, BOOL_OR(step = 'transform') AS transform_done, BOOL_OR(step = 'analysis') AS analysis_done,
       BOOL_OR(step = 'transform') AND BOOL_OR(step = 'analysis') AS both_done
FROM lg WHERE step IN ('transform', 'analysis') AND status = 'done' GROUP BY job_id""", LOG),
    "step_verdict": with_tables("""
SELECT job_id, step, ts, expected_count,
       CASE WHEN NOT complete THEN 'missing field' WHEN expected_count <> actual_count THEN 'count mismatch' END AS reason,
       CASE WHEN NOT complete OR expected_count <> actual_count THEN 'failed' ELSE status END AS verdict
FROM lg""", LOG),
    "job_step_status": with_tables(
        "SELECT DISTINCT job_id FROM lg WHERE step = 'analysis' AND status = 'failed'", LOG),
    "distinct_counts": with_tables("SELECT job_id, COUNT(DISTINCT review_id) AS n FROM li GROUP BY job_id", LINES),
    "array_counts": with_tables(
        "SELECT job_id, CAST(COUNT(*) FILTER (WHERE l_linestatus = 'F') + "
        "COUNT(*) FILTER (WHERE l_linestatus = 'F' AND l_returnflag = 'R') AS BIGINT) AS n FROM bm GROUP BY job_id", BATCHES),
    "hourly_counts": with_tables(
        "SELECT job_id, window_start, window_start + INTERVAL '1' HOUR AS window_end, n FROM th",
        REVIEWS, ANALYSES, HOURS),
    "closed_windows": with_tables(f"""
SELECT job_id, window_start, window_start + INTERVAL '1' HOUR AS window_end, n FROM th
WHERE window_start + INTERVAL '1' HOUR <= TIMESTAMP '{AS_OF}' - INTERVAL '2' MINUTE""",
        REVIEWS, ANALYSES, HOURS),
    "counts_at_collection": with_tables("""
SELECT job_id, ts AS collected_at, expected_count,
       (SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) FROM th WHERE th.job_id = ctl.job_id
          AND window_start BETWEEN ctl.ts - INTERVAL '1' HOUR AND ctl.ts) AS transform_count,
       (SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) FROM ah WHERE ah.job_id = ctl.job_id
          AND window_start BETWEEN ctl.ts - INTERVAL '1' HOUR AND ctl.ts) AS analysis_count
FROM ctl""", REVIEWS, ANALYSES, COLLECTED, HOURS),
    "transform_complete": with_tables(complete("tc"), REVIEWS, ANALYSES, COLLECTED, COUNTS),
    "analysis_complete": with_tables(complete("ac"), REVIEWS, ANALYSES, COLLECTED, COUNTS),
    "min_counts": with_tables(
        "SELECT tc.job_id, LEAST(tc.n, ac.n) AS n FROM tc JOIN ac ON tc.job_id = ac.job_id", REVIEWS, ANALYSES, COUNTS),
    "ledger": with_tables("SELECT * FROM lg2", *LEDGER_TABLES),
    "aggregation_complete": with_tables(
        "SELECT job_id, expected_count, min_count AS actual_count FROM lg2 WHERE aggregation_done", *LEDGER_TABLES),
    "control_events": with_tables(events_sql(AS_OF), *LEDGER_TABLES),
    "job_timeouts": with_tables(
        f"SELECT * FROM ({events_sql(AS_OF)}) WHERE status = 'failed'", *LEDGER_TABLES),
    "step_timeouts": with_tables(f"""
SELECT job_id, step, 'timeout' AS status, expected_count, actual_count FROM (
  SELECT job_id, 'transform' AS step, 30 AS minutes, transform_done AS done, expected_count,
         COALESCE(transform_count, 0) AS actual_count, collected_at FROM lg2
  UNION ALL SELECT job_id, 'analysis', 45, analysis_done, expected_count, COALESCE(analysis_count, 0), collected_at FROM lg2
  UNION ALL SELECT job_id, 'aggregation', 15, aggregation_done, expected_count, COALESCE(min_count, 0), collected_at FROM lg2)
WHERE NOT done AND collected_at + minutes * INTERVAL '1' MINUTE <= TIMESTAMP '{AS_OF}'""", *LEDGER_TABLES),
    # --- metrics
    "control_metrics": with_tables("SELECT step, status, COUNT(*) AS messages FROM lg GROUP BY step, status", LOG),
    "step_duration": with_tables(f"""
SELECT step, COUNT(*) AS observations, SUM(processing_time) AS seconds, MIN(processing_time) AS shortest,
       MAX(processing_time) AS longest,
       {', '.join(f"{n_if(f'processing_time <= {b}')} AS le_{b}" for b in DURATION_BOUNDS)}
FROM lg GROUP BY step""", LOG),
    "active_jobs": with_tables("""
SELECT step, COUNT(*) FILTER (WHERE before AND NOT this) AS jobs FROM (
  SELECT job_id, 'transform' AS step, BOOL_OR(step = 'collection' AND status = 'done') AS before,
         BOOL_OR(step = 'transform') AS this FROM lg GROUP BY job_id
  UNION ALL SELECT job_id, 'analysis', BOOL_OR(step = 'transform' AND status = 'done'),
         BOOL_OR(step = 'analysis') FROM lg GROUP BY job_id
  UNION ALL SELECT job_id, 'aggregation', BOOL_OR(step = 'analysis' AND status = 'done'),
         BOOL_OR(step = 'aggregation') FROM lg GROUP BY job_id)
GROUP BY step""", LOG),
    "ops_metrics": with_tables(
        "SELECT date_trunc('hour', ts) AS window_start, COUNT(*) AS reviews, COUNT(*) / 3600.0e0 AS reviews_per_second "
        "FROM tr GROUP BY 1", REVIEWS),
    "match_rate": with_tables(f"""
SELECT step, COUNT(*) AS messages, {pct(n_if("status = 'done'"), 'COUNT(*)')} AS completion_rate,
       {pct(n_if("status <> 'done'"), 'COUNT(*)')} AS failure_rate,
       {pct(n_if('expected_count = actual_count'), 'COUNT(*)')} AS match_rate
FROM lg GROUP BY step""", LOG),
    "join_drop_rate": with_tables(f"""
SELECT job_id, COUNT(*) AS reviews, {n_if('NOT met')} AS dropped, {n_if('nameless')} AS without_id,
       {pct(n_if('NOT met'), 'COUNT(*)')} AS drop_rate
FROM (SELECT t.job_id, event_id % 7 = 0 AS nameless, event_id % 7 <> 0 AND EXISTS (
        SELECT 1 FROM an a WHERE a.job_id = t.job_id AND a.review_id = t.review_id
        AND a.ts BETWEEN t.ts - INTERVAL '90' SECOND AND t.ts + INTERVAL '90' SECOND) AS met FROM tr t)
GROUP BY job_id""", REVIEWS, ANALYSES),
}

REACHED = """
firsts AS (
  SELECT 't' AS side, job_id, review_id, MIN(ts) AS ts FROM tr GROUP BY ALL
  UNION ALL SELECT 'a', job_id, review_id, MIN(ts) FROM an GROUP BY ALL),
placed AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY side, job_id ORDER BY ts) AS place FROM firsts),
dn AS (
  SELECT job_id, GREATEST(ctl.ts, MAX(placed.ts)) AS done_at FROM placed JOIN ctl USING (job_id)
  WHERE place = GREATEST(expected_count, 1) GROUP BY job_id, ctl.ts HAVING COUNT(*) = 2)"""
DONE_TABLES = (REVIEWS, ANALYSES, COLLECTED, REACHED)
LATENCY = """
SELECT job_id, TIME_BUCKET(INTERVAL '1' HOUR, done_at) AS window_start, COUNT(*) AS arrivals,
       SUM(waited) / 1e6 AS seconds, MIN(waited) / 1e6 AS shortest, MAX(waited) / 1e6 AS longest,
       """ + ", ".join(f"COUNT(*) FILTER (waited <= {b * 1_000_000}) / CAST(COUNT(*) AS DOUBLE) AS within_{b}" for b in LATENCY_BOUNDS) + """
FROM (SELECT job_id, done_at, EPOCH_US(done_at) - EPOCH_US(ts) AS waited
      FROM (SELECT job_id, ts FROM tr UNION ALL SELECT job_id, ts FROM an) JOIN dn USING (job_id)
      WHERE ts <= done_at AND ts > done_at - INTERVAL '1' DAY)
GROUP BY ALL"""
REMAINING = """
lt AS (SELECT job_id, review_id, MAX(ts) AS ts, ARG_MAX(rating, ts) AS rating, MIN(event_id) AS event_id FROM tr GROUP BY ALL),
gone AS (SELECT 'job-' || user_id AS job_id, 'r' || event_id AS review_id, ts + INTERVAL '500' MILLISECOND AS ts FROM events WHERE event_id % 7 = 0),
rem AS (SELECT job_id, review_id, ts, rating FROM lt WHERE NOT EXISTS (
  SELECT 1 FROM gone WHERE gone.job_id = lt.job_id AND gone.review_id = lt.review_id AND gone.ts >= lt.ts))"""
SQL["latest_by_key_with_deletes"] = with_tables("SELECT * FROM rem", REVIEWS, REMAINING)
SQL["ledger_with_deletes"] = with_tables(
    "SELECT * FROM lg2", REVIEWS, ANALYSES, COLLECTED, REMAINING,
    COUNTS.replace("FROM tr GROUP BY", "FROM rem GROUP BY"), LEDGER)
SQL["active_jobs_over_time"] = with_tables("""
SELECT step, ts, CAST(SUM(SUM(delta)) OVER (PARTITION BY step ORDER BY ts) AS BIGINT) AS active FROM (
  SELECT step, started AS ts, 1 AS delta FROM waits UNION ALL SELECT step, ended, -1 FROM waits WHERE ended IS NOT NULL)
GROUP BY step, ts""", LOG, """
started AS (
  SELECT job_id, CASE step WHEN 'collection' THEN 'transform' WHEN 'transform' THEN 'analysis' ELSE 'aggregation' END AS step, MIN(ts) AS started
  FROM lg WHERE status = 'done' AND step IN ('collection', 'transform', 'analysis') GROUP BY ALL),
waits AS (
  SELECT job_id, step, started, (SELECT MIN(ts) FROM lg WHERE lg.job_id = s.job_id AND lg.step = s.step AND ts >= started) AS ended
  FROM started s)""")
SQL["duration_quantiles"] = with_tables("""
SELECT step, rank, CAST(COUNT(processing_time) AS BIGINT) AS observations, TRUE AS inside
FROM lg, (SELECT UNNEST([0.5e0, 0.9e0, 0.99e0]) AS rank) WHERE step IS NOT NULL AND processing_time IS NOT NULL GROUP BY step, rank""", LOG)
SQL["reviews_on_both_sides"] = with_tables("""
SELECT tc.job_id, tc.n AS transform_count, ac.n AS analysis_count,
  (SELECT COUNT(DISTINCT tr.review_id) FROM tr JOIN an ON tr.job_id = an.job_id AND tr.review_id = an.review_id WHERE tr.job_id = tc.job_id) AS both_count
FROM tc JOIN ac ON tc.job_id = ac.job_id""", REVIEWS, ANALYSES, COUNTS)
SQL["done_events"] = with_tables("SELECT job_id, done_at FROM dn", *DONE_TABLES)
SQL["aggregate_latency"] = with_tables(LATENCY, *DONE_TABLES)

# --- the streaming twins end with what the batch form returns
SQL["stream_join_reviews"] = with_tables("""
SELECT job_id, review_id, ts, analysis_ts, rating, event_type AS title, sentiment, summary
FROM jn""", REVIEWS, ANALYSES, PAIRS)
SQL["stream_hourly_counts"] = with_tables(f"""
SELECT job_id, window_start, window_start + INTERVAL '1' HOUR AS window_end, n FROM th
WHERE window_start + INTERVAL '1' HOUR <= {NEWEST} - INTERVAL '2' MINUTE""", REVIEWS, ANALYSES, HOURS)
SQL["stream_counts_at_collection"] = f"""
SELECT * FROM ({SQL["counts_at_collection"]}) WHERE TIME_BUCKET(INTERVAL '1' HOUR, collected_at) + INTERVAL '62' MINUTE
  <= (SELECT TIME_BUCKET(INTERVAL '1' HOUR, MAX(ts)) FROM events)"""
SQL["stream_aggregate_latency"] = with_tables(f"""
SELECT * FROM ({LATENCY}) WHERE window_start + INTERVAL '1' HOUR
  <= LEAST({NEWEST}, (SELECT MAX(ts) FROM an), (SELECT MAX(done_at) FROM dn)) - INTERVAL '1' DAY""", *DONE_TABLES)
SQL["stream_distinct_counts"] = with_tables("SELECT job_id, n FROM tc", REVIEWS, ANALYSES, COUNTS)
SQL["stream_combined"] = SQL["combined_job_stats"]
SQL["stream_emit_done"] = with_tables(
    f"SELECT event_key, job_id, step, status, expected_count FROM ({events_sql(None)})", *LEDGER_TABLES)
SQL["stream_quarantine"] = """
SELECT '{"results":[{' AS value, ts + (event_id % 181) * INTERVAL '1' SECOND AS ts, 'not a JSON object' AS reason
FROM events WHERE event_type = 'error' AND event_id % 5 = 4"""
SQL["read_sources"] = with_tables("""
SELECT job_id, CAST(SUM(t) AS BIGINT) AS reviews, CAST(SUM(a) AS BIGINT) AS analyses, SUM(rating) AS ratings FROM (
  SELECT job_id, rating, 1 AS t, 0 AS a FROM tr UNION ALL SELECT job_id, 0.0e0, 0, 1 FROM an) GROUP BY job_id""", REVIEWS, ANALYSES)
SQL["stream_job_timeouts"] = SQL["job_timeouts"]
SQL["stream_job_document"] = SQL["job_document"]
SQL["stream_step_timeouts"] = SQL["step_timeouts"]
SQL["frequent_keywords"] = SQL["top_keywords"]
SQL["replayed_ledger"] = SQL["ledger"]
SQL["replayed_document"] = SQL["job_document"]

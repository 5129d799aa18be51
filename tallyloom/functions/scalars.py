"""Scalar rules on ratings, flags, keys, shares and time texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom import schema as S


def variant_as(value: Column, kind: str) -> Column:
    return F.try_variant_get(value, "$", kind)


def present(value: Column) -> Column:
    """True when a VARIANT field is there and not JSON null."""
    return value.isNotNull() & ~F.is_variant_null(value)


def job_id_or_unknown(job_id: Column) -> Column:
    return F.coalesce(F.nullif(job_id, F.lit("")), F.lit(S.UNKNOWN_JOB))


def number_or_zero(value: Column) -> Column:
    """A VARIANT as DOUBLE: numbers, numeric text and booleans; else 0.0."""
    return F.coalesce(variant_as(value, "double"), F.lit(0.0))


def rating_coalesce(*candidates: Column) -> Column:
    """The first candidate that is present decides, even when not numeric."""
    chosen = F
    for candidate in candidates:
        chosen = chosen.when(present(candidate), candidate)
    return number_or_zero(chosen)


def flag_or(value: Column, default: bool) -> Column:
    """A VARIANT as a flag: boolean, number <> 0, or the texts true/false."""
    text = F.trim(variant_as(value, "string"))
    as_text = text != "false" if default else text == "true"
    as_value = F.when(F.schema_of_variant(value) == "STRING", as_text).otherwise(
        variant_as(value, "boolean")
    )
    return F.coalesce(F.when(present(value), as_value), F.lit(default))


def flag_is_one(value: Column) -> Column:
    """True when the VARIANT, cut to a whole number, is 1."""
    return F.floor(number_or_zero(value)) == 1


def rating_bucket(rating: Column) -> Column:
    """Stars 1..5 by rounding half up; null outside that range."""
    stars = F.floor(rating + F.lit(0.5))
    return F.when(stars.between(1, 5), stars.cast("int"))


def safe_double(text: Column) -> Column:
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def pct(part: Column, total: Column) -> Column:
    """100 * part / total, 0.0 for an empty total."""
    return F.coalesce(part * F.lit(100.0) / F.nullif(total.cast("double"), F.lit(0.0)), F.lit(0.0))


def share_pct(part: Column, total: Column) -> Column:
    """part / total * 100: the order of operations the typed statistics use."""
    return F.coalesce(part / F.nullif(total.cast("double"), F.lit(0.0)) * F.lit(100.0), F.lit(0.0))


# The same rules as SQL text, for aggregations with dozens of columns: one text
# costs one call into the JVM, the column form one per operator.


def pct_sql(part: str, total: str) -> str:
    return f"coalesce({part} * 100D / nullif(cast({total} AS double), 0D), 0D)"


def share_pct_sql(part: str, total: str) -> str:
    return f"coalesce({part} / nullif(cast({total} AS double), 0D) * 100D, 0D)"


def mean_or_zero_sql(total: str, n: str) -> str:
    return f"coalesce(cast({total} AS double) / nullif(cast({n} AS double), 0D), 0D)"


def mean_or_zero(total: Column, n: Column) -> Column:
    return F.coalesce(total.cast("double") / F.nullif(n.cast("double"), F.lit(0.0)), F.lit(0.0))


def dominant_sentiment(positive: Column, negative: Column, neutral: Column) -> Column:
    """Largest share; ties go to positive, then negative, then neutral."""
    top = F.greatest(positive, negative, neutral)
    return F.when(positive == top, S.POSITIVE).when(negative == top, S.NEGATIVE).otherwise(S.NEUTRAL)


def sentiment_rating_score(avg_rating: Column, positive_pct: Column) -> Column:
    return avg_rating * positive_pct / F.lit(100.0)


def composite_key(*parts: Column) -> Column:
    return F.concat_ws("|", *parts)


def composite_job(key: Column) -> Column:
    """The job part of a composite key: the text before the first bar."""
    return F.split_part(key, F.lit("|"), F.lit(1))


def strip_quotes(text: Column) -> Column:
    return F.regexp_replace(text, S.OUTER_QUOTES, "")


def control_key(record_key: Column, job_id: Column) -> Column:
    """Payload job id, else the record key, both without outer quotes."""
    return F.coalesce(
        F.nullif(strip_quotes(job_id), F.lit("")),
        F.nullif(strip_quotes(record_key), F.lit("")),
        F.lit(S.UNKNOWN_JOB),
    )


def wall_clock(ts: Column, zone: str) -> Column:
    """The local date and time in a zone, whatever the session zone is."""
    return F.convert_timezone(None, F.lit(zone), ts.cast("timestamp_ntz"))


def kst_iso(ts: Column) -> Column:
    """ISO-8601 text with the Korean offset, whole seconds."""
    text = F.date_format(wall_clock(ts, S.KST_ZONE), "yyyy-MM-dd'T'HH:mm:ss")
    return F.concat(text, F.lit(S.KST_OFFSET))


def utc_iso(ts: Column) -> Column:
    """ISO-8601 UTC text; the fraction has 0, 3 or 6 digits as needed."""
    local = wall_clock(ts, "UTC")
    fraction = F.date_format(local, "SSSSSS")
    tail = (
        F.when(fraction == "000000", F.lit(""))
        .when(fraction.endswith("000"), F.concat(F.lit("."), F.left(fraction, F.lit(3))))
        .otherwise(F.concat(F.lit("."), fraction))
    )
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), tail, F.lit("Z"))


def step_timeout(step: Column) -> Column:
    """Milliseconds a step may take; case does not matter."""
    name = F.lower(step)
    chain = F
    for known, minutes in S.STEP_TIMEOUT_MINUTES.items():
        chain = chain.when(name == known, F.lit(minutes))
    return (chain.otherwise(F.lit(S.DEFAULT_TIMEOUT_MINUTES)) * F.lit(60_000)).cast("bigint")


def older_than(ts: Column, limit_ms: Column, as_of: Column) -> Column:
    """True when ``as_of`` lies at least ``limit_ms`` after ``ts``."""
    return F.unix_micros(as_of) - F.unix_micros(ts) >= limit_ms * F.lit(1000)

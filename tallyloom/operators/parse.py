"""From JSON messages to typed columns.

Each message is parsed once. ``from_json`` reads only the fields a query names,
so unused texts are skipped by the JSON reader instead of being carried along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import schema as S
from tallyloom.functions import codec
from tallyloom.functions import scalars as sc

# Read as VARIANT, because the JSON type matters or may vary between messages.
_AS_VARIANT = {*S.FLAG_FIELDS, *S.RATING_FIELDS, "keywords", "invalid_reason"}


# What a review is judged by, and the message fields each figure needs.
_FIGURES = {
    "rating": S.RATING_FIELDS,
    "own_rating": ("rating",),
    "valid": ("is_valid",),
    "empty": ("is_empty_review",),
    "trial": ("is_coupang_trial",),
}
FIGURES = tuple(_FIGURES)


def parse_transform(
    messages: DataFrame,
    carry: Sequence[str] = (),
    on_error: str = "quarantine",
    value: str = "value",
    figures: Sequence[str] = FIGURES,
) -> DataFrame:
    """Typed reviews from transform messages.

    Keeps every column of ``messages`` but the JSON text and adds ``job_id``,
    ``review_id``, ``rating`` (first of the three rating fields), ``own_rating``
    (the field ``rating`` alone), the booleans ``valid``, ``empty``, ``trial``
    and the pass-through fields named in ``carry``. Counts and joins that need
    none or few of the five figures name those in ``figures``; the JSON reader
    skips the fields behind the others.

    ``on_error='quarantine'`` leaves unreadable messages out (``quarantine``
    returns them); ``'row'`` turns each into a review of job ``error``;
    ``'mark'`` keeps them with their text in the column ``unreadable``, null
    for good messages, so one pass can store both.
    """
    _check(on_error, "quarantine", "row", "mark")
    unknown = set(carry) - set(S.PASS_THROUGH)
    if unknown:
        raise ValueError(f"not fields of a transform message: {sorted(unknown)}")
    fields = {"job_id": "string", "review_id": "string"}
    for name in (*[f for figure in figures for f in _FIGURES[figure]], *carry):
        fields[name] = "variant" if name in _AS_VARIANT else "string"
    parsed = codec.parse_once(messages, value, fields)
    readable = codec.is_readable(F.col("_m"))
    m = lambda name: F.col("_m")[name]

    if on_error == "row":
        job = F.when(readable, sc.job_id_or_unknown(m("job_id"))).otherwise(F.lit(S.ERROR_JOB))
        review = F.when(readable, m("review_id")).otherwise(F.lit(S.ERROR_JOB))
    else:
        if on_error == "quarantine":
            parsed = parsed.filter(readable)
        job, review = sc.job_id_or_unknown(m("job_id")), m("review_id")
    # a missing review id is the empty id, which joins and counts like any other
    review = F.coalesce(review, F.lit(""))

    figure = {
        "rating": lambda: sc.rating_coalesce(*(m(name) for name in S.RATING_FIELDS)),
        "own_rating": lambda: sc.number_or_zero(m("rating")),
        "valid": lambda: sc.flag_or(m("is_valid"), True),
        "empty": lambda: sc.flag_is_one(m("is_empty_review")),
        "trial": lambda: sc.flag_is_one(m("is_coupang_trial")),
    }
    kept = [F.col(c) for c in messages.columns if c != value]
    return parsed.select(
        *kept,
        job.alias("job_id"),
        review.alias("review_id"),
        *(figure[name]().alias(name) for name in figures),
        *(_carried(m(name), name).alias(name) for name in carry),
        *([_unreadable()] if on_error == "mark" else []),
    )


def _check(on_error: str, *known: str) -> None:
    if on_error not in known:
        raise ValueError(f"on_error must be one of {known}, not {on_error!r}")


def _unreadable() -> Column:
    """The text of a message that is no JSON object, else null."""
    return F.when(~codec.is_readable(F.col("_m")), F.coalesce(F.col("_m")[codec.CORRUPT], F.lit(""))).alias("unreadable")


def _carried(field: Column, name: str) -> Column:
    kind = S.JOINED_COLUMNS[name]
    if name == "keywords":
        return field
    if name in _AS_VARIANT:
        return sc.variant_as(field, kind)
    return field if kind == "string" else field.try_cast(kind)


def flatten_analysis(messages: DataFrame, value: str = "value", on_error: str = "quarantine") -> DataFrame:
    """One row per analysis result; results without a job id are left out.

    The results are read as VARIANT, so one odd element does not cost the rest
    of its message. ``on_error='mark'`` adds a row for each unreadable message
    with its text in the column ``unreadable``, null for results.
    """
    _check(on_error, "quarantine", "mark")
    kept = [c for c in messages.columns if c != value]
    mark = on_error == "mark"
    rows = codec.parse_once(messages, value, {"results": "array<variant>"})
    if mark:
        rows = rows.select(*kept, _unreadable(), F.explode_outer("_m.results").alias("_r"))
    else:
        rows = rows.select(*kept, F.explode("_m.results").alias("_r"))
    field = lambda name, kind="string": F.try_variant_get("_r", f"$.{name}", kind)
    trial = F.try_variant_get("_r", "$.is_coupang_trial", "variant")
    return rows.select(
        *kept,
        field("job_id").alias("job_id"),
        F.coalesce(field("review_id"), F.lit("")).alias("review_id"),
        field("sentiment").alias("sentiment"),
        field("summary").alias("summary"),
        sc.flag_is_one(trial).alias("trial"),
        *(["unreadable"] if mark else []),
    ).filter("job_id <> '' OR unreadable IS NOT NULL" if mark else "job_id <> ''")


def flatten_array(
    messages: DataFrame, array: str, with_job_id: bool = True, value: str = "value"
) -> DataFrame:
    """Elements of a named array as VARIANT, next to the id of their message's job.

    With ``with_job_id=False`` the elements keep their own job id.
    """
    kept = [c for c in messages.columns if c != value]
    rows = codec.parse_once(messages, value, {"job_id": "string", array: "array<variant>"}).select(
        *kept,
        F.coalesce(F.col("_m.job_id"), F.lit("")).alias("_parent"),
        F.explode(F.col("_m")[array]).alias("element"),
    )
    own = F.coalesce(F.try_variant_get("element", "$.job_id", "string"), F.lit(""))
    job = F.col("_parent") if with_job_id else own
    return rows.select(
        *kept,
        job.alias("job_id"),
        F.coalesce(F.try_variant_get("element", "$.review_id", "string"), F.lit("")).alias("review_id"),
        "element",
    )


def first_review(messages: DataFrame, value: str = "value") -> DataFrame:
    """The one review a message stands for: itself, or the first of ``reviews``."""
    return _first_element(messages, "reviews", "rating", value)


def first_analysis(messages: DataFrame, value: str = "value") -> DataFrame:
    """The one analysis a message stands for: itself, or the first of ``results``."""
    return _first_element(messages, "results", "sentiment", value)


def _first_element(messages: DataFrame, array: str, mark: str, value: str) -> DataFrame:
    fields = {name: "variant" for name in ("job_id", "review_id", mark, array)}
    kept = [c for c in messages.columns if c != value]
    m = lambda name: F.col("_m")[name]
    text = lambda v: sc.variant_as(v, "string")
    readable = codec.is_readable(F.col("_m"))
    itself = m("review_id").isNotNull() & m(mark).isNotNull()
    first = F.try_variant_get(m(array), "$[0]", "variant")
    listed = first.isNotNull()

    def pick(own: Column, element: Column, fallback: bool) -> Column:
        other = F.lit(S.UNKNOWN_JOB) if fallback else F.lit(None).cast("string")
        error = F.lit(S.ERROR_JOB) if fallback else F.lit(None).cast("string")
        return (
            F.when(~readable, error).when(itself, own).when(listed, element).otherwise(other)
        )

    of_first = lambda name: F.try_variant_get(first, f"$.{name}", "string")
    return codec.parse_once(messages, value, fields).select(
        *kept,
        pick(text(m("job_id")), F.coalesce(text(m("job_id")), F.lit("")), True).alias("job_id"),
        pick(text(m("review_id")), of_first("review_id"), True).alias("review_id"),
        pick(text(m(mark)), of_first(mark), False).alias(mark),
    )


def valid_records(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages whose value is a JSON object."""
    return _marked(messages, value).filter(codec.is_readable(F.col("_m"))).drop("_m")


def quarantine(messages: DataFrame, value: str = "value") -> DataFrame:
    """The complement of ``valid_records``, with the reason, for reprocessing."""
    blank = F.coalesce(F.trim(F.col(value)), F.lit("")) == ""
    reason = F.when(blank, F.lit("empty")).otherwise(F.lit("not a JSON object"))
    return (
        _marked(messages, value)
        .filter(~codec.is_readable(F.col("_m")))
        .withColumn("reason", reason)
        .drop("_m")
    )


def _marked(messages: DataFrame, value: str) -> DataFrame:
    copy = messages.withColumn("_text", F.col(value))
    return codec.parse_once(copy, "_text", {"job_id": "string"})


def parse_control(
    messages: DataFrame, key: str | None = None, value: str = "value", on_error: str = "quarantine"
) -> DataFrame:
    """Typed control messages; unreadable ones are left out or, with
    ``on_error='mark'``, kept with their text in the column ``unreadable``.

    ``job_id`` falls back to the record key named by ``key``.
    """
    fields = {
        "job_id": "string",
        "step": "string",
        "status": "string",
        "expected_count": "variant",
        "actual_count": "variant",
        "timestamp": "string",
        "error_message": "string",
        "metadata": "variant",
    }
    m = lambda name: F.col("_m")[name]
    record_key = F.col(key) if key else F.lit(None).cast("string")
    count = lambda name: F.coalesce(
        sc.number_or_zero(m(name)).try_cast("bigint"), F.lit(0).cast("bigint")
    )
    _check(on_error, "quarantine", "mark")
    mark = on_error == "mark"
    kept = [c for c in messages.columns if c not in (value, key)]
    parsed = codec.parse_once(messages, value, fields)
    return (
        (parsed if mark else parsed.filter(codec.is_readable(F.col("_m"))))
        .select(
            *kept,
            *([_unreadable()] if mark else []),
            sc.control_key(record_key, m("job_id")).alias("job_id"),
            m("step").alias("step"),
            m("status").alias("status"),
            count("expected_count").alias("expected_count"),
            count("actual_count").alias("actual_count"),
            m("timestamp").alias("sent_at"),
            m("error_message").alias("error_message"),
            F.try_variant_get(m("metadata"), "$.processing_time", "double").alias("processing_time"),
        )
    )


def valid_control(messages: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``is_valid``: all six required fields are there, null values included."""
    fields = codec.parse_object(F.col(value))
    return messages.withColumn(
        "is_valid",
        F.forall(
            F.array(*(F.lit(name) for name in S.CONTROL_REQUIRED)),
            lambda name: F.array_contains(F.map_keys(fields), name),
        ),
    )

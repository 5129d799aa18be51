"""Review-level operators: the interval join, latest values, match counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyloom import schema as S

SLICE_SECONDS = 600
_MICROS = 1_000_000


def join_reviews(
    transform: DataFrame,
    analysis: DataFrame,
    within_seconds: int = S.JOIN_WITHIN_SECONDS,
    slice_seconds: int = SLICE_SECONDS,
    ts: str = "ts",
    pair_missing_ids: bool = False,
) -> DataFrame:
    """Every (review, analysis) pair of one job and review at most
    ``within_seconds`` apart, both ends included.

    Rows without a review id stand for no review in common and are left out;
    with ``pair_missing_ids`` they meet as if they were copies of one review,
    all with all.

    The equi-key also holds a time slice: a review lies in one slice, an
    analysis in each slice its interval touches, so a pair meets exactly once
    while the copies of a much repeated review spread over many tasks and, on
    streams, over many partitions of the state.

    Returns the transform columns (``ts`` included), ``analysis_ts`` and the
    analysis texts.
    """
    if not pair_missing_ids:
        transform, analysis = transform.filter(has_id()), analysis.filter(has_id())
    right = analysis.select(
        F.col("job_id"),
        F.col("review_id"),
        F.col(ts).alias("analysis_ts"),
        *[F.col(c) for c in S.ANALYSIS_COLUMNS if c in analysis.columns],
    )
    span = F.expr(f"INTERVAL {int(within_seconds)} SECONDS")
    texts = [c for c in right.columns if c not in ("job_id", "review_id", "analysis_ts")]
    t = transform.withColumn("_slice", slice_of(F.col(ts), slice_seconds)).alias("t")
    right = right.withColumn(
        "_slice", F.explode(slices_within(F.col("analysis_ts"), within_seconds, slice_seconds))
    )
    a = right.alias("a")
    on = (
        (F.col("t._slice") == F.col("a._slice"))
        & (F.col("t.job_id") == F.col("a.job_id"))
        & (F.col("t.review_id") == F.col("a.review_id"))
        & (F.col("a.analysis_ts") >= F.col(f"t.{ts}") - span)
        & (F.col("a.analysis_ts") <= F.col(f"t.{ts}") + span)
    )
    # both sides hold rows, however small what they are parsed from looks to the planner
    return t.join(a.hint("merge"), on, "inner").select(
        *[F.col(f"t.{c}") for c in transform.columns],
        F.col("a.analysis_ts"),
        *[F.col(f"a.{c}") for c in texts],
    )


def has_id() -> Column:
    return F.col("review_id") != ""


def _slice_start(micros: Column, slice_seconds: int) -> Column:
    """Whole-number arithmetic: exact for any time, also before 1970."""
    return micros - F.pmod(micros, F.lit(slice_seconds * _MICROS))


def slice_of(ts: Column, slice_seconds: int) -> Column:
    """The slice a time lies in, named by its start in microseconds."""
    return _slice_start(F.unix_micros(ts), slice_seconds)


def slices_within(ts: Column, within_seconds: int, slice_seconds: int) -> Column:
    """All slices that the interval ``ts`` +- ``within_seconds`` touches."""
    micros, reach = F.unix_micros(ts), F.lit(within_seconds * _MICROS)
    return F.sequence(
        _slice_start(micros - reach, slice_seconds),
        _slice_start(micros + reach, slice_seconds),
        F.lit(slice_seconds * _MICROS).cast("bigint"),
    )


def joined_rows(joined: DataFrame) -> DataFrame:
    """The published row: all joined columns in their fixed order.

    Fields the input never carried come out as nulls of their type.
    """
    have = set(joined.columns)
    return joined.select(
        *[
            (F.col(name) if name in have else F.lit(None).cast(kind)).alias(name)
            for name, kind in S.JOINED_COLUMNS.items()
        ]
    )


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key. ``order`` must rank the rows of a key completely.

    ``max_by`` merges map-side, so copies of one key shrink before the shuffle.
    """
    values = [c for c in df.columns if c not in keys]
    latest = F.max_by(F.struct(*values), F.struct(*order))
    return df.groupBy(*keys).agg(latest.alias("_v")).select(*keys, "_v.*")


def latest_with_deletes(df: DataFrame, deletions: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key, without the keys whose last message deletes them.

    ``deletions`` has the keys and the columns of ``order``: messages without a
    value. A row after a deletion brings its key back; of a row and a deletion
    of equal order the deletion counts. What is counted from the result has
    forgotten the deleted keys as well.
    """
    gone = deletions.select(*keys, *order, F.lit(True).alias("_gone"))
    both = df.withColumn("_gone", F.lit(False)).unionByName(gone, allowMissingColumns=True)
    return latest_by_key(both, keys, [*order, "_gone"]).filter(~F.col("_gone")).drop("_gone")


def latest_review(reviews: DataFrame, order: Sequence[str] = ("ts",)) -> DataFrame:
    return latest_by_key(reviews, ["job_id", "review_id"], order)


def match_counts(
    transform: DataFrame,
    analysis: DataFrame,
    within_seconds: int = S.JOIN_WITHIN_SECONDS,
    slice_seconds: int = SLICE_SECONDS,
    ts: str = "ts",
    pair_missing_ids: bool = False,
) -> DataFrame:
    """How many analyses each review meets, without building the pairs.

    Both sides are first counted per (job, review, slice, instant); a running
    total over the instants of one slice then gives, for each review, the
    analyses up to its interval's end less those before its start. The work is
    linear in the rows, where the pairs of a much repeated review would be
    quadratic. A window partition holds one entry per distinct instant of one
    review within one slice: 600,000 at most for millisecond record times.
    Reviews without id match nothing, unless ``pair_missing_ids``, and are
    counted in one row per job.

    Returns one row per review instant: ``reviews`` and ``rating_sum`` over the
    copies at that instant and, for each single copy, ``matches``, ``positive``,
    ``negative``, ``neutral`` and ``lag_micros`` (analysis time less review
    time, summed over the matches).
    """
    zero = F.lit(0).cast("bigint")
    micros = F.unix_micros(F.col(ts))
    anonymous = transform.filter(~has_id())
    if not pair_missing_ids:
        transform, analysis = transform.filter(has_id()), analysis.filter(has_id())
    left = transform.select(
        "job_id",
        "review_id",
        slice_of(F.col(ts), slice_seconds).alias("_slice"),
        micros.alias("_at"),
        F.lit(True).alias("_review"),
        F.col("rating").alias("rating"),
        F.lit(None).cast("string").alias("sentiment"),
    )
    right = analysis.select(
        "job_id",
        "review_id",
        F.explode(slices_within(F.col(ts), within_seconds, slice_seconds)).alias("_slice"),
        micros.alias("_at"),
        F.lit(False).alias("_review"),
        F.lit(0.0).alias("rating"),
        F.col("sentiment"),
    )
    analysed = ~F.col("_review")
    per_instant = (
        left.unionByName(right)
        .groupBy("job_id", "review_id", "_slice", "_at")
        .agg(
            F.count_if("_review").alias("reviews"),
            F.coalesce(F.sum(F.when(F.col("_review"), F.col("rating"))), F.lit(0.0)).alias("rating_sum"),
            F.count_if(analysed).alias("_n"),
            *[
                F.count_if(analysed & (F.col("sentiment") == label)).alias(f"_{i}")
                for i, label in enumerate(S.SENTIMENTS)
            ],
        )
        .withColumn("_off", F.col("_n") * (F.col("_at") - F.col("_slice")))
    )
    reach = within_seconds * _MICROS
    ordered = W.partitionBy("job_id", "review_id", "_slice").orderBy("_at")
    upto = ordered.rangeBetween(W.unboundedPreceding, reach)
    before = ordered.rangeBetween(W.unboundedPreceding, -reach - 1)

    def within(column: str) -> Column:
        return F.sum(column).over(upto) - F.coalesce(F.sum(column).over(before), zero)

    matched = (
        per_instant.select(
            "job_id",
            "review_id",
            "_slice",
            "_at",
            "reviews",
            "rating_sum",
            within("_n").alias("matches"),
            within("_0").alias("positive"),
            within("_1").alias("negative"),
            within("_2").alias("neutral"),
            within("_off").alias("_offsets"),
        )
        .filter("reviews > 0")
        .withColumn(
            # distance in time of all matches, analysis minus review
            "lag_micros",
            F.col("_offsets") - F.col("matches") * (F.col("_at") - F.col("_slice")),
        )
        .drop("_offsets", "_slice", "_at")
    )
    if pair_missing_ids:
        return matched
    alone = anonymous.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("reviews"), F.coalesce(F.sum("rating"), F.lit(0.0)).alias("rating_sum")
    )
    none = {name: zero for name in ("matches", "positive", "negative", "neutral", "lag_micros")}
    return matched.unionByName(alone.withColumns({"review_id": F.lit(""), **none}))

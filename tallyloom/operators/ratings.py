"""Per-job review counts, rating averages and star histograms.

Two definitions exist side by side and disagree on purpose. The *published*
profile averages the rounded stars and splits all reviews into trial and
regular. The *typed* statistics average the raw ratings and keep empty reviews
apart.

Every figure here follows from the *cells* of a job: how many reviews share
stars and flags, at most 96 cells per job. Reviews are counted into cells
first, one counter per row and merged map-side, so a job of any size shuffles
as a handful of rows; the many conditional sums then run over cells only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import schema as S
from tallyloom.functions import scalars as sc


# Predicates on the flags of a review, as SQL.
PUBLISHED = {"all": "true", "coupang_trial": "trial", "regular": "NOT trial"}
TYPED = {
    "all": "true",
    "coupang_trial": "NOT empty AND trial",
    "regular": "NOT empty AND NOT trial",
    "empty_review": "empty",
}


def cohorts(reviews: DataFrame) -> DataFrame:
    """Long form: one row per review and typed cohort it belongs to."""
    tags = F.array_compact(F.array(*(F.expr(f"CASE WHEN {test} THEN '{name}' END") for name, test in TYPED.items())))
    return reviews.withColumn("cohort", F.explode(tags))


def _count_of(test: str, name: str) -> Column:
    """Reviews in the cells that pass the test."""
    return F.expr(f"coalesce(sum(CASE WHEN {test} THEN _n END), 0)").alias(name)


def _mean(total: str, n: str, test: str, name: str) -> Column:
    case = lambda value: f"sum(CASE WHEN {test} THEN {value} END)"
    return F.expr(sc.mean_or_zero_sql(case(total), case(n))).alias(name)


def _histogram(groups: Mapping[str, str], prefix: str = "stars") -> list[Column]:
    return [
        _count_of(f"({test}) AND _bucket = {star}", f"{prefix}_{name}_{star}")
        for name, test in groups.items()
        for star in S.STARS
    ]


def histogram_names(groups, prefix: str = "stars") -> list[str]:
    return [f"{prefix}_{name}_{star}" for name in groups for star in S.STARS]


def _unpivot_histogram(wide: DataFrame, groups, prefix: str = "stars") -> DataFrame:
    cells = ", ".join(
        f"named_struct('cohort', '{name}', 'stars', {star}, 'n', {prefix}_{name}_{star})"
        for name in groups
        for star in S.STARS
    )
    return wide.select("job_id", F.expr(f"inline(array({cells}))"))


def _cells(reviews: DataFrame, *by: str) -> DataFrame:
    """Counts and rating sums per job, stars and flags.

    On a stream each review stays a cell of its own: Structured Streaming
    chains no second aggregation in update mode.
    """
    bucket = sc.rating_bucket(F.col("rating")).alias("_bucket")
    counted = "_counted" if "_counted" in reviews.columns else F.lit(True).alias("_counted")
    rows = reviews.select("job_id", *by, bucket, counted, "valid", "empty", "trial", "rating")
    if reviews.isStreaming:
        return rows.withColumns({"_n": F.lit(1).cast("bigint"), "_sum": F.col("rating")})
    keys = [c for c in rows.columns if c != "rating"]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum("rating").alias("_sum"))


def transform_profile(reviews: DataFrame, histogram: bool = True) -> DataFrame:
    """Published profile per job. ``avg_rating_excluding_empty`` repeats
    ``avg_rating`` wherever the job has a valid review; ``transform_stats``
    holds the mean that really leaves empty reviews out."""
    starred = lambda test: f"({test}) AND _bucket IS NOT NULL"
    profile = _cells(reviews).groupBy("job_id").agg(
        F.sum("_n").alias("total_reviews"),
        _count_of("valid", "valid_reviews"),
        _count_of("empty", "empty_reviews"),
        _count_of("trial", "trial_reviews"),
        _mean("_bucket * _n", "_n", starred("true"), "avg_rating"),
        _mean("_bucket * _n", "_n", starred("trial"), "avg_rating_trial"),
        _mean("_bucket * _n", "_n", starred("NOT trial"), "avg_rating_regular"),
        *(_histogram(PUBLISHED) if histogram else ()),
    )
    return profile.withColumn(
        "avg_rating_excluding_empty",
        F.when(F.col("valid_reviews") > 0, F.col("avg_rating")).otherwise(F.lit(0.0)),
    )


def rating_distribution(reviews: DataFrame) -> DataFrame:
    """Rows (job, cohort, stars, n), published cohorts, zero counts included."""
    wide = _cells(reviews).groupBy("job_id").agg(*_histogram(PUBLISHED))
    return _unpivot_histogram(wide, S.COHORTS)


def _typed(reviews: DataFrame) -> DataFrame:
    """Own rating only; a review without id adds nothing but its job."""
    return reviews.select(
        *[c for c in reviews.columns if c != "rating"],
        F.col("own_rating").alias("rating"),
        (F.col("review_id") != "").alias("_counted"),
    )


_COUNTED = {name: f"_counted AND ({test})" for name, test in TYPED.items()}


def transform_stats(reviews: DataFrame, *by: str, histogram: bool = True) -> DataFrame:
    """Typed statistics per job, or per job and the extra columns ``by``."""
    mean = lambda test, name: _mean("_sum", "_n", f"_counted AND ({test})", name)
    return _cells(_typed(reviews), *by).groupBy("job_id", *by).agg(
        _count_of("_counted", "total_reviews"),
        _count_of("_counted AND valid", "valid_reviews"),
        _count_of("_counted AND empty", "empty_reviews"),
        _count_of("_counted AND trial", "trial_reviews"),
        mean("true", "avg_rating"),
        mean("NOT empty", "avg_rating_excluding_empty"),
        mean("trial", "avg_rating_trial"),
        mean("NOT trial", "avg_rating_regular"),
        *(_histogram(_COUNTED) if histogram else ()),
    )


def rating_distribution_4(reviews: DataFrame) -> DataFrame:
    """Rows (job, cohort, stars, n), typed cohorts, zero counts included."""
    wide = _cells(_typed(reviews)).groupBy("job_id").agg(*_histogram(_COUNTED))
    return _unpivot_histogram(wide, S.COHORTS_WITH_EMPTY)


def merge_stats(stats: DataFrame) -> DataFrame:
    """Rolls ``transform_stats`` rows of parts of a job up to the job.

    Averages merge weighted by the count each of them stands for; counts and
    histogram cells add up.
    """
    total, empty, trial = F.col("total_reviews"), F.col("empty_reviews"), F.col("trial_reviews")
    weights = {
        "avg_rating": total,
        "avg_rating_excluding_empty": total - empty,
        "avg_rating_trial": trial,
        "avg_rating_regular": total - trial,
    }
    counts = ["total_reviews", "valid_reviews", "empty_reviews", "trial_reviews"]
    cells = [c for c in histogram_names(S.COHORTS_WITH_EMPTY) if c in stats.columns]
    return stats.groupBy("job_id").agg(
        *[F.sum(c).alias(c) for c in counts],
        *[
            sc.mean_or_zero(F.sum(F.col(name) * weight), F.sum(weight)).alias(name)
            for name, weight in weights.items()
        ],
        *[F.sum(c).alias(c) for c in cells],
    )

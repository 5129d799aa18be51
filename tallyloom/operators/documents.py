"""Job-level statistics that combine both sides, and the job documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import schema as S
from tallyloom.functions import scalars as sc
from tallyloom.operators import cells as cl
from tallyloom.operators import reviews, sentiment

_COMBINED = (
    "total_reviews",
    "analyzed_reviews",
    "analysis_coverage",
    "avg_rating",
    "dominant_sentiment",
    "sentiment_rating_score",
)


def combine(joined: DataFrame) -> DataFrame:
    """Adds the combined figures to rows that hold both profiles."""
    return joined.withColumns(
        {
            "analyzed_reviews": F.col("total_analyzed"),
            "analysis_coverage": sc.pct(F.col("total_analyzed"), F.col("total_reviews")),
            "dominant_sentiment": sc.dominant_sentiment(
                F.col("all_positive_pct"), F.col("all_negative_pct"), F.col("all_neutral_pct")
            ),
            "sentiment_rating_score": sc.sentiment_rating_score(
                F.col("avg_rating"), F.col("all_positive_pct")
            ),
        }
    )


def combined_job_stats(profile: DataFrame, sentiments: DataFrame) -> DataFrame:
    """Jobs present on both sides. Both inputs are grouped by job already, so
    the join needs no further shuffle."""
    return combine(profile.join(sentiments, "job_id")).select("job_id", *_COMBINED)


def combined_from_tagged(transform: DataFrame, analysis: DataFrame) -> DataFrame:
    """``combined_job_stats`` in one aggregation over the tagged union.

    The form streaming needs: two streaming aggregates cannot be joined in
    update mode, one aggregate over their union can run.
    """
    t = transform.select(
        "job_id", F.lit(True).alias("_review"), sc.rating_bucket(F.col("rating")).alias("_bucket"),
        F.lit(None).cast("string").alias("sentiment"),
    )
    a = analysis.select(
        "job_id", F.lit(False).alias("_review"), F.lit(None).cast("int").alias("_bucket"), "sentiment"
    )
    counts = t.unionByName(a).groupBy("job_id").agg(
        F.count_if("_review").alias("total_reviews"),
        F.count_if(~F.col("_review")).alias("total_analyzed"),
        sc.mean_or_zero(F.sum("_bucket"), F.count("_bucket")).alias("avg_rating"),
        *[
            F.count_if(F.col("sentiment") == label).alias(f"all_{name}")
            for name, label in sentiment.LABELS.items()
        ],
    )
    both = counts.filter("total_reviews > 0 AND total_analyzed > 0")
    total = "(all_positive + all_negative + all_neutral)"
    shares = both.withColumns(
        {f"all_{name}_pct": F.expr(sc.pct_sql(f"all_{name}", total)) for name in sentiment.LABELS}
    )
    return combine(shares).select("job_id", *_COMBINED)


def joined_job_stats(transform: DataFrame, analysis: DataFrame, **interval) -> DataFrame:
    """The joined rows grouped by job, computed from match counts: the pairs
    themselves are never built."""
    per_review = reviews.match_counts(transform, analysis, **interval).filter("matches > 0")
    pairs = F.col("reviews") * F.col("matches")
    weighted = {name: F.sum(F.col("reviews") * F.col(name)) for name in sentiment.LABELS}
    return per_review.groupBy("job_id").agg(
        F.sum(pairs).alias("joined_rows"),
        sc.mean_or_zero(F.sum(F.col("rating_sum") * F.col("matches")), F.sum(pairs)).alias("avg_rating"),
        *[total.alias(name) for name, total in weighted.items()],
        sc.mean_or_zero(F.sum(F.col("reviews") * F.col("lag_micros")), F.sum(pairs) * F.lit(1_000_000))
        .alias("avg_lag_seconds"),
    )


def _stars(cohorts, prefix: str = "") -> Column:
    return F.struct(
        *[
            F.expr(
                "named_struct(" + ", ".join(f"'{star}', {prefix}stars_{c}_{star}" for star in S.STARS) + ")"
            ).alias(c)
            for c in cohorts
        ]
    )


def _review_figures(prefix: str = "") -> list[Column]:
    names = {
        "total_reviews": "total_reviews",
        "valid_reviews": "valid_reviews",
        "empty_reviews": "empty_reviews",
        "coupang_trial_reviews": "trial_reviews",
        "avg_rating": "avg_rating",
        "avg_rating_excluding_empty": "avg_rating_excluding_empty",
        "avg_rating_coupang_trial": "avg_rating_trial",
        "avg_rating_regular": "avg_rating_regular",
    }
    return [F.col(f"{prefix}{column}").alias(name) for name, column in names.items()]


def job_document(cells: DataFrame, stamp: Column) -> DataFrame:
    """One JSON document per job with rows on both sides, published shape;
    ``stamp`` is its time text."""
    rows = combine(cl.job_statistics(cells).filter("total_analyzed > 0"))

    def labels(cohort: str) -> Column:
        counts = [F.col(f"{cohort}_{name}").alias(text) for name, text in sentiment.LABELS.items()]
        shares = [F.col(f"{cohort}_{name}_pct").alias(f"{text}_pct") for name, text in sentiment.LABELS.items()]
        return F.struct(*counts, *shares).alias(cohort)

    document = F.struct(
        F.col("job_id").alias("_id"),
        F.col("job_id"),
        stamp.alias("timestamp"),
        F.struct(*_review_figures()).alias("transform_stats"),
        _stars(S.COHORTS).alias("rating_distribution"),
        "keyword_analysis",
        F.struct(
            "total_analyzed", F.struct(*[labels(c) for c in S.COHORTS]).alias("sentiment_distribution")
        ).alias("analysis_stats"),
        F.struct(
            "total_reviews",
            "analyzed_reviews",
            "analysis_coverage",
            "avg_rating",
            "dominant_sentiment",
            F.col("sentiment_rating_score").alias("sentiment_rating_correlation"),
        ).alias("combined_stats"),
    )
    return rows.select("job_id", F.to_json(document).alias("document"))


def job_document_spec(cells: DataFrame, k: int = S.TOP_KEYWORDS) -> DataFrame:
    """One JSON document per job in the specified shape: typed statistics,
    histogram with empty reviews, tags of the top ``k`` keywords by cohort."""
    top = cl.top_keywords(cells, k)
    jobs = cl.job_statistics(cells, keywords=False).filter("total_analyzed > 0").join(top, "job_id", "left")
    nested = F.coalesce(
        "keyword_analysis", F.from_json(F.lit("[]"), top.schema["keyword_analysis"].dataType)
    ).alias("keyword_analysis")

    def labels(cohort: str) -> Column:
        return F.struct(
            F.col(f"{cohort}_positive").alias("positive"),
            F.col(f"{cohort}_negative").alias("negative"),
            F.col(f"typed_{cohort}_neutral").alias("neutral"),
            *[F.col(f"typed_{cohort}_{name}_pct").alias(f"{name}Pct") for name in sentiment.LABELS],
        ).alias(f"{cohort}_sentiment")

    document = F.struct(
        F.col("job_id"),
        F.struct(
            *_review_figures("typed_"),
            _stars(S.COHORTS_WITH_EMPTY, "typed_").alias("rating_distribution"),
            nested,
        ).alias("transform_stats"),
        F.struct("total_analyzed", *[labels(c) for c in S.COHORTS]).alias("analysis_stats"),
    )
    return jobs.select("job_id", F.to_json(document).alias("document"))

"""Sentiment counts and shares per job, in the published and the typed form.

Results are first counted per job, label and trial flag: eight rows per job at
most, whatever its size. All figures are sums over those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import schema as S
from tallyloom.functions import scalars as sc
from tallyloom.operators.ratings import PUBLISHED

LABELS = {"positive": S.POSITIVE, "negative": S.NEGATIVE, "neutral": S.NEUTRAL}


def _profile(results: DataFrame, label: Column, share) -> DataFrame:
    rows = results.select("job_id", label.alias("_label"), "trial")
    if results.isStreaming:
        cells = rows.withColumn("_n", F.lit(1).cast("bigint"))
    else:
        cells = rows.groupBy("job_id", "_label", "trial").agg(F.count(F.lit(1)).alias("_n"))
    counts = cells.groupBy("job_id").agg(
        F.sum("_n").alias("total_analyzed"),
        *[
            F.expr(f"coalesce(sum(CASE WHEN {test} AND _label = '{name}' THEN _n END), 0)").alias(f"{cohort}_{name}")
            for cohort, test in PUBLISHED.items()
            for name in LABELS
        ],
    )
    return with_shares(counts, share)


def label_name(sentiment: Column, otherwise: str | None = None) -> Column:
    """positive, negative, neutral or the fallback."""
    chosen = F
    for name, text in LABELS.items():
        chosen = chosen.when(sentiment == text, F.lit(name))
    return chosen.otherwise(F.lit(otherwise))


def with_shares(counts: DataFrame, share=sc.pct_sql) -> DataFrame:
    """Adds each label's share of the labels counted in its cohort."""
    columns = [
        f"{share(f'{cohort}_{name}', f'({cohort}_positive + {cohort}_negative + {cohort}_neutral)')}"
        f" AS {cohort}_{name}_pct"
        for cohort in S.COHORTS
        for name in LABELS
    ]
    return counts.selectExpr("*", *columns)


def sentiment_profile(results: DataFrame) -> DataFrame:
    """Published: other or missing sentiments count as analysed only."""
    return _profile(results, label_name(F.col("sentiment")), sc.pct_sql)


def sentiment_stats(results: DataFrame) -> DataFrame:
    """Typed: everything that is neither positive nor negative is neutral."""
    return _profile(results, label_name(F.col("sentiment"), "neutral"), sc.share_pct_sql)

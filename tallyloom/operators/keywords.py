"""Keyword and tag breakdowns.

Counting collapses rows before anything else happens. What remains per keyword
is one row per distinct tag, which a hot keyword may still have very many of;
shares and ranks therefore never put one keyword's tags into one window
partition. They go through ``_ladder``, the table of distinct counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyloom import schema as S
from tallyloom.functions import scalars as sc

# Over so many tasks the tags of one keyword and count are joined with their rank.
SALTS = 16
# Items that a summary of frequent keywords tells apart; its size depends on nothing else.
TRACKED = 512


def explode_keywords(reviews: DataFrame, textual_only: bool = False) -> DataFrame:
    """One row per review and keyword with a non-empty tag.

    Tags that are numbers or booleans count by their text, unless
    ``textual_only``; nulls, objects and arrays are never tags.
    """
    kept = [c for c in reviews.columns if c != "keywords"]
    pairs = sc.variant_as(F.col("keywords"), "map<string,variant>")
    kind = F.schema_of_variant(F.col("_tag"))
    if textual_only:
        usable = kind == "STRING"
    else:
        usable = ~(kind.startswith("OBJECT") | kind.startswith("ARRAY") | (kind == "VOID"))
    return (
        reviews.select(*kept, F.explode(pairs).alias("keyword", "_tag"))
        .filter(usable)
        .select(*kept, "keyword", sc.variant_as(F.col("_tag"), "string").alias("tag"))
        .filter("tag <> ''")
    )


def _ladder(counts: DataFrame, group: Sequence[str], n: str = "n") -> DataFrame:
    """Per group and distinct count: how many rows lie above it, and the total.

    A group of T counted rows has at most sqrt(2 T) distinct counts, so these
    window partitions stay small for any group.
    """
    steps = counts.groupBy(*group, n).agg(F.count(F.lit(1)).alias("_ties"))
    whole = W.partitionBy(*group)
    above = whole.orderBy(F.desc(n)).rowsBetween(W.unboundedPreceding, -1)
    return steps.select(
        *group,
        n,
        (F.coalesce(F.sum("_ties").over(above), F.lit(0)) + 1).cast("int").alias("_rank"),
        F.sum(F.col("_ties") * F.col(n)).over(whole).alias("_total"),
    )


def _ranked_shares(counts: DataFrame, group: Sequence[str], share) -> DataFrame:
    """Adds ``percentage`` of the group's total and ``tag_rank`` (1 = most
    frequent, equal counts share a rank).

    Most tags of a large keyword occur once, so the join key also holds a salt
    of the tag; each step of the ladder is there for every salt. Either side is
    as large as the distinct tags may make it, so neither is ever broadcast.
    """
    salted = counts.withColumn("_salt", F.pmod(F.xxhash64("tag"), F.lit(SALTS)).cast("int"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return (
        salted.join(_ladder(counts, group).withColumn("_salt", salts).hint("merge"), [*group, "n", "_salt"])
        .withColumn("percentage", share(F.col("n"), F.col("_total")))
        .withColumnRenamed("_rank", "tag_rank")
        .drop("_total", "_salt")
    )


def keyword_items(reviews: DataFrame) -> DataFrame:
    """Published breakdown: all reviews, no cohorts, every keyword."""
    counts = (
        explode_keywords(reviews.select("job_id", "keywords"))
        .groupBy("job_id", "keyword", "tag")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return _ranked_shares(counts, ["job_id", "keyword"], sc.pct).select(
        "job_id", "keyword", "tag", "n", "percentage", "tag_rank"
    )


def tag_counts(reviews: DataFrame) -> DataFrame:
    """Tags of non-empty reviews per (job, keyword, tag), by trial flag."""
    texts = explode_keywords(
        reviews.filter(~F.col("empty") & (F.col("review_id") != "")).select("job_id", "trial", "keywords"),
        textual_only=True,
    )
    return texts.groupBy("job_id", "keyword", "tag").agg(
        F.count(F.lit(1)).alias("all"),
        F.count_if("trial").alias("coupang_trial"),
        F.count_if(~F.col("trial")).alias("regular"),
    )


def _by_cohort(counts: DataFrame) -> DataFrame:
    cells = F.array(
        *[F.struct(F.lit(name).alias("cohort"), F.col(f"`{name}`").alias("n")) for name in S.COHORTS]
    )
    return counts.select("job_id", "keyword", "tag", F.inline(cells)).filter("n > 0")


def keyword_tags(reviews: DataFrame) -> DataFrame:
    """Typed breakdown: tag counts, shares and ranks within each cohort."""
    counts = _by_cohort(tag_counts(reviews))
    return _ranked_shares(counts, ["job_id", "keyword", "cohort"], sc.share_pct).select(
        "job_id", "keyword", "cohort", "tag", "n", "percentage", "tag_rank"
    )


def top_keywords(reviews: DataFrame, k: int = S.TOP_KEYWORDS) -> DataFrame:
    """The ``k`` most frequent keywords per job, ties by name.

    The rank filter lets Spark keep only ``k`` rows per job and task before
    the shuffle.
    """
    totals = _texts(reviews).groupBy("job_id", "keyword").agg(F.count(F.lit(1)).alias("total"))
    return _first_k(totals, k)


def _first_k(totals: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("job_id").orderBy(F.desc("total"), "keyword")
    return totals.withColumn("keyword_rank", F.row_number().over(order)).filter(
        F.col("keyword_rank") <= k
    )


def _texts(reviews: DataFrame, *carry: str) -> DataFrame:
    kept = reviews.filter(~F.col("empty") & (F.col("review_id") != "")).select("job_id", *carry, "keywords")
    return explode_keywords(kept, textual_only=True)


def keyword_summaries(reviews: DataFrame, *by: Column, tracked: int = TRACKED) -> DataFrame:
    """A bounded frequent-items summary of the keywords of each job, and of each of ``by``, with the rows it saw.

    The summaries of batches, days or partitions merge (``merged_summaries``).
    """
    texts = _texts(reviews, *by)
    keys = [c for c in texts.columns if c not in ("keyword", "tag")]
    return texts.groupBy(*keys).agg(
        F.call_function("approx_top_k_accumulate", F.col("keyword"), F.lit(tracked)).alias("summary"),
        F.count(F.lit(1)).alias("seen"),
    )


def merged_summaries(summaries: DataFrame, *keys: str, tracked: int = TRACKED) -> DataFrame:
    merged = F.call_function("approx_top_k_combine", F.col("summary"), F.lit(tracked))
    return summaries.groupBy(*keys).agg(merged.alias("summary"), F.sum("seen").alias("seen"))


def frequent_candidates(summaries: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """``(job_id, keyword, estimate, seen, missed)``: ``missed`` is the most rows a keyword left out can have.

    A summary keeps its items in a map of the next power of two over 4/3 of
    ``tracked``; an estimate is off by at most 3.5 of ``seen`` over that size, and
    an item is left out when it may be no more than that error.
    """
    slots = 1 << (-(-tracked * 4 // 3) - 1).bit_length()
    found = F.call_function("approx_top_k_estimate", F.col("summary"), F.lit(tracked))
    missed = F.floor(F.col("seen") * F.lit(7.0 / slots))
    rows = summaries.select("job_id", "seen", missed.alias("missed"), F.inline_outer(found).alias("keyword", "estimate"))
    return rows.select("job_id", "keyword", "estimate", "seen", "missed")


def frequent_keywords(reviews: DataFrame, summaries: DataFrame, k: int = S.TOP_KEYWORDS, tracked: int = TRACKED) -> DataFrame:
    """``top_keywords`` by way of the summaries of all its reviews, with the same result.

    A second pass counts the candidates alone. That settles a job when its
    ``k``-th candidate has more rows than any keyword left out can have, or when
    the candidates have all rows there are; the keywords of other jobs are
    counted one and all. Rows meet the candidates under a salt, so a keyword of
    a third of all rows is counted in many tasks. No side is broadcast: what the
    planner takes for the size of parsed rows says nothing of them.
    """
    candidates = frequent_candidates(summaries, tracked)
    salt = F.pmod(F.xxhash64("review_id", "ts"), F.lit(SALTS)).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    texts = _texts(reviews, "review_id", "ts")
    asked = candidates.filter("keyword IS NOT NULL").withColumn("_salt", salts)
    met = texts.withColumn("_salt", salt).join(asked.hint("merge"), ["job_id", "keyword", "_salt"])
    parts = met.groupBy("job_id", "keyword", "_salt", "seen", "missed").agg(F.count(F.lit(1)).alias("n"))
    counted = parts.groupBy("job_id", "keyword", "seen", "missed").agg(F.sum("n").alias("total"))
    # at most ``tracked`` rows a job
    settled = (F.get(F.sort_array(F.collect_list("total"), asc=False), k - 1) > F.any_value("missed")) | (
        F.sum("total") == F.any_value("seen")
    )
    jobs = counted.groupBy("job_id").agg(F.coalesce(settled, F.lit(False)).alias("_settled"))
    known = counted.join(jobs.filter("_settled").hint("merge"), "job_id", "left_semi").select("job_id", "keyword", "total")
    # a job whose summary names nothing is open as well
    open_jobs = summaries.select("job_id").join(jobs.filter("_settled").hint("merge"), "job_id", "left_anti")
    rest = texts.join(open_jobs.hint("merge"), "job_id", "left_semi").groupBy("job_id", "keyword").agg(F.count(F.lit(1)).alias("total"))
    return _first_k(known.unionByName(rest), k)

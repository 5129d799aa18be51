"""All job statistics from one pass: the cells of a job.

A cell is a count of messages that are alike in everything a statistic can ask
for: stars and flags of a review, one keyword tag, one sentiment. ``job_cells``
reads both sides once, counts with one counter per item and merges map-side;
``job_statistics`` and the documents only ever read cells. On a stream the
cells are the state, and their changelog is what the documents are built from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyloom import schema as S
from tallyloom.functions import scalars as sc
from tallyloom.operators.sentiment import LABELS, label_name

KEYS = ["job_id", "kind", "name", "tag", "valid", "empty", "trial", "typed"]
LAYOUT = """
  job_id string, kind string, name string, tag string, valid boolean, empty boolean, trial boolean, typed boolean,
  n bigint, total double"""

# Which cells of an item each measure counts.
_MEASURES = {
    "all": "TRUE",
    "trial": "trial",
    "regular": "NOT trial",
    "valid": "valid",
    "empty": "empty",
    "full": "NOT empty",
    "full_trial": "NOT empty AND trial",
    "full_regular": "NOT empty AND NOT trial",
    "typed": "typed",
    "typed_trial": "typed AND trial",
    "typed_regular": "typed AND NOT trial",
}
_SUMS = ("all", "full", "trial", "regular")


def job_cells(transform: DataFrame, analysis: DataFrame) -> DataFrame:
    """Cells of both sides. ``transform`` must carry ``keywords``.

    Kinds: ``stars`` by the first of the three ratings, ``own`` by the rating
    field alone (reviews with an id only), ``tag`` and ``sentiment``. The flag
    ``typed`` marks tags the typed keyword statistics accept.
    """
    none, no, zero = F.lit(""), F.lit(False), F.lit(0.0)
    bucket = lambda c: sc.rating_bucket(F.col(c)).cast("string")
    pairs = F.map_entries(sc.variant_as(F.col("keywords"), "map<string,variant>"))
    # bare entries are exploded and judged as columns: functions over arrays would run uncompiled for every entry
    entries = F.concat(F.array(F.lit(None), F.lit(None)).cast(_ENTRIES), F.coalesce(pairs, F.array().cast(_ENTRIES)))
    rows = transform.select(
        "job_id", "valid", "empty", "trial", "rating", "own_rating",
        (F.col("review_id") != "").alias("_has_id"), F.posexplode(entries).alias("_at", "_entry"),
    )
    stars, own, tag = F.col("_at") == 0, F.col("_at") == 1, F.col("_at") > 1
    value = F.col("_entry.value")
    kind = F.schema_of_variant(value)
    text = F.when(~(kind.startswith("OBJECT") | kind.startswith("ARRAY")), sc.variant_as(value, "string"))
    reviews = rows.filter(stars | (own & F.col("_has_id")) | (tag & (F.coalesce(text, none) != ""))).select(
        "job_id",
        F.when(stars, "stars").when(own, "own").otherwise("tag").alias("kind"),
        F.coalesce(F.when(stars, bucket("rating")).when(own, bucket("own_rating")).otherwise(F.col("_entry.key")), none).alias("name"),
        F.when(tag, text).otherwise(none).alias("tag"),
        (~tag & F.col("valid")).alias("valid"),
        (~tag & F.col("empty")).alias("empty"),
        "trial",
        (~tag | ((kind == "STRING") & ~F.col("empty") & F.col("_has_id"))).alias("typed"),
        F.when(own, F.col("own_rating")).otherwise(zero).alias("amount"),
    )
    results = analysis.select(
        "job_id",
        F.lit("sentiment").alias("kind"),
        label_name(F.col("sentiment"), "other").alias("name"),
        none.alias("tag"),
        no.alias("valid"),
        no.alias("empty"),
        "trial",
        no.alias("typed"),
        zero.alias("amount"),
    )
    return reviews.unionByName(results).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total")
    )


_ENTRIES = "array<struct<key:string,value:variant>>"


def _by_tag(cells: DataFrame) -> DataFrame:
    return cells.groupBy("job_id", "kind", "name", "tag").agg(
        *[F.coalesce(F.sum(F.expr(f"CASE WHEN {t} THEN n END")), F.lit(0)).alias(f"n_{m}") for m, t in _MEASURES.items()],
        *[F.sum(F.expr(f"CASE WHEN {_MEASURES[m]} THEN total END")).alias(f"s_{m}") for m in _SUMS],
    )


def _entries(count: str, share) -> Column:
    """The tags of a keyword, most frequent first, with their share."""
    n = F.col(f"n_{count}")
    rows = F.sort_array(F.collect_list(F.when(n > 0, F.struct((-n).alias("_order"), "tag", n.alias("count")))))
    total = F.sum(n)
    return F.transform(
        rows,
        lambda e: F.struct(
            e["tag"].alias("tag"), e["count"].alias("count"), share(e["count"], total).alias("percentage")
        ),
    )


def job_statistics(cells: DataFrame, keywords: bool = True) -> DataFrame:
    """One row per job with reviews: published and typed figures of both sides.

    Typed figures carry the prefix ``typed_``. With ``keywords`` the column
    ``keyword_analysis`` lists every keyword of the job with its tags: as large
    as the job has distinct tags, since it is the document's own content.
    """
    used = cells if keywords else cells.filter("kind <> 'tag'")
    per_name = _by_tag(used).groupBy("job_id", "kind", "name").agg(
        *[F.sum(f"n_{m}").alias(f"count_{m}") for m in _MEASURES],
        *[F.sum(f"s_{m}").alias(f"sum_{m}") for m in _SUMS],
        *([_entries("all", sc.pct).alias("items")] if keywords else []),
    )

    def count(kind: str, measure: str, name: str | None = None) -> str:
        named = f" AND name = '{name}'" if name is not None else ""
        return f"coalesce(sum(CASE WHEN kind = '{kind}'{named} THEN count_{measure} END), 0)"

    def stars_mean(measure: str) -> str:
        case = "sum(CASE WHEN kind = 'stars' AND name <> '' THEN {} END)"
        return sc.mean_or_zero_sql(
            case.format(f"count_{measure} * cast(name AS int)"), case.format(f"count_{measure}")
        )

    def own_mean(measure: str) -> str:
        case = "sum(CASE WHEN kind = 'own' THEN {} END)"
        return sc.mean_or_zero_sql(case.format(f"sum_{measure}"), case.format(f"count_{measure}"))

    published = {"all": "all", "coupang_trial": "trial", "regular": "regular"}
    typed = {"all": "all", "coupang_trial": "full_trial", "regular": "full_regular", "empty_review": "empty"}
    columns = {
        "total_reviews": count("stars", "all"),
        "valid_reviews": count("stars", "valid"),
        "empty_reviews": count("stars", "empty"),
        "trial_reviews": count("stars", "trial"),
        "avg_rating": stars_mean("all"),
        "avg_rating_trial": stars_mean("trial"),
        "avg_rating_regular": stars_mean("regular"),
        "typed_total_reviews": count("own", "all"),
        "typed_valid_reviews": count("own", "valid"),
        "typed_empty_reviews": count("own", "empty"),
        "typed_trial_reviews": count("own", "trial"),
        "typed_avg_rating": own_mean("all"),
        "typed_avg_rating_excluding_empty": own_mean("full"),
        "typed_avg_rating_trial": own_mean("trial"),
        "typed_avg_rating_regular": own_mean("regular"),
        "total_analyzed": count("sentiment", "all"),
    }
    for star in S.STARS:
        for cohort, measure in published.items():
            columns[f"stars_{cohort}_{star}"] = count("stars", measure, str(star))
        for cohort, measure in typed.items():
            columns[f"typed_stars_{cohort}_{star}"] = count("own", measure, str(star))
    for cohort, measure in published.items():
        for name in LABELS:
            columns[f"{cohort}_{name}"] = count("sentiment", measure, name)
        other = count("sentiment", measure, "other")
        columns[f"typed_{cohort}_neutral"] = count("sentiment", measure, "neutral") + " + " + other
    if keywords:
        columns["keyword_analysis"] = (
            "sort_array(collect_list(CASE WHEN kind = 'tag' THEN named_struct('name', name, 'items', items) END))"
        )
    jobs = per_name.groupBy("job_id").agg(*[F.expr(text).alias(name) for name, text in columns.items()])
    return _with_shares(jobs.filter("total_reviews > 0"))


def _with_shares(jobs: DataFrame) -> DataFrame:
    columns = ["CASE WHEN valid_reviews > 0 THEN avg_rating ELSE 0D END AS avg_rating_excluding_empty"]
    for cohort in S.COHORTS:
        for prefix, share in (("", sc.pct_sql), ("typed_", sc.share_pct_sql)):
            parts = {
                "positive": f"{cohort}_positive",
                "negative": f"{cohort}_negative",
                "neutral": f"{prefix}{cohort}_neutral",
            }
            total = f"({' + '.join(parts.values())})"
            columns += [f"{share(part, total)} AS {prefix}{cohort}_{name}_pct" for name, part in parts.items()]
    return jobs.selectExpr("*", *columns)


def top_keywords(cells: DataFrame, k: int = S.TOP_KEYWORDS) -> DataFrame:
    """The typed breakdown of each job's ``k`` most frequent keywords as one
    array: ``[{keyword, all_tags, coupang_tags, regular_tags}]``.

    Ranking works on bare totals, so tag lists are built for ``k`` keywords per
    job only.
    """
    tags = _by_tag(cells.filter("kind = 'tag' AND typed")).select(
        "job_id", "name", "tag", "n_typed", "n_typed_trial", "n_typed_regular"
    )
    totals = tags.groupBy("job_id", "name").agg(F.sum("n_typed").alias("_total"))
    order = W.partitionBy("job_id").orderBy(F.desc("_total"), "name")
    ranked = totals.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k)
    lists = {"all_tags": "typed", "coupang_tags": "typed_trial", "regular_tags": "typed_regular"}
    per_keyword = (
        tags.join(ranked, ["job_id", "name"])
        .groupBy("job_id", "_rank", F.col("name").alias("keyword"))
        .agg(*[_entries(count, sc.share_pct).alias(name) for name, count in lists.items()])
    )
    ordered = F.sort_array(F.collect_list(F.struct("_rank", "keyword", *lists)))
    return per_keyword.groupBy("job_id").agg(
        F.transform(
            ordered, lambda e: F.struct(e["keyword"].alias("keyword"), *[e[n].alias(n) for n in lists])
        ).alias("keyword_analysis")
    )

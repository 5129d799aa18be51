"""Every operator as a query over the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import schema as S
from tallyloom.functions import codec
from tallyloom.functions import scalars as sc
from tallyloom.operators import cells as cl
from tallyloom.operators import control as ct
from tallyloom.operators import documents as doc
from tallyloom.operators import keywords as kw
from tallyloom.operators import latency as lt
from tallyloom.operators import metrics as mx
from tallyloom.operators import parse, ratings, replay, reviews
from tallyloom.operators import sentiment as sn
from tallyloom.plans import fixtures as fx
from tallyloom.plans.oracle import AS_OF
from tallyloom.session import work_dir
from tallyloom.sources import readers, sinks
from tallyloom.streaming import flows, timers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    """Registers a query; its timestamps leave as zone-less UTC times."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = build(spark, sf_dir)
            zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
            return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df

        run.__name__ = name
        QUERIES[name] = run
        return build

    return register


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def _reviews(spark, sf, *carry: str, figures=parse.FIGURES) -> DataFrame:
    return parse.parse_transform(fx.transform_messages(spark, sf), carry, figures=figures)


def _ids(spark, sf) -> DataFrame:
    """Reviews for counting: ids and times, nothing else parsed."""
    return _reviews(spark, sf, figures=())


def _analyses(spark, sf) -> DataFrame:
    return parse.flatten_analysis(fx.analysis_messages(spark, sf))


def _lines(spark, sf) -> DataFrame:
    return parse.parse_transform(fx.lineitem_messages(spark, sf))


def _log(spark, sf) -> DataFrame:
    return parse.parse_control(fx.control_log(spark, sf), key="key")


def _collections(spark, sf) -> DataFrame:
    return parse.parse_control(fx.collection_messages(spark, sf), key="key")


def _ledger(spark, sf) -> DataFrame:
    return ct.ledger(
        ct.expected_counts(_collections(spark, sf)),
        ct.distinct_counts(_ids(spark, sf)),
        ct.distinct_counts(_analyses(spark, sf)),
    )


# --- parsing


@query("normalize_transform")
def _(spark, sf):
    carry = ("title", "sales_price", "year", "clean_text")
    return _reviews(spark, sf, *carry).select(
        "job_id", "review_id", "ts", "redelivery", "rating", "valid", "empty", "trial", *carry
    )


@query("rating_coalesce")
def _(spark, sf):
    return _reviews(spark, sf).select("job_id", "review_id", "redelivery", "rating", "own_rating")


@query("coerce_flags")
def _(spark, sf):
    return _reviews(spark, sf).select("job_id", "review_id", "redelivery", "valid", "empty", "trial")


@query("flatten_analysis")
def _(spark, sf):
    return _analyses(spark, sf)


@query("flatten_array")
def _(spark, sf):
    rows = parse.flatten_array(fx.batch_messages(spark, sf), "reviews")
    rating = sc.number_or_zero(F.try_variant_get("element", "$.rating", "variant"))
    return rows.select("job_id", "review_id", rating.alias("rating"), "l_extendedprice")


@query("first_review")
def _(spark, sf):
    rows = parse.first_review(fx.batch_messages(spark, sf))
    return rows.select("job_id", "review_id", sc.safe_double(F.col("rating")).alias("rating"), "l_extendedprice")


@query("first_analysis")
def _(spark, sf):
    return parse.first_analysis(fx.analysis_messages(spark, sf))


@query("valid_records")
def _(spark, sf):
    return parse.valid_records(fx.document_messages(spark, sf, damaged=True)).select("doc_id")


@query("quarantine")
def _(spark, sf):
    return parse.quarantine(fx.document_messages(spark, sf, damaged=True)).select("doc_id", "reason")


@query("parse_object")
def _(spark, sf):
    rows = fx.document_messages(spark, sf, damaged=True).withColumn("_o", codec.parse_object(F.col("value")))
    job = sc.variant_as(F.try_element_at("_o", F.lit("job_id")), "string")
    return rows.select("doc_id", F.size(F.map_keys("_o")).alias("fields"), job.alias("job_id"))


@query("encode_json")
def _(spark, sf):
    texts = fx.table(spark, sf, "documents").select(
        "doc_id", codec.encode_json("text", "lang", "n_chars").alias("value")
    )
    back = F.from_json("value", "text string, lang string, n_chars bigint")
    return texts.select("doc_id", back.alias("_v")).select(
        "doc_id", F.md5("_v.text").alias("text_md5"), "_v.lang", "_v.n_chars"
    )


@query("extract_job_id")
def _(spark, sf):
    rows = fx.document_messages(spark, sf, damaged=True)
    return rows.select("doc_id", codec.extract_job_id(F.col("value")).alias("job_id"))


@query("valid_control")
def _(spark, sf):
    return parse.valid_control(fx.control_log(spark, sf)).select("key", "ts", "is_valid")


@query("control_key")
def _(spark, sf):
    return _collections(spark, sf).select("job_id", "ts", "expected_count")


@query("explode_keywords")
def _(spark, sf):
    rows = kw.explode_keywords(_reviews(spark, sf, "keywords", figures=()))
    return rows.groupBy("job_id", "keyword", "tag").agg(F.count(F.lit(1)).alias("n"))


# --- scalars


@query("rating_bucket")
def _(spark, sf):
    return _lines(spark, sf).select("review_id", "rating", sc.rating_bucket(F.col("rating")).alias("bucket"))


@query("cohorts")
def _(spark, sf):
    return ratings.cohorts(_reviews(spark, sf)).groupBy("job_id", "cohort").agg(F.count(F.lit(1)).alias("n"))


@query("composite_key")
def _(spark, sf):
    key = sc.composite_key(F.col("job_id"), F.col("review_id"))
    rows = _lines(spark, sf).select(key.alias("event_key"))
    return rows.select("event_key", sc.composite_job(F.col("event_key")).alias("job_part"))


@query("kst_iso")
def _(spark, sf):
    return fx.table(spark, sf, "events").select("event_id", sc.kst_iso(F.col("ts")).alias("kst"))


@query("utc_iso")
def _(spark, sf):
    return fx.table(spark, sf, "events").select("event_id", sc.utc_iso(F.col("ts")).alias("utc"))


@query("safe_double")
def _(spark, sf):
    text = F.expr("CASE lang WHEN 'en' THEN CAST(n_chars / 4 AS STRING) WHEN 'fr' THEN source END")
    return fx.table(spark, sf, "documents").select("doc_id", sc.safe_double(text).alias("number"))


@query("pct")
def _(spark, sf):
    return _lines(spark, sf).groupBy("job_id").agg(
        sc.pct(F.count_if("trial"), F.count_if("empty")).alias("trial_per_empty")
    )


@query("dominant_sentiment")
def _(spark, sf):
    return _combined(spark, sf).select("job_id", "dominant_sentiment")


@query("sentiment_rating_score")
def _(spark, sf):
    return _combined(spark, sf).select("job_id", "sentiment_rating_score")


@query("step_timeout")
def _(spark, sf):
    return _log(spark, sf).groupBy("step").agg(
        F.count(F.lit(1)).alias("messages"), F.max(sc.step_timeout(F.col("step"))).alias("timeout_ms")
    )


@query("control_message")
def _(spark, sf):
    want = F.col("expected_count")
    text = ct.done_message("transform", F.col("job_id"), want, want, F.col("ts"))
    return _collections(spark, sf).select("job_id", text.alias("message"))


@query("failure_message")
def _(spark, sf):
    text = ct.failure_message(
        F.col("job_id"), F.col("step"), F.lit("step failed"), F.col("expected_count"), F.col("actual_count"), F.col("ts")
    )
    return _log(spark, sf).filter("status = 'failed'").select("job_id", text.alias("message"))


@query("timeout_message")
def _(spark, sf):
    text = ct.timeout_message(
        F.col("job_id"), F.col("step"), F.col("expected_count"), F.col("actual_count"), F.col("ts"), stamp=sc.utc_iso
    )
    return _log(spark, sf).filter("status = 'timeout'").select("job_id", text.alias("message"))


# --- reviews


@query("latest_by_key")
def _(spark, sf):
    rows = _log(spark, sf).select("job_id", "step", "ts", "status", "expected_count", "actual_count")
    return reviews.latest_by_key(rows, ["job_id", "step"], ["ts", "expected_count", "actual_count", "status"])


def _remaining(spark, sf, *values: str) -> DataFrame:
    rows = _reviews(spark, sf).select("job_id", "review_id", "ts", *values)
    gone = fx.deletion_messages(spark, sf).filter(F.col("value").isNull())
    parts = F.split("key", r"\|", 2)
    gone = gone.select(parts[0].alias("job_id"), parts[1].alias("review_id"), F.col("ts").cast("timestamp"))
    return reviews.latest_with_deletes(rows, gone, ["job_id", "review_id"], ["ts"])


@query("latest_by_key_with_deletes")
def _(spark, sf):
    return _remaining(spark, sf, "rating")


@query("ledger_with_deletes")
def _(spark, sf):
    """Completion over the reviews that are still there."""
    return ct.ledger(
        ct.expected_counts(_collections(spark, sf)),
        ct.distinct_counts(_remaining(spark, sf)),
        ct.distinct_counts(_analyses(spark, sf)),
    )


@query("latest_review")
def _(spark, sf):
    rows = _lines(spark, sf).drop("own_rating")
    order = ("ts", "l_partkey", "l_extendedprice", "rating", "trial", "empty", "valid")
    return reviews.latest_review(rows, order)


def _joined(spark, sf, *carry):
    rows = _reviews(spark, sf, *carry, figures=("rating",))
    return reviews.join_reviews(rows, _analyses(spark, sf))


_JOIN_COLUMNS = (
    "job_id", "review_id", "ts", "redelivery", "analysis_ts", "rating", "title", "sentiment", "summary",
)


@query("join_reviews")
def _(spark, sf):
    return _joined(spark, sf, "title").select(*_JOIN_COLUMNS)


def _anonymous(spark, sf, *carry: str) -> tuple[DataFrame, DataFrame]:
    """Reviews and analyses some of which have no review id."""
    messages = fx.transform_messages(spark, sf, anonymous=True)
    return (
        parse.parse_transform(messages, carry, figures=("rating",)),
        parse.flatten_analysis(fx.analysis_messages(spark, sf, anonymous=True)),
    )


@query("join_missing_ids")
def _(spark, sf):
    return reviews.join_reviews(*_anonymous(spark, sf, "title")).select(*_JOIN_COLUMNS)


@query("joined_rows")
def _(spark, sf):
    rows = reviews.joined_rows(_joined(spark, sf, *S.PASS_THROUGH))
    return rows.withColumns(
        {"keywords": F.to_json("keywords"), "invalid_reason": F.concat_ws(",", "invalid_reason")}
    )


@query("joined_job_stats")
def _(spark, sf):
    return doc.joined_job_stats(_reviews(spark, sf, figures=("rating",)), _analyses(spark, sf))


# --- profiles


@query("transform_profile")
def _(spark, sf):
    return ratings.transform_profile(_reviews(spark, sf))


@query("transform_profile_lines")
def _(spark, sf):
    return ratings.transform_profile(_lines(spark, sf))


@query("transform_profile_texts")
def _(spark, sf):
    return ratings.transform_profile(parse.parse_transform(fx.document_messages(spark, sf)))


@query("rating_distribution")
def _(spark, sf):
    return ratings.rating_distribution(_reviews(spark, sf))


@query("transform_stats")
def _(spark, sf):
    return ratings.transform_stats(_reviews(spark, sf))


@query("merge_stats")
def _(spark, sf):
    by_day = ratings.transform_stats(_reviews(spark, sf).withColumn("day", F.to_date("ts")), "day")
    merged = ratings.merge_stats(by_day)
    return merged.withColumns({c: F.round(c, 9) for c in merged.columns if c.startswith("avg_")})


@query("rating_distribution_4")
def _(spark, sf):
    return ratings.rating_distribution_4(_reviews(spark, sf))


@query("sentiment_profile")
def _(spark, sf):
    return sn.sentiment_profile(_analyses(spark, sf))


@query("sentiment_stats")
def _(spark, sf):
    return sn.sentiment_stats(_analyses(spark, sf))


@query("keyword_items")
def _(spark, sf):
    return kw.keyword_items(_reviews(spark, sf, "keywords", figures=()))


@query("keyword_tags")
def _(spark, sf):
    return kw.keyword_tags(_reviews(spark, sf, "keywords", figures=("empty", "trial")))


@query("top_keywords")
def _(spark, sf):
    return kw.top_keywords(_reviews(spark, sf, "keywords", figures=("empty",)))


@query("frequent_keywords")
def _(spark, sf):
    """The same by way of bounded summaries by day, merged."""
    rows = _reviews(spark, sf, "keywords", figures=("empty",))
    summaries = kw.keyword_summaries(rows, F.date_trunc("day", "ts").alias("day"))
    return kw.frequent_keywords(rows, kw.merged_summaries(summaries, "job_id"))


def _combined(spark, sf):
    profile = ratings.transform_profile(_reviews(spark, sf), histogram=False)
    return doc.combined_job_stats(profile, sn.sentiment_profile(_analyses(spark, sf)))


@query("combined_job_stats")
def _(spark, sf):
    return _combined(spark, sf)


def _cells(spark, sf):
    return cl.job_cells(_reviews(spark, sf, "keywords"), _analyses(spark, sf))


@query("job_document")
def _(spark, sf):
    return _read_document(doc.job_document(_cells(spark, sf), sc.kst_iso(as_of())))


def _read_document(documents: DataFrame) -> DataFrame:
    """What a consumer of the published documents reads from them."""
    layout = f"""
      timestamp string,
      transform_stats struct<total_reviews bigint, avg_rating double, coupang_trial_reviews bigint>,
      rating_distribution struct<regular map<string,bigint>>,
      keyword_analysis array<struct<name string, items array<struct<tag string, count bigint, percentage double>>>>,
      analysis_stats struct<sentiment_distribution struct<
        all map<string,double>, regular map<string,double>>>,
      combined_stats struct<analysis_coverage double, dominant_sentiment string, sentiment_rating_correlation double>"""
    d = documents.select("job_id", F.from_json("document", layout).alias("d"))
    tags = F.flatten(F.col("d.keyword_analysis.items"))
    first = F.col("d.keyword_analysis")[0]["items"][0]
    return d.select(
        "job_id",
        F.col("d.timestamp").alias("stamp"),
        "d.transform_stats.total_reviews",
        "d.transform_stats.avg_rating",
        F.col("d.rating_distribution.regular")["5"].alias("regular_five"),
        F.col("d.transform_stats.coupang_trial_reviews").alias("trials"),
        F.size("d.keyword_analysis").alias("keywords"),
        F.size(tags).cast("bigint").alias("tags"),
        F.aggregate(tags, F.lit(0).cast("bigint"), lambda n, e: n + e["count"]).alias("tag_total"),
        first["tag"].alias("first_tag"),
        first["percentage"].alias("first_pct"),
        F.col("d.analysis_stats.sentiment_distribution.all")[S.POSITIVE].cast("bigint").alias("all_positive"),
        F.col("d.analysis_stats.sentiment_distribution.regular")[f"{S.NEGATIVE}_pct"].alias("regular_negative_pct"),
        "d.combined_stats.analysis_coverage",
        "d.combined_stats.dominant_sentiment",
        F.col("d.combined_stats.sentiment_rating_correlation").alias("sentiment_rating_score"),
    )


@query("job_document_spec")
def _(spark, sf):
    documents = _spec_documents(spark, sf)
    tag = "array<struct<tag string, count bigint, percentage double>>"
    layout = f"""
      transform_stats struct<avg_rating_excluding_empty double,
        rating_distribution struct<empty_review map<string,bigint>>,
        keyword_analysis array<struct<keyword string, all_tags {tag}, coupang_tags {tag}, regular_tags {tag}>>>,
      analysis_stats struct<regular_sentiment struct<neutral bigint>, all_sentiment struct<neutralPct double>>"""
    d = documents.select("job_id", F.from_json("document", layout).alias("d"))
    listed = lambda tags: F.array_join(
        F.transform(tags, lambda e: F.concat(e["tag"], F.lit(":"), e["count"].cast("string"))), ","
    )
    rows = d.select("job_id", "d", F.posexplode("d.transform_stats.keyword_analysis").alias("_at", "k"))
    return rows.select(
        "job_id",
        "d.transform_stats.avg_rating_excluding_empty",
        F.col("d.transform_stats.rating_distribution.empty_review")["1"].alias("stars_empty_review_1"),
        F.col("d.analysis_stats.regular_sentiment.neutral").alias("regular_neutral"),
        F.col("d.analysis_stats.all_sentiment.neutralPct").alias("all_neutral_pct"),
        (F.col("_at") + 1).alias("keyword_rank"),
        "k.keyword",
        listed(F.col("k.all_tags")).alias("all_tags"),
        listed(F.col("k.coupang_tags")).alias("coupang_tags"),
        F.col("k.all_tags")[0]["tag"].alias("all_first"),
        F.col("k.all_tags")[0]["percentage"].alias("all_first_pct"),
    )


def _flat(section: str, values: str) -> Column:
    """The entries of a map of numbers as ``(part, value)``."""
    return F.transform(
        F.map_entries(values), lambda e: F.struct(F.concat(F.lit(f"{section}."), e["key"]).alias("part"), e["value"].alias("value"))
    )


def _nested(section: str, values: str) -> Column:
    """The entries of a map of maps of numbers as ``(part, value)``."""
    inner = lambda c: F.transform(
        F.map_entries(c["value"]),
        lambda e: F.struct(F.concat(F.lit(f"{section}."), c["key"], F.lit("."), e["key"]).alias("part"), e["value"].alias("value")),
    )
    return F.flatten(F.transform(F.map_entries(values), inner))


def _numbers(documents: DataFrame, layout: str, *parts: Column) -> DataFrame:
    """Every number of the documents outside their tag lists, as ``(job_id, part, value)``."""
    d = documents.select("job_id", F.from_json("document", layout).alias("d"))
    return d.select("job_id", F.inline(F.concat(*parts)))


_TAG_LIST = "array<struct<tag string, count bigint, percentage double>>"


@query("job_document_values")
def _(spark, sf):
    numbers = "map<string,double>"
    return _numbers(
        doc.job_document(_cells(spark, sf), F.lit("now")),
        f"""transform_stats {numbers}, rating_distribution map<string,{numbers}>, combined_stats map<string,string>,
            analysis_stats struct<total_analyzed double, sentiment_distribution map<string,{numbers}>>""",
        _flat("transform_stats", "d.transform_stats"),
        _nested("rating_distribution", "d.rating_distribution"),
        F.array(F.struct(F.lit("total_analyzed").alias("part"), F.col("d.analysis_stats.total_analyzed").alias("value"))),
        _nested("sentiment", "d.analysis_stats.sentiment_distribution"),
        F.filter(
            F.transform(
                F.map_entries("d.combined_stats"),
                lambda e: F.struct(F.concat(F.lit("combined_stats."), e["key"]).alias("part"), e["value"].try_cast("double").alias("value")),
            ),
            lambda e: e["value"].isNotNull(),
        ),
    )


@query("job_document_tags")
def _(spark, sf):
    documents = doc.job_document(_cells(spark, sf), F.lit("now"))
    layout = f"keyword_analysis array<struct<name string, items {_TAG_LIST}>>"
    rows = documents.select("job_id", F.explode(F.from_json("document", layout)["keyword_analysis"]).alias("k"))
    rows = rows.select("job_id", F.col("k.name").alias("keyword"), F.posexplode("k.items").alias("place", "t"))
    return rows.select("job_id", "keyword", "place", "t.tag", F.col("t.count").alias("n"), "t.percentage")


def _spec_documents(spark, sf) -> DataFrame:
    # two branches read the cells, so they are stored once
    stored = f"{work_dir(spark, 'cells')}/cells"
    _cells(spark, sf).write.parquet(stored)
    return doc.job_document_spec(spark.read.parquet(stored))


@query("job_document_spec_values")
def _(spark, sf):
    numbers = "map<string,double>"
    figures = (
        "total_reviews valid_reviews empty_reviews coupang_trial_reviews avg_rating avg_rating_excluding_empty "
        "avg_rating_coupang_trial avg_rating_regular"
    ).split()
    layout = f"""
      transform_stats struct<{", ".join(f"{f} double" for f in figures)}, rating_distribution map<string,{numbers}>>,
      analysis_stats struct<total_analyzed double, {", ".join(f"{c}_sentiment {numbers}" for c in S.COHORTS)}>"""
    part = lambda name, value: F.struct(F.lit(name).alias("part"), F.col(value).alias("value"))
    return _numbers(
        _spec_documents(spark, sf),
        layout,
        F.array(*(part(f"transform_stats.{f}", f"d.transform_stats.{f}") for f in figures)),
        _nested("rating_distribution", "d.transform_stats.rating_distribution"),
        F.array(part("total_analyzed", "d.analysis_stats.total_analyzed")),
        *(_flat(f"{c}_sentiment", f"d.analysis_stats.{c}_sentiment") for c in S.COHORTS),
    )


@query("job_document_spec_tags")
def _(spark, sf):
    names = {"all": "all_tags", "coupang_trial": "coupang_tags", "regular": "regular_tags"}
    layout = f"""transform_stats struct<keyword_analysis array<struct<keyword string,
      {", ".join(f"{n} {_TAG_LIST}" for n in names.values())}>>>"""
    d = _spec_documents(spark, sf).select("job_id", F.from_json("document", layout).alias("d"))
    rows = d.select("job_id", F.posexplode("d.transform_stats.keyword_analysis").alias("_at", "k"))
    lists = F.array(*(F.struct(F.lit(c).alias("cohort"), F.col(f"k.{n}").alias("tags")) for c, n in names.items()))
    rows = rows.select("job_id", (F.col("_at") + 1).alias("keyword_rank"), "k.keyword", F.inline(lists))
    rows = rows.select("job_id", "keyword_rank", "keyword", "cohort", F.posexplode("tags").alias("place", "t"))
    return rows.select("job_id", "keyword_rank", "keyword", "cohort", "place", "t.tag", F.col("t.count").alias("n"), "t.percentage")


# --- control


@query("expected_counts")
def _(spark, sf):
    return ct.expected_counts(_collections(spark, sf))


@query("collection_done")
def _(spark, sf):
    return ct.collection_done(_log(spark, sf)).select("job_id", "ts", "expected_count")


@query("step_done")
def _(spark, sf):
    return ct.step_done(_log(spark, sf)).select("job_id", "step", "ts")


@query("step_completion")
def _(spark, sf):
    return ct.step_completion(_log(spark, sf))


@query("step_verdict")
def _(spark, sf):
    messages = parse.valid_control(fx.control_log(spark, sf))
    return ct.step_verdict(parse.parse_control(messages, key="key")).select("job_id", "step", "ts", "expected_count", "reason", "verdict")


@query("job_step_status")
def _(spark, sf):
    return ct.job_step_status(_log(spark, sf), "analysis", "failed")


@query("distinct_counts")
def _(spark, sf):
    return ct.distinct_counts(parse.parse_transform(fx.lineitem_messages(spark, sf), figures=()))


@query("array_counts")
def _(spark, sf):
    return ct.array_counts(fx.batch_messages(spark, sf), "reviews")


@query("hourly_counts")
def _(spark, sf):
    return ct.hourly_counts(_ids(spark, sf))


@query("closed_windows")
def _(spark, sf):
    return ct.closed_windows(ct.hourly_counts(_ids(spark, sf)), as_of())


@query("counts_at_collection")
def _(spark, sf):
    return ct.counts_at_collection(
        _collections(spark, sf), ct.hourly_counts(_ids(spark, sf)), ct.hourly_counts(_analyses(spark, sf))
    )


@query("transform_complete")
def _(spark, sf):
    return ct.step_complete(ct.distinct_counts(_ids(spark, sf)), ct.expected_counts(_collections(spark, sf)))


@query("analysis_complete")
def _(spark, sf):
    return ct.step_complete(ct.distinct_counts(_analyses(spark, sf)), ct.expected_counts(_collections(spark, sf)))


@query("min_counts")
def _(spark, sf):
    return ct.min_counts(ct.distinct_counts(_ids(spark, sf)), ct.distinct_counts(_analyses(spark, sf)))


@query("ledger")
def _(spark, sf):
    return _ledger(spark, sf)


@query("aggregation_complete")
def _(spark, sf):
    return ct.aggregation_complete(_ledger(spark, sf))


@query("control_events")
def _(spark, sf):
    return ct.control_events(_ledger(spark, sf), as_of())


@query("job_timeouts")
def _(spark, sf):
    return ct.job_timeouts(_ledger(spark, sf), as_of())


@query("step_timeouts")
def _(spark, sf):
    return ct.step_timeouts(_ledger(spark, sf), as_of())


# --- metrics


@query("control_metrics")
def _(spark, sf):
    return mx.control_metrics(_log(spark, sf))


@query("step_duration")
def _(spark, sf):
    return mx.step_duration(_log(spark, sf))


@query("duration_quantiles")
def _(spark, sf):
    """The exact rank of each quantile that the merged hourly sketches give, judged by the sketch's error."""
    control = _log(spark, sf)
    found = mx.duration_quantiles(mx.duration_sketches(control))
    times = control.select(F.col("step").alias("_step"), "processing_time")
    # a few rows a step meet all observations, which are counted where they lie
    ranks = F.broadcast(found).join(times, F.col("step") == F.col("_step")).groupBy("step", "rank", "observations")
    below, upto = (F.count_if(test) / F.col("observations") for test in (F.col("processing_time") < F.col("seconds"), F.col("processing_time") <= F.col("seconds")))
    inside = (below - 0.02 <= F.col("rank")) & (F.col("rank") <= upto + 0.02)
    return ranks.agg(inside.alias("inside"))


@query("reviews_on_both_sides")
def _(spark, sf):
    sides = ct.review_sketches(_ids(spark, sf)), ct.review_sketches(_analyses(spark, sf))
    return ct.reviews_on_both_sides(*sides)


@query("active_jobs")
def _(spark, sf):
    return mx.active_jobs(_log(spark, sf))


@query("active_jobs_over_time")
def _(spark, sf):
    return mx.active_jobs_over_time(_log(spark, sf))


@query("ops_metrics")
def _(spark, sf):
    return mx.ops_metrics(_ids(spark, sf))


# How long before its job's done event a message may have come.
LATENCY_SPAN = "1 day"


def _done(spark, sf) -> DataFrame:
    return lt.done_events(_ids(spark, sf), _analyses(spark, sf), _collections(spark, sf))


@query("done_events")
def _(spark, sf):
    return _done(spark, sf)


@query("aggregate_latency")
def _(spark, sf):
    rows = lt.arrivals(_ids(spark, sf), _analyses(spark, sf))
    return lt.aggregate_latency(rows, _done(spark, sf), LATENCY_SPAN)


def _replayed(spark, sf) -> DataFrame:
    """Transform messages of which a third came in broken, after two runs of the replay."""
    work = work_dir(spark, "replay")

    def stored(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{work}/{name}")
        return spark.read.parquet(f"{work}/{name}")

    # both runs and the result read the messages, both runs the dead letters
    right = stored(fx.positioned(fx.transform_messages(spark, sf)), "messages")
    came = fx.broken(right)
    dead, repairs = stored(parse.quarantine(came), "dead"), fx.repairs(right)
    rows = parse.valid_records(came)
    # the first run finds half of the repairs, the second all
    for run, found in enumerate((repairs.filter("crc32(position) % 2 = 0"), repairs)):
        rows = rows.unionByName(replay.replay(spark, dead, found, fx.POSITION, work, run))
    return rows.drop("position")


@query("replayed_ledger")
def _(spark, sf):
    return ct.ledger(
        ct.expected_counts(_collections(spark, sf)),
        ct.distinct_counts(parse.parse_transform(_replayed(spark, sf), figures=())),
        ct.distinct_counts(_analyses(spark, sf)),
    )


@query("replayed_document")
def _(spark, sf):
    cells = cl.job_cells(parse.parse_transform(_replayed(spark, sf), ("keywords",)), _analyses(spark, sf))
    return _read_document(doc.job_document(cells, sc.kst_iso(as_of())))


@query("match_rate")
def _(spark, sf):
    return mx.match_rate(_log(spark, sf))


@query("join_drop_rate")
def _(spark, sf):
    return mx.join_drop_rate(*_anonymous(spark, sf))


# --- the operators on streams: run to the end of the input, then read the sink


# The messages come in so many portions by time, the stream runs on after each.
PORTIONS = 3


def _fed(spark, sf, work: str, writer, more: dict[str, DataFrame] | None = None) -> None:
    """Feeds a stream portion by portion. ``writer`` gets the three sources and those of ``more``."""
    # a few rows from all events, so they are made once for all portions
    fx.collection_messages(spark, sf).write.parquet(f"{work}/collected")
    inputs = {
        "analysis": fx.analysis_messages(spark, sf).withColumn("key", F.lit(None).cast("string")),
        "control": spark.read.parquet(f"{work}/collected"),
        **(more or {}),
    }
    ends = fx.transform_times(spark, sf)
    step = (ends["z"] - ends["a"]) / PORTIONS if ends["a"] else None
    sources = {name: readers.Source(path=f"{work}/in/{name}") for name in ("transform", *inputs)}
    for i in range(PORTIONS):
        since = ends["a"] + i * step if step and i > 0 else None
        until = ends["a"] + (i + 1) * step if step and i < PORTIONS - 1 else None
        for name, messages in {"transform": fx.transform_messages(spark, sf, since=since, until=until), **inputs}.items():
            portion = messages.select("key", "value", "ts")
            if since is not None:
                portion = portion.filter(F.col("ts") >= F.lit(since))
            if until is not None:
                portion = portion.filter(F.col("ts") < F.lit(until))
            portion.write.mode("append").parquet(sources[name].path)
        sinks.run_available(writer(sources))


def _fed_reviews(spark, sources, *carry, figures=parse.FIGURES):
    return readers.read_transform(spark, sources["transform"], carry, streaming=True, figures=figures)


def _fed_ids(spark, sources):
    """Reviews for counting: ids and times, nothing else parsed."""
    return _fed_reviews(spark, sources, figures=())


def _fed_analyses(spark, sources):
    return readers.read_analysis(spark, sources["analysis"], streaming=True)


@query("stream_join_reviews")
def _(spark, sf):
    work = work_dir(spark, "join")

    def writer(sources):
        joined = flows.join_reviews(_fed_reviews(spark, sources, "title"), _fed_analyses(spark, sources))
        return sinks.append(joined.select(*(c for c in _JOIN_COLUMNS if c != "redelivery")), f"{work}/rows", f"{work}/checkpoint")

    _fed(spark, sf, work, writer)
    return spark.read.parquet(f"{work}/rows")


@query("stream_hourly_counts")
def _(spark, sf):
    work = work_dir(spark, "hours")
    _fed(spark, sf, work, lambda sources: sinks.append(
        flows.hourly_counts(_fed_ids(spark, sources)), f"{work}/rows", f"{work}/checkpoint"))
    return spark.read.parquet(f"{work}/rows")


@query("stream_counts_at_collection")
def _(spark, sf):
    work = work_dir(spark, "lookup")

    def writer(sources):
        control = readers.read_control(spark, sources["control"], streaming=True)
        counts = flows.counts_at_collection(_fed_ids(spark, sources), _fed_analyses(spark, sources), control)
        return sinks.append(counts, f"{work}/rows", f"{work}/checkpoint")

    _fed(spark, sf, work, writer)
    return flows.counts_of_messages(spark.read.parquet(f"{work}/rows"))


@query("stream_aggregate_latency")
def _(spark, sf):
    """Done events come as control messages of the aggregation step."""
    work = work_dir(spark, "latency")
    done = _done(spark, sf)
    message = F.to_json(F.struct("job_id", F.lit("aggregation").alias("step"), F.lit("done").alias("status")))
    told = done.select(F.col("job_id").alias("key"), message.alias("value"), F.col("done_at").alias("ts"))
    # every portion reads them, so they are made once
    told.write.parquet(f"{work}/told")
    told = spark.read.parquet(f"{work}/told")

    def writer(sources):
        rows = lt.arrivals(_fed_ids(spark, sources), _fed_analyses(spark, sources))
        events = readers.read_control(spark, sources["done"], streaming=True)
        events = events.filter((F.col("step") == "aggregation") & (F.col("status") == "done")).select("job_id", F.col("ts").alias("done_at"))
        return sinks.append(flows.aggregate_latency(rows, events, LATENCY_SPAN), f"{work}/rows", f"{work}/checkpoint")

    _fed(spark, sf, work, writer, {"done": told})
    return spark.read.parquet(f"{work}/rows")


@query("stream_distinct_counts")
def _(spark, sf):
    work = work_dir(spark, "distinct")
    _fed(spark, sf, work, lambda sources: sinks.changelog(
        flows.distinct_counts(_fed_ids(spark, sources)), f"{work}/rows", f"{work}/checkpoint"))
    return sinks.read_latest(spark, f"{work}/rows", ["job_id"])


@query("stream_combined")
def _(spark, sf):
    work = work_dir(spark, "combined")
    _fed(spark, sf, work, lambda sources: sinks.changelog(
        flows.combined_job_stats(_fed_reviews(spark, sources), _fed_analyses(spark, sources)),
        f"{work}/rows", f"{work}/checkpoint"))
    return sinks.read_latest(spark, f"{work}/rows", ["job_id"])


def _emitted(spark, sf, at: Column | None):
    work = work_dir(spark, "events")

    def writer(sources):
        control = readers.read_control(spark, sources["control"], streaming=True)
        updates = flows.ledger(_fed_ids(spark, sources), _fed_analyses(spark, sources), control)
        return flows.emit_events(spark, updates, f"{work}/ledger", f"{work}/rows", f"{work}/checkpoint", at)

    _fed(spark, sf, work, writer)
    return flows.read_events(spark, f"{work}/rows")


@query("stream_emit_done")
def _(spark, sf):
    # the count in a done message is the one at the moment the step became complete
    return _emitted(spark, sf, None).select("event_key", "job_id", "step", "status", "expected_count")


@query("stream_job_timeouts")
def _(spark, sf):
    return _emitted(spark, sf, as_of()).filter("status = 'failed'").drop("message")


@query("stream_step_timeouts")
def _(spark, sf):
    """The ledger's updates wind the timers of their jobs; the clock ends at the time of ``as_of``."""
    work = work_dir(spark, "timers")
    clock, updates = readers.Source(path=f"{work}/clock"), readers.Source(path=f"{work}/updates")
    ends = fx.transform_times(spark, sf)
    portion = iter(range(1, PORTIONS + 1))

    def writer(sources):
        n = next(portion)
        early = n < PORTIONS and ends["a"]
        now = F.lit(ends["a"] + n * (ends["z"] - ends["a"]) / PORTIONS) if early else as_of()
        control = readers.read_control(spark, sources["control"], streaming=True)
        rows = flows.ledger(_fed_ids(spark, sources), _fed_analyses(spark, sources), control)
        sinks.run_available(timers.write_updates(rows, updates.path, f"{work}/checkpoints/updates", now))
        spark.range(1).select(now.alias("at")).write.mode("append").parquet(clock.path)
        told = timers.step_timeouts(
            spark.readStream.schema(timers.UPDATE_LAYOUT).parquet(f"{updates.path}/*"),
            spark.readStream.schema("at timestamp").parquet(clock.path),
        )
        return sinks.append(told, f"{work}/rows", f"{work}/checkpoints/rows")

    _fed(spark, sf, work, writer)
    return spark.read.parquet(f"{work}/rows")


@query("stream_job_document")
def _(spark, sf):
    work = work_dir(spark, "documents")
    _fed(spark, sf, work, lambda sources: sinks.changelog(
        cl.job_cells(_fed_reviews(spark, sources, "keywords"), _fed_analyses(spark, sources)),
        f"{work}/cells", f"{work}/checkpoint"))
    cells = sinks.read_latest(spark, f"{work}/cells", cl.KEYS)
    return _read_document(doc.job_document(cells, sc.kst_iso(as_of())))


@query("stream_quarantine")
def _(spark, sf):
    """Unreadable analysis messages that a stream came across."""
    work = work_dir(spark, "quarantine")
    _fed(spark, sf, work, lambda sources: sinks.append(
        parse.quarantine(readers.read_messages(spark, sources["analysis"], streaming=True)),
        f"{work}/rows", f"{work}/checkpoint"))
    return spark.read.parquet(f"{work}/rows").drop("key")


@query("read_sources")
def _(spark, sf):
    """Reviews and analyses by job, read back from message files."""
    work = work_dir(spark, "sources")
    fx.transform_messages(spark, sf).select("key", "value", "ts").write.parquet(f"{work}/transform")
    fx.analysis_messages(spark, sf).write.json(f"{work}/analysis", ignoreNullFields=False)
    rows = readers.read_transform(spark, readers.Source(path=f"{work}/transform"))
    results = readers.read_analysis(spark, readers.Source("json", f"{work}/analysis", schema="value string, ts timestamp", key=None))
    both = rows.select("job_id", "rating", F.lit(1).alias("t"), F.lit(0).alias("a")).unionByName(
        results.select("job_id", F.lit(0.0).alias("rating"), F.lit(0).alias("t"), F.lit(1).alias("a")))
    return both.groupBy("job_id").agg(
        F.sum("t").alias("reviews"), F.sum("a").alias("analyses"), F.sum("rating").alias("ratings"))

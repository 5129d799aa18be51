"""Times the headline queries end to end and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

``queries`` derive their JSON messages from the tables within the clock, as in
earlier rounds; ``stored`` are the same batch queries on messages written
beforehand, and ``messages`` is what deriving and writing them took.
"""

from __future__ import annotations

import json
import os
import time

from tallyloom.plans import fixtures as fx
from tallyloom.plans.catalog import QUERIES
from tallyloom.session import local_session, work_dir

MESSAGES = "transform_messages analysis_messages collection_messages control_log lineitem_messages batch_messages".split()

#: Files of each stored topic, whatever its size.
FILES = 16

HEADLINE = (
    "normalize_transform flatten_analysis quarantine join_reviews joined_job_stats latest_review "
    "transform_profile transform_profile_lines transform_profile_texts rating_distribution transform_stats "
    "merge_stats sentiment_profile sentiment_stats keyword_items keyword_tags top_keywords combined_job_stats "
    "job_document job_document_spec distinct_counts array_counts hourly_counts counts_at_collection "
    "control_events job_timeouts step_timeouts control_metrics step_duration active_jobs ops_metrics "
    "match_rate join_drop_rate stream_join_reviews stream_hourly_counts stream_distinct_counts "
    "stream_combined stream_emit_done aggregate_latency latest_by_key_with_deletes active_jobs_over_time"
).split()


def timed(build, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def store_messages(spark, sf_dir: str) -> dict[str, float]:
    """Writes the derived messages; from then on the fixtures read those."""
    folder, seconds = work_dir(spark, "bench"), {}
    for name in MESSAGES:
        derive, start = getattr(fx, name), time.perf_counter()
        derive(spark, sf_dir).repartition(FILES).write.parquet(f"{folder}/{name}")  # as topics are, in many parts
        seconds[name] = round(time.perf_counter() - start, 3)
        stored = lambda spark, sf_dir, *a, path=f"{folder}/{name}", derive=derive, **kw: (
            derive(spark, sf_dir, *a, **kw) if a or kw else spark.read.parquet(path)
        )
        setattr(fx, name, stored)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench", spark__ui__showConsoleProgress="false")
    QUERIES["combined_job_stats"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # JVM warm-up
    seconds = {name: timed(QUERIES[name], spark, sf_dir) for name in HEADLINE}
    messages = store_messages(spark, sf_dir)
    stored = {name: timed(QUERIES[name], spark, sf_dir) for name in HEADLINE if not name.startswith("stream_")}
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "stored": stored,
                "messages": messages,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "lineitem_rows_per_sec": round(rows / seconds["transform_profile_lines"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

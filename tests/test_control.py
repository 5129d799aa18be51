import json

import pytest
from clock import at
from pyspark.sql import functions as F

from tallyloom.functions import scalars as sc
from tallyloom.operators import control as ct
from tallyloom.operators import metrics as mx
from tallyloom.operators import parse


def collected(expected, job="j", seconds=0, **more):
    return ({"job_id": job, "step": "collection", "status": "done", "expected_count": expected, "actual_count": expected,
             "timestamp": "t", **more}, seconds)


def ids(spark, *names, job="j"):
    return spark.createDataFrame([(job, n) for n in names], "job_id string, review_id string")


def ledger(spark, messages, expected, transform, analysis, job="j"):
    control = parse.parse_control(messages(*expected), key="key")
    return ct.ledger(
        ct.expected_counts(control),
        ct.distinct_counts(ids(spark, *transform, job=job)),
        ct.distinct_counts(ids(spark, *analysis, job=job)),
    )


@pytest.mark.parametrize("expected, sizes", [(2, [1, 1]), (3, [1, 1, 1]), (5, [2, 3])])
def test_documented_completions(messages, spark, expected, sizes):
    lists = [{"job_id": "j", "reviews": [{"review_id": f"{i}-{n}"} for n in range(size)]} for i, size in enumerate(sizes)]
    counts = ct.array_counts(messages(*lists), "reviews")
    assert counts.first().n == expected
    control = parse.parse_control(messages(collected(expected)), key="key")
    row = ct.step_complete(counts, ct.expected_counts(control)).first()
    assert (row.actual_count, row.expected_count, row.is_complete, row.exact_match) == (expected, expected, True, True)


def test_array_counts_of_odd_messages(messages):
    odd = messages({"reviews": [1, 2]}, {"job_id": "j", "reviews": "x"}, {"job_id": "j"}, "{bad")
    assert {r.job_id: r.n for r in ct.array_counts(odd, "reviews").collect()} == {"unknown": 2, "j": 0}


def test_copies_do_not_count(spark, messages):
    row = ledger(spark, messages, [collected(3)], ["a", "b", "b", "b"], ["a"]).first()
    assert (row.transform_count, row.analysis_count, row.transform_done, row.min_count) == (2, 1, False, 1)


def test_more_than_expected_is_done_but_no_match(spark, messages):
    control = parse.parse_control(messages(collected(1)), key="key")
    row = ct.step_complete(ct.distinct_counts(ids(spark, "a", "b")), ct.expected_counts(control)).first()
    assert (row.is_complete, row.exact_match) == (True, False)


def test_empty_job_needs_rows_on_both_sides(spark, messages):
    row = ledger(spark, messages, [collected(0)], ["a"], ["x"], job="other").first()
    assert (row.transform_done, row.analysis_done, row.aggregation_done) == (False, False, False)


def test_last_collection_message_counts(messages):
    control = parse.parse_control(messages(collected(5, seconds=10), collected(9, seconds=3)), key="key")
    assert [r.expected_count for r in ct.expected_counts(control).collect()] == [5]


def test_events_once_per_step(spark, messages):
    done = ledger(spark, messages, [collected(2), collected(2, seconds=1)], ["a", "b"], ["a", "b", "c"])
    events = ct.control_events(done).collect()
    assert sorted((e.event_key, e.status, e.expected_count, e.actual_count) for e in events) == [
        ("j|aggregation", "done", 2, 2), ("j|analysis", "done", 2, 3), ("j|transform", "done", 2, 2)]


@pytest.mark.parametrize("minutes, failed", [(9.99, 0), (10, 1), (11, 1)])
def test_job_timeout(spark, messages, minutes, failed):
    open_job = ledger(spark, messages, [collected(5)], ["a"], ["a"])
    late = ct.job_timeouts(open_job, F.lit(at(minutes * 60)))
    rows = late.collect()
    assert len(rows) == failed
    if failed:
        assert (rows[0].event_key, rows[0].step, rows[0].status, rows[0].actual_count) == (
            "j|timeout", "aggregation", "failed", 0)


def test_no_timeout_when_done(spark, messages):
    done = ledger(spark, messages, [collected(1)], ["a"], ["a"])
    assert ct.job_timeouts(done, F.lit(at(1e6))).count() == 0


@pytest.mark.parametrize("minutes, late", [(14, set()), (15, {"aggregation"}), (30, {"aggregation", "transform"}),
                                           (45, {"aggregation", "transform", "analysis"})])
def test_step_timeouts(spark, messages, minutes, late):
    open_job = ledger(spark, messages, [collected(5)], ["a"], ["a"])
    rows = ct.step_timeouts(open_job, F.lit(at(minutes * 60))).collect()
    assert {r.step for r in rows} == late and {r.status for r in rows} <= {"timeout"}


@pytest.mark.parametrize("step, minutes", [("collection", 60), ("TRANSFORM", 30), ("Analysis", 45), ("aggregation", 15), ("x", 30)])
def test_step_timeout_table(spark, step, minutes):
    assert spark.range(1).select(sc.step_timeout(F.lit(step))).first()[0] == minutes * 60_000


def test_time_texts(spark):
    row = spark.range(1).select(
        sc.kst_iso(F.lit(at(0))), sc.utc_iso(F.lit(at(0))), sc.utc_iso(F.lit(at(0.25))), sc.utc_iso(F.lit(at(1e-6)))
    ).first()
    assert tuple(row) == ("2024-01-15T19:30:00+09:00", "2024-01-15T10:30:00Z", "2024-01-15T10:30:00.250Z",
                          "2024-01-15T10:30:00.000001Z")


def test_messages(spark):
    j, one, ts = F.lit("j"), F.lit(1), F.lit(at(0))
    row = spark.range(1).select(
        ct.done_message("transform", j, one, one, ts, worker_id="w").alias("done"),
        ct.failure_message(j, F.lit("analysis"), F.lit("broke"), F.lit(1000), F.lit(850), ts).alias("failed"),
        ct.timeout_message(j, F.lit("analysis"), one, one, ts, stamp=sc.utc_iso).alias("late"),
    ).first()
    assert json.loads(row.done) == {
        "job_id": "j", "step": "transform", "status": "done", "expected_count": 1, "actual_count": 1,
        "timestamp": "2024-01-15T19:30:00+09:00",
        "metadata": {"processing_time": 0.0, "worker_id": "w", "batch_id": "batch-1705314600000", "server_info": "tallyloom"}}
    failed = json.loads(row.failed)
    assert (failed["status"], failed["error_message"], failed["actual_count"]) == ("failed", "broke", 850)
    late = json.loads(row.late)
    assert (late["status"], late["error_message"], late["timestamp"]) == (
        "timeout", "Processing timeout exceeded", "2024-01-15T10:30:00Z")
    with pytest.raises(ValueError):
        ct.done_message("cooking", j, one, one, ts)


def sample(step, status, n, seconds, at=0):
    return ({"job_id": "shoes-7", "step": step, "status": status, "expected_count": 64, "actual_count": n,
             "timestamp": "2025-03-02T08:00:00+09:00", "metadata": {"processing_time": seconds}}, at)


SAMPLES = [sample("collection", "done", 64, 31.0, 0), sample("transform", "done", 64, 7.5, 1),
           sample("analysis", "failed", 60, 700.0, 2), sample("aggregation", "done", 64, 0.5, 3)]


def test_sample_log(messages):
    control = parse.parse_control(parse.valid_control(messages(*SAMPLES)), key="key")
    verdicts = {r.step: (r.verdict, r.reason) for r in ct.step_verdict(control).collect()}
    assert verdicts["analysis"] == ("failed", "count mismatch") and verdicts["transform"] == ("done", None)
    done = ct.step_completion(control).first()
    assert (done.transform_done, done.analysis_done, done.both_done) == (True, False, False)
    assert ct.job_step_status(control, "analysis", "failed").count() == 1
    assert ct.job_step_status(control, "analysis").count() == 0
    times = {r.step: (r.seconds, r.le_60, r.le_1800) for r in mx.step_duration(control).collect()}
    assert times["analysis"] == (700.0, 0, 1) and times["transform"] == (7.5, 1, 1)
    rates = {r.step: (r.completion_rate, r.failure_rate, r.match_rate) for r in mx.match_rate(control).collect()}
    assert rates["analysis"] == (0.0, 100.0, 0.0) and rates["collection"] == (100.0, 0.0, 100.0)
    assert {r.step: r.jobs for r in mx.active_jobs(control).collect()} == {"transform": 0, "analysis": 0, "aggregation": 0}


def test_active_jobs(messages):
    control = parse.parse_control(messages(collected(1, "a"), collected(1, "b"), SAMPLES[1]), key="key")
    assert {r.step: r.jobs for r in mx.active_jobs(control).collect()} == {"transform": 2, "analysis": 1, "aggregation": 0}


def test_verdict_of_missing_fields(messages):
    full = {"job_id": "j", "step": "analysis", "status": "done", "expected_count": 0, "actual_count": 0, "timestamp": "t"}
    odd = [{k: v for k, v in full.items() if k != name} for name in full]
    odd.append({k: v for k, v in full.items() if not k.endswith("count")})
    judge = lambda items: [
        (r.verdict, r.reason)
        for r in ct.step_verdict(parse.parse_control(parse.valid_control(messages(*items, key="k")), key="key")).collect()
    ]
    assert judge(odd) == [("failed", "missing field")] * 7
    assert judge([full, full | {"expected_count": 1}]) == [("done", None), ("failed", "count mismatch")]
    assert judge([full | {"status": None}]) == [(None, None)]  # null is there


def test_counts_at_collection_on_the_hour(spark, messages):
    # windows 09:00, 10:00 and 11:00; a message at 11:00 sharp sees starts 10:00 and 11:00
    rows = spark.createDataFrame([("j", at(-3600)), ("j", at(0)), ("j", at(0)), ("j", at(1800))], "job_id string, ts timestamp")
    hours = ct.hourly_counts(rows)
    control = parse.parse_control(messages(collected(1, seconds=1800), collected(1, seconds=1801)), key="key")
    got = {r.collected_at: (r.transform_count, r.analysis_count)
           for r in ct.counts_at_collection(control, hours, hours.filter("false")).collect()}
    assert list(sorted(got.items()))[0][1] == (3, 0)  # 11:00:00 -> 10:00 (2) + 11:00 (1)
    assert list(sorted(got.items()))[1][1] == (1, 0)  # 11:00:01 -> 11:00 only

"""Done events, latencies, deletions, the sweep over waiting jobs, and sketches."""

import random

from clock import at
from pyspark.sql import functions as F

from tallyloom.operators import control as ct
from tallyloom.operators import latency as lt
from tallyloom.operators import metrics as mx
from tallyloom.operators import reviews

ROWS, CONTROL = "job_id string, review_id string, ts timestamp", "job_id string, step string, status string, ts timestamp, expected_count bigint"


def sides(spark, seed):
    rng = random.Random(seed)
    rows = lambda n: [(f"j{rng.randrange(5)}", f"r{rng.randrange(40)}", at(rng.randrange(6000))) for _ in range(n)]
    control = [(f"j{i}", "collection", "done", at(rng.randrange(6000)), rng.choice([0, 3, 12, 200])) for i in range(6)]
    return rows(150), rows(150), control


def simple_done(t, a, control):
    out = {}
    for job, _, _, collected, expected in control:
        times = []
        for side in (t, a):
            first = {}
            for j, r, ts in side:
                if j == job:
                    first[r] = min(ts, first.get(r, ts))
            times.append(sorted(first.values()))
        k = max(expected, 1)
        if all(len(x) >= k for x in times):
            out[job] = max(collected, *(x[k - 1] for x in times))
    return out


def test_done_and_latency(spark):
    for seed in (1, 2):
        t, a, control = sides(spark, seed)
        frames = spark.createDataFrame(t, ROWS), spark.createDataFrame(a, ROWS), spark.createDataFrame(control, CONTROL)
        done, want = lt.done_events(*frames), simple_done(t, a, control)
        got = {r.job_id: r.done for r in done.select("job_id", (F.unix_micros("done_at") / 1e6).alias("done")).collect()}
        assert got == {j: ts.timestamp() for j, ts in want.items()}
        rows = lt.aggregate_latency(lt.arrivals(frames[0], frames[1]), done, "1 hour").collect()
        waits = {j: [(d - ts).total_seconds() for jj, _, ts in t + a if jj == j and ts <= d and (d - ts).total_seconds() < 3600] for j, d in want.items()}
        assert {r.job_id: (r.arrivals, r.seconds, r.shortest, r.longest, r.within_60) for r in rows} == {
            j: (len(w), sum(w), min(w), max(w), sum(x <= 60 for x in w) / len(w)) for j, w in waits.items() if w}


def test_a_hot_job_is_ranked_within_one_minute(spark):
    rows = spark.range(60_000).select(F.lit("hot").alias("job_id"), F.col("id").cast("string").alias("review_id"),
                                      (F.lit(at(0)) + F.col("id") * F.expr("INTERVAL 1 SECOND")).alias("ts"))
    expected = spark.createDataFrame([("hot", 40_001)], "job_id string, expected_count bigint")
    assert [r.t for r in lt.reached_at(rows, expected).select(F.unix_timestamp("reached_at").alias("t")).collect()] == [at(40_000).timestamp()]


def test_deletes(spark):
    rows = spark.createDataFrame([("a", 1, at(0)), ("a", 2, at(9)), ("b", 1, at(0)), ("c", 1, at(5)), ("d", 1, at(5))], "k string, v int, ts timestamp")
    gone = spark.createDataFrame([("a", at(5)), ("b", at(1)), ("c", at(5)), ("x", at(0))], "k string, ts timestamp")
    left = reviews.latest_with_deletes(rows, gone, ["k"], ["ts"])
    assert left.columns == rows.columns
    assert sorted((r.k, r.v) for r in left.collect()) == [("a", 2), ("d", 1)]
    assert reviews.latest_with_deletes(rows.limit(0), gone, ["k"], ["ts"]).count() == 0


def test_waiting_jobs(spark):
    rng = random.Random(3)
    steps = ("collection", "transform", "analysis", "aggregation")
    log = [(f"j{rng.randrange(30)}", rng.choice(steps), rng.choice(["done", "failed"]), at(rng.randrange(90) * 86_400)) for _ in range(200)]
    frame = spark.createDataFrame(log, "job_id string, step string, status string, ts timestamp")
    got = {(r.step, r.t): r.active for r in mx.active_jobs_over_time(frame).withColumn("t", F.unix_timestamp("ts")).collect()}
    changes = {}
    for before, step in zip(steps, steps[1:]):
        for job in {x[0] for x in log}:
            starts = [ts for j, s, status, ts in log if j == job and s == before and status == "done"]
            if starts:
                ends = [ts for j, s, _, ts in log if j == job and s == step and ts >= min(starts)]
                for ts, by in [(min(starts), 1), *((end, -1) for end in sorted(ends)[:1])]:
                    changes.setdefault(step, {}).setdefault(ts.timestamp(), []).append(by)
    assert got == {(step, ts): sum(sum(by) for t, by in c.items() if t <= ts) for step, c in changes.items() for ts in c}


def test_merged_sketches_keep_their_error(spark):
    times = spark.range(30_000).select(
        F.lit("transform").alias("step"), F.pmod(F.xxhash64("id"), F.lit(100_000)).cast("double").alias("processing_time"),
        (F.lit(at(0)) + F.col("id") * F.expr("INTERVAL 7 SECONDS")).alias("ts"))
    sketches = mx.duration_sketches(times)
    assert sketches.count() > 50
    for row in mx.duration_quantiles(sketches).collect():
        assert row.observations == 30_000
        assert abs(times.filter(F.col("processing_time") <= row.seconds).count() / 30_000 - row.rank) < 0.02
    for n in (500, 4_000, 60_000):
        ids = lambda start: spark.range(start, start + n).select(F.lit("j").alias("job_id"), F.col("id").cast("string").alias("review_id"), times_of)  # noqa: B023, E731
        times_of = (F.lit(at(0)) + F.col("id") * F.expr("INTERVAL 3 SECONDS")).alias("ts")
        both = ct.reviews_on_both_sides(ct.review_sketches(ids(0)), ct.review_sketches(ids(n // 2))).first()
        error = 0 if n < 4_096 else 0.08
        assert abs(both.transform_count - n) <= error * n and abs(both.both_count - n / 2) <= error * n

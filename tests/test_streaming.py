"""Streams over randomly split files end where the batch form ends."""

import json
import random

import pytest
from clock import at
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallyloom import schema as S
from tallyloom.operators import cells as cl
from tallyloom.operators import control as ct
from tallyloom.operators import documents as doc
from tallyloom.operators import parse, reviews
from tallyloom.plans import pipeline as pl
from tallyloom.sources import readers, sinks
from tallyloom.sources.readers import Source
from tallyloom.streaming import flows

LAYOUT = "key string, value string, ts timestamp"
ONE_FILE = {"maxFilesPerTrigger": "1"}


def write_split(spark, path, rows, files, seed):
    """Each row into a random one of ``files`` files."""
    rng = random.Random(seed)
    groups = [[] for _ in range(files)]
    for row in rows:
        rng.choice(groups).append(row)
    for group in groups:
        spark.createDataFrame(group, LAYOUT).coalesce(1).write.mode("append").parquet(path)
    return Source(path=path, options=ONE_FILE)


def make_jobs(n=60, copies=3):
    """Transform rows with copies, analyses, and collection messages of three jobs."""
    rng = random.Random(7)
    transform, analysis = [], []
    for i in range(n):
        body = {"job_id": f"j{i % 3}", "review_id": f"r{i}", "rating": i % 11 / 2, "is_coupang_trial": i % 2,
                "keywords": {"품질": "좋음" if i % 4 else "나쁨"}}
        for c in range(1 + (i % copies == 0)):
            transform.append((None, json.dumps(body), at(i * 60 + c)))
        if i % 5:
            result = {"job_id": f"j{i % 3}", "review_id": f"r{i}", "sentiment": S.SENTIMENTS[i % 3], "is_coupang_trial": i % 2}
            analysis.append((None, json.dumps({"results": [result]}), at(i * 60 + rng.choice([5, 89, 95]))))
    control = [
        (None, json.dumps({"job_id": f"j{j}", "step": "collection", "status": "done", "expected_count": want}), at(4000))
        for j, want in ((0, 16), (1, 20), (2, 99))
    ]
    return transform, analysis, control


@pytest.fixture
def streams(spark, tmp_path):
    transform, analysis, control = make_jobs()
    return pl.Inputs(
        write_split(spark, f"{tmp_path}/t", transform, 4, 1),
        write_split(spark, f"{tmp_path}/a", analysis, 3, 2),
        write_split(spark, f"{tmp_path}/c", control, 2, 3),
    )


def read(spark, inputs, streaming):
    return (
        readers.read_transform(spark, inputs.transform, ("keywords",), streaming),
        readers.read_analysis(spark, inputs.analysis, streaming),
        readers.read_control(spark, inputs.control, streaming),
    )


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_join(spark, streams, tmp_path):
    t, a, _ = read(spark, streams, False)
    want = reviews.join_reviews(t.drop("keywords"), a)
    t, a, _ = read(spark, streams, True)
    joined = flows.join_reviews(t.drop("keywords"), a, delay="2 hours")
    sinks.run_available(sinks.append(joined, f"{tmp_path}/rows", f"{tmp_path}/cp"))
    got = spark.read.parquet(f"{tmp_path}/rows")
    assert 0 < got.count() and rows(got) == rows(want)


def test_hours_hold_back_open_windows(spark, tmp_path):
    # in time order, so no row is late: two files, the second moves the watermark on
    rows_in_order = sorted(make_jobs()[0], key=lambda r: r[2])
    for part in (rows_in_order[:40], rows_in_order[40:]):
        write_split(spark, f"{tmp_path}/t", part, 1, 0)
    source = Source(path=f"{tmp_path}/t")
    batch = ct.hourly_counts(readers.read_transform(spark, source))
    want = ct.closed_windows(batch, F.lit(rows_in_order[-1][2]))
    counts = flows.hourly_counts(readers.read_transform(spark, source, streaming=True))
    sinks.run_available(sinks.append(counts, f"{tmp_path}/rows", f"{tmp_path}/cp"))
    got = spark.read.parquet(f"{tmp_path}/rows")
    assert 0 < want.count() < batch.count() and rows(got) == rows(want)


@pytest.mark.parametrize("lifetime", [None, "1 day"])
def test_distinct_counts(spark, streams, tmp_path, lifetime):
    want = ct.distinct_counts(read(spark, streams, False)[0])
    counts = flows.distinct_counts(read(spark, streams, True)[0], lifetime)
    sinks.run_available(sinks.changelog(counts, f"{tmp_path}/rows", f"{tmp_path}/cp"))
    assert rows(sinks.read_latest(spark, f"{tmp_path}/rows", ["job_id"])) == rows(want)


def test_cells_and_documents(spark, streams, tmp_path):
    t, a, _ = read(spark, streams, False)
    want = doc.job_document(cl.job_cells(t, a), F.lit("now"))
    t, a, _ = read(spark, streams, True)
    sinks.run_available(sinks.changelog(cl.job_cells(t, a), f"{tmp_path}/cells", f"{tmp_path}/cp"))
    cells = sinks.read_latest(spark, f"{tmp_path}/cells", cl.KEYS, cl.LAYOUT)
    assert rows(doc.job_document(cells, F.lit("now"))) == rows(want)
    sinks.compact(spark, f"{tmp_path}/cells", cl.KEYS, f"{tmp_path}/small")
    small = sinks.read_latest(spark, f"{tmp_path}/small", cl.KEYS, cl.LAYOUT)
    assert rows(small) == rows(cells)


def batch_events(spark, streams, as_of=None):
    t, a, c = read(spark, streams, False)
    ledger = ct.ledger(ct.expected_counts(c), ct.distinct_counts(t), ct.distinct_counts(a))
    return ct.control_events(ledger, as_of)


def test_events_once(spark, streams, tmp_path):
    as_of = F.lit(at(100_000))
    updates = flows.ledger(*read(spark, streams, True))
    work = str(tmp_path)
    sinks.run_available(flows.emit_events(spark, updates, f"{work}/l", f"{work}/e", f"{work}/cp", as_of))
    got = [r.event_key for r in flows.read_events(spark, f"{work}/e").collect()]
    assert len(got) == len(set(got))
    want = {r.event_key for r in batch_events(spark, streams, as_of).collect()}
    # a job that timed out in an early batch may be done later: both are told
    assert want <= set(got) and {k for k in got if not k.endswith("|timeout")} == {
        k for k in want if not k.endswith("|timeout")}
    assert "j0|transform" in want and "j2|timeout" in want


def test_overdue_job_is_told_in_a_later_batch(spark, tmp_path, monkeypatch):
    """Nothing arrives for the open job after its first batch."""
    work, clock = str(tmp_path), {"now": at(60)}
    monkeypatch.setattr(flows, "pinned", lambda session, time: F.lit(clock["now"]))

    def message(job, path, seconds):
        body = json.dumps({"job_id": job, "step": "collection", "status": "done", "expected_count": 1})
        write_split(spark, path, [(None, body, at(seconds))], 1, 0)

    def feed():
        source = Source(path=f"{work}/c")
        control = readers.read_control(spark, source, streaming=True)
        empty = Source(path=f"{work}/none")
        updates = flows.ledger(readers.read_transform(spark, empty, (), True), readers.read_analysis(spark, empty, True), control)
        sinks.run_available(
            flows.emit_events(spark, updates, f"{work}/l", f"{work}/e", f"{work}/cp", F.current_timestamp()))
        return sorted(r.event_key for r in flows.read_events(spark, f"{work}/e").collect())

    spark.createDataFrame([], LAYOUT).write.parquet(f"{work}/none")
    message("slow", f"{work}/c", 0)
    assert feed() == []
    clock["now"] = at(700)
    message("new", f"{work}/c", 650)
    assert feed() == ["slow|timeout"]
    message("newer", f"{work}/c", 690)
    assert feed() == ["slow|timeout"]


def test_idle_stream_reports_timeouts(spark, tmp_path, monkeypatch):
    """No message comes, only the heartbeat."""
    work, clock = str(tmp_path), {"now": at(60)}
    monkeypatch.setattr(flows, "pinned", lambda session, time: F.lit(clock["now"]))
    body = json.dumps({"job_id": "slow", "step": "collection", "status": "done", "expected_count": 1})
    write_split(spark, f"{work}/c", [(None, body, at(0))], 1, 0)
    spark.createDataFrame([], LAYOUT).write.parquet(f"{work}/none")

    def beat():
        spark.range(1).write.mode("append").parquet(f"{work}/beat")
        empty = Source(path=f"{work}/none")
        updates = flows.ledger(
            readers.read_transform(spark, empty, (), True), readers.read_analysis(spark, empty, True),
            readers.read_control(spark, Source(path=f"{work}/c"), streaming=True),
            heartbeat=spark.readStream.schema("id bigint").parquet(f"{work}/beat"),
        )
        sinks.run_available(flows.emit_events(spark, updates, f"{work}/l", f"{work}/e", f"{work}/cp", F.current_timestamp()))
        return sorted(r.event_key for r in flows.read_events(spark, f"{work}/e").collect())

    assert beat() == []
    clock["now"] = at(700)
    assert beat() == ["slow|timeout"]
    clock["now"] = at(7200)
    assert beat() == ["slow|aggregation|timeout", "slow|analysis|timeout", "slow|timeout", "slow|transform|timeout"]
    assert len(beat()) == 4


def test_compacting_changelog(spark, tmp_path):
    layout, want = "job_id string, n bigint", {}
    for i in range(8):
        update = {f"j{i % 3}": i, "x": i}
        want |= update
        current = sinks.write_compacting(spark.createDataFrame(list(update.items()), layout), f"{tmp_path}/c", i, ["job_id"], layout, 3)
        assert {r.job_id: r.n for r in current.collect()} == want


def test_repeated_batch_changes_nothing(spark, tmp_path):
    """A micro-batch that runs again after a failure rewrites its own output."""
    df = spark.createDataFrame([("a", 1), ("b", 2)], "job_id string, n bigint")
    for _ in range(2):
        sinks.write_batch(df, f"{tmp_path}/x", 0)
    sinks.write_batch(df.filter("n = 2").withColumn("n", F.lit(5).cast("bigint")), f"{tmp_path}/x", 1)
    got = sinks.read_latest(spark, f"{tmp_path}/x", ["job_id"], "job_id string, n bigint")
    assert {r.job_id: r.n for r in got.collect()} == {"a": 1, "b": 5}
    assert sinks.read_changelog(spark, f"{tmp_path}/x").count() == 3


def test_whole_pipeline(spark, streams, tmp_path):
    batch, live = pl.Outputs(f"{tmp_path}/batch"), pl.Outputs(f"{tmp_path}/live")
    for source, text in ((streams.transform, "{broken"), (streams.analysis, "[1]"), (streams.control, "nothing")):
        write_split(spark, source.path, [(None, text, at(4000))], 1, 0)
    now = F.lit(at(100_000))
    pl.run_batch(spark, streams, batch, now)
    for query in pl.start_streams(spark, streams, live, delay="2 hours", as_of=now):
        query.awaitTermination()
        assert query.exception() is None
    read_rows = lambda out: spark.read.parquet(out.rows).withColumn("keywords", F.to_json("keywords"))
    assert rows(read_rows(live)) == rows(read_rows(batch))
    assert rows(pl.current_documents(spark, live)) == rows(spark.read.parquet(batch.documents))
    # a stream reports the count it saw when the step became complete
    done = lambda events: rows(events.filter("status = 'done'").select("event_key", "expected_count"))
    assert done(flows.read_events(spark, live.events)) == done(spark.read.parquet(batch.events))
    for out in (batch, live):
        bad = spark.read.parquet(out.quarantine).collect()
        assert sorted((r.source, r.unreadable) for r in bad) == [("analyses", "[1]"), ("control", "nothing"), ("reviews", "{broken")]
    told = {r.event_key: json.loads(r.message) for r in flows.read_events(spark, live.events).collect()}
    assert told["j2|timeout"]["error_message"] == S.TIMEOUT_TEXT and told["j2|transform|timeout"]["status"] == "timeout"
    assert "error_message" not in told["j0|transform"]
    assert spark.read.parquet(batch.documents_spec).count() == 3
    event = json.loads(spark.read.parquet(batch.events).filter("event_key = 'j0|transform'").first().message)
    assert event["expected_count"] == 16 and event["timestamp"].endswith("+09:00")


def test_text_lines_and_messages(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"job_id": "j", "review_id": "r"}\n{bad\n', encoding="utf-8")
    source = Source.lines(f"{tmp_path}/in")
    assert parse.parse_transform(readers.read_messages(spark, source)).count() == 1
    streamed = readers.read_messages(spark, source, streaming=True)
    sinks.run_available(sinks.append(streamed, f"{tmp_path}/out", f"{tmp_path}/cp"))
    assert spark.read.parquet(f"{tmp_path}/out").filter("ts IS NOT NULL").count() == 2
    out = sinks.as_messages(spark.createDataFrame([("j", None)], "job_id string, x int"), F.col("job_id"))
    assert tuple(out.first()) == ("j", '{"job_id":"j","x":null}')
    kafka = Source.kafka("host:1", "topic", maxOffsetsPerTrigger="5")
    assert kafka.options["subscribe"] == "topic" and kafka.ts == "timestamp"


def test_observed_counts(spark, messages, tmp_path):
    t = parse.parse_transform(messages({"job_id": "a", "review_id": "1"}, {"job_id": "a", "review_id": "2"}))
    seen = Observation("seen")
    counted = t.observe(seen, F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("job_id").alias("jobs"))
    assert counted.count() == 2 and seen.get == {"rows": 2, "jobs": 1}
    transform, _, _ = make_jobs(n=20, copies=1)
    source = write_split(spark, f"{tmp_path}/in", transform, 3, 1)
    rows = flows.count_observer(readers.read_transform(spark, source, streaming=True), "seen_on_stream")
    run = rows.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    run.awaitTermination()
    told = [m.observedMetrics["seen_on_stream"] for m in run.recentProgress if "seen_on_stream" in m.observedMetrics]
    assert sum(m["rows"] for m in told) == len(transform) and len(told) >= 2
    assert max(m["jobs"] for m in told) <= len({json.loads(r[1])["job_id"] for r in transform})


def test_counts_at_collection_on_a_stream(spark, tmp_path):
    """A window without rows counts zero, a message on the hour asks for two windows, an open window waits."""
    text = lambda **fields: json.dumps(fields)
    review = lambda job, i, s: (None, text(job_id=job, review_id=str(i)), at(s))
    collected = lambda job, s: (None, text(job_id=job, step="collection", status="done", expected_count=2, actual_count=2), at(s))
    transform = [review("a", 1, 0), review("a", 1, 5), review("b", 1, 1800), review("a", 2, 1800), review("z", 1, 5 * 3600)]
    analysis = [(None, text(results=[{"job_id": "a", "review_id": "1", "sentiment": "긍정"}]), at(60))]
    control = [collected("a", 600), collected("a", 600), collected("b", 1800), collected("c", 900), collected("z", 5 * 3600)]
    sources = [write_split(spark, f"{tmp_path}/{name}", rows, 1, 1) for name, rows in (("t", transform), ("a", analysis), ("c", control))]
    counts = flows.counts_at_collection(
        readers.read_transform(spark, sources[0], streaming=True), readers.read_analysis(spark, sources[1], streaming=True),
        readers.read_control(spark, sources[2], streaming=True))
    sinks.run_available(sinks.append(counts, f"{tmp_path}/out", f"{tmp_path}/cp"))
    rows = spark.read.parquet(f"{tmp_path}/out")
    assert rows.groupBy("job_id").count().filter("job_id = 'b'").first()["count"] == 2
    got = {r.job_id: (r.transform_count, r.analysis_count) for r in flows.counts_of_messages(rows).collect()}
    assert got == {"a": (2, 1), "b": (1, 0), "c": (0, 0)}

"""How often and in how many tasks messages are made and parsed."""

import pytest
from clock import at

from tallyloom.operators import cells as cl
from tallyloom.operators import parse, replay
from tallyloom.plans import catalog
from tallyloom.plans import fixtures as fx


@pytest.fixture
def tables(spark, tmp_path):
    rows = [(i, at(i), i % 3, ["click", "purchase", "view"][i % 3], float(i), '{"k": 1}') for i in range(200)]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string")
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("messages", [fx.transform_messages, fx.analysis_messages])
def test_messages_of_one_file_are_made_in_many_tasks(spark, tables, messages):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would coalesce a table this small
    try:
        assert fx.table(spark, tables, "events").rdd.getNumPartitions() == 1
        assert messages(spark, tables).rdd.getNumPartitions() == 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_done_messages_are_made_once_for_all_portions(spark, tables, monkeypatch):
    fed = {}
    monkeypatch.setattr(catalog, "_fed", lambda spark, sf, work, writer, more=None: fed.update(more) or spark.range(1).write.parquet(f"{work}/rows"))
    catalog.QUERIES["stream_aggregate_latency"](spark, tables)
    assert all("/told/" in name for name in fed["done"].inputFiles())


def test_only_repairs_of_waiting_letters_are_parsed(spark, monkeypatch):
    dead = spark.createDataFrame([("a", "{", "r"), (None, "{", "r")], "position string, value string, reason string")
    rows = [("a", '{"n":1}', at(1)), ("a", "[", at(2)), ("b", '{"n":2}', at(1)), (None, "{}", at(1))]
    repairs = spark.createDataFrame(rows, "position string, value string, repaired_at timestamp")
    parsed, whole = [], parse.valid_records
    monkeypatch.setattr(parse, "valid_records", lambda messages, value="value": parsed.append(messages.count()) or whole(messages, value))
    back = replay.reentering(dead, repairs, ["position"])
    assert [tuple(r) for r in back.collect()] == [("a", '{"n":1}')] and parsed == [2]


@pytest.mark.parametrize("messages", [fx.transform_messages, fx.analysis_messages])
def test_few_bytes_do_not_merge_the_tasks_that_make_messages(spark, tables, messages):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert messages(spark, tables).rdd.getNumPartitions() == 4


def test_no_function_over_arrays_runs_for_the_keywords_of_a_review(spark):
    messages = spark.createDataFrame([], "key string, value string, ts timestamp")
    cells = cl.job_cells(parse.parse_transform(messages, ("keywords",)), parse.flatten_analysis(messages))
    assert "lambda" not in cells._jdf.queryExecution().executedPlan().toString()


def test_cells_of_all_kinds_of_tags(spark):
    tags = '{"a":"x","b":1,"c":null,"d":{"n":1},"e":["x"],"f":"","g":true}'
    rows = [("r", f'{{"job_id":"j","review_id":"r","rating":4,"keywords":{tags}}}', at(0)), ("", '{"job_id":"j","keywords":{"a":"x"}}', at(0)),
            ("s", '{"job_id":"j","review_id":"s","is_empty_review":1,"keywords":["x"]}', at(0))]
    messages = spark.createDataFrame(rows, "key string, value string, ts timestamp")
    cells = cl.job_cells(parse.parse_transform(messages, ("keywords",)), parse.flatten_analysis(messages))
    assert sorted(tuple(r)[1:] for r in cells.collect()) == [
        ("own", "", "", True, True, False, True, 1, 0.0),
        ("own", "4", "", True, False, False, True, 1, 4.0),
        ("stars", "", "", True, False, False, True, 1, 0.0),
        ("stars", "", "", True, True, False, True, 1, 0.0),
        ("stars", "4", "", True, False, False, True, 1, 0.0),
        ("tag", "a", "x", False, False, False, False, 1, 0.0),
        ("tag", "a", "x", False, False, False, True, 1, 0.0),
        ("tag", "b", "1", False, False, False, False, 1, 0.0),
        ("tag", "g", "true", False, False, False, False, 1, 0.0),
    ]


@pytest.mark.parametrize("since, until", [(None, at(50)), (at(50), at(120)), (at(120), None), (None, None)])
def test_bounds_leave_the_messages_between_them(spark, tables, since, until):
    since, until = (time and time.astimezone().replace(tzinfo=None) for time in (since, until))  # as rows give them
    whole = fx.transform_messages(spark, tables).select("value", "ts", "redelivery").collect()
    some = fx.transform_messages(spark, tables, since=since, until=until).select("value", "ts", "redelivery").collect()
    inside = [r for r in whole if (since is None or r.ts >= since) and (until is None or r.ts < until)]
    assert sorted(some) == sorted(inside)
    times = fx.transform_times(spark, tables)
    assert (times.a, times.z) == (min(r.ts for r in whole), max(r.ts for r in whole))
    early = fx.transform_messages(spark, tables, since=since, until=until)._jdf.queryExecution().optimizedPlan().toString()
    assert since is until is None or "Filter" in early[early.index("RepartitionByExpression"):]


def test_portions_hold_every_message_once_and_collections_are_made_once(spark, tables, tmp_path, monkeypatch):
    made, seen, whole = [], [], fx.collection_messages
    monkeypatch.setattr(fx, "collection_messages", lambda spark, sf: made.append(1) or whole(spark, sf))
    monkeypatch.setattr(catalog.sinks, "run_available", lambda writer: None)
    work = str(tmp_path / "work")
    catalog._fed(spark, tables, work, lambda sources: seen.append(sources))
    fed = {name: spark.read.parquet(source.path).select("value", "ts") for name, source in seen[0].items()}
    for name, messages in (("transform", fx.transform_messages), ("analysis", fx.analysis_messages), ("control", whole)):
        assert sorted(fed[name].collect()) == sorted(messages(spark, tables).select("value", "ts").collect())
    assert len(seen) == catalog.PORTIONS and made == [1]
    assert sorted(spark.read.parquet(f"{work}/collected").select("value", "ts").collect()) == sorted(fed["control"].collect())
    assert catalog._fed_ids(spark, seen[0]).columns == ["key", "ts", "job_id", "review_id"]

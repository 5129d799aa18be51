"""Dead letters come back once, repaired, whatever else the repairs hold."""

import json

from clock import at

from tallyloom.operators import parse, replay

LAYOUT = "position string, value string, ts timestamp"
GOOD = json.dumps({"job_id": "j", "review_id": "r1"})
OTHER = json.dumps({"job_id": "j", "review_id": "r2"})


def dead_letters(spark):
    came = [("t/0/1", GOOD[:-1], at(1)), ("t/0/2", "[", at(2)), ("t/0/3", GOOD, at(3)), ("t/0/4", "", at(4)), (None, "{", at(5))]
    return spark.createDataFrame(came, LAYOUT)


def repaired(spark, *rows):
    return spark.createDataFrame(rows, "position string, value string, repaired_at timestamp")


def values(df):
    return sorted((r["position"], r["value"], r["ts"].second) for r in df.collect())


def test_latest_readable_repair_of_dead_positions_only(spark):
    messages = dead_letters(spark)
    dead = parse.quarantine(messages)
    repairs = repaired(
        spark, ("t/0/1", OTHER, at(10)), ("t/0/1", GOOD, at(20)), ("t/0/1", "[", at(30)),
        ("t/0/3", OTHER, at(10)), ("t/9/9", OTHER, at(10)), ("t/0/4", "still broken", at(10)), (None, GOOD, at(10)),
    )
    got = replay.reentering(dead.unionByName(dead), repairs, ["position"])
    assert got.columns == ["position", "value", "ts"]
    assert values(got) == [("t/0/1", GOOD, at(1).second)]


def test_runs_bring_each_position_back_once(spark, tmp_path):
    dead = parse.quarantine(dead_letters(spark))
    first = repaired(spark, ("t/0/1", GOOD, at(10)))
    both = first.unionByName(repaired(spark, ("t/0/1", OTHER, at(40)), ("t/0/2", OTHER, at(20))))
    path = str(tmp_path / "replayed")
    run = lambda repairs, n: values(replay.replay(spark, dead, repairs, ["position"], path, n))
    assert run(first, 0) == [("t/0/1", GOOD, at(1).second)]
    assert run(both, 1) == [("t/0/2", OTHER, at(2).second)]
    assert run(both, 1) == [("t/0/2", OTHER, at(2).second)]  # the run is repeated
    assert run(both, 2) == []


def test_nothing_dead_and_no_repairs(spark):
    dead = parse.quarantine(dead_letters(spark))
    assert replay.reentering(dead, repaired(spark, ("x", GOOD, at(0))).filter("false"), ["position"]).count() == 0
    assert replay.reentering(dead.filter("false"), repaired(spark, ("t/0/1", GOOD, at(0))), ["position"]).count() == 0

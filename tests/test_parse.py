import pytest
from pyspark.sql import functions as F

from tallyloom import schema as S
from tallyloom.functions import codec
from tallyloom.operators import parse


def reviews(messages, *items, **options):
    rows = parse.parse_transform(messages(*items), **options).collect()
    return [r.asDict() for r in rows]


@pytest.mark.parametrize(
    "fields, rating, own",
    [
        ({"rating": 4.5}, 4.5, 4.5),
        ({"rating": None, "star_rating": 3}, 3.0, 0.0),
        ({"overall_star_rating": 2, "star_rating": 3}, 2.0, 0.0),
        ({"rating": "n/a", "star_rating": 3}, 0.0, 0.0),  # present, so it decides
        ({"rating": "3.5"}, 3.5, 3.5),
        ({"rating": True}, 1.0, 1.0),
        ({"rating": {"a": 1}, "star_rating": 5}, 0.0, 0.0),
        ({}, 0.0, 0.0),
        ({"rating": None, "overall_star_rating": None, "star_rating": None}, 0.0, 0.0),
    ],
)
def test_rating_coalesce(messages, fields, rating, own):
    (row,) = reviews(messages, {"job_id": "j", "review_id": "r", **fields})
    assert (row["rating"], row["own_rating"]) == (rating, own)


@pytest.mark.parametrize(
    "is_valid, expected",
    [(1, True), (0, False), (2, True), (True, True), (False, False), ("true", True), ("false", False),
     ("0", True), ("x", True), (None, True), ([], True)],
)
def test_is_valid(messages, is_valid, expected):
    (row,) = reviews(messages, {"job_id": "j", "is_valid": is_valid})
    assert row["valid"] is expected


@pytest.mark.parametrize(
    "flag, expected",
    [(1, True), (0, False), (2, False), (1.9, True), (0.9, False), ("1", True), ("1.0", True), (True, True),
     (None, False), ("yes", False), ({}, False)],
)
def test_zero_one_flags(messages, flag, expected):
    (row,) = reviews(messages, {"job_id": "j", "is_empty_review": flag, "is_coupang_trial": flag})
    assert (row["empty"], row["trial"]) == (expected, expected)


def test_absent_flags(messages):
    (row,) = reviews(messages, {"job_id": "j"})
    assert (row["valid"], row["empty"], row["trial"], row["review_id"]) == (True, False, False, "")


@pytest.mark.parametrize("job", [{}, {"job_id": ""}, {"job_id": None}])
def test_missing_job(messages, job):
    (row,) = reviews(messages, {"review_id": "r", **job})
    assert row["job_id"] == "unknown"


BAD = ["{bad", "[1,2]", "5", "null", "", None]


def test_unreadable_messages(messages):
    good = {"job_id": "j", "review_id": "r"}
    assert [r["job_id"] for r in reviews(messages, good, *BAD)] == ["j"]
    as_rows = reviews(messages, good, *BAD, on_error="row")
    assert sorted(r["job_id"] for r in as_rows) == ["error"] * len(BAD) + ["j"]
    marked = reviews(messages, good, *BAD, on_error="mark")
    assert sorted(r["unreadable"] for r in marked if r["unreadable"] is not None) == sorted(b or "" for b in BAD)
    mixed = messages(good, *BAD)
    assert parse.valid_records(mixed).count() == 1
    reasons = [r.reason for r in parse.quarantine(mixed).collect()]
    assert sorted(reasons) == ["empty"] * 2 + ["not a JSON object"] * 4


def test_carried_fields(messages):
    (row,) = reviews(
        messages,
        {"job_id": "j", "title": 5, "year": "2024", "month": "x", "invalid_reason": ["a", "b"],
         "clean_text": "긴 글", "keywords": {"품질": "좋음"}},
        carry=S.PASS_THROUGH,
    )
    assert (row["title"], row["year"], row["month"], row["invalid_reason"]) == ("5", 2024, None, ["a", "b"])
    assert row["clean_text"] == "긴 글" and row["sales_price"] is None
    with pytest.raises(ValueError):
        reviews(messages, {}, carry=["nothing"])


def test_flatten_analysis(messages):
    rows = parse.flatten_analysis(
        messages(
            {"results": [{"job_id": "j", "review_id": "r1", "sentiment": "긍정", "is_coupang_trial": 1}, 5,
                         {"review_id": "r2"}, {"job_id": "", "review_id": "r3"}, {"job_id": None},
                         {"job_id": 7, "sentiment": None}]},
            {"results": {"job_id": "j"}}, {"results": "x"}, {"results": []}, "{bad", {"n": 1},
        )
    ).collect()
    assert sorted((r.job_id, r.review_id, r.sentiment, r.trial) for r in rows) == [
        ("7", "", None, False), ("j", "r1", "긍정", True)]


def test_flatten_array(messages):
    m = messages({"job_id": "p", "reviews": [{"job_id": "own", "review_id": "a"}, {"review_id": "b"}]},
                 {"job_id": "q", "reviews": "no"}, "{bad")
    rows = parse.flatten_array(m, "reviews").collect()
    assert sorted((r.job_id, r.review_id) for r in rows) == [("p", "a"), ("p", "b")]
    rows = parse.flatten_array(m, "reviews", with_job_id=False).collect()
    assert sorted((r.job_id, r.review_id) for r in rows) == [("", "b"), ("own", "a")]


@pytest.mark.parametrize(
    "message, job, review, rating",
    [
        ({"job_id": "j", "review_id": "r", "rating": 3}, "j", "r", "3"),
        ({"job_id": "j", "review_id": "r", "rating": None}, "j", "r", None),
        ({"job_id": "j", "reviews": [{"review_id": "a", "rating": 1}, {"review_id": "b"}]}, "j", "a", "1"),
        ({"reviews": [{"job_id": "x", "review_id": "a"}]}, "", "a", None),
        ({"job_id": "j", "reviews": []}, "unknown", "unknown", None),
        ({"job_id": "j"}, "unknown", "unknown", None),
        ("{bad", "error", "error", None),
    ],
)
def test_first_review(messages, message, job, review, rating):
    (row,) = parse.first_review(messages(message)).collect()
    assert (row.job_id, row.review_id, row.rating) == (job, review, rating)


def test_first_analysis(messages):
    rows = parse.first_analysis(
        messages({"job_id": "j", "review_id": "r", "sentiment": "부정"},
                 {"job_id": "k", "results": [{"review_id": "a", "sentiment": "긍정"}]})
    ).collect()
    assert sorted((r.job_id, r.review_id, r.sentiment) for r in rows) == [("j", "r", "부정"), ("k", "a", "긍정")]


def test_valid_control(messages):
    full = {name: None for name in S.CONTROL_REQUIRED}
    m = messages(full, {k: v for k, v in full.items() if k != "timestamp"}, "{bad", {**full, "extra": 1})
    assert [r.is_valid for r in parse.valid_control(m).collect()] == [True, False, False, True]


@pytest.mark.parametrize(
    "key, job, expected",
    [('"k"', "j", "j"), ('"k"', '"j"', "j"), ('"k"', None, "k"), ("k", "", "k"), (None, None, "unknown"),
     ("", None, "unknown")],
)
def test_control_key(messages, key, job, expected):
    (row,) = parse.parse_control(messages({"job_id": job, "step": "collection"}, key=key), key="key").collect()
    assert row.job_id == expected


def test_control_counts(messages):
    rows = parse.parse_control(
        messages({"expected_count": "12", "actual_count": 3.9}, {"expected_count": "x"}, "{bad",
                 {"metadata": {"processing_time": 1.5}}, {"metadata": "none"})
    ).collect()
    assert [(r.expected_count, r.actual_count, r.processing_time) for r in rows] == [
        (12, 3, None), (0, 0, None), (0, 0, 1.5), (0, 0, None)]


def test_parse_object_and_job_id(messages):
    m = messages({"job_id": "j", "n": None}, "{bad", "[1]", {"job_id": None}, {})
    sizes = [r[0] for r in m.select(F.size(F.map_keys(codec.parse_object(F.col("value"))))).collect()]
    assert sizes == [2, 0, 0, 1, 0]
    assert [r[0] for r in m.select(codec.extract_job_id(F.col("value"))).collect()] == ["j", "", "", "", ""]
    texts = m.limit(1).select(F.lit(1).alias("a"), F.lit(None).cast("int").alias("b"))
    assert texts.select(codec.encode_json("a", "b").alias("v")).first().v == '{"a":1,"b":null}'

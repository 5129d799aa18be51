import json

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import scalars as sc
from tallyloom.operators import cells as cl
from tallyloom.operators import documents as doc
from tallyloom.operators import keywords as kw
from tallyloom.operators import parse, ratings
from tallyloom.operators import sentiment as sn

POS, NEG, NEU = "긍정", "부정", "중립"


def review(rating=0.0, review_id="r", **more):
    return {"job_id": "j", "review_id": review_id, "rating": rating, **more}


def parsed(messages, *items, carry=()):
    return parse.parse_transform(messages(*items), carry)


def result(sentiment, trial=0, job="j"):
    return {"job_id": job, "review_id": "r", "sentiment": sentiment, "is_coupang_trial": trial}


@pytest.mark.parametrize(
    "rating, stars", [(0.0, None), (0.49, None), (0.5, 1), (2.5, 3), (4.49, 4), (5.49, 5), (5.5, None), (-3.0, None)]
)
def test_rating_bucket(spark, rating, stars):
    assert spark.range(1).select(sc.rating_bucket(F.lit(rating))).first()[0] == stars


def test_published_and_typed_profiles_differ(messages):
    rows = parsed(
        messages,
        review(2.5, "a"),
        review(4.4, "b", is_coupang_trial=1),
        review(5.0, "c", is_empty_review=1),
        review(0.0, "d", is_valid=0),
        {"job_id": "j", "review_id": "e", "star_rating": 2},
        {"job_id": "j", "rating": 1},  # no id: the typed statistics leave it out
    )
    p = ratings.transform_profile(rows).first()
    assert (p.total_reviews, p.valid_reviews, p.empty_reviews, p.trial_reviews) == (6, 5, 1, 1)
    assert p.avg_rating == (3 + 4 + 5 + 2 + 1) / 5
    assert p.avg_rating_excluding_empty == p.avg_rating
    assert (p.avg_rating_trial, p.avg_rating_regular) == (4.0, 11 / 4)
    assert (p.stars_regular_5, p.stars_coupang_trial_4, p.stars_all_2) == (1, 1, 1)
    t = ratings.transform_stats(rows).first()
    assert (t.total_reviews, t.valid_reviews, t.empty_reviews) == (5, 4, 1)
    assert t.avg_rating == pytest.approx((2.5 + 4.4 + 5.0) / 5)
    assert t.avg_rating_excluding_empty == pytest.approx((2.5 + 4.4) / 4)
    assert (t.stars_regular_5, t.stars_empty_review_5, t.stars_regular_2) == (0, 1, 0)


def test_job_without_ids_or_valid_reviews(messages):
    rows = parsed(messages, {"job_id": "j", "rating": 3, "is_valid": 0})
    assert ratings.transform_stats(rows).first().total_reviews == 0
    p = ratings.transform_profile(rows).first()
    assert (p.avg_rating, p.avg_rating_excluding_empty, p.avg_rating_trial) == (3.0, 0.0, 0.0)


def test_merge_equals_whole(messages):
    rows = parsed(messages, *[review(i % 11 / 2, f"r{i}", is_coupang_trial=i % 3 // 2, is_empty_review=i % 4 // 3)
                              for i in range(60)])
    parts = rows.withColumn("part", F.pmod(F.hash("review_id"), F.lit(7)))
    merged = ratings.merge_stats(ratings.transform_stats(parts, "part")).first().asDict()
    for name, value in ratings.transform_stats(rows).first().asDict().items():
        assert merged[name] == pytest.approx(value) if isinstance(value, float) else merged[name] == value


def test_sentiments(messages):
    m = messages({"results": [result(POS), result(POS, 1), result(NEG), result(None), result(""), result("혼합", 1)]})
    rows = parse.flatten_analysis(m)
    p, t = sn.sentiment_profile(rows).first(), sn.sentiment_stats(rows).first()
    assert (p.total_analyzed, p.all_positive, p.all_negative, p.all_neutral) == (6, 2, 1, 0)
    assert p.all_positive_pct == 2 * 100.0 / 3 and p.coupang_trial_positive_pct == 100.0
    assert (t.all_neutral, t.coupang_trial_neutral, t.regular_neutral) == (3, 1, 2)
    assert t.all_positive_pct == 2 / 6 * 100.0


@pytest.mark.parametrize(
    "shares, expected",
    [((50.0, 50.0, 0.0), POS), ((10.0, 45.0, 45.0), NEG), ((0.0, 0.0, 100.0), NEU), ((0.0, 0.0, 0.0), POS)],
)
def test_dominant_sentiment(spark, shares, expected):
    assert spark.range(1).select(sc.dominant_sentiment(*map(F.lit, shares))).first()[0] == expected


KEYWORDS = {"품질": "좋음", "가격": 3, "공란": "", "없음": None, "객체": {"a": 1}, "목록": [1], "참": True}


def test_keyword_rules(messages):
    rows = parsed(messages, review(1.0, "a", keywords=KEYWORDS), review(1.0, "b", keywords="품질"),
                  review(1.0, "c", keywords={"품질": "좋음"}, is_empty_review=1),
                  review(1.0, "d", keywords={"품질": "나쁨"}, is_coupang_trial=1), carry=["keywords"])
    items = {(r.keyword, r.tag): (r.n, r.percentage, r.tag_rank) for r in kw.keyword_items(rows).collect()}
    assert items == {("품질", "좋음"): (2, 2 * 100.0 / 3, 1), ("품질", "나쁨"): (1, 100.0 / 3, 2),
                     ("가격", "3"): (1, 100.0, 1), ("참", "true"): (1, 100.0, 1)}
    tags = {(r.keyword, r.cohort, r.tag): r.n for r in kw.keyword_tags(rows).collect()}
    assert tags == {("품질", "all", "좋음"): 1, ("품질", "all", "나쁨"): 1,
                    ("품질", "regular", "좋음"): 1, ("품질", "coupang_trial", "나쁨"): 1}


def test_top_keywords_cut_with_tie(messages):
    many = [review(1.0, f"r{i}-{j}", keywords={f"k{i:02d}": "t"}) for i in range(12) for j in range(2 if i < 9 else 1)]
    rows = parsed(messages, *many, carry=["keywords"])
    top = sorted(kw.top_keywords(rows).collect(), key=lambda r: r.keyword_rank)
    assert [r.keyword for r in top] == [f"k{i:02d}" for i in range(10)]
    results = parse.flatten_analysis(messages({"results": [result(POS)]}))
    document = json.loads(doc.job_document_spec(cl.job_cells(rows, results)).first().document)
    assert [k["keyword"] for k in document["transform_stats"]["keyword_analysis"]] == [r.keyword for r in top]


def test_documents(messages):
    rows = parsed(
        messages,
        review(4.0, "a", keywords={"배송": "빠름"}),
        review(2.0, "b", keywords={"배송": "빠름"}, is_coupang_trial=1),
        review(5.0, "c", keywords={"배송": "느림"}, is_empty_review=1),
        {"job_id": "other", "review_id": "x", "rating": 1},
        carry=["keywords"],
    )
    results = parse.flatten_analysis(messages({"results": [result(POS), result(NEG, 1), result(POS, job="alone")]}))
    cells = cl.job_cells(rows, results)
    (published,) = doc.job_document(cells, F.lit("2024-01-15T19:30:00+09:00")).collect()
    d = json.loads(published.document)
    assert list(d) == ["_id", "job_id", "timestamp", "transform_stats", "rating_distribution", "keyword_analysis",
                       "analysis_stats", "combined_stats"]
    assert d["keyword_analysis"] == [{"name": "배송", "items": [
        {"tag": "빠름", "count": 2, "percentage": 2 * 100.0 / 3}, {"tag": "느림", "count": 1, "percentage": 100.0 / 3}]}]
    assert d["rating_distribution"]["regular"] == {"1": 0, "2": 0, "3": 0, "4": 1, "5": 1}
    assert d["analysis_stats"]["sentiment_distribution"]["all"] == {
        "긍정": 1, "부정": 1, "중립": 0, "긍정_pct": 50.0, "부정_pct": 50.0, "중립_pct": 0.0}
    assert d["combined_stats"] == {
        "total_reviews": 3, "analyzed_reviews": 2, "analysis_coverage": 200.0 / 3, "avg_rating": 11 / 3,
        "dominant_sentiment": POS, "sentiment_rating_correlation": 11 / 3 * 50.0 / 100.0}
    (spec,) = doc.job_document_spec(cells).collect()
    s = json.loads(spec.document)
    assert s["transform_stats"]["rating_distribution"]["empty_review"]["5"] == 1
    assert s["transform_stats"]["avg_rating_excluding_empty"] == 3.0
    (keyword,) = s["transform_stats"]["keyword_analysis"]
    assert keyword["all_tags"] == [{"tag": "빠름", "count": 2, "percentage": 100.0}]
    assert keyword["coupang_tags"] == [{"tag": "빠름", "count": 1, "percentage": 100.0}]
    assert s["analysis_stats"]["all_sentiment"]["positivePct"] == 50.0


def test_document_without_keywords(messages):
    rows = parsed(messages, review(4.0, "a"), carry=["keywords"])
    cells = cl.job_cells(rows, parse.flatten_analysis(messages({"results": [result(NEU)]})))
    assert json.loads(doc.job_document(cells, F.lit("t")).first().document)["keyword_analysis"] == []
    spec = json.loads(doc.job_document_spec(cells).first().document)
    assert spec["transform_stats"]["keyword_analysis"] == []


def test_cells_agree_with_operators(messages):
    rows = parsed(messages, *[review(i % 13 / 2, f"r{i}", is_coupang_trial=i % 2, is_empty_review=i % 5 // 4,
                                     keywords={"k": str(i % 3)}) for i in range(50)], carry=["keywords"])
    results = parse.flatten_analysis(messages({"results": [result([POS, NEG, NEU, "?"][i % 4], i % 2) for i in range(30)]}))
    job = cl.job_statistics(cl.job_cells(rows, results)).first().asDict()
    for source, prefix in ((ratings.transform_profile(rows), ""), (ratings.transform_stats(rows), "typed_"),
                           (sn.sentiment_profile(results), "")):
        for name, value in source.drop("job_id").first().asDict().items():
            assert job[prefix + name] == pytest.approx(value), name

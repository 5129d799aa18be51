import random

import corpus_pipeline
from fixtures import docs, prose


def test_rows_with_null_or_repeated_ids_are_judged(spark, tmp_path):
    rng = random.Random(4)
    one, two, three, held = (prose(rng, 60, 100_000) for _ in range(4))
    rows = [(None, one), (None, one), (3, one), (3, one), (None, two), (None, two), (7, three), (7, three + " "), (None, None), (9, None)]
    kept = corpus_pipeline.near_duplicate_stage(spark, docs(spark, rows), str(tmp_path))
    assert kept.columns == docs(spark, rows).columns
    got = sorted(((r["doc_id"], (r["text"] or "").strip()) for r in kept.collect()), key=str)
    assert got == sorted([(3, one), (None, two), (7, three), (9, "")], key=str)
    spark.createDataFrame([(1, held)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = corpus_pipeline.benchmark_stage(spark, docs(spark, [(None, held), (None, one), (5, held), (5, two)]), str(tmp_path))
    assert sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=str) == sorted([(None, one), (5, two)], key=str)

"""What Python workers hold between the stages of the pipeline, and while they run them."""

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from cueloom.llm.packing import Encoder
from cueloom.llm.scratch import tidy


def test_word_memo_is_bounded_and_changes_no_ids():
    path = public_tokenizers.path("byte_bpe_50k.json")
    text = " ".join(f"word{i % 37} and{i % 11}" for i in range(300))
    few, many = Encoder(path, 8), Encoder(path)
    assert few.encode(text) == many.encode(text) and len(few.words) <= 8 < len(many.words)


def test_a_task_that_ends_early_holds_nothing():
    held = []

    def work(batches):
        held.append("model")
        yield from batches

    run = tidy(work, held)(iter([1, 2]))
    assert next(run) == 1 and held
    run.close()
    assert held == []


def test_stages_take_small_batches(spark, monkeypatch, tmp_path):
    batches = corpus_pipeline.BATCHES
    before = spark.conf.get(batches)
    monkeypatch.setattr(corpus_pipeline, "keep_identified", lambda docs: docs.mapInArrow(lambda got: (b for b in got if b.num_rows > corpus_pipeline.BATCH_ROWS), "id long"))
    try:
        assert corpus_pipeline.language(spark, spark.range(0, 2500, 1, 1), "").count() == 0
    finally:
        spark.conf.set(batches, before)
    seen = []
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", lambda s, docs, d: seen.append(s.conf.get(batches)) or docs.select(F.lit(1).alias("x")))])
    spark.range(3).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 3
    assert seen == ["1000"] and spark.conf.get(batches) == before

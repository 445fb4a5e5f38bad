"""Batches of texts that go to Python workers are bounded."""

import pytest

import corpus_pipeline
from slotbook.llm import quality as Q

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.mark.parametrize("had, then", [("10000", "2000"), ("0", "2000"), ("700", "700")])
def test_stages_bound_the_rows_of_a_batch(spark, had, then):
    before = spark.conf.get(ROWS)
    try:
        spark.conf.set(ROWS, had)
        corpus_pipeline.near_copies(spark, spark.createDataFrame(
            [(1, "a b c", "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long"), "")
        assert spark.conf.get(ROWS) == then
    finally:
        spark.conf.set(ROWS, before)


def test_freed_memory_goes_back_before_words_are_kept(monkeypatch):
    import public_tokenizers
    given = []
    monkeypatch.setattr(Q, "give_back", lambda: given.append(1), raising=False)
    Q.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    assert given == [1]

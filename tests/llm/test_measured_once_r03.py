"""A task of the quality stage measures its texts once, with one Python worker."""

import contextlib
import io

import corpus_pipeline


def test_filter_on_measures_takes_none_again(spark):
    rows = [(i, " ".join(f"word{(i * j) % 61}" for j in range(80)), "en", "s", 5) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.quality_rules(spark, docs, "")
    with contextlib.redirect_stdout(plan := io.StringIO()):
        kept.explain()
    assert plan.getvalue().count("ArrowEvalPython") == 1
    assert kept.count() > 0

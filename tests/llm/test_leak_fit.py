"""The latent space of op10 is fitted on all documents, and the search leaves out only what cannot be a leak."""

import random

import numpy as np
import pyarrow as pa
import pytest

from slotbook.llm import decontaminate as D
from slotbook.llm.common import on_workers


def texts(n, seed=3, words=60):
    r = random.Random(seed)
    return [" ".join(f"w{min(r.randrange(words), r.randrange(words))}" for _ in range(r.randrange(70))) for _ in range(n)]


def dense(some, fit):
    rows = [D.words_of(D._bytes([t]), D.PUNCTUATION)[0] for t in some]
    return np.concatenate([fit.rows(w) for w in rows if len(w)]).astype(float)


def fitted(some, size=16):
    vocabulary = np.unique(D.words_of(D._bytes([t for t in some[:6] if t]), D.PUNCTUATION)[0])
    return D.Fit(np.log(np.random.default_rng(1).random(1 << D.BUCKET_BITS) * 9 + 1) + 1, vocabulary, size)


def test_the_fit_reads_every_document(spark, monkeypatch):
    on_workers(spark)
    docs = spark.createDataFrame(list(enumerate(texts(2500))), "doc_id long, text string")
    items = spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9"), (2, "w11 w12 w3 w4 w5")], "item_id long, text string")
    seen = []
    svd = D.randomised_svd
    monkeypatch.setattr(D, "randomised_svd", lambda t, *a: seen.append(t.count()) or svd(t, *a))
    next(D.indexes(docs, items))
    assert seen == [2502]


def test_space_is_that_of_all_passages(spark):
    on_workers(spark)
    some = texts(300)
    fit = fitted(some)
    space = D.randomised_svd(spark.createDataFrame([(t,) for t in some], "text string").repartition(3), fit, 128)
    x = dense(some, fit)
    full = np.linalg.svd(x, full_matrices=False)[2]
    assert space.shape == full.T.shape and np.allclose(x @ space @ space.T, x, atol=1e-3)


@pytest.mark.parametrize("cells", [1 << 24, 400])
def test_pairs_of_words_are_the_passages_product(monkeypatch, cells):
    monkeypatch.setattr(D, "CELLS", cells)
    some = [*texts(80), "", None, "w1", "w2 w2 w2", *texts(3)]
    fit = fitted(some)
    omega = np.random.default_rng(2).standard_normal((len(fit.vocabulary), 5)).astype(np.float32)
    batches = [pa.RecordBatch.from_arrays([pa.array(some[i:i + 30])], names=["text"]) for i in range(0, len(some), 30)]
    got = np.concatenate([np.frombuffer(b.column(1)[0].as_py()) for b in D._together(fit, omega)(iter(batches))])
    x = dense([t or "" for t in some], fit)
    assert np.allclose(got.reshape(omega.shape), x.T @ (x @ omega), rtol=1e-4, atol=1e-3)


def test_stretches_left_out_hold_no_leak(monkeypatch):
    r = random.Random(8)
    items = [(i, t) for i, t in enumerate(texts(40, 5, 300)) if len(t.split()) > 5]
    docs = texts(60, 6, 300)
    for i, (_, t) in enumerate(items):          # parts of items, in the middle of long texts
        words = t.split()
        cut = words[:max(1, int(len(words) * r.uniform(0.4, 1)))]
        docs.append(" ".join([*docs[i % 60].split() * 3, *cut, *docs[(i + 1) % 60].split() * 2]))
    data = D._bytes(docs)
    vocabulary = np.unique(D.words_of(D._bytes([t for _, t in items]), D.PUNCTUATION)[0])
    fit = D.Fit(np.log(np.random.default_rng(1).random(1 << D.BUCKET_BITS) * 9 + 1) + 1, vocabulary, 16)
    index = D.Index(items, fit, np.eye(len(vocabulary), dtype=np.float32), D.LeakRules())
    got = index.leaks(data)
    left = []
    enough = index._enough
    monkeypatch.setattr(index, "_enough", lambda at, item, a, b: left.append(
        len(item) - len(enough(at, item, a, b))) or np.arange(len(item)))
    assert sum(map(len, got)) > 10 and index.leaks(data) == got and sum(left)

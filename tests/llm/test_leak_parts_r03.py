"""op10 projects no passage that can hold no leak."""

import random

import numpy as np

from slotbook.llm import decontaminate as D


def test_different_keys():
    keys = np.random.default_rng(3).integers(0, 500, 2000)
    for some in (keys, keys[:1], keys[:0]):
        assert D._different(some).tolist() == np.unique(some).tolist()


def test_only_passages_that_can_hold_a_leak_are_projected(monkeypatch):
    r = random.Random(4)
    items = [(i, " ".join(f"w{r.randrange(300)}" for _ in range(r.choice((5, 9, 20, 45))))) for i in range(40)]
    docs = [" ".join(f"w{r.randrange(300)}" for _ in range(200)) for _ in range(30)]
    docs += [f"{docs[i % 30]} {t} {docs[(i + 1) % 30]}" for i, t in items]
    vocabulary = np.unique(D.words_of(D._bytes([t for _, t in items]), D.PUNCTUATION)[0])
    fit = D.Fit(np.log(np.random.default_rng(1).random(1 << D.BUCKET_BITS) * 9 + 1) + 1, vocabulary, 16)
    index = D.Index(items, fit, np.eye(len(vocabulary), dtype=np.float32), D.LeakRules())
    words = D.words_of(D._bytes(docs), D.PUNCTUATION)[0].tolist()
    seen = []
    projected = index._projected
    monkeypatch.setattr(index, "_projected", lambda weight, at, a, b: seen.extend(
        zip(a.tolist(), b.tolist(), strict=True)) or projected(weight, at, a, b))
    found = index.leaks(D._bytes(docs))
    assert sum(map(len, found)) >= 40 and all(k in {x["item_id"] for x in found[30 + k]} for k, _ in items)

    def holds(item, a, b):
        wide = len(item.words)
        near = set(words[max(a - wide, 0):b + wide])
        return sum(item.counts[w] for w in item.counts.keys() & near) >= 0.5 * wide

    assert seen and all(any(holds(i, a, b) for i in index.items) for a, b in seen)

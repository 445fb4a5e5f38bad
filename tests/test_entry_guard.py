"""The engine's queries load whatever is missing of the training-data operators."""

import builtins
import sys

import pytest

import __spark_entry__ as E
from slotbook.plans.queries import QUERIES


@pytest.mark.parametrize("missing", ["slotbook.llm", "public_tokenizers", "corpus_pipeline", "xxhash"])
def test_engine_queries_load_without(monkeypatch, missing):
    for m in [m for m in sys.modules if m.startswith("slotbook.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, m)
    real = builtins.__import__

    def block(name, globals=None, locals=None, fromlist=(), level=0):
        if name == missing or name.startswith(missing + "."):
            raise ModuleNotFoundError(f"No module named {missing!r}", name=missing)
        return real(name, globals, locals, fromlist, level)

    monkeypatch.setattr(builtins, "__import__", block)
    with pytest.warns(UserWarning) if missing in ("public_tokenizers", "xxhash") else _quiet():
        found = E.queries()
        assert set(QUERIES) <= set(found) and set(E.oracle_sql()) <= set(found)
    assert "pipeline" not in found


class _quiet:
    def __enter__(self):
        return self

    def __exit__(self, *exc):
        return False

"""The driver contract without the optional parts."""

import builtins
import importlib
import importlib.util
import sys

import pytest


@pytest.mark.parametrize("missing", ["corpus_pipeline", "sojourn.llm.queries", "sentencepiece", "xxhash"])
def test_the_other_queries_stay_when_something_optional_is_missing(monkeypatch, missing):
    warned = missing in ("sentencepiece", "xxhash") and importlib.util.find_spec("corpus_pipeline") is not None
    real = builtins.__import__

    def without(name, globals=None, locals=None, fromlist=(), level=0):
        if name == missing or name.startswith(missing + "."):
            raise ModuleNotFoundError(f"No module named {missing!r}", name=missing)
        return real(name, globals, locals, fromlist, level)

    for name in [m for m in sys.modules if m in ("__spark_entry__", "corpus_pipeline") or m.startswith("sojourn.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(builtins, "__import__", without)
    with pytest.warns(UserWarning, match=missing) if warned else pytest.MonkeyPatch.context():
        entry = importlib.import_module("__spark_entry__")
    assert len(entry.queries()) == len(entry.oracle_sql()) == 43
    for name in [m for m in sys.modules if m in ("__spark_entry__", "corpus_pipeline") or m.startswith("sojourn.llm")]:
        monkeypatch.delitem(sys.modules, name)

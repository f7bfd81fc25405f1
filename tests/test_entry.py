"""The entry without the corpus operators, and the plans that the README cites."""

import builtins
import importlib
import os
import sys

import pytest

from data_paths import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("blocked", ["public_tokenizers", "pairgrade.llm", "corpus_pipeline"])
def test_entry_works_without_what_the_corpus_needs(monkeypatch, blocked):
    for name in [m for m in sys.modules if m.split(".")[0] in ("corpus_pipeline", "public_tokenizers")
                 or m.startswith("pairgrade.llm")]:
        monkeypatch.delitem(sys.modules, name)
    real = builtins.__import__

    def refuse(name, *args, **kwargs):
        if name == blocked or name.startswith(blocked + "."):
            raise ModuleNotFoundError(name)
        return real(name, *args, **kwargs)

    real_find = importlib.import_module
    monkeypatch.setattr(builtins, "__import__", refuse)
    monkeypatch.setattr(importlib, "import_module", lambda name, package=None: refuse(name) if name == blocked
                        or name.startswith(blocked + ".") else real_find(name, package))
    import __spark_entry__ as entry
    assert set(entry._QUERIES) <= set(entry.queries()) and set(entry._ORACLE) <= set(entry.oracle_sql())
    assert "pipeline" not in entry.queries()


def test_plans_can_be_shown(spark, capsys):
    sys.path.insert(0, os.path.join(ROOT, "tools"))
    import explain_plans
    explain_plans.explain(spark, SF_SMALL)
    shown = capsys.readouterr().out
    half = shown[shown.index("5. pair solver"):]
    assert "Expand" in shown and "FlatMapCoGroupsInArrow" in half and "InMemoryTableScan" in half

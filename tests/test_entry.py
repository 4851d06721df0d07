import importlib

import __spark_entry__ as entry


def test_contract(spark):
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) > 150
    assert entry.entry(spark).count() > 0


def test_import_without_llm(monkeypatch):
    """The rest works where the subpackage and the pipeline are gone."""
    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name.startswith(("tipoff.llm", "corpus_pipeline")) else real(name, *a))
    again = importlib.reload(entry)
    try:
        assert "pipeline" not in again.queries() and "agg_1_pricing_summary" in again.queries()
    finally:
        monkeypatch.undo()
        importlib.reload(entry)

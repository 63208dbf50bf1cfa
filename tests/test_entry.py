import importlib

import __spark_entry__ as entry


def test_registry_is_consistent():
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q) and "p6_found" in q


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["short_form", "long_form", "mentions", "docs"] and df.count() > 0


def test_rest_imports_without_optional_modules(monkeypatch):
    real = importlib.import_module

    def gone(name, *a):
        if name in entry.OPTIONAL:
            raise ImportError(name)
        return real(name, *a)

    monkeypatch.setattr(importlib, "import_module", gone)
    assert "p6_found" in entry.queries() and "ag15_usage_by_model" in entry.oracle_sql()

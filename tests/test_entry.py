import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402


def test_every_engine_query_has_oracle():
    from parley.oracle.sql import ORACLE
    from parley.plans.catalog import REGISTRY

    assert set(REGISTRY) == set(ORACLE) and len(REGISTRY) >= 59
    assert set(REGISTRY) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_without_the_optional_subpackage(monkeypatch):
    from parley.plans.catalog import REGISTRY

    monkeypatch.setattr(E, "_optional", lambda name: None)
    assert set(E.queries()) == set(E.oracle_sql()) == set(REGISTRY)
    assert E._optional("parley.llm") is None


def test_a_broken_optional_module_is_not_hidden(tmp_path, monkeypatch):
    import pytest

    (tmp_path / "broken_module.py").write_text("import surely_not_installed\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    with pytest.raises(ModuleNotFoundError):
        E._optional("broken_module")
    assert E._optional("parley.no_such_subpackage") is None


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["qid", "doc_id", "score", "rank"]
    assert df.count() > 0

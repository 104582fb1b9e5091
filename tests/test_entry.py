import sys

import pytest

import __spark_entry__ as entry_module
from learnlog.plans import catalog
from oracle import sql

OPTIONAL = ("learnlog.llm", "corpus_pipeline")


@pytest.mark.parametrize("missing", ["learnlog.llm", "xxhash"])
def test_other_queries_stay_without_the_operators(monkeypatch, capsys, missing):
    """Without the folder, or a library that it needs, its queries are left out."""
    for name in [n for n in sys.modules if n.startswith(OPTIONAL)]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    assert set(entry_module.queries()) == set(catalog.queries())
    assert entry_module.oracle_sql() == sql.oracle_sql()
    assert "left out" in capsys.readouterr().err
    for name in [n for n in sys.modules if n.startswith(OPTIONAL) and n != missing]:
        monkeypatch.delitem(sys.modules, name)  # half imported


def test_other_errors_are_not_hidden(monkeypatch):
    def broken(name):
        raise ValueError(name)

    monkeypatch.setattr(entry_module.importlib, "import_module", broken)
    with pytest.raises(ValueError):
        entry_module.queries()

import sys

import pytest


def test_broken_import_is_raised(monkeypatch):
    import __spark_entry__

    monkeypatch.setitem(sys.modules, "pairloom.llm.queries", None)
    with pytest.raises(ImportError):
        __spark_entry__.queries()

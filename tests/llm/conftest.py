import importlib
import sys

import pytest


@pytest.fixture(autouse=True)
def own_test_operators(monkeypatch):
    """``test_operators`` is this folder's module here, also when the one above was collected in the same run."""
    monkeypatch.setitem(sys.modules, "test_operators", importlib.import_module(f"{__name__.rpartition('.')[0]}.test_operators"))

from __future__ import annotations

import importlib.util
from pathlib import Path


def test_entry_module(spark):
    path = Path(__file__).resolve().parent.parent / "__spark_entry__.py"
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert module.entry(spark).count() > 0
    assert set(module.oracle_sql()) <= set(module.queries())

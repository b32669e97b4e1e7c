"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

from support import ROOT


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_flagship(spark):
    mod = _entry_module()
    df = mod.entry(spark)
    assert set(df.columns) == {"window_start", "window_end", "event_type", "cnt"}
    assert df.count() > 0


def test_every_query_has_an_oracle():
    mod = _entry_module()
    own = set(mod.queries()) - set(mod.LLM_QUERIES)
    assert own == set(mod.oracle_sql()) - set(mod.LLM_ORACLES)
    assert len(own) >= 28

"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

from jobstar.plans.queries import REGISTRY

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_contract(spark):
    m = _entry_module()
    qs, sql = m.queries(), m.oracle_sql()
    own = set(REGISTRY)
    assert set(sql) <= set(qs) and own <= set(qs) and own <= set(sql) and len(own) >= 56
    df = m.entry(spark)
    assert df.columns == ["skill_name", "skill_category", "demand_count", "pct_of_jobs"]
    rows = df.collect()
    assert len(rows) == 31 and [r.demand_count for r in rows] == sorted((r.demand_count for r in rows), reverse=True)

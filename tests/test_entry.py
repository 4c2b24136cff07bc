"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_flagship(spark):
    m = _entry()
    df = m.entry(spark)
    assert set(df.columns) == {"camera_id", "hour", "n_people", "n_sightings"}
    assert df.count() > 0


def test_every_query_of_the_engine_has_oracle_sql():
    from sightline.plans import ORACLE, QUERIES
    m = _entry()
    q, o = m.queries(), m.oracle_sql()
    assert set(QUERIES) == set(ORACLE) and len(QUERIES) >= 66
    assert set(QUERIES) <= set(q) and set(o) <= set(q)
    # operators of the optional subpackage come on top, under names of their own
    assert all(k.startswith("op") or k == "pipeline" for k in set(q) - set(QUERIES))

"""Driver contract: entry runs, every query has a SQL twin unless it trains a model."""

import __spark_entry__ as E

# queries whose output comes from trained tree models (no SQL twin)
ROWS_ONLY = {"m3_gbt_ovr_metrics", "m3_holdout_auc", "m10_random_search", "m10_severity_search"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "puntaje" in df.columns


def test_oracles_cover_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    # the training-data operators have their own tests
    own = {k for k in set(q) - set(o) if not k.startswith("op") and k != "pipeline"}
    assert own == ROWS_ONLY


def test_a_missing_dependency_costs_only_the_queries_that_need_it():
    import subprocess
    import sys

    code = ("import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as E; "
            "q, o = E.queries(), E.oracle_sql(); assert 'c1_process_data' in q and 'pipeline' not in q and set(o) <= set(q)")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)

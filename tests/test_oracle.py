"""The correctness gate: every registered query against its DuckDB oracle."""

from tests.conftest import SF_SMALL
from tools.oracle_check import check


def test_registered_queries_match_oracle(spark):
    import __spark_entry__ as E
    own = list(E._QUERIES)
    assert set(own) <= set(E.oracle_sql())
    rep = check(spark, SF_SMALL, own)
    bad = {k: r for k, r in rep.items() if not (r["values"] and r["schema"])}
    assert not bad, bad


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "wallet_address"

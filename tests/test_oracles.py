"""Every registered query equals its DuckDB oracle on the smallest scale."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracles import run_checks  # noqa: E402
from conftest import SF_SMALL  # noqa: E402


def test_all_registered_queries_match_oracles(spark):
    from cdclake.workloads import QUERIES

    results = run_checks(spark, SF_SMALL, set(QUERIES))
    failed = [r for r in results if r[1] not in ("OK", "ROWS-ONLY")]
    assert not failed, failed
    from cdclake.workloads import ORACLES, QUERIES

    assert set(QUERIES) == set(ORACLES)  # every query of the library's core has an oracle


def test_entry_runs(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["__op", "n"] and sum(r["n"] for r in rows) == 1500

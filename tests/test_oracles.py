"""Every registered query with a SQL oracle matches DuckDB on sf0.001
(row count, column names, order-insensitive values)."""

import pytest

from oracle_check import _rows
from tessera.plans.registry import all_queries

QUERIES = all_queries()
WITH_ORACLE = sorted(k for k, q in QUERIES.items() if q.oracle)
ROWS_ONLY = sorted(k for k, q in QUERIES.items() if not q.oracle)


@pytest.mark.parametrize("key", WITH_ORACLE)
def test_matches_oracle(spark, sf, duck, key):
    q = QUERIES[key]
    got = q.build(spark, sf).toPandas()
    want = duck.execute(q.oracle).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc, f"columns differ: {gc} vs {wc}"
    dtypes = [(c, str(got[c].dtype), str(want[c].dtype)) for c in gc if str(got[c].dtype) != str(want[c].dtype)]
    assert not dtypes, f"pandas dtypes differ: {dtypes}"
    assert len(gr) == len(wr)
    assert gr == wr


@pytest.mark.parametrize("key", ROWS_ONLY)
def test_rows_only_runs(spark, sf, key):
    df = QUERIES[key].build(spark, sf)
    assert df.columns
    df.write.format("noop").mode("overwrite").save()


def test_every_query_has_inventory_id():
    for q in QUERIES.values():
        assert "-" in q.op_id and q.key == q.key.lower()

import duckdb
import pytest

from seqtable import queries as q

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(v):
    return round(float(v), 5) if isinstance(v, float) or hasattr(v, "as_tuple") else v


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query_equals_sql(spark, data, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    r = con.execute(q.oracle_sql()[name])
    cols = [c[0] for c in r.description]
    want = r.fetchall()
    df = q.queries()[name](spark, data)
    assert sorted(df.columns) == sorted(cols)
    order = sorted(cols)
    rows = lambda xs, names: sorted(repr(tuple(normal(x[names.index(c)]) for c in order)) for x in xs)
    assert rows(df.collect(), df.columns) == rows(want, cols)


@pytest.mark.parametrize("name", sorted(set(q.queries()) - set(q.oracle_sql())))
def test_query_runs(spark, data, name):
    assert q.queries()[name](spark, data).count() > 0

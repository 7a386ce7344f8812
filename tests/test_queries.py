"""Every registered query of the library against its DuckDB twin."""

import decimal

import pytest

from folioframe.queries import ORACLES, QUERIES


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    return round(v, 6) + 0.0 if isinstance(v, float) else v


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(([plain(r[i]) for i in order] for r in rows), key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, small, name):
    df = QUERIES[name](spark, small)
    got = table([tuple(r) for r in df.collect()], df.columns)
    if name in ORACLES:
        r = duck.execute(ORACLES[name])
        columns = [c[0] for c in r.description]
        assert got == table(r.fetchall(), columns)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

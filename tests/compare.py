"""Run a registered query and its check SQL on the same tables and compare rows."""

import datetime as dt
import decimal

import duckdb

from cardledger.fixtures import BASE_TABLES


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def kind(value):
    """Coarse type of a value, so that 1 and Decimal('1.00') do not pass as equal."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, decimal.Decimal):
        return f"dec{-value.as_tuple().exponent}"
    if isinstance(value, dt.datetime):
        return "ts"
    return type(value).__name__


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple((kind(r[i]), str(r[i])) for i in order) for r in rows), key=lambda r: str(r)
    )


def compare(spark, con, query, sql, sf_dir):
    df = query(spark, sf_dir)
    mine = normal([tuple(r) for r in df.collect()], df.columns)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = normal(cur.fetchall(), names)
    assert sorted(df.columns) == sorted(names), (sorted(df.columns), sorted(names))
    assert len(mine) == len(theirs), (len(mine), len(theirs))
    for a, b in zip(mine, theirs):
        assert a == b, (a, b)
    return len(mine)

"""Compare registered queries with their SQL in DuckDB: row count, columns, values.

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 6) + 0.0
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(names, rows):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


def difference(spark, con, sf_dir, build, sql):
    """None if equal, else a short text."""
    result = build(spark, sf_dir)
    got = rows_of(result.columns, result.collect())
    answer = con.execute(sql)
    names = [c[0] for c in answer.description]
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(names)}"
    want = rows_of(names, answer.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, e.g. {str(wrong[0])[:600]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from tests.conftest import session

    import __spark_entry__ as contract

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = session(), connect(sf)
    names = sys.argv[2:] or list(contract.queries())
    bad = 0
    for name in names:
        start = time.time()
        try:
            sql = contract.oracle_sql().get(name)
            if sql is None:
                verdict = f"rows only: {contract.queries()[name](spark, sf).count()}"
            else:
                verdict = difference(spark, con, sf, contract.queries()[name], sql)
        except Exception as error:  # keep going: this is a report
            verdict = f"{type(error).__name__}: {str(error)[:900]}"
        bad += verdict is not None and not verdict.startswith("rows only")
        print(f"{name:28s} {time.time() - start:6.2f}s {verdict or 'ok'}", flush=True)
    print(f"{len(names)} queries, {bad} wrong")

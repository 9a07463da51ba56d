"""Run registered queries next to their SQL: python tests/check_oracle.py [sf] [name ...]"""

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(spark, con, sf_dir, name, sql):
    """Empty text when equal, else the first difference."""
    result = entry.queries()[name](spark, sf_dir)
    got = rows_of(result.columns, [tuple(r) for r in result.collect()])
    rel = con.sql(sql)
    want = rows_of(rel.columns, rel.fetchall())
    if sorted(result.columns) != sorted(rel.columns):
        return f"columns {sorted(result.columns)} != {sorted(rel.columns)}"
    if got == want:
        return ""
    extra = list((set(got) - set(want)))[:2]
    missing = list((set(want) - set(got)))[:2]
    return f"{len(got)} rows, expected {len(want)}; extra {extra}, missing {missing}"


def main(argv):
    from conftest import make_session

    sf_dir = f"/root/testdata/sf{argv[0] if argv else '0.01'}"
    spark, con = make_session(), duck(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name in argv[1:] or sql:
        begin = time.time()
        try:
            text = compare(spark, con, sf_dir, name, sql[name])
        except Exception as error:  # noqa: BLE001
            text = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(text)
        print(f"{name:26s} {time.time() - begin:6.2f}s {'ok' if not text else 'BAD ' + text}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

"""Run queries next to their SQL twins: python tests/compare.py [sf] [name ...]"""

import math
import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    return round(v, 9) if isinstance(v, float) else v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in data]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, name, query, sql, sf_dir):
    """None when equal, else a description of the difference."""
    df = query(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    table = con.execute(sql).to_arrow_table()
    want = rows(table.column_names, list(zip(*[c.to_pylist() for c in table.columns])))
    if sorted(df.columns) != sorted(table.column_names):
        return f"columns {df.columns} vs {table.column_names}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"first difference {str(a)[:400]} vs {str(b)[:400]}"
    return None


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from almsflow.runtime import local_session

    sf_dir = f"/root/testdata/{argv[0] if argv else 'sf0.01'}"
    spark, con, sqls = local_session(8), connect(sf_dir), oracle_sql()
    for name, query in queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, query, sqls.get(name), sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
            if argv[1:]:
                traceback.print_exc()
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])

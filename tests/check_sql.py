"""Run registered queries beside their SQL: python tests/check_sql.py [sf] [name or prefix ...]"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from __spark_entry__ import oracle_sql, queries  # noqa: E402

NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def connect(path):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for n in NAMES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{path}/{n}.parquet')")
    return con


def plain(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


def compare(spark_df, con, sql):
    """Differences between a Spark result and a DuckDB result; an empty list means equal."""
    names = sorted(spark_df.columns)
    rows = [tuple(plain(r[c]) for c in names) for r in spark_df.collect()]
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    got = rel.fetchall()
    problems = []
    if sorted(cols) != names:
        return len(rows), [f"columns {names} against {sorted(cols)}"]
    types = dict(zip(cols, [str(d[1]) for d in rel.description]))
    for n, t in spark_df.dtypes:
        want = KINDS.get(t, t)
        if types[n] != want:
            problems.append(f"type of {n}: {want} against {types[n]}")
    at = [cols.index(c) for c in names]
    other = [tuple(plain(r[i]) for i in at) for r in got]
    if len(rows) != len(other):
        problems.append(f"rows {len(rows)} against {len(other)}")
    a, b = sorted(rows), sorted(other)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        x, y = bad[0]
        diff = [(n, p, q) for n, p, q in zip(names, x, y) if p != q]
        problems.append(f"{len(bad)} rows differ, first: {diff[:4]}")
    return len(rows), problems


def main():
    from tabulon.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    path = f"/root/testdata/{sf}"
    wanted = sys.argv[2:]
    spark = local_session()
    con = connect(path)
    run, sql = queries(), oracle_sql()
    names = [n for n in run if not wanted or n in wanted or any(w.endswith("*") and n.startswith(w[:-1]) for w in wanted)]
    bad = 0
    for n in names:
        start = time.time()
        try:
            df = run[n](spark, path)
            if n in sql:
                count, problems = compare(df, con, sql[n])
            else:
                count, problems = len(df.collect()), []
        except Exception as e:  # report and go on
            count, problems = -1, [f"{type(e).__name__}: {str(e)[:700]}"]
        bad += bool(problems)
        mark = "BAD" if problems else ("ok" if n in sql else "rows")
        print(f"{mark:5}{n:8} {count:7} rows {time.time() - start:6.2f}s  {'; '.join(problems)[:900]}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()

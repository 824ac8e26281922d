"""Run queries next to their SQL and compare: python tests/check_oracle.py [sf_dir] [name ...]"""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(float(f"{value:.9g}"))
    if isinstance(value, bool) or value is None:
        return repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(row[i]) for i in order) for row in rows)


def compare(columns, rows, sql_columns, sql_rows):
    """Empty text if both results are the same bag of rows."""
    if sorted(columns) != sorted(sql_columns):
        return f"columns {sorted(columns)} != {sorted(sql_columns)}"
    mine, theirs = rows_of(columns, rows), rows_of(sql_columns, sql_rows)
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(bad)} rows differ, {sorted(columns)}: {bad[:3]}" if bad else ""


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def run_sql(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return columns, result.fetchall()


if __name__ == "__main__":
    import __spark_entry__ as entry
    from measlake.session import local_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = args or list(entry.queries())
    spark, con, sql = local_session("8"), connect(sf_dir), entry.oracle_sql()
    failed = []
    for name in names:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            spent = time.time() - start
            verdict = "no sql" if name not in sql else compare(df.columns, rows, *run_sql(con, sql[name]))
        except Exception as error:  # report and go on with the next query
            spent, verdict, rows = time.time() - start, f"{type(error).__name__}: {error}"[:1500], []
        if verdict not in ("", "no sql"):
            failed.append(name)
        print(f"{name:28s} {spent:7.2f}s rows={len(rows):7d} {verdict or 'ok'}", flush=True)
    print("FAILED", failed)

"""Compare registered queries with their SQL. `python tests/oracle.py [sf] [name ...]`."""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder):
    db = duckdb.connect()
    for table in TABLES.split():
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return db


def _cell(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, list):
        return tuple(_cell(v) for v in value)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, db, name, build, sql, folder):
    """Empty text if both sides agree, else what differs."""
    frame = build(spark, folder)
    ours = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    if sql is None:
        return "", len(ours)
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    theirs = canonical(names, result.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}", len(ours)
    if ours == theirs and [[type(v) for v in r] for r in ours] == [[type(v) for v in r] for r in theirs]:
        return "", len(ours)
    left, right = set(ours), set(theirs)
    mine, other = [r for r in ours if r not in right][:2], [r for r in theirs if r not in left][:2]
    return f"rows {len(ours)}/{len(theirs)} {sorted(names)}\n   spark {mine}\n   sql   {other}\n types {[type(v).__name__ for v in ours[0]] if ours else ''} {[type(v).__name__ for v in theirs[0]] if theirs else ''}", len(ours)


def main():
    from tidemark.plans import catalog
    from tidemark.session import get_session

    scale, *names = sys.argv[1:] or ["0.01"]
    folder = f"/root/testdata/sf{scale}"
    spark = get_session("oracle")
    spark.sparkContext.setLogLevel("OFF")
    db, sqls, bad = connect(folder), catalog.oracle_sql(), 0
    for name, build in catalog.queries().items():
        if names and not any(name.startswith(n) if n.endswith("_") else name == n for n in names):
            continue
        start = time.time()
        try:
            problem, rows = compare(spark, db, name, build, sqls.get(name), folder)
        except Exception as error:  # noqa: BLE001
            problem, rows = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += bool(problem)
        mark = "FAIL" if problem else ("ok  " if name in sqls else "rows")
        print(f"{mark} {name} rows={rows} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} differ", flush=True)


if __name__ == "__main__":
    main()

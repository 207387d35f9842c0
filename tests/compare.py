"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

    python tests/compare.py [--sf 0.01] [name or name-prefix* ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def normal(value):
    if value is None:
        return None
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if type(value).__name__ == "Decimal":
        return ("decimal", str(value))
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir, name, fn, sql):
    started = time.time()
    df = fn(spark, sf_dir)
    columns = df.columns
    rows = [tuple(r) for r in df.collect()]
    spark_seconds = time.time() - started
    if sql is None:
        return "rows", f"{len(rows)} rows {spark_seconds:.1f}s"
    started = time.time()
    result = con.execute(sql)
    duck_columns = [d[0] for d in result.description]
    duck_rows = result.fetchall()
    duck_seconds = time.time() - started
    note = f"{len(rows)} rows {spark_seconds:.1f}s / {duck_seconds:.1f}s"
    a_cols, a = sorted_rows(columns, rows)
    b_cols, b = sorted_rows(duck_columns, duck_rows)
    if a_cols != b_cols:
        return "FAIL", f"columns {a_cols} != {b_cols}"
    if len(a) != len(b):
        extra = [r for r in a if r not in set(b)][:3] if len(a) < 200000 else []
        missing = [r for r in b if r not in set(a)][:3] if len(b) < 200000 else []
        return "FAIL", f"{note}; rows {len(a)} != {len(b)}; only spark {extra}; only sql {missing}"
    bad = [(x, y) for x, y in zip(a, b) if x != y or [type(v) for v in x] != [type(v) for v in y]]
    if bad:
        return "FAIL", f"{note}; {len(bad)} rows differ, e.g. {bad[0]}"
    if not a:
        return "EMPTY", note
    return "ok", note


def main(argv):
    sf = "0.01"
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    from citygrain.session import build_session
    from __spark_entry__ import oracle_sql, queries

    spark = build_session(
        "compare",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    sql = oracle_sql()
    failed = 0
    for name, fn in queries().items():
        if argv and not any(name == a or (a.endswith("*") and name.startswith(a[:-1])) for a in argv):
            continue
        try:
            status, note = compare(spark, con, sf_dir, name, fn, sql.get(name))
        except Exception as error:  # report and go on
            status, note = "ERROR", f"{type(error).__name__}: {str(error)[:600]}"
        failed += status in ("FAIL", "ERROR", "EMPTY")
        print(f"{status:6} {name:40} {note}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1:])

"""Runs registered queries beside their SQL in DuckDB and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    """Values with their kind, so that 1, 1.0 and '1' differ."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return f"b:{value}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"f:{value + 0.0!r}"
    if isinstance(value, decimal.Decimal):
        return f"dec:{value}"
    if isinstance(value, datetime.datetime):
        return f"t:{value.isoformat()}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return f"{type(value).__name__}:{value}"


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = normal([c[0] for c in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} vs {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows vs {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if bad:
        return f"{len(bad)} of {len(got[1])} rows differ: spark={bad[0][0]} sql={bad[0][1]}"
    return None


def main(folder, patterns):
    import __spark_entry__ as entry
    from cargolith.session import build_session

    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, run in queries.items():
        if patterns and not any(name.startswith(p) for p in patterns):
            continue
        began = time.time()
        try:
            df = run(spark, folder)
            if name in sqls:
                problem = compare(df, con, sqls[name])
                if problem is None:
                    n = con.execute(f"SELECT count(*) FROM ({sqls[name]})").fetchall()[0][0]
                    problem = None if n else "no rows"
            else:
                n = len(df.collect())
                problem = None if n else "no rows"
        except Exception as e:  # noqa: BLE001 - report and go on
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        failed += problem is not None
        tag = "ok  " if problem is None else "FAIL"
        print(f"{tag} {name} {time.time() - began:.1f}s {'' if name in sqls else '(rows only) '}{problem or n}", flush=True)
    print(f"failed: {failed}")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])

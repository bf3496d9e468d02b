"""Run registered queries beside their oracle SQL and compare whole results.

    python tests/oracle.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyglass.plans.catalogue.views import BASE  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(x):
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, decimal.Decimal):
        return str(x.normalize())
    if isinstance(x, float):
        return f"{x:.9g}"
    if isinstance(x, (dt.date, dt.datetime)):
        return x.isoformat()
    return None if x is None else str(x)


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((x is not None, x or "") for x in r))
    return [columns[i] for i in order], out


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    mine = normal(df.columns, df.collect())
    cur = con.execute(sql)
    theirs = normal([d[0] for d in cur.description], cur.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} vs {theirs[0]}"
    if mine[1] == theirs[1]:
        return None
    a, b = set(mine[1]), set(theirs[1])
    return (
        f"rows {len(mine[1])} vs {len(theirs[1])}; only here {sorted(a - b, key=str)[:2]}; "
        f"only oracle {sorted(b - a, key=str)[:2]}"
    )


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from tallyglass.session import build_session

    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                diff = compare(df, con, oracles[name])
            else:
                n = df.count()
                diff = None if n else "no rows"
        except Exception as e:  # report and go on
            diff = "error " + str(e)[:1500]
        took = time.time() - start
        kind = "oracle" if name in oracles else "rows"
        print(f"{'ok ' if diff is None else 'BAD'} {name:24s} {kind} {took:6.2f}s", diff or "", flush=True)
        bad += diff is not None
    print(f"{bad} bad of {len(names or queries)}, {len(oracles)} oracles")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)

"""Run registered queries in Spark and DuckDB and compare all rows exactly."""

from __future__ import annotations

import datetime
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from claimtide.lens.tables import BASE_TABLES  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences between a DataFrame and a query, as messages."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected = cur.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns differ: only Spark {sorted(set(df.columns) - set(names))}, "
                f"only SQL {sorted(set(names) - set(df.columns))}"]
    got = df.collect()
    if len(got) != len(expected):
        problems.append(f"rows: Spark {len(got)}, SQL {len(expected)}")
    a, b = rows_of(df.columns, got), rows_of(names, expected)
    if a != b:
        problems.append(f"columns {sorted(names)}")
        problems.append(f"only Spark: {list((a - b).items())[:3]} of {sum((a - b).values())}")
        problems.append(f"only SQL:   {list((b - a).items())[:3]} of {sum((b - a).values())}")
    kinds = {n: str(d[1]) for n, d in zip(names, cur.description)}
    for name, kind in df.dtypes:
        loose = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
                 "TIMESTAMP": "timestamp", "BOOLEAN": "boolean"}.get(kinds[name], kinds[name])
        if loose != kind and not (loose == "NUMBER" and kind in ("int", "bigint", "double")):
            problems.append(f"type of {name}: Spark {kind}, SQL {kinds[name]}")
    return problems


def main(argv):
    import __spark_entry__ as entry
    from claimtide.session import build_session

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", confs={
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    wanted = argv[1:] or list(queries)
    bad = 0
    for name in wanted:
        t = time.time()
        try:
            df = queries[name](spark, sf)
            problems = compare(df, con, oracles[name]) if name in oracles else [f"no SQL, {df.count()} rows"]
            n = con.execute(f"select count(*) from ({oracles[name]})").fetchall()[0][0] if name in oracles else 0
        except Exception as e:  # report and go on with the next query
            problems, n = [f"{type(e).__name__}: {str(e)[:900]}"], -1
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} rows={n} {time.time() - t:.1f}s", flush=True)
        for p in problems:
            print("     ", p, flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")


if __name__ == "__main__":
    main(sys.argv[1:])

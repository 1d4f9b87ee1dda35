"""Run registered queries next to their SQL oracles and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v):
    if v is None:
        return ("", None)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (int, decimal.Decimal)):
        return ("n", str(decimal.Decimal(v).normalize()))
    if isinstance(v, float):
        return ("f", "nan" if math.isnan(v) else f"{v:.9g}")
    if isinstance(v, (datetime.date, datetime.datetime)):
        return ("d", v.isoformat())
    return ("s", str(v))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows), sorted(names)


def compare(spark, con, name, query, sql, sf_dir):
    """Empty text when equal, otherwise what differs."""
    df = query(spark, sf_dir)
    ours, our_names = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return "" if ours else "no rows"
    cur = con.execute(sql)
    theirs, their_names = rows_of([d[0] for d in cur.description], cur.fetchall())
    if our_names != their_names:
        return f"columns {our_names} <> {their_names}"
    if ours != theirs:
        a, b = sorted(set(ours) - set(theirs))[:2], sorted(set(theirs) - set(ours))[:2]
        return f"{len(ours)} rows <> {len(theirs)} rows\n   ours  {a}\n   sql   {b}"
    if not ours:
        return "both empty"
    return ""


def main() -> None:
    import __spark_entry__ as entry
    from plumbline.session import local_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            diff = compare(spark, con, name, query, oracle.get(name), sf_dir)
        except Exception as e:
            diff = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += bool(diff)
        print(f"{name:28s} {time.time() - start:6.2f}s {diff or 'ok'}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()

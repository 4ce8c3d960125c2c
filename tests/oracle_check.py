"""Compare a registered query with its SQL text on one data folder."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def canonical(columns: list[str], rows: list) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(spark, con, folder: str, name: str, fn, sql: str | None) -> tuple[bool, str]:
    start = time.time()
    df = fn(spark, folder)
    rows = df.collect()
    took = time.time() - start
    if sql is None:
        return True, f"{len(rows)} rows, no SQL, {took:.1f}s"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    other = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = canonical(df.columns, [tuple(r) for r in rows]), canonical(names, other)
    if a == b:
        return True, f"{len(rows)} rows, {took:.1f}s"
    sa, sb = set(a), set(b)
    diff = sorted(sa - sb)[:3], sorted(sb - sa)[:3]
    return False, f"{len(a)} vs {len(b)} rows, {len(sa - sb)} differ, e.g. {sorted(df.columns)}\n   spark {diff[0]}\n   sql   {diff[1]}"


def main() -> None:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from celltrace.session import build_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sqls = entry.oracle_sql()
    bad = []
    for name, fn in entry.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        try:
            ok, note = compare(spark, con, folder, name, fn, sqls.get(name))
        except Exception as exc:  # report and go on with the next query
            ok, note = False, f"{type(exc).__name__}: {str(exc)[:600]}"
        print("ok  " if ok else "FAIL", name, note, flush=True)
        if not ok:
            bad.append(name)
    print("failed:", bad)


if __name__ == "__main__":
    main()

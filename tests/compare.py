"""Run registered queries in Spark and their oracles in DuckDB and compare."""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
#: Queries that SQL cannot express; tests compare them with a plain computation.
BRUTE_FORCE = {"page_chunks"}
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    def cell(v):
        if isinstance(v, float):
            return round(v, 6)
        return v
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, sf_dir: str, fn, sql: str | None) -> str | None:
    """None if equal, else what differs."""
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if name in BRUTE_FORCE or name.startswith("op") or name == "pipeline" else "no oracle"
    res = con.execute(sql)
    columns = [d[0] for d in res.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    want = rows_of(columns, res.fetchall())
    if got == want:
        return None if got else "both empty"
    extra = [r for r in got if r not in set(want)][:3]
    lost = [r for r in want if r not in set(got)][:3]
    return f"spark {len(got)} rows, oracle {len(want)}; only spark {extra}; only oracle {lost}"


def main() -> None:
    from chatloom.session import local_session
    import __spark_entry__ as entry

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session(os.environ.get("COMPARE_CPUS", "8"))
    con = oracle_connection(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        t = time.time()
        try:
            problem = compare(spark, con, name, sf_dir, fn, oracles.get(name))
        except Exception as e:  # report and go on to the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'OK  ' if problem is None else 'FAIL'} {name} {time.time() - t:.1f}s"
              f"{'' if name in oracles else ' (rows only)'} {problem or ''}"[:2500], flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()

"""Run registered queries next to their oracles: ``python -m workload.check SF_DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from strataseek.session import build_session
from workload.oracle import all_oracles
from workload.queries import all_queries

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(rows, columns) -> list[tuple]:
    """Rows with columns in name order, sorted, nulls and NaN made equal."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return None if math.isnan(v) else v + 0.0
        return v

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> str:
    started = time.perf_counter()
    df = all_queries()[name](spark, sf_dir)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    took = time.perf_counter() - started
    oracle = all_oracles().get(name)
    if oracle is None:
        return f"ROWS {name}: {len(got)} rows, {took:.1f}s"
    started = time.perf_counter()
    cursor = con.execute(oracle)
    columns = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    want = normal(cursor.fetchall(), columns)
    sql_took = time.perf_counter() - started
    note = f"{name}: {len(got)} rows, {took:.1f}s, oracle {sql_took:.1f}s"
    odd = {c: t for c, t in types.items() if t in ("HUGEINT",) or t.startswith(
        ("DECIMAL", "TIMESTAMP", "DATE")) or t.endswith("[]")}
    if odd:
        note += f" TYPES {odd}"
    if sorted(df.columns) != sorted(columns):
        return f"FAIL {note} columns {sorted(df.columns)} / {sorted(columns)}"
    if got == want:
        return f"ok   {note}"
    only_got = [r for r in got if r not in set(want)][:3]
    only_want = [r for r in want if r not in set(got)][:3]
    return (f"FAIL {note} / {len(want)} rows\n  got  {str(only_got)[:900]}"
            f"\n  want {str(only_want)[:900]}")


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(all_queries())
    spark, con = build_session("check", 8), connect(sf_dir)
    for name in names:
        try:
            print(compare(spark, con, sf_dir, name), flush=True)
        except Exception as error:
            print(f"ERR  {name}: {type(error).__name__} {str(error)[:700]}", flush=True)


if __name__ == "__main__":
    main()

"""Run queries beside their SQL oracle: python tests/oracle_check.py [scale] [query ...]"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    if isinstance(value, datetime.date | datetime.datetime):
        return value.isoformat()
    return value


def table_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    values = [tuple(repr(plain(row[i])) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(values)


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    got = table_of(df.columns, df.collect())
    cursor = con.execute(sql)
    want = table_of([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows, expected {len(want[1])}"
    wrong = [(g, w) for g, w in zip(got[1], want[1], strict=True) if g != w]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main(scale: str, names: list[str]) -> int:
    import __spark_entry__ as contract
    from tidemark.session import local_session

    spark = local_session()
    sf_dir = f"/root/testdata/{scale}"
    con = connect(sf_dir)
    queries, oracle = contract.queries(), contract.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracle:
                problem = compare(df, con, oracle[name])
                verdict = "ok" if problem is None else f"DIFF {problem}"
            else:
                verdict = f"rows {len(df.collect())}"
        except Exception as error:  # noqa: BLE001
            verdict = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        bad += verdict.startswith(("DIFF", "ERROR"))
        print(f"{name:32s} {time.time() - start:6.2f}s {verdict[:1500]}", flush=True)
    missing = sorted(set(oracle) - set(queries))
    print(f"{bad} bad, without oracle: {sorted(set(queries) - set(oracle))}, oracle without query: {missing}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "sf0.01", sys.argv[2:]))

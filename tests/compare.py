"""Run registered queries next to their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


def rows_of(df):
    names = sorted(df.columns)
    return names, sorted((tuple(_cell(r[c]) for c in names) for r in df.collect()), key=repr)


def rows_of_sql(con, text):
    cur = con.execute(text)
    cols = [c[0] for c in cur.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = sorted((tuple(_cell(r[i]) for i in order) for r in cur.fetchall()), key=repr)
    return [cols[i] for i in order], rows


def kinds(rows):
    out = [set() for _ in (rows[0] if rows else ())]
    for r in rows:
        for i, v in enumerate(r):
            if v is not None:
                out[i].add(type(v).__name__)
    return out


def difference(spark, con, sf_dir, name, query, text):
    """Empty text where both sides agree."""
    names, got = rows_of(query(spark, sf_dir))
    want_names, want = rows_of_sql(con, text)
    if names != want_names:
        return f"columns {names} <> {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} <> {len(want)}"
    if kinds(got) != kinds(want):
        return f"types {kinds(got)} <> {kinds(want)}"
    off = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(off)} of {len(got)} rows differ, first {off[0]}" if off else ""


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tallyrill.session import local_session

    sf_dir = sys.argv[1]
    only = sys.argv[2:]
    spark, con = local_session(), database(sf_dir)
    oracle = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            if name in oracle:
                note = difference(spark, con, sf_dir, name, query, oracle[name])
            else:
                note = "" if query(spark, sf_dir).count() else "no rows"
        except Exception as problem:
            note = f"{type(problem).__name__}: {str(problem)[:600]}"
        bad += bool(note)
        print(f"{'DIFF' if note else 'ok  '} {name} {time.time() - start:.1f}s "
              f"{'' if name in oracle else '(rows only) '}{note}", flush=True)
    print("differences:", bad)

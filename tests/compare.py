"""Compare registered queries with their SQL. As a script: ``python -m tests.compare 0.01 [query ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings"
          " pages benchmark labels conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0  # no minus zero
    return list(value) if isinstance(value, (list, tuple)) else value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None where names, row count and values agree."""
    got_columns, got = _sorted_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    want_columns, want = _sorted_rows([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{str(a)[:600]} != {str(b)[:600]}"
    return None


def types(spark_df, con, sql: str) -> tuple[dict, dict]:
    described = con.execute(f"describe {sql}").fetchall()
    return dict(spark_df.dtypes), {row[0]: row[1] for row in described}


def main(scale: str, names: list[str]) -> int:
    from tests.session import local_session
    import __spark_entry__ as entry

    folder = f"/root/testdata/sf{scale}"
    spark, con = local_session(), duck(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracle:
                diff = difference(df, con, oracle[name])
                note = str(types(df, con, oracle[name])) if "-t" in sys.argv else ""
                verdict = "ok" if diff is None else f"DIFF {diff}"
                verdict += f" rows={df.count()} {note}"
            else:
                verdict = f"rows {df.count()}"
                diff = None
        except Exception as e:  # noqa: BLE001
            diff = verdict = f"ERROR {type(e).__name__} {str(e)[:1500]}"
        bad += diff is not None
        print(f"{name}: {verdict} [{time.time() - start:.1f}s]", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], [a for a in sys.argv[2:] if a != "-t"]))

"""Holds a query's rows against those of its SQL counterpart on the same tables."""

from __future__ import annotations

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def sql_rows(sql: str, sf_dir: str) -> tuple[list[str], list[str], list[tuple]]:
    with duckdb.connect() as c:
        for t in TABLES:
            c.sql(f"CREATE VIEW {t} AS FROM '{sf_dir}/{t}.parquet'")
        out = c.sql(sql)
        return out.columns, [str(t) for t in out.types], out.fetchall()


def normal(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])

    def plain(x):
        if isinstance(x, float):
            return 0.0 if x == 0 else round(x, 9)
        if isinstance(x, (list, tuple)):
            return tuple(map(plain, x))
        return str(x) if hasattr(x, "isoformat") else x

    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


def differences(df, sql: str, sf_dir: str) -> str:
    columns, types, wanted = sql_rows(sql, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)}, not {sorted(columns)}"
    a, b = normal(df.columns, got), normal(columns, wanted)
    if a != b:
        only = [x for x in a if x not in set(b)][:2], [x for x in b if x not in set(a)][:2]
        return f"{len(a)} rows, not {len(b)}; only here {only[0]}; only there {only[1]}"
    kinds = dict(zip(columns, types, strict=True))
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP"}
    odd = [(c, t, kinds[c]) for c, t in df.dtypes if t in names and names[t] != kinds[c]]
    return f"types {odd}" if odd else ""

"""Run a query and its oracle on the same tables and compare the rows."""

from __future__ import annotations

from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
}


def _normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, bool) or v is None:
            return str(v)
        if isinstance(v, (int, float)):
            return repr(float(v))
        return str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def difference(df, sql: str, con) -> str | None:
    """None if equal, else what differs first."""
    result = con.execute(sql)
    want, want_columns = _normal(result.fetchall(), [d[0] for d in result.description])
    types = {d[0]: SPARK_TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    got, got_columns = _normal([tuple(r) for r in df.collect()], df.columns)
    if want_columns != got_columns:
        return f"columns {got_columns} != {want_columns}"
    if types != dict(df.dtypes):
        return f"types {sorted(df.dtypes)} != {sorted(types.items())}"
    if len(want) != len(got):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{sum(x != y for x, y in zip(got, want))} rows differ, first {str(a)[:600]} != {str(b)[:600]}"
    return None

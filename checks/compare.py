"""Run a query and its check side by side on one scale and report the difference."""

import math

from checks.testmart import SOURCES

TABLES = (*SOURCES, "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return repr(value)


def difference(connection, df, sql: str) -> tuple[int, str | None]:
    """Row count of the Spark result and the first difference, None when both agree."""
    columns = sorted(df.columns)
    rows = df.select(*columns).collect()
    result = connection.sql(sql)
    if sorted(result.columns) != columns:
        return len(rows), f"columns {columns} against {sorted(result.columns)}"
    wide = [n for n, t in zip(result.columns, result.types) if str(t) in ("HUGEINT", "UHUGEINT") or "DECIMAL" in str(t)]
    if wide:
        return len(rows), f"check returns wide types for {wide}"
    expected = result.select(", ".join(f'"{c}"' for c in columns)).fetchall()
    ours = sorted([[_cell(v) for v in row] for row in rows], key=str)
    theirs = sorted([[_cell(v) for v in row] for row in expected], key=str)
    if len(ours) != len(theirs):
        return len(rows), f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return len(rows), f"{columns}: {a} against {b}"
    return len(rows), None

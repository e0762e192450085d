"""Compare Spark queries with their SQL run by DuckDB on the same files."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def _canonical(df: pd.DataFrame) -> list[tuple]:
    def text(v) -> str:
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "NULL"
        if hasattr(v, "isoformat"):
            return v.isoformat()[:10]
        if isinstance(v, bool) or type(v).__name__ == "bool_":
            return str(bool(v))
        if isinstance(v, (int, float)) or hasattr(v, "dtype"):
            return repr(float(v))
        return str(v)

    columns = sorted(df.columns)
    return sorted(tuple(text(v) for v in row) for row in df[columns].itertuples(index=False))


def differences(spark_df, sql: str, con: duckdb.DuckDBPyConnection) -> list[str]:
    ours = spark_df.toPandas()
    theirs = con.execute(sql).fetchdf()
    if sorted(ours.columns) != sorted(theirs.columns):
        return [f"columns {sorted(ours.columns)} against {sorted(theirs.columns)}"]
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows against {len(theirs)}"]
    a, b = _canonical(ours), _canonical(theirs)
    return [f"{x} against {y}" for x, y in zip(a, b) if x != y][:3]

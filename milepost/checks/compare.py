"""Row-by-row comparison of a Spark result with the oracle's."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from pathlib import Path

from pyspark.sql import DataFrame


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def oracle_connection(sf_dir: str):
    """DuckDB connection with every Parquet file of a folder as a view."""
    import duckdb

    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def difference(df: DataFrame, con, sql: str) -> str | None:
    """None when both sides hold the same rows, else a short description."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected_rows = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(df.columns)} and {sorted(names)}"
    order = sorted(names)
    positions = [names.index(c) for c in order]
    expected = Counter(tuple(_plain(row[p]) for p in positions) for row in expected_rows)
    actual = Counter(
        tuple(_plain(v) for v in row) for row in df.select(*[f"`{c}`" for c in order]).collect()
    )
    if expected == actual:
        return None
    extra, missing = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows against {sum(expected.values())}; "
        f"{sum(extra.values())} only in Spark, {sum(missing.values())} only in SQL; "
        f"columns {order}; Spark {_sample(extra)}; SQL {_sample(missing)}"
    )


def _sample(rows: Counter) -> list[str]:
    return [repr(row)[:600] for row in sorted(rows, key=repr)[:2]]

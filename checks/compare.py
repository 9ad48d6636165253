"""Run a query and its oracle on the same tables and compare the rows."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "NaN" if value != value else repr(value + 0.0)
    if isinstance(value, Decimal):
        return repr(float(value))
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(v) for v in row) for row in df.select(*names).collect())


def oracle_rows(folder: str, sql: str) -> tuple[list[str], Counter]:
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    return [columns[i] for i in order], rows


def differences(df: DataFrame, folder: str, sql: str) -> str | None:
    """None when equal, else what differs."""
    names, got = spark_rows(df)
    expected_names, expected = oracle_rows(folder, sql)
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if got == expected:
        return None if got else "both empty"
    extra, missing = got - expected, expected - got
    return (
        f"{got.total()} rows against {expected.total()}; "
        f"{extra.total()} extra like {list(extra)[:3]}; {missing.total()} missing like {list(missing)[:3]}"
    )

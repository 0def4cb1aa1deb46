"""Results of Spark and DuckDB as comparable multisets."""

from collections import Counter
from decimal import Decimal

import duckdb

from showcase.queries import TABLES


def cell(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return float(f"{value:.12g}")
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


def spark_result(df):
    return sorted(df.columns), bag(df.columns, df.collect())


def duckdb_result(sf_dir, text):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    cursor = connection.execute(text)
    columns = [c[0] for c in cursor.description]
    return sorted(columns), bag(columns, cursor.fetchall())

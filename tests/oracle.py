"""Compare a registered query with its SQL."""

from __future__ import annotations

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def rows_of(table) -> tuple[dict[str, str], list[tuple]]:
    """Column types and sorted rows of an Arrow table, columns in name order."""
    names = sorted(table.column_names)
    types = {n: str(table.schema.field(n).type).replace("large_", "") for n in names}
    columns = [table.column(n).to_pylist() for n in names]
    return types, sorted(zip(*columns), key=repr)


def compare(spark_df, connection, sql: str) -> list[str]:
    """Differences, none if the two agree."""
    ours_types, ours = rows_of(spark_df.toArrow())
    their_types, theirs = rows_of(connection.sql(sql).to_arrow_table())
    problems = []
    if ours_types != their_types:
        problems.append(f"types: {ours_types} != {their_types}")
    if len(ours) != len(theirs):
        problems.append(f"rows: {len(ours)} != {len(theirs)}")
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if different:
        problems.append(f"{len(different)} rows differ, first {different[0]}")
    return problems

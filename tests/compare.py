"""Row-by-row comparison of a Spark result with DuckDB's."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# Spark's type names for the DuckDB types that results use.
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _sortable(row):
    return [(value is not None, str(type(value)), value if value is not None else 0) for value in row]


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Every way in which the two results differ; empty when they agree."""
    relation = con.sql(sql)
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    actual_types = dict(df.dtypes)
    if sorted(expected_types) != sorted(actual_types):
        return [f"columns: {sorted(actual_types)} but SQL has {sorted(expected_types)}"]
    found = [
        f"type of {name}: {actual_types[name]} but SQL has {kind}"
        for name, kind in expected_types.items()
        if TYPES.get(kind, kind) != actual_types[name]
    ]
    names = sorted(expected_types)
    expected = relation.project(", ".join(f'"{name}"' for name in names)).fetchall()
    actual = [tuple(row) for row in df.select(*(f"`{name}`" for name in names)).collect()]
    if len(expected) != len(actual):
        found.append(f"rows: {len(actual)} but SQL has {len(expected)}")
    for mine, theirs in zip(sorted(actual, key=_sortable), sorted(expected, key=_sortable)):
        if mine != theirs:
            found.append(f"row {dict(zip(names, mine))} but SQL has {dict(zip(names, theirs))}")
            break
    return found

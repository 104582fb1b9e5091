"""Run a query and its SQL on the same tables and compare every cell."""

from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"create view {table} as select * from read_parquet('{path}')")
    return con


def _sortable(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    rows = [tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()]
    return names, sorted(rows, key=_sortable)


def duck_rows(con, statement: str) -> tuple[list[str], list[tuple], list[str]]:
    result = con.sql(statement)
    order = sorted(range(len(result.columns)), key=lambda i: result.columns[i])
    names = [result.columns[i] for i in order]
    kinds = [str(result.types[i]) for i in order]
    rows = [tuple(r[i] for i in order) for r in result.fetchall()]
    return names, sorted(rows, key=_sortable), kinds


SAME_KIND = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def mismatch(df, con, statement: str) -> str | None:
    """None if names, types and all rows are equal, else what differs."""
    names, rows = spark_rows(df)
    other_names, other_rows, kinds = duck_rows(con, statement)
    if names != other_names:
        return f"columns {names} != {other_names}"
    spark_kinds = dict(df.dtypes)
    for name, kind in zip(names, kinds):
        if SAME_KIND.get(kind) != spark_kinds[name]:
            return f"type of {name}: {spark_kinds[name]} != {kind}"
    if len(rows) != len(other_rows):
        return f"{len(rows)} rows != {len(other_rows)}"
    for a, b in zip(rows, other_rows):
        if a != b:
            cells = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
            return f"row differs: {cells[:5]}"
    return None

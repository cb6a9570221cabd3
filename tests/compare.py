"""Result of a query against DuckDB's answer to its SQL: names, types and the multiset of rows."""

import duckdb
import pyarrow as pa

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
          " labels conversations").split()


def connect(root):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root}/{name}.parquet')")
    return con


def _plain(kind):
    if pa.types.is_large_string(kind):
        return pa.string()
    if pa.types.is_timestamp(kind):
        return pa.timestamp("us")
    return kind


def _rows(table):
    names = sorted(table.column_names)
    return names, [str(_plain(table.schema.field(n).type)) for n in names], sorted(
        map(repr, zip(*[table.column(n).to_pylist() for n in names]))
    )


def differences(df, sql, con):
    names, types, rows = _rows(df.toArrow())
    their_names, their_types, their_rows = _rows(con.sql(sql).to_arrow_table())
    found = []
    if names != their_names:
        found.append(f"columns {names} != {their_names}")
    elif types != their_types:
        found.append(f"types {[(n, a, b) for n, a, b in zip(names, types, their_types) if a != b]}")
    if rows != their_rows:
        ours, theirs = set(rows) - set(their_rows), set(their_rows) - set(rows)
        found.append(f"{len(rows)} rows != {len(their_rows)}; only ours {sorted(ours)[:3]}, only theirs {sorted(theirs)[:3]}")
    return found

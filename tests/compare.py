"""Run a registered query and its SQL, and compare columns, types and rows."""

from __future__ import annotations

import re
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

DUCK_TO_SPARK = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _duck_type(kind: str) -> str:
    text = str(kind).upper()
    match = re.match(r"DECIMAL\((\d+),\s*(\d+)\)", text)
    return f"decimal({match[1]},{match[2]})" if match else DUCK_TO_SPARK.get(text, text)


def run_sql(con, statement: str):
    relation = con.sql(statement)
    order = sorted(range(len(relation.columns)), key=lambda i: relation.columns[i])
    names = [relation.columns[i] for i in order]
    types = [_duck_type(relation.types[i]) for i in order]
    return names, types, Counter(tuple(row[i] for i in order) for row in relation.fetchall())


def run_spark(df):
    names = sorted(df.columns)
    kinds = dict(df.dtypes)
    types = [kinds[n].replace("timestamp_ntz", "timestamp") for n in names]
    return names, types, Counter(tuple(row) for row in df.select(*names).collect())


def differences(df, con, statement: str) -> list[str]:
    names, types, rows = run_spark(df)
    sql_names, sql_types, sql_rows = run_sql(con, statement)
    found = []
    if names != sql_names:
        return [f"columns {names} != {sql_names}"]
    if types != sql_types:
        found.append(f"types {[(n, a, b) for n, a, b in zip(names, types, sql_types) if a != b]}")
    only_spark, only_sql = rows - sql_rows, sql_rows - rows
    if only_spark or only_sql:
        key = repr
        found.append(
            f"{sum(rows.values())} rows, SQL {sum(sql_rows.values())}; columns {names}\n"
            f"  only Spark ({sum(only_spark.values())}): {sorted(only_spark, key=key)[:3]}\n"
            f"  only SQL   ({sum(only_sql.values())}): {sorted(only_sql, key=key)[:3]}"
        )
    if not rows:
        found.append("no rows at all")
    return found

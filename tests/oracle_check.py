"""Compares registered queries with their SQL on one scale: python tests/oracle_check.py SF_DIR [name...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    return columns, sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(r[i] for i in order) for r in result.fetchall()]
    return [names[i] for i in order], sorted(rows, key=repr)


def difference(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when columns and rows agree, else a short account of the first difference."""
    columns, got = spark_rows(query(spark, sf_dir))
    sql_columns, expected = sql_rows(con, sql)
    if columns != sql_columns:
        return f"columns {columns} / {sql_columns}"
    if len(got) != len(expected):
        return f"rows {len(got)} / {len(expected)}; first {got[:1]} / {expected[:1]}"
    for a, b in zip(got, expected):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"value {a} / {b}"
    return None


def main() -> None:
    from aislewise.plans.oracle import ORACLE_SQL
    from aislewise.plans.queries import QUERIES
    from aislewise.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    for name, query in QUERIES.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            found = difference(spark, con, query, ORACLE_SQL[name], sf_dir) if name in ORACLE_SQL else "no SQL"
        except Exception as error:  # report and go on with the next query
            found = f"error {str(error)[:400]}"
        print("ok  " if found is None else "DIFF", name, f"{time.time() - start:.1f}s", found or "", flush=True)


if __name__ == "__main__":
    main()

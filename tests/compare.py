"""Results of both engines as sorted rows of text."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

from waymark.plans.proxies import TABLES


def cell(v) -> str:
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return f"{float(v):.6g}"
    return str(v)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted(tuple(cell(r[n]) for n in names) for r in df.collect())


def duck_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    c.execute(sql)
    at = [d[0] for d in c.description]
    order = sorted(range(len(at)), key=lambda i: at[i])
    return [at[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in c.fetchall())

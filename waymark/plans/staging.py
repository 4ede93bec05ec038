"""Output staging and reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A-6: (table_name, n_rows), one distributed count per table in one job."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.union(one)
    if out is None:
        raise ValueError("no tables")
    return out


def remap(df: DataFrame, layout: Mapping[str, tuple[Column | None, str]]) -> DataFrame:
    """E-16, R-14: a staging layout: output column to (source, type); no source gives typed nulls."""
    return df.select(*[(F.lit(None) if c is None else c).cast(kind).alias(name) for name, (c, kind) in layout.items()])


def empty_table(spark: SparkSession, schema: str) -> DataFrame:
    """W-12: a typed table without rows."""
    return spark.createDataFrame([], schema)




def address_road_layout() -> dict[str, tuple[Column | None, str]]:
    """R-14: the staging columns of an address with its road."""
    c = F.col
    return {
        "mslink": (c("mslink"), "int"), "mapid": (None, "int"), "ad_pfi": (c("pfi"), "string"), "st_num": (c("st_num"), "string"), "hi_num": (c("hi_num"), "string"),
        "lv_apt": (c("lv_apt"), "string"), "road_pfi": (c("road_pfi"), "long"), "side": (c("side_of_road"), "string"), "road_name": (c("road_name"), "string"),
        "road_type": (c("road_type"), "string"), "road_suffix": (c("road_suffix"), "string"), "locality": (c("locality_name"), "string"), "x_uor": (c("x") * 100, "double"),
        "y_uor": (c("y") * 100, "double"), "created": (None, "timestamp"), "retired": (None, "timestamp"),
    }

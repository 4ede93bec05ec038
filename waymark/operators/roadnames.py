"""Road names: distinct name triples, aliases and name ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import road_name_parts, route_name_parts

Triple = tuple[str, str, str]


def name_triples(roads: DataFrame, triples: Sequence[Triple]) -> DataFrame:
    """U-1: the distinct (road_name, road_type, road_suffix) of several column triples, in one scan; empty names are skipped."""
    each = F.array(*[F.struct(*road_name_parts(*(F.col(c) for c in t))) for t in triples])
    return roads.select(F.explode(each).alias("t")).select("t.road_name", "t.road_type", "t.road_suffix").where("road_name <> ''").distinct()


def road_aliases(roads: DataFrame, register: DataFrame, triples: Sequence[Triple], key: str = "pfi", route: str | None = None, structure: str | None = None) -> DataFrame:
    """R-11, U-5: (key, road_name_id, alias_number, route_flag).

    Names are numbered 0, 1, ... in the order of ``triples``, then the route number (8)
    and the structure name (9); empty ones are skipped, and of equal ids of
    one road the first stays.
    """
    names = [F.struct(*road_name_parts(*(F.col(c) for c in t)), F.lit(i).alias("alias_number")) for i, t in enumerate(triples)]
    if route:
        names.append(F.struct(*route_name_parts(F.col(route)), F.lit(8).alias("alias_number")))
    if structure:
        names.append(F.struct(*road_name_parts(F.col(structure), F.lit(None), F.lit(None)), F.lit(9).alias("alias_number")))
    rows = roads.select(key, F.explode(F.array(*names)).alias("t")).select(key, "t.*").where("road_name <> ''")
    known = rows.join(register.select("road_name_id", "road_name", "road_type", "road_suffix"), ["road_name", "road_type", "road_suffix"])
    first = F.min(F.struct("alias_number", "route_flag")).alias("f")
    return known.groupBy(key, "road_name_id").agg(first).select(key, "road_name_id", "f.alias_number", "f.route_flag")


def name_ids(rows: DataFrame, register: DataFrame, key: str, triple: Triple, skip: Sequence[str] = ("TEMP",)) -> DataFrame:
    """R-12: (key, road_name_id) by the normal name; null and skipped names have none."""
    name = F.col(triple[0])
    some = rows.where(name.isNotNull() & ~name.isin(*skip)).select(key, *road_name_parts(*(F.col(c) for c in triple))).drop("route_flag")
    return some.join(register.select("road_name_id", "road_name", "road_type", "road_suffix"), ["road_name", "road_type", "road_suffix"]).select(key, "road_name_id")


def first_alias(aliases: DataFrame, key: str = "pfi") -> DataFrame:
    """The name id with the lowest alias number of each road: (key, road_name_id)."""
    w = Window.partitionBy(key).orderBy("alias_number", "road_name_id")
    return aliases.withColumn("__r", F.row_number().over(w)).where("__r = 1").select(key, "road_name_id")

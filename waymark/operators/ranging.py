"""House-number ranges per road side, near ranges and direction checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import near_max, near_min
from .registers import patch

SIDES = (("L", "left"), ("R", "right"))


def side_ranges(addresses: DataFrame, keys: Sequence[str] = ("road_pfi",), least_score: int = 50) -> DataFrame:
    """A-1: both sides' number and parity ranges in one aggregation: <side>_min, _max, _odd_min, _odd_max.

    Input: keys, side_of_road, house_number_1, house_number_2, rule_score. A
    second number counts for the maximum, else the first does.
    """
    number, top = F.col("house_number_1"), F.coalesce("house_number_2", "house_number_1")

    def on(side: str, value: Column) -> Column:
        return F.when(F.col("side_of_road") == side, value)

    aggs = [
        f(on(code, v)).alias(f"{name}_{label}")
        for code, name in SIDES
        for label, f, v in (("min", F.min, number), ("max", F.max, top), ("odd_min", F.min, number % 2), ("odd_max", F.max, number % 2))
    ]
    return addresses.where(F.col("rule_score") >= least_score).groupBy(*keys).agg(*aggs)


def address_type() -> Column:
    """0 if one side has one parity and the other is empty, or both have one and they differ; else 1."""
    single = {n: F.coalesce(F.col(f"{n}_odd_min") == F.col(f"{n}_odd_max"), F.lit(False)) for _, n in SIDES}
    empty = {n: F.col(f"{n}_odd_min").isNull() & F.col(f"{n}_odd_max").isNull() for _, n in SIDES}
    differ = single["left"] & single["right"] & (F.col("left_odd_min") != F.col("right_odd_min"))
    return F.when((single["left"] & empty["right"]) | (single["right"] & empty["left"]) | differ, 0).otherwise(1)


def road_ranging(roads: DataFrame, addresses: DataFrame, valid: DataFrame | None = None, patches: DataFrame | None = None, road_key: str = "pfi", geocoded: str | None = None) -> DataFrame:
    """R-6: every road with its ranges (null without addresses), patched by hand, and its address type.

    ``valid``: the address ids (addr_pfi) that take part, or all. ``geocoded``: only addresses with this
    geocode_source, as the second source asks for.
    """
    if geocoded is not None:
        addresses = addresses.where(F.col("geocode_source") == geocoded)
    if valid is not None:
        addresses = addresses.join(valid.select("addr_pfi").distinct(), "addr_pfi", "left_semi")
    ranges = side_ranges(addresses).withColumnRenamed("road_pfi", road_key)
    out = roads.select(road_key).join(ranges, road_key, "left")
    if patches is not None:
        out = patch(out, patches, road_key)
    return out.withColumn("address_type", address_type())


def node_links(roads: DataFrame, key: str = "pfi") -> DataFrame:
    """U-2: (road_pfi, ufi) for both nodes of each road, in one scan, each once."""
    return roads.select(F.col(key).alias("road_pfi"), F.explode(F.array_distinct(F.array("from_ufi", "to_ufi"))).alias("ufi"))


def near_ranges(roads: DataFrame, aliases: DataFrame, ranging: DataFrame, key: str = "pfi") -> DataFrame:
    """J-7, A-2: (pfi, road_name_id, number_min, number_max) over the roads, itself included, that share a node and the name.

    Ranges are reduced to one row per (node, name) before they meet the roads at
    that node, so a node with many roads costs its degree and not its square.
    """
    number = ranging.select(F.col(key).alias("road_pfi"), near_min(F.col("left_min"), F.col("right_min")).alias("lo"), near_max(F.col("left_max"), F.col("right_max")).alias("hi"))
    named = node_links(roads, key).join(aliases.select(F.col(key).alias("road_pfi"), "road_name_id").distinct(), "road_pfi")
    at_node = named.join(number, "road_pfi").groupBy("ufi", "road_name_id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    met = named.join(at_node, ["ufi", "road_name_id"])
    return met.groupBy(F.col("road_pfi").alias(key), "road_name_id").agg(F.min("lo").alias("number_min"), F.max("hi").alias("number_max"))


def road_flip(ranging: DataFrame, addresses: DataFrame, cross_streets: DataFrame, key: str = "pfi") -> DataFrame:
    """R-9: (key, ranges, left_inversed, right_inversed, flip_status) of the roads that have some range.

    A side is inversed if its last house number along the road is less than
    its first. Distances count to four decimals, ties go by the text of the id.
    ``cross_streets``: (key, to_rnid); without a row it is -1. A road of type 1
    with one inversed side, whose far end meets no other name, gets -1 if both
    sides have addresses that differ from first to last.
    """
    at = F.struct(F.round("dist_along", 4), F.col("addr_pfi").cast("string"))
    aggs = []
    for code, name in SIDES:
        on = F.col("side_of_road") == code
        aggs += [F.min_by(F.when(on, F.col("house_number_1")), F.when(on, at)).alias(f"{name}_first"), F.max_by(F.when(on, F.col("house_number_1")), F.when(on, at)).alias(f"{name}_last")]
    ends = addresses.where("house_number_1 is not null").groupBy(F.col("road_pfi").alias(key)).agg(*aggs)
    some = ranging.where("left_min is not null or left_max is not null or right_min is not null or right_max is not null")
    rows = some.join(ends, key, "left").join(cross_streets.select(key, "to_rnid"), key, "left")
    inv = {n: F.coalesce(F.col(f"{n}_last") < F.col(f"{n}_first"), F.lit(False)) for _, n in SIDES}
    moved = F.coalesce((F.col("left_last") != F.col("left_first")) & (F.col("right_last") != F.col("right_first")), F.lit(False))
    status = inv["left"].cast("int") + inv["right"].cast("int")
    open_end = (F.coalesce("to_rnid", F.lit(-1)) == -1) & moved
    return rows.select(
        key, "left_min", "left_max", inv["left"].alias("left_inversed"), "right_min", "right_max", inv["right"].alias("right_inversed"),
        F.when((status == 1) & (F.col("address_type") == 1) & open_end, -1).otherwise(status).alias("flip_status"),
    )

"""Final output tables: the layouts that readers of the dataset expect, and the joins that fill them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import soundex
from ..operators import registers
from .staging import remap

#: Column names and types of the output tables.
ADDRESS_ROAD = """CREATED_DATETIME timestamp, MODIFIED_DATETIME timestamp, PFI long, UFI long, Length double, ADDRESS_PFI string, ROAD_PFI long, ROAD_X_PFI long, SIDE_OF_ROAD string, MATCH_METHOD string,
    INPUT_ROAD_NAME_ID long, MATCH_ROAD_NAME_ID long, CROSS_COUNT long, DISTANCE_FROM_FEATURE double, DISTANCE_ALONG_FEATURE double, SCORE long, LOCALITY_NAME string, SOUNDEX string, Shape string"""
ADDRESS = """CREATED_DATETIME timestamp, MODIFIED_DATETIME timestamp, PFI long, UFI long, VicGrid94_X double, VicGrid94_Y double, INGR94_X double, INGR94_Y double, ESZ long,
    AMBULANCE string, FIRE string, POLICE string, SES string, AMBULANCE_PERCENT double, FIRE_PERCENT double, POLICE_PERCENT double, SES_PERCENT double,
    VicMapAddressPFI string, VicMapAddressUFI long, VicMapPropertyPFI string, EZI_ADDRESS string, CAD_STRING string, CAD_LV_APT string, CAD_ST_NUM string, NUMBER_1 int, NUMBER_2 int,
    ROAD_NAME string, ROAD_TYPE string, ROAD_SUFFIX string, ROAD_NAME_ID long, LOCALITY_NAME string, PREMISE_NAME string, TEMPORARY_ADDRESS string, MSLINK long, VicMapRoadPFI long, VicMapRoadXPFI long, MESSAGE string, WKT string"""
ROAD_ALIAS = """PFI long, UFI long, CLASS_CODE short, FEATURE_TYPE_CODE string, FROM_UFI long, TO_UFI long, LABEL_STRING string, ROAD_NAME_ID long, ROAD_NAME string, ROAD_TYPE string, ROAD_SUFFIX string, SOUNDEX string,
    ROUTE_FLAG int, ALIAS_NUMBER int, ALIAS_COUNT long, LEFT_LOCALITY string, RIGHT_LOCALITY string, LABEL_FLAG int, WKT string"""
INTERSECTION_ALIAS = """PFI long, UFI long, A_ROAD_NAME_ID long, A_ROAD_NAME string, A_ROAD_TYPE string, A_ROAD_SUFFIX string, A_SOUNDEX string, B_ROAD_NAME_ID long, B_ROAD_NAME string, B_ROAD_TYPE string, B_ROAD_SUFFIX string, B_SOUNDEX string,
    MSLINK long, LOCALITY_NAME string, MUN_SDX string, XVALUE double, YVALUE double, ESZ long, VERSION string, WKT string"""


def laid_out(df: DataFrame, layout: str, sources: Mapping[str, Column]) -> DataFrame:
    """E-16: the columns of a layout in its order, each from its source or as typed nulls."""
    columns = [c.split() for c in layout.split(",")]
    if unknown := set(sources) - {name for name, _ in columns}:
        raise ValueError(f"not in the layout: {sorted(unknown)}")
    return remap(df, {name: (sources.get(name), kind) for name, kind in columns})


def point_text(x: Column, y: Column) -> Column:
    return F.format_string("POINT (%.2f %.2f)", x, y)


def address_roads(matches: DataFrame) -> DataFrame:
    """R-14: the connector of each matched address, from rows of the cascade."""
    same = {
        "Length": "dist_from_road", "ADDRESS_PFI": "addr_pfi", "ROAD_PFI": "road_pfi", "SIDE_OF_ROAD": "side_of_road", "MATCH_METHOD": "rule_code", "INPUT_ROAD_NAME_ID": "addr_rnid", "MATCH_ROAD_NAME_ID": "road_rnid",
        "CROSS_COUNT": "intersects", "DISTANCE_FROM_FEATURE": "dist_from_road", "DISTANCE_ALONG_FEATURE": "dist_along_road", "SCORE": "rule_score", "LOCALITY_NAME": "addr_locality_name", "SOUNDEX": "addr_soundex", "Shape": "geometry",
    }
    return laid_out(matches, ADDRESS_ROAD, {k: F.col(c) for k, c in same.items() if c in matches.columns})


def address_output(addresses: DataFrame, register: DataFrame) -> DataFrame:
    """R-14: validated addresses with their register number.

    ``addresses``: pfi, property_pfi, address_string, lv_apt, st_num, house_number_1, house_number_2, road_name,
    road_type, road_suffix, road_name_id, locality_name, road_pfi, x, y. ``register``:
    (mslink, address_string), one row per string. Coordinates of the local grid are in hundredths.
    """
    rows = addresses.join(register.select("address_string", "mslink"), "address_string", "left")
    c = F.col
    return laid_out(rows, ADDRESS, {
        "PFI": c("pfi"), "VicGrid94_X": c("x"), "VicGrid94_Y": c("y"), "INGR94_X": c("x") * 100, "INGR94_Y": c("y") * 100, "VicMapAddressPFI": c("pfi"), "VicMapPropertyPFI": c("property_pfi"),
        "EZI_ADDRESS": F.concat_ws(" ", "st_num", "road_name", "road_type", "road_suffix", "locality_name"), "CAD_STRING": c("address_string"), "CAD_LV_APT": c("lv_apt"), "CAD_ST_NUM": c("st_num"),
        "NUMBER_1": c("house_number_1"), "NUMBER_2": c("house_number_2"), "ROAD_NAME": c("road_name"), "ROAD_TYPE": c("road_type"), "ROAD_SUFFIX": c("road_suffix"), "ROAD_NAME_ID": c("road_name_id"),
        "LOCALITY_NAME": c("locality_name"), "MSLINK": c("mslink"), "VicMapRoadPFI": c("road_pfi"), "WKT": point_text(c("x"), c("y")),
    })


def road_alias_output(roads: DataFrame, aliases: DataFrame, names: DataFrame) -> DataFrame:
    """R-14: a row per road and name, with the number of its names; the first name is its label.

    ``roads``: pfi, from_ufi, to_ufi, feature_type_code, left_locality, right_locality. ``aliases``: pfi,
    road_name_id, alias_number. ``names``: road_name_id, road_name, road_type, road_suffix, soundex, route_flag.
    """
    count = aliases.groupBy("pfi").agg(F.count(F.lit(1)).alias("alias_count"))
    rows = roads.join(aliases.select("pfi", "road_name_id", "alias_number"), "pfi").join(count, "pfi").join(names, "road_name_id", "left")
    same = ("PFI", "FEATURE_TYPE_CODE", "FROM_UFI", "TO_UFI", "ROAD_NAME_ID", "ROAD_NAME", "ROAD_TYPE", "ROAD_SUFFIX", "SOUNDEX", "ROUTE_FLAG", "ALIAS_NUMBER", "ALIAS_COUNT", "LEFT_LOCALITY", "RIGHT_LOCALITY")
    label = F.concat_ws(" ", "road_name", "road_type", "road_suffix")
    return laid_out(rows, ROAD_ALIAS, {n: F.col(n.lower()) for n in same} | {"LABEL_STRING": label, "LABEL_FLAG": (F.col("alias_number") == 0).cast("int")})


def intersection_alias_output(links: DataFrame, names: DataFrame, nodes: DataFrame) -> DataFrame:
    """R-14: a row per node and ordered pair of different names that meet there.

    ``links``: (ufi, road_name_id) in any number; a node's names are gathered once, so that it costs the square of
    its names and not of its roads. ``nodes``: ufi, x, y, locality_name.
    """
    at = links.select("ufi", "road_name_id").distinct()
    pair = at.withColumnRenamed("road_name_id", "a_id").join(at.withColumnRenamed("road_name_id", "b_id"), "ufi").where("a_id <> b_id")

    def side(s: str) -> DataFrame:
        return names.select(F.col("road_name_id").alias(f"{s}_id"), *[F.col(c).alias(f"{s}_{c}") for c in ("road_name", "road_type", "road_suffix", "soundex")])

    rows = pair.join(side("a"), "a_id", "left").join(side("b"), "b_id", "left").join(nodes, "ufi", "left")
    of = {f"{s.upper()}_{n}": F.col(f"{s}_{c}") for s in "ab" for n, c in (("ROAD_NAME_ID", "id"), ("ROAD_NAME", "road_name"), ("ROAD_TYPE", "road_type"), ("ROAD_SUFFIX", "road_suffix"), ("SOUNDEX", "soundex"))}
    return laid_out(rows, INTERSECTION_ALIAS, of | {
        "UFI": F.col("ufi"), "LOCALITY_NAME": F.col("locality_name"), "MUN_SDX": soundex(F.col("locality_name")), "XVALUE": F.col("x"), "YVALUE": F.col("y"), "WKT": point_text(F.col("x"), F.col("y"))
    })


def locality_output(localities: DataFrame, attributes: DataFrame, register: DataFrame) -> DataFrame:
    """R-13: localities with the columns that four updates set; without a node it is -1.

    ``attributes``: what ``chains.locality_attributes`` gives, coordinates in hundredths. ``register``: (mslink,
    name), one row per name.
    """
    a = attributes.select(
        "pfi", F.coalesce("node_ufi", F.lit(-1)).alias("node_id"), (F.col("centroid_x") * 100).alias("x_cord"), (F.col("centroid_y") * 100).alias("y_cord"), "ring_count", "segment_count", "area_size", "perimeter_size", "soundex"
    )
    base = localities.select("pfi", "name").withColumns({"node_id": F.lit(-1).cast("long"), **{c: F.lit(None).cast(kind) for c, kind in a.dtypes if c not in ("pfi", "node_id")}, "esz": F.lit(None).cast("long")})
    out = registers.update_from(base, a, ["pfi"], [c for c in a.columns if c != "pfi"], keep=True)
    return registers.update_from(out, register.select("name", F.col("mslink").alias("esz")), ["name"], ["esz"], keep=False)

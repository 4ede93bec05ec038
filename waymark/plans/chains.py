"""Whole chains of operators, each one lineage.

Intermediate results are DataFrames; a caller writes out those that are deliverables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions.keys import soundex
from ..operators import ranging, registers, resolution, spatial, topology


@dataclass
class Topology:
    """3.C: what the road chain delivers."""

    segments: DataFrame
    details: DataFrame
    bearings: DataFrame
    turns: DataFrame
    walks: DataFrame
    cross_streets: DataFrame


def road_topology(roads: DataFrame, nodes: DataFrame, aliases: DataFrame) -> Topology:
    """3.C: from road lines (pfi, from_ufi, to_ufi, feature_type_code, pts) to cross streets."""
    segs = g.segments(roads)
    bearings = g.road_bearings(segs)
    turns = topology.checkpoint(topology.turn_table(roads, bearings, nodes))
    walks = topology.cross_street_walks(roads, turns, aliases)
    return Topology(segs, g.line_measures(roads), bearings, turns, walks, topology.cross_streets(roads, walks, aliases))


@dataclass
class Resolution:
    """3.B: what the address chain delivers."""

    excluded: DataFrame
    duplicate: DataFrame
    phase_1: DataFrame
    phase_2: DataFrame
    validated: DataFrame
    register: DataFrame
    ranging: DataFrame
    flips: DataFrame


def resolve_addresses(
    addresses: DataFrame, matches: DataFrame, roads: DataFrame, aliases: DataFrame, cross: DataFrame, register: DataFrame,
    manual: DataFrame | None = None, overrides: DataFrame | None = None, patches: DataFrame | None = None, second_source: bool = False,
) -> Resolution:
    """3.B: exclusions, both duplicate phases, validated ids, the register, ranges and directions.

    ``addresses``: one row per address with its key parts and ``st_num``, ``lv_apt``, ``view_pfi``,
    ``address_string``. ``matches``: (pfi, road_pfi, road_name_id, rule_score, dist_from_road, dist_along,
    side_of_road). ``cross``: (pfi, to_rnid). ``register``: (mslink, address_string). The second source's addresses have a
    geocode_source too, and only those geocoded by address count in ranges.
    """
    known = topology.checkpoint(addresses.join(matches, "pfi", "left"))
    excluded = resolution.exclusions(known, manual, second_source)
    dups = resolution.duplicates(known)
    one = resolution.resolve_phase_1(dups)
    first = resolution.validated_phase_1(known, excluded, dups, one)
    facts = known.select(F.col("pfi").alias("addr_pfi"), "road_pfi", "side_of_road", "house_number_1", "house_number_2", "rule_score", "dist_along", *(["geocode_source"] if second_source else []))
    geocoded = "ADDRESS" if second_source else None
    ranges = ranging.road_ranging(roads, facts, first.withColumnRenamed("pfi", "addr_pfi"), patches, geocoded=geocoded)
    near = ranging.near_ranges(roads, aliases, ranges)
    open_ = dups.join(one.where("resolution_code = 'UNRESOLVED'").select("pfi"), "pfi", "left_semi")
    at = ranges.select(F.col("pfi").alias("road_pfi"), "left_min", "left_max", "right_min", "right_max", "address_type")
    two = resolution.resolve_phase_2(open_.join(at, "road_pfi", "left"), near)
    valid = topology.checkpoint(resolution.validated_phase_2(known, excluded, dups, one, two, overrides))
    new = known.join(valid, "pfi", "left_semi").select("address_string")
    reg = registers.register(register, new, ["address_string"], "mslink", null_keys=second_source)
    final = ranging.road_ranging(roads, facts, valid.withColumnRenamed("pfi", "addr_pfi"), patches, geocoded=geocoded)
    flips = ranging.road_flip(final, facts.join(valid.withColumnRenamed("pfi", "addr_pfi"), "addr_pfi", "left_semi"), cross)
    return Resolution(resolution.described(excluded, dups), dups, one, two, valid, reg, final, flips)


def locality_attributes(edges: DataFrame, names: DataFrame, nodes: DataFrame, size: float) -> DataFrame:
    """R-13: (pfi, name, measures, soundex, node_ufi): a locality's centroid, detail and the node nearest its centre."""
    measures = g.ring_measures(edges)
    near = spatial.nearest_contained(nodes.withColumnRenamed("ufi", "node_ufi"), edges, measures, "pfi", "node_ufi", size)
    return measures.join(names, "pfi").join(near, "pfi", "left").withColumn("soundex", soundex(F.col("name")))


def point_details(points: DataFrame, localities: tuple[DataFrame, DataFrame], areas: tuple[DataFrame, DataFrame], size: float, key: str = "pfi") -> DataFrame:
    """J-10, J-11, E-9: (key, locality, percent, area, x, y, x_uor, y_uor). Each pair: (edges, names), keyed by polygon."""
    town = spatial.locate(points, *localities, key, "polygon", size).select(key, F.col("name").alias("locality_name"), F.col("percent").alias("locality_percent"))
    area = spatial.locate(points, *areas, key, "polygon", size, by_overlap=False).select(key, F.col("name").alias("lga_name"))
    out = points.join(town, key, "left").join(area, key, "left")
    return out.select(key, "locality_name", "locality_percent", "lga_name", "x", "y", (F.col("x") * 100).alias("x_uor"), (F.col("y") * 100).alias("y_uor"))


def keep_inside(tables: Sequence[DataFrame], edges: DataFrame, key: str, size: float) -> list[DataFrame]:
    """3.D, J-12: the rows of each point table inside or on the border of some polygon."""
    return [t.join(spatial.point_in_polygon(t, edges, key, "polygon", size, closed=True).select(key).distinct(), key, "left_semi") for t in tables]


def validated_roads(roads: DataFrame, status: DataFrame, columns: Sequence[str]) -> DataFrame:
    """G-12: the listed columns of roads that no connectivity test found disconnected."""
    return registers.not_in(roads, "pfi", status.where("status = 'DISCONNECTED'"), "pfi").select(*columns)

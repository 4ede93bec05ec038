"""Keys, predicates and geometry on hand-made rows."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from waymark.functions import geometry as g
from waymark.functions import keys as k


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def lit(v, kind="string"):
    return F.lit(v).cast(kind)


def test_house_number_is_null_only_with_the_number(spark):
    got = one(spark, k.house_number(lit(None), lit(12, "int"), lit("A")), k.house_number(lit("U"), lit(None, "int"), lit("A")), k.house_number(lit("U"), lit(7, "int"), lit(None)))
    assert tuple(got) == ("12A", None, "U7")


def test_apartment_takes_the_unit_or_the_floor_and_five_characters(spark):
    a = lambda u, s, f: k.apartment(lit(u, "int"), lit(s), lit(f, "int"))
    assert tuple(one(spark, a(12345, "BC", 3), a(1, None, 3), a(None, "B", 3), a(None, None, None))) == ("12345", "1", "3", None)


def test_address_string_forms(spark):
    parts = [lit("L"), lit("R"), lit(None), lit(None), lit("5")]
    assert tuple(one(spark, k.address_string(*parts), k.address_string(*parts, trailing=True), k.address_string(*parts[:4], lit(None)))) == ("L_R___5", "L_R___5_", None)


def test_numeric_text(spark):
    got = one(spark, *[k.is_numeric(lit(v)) for v in ("1", "X", "1X", None, "1e3", "$")])
    assert tuple(got) == (True, False, False, False, True, False)


def test_near_bounds(spark):
    got = one(spark, k.near_max(lit(0, "int"), lit(None, "int")), k.near_max(lit(None, "int"), lit(4, "int")), k.near_min(lit(3, "int"), lit(None, "int")), k.near_min(lit(None, "int"), lit(None, "int")), k.near_max(lit(9, "int"), lit(9, "int")))
    assert tuple(got) == (None, 4, 3, None, 9)


def test_names(spark):
    row = one(spark, *k.road_name_parts(lit("  old   mill\trd "), lit(None), lit("n")), *k.route_name_parts(lit(" m1 ")))
    assert tuple(row) == ("OLD MILL RD", "", "N", 0, "M1", "-", "", 1)


def test_soundex(spark):
    assert tuple(one(spark, *[k.soundex(lit(v)) for v in ("Robert", "Rupert", " ashcraft ", "")])) == ("R163", "R163", "A261", "")


def test_bearings(spark):
    d = lambda *v: [F.lit(float(x)) for x in v]
    got = one(spark, g.bearing(*d(0, 0, 0, 1)), g.bearing(*d(0, 0, 1, 0)), g.bearing(*d(0, 0, 0, -1)), g.bearing(*d(0, 0, -1, 0)), g.flip(F.lit(190.0)))
    assert [round(v, 9) for v in got] == [0, 90, 180, 270, 10]
    assert tuple(one(spark, *[g.turn_angle(F.lit(a), F.lit(b)) for a, b in ((180.0, 0.0), (0.0, 180.0), (350.0, 10.0), (10.0, 350.0))])) == (180, -180, -20, 20)


def test_turns_are_antisymmetric_but_for_the_ends(spark):
    r = random.Random(3)
    rows = [(r.uniform(0, 360), r.uniform(0, 360)) for _ in range(200)]
    for x in spark.createDataFrame(rows, "a double, b double").select(g.turn_angle(F.col("a"), F.col("b")).alias("f"), g.turn_angle(F.col("b"), F.col("a")).alias("t")).collect():
        assert x.f == pytest.approx(-x.t) and -180 <= x.f <= 180


def test_crossing_needs_inner_points(spark):
    s = lambda *v: tuple(F.lit(float(x)) for x in v)
    base = s(0, 0, 10, 0)
    got = one(spark, *[g.segments_cross(base, o) for o in (s(5, -1, 5, 1), s(5, 0, 5, 1), s(10, -1, 10, 1), s(0, 0, 10, 0), s(20, -1, 20, 1))])
    assert tuple(got) == (True, False, False, False, False)


LINES = [(1, [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0)]), (2, [(0.0, 0.0), (1.0, 0.0)]), (3, [(0.0, 0.0), (2.0, 0.0)])]


@pytest.fixture
def segs(spark):
    return g.segments(spark.createDataFrame(LINES, "pfi int, pts array<struct<x:double,y:double>>"))


def test_segments_and_measures(spark, segs):
    assert sorted((r.pfi, r.seq, r.cum_len) for r in segs.collect()) == [(1, 0, 0), (1, 1, 10), (2, 0, 0), (3, 0, 0)]
    lines = spark.createDataFrame([*LINES, (4, [(1.0, 1.0)]), (5, [])], "pfi int, pts array<struct<x:double,y:double>>")
    assert sorted(map(tuple, g.line_measures(lines).collect())) == [(1, 20, 2), (2, 1, 1), (3, 2, 1), (4, 0, 0), (5, 0, 0)]


def test_short_lines_have_bearings(segs):
    got = {r.pfi: (round(r.entry_bearing, 6), round(r.exit_bearing, 6), round(r.entry_bearing_flip, 6)) for r in g.road_bearings(segs).collect()}
    # of the line of length 2 the exit sample lies at 2 * 2 - 2.5 = 1.5; of that of length 1 at 0
    assert got == {1: (90, 0, 180), 2: (90, 90, 270), 3: (90, 90, 270)}


def test_projection_and_side(spark, segs):
    pts = spark.createDataFrame([(1, 1, 4.0, 3.0), (2, 1, 4.0, -3.0), (3, 1, 30.0, 30.0), (4, 1, 5.0, 0.0)], "id int, pfi int, x double, y double")
    got = {r.id: (r.dist, r.along) for r in g.project(pts, segs, "id").collect()}
    assert got[1] == (3, 4) and got[2] == (3, 4) and got[4] == (0, 5) and got[3] == (pytest.approx(math.hypot(20, 20)), 20)
    at = lambda y: g.side_of_line(F.lit(4.0), F.lit(y), *[(F.lit(float(x)), F.lit(0.0)) for x in (3, 4, 5)])
    assert tuple(one(spark, at(3.0), at(-3.0), at(0.0))) == ("L", "R", "R")


def test_rings_with_a_hole(spark):
    def edges(key, ring, pts):
        return [(key, ring, i, *map(float, a), *map(float, b)) for i, (a, b) in enumerate(zip(pts, pts[1:] + pts[:1], strict=True))]

    rows = edges(1, 0, [(0, 0), (10, 0), (10, 10), (0, 10)]) + edges(1, 1, [(2, 2), (2, 4), (4, 4), (4, 2)])
    r = g.ring_measures(spark.createDataFrame(rows, "pfi int, ring int, seq int, x1 double, y1 double, x2 double, y2 double")).first()
    assert (r.ring_count, r.segment_count, r.area_size, r.perimeter_size) == (2, 8, 96, 48)
    assert r.centroid_x == pytest.approx((100 * 5 - 4 * 3) / 96)


def test_projection_to_the_plane(spark):
    x, y = one(spark, *g.lambert(F.lit(145.0), F.lit(-37.0)))
    assert x == pytest.approx(2_500_000, abs=1e-6) and y == pytest.approx(2_500_000, abs=1e-6)
    far = one(spark, *g.lambert(F.lit(144.9631), F.lit(-37.8136)))  # Melbourne
    assert 2_496_000 < far[0] < 2_497_500 and 2_409_000 < far[1] < 2_411_000


def test_short_connectors_are_drawn_out(spark):
    e = lambda *v: g.extend_short(*[F.lit(float(x)) for x in v])
    assert tuple(one(spark, *e(0, 0, 0, 0), *e(0, 0, 5, 0))) == (0, 0, 5, 0)
    assert tuple(one(spark, *e(0, 0, 0.005, 0))) == (pytest.approx(0.105), 0)

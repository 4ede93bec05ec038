"""Duplicates, ranges, directions and exclusions: one hand-made group per outcome."""

from __future__ import annotations

import pytest

from waymark.operators import ranging, resolution

COLUMNS = "pfi string, st_num string, road_name string, road_type string, road_suffix string, locality_name string, is_primary string, graphic_type string, status string, lv_apt string, rule_score int, dist_from_road double, house_number_2 int, road_pfi long, x double, y double"


def group(num, *rows):
    """Rows of one duplicate group: each (pfi, changes)."""
    base = {"is_primary": "N", "graphic_type": "P", "status": "P", "lv_apt": "1", "rule_score": 80, "dist_from_road": 1.0, "house_number_2": None, "road_pfi": 1, "x": 0.0, "y": 0.0}
    out = []
    for i, (pfi, change) in enumerate(rows):
        r = base | {"road_pfi": i, "x": float(i)} | change
        out.append((pfi, num, "R", "ST", None, "L", *(r[k] for k in list(base))))
    return out


GROUPS = {
    "IS_PRIMARY": group("1", ("a", {"is_primary": "Y"}), ("b", {})),
    "BASE_PROP": group("2", ("a", {}), ("b", {"graphic_type": "B"})),
    "APPROVED": group("3", ("a", {"status": "A"}), ("b", {})),
    "BASE_ADD": group("4", ("a", {"lv_apt": None}), ("b", {})),
    "SAME_POINT": group("5", ("9", {"x": 1.0}), ("10", {"x": 1.0})),
    "RD_SING_PR": group("6", ("a", {"road_pfi": 5, "is_primary": "Y", "rule_score": 70}), ("b", {"road_pfi": 5, "is_primary": "Y"}), ("c", {"road_pfi": 5})),
    "RD_SINGANY": group("7", ("a", {"road_pfi": 5, "dist_from_road": 2.0}), ("b", {"road_pfi": 5})),
    "UNRESOLVED": group("8", ("a", {}), ("b", {})),
}
WINNERS = {"IS_PRIMARY": "a", "BASE_PROP": "b", "APPROVED": "a", "BASE_ADD": "a", "SAME_POINT": "9", "RD_SING_PR": "b", "RD_SINGANY": "b", "UNRESOLVED": None}


@pytest.mark.parametrize("code", GROUPS)
def test_phase_1(spark, code):
    df = spark.createDataFrame(GROUPS[code], COLUMNS)
    assert {tuple(r)[1:] for r in resolution.resolve_phase_1(resolution.duplicates(df)).collect()} == {(WINNERS[code], code)}


def test_duplicates_group_nulls(spark):
    rows = [("a", None, 1), ("b", None, 1), ("c", "x", 1)]
    assert sorted(r.pfi for r in resolution.duplicates(spark.createDataFrame(rows, "pfi string, k string, j int"), ["k", "j"]).collect()) == ["a", "b"]


def phase_2(spark, rows, near=()):
    full = [(*g, *r[1]) for g, r in zip(group("1", *[(p, c) for p, c, _ in rows]), [(p, t) for p, _, t in rows], strict=True)]
    df = spark.createDataFrame(full, COLUMNS + ", house_number_1 int, road_name_id long, left_min int, left_max int, right_min int, right_max int, address_type int")
    n = spark.createDataFrame(list(near), "pfi long, road_name_id long, number_min int, number_max int")
    return {tuple(r)[1:] for r in resolution.resolve_phase_2(df, n).collect()}


def test_phase_2_codes(spark):
    a, b = {"road_pfi": 1}, {"road_pfi": 2}
    run = lambda one, two, near=(): phase_2(spark, [("a", a | {"rule_score": 90}, one), ("b", b, two)], near)
    far = (11, 3, 51, 61, 50, 60, 1)
    assert run(far, (11, 3, 1, 21, 50, 60, 0)) == {("b", "R*_NULL", 2)}
    assert run(far, (11, 3, 2, 20, 50, 60, 0)) == {("b", "R*_RNG", 2)}
    assert run(far, far, [(2, 3, 1, 20), (2, 4, 11, 11)]) == {("b", "R*_RNGNEAR", 2)}
    assert run(far, (11, 3, None, None, 50, 60, 0)) == {("b", "R*_1S_TY", 2)}
    assert run(far, (11, 3, None, None, 50, 60, 1)) == {("b", "R*_1S", 2)}  # the type guard covers the first half
    assert run(far, (11, 3, 50, 60, None, None, 1)) == {("b", "R*_1S_TY", 2)}  # and not the second
    assert run(far, (11, 3, None, None, None, None, 1)) == {("b", "R*_1S_TY", 2)}  # both sides null: never R*_ALL_NUL
    assert run(far, far, [(2, 3, 21, 30)]) == {("b", "R*_RNG_OFF", 2)}
    assert run(far, far) == {("a", "RANDOM", 1)}


def test_validated_ids(spark):
    s = lambda rows, cols: spark.createDataFrame(rows, cols)
    a = s([(p,) for p in "abcdef"], "pfi string")
    ex, dup = s([("a",), ("b",)], "pfi string"), s([("b",), ("c",), ("d",), ("e",)], "pfi string")
    one, two = s([("b", "IS_PRIMARY"), ("c", "UNRESOLVED")], "resolution_pfi string, resolution_code string"), s([("d", "RANDOM")], "resolution_pfi string, resolution_code string")
    ids = lambda df: sorted(r.pfi for r in df.collect())
    assert ids(resolution.validated_phase_1(a, ex, dup, one)) == ["b", "f"]  # winning lifts b's exclusion
    assert ids(resolution.validated_phase_2(a, ex, dup, one, two, s([("e",), ("z",)], "override_pfi string"))) == ["b", "c", "d", "e", "f"]


def test_exclusions(spark):
    rows = [("a", "S", None, None, "v", None, 80), ("b", "M", 1, "7", None, "PAPER_ROAD_ONLY", 20), ("c", None, None, None, "v", None, None)]
    df = spark.createDataFrame(rows, "pfi string, address_class string, house_number_1 int, house_prefix_1 string, view_pfi string, feature_quality_id string, rule_score int")
    codes = lambda **k: sorted((r.pfi, r.rule_code) for r in resolution.exclusions(df, **k).collect())
    assert codes() == [("a", "NO_NUM"), ("b", "AR_L50"), ("b", "CLASS_M"), ("b", "NO_PROPPFI"), ("b", "PAPER"), ("b", "PREFIX_NOT_NUM")]
    assert codes(second_source=True) == [("a", "NO_NUM"), ("b", "AR_L50"), ("c", "NO_NUM")]
    assert ("c", "REFERENCE") in codes(manual=df.where("pfi = 'c'"))


def test_ranges_and_types(spark):
    rows = [(1, 1, "L", 3, None, 90), (2, 1, "L", 7, 11, 90), (3, 2, "R", 4, None, 90), (4, 2, "L", 5, None, 90), (5, 3, "L", 4, None, 90), (6, 3, "R", 6, None, 90), (7, 4, "L", 1, None, 10), (8, 5, "L", 1, None, 50), (9, 5, "L", 2, None, 50)]
    a = spark.createDataFrame(rows, "addr_pfi int, road_pfi int, side_of_road string, house_number_1 int, house_number_2 int, rule_score int")
    roads = spark.createDataFrame([(i,) for i in range(1, 6)], "pfi int")
    got = {r.pfi: (r.left_min, r.left_max, r.right_min, r.address_type) for r in ranging.road_ranging(roads, a).collect()}
    assert got == {1: (3, 11, None, 0), 2: (5, 5, 4, 0), 3: (4, 4, 6, 1), 4: (None, None, None, 1), 5: (1, 2, None, 1)}
    only = ranging.road_ranging(roads, a, valid=spark.createDataFrame([(1,)], "addr_pfi int"))
    assert {r.pfi: r.left_max for r in only.collect()}[1] == 3


def test_directions(spark):
    def road(pfi, left, right):
        return [(i + pfi * 100, pfi, s, n, float(d)) for s, side in (("L", left), ("R", right)) for i, (d, n) in enumerate(side)]

    rows = road(1, [(1, 9), (2, 1)], []) + road(2, [(1, 9), (2, 1)], [(1, 8), (2, 2)]) + road(3, [(1, 9), (2, 1)], [(1, 2), (2, 8)]) + road(4, [(1.00001, 5), (1.00002, 5)], [(1, 3), (2, 1)])
    a = spark.createDataFrame(rows, "addr_pfi int, road_pfi int, side_of_road string, house_number_1 int, dist_along double")
    r = spark.createDataFrame([(i, 1, 9, 2, 8, 1) for i in (1, 2, 3, 4)], "pfi int, left_min int, left_max int, right_min int, right_max int, address_type int")
    x = spark.createDataFrame([(1, -1), (2, 5)], "pfi int, to_rnid int")
    got = {q.pfi: q.flip_status for q in ranging.road_flip(r, a, x).collect()}
    assert got == {1: 1, 2: 2, 3: -1, 4: 1}  # an empty side, or one that doesn't change, keeps 1


def test_near_ranges(spark):
    roads = spark.createDataFrame([(1, 10, 11), (2, 11, 12), (3, 12, 12)], "pfi int, from_ufi int, to_ufi int")
    names = spark.createDataFrame([(1, 7, 0), (2, 7, 0), (3, 8, 0)], "pfi int, road_name_id int, alias_number int")
    rng = spark.createDataFrame([(1, 5, 0, None, None), (2, 1, 9, 4, None), (3, 50, 60, 40, 70)], "pfi int, left_min int, left_max int, right_min int, right_max int")
    got = {(r.pfi, r.road_name_id): (r.number_min, r.number_max) for r in ranging.near_ranges(roads, names, rng).collect()}
    assert got == {(1, 7): (1, 9), (2, 7): (1, 9), (3, 8): (40, 70)}

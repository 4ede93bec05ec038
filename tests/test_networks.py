"""Topology, spatial joins, rules and whole chains, against brute force on small worlds."""

from __future__ import annotations

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from waymark.functions import geometry as g
from waymark.operators import rules, spatial, topology
from waymark.plans import chains

NODE = "ufi long, feature_type_code string, conpfi1 long, conpfi2 long"
ROAD = "pfi long, from_ufi long, to_ufi long, feature_type_code string"
ALIAS = "pfi long, road_name_id long, alias_number int"
BEAR = "pfi long, entry_bearing double, entry_bearing_flip double"


def test_turns_at_nodes_and_tunnels(spark):
    roads = spark.createDataFrame([(1, 10, 11, "ROAD"), (2, 11, 12, "ROAD"), (3, 11, 11, "ROAD"), (4, 12, 13, "ROAD"), (5, 12, 14, "ROAD"), (6, 20, 21, "ROAD"), (7, 21, 22, "ROAD")], ROAD)
    bears = spark.createDataFrame([(i, 10.0 * i, 10.0 * i + 180) for i in range(1, 8)], BEAR)
    nodes = spark.createDataFrame([(11, "x", None, None), (12, "Tunnel", 2, 4)], NODE)  # 21 isn't known
    got = {(r.ufi, r.from_pfi, r.to_pfi): r.angle for r in topology.turn_table(roads, bears, nodes).collect()}
    assert set(got) == {(11, a, b) for a in (1, 2, 3) for b in (1, 2, 3) if a != b} | {(12, 2, 4), (12, 4, 2)}
    assert got[11, 1, 2] == 190 - 20 and got[11, 2, 3] == -10


def walk(roads, turns, names, ends, pfi, kind):
    """A literal walk, for comparison."""
    primary = lambda p: min(names[p])[1]
    at, ufi, how, rows = pfi, ends[pfi][0 if kind == "FROM" else 1], "BEGIN", []
    for step in range(52):
        near = sorted(((abs(a), str(t), t) for (u, f, t), a in turns.items() if u == ufi and f == at))
        rows.append((pfi, kind, step, at, ufi, len(near), how, None))
        if not near:
            break
        x = next((t for _, _, t in near if all(i != 1312 for _, i in names[t]) and all(i != primary(pfi) for _, i in names[t]) and roads[t] != "TUNNEL"), None)
        if x is not None:
            rows.append((pfi, kind, step, at, ufi, len(near), "XSTREET", x))
            break
        straight = sorted(near, key=lambda c: abs(180 - c[0]))
        same = [c for c in straight if primary(at) != 1312 and any(i == primary(at) for _, i in names[c[2]])]
        how, at = ("SAME_RNID", same[0][2]) if same else ("CLOSE_TO_180", straight[0][2])
        ufi = ends[at][1] if ends[at][0] == ufi else ends[at][0]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_walks_against_a_literal_walk(spark, seed):
    r = random.Random(seed)
    ends = {i: (r.randrange(14), r.randrange(14)) for i in range(1, 26)}
    kinds = {i: r.choice(["ROAD", "ROAD", "ROAD", "TUNNEL"]) for i in ends}
    names = {i: [(0, r.choice([1, 2, 3, 1312]))] + ([(1, r.choice([1, 4]))] if r.random() < 0.4 else []) for i in ends}
    turns = {}
    for u in range(14):
        here = sorted({i for i, e in ends.items() if u in e})
        turns |= {(u, a, b): float(r.choice([0, 45, -90, 135, 180, -170])) for a in here for b in here if a != b}
    df = lambda rows, s: spark.createDataFrame(rows, s)
    roads = df([(i, *e, kinds[i]) for i, e in ends.items()], ROAD)
    t = df([(u, a, b, x) for (u, a, b), x in turns.items()], "ufi long, from_pfi long, to_pfi long, angle double")
    al = df([(i, n, k) for i, v in names.items() for k, n in v], ALIAS)
    walks = topology.cross_street_walks(roads, t, al).select("pfi", "node_type", "step", "traversal_pfi", "traversal_ufi", "conn_count", "how", "xstreet_pfi")
    want = [row for i in ends for k in ("FROM", "TO") for row in walk(kinds, turns, names, ends, i, k)]
    key = lambda row: tuple(str(v) for v in row)
    assert sorted(map(tuple, walks.collect()), key=key) == sorted(want, key=key)
    x = topology.cross_streets(roads, walks, al)
    assert x.count() == len(ends) and x.where("from_xpfi <> -1").count() == sum(row[6] == "XSTREET" and row[1] == "FROM" for row in want)


def test_components_with_and_without_a_patch(spark):
    edges = spark.createDataFrame([(1, 1, 2), (2, 2, 3), (3, 2, 3), (4, 7, 8), (5, 9, 9)], "pfi long, src long, dst long")
    patch = spark.createDataFrame([(3, 7)], "src long, dst long")
    status = lambda *p: {(r.pfi, r.status) for r in topology.connectivity(edges, 1, *p).collect()}
    assert status() == {(1, "NETWORKED"), (2, "NETWORKED"), (3, "NETWORKED"), (4, "DISCONNECTED"), (5, "DISCONNECTED")}
    assert status(patch) == {(i, "NETWORKED") for i in (1, 2, 3, 4, -1)} | {(5, "DISCONNECTED")}
    assert [r.pfi for r in chains.validated_roads(edges, topology.connectivity(edges, 1), ["pfi"]).orderBy("pfi").collect()] == [1, 2, 3]
    assert topology.component_labels(edges.limit(0)).count() == 0


def test_long_chains_settle(spark):
    edges = spark.range(3000).select(F.col("id").alias("pfi"), F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    assert topology.component_labels(edges).where("component <> 0").count() == 0


SQUARES = [("a", [(0, 0), (10, 0), (10, 10), (0, 10)], []), ("b", [(9, 0), (20, 0), (20, 10), (9, 10)], [[(12, 2), (12, 8), (18, 8), (18, 2)]])]


@pytest.fixture
def polygons(spark):
    rows = []
    for key, outer, holes in SQUARES:
        for ring, pts in enumerate([outer, *holes]):
            rows += [(key, ring, i, *map(float, p), *map(float, q)) for i, (p, q) in enumerate(zip(pts, pts[1:] + pts[:1], strict=True))]
    return spark.createDataFrame(rows, "polygon string, ring int, seq int, x1 double, y1 double, x2 double, y2 double")


POINTS = {"in": (5, 5), "edge": (0, 5), "corner": (0, 0), "hole": (15, 5), "two": (9.5, 5), "none": (30, 5), "on hole": (12, 5), "near left": (8.9, 5)}


@pytest.mark.parametrize("size", [1.0, 4.0, 100.0])
def test_points_in_polygons(spark, polygons, size):
    pts = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in POINTS.items()], "pfi string, x double, y double")
    hits = lambda closed: {(r.pfi, r.polygon) for r in spatial.point_in_polygon(pts, polygons, "pfi", "polygon", size, closed).collect()}
    strict = {("in", "a"), ("two", "a"), ("two", "b"), ("near left", "a")}
    assert hits(False) == strict and hits(True) == strict | {("edge", "a"), ("corner", "a"), ("on hole", "b")}
    names = spark.createDataFrame([("a", "Zed"), ("b", "Alpha")], "polygon string, name string")
    first = {r.pfi: (r.name, r.percent) for r in spatial.locate(pts, polygons, names, "pfi", "polygon", size, by_overlap=False).collect()}
    assert first["two"] == ("Alpha", 100) and first["none"] == ("UNKNOWN", 0) and first["in"] == ("Zed", 100)
    overlap = {r.pfi: r for r in spatial.locate(pts, polygons, names, "pfi", "polygon", size).collect()}
    assert overlap["two"].name in ("Zed", "Alpha") and 50 < overlap["two"].percent < 70 and overlap["edge"].name == "UNKNOWN"
    assert [d.count() for d in chains.keep_inside([pts], polygons, "pfi", size)] == [6]


def world(seed, n=60, roads=40, span=1500):
    r = random.Random(seed)
    c = lambda: float(r.randrange(span))
    pts = [(i, c(), c()) for i in range(n)]
    segs = []
    for i in range(roads):
        x, y = c(), c()
        for s in range(r.randint(1, 3)):
            nx, ny = x + r.randint(-200, 200), y + r.randint(-200, 200)
            segs.append((i, s, x, y, nx, ny))
            x, y = nx, ny
    return pts, segs


def foot(x, y, s):
    _, _, x1, y1, x2, y2 = s
    d = (x2 - x1) ** 2 + (y2 - y1) ** 2
    t = min(1, max(0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / d)) if d else 0
    return ((x1 + t * (x2 - x1) - x) ** 2 + (y1 + t * (y2 - y1) - y) ** 2) ** 0.5, x1 + t * (x2 - x1), y1 + t * (y2 - y1)


def frame(spark, segs):
    df = spark.createDataFrame(segs, "pfi int, seq int, x1 double, y1 double, x2 double, y2 double")
    return df.withColumns({"len": g.distance(*(F.col(c) for c in ("x1", "y1", "x2", "y2"))), "cum_len": F.lit(0.0)})


def test_distances_against_brute_force(spark):
    pts, segs = world(3)
    df = spark.createDataFrame(pts, "id int, x double, y double")
    got = {(r.id, r.pfi): r.dist for r in spatial.distance_join(df, frame(spark, segs), 300.0, "id").collect()}
    want = {}
    for i, x, y in pts:
        for s in segs:
            d = foot(x, y, s)[0]
            if d <= 300:
                want[i, s[0]] = min(d, want.get((i, s[0]), d))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


@pytest.mark.parametrize("start", [None, 3.0])
def test_nearest_against_brute_force(spark, start):
    r = random.Random(4)
    pts = [(i, float(r.randrange(900)), float(r.randrange(900))) for i in range(80)] + [(99, -5000.0, 9000.0)]
    sites = [(i, float(r.randrange(90)), float(r.randrange(90))) for i in range(12)]
    a, b = spark.createDataFrame(pts, "id int, x double, y double"), spark.createDataFrame(sites, "ufi int, x double, y double")
    got = {x.id: x.ufi for x in spatial.nearest(a, b, "id", "ufi", start).collect()}
    assert got == {i: min(((x - u) ** 2 + (y - v) ** 2, k) for k, u, v in sites)[1] for i, x, y in pts}
    assert spatial.nearest(a, b.limit(0), "id", "ufi").count() == 0 and spatial.nearest(a.limit(0), b, "id", "ufi").count() == 0


TABLE = [(1, "A", 90, "RoadNameID", "Any", 0, 100), (2, "B", 70, "RoadName", "Nearest", 1, 400), (3, "C", 50, "Partial", "Any", 1, 600), (4, "F_N", 10, "Named", "Nearest", 9, 500)]


def fits(kind, b, t):
    if kind == "Partial":
        x, y = b[0].replace("-", " ").split(" "), t[0].replace("-", " ").split(" ")
        return sum(p == q for p in x for q in y) / min(len(x), len(y)) >= 0.3
    return {"RoadNameID": b[1] == t[1], "RoadName": b[0] == t[0], "Named": b[0] != "UNNAMED"}[kind]


def crosses(a, b):
    o = lambda p, q, s: (q[0] - p[0]) * (s[1] - p[1]) - (q[1] - p[1]) * (s[0] - p[0])
    return o(a[:2], a[2:], b[:2]) * o(a[:2], a[2:], b[2:]) < 0 and o(b[:2], b[2:], a[:2]) * o(b[:2], b[2:], a[2:]) < 0


def cascade(x, y, base, local, segs, names):
    """A literal rule cascade, for comparison."""
    last_try = None
    for order, code, _, kind, near, most, reach in TABLE:
        seen, decided, tried = set(), None, None
        for ring in [*range(min(reach, 250), reach, 250), reach]:
            found = []
            for pfi in {s[0] for s in segs} - seen:
                if any(n in ("UNNAMED", "UNKNOWN") for n, _ in names[pfi]) or not (code == "F_N" or local == "UNKNOWN" or local == pfi % 3):
                    continue
                d, fx, fy = min(foot(x, y, s) for s in segs if s[0] == pfi)
                if d <= ring:
                    found.append((d, str(pfi), pfi, fx, fy))
                    seen.add(pfi)
            found.sort()
            for d, _, pfi, fx, fy in found:
                tried = (pfi, order, False, False)
                if any(fits(kind, base, t) for t in names[pfi]):
                    over = {s[0] for s in segs if s[0] != pfi and crosses((x, y, fx, fy), s[2:])}
                    count = sum(4 if min(names[o], key=lambda t: f"{t[1]},{names[o].index(t)},0")[0] in ("UNNAMED", "UNKNOWN") else 10 for o in over) // 10
                    decided = (pfi, order, True, code == "F_N" or (d < reach and (count <= most or near == "Nearest")))
                    break
                if near == "Nearest" and d > found[0][0]:
                    break
            if decided:
                break
        if decided and decided[3]:
            return decided
        last_try = decided or tried or last_try
    return last_try


@pytest.mark.parametrize("seed", [5, 6])
def test_cascade_against_a_literal_one(spark, seed):
    r = random.Random(seed)
    pts, segs = world(seed, n=50, roads=36)
    words = ["OLD MILL", "MILL", "HIGH HILL", "HILL", "STATION"]
    names = {i: [(r.choice([*words, "UNNAMED"]), r.randrange(12))] + ([(r.choice(words), r.randrange(12))] if r.random() < 0.4 else []) for i in range(36)}
    base = {i: (r.choice(words), r.randrange(12)) for i, *_ in pts}
    local = {i: r.choice(["UNKNOWN", "0", "1", "2"]) for i, *_ in pts}
    a = spark.createDataFrame([(i, x, y, base[i][0], "RD", base[i][1], "", local[i]) for i, x, y in pts], "addr_pfi int, x double, y double, name string, type string, rnid int, soundex string, locality string")
    al = spark.createDataFrame([(i, n[1], k, 0, n[0], "RD", "") for i, v in names.items() for k, n in enumerate(v)], "pfi int, rnid int, alias_number int, route_flag int, name string, type string, soundex string")
    loc = spark.createDataFrame([(i, str(i % 3)) for i in range(36)], "pfi int, locality string")
    got = {x.addr_pfi: (x.road_pfi, x.rule_rank, x.valid_attr, x.valid_spatial) for x in rules.match_addresses(a, frame(spark, segs), al, spark.createDataFrame(TABLE, rules.RULE_SCHEMA), loc).collect()}
    want = {i: cascade(x, y, base[i], "UNKNOWN" if local[i] == "UNKNOWN" else int(local[i]), segs, names) for i, x, y in pts}
    assert got == {i: w for i, w in want.items() if w}


@pytest.mark.parametrize(("kind", "base", "test", "valid"), [
    ("NoSpace", "A B", "AB", True), ("NoSpace", "AB", "AB", False), ("OldPrefix", "OLD MILL", "MILL", True), ("OldPrefix", "MILL", "MILL", False), ("SSuffix", "MILLS", "MILL", True), ("SSuffix", "MILL", "MILL", False),
    ("StartsWith", "STATION", "STATUTE", False), ("StartsWith", "STATION", "STATI WAY", True), ("Partial", "A B C", "C-D-E", True), ("Partial", "A B C D", "D E F G", False), ("Named", "UNNAMED", "X", False),
    ("None", "X", "Y", True), ("Nonsense", "X", "X", False), (None, "X", "X", False),
])
def test_matchers(spark, kind, base, test, valid):
    side = lambda n: {"name": F.lit(n), "type": F.lit("RD"), "rnid": F.lit(1), "soundex": F.soundex(F.lit(n))}
    assert spark.range(1).select(rules.attribute_match(F.lit(kind), side(base), side(test)).alias("v")).first().v is valid


def test_crossings_are_weighted(spark):
    rows = [(1, i) for i in range(5)] + [(2, 10), (2, 11)] + [(3, 1), (3, 10)]
    names = [(i, "NAMED") for i in range(5)] + [(10, "UNNAMED"), (11, "UNKNOWN"), (12, "UNNAMED")]
    out = rules.weighted_crossings(spark.createDataFrame([*rows, (4, 10), (4, 11), (4, 12)], "addr int, cross_pfi int"), spark.createDataFrame(names, "pfi int, road_name string"), ["addr"])
    assert {r.addr: (r.crossed, r.intersects) for r in out.collect()} == {1: (5, 5), 2: (0, 2), 3: (1, 2), 4: (1, 3)}


def test_whole_road_chain(spark):
    pts = lambda *p: [(float(x), float(y)) for x, y in p]
    roads = spark.createDataFrame([(1, 1, 2, "ROAD", pts((0, 0), (100, 0))), (2, 2, 3, "ROAD", pts((100, 0), (200, 0))), (3, 3, 4, "ROAD", pts((200, 0), (200, 90)))], ROAD + ", pts array<struct<x:double,y:double>>")
    nodes = spark.createDataFrame([(i, "x", None, None) for i in range(1, 5)], NODE)
    names = spark.createDataFrame([(1, 7, 0), (2, 7, 0), (3, 8, 0)], ALIAS)
    t = chains.road_topology(roads, nodes, names)
    assert {r.pfi: (r.from_xpfi, r.to_xpfi, r.to_xrnid) for r in t.cross_streets.collect()} == {1: (-1, 3, 8), 2: (-1, 3, 8), 3: (2, -1, -1)}
    d = {(r.pfi, r.node_type): r.distance for r in topology.walk_distances(t.walks, t.details).collect()}
    assert d[1, "TO"] == 100 + 100 + 100 - 100 and d[1, "FROM"] == 0
    assert {r.pfi: r.length for r in t.details.collect()} == {1: 100, 2: 100, 3: 90}


def test_whole_address_chain(spark):
    a = [(str(i), "S", None, None, n, None, None, str(i), "R", "ST", None, "L", "N", "P", "P", str(i), float(i), 0.0, str(n), f"L_R_ST__{n}_") for i, n in enumerate([1, 1, 3, 5, 7])]
    schema = "pfi string, address_class string, house_prefix_1 string, feature_quality_id string, house_number_1 int, house_number_2 int, house_suffix_1 string, view_pfi string, road_name string, road_type string, road_suffix string, locality_name string, is_primary string, graphic_type string, status string, lv_apt string, x double, y double, st_num string, address_string string"
    m = [(str(i), 1 if i else 2, 7, 80 if i < 4 else 20, 1.0, float(i), "L") for i in range(5)]
    matches = spark.createDataFrame(m, "pfi string, road_pfi long, road_name_id long, rule_score int, dist_from_road double, dist_along double, side_of_road string")
    roads = spark.createDataFrame([(1, 1, 2), (2, 2, 3)], "pfi long, from_ufi long, to_ufi long")
    names = spark.createDataFrame([(1, 7, 0), (2, 9, 0)], ALIAS)
    out = chains.resolve_addresses(spark.createDataFrame(a, schema), matches, roads, names, spark.createDataFrame([(1, 4)], "pfi long, to_rnid long"), spark.createDataFrame([(40, "L_R_ST__3_")], "mslink long, address_string string"))
    assert {r.resolution_code for r in out.phase_1.collect()} == {"UNRESOLVED"}
    two = {(r.pfi, r.resolution_pfi, r.resolution_code) for r in out.phase_2.collect()}
    assert two == {("0", "1", "R*_RNGNEAR"), ("1", "1", "R*_RNGNEAR")} or {c for _, _, c in two} <= {"R*_RNG_OFF", "R*_NULL", "R*_RNG", "RANDOM", "R*_1S_TY", "R*_1S"}
    won = next(iter(two))[1]
    assert sorted(r.pfi for r in out.validated.collect()) == sorted([won, "2", "3"])
    assert sorted((r.mslink, r.address_string) for r in out.register.collect()) == [(40, "L_R_ST__3_"), (41, "L_R_ST__1_"), (42, "L_R_ST__5_")]
    assert out.ranging.count() == 2 and out.flips.where("flip_status <> 0").count() == 0


def on(p, a, b):
    """Whether a point lies on a segment, in whole numbers."""
    return (b[0] - a[0]) * (p[1] - a[1]) == (b[1] - a[1]) * (p[0] - a[0]) and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])


def shared(a, b, c, d):
    """What two segments share: nothing, one point as exact fractions, or a piece ('over')."""
    u, v, w = (b[0] - a[0], b[1] - a[1]), (d[0] - c[0], d[1] - c[1]), (c[0] - a[0], c[1] - a[1])
    k = u[0] * v[1] - u[1] * v[0]
    if k:
        t, s = Fraction(w[0] * v[1] - w[1] * v[0], k), Fraction(w[0] * u[1] - w[1] * u[0], k)
        return (a[0] + t * u[0], a[1] + t * u[1]) if 0 <= t <= 1 and 0 <= s <= 1 else None
    ends = {p for p in (a, b) if on(p, c, d)} | {p for p in (c, d) if on(p, a, b)}
    return None if not ends else "over" if len(ends) > 1 else ends.pop()


def relation(a, b):
    """(meets, crosses) of two polylines by the definition."""
    edge = lambda l: set() if l[0] == l[-1] else {l[0], l[-1]}  # noqa: E731, E741
    bits = [x for p, q in zip(a, a[1:]) for r, s in zip(b, b[1:]) if (x := shared(p, q, r, s)) is not None]
    return bool(bits), "over" not in bits and any(x not in edge(a) and x not in edge(b) for x in bits)


def polyline(r, span):
    while True:
        pts = [(r.randrange(span), r.randrange(span)) for _ in range(r.randint(2, 4))]
        pts += pts[:1] if r.random() < 0.2 and len(pts) > 2 else []
        if all(p != q for p, q in zip(pts, pts[1:])):
            return pts


def rows_of(lines):
    return [(i, n, *map(float, p), *map(float, q)) for i, l in enumerate(lines) for n, (p, q) in enumerate(zip(l, l[1:]))]


@pytest.mark.parametrize(("seed", "size"), [(1, None), (2, 1.0), (3, 50.0)])
def test_relations_of_lines_on_a_lattice(spark, seed, size):
    r = random.Random(seed)
    a, b = ([polyline(r, 6) for _ in range(45)] for _ in range(2))
    df = lambda lines, key: spark.createDataFrame(rows_of(lines), f"{key} int, seq int, x1 double, y1 double, x2 double, y2 double")
    got = {(x.a_pfi, x.b_pfi): x.crosses for x in spatial.line_relations(df(a, "a_pfi"), df(b, "b_pfi"), size).collect()}
    want = {(i, j): relation(p, q) for i, p in enumerate(a) for j, q in enumerate(b)}
    assert got == {k: c for k, (m, c) in want.items() if m}
    assert 0 < sum(got.values()) < len(got)


def test_crossings_at_inner_vertices(spark):
    lines = [[(0, -5), (0, 0), (0, 5)], [(3, -1), (3, 1)], [(1, 0), (2, 0)], [(-1, 0), (-1, 4)], [(-3, -2), (-3, 2)]]
    segs = frame(spark, rows_of(lines))
    links = spark.createDataFrame([("a", 9, -3.0, 0.0, 2.5, 0.0), ("b", 0, -3.0, 1.0, 2.0, 1.0), ("c", 9, 0.0, 0.0, 0.0, 0.0)], "addr string, pfi int, x double, y double, nx double, ny double")
    got = {(x.addr, x.cross_pfi) for x in spatial.crossings(links, segs, ["addr", "pfi"], own="pfi").collect()}
    # through an inner vertex; not along a line, at the end of one, from a point on one, or without length
    assert got == {("a", 0), ("b", 3)}


@pytest.mark.parametrize("size", [2.0, 30.0])
def test_lines_in_polygons_by_corners_and_edges(spark, polygons, size):
    lines = [[(-5, -5), (15, 15)], [(-5, 0), (15, 0)], [(-4, 4), (4, -4)], [(-4, 3), (3, -4)], [(13, 3), (17, 7)], [(3, 3), (4, 4)], [(-1, 12), (30, 12)], [(12, 4), (18, 4)]]
    got = {(x.pfi, x.polygon) for x in spatial.lines_in_polygons(frame(spark, rows_of(lines)), polygons, "polygon", size).collect()}
    assert got == {(0, "a"), (0, "b"), (1, "a"), (1, "b"), (2, "a"), (5, "a"), (7, "b")}


def test_disc_shares_in_closed_form(spark, polygons):
    """A half plane, a corner, a hole and whole discs, from points inside, outside and on the boundary."""
    import math

    r = 1.0
    # area of a disc beyond a straight line at distance d, and a quarter-like corner by fine sums
    beyond = lambda d: math.acos(d) - d * math.sqrt(1 - d * d)
    corner = lambda x, y: sum(max(0.0, min(math.sqrt(max(0.0, 1 - t * t)), y + 5) + min(math.sqrt(max(0.0, 1 - t * t)), y)) for t in ((i + 0.5) / 200_000 * (1 + x) - x for i in range(200_000))) / 200_000 * (1 + x)
    pts = {
        "whole": (5, 5), "half": (5, 0), "quarter": (0, 0), "inside": (5, 0.25), "outside": (5, -0.25), "near corner": (0.3, 0.4), "beside hole": (14, 5), "in hole": (12.5, 5), "on hole": (12, 5), "hole corner": (12, 2), "far": (5, -2),
    }
    df = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in pts.items()], "pfi string, x double, y double")
    for size in (1.0, 50.0):
        got = {(x.pfi, x.polygon): x.area for x in spatial.disc_overlap(df, polygons, "pfi", "polygon", size, r).collect()}
        want = {
            ("whole", "a"): math.pi, ("half", "a"): math.pi / 2, ("quarter", "a"): math.pi / 4, ("inside", "a"): math.pi - beyond(0.25), ("outside", "a"): beyond(0.25), ("near corner", "a"): corner(0.3, 0.4),
            ("in hole", "b"): beyond(0.5), ("on hole", "b"): math.pi / 2, ("hole corner", "b"): math.pi * 3 / 4,
        }
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-5 if k[0] == "near corner" else 1e-7) for k in want)


def test_projection_and_back(spark):
    rows = spark.createDataFrame([(141.0, -39.2), (145.0, -37.0), (150.0, -34.0), (145.0, -10.0), (100.0, -60.0)], "lon double, lat double")
    x, y = g.lambert(F.col("lon"), F.col("lat"))
    lon, lat = g.lambert_inverse(F.col("x"), F.col("y"))
    for r in rows.withColumns({"x": x, "y": y}).withColumns({"a": lon, "b": lat}).collect():
        assert (r.a, r.b) == (pytest.approx(r.lon, abs=1e-11), pytest.approx(r.lat, abs=1e-11))
    u, v = g.local_grid(F.col("lon"), F.col("lat"), east=100.0, north=-30.0, turn=90.0, scale=2.0)
    first = rows.select(u.alias("u"), v.alias("v")).first()
    assert (first.u, first.v) == (pytest.approx(2 * (-39.2 + 30)), pytest.approx(-2 * 41.0))


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_within_a_tolerance(spark, seed):
    r = random.Random(seed)
    place = lambda: (r.randrange(4) + r.randrange(-9, 10) * 0.0023, r.randrange(3) + r.randrange(-9, 10) * 0.0023)
    lines = [(i, *place(), *place()) for i in range(120)] + [(500, 10.0049, 0.0, 20.0, 0.0), (501, 10.0051, 0.0, 30.0, 0.0), (502, 10.0049, 0.0, 30.0, 0.011)]
    got = {x.pfi: (tuple(x.src), tuple(x.dst)) for x in topology.tolerance_nodes(spark.createDataFrame(lines, "pfi int, x1 double, y1 double, x2 double, y2 double"), 0.01).collect()}
    pts = sorted({q for _, *c in lines for q in (tuple(c[:2]), tuple(c[2:]))})
    links = [(a, b) for a in pts for b in pts if a < b and (a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2 <= 1e-4]
    root, moved = {q: q for q in pts}, True
    while moved:
        moved = False
        for a, b in links:
            low = min(root[a], root[b])
            moved |= (root[a], root[b]) != (low, low)
            root[a] = root[b] = low
    assert got == {i: (root[tuple(c[:2])], root[tuple(c[2:])]) for i, *c in lines}
    assert got[500][0] == got[501][0] == (10.0049, 0.0) and got[501][1] != got[502][1]


def test_attempts_end_with_the_match(spark):
    r = random.Random(7)
    pts, segs = world(7, n=40, roads=30)
    words = ["MILL", "HIGH HILL", "HILL", "STATION"]
    a = spark.createDataFrame([(i, x, y, r.choice(words), "RD", r.randrange(12), "", r.choice(["UNKNOWN", "0", "1"])) for i, x, y in pts], "addr_pfi int, x double, y double, name string, type string, rnid int, soundex string, locality string")
    al = spark.createDataFrame([(i, r.randrange(12), 0, 0, r.choice([*words, "UNNAMED"]), "RD", "") for i in range(30)], "pfi int, rnid int, alias_number int, route_flag int, name string, type string, soundex string")
    loc = spark.createDataFrame([(i, str(i % 3)) for i in range(30)], "pfi int, locality string")
    args = (a, frame(spark, segs), al, spark.createDataFrame(TABLE, rules.RULE_SCHEMA), loc)
    match = {x.addr_pfi: (x.road_pfi, x.rule_rank, x.valid_attr, x.valid_spatial, x.side_of_road, x.geometry) for x in rules.match_addresses(*args).collect()}
    log = {}
    for x in sorted(rules.all_attempts(*args).collect(), key=lambda x: (x.addr_pfi, x.attempt)):
        log.setdefault(x.addr_pfi, []).append(x)
    assert log.keys() == match.keys() and max(map(len, log.values())) > 3
    for i, rows in log.items():
        last = rows[-1]
        assert [x.attempt for x in rows] == list(range(1, len(rows) + 1)) and not any(x.valid_spatial for x in rows[:-1])
        assert (last.road_pfi, last.rule_rank, last.valid_attr, last.valid_spatial, last.side_of_road, last.geometry) == match[i]
        for x, y in zip(rows, rows[1:]):
            assert not x.valid_attr or y.rule_rank > x.rule_rank  # a road that fits ends its rule


def test_walks_as_lines(spark):
    pts = lambda *q: [(float(x), float(y)) for x, y in q]
    roads = spark.createDataFrame([(1, 1, 2, pts((0, 0), (5, 5), (10, 0))), (2, 3, 2, pts((30, 0), (10, 0))), (3, 3, 4, pts((30, 0), (30, 9))), (4, 4, 4, pts((30, 9), (31, 9), (30, 9)))], "pfi long, from_ufi long, to_ufi long, pts array<struct<x:double,y:double>>")
    walks = [(1, "TO", 0, 1, 2, "BEGIN", None), (1, "TO", 1, 2, 3, "SAME_RNID", None), (1, "TO", 1, 2, 3, "XSTREET", 3), (1, "FROM", 0, 1, 1, "BEGIN", None), (4, "FROM", 0, 4, 4, "BEGIN", None)]
    w = spark.createDataFrame(walks, "pfi long, node_type string, step int, traversal_pfi long, traversal_ufi long, how string, xstreet_pfi long")
    got = {(x.pfi, x.node_type): (x.legs, round(x.length, 3), x.wkt, x.xstreet_wkt) for x in topology.walk_lines(w, roads).collect()}
    half = pytest.approx(14.142)
    assert got[1, "TO"] == (2, pytest.approx(34.142), "LINESTRING (0.000 0.000, 5.000 5.000, 10.000 0.000, 30.000 0.000)", "LINESTRING (30.000 0.000, 30.000 9.000)")
    assert got[1, "FROM"] == (1, half, "LINESTRING (10.000 0.000, 5.000 5.000, 0.000 0.000)", None) and got[4, "FROM"][:2] == (1, 2.0)


def test_clustered_tables_meet_where_they_lie(spark, tmp_path):
    from waymark.plans.deliverables import clustered_totals
    from waymark.sources import files

    o = files.cluster_table(spark.range(50).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey"), "clustered_o", ["o_orderkey"], 4, str(tmp_path / "o"))
    l = files.cluster_table(spark.range(200).selectExpr("id % 60 AS l_orderkey", "id AS l_quantity"), "clustered_l", ["l_orderkey"], 4, str(tmp_path / "l"))  # noqa: E741
    try:
        out = clustered_totals(o, l)
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 50 and out.agg(F.sum("n_lines")).first()[0] == sum(i % 60 < 50 for i in range(200))
    finally:
        for n in ("o", "l"):
            files.drop_table(spark, f"clustered_{n}", str(tmp_path / n))
    assert not (tmp_path / "o").exists()


def union_of(polygons):
    """Area and boundary length of a union of polygons without vertical edges, slab by slab between all their vertices and crossings."""
    edges = [(p, q, k) for k, rings in enumerate(polygons) for ring in rings for p, q in zip(ring, ring[1:] + ring[:1])]
    cuts = {x for p, q, _ in edges for x, _ in (p, q)}
    slope = lambda p, q: Fraction(q[1] - p[1], q[0] - p[0])
    for i, (p, q, _) in enumerate(edges):
        for r, s, _ in edges[i + 1 :]:
            if slope(p, q) != slope(r, s):
                x = (r[1] - slope(r, s) * r[0] - p[1] + slope(p, q) * p[0]) / (slope(p, q) - slope(r, s))
                if max(min(p[0], q[0]), min(r[0], s[0])) < x < min(max(p[0], q[0]), max(r[0], s[0])):
                    cuts.add(x)
    area = length = 0.0
    for lo, hi in zip(sorted(cuts), sorted(cuts)[1:]):
        mid, steps = (Fraction(lo) + hi) / 2, {}
        for k in range(len(polygons)):
            here = sorted((p[1] + slope(p, q) * (mid - p[0]), slope(p, q)) for p, q, o in edges if o == k and min(p[0], q[0]) < mid < max(p[0], q[0]))
            for n, (y, m) in enumerate(here):
                steps[y] = (steps.get(y, (0, m))[0] + (1 if n % 2 == 0 else -1), m)
        depth, below = 0, None
        for y in sorted(steps):
            before, depth = depth, depth + steps[y][0]
            if (before == 0) != (depth == 0):
                length += float(hi - lo) * float(1 + steps[y][1] ** 2) ** 0.5
                if depth == 0:
                    area += float((y - below) * (hi - lo))
                below = y
    return area, length


def dissolved(spark, polygons, **more):
    rows = [(k, "g", r, i, *map(float, p), *map(float, q)) for k, rings in enumerate(polygons) for r, ring in enumerate(rings) for i, (p, q) in enumerate(zip(ring, ring[1:] + ring[:1]))]
    edges = spark.createDataFrame(rows, "poly long, grp string, ring int, seq int, x1 double, y1 double, x2 double, y2 double")
    got = spatial.union_boundary(edges, "poly", "grp", **more).collect()
    return sum(r.x1 * r.y2 - r.y1 * r.x2 for r in got) / 2, sum(((r.x2 - r.x1) ** 2 + (r.y2 - r.y1) ** 2) ** 0.5 for r in got)


@pytest.mark.parametrize("seed", range(3))
def test_union_of_triangles(spark, seed):
    rng = random.Random(seed)
    polygons = []
    while len(polygons) < 14:
        t = [(rng.randrange(30), rng.randrange(30)) for _ in range(3)]
        if len({x for x, _ in t}) == 3 and (t[1][0] - t[0][0]) * (t[2][1] - t[0][1]) != (t[1][1] - t[0][1]) * (t[2][0] - t[0][0]):
            polygons += [[t]] * (2 if len(polygons) % 5 == 0 else 1)
    for size in (None, 50.0):
        assert dissolved(spark, polygons, size=size) == pytest.approx(union_of(polygons), rel=1e-5)


def test_union_by_cases(spark):
    square = lambda x, y, w: [(x, y), (x + w, y), (x + w, y + w), (x, y + w)]
    assert dissolved(spark, [[square(0, 0, 2)], [square(2, 0, 2)[::-1]]]) == (8, 12)  # a shared border goes, whichever way each runs
    assert dissolved(spark, [[square(0, 0, 2)], [square(2, 1, 2)]]) == (8, 14)  # a border shared in part
    assert dissolved(spark, [[square(0, 0, 2)], [square(2, 2, 2)]]) == (8, 16)  # a corner only
    assert dissolved(spark, [[square(0, 0, 9)], [square(2, 2, 2)], [square(0, 0, 9)]]) == (81, 36)  # one inside, one repeated
    holed = [square(0, 0, 9), square(3, 3, 3)[::-1]]
    assert dissolved(spark, [holed]) == (72, 48)
    assert dissolved(spark, [holed, [square(3, 3, 3)]]) == (81, 36)  # a hole filled
    assert dissolved(spark, [holed, [square(4, 4, 1)], [[(0, 0), (1, 1), (2, 2)]]]) == (73, 52)  # an island, and a polygon without area
    assert dissolved(spark, [[square(0, 0, 1)], []]) == (1, 4)
    empty = spark.createDataFrame([], "poly long, grp string, ring int, seq int, x1 double, y1 double, x2 double, y2 double")
    assert spatial.union_boundary(empty, "poly", "grp").count() == 0
    null = spark.createDataFrame([(1, None, 0, i, *map(float, p), *map(float, q)) for i, (p, q) in enumerate(zip(square(0, 0, 1), square(0, 0, 1)[1:] + square(0, 0, 1)[:1]))] + [(2, "h", 0, 0, None, 1.0, 2.0, 3.0)], empty.schema)
    assert [r.grp for r in spatial.union_boundary(null, "poly", "grp").collect()] == [None] * 4  # no group is a group of its own

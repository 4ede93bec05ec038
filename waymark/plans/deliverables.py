"""Registered queries of outputs, tables and chains, each beside its SQL; ``catalog`` imports them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import keys as k
from ..operators import ranging, registers, resolution, roadnames, topology
from ..sources import files
from . import chains, outputs
from . import proxies as p
from .catalog import _CR, _EX, _NET, _SIDES, _TYPE, _WALK, CELL, A, _component_sql, _excluded, _pip_sql, _walks, cte, query, soundex_sql

_ST = "coalesce(house_prefix_1, '') || CAST(house_number_1 AS STRING) || coalesce(house_suffix_1, '')"
_KEY = f"locality_name || '_' || road_name || '_' || road_type || '_' || coalesce(road_suffix, '') || '_' || ({_ST}) || '_'"
_REGISTER = "SELECT road_name_id, road_name, 'ROAD' AS road_type, CASE WHEN road_name_id % 2 = 0 THEN 'N' END AS road_suffix, CAST(0 AS INT) AS route_flag FROM (SELECT DISTINCT rnid AS road_name_id, road_name FROM ({r}) AS t) AS u".replace("{r}", p.ROAD)
_NULLS = lambda layout, given: ", ".join(f"{given[n]} AS {n}" if n in given else f"NULL AS {n}" for n, _ in (c.split() for c in layout.split(",")))


def _names(spark: SparkSession, sf: str) -> DataFrame:
    return p.read(spark, sf, _REGISTER).withColumn("soundex", k.soundex(F.regexp_replace("road_name", "[0-9]", "")))


_SDX = soundex_sql("trim(regexp_replace({c}, '[0-9]', '', 'g'))")
_MATCHES = "SELECT pfi AS addr_pfi, road_pfi, side_of_road, 'A_ID' AS rule_code, road_name_id AS addr_rnid, road_name_id + 1 AS road_rnid, house_number_1 AS intersects, dist_from_road, dist_along AS dist_along_road, rule_score, locality_name AS addr_locality_name, 'R300' AS addr_soundex, CAST(NULL AS STRING) AS geometry FROM ({a}) AS t".replace("{a}", p.ADDRESS)


@query("WITH m AS (" + _MATCHES + ") SELECT " + _NULLS(outputs.ADDRESS_ROAD, {
    "Length": "dist_from_road", "ADDRESS_PFI": "addr_pfi", "ROAD_PFI": "road_pfi", "SIDE_OF_ROAD": "side_of_road", "MATCH_METHOD": "rule_code", "INPUT_ROAD_NAME_ID": "addr_rnid", "MATCH_ROAD_NAME_ID": "road_rnid",
    "CROSS_COUNT": "intersects", "DISTANCE_FROM_FEATURE": "dist_from_road", "DISTANCE_ALONG_FEATURE": "dist_along_road", "SCORE": "rule_score", "LOCALITY_NAME": "addr_locality_name", "SOUNDEX": "addr_soundex",
}) + " FROM m")
def address_road_layout(spark: SparkSession, sf: str) -> DataFrame:
    return outputs.address_roads(p.read(spark, sf, _MATCHES))


_REG = f"SELECT row_number() OVER (ORDER BY address_string) AS mslink, address_string FROM (SELECT DISTINCT {_KEY} AS address_string FROM a WHERE house_number_1 > 9) u WHERE address_string IS NOT NULL"


@query(f"WITH {A}, reg AS ({_REG}), v AS (SELECT *, {_KEY} AS key, {_ST} AS st_num FROM a) SELECT " + _NULLS(outputs.ADDRESS, {
    "PFI": "CAST(pfi AS BIGINT)", "VicGrid94_X": "x", "VicGrid94_Y": "y", "INGR94_X": "x * 100", "INGR94_Y": "y * 100", "VicMapAddressPFI": "pfi", "VicMapPropertyPFI": "view_pfi",
    "EZI_ADDRESS": "concat_ws(' ', st_num, road_name, road_type, road_suffix, locality_name)", "CAD_STRING": "key", "CAD_LV_APT": "lv_apt", "CAD_ST_NUM": "st_num", "NUMBER_1": "house_number_1", "NUMBER_2": "house_number_2",
    "ROAD_NAME": "road_name", "ROAD_TYPE": "road_type", "ROAD_SUFFIX": "road_suffix", "ROAD_NAME_ID": "road_name_id", "LOCALITY_NAME": "locality_name", "MSLINK": "mslink", "VicMapRoadPFI": "road_pfi",
    "WKT": "printf('POINT (%.2f %.2f)', x, y)",
}) + " FROM v LEFT JOIN reg ON reg.address_string = v.key")
def address_output(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    a = p.read(spark, sf, p.ADDRESS)
    st = k.house_number(c("house_prefix_1"), c("house_number_1"), c("house_suffix_1"))
    a = a.withColumn("st_num", st).withColumn("address_string", k.address_string(c("locality_name"), c("road_name"), c("road_type"), c("road_suffix"), c("st_num"), trailing=True))
    known = a.where("house_number_1 > 9").select("address_string").distinct().where("address_string is not null")
    return outputs.address_output(a.withColumnRenamed("view_pfi", "property_pfi"), registers.dense_ids(known, ["address_string"], "mslink"))


@query(f"WITH road AS ({p.ROAD}), al AS ({p.ALIAS}), n AS ({_REGISTER}), ct AS (SELECT pfi, count(*) AS alias_count FROM al GROUP BY 1) SELECT " + _NULLS(outputs.ROAD_ALIAS, {
    "PFI": "road.pfi", "FEATURE_TYPE_CODE": "feature_type_code", "FROM_UFI": "from_ufi", "TO_UFI": "to_ufi", "LABEL_STRING": "concat_ws(' ', n.road_name, road_type, road_suffix)", "ROAD_NAME_ID": "al.road_name_id",
    "ROAD_NAME": "n.road_name", "ROAD_TYPE": "road_type", "ROAD_SUFFIX": "road_suffix", "SOUNDEX": _SDX.replace("{c}", "n.road_name"), "ROUTE_FLAG": "route_flag", "ALIAS_NUMBER": "alias_number", "ALIAS_COUNT": "alias_count",
    "LEFT_LOCALITY": "left_locality", "RIGHT_LOCALITY": "right_locality", "LABEL_FLAG": "CASE WHEN alias_number = 0 THEN 1 ELSE 0 END",
}) + " FROM road JOIN al ON al.pfi = road.pfi JOIN ct ON ct.pfi = road.pfi LEFT JOIN n ON n.road_name_id = al.road_name_id")
def road_alias_output(spark: SparkSession, sf: str) -> DataFrame:
    return outputs.road_alias_output(p.read(spark, sf, p.ROAD).drop("road_name"), p.read(spark, sf, p.ALIAS), _names(spark, sf))


_PLACE = "SELECT c_custkey AS ufi, CAST(c_custkey * 7919 % 10007 AS DOUBLE) AS x, CAST(c_custkey * 104729 % 10009 AS DOUBLE) AS y, c_mktsegment AS locality_name FROM {customer}"


@query(f"WITH road AS ({p.ROAD}), n AS ({_REGISTER}), pl AS ({_PLACE}), ends AS (SELECT DISTINCT from_ufi AS ufi, rnid FROM road UNION SELECT to_ufi, rnid FROM road) SELECT " + _NULLS(outputs.INTERSECTION_ALIAS, {
    "UFI": "a.ufi", "A_ROAD_NAME_ID": "a.rnid", "A_ROAD_NAME": "na.road_name", "A_ROAD_TYPE": "na.road_type", "A_ROAD_SUFFIX": "na.road_suffix", "A_SOUNDEX": _SDX.replace("{c}", "na.road_name"),
    "B_ROAD_NAME_ID": "b.rnid", "B_ROAD_NAME": "nb.road_name", "B_ROAD_TYPE": "nb.road_type", "B_ROAD_SUFFIX": "nb.road_suffix", "B_SOUNDEX": _SDX.replace("{c}", "nb.road_name"),
    "LOCALITY_NAME": "locality_name", "MUN_SDX": soundex_sql("locality_name"), "XVALUE": "x", "YVALUE": "y", "WKT": "CASE WHEN x IS NULL THEN 'POINT (null null)' ELSE printf('POINT (%.2f %.2f)', x, y) END",
}) + " FROM ends a JOIN ends b ON a.ufi = b.ufi AND a.rnid <> b.rnid LEFT JOIN n na ON na.road_name_id = a.rnid LEFT JOIN n nb ON nb.road_name_id = b.rnid LEFT JOIN pl ON pl.ufi = a.ufi")
def intersection_alias_output(spark: SparkSession, sf: str) -> DataFrame:
    road = p.read(spark, sf, p.ROAD)
    links = ranging.node_links(road).join(road.select(F.col("pfi").alias("road_pfi"), F.col("rnid").alias("road_name_id")), "road_pfi")
    return outputs.intersection_alias_output(links, _names(spark, sf), p.read(spark, sf, _PLACE))


_TOWN = cte(pt=p.POINT, e=p.EDGE, co=p.CORNERS)


@query(f"""WITH {_TOWN}, m AS (SELECT pfi, count(DISTINCT ring) AS ring_count, count(*) AS segment_count, round(abs(sum({_CR}) / 2), 4) AS area_size, round(sum(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))), 4) AS perimeter_size,
        sum((x1 + x2) * {_CR}) / (3 * sum({_CR})) AS mx, sum((y1 + y2) * {_CR}) / (3 * sum({_CR})) AS my FROM e GROUP BY 1), h AS ({_pip_sql('pt', 'pfi')}),
    d AS (SELECT h.polygon, h.pfi AS node, row_number() OVER (PARTITION BY h.polygon ORDER BY (x - mx) * (x - mx) + (y - my) * (y - my), h.pfi) AS r FROM h JOIN pt ON pt.pfi = h.pfi JOIN m ON m.pfi = h.polygon)
    SELECT co.pfi, name, coalesce(node, -1) AS node_id, round(mx * 100, 2) AS x_cord, round(my * 100, 2) AS y_cord, ring_count, segment_count, area_size, perimeter_size, {soundex_sql("regexp_replace(name, '[^A-Z]', '', 'g')")} AS soundex,
        CASE WHEN co.pfi % 3 <> 0 THEN co.pfi + 100 END AS esz FROM co JOIN m ON m.pfi = co.pfi LEFT JOIN d ON d.polygon = co.pfi AND r = 1""")
def locality_output(spark: SparkSession, sf: str) -> DataFrame:
    names = p.read(spark, sf, p.CORNERS).select("pfi", "name")
    attributes = chains.locality_attributes(p.read(spark, sf, p.EDGE), names, p.read(spark, sf, p.POINT).withColumnRenamed("pfi", "ufi"), CELL)
    out = outputs.locality_output(names, attributes, names.where("pfi % 3 <> 0").select((F.col("pfi") + 100).cast("long").alias("mslink"), "name"))
    return out.withColumns({c: F.round(c, d) for c, d in (("x_cord", 2), ("y_cord", 2), ("area_size", 4), ("perimeter_size", 4))})


@query(f"""WITH ra AS ({p.RANGE_ADDRESS}), sides AS (SELECT road_pfi, {_SIDES} FROM ra WHERE rule_score >= 50 AND addr_pfi % 3 <> 0 GROUP BY road_pfi),
    r AS (SELECT s_suppkey AS pfi, left_min, left_max, left_odd_min, left_odd_max, right_min, right_max, right_odd_min, right_odd_max FROM supplier LEFT JOIN sides ON s_suppkey = road_pfi) SELECT *, {_TYPE} AS address_type FROM r""")
def road_ranging_second_source(spark: SparkSession, sf: str) -> DataFrame:
    roads = spark.read.parquet(f"{sf}/supplier.parquet").select(F.col("s_suppkey").alias("pfi"))
    source = F.when(F.col("addr_pfi") % 3 != 0, "ADDRESS").when(F.col("addr_pfi") % 2 == 0, "STREET")
    return ranging.road_ranging(roads, p.read(spark, sf, p.RANGE_ADDRESS).withColumn("geocode_source", source), geocoded="ADDRESS")


_TEXTS = ", ".join(f"('{c}', '{t}')" for c, t in resolution.EXCLUSION_TEXT.items())


@query(f"WITH {A}, ex AS ({_EX} UNION ALL SELECT pfi, 'DUPLICATE' FROM (SELECT pfi, count(*) OVER (PARTITION BY road_name, road_type, locality_name) AS n FROM a) d WHERE n > 1) SELECT pfi, ex.rule_code, rule_desc FROM ex LEFT JOIN (VALUES {_TEXTS}) v(rule_code, rule_desc) ON v.rule_code = ex.rule_code")
def exclusion_texts(spark: SparkSession, sf: str) -> DataFrame:
    dups = resolution.duplicates(p.read(spark, sf, p.ADDRESS), ["road_name", "road_type", "locality_name"])
    return resolution.described(_excluded(spark, sf), dups)


@query("""WITH reg AS (SELECT row_number() OVER (ORDER BY name) AS mslink, name, 'old' AS source_dataset, CAST(NULL AS BIGINT) AS source_pk FROM (SELECT DISTINCT p_type AS name FROM part WHERE p_size < 10) d)
    SELECT * FROM reg UNION ALL SELECT (SELECT max(mslink) FROM reg) + row_number() OVER (ORDER BY name), name, 'parts', pk FROM (SELECT p_name AS name, min(p_partkey) AS pk FROM part GROUP BY 1) n WHERE name NOT IN (SELECT name FROM reg)""")
def register_with_source(spark: SparkSession, sf: str) -> DataFrame:
    part = spark.read.parquet(f"{sf}/part.parquet")
    old = registers.dense_ids(part.where("p_size < 10").select(F.col("p_type").alias("name")).distinct(), ["name"], "mslink")
    old = old.withColumns({"source_dataset": F.lit("old"), "source_pk": F.lit(None).cast("long")})
    batch = part.select(F.col("p_name").alias("name"), F.lit("parts").alias("source_dataset"), F.col("p_partkey").alias("source_pk"))
    return registers.register(old, batch, ["name"], "mslink", tags=["source_dataset", "source_pk"])


# --- names, roads, networks ------------------------------------------------------------------------


@query(f"""WITH road AS ({p.ROAD}), n AS ({_REGISTER}) SELECT pfi, road_name_id FROM road JOIN n ON n.road_name = road.road_name AND n.road_type = 'ROAD' AND coalesce(n.road_suffix, '') = CASE WHEN pfi % 3 = 0 THEN 'N' ELSE '' END
    WHERE road.road_name <> 'UNNAMED'""")
def name_ids(spark: SparkSession, sf: str) -> DataFrame:
    rows = p.read(spark, sf, p.ROAD).select("pfi", F.concat(F.lit(" "), F.lower("road_name")).alias("n"), F.lit("road").alias("t"), F.when(F.col("pfi") % 3 == 0, "n").alias("s"))
    register = _names(spark, sf).withColumn("road_suffix", F.coalesce("road_suffix", F.lit("")))
    return roadnames.name_ids(rows, register, "pfi", ("n", "t", "s"), skip=(" unnamed",))


_STATUS = _component_sql("SELECT pfi, from_ufi AS src, to_ufi AS dst FROM road").partition("SELECT ed.pfi")


@query(f"WITH RECURSIVE road AS ({p.ROAD}), {_STATUS[0].rstrip()}, st AS ({_STATUS[1]}{_STATUS[2]}) SELECT pfi, from_ufi, to_ufi FROM road WHERE pfi NOT IN (SELECT pfi FROM st WHERE status = 'DISCONNECTED')")
def validated_roads(spark: SparkSession, sf: str) -> DataFrame:
    road = p.read(spark, sf, p.ROAD)
    status = topology.connectivity(road.select("pfi", F.col("from_ufi").alias("src"), F.col("to_ufi").alias("dst")), 1)
    return chains.validated_roads(road, status, ["pfi", "from_ufi", "to_ufi"])


_GRID = "SELECT pfi, from_ufi * 10.0 + 0.004 AS x1, CAST(pfi % 2 AS DOUBLE) * 0.003 AS y1, to_ufi * 10.0 - 0.004 AS x2, CAST(pfi % 3 AS DOUBLE) * 0.002 AS y2 FROM ({r}) AS t".replace("{r}", p.ROAD)


@query(f"WITH RECURSIVE road AS ({p.ROAD}), {_component_sql('SELECT pfi, from_ufi AS src, to_ufi AS dst FROM road')}")
def snapped_component(spark: SparkSession, sf: str) -> DataFrame:
    """Ends that lie within the tolerance are one node: the same components as by node ids."""
    return topology.trace(p.read(spark, sf, _GRID), 10.0, 0.0, tolerance=0.01)


#: Ends scattered around their nodes by steps of 2.3 mm, up to 9 mm, so that they straddle the borders of any cells and some hang together only by way of others.
_SCATTER = "SELECT pfi, from_ufi + (pfi * 7 % 9 - 4) * CAST(0.0023 AS DOUBLE) AS x1, (pfi * 5 % 7 - 3) * CAST(0.0023 AS DOUBLE) AS y1, to_ufi + (pfi * 11 % 9 - 4) * CAST(0.0023 AS DOUBLE) AS x2, (pfi * 13 % 7 - 3) * CAST(0.0023 AS DOUBLE) AS y2 FROM ({r}) AS t".replace("{r}", p.ROAD)


@query(f"""WITH RECURSIVE l AS ({_SCATTER}), pt AS (SELECT x1 AS x, y1 AS y FROM l UNION SELECT x2, y2 FROM l), pn AS (SELECT row_number() OVER (ORDER BY x, y) AS i, x, y FROM pt),
    adj AS (SELECT a.i AS a, b.i AS b FROM pn a JOIN pn b ON b.x BETWEEN a.x - 0.011 AND a.x + 0.011 AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 0.0001),
    reach AS (SELECT i AS node, i AS n FROM pn UNION SELECT node, b FROM reach JOIN adj ON a = n), c AS (SELECT node, min(n) AS root FROM reach GROUP BY 1),
    nd AS (SELECT pn.x, pn.y, r.x AS nx, r.y AS ny FROM pn JOIN c ON c.node = pn.i JOIN pn r ON r.i = c.root)
    SELECT pfi, round(s.nx, 6) AS src_x, round(s.ny, 6) AS src_y, round(d.nx, 6) AS dst_x, round(d.ny, 6) AS dst_y FROM l JOIN nd s ON s.x = x1 AND s.y = y1 JOIN nd d ON d.x = x2 AND d.y = y2""")
def tolerance_nodes(spark: SparkSession, sf: str) -> DataFrame:
    nodes = topology.tolerance_nodes(p.read(spark, sf, _SCATTER), 0.01)
    return nodes.select("pfi", *[F.round(f"{e}.{c}", 6).alias(f"{e}_{c}") for e in ("src", "dst") for c in "xy"])


#: Roads as bent lines between the places of their nodes.
_SHAPE = "SELECT *, CAST(from_ufi % 40 * 10 AS DOUBLE) AS fx, CAST(floor(from_ufi / 40.0) * 10 AS DOUBLE) AS fy, CAST(from_ufi % 40 * 10 + pfi % 7 + 1 AS DOUBLE) AS mx, CAST(floor(from_ufi / 40.0) * 10 + pfi % 5 + 1 AS DOUBLE) AS my, CAST(to_ufi % 40 * 10 AS DOUBLE) AS tx, CAST(floor(to_ufi / 40.0) * 10 AS DOUBLE) AS ty FROM ({r}) AS t".replace("{r}", p.ROAD)
_SPOT = lambda c: f"printf('%.3f %.3f', s.{c}x, s.{c}y)"
_SHAPED = "sqrt((mx - fx) * (mx - fx) + (my - fy) * (my - fy)) + sqrt((tx - mx) * (tx - mx) + (ty - my) * (ty - my))"


@query(f"""WITH RECURSIVE {_NET}, {_WALK}, s AS (SELECT *, {_SHAPED} AS len FROM ({_SHAPE}) AS q), g AS (SELECT t.pfi, t.node_type, count(*) AS legs, round(sum(len), 6) AS length, 'LINESTRING (' || string_agg(
        CASE WHEN step > 0 THEN '' WHEN traversal_ufi = s.to_ufi THEN {_SPOT('f')} || ', ' ELSE {_SPOT('t')} || ', ' END || {_SPOT('m')} || ', ' || CASE WHEN traversal_ufi = s.to_ufi THEN {_SPOT('t')} ELSE {_SPOT('f')} END, ', ' ORDER BY step) || ')' AS wkt
        FROM trav t JOIN s ON s.pfi = traversal_pfi WHERE how <> 'XSTREET' GROUP BY 1, 2)
    SELECT g.*, x.wkt AS xstreet_wkt FROM g LEFT JOIN (SELECT t.pfi, node_type, 'LINESTRING (' || {_SPOT('f')} || ', ' || {_SPOT('m')} || ', ' || {_SPOT('t')} || ')' AS wkt FROM trav t JOIN s ON s.pfi = xstreet_pfi WHERE how = 'XSTREET') x ON x.pfi = g.pfi AND x.node_type = g.node_type""")
def walk_geometry(spark: SparkSession, sf: str) -> DataFrame:
    pts = F.array(*[F.struct(F.col(f"{c}x").alias("x"), F.col(f"{c}y").alias("y")) for c in "fmt"]).alias("pts")
    lines = topology.walk_lines(_walks(spark, sf), p.read(spark, sf, _SHAPE).select("pfi", "from_ufi", "to_ufi", pts))
    return lines.withColumn("length", F.round("length", 6))


_LL = "SELECT c_custkey AS pfi, 141 + c_custkey * 7919 % 9000 / 1000.0 AS lon, -39 + c_custkey * 104729 % 5000 / 1000.0 AS lat FROM {customer}"
_PLANE = {"east": 2_500_000.0, "north": 2_500_000.0}
_GRID_AT = {"east": 2_400_000.0, "north": 2_450_000.0, "turn": 30.0, "scale": 100.0}


@query(f"""WITH k AS (SELECT sqrt(2 / 298.257222101 - 1 / (298.257222101 * 298.257222101)) AS e), a AS (SELECT e, radians(v) AS phi, i FROM k, (VALUES (0, -37), (1, -36), (2, -38)) q(i, v)),
    mt AS (SELECT i, e, cos(phi) / sqrt(1 - e * e * sin(phi) * sin(phi)) AS m, tan(pi() / 4 - phi / 2) / pow((1 - e * sin(phi)) / (1 + e * sin(phi)), e / 2) AS t FROM a),
    n AS (SELECT max(e) AS e, (ln(max(CASE WHEN i = 1 THEN m END)) - ln(max(CASE WHEN i = 2 THEN m END))) / (ln(max(CASE WHEN i = 1 THEN t END)) - ln(max(CASE WHEN i = 2 THEN t END))) AS n, max(CASE WHEN i = 1 THEN m END) AS m1, max(CASE WHEN i = 1 THEN t END) AS t1, max(CASE WHEN i = 0 THEN t END) AS t0 FROM mt),
    pl AS (SELECT c.pfi, CAST(lon AS DOUBLE) AS lon, CAST(lat AS DOUBLE) AS lat, e, n, 6378137.0 * m1 / (n * pow(t1, n)) AS f, t0, tan(pi() / 4 - radians(lat) / 2) / pow((1 - e * sin(radians(lat))) / (1 + e * sin(radians(lat))), e / 2) AS t FROM ({_LL}) c, n),
    xy AS (SELECT pfi, lon, lat, f * pow(t, n) * sin(n * radians(lon - 145)) + 2500000 AS x, 2500000 + f * pow(t0, n) - f * pow(t, n) * cos(n * radians(lon - 145)) AS y FROM pl)
    SELECT pfi, round(x, 3) AS x, round(y, 3) AS y, round(lon, 7) AS lon, round(lat, 7) AS lat, round(((x - 2400000) * cos(radians(30)) + (y - 2450000) * sin(radians(30))) * 100, 1) AS u, round(((y - 2450000) * cos(radians(30)) - (x - 2400000) * sin(radians(30))) * 100, 1) AS v, true AS same FROM xy""")
def reprojected_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Degrees to the plane while scanning, back from it, and to a local grid and back, all to under a micrometre."""
    rows = p.read(spark, sf, _LL).select("pfi", F.col("lon").cast("double").alias("x"), F.col("lat").cast("double").alias("y"))
    plane = files.scan_projected(rows, "x", "y", "plane", **_PLANE)
    back = files.scan_projected(plane.withColumns({"lon": F.col("x"), "lat": F.col("y")}), "lon", "lat", "degrees", **_PLANE)
    again = files.scan_projected(back.withColumns({"x2": F.col("lon"), "y2": F.col("lat")}), "x2", "y2", "plane", **_PLANE)
    grid = files.scan_projected(again.withColumns({"u": F.col("x"), "v": F.col("y")}), "u", "v", "grid", **_GRID_AT)
    home = files.scan_projected(grid.withColumns({"x3": F.col("u"), "y3": F.col("v")}), "x3", "y3", "grid_inverse", **_GRID_AT)
    near = [F.abs(F.col(a) - F.col(b)) < 1e-6 for a, b in (("x", "x2"), ("y", "y2"), ("x", "x3"), ("y", "y3"))]
    digits = {"x": 3, "y": 3, "lon": 7, "lat": 7, "u": 1, "v": 1}
    return home.select("pfi", *[F.round(c, d).alias(c) for c, d in digits.items()], (near[0] & near[1] & near[2] & near[3]).alias("same"))


@query("SELECT o_orderkey, o_custkey, count(*) AS n_lines, sum(l_quantity) AS quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2")
def clustered_join(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables clustered by the same key are joined and grouped by it where their rows lie."""
    folder, run = files.scratch(spark), uuid.uuid4().hex
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sides = {"orders": ("o_orderkey", ["o_orderkey", "o_custkey"]), "lineitem": ("l_orderkey", ["l_orderkey", "l_quantity"])}
    at = {t: (f"waymark_{t}_{run}", f"{folder}/waymark-{t}-{run}") for t in sides}
    o, l = (files.cluster_table(spark.read.parquet(f"{sf}/{t}.parquet").select(*cols), at[t][0], [key], buckets, at[t][1]) for t, (key, cols) in sides.items())  # noqa: E741
    out = topology.checkpoint(clustered_totals(o, l))
    for name, path in at.values():
        files.drop_table(spark, name, path)
    return out


def clustered_totals(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders with their lines' totals; the merge hint keeps both sides where they lie."""
    met = orders.join(lines.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
    return met.groupBy("o_orderkey", "o_custkey").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("quantity"))


_SPOTS = "SELECT pfi, 'a' AS tag, CAST(pfi % 2 AS DOUBLE) AS d FROM ({l}) AS t UNION ALL SELECT pfi, 'b', 2.5 FROM ({l}) AS t".replace("{l}", p.LINE_POINTS)


@query(f"""WITH s AS ({p.SEGMENT}), w AS ({_SPOTS}), h AS (SELECT w.pfi, tag, x1, y1, x2, y2, CASE WHEN len > 0 THEN (d - cum_len) / len ELSE 0.0 END AS f, row_number() OVER (PARTITION BY w.pfi, tag ORDER BY seq) AS r
    FROM w JOIN s ON s.pfi = w.pfi AND d >= cum_len AND d <= cum_len + len) SELECT pfi, tag, round(x1 + f * (x2 - x1), 6) AS x, round(y1 + f * (y2 - y1), 6) AS y FROM h WHERE r = 1""")
def line_samples(spark: SparkSession, sf: str) -> DataFrame:
    out = g.interpolate(p.read(spark, sf, p.SEGMENT), p.read(spark, sf, _SPOTS))
    return out.withColumns({c: F.round(c, 6) for c in "xy"})


# --- tables and files ------------------------------------------------------------------------------


@query("SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def imported_table(spark: SparkSession, sf: str) -> DataFrame:
    """Sources saved as tables of a database, a second import that skips what exists, and a read from there."""
    name = f"waymark_{uuid.uuid4().hex}"
    sources = {name: f"{sf}/supplier.parquet", f"{name}_left_out": f"{sf}/nation.parquet"}
    files.require(["supplier"], ["supplier", "nation"])
    first = files.import_tables(spark, sources, skip=[f"{name}_LEFT_OUT"])
    again = files.import_tables(spark, sources, skip=[f"{name}_left_out"])
    if first != [name] or again:
        raise AssertionError("an import is made once")
    out = topology.checkpoint(files.scan(files.other_database(spark, "default", name), ["s_suppkey", "s_name", "s_nationkey"]))
    spark.sql(f"DROP TABLE {name}")
    return out


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice < 150000")
def filtered_scan(spark: SparkSession, sf: str) -> DataFrame:
    return files.scan(spark.read.parquet(f"{sf}/orders.parquet"), ["o_orderkey", "o_totalprice"], "o_orderstatus = 'F' AND o_totalprice < 150000", order=["o_orderkey"])


@query("SELECT r_regionkey, r_name FROM region")
def written_report(spark: SparkSession, sf: str) -> DataFrame:
    at = f"{files.scratch(spark)}/report-{uuid.uuid4().hex}"
    for _ in range(2):  # the second one replaces the first
        files.report(spark.read.parquet(f"{sf}/region.parquet").select("r_regionkey", "r_name"), at)
    return spark.read.csv(at, header=True, schema="r_regionkey int, r_name string")


@query("SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, NULL FROM supplier")
def copied_columns(spark: SparkSession, sf: str) -> DataFrame:
    target = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    source = spark.read.parquet(f"{sf}/supplier.parquet").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"), F.lit(1).alias("s_left_out"))
    return registers.copy_columns(target, source, ["c_custkey", "c_name"])

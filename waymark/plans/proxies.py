"""Address, road and polygon tables made from the driver's tables, as SQL that Spark and DuckDB both run.

The reference's own inputs aren't published, so each operator runs over
whole driver tables in an address-like shape. Every statement here is arithmetic
on keys; ``{name}`` stands for a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ADDRESS = """
    SELECT CAST(o_orderkey AS STRING) AS pfi,
        CASE WHEN o_orderkey % 17 = 0 THEN 'M' ELSE 'S' END AS address_class,
        CASE WHEN o_orderkey % 19 = 0 THEN 'PAPER_ROAD_ONLY' WHEN o_orderkey % 3 = 0 THEN 'OK' END AS feature_quality_id,
        CAST(nullif(o_orderkey % 50, 0) AS INT) AS house_number_1,
        CAST(CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey % 50 + 4 END AS INT) AS house_number_2,
        CASE WHEN o_orderkey % 22 = 0 THEN '1' WHEN o_orderkey % 11 = 0 THEN 'X' END AS house_prefix_1,
        CASE WHEN o_orderkey % 5 = 0 THEN 'A' END AS house_suffix_1,
        CASE WHEN o_orderkey % 13 = 0 THEN 'R' END AS house_prefix_2,
        CASE WHEN o_orderkey % 9 = 0 THEN 'B' END AS house_suffix_2,
        CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey * 7 % 100000 END AS INT) AS unit,
        CASE WHEN o_orderkey % 6 = 0 THEN 'BC' END AS unit_suffix,
        CAST(CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey % 9 END AS INT) AS floor,
        concat('ROAD ', CAST(o_custkey % 97 AS STRING)) AS road_name,
        CASE WHEN o_custkey % 5 = 0 THEN 'LANE' ELSE 'STREET' END AS road_type,
        CASE WHEN o_custkey % 4 = 0 THEN 'N' END AS road_suffix,
        o_orderpriority AS locality_name,
        CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS is_primary,
        CASE WHEN o_orderkey % 13 = 0 THEN 'B' ELSE 'P' END AS graphic_type,
        CASE WHEN o_orderkey % 3 = 0 THEN 'A' ELSE 'P' END AS status,
        CASE WHEN o_orderkey % 8 <> 0 THEN CAST(o_orderkey AS STRING) END AS view_pfi,
        CASE WHEN o_orderkey % 4 = 1 THEN CAST(o_orderkey % 40 AS STRING) END AS lv_apt,
        CAST(o_orderkey % 100 AS INT) AS rule_score,
        CAST(o_orderkey * 31 % 1000 AS DOUBLE) AS dist_from_road,
        CAST(o_custkey % 211 AS BIGINT) AS road_pfi,
        CAST(o_custkey % 41 AS BIGINT) AS road_name_id,
        CASE WHEN o_orderkey % 2 = 0 THEN 'L' ELSE 'R' END AS side_of_road,
        CAST(o_orderkey * 7919 % 1009 AS DOUBLE) AS dist_along,
        CAST(o_custkey * 7919 % 10007 AS DOUBLE) AS x, CAST(o_custkey * 104729 % 10009 AS DOUBLE) AS y
    FROM {orders}
"""

#: House numbers per supplier: the shape of the road ranging query.
RANGE_ADDRESS = """
    SELECT l_orderkey AS addr_pfi, l_suppkey AS road_pfi, CASE WHEN l_suppkey % 11 = 0 OR (l_suppkey % 7 = 0 AND l_linestatus = 'O') THEN NULL WHEN l_linestatus = 'O' THEN 'L' ELSE 'R' END AS side_of_road,
        CAST(CASE WHEN l_suppkey % 3 = 0 THEN l_quantity * 2 WHEN l_suppkey % 3 = 1 AND l_linestatus = 'O' THEN l_quantity * 2 + 1
            WHEN l_suppkey % 3 = 1 THEN l_quantity * 2 ELSE l_quantity END AS INT) AS house_number_1,
        CAST(CASE WHEN l_linenumber = 7 THEN l_quantity * 2 + 6 END AS INT) AS house_number_2,
        CAST(l_orderkey % 100 AS INT) AS rule_score, l_extendedprice AS dist_along
    FROM {lineitem}
"""

#: Roads in blocks of 40 nodes, so that there are many components; some loops, tunnels and unnamed roads.
ROAD = """
    SELECT c_custkey AS pfi, n AS from_ufi,
        CASE WHEN c_custkey % 9 = 0 THEN n ELSE n - n % 40 + (n + 1 + c_custkey % 3) % 40 END AS to_ufi,
        CASE WHEN c_custkey % 11 = 0 THEN 1312 ELSE CAST(floor(n / 6.0) AS BIGINT) % 301 END AS rnid,
        CASE WHEN c_custkey % 23 = 0 THEN 'TUNNEL' ELSE 'ROAD' END AS feature_type_code,
        CASE WHEN c_custkey % 11 = 0 THEN 'UNNAMED' ELSE concat('NAME ', CAST(CAST(floor(n / 6.0) AS BIGINT) % 301 AS STRING)) END AS road_name,
        CASE WHEN c_custkey % 5 = 0 THEN 'A (NSW)' WHEN c_custkey % 8 = 0 THEN NULL ELSE 'A' END AS left_locality,
        CASE WHEN c_custkey % 10 = 0 THEN 'B (NSW)' WHEN c_custkey % 6 = 0 THEN 'B (SA)' ELSE 'B' END AS right_locality
    FROM (SELECT c_custkey, CAST(floor(c_custkey / 2.0) AS BIGINT) AS n FROM {customer}) AS t
"""
BEARING = """
    SELECT c_custkey AS pfi, CAST(c_custkey * 37 % 360 AS DOUBLE) AS entry_bearing, CAST((c_custkey * 53 + 180) % 360 AS DOUBLE) AS entry_bearing_flip
    FROM {customer}
"""
NODE = """
    SELECT DISTINCT CASE WHEN n % 31 = 0 THEN -1 - n ELSE n END AS ufi, CASE WHEN n % 7 = 0 THEN 'Tunnel' ELSE 'junction' END AS feature_type_code, n * 2 AS conpfi1,
        CASE WHEN n % 2 = 0 THEN n * 2 - 3 END AS conpfi2
    FROM (SELECT CAST(floor(c_custkey / 2.0) AS BIGINT) AS n FROM {customer}) AS t
"""
ALIAS = """
    SELECT pfi, rnid AS road_name_id, 0 AS alias_number FROM ({road}) AS r
    UNION ALL SELECT pfi, CASE WHEN pfi % 4 = 0 AND rnid <> 1312 THEN (rnid + 1) % 301 ELSE rnid END AS road_name_id, 1 AS alias_number FROM ({road}) AS r
""".replace("{road}", ROAD)
#: Patch edges that join every third block of nodes to the next; the others are loops.
ROAD_PATCH = "SELECT DISTINCT n - n % 40 AS src, n - n % 40 + CASE WHEN CAST(floor(n / 40.0) AS BIGINT) % 3 = 0 THEN 40 ELSE 0 END AS dst FROM (SELECT CAST(floor(c_custkey / 2.0) AS BIGINT) AS n FROM {customer}) AS t"

#: Points of customers and suppliers on a plane of about 10 km.
POINT = "SELECT c_custkey AS pfi, CAST(c_custkey * 7919 % 10007 AS DOUBLE) AS x, CAST(c_custkey * 104729 % 10009 AS DOUBLE) AS y FROM {customer}"
SITE = "SELECT s_suppkey AS ufi, CAST(s_suppkey * 6007 % 10007 AS DOUBLE) AS x, CAST(s_suppkey * 8009 % 10009 AS DOUBLE) AS y FROM {supplier}"
#: A bent road per part: three points.
LINE_POINTS = """
    SELECT p_partkey AS pfi, px, py, px + p_partkey % 97 + 3 AS qx, py + p_partkey % 53 - 26 AS qy,
        px + p_partkey % 97 + 3 + p_partkey % 41 - 20 AS rx, py + p_partkey % 53 - 26 + p_partkey % 61 + 5 AS ry
    FROM (SELECT p_partkey, p_size, CAST(p_partkey * 7907 % 10007 AS DOUBLE) AS px, CAST(p_partkey * 6151 % 10009 AS DOUBLE) AS py FROM {part}) AS t
"""
SEGMENT = """
    SELECT pfi, 0 AS seq, px AS x1, py AS y1, qx AS x2, qy AS y2, sqrt((qx - px) * (qx - px) + (qy - py) * (qy - py)) AS len, CAST(0 AS DOUBLE) AS cum_len FROM ({line}) AS a
    UNION ALL SELECT pfi, 1, qx, qy, rx, ry, sqrt((rx - qx) * (rx - qx) + (ry - qy) * (ry - qy)), sqrt((qx - px) * (qx - px) + (qy - py) * (qy - py)) FROM ({line}) AS b
""".replace("{line}", LINE_POINTS)
#: Bent lines on a lattice of 12 by 12 per 40 parts, so that they often meet in vertices, end on each other and run along each other.
LATTICE = """
    SELECT pfi, block, b + px AS px, py, b + qx AS qx, qy, b + rx AS rx, ry FROM (
        SELECT p_partkey AS pfi, CAST(floor(p_partkey / 40.0) AS BIGINT) AS block, CAST(CAST(floor(p_partkey / 40.0) AS BIGINT) * 20 AS DOUBLE) AS b,
            CAST(p_partkey * 7 % 12 AS DOUBLE) AS px, CAST(p_partkey * 5 % 11 AS DOUBLE) AS py, CAST(p_partkey * 11 % 10 AS DOUBLE) AS qx, CAST(p_partkey * 3 % 12 AS DOUBLE) AS qy,
            CAST(CASE WHEN p_partkey % 6 = 0 THEN p_partkey * 7 % 12 ELSE p_partkey * 13 % 12 END AS DOUBLE) AS rx, CAST(CASE WHEN p_partkey % 6 = 0 THEN p_partkey * 5 % 11 ELSE p_partkey * 17 % 9 END AS DOUBLE) AS ry
        FROM {part}) AS t
    WHERE (px <> qx OR py <> qy) AND (qx <> rx OR qy <> ry)
"""
LATTICE_SEGMENT = """
    SELECT pfi, block, 0 AS seq, px AS x1, py AS y1, qx AS x2, qy AS y2 FROM ({l}) AS a UNION ALL SELECT pfi, block, 1, qx, qy, rx, ry FROM ({l}) AS b
""".replace("{l}", LATTICE)
#: A square with corners on the lattice per block.
LATTICE_EDGE = """
    SELECT block AS polygon, 0 AS ring, i AS seq, CAST(block * 20 + CASE WHEN i IN (0, 3) THEN 3 ELSE 8 END AS DOUBLE) AS x1, CAST(CASE WHEN i IN (0, 1) THEN 2 ELSE 7 END AS DOUBLE) AS y1,
        CAST(block * 20 + CASE WHEN i IN (2, 3) THEN 3 ELSE 8 END AS DOUBLE) AS x2, CAST(CASE WHEN i IN (0, 3) THEN 2 ELSE 7 END AS DOUBLE) AS y2
    FROM (SELECT DISTINCT CAST(floor(p_partkey / 40.0) AS BIGINT) AS block FROM {part}) AS t, (SELECT n_nationkey AS i FROM {nation} WHERE n_nationkey < 4) AS k
"""

#: Plots with cut corners per part, in blocks of 20 on a lattice, which overlap, touch and repeat each other; larger ones have a square hole.
PLOT = """
    SELECT pfi, block, x0, y0, x0 + w AS x1, y0 + h AS y1, cut, w >= 8 AND h >= 8 AS holed
    FROM (SELECT p_partkey AS pfi, block, block * 40 + k * 7 % 23 AS x0, k * 11 % 23 AS y0, 4 + k % 9 AS w, 4 + k * 5 % 8 AS h, k % 3 AS cut
        FROM (SELECT p_partkey, CAST(floor(p_partkey / 20.0) AS BIGINT) AS block, p_partkey - p_partkey % 20 + p_partkey % 20 % 17 AS k FROM {part}) AS t) AS u
"""
_RIM = [("x0 + cut", "y0"), ("x1 - cut", "y0"), ("x1", "y0 + cut"), ("x1", "y1 - cut"), ("x1 - cut", "y1"), ("x0 + cut", "y1"), ("x0", "y1 - cut"), ("x0", "y0 + cut")]
_HOLE = [("x0 + 3", "y0 + 3"), ("x0 + 3", "y1 - 3"), ("x1 - 3", "y1 - 3"), ("x1 - 3", "y0 + 3")]
_RINGS = [(ring, *pair) for ring in (_RIM, _HOLE) for pair in zip(ring, ring[1:] + ring[:1], strict=True)]
_CORNER = lambda end, axis: "CASE i " + " ".join(f"WHEN {i} THEN {r[end][axis]}" for i, r in enumerate(_RINGS)) + " END"
#: Their edges; plots of odd keys run the other way round.
PLOT_EDGE = (
    "SELECT pfi, block, CASE WHEN i < 8 THEN 0 ELSE 1 END AS ring, i AS seq, "
    + ", ".join(f"CAST(CASE WHEN pfi % 2 = 0 THEN {_CORNER(a, axis)} ELSE {_CORNER(3 - a, axis)} END AS DOUBLE) AS {n}" for n, a, axis in (("x1", 1, 0), ("y1", 1, 1), ("x2", 2, 0), ("y2", 2, 1)))
    + f" FROM ({PLOT}) AS t, (SELECT n_nationkey AS i FROM {{nation}} WHERE n_nationkey < 12) AS k WHERE i < 8 OR holed"
)

#: A quadrilateral per nation; neighbours overlap a little.
CORNERS = """
    SELECT n_nationkey AS pfi, n_name AS name, n_nationkey % 5 * 2000.0 AS ax, CAST(floor(n_nationkey / 5.0) AS BIGINT) * 2000.0 AS ay,
        n_nationkey % 5 * 2000.0 + 2050.0 AS bx, CAST(floor(n_nationkey / 5.0) AS BIGINT) * 2000.0 + n_nationkey * 3 AS by_,
        n_nationkey % 5 * 2000.0 + 2100.0 - n_nationkey AS cx, CAST(floor(n_nationkey / 5.0) AS BIGINT) * 2000.0 + 2030.0 AS cy,
        n_nationkey % 5 * 2000.0 + n_nationkey AS dx, CAST(floor(n_nationkey / 5.0) AS BIGINT) * 2000.0 + 1900.0 AS dy
    FROM {nation}
"""
EDGE = """
    SELECT pfi, 0 AS ring, 0 AS seq, CAST(ax AS DOUBLE) AS x1, CAST(ay AS DOUBLE) AS y1, CAST(bx AS DOUBLE) AS x2, CAST(by_ AS DOUBLE) AS y2 FROM ({c}) AS a
    UNION ALL SELECT pfi, 0, 1, CAST(bx AS DOUBLE), CAST(by_ AS DOUBLE), CAST(cx AS DOUBLE), CAST(cy AS DOUBLE) FROM ({c}) AS a
    UNION ALL SELECT pfi, 0, 2, CAST(cx AS DOUBLE), CAST(cy AS DOUBLE), CAST(dx AS DOUBLE), CAST(dy AS DOUBLE) FROM ({c}) AS a
    UNION ALL SELECT pfi, 0, 3, CAST(dx AS DOUBLE), CAST(dy AS DOUBLE), CAST(ax AS DOUBLE), CAST(ay AS DOUBLE) FROM ({c}) AS a
""".replace("{c}", CORNERS)

#: Pairs of road names, one of each kind of likeness in turn.
NAME_PAIR = """
    SELECT p_partkey AS id, n AS b_name, CASE WHEN p_partkey % 3 = 0 THEN 'ROAD' ELSE 'STREET' END AS b_type, p_partkey % 50 AS b_rnid,
        CASE p_partkey % 9 WHEN 0 THEN n WHEN 1 THEN replace(n, ' ', '-') WHEN 2 THEN concat('OLD ', n) WHEN 3 THEN concat(n, 'S')
            WHEN 4 THEN concat(substr(n, 1, 5), ' HILL') WHEN 5 THEN 'UNNAMED' WHEN 6 THEN concat('MOUNT ', n, ' UPPER LOWER FAR') WHEN 7 THEN replace(n, ' ', '') ELSE 'ELSEWHERE' END AS t_name,
        CASE WHEN p_partkey % 4 = 0 THEN 'ROAD' ELSE 'STREET' END AS t_type, p_partkey * 3 % 50 AS t_rnid, p_size
    FROM (SELECT p_partkey, p_size, CASE WHEN p_partkey % 10 = 9 THEN 'UNNAMED' WHEN p_partkey % 7 = 3 THEN concat(upper(p_name), 'S') ELSE upper(p_name) END AS n FROM {part}) AS t
"""

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read(spark: SparkSession, sf_dir: str, sql: str, spread: dict[str, str] | None = None) -> DataFrame:
    """Run one of these statements over the tables of a folder. ``spread``: tables, with a key, of whose rows it makes so much that they are dealt out first, as their files may be few."""
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in sql}
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    used |= {t: used[t].repartition(n, key) for t, key in (spread or {}).items()}
    return spark.sql(sql, **used)


def plain(sql: str) -> str:
    """The same statement for an engine that has the tables as views."""
    for t in TABLES:
        sql = sql.replace(f"{{{t}}}", t)
    return sql

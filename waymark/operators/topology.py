"""Road topology: turns, best continuation, cross streets and connectivity."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import path_length, turn_angle, wkt_line
from ..functions.keys import UNNAMED_ID
from ..sources.files import scratch

#: A walk takes steps 0 to LAST_STEP.
LAST_STEP = 51


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the session's ``spark.checkpoint.dir``.

    A checkpoint keeps the estimated size of its plan, and that of a join is the product of both sides, so
    that a loop's would grow to numbers of millions of digits; the rows are given as a plain scan.
    """
    spark = df.sparkSession
    scratch(spark)
    plan = df.checkpoint(eager=True)._jdf
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(plan.queryExecution().toRdd(), plan.schema(), False), spark)


def incidence(roads: DataFrame) -> DataFrame:
    """G-1: (ufi, pfi) for both ends of each road; a loop counts once."""
    return roads.select(F.explode(F.array_distinct(F.array("from_ufi", "to_ufi"))).alias("ufi"), "pfi")


def turn_table(roads: DataFrame, bearings: DataFrame, nodes: DataFrame) -> DataFrame:
    """G-2 to G-4: (ufi, from_pfi, to_pfi, angle, from_bearing, to_bearing) for ordered pairs of different roads at a known node.

    ``nodes``: (ufi, feature_type_code, conpfi1, conpfi2). At a tunnel's node a
    pair goes if exactly one of its roads is one that the tunnel connects. A
    road's bearing is that of entering it, or the flipped entry bearing where
    the node is its far end.
    """
    ends = incidence(roads.select("pfi", "from_ufi", "to_ufi")).join(roads.select("pfi", "from_ufi"), "pfi").join(bearings.select("pfi", "entry_bearing", "entry_bearing_flip"), "pfi")
    ends = ends.select("ufi", "pfi", F.when(F.col("ufi") == F.col("from_ufi"), F.col("entry_bearing")).otherwise(F.col("entry_bearing_flip")).alias("b"))
    known = ends.join(nodes.select("ufi", "feature_type_code", "conpfi1", "conpfi2"), "ufi")
    mine = F.coalesce(F.col("pfi").isin(F.col("conpfi1"), F.col("conpfi2")), F.lit(False))
    known = known.select("ufi", "pfi", "b", F.when(F.lower("feature_type_code") == "tunnel", mine).alias("through"))
    a, b = known.alias("a"), known.alias("b")
    split = F.coalesce(F.col("a.through") != F.col("b.through"), F.lit(False))
    pairs = a.join(b, F.col("a.ufi") == F.col("b.ufi")).where((F.col("a.pfi") != F.col("b.pfi")) & ~split)
    return pairs.select(
        F.col("a.ufi").alias("ufi"), F.col("a.pfi").alias("from_pfi"), F.col("b.pfi").alias("to_pfi"), F.round(turn_angle(F.col("a.b"), F.col("b.b")), 5).alias("angle"),
        F.round(F.col("a.b"), 5).alias("from_bearing"), F.round(F.col("b.b"), 5).alias("to_bearing"),
    )


def _primary(aliases: DataFrame) -> DataFrame:
    return aliases.groupBy("pfi").agg(F.min_by("road_name_id", F.struct("alias_number", "road_name_id")).alias("rnid"))


def best_continuation(turns: DataFrame, aliases: DataFrame, roads: DataFrame) -> DataFrame:
    """G-5: one successor per (pfi, ufi): (pfi, ufi, next_pfi, next_ufi, how).

    Of the connecting roads, nearest to straight ahead first: one that carries
    the road's own primary name, unless that is UNNAMED (SAME_RNID), else the first
    (CLOSE_TO_180). Ties go by the text of the id. ``next_ufi``: the successor's other end.
    """
    rows = turns.select("ufi", F.col("from_pfi").alias("pfi"), F.col("to_pfi").alias("next_pfi"), F.abs(F.lit(180) - F.abs("angle")).alias("off"))
    rows = rows.join(_primary(aliases), "pfi", "left")
    carries = aliases.select(F.col("pfi").alias("next_pfi"), F.col("road_name_id").alias("rnid"), F.lit(True).alias("same")).distinct()
    rows = rows.join(carries, ["next_pfi", "rnid"], "left").withColumn("same", F.coalesce(F.col("same") & (F.col("rnid") != UNNAMED_ID), F.lit(False)))
    best = F.min(F.struct((~F.col("same")).alias("other"), "off", F.col("next_pfi").cast("string").alias("txt"), "next_pfi")).alias("b")
    out = rows.groupBy("pfi", "ufi").agg(best).select("pfi", "ufi", F.col("b.next_pfi").alias("next_pfi"), F.when(F.col("b.other"), "CLOSE_TO_180").otherwise("SAME_RNID").alias("how"))
    ends = roads.select(F.col("pfi").alias("next_pfi"), "from_ufi", "to_ufi")
    far = F.when(F.col("from_ufi") == F.col("ufi"), F.col("to_ufi")).otherwise(F.col("from_ufi"))
    return out.join(ends, "next_pfi").select("pfi", "ufi", "next_pfi", far.alias("next_ufi"), "how")


def cross_street_walks(roads: DataFrame, turns: DataFrame, aliases: DataFrame, last_step: int = LAST_STEP) -> DataFrame:
    """G-6, G-8: the traversal rows (pfi, node_type, step, traversal_pfi, traversal_ufi, conn_count, how, xstreet_pfi).

    From each end of each road: if a connecting road, by rising |angle|, has no
    UNNAMED alias and no alias of the base road's name and isn't a tunnel, it
    is the cross street, named in a second row of that step with how = 'XSTREET';
    else the walk goes on along the best continuation. It ends where no road
    connects (ROAD_END), or after step ``last_step``.

    Where a walk goes on to doesn't depend on its base name; whether it goes on does: all usable candidates must carry
    that name. So per (road, node) there is a successor and the set of names that pass it, the names which its
    candidates have in common (null: no candidate, so every name). Jumps of 2, 4, ... 32 steps come from joining
    those of half the length end to end, with the names that pass all of them and the legs on the way; a jump that no name passes goes.
    Each walk then takes the longest jumps that its name passes, from the largest to the smallest, as in binary
    search: 5 joins to make the jumps and 6 to walk, instead of one a step.
    """
    primary = _primary(aliases)
    place, who = ["traversal_pfi", "traversal_ufi"], ["pfi", "node_type"]
    unnamed = aliases.where(F.col("road_name_id") == UNNAMED_ID).select("pfi")
    tunnel = roads.where("feature_type_code = 'TUNNEL'").select("pfi")
    at_node = turns.select(F.col("from_pfi").alias("traversal_pfi"), F.col("ufi").alias("traversal_ufi"), F.col("to_pfi").alias("xpfi"), F.abs("angle").alias("off"))
    names = aliases.groupBy(F.col("pfi").alias("xpfi")).agg(F.collect_set("road_name_id").alias("names"))
    usable = at_node.join(unnamed.union(tunnel).distinct().withColumnRenamed("pfi", "xpfi"), "xpfi", "left_anti").join(names, "xpfi", "left")
    order = F.array_sort(F.collect_list(F.struct("off", F.col("xpfi").cast("string").alias("txt"), "xpfi", "names"))).alias("cands")
    degree = at_node.groupBy(*place).agg(F.count(F.lit(1)).alias("conn_count"))
    follow = best_continuation(turns, aliases, roads).select(F.col("pfi").alias("traversal_pfi"), F.col("ufi").alias("traversal_ufi"), "next_pfi", "next_ufi", F.col("how").alias("next_how"))
    table = checkpoint(degree.join(usable.groupBy(*place).agg(order), place, "left").join(follow, place, "left"))
    jumps = _jumps(table, last_step)
    ends = F.explode(F.array(F.struct(F.lit("FROM").alias("node_type"), F.col("from_ufi").alias("u")), F.struct(F.lit("TO").alias("node_type"), F.col("to_ufi").alias("u")))).alias("e")
    kind = roads.schema["pfi"].dataType.simpleString()
    at = roads.select("pfi", "from_ufi", "to_ufi").join(primary, "pfi", "left").select("pfi", F.col("rnid").alias("base_rnid"), ends)
    at = at.select("pfi", "base_rnid", "e.node_type", F.col("pfi").alias("traversal_pfi"), F.col("e.u").alias("traversal_ufi"), F.array().cast(_leg_type(table)).alias("trail"))
    for length, jump in reversed(jumps):
        near = jump.select(*place, "to_pfi", "to_ufi", "pass", "legs")
        here = at.join(near, place, "left")
        goes = F.coalesce(F.col("to_pfi").isNotNull() & (F.col("pass").isNull() | F.array_contains("pass", F.col("base_rnid"))) & (F.size("trail") + length <= last_step), F.lit(False))
        at = here.select(
            "pfi", "base_rnid", "node_type", F.when(goes, F.col("to_pfi")).otherwise(F.col("traversal_pfi")).alias("traversal_pfi"), F.when(goes, F.col("to_ufi")).otherwise(F.col("traversal_ufi")).alias("traversal_ufi"),
            F.when(goes, F.concat("trail", "legs")).otherwise(F.col("trail")).alias("trail"),
        )
    # the last place of each walk: a cross street, no road, or no step left
    first = F.get(F.filter("cands", lambda c: ~F.coalesce(F.array_contains(c["names"], F.col("base_rnid")), F.lit(False))), F.lit(0))["xpfi"]
    last = F.struct(*place, F.coalesce("conn_count", F.lit(0)).cast("long").alias("conn_count"), F.lit(None).cast("string").alias("next_how"))
    done = checkpoint(at.join(table.select(*place, "conn_count", "cands"), place, "left").select(*who, F.concat("trail", F.array(last).cast(_leg_type(table))).alias("trail"), first.alias("x")))
    rows = done.select(*who, "trail", F.posexplode("trail").alias("step", "leg"))
    how = F.coalesce(F.get("trail", F.col("step") - 1)["next_how"], F.lit("BEGIN"))
    rows = rows.select(*who, "step", "leg.traversal_pfi", "leg.traversal_ufi", "leg.conn_count", how.alias("how"), F.lit(None).cast(kind).alias("xstreet_pfi"))
    found = done.where("x is not null").select(*who, (F.size("trail") - 1).alias("step"), F.element_at("trail", -1).alias("leg"), F.col("x").cast(kind).alias("xstreet_pfi"))
    return rows.union(found.select(*who, "step", "leg.traversal_pfi", "leg.traversal_ufi", "leg.conn_count", F.lit("XSTREET").alias("how"), "xstreet_pfi"))


def _leg_type(table: DataFrame) -> str:
    """The type of a walk's legs: the places left, and how the walk went on from each."""
    kind = {f.name: f.dataType.simpleString() for f in table.schema}
    return f"array<struct<traversal_pfi:{kind['traversal_pfi']},traversal_ufi:{kind['traversal_ufi']},conn_count:bigint,next_how:string>>"


def _jumps(table: DataFrame, last_step: int) -> list[tuple[int, DataFrame]]:
    """Jumps of 1, 2, 4, ... steps, up to ``last_step``: [(steps, (traversal_pfi, traversal_ufi, to_pfi, to_ufi, pass, legs))]; lengths that no walk has are left out."""
    place = ["traversal_pfi", "traversal_ufi"]
    names = F.transform("cands", lambda c: F.coalesce(c["names"], F.array().cast(table.schema["cands"].dataType.elementType["names"].dataType)))
    common = F.aggregate(F.slice(names, 2, F.greatest(F.size("cands") - 1, F.lit(0))), F.get(names, F.lit(0)), F.array_intersect)
    leg = F.array(F.struct(*place, F.col("conn_count").cast("long").alias("conn_count"), F.col("next_how").alias("next_how"))).cast(_leg_type(table))
    passable = F.col("pass").isNull() | (F.size("pass") > 0)
    steps = table.where("next_pfi is not null").select(*place, F.col("next_pfi").alias("to_pfi"), F.col("next_ufi").alias("to_ufi"), F.when(F.size("cands") > 0, common).alias("pass"), leg.alias("legs"))
    out, length, jump = [], 1, checkpoint(steps.where(passable))
    while length <= last_step and not jump.isEmpty():
        out.append((length, jump))
        length *= 2
        if length <= last_step:
            then = jump.select(F.col("traversal_pfi").alias("to_pfi"), F.col("traversal_ufi").alias("to_ufi"), F.col("to_pfi").alias("end_pfi"), F.col("to_ufi").alias("end_ufi"), F.col("pass").alias("then_pass"), F.col("legs").alias("then_legs"))
            both = F.when(F.col("pass").isNull(), F.col("then_pass")).when(F.col("then_pass").isNull(), F.col("pass")).otherwise(F.array_intersect("pass", "then_pass"))
            far = jump.join(then, ["to_pfi", "to_ufi"]).select(*place, F.col("end_pfi").alias("to_pfi"), F.col("end_ufi").alias("to_ufi"), both.alias("pass"), F.concat("legs", "then_legs").alias("legs"))
            jump = checkpoint(far.where(passable))
    return out


def cross_streets(roads: DataFrame, walks: DataFrame, aliases: DataFrame) -> DataFrame:
    """G-6: (pfi, rnid, from_ufi, from_xrnid, from_xpfi, to_ufi, to_xrnid, to_xpfi); -1 where a walk found none."""
    x = walks.where("how = 'XSTREET'").join(_primary(aliases).select(F.col("pfi").alias("xstreet_pfi"), "rnid"), "xstreet_pfi", "left")
    at = [F.max(F.when(F.col("node_type") == t, F.col(c))).alias(f"{t.lower()}_{n}") for t in ("FROM", "TO") for c, n in (("rnid", "xrnid"), ("xstreet_pfi", "xpfi"))]
    found = x.groupBy("pfi").agg(*at)
    out = roads.select("pfi", "from_ufi", "to_ufi").join(_primary(aliases), "pfi", "left").join(found, "pfi", "left")
    return out.select("pfi", "rnid", *[c for t in ("from", "to") for c in (F.col(f"{t}_ufi"), F.coalesce(f"{t}_xrnid", F.lit(-1)).alias(f"{t}_xrnid"), F.coalesce(f"{t}_xpfi", F.lit(-1)).alias(f"{t}_xpfi"))])


def walk_distances(walks: DataFrame, lengths: DataFrame) -> DataFrame:
    """G-7, GE-14: (pfi, node_type, distance): the lengths of a walk's rows, its repeated last segment included, less the base road's."""
    legs = walks.select("pfi", "node_type", F.col("traversal_pfi").alias("on"))
    total = legs.join(lengths.select(F.col("pfi").alias("on"), "length"), "on").groupBy("pfi", "node_type").agg(F.sum("length").alias("total"))
    return total.join(lengths.select("pfi", "length"), "pfi").select("pfi", "node_type", (F.col("total") - F.col("length")).alias("distance"))


def walk_lines(walks: DataFrame, roads: DataFrame) -> DataFrame:
    """GE-14, G-8: (pfi, node_type, legs, length, wkt, xstreet_wkt): the roads of each walk as one directed line, and the cross street it found.

    ``roads``: (pfi, from_ufi, to_ufi, pts). A walk leaves every leg at a known node, so a leg runs forward if that is the road's
    far end and backward if not; the legs then follow each other end to end, from the base road's other end to the last node.
    Points that two legs share at a node come once. The row that repeats a walk's last leg for its cross street is no leg of its own.
    """
    line = roads.select(F.col("pfi").alias("traversal_pfi"), "to_ufi", "pts")
    legs = walks.where("how <> 'XSTREET'").select("pfi", "node_type", "step", "traversal_pfi", "traversal_ufi").join(line, "traversal_pfi")
    run = F.when(F.col("to_ufi") == F.col("traversal_ufi"), F.col("pts")).otherwise(F.reverse("pts"))
    # a fold over at most LAST_STEP + 1 legs, in their order
    parts = F.array_sort(F.collect_list(F.struct("step", run.alias("pts"))))
    whole = legs.groupBy("pfi", "node_type").agg(parts.alias("parts"))
    first = F.get("parts", F.lit(0))["pts"]
    joined = F.aggregate(F.slice("parts", F.lit(2), F.greatest(F.size("parts") - 1, F.lit(0))), first, lambda done, leg: F.concat(done, F.when(F.element_at(done, -1) == F.get(leg["pts"], F.lit(0)), F.slice(leg["pts"], F.lit(2), F.size(leg["pts"]))).otherwise(leg["pts"])))
    out = whole.select("pfi", "node_type", F.size("parts").cast("long").alias("legs"), joined.alias("line"))
    found = walks.where("how = 'XSTREET'").select("pfi", "node_type", F.col("xstreet_pfi").alias("traversal_pfi")).join(line, "traversal_pfi").select("pfi", "node_type", F.col("pts").alias("xpts"))
    out = out.join(found, ["pfi", "node_type"], "left")
    return out.select("pfi", "node_type", "legs", path_length(F.col("line")).alias("length"), wkt_line(F.col("line")).alias("wkt"), F.when(F.col("xpts").isNotNull(), wkt_line(F.col("xpts"))).alias("xstreet_wkt"))


def snap(lines: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Edges (pfi, src, dst) between line ends that round to the same place on a grid of ``tolerance``; see ``tolerance_nodes`` for a true distance."""
    node = lambda x, y: F.concat_ws(":", F.round(x / tolerance).cast("long"), F.round(y / tolerance).cast("long"))
    return lines.select("pfi", node(F.col("x1"), F.col("y1")).alias("src"), node(F.col("x2"), F.col("y2")).alias("dst"))


def tolerance_nodes(lines: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """G-10: edges (pfi, src, dst) between nodes, where ends of lines within ``tolerance`` of each other, directly or by way of others, are one node.

    ``lines``: (pfi, x1, y1, x2, y2). A node is the place struct(x, y) of its first end, by x and then y. Equal ends are one place from
    the start. Cells are so small that all places in one are within the tolerance of each other: each is linked to the cell's
    first only. Places of different cells meet where their cells lie near enough, and an exact distance decides, wherever
    the borders of cells fall. The components of these links are the nodes.
    """
    side = tolerance / 1.5  # the diagonal is shorter than the tolerance
    place = lambda i: F.struct(*[F.col(f"{c}{i}").cast("double").alias(c) for c in "xy"])
    ends = lines.select("pfi", place(1).alias("src"), place(2).alias("dst"))
    places = ends.select(F.explode(F.array("src", "dst")).alias("p")).distinct()
    at = checkpoint(places.select("p", F.floor(F.col("p.x") / side).cast("long").alias("cx"), F.floor(F.col("p.y") / side).cast("long").alias("cy")))
    within = at.join(at.groupBy("cx", "cy").agg(F.min("p").alias("first")), ["cx", "cy"]).select(F.col("p").alias("src"), F.col("first").alias("dst"))
    # each pair of cells meets once: those up to two to the right, or above
    around = [(dx, dy) for dx in range(3) for dy in range(-2, 3) if (dx, dy) > (0, 0)]
    step = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in around])).alias("o")
    asking = at.select("p", "cx", "cy", step).select(F.col("p").alias("a"), (F.col("cx") + F.col("o.dx")).alias("cx"), (F.col("cy") + F.col("o.dy")).alias("cy"))
    d2 = F.expr("(a.x - p.x) * (a.x - p.x) + (a.y - p.y) * (a.y - p.y)")
    across = asking.join(at, ["cx", "cy"]).where(d2 <= tolerance * tolerance).select(F.col("a").alias("src"), F.col("p").alias("dst"))
    node = checkpoint(component_labels(within.union(across)))
    out = ends.join(node.select(F.col("node").alias("src"), F.col("component").alias("s")), "src").join(node.select(F.col("node").alias("dst"), F.col("component").alias("d")), "dst")
    return out.select("pfi", F.col("s").alias("src"), F.col("d").alias("dst"))


def trace(lines: DataFrame, x: float, y: float, tolerance: float = 0.01) -> DataFrame:
    """G-10: (pfi, status) of lines by whether they hang together, end to end within ``tolerance``, with the end nearest to a constant place."""
    edges = checkpoint(tolerance_nodes(lines, tolerance))
    places = edges.select(F.explode(F.array("src", "dst")).alias("ufi")).distinct().select("ufi", "ufi.x", "ufi.y")
    start = nearest_to(places, x, y).select("ufi.x", "ufi.y").first()
    if start is None:
        return edges.select("pfi", F.lit("DISCONNECTED").alias("status"))
    return connectivity(edges, F.struct(F.lit(start["x"]).alias("x"), F.lit(start["y"]).alias("y")))


def component_labels(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, by alternating stars, in a logarithmic number of rounds.

    In a round every node's larger neighbours are hung under the least node
    it sees, then its smaller ones; minima are combined before the shuffle.
    """
    links = edges.select(F.col("src").alias("u"), F.col("dst").alias("v"))
    alone = links.select("u").union(links.select("v")).distinct()
    links, seen = checkpoint(links.where("u <> v").distinct()), None
    for _ in range(most_rounds):
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        hung = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        floor = hung.groupBy("u").agg(F.min("v").alias("m"))
        links = checkpoint(hung.join(floor, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(floor.select("u", "m")).where("u <> v").distinct())
        now = links.agg(F.count("*"), F.expr("coalesce(bit_xor(xxhash64(u, v)), 0)")).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    root = links.groupBy("u").agg(F.min("v").alias("c"))
    return alone.join(root, "u", "left").select(F.col("u").alias("node"), F.coalesce("c", "u").alias("component"))


def connectivity(edges: DataFrame, seed, patches: DataFrame | None = None) -> DataFrame:
    """G-9: (pfi, status): NETWORKED if the edge is in the seed node's component, else DISCONNECTED.

    ``patches``: further edges (src, dst), which connect but have pfi -1.
    """
    every = edges.select("pfi", "src", "dst")
    if patches is not None:
        every = every.union(patches.select(F.lit(-1).cast(edges.schema["pfi"].dataType), "src", "dst"))
    labels = component_labels(every)
    home = labels.where(F.col("node") == (seed if isinstance(seed, Column) else F.lit(seed))).select("component", F.lit("NETWORKED").alias("status"))  # at most one row
    inside = labels.join(F.broadcast(home), "component").select(F.col("node").alias("src"), "status")
    return every.join(inside, "src", "left").select("pfi", F.coalesce("status", F.lit("DISCONNECTED")).alias("status"))


def nearest_to(points: DataFrame, x: float, y: float) -> DataFrame:
    """J-19: the one point nearest to a constant place (a top-k of one; ties by ufi)."""
    d2 = (F.col("x") - x) * (F.col("x") - x) + (F.col("y") - y) * (F.col("y") - y)
    return points.withColumn("d2", d2).orderBy("d2", "ufi").limit(1)


def disconnected_splits(roads: DataFrame) -> DataFrame:
    """G-11: (pfi, split): UNNAMED, VIC and INTERSTATE are independent predicates, so a road may be in two."""
    named = F.col("road_name") != "UNNAMED"
    sides = ("left_locality", "right_locality")
    inside = [reduce(or_, [~F.col(c).like(f"%({state})%") for c in sides]) for state in ("NSW", "SA")]
    outside = reduce(or_, [F.col(c).like(f"%({state})%") for state in ("NSW", "SA") for c in sides])
    splits = F.array(
        F.when(F.col("road_name") == "UNNAMED", F.lit("UNNAMED")), F.when(named & inside[0] & inside[1], F.lit("VIC")), F.when(named & outside, F.lit("INTERSTATE"))
    )
    return roads.select("pfi", F.explode(F.filter(splits, lambda s: s.isNotNull())).alias("split"))

"""Rules as data: attribute and spatial matchers, and the cascade that matches addresses to roads."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..functions.geometry import extend_short
from .spatial import crossings, distance_join, line_rows, sides, spread
from .topology import checkpoint

RING = 250
MOST_RULES = 10_000
SHARE = 16  # roads that an address looks at first in each ring
NAMELESS = ("UNNAMED", "UNKNOWN")
RULE_SCHEMA = "test_order int, code string, score int, match_attribute string, match_spatial string, max_intersects int, max_distance int"


def rules_in_order(categories: DataFrame, category_rules: DataFrame, rules: DataFrame, category: str) -> DataFrame:
    """S-10: the rules of a category with their test order."""
    known = categories.where(F.col("category_code") == category).select("category_code")
    return category_rules.join(F.broadcast(known), "category_code").join(rules, F.col("rule_code") == F.col("code")).select(*[x.split()[0] for x in RULE_SCHEMA.split(", ")])


def matchers(b: dict[str, Column], t: dict[str, Column]) -> dict[str, Column]:
    """R-1: each matcher over the address's (b) and the road's (t) name, type, rnid and soundex."""
    base, test = b["name"], t["name"]
    bare = lambda c: F.regexp_replace(c, "[ -]", "")
    old = lambda c: F.regexp_replace(c, "OLD ", "")
    single = lambda c: F.when(c.endswith("S"), F.substring(c, F.lit(1), F.length(c) - 1)).otherwise(c)
    parts = lambda c: F.split(c, "[- ]")
    same = F.aggregate(parts(base), F.lit(0), lambda n, x: n + F.size(F.filter(parts(test), lambda y: x == y)))
    return {
        "RoadNameID": b["rnid"] == t["rnid"],
        "RoadNameType": (base == test) & (b["type"] == t["type"]),
        "RoadName": base == test,
        "NoSpace": (base != test) & (bare(base) == bare(test)),
        "OldPrefix": (base.startswith("OLD ") | test.startswith("OLD ")) & (old(base) == old(test)),
        "SSuffix": (base.endswith("S") | test.endswith("S")) & (single(base) == single(test)),
        "StartsWith": base.startswith(F.substring(test, 1, 5)),
        "Partial": same / F.least(F.size(parts(base)), F.size(parts(test))) >= 0.3,
        "Soundex": b["soundex"] == t["soundex"],
        "Named": base != "UNNAMED",
        "None": F.lit(True),
    }


def attribute_match(kind: Column, b: dict[str, Column], t: dict[str, Column]) -> Column:
    """R-1: the matcher that ``kind`` names; others, and nulls, don't match."""
    out = F.lit(False)
    for name, fits in matchers(b, t).items():
        out = F.when(kind == name, F.coalesce(fits, F.lit(False))).otherwise(out)
    return out


def spatial_match(code: Column, nearest: Column, dist: Column, crossed: Column, max_distance: Column, max_intersects: Column) -> Column:
    """R-2: rule F_N always; else nearer than the limit, and few crossings or a rule for the nearest."""
    return (code == "F_N") | ((dist < max_distance) & ((crossed <= max_intersects) | (nearest == "Nearest")))


def weighted_crossings(crossed: DataFrame, first_names: DataFrame | None, key: list[str], within: tuple[str, ...] = ()) -> DataFrame:
    """A-9: (key, crossed): crossings counted as 1, those of nameless roads as 0.4, rounded down. ``within``: columns that the key tells, by which the crossings are dealt, so that they needn't be shuffled. Without ``first_names`` the crossed roads have their road_name with them, so that crossings needn't be shuffled by road."""
    weight = F.when(F.col("road_name").isin(*NAMELESS), 4).otherwise(10)
    rows = crossed if first_names is None else crossed.join(first_names.select(F.col("pfi").alias("cross_pfi"), "road_name"), "cross_pfi", "left")
    return rows.groupBy(*within, *key).agg((F.sum(weight) / 10).cast("int").alias("crossed"), F.count(F.lit(1)).alias("intersects")).drop(*within)


def match_addresses(addresses: DataFrame, segs: DataFrame, aliases: DataFrame, rules: DataFrame, in_locality: DataFrame) -> DataFrame:
    """R-3: one row per address with an attempt: the first rule, in test order, whose road passes both tests.

    Gives the 17 columns of a match, with the connector from the address to the road as ``geometry``.
    ``addresses``: addr_pfi, x, y, name, type, rnid, soundex, locality. ``aliases``: pfi,
    rnid, alias_number, route_flag, name, type, soundex. ``in_locality``: (pfi,
    locality) pairs. ``rules``: a small table (``RULE_SCHEMA``).

    Per rule an address looks at roads without a nameless alias, within the
    rule's distance, that meet the address's locality (not for rule F_N or
    locality UNKNOWN), in rings of 250 m, nearest first. The first road with a
    fitting alias decides the rule, whether or not it passes the spatial test;
    for a 'Nearest' rule each ring is looked at only up to the first road beyond its
    closest. An address that no rule accepts keeps its last attempt: of the last rule that
    found a road, the one that fitted, else the last one tried, with its last alias. Crossings
    are counted where the attributes fit, the side of the road where both tests pass, and
    there a connector shorter than a centimetre is drawn out.

    The rules are taken in tiers: a new one begins where a rule reaches farther than all before it, and only
    the addresses that no rule has accepted go on, so that few meet the roads within the longest distances. Where more roads lie within
    a tier's reach, an address first looks at the nearest parts of its rings, which hold about ``SHARE`` roads, and at four times as many only
    where these don't settle all rules of the tier.
    """
    roads = _roads(segs, aliases)
    best = _in_tiers(addresses, roads, aliases, rules, in_locality, lambda tries: _decided(_judged(addresses, roads, _first_fits(tries))))
    return _finished(_decided(best), addresses, segs)


def all_attempts(addresses: DataFrame, segs: DataFrame, aliases: DataFrame, rules: DataFrame, in_locality: DataFrame) -> DataFrame:
    """R-3: every road that the cascade tries, for review: the columns of a match and ``attempt``, counted from 1 for each address.

    Roads of a rule are tried in rings of 250 m, nearest first, up to and with the first that has a fitting alias;
    rules in their order up to and with the first that accepts a road. The last attempt, or the only one that is
    accepted, is the row of ``match_addresses``, but for an address that no rule accepts: there the row is the one that
    fitted in the last rule that found a road, which is the last of its attempts as well. Takes what ``match_addresses`` takes.
    """
    roads = _roads(segs, aliases)

    def log(tries: DataFrame) -> DataFrame:
        rows = _judged(addresses, roads, _tried(tries))
        accepted = rows.where("valid_spatial").groupBy("addr_pfi").agg(F.min(F.struct("test_order", "code")).alias("stop"))
        return rows.join(accepted, "addr_pfi", "left").where(F.col("stop").isNull() | (F.struct("test_order", "code") <= F.col("stop"))).drop("stop")

    rows = _in_tiers(addresses, roads, aliases, rules, in_locality, log)
    turn = Window.partitionBy("addr_pfi").orderBy("test_order", "code", "ring", "dist", F.col("pfi").cast("string"))
    return _finished(rows.withColumn("attempt", F.row_number().over(turn)), addresses, segs, "attempt")


def _roads(segs: DataFrame, aliases: DataFrame) -> tuple[DataFrame, Row]:
    """Each road as one row, with its first name, and their spread."""
    main = aliases.groupBy("pfi").agg(F.min_by("name", F.concat_ws(",", "rnid", "alias_number", "route_flag")).alias("road_name"))
    rows = checkpoint(line_rows(segs.join(main, "pfi", "left"), also=("road_name",)))
    return rows, spread(rows)


def _in_tiers(addresses: DataFrame, roads: tuple[DataFrame, Row], aliases: DataFrame, rules: DataFrame, in_locality: DataFrame, attempts) -> DataFrame:
    """The rows that ``attempts`` gives for each tier of rules and the addresses that no rule of the tiers before accepted."""
    table = rules.select(*[x.split()[0] for x in RULE_SCHEMA.split(", ")]).orderBy("test_order", "code").limit(MOST_RULES + 1).collect()
    if all(r["max_distance"] is None for r in table) or len(table) > MOST_RULES:  # the rules are broadcast
        raise ValueError(f"1 to {MOST_RULES} rules with a distance are needed")
    nameless = aliases.where(F.col("name").isin(*NAMELESS)).select("pfi").distinct()
    named = checkpoint(roads[0].drop("road_name").join(nameless, "pfi", "left_anti"))
    local = in_locality.select("pfi", "locality", F.lit(True).alias("inside")).distinct()
    of, left, out = spread(named), addresses, None
    for tier, reach in _tiers(table):
        some = addresses.sparkSession.createDataFrame(tier, RULE_SCHEMA)
        found, more = None, left
        for bands in _bands((of["density"], of["length"]), float(reach)):
            tries = _candidates(more, named, aliases, some, local, float(reach), bands, of)
            if bands is not None:
                tries = checkpoint(tries)  # read twice
                unsettled = checkpoint(_unsettled(tries, more, some, bands))
                tries, more = tries.join(unsettled, "addr_pfi", "left_anti"), more.join(unsettled, "addr_pfi", "left_semi")
            part = checkpoint(attempts(tries))
            found = part if found is None else found.union(part)
            if bands is not None and unsettled.isEmpty():
                break
        out = found if out is None else out.union(found)
        left = left.join(found.where("valid_spatial").select("addr_pfi"), "addr_pfi", "left_anti")
    return out


def _finished(rows: DataFrame, addresses: DataFrame, segs: DataFrame, *more: str) -> DataFrame:
    """The columns of a match; an address has at most one row that passes both tests."""
    spot = addresses.select("addr_pfi", F.col("x").alias("x0"), F.col("y").alias("y0"), F.col("rnid").alias("addr_rnid"), F.col("locality").alias("addr_locality_name"), F.col("soundex").alias("addr_soundex"))
    best = checkpoint(rows.join(spot, "addr_pfi"))
    side = sides(best.where("valid_spatial").select("addr_pfi", "pfi", F.col("x0").alias("x"), F.col("y0").alias("y"), "along"), segs, "addr_pfi").select("addr_pfi", "side", F.lit(True).alias("valid_spatial"))
    far = extend_short(*(F.col(c) for c in ("x0", "y0", "nx", "ny")))
    end = [F.when(F.col("valid_spatial"), e).otherwise(F.col(c)) for e, c in zip(far, ("nx", "ny"), strict=True)]
    return best.join(side, ["addr_pfi", "valid_spatial"], "left").select(
        "addr_pfi", *more, F.col("pfi").alias("road_pfi"), F.col("test_order").alias("rule_rank"), F.col("code").alias("rule_code"), F.col("score").alias("rule_score"), "valid_attr", "valid_spatial",
        "addr_rnid", F.col("t_rnid").alias("road_rnid"), "addr_locality_name", F.col("addr_locality_name").alias("road_locality_name"), "addr_soundex", F.col("t_soundex").alias("road_soundex"),
        "intersects", F.coalesce("side", F.lit("")).alias("side_of_road"), F.col("dist").alias("dist_from_road"), F.col("along").alias("dist_along_road"),
        F.format_string("LINESTRING (%.3f %.3f, %.3f %.3f)", "x0", "y0", *end).alias("geometry"), "crossed",
    )


def _tiers(table: list) -> list[tuple[list, int]]:
    """The rules, in order, cut where one reaches farther than all before it: (rules, farthest distance so far)."""
    out, reach = [], None
    for rule in table:
        d = rule["max_distance"]
        if reach is None or (d is not None and d > reach):
            reach = d if d is not None else reach
            out.append(([], reach))
        out[-1][0].append(rule)
    return [(tier, d) for tier, d in out if d is not None]


ATTEMPT = ("test_order", "code", "score", "valid_attr", "valid_spatial", "pfi", "t_rnid", "t_soundex", "dist", "along", "nx", "ny", "intersects", "crossed")


def _decided(rows: DataFrame) -> DataFrame:
    """One attempt per address: the first that is valid, else the last."""
    row = F.struct(*ATTEMPT)
    return rows.groupBy("addr_pfi").agg(F.coalesce(F.min(F.when(F.col("valid_spatial"), row)), F.max(row)).alias("b")).select("addr_pfi", "b.*")


RULE = ("test_order", "code", "score", "match_spatial", "max_intersects", "max_distance")


def _bands(spread: tuple[float, float], reach: float) -> list:
    """For the number of roads per unit of area and their mean length, the distances (from, to) to look at in turn, one for each ring, each time with four times as many roads; at last None, for all.

    Between the distances a and a + d of a road of length l lies an area of 2 l d + pi (2 a d + d d).
    """
    density, length = spread
    out, share = [], SHARE
    while share * 4 <= density * (2 * length * reach + math.pi * reach * reach):
        half = {lo: length + math.pi * lo for lo in range(0, math.ceil(reach), RING)}
        out.append([(float(lo), min(lo + (math.sqrt(b * b + math.pi * share / density) - b) / math.pi, lo + RING, reach)) for lo, b in half.items()])
        share *= 4
    return [*out, None]


def _unsettled(tries: DataFrame, addresses: DataFrame, rules: DataFrame, bands: list[tuple[float, float]]) -> DataFrame:
    """The addresses (addr_pfi) of which a rule isn't settled by the roads within ``bands``.

    A rule is settled by its first ring with a road that fits, if all rings before it are known. A ring is known if the band covers
    all that the rule may look at, and for a 'Nearest' rule also if the band holds a road beyond the closest.
    """
    nearest = F.col("match_spatial") == "Nearest"
    at = lambda r, c: F.when(F.col("ring") == r + 1, F.col(c))
    sums = [f.alias(f"{n}_{r}") for r in range(len(bands)) for n, f in (("fit", F.max(at(r, "fits"))), ("beyond", F.max(at(r, "dist")) > F.min(at(r, "dist"))))]
    seen = tries.groupBy("addr_pfi", "test_order", "code").agg(*sums)
    asked = rules.where("max_distance is not null").select("test_order", "code", "match_spatial", "max_distance")
    rows = addresses.select("addr_pfi").crossJoin(F.broadcast(asked)).join(seen, ["addr_pfi", "test_order", "code"], "left")
    settled = F.lit(True)
    for r, (start, to) in reversed(list(enumerate(bands))):
        known = (F.least(F.lit(start + RING), F.col("max_distance")) <= to) | F.coalesce(nearest & F.col(f"beyond_{r}"), F.lit(False))
        settled = (F.col("max_distance") <= start if r else F.lit(False)) | F.coalesce(F.col(f"fit_{r}"), F.lit(False)) | (known & settled)
    return rows.where(~settled).select("addr_pfi").distinct()


def _candidates(addresses: DataFrame, named: DataFrame, aliases: DataFrame, rules: DataFrame, local: DataFrame, reach: float, bands: list[tuple[float, float]] | None, of: Row) -> DataFrame:
    """The roads that each rule would look at for each address, a row per alias, with ``fits``; no rule reaches beyond ``reach``. ``bands``: only roads of these distances. ``named``: rows of lines, with their spread."""
    near = distance_join(addresses, named, reach, "addr_pfi", bands=bands, of=of).join(addresses.drop("x", "y"), "addr_pfi")
    near = near.join(local, ["pfi", "locality"], "left").withColumn("inside", F.coalesce("inside", F.lit(False)))
    tries = near.join(F.broadcast(rules), F.col("dist") <= F.col("max_distance")).where("inside or code = 'F_N' or locality = 'UNKNOWN'")
    # the ring of a road: rings end at 250, 500, ... and at the rule's distance
    tries = tries.withColumn("ring", F.when(F.col("dist") <= RING, 1).otherwise(F.ceil(F.col("dist") / RING)).cast("int"))
    ring = Window.partitionBy("addr_pfi", "test_order", "ring").orderBy("dist", F.col("pfi").cast("string"))
    tries = tries.withColumns({"closest": F.min("dist").over(ring), "before": F.lag("dist").over(ring)})
    tries = tries.where("match_spatial <> 'Nearest' or match_spatial is null or dist = closest or before = closest")
    road = aliases.select("pfi", *[F.col(c).alias(f"t_{c}") for c in ("rnid", "alias_number", "route_flag", "name", "type", "soundex")])
    fits = attribute_match(F.col("match_attribute"), {c: F.col(c) for c in ("name", "type", "rnid", "soundex")}, {c: F.col(f"t_{c}") for c in ("name", "type", "rnid", "soundex")})
    return tries.join(road, "pfi").withColumns({"fits": F.coalesce(fits, F.lit(False)), "alias_text": F.concat_ws(",", "t_rnid", "t_alias_number", "t_route_flag")})


def _first_fits(candidates: DataFrame) -> DataFrame:
    """Per address and rule the road that decides it: the first that fits, else the last one tried."""
    attempt = F.struct("ring", "dist", F.col("pfi").cast("string").alias("txt"), "alias_text", "pfi", "t_rnid", "t_soundex", "along", "nx", "ny")
    tried = candidates.groupBy("addr_pfi", *RULE).agg(F.min(F.when(F.col("fits"), attempt)).alias("first"), F.max(F.when(~F.col("fits"), attempt)).alias("last"))
    return tried.select("addr_pfi", *RULE, F.col("first").isNotNull().alias("valid_attr"), F.coalesce("first", "last").alias("f")).select("addr_pfi", *RULE, "valid_attr", "f.*")


def _tried(candidates: DataFrame) -> DataFrame:
    """Per address and rule all roads up to the first that fits, each with its first fitting alias, else its last one."""
    road = ["ring", "dist", "pfi", "along", "nx", "ny"]
    alias = F.struct("alias_text", "t_rnid", "t_soundex")
    each = candidates.groupBy("addr_pfi", *RULE, *road).agg(F.min(F.when(F.col("fits"), alias)).alias("first"), F.max(F.when(~F.col("fits"), alias)).alias("last"))
    each = each.select("addr_pfi", *RULE, *road, F.col("first").isNotNull().alias("valid_attr"), F.coalesce("first", "last").alias("f")).select("addr_pfi", *RULE, *road, "valid_attr", "f.*")
    before = Window.partitionBy("addr_pfi", "test_order", "code").orderBy("ring", "dist", F.col("pfi").cast("string")).rowsBetween(Window.unboundedPreceding, -1)
    return each.withColumn("done", F.coalesce(F.max("valid_attr").over(before), F.lit(False))).where("not done").drop("done")


def _judged(addresses: DataFrame, roads: tuple[DataFrame, Row], attempts: DataFrame) -> DataFrame:
    """Attempts with their crossings, counted where the attributes fit, and the spatial test."""
    chosen = checkpoint(attempts)  # read twice
    links = chosen.where("valid_attr").select("addr_pfi", "pfi", "nx", "ny").distinct().join(addresses.select("addr_pfi", "x", "y"), "addr_pfi")
    crossed = weighted_crossings(crossings(links, roads[0], ["addr_pfi", "pfi"], own="pfi", also=("road_name",), of=roads[1]), None, ["addr_pfi", "pfi"])
    crossed = crossed.withColumn("valid_attr", F.lit(True))
    rows = chosen.join(crossed, ["addr_pfi", "pfi", "valid_attr"], "left").withColumns({"crossed": F.coalesce("crossed", F.lit(0)), "intersects": F.coalesce("intersects", F.lit(0))})
    ok = spatial_match(F.col("code"), F.col("match_spatial"), F.col("dist"), F.col("crossed"), F.col("max_distance"), F.col("max_intersects"))
    return rows.withColumn("valid_spatial", F.col("valid_attr") & F.coalesce(ok, F.lit(False)))

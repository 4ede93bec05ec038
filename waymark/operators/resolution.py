"""Exclusions, duplicate addresses and validated ids.

One decision per group is a cascade over windows of the group's rows; no rows
are collected. Groups are addresses with the same key, so they are small; a
null in the key groups with other nulls.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import address_string, apartment, house_number, is_numeric, not_equal_or_null

KEY = ("st_num", "road_name", "road_type", "road_suffix", "locality_name")


#: What the codes of exclusion stand for.
EXCLUSION_TEXT = {
    "CLASS_M": "ADDRESS CLASS IS M", "AR_L50": "ADDRESS ROAD SCORE IS LESS THAN 50", "NO_NUM": "ADDRESS CLASS S HAS NO NUM", "NO_PROPPFI": "ADDRESS HAS NO MATCHING PROPERTY PFI",
    "PREFIX_NOT_NUM": "HOUSE_PREFIX_1 IS NOT A NUMBER", "PAPER": "ADDRESS FEATURE_QUALITY IS PAPER_ROAD_ONLY", "DUPLICATE": "ADDRESS HAS DUPLICATES",
}


def described(excluded: DataFrame, dups: DataFrame | None = None) -> DataFrame:
    """R-4: the excluded addresses with a row for each that has duplicates, and what each code stands for (pfi, rule_code, rule_desc)."""
    rows = excluded if dups is None else excluded.union(dups.select("pfi", F.lit("DUPLICATE")))
    text = F.create_map(*[F.lit(x) for pair in EXCLUSION_TEXT.items() for x in pair])
    return rows.select("pfi", "rule_code", text[F.col("rule_code")].alias("rule_desc"))


def exclusions(addresses: DataFrame, manual: DataFrame | None = None, second_source: bool = False) -> DataFrame:
    """R-4: (pfi, rule_code), one row per rule that excludes an address.

    Input: pfi, address_class, house_number_1, house_prefix_1, view_pfi (of its
    property, or null), feature_quality_id, rule_score. The second source
    knows only AR_L50 and NO_NUM, the latter without the class test.
    """
    single = F.coalesce(F.col("address_class") == "S", F.lit(False))
    tests = {"AR_L50": F.col("rule_score") < 50, "NO_NUM": F.col("house_number_1").isNull() & (F.lit(True) if second_source else single)}
    if not second_source:
        tests |= {
            "CLASS_M": F.col("address_class") == "M",
            "NO_PROPPFI": F.col("view_pfi").isNull(),
            "PREFIX_NOT_NUM": is_numeric(F.col("house_prefix_1")),
            "PAPER": ~not_equal_or_null(F.col("feature_quality_id"), "PAPER_ROAD_ONLY"),
        }
    hits = F.filter(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(code)) for code, t in tests.items()]), lambda c: c.isNotNull())
    out = addresses.select("pfi", F.explode(hits).alias("rule_code"))
    return out if manual is None else out.union(manual.select("pfi", F.lit("REFERENCE").alias("rule_code")))


def duplicates(addresses: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """A-7: the rows whose key occurs at least twice; nulls equal nulls.

    The rows keep their partitions, here and in the windows over the same key: put together to few tasks, each task would sort more the more rows there are.
    """
    n = int(addresses.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return addresses.repartition(n, *key).withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*key))).where("__n > 1").drop("__n")


def _ranking() -> list[Column]:
    down, up = (lambda c: F.col(c).desc_nulls_last()), (lambda c: F.col(c).asc_nulls_last())
    return [down("is_primary"), down("rule_score"), up("dist_from_road"), down("house_number_2"), up("lv_apt"), F.col("pfi").cast("string").desc_nulls_last()]


def resolve_phase_1(dups: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """R-5: (pfi, resolution_pfi, resolution_code) for every member of a duplicate group.

    Input: pfi, key, is_primary, graphic_type, status, lv_apt, rule_score,
    dist_from_road, house_number_2, road_pfi, x, y. The first rule that fits
    decides for the whole group.
    """
    group = Window.partitionBy(*key)
    ranked = group.orderBy(*_ranking()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    test = {
        "primary": F.col("is_primary") == "Y", "base": F.col("graphic_type") == "B", "approved": F.col("status") == "A", "plain": F.col("lv_apt").isNull(),
    }
    count = {k: F.count(F.when(t, 1)).over(group) for k, t in test.items()}
    top = {k: F.first(F.when(t, F.col("pfi")), ignorenulls=True).over(ranked) for k, t in test.items()}
    first = F.first("pfi").over(ranked)
    one = lambda *c: F.min(F.struct(*c)).over(group) == F.max(F.struct(*c)).over(group)  # noqa: E731  a struct keeps nulls as values
    rules = [
        ("IS_PRIMARY", count["primary"] == 1, top["primary"]), ("BASE_PROP", count["base"] == 1, top["base"]), ("APPROVED", count["approved"] == 1, top["approved"]),
        ("BASE_ADD", count["plain"] == 1, top["plain"]), ("SAME_POINT", one("x", "y"), first),
        ("RD_SING_PR", one("road_pfi") & (count["primary"] > 0), top["primary"]), ("RD_SINGANY", one("road_pfi"), first),
    ]
    code, winner = F.lit("UNRESOLVED"), F.lit(None).cast("string")
    for name, fits, pfi in reversed(rules):
        code, winner = F.when(fits, name).otherwise(code), F.when(fits, pfi).otherwise(winner)
    return dups.select("pfi", winner.alias("resolution_pfi"), code.alias("resolution_code"))


def resolve_phase_2(dups: DataFrame, near: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """R-7: (pfi, resolution_pfi, resolution_code, road_pfi) for groups that phase 1 left.

    Input as for phase 1, with house_number_1, road_name_id and the ranges
    left_min, left_max, right_min, right_max and address_type of each row's
    road. ``near``: (pfi of the road, road_name_id, number_min, number_max).
    Comparisons with null are false, but a null differs in parity from any number.
    """
    group = Window.partitionBy(*key)
    ranked = group.orderBy(*_ranking())
    rows = dups.withColumn("__r", F.row_number().over(ranked))
    lead = lambda c: F.first(c).over(group.orderBy("__r").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = rows.withColumns({"__number": lead("house_number_1"), "__rnid": lead("road_name_id")})
    met = near.select(F.col("pfi").alias("road_pfi"), F.col("road_name_id").alias("__rnid"), F.col("number_min").alias("__lo"), F.col("number_max").alias("__hi"))
    rows = rows.join(met, ["road_pfi", "__rnid"], "left")  # one row per road and name
    yes = lambda c: F.coalesce(c, F.lit(False))
    n, typed = F.col("house_number_1"), yes(F.col("address_type") == 0)
    side = {}
    for s in ("left", "right"):
        lo, hi = F.col(f"{s}_min"), F.col(f"{s}_max")
        within = yes(lo <= n) & yes(hi >= n)
        same = yes(lo % 2 == n % 2)
        side[s] = {"in": within, "even": within & same, "null": lo.isNull() & hi.isNull(), "differs": ~same}
    left, right = side["left"], side["right"]
    number, lo, hi = F.col("__number"), F.col("__lo"), F.col("__hi")
    right_only, left_only = left["null"] & right["differs"], right["null"] & left["differs"]
    rules = [
        ("R*_NULL", typed & (left["even"] | right["even"])), ("R*_RNG", left["in"] | right["in"]), ("R*_RNGNEAR", yes(lo <= number) & yes(hi >= number)),
        ("R*_1S_TY", (typed & right_only) | left_only), ("R*_1S", right_only | left_only), ("R*_ALL_NUL", left["null"] & right["null"]),
        ("R*_RNG_OFF", yes(lo <= number + 10) & yes(hi >= number - 10)),
    ]
    rows = rows.withColumns({f"__{i}": fits for i, (_, fits) in enumerate(rules)})
    whole = group.orderBy("__r").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    code, road = F.lit("RANDOM"), F.first("road_pfi").over(whole)
    for i, (name, _) in reversed(list(enumerate(rules))):
        any_ = F.max(F.col(f"__{i}").cast("int")).over(group) == 1
        code = F.when(any_, name).otherwise(code)
        road = F.when(any_, F.first(F.when(F.col(f"__{i}"), F.col("road_pfi")), ignorenulls=True).over(whole)).otherwise(road)
    rows = rows.withColumns({"__code": code, "__road": road})
    winner = F.when(F.col("__code") == "RANDOM", F.first("pfi").over(whole)).otherwise(F.first(F.when(F.col("road_pfi") == F.col("__road"), F.col("pfi")), ignorenulls=True).over(whole))
    return rows.select("pfi", winner.alias("resolution_pfi"), F.col("__code").alias("resolution_code"), F.col("__road").alias("road_pfi"))


def _marked(**marks: DataFrame) -> DataFrame:
    """Each id of the given one-column tables once, with a flag per table that holds it; nulls are one id. One shuffle."""
    rows = None
    for name, ids in marks.items():
        some = ids.select(F.col(ids.columns[0]).alias("pfi"), *[F.lit(name == other).alias(other) for other in marks])
        rows = some if rows is None else rows.union(some)
    return rows.groupBy("pfi").agg(*[F.max(name).alias(name) for name in marks])


def _resolved(phase_1: DataFrame) -> DataFrame:
    return phase_1.where("resolution_code <> 'UNRESOLVED'").select("resolution_pfi")


def validated_phase_1(addresses: DataFrame, excluded: DataFrame, duplicate: DataFrame, resolved: DataFrame) -> DataFrame:
    """R-8, U-3: addresses - ((excluded + duplicate) - phase 1 winners), each id once."""
    ids = _marked(address=addresses.select("pfi"), out=excluded.select("pfi").union(duplicate.select("pfi")), won=_resolved(resolved))
    return ids.where("address and (won or not out)").select("pfi")


def validated_phase_2(addresses: DataFrame, excluded: DataFrame, duplicate: DataFrame, phase_1: DataFrame, phase_2: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """R-8: as phase 1, less the winners of both phases; overrides that are addresses come back."""
    return validated(addresses, excluded, duplicate, phase_1, phase_2, overrides).where("phase = 2").select("pfi")


def validated(addresses: DataFrame, excluded: DataFrame, duplicate: DataFrame, phase_1: DataFrame, phase_2: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """R-8: (phase, pfi) for both phases from one grouping of all ids with flags, each id once a phase."""
    back = addresses.select("pfi").limit(0) if overrides is None else overrides.select("override_pfi").where("override_pfi is not null")
    out = excluded.select("pfi").union(duplicate.select("pfi"))
    ids = _marked(address=addresses.select("pfi"), out=out, won_1=_resolved(phase_1), won_2=phase_1.select("resolution_pfi").union(phase_2.select("resolution_pfi")), back=back)
    phases = F.array(F.when(F.expr("won_1 or not out"), 1), F.when(F.expr("won_2 or back or not out"), 2))
    return ids.where("address").select(F.explode(F.filter(phases, lambda p: p.isNotNull())).alias("phase"), "pfi")


def components(addresses: DataFrame, second_source: bool = False) -> DataFrame:
    """R-10: the composed parts of each address; the second source leaves number prefixes out."""
    p1, p2 = (F.lit(None), F.lit(None)) if second_source else (F.col("house_prefix_1"), F.col("house_prefix_2"))
    st, hi = house_number(p1, F.col("house_number_1"), F.col("house_suffix_1")), house_number(p2, F.col("house_number_2"), F.col("house_suffix_2"))
    return addresses.select(
        "pfi", st.alias("st_num"), hi.alias("hi_num"), apartment(F.col("unit"), F.col("unit_suffix"), F.col("floor")).alias("lv_apt"),
        address_string(F.col("locality_name"), F.col("road_name"), F.col("road_type"), F.col("road_suffix"), st, trailing=True).alias("address_string"),
    )


def code_counts(resolved: DataFrame) -> DataFrame:
    """A-3, A-4: (resolution_code, n_rows, n_winners)."""
    return resolved.groupBy("resolution_code").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("resolution_pfi").alias("n_winners"))

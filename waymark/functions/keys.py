"""Address keys and scalar predicates, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Id of the register entry for roads without a name.
UNNAMED_ID = 1312
#: Sentinels of the range columns (E-7).
NO_MIN, NO_MAX = 99999999, 0


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def house_number(prefix: Column, number: Column, suffix: Column) -> Column:
    """E-1: prefix, number and suffix; null where the number is."""
    return F.concat(text(prefix), number.cast("string"), text(suffix))


def apartment(unit: Column, unit_suffix: Column, floor: Column) -> Column:
    """E-2: unit with suffix, else floor; its first five characters."""
    return F.substring(F.coalesce(F.concat(unit.cast("string"), text(unit_suffix)), floor.cast("string")), 1, 5)


def address_string(locality: Column, road: Column, road_type: Column, road_suffix: Column, number: Column, trailing: bool = False) -> Column:
    """E-3: LOCALITY_ROAD_TYPE_SUFFIX_NUMBER; null where the number is. ``trailing``: the form with a final underscore."""
    parts = [text(locality), text(road), text(road_type), text(road_suffix), number]
    return F.concat(*[x for p in parts for x in (p, F.lit("_"))][: None if trailing else -1])


def yes_no(condition: Column) -> Column:
    """E-4: 'Y' where the condition holds, else 'N'."""
    return F.when(condition, "Y").otherwise("N")


def parity(c: Column) -> Column:
    """E-6: the remainder by two, with the dividend's sign."""
    return c % 2


def near_min(left: Column, right: Column) -> Column:
    """E-7: the left minimum if it is the smaller one, else the right; a null side counts as NO_MIN."""
    return F.when(F.coalesce(left, F.lit(NO_MIN)) < F.coalesce(right, F.lit(NO_MIN)), left).otherwise(right)


def near_max(left: Column, right: Column) -> Column:
    """E-7: the left maximum if it is the larger one, else the right; a null side counts as 0, so 0 beside null gives null."""
    return F.when(F.coalesce(left, F.lit(NO_MAX)) > F.coalesce(right, F.lit(NO_MAX)), left).otherwise(right)


def or_sentinel(c: Column, sentinel: int = -1) -> Column:
    """E-8."""
    return F.coalesce(c, F.lit(sentinel))


def is_numeric(c: Column) -> Column:
    """F-4: whether the text reads as a number (unlike the original, lone signs and currency marks don't)."""
    return F.coalesce(c.try_cast("double").isNotNull(), F.lit(False))


def not_equal_or_null(c: Column, value: str) -> Column:
    """F-2: null counts as different."""
    return F.coalesce(c, F.lit("")) != value


def hundredfold(c: Column) -> Column:
    """E-9: coordinates in hundredths."""
    return c * F.lit(100.0)


def normal_name(c: Column) -> Column:
    """E-12: upper case, single blanks, none at the ends; null counts as empty."""
    return F.upper(F.trim(F.regexp_replace(text(c), r"\s+", " ")))


def road_name_parts(name: Column, road_type: Column, suffix: Column, route_flag: Column | None = None) -> list[Column]:
    """E-12: (road_name, road_type, road_suffix, route_flag), each row by itself."""
    flag = F.coalesce(route_flag, F.lit(0)) if route_flag is not None else F.lit(0)
    return [normal_name(name).alias("road_name"), normal_name(road_type).alias("road_type"), normal_name(suffix).alias("road_suffix"), flag.cast("int").alias("route_flag")]


def route_name_parts(route_no: Column) -> list[Column]:
    """A route number as a road name: type '-', no suffix, flag 1."""
    return [normal_name(route_no).alias("road_name"), F.lit("-").alias("road_type"), F.lit("").alias("road_suffix"), F.lit(1).alias("route_flag")]


def soundex(c: Column) -> Column:
    """E-11: the four-character code of the normal name."""
    return F.soundex(normal_name(c))

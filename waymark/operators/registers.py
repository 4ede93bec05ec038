"""Joins by membership, registers with surrogate ids, and updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .topology import checkpoint


def without(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """J-4: rows of ``df`` without a partner; a null key has none, so its row stays."""
    return df.join(other.select(*on).distinct(), list(on), "left_anti")


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """J-5: SQL's NOT IN, with its three-valued logic, at any size.

    Nothing is left if ``other`` holds a null; a null key passes only where
    ``other`` is empty. Two counts decide that in one row each, so the join
    itself is an ordinary anti join that shuffles by key.
    """
    keys = other.select(F.col(other_column).alias("__k"))
    facts = keys.agg(F.count(F.lit(1)).alias("__n"), F.count("__k").alias("__known"))
    kept = df.where(F.col(column).isNotNull()).join(keys.where("__k is not null").distinct(), F.col(column) == F.col("__k"), "left_anti")
    whole, empty = F.broadcast(facts.where("__n = __known")), F.broadcast(facts.where("__n = 0"))  # one row each at most
    return kept.join(whole).union(df.where(F.col(column).isNull()).join(empty)).drop("__n", "__known")  # rows without a key don't shuffle


def within(df: DataFrame, column: str, *others: DataFrame) -> DataFrame:
    """J-6: rows whose key is in the union of the first columns of ``others``."""
    keys = others[0].select(F.col(others[0].columns[0]).alias("__k"))
    for o in others[1:]:
        keys = keys.union(o.select(F.col(o.columns[0]).alias("__k")))
    return df.join(keys.distinct(), F.col(column) == F.col("__k"), "left_semi")


def dense_ids(df: DataFrame, order: Sequence[str], name: str = "objectid", start: int = 0) -> DataFrame:
    """O-5: ids start + 1, start + 2, ... in the order of unique keys, without one task seeing all rows.

    Rows are dealt out by ranges of the key; each range is numbered by itself
    and shifted by the number of rows in the ranges before it.
    """
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id())
    dealt = checkpoint(dealt)  # the ranges stay as they are if a task is repeated
    count = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = count.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))  # one row per partition
    nth = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return dealt.join(F.broadcast(before), "__part").withColumn(name, (nth + F.col("__before") + start).cast("long")).drop("__part", "__before")


def register(current: DataFrame, batch: DataFrame, key: Sequence[str], id_col: str, null_keys: bool = False, tags: Sequence[str] = ()) -> DataFrame:
    """W-4: the register with the new keys of ``batch`` appended under the next ids.

    Keys are compared null-safely. ``null_keys``: whether keys with a null are
    inserted (the left-join form) or never (the NOT IN form). A batch that was
    registered before adds nothing. Of rows that share a new key one counts. ``tags``: further columns of the
    register, such as the source and its key, which the first row in their order gives.
    """
    fresh = batch.select(*key).distinct() if not tags else batch.groupBy(*key).agg(F.min(F.struct(*tags)).alias("__t")).select(*key, "__t.*")
    if not null_keys:
        fresh = fresh.dropna(subset=list(key))
    c, f = current.alias("c"), fresh.alias("f")
    same = [F.col(f"f.{k}").eqNullSafe(F.col(f"c.{k}")) for k in key]
    new = f.join(c, same, "left_anti")
    last = current.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long")).first()[0]
    return current.select(id_col, *key, *tags).unionByName(dense_ids(new, key, id_col, last).select(id_col, *key, *tags))


def update_from(df: DataFrame, source: DataFrame, on: Sequence[str], columns: Sequence[str], keep: bool = True) -> DataFrame:
    """W-1, W-2: set columns from the matching source row; others keep theirs (``keep``) or get null."""
    s = source.select(*on, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__{c}") for c in columns])
    out = df.join(s, list(on), "left")
    new = {c: F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c) if keep else F.lit(None)) for c in columns}
    return out.withColumns(new).select(*df.columns)


def patch(df: DataFrame, patches: DataFrame, key: str) -> DataFrame:
    """W-3, W-5: values of single rows replaced where the patch row has one. The key columns of patches are unique."""
    columns = [c for c in patches.columns if c != key]
    p = patches.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    return df.join(p, key, "left").withColumns({c: F.coalesce(f"__{c}", c) for c in columns}).select(*df.columns)


def guarded_delete(df: DataFrame, condition: Column, expected: int = 1) -> DataFrame:
    """W-8: without the rows of ``condition``, if exactly ``expected`` of them exist; else unchanged."""
    hits = df.agg(F.count(F.when(condition, 1)).alias("__hits"))
    return df.join(F.broadcast(hits), ~F.coalesce(condition, F.lit(False)) | (F.col("__hits") != expected)).drop("__hits")  # one row


def copy_columns(target: DataFrame, source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """W-7: rows of ``source`` appended under the listed columns; the target's others are null."""
    return target.unionByName(source.select(*columns), allowMissingColumns=True)

"""Exact dedup: tree-merge of sorted digest runs, in DataFrame operations only.

Rows are dealt over ``fan_in ** levels`` runs by a hash of their id. A run
holds one digest record per distinct digest of its rows, sorted by digest; no text leaves the
scan. In round k, runs whose numbers differ only in their k-th digit (base
``fan_in``) exchange records: each keeps the digests whose own k-th digit is
its. Records move by the number of their next run alone, so a task holds whole runs; it sorts
what it got once and merges the ``fan_in`` runs it holds by one streaming
pass that keeps the identifier that stays and the number of rows of equal digests. When runs are first formed
records are combined before they move, so a text that a third of all rows share costs one
record per task and run. After the last round equal digests have met in one run, and
every run holds an equal part of the digests, so no task grows with the whole.
The survivors then walk back down the same rounds, from a run to the ``fan_in``
runs its records came from, so that rows meet their survivor on (run, digest) and
a hot text is spread over all runs instead of one task.

Every record carries the SHA-256, the byte length and a second 64-bit hash of
its text, and runs merge only records that agree in all three.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import cut, partitions

DIGEST = ["text_sha256", "n_bytes", "check64"]
#: So many rounds are made that there are as many runs as shuffle partitions at least.
FAN_IN = 8


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int = 64) -> DataFrame:
    """(id, run, digest columns) of each row; null text counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    raw = text.cast("binary")
    return docs.select(
        F.col(id_col).alias("id"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(runs)).cast("int").alias("run"),
        F.sha2(raw, 256).alias("text_sha256"),
        F.octet_length(raw).alias("n_bytes"),
        F.xxhash64(text).alias("check64"),
    )


def _next_run(k: int, fan_in: int):
    """The run that a record of round k belongs to next: digit k of its run becomes that of its digest."""
    place = fan_in**k
    digit = F.pmod(F.shiftrightunsigned(F.col("check64"), 7 * k % 56), F.lit(fan_in))
    return (F.col("run") + (digit - F.pmod(F.floor(F.col("run") / place), F.lit(fan_in))) * place).cast("int")


def _merged(runs: DataFrame, best, n) -> DataFrame:
    """One record per (run, digest). The struct is merged by a streaming aggregate over sorted runs, as hash tables hold no structs."""
    met = runs.groupBy("run", *DIGEST).agg(best(F.struct("keep_id")).alias("best"), F.sum(n).alias("n"))
    return met.select("run", *DIGEST, F.col("best.keep_id").alias("keep_id"), "n")


def _exchanged(runs: DataFrame, k: int, fan_in: int, best) -> DataFrame:
    """Round k: records go to their next run, keyed by its number alone, are sorted there once, and merge as they stream by."""
    moved = runs.withColumn("run", _next_run(k, fan_in)).repartition("run").sortWithinPartitions("run", *DIGEST)
    return _merged(moved, best, F.col("n"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", fan_in: int = FAN_IN, levels: int | None = None, digest: bool = False) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256): one row per input row.

    Equal texts are those identical without any change. ``keep`` says which
    id of a group stays: "largest" or "smallest". Null text counts as empty,
    and empty texts form one group. Rows repeated with the same id count
    each in ``group_size`` and are marked alike. A null id is never the one
    that stays unless its group has no other. An empty table gives an empty
    result; further columns are ignored. ``levels``: rounds, by default as many as make
    a run for each shuffle partition; ``digest``: with all digest columns.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(keep)
    if levels is None:
        levels = max(1, next(k for k in range(64) if fan_in**k >= partitions(docs.sparkSession)))
    # a null id comes last in either order
    rank = (lambda s: F.max(s)) if keep == "largest" else (lambda s: F.min_by(s, F.struct(s["keep_id"].isNull(), s["keep_id"])))
    rows = cut(digests(docs, id_col, text_col, fan_in**levels))
    up = [cut(_merged(rows.withColumnRenamed("id", "keep_id"), rank, F.lit(1)))]
    for k in range(levels):
        up.append(cut(_exchanged(up[-1], k, fan_in, rank)))
    known = up[-1].withColumnRenamed("n", "group_size")
    for k in reversed(range(levels)):
        down = up[k].select("run", _next_run(k, fan_in).alias("parent"), *DIGEST)
        known = down.join(known.withColumnRenamed("run", "parent"), ["parent", *DIGEST]).drop("parent")
    return rows.join(known, ["run", *DIGEST]).select(
        "id", "keep_id", "group_size", F.coalesce(F.col("id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"), *(DIGEST if digest else DIGEST[:1])
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """One row per text, that of the id that stays, with all its columns.

    Of rows with the same id and text the one whose further columns come first
    stays; they are combined inside each task before any row is shuffled.
    """
    stays = exact_groups(docs, id_col, text_col, keep, digest=True).where("kept")
    stays = stays.select(F.xxhash64("id").alias("__h"), *(F.col(c).alias(f"__{c}") for c in DIGEST), F.col("id").alias("__id")).distinct()
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    others = [F.col(c) for c, kind in docs.dtypes if c not in (id_col, text_col) and "map<" not in kind and kind != "variant"]
    keys = {"__h": F.xxhash64(F.col(id_col)), "__text_sha256": F.sha2(raw, 256), "__n_bytes": F.octet_length(raw), "__check64": F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))}
    once = docs.select(*(v.alias(k) for k, v in keys.items()), F.struct(*docs.columns).alias("__row"), F.struct(F.lit(0), *others).alias("__first"))
    once = once.groupBy(*keys).agg(F.min_by("__row", "__first").alias("__row"))
    met = once.join(stays, list(keys)).where(F.col(f"__row.{id_col}").eqNullSafe(F.col("__id")))
    return met.select("__row.*")

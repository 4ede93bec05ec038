"""Small Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import shutil
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.topology import checkpoint
from ..sources.files import scratch


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once, so that they need no installation of it."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parents[2]
        if not (root / "waymark").is_dir():  # it came as an archive itself
            return
        out = tempfile.mkdtemp(prefix="waymark-")
        spark.sparkContext.addPyFile(shutil.make_archive(f"{out}/waymark", "zip", root, "waymark"))
        _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables, by a path that only Spark needs to understand."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local one only where the session names none and all runs in one process."""
    return scratch(spark)


#: Spark's own setting to remove the shuffle files of an execution when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, narrow: bool = False, free: bool = False, again: bool = False) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in ``spark.checkpoint.dir``.

    ``narrow``: rows much smaller than what they were made from are gathered
    into partitions of the advisory size first, for fewer and larger files.
    ``free``: what was shuffled to make these rows goes as soon as they are
    written; nothing that isn't cut reads it again.
    ``again``: for loops, whose estimates of sizes would multiply.

    Spark removes the files when nothing refers to them any more.
    """
    shared_folder(df.sparkSession)
    if narrow:
        df = df.hint("rebalance")
    if again:
        return checkpoint(df)
    if not free:
        return df.checkpoint(eager=True)
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a plan made under the setting
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files that only lie behind checkpoints.

    Spark removes them once the driver's collectors find that nothing refers to
    them, which may otherwise take as long as the job.
    """
    for _ in range(3):  # what one pass frees lets go of more in the next
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id="doc_id"):
    """crc32 of the id as text, modulo 4, is 2: rows that no model learns from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of an undirected graph given as links (a, b), by alternating stars.

    Large star hangs every neighbour above a node under the least node it
    sees; small star does so for those below. Both keep the components and end
    in one star per component around its smallest node. Minima are combined
    before they are shuffled, joins are plain equi-joins that adaptive
    execution may split, and each round is checkpointed. Nodes without a link
    don't appear.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")

    def star(links: DataFrame, large: bool) -> DataFrame:
        if large:
            sym = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = sym.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
            return sym.join(least, "u").where("v > u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).where("u <> v").distinct()
        down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()

    links, seen = cut(both.distinct()), None
    for _ in range(rounds):
        links = cut(star(star(links, True), False), again=True)
        now = links.agg(F.count("*"), F.expr("coalesce(bit_xor(xxhash64(u, v)), 0)")).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)

"""Sources and sinks at the edge: archives, pipe-separated text, table walks."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import time
import zipfile
from collections.abc import Iterable, Mapping, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as g


def unpack(folder: str, into: str, allowed: Iterable[str]) -> tuple[list[str], set[str]]:
    """S-1: unpack the allowed archives of a folder (names compared without case), keeping the members' times.

    Gives the unpacked files and the allowed archives that weren't there. Members
    that would land outside ``into`` are refused.
    """
    wanted = {a.lower() for a in allowed}
    out, seen, root = [], set(), Path(into).resolve()
    for archive in sorted(Path(folder).iterdir()):
        if archive.name.lower() not in wanted:
            continue
        seen.add(archive.name.lower())
        with zipfile.ZipFile(archive) as z:
            for m in z.infolist():
                target = (root / m.filename).resolve()
                if not target.is_relative_to(root):
                    raise ValueError(f"{archive.name}: {m.filename} lies outside the target")
                if m.is_dir():
                    target.mkdir(parents=True, exist_ok=True)
                    continue
                target.parent.mkdir(parents=True, exist_ok=True)
                with z.open(m) as src, open(target, "wb") as dst:
                    shutil.copyfileobj(src, dst, 1 << 16)
                stamp = time.mktime((*m.date_time, 0, 0, -1))
                os.utime(target, (stamp, stamp))
                out.append(str(target))
    return out, wanted - seen


def require(names: Iterable[str], present: Iterable[str]) -> None:
    """S-5: fail with the names of required files that aren't there."""
    if missing := set(names) - set(present):
        raise FileNotFoundError(", ".join(sorted(missing)))


def read_psv(spark: SparkSession, paths: Sequence[str], schema: str, key: Sequence[str] = ()) -> DataFrame:
    """S-4, S-6: several pipe-separated files with a header line as one table with a declared schema; one row per key, if given."""
    df = spark.read.csv(list(paths), sep="|", header=True, schema=schema, enforceSchema=True)
    return df.dropDuplicates(list(key)) if key else df


def scratch(spark: SparkSession) -> str:
    """A folder that all executors share: the session's ``spark.checkpoint.dir``.

    Where it is unset a local one is made, but only if all runs in one process; a cluster must name one.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="waymark-"))
    return context._jsc.sc().getCheckpointDir().get()


def write_psv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep="|", header=True, emptyValue="", timestampFormat="yyyy-MM-dd HH:mm:ss")


def import_tables(spark: SparkSession, sources: Mapping[str, str], skip: Iterable[str] = (), format: str = "parquet", database: str = "default") -> list[str]:
    """S-2, S-3: save each source (target name to path) as a table, but those to skip or that exist; gives the names saved."""
    left_out, done = {s.lower() for s in skip}, []
    for name, path in sources.items():
        if name.lower() in left_out or spark.catalog.tableExists(f"{database}.{name}"):
            continue
        spark.read.format(format).load(path).write.saveAsTable(f"{database}.{name}")
        done.append(name)
    return done


def scan(df: DataFrame, columns: Sequence[str], where: Column | str | None = None, order: Sequence[str] = ()) -> DataFrame:
    """S-7, F-6: pruned columns, an optional predicate, an optional order; the first two reach the scan."""
    out = df if where is None else df.where(where)
    out = out.select(*columns)
    return out.orderBy(*order) if order else out


def other_database(spark: SparkSession, database: str, table: str) -> DataFrame:
    """S-9: a table of another database, such as last year's."""
    return spark.table(f"{database}.{table}")


def scan_projected(df: DataFrame, x: str, y: str, to: str, **cone) -> DataFrame:
    """S-8: a table with two coordinate columns taken to another system while it is read; other columns stay as they are.

    ``to``: "plane" from degrees of longitude and latitude, "degrees" from the plane, "grid" from the plane to a local grid, "grid_inverse" back. What
    the target needs (parallels and origin, or the grid's origin, turn and scale) comes as further arguments.
    """
    ways = {"plane": g.lambert, "degrees": g.lambert_inverse, "grid": g.local_grid, "grid_inverse": g.local_grid_inverse}
    if to not in ways:
        raise ValueError(f"{to} is none of {', '.join(ways)}")
    return df.withColumns(dict(zip((x, y), ways[to](F.col(x), F.col(y), **cone), strict=True)))


def cluster_table(df: DataFrame, name: str, key: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """W-11: save a table dealt out by its key into sorted buckets, one file each, and read it back.

    Tables with equally many buckets join on the key, and any of them is grouped by it, without moving a row, as often as
    they are read: what a clustered index did for the updates and joins by id.
    """
    writer = df.repartition(buckets, *key).write.mode("overwrite").bucketBy(buckets, *key).sortBy(*key)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def drop_table(spark: SparkSession, name: str, path: str | None = None) -> None:
    """Drop a table and, where it lies in a folder of its own, that folder."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if path:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def report(df: DataFrame, path: str) -> None:
    """W-10: a small report as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def clustered(df: DataFrame, key: Sequence[str], parts: int | None = None) -> DataFrame:
    """W-11: what an index did: rows dealt out by the key and sorted by it within each part."""
    dealt = df.repartition(parts, *key) if parts else df.repartition(*key)
    return dealt.sortWithinPartitions(*key)


def text_prefix(column: str, width: int) -> Column:
    """nvarchar(n): a cast doesn't cut text, this does."""
    return F.substring(column, 1, width).alias(column)

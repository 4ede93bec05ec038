"""Membership joins, registers, updates, files and streams."""

from __future__ import annotations

import zipfile

import pytest
from pyspark.sql import functions as F

from waymark.operators import registers as r
from waymark.operators import roadnames
from waymark.plans import staging
from waymark.sources import files
from waymark.streaming import registers as streaming


def ids(df, column="id"):
    return sorted((x[column] for x in df.collect()), key=lambda v: (v is None, v))


@pytest.fixture
def left(spark):
    return spark.createDataFrame([(1,), (2,), (None,)], "id int")


def test_anti_joins_differ_on_nulls(spark, left):
    some, holed, none = (spark.createDataFrame(x, "k int") for x in ([(1,)], [(1,), (None,)], []))
    assert ids(r.without(left, some.withColumnRenamed("k", "id"), ["id"])) == [2, None]
    assert ids(r.not_in(left, "id", some, "k")) == [2]
    assert ids(r.not_in(left, "id", holed, "k")) == []
    assert ids(r.not_in(left, "id", none, "k")) == [1, 2, None]
    assert ids(r.within(left, "id", some, spark.createDataFrame([(2,), (9,)], "k int"))) == [1, 2]


def test_dense_ids_follow_the_order(spark):
    rows = r.dense_ids(spark.range(0, 1000, 3, 7).select((F.lit(5000) - F.col("id")).alias("k")), ["k"], start=10).orderBy("k").collect()
    assert [x.objectid for x in rows] == list(range(11, 11 + len(rows)))


def test_register_twice_adds_nothing_and_nulls_go_by_form(spark):
    reg = spark.createDataFrame([(7, "A", None)], "rid int, name string, kind string")
    batch = spark.createDataFrame([("A", None), ("B", "x"), ("B", "x"), (None, "y"), ("C", None)], "name string, kind string")
    strict = r.register(reg, batch, ["name", "kind"], "rid")
    assert sorted((x.rid, x.name) for x in strict.collect()) == [(7, "A"), (8, "B")]
    loose = r.register(reg, batch, ["name", "kind"], "rid", null_keys=True)
    assert loose.count() == 4 and r.register(loose, batch, ["name", "kind"], "rid", null_keys=True).count() == 4
    assert r.register(spark.createDataFrame([], reg.schema), batch, ["name"], "rid").count() == 3


def test_updates_patches_and_guarded_deletes(spark):
    t = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id int, v string, n int")
    s = spark.createDataFrame([(1, None)], "id int, v string")
    assert [tuple(x) for x in r.update_from(t, s, ["id"], ["v"]).orderBy("id").collect()] == [(1, None, 5), (2, "b", 6)]
    assert [x.v for x in r.update_from(t, s, ["id"], ["v"], keep=False).orderBy("id").collect()] == [None, None]
    assert [tuple(x) for x in r.patch(t, spark.createDataFrame([(2, None, 9)], t.schema), "id").orderBy("id").collect()] == [(1, "a", 5), (2, "b", 9)]
    assert ids(r.guarded_delete(t, F.col("v") == "a")) == [2] and ids(r.guarded_delete(t, F.col("n") > 0)) == [1, 2] and ids(r.guarded_delete(t, F.col("n") > 9)) == [1, 2]
    assert r.copy_columns(t, t, ["id"]).where("v is null").count() == 2


def test_aliases_keep_the_first_of_equal_names(spark):
    road = spark.createDataFrame([(1, "a", "st", None, " A ", "ST", None, "m1", None), (2, None, None, None, None, None, None, None, "bridge")], "pfi int, n string, t string, s string, n1 string, t1 string, s1 string, route string, structure string")
    triples = [("n", "t", "s"), ("n1", "t1", "s1")]
    names = roadnames.name_triples(road, triples)
    assert [tuple(x) for x in names.collect()] == [("A", "ST", "")]
    reg = spark.createDataFrame([(10, "A", "ST", ""), (11, "M1", "-", ""), (12, "BRIDGE", "", "")], "road_name_id int, road_name string, road_type string, road_suffix string")
    got = sorted(tuple(x) for x in roadnames.road_aliases(road, reg, triples, route="route", structure="structure").collect())
    assert got == [(1, 10, 0, 0), (1, 11, 8, 1), (2, 12, 9, 0)]
    assert [tuple(x) for x in roadnames.name_ids(road, reg, "pfi", ("n", "t", "s")).collect()] == [(1, 10)]
    assert roadnames.name_ids(spark.createDataFrame([(1, "TEMP", None, None)], "pfi int, n string, t string, s string"), reg, "pfi", ("n", "t", "s")).count() == 0


def test_archives(tmp_path):
    with zipfile.ZipFile(tmp_path / "Roads.ZIP", "w") as z:
        z.writestr("a/b.txt", "x")
    with zipfile.ZipFile(tmp_path / "evil.zip", "w") as z:
        z.writestr("../evil.txt", "x")
    got, missing = files.unpack(str(tmp_path), str(tmp_path / "out"), ["roads.zip", "none.zip"])
    assert [g.rsplit("/", 1)[1] for g in got] == ["b.txt"] and missing == {"none.zip"}
    with pytest.raises(ValueError):
        files.unpack(str(tmp_path), str(tmp_path / "out"), ["evil.zip"])
    with pytest.raises(FileNotFoundError, match="b"):
        files.require(["a", "b"], ["a"])


def test_pipe_separated_text(spark, tmp_path):
    for i in (1, 2):
        (tmp_path / f"{i}.psv").write_text(f"pid|lon\n{i}|1.5\n9|2.5\n")
    df = files.read_psv(spark, [str(tmp_path / "1.psv"), str(tmp_path / "2.psv")], "pid string, lon double", key=["pid"])
    assert sorted((x.pid, x.lon) for x in df.collect()) == [("1", 1.5), ("2", 1.5), ("9", 2.5)]
    files.report(df.groupBy().count(), str(tmp_path / "report"))
    assert spark.read.csv(str(tmp_path / "report"), header=True).first()[0] == "3"


def test_table_walk_skips_what_is_there(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    where = {"walk_one": str(tmp_path / "t"), "walk_two": str(tmp_path / "t")}
    assert files.import_tables(spark, where, skip=["WALK_TWO"]) == ["walk_one"]
    assert files.import_tables(spark, where) == ["walk_two"] and files.other_database(spark, "default", "walk_one").count() == 3
    assert files.scan(spark.table("walk_one"), ["id"], "id > 0", ["id"]).first().id == 1
    assert files.clustered(spark.table("walk_one"), ["id"], 2).count() == 3
    assert spark.createDataFrame([("abcdef",)], "s string").select(files.text_prefix("s", 3)).first().s == "abc"


def test_staging(spark):
    assert staging.empty_table(spark, "a int, b string").dtypes == [("a", "int"), ("b", "string")]
    out = staging.remap(spark.range(1), {"x": (F.col("id"), "string"), "y": (None, "timestamp")})
    assert out.dtypes == [("x", "string"), ("y", "timestamp")] and tuple(out.first()) == ("0", None)


def test_a_stream_feeds_a_register(spark, tmp_path):
    schema, folder = "rid long, name string", str(tmp_path / "register")
    source = tmp_path / "in"
    for names in (["b", "a"], ["a", "c", None]):
        spark.createDataFrame([(n,) for n in names], "name string").coalesce(1).write.mode("append").parquet(str(source))
        q = streaming.register_stream(spark.readStream.schema("name string").parquet(str(source)), folder, str(tmp_path / "cp"), ["name"], "rid", schema)
        q.awaitTermination(120)
    got = {x.name: x.rid for x in streaming.read_register(spark, folder, schema).collect()}
    assert got == {"a": 1, "b": 2, "c": 3}
    assert streaming.read_register(spark, str(tmp_path / "nothing"), schema).count() == 0


def test_windowed_counts_agree_on_stream_and_table(spark, sf_dir, tmp_path):
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    want = {(x.window_start, x.event_type): x.n_events for x in streaming.windowed_counts(table).collect()}
    (tmp_path / "events").mkdir()
    table.coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "events" / "t"))
    stream = spark.readStream.schema(table.schema).parquet(str(tmp_path / "events" / "t"))
    q = streaming.windowed_counts(stream).writeStream.outputMode("complete").format("memory").queryName("wc").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(x.window_start, x.event_type): x.n_events for x in spark.table("wc").collect()} == want

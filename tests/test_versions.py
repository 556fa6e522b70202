"""Versioned tables: results as the whole-table operators', writes only where something changes."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from govlake.operators import merge as M
from govlake.operators import versions as V
from govlake.operators.flatten import anonymise

D = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
NOW = "2024-02-01 00:00:00"


def days(spark, values):
    return spark.createDataFrame([(i, d, f"u{i}") for i, d in values], "id int, d date, user string")


def written(table, version):
    """Partition folders of the newest write, from the disk."""
    names = {w for ws in table.state(version)["parts"].values() for w in ws}
    before = {w for ws in table.state(version - 1)["parts"].values() for w in ws} if version > 1 else set()
    return {p for n in names - before for p in os.listdir(f"{table.base}/data/_write={n}") if "=" in p}


def test_replace_since_writes_the_touched_days(spark, tmp_path):
    t = V.Versions(spark, str(tmp_path), "d")
    first = days(spark, [(n, D(n)) for n in range(10)] + [(100, None)])
    assert t.read() is None and t.commit(first) == 1
    new = days(spark, [(200 + n, D(n)) for n in range(8, 12)] + [(300, None)])
    v = V.replace_since(t, new)
    assert rows(t.read()) == rows(M.replace_since(first, new, "d"))
    assert written(t, v) == {f"d={D(n)}" for n in range(8, 12)} == t.changed(v)
    assert rows(t.read(version=1)) == rows(first)  # earlier versions are still there


def test_replace_since_empty_feed_and_late_feed(spark, tmp_path):
    t = V.Versions(spark, str(tmp_path), "d")
    first = days(spark, [(1, D(1)), (2, D(5)), (3, None)])
    t.commit(first)
    for nothing in (first.limit(0), days(spark, [(9, None)])):
        assert V.replace_since(t, nothing) == 1 and rows(M.replace_since(first, nothing, "d")) == rows(first)
    gap = days(spark, [(7, D(9))])  # later than the newest day: the cut is the newest day, which goes
    V.replace_since(t, gap)
    assert rows(t.read(), ["id"]) == [(1,), (3,), (7,)]
    assert rows(t.read()) == rows(M.replace_since(first, gap, "d"))
    empty = V.Versions(spark, f"{tmp_path}/e", "d")
    empty.commit(first.limit(0))
    V.replace_since(empty, gap)
    assert rows(empty.read(), ["id"]) == [(7,)]


def test_replace_since_random_feeds(spark, tmp_path):
    rnd = random.Random(4)
    t, whole = V.Versions(spark, str(tmp_path), "d"), days(spark, [(n, D(n % 6)) for n in range(12)])
    t.commit(whole)
    for k in range(4):
        start = rnd.randint(0, 9)
        feed = days(spark, [(100 * k + n, rnd.choice([None, D(start + n)])) for n in range(rnd.randint(0, 4))])
        whole = M.replace_since(whole, feed, "d")
        V.replace_since(t, feed)
        assert rows(t.read()) == rows(whole)


def test_snapshot_day(spark, tmp_path):
    t = V.Versions(spark, str(tmp_path), "Snapshot_Date")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    odd = M.snapshot_daily(None, df, ["id"], "2023-12-31").withColumn("Snapshot_Date", F.lit(None).cast("date"))
    t.commit(odd)
    for day in ("2024-01-01", "2024-01-02"):
        V.snapshot_day(t, df, ["id"], day)
    v = V.snapshot_day(t, df.withColumn("v", F.lit(7)), ["id"], "2024-01-02")
    whole = M.snapshot_daily(odd, df, ["id"], "2024-01-01")
    whole = M.snapshot_daily(M.snapshot_daily(whole, df, ["id"], "2024-01-02"), df.withColumn("v", F.lit(7)), ["id"], "2024-01-02")
    assert rows(t.read(), whole.columns) == rows(whole) and len(rows(whole)) == 6
    assert written(t, v) == {"Snapshot_Date=2024-01-02"}


def test_anonymise_days(spark, tmp_path):
    t = V.Versions(spark, str(tmp_path), "d")
    whole = days(spark, [(n, D(n)) for n in range(10)] + [(99, None)])
    t.commit(whole)
    v = V.anonymise_days(t, ["user"], 3, D(8))
    assert written(t, v) == {f"d={D(n)}" for n in range(5)}
    assert V.anonymise_days(t, ["user"], 3, D(8)) == v  # nothing has aged since
    v = V.anonymise_days(t, ["user"], 3, D(9))
    assert written(t, v) == {f"d={D(5)}"}
    whole = anonymise(anonymise(whole, ["user"], "d", 3, D(8)), ["user"], "d", 3, D(9))
    assert rows(t.read(), ["id", "d", "user"]) == rows(whole, ["id", "d", "user"])
    V.replace_since(t, days(spark, [(50, D(2))]))  # a day loaded anew is due again
    v = V.anonymise_days(t, ["user"], 3, D(9))
    assert written(t, v) == {f"d={D(2)}"} and len(t.read().where("id = 50").first().user) == 32


def test_append_stamped(spark, tmp_path):
    t = V.Versions(spark, str(tmp_path), "TransferDate")
    df = spark.createDataFrame([("a", 1)], "id string, v int")
    V.append_stamped(t, df, "2024-01-01 06:00:00")
    v = V.append_stamped(t, df.withColumn("w", F.lit("new")), "2024-01-01 18:00:00")
    whole = M.append_stamped(M.append_stamped(None, df, "2024-01-01 06:00:00"), df.withColumn("w", F.lit("new")), "2024-01-01 18:00:00")
    assert rows(t.read(), whole.columns) == rows(whole)
    assert len(t.state()["parts"]["TransferDate=2024-01-01"]) == 2 and written(t, v) == {"TransferDate=2024-01-01"}


def test_merges_on_buckets_equal_the_whole_table_merges(spark, tmp_path):
    t = V.Buckets(spark, str(tmp_path), ["k"], 16)
    whole = spark.createDataFrame([(f"k{n}", n, "old") for n in range(60)], "k string, v int, w string")
    V.upsert(t, whole)
    steps = [
        (lambda s: V.upsert(t, s), lambda w, s: M.upsert(w, s, ["k"]), [("k3", -3, 1.5), ("new", 1, 2.5)], "k string, v int, z double"),
        (lambda s: V.upsert(t, s, ["v"]), lambda w, s: M.upsert(w, s, ["k"], ["v"]), [("k4", -4, "new"), ("more", 2, "new")], "k string, v int, w string"),
        (lambda s: V.insert_new(t, s), lambda w, s: M.insert_new(w, s, ["k"]), [("k5", 0, "x"), ("most", 0, "x")], "k string, v int, w string"),
        (lambda s: V.update_from(t, s, ["dom"]), lambda w, s: M.update_from(w, s, ["k"], ["dom"]), [("k6", "D"), ("none", "D")], "k string, dom string"),
    ]
    for merge, same, values, schema in steps:
        source = spark.createDataFrame(values, schema)
        hit = set(t.touched(t.keyed(source)))
        v = merge(source)
        whole = same(whole, source)
        assert rows(t.rows(), whole.columns) == rows(whole) and set(t.rows().columns) == set(whole.columns)
        assert written(t, v) <= hit and t.changed(v) <= hit and len(hit) <= 2
    source = spark.createDataFrame([(f"k{n}", n, "kept") for n in range(30)], "k string, v int, w string")
    for day in (NOW, "2024-02-02 00:00:00"):
        v = V.upsert_soft_delete(t, source, day)
        whole = M.upsert_soft_delete(whole, source, ["k"], day)
        assert rows(t.rows(), whole.columns) == rows(whole)


def test_soft_delete_leaves_buckets_of_deleted_rows(spark, tmp_path):
    t = V.Buckets(spark, str(tmp_path), ["k"], 8)
    V.upsert_soft_delete(t, spark.createDataFrame([(n,) for n in range(40)], "k int"), NOW)
    only = spark.createDataFrame([(1,)], "k int")
    V.upsert_soft_delete(t, only, NOW)
    v = V.upsert_soft_delete(t, only, "2024-02-02 00:00:00")
    assert written(t, v) == set(t.touched(t.keyed(only))) and t.rows().where("is_deleted").count() == 39


def test_only_touched_buckets_are_read(spark, tmp_path):
    t = V.Buckets(spark, str(tmp_path), ["k"], 32)
    V.upsert(t, spark.range(500).select(F.col("id").alias("k"), F.lit(0).alias("v")))
    source = spark.createDataFrame([(7, 1)], "k long, v int")
    files = t.read(t.touched(t.keyed(source))).inputFiles()
    assert files and {f.split("_bucket=")[1].split("/")[0] for f in files} == {t.touched(t.keyed(source))[0].split("=")[1]}
    # an int key finds the bucket of the long one
    assert t.touched(t.keyed(spark.createDataFrame([(7,)], "k int"))) == t.touched(t.keyed(source))


def test_nulls_duplicates_types_and_layout(spark, tmp_path):
    t = V.Buckets(spark, str(tmp_path), ["k"], 4)
    V.upsert(t, spark.createDataFrame([("a", 1), (None, 2)], "k string, v int"))
    V.upsert(t, spark.createDataFrame([(None, 3)], "k string, v int"))  # a null key matches nothing
    assert rows(t.rows(), ["k", "v"]) == rows(spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "k string, v int"))
    before = t.state()["version"]
    with pytest.raises(Exception, match="duplicate source key"):
        V.upsert(t, spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int"))
    with pytest.raises(ValueError, match="column v"):
        V.upsert(t, spark.createDataFrame([("a", "x")], "k string, v string"))
    with pytest.raises(ValueError, match="lies by"):
        V.Buckets(spark, str(tmp_path), ["k"], 8).read()
    assert t.state()["version"] == before and t.rows().count() == 3


def test_epoch_marks_and_clean(spark, tmp_path):
    t = V.Buckets(spark, str(tmp_path), ["k"], 4)
    a, b = (spark.createDataFrame([(1, n)], "k int, v int") for n in (1, 2))
    V.upsert(t, a, mark=("s", 0))
    v = V.upsert(t, b, mark=("s", 1))
    assert V.upsert(t, b, mark=("s", 1)) == v and V.upsert(t, a, mark=("other", 1)) == v + 1
    assert t.state()["marks"] == {"s": 1, "other": 1}
    gone = t.clean()
    assert t.numbers() == [v + 1] and len([n for n in gone if n.startswith("_write")]) >= 2 and rows(t.rows(), ["k", "v"]) == [(1, 1)]

"""Incremental upserts through Structured Streaming micro-batches."""

import json
import os

from conftest import rows
from govlake.streaming import incremental as S


def test_upsert_stream_matches_batch(spark, tmp_path):
    landing = f"{tmp_path}/landing"
    os.makedirs(landing)
    feeds = [[{"id": "a", "v": 1}, {"id": "b", "v": 2}], [{"id": "a", "v": 10}, {"id": "c", "v": 3}]]
    for i, recs in enumerate(feeds):
        with open(f"{landing}/{i}.json", "w") as f:
            json.dump({"value": recs}, f)
        os.utime(f"{landing}/{i}.json", (1_700_000_000 + i * 100, 1_700_000_000 + i * 100))  # arrival order
    schema = "value array<struct<id:string,v:bigint>>"
    from pyspark.sql.types import _parse_datatype_string
    q = S.upsert_stream(spark, landing, _parse_datatype_string(schema), "value", f"{tmp_path}/gold", ["id"],
                        f"{tmp_path}/ckpt")
    q.awaitTermination(120)
    cur = S.read_current(spark, f"{tmp_path}/gold")
    assert rows(cur, ["id", "v"]) == [("a", 10), ("b", 2), ("c", 3)]
    assert S.committed_versions(spark, f"{tmp_path}/gold") == [1, 2]


def test_replayed_epoch_rewrites_same_version(spark, tmp_path):
    from govlake.operators import merge as M
    base = f"{tmp_path}/gold"
    fn = S.merge_batch_fn(base, lambda cur, b: b if cur is None else M.upsert(cur, b, ["id"]))
    b1 = spark.createDataFrame([("a", 1)], "id string, v int")
    b2 = spark.createDataFrame([("a", 2), ("b", 3)], "id string, v int")
    fn(b1, 0)
    fn(b2, 1)
    fn(b2, 1)  # the same epoch replayed after a failure: rebuilt from version 1, not from itself
    assert S.committed_versions(spark, base) == [1, 2]
    assert rows(S.read_current(spark, base), ["id", "v"]) == [("a", 2), ("b", 3)]


def test_fresh_checkpoint_goes_on_after_the_committed_versions(spark, tmp_path):
    from govlake.operators import merge as M
    base = f"{tmp_path}/gold"
    merge = lambda cur, b: b if cur is None else M.upsert(cur, b, ["id"])
    row = lambda k, v: spark.createDataFrame([(k, v)], "id string, v int")
    for epoch, k in enumerate("abc"):
        S.merge_batch_fn(base, merge, stream="first")(row(k, 1), epoch)
    S.merge_batch_fn(base, merge, stream="second")(row("d", 2), 0)  # restarts at epoch 0
    assert S.committed_versions(spark, base) == [1, 2, 3, 4]
    assert rows(S.read_current(spark, base), ["id", "v"]) == [("a", 1), ("b", 1), ("c", 1), ("d", 2)]


def test_replace_since_stream(spark, tmp_path):
    landing = f"{tmp_path}/landing"
    os.makedirs(landing)
    feeds = [[{"Id": "1", "d": "2024-01-01", "v": 1}, {"Id": "2", "d": "2024-01-05", "v": 2}],
             [{"Id": "3", "d": "2024-01-05", "v": 30}, {"Id": "4", "d": "2024-01-06", "v": 40}]]
    for i, recs in enumerate(feeds):
        with open(f"{landing}/{i}.json", "w") as f:
            json.dump({"activityEventEntities": recs}, f)
        os.utime(f"{landing}/{i}.json", (1_700_000_000 + i * 100, 1_700_000_000 + i * 100))
    from pyspark.sql import functions as F
    from pyspark.sql.types import _parse_datatype_string
    schema = _parse_datatype_string("activityEventEntities array<struct<Id:string,d:string,v:bigint>>")
    q = S.replace_since_stream(spark, landing, schema, "activityEventEntities", f"{tmp_path}/gold", "d",
                               f"{tmp_path}/ckpt", prepare=lambda df: df.withColumn("d", F.to_date("d")))
    q.awaitTermination(120)
    cur = S.read_current(spark, f"{tmp_path}/gold")
    assert rows(cur, ["Id", "v"]) == [("1", 1), ("3", 30), ("4", 40)]


def test_replace_since_stream_partitioned_by_date(spark, tmp_path):
    landing = f"{tmp_path}/landing"
    os.makedirs(landing)
    feeds = [[{"Id": "1", "d": "2024-01-01", "v": 1}, {"Id": "2", "d": "2024-01-05", "v": 2}],
             [{"Id": "3", "d": "2024-01-05", "v": 30}, {"Id": "4", "d": "2024-01-06", "v": 40}]]
    for i, recs in enumerate(feeds):
        with open(f"{landing}/{i}.json", "w") as f:
            json.dump({"activityEventEntities": recs}, f)
        os.utime(f"{landing}/{i}.json", (1_700_000_000 + i * 100, 1_700_000_000 + i * 100))
    from pyspark.sql import functions as F
    from pyspark.sql.types import _parse_datatype_string
    schema = _parse_datatype_string("activityEventEntities array<struct<Id:string,d:string,v:bigint>>")
    q = S.replace_since_stream(spark, landing, schema, "activityEventEntities", f"{tmp_path}/gold", "d",
                               f"{tmp_path}/ckpt", partition_by_date=True)
    q.awaitTermination(120)
    cur = S.read_current(spark, f"{tmp_path}/gold")
    assert rows(cur, ["Id", "v"]) == [("1", 1), ("3", 30), ("4", 40)]
    assert sorted(p for p in os.listdir(f"{tmp_path}/gold/v00000002") if p.startswith("d=")) == \
        ["d=2024-01-01", "d=2024-01-05", "d=2024-01-06"]
    plan = cur.filter(F.col("d") >= "2024-01-05")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan


def test_versioned_stream_writes_touched_buckets_and_days(spark, tmp_path):
    from pyspark.sql import functions as F
    from pyspark.sql.types import _parse_datatype_string

    from govlake.operators import versions as V
    landing = f"{tmp_path}/landing"
    os.makedirs(landing)
    feeds = [[{"id": f"k{n}", "d": f"2024-01-0{n}"} for n in range(1, 9)], [{"id": "k3", "d": "2024-01-08"}, {"id": "new", "d": "2024-01-09"}]]
    for i, recs in enumerate(feeds):
        with open(f"{landing}/{i}.json", "w") as f:
            json.dump({"value": recs}, f)
        os.utime(f"{landing}/{i}.json", (1_700_000_000 + i * 100, 1_700_000_000 + i * 100))
    schema = _parse_datatype_string("value array<struct<id:string,d:string>>")
    keyed, daily = V.Buckets(spark, f"{tmp_path}/keyed", ["id"], 16), V.Versions(spark, f"{tmp_path}/daily", "d")
    calls = []

    def both(batch, mark):
        calls.append((batch.count(), mark))
        V.upsert(keyed, batch, mark=mark)
        return V.replace_since(daily, batch, mark=mark)

    for _ in range(2):  # started again from its checkpoint: nothing new
        q = S.versioned_stream(spark, landing, schema, "value", both, f"{tmp_path}/ckpt", lambda df: df.withColumn("d", F.to_date("d")))
        q.awaitTermination(120)
    assert [n for n, _ in calls] == [8, 2] and keyed.numbers() == daily.numbers() == [1, 2]
    assert len(rows(keyed.rows())) == 9 and rows(daily.read().where("d >= '2024-01-08'"), ["id"]) == [("k3",), ("new",)]
    assert daily.changed(2) == {"d=2024-01-08", "d=2024-01-09"} and len(keyed.changed(2)) <= 2
    batch = spark.createDataFrame([("x", None)], "id string, d date")
    assert both(batch, calls[-1][1]) == 2 and keyed.numbers() == [1, 2]  # the epoch is in the tables

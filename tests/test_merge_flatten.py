"""Merges (with their invariants) and flattening operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from govlake.operators import flatten as P
from govlake.operators import merge as M

NOW = "2024-02-01 00:00:00"
T_NOW = dt.datetime(2024, 2, 1)


def test_replace_since(spark):
    ex = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 5)), (3, dt.date(2024, 1, 9))],
                               "id int, d date")
    new = spark.createDataFrame([(20, dt.date(2024, 1, 5)), (40, dt.date(2024, 1, 12))], "id int, d date")
    assert rows(M.replace_since(ex, new, "d"), ["id"]) == [(1,), (20,), (40,)]
    # new data older than the existing max: cut = min new date
    new2 = spark.createDataFrame([(9, dt.date(2023, 12, 31))], "id int, d date")
    assert rows(M.replace_since(ex, new2, "d"), ["id"]) == [(9,)]
    # empty existing table: everything new is kept
    assert rows(M.replace_since(ex.limit(0), new, "d"), ["id"]) == [(20,), (40,)]


def test_upsert_soft_delete(spark):
    t = spark.createDataFrame([("a", 1, dt.datetime(2024, 1, 1), False), ("b", 2, dt.datetime(2024, 1, 1), False),
                               ("c", 3, dt.datetime(2024, 1, 1), True)],
                              "id string, v int, modified_at timestamp, is_deleted boolean")
    s = spark.createDataFrame([("a", 10), ("d", 40)], "id string, v int")
    out = {r["id"]: r for r in M.upsert_soft_delete(t, s, ["id"], now=NOW).collect()}
    assert (out["a"]["v"], out["a"]["is_deleted"], out["a"]["modified_at"]) == (10, False, T_NOW)
    assert (out["b"]["v"], out["b"]["is_deleted"], out["b"]["modified_at"]) == (2, True, T_NOW)
    assert (out["c"]["is_deleted"], out["c"]["modified_at"]) == (True, dt.datetime(2024, 1, 1))
    assert (out["d"]["v"], out["d"]["is_deleted"]) == (40, False)


def test_upsert_idempotent_and_update_cols(spark):
    t = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "id string, v int, w string")
    s = spark.createDataFrame([("a", 10, 5.0), ("c", 30, 6.0)], "id string, v int, z double")
    once = M.upsert(t, s, ["id"])
    twice = M.upsert(once, s, ["id"])
    assert rows(once) == rows(twice)
    assert rows(once, ["id", "v", "w", "z"]) == [("a", 10, "x", 5.0), ("b", 2, "y", None), ("c", 30, None, 6.0)]
    part = M.upsert(t, s, ["id"], update_cols=["v"])
    assert rows(part, ["id", "v", "z"]) == [("a", 10, None), ("b", 2, None), ("c", 30, 6.0)]


def test_upsert_rejects_duplicate_source_keys(spark):
    t = spark.createDataFrame([("a", 1)], "id string, v int")
    s = spark.createDataFrame([("a", 1), ("a", 2)], "id string, v int")
    with pytest.raises(Exception):
        M.upsert(t, s, ["id"]).collect()


def test_insert_update_stamp_snapshot(spark):
    t = spark.createDataFrame([("a", 1)], "id string, v int")
    s = spark.createDataFrame([("a", 9), ("b", 2)], "id string, v int")
    assert rows(M.insert_new(t, s, ["id"])) == [("a", 1), ("b", 2)]
    u = M.update_from(t.withColumn("x", F.lit(0)), spark.createDataFrame([("a", "D1")], "id string, Dom string"),
                      ["id"], ["Dom"])
    assert rows(u, ["id", "Dom"]) == [("a", "D1")]
    st = M.append_stamped(None, t, NOW)
    assert st.first()["TransferDate"] == dt.date(2024, 2, 1)
    h = M.snapshot_daily(None, t, ["id"], "2024-01-01")
    h = M.snapshot_daily(h, t, ["id"], "2024-01-02")
    again = M.snapshot_daily(h, t.withColumn("v", F.lit(5)), ["id"], "2024-01-02")
    assert rows(again, ["Snapshot_Date", "Snapshot_id", "v"]) == [
        (dt.date(2024, 1, 1), "2024-01-01_a", 1), (dt.date(2024, 1, 2), "2024-01-02_a", 5)]
    # re-running the same day twice equals running it once
    assert rows(M.snapshot_daily(again, t.withColumn("v", F.lit(5)), ["id"], "2024-01-02")) == rows(again)


def test_commit_version(spark, tmp_path):
    p = M.commit_version(spark.range(3), str(tmp_path), 1)
    assert spark.read.parquet(p).count() == 3
    with pytest.raises(Exception):
        M.commit_version(spark.range(3), str(tmp_path), 1)


def test_stringify_upper_project_promote(spark):
    df = spark.createDataFrame([("ab", {"x": 1}, [1, 2], dt.datetime(2024, 1, 1), {"u": {"p": "me"}})],
                               "id string, m map<string,int>, a array<int>, t timestamp, c struct<u:struct<p:string>>")
    s = P.stringify_complex(df)
    assert dict(s.dtypes) == {"id": "string", "m": "string", "a": "string", "t": "string", "c": "string"}
    assert P.upper_keys(df, ["id", "missing"]).first()["id"] == "AB"
    pr = P.project(df, {"id": "Id", "description": "Description", "c.u.p": "P"}, {"Description": ""})
    assert pr.first().asDict() == {"Id": "ab", "Description": "", "P": "me"}
    pm = P.promote(df, "c", ["u.p"], "creator_")
    assert "c" not in pm.columns and pm.first()["creator_p"] == "me"


def test_child_table_and_dedupe(spark):
    df = spark.createDataFrame([("w1", [{"id": "a", "s": {"k": 1}}, {"id": None, "s": {"k": 2}}]), ("w2", None)],
                               "id string, items array<struct<id:string,s:struct<k:int>>>")
    ct = P.child_table(df, "id", "items", rename_id="ItemId", parent_alias="WorkspaceId")
    assert ct.columns == ["WorkspaceId", "ItemId", "s.k"]
    assert rows(ct, ["WorkspaceId", "ItemId"]) == [("w1", "a")]
    assert P.child_table(df, "id", "absent").count() == 0
    d = spark.createDataFrame([("k", 2, "b"), ("k", 1, "z"), ("j", 5, "a")], "k string, o int, v string")
    assert rows(P.dedupe(d, ["k"], order=["o"]), ["k", "v"]) == [("j", "a"), ("k", "z")]
    assert rows(P.dedupe(d, ["k"], order=["o"], desc=True), ["k", "v"]) == [("j", "a"), ("k", "b")]
    assert rows(P.dedupe(d, ["k"]), ["k", "o"]) == [("j", 5), ("k", 1)]


def test_sentinels_connection_anonymise(spark):
    df = spark.createDataFrame([("00000000-0000-0000-0000-000000000000", "2024-01-01"), ("x", "0001-01-01T00:00"),
                                ("y", "2024-01-02"), (None, "2024-01-03")], "id string, e string")
    assert rows(P.drop_sentinels(df, id_col="id", end_col="e"), ["id"]) == [("y",)]
    ds = spark.createDataFrame([
        ("Extension", "Databricks", None, '{"host":"h.net","httpPath":"\\/sql\\/1"}', None),
        ("Sql", None, "srv", None, "db")],
        "DatasourceType string, `connectionDetails.extensionDataSourceKind` string, `connectionDetails.server` string, "
        "`connectionDetails.path` string, `connectionDetails.database` string")
    out = rows(P.connection_string(ds), ["DatasourceKind", "ConnectionString"])
    assert out == [("Databricks", "h.net /sql/1"), ("Sql", "srv db")]
    a = spark.createDataFrame([("u", dt.date(2024, 1, 1)), ("v", dt.date(2024, 1, 30))], "u string, d date")
    once = P.anonymise(a, ["u"], "d", after_days=10, today="2024-01-30")
    twice = P.anonymise(once, ["u"], "d", after_days=10, today="2024-01-30")
    assert rows(once) == rows(twice)
    import hashlib
    assert rows(once, ["u"]) == sorted([(hashlib.md5(b"u").hexdigest(),), ("v",)])


def test_extract_all_rows_and_decode_enum(spark):
    df = spark.createDataFrame([(1, "'T'[a] and 'U'[b]"), (2, "none")], "id int, t string")
    assert rows(P.extract_all_rows(df, "t", r"('.*?'\[.*?\])"), ["id", "match"]) == [(1, "'T'[a]"), (1, "'U'[b]")]
    e = spark.createDataFrame([(0, "Import")], "Enum int, Name string")
    d = P.decode_enum(spark.createDataFrame([(0,), (7,)], "c int"), "c", e, "mode")
    assert rows(d, ["mode"]) == [("7",), ("Import",)]


def test_merge_null_and_repeated_source_keys(spark):
    import pytest
    t = spark.createDataFrame([("a", 1), (None, 2)], "id string, v int")
    nulls = spark.createDataFrame([(None, 7), (None, 8), ("a", 9)], "id string, v int")
    # null keys match nothing: the target's stays, the source's are inserted
    assert rows(M.upsert(t, nulls, ["id"])) == sorted([("a", 9), (None, 2), (None, 7), (None, 8)], key=repr)
    assert M.upsert_soft_delete(t, nulls, ["id"], now=NOW).count() == 4
    assert rows(M.update_from(t, nulls, ["id"], ["v"])) == sorted([("a", 9), (None, 2)], key=repr)
    twice = spark.createDataFrame([("a", 1), ("a", 2)], "id string, v int")
    for fn in (lambda: M.upsert(t, twice, ["id"]), lambda: M.update_from(t, twice, ["id"], ["v"]),
               lambda: M.upsert_soft_delete(t, twice, ["id"], now=NOW)):
        with pytest.raises(Exception, match="duplicate source key"):
            fn().collect()


def test_merge_reads_the_target_once(spark, tmp_path):
    spark.range(100).selectExpr("id", "id * 2 AS v").write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    plan = M.upsert(t, spark.range(5).selectExpr("id", "0 AS v"), ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1 and "broadcast" not in plan.lower()


def test_pair_designated_within_scope(spark):
    from govlake.operators import joins as J
    lh = spark.createDataFrame(
        [("w1", "StagingLakehouseForDataflows_1", "s1"), ("w1", "Sales", "a"), ("w1", "Finance", "b"),
         ("w2", "Ops", "c"), ("w2", "StagingLakehouseForDataflows_2", "s2"), ("w2", "StagingLakehouseForDataflows_3", "s3"),
         ("w3", "Lonely", "d")], "ws string, name string, id string")
    staging = F.col("name").startswith("StagingLakehouseForDataflows")
    p = J.pair_within(lh.filter(staging), lh.filter(~staging), "ws", {"id": "up"}, {"id": "down"})
    # designated x others of the same scope; staging rows are never paired with each other
    assert rows(p, ["up", "down"]) == [("s1", "a"), ("s1", "b"), ("s2", "c"), ("s3", "c")]

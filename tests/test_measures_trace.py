"""Measure families and trace queries on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from govlake.operators import measures as A
from govlake.operators import trace as K
from govlake.operators import windows as W


def test_two_level_and_unused(spark):
    df = spark.createDataFrame([("d1", "i1", 1.0), ("d1", "i1", 2.0), ("d1", "i2", 5.0), ("d2", "i1", 4.0)],
                               "d string, i string, v double")
    r = A.two_level(df, ["d", "i"], F.col("v")).first()
    assert (r["avg_value"], r["max_value"], r["count_value"]) == (4.0, 5.0, 3)
    ent = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    m1 = spark.createDataFrame([("a", 3), ("b", 0)], "k string, v int")
    m2 = spark.createDataFrame([("a", 1)], "k string, v int")
    out = {x["k"]: x for x in A.unused_indicators(ent, "k", {"act": m1, "cu": m2}).collect()}
    assert (out["a"]["unused_act"], out["a"]["unused_score"]) == (None, None)
    assert (out["b"]["unused_act"], out["b"]["unused_cu"], out["b"]["unused_score"]) == (1, 1, 1.0)


def test_month_over_month_and_latest(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5), 1.0), (dt.date(2024, 2, 5), 3.0), (dt.date(2024, 4, 1), 2.0)],
                               "d date, v double")
    out = {r["Month"]: r for r in A.month_over_month(df, "d", {"s": F.sum("v")}).collect()}
    assert out[dt.date(2024, 2, 1)]["growth_s"] == 2.0
    assert out[dt.date(2024, 4, 1)]["growth_s"] is None
    assert A.latest_snapshot(df, "d").count() == 1


def test_trailing_average_and_outliers(spark):
    df = spark.createDataFrame([("i", dt.date(2024, 1, 1), 10.0), ("i", dt.date(2024, 1, 20), 20.0),
                                ("i", dt.date(2024, 3, 1), 30.0)], "i string, d date, v double")
    ta = {r["Date"]: r["trailing_avg"] for r in A.trailing_average(df, "i", "d", F.col("v"), 30).collect()}
    assert ta == {dt.date(2024, 1, 1): 10.0, dt.date(2024, 1, 20): 15.0, dt.date(2024, 3, 1): 30.0}
    o = {r["Date"]: r for r in A.outliers(df, "i", "d", F.col("v")).collect()}
    assert o[dt.date(2024, 3, 1)]["daily_vs_avg"] == 10.0
    assert o[dt.date(2024, 3, 1)]["outlier_factor"] == (10.0 - 20.0) / 20.0


def test_run_comparison_storage_health(spark):
    df = spark.createDataFrame([("m", 1, 5), ("m", 2, 7), ("n", 1, 3)], "m string, run int, size int")
    out = {r["m"]: r for r in A.run_comparison(df, "m", "run", {"size": F.col("size")}).collect()}
    assert (out["m"]["last_run"], out["m"]["previous_run"], out["m"]["size_diff"]) == (2, 1, -2)
    assert (out["n"]["previous_run"], out["n"]["size_previous"]) == (None, None)
    seg = spark.createDataFrame([("T1", 10, 0, "BASIC_DATA", 4), ("H$x", 5, 0, "X", 0), ("H$x", 6, 1, "X", 0),
                                 ("R$y", 7, 0, "X", 0)],
                                "TABLE_ID string, USED_SIZE long, SEGMENT_NUMBER int, COLUMN_TYPE string, DICTIONARY_SIZE long")
    s = A.storage_breakdown(seg).first()
    assert (s["data_size"], s["hierarchy_size"], s["relationship_size"], s["dictionary_size"], s["total_size"]) == \
        (10, 5, 7, 4, 26)
    cols = spark.createDataFrame([("m", None, "Ready"), ("n", "err", "Ready")], "model string, ErrorMessage string, State string")
    parts = spark.createDataFrame([("m", None, "Ready"), ("n", None, "NoData")], "model string, ErrorMessage string, State string")
    h = {r["model"]: r for r in A.health_flags({"columns": cols, "partitions": parts}, "model").collect()}
    assert h["m"]["model_healthy"] is True and h["n"]["columns_healthy"] is False


def test_windows(spark):
    df = spark.createDataFrame([("t", 1, 5.0), ("t", 2, 5.0), ("t", 3, 1.0)], "g string, id int, v double")
    assert rows(W.rank_desc(df, ["g"], "v"), ["id", "rank"]) == [(1, 1), (2, 1), (3, 3)]
    assert rows(W.running_total(df, ["g"], "id", "v"), ["id", "running_total"]) == [(1, 5.0), (2, 10.0), (3, 11.0)]
    assert rows(W.running_total_grouped(df, ["g"], "id", "v"), ["id", "running_total"]) == [(1, 5.0), (2, 10.0), (3, 11.0)]
    assert rows(W.share_of_total(df, "v"), ["id", "share"]) == [(1, 5 / 11), (2, 5 / 11), (3, 1 / 11)]
    assert rows(W.top1_by_group(df, ["g"], "id"), ["g", "id"]) == [("t", 3)]


def _trace(spark):
    now = dt.datetime(2024, 1, 31)
    base = dict(TimeGenerated=now - dt.timedelta(days=1), Resource="R", ResourceGroup="rg",
                ResourceProvider="MICROSOFT.ANALYSISSERVICES", ApplicationName_s="PowerBI", ApplicationContext_s=None,
                TextData_s="", SPID_s="1", ObjectPath_s="p", ObjectReference_s=None, Duration_s="1000",
                Success_s="1", Error_s="0", IntegerData_s="5", User_s="u", DatabaseName_s="db", ServerName_s="s",
                RootActivityId_g="x", StartTime_t=now, EndTime_t=now, OperationName="", EventSubclass_s="0")
    recs = [
        {**base, "OperationName": "QueryEnd", "EventSubclass_s": "3", "TextData_s": "'T'[a] 'T'[b]", "SPID_s": "1",
         "ApplicationContext_s": '{"Sources":"[{\\"ReportId\\":\\"r1\\",\\"VisualId\\":\\"v1\\"}]"}'},
        {**base, "OperationName": "QueryEnd", "EventSubclass_s": "3", "TextData_s": "'T'[a]", "SPID_s": "2",
         "Duration_s": "3000", "ApplicationContext_s": '{"Sources":"[{\\"ReportId\\":\\"r1\\",\\"VisualId\\":\\"v1\\"}]"}'},
        {**base, "OperationName": "QueryEnd", "EventSubclass_s": "3", "TextData_s": "'T'[c]",
         "TimeGenerated": now - dt.timedelta(days=40)},
        {**base, "OperationName": "ProgressReportEnd", "EventSubclass_s": "1",
         "ObjectReference_s": "<Object><Database>d</Database><Table>t</Table><Partition>p</Partition></Object>"},
        {**base, "OperationName": "ProgressReportEnd", "EventSubclass_s": "17", "IntegerData_s": "42"},
        {**base, "OperationName": "ProgressReportEnd", "EventSubclass_s": "55", "TextData_s": "x <pii>ColA</pii>",
         "ObjectReference_s": "<Object><Table>t</Table></Object>"},
        {**base, "OperationName": "Error", "TextData_s": "boom", "RootActivityId_g": "A"},
        {**base, "OperationName": "Error", "TextData_s": "also", "RootActivityId_g": "A"},
        {**base, "OperationName": "CommandEnd", "EventSubclass_s": "38", "Error_s": "-1055784777",
         "RootActivityId_g": "A", "TextData_s": "refresh"},
    ]
    cols = list(base)
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in recs],
                                 ", ".join(f"{c} {'timestamp' if c in ('TimeGenerated', 'StartTime_t', 'EndTime_t') else 'string'}"
                                           for c in cols))


def test_trace_queries(spark):
    t = _trace(spark)
    now = "2024-01-31 00:00:00"
    assert rows(K.k_column_usage(t, now=now)) == [("'T'[a]", 2), ("'T'[b]", 1)]
    pl = K.k_partition_load_time(t).collect()
    assert len(pl) == 1 and pl[0]["Number_Of_Rows"] == "42" and pl[0]["Table"] == "t" and pl[0]["Duration_Seconds"] == 1.0
    err = K.k_processing_errors(t).collect()
    assert len(err) == 1 and err[0]["Error"] == "also" and err[0]["Details"] == "refresh"
    ql = K.k_query_load_time(t, now=now).collect()
    assert len(ql) == 1 and ql[0]["count_queries"] == 2 and ql[0]["ReportId_"] == "r1" and ql[0]["avg_load_time_sec"] == 2.0
    re_ = K.k_re_encoding(t).collect()
    assert len(re_) == 1 and re_[0]["Column"] == "ColA"


def test_exact_median_matches_spark_median(spark):
    import random
    rnd = random.Random(7)
    data = [(g, float(rnd.randint(0, 20))) for g in "abc" for _ in range(rnd.randint(1, 30))] + [("d", None)]
    df = spark.createDataFrame(data, "g string, v double")
    mine = rows(A.exact_median(df, "v", ["g"]), ["g", "median"])
    ref = rows(df.groupBy("g").agg(F.median("v").alias("m")), ["g", "m"])
    assert [m for m in mine if m[0] != "d"] == [r for r in ref if r[0] != "d"]
    whole = A.distribution_stats(df.filter("g = 'a'"), "v").first()
    assert whole["v_median"] == [r[1] for r in ref if r[0] == "a"][0]


def test_gateway_and_sql_measures(spark):
    ev = spark.createDataFrame([("r1", "WorkspaceId", "w1"), ("r1", "WorkspaceId", "w2"), ("r1", "DatasetId", "m2"),
                                ("r1", "DatasetId", "m1"), ("r2", "Other", "x")], "RequestId string, key string, value string")
    out = {r["RequestId"]: r for r in A.request_context_values(ev).collect()}
    assert (out["r1"]["RefreshWorkspaceId"], out["r1"]["SemanticModelId"]) == ("w2", "m1")
    assert out["r2"]["SemanticModelId"] is None
    h = spark.createDataFrame([(1000, 500, 10, 2, 1.0, 0.5, 0.0, "Succeeded"), (3000, 100, 5, 0, 2.0, 0.0, 1.0, "Failed")],
                              "total_elapsed_time_ms long, allocated_cpu_time_ms long, row_count long, result_cache_hit int, "
                              "data_scanned_disk_mb double, data_scanned_memory_mb double, "
                              "data_scanned_remote_storage_mb double, status string")
    m = A.sql_request_measures(h).first()
    assert (m["elapsed"], m["max_elapsed"], m["cache_hits"], m["success_rate"]) == (4.0, 3.0, 1, 0.5)
    mash = spark.createDataFrame([(dt.date(2024, 1, 1), 10, 20, 5, 7, 1.0, 2.0, 100, 6.0)],
                                 "EndDate date, `AverageCommit(byte)` long, `MaxCommit(byte)` long, "
                                 "`AverageWorkingSet(byte)` long, `MaxWorkingSet(byte)` long, AveragePercentProcessorTime double, "
                                 "MaxPercentProcessorTime double, `TotalProcessorTime(ms)` long, TotalRowsSum double")
    ex = spark.createDataFrame([(dt.date(2024, 1, 1), "r1"), (dt.date(2024, 1, 1), "r1")],
                               "QueryExecutionEndDate date, RequestId string")
    r = A.mashup_by_end_date(mash, ex).first()
    assert (r["avg_commit"], r["requests"], r["total_rows"]) == (10.0, 1, 6.0)


def test_documentation_ratio_and_names(spark):
    from govlake.functions import scalar as P
    d = spark.createDataFrame([("m", "x"), ("m", ""), ("m", None), ("n", "y")], "model string, d string")
    out = {r["model"]: r["documented_ratio"] for r in A.documentation_ratio(d, "d", by=["model"]).collect()}
    assert out == {"m": 1 / 3, "n": 1.0}
    n = spark.createDataFrame([("", "inf"), ("exp", "inf"), (None, None)], "e string, i string")
    assert [r[0] for r in n.select(P.coalesce_name("e", "i")).collect()] == ["inf", "exp", None]
    assert [r[0] for r in n.select(P.replace_null("i", "0")).collect()] == ["inf", "inf", "0"]


def test_distributed_rank_running_total_median(spark):
    import random
    rnd = random.Random(3)
    # one hot group holding most rows, plus small groups, with ties
    data = [("hot", rnd.randint(0, 40), float(rnd.randint(1, 9))) for _ in range(400)] + \
           [(g, rnd.randint(0, 5), float(rnd.randint(1, 9))) for g in "abc" for _ in range(rnd.randint(1, 9))]
    df = spark.createDataFrame(data, "g string, v int, w double").repartition(7)
    want = rows(W.rank_desc(df, ["g"], "v"), ["g", "v", "w", "rank"])
    got = rows(W.rank_desc_distributed(df, ["g"], "v"), ["g", "v", "w", "rank"])
    assert got == want
    from pyspark.sql import Window
    rng = Window.partitionBy("g").orderBy("v").rangeBetween(Window.unboundedPreceding, 0)
    want_rt = rows(df.withColumn("rt", F.sum("w").over(rng)), ["g", "v", "w", "rt"])
    got_rt = rows(W.running_total_distributed(df, ["g"], "v", "w", "rt"), ["g", "v", "w", "rt"])
    assert got_rt == want_rt
    med = rows(A.exact_median(df, "v", ["g"]), ["g", "median"])
    assert med == rows(df.groupBy("g").agg(F.median("v").alias("m")), ["g", "m"])
    assert A.exact_median(df, "v").first()["median"] == df.agg(F.median("v")).first()[0]


def test_sum_over_groups_equals_total(spark):
    from conftest import SF_CHECK
    from govlake.plans.standins import load
    li = load(spark, SF_CHECK, "lineitem")
    conds = {"discounted": F.col("l_discount") > 0.05, "taxed": F.col("l_tax") > 0}
    by = A.conditional_counts(li, conds, by=["l_returnflag"]).agg(*[F.sum(c).alias(c) for c in conds]).first()
    total = A.conditional_counts(li, conds).first()
    assert by.asDict() == total.asDict()
    o = load(spark, SF_CHECK, "orders")
    roll = A.rolling_counts(o, "o_orderdate", "2001-08-01", days=(30, 365), by=["o_orderstatus"])
    whole = A.rolling_counts(o, "o_orderdate", "2001-08-01", days=(30, 365)).first()
    assert roll.agg(F.sum("last_30d"), F.sum("last_365d")).first()[:] == (whole["last_30d"], whole["last_365d"])
    grouped = A.measure(li, {"q": A.exact_sum(F.col("l_quantity"), 2)}, by=["l_suppkey"]).agg(A.exact_sum(F.col("q"), 2)).first()[0]
    assert grouped == A.measure(li, {"q": A.exact_sum(F.col("l_quantity"), 2)}).first()[0]


def test_exact_sums_have_no_ceiling(spark):
    from govlake.operators import measures as A
    from govlake.plans.registry import rnd
    df = spark.createDataFrame([(1, 1e17), (1, 2e17), (2, 0.1), (2, 0.2)], "k int, v double")
    got = rows(df.groupBy("k").agg(A.exact_sum(F.col("v"), 4).alias("s"), rnd(F.max("v"), 4).alias("m")), ["k", "s", "m"])
    assert got == [(1, 3e17, 2e17), (2, 0.3, 0.2)]


def test_windows_keep_null_groups_and_null_values(spark):
    from pyspark.sql import Window
    from govlake.operators import windows as W
    df = spark.createDataFrame([("a", 1, 10), ("a", None, 20), ("a", 1, 30), (None, 2, 1), (None, 3, 2), (None, None, 3)], "g string, o int, v int")
    w = Window.partitionBy("g").orderBy(F.col("o").desc())
    assert rows(W.rank_desc_distributed(df, ["g"], "o"), ["g", "o", "rank"]) == rows(df.withColumn("rank", F.rank().over(w)), ["g", "o", "rank"])
    t = Window.partitionBy("g").orderBy("o")
    want = rows(df.withColumn("s", F.sum("v").over(t)), ["g", "o", "s"])
    assert rows(W.running_total_distributed(df, ["g"], "o", "v", "s"), ["g", "o", "s"]) == want
    assert rows(W.running_total_grouped(df, ["g"], "o", "v", "s"), ["g", "o", "s"]) == want


def test_item_vs_all_averages_item_days(spark):
    today = dt.date(2024, 4, 1)
    df = spark.createDataFrame([("a", today, 10.0), ("b", today, 30.0), ("b", dt.date(2024, 1, 2), 50.0), ("a", dt.date(2024, 1, 1), 99.0)],
                               "item string, d date, v double")
    # 2024-01-02 is today - 90 and counts, 2024-01-01 doesn't; the baseline is the mean of three (item, day) sums
    got = rows(A.item_vs_all(df, "item", "d", F.col("v"), today, decimals=2), ["item", "item_avg", "all_avg", "above"])
    assert got == [("a", 10.0, 30.0, False), ("b", 30.0, 30.0, False)]


def test_success_ratio_counts_only_failures(spark):
    df = spark.createDataFrame([("r1", "Y"), ("r2", "N"), ("r3", "?"), ("r4", None)], "id string, s string")
    assert rows(A.success_ratio(df, "id", "s")) == [(4, 1, 0.25)]


def test_window_trend(spark):
    today = dt.date(2024, 4, 1)
    df = spark.createDataFrame([("a", today, 6.0), ("a", dt.date(2024, 3, 5), 2.0), ("b", dt.date(2024, 1, 1), 9.0)], "item string, d date, v double")
    assert rows(A.window_trend(df, "item", "d", today, F.col("v"), decimals=2)) == [(6.0, 4.0, 0.5)]
    assert rows(A.window_trend(df, None, "d", today)) == [(1, 2, -0.5)]

"""Sources and sinks on hand-made JSON and CSV files."""

import json
import os

from pyspark.sql import functions as F

from conftest import rows
from govlake.operators.flatten import decode_enum
from govlake.sources import dims, envelope, logs, sinks


def _write(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(obj if isinstance(obj, str) else json.dumps(obj, indent=2))


def test_envelope_explode_and_fallback(spark, tmp_path):
    _write(f"{tmp_path}/a/1.json", {"value": [{"id": "a", "n": 1}, {"id": "b", "n": 2}]})
    df = envelope.read_envelope(spark, f"{tmp_path}/a", ["tenantSettings", "value"])
    assert rows(df, ["id", "n"]) == [("a", 1), ("b", 2)]
    _write(f"{tmp_path}/b/1.json", {"tenantSettings": [{"settingName": "s", "enabled": True}]})
    df = envelope.read_envelope(spark, f"{tmp_path}/b", ["tenantSettings", "value"])
    assert rows(df, ["settingName", "enabled"]) == [("s", True)]


def test_envelope_empty_folder_and_missing_field(spark, tmp_path):
    os.makedirs(f"{tmp_path}/empty")
    assert envelope.read_envelope(spark, f"{tmp_path}/empty", ["value"]).count() == 0
    _write(f"{tmp_path}/c/1.json", {"other": [1]})
    assert envelope.read_envelope(spark, f"{tmp_path}/c", ["value"]).count() == 0


def test_read_latest_takes_greatest_folder_per_level(spark, tmp_path):
    _write(f"{tmp_path}/scan/2024/01/05/x.json", {"workspaces": [{"id": "old"}]})
    _write(f"{tmp_path}/scan/2024/02/01/x.json", {"workspaces": [{"id": "new"}]})
    _write(f"{tmp_path}/scan/2023/12/31/x.json", {"workspaces": [{"id": "older"}]})
    df = envelope.read_latest(spark, f"{tmp_path}/scan", ["workspaces"])
    assert rows(df, ["id"]) == [("new",)]


def test_report_logs_by_header_per_file(spark, tmp_path):
    _write(f"{tmp_path}/gw/QueryExecutionReport_1.log",
           'RequestId,Success,DataSource\nr1,Y,"[""{\\""kind\\"":\\""Sql\\""}""]"\nr2,N,broken\n')
    _write(f"{tmp_path}/gw/QueryExecutionReport_2.log", "Success,RequestId\nY,r3\n")
    _write(f"{tmp_path}/gw/MashupEvaluationReport_1.log", "RequestId\nzz\n")
    df = logs.read_report_logs(spark, f"{tmp_path}/gw", "QueryExecutionReport", ["RequestId", "Success", "DataSource"],
                                with_row_number=True)
    got = rows(df, ["RequestId", "Success", "FileName", "RowNumber"])
    assert got == [("r1", "Y", "QueryExecutionReport_1.log", 1), ("r2", "N", "QueryExecutionReport_1.log", 2),
                   ("r3", "Y", "QueryExecutionReport_2.log", 1)]
    assert df.filter(F.col("RequestId") == "r3").first()["DataSource"] is None
    bad = logs.bad_json_rows(df, "DataSource")
    # a missing JSON text doesn't parse either
    assert rows(bad, ["FileName", "RowNumber"]) == [("QueryExecutionReport_1.log", 2), ("QueryExecutionReport_2.log", 1)]


def test_write_evolve_and_ensure_columns(spark, tmp_path):
    p = f"{tmp_path}/t"
    sinks.write_table(spark.createDataFrame([(1,)], "a int"), p, "append")
    sinks.write_table(spark.createDataFrame([(2, "x")], "a int, b string"), p, "append")
    t = sinks.read_table(spark, p)
    assert rows(t, ["a", "b"]) == [(1, None), (2, "x")]
    defs = spark.createDataFrame([("t", "c", "bigint"), ("t", "s", "struct<x:int>"), ("u", "z", "int")],
                                 "Table_Name string, Column_Name string, Data_Type string")
    out = sinks.ensure_columns(t, defs, "t")
    assert out.columns == ["a", "b", "c"] and dict(out.dtypes)["c"] == "bigint"


def test_calendar_flags(spark):
    cal = dims.calendar(spark, "2024-01-01", "2024-03-01", today="2024-02-15")
    assert cal.count() == 61
    r = {x["Date"]: x for x in cal.collect()}
    assert r["2024-02-01"]["IsCurrentMonth"] == 1 and r["2024-01-31"]["IsPreviousMonth"] == 1
    assert r["2024-02-01"]["IsInLast14Days"] == 1 and r["2024-01-31"]["IsInLast14Days"] == 0
    assert r["2024-01-16"]["IsInLast30Days"] == 1 and r["2024-01-15"]["IsInLast30Days"] == 0
    assert r["2024-01-01"]["DayOfWeek"] == "Mon" and r["2024-01-01"]["DayOfWeekNum"] == 2


def test_day_spine_and_static_dims(spark):
    e = spark.createDataFrame([("a",), ("b",)], "k string")
    assert dims.day_spine(e, "2024-01-01", "2024-01-04").count() == 8
    sd = dims.static_dims(spark)
    assert sd["capacity_regions"].count() == 30 and sd["size_units"].count() == 4


def test_logs_wider_than_any_fixed_width(spark, tmp_path):
    import os
    os.makedirs(f"{tmp_path}/wide")
    names = [f"c{i}" for i in range(200)]
    _write(f"{tmp_path}/wide/WideReport_1.log", ",".join(names) + "\n" + ",".join(str(i) for i in range(200)) + "\n")
    _write(f"{tmp_path}/wide/WideReport_2.log", "c199,c0\nz,a\n")
    df = logs.read_report_logs(spark, f"{tmp_path}/wide", "WideReport", ["c0", "c64", "c199"])
    assert rows(df) == sorted([("0", "64", "199"), ("a", None, "z")], key=repr)


def test_envelope_fallback_row_by_row_and_wrong_path(spark, tmp_path):
    import os

    import pytest
    os.makedirs(f"{tmp_path}/env")
    _write(f"{tmp_path}/env/a.json", '{"Overrides": [{"x": "1"}]}')
    _write(f"{tmp_path}/env/b.json", '{"value": [{"x": "2"}]}')
    from govlake.sources import envelope
    schema = "Overrides array<struct<x:string>>, value array<struct<x:string>>"
    for sch in (None, schema):
        assert rows(envelope.read_envelope(spark, f"{tmp_path}/env", ["Overrides", "value"], sch)) == [("1",), ("2",)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        envelope.read_envelope(spark, f"{tmp_path}/missing", "value")


def test_enum_tables_and_names(spark):
    tables = dims.enum_tables(spark)
    assert len(tables) == 18 and {r["Enum"]: r["Name"] for r in tables["data_type"].collect()}[9] == "DateTime"
    df = spark.createDataFrame([(1, 2), (99, None)], "state int, kind int")
    got = dims.enum_names(df, {"state": "state", "kind": "partition_type"}).collect()
    assert [(r["state_name"], r["kind_name"]) for r in got] == [("Ready", "Calculated"), ("99", None)]
    codes = spark.range(25).select(F.col("id").cast("int").alias("c"))
    looked_up = {r["c"]: r["name"] for r in decode_enum(codes, "c", tables["data_type"], "name").collect()}
    assert looked_up == {r["id"]: r["id_name"] for r in dims.enum_names(spark.range(25), {"id": "data_type"}).collect()}


def test_report_logs_number_rows_without_sorting_a_file(spark, tmp_path):
    folder = tmp_path / "plain"
    folder.mkdir()
    (folder / "MyReport_1.log").write_text('b,a\n"x\ny",1\n,2\n')
    (folder / "MyReport_2.log").write_text("a,c\n3,z\n")
    (folder / "MyReport_3.log").write_text("a,b\n")
    df = logs.read_report_logs(spark, str(folder), "MyReport", ["a", "b"], True)
    assert sorted(tuple(r) for r in df.collect()) == [("1", "x\ny", "MyReport_1.log", 1), ("2", None, "MyReport_1.log", 2), ("3", None, "MyReport_2.log", 1)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort " not in plan

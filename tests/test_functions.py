"""Scalar transforms and blank-aware helpers on hand-made rows."""

import base64
import datetime as dt

from pyspark.sql import functions as F

from govlake.functions import blank, scalar as P


def one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_ddivide_blank_on_zero_and_null(spark):
    out = one(spark, blank.ddivide("a", "b"), [(1, 2), (1, 0), (1, None)], "a int, b int")
    assert out == [0.5, None, None]
    assert one(spark, blank.ddivide("a", "b", 0.0), [(1, 0)], "a int, b int") == [0.0]


def test_dcount_blank_counts_null_once(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,), (None,), ("x",)], "v string")
    assert df.agg(blank.dcount_blank("v")).first()[0] == 3
    assert spark.createDataFrame([("x",)], "v string").agg(blank.dcount_blank("v")).first()[0] == 1


def test_date_parts_from_iso_text(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05Z",)], "t string")
    r = df.select(*[c.alias(n) for n, c in P.date_parts("t").items()]).first()
    assert r["CreationDate"] == dt.date(2024, 1, 2)
    assert r["CreationDateKey"] == "20240102"
    assert r["CreationMinute"] == "04"


def test_activity_status_order(spark):
    data = [("Failed", True), ("InProgress", True), ("Succeeded", False), (None, True), (None, False), ("Other", None)]
    out = one(spark, P.activity_status(), data, "ResultStatus string, IsSuccess boolean")
    assert out == ["Failed", "InProgress", "Succeeded", "Succeeded", "N/A", "N/A"]
    assert one(spark, P.yn_status("s"), [("Y",), ("N",), ("x",)], "s string") == ["Success", "Error", "N/A"]


def test_time_bin_floor_and_null(spark):
    data = [(dt.datetime(2024, 1, 1, 10, 14, 59),), (None,)]
    out = one(spark, P.time_bin("t", 15), data, "t timestamp")
    assert out == [dt.datetime(2024, 1, 1, 10, 0), None]
    assert one(spark, P.time_bin("t", 5), [(dt.datetime(2024, 1, 1, 10, 14, 59),)], "t timestamp") == \
        [dt.datetime(2024, 1, 1, 10, 10)]


def test_sum_bracket_list(spark):
    out = one(spark, P.sum_bracket_list("t"), [("[1,2, 3]",), ("[]",), ("x[4]y",)], "t string")
    assert out == [6.0, 0.0, 4.0]


def test_between_first_and_last(spark):
    data = [("a (1) b (22)",), ("none",)]
    assert one(spark, P.between("t", "(", ")"), data, "t string") == ["1", ""]
    assert one(spark, P.between("t", "(", ")", from_end=True), data, "t string") == ["22", ""]


def test_decode_b64_text_cp1252(spark):
    raw = bytes([0x48, 0x80, 0x93, 0x69, 0x94, 0x0A, 0x78, 0xE9, 0x81])
    text = base64.b64encode(raw).decode()
    want = "H€“i” xé\x81"
    assert one(spark, P.decode_b64_text("t"), [(text,)], "t string") == [want]
    # the printable bytes agree with Python's codec
    assert raw[:5].decode("cp1252") == want[:5]


def test_io_rate_and_units(spark):
    assert one(spark, P.io_rate("b", "ms"), [(2000, 1000), (5, 0)], "b long, ms long") == [2000.0, None]
    assert one(spark, P.to_unit("b", "kilobytes"), [(2048,)], "b long") == [2.0]
    assert one(spark, P.to_unit("ms", "minutes", kind="time"), [(120000,)], "ms long") == [2.0]


def test_item_url(spark):
    data = [("WS", "ID", "Report"), ("WS", "ID", "SemanticModel"), ("WS", "ID", "Other")]
    out = one(spark, P.item_url("w", "i", "t"), data, "w string, i string, t string")
    assert out == ["https://app.powerbi.com/groups/ws/reports/id",
                   "https://app.powerbi.com/groups/ws/datasets/id/details",
                   "https://app.powerbi.com/groups/WS"]


def test_extract_and_xml_and_json(spark):
    assert one(spark, P.extract(r"<pii>(.*?)</pii>", 1, "t"), [("a <pii>c1</pii>",), ("none",)], "t string") == ["c1", None]
    xml = "<Object><Database>d</Database><Table>t</Table></Object>"
    assert one(spark, P.xml_field("x", "Object/Table"), [(xml,)], "x string") == ["t"]
    assert one(spark, P.xml_field("x", "Object/Partition"), [(xml,)], "x string") == [None]
    ctx = '{"Sources":"[{\\"ReportId\\":\\"r1\\",\\"VisualId\\":\\"v\\"}]"}'
    assert one(spark, P.json_text_field("c", "Sources", "ReportId"), [(ctx,)], "c string") == ["r1"]


def test_keys(spark):
    import hashlib
    out = one(spark, P.sha_key("a", "b"), [("x", 1)], "a string, b int")
    assert out == [hashlib.sha256(b"x-1").hexdigest()]
    assert one(spark, P.text_key(["a", "b"], "-"), [("x", None)], "a string, b string") == ["x"]


def test_encoding_verdict_and_flags(spark):
    data = [("Default", "Hash"), ("Hash", "Hash"), ("Value", "Hash"), (None, "Hash")]
    assert one(spark, P.encoding_verdict("h", "a"), data, "h string, a string") == [None, "Accepted", "Not Accepted", None]
    assert one(spark, P.decode_flag("f", "Key", "Not Key"), [(True,), (False,), (None,)], "f boolean") == ["Key", "Not Key", None]
    assert one(spark, P.first_nonempty("a", "b"), [("", "x"), (None, None), ("y", "x")], "a string, b string") == ["x", None, "y"]

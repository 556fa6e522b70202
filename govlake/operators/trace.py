"""Engine-trace queries (K1-K5) over a diagnostics table.

Column names default to the trace table's native names; pass others to run
the same query over a differently named table.  ``now`` fixes the
"last 30 days" window so results are reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import REPORT_URL_BASE, extract, json_text_field, xml_fields
from .joins import inner_unique, left_outer_distinct

# The trace filters.
QUERY_END = "QueryEnd"
PROGRESS_END = "ProgressReportEnd"
COMMAND_END = "CommandEnd"
ERROR_OP = "Error"
PROVIDER = "MICROSOFT.ANALYSISSERVICES"
APPLICATION = "PowerBI"
ERROR_CODE = -1055784777
COLUMN_REF_PATTERN = r"('.*?'\[.*?\])"
PII_PATTERN = r"<pii>(.*?)</pii>"


def _ts(now) -> Column:
    return now if isinstance(now, Column) else F.lit(str(now)).cast("timestamp")


def _query_end(trace: DataFrame, resource: str | None, now, days: int) -> DataFrame:
    cond = (F.col("OperationName") == QUERY_END) & (F.col("EventSubclass_s").cast("int") == 3) \
        & (F.col("ApplicationName_s") == APPLICATION)
    if resource is not None:
        cond = cond & (F.col("Resource") == resource)
    if now is not None:
        cond = cond & (F.col("TimeGenerated") > _ts(now) - F.expr(f"INTERVAL {days} DAYS"))
    return trace.filter(cond)


def _seconds(col: str = "Duration_s") -> Column:
    return F.col(col).cast("int") / 1000.0


XML_OBJECT_FIELDS = ("Database", "Model", "Table", "Partition")


def _xml_object() -> dict[str, Column]:
    """Database/Model/Table/Partition of the object reference: one XML parse
    per row for all four fields."""
    o = xml_fields("ObjectReference_s", list(XML_OBJECT_FIELDS))
    return {n: F.nullif(o[n], F.lit("")) for n in XML_OBJECT_FIELDS}


def k_column_usage(trace: DataFrame, resource: str | None = None, now=None, days: int = 30,
                   exact: bool = True) -> DataFrame:
    """K1: distinct sessions per ``'Table'[Column]`` reference in query text.
    ``exact=False`` uses the approximate distinct count as the source does."""
    q = _query_end(trace, resource, now, days)
    refs = q.select(F.explode(F.regexp_extract_all(F.col("TextData_s"), F.lit(COLUMN_REF_PATTERN), 1)).alias("Table_Column"),
                    "SPID_s")
    dc = F.count_distinct("SPID_s") if exact else F.approx_count_distinct("SPID_s")
    return refs.groupBy("Table_Column").agg(dc.alias("Total_Number_Queried"))


def k_partition_load_time(trace: DataFrame) -> DataFrame:
    """K2: successful partition processing with XML object fields and
    seconds, left-joined to the row-count events by (session, object path),
    distinct rows."""
    base = (F.col("OperationName") == PROGRESS_END) & (F.col("Success_s").cast("int") == 1)
    uid = F.concat_ws("-", F.col("SPID_s").cast("string"), F.col("ObjectPath_s"))
    proc = trace.filter(base & (F.col("EventSubclass_s").cast("int") == 1)).select(
        F.col("ResourceGroup").alias("Resource_Group"), "Resource",
        *[c.alias(n) for n, c in _xml_object().items()],
        F.col("User_s").alias("User"), _seconds().alias("Duration_Seconds"),
        F.col("StartTime_t").alias("Start_Time"), F.col("EndTime_t").alias("End_Time"),
        uid.alias("unique_id"))
    rows = trace.filter(base & (F.col("EventSubclass_s").cast("int") == 17)).select(
        uid.alias("unique_id"), F.col("IntegerData_s").alias("Number_Of_Rows"))
    j = left_outer_distinct(proc, rows, ["unique_id"]).drop("unique_id")
    return j.select("Resource_Group", "Resource", "Database", "Model", "Table", "Partition", "User",
                    "Duration_Seconds", "Number_Of_Rows", "Start_Time", "End_Time")


def k_processing_errors(trace: DataFrame) -> DataFrame:
    """K3: error events that carry a user, matched (innerunique) to failed
    processing commands by root activity id; newest first."""
    prov = F.col("ResourceProvider") == PROVIDER
    errors = trace.filter(prov & (F.col("OperationName") == ERROR_OP)
                          & (F.coalesce(F.col("User_s"), F.lit("")) != "")).select(
        "RootActivityId_g", F.col("TextData_s").alias("Error"), F.col("ServerName_s").alias("Server"),
        "Resource", F.col("User_s").alias("User"), F.col("ApplicationName_s").alias("Application"))
    procs = trace.filter(prov & (F.col("Error_s").cast("long") == ERROR_CODE)
                         & (F.col("OperationName") == COMMAND_END)
                         & (F.col("EventSubclass_s").cast("int") == 38)).select(
        "RootActivityId_g", F.col("EndTime_t").alias("End_Time"), F.col("DatabaseName_s").alias("Database"),
        F.col("TextData_s").alias("Details"))
    j = inner_unique(errors, procs, ["RootActivityId_g"])
    return j.select("End_Time", "Database", "Details", "Error", "Server", "Resource", "User", "Application") \
            .orderBy(F.col("End_Time").desc_nulls_last())


def k_query_load_time(trace: DataFrame, resource: str | None = None, now=None, days: int = 30) -> DataFrame:
    """K4: per application context and resource: average and total seconds,
    query count, report and visual ids from the nested JSON, report URL;
    slowest total first."""
    q = _query_end(trace, resource, now, days)
    d = F.col("Duration_s").cast("int")
    g = q.groupBy("ApplicationContext_s", "Resource").agg(
        (F.avg(d) / 1000).alias("avg_load_time_sec"), (F.sum(d) / 1000).alias("sum_load_time_sec"),
        F.count(F.lit(1)).alias("count_queries"))
    rid = json_text_field("ApplicationContext_s", "Sources", "ReportId")
    vid = json_text_field("ApplicationContext_s", "Sources", "VisualId")
    out = g.select("avg_load_time_sec", "sum_load_time_sec", "count_queries", rid.alias("ReportId_"),
                   vid.alias("VisualId_"), F.concat(F.lit(REPORT_URL_BASE), F.coalesce(rid, F.lit(""))).alias("ReportUrl"))
    return out.orderBy(F.col("sum_load_time_sec").desc_nulls_last())


def k_re_encoding(trace: DataFrame) -> DataFrame:
    """K5: re-encoding events with XML object fields, seconds and the column
    name from the tagged text; newest first."""
    t = trace.filter((F.col("OperationName") == PROGRESS_END) & (F.col("EventSubclass_s").cast("int") == 55))
    o = _xml_object()
    out = t.select(F.col("StartTime_t").alias("Start_Time"), F.col("EndTime_t").alias("End_Time"),
                   o["Table"].alias("Table"), extract(PII_PATTERN, 1, "TextData_s").alias("Column"),
                   _seconds().alias("Duration_Seconds"), F.col("TextData_s").alias("Text"),
                   o["Database"].alias("Database"), o["Model"].alias("Model"), o["Partition"].alias("Partition"),
                   "Resource")
    return out.orderBy(F.col("Start_Time").desc_nulls_last())

"""Stand-ins: the driver tables re-shaped into the native inputs.

The operators are written against the native shapes (activity log, engine
trace, lineage edges).  The test data is a TPC-H-like star plus an
``events`` log, so these adapters derive native-shaped DataFrames from it -
row for row, on executors, growing with the tables.  Each adapter has an
SQL twin (``*_SQL``) that the DuckDB oracle uses, so both engines see
exactly the same derived input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Fixed evaluation dates, so Spark and the oracle agree.
TODAY = "2024-01-30"            # last day of the events table
NOW = "2024-01-31 00:00:00"     # end of that day
ORDERS_TODAY = "2001-08-01"     # last order date
SHIP_TODAY = "2001-06-30"       # a day inside the lineitem ship dates


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("long")


# --------------------------------------------------------------------------- activities
def activities_from_events(events: DataFrame) -> DataFrame:
    """Activity-log rows (native column names) from ``events``."""
    k = _k()
    et = F.col("event_type")
    return events.select(
        F.col("event_id").cast("string").alias("Id"),
        F.col("ts").alias("CreationTime"),
        et.alias("Activity"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("UserId"),
        F.when(et != "signup", F.concat(F.lit("art-"), k.cast("string"))).alias("ArtifactId"),
        F.concat(F.lit("obj-"), k.cast("string")).alias("ObjectId"),
        F.when(et == "view", F.lit("Report")).alias("ObjectType"),
        F.when(et.isin("click", "purchase"), F.lit("SemanticModel")).otherwise(F.lit("Dashboard")).alias("ArtifactKind"),
        F.concat(F.lit("cap-"), (F.col("user_id") % 7).cast("string")).alias("CapacityId"),
        F.concat(F.lit("ws-"), (F.col("user_id") % 25).cast("string")).alias("WorkspaceId"),
        F.lit("web").alias("Experience"),
        F.when(et == "purchase", F.lit("Premium")).otherwise(F.lit("Reports")).alias("Workload"),
        F.lit(None).cast("string").alias("GatewayId"),
        F.when(et == "error", F.lit("Failed")).when(et == "signup", F.lit("InProgress")).alias("ResultStatus"),
        (et != "error").alias("IsSuccess"),
        F.col("value"),
    )


ACTIVITIES_SQL = """
activities AS (
  SELECT CAST(event_id AS VARCHAR) AS Id, ts AS CreationTime, event_type AS Activity,
         'user' || CAST(user_id AS VARCHAR) AS UserId,
         CASE WHEN event_type <> 'signup' THEN 'art-' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR) END AS ArtifactId,
         'obj-' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR) AS ObjectId,
         CASE WHEN event_type = 'view' THEN 'Report' END AS ObjectType,
         CASE WHEN event_type IN ('click', 'purchase') THEN 'SemanticModel' ELSE 'Dashboard' END AS ArtifactKind,
         'cap-' || CAST(user_id % 7 AS VARCHAR) AS CapacityId,
         'ws-' || CAST(user_id % 25 AS VARCHAR) AS WorkspaceId,
         'web' AS Experience,
         CASE WHEN event_type = 'purchase' THEN 'Premium' ELSE 'Reports' END AS Workload,
         CAST(NULL AS VARCHAR) AS GatewayId,
         CASE WHEN event_type = 'error' THEN 'Failed' WHEN event_type = 'signup' THEN 'InProgress' END AS ResultStatus,
         event_type <> 'error' AS IsSuccess,
         value
  FROM events
)"""


# --------------------------------------------------------------------------- engine trace
def trace_from_events(events: DataFrame) -> DataFrame:
    """Engine-trace rows (native diagnostics column names) from ``events``."""
    k = _k()
    et = F.col("event_type")
    s = lambda c: c.cast("string")
    op = (F.when(et == "view", "QueryEnd").when(et.isin("click", "purchase"), "ProgressReportEnd")
          .when(et == "error", "Error").otherwise("CommandEnd"))
    sub = (F.when(et == "view", "3").when((et == "click") & (k % 2 == 0), "1").when(et == "click", "55")
           .when(et == "purchase", "17").when(et == "signup", "38").otherwise("0"))
    text = (F.when(et == "view", F.concat(F.lit("EVALUATE SUMMARIZECOLUMNS('t"), s(k % 5), F.lit("'[c"), s(k % 3),
                                          F.lit("], 'u"), s(F.col("user_id") % 4), F.lit("'[m"), s(k % 2), F.lit("])")))
            .when(et == "click", F.concat(F.lit("Column <pii>col"), s(k % 9), F.lit("</pii> re-encoded")))
            .when(et == "error", F.concat(F.lit("Error "), s(k)))
            .otherwise(F.concat(F.lit("Command "), s(F.col("event_id")))))
    ctx = F.concat(F.lit('{"Sources":"[{\\"ReportId\\":\\"r'), s(k % 10), F.lit('\\",\\"VisualId\\":\\"v'),
                   s(k % 7), F.lit('\\"}]"}'))
    xml = F.concat(F.lit("<Object><Database>db"), s(k % 4), F.lit("</Database><Model>m"), s(k % 2),
                   F.lit("</Model><Table>t"), s(k % 5), F.lit("</Table><Partition>p"), s(k % 3),
                   F.lit("</Partition></Object>"))
    return events.select(
        F.col("ts").alias("TimeGenerated"), op.alias("OperationName"), sub.alias("EventSubclass_s"),
        F.concat(F.lit("RES"), s(F.col("user_id") % 3)).alias("Resource"),
        F.concat(F.lit("rg"), s(F.col("user_id") % 2)).alias("ResourceGroup"),
        F.lit("MICROSOFT.ANALYSISSERVICES").alias("ResourceProvider"),
        F.when(F.col("user_id") % 5 == 0, F.lit("Excel")).otherwise(F.lit("PowerBI")).alias("ApplicationName_s"),
        ctx.alias("ApplicationContext_s"), text.alias("TextData_s"),
        s(F.col("user_id")).alias("SPID_s"),
        F.concat(F.lit("db"), s(k % 4), F.lit(".t"), s(k % 5)).alias("ObjectPath_s"),
        xml.alias("ObjectReference_s"),
        s((F.col("value") * 100).cast("int")).alias("Duration_s"),
        F.when(k % 10 == 0, F.lit("0")).otherwise(F.lit("1")).alias("Success_s"),
        F.when((et == "signup") & (k % 2 == 0), F.lit("-1055784777")).otherwise(F.lit("0")).alias("Error_s"),
        s(k * 10).alias("IntegerData_s"),
        F.when((et == "error") & (k % 3 == 0), F.lit("")).otherwise(F.concat(F.lit("user"), s(F.col("user_id")))).alias("User_s"),
        F.concat(F.lit("db"), s(k % 4)).alias("DatabaseName_s"),
        F.concat(F.lit("srv"), s(F.col("user_id") % 2)).alias("ServerName_s"),
        F.concat(F.lit("act-"), s(F.col("user_id"))).alias("RootActivityId_g"),
        (F.col("ts") - F.expr("INTERVAL 1 MINUTE")).alias("StartTime_t"),
        F.col("ts").alias("EndTime_t"),
    )


TRACE_SQL = r"""
ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
trace AS (
  SELECT ts AS TimeGenerated,
         CASE WHEN event_type = 'view' THEN 'QueryEnd' WHEN event_type IN ('click', 'purchase') THEN 'ProgressReportEnd'
              WHEN event_type = 'error' THEN 'Error' ELSE 'CommandEnd' END AS OperationName,
         CASE WHEN event_type = 'view' THEN '3' WHEN event_type = 'click' AND k % 2 = 0 THEN '1'
              WHEN event_type = 'click' THEN '55' WHEN event_type = 'purchase' THEN '17'
              WHEN event_type = 'signup' THEN '38' ELSE '0' END AS EventSubclass_s,
         'RES' || CAST(user_id % 3 AS VARCHAR) AS Resource,
         'rg' || CAST(user_id % 2 AS VARCHAR) AS ResourceGroup,
         'MICROSOFT.ANALYSISSERVICES' AS ResourceProvider,
         CASE WHEN user_id % 5 = 0 THEN 'Excel' ELSE 'PowerBI' END AS ApplicationName_s,
         '{"Sources":"[{\"ReportId\":\"r' || CAST(k % 10 AS VARCHAR) || '\",\"VisualId\":\"v' || CAST(k % 7 AS VARCHAR) || '\"}]"}' AS ApplicationContext_s,
         CASE WHEN event_type = 'view' THEN 'EVALUATE SUMMARIZECOLUMNS(''t' || CAST(k % 5 AS VARCHAR) || '''[c' || CAST(k % 3 AS VARCHAR)
                   || '], ''u' || CAST(user_id % 4 AS VARCHAR) || '''[m' || CAST(k % 2 AS VARCHAR) || '])'
              WHEN event_type = 'click' THEN 'Column <pii>col' || CAST(k % 9 AS VARCHAR) || '</pii> re-encoded'
              WHEN event_type = 'error' THEN 'Error ' || CAST(k AS VARCHAR)
              ELSE 'Command ' || CAST(event_id AS VARCHAR) END AS TextData_s,
         CAST(user_id AS VARCHAR) AS SPID_s,
         'db' || CAST(k % 4 AS VARCHAR) || '.t' || CAST(k % 5 AS VARCHAR) AS ObjectPath_s,
         '<Object><Database>db' || CAST(k % 4 AS VARCHAR) || '</Database><Model>m' || CAST(k % 2 AS VARCHAR)
           || '</Model><Table>t' || CAST(k % 5 AS VARCHAR) || '</Table><Partition>p' || CAST(k % 3 AS VARCHAR)
           || '</Partition></Object>' AS ObjectReference_s,
         CAST(CAST(trunc(value * 100) AS INTEGER) AS VARCHAR) AS Duration_s,
         CASE WHEN k % 10 = 0 THEN '0' ELSE '1' END AS Success_s,
         CASE WHEN event_type = 'signup' AND k % 2 = 0 THEN '-1055784777' ELSE '0' END AS Error_s,
         CAST(k * 10 AS VARCHAR) AS IntegerData_s,
         CASE WHEN event_type = 'error' AND k % 3 = 0 THEN '' ELSE 'user' || CAST(user_id AS VARCHAR) END AS User_s,
         'db' || CAST(k % 4 AS VARCHAR) AS DatabaseName_s,
         'srv' || CAST(user_id % 2 AS VARCHAR) AS ServerName_s,
         'act-' || CAST(user_id AS VARCHAR) AS RootActivityId_g,
         ts - INTERVAL 1 MINUTE AS StartTime_t,
         ts AS EndTime_t
  FROM ev
)"""


# --------------------------------------------------------------------------- lineage edges
def lineage_edges_from_tpch(region: DataFrame, nation: DataFrame, customer: DataFrame, supplier: DataFrame,
                            lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Lineage edges (upstream -> downstream) over the star:
    region -> nation -> customer -> order, nation -> supplier -> part
    (supplier -> part from the distinct supplier/part pairs of lineitem).
    Node ids are ``<kind>:<key>``; the workspace of a node is its kind."""
    def node(kind, col):
        return F.concat(F.lit(kind + ":"), F.col(col).cast("string"))

    def edge(df, up_kind, up_col, down_kind, down_col, label):
        return df.select(node(down_kind, down_col).alias("DownStreamId"), F.lit(down_kind).alias("DownStreamWorkspaceId"),
                         F.lit(down_kind).alias("DownStreamType"), node(up_kind, up_col).alias("UpStreamId"),
                         F.lit(up_kind).alias("UpStreamWorkspaceId"), F.lit(up_kind).alias("UpStreamType"),
                         F.lit(label).alias("SourceDF"))
    parts = [
        edge(nation, "region", "n_regionkey", "nation", "n_nationkey", "region_to_nation"),
        edge(customer, "nation", "c_nationkey", "customer", "c_custkey", "nation_to_customer"),
        edge(orders, "customer", "o_custkey", "order", "o_orderkey", "customer_to_order"),
        edge(supplier, "nation", "s_nationkey", "supplier", "s_suppkey", "nation_to_supplier"),
        edge(lineitem.select("l_suppkey", "l_partkey").distinct(), "supplier", "l_suppkey", "part", "l_partkey",
             "supplier_to_part"),
    ]
    from ..operators.setops import union_edges
    return union_edges(parts)


EDGES_SQL = """
edges AS (
  SELECT 'nation:' || CAST(n_nationkey AS VARCHAR) AS DownStreamId, 'nation' AS DownStreamWorkspaceId, 'nation' AS DownStreamType,
         'region:' || CAST(n_regionkey AS VARCHAR) AS UpStreamId, 'region' AS UpStreamWorkspaceId, 'region' AS UpStreamType,
         'region_to_nation' AS SourceDF FROM nation
  UNION ALL
  SELECT 'customer:' || CAST(c_custkey AS VARCHAR), 'customer', 'customer',
         'nation:' || CAST(c_nationkey AS VARCHAR), 'nation', 'nation', 'nation_to_customer' FROM customer
  UNION ALL
  SELECT 'order:' || CAST(o_orderkey AS VARCHAR), 'order', 'order',
         'customer:' || CAST(o_custkey AS VARCHAR), 'customer', 'customer', 'customer_to_order' FROM orders
  UNION ALL
  SELECT 'supplier:' || CAST(s_suppkey AS VARCHAR), 'supplier', 'supplier',
         'nation:' || CAST(s_nationkey AS VARCHAR), 'nation', 'nation', 'nation_to_supplier' FROM supplier
  UNION ALL
  SELECT 'part:' || CAST(l_partkey AS VARCHAR), 'part', 'part',
         'supplier:' || CAST(l_suppkey AS VARCHAR), 'supplier', 'supplier', 'supplier_to_part'
  FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)
)"""


def lineage_names(region: DataFrame, nation: DataFrame, customer: DataFrame, supplier: DataFrame,
                  part: DataFrame) -> dict[str, DataFrame]:
    """Name tables for J1: workspaces (one per node kind), items with names
    and types, data sources (regions play the data sources) and reports."""
    spark = region.sparkSession
    kinds = ["region", "nation", "customer", "order", "supplier", "part"]
    # one row per node kind: a fixed-size table, safe to broadcast (a local
    # DataFrame carries no size statistics, so the planner cannot tell)
    workspaces = F.broadcast(spark.createDataFrame([(k, k.upper() + " WS") for k in kinds if k != "region"],
                                                   "WorkspaceId string, WorkspaceName string"))
    n = lambda kind, key: F.concat(F.lit(kind + ":"), F.col(key).cast("string"))
    items = (nation.select(n("nation", "n_nationkey").alias("id"), F.col("n_name").alias("name"), F.lit("Nation").alias("Type"))
             .unionByName(customer.select(n("customer", "c_custkey").alias("id"), F.col("c_name").alias("name"),
                                          F.lit("Customer").alias("Type")))
             .unionByName(supplier.select(n("supplier", "s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                          F.lit("Supplier").alias("Type"))))
    sources = region.select(n("region", "r_regionkey").alias("DatasourceId"), F.lit("Region").alias("DataSourceType"),
                            F.col("r_name").alias("path"), F.lit(None).cast("string").alias("extensionDataSourcePath"),
                            F.lit(None).cast("string").alias("server"))
    reports = part.select(n("part", "p_partkey").alias("ReportId"), F.col("p_name").alias("Name"))
    return {"workspaces": workspaces, "items": items, "sources": sources, "reports": reports}


NAMES_SQL = """
workspaces AS (SELECT * FROM (VALUES ('nation', 'NATION WS'), ('customer', 'CUSTOMER WS'), ('order', 'ORDER WS'),
                                     ('supplier', 'SUPPLIER WS'), ('part', 'PART WS')) t(WorkspaceId, WorkspaceName)),
items AS (
  SELECT 'nation:' || CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, 'Nation' AS Type FROM nation
  UNION ALL SELECT 'customer:' || CAST(c_custkey AS VARCHAR), c_name, 'Customer' FROM customer
  UNION ALL SELECT 'supplier:' || CAST(s_suppkey AS VARCHAR), s_name, 'Supplier' FROM supplier),
sources AS (SELECT DISTINCT 'region:' || CAST(r_regionkey AS VARCHAR) AS DatasourceId, 'Region' AS DataSourceType, r_name AS path,
                   CAST(NULL AS VARCHAR) AS extensionDataSourcePath, CAST(NULL AS VARCHAR) AS server FROM region),
reports AS (SELECT 'part:' || CAST(p_partkey AS VARCHAR) AS ReportId, p_name AS Name FROM part)"""


# --------------------------------------------------------------------------- SQL request history
def sql_requests_from_events(events: DataFrame) -> DataFrame:
    """SQL-endpoint request history rows from ``events``."""
    k = _k()
    et = F.col("event_type")
    return events.select(
        F.col("event_id").cast("string").alias("distributed_statement_id"),
        F.col("ts").cast("string").alias("start_time"),
        (F.col("value") * 1000).cast("long").alias("total_elapsed_time_ms"),
        (k * 10).alias("allocated_cpu_time_ms"),
        k.alias("row_count"),
        F.when(et == "error", F.lit("Failed")).otherwise(F.lit("Succeeded")).alias("status"),
        F.when(k % 3 == 0, F.lit(2)).otherwise(F.lit(0)).alias("result_cache_hit"),
        (k % 7).cast("double").alias("data_scanned_disk_mb"),
        (k % 5).cast("double").alias("data_scanned_memory_mb"),
        (k % 11).cast("double").alias("data_scanned_remote_storage_mb"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("login_name"))


SQL_REQUESTS_SQL = """
ev2 AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
sqlreq AS (
  SELECT CAST(event_id AS VARCHAR) AS distributed_statement_id, CAST(ts AS VARCHAR) AS start_time,
         CAST(trunc(value * 1000) AS BIGINT) AS total_elapsed_time_ms, k * 10 AS allocated_cpu_time_ms, k AS row_count,
         CASE WHEN event_type = 'error' THEN 'Failed' ELSE 'Succeeded' END AS status,
         CASE WHEN k % 3 = 0 THEN 2 ELSE 0 END AS result_cache_hit,
         CAST(k % 7 AS DOUBLE) AS data_scanned_disk_mb, CAST(k % 5 AS DOUBLE) AS data_scanned_memory_mb,
         CAST(k % 11 AS DOUBLE) AS data_scanned_remote_storage_mb, 'user' || CAST(user_id AS VARCHAR) AS login_name
  FROM ev2
)"""


# --------------------------------------------------------------------------- data-source instances
def datasources_from_suppliers(supplier: DataFrame) -> DataFrame:
    """Data-source instance rows (flattened connection details) from ``supplier``."""
    kind = F.col("s_suppkey") % 4
    return supplier.select(
        F.concat(F.lit("ds-"), F.col("s_suppkey").cast("string")).alias("DatasourceId"),
        F.when(kind == 0, F.lit("Extension")).when(kind == 1, F.lit("Sql")).when(kind == 2, F.lit("Web"))
         .otherwise(F.lit("File")).alias("DatasourceType"),
        F.when(kind == 0, F.concat(F.lit("Kind"), (F.col("s_nationkey") % 3).cast("string")))
         .alias("connectionDetails.extensionDataSourceKind"),
        F.when(kind == 2, F.concat(F.lit("https://"), F.col("s_name"), F.lit(".example"))).alias("connectionDetails.url"),
        F.when(kind.isin(0, 1), F.col("s_name")).alias("connectionDetails.server"),
        F.when(kind == 1, F.concat(F.lit("db"), F.col("s_nationkey").cast("string")))
         .when(kind == 0, F.lit(" ")).alias("connectionDetails.database"),
        F.when(kind == 3, F.concat(F.lit("/share/"), F.col("s_suppkey").cast("string")))
         .when((kind == 0) & (F.col("s_nationkey") % 2 == 0),
               F.concat(F.lit('{"host":"h'), F.col("s_nationkey").cast("string"), F.lit('.net","httpPath":"\\/sql\\/'),
                        F.col("s_suppkey").cast("string"), F.lit('"}')))
         .alias("connectionDetails.path"))


DATASOURCES_SQL = """
dsi AS (
  SELECT 'ds-' || CAST(s_suppkey AS VARCHAR) AS DatasourceId,
    CASE s_suppkey % 4 WHEN 0 THEN 'Extension' WHEN 1 THEN 'Sql' WHEN 2 THEN 'Web' ELSE 'File' END AS DatasourceType,
    CASE WHEN s_suppkey % 4 = 0 THEN 'Kind' || CAST(s_nationkey % 3 AS VARCHAR) END AS ext_kind,
    CASE WHEN s_suppkey % 4 = 2 THEN 'https://' || s_name || '.example' END AS url,
    CASE WHEN s_suppkey % 4 IN (0, 1) THEN s_name END AS server,
    CASE WHEN s_suppkey % 4 = 1 THEN 'db' || CAST(s_nationkey AS VARCHAR) WHEN s_suppkey % 4 = 0 THEN ' ' END AS database,
    CASE WHEN s_suppkey % 4 = 3 THEN '/share/' || CAST(s_suppkey AS VARCHAR)
         WHEN s_suppkey % 4 = 0 AND s_nationkey % 2 = 0
         THEN '{"host":"h' || CAST(s_nationkey AS VARCHAR) || '.net","httpPath":"\\/sql\\/' || CAST(s_suppkey AS VARCHAR) || '"}'
    END AS path
  FROM supplier
)"""


# --------------------------------------------------------------------------- model column catalogue
def model_columns_from_parts(part: DataFrame) -> DataFrame:
    """Model column metadata (one column per part) for the column rules:
    model = brand, table = type, column name = part name."""
    size = F.col("p_size")
    return part.select(
        F.col("p_brand").alias("ModelId"), F.col("p_type").alias("TableName"), F.col("p_name").alias("ColumnName"),
        F.when(size % 5 == 0, F.lit("Double")).when(size % 5 == 1, F.lit("Int64")).when(size % 5 == 2, F.lit("DateTime"))
         .when(size % 5 == 3, F.lit("String")).otherwise(F.lit("Decimal")).alias("DataType"),
        F.when(size % 7 == 0, F.lit("Calculated")).otherwise(F.lit("Data")).alias("Type"),
        (size % 3 == 0).alias("IsHidden"),
        F.when(size % 4 == 0, F.lit("Sum")).otherwise(F.lit("None")).alias("SummarizeBy"),
        F.when(size % 6 == 0, F.lit("mm/dd/yyyy")).otherwise(F.lit("")).alias("FormatString"),
        F.when(size % 9 == 0, F.lit("")).otherwise(F.concat(F.lit("src_"), F.col("p_partkey").cast("string"))).alias("SourceColumn"))


# --------------------------------------------------------------------------- refreshables
ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def refreshables_from_orders(orders: DataFrame) -> DataFrame:
    """Refreshable records (nested like the API's: capacity, group,
    refreshSchedule with day and time arrays, lastRefresh) built per order
    row - structs and arrays per row, no grouping."""
    k = F.col("o_orderkey")
    d = F.col("o_orderdate")
    st = F.col("o_orderstatus")
    iso = lambda c: F.date_format(c, ISO)
    last_start = d + F.make_dt_interval(F.lit(1), (k % 24).cast("int"))
    return orders.select(
        F.concat(F.lit("ref-"), k.cast("string")).alias("id"),
        F.concat(F.lit("model-"), k.cast("string")).alias("name"),
        F.lit("Dataset").alias("kind"),
        F.struct(F.concat(F.lit("cap-"), (F.col("o_custkey") % 7).cast("string")).alias("id")).alias("capacity"),
        F.struct(F.concat(F.lit("ws-"), (F.col("o_custkey") % 25).cast("string")).alias("id")).alias("group"),
        iso(d).alias("startTime"),
        F.when(st == "P", F.lit("0001-01-01T00:00:00Z"))
         .otherwise(iso(d + F.make_dt_interval((k % 5).cast("int")))).alias("endTime"),
        (F.col("o_totalprice") / 1000).alias("averageDuration"),
        (F.col("o_totalprice") / 2000).alias("medianDuration"),
        (k % 9).alias("refreshCount"),
        F.struct((st == "F").alias("enabled"), F.lit("UTC").alias("localTimeZoneId"),
                 F.array(F.date_format(d, "EEEE"), F.date_format(F.date_add(d, 2), "EEEE")).alias("days"),
                 F.array(F.concat(F.lpad((k % 10).cast("string"), 2, "0"), F.lit(":00")), F.lit("12:00")).alias("times"))
         .alias("refreshSchedule"),
        F.struct(F.when(st != "O", F.concat(F.lit("req-"), k.cast("string"))).alias("requestId"),
                 F.when(st == "F", F.lit("Completed")).otherwise(F.lit("Failed")).alias("status"),
                 F.lit("Scheduled").alias("refreshType"),
                 iso(last_start).alias("startTime"),
                 iso(last_start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (k % 3600).cast("int"))).alias("endTime"))
         .alias("lastRefresh"))


REFRESHABLES_SQL = """
rf AS (
  SELECT upper('cap-' || CAST(o_custkey % 7 AS VARCHAR)) AS CapacityId, upper('ws-' || CAST(o_custkey % 25 AS VARCHAR)) AS WorkspaceId,
         upper('ref-' || CAST(o_orderkey AS VARCHAR)) AS ItemId, 'model-' || CAST(o_orderkey AS VARCHAR) AS ItemName,
         o_orderstatus = 'F' AS IsRefreshEnabled, 'UTC' AS LocalTimeZoneId, 'Dataset' AS Kind,
         o_orderdate AS start_ts,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate + to_days(CAST(o_orderkey % 5 AS INTEGER)) END AS end_ts,
         o_orderstatus = 'P' AS end_sentinel,
         o_totalprice / 1000 AS RefreshAverageDuration, o_totalprice / 2000 AS RefreshMedianDuration,
         o_orderkey % 9 AS RefreshCount,
         dayname(o_orderdate) AS day1, dayname(o_orderdate + INTERVAL 2 DAY) AS day2,
         lpad(CAST(o_orderkey % 10 AS VARCHAR), 2, '0') || ':00' AS time1, '12:00' AS time2,
         CASE WHEN o_orderstatus <> 'O' THEN 'req-' || CAST(o_orderkey AS VARCHAR) END AS RequestId,
         CASE WHEN o_orderstatus = 'F' THEN 'Completed' ELSE 'Failed' END AS Status, 'Scheduled' AS RefreshType,
         o_orderdate + to_days(1) + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS last_start,
         o_orderdate + to_days(1) + to_hours(CAST(o_orderkey % 24 AS INTEGER)) + to_seconds(CAST(o_orderkey % 3600 AS INTEGER)) AS last_end
  FROM orders
)"""


# --------------------------------------------------------------------------- tenant scan
def scan_workspaces_from_customers(customer: DataFrame) -> DataFrame:
    """Scanned workspaces (the tenant-scan shape: one workspace per customer
    with users, datasets -> tables -> columns/measures/sources, reports and
    lakehouses as arrays of structs), built per row - no grouping."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    ks, ns = k.cast("string"), n.cast("string")
    cat = lambda *p: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in p])
    created = cat("2023-", F.lpad((n % 12 + 1).cast("string"), 2, "0"), "-01T00:00:00")
    right = F.when(k % 3 == 0, "Admin").when(k % 3 == 1, "Member").otherwise("Viewer")
    ws_user = F.struct(cat("u", ks, "@x").alias("identifier"), cat("User ", ks).alias("displayName"),
                       cat("u", ks, "@x").alias("emailAddress"), right.alias("groupUserAccessRight"),
                       F.lit("User").alias("principalType"), F.lit("Member").alias("userType"), cat("g", ks).alias("graphId"))
    table = F.struct(
        cat("Sales", ns).alias("name"), (k % 2 == 0).alias("isHidden"), F.lit("Import").alias("storageMode"),
        F.array(F.struct(F.lit("Amount").alias("name"), F.lit("Double").alias("dataType"), F.lit("Data").alias("columnType"),
                         F.lit(False).alias("isHidden"), F.lit(None).cast("string").alias("expression")),
                F.struct(cat("Key", ns).alias("name"), F.lit("Int64").alias("dataType"), F.lit("Data").alias("columnType"),
                         F.lit(True).alias("isHidden"), F.lit(None).cast("string").alias("expression"))).alias("columns"),
        F.array(F.struct(cat("Total ", ks).alias("name"), F.lit("SUM(Sales[Amount])").alias("expression"),
                         F.lit(False).alias("isHidden"))).alias("measures"),
        F.array(F.struct(cat("let x = ", ks).alias("expression"), F.lit(None).cast("string").alias("schemaName"))).alias("source"))
    dataset = F.struct(
        cat("sm-", ks).alias("id"), cat("Model ", ks).alias("name"), cat("owner", ns, "@x").alias("configuredById"),
        created.alias("createdDate"),
        F.when(k % 2 == 0, "PbixInImportMode").otherwise("InDirectQueryMode").alias("contentProviderType"),
        F.lit("Abf").alias("targetStorageMode"),
        F.array(F.struct(cat("ds-", (k % 100).cast("string")).alias("datasourceInstanceId"))).alias("datasourceUsages"),
        F.array(table).alias("tables"),
        F.array(F.struct(cat("u", ks, "@x").alias("identifier"), F.lit("ReadWrite").alias("datasetUserAccessRight"),
                         F.lit("User").alias("principalType"))).alias("users"))
    report = F.struct(
        cat("rep-", ks).alias("id"), cat("Report ", ks).alias("name"), cat("sm-", ks).alias("datasetId"),
        cat("ws-", ks).alias("datasetWorkspaceId"), F.lit("PowerBIReport").alias("reportType"),
        created.alias("createdDateTime"), created.alias("modifiedDateTime"),
        F.array(F.struct(cat("v", ks, "@x").alias("identifier"),
                         F.when(k % 2 == 1, F.lit("Owner")).alias("reportUserAccessRight"),
                         F.lit("Read").alias("artifactUserAccessRight"), F.lit("User").alias("principalType"))).alias("users"))
    lake = F.struct(cat("lh-", ks).alias("id"), cat("LH ", ks).alias("name"), F.lit("").alias("description"),
                    F.lit("Active").alias("state"), created.alias("createdDate"), cat("o", ns).alias("createdById"),
                    F.array(F.struct(cat("w", ks, "@x").alias("identifier"),
                                     F.lit("Read").alias("artifactUserAccessRight"))).alias("users"))
    return customer.select(
        cat("ws-", ks).alias("id"), F.col("c_name").alias("name"), F.lit("Workspace").alias("type"),
        F.lit("Active").alias("state"), cat("cap-", ns).alias("capacityId"),
        F.array(ws_user).alias("users"), F.array(dataset).alias("datasets"), F.array(report).alias("reports"),
        F.filter(F.array(lake), lambda x: k % 4 == 0).alias("Lakehouse"))


SCAN_SQL = """
sc AS (
  SELECT c_custkey AS k, c_nationkey AS n, c_name,
         'ws-' || CAST(c_custkey AS VARCHAR) AS ws, '2023-' || lpad(CAST(c_nationkey % 12 + 1 AS VARCHAR), 2, '0') || '-01T00:00:00' AS created
  FROM customer
)"""


# --------------------------------------------------------------------------- small feeds
def _cat(*p):
    return F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in p])


def active_items_from_parts(part: DataFrame) -> DataFrame:
    """Active-item records (one per part; every 50th carries the all-zero id)."""
    k = F.col("p_partkey")
    return part.select(
        F.when(k % 50 == 0, F.lit("00000000-0000-0000-0000-000000000000")).otherwise(_cat("item-", k)).alias("id"),
        F.col("p_name").alias("name"), F.col("p_type").alias("type"), F.lit("Active").alias("state"),
        _cat("ws-", k % 30).alias("workspaceId"), _cat("cap-", F.col("p_size") % 7).alias("capacityId"),
        F.struct(F.struct(_cat("u", F.col("p_size"), "@x").alias("userPrincipalName")).alias("userDetails"))
         .alias("creatorPrincipal"))


def domains_from_customers(customer: DataFrame) -> DataFrame:
    """Domain records: one main domain per market segment, one sub-domain per customer."""
    main = customer.select(_cat("dom-", F.lower("c_mktsegment")).alias("id"), F.col("c_mktsegment").alias("displayName"),
                           F.lit(None).cast("string").alias("parentDomainId"),
                           F.lit("AllTenant").alias("contributorsScope")).distinct()
    sub = customer.select(_cat("dom-c", F.col("c_custkey")).alias("id"), F.col("c_name").alias("displayName"),
                          _cat("dom-", F.lower("c_mktsegment")).alias("parentDomainId"),
                          F.lit("AdminsOnly").alias("contributorsScope"))
    return main.unionByName(sub)


def capacities_from_suppliers(supplier: DataFrame) -> DataFrame:
    """Capacity records with admin and user arrays (one per supplier)."""
    k = F.col("s_suppkey")
    return supplier.select(_cat("cap-", k).alias("id"), F.col("s_name").alias("displayName"),
                           F.array(F.col("s_name")).alias("admins"),
                           F.array(_cat("u", F.col("s_nationkey"), "@x"), _cat("v", k % 13, "@x")).alias("users"))


def tenant_settings_from_customers(customer: DataFrame) -> DataFrame:
    """Tenant-setting snapshot rows with enabled security groups."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    return customer.select(
        _cat("Setting", k).alias("settingName"), F.lit("2024-01-30 06:00:00").cast("timestamp").alias("TransferDateTime"),
        (F.col("c_acctbal") > 0).alias("enabled"),
        F.array(F.struct(_cat("g", n).alias("graphId"), _cat("Group ", n).alias("name")),
                F.struct(_cat("h", k % 3).alias("graphId"), _cat("Team ", k % 3).alias("name"))).alias("enabledSecurityGroups"))


def overrides_from_suppliers(supplier: DataFrame) -> DataFrame:
    """Delegated-override records: two capacity-level settings per supplier."""
    def setting(group, title, name, enabled):
        return F.struct(F.lit(group).alias("tenantSettingGroup"), F.lit(title).alias("title"),
                        F.lit("Tenant").alias("delegatedFrom"), F.lit(name).alias("settingName"),
                        enabled.alias("enabled"), F.lit(True).alias("canSpecifySecurityGroups"))
    return supplier.select(_cat("cap-", F.col("s_suppkey")).alias("id"),
                           F.array(setting("Export", "Export to Excel", "ExportToExcel", F.col("s_acctbal") > 0),
                                   setting("Publish", "Publish to web", "PublishToWeb", F.col("s_nationkey") % 2 == 0))
                           .alias("tenantSettings"))


def shared_items_from_customers(customer: DataFrame) -> DataFrame:
    """Widely-shared artifact records with a nested sharer."""
    n = F.col("c_nationkey")
    return customer.select(
        _cat("art-", F.col("c_custkey")).alias("artifactId"), F.col("c_name").alias("displayName"),
        F.lit("Report").alias("artifactType"), F.lit("View").alias("accessRight"), F.lit("PublishToWeb").alias("shareType"),
        F.struct(_cat("Sharer ", n).alias("displayName"), _cat("s", n, "@x").alias("emailAddress"),
                 _cat("g", n).alias("graphId"), _cat("s", n, "@x").alias("identifier"),
                 F.lit("User").alias("principalType")).alias("sharer"))


# --------------------------------------------------------------------------- gateway logs
def _ts_text(c):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


def datasource_text(ln, sk, pk):
    """The DataSource log field: a JSON list of JSON object texts (one or
    two sources), or broken text for line 7."""
    src_sql = _cat('{"kind":"Sql","path":"srv', sk, ';db"}')
    src_web = _cat('{"ConnectorType":"Web","url":"http://p', pk, '","mode":"x"}')
    src_file = _cat('{"kind":"File","path":"/f', pk, '"}')
    lst = lambda *xs: F.to_json(F.array(*xs))
    return (F.when(ln == 7, F.lit("broken"))
            .when(ln % 3 == 0, lst(src_sql)).when(ln % 3 == 1, lst(src_web)).otherwise(lst(src_file, src_sql)))


def query_execution_logs_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Gateway query-execution log rows (all text, as the log reader returns
    them), one per line item; the DataSource column is a JSON list of JSON
    object texts (one or two sources, or broken text)."""
    ln, sk, pk = F.col("l_linenumber"), F.col("l_suppkey"), F.col("l_partkey")
    ds = datasource_text(ln, sk, pk)
    end = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), (F.col("l_orderkey") % 24).cast("int"))
    return lineitem.select(
        _cat("gw-", sk % 5).alias("GatewayObjectId"), _cat("r", F.col("l_orderkey")).alias("RequestId"),
        ds.alias("DataSource"), _cat("t", ln).alias("QueryTrackingId"),
        _ts_text(end).alias("QueryExecutionEndTimeUTC"),
        (F.col("l_quantity") * 100).cast("long").cast("string").alias("QueryExecutionDuration(ms)"),
        F.lit("Query").alias("QueryType"),
        (F.col("l_extendedprice") / 10).cast("long").cast("string").alias("DataReadingAndSerializationDuration(ms)"),
        (pk % 97).cast("string").alias("SpoolingDiskWritingDuration(ms)"),
        (pk % 89).cast("string").alias("SpoolingDiskReadingDuration(ms)"),
        (pk * 1024).cast("string").alias("SpoolingTotalDataSize(byte)"),
        _ts_text(end).alias("DataProcessingEndTimeUTC"),
        (F.col("l_quantity") * 7).cast("long").cast("string").alias("DataProcessingDuration(ms)"),
        F.when(F.col("l_returnflag") == "R", F.lit("N")).otherwise(F.lit("Y")).alias("Success"),
        F.when(F.col("l_returnflag") == "R", _cat("timeout on p", pk)).alias("ErrorMessage"))


QUERY_EXECUTION_SQL = """
qe_base AS (
  SELECT 'gw-' || CAST(l_suppkey % 5 AS VARCHAR) AS GatewayObjectId, 'r' || CAST(l_orderkey AS VARCHAR) AS RequestId,
         't' || CAST(l_linenumber AS VARCHAR) AS QueryTrackingId, l_linenumber AS ln, l_suppkey AS sk, l_partkey AS pk,
         l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS end_ts,
         CAST(trunc(l_quantity * 100) AS BIGINT) AS qdur, CAST(trunc(l_extendedprice / 10) AS BIGINT) AS rdur,
         CAST(l_partkey % 97 AS BIGINT) AS wdur, CAST(l_partkey % 89 AS BIGINT) AS sdur, CAST(l_partkey * 1024 AS BIGINT) AS bytes,
         CAST(trunc(l_quantity * 7) AS BIGINT) AS pdur,
         CASE WHEN l_returnflag = 'R' THEN 'N' ELSE 'Y' END AS Success
  FROM lineitem),
qe AS (
  SELECT *, 'Sql' AS kind, 'srv' || CAST(sk AS VARCHAR) || ';db' AS path FROM qe_base WHERE ln <> 7 AND ln % 3 = 0
  UNION ALL SELECT *, 'Web', 'http://p' || CAST(pk AS VARCHAR) || ';x' FROM qe_base WHERE ln <> 7 AND ln % 3 = 1
  UNION ALL SELECT *, 'File', '/f' || CAST(pk AS VARCHAR) FROM qe_base WHERE ln <> 7 AND ln % 3 = 2
  UNION ALL SELECT *, 'Sql', 'srv' || CAST(sk AS VARCHAR) || ';db' FROM qe_base WHERE ln <> 7 AND ln % 3 = 2)"""


def query_start_logs_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Gateway query-start log rows: base64 query text and a JSON evaluation
    context whose ApplicationContext value is itself JSON text."""
    ln, sk, pk, ok = F.col("l_linenumber"), F.col("l_suppkey"), F.col("l_partkey"), F.col("l_orderkey")
    text = _cat("SELECT * FROM t", pk, "\nWHERE q > ", ln)
    app = F.to_json(F.struct(_cat("m", pk % 50).alias("DatasetId"),
                             F.array(F.struct(_cat("r", pk % 20).alias("ReportId"), _cat("v", ln).alias("VisualId"),
                                              F.struct(F.lit("Web").alias("ConsumptionMethod"),
                                                       _cat("s", ok % 100).alias("UserSession")).alias("HostProperties")))
                             .alias("Sources")))
    kv = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    ctx = F.to_json(F.struct(F.array(F.struct(
        F.lit("svc").alias("serviceName"),
        F.array(kv("DatasetId", _cat("m", pk % 50)), kv("WorkspaceId", _cat("w", sk % 10)),
                kv("Host Context Type", F.when(ln % 2 == 0, F.lit("Refresh")).otherwise(F.lit("Query"))),
                kv("ApplicationContext", app)).alias("traceIds"))).alias("serviceTraceContexts")))
    start = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), (ok % 24).cast("int"))
    return lineitem.select(
        _cat("gw-", sk % 5).alias("GatewayObjectId"), _cat("r", ok).alias("RequestId"), _cat("t", ln).alias("QueryTrackingId"),
        F.lit("[]").alias("DataSource"), _ts_text(start).alias("QueryExecutionStartTimeUTC"), F.lit("Query").alias("QueryType"),
        F.base64(F.encode(text, "UTF-8")).alias("QueryText"), ctx.alias("EvaluationContext"))


QUERY_START_SQL = """
qs AS (
  SELECT 'gw-' || CAST(l_suppkey % 5 AS VARCHAR) AS GatewayObjectId, 'r' || CAST(l_orderkey AS VARCHAR) AS RequestId,
         't' || CAST(l_linenumber AS VARCHAR) AS QueryTrackingId, l_linenumber AS ln, l_suppkey AS sk, l_partkey AS pk,
         l_orderkey AS ok, l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS start_ts
  FROM lineitem)"""


def mashup_logs_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Gateway mashup-evaluation log rows with a number-list TotalRows text."""
    ln, ok = F.col("l_linenumber"), F.col("l_orderkey")
    return lineitem.select(
        _cat("gw-", F.col("l_suppkey") % 5).alias("GatewayObjectId"), _cat("c", ok % 7).alias("ConnectionId"),
        _cat("r", ok).alias("RequestId"), _cat("t", ln).alias("QueryTrackingId"), F.lit("[]").alias("DataSource"),
        _cat("[", F.col("l_quantity").cast("long"), ",", ln, "]").alias("TotalRows"),
        (F.col("l_partkey") * 10).cast("string").alias("TotalBytes"),
        (F.col("l_quantity") * 11).cast("long").cast("string").alias("TotalProcessorTime(ms)"),
        _ts_text(F.col("l_shipdate")).alias("EndTimeUTC"),
        (F.col("l_partkey") * 100).cast("string").alias("AverageWorkingSet(byte)"),
        (F.col("l_partkey") * 150).cast("string").alias("MaxWorkingSet(byte)"),
        (F.col("l_suppkey") * 100).cast("string").alias("AverageCommit(byte)"),
        (F.col("l_suppkey") * 130).cast("string").alias("MaxCommit(byte)"),
        F.round(F.col("l_discount") * 100).cast("long").cast("string").alias("AveragePercentProcessorTime"),
        (F.round(F.col("l_tax") * 100) + 50).cast("long").cast("string").alias("MaxPercentProcessorTime"),
        F.lit("0").alias("AverageIODataBytesPerSecond"), F.lit("0").alias("MaxIODataBytesPerSecond"))


def counter_logs_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Gateway system-counter log rows (one counter reading per line item)."""
    ln = F.col("l_linenumber")
    name = F.when(ln % 3 == 0, F.lit("CPU")).when(ln % 3 == 1, F.lit("Memory")).otherwise(F.lit("Threads"))
    st = F.col("l_shipdate")
    return lineitem.select(
        _cat("gw-", F.col("l_suppkey") % 5).alias("GatewayObjectId"), _ts_text(st).alias("AggregationStartTimeUTC"),
        _ts_text(st + F.make_dt_interval(F.lit(0), F.lit(1))).alias("AggregationEndTimeUTC"), name.alias("CounterName"),
        (F.col("l_quantity") + 1).cast("string").alias("Max"), F.col("l_discount").cast("string").alias("Min"),
        (F.col("l_quantity") / 2).cast("string").alias("Average"))


def workspaces_from_customers(customer: DataFrame) -> DataFrame:
    """Workspace API records (no ``description`` field, as some feeds lack it)."""
    k = F.col("c_custkey")
    return customer.select(
        _cat("ws-", k).alias("id"), F.col("c_name").alias("name"), F.lit("Workspace").alias("type"),
        F.when(F.col("c_acctbal") < 0, F.lit("Deleted")).otherwise(F.lit("Active")).alias("state"),
        _cat("cap-", F.col("c_nationkey")).alias("capacityId"), F.lit("Completed").alias("capacityMigrationStatus"),
        F.when(k % 2 == 0, F.lit("Small")).otherwise(F.lit("Large")).alias("defaultDatasetStorageFormat"),
        (F.col("c_acctbal") > 5000).alias("isOnDedicatedCapacity"), F.lit(False).alias("isReadOnly"),
        (k % 5 == 0).alias("hasWorkspaceLevelSettings"))


def workspace_domains_from_customers(customer: DataFrame) -> DataFrame:
    """Workspace -> domain assignments (only some workspaces have one)."""
    return customer.filter(F.col("c_custkey") % 3 == 0).select(
        _cat("ws-", F.col("c_custkey")).alias("id"), _cat("cap-", F.col("c_nationkey")).alias("capacityId"),
        _cat("dom-", F.lower("c_mktsegment")).alias("domainId"))


def aggregation_logs_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Gateway query-execution aggregation log rows (one per line item; repeated rows collapse)."""
    ln = F.col("l_linenumber")
    st = F.col("l_shipdate")
    src = _cat('{"kind":"Sql","path":"srv', F.col("l_suppkey") % 3, ';db"}')
    return lineitem.select(
        _cat("gw-", F.col("l_suppkey") % 5).alias("GatewayObjectId"), _ts_text(st).alias("AggregationStartTimeUTC"),
        _ts_text(st + F.make_dt_interval(F.lit(0), F.lit(1))).alias("AggregationEndTimeUTC"),
        F.to_json(F.array(src)).alias("DataSource"),
        F.when(F.col("l_returnflag") == "R", F.lit("N")).otherwise(F.lit("Y")).alias("Success"),
        (ln * 100).cast("string").alias("AverageQueryExecutionDuration(ms)"),
        (ln * 200).cast("string").alias("MaxQueryExecutionDuration(ms)"),
        (ln * 10).cast("string").alias("MinQueryExecutionDuration(ms)"), F.lit("Query").alias("QueryType"),
        (ln * 50).cast("string").alias("AverageDataProcessingDuration(ms)"),
        (ln * 80).cast("string").alias("MaxDataProcessingDuration(ms)"),
        (ln * 5).cast("string").alias("MinDataProcessingDuration(ms)"), ln.cast("string").alias("Count"))


# --------------------------------------------------------------------------- model metadata
MEASURE_TEMPLATES_SQL = """CASE l_orderkey % 10
    WHEN 0 THEN 'SUM(Sales[Amount]) + 0'
    WHEN 1 THEN 'DIVIDE([Total], [Count], 0)'
    WHEN 2 THEN 'IFERROR([Total] / [Count], 0)'
    WHEN 3 THEN 'CALCULATE([Total], FILTER(Sales, [Qty] > ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '))'
    WHEN 4 THEN '[Total] / [Count]'
    WHEN 5 THEN '1 - (SUM(Sales[Cost]) / SUM(Sales[Amount]))'
    WHEN 6 THEN 'EVALUATEANDLOG([Total])'
    WHEN 7 THEN 'COUNTROWS(INTERSECT(VALUES(A[x]), VALUES(B[x])))'
    WHEN 8 THEN 'DIVIDE([Total], [Count]) + 1'
    ELSE 'CALCULATE([Total], FILTER(''Sales'', ''Sales''[Region] = "EU"))' END"""


MEASURE_REFS_SQL = """
li AS (SELECT l_orderkey % 7 AS k, l_linenumber, 'model-' || CAST(l_suppkey % 20 AS VARCHAR) AS ModelId,
              'Sales' || CAST(l_partkey % 5 AS VARCHAR) AS TableName,
              'M' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS MeasureName,
              'Sales' || CAST(l_suppkey % 5 AS VARCHAR) AS rt,
              'Col' || CAST((l_suppkey + l_linenumber * 10) % 30 AS VARCHAR) AS rc,
              'M' || CAST(l_orderkey AS VARCHAR) || CASE WHEN l_linenumber > 4 THEN '_4' ELSE '_1' END AS rm
       FROM lineitem),
m AS (SELECT ModelId, TableName, MeasureName, CASE k
          WHEN 0 THEN 'SUM(' || rt || '[' || rc || '])'
          WHEN 1 THEN 'SUM([' || rc || '])'
          WHEN 2 THEN 'SUM(' || chr(39) || rt || chr(39) || '[' || rc || '])'
          WHEN 3 THEN 'SUM(Fact' || rt || '[' || rc || ']) + Other[' || rc || ']'
          WHEN 4 THEN '[' || rm || ']'
          WHEN 5 THEN TableName || '[' || rm || '] + 1'
          ELSE '[' || rc || '] + ' || chr(39) || rt || chr(39) || '[' || rc || ']' END AS Expression,
        l_linenumber % 4 = 0 AS IsHidden FROM li),
cols AS (SELECT DISTINCT 'model-' || CAST(p_partkey % 20 AS VARCHAR) AS ModelId,
                CASE WHEN p_size % 6 = 5 THEN 'FactSales0' ELSE 'Sales' || CAST(p_size % 5 AS VARCHAR) END AS TableName,
                'Col' || CAST(p_partkey % 30 AS VARCHAR) AS ColumnName FROM part),
deps AS (SELECT ModelId, CASE WHEN l_linenumber = 7 THEN 'Calc Column' ELSE 'Measure' END AS ObjectType, TableName,
                MeasureName AS ObjectName, CASE WHEN k IN (4, 5) THEN 'Measure' ELSE 'Column' END AS ReferencedObjectType,
                CASE WHEN k IN (4, 5) THEN TableName WHEN k = 6 THEN 'Other' ELSE rt END AS ReferencedTable,
                CASE WHEN k IN (4, 5) THEN rm ELSE rc END AS ReferencedObject FROM li)
"""


def measure_refs_from_tpch(lineitem: DataFrame, part: DataFrame) -> dict[str, DataFrame]:
    """Measures, columns and calculation dependencies for the reference rules:
    one measure and one dependency row per line item (column references
    written qualified, quoted, bare or under other table names; measure
    references bare or table-qualified), columns from parts."""
    k = F.col("l_orderkey") % 7
    ln = F.col("l_linenumber")
    li = lineitem.select(
        k.alias("k"), ln, _cat("model-", F.col("l_suppkey") % 20).alias("ModelId"),
        _cat("Sales", F.col("l_partkey") % 5).alias("TableName"),
        _cat("M", F.col("l_orderkey"), "_", ln).alias("MeasureName"), _cat("Sales", F.col("l_suppkey") % 5).alias("rt"),
        _cat("Col", (F.col("l_suppkey") + ln * 10) % 30).alias("rc"),
        _cat("M", F.col("l_orderkey"), F.when(ln > 4, F.lit("_4")).otherwise(F.lit("_1"))).alias("rm"))
    rt, rc, rm, kk = F.col("rt"), F.col("rc"), F.col("rm"), F.col("k")
    expr = (F.when(kk == 0, _cat("SUM(", rt, "[", rc, "])"))
            .when(kk == 1, _cat("SUM([", rc, "])"))
            .when(kk == 2, _cat("SUM('", rt, "'[", rc, "])"))
            .when(kk == 3, _cat("SUM(Fact", rt, "[", rc, "]) + Other[", rc, "]"))
            .when(kk == 4, _cat("[", rm, "]"))
            .when(kk == 5, _cat(F.col("TableName"), "[", rm, "] + 1"))
            .otherwise(_cat("[", rc, "] + '", rt, "'[", rc, "]")))
    measures = li.select("ModelId", "TableName", "MeasureName", expr.alias("Expression"),
                         (ln % 4 == 0).alias("IsHidden"))
    is_m = kk.isin(4, 5)
    deps = li.select(
        "ModelId", F.when(ln == 7, F.lit("Calc Column")).otherwise(F.lit("Measure")).alias("ObjectType"), "TableName",
        F.col("MeasureName").alias("ObjectName"),
        F.when(is_m, F.lit("Measure")).otherwise(F.lit("Column")).alias("ReferencedObjectType"),
        F.when(is_m, F.col("TableName")).when(kk == 6, F.lit("Other")).otherwise(rt).alias("ReferencedTable"),
        F.when(is_m, rm).otherwise(rc).alias("ReferencedObject"))
    size = F.col("p_size")
    columns = part.select(
        _cat("model-", F.col("p_partkey") % 20).alias("ModelId"),
        F.when(size % 6 == 5, F.lit("FactSales0")).otherwise(_cat("Sales", size % 5)).alias("TableName"),
        _cat("Col", F.col("p_partkey") % 30).alias("ColumnName")).distinct()
    return {"measures": measures, "columns": columns, "dependencies": deps}


def measures_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Model measure metadata (one measure per line item, DAX-like text from
    ten templates) for the measure-text rules."""
    t = F.col("l_orderkey") % 10
    expr = (F.when(t == 0, F.lit("SUM(Sales[Amount]) + 0"))
            .when(t == 1, F.lit("DIVIDE([Total], [Count], 0)"))
            .when(t == 2, F.lit("IFERROR([Total] / [Count], 0)"))
            .when(t == 3, _cat("CALCULATE([Total], FILTER(Sales, [Qty] > ", F.col("l_quantity").cast("long"), "))"))
            .when(t == 4, F.lit("[Total] / [Count]"))
            .when(t == 5, F.lit("1 - (SUM(Sales[Cost]) / SUM(Sales[Amount]))"))
            .when(t == 6, F.lit("EVALUATEANDLOG([Total])"))
            .when(t == 7, F.lit("COUNTROWS(INTERSECT(VALUES(A[x]), VALUES(B[x])))"))
            .when(t == 8, F.lit("DIVIDE([Total], [Count]) + 1"))
            .otherwise(F.lit("CALCULATE([Total], FILTER('Sales', 'Sales'[Region] = \"EU\"))")))
    rf = F.col("l_returnflag")
    return lineitem.select(
        _cat("model-", F.col("l_suppkey") % 20).alias("ModelId"), _cat("Sales", F.col("l_partkey") % 5).alias("TableName"),
        _cat("M", F.col("l_orderkey"), "_", F.col("l_linenumber")).alias("MeasureName"), expr.alias("Expression"),
        (F.col("l_linenumber") % 4 == 0).alias("IsHidden"),
        F.when(rf == "A", F.lit("#,0")).when(rf == "N", F.lit("0.0%")).otherwise(F.lit("")).alias("FormatString"),
        F.when(F.col("l_linestatus") == "F", F.lit("doc")).otherwise(F.lit("")).alias("Description"))


def relationships_from_orders(orders: DataFrame) -> DataFrame:
    """Model relationship metadata (one relationship per order)."""
    k = F.col("o_orderkey")
    return orders.select(
        _cat("model-", F.col("o_custkey") % 20).alias("ModelId"), _cat("Sales", k % 5).alias("FromTable"),
        _cat("Key", k % 7).alias("FromColumn"), _cat("Dim", k % 3).alias("ToTable"), F.lit("Id").alias("ToColumn"),
        F.lit("Many").alias("FromCardinality"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Many")).otherwise(F.lit("One")).alias("ToCardinality"),
        F.when(F.col("o_orderstatus") == "F", F.lit("BothDirections")).otherwise(F.lit("OneDirection"))
         .alias("CrossFilteringBehavior"),
        (k % 4 != 0).alias("IsActive"))


def model_catalogue_from_parts(part: DataFrame, lineitem: DataFrame, customer: DataFrame) -> dict[str, DataFrame]:
    """A model metadata catalogue built per row: tables and partitions from
    ``part`` (model = partkey % 20), relationships from ``lineitem``, row-level
    security roles from ``customer``, calculation items from ``part``."""
    pk, sz = F.col("p_partkey"), F.col("p_size")
    model = _cat("model-", pk % 20)
    tname = (F.when(sz % 10 == 0, _cat("LocalDateTable_", pk)).when(sz % 10 == 1, _cat("Calendar", pk))
             .otherwise(_cat("T", F.floor(pk / 20))))
    tables = part.select(model.alias("ModelId"), tname.alias("TableName"), F.lit(False).alias("IsHidden"),
                         F.when(sz % 3 == 0, F.lit("Time")).otherwise(F.lit("")).alias("DataCategory"),
                         F.lit("d").alias("Description"), (sz % 7 == 0).alias("IsCalculated"),
                         (sz % 14 == 0).alias("IsFieldParameter"), (sz % 9 == 0).alias("IsCalculationGroup"),
                         (F.col("p_retailprice") * 30000).cast("long").alias("RowCount"))
    p1 = part.select(model.alias("ModelId"), tname.alias("TableName"), F.lit("p1").alias("PartitionName"),
                     F.lit("Import").alias("Mode"), F.lit("M").alias("SourceType"),
                     F.lit('let Source = Sql.Database("s", "d") in Source').alias("Expression"),
                     F.lit(None).cast("string").alias("DataCoverageDefinition"))
    p2 = part.filter(sz % 4 == 0).select(
        model.alias("ModelId"), tname.alias("TableName"), F.lit("p2").alias("PartitionName"),
        F.when(sz % 8 == 0, F.lit("DirectQuery")).otherwise(F.lit("Dual")).alias("Mode"), F.lit("M").alias("SourceType"),
        F.lit('let x = Table.Group("a") in x').alias("Expression"),
        F.when(sz % 16 == 0, F.lit("x")).alias("DataCoverageDefinition"))
    rel = lineitem.select(
        _cat("model-", F.col("l_partkey") % 20).alias("ModelId"), _cat("T", F.floor(F.col("l_partkey") / 20)).alias("FromTable"),
        _cat("K", F.col("l_linenumber")).alias("FromColumn"), _cat("T", F.floor(F.col("l_suppkey") / 20)).alias("ToTable"),
        F.lit("Id").alias("ToColumn"), F.lit("Many").alias("FromCardinality"),
        F.when(F.col("l_returnflag") == "R", F.lit("Many")).otherwise(F.lit("One")).alias("ToCardinality"),
        F.when(F.col("l_linestatus") == "F", F.lit("BothDirections")).otherwise(F.lit("OneDirection"))
         .alias("CrossFilteringBehavior"), F.lit(True).alias("IsActive"))
    ck = F.col("c_custkey")
    rls = customer.select(
        _cat("model-", ck % 20).alias("ModelId"), _cat("T", F.floor(ck / 20)).alias("TableName"), _cat("Role", ck).alias("RoleName"),
        F.when(ck % 4 == 0, F.lit("[Email] = USERPRINCIPALNAME()")).when(ck % 4 == 1, F.lit('LEFT([Region], 2) = "EU"'))
         .when(ck % 4 == 2, F.lit("TRUE()")).otherwise(F.lit("UPPER([User]) = USERNAME()")).alias("FilterExpression"))
    items = part.filter(sz % 18 == 0).select(model.alias("ModelId"), tname.alias("TableName"), _cat("Item", pk).alias("ItemName"),
                                             F.when(pk % 2 == 0, F.lit("")).otherwise(F.lit("SELECTEDMEASURE()")).alias("Expression"))
    models = part.select(model.alias("ModelId")).distinct().select(
        "ModelId", F.lit(False).alias("IsDirectLake"), F.lit(False).alias("UsesView"))
    return {"models": models, "tables": tables, "partitions": p1.unionByName(p2), "relationships": rel, "rls": rls,
            "calc_items": items}


CATALOGUE_SQL = """
tb AS (SELECT 'model-' || CAST(p_partkey % 20 AS VARCHAR) AS ModelId,
              CASE WHEN p_size % 10 = 0 THEN 'LocalDateTable_' || CAST(p_partkey AS VARCHAR)
                   WHEN p_size % 10 = 1 THEN 'Calendar' || CAST(p_partkey AS VARCHAR)
                   ELSE 'T' || CAST(CAST(floor(p_partkey / 20) AS BIGINT) AS VARCHAR) END AS TableName,
              p_size % 3 = 0 AS is_time, p_size % 7 = 0 AS IsCalculated, p_size % 14 = 0 AS IsFieldParameter,
              p_size % 9 = 0 AS IsCalculationGroup, CAST(trunc(p_retailprice * 30000) AS BIGINT) AS RowCount, p_size, p_partkey
       FROM part),
pt AS (SELECT ModelId, TableName, 'p1' AS PartitionName, 'Import' AS Mode, false AS has_cov, false AS heavy FROM tb
       UNION ALL SELECT ModelId, TableName, 'p2', CASE WHEN p_size % 8 = 0 THEN 'DirectQuery' ELSE 'Dual' END,
                        p_size % 16 = 0, true FROM tb WHERE p_size % 4 = 0),
rl AS (SELECT 'model-' || CAST(l_partkey % 20 AS VARCHAR) AS ModelId, 'T' || CAST(CAST(floor(l_partkey / 20) AS BIGINT) AS VARCHAR) AS FromTable,
              'T' || CAST(CAST(floor(l_suppkey / 20) AS BIGINT) AS VARCHAR) AS ToTable, l_returnflag = 'R' AS to_many,
              l_linestatus = 'F' AS bidi FROM lineitem),
rs AS (SELECT 'model-' || CAST(c_custkey % 20 AS VARCHAR) AS ModelId, 'T' || CAST(CAST(floor(c_custkey / 20) AS BIGINT) AS VARCHAR) AS TableName,
              'Role' || CAST(c_custkey AS VARCHAR) AS RoleName,
              CASE c_custkey % 4 WHEN 0 THEN '[Email] = USERPRINCIPALNAME()' WHEN 1 THEN 'LEFT([Region], 2) = "EU"'
                   WHEN 2 THEN 'TRUE()' ELSE 'UPPER([User]) = USERNAME()' END AS FilterExpression FROM customer),
ci AS (SELECT ModelId, TableName, 'Item' || CAST(p_partkey AS VARCHAR) AS ItemName,
              CASE WHEN p_partkey % 2 = 0 THEN '' ELSE 'SELECTEDMEASURE()' END AS Expression FROM tb WHERE p_size % 18 = 0),
ends AS (SELECT ModelId, FromTable AS TableName, 'From' AS e, false AS to_one FROM rl
         UNION ALL SELECT ModelId, ToTable, 'To', NOT to_many FROM rl),
fl AS (SELECT ModelId, TableName, max(CASE WHEN e = 'From' THEN 1 ELSE 0 END) AS f, max(CASE WHEN e = 'To' THEN 1 ELSE 0 END) AS t,
              max(CASE WHEN to_one THEN 1 ELSE 0 END) AS t1 FROM ends GROUP BY 1, 2),
hy AS (SELECT ModelId, TableName FROM pt GROUP BY 1, 2
       HAVING max(CASE WHEN Mode = 'Import' THEN 1 ELSE 0 END) = 1 AND max(CASE WHEN Mode = 'DirectQuery' THEN 1 ELSE 0 END) = 1)"""


def model_columns_catalogue(part: DataFrame, lineitem: DataFrame) -> dict[str, DataFrame]:
    """Columns (key columns K1..K7 seen on line items, one Id per part table),
    hierarchies and column dependencies for the column-structure rules."""
    pk, ln = F.col("l_partkey"), F.col("l_linenumber")
    keys = lineitem.select(
        _cat("model-", pk % 20).alias("ModelId"), _cat("T", F.floor(pk / 20)).alias("TableName"), _cat("K", ln).alias("ColumnName"),
        F.lit("Int64").alias("DataType"), ((pk + ln) % 3 == 0).alias("IsHidden"), (pk % 2 == 0).alias("IsAvailableInMDX"),
        F.lit(False).alias("IsKey"), F.when(ln == 1, F.lit("K2")).alias("SortByColumn")).distinct()
    p = F.col("p_partkey")
    ids = part.select(_cat("model-", p % 20).alias("ModelId"), _cat("T", F.floor(p / 20)).alias("TableName"),
                      F.lit("Id").alias("ColumnName"), F.lit("Int64").alias("DataType"), F.lit(False).alias("IsHidden"),
                      F.lit(True).alias("IsAvailableInMDX"), (F.col("p_size") % 2 == 0).alias("IsKey"),
                      F.lit(None).cast("string").alias("SortByColumn"))
    hier = part.filter(F.col("p_size") % 6 == 0).select(
        _cat("model-", p % 20).alias("ModelId"), _cat("T", F.floor(p / 20)).alias("TableName"),
        F.lit("H").alias("HierarchyName"), F.lit("K3").alias("ColumnName"))
    deps = lineitem.filter(ln % 3 == 0).select(
        _cat("model-", pk % 20).alias("ModelId"), F.lit("COLUMN").alias("ObjectType"),
        _cat("T", F.floor(pk / 20)).alias("TableName"), _cat("K", ln).alias("ObjectName"),
        F.lit("COLUMN").alias("ReferencedObjectType"), _cat("T", F.floor(pk / 20)).alias("ReferencedTable"),
        F.lit("Id").alias("ReferencedObject")).distinct()
    return {"columns": keys.unionByName(ids), "hierarchies": hier, "dependencies": deps}


COLUMNS_CATALOGUE_SQL = """
cols AS (
  SELECT DISTINCT 'model-' || CAST(l_partkey % 20 AS VARCHAR) AS ModelId, 'T' || CAST(CAST(floor(l_partkey / 20) AS BIGINT) AS VARCHAR) AS TableName,
         'K' || CAST(l_linenumber AS VARCHAR) AS ColumnName, (l_partkey + l_linenumber) % 3 = 0 AS IsHidden,
         l_partkey % 2 = 0 AS IsAvailableInMDX, false AS IsKey, CASE WHEN l_linenumber = 1 THEN 'K2' END AS SortByColumn FROM lineitem
  UNION ALL
  SELECT 'model-' || CAST(p_partkey % 20 AS VARCHAR), 'T' || CAST(CAST(floor(p_partkey / 20) AS BIGINT) AS VARCHAR), 'Id', false, true,
         p_size % 2 = 0, CAST(NULL AS VARCHAR) FROM part),
hier AS (SELECT DISTINCT 'model-' || CAST(p_partkey % 20 AS VARCHAR) AS ModelId,
                'T' || CAST(CAST(floor(p_partkey / 20) AS BIGINT) AS VARCHAR) AS TableName, 'K3' AS ColumnName FROM part WHERE p_size % 6 = 0),
deps AS (SELECT DISTINCT 'model-' || CAST(l_partkey % 20 AS VARCHAR) AS ModelId,
                'T' || CAST(CAST(floor(l_partkey / 20) AS BIGINT) AS VARCHAR) AS TableName, 'K' || CAST(l_linenumber AS VARCHAR) AS ColumnName
         FROM lineitem WHERE l_linenumber % 3 = 0),
sortused AS (SELECT DISTINCT ModelId, TableName, SortByColumn AS ColumnName FROM cols WHERE SortByColumn IS NOT NULL AND SortByColumn <> ''),
relcols AS (SELECT DISTINCT 'model-' || CAST(l_partkey % 20 AS VARCHAR) AS ModelId,
                   'T' || CAST(CAST(floor(l_partkey / 20) AS BIGINT) AS VARCHAR) AS TableName, 'K' || CAST(l_linenumber AS VARCHAR) AS ColumnName,
                   'From' AS e, 'Many' AS card FROM lineitem
            UNION SELECT DISTINCT 'model-' || CAST(l_partkey % 20 AS VARCHAR), 'T' || CAST(CAST(floor(l_suppkey / 20) AS BIGINT) AS VARCHAR),
                   'Id', 'To', CASE WHEN l_returnflag = 'R' THEN 'Many' ELSE 'One' END FROM lineitem)"""

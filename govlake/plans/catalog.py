"""Registered queries over the driver tables, each with its DuckDB oracle.

Every query reads whole tables (or data Spark derives from them); the
stand-in shapes come from :mod:`govlake.plans.standins`.  Money-like sums
are rounded to their exact decimal places (sums of 2-decimal values have 2
decimals), and averages are taken as rounded-sum / count, so Spark and the
oracle produce bit-identical doubles whatever the summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import date_parts, time_bin
from ..operators import measures as A
from ..operators.tables import build_activities, build_aggregated_activities
from ..sources.dims import calendar_columns, calendar_of
from .registry import REGISTRY, register, rnd, rnd_sql, with_
from .standins import (ACTIVITIES_SQL, ORDERS_TODAY, SHIP_TODAY, TODAY, activities_from_events, load)

ACT_SILVER_SQL = """
silver AS (
  SELECT CAST(CreationTime AS DATE) AS CreationDate, strftime(CreationTime, '%Y%m%d') AS CreationDateKey,
         strftime(CreationTime, '%-H') AS CreationHour, strftime(CreationTime, '%M') AS CreationMinute,
         upper(Id) AS Id, CAST(CreationTime AS VARCHAR) AS CreationTime, Activity, upper(UserId) AS UserId,
         upper(ArtifactId) AS ArtifactId, ObjectId, ObjectType, ArtifactKind, upper(CapacityId) AS CapacityId,
         upper(WorkspaceId) AS WorkspaceId, Experience, Workload, upper(GatewayId) AS GatewayId, ResultStatus,
         IsSuccess, value
  FROM activities
)"""


def _activities(spark: SparkSession, sf: str) -> DataFrame:
    return build_activities(activities_from_events(load(spark, sf, "events")))


# --------------------------------------------------------------------------- T26 (flagship)
@register("activity_agg_30d", "T26, T1, P6, P2, P1, P10, P11", headline=True, sql=with_(ACTIVITIES_SQL, ACT_SILVER_SQL) + f"""
SELECT CreationDate, CreationDateKey, CreationHour, Activity, Experience, Workload,
       upper(r_cap) AS CapacityId, upper(r_ws) AS WorkspaceId, GatewayId,
       coalesce(upper(ArtifactId), upper(ObjectId)) AS item_id,
       coalesce(ObjectType, ArtifactKind) AS item_kind_resolved,
       CASE WHEN ResultStatus = 'Failed' THEN 'Failed' WHEN ResultStatus = 'InProgress' THEN 'InProgress'
            WHEN ResultStatus = 'Succeeded' THEN 'Succeeded' WHEN CAST(IsSuccess AS INTEGER) = 1 THEN 'Succeeded'
            ELSE 'N/A' END AS activity_status,
       count(*) AS CountOfActivities, count(DISTINCT UserId) AS DistinctCountOfUsers
FROM (SELECT *, CapacityId AS r_cap, WorkspaceId AS r_ws FROM silver) s
WHERE CreationDate >= DATE '{TODAY}' - INTERVAL 30 DAY
GROUP BY CreationDate, CreationDateKey, CreationHour, Activity, Experience, Workload, r_cap, r_ws, GatewayId,
         ArtifactId, ObjectId, ObjectType, ArtifactKind, ResultStatus, IsSuccess
""")
def q_activity_agg_30d(spark, sf):
    """Activities of the last 30 days aggregated by their raw keys."""
    return build_aggregated_activities(_activities(spark, sf), TODAY, 30)


# --------------------------------------------------------------------------- A14
@register("activity_calendar_windows", "A14, S9", sql=with_(ACTIVITIES_SQL, ACT_SILVER_SQL) + f"""
SELECT Activity,
  count(CASE WHEN year(CreationDate) = year(DATE '{TODAY}') AND month(CreationDate) = month(DATE '{TODAY}') THEN 1 END) AS current_month,
  count(CASE WHEN strftime(CreationDate, '%Y-%m') = strftime(DATE '{TODAY}' - INTERVAL 1 MONTH, '%Y-%m') THEN 1 END) AS previous_month,
  count(CASE WHEN year(CreationDate) = year(DATE '{TODAY}') THEN 1 END) AS current_year,
  count(CASE WHEN year(CreationDate) = year(DATE '{TODAY}') - 1 THEN 1 END) AS previous_year,
  count(CASE WHEN year(CreationDate) = year(DATE '{TODAY}') AND quarter(CreationDate) = quarter(DATE '{TODAY}') THEN 1 END) AS current_quarter,
  count(CASE WHEN CreationDate BETWEEN DATE '{TODAY}' - INTERVAL 14 DAY AND DATE '{TODAY}' THEN 1 END) AS last_14_days,
  count(CASE WHEN CreationDate BETWEEN DATE '{TODAY}' - INTERVAL 30 DAY AND DATE '{TODAY}' THEN 1 END) AS last_30_days
FROM silver GROUP BY Activity
""")
def q_activity_calendar_windows(spark, sf):
    """Activity counts under the calendar windows (month, year, quarter, 14/30 days)."""
    return A.calendar_window_measures(_activities(spark, sf), "CreationDate", TODAY, by=["Activity"])


# --------------------------------------------------------------------------- A15
@register("activity_rolling_users", "A15, A4", sql=with_(ACTIVITIES_SQL, ACT_SILVER_SQL) + f"""
SELECT Workload,
  count(DISTINCT CASE WHEN CreationDate >= DATE '{TODAY}' - INTERVAL 7 DAY AND CreationDate <= DATE '{TODAY}' THEN UserId END) AS last_7d,
  count(DISTINCT CASE WHEN CreationDate >= DATE '{TODAY}' - INTERVAL 14 DAY AND CreationDate <= DATE '{TODAY}' THEN UserId END) AS last_14d,
  count(DISTINCT CASE WHEN CreationDate >= DATE '{TODAY}' - INTERVAL 30 DAY AND CreationDate <= DATE '{TODAY}' THEN UserId END) AS last_30d
FROM silver GROUP BY Workload
""")
def q_activity_rolling_users(spark, sf):
    """Distinct active users over the last 7/14/30 days per workload."""
    return A.rolling_counts(_activities(spark, sf), "CreationDate", TODAY, days=(7, 14, 30), by=["Workload"],
                            distinct="UserId")


@register("activity_rolling_counts", "A15", sql=with_(ACTIVITIES_SQL, ACT_SILVER_SQL) + f"""
SELECT Activity,
  count(CASE WHEN CreationDate >= DATE '{TODAY}' - INTERVAL 7 DAY AND CreationDate <= DATE '{TODAY}' THEN 1 END) AS last_7d,
  count(CASE WHEN CreationDate >= DATE '{TODAY}' - INTERVAL 14 DAY AND CreationDate <= DATE '{TODAY}' THEN 1 END) AS last_14d,
  count(CASE WHEN CreationDate >= DATE '{TODAY}' - INTERVAL 30 DAY AND CreationDate <= DATE '{TODAY}' THEN 1 END) AS last_30d,
  count(CASE WHEN CreationDate >= DATE '{TODAY}' - INTERVAL 60 DAY AND CreationDate <= DATE '{TODAY}' THEN 1 END) AS last_60d,
  count(CASE WHEN CreationDate >= DATE '{TODAY}' - INTERVAL 90 DAY AND CreationDate <= DATE '{TODAY}' THEN 1 END) AS last_90d
FROM silver GROUP BY Activity
""")
def q_activity_rolling_counts(spark, sf):
    """Activity counts over the last 7/14/30/60/90 days."""
    return A.rolling_counts(_activities(spark, sf), "CreationDate", TODAY, by=["Activity"])


# --------------------------------------------------------------------------- A12
@register("activity_two_level", "A12, A13", sql=with_(ACTIVITIES_SQL, ACT_SILVER_SQL) + f"""
SELECT Activity, {rnd_sql('sum(s)', 2)} / count(s) AS avg_value, max(s) AS max_value, count(s) AS count_value
FROM (SELECT Activity, CreationDate, ArtifactId, {rnd_sql('sum(value)', 2)} AS s FROM silver
      GROUP BY Activity, CreationDate, ArtifactId) GROUP BY Activity
""")
def q_activity_two_level(spark, sf):
    """Sum of value per (day, item), then its average / maximum / count per activity."""
    return A.two_level(_activities(spark, sf), ["CreationDate", "ArtifactId"], F.col("value"),
                       outer_by=["Activity"], decimals=2)


# --------------------------------------------------------------------------- A6
@register("activity_latest_day", "A6", sql=with_(ACTIVITIES_SQL, ACT_SILVER_SQL) + """
SELECT Id, CreationDate, Activity, UserId FROM silver WHERE CreationDate = (SELECT max(CreationDate) FROM silver)
""")
def q_activity_latest_day(spark, sf):
    """Rows of the latest snapshot day (stamp = greatest stamp)."""
    return A.latest_snapshot(_activities(spark, sf), "CreationDate").select("Id", "CreationDate", "Activity", "UserId")


# --------------------------------------------------------------------------- P14
@register("activity_15min_bins", "P14", sql=with_(ACTIVITIES_SQL) + """
SELECT to_timestamp(floor(epoch(CreationTime) / 900) * 900)::TIMESTAMP AS TimeBin, count(*) AS n
FROM activities GROUP BY 1
""")
def q_activity_15min_bins(spark, sf):
    """Activities per 15-minute bin."""
    acts = activities_from_events(load(spark, sf, "events"))
    return (acts.groupBy(time_bin("CreationTime", 15).cast("timestamp_ntz").alias("TimeBin"))
            .agg(F.count(F.lit(1)).alias("n")))


# --------------------------------------------------------------------------- A16
@register("orders_month_over_month", "A16", sql=f"""
WITH m AS (
  SELECT date_trunc('month', o_orderdate)::DATE AS Month, count(*) AS orders,
         count(DISTINCT o_custkey) AS customers, {rnd_sql('sum(o_totalprice)', 2)} AS revenue
  FROM orders GROUP BY 1)
SELECT m.Month, m.orders, m.customers, m.revenue, p.orders AS prev_orders, p.customers AS prev_customers,
       p.revenue AS prev_revenue,
       CASE WHEN p.orders <> 0 THEN CAST(m.orders - p.orders AS DOUBLE) / p.orders END AS growth_orders,
       CASE WHEN p.customers <> 0 THEN CAST(m.customers - p.customers AS DOUBLE) / p.customers END AS growth_customers,
       CASE WHEN p.revenue <> 0 THEN (m.revenue - p.revenue) / p.revenue END AS growth_revenue
FROM m LEFT JOIN m p ON p.Month + INTERVAL 1 MONTH = m.Month
""")
def q_orders_month_over_month(spark, sf):
    """Monthly orders, customers and revenue with previous-month growth."""
    o = load(spark, sf, "orders")
    return A.month_over_month(o, "o_orderdate", {"orders": F.count(F.lit(1)),
                                                 "customers": F.count_distinct("o_custkey"),
                                                 "revenue": rnd(F.sum("o_totalprice"), 2)})


# --------------------------------------------------------------------------- S10 + S9 flags
@register("orders_calendar", "S10, S9", sql=f"""
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) lo, max(CAST(o_orderdate AS DATE)) hi FROM orders),
d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS Date FROM b)
SELECT Date, CAST(year(Date) AS INTEGER) AS Year, CAST(month(Date) AS INTEGER) AS Month,
       strftime(Date, '%Y-%m') AS YearMonth, CAST(isodow(Date) AS INTEGER) AS WeekdayNum, strftime(Date, '%A') AS WeekdayName,
       strftime(Date, '%Y%m%d') AS DateKey, CAST(weekofyear(Date) AS INTEGER) AS WeekOfYear, strftime(Date, '%a') AS DayOfWeek,
       CAST(dayofweek(Date) + 1 AS INTEGER) AS DayOfWeekNum,
       CASE WHEN year(Date) = year(DATE '{ORDERS_TODAY}') THEN 1 ELSE 0 END AS IsCurrentYear,
       CASE WHEN year(Date) = year(DATE '{ORDERS_TODAY}') - 1 THEN 1 ELSE 0 END AS IsPreviousYear,
       CASE WHEN year(Date) = year(DATE '{ORDERS_TODAY}') AND quarter(Date) = quarter(DATE '{ORDERS_TODAY}') THEN 1 ELSE 0 END AS IsCurrentQuarter,
       CASE WHEN year(Date) = year(DATE '{ORDERS_TODAY}') AND month(Date) = month(DATE '{ORDERS_TODAY}') THEN 1 ELSE 0 END AS IsCurrentMonth,
       CASE WHEN strftime(Date, '%Y-%m') = strftime(DATE '{ORDERS_TODAY}' - INTERVAL 1 MONTH, '%Y-%m') THEN 1 ELSE 0 END AS IsPreviousMonth,
       CASE WHEN Date BETWEEN DATE '{ORDERS_TODAY}' - INTERVAL 14 DAY AND DATE '{ORDERS_TODAY}' THEN 1 ELSE 0 END AS IsInLast14Days,
       CASE WHEN Date BETWEEN DATE '{ORDERS_TODAY}' - INTERVAL 30 DAY AND DATE '{ORDERS_TODAY}' THEN 1 ELSE 0 END AS IsInLast30Days
FROM d
""")
def q_orders_calendar(spark, sf):
    """Calendar spanning the order dates, with attributes and relative flags."""
    cal = calendar_of(load(spark, sf, "orders"), "o_orderdate")
    extra = [c for c in calendar_columns(F.col("Date"), ORDERS_TODAY)]
    # DateKey, Date(text), Date2Key ... : keep the ones not already present
    keep = [extra[0], extra[6], extra[8]] + extra[9:]
    return cal.select("*", *keep).withColumnRenamed("Date", "Date")


# =========================================================================== lineitem / orders measures
REV = "l_extendedprice * (1 - l_discount)"


def _rev() -> F.Column:
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


@register("supplier_trailing_avg", "A17, W2", sql=f"""
WITH d AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS Date, {rnd_sql(f'sum({REV})', 4)} AS daily_value
           FROM lineitem GROUP BY 1, 2),
w AS (SELECT *, {rnd_sql('sum(daily_value) OVER win', 4)} / count(daily_value) OVER win AS trailing_avg
      FROM d WINDOW win AS (PARTITION BY l_suppkey ORDER BY Date RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW))
SELECT l_suppkey, Date, daily_value, trailing_avg,
       CASE WHEN trailing_avg <> 0 THEN (trailing_avg - daily_value) / trailing_avg END AS trend_ratio FROM w
""")
def q_supplier_trailing_avg(spark, sf):
    """Daily revenue per supplier, trailing 30-day average and trend ratio."""
    return A.trailing_average(load(spark, sf, "lineitem"), "l_suppkey", "l_shipdate", _rev(), 30, decimals=4)


@register("supplier_outliers", "A21", sql=f"""
WITH d AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS Date, {rnd_sql(f'sum({REV})', 4)} AS daily_value
           FROM lineitem GROUP BY 1, 2),
a AS (SELECT l_suppkey, {rnd_sql('sum(daily_value)', 4)} / count(daily_value) AS avg_all_days FROM d GROUP BY 1)
SELECT d.l_suppkey, Date, daily_value, avg_all_days, daily_value - avg_all_days AS daily_vs_avg,
       CASE WHEN avg_all_days <> 0 THEN (daily_value - avg_all_days - avg_all_days) / avg_all_days END AS outlier_factor,
       CASE WHEN avg_all_days <> 0 THEN (daily_value - avg_all_days) / avg_all_days END AS outlier_factor_intended
FROM d JOIN a USING (l_suppkey)
""")
def q_supplier_outliers(spark, sf):
    """Daily revenue per supplier against its all-days average (outlier factor)."""
    return A.outliers(load(spark, sf, "lineitem"), "l_suppkey", "l_shipdate", _rev(), decimals=4)


@register("customer_unused", "A22", sql=f"""
WITH o AS (SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '{ORDERS_TODAY}' - INTERVAL 180 DAY),
c AS (SELECT DISTINCT c_custkey FROM customer),
m1 AS (SELECT o_custkey AS c_custkey, count(*) AS v FROM o GROUP BY 1),
m2 AS (SELECT o_custkey AS c_custkey, count(*) AS v FROM o WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
m3 AS (SELECT o_custkey AS c_custkey, count(*) AS v FROM o WHERE o_orderstatus = 'O' GROUP BY 1),
i AS (SELECT c.c_custkey,
        CASE WHEN coalesce(m1.v, 0) < 1 THEN 1 END AS unused_recent,
        CASE WHEN coalesce(m2.v, 0) < 1 THEN 1 END AS unused_urgent,
        CASE WHEN coalesce(m3.v, 0) < 1 THEN 1 END AS unused_open
      FROM c LEFT JOIN m1 USING (c_custkey) LEFT JOIN m2 USING (c_custkey) LEFT JOIN m3 USING (c_custkey))
SELECT *, CASE WHEN coalesce(unused_recent, 0) + coalesce(unused_urgent, 0) + coalesce(unused_open, 0) > 0
               THEN (coalesce(unused_recent, 0) + coalesce(unused_urgent, 0) + coalesce(unused_open, 0)) / 3.0 END AS unused_score
FROM i
""")
def q_customer_unused(spark, sf):
    """Unused-customer indicators (no recent / urgent / open orders) and score."""
    o = load(spark, sf, "orders").filter(F.to_date("o_orderdate") > F.date_sub(F.lit(ORDERS_TODAY).cast("date"), 180))
    # all three metrics in one pass over orders
    m = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("recent"), F.count(F.when(F.col("o_orderpriority") == "1-URGENT", 1)).alias("urgent"),
        F.count(F.when(F.col("o_orderstatus") == "O", 1)).alias("open"))
    return A.unused_indicators(load(spark, sf, "customer"), "c_custkey", m)


@register("nation_first_customer", "A23", sql="""
SELECT n_nationkey, coalesce(min(c_name), 'No customer') AS first_customer
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey
""")
def q_nation_first_customer(spark, sf):
    """First customer name per nation, with a default text."""
    j = load(spark, sf, "nation").join(load(spark, sf, "customer"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return A.first_value(j, ["n_nationkey"], "c_name", "No customer", "first_customer")


@register("customer_run_comparison", "A24", sql=f"""
WITH r AS (SELECT o_custkey, CAST(year(o_orderdate) - 1994 AS INTEGER) AS run, o_totalprice FROM orders),
l AS (SELECT o_custkey, max(run) AS last_run FROM r GROUP BY 1),
j AS (SELECT r.*, l.last_run, CASE WHEN l.last_run - 1 > 0 THEN l.last_run - 1 END AS prev FROM r JOIN l USING (o_custkey))
SELECT o_custkey, max(last_run) AS last_run, max(prev) AS previous_run,
       {rnd_sql('sum(CASE WHEN run = last_run THEN o_totalprice END)', 2)} AS revenue_last,
       {rnd_sql('sum(CASE WHEN run = prev THEN o_totalprice END)', 2)} AS revenue_previous,
       count(CASE WHEN run = last_run THEN 1 END) AS orders_last,
       count(CASE WHEN run = prev THEN 1 END) AS orders_previous,
       {rnd_sql('sum(CASE WHEN run = prev THEN o_totalprice END)', 2)} - {rnd_sql('sum(CASE WHEN run = last_run THEN o_totalprice END)', 2)} AS revenue_diff,
       count(CASE WHEN run = prev THEN 1 END) - count(CASE WHEN run = last_run THEN 1 END) AS orders_diff
FROM j GROUP BY o_custkey
""")
def q_customer_run_comparison(spark, sf):
    """Per customer: last and previous yearly run and the change between them."""
    o = load(spark, sf, "orders").withColumn("run", F.year("o_orderdate") - 1994)
    out = A.run_comparison(o, "o_custkey", "run", {"revenue": F.col("o_totalprice"), "orders": F.lit(1)},
                           decimals={"revenue": 2})
    return out.withColumns({"orders_last": F.coalesce("orders_last", F.lit(0)).cast("long"),
                            "orders_previous": F.coalesce("orders_previous", F.lit(0)).cast("long")}) \
              .withColumn("orders_diff", F.col("orders_previous") - F.col("orders_last"))


@register("lineitem_storage_breakdown", "A26", sql="""
WITH s AS (SELECT l_returnflag,
             CASE l_linenumber WHEN 1 THEN 'H$' WHEN 2 THEN 'U$' WHEN 3 THEN 'R$' ELSE 'T' END || CAST(l_partkey AS VARCHAR) AS TABLE_ID,
             CAST(l_quantity AS BIGINT) AS USED_SIZE, l_linenumber % 2 AS SEGMENT_NUMBER,
             CASE WHEN l_linestatus = 'F' THEN 'BASIC_DATA' ELSE 'OTHER' END AS COLUMN_TYPE,
             CAST(l_partkey % 100 AS BIGINT) AS DICTIONARY_SIZE FROM lineitem)
SELECT l_returnflag,
  sum(CASE WHEN substr(TABLE_ID, 2, 1) <> '$' THEN USED_SIZE END)::BIGINT AS data_size,
  sum(CASE WHEN substr(TABLE_ID, 1, 2) = 'H$' AND SEGMENT_NUMBER = 0 THEN USED_SIZE END)::BIGINT AS hierarchy_size,
  sum(CASE WHEN substr(TABLE_ID, 1, 2) = 'U$' THEN USED_SIZE END)::BIGINT AS user_hierarchy_size,
  sum(CASE WHEN substr(TABLE_ID, 1, 2) = 'R$' THEN USED_SIZE END)::BIGINT AS relationship_size,
  sum(CASE WHEN COLUMN_TYPE = 'BASIC_DATA' THEN DICTIONARY_SIZE END)::BIGINT AS dictionary_size,
  (coalesce(sum(CASE WHEN substr(TABLE_ID, 2, 1) <> '$' THEN USED_SIZE END), 0)
   + coalesce(sum(CASE WHEN substr(TABLE_ID, 1, 2) = 'H$' AND SEGMENT_NUMBER = 0 THEN USED_SIZE END), 0)
   + coalesce(sum(CASE WHEN substr(TABLE_ID, 1, 2) = 'U$' THEN USED_SIZE END), 0)
   + coalesce(sum(CASE WHEN substr(TABLE_ID, 1, 2) = 'R$' THEN USED_SIZE END), 0)
   + coalesce(sum(CASE WHEN COLUMN_TYPE = 'BASIC_DATA' THEN DICTIONARY_SIZE END), 0))::BIGINT AS total_size
FROM s GROUP BY l_returnflag
""")
def q_lineitem_storage_breakdown(spark, sf):
    """Storage size breakdown by table-id prefix (lineitem as segment rows)."""
    li = load(spark, sf, "lineitem")
    seg = li.select("l_returnflag",
                    F.concat(F.when(F.col("l_linenumber") == 1, "H$").when(F.col("l_linenumber") == 2, "U$")
                             .when(F.col("l_linenumber") == 3, "R$").otherwise("T"),
                             F.col("l_partkey").cast("string")).alias("TABLE_ID"),
                    F.col("l_quantity").cast("long").alias("USED_SIZE"),
                    (F.col("l_linenumber") % 2).alias("SEGMENT_NUMBER"),
                    F.when(F.col("l_linestatus") == "F", "BASIC_DATA").otherwise("OTHER").alias("COLUMN_TYPE"),
                    (F.col("l_partkey") % 100).cast("long").alias("DICTIONARY_SIZE"))
    return A.storage_breakdown(seg, by=["l_returnflag"])


@register("lineitem_quantity_stats", "A27, A10, A9, A11", sql=f"""
SELECT l_returnflag, l_linestatus,
  {rnd_sql('sum(l_quantity)', 2)} / count(l_quantity) AS l_quantity_avg, median(l_quantity) AS l_quantity_median,
  min(l_quantity) AS l_quantity_min, max(l_quantity) AS l_quantity_max, {rnd_sql('sum(l_quantity)', 2)} AS l_quantity_sum,
  count(l_quantity) AS l_quantity_count, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
FROM lineitem GROUP BY 1, 2
""")
def q_lineitem_quantity_stats(spark, sf):
    """Average, exact median, min, max, sum, count of quantities; first/last ship dates."""
    li = load(spark, sf, "lineitem")
    st = A.distribution_stats(li, "l_quantity", by=["l_returnflag", "l_linestatus"], decimals=2)
    mm = li.groupBy("l_returnflag", "l_linestatus").agg(F.min("l_shipdate").alias("first_ship"),
                                                        F.max("l_shipdate").alias("last_ship"))
    return st.join(mm, ["l_returnflag", "l_linestatus"])


@register("usage_rollup", "A39, A8", sql=f"""
SELECT l_suppkey AS CapacityId, o_custkey AS WorkspaceId, CAST(l_shipdate AS DATE) AS Date, l_returnflag AS ItemKind,
  {rnd_sql('sum(l_quantity)', 2)} AS quantity, {rnd_sql('sum(l_extendedprice)', 2)} AS gross,
  {rnd_sql(f'sum({REV})', 4)} AS cu, count(*) AS operations, strftime(CAST(l_shipdate AS DATE), '%Y%m%d') AS DateKey
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY 1, 2, 3, 4 HAVING {rnd_sql(f'sum({REV})', 4)} > 0
""")
def q_usage_rollup(spark, sf):
    """Usage rolled up by (supplier, customer, day, kind): sums, CU > 0, DateKey."""
    li = load(spark, sf, "lineitem")
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        F.col("l_suppkey").alias("CapacityId"), F.col("o_custkey").alias("WorkspaceId"),
        F.to_date("l_shipdate").alias("Date"), F.col("l_returnflag").alias("ItemKind"),
        "l_quantity", "l_extendedprice", _rev().alias("rev"))
    return A.usage_rollup(j, ["CapacityId", "WorkspaceId", "Date", "ItemKind"],
                          {"quantity": ("l_quantity", 2), "gross": ("l_extendedprice", 2), "cu": ("rev", 4),
                           "operations": (F.lit(1), None)}, "cu")


# =========================================================================== joins
from ..operators import joins as J  # noqa: E402
from ..operators import windows as W  # noqa: E402
from ..operators.flatten import dedupe  # noqa: E402
from ..operators.setops import union_distinct  # noqa: E402


@register("star_join_revenue", "J6, A7", sql=f"""
SELECT p.p_type AS part_p_type, s.s_nationkey AS supplier_s_nationkey, c.c_mktsegment AS customer_c_mktsegment,
       {rnd_sql(f'sum({REV})', 4)} AS revenue, count(*) AS lines
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY 1, 2, 3
""")
def q_star_join_revenue(spark, sf):
    """Lineitem fact through its relationship list (customer via an inactive
    relationship switched on) - revenue by part type, supplier nation, segment."""
    li = load(spark, sf, "lineitem")
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    fact = li.join(o, li["l_orderkey"] == o["o_orderkey"], "left")
    dims = [("part", load(spark, sf, "part").select("p_partkey", "p_type"), "l_partkey", "p_partkey", True),
            ("supplier", load(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), "l_suppkey", "s_suppkey", True),
            ("customer", load(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "o_custkey", "c_custkey", False)]
    s = J.star_join(fact, dims, use={"customer"})
    return s.groupBy("part_p_type", "supplier_s_nationkey", "customer_c_mktsegment").agg(
        A.exact_sum(_rev(), 4).alias("revenue"), F.count(F.lit(1)).alias("lines"))


@register("parts_via_rich_suppliers", "J7", sql="""
SELECT p_partkey, p_name FROM part WHERE p_partkey IN (
  SELECT l_partkey FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000))
""")
def q_parts_via_rich_suppliers(spark, sf):
    """Parts linked through lineitem to suppliers with balance > 5000 (two semi-joins)."""
    rich = load(spark, sf, "supplier").filter(F.col("s_acctbal") > 5000)
    return J.filter_through(load(spark, sf, "part").select("p_partkey", "p_name"), load(spark, sf, "lineitem"), rich,
                            "p_partkey", "l_partkey", "l_suppkey", "s_suppkey")


@register("lineitem_large_parts", "J8, A3", sql="""
SELECT l_returnflag, count(*) AS lines FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 40) GROUP BY 1
""")
def q_lineitem_large_parts(spark, sf):
    """Lines whose part is in the value set of large parts (virtual relationship)."""
    big = load(spark, sf, "part").filter(F.col("p_size") > 40)
    li = J.filter_by_values(load(spark, sf, "lineitem"), "l_partkey", big, "p_partkey")
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lines"))


@register("part_single_nation", "J9", sql="""
WITH ps AS (SELECT l_partkey, s_nationkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
r AS (SELECT l_partkey AS p_partkey, CASE WHEN count(DISTINCT s_nationkey) = 1 THEN min(s_nationkey) END AS supplier_nation
      FROM ps GROUP BY 1)
SELECT p.p_partkey, r.supplier_nation FROM part p LEFT JOIN r USING (p_partkey)
""")
def q_part_single_nation(spark, sf):
    """The supplier nation of each part when exactly one matches, else blank."""
    ps = (load(spark, sf, "lineitem").join(load(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
          .select(F.col("l_partkey").alias("p_partkey"), "s_nationkey"))
    return J.lookup_single(load(spark, sf, "part").select("p_partkey"), ps, ["p_partkey"], "s_nationkey", "supplier_nation")


@register("returnflag_partition_series", "J10, W3", sql="""
WITH s AS (SELECT l_returnflag, count(*) AS line_count FROM lineitem GROUP BY 1),
x AS (SELECT l_returnflag, line_count, CAST(unnest(generate_series(1, 64)) AS INTEGER) AS Value FROM s)
SELECT l_returnflag, Value, line_count, CAST(ceil(line_count / Value) AS BIGINT) AS rows_per_partition,
       CAST(sum(CAST(ceil(line_count / Value) AS BIGINT)) OVER (PARTITION BY l_returnflag ORDER BY Value
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_total
FROM x
""")
def q_returnflag_partition_series(spark, sf):
    """Each summary row repeated for partition counts 1..64 (series join), rows per
    partition and their running total."""
    s = load(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("line_count"))
    x = J.with_series(s, 1, 64).withColumn("rows_per_partition", F.ceil(F.col("line_count") / F.col("Value")).cast("long"))
    return W.running_total(x, ["l_returnflag"], "Value", "rows_per_partition")


@register("customer_orders_lookup", "J2, J4", sql="""
SELECT DISTINCT o.o_orderkey, o.o_orderstatus, c.c_name, c.c_nationkey
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""")
def q_customer_orders_lookup(spark, sf):
    """Order -> customer name/nation lookup (left join), distinct rows."""
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    return J.left_outer_distinct(o, c, ["o_custkey"]).drop("o_custkey")


@register("supplier_first_order", "J5", sql="""
WITH one AS (SELECT l_suppkey, min(l_orderkey) AS l_orderkey FROM lineitem GROUP BY 1)
SELECT l_suppkey, one.l_orderkey, o_orderdate, o_totalprice FROM one JOIN orders ON one.l_orderkey = o_orderkey
""")
def q_supplier_first_order(spark, sf):
    """innerunique: one lineitem row per supplier (least order key), then joined to orders."""
    li = load(spark, sf, "lineitem").select("l_suppkey", F.col("l_orderkey").alias("o_orderkey"))
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return J.inner_unique(li, o, ["o_orderkey"], reduce_on=["l_suppkey"]).withColumnRenamed("o_orderkey", "l_orderkey")


@register("nation_pairs_by_region", "J3", sql="""
SELECT a.n_name AS nation, b.n_name AS other_nation, count(*) AS suppliers
FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey
JOIN supplier s ON s.s_nationkey = b.n_nationkey
WHERE starts_with(a.n_name, 'NATION_1') AND NOT starts_with(b.n_name, 'NATION_1')
GROUP BY 1, 2
""")
def q_nation_pairs_by_region(spark, sf):
    """Scope-wise pairing as for staging lakehouses: the designated nations of a
    region (name prefix) with the region's other nations, counting the
    suppliers of the other nation.  Designated x group, never all pairs."""
    n = load(spark, sf, "nation")
    designated = F.col("n_name").startswith("NATION_1")
    p = J.pair_within(n.filter(designated), n.filter(~designated), "n_regionkey", {"n_name": "nation"},
                      {"n_name": "other_nation", "n_nationkey": "k2"})
    s = load(spark, sf, "supplier").select(F.col("s_nationkey").alias("k2"))
    return p.join(s, "k2").groupBy("nation", "other_nation").agg(F.count(F.lit(1)).alias("suppliers"))


# =========================================================================== windows / set ops
@register("part_price_rank", "W1", sql="""
SELECT p_partkey, p_type, p_retailprice, CAST(rank() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC) AS INTEGER) AS rank
FROM part
""")
def q_part_price_rank(spark, sf):
    """Rank of each part by price within its type, descending, ties share a rank."""
    # skew-safe form: no per-type window, a hot type spans many tasks
    return W.rank_desc_distributed(load(spark, sf, "part").select("p_partkey", "p_type", "p_retailprice"),
                                   ["p_type"], "p_retailprice")


@register("daily_revenue_running_total", "W3", sql=f"""
WITH d AS (SELECT l_returnflag, CAST(l_shipdate AS DATE) AS Date, {rnd_sql(f'sum({REV})', 4)} AS revenue FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, Date, revenue,
  {rnd_sql('sum(revenue) OVER (PARTITION BY l_returnflag ORDER BY Date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 4)} AS running_total
FROM d
""")
def q_daily_revenue_running_total(spark, sf):
    """Cumulative daily revenue per return flag."""
    d = (load(spark, sf, "lineitem").groupBy("l_returnflag", F.to_date("l_shipdate").alias("Date"))
         .agg(A.exact_sum(_rev(), 4).alias("revenue")))
    # one row per (flag, day), so RANGE and ROWS totals coincide; the
    # distributed form never puts a whole flag into one window task
    return W.running_total_distributed(d, ["l_returnflag"], "Date", "revenue").withColumn(
        "running_total", rnd("running_total", 4))


@register("nation_revenue_share", "W4, A31", sql=f"""
WITH r AS (SELECT s_nationkey, {rnd_sql(f'sum({REV})', 4)} AS revenue FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1)
SELECT s_nationkey, revenue, revenue / (SELECT {rnd_sql('sum(revenue)', 4)} FROM r) AS share FROM r
""")
def q_nation_revenue_share(spark, sf):
    """Revenue per supplier nation and its share of the total."""
    r = (load(spark, sf, "lineitem").join(load(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
         .groupBy("s_nationkey").agg(A.exact_sum(_rev(), 4).alias("revenue")))
    total = r.select(A.exact_sum(F.col("revenue"), 4)).scalar()
    return r.withColumn("share", F.col("revenue") / total)


@register("top_customers", "W6", sql=f"""
SELECT o_custkey, {rnd_sql('sum(o_totalprice)', 2)} AS revenue FROM orders GROUP BY 1
ORDER BY revenue DESC, o_custkey LIMIT 10
""")
def q_top_customers(spark, sf):
    """Top 10 customers by order value (top-k is the feature)."""
    r = load(spark, sf, "orders").groupBy("o_custkey").agg(A.exact_sum(F.col("o_totalprice"), 2).alias("revenue"))
    return W.top_n(r, [F.col("revenue").desc(), F.col("o_custkey").asc()], 10)


@register("order_supplier_pairs", "U3, P8", sql="""
SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem
""")
def q_order_supplier_pairs(spark, sf):
    """Distinct (order, supplier) rows."""
    return dedupe(load(spark, sf, "lineitem").select("l_orderkey", "l_suppkey"))


@register("nations_in_use", "U2", sql="""
SELECT c_nationkey AS nationkey, 'customer' AS side FROM customer
UNION SELECT s_nationkey, 'supplier' FROM supplier
""")
def q_nations_in_use(spark, sf):
    """Distinct union of the nations used by customers and suppliers."""
    a = load(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"), F.lit("customer").alias("side"))
    b = load(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"), F.lit("supplier").alias("side"))
    return union_distinct(a, b)


@register("latest_order_per_customer", "P8, W6", sql="""
SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, max(o_orderdate) AS o_orderdate
FROM orders GROUP BY 1
""")
def q_latest_order_per_customer(spark, sf):
    """Keep one row per customer: its latest order (fixed tie-break on the key)."""
    o = load(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return dedupe(o, ["o_custkey"], order=["o_orderdate", "o_orderkey"], desc=True)


# =========================================================================== lineage graph
from ..operators import lineage as G  # noqa: E402
from ..session import discard, materialize  # noqa: E402
from .standins import EDGES_SQL, NAMES_SQL, lineage_edges_from_tpch, lineage_names  # noqa: E402

# one row an id and side: the name and type of the source with the least rank that has them
HIERARCHY_SQL = """
known AS (
  SELECT id AS k, 1 AS rank, name AS label, Type AS kind FROM items
  UNION ALL SELECT ReportId, 2, Name, NULL FROM reports
  UNION ALL SELECT DatasourceId, 3, coalesce(path, extensionDataSourcePath, server), DataSourceType FROM sources),
named AS (
  SELECT k, down, arg_min(label, rank) FILTER (label IS NOT NULL) AS label, arg_min(kind, rank) FILTER (kind IS NOT NULL) AS kind
  FROM known, (SELECT unnest([true, false]) AS down) WHERE down OR rank <> 2 GROUP BY k, down),
hierarchy AS (
  SELECT DISTINCT e.UpStreamId, e.UpStreamWorkspaceId, coalesce(u.label, e.UpStreamId) AS UpStreamName, coalesce(u.kind, e.UpStreamType) AS UpStreamType,
    coalesce((SELECT min(WorkspaceName) FROM workspaces WHERE WorkspaceId = e.UpStreamWorkspaceId), 'Data Source') AS UpStreamWorkspaceName,
    e.DownStreamId, e.DownStreamWorkspaceId, coalesce(d.label, e.DownStreamId) AS DownStreamName, coalesce(d.kind, e.DownStreamType) AS DownStreamType,
    coalesce((SELECT min(WorkspaceName) FROM workspaces WHERE WorkspaceId = e.DownStreamWorkspaceId), 'Data Source') AS DownStreamWorkspaceName,
    e.SourceDF
  FROM edges e LEFT JOIN named u ON u.k = e.UpStreamId AND NOT u.down LEFT JOIN named d ON d.k = e.DownStreamId AND d.down
)"""

HITEMS_SQL = """
hitems AS (
  SELECT Id, WorkspaceId, Name, Type, WorkspaceName FROM (
    SELECT *, row_number() OVER (PARTITION BY Id ORDER BY WorkspaceId, Name, Type, WorkspaceName) AS rn FROM (
      SELECT UpStreamId AS Id, UpStreamWorkspaceId AS WorkspaceId, UpStreamName AS Name, UpStreamType AS Type,
             UpStreamWorkspaceName AS WorkspaceName FROM hierarchy WHERE UpStreamId IS NOT NULL
      UNION
      SELECT DownStreamId, DownStreamWorkspaceId, DownStreamName, DownStreamType, DownStreamWorkspaceName
      FROM hierarchy WHERE DownStreamId IS NOT NULL)) WHERE rn = 1
)"""

PATHS_SQL = """
e AS (SELECT DISTINCT UpStreamId AS p, DownStreamId AS c FROM edges WHERE UpStreamId IS NOT NULL AND DownStreamId IS NOT NULL),
nodes AS (SELECT p AS node FROM e UNION SELECT c FROM e),
walk(source, target, path, length) AS (
  SELECT p, c, [p, c], 1 FROM e
  UNION ALL
  SELECT w.source, e.c, list_append(w.path, e.c), w.length + 1 FROM walk w JOIN e ON e.p = w.target
),
best AS (SELECT source, target, min(length) AS length FROM walk WHERE source <> target GROUP BY 1, 2),
paths AS (
  SELECT w.source, w.target, min(w.path) AS path, w.length FROM walk w JOIN best b USING (source, target, length)
  GROUP BY w.source, w.target, w.length
  UNION ALL SELECT node, node, [node, node], 0 FROM nodes
)"""


# the session's shared folder; a local session without one gets its own
LOCAL_CHECKPOINTS = None


#: Edges of one task: a few keys a row are read in large shares, an edge's names and its row in a hash table are wide.
EDGES_PER_TASK = 250_000


def _dealt(df, *keys):
    """Keys dealt to tasks by their number (read from file footers), so that no task's share grows with the table."""
    df = df.select(*keys)
    n = -(-df.count() // EDGES_PER_TASK)
    return df.repartition(n, *keys) if n > 1 else df


def _lineage_inputs(spark, sf):
    t = {n: load(spark, sf, n) for n in ("region", "nation", "customer", "supplier", "part", "lineitem", "orders")}
    t["orders"], t["lineitem"] = _dealt(t["orders"], "o_orderkey", "o_custkey"), _dealt(t["lineitem"], "l_suppkey", "l_partkey")
    edges = lineage_edges_from_tpch(t["region"], t["nation"], t["customer"], t["supplier"], t["lineitem"], t["orders"])
    names = lineage_names(t["region"], t["nation"], t["customer"], t["supplier"], t["part"])
    return edges, names


def _hierarchy(spark, sf):
    edges, names = _lineage_inputs(spark, sf)
    return G.hierarchy(edges, names["workspaces"], names["items"], names["sources"], names["reports"])


@register("lineage_hierarchy", "G1, G2, J1, U1", sql=with_(EDGES_SQL, NAMES_SQL, HIERARCHY_SQL) + "SELECT * FROM hierarchy")
def q_lineage_hierarchy(spark, sf):
    """Edge sets unioned and both ends named through seven left joins."""
    return _hierarchy(spark, sf)


URL_SQL = """CASE WHEN Type IN ('Report', 'SemanticModel', 'Dataflow', 'Lakehouse', 'Warehouse', 'SQLEndpoint', 'DataPipeline')
  THEN 'https://app.powerbi.com/groups/' || lower(WorkspaceId) || '/' ||
       CASE Type WHEN 'Report' THEN 'reports' WHEN 'SemanticModel' THEN 'datasets' WHEN 'Dataflow' THEN 'dataflows-gen2'
                 WHEN 'Lakehouse' THEN 'lakehouses' WHEN 'Warehouse' THEN 'warehouses' WHEN 'SQLEndpoint' THEN 'mirroredwarehouses'
                 WHEN 'DataPipeline' THEN 'pipelines' END || '/' || lower(Id)
  ELSE 'https://app.powerbi.com/groups/' || WorkspaceId END
  || CASE WHEN Type = 'SemanticModel' THEN '/details' ELSE '' END"""


@register("lineage_items", "G3, U2, P20, P8", sql=with_(EDGES_SQL, NAMES_SQL, HIERARCHY_SQL, HITEMS_SQL)
          + f"SELECT *, {URL_SQL} AS url FROM hitems")
def q_lineage_items(spark, sf):
    """Items from both ends of the named edges, one row per id, with URL."""
    return G.hierarchy_items(_hierarchy(spark, sf))


@register("lineage_paths", "G4", sql="WITH RECURSIVE " + EDGES_SQL.strip() + ",\n" + PATHS_SQL.strip()
          + "\nSELECT source, target, array_to_string(path, '>') AS path, length FROM paths")
def q_lineage_paths(spark, sf):
    """All-pairs shortest paths over the lineage edges (BFS frontier joins)."""
    edges, _ = _lineage_inputs(spark, sf)
    edges = materialize(edges.select("UpStreamId", "DownStreamId"), "edges", LOCAL_CHECKPOINTS, codec="zstd")  # read by each slice of the search
    p = G.shortest_paths(edges, checkpoint_dir=LOCAL_CHECKPOINTS)
    discard(edges)
    return p.select("source", "target", F.array_join("path", ">").alias("path"), "length")


@register("lineage_impact", "G5, A4", sql="WITH RECURSIVE " + ",\n".join(
    x.strip() for x in (EDGES_SQL, NAMES_SQL, HIERARCHY_SQL, HITEMS_SQL, PATHS_SQL)) + """,
ws AS (SELECT Id AS n, WorkspaceId AS w FROM hitems),
up AS (SELECT target AS Id, count(source) AS items_upstream,
              count(DISTINCT w) + max(CASE WHEN w IS NULL THEN 1 ELSE 0 END) AS workspaces_upstream, max(length) AS layers_upstream
       FROM paths LEFT JOIN ws ON source = n GROUP BY target),
down AS (SELECT source AS Id, count(target) AS items_downstream,
                count(DISTINCT w) + max(CASE WHEN w IS NULL THEN 1 ELSE 0 END) AS workspaces_downstream, max(length) AS layers_downstream
         FROM paths LEFT JOIN ws ON target = n GROUP BY source)
SELECT i.Id, CAST(coalesce(items_upstream, 0) AS BIGINT) AS items_upstream, CAST(coalesce(items_downstream, 0) AS BIGINT) AS items_downstream,
       CAST(coalesce(workspaces_upstream, 0) AS BIGINT) AS workspaces_upstream, CAST(coalesce(workspaces_downstream, 0) AS BIGINT) AS workspaces_downstream,
       CAST(coalesce(layers_upstream, 0) AS BIGINT) AS layers_upstream, CAST(coalesce(layers_downstream, 0) AS BIGINT) AS layers_downstream
FROM (SELECT DISTINCT Id FROM hitems) i LEFT JOIN up USING (Id) LEFT JOIN down USING (Id)
""")
def q_lineage_impact(spark, sf):
    """Items and workspaces up/down stream and number of layers per item."""
    edges, names = _lineage_inputs(spark, sf)
    # the edge table feeds both the naming joins and the path search: write it once
    edges = materialize(edges, "edges", LOCAL_CHECKPOINTS)
    up, down = (G.hierarchy(ends, names["workspaces"], names["items"], names["sources"], names["reports"]) for ends in G.cut_edges(edges))
    items = materialize(G.hierarchy_items(up.unionByName(down)), "items", LOCAL_CHECKPOINTS)
    return G.reach_measures(edges, items, checkpoint_dir=LOCAL_CHECKPOINTS)


# =========================================================================== engine-trace queries
from ..operators import trace as K  # noqa: E402
from .standins import NOW, TRACE_SQL, trace_from_events  # noqa: E402


def _trace(spark, sf):
    return trace_from_events(load(spark, sf, "events"))


QUERY_END_SQL = f"""OperationName = 'QueryEnd' AND CAST(EventSubclass_s AS INTEGER) = 3 AND ApplicationName_s = 'PowerBI'
  AND TimeGenerated > TIMESTAMP '{NOW}' - INTERVAL 30 DAY"""


def _xml_sql(tag: str) -> str:
    return f"nullif(regexp_extract(ObjectReference_s, '<Object>.*<{tag}>(.*?)</{tag}>', 1), '')"


@register("trace_column_usage", "K1, P23, A40", sql=with_(TRACE_SQL) + f"""
SELECT Table_Column, count(DISTINCT SPID_s) AS Total_Number_Queried FROM (
  SELECT unnest(regexp_extract_all(TextData_s, '(''.*?''\\[.*?\\])', 1)) AS Table_Column, SPID_s FROM trace
  WHERE {QUERY_END_SQL}) GROUP BY 1
""")
def q_trace_column_usage(spark, sf):
    """Distinct sessions per 'Table'[Column] reference in query text (last 30 days)."""
    return K.k_column_usage(_trace(spark, sf), now=NOW)


@register("trace_partition_load_time", "K2, P24, J4", sql=with_(TRACE_SQL) + f"""
, proc AS (
  SELECT ResourceGroup AS Resource_Group, Resource, {_xml_sql('Database')} AS Database, {_xml_sql('Model')} AS Model,
         {_xml_sql('Table')} AS "Table", {_xml_sql('Partition')} AS "Partition", User_s AS "User",
         CAST(Duration_s AS INTEGER) / 1000.0::DOUBLE AS Duration_Seconds, StartTime_t AS Start_Time, EndTime_t AS End_Time,
         concat_ws('-', SPID_s, ObjectPath_s) AS unique_id
  FROM trace WHERE OperationName = 'ProgressReportEnd' AND CAST(Success_s AS INTEGER) = 1 AND CAST(EventSubclass_s AS INTEGER) = 1),
rws AS (SELECT concat_ws('-', SPID_s, ObjectPath_s) AS unique_id, IntegerData_s AS Number_Of_Rows FROM trace
        WHERE OperationName = 'ProgressReportEnd' AND CAST(Success_s AS INTEGER) = 1 AND CAST(EventSubclass_s AS INTEGER) = 17)
SELECT DISTINCT Resource_Group, Resource, Database, Model, "Table", "Partition", "User", Duration_Seconds, Number_Of_Rows,
       Start_Time, End_Time
FROM proc LEFT JOIN rws USING (unique_id)
""")
def q_trace_partition_load_time(spark, sf):
    """Partition processing times with XML object fields and row counts."""
    return K.k_partition_load_time(_trace(spark, sf))


@register("trace_processing_errors", "K3, J5, W6", sql=with_(TRACE_SQL) + """
, errs AS (
  SELECT RootActivityId_g, TextData_s AS Error, ServerName_s AS Server, Resource, User_s AS "User", ApplicationName_s AS Application
  FROM trace WHERE ResourceProvider = 'MICROSOFT.ANALYSISSERVICES' AND OperationName = 'Error' AND coalesce(User_s, '') <> ''),
one AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY RootActivityId_g
          ORDER BY Error, Server, Resource, "User", Application) AS rn FROM errs) WHERE rn = 1),
procs AS (SELECT RootActivityId_g, EndTime_t AS End_Time, DatabaseName_s AS Database, TextData_s AS Details FROM trace
          WHERE ResourceProvider = 'MICROSOFT.ANALYSISSERVICES' AND CAST(Error_s AS BIGINT) = -1055784777
            AND OperationName = 'CommandEnd' AND CAST(EventSubclass_s AS INTEGER) = 38)
SELECT End_Time, Database, Details, Error, Server, Resource, "User", Application
FROM one JOIN procs USING (RootActivityId_g) ORDER BY End_Time DESC
""")
def q_trace_processing_errors(spark, sf):
    """Errors with a user matched (innerunique) to failed processing commands, newest first."""
    return K.k_processing_errors(_trace(spark, sf))


@register("trace_query_load_time", "K4, P25, A40", sql=with_(TRACE_SQL) + f"""
, g AS (SELECT ApplicationContext_s, Resource, avg(CAST(Duration_s AS INTEGER)) / 1000 AS avg_load_time_sec,
               sum(CAST(Duration_s AS INTEGER)) / 1000 AS sum_load_time_sec, count(*) AS count_queries
        FROM trace WHERE {QUERY_END_SQL} GROUP BY 1, 2),
x AS (SELECT *, json_extract_string(json_extract_string(ApplicationContext_s, '$.Sources'), '$[0].ReportId') AS ReportId_,
             json_extract_string(json_extract_string(ApplicationContext_s, '$.Sources'), '$[0].VisualId') AS VisualId_ FROM g)
SELECT avg_load_time_sec, sum_load_time_sec, count_queries, ReportId_, VisualId_,
       'https://app.powerbi.com/groups/me/reports/' || coalesce(ReportId_, '') AS ReportUrl
FROM x ORDER BY sum_load_time_sec DESC
""")
def q_trace_query_load_time(spark, sf):
    """Query load time per application context, with report/visual ids and URL."""
    return K.k_query_load_time(_trace(spark, sf), now=NOW)


@register("trace_re_encoding", "K5, P22, P24", sql=with_(TRACE_SQL) + f"""
SELECT StartTime_t AS Start_Time, EndTime_t AS End_Time, {_xml_sql('Table')} AS "Table",
       CASE WHEN regexp_matches(TextData_s, '<pii>(.*?)</pii>') THEN regexp_extract(TextData_s, '<pii>(.*?)</pii>', 1) END AS "Column",
       CAST(Duration_s AS INTEGER) / 1000.0::DOUBLE AS Duration_Seconds, TextData_s AS Text, {_xml_sql('Database')} AS Database,
       {_xml_sql('Model')} AS Model, {_xml_sql('Partition')} AS "Partition", Resource
FROM trace WHERE OperationName = 'ProgressReportEnd' AND CAST(EventSubclass_s AS INTEGER) = 55
ORDER BY Start_Time DESC
""")
def q_trace_re_encoding(spark, sf):
    """Re-encoding events with XML fields, seconds and the tagged column name."""
    return K.k_re_encoding(_trace(spark, sf))


# =========================================================================== merges
from ..operators import merge as M  # noqa: E402

MERGE_NOW = NOW
OLD_STAMP = "2023-12-31 00:00:00"


@register("events_replace_since", "M1", sql=with_(ACTIVITIES_SQL, ACT_SILVER_SQL) + """
, ex AS (SELECT Id, CreationDate, value FROM silver WHERE CreationDate < DATE '2024-01-20'),
nw AS (SELECT Id, CreationDate, value + 1 AS value FROM silver WHERE CreationDate >= DATE '2024-01-15'),
cut AS (SELECT least((SELECT min(CreationDate) FROM nw), (SELECT max(CreationDate) FROM ex)) AS c)
SELECT * FROM ex WHERE CreationDate < (SELECT c FROM cut)
UNION ALL SELECT * FROM nw WHERE CreationDate >= (SELECT c FROM cut)
""")
def q_events_replace_since(spark, sf):
    """High-water-mark reload: an existing table up to 01-19 replaced from the new
    load's first day (01-15) onwards."""
    s = _activities(spark, sf).select("Id", "CreationDate", "value")
    existing = s.filter(F.col("CreationDate") < F.lit("2024-01-20").cast("date"))
    new = s.filter(F.col("CreationDate") >= F.lit("2024-01-15").cast("date")).withColumn("value", F.col("value") + 1)
    return M.replace_since(existing, new, "CreationDate")


def _orders_merge_inputs(spark, sf):
    o = load(spark, sf, "orders")
    target = o.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.lit(OLD_STAMP).cast("timestamp").alias("modified_at"),
        (F.col("o_orderpriority") == "5-LOW").alias("is_deleted"))
    source = o.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", F.lit("F").alias("o_orderstatus"), "o_totalprice")
    return target, source


ORDERS_MERGE_SQL = f"""
t AS (SELECT o_orderkey, o_orderstatus, o_totalprice, TIMESTAMP '{OLD_STAMP}' AS modified_at,
             o_orderpriority = '5-LOW' AS is_deleted FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
s AS (SELECT o_orderkey, 'F' AS o_orderstatus, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
merged AS (
  SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
    CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
    CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
    CASE WHEN s.o_orderkey IS NOT NULL THEN TIMESTAMP '{MERGE_NOW}'
         WHEN NOT coalesce(t.is_deleted, false) THEN TIMESTAMP '{MERGE_NOW}' ELSE t.modified_at END AS modified_at,
    CASE WHEN s.o_orderkey IS NOT NULL THEN false WHEN NOT coalesce(t.is_deleted, false) THEN true
         ELSE t.is_deleted END AS is_deleted
  FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey)"""


@register("orders_upsert_soft_delete", "M2", sql=with_(ORDERS_MERGE_SQL) + "SELECT * FROM merged")
def q_orders_upsert_soft_delete(spark, sf):
    """Upsert with soft delete: matched rows updated, new rows inserted, rows missing
    from the new load flagged deleted (once)."""
    target, source = _orders_merge_inputs(spark, sf)
    return M.upsert_soft_delete(target, source, ["o_orderkey"], now=MERGE_NOW)


@register("orders_live_after_merge", "A1, A2, M2", sql=with_(ORDERS_MERGE_SQL) + """
SELECT o_orderstatus, count(*) AS live_count FROM merged WHERE NOT coalesce(is_deleted, false) GROUP BY 1
""")
def q_orders_live_after_merge(spark, sf):
    """Live (not deleted) orders per status after the soft-delete merge."""
    target, source = _orders_merge_inputs(spark, sf)
    return A.live_count(M.upsert_soft_delete(target, source, ["o_orderkey"], now=MERGE_NOW), by=["o_orderstatus"])


CUST_MERGE_SQL = """
t AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal < 5000),
s AS (SELECT c_custkey, c_acctbal + 100 AS c_acctbal, 'UPDATED-' || c_mktsegment AS c_mktsegment FROM customer
      WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))"""


def _cust_merge_inputs(spark, sf):
    c = load(spark, sf, "customer")
    target = c.filter(F.col("c_acctbal") < 5000).select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    source = c.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        "c_custkey", (F.col("c_acctbal") + 100).alias("c_acctbal"),
        F.concat(F.lit("UPDATED-"), F.col("c_mktsegment")).alias("c_mktsegment"))
    return target, source


@register("customer_upsert", "M3", sql=with_(CUST_MERGE_SQL) + """
SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, t.c_name,
  CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
  CASE WHEN s.c_custkey IS NOT NULL THEN s.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment
FROM t FULL OUTER JOIN s ON t.c_custkey = s.c_custkey
""")
def q_customer_upsert(spark, sf):
    """Upsert on keys with the union of both schemas."""
    target, source = _cust_merge_inputs(spark, sf)
    return M.upsert(target, source, ["c_custkey"])


@register("customer_upsert_cols", "M4", sql=with_(CUST_MERGE_SQL) + """
SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, t.c_name,
  CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
  CASE WHEN t.c_custkey IS NOT NULL THEN t.c_mktsegment ELSE s.c_mktsegment END AS c_mktsegment
FROM t FULL OUTER JOIN s ON t.c_custkey = s.c_custkey
""")
def q_customer_upsert_cols(spark, sf):
    """Upsert updating only the balance; other columns keep the target's values."""
    target, source = _cust_merge_inputs(spark, sf)
    return M.upsert(target, source, ["c_custkey"], update_cols=["c_acctbal"])


@register("orders_insert_new", "M5", sql="""
WITH t AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
s AS (SELECT o_orderkey, 'X' AS o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT * FROM t UNION ALL SELECT * FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)
""")
def q_orders_insert_new(spark, sf):
    """Insert only the keys the target does not have."""
    o = load(spark, sf, "orders")
    t = o.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).select("o_orderkey", "o_orderstatus")
    s = o.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"))
    return M.insert_new(t, s, ["o_orderkey"])


@register("customer_domain_update", "M6", sql="""
SELECT c.c_custkey, c.c_name, u.DomainId FROM customer c
LEFT JOIN (SELECT c_custkey, 'dom-' || CAST(c_nationkey AS VARCHAR) AS DomainId FROM customer WHERE c_mktsegment = 'BUILDING') u
ON c.c_custkey = u.c_custkey
""")
def q_customer_domain_update(spark, sf):
    """Update-only enrichment: set DomainId where the key matches (column added first)."""
    c = load(spark, sf, "customer")
    src = c.filter(F.col("c_mktsegment") == "BUILDING").select(
        "c_custkey", F.concat(F.lit("dom-"), F.col("c_nationkey").cast("string")).alias("DomainId"))
    return M.update_from(c.select("c_custkey", "c_name"), src, ["c_custkey"], ["DomainId"])


@register("customer_settings_stamped", "M7", sql="""
SELECT DATE '2024-01-29' AS TransferDate, TIMESTAMP '2024-01-29 06:00:00' AS TransferDateTime, c_custkey, c_mktsegment FROM customer
UNION ALL
SELECT DATE '2024-01-30', TIMESTAMP '2024-01-30 06:00:00', c_custkey, c_mktsegment FROM customer WHERE c_acctbal > 0
""")
def q_customer_settings_stamped(spark, sf):
    """Two stamped snapshot appends (TransferDate, TransferDateTime)."""
    c = load(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    day1 = M.append_stamped(None, c.select("c_custkey", "c_mktsegment"), "2024-01-29 06:00:00")
    return M.append_stamped(day1, c.filter(F.col("c_acctbal") > 0).select("c_custkey", "c_mktsegment"),
                            "2024-01-30 06:00:00")


@register("customer_snapshot_daily", "M8", sql="""
SELECT DATE '2024-01-29' AS Snapshot_Date, '2024-01-29_' || CAST(c_custkey AS VARCHAR) AS Snapshot_c_custkey,
       '2024-01-29_' || CAST(c_nationkey AS VARCHAR) AS Snapshot_c_nationkey, c_custkey, c_nationkey, c_acctbal FROM customer
UNION ALL
SELECT DATE '2024-01-30', '2024-01-30_' || CAST(c_custkey AS VARCHAR), '2024-01-30_' || CAST(c_nationkey AS VARCHAR),
       c_custkey, c_nationkey, c_acctbal + 1 FROM customer
""")
def q_customer_snapshot_daily(spark, sf):
    """Daily snapshot history; the re-run of a day replaces that day's rows."""
    c = load(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    ids = ["c_custkey", "c_nationkey"]
    h = M.snapshot_daily(None, c, ids, "2024-01-29")
    h = M.snapshot_daily(h, c, ids, "2024-01-30")
    rerun = c.withColumn("c_acctbal", F.col("c_acctbal") + 1)
    return M.snapshot_daily(h, rerun, ids, "2024-01-30").select(
        "Snapshot_Date", "Snapshot_c_custkey", "Snapshot_c_nationkey", "c_custkey", "c_nationkey", "c_acctbal")


# =========================================================================== scalar transforms & dims
from ..functions import scalar as P  # noqa: E402
from ..operators.flatten import anonymise, decode_enum, extract_all_rows  # noqa: E402
from ..sources.dims import day_spine, static_dims, timepoint_dim  # noqa: E402


@register("lineitem_keys", "P12, P13", sql="""
SELECT l_orderkey, l_linenumber, sha256(concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))) AS line_sha,
       concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS line_key FROM lineitem
""")
def q_lineitem_keys(spark, sf):
    """Surrogate (SHA-256 of '-'-joined parts) and composite text keys."""
    li = load(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", P.sha_key("l_orderkey", "l_linenumber").alias("line_sha"),
                     P.text_key(["l_orderkey", "l_linenumber"], "-").alias("line_key"))


@register("activity_anonymised", "P26", sql=with_(ACTIVITIES_SQL, ACT_SILVER_SQL) + f"""
SELECT Id, CreationDate, CASE WHEN CreationDate < DATE '{TODAY}' - INTERVAL 14 DAY THEN md5(UserId) ELSE UserId END AS UserId,
       CreationDate < DATE '{TODAY}' - INTERVAL 14 DAY AS IsAnonymised FROM silver
""")
def q_activity_anonymised(spark, sf):
    """User ids hashed (md5) for activities older than 14 days, with a guard flag."""
    a = _activities(spark, sf).select("Id", "CreationDate", "UserId")
    return anonymise(a, ["UserId"], "CreationDate", after_days=14, today=TODAY)


@register("activity_status_counts", "P10, A5", sql=with_(ACTIVITIES_SQL, ACT_SILVER_SQL) + """
, st AS (SELECT Activity, CASE WHEN ResultStatus = 'Failed' THEN 'Failed' WHEN ResultStatus = 'InProgress' THEN 'InProgress'
            WHEN ResultStatus = 'Succeeded' THEN 'Succeeded' WHEN CAST(IsSuccess AS INTEGER) = 1 THEN 'Succeeded'
            ELSE 'N/A' END AS s FROM silver)
SELECT Activity, count(CASE WHEN s = 'Failed' THEN 1 END) AS failed, count(CASE WHEN s = 'InProgress' THEN 1 END) AS in_progress,
       count(CASE WHEN s = 'Succeeded' THEN 1 END) AS succeeded, count(CASE WHEN s = 'N/A' THEN 1 END) AS not_available
FROM st GROUP BY 1
""")
def q_activity_status_counts(spark, sf):
    """Resolved activity status counted per activity (conditional counts)."""
    a = _activities(spark, sf).withColumn("s", P.activity_status())
    return A.conditional_counts(a, {"failed": F.col("s") == "Failed", "in_progress": F.col("s") == "InProgress",
                                    "succeeded": F.col("s") == "Succeeded", "not_available": F.col("s") == "N/A"},
                                by=["Activity"])


@register("part_type_counts", "A2", sql="""
SELECT p_brand, p_type, count(*) AS item_count FROM part GROUP BY 1, 2
""")
def q_part_type_counts(spark, sf):
    """Items per type (parts per type and brand)."""
    return A.count_by_type(load(spark, sf, "part"), "p_type", by=["p_brand"])


@register("activity_success_ratio", "A34", sql=with_(ACTIVITIES_SQL, ACT_SILVER_SQL) + """
SELECT CreationDate, count(DISTINCT Id) AS requests, count(DISTINCT CASE WHEN NOT IsSuccess THEN Id END) AS failed_requests,
       CAST(count(DISTINCT CASE WHEN IsSuccess THEN Id END) AS DOUBLE) / count(DISTINCT Id) AS success_ratio
FROM silver GROUP BY 1
""")
def q_activity_success_ratio(spark, sf):
    """Distinct requests, failed requests and success ratio per day."""
    return A.success_ratio(_activities(spark, sf), "Id", "IsSuccess", True, False, by=["CreationDate"])


@register("event_counter_averages", "A33", sql=f"""
SELECT CAST(ts AS DATE) AS Date,
  ({rnd_sql("sum(CASE WHEN event_type = 'view' THEN value END)", 2)} / count(CASE WHEN event_type = 'view' THEN value END)) * 100.0 AS cpu,
  ({rnd_sql("sum(CASE WHEN event_type = 'click' THEN value END)", 2)} / count(CASE WHEN event_type = 'click' THEN value END)) * 1.0 AS memory,
  ({rnd_sql("sum(CASE WHEN event_type = 'purchase' THEN value END)", 2)} / count(CASE WHEN event_type = 'purchase' THEN value END)) * 8.0 AS threads
FROM events GROUP BY 1
""")
def q_event_counter_averages(spark, sf):
    """Average of each named counter per day (scaled: x100, x1, x8 cores)."""
    e = load(spark, sf, "events").withColumn("Date", F.to_date("ts"))
    return A.counter_averages(e, "event_type", "value", {"cpu": "view", "memory": "click", "threads": "purchase"},
                              by=["Date"], scale={"cpu": 100.0, "threads": 8.0}, decimals=2)


@register("supplier_vs_all", "A38", sql=f"""
WITH d AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS Date, {rnd_sql(f'sum({REV})', 4)} AS v FROM lineitem GROUP BY 1, 2),
b AS (SELECT {rnd_sql('sum(v)', 4)} / count(v) AS all_avg FROM d
      WHERE Date >= DATE '{SHIP_TODAY}' - INTERVAL 90 DAY AND Date <= DATE '{SHIP_TODAY}'),
r AS (SELECT l_suppkey, {rnd_sql('sum(v)', 4)} / count(v) AS item_avg FROM d
      WHERE Date >= DATE '{SHIP_TODAY}' - INTERVAL 7 DAY AND Date <= DATE '{SHIP_TODAY}' GROUP BY 1)
SELECT l_suppkey, item_avg, all_avg, item_avg - all_avg AS difference,
       CASE WHEN all_avg <> 0 THEN (item_avg - all_avg) / all_avg END AS difference_pct, item_avg - all_avg > 0 AS above
FROM r, b
""")
def q_supplier_vs_all(spark, sf):
    """Each supplier's 7-day daily average against the 90-day average of all suppliers' days."""
    return A.item_vs_all(load(spark, sf, "lineitem"), "l_suppkey", "l_shipdate", _rev(), SHIP_TODAY, decimals=4)


@register("lineitem_throttling", "A19", sql="""
SELECT l_returnflag, count(CASE WHEN l_discount * 20 > 1.0 THEN 1 END) AS high_discount,
       count(CASE WHEN l_tax * 20 > 1.0 THEN 1 END) AS high_tax FROM lineitem GROUP BY 1
""")
def q_lineitem_throttling(spark, sf):
    """Rows whose percentage (discount, tax x 20) exceeds 100 %."""
    li = load(spark, sf, "lineitem")
    return A.throttling_counts(li, {"high_discount": F.col("l_discount") * 20, "high_tax": F.col("l_tax") * 20},
                               by=["l_returnflag"])


@register("nation_utilisation", "A18", sql=f"""
SELECT s_nationkey, {rnd_sql('sum(l_quantity)', 2)} AS used, {rnd_sql('sum(50.0)', 2)} AS available,
       {rnd_sql('sum(l_quantity)', 2)} / {rnd_sql('sum(50.0)', 2)} AS utilisation
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1
""")
def q_nation_utilisation(spark, sf):
    """Quantity used against capacity (50 per line) per supplier nation."""
    j = load(spark, sf, "lineitem").join(load(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return A.utilisation(j, "l_quantity", F.lit(50.0), by=["s_nationkey"], decimals=2)


@register("supplier_schedule_slots", "A20", sql="""
WITH d AS (SELECT DISTINCT l_suppkey, strftime(CAST(l_shipdate AS DATE), '%a') AS Day, l_suppkey % 2 = 0 AS Enabled FROM lineitem),
t AS (SELECT DISTINCT l_suppkey, lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || ':00' AS Time FROM lineitem),
s AS (SELECT DISTINCT d.l_suppkey, Day, Enabled, Time FROM d JOIN t USING (l_suppkey))
SELECT l_suppkey, count(CASE WHEN Enabled = true THEN 1 END) AS slots_enabled,
       count(CASE WHEN Enabled = false THEN 1 END) AS slots_disabled, count(*) AS slots_any FROM s GROUP BY 1
""")
def q_supplier_schedule_slots(spark, sf):
    """Schedule expansion: distinct (item, day, time) slots, counted by enabled state."""
    li = load(spark, sf, "lineitem")
    days = li.select("l_suppkey", F.date_format("l_shipdate", "E").alias("Day"),
                     (F.col("l_suppkey") % 2 == 0).alias("Enabled"))
    times = li.select("l_suppkey", F.concat(F.lpad(F.col("l_linenumber").cast("string"), 2, "0"), F.lit(":00")).alias("Time"))
    slots = A.refresh_schedule_slots(days, times, ["l_suppkey"])
    return A.refresh_slot_counts(slots, by=["l_suppkey"])


@register("order_quantity_attached", "A30", sql=f"""
SELECT o.o_orderkey AS l_orderkey, o.o_orderstatus, q.quantity FROM orders o
LEFT JOIN (SELECT l_orderkey, {rnd_sql('sum(l_quantity)', 2)} AS quantity FROM lineitem GROUP BY 1) q ON o.o_orderkey = q.l_orderkey
""")
def q_order_quantity_attached(spark, sf):
    """Sum of line quantities attached to each order."""
    o = load(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    return A.attach_sum(o, load(spark, sf, "lineitem"), ["l_orderkey"], "l_quantity", "quantity", decimals=2)


@register("part_type_statistics", "A31, W4", sql=f"""
WITH s AS (SELECT p_type, count(*) AS records, count(DISTINCT p_brand) AS brands, {rnd_sql('sum(p_retailprice)', 2)} AS size
           FROM part GROUP BY 1)
SELECT *, size / (SELECT {rnd_sql('sum(size)', 2)} FROM s) AS share FROM s
""")
def q_part_type_statistics(spark, sf):
    """Per type: records, distinct brands, size and share of the total size."""
    s = load(spark, sf, "part").groupBy("p_type").agg(F.count(F.lit(1)).alias("records"),
                                                      F.count_distinct("p_brand").alias("brands"),
                                                      A.exact_sum(F.col("p_retailprice"), 2).alias("size"))
    total = s.select(A.exact_sum(F.col("size"), 2)).scalar()
    return s.withColumn("share", F.col("size") / total)


@register("customer_day_spine", "S12", sql=f"""
WITH d AS (SELECT c_custkey, CAST(unnest(generate_series(DATE '2001-07-29', DATE '{ORDERS_TODAY}', INTERVAL 1 DAY)) AS DATE) AS Date
           FROM customer),
o AS (SELECT o_custkey AS c_custkey, CAST(o_orderdate AS DATE) AS Date, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT d.c_custkey, d.Date, coalesce(o.n, 0) AS orders FROM d LEFT JOIN o USING (c_custkey, Date)
""")
def q_customer_day_spine(spark, sf):
    """One row per (customer, day) for the last 4 days, zero-filled order counts."""
    spine = day_spine(load(spark, sf, "customer").select("c_custkey"), "2001-07-29", ORDERS_TODAY)
    o = (load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("Date"))
         .agg(F.count(F.lit(1)).alias("n")))
    return spine.join(o, ["c_custkey", "Date"], "left").select("c_custkey", "Date",
                                                               F.coalesce("n", F.lit(0)).alias("orders"))


@register("event_timepoints", "S11", sql="""
SELECT DISTINCT ts AS TimePoint, CAST(ts AS DATE) AS Date, date_trunc('hour', ts) AS Hour FROM events
""")
def q_event_timepoints(spark, sf):
    """Distinct time points with date and truncated hour."""
    t = timepoint_dim(load(spark, sf, "events"), "ts")
    return t.withColumn("Hour", F.col("Hour").cast("timestamp_ntz"))


TITLE_SQL = """CASE WHEN strpos(html, '<title>') > 0 AND strpos(substr(html, strpos(html, '<title>') + 7), '</title>') > 0
  THEN substr(substr(html, strpos(html, '<title>') + 7), 1, strpos(substr(html, strpos(html, '<title>') + 7), '</title>') - 1)
  ELSE '' END"""


@register("page_titles", "P16", sql=f"""
SELECT page_id, {TITLE_SQL} AS title, CASE WHEN strpos(url, '?') > 0 THEN split_part(url, '?', 2) ELSE '' END AS query
FROM pages
""")
def q_page_titles(spark, sf):
    """Text between delimiters: page title, and the URL query after '?'."""
    p = load(spark, sf, "pages")
    return p.select("page_id", P.between("html", "<title>", "</title>").alias("title"),
                    F.when(F.locate("?", F.col("url")) > 0, F.substring_index(F.substring_index("url", "?", -1), "?", 1))
                    .otherwise(F.lit("")).alias("query"))


@register("page_links", "P23, A40", sql="""
SELECT link, count(DISTINCT page_id) AS pages FROM (
  SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages) GROUP BY 1
""")
def q_page_links(spark, sf):
    """Every href of every page (one row per match), distinct pages per link."""
    rows = extract_all_rows(load(spark, sf, "pages"), "html", r'href="([^"]*)"', out="link")
    return rows.groupBy("link").agg(F.count_distinct("page_id").alias("pages"))


@register("order_line_totals", "P15", sql=f"""
SELECT l_orderkey, '[' || string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) || ']' AS line_list,
       {rnd_sql('sum(l_quantity)', 2)} AS total_quantity, CAST(sum(l_linenumber) AS BIGINT) AS line_sum FROM lineitem GROUP BY 1
""")
def q_order_line_totals(spark, sf):
    """Number-list text per order ('[1,2,3]') and its parsed sum."""
    g = load(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list("l_linenumber")).cast("array<string>"), ","),
                 F.lit("]")).alias("line_list"),
        A.exact_sum(F.col("l_quantity"), 2).alias("total_quantity"))
    return g.withColumn("line_sum", P.sum_bracket_list("line_list").cast("long"))


@register("order_io_rates", "P18, P19, A32", sql=f"""
SELECT l_orderkey, {rnd_sql('sum(l_extendedprice)', 2)} * 1024 / 1048576.0 AS megabytes,
       CASE WHEN count(*) * 250 <> 0 THEN ({rnd_sql('sum(l_extendedprice)', 2)} * 1024) / (count(*) * 250 / 1000.0) END AS bytes_per_sec,
       count(*) * 250 / 1000.0 AS seconds
FROM lineitem GROUP BY 1
""")
def q_order_io_rates(spark, sf):
    """Bytes scaled to megabytes, bytes per second and milliseconds as seconds."""
    g = load(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        (A.exact_sum(F.col("l_extendedprice"), 2) * 1024).alias("bytes"), (F.count(F.lit(1)) * 250).alias("ms"))
    return g.select("l_orderkey", P.to_unit("bytes", "megabytes").alias("megabytes"),
                    P.io_rate("bytes", "ms").alias("bytes_per_sec"), P.to_unit("ms", "seconds", kind="time").alias("seconds"))


@register("order_ship_durations", "P7, P6", sql="""
SELECT l_returnflag, strftime(o_orderdate, '%Y%m%d') AS OrderDateKey, count(*) AS n,
       sum(epoch(l_shipdate) - epoch(o_orderdate))::BIGINT AS total_s, max(epoch(l_shipdate) - epoch(o_orderdate))::BIGINT AS max_s
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2
""")
def q_order_ship_durations(spark, sf):
    """Seconds from order to shipment, per return flag and order DateKey."""
    j = load(spark, sf, "lineitem").join(load(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    d = j.select("l_returnflag", P.date_parts("o_orderdate", "Order")["OrderDateKey"].alias("OrderDateKey"),
                 P.duration_s("o_orderdate", "l_shipdate").alias("s"))
    return d.groupBy("l_returnflag", "OrderDateKey").agg(F.count(F.lit(1)).alias("n"), F.sum("s").alias("total_s"),
                                                         F.max("s").alias("max_s"))


@register("part_size_modes", "P27, S8", sql="""
WITH e AS (SELECT * FROM (VALUES (0, 'Import'), (1, 'DirectQuery'), (2, 'Default'), (3, 'Push'), (4, 'Dual'), (5, 'DirectLake')) t(Enum, Name))
SELECT p_partkey, p_size % 8 AS mode_code, coalesce(e.Name, CAST(p_size % 8 AS VARCHAR)) AS mode
FROM part LEFT JOIN e ON p_size % 8 = e.Enum
""")
def q_part_size_modes(spark, sf):
    """Enum decoding through a fixed lookup table; unmatched codes kept as text."""
    p = load(spark, sf, "part").select("p_partkey", (F.col("p_size") % 8).alias("mode_code"))
    return decode_enum(p, "mode_code", static_dims(spark)["partition_mode_enum"], "mode")


@register("supplier_size_measures", "A25", sql="""
SELECT l_suppkey, sum(CAST(l_quantity AS BIGINT) * 4096) / 1024.0 AS bytes_kilobytes,
       sum(CAST(l_linenumber AS BIGINT) * 512) / 1024.0 AS rows_kilobytes FROM lineitem GROUP BY 1
""")
def q_supplier_size_measures(spark, sf):
    """Size sums per supplier in a chosen unit (kilobytes)."""
    li = load(spark, sf, "lineitem").select("l_suppkey", (F.col("l_quantity").cast("long") * 4096).alias("bytes"),
                                            (F.col("l_linenumber").cast("long") * 512).alias("rows"))
    return A.size_measures(li, ["bytes", "rows"], by=["l_suppkey"], unit="kilobytes")


# =========================================================================== more stand-ins
from ..operators import rules as B  # noqa: E402
from ..operators.flatten import connection_string  # noqa: E402
from ..operators.tables import build_sql_requests  # noqa: E402
from .standins import (DATASOURCES_SQL, SQL_REQUESTS_SQL, datasources_from_suppliers,  # noqa: E402
                       model_columns_from_parts, sql_requests_from_events)


@register("lineitem_line_index", "W5", sql="""
SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS INTEGER) AS Index
FROM lineitem
""")
def q_lineitem_line_index(spark, sf):
    """1-based row index of each line within its order."""
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return W.row_index(li, ["l_orderkey"], ["l_linenumber", "l_partkey"]).drop("l_partkey")


@register("sql_request_daily", "T22, A37, P14", sql=with_(SQL_REQUESTS_SQL) + """
, r AS (SELECT *, CAST(CAST(start_time AS TIMESTAMP) AS DATE) AS start_date FROM sqlreq)
SELECT start_date, sum(total_elapsed_time_ms) / 1000.0 AS elapsed, max(total_elapsed_time_ms) / 1000.0 AS max_elapsed,
       sum(allocated_cpu_time_ms) / 1000.0 AS cpu, max(allocated_cpu_time_ms) / 1000.0 AS max_cpu,
       CAST(sum(row_count) AS BIGINT) AS rows, max(row_count) AS max_rows, count(CASE WHEN result_cache_hit = 2 THEN 1 END) AS cache_hits,
       sum(data_scanned_disk_mb) AS scanned_disk_mb, sum(data_scanned_memory_mb) AS scanned_memory_mb,
       sum(data_scanned_remote_storage_mb) AS scanned_remote_mb, count(*) AS requests,
       CAST(count(CASE WHEN lower(status) = 'succeeded' THEN 1 END) AS DOUBLE) / count(*) AS success_rate
FROM r GROUP BY 1
""")
def q_sql_request_daily(spark, sf):
    """SQL request history per start date: elapsed/CPU time, rows, cache hits, data scanned, success rate."""
    req = build_sql_requests(sql_requests_from_events(load(spark, sf, "events")))
    return A.sql_request_measures(req, by=["start_date"])


@register("datasource_connection_strings", "P21, T12", sql=with_(DATASOURCES_SQL) + r"""
, j AS (SELECT DatasourceId, DatasourceType, ext_kind,
          concat_ws(' ', nullif(trim(ext_kind), ''), nullif(trim(url), ''), nullif(trim(server), ''),
                    nullif(trim(database), ''), nullif(trim(path), '')) AS joined FROM dsi)
SELECT DatasourceId, DatasourceType,
  CASE WHEN DatasourceType = 'Extension' THEN ext_kind ELSE DatasourceType END AS DatasourceKind,
  CASE WHEN regexp_matches(joined, '"host":"([^"]+)","httpPath":"([^"]+)"')
       THEN regexp_extract(joined, '"host":"([^"]+)"', 1) || ' ' || replace(regexp_extract(joined, '"httpPath":"([^"]+)"', 1), '\/', '/')
       ELSE joined END AS ConnectionString
FROM j
""")
def q_datasource_connection_strings(spark, sf):
    """Data-source kind and connection string from the connection-detail fields."""
    ds = datasources_from_suppliers(load(spark, sf, "supplier"))
    return connection_string(ds).select("DatasourceId", "DatasourceType", "DatasourceKind", "ConnectionString")


COLUMN_RULES = [1, 2, 25, 46, 47, 57, 58, 59, 60]


@register("part_column_rule_violations", "B1, B10", sql="""
WITH c AS (
  SELECT p_brand AS ModelId, p_type AS TableName, p_name AS ColumnName,
    CASE p_size % 5 WHEN 0 THEN 'Double' WHEN 1 THEN 'Int64' WHEN 2 THEN 'DateTime' WHEN 3 THEN 'String' ELSE 'Decimal' END AS DataType,
    CASE WHEN p_size % 7 = 0 THEN 'Calculated' ELSE 'Data' END AS Type, p_size % 3 = 0 AS IsHidden,
    CASE WHEN p_size % 4 = 0 THEN 'Sum' ELSE 'None' END AS SummarizeBy,
    CASE WHEN p_size % 6 = 0 THEN 'mm/dd/yyyy' ELSE '' END AS FormatString,
    CASE WHEN p_size % 9 = 0 THEN '' ELSE 'src_' || CAST(p_partkey AS VARCHAR) END AS SourceColumn FROM part),
v AS (
  SELECT ModelId, 1 AS RuleId, 'Column' AS ObjectType, TableName, ColumnName AS ObjectName FROM c WHERE DataType = 'Double'
  UNION ALL SELECT ModelId, 2, 'Column', TableName, ColumnName FROM c WHERE Type = 'Calculated'
  UNION ALL SELECT ModelId, 25, 'Column', TableName, ColumnName FROM c WHERE Type = 'Data' AND length(SourceColumn) = 0
  UNION ALL SELECT ModelId, 46, 'Column', TableName, ColumnName FROM c
            WHERE regexp_matches(ColumnName, '(?i)date') AND DataType = 'DateTime' AND FormatString <> 'mm/dd/yyyy'
  UNION ALL SELECT ModelId, 47, 'Column', TableName, ColumnName FROM c
            WHERE DataType IN ('Int64', 'Decimal', 'Double') AND SummarizeBy <> 'None' AND NOT IsHidden
  UNION ALL SELECT ModelId, 57, 'Column', TableName, ColumnName FROM c
            WHERE (starts_with(lower(ColumnName), 'is') AND DataType = 'Int64' AND NOT IsHidden)
               OR (ends_with(lower(ColumnName), ' flag') AND DataType <> 'String' AND NOT IsHidden)
  UNION ALL SELECT ModelId, 58, 'Column', TableName, ColumnName FROM c WHERE starts_with(ColumnName, ' ') OR ends_with(ColumnName, ' ')
  UNION ALL SELECT ModelId, 59, 'Column', TableName, ColumnName FROM c WHERE substr(ColumnName, 1, 1) <> upper(substr(ColumnName, 1, 1))
  UNION ALL SELECT ModelId, 60, 'Column', TableName, ColumnName FROM c WHERE regexp_matches(ColumnName, '[\t\r\n]'))
SELECT ModelId, RuleId, count(*) AS violations, count(DISTINCT ObjectName) AS objects FROM v GROUP BY 1, 2
""")
def q_part_column_rule_violations(spark, sf):
    """Column best-practice rules over a column catalogue (one column per part), counted per model and rule."""
    cols = model_columns_from_parts(load(spark, sf, "part"))
    empty = lambda schema: spark.createDataFrame([], schema)
    meta = {"columns": cols,
            "tables": cols.select("ModelId", "TableName", F.lit(False).alias("IsHidden"), F.lit("").alias("Description"),
                                  F.lit("").alias("DataCategory")).distinct(),
            "measures": empty("ModelId string, TableName string, MeasureName string, IsHidden boolean, Description string"),
            "partitions": empty("ModelId string, TableName string, PartitionName string"),
            "hierarchies": empty("ModelId string, TableName string, HierarchyName string, ColumnName string")}
    v = B.bpa(meta, COLUMN_RULES).filter(F.col("ObjectType") == "Column")
    return v.groupBy("ModelId", "RuleId").agg(F.count(F.lit(1)).alias("violations"),
                                              F.count_distinct("ObjectName").alias("objects"))


# =========================================================================== refreshables
from ..operators.tables import build_refreshables  # noqa: E402
from .standins import REFRESHABLES_SQL, refreshables_from_orders  # noqa: E402


def _refreshables(spark, sf):
    return build_refreshables(refreshables_from_orders(load(spark, sf, "orders")))


@register("refreshables_main", "T8", sql=with_(REFRESHABLES_SQL) + """
SELECT DISTINCT CapacityId, WorkspaceId, ItemId, ItemName, IsRefreshEnabled, LocalTimeZoneId, Kind FROM rf
""")
def q_refreshables_main(spark, sf):
    """Refreshables: main attributes per item."""
    return _refreshables(spark, sf)["main"]


@register("refreshables_days", "T8", sql=with_(REFRESHABLES_SQL) + """
SELECT DISTINCT CapacityId, WorkspaceId, ItemId, day1 AS Day FROM rf
UNION SELECT DISTINCT CapacityId, WorkspaceId, ItemId, day2 FROM rf
""")
def q_refreshables_days(spark, sf):
    """Refreshables: scheduled days (exploded, distinct)."""
    return _refreshables(spark, sf)["days"]


@register("refreshables_summaries", "T8, P6, P7, P9", sql=with_(REFRESHABLES_SQL) + """
SELECT DISTINCT CapacityId, WorkspaceId, ItemId, ItemName, strftime(start_ts, '%Y%m%d') AS ConsideredStartDateKey,
       CAST(start_ts AS DATE) AS ConsideredStartDate, CAST(end_ts AS DATE) AS ConsideredEndDate,
       start_ts AS ConsideredStartTime, end_ts AS ConsideredEndTime, RefreshAverageDuration, RefreshMedianDuration,
       RefreshCount, CAST(epoch(end_ts) - epoch(start_ts) AS BIGINT) AS ConsiderationDurationSeconds
FROM rf WHERE NOT end_sentinel
""")
def q_refreshables_summaries(spark, sf):
    """Refreshables: consideration window summaries (sentinel end dates dropped, duration)."""
    return _refreshables(spark, sf)["summaries"]


@register("refreshables_details", "T8, P6, P7", sql=with_(REFRESHABLES_SQL) + """
SELECT DISTINCT CapacityId, WorkspaceId, ItemId, ItemName, RequestId, strftime(last_start, '%Y%m%d') AS LastRefreshStartDateKey,
       Status, RefreshType, CAST(last_start AS DATE) AS LastRefreshStartDate, CAST(last_end AS DATE) AS LastRefreshEndDate,
       last_start AS LastRefreshStartTime, last_end AS LastRefreshEndTime, strftime(last_start, '%-H') AS LastRefreshStartHour,
       strftime(last_end, '%-H') AS LastRefreshEndHour, CAST(epoch(last_end) - epoch(last_start) AS BIGINT) AS DurationInSeconds
FROM rf WHERE RequestId IS NOT NULL
""")
def q_refreshables_details(spark, sf):
    """Refreshables: last refresh details with duration."""
    return _refreshables(spark, sf)["details"]


@register("refresh_schedule_counts", "A20, T8", sql=with_(REFRESHABLES_SQL) + """
, d AS (SELECT DISTINCT WorkspaceId, ItemId, day1 AS Day, IsRefreshEnabled AS Enabled FROM rf
        UNION SELECT DISTINCT WorkspaceId, ItemId, day2, IsRefreshEnabled FROM rf),
t AS (SELECT DISTINCT WorkspaceId, ItemId, time1 AS Time FROM rf UNION SELECT DISTINCT WorkspaceId, ItemId, time2 FROM rf),
s AS (SELECT DISTINCT d.WorkspaceId, d.ItemId, Day, Enabled, Time FROM d JOIN t USING (WorkspaceId, ItemId))
SELECT WorkspaceId, count(CASE WHEN Enabled = true THEN 1 END) AS slots_enabled,
       count(CASE WHEN Enabled = false THEN 1 END) AS slots_disabled, count(*) AS slots_any FROM s GROUP BY 1
""")
def q_refresh_schedule_counts(spark, sf):
    """Scheduled refresh slots (item x day x time) per workspace, by enabled state."""
    r = _refreshables(spark, sf)
    days = r["days"].join(r["main"].select("WorkspaceId", "ItemId", F.col("IsRefreshEnabled").alias("Enabled")),
                          ["WorkspaceId", "ItemId"])
    slots = A.refresh_schedule_slots(days, r["times"], ["WorkspaceId", "ItemId"])
    return A.refresh_slot_counts(slots, by=["WorkspaceId"])


# =========================================================================== tenant scan
from ..operators.tables import (build_datasource_usages, build_inventory_table, build_item_users,  # noqa: E402
                                build_semantic_model_metadata)
from .standins import SCAN_SQL, scan_workspaces_from_customers  # noqa: E402


def _scan(spark, sf):
    return scan_workspaces_from_customers(load(spark, sf, "customer"))


@register("scan_reports", "T10, P5, P2, P3", sql=with_(SCAN_SQL) + """
SELECT upper(ws) AS WorkspaceId, upper('rep-' || CAST(k AS VARCHAR)) AS ReportId, 'Report ' || CAST(k AS VARCHAR) AS Name,
       upper('sm-' || CAST(k AS VARCHAR)) AS SemanticModelId, upper(ws) AS SemanticModelWorkspaceId,
       'PowerBIReport' AS ReportType, created AS CreatedDateTime, created AS ModifiedDateTime FROM sc
""")
def q_scan_reports(spark, sf):
    """Inventory child table: reports of the scanned workspaces."""
    t = build_inventory_table(_scan(spark, sf), "reports")
    return t.select("WorkspaceId", "ReportId", "Name", "SemanticModelId", "SemanticModelWorkspaceId", "ReportType",
                    "CreatedDateTime", "ModifiedDateTime")


@register("scan_semantic_models", "T10, P5", sql=with_(SCAN_SQL) + """
SELECT upper(ws) AS WorkspaceId, upper('sm-' || CAST(k AS VARCHAR)) AS SemanticModelId, 'Model ' || CAST(k AS VARCHAR) AS Name,
       upper('owner' || CAST(n AS VARCHAR) || '@x') AS ConfiguredById, created AS CreatedDateTime,
       CASE WHEN k % 2 = 0 THEN 'PbixInImportMode' ELSE 'InDirectQueryMode' END AS ContentProviderType,
       'Abf' AS StorageMode, substr(created, 1, 10) AS CreatedDate FROM sc
""")
def q_scan_semantic_models(spark, sf):
    """Inventory child table: semantic models (nested arrays dropped, renamed, sliced)."""
    return build_inventory_table(_scan(spark, sf), "semantic_models")


@register("scan_lakehouses", "T10, P5", sql=with_(SCAN_SQL) + """
SELECT upper(ws) AS WorkspaceId, upper('lh-' || CAST(k AS VARCHAR)) AS LakehouseId, 'LH ' || CAST(k AS VARCHAR) AS Name,
       '' AS Description, 'Active' AS State, created AS CreatedDateTime, upper('o' || CAST(n AS VARCHAR)) AS CreatedById,
       substr(created, 1, 10) AS CreatedDate FROM sc WHERE k % 4 = 0
""")
def q_scan_lakehouses(spark, sf):
    """Inventory child table: lakehouses (common item shape)."""
    return build_inventory_table(_scan(spark, sf), "lakehouses")


@register("scan_workspace_users", "T10, P5", sql=with_(SCAN_SQL) + """
SELECT upper(ws) AS WorkspaceId, 'u' || CAST(k AS VARCHAR) || '@x' AS Identifier,
       CASE k % 3 WHEN 0 THEN 'Admin' WHEN 1 THEN 'Member' ELSE 'Viewer' END AS GroupUserAccessRight,
       'User' AS PrincipalType, 'Member' AS UserType, 'g' || CAST(k AS VARCHAR) AS GraphId FROM sc
""")
def q_scan_workspace_users(spark, sf):
    """Inventory child table: workspace users (no id field: all-empty rows dropped)."""
    return build_inventory_table(_scan(spark, sf), "workspaces_scanned_users")


@register("scan_model_datasources", "T11", sql=with_(SCAN_SQL) + """
SELECT upper(ws) AS WorkspaceId, upper('sm-' || CAST(k AS VARCHAR)) AS SemanticModelId,
       upper('ds-' || CAST(k % 100 AS VARCHAR)) AS datasourceInstanceId FROM sc
""")
def q_scan_model_datasources(spark, sf):
    """Semantic model -> data-source instance usage edges."""
    return build_datasource_usages(_scan(spark, sf))["semantic_model_datasources"]


@register("scan_item_users", "T13", sql=with_(SCAN_SQL) + """
SELECT upper(ws) AS WorkspaceId, upper('rep-' || CAST(k AS VARCHAR)) AS ItemId, 'reports' AS ItemType,
       'Report ' || CAST(k AS VARCHAR) AS ItemName, CASE WHEN k % 2 = 1 THEN 'Owner' ELSE 'Read' END AS AccessRight,
       '' AS EmailAddress, '' AS DisplayName, 'v' || CAST(k AS VARCHAR) || '@x' AS Identifier, '' AS GraphId,
       'User' AS PrincipalType, '' AS UserType FROM sc
UNION ALL
SELECT upper(ws), upper('sm-' || CAST(k AS VARCHAR)), 'datasets', 'Model ' || CAST(k AS VARCHAR), 'ReadWrite', '', '',
       'u' || CAST(k AS VARCHAR) || '@x', '', 'User', '' FROM sc
UNION ALL
SELECT upper(ws), upper('lh-' || CAST(k AS VARCHAR)), 'Lakehouse', 'LH ' || CAST(k AS VARCHAR), 'Read', '', '',
       'w' || CAST(k AS VARCHAR) || '@x', '', '', '' FROM sc WHERE k % 4 = 0
""")
def q_scan_item_users(spark, sf):
    """Every user of every item, with access-right fallbacks."""
    return build_item_users(_scan(spark, sf))


@register("scan_model_columns", "T14, P12", sql=with_(SCAN_SQL) + """
, t AS (SELECT *, sha256('sm-' || CAST(k AS VARCHAR) || '-' || 'Sales' || CAST(n AS VARCHAR)) AS TableId FROM sc)
SELECT TableId, sha256(TableId || '-' || 'Amount') AS ColumnId, 'Amount' AS ColumnName, 'Data' AS ColumnType,
       'Double' AS DataType, false AS isHidden, CAST(NULL AS VARCHAR) AS Expression FROM t
UNION ALL
SELECT TableId, sha256(TableId || '-' || 'Key' || CAST(n AS VARCHAR)), 'Key' || CAST(n AS VARCHAR), 'Data', 'Int64', true,
       CAST(NULL AS VARCHAR) FROM t
""")
def q_scan_model_columns(spark, sf):
    """Semantic-model columns with chained SHA-256 keys."""
    return build_semantic_model_metadata(_scan(spark, sf))["columns"]


# =========================================================================== small feeds
from ..operators import tables as T  # noqa: E402
from . import standins as SI  # noqa: E402


@register("active_items", "T2, P4, P9, P8", sql="""
SELECT upper(CASE WHEN p_partkey % 50 = 0 THEN '00000000-0000-0000-0000-000000000000' ELSE 'item-' || CAST(p_partkey AS VARCHAR) END) AS id,
       p_name AS name, p_type AS type, 'Active' AS state, upper('ws-' || CAST(p_partkey % 30 AS VARCHAR)) AS workspaceId,
       upper('cap-' || CAST(p_size % 7 AS VARCHAR)) AS capacityId, 'u' || CAST(p_size AS VARCHAR) || '@x' AS creatorUserPrincipalName
FROM part WHERE p_partkey % 50 <> 0
""")
def q_active_items(spark, sf):
    """Active items: upper-cased keys, creator promoted, duplicates and the zero id removed."""
    t = T.build_active_items(SI.active_items_from_parts(load(spark, sf, "part")))
    return t.drop("creatorPrincipal")


@register("domains_flat", "T4", sql="""
WITH d AS (
  SELECT DISTINCT upper('dom-' || lower(c_mktsegment)) AS DomainId, c_mktsegment AS DomainName, CAST(NULL AS VARCHAR) AS ParentDomainId,
         'AllTenant' AS DomainContributorsScope FROM customer
  UNION ALL
  SELECT upper('dom-c' || CAST(c_custkey AS VARCHAR)), c_name, upper('dom-' || lower(c_mktsegment)), 'AdminsOnly' FROM customer)
SELECT g.DomainId, g.DomainContributorsScope, g.DomainName AS OriginalDomainName, g.ParentDomainId AS OriginalParentDomainId,
       CASE WHEN g.ParentDomainId IS NULL THEN g.DomainName ELSE md.DomainName END AS MainDomainName,
       CASE WHEN g.ParentDomainId IS NOT NULL THEN g.DomainName ELSE 'Without Subdomain' END AS SubDomainName,
       CASE WHEN g.ParentDomainId IS NOT NULL THEN 1 ELSE 0 END AS IsSubDomain
FROM d g LEFT JOIN d md ON g.ParentDomainId = md.DomainId
""")
def q_domains_flat(spark, sf):
    """Domains flattened against their parent domain."""
    return T.build_domains(T.build_domains_silver(SI.domains_from_customers(load(spark, sf, "customer"))))


@register("capacity_users", "T5", sql="""
SELECT upper('cap-' || CAST(s_suppkey AS VARCHAR)) AS CapacityId, 'Admin' AS role, s_name AS "user" FROM supplier
UNION ALL SELECT upper('cap-' || CAST(s_suppkey AS VARCHAR)), 'Contributor', 'u' || CAST(s_nationkey AS VARCHAR) || '@x' FROM supplier
UNION ALL SELECT upper('cap-' || CAST(s_suppkey AS VARCHAR)), 'Contributor', 'v' || CAST(s_suppkey % 13 AS VARCHAR) || '@x' FROM supplier
""")
def q_capacity_users(spark, sf):
    """Capacity admins and users, one row each."""
    return T.build_capacity_users(SI.capacities_from_suppliers(load(spark, sf, "supplier")))


@register("tenant_setting_groups", "T6", sql="""
SELECT 'Setting' || CAST(c_custkey AS VARCHAR) AS settingName, TIMESTAMP '2024-01-30 06:00:00' AS TransferDateTime,
       'g' || CAST(c_nationkey AS VARCHAR) AS graphId, 'Group ' || CAST(c_nationkey AS VARCHAR) AS name FROM customer
UNION ALL
SELECT 'Setting' || CAST(c_custkey AS VARCHAR), TIMESTAMP '2024-01-30 06:00:00', 'h' || CAST(c_custkey % 3 AS VARCHAR),
       'Team ' || CAST(c_custkey % 3 AS VARCHAR) FROM customer
""")
def q_tenant_setting_groups(spark, sf):
    """Enabled security groups per tenant-setting snapshot."""
    return T.build_enabled_security_groups(SI.tenant_settings_from_customers(load(spark, sf, "customer")))


@register("delegated_overrides", "T7", sql="""
SELECT 'cap-' || CAST(s_suppkey AS VARCHAR) AS OverrideId, 'cap-' || CAST(s_suppkey AS VARCHAR) AS CapacityId,
       'Export' AS tenantSettingGroup, 'Export to Excel' AS title, 'Tenant' AS delegatedFrom, 'ExportToExcel' AS settingName,
       s_acctbal > 0 AS enabled, true AS canSpecifySecurityGroups FROM supplier
UNION ALL
SELECT 'cap-' || CAST(s_suppkey AS VARCHAR), 'cap-' || CAST(s_suppkey AS VARCHAR), 'Publish', 'Publish to web', 'Tenant',
       'PublishToWeb', s_nationkey % 2 = 0, true FROM supplier
""")
def q_delegated_overrides(spark, sf):
    """Delegated tenant-setting overrides, two-level explode."""
    return T.build_delegated_overrides(SI.overrides_from_suppliers(load(spark, sf, "supplier")))


@register("widely_shared_items", "T9, P4, P2", sql="""
SELECT c_name AS item_displayName, 'Report' AS artifactType, 'View' AS accessRight, 'PublishToWeb' AS shareType,
       'Sharer ' || CAST(c_nationkey AS VARCHAR) AS sharer_displayName, 's' || CAST(c_nationkey AS VARCHAR) || '@x' AS sharer_emailAddress,
       'g' || CAST(c_nationkey AS VARCHAR) AS sharer_graphId, 's' || CAST(c_nationkey AS VARCHAR) || '@x' AS sharer_identifier,
       'User' AS sharer_principalType, upper('art-' || CAST(c_custkey AS VARCHAR)) AS ItemId FROM customer
""")
def q_widely_shared_items(spark, sf):
    """Widely-shared artifacts with the sharer promoted."""
    return T.build_widely_shared(SI.shared_items_from_customers(load(spark, sf, "customer")))


# =========================================================================== gateway logs
def _qe(spark, sf):
    return T.build_query_execution(SI.query_execution_logs_from_lineitem(load(spark, sf, "lineitem")))


def _qs(spark, sf):
    return T.build_query_start(SI.query_start_logs_from_lineitem(load(spark, sf, "lineitem")))


@register("gateway_query_execution", "T15, P10, P13", sql=with_(SI.QUERY_EXECUTION_SQL) + """
SELECT RequestId, QueryTrackingId, kind AS "DataSource.kind", path AS "DataSource.path", qdur AS "QueryExecutionDuration(ms)",
       end_ts AS QueryExecutionEndTimeUTC, CAST(end_ts AS DATE) AS QueryExecutionEndDate, RequestId || QueryTrackingId AS RequestTrackingKey,
       CASE WHEN Success = 'Y' THEN 'Success' WHEN Success = 'N' THEN 'Error' ELSE 'N/A' END AS SuccessStatus
FROM qe
""")
def q_gateway_query_execution(spark, sf):
    """Query-execution fact: one row per request x data source (JSON list parsed, kind/path fallbacks)."""
    return _qe(spark, sf).select("RequestId", "QueryTrackingId", "`DataSource.kind`", "`DataSource.path`",
                                 "`QueryExecutionDuration(ms)`", "QueryExecutionEndTimeUTC", "QueryExecutionEndDate",
                                 "RequestTrackingKey", "SuccessStatus")


@register("gateway_durations", "A32", sql=with_(SI.QUERY_EXECUTION_SQL) + """
SELECT GatewayObjectId,
  sum(qdur) / 1000.0 AS "sum_QueryExecutionDuration(ms)", max(qdur) / 1000.0 AS "max_QueryExecutionDuration(ms)",
  avg(qdur) / 1000.0 AS "avg_QueryExecutionDuration(ms)",
  sum(pdur) / 1000.0 AS "sum_DataProcessingDuration(ms)", max(pdur) / 1000.0 AS "max_DataProcessingDuration(ms)",
  avg(pdur) / 1000.0 AS "avg_DataProcessingDuration(ms)",
  sum(rdur) / 1000.0 AS "sum_DataReadingAndSerializationDuration(ms)", max(rdur) / 1000.0 AS "max_DataReadingAndSerializationDuration(ms)",
  avg(rdur) / 1000.0 AS "avg_DataReadingAndSerializationDuration(ms)", count(*) AS rows
FROM qe GROUP BY 1
""")
def q_gateway_durations(spark, sf):
    """Query, processing and serialisation times per gateway (seconds)."""
    cols = ["QueryExecutionDuration(ms)", "DataProcessingDuration(ms)", "DataReadingAndSerializationDuration(ms)"]
    qe = _qe(spark, sf).select("GatewayObjectId", *[F.col(f"`{c}`").alias(c) for c in cols])
    return A.time_measures(qe, [f"`{c}`" for c in cols], by=["GatewayObjectId"], unit="seconds") \
        .toDF("GatewayObjectId", *[f"{a}_{c}" for c in cols for a in ("sum", "max", "avg")], "rows")


@register("gateway_success", "A34", sql=with_(SI.QUERY_EXECUTION_SQL) + """
SELECT GatewayObjectId, count(DISTINCT RequestId) AS requests,
       count(DISTINCT CASE WHEN NOT Success = 'Y' THEN RequestId END) AS failed_requests,
       CAST(count(DISTINCT CASE WHEN Success = 'Y' THEN RequestId END) AS DOUBLE) / count(DISTINCT RequestId) AS success_ratio
FROM qe GROUP BY 1
""")
def q_gateway_success(spark, sf):
    """Distinct and failed requests and the success ratio per gateway."""
    return A.success_ratio(_qe(spark, sf), "RequestId", "Success", by=["GatewayObjectId"])


@register("gateway_query_texts", "T17, P17", sql=with_(SI.QUERY_START_SQL) + """
SELECT RequestId, QueryTrackingId, RequestId || QueryTrackingId AS RequestTrackingKey,
       'SELECT * FROM t' || CAST(pk AS VARCHAR) || ' WHERE q > ' || CAST(ln AS VARCHAR) AS QueryText FROM qs
""")
def q_gateway_query_texts(spark, sf):
    """Query texts decoded from base64 (code page 1252), line breaks as spaces."""
    return _qs(spark, sf)["texts"]


@register("gateway_evaluation_context", "T18", sql=with_(SI.QUERY_START_SQL) + """
SELECT GatewayObjectId, RequestId, QueryTrackingId, RequestId || QueryTrackingId AS RequestTrackingKey, 'svc' AS serviceName,
       'DatasetId' AS key, 'm' || CAST(pk % 50 AS VARCHAR) AS value FROM qs
UNION ALL SELECT GatewayObjectId, RequestId, QueryTrackingId, RequestId || QueryTrackingId, 'svc', 'WorkspaceId',
       'w' || CAST(sk % 10 AS VARCHAR) FROM qs
UNION ALL SELECT GatewayObjectId, RequestId, QueryTrackingId, RequestId || QueryTrackingId, 'svc', 'Host Context Type',
       CASE WHEN ln % 2 = 0 THEN 'Refresh' ELSE 'Query' END FROM qs
""")
def q_gateway_evaluation_context(spark, sf):
    """Evaluation context: (service, key, value) per request, application context excluded."""
    return _qs(spark, sf)["evaluation_context"]


@register("gateway_application_context", "T19", sql=with_(SI.QUERY_START_SQL) + """
SELECT GatewayObjectId, RequestId, QueryTrackingId, RequestId || QueryTrackingId AS RequestTrackingKey, 'svc' AS serviceName,
       'ApplicationContext' AS key, 'm' || CAST(pk % 50 AS VARCHAR) AS SemanticModelId, 'r' || CAST(pk % 20 AS VARCHAR) AS ReportId,
       'v' || CAST(ln AS VARCHAR) AS VisualId, 'Web' AS ConsumptionMethod, 's' || CAST(ok % 100 AS VARCHAR) AS UserSession FROM qs
""")
def q_gateway_application_context(spark, sf):
    """Application context: report, visual, consumption method and session per request."""
    return _qs(spark, sf)["application_context"]


@register("gateway_service_mapping", "T20", sql=with_(SI.QUERY_START_SQL) + """
SELECT RequestId || QueryTrackingId AS RequestTrackingKey, max('m' || CAST(pk % 50 AS VARCHAR)) AS SemanticModelId,
       max('w' || CAST(sk % 10 AS VARCHAR)) AS WorkspaceId
FROM qs GROUP BY 1
""")
def q_gateway_service_mapping(spark, sf):
    """Context keys pivoted to columns per tracked request (repeated keys keep the greatest value)."""
    return _qs(spark, sf)["service_mapping"]


@register("gateway_host_types", "T20", sql=with_(SI.QUERY_START_SQL) + """
SELECT RequestId || QueryTrackingId AS RequestTrackingKey, max(CASE WHEN ln % 2 = 0 THEN 'Refresh' ELSE 'Query' END) AS "Host Context Type"
FROM qs GROUP BY 1
""")
def q_gateway_host_types(spark, sf):
    """Host context type of every tracked request."""
    return _qs(spark, sf)["host_types"]


@register("gateway_request_context", "A36", sql=with_(SI.QUERY_START_SQL) + """
SELECT RequestId, max('w' || CAST(sk % 10 AS VARCHAR)) AS RefreshWorkspaceId, min('m' || CAST(pk % 50 AS VARCHAR)) AS SemanticModelId
FROM qs GROUP BY 1
""")
def q_gateway_request_context(spark, sf):
    """Refresh workspace id (greatest) and model id (least) per request."""
    return A.request_context_values(_qs(spark, sf)["evaluation_context"])


@register("gateway_mashup", "T21, P15", sql="""
SELECT 'r' || CAST(l_orderkey AS VARCHAR) AS RequestId, 't' || CAST(l_linenumber AS VARCHAR) AS QueryTrackingId,
       CAST(CAST(l_quantity AS BIGINT) + l_linenumber AS DOUBLE) AS TotalRowsSum, CAST(l_shipdate AS DATE) AS EndDate,
       'r' || CAST(l_orderkey AS VARCHAR) || 't' || CAST(l_linenumber AS VARCHAR) AS RequestTrackingKey,
       CAST(l_partkey * 10 AS BIGINT) AS TotalBytes, CAST(trunc(l_quantity * 11) AS BIGINT) AS "TotalProcessorTime(ms)"
FROM lineitem
""")
def q_gateway_mashup(spark, sf):
    """Mashup evaluation fact: number-list rows summed, end date, key."""
    m = T.build_mashup_evaluation(SI.mashup_logs_from_lineitem(load(spark, sf, "lineitem")))
    return m.select("RequestId", "QueryTrackingId", "TotalRowsSum", "EndDate", "RequestTrackingKey", "TotalBytes",
                    "`TotalProcessorTime(ms)`")


@register("gateway_mashup_by_date", "A35, T21", sql=with_(SI.QUERY_EXECUTION_SQL) + """
, m AS (SELECT CAST(l_shipdate AS DATE) AS EndDate, l_suppkey * 100 AS ac, l_suppkey * 130 AS mc, l_partkey * 100 AS aw,
               l_partkey * 150 AS mw, CAST(round(l_discount * 100) AS BIGINT) AS ap, CAST(round(l_tax * 100) + 50 AS BIGINT) AS mp,
               CAST(trunc(l_quantity * 11) AS BIGINT) AS tp, CAST(CAST(l_quantity AS BIGINT) + l_linenumber AS DOUBLE) AS tr FROM lineitem),
ma AS (SELECT EndDate, avg(ac) AS avg_commit, max(mc) AS max_commit, avg(aw) AS avg_working_set, avg(mw) AS max_working_set_avg,
              avg(ap) AS avg_processor_pct, max(CAST(mp AS DOUBLE)) AS max_processor_pct, CAST(sum(tp) AS BIGINT) AS total_processor_ms,
              sum(tr) AS total_rows FROM m GROUP BY 1),
e AS (SELECT CAST(end_ts AS DATE) AS EndDate, count(DISTINCT RequestId) AS requests FROM qe GROUP BY 1)
SELECT ma.*, e.requests FROM ma LEFT JOIN e USING (EndDate)
""")
def q_gateway_mashup_by_date(spark, sf):
    """Mashup measures per end date with the requests executed that day."""
    m = T.build_mashup_evaluation(SI.mashup_logs_from_lineitem(load(spark, sf, "lineitem")))
    m = m.withColumns({c: F.col(f"`{c}`").cast("long") for c in ("AverageCommit(byte)", "MaxCommit(byte)",
                                                                 "AverageWorkingSet(byte)", "MaxWorkingSet(byte)",
                                                                 "AveragePercentProcessorTime")})
    m = m.withColumn("MaxPercentProcessorTime", F.col("MaxPercentProcessorTime").cast("double"))
    return A.mashup_by_end_date(m, _qe(spark, sf))


@register("gateway_counters", "T21, A33", sql="""
SELECT CAST(l_shipdate + INTERVAL 1 HOUR AS DATE) AS AggregationEndDate,
  avg(CASE WHEN l_linenumber % 3 = 0 THEN l_quantity / 2 END) * 100.0 AS cpu,
  avg(CASE WHEN l_linenumber % 3 = 1 THEN l_quantity / 2 END) * 1.0 AS memory,
  avg(CASE WHEN l_linenumber % 3 = 2 THEN l_quantity / 2 END) * 1.0 AS threads
FROM lineitem GROUP BY 1
""")
def q_gateway_counters(spark, sf):
    """System counters per day: average CPU (x100), memory and threads."""
    c = T.build_system_counters(SI.counter_logs_from_lineitem(load(spark, sf, "lineitem")))
    return A.counter_averages(c, "CounterName", "Average", {"cpu": "CPU", "memory": "Memory", "threads": "Threads"},
                              by=["AggregationEndDate"], scale={"cpu": 100.0})


# =========================================================================== T3, T16, T24, T27, A29
@register("workspaces_with_domains", "T3, P3, M6", sql="""
SELECT upper('cap-' || CAST(c.c_nationkey AS VARCHAR)) AS CapacityId, upper('ws-' || CAST(c.c_custkey AS VARCHAR)) AS WorkspaceId,
       'Completed' AS CapacityMigrationStatus, CASE WHEN c.c_custkey % 2 = 0 THEN 'Small' ELSE 'Large' END AS DefaultDatasetStorageFormat,
       '' AS Description, c.c_custkey % 5 = 0 AS HasWorkspaceLevelSettings, c.c_acctbal > 5000 AS IsOnDedicatedCapacity,
       false AS IsReadOnly, c.c_name AS WorkspaceName, CASE WHEN c.c_acctbal < 0 THEN 'Deleted' ELSE 'Active' END AS State,
       'Workspace' AS Type,
       CASE WHEN c.c_custkey % 3 = 0 THEN upper('dom-' || lower(c.c_mktsegment)) END AS DomainId
FROM customer c
""")
def q_workspaces_with_domains(spark, sf):
    """Workspaces projected with defaults (missing description -> ''), keys upper-cased, domain attached."""
    c = load(spark, sf, "customer")
    return T.build_workspaces(SI.workspaces_from_customers(c), SI.workspace_domains_from_customers(c))


@register("gateway_aggregations", "T16", sql="""
SELECT DISTINCT 'gw-' || CAST(l_suppkey % 5 AS VARCHAR) AS GatewayObjectId, l_shipdate AS AggregationStartTimeUTC,
       l_shipdate + INTERVAL 1 HOUR AS AggregationEndTimeUTC, CASE WHEN l_returnflag = 'R' THEN 'N' ELSE 'Y' END AS Success,
       CAST(l_linenumber * 100 AS BIGINT) AS "AverageQueryExecutionDuration(ms)", CAST(l_linenumber AS BIGINT) AS Count,
       'Sql' AS "DataSource.kind", 'srv' || CAST(l_suppkey % 3 AS VARCHAR) || ';db' AS "DataSource.path",
       CAST(l_shipdate + INTERVAL 1 HOUR AS DATE) AS AggregationEndDate
FROM lineitem
""")
def q_gateway_aggregations(spark, sf):
    """Aggregation-report fact: data sources parsed, values typed, duplicate rows removed."""
    a = T.build_query_execution_aggregation(SI.aggregation_logs_from_lineitem(load(spark, sf, "lineitem")))
    return a.select("GatewayObjectId", "AggregationStartTimeUTC", "AggregationEndTimeUTC", "Success",
                    "`AverageQueryExecutionDuration(ms)`", "Count", "`DataSource.kind`", "`DataSource.path`",
                    "AggregationEndDate").distinct()


@register("model_query_list", "T24, U2", sql=with_(SCAN_SQL) + """
SELECT OriginalName, CASE WHEN k % 2 = 0 THEN '🎚️ ' ELSE '✏️ ' END || OriginalName AS Name, 'group ' || CAST(k % 3 AS VARCHAR) AS QueryGroupId,
       CASE WHEN k % 2 = 0 THEN '🎚️ Parameter' ELSE '✏️ Shared Expression' END AS Type, 'SUM(Sales[Amount])' AS Expression
FROM (SELECT 'Total ' || CAST(k AS VARCHAR) AS OriginalName, k FROM sc)
UNION ALL
SELECT 'Sales' || CAST(n AS VARCHAR), '📘 Sales' || CAST(n AS VARCHAR), 'group ' || CAST(k % 3 AS VARCHAR), '📘 Table (Partitions)',
       'let x = ' || CAST(k AS VARCHAR) FROM sc
""")
def q_model_query_list(spark, sf):
    """Queries of the models: partition queries and expressions in one shape, repeated rows kept."""
    md = build_semantic_model_metadata(_scan(spark, sf))
    number = lambda c: F.regexp_extract(c, "([0-9]+)", 1).cast("long")
    group = lambda c: SI._cat("group ", number(c) % 3).alias("QueryGroupID")
    exprs = md["measures"].select(F.col("MeasureName").alias("Name"), "Expression", group("MeasureName"),
                                  F.when(number("MeasureName") % 2 == 0, "P").otherwise("M").alias("ExpressionType"))
    parts = md["partitions"].join(md["tables"].select("TableId", "TableName"), "TableId") \
        .select("TableName", F.col("Expression").alias("QueryDefinition"), group("Expression"))
    return T.build_query_list(exprs, parts)


@register("archive_candidates", "T27, W6", sql="""
WITH i AS (SELECT upper('item-' || CAST(p_partkey AS VARCHAR)) AS id, p_name AS name, p_type AS type,
                  upper('ws-' || CAST(p_partkey % 30 AS VARCHAR)) AS workspaceId
           FROM part WHERE p_partkey % 50 <> 0 AND p_type = 'MEDIUM'),
w AS (SELECT DISTINCT upper('ws-' || CAST(p_partkey % 30 AS VARCHAR)) AS workspaceId,
             'Workspace ' || CAST(p_partkey % 30 AS VARCHAR) AS WorkspaceName FROM part)
SELECT i.workspaceId, i.id, i.name, i.type, w.WorkspaceName FROM i LEFT JOIN w USING (workspaceId)
WHERE w.WorkspaceName = 'Workspace 2'
""")
def q_archive_candidates(spark, sf):
    """Live items of one type in the workspace of that name, with the workspace name, ordered."""
    p = load(spark, sf, "part")
    items = T.build_active_items(SI.active_items_from_parts(p)).select("workspaceId", "id", "name", "type")
    ws = p.select(F.upper(SI._cat("ws-", F.col("p_partkey") % 30)).alias("WorkspaceId"),
                  SI._cat("Workspace ", F.col("p_partkey") % 30).alias("WorkspaceName")).distinct()
    return T.build_archive_candidates(items, ws, "MEDIUM", "Workspace 2")


@register("document_coverage", "A29", sql="""
SELECT lang, CAST(count(nullif(trim(text), '')) AS DOUBLE) / count(*) AS documented_ratio FROM documents GROUP BY 1
""")
def q_document_coverage(spark, sf):
    """Share of documents with non-blank text per language (documentation ratio)."""
    return A.documentation_ratio(load(spark, sf, "documents"), "text", by=["lang"])


@register("gateway_bad_records", "S5", sql="""
SELECT 'QueryExecutionReport_' || CAST(l_suppkey % 4 AS VARCHAR) || '.log' AS FileName, l_orderkey * 8 + l_linenumber AS RowNumber,
       'broken' AS Value
FROM lineitem WHERE l_linenumber = 7
""")
def q_gateway_bad_records(spark, sf):
    """File name and row of every log row whose JSON column does not parse."""
    from ..sources.logs import bad_json_rows
    li = load(spark, sf, "lineitem")
    logs = li.select(SI._cat("QueryExecutionReport_", F.col("l_suppkey") % 4, ".log").alias("FileName"),
                     (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("RowNumber"),
                     SI.datasource_text(F.col("l_linenumber"), F.col("l_suppkey"), F.col("l_partkey")).alias("DataSource"))
    return bad_json_rows(logs, "DataSource")


MEASURE_RULES = [14, 28, 29, 30, 32, 33, 34, 35, 36, 37, 48, 50, 51]


def _empty_meta(spark):
    e = lambda schema: spark.createDataFrame([], schema)
    return {"hierarchies": e("ModelId string, TableName string, HierarchyName string, ColumnName string"),
            "partitions": e("ModelId string, TableName string, PartitionName string, Mode string"),
            "tables": e("ModelId string, TableName string, IsHidden boolean, Description string"),
            "columns": e("ModelId string, TableName string, ColumnName string, IsHidden boolean, Description string")}


@register("measure_rule_violations", "B8, B9", sql="""
WITH m AS (
  SELECT 'model-' || CAST(l_suppkey % 20 AS VARCHAR) AS ModelId, 'Sales' || CAST(l_partkey % 5 AS VARCHAR) AS TableName,
         'M' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS MeasureName,
         """ + SI.MEASURE_TEMPLATES_SQL + """ AS e, l_linenumber % 4 = 0 AS IsHidden,
         CASE l_returnflag WHEN 'A' THEN '#,0' WHEN 'N' THEN '0.0%' ELSE '' END AS FormatString FROM lineitem),
d AS (SELECT ModelId, regexp_replace(e, '\\s+', '', 'g') AS norm FROM m GROUP BY 1, 2 HAVING count(DISTINCT MeasureName) > 1),
v AS (
  SELECT ModelId, 14 AS RuleId, MeasureName FROM m WHERE starts_with(replace(e, ' ', ''), '0+') OR ends_with(replace(e, ' ', ''), '+0')
      OR regexp_matches(e, '(?i)DIVIDE\\s*\\(\\s*[^,]+,\\s*[^,]+,\\s*0\\s*\\)') OR regexp_matches(e, '(?i)IFERROR\\s*\\(\\s*[^,]+,\\s*0\\s*\\)')
  UNION ALL SELECT ModelId, 28, MeasureName FROM m WHERE regexp_matches(e, '(?i)iferror\\s*\\(')
  UNION ALL SELECT ModelId, 29, MeasureName FROM m WHERE regexp_matches(e, '(?i)intersect\\s*\\(')
  UNION ALL SELECT ModelId, 30, MeasureName FROM m WHERE regexp_matches(e, '(?i)evaluateandlog\\s*\\(')
  UNION ALL SELECT m.ModelId, 32, MeasureName FROM m JOIN d ON m.ModelId = d.ModelId AND regexp_replace(m.e, '\\s+', '', 'g') = d.norm
  UNION ALL SELECT ModelId, 33, MeasureName FROM m WHERE regexp_matches(e, '(?i)DIVIDE\\s*\\((\\s*.*?)\\)\\s*[+-]\\s*1|\\/\\s*.*[-+]\\s*1')
  UNION ALL SELECT ModelId, 34, MeasureName FROM m
      WHERE regexp_matches(e, '(?i)[0-9]+\\s*[-+]\\s*[\\(]*\\s*SUM\\s*\\(\\s*''*[A-Za-z0-9 _]+''*\\s*\\[[A-Za-z0-9 _]+\\]\\s*\\)\\s*/')
         OR regexp_matches(e, '(?i)[0-9]+\\s*[-+]\\s*DIVIDE\\s*\\(')
  UNION ALL SELECT ModelId, 35, MeasureName FROM m
      WHERE regexp_matches(e, '(?i)CALCULATE\\s*\\(\\s*[^,]+,\\s*FILTER\\s*\\(\\s*''*[A-Za-z0-9 _]+''*\\s*,\\s*\\[[^\\]]+\\]')
         OR regexp_matches(e, '(?i)CALCULATETABLE\\s*\\(\\s*[^,]*,\\s*FILTER\\s*\\(\\s*''*[A-Za-z0-9 _]+''*\\s*,\\s*\\[')
  UNION ALL SELECT ModelId, 36, MeasureName FROM m
      WHERE regexp_matches(e, '(?i)CALCULATE\\s*\\(\\s*[^,]+,\\s*FILTER\\s*\\(\\s*''*[A-Za-z0-9 _]+''*\\s*,\\s*''*[A-Za-z0-9 _]+''*\\[[A-Za-z0-9 _]+\\]')
         OR regexp_matches(e, '(?i)CALCULATETABLE\\s*\\([^,]*,\\s*FILTER\\s*\\(\\s*''*[A-Za-z0-9 _]+''*\\s*,\\s*''*[A-Za-z0-9 _]+''*\\[[A-Za-z0-9 _]+\\]')
  UNION ALL SELECT ModelId, 37, MeasureName FROM m
      WHERE regexp_matches(e, '\\]\\s*\\/([^/*]|$)') OR regexp_matches(e, '\\)\\s*\\/([^/*]|$)')
  UNION ALL SELECT ModelId, 48, MeasureName FROM m WHERE NOT IsHidden AND length(FormatString) = 0
  UNION ALL SELECT ModelId, 50, MeasureName FROM m WHERE contains(FormatString, '%') AND FormatString <> '#,0.0%;-#,0.0%;#,0.0%'
  UNION ALL SELECT ModelId, 51, MeasureName FROM m
      WHERE NOT contains(FormatString, '$') AND NOT contains(FormatString, '%') AND FormatString NOT IN ('#,0', '#,0.0'))
SELECT ModelId, RuleId, count(*) AS violations, count(DISTINCT MeasureName) AS objects FROM v GROUP BY 1, 2
""")
def q_measure_rule_violations(spark, sf):
    """Measure-text best-practice rules over a measure catalogue, counted per model and rule."""
    meta = {**_empty_meta(spark), "measures": SI.measures_from_lineitem(load(spark, sf, "lineitem"))}
    v = B.bpa(meta, MEASURE_RULES)
    return v.groupBy("ModelId", "RuleId").agg(F.count(F.lit(1)).alias("violations"),
                                              F.count_distinct("ObjectName").alias("objects"))


@register("measure_reference_rule_violations", "B9", sql=with_(SI.MEASURE_REFS_SQL) + """
, pairs AS (
  SELECT d.ModelId, d.TableName, d.ObjectName AS MeasureName, d.ReferencedObject AS rc, m.Expression AS e
  FROM (SELECT DISTINCT * FROM deps) d JOIN m ON m.ModelId = d.ModelId AND m.TableName = d.TableName AND m.MeasureName = d.ObjectName
  WHERE upper(d.ObjectType) = 'MEASURE' AND upper(d.ReferencedObjectType) = 'COLUMN'
    AND EXISTS (SELECT 1 FROM cols c WHERE c.ModelId = d.ModelId AND c.TableName = d.ReferencedTable AND c.ColumnName = d.ReferencedObject)),
occ AS (
  SELECT * FROM (SELECT ModelId, TableName, MeasureName, rc, e, unnest(range(1, length(e) + 1)) AS pos FROM pairs)
  WHERE substr(e, pos, length(rc) + 2) = '[' || rc || ']'),
bare AS (
  SELECT DISTINCT ModelId, TableName, MeasureName FROM occ o
  WHERE NOT EXISTS (SELECT 1 FROM cols c WHERE c.ModelId = o.ModelId AND c.ColumnName = o.rc
          AND ((o.pos > length(c.TableName) AND substr(o.e, o.pos - length(c.TableName), length(c.TableName)) = c.TableName)
            OR (o.pos > length(c.TableName) + 2
                AND substr(o.e, o.pos - length(c.TableName) - 2, length(c.TableName) + 2) = chr(39) || c.TableName || chr(39))))),
qual AS (
  SELECT DISTINCT d.ModelId, d.TableName, d.ObjectName AS MeasureName
  FROM deps d JOIN m ON m.ModelId = d.ModelId AND m.TableName = d.TableName AND m.MeasureName = d.ObjectName
  JOIN m t ON t.ModelId = d.ModelId AND t.MeasureName = d.ReferencedObject
  WHERE upper(d.ObjectType) = 'MEASURE' AND upper(d.ReferencedObjectType) = 'MEASURE'
    AND (contains(m.Expression, t.TableName || '[' || t.MeasureName || ']')
         OR contains(m.Expression, chr(39) || t.TableName || chr(39) || '[' || t.MeasureName || ']'))),
v AS (
  SELECT ModelId, 31 AS RuleId, MeasureName FROM m
    WHERE EXISTS (SELECT 1 FROM m m2 WHERE m2.ModelId = m.ModelId AND m.Expression = '[' || m2.MeasureName || ']')
  UNION ALL SELECT ModelId, 38, MeasureName FROM m
    WHERE EXISTS (SELECT 1 FROM bare b WHERE b.ModelId = m.ModelId AND b.TableName = m.TableName AND b.MeasureName = m.MeasureName)
  UNION ALL SELECT ModelId, 39, MeasureName FROM m
    WHERE EXISTS (SELECT 1 FROM qual q WHERE q.ModelId = m.ModelId AND q.TableName = m.TableName AND q.MeasureName = m.MeasureName)
  UNION ALL SELECT ModelId, 42, MeasureName FROM m
    WHERE IsHidden AND NOT EXISTS (SELECT 1 FROM deps d WHERE upper(d.ReferencedObjectType) = 'MEASURE'
                                     AND d.ModelId = m.ModelId AND d.ReferencedObject = m.MeasureName))
SELECT ModelId, RuleId, count(*) AS violations, count(DISTINCT MeasureName) AS objects FROM v GROUP BY 1, 2
""")
def q_measure_reference_rule_violations(spark, sf):
    """Measures against measures and dependencies (31, 42) and the reference
    form rules (38 bare column references, 39 table-qualified measure
    references), counted per model and rule."""
    meta = SI.measure_refs_from_tpch(load(spark, sf, "lineitem"), load(spark, sf, "part"))
    v = B.bpa(meta, [31, 38, 39, 42])
    return v.groupBy("ModelId", "RuleId").agg(F.count(F.lit(1)).alias("violations"),
                                              F.count_distinct("ObjectName").alias("objects"))


@register("relationship_rule_violations", "B3, B7", sql="""
WITH r AS (
  SELECT 'model-' || CAST(o_custkey % 20 AS VARCHAR) AS ModelId, o_orderpriority = '1-URGENT' AS m2m,
         o_orderstatus = 'F' AS bidi FROM orders),
v AS (
  SELECT ModelId, 3 AS RuleId FROM r WHERE m2m OR bidi
  UNION ALL SELECT ModelId, 6 FROM r WHERE m2m AND bidi
  UNION ALL SELECT ModelId, 17 FROM (
      SELECT ModelId, count(CASE WHEN bidi THEN 1 END) + count(CASE WHEN m2m THEN 1 END) AS bad, count(*) AS n FROM r GROUP BY 1)
    WHERE bad / greatest(n, 1) > 0.3)
SELECT ModelId, RuleId, count(*) AS violations FROM v GROUP BY 1, 2
""")
def q_relationship_rule_violations(spark, sf):
    """Relationship rules (bi-directional / many-to-many) and the model-level share rule."""
    meta = {**_empty_meta(spark), "relationships": SI.relationships_from_orders(load(spark, sf, "orders")),
            "models": spark.createDataFrame([], "ModelId string")}
    v = B.bpa(meta, [3, 6, 17])
    return v.groupBy("ModelId", "RuleId").agg(F.count(F.lit(1)).alias("violations"))


CATALOGUE_RULES = [4, 5, 8, 9, 10, 11, 12, 15, 18, 19, 20, 21, 23, 43, 44]


@register("model_catalogue_rule_violations", "B4, B5, B6, B7, B10", sql=with_(SI.CATALOGUE_SQL) + """
, v AS (
  SELECT ModelId, 4 AS RuleId, RoleName AS ObjectName FROM rs
    WHERE regexp_matches(FilterExpression, '(?i)(USERPRINCIPALNAME\\(\\)|USERNAME\\(\\))')
  UNION ALL SELECT ModelId, 21, RoleName FROM rs
    WHERE contains(lower(FilterExpression), 'right(') OR contains(lower(FilterExpression), 'left(')
       OR contains(lower(FilterExpression), 'filter(') OR contains(lower(FilterExpression), 'upper(')
       OR contains(lower(FilterExpression), 'lower(') OR contains(lower(FilterExpression), 'find(')
  UNION ALL SELECT DISTINCT t.ModelId, 5, t.TableName FROM tb t
    JOIN (SELECT ModelId, FromTable AS TableName FROM rl WHERE to_many UNION SELECT ModelId, ToTable FROM rl WHERE to_many) m
      ON t.ModelId = m.ModelId AND t.TableName = m.TableName
    WHERE EXISTS (SELECT 1 FROM rs WHERE rs.ModelId = t.ModelId AND rs.TableName = t.TableName)
  UNION ALL SELECT p.ModelId, 8, p.PartitionName FROM pt p JOIN hy ON p.ModelId = hy.ModelId AND p.TableName = hy.TableName
    WHERE p.Mode = 'DirectQuery' AND NOT p.has_cov
  UNION ALL SELECT ModelId, 9, ModelId FROM pt GROUP BY ModelId
    HAVING count(CASE WHEN Mode = 'DirectQuery' THEN 1 END) = 0 AND count(CASE WHEN Mode = 'Dual' THEN 1 END) > 0
  UNION ALL SELECT t.ModelId, 10, t.TableName FROM tb t
    JOIN (SELECT ModelId, TableName, count(*) AS n, count(CASE WHEN Mode = 'Import' THEN 1 END) AS imp FROM pt GROUP BY 1, 2) pc
      ON t.ModelId = pc.ModelId AND t.TableName = pc.TableName
    JOIN fl ON t.ModelId = fl.ModelId AND t.TableName = fl.TableName
    WHERE pc.n = 1 AND pc.imp = 1 AND fl.t1 = 1 AND t.ModelId IN (SELECT ModelId FROM hy)
  UNION ALL SELECT ModelId, 11, PartitionName FROM pt WHERE heavy
  UNION ALL SELECT t.ModelId, 12, t.TableName FROM tb t JOIN fl ON t.ModelId = fl.ModelId AND t.TableName = fl.TableName
    WHERE NOT t.IsCalculationGroup AND fl.f = 1 AND fl.t = 1
  UNION ALL SELECT ModelId, 15, TableName FROM tb WHERE NOT IsFieldParameter AND IsCalculated
  UNION ALL SELECT ModelId, 18, TableName FROM tb
    WHERE IsCalculated AND (starts_with(TableName, 'DateTableTemplate_') OR starts_with(TableName, 'LocalDateTable_'))
  UNION ALL SELECT ModelId, 19, TableName FROM tb WHERE regexp_matches(TableName, '(?i)(date|calendar)') AND NOT is_time
  UNION ALL SELECT t.ModelId, 20, t.TableName FROM tb t
    JOIN (SELECT ModelId, TableName, count(*) AS n FROM pt GROUP BY 1, 2) pc ON t.ModelId = pc.ModelId AND t.TableName = pc.TableName
    WHERE pc.n = 1 AND t.RowCount > 25000000
  UNION ALL SELECT ModelId, 23, ItemName FROM ci WHERE length(Expression) = 0
  UNION ALL SELECT t.ModelId, 43, t.TableName FROM tb t LEFT JOIN fl ON t.ModelId = fl.ModelId AND t.TableName = fl.TableName
    WHERE coalesce(fl.f, 0) + coalesce(fl.t, 0) = 0 AND NOT t.IsCalculationGroup
  UNION ALL SELECT t.ModelId, 44, t.TableName FROM tb t
    WHERE t.IsCalculationGroup AND NOT EXISTS (SELECT 1 FROM ci WHERE ci.ModelId = t.ModelId AND ci.TableName = t.TableName))
SELECT ModelId, RuleId, count(*) AS violations, count(DISTINCT ObjectName) AS objects FROM v GROUP BY 1, 2
""")
def q_model_catalogue_rule_violations(spark, sf):
    """Table, partition, row-level-security, model and calculation-item rules over a model catalogue."""
    meta = SI.model_catalogue_from_parts(load(spark, sf, "part"), load(spark, sf, "lineitem"), load(spark, sf, "customer"))
    e = lambda schema: spark.createDataFrame([], schema)
    meta.update({"measures": e("ModelId string, TableName string, MeasureName string, Expression string"),
                 "columns": e("ModelId string, TableName string, ColumnName string, DataType string, IsKey boolean"),
                 "hierarchies": e("ModelId string, TableName string, HierarchyName string, ColumnName string")})
    v = B.bpa(meta, CATALOGUE_RULES)
    return v.groupBy("ModelId", "RuleId").agg(F.count(F.lit(1)).alias("violations"),
                                              F.count_distinct("ObjectName").alias("objects"))


@register("part_column_labels", "P28, P29, P30, P31", sql="""
SELECT p_partkey,
  CASE WHEN p_size % 3 = 0 THEN 'Hidden' ELSE 'Visible' END AS hidden_label,
  CASE WHEN p_size % 5 = 0 THEN 'Key' ELSE 'Not Key' END AS key_label,
  coalesce(nullif(CASE WHEN p_size % 2 = 0 THEN p_name ELSE '' END, ''), p_type) AS ColumnName,
  coalesce(CASE WHEN p_size % 4 = 0 THEN p_brand END,
           CASE WHEN contains(p_name, 'ring') THEN 'ePBIDTS' ELSE '0' END) AS SourceOrDefault,
  CASE WHEN (CASE p_size % 3 WHEN 0 THEN 'Default' WHEN 1 THEN 'Hash' ELSE 'Value' END) = 'Default' THEN NULL
       WHEN (CASE p_size % 3 WHEN 0 THEN 'Default' WHEN 1 THEN 'Hash' ELSE 'Value' END)
            = (CASE WHEN p_partkey % 2 = 0 THEN 'Hash' ELSE 'Value' END) THEN 'Accepted' ELSE 'Not Accepted' END AS EncodingVerdict
FROM part
""")
def q_part_column_labels(spark, sf):
    """Flag labels, explicit-else-inferred names, null replacement and encoding-hint verdicts over a column catalogue."""
    p = load(spark, sf, "part")
    sz = F.col("p_size")
    cols = p.select("p_partkey", "p_name", "p_type", (sz % 3 == 0).alias("IsHidden"), (sz % 5 == 0).alias("IsKey"),
                    F.when(sz % 2 == 0, F.col("p_name")).otherwise(F.lit("")).alias("ExplicitName"),
                    F.col("p_type").alias("InferredName"), F.when(sz % 4 == 0, F.col("p_brand")).alias("SourceColumn"),
                    F.when(sz % 3 == 0, "Default").when(sz % 3 == 1, "Hash").otherwise("Value").alias("EncodingHint"),
                    F.when(F.col("p_partkey") % 2 == 0, "Hash").otherwise("Value").alias("Encoding"))
    labels = P.label_flags({"hidden_label": ("IsHidden", "Hidden", "Visible"), "key_label": ("IsKey", "Key", "Not Key")})
    return cols.select("p_partkey", *[c.alias(n) for n, c in labels.items()],
                       P.coalesce_name("ExplicitName", "InferredName").alias("ColumnName"),
                       P.replace_null("SourceColumn", F.when(F.col("p_name").contains("ring"), F.lit("ePBIDTS"))
                                      .otherwise(F.lit("0"))).alias("SourceOrDefault"),
                       P.encoding_verdict("EncodingHint", "Encoding").alias("EncodingVerdict"))


@register("calc_dependencies", "T23", sql="""
WITH t AS (SELECT DISTINCT CAST(p_partkey % 5 AS BIGINT) AS ID, 'Sales' || CAST(p_partkey % 5 AS VARCHAR) AS Name FROM part),
ot AS (SELECT * FROM (VALUES ('MEASURE', 'Measure'), ('COLUMN', 'Column'), ('CALC_COLUMN', 'Calculated Column')) v(Enum, Name)),
d AS (SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'MEASURE' ELSE 'CALC_COLUMN' END AS OBJECT_TYPE,
             'Sales' || CAST(l_partkey % 5 AS VARCHAR) AS "TABLE", 'M' || CAST(l_orderkey AS VARCHAR) AS OBJECT,
             CASE WHEN l_linenumber % 3 = 0 THEN 'MEASURE' ELSE 'COLUMN' END AS REFERENCED_OBJECT_TYPE,
             'Sales' || CAST(l_suppkey % 7 AS VARCHAR) AS REFERENCED_TABLE,
             'C' || CAST(l_linenumber AS VARCHAR) AS REFERENCED_OBJECT FROM lineitem)
SELECT d.*, t1.ID AS TableID, t2.ID AS ReferencedTableID, o1.Name AS ObjectTypeName, o2.Name AS ReferencedObjectTypeName,
       d."TABLE" || '-' || d.OBJECT AS DependencyKey
FROM d LEFT JOIN t t1 ON d."TABLE" = t1.Name LEFT JOIN t t2 ON d.REFERENCED_TABLE = t2.Name
LEFT JOIN ot o1 ON d.OBJECT_TYPE = o1.Enum LEFT JOIN ot o2 ON d.REFERENCED_OBJECT_TYPE = o2.Enum
""")
def q_calc_dependencies(spark, sf):
    """Calculation dependencies with table ids and object-type names of both ends."""
    li = load(spark, sf, "lineitem")
    deps = li.select(F.when(F.col("l_linenumber") % 2 == 0, "MEASURE").otherwise("CALC_COLUMN").alias("OBJECT_TYPE"),
                     SI._cat("Sales", F.col("l_partkey") % 5).alias("TABLE"), SI._cat("M", F.col("l_orderkey")).alias("OBJECT"),
                     F.when(F.col("l_linenumber") % 3 == 0, "MEASURE").otherwise("COLUMN").alias("REFERENCED_OBJECT_TYPE"),
                     SI._cat("Sales", F.col("l_suppkey") % 7).alias("REFERENCED_TABLE"),
                     SI._cat("C", F.col("l_linenumber")).alias("REFERENCED_OBJECT"))
    tabs = load(spark, sf, "part").select((F.col("p_partkey") % 5).cast("long").alias("ID"),
                                          SI._cat("Sales", F.col("p_partkey") % 5).alias("Name")).distinct()
    # Dependency object types.
    ot = spark.createDataFrame([("MEASURE", "Measure"), ("COLUMN", "Column"), ("CALC_COLUMN", "Calculated Column")],
                               "Enum string, Name string")
    return T.build_calc_dependencies(deps, tabs, ot)


@register("query_folders", "T25", sql="""
SELECT '-1' AS ID, CAST(NULL AS VARCHAR) AS ModelID, '(No folder)' AS Folder, CAST(NULL AS VARCHAR) AS Description
UNION ALL SELECT DISTINCT CAST(p_size % 10 AS VARCHAR), '1', 'Folder ' || CAST(p_size % 10 AS VARCHAR), 'Size ' || CAST(p_size % 10 AS VARCHAR) FROM part
""")
def q_query_folders(spark, sf):
    """Folder list: the default folder plus the query groups."""
    groups = load(spark, sf, "part").select((F.col("p_size") % 10).cast("long").alias("ID"), F.lit(1).alias("ModelID"),
                                            SI._cat("Folder ", F.col("p_size") % 10).alias("Folder"),
                                            SI._cat("Size ", F.col("p_size") % 10).alias("Description")).distinct()
    return T.build_folder_list(groups)


@register("model_health", "A28", sql="""
WITH c AS (SELECT 'model-' || CAST(l_suppkey % 20 AS VARCHAR) AS model,
                  count(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 1 END)
                  + count(CASE WHEN l_linestatus <> 'F' THEN 1 END) AS bad FROM lineitem GROUP BY 1),
p AS (SELECT 'model-' || CAST(o_custkey % 20 AS VARCHAR) AS model, count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS bad
      FROM orders GROUP BY 1),
m AS (SELECT model FROM c UNION SELECT model FROM p)
SELECT m.model, coalesce(c.bad, 0) = 0 AS columns_healthy, coalesce(p.bad, 0) = 0 AS partitions_healthy,
       coalesce(c.bad, 0) = 0 AND coalesce(p.bad, 0) = 0 AS model_healthy
FROM m LEFT JOIN c USING (model) LEFT JOIN p USING (model)
""")
def q_model_health(spark, sf):
    """Model health: errors + not-Ready objects per kind, model healthy when every kind is."""
    li = load(spark, sf, "lineitem").select(
        SI._cat("model-", F.col("l_suppkey") % 20).alias("model"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), F.lit("err")).alias("ErrorMessage"),
        F.when(F.col("l_linestatus") == "F", F.lit("Ready")).otherwise(F.lit("Processing")).alias("State"))
    o = load(spark, sf, "orders").select(
        SI._cat("model-", F.col("o_custkey") % 20).alias("model"), F.lit(None).cast("string").alias("ErrorMessage"),
        F.when(F.col("o_orderstatus") == "P", F.lit("NoData")).otherwise(F.lit("Ready")).alias("State"))
    return A.health_flags({"columns": li, "partitions": o}, "model")


# =========================================================================== sources
from ..sources import envelope as ENV  # noqa: E402
from ..sources import logs as LOGS  # noqa: E402
from ..sources import sinks as SINK  # noqa: E402
from ..session import ensure_checkpoint_dir  # noqa: E402

# The column definitions enforced on the orders table.
ORDER_COLUMN_DEFS = [("orders", "o_clerk", "string"), ("orders", "o_comment", "string"),
                     ("orders", "o_totalprice", "double"), ("orders", "o_audit", "struct<by:string>"),
                     ("customer", "c_phone", "string")]


@register("orders_enforced_schema", "S7", sql="""
SELECT *, CAST(NULL AS VARCHAR) AS o_clerk, CAST(NULL AS VARCHAR) AS o_comment FROM orders
""")
def q_orders_enforced_schema(spark, sf):
    """Columns declared for the table but absent are added as typed nulls (struct types skipped)."""
    defs = spark.createDataFrame(ORDER_COLUMN_DEFS, "Table_Name string, Column_Name string, Data_Type string")
    return SINK.ensure_columns(load(spark, sf, "orders"), defs, "orders")


def _scratch(spark, tag: str) -> str:
    """A fresh folder under the reliable checkpoint folder (shared on a cluster)."""
    import uuid
    return f"{ensure_checkpoint_dir(spark, LOCAL_CHECKPOINTS).rstrip('/')}/govlake-{tag}-{uuid.uuid4().hex}"


@register("activity_feed_roundtrip", "S1, T1, T26", sql=REGISTRY["activity_agg_30d"].sql)
def q_activity_feed_roundtrip(spark, sf):
    """Activities written as JSON-lines envelopes to the shared folder, read back
    through the envelope scan, then the 30-day aggregate."""
    acts = activities_from_events(load(spark, sf, "events"))
    path = _scratch(spark, "activity-feed")
    acts.select(F.array(F.struct(*acts.columns)).alias("activityEventEntities")).write.json(path)
    records = ENV.read_envelope(spark, path, ["activityEventEntities"], multiline=False)
    return build_aggregated_activities(build_activities(records), TODAY, 30)


@register("settings_feed_fallback", "S2, M7, T6", sql=REGISTRY["tenant_setting_groups"].sql)
def q_settings_feed_fallback(spark, sf):
    """Tenant settings delivered under the fallback array field ('value'),
    read with ['tenantSettings', 'value'], stamped, then their security groups."""
    st = SI.tenant_settings_from_customers(load(spark, sf, "customer")).drop("TransferDateTime")
    path = _scratch(spark, "settings-feed")
    st.select(F.array(F.struct(*st.columns)).alias("value")).write.json(path)
    records = ENV.read_envelope(spark, path, ["tenantSettings", "value"], multiline=False)
    return T.build_enabled_security_groups(M.append_stamped(None, records, "2024-01-30 06:00:00"))


@register("orders_latest_snapshot", "S3, S6", sql="""
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
""")
def q_orders_latest_snapshot(spark, sf):
    """Two dated parquet snapshots (the newer one with an added column); the
    newest leaf of the date tree is read."""
    o = load(spark, sf, "orders")
    base = _scratch(spark, "order-snapshots")
    SINK.write_table(o.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
                     .select("o_orderkey", "o_orderstatus", "o_totalprice"), f"{base}/2024/01/29", "overwrite")
    SINK.write_table(o.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"),
                     f"{base}/2024/01/30", "overwrite")
    return ENV.read_latest(spark, base, fmt="parquet")


@register("orders_evolving_table", "S6", sql="""
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN o_orderpriority END AS o_orderpriority
FROM orders
""")
def q_orders_evolving_table(spark, sf):
    """Appends with additive schema evolution: old rows lack the new column."""
    o = load(spark, sf, "orders")
    path = _scratch(spark, "orders-table")
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    SINK.write_table(o.filter(F.col("o_orderdate") < cut).select("o_orderkey", "o_orderstatus"), path, "append")
    SINK.write_table(o.filter(F.col("o_orderdate") >= cut).select("o_orderkey", "o_orderstatus", "o_orderpriority"),
                     path, "append")
    return SINK.read_table(spark, path).select("o_orderkey", "o_orderstatus", "o_orderpriority")


def _rename_parts(spark, folder: str, prefix: str, ext: str = ".log") -> None:
    """Give the part files of a written folder report-style names (a metadata
    operation on the file system, as log shipping produces them)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for i, st in enumerate(sorted(fs.listStatus(p), key=lambda x: x.getPath().getName())):
        name = st.getPath().getName()
        if name.startswith("part-"):
            fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(folder, f"{prefix}_{i}{ext}"))


@register("gateway_logs_from_files", "S4", sql="""
SELECT 'r' || CAST(l_orderkey AS VARCHAR) AS RequestId, 't' || CAST(l_linenumber AS VARCHAR) AS QueryTrackingId,
       CASE WHEN l_returnflag = 'R' THEN 'N' ELSE 'Y' END AS Success, l_linenumber % 2 = 0 AS HasDataSource
FROM lineitem
""")
def q_gateway_logs_from_files(spark, sf):
    """Report logs written as CSV files whose headers differ (one set lacks
    DataSource, another report's files sit alongside), read by name per file."""
    logs = SI.query_execution_logs_from_lineitem(load(spark, sf, "lineitem"))
    base = _scratch(spark, "gateway-logs")
    opts = dict(header=True, quote='"', escape='"')
    even = F.col("QueryTrackingId").substr(2, 5).cast("int") % 2 == 0
    logs.filter(even).select("RequestId", "DataSource", "QueryTrackingId", "Success").write.options(**opts).csv(f"{base}/a")
    logs.filter(~even).select("Success", "RequestId", "QueryTrackingId").write.options(**opts).csv(f"{base}/b")
    # files of another report in the same folder: must be skipped by name
    load(spark, sf, "nation").select(F.col("n_name").alias("RequestId")).write.options(**opts).csv(f"{base}/c")
    _rename_parts(spark, f"{base}/a", "QueryExecutionReport_a")
    _rename_parts(spark, f"{base}/b", "QueryExecutionReport_b")
    _rename_parts(spark, f"{base}/c", "MashupEvaluationReport_c")
    rows_ = LOGS.read_report_logs(spark, base, "QueryExecutionReport", ["RequestId", "QueryTrackingId", "Success", "DataSource"])
    return rows_.select("RequestId", "QueryTrackingId", "Success", F.col("DataSource").isNotNull().alias("HasDataSource"))


@register("model_column_structure_rules", "B2", sql=with_(SI.CATALOGUE_SQL, SI.COLUMNS_CATALOGUE_SQL) + """
, tcat AS (SELECT ModelId, TableName, bool_or(is_time) AS is_time FROM tb GROUP BY 1, 2),
c AS (SELECT cols.*, cols.IsHidden AS ColHidden, coalesce(tc.is_time, false) AS is_time
      FROM cols LEFT JOIN tcat tc ON cols.ModelId = tc.ModelId AND cols.TableName = tc.TableName),
v AS (
  SELECT c.ModelId, 7 AS RuleId, c.TableName || '.' || c.ColumnName AS ObjectName FROM c
    WHERE c.IsAvailableInMDX AND c.ColHidden AND coalesce(c.SortByColumn, '') = ''
      AND NOT EXISTS (SELECT 1 FROM sortused s WHERE s.ModelId = c.ModelId AND s.TableName = c.TableName AND s.ColumnName = c.ColumnName)
      AND NOT EXISTS (SELECT 1 FROM hier h WHERE h.ModelId = c.ModelId AND h.TableName = c.TableName AND h.ColumnName = c.ColumnName)
  UNION ALL SELECT c.ModelId, 26, c.TableName || '.' || c.ColumnName FROM c
    WHERE NOT c.IsAvailableInMDX AND (
      EXISTS (SELECT 1 FROM sortused s WHERE s.ModelId = c.ModelId AND s.TableName = c.TableName AND s.ColumnName = c.ColumnName)
      OR EXISTS (SELECT 1 FROM hier h WHERE h.ModelId = c.ModelId AND h.TableName = c.TableName AND h.ColumnName = c.ColumnName)
      OR length(coalesce(c.SortByColumn, '')) > 0)
  UNION ALL SELECT c.ModelId, 41, c.TableName || '.' || c.ColumnName FROM c
    WHERE c.ColHidden
      AND NOT EXISTS (SELECT 1 FROM relcols r WHERE r.ModelId = c.ModelId AND r.TableName = c.TableName AND r.ColumnName = c.ColumnName)
      AND NOT EXISTS (SELECT 1 FROM hier h WHERE h.ModelId = c.ModelId AND h.TableName = c.TableName AND h.ColumnName = c.ColumnName)
      AND NOT EXISTS (SELECT 1 FROM sortused s WHERE s.ModelId = c.ModelId AND s.TableName = c.TableName AND s.ColumnName = c.ColumnName)
      AND EXISTS (SELECT 1 FROM deps d WHERE d.ModelId = c.ModelId AND d.TableName = c.TableName AND d.ColumnName = c.ColumnName)
  UNION ALL SELECT c.ModelId, 52, c.TableName || '.' || c.ColumnName FROM c
    WHERE NOT c.IsHidden AND EXISTS (SELECT 1 FROM relcols r WHERE r.ModelId = c.ModelId AND r.TableName = c.TableName
                                      AND r.ColumnName = c.ColumnName AND r.e = 'From' AND r.card = 'Many')
  UNION ALL SELECT c.ModelId, 53, c.TableName || '.' || c.ColumnName FROM c
    WHERE NOT c.IsKey AND NOT c.is_time AND EXISTS (SELECT 1 FROM relcols r WHERE r.ModelId = c.ModelId AND r.TableName = c.TableName
                                      AND r.ColumnName = c.ColumnName AND r.e = 'To' AND r.card = 'One'))
SELECT ModelId, RuleId, count(*) AS violations, count(DISTINCT ObjectName) AS objects FROM v GROUP BY 1, 2
""")
def q_model_column_structure_rules(spark, sf):
    """Column rules that consult relationships, hierarchies, sort-by columns and dependencies."""
    p, li = load(spark, sf, "part"), load(spark, sf, "lineitem")
    meta = SI.model_catalogue_from_parts(p, li, load(spark, sf, "customer"))
    meta.update(SI.model_columns_catalogue(p, li))
    meta["tables"] = meta["tables"].select("ModelId", "TableName", F.lit(False).alias("IsHidden"),
                                           F.when(F.col("DataCategory") == "Time", "Time").otherwise("").alias("DataCategory"))
    meta["tables"] = meta["tables"].groupBy("ModelId", "TableName").agg(
        F.lit(False).alias("IsHidden"), F.max("DataCategory").alias("DataCategory"))
    v = B.bpa(meta, [7, 26, 41, 52, 53])
    v = v.withColumn("ObjectName", F.concat_ws(".", "TableName", "ObjectName"))
    return v.groupBy("ModelId", "RuleId").agg(F.count(F.lit(1)).alias("violations"),
                                              F.count_distinct("ObjectName").alias("objects"))


# --------------------------------------------------------------------------- all relation kinds of the scan
def _rel_scan(customer: DataFrame) -> DataFrame:
    """One workspace a customer, with items and relations of every kind."""
    k = F.col("c_custkey")
    t = lambda p, n=k: SI._cat(p, n)
    rel = lambda a, w: F.struct(a.alias("dependentOnArtifactId"), w.alias("workspaceId"))
    none = lambda kind: F.lit(None).cast(f"array<struct<{kind}>>")
    usage = F.array(F.struct(t("ds-", k % 6).alias("datasourceInstanceId")))
    lakes = F.array(F.struct(t("lh-").alias("id"), F.lit("Sales").alias("name"), F.array(rel(t("src-", k % 7), t("ws-", k % 5))).alias("relations")),
                    F.struct(t("st-").alias("id"), F.when(k % 4 == 0, t("StagingLakehouseForDataflows_")).otherwise("DataflowsStagingLakehouse").alias("name"),
                             none("dependentOnArtifactId:string,workspaceId:string").alias("relations")))
    return customer.select(F.array(F.struct(
        t("ws-").alias("id"),
        F.array(F.struct(t("sql-").alias("id"), F.array(rel(t("lh-"), t("ws-"))).alias("relations"))).alias("SQLAnalyticsEndpoint"),
        lakes.alias("Lakehouse"),
        F.array(F.struct(t("nb-").alias("id"), F.array(rel(t("lh-"), t("ws-")), rel(t("lh-", k % 3), t("ws-", k % 3))).alias("relations"))).alias("Notebook"),
        F.array(F.struct(
            t("sm-").alias("id"),
            F.when(k % 3 != 0, F.array(F.struct(t("sm-", k % 10).alias("targetDatasetId"), t("ws-", k % 10).alias("groupId")))).alias("upstreamDatasets"),
            F.array(rel(t("lh-"), t("ws-"))).alias("relations"),
            F.array(F.struct(t("df-").alias("targetDataflowId"), t("ws-").alias("groupId"))).alias("upstreamDataflows"),
            usage.alias("datasourceUsages"))).alias("datasets"),
        F.array(F.struct(t("df-").alias("objectid"), F.when(k % 2 == 0, usage).alias("datasourceUsages"),
                         F.array(rel(t("lh-"), t("ws-"))).alias("relations"))).alias("dataflows"),
        F.array(F.struct(t("dp-").alias("id"), F.array(rel(t("nb-"), t("ws-"))).alias("relations"))).alias("DataPipeline"))).alias("workspaces"))


_REL_KINDS = (  # (down id, down workspace, down type, up id, up workspace, up type, label, condition)
    ("'SQL-' || k", "'WS-' || k", "SQLAnalyticsEndpoint", "'LH-' || k", "'WS-' || k", "Relation", "sql_to_rel", ""),
    ("'LH-' || k", "'WS-' || k", "Lakehouse", "'SRC-' || k % 7", "'WS-' || k % 5", "Relation", "lh_to_rel", ""),
    ("'NB-' || k", "'WS-' || k", "Notebook", "'LH-' || k", "'WS-' || k", "Relation", "nb_to_rel", ""),
    ("'NB-' || k", "'WS-' || k", "Notebook", "'LH-' || k % 3", "'WS-' || k % 3", "Relation", "nb_to_rel", ""),
    ("'SM-' || k", "'WS-' || k", "SemanticModel", "'SM-' || k % 10", "'WS-' || k % 10", "SemanticModel", "sm_to_sm", "k % 3 <> 0"),
    ("'SM-' || k", "'WS-' || k", "SemanticModel", "'LH-' || k", "'WS-' || k", "Relation", "sm_to_sm", ""),
    ("'SM-' || k", "'WS-' || k", "SemanticModel", "'DF-' || k", "'WS-' || k", "Dataflow", "sm_to_df", ""),
    ("'SM-' || k", "'WS-' || k", "SemanticModel", "'DS-' || k % 6", "'DATASOURCE'", "DataSource", "sm_to_source", ""),
    ("'DF-' || k", "'WS-' || k", "Dataflow", "CASE WHEN k % 2 = 0 THEN 'DS-' || k % 6 END", "NULL", "DataSource", "source_to_df", ""),
    ("'LH-' || k", "'WS-' || k", "Destination", "'DF-' || k", "'WS-' || k", "Dataflow", "df_to_dest", ""),
    ("'DP-' || k", "'WS-' || k", "DataPipeline", "NULL", "NULL", "DataSource", "source_to_dp", ""),
    ("'DP-' || k", "'WS-' || k", "DataPipeline", "'NB-' || k", "'WS-' || k", None, "dp_to_rel", ""),
    ("'LH-' || k", "'WS-' || k", "Lakehouse", "'ST-' || k", "'WS-' || k", "Lakehouse", "lh_to_lh", "k % 4 = 0"),
    ("'R-' || k", "'WS-' || k", "Report", "'SM-' || k % 50", "'WS-' || k % 50", "SemanticModel", "r_to_sm", "k % 2 = 0"),
    ("'R-' || k", "'WS-' || k", "ReportApp", "'R-' || (k - 1)", "'WS-' || k", "Report", "app_to_r", "k % 2 = 1"),
)
_REL_SQL = "\nUNION ALL\n".join(
    f"SELECT {d} AS DownStreamId, {dw} AS DownStreamWorkspaceId, '{dt}' AS DownStreamType, {u} AS UpStreamId, CAST({uw} AS VARCHAR) AS UpStreamWorkspaceId, "
    f"CAST({'NULL' if ut is None else repr(ut)} AS VARCHAR) AS UpStreamType, '{label}' AS SourceDF FROM c" + (f" WHERE {cond}" if cond else "")
    for d, dw, dt, u, uw, ut, label, cond in _REL_KINDS)


@register("scan_lineage_edges", "G1, J2, J3, U1", sql="WITH c AS (SELECT c_custkey AS k FROM customer)\n" + _REL_SQL)
def q_scan_lineage_edges(spark, sf):
    """Edges of all relation kinds of the scan and of the reports, in one pass over the workspaces."""
    c = load(spark, sf, "customer")
    k = F.col("c_custkey")
    t = lambda p, n=k: SI._cat(p, n)
    reports = c.select(t("r-").alias("ReportId"), t("ws-").alias("WorkspaceId"), F.lit("PowerBIReport").alias("ReportType"),
                       F.when(k % 2 == 1, t("app-")).alias("AppId"), t("sm-", k % 50).alias("SemanticModelId"), t("r-", k - 1).alias("OriginalReportObjectId"))
    return G.lineage_edges(_rel_scan(c), reports, c.select(t("sm-").alias("SemanticModelId"), t("ws-").alias("WorkspaceId")))


# --------------------------------------------------------------------------- capacities, Git connections, 14 d / 30 d trends
@register("capacity_table", "S1, P4", sql="""
SELECT upper('cap-' || CAST(s_suppkey AS VARCHAR)) AS CapacityId, s_name AS displayName, 'F' || CAST(s_nationkey AS VARCHAR) AS sku FROM supplier
""")
def q_capacity_table(spark, sf):
    """Capacities with their upper-case id."""
    return T.build_capacities(load(spark, sf, "supplier").select(
        SI._cat("cap-", F.col("s_suppkey")).alias("id"), F.col("s_name").alias("displayName"), SI._cat("F", F.col("s_nationkey")).alias("sku")))


@register("git_connections", "S1, P4", sql="""
SELECT upper('ws-' || CAST(s_suppkey AS VARCHAR)) AS workspaceId, 'repo' || CAST(s_nationkey AS VARCHAR) AS repositoryName,
       CASE WHEN s_suppkey % 2 = 0 THEN 'GitHub' ELSE 'AzureDevOps' END AS gitProviderType FROM supplier
""")
def q_git_connections(spark, sf):
    """Git connections of the workspaces, provider details promoted to columns."""
    return T.build_git_connections(load(spark, sf, "supplier").select(
        SI._cat("ws-", F.col("s_suppkey")).alias("workspaceId"),
        F.struct(SI._cat("repo", F.col("s_nationkey")).alias("repositoryName"),
                 F.when(F.col("s_suppkey") % 2 == 0, "GitHub").otherwise("AzureDevOps").alias("gitProviderType")).alias("gitProviderDetails")))


@register("supplier_trend_14d_30d", "A17", sql=f"""
WITH d AS (SELECT l_returnflag, l_suppkey, CAST(l_shipdate AS DATE) AS Date, {rnd_sql(f'sum({REV})', 4)} AS v FROM lineitem GROUP BY 1, 2, 3),
a AS (SELECT l_returnflag,
  {rnd_sql(f"sum(v) FILTER (Date >= DATE '{SHIP_TODAY}' - INTERVAL 14 DAY AND Date <= DATE '{SHIP_TODAY}')", 4)}
    / count(v) FILTER (Date >= DATE '{SHIP_TODAY}' - INTERVAL 14 DAY AND Date <= DATE '{SHIP_TODAY}') AS last_14d,
  {rnd_sql(f"sum(v) FILTER (Date >= DATE '{SHIP_TODAY}' - INTERVAL 30 DAY AND Date <= DATE '{SHIP_TODAY}')", 4)}
    / count(v) FILTER (Date >= DATE '{SHIP_TODAY}' - INTERVAL 30 DAY AND Date <= DATE '{SHIP_TODAY}') AS last_30d FROM d GROUP BY 1)
SELECT *, CASE WHEN last_30d <> 0 THEN (last_14d - last_30d) / last_30d END AS trend FROM a
""")
def q_supplier_trend(spark, sf):
    """Average of the suppliers' days over 14 against 30 days, per return flag."""
    return A.window_trend(load(spark, sf, "lineitem"), "l_suppkey", "l_shipdate", SHIP_TODAY, _rev(), by=["l_returnflag"], decimals=4)


@register("activity_trend_14d_30d", "A17", sql=with_(ACTIVITIES_SQL, ACT_SILVER_SQL) + f"""
, a AS (SELECT Activity, count(*) FILTER (CreationDate >= DATE '{TODAY}' - INTERVAL 14 DAY AND CreationDate <= DATE '{TODAY}') AS last_14d,
  count(*) FILTER (CreationDate >= DATE '{TODAY}' - INTERVAL 30 DAY AND CreationDate <= DATE '{TODAY}') AS last_30d FROM silver GROUP BY 1)
SELECT *, CASE WHEN last_30d <> 0 THEN CAST(last_14d - last_30d AS DOUBLE) / last_30d END AS trend FROM a
""")
def q_activity_trend(spark, sf):
    """Activities of the last 14 against the last 30 days, per activity."""
    return A.window_trend(_activities(spark, sf), None, "CreationDate", TODAY, by=["Activity"])

"""Registered queries over kept state: versioned tables and lineage brought up to date."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..operators import context as CX
from ..operators import daily as DY
from ..operators import drill as DR
from ..operators import inventory as INV
from ..operators import lineage as G
from ..operators import versions as V
from ..session import discard, materialize
from ..sources import dims as DIM
from ..sources import logs as LOGS
from .catalog import (ACT_SILVER_SQL, EDGES_SQL, LOCAL_CHECKPOINTS, MERGE_NOW, PATHS_SQL, _activities, _lineage_inputs, _rename_parts, _scratch)
from ..operators.tables import INVENTORY_TABLES, ITEM_USER_TYPES, _spec
from .registry import register, with_
from ..operators import tables as T
from . import standins as SI
from .standins import ACTIVITIES_SQL, TODAY, load

# --------------------------------------------------------------------------- M1 by day
RELOAD_SQL = """
a AS (SELECT Id, CASE WHEN CAST(Id AS BIGINT) % 11 = 0 THEN NULL ELSE CreationDate END AS CreationDate, value FROM silver),
ex AS (SELECT * FROM a WHERE CreationDate < DATE '2024-01-20' OR CreationDate IS NULL),
one AS (SELECT Id, CreationDate, value + 1 AS value FROM a WHERE CreationDate >= DATE '2024-01-15' AND CreationDate < DATE '2024-01-28'),
t1 AS (SELECT * FROM ex WHERE CreationDate IS NULL OR CreationDate < DATE '2024-01-15' UNION ALL SELECT * FROM one),
two AS (SELECT Id, CreationDate, value + 2 AS value FROM a WHERE CreationDate >= DATE '2024-01-25'),
cut AS (SELECT least((SELECT min(CreationDate) FROM two), (SELECT max(CreationDate) FROM t1)) AS c)"""


def _reloaded(spark, sf) -> V.Versions:
    a = _activities(spark, sf).select("Id", F.when(F.col("Id").cast("long") % 11 != 0, F.col("CreationDate")).alias("CreationDate"), "value")
    day = lambda d: F.lit(d).cast("date")
    table = V.Versions(spark, _scratch(spark, "activity-days"), "CreationDate")
    table.commit(a.where((F.col("CreationDate") < day("2024-01-20")) | F.col("CreationDate").isNull()))
    V.replace_since(table, a.where("CreationDate IS NULL"))  # a feed without dates changes nothing
    for first, last, more in (("2024-01-15", "2024-01-28", 1), ("2024-01-25", "9999-01-01", 2)):
        feed = a.where(((F.col("CreationDate") >= day(first)) & (F.col("CreationDate") < day(last))) | F.col("CreationDate").isNull())
        V.replace_since(table, feed.withColumn("value", F.col("value") + more))
    return table


@register("activity_reload_by_day", "M1", sql=with_(ACTIVITIES_SQL, ACT_SILVER_SQL, RELOAD_SQL) + """
SELECT * FROM t1 WHERE CreationDate IS NULL OR CreationDate < (SELECT c FROM cut)
UNION ALL SELECT * FROM two WHERE CreationDate >= (SELECT c FROM cut)
""")
def q_activity_reload_by_day(spark, sf):
    """High-water-mark reloads of a table by day: rows without a date stay, an empty feed changes nothing."""
    return _reloaded(spark, sf).read()


@register("activity_reload_touched_days", "M1", sql=with_(ACTIVITIES_SQL, ACT_SILVER_SQL, RELOAD_SQL) + """
SELECT DISTINCT CAST(CreationDate AS VARCHAR) AS day FROM (SELECT CreationDate FROM t1 UNION ALL SELECT CreationDate FROM two)
WHERE CreationDate >= (SELECT c FROM cut)
""")
def q_activity_reload_touched_days(spark, sf):
    """The days that the last reload wrote or removed; all other days' folders are those of the version before."""
    table = _reloaded(spark, sf)
    days = [(table.value(p),) for p in sorted(table.changed(table.state()["version"]))]
    return spark.createDataFrame(days, "day string")


# --------------------------------------------------------------------------- M8, P26, M7 by day
@register("customer_history_by_day", "M8", sql="""
WITH c AS (SELECT c_custkey, c_nationkey, c_acctbal FROM customer),
h AS (SELECT CAST(NULL AS DATE) AS Snapshot_Date, CAST(NULL AS VARCHAR) AS Snapshot_c_custkey, c.* FROM c WHERE c_custkey % 5 = 0
      UNION ALL SELECT DATE '2024-01-29', '2024-01-29_' || CAST(c_custkey AS VARCHAR), c.* FROM c
      UNION ALL SELECT DATE '2024-01-30', '2024-01-30_' || CAST(c_custkey AS VARCHAR), c_custkey, c_nationkey, c_acctbal + 1 FROM c WHERE c_custkey % 2 = 0)
SELECT * FROM h
""")
def q_customer_history_by_day(spark, sf):
    """Daily snapshots by day folder: the re-run of a day writes that day only, rows without a day stay."""
    c = load(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    table = V.Versions(spark, _scratch(spark, "customer-days"), "Snapshot_Date")
    null = lambda kind: F.lit(None).cast(kind)
    table.commit(c.where("c_custkey % 5 = 0").withColumns({"Snapshot_Date": null("date"), "Snapshot_c_custkey": null("string")}))
    for day in ("2024-01-29", "2024-01-30"):
        V.snapshot_day(table, c, ["c_custkey"], day)
    V.snapshot_day(table, c.where("c_custkey % 2 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1), ["c_custkey"], "2024-01-30")
    return table.read()


@register("activity_anonymised_by_day", "P26", sql=with_(ACTIVITIES_SQL, ACT_SILVER_SQL) + f"""
SELECT Id, CreationDate, CASE WHEN CreationDate < DATE '{TODAY}' - INTERVAL 14 DAY THEN md5(UserId) ELSE UserId END AS UserId FROM silver
""")
def q_activity_anonymised_by_day(spark, sf):
    """User ids of aged days hashed: three runs on successive days, each writing only days that came of age; no hash is hashed."""
    table = V.Versions(spark, _scratch(spark, "activity-hashed"), "CreationDate")
    table.commit(_activities(spark, sf).select("Id", "CreationDate", "UserId"))
    for today in ("2024-01-20", "2024-01-27", TODAY):
        V.anonymise_days(table, ["UserId"], 14, today)
    return table.read().select("Id", "CreationDate", "UserId")


@register("settings_stamped_by_day", "M7", sql="""
SELECT DATE '2024-01-29' AS TransferDate, TIMESTAMP '2024-01-29 06:00:00' AS TransferDateTime, c_custkey, c_mktsegment FROM customer
UNION ALL SELECT DATE '2024-01-29', TIMESTAMP '2024-01-29 18:00:00', c_custkey, c_mktsegment FROM customer WHERE c_acctbal > 0
""")
def q_settings_stamped_by_day(spark, sf):
    """Two stamped appends on one day; the second writes its own rows beside the first's."""
    c = load(spark, sf, "customer")
    table = V.Versions(spark, _scratch(spark, "settings-days"), "TransferDate")
    V.append_stamped(table, c.select("c_custkey", "c_mktsegment"), "2024-01-29 06:00:00")
    V.append_stamped(table, c.where("c_acctbal > 0").select("c_custkey", "c_mktsegment"), "2024-01-29 18:00:00")
    return table.read().select("TransferDate", "TransferDateTime", "c_custkey", "c_mktsegment")


# --------------------------------------------------------------------------- M2-M6 on buckets
@register("customer_merged_in_buckets", "M2, M3, M4, M5, M6", sql=with_(f"""
c0 AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal < 5000),
s1 AS (SELECT c_custkey, c_acctbal + 100 AS c_acctbal, 'UPDATED-' || c_mktsegment AS c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')),
c1 AS (SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, t.c_name, CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
         CASE WHEN s.c_custkey IS NOT NULL THEN s.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment FROM c0 t FULL JOIN s1 s ON t.c_custkey = s.c_custkey),
c2 AS (SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, CASE WHEN t.c_custkey IS NULL THEN 'N' ELSE t.c_name END AS c_name,
         CASE WHEN s.c_custkey IS NOT NULL THEN 0 ELSE t.c_acctbal END AS c_acctbal, t.c_mktsegment
       FROM c1 t FULL JOIN (SELECT c_custkey FROM customer WHERE c_custkey % 10 = 0) s ON t.c_custkey = s.c_custkey),
c3 AS (SELECT * FROM c2 UNION ALL SELECT c_custkey, 'INSERTED', -1, 'X' FROM customer WHERE c_custkey % 7 = 0 AND c_custkey NOT IN (SELECT c_custkey FROM c2)),
c4 AS (SELECT c3.*, CASE WHEN c_custkey % 5 = 0 THEN 'dom-' || CAST(c_custkey % 5 AS VARCHAR) END AS DomainId FROM c3),
s5 AS (SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 2 = 0)""") + f"""
SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, c_name, CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
       c_mktsegment, DomainId, TIMESTAMP '{MERGE_NOW}' AS modified_at, s.c_custkey IS NULL AS is_deleted
FROM c4 t FULL JOIN s5 s ON t.c_custkey = s.c_custkey
""")
def q_customer_merged_in_buckets(spark, sf):
    """All merges in turn on a table in key buckets: upsert, upsert of one column, insert if absent, update only, full load with soft delete."""
    c = load(spark, sf, "customer")
    table = V.Buckets(spark, _scratch(spark, "customer-buckets"), ["c_custkey"], 32)
    V.upsert(table, c.where("c_acctbal < 5000").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"))
    V.upsert(table, c.where("c_mktsegment IN ('BUILDING', 'MACHINERY')").select(
        "c_custkey", (F.col("c_acctbal") + 100).alias("c_acctbal"), F.concat(F.lit("UPDATED-"), "c_mktsegment").alias("c_mktsegment")))
    V.upsert(table, c.where("c_custkey % 10 = 0").select("c_custkey", F.lit("N").alias("c_name"), F.lit(0.0).alias("c_acctbal")), ["c_acctbal"])
    V.insert_new(table, c.where("c_custkey % 7 = 0").select("c_custkey", F.lit("INSERTED").alias("c_name"), F.lit(-1.0).alias("c_acctbal"),
                                                            F.lit("X").alias("c_mktsegment")))
    V.update_from(table, c.where("c_custkey % 5 = 0").select("c_custkey", F.concat(F.lit("dom-"), (F.col("c_custkey") % 5).cast("string")).alias("DomainId")), ["DomainId"])
    V.upsert_soft_delete(table, c.where("c_custkey % 2 = 0").select("c_custkey", "c_acctbal"), MERGE_NOW)
    return table.rows()


# --------------------------------------------------------------------------- G4 kept current
@register("lineage_paths_refreshed", "G4", sql="WITH RECURSIVE " + EDGES_SQL.strip() + ",\n" + PATHS_SQL.strip()
          + "\nSELECT source, target, array_to_string(path, '>') AS path, length FROM paths")
def q_lineage_paths_refreshed(spark, sf):
    """Yesterday's paths brought up to today's edges: yesterday lacked every 50th customer edge and had some supplier edges more."""
    edges, _ = _lineage_inputs(spark, sf)
    ends = [F.col("UpStreamId"), F.col("DownStreamId")]
    edges = materialize(edges.select(*ends, "SourceDF"), "edges", LOCAL_CHECKPOINTS, codec="zstd")  # read by both searches and their comparison
    number = lambda c: F.split(c, ":")[1].cast("long")
    was = edges.where(~((F.col("SourceDF") == "nation_to_customer") & (number(ends[1]) % 50 == 0))).select(*ends)
    nations = edges.where(F.col("SourceDF") == "nation_to_supplier").where(number(ends[1]) % 50 == 1)
    was = was.unionByName(nations.select(ends[0], F.concat(F.lit("supplier:"), (number(ends[1]) + 1).cast("string")).alias("DownStreamId")))
    paths = G.shortest_paths(was, checkpoint_dir=LOCAL_CHECKPOINTS)
    out = G.refresh_paths(paths, was, edges, checkpoint_dir=LOCAL_CHECKPOINTS)
    discard(edges)
    return out.select("source", "target", F.array_join("path", ">").alias("path"), "length")


# --------------------------------------------------------------------------- A4, A14, A15, A40: users over windows
_WINDOWS_SQL = {f"last_{n}d": f"CreationDate BETWEEN DATE '{TODAY}' - INTERVAL {n} DAY AND DATE '{TODAY}'" for n in (7, 14, 30, 60, 90, 180)} | {
    f"{when}_{part}": f"date_trunc('{part}', CreationDate) = date_trunc('{part}', DATE '{TODAY}'{back})"
    for part, months in (("month", 1), ("quarter", 3), ("year", 12)) for when, back in (("current", ""), ("previous", f" - INTERVAL {months} MONTH"))}
#: a distinct count that takes a missing user as one
_USERS_SQL = ",\n  ".join(f"count(DISTINCT CASE WHEN {c} THEN u END) + coalesce(max(CASE WHEN {c} AND u IS NULL THEN 1 END), 0) AS {n}" for n, c in _WINDOWS_SQL.items())
_BLANK_USERS_SQL = "act AS (SELECT Activity, CreationDate, CASE WHEN UserId LIKE '%7' THEN NULL ELSE UserId END AS u FROM silver)"


def _users(spark, sf):
    return _activities(spark, sf).select("Activity", "CreationDate", F.when(~F.col("UserId").endswith("7"), F.col("UserId")).alias("User"))


@register("active_users_windows", "A4, A14, A15", sql=with_(ACTIVITIES_SQL, ACT_SILVER_SQL, _BLANK_USERS_SQL) + f"""
SELECT Activity,
  {_USERS_SQL}
FROM act GROUP BY Activity
""")
def q_active_users_windows(spark, sf):
    """Distinct users (a missing one counts) of each activity over six rolling and six calendar windows, from daily bitmaps loaded in two feeds."""
    users = _users(spark, sf)
    numbers = V.Buckets(spark, _scratch(spark, "user-numbers"), ["User"], 16)
    state = V.Versions(spark, _scratch(spark, "user-days"), "day")
    for feed in ("CreationDate < '2024-01-20'", "CreationDate >= '2024-01-15'"):  # five days are loaded again
        DY.load_days(state, numbers, users.where(feed), "CreationDate", "User", ["Activity"])
    return DY.window_users(state.read(), DY.all_windows(TODAY), ["Activity"])


@register("active_users_total", "A4, A15", sql=with_(ACTIVITIES_SQL, ACT_SILVER_SQL, _BLANK_USERS_SQL) + f"""
SELECT {_USERS_SQL.split(",\n  count(DISTINCT CASE WHEN date_trunc")[0]} FROM act
""")
def q_active_users_total(spark, sf):
    """Distinct users of all activities over the rolling windows: the daily bitmaps of the activities are united."""
    users = _users(spark, sf)
    numbers = materialize(DY.number_values(users, "User"), "user-numbers", LOCAL_CHECKPOINTS)
    return DY.window_users(DY.daily_sets(users, "CreationDate", "User", numbers, ["Activity"]), DY.rolling(TODAY))


@register("active_users_estimated", "A15, A40", sql=with_(ACTIVITIES_SQL, ACT_SILVER_SQL) + f"""
SELECT Activity, {", ".join(f"count(DISTINCT CASE WHEN {c} THEN UserId END) AS {n}, true AS {n}_close" for n, c in list(_WINDOWS_SQL.items())[:6])}
FROM silver GROUP BY Activity
""")
def q_active_users_estimated(spark, sf):
    """The rolling windows from daily sketches (dcount) beside the exact numbers: each estimate lies within five per cent, or one."""
    a = _activities(spark, sf).select("Activity", "CreationDate", "UserId")
    numbers = materialize(DY.number_values(a, "UserId"), "user-numbers", LOCAL_CHECKPOINTS)
    exact = DY.window_users(DY.daily_sets(a, "CreationDate", "UserId", numbers, ["Activity"]), DY.rolling(TODAY), ["Activity"])
    about = DY.window_users(DY.daily_sketches(a, "CreationDate", "UserId", ["Activity"]), DY.rolling(TODAY), ["Activity"])
    names = [c for c in exact.columns if c != "Activity"]
    both = exact.join(about.select("Activity", *[F.col(c).alias(f"{c}_about") for c in names]), "Activity")
    close = lambda c: F.abs(F.col(c) - F.col(f"{c}_about")) <= F.greatest(F.col(c) * 0.05, F.lit(1.0))
    return both.select("Activity", *[x for c in names for x in (F.col(c), close(c).alias(f"{c}_close"))])


# --------------------------------------------------------------------------- A27, A31
STORAGE_SQL = """
tables AS (SELECT s_suppkey AS TableId, s_name AS TableName FROM supplier WHERE s_nationkey < 20),
l AS (SELECT *, l_suppkey AS TableId, CAST(l_quantity AS BIGINT) AS q FROM lineitem),
columns_ AS (SELECT TableId FROM l WHERE l_linenumber = 1),
maps AS (SELECT TableId, q AS RecordCount FROM l WHERE l_linenumber <= 2),
states AS (SELECT TableId, l_partkey % 1000 AS DistinctStates FROM l WHERE l_linenumber <= 4),
dict AS (SELECT TableId, CASE WHEN l_returnflag = 'A' THEN 'N/A' ELSE 'DBTYPE_I8' END AS DATATYPE, CASE WHEN l_linestatus = 'O' THEN 'BASIC_DATA' ELSE 'HIERARCHY' END AS COLUMN_TYPE,
                q * 4096 AS DICTIONARY_SIZE, (l_partkey % 100) / 4.0 AS DICTIONARY_TEMPERATURE FROM l WHERE l_linenumber <= 3),
segs AS (SELECT TableId, CASE l_linenumber WHEN 1 THEN 'H$T (' WHEN 2 THEN 'U$T (' WHEN 3 THEN 'R$T (' ELSE 'T (' END || CAST(TableId AS VARCHAR) || ')' AS TABLE_ID,
                l_orderkey % 2 AS SEGMENT_NUMBER, q * 65536 AS USED_SIZE, (l_orderkey % 50) / 2.0 AS TEMPERATURE FROM l),
parts AS (SELECT TableId, q * 1000 AS DataSize FROM l WHERE l_linenumber = 5)"""


def _storage(spark, sf):
    """Model metadata of a table a supplier: columns, segment maps, column storages, dictionaries, segments, partitions."""
    line = load(spark, sf, "lineitem").withColumn("q", F.col("l_quantity").cast("long")).withColumn("TableId", F.col("l_suppkey"))
    at = lambda n: line.where(F.col("l_linenumber") <= n)
    k = F.col("l_linenumber")
    mark = F.when(k == 1, "H$T (").when(k == 2, "U$T (").when(k == 3, "R$T (").otherwise("T (")
    return {
        "tables": load(spark, sf, "supplier").where("s_nationkey < 20").select(F.col("s_suppkey").alias("TableId"), F.col("s_name").alias("TableName")),
        "columns": at(1).select("TableId"),
        "segment_maps": at(2).select("TableId", F.col("q").alias("RecordCount")),
        "column_storages": at(4).select("TableId", (F.col("l_partkey") % 1000).alias("DistinctStates")),
        "storage_columns": at(3).select("TableId", F.when(F.col("l_returnflag") == "A", "N/A").otherwise("DBTYPE_I8").alias("DATATYPE"),
                                        F.when(F.col("l_linestatus") == "O", "BASIC_DATA").otherwise("HIERARCHY").alias("COLUMN_TYPE"),
                                        (F.col("q") * 4096).alias("DICTIONARY_SIZE"), (F.col("l_partkey") % 100 / 4.0).alias("DICTIONARY_TEMPERATURE")),
        "segments": line.select("TableId", F.concat(mark, F.col("TableId").cast("string"), F.lit(")")).alias("TABLE_ID"), (F.col("l_orderkey") % 2).alias("SEGMENT_NUMBER"),
                                (F.col("q") * 65536).alias("USED_SIZE"), (F.col("l_orderkey") % 50 / 2.0).alias("TEMPERATURE")),
        "partitions": line.where("l_linenumber = 5").select("TableId", (F.col("q") * 1000).alias("DataSize")),
    }


@register("model_table_statistics", "A31", sql=with_(STORAGE_SQL, """
g AS (SELECT TableId, sum(USED_SIZE) FILTER (substr(TABLE_ID, 2, 1) <> '$') / 1048576.0 AS d, sum(USED_SIZE) FILTER (TABLE_ID LIKE 'H$%' AND SEGMENT_NUMBER = 0) / 1048576.0 AS h,
             sum(USED_SIZE) FILTER (TABLE_ID LIKE 'U$%') / 1048576.0 AS u, sum(USED_SIZE) FILTER (TABLE_ID LIKE 'R$%') / 1048576.0 AS r FROM segs GROUP BY TableId),
m AS (SELECT t.TableId, t.TableName, (SELECT nullif(count(*), 0) FROM columns_ c WHERE c.TableId = t.TableId) AS CountColumns,
        (SELECT sum(RecordCount) FROM maps x WHERE x.TableId = t.TableId)::BIGINT AS CountSegmentRecords,
        (SELECT sum(DistinctStates) FROM states x WHERE x.TableId = t.TableId)::BIGINT AS SumDistinctCounts,
        (SELECT sum(DICTIONARY_SIZE) / 1048576.0 FROM dict x WHERE x.TableId = t.TableId AND DATATYPE <> 'N/A' AND COLUMN_TYPE = 'BASIC_DATA') AS SumDictionarySize,
        d AS SumSegmentUsedSize, h AS SumSegmentHierarchySize, u, r FROM tables t LEFT JOIN g ON g.TableId = t.TableId),
s AS (SELECT *, CASE WHEN coalesce(SumSegmentUsedSize, SumDictionarySize, SumSegmentHierarchySize, u, r) IS NOT NULL THEN coalesce(SumSegmentUsedSize, 0) + coalesce(SumDictionarySize, 0)
             + coalesce(SumSegmentHierarchySize, 0) + coalesce(u, 0) + coalesce(r, 0) END AS SumSize FROM m WHERE coalesce(CountColumns, CountSegmentRecords, SumDistinctCounts, SumSegmentUsedSize, u, r) IS NOT NULL)""") + """
SELECT TableId, TableName, CountColumns, CountSegmentRecords, SumDistinctCounts, SumDictionarySize, SumSegmentUsedSize, SumSegmentHierarchySize, SumSize,
       SumSize / (SELECT sum(SumSize) FROM s) AS SumSizeRatio,
       TableName || ' | Col: ' || coalesce(CAST(CountColumns AS VARCHAR), '') || ' | Sum Size: ' || coalesce(CAST(floor(SumSize * 100 + 0.5) / 100 AS VARCHAR), '') || ' MB | Rows: '
         || coalesce(CAST(CountSegmentRecords AS VARCHAR), '') AS TableStatisticName FROM s
""")
def q_model_table_statistics(spark, sf):
    """Table statistics of the model analyser: five facts of different grain met by table, the share of the selected tables, a caption."""
    f = _storage(spark, sf)
    f.pop("partitions")
    return DR.table_statistics(**f)


@register("model_partition_statistics", "A27", sql=with_(STORAGE_SQL) + """
SELECT TableId, r.* EXCLUDE (k), p.* EXCLUDE (k), c.* EXCLUDE (k), g.* EXCLUDE (k), d.* EXCLUDE (k) FROM (SELECT DISTINCT TableId FROM l) t
LEFT JOIN (SELECT TableId AS k, sum(RecordCount)::DOUBLE / count(RecordCount) AS AvgRowsByPartition, min(RecordCount) AS MinRowsByPartition, max(RecordCount) AS MaxRowsByPartition,
                  sum(RecordCount)::BIGINT AS SegmentRecords, median(RecordCount)::DOUBLE AS MedianRowsByPartition FROM maps GROUP BY 1) r ON r.k = TableId
LEFT JOIN (SELECT TableId AS k, sum(DataSize) / 1048576.0 AS SumDataSizeByPartition, sum(DataSize)::DOUBLE / count(*) / 1048576.0 AS AvgDataSizeByPartition,
                  sum(DataSize)::DOUBLE / count(*) AS AvgDataSizeByPartitionBytes, median(DataSize) / 1048576.0 AS MedianDataSizeByPartition FROM parts GROUP BY 1) p ON p.k = TableId
LEFT JOIN (SELECT TableId AS k, sum(DistinctStates)::BIGINT AS Cardinality FROM states GROUP BY 1) c ON c.k = TableId
LEFT JOIN (SELECT TableId AS k, sum(TEMPERATURE)::DOUBLE / count(*) AS AvgSegmentTemperature FROM segs GROUP BY 1) g ON g.k = TableId
LEFT JOIN (SELECT TableId AS k, sum(DICTIONARY_TEMPERATURE)::DOUBLE / count(*) AS AvgDictionaryTemperature FROM dict GROUP BY 1) d ON d.k = TableId
""")
def q_model_partition_statistics(spark, sf):
    """Rows and sizes of partitions, segment records, cardinality and temperatures of every table."""
    f = _storage(spark, sf)
    return DR.partition_statistics(f["segment_maps"], f["partitions"], f["segments"], f["storage_columns"], f["column_storages"])


# --------------------------------------------------------------------------- J6, J7: filters over the relationship graph
STAR = [
    CX.Relationship("lineitem", "l_orderkey", "orders", "o_orderkey"),
    CX.Relationship("lineitem", "l_partkey", "part", "p_partkey"),
    CX.Relationship("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    CX.Relationship("orders", "o_custkey", "customer", "c_custkey"),
    CX.Relationship("customer", "c_nationkey", "nation", "n_nationkey"),
    CX.Relationship("supplier", "s_nationkey", "nation", "n_nationkey", active=False),
    CX.Relationship("nation", "n_regionkey", "region", "r_regionkey"),
]


def _star(spark, sf):
    return {t: load(spark, sf, t) for t in ("lineitem", "orders", "part", "supplier", "customer", "nation", "region")}


@register("filtered_fact_by_region", "J6, J7", sql="""
SELECT l_returnflag, count(*) AS lines, sum(CAST(l_quantity AS BIGINT))::BIGINT AS quantity FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey IN (
        SELECT n_nationkey FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name IN ('ASIA', 'EUROPE')))))
  AND l_partkey IN (SELECT p_partkey FROM part WHERE p_type <> 'STANDARD') AND l_linenumber <= 4
GROUP BY l_returnflag
""")
def q_filtered_fact_by_region(spark, sf):
    """Lines of customers of two regions (four hops away) and of some parts, with a filter of their own: three filters, one programme."""
    rows = CX.filtered("lineitem", _star(spark, sf), {"region": F.col("r_name").isin("ASIA", "EUROPE"), "part": F.col("p_type") != "STANDARD",
                                                      "lineitem": F.col("l_linenumber") <= 4}, STAR)
    return rows.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))


@register("filtered_fact_by_supplier_region", "J6, J7", sql="""
SELECT l_returnflag, count(*) AS lines FROM lineitem
WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name = 'ASIA')))
GROUP BY l_returnflag
""")
def q_filtered_fact_by_supplier_region(spark, sf):
    """The same region reached through the suppliers: their inactive relationship is switched on, the customers' way is left out."""
    star = [r for r in STAR if (r.many, r.one) != ("customer", "nation")]
    rows = CX.filtered("lineitem", _star(spark, sf), {"region": F.col("r_name") == "ASIA"}, star, use=["supplier.s_nationkey->nation.n_nationkey"])
    return rows.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lines"))


@register("nations_of_returned_parts", "J7", sql="""
SELECT n_name FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9000 AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey IN (
  SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'STANDARD'))))
""")
def q_nations_of_returned_parts(spark, sf):
    """Filters that travel against the relationships: from parts and returned lines over orders and customers to nations, both ways switched on."""
    back = ["lineitem.l_orderkey->orders.o_orderkey", "orders.o_custkey->customer.c_custkey", "customer.c_nationkey->nation.n_nationkey"]
    rows = CX.filtered("nation", _star(spark, sf), {"part": F.col("p_type") == "STANDARD", "lineitem": F.col("l_returnflag") == "R", "customer": F.col("c_acctbal") > 9000}, STAR, both=back)
    return rows.select("n_name")


# --------------------------------------------------------------------------- A1-A9 at several grains
_FAMILY_SQL = """count(*) AS operations, count(CASE WHEN l_returnflag <> 'A' THEN 1 END) AS live, count(CASE WHEN l_linestatus = 'O' AND l_quantity > 25 THEN 1 END) AS large_open,
  count(DISTINCT s) + coalesce(max(CASE WHEN s IS NULL THEN 1 END), 0) AS suppliers,
  count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey END) + coalesce(max(CASE WHEN l_returnflag = 'R' AND l_partkey IS NULL THEN 1 END), 0) AS returned_parts,
  CAST(sum(CAST(l_quantity AS DECIMAL(38,2))) AS DOUBLE) AS quantity, CAST(sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(38,2)) END) AS DOUBLE) AS finished_price,
  CAST(sum(CAST(l_discount AS DECIMAL(38,2))) AS DOUBLE) / count(l_discount) AS discount_avg, max(l_extendedprice) AS price_max, min(CASE WHEN l_tax > 0 THEN l_extendedprice END) AS taxed_price_min"""
_GRAINS = [[], ["line"], ["l_returnflag", "l_linestatus"], ["line", "l_returnflag", "l_linestatus"]]


@register("line_measures_by_grain", "A1, A2, A3, A4, A5, A7, A8, A9", sql="WITH f AS (SELECT *, CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE l_suppkey END AS s, CAST(l_linenumber AS VARCHAR) AS line FROM lineitem)\n" + "\nUNION ALL\n".join(
    f"SELECT '{','.join(g)}' AS grain, " + ", ".join(c if c in g else f"CAST(NULL AS VARCHAR) AS {c}" for c in ("line", "l_returnflag", "l_linestatus")) + f", {_FAMILY_SQL} FROM f"
    + (f" GROUP BY {', '.join(g)}" if g else "") for g in _GRAINS))
def q_line_measures_by_grain(spark, sf):
    """Counts, conditional and distinct counts, sums, averages and extremes at four grains, from one scan and one declared list."""
    m, c = CX.Measure, F.col
    rows = load(spark, sf, "lineitem").withColumns({"s": F.when(c("l_suppkey") % 9 != 0, c("l_suppkey")), "line": c("l_linenumber").cast("string")})
    return CX.measure_family(rows, {
        "operations": m("count"), "live": m("count", where=c("l_returnflag") != "A"), "large_open": m("count", where=(c("l_linestatus") == "O") & (c("l_quantity") > 25)),
        "suppliers": m("distinct", "s"), "returned_parts": m("distinct", "l_partkey", c("l_returnflag") == "R"),
        "quantity": m("sum", "l_quantity", decimals=2), "finished_price": m("sum", "l_extendedprice", c("l_linestatus") == "F", 2),
        "discount_avg": m("avg", "l_discount", decimals=2), "price_max": m("max", "l_extendedprice"), "taxed_price_min": m("min", "l_extendedprice", c("l_tax") > 0),
    }, _GRAINS)


# --------------------------------------------------------------------------- T10, T11, T13: all tables of the scan in one pass
#: An item's fields by array, as expressions of its customer k and its number j that both engines read.
_COMMON_FIELDS = {"id": "CASE WHEN k % 6 = 0 AND j = 2 THEN NULL ELSE '{p}-' || k || '-' || j END", "name": "'{p} ' || k", "description": "CASE WHEN k % 2 = 0 THEN 'about ' || k END",
                  "state": "'Active'", "lastUpdatedDate": "'2024-01-1' || k % 10 || 'T10:00:00'", "createdDate": "'2023-0' || (1 + k % 9) || '-05T08:00:00'",
                  "createdById": "'own-' || k % 40", "modifiedById": "'mod-' || j"}
_MADE = {"configuredById": "'own-' || k % 40", "modifiedById": "'mod-' || j", "modifiedDateTime": "'2024-01-1' || k % 10 || 'T10:00:00'"}
_ID, _NAME = _COMMON_FIELDS["id"], _COMMON_FIELDS["name"]
_ITEM_FIELDS = {
    "users": {"groupUserAccessRight": "'Admin'", "identifier": "'u' || k || '-' || j", "graphId": "'g' || k", "principalType": "'User'", "userType": "'Member'",
              "emailAddress": "'m' || k", "displayName": "'User ' || k"},
    "datamarts": {"id": _ID, "name": _NAME, "type": "'Sql'", **_MADE},
    "datasets": {"id": _ID, "name": _NAME, "configuredById": "'own-' || k % 40", "createdDate": "'2023-0' || (1 + k % 9) || '-05T08:00:00'", "targetStorageMode": "'Abf'", "contentProviderType": "'Pbix'"},
    "dataflows": {"objectId": _ID, "name": _NAME, "modifiedDateTime": "'2024-01-1' || k % 10 || 'T10:00:00'", "generation": "k % 2 + 1"},
    "reports": {"id": _ID, "name": _NAME, "datasetId": "'sm-' || k || '-1'", "datasetWorkspaceId": "'ws-' || k", "reportType": "'PowerBIReport'", "createdDateTime": "'2023-0' || (1 + k % 9)",
                "modifiedDateTime": "'2024-0' || (1 + k % 9)", "modifiedById": "'mod-' || j", "createdById": "'own-' || k % 40", "originalReportObjectId": "'rep-' || k || '-1'", "appId": "CASE WHEN j = 2 THEN 'app-' || k END"},
    "dashboards": {"id": _ID, "displayName": _NAME, "isReadOnly": "j = 2"},
    "KQLDatabase": _COMMON_FIELDS,
    "warehouses": {"id": _ID, "name": _NAME, "description": "'about ' || k", "state": "'Active'", **_MADE},
} | {a: _COMMON_FIELDS for a in ("Eventhouse", "Lakehouse", "Eventstream", "DataPipeline", "Notebook", "Environment", "Reflex", "MLModel")}
_USER_FIELDS = {"identifier": "'v' || k || '-' || j", "groupUserAccessRight": "'Viewer'", "artifactUserAccessRight": "CASE WHEN k % 3 = 0 THEN NULL ELSE 'Read' END",
                "graphId": "'g' || k", "principalType": "'User'", "displayName": "CASE WHEN k % 4 = 0 THEN NULL ELSE 'User ' || k END"}
_OWN_RIGHT = "CASE WHEN k % 5 = 0 THEN '' WHEN k % 7 = 0 THEN NULL ELSE 'Owner' END"
_USED = "CASE WHEN k % 8 = 0 THEN NULL ELSE 'ds-' || k % 100 END"


def _field(array: str, name: str) -> str:
    return _ITEM_FIELDS[array][name].replace("{p}", array.lower())


#: Workspaces of one task of the scan; each gives about seventy rows of the tables.
WORKSPACES_PER_TASK = 20_000


def _inventory_scan(spark, sf):
    """A workspace a customer with two items of each kind; keyless items, missing rights and usages among them."""
    def struct(fields: dict[str, str]) -> str:
        return "named_struct(" + ", ".join(f"'{n}', {e}" for n, e in fields.items()) + ")"

    arrays = []
    for array in _ITEM_FIELDS:
        fields = {n: _field(array, n) for n in _ITEM_FIELDS[array]}
        if array in ITEM_USER_TYPES:
            right = ITEM_USER_TYPES[array]
            fields["users"] = f"array({struct(_USER_FIELDS | ({right: _OWN_RIGHT} if right not in _USER_FIELDS else {}))})"
        if array in ("datasets", "dataflows", "reports"):
            fields["datasourceUsages"] = f"array({struct({'datasourceInstanceId': _USED})})"
        if array == "Lakehouse":
            fields["extendedProperties"] = struct({"path": "'abfss://' || k", "tables": "k % 50"})
            fields["tags"] = "array('a', 'k' || k)"
        # the two items by name, not by a lambda over numbers: compiled, and texts that they share are made once
        arrays.append(F.expr("array(" + ", ".join(re.sub(r"\bj\b", str(j), struct(fields)) for j in (1, 2)) + ")").alias(array))
    keys = load(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    # a few bytes a workspace are read, often by one task: the keys are dealt to all tasks before workspaces are made of
    # them, to more tasks where there are more (the count reads file footers), so no task's share grows
    keys = keys.repartition(max(4 * spark.sparkContext.defaultParallelism, -(-keys.count() // WORKSPACES_PER_TASK)))
    return keys.select(F.expr("'ws-' || k").alias("id"), *arrays)


def _inventory_sql(table: str) -> str:
    spec = _spec(table)
    array, columns = spec["array"], {"WorkspaceId": "upper('ws-' || k)"}
    for n in _ITEM_FIELDS[array]:
        if n not in spec["drop"]:
            final = spec["rename"].get(n, n)
            columns[final] = f"upper({_field(array, n)})" if final in spec["upper"] else _field(array, n)
    if array == "reports":  # the one table that keeps its users, as text
        columns["users"] = (f"'[{{' || {_USER_FIELDS['identifier']} || ', Viewer, ' || coalesce({_USER_FIELDS['artifactUserAccessRight']}, 'null') || ', g' || k || ', User, ' || "
                            f"coalesce({_USER_FIELDS['displayName']}, 'null') || ', ' || coalesce({_OWN_RIGHT}, 'null') || '}}]'")
    if array == "Lakehouse":
        columns |= {"extendedProperties.path": "'abfss://' || k", "extendedProperties.tables": "k % 50", "tags": "'[a, k' || k || ']'"}
    columns |= {out: f"substr({columns[source]}, 1, 10)" for out, source in spec["slices"].items() if source in columns}
    where = f" WHERE {_field(array, spec['key'])} IS NOT NULL" if spec["key"] else ""
    return "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in columns.items()) + " FROM (SELECT c_custkey AS k, unnest([1, 2]) AS j FROM customer)" + where


def _inventory_query(table: str) -> None:
    def query(spark, sf):
        return INV.tagged_rows(_inventory_scan(spark, sf)).where(F.col("table") == table).select(f"`{table}`.*")

    query.__doc__ = f"The {table.replace('_', ' ')} of the tenant scan, from the rows of all tables in one pass."
    register(f"inventory_{table}", "T10", sql=_inventory_sql(table))(query)


for _table in INVENTORY_TABLES:
    _inventory_query(_table)

_ITEMS_SQL = "(SELECT c_custkey AS k, unnest([1, 2]) AS j FROM customer)"


def _item_users_sql(array: str) -> str:
    right = ITEM_USER_TYPES[array]
    art, own = _USER_FIELDS["artifactUserAccessRight"], _OWN_RIGHT if right not in _USER_FIELDS else _USER_FIELDS[right]
    key, name = ("objectId" if array == "dataflows" else "id"), ("displayName" if array == "dashboards" else "name")
    return (f"SELECT upper('ws-' || k) AS WorkspaceId, upper(coalesce({_field(array, key)}, '')) AS ItemId, '{array}' AS ItemType, {_field(array, name)} AS ItemName, "
            f"CASE WHEN coalesce({own}, '') <> '' THEN {own} ELSE coalesce({art}, 'Viewer') END AS AccessRight, '' AS EmailAddress, coalesce({_USER_FIELDS['displayName']}, '') AS DisplayName, "
            f"{_USER_FIELDS['identifier']} AS Identifier, upper({_USER_FIELDS['graphId']}) AS GraphId, 'User' AS PrincipalType, '' AS UserType FROM {_ITEMS_SQL}")


@register("inventory_item_users", "T13", sql="\nUNION ALL\n".join(_item_users_sql(a) for a in ITEM_USER_TYPES))
def q_inventory_item_users(spark, sf):
    """Every user of every item of the fifteen item types, written and read with all other tables of the scan."""
    return INV.demultiplex(_inventory_scan(spark, sf), _scratch(spark, "inventory"))["item_users"]


def _usage_sql(array: str, key: str, named: str) -> str:
    return (f"SELECT '{named}' AS kind, upper('ws-' || k) AS WorkspaceId, upper({_field(array, key)}) AS ItemId, upper({_USED}) AS datasourceInstanceId FROM {_ITEMS_SQL} "
            f"WHERE {_field(array, key)} IS NOT NULL AND k % 8 <> 0")


@register("inventory_datasource_bridges", "T11", sql=_usage_sql("datasets", "id", "SemanticModelId") + "\nUNION ALL\n" + _usage_sql("dataflows", "objectId", "DataflowId")
          + "\nUNION ALL\n" + _usage_sql("reports", "id", "ReportId").replace("upper('ws-' || k) AS WorkspaceId", "NULL"))
def q_inventory_datasource_bridges(spark, sf):
    """The three bridges from items to data-source instances: semantic models, dataflows and reports."""
    tables = INV.demultiplex(_inventory_scan(spark, sf), _scratch(spark, "inventory"))
    parts = []
    for name, (_, _, named, spaced) in INV.USAGES.items():
        space = F.col("WorkspaceId") if spaced else F.lit(None).cast("string")
        parts.append(tables[name].select(F.lit(named).alias("kind"), space.alias("WorkspaceId"), F.col(named).alias("ItemId"), "datasourceInstanceId"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --------------------------------------------------------------------------- S4: logs read split by split
@register("gateway_logs_split", "S4", sql="""
SELECT 'r' || l_orderkey AS RequestId, l_linenumber || chr(10) || 'said "' || l_returnflag || '",' || chr(10) AS Note, CASE WHEN l_linenumber % 2 = 0 THEN l_linestatus END AS Status FROM lineitem
""")
def q_gateway_logs_split(spark, sf):
    """Report logs with line breaks, quotes and commas inside quoted values, and two headers, read by all tasks side by side."""
    line = load(spark, sf, "lineitem")
    k = F.col("l_linenumber")
    rows = line.select(F.concat(F.lit("r"), "l_orderkey").alias("RequestId"), F.concat(k.cast("string"), F.lit('\nsaid "'), "l_returnflag", F.lit('",\n')).alias("Note"),
                       F.col("l_linestatus").alias("Status"), (k % 2).alias("odd"))
    base = _scratch(spark, "split-logs")
    for odd, cols in ((0, ["Status", "RequestId", "Note"]), (1, ["RequestId", "Note"])):
        rows.where(F.col("odd") == odd).select(*cols).write.options(
            header=True, quote='"', escape='"', ignoreTrailingWhiteSpace=False, ignoreLeadingWhiteSpace=False).csv(f"{base}/{odd}")
        _rename_parts(spark, f"{base}/{odd}", f"QueryStartReport_{odd}")
    return LOGS.read_split_logs(spark, base, "QueryStartReport", ["RequestId", "Note", "Status"])


# --------------------------------------------------------------------------- S8: enum names
_ENUM_LISTS = DIM.ENUMS | {"partition_mode": DIM.PARTITION_MODE_ENUM}


def _enum_case(enum: str, shift: int) -> str:
    code = f"(p_partkey + {shift}) % 21"
    return "CASE " + code + "".join(f" WHEN {c} THEN '{n}'" for c, n in _ENUM_LISTS[enum]) + f" ELSE CAST({code} AS VARCHAR) END AS {enum}_name"


@register("model_enum_names", "S8, P27", sql="SELECT p_partkey, " + ", ".join(_enum_case(e, i) for i, e in enumerate(_ENUM_LISTS)) + " FROM part")
def q_model_enum_names(spark, sf):
    """The names beside the codes of all eighteen enums; unknown codes keep their value as text."""
    k = F.col("p_partkey")
    coded = load(spark, sf, "part").select("p_partkey", *[((k + i) % 21).alias(e) for i, e in enumerate(_ENUM_LISTS)])
    return DIM.enum_names(coded, {e: e for e in _ENUM_LISTS}).drop(*_ENUM_LISTS)


# --------------------------------------------------------------------------- T17: query-start fact and its data sources
def _sourced_starts(spark, sf):
    """Query starts with lists of data sources: two, one, none, and a text that is no list."""
    line = load(spark, sf, "lineitem")
    k = F.col("l_linenumber")
    texts = F.array(F.to_json(F.struct(F.lit("Sql").alias("kind"), SI._cat("srv", F.col("l_suppkey") % 9).alias("path"))),
                    F.to_json(F.struct(F.lit("Web").alias("ConnectorType"), SI._cat("u", k).alias("a"), F.lit("z").alias("b"))))
    lists = F.when(k == 7, F.lit("no list")).when(k == 6, F.lit("[]")).otherwise(F.to_json(F.slice(texts, F.lit(1), k % 2 + 1)))
    absent = [F.lit(None).cast("string").alias(c) for c in ("QueryExecutionStartTimeUTC", "QueryText", "EvaluationContext")]
    return line.select(SI._cat("gw-", F.col("l_suppkey") % 5).alias("GatewayObjectId"), SI._cat("r", F.col("l_orderkey")).alias("RequestId"),
                       SI._cat("t", k).alias("QueryTrackingId"), lists.alias("DataSource"), *absent)


@register("gateway_query_starts", "T17", sql=with_(SI.QUERY_START_SQL) + """
SELECT GatewayObjectId, RequestId, QueryTrackingId, start_ts AS QueryExecutionStartTimeUTC, 'Query' AS QueryType, CAST(start_ts AS DATE) AS QueryExecutionStartDate,
       RequestId || QueryTrackingId AS RequestTrackingKey FROM qs
""")
def q_gateway_query_starts(spark, sf):
    """The query-start fact: start time and date, and the key of the tracked request."""
    return T.build_query_start(SI.query_start_logs_from_lineitem(load(spark, sf, "lineitem")))["fact"]


@register("gateway_query_start_sources", "T17", sql=with_(SI.QUERY_START_SQL) + """
SELECT GatewayObjectId, RequestId, QueryTrackingId, 'Sql' AS "DataSource.kind", 'srv' || CAST(sk % 9 AS VARCHAR) AS "DataSource.path", RequestId || QueryTrackingId AS RequestTrackingKey FROM qs WHERE ln < 6
UNION ALL
SELECT GatewayObjectId, RequestId, QueryTrackingId, 'Web', 'u' || CAST(ln AS VARCHAR) || ';z', RequestId || QueryTrackingId FROM qs WHERE ln < 6 AND ln % 2 = 1
""")
def q_gateway_query_start_sources(spark, sf):
    """The data sources of query starts: a row each of a JSON list, kind and path with their fallbacks; lists that don't parse give none."""
    return T.build_query_start(_sourced_starts(spark, sf))["datasources"]

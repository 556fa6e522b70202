"""Registered queries over a model catalogue with names, types, texts and inactive relationships of its own.

One model holds twenty customers' tables, so models grow with the data; each
order is a column, a relationship and a measure of its customer's table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import rules as B
from .registry import register, with_
from .standins import _cat, load

#: Rules on column texts and names (16, 49, 54, 56), types and use of relationships (24, 40, 55, 27), models (13, 22), descriptions (45).
NAMED_RULES = [13, 16, 22, 24, 27, 40, 45, 49, 54, 55, 56]


def named_model(customer: DataFrame, orders: DataFrame) -> dict[str, DataFrame]:
    """Model metadata, row for row: a table (with an Id column) a customer, a column, a relationship and a measure an order."""
    def model(key):
        return _cat("model-", F.floor(key / 20)).alias("ModelId")

    c, o, oc = F.col("c_custkey"), F.col("o_orderkey"), F.col("o_custkey")
    own, other = _cat("T", oc % 20), _cat("T", F.floor(oc % 20 / 2))
    prefix = F.element_at(F.array(*map(F.lit, ("Country", "City of ", "Month", "Months", "Start MONTH ", "latitude", "Amount", "Key"))), (o % 8 + 1).cast("int"))
    column = F.concat(prefix, o.cast("string"))
    kind = F.element_at(F.create_map(*[F.lit(x) for pair in (
        ("1-URGENT", "Int64"), ("2-HIGH", "String"), ("3-MEDIUM", "DateTime"), ("4-NOT SPECIFIED", "String"), ("5-LOW", "Int64")) for x in pair]), F.col("o_orderpriority"))
    tables = customer.select(
        model(c), _cat("T", c % 20).alias("TableName"), (c % 5 == 0).alias("IsHidden"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Time").otherwise("").alias("DataCategory"),
        F.when(F.col("c_nationkey") % 2 == 0, "").when(F.col("c_nationkey") % 3 != 0, "d").alias("Description"))
    ids = customer.where(F.col("c_nationkey") % 5 != 0).select(
        model(c), _cat("T", c % 20).alias("TableName"), F.lit("Id").alias("ColumnName"),
        F.when(F.col("c_nationkey") % 2 == 0, "Int64").otherwise("String").alias("DataType"), F.lit("Data").alias("Type"),
        F.lit(True).alias("IsHidden"), F.lit(False).alias("IsKey"))
    columns = orders.select(
        model(oc), own.alias("TableName"), column.alias("ColumnName"), kind.alias("DataType"),
        F.when(F.col("o_orderstatus") == "F", "Calculated").otherwise("Data").alias("Type"),
        (o % 4 == 1).alias("IsHidden"), (o % 6 == 0).alias("IsKey"),
        F.when(oc % 3 == 0, "").when(oc % 3 == 1, column).alias("SortByColumn"),
        F.when(oc % 2 == 0, "MMMM yyyy").otherwise("").alias("FormatString"),
        F.when(oc % 7 == 0, "Place").when(oc % 7 < 4, "").alias("DataCategory"),
        F.when(oc % 4 == 0, "d").otherwise("").alias("Description"),
        F.when(o % 3 == 0, "RELATED(Dim[x])").when(o % 3 == 1, "1 + related (Dim[x])").otherwise("SUM(Dim[related])").alias("Expression"))
    relationships = orders.select(
        model(oc), own.alias("FromTable"), column.alias("FromColumn"), other.alias("ToTable"), F.lit("Id").alias("ToColumn"),
        F.lit("Many").alias("FromCardinality"), F.lit("One").alias("ToCardinality"), F.lit("OneDirection").alias("CrossFilteringBehavior"),
        (o % 2 == 0).alias("IsActive"))
    call = F.when(F.col("o_orderstatus") == "O", _cat("CALCULATE([n], USERELATIONSHIP('", own, "'[", column, "], '", other, "'[Id]))")) \
        .when(F.col("o_orderstatus") == "F", _cat("calculate([n], userelationship (", F.lower(own), "[", column, "],", other, "[ID]))")) \
        .otherwise(_cat("SUM('", own, "'[", column, "])"))
    measures = orders.select(
        model(oc), own.alias("TableName"), _cat("M", o).alias("MeasureName"), call.alias("Expression"), (o % 3 == 0).alias("IsHidden"),
        F.when(o % 5 == 0, "d").otherwise("").alias("Description"))
    rls = customer.where(c % 3 == 0).select(
        model(c), _cat("T", c % 20).alias("TableName"), F.lit("Reader").alias("RoleName"), F.lit("TRUE()").alias("FilterExpression"))
    models = customer.select(model(c), (F.floor(c / 20) % 2 == 0).alias("IsDirectLake"), (F.floor(c / 20) % 3 == 0).alias("UsesView")).distinct()
    none = models.select("ModelId", F.lit("").alias("TableName")).where(F.lit(False))
    return {"models": models, "tables": tables, "columns": ids.unionByName(columns, allowMissingColumns=True), "relationships": relationships,
            "measures": measures, "rls": rls, "partitions": none.withColumn("PartitionName", F.lit("")),
            "hierarchies": none.withColumns({"HierarchyName": F.lit(""), "ColumnName": F.lit("")})}


NAMED_SQL = """
cu AS (SELECT 'model-' || CAST(c_custkey // 20 AS VARCHAR) AS ModelId, c_custkey // 20 AS mn, 'T' || CAST(c_custkey % 20 AS VARCHAR) AS TableName, * FROM customer),
ord AS (
  SELECT 'model-' || CAST(o_custkey // 20 AS VARCHAR) AS ModelId, 'T' || CAST(o_custkey % 20 AS VARCHAR) AS TableName,
         'T' || CAST((o_custkey % 20) // 2 AS VARCHAR) AS ToTable,
         CASE o_orderkey % 8 WHEN 0 THEN 'Country' WHEN 1 THEN 'City of ' WHEN 2 THEN 'Month' WHEN 3 THEN 'Months' WHEN 4 THEN 'Start MONTH '
              WHEN 5 THEN 'latitude' WHEN 6 THEN 'Amount' ELSE 'Key' END || CAST(o_orderkey AS VARCHAR) AS ColumnName,
         CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN 'Int64' WHEN o_orderpriority = '3-MEDIUM' THEN 'DateTime'
              WHEN o_orderpriority IN ('2-HIGH', '4-NOT SPECIFIED') THEN 'String' END AS DataType,
         * FROM orders),
idt AS (SELECT ModelId, TableName, CASE WHEN c_nationkey % 2 = 0 THEN 'Int64' ELSE 'String' END AS DataType FROM cu WHERE c_nationkey % 5 <> 0),
rt AS (SELECT o.*, i.DataType AS ToType FROM ord o LEFT JOIN idt i ON i.ModelId = o.ModelId AND i.TableName = o.ToTable),
used AS (SELECT ModelId, lower(TableName) AS ft, lower(ColumnName) AS fc, lower(ToTable) AS tt FROM ord WHERE o_orderstatus IN ('O', 'F'))"""


@register("named_model_rule_violations", "B1, B3, B5, B7, B10", sql=with_(NAMED_SQL) + r"""
, v AS (
  SELECT DISTINCT ModelId, 13 AS RuleId, 'Model' AS ObjectType, ModelId AS ObjectName FROM cu WHERE mn % 2 = 0 AND mn % 3 = 0
  UNION ALL SELECT ModelId, 16, 'Column', ColumnName FROM ord WHERE o_orderstatus = 'F' AND o_orderkey % 3 < 2
  UNION ALL SELECT DISTINCT ModelId, 22, 'Model', ModelId FROM cu
    WHERE NOT EXISTS (SELECT 1 FROM ord o JOIN cu t ON t.ModelId = o.ModelId AND t.TableName = o.TableName
                      WHERE o.ModelId = cu.ModelId AND o.o_orderkey % 6 = 0 AND o.DataType = 'DateTime' AND t.c_mktsegment = 'BUILDING')
  UNION ALL SELECT ModelId, 24, 'Relationship', ColumnName FROM rt WHERE DataType IS DISTINCT FROM ToType
  UNION ALL SELECT ModelId, 27, 'Table', TableName FROM cu
    WHERE c_custkey % 3 = 0 AND EXISTS (SELECT 1 FROM used u WHERE u.ModelId = cu.ModelId AND u.tt = lower(cu.TableName))
  UNION ALL SELECT ModelId, 40, 'Relationship', ColumnName FROM ord o
    WHERE o_orderkey % 2 <> 0 AND NOT EXISTS (SELECT 1 FROM used u WHERE u.ModelId = o.ModelId AND u.ft = lower(o.TableName)
                                              AND u.fc = lower(o.ColumnName) AND u.tt = lower(o.ToTable))
  UNION ALL SELECT ModelId, 45, 'Table', TableName FROM cu
    WHERE c_custkey % 5 <> 0 AND (c_nationkey % 2 = 0 OR c_nationkey % 3 = 0)
  UNION ALL SELECT ModelId, 45, 'Column', ColumnName FROM ord WHERE o_orderkey % 4 <> 1 AND o_custkey % 4 <> 0
  UNION ALL SELECT ModelId, 45, 'Measure', 'M' || CAST(o_orderkey AS VARCHAR) FROM ord WHERE o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0
  UNION ALL SELECT ModelId, 49, 'Column', ColumnName FROM ord
    WHERE o_custkey % 7 <> 0 AND regexp_matches(lower(ColumnName), '^(country|city|continent|latitude|longitude)')
  UNION ALL SELECT ModelId, 54, 'Column', ColumnName FROM ord
    WHERE regexp_matches(ColumnName, '(?i)month') AND NOT regexp_matches(ColumnName, '(?i)months') AND DataType = 'String' AND o_custkey % 3 <> 1
  UNION ALL SELECT ModelId, 55, 'Relationship', ColumnName FROM rt WHERE DataType IS DISTINCT FROM 'Int64' OR ToType IS DISTINCT FROM 'Int64'
  UNION ALL SELECT ModelId, 56, 'Column', ColumnName FROM ord WHERE contains(lower(ColumnName), 'month') AND DataType = 'DateTime' AND o_custkey % 2 <> 0)
SELECT RuleId, ModelId, ObjectType, CAST(count(*) AS BIGINT) AS violations, CAST(count(DISTINCT ObjectName) AS BIGINT) AS objects,
       min(ObjectName) AS first_object, max(ObjectName) AS last_object
FROM v GROUP BY 1, 2, 3
""")
def q_named_model_rule_violations(spark, sf):
    """Rules on column names and texts, relationship types and use, date tables and descriptions, per model, rule and kind of object."""
    v = B.bpa(named_model(load(spark, sf, "customer"), load(spark, sf, "orders")), NAMED_RULES)
    # a relationship by the column that it starts from
    name = F.when(F.col("ObjectType") == "Relationship", F.regexp_extract("ObjectName", r"^'[^\[]*\[([^\]]*)\]", 1)).otherwise(F.col("ObjectName"))
    return v.withColumn("ObjectName", name).groupBy("RuleId", "ModelId", "ObjectType").agg(
        F.count(F.lit(1)).alias("violations"), F.count_distinct("ObjectName").alias("objects"),
        F.min("ObjectName").alias("first_object"), F.max("ObjectName").alias("last_object"))


def _catalogue_sql() -> str:
    quoted = ["(%d, %s)" % (r[0], ", ".join("'%s'" % x.replace("'", "''") for x in r[1:])) for r in B.RULE_CATALOGUE]
    return "rc(RuleId, Category, Scope, Severity, ImpactArea, RuleName) AS (VALUES " + ",\n ".join(quoted) + ")"


@register("rule_catalogue_use", "S8, A5, B1, B3", sql=with_(NAMED_SQL, _catalogue_sql()) + r"""
, v AS (
  SELECT 16 AS RuleId, ModelId FROM ord WHERE o_orderstatus = 'F' AND o_orderkey % 3 < 2
  UNION ALL SELECT 24, ModelId FROM rt WHERE DataType IS DISTINCT FROM ToType
  UNION ALL SELECT 55, ModelId FROM rt WHERE DataType IS DISTINCT FROM 'Int64' OR ToType IS DISTINCT FROM 'Int64'
  UNION ALL SELECT 56, ModelId FROM ord WHERE contains(lower(ColumnName), 'month') AND DataType = 'DateTime' AND o_custkey % 2 <> 0)
SELECT rc.RuleId, rc.Category, rc.Scope, rc.Severity, rc.ImpactArea, rc.RuleName, CAST(count(v.RuleId) AS BIGINT) AS violations,
       CAST(count(DISTINCT v.ModelId) AS BIGINT) AS models
FROM rc LEFT JOIN v ON v.RuleId = rc.RuleId GROUP BY ALL
""")
def q_rule_catalogue_use(spark, sf):
    """The whole rule catalogue, each rule with its violations and the models that have any (rules without stay, with none)."""
    v = B.bpa(named_model(load(spark, sf, "customer"), load(spark, sf, "orders")), [16, 24, 55, 56])
    # violations are counted before they meet the catalogue's sixty rows
    n = v.groupBy("RuleId").agg(F.count(F.lit(1)).alias("violations"), F.count_distinct("ModelId").alias("models"))
    return B.rule_catalogue(spark).join(n, "RuleId", "left").na.fill(0, ["violations", "models"])

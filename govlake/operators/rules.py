"""Model best-practice rules (B1-B10) as one Spark job over metadata tables.

Each rule is a predicate over one kind of model object, expressed with
DataFrame filters, joins and ``rlike``; :func:`bpa` runs the selected rules
and returns one row per violation ``(ModelId, RuleId, ObjectType,
TableName, ObjectName)``.  All rules of all models run in one plan: each
metadata table is scanned once per rule family and grouped by model, so
the job scales with the number of models, not with a per-model loop.

Metadata tables (DataFrames, one row per object; every table carries
``ModelId``):

* ``models``        ModelId, IsDirectLake, UsesView
* ``tables``        TableName, IsHidden, DataCategory, Description, IsCalculated,
                    IsFieldParameter, IsCalculationGroup, RowCount
* ``columns``       TableName, ColumnName, DataType, Type, IsHidden, IsAvailableInMDX,
                    IsKey, SortByColumn, SummarizeBy, FormatString, DataCategory,
                    Description, Expression, SourceColumn
* ``measures``      TableName, MeasureName, Expression, IsHidden, FormatString, Description
* ``relationships`` FromTable, FromColumn, ToTable, ToColumn, FromCardinality,
                    ToCardinality, CrossFilteringBehavior, IsActive
* ``partitions``    TableName, PartitionName, Mode, SourceType, Expression,
                    DataCoverageDefinition
* ``rls``           TableName, RoleName, FilterExpression
* ``hierarchies``   TableName, HierarchyName, ColumnName (one row per level)
* ``calc_items``    TableName, ItemName, Expression
* ``dependencies``  ObjectType, TableName, ObjectName, ReferencedObjectType,
                    ReferencedTable, ReferencedObject

Rules 38 and 39 (qualified/unqualified references) resolve each measure's
references through ``dependencies`` (an equi-join, no DAX parsing) and test
only the reference text of each resolved pair.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

# --- fixed values ---------------------------------------------------------
# The rule catalogue (RuleId, Category, Scope, Severity, ImpactArea, RuleName).
RULE_CATALOGUE = [
    (1, "Performance", "Column", "Warning", "Query Operation", "Do not use floating point data types"),
    (2, "Performance", "Column", "Warning", "Background Operation", "Avoid using calculated columns"),
    (3, "Performance", "Relationship", "Warning", "Query Operation", "Check if bi-directional and many-to-many relationships are valid"),
    (4, "Performance", "Row Level Security", "Info", "Query Operation", "Check if dynamic row level security (RLS) is necessary"),
    (5, "Performance", "Table", "Warning", "Query Operation", "Avoid using many-to-many relationships on tables used for dynamic row level security"),
    (6, "Performance", "Relationship", "Warning", "Query Operation", "Many-to-many relationships should be single-direction"),
    (7, "Performance", "Column", "Warning", "Query Operation", "Set IsAvailableInMdx to false on non-attribute columns"),
    (8, "Performance", "Partition", "Warning", "Query Operation", "Set 'Data Coverage Definition' property on the DirectQuery partition of a hybrid table"),
    (9, "Performance", "Model", "Warning", "Query Operation", "Dual mode is only relevant for dimension tables if DirectQuery is used for the corresponding fact table"),
    (10, "Performance", "Table", "Warning", "Background Operation", "Set dimensions tables to dual mode instead of import when using DirectQuery on fact tables"),
    (11, "Performance", "Partition", "Warning", "Background Operation", "Minimize Power Query transformations"),
    (12, "Performance", "Table", "Warning", "Query Operation", "Consider a star-schema instead of a snowflake architecture"),
    (13, "Performance", "Model", "Warning", "Query Operation", "Avoid using views when using Direct Lake mode"),
    (14, "Performance", "Measure", "Warning", "Query Operation", "Avoid adding 0 to a measure"),
    (15, "Performance", "Table", "Warning", "Background Operation", "Reduce usage of calculated tables"),
    (16, "Performance", "Column", "Warning", "Query Operation", "Reduce usage of calculated columns that use the RELATED function"),
    (17, "Performance", "Model", "Warning", "Query Operation", "Avoid excessive bi-directional or many-to-many relationships"),
    (18, "Performance", "Table", "Warning", "Query Operation", "Remove auto-date table"),
    (19, "Performance", "Table", "Warning", "Usability", "Date/calendar tables should be marked as a date table"),
    (20, "Performance", "Table", "Warning", "Background Operation", "Large tables should be partitioned"),
    (21, "Performance", "Row Level Security", "Warning", "Query Operation", "Limit row level security (RLS) logic"),
    (22, "Performance", "Model", "Warning", "Usability", "Model should have a date table"),
    (23, "Error Prevention", "Calculation Item", "Error", "Usability", "Calculation items must have an expression"),
    (24, "Error Prevention", "Relationship", "Warning", "Query Operation", "Relationship columns should be of the same data type"),
    (25, "Error Prevention", "Column", "Error", "Usability", "Data columns must have a source column"),
    (26, "Error Prevention", "Column", "Warning", "Query Operation", "Set IsAvailableInMdx to true on necessary columns"),
    (27, "Error Prevention", "Table", "Error", "Query Operation", "Avoid the USERELATIONSHIP function and RLS against the same table"),
    (28, "DAX Expressions", "Measure", "Warning", "Query Operation", "Avoid using the IFERROR function"),
    (29, "DAX Expressions", "Measure", "Warning", "Query Operation", "Use the TREATAS function instead of INTERSECT for virtual relationships"),
    (30, "DAX Expressions", "Measure", "Warning", "Usability", "The EVALUATEANDLOG function should not be used in production models"),
    (31, "DAX Expressions", "Measure", "Warning", "Usability", "Measures should not be direct references of other measures"),
    (32, "DAX Expressions", "Measure", "Warning", "Usability", "No two measures should have the same definition"),
    (33, "DAX Expressions", "Measure", "Warning", "Query Operation", "Avoid addition or subtraction of constant values to results of divisions"),
    (34, "DAX Expressions", "Measure", "Warning", "Query Operation", "Avoid using '1-(x/y)' syntax"),
    (35, "DAX Expressions", "Measure", "Warning", "Query Operation", "Filter measure values by columns, not tables"),
    (36, "DAX Expressions", "Measure", "Warning", "Query Operation", "Filter column values with proper syntax"),
    (37, "DAX Expressions", "Measure", "Warning", "Query Operation", "Use the DIVIDE function for division"),
    (38, "DAX Expressions", "Measure", "Error", "Usability", "Column references should be fully qualified"),
    (39, "DAX Expressions", "Measure", "Error", "Usability", "Measure references should be unqualified"),
    (40, "DAX Expressions", "Relationship", "Warning", "Usability", "Inactive relationships that are never activated"),
    (41, "Maintenance", "Column", "Warning", "Usability", "Remove unnecessary columns"),
    (42, "Maintenance", "Measure", "Warning", "Usability", "Remove unnecessary measures"),
    (43, "Maintenance", "Table", "Warning", "Usability", "Ensure tables have relationships"),
    (44, "Maintenance", "Table", "Warning", "Usability", "Calculation groups with no calculation items"),
    (45, "Maintenance", "Column, Measure, Table", "Info", "Usability", "Visible objects with no description"),
    (46, "Formatting", "Column", "Warning", "Usability", "Provide format string for 'Date' columns"),
    (47, "Formatting", "Column", "Warning", "Query Operation", "Do not summarize numeric columns"),
    (48, "Formatting", "Measure", "Info", "Usability", "Provide format string for measures"),
    (49, "Formatting", "Column", "Info", "Usability", "Add data category for columns"),
    (50, "Formatting", "Measure", "Warning", "Usability", "Percentages should be formatted with thousands separators and 1 decimal"),
    (51, "Formatting", "Measure", "Warning", "Usability", "Whole numbers should be formatted with thousands separators and no decimals"),
    (52, "Formatting", "Column", "Info", "Usability", "Hide foreign keys"),
    (53, "Formatting", "Column", "Info", "Usability", "Mark primary keys"),
    (54, "Formatting", "Column", "Info", "Usability", "Month (as a string) must be sorted"),
    (55, "Formatting", "Relationship", "Warning", "Query Operation", "Relationship columns should be of integer data type"),
    (56, "Formatting", "Column", "Warning", "Usability", 'Provide format string for "Month" columns'),
    (57, "Formatting", "Column", "Info", "Usability", "Format flag columns as Yes/No value strings"),
    (58, "Formatting", "Table, Column, Measure, Partition, Hierarchy", "Error", "Usability", "Objects should not start or end with a space"),
    (59, "Formatting", "Table, Column, Measure, Partition, Hierarchy", "Info", "Usability", "First letter of objects must be capitalized"),
    (60, "Naming Conventions", "Table, Column, Measure, Partition, Hierarchy", "Warning", "Usability", "Object names must not contain special characters"),
]
# Power Query steps that rule 11 flags.
PQ_HEAVY_STEPS = ['Table.Combine("', 'Table.Join("', 'Table.NestedJoin("', 'Table.AddColumn("', 'Table.Group("',
                  'Table.Sort("', 'Table.Pivot("', 'Table.Unpivot("', 'Table.UnpivotOtherColumns("',
                  'Table.Distinct("', '[Query=(""SELECT', "Value.NativeQuery", "OleDb.Query", "Odbc.Query"]
# RLS functions that rule 21 flags.
RLS_HEAVY_FUNCTIONS = ["right(", "left(", "filter(", "upper(", "lower(", "find("]
# Column name prefixes that rule 49 expects a data category for.
GEO_PREFIXES = ["country", "city", "continent", "latitude", "longitude"]
LARGE_TABLE_ROWS = 25_000_000
# --------------------------------------------------------------------------

NOT_BUILT: set[int] = set()


def rule_catalogue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULE_CATALOGUE, "RuleId int, Category string, Scope string, Severity string, "
                                                 "ImpactArea string, RuleName string")


def _b(c: str) -> Column:
    return F.coalesce(F.col(c).cast("boolean"), F.lit(False))


def _s(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _opt(df: DataFrame, name: str, default, dtype: str = "string") -> Column:
    """An optional metadata field: the column when present, else a default."""
    return F.col(name) if name in df.columns else F.lit(default).cast(dtype)


def _hidden(cols: DataFrame, tables: DataFrame) -> DataFrame:
    """Columns with the flag 'column or its table hidden' (ColHidden)."""
    t = tables.select("ModelId", "TableName", _b("IsHidden").alias("_th"))
    return cols.join(t, ["ModelId", "TableName"], "left").withColumn(
        "ColHidden", _b("IsHidden") | F.coalesce(F.col("_th"), F.lit(False))).drop("_th")


def _out(df: DataFrame, rule: int, obj_type: str, table: Column | str, name: Column | str) -> DataFrame:
    t = F.col(table) if isinstance(table, str) else table
    n = F.col(name) if isinstance(name, str) else name
    return df.select("ModelId", F.lit(rule).alias("RuleId"), F.lit(obj_type).alias("ObjectType"),
                     t.cast("string").alias("TableName"), n.cast("string").alias("ObjectName"))


def _direct_lake(m: dict) -> DataFrame:
    return m["models"].select("ModelId", _b("IsDirectLake").alias("IsDirectLake"), _b("UsesView").alias("UsesView"))


def _sort_by_used(m: dict) -> DataFrame:
    """(ModelId, TableName, ColumnName) of columns some column sorts by."""
    c = m["columns"]
    return (c.filter(F.col("SortByColumn").isNotNull() & (F.col("SortByColumn") != ""))
            .select("ModelId", "TableName", F.col("SortByColumn").alias("ColumnName")).distinct())


def _in_hierarchy(m: dict) -> DataFrame:
    return m["hierarchies"].select("ModelId", "TableName", "ColumnName").distinct()


def _rel_ends(m: dict) -> DataFrame:
    """(ModelId, TableName, ColumnName, End, Cardinality) for both relationship ends."""
    r = m["relationships"]
    f = r.select("ModelId", F.col("FromTable").alias("TableName"), F.col("FromColumn").alias("ColumnName"),
                 F.lit("From").alias("End"), F.col("FromCardinality").alias("Cardinality"))
    t = r.select("ModelId", F.col("ToTable").alias("TableName"), F.col("ToColumn").alias("ColumnName"),
                 F.lit("To").alias("End"), F.col("ToCardinality").alias("Cardinality"))
    return f.unionByName(t)


def _m2m(r: DataFrame | None = None) -> Column:
    return (F.col("FromCardinality") == "Many") & (F.col("ToCardinality") == "Many")


def _bidi(r: DataFrame | None = None) -> Column:
    return F.col("CrossFilteringBehavior") == "BothDirections"


# ---------------------------------------------------------------------------- B1 columns


# ---------------------------------------------------------------------------- B2 columns vs others
def r7(m):
    c = _hidden(m["columns"], m["tables"]).join(_direct_lake(m), "ModelId", "left")
    c = c.join(_sort_by_used(m), ["ModelId", "TableName", "ColumnName"], "left_anti")
    c = c.join(_in_hierarchy(m), ["ModelId", "TableName", "ColumnName"], "left_anti")
    c = c.filter(~F.coalesce(F.col("IsDirectLake"), F.lit(False)) & _b("IsAvailableInMDX") & F.col("ColHidden")
                 & (F.length(_s("SortByColumn")) == 0))
    return _out(c, 7, "Column", "TableName", "ColumnName")


def r26(m):
    c = m["columns"].join(_direct_lake(m), "ModelId", "left")
    used = _sort_by_used(m).unionByName(_in_hierarchy(m)).distinct().withColumn("_used", F.lit(True))
    c = c.join(used, ["ModelId", "TableName", "ColumnName"], "left")
    c = c.filter(~F.coalesce(F.col("IsDirectLake"), F.lit(False)) & ~_b("IsAvailableInMDX")
                 & (F.coalesce(F.col("_used"), F.lit(False)) | (F.length(_s("SortByColumn")) > 0)))
    return _out(c, 26, "Column", "TableName", "ColumnName")


def r41(m):
    c = _hidden(m["columns"], m["tables"]).filter(F.col("ColHidden"))
    ends = _rel_ends(m).select("ModelId", "TableName", "ColumnName").distinct()
    c = (c.join(ends, ["ModelId", "TableName", "ColumnName"], "left_anti")
         .join(_in_hierarchy(m), ["ModelId", "TableName", "ColumnName"], "left_anti")
         .join(_sort_by_used(m), ["ModelId", "TableName", "ColumnName"], "left_anti"))
    # as written: the column must have dependencies (the rule text says unreferenced)
    deps = m["dependencies"].filter(F.upper("ObjectType") == "COLUMN").select(
        "ModelId", "TableName", F.col("ObjectName").alias("ColumnName")).distinct()
    return _out(c.join(deps, ["ModelId", "TableName", "ColumnName"], "left_semi"), 41, "Column", "TableName", "ColumnName")


def r52(m):
    c = m["columns"].filter(~_b("IsHidden"))
    fk = _rel_ends(m).filter((F.col("End") == "From") & (F.col("Cardinality") == "Many")) \
        .select("ModelId", "TableName", "ColumnName").distinct()
    return _out(c.join(fk, ["ModelId", "TableName", "ColumnName"], "left_semi"), 52, "Column", "TableName", "ColumnName")


def r53(m):
    t = m["tables"].select("ModelId", "TableName", _s("DataCategory").alias("_tcat"))
    c = m["columns"].join(t, ["ModelId", "TableName"], "left").filter(~_b("IsKey") & (F.coalesce("_tcat", F.lit("")) != "Time"))
    pk = _rel_ends(m).filter((F.col("End") == "To") & (F.col("Cardinality") == "One")) \
        .select("ModelId", "TableName", "ColumnName").distinct()
    return _out(c.join(pk, ["ModelId", "TableName", "ColumnName"], "left_semi"), 53, "Column", "TableName", "ColumnName")


# ---------------------------------------------------------------------------- B3 relationships
def _rel_name() -> Column:
    return F.concat(F.lit("'"), F.col("FromTable"), F.lit("'["), F.col("FromColumn"), F.lit("] -> '"),
                    F.col("ToTable"), F.lit("'["), F.col("ToColumn"), F.lit("]"))


def _with_col_types(m) -> DataFrame:
    ct = m["columns"].select("ModelId", "TableName", "ColumnName", "DataType")
    r = m["relationships"]
    r = r.join(ct.select("ModelId", F.col("TableName").alias("FromTable"), F.col("ColumnName").alias("FromColumn"),
                         F.col("DataType").alias("FromType")), ["ModelId", "FromTable", "FromColumn"], "left")
    return r.join(ct.select("ModelId", F.col("TableName").alias("ToTable"), F.col("ColumnName").alias("ToColumn"),
                            F.col("DataType").alias("ToType")), ["ModelId", "ToTable", "ToColumn"], "left")


def r24(m):
    r = _with_col_types(m)
    return _out(r.filter(~F.col("FromType").eqNullSafe(F.col("ToType"))), 24, "Relationship", "FromTable", _rel_name())


def r55(m):
    r = _with_col_types(m)
    return _out(r.filter(~F.col("FromType").eqNullSafe(F.lit("Int64")) | ~F.col("ToType").eqNullSafe(F.lit("Int64"))),
                55, "Relationship", "FromTable", _rel_name())


# one USERELATIONSHIP( 'From'[Col] , 'To'[Col] ) reference: table and column of both ends
USEREL_PATTERN = r"(?i)USERELATIONSHIP\s*\(\s*'*([^'\[]*?)'*\[([^\]]+)\]\s*,\s*'*([^'\[]*?)'*\[([^\]]+)\]"


def _userelationship_refs(m) -> DataFrame:
    """(ModelId, from table, from column, to table, to column) of every
    USERELATIONSHIP call in any measure, lower-cased.  Extracted once per
    measure and then equi-joined - never a measure x relationship pairing."""
    ms = m["measures"].select("ModelId", _s("Expression").alias("_e"))
    calls = ms.select("ModelId", F.explode(F.regexp_extract_all("_e", F.lit(USEREL_PATTERN), 0)).alias("_call"))
    grp = lambda i: F.lower(F.trim(F.regexp_extract("_call", USEREL_PATTERN, i)))
    return calls.select("ModelId", grp(1).alias("_ft"), grp(2).alias("_fc"), grp(3).alias("_tt"), grp(4).alias("_tc")).distinct()


def r40(m):
    r = m["relationships"].filter(~_b("IsActive"))
    keyed = r.withColumns({"_ft": F.lower("FromTable"), "_fc": F.lower("FromColumn"),
                           "_tt": F.lower("ToTable"), "_tc": F.lower("ToColumn")})
    unused = keyed.join(_userelationship_refs(m), ["ModelId", "_ft", "_fc", "_tt", "_tc"], "left_anti")
    return _out(unused, 40, "Relationship", "FromTable", _rel_name())


# ---------------------------------------------------------------------------- B4 RLS


# ---------------------------------------------------------------------------- B5 tables
def _tables_rel_flags(m) -> DataFrame:
    ends = _rel_ends(m)
    f = ends.groupBy("ModelId", "TableName").agg(
        F.max(F.when(F.col("End") == "From", 1).otherwise(0)).alias("_from"),
        F.max(F.when(F.col("End") == "To", 1).otherwise(0)).alias("_to"),
        F.max(F.when((F.col("End") == "To") & (F.col("Cardinality") == "One"), 1).otherwise(0)).alias("_to_one"))
    return m["tables"].join(f, ["ModelId", "TableName"], "left")


def _rls_tables(m) -> DataFrame:
    return m["rls"].select("ModelId", "TableName").distinct()


def r5(m):
    m2m_tabs = (m["relationships"].filter(_m2m(m["relationships"]))
                .select("ModelId", F.explode(F.array("FromTable", "ToTable")).alias("TableName")).distinct())
    t = m["tables"].join(m2m_tabs, ["ModelId", "TableName"], "left_semi").join(_rls_tables(m), ["ModelId", "TableName"], "left_semi")
    return _out(t, 5, "Table", "TableName", "TableName")


def _hybrid_tables(m) -> DataFrame:
    p = m["partitions"]
    return (p.groupBy("ModelId", "TableName")
            .agg(F.max(F.when(F.col("Mode") == "Import", 1).otherwise(0)).alias("_imp"),
                 F.max(F.when(F.col("Mode") == "DirectQuery", 1).otherwise(0)).alias("_dq"))
            .filter((F.col("_imp") == 1) & (F.col("_dq") == 1)).select("ModelId", "TableName"))


def r8(m):
    p = m["partitions"].join(_hybrid_tables(m), ["ModelId", "TableName"], "left_semi")
    p = p.filter((F.col("Mode") == "DirectQuery") & (F.length(_s("DataCoverageDefinition")) == 0))
    return _out(p, 8, "Partition", "TableName", "PartitionName")


def r10(m):
    p = m["partitions"].groupBy("ModelId", "TableName").agg(
        F.count(F.lit(1)).alias("_n"), F.count(F.when(F.col("Mode") == "Import", 1)).alias("_imp"))
    has_hybrid = _hybrid_tables(m).select("ModelId").distinct()
    t = (_tables_rel_flags(m).join(p, ["ModelId", "TableName"])
         .join(has_hybrid, "ModelId", "left_semi")
         .filter((F.col("_n") == 1) & (F.col("_imp") == 1) & (F.coalesce("_to_one", F.lit(0)) == 1)))
    return _out(t, 10, "Table", "TableName", "TableName")


def r12(m):
    t = _tables_rel_flags(m).filter(~_b("IsCalculationGroup") & (F.coalesce("_from", F.lit(0)) == 1)
                                    & (F.coalesce("_to", F.lit(0)) == 1))
    return _out(t, 12, "Table", "TableName", "TableName")


def r20(m):
    p = m["partitions"].groupBy("ModelId", "TableName").agg(F.count(F.lit(1)).alias("_n"))
    t = (m["tables"].join(p, ["ModelId", "TableName"]).join(_direct_lake(m), "ModelId", "left")
         .filter(~F.coalesce(F.col("IsDirectLake"), F.lit(False)) & (F.col("_n") == 1)
                 & (F.col("RowCount") > LARGE_TABLE_ROWS)))
    return _out(t, 20, "Table", "TableName", "TableName")


def r27(m):
    # tables used as the second end of a USERELATIONSHIP call and secured by RLS
    used = _userelationship_refs(m).select("ModelId", F.col("_tt").alias("_t")).distinct()
    t = (m["tables"].join(_rls_tables(m), ["ModelId", "TableName"], "left_semi")
         .withColumn("_t", F.lower("TableName")).join(used, ["ModelId", "_t"], "left_semi"))
    return _out(t, 27, "Table", "TableName", "TableName")


def r43(m):
    t = _tables_rel_flags(m).filter((F.coalesce("_from", F.lit(0)) + F.coalesce("_to", F.lit(0)) == 0)
                                    & ~_b("IsCalculationGroup"))
    return _out(t, 43, "Table", "TableName", "TableName")


def r44(m):
    items = m["calc_items"].select("ModelId", "TableName").distinct()
    t = m["tables"].filter(_b("IsCalculationGroup")).join(items, ["ModelId", "TableName"], "left_anti")
    return _out(t, 44, "Table", "TableName", "TableName")


# ---------------------------------------------------------------------------- B6 partitions


# ---------------------------------------------------------------------------- B7 models
def r9(m):
    p = m["partitions"].groupBy("ModelId").agg(F.count(F.when(F.col("Mode") == "DirectQuery", 1)).alias("_dq"),
                                               F.count(F.when(F.col("Mode") == "Dual", 1)).alias("_dual"))
    return _out(p.filter((F.col("_dq") == 0) & (F.col("_dual") > 0)), 9, "Model", F.lit(None), "ModelId")


def r13(m):
    return _out(_direct_lake(m).filter(F.col("IsDirectLake") & F.col("UsesView")), 13, "Model", F.lit(None), "ModelId")


def r17(m):
    r = m["relationships"]
    g = r.groupBy("ModelId").agg((F.count(F.when(_bidi(r), 1)) + F.count(F.when(_m2m(r), 1))).alias("_bad"),
                                 F.count(F.lit(1)).alias("_n"))
    return _out(g.filter(F.col("_bad") / F.greatest(F.col("_n"), F.lit(1)) > 0.3), 17, "Model", F.lit(None), "ModelId")


def r22(m):
    t = m["tables"].select("ModelId", "TableName", _s("DataCategory").alias("_cat"))
    ok = (m["columns"].filter(_b("IsKey") & (F.col("DataType") == "DateTime"))
          .join(t, ["ModelId", "TableName"]).filter(F.col("_cat") == "Time").select("ModelId").distinct())
    return _out(m["models"].join(ok, "ModelId", "left_anti"), 22, "Model", F.lit(None), "ModelId")


# ---------------------------------------------------------------------------- B8 measure text


# ---------------------------------------------------------------------------- B9 measures vs measures
def r31(m):
    ms = m["measures"]
    names = ms.select("ModelId", F.concat(F.lit("["), F.col("MeasureName"), F.lit("]")).alias("Expression")).distinct()
    return _out(ms.join(names, ["ModelId", "Expression"], "left_semi"), 31, "Measure", "TableName", "MeasureName")


def r32(m):
    ms = m["measures"].withColumn("_norm", F.regexp_replace(_s("Expression"), r"\s+", ""))
    g = ms.groupBy("ModelId", "_norm").agg(F.count_distinct("MeasureName").alias("_names"))
    dup = ms.join(g.filter(F.col("_names") > 1), ["ModelId", "_norm"], "left_semi")
    return _out(dup, 32, "Measure", "TableName", "MeasureName")


def r42(m):
    refs = (m["dependencies"].filter(F.upper("ReferencedObjectType") == "MEASURE")
            .select("ModelId", F.col("ReferencedObject").alias("MeasureName")).distinct())
    ms = m["measures"].filter(_b("IsHidden")).join(refs, ["ModelId", "MeasureName"], "left_anti")
    return _out(ms, 42, "Measure", "TableName", "MeasureName")


def _measure_refs(m, ref_type: str) -> DataFrame:
    """(measure, referenced object) pairs of measures whose dependency rows
    reference objects of ``ref_type``, with the measure's expression."""
    d = (m["dependencies"].filter((F.upper("ObjectType") == "MEASURE") & (F.upper("ReferencedObjectType") == ref_type))
         .select("ModelId", "TableName", F.col("ObjectName").alias("MeasureName"), "ReferencedTable", "ReferencedObject")
         .distinct())
    ms = m["measures"].select("ModelId", "TableName", "MeasureName", _s("Expression").alias("_e"))
    return d.join(ms, ["ModelId", "TableName", "MeasureName"])


def r38(m):
    """A measure references a column (per its dependencies) with a bare
    ``[Column]`` that is not directly preceded by ``Table`` or ``'Table'``
    for any table of the model having a column of that name.

    Every occurrence of ``[Column]`` is located by position; for each
    distinct table-name length L of that column's tables, the L (and L + 2,
    quoted) characters before it are equi-joined with the model's (column,
    table) pairs.  An occurrence no candidate matches is bare.  Nothing is
    collected per group: rows grow with occurrences x distinct name lengths."""
    cols = m["columns"].select("ModelId", "TableName", "ColumnName").distinct()
    ref_cols = cols.select("ModelId", F.col("TableName").alias("ReferencedTable"), F.col("ColumnName").alias("ReferencedObject"))
    pairs = (_measure_refs(m, "COLUMN").join(ref_cols, ["ModelId", "ReferencedTable", "ReferencedObject"], "left_semi")
             .withColumn("_tok", F.concat(F.lit("["), F.col("ReferencedObject"), F.lit("]"))))
    key = ["ModelId", "TableName", "MeasureName", "ReferencedObject", "_p"]
    # positions of every '[' (split on a constant pattern: bracket i starts after
    # parts 0..i and i brackets), kept where the token starts
    parts = pairs.withColumn("_parts", F.split("_e", r"\[", -1))
    occ = parts.select("ModelId", "TableName", "MeasureName", "ReferencedObject", "_e", F.explode(F.expr(
        "filter(transform(sequence(0, greatest(size(_parts) - 2, 0)), i -> "
        "aggregate(slice(_parts, 1, i + 1), 0, (a, x) -> a + length(x)) + i + 1), "
        "p -> size(_parts) > 1 AND substr(_e, p, length(_tok)) = _tok)")).alias("_p"))
    # the referenced column exists, so every occurrence has at least one length
    lens = cols.select("ModelId", F.col("ColumnName").alias("ReferencedObject"), F.length("TableName").alias("_l")).distinct()
    quoted = F.expr("substr(_e, _p - _l - 2, _l + 2)")
    cand = occ.join(lens, ["ModelId", "ReferencedObject"]).select(*key, F.explode(F.array(
        F.when(F.col("_p") > F.col("_l"), F.expr("substr(_e, _p - _l, _l)")),
        F.when((F.col("_p") > F.col("_l") + 2) & quoted.startswith("'") & quoted.endswith("'"),
               F.expr("substr(_e, _p - _l - 1, _l)")))).alias("_t"))
    tabs = cols.select("ModelId", F.col("ColumnName").alias("ReferencedObject"), F.col("TableName").alias("_t"),
                       F.lit(True).alias("_hit"))
    per_occ = (cand.join(tabs, ["ModelId", "ReferencedObject", "_t"], "left").groupBy(*key)
               .agg(F.max(F.coalesce(F.col("_hit"), F.lit(False))).alias("_qualified")))
    bare = per_occ.filter(~F.col("_qualified")).select("ModelId", "TableName", "MeasureName")
    ms = m["measures"].join(bare, ["ModelId", "TableName", "MeasureName"], "left_semi")
    return _out(ms, 38, "Measure", "TableName", "MeasureName")


def r39(m):
    """A measure references another measure (per its dependencies, resolved
    by name in the model) as ``Table[Measure]`` or ``'Table'[Measure]`` with
    the referenced measure's own table."""
    target = m["measures"].select("ModelId", F.col("MeasureName").alias("ReferencedObject"), F.col("TableName").alias("_pt"))
    pairs = _measure_refs(m, "MEASURE").join(target, ["ModelId", "ReferencedObject"])
    ref = F.concat(F.lit("["), F.col("ReferencedObject"), F.lit("]"))
    hit = (F.instr("_e", F.concat(F.col("_pt"), ref)) > 0) | (F.instr("_e", F.concat(F.lit("'"), F.col("_pt"), F.lit("'"), ref)) > 0)
    hits = pairs.filter(hit).select("ModelId", "TableName", "MeasureName")
    ms = m["measures"].join(hits, ["ModelId", "TableName", "MeasureName"], "left_semi")
    return _out(ms, 39, "Measure", "TableName", "MeasureName")


# ---------------------------------------------------------------------------- B10 any object
def _named_objects(m) -> DataFrame:
    def part(df, kind, name_col):
        return df.select("ModelId", F.lit(kind).alias("_k"), "TableName", F.col(name_col).alias("_n"),
                         F.coalesce(_opt(df, "IsHidden", False, "boolean"), F.lit(False)).alias("_h"),
                         F.coalesce(_opt(df, "Description", ""), F.lit("")).alias("_d"))
    t = part(m["tables"], "Table", "TableName")
    c = part(m["columns"], "Column", "ColumnName")
    ms = part(m["measures"], "Measure", "MeasureName")
    p = m["partitions"].select("ModelId", F.lit("Partition").alias("_k"), "TableName", F.col("PartitionName").alias("_n"),
                               F.lit(False).alias("_h"), F.lit("").alias("_d"))
    h = m["hierarchies"].select("ModelId", F.lit("Hierarchy").alias("_k"), "TableName",
                                F.col("HierarchyName").alias("_n"), F.lit(False).alias("_h"),
                                F.lit("").alias("_d")).distinct()
    return t.unionByName(c).unionByName(ms).unionByName(p).unionByName(h)


# ---------------------------------------------------------------------------- per-row rules
def _frame(kind: str, m: dict) -> DataFrame:
    """The object table a per-row rule reads, with the helper columns its
    predicates use."""
    if kind == "columns":
        return _hidden(m["columns"], m["tables"])
    if kind == "measures":
        return m["measures"].withColumn("_e", _s("Expression"))
    if kind == "named":
        return _named_objects(m)
    return m[kind]


def _geo(c: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.lower(c).startswith(p) for p in GEO_PREFIXES])


_NOSPACE = lambda: F.regexp_replace(F.col("_e"), " ", "")
_RX = lambda pat: F.col("_e").rlike(pat)
_FMT = lambda: _s("FormatString")

# rule id -> (object kind, predicate); one pass per kind evaluates all of them
ROW_RULES: dict[int, tuple[str, Callable[[], Column]]] = {
    # B1 columns
    1: ("columns", lambda: F.col("DataType") == "Double"),
    2: ("columns", lambda: F.col("Type") == "Calculated"),
    16: ("columns", lambda: (F.col("Type") == "Calculated") & _s("Expression").rlike(r"(?i)related\s*\(")),
    25: ("columns", lambda: (F.col("Type") == "Data") & (F.length(_s("SourceColumn")) == 0)),
    46: ("columns", lambda: F.col("ColumnName").rlike("(?i)date") & (F.col("DataType") == "DateTime")
         & (_s("FormatString") != "mm/dd/yyyy")),
    47: ("columns", lambda: F.col("DataType").isin("Int64", "Decimal", "Double")
         & (_s("SummarizeBy") != "None") & ~F.col("ColHidden")),
    49: ("columns", lambda: (F.length(_s("DataCategory")) == 0) & _geo(F.col("ColumnName"))),
    54: ("columns", lambda: F.col("ColumnName").rlike("(?i)month") & ~F.col("ColumnName").rlike("(?i)months")
         & (F.col("DataType") == "String") & (F.length(_s("SortByColumn")) == 0)),
    56: ("columns", lambda: F.col("ColumnName").rlike("(?i)month") & (F.col("DataType") == "DateTime")
         & (_s("FormatString") != "MMMM yyyy")),
    57: ("columns", lambda: (F.lower("ColumnName").startswith("is") & (F.col("DataType") == "Int64") & ~F.col("ColHidden"))
         | (F.lower("ColumnName").endswith(" flag") & (F.col("DataType") != "String") & ~F.col("ColHidden"))),
    # B3 relationships
    3: ("relationships", lambda: _m2m(None) | _bidi(None)),
    6: ("relationships", lambda: _m2m(None) & _bidi(None)),
    # B4 row-level security
    4: ("rls", lambda: _s("FilterExpression").rlike(r"(?i)(USERPRINCIPALNAME\(\)|USERNAME\(\))")),
    21: ("rls", lambda: reduce(lambda a, b: a | b,
                               [F.lower(_s("FilterExpression")).contains(x) for x in RLS_HEAVY_FUNCTIONS])),
    # B5 tables
    15: ("tables", lambda: ~_b("IsFieldParameter") & _b("IsCalculated")),
    18: ("tables", lambda: _b("IsCalculated") & (F.col("TableName").startswith("DateTableTemplate_")
                                                 | F.col("TableName").startswith("LocalDateTable_"))),
    19: ("tables", lambda: F.col("TableName").rlike("(?i)(date|calendar)") & (_s("DataCategory") != "Time")),
    # B6 partitions
    11: ("partitions", lambda: (F.col("SourceType") == "M")
         & reduce(lambda a, b: a | b, [_s("Expression").contains(x) for x in PQ_HEAVY_STEPS])),
    # B8 measure text
    14: ("measures", lambda: _NOSPACE().startswith("0+") | _NOSPACE().endswith("+0")
         | _RX(r"(?i)DIVIDE\s*\(\s*[^,]+,\s*[^,]+,\s*0\s*\)") | _RX(r"(?i)IFERROR\s*\(\s*[^,]+,\s*0\s*\)")),
    28: ("measures", lambda: _RX(r"(?i)iferror\s*\(")),
    29: ("measures", lambda: _RX(r"(?i)intersect\s*\(")),
    30: ("measures", lambda: _RX(r"(?i)evaluateandlog\s*\(")),
    33: ("measures", lambda: _RX(r"(?i)DIVIDE\s*\((\s*.*?)\)\s*[+-]\s*1|\/\s*.*(?=[-+]\s*1)")),
    34: ("measures", lambda: _RX(r"(?i)[0-9]+\s*[-+]\s*[\(]*\s*SUM\s*\(\s*'*[A-Za-z0-9 _]+'*\s*\[[A-Za-z0-9 _]+\]\s*\)\s*/")
         | _RX(r"(?i)[0-9]+\s*[-+]\s*DIVIDE\s*\(")),
    35: ("measures", lambda: _RX(r"(?i)CALCULATE\s*\(\s*[^,]+,\s*FILTER\s*\(\s*'*[A-Za-z0-9 _]+'*\s*,\s*\[[^\]]+\]")
         | _RX(r"(?i)CALCULATETABLE\s*\(\s*[^,]*,\s*FILTER\s*\(\s*'*[A-Za-z0-9 _]+'*\s*,\s*\[")),
    36: ("measures", lambda: _RX(r"(?i)CALCULATE\s*\(\s*[^,]+,\s*FILTER\s*\(\s*'*[A-Za-z0-9 _]+'*\s*,\s*'*[A-Za-z0-9 _]+'*\[[A-Za-z0-9 _]+\]")
         | _RX(r"(?i)CALCULATETABLE\s*\([^,]*,\s*FILTER\s*\(\s*'*[A-Za-z0-9 _]+'*\s*,\s*'*[A-Za-z0-9 _]+'*\[[A-Za-z0-9 _]+\]")),
    # the source pattern joins two alternatives with a stray '" or "'; these are the two intended ones
    37: ("measures", lambda: _RX(r"\]\s*\/(?!\/)(?!\*)") | _RX(r"\)\s*\/(?!\/)(?!\*)")),
    48: ("measures", lambda: ~_b("IsHidden") & (F.length(_FMT()) == 0)),
    50: ("measures", lambda: _FMT().contains("%") & (_FMT() != "#,0.0%;-#,0.0%;#,0.0%")),
    51: ("measures", lambda: ~_FMT().contains("$") & ~_FMT().contains("%") & ~_FMT().isin("#,0", "#,0.0")),
    # B10 any object
    23: ("calc_items", lambda: F.length(_s("Expression")) == 0),
    45: ("named", lambda: F.col("_k").isin("Column", "Measure", "Table") & ~F.col("_h") & (F.length("_d") == 0)),
    58: ("named", lambda: F.col("_n").startswith(" ") | F.col("_n").endswith(" ")),
    59: ("named", lambda: F.substr(F.col("_n"), F.lit(1), F.lit(1)) != F.upper(F.substr(F.col("_n"), F.lit(1), F.lit(1)))),
    60: ("named", lambda: F.col("_n").rlike("[\t\r\n]")),
}

# how each kind names its objects: (ObjectType, table column, object name column)
_OUTPUT = {
    "columns": (lambda: F.lit("Column"), "TableName", lambda: F.col("ColumnName")),
    "measures": (lambda: F.lit("Measure"), "TableName", lambda: F.col("MeasureName")),
    "rls": (lambda: F.lit("Row Level Security"), "TableName", lambda: F.col("RoleName")),
    "partitions": (lambda: F.lit("Partition"), "TableName", lambda: F.col("PartitionName")),
    "tables": (lambda: F.lit("Table"), "TableName", lambda: F.col("TableName")),
    "relationships": (lambda: F.lit("Relationship"), "FromTable", _rel_name),
    "calc_items": (lambda: F.lit("Calculation Item"), "TableName", lambda: F.col("ItemName")),
    "named": (lambda: F.col("_k"), "TableName", lambda: F.col("_n")),
}


def _row_pass(meta: dict, kind: str, ids: list[int]) -> DataFrame:
    """All per-row rules of one object kind in a single scan: an array of
    the ids whose predicate holds, exploded to one row per violation."""
    df = _frame(kind, meta)
    flags = F.array(*[F.when(ROW_RULES[i][1](), F.lit(i)) for i in ids])
    obj_type, table_col, name = _OUTPUT[kind]
    # explode the flag array and drop the nulls: stays in generated code
    # (a lambda filter over the array would not)
    return (df.select("ModelId", F.explode(flags).alias("RuleId"), obj_type().alias("ObjectType"),
                      F.col(table_col).cast("string").alias("TableName"), name().cast("string").alias("ObjectName"))
            .filter(F.col("RuleId").isNotNull()))


RULES: dict[int, Callable[[dict], DataFrame]] = {
    **{i: (lambda m, i=i: _row_pass(m, ROW_RULES[i][0], [i])) for i in ROW_RULES},
    **{int(n[1:]): fn for n, fn in globals().items() if n.startswith("r") and n[1:].isdigit() and callable(fn)}}


def bpa(meta: dict[str, DataFrame], rules: list[int] | None = None) -> DataFrame:
    """Run the selected rules (default: every built rule) over all models.

    Returns ``(ModelId, RuleId, ObjectType, TableName, ObjectName)``; join
    with :func:`rule_catalogue` for category, severity and impact."""
    ids = sorted(rules or RULES)
    uses = _Uses(meta)
    _parts(uses, ids)
    # a table that several rules read is written once, unless it doesn't come from files
    again = {k: materialize(meta[k], f"meta-{k}") for k, n in uses.n.items() if n > 1 and meta[k].inputFiles()}
    return reduce(lambda a, b: a.unionByName(b), _parts({**meta, **again}, ids))


class _Uses(dict):
    """The metadata tables, counting how often each is asked for."""

    def __init__(self, meta: dict[str, DataFrame]):
        super().__init__(meta)
        self.n: dict[str, int] = {}

    def __getitem__(self, key: str) -> DataFrame:
        self.n[key] = self.n.get(key, 0) + 1
        return super().__getitem__(key)


def _parts(meta: dict[str, DataFrame], ids: list[int]) -> list[DataFrame]:
    by_kind: dict[str, list[int]] = {}
    for i in ids:
        if i in ROW_RULES:
            by_kind.setdefault(ROW_RULES[i][0], []).append(i)
    parts = [_row_pass(meta, kind, kind_ids) for kind, kind_ids in by_kind.items()]
    return parts + [RULES[i](meta) for i in ids if i not in ROW_RULES]


def violation_counts(violations: DataFrame, catalogue: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A5 over rule results: violations by severity and by impact area."""
    j = violations.join(F.broadcast(catalogue), "RuleId")
    return j.groupBy(*(by or ["ModelId"])).agg(
        F.count(F.lit(1)).alias("violations"),
        *[F.count(F.when(F.col("Severity") == s, 1)).alias(f"severity_{s.lower()}") for s in ("Error", "Warning", "Info")],
        *[F.count(F.when(F.col("ImpactArea") == a, 1)).alias(a.lower().replace(" ", "_"))
          for a in ("Query Operation", "Background Operation", "Usability")])

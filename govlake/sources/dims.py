"""Dimension builders: static lookup tables (S8), calendars (S9, S10),
time-point dimension (S11) and the entity x day spine (S12)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------
# Capacity regions (Continent, Region, Latitude, Longitude, Location).
CAPACITY_REGIONS = [
    ("Asia Pacific", "Australia East", 31.2532, 146.9211, "New South Wales"),
    ("Asia Pacific", "Australia Southeast", 36.9848, 143.3906, "Victoria"),
    ("Asia Pacific", "Central India", 18.5204, 73.8567, "Pune"),
    ("Asia Pacific", "East Asia", 22.3193, 114.1694, "Hong Kong"),
    ("Asia Pacific", "Japan East", 35.6764, 139.65, "Tokyo"),
    ("Asia Pacific", "Korea Central", 37.5519, 126.9918, "Seoul"),
    ("Asia Pacific", "Southeast Asia", 1.3521, 103.8198, "Singapore"),
    ("Asia Pacific", "South India", 13.0827, 80.2707, "Chennai"),
    ("Europe", "North Europe", 53.7798, 7.3055, "Ireland"),
    ("Europe", "West Europe", 52.1326, 5.2913, "Netherlands"),
    ("Europe", "France Central", 48.8566, 2.3522, "Paris"),
    ("Europe", "Germany West Central", 50.1109, 8.6821, "Frankfurt am Main"),
    ("Europe", "Norway East", 59.9139, 10.7522, "Oslo"),
    ("Europe", "Sweden Central", 60.6749, 17.1413, "Gävle"),
    ("Europe", "Switzerland North", 47.3769, 8.5417, "Zürich"),
    ("Europe", "Switzerland West", 46.2044, 6.1432, "Geneva"),
    ("Europe", "UK South", 51.5072, -0.1276, "London"),
    ("Europe", "UK West", 51.4837, -3.1681, "Cardiff"),
    ("Americas", "Brazil South", -23.5558, -46.6396, "São Paulo State"),
    ("Americas", "Canada Central", 43.6532, -79.3832, "Toronto"),
    ("Americas", "Canada East", 46.8131, -71.2075, "Quebec City"),
    ("Americas", "East US", 37.4316, -78.6569, "Virginia"),
    ("Americas", "East US 2", 37.4316, -78.6569, "Virginia"),
    ("Americas", "North Central US", 40.6331, -89.3985, "Illinois"),
    ("Americas", "South Central US", 31.9686, -99.9018, "Texas"),
    ("Americas", "West US", 36.7783, -119.4179, "California"),
    ("Americas", "West US 2", 47.7511, -120.7401, "Washington"),
    ("Americas", "West US 3", 34.0489, -111.0937, "Arizona"),
    ("Middle East and Africa", "South Africa North", -26.2056, 28.0337, "Johannesburg"),
    ("Middle East and Africa", "UAE North", 25.2048, 55.2708, "Dubai"),
]
# Semantic model content provider types
# (ContentProviderType, MappedName, IsIncludedInOptimizationModule, IsDefaultSemanticModel).
CONTENT_PROVIDER_TYPES = [
    ("InCompositeMode", "Composite Mode", False, True),
    ("InDirectQueryMode", "DirectQuery Mode", False, True),
    ("InImportMode", "Import Mode", False, True),
    ("PbixInCompositeMode", "Composite Mode", True, False),
    ("PbixInDirectQueryMode", "DirectQuery Mode", True, False),
    ("PbixInImportMode", "Import Mode", True, False),
    ("PbixInLiveConnectionMode", "Live Connection Mode", False, False),
    ("RealTimeInPushMode", "Push Mode", False, False),
    ("RealTimeInStreamingMode", "Streaming Mode", False, False),
    ("Unknown", "Semantic Model in App", False, False),
    ("UsageMetricsUserReport", "Usage Metrics", False, False),
    ("UsageMetricsUserDashboard", "Usage Metrics", False, False),
    ("CSV", "CSV", False, False),
    ("Excel", "Excel", False, False),
]
# Size units (UnitKey, Unit, UnitValue).
SIZE_UNIT_ROWS = [(1, "bytes", 1), (2, "kilobytes", 1024), (3, "megabytes", 1048576), (4, "gigabytes", 1073741824)]
# Time units (UnitKey, Unit, UnitValue in milliseconds).
TIME_UNIT_ROWS = [(1, "milliseconds", 1), (2, "seconds", 1000), (3, "minutes", 60000), (4, "hours", 3600000)]
# Partition mode enum (Enum, Name).
PARTITION_MODE_ENUM = [(0, "Import"), (1, "DirectQuery"), (2, "Default"), (3, "Push"), (4, "Dual"), (5, "DirectLake")]
# The other enum tables of the model's metadata (Enum, Name).
STATE_ENUM = [(1, "Ready"), (3, "NoData"), (4, "CalculationNeeded"), (5, "SemanticError"), (6, "EvaluationError"), (7, "DependencyError"), (8, "Incomplete"), (9, "SyntaxError")]
ENCODING_HINT_ENUM = [(0, "Default"), (1, "Hash"), (2, "Value")]
ENUMS = {
    "cardinality": [(1, "One"), (2, "Many")],
    "column_alignment": [(1, "Default"), (2, "Left"), (3, "Right"), (4, "Center")],
    "column_encoding": ENCODING_HINT_ENUM,
    "column_encoding_hint": ENCODING_HINT_ENUM,
    "column_summarize_by": [(1, "Default"), (2, "None"), (3, "Sum"), (4, "Min"), (5, "Max"), (6, "Count"), (7, "Average"), (8, "DistinctCount")],
    "column_type": [(1, "Data"), (2, "Calculated"), (3, "RowNumber"), (4, "CalculatedTableColumn")],
    "cross_filtering_behavior": [(1, "OneDirection"), (2, "BothDirection"), (3, "Automatic")],
    "data_source_impersonation_mode": [(2, "ImpersonateAccount"), (3, "ImpersonateAnonymous"), (4, "ImpersonateCurrentUser"), (5, "ImpersonateServiceAccount"),
                                       (6, "ImpersonateUnattendedAccount")],
    "data_source_isolation": [(1, "ReadCommited"), (2, "Snapshot")],
    "data_source_type": [(1, "Provider"), (2, "Structured")],
    "data_type": [(1, "Automatic"), (2, "String"), (6, "Int64"), (8, "Double"), (9, "DateTime"), (10, "Decimal"), (11, "Boolean"), (17, "Binary"), (19, "Unknown")],
    "join_on_date_behavior": [(1, "DateAndTime"), (2, "DatePartOnly")],
    "partition_type": [(1, "Query"), (2, "Calculated"), (3, "None"), (4, "M"), (5, "Entity"), (7, "CalculationGroup")],
    "relationship_type": [(1, "SingleColumn")],
    "security_filtering_behavior": [(1, "OneDirection"), (2, "BothDirection"), (3, "None")],
    "state": STATE_ENUM,
    "state_column": STATE_ENUM,
}
# --------------------------------------------------------------------------


def enum_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """Every enum table as (Enum, Name), the partition modes among them."""
    return {n: spark.createDataFrame(rows, "Enum int, Name string") for n, rows in (ENUMS | {"partition_mode": PARTITION_MODE_ENUM}).items()}


def enum_names(df: DataFrame, codes: dict[str, str], suffix: str = "_name") -> DataFrame:
    """``df`` with the name beside each code column (column -> enum), all in one projection without a join;
    an unknown code keeps its value as text, as the lookup in the table does."""
    known = ENUMS | {"partition_mode": PARTITION_MODE_ENUM}

    def name(column: str, enum: str) -> Column:
        pairs = F.create_map(*[x for code, text in known[enum] for x in (F.lit(code).cast("long"), F.lit(text))])
        return F.coalesce(F.try_element_at(pairs, F.col(column).cast("long")), F.col(column).cast("string"))

    return df.withColumns({f"{c}{suffix}": name(c, enum) for c, enum in codes.items()})


def static_dims(spark: SparkSession) -> dict[str, DataFrame]:
    """The small constant lookup tables, as DataFrames.

    They are fixed-size (at most a few dozen rows) and carry a broadcast
    hint: a local DataFrame has no size statistics, so without the hint the
    planner would shuffle the large side to join them."""
    return {k: F.broadcast(v) for k, v in _static_dims(spark).items()}


def _static_dims(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        "capacity_regions": spark.createDataFrame(
            CAPACITY_REGIONS, "Continent string, Region string, Latitude double, Longitude double, Location string"),
        "semantic_model_content_types": spark.createDataFrame(
            CONTENT_PROVIDER_TYPES,
            "ContentProviderType string, MappedName string, IsIncludedInOptimizationModule boolean, IsDefaultSemanticModel boolean"),
        "size_units": spark.createDataFrame(SIZE_UNIT_ROWS, "UnitKey int, Unit string, UnitValue long"),
        "time_units": spark.createDataFrame(TIME_UNIT_ROWS, "UnitKey int, Unit string, UnitValue long"),
        "partition_mode_enum": spark.createDataFrame(PARTITION_MODE_ENUM, "Enum int, Name string"),
    }


def _d(x) -> Column:
    if isinstance(x, (dt.date, dt.datetime)):
        return F.lit(x.isoformat()[:10]).cast("date")
    if isinstance(x, str):
        return F.lit(x).cast("date")
    return x


def calendar_columns(date: Column, today) -> list[Column]:
    """Calendar attributes and relative flags of ``date`` given ``today``."""
    t = _d(today)
    flag = lambda cond: F.when(cond, 1).otherwise(0)
    return [
        F.date_format(date, "yyyyMMdd").alias("DateKey"),
        F.date_format(date, "yyyy-MM-dd").alias("Date"),
        date.alias("Date2Key"),
        F.year(date).alias("Year"),
        F.month(date).alias("Month"),
        F.dayofmonth(date).alias("Day"),
        F.weekofyear(date).alias("WeekOfYear"),
        F.date_format(date, "yyyy-MM").alias("YearMonth"),
        F.date_format(date, "E").alias("DayOfWeek"),
        F.dayofweek(date).alias("DayOfWeekNum"),
        flag(F.year(date) == F.year(t)).alias("IsCurrentYear"),
        flag(F.year(date) == F.year(t) - 1).alias("IsPreviousYear"),
        flag((F.year(date) == F.year(t)) & (F.quarter(date) == F.quarter(t))).alias("IsCurrentQuarter"),
        flag((F.year(date) == F.year(t)) & (F.month(date) == F.month(t))).alias("IsCurrentMonth"),
        flag(F.date_format(date, "yyyy-MM") == F.date_format(F.add_months(t, -1), "yyyy-MM")).alias("IsPreviousMonth"),
        flag(date.between(F.date_add(t, -14), t)).alias("IsInLast14Days"),
        flag(date.between(F.date_add(t, -30), t)).alias("IsInLast30Days"),
    ]


def calendar(spark: SparkSession, begin, end, today) -> DataFrame:
    """One row per day from ``begin`` to ``end`` (both inclusive).

    The day list is generated on executors (``sequence`` exploded inside
    ``range`` partitions), so a long calendar is never a driver-side list.
    ``today`` is an argument so results are reproducible.
    """
    days = (spark.range(1).select(F.explode(F.sequence(_d(begin), _d(end), F.expr("interval 1 day"))).alias("date")))
    return days.select(*calendar_columns(F.col("date"), today))


def calendar_of(df: DataFrame, col: str) -> DataFrame:
    """Calendar spanning the min..max date of a fact column: Date, Year,
    Month, Year-Month, weekday number (Monday=1) and weekday name."""
    bounds = df.agg(F.min(F.to_date(col)).alias("lo"), F.max(F.to_date(col)).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("Date"))
    return days.select(
        "Date",
        F.year("Date").alias("Year"),
        F.month("Date").alias("Month"),
        F.date_format("Date", "yyyy-MM").alias("YearMonth"),
        ((F.dayofweek("Date") + 5) % 7 + 1).alias("WeekdayNum"),
        F.date_format("Date", "EEEE").alias("WeekdayName"),
    )


def timepoint_dim(df: DataFrame, col: str = "TimePoint") -> DataFrame:
    """Distinct time points with their date and hour (truncated)."""
    tp = F.col(col)
    return (df.select(tp.alias("TimePoint")).distinct()
            .select("TimePoint", F.to_date("TimePoint").alias("Date"),
                    F.date_trunc("hour", F.col("TimePoint")).alias("Hour")))


def day_spine(entities: DataFrame, start, end, date_col: str = "Date") -> DataFrame:
    """One row per (entity row, day) for ``start``..``end`` inclusive.

    Each entity row carries the day sequence and is exploded in place - no
    cross join, no shuffle; the output is entities x days by construction.
    """
    return entities.withColumn(date_col, F.explode(F.sequence(_d(start), _d(end), F.expr("interval 1 day"))))

"""Facts of different grain met by one key.

Each fact is aggregated by the key on its own, and the aggregates are laid one
under another and aggregated once more: a key has one row a fact there, so no
fact multiplies another's rows, and one small shuffle replaces a join a fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blank import blank0, ddivide
from .measures import exact_avg, exact_median

#: Units of a size, in bytes.
UNITS = {"bytes": 1, "kilobytes": 1 << 10, "megabytes": 1 << 20, "gigabytes": 1 << 30}


def drill_across(facts: list[tuple[DataFrame, dict[str, Column]]], key: str) -> DataFrame:
    """The aggregates of all facts by ``key``; null where a fact has no row for it.  Null is a key like others."""
    names = [n for _, aggs in facts for n in aggs]
    met = None
    for df, aggs in facts:
        one = df.groupBy(key).agg(*[a.alias(n) for n, a in aggs.items()])
        met = one if met is None else met.unionByName(one, allowMissingColumns=True)
    return met.groupBy(key).agg(*[F.max(n).alias(n) for n in names])


def _sizes(unit: str) -> dict[str, Column]:
    """The sizes of storage segments by the kind that their table id names: ``H$`` hierarchies, ``U$`` user
    hierarchies, ``R$`` relationships, no ``$`` in the second place data."""
    kind = F.substring("TABLE_ID", 1, 2)
    size = lambda c: F.sum(F.when(c, F.col("USED_SIZE"))) / float(UNITS[unit])
    return {"SumSegmentUsedSize": size(F.substring("TABLE_ID", 2, 1) != "$"), "SumSegmentHierarchySize": size((kind == "H$") & (F.col("SEGMENT_NUMBER") == 0)),
            "SumUserHierarchySize": size(kind == "U$"), "SumRelationshipSize": size(kind == "R$")}


def table_statistics(tables: DataFrame, columns: DataFrame, segment_maps: DataFrame, column_storages: DataFrame, storage_columns: DataFrame,
                     segments: DataFrame, key: str = "TableId", name: str = "TableName", unit: str = "megabytes") -> DataFrame:
    """Per table its columns, records, distinct states, dictionary, data and hierarchy sizes, total size,
    the total's share of all given tables, and a caption.

    ``columns(key)``, ``segment_maps(key, RecordCount)``, ``column_storages(key,
    DistinctStates)``, ``storage_columns(key, DATATYPE, COLUMN_TYPE,
    DICTIONARY_SIZE)`` without the data type N/A, ``segments(key, TABLE_ID,
    SEGMENT_NUMBER, USED_SIZE)``.  Tables without any fact are left out.  The
    share's total is a scalar subquery over the tables that were given.
    """
    scale = float(UNITS[unit])
    basic = storage_columns.where((F.col("DATATYPE") != "N/A") & (F.col("COLUMN_TYPE") == "BASIC_DATA"))
    met = drill_across([
        (columns, {"CountColumns": F.count(F.lit(1))}),
        (segment_maps, {"CountSegmentRecords": F.sum("RecordCount")}),
        (column_storages, {"SumDistinctCounts": F.sum("DistinctStates")}),
        (basic, {"SumDictionarySize": F.sum("DICTIONARY_SIZE") / scale}),
        (segments, _sizes(unit)),
    ], key)
    sizes = ["SumSegmentUsedSize", "SumDictionarySize", "SumSegmentHierarchySize", "SumUserHierarchySize", "SumRelationshipSize"]
    total = sum((blank0(F.col(c)) for c in sizes[1:]), blank0(F.col(sizes[0])))
    total = F.when(F.coalesce(*sizes).isNotNull(), total)
    out = tables.select(key, name).join(met, key).withColumn("SumSize", total)
    out = out.withColumn("SumSizeRatio", ddivide(F.col("SumSize"), out.select(F.sum("SumSize")).scalar()))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    caption = F.concat(text(name), F.lit(" | Col: "), text("CountColumns"), F.lit(" | Sum Size: "), F.coalesce(F.round("SumSize", 2).cast("string"), F.lit("")),
                       F.lit(" MB | Rows: "), text("CountSegmentRecords"))
    return out.select(key, name, "CountColumns", "CountSegmentRecords", "SumDistinctCounts", "SumDictionarySize", "SumSegmentUsedSize",
                      "SumSegmentHierarchySize", "SumSize", "SumSizeRatio", caption.alias("TableStatisticName"))


def partition_statistics(segment_maps: DataFrame, partitions: DataFrame, segments: DataFrame, storage_columns: DataFrame, column_storages: DataFrame,
                         key: str = "TableId", unit: str = "megabytes") -> DataFrame:
    """Rows a partition (average, median, least, most), segment records, partition sizes (sum, average,
    median, average in bytes), cardinality, and the average temperatures of segments and dictionaries.

    ``segment_maps(key, RecordCount)``, ``partitions(key, DataSize)`` in bytes,
    ``segments(key, TEMPERATURE)``, ``storage_columns(key,
    DICTIONARY_TEMPERATURE)`` (temperatures of two places), ``column_storages(key,
    DistinctStates)``.  Medians are exact without a group in one task.
    """
    scale = float(UNITS[unit])
    rows, size = F.col("RecordCount"), F.col("DataSize")
    facts = [
        (segment_maps, {"AvgRowsByPartition": exact_avg(rows, 0), "MinRowsByPartition": F.min(rows), "MaxRowsByPartition": F.max(rows), "SegmentRecords": F.sum(rows)}),
        (partitions, {"SumDataSizeByPartition": F.sum(size) / scale, "AvgDataSizeByPartition": exact_avg(size, 0) / scale, "AvgDataSizeByPartitionBytes": exact_avg(size, 0)}),
        (column_storages, {"Cardinality": F.sum("DistinctStates")}),
        (segments, {"AvgSegmentTemperature": exact_avg(F.col("TEMPERATURE"), 2)}),
        (storage_columns, {"AvgDictionaryTemperature": exact_avg(F.col("DICTIONARY_TEMPERATURE"), 2)}),
        (exact_median(segment_maps, "RecordCount", [key], "m"), {"MedianRowsByPartition": F.max("m")}),
        (exact_median(partitions, "DataSize", [key], "m"), {"MedianDataSizeByPartition": F.max("m") / scale}),
    ]
    return drill_across(facts, key)

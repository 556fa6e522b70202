"""Projection and flattening operators.

All are narrow transformations (no shuffle) except :func:`dedupe`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DateType, DoubleType, FloatType,
                               IntegerType, LongType, StringType, StructType)

from ..functions.scalar import ZERO_GUID, EMPTY_END_DATE

_SIMPLE = (DateType, StringType, BooleanType, LongType, IntegerType, DoubleType, FloatType)


def stringify_complex(df: DataFrame) -> DataFrame:
    """Keep date/string/boolean/long/int/double/float columns, cast every
    other column (struct, array, map, timestamp, decimal, ...) to string."""
    return df.select(*[F.col(f"`{f.name}`") if isinstance(f.dataType, _SIMPLE)
                       else F.col(f"`{f.name}`").cast("string").alias(f.name)
                       for f in df.schema.fields])


def upper_keys(df: DataFrame, cols) -> DataFrame:
    """Upper-case those of ``cols`` that exist in ``df``."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.upper(F.col(c)) for c in present}) if present else df


def project(df: DataFrame, mapping: dict[str, str], defaults: dict | None = None) -> DataFrame:
    """Select ``source -> target`` columns; absent sources take their default
    (``defaults[target]``, else null)."""
    defaults = defaults or {}
    have = set(df.columns)
    out = []
    for src, dst in mapping.items():
        top = src.split(".")[0]
        if top in have and _has_path(df.schema, src):
            out.append(F.col(src).alias(dst))
        else:
            out.append(F.lit(defaults.get(dst)).alias(dst))
    return df.select(*out)


def _has_path(schema: StructType, path: str) -> bool:
    t = schema
    for part in path.split("."):
        if not isinstance(t, StructType) or part not in t.fieldNames():
            return False
        t = t[part].dataType
    return True


def promote(df: DataFrame, struct: str, fields: list[str] | None = None, prefix: str = "",
            drop: bool = True) -> DataFrame:
    """Lift fields of a struct column to top-level columns named
    ``<prefix><field>``; the struct is dropped.  Nested paths such as
    ``userDetails.userPrincipalName`` become ``<prefix>userPrincipalName``."""
    if struct not in df.columns:
        return df
    st = df.schema[struct].dataType
    names = fields or list(st.fieldNames())
    cols = []
    for f in names:
        leaf = f.split(".")[-1]
        cols.append((F.col(f"{struct}.{f}") if _has_path(st, f) else F.lit(None).cast("string")).alias(prefix + leaf))
    base = [F.col(f"`{c}`") for c in df.columns if not (drop and c == struct)]
    return df.select(*base, *cols)


def _flatten_struct_cols(schema: StructType, prefix: str = "") -> list[Column]:
    cols = []
    for f in schema.fields:
        name = prefix + f.name
        if isinstance(f.dataType, StructType):
            cols.extend(_flatten_struct_cols(f.dataType, name + "."))
        else:
            cols.append(F.col(".".join(f"`{p}`" for p in name.split("."))).alias(name))
    return cols


def flatten_structs(df: DataFrame) -> DataFrame:
    """Flatten nested structs to dotted column names (``a.b.c``)."""
    return df.select(*_flatten_struct_cols(df.schema))


def child_table(df: DataFrame, parent_id: str, array_col: str, rename_id: str | None = None,
                parent_alias: str | None = None, id_col: str = "id") -> DataFrame:
    """One row per element of ``array_col``, tagged with its parent id.

    Structs are flattened to dotted names; rows with a null ``id`` are
    dropped (when the element has no id, rows whose fields are all null are
    dropped).  A missing array field gives an empty result.
    """
    alias = parent_alias or parent_id
    if not _has_path(df.schema, array_col):
        return df.select(F.col(parent_id).alias(alias)).limit(0)
    arr_t = df.schema
    for p in array_col.split("."):
        arr_t = arr_t[p].dataType
    exploded = df.select(F.col(parent_id).alias(alias), F.explode_outer(F.col(array_col)).alias("_e"))
    el = arr_t.elementType if isinstance(arr_t, ArrayType) else arr_t
    if isinstance(el, StructType):
        flat = exploded.select(alias, *[c for c in _flatten_struct_cols(el, "_e.")])
        flat = flat.toDF(alias, *[c[3:] for c in flat.columns[1:]])
        fields = flat.columns[1:]
        if id_col in fields:
            flat = flat.filter(F.col(f"`{id_col}`").isNotNull())
        else:
            flat = flat.filter(F.coalesce(*[F.col(f"`{c}`").cast("string") for c in fields]).isNotNull())
        if rename_id and id_col in fields:
            flat = flat.withColumnRenamed(id_col, rename_id)
        return flat
    return exploded.filter(F.col("_e").isNotNull()).withColumnRenamed("_e", rename_id or "value")


def dedupe(df: DataFrame, cols: list[str] | None = None, order: list[str] | None = None,
           desc: bool = False) -> DataFrame:
    """Whole-row distinct, or one row per key.

    On keys the kept row is fixed - the row with the least (or, with
    ``desc``, greatest) ``order`` columns, ties broken by the remaining
    columns - instead of whichever row arrives first.  It is computed with
    ``min``/``max_by`` over structs, a partial aggregate: a hot key sends
    one row per partition through the shuffle instead of all its rows into
    one window task.
    """
    if not cols:
        return df.distinct()
    rest = [c for c in df.columns if c not in cols]
    if not rest:
        return df.distinct()
    packed = F.struct(*[F.col(f"`{c}`") for c in rest])
    if order is None:
        agg = F.min(packed) if not desc else F.max(packed)
    else:
        key = F.struct(*[F.col(f"`{c}`") for c in order], packed)
        agg = F.max_by(packed, key) if desc else F.min_by(packed, key)
    return df.groupBy(*cols).agg(agg.alias("_k")).select(*cols, "_k.*").select(*df.columns)


def drop_sentinels(df: DataFrame, id_col: str | None = None, end_col: str | None = None,
                   start_col: str | None = None) -> DataFrame:
    """Drop rows with the all-zero GUID or a null id, an empty end date
    (0001-01-01) or a null start."""
    cond = F.lit(True)
    if id_col:
        cond = cond & F.col(id_col).isNotNull() & (F.col(id_col) != ZERO_GUID)
    if end_col:
        cond = cond & (F.coalesce(F.col(end_col).cast("string"), F.lit("")).substr(1, 10) != EMPTY_END_DATE)
    if start_col:
        cond = cond & F.col(start_col).isNotNull()
    return df.filter(cond)


def connection_string(df: DataFrame, type_col: str = "DatasourceType",
                      details_prefix: str = "connectionDetails.") -> DataFrame:
    """Data-source kind and connection string.

    kind = extension kind when the type is ``Extension``, else the type.
    The string joins the non-empty connection fields by a space: extension
    kind, url, server, database first, the others after in column order; a
    ``{"host":..,"httpPath":..}`` value is rewritten as ``host path``.
    """
    cols = [c for c in df.columns if details_prefix in c]
    first = ["extensionDataSourceKind", "url", "server", "database"]
    ordered = [c for o in first for c in cols if o in c]
    ordered += [c for c in cols if c not in ordered]
    ext = f"{details_prefix}extensionDataSourceKind"
    kind = (F.when(F.col(type_col) == "Extension", F.col(f"`{ext}`")) if ext in df.columns else F.lit(None))
    parts = [F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) for c in ordered]
    joined = F.concat_ws(" ", *parts) if parts else F.lit("")
    m = F.regexp_extract(joined, r'"host":"([^"]+)","httpPath":"([^"]+)"', 0)
    rewritten = F.when(m != "", F.concat_ws(" ", F.regexp_extract(joined, r'"host":"([^"]+)"', 1),
                                            F.regexp_replace(F.regexp_extract(joined, r'"httpPath":"([^"]+)"', 1),
                                                             r"\\/", "/"))).otherwise(joined)
    return df.withColumns({"DatasourceKind": F.when(F.col(type_col) == "Extension", kind).otherwise(F.col(type_col)),
                           "ConnectionString": rewritten})


def extract_all_rows(df: DataFrame, col: str, pattern: str, out: str = "match", group: int = 1) -> DataFrame:
    """One row per regex match of ``pattern`` in ``col`` (rows without a
    match are dropped, as an expand of an empty list is)."""
    return df.withColumn(out, F.explode(F.regexp_extract_all(F.col(col), F.lit(pattern), group)))


def anonymise(df: DataFrame, cols: list[str], date_col: str | None = None, after_days: int = 0,
              today=None, flag_col: str = "IsAnonymised") -> DataFrame:
    """md5 the ``cols``: all rows, or only rows older than ``after_days``.

    A guard flag records rows already hashed so a re-run does not hash a
    hash again (the unguarded version re-hashes old rows on every run).
    """
    done = F.coalesce(F.col(flag_col), F.lit(False)) if flag_col in df.columns else F.lit(False)
    if date_col and after_days > 0:
        cutoff = F.date_sub(F.lit(str(today)).cast("date") if today else F.current_date(), after_days)
        due = (F.col(date_col) < cutoff) & ~done
    else:
        due = ~done
    out = df.withColumns({c: F.when(due, F.md5(F.col(c).cast("string"))).otherwise(F.col(c)) for c in cols})
    return out.withColumn(flag_col, done | due)


def audit_row(spark, now, kind: str, obj: str, objects: str, reason: str, **extra) -> DataFrame:
    """One audit record describing an anonymisation run."""
    row = {"timestamp": now, "type": kind, "affected_object": obj, "affected_objects": objects,
           "reason": reason, **extra}
    return spark.createDataFrame([row])


def decode_enum(df: DataFrame, code_col: str, enum_df: DataFrame, out_col: str,
                enum_key: str = "Enum", enum_name: str = "Name") -> DataFrame:
    """Code -> name by lookup in a small enum table (broadcast: enum tables
    are fixed, a few dozen rows); unmatched codes keep their value as text."""
    e = F.broadcast(enum_df.select(F.col(enum_key).alias("_ek"), F.col(enum_name).alias("_en")))
    j = df.join(e, df[code_col] == e["_ek"], "left")
    return j.withColumn(out_col, F.coalesce(F.col("_en"), F.col(code_col).cast("string"))).drop("_ek", "_en")

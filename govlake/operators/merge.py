"""Incremental load and merge operators (M1-M8) without a table format.

Each operator returns the *new version* of the target as a DataFrame; the
caller writes it to a new folder (see :func:`commit_version`) instead of
overwriting the folder being read.  Merges are one full-outer (or anti)
join on the keys: a single shuffle of target and source by key, no
driver-side loops, and skewed keys are split by AQE's skew-join handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _lit_ts(now) -> Column:
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now
    return F.lit(str(now)).cast("timestamp")


def _lit_date(d) -> Column:
    if isinstance(d, Column):
        return d
    return F.lit(str(d)[:10]).cast("date")


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


# ---------------------------------------------------------------------------
# M1
def replace_since(existing: DataFrame, new: DataFrame, date_col: str) -> DataFrame:
    """High-water-mark replace.

    cut = min(min date of ``new``, max date of ``existing``); rows of
    ``existing`` at or after the cut are replaced by rows of ``new`` at or
    after the cut.  A feed without dates has no cut and changes nothing, and
    existing rows without a date stay; feed rows without one are not loaded.
    The cut is a scalar subquery evaluated once, so no row goes through the
    driver and no join is needed.  Columns are aligned by name (new columns
    allowed).
    """
    first = new.select(F.min(date_col)).scalar()
    cut = F.when(first.isNotNull(), F.least(first, existing.select(F.max(date_col)).scalar()))
    keep = existing.filter(F.coalesce(F.col(date_col) < cut, F.lit(True)))
    add = new.filter(F.col(date_col) >= cut)
    return keep.unionByName(add, allowMissingColumns=True)


# ---------------------------------------------------------------------------
def _once(s: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """``s`` with ``flag`` = true on every row; a key that occurs twice raises
    (as a MERGE would).  Keys with a null match nothing, so they may repeat.
    The window runs on the key partitioning that the join needs anyway."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    return s.withColumn("_n", n).withColumn(flag, F.when(whole & (F.col("_n") > 1), F.raise_error(F.lit(
        "duplicate source key in merge")).cast("boolean")).otherwise(F.lit(True))).drop("_n")


def _merge(target: DataFrame, source: DataFrame, keys: list[str], *, update_cols: list[str] | None = None,
           insert: bool = True, soft_delete: bool = False, now=None, check_unique: bool = True,
           deleted_col: str = "is_deleted", modified_col: str = "modified_at") -> DataFrame:
    """Shared merge core: one full-outer join that reads target and source
    once, both hash-partitioned by key; skewed keys are split by AQE."""
    ts = _lit_ts(now)
    if soft_delete:
        source = source.withColumns({modified_col: ts, deleted_col: F.lit(False)})
        if deleted_col not in target.columns:
            target = target.withColumn(deleted_col, F.lit(None).cast("boolean"))
        if modified_col not in target.columns:
            target = target.withColumn(modified_col, F.lit(None).cast("timestamp"))
    t_cols, s_cols = target.columns, source.columns
    cols = t_cols + [c for c in s_cols if c not in t_cols]
    s = source.select(*[_q(c).alias(f"s__{c}") for c in s_cols], F.lit(True).alias("s__present"))
    if check_unique:
        s = _once(s, [f"s__{k}" for k in keys], "s__present")
    t = target.select(*[_q(c).alias(f"t__{c}") for c in t_cols], F.lit(True).alias("t__present"))
    cond = None
    for k in keys:
        e = F.col(f"t__{k}") == F.col(f"s__{k}")
        cond = e if cond is None else cond & e
    sp, tp = F.col("s__present").isNotNull(), F.col("t__present").isNotNull()
    upd = set(update_cols) if update_cols is not None else set(s_cols)
    out = []
    for c in cols:
        sc, tc = F.col(f"s__{c}") if c in s_cols else None, F.col(f"t__{c}") if c in t_cols else None
        if c in keys:
            v = F.coalesce(tc, sc)
        elif soft_delete and c == deleted_col:
            v = (F.when(sp, F.lit(False))
                 .when(tp & ~F.coalesce(tc, F.lit(False)), F.lit(True)).otherwise(tc))
        elif soft_delete and c == modified_col:
            v = (F.when(sp, sc)
                 .when(tp & ~F.coalesce(F.col(f"t__{deleted_col}"), F.lit(False)), ts).otherwise(tc))
        else:
            matched_val = sc if (sc is not None and c in upd) else tc
            insert_val = sc if sc is not None else F.lit(None)
            if matched_val is None:
                matched_val = F.lit(None)
            v = (F.when(tp & sp, matched_val)
                 .when(sp, insert_val)
                 .otherwise(tc if tc is not None else F.lit(None)))
        out.append(v.alias(c))

    merged = t.join(s, cond, "full_outer").select(*out, tp.alias("_tp"))
    return (merged if insert else merged.filter(F.col("_tp"))).drop("_tp")


def upsert_soft_delete(target: DataFrame, source: DataFrame, keys: list[str], now=None) -> DataFrame:
    """M2: matched -> all source values and ``modified_at = now``;
    not matched -> inserted; not matched by source -> ``is_deleted = True``
    and modified time set, once (rows already deleted are left alone)."""
    return _merge(target, source, keys, soft_delete=True, now=now)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str] | None = None,
           check_unique: bool = True) -> DataFrame:
    """M3/M4: insert new keys, update matched rows.

    Columns are the union of both schemas.  ``update_cols`` limits which
    columns a match overwrites; the others keep the target's values.
    """
    return _merge(target, source, keys, update_cols=update_cols, check_unique=check_unique)


def insert_new(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """M5: append source rows whose key is absent from the target."""
    fresh = source.join(target.select(*keys), on=keys, how="left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def update_from(target: DataFrame, source: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """M6: set ``cols`` from the source where the key matches (the column is
    added first when absent); unmatched target rows keep their values.  A
    repeated source key raises, as in M2-M4."""
    for c in cols:
        if c not in target.columns:
            target = target.withColumn(c, F.lit(None).cast(source.schema[c].dataType))
    s = _once(source.select(*keys, *[F.col(c).alias(f"u__{c}") for c in cols]), keys, "u__hit")
    j = target.join(s, on=keys, how="left")
    return j.select(*[F.when(F.col("u__hit"), F.col(f"u__{c}")).otherwise(F.col(c)).alias(c)
                      if c in cols else _q(c) for c in target.columns])


def append_stamped(target: DataFrame | None, df: DataFrame, now) -> DataFrame:
    """M7: rows stamped with ``TransferDate`` and ``TransferDateTime`` and
    appended to the snapshot table."""
    ts = _lit_ts(now)
    stamped = df.select(F.to_date(ts).alias("TransferDate"), ts.alias("TransferDateTime"), "*")
    if target is None:
        return stamped
    return target.unionByName(stamped, allowMissingColumns=True)


def snapshot_daily(history: DataFrame | None, df: DataFrame, ids: list[str], date) -> DataFrame:
    """M8: daily snapshot history.

    Adds ``Snapshot_Date`` and ``Snapshot_<id> = '<date>_<id>'``; a re-run of
    a day replaces that day's rows; history rows without a day stay.
    ``versions.snapshot_day`` rewrites that day's folder only.
    """
    d = str(date)[:10]
    snap = df.withColumn("Snapshot_Date", _lit_date(d))
    snap = snap.withColumns({f"Snapshot_{i}": F.concat(F.lit(d), F.lit("_"), F.col(i)) for i in ids})
    if history is None:
        return snap
    return history.filter(~F.col("Snapshot_Date").eqNullSafe(_lit_date(d))).unionByName(snap, allowMissingColumns=True)


def commit_version(df: DataFrame, base: str, version: int, partition_by: list[str] | None = None) -> str:
    """Write a merge result as version ``version`` under ``base`` and return
    its path.  Never overwrites the version it was computed from, so a
    failed write leaves the previous version intact; readers switch to the
    new path only after the write committed."""
    path = f"{base.rstrip('/')}/v{version:08d}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path

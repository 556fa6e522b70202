"""Distinct users over overlapping windows from daily state.

A distinct count can't be added up over days, but a set can: each day (and
group) keeps the set of its users, as bitmaps over the users' numbers or as a
sketch, and a window is the union of its days.  All windows, rolling or by
calendar, are answered by one scan of the state: days that lie in the same
windows are united first, and only these few unions go to each of their windows.
The state of a day changes only when the day is loaded again.
"""

from __future__ import annotations

from datetime import date, timedelta
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import versions as V

#: The number of the blank user: a missing value counts as one.
BLANK = 1


def number_values(values: DataFrame, col: str, known: DataFrame | None = None) -> DataFrame:
    """(col, number) of the values that ``known`` doesn't have: longs beyond the known ones.

    Numbers of a task follow each other; tasks begin 2^33 apart, which leaves
    holes but no bitmaps for them.
    """
    new = values.select(col).where(F.col(col).isNotNull()).distinct()
    base = F.lit(BLANK + 1).cast("long")
    if known is not None:
        new = new.join(known.select(col), col, "left_anti")
        top = known.select(F.max("number")).scalar()
        base = F.coalesce((F.shiftright(top, 33) + 1) * F.lit(1 << 33), base)
    return new.select(col, (base + F.monotonically_increasing_id()).alias("number"))


def daily_sets(df: DataFrame, date_col: str, user_col: str, numbers: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(day, by, bucket, users): bitmaps of the numbers of each day's users.

    Repeated users of a day are dropped before the numbers are joined, and each
    task builds its own bitmaps before they are shuffled.
    """
    by = list(by or [])
    seen = df.select(F.to_date(date_col).alias("day"), *by, user_col).distinct()
    n = F.coalesce(F.col("number"), F.lit(BLANK).cast("long"))
    put = seen.join(numbers.select(user_col, "number"), user_col, "left").select("day", *by, n.alias("n"))
    return put.groupBy("day", *by, F.bitmap_bucket_number("n").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("users"))


def daily_sketches(df: DataFrame, date_col: str, user_col: str, by: list[str] | None = None, lg_k: int = 12) -> DataFrame:
    """(day, by, users): a sketch of each day's users, of bounded size; relative error about 1 / sqrt(2^lg_k)."""
    user = F.coalesce(F.col(user_col).cast("string"), F.lit(""))
    return df.groupBy(F.to_date(date_col).alias("day"), *(by or [])).agg(F.hll_sketch_agg(user, F.lit(lg_k)).alias("users"))


def rolling(today, days=(7, 14, 30, 60, 90, 180)) -> dict[str, Column]:
    """``today - n`` to ``today``."""
    t = F.lit(str(today)[:10]).cast("date")
    return {f"last_{n}d": F.col("day").between(F.date_sub(t, n), t) for n in days}


def calendar(today) -> dict[str, Column]:
    """This and the previous month, quarter and year."""
    t, d = F.lit(str(today)[:10]).cast("date"), F.col("day")
    same = lambda part, at: F.trunc(d, part) == F.trunc(at, part)
    out = {}
    for part, months in (("month", 1), ("quarter", 3), ("year", 12)):
        out |= {f"current_{part}": same(part, t), f"previous_{part}": same(part, F.add_months(t, -months))}
    return out


def window_users(state: DataFrame, windows: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """One row a group, one column a window: its number of distinct users, exact for sets, estimated for sketches.

    ``windows`` are conditions on ``day``, at most 62.  Groups without users in
    any window have zeros.
    """
    by = list(by or [])
    exact = "bucket" in state.columns
    keys = [*by, "bucket"] if exact else by
    unite = (lambda c: F.bitmap_or_agg(c)) if exact else (lambda c: F.hll_union_agg(c))
    mask = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, c in enumerate(windows.values())), F.lit(0).cast("long"))
    parts = state.select(*keys, "users", mask.alias("mask")).groupBy(*keys, "mask").agg(unite("users").alias("users"))
    hit = F.filter(F.array(*[F.lit(i) for i in range(len(windows))]), lambda i: F.expr("mask").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i)) != 0)
    # a part in no window only keeps its group
    sets = parts.select(*keys, F.explode_outer(hit).alias("w"), "users").groupBy(*keys, "w").agg(unite("users").alias("users"))
    count = F.bitmap_count("users") if exact else F.hll_sketch_estimate("users")
    return sets.select(*by, "w", count.cast("long").alias("n")).groupBy(*by).agg(*[
        F.coalesce(F.sum(F.when(F.col("w") == i, F.col("n"))), F.lit(0)).cast("long").alias(name) for i, name in enumerate(windows)])


def load_days(state: V.Versions, numbers: V.Buckets, feed: DataFrame, date_col: str, user_col: str, by: list[str] | None = None) -> int:
    """Brings the kept state up to a feed of whole days: new users get numbers, and the feed's days are written anew.

    ``state`` lies by ``day``, ``numbers`` by the user.  Other days aren't read.
    """
    known = numbers.rows()
    V.insert_new(numbers, number_values(feed, user_col, known))
    return state.commit(daily_sets(feed, date_col, user_col, numbers.rows(), by))


def days_of(state: V.Versions, today, days: int) -> DataFrame:
    """The state of the last days alone: their folders are chosen by name."""
    last = date.fromisoformat(str(today)[:10])
    wanted = {str(last - timedelta(days=n)) for n in range(days + 1)}
    return state.read([p for p in state.state()["parts"] if state.value(p) in wanted])


def all_windows(today, days=(7, 14, 30, 60, 90, 180)) -> dict[str, Column]:
    return dict(chain(rolling(today, days).items(), calendar(today).items()))

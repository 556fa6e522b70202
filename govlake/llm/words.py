"""Words, lines and shingle hashes of texts as Spark columns (no Python on the executors)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stage import private

#: Runs of these separate words.
GAP = r"[\x20\x09-\x0D]+"


def words(text: str | Column) -> Column:
    """The words of a text, in order; none for null.  Keep it in a column of its own before it is used."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def with_runs(df: DataFrame, word_col: str, out: str, width: int) -> DataFrame:
    """Adds a 64-bit hash of each run of ``width`` words of an array column, in order; none if there are fewer.

    Words are hashed once, then runs of 1, 2, 4, ... words are doubled by
    hashing two neighbours; each level is a column of its own, so that it is
    computed once a row.
    """
    size = F.size(word_col)
    shifted = lambda c, k: F.slice(F.col(c), F.lit(k + 1), F.greatest(size - k, F.lit(0)))
    pair = lambda a, b: F.xxhash64(a, b)
    name, levels = private(df), [1]
    own = lambda k: name(f"run{k}")
    df = df.withColumn(own(1), F.transform(word_col, lambda x: F.xxhash64(x)))
    k = 1
    while k * 2 <= width:
        df = df.withColumn(own(k * 2), F.zip_with(F.col(own(k)), shifted(own(k), k), pair))
        k *= 2
        levels.append(k)
    run, done, level = F.col(own(k)), k, k // 2
    while done < width:
        if done + level <= width:
            run = F.zip_with(run, shifted(own(level), done), pair)
            done += level
        level //= 2
    run = F.when(size >= width, F.slice(run, F.lit(1), F.greatest(size - (width - 1), F.lit(0)))).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn(out, run).drop(*map(own, levels))


def with_shingles(df: DataFrame, word_col: str, out: str, width: int) -> DataFrame:
    """Adds the hashes of the distinct ``width``-word shingles; fewer words are one shingle, no words none."""
    w = F.col(word_col)
    return with_runs(df, word_col, out, width).withColumn(out, F.when(F.size(w) >= width, F.array_distinct(out)).when(
        F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, "\n"), F.size(w)))).otherwise(F.array().cast("array<bigint>")))

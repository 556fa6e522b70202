"""Gateway report log scans (S4) and bad-record reports.

Log files are CSV with a header line, but files of one report may carry
different headers (columns added or missing between versions).  Instead of
trusting the first file's header, every file is read header-less and each
data row is matched to the header line of *its own* file, so columns are
picked by name per file in one distributed pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def _widest_header(spark: SparkSession, folder: str, report: str) -> int:
    """The largest number of columns that a file's first line names (one number comes to the driver)."""
    lines = (spark.read.option("pathGlobFilter", f"*{report}*.log").option("recursiveFileLookup", "true")
             .option("ignoreCorruptFiles", "true").text(folder)
             .select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("at"),
                     F.monotonically_increasing_id().alias("n")))
    # numbers alone are aggregated: texts, which a hash aggregation can't update in place, would have every line sorted
    first = lines.where("at = 0").groupBy("f").agg(F.min_by(F.size(F.split("value", ",")), "n").alias("width"))
    return first.agg(F.max("width")).first()[0] or 1


def read_report_logs(spark: SparkSession, folder: str, report: str, cols: list[str],
                     with_row_number: bool = False, checkpoint_dir: str | None = None) -> DataFrame:
    """Rows of all ``*<report>*.log`` files under ``folder``, columns ``cols``.

    Missing columns are null, unreadable files are skipped.  With
    ``with_row_number`` a ``FileName`` and 1-based ``RowNumber`` (data rows,
    within the file) are added.
    """
    from ..session import materialize

    raw_names = [f"_c{i}" for i in range(_widest_header(spark, folder, report))]
    schema = StructType([StructField(n, StringType()) for n in raw_names])
    raw = (spark.read.schema(schema)
           .option("header", "false").option("multiLine", "true")
           .option("quote", '"').option("escape", '"')
           .option("mode", "PERMISSIVE").option("ignoreCorruptFiles", "true")
           .option("pathGlobFilter", f"*{report}*.log").option("recursiveFileLookup", "true")
           .csv(folder)
           .select(F.array(*raw_names).alias("_v"),
                   F.col("_metadata.file_path").alias("_file"),
                   F.col("_metadata.file_name").alias("_fname"),
                   F.monotonically_increasing_id().alias("_seq")))
    # one task reads one multiLine file in order, so a file's rows have consecutive
    # numbers, the header the least: no file is sorted, or held, for its row numbers.
    # Rows are parsed once and written; the headers are a row a file.
    raw = materialize(raw, "log-rows", checkpoint_dir)
    first = materialize(raw.groupBy("_file").agg(F.min("_seq").alias("_first")), "log-firsts", checkpoint_dir)
    few = first.count() <= BROADCAST_SPLITS
    near = lambda df: F.broadcast(df) if few else df
    headers = raw.join(near(first), "_file").filter(F.col("_seq") == F.col("_first")).select("_file", "_first", F.col("_v").alias("_h"))
    headers = materialize(headers, "log-headers", checkpoint_dir)
    data = raw.join(near(headers), "_file").filter(F.col("_seq") > F.col("_first"))
    # array_position gives 0 when the file lacks the column; element_at(arr, 0) raises, so guard it
    out = [F.when(F.array_position(F.col("_h"), F.lit(c)) > 0,
                  F.element_at(F.col("_v"), F.greatest(F.array_position(F.col("_h"), F.lit(c)).cast("int"), F.lit(1))))
           .alias(c) for c in cols]
    extra = [F.col("_fname").alias("FileName"), (F.col("_seq") - F.col("_first")).cast("int").alias("RowNumber")] if with_row_number else []
    return data.select(*out, *extra)


def bad_json_rows(df: DataFrame, col: str, file_col: str = "FileName", row_col: str = "RowNumber") -> DataFrame:
    """File name, row number and text of rows whose ``col`` is not valid JSON."""
    c = F.col(col)
    bad = F.try_parse_json(c).isNull()  # null and blank texts don't parse either
    return df.filter(bad).select(file_col, row_col, c.alias("Value"))


# ------------------------------------------------------------------ split scan
#: A row for each split of a file up to this number is broadcast; beyond, lines and splits meet by shuffling.
BROADCAST_SPLITS = 500_000


def _log_lines(spark: SparkSession, folder: str, report: str) -> DataFrame:
    """Lines of the logs with file, split and a number that rises within a split; splits are read side by side."""
    return (spark.read.option("pathGlobFilter", f"*{report}*.log").option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true")
            .option("lineSep", "\n").text(folder)
            .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"),
                    F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n")))


def _runs(batch):
    """(first, last, file, at) of the runs of one split's lines in a batch."""
    import numpy as np

    at, file = batch.column("at").to_numpy(), batch.column("file").dictionary_encode().indices.to_numpy()
    cuts = np.flatnonzero((at[1:] != at[:-1]) | (file[1:] != file[:-1])) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        if b > a:
            yield a, b, batch.column("file")[a].as_py(), int(at[a])


def _parity(values):
    """Of consecutive lines: quotes before each, whether each is blank, and all quotes."""
    import numpy as np
    import pyarrow.compute as pc

    quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(quotes)
    blank = pc.is_in(values, value_set=pc.cast(["", "\r"], values.type)).to_numpy(zero_copy_only=False)
    return ends - quotes, blank, int(ends[-1]) if len(ends) else 0


def _split_facts(batches):
    """For each split: whether its quotes are odd in number, how many records start in it if the quotes before it are
    even and if they are odd, and its first line."""
    import pyarrow as pa

    facts: dict[tuple, list] = {}
    for batch in batches:
        for a, b, file, at in _runs(batch):
            values = batch.column("value").slice(a, b - a)
            before, blank, total = _parity(values)
            own = facts.setdefault((file, at), [0, 0, 0, values[0].as_py()])
            odd = (own[0] + before) % 2 == 1
            own[1] += int((~odd & ~blank).sum())
            own[2] += int((odd & ~blank).sum())
            own[0] += total
    rows = [(file, at, own[0] % 2, own[1], own[2], own[3] if at == 0 else None) for (file, at), own in facts.items()]
    yield pa.RecordBatch.from_pylist([dict(zip(("file", "at", "odd", "even_starts", "odd_starts", "head"), r)) for r in rows], schema=pa.schema(
        [("file", pa.string()), ("at", pa.int64()), ("odd", pa.int32()), ("even_starts", pa.int64()), ("odd_starts", pa.int64()), ("head", pa.string())]))


def _records(batches):
    """Records of the lines of each split.  A record that goes on beyond its split comes in pieces (``whole`` is false)."""
    import pyarrow as pa

    names = ["file", "name", "record", "at", "text", "whole"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
    split, parity, number, open_lines, name, inside = None, 0, 0, [], None, False

    def close(out: list, whole: bool) -> None:
        if open_lines:
            out.append((split[0], name, number, split[1], "\n".join(open_lines), whole))
            open_lines.clear()

    def table(out: list):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    for batch in batches:
        out: list = []
        for a, b, file, at in _runs(batch):
            if (file, at) != split:
                close(out, parity == 0 and not inside)
                split, name = (file, at), batch.column("name")[a].as_py()
                parity, number = batch.column("parity")[a].as_py(), batch.column("records")[a].as_py()
                inside = parity == 1  # the first lines go on with a record of an earlier split
            values = batch.column("value").slice(a, b - a)
            before, blank, total = _parity(values)
            odd = ((parity + before) % 2 == 1).tolist()
            for text, continued, empty in zip(values.to_pylist(), odd, blank.tolist()):
                if not continued:
                    close(out, not inside)
                    inside = False
                    if empty:
                        continue
                    number += 1
                open_lines.append(text)
            parity = (parity + total) % 2
        yield table(out)
    out = []
    close(out, parity == 0 and not inside)
    yield table(out)


def read_split_logs(spark: SparkSession, folder: str, report: str, cols: list[str], with_row_number: bool = False,
                    checkpoint_dir: str | None = None) -> DataFrame:
    """What :func:`read_report_logs` returns, with each file read by as many tasks as it has splits.

    Whether a line break ends a record depends on whether the quotes before it
    are even in number.  Each split counts its quotes, and the records that
    start in it in both cases; prefix sums over a file's splits then tell each
    split its case and the number of its first record.  Records that lie across
    splits are put together from their pieces, each of which knows its record's
    number.  Lines are scanned once for the counts and parsed once.

    A quote inside an unquoted value isn't understood, as in any CSV of RFC 4180.
    """
    from ..session import importable, materialize

    importable(spark)
    lines = _log_lines(spark, folder, report)
    facts = lines.select("value", "file", "at").mapInArrow(_split_facts, "file string, at long, odd int, even_starts long, odd_starts long, head string")
    facts = facts.groupBy("file", "at").agg(F.sum("odd").alias("odd"), F.sum("even_starts").alias("even_starts"), F.sum("odd_starts").alias("odd_starts"), F.max("head").alias("head"))
    along = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)  # a row a split
    splits = facts.withColumn("parity", (F.coalesce(F.sum("odd").over(along), F.lit(0)) % 2).cast("int"))
    splits = splits.withColumn("records", F.coalesce(F.sum(F.when(F.col("parity") == 0, F.col("even_starts")).otherwise(F.col("odd_starts"))).over(along), F.lit(0)))
    splits = materialize(splits, "log-splits", checkpoint_dir)
    known = splits.select(F.col("file").alias("f"), F.col("at").alias("a"), "parity", "records")
    few = known.count() <= BROADCAST_SPLITS
    met = lines.join(F.broadcast(known) if few else known, (F.col("file") == F.col("f")) & (F.col("at") == F.col("a")), "left")
    told = lambda c: F.coalesce(F.col(c), F.raise_error(F.lit("a log changed while it was read")).cast("long")).alias(c)
    met = met.select("value", "file", "name", "at", "n", told("parity"), told("records"))
    if not few:
        met = met.repartition("file", "at").sortWithinPartitions("file", "at", "n")
    found = met.drop("n").mapInArrow(_records, "file string, name string, record long, at long, text string, whole boolean")
    found = materialize(found, "log-records", checkpoint_dir)
    pieces = found.where("NOT whole").groupBy("file", "name", "record").agg(F.array_sort(F.collect_list(F.struct("at", "text"))).alias("p"))
    joined = pieces.select("file", "name", "record", F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"))
    rows = found.where("whole").select("file", "name", "record", "text").unionByName(joined)
    text = F.regexp_replace(F.regexp_replace("text", "\r$", ""), "^﻿", "")
    width = splits.agg(F.max(F.size(F.split("head", ",")))).first()[0] or 1
    names = [f"_c{i}" for i in range(width)]
    parsed = rows.select("file", "name", "record", F.from_csv(text, ", ".join(f"{n} string" for n in names), {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}).alias("v"))
    parsed = parsed.select("file", "name", "record", F.array(*[F.col(f"v.{n}") for n in names]).alias("v"))
    headers = parsed.where("record = 1").select("file", F.col("v").alias("h"))
    data = parsed.where("record > 1").join(headers, "file")
    place = lambda c: F.array_position("h", F.lit(c)).cast("int")
    out = [F.when(place(c) > 0, F.element_at("v", F.greatest(place(c), F.lit(1)))).alias(c) for c in cols]
    extra = [F.col("name").alias("FileName"), (F.col("record") - 1).alias("RowNumber")] if with_row_number else []
    return data.select(*out, *extra)

"""Incremental loads that rewrite only what they touch.

A :class:`Versions` table lies in folders by one partition column, and a
version is a list of folders: a change writes the partitions it touches into a
new folder and commits a list that refers to the untouched ones as they are.
Nothing is overwritten, so readers of an earlier version go on, a failed write
leaves no trace but an unlisted folder, and :meth:`Versions.clean` removes what
no kept version lists.  One writer at a time.

* by date: the high-water-mark reload (M1), the daily snapshot (M8), stamped
  appends (M7) and anonymising of aged days (P26) write days, not tables;
* :class:`Buckets`: by a hash of the key, for the merges (M2-M6).  The buckets
  of the source's keys are found first, only these are read, joined and written.

To the driver come folder names, cut dates and bucket numbers, never rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from datetime import date, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from . import merge as M
from .flatten import anonymise

WRITE, BUCKET, NULL = "_write", "_bucket", "__HIVE_DEFAULT_PARTITION__"
#: Writes of anonymised days carry this name, so that a day is due again only after it was loaded anew.
HASHED = "anonymised"


class Versions:
    """A table under ``base``, partitioned by the column ``by``.

    ``base/data/_write=<name>/<by>=<value>/`` holds rows, ``base/versions/v<n>/``
    one text: the schema, the writes that each partition consists of, and the
    last epoch of each stream that loads the table.  Null is a partition too.
    """

    def __init__(self, spark: SparkSession, base: str, by: str):
        self.spark, self.base, self.by = spark, base.rstrip("/"), by
        self.layout: dict = {"by": by}

    # ------------------------------------------------------------ reading
    def _folder(self, *names: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path("/".join([self.base, *names]))
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _names(self, *names: str) -> list[str]:
        fs, path = self._folder(*names)
        return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()) if fs.exists(path) else []

    def numbers(self) -> list[int]:
        """The committed versions, in order."""
        return [int(n[1:]) for n in self._names("versions") if self._folder("versions", n, "_SUCCESS")[0].exists(self._folder("versions", n, "_SUCCESS")[1])]

    def state(self, version: int | None = None) -> dict:
        """Schema, partitions and marks of a version (the newest); an empty table where there is none."""
        if version is None:
            version = max(self.numbers(), default=0)
        if not version:
            return {"version": 0, "schema": None, "parts": {}, "marks": {}, "layout": self.layout}
        text = self.spark.read.text(f"{self.base}/versions/v{version:08d}", wholetext=True).first()[0]
        state = json.loads(text) | {"version": version}
        if state["layout"] != self.layout:
            raise ValueError(f"the table lies by {state['layout']}, not by {self.layout}")
        return state

    def value(self, part: str) -> str | None:
        """A partition folder's value, as text."""
        text = part.split("=", 1)[1]
        return None if text == NULL else unquote(text)

    def read(self, parts: Iterable[str] | None = None, version: int | None = None) -> DataFrame | None:
        """The rows of a version, or of some of its partitions; None before the first one."""
        state = self.state(version)
        if state["schema"] is None:
            return None
        schema = StructType.fromJson(state["schema"])
        wanted = state["parts"] if parts is None else [p for p in parts if p in state["parts"]]
        paths = [f"{self.base}/data/{WRITE}={w}/{p}" for p in wanted for w in state["parts"][p]]
        if not paths:
            return self.spark.createDataFrame([], schema)
        whole = StructType([*schema.fields, StructField(WRITE, StringType())])
        return self.spark.read.schema(whole).option("basePath", f"{self.base}/data").parquet(*paths).select(*[F.col(f"`{n}`") for n in schema.names])

    def changed(self, version: int) -> set[str]:
        """The partitions that differ from the version before."""
        old, new = (self.state(v)["parts"] if v else {} for v in (version - 1, version))
        return {p for p in old.keys() | new.keys() if old.get(p) != new.get(p)}

    # ------------------------------------------------------------ writing
    def _schema(self, state: dict, rows: DataFrame) -> StructType:
        """The table's columns and then the new ones; a column that changes its type is refused."""
        old = StructType.fromJson(state["schema"]) if state["schema"] else StructType([])
        kinds = {f.name: f.dataType for f in old.fields}
        for f in rows.schema.fields:
            if f.name == WRITE or kinds.get(f.name, f.dataType) != f.dataType:
                raise ValueError(f"column {f.name}: {f.dataType.simpleString()} can't join {kinds.get(f.name)}")
        fields = [*old.fields, *[f for f in rows.schema.fields if f.name not in kinds]]
        return StructType([StructField(f.name, f.dataType, True) for f in fields])

    def commit(self, rows: DataFrame | None, replaced: Iterable[str] = (), append: bool = False, mark: tuple[str, int] | None = None,
               name: str = "rows") -> int:
        """A new version: without the partitions ``replaced`` and with the ``rows``, whose partitions stand
        in the place of earlier ones or, with ``append``, beside them.  ``mark`` (stream, epoch) makes the
        commit a no-op when that epoch is in the table."""
        state = self.state()
        if mark and state["marks"].get(mark[0]) == mark[1]:
            return state["version"]
        gone = set(replaced)
        parts = {p: list(w) for p, w in state["parts"].items() if p not in gone}
        schema = state["schema"]
        if rows is not None:
            schema = self._schema(state, rows).jsonValue()
            write = f"{name}-{uuid.uuid4().hex}"
            # adaptive execution splits a large partition over tasks and joins small ones
            rows.hint("rebalance", self.by).write.partitionBy(self.by).parquet(f"{self.base}/data/{WRITE}={write}")
            for p in self._names("data", f"{WRITE}={write}"):
                parts[p] = [*(parts.get(p, []) if append else []), write]
        marks = state["marks"] | ({mark[0]: mark[1]} if mark else {})
        version = state["version"] + 1
        text = json.dumps({"schema": schema, "parts": parts, "marks": marks, "layout": self.layout})
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{self.base}/versions/v{version:08d}")
        return version

    def clean(self, keep: int = 1) -> list[str]:
        """Removes all but the newest ``keep`` versions and the writes that none of these lists; their names."""
        numbers = self.numbers()
        kept = {w for v in numbers[-keep:] for ws in self.state(v)["parts"].values() for w in ws}
        gone = [("versions", f"v{v:08d}") for v in numbers[:-keep]]
        gone += [("data", n) for n in self._names("data") if n.removeprefix(f"{WRITE}=") not in kept]
        for names in gone:
            fs, path = self._folder(*names)
            fs.delete(path, True)
        return [names[-1] for names in gone]


# ---------------------------------------------------------------- by date
def replace_since(table: Versions, new: DataFrame, mark: tuple[str, int] | None = None) -> int:
    """M1 on a table by date: the days from the cut on are replaced by the feed's, earlier days and rows
    without a date aren't touched, and a feed without dates changes nothing.

    The table's newest day is read from its folder names.
    """
    first = new.agg(F.min(table.by)).first()[0]
    days = {p: table.value(p) for p in table.state()["parts"]}
    if first is None:
        return table.commit(None, mark=mark) if mark else table.state()["version"]
    last = max((d for d in days.values() if d), default=str(first))
    cut = min(str(first), last)
    return table.commit(new.where(F.col(table.by) >= F.lit(cut).cast("date")), [p for p, d in days.items() if d and d >= cut], mark=mark)


def snapshot_day(table: Versions, df: DataFrame, ids: list[str], day) -> int:
    """M8 on a table by ``Snapshot_Date``: the day's folder is written, or written anew; an empty
    snapshot leaves the day without rows."""
    rows = M.snapshot_daily(None, df, ids, day)
    return table.commit(rows, [f"{table.by}={str(day)[:10]}"])


def append_stamped(table: Versions, df: DataFrame, now) -> int:
    """M7 on a table by ``TransferDate``: the stamped rows are put beside the day's earlier ones."""
    return table.commit(M.append_stamped(None, df, now), append=True)


def anonymise_days(table: Versions, cols: list[str], after_days: int, today, flag_col: str = "IsAnonymised") -> int:
    """P26 on a table by date: only days that have aged past ``after_days`` since they were last written
    are read and written; rows hashed before keep their hashes."""
    cutoff = str(date.fromisoformat(str(today)[:10]) - timedelta(days=after_days))
    state = table.state()
    due = [p for p, writes in state["parts"].items()
           if (d := table.value(p)) and d < cutoff and not all(w.startswith(HASHED) for w in writes)]
    if not due:
        return state["version"]
    return table.commit(anonymise(table.read(due), cols, flag_col=flag_col), due, name=HASHED)


# ---------------------------------------------------------------- by key
class Buckets(Versions):
    """A table in ``n`` buckets by a hash of ``keys``."""

    def __init__(self, spark: SparkSession, base: str, keys: list[str], n: int = 256):
        super().__init__(spark, base, BUCKET)
        self.keys, self.n = keys, n
        self.layout = {"by": BUCKET, "keys": keys, "n": n}

    def keyed(self, rows: DataFrame) -> DataFrame:
        """The rows with their bucket; keys take the table's types first, for the hash depends on them."""
        schema = self.state()["schema"]
        kinds = {f.name: f.dataType for f in StructType.fromJson(schema).fields} if schema else {}
        rows = rows.withColumns({k: F.col(k).cast(kinds[k]) for k in self.keys if k in kinds})
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.n)).cast("int"))

    def touched(self, *rows: DataFrame) -> list[str]:
        """The folders of the buckets that hold any of the rows: at most ``n`` numbers come to the driver."""
        found = {r[0] for df in rows for r in df.select(BUCKET).distinct().collect()}
        return [f"{BUCKET}={b}" for b in sorted(found)]

    def rows(self, version: int | None = None) -> DataFrame | None:
        """The table without the bucket column."""
        df = self.read(version=version)
        return None if df is None else df.drop(BUCKET)


def upsert(table: Buckets, source: DataFrame, update_cols: list[str] | None = None, mark: tuple[str, int] | None = None) -> int:
    """M3/M4 on buckets: those of the source's keys are joined and written, the others stay."""
    source = table.keyed(source)
    if table.state()["schema"] is None:
        return table.commit(source, mark=mark)
    hit = table.touched(source)
    return table.commit(_merged(table, hit, lambda t: M.upsert(t, source.drop(BUCKET), table.keys, update_cols)), hit, mark=mark)


def upsert_soft_delete(table: Buckets, source: DataFrame, now, deleted_col: str = "is_deleted", mark: tuple[str, int] | None = None) -> int:
    """M2 on buckets: besides the source's, those with a row that isn't deleted yet (one narrow scan tells)."""
    source = table.keyed(source)
    old = table.read()
    if old is None:
        return table.commit(table.keyed(M.upsert_soft_delete(source.drop(BUCKET).limit(0), source.drop(BUCKET), table.keys, now)), mark=mark)
    live = old.where(~F.coalesce(F.col(deleted_col), F.lit(False))) if deleted_col in old.columns else old
    hit = table.touched(source, live)
    return table.commit(_merged(table, hit, lambda t: M.upsert_soft_delete(t, source.drop(BUCKET), table.keys, now)), hit, mark=mark)


def insert_new(table: Buckets, source: DataFrame, mark: tuple[str, int] | None = None) -> int:
    """M5 on buckets: the touched buckets' keys are read, and only rows with a new key are written."""
    source = table.keyed(source)
    if table.state()["schema"] is None:
        return table.commit(source, mark=mark)
    known = table.read(table.touched(source)).select(*table.keys)
    return table.commit(source.join(known, table.keys, "left_anti").select(*source.columns), append=True, mark=mark)


def update_from(table: Buckets, source: DataFrame, cols: list[str], mark: tuple[str, int] | None = None) -> int:
    """M6 on buckets: those that hold one of the source's keys are joined and written."""
    source = table.keyed(source)
    known = table.read(table.touched(source))
    hit = table.touched(known.join(source.select(*table.keys), table.keys, "left_semi"))
    rows = _merged(table, hit, lambda t: M.update_from(t, source.select(*table.keys, *cols), table.keys, cols))
    return table.commit(rows, hit, mark=mark)


def _merged(table: Buckets, hit: list[str], merge) -> DataFrame:
    return table.keyed(merge(table.read(hit).drop(BUCKET)))

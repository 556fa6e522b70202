"""All tables of the tenant scan from one pass.

Each workspace is repeated under the names of the tables and builds, under
each, one array of rows: a struct with one field a table, of which only the
named one is set, with that table's columns and types.  The rows are written
once, partitioned by the name; a table is its folder, read for its own field
only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .flatten import _SIMPLE, _has_path
from .tables import INVENTORY_TABLES, ITEM_USER_TYPES, _spec

#: Columns of the item users, and what of a user they are.
USER_COLUMNS = {"EmailAddress": "emailAddress", "DisplayName": "displayName", "Identifier": "identifier", "GraphId": "graphId",
                "PrincipalType": "principalType", "UserType": "userType"}
#: Bridges to data-source instances: array, key, name of the key, whether the workspace is a column.
USAGES = {"semantic_model_datasources": ("datasets", "id", "SemanticModelId", True), "dataflow_datasources": ("dataflows", "objectId", "DataflowId", True),
          "report_datasources": ("reports", "id", "ReportId", False)}


class _Table:
    """Rows of one table as an array in a workspace: its columns' types, and the array's expression."""

    def __init__(self, name: str, columns: list[tuple[str, object]], rows):
        self.name, self.type, self.rows = name, StructType([StructField(n, t) for n, t in columns]), rows


def _element(kind: StructType, array: str):
    """The struct type of an array's elements, or None."""
    if not _has_path(kind, array) or not isinstance(kind[array].dataType, ArrayType):
        return None
    inner = kind[array].dataType.elementType
    return inner if isinstance(inner, StructType) else None


def _leaves(kind: StructType, prefix: str = "") -> list[tuple[str, tuple[str, ...], object]]:
    """(dotted name, path, type) of a struct's fields, nested structs opened."""
    out = []
    for f in kind.fields:
        name = prefix + f.name
        out += _leaves(f.dataType, name + ".") if isinstance(f.dataType, StructType) else [(name, tuple(name.split(".")), f.dataType)]
    return out


def _at(item: Column, path: tuple[str, ...]) -> Column:
    for p in path:
        item = item[p]
    return item


def _text(item: Column, kind: StructType, field: str) -> Column:
    return F.coalesce(item[field].cast("string"), F.lit("")) if _has_path(kind, field) else F.lit("")


def _first(item: Column, kind: StructType, *fields: str) -> Column:
    return F.coalesce(*[item[f] for f in fields if _has_path(kind, f)], F.lit(None).cast("string"))


def _child(kind: StructType, name: str) -> _Table | None:
    """The elements of the table's array: flattened, without keyless ones, renamed, ids upper-cased, dates sliced."""
    spec = _spec(name)
    element = _element(kind, spec["array"])
    if element is None:
        return None
    leaves = _leaves(element)
    key = spec["key"] or "id"
    keyed = [path for n, path, _ in leaves if n == key]
    columns, values = [("WorkspaceId", StringType())], [lambda ws, it: F.upper(ws["id"])]
    for n, path, t in leaves:
        if n in spec["drop"]:
            continue
        final, simple = spec["rename"].get(n, n), isinstance(t, _SIMPLE)
        columns.append((final, t if simple else StringType()))
        values.append(lambda ws, it, path=path, up=final in spec["upper"], simple=simple: (
            F.upper(_at(it, path)) if up else _at(it, path) if simple else _at(it, path).cast("string")))
        if final in spec["upper"]:
            columns[-1] = (final, StringType())
    places = {n: i for i, (n, _) in enumerate(columns)}
    for out, source in spec["slices"].items():
        if source in places:
            make = values[places[source]]
            cut = lambda ws, it, make=make: F.substring(make(ws, it).cast("string"), 1, 10)
            if out in places:
                columns[places[out]], values[places[out]] = (out, StringType()), cut
            else:
                columns.append((out, StringType()))
                values.append(cut)

    def kept(it: Column) -> Column:
        if keyed:
            return _at(it, keyed[0]).isNotNull()
        return F.coalesce(*[_at(it, path).cast("string") for _, path, _ in leaves]).isNotNull()

    def rows(ws: Column) -> Column:
        return F.transform(F.filter(ws[spec["array"]], kept), lambda it: F.struct(*[v(ws, it).alias(n) for (n, _), v in zip(columns, values)]))

    return _Table(name, columns, rows)


def _users(kind: StructType) -> _Table | None:
    """Every user of every item of the listed types, with the access right that is given first."""
    arrays = []
    for array, right in ITEM_USER_TYPES.items():
        element = _element(kind, array)
        person = element and _element(element, "users")
        if person:
            arrays.append((array, right, element, person))
    if not arrays:
        return None
    names = ["WorkspaceId", "ItemId", "ItemType", "ItemName", "AccessRight", *USER_COLUMNS]

    kinds = ArrayType(_texts(names))

    def users_of(ws: Column, array: str, right: str, element: StructType, person: StructType):
        def of_item(it: Column) -> Column:
            item, name = F.upper(F.coalesce(_first(it, element, "id", "objectId"), F.lit(""))), F.coalesce(_first(it, element, "name", "displayName"), F.lit(""))

            def of_user(u: Column) -> Column:
                own = _first(u, person, right)
                access = F.when(F.coalesce(own, F.lit("")) != "", own).otherwise(F.coalesce(_first(u, person, "artifactUserAccessRight"), _text(u, person, "groupUserAccessRight")))
                texts = [F.upper(_text(u, person, f)) if c == "GraphId" else _text(u, person, f) for c, f in USER_COLUMNS.items()]
                values = [F.upper(F.coalesce(ws["id"], F.lit(""))), item, F.lit(array), name, access, *texts]
                return F.struct(*[v.alias(n) for n, v in zip(names, values)])

            found = F.transform(F.coalesce(it["users"], F.array().cast(ArrayType(person))), of_user)
            return F.when((item != "") | (name != ""), found).otherwise(F.array().cast(kinds))

        return F.flatten(F.transform(F.coalesce(ws[array], F.array().cast(ArrayType(element))), of_item)).cast(kinds)

    def rows(ws: Column) -> Column:
        return F.concat(*[users_of(ws, *each) for each in arrays])

    return _Table("item_users", [(n, StringType()) for n in names], rows)


def _texts(names) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def _usage(kind: StructType, name: str) -> _Table | None:
    """The data-source instances that an item uses."""
    array, key, named, spaced = USAGES[name]
    element = _element(kind, array)
    used = element and _element(element, "datasourceUsages")
    if not used or not _has_path(element, key) or not _has_path(used, "datasourceInstanceId"):
        return None
    names = [*(["WorkspaceId"] if spaced else []), named, "datasourceInstanceId"]

    def rows(ws: Column) -> Column:
        def of_item(it):
            found = F.filter(F.coalesce(it["datasourceUsages"], F.array().cast(ArrayType(used))), lambda u: u["datasourceInstanceId"].isNotNull())
            values = lambda u: [*([F.upper(ws["id"])] if spaced else []), F.upper(it[key]), F.upper(u["datasourceInstanceId"])]
            return F.transform(found, lambda u: F.struct(*[v.alias(n) for n, v in zip(names, values(u))]))

        return F.flatten(F.transform(F.filter(ws[array], lambda it: it[key].isNotNull()), of_item)).cast(ArrayType(_texts(names)))

    return _Table(name, [(n, StringType()) for n in names], rows)


def _tables(workspaces: DataFrame) -> list[_Table]:
    kind = workspaces.schema
    made = [_child(kind, n) for n in INVENTORY_TABLES] + [_users(kind)] + [_usage(kind, n) for n in USAGES]
    return [t for t in made if t is not None]


def tagged_rows(workspaces: DataFrame) -> DataFrame:
    """(table, and one struct a table): the rows of all tables, exploded from one array a workspace and table.

    A workspace is first repeated under the tables' names, then each of these
    rows builds its own table's rows alone: a filter on ``table`` goes below
    the second explode, so rows of other tables are never built.
    """
    tables = _tables(workspaces)
    if not tables:
        raise ValueError("the scan holds none of the item arrays")
    shape = StructType([StructField(t.name, t.type) for t in tables])
    ws = F.col("w")

    def tagged(t: _Table) -> Column:
        fields = lambda row: [row.cast(o.type) if o is t else F.lit(None).cast(o.type) for o in tables]
        return F.transform(t.rows(ws), lambda row: F.struct(*[c.alias(o.name) for c, o in zip(fields(row), tables)])).cast(ArrayType(shape))

    own = F.lit(None).cast(ArrayType(shape))
    for t in reversed(tables):
        own = F.when(F.col("table") == t.name, tagged(t)).otherwise(own)
    named = workspaces.select(F.struct("*").alias("w"), F.explode(F.array(*[F.lit(t.name) for t in tables])).alias("table"))
    return named.select("table", F.explode(own).alias("e")).select("table", "e.*")


def demultiplex(workspaces: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Every table of the scan: one pass over ``workspaces``, one write under ``folder``, one folder a table.

    Tables whose array the scan lacks are left out; a table without rows is empty.
    """
    rows = tagged_rows(workspaces)
    rows.write.partitionBy("table").parquet(folder)
    stored = workspaces.sparkSession.read.schema(rows.schema).parquet(folder)
    return {f.name: stored.where(F.col("table") == f.name).select(f"`{f.name}`.*") for f in rows.schema.fields if f.name != "table"}

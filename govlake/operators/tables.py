"""Table-building jobs (T1-T27): compositions of the operators with their
own semantics.  Each takes DataFrames and returns DataFrame(s)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import (ZERO_GUID, activity_status, date_parts, date_slice, decode_b64_text,
                                duration_s, item_key, item_kind, sha_key, sum_bracket_list, text_key, time_bin,
                                yn_status)
from .flatten import child_table, promote, stringify_complex, upper_keys

# Id columns upper-cased in the activity log.
ACTIVITY_KEYS = ["ActivityId", "ArtifactId", "CapacityId", "DashboardId", "DataflowId", "DatasetId",
                 "DatasourceId", "FolderObjectId", "GatewayId", "Id", "ItemId", "ReportId", "UserId", "WorkspaceId"]


# T1 -----------------------------------------------------------------------------
def build_activities(records: DataFrame) -> DataFrame:
    """Activities silver: date parts of CreationTime, upper-cased ids,
    complex columns as text."""
    parts = date_parts("CreationTime", "Creation")
    df = records.select(*[c.alias(n) for n, c in parts.items()], "*")
    return stringify_complex(upper_keys(df, ACTIVITY_KEYS))


# T26 ----------------------------------------------------------------------------
# The raw grouping keys of the aggregate (16) - more than the
# 12 projected ones, so one output key may repeat.
AGG_GROUP_KEYS = ["CreationDate", "CreationDateKey", "CreationHour", "Activity", "Experience", "Workload",
                  "CapacityId", "WorkspaceId", "GatewayId", "ArtifactId", "ItemId", "ObjectId", "ObjectType",
                  "ArtifactKind", "ResultStatus", "IsSuccess"]


def build_aggregated_activities(activities: DataFrame, today, days: int = 30) -> DataFrame:
    """Activities of the last ``days`` days (CreationDate >= today - days):
    count and distinct users per raw key set, projected to upper-cased ids,
    the first non-null item id/kind and the resolved status.

    The date filter is a plain column predicate, so it reaches the parquet
    scan (and prunes partitions when the table is partitioned by date)."""
    df = activities
    for c in AGG_GROUP_KEYS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    t = F.lit(str(today)[:10]).cast("date")
    g = (df.filter(F.col("CreationDate") >= F.date_sub(t, days))
         .groupBy(*AGG_GROUP_KEYS)
         .agg(F.count(F.lit(1)).alias("CountOfActivities"),
              F.count_distinct("UserId").alias("DistinctCountOfUsers")))
    return g.select("CreationDate", "CreationDateKey", "CreationHour", "Activity", "Experience", "Workload",
                    F.upper("CapacityId").alias("CapacityId"), F.upper("WorkspaceId").alias("WorkspaceId"),
                    "GatewayId", item_key().alias("item_id"), item_kind().alias("item_kind_resolved"),
                    activity_status().alias("activity_status"), "CountOfActivities", "DistinctCountOfUsers")


def _col_or_null(df: DataFrame, path: str, dtype: str = "string") -> Column:
    from .flatten import _has_path
    return F.col(path) if _has_path(df.schema, path) else F.lit(None).cast(dtype)


# T2 -----------------------------------------------------------------------------
def build_active_items(records: DataFrame) -> DataFrame:
    """Active items silver: upper-cased keys, creator promoted, duplicates
    and the all-zero id removed, complex columns as text."""
    df = upper_keys(records, ["id", "capacityId", "workspaceId"])
    df = df.withColumn("creatorUserPrincipalName", _col_or_null(df, "creatorPrincipal.userDetails.userPrincipalName"))
    df = df.dropDuplicates().filter(F.col("id") != ZERO_GUID)
    return stringify_complex(df)


# T3 -----------------------------------------------------------------------------
def build_workspaces(records: DataFrame, domains: DataFrame | None = None) -> DataFrame:
    """Workspaces silver: projection with defaults (description -> ''),
    upper-cased ids; with ``domains`` (id, capacityId, domainId) the
    DomainId is attached by workspace id."""
    from .flatten import project
    ws = project(records, {"id": "WorkspaceId", "name": "WorkspaceName", "type": "Type", "state": "State",
                           "capacityId": "CapacityId", "capacityMigrationStatus": "CapacityMigrationStatus",
                           "defaultDatasetStorageFormat": "DefaultDatasetStorageFormat", "description": "Description",
                           "isOnDedicatedCapacity": "IsOnDedicatedCapacity", "isReadOnly": "IsReadOnly",
                           "hasWorkspaceLevelSettings": "HasWorkspaceLevelSettings"},
                 {"Description": ""})
    ws = upper_keys(ws, ["WorkspaceId", "CapacityId"])
    if domains is not None:
        d = project(domains, {"id": "WorkspaceId", "domainId": "DomainId"}, {})
        # one domain per workspace; a repeated workspace keeps its least domain
        # (a fixed choice, aggregated per task before the shuffle)
        d = upper_keys(d, ["WorkspaceId", "DomainId"]).groupBy("WorkspaceId").agg(F.min("DomainId").alias("DomainId"))
        ws = ws.join(d, "WorkspaceId", "left")
    return ws


# T4 -----------------------------------------------------------------------------
def build_domains_silver(records: DataFrame) -> DataFrame:
    """Domain records renamed (DomainId, ParentDomainId, DomainName,
    DomainContributorsScope, DomainDescription), ids upper-cased."""
    ren = {"id": "DomainId", "parentDomainId": "ParentDomainId", "displayName": "DomainName",
           "contributorsScope": "DomainContributorsScope", "description": "DomainDescription"}
    df = records.withColumnsRenamed({a: b for a, b in ren.items() if a in records.columns})
    for c in ("ParentDomainId", "DomainContributorsScope"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return upper_keys(df, ["DomainId", "ParentDomainId"])


def build_domains(silver: DataFrame) -> DataFrame:
    """Domains flattened against their parent (self left join):
    MainDomainName (own name for a main domain, else the parent's),
    SubDomainName ('Without Subdomain' for main domains) and IsSubDomain 1/0."""
    parent = silver.select(F.col("DomainId").alias("_pid"), F.col("DomainName").alias("_pname"))
    j = silver.join(parent, silver["ParentDomainId"] == parent["_pid"], "left")
    sub = F.col("ParentDomainId").isNotNull()
    return j.select("DomainId", "DomainContributorsScope", F.col("DomainName").alias("OriginalDomainName"),
                    F.col("ParentDomainId").alias("OriginalParentDomainId"),
                    F.when(~sub, F.col("DomainName")).otherwise(F.col("_pname")).alias("MainDomainName"),
                    F.when(sub, F.col("DomainName")).otherwise(F.lit("Without Subdomain")).alias("SubDomainName"),
                    F.when(sub, 1).otherwise(0).alias("IsSubDomain"))


# T5 -----------------------------------------------------------------------------
def build_capacity_users(capacities: DataFrame) -> DataFrame:
    """(CapacityId, role, user): admins as 'Admin' UNION ALL users as
    'Contributor'.  Reads the capacities table (CapacityId) or raw records (id)."""
    cid = F.col("CapacityId") if "CapacityId" in capacities.columns else F.upper("id").alias("CapacityId")
    admins = capacities.select(cid, F.lit("Admin").alias("role"),
                               F.explode(_col_or_null(capacities, "admins", "array<string>")).alias("user"))
    users = capacities.select(cid, F.lit("Contributor").alias("role"),
                              F.explode(_col_or_null(capacities, "users", "array<string>")).alias("user"))
    return admins.unionByName(users)


# T6 -----------------------------------------------------------------------------
def build_enabled_security_groups(settings: DataFrame) -> DataFrame:
    """(settingName, TransferDateTime, graphId, name): one row per setting
    snapshot and enabled security group."""
    ts = F.col("TransferDateTime") if "TransferDateTime" in settings.columns else F.lit(None).cast("timestamp")
    g = settings.select("settingName", ts.alias("TransferDateTime"), F.explode("enabledSecurityGroups").alias("g"))
    return g.select("settingName", "TransferDateTime", F.col("g.graphId").alias("graphId"), F.col("g.name").alias("name"))


# T7 -----------------------------------------------------------------------------
def build_delegated_overrides(overrides: DataFrame) -> DataFrame:
    """Two-level explode of delegated tenant-setting overrides; the override
    id doubles as the capacity id."""
    s = overrides.select(F.col("id").alias("OverrideId"), F.explode("tenantSettings").alias("ts"))
    return s.select("OverrideId", F.col("OverrideId").alias("CapacityId"),
                    *[F.col(f"ts.{c}").alias(c) for c in ("tenantSettingGroup", "title", "delegatedFrom", "settingName",
                                                          "enabled", "canSpecifySecurityGroups")])


# T8 -----------------------------------------------------------------------------
def build_refreshables(records: DataFrame) -> dict[str, DataFrame]:
    """Refreshables split five ways: main, days, times, summaries and
    last-refresh details.  Optional summary columns may be absent."""
    ex = records.select(_col_or_null(records, "capacity.id").alias("_cap"), _col_or_null(records, "group.id").alias("_ws"),
                        "*")
    ex = ex.withColumns({"CapacityId": F.upper("_cap"), "WorkspaceId": F.upper("_ws"), "ItemId": F.upper("id")})
    keys = ["CapacityId", "WorkspaceId", "ItemId"]
    main = ex.select(*keys, F.col("name").alias("ItemName"),
                     _col_or_null(ex, "refreshSchedule.enabled", "boolean").alias("IsRefreshEnabled"),
                     _col_or_null(ex, "refreshSchedule.localTimeZoneId").alias("LocalTimeZoneId"),
                     _col_or_null(ex, "kind").alias("Kind")).dropDuplicates()
    days = ex.select(*keys, F.explode(_col_or_null(ex, "refreshSchedule.days", "array<string>")).alias("Day")).dropDuplicates()
    times = ex.select(*keys, F.explode(_col_or_null(ex, "refreshSchedule.times", "array<string>")).alias("Time")).dropDuplicates()
    st, en = _col_or_null(ex, "startTime"), _col_or_null(ex, "endTime")
    summ = ex.select(*keys, F.col("name").alias("ItemName"),
                     F.date_format(st, "yyyyMMdd").alias("ConsideredStartDateKey"),
                     date_slice(st).alias("ConsideredStartDate"), date_slice(en).alias("ConsideredEndDate"),
                     F.to_timestamp(st).alias("ConsideredStartTime"), F.to_timestamp(en).alias("ConsideredEndTime"),
                     _col_or_null(ex, "averageDuration", "double").alias("RefreshAverageDuration"),
                     _col_or_null(ex, "medianDuration", "double").alias("RefreshMedianDuration"),
                     _col_or_null(ex, "refreshCount", "long").alias("RefreshCount"))
    summ = summ.filter(F.col("ConsideredStartTime").isNotNull()
                       & (F.col("ConsideredEndDate").cast("string") != "0001-01-01"))  # a null end date goes too
    summ = summ.withColumn("ConsiderationDurationSeconds",
                           duration_s("ConsideredStartTime", "ConsideredEndTime")).dropDuplicates()
    lr = lambda f, t="string": _col_or_null(ex, f"lastRefresh.{f}", t)
    det = ex.select(*keys, F.col("name").alias("ItemName"), lr("requestId").alias("RequestId"),
                    F.date_format(lr("startTime"), "yyyyMMdd").alias("LastRefreshStartDateKey"),
                    lr("status").alias("Status"), lr("refreshType").alias("RefreshType"),
                    date_slice(lr("startTime")).alias("LastRefreshStartDate"),
                    date_slice(lr("endTime")).alias("LastRefreshEndDate"),
                    F.to_timestamp(lr("startTime")).alias("LastRefreshStartTime"),
                    F.to_timestamp(lr("endTime")).alias("LastRefreshEndTime"),
                    F.date_format(lr("startTime"), "H").alias("LastRefreshStartHour"),
                    F.date_format(lr("endTime"), "H").alias("LastRefreshEndHour"))
    det = det.filter(F.col("RequestId").isNotNull()).dropDuplicates()
    det = det.withColumn("DurationInSeconds", duration_s("LastRefreshStartTime", "LastRefreshEndTime"))
    return {"main": main, "days": days, "times": times, "summaries": summ, "details": det}


# capacities and Git connections ---------------------------------------------------
def build_capacities(records: DataFrame) -> DataFrame:
    """Capacities: every column of the records, the id as upper-case CapacityId; rows are kept as they come."""
    return records.withColumnRenamed("id", "CapacityId").withColumn("CapacityId", F.upper("CapacityId"))


def build_git_connections(records: DataFrame) -> DataFrame:
    """Git connections: workspace (upper case), repository and provider."""
    return records.select(F.upper("workspaceId").alias("workspaceId"),
                          _col_or_null(records, "gitProviderDetails.repositoryName").alias("repositoryName"),
                          _col_or_null(records, "gitProviderDetails.gitProviderType").alias("gitProviderType"))


# T9 -----------------------------------------------------------------------------
def build_widely_shared(records: DataFrame) -> DataFrame:
    """Widely-shared artifacts (published to web, organisation links): the
    item's displayName kept as ``item_displayName``, sharer fields promoted
    with a ``sharer_`` prefix, ``ItemId`` = upper-cased artifact id."""
    df = records.withColumnRenamed("displayName", "item_displayName") if "displayName" in records.columns else records
    df = promote(df, "sharer", ["displayName", "emailAddress", "graphId", "identifier", "principalType"], "sharer_")
    df = df.withColumn("ItemId", F.upper("artifactId")) if "artifactId" in df.columns else df
    return df.drop("artifactId")


# T10 ----------------------------------------------------------------------------
# The common shape of workspace items - dropped fields, renames,
# upper-cased ids (``{kind}`` is the item kind) and 10-character date slices.
COMMON_ITEM_DROP = ["users", "createdBy", "modifiedBy"]
COMMON_ITEM_RENAME = {"id": "{kind}Id", "name": "Name", "description": "Description", "state": "State",
                      "createdById": "CreatedById", "modifiedById": "ModifiedById",
                      "lastUpdatedDate": "LastUpdatedDateTime", "createdDate": "CreatedDateTime"}
COMMON_ITEM_UPPER = ["{kind}Id", "CreatedById", "ModifiedById"]
COMMON_ITEM_SLICES = {"CreatedDate": "CreatedDateTime", "LastUpdatedDate": "LastUpdatedDateTime"}

# One entry per child table - (scan array, item kind, key field, and
# for tables that differ from the common shape: drop, rename, upper, slices).
INVENTORY_TABLES = {
    "workspaces_scanned_users": dict(array="users", kind=None, key=None,
                                     drop=["emailAddress", "displayName"],
                                     rename={"groupUserAccessRight": "GroupUserAccessRight", "identifier": "Identifier",
                                             "graphId": "GraphId", "principalType": "PrincipalType",
                                             "userType": "UserType"},
                                     upper=[], slices={}),
    "datamarts": dict(array="datamarts", kind="Datamart", key="id",
                      drop=["configuredBy", "users", "modifiedBy"],
                      rename={"id": "DatamartId", "name": "Name", "configuredById": "ConfiguredById",
                              "modifiedById": "ModifiedById", "modifiedDateTime": "ModifiedDateTime", "type": "Type"},
                      upper=["DatamartId", "ConfiguredById", "ModifiedById"], slices={"ModifiedDateTime": "ModifiedDateTime"}),
    "semantic_models": dict(array="datasets", kind="SemanticModel", key="id",
                            drop=["configuredBy", "users", "tables", "datasourceUsages", "relations",
                                  "refreshSchedule.days", "refreshSchedule.times", "directQueryRefreshSchedule.days",
                                  "directQueryRefreshSchedule.times", "upstreamDatasets", "upstreamDatamarts",
                                  "misconfiguredDatasourceUsages"],
                            rename={"id": "SemanticModelId", "name": "Name", "configuredById": "ConfiguredById",
                                    "createdDate": "CreatedDateTime", "targetStorageMode": "StorageMode",
                                    "contentProviderType": "ContentProviderType"},
                            upper=["SemanticModelId", "ConfiguredById"], slices={"CreatedDate": "CreatedDateTime"}),
    "dataflows": dict(array="dataflows", kind="Dataflow", key="objectId",
                      drop=["configuredBy", "modifiedBy", "users", "datasourceUsages"],
                      rename={"objectId": "DataflowId", "name": "Name", "modifiedDateTime": "ModifiedDateTime",
                              "generation": "Generation"},
                      upper=["DataflowId"], slices={}),
    "reports": dict(array="reports", kind="Report", key="id",
                    drop=["createdBy", "modifiedBy", "relations", "datasourceUsages"],
                    rename={"id": "ReportId", "datasetId": "SemanticModelId", "datasetWorkspaceId": "SemanticModelWorkspaceId",
                            "reportType": "ReportType", "name": "Name", "createdDateTime": "CreatedDateTime",
                            "modifiedDateTime": "ModifiedDateTime", "modifiedById": "ModifiedById",
                            "createdById": "CreatedById", "originalReportObjectId": "OriginalReportObjectId",
                            "appId": "AppId"},
                    upper=["ReportId", "SemanticModelId", "ModifiedById", "CreatedById", "SemanticModelWorkspaceId",
                           "OriginalReportObjectId", "AppId"], slices={}),
    "dashboards": dict(array="dashboards", kind="Dashboard", key="id", drop=["users", "isReadOnly"],
                       rename={"id": "DashboardId", "displayName": "Name"}, upper=["DashboardId"], slices={}),
    "eventhouses": dict(array="Eventhouse", kind="Eventhouse", key="id"),
    "kql_databases": dict(array="KQLDatabase", kind="KQLDatabase", key="id", drop=["users"],
                          rename={"id": "KQLDatabaseId", "name": "Name", "description": "Description", "state": "State"},
                          upper=["KQLDatabaseId"], slices={}),
    "lakehouses": dict(array="Lakehouse", kind="Lakehouse", key="id"),
    "warehouses": dict(array="warehouses", kind="Warehouse", key="id", drop=["users", "configuredBy", "modifiedBy"],
                       rename={"id": "WarehouseId", "name": "Name", "description": "Description", "state": "State",
                               "configuredById": "ConfiguredById", "modifiedById": "ModifiedById",
                               "modifiedDateTime": "ModifiedDateTime"},
                       upper=["WarehouseId", "ConfiguredById"], slices={"ModifiedDate": "ModifiedDateTime"}),
    "eventstreams": dict(array="Eventstream", kind="Eventstream", key="id"),
    "pipelines": dict(array="DataPipeline", kind="Pipeline", key="id"),
    "notebooks": dict(array="Notebook", kind="Notebook", key="id"),
    "environments": dict(array="Environment", kind="Environment", key="id"),
    "reflexes": dict(array="Reflex", kind="Reflex", key="id"),
    "ml_models": dict(array="MLModel", kind="MLModel", key="id"),
}


def _spec(name: str) -> dict:
    sp = dict(INVENTORY_TABLES[name])
    k = sp.get("kind") or ""
    sp.setdefault("drop", COMMON_ITEM_DROP)
    sp.setdefault("rename", {a: b.format(kind=k) for a, b in COMMON_ITEM_RENAME.items()})
    sp.setdefault("upper", [u.format(kind=k) for u in COMMON_ITEM_UPPER])
    sp.setdefault("slices", COMMON_ITEM_SLICES)
    return sp


def build_inventory_table(workspaces: DataFrame, name: str) -> DataFrame:
    """One inventory child table: explode the item array under its workspace,
    flatten structs to dotted names, keep rows with a key (or any value when
    the element has no key), drop, rename, upper-case ids, add date slices;
    remaining arrays/structs become text.  Absent array -> empty table."""
    sp = _spec(name)
    t = child_table(workspaces, "id", sp["array"], parent_alias="WorkspaceId", id_col=sp["key"] or "id")
    t = t.drop(*[c for c in sp["drop"] if c in t.columns])
    t = t.withColumnsRenamed({a: b for a, b in sp["rename"].items() if a in t.columns})
    t = upper_keys(t, ["WorkspaceId", *sp["upper"]])
    for out, src in sp["slices"].items():
        if src in t.columns:
            t = t.withColumn(out, F.substr(F.col(src).cast("string"), F.lit(1), F.lit(10)))
    return stringify_complex(t)


# Scanned workspace fields and their table names.
SCANNED_WORKSPACE_COLUMNS = {"id": "WorkspaceId", "name": "WorkspaceName", "type": "Type", "state": "State",
                             "isOnDedicatedCapacity": "IsOnDedicatedCapacity", "capacityId": "CapacityId",
                             "domainId": "DomainId", "description": "Description",
                             "defaultDatasetStorageFormat": "StorageFormat"}


def build_scanned_workspaces(workspaces: DataFrame) -> DataFrame:
    """The scanned workspaces themselves: named fields (``DomainId`` only
    when the tenant uses domains), ids upper-cased, item arrays left to the
    child tables."""
    cols = [F.col(f"`{a}`").alias(b) for a, b in SCANNED_WORKSPACE_COLUMNS.items() if a in workspaces.columns]
    return upper_keys(workspaces.select(*cols), ["WorkspaceId", "CapacityId", "DomainId"])


def build_inventory_children(workspaces: DataFrame) -> dict[str, DataFrame]:
    """Every inventory child table of the tenant scan (16 specs, one job
    each; no driver-side pandas)."""
    return {name: build_inventory_table(workspaces, name) for name in INVENTORY_TABLES}


# T11 ----------------------------------------------------------------------------
def build_datasource_usages(workspaces: DataFrame) -> dict[str, DataFrame]:
    """Item -> data-source-instance usage tables: ``semantic_model_datasources``
    (WorkspaceId, SemanticModelId, datasourceInstanceId),
    ``dataflow_datasources`` (WorkspaceId, DataflowId, datasourceInstanceId;
    built as intended - the source's branch calls an undefined name) and
    ``report_datasources`` (ReportId, datasourceInstanceId).  Ids upper-cased,
    usages without an instance id dropped."""
    from .flatten import _has_path

    def usages(arr: str, key: str, out_key: str, with_ws: bool) -> DataFrame | None:
        if arr not in workspaces.columns:
            return None
        items = workspaces.select(F.upper("id").alias("WorkspaceId"), F.explode(arr).alias("it"))
        if not _has_path(items.schema, "it.datasourceUsages") or not _has_path(items.schema, f"it.{key}"):
            return None
        u = items.filter(F.col(f"it.{key}").isNotNull()).select(
            "WorkspaceId", F.upper(F.col(f"it.{key}")).alias(out_key), F.explode("it.datasourceUsages").alias("u"))
        u = u.filter(F.col("u.datasourceInstanceId").isNotNull())
        cols = (["WorkspaceId"] if with_ws else []) + [out_key]
        return u.select(*cols, F.upper("u.datasourceInstanceId").alias("datasourceInstanceId"))

    out = {"semantic_model_datasources": usages("datasets", "id", "SemanticModelId", True),
           "dataflow_datasources": usages("dataflows", "objectId", "DataflowId", True),
           "report_datasources": usages("reports", "id", "ReportId", False)}
    return {k: v for k, v in out.items() if v is not None}


# T12 ----------------------------------------------------------------------------
def build_datasource_instances(instances: DataFrame) -> DataFrame:
    """Distinct data-source instances: nested connection details flattened to
    dotted names, ids renamed and upper-cased, plus kind and connection
    string (P21)."""
    from .flatten import connection_string, flatten_structs
    flat = flatten_structs(instances)
    flat = flat.withColumnsRenamed({a: b for a, b in {"datasourceId": "DatasourceId", "datasourceType": "DatasourceType",
                                                      "gatewayId": "GatewayId"}.items() if a in flat.columns})
    flat = upper_keys(flat.distinct(), ["DatasourceId", "GatewayId"])
    return connection_string(flat)


def build_misconfigured_instances(instances: DataFrame) -> DataFrame:
    """Distinct misconfigured data-source instances, ids renamed and upper-cased."""
    from .flatten import flatten_structs
    flat = flatten_structs(instances)
    flat = flat.withColumnsRenamed({a: b for a, b in {"datasourceId": "DatasourceId",
                                                      "datasourceType": "DatasourceType"}.items() if a in flat.columns})
    return upper_keys(flat.distinct(), ["DatasourceId"])


# T13 ----------------------------------------------------------------------------
# Item arrays whose users are listed, and each type's own access-right field.
ITEM_USER_TYPES = {
    "reports": "reportUserAccessRight",
    "datasets": "datasetUserAccessRight",
    "dashboards": "dashboardUserAccessRight",
    "dataflows": "dataflowUserAccessRight",
    "datamarts": "datamartUserAccessRight",
    "Lakehouse": "artifactUserAccessRight",
    "Notebook": "artifactUserAccessRight",
    "DataPipeline": "artifactUserAccessRight",
    "Eventstream": "artifactUserAccessRight",
    "Environment": "artifactUserAccessRight",
    "MLModel": "artifactUserAccessRight",
    "Reflex": "artifactUserAccessRight",
    "KQLDatabase": "artifactUserAccessRight",
    "Eventhouse": "artifactUserAccessRight",
    "warehouses": "artifactUserAccessRight",
}


def build_item_users(workspaces: DataFrame) -> DataFrame:
    """Every user of every item of the listed types.

    Item id = ``id`` else ``objectId``; item name = ``name`` else
    ``displayName``; access right = the type's own field when non-empty,
    else the artifact right, else the group right.  Ids and graph ids are
    upper-cased, absent texts are empty strings, and rows whose item has
    neither id nor name are dropped.  One explode per type, unioned: no
    per-workspace loop on the driver."""
    from .flatten import _has_path
    parts = []
    for arr, right in ITEM_USER_TYPES.items():
        if arr not in workspaces.columns:
            continue
        items = workspaces.select(F.col("id").alias("_ws"), F.explode(arr).alias("it"))
        if not _has_path(items.schema, "it.users"):
            continue
        items = items.select("_ws", F.coalesce(_col_or_null(items, "it.id"), _col_or_null(items, "it.objectId")).alias("_iid"),
                             F.coalesce(_col_or_null(items, "it.name"), _col_or_null(items, "it.displayName")).alias("_iname"),
                             F.explode("it.users").alias("u"))
        txt = lambda f: F.coalesce(_col_or_null(items, f"u.{f}"), F.lit(""))
        own = _col_or_null(items, f"u.{right}")
        art = _col_or_null(items, "u.artifactUserAccessRight")
        access = (F.when(F.coalesce(own, F.lit("")) != "", own)
                  .when(art.isNotNull(), art)
                  .otherwise(txt("groupUserAccessRight")))
        parts.append(items.select(
            F.upper(F.coalesce(F.col("_ws"), F.lit(""))).alias("WorkspaceId"),
            F.upper(F.coalesce(F.col("_iid"), F.lit(""))).alias("ItemId"),
            F.lit(arr).alias("ItemType"), F.coalesce(F.col("_iname"), F.lit("")).alias("ItemName"),
            access.alias("AccessRight"), txt("emailAddress").alias("EmailAddress"),
            txt("displayName").alias("DisplayName"), txt("identifier").alias("Identifier"),
            F.upper(txt("graphId")).alias("GraphId"), txt("principalType").alias("PrincipalType"),
            txt("userType").alias("UserType")))
    if not parts:
        return workspaces.sparkSession.createDataFrame(
            [], "WorkspaceId string, ItemId string, ItemType string, ItemName string, AccessRight string, "
                "EmailAddress string, DisplayName string, Identifier string, GraphId string, PrincipalType string, "
                "UserType string")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter((F.col("ItemId") != "") | (F.col("ItemName") != ""))


# T14 ----------------------------------------------------------------------------
def build_semantic_model_metadata(workspaces: DataFrame) -> dict[str, DataFrame]:
    """Models, tables, columns, measures, partitions and the model -> data
    source bridge of the tenant scan, with chained SHA-256 keys:
    ``TableId = sha256(model-table)``, ``ColumnId = sha256(TableId-column)``,
    ``MeasureId = sha256(TableId-measure)``,
    ``PartitionId = sha256(TableId-expression)``.  Chained explodes only."""
    from .flatten import _has_path
    ds = workspaces.select(F.col("id").alias("WorkspaceId"), F.explode("datasets").alias("SemanticModel"))
    models = ds.select("WorkspaceId", F.col("SemanticModel.id").alias("SemanticModelId"),
                       F.col("SemanticModel.name").alias("SemanticModelName"))
    usage_t = "array<struct<datasourceInstanceId:string>>"
    bridge = ds.select(F.col("SemanticModel.id").alias("SemanticModelId"),
                       F.explode(_col_or_null(ds, "SemanticModel.datasourceUsages", usage_t)).alias("u")) \
        .select(F.col("u.datasourceInstanceId").alias("DatasourceInstanceId"), "SemanticModelId")
    tabs = ds.select(F.col("SemanticModel.id").alias("SemanticModelId"),
                     F.explode(_col_or_null(ds, "SemanticModel.tables", "array<struct<name:string>>")).alias("Table"))
    tabs = tabs.select("SemanticModelId", sha_key("SemanticModelId", F.col("Table.name")).alias("TableId"),
                       F.col("Table.name").alias("TableName"),
                       _col_or_null(tabs, "Table.isHidden", "boolean").alias("IsHidden"),
                       _col_or_null(tabs, "Table.storageMode").alias("StorageMode"), "Table")

    def child(arr: str, key_field: str, key_name: str, fields: dict[str, str]) -> DataFrame:
        if not _has_path(tabs.schema, f"Table.{arr}"):
            return tabs.select("TableId", F.lit(None).cast("string").alias(key_name),
                               *[F.lit(None).cast("string").alias(o) for o in fields.values()]).limit(0)
        x = tabs.select("TableId", F.explode(f"Table.{arr}").alias("x"))
        return x.select("TableId", sha_key("TableId", F.col(f"x.{key_field}")).alias(key_name),
                        *[_col_or_null(x, f"x.{f}").alias(o) for f, o in fields.items()])

    columns = child("columns", "name", "ColumnId", {"name": "ColumnName", "columnType": "ColumnType",
                                                    "dataType": "DataType", "isHidden": "isHidden",
                                                    "expression": "Expression"})
    measures = child("measures", "name", "MeasureId", {"name": "MeasureName", "isHidden": "IsHidden",
                                                       "expression": "Expression"})
    partitions = child("source", "expression", "PartitionId", {"expression": "Expression", "schemaName": "SchemaName"})
    return {"models": models, "tables": tabs.drop("Table"), "columns": columns, "measures": measures,
            "partitions": partitions, "datasource_bridge": bridge}


# T15 / T16 ------------------------------------------------------------------------
# Gateway report columns.
QUERY_EXECUTION_COLUMNS = ["GatewayObjectId", "RequestId", "DataSource", "QueryTrackingId", "QueryExecutionEndTimeUTC",
                           "QueryExecutionDuration(ms)", "QueryType", "DataReadingAndSerializationDuration(ms)",
                           "SpoolingDiskWritingDuration(ms)", "SpoolingDiskReadingDuration(ms)",
                           "SpoolingTotalDataSize(byte)", "DataProcessingEndTimeUTC", "DataProcessingDuration(ms)",
                           "Success", "ErrorMessage"]
QUERY_EXECUTION_AGG_COLUMNS = ["GatewayObjectId", "AggregationStartTimeUTC", "AggregationEndTimeUTC", "DataSource",
                               "Success", "AverageQueryExecutionDuration(ms)", "MaxQueryExecutionDuration(ms)",
                               "MinQueryExecutionDuration(ms)", "QueryType", "AverageDataProcessingDuration(ms)",
                               "MaxDataProcessingDuration(ms)", "MinDataProcessingDuration(ms)", "Count"]
QUERY_START_COLUMNS = ["GatewayObjectId", "RequestId", "QueryTrackingId", "DataSource", "QueryExecutionStartTimeUTC",
                       "QueryType", "QueryText", "EvaluationContext"]
MASHUP_COLUMNS = ["GatewayObjectId", "ConnectionId", "RequestId", "QueryTrackingId", "DataSource", "TotalRows",
                  "TotalBytes", "TotalProcessorTime(ms)", "EndTimeUTC", "AverageWorkingSet(byte)", "MaxWorkingSet(byte)",
                  "AverageCommit(byte)", "MaxCommit(byte)", "AveragePercentProcessorTime", "MaxPercentProcessorTime",
                  "AverageIODataBytesPerSecond", "MaxIODataBytesPerSecond"]
COUNTER_COLUMNS = ["GatewayObjectId", "AggregationStartTimeUTC", "AggregationEndTimeUTC", "CounterName", "Max", "Min",
                   "Average"]


def explode_datasource(df: DataFrame, col: str = "DataSource") -> DataFrame:
    """A JSON list of JSON-object texts -> one row per data source with
    ``DataSource.kind`` (kind, else ConnectorType) and ``DataSource.path``
    (path, else the other values after the first joined by ';').  Rows
    whose list does not parse are dropped."""
    # explode drops rows whose list is null (unparsable), so no extra filter is needed
    x = df.withColumn("_d", F.explode(F.from_json(F.col(col), "array<string>")))
    x = x.withColumn("_m", F.from_json(F.col("_d"), "map<string,string>"))
    kind = F.coalesce(F.col("_m")["kind"], F.col("_m")["ConnectorType"])
    vals = F.map_values("_m")
    rest = F.array_join(F.slice(vals, 2, F.greatest(F.size(vals) - 1, F.lit(0))), ";")
    path = F.coalesce(F.col("_m")["path"], F.when(F.size(vals) >= 1, rest))
    return x.withColumns({"DataSource.kind": kind, "DataSource.path": path}).drop("_d", "_m", col)


def _casts(df: DataFrame, longs=(), times=()) -> DataFrame:
    return df.withColumns({**{c: F.col(f"`{c}`").cast("long") for c in longs if c in df.columns},
                           **{c: F.to_timestamp(F.col(f"`{c}`")) for c in times if c in df.columns}})


def build_query_execution(logs: DataFrame) -> DataFrame:
    """Gateway query-execution fact (one row per request x data source)."""
    df = explode_datasource(logs)
    df = _casts(df, longs=[c for c in QUERY_EXECUTION_COLUMNS if c.endswith("(ms)") or c.endswith("(byte)")],
                times=["QueryExecutionEndTimeUTC", "DataProcessingEndTimeUTC"])
    return df.withColumns({"QueryExecutionEndDate": F.to_date("QueryExecutionEndTimeUTC"),
                           "RequestTrackingKey": text_key(["RequestId", "QueryTrackingId"]),
                           "SuccessStatus": yn_status("Success")})


def build_query_execution_aggregation(logs: DataFrame) -> DataFrame:
    """Aggregation-report fact, same data-source parsing, distinct rows."""
    df = explode_datasource(logs)
    df = _casts(df, longs=[c for c in QUERY_EXECUTION_AGG_COLUMNS if c.endswith("(ms)") or c == "Count"],
                times=["AggregationStartTimeUTC", "AggregationEndTimeUTC"])
    return df.withColumn("AggregationEndDate", F.to_date("AggregationEndTimeUTC")).distinct()


# T17-T20 ----------------------------------------------------------------------------
def build_query_start(logs: DataFrame) -> dict[str, DataFrame]:
    """Query-start fact, its data sources, decoded query texts,
    evaluation context (service, key, value), application context
    (report, visual, consumption method, session) and the per-request pivot
    of context keys."""
    key = text_key(["RequestId", "QueryTrackingId"]).alias("RequestTrackingKey")
    fact = _casts(logs.drop("QueryText", "EvaluationContext", "DataSource"), times=["QueryExecutionStartTimeUTC"])
    fact = fact.withColumns({"QueryExecutionStartDate": F.to_date("QueryExecutionStartTimeUTC"),
                             "RequestTrackingKey": text_key(["RequestId", "QueryTrackingId"])})
    sources = explode_datasource(logs.select("GatewayObjectId", "RequestId", "QueryTrackingId", "DataSource")) \
        .withColumn("RequestTrackingKey", text_key(["RequestId", "QueryTrackingId"]))
    texts = logs.select("RequestId", "QueryTrackingId", key, decode_b64_text("QueryText").alias("QueryText"))
    ctx_t = "struct<serviceTraceContexts:array<struct<serviceName:string,traceIds:array<struct<key:string,value:string>>>>>"
    pair_t = "array<struct<serviceName:string,key:string,value:string>>"

    def pairs(keep) -> DataFrame:
        """The context's (service, key, value) that ``keep`` lets through, chosen before they become rows."""
        parsed = F.from_json("EvaluationContext", ctx_t)["serviceTraceContexts"]
        of = lambda s: F.coalesce(F.transform(F.filter(s["traceIds"], lambda t: keep(t["key"])), lambda t: F.struct(
            s["serviceName"].alias("serviceName"), t["key"].alias("key"), t["value"].alias("value"))), F.array().cast(pair_t))
        return logs.select("GatewayObjectId", "RequestId", "QueryTrackingId", key, F.explode(F.flatten(F.transform(parsed, of))).alias("t")).select(
            "GatewayObjectId", "RequestId", "QueryTrackingId", "RequestTrackingKey", "t.*")

    evaluation = pairs(lambda k: k != "ApplicationContext")
    app_t = ("struct<DatasetId:string,Sources:array<struct<ReportId:string,VisualId:string,"
             "HostProperties:struct<ConsumptionMethod:string,UserSession:string>>>>")
    app = pairs(lambda k: k == "ApplicationContext").withColumn("v", F.from_json("value", app_t))
    app = app.select("GatewayObjectId", "RequestId", "QueryTrackingId", "RequestTrackingKey", "serviceName", "key",
                     F.col("v.DatasetId").alias("SemanticModelId"), F.explode_outer("v.Sources").alias("src"))
    app = app.select("GatewayObjectId", "RequestId", "QueryTrackingId", "RequestTrackingKey", "serviceName", "key",
                     "SemanticModelId", F.col("src.ReportId").alias("ReportId"), F.col("src.VisualId").alias("VisualId"),
                     F.col("src.HostProperties.ConsumptionMethod").alias("ConsumptionMethod"),
                     F.col("src.HostProperties.UserSession").alias("UserSession"))
    pivoted = lambda *keys: context_pivot(pairs(lambda k: k.isin(*keys)), list(keys))
    mapping = pivoted("DatasetId", "WorkspaceId").withColumnRenamed("DatasetId", "SemanticModelId")
    hosts = pivoted("Host Context Type")
    return {"fact": fact, "datasources": sources, "texts": texts, "evaluation_context": evaluation,
            "application_context": app, "service_mapping": mapping, "host_types": hosts}


def context_pivot(kv: DataFrame, keys: list[str], by: str = "RequestTrackingKey") -> DataFrame:
    """One row per tracked request, one column per context key (a pivot with the
    key list given, so no distinct-values pass).  A key repeated with
    different values keeps the greatest value."""
    return kv.filter(F.col("key").isin(keys)).groupBy(by).pivot("key", keys).agg(F.max("value"))


# T21 ----------------------------------------------------------------------------
def build_mashup_evaluation(logs: DataFrame) -> DataFrame:
    """Mashup evaluation fact: TotalRows list summed, end date, key."""
    longs = [c for c in MASHUP_COLUMNS if c.endswith("(byte)") or c.endswith("(ms)") or c == "TotalBytes"]
    df = _casts(logs, longs=longs, times=["EndTimeUTC"])
    return df.withColumns({"TotalRowsSum": sum_bracket_list("TotalRows"), "EndDate": F.to_date("EndTimeUTC"),
                           "RequestTrackingKey": text_key(["RequestId", "QueryTrackingId"])})


def build_system_counters(logs: DataFrame) -> DataFrame:
    """System counter fact with end date; numbers as double."""
    df = logs.withColumns({c: F.col(c).cast("double") for c in ("Max", "Min", "Average") if c in logs.columns})
    df = _casts(df, times=["AggregationStartTimeUTC", "AggregationEndTimeUTC"])
    return df.withColumn("AggregationEndDate", F.to_date("AggregationEndTimeUTC"))


# T22 ----------------------------------------------------------------------------
def build_sql_requests(history: DataFrame) -> DataFrame:
    """SQL request history with start date, start hour and 15-minute bin."""
    st = F.col("start_time").cast("timestamp")
    return history.withColumns({"start_date": F.to_date(st), "start_hour": F.hour(st),
                                "start_time_15min": time_bin(st, 15)})


# T23 ----------------------------------------------------------------------------
def build_calc_dependencies(deps: DataFrame, tables: DataFrame, object_types: DataFrame) -> DataFrame:
    """Calc dependencies with table ids of both ends and object-type
    names of both ends (4 left joins; the two enum joins broadcast)."""
    t = tables.select(F.col("Name").alias("_tn"), F.col("ID").alias("_tid"))
    ot = F.broadcast(object_types.select(F.col("Enum").alias("_oe"), F.col("Name").alias("_on")))
    j = (deps.join(t.withColumnsRenamed({"_tn": "_tn1", "_tid": "TableID"}), F.col("TABLE") == F.col("_tn1"), "left")
         .join(t.withColumnsRenamed({"_tn": "_tn2", "_tid": "ReferencedTableID"}),
               F.col("REFERENCED_TABLE") == F.col("_tn2"), "left")
         .join(ot.withColumnsRenamed({"_oe": "_oe1", "_on": "ObjectTypeName"}), F.col("OBJECT_TYPE") == F.col("_oe1"), "left")
         .join(ot.withColumnsRenamed({"_oe": "_oe2", "_on": "ReferencedObjectTypeName"}),
               F.col("REFERENCED_OBJECT_TYPE") == F.col("_oe2"), "left"))
    j = j.withColumn("DependencyKey", text_key(["TABLE", "OBJECT"], "-"))
    return j.drop("_tn1", "_tn2", "_oe1", "_oe2")


#: The marks that the query list puts before names and types.
QUERY_MARKS = {"parameter": "🎚️", "table": "📘", "expression": "✏️"}


# T24 / T25 ----------------------------------------------------------------------------
def build_query_list(expressions: DataFrame, partitions: DataFrame) -> DataFrame:
    """Partitions and expressions in one shape (OriginalName, Name,
    QueryGroupId, Type, Expression); repeated rows stay.

    ``partitions`` carry their TableName; an expression of type ``P`` is a
    parameter, any other a shared expression.
    """
    p = partitions.select(F.col("TableName").alias("OriginalName"), F.concat(F.lit(f"{QUERY_MARKS['table']} "), F.col("TableName")).alias("Name"),
                          F.col("QueryGroupID").alias("QueryGroupId"), F.lit(f"{QUERY_MARKS['table']} Table (Partitions)").alias("Type"),
                          F.col("QueryDefinition").alias("Expression"))
    is_parameter = F.col("ExpressionType") == "P"
    mark = F.when(is_parameter, QUERY_MARKS["parameter"]).otherwise(QUERY_MARKS["expression"])
    e = expressions.select(F.col("Name").alias("OriginalName"), F.concat_ws(" ", mark, F.col("Name")).alias("Name"),
                           F.col("QueryGroupID").alias("QueryGroupId"),
                           F.concat_ws(" ", mark, F.when(is_parameter, "Parameter").otherwise("Shared Expression")).alias("Type"), F.col("Expression"))
    return p.unionByName(e)


def build_folder_list(query_groups: DataFrame, default_folder: str = "(No folder)") -> DataFrame:
    """The default folder row combined with the query groups (ID and ModelID are texts)."""
    cols = ("ID", "ModelID", "Folder", "Description")
    default = query_groups.sparkSession.createDataFrame([("-1", None, default_folder, None)], ", ".join(f"{c} string" for c in cols))
    own = [F.col(c).cast("string").alias(c) if c in query_groups.columns else F.lit(None).cast("string").alias(c) for c in cols]
    return default.unionByName(query_groups.select(*own))


# T27 ----------------------------------------------------------------------------
def build_archive_candidates(items: DataFrame, workspaces: DataFrame, item_type: str,
                             workspace: str | None = None) -> DataFrame:
    """Live items of one type, optionally of the workspace of that exact
    name, with their workspace name, by workspace name descending."""
    i = items.filter((F.col("type") == item_type) & ~F.coalesce(F.col("is_deleted"), F.lit(False))) \
        if "is_deleted" in items.columns else items.filter(F.col("type") == item_type)
    j = i.join(workspaces.select(F.col("WorkspaceId").alias("workspaceId"), "WorkspaceName"), "workspaceId", "left")
    if workspace is not None:
        j = j.filter(F.col("WorkspaceName") == workspace)
    return j.orderBy(F.desc("WorkspaceName"), "name")

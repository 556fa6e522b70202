"""Table-building jobs on hand-made envelope and log fixtures."""

import base64
import datetime as dt
import json
import os

from conftest import rows
from govlake.operators import tables as T
from govlake.sources.envelope import read_envelope
from govlake.sources.logs import read_report_logs


def _env(spark, tmp_path, name, field, records):
    d = f"{tmp_path}/{name}"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/1.json", "w") as f:
        json.dump({field: records}, f, indent=1)
    return read_envelope(spark, d, [field])


def test_activities_and_aggregate(spark, tmp_path):
    recs = [{"Id": "e1", "CreationTime": "2024-01-29T10:05:00Z", "Activity": "ViewReport", "UserId": "u1",
             "ArtifactId": "a1", "CapacityId": "c1", "WorkspaceId": "w1", "ResultStatus": "Succeeded",
             "IsSuccess": True, "Extra": {"k": 1}},
            {"Id": "e2", "CreationTime": "2024-01-29T10:45:00Z", "Activity": "ViewReport", "UserId": "u2",
             "ObjectId": "o1", "CapacityId": "c1", "WorkspaceId": "w1", "IsSuccess": False},
            {"Id": "e3", "CreationTime": "2023-11-01T10:05:00Z", "Activity": "ViewReport", "UserId": "u1"}]
    acts = T.build_activities(_env(spark, tmp_path, "act", "activityEventEntities", recs))
    assert dict(acts.dtypes)["Extra"] == "string"
    r = {x["Id"]: x for x in acts.collect()}
    assert r["E1"]["CreationDate"] == dt.date(2024, 1, 29) and r["E1"]["CreationHour"] == "10" and r["E1"]["UserId"] == "U1"
    agg = T.build_aggregated_activities(acts, "2024-01-30", 30)
    got = rows(agg, ["item_id", "activity_status", "CountOfActivities", "DistinctCountOfUsers"])
    assert got == [("A1", "Succeeded", 1, 1), ("O1", "N/A", 1, 1)]


def test_items_workspaces_domains_capacities(spark, tmp_path):
    items = _env(spark, tmp_path, "items", "itemEntities", [
        {"id": "i1", "name": "n", "type": "Report", "workspaceId": "w", "capacityId": "c",
         "creatorPrincipal": {"userDetails": {"userPrincipalName": "me@x"}}},
        {"id": "i1", "name": "n", "type": "Report", "workspaceId": "w", "capacityId": "c",
         "creatorPrincipal": {"userDetails": {"userPrincipalName": "me@x"}}},
        {"id": "00000000-0000-0000-0000-000000000000", "name": "z", "type": "Report"}])
    ai = T.build_active_items(items)
    assert rows(ai, ["id", "creatorUserPrincipalName"]) == [("I1", "me@x")]
    ws = _env(spark, tmp_path, "ws", "value", [{"id": "w1", "name": "A", "capacityId": "c"}])
    dom = _env(spark, tmp_path, "wsd", "workspaces", [{"id": "w1", "domainId": "d1"}])
    w = T.build_workspaces(ws, dom).first()
    assert (w["WorkspaceId"], w["Description"], w["DomainId"]) == ("W1", "", "D1")
    d = _env(spark, tmp_path, "dom", "domains", [{"id": "p", "displayName": "Main"},
                                                 {"id": "s", "displayName": "Sub", "parentDomainId": "p"}])
    got = rows(T.build_domains(T.build_domains_silver(d)), ["DomainId", "MainDomainName", "SubDomainName", "IsSubDomain"])
    assert got == [("P", "Main", "Without Subdomain", 0), ("S", "Main", "Sub", 1)]
    cap = _env(spark, tmp_path, "cap", "value", [{"id": "c", "admins": ["a1"], "users": ["u1", "u2"]}])
    assert rows(T.build_capacity_users(cap), ["CapacityId", "user", "role"]) == [
        ("C", "a1", "Admin"), ("C", "u1", "Contributor"), ("C", "u2", "Contributor")]


def test_settings_overrides_shared(spark, tmp_path):
    s = _env(spark, tmp_path, "ten", "tenantSettings", [
        {"settingName": "x", "enabled": True, "enabledSecurityGroups": [{"graphId": "g", "name": "G"}]}])
    assert rows(T.build_enabled_security_groups(s), ["settingName", "graphId"]) == [("x", "g")]
    o = _env(spark, tmp_path, "del", "Overrides", [{"id": "c1", "tenantSettings": [
        {"settingName": "x", "enabled": True, "title": "t", "tenantSettingGroup": "g", "delegatedFrom": "Tenant",
         "canSpecifySecurityGroups": False}]}])
    assert rows(T.build_delegated_overrides(o), ["OverrideId", "CapacityId", "settingName"]) == [("c1", "c1", "x")]
    sh = _env(spark, tmp_path, "ptw", "ArtifactAccessEntities", [
        {"artifactId": "a", "displayName": "R", "sharer": {"displayName": "Me", "emailAddress": "m@x"}}])
    r = T.build_widely_shared(sh).first()
    assert (r["ItemId"], r["item_displayName"], r["sharer_emailAddress"]) == ("A", "R", "m@x")


def test_refreshables(spark, tmp_path):
    recs = [{"id": "i1", "name": "M", "kind": "Dataset", "capacity": {"id": "c"}, "group": {"id": "w"},
             "startTime": "2024-01-01T00:00:00Z", "endTime": "2024-01-08T00:00:00Z", "averageDuration": 10.5,
             "refreshSchedule": {"enabled": True, "days": ["Monday", "Friday"], "times": ["07:00"]},
             "lastRefresh": {"requestId": "q", "status": "Completed", "startTime": "2024-01-07T05:00:00Z",
                             "endTime": "2024-01-07T05:01:30Z"}},
            {"id": "i2", "name": "N", "kind": "Dataset", "capacity": {"id": "c"}, "group": {"id": "w"},
             "startTime": "2024-01-01T00:00:00Z", "endTime": "0001-01-01T00:00:00Z"}]
    out = T.build_refreshables(_env(spark, tmp_path, "ref", "value", recs))
    assert out["main"].count() == 2 and out["days"].count() == 2 and out["times"].count() == 1
    s = out["summaries"].collect()
    assert len(s) == 1 and s[0]["ConsiderationDurationSeconds"] == 7 * 86400 and s[0]["RefreshCount"] is None
    d = out["details"].first()
    assert (d["DurationInSeconds"], d["LastRefreshStartHour"]) == (90, "5")


def test_inventory_children_usages_users_metadata(spark, tmp_path):
    ws = [{"id": "w1", "name": "W", "users": [{"identifier": "u@x", "groupUserAccessRight": "Admin"}],
           "Lakehouse": [{"id": "lh1", "name": "L", "createdDate": "2024-03-04T01:02:03", "createdById": "ab"}],
           "reports": [{"id": "r1", "name": "R", "createdDate": "2024-01-02T00:00:00", "datasourceUsages": [
               {"datasourceInstanceId": "ds1"}], "users": [{"identifier": "a", "reportUserAccessRight": "Owner",
                                                             "artifactUserAccessRight": "Read"},
                                                            {"graphId": "g", "groupUserAccessRight": "Viewer"},
                                                            {"principalType": "App"}]}],
           "datasets": [{"id": "m1", "name": "M", "tables": [{"name": "T", "columns": [{"name": "c", "dataType": "Int64"}],
                                                               "measures": [{"name": "x", "expression": "1"}],
                                                               "source": [{"expression": "let"}]}],
                         "datasourceUsages": [{"datasourceInstanceId": "ds1"}]}]}]
    scan = _env(spark, tmp_path, "scan", "workspaces", ws)
    ch = T.build_inventory_children(scan)
    assert rows(ch["reports"], ["WorkspaceId", "ReportId", "Name"]) == [("W1", "R1", "R")]
    sw = T.build_scanned_workspaces(scan)
    assert sw.columns == ["WorkspaceId", "WorkspaceName"] and sw.first()["WorkspaceId"] == "W1"
    assert "datasourceUsages" not in ch["reports"].columns and "createdDate" in ch["reports"].columns
    sm = ch["semantic_models"].first()
    assert (sm["SemanticModelId"], sm["Name"]) == ("M1", "M") and "tables" not in ch["semantic_models"].columns
    assert rows(ch["workspaces_scanned_users"], ["WorkspaceId", "Identifier", "GroupUserAccessRight"]) == [
        ("W1", "u@x", "Admin")]
    lh = ch["lakehouses"].first()
    assert (lh["LakehouseId"], lh["CreatedById"], lh["CreatedDate"], lh["CreatedDateTime"]) == (
        "LH1", "AB", "2024-03-04", "2024-03-04T01:02:03")
    assert ch["notebooks"].count() == 0
    us = T.build_datasource_usages(scan)
    assert rows(us["semantic_model_datasources"]) == [("W1", "M1", "DS1")]
    assert rows(us["report_datasources"]) == [("R1", "DS1")]
    iu = T.build_item_users(scan)
    got = rows(iu, ["ItemId", "ItemType", "ItemName", "Identifier", "GraphId", "AccessRight", "PrincipalType"])
    assert got == [("R1", "reports", "R", "", "", "", "App"), ("R1", "reports", "R", "", "G", "Viewer", ""),
                   ("R1", "reports", "R", "a", "", "Owner", "")]
    md = T.build_semantic_model_metadata(scan)
    import hashlib
    sha = lambda *p: hashlib.sha256("-".join(p).encode()).hexdigest()
    t = md["tables"].first()
    assert (t["SemanticModelId"], t["TableName"], t["TableId"]) == ("m1", "T", sha("m1", "T"))
    c = md["columns"].first()
    assert (c["ColumnId"], c["DataType"]) == (sha(sha("m1", "T"), "c"), "Int64")
    assert md["measures"].first()["MeasureId"] == sha(sha("m1", "T"), "x")
    assert md["partitions"].first()["PartitionId"] == sha(sha("m1", "T"), "let")
    assert rows(md["datasource_bridge"], ["DatasourceInstanceId", "SemanticModelId"]) == [("ds1", "m1")]


def test_gateway_reports(spark, tmp_path):
    d = f"{tmp_path}/gw"
    os.makedirs(d)
    ds = '"[""{\\""kind\\"":\\""Sql\\"",\\""path\\"":\\""s;db\\""}"",""{\\""ConnectorType\\"":\\""Web\\"",\\""a\\"":\\""1\\"",\\""b\\"":\\""2\\""}""]"'
    with open(f"{d}/QueryExecutionReport_a.log", "w") as f:
        f.write("GatewayObjectId,RequestId,QueryTrackingId,DataSource,QueryExecutionEndTimeUTC,QueryExecutionDuration(ms),Success\n")
        f.write(f"g,r1,t1,{ds},2024-01-01T10:00:00,1500,Y\n")
        f.write("g,r2,t2,not json,2024-01-01T10:00:00,10,N\n")
    qe = T.build_query_execution(read_report_logs(spark, d, "QueryExecutionReport", T.QUERY_EXECUTION_COLUMNS))
    got = rows(qe, ["RequestTrackingKey", "DataSource.kind", "DataSource.path", "QueryExecutionDuration(ms)", "SuccessStatus"])
    assert got == [("r1t1", "Sql", "s;db", 1500, "Success"), ("r1t1", "Web", "1;2", 1500, "Success")]
    ctx = json.dumps({"serviceTraceContexts": [{"serviceName": "svc", "traceIds": [
        {"key": "DatasetId", "value": "m1"}, {"key": "WorkspaceId", "value": "w1"},
        {"key": "ApplicationContext", "value": json.dumps({"DatasetId": "m1", "Sources": [
            {"ReportId": "r", "VisualId": "v", "HostProperties": {"ConsumptionMethod": "Web", "UserSession": "s"}}]})}]}]})
    text = base64.b64encode(b"SELECT 1\nFROM t").decode()
    with open(f"{d}/QueryStartReport_a.log", "w") as f:
        f.write("GatewayObjectId,RequestId,QueryTrackingId,DataSource,QueryExecutionStartTimeUTC,QueryType,QueryText,EvaluationContext\n")
        f.write('g,r1,t1,"[]",2024-01-01T09:00:00,Q,' + text + ',"' + ctx.replace('"', '""') + '"\n')
    qs = T.build_query_start(read_report_logs(spark, d, "QueryStartReport", T.QUERY_START_COLUMNS))
    assert qs["texts"].first()["QueryText"] == "SELECT 1 FROM t"
    assert rows(qs["evaluation_context"], ["key", "value"]) == [("DatasetId", "m1"), ("WorkspaceId", "w1")]
    a = qs["application_context"].first()
    assert (a["SemanticModelId"], a["ReportId"], a["ConsumptionMethod"]) == ("m1", "r", "Web")
    m = qs["service_mapping"].first()
    assert (m["RequestTrackingKey"], m["SemanticModelId"], m["WorkspaceId"]) == ("r1t1", "m1", "w1")
    with open(f"{d}/MashupEvaluationReport_a.log", "w") as f:
        f.write("RequestId,QueryTrackingId,TotalRows,EndTimeUTC\nr1,t1,\"[1,2,3]\",2024-01-02T00:00:00\n")
    me = T.build_mashup_evaluation(read_report_logs(spark, d, "MashupEvaluationReport", T.MASHUP_COLUMNS)).first()
    assert (me["TotalRowsSum"], me["EndDate"]) == (6.0, dt.date(2024, 1, 2))


def test_model_metadata_tables(spark):
    deps = spark.createDataFrame([("MEASURE", "Sales", "Total", "COLUMN", "Sales", "Amount")],
                                 "OBJECT_TYPE string, TABLE string, OBJECT string, REFERENCED_OBJECT_TYPE string, "
                                 "REFERENCED_TABLE string, REFERENCED_OBJECT string")
    tabs = spark.createDataFrame([(1, "Sales")], "ID long, Name string")
    ot = spark.createDataFrame([("MEASURE", "Measure"), ("COLUMN", "Column")], "Enum string, Name string")
    r = T.build_calc_dependencies(deps, tabs, ot).first()
    assert (r["TableID"], r["ReferencedTableID"], r["ObjectTypeName"], r["DependencyKey"]) == (1, 1, "Measure", "Sales-Total")
    e = spark.createDataFrame([("P1", "x", "P", "g"), ("E1", "y", "M", None)], "Name string, Expression string, ExpressionType string, QueryGroupID string")
    p = spark.createDataFrame([("T", "let", "g"), ("T", "let", "g")], "TableName string, QueryDefinition string, QueryGroupID string")
    assert rows(T.build_query_list(e, p), ["Name", "QueryGroupId", "Type"]) == rows(spark.createDataFrame(
        [("📘 T", "g", "📘 Table (Partitions)")] * 2 + [("🎚️ P1", "g", "🎚️ Parameter"), ("✏️ E1", None, "✏️ Shared Expression")], "a string, b string, c string"))
    assert rows(T.build_folder_list(spark.createDataFrame([(1, 7, "F", "d")], "ID long, ModelID long, Folder string, Description string"))) == [
        ("-1", None, "(No folder)", None), ("1", "7", "F", "d")]
    h = spark.createDataFrame([("1", "2024-01-01 10:20:00")], "distributed_statement_id string, start_time string")
    rq = T.build_sql_requests(h).first()
    assert (rq["start_hour"], rq["start_time_15min"]) == (10, dt.datetime(2024, 1, 1, 10, 15))
    items = spark.createDataFrame([("a", "Report", "W1", False), ("b", "Report", "W2", True)],
                                  "name string, type string, workspaceId string, is_deleted boolean")
    wsp = spark.createDataFrame([("W1", "Prod"), ("W2", "Prod")], "WorkspaceId string, WorkspaceName string")
    assert rows(T.build_archive_candidates(items, wsp, "Report", "Prod"), ["name"]) == [("a",)]
    assert T.build_archive_candidates(items, wsp, "Report", "Pro").count() == 0


def test_datasource_instances(spark, tmp_path):
    inst = _env(spark, tmp_path, "dsi", "datasourceInstances", [
        {"datasourceId": "d1", "datasourceType": "Sql", "gatewayId": "g1",
         "connectionDetails": {"server": "srv", "database": "db"}},
        {"datasourceId": "d1", "datasourceType": "Sql", "gatewayId": "g1",
         "connectionDetails": {"server": "srv", "database": "db"}},
        {"datasourceId": "d2", "datasourceType": "Extension", "gatewayId": None,
         "connectionDetails": {"extensionDataSourceKind": "Databricks", "path": "p"}}])
    out = rows(T.build_datasource_instances(inst), ["DatasourceId", "GatewayId", "DatasourceKind", "ConnectionString"])
    assert out == [("D1", "G1", "Sql", "srv db"), ("D2", None, "Databricks", "Databricks p")]
    mis = _env(spark, tmp_path, "mis", "misconfiguredDatasourceInstances", [{"datasourceId": "x", "datasourceType": "Web"}])
    assert rows(T.build_misconfigured_instances(mis)) == [("X", "Web")]


def test_capacities_and_git_connections(spark):
    cap = T.build_capacities(spark.createDataFrame([("c1", "F64"), ("c1", "F64")], "id string, sku string"))
    assert rows(cap) == [("C1", "F64")] * 2
    git = spark.createDataFrame([("w1", ("repo", "GitHub", "main")), ("w2", None)],
                                "workspaceId string, gitProviderDetails struct<repositoryName:string,gitProviderType:string,branch:string>")
    assert rows(T.build_git_connections(git)) == sorted([("W1", "repo", "GitHub"), ("W2", None, None)], key=repr)

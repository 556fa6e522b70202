"""All tables of the scan in one pass equal the tables built one by one."""

import pytest

from conftest import SF_SMALL, rows
from govlake.operators import inventory as INV
from govlake.operators import tables as T
from govlake.plans.catalog_state import _inventory_scan


@pytest.fixture(scope="module")
def scan(spark):
    return _inventory_scan(spark, SF_SMALL)


@pytest.fixture(scope="module")
def made(scan, tmp_path_factory):
    return INV.demultiplex(scan, f"{tmp_path_factory.mktemp('inventory')}/t")


def test_tables_equal_the_single_builders(scan, made):
    assert set(made) == {*T.INVENTORY_TABLES, "item_users", *INV.USAGES}
    for name in T.INVENTORY_TABLES:
        want = T.build_inventory_table(scan, name)
        assert [(n, t) for n, t in made[name].dtypes] == [(n, t) for n, t in want.dtypes], name
        tick = [f"`{c}`" for c in want.columns]
        assert sorted(map(tuple, made[name].select(*tick).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr), name


def test_users_and_usages_equal_the_single_builders(scan, made):
    assert rows(made["item_users"], T.build_item_users(scan).columns) == rows(T.build_item_users(scan))
    for name, want in T.build_datasource_usages(scan).items():
        assert rows(made[name], want.columns) == rows(want)


def test_one_scan_and_nested_pruning(spark, scan, tmp_path):
    scan.write.parquet(f"{tmp_path}/scan")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(INV.tagged_rows(spark.read.parquet(f"{tmp_path}/scan"))).count("FileScan") == 1
    one = INV.demultiplex(spark.read.parquet(f"{tmp_path}/scan"), f"{tmp_path}/t")["lakehouses"]
    assert "ReadSchema: struct<lakehouses:struct<" in plan(one) and "semantic_models" not in plan(one).split("ReadSchema")[1]


def test_missing_arrays_nulls_and_empty_workspaces(spark, tmp_path):
    scan = spark.createDataFrame([("w1", [("a", "A", None)], None), ("w2", None, [(None, [("x", "Admin")])]), ("w3", [], [("d", None)])],
                                 "id string, reports array<struct<id:string,name:string,users:array<struct<identifier:string,reportUserAccessRight:string>>>>, "
                                 "dashboards array<struct<id:string,users:array<struct<identifier:string,groupUserAccessRight:string>>>>")
    made = INV.demultiplex(scan, f"{tmp_path}/t")
    assert set(made) == {"reports", "dashboards", "item_users"}
    assert rows(made["reports"], ["WorkspaceId", "ReportId"]) == [("W1", "A")] and rows(made["dashboards"], ["DashboardId"]) == [("D",)]
    assert made["item_users"].count() == 0  # the only user stands at an item with neither id nor name
    assert rows(T.build_item_users(scan)) == []
    with pytest.raises(ValueError):
        INV.tagged_rows(spark.createDataFrame([("w",)], "id string"))


def test_workspaces_are_dealt_to_all_tasks(spark):
    scan = _inventory_scan(spark, SF_SMALL)  # one file of a few bytes a key
    assert scan.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


def test_a_filter_on_the_table_goes_below_the_rows(spark, scan):
    made = INV.tagged_rows(scan).where("table = 'reports'").select("reports.*")
    lines = made._jdf.queryExecution().executedPlan().toString().splitlines()
    explodes = [i for i, x in enumerate(lines) if "Generate explode(" in x]
    kept = [i for i, x in enumerate(lines) if "Filter" in x and "= reports" in x]
    assert len(explodes) == 2 and len(kept) == 1 and explodes[0] < kept[0] < explodes[1]  # plans run from below

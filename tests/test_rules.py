"""Best-practice rules on a hand-made model."""

from conftest import rows
from govlake.operators import rules as B


def meta(spark):
    m = {
        "models": spark.createDataFrame([("M", False, False)], "ModelId string, IsDirectLake boolean, UsesView boolean"),
        "tables": spark.createDataFrame([
            ("M", "Sales", False, "", "", False, False, False, 30_000_000),
            ("M", "Date", False, "", "d", False, False, False, 10),
            ("M", "LocalDateTable_1", True, "", "", True, False, False, 10),
            ("M", "Calc", False, "", "", False, False, True, 0),
            ("M", "lower ", False, "", "x", False, False, False, 1)],
            "ModelId string, TableName string, IsHidden boolean, DataCategory string, Description string, "
            "IsCalculated boolean, IsFieldParameter boolean, IsCalculationGroup boolean, RowCount long"),
        "columns": spark.createDataFrame([
            ("M", "Sales", "Amount", "Double", "Data", False, True, False, None, "Sum", "", "", "", None, "amt"),
            ("M", "Sales", "Calc", "Int64", "Calculated", True, True, False, None, "None", "", "", "", "RELATED(x)", ""),
            ("M", "Sales", "DateKey", "Int64", "Data", False, True, False, None, "None", "", "", "d", None, "dk"),
            ("M", "Date", "DateKey", "Int64", "Data", False, True, False, None, "None", "", "", "d", None, "dk"),
            ("M", "Date", "MonthName", "String", "Data", False, True, False, "", "None", "", "", "d", None, "m")],
            "ModelId string, TableName string, ColumnName string, DataType string, Type string, IsHidden boolean, "
            "IsAvailableInMDX boolean, IsKey boolean, SortByColumn string, SummarizeBy string, FormatString string, "
            "DataCategory string, Description string, Expression string, SourceColumn string"),
        "measures": spark.createDataFrame([
            ("M", "Sales", "Total", "SUM(Sales[Amount]) + 0", False, "", "d"),
            ("M", "Sales", "Copy", "SUM( Sales[Amount] ) + 0", True, "#,0", "d"),
            ("M", "Sales", "Ratio", "[Total] / [Copy]", False, "0%", "d"),
            ("M", "Sales", "Alias", "[Total]", False, "#,0", "d"),
            ("M", "Sales", "ByShip", "CALCULATE([Total], USERELATIONSHIP('Sales'[ShipKey], 'Date'[DateKey]))", False, "#,0", "d")],
            "ModelId string, TableName string, MeasureName string, Expression string, IsHidden boolean, "
            "FormatString string, Description string"),
        "relationships": spark.createDataFrame([
            ("M", "Sales", "DateKey", "Date", "DateKey", "Many", "One", "BothDirections", True),
            ("M", "Sales", "Amount", "Date", "DateKey", "Many", "Many", "OneDirection", False),
            ("M", "Sales", "ShipKey", "Date", "DateKey", "Many", "One", "OneDirection", False)],
            "ModelId string, FromTable string, FromColumn string, ToTable string, ToColumn string, "
            "FromCardinality string, ToCardinality string, CrossFilteringBehavior string, IsActive boolean"),
        "partitions": spark.createDataFrame([
            ("M", "Sales", "p1", "Import", "M", 'let x = Table.Group("a")', None),
            ("M", "Date", "p1", "Dual", "M", "let", None)],
            "ModelId string, TableName string, PartitionName string, Mode string, SourceType string, "
            "Expression string, DataCoverageDefinition string"),
        "rls": spark.createDataFrame([("M", "Sales", "R", "[Email] = USERPRINCIPALNAME()"), ("M", "Date", "R2", "TRUE()")],
                                     "ModelId string, TableName string, RoleName string, FilterExpression string"),
        "hierarchies": spark.createDataFrame([], "ModelId string, TableName string, HierarchyName string, ColumnName string"),
        "calc_items": spark.createDataFrame([], "ModelId string, TableName string, ItemName string, Expression string"),
        "dependencies": spark.createDataFrame(
            [("M", "MEASURE", "Sales", "Ratio", "MEASURE", "Sales", "Total")],
            "ModelId string, ObjectType string, TableName string, ObjectName string, ReferencedObjectType string, "
            "ReferencedTable string, ReferencedObject string"),
    }
    return m


def test_rules_fire_where_expected(spark):
    v = B.bpa(meta(spark))
    got = {(r["RuleId"], r["ObjectName"]) for r in v.collect()}
    assert (1, "Amount") in got and (2, "Calc") in got and (16, "Calc") in got
    assert (3, "'Sales'[DateKey] -> 'Date'[DateKey]") in got
    assert (4, "R") in got and (11, "p1") in got and (9, "M") in got
    assert (14, "Total") in got and (32, "Total") in got and (32, "Copy") in got
    assert (31, "Alias") in got and (37, "Ratio") in got and (42, "Copy") in got
    assert (18, "LocalDateTable_1") in got and (19, "Date") in got and (20, "Sales") in got
    assert (22, "M") in got and (44, "Calc") in got and (54, "MonthName") in got
    assert (40, "'Sales'[Amount] -> 'Date'[DateKey]") in got and (55, "'Sales'[Amount] -> 'Date'[DateKey]") in got
    assert (52, "DateKey") in got and (53, "DateKey") in got and (58, "lower ") in got and (59, "lower ") in got
    assert (1, "DateKey") not in got and (31, "Total") not in got
    assert (40, "'Sales'[ShipKey] -> 'Date'[DateKey]") not in got and (27, "Date") in got and (27, "Sales") not in got
    assert not B.NOT_BUILT and len(B.RULES) == 60


def test_catalogue_and_counts(spark):
    cat = B.rule_catalogue(spark)
    assert cat.count() == 60
    counts = B.violation_counts(B.bpa(meta(spark)), cat).first()
    assert counts["violations"] == counts["severity_error"] + counts["severity_warning"] + counts["severity_info"]


def _brute_refs(measures, columns, deps):
    """Rules 38/39 per measure in plain Python: resolve references through the
    dependency rows, then search the expression text (Python ``re``)."""
    import re
    out = set()
    for (mid, t, name, e) in measures:
        for (dm, ot, dt, dn, rt, rtab, robj) in deps:
            if (dm, ot.upper(), dt, dn) != (mid, "MEASURE", t, name):
                continue
            if rt.upper() == "COLUMN" and (mid, rtab, robj) in {(c[0], c[1], c[2]) for c in columns}:
                tabs = [c[1] for c in columns if c[0] == mid and c[2] == robj]
                pat = "".join(r"(?<!" + re.escape(x) + r")(?<!'" + re.escape(x) + r"')" for x in tabs) + re.escape(f"[{robj}]")
                if re.search(pat, e):
                    out.add((38, name))
            if rt.upper() == "MEASURE":
                for (mm, pt, pn, _) in measures:
                    if mm == mid and pn == robj and (f"{pt}[{pn}]" in e or f"'{pt}'[{pn}]" in e):
                        out.add((39, name))
    return out


def test_qualified_reference_rules_match_brute_force(spark):
    measures = [
        ("M", "Sales", "Bare", "SUM([Amount])"),
        ("M", "Sales", "Qual", "SUM(Sales[Amount])"),
        ("M", "Sales", "Quoted", "SUM('Sales'[Amount]) + SUM('Fact.Sales (x)'[Qty])"),
        ("M", "Sales", "Suffix", "SUM(FactSales[Amount])"),
        ("M", "Sales", "Other", "SUM(Other[Amount])"),
        ("M", "Sales", "Mixed", "Sales[Amount] + [Amount]"),
        ("M", "Sales", "Unresolved", "SUM([Missing])"),
        ("M", "Sales", "Meta", "SUM([Qty])"),
        ("M", "Sales", "Total", "SUM(Sales[Amount])"),
        ("M", "Date", "UsesTotal", "Sales[Total] * 2"),
        ("M", "Date", "UsesTotalQ", "'Sales'[Total] * 2"),
        ("M", "Date", "UsesTotalBare", "[Total] * 2"),
        ("M", "Date", "WrongTable", "Date[Total] * 2"),
        ("N", "Sales", "Bare", "SUM([Amount])"),
    ]
    columns = [("M", "Sales", "Amount"), ("M", "FactSales", "Amount"), ("M", "Fact.Sales (x)", "Qty"),
               ("N", "Other", "Amount")]
    deps = [("M", "Measure", "Sales", n, "Column", "Sales", "Amount")
            for n in ("Bare", "Qual", "Quoted", "Suffix", "Other", "Mixed", "Total")]
    deps += [("M", "Measure", "Sales", "Unresolved", "Column", "Sales", "Missing"),
             ("M", "Measure", "Sales", "Meta", "Column", "Fact.Sales (x)", "Qty"),
             ("M", "Measure", "Sales", "Quoted", "Column", "Fact.Sales (x)", "Qty"),
             ("M", "Calc Column", "Sales", "Bare", "Column", "Sales", "Amount"),
             ("N", "Measure", "Sales", "Bare", "Column", "Sales", "Amount")]
    deps += [("M", "Measure", "Date", n, "Measure", "Sales", "Total")
             for n in ("UsesTotal", "UsesTotalQ", "UsesTotalBare", "WrongTable")]
    meta = {
        "measures": spark.createDataFrame(measures, "ModelId string, TableName string, MeasureName string, Expression string"),
        "columns": spark.createDataFrame(columns, "ModelId string, TableName string, ColumnName string"),
        "dependencies": spark.createDataFrame(
            deps, "ModelId string, ObjectType string, TableName string, ObjectName string, ReferencedObjectType string, "
                  "ReferencedTable string, ReferencedObject string"),
    }
    got = {(r["RuleId"], r["ObjectName"]) for r in B.bpa(meta, [38, 39]).collect()}
    want = _brute_refs(measures, columns, deps)
    assert got == want
    assert {(38, "Bare"), (38, "Other"), (38, "Mixed"), (38, "Meta"), (39, "UsesTotal"), (39, "UsesTotalQ")} <= got
    assert (38, "Qual") not in got and (38, "Suffix") not in got and (38, "Unresolved") not in got
    assert (39, "UsesTotalBare") not in got and (39, "WrongTable") not in got


def test_rule_47_needs_a_visible_summarised_number(spark):
    cols = spark.createDataFrame(
        [("M", "Sales", f"{t}{s}{h}", t, s, h) for t in ("Int64", "Decimal", "Double", "String") for s in ("Sum", "None") for h in (True, False)],
        "ModelId string, TableName string, ColumnName string, DataType string, SummarizeBy string, IsHidden boolean")
    m = {**meta(spark), "columns": cols}
    got = {r["ObjectName"] for r in B.bpa(m, [47]).collect()}
    assert got == {"Int64SumFalse", "DecimalSumFalse", "DoubleSumFalse"}

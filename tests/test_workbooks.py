"""Workbooks that the tasks write, and reports on runs."""

import os

import pytest
from pyspark.sql import functions as F

from tagloom.operators import reports, sheets
from tagloom.sources import workbooks, xlsx


def content(path):
    with open(path, "rb") as f:
        return dict(xlsx.sheets(f.read()))


def test_seven_sheets_round_trip_without_collect(spark, tmp_path, monkeypatch):
    assets = spark.createDataFrame(
        [(0, "P", "A", "K-V-201", "P.A.K-V-201", "NULL", "K-V-201", 0, "K-V-201", False), (0, "P", "A", "K-V-201", "P.A.K-V-201.S.T<1>", "S", "T<1>", 2, "K-V-201 > S > T<1>", False), (0, "P", "A", "X", "P.A.L", "NULL", '6IN-"a"&b', 0, "L", True), (1, "P", "A", "X", "P.A.X", "NULL", "X", 0, "X", False)],
        "drawing_id int, plant string, area string, system string, functional_location string, parent_equipment string, equipment string, level int, path string, piping boolean",
    )
    rels = spark.createDataFrame([(0, "b", "c", "part_of", "backbone", 0.5), (0, "a", "z", "controls", "edge", None)], "drawing_id int, parent string, child string, rel string, source string, confidence double")
    cross = spark.createDataFrame([(0, "D0", "t", "D1", "u", "continues_to")], "drawing_id int, source_drawing string, source_tag string, ref_drawing string, ref_tag string, relationship string")
    lone = spark.createDataFrame([(1, "X", "equipment", True, False, "no parent / no line; no system")], "drawing_id int, tag string, kind string, no_parent boolean, isolated boolean, reason string")
    figures = spark.createDataFrame([(d, k + 1, m, k * 10) for d in (0, 1) for k, m in enumerate(sheets.FIGURES)], "drawing_id int, ord int, metric string, value long")
    made = sheets.hierarchy_sheets(assets, rels, cross, lone, figures, F.lit("U1"))
    assert len(made) == 7
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.collect", lambda self: pytest.fail("collected"))
    books = workbooks.workbooks(workbooks.sheet_rows(made, assets), F.concat(F.lit("hierarchy-"), "drawing_id", F.lit(".xlsx")))
    workbooks.write_workbooks(spark, books, f"file://{tmp_path}/out")
    assert sorted(os.listdir(tmp_path / "out")) == ["_SUCCESS", "hierarchy-0.xlsx", "hierarchy-1.xlsx"]
    zero, one = content(tmp_path / "out/hierarchy-0.xlsx"), content(tmp_path / "out/hierarchy-1.xlsx")
    assert list(zero) == list(made)
    assert [r[5] for r in zero["Asset Hierarchy"]] == ["Equipment", "K-V-201", "T<1>"] and zero["Asset Hierarchy"][2][8] == "2"
    assert [r[0] for r in zero["Piping Lines"]] == ["Line Number", '6IN-"a"&b'] and one["Piping Lines"][1][1] == "No piping line numbers detected"
    assert zero["Parent Child Relationships"][1:] == [["a", "z", "controls", "edge", None], ["b", "c", "part_of", "backbone", "0.5"]]
    assert zero["Functional Location"][3][3:6] == ["K-V-201", "S", "T<1>"] or ["K-V-201", "S", "T<1>"] in [r[3:6] for r in zero["Functional Location"]]
    assert one["Cross Drawing References"][1] == ["—", "—", "—", "—", "No cross-drawing references detected on this sheet"]
    assert one["Orphan Nodes"][1] == ["X", "equipment", "YES", "", "YES", "", "no parent / no line; no system"] and zero["Orphan Nodes"][1][-1] == "No orphan nodes"
    assert [r[0] for r in one["Hierarchy Statistics"][1:]] == list(sheets.FIGURES) and one["Hierarchy Statistics"][3][1] == "20"


def test_validation_and_register_workbooks(spark, tmp_path):
    issues = spark.createDataFrame([(0, "Duplicate", "b", "HIGH", "r", "f"), (0, "Duplicate", "a", "LOW", None, "f"), (0, "Broken", "c", "HIGH", "r", "f")], "drawing_id int, issue string, node string, severity string, reason string, fix string")
    drawings = spark.createDataFrame([(0,), (1,)], "drawing_id int")
    made = sheets.validation_sheets(issues, drawings)
    books = workbooks.workbooks(workbooks.sheet_rows(made, drawings), F.concat(F.lit("v"), "drawing_id", F.lit(".xlsx")))
    workbooks.write_workbooks(spark, books, f"file://{tmp_path}/v")
    zero, one = content(tmp_path / "v/v0.xlsx"), content(tmp_path / "v/v1.xlsx")
    assert zero["Summary"] == [["Metric", "Count"], ["TOTAL ISSUES", "3"], ["Severity: HIGH", "2"], ["Severity: LOW", "1"], ["Type: Broken", "1"], ["Type: Duplicate", "2"]]
    assert [r[1] for r in zero["Validation Issues"]] == ["Node", "c", "a", "b"]
    assert one["Summary"] == [["Metric", "Count"], ["TOTAL ISSUES", "0"]] and one["Validation Issues"][1][3] == "No validation issues found"
    three = {n: (drawings.select("drawing_id", F.lit(n).alias("TAG NUMBER"), F.lit(float("nan")).alias("C"), F.array(F.lit(1)).alias("L"), F.lit("\x01x").alias("T")), ["TAG NUMBER"]) for n in ("AUTO_ACCEPT", "HUMAN_REVIEW", "SUMMARY")}
    workbooks.write_workbooks(spark, workbooks.workbooks(workbooks.sheet_rows(three, drawings), F.concat("drawing_id", F.lit(".xlsx"))), f"file://{tmp_path}/r")
    assert content(tmp_path / "r/0.xlsx")["HUMAN_REVIEW"] == [["TAG NUMBER", "C", "L", "T"], ["HUMAN_REVIEW", None, "[1]", "x"]]
    assert spark.read.format("binaryFile").load(f"file://{tmp_path}/r/*.xlsx").count() == 2


def test_long_sheets_go_on_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workbooks, "MOST_ROWS", 4)
    df = spark.range(8).select(F.lit(0).alias("drawing_id"), F.col("id").alias("n"))
    books = workbooks.workbooks(workbooks.sheet_rows({"Rows & more": (df, ["n"])}, df), F.lit("b.xlsx"))
    workbooks.write_workbooks(spark, books, f"file://{tmp_path}/p")
    got = content(tmp_path / "p/b.xlsx")
    assert got == {"Rows & more": [["n"], ["0"], ["1"], ["2"]], "Rows & more 2": [["n"], ["3"], ["4"], ["5"]], "Rows & more 3": [["n"], ["6"], ["7"]]}
    with pytest.raises(Exception, match="not a file"):
        workbooks.write_workbooks(spark, books.withColumn("file", F.lit("../x")), f"file://{tmp_path}/p")


def test_differences_of_runs(spark):
    a = spark.createDataFrame([(0, "x", 3), (0, "y", 1)], "d int, metric string, value long")
    b = spark.createDataFrame([(0, "x", 5), (1, "y", 2)], "d int, metric string, value long")
    assert {(r.d, r.metric): (r.before, r.after, r.change) for r in reports.difference(a, b, ["d", "metric"]).collect()} == {(0, "x"): (3, 5, 2), (0, "y"): (1, None, -1), (1, "y"): (None, 2, 2)}
    nodes = "d int, node int, kind string, equipment_parent string"
    before = spark.createDataFrame([(0, 1, "valve", None), (0, 2, "valve", "e"), (0, 3, "piping", None)], nodes)
    after = spark.createDataFrame([(0, 1, "valve", "e"), (0, 2, "valve", ""), (0, 4, "instrument", "f"), (0, 3, "piping", "e")], nodes)
    coverage, gained = reports.parents_gained(before, after, ["d"])
    assert [tuple(r) for r in coverage.collect()] == [(0, 1, 2, 3, 2, 1)] and {(r.node, r.equipment_parent) for r in gained.collect()} == {(1, "e"), (4, "f")}

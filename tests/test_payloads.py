"""What viewers, editors and readers get, documents and paths."""

import json

import pytest
from pyspark.sql import functions as F

from tagloom.functions import geometry as g
from tagloom.operators import payloads
from tagloom.sources import documents, workbooks, xlsx


def test_viewer_documents(spark):
    nodes = spark.createDataFrame([(0, "b", "T2", 1), (0, "a", "T1", 0)], "drawing_id int, id string, tag string, depth int")
    rels = spark.createDataFrame([(0, "a", "b", "part_of", "backbone")], "drawing_id int, parent string, child string, rel string, source string")
    meta = spark.createDataFrame([(0, "P"), (1, "Q")], "drawing_id int, plant string")
    got = {r.drawing_id: json.loads(r.document) for r in payloads.viewer_documents(nodes, rels, meta).collect()}
    assert got[0] == {"meta": {"plant": "P", "n_nodes": 2, "n_rels": 1}, "nodes": [{"id": "a", "tag": "T1", "depth": 0}, {"id": "b", "tag": "T2", "depth": 1}], "rels": [{"p": "a", "c": "b", "rel": "part_of", "src": "backbone"}]}
    assert got[1] == {"meta": {"plant": "Q", "n_nodes": 0, "n_rels": 0}, "nodes": [], "rels": []}


def test_thinning_keeps_the_last_corner(spark):
    def thin(n, most):
        pts = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.struct(i.cast("double").alias("x"), F.lit(0.0).alias("y")))
        return [int(p.x) for p in spark.range(1).select(g.simplify(pts, most)).first()[0]]

    assert thin(5, 5) == [1, 2, 3, 4, 5] and thin(6, 3) == [1, 3, 5, 6] and thin(7, 3) == [1, 3, 5, 7] and thin(7, 5) == [1, 2, 3, 4, 5, 6, 7]


def test_first_tips_and_summaries(spark):
    tips = spark.createDataFrame([(0, 1, 1, (0.0, 0.0)), (0, 2, 2, (10.0, 0.0)), (0, 3, 3, (20.0, 0.0)), (0, 4, 4, (34.9, 0.0))], "drawing_id int, id int, ord int, tip struct<x:double,y:double>")
    assert sorted(r.id for r in payloads.first_tips(tips).collect()) == [1, 3]
    rows = spark.createDataFrame([(0, "V-1", None, None, (1, 2, 3, 4), 0.5, None)], "drawing_id int, tag_text string, symbol_category string, symbol_bbox struct<x1:int,y1:int,x2:int,y2:int>, tag_bbox struct<x1:int,y1:int,x2:int,y2:int>, vision_confidence double, ocr_confidence double")
    made = payloads.candidate_summary(rows)
    assert made.first().bbox.x2 == 3
    assert made.select(payloads.miss_line()).first()[0] == '    V-1                None         vc=0.5 bbox={"x1":1,"y1":2,"x2":3,"y2":4}'
    two = spark.createDataFrame([([1, 2],), ([1, 2, 3],), (None,)], "polygon array<int>")
    assert payloads.whole_polygons(two).count() == 1


def test_documents_and_paths(spark, tmp_path):
    rows = spark.createDataFrame([(0, 1, "b", None), (0, 0, "a", 0.5), (1, 0, "c", 0.1)], "drawing_id int, ord int, tag_text string, ocr_confidence double")
    docs = documents.json_documents(rows, counts={"with_ocr": F.count("ocr_confidence")})
    got = {r.drawing_id: json.loads(r.document) for r in docs.collect()}
    assert got[0] == {"version": "1.0", "count": 2, "with_ocr": 1, "candidates": [{"tag_text": "a", "ocr_confidence": 0.5}, {"tag_text": "b"}]}
    files = docs.select(F.concat("drawing_id", F.lit(".json")).alias("file"), F.col("document").cast("binary").alias("content"))
    workbooks.write_workbooks(spark, files, f"file://{tmp_path}/docs")
    back = documents.read_records(spark, f"file://{tmp_path}/docs/*.json")
    assert sorted((r.drawing_id, r.ord, r.tag_text) for r in back.collect()) == [("0", 0, "a"), ("0", 1, "b"), ("1", 0, "c")]
    folder = f"file://{tmp_path}"
    assert documents.hierarchy_path(spark, folder) is None and documents.registry_path(spark, folder) is None
    (tmp_path / "hierarchy.json").write_text("{}")
    with pytest.warns(UserWarning, match="lack"):
        assert documents.hierarchy_path(spark, folder).endswith("/hierarchy.json")
    (tmp_path / "hierarchy_full.json").write_text("{}")
    assert documents.hierarchy_path(spark, folder).endswith("_full.json")
    (tmp_path / "tables_context.json").write_text("")
    (tmp_path / "r.xlsx").write_text("")
    assert documents.registry_path(spark, folder, "r.xlsx").endswith("tables_context.json")


def test_ground_truth_is_the_third_column_of_the_first_sheet(spark, tmp_path):
    one = spark.createDataFrame([("x", "y", " V-1 "), ("x", "y", None), ("x", "y", "")], "a string, b string, tag string")
    (tmp_path / "t.xlsx").write_bytes(xlsx.workbook({"First": one, "Second": one}))
    got = xlsx.ground_truth(xlsx.read_xlsx(spark, f"file://{tmp_path}/t.xlsx")).collect()
    assert [(r.ord, r.tag) for r in got] == [(2, "V-1")]

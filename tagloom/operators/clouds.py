"""Revision clouds: non-maximum suppression and nesting by exact shared areas, frames, and the documents that an editor's save leaves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import geometry as g
from tagloom.functions import polygons as p
from tagloom.operators.graph import greedy_keep
from tagloom.operators.spatial import grid_join
from tagloom.staging import staged

DK = ["drawing_id"]
# Overlap above which the less sure cloud goes, and the share inside another that makes an inner cloud.
MOST_IOU, LEAST_INSIDE = 0.35, 0.80
# Pixels around a cloud's mask.
MASK_PAD = 10
# Clouds are several hundred pixels wide: cells of their outlines are wider, so that few outlines are dealt to more than one or two.
CELL = 1000


def shared_areas(clouds: DataFrame, node: str = "id", by: list[str] = DK) -> DataFrame:
    """(by, a, b, both, area_a, area_b): the unordered pairs of polygons (id, polygon) that share an area, met behind the grid of their boxes; a is the smaller id."""
    p_ = F.col("polygon")
    rows = clouds.select(*by, node, p.flat(p_).alias("corners"), g.polygon_box(p_).alias("box"), g.polygon_area(p_).alias("area"))
    l, r = F.col("l"), F.col("r")
    pairs = grid_join(rows, rows, 0, cell=CELL, by=by).where(l[node] < r[node]).withColumn("both", p.flat_area(l["corners"], r["corners"]))
    return pairs.where("both > 1e-9").select(*by, l[node].alias("a"), r[node].alias("b"), "both", l["area"].alias("area_a"), r["area"].alias("area_b"))


def keep_and_nest(clouds: DataFrame, most_iou: float = MOST_IOU, least_inside: float = LEAST_INSIDE, by: list[str] = DK) -> DataFrame:
    """The clouds (id, ord, polygon, conf) that a greedy pass keeps, with tag: in order of confidence (null: 0.5), then ord, each goes that overlaps
    one kept before by more than most_iou; of those left one is inner if another holds at least least_inside of its area, else outer.

    Each pair's area is computed once for both steps. Polygons are simple and have an area; ids and ords are unique in a drawing."""
    found = staged(shared_areas(clouds, by=by), "shared")
    rank = F.struct(-F.coalesce("conf", F.lit(0.5)), "ord")
    of = clouds.select(*by, "id", rank.alias("rank"))
    tight = found.where(F.col("both") > most_iou * (F.col("area_a") + F.col("area_b") - F.col("both"))).select(*by, "a", "b")
    both = tight.join(of.select(*by, F.col("id").alias("a"), F.col("rank").alias("ra")), [*by, "a"]).join(of.select(*by, F.col("id").alias("b"), F.col("rank").alias("rb")), [*by, "b"])
    first = F.col("ra") < F.col("rb")
    kept = greedy_keep(clouds, both.select(*by, F.when(first, F.col("a")).otherwise(F.col("b")).alias("hi"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("lo")), by=by)
    inside = found.select(*by, F.col("a").alias("id"), F.col("b").alias("other"), (F.col("both") / F.col("area_a")).alias("share")).unionAll(found.select(*by, F.col("b").alias("id"), F.col("a").alias("other"), (F.col("both") / F.col("area_b")).alias("share"))).where(F.col("share") >= least_inside)
    inner = inside.join(kept.select(*by, F.col("id").alias("other")), [*by, "other"], "left_semi").select(*by, "id").distinct().withColumn("__inner", F.lit(True))
    return kept.join(inner, [*by, "id"], "left").withColumn("tag", F.when(F.col("__inner"), "inner").otherwise("outer")).drop("__inner")


def without_frames(clouds: DataFrame, width: Column, height: Column) -> DataFrame:
    """clouds (polygon) that aren't frames, borders or long pipes."""
    rows = clouds.withColumn("__hull", g.convex_hull(F.col("polygon"))).withColumn("__run", p.straight_run(F.col("polygon")))
    return rows.where(~p.is_frame(F.col("__run"), g.scallopedness(F.col("polygon"), F.col("__hull")), width, height)).select(clouds.columns)


def _points(points: Column, x, y) -> Column:
    return F.transform(points, lambda q: F.struct(x(q["x"]).cast("int").alias("x"), y(q["y"]).cast("int").alias("y")))


def saved_clouds(payload: DataFrame, by: list[str] = DK) -> DataFrame:
    """The clouds of an editor's save: payload (by, clouds array<struct<id, source, confidence, status, polygon_json, polygon_img, polygon_display>>,
    scale_j2i, display_scale, image_w, image_h), polygons being arrays of x and y, as (by, place, id, tag, source, confidence, bbox, area, scallopedness,
    polygon, status, polygon_img, mask_bbox, mask_shape), a row for each cloud.

    An approved cloud keeps its polygon in the document's coordinates, cut to whole numbers; another's comes from the image's, else the display's, by
    the scales, rounded half to even. Scales apply to what was given, not to what was rounded before."""
    def rounded(by_what: Column):
        return lambda v: F.bround(v * by_what)

    cut = lambda v: v.cast("int")
    c = F.col("c")
    j2i, d2i = F.col("scale_j2i"), 1 / F.col("display_scale")
    i2j = 1 / j2i
    status = F.coalesce(c["status"], F.lit("approved"))
    whole, image = F.coalesce(F.size(c["polygon_json"]), F.lit(0)) > 0, F.coalesce(F.size(c["polygon_img"]), F.lit(0)) > 0
    rows = payload.select(*by, "scale_j2i", "display_scale", "image_w", "image_h", F.posexplode("clouds").alias("place", "c"))
    as_is = (status == "approved") & whole
    polygon = F.when(as_is, _points(c["polygon_json"], cut, cut)).when(image, _points(c["polygon_img"], rounded(i2j), rounded(i2j))).otherwise(_points(c["polygon_display"], rounded(d2i * i2j), rounded(d2i * i2j)))
    img = F.when(as_is, _points(c["polygon_json"], rounded(j2i), rounded(j2i))).when(image, _points(c["polygon_img"], cut, cut)).otherwise(_points(c["polygon_display"], rounded(d2i), rounded(d2i)))
    made = rows.withColumn("polygon", polygon).withColumn("polygon_img", img).withColumn("__hull", g.convex_hull(F.transform("polygon", lambda q: F.struct(q["x"].cast("double").alias("x"), q["y"].cast("double").alias("y")))))
    b, m = g.polygon_box(F.col("polygon")), g.polygon_box(F.col("polygon_img"))
    mask = F.array(F.greatest(F.lit(0), m["x1"] - MASK_PAD), F.greatest(F.lit(0), m["y1"] - MASK_PAD), F.least("image_w", m["x2"] + MASK_PAD), F.least("image_h", m["y2"] + MASK_PAD))
    shape = F.array(F.greatest(F.lit(1), F.get("mask_bbox", F.lit(3)) - F.get("mask_bbox", F.lit(1))), F.greatest(F.lit(1), F.get("mask_bbox", F.lit(2)) - F.get("mask_bbox", F.lit(0))))
    bumps = F.round(g.scallopedness(F.col("polygon"), F.col("__hull")), 3)
    out = made.select(*by, "place", c["id"].alias("id"), F.lit("outer").alias("tag"), F.coalesce(c["source"], F.lit("manual_add")).alias("source"), F.round(F.coalesce(c["confidence"], F.lit(1.0)), 3).alias("confidence"), F.array(b["x1"], b["y1"], b["x2"], b["y2"]).alias("bbox"), F.round(g.polygon_area(F.col("polygon")), 1).alias("area"), bumps.alias("scallopedness"), "polygon", status.alias("status"), "polygon_img", mask.alias("mask_bbox"))
    return out.withColumn("mask_shape", shape)


def saved_documents(payload: DataFrame, saved: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, clouds, stats, edit_metadata): a document for each save, its clouds in the payload's order; payload also has json_w, json_h and edit_summary
    struct<original_count, deleted, added, modified, merged>, whose nulls are 0. A save without clouds has an empty array."""
    columns = ["id", "tag", "source", "confidence", "bbox", "area", "scallopedness", "polygon", "status", "mask_bbox", "mask_shape"]
    kind = saved.select(F.struct(*columns)).schema[0].dataType.simpleString()
    arrays = saved.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", F.struct(*columns).alias("c")))), lambda z: z["c"]).alias("clouds"))
    e = F.col("edit_summary")
    n = {k: F.coalesce(e[k], F.lit(0)) for k in ("original_count", "deleted", "added", "modified", "merged")}
    kept = F.greatest(F.lit(0), n["original_count"] - n["deleted"] - n["modified"] - n["merged"])
    meta = F.struct(F.lit("human_in_the_loop").alias("workflow"), n["original_count"].alias("original_auto_detected"), kept.alias("approved_unchanged"), *[n[k].alias(k) for k in ("deleted", "added", "modified", "merged")], F.array("image_w", "image_h").alias("image_file_size"))
    rows = payload.select(*by, "json_w", "json_h", meta.alias("edit_metadata")).join(arrays, by, "left").withColumn("clouds", F.coalesce("clouds", F.array().cast(f"array<{kind}>")))
    total = F.size("clouds")
    return rows.select(*by, "clouds", F.struct(total.alias("total"), total.alias("outer"), F.lit(0).alias("inner"), F.array("json_w", "json_h").alias("image_size")).alias("stats"), "edit_metadata")

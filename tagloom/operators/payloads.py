"""What people and viewers read: an editor's payload, a viewer's document, the scope as text, a comparison's report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import geometry as g

DK = ["drawing_id"]
# The width at which an editor shows a sheet, and the corners of an outline there.
DISPLAY_WIDTH, MOST_POINTS = 2400, 120


def whole_polygons(clouds: DataFrame) -> DataFrame:
    """clouds (polygon) with three corners or more."""
    return clouds.where(F.coalesce(F.size("polygon"), F.lit(0)) >= 3)


def editor_clouds(clouds: DataFrame, width: int = DISPLAY_WIDTH, most: int = MOST_POINTS, by: list[str] = DK) -> DataFrame:
    """(by, id, tag, source, confidence, scallopedness, area_json, point_count, bbox, bbox_img, polygon, polygon_img, polygon_json): outer clouds (id, tag, source,
    confidence, scallopedness, area, bbox, polygon, scale_j2i, image_w) as an editor gets them: scaled to the image and rounded half to even, thinned, and scaled to the display to a tenth."""
    j2i, shown = F.col("scale_j2i"), F.lit(float(width)) / F.col("image_w")
    full = F.transform("polygon", lambda p: F.struct(F.bround(p["x"] * j2i).cast("int").alias("x"), F.bround(p["y"] * j2i).cast("int").alias("y")))
    rows = clouds.where("tag = 'outer'").withColumn("__img", g.simplify(full, most)).withColumn("__box", F.transform("bbox", lambda v: F.bround(v * j2i).cast("int")))
    polygon = F.transform("__img", lambda p: F.struct(F.bround(p["x"] * shown, 1).alias("x"), F.bround(p["y"] * shown, 1).alias("y")))
    return rows.select(
        *by, "id", "tag", F.coalesce("source", F.lit("unknown")).alias("source"), F.round(F.coalesce("confidence", F.lit(0.8)), 3).alias("confidence"), F.round(F.coalesce("scallopedness", F.lit(0.0)), 3).alias("scallopedness"),
        F.round(F.coalesce("area", F.lit(0.0)), 1).alias("area_json"), F.size("polygon").alias("point_count"), F.transform("__box", lambda v: F.bround(v * shown, 1)).alias("bbox"), F.col("__box").alias("bbox_img"), polygon.alias("polygon"), F.col("__img").alias("polygon_img"), F.col("polygon").alias("polygon_json"),
    )


def viewer_documents(nodes: DataFrame, relations: DataFrame, meta: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, document): a JSON text for each drawing of meta (its columns, and the numbers of its nodes and relations): nodes (id and whatever a viewer shows) by id, relations (parent, child, rel, source) by parent and child."""
    fields = [c for c in nodes.columns if c not in by]
    n = nodes.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*sorted(fields, key=lambda c: c != "id")))).alias("nodes"))
    r = relations.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col("parent").alias("p"), F.col("child").alias("c"), "rel", F.col("source").alias("src")))).alias("rels"))
    rows = meta.join(n, by, "left").join(r, by, "left")
    told = F.struct(*[F.col(c) for c in meta.columns if c not in by], F.coalesce(F.size("nodes"), F.lit(0)).alias("n_nodes"), F.coalesce(F.size("rels"), F.lit(0)).alias("n_rels"))
    return rows.select(*by, F.to_json(F.struct(told.alias("meta"), F.coalesce("nodes", F.from_json(F.lit("[]"), n.schema["nodes"].dataType)).alias("nodes"), F.coalesce("rels", F.from_json(F.lit("[]"), r.schema["rels"].dataType)).alias("rels"))).alias("document"))


def scope_summary(scope: DataFrame) -> DataFrame:
    """(part, ord, line): the scope's symbols (ord, name, status, prefix) as lines: their numbers, those allowed with their prefixes, and those blocked."""
    head = scope.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "ALLOW").alias("a"), F.count_if(F.col("status") == "BLOCK").alias("b"))
    first = head.select(F.lit(0).alias("part"), F.lit(0).cast("long").alias("ord"), F.format_string("Total symbols: %d (%d ALLOW | %d BLOCK)", "n", "a", "b").alias("line"))
    tag = F.when(F.coalesce("prefix", F.lit("")) != "", F.concat(F.lit("["), "prefix", F.lit("]"))).otherwise("")
    allowed = scope.where("status = 'ALLOW'").select(F.lit(1).alias("part"), F.col("ord").cast("long"), F.concat(F.lit("  ✓ "), F.when(F.length(tag) < 8, F.lpad(tag, 8, " ")).otherwise(tag), F.lit("  "), "name").alias("line"))
    blocked = scope.where("status = 'BLOCK'").select(F.lit(2).alias("part"), F.col("ord").cast("long"), F.concat(F.lit("  ✗           "), "name").alias("line"))
    return first.unionAll(allowed).unionAll(blocked)


def candidate_summary(rows: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, tag_text, symbol_category, bbox, vision_confidence, ocr_confidence), the box being the symbol's, else the tag's."""
    return rows.select(*by, "tag_text", "symbol_category", F.coalesce("symbol_bbox", "tag_bbox").alias("bbox"), "vision_confidence", "ocr_confidence")


def miss_line() -> Column:
    """A report's line for a row of `candidate_summary`."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("None"))

    def wide(c: Column, n: int) -> Column:
        return F.when(F.length(c) < n, F.rpad(c, n, " ")).otherwise(c)

    return F.concat(F.lit("    "), wide(text("tag_text"), 18), F.lit(" "), wide(text("symbol_category"), 12), F.lit(" vc="), text("vision_confidence"), F.lit(" bbox="), F.coalesce(F.to_json("bbox"), F.lit("None")))


def first_tips(rows: DataFrame, least: float = 15, by: list[str] = DK) -> DataFrame:
    """rows (id, ord, tip), tips being points of x and y, without those less than `least` from the tip of one that stays; in order of ord the first stay."""
    from tagloom.operators.dedup import suppress

    p = F.col("tip")
    spots = rows.withColumn("box", F.struct(p["x"].alias("x1"), p["y"].alias("y1"), p["x"].alias("x2"), p["y"].alias("y2")))
    return suppress(spots, ["ord"], lambda a, b: g.center_distance(a["box"], b["box"]) < least, least, by).drop("box")


def in_patch_order(rows: DataFrame, by: list[str] = DK) -> DataFrame:
    """rows (patch_id, ord) with `place`, from 0: by patch (null: 0), then ord."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(F.coalesce("patch_id", F.lit(0)), "ord")) - 1)


def distinct_in_order(rows: DataFrame, value: str, by: list[str] = DK) -> DataFrame:
    """(by, value, place): the distinct values (value, ord) of a drawing in the order in which they first occur, from 0."""
    first = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.min("ord").alias("__at"))
    return first.select(*by, value, (F.row_number().over(Window.partitionBy(*by).orderBy("__at")) - 1).alias("place"))

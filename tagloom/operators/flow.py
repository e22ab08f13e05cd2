"""Flow directions of pipelines: equipment conventions, dead legs, answers, directed edges; continuation of lines and links to them.

A pipeline's axis has ends a and b (structs of x and y); forward is from a to b. Every step only fills directions that are unknown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import geometry as g
from tagloom.operators.graph import component_of
from tagloom.operators.spatial import grid_join, least_distances

DK = ["drawing_id"]
# Direction words and their unit vectors; y grows downwards.
WORDS = {"left_to_right": (1.0, 0.0), "right_to_left": (-1.0, 0.0), "top_to_bottom": (0.0, 1.0), "bottom_to_top": (0.0, -1.0)}
# Tags whose discharge is on the right.
COMPRESSORS = ("K-V-201", "KG-V-201", "KM-V-201")
SYMBOLS = ("instrument", "valve", "piping", "equipment")


def _distance(p: Column, x: Column, y: Column) -> Column:
    return F.sqrt((p["x"] - x) * (p["x"] - x) + (p["y"] - y) * (p["y"] - y))


def _nearer(x: Column, y: Column) -> Column:
    """Which end of the axis is nearer: A unless b is strictly closer."""
    return F.when(_distance(F.col("a"), x, y) <= _distance(F.col("b"), x, y), "A").otherwise("B")


def equipment_conventions(equipment: DataFrame, axes: DataFrame, radius: float = 90, compressors: tuple[str, ...] = COMPRESSORS, by: list[str] = DK) -> DataFrame:
    """(by, equipment, line, end, outgoing, direction): lines (line, a, b) with an end (a before b) in the box of equipment (id, tag, box) grown by radius.

    Compressors discharge on their right, other equipment at its bottom; an outgoing line flows away from the equipment's end, any other towards it."""
    def spot(p: str) -> Column:
        return F.struct(F.col(p)["x"].alias("x1"), F.col(p)["y"].alias("y1"), F.col(p)["x"].alias("x2"), F.col(p)["y"].alias("y2"))

    ends = axes.select(*by, "line", F.explode(F.array(F.struct(F.lit("A").alias("end"), spot("a").alias("box")), F.struct(F.lit("B").alias("end"), spot("b").alias("box")))).alias("e")).select(*by, "line", "e.end", "e.box")
    met = grid_join(equipment.select(*by, "id", "tag", "box"), ends, radius, by=by)
    first = met.groupBy(*by, F.col("l.id").alias("equipment"), F.col("r.line").alias("line")).agg(F.min(F.struct(F.col("r.end").alias("end"), F.col("r.box.x1").alias("x"), F.col("r.box.y1").alias("y"))).alias("e"), F.first("l.tag").alias("tag"), F.first("l.box").alias("box"))
    cx, cy = g.center(F.col("box"))
    out = F.when(F.coalesce(F.col("tag"), F.lit("")).isin(*compressors), F.col("e.x") >= cx).otherwise(F.col("e.y") >= cy + (F.col("box.y2") - F.col("box.y1")) * 0.15)
    direction = F.when(out == (F.col("e.end") == "A"), "forward").otherwise("reverse")
    return first.select(*by, "equipment", "line", F.col("e.end").alias("end"), out.alias("outgoing"), direction.alias("direction"))


def fill_directions(known: DataFrame, found: DataFrame, evidence: str, order: list[str], by: list[str] = DK) -> DataFrame:
    """known (line, direction, evidence) with the first direction in order that found (line, direction, ...) has for each line whose own is unknown."""
    first = found.groupBy(*by, "line").agg(F.min_by("direction", F.struct(*order)).alias("__d"))
    open_ = F.col("direction") == "unknown"
    out = known.join(first, [*by, "line"], "left")
    take = open_ & F.col("__d").isNotNull()
    return out.select(*by, "line", F.when(take, F.col("__d")).otherwise(F.col("direction")).alias("direction"), F.when(take, evidence).otherwise(F.col("evidence")).alias("evidence"))


def line_links(edges: DataFrame, nodes: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, line, node, rel, kind): what graph edges (a, b, rel) tie to each pipeline, whichever end it is. nodes: (node, kind)."""
    k = nodes.select(*by, "node", "kind")
    both = edges.select(*by, F.col("a").alias("line"), F.col("b").alias("node"), "rel").unionAll(edges.select(*by, F.col("b").alias("line"), F.col("a").alias("node"), "rel"))
    lines = k.where("kind = 'pipeline'").select(*by, F.col("node").alias("line"))
    return both.join(lines, [*by, "line"]).join(k, [*by, "node"]).where(F.col("kind").isin(*SYMBOLS)).select(*by, "line", "node", "rel", "kind")


def connected_ends(axes: DataFrame, junctions: DataFrame, links: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, line, end, kinds): what is tied to each end: a junction (line, x, y), equipment, or a symbol CONNECTED_TO (links: line, rel, kind, box), at the end that is nearer to it."""
    x, y = g.center(F.col("box"))
    points = junctions.select(*by, "line", F.lit("junction").alias("what"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    what = F.when(F.col("kind") == "equipment", "equipment").when(F.col("rel") == "CONNECTED_TO", "candidate")
    more = links.where("box IS NOT NULL").select(*by, "line", what.alias("what"), x.cast("double").alias("x"), y.cast("double").alias("y")).where("what IS NOT NULL")
    return axes.select(*by, "line", "a", "b").join(points.unionAll(more), [*by, "line"]).groupBy(*by, "line", _nearer(F.col("x"), F.col("y")).alias("end")).agg(F.array_sort(F.collect_set("what")).alias("kinds"))


def _worth(links: DataFrame, by: list[str]) -> DataFrame:
    """(by, line, linked, signal): whether anything is linked to a line, and whether all of it are instruments that monitor it."""
    return links.groupBy(*by, "line").agg(F.lit(True).alias("linked"), F.min((F.col("rel") == "MONITORS") & (F.col("kind") == "instrument")).alias("signal"))


def dead_leg_directions(lines: DataFrame, ends: DataFrame, links: DataFrame, stub: int = 3, by: list[str] = DK) -> DataFrame:
    """(by, line, direction): lines (line, segments, direction) of unknown direction flow towards their only connected end, if a junction or equipment is there. Short stubs without links and signal lines are left out."""
    one = ends.groupBy(*by, "line").agg(F.count(F.lit(1)).alias("n"), F.max("end").alias("end"), F.max("kinds").alias("kinds")).where((F.col("n") == 1) & F.arrays_overlap("kinds", F.array(F.lit("junction"), F.lit("equipment"))))
    rows = lines.where("direction = 'unknown'").join(_worth(links, by), [*by, "line"], "left").join(one, [*by, "line"])
    keep = (F.coalesce("linked", F.lit(False)) | (F.col("segments") >= stub)) & ~F.coalesce("signal", F.lit(False))
    return rows.where(keep).select(*by, "line", F.when(F.col("end") == "A", "reverse").otherwise("forward").alias("direction"))


def unresolved(lines: DataFrame, ends: DataFrame, links: DataFrame, by: list[str] = DK) -> DataFrame:
    """Lines of unknown direction that have links, aren't signal lines and are connected at both ends: what is worth asking a model about."""
    two = ends.groupBy(*by, "line").agg(F.count(F.lit(1)).alias("n")).where("n = 2").select(*by, "line")
    good = _worth(links, by).where("NOT signal").select(*by, "line")
    return lines.where("direction = 'unknown'").join(good, [*by, "line"], "left_semi").join(two, [*by, "line"], "left_semi")


def answered_directions(answers: DataFrame, axes: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, line, direction): a model's words (line, word) along each line's axis: forward if the word's vector points along it or across; other words give nothing."""
    vx = F.create_map(*[F.lit(v) for k, (x, _) in WORDS.items() for v in (k, x)])
    vy = F.create_map(*[F.lit(v) for k, (_, y) in WORDS.items() for v in (k, y)])
    a, b = F.col("a"), F.col("b")
    along = F.try_element_at(vx, F.col("word")) * (b["x"] - a["x"]) + F.try_element_at(vy, F.col("word")) * (b["y"] - a["y"])
    return answers.join(axes, [*by, "line"]).withColumn("__p", along).where("__p IS NOT NULL").select(*by, "line", F.when(F.col("__p") >= 0, "forward").otherwise("reverse").alias("direction"))


def directed_edges(edges: DataFrame, known: DataFrame, by: list[str] = DK) -> DataFrame:
    """edges (a, b, ...) with directed, flow_direction and flow_evidence of the pipeline at an end, that at a first."""
    told = known.where("direction IN ('forward', 'reverse')").select(*by, "line", F.struct("direction", "evidence").alias("s"))
    out = edges.join(told.withColumnRenamed("line", "a").withColumnRenamed("s", "__a"), [*by, "a"], "left").join(told.withColumnRenamed("line", "b").withColumnRenamed("s", "__b"), [*by, "b"], "left")
    s = F.coalesce("__a", "__b")
    return out.withColumn("directed", s.isNotNull()).withColumn("flow_direction", s["direction"]).withColumn("flow_evidence", s["evidence"]).drop("__a", "__b")


def flow_paths(links: DataFrame, known: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, node, line, direction, evidence) for each node on a pipeline of known direction, by its first physical edge (links: line, node, edge_id)."""
    first = links.groupBy(*by, "node").agg(F.min_by("line", "edge_id").alias("line"))
    return first.join(known.where("direction IN ('forward', 'reverse')").select(*by, "line", "direction", "evidence"), [*by, "line"]).select(*by, "node", "line", "direction", "evidence")


def evidence_counts(known: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, evidence, n): lines by what their direction rests on; unknown for the rest."""
    return known.groupBy(*by, F.when(F.col("direction") == "unknown", "unknown").otherwise(F.col("evidence")).alias("evidence")).agg(F.count(F.lit(1)).alias("n"))


def adjacent_lines(lines: DataFrame, ends: DataFrame, snap: float, align: float, by: list[str] = DK) -> DataFrame:
    """(by, line, side, other): other pipelines with an end (line, box) within snap beyond a line's box (line, box) on a side, and in line with it within align."""
    b, e = F.col("l")["box"], F.col("r")["box"]
    met = grid_join(lines.select(*by, "line", "box"), ends.select(*by, "line", "box"), max(snap, align), by=by).where(F.col("l.line") != F.col("r.line"))
    x, y = e["x1"], e["y1"]
    high, wide = y.between(b["y1"] - align, b["y2"] + align), x.between(b["x1"] - align, b["x2"] + align)
    sides = F.array_compact(F.array(F.when(x.between(b["x1"] - snap, b["x1"]) & high, "LEFT"), F.when(x.between(b["x2"], b["x2"] + snap) & high, "RIGHT"), F.when(y.between(b["y1"] - snap, b["y1"]) & wide, "UP"), F.when(y.between(b["y2"], b["y2"] + snap) & wide, "DOWN")))
    return met.select(*by, F.col("l.line").alias("line"), F.explode(sides).alias("side"), F.col("r.line").alias("other")).distinct()


def continuations(answers: DataFrame, adjacent: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, a, b): pairs of pipelines to merge: where an answer (line, continues, confidence, directions) of high or medium confidence says that a line goes on at a side, with what is adjacent there."""
    ok = answers.where(F.col("continues") & F.lower("confidence").isin("high", "medium")).select(*by, "line", F.explode("directions").alias("side")).withColumn("side", F.upper("side"))
    return ok.join(adjacent, [*by, "line", "side"]).select(*by, F.least("line", "other").alias("a"), F.greatest("line", "other").alias("b")).distinct()


def line_reach(symbols: DataFrame, segments: DataFrame, radius: float, by: list[str] = DK) -> DataFrame:
    """(by, line, nodes): instruments and valves (id, kind, box) up to radius from any segment (line, seg, box) of a line, in order of id."""
    few = symbols.where("kind IN ('instrument', 'valve')").select(*by, "id", "box")
    near = least_distances(few, segments.select(*by, "line", "seg", "box"), radius, by)
    return near.groupBy(*by, "line").agg(F.array_sort(F.collect_set("id")).alias("nodes"))


def attach_targets(nodes: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, node, reason): instruments and valves (node, kind, equipment_parent, is_isolated) without an equipment parent: isolated or unresolved."""
    rows = nodes.where("kind IN ('instrument', 'valve') AND equipment_parent IS NULL")
    return rows.select(*by, "node", F.when(F.col("is_isolated"), "isolated").otherwise("unresolved").alias("reason"))


def resolve_entities(rows: DataFrame, distance: float = 1500, flattest: float = 3.5, cap: float = 0.4, prefix: str = "V-", by: list[str] = DK) -> tuple[DataFrame, DataFrame]:
    """(entities, remap) of detections (id, tag, category, box, conf).

    Boxes too small or flat for a symbol go, but of equipment whose tag has no real symbol the most confident flat label stays,
    label_only and with a cap on the confidence of what is attached to it. Equal tags of one category within `distance`, in chains, are one entity: its most
    confident, then largest, detection with the box of all. A tag that another entity has with the site prefix joins that one.
    remap (id, into) names the entity of every detection that is left; those of blank tags are their own.
    """
    key = F.upper(F.trim(F.coalesce("tag", F.lit(""))))
    gate = rows.withColumn("__key", key).withColumn("__ok", g.size_gate(F.col("box"), F.col("category"))["reason"] == "ok")
    wide, high = F.col("box.x2") - F.col("box.x1"), F.col("box.y2") - F.col("box.y1")
    flat = F.greatest(wide, high) / F.greatest(F.least(wide, high), F.lit(1)) > flattest
    real = gate.where("__ok")
    shown = real.where("category = 'equipment'").select(*by, "__key").distinct()
    labels = gate.where(~F.col("__ok") & (F.col("category") == "equipment") & flat & (F.col("__key") != "")).join(shown, [*by, "__key"], "left_anti")
    best = labels.groupBy(*by, "__key").agg(F.max_by("id", F.struct(F.coalesce("conf", F.lit(0.0)), -F.col("id"))).alias("id"))
    kept = real.withColumn("label_only", F.lit(False)).unionByName(labels.join(best, [*by, "__key", "id"], "left_semi").withColumn("label_only", F.lit(True)))
    kept = kept.select(*by, "id", "tag", "category", "box", "conf", "label_only", "__key")
    named = kept.where("__key <> ''")
    few = named.select(*by, "id", "__key", "category", "box")
    pairs = grid_join(few, few, distance, cell=3000, by=[*by, "__key", "category"]).where(F.col("l")["id"] < F.col("r")["id"]).where(g.center_distance(F.col("l")["box"], F.col("r")["box"]) <= distance)
    of = component_of(named, pairs.select(*by, F.col("l.id").alias("a"), F.col("r.id").alias("b")), "id", by)
    rank, b = F.struct(F.coalesce("conf", F.lit(0.0)), g.area(F.col("box")), -F.col("id")), F.col("box")
    whole = F.struct(F.min(b["x1"]).alias("x1"), F.min(b["y1"]).alias("y1"), F.max(b["x2"]).alias("x2"), F.max(b["y2"]).alias("y2"))
    one = of.groupBy(*by, "root").agg(*[F.max_by(c, rank).alias(c) for c in ("id", "tag", "category", "conf", "label_only", "__key")], whole.alias("box"), F.count(F.lit(1)).alias("members"))
    site = one.where(F.col("__key").startswith(prefix)).groupBy(*by, F.substr(F.col("__key"), F.lit(len(prefix) + 1)).alias("__key")).agg(F.min("id").alias("__into"))
    joined = one.join(site, [*by, "__key"], "left").withColumn("__into", F.when(~F.col("__key").startswith(prefix), F.col("__into")))
    blank = kept.where("__key = ''")
    limit = F.when(F.col("label_only"), F.lit(cap)).alias("confidence_cap")
    entities = joined.where("__into IS NULL").select(*by, "id", "tag", "category", "box", "conf", "label_only", limit, "members").unionByName(blank.select(*by, "id", "tag", "category", "box", "conf", "label_only", limit, F.lit(1).cast("long").alias("members")))
    into = joined.select(*by, "root", F.coalesce("__into", "id").alias("into"))
    remap = of.select(*by, "id", "root").join(into, [*by, "root"]).select(*by, "id", "into").unionAll(blank.select(*by, "id", F.col("id").alias("into")))
    return entities, remap


def zone_text_gate(rows: DataFrame, by: list[str] = DK) -> DataFrame:
    """rows (id, tag, symbol, tag_box) with kept: outside zones of text, or a line number, or with a symbol of its own or next to its tag."""
    from tagloom.functions.text import is_line_number
    from tagloom.operators.spatial import adjacent_glyph

    x, y = g.center(F.col("symbol"))
    seen = adjacent_glyph(rows.select(*by, "id", "symbol", F.col("tag_box").alias("tag")), by=by).select(*by, "id", "has_glyph")
    return rows.join(seen, [*by, "id"]).withColumn("kept", (g.zone(x, y) == "main_drawing") | is_line_number(F.col("tag")) | F.col("has_glyph")).drop("has_glyph")

"""Pipelines and junctions, graph edges, flow direction, relations, structural checks and the asset hierarchy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import geometry as g
from tagloom.functions.text import cross_drawing_tokens, instrument_family, is_instrument_tag, is_piping_node, numbered
from tagloom.operators.graph import ancestors, bfs_tree, component_of
from tagloom.operators.spatial import grid_join

DK = ["drawing_id"]
# How each relation of a graph edge reads in the register, and which change their ends' places; other relations are left out.
RELATIONS = {"MOUNTED_ON": "support_function", "CONTAINED_WITHIN": "contains", "SIGNAL_TO": "controls", "MONITORS": "monitors", "CONNECTED_TO": "connected_to"}
TURNED = ("CONTAINED_WITHIN", "MOUNTED_ON")
# What may be a root, by kind; other kinds have 0.5.
RANKS = {"equipment": 4.0, "pipeline": 3.5, "piping": 3.0, "junction": 3.0, "valve": 2.0, "instrument": 1.0}
VIRTUAL = ("pipeline", "junction")


def ends_of(segments: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, id, end, box): both ends of each segment (id, seg) as points."""
    s = F.col("seg")
    pts = F.array(F.struct(F.lit(0).alias("end"), s["x0"].alias("x"), s["y0"].alias("y")), F.struct(F.lit(1).alias("end"), s["x1"].alias("x"), s["y1"].alias("y")))
    e = segments.select(*by, "id", F.explode(pts).alias("p"))
    return e.select(*by, "id", "p.end", F.struct(F.col("p.x").alias("x1"), F.col("p.y").alias("y1"), F.col("p.x").alias("x2"), F.col("p.y").alias("y2")).alias("box"))


def bridges(ends: DataFrame, gap: float, equipment: DataFrame | None = None, by: list[str] = DK) -> DataFrame:
    """(by, a, b): segments with ends (id, end, box) up to gap apart, unless a quarter point of the way lies in a box of equipment (box)."""
    l, r = F.col("l")["box"], F.col("r")["box"]
    dx, dy = r["x1"] - l["x1"], r["y1"] - l["y1"]
    near = grid_join(ends, ends, gap, by=by).where((F.col("l")["id"] < F.col("r")["id"]) & (F.sqrt(dx * dx + dy * dy) <= gap))
    pairs = near.select(*by, F.col("l")["id"].alias("a"), F.col("r")["id"].alias("b"), F.col("l")["end"].alias("ea"), F.col("r")["end"].alias("eb"), l["x1"].alias("x"), l["y1"].alias("y"), dx.alias("dx"), dy.alias("dy"))
    if equipment is not None:
        px, py = F.col("x") + F.col("dx") * F.col("f"), F.col("y") + F.col("dy") * F.col("f")
        ways = pairs.withColumn("f", F.explode(F.array(*[F.lit(f) for f in (0.25, 0.5, 0.75)]))).select(*by, "a", "b", "ea", "eb", F.struct(px.alias("x1"), py.alias("y1"), px.alias("x2"), py.alias("y2")).alias("box"))
        crossed = grid_join(ways, equipment.select(*by, "box"), 0, by=by).select(*by, "l.a", "l.b", "l.ea", "l.eb").distinct()
        pairs = pairs.join(crossed, [*by, "a", "b", "ea", "eb"], "left_anti")
    return pairs.select(*by, "a", "b")


def pipelines(segments: DataFrame, tol: float = 25, by: list[str] = DK, gap: float = 100, equipment: DataFrame | None = None, least_length: float = 60) -> tuple[DataFrame, DataFrame]:
    """(lines, junctions) of segments (id, seg, box) that are at least least_length long and, where they have a type, horizontal or
    vertical pipes. A grid point where three or more segments end, or an end meets another's
    interior, is a junction; ends that touch elsewhere join their segments into a pipeline, and so do ends off junctions that
    are up to gap apart, unless equipment (box) lies between.

    lines: (by, id, pipeline), pipelines named PL-nnnn by size; junctions: (by, junction, x, y, degree, kind)."""
    own = F.col("seg")
    long = F.sqrt((own["x1"] - own["x0"]) * (own["x1"] - own["x0"]) + (own["y1"] - own["y0"]) * (own["y1"] - own["y0"])) >= least_length
    segments = segments.where(long & F.col("type").isin("horizontal_pipe", "vertical_pipe") if "type" in segments.columns else long)
    ends = ends_of(segments, by)
    s = F.col("r")["seg"]
    touch = grid_join(ends, segments.select(*by, "id", "seg", "box"), tol, by=by).where(F.col("l")["id"] != F.col("r")["id"])
    x, y = F.col("l")["box"]["x1"], F.col("l")["box"]["y1"]
    along = g.projection(x, y, s)
    length = F.sqrt((s["x1"] - s["x0"]) * (s["x1"] - s["x0"]) + (s["y1"] - s["y0"]) * (s["y1"] - s["y0"]))
    slack = F.least(F.lit(0.5), tol / F.greatest(length, F.lit(1.0)))
    touch = touch.where(g.point_segment_distance(x, y, s) <= tol).select(*by, g.snap(x, int(tol)).alias("gx"), g.snap(y, int(tol)).alias("gy"), F.col("l.id").alias("a"), F.col("r.id").alias("b"), ((along > slack) & (along < 1 - slack)).alias("inner"))
    x0, y0 = F.col("box")["x1"], F.col("box")["y1"]
    placed = ends.withColumn("gx", g.snap(x0, int(tol))).withColumn("gy", g.snap(y0, int(tol)))
    # who meets at a point: all that end in its cell, and all that such an end touches
    there = placed.select(*by, "gx", "gy", "id", F.lit(False).alias("inner")).unionAll(touch.select(*by, "gx", "gy", F.col("b").alias("id"), "inner"))
    spots = there.groupBy(*by, "gx", "gy").agg(F.countDistinct("id").alias("degree"), F.max("inner").alias("inner"))
    junctions = spots.where((F.col("degree") >= 3) | F.col("inner"))
    n = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("degree"), "gx", "gy")) - 1
    named = junctions.select(*by, F.concat(F.lit("JN-"), n.cast("string")).alias("junction"), (F.col("gx") * int(tol)).alias("x"), (F.col("gy") * int(tol)).alias("y"), "degree", F.when(F.col("degree") >= 4, "CROSS").otherwise("TEE").alias("kind"))
    free = touch.join(junctions.select(*by, "gx", "gy"), [*by, "gx", "gy"], "left_anti").select(*by, "a", "b")
    loose = placed.join(junctions.select(*by, "gx", "gy"), [*by, "gx", "gy"], "left_anti").select(*by, "id", "end", "box")
    of = component_of(segments.select(*by, "id"), free.unionAll(bridges(loose, gap, equipment, by)), "id", by)
    sizes = of.groupBy(*by, "root").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "root")) - 1
    names = sizes.select(*by, "root", numbered("PL-", rank, 4).alias("pipeline"))
    return of.join(names, [*by, "root"]).select(*by, "id", "pipeline"), named


def line_geometry(segments: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, pipeline, segments, length, box) of segments (pipeline, length, box)."""
    b = F.col("box")
    return segments.groupBy(*by, "pipeline").agg(F.count(F.lit(1)).alias("segments"), F.round(F.sum("length"), 3).alias("length"), F.struct(F.min(b["x1"]).alias("x1"), F.min(b["y1"]).alias("y1"), F.max(b["x2"]).alias("x2"), F.max(b["y2"]).alias("y2")).alias("box"))


def axis(ends: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, line, a, b, span): the two ends of a pipeline that lie farthest apart, the first pair by coordinates of several. ends: (line, x, y).

    The extremes along four axes give a span that the farthest pair reaches at least; an end from which no corner of the line's
    box is that far can't be of the pair. What is left after that, few ends of a long line, is compared pair by pair."""
    def span(a: Column, b: Column) -> Column:
        return F.sqrt((a["x"] - b["x"]) * (a["x"] - b["x"]) + (a["y"] - b["y"]) * (a["y"] - b["y"]))

    pts = ends.select(*by, "line", F.struct(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).alias("p")).distinct()
    x, y = F.col("p.x"), F.col("p.y")
    tops = pts.groupBy(*by, "line").agg(*[f("p", v).alias(f"{n}{k}") for k, v in enumerate((x, y, x + y, x - y)) for n, f in (("hi", F.max_by), ("lo", F.min_by))], F.min(x).alias("x1"), F.max(x).alias("x2"), F.min(y).alias("y1"), F.max(y).alias("y2"))
    least = F.greatest(*[span(F.col(f"hi{k}"), F.col(f"lo{k}")) for k in range(4)])
    corner = F.sqrt(F.pow(F.greatest(x - F.col("x1"), F.col("x2") - x), 2) + F.pow(F.greatest(y - F.col("y1"), F.col("y2") - y), 2))
    left = pts.join(tops.select(*by, "line", "x1", "x2", "y1", "y2", least.alias("least")), [*by, "line"]).where(corner * (1 + 1e-9) >= F.col("least")).select(*by, "line", "p")
    pairs = left.withColumnRenamed("p", "a").join(left.withColumnRenamed("p", "b"), [*by, "line"]).where("a <= b").withColumn("span", F.round(span(F.col("a"), F.col("b")), 3))
    best = F.struct(-F.col("span"), "a", "b")
    return pairs.groupBy(*by, "line").agg(F.min(best).alias("m")).select(*by, "line", "m.a", "m.b", (-F.col("m.col1")).alias("span"))


def symbol_edges(symbols: DataFrame, segments: DataFrame, radius: float = 60, by: list[str] = DK) -> DataFrame:
    """(by, a, b, rel, category, confidence, evidence): each symbol but equipment (id, box, kind) with the nearest line under radius: instruments monitor it, others connect to it. segments: id, line, seg, box."""
    near = grid_join(symbols.where("kind <> 'equipment'").select(*by, "id", "box", "kind"), segments.select(*by, "line", "seg", "box"), radius, by=by).withColumn("d", g.box_segment_distance(F.col("l")["box"], F.col("r")["seg"]))
    # bounded after the aggregate, as in spatial.least_distances
    best = near.groupBy(*by, F.col("l.id").alias("a"), F.col("l.kind").alias("kind")).agg(F.min(F.when(F.col("d").isNotNull(), F.struct(F.col("d"), F.col("r.line").alias("line")))).alias("m")).where(F.col("m.d") < radius)
    rel = F.when(F.col("kind") == "instrument", "MONITORS").otherwise("CONNECTED_TO")
    told = F.concat(F.lit("symbol edge "), F.round("m.d", 1).cast("string"), F.lit("px from pipeline"))
    return best.select(*by, "a", F.col("m.line").alias("b"), rel.alias("rel"), F.lit("physical").alias("category"), F.round(0.85 - F.col("m.d") / (radius * 4), 3).alias("confidence"), told.alias("evidence"))


def mounted_edges(symbols: DataFrame, radius: float = 200, by: list[str] = DK) -> DataFrame:
    """(by, a, b, rel, category, confidence, evidence): each instrument but those of flow (id, box, kind, tag) with the equipment whose edge is nearest, under radius."""
    tools = symbols.where("kind = 'instrument'").withColumn("family", instrument_family(F.col("tag"))).where("family IS NULL OR family <> 'flow'")
    near = grid_join(tools.select(*by, "id", "box", "family"), symbols.where("kind = 'equipment'").select(*by, "id", "box"), radius, by=by).withColumn("d", g.edge_gap(F.col("l")["box"], F.col("r")["box"])).where(F.col("d") < radius)
    best = near.groupBy(*by, F.col("l.id").alias("a"), F.col("l.family").alias("family")).agg(F.min(F.struct(F.col("d"), F.col("r.id").alias("b"))).alias("m"))
    told = F.concat(F.lit("instrument "), F.round("m.d", 1).cast("string"), F.lit("px from equipment ("), F.coalesce("family", F.lit("geometry-only")), F.lit(")"))
    return best.select(*by, "a", F.col("m.b").alias("b"), F.lit("MOUNTED_ON").alias("rel"), F.lit("functional").alias("category"), F.round(0.75 - F.col("m.d") / (radius * 4), 3).alias("confidence"), told.alias("evidence"))


def nearest_junctions(ends: DataFrame, junctions: DataFrame, tol: float = 25, by: list[str] = DK) -> DataFrame:
    """(by, line, end, junction): the junction (junction, x, y) nearest to each end (line, end, box) of a pipeline, under three tolerances; the first by name of several."""
    spots = junctions.withColumn("box", F.struct(F.col("x").cast("double").alias("x1"), F.col("y").cast("double").alias("y1"), F.col("x").cast("double").alias("x2"), F.col("y").cast("double").alias("y2")))
    near = grid_join(ends.select(*by, "line", "end", "box"), spots.select(*by, "junction", "box"), 3 * tol, by=by).withColumn("d", g.center_distance(F.col("l")["box"], F.col("r")["box"])).where(F.col("d") < 3 * tol)
    return near.groupBy(*by, F.col("l.line").alias("line"), F.col("l.end").alias("end")).agg(F.min_by(F.col("r.junction"), F.struct("d", F.col("r.junction"))).alias("junction"))


def seed_flow(evidence: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, node, value, conflict): direction by the first piece of evidence: check valves before arrowheads, then by id. evidence: (node, kind, id, value)."""
    first = F.struct(F.when(F.col("kind") == "check_valve", 0).otherwise(1), "id")
    return evidence.groupBy(*by, "node").agg(F.min_by("value", first).alias("value"), (F.countDistinct("value") > 1).alias("conflict"))


def equipment_parent(candidates: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, node, parent, evidence): the candidate with the lowest rank, then the smallest parent. candidates: (node, parent, rank, evidence)."""
    best = candidates.groupBy(*by, "node").agg(F.min_by(F.struct("parent", "evidence"), F.struct("rank", "parent")).alias("s"))
    return best.select(*by, "node", "s.parent", "s.evidence")


def parent_provenance(tree: DataFrame, edges: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, node, parent, confidence, evidence): of each node's edges (edge_id, a, b, confidence, evidence) to its parent in the tree (node, parent), whichever way, the first's; null without one."""
    ends = edges.select(*by, F.least("a", "b").alias("__lo"), F.greatest("a", "b").alias("__hi"), F.struct("edge_id", "confidence", "evidence").alias("__e"))
    first = ends.groupBy(*by, "__lo", "__hi").agg(F.min_by("__e", "__e.edge_id").alias("__e"))
    up = tree.where("parent IS NOT NULL").select(*by, "node", "parent", F.least("node", "parent").alias("__lo"), F.greatest("node", "parent").alias("__hi"))
    return up.join(first, [*by, "__lo", "__hi"], "left").select(*by, "node", "parent", "__e.confidence", "__e.evidence")


def cross_references(nodes: DataFrame, own: Column, by: list[str] = DK) -> DataFrame:
    """(by, source_tag, ref_drawing, relationship): every token like a number of another drawing of the same series in a node's tag or context (tag, context), as often as it occurs."""
    tag, context = F.coalesce("tag", F.lit("")), F.coalesce("context", F.lit(""))
    found = F.concat(F.transform(cross_drawing_tokens(tag, own), lambda t: F.struct(t.alias("t"), F.lit("reference_in_tag").alias("r"))), F.transform(cross_drawing_tokens(context, own), lambda t: F.struct(t.alias("t"), F.lit("reference_in_context").alias("r"))))
    return nodes.select(*by, tag.alias("source_tag"), F.explode(found).alias("x")).select(*by, "source_tag", F.col("x.t").alias("ref_drawing"), F.col("x.r").alias("relationship"))


def structural_edges(edges: DataFrame, by: list[str] = DK) -> DataFrame:
    """edges (a, b, rel, confidence) once for each unordered pair and relation, the most confident first."""
    keyed = edges.withColumn("lo", F.least("a", "b")).withColumn("hi", F.greatest("a", "b"))
    return keyed.groupBy(*by, "lo", "hi", "rel").agg(F.max("confidence").alias("confidence"))


def effective_parents(nodes: DataFrame, by: list[str] = DK) -> DataFrame:
    """nodes (node, parent, and perhaps equipment_parent) with `parent` the direct parent if it is a node, else the equipment parent if that is one, else null."""
    known = nodes.select(*by, F.col("node").alias("parent"), F.lit(True).alias("__known")).distinct()
    two = nodes.columns if "equipment_parent" in nodes.columns else [*nodes.columns, "equipment_parent"]
    rows = nodes if "equipment_parent" in nodes.columns else nodes.withColumn("equipment_parent", F.lit(None).cast(nodes.schema["node"].dataType))
    one = rows.join(known, [*by, "parent"], "left").withColumnRenamed("__known", "__direct").withColumnRenamed("parent", "__p")
    both = one.join(known.withColumnRenamed("parent", "equipment_parent"), [*by, "equipment_parent"], "left")
    out = both.withColumn("parent", F.when(F.col("__direct"), F.col("__p")).when(F.col("__known"), F.col("equipment_parent")))
    return out.select(*[c for c in two if c in nodes.columns])


def relationships(nodes: DataFrame, edges: DataFrame, loops: DataFrame | None = None, by: list[str] = DK) -> DataFrame:
    """(by, parent, child, rel, source, confidence) of nodes (node, parent, and perhaps confidence): part_of for each parent; graph edges
    (a, b, rel, confidence, and perhaps evidence, category, edge_id) between nodes under their register names, two of them turned round;
    and what each controller of a loop (loop_id, node, tag, role) does to the loop's other tags. Of equal (parent, child, rel) the first in this order."""
    def column(df: DataFrame, name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)

    ids = nodes.schema["node"].dataType.simpleString()
    one = nodes.where("parent IS NOT NULL").select(*by, "parent", F.col("node").alias("child"), F.lit("part_of").alias("rel"), F.lit("hierarchy_tree").alias("source"), column(nodes, "confidence", "double").alias("confidence"), F.lit(0).alias("o"), F.lit("").alias("k"))
    names = F.create_map(*[F.lit(x) for kv in RELATIONS.items() for x in kv])
    known = nodes.select(*by, "node").distinct()
    told = F.coalesce(F.nullif(column(edges, "evidence", "string"), F.lit("")), F.nullif(column(edges, "category", "string"), F.lit("")), F.col("rel"))
    real = edges.withColumn("__s", told).join(known.withColumnRenamed("node", "a"), [*by, "a"], "left_semi").join(known.withColumnRenamed("node", "b"), [*by, "b"], "left_semi")
    turn = F.col("rel").isin(*TURNED)
    two = real.select(*by, F.when(turn, F.col("b")).otherwise(F.col("a")).alias("parent"), F.when(turn, F.col("a")).otherwise(F.col("b")).alias("child"), F.try_element_at(names, F.col("rel")).alias("rel"), F.col("__s").alias("source"), F.col("confidence").cast("double"), F.lit(1).alias("o"), F.coalesce(column(edges, "edge_id", "string"), F.lit("")).alias("k")).where("rel IS NOT NULL")
    every = one.unionAll(two)
    if loops is not None:
        own = loops.groupBy(*by, "loop_id", "tag").agg(F.max("node").alias("node"), F.max_by("role", "node").alias("role"))
        lead = own.where(F.lower("role").contains("control")).select(*by, "loop_id", F.col("node").alias("parent"))
        watch = F.lower("role").rlike("transmit|element|sens")
        met = lead.join(own, [*by, "loop_id"]).where("parent <> node")
        three = met.select(*by, F.col("parent").cast(ids), F.col("node").cast(ids).alias("child"), F.when(watch, "monitors").otherwise("controls").alias("rel"), F.concat(F.lit("control_loop:"), F.col("loop_id")).alias("source"), F.lit(None).cast("double").alias("confidence"), F.lit(2).alias("o"), F.col("loop_id").alias("k"))
        every = every.unionAll(three)
    w = Window.partitionBy(*by, "parent", "child", "rel").orderBy("o", "k", F.desc("confidence"), "source")
    return every.withColumn("__n", F.row_number().over(w)).where("__n = 1").select(*by, "parent", "child", "rel", "source", "confidence")


def issues(nodes: DataFrame, edges: DataFrame, rels: DataFrame, graph_nodes: DataFrame | None = None, by: list[str] = DK, most_depth: int = 12) -> DataFrame:
    """(by, issue, node, severity, reason, fix) of nodes (node, tag, kind, parent, is_isolated), in eight rules. A node's name is its tag, or its id.

    Several parents by the relations part_of and contains, chains into a cycle, no parent, isolation, no system (which only counts without a
    parent), tags of several nodes, ends of edges that are no node (nor one of graph_nodes), and more than most_depth ancestors."""
    text = nodes.withColumn("__label", F.coalesce(F.nullif(F.col("tag"), F.lit("")), F.col("node").cast("string")))
    label = text.select(*by, "node", "__label")

    def told(df: DataFrame, issue: str, node: Column, severity: str, reason: Column, fix: str) -> DataFrame:
        return df.select(*by, F.lit(issue).alias("issue"), node.cast("string").alias("node"), F.lit(severity).alias("severity"), reason.alias("reason"), F.lit(fix).alias("fix"))

    named = F.col("__label")
    parents = rels.where("rel IN ('part_of', 'contains')").select(*by, F.col("child").alias("node"), "parent").distinct()
    shown = parents.join(label.select(*by, F.col("node").alias("parent"), F.col("__label").alias("__p")), [*by, "parent"], "left")
    many = shown.groupBy(*by, "node").agg(F.array_sort(F.collect_list(F.coalesce("__p", F.col("parent").cast("string")))).alias("ps")).where(F.size("ps") > 1).join(label, [*by, "node"], "left")
    one = told(many, "Multiple Parents", F.coalesce(named, F.col("node").cast("string")), "HIGH", F.concat(F.size("ps").cast("string"), F.lit(" parents: "), F.array_join("ps", ", ")), "Confirm the true physical parent; remove spurious containment.")
    walks = ancestors(nodes, by).join(label, [*by, "node"])
    two = told(walks.where("cycle"), "Cyclic Hierarchy", named, "HIGH", F.lit("effective-parent chain forms a cycle"), "Break reciprocal CONTAINED_WITHIN; pick one direction.")
    alone = text.where("parent IS NULL AND coalesce(kind, '') <> 'equipment'")
    three = told(alone, "Missing Parent", named, "MEDIUM", F.lit("no equipment parent and not attached to any process line"), "Manually assign parent equipment or system.")
    four = told(text.where("is_isolated"), "Disconnected Subgraph", named, "MEDIUM", F.lit("isolated detection — no pipe/equipment/signal edge"), "Verify detection; connect or reject as false positive.")
    five = told(alone, "Missing System", named, "LOW", F.lit("no process system resolved"), "Assign to a process system.")
    again = nodes.withColumn("u", F.upper("tag")).where("u <> ''").groupBy(*by, "u").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    six = told(again, "Duplicate Nodes", F.col("u"), "MEDIUM", F.concat(F.col("n").cast("string"), F.lit(" nodes share tag '"), F.col("u"), F.lit("'")), "Merge duplicate detections.")
    known = nodes.select(*by, "node") if graph_nodes is None else nodes.select(*by, "node").unionAll(graph_nodes.select(*by, "node"))
    edge = F.col("edge_id").cast("string") if "edge_id" in edges.columns else F.concat_ws(">", "a", "b")
    ends = edges.withColumn("__e", edge).select(*by, "__e", F.explode(F.array("a", "b")).alias("node")).join(known.distinct(), [*by, "node"], "left_anti")
    seven = told(ends, "Broken Relationship", F.col("node"), "HIGH", F.concat(F.lit("edge "), F.col("__e"), F.lit(" references unknown node")), "Build the graph again from the current extraction.")
    eight = told(walks.where(F.col("depth") > most_depth), "Invalid Hierarchy Depth", named, "LOW", F.concat(F.lit("effective depth="), F.col("depth").cast("string")), "Investigate over-deep containment chain.")
    out = one
    for more in (two, three, four, five, six, seven, eight):
        out = out.unionAll(more)
    return out


def issue_summary(found: DataFrame) -> DataFrame:
    """(kind, name, n): issues in all, by severity and by type."""
    n = F.count(F.lit(1)).alias("n")
    a = found.groupBy(F.lit("severity").alias("kind"), F.col("severity").alias("name")).agg(n)
    b = found.groupBy(F.lit("issue").alias("kind"), F.col("issue").alias("name")).agg(n)
    return found.agg(F.lit("total").alias("kind"), F.lit("TOTAL ISSUES").alias("name"), n).unionAll(a).unionAll(b)


def orphans(nodes: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, tag, node, kind, no_parent, isolated, reason): nodes (node, tag, kind, parent, is_isolated, confidence) that are isolated, or have no parent and are no equipment; the most confident for each tag."""
    lone = F.col("parent").isNull() & (F.coalesce("kind", F.lit("")) != "equipment")
    iso = F.coalesce("is_isolated", F.lit(False))
    reasons = F.array_compact(F.array(F.when(F.col("parent").isNull(), "no parent / no line"), F.when(lone, "no system"), F.when(iso, "isolated (no graph edge)")))
    rows = nodes.where(lone | iso).withColumn("tag", F.coalesce(F.nullif(F.col("tag"), F.lit("")), F.col("node").cast("string"))).withColumn("reason", F.coalesce(F.nullif(F.array_join(reasons, "; "), F.lit("")), F.lit("line-rooted (review)")))
    w = Window.partitionBy(*by, "tag").orderBy(F.desc(F.coalesce("confidence", F.lit(-1.0))), "node")
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").select(*by, "tag", "node", "kind", lone.alias("no_parent"), iso.alias("isolated"), "reason")


def statistics(nodes: DataFrame, edges: DataFrame, rels: DataFrame, graph_nodes: DataFrame, loops: DataFrame, cross: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, ord, metric, value): fourteen figures for each drawing with nodes. nodes: as in `orphans`; graph_nodes: (node, kind); loops: a row for each; cross: a row for each reference."""
    kind = F.coalesce("kind", F.lit(""))
    n = F.count(F.lit(1))
    parts = [
        nodes.groupBy(*by).agg(n.alias("1 Total Nodes (tagged)"), *[F.count_if(kind == k).alias(f"{o} {k.title()} Count") for o, k in ((5, "equipment"), (6, "instrument"), (7, "valve"), (8, "piping"))], F.count_if(F.coalesce("is_isolated", F.lit(False))).alias("14 Isolated Detections")),
        graph_nodes.groupBy(*by).agg(n.alias("2 Total Graph Nodes (incl. virtual)"), F.count_if(kind.isin(*VIRTUAL)).alias("12 Virtual Nodes (pipelines+junctions)")),
        rels.groupBy(*by).agg(n.alias("3 Total Relationships (business)")),
        edges.groupBy(*by).agg(n.alias("4 Total Graph Edges")),
        loops.groupBy(*by).agg(n.alias("9 Control Loops")),
        cross.groupBy(*by).agg(n.alias("10 Cross Drawing Links")),
        orphans(nodes, by).groupBy(*by).agg(n.alias("11 Orphan Nodes")),
        ancestors(nodes, by).groupBy(*by).agg(F.max("depth").cast("long").alias("13 Hierarchy Depth (max)")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, by, "left")
    figures = [c for c in out.columns if c not in by]
    pairs = F.array(*[F.struct(F.lit(int(c.split(" ")[0])).alias("ord"), F.lit(c.split(" ", 1)[1]).alias("metric"), F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("long").alias("value")) for c in figures])
    return out.select(*by, F.explode(pairs).alias("x")).select(*by, "x.ord", "x.metric", "x.value")


def rooted_tree(nodes: DataFrame, edges: DataFrame, by: list[str] = DK) -> DataFrame:
    """bfs_tree of each component of nodes (node, kind, box) under edges (a, b, and perhaps category) without signals, from the node with the highest rank of kind, then degree, then area, then the smallest id."""
    process = edges.where("coalesce(category, '') <> 'signal'") if "category" in edges.columns else edges
    ranks = F.create_map(*[F.lit(x) for kv in RANKS.items() for x in kv])
    near = process.select(*by, F.col("a").alias("node"), F.col("b").alias("other")).unionAll(process.select(*by, F.col("b").alias("node"), F.col("a").alias("other"))).where("node <> other").distinct()
    degree = near.groupBy(*by, "node").agg(F.count(F.lit(1)).alias("degree"))
    of = component_of(nodes.select(*by, "node", "kind", "box"), process.select(*by, "a", "b"), "node", by).join(degree, [*by, "node"], "left")
    best = F.struct((-F.coalesce(F.try_element_at(ranks, F.col("kind")), F.lit(0.5))).alias("r"), (-F.coalesce("degree", F.lit(0))).alias("d"), (-g.area(F.col("box"))).alias("s"), "node")
    roots = of.groupBy(*by, "root").agg(F.min(best).alias("m")).select(*by, F.col("m.node").alias("node"))
    return bfs_tree(process.select(*by, "a", "b").join(nodes.select(*by, F.col("node").alias("a")), [*by, "a"], "left_semi").join(nodes.select(*by, F.col("node").alias("b")), [*by, "b"], "left_semi"), roots, by)


def relatives(tree: DataFrame, by: list[str] = DK, named: bool = True) -> DataFrame:
    """tree (node, parent) with children, siblings and the number of descendants. Siblings are their names or, if not named, their number: a list for each of
    n children is n * n names."""
    kids = tree.where("parent IS NOT NULL").groupBy(*by, F.col("parent").alias("node")).agg(F.array_sort(F.collect_list("node")).alias("children"))
    # walks go by the nodes that have children: a leaf is below its parent and what is above that
    inner = tree.join(kids.select(*by, "node"), [*by, "node"], "left_semi").select(*by, "node", "parent")
    up = ancestors(inner, by).select(*by, "node", F.explode(F.concat(F.array("node"), "chain")).alias("top"))
    below = up.join(kids.select(*by, "node", F.size("children").alias("n")), [*by, "node"]).groupBy(*by, F.col("top").alias("node")).agg(F.sum("n").alias("descendants"))
    none = F.array().cast(f"array<{tree.schema['node'].dataType.simpleString()}>")
    brothers = kids.select(*by, F.col("node").alias("parent"), (F.col("children") if named else F.size("children")).alias("__s"))
    out = tree.join(kids, [*by, "node"], "left").join(brothers, [*by, "parent"], "left").join(below, [*by, "node"], "left")
    siblings = F.coalesce(F.filter("__s", lambda x: x != F.col("node")), none) if named else F.coalesce(F.col("__s") - 1, F.lit(0))
    return out.select(*tree.columns, F.coalesce("children", none).alias("children"), siblings.alias("siblings"), F.coalesce("descendants", F.lit(0)).alias("descendants"))


def parent_candidates(nodes: DataFrame, edges: DataFrame, tree: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, node, parent, rank, evidence, confidence) for `equipment_parent`: equipment that a node is mounted on (1, the most confident),
    its own parent in the tree (2), and for instrument tags the nearest equipment among its ancestors (3) and the only equipment on its parent pipeline (4).
    nodes: (node, tag, kind); edges: (a, b, rel, confidence); tree: (node, parent)."""
    kinds = nodes.select(*by, "node", "kind")
    both = edges.select(*by, F.col("a").alias("node"), F.col("b").alias("parent"), "rel", "confidence").unionAll(edges.select(*by, F.col("b").alias("node"), F.col("a").alias("parent"), "rel", "confidence"))
    to_equipment = both.join(kinds.where("kind = 'equipment'").select(*by, F.col("node").alias("parent")), [*by, "parent"])
    mounted = to_equipment.where("rel IN ('MOUNTED_ON', 'GEMINI_ATTACHED')").groupBy(*by, "node").agg(F.max_by(F.struct("parent", "confidence"), F.struct(F.coalesce("confidence", F.lit(0.0)), F.lit(0))).alias("m"))
    one = mounted.select(*by, "node", "m.parent", F.lit(1).alias("rank"), F.lit("MOUNTED_ON").alias("evidence"), F.col("m.confidence").cast("double").alias("confidence"))
    up = tree.where("parent IS NOT NULL").select(*by, "node", "parent").join(kinds.select(*by, F.col("node").alias("parent"), F.col("kind").alias("pk")), [*by, "parent"])
    edge = both.groupBy(*by, "node", "parent").agg(F.max("confidence").cast("double").alias("confidence"))
    two = up.where("pk = 'equipment'").join(edge, [*by, "node", "parent"], "left").select(*by, "node", "parent", F.lit(2).alias("rank"), F.lit("direct_parent").alias("evidence"), "confidence")
    tools = nodes.where(is_instrument_tag(F.col("tag"))).select(*by, "node")
    chain = ancestors(tree, by).join(tools, [*by, "node"]).select(*by, "node", F.posexplode("chain").alias("pos", "parent")).join(kinds.where("kind = 'equipment'").select(*by, F.col("node").alias("parent")), [*by, "parent"])
    three = chain.groupBy(*by, "node").agg(F.min_by("parent", "pos").alias("parent")).select(*by, "node", "parent", F.lit(3).alias("rank"), F.lit("pipeline_traversal").alias("evidence"), F.lit(0.5).alias("confidence"))
    touching = to_equipment.select(*by, F.col("node").alias("line"), "parent").distinct().join(kinds.where("kind = 'pipeline'").select(*by, F.col("node").alias("line")), [*by, "line"])
    on = up.where("pk = 'pipeline'").join(tools, [*by, "node"]).select(*by, "node", F.col("parent").alias("line")).join(touching, [*by, "line"]).where("parent <> node")
    four = on.groupBy(*by, "node").agg(F.count(F.lit(1)).alias("n"), F.min("parent").alias("parent")).where("n = 1").select(*by, "node", "parent", F.lit(4).alias("rank"), F.lit("pipeline_traversal").alias("evidence"), F.lit(0.5).alias("confidence"))
    return one.unionAll(two).unionAll(three).unionAll(four)


def asset_rows(nodes: DataFrame, plant: Column, area: Column, by: list[str] = DK) -> DataFrame:
    """(by, plant, area, system, functional_location, parent_equipment, equipment, level, path, piping) of nodes (node, tag, kind, parent), a row for each.

    Level and path are of the ancestors' names without repeats next to each other; the system is the first equipment from the root down, else the node itself if it is equipment, else the root, else UNASSIGNED."""
    label = nodes.select(*by, "node", F.coalesce(F.nullif(F.col("tag"), F.lit("")), F.col("node").cast("string")).alias("label"), F.coalesce("kind", F.lit("")).alias("kind"))
    chain = ancestors(nodes, by).select(*by, "node", F.posexplode_outer("chain").alias("pos", "up"))
    named = chain.join(label.select(*by, F.col("node").alias("up"), F.col("label").alias("up_label"), F.col("kind").alias("up_kind")), [*by, "up"], "left")
    ups = named.groupBy(*by, "node").agg(F.array_sort(F.collect_list(F.when(F.col("up").isNotNull(), F.struct((-F.col("pos")).alias("o"), F.col("up_label").alias("label"), F.col("up_kind").alias("kind"))))).alias("ups"))
    rows = label.join(ups, [*by, "node"])
    names = F.transform("ups", lambda x: x["label"])
    short = F.filter(names, lambda x, i: (i == 0) | (x != F.get(names, i - 1)))
    first = F.get(F.filter("ups", lambda x: x["kind"] == "equipment"), F.lit(0))["label"]
    system = F.coalesce(first, F.when(F.col("kind") == "equipment", F.col("label")), F.get(names, F.lit(0)), F.lit("UNASSIGNED"))
    place = F.concat(plant, F.lit("."), area, F.lit("."), F.array_join(F.concat(short, F.array("label")), "."))
    above = F.coalesce(F.get(names, F.size(names) - 1), F.lit("NULL"))
    return rows.select(*by, "node", plant.alias("plant"), area.alias("area"), system.alias("system"), place.alias("functional_location"), above.alias("parent_equipment"), F.col("label").alias("equipment"), F.size(short).alias("level"), F.array_join(F.concat(short, F.array("label")), " > ").alias("path"), is_piping_node(F.col("kind"), F.col("label")).alias("piping"))


def merge_lines(members: DataFrame, accepted: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, id, pipeline): members (id, pipeline) after merging accepted pairs (a, b) of pipelines, in chains, into the largest (then first by name) of each group."""
    sizes = members.groupBy(*by, "pipeline").agg(F.count(F.lit(1)).alias("n"))
    of = component_of(sizes, accepted, "pipeline", by)
    keep = of.groupBy(*by, "root").agg(F.max_by("pipeline", F.struct("n", F.lit(0))).alias("__any"), F.min(F.struct((-F.col("n")).alias("m"), "pipeline")).alias("k")).select(*by, "root", F.col("k.pipeline").alias("into"))
    to = of.join(keep, [*by, "root"]).select(*by, "pipeline", "into")
    return members.join(to, [*by, "pipeline"]).select(*by, "id", F.col("into").alias("pipeline"))


def dead_legs(ends: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, line, toward): pipelines with exactly one connected end flow from it to the free one. ends: (line, end, connected)."""
    a = ends.groupBy(*by, "line").agg(F.count_if("connected").alias("n"), F.max(F.when(~F.col("connected"), F.col("end"))).alias("free"))
    return a.where("n = 1 AND free IS NOT NULL").select(*by, "line", F.col("free").alias("toward"))

"""Rules against vectors worked out by hand from their definitions, row by row, and joins that must not cross drawings."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tagloom.functions import geometry as g
from tagloom.functions import scores, text
from tagloom.operators import dedup, hierarchy, lookup, sow

TAGS = {
    # tag: legacy discipline, family, role
    "FCV-101": ("MECHANICAL", None, "controller"),
    "FV-1": ("INSTRUMENTATION", None, "valve"),
    "V-FIC-12": ("INSTRUMENTATION", "flow", "controller"),
    "V-FIT-208": ("INSTRUMENTATION", "flow", "transmitter"),
    "PIT-211": ("INSTRUMENTATION", "pressure", "transmitter"),
    "V-PAHH-9": ("INSTRUMENTATION", "pressure", "other"),
    "LIT-3": ("INSTRUMENTATION", "level", "transmitter"),
    "LG-3": ("INSTRUMENTATION", None, "other"),
    "TAHH-212": ("INSTRUMENTATION", "temperature", "other"),
    "TE-7": ("INSTRUMENTATION", "temperature", "element"),
    "FE-224": ("INSTRUMENTATION", None, "element"),
    "K-V-201": ("MECHANICAL", None, "other"),
    "V-KM-V-201": ("ELECTRICAL", None, "other"),
    "V-V-201": ("MECHANICAL", None, "other"),
    "V-BV-2243": ("MECHANICAL", None, "valve"),
    "GLV-9": ("MECHANICAL", None, "other"),
    "10IN-GV-V272": ("PIPING", None, "other"),
    '2"-ETH-V057': ("PIPING", None, "other"),
    "": ("INSTRUMENTATION", None, "other"),
}


def test_tags(spark):
    df = spark.createDataFrame([(x,) for x in TAGS], "tag string")
    got = {r.tag: (r.a, r.b, r.c) for r in df.select("tag", text.legacy_discipline(F.col("tag")).alias("a"), text.instrument_family(F.col("tag")).alias("b"), text.loop_role(F.col("tag")).alias("c")).collect()}
    assert got == TAGS


DECODED = {
    "PIT-211": ("INSTRUMENT", "PRESSURE", "INDICATING TRANSMITTER", "211", "PRESSURE INDICATING TRANSMITTER"),
    "TAHH-212": ("INSTRUMENT", "TEMPERATURE", "ALARM HIGH HIGH", "212", "TEMPERATURE ALARM HIGH HIGH"),
    "V-FZSC-208": ("INSTRUMENT", "FLOW", "SWITCH CLOSE", "208", "FLOW SWITCH CLOSE"),
    "FE-224": ("INSTRUMENT", "FLOW", "ELEMENT", "224", "FLOW ELEMENT"),
    "k-v-201": ("EQUIPMENT", "", "", "201", "K-V-201"),
    "V-NRV-2243A": ("VALVE", "", "NON-RETURN VALVE", "2243A", "NON-RETURN VALVE"),
    "FCV101": ("VALVE", "", "FLOW CONTROL VALVE", "101", "FLOW CONTROL VALVE"),
    '2"-ETH-V057-61440X': ("PIPING", "", "", "", 'PIPING,2"-ETH-V057-61440X'),
    "I-004": ("LOGIC", "", "INTERLOCK", "004", "INTERLOCK/LOGIC ELEMENT"),
    "XYZ": ("UNKNOWN", "", "", "", "XYZ"),
    "": ("UNKNOWN", "", "", "", ""),
    "JQ-55": ("INSTRUMENT", "J", "", "55", "J"),
}


def test_decode(spark):
    df = spark.createDataFrame([(x,) for x in DECODED], "tag string").select("tag", text.decode_tag(F.col("tag")).alias("d"))
    assert {r.tag: tuple(r.d) for r in df.collect()} == DECODED


@pytest.mark.parametrize(
    ("number", "title", "mode"),
    [("LT-1", "", "COUNT_ONLY"), ("LTX", "", "COUNT_ONLY"), ("X-LT-1", "", "COUNT_ONLY"), ("LC-1", "LT plan", "FULL_EXTRACTION"), ("D-1", "gt plan", "COUNT_ONLY"), ("D-1", "plan", "FULL_EXTRACTION"), (None, None, "FULL_EXTRACTION")],
)
def test_project_mode(spark, number, title, mode):
    assert spark.range(1).select(scores.project_mode(F.lit(number).cast("string"), F.lit(title).cast("string"))).first()[0] == mode


def test_revisions_relations_and_legacy_scores(spark):
    def of(c):
        return spark.range(1).select(c).first()[0]

    none = F.lit(None).cast("double")
    assert [of(scores.revision_scope(F.lit(n), F.lit(r))) for n, r in (("use CLOUDed areas", "0"), ("", "rev0"), ("", ""), ("", "IFC"), ("", "P1"), ("", "B"))] == ["CLOUD_ONLY", "FULL_DRAWING", "CLOUD_PRIORITY", "CLOUD_PRIORITY", "FULL_DRAWING", "CLOUD_PRIORITY"]
    assert [of(scores.spatial_relationship(F.lit(c), x, y)) for c, x, y in ((True, none, none), (False, F.lit(19.0), none), (False, F.lit(21.0), F.lit(29.0)), (False, F.lit(150.0), none), (False, none, F.lit(150.0)), (False, F.lit(151.0), F.lit(151.0)))] == ["CONTAINED_WITHIN", "ATTACHED_TO", "CONNECTED_TO", "ADJACENT_TO", "ADJACENT_TO", "ISOLATED"]
    assert of(scores.legacy_confidence(*[F.lit(x) for x in (0.853, 0.8, 0.8, 1.0, 0.5)])) == 0.823
    assert of(scores.legacy_label(F.lit(" high "))) == 0.95
    assert tuple(of(text.drawing_location(F.lit("4224-MGDV-6-50-2004"), F.lit("")))) == ("MGDV", "6-50", "2004")
    assert tuple(of(text.drawing_location(F.lit("X"), F.lit("7")))) == ("PLANT", "X", "7")


def test_registry_and_ocr_stay_inside_a_drawing(spark):
    reg = lookup.load_registry(spark.createDataFrame([("V-BV-1", 0)], "tag string, ord int"))
    rows = spark.createDataFrame([(1, 1, "V BV 1"), (2, 1, "V-GV 2")], "drawing_id int, id int, tag string")
    got = {r.drawing_id: (r.match, r.matched_key) for r in lookup.registry_join(rows, reg).collect()}
    assert got == {1: ("normalised", "V-BV-1"), 2: ("none", None)}
    model = spark.createDataFrame([(1, 0, 1, "ABCD"), (2, 0, 1, "ABCD")], "drawing_id int, patch_id int, id int, tag_text string")
    ocr = spark.createDataFrame([(1, 0, "abcx", 1), (2, 0, "zzzz", 1)], "drawing_id int, patch_id int, text string, ord int")
    assert [(r.drawing_id, r.ocr_text, r.score) for r in lookup.reconcile(model, ocr).collect()] == [(1, "abcx", 0.75)]


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    i = max(w, 0) * max(h, 0)
    return i / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - i)


def test_duplicate_pairs_use_both_boxes(spark):
    rng = random.Random(6)
    rows = []
    for i in range(120):
        x, y = rng.randrange(0, 900), rng.randrange(0, 500)
        u, v = x + rng.randrange(-500, 500), y + rng.randrange(-20, 20)
        rows.append((0, i, rng.choice(["V-BV-2245", "V-BV-2246", "V012", "VO12", "", "VBV224"]), x, y, x + 60, y + 40, u, v, u + 80, v + 30))
    names = "drawing_id int, id int, tag string, x1 int, y1 int, x2 int, y2 int, u1 int, v1 int, u2 int, v2 int"
    df = spark.createDataFrame(rows, names).withColumn("box", g.box()).withColumn("tag_box", F.struct(F.col("u1").alias("x1"), F.col("v1").alias("y1"), F.col("u2").alias("x2"), F.col("v2").alias("y2")))
    want = set()
    fold = str.maketrans("01", "OI")
    for p, q in itertools.combinations(rows, 2):
        a, b = (r[2].replace("-", "") for r in (p, q))
        d = math.hypot((p[3] + p[5] - q[3] - q[5]) / 2, (p[4] + p[6] - q[4] - q[6]) / 2)
        lap = max(iou(p[3:7], q[3:7]), iou(p[7:], q[7:]))
        same, like = bool(a) and a == b, bool(a and b) and a.translate(fold) == b.translate(fold)
        part = len(a) >= 6 and len(b) >= 6 and (a in b or b in a)
        if same and d <= 60 or part and d <= 300 or (same or like) and (lap >= 0.2 or d <= 120) or not (a and b) and lap >= 0.5:
            want.add((p[1], q[1]))
    assert {(r.a, r.b) for r in dedup.duplicate_pairs(df).collect()} == want and want


def test_axis_is_the_farthest_pair(spark):
    rng = random.Random(2)
    rows = []
    for line in range(12):
        t = rng.random() * math.pi
        for _ in range(30):
            s, o = rng.uniform(-300, 300), rng.uniform(-200, 200) * (line % 3)
            rows.append((0, line, round(500 + s * math.cos(t) - o * math.sin(t)), round(500 + s * math.sin(t) + o * math.cos(t))))
    df = spark.createDataFrame(rows, "drawing_id int, line int, x int, y int")
    got = {r.line: r.span for r in hierarchy.axis(df).collect()}
    for line in range(12):
        own = [(x, y) for _, n, x, y in rows if n == line]
        assert got[line] == round(max(math.dist(a, b) for a, b in itertools.combinations(own, 2)), 3)


def test_relationships_and_issues(spark):
    nodes = spark.createDataFrame(
        [("e", "E1", "equipment", None, False, 0.9), ("i", "FIC-1", "instrument", "e", False, 0.8), ("j", "FIT-1", "instrument", None, True, 0.7), ("k", "", "valve", "l", False, 0.6), ("l", "fit-1", "valve", "k", False, None)],
        "node string, tag string, kind string, parent string, is_isolated boolean, confidence double",
    ).withColumn("drawing_id", F.lit(0))
    edges = spark.createDataFrame([("j", "e", "MOUNTED_ON", 0.7, "E-1"), ("i", "e", "CONTAINED_WITHIN", 0.6, "E-2"), ("j", "i", "SIGNAL_TO", 0.5, "E-3"), ("j", "k", "ADJACENT_TO", 0.4, "E-4"), ("j", "JN-0", "JUNCTION_OF", 0.4, "E-5"), ("i", "gone", "MONITORS", 0.3, "E-6")], "a string, b string, rel string, confidence double, edge_id string").withColumn("drawing_id", F.lit(0))
    loops = spark.createDataFrame([("CL-00", "i", "FIC-1", "controller"), ("CL-00", "j", "FIT-1", "transmitter"), ("CL-00", "l", "fit-1", "valve")], "loop_id string, node string, tag string, role string").withColumn("drawing_id", F.lit(0))
    rels = hierarchy.relationships(nodes, edges, loops)
    got = {(r.parent, r.child, r.rel, r.source) for r in rels.collect()}
    assert got == {
        ("e", "i", "part_of", "hierarchy_tree"), ("l", "k", "part_of", "hierarchy_tree"), ("k", "l", "part_of", "hierarchy_tree"),
        ("e", "j", "support_function", "MOUNTED_ON"), ("e", "i", "contains", "CONTAINED_WITHIN"), ("j", "i", "controls", "SIGNAL_TO"),
        ("i", "j", "monitors", "control_loop:CL-00"), ("i", "l", "controls", "control_loop:CL-00"),
    }
    graph_nodes = spark.createDataFrame([(0, "JN-0", "junction")], "drawing_id int, node string, kind string")
    found = sorted((r.issue, r.node) for r in hierarchy.issues(nodes, edges, rels, graph_nodes).collect())
    assert found == [("Broken Relationship", "gone"), ("Cyclic Hierarchy", "fit-1"), ("Cyclic Hierarchy", "k"), ("Disconnected Subgraph", "FIT-1"), ("Duplicate Nodes", "FIT-1"), ("Missing Parent", "FIT-1"), ("Missing System", "FIT-1")]


def test_scope_and_symbols(spark):
    df = spark.createDataFrame([("Flow Indicating Transmitter",), ("3-WAY SOLENOID VALVE",), ("Limit Switch Open",), ("thing",)], "name string").withColumn("x", sow.inferred(F.col("name")))
    got = {r.name: (r.category, r.prefix, r.shape) for r in df.select("name", "x.*", sow.shape_features(F.col("name"), F.col("x.category")).alias("shape")).collect()}
    assert got["Flow Indicating Transmitter"][:2] == ("Transmitter", "FIT") and got["Flow Indicating Transmitter"][2][-1] == "indicating (I letter in tag)"
    assert got["3-WAY SOLENOID VALVE"][:2] == ("Valve", "SV") and "three-port valve body" in got["3-WAY SOLENOID VALVE"][2]
    assert got["Limit Switch Open"][:2] == ("Switch", "LSO") and got["thing"] == ("Unknown", "", ["unknown shape"])


def test_discrepancies_and_extras(spark):
    def rows(items):
        return spark.createDataFrame([(0, i, i, tag, x) for i, (tag, x) in enumerate(items)], "drawing_id int, id int, ord int, tag string, x int").withColumn("box", F.struct(F.col("x").alias("x1"), F.lit(0).alias("y1"), (F.col("x") + 10).alias("x2"), F.lit(10).alias("y2")))

    full = rows([("V-BV-1", 0), ("BV-2", 500), ("GV 3", 1000), ("X-9", 2000)])
    other = rows([("BV-1", 40), ("GV-7", 600), ("gv-3", 1100), ("X-9", 2151)])
    assert {(r.full_tag, r.other_tag, r.kind, r.distance) for r in lookup.prefix_discrepancies(full, other).collect()} == {("V-BV-1", "BV-1", "prefix", 40.0), ("BV-2", "GV-7", "mismatch", 100.0)}
    assert {r.tag for r in lookup.extras(full, other).collect()} == {"BV-2"}


def test_pipelines_against_plain_python(spark):
    """Random short and long segments: contacts, junctions, unions and bridges, point by point."""
    rng = random.Random(8)
    segs = []
    for i in range(90):
        x, y, n = rng.randrange(0, 1200), rng.randrange(0, 900), rng.choice([40, 80, 200, 300])
        dx, dy = rng.choice([(n, 0), (0, n), (n, 10)])
        segs.append((i, float(x), float(y), float(x + dx), float(y + dy)))
    pipes = [s for s in segs if math.dist(s[1:3], s[3:]) >= 60]

    def off(px, py, s):
        _, x0, y0, x1, y1 = s
        n = (x1 - x0) ** 2 + (y1 - y0) ** 2
        t = max(0.0, min(1.0, ((px - x0) * (x1 - x0) + (py - y0) * (y1 - y0)) / n))
        return math.hypot(px - x0 - t * (x1 - x0), py - y0 - t * (y1 - y0)), t

    root = {s[0]: s[0] for s in pipes}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    met, inner, touch = {}, set(), []
    ends = [(s[0], *p) for s in pipes for p in (s[1:3], s[3:])]
    for i, px, py in ends:
        at = round(px / 25), round(py / 25)
        met.setdefault(at, set()).add(i)
        for s in pipes:
            d, t = off(px, py, s)
            if s[0] != i and d <= 25:
                met[at].add(s[0])
                slack = 25 / math.dist(s[1:3], s[3:])
                if t <= slack or t >= 1 - slack:
                    touch.append((i, s[0], at))
                else:
                    inner.add(at)
    junctions = {at for at, ids in met.items() if len(ids) >= 3 or at in inner}
    for i, j, at in touch:
        if at not in junctions:
            root[find(i)] = find(j)
    loose = [e for e in ends if (round(e[1] / 25), round(e[2] / 25)) not in junctions]
    for a, b in itertools.combinations(loose, 2):
        if math.dist(a[1:], b[1:]) <= 100:
            root[find(a[0])] = find(b[0])
    want = {}
    for s in pipes:
        want.setdefault(find(s[0]), set()).add(s[0])
    df = spark.createDataFrame([(0, *s) for s in segs], "drawing_id int, id long, x0 double, y0 double, x1 double, y1 double")
    df = df.select("drawing_id", "id", F.struct("x0", "y0", "x1", "y1").alias("seg"), F.struct(F.col("x0").alias("x1"), F.col("y0").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2")).alias("box"))
    lines, found = hierarchy.pipelines(df)
    got = {}
    for r in lines.collect():
        got.setdefault(r.pipeline, set()).add(r.id)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert {(r.x // 25, r.y // 25, r.degree) for r in found.collect()} == {(*at, len(met[at])) for at in junctions}


def test_tile_duplicates_against_plain_python(spark):
    import difflib

    rng = random.Random(4)
    rows = [(0, i, rng.choice(["V-BV-2245", "V-BV-2246", "V BV 2245", "10IN-GV-V272-11502X", "10IN-GV-V272-11502Y", "LG-3"]), rng.random(), x := rng.randrange(0, 200), y := rng.randrange(0, 100), x + rng.randrange(40, 90), y + rng.randrange(30, 60)) for i in range(90)]

    def key(t):
        return t.upper().replace("-", "").replace(" ", "").replace("IN", "")

    kept = []
    for r in sorted(rows, key=lambda r: (-r[3], r[1])):
        def same(k, r=r):
            lap = iou(r[4:], k[4:])
            return key(r[2]) == key(k[2]) and lap > 0.15 or lap > 0.55 and difflib.SequenceMatcher(None, k[2].upper(), r[2].upper()).ratio() >= 0.92

        if not any(map(same, kept)):
            kept.append(r)
    df = spark.createDataFrame(rows, "drawing_id int, id int, tag string, conf double, x1 int, y1 int, x2 int, y2 int").withColumn("box", g.box())
    assert {r.id for r in dedup.tile_duplicates(df).collect()} == {r[1] for r in kept} and len(kept) < 80

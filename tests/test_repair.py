"""Oriented flow, pipe repair, traces, attachments and clouds against plain Python on small random inputs."""

import decimal
import math
import random
from collections import Counter, deque

import pytest
from pyspark.sql import functions as F

from tagloom.functions import polygons as poly
from tagloom.operators import attach, clouds, hierarchy, oriented, repair, traces

P = "struct<x:double,y:double>"


def flow_by_queue(seeds, meets, junctions, axes):
    known, queue, split = {}, deque(), set()
    for line, direction, evidence, _ in sorted(seeds, key=lambda s: s[3]):
        if line in axes and line not in known:
            known[line] = direction, evidence
            queue.append(line)

    def end(line, x, y):
        a, b = axes[line]
        return "A" if math.hypot(a[0] - x, a[1] - y) <= math.hypot(b[0] - x, b[1] - y) else "B"

    while queue:
        p = queue.popleft()
        for j, x, y, degree in junctions:
            at = {q for k, q in meets if k == j and q in axes}
            if p not in at:
                continue
            if degree > 2 or len(at) > 2:
                split.add(j)
                continue
            into = end(p, x, y) == ("B" if known[p][0] == "forward" else "A")
            for q in at - {p}:
                if q not in known:
                    first = end(q, x, y) == "A"
                    known[q] = ("forward" if first == into else "reverse"), "propagated"
                    queue.append(q)
    return known, split


@pytest.mark.parametrize("seed", range(4))
def test_flow_propagation(spark, seed):
    rng = random.Random(seed)
    n = 60
    axes = {i: ((rng.randrange(50), rng.randrange(50)), (rng.randrange(50), rng.randrange(50))) for i in range(n)}
    junctions = [(j, rng.randrange(50), rng.randrange(50), rng.choice([2, 2, 2, 2, 3])) for j in range(70)]
    meets = [(j, q) for j, *_ in junctions for q in rng.sample(range(n + 3), rng.choice([1, 2, 2, 2, 2, 3]))]
    seeds = [(rng.randrange(n), rng.choice(["forward", "reverse"]), "arrowhead", k) for k in range(5)] + [(n + 9, "forward", "arrowhead", 9)]
    known, split = flow_by_queue(seeds, meets, junctions, axes)
    m = spark.createDataFrame([(0, j, q) for j, q in meets], "drawing_id int, junction int, line int")
    j = spark.createDataFrame([(0, j, j, float(x), float(y), d) for j, x, y, d in junctions], "drawing_id int, junction int, ord int, x double, y double, degree int")
    a = spark.createDataFrame([(0, i, *[tuple(map(float, p)) for p in v]) for i, v in axes.items()], f"drawing_id int, line int, a {P}, b {P}")
    s = spark.createDataFrame([(0, *x) for x in seeds], "drawing_id int, line int, direction string, evidence string, ord int")
    flow, stops = oriented.flow_propagation(s, m, j, a)
    assert {r.line: (r.direction, r.evidence) for r in flow.collect()} == known
    assert {r.junction for r in stops.collect()} == split
    assert oriented.flow_propagation(s.limit(0), m, j, a)[0].count() == 0


def merges_in_order(sizes, log):
    live, size, out = dict.fromkeys(sizes, True), dict(sizes), []
    for o, kind, a, b in sorted(log):
        keep = drop = None
        if kind == "gap":
            if live.get(a) and live.get(b):
                keep, drop = (b, a) if size[b] > size[a] else (a, b)
        else:
            keep = a if live.get(a) else b if live.get(b) else None
            if keep is not None:
                size[keep] += 1
                other = b if keep == a else a
                drop = other if other != keep and live.get(other) else None
        if drop is not None:
            size[keep] += size[drop]
            live[drop] = False
        out.append((o, kind, keep, drop, ("separate" if keep is None else "merged") if kind == "gap" else "noise" if keep is None else "elbow"))
    return out


@pytest.mark.parametrize("seed,rounds", [(1, 6), (2, 1), (3, 0), (4, 50)])
def test_merges_of_random_logs(spark, seed, rounds):
    rng, want, lines, log = random.Random(seed), Counter(), [], []
    for d in range(2):
        n = 40
        sizes = {i: rng.randrange(1, 5) for i in range(n)}
        one = [(k, "gap", *rng.sample(range(n + 1), 2)) for k in range(40)] + [(40 + k, "elbow", rng.randrange(n), rng.randrange(n)) for k in range(20)]
        want.update((d, *x) for x in merges_in_order(sizes, one))
        lines += [(d, i, s) for i, s in sizes.items()]
        log += [(d, *x) for x in one]
    rng.shuffle(log)
    got = repair.replay_merges(spark.createDataFrame(lines, "drawing_id int, line int, segments int"), spark.createDataFrame(log, "drawing_id int, ord long, kind string, a int, b int"), rounds=rounds)
    assert Counter(tuple(r) for r in got.select("drawing_id", "ord", "kind", "keep", "drop", "result").collect()) == want


def test_a_hub_and_a_chain_of_merges(spark):
    """Entries that wait for one another far beyond the rounds, on text ids."""
    lines = [(0, f"L{k}", 1) for k in range(400)]
    log = [(0, k, "gap", "L0", f"L{k + 1}") for k in range(150)] + [(0, 150 + k, "gap", f"L{151 + k}", f"L{152 + k}") for k in range(200)]
    want = Counter((0, *x) for x in merges_in_order({x: n for _, x, n in lines}, [x[1:] for x in log]))
    made = repair.replay_merges(spark.createDataFrame(lines, "drawing_id int, line string, segments int"), spark.createDataFrame(log, "drawing_id int, ord long, kind string, a string, b string"), rounds=3)
    assert Counter(tuple(r) for r in made.select("drawing_id", "ord", "kind", "keep", "drop", "result").collect()) == want
    into = {r.line: r["into"] for r in repair.remap(made).collect()}
    assert into["L150"] == "L0" and len(into) == 150 + 100


def test_repair_rebuilds_lines_and_junctions(spark):
    box = "box struct<x1:int,y1:int,x2:int,y2:int>"
    segs = spark.createDataFrame([(0, 1, "A", 10.0, (0, 0, 10, 0)), (0, 2, "B", 5.0, (20, 0, 25, 0)), (0, 3, "B", 5.0, (25, 0, 30, 0)), (0, 4, None, 7.0, (30, 0, 35, 5)), (0, 5, "C", 4.0, (35, 5, 39, 5)), (0, 6, "D", 1.0, (90, 90, 91, 90))], f"drawing_id int, id int, line string, length double, {box}")
    junctions = spark.createDataFrame([(0, "J1", 3), (0, "J2", 4)], "drawing_id int, junction string, degree int")
    meets = spark.createDataFrame([(0, "J1", "A"), (0, "J1", "B"), (0, "J1", "D"), (0, "J2", "A"), (0, "J2", "C")], "drawing_id int, junction string, line string")
    gaps = spark.createDataFrame([(0, 0, "A", "B", True, "HIGH"), (0, 1, "A", "C", True, "high"), (0, 2, "B", "D", True, "low"), (0, 3, "B", "D", None, "high")], "drawing_id int, ord int, a string, b string, connected boolean, confidence string")
    elbows = spark.createDataFrame([(0, 0, "B", "C", 4, "Elbow", "medium"), (0, 1, "B", "D", 6, "noise", "high")], "drawing_id int, ord int, a string, b string, segment int, type string, confidence string")
    crossings = spark.createDataFrame([(0, "J2", "crossing", "high"), (0, "J1", "crossing", None)], "drawing_id int, junction string, junction_type string, confidence string")
    made = repair.repair(segs, junctions, meets, gaps, elbows, crossings)
    assert sorted((r.ord, r.kind, r.keep, r.drop, r.result) for r in made["merges"].collect()) == [(0, "gap", "B", "A", "merged"), (1, "gap", None, None, "separate"), (2, "elbow", "B", "C", "elbow")]
    assert {r.id: r.line for r in made["segments"].collect()} == {1: "B", 2: "B", 3: "B", 4: "B", 5: "B", 6: "D"}
    assert {r.line: (r.segments, r.length, tuple(r.box)) for r in made["lines"].collect()} == {"B": (5, 31.0, (0, 0, 39, 5)), "D": (1, 1.0, (90, 90, 91, 90))}
    assert [r.junction for r in made["junctions"].collect()] == ["J1"]
    assert sorted((r.junction, r.line) for r in made["meets"].collect()) == [("J1", "B"), ("J1", "D")]
    none = repair.repair(segs, junctions, meets, gaps.limit(0), elbows.limit(0), crossings.limit(0))
    assert none["merges"].count() == 0 and none["lines"].count() == 4 and none["meets"].count() == 5


SEG = "drawing_id int, id int, ord int, type string, line int, seg struct<x0:double,y0:double,x1:double,y1:double>, box struct<x1:double,y1:double,x2:double,y2:double>"


def random_segments(rng, n, kinds, lines, size=400, drawings=2):
    rows = []
    for d in range(drawings):
        for i in range(n):
            x, y = rng.randrange(size), rng.randrange(size)
            u, v = x + rng.choice([0, 10, 30]), y + rng.choice([0, 10, 30])
            rows.append((d, i, i, rng.choice(kinds), lines(rng, i), (float(x), float(y), float(u), float(v)), (float(x), float(y), float(u), float(v))))
    return rows


def test_elbow_candidates(spark):
    rng = random.Random(3)
    rows = random_segments(rng, 60, ["horizontal_pipe", "vertical_pipe", "diagonal_pipe", "leader_line"], lambda r, i: r.choice([None, i % 7]), 150)
    want = set()
    for d in (0, 1):
        pipes = [r for r in rows if r[0] == d and r[3] in ("horizontal_pipe", "vertical_pipe") and r[4] is not None]
        ends = [(r[4], r[5][0], r[5][1]) for r in pipes] + [(r[4], r[5][2], r[5][3]) for r in pipes]

        def nearest(x, y):
            best, least = None, 20
            for line, u, v in ends:
                if math.hypot(x - u, y - v) <= least:
                    best, least = line, math.hypot(x - u, y - v)
            return best

        for r in rows:
            if r[0] == d and r[3] == "diagonal_pipe":
                a, b = nearest(*r[5][:2]), nearest(*r[5][2:])
                if a is not None and b is not None:
                    want.add((d, r[1], a, b))
    got = {tuple(r) for r in repair.elbow_candidates(spark.createDataFrame(rows, SEG), 20).select("drawing_id", "segment", "a", "b").collect()}
    assert got == want and len(want) > 5


def traced(segs, asked, snap, align):
    """The loop over traces, on dictionaries."""
    line = {s[1]: s[4] for s in segs}
    live, out, end = set(line.values()), [], {}

    def box(p):
        b = [s[5] for s in segs if line[s[1]] == p]
        return min(min(s[0], s[2]) for s in b), min(min(s[1], s[3]) for s in b), max(max(s[0], s[2]) for s in b), max(max(s[1], s[3]) for s in b)

    for o, p, go, conf, sides in sorted(asked):
        if go and (conf or "").lower() in ("high", "medium") and p in live:
            for side in sides or []:
                x1, y1, x2, y2 = box(p)
                hits = []
                for s in segs:
                    for x, y in (s[5][:2], s[5][2:]):
                        tall, wide = y1 - align <= y <= y2 + align, x1 - align <= x <= x2 + align
                        ok = {"left": x1 - snap <= x <= x1 and tall, "right": x2 <= x <= x2 + snap and tall, "up": y1 - snap <= y <= y1 and wide, "down": y2 <= y <= y2 + snap and wide}.get(side, False)
                        if ok and line[s[1]] != p and line[s[1]] not in hits:
                            hits.append(line[s[1]])
                for q in hits:
                    if q not in live or q == p:
                        continue
                    n = Counter(line.values())
                    keep, drop = (p, q) if n[p] >= n[q] else (q, p)
                    line = {k: keep if v == drop else v for k, v in line.items()}
                    live.discard(drop)
                    out.append((o, keep, drop))
                    p = keep
        end[o] = p
    return out, end


def test_trace_merges_and_valves(spark):
    rng = random.Random(5)
    rows = random_segments(rng, 60, ["horizontal_pipe"], lambda r, i: i // 2, 300)
    asked = [(d, o, rng.randrange(31), rng.random() < 0.8, rng.choice(["High", "medium", "low", None]), rng.choice([["left", "down"], ["right"], ["up", "right", "left"], None, ["nowhere"]])) for d in (0, 1) for o in range(20)]
    merges, ends = set(), {}
    for d in (0, 1):
        m, e = traced([r for r in rows if r[0] == d], [a[1:] for a in asked if a[0] == d], 20, 8)
        merges |= {(d, *x) for x in m}
        ends |= {(d, o): p for o, p in e.items()}
    df = spark.createDataFrame(asked, "drawing_id int, ord int, line int, continues boolean, confidence string, directions array<string>")
    got = traces.trace_merges(spark.createDataFrame(rows, SEG), df, 20, 8).collect()
    assert {(r.drawing_id, r.ord, r.keep, r.drop) for r in got if r.step >= 0} == merges and len(merges) > 3
    assert {(r.drawing_id, r.ord): r.keep for r in got if r.step < 0} == ends
    again = spark.createDataFrame([tuple(r) for r in got], "drawing_id int, ord int, step int, keep int, drop int")
    named = df.withColumn("valves", F.when(F.col("ord") < 2, F.array(F.lit(" v-1 "), F.lit(""))).when(F.col("ord") == 7, F.array(F.lit("V-2"))))
    tags = spark.createDataFrame([(0, "V-1"), (0, "v-2 "), (0, ""), (0, None), (1, "X")], "drawing_id int, tag string")
    found = {r.tag: (r.in_pipeline, r.in_pipeline_id) for r in traces.valves_in_pipelines(tags, named, again).collect()}
    assert found == {"V-1": (True, ends[0, 1]), "v-2 ": (True, ends[0, 7]), "": (False, None), None: (False, None), "X": (False, None)}


def test_ordered_assignment_is_the_loop_over_takers(spark):
    rng, pairs, want = random.Random(4), [], set()
    for d in range(3):
        may = {t: rng.sample(range(12), rng.randrange(1, 7)) for t in range(10)}
        pairs += [(d, t, 100 - t, k, k) for t, ks in may.items() for k in ks]
        gone = set()
        for t in sorted(may, reverse=True):
            free = sorted(set(may[t]) - gone)
            if free:
                gone.add(free[0])
                want.add((d, t, free[0]))
    got = attach.ordered_assignment(spark.createDataFrame(pairs, "drawing_id int, taker int, t_ord int, taken int, k_ord int"))
    assert {(r.drawing_id, r.taker, r.taken) for r in got.collect()} == want


def test_motor_proxies(spark):
    box = "box struct<x1:int,y1:int,x2:int,y2:int>"

    def at(x):
        return x, 0, x + 10, 10

    rows = [
        (0, 1, 1, "KM-V-201", "label", "equipment", at(0), True), (0, 2, 2, "", "MOTOR box", "valve", at(520), False), (0, 3, 3, " ", "Motor", "valve", at(300), False), (0, 4, 4, None, "motor", "valve", at(200), False),
        (0, 5, 5, "km-v-202", "label", "equipment", at(100), True), (0, 6, 6, "X-1", "motor", "valve", at(110), False),
        (1, 1, 1, "KM-V-201", "label", "equipment", at(0), True), (1, 2, 2, "KM-V-201", "pump", "equipment", at(900), False), (1, 3, 3, "", "motor", "valve", at(20), False),
    ]
    df = spark.createDataFrame(rows, f"drawing_id int, id int, ord int, tag string, symbol_name string, category string, {box}, filtered boolean")
    got = attach.motor_proxies(df, ("KM-V-201", "KM-V-202"))
    assert sorted(tuple(r) for r in got.select("drawing_id", "id", "tag").collect()) == [(0, 3, "KM-V-201"), (0, 4, "KM-V-202")]
    out = attach.with_motors(df.withColumn("label_only", F.col("filtered") & (F.col("id") == 1)), got)
    assert sorted((r.drawing_id, r.id, r.tag, r.category) for r in out.where("is_motor_proxy").collect()) == [(0, 3, "KM-V-201", "equipment"), (0, 4, "KM-V-202", "equipment")]
    assert out.count() == len(rows) - 1


def test_attachment_edges(spark):
    inst = spark.createDataFrame([(0, 1, "V-PIT-100", "n1", 0), (0, 1, "v-pit-100", "n9", 1), (0, 2, "A-TT-5", "n2", 2), (0, 2, "B-TT-5", "n3", 3)], "drawing_id int, cluster int, tag string, node string, ord int")
    equip = spark.createDataFrame([(0, "K-V-201", "e1", 0, False), (0, "S-V-204", "e2", 1, True)], "drawing_id int, tag string, node string, ord int, label_only boolean")
    told = [(0, 1, 0, "PIT-100", "V-201", "high", "r"), (0, 1, 1, "V-PIT-100", "K-V-201", "High", None), (0, 1, 2, "TT-5", "K-V-201", "high", ""), (0, 2, 0, "x-tt-5", "S-V-204", "medium", "x"), (0, 2, 1, "A-TT-5", "Z-V-9", "medium", ""), (0, 2, 2, "A-TT-5", "K-V-201", "low", ""), (0, 2, 3, None, None, None, None)]
    a = spark.createDataFrame(told, "drawing_id int, cluster int, ord int, instrument_tag string, parent_equipment string, confidence string, reasoning string")
    edges, outcomes = attach.attachment_edges(a, inst, equip, after=5)
    assert sorted((r.edge_id, r.a, r.b, r.confidence, r.evidence) for r in edges.collect()) == [("E-5", "n1", "e1", 0.85, "gemini_vision: "), ("E-6", "n2", "e2", 0.4, "gemini_vision: x")]
    assert {(r.cluster, r.ord): (r.word, r.outcome) for r in outcomes.collect()} == {(1, 0): ("high", "not_equipment"), (1, 1): ("high", "edge"), (1, 2): ("high", "no_instrument"), (2, 0): ("medium", "edge"), (2, 1): ("medium", "unknown_equipment"), (2, 2): ("low", "low"), (2, 3): ("unknown", "low")}


POLY = f"array<{P}>"


def test_shared_area_of_polygons(spark):
    """Rings of quarter pixels: the share of a fine raster's points in both, and known shapes."""
    rng = random.Random(2)

    def star(n):
        x, y = rng.uniform(20, 40), rng.uniform(20, 40)
        pts = [(x + rng.uniform(5, 20) * math.cos(2 * math.pi * k / n), y + rng.uniform(5, 20) * math.sin(2 * math.pi * k / n)) for k in range(n)]
        return pts if rng.random() < 0.5 else pts[::-1]

    def inside(p, x, y):
        return sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in zip(p, p[1:] + p[:1])) % 2

    pairs = [(star(rng.randrange(3, 9)), star(rng.randrange(3, 9))) for _ in range(12)]
    got = [r[0] for r in spark.createDataFrame([(k, *x) for k, x in enumerate(pairs)], f"k int, a {POLY}, b {POLY}").orderBy("k").select(poly.shared_area(F.col("a"), F.col("b"))).collect()]
    for value, (a, b) in zip(got, pairs):
        raster = sum(inside(a, x / 4, y / 4) and inside(b, x / 4, y / 4) for x in range(1, 260) for y in range(1, 260)) / 16
        assert abs(value - raster) < 6 + raster * 0.05
    square, notch = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)], [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (5.0, 5.0), (0.0, 10.0)]
    rows = spark.createDataFrame([(square, square), (square, notch), (notch, [(4.0, 6.0), (6.0, 6.0), (6.0, 8.0), (4.0, 8.0)]), (square, [(20.0, 0.0), (30.0, 0.0), (30.0, 9.0)]), (square, [(0.0, 0.0), (1.0, 1.0)]), (square, None)], f"a {POLY}, b {POLY}")
    assert [None if r[0] is None else round(r[0], 9) for r in rows.select(poly.shared_area(F.col("a"), F.col("b"))).collect()] == [100.0, 75.0, 0.0, 0.0, 0.0, None]


def test_keep_and_nest(spark):
    def box(x1, y1, x2, y2):
        return [(float(x1), float(y1)), (float(x2), float(y1)), (float(x2), float(y2)), (float(x1), float(y2))]

    rows = [(0, 1, 1, box(0, 0, 100, 100), 0.9), (0, 2, 2, box(0, 0, 100, 90), 0.8), (0, 3, 3, box(0, 50, 100, 150), None), (0, 4, 4, box(10, 10, 30, 30), 0.7), (0, 5, 5, box(90, 10, 110, 30), 0.7), (1, 1, 1, box(0, 0, 100, 90), 0.5), (1, 2, 2, box(0, 0, 100, 100), None)]
    df = spark.createDataFrame(rows, f"drawing_id int, id int, ord int, polygon {POLY}, conf double")
    got = {(r.drawing_id, r.id): r.tag for r in clouds.keep_and_nest(df).collect()}
    assert got == {(0, 1): "outer", (0, 3): "outer", (0, 4): "inner", (0, 5): "outer", (1, 1): "outer"}


def test_frames_and_clouds(spark):
    wave = [(500.0 + (220 + 30 * (k % 2)) * math.cos(2 * math.pi * k / 48), 400.0 + (220 + 30 * (k % 2)) * math.sin(2 * math.pi * k / 48)) for k in range(48)]
    frame = [(5.0, 5.0), (1990.0, 5.0), (1990.0, 1490.0), (5.0, 1490.0)]
    pipe = [(100.0, 100.0), (900.0, 100.0), (900.0, 102.0), (500.0, 101.0), (100.0, 102.0)]
    df = spark.createDataFrame([(0, "wave", wave), (0, "frame", frame), (0, "pipe", pipe)], f"drawing_id int, id string, polygon {POLY}")
    w, h = F.lit(2000), F.lit(1500)
    assert [r.id for r in clouds.without_frames(df, w, h).collect()] == ["wave"]
    from tagloom.functions import geometry as g

    hulls = df.withColumn("hull", g.convex_hull(F.col("polygon")))
    assert [r.id for r in hulls.where(poly.is_cloud(F.col("polygon"), F.col("hull"), w, h)).collect()] == ["wave"]
    low = hulls.where("id = 'wave'").withColumn("polygon", F.transform("polygon", lambda q: F.struct(q["x"].alias("x"), (q["y"] + 950).alias("y")))).withColumn("hull", F.transform("hull", lambda q: F.struct(q["x"].alias("x"), (q["y"] + 950).alias("y"))))
    assert low.where(poly.is_cloud(F.col("polygon"), F.col("hull"), w, h)).count() == 0 and low.where(poly.is_cloud(F.col("polygon"), F.col("hull"), w, h, any_zone=True)).count() == 1


def test_saved_documents(spark):
    cloud = f"struct<id:int,source:string,confidence:double,status:string,polygon_json:{POLY},polygon_img:{POLY},polygon_display:{POLY}>"
    shape = [(10.0, 10.0), (20.6, 10.0), (20.0, 21.0)]
    rows = [
        (0, [(1, "auto", 0.81234, "approved", shape, None, None), (2, None, None, "modified", shape, [(30.0, 30.0), (41.0, 30.0), (41.0, 45.0)], None), (3, "manual_add", None, None, [], [], [(5.0, 5.0), (10.0, 5.0), (10.0, 8.0)])], 2.0, 0.5, 100, 100, 50, 50, (5, 1, 1, 1, None)),
        (1, [], 2.0, 0.5, 100, 100, 50, 50, None),
    ]
    df = spark.createDataFrame(rows, f"drawing_id int, clouds array<{cloud}>, scale_j2i double, display_scale double, image_w int, image_h int, json_w int, json_h int, edit_summary struct<original_count:int,deleted:int,added:int,modified:int,merged:int>")
    saved = clouds.saved_clouds(df)
    got = {r.id: r for r in saved.collect()}
    pts = {k: [tuple(p) for p in r.polygon] for k, r in got.items()}
    assert pts == {1: [(10, 10), (20, 10), (20, 21)], 2: [(15, 15), (20, 15), (20, 22)], 3: [(5, 5), (10, 5), (10, 8)]}
    assert [tuple(p) for p in got[1].polygon_img] == [(20, 20), (41, 20), (40, 42)] and got[1].bbox == [10, 10, 20, 21] and got[1].area == 55.0 and got[1].confidence == 0.812
    assert got[2].source == "manual_add" and got[2].confidence == 1.0 and got[2].mask_bbox == [20, 20, 51, 55] and got[2].mask_shape == [35, 31] and got[3].status == "approved"
    docs = {r.drawing_id: r for r in clouds.saved_documents(df, saved).collect()}
    assert [c.id for c in docs[0].clouds] == [1, 2, 3] and docs[0].stats.total == 3 and docs[0].edit_metadata.approved_unchanged == 3 and docs[0].edit_metadata.image_file_size == [100, 100]
    assert docs[1].clouds == [] and docs[1].stats.total == 0 and docs[1].edit_metadata.added == 0


def test_greedy_keep_of_a_chain_longer_than_its_rounds(spark):
    from tagloom.operators import graph

    n = 500
    rows = spark.range(n).select(F.lit(0).alias("drawing_id"), F.col("id"))
    chain = spark.range(n - 1).select(F.lit(0).alias("drawing_id"), F.col("id").alias("hi"), (F.col("id") + 1).alias("lo"))
    more = chain.unionAll(spark.createDataFrame([(0, 3, 400), (0, 10, 401), (0, 7, 90)], "drawing_id int, hi long, lo long"))
    for conflicts in (chain, more):
        kept = set()
        worse = {}
        for r in conflicts.collect():
            worse.setdefault(r.lo, []).append(r.hi)
        for i in range(n):
            if not any(h in kept for h in worse.get(i, ())):
                kept.add(i)
        assert {r.id for r in graph.greedy_keep(rows, conflicts, rounds=3).collect()} == kept


def test_merged_primaries_take_the_best_spelling(spark):
    from tagloom.operators import dedup

    box = "box struct<x1:int,y1:int,x2:int,y2:int>"
    at = (0, 0, 50, 50)
    rows = [(0, 1, "V-FIT-10", 0.9, 0.2, False), (0, 2, "V-FIT-1O", 0.5, 0.8, False), (0, 3, "V-FIT-100A", 0.4, 0.1, False), (0, 4, "", 0.1, 0.95, False), (1, 1, "V-FIT-10", 0.9, 0.2, True), (1, 2, "V-FIT-1O", 0.5, 0.8, False), (2, 9, None, 0.5, 0.5, False), (3, 1, "V-FIT-10", 0.9, 0.9, False), (3, 2, "V-FIT-10A", 0.1, 0.1, False)]
    df = spark.createDataFrame([(d, i, t, c, o, 0.5, "PASS", k, at) for d, i, t, c, o, k in rows], f"drawing_id int, id int, tag string, conf double, ocr double, assoc double, status string, in_registry boolean, {box}")
    got = {r.drawing_id: (r.id, r.tag, r.ocr, r.merged_from) for r in dedup.merged_primaries(dedup.resolve_duplicates(df)).collect()}
    assert got == {0: (2, "V-FIT-1O", 0.8, [1, 4, 3]), 1: (1, "V-FIT-10", 0.2, [2]), 2: (9, "", 0.5, []), 3: (1, "V-FIT-10A", 0.9, [2])}
    links = dedup.duplicate_links(dedup.resolve_duplicates(df)).collect()
    assert {(r.drawing_id, r.id, r.primary) for r in links} == {(0, 1, 2), (0, 3, 2), (0, 4, 2), (1, 2, 1), (3, 2, 1)}


def test_clusters_alone_are_shuffled_by_their_root(spark):
    """Rows without a duplicate pass by the sort; what is made of a cluster is made in one pass over it, and an exact key meets as far as it is asked to."""
    from tagloom.operators import dedup

    box = "box struct<x1:int,y1:int,x2:int,y2:int>"
    rows = [(0, i, "A-1", 0.5, 0.5, 0.5, "PASS", False, (x, 0, x + 50, 50)) for i, x in ((1, 0), (2, 400), (3, 5000))]
    df = spark.createDataFrame(rows, f"drawing_id int, id int, tag string, conf double, ocr double, assoc double, status string, in_registry boolean, {box}")
    assert {(r.a, r.b) for r in dedup.duplicate_pairs(df, exact_distance=450).collect()} == {(1, 2)}
    of = dedup.resolve_duplicates(df, exact_distance=450)
    assert {(r.id, r.root, r.duplicate_status, r.merged_into, r.merged_count) for r in of.collect()} == {(1, 1, "PRIMARY", None, 2), (2, 1, "DISCARDED", 1, 2), (3, 3, "PRIMARY", None, 1)}
    for made in (dedup.duplicate_links(of), dedup.merged_primaries(of)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" in plan and "LeftOuter" not in plan


def test_polygon_overlap_counts_the_raster(spark):
    from tagloom.functions import geometry as g

    rng = random.Random(5)

    def inside(p, x, y):
        odd = False
        for (ax, ay), (bx, by) in zip(p, p[1:] + p[:1], strict=True):
            if (bx - ax) * (y - ay) == (by - ay) * (x - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                return True
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
        return odd

    def polygon():
        f = rng.choice([1, 1, 2])
        if rng.random() < 0.3:  # whole or half coordinates, all sides upright or level
            x, y, w, h = (rng.randrange(1, 20) / f for _ in range(4))
            return [(x, y), (x + w, y), (x + w, y + h), (x + 2 * w, y + h), (x + 2 * w, y + 2 * h), (x, y + 2 * h)]
        return [(rng.randrange(-10, 25 * f) / f, rng.randrange(-10, 25 * f) / f) for _ in range(rng.randrange(1, 9))]

    pairs = [(polygon(), polygon()) for _ in range(120)]
    grid = [(x, y) for x in range(-12, 62) for y in range(-12, 62)]
    rows = spark.createDataFrame([(k, *x) for k, x in enumerate([*pairs, ([], pairs[0][0]), (None, pairs[0][0])])], f"k int, a {POLY}, b {POLY}")
    got = [tuple(r[0]) for r in rows.orderBy("k").select(g.polygon_overlap(F.col("a"), F.col("b"))).collect()]
    for (a, b), found in zip(pairs, got):
        one, two = {z for z in grid if inside(a, *z)}, {z for z in grid if inside(b, *z)}
        assert found == (len(one), len(two), len(one & two))
    assert got[-2:] == [(0, 0, 0)] * 2
    # a raster of this box has 4 * 10 ** 10 points
    n = 200_000.0
    wide = spark.createDataFrame([([(0.0, 0.0), (n, 0.0), (n, n), (0.0, n)], [(1.0, 0.0), (n + 1, 0.0), (n + 1, n), (1.0, n)])], f"a {POLY}, b {POLY}")
    assert tuple(wide.select(g.polygon_overlap(F.col("a"), F.col("b"))).first()[0]) == (200_001**2, 200_001**2, 200_000 * 200_001)


def test_areas_of_pairs_are_computed_once_in_batches(spark):
    n = 3000
    ring = lambda x, r: [(x + r * math.cos(2 * math.pi * k / n), r * math.sin(2 * math.pi * k / n)) for k in range(n)]
    rows = spark.createDataFrame([(0, k, ring(50.0 * k, 100.0)) for k in range(3)], f"drawing_id int, id int, polygon {POLY}")
    found = clouds.shared_areas(rows)
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    lens = lambda d: 2 * 100**2 * math.acos(d / 200) - d / 2 * math.sqrt(4 * 100**2 - d * d)
    assert {(r.a, r.b): round(r.both / lens(50 * (r.b - r.a)), 4) for r in found.collect()} == {(0, 1): 1.0, (0, 2): 1.0, (1, 2): 1.0}


def test_lengths_are_summed_in_a_fixed_order(spark):
    rng = random.Random(3)
    box = "box struct<x1:int,y1:int,x2:int,y2:int>"
    rows = []
    for d in range(400):  # lengths of three digits whose sum ends in 5 hundredths: its last bit decides
        parts = [rng.randrange(200_000, 500_000) for _ in range(9)]
        parts[-1] += (50 - sum(parts)) % 100
        rows += [(d, k, k % 2, v / 1000, (0, 0, 1, 1)) for k, v in enumerate(parts)]

    def total(order):
        out = 0.0
        for v in order:
            out += v
        return float(str(round(decimal.Decimal(repr(out)).quantize(decimal.Decimal("0.1"), decimal.ROUND_HALF_UP), 1)))

    of = {d: [r[3] for r in rows if r[0] == d] for d in range(400)}
    ids = {d: total(v[1::2] + v[0::2]) for d, v in of.items()}
    assert any(ids[d] != total(v) for d, v in of.items())  # the order matters
    rng.shuffle(rows)
    segs = spark.createDataFrame(rows, f"drawing_id int, id int, line int, length double, {box}").repartition(7)
    gaps = spark.createDataFrame([(d, 0, 0, 1, True, "high") for d in of], "drawing_id int, ord int, a int, b int, connected boolean, confidence string")
    elbows = spark.createDataFrame([], "drawing_id int, ord int, a int, b int, segment int, type string, confidence string")
    none = spark.createDataFrame([], "drawing_id int, junction int, line int, junction_type string, confidence string")
    made = repair.repair(segs, none.select("drawing_id", "junction"), none.select("drawing_id", "junction", "line"), gaps, elbows, none)
    assert {r.drawing_id: r.length for r in made["lines"].collect()} == ids


def test_siblings_are_counted_where_lists_would_be_quadratic(spark):
    rows = [(0, "r", None), (0, "a", "r"), (0, "b", "r"), (0, "c", "a"), (0, "d", "c"), (1, "r", None)] + [(1, f"k{i}", "r") for i in range(300)]
    tree = spark.createDataFrame(rows, "drawing_id int, node string, parent string")
    named = {(r.drawing_id, r.node): r for r in hierarchy.relatives(tree).collect()}
    counted = {(r.drawing_id, r.node): r for r in hierarchy.relatives(tree, named=False).collect()}
    assert {k: (v.children, len(v.siblings), v.descendants) for k, v in named.items()} == {k: (v.children, v.siblings, v.descendants) for k, v in counted.items()}
    assert {k[1]: (v.siblings, v.descendants) for k, v in named.items() if not k[0]} == {"r": ([], 4), "a": (["b"], 2), "b": (["a"], 0), "c": ([], 1), "d": ([], 0)}
    assert counted[1, "k7"].siblings == 299 and counted[1, "r"].descendants == 300


def test_nearest_in_each_direction_without_a_shuffle_of_pairs(spark):
    from tagloom.operators import spatial

    rng = random.Random(11)
    rows = []
    for d in range(3):
        for i in range(120 if d else 1):
            x, y = rng.randrange(-60, 60), rng.randrange(-60, 60)
            rows.append((d, f"n{i}", (x, y, x + rng.choice([0, 4, 9]), y + rng.choice([0, 4, 9]))))
    want = set()
    for d, a, p in rows:
        ways = {}
        for e, b, q in rows:
            if d == e and a != b:
                u, v = (q[0] + q[2] - p[0] - p[2]) / 2, (q[1] + q[3] - p[1] - p[3]) / 2
                if math.sqrt(u * u + v * v) <= 25:
                    over = p[0] < q[2] and p[2] > q[0] and p[1] < q[3] and p[3] > q[1]
                    way = "overlaps" if over else ("right_of" if u >= 0 else "left_of") if abs(u) >= abs(v) else "below" if v >= 0 else "above"
                    ways.setdefault(way, []).append((math.sqrt(u * u + v * v), b))
        want |= {(d, a, way, b, k + 1) for way, found in ways.items() for k, (_, b) in enumerate(sorted(found)[:3])}
    table = spark.createDataFrame([*rows, (0, None, (0, 0, 1, 1)), (0, "x", None)], "drawing_id int, id string, box struct<x1:int,y1:int,x2:int,y2:int>")
    found = spatial.directions(table, 25, 3)
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()


def test_traces_send_no_table_to_all(spark):
    from tagloom.operators.graph import component_of

    s = spark.createDataFrame(random_segments(random.Random(2), 40, ["pipe"], lambda rng, i: i), SEG)
    asked = s.select("drawing_id", "line", "ord", F.lit(True).alias("continues"), F.lit("high").alias("confidence"), F.array(F.lit("right"), F.lit("up")).alias("directions"))
    found = traces.trace_merges(s, asked, 20, 8)
    edges = s.select("drawing_id", F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    of = component_of(s.select("drawing_id", F.col("id").alias("node")), edges)
    for df in (found, of):
        assert df.count() > 0
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_groups_of_the_log_follow_each_other_in_a_task():
    """A group may go on in the next batch, and the same lines in the next group are lines of their own."""
    import pandas as pd

    from tagloom.operators.repair import _in_order

    one = [(0, 1, k, "gap", a, b, True, True, 1, 1) for k, (a, b) in enumerate([(1, 2), (3, 2), (1, 3)])]
    two = [(0, 2, k, "gap", a, b, True, True, 1, 3) for k, (a, b) in enumerate([(1, 2), (3, 2)])]
    log = pd.DataFrame(one + two, columns="drawing_id __group ord kind a b alive_a alive_b size_a size_b".split())
    done = pd.concat(_in_order(iter([log[:2], log[2:4], log[4:]]), ["drawing_id", "__group"]))
    got = [(x if y == "merged" else None, y) for x, y in zip(done.keep, done.result, strict=True)]
    assert got == [(1, "merged"), (None, "separate"), (1, "merged"), (2, "merged"), (2, "merged")]

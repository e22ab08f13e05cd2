"""Order-dependent and iterative operators against plain Python on small random inputs."""

import random
from collections import deque

from pyspark.sql import functions as F

from tagloom.functions import geometry as g
from tagloom.functions import scores
from tagloom.functions import text as t
from tagloom.operators import dedup, graph, hierarchy, lookup, shaping
from tagloom.sources import adapters, xlsx
from tagloom.sources.documents import detect_format, manifest, read_records, write_records


def one(spark, expr):
    return spark.range(1).select(expr).first()[0]


def test_components_and_greedy(spark):
    rng = random.Random(1)
    edges = [(d, a, b) for d in (0, 1) for _ in range(40) for a, b in [(rng.randrange(40), rng.randrange(40))] if a != b]
    df = spark.createDataFrame(edges, "drawing_id int, a int, b int")
    root = {(d, n): n for d in (0, 1) for n in range(40)}

    def find(d, n):
        while root[d, n] != n:
            n = root[d, n]
        return n

    for d, a, b in edges:
        x, y = find(d, a), find(d, b)
        root[d, max(x, y)] = min(x, y)
    got = {(r.drawing_id, r.node): r.root for r in graph.components(df).collect()}
    assert got == {(d, n): find(d, n) for d, n in {(d, x) for d, a, b in edges for x in (a, b)}}
    near = {(d, min(a, b), max(a, b)) for d, a, b in edges}
    nodes = spark.createDataFrame([(d, n) for d in (0, 1) for n in range(40)], "drawing_id int, id int")
    kept = set()
    for d in (0, 1):
        for n in range(40):
            if not any((d, m, n) in near for m in range(n) if (d, m) in kept):
                kept.add((d, n))
    conflicts = spark.createDataFrame(sorted(near), "drawing_id int, hi int, lo int")
    assert {tuple(r) for r in graph.greedy_keep(nodes, conflicts).collect()} == kept


def test_bfs_visits_in_order(spark):
    rng = random.Random(2)
    edges = [(0, rng.randrange(25), rng.randrange(25)) for _ in range(45)]
    adj = {n: sorted({b if a == n else a for _, a, b in edges if n in (a, b)} - {n}) for n in range(25)}
    parent, depth, q = {0: None}, {0: 0}, deque([0])
    while q:
        u = q.popleft()
        for v in adj[u]:
            if v not in parent:
                parent[v], depth[v] = u, depth[u] + 1
                q.append(v)
    df = graph.bfs_tree(spark.createDataFrame(edges, "drawing_id int, a int, b int"), spark.createDataFrame([(0, 0)], "drawing_id int, node int"))
    assert {r.node: (r.parent, r.depth) for r in df.collect()} == {n: (parent[n], depth[n]) for n in parent}


def test_ancestors_and_cycles(spark):
    up = {1: None, 2: 1, 3: 2, 4: 3, 5: 4, 6: 7, 7: 8, 8: 6, 9: 6, 10: 10}
    df = spark.createDataFrame([(0, n, p) for n, p in up.items()], "drawing_id int, node int, parent int")
    got = {r.node: (r.chain, r.cycle) for r in graph.ancestors(df).collect()}
    assert got[5] == ([4, 3, 2, 1], False) and got[1] == ([], False)
    assert got[10] == ([], True) and got[6] == ([7, 8], True) and got[9] == ([6, 7, 8], True)


def test_duplicate_clusters(spark):
    rows = [(0, 1, "V-BV-2245", 0), (0, 2, "V-BV-2246", 10), (0, 3, "v-bv-2245", 20), (0, 4, "V012", 500), (0, 5, "VO12", 510), (1, 6, "V-BV-2245", 0)]
    df = spark.createDataFrame([(d, i, i, tag, x, 0, x + 40, 40, 0.9 - i / 100, 0.5, 0.5, False, "PASS") for d, i, tag, x in rows], "drawing_id int, id int, ord int, tag string, x1 int, y1 int, x2 int, y2 int, conf double, ocr double, assoc double, in_registry boolean, status string").withColumn("box", g.box())
    got = {r.id: (r.root, r.duplicate_status, r.merged_into) for r in dedup.resolve_duplicates(df).collect()}
    assert got == {1: (1, "PRIMARY", None), 2: (2, "PRIMARY", None), 3: (1, "DISCARDED", 1), 4: (4, "PRIMARY", None), 5: (4, "DISCARDED", 4), 6: (6, "PRIMARY", None)}


def test_pipelines_bridge_gaps(spark):
    """Gaps up to 100 are bridged, longer ones and those across equipment aren't; ends at a junction stay apart."""
    flat = [(1, 0, 0, 400, 0), (2, 480, 0, 900, 0), (3, 1010, 0, 1500, 0), (4, 0, 2000, 400, 2000), (5, 490, 2000, 900, 2000), (6, 0, 4000, 400, 4000), (7, 400, 4000, 800, 4000), (8, 400, 4000, 400, 4500), (9, 400, 4580, 400, 4900)]
    df = spark.createDataFrame([(0, i, *map(float, c)) for i, *c in flat], "drawing_id int, id long, x0 double, y0 double, x1 double, y1 double")
    box = F.struct(F.least("x0", "x1").alias("x1"), F.least("y0", "y1").alias("y1"), F.greatest("x0", "x1").alias("x2"), F.greatest("y0", "y1").alias("y2"))
    seg = df.select("drawing_id", "id", F.struct("x0", "y0", "x1", "y1").alias("seg"), box.alias("box"))
    equipment = spark.createDataFrame([(0, (430.0, 1980.0, 460.0, 2020.0))], "drawing_id int, box struct<x1: double, y1: double, x2: double, y2: double>")

    def groups(**more):
        found = {}
        for r in hierarchy.pipelines(seg, **more)[0].collect():
            found.setdefault(r.pipeline, set()).add(r.id)
        return sorted(map(sorted, found.values()))

    assert groups(equipment=equipment) == [[1, 2], [3], [4], [5], [6], [7], [8, 9]]
    assert groups() == [[1, 2], [3], [4, 5], [6], [7], [8, 9]]


def plain_stitch(rows, dy=30, gap=120):
    """The first pair that fits, in order of id, is joined; then all pairs are tried anew."""

    def made(a, b):
        if b[1] in a[1] or a[1] in b[1]:
            return max(a[1], b[1], key=len)
        n = next((n for n in range(min(len(a[1]), len(b[1])), 3, -1) if a[1][-n:] == b[1][:n]), 0)
        return a[1] + b[1][n:] if n else ""

    live = [[i, tag, x1, y1, x2, y2, 1] for i, tag, x1, y1, x2, y2 in sorted(rows)]
    while True:
        fit = next(((i, j) for i, a in enumerate(live) for j, b in enumerate(live) if i != j and abs((a[3] + a[5]) - (b[3] + b[5])) / 2 <= dy and -gap <= b[2] - a[4] <= gap and len(made(a, b)) > max(len(a[1]), len(b[1]))), None)
        if fit is None:
            return {r[0]: (r[1], r[6]) for r in live}
        a, b = live[fit[0]], live[fit[1]]
        a[:] = [min(a[0], b[0]), made(a, b), min(a[2], b[2]), min(a[3], b[3]), max(a[4], b[4]), max(a[5], b[5]), a[6] + b[6]]
        del live[fit[1]]


def plain_leaders(points, radius):
    heads, out = [], {}
    for i, x, y in sorted(points):
        k = next((k for k, (u, v) in enumerate(heads) if ((x - u) ** 2 + (y - v) ** 2) ** 0.5 < radius), len(heads))
        heads += [(x, y)] if k == len(heads) else []
        out[i] = k
    return out


def plain_running(points, radius):
    out, k, own = {}, -1, []
    for x, i, y in sorted((x, i, y) for i, x, y in points):
        if own and ((x - sum(p[0] for p in own) / len(own)) ** 2 + (y - sum(p[1] for p in own) / len(own)) ** 2) ** 0.5 <= radius:
            own.append((x, y))
        else:
            k, own = k + 1, [(x, y)]
        out[i] = k
    return out


def test_stitch_and_clusters_against_plain_python(spark):
    rng = random.Random(7)
    rows = []
    for d in range(12):
        for i in range(70):
            x, y, at = rng.randrange(0, 900), rng.randrange(-60, 60), rng.randrange(0, 12)
            rows.append((d, i, "ABABCABCABCDABCDEABCDEF"[at : at + rng.randrange(5, 9)], x, y, x + rng.randrange(10, 200), y + rng.randrange(5, 40)))
    df = spark.createDataFrame(rows, "drawing_id int, id long, tag string, x1 int, y1 int, x2 int, y2 int").select("drawing_id", "id", "tag", F.struct("x1", "y1", "x2", "y2").alias("box"))
    stitched, leaders, running = ({}, {}, {})
    for r in dedup.stitch(df).collect():
        stitched.setdefault(r.drawing_id, {})[r.id] = (r.tag, r.parts)
    for f, into in ((dedup.leader_clusters, leaders), (dedup.running_clusters, running)):
        for r in f(df, 60).collect():
            into.setdefault(r.drawing_id, {})[r.id] = r.cluster
    for d in range(12):
        own = [r[1:] for r in rows if r[0] == d]
        assert stitched[d] == plain_stitch(own) and len(stitched[d]) < 60
        points = [(i, (x1 + x2) / 2, (y1 + y2) / 2) for i, _, x1, y1, x2, y2 in own]
        assert leaders[d] == plain_leaders(points, 60)
        assert running[d] == plain_running(points, 60)


def test_stitch_and_clusters_read_every_box(spark):
    from tagloom.plans import queries

    n = queries.boxes(spark, "/root/testdata/sf0.001").count()
    assert queries.QUERIES["greedy_clusters"](spark, "/root/testdata/sf0.001").count() == n
    assert queries.QUERIES["line_stitch"](spark, "/root/testdata/sf0.001").agg(F.sum("parts")).first()[0] == n


def test_stitch(spark):
    rows = [(0, 1, "2IN-GV-V273-11", 0, 100), (0, 2, "GV-V273-11502X", 150, 260), (0, 3, "10IN-ETH-V1-C03B", 2000, 2200)]
    df = spark.createDataFrame([(d, i, tag, a, 0, b, 20) for d, i, tag, a, b in rows], "drawing_id int, id int, tag string, x1 int, y1 int, x2 int, y2 int").withColumn("box", g.box())
    assert {r.id: r.tag for r in dedup.stitch(df).collect()} == {1: "2IN-GV-V273-11502X", 3: "10IN-ETH-V1-C03B"}


def test_scores(spark):
    c = scores.confidence(F.lit(0.8), F.lit(0.0), F.lit(0.6), F.lit(0.0), F.lit(None).cast("double"), F.lit(True))
    got = one(spark, c)
    assert got.c_ocr_eff == 0.72 and got.c_geo == 0.3 and got.c_val == 0.5 and got.c_final == round(0.24 + 0.216 + 0.045 + 0.1 + 0.025, 4)
    strict = one(spark, scores.confidence(F.lit(0.8), F.lit(0.0), F.lit(0.6), F.lit(0.0), F.lit(0.5), None, True))
    assert strict.c_val == 0.0
    assert one(spark, scores.check_value(F.from_json(F.lit('[{"pass":true},{"pass":null}]'), "array<struct<pass:boolean>>"))) == 0.5


def test_text(spark):
    assert one(spark, t.normalize_tag(F.lit("V FZ-208"))) == "V-FZ-208"
    assert one(spark, t.normalize_tag(F.lit("10''--GV - V272"))) == "10IN-GV-V272"
    assert one(spark, t.dedup_key(F.lit('10"—PIN-7'))) == "10P7"
    assert one(spark, t.overlap_concat(F.lit("2IN-GV-V273-11"), F.lit("GV-V273-11502X"))) == "2IN-GV-V273-11502X"
    assert one(spark, t.is_line_number(F.lit("4INX3IN-ETH-VO06-C03B-PP"))) is True
    assert one(spark, t.tag_similarity(F.lit("V012"), F.lit("VO12"))) == 0.9
    assert t.parse_lenient("```json\n{'a': 1,}\n```") == '{"a": 1}' and t.parse_lenient("no json") is None


def test_geometry(spark):
    square = F.from_json(F.lit('[{"x":0,"y":0},{"x":10,"y":0},{"x":10,"y":10},{"x":0,"y":10}]'), "array<struct<x:double,y:double>>")
    assert one(spark, g.polygon_area(square)) == 100.0
    assert one(spark, g.point_in_polygon(F.lit(5.0), F.lit(5.0), square)) and not one(spark, g.point_in_polygon(F.lit(15.0), F.lit(5.0), square))
    assert one(spark, g.run_lengths(F.array(*[F.lit(x) for x in (0, 0, 1, 1, 1, 0)]))) == [2, 3, 1]
    assert one(spark, shaping.spaced_values(F.array(*[F.lit(x) for x in (1, 3, 6, 7, 20)]), 4)) == [1, 6, 20]


def test_flow_and_lines(spark):
    ev = spark.createDataFrame([(0, "L1", "arrow", 1, "FWD"), (0, "L1", "check_valve", 2, "REV"), (0, "L2", "arrow", 3, "FWD")], "drawing_id int, node string, kind string, id int, value string")
    assert {r.node: (r.value, r.conflict) for r in hierarchy.seed_flow(ev).collect()} == {"L1": ("REV", True), "L2": ("FWD", False)}
    members = spark.createDataFrame([(0, i, p) for i, p in enumerate("AABBBC")], "drawing_id int, id int, pipeline string")
    pairs = spark.createDataFrame([(0, "A", "B")], "drawing_id int, a string, b string")
    assert {r.id: r.pipeline for r in hierarchy.merge_lines(members, pairs).collect()} == {0: "B", 1: "B", 2: "B", 3: "B", 4: "B", 5: "C"}


def test_workbook_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("V-BV-1", "MECHANICAL", 'a & "b"', None), ("", "X", "", "")], "`TAG NUMBER` string, DISCIPLINE string, `TAG DESCRIPTION` string, `EQUIPMENT DESCRIPTION` string")
    (tmp_path / "r.xlsx").write_bytes(xlsx.workbook({"Register": df, "Empty": df.limit(0)}))
    rows = xlsx.read_xlsx(spark, str(tmp_path / "r.xlsx"))
    assert rows.where("sheet = 'Empty'").count() == 1
    got = xlsx.registry_rows(rows.where("sheet = 'Register'")).collect()
    assert [(r.tag, r.description, r.equipment_description) for r in got] == [("V-BV-1", 'a & "b"', None)]


def test_documents(spark, tmp_path):
    (tmp_path / "D1.json").write_text('{"version": "1", "candidates": [{"candidate_id": "a", "tag_text": "X", "symbol_bbox": {"x1": 1, "y1": 2, "x2": 3, "y2": 4}}, {"candidate_id": "b"}]}')
    rows = read_records(spark, str(tmp_path))
    assert [(r.drawing_id, r.ord, r.candidate_id, r.tag_text) for r in rows.orderBy("ord").collect()] == [("D1", 0, "a", "X"), ("D1", 1, "b", None)]
    assert write_records(rows, str(tmp_path / "out"), {"tagged": F.count("tag_text")}).first() == (2, 1)
    assert [tuple(r) for r in manifest({"5a": rows, "5d": rows.limit(1)}).orderBy("ord").collect()] == [(0, "5a", 2), (1, "5d", 1)]
    f = spark.createDataFrame([("a.PDF", 2, 60), ("b.pdf", 0, 0), ("c.tif", 0, 0), ("d.doc", 0, 0)], "path string, font_count int, text_len int")
    assert [r.kind for r in detect_format(f).collect()] == ["vector", "raster", "raster", "unsupported"]


def test_adapter_cache(spark):
    req = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id int, q string")
    cache = req.where("q = 'a'").select(F.sha2(F.concat_ws("\x1f", "q"), 256).alias("key"), F.lit("yes").alias("answer"))
    got, new = adapters.answer(req, cache, ["q"], lambda f: ["asked"] * len(f))
    assert {r.id: r.answer for r in got.collect()} == {1: "yes", 2: "asked", 3: "asked"} and new.count() == 1


def test_recall_bounds(spark):
    truth = spark.createDataFrame([("V-BV-1",), ("V-BV-12345",), ("ZZ",)], "tag string")
    found = spark.createDataFrame([("BV1", 1), ("V-BV-1", 2), ("VBV123", 3)], "tag string, ord int")
    assert {r.tag: r.hit for r in lookup.recall(truth, found).collect()} == {"V-BV-1": "V-BV-1", "V-BV-12345": "VBV123", "ZZ": None}


def test_components_need_no_rounds_where_tasks_hold_them(spark, monkeypatch):
    """Edges of a drawing come together, so a path of 3,000 nodes is one star before the first round; one larger than what a task holds still joins."""
    path = [(d, k, k + 1) for d in (1, 2) for k in range(3000)]
    df = spark.createDataFrame([*path, (3, 5, 5), (None, 7, 8)], "drawing_id int, a long, b long").repartition(7)
    got = sorted(tuple(r) for r in graph.components(df, max_rounds=1).select("drawing_id", "node", "root").collect())
    assert got == sorted((d, k, 0) for d in (1, 2) for k in range(3001))
    names = spark.createDataFrame([(f"N{k}", f"N{k + 1}") for k in range(100, 300)], "a string, b string").repartition(5)
    assert {tuple(r) for r in graph.components(names, []).select("node", "root").collect()} == {(f"N{k}", "N100") for k in range(100, 301)}
    monkeypatch.setattr(graph, "_EDGES", 100)
    got = sorted(tuple(r) for r in graph.components(df).select("drawing_id", "node", "root").collect())
    assert got == sorted((d, k, 0) for d in (1, 2) for k in range(3001))


def test_propagation_reads_two_levels_a_round(spark, monkeypatch):
    """However long the walk is, a round reads the edges and two levels; repeated edges don't count twice."""
    read, staged = [], graph.staged

    def watched(df, label="t"):
        read.append(len({f.rsplit("/", 1)[0] for f in df.inputFiles()}))
        return staged(df, label)

    monkeypatch.setattr(graph, "staged", watched)
    edges = spark.createDataFrame([(1, k, k + 1) for k in range(8)] + [(1, 1, 0)], "drawing_id int, a int, b int")
    seeds = spark.createDataFrame([(1, 0, "B"), (1, 0, "A"), (1, 8, "C")], "drawing_id int, node int, value string")
    got = {r.node: (r.value, r.hops) for r in graph.propagate(seeds, edges).collect()}
    assert got == {k: ("A", k) for k in range(5)} | {k: ("C", 8 - k) for k in range(5, 9)}
    assert max(read) <= 3

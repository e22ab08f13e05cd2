"""Queries of oriented flow, pipe repair, attachments and clouds, with SQL that spells out its own values."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tagloom.functions import text as t
from tagloom.operators import attach, clouds, dedup, flow, hierarchy, oriented, payloads, register, repair, reports, shaping, sow, spatial, traces
from tagloom.plans.fixtures import boxes, segments, table
from tagloom.plans.queries import _D, _IOU, _pd, B, S, query

RS = S.replace("WITH ", "WITH RECURSIVE ", 1)


def _point(x, y):
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def _rows(spark, d):
    """Segments with the ids of the next and of the third next in their drawing."""
    w = Window.partitionBy("drawing_id").orderBy("id")
    return segments(spark, d).withColumn("n1", F.lead("id").over(w)).withColumn("n3", F.lead("id", 3).over(w))


_JUNCTIONS = """
w AS (SELECT *, lead(id) OVER (PARTITION BY drawing_id ORDER BY id) AS n1, lead(id, 3) OVER (PARTITION BY drawing_id ORDER BY id) AS n3 FROM seg),
j AS (SELECT drawing_id, id * 2 AS j, sx1 AS x, sy1 AS y, CASE WHEN id % 11 = 0 THEN 3 ELSE 2 END AS degree, id AS a, n1 AS b, CASE WHEN id % 13 = 0 THEN n3 END AS c FROM w WHERE n1 IS NOT NULL AND id % 7 <> 0
      UNION ALL SELECT drawing_id, id * 2 + 1, sx1, sy1, 2, id, n3, NULL FROM w WHERE n3 IS NOT NULL AND id % 4 = 0),
m AS (SELECT DISTINCT drawing_id, j, x, y, degree, line FROM (SELECT drawing_id, j, x, y, degree, unnest([a, b, c]) AS line FROM j) WHERE line IS NOT NULL),
e AS (SELECT m.*, (sx0 - x) ** 2 + (sy0 - y) ** 2 <= (sx1 - x) ** 2 + (sy1 - y) ** 2 AS at_a FROM m JOIN seg ON seg.drawing_id = m.drawing_id AND seg.id = m.line),
z AS (SELECT drawing_id, j, count(*) AS n, max(degree) AS degree FROM e GROUP BY 1, 2),
lk AS (SELECT p.drawing_id, p.j, p.line AS p, q.line AS q, p.at_a = q.at_a AS flip FROM e p JOIN e q ON p.drawing_id = q.drawing_id AND p.j = q.j AND p.line <> q.line JOIN z ON z.drawing_id = p.drawing_id AND z.j = p.j WHERE z.n = 2 AND z.degree <= 2)"""


def _flow(spark, d):
    r = _rows(spark, d)
    end = F.col("seg")
    one = r.where("n1 IS NOT NULL AND id % 7 <> 0").select("drawing_id", (F.col("id") * 2).alias("junction"), end["x1"].alias("x"), end["y1"].alias("y"), F.when(F.col("id") % 11 == 0, 3).otherwise(2).alias("degree"), F.array("id", "n1", F.when(F.col("id") % 13 == 0, F.col("n3"))).alias("lines"))
    two = r.where("n3 IS NOT NULL AND id % 4 = 0").select("drawing_id", (F.col("id") * 2 + 1).alias("junction"), end["x1"].alias("x"), end["y1"].alias("y"), F.lit(2).alias("degree"), F.array("id", "n3", F.lit(None).cast("bigint")).alias("lines"))
    junctions = one.unionAll(two).withColumn("ord", F.col("junction"))
    meets = junctions.select("drawing_id", "junction", F.explode(F.array_compact("lines")).alias("line"))
    axes = segments(spark, d).select("drawing_id", F.col("id").alias("line"), _point(end["x0"], end["y0"]).alias("a"), _point(end["x1"], end["y1"]).alias("b"))
    seeds = axes.where("line % 9 = 0").select("drawing_id", "line", F.when(F.col("line") % 2 == 0, "forward").otherwise("reverse").alias("direction"), F.lit("arrowhead").alias("evidence"), F.col("line").alias("ord"))
    return oriented.flow_propagation(seeds, meets, junctions, axes)


_FLOW = f"""{RS}, {_JUNCTIONS},
st AS (SELECT drawing_id, id AS line, id % 2 = 0 AS fwd, 0 AS hops, row_number() OVER (ORDER BY drawing_id, id) AS rnk, 0 AS it FROM seg WHERE id % 9 = 0
UNION ALL (WITH nw AS (SELECT lk.drawing_id, lk.q AS line, arg_min(st.fwd <> lk.flip, (st.rnk, lk.j)) AS fwd, min((st.rnk, lk.j)) AS r, max(st.it) + 1 AS it FROM st JOIN lk ON st.drawing_id = lk.drawing_id AND st.line = lk.p WHERE st.hops = st.it AND NOT EXISTS (SELECT 1 FROM st s WHERE s.drawing_id = lk.drawing_id AND s.line = lk.q) GROUP BY 1, 2)
SELECT drawing_id, line, fwd, hops, rnk, it + 1 FROM st WHERE EXISTS (SELECT 1 FROM nw) UNION ALL SELECT drawing_id, line, fwd, it, row_number() OVER (ORDER BY drawing_id, r), it FROM nw)),
f AS (SELECT * FROM st WHERE it = (SELECT max(it) FROM st))"""


@query(f"{_FLOW} SELECT drawing_id, line, CASE WHEN fwd THEN 'forward' ELSE 'reverse' END AS direction, CASE WHEN hops = 0 THEN 'arrowhead' ELSE 'propagated' END AS evidence, hops FROM f")
def flow_propagation(spark, d):
    return _flow(spark, d)[0]


@query(f"{_FLOW} SELECT DISTINCT e.drawing_id, e.j AS junction FROM e JOIN z ON e.drawing_id = z.drawing_id AND e.j = z.j JOIN f ON f.drawing_id = e.drawing_id AND f.line = e.line WHERE z.n > 2 OR z.degree > 2")
def flow_splits(spark, d):
    return _flow(spark, d)[1]


def _pipes(spark, d):
    """Segments as lines of one to four; every ninth has none."""
    n = F.col("id")
    s = F.col("seg")
    length = F.sqrt((s["x1"] - s["x0"]) * (s["x1"] - s["x0"]) + (s["y1"] - s["y0"]) * (s["y1"] - s["y0"])).cast("double")
    return _rows(spark, d).withColumn("line", F.when(n % 9 != 8, n - n % 4)).withColumn("length", F.round(length, 3))


_LOG = f"""{RS}, w AS (SELECT *, CASE WHEN id % 9 <> 8 THEN id - id % 4 END AS line, lead(id) OVER (PARTITION BY drawing_id ORDER BY id) AS n1, lead(id, 3) OVER (PARTITION BY drawing_id ORDER BY id) AS n3 FROM seg),
ln AS (SELECT drawing_id, line, count(*) AS size, row_number() OVER (PARTITION BY drawing_id ORDER BY line) AS pos FROM w WHERE line IS NOT NULL GROUP BY 1, 2),
g0 AS (SELECT drawing_id, 0 AS phase, id AS ord, 'gap' AS kind, id - id % 4 AS a, n1 - n1 % 4 AS b, CAST(NULL AS BIGINT) AS segment FROM w WHERE id % 3 = 0 AND n1 - n1 % 4 <> id - id % 4 AND id % 5 <> 1
      UNION ALL SELECT drawing_id, 0, id, 'gap', id - id % 4, n3 - n3 % 4, NULL FROM w WHERE id % 3 = 1 AND n3 - n3 % 4 <> id - id % 4 AND id % 5 <> 1
      UNION ALL SELECT drawing_id, 1, id, 'elbow', n1 - n1 % 4, n3 - n3 % 4, id FROM w WHERE id % 9 = 8 AND n3 IS NOT NULL AND id % 4 <> 2),
lg AS (SELECT g0.*, row_number() OVER (PARTITION BY g0.drawing_id ORDER BY phase, ord) AS k, la.pos AS pa, lb.pos AS pb FROM g0 LEFT JOIN ln la ON la.drawing_id = g0.drawing_id AND la.line = g0.a LEFT JOIN ln lb ON lb.drawing_id = g0.drawing_id AND lb.line = g0.b WHERE g0.a IS NOT NULL AND g0.b IS NOT NULL),
st AS (SELECT drawing_id, list(size ORDER BY pos) AS z, 0::BIGINT AS k, NULL::BIGINT AS kp, NULL::BIGINT AS dp FROM ln GROUP BY 1
UNION ALL SELECT drawing_id, list_transform(z, lambda v, i: CASE WHEN i = dp THEN 0 WHEN i = kp THEN v + coalesce(z[dp], 0) + (kind = 'elbow')::INT ELSE v END), k, kp, dp FROM
 (SELECT *, CASE WHEN kind = 'gap' THEN CASE WHEN kp = pa THEN pb WHEN kp = pb THEN pa END WHEN kp = pa AND pb <> pa AND coalesce(z[pb], 0) > 0 THEN pb END AS dp FROM
  (SELECT st.drawing_id, z, lg.k, kind, pa, pb, CASE WHEN kind = 'gap' THEN CASE WHEN coalesce(z[pa], 0) > 0 AND coalesce(z[pb], 0) > 0 THEN CASE WHEN z[pb] > z[pa] THEN pb ELSE pa END END WHEN coalesce(z[pa], 0) > 0 THEN pa WHEN coalesce(z[pb], 0) > 0 THEN pb END AS kp FROM st JOIN lg ON st.drawing_id = lg.drawing_id AND lg.k = st.k + 1) x) y),
done AS (SELECT st.drawing_id, lg.ord, lg.kind, lg.segment, a.line AS keep, b.line AS "drop" FROM st JOIN lg ON st.drawing_id = lg.drawing_id AND st.k = lg.k LEFT JOIN ln a ON a.drawing_id = st.drawing_id AND a.pos = st.kp LEFT JOIN ln b ON b.drawing_id = st.drawing_id AND b.pos = st.dp)"""


def _answers(spark, d):
    r, n = _rows(spark, d), F.col("id")
    pipes = _pipes(spark, d)
    base = lambda c: F.col(c) - F.col(c) % 4
    one = r.where("id % 3 = 0").select("drawing_id", n.alias("ord"), base("id").alias("a"), base("n1").alias("b"))
    two = r.where("id % 3 = 1").select("drawing_id", n.alias("ord"), base("id").alias("a"), base("n3").alias("b"))
    gaps = one.unionAll(two).where("a <> b").withColumn("connected", F.lit(True)).withColumn("confidence", F.when(F.col("ord") % 5 == 1, "low").when(F.col("ord") % 2 == 0, "High").otherwise("medium"))
    elbows = r.where("id % 9 = 8 AND n3 IS NOT NULL").select("drawing_id", n.alias("ord"), base("n1").alias("a"), base("n3").alias("b"), n.alias("segment"), F.when(n % 4 == 2, "noise").otherwise("elbow").alias("type"), F.lit("high").alias("confidence"))
    junctions = r.where("id % 2 = 0").select("drawing_id", n.alias("junction"))
    meets = r.where("id % 2 = 0").select("drawing_id", n.alias("junction"), F.explode(F.array_compact(F.array(base("id"), base("n1"), base("n3")))).alias("line"))
    crossings = junctions.where("junction % 6 = 0").withColumn("junction_type", F.lit("crossing")).withColumn("confidence", F.when(F.col("junction") % 12 == 0, "high").otherwise("low"))
    return repair.repair(pipes.select("drawing_id", "id", "line", "length", "box"), junctions, meets, gaps, elbows, crossings)


@query(f"""{_LOG} SELECT drawing_id, kind, CASE WHEN kind = 'gap' THEN ord ELSE segment END AS entry, keep, "drop", CASE WHEN kind = 'gap' THEN CASE WHEN keep IS NULL THEN 'separate' ELSE 'merged' END WHEN keep IS NULL THEN 'noise' ELSE 'elbow' END AS result FROM done""")
def merge_log(spark, d):
    """Elbows are known by their segment, their place in the log comes after the gaps'."""
    after = _gap_ends(spark, d)
    m = _answers(spark, d)["merges"].join(after, "drawing_id", "left")
    return m.select("drawing_id", "kind", F.when(F.col("kind") == "gap", F.col("ord")).otherwise(F.col("ord") - F.coalesce("after", F.lit(0))).alias("entry"), "keep", "drop", "result")


def _gap_ends(spark, d):
    r = _rows(spark, d)
    base = lambda c: F.col(c) - F.col(c) % 4
    other = F.when(F.col("id") % 3 == 0, base("n1")).when(F.col("id") % 3 == 1, base("n3"))
    return r.where((other != base("id")) & (F.col("id") % 5 != 1)).groupBy("drawing_id").agg((F.max("id") + 1).alias("after"))


_INTO = """, up AS (SELECT drawing_id, "drop" AS line, keep AS into_line FROM done WHERE "drop" IS NOT NULL UNION ALL SELECT up.drawing_id, up.line, d.keep FROM up JOIN done d ON d.drawing_id = up.drawing_id AND d."drop" = up.into_line),
root AS (SELECT drawing_id, line, into_line FROM up WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.drawing_id = up.drawing_id AND d."drop" = up.into_line))"""


@query(f"""{_LOG}{_INTO}, own AS (SELECT w.drawing_id, w.id, coalesce(d.keep, w.line) AS line, sx0, sy0, sx1, sy1 FROM w LEFT JOIN done d ON d.drawing_id = w.drawing_id AND d.segment = w.id AND d.keep IS NOT NULL)
SELECT own.drawing_id, coalesce(root.into_line, own.line) AS line, count(*) AS segments, round(sum(round(sqrt((sx1 - sx0) ** 2.0 + (sy1 - sy0) ** 2.0), 3)), 1) AS length, min(sx0) AS x1, min(sy0) AS y1, max(sx1) AS x2, max(sy1) AS y2
FROM own LEFT JOIN root ON root.drawing_id = own.drawing_id AND root.line = own.line WHERE own.line IS NOT NULL GROUP BY 1, 2""")
def pipe_repair(spark, d):
    return _answers(spark, d)["lines"].select("drawing_id", "line", "segments", "length", "box.x1", "box.y1", "box.x2", "box.y2")


@query(f"""{_LOG}{_INTO}, m AS (SELECT drawing_id, id AS junction, unnest([id - id % 4, n1 - n1 % 4, n3 - n3 % 4]) AS line FROM w WHERE id % 2 = 0 AND id % 12 <> 0)
SELECT DISTINCT m.drawing_id, m.junction, coalesce(root.into_line, m.line) AS line FROM m LEFT JOIN root ON root.drawing_id = m.drawing_id AND root.line = m.line WHERE m.line IS NOT NULL""")
def repaired_junctions(spark, d):
    return _answers(spark, d)["meets"]


_TYPED = "SELECT drawing_id, id, id AS ord, CASE WHEN id % 2 = 1 THEN id % 30 END AS line, CASE WHEN id % 6 IN (0, 2) THEN 'diagonal_pipe' WHEN id % 6 IN (1, 5) THEN 'horizontal_pipe' ELSE 'vertical_pipe' END AS type, sx0, sy0, sx1, sy1 FROM seg"


@query(f"""{S}, t AS ({_TYPED}), e AS (SELECT drawing_id, ord, line, 0 AS e, sx0 AS x, sy0 AS y FROM t WHERE type <> 'diagonal_pipe' AND line IS NOT NULL UNION ALL SELECT drawing_id, ord, line, 1, sx1, sy1 FROM t WHERE type <> 'diagonal_pipe' AND line IS NOT NULL),
p AS (SELECT d.drawing_id, d.id, k, e.line, e.e, e.ord, sqrt((CASE k WHEN 0 THEN sx0 ELSE sx1 END - x) ** 2.0 + (CASE k WHEN 0 THEN sy0 ELSE sy1 END - y) ** 2.0) AS d FROM (SELECT *, unnest([0, 1]) AS k FROM t WHERE type = 'diagonal_pipe') d JOIN e ON d.drawing_id = e.drawing_id),
n AS (SELECT drawing_id, id, k, arg_min(line, (d, -e, -ord)) AS line FROM p WHERE d <= 400 GROUP BY 1, 2, 3) SELECT a.drawing_id, a.id AS segment, a.line AS a, b.line AS b FROM n a JOIN n b ON a.drawing_id = b.drawing_id AND a.id = b.id WHERE a.k = 0 AND b.k = 1""")
def elbow_candidates(spark, d):
    """A radius of 400, as the table's segments seldom come within 50."""
    n = F.col("id")
    kind = F.when((n % 6).isin(0, 2), "diagonal_pipe").when((n % 6).isin(1, 5), "horizontal_pipe").otherwise("vertical_pipe")
    return repair.elbow_candidates(segments(spark, d).withColumn("type", kind).withColumn("line", F.when(n % 2 == 1, n % 30)), 400)


def trace_merges(spark, d):
    """Each segment is a line; every third is traced on."""
    n = F.col("id")
    s = segments(spark, d).withColumn("line", n)
    sides = F.when(n % 4 == 0, F.array(F.lit("left"), F.lit("down"))).when(n % 4 == 1, F.array(F.lit("RIGHT"))).otherwise(F.array(F.lit("up"), F.lit("right"), F.lit("left")))
    asked = s.where("id % 3 = 0").select("drawing_id", "line", n.alias("ord"), (n % 5 != 1).alias("continues"), F.when(n % 2 == 0, "high").otherwise("Medium").alias("confidence"), sides.alias("directions"))
    return traces.trace_merges(s, asked, 150, 30)


query()(trace_merges)

_MOTOR = """q AS (SELECT drawing_id, id, x1, y1, x2, y2, id % 17 = 3 AS filtered, CASE WHEN id % 17 = 3 THEN CASE WHEN id % 2 = 0 THEN 'KM-V-201' ELSE ' km-v-202' END WHEN id % 3 = 0 THEN 'X-1' ELSE '' END AS tag, id % 2 = 0 AS motor FROM boxes),
l AS (SELECT drawing_id, upper(trim(tag)) AS site, arg_min((x1 + x2) / 2.0, id) AS x, arg_min((y1 + y2) / 2.0, id) AS y FROM q WHERE filtered GROUP BY 1, 2),
p AS (SELECT q.drawing_id, l.site, q.id FROM q JOIN l ON q.drawing_id = l.drawing_id WHERE NOT filtered AND motor AND tag = '' AND sqrt(((x1 + x2) / 2.0 - x) ** 2 + ((y1 + y2) / 2.0 - y) ** 2) <= 4000),
one AS (SELECT drawing_id, site, min(id) AS id FROM p WHERE site = 'KM-V-201' GROUP BY 1, 2), two AS (SELECT p.drawing_id, p.site, min(p.id) AS id FROM p LEFT JOIN one ON one.drawing_id = p.drawing_id AND one.id = p.id WHERE p.site = 'KM-V-202' AND one.id IS NULL GROUP BY 1, 2)"""


@query(f"{B}, {_MOTOR} SELECT drawing_id, id, site AS tag FROM one UNION ALL SELECT drawing_id, id, site FROM two")
def motor_proxies(spark, d):
    """Two site tags that contend for boxes within a reach of 4,000."""
    n = F.col("id")
    tag = F.when(n % 17 == 3, F.when(n % 2 == 0, "KM-V-201").otherwise(" km-v-202")).when(n % 3 == 0, "X-1").otherwise("")
    rows = boxes(spark, d).withColumn("tag", tag).withColumn("filtered", n % 17 == 3).withColumn("symbol_name", F.when(n % 2 == 0, "Motor, electric").otherwise("pump")).withColumn("category", F.when(n % 17 == 3, "equipment").otherwise("valve"))
    return attach.motor_proxies(rows, ("KM-V-201", "KM-V-202"), 4000)


_ATTACH = """n AS (SELECT drawing_id, id, id // 2 % 6 AS cluster, CASE WHEN id % 3 = 0 THEN 'V-PIT-' WHEN id % 3 = 1 THEN 'A-PIT-' ELSE 'tt-' END || CAST(id % 90 + 10 AS VARCHAR) AS tag FROM boxes WHERE id % 2 = 0),
q AS (SELECT drawing_id, id, CASE WHEN id % 4 = 1 THEN 'K-V-' ELSE 'S-V-' END || CAST(id % 60 + 200 AS VARCHAR) AS tag, id % 5 = 0 AS flat FROM boxes WHERE id % 2 = 1),
t AS (SELECT drawing_id, id AS ord, id // 2 % 6 AS cluster, CASE WHEN id % 7 = 0 THEN 'x-pit-' ELSE 'TT-' END || CAST(id % 90 + 10 AS VARCHAR) AS i, CASE WHEN id % 4 = 0 THEN 'Z-V-' WHEN id % 4 = 1 THEN 'K-V-' WHEN id % 4 = 2 THEN 's-v-' ELSE 'V-' END || CAST((id + 1) % 70 + 200 AS VARCHAR) AS e, CASE WHEN id % 8 = 0 THEN 'Low' WHEN id % 8 < 4 THEN 'high' ELSE 'Medium' END AS c FROM boxes),
ni AS (SELECT drawing_id, cluster, upper(tag) AS m, arg_min(id, id) AS node FROM n GROUP BY 1, 2, 3), qi AS (SELECT drawing_id, upper(tag) AS m, arg_min(id, id) AS node FROM q GROUP BY 1, 2),
ix AS (SELECT t.drawing_id, t.ord, arg_min(node, (CASE WHEN ni.m = upper(i) THEN 0 WHEN regexp_replace(ni.m, '^[A-Z]+-', '') = regexp_replace(upper(i), '^[A-Z]+-', '') THEN 1 ELSE 2 END, ni.m)) AS node FROM t JOIN ni ON t.drawing_id = ni.drawing_id AND t.cluster = ni.cluster AND (ni.m = upper(i) OR regexp_replace(ni.m, '^[A-Z]+-', '') = regexp_replace(upper(i), '^[A-Z]+-', '') OR (length(regexp_replace(upper(i), '^[A-Z]+-', '')) >= 3 AND ends_with(ni.m, regexp_replace(upper(i), '^[A-Z]+-', '')))) GROUP BY 1, 2),
ex AS (SELECT t.drawing_id, t.ord, arg_min(node, (CASE WHEN qi.m = upper(e) THEN 0 WHEN regexp_replace(qi.m, '^[A-Z]+-', '') = regexp_replace(upper(e), '^[A-Z]+-', '') THEN 1 ELSE 2 END, qi.m)) AS node FROM t JOIN qi ON t.drawing_id = qi.drawing_id AND (qi.m = upper(e) OR regexp_replace(qi.m, '^[A-Z]+-', '') = regexp_replace(upper(e), '^[A-Z]+-', '') OR (length(regexp_replace(upper(e), '^[A-Z]+-', '')) >= 3 AND ends_with(qi.m, regexp_replace(upper(e), '^[A-Z]+-', '')))) GROUP BY 1, 2)"""


@query(f"""{B}, {_ATTACH}, r AS (SELECT t.*, ix.node AS a, ex.node AS b FROM t LEFT JOIN ix ON ix.drawing_id = t.drawing_id AND ix.ord = t.ord LEFT JOIN ex ON ex.drawing_id = t.drawing_id AND ex.ord = t.ord WHERE lower(c) <> 'low' AND ix.node IS NOT NULL AND ex.node IS NOT NULL AND e NOT LIKE 'V-%')
SELECT r.drawing_id, 'E-' || CAST(row_number() OVER (PARTITION BY r.drawing_id ORDER BY cluster, ord) - 1 AS VARCHAR) AS edge_id, a, b, CASE WHEN b % 5 = 0 THEN 0.4 WHEN lower(c) = 'high' THEN 0.85 ELSE 0.65 END::DOUBLE AS confidence FROM r""")
def attachment_edges(spark, d):
    return _attached(spark, d)[0].select("drawing_id", "edge_id", "a", "b", "confidence")


def _attached(spark, d):
    n = F.col("id")
    b = boxes(spark, d)
    inst = b.where("id % 2 = 0").select("drawing_id", F.expr("(id div 2) % 6").alias("cluster"), F.concat(F.when(n % 3 == 0, "V-PIT-").when(n % 3 == 1, "A-PIT-").otherwise("tt-"), n % 90 + 10).alias("tag"), n.alias("node"), n.alias("ord"))
    equip = b.where("id % 2 = 1").select("drawing_id", F.concat(F.when(n % 4 == 1, "K-V-").otherwise("S-V-"), n % 60 + 200).alias("tag"), n.alias("node"), n.alias("ord"), (n % 5 == 0).alias("label_only"))
    told = b.select("drawing_id", F.expr("(id div 2) % 6").alias("cluster"), n.alias("ord"), F.concat(F.when(n % 7 == 0, "x-pit-").otherwise("TT-"), n % 90 + 10).alias("instrument_tag"), F.concat(F.when(n % 4 == 0, "Z-V-").when(n % 4 == 1, "K-V-").when(n % 4 == 2, "s-v-").otherwise("V-"), (n + 1) % 70 + 200).alias("parent_equipment"), F.when(n % 8 == 0, "Low").when(n % 8 < 4, "high").otherwise("Medium").alias("confidence"), F.lit("near").alias("reasoning"))
    return attach.attachment_edges(told, inst, equip)


@query(f"""{B}, {_ATTACH}, r AS (SELECT t.drawing_id, CASE WHEN id_ % 8 = 0 THEN 'low' WHEN id_ % 8 < 4 THEN 'high' ELSE 'medium' END AS word, CASE WHEN lower(c) = 'low' THEN 'low' WHEN ix.node IS NULL THEN 'no_instrument' WHEN e LIKE 'V-%' THEN 'not_equipment' WHEN ex.node IS NULL THEN 'unknown_equipment' ELSE 'edge' END AS outcome FROM (SELECT *, ord AS id_ FROM t) t LEFT JOIN ix ON ix.drawing_id = t.drawing_id AND ix.ord = t.ord LEFT JOIN ex ON ex.drawing_id = t.drawing_id AND ex.ord = t.ord)
SELECT drawing_id, 'confidence' AS section, word AS name, count(*) AS n FROM r GROUP BY 1, 3 UNION ALL SELECT drawing_id, 'outcome', outcome, count(*) FROM r GROUP BY 1, 3 UNION ALL SELECT drawing_id, 'total', 'answers', count(*) FROM r GROUP BY 1""")
def attachment_report(spark, d):
    return reports.attachment_report(_attached(spark, d)[1])


_KIND = "CASE id % 4 WHEN 0 THEN 'equipment' WHEN 1 THEN 'instrument' WHEN 2 THEN 'valve' ELSE 'piping' END"


def _parented(spark, d, other):
    n = F.col("id")
    kind = F.when(n % 4 == 0, "equipment").when(n % 4 == 1, "instrument").when(n % 4 == 2, "valve").otherwise("piping")
    told = F.when(n % 6 == 1, "pipeline_traversal").when(n % 6 == 2, "12px from equipment").when(n % 6 == 5, "gemini_vision: near a pipeline").otherwise("near")
    return boxes(spark, d).select("drawing_id", n.alias("node"), kind.alias("kind"), F.when(other, n - n % 4).cast("string").alias("equipment_parent"), told.alias("evidence"), (n % 11 == 0).alias("is_isolated"))


@query(f"""{B}, seg AS (SELECT o_orderkey AS id, CAST(floor(o_orderkey / 400) AS BIGINT) AS drawing_id, o_custkey % 400 AS l FROM orders),
n AS (SELECT drawing_id, id, {_KIND} AS kind, id % 3 <> 0 AS has, id % 11 = 0 AS iso, CASE WHEN id % 6 = 1 THEN 'pipeline' WHEN id % 6 = 2 THEN 'mounted' WHEN id % 6 = 5 THEN 'gemini' ELSE 'other' END AS e FROM boxes),
a AS (SELECT drawing_id, count(*) AS n, count_if(kind = 'equipment') AS eq, count_if(has) AS p, count_if(kind IN ('instrument', 'valve')) AS iv, count_if(kind IN ('instrument', 'valve') AND has) AS ivp, count_if(has AND e = 'gemini') AS eg, count_if(has AND e = 'pipeline') AS ep, count_if(has AND e = 'mounted') AS em, count_if(has AND e = 'other') AS eo, count_if(iso) AS iso, count_if(kind IN ('instrument', 'valve') AND NOT has AND NOT iso) AS np FROM n GROUP BY 1)
SELECT drawing_id, unnest(['nodes', 'equipment nodes', 'equipment parent', 'instruments and valves', 'instruments and valves with parent', 'evidence: gemini', 'evidence: pipeline', 'evidence: mounted', 'evidence: other', 'isolated', 'no parent', 'equipment parent %', 'instruments and valves with parent %']) AS metric,
 unnest([n, eq, p, iv, ivp, eg, ep, em, eo, iso, np, round(100.0 * p / n), CASE WHEN iv > 0 THEN round(100.0 * ivp / iv) END])::BIGINT AS value FROM a
UNION ALL SELECT drawing_id, 'edges', count(*) FROM n WHERE id % 2 = 0 GROUP BY 1 UNION ALL SELECT drawing_id, 'edges: ' || CASE WHEN id % 6 = 0 THEN 'MOUNTED_ON' ELSE 'MONITORS' END, count(*) FROM n WHERE id % 2 = 0 GROUP BY 1, 2
UNION ALL SELECT drawing_id, 'pipe segments', count_if(id % 3 <> 1 AND l > 150) FROM seg GROUP BY 1 UNION ALL SELECT drawing_id, 'lines', count(DISTINCT id % 30) FROM seg GROUP BY 1""")
def hierarchy_metrics(spark, d):
    n = F.col("id")
    edges = boxes(spark, d).where("id % 2 = 0").select("drawing_id", F.when(n % 6 == 0, "MOUNTED_ON").otherwise("MONITORS").alias("rel"))
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    segs = o.select(F.floor(k / 400).alias("drawing_id"), F.when(k % 3 == 0, "horizontal_pipe").when(k % 3 == 1, "diagonal_pipe").otherwise("vertical_pipe").alias("type"), (F.col("o_custkey") % 400).alias("length"), (k % 30).alias("line"))
    return reports.hierarchy_metrics(_parented(spark, d, n % 3 != 0), edges, segs)


@query(f"""{B}, n AS (SELECT drawing_id, id % 3 <> 0 AND id % 10 <> 9 AS b, id % 5 <> 0 AS a, id % 7 <> 6 AS t FROM boxes WHERE id % 4 IN (1, 2)) SELECT drawing_id, count_if(b) AS before, count_if(a AND t) AS after, count_if(t) AS total, count_if(a AND t AND NOT b) AS gained, count_if(b AND NOT (a AND t)) AS lost FROM n GROUP BY 1""")
def parents_gained(spark, d):
    n, m = F.col("id"), F.col("node")
    before = _parented(spark, d, n % 3 != 0).where(m % 10 != 9)
    after = _parented(spark, d, n % 5 != 0).where(m % 7 != 6)
    return reports.parents_gained(before, after)[0]




def _corners(*points):
    return F.array(*[_point(x, y) for x, y in points])


#: A cloud is a box four times as wide and high without its upper right quarter; its parts are the left half and the lower right quarter.
_ELLS = """c AS (SELECT drawing_id, id, conf, x1 * 1.0 AS x1, y1 * 1.0 AS y1, x1 + 2.0 * (x2 - x1) AS xm, y1 + 2.0 * (y2 - y1) AS ym, x1 + 4.0 * (x2 - x1) AS x2, y1 + 4.0 * (y2 - y1) AS y2 FROM boxes),
k AS (SELECT drawing_id, id, conf, 12.0 / 16 * (x2 - x1) * (y2 - y1) AS area, x1, y1, xm AS x2, y2 FROM c UNION ALL SELECT drawing_id, id, conf, 12.0 / 16 * (x2 - x1) * (y2 - y1), xm, ym, x2, y2 FROM c),
s AS (SELECT a.drawing_id, a.id AS a, b.id AS b, max(a.area) AS aa, max(b.area) AS ab, max(a.conf) AS ca, max(b.conf) AS cb, sum(greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1))) AS n FROM k a JOIN k b ON a.drawing_id = b.drawing_id AND a.id < b.id AND a.x1 < b.x2 AND b.x1 < a.x2 AND a.y1 < b.y2 AND b.y1 < a.y2 GROUP BY 1, 2, 3)"""


def _ells(spark, d):
    b = F.col("box")
    w, h = b["x2"] - b["x1"], b["y2"] - b["y1"]
    x = [b["x1"], b["x1"] + 2 * w, b["x1"] + 4 * w]
    y = [b["y1"], b["y1"] + 2 * h, b["y1"] + 4 * h]
    return boxes(spark, d).select("drawing_id", "id", "ord", "conf", _corners((x[0], y[0]), (x[1], y[0]), (x[1], y[1]), (x[2], y[1]), (x[2], y[2]), (x[0], y[2])).alias("polygon"))


@query(f"{B}, {_ELLS} SELECT drawing_id, a, b, round(n, 3)::DOUBLE AS both, round(n / (aa + ab - n), 6)::DOUBLE AS iou FROM s WHERE n > 1e-9")
def polygon_pairs(spark, d):
    found = clouds.shared_areas(_ells(spark, d))
    return found.select("drawing_id", "a", "b", F.round("both", 3).alias("both"), F.round(F.col("both") / (F.col("area_a") + F.col("area_b") - F.col("both")), 6).alias("iou"))


@query(f"""{B}, {_ELLS}, o AS (SELECT drawing_id, CASE WHEN ca >= cb THEN a ELSE b END AS hi, CASE WHEN ca >= cb THEN b ELSE a END AS lo FROM s WHERE n > 0.35 * (aa + ab - n)),
st AS (SELECT drawing_id, hi AS id, 0 AS s, 0 AS it FROM o UNION SELECT drawing_id, lo, 0, 0 FROM o
UNION ALL (WITH u AS (SELECT * FROM st WHERE s = 0), top AS (SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM o JOIN st h ON h.drawing_id = o.drawing_id AND h.id = o.hi AND h.s < 2 WHERE o.drawing_id = u.drawing_id AND o.lo = u.id)),
 lost AS (SELECT DISTINCT o.drawing_id, o.lo AS id FROM o JOIN top ON top.drawing_id = o.drawing_id AND top.id = o.hi)
 SELECT st.drawing_id, st.id, CASE WHEN s > 0 THEN s WHEN EXISTS (SELECT 1 FROM top t WHERE t.drawing_id = st.drawing_id AND t.id = st.id) THEN 1 WHEN EXISTS (SELECT 1 FROM lost t WHERE t.drawing_id = st.drawing_id AND t.id = st.id) THEN 2 ELSE 0 END, it + 1 FROM st WHERE EXISTS (SELECT 1 FROM u))),
gone AS (SELECT drawing_id, id FROM st WHERE s = 2), kept AS (SELECT drawing_id, id FROM boxes EXCEPT SELECT drawing_id, id FROM gone),
i AS (SELECT drawing_id, a AS id, b AS other FROM s WHERE n >= 0.8 * aa UNION ALL SELECT drawing_id, b, a FROM s WHERE n >= 0.8 * ab), n AS (SELECT DISTINCT i.drawing_id, i.id FROM i JOIN kept ON kept.drawing_id = i.drawing_id AND kept.id = i.other)
SELECT kept.drawing_id, kept.id, CASE WHEN n.id IS NULL THEN 'outer' ELSE 'inner' END AS tag FROM kept LEFT JOIN n ON n.drawing_id = kept.drawing_id AND n.id = kept.id""")
def cloud_nesting(spark, d):
    return clouds.keep_and_nest(_ells(spark, d)).select("drawing_id", "id", "tag")


@query(f"""{B}, p AS (SELECT drawing_id, id, row_number() OVER (PARTITION BY drawing_id ORDER BY id) - 1 AS place, CASE id % 3 WHEN 0 THEN 'approved' WHEN 1 THEN 'modified' END AS status, x1, y1, x2, y2 FROM boxes),
v AS (SELECT *, CASE WHEN id % 3 = 0 OR id % 6 = 2 THEN x1 WHEN id % 3 = 1 THEN round_even(x1 / 1.6, 0) ELSE round_even(x1 * 4 * (1 / 1.6), 0) END AS px1, CASE WHEN id % 3 = 0 OR id % 6 = 2 THEN y1 WHEN id % 3 = 1 THEN round_even(y1 / 1.6, 0) ELSE round_even(y1 * 4 * (1 / 1.6), 0) END AS py1,
 CASE WHEN id % 3 = 0 OR id % 6 = 2 THEN x2 WHEN id % 3 = 1 THEN round_even(x2 / 1.6, 0) ELSE round_even(x2 * 4 * (1 / 1.6), 0) END AS px2, CASE WHEN id % 3 = 0 OR id % 6 = 2 THEN y2 WHEN id % 3 = 1 THEN round_even(y2 / 1.6, 0) ELSE round_even(y2 * 4 * (1 / 1.6), 0) END AS py2 FROM p)
SELECT drawing_id, place::BIGINT AS place, id, coalesce(status, 'approved') AS status, px1::INT AS x1, py1::INT AS y1, px2::INT AS x2, py2::INT AS y2, round((px2 - px1) * (py2 - py1), 1)::DOUBLE AS area FROM v""")
def saved_clouds(spark, d):
    """A drawing's boxes as one payload: a third approved, a third drawn anew on the image, the rest without status, of which every second has the display's polygon alone."""
    b, n = F.col("box"), F.col("id")
    rectangle = _corners((b["x1"], b["y1"]), (b["x2"], b["y1"]), (b["x2"], b["y2"]), (b["x1"], b["y2"]))
    none = F.array().cast("array<struct<x:double,y:double>>")
    cloud = F.struct(n.alias("id"), F.lit("auto").alias("source"), F.lit(0.8).alias("confidence"), F.when(n % 3 == 0, "approved").when(n % 3 == 1, "modified").alias("status"), F.when((n % 3 == 0) | (n % 6 == 2), rectangle).otherwise(none).alias("polygon_json"), F.when(n % 3 == 1, rectangle).alias("polygon_img"), rectangle.alias("polygon_display"))
    payload = boxes(spark, d).groupBy("drawing_id").agg(F.array_sort(F.collect_list(cloud)).alias("clouds")).withColumns({"scale_j2i": F.lit(1.6), "display_scale": F.lit(0.25), "image_w": F.lit(16000), "image_h": F.lit(12000)})
    made = clouds.saved_clouds(payload)
    at = [F.get("bbox", F.lit(k)).alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"))]
    return made.select("drawing_id", F.col("place").cast("long").alias("place"), "id", "status", *at, "area")


_TAGGED = "CASE WHEN id % 9 = 0 THEN '' WHEN id % 4 = 1 THEN tag || 'X' || CAST(id % 2 AS VARCHAR) ELSE tag END"
_RESOLVED = f"""b AS (SELECT * REPLACE ('T-' || CAST(id % 3 AS VARCHAR) || '00' AS tag), id % 6 = 0 AS known, CAST(id % 5 AS DOUBLE) / 5 AS ocr FROM boxes),
e AS (SELECT a.drawing_id, a.id AS a, b.id AS b FROM b a JOIN b ON a.drawing_id = b.drawing_id AND a.id <> b.id AND a.tag = b.tag AND ({_D} <= 120 OR {_IOU} >= 0.2)),
r AS (SELECT drawing_id, id AS node, id AS root FROM b UNION SELECT r.drawing_id, e.b, r.root FROM r JOIN e ON r.drawing_id = e.drawing_id AND r.node = e.a),
m AS (SELECT drawing_id, node AS id, min(root) AS root FROM r GROUP BY 1, 2), s AS (SELECT m.root, b.*, round(CASE WHEN known THEN 1.0 ELSE 0.0 END + 0.4 * conf + 0.3 * ocr + 0.1 + 0.1, 9) AS score FROM m JOIN b ON m.drawing_id = b.drawing_id AND m.id = b.id),
p AS (SELECT drawing_id, root, arg_max(id, (score, -id)) AS first FROM s GROUP BY 1, 2)"""


def _resolved(spark, d):
    n = F.col("id")
    b = boxes(spark, d).withColumn("tag", F.concat(F.lit("T-"), n % 3, F.lit("00"))).withColumn("in_registry", n % 6 == 0).withColumn("ocr", (n % 5).cast("double") / 5).withColumn("assoc", F.lit(0.5)).withColumn("status", F.lit("PASS"))
    return dedup.resolve_duplicates(b)


@query(f"""{B}, {_RESOLVED} SELECT s.drawing_id, p.first AS id, coalesce(string_agg(CAST(s.id AS VARCHAR), ',' ORDER BY s.score DESC, s.id) FILTER (s.id <> p.first), '') AS merged_from, CASE WHEN bool_or(s.known AND s.id = p.first) THEN max(s.ocr) FILTER (s.id = p.first) ELSE round(max(s.ocr), 3) END AS ocr, min(x1) AS x1, max(y2) AS y2
FROM s JOIN p ON s.drawing_id = p.drawing_id AND s.root = p.root GROUP BY 1, 2""")
def merged_primaries(spark, d):
    return dedup.merged_primaries(_resolved(spark, d)).select("drawing_id", "id", F.array_join(F.transform("merged_from", lambda x: x.cast("string")), ",").alias("merged_from"), "ocr", "box.x1", "box.y2")


@query(f"{B}, {_RESOLVED} SELECT s.drawing_id, s.id, p.first AS primary FROM s JOIN p ON s.drawing_id = p.drawing_id AND s.root = p.root WHERE s.id <> p.first")
def duplicate_links(spark, d):
    return dedup.duplicate_links(_resolved(spark, d)).select("drawing_id", "id", "primary")


_LEAD = "sqrt(greatest(0, greatest(b.x1 - b.tx2, b.tx1 - b.x2)) ** 2 + greatest(0, greatest(b.y1 - b.ty2, b.ty1 - b.y2)) ** 2)"


@query(f"""{S}, b AS (SELECT *, CASE WHEN id % 5 <> 0 THEN x2 + id % 4 * 40 END AS tx1, y1 AS ty1, CASE WHEN id % 5 <> 0 THEN x2 + id % 4 * 40 + 30 END AS tx2, y2 AS ty2 FROM boxes), g AS (SELECT *, CASE WHEN id % 5 <> 0 AND {_LEAD} <= 80 THEN {_LEAD} END AS gap FROM b),
n AS (SELECT a.drawing_id, a.id, min({_pd('(a.x1 + a.x2) / 2.0', '(a.y1 + a.y2) / 2.0')}) AS d FROM g a JOIN seg s ON a.drawing_id = s.drawing_id WHERE a.gap IS NULL GROUP BY 1, 2)
SELECT g.drawing_id, g.id, gap IS NOT NULL OR coalesce(d < 20, false) AS leader, round(CASE WHEN gap IS NOT NULL THEN gap WHEN d < 20 THEN d END, 3) AS distance FROM g LEFT JOIN n ON n.drawing_id = g.drawing_id AND n.id = g.id""")
def leader_lines(spark, d):
    """Tags stand right of their symbols, up to 120 away; of five symbols one has none."""
    b, n = F.col("box"), F.col("id")
    x = (b["x2"] + n % 4 * 40)
    tag = F.when(n % 5 != 0, F.struct(x.alias("x1"), b["y1"].alias("y1"), (x + 30).alias("x2"), b["y2"].alias("y2")))
    return spatial.leader_lines(boxes(spark, d).withColumn("tag_box", tag), segments(spark, d))


@query(f"{B}, e AS (SELECT drawing_id, id - id % 7 AS b, id AS node, conf, id * 31 % 1000 AS k FROM boxes WHERE id % 7 <> 0) SELECT drawing_id, node, b AS parent, arg_min(CASE WHEN z = 0 THEN conf ELSE 0.5 END, (k, z)) AS confidence FROM (SELECT *, unnest([0, 1]) AS z FROM e) GROUP BY 1, 2, 3")
def parent_provenance(spark, d):
    """Two edges a pair, one each way; their ids are in another order than the nodes."""
    n = F.col("id")
    e = boxes(spark, d).where("id % 7 <> 0")
    tree = e.select("drawing_id", n.alias("node"), (n - n % 7).alias("parent"))
    one = e.select("drawing_id", F.struct((n * 31 % 1000).alias("k"), F.lit(0).alias("z")).alias("edge_id"), n.alias("a"), (n - n % 7).alias("b"), F.col("conf").alias("confidence"), F.lit("x").alias("evidence"))
    two = e.select("drawing_id", F.struct((n * 31 % 1000).alias("k"), F.lit(1).alias("z")).alias("edge_id"), (n - n % 7).alias("a"), n.alias("b"), F.lit(0.5).alias("confidence"), F.lit("y").alias("evidence"))
    return hierarchy.parent_provenance(tree, one.unionAll(two)).select("drawing_id", "node", "parent", "confidence")


@query(f"{B}, r AS (SELECT drawing_id, x1 - 60 AS x1, y1 - 60 AS y1, x2 + 60 AS x2, y2 + 60 AS y2 FROM boxes WHERE id % 5 = 0) SELECT DISTINCT a.drawing_id, a.id FROM boxes a JOIN r b ON a.drawing_id = b.drawing_id AND a.x1 < b.x2 AND b.x1 < a.x2 AND a.y1 < b.y2 AND b.y1 < a.y2")
def overlapping_tiles(spark, d):
    """Boxes as tiles, every fifth grown by 60 as a region."""
    b = F.col("box")
    grown = F.struct((b["x1"] - 60).alias("x1"), (b["y1"] - 60).alias("y1"), (b["x2"] + 60).alias("x2"), (b["y2"] + 60).alias("y2"))
    rows = boxes(spark, d).select("drawing_id", "id", "box")
    return spatial.overlapping_tiles(rows, rows.where("id % 5 = 0").withColumn("box", grown)).select("drawing_id", "id")


_EDGE_GAP = "sqrt(greatest(0, greatest(a.x1 - b.x2, b.x1 - a.x2)) ** 2 + greatest(0, greatest(a.y1 - b.y2, b.y1 - a.y2)) ** 2)"


@query(f"""{B}, q AS (SELECT *, id % 13 AS line FROM boxes WHERE id % 4 = 0) SELECT a.drawing_id, a.id AS a, b.id AS b FROM q a JOIN q b ON a.drawing_id = b.drawing_id AND a.id < b.id AND a.line <> b.line
WHERE (abs((a.y1 + a.y2) / 2.0 - (b.y1 + b.y2) / 2.0) <= 90 OR abs((a.x1 + a.x2) / 2.0 - (b.x1 + b.x2) / 2.0) <= 90) AND {_EDGE_GAP} <= 700""")
def drive_hints(spark, d):
    q = boxes(spark, d).where("id % 4 = 0")
    return spatial.drive_hints(q.select("drawing_id", "id", "box"), q.select("drawing_id", F.col("id").alias("equipment"), (F.col("id") % 13).alias("line"))).select("drawing_id", "a", "b")


@query(f"{B}, e AS (SELECT drawing_id, id AS a, id + 10 - 2 * (id % 10) AS b, CASE id % 3 WHEN 0 THEN 'ADJACENT_TO' ELSE 'JUNCTION_OF' END AS rel, conf FROM boxes UNION ALL SELECT drawing_id, id + 10 - 2 * (id % 10), id, 'ADJACENT_TO', 0.4 FROM boxes) SELECT drawing_id, least(a, b) AS lo, greatest(a, b) AS hi, rel, max(conf) AS confidence FROM e GROUP BY 1, 2, 3, 4")
def structural_edges(spark, d):
    n = F.col("id")
    other = n + 10 - 2 * (n % 10)
    b = boxes(spark, d)
    e = b.select("drawing_id", n.alias("a"), other.alias("b"), F.when(n % 3 == 0, "ADJACENT_TO").otherwise("JUNCTION_OF").alias("rel"), F.col("conf").alias("confidence")).unionAll(b.select("drawing_id", other, n, F.lit("ADJACENT_TO"), F.lit(0.4)))
    return hierarchy.structural_edges(e)


_GRAPH = "CASE id % 5 WHEN 0 THEN 'pipeline' WHEN 1 THEN 'valve' WHEN 2 THEN 'instrument' WHEN 3 THEN 'junction' ELSE 'equipment' END"


def _graph(spark, d):
    n = F.col("id")
    kind = F.element_at(F.array(*[F.lit(k) for k in ("pipeline", "valve", "instrument", "junction", "equipment")]), (n % 5 + 1).cast("int"))
    return boxes(spark, d).select("drawing_id", n.alias("node"), kind.alias("kind")), boxes(spark, d).where("id % 10 > 1").select("drawing_id", F.when(n % 2 == 0, n).otherwise(n - 1).alias("a"), F.when(n % 2 == 0, n - 1).otherwise(n).alias("b"), F.when(n % 3 == 0, "MONITORS").otherwise("CONNECTED_TO").alias("rel"), n.alias("edge_id"))


_TIES = f"k AS (SELECT drawing_id, id AS node, {_GRAPH} AS kind FROM boxes), e AS (SELECT drawing_id, CASE WHEN id % 2 = 0 THEN id ELSE id - 1 END AS a, CASE WHEN id % 2 = 0 THEN id - 1 ELSE id END AS b, CASE WHEN id % 3 = 0 THEN 'MONITORS' ELSE 'CONNECTED_TO' END AS rel, id AS edge_id FROM boxes WHERE id % 10 > 1)"


@query(f"""{B}, {_TIES}, w AS (SELECT drawing_id, a, b, rel FROM e UNION ALL SELECT drawing_id, b, a, rel FROM e) SELECT w.drawing_id, l.node AS line, n.node, w.rel, n.kind FROM w JOIN k l ON l.drawing_id = w.drawing_id AND l.node = w.a JOIN k n ON n.drawing_id = w.drawing_id AND n.node = w.b WHERE l.kind = 'pipeline' AND n.kind IN ('instrument', 'valve', 'equipment')""")
def line_links(spark, d):
    nodes, edges = _graph(spark, d)
    return flow.line_links(edges, nodes)


_TOLD = "t AS (SELECT drawing_id, id AS line, CASE id % 4 WHEN 0 THEN 'forward' WHEN 1 THEN 'reverse' ELSE 'unknown' END AS direction, CASE WHEN id % 4 > 1 THEN 'none' WHEN id % 8 < 4 THEN 'arrowhead' ELSE 'propagated' END AS evidence FROM boxes WHERE id % 5 = 0)"


def _told(spark, d):
    n = F.col("id")
    return boxes(spark, d).where("id % 5 = 0").select("drawing_id", n.alias("line"), F.when(n % 4 == 0, "forward").when(n % 4 == 1, "reverse").otherwise("unknown").alias("direction"), F.when(n % 4 > 1, "none").when(n % 8 < 4, "arrowhead").otherwise("propagated").alias("evidence"))


@query(f"{B}, {_TOLD} SELECT drawing_id, CASE WHEN direction = 'unknown' THEN 'unknown' ELSE evidence END AS evidence, count(*) AS n FROM t GROUP BY 1, 2")
def evidence_counts(spark, d):
    return flow.evidence_counts(_told(spark, d))


@query(f"""{B}, {_TIES}, {_TOLD}, f AS (SELECT * FROM t WHERE direction <> 'unknown') SELECT e.drawing_id, e.edge_id, f.direction IS NOT NULL OR g.direction IS NOT NULL AS directed, coalesce(f.direction, g.direction) AS flow_direction, coalesce(f.evidence, g.evidence) AS flow_evidence
FROM e LEFT JOIN f ON f.drawing_id = e.drawing_id AND f.line = e.a LEFT JOIN f g ON g.drawing_id = e.drawing_id AND g.line = e.b""")
def directed_edges(spark, d):
    return flow.directed_edges(_graph(spark, d)[1], _told(spark, d)).select("drawing_id", "edge_id", "directed", "flow_direction", "flow_evidence")


@query(f"""{B}, {_TOLD}, l AS (SELECT drawing_id, arg_min(id - id % 5, id) AS line, id % 60 AS node FROM boxes WHERE id % 5 > 0 GROUP BY 1, 3) SELECT l.drawing_id, l.node, l.line, t.direction, t.evidence FROM l JOIN t ON t.drawing_id = l.drawing_id AND t.line = l.line WHERE t.direction <> 'unknown'""")
def flow_paths(spark, d):
    n = F.col("id")
    links = boxes(spark, d).where("id % 5 > 0").select("drawing_id", (n % 60).alias("node"), (n - n % 5).alias("line"), n.alias("edge_id"))
    return flow.flow_paths(links, _told(spark, d))


@query(f"{B} SELECT drawing_id, id AS node, CASE WHEN id % 11 = 0 THEN 'isolated' ELSE 'unresolved' END AS reason FROM boxes WHERE id % 4 IN (1, 2) AND id % 3 = 0")
def attach_targets(spark, d):
    return flow.attach_targets(_parented(spark, d, F.col("id") % 3 != 0))


@query("SELECT upper(left(p_name, 3)) AS prefix, string_agg(p_name, ';' ORDER BY p_partkey) AS names FROM part WHERE left(p_name, 3) <> '' GROUP BY 1")
def scope_prefixes(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("ord"), F.col("p_name").alias("name"), F.left("p_name", F.lit(3)).alias("prefix"))
    return sow.prefix_index(p).select("prefix", F.array_join("names", ";").alias("names"))


@query("SELECT CASE p_partkey % 4 WHEN 0 THEN 'instrument' WHEN 1 THEN 'valve' ELSE 'Unknown' END AS category, CASE WHEN p_partkey % 3 = 0 THEN 'BLOCK' ELSE 'ALLOW' END AS status, count(*) AS n FROM part GROUP BY 1, 2")
def scope_breakdown(spark, d):
    k = F.col("p_partkey")
    return sow.category_breakdown(table(spark, d, "part").select(F.when(k % 4 == 0, "instrument").when(k % 4 == 1, "valve").otherwise("Unknown").alias("category"), F.when(k % 3 == 0, "BLOCK").otherwise("ALLOW").alias("status")))


@query("""WITH c AS (SELECT p_partkey % 40 AS drawing_id, p_partkey - p_partkey % 7 % 2 AS id, p_partkey AS k FROM part), n AS (SELECT *, count(*) OVER (PARTITION BY drawing_id, id) AS n FROM c)
SELECT drawing_id, id, s AS severity, i AS issue FROM (SELECT drawing_id, id, unnest([CASE WHEN n > 1 THEN 'ERROR' END, CASE WHEN k % 5 = 0 THEN 'ERROR' END, CASE WHEN k % 5 = 1 THEN 'ERROR' END, CASE WHEN k % 5 <> 0 AND k % 6 = 0 THEN 'WARNING' END]) AS s, unnest(['DUPLICATE_ID', 'TOO_FEW_POINTS', 'ZERO_AREA', 'OUT_OF_BOUNDS']) AS i FROM n) WHERE s IS NOT NULL""")
def cloud_issues(spark, d):
    """Polygons of two corners, without area, beyond the sheet, and with ids that others have."""
    k = F.col("p_partkey")
    far = F.when(k % 6 == 0, 5000.0).otherwise(100.0)
    zero = F.lit(0.0)
    whole = F.array(_point(zero, zero), _point(far, zero), _point(far, F.lit(50.0)))
    flat = F.array(_point(zero, zero), _point(far, zero), _point(far / 2, zero))
    two = F.array(_point(zero, zero), _point(F.lit(10.0), zero))
    rows = table(spark, d, "part").select((k % 40).alias("drawing_id"), (k - k % 7 % 2).alias("id"), F.when(k % 5 == 0, two).when(k % 5 == 1, flat).otherwise(whole).alias("polygon"), F.lit(1000).alias("width_px"), F.lit(800).alias("height_px"))
    return shaping.validate_clouds(rows)


@query("""WITH c AS (SELECT p_partkey % 40 AS drawing_id, p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN 'inner' ELSE 'outer' END AS tag, p_partkey % 7 + 3 AS n FROM part)
SELECT drawing_id, id, n::INT AS point_count, round_even((id % 50 * 1.6), 0)::INT AS x_img, round_even(round_even((id % 50 * 1.6), 0) * 0.25, 1)::DOUBLE AS x_display, CASE WHEN n <= 4 THEN n WHEN n < 8 THEN n ELSE (n - 1) // 2 + 1 + CASE WHEN (n - 1) % 2 = 0 THEN 0 ELSE 1 END END::INT AS kept FROM c WHERE tag = 'outer'""")
def editor_clouds(spark, d):
    """Outlines of three to nine corners, of which an editor shows four where twice four fit."""
    k = F.col("p_partkey")
    pts = F.transform(F.sequence(F.lit(0), (k % 7 + 2).cast("int")), lambda i: F.struct((k % 50 + i).cast("double").alias("x"), (i * i).cast("double").alias("y")))
    rows = table(spark, d, "part").select((k % 40).alias("drawing_id"), k.alias("id"), F.when(k % 3 == 0, "inner").otherwise("outer").alias("tag"), F.lit(None).cast("string").alias("source"), F.lit(0.9).alias("confidence"), F.lit(1.5).alias("scallopedness"), F.lit(9.0).alias("area"), F.array(F.lit(1.0), F.lit(2.0)).alias("bbox"), pts.alias("polygon"), F.lit(1.6).alias("scale_j2i"), F.lit(9600).alias("image_w"))
    made = payloads.editor_clouds(rows, most=4)
    return made.select("drawing_id", "id", "point_count", F.get("polygon_img", F.lit(0))["x"].alias("x_img"), F.get("polygon", F.lit(0))["x"].alias("x_display"), F.size("polygon").alias("kept"))


@query("""SELECT 0 AS part, 0::BIGINT AS ord, 'Total symbols: ' || count(*) || ' (' || count_if(p_partkey % 3 <> 0) || ' ALLOW | ' || count_if(p_partkey % 3 = 0) || ' BLOCK)' AS line FROM part
UNION ALL SELECT 1, p_partkey, '  ✓ ' || lpad(CASE WHEN p_partkey % 4 = 0 THEN '' ELSE '[' || left(p_name, 2) || ']' END, 8, ' ') || '  ' || p_name FROM part WHERE p_partkey % 3 <> 0 UNION ALL SELECT 2, p_partkey, '  ✗           ' || p_name FROM part WHERE p_partkey % 3 = 0""")
def scope_summary(spark, d):
    k = F.col("p_partkey")
    return payloads.scope_summary(table(spark, d, "part").select(k.alias("ord"), F.col("p_name").alias("name"), F.when(k % 3 == 0, "BLOCK").otherwise("ALLOW").alias("status"), F.when(k % 4 != 0, F.left("p_name", F.lit(2))).alias("prefix")))


@query(f"{B} SELECT drawing_id, tag, row_number() OVER (PARTITION BY drawing_id ORDER BY min(id)) - 1 AS place FROM boxes GROUP BY 1, 2")
def distinct_tags(spark, d):
    return payloads.distinct_in_order(boxes(spark, d), "tag").select("drawing_id", "tag", F.col("place").cast("long").alias("place"))


@query(f"{B} SELECT drawing_id, id, row_number() OVER (PARTITION BY drawing_id ORDER BY CASE WHEN id % 5 = 0 THEN 0 ELSE x1 // 700 END, id) - 1 AS place FROM boxes")
def patch_order(spark, d):
    rows = boxes(spark, d).withColumn("patch_id", F.when(F.col("id") % 5 != 0, F.floor(F.col("box.x1") / 700)))
    return payloads.in_patch_order(rows).select("drawing_id", "id", F.col("place").cast("long").alias("place"))


@query("""WITH t AS (SELECT p_partkey AS id, CASE p_partkey % 6 WHEN 0 THEN 'V-PIC-' WHEN 1 THEN 'XS-' WHEN 2 THEN ' V-HS-' WHEN 3 THEN 'FT-' WHEN 4 THEN 'rci-' ELSE 'RCI-' END || CAST(p_partkey % 1500 AS VARCHAR) AS tag FROM part)
SELECT id, regexp_matches(trim(tag), '^(V-)?PIC-\\d{3,4}$') OR regexp_matches(trim(tag), '^(V-)?FT-246[A-Z]?$') OR regexp_matches(trim(tag), '^(V-)?RCI-') OR regexp_matches(trim(tag), '^(V-)?HS-14\\d{2}[A-Z]?$') OR regexp_matches(trim(tag), '^(V-)?XS-2[3-7]\\d$') AS other FROM t""")
def other_drawings(spark, d):
    k = F.col("p_partkey")
    tag = F.concat(F.when(k % 6 == 0, "V-PIC-").when(k % 6 == 1, "XS-").when(k % 6 == 2, " V-HS-").when(k % 6 == 3, "FT-").when(k % 6 == 4, "rci-").otherwise("RCI-"), k % 1500)
    return table(spark, d, "part").select(k.alias("id"), t.names_other_drawing(tag).alias("other"))


@query(f"{B} SELECT drawing_id, CAST(id AS VARCHAR) AS candidate_id, tag AS tag_text, 'UNSPECIFIED' AS sow_status, 'WARN' AS validation_status FROM boxes WHERE id % 4 <> 0")
def final_projection(spark, d):
    n = F.col("id")
    rows = boxes(spark, d).select("drawing_id", n.cast("string").alias("candidate_id"), F.col("tag").alias("tag_text"), F.when(n % 4 == 0, "DISCARDED").otherwise("PRIMARY").alias("duplicate_status"), F.lit(None).cast("string").alias("sow_status"))
    return register.final_projection(rows).select("drawing_id", "candidate_id", "tag_text", "sow_status", "validation_status")

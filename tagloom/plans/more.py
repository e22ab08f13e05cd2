"""Further queries with their SQL: decoding, scope of work, the register, comparisons and the hierarchy's deliverables. Their SQL spells out its own values."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.functions import geometry as g
from tagloom.functions import text as t
from tagloom.operators import flow, hierarchy, lookup, register, shaping, sow
from tagloom.plans.fixtures import boxes, candidates, segments, table
from tagloom.plans.queries import _D, _E, _EDGES, _NODES, _edges, _nodes, _pd, _tree, EVAL_KEY, B, C, S, query, sql_key

_K = sql_key("tag", EVAL_KEY)
_MEANS = """MAP {'AHH': 'ALARM HIGH HIGH', 'ALL': 'ALARM LOW LOW', 'IT': 'INDICATING TRANSMITTER', 'AH': 'ALARM HIGH', 'AL': 'ALARM LOW', 'HH': 'ALARM HIGH HIGH', 'LL': 'ALARM LOW LOW', 'SC': 'SWITCH CLOSE', 'SO': 'SWITCH OPEN', 'ZT': 'POSITION TRANSMITTER', 'ZY': 'SOLENOID/CONVERTER', 'IC': 'INDICATING CONTROLLER', 'CV': 'CONTROL VALVE',
'I': 'INDICATING', 'T': 'TRANSMITTER', 'E': 'ELEMENT', 'V': 'VALVE', 'W': 'WELL/THERMOWELL', 'Y': 'RELAY/CONVERTER', 'A': 'ALARM', 'H': 'HIGH', 'L': 'LOW', 'S': 'SWITCH', 'C': 'CONTROLLER', 'D': 'DIFFERENTIAL', 'R': 'RECORDER', 'X': 'UNCLASSIFIED', 'G': 'GAUGE/GLASS', 'K': 'CONTROL STATION'}"""
_FIRST = "MAP {'F': 'FLOW', 'P': 'PRESSURE', 'T': 'TEMPERATURE', 'L': 'LEVEL', 'X': 'UNCLASSIFIED', 'B': 'BURNER', 'V': 'VIBRATION', 'G': 'GAUGING', 'I': 'CURRENT', 'M': 'MOISTURE'}"


@query(f"""{C}, a AS (SELECT id, tag, upper(CASE WHEN id % 5 = 0 THEN 'V-FAHH-' || CAST(id % 900 + 100 AS VARCHAR) WHEN id % 5 = 1 THEN 'A-PRV' || CAST(id % 900 + 100 AS VARCHAR) WHEN id % 5 = 2 THEN 'V-GLV-' || CAST(id % 900 + 100 AS VARCHAR) ELSE trim(tag) END) AS raw FROM cand),
b AS (SELECT id, raw, regexp_replace(raw, '^[A-Z0-9]+-([A-Z]+-?[0-9])', '\\1') AS clean FROM a), c AS (SELECT *, regexp_extract(clean, '^([A-Z]+?)-?([0-9]{{2,5}}[A-Z]?)$', 1) AS l, regexp_extract(clean, '^([A-Z]+?)-?([0-9]{{2,5}}[A-Z]?)$', 2) AS num FROM b),
e AS (SELECT *, coalesce(list_extract(map_extract({_FIRST}, left(l, 1)), 1), left(l, 1)) AS m, array_to_string(list_filter(list_transform(regexp_extract_all(substr(l, 2), 'AHH|ALL|IT|AH|AL|HH|LL|SC|SO|ZT|ZY|IC|CV|[A-Z]'), lambda w: list_extract(map_extract({_MEANS}, w), 1)), lambda w: w IS NOT NULL), ' ') AS f FROM c)
SELECT id, CASE WHEN raw = '' THEN 'UNKNOWN' WHEN regexp_matches(raw, '^[A-Z]{{1,3}}-V-[0-9]{{3}}[A-Z]?$') THEN 'EQUIPMENT' WHEN regexp_matches(clean, '^(BV|GV|RV|NRV|GLV|FCV|PCV|TCV|LCV)-?[0-9]{{3,5}}[A-Z]?$') THEN 'VALVE' WHEN regexp_matches(clean, '^[0-9]{{1,2}}["'']?-') THEN 'PIPING' WHEN regexp_matches(clean, '^I-?[0-9]{{3}}[A-Z]?$') THEN 'LOGIC' WHEN l <> '' THEN 'INSTRUMENT' ELSE 'UNKNOWN' END AS type,
CASE WHEN l = '' OR regexp_matches(clean, '^(BV|GV|RV|NRV|GLV|FCV|PCV|TCV|LCV)-?[0-9]{{3,5}}[A-Z]?$') OR regexp_matches(clean, '^I-?[0-9]{{3}}[A-Z]?$') OR regexp_matches(raw, '^[A-Z]{{1,3}}-V-[0-9]{{3}}[A-Z]?$') THEN '' ELSE trim(m || ' ' || f) END AS instrument FROM e""")
def isa_decode(spark, d):
    n = (F.col("id") % 900 + 100).cast("string")
    tag = F.when(F.col("id") % 5 == 0, F.concat(F.lit("V-FAHH-"), n)).when(F.col("id") % 5 == 1, F.concat(F.lit("A-PRV"), n)).when(F.col("id") % 5 == 2, F.concat(F.lit("V-GLV-"), n)).otherwise(F.col("tag"))
    df = candidates(spark, d).withColumn("x", t.decode_tag(tag))
    return df.select("id", "x.type", F.when(F.col("x.type") == "INSTRUMENT", F.col("x.description")).otherwise("").alias("instrument"))


@query(f"""{C}, x AS (SELECT id, upper(tag) AS u, regexp_extract(regexp_replace(upper(tag), '^[V-]+', ''), '^([A-Z]+)', 1) AS l FROM cand)
SELECT id, CASE WHEN regexp_matches(u, '^(V-)?(K|KG|S)-V-') THEN 'MECHANICAL' WHEN regexp_matches(u, '^(V-)?KM-V-') THEN 'ELECTRICAL' WHEN regexp_matches(u, '^(V-)?V-V-') THEN 'MECHANICAL' WHEN regexp_matches(u, '^(V-)?(BV|GV|RV|NRV|GLV|FCV|PCV|TCV|LCV)-') THEN 'MECHANICAL' WHEN regexp_matches(u, '^[0-9][0-9]?(IN)?["-]') THEN 'PIPING' ELSE 'INSTRUMENTATION' END AS discipline,
CASE WHEN contains(l, 'C') THEN 'controller' WHEN contains(l, 'IT') OR suffix(l, 'T') THEN 'transmitter' WHEN suffix(l, 'E') OR contains(left(l, 2), 'E') THEN 'element' WHEN left(l, 2) IN ('FV', 'PV', 'TV', 'LV', 'ZV', 'XV', 'BV', 'GV') THEN 'valve' ELSE 'other' END AS role FROM x""")
def legacy_rules(spark, d):
    return candidates(spark, d).select("id", t.legacy_discipline(F.col("tag")).alias("discipline"), t.loop_role(F.col("tag")).alias("role"))


_KIND = """CASE symbol_name WHEN 'Ball Valve' THEN 'Valve/BV' WHEN 'Flow Indicating Transmitter' THEN 'Transmitter/FIT' WHEN 'Pressure Safety Relief Valve' THEN 'Safety/Shutdown/SRV' WHEN 'Flow Control Valve' THEN 'Control Valve/FC' WHEN 'Temperature Element' THEN 'Element/TE' WHEN 'Limit Switch Close' THEN 'Switch/LSC' WHEN 'Pressure Transmitter' THEN 'Transmitter/PT' ELSE 'Unknown/' END"""
_LOOK = """CASE symbol_name WHEN 'Ball Valve' THEN 'valve body shape;line through symbol' WHEN 'Flow Indicating Transmitter' THEN 'circle;bubble;letter code inside circle;line below;indicating (I letter in tag)' WHEN 'Pressure Safety Relief Valve' THEN 'valve with actuator;spring symbol;safety marker' WHEN 'Flow Control Valve' THEN 'bow-tie shape;triangle;actuator on top;valve body'
WHEN 'Temperature Element' THEN 'circle or small symbol;element shape;field instrument' WHEN 'Limit Switch Close' THEN 'circle;bubble;S prefix or letter;closed position indicator' WHEN 'Pressure Transmitter' THEN 'circle;bubble;letter code inside circle;line below' ELSE 'unknown shape' END"""


@query(f"{C} SELECT id, {_KIND} AS inferred, {_LOOK} AS shape FROM cand")
def symbol_inference(spark, d):
    df = candidates(spark, d).withColumn("x", sow.inferred(F.col("symbol_name")))
    return df.select("id", F.concat_ws("/", "x.category", "x.prefix").alias("inferred"), F.array_join(sow.shape_features(F.col("symbol_name"), F.col("x.category")), ";").alias("shape"))


_SCOPE = "SELECT * FROM (VALUES (0, 'BALL VALVE', 'ALLOW', 'BV'), (1, 'FLOW TRANSMITTER', 'BLOCK', 'FT'), (2, 'PRESSURE TRANSMITTER', 'ALLOW', 'PT'), (3, 'GAS COMPRESSOR', 'BLOCK', 'K'), (4, 'SAFETY RELIEF VALVE', 'ALLOW', 'PSV'), (5, 'LIMIT SWITCH OPEN', 'ALLOW', 'TT'), (6, 'LIMIT SWITCH CLOSE', 'BLOCK', 'TT')) v(ord, name, status, prefix)"


def _scope(spark):
    return spark.sql(_SCOPE.replace("v(ord", "AS v(ord"))


_MET = "len(list_intersect(list_distinct(regexp_split_to_array(upper(trim(x)), '\\s+')), string_split(sc.name, ' '))) / greatest(len(list_distinct(regexp_split_to_array(upper(trim(x)), '\\s+'))), len(string_split(sc.name, ' ')))"


@query(f"{C}, sc AS ({_SCOPE}), a AS (SELECT DISTINCT symbol_name AS x FROM cand), h AS (SELECT x, min((CASE WHEN status = 'BLOCK' THEN 0 ELSE 1 END, sc.name)) AS m FROM a, sc WHERE {_MET} >= 0.6 GROUP BY x) SELECT id, CASE m[1] WHEN 0 THEN 'OUT_OF_SCOPE' WHEN 1 THEN 'IN_SCOPE' ELSE 'UNSPECIFIED' END AS sow_status, coalesce(m[2], '') AS sow_reason FROM cand LEFT JOIN h ON cand.symbol_name = h.x")
def scope_any(spark, d):
    return sow.scope_any(candidates(spark, d), _scope(spark)).select("id", "sow_status", "sow_reason")


@query(f"""{C}, sc AS ({_SCOPE}), pf AS (SELECT prefix, arg_min(name, ord) AS first FROM sc GROUP BY prefix), a AS (SELECT id, tag, CASE WHEN id % 2 = 0 THEN symbol_name ELSE '' END AS given, regexp_extract(upper(tag), '^([A-Z]{{1,5}})', 1) AS l FROM cand),
b AS (SELECT id, CASE WHEN given NOT IN ('', tag) THEN given WHEN l = '' THEN given ELSE coalesce(first, 'Tag prefix ' || l) END AS x FROM a LEFT JOIN pf ON a.l = pf.prefix), u AS (SELECT DISTINCT x FROM b),
ex AS (SELECT name, max(CASE WHEN status = 'BLOCK' THEN 1 ELSE 0 END) AS b FROM sc GROUP BY name), nr AS (SELECT x, arg_max(status, (round({_MET}, 6), -ord)) AS s FROM u, sc WHERE round({_MET}, 6) >= 0.6 GROUP BY x)
SELECT b.id, b.x AS symbol, CASE WHEN coalesce(ex.b = 1, nr.s = 'BLOCK') THEN 'OUT_OF_SCOPE' WHEN ex.b IS NOT NULL OR nr.s IS NOT NULL THEN 'IN_SCOPE' ELSE 'UNSPECIFIED' END AS sow_status FROM b LEFT JOIN ex ON upper(trim(b.x)) = ex.name LEFT JOIN nr ON b.x = nr.x""")
def sow_filter(spark, d):
    tags = candidates(spark, d).withColumn("symbol_name", F.when(F.col("id") % 2 == 0, F.col("symbol_name")).otherwise(""))
    return sow.filter_tags(tags, _scope(spark)).select("id", "symbol", "sow_status")


def _records(spark, d):
    """Register records of the candidates: every sixth has a register entry, every ninth comes out of a cloud, every fifth hangs on a parent."""
    i = F.col("id")
    entry = "struct<description:string,equipment_description:string,discipline:string,size_rating:string>"
    reg = F.struct(F.lit("registered").alias("description"), F.lit("unit").alias("equipment_description"), F.lit(" piping ").alias("discipline"), F.lit("10IN").alias("size_rating"))
    details = F.array(F.struct(F.lit(True).alias("pass"), F.lit("REGISTRY").alias("rule"), F.lit("m").alias("message"), (i % 6 == 0).alias("in_registry"), F.when(i % 6 == 0, reg).otherwise(F.lit(None).cast(entry)).alias("registry_entry")))
    rows = candidates(spark, d).select(
        "drawing_id", "ord", i.cast("string").alias("candidate_id"), F.col("tag").alias("tag_text"), "symbol_name", F.col("category").alias("symbol_category"), F.lit("").alias("functional_context"),
        F.when(i % 4 == 0, "FAIL").when(i % 4 == 1, "PASS").otherwise("WARN").alias("validation_status"), F.lit("why").alias("validation_reason"), details.alias("validation_details"),
        F.when(i % 3 == 0, "IN_SCOPE").when(i % 3 == 1, "OUT_OF_SCOPE").alias("sow_status"), F.when(i % 9 == 0, "REVISION_CLOUD").alias("scope_type"), F.lit("PRIMARY").alias("duplicate_status"),
        F.col("det").alias("vision_confidence"), F.col("ocr").alias("ocr_confidence"), F.col("geo").alias("association_confidence"), F.lit(0).alias("patch_id"), F.lit(None).cast("string").alias("symbol_bbox"),
    )
    links = candidates(spark, d).select("drawing_id", i.cast("string").alias("candidate_id"), F.when(i % 5 == 0, F.concat(F.lit("K-V-"), i)).alias("parent_equipment"), (i % 7 == 0).alias("is_isolated"), F.when(i % 8 == 0, "FORWARD").alias("flow_direction"), F.when(i % 10 == 0, "CL-00").alias("control_loop"))
    meta = candidates(spark, d).select("drawing_id").distinct().select("drawing_id", F.concat(F.lit("D-"), F.col("drawing_id")).alias("drawing_number"), F.lit("1").alias("sheet_number"), F.lit("C").alias("revision_code"), F.lit("Plan").alias("drawing_title"), F.lit(None).cast("string").alias("drawing_reference"), F.lit(None).cast("string").alias("current_issue_status"), F.lit(None).cast("string").alias("issue_date"))
    return register.records(rows, meta, links, "PRJ")


_PART = lambda when, text: f"CASE WHEN {when} THEN {text} END"
_REMARKS = "array_to_string(list_filter([" + ", ".join([
    "CASE id % 4 WHEN 0 THEN 'VALIDATION_FAIL: why' WHEN 1 THEN NULL ELSE 'WARN: why' END",
    "CASE id % 3 WHEN 1 THEN 'OUT_OF_SCOPE' WHEN 2 THEN 'NO_SCOPE_DEFINITION_FOUND' END",
    _PART("id % 6 <> 0", "'NOT_IN_REGISTER'"),
    _PART("tag <> '' AND (t0 <> t1 OR t3 <> t4 OR t5 <> t6)", "'TAG_NORMALISED_FROM: ' || tag"),
    _PART("id % 9 = 0", "'WITHIN_REVISION_CLOUD'"),
    _PART("id % 5 = 0", "'PARENT_EQUIP: K-V-' || CAST(id AS VARCHAR)"),
    _PART("id % 7 = 0", "'ISOLATED_DETECTION'"),
    _PART("id % 8 = 0", "'FLOW: FORWARD'"),
    _PART("id % 10 = 0", "'CONTROL_LOOP: CL-00'"),
]) + "], lambda z: z IS NOT NULL), ' | ')"


def _canon() -> str:
    from tagloom.plans.queries import CANON

    return CANON


@query(f"""{_canon()} SELECT drawing_id, CAST(id AS VARCHAR) AS id, row_number() OVER (PARTITION BY drawing_id ORDER BY id) AS slno, CASE WHEN canonical_tag = '' THEN 'UNKNOWN' ELSE canonical_tag END AS tag, {_REMARKS} AS remarks, CAST(CASE WHEN id % 6 = 0 THEN 1.0 ELSE 0.5 END AS DOUBLE) AS c_reg, CASE WHEN id % 6 = 0 THEN '10IN' ELSE '' END AS size,
upper(substr(sha256('PRJ|' || CASE WHEN canonical_tag = '' THEN 'UNKNOWN' ELSE canonical_tag END || '|D-' || CAST(drawing_id AS VARCHAR)), 1, 12)) AS canonical_id, CASE WHEN id % 6 = 0 THEN 'REGISTERED' END AS registered FROM canon""")
def register_records(spark, d):
    r = _records(spark, d)
    return r.select("drawing_id", F.col("_candidate_id").alias("id"), F.col("SLNO").alias("slno"), F.col("`TAG NUMBER`").alias("tag"), F.col("REMARKS").alias("remarks"), F.col("_c_reg").alias("c_reg"), F.col("`SIZE&RATING`").alias("size"), F.col("_canonical_id").alias("canonical_id"), F.when(F.col("_in_registry"), F.col("`TAG DESCRIPTION`")).alias("registered"))


_ROUTED = f"""{_canon()}, q AS (SELECT c.drawing_id, c.id AS id, c.canonical_tag, c.tag, {_REMARKS} AS remarks, d.det, CASE WHEN d.ocr > 0 THEN d.ocr ELSE round(0.9 * d.det, 3) END AS o2, CASE WHEN c.id % 7 = 0 THEN round(d.geo * 0.5, 3) ELSE d.geo END AS g2 FROM canon c JOIN (SELECT id AS did, det, ocr, geo FROM cand) d ON c.id = d.did),
w AS (SELECT *, round(least(1.0, greatest(0.0, 0.30 * det + 0.30 * o2 + 0.15 * g2 + 0.20 * 1.0 + 0.05 * CASE WHEN id % 6 = 0 THEN 1.0 ELSE 0.5 END)), 4) AS c_final FROM q),
rt AS (SELECT *, CASE WHEN trim(tag) IN ('', 'UNKNOWN') THEN 'HUMAN_REVIEW' WHEN c_final >= 0.80 THEN 'AUTO_ACCEPT' WHEN c_final >= 0.55 THEN 'HUMAN_REVIEW' ELSE 'AUTO_REJECT' END AS route FROM w),
rv AS (SELECT *, CASE WHEN trim(tag) IN ('', 'UNKNOWN') THEN 'P1 MISSING_TAG' WHEN id % 4 = 0 THEN 'P1 VALIDATION_FAIL' WHEN contains(upper(remarks), 'DUPLICATE') THEN 'P2 DUPLICATE_CONFLICT' WHEN o2 < 0.75 THEN 'P2 LOW_TEXT_CONF' WHEN id % 7 = 0 THEN 'P3 ISOLATED_DETECTION' WHEN id % 6 <> 0 THEN 'P3 NOT_IN_REGISTER' WHEN id % 3 = 2 THEN 'P3 SOW_UNSPECIFIED' ELSE 'P4 CONFIDENCE_BORDERLINE' END AS why FROM rt)"""


@query(f"{_ROUTED} SELECT drawing_id, row_number() OVER (PARTITION BY drawing_id ORDER BY CAST(substr(why, 2, 1) AS INTEGER), CASE WHEN canonical_tag = '' THEN 'UNKNOWN' ELSE canonical_tag END, CAST(id AS VARCHAR)) AS place, why, c_final FROM rv WHERE route = 'HUMAN_REVIEW'")
def review_queue(spark, d):
    q = register.review_queue(register.routed(_records(spark, d)))
    return q.select("drawing_id", "place", F.concat_ws(" ", "priority_label", "review_reason").alias("why"), "c_final")


@query(f"{_ROUTED} SELECT drawing_id, CAST(id AS VARCHAR) AS id, CASE WHEN canonical_tag = '' THEN 'UNKNOWN' ELSE canonical_tag END AS tag, c_final FROM rt WHERE route = 'AUTO_REJECT'")
def audit_log(spark, d):
    return register.audit_log(register.routed(_records(spark, d))).select("drawing_id", F.col("candidate_id").alias("id"), F.col("tag_number").alias("tag"), "c_final")


@query(f"{_canon()} SELECT drawing_id, CASE WHEN canonical_tag = '' THEN 'UNKNOWN' ELSE canonical_tag END AS tag, count(*) AS records FROM canon GROUP BY 1, 2 HAVING count(*) > 1")
def canonical_duplicates(spark, d):
    return register.canonical_duplicates(_records(spark, d))


_MATCH = f"""{C}, a AS (SELECT DISTINCT tag, {_K} AS k FROM cand WHERE drawing_id < 20 AND {_K} <> ''), b AS (SELECT DISTINCT tag AS reg, {_K} AS rk FROM cand WHERE drawing_id >= 20),
h AS (SELECT a.tag, b.reg, length(rk) - length(k) AS lead, length(rk) AS n FROM a JOIN b ON suffix(rk, k) AND length(rk) - length(k) BETWEEN 0 AND 3 AND (rk = k OR NOT regexp_matches(left(rk, length(rk) - length(k)), '^[0-9]+$'))),
m AS (SELECT tag, arg_min(reg, (lead, n, reg)) AS match FROM h GROUP BY tag), f AS (SELECT CASE WHEN id % 2 = 0 THEN 'AUTO_ACCEPT' ELSE 'HUMAN_REVIEW' END AS sheet, cand.tag, id, match FROM cand LEFT JOIN m ON cand.tag = m.tag WHERE drawing_id < 20)"""


@query(f"""{_MATCH} SELECT sheet || ' rows matching' AS metric, count(match) AS value FROM f GROUP BY sheet UNION ALL SELECT sheet || ' unique register tags', count(DISTINCT match) FROM f GROUP BY sheet UNION ALL SELECT sheet || ' rows not in the register', count(*) - count(match) FROM f GROUP BY sheet
UNION ALL SELECT 'register tags', count(DISTINCT reg) FROM b UNION ALL SELECT 'register tags found', count(DISTINCT match) FROM f UNION ALL SELECT 'register tags missing', count(DISTINCT reg) FROM b WHERE reg NOT IN (SELECT match FROM f WHERE match IS NOT NULL) UNION ALL SELECT 'register tags of several rows', count(*) FROM (SELECT match FROM f WHERE match IS NOT NULL GROUP BY match HAVING count(*) > 1)""")
def comparison_summary(spark, d):
    c = candidates(spark, d)
    rows = c.where("drawing_id < 20").select(F.when(F.col("id") % 2 == 0, "AUTO_ACCEPT").otherwise("HUMAN_REVIEW").alias("sheet"), "tag", "ord")
    return register.compare(rows, c.where("drawing_id >= 20"))["summary"]


@query(f"""{C}, g AS (SELECT DISTINCT tag, {_K} AS k FROM cand WHERE drawing_id < 20), f AS (SELECT tag, {_K} AS k FROM cand WHERE drawing_id >= 20), fk AS (SELECT DISTINCT k FROM f), gk AS (SELECT DISTINCT k FROM g),
hit AS (SELECT DISTINCT g.tag FROM g JOIN fk ON g.k <> '' AND fk.k <> '' AND (g.k = fk.k OR (abs(length(g.k) - length(fk.k)) <= 2 AND (contains(g.k, fk.k) OR contains(fk.k, g.k))))),
ok AS (SELECT DISTINCT fk.k FROM fk JOIN gk ON fk.k <> '' AND gk.k <> '' AND abs(length(gk.k) - length(fk.k)) <= 2 AND (contains(gk.k, fk.k) OR contains(fk.k, gk.k))), c AS (SELECT count(*) AS n FROM f WHERE k IN (SELECT k FROM ok))
SELECT round((SELECT count(*) FROM hit) / (SELECT count(*) FROM g), 4) AS recall, round((SELECT n FROM c) / (SELECT count(*) FROM f), 4) AS precision, (SELECT count(*) FROM hit) AS found_count, (SELECT count(*) FROM g) AS gt_count, (SELECT n FROM c) AS correct, (SELECT count(*) FROM f) AS detections""")
def recall_precision(spark, d):
    c = candidates(spark, d)
    return lookup.recall_precision(c.where("drawing_id >= 20"), c.where("drawing_id < 20"))


_HIT = "(g.k = f.k OR (abs(length(g.k) - length(f.k)) <= 2 AND (contains(g.k, f.k) OR contains(f.k, g.k))))"


@query(f"""{C}, g AS (SELECT DISTINCT tag, {_K} AS k FROM cand WHERE drawing_id < 20), f AS (SELECT DISTINCT {_K} AS k, drawing_id % 2 AS side FROM cand WHERE drawing_id >= 20 AND {_K} <> '')
SELECT tag FROM g WHERE NOT EXISTS (SELECT 1 FROM f WHERE g.k <> '' AND side = 0 AND {_HIT}) AND NOT EXISTS (SELECT 1 FROM f WHERE g.k <> '' AND side = 1 AND {_HIT})""")
def missing_in_both(spark, d):
    c = candidates(spark, d)
    return lookup.missing_in_both(c.where("drawing_id < 20"), c.where("drawing_id >= 20 AND drawing_id % 2 = 0"), c.where("drawing_id >= 20 AND drawing_id % 2 = 1"))


@query(f"{C}, g AS (SELECT DISTINCT {_K} AS k FROM cand WHERE drawing_id >= 20 AND {_K} <> ''), f AS (SELECT DISTINCT tag, {_K} AS k FROM cand WHERE drawing_id < 20 AND {_K} <> '') SELECT tag FROM f WHERE NOT EXISTS (SELECT 1 FROM g WHERE contains(g.k, f.k) OR contains(f.k, g.k))")
def extra_detections(spark, d):
    c = candidates(spark, d)
    return lookup.extras(c.where("drawing_id < 20"), c.where("drawing_id >= 20"))


_STEPS = "abs((a.x1 + a.x2) / 2.0 - (b.x1 + b.x2) / 2.0) + abs((a.y1 + a.y2) / 2.0 - (b.y1 + b.y2) / 2.0)"


@query(f"""{B}, f AS (SELECT *, CASE WHEN id % 2 = 0 THEN 'V-' ELSE '' END || tag AS t FROM boxes), p AS (SELECT a.drawing_id, a.id, arg_min(b.id, ({_STEPS}, b.ord)) AS other, arg_min(b.t, ({_STEPS}, b.ord)) AS other_tag, min(a.t) AS full_tag, round(min({_STEPS}), 1) AS distance
FROM f a JOIN f b ON a.drawing_id = b.drawing_id AND a.id % 3 = 0 AND b.id % 3 <> 0 AND {_STEPS} <= 150 GROUP BY 1, 2), k AS (SELECT *, replace(full_tag, '-', '') AS x, replace(other_tag, '-', '') AS y FROM p)
SELECT drawing_id, id, other, CASE WHEN suffix(x, y) OR suffix(y, x) THEN 'prefix' ELSE 'mismatch' END AS kind, full_tag, other_tag, distance FROM k WHERE x <> y""")
def prefix_discrepancies(spark, d):
    b = boxes(spark, d).withColumn("tag", F.concat(F.when(F.col("id") % 2 == 0, "V-").otherwise(""), "tag"))
    return lookup.prefix_discrepancies(b.where("id % 3 = 0"), b.where("id % 3 <> 0"))


_BS = f"least({_pd('(a.x1 + a.x2) / 2.0', '(a.y1 + a.y2) / 2.0')}, {_pd('a.x1', 'a.y1')}, {_pd('a.x2', 'a.y1')}, {_pd('a.x1', 'a.y2')}, {_pd('a.x2', 'a.y2')})"


@query(f"{S}, p AS (SELECT a.drawing_id, a.id AS a, a.id % 2 AS o, s.id AS line, {_BS} AS d FROM boxes a JOIN seg s ON a.drawing_id = s.drawing_id WHERE a.id % 3 <> 0) SELECT drawing_id, a, arg_min(line, (d, line)) AS b, CASE o WHEN 0 THEN 'MONITORS' ELSE 'CONNECTED_TO' END AS rel, round(min(d), 1) AS gap FROM p WHERE d < 60 GROUP BY drawing_id, a, o")
def symbol_edges(spark, d):
    kind = F.when(F.col("id") % 3 == 0, "equipment").when(F.col("id") % 2 == 0, "instrument").otherwise("valve")
    return hierarchy.symbol_edges(boxes(spark, d).withColumn("kind", kind), segments(spark, d).withColumn("line", F.col("id"))).select("drawing_id", "a", "b", "rel", F.regexp_extract("evidence", "([0-9.]+)px", 1).cast("double").alias("gap"))


_GAP = "sqrt(greatest(0, greatest(a.x1 - b.x2, b.x1 - a.x2)) ** 2 + greatest(0, greatest(a.y1 - b.y2, b.y1 - a.y2)) ** 2)"


@query(f"{B}, p AS (SELECT a.drawing_id, a.id AS a, b.id AS b, {_GAP} AS d FROM boxes a JOIN boxes b ON a.drawing_id = b.drawing_id AND a.id % 3 <> 0 AND a.id % 4 <> 1 AND b.id % 3 = 0) SELECT drawing_id, a, arg_min(b, (d, b)) AS b, round(min(d), 1) AS gap FROM p WHERE d < 200 GROUP BY drawing_id, a")
def mounted_edges(spark, d):
    b = boxes(spark, d).withColumn("kind", F.when(F.col("id") % 3 == 0, "equipment").otherwise("instrument")).withColumn("tag", F.when(F.col("id") % 4 == 1, "V-FIT-1").otherwise("V-PIT-2"))
    return hierarchy.mounted_edges(b).select("drawing_id", "a", "b", F.regexp_extract("evidence", "([0-9.]+)px", 1).cast("double").alias("gap"))


@query(f"""{S}, e AS (SELECT DISTINCT drawing_id, id % 20 AS line, CAST(sx0 AS DOUBLE) AS x, CAST(sy0 AS DOUBLE) AS y FROM seg UNION SELECT DISTINCT drawing_id, id % 20, sx1, sy1 FROM seg),
p AS (SELECT a.drawing_id, a.line, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 3) AS span, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_ FROM e a JOIN e b ON a.drawing_id = b.drawing_id AND a.line = b.line AND (a.x < b.x OR (a.x = b.x AND a.y <= b.y))),
m AS (SELECT drawing_id, line, arg_min((ax, ay, bx, by_), (-span, ax, ay, bx, by_)) AS q, max(span) AS span FROM p GROUP BY 1, 2) SELECT drawing_id, line, q[1] AS ax, q[2] AS ay, q[3] AS bx, q[4] AS by, span FROM m""")
def pipeline_axis(spark, d):
    e = hierarchy.ends_of(segments(spark, d)).select("drawing_id", (F.col("id") % 20).alias("line"), F.col("box.x1").alias("x"), F.col("box.y1").alias("y"))
    return hierarchy.axis(e).select("drawing_id", "line", F.col("a.x").alias("ax"), F.col("a.y").alias("ay"), F.col("b.x").alias("bx"), F.col("b.y").alias("by"), "span")


@query(f"""WITH RECURSIVE {_E}, r AS (SELECT DISTINCT drawing_id, b AS node, CAST(NULL AS VARCHAR) AS parent, 0 AS depth FROM e WHERE b LIKE 'N%' UNION ALL SELECT e.drawing_id, e.b, e.a, r.depth + 1 FROM r JOIN e ON e.a = r.node AND e.drawing_id = r.drawing_id), t AS (SELECT * FROM r UNION ALL SELECT drawing_id, a, b, 1 FROM e WHERE a LIKE 'R%'),
k AS (SELECT drawing_id, parent, count(*) AS n, array_to_string(list_sort(list(node)), ',') AS kids FROM t WHERE parent IS NOT NULL GROUP BY 1, 2), dd AS (SELECT drawing_id, a AS node, count(*) AS n FROM e WHERE a LIKE 'C%' GROUP BY 1, 2)
SELECT t.drawing_id, t.node, t.parent, t.depth, coalesce(k.kids, '') AS children, coalesce(s.n - 1, 0) AS siblings, CASE WHEN t.depth = 0 THEN (SELECT count(*) - 1 FROM t x WHERE x.drawing_id = t.drawing_id) ELSE coalesce(dd.n, 0) END AS descendants
FROM t LEFT JOIN k ON t.drawing_id = k.drawing_id AND t.node = k.parent LEFT JOIN k s ON t.drawing_id = s.drawing_id AND t.parent = s.parent LEFT JOIN dd ON t.drawing_id = dd.drawing_id AND t.node = dd.node""")
def rooted_tree(spark, d):
    """Nations are equipment and so the roots, above their regions."""
    box = F.struct(F.lit(0).alias("x1"), F.lit(0).alias("y1"), F.lit(9).alias("x2"), F.lit(9).alias("y2"))
    e = _tree(spark, d)
    regions = e.where("a LIKE 'R%'").select("drawing_id", F.col("a").alias("node"), F.lit("valve").alias("kind"))
    nodes = _nodes(spark, d).select("drawing_id", "node", "kind").unionAll(regions).withColumn("box", box)
    tree = hierarchy.rooted_tree(nodes, e)
    return hierarchy.relatives(tree, named=False).select("drawing_id", "node", "parent", "depth", F.array_join("children", ",").alias("children"), "siblings", "descendants")


@query(f"""WITH {_E}, {_NODES}, {_EDGES} SELECT n.drawing_id, n.node, CASE WHEN n.node LIKE 'R%' THEN NULL ELSE 'N' || CAST(n.drawing_id AS VARCHAR) END AS parent, CASE WHEN n.node LIKE 'S%' THEN 'MOUNTED_ON' WHEN n.node LIKE 'C%' THEN 'direct_parent' ELSE 'pipeline_traversal' END AS evidence FROM nodes n WHERE n.node LIKE 'S%' OR n.node LIKE 'C%' OR (n.node LIKE 'O%' AND n.parent IS NOT NULL)""")
def equipment_parents(spark, d):
    tagged = _nodes(spark, d).withColumn("tag", F.when(F.col("kind") == "instrument", F.concat(F.lit("V-PIT-"), F.lpad(F.substr(F.col("node"), F.lit(2)), 3, "0"))).otherwise(F.col("tag")))
    found = hierarchy.parent_candidates(tagged, _edges(spark, d), tagged.select("drawing_id", "node", "parent"))
    return hierarchy.equipment_parent(found).select("drawing_id", "node", "parent", "evidence")


@query(f"""WITH {_E}, {_NODES}, x AS (SELECT *, CASE WHEN parent IS NULL THEN [] WHEN node LIKE 'O%' THEN ['N' || CAST(drawing_id AS VARCHAR), parent] ELSE [parent] END AS up FROM nodes)
SELECT drawing_id, node, CASE WHEN len(up) > 0 OR kind = 'equipment' THEN 'N' || CAST(drawing_id AS VARCHAR) ELSE 'UNASSIGNED' END AS system, 'P1.A1.' || array_to_string(list_append(up, tag), '.') AS functional_location, coalesce(parent, 'NULL') AS parent_equipment, len(up) AS level, array_to_string(list_append(up, tag), ' > ') AS path, kind = 'piping' AS piping FROM x""")
def asset_hierarchy(spark, d):
    rows = hierarchy.asset_rows(_nodes(spark, d), F.lit("P1"), F.lit("A1"))
    return rows.select("drawing_id", "node", "system", "functional_location", "parent_equipment", "level", "path", "piping")


@query(f"WITH {_E}, {_NODES} SELECT drawing_id, tag, arg_max(node, (conf, node)) AS node, bool_or(parent IS NULL) AS no_parent, bool_or(iso) AS isolated FROM nodes WHERE iso OR (parent IS NULL AND kind <> 'equipment') GROUP BY 1, 2")
def orphan_nodes(spark, d):
    return hierarchy.orphans(_nodes(spark, d)).select("drawing_id", "tag", "node", "no_parent", "isolated")


@query(f"{B}, e AS (SELECT drawing_id, id AS line, x1 AS x, y1 AS y FROM boxes WHERE id % 2 = 0), j AS (SELECT drawing_id, 'JN-' || CAST(id AS VARCHAR) AS j, x1 AS x, y1 AS y FROM boxes WHERE id % 2 = 1), p AS (SELECT e.drawing_id, line, j, sqrt((e.x - j.x) ** 2.0 + (e.y - j.y) ** 2.0) AS d FROM e JOIN j ON e.drawing_id = j.drawing_id) SELECT drawing_id, line, arg_min(j, (d, j)) AS junction FROM p WHERE d < 75 GROUP BY 1, 2")
def nearest_junctions(spark, d):
    b = boxes(spark, d)
    x, y = F.col("box.x1"), F.col("box.y1")
    ends = b.where("id % 2 = 0").select("drawing_id", F.col("id").alias("line"), F.lit(0).alias("end"), F.struct(x.alias("x1"), y.alias("y1"), x.alias("x2"), y.alias("y2")).alias("box"))
    spots = b.where("id % 2 = 1").select("drawing_id", F.concat(F.lit("JN-"), F.col("id")).alias("junction"), x.alias("x"), y.alias("y"))
    return hierarchy.nearest_junctions(ends, spots).select("drawing_id", "line", "junction")




def _axes(spark, d):
    s = F.col("seg")
    return segments(spark, d).select("drawing_id", F.col("id").alias("line"), F.struct(s["x0"].cast("double").alias("x"), s["y0"].cast("double").alias("y")).alias("a"), F.struct(s["x1"].cast("double").alias("x"), s["y1"].cast("double").alias("y")).alias("b"))


_GROWN = "{x} >= b.x1 - 90 AND {x} <= b.x2 + 90 AND {y} >= b.y1 - 90 AND {y} <= b.y2 + 90"


@query(f"""{S}, p AS (SELECT b.drawing_id, b.id AS equipment, s.id AS line, b.tag, (b.x1 + b.x2) / 2.0 AS cx, (b.y1 + b.y2) / 2.0 AS cy, b.y2 - b.y1 AS h, {_GROWN.format(x='s.sx0', y='s.sy0')} AS at_a, s.sx0, s.sy0, s.sx1, s.sy1 FROM boxes b JOIN seg s ON b.drawing_id = s.drawing_id
WHERE ({_GROWN.format(x='s.sx0', y='s.sy0')}) OR ({_GROWN.format(x='s.sx1', y='s.sy1')})), q AS (SELECT *, CASE WHEN at_a THEN 'A' ELSE 'B' END AS e, CASE WHEN tag = 'T-7' THEN CASE WHEN at_a THEN sx0 ELSE sx1 END >= cx ELSE CASE WHEN at_a THEN sy0 ELSE sy1 END >= cy + h * 0.15 END AS o FROM p)
SELECT drawing_id, equipment, line, e AS "end", o AS outgoing, CASE WHEN o = (e = 'A') THEN 'forward' ELSE 'reverse' END AS direction FROM q""")
def flow_conventions(spark, d):
    return flow.equipment_conventions(boxes(spark, d), _axes(spark, d), compressors=("T-7",))


@query(f"""{S}, w AS (SELECT *, CASE id % 5 WHEN 0 THEN 'left_to_right' WHEN 1 THEN 'right_to_left' WHEN 2 THEN 'top_to_bottom' WHEN 3 THEN 'bottom_to_top' ELSE 'unclear' END AS word FROM seg)
SELECT drawing_id, id AS line, CASE WHEN CASE word WHEN 'left_to_right' THEN sx1 - sx0 WHEN 'right_to_left' THEN sx0 - sx1 WHEN 'top_to_bottom' THEN sy1 - sy0 ELSE sy0 - sy1 END >= 0 THEN 'forward' ELSE 'reverse' END AS direction FROM w WHERE word <> 'unclear'""")
def flow_answers(spark, d):
    words = F.element_at(F.array(*[F.lit(x) for x in ("left_to_right", "right_to_left", "top_to_bottom", "bottom_to_top", "unclear")]), (F.col("line") % 5 + 1).cast("int"))
    axes = _axes(spark, d)
    return flow.answered_directions(axes.select("drawing_id", "line", words.alias("word")), axes)


def _connections(spark, d):
    """(lines, ends, links): every second line has a junction at its first end; of five lines one has a valve, one a monitor and one equipment at its other end."""
    axes = _axes(spark, d)
    n = F.col("line")
    junctions = axes.where("line % 2 = 0").select("drawing_id", "line", "a.x", "a.y")
    kind = F.when(n % 5 == 1, "valve").when(n % 5 == 2, "instrument").otherwise("equipment")
    rel = F.when(n % 5 == 1, "CONNECTED_TO").when(n % 5 == 2, "MONITORS").otherwise("MOUNTED_ON")
    b = F.col("b")
    box = F.struct((b["x"] - 1).alias("x1"), (b["y"] - 1).alias("y1"), (b["x"] + 1).alias("x2"), (b["y"] + 1).alias("y2"))
    links = axes.where("line % 5 IN (1, 2, 3)").select("drawing_id", "line", rel.alias("rel"), kind.alias("kind"), box.alias("box"))
    lines = axes.select("drawing_id", "line", (n % 4 + 1).alias("segments"), F.when(n % 7 == 0, "forward").otherwise("unknown").alias("direction"))
    return lines, flow.connected_ends(axes, junctions, links), links


@query(f"""{S} SELECT drawing_id, id AS line, CASE WHEN id % 2 = 0 THEN 'reverse' ELSE 'forward' END AS direction FROM seg WHERE id % 7 <> 0 AND id % 5 <> 2 AND (id % 5 IN (1, 3) OR id % 4 + 1 >= 3) AND ((id % 2 = 0 AND id % 5 NOT IN (1, 3)) OR (id % 2 = 1 AND id % 5 = 3))""")
def flow_dead_legs(spark, d):
    lines, ends, links = _connections(spark, d)
    return flow.dead_leg_directions(lines, ends, links)


@query(f"{S} SELECT drawing_id, id AS line FROM seg WHERE id % 7 <> 0 AND id % 2 = 0 AND id % 5 IN (1, 3)")
def flow_unresolved(spark, d):
    lines, ends, links = _connections(spark, d)
    return flow.unresolved(lines, ends, links).select("drawing_id", "line")


_BOX = "least(a.sx0, a.sx1) AS x1, least(a.sy0, a.sy1) AS y1, greatest(a.sx0, a.sx1) AS x2, greatest(a.sy0, a.sy1) AS y2"


@query(f"""{S}, l AS (SELECT drawing_id, id, {_BOX} FROM seg a), e AS (SELECT drawing_id, id, sx0 AS x, sy0 AS y FROM seg UNION ALL SELECT drawing_id, id, sx1, sy1 FROM seg),
p AS (SELECT l.drawing_id, l.id AS line, e.id AS other, unnest([CASE WHEN x BETWEEN x1 - 150 AND x1 AND y BETWEEN y1 - 30 AND y2 + 30 THEN 'LEFT' END, CASE WHEN x BETWEEN x2 AND x2 + 150 AND y BETWEEN y1 - 30 AND y2 + 30 THEN 'RIGHT' END, CASE WHEN y BETWEEN y1 - 150 AND y1 AND x BETWEEN x1 - 30 AND x2 + 30 THEN 'UP' END, CASE WHEN y BETWEEN y2 AND y2 + 150 AND x BETWEEN x1 - 30 AND x2 + 30 THEN 'DOWN' END]) AS side FROM l JOIN e ON l.drawing_id = e.drawing_id AND l.id <> e.id)
SELECT DISTINCT drawing_id, line, side, other FROM p WHERE side IS NOT NULL""")
def adjacent_lines(spark, d):
    lines = segments(spark, d).select("drawing_id", F.col("id").alias("line"), "box")
    ends = hierarchy.ends_of(segments(spark, d)).select("drawing_id", F.col("id").alias("line"), "box")
    return flow.adjacent_lines(lines, ends, 150, 30)


_OK = "x2 - x1 >= 30 AND y2 - y1 >= 30 AND (category <> 'equipment' OR ((x2 - x1) * (y2 - y1) >= 5000 AND greatest(x2 - x1, y2 - y1) / least(x2 - x1, y2 - y1) <= 3.5))"


@query(f"""{B}, d AS (SELECT drawing_id, id, CASE WHEN id % 7 = 0 THEN 'V-' ELSE '' END || tag AS k, CASE WHEN id % 3 = 0 THEN 'equipment' ELSE 'valve' END AS category, conf, x1, y1, x2, y2 FROM boxes), g AS (SELECT *, {_OK} AS ok FROM d),
lab AS (SELECT drawing_id, k, arg_max(id, (conf, -id)) AS id FROM g WHERE NOT ok AND category = 'equipment' AND greatest(x2 - x1, y2 - y1) / greatest(least(x2 - x1, y2 - y1), 1) > 3.5 AND NOT EXISTS (SELECT 1 FROM g h WHERE h.ok AND h.category = 'equipment' AND h.drawing_id = g.drawing_id AND h.k = g.k) GROUP BY 1, 2),
kept AS (SELECT g.* FROM g WHERE ok OR EXISTS (SELECT 1 FROM lab WHERE lab.drawing_id = g.drawing_id AND lab.id = g.id)), e AS (SELECT a.drawing_id, a.id AS a, b.id AS b FROM kept a JOIN kept b ON a.drawing_id = b.drawing_id AND a.id <> b.id AND a.k = b.k AND a.category = b.category AND {_D} <= 400),
r AS (SELECT drawing_id, id AS node, id AS root FROM kept UNION SELECT r.drawing_id, e.b, r.root FROM r JOIN e ON r.drawing_id = e.drawing_id AND r.node = e.a), m AS (SELECT drawing_id, node, min(root) AS root FROM r GROUP BY 1, 2),
one AS (SELECT m.drawing_id, m.root, arg_max(id, (conf, (x2 - x1) * (y2 - y1), -id)) AS id, min(k) AS k, count(*) AS members FROM m JOIN kept ON m.drawing_id = kept.drawing_id AND m.node = kept.id GROUP BY 1, 2),
site AS (SELECT drawing_id, substr(k, 3) AS k, min(id) AS into_id FROM one WHERE k LIKE 'V-%' GROUP BY 1, 2)
SELECT one.drawing_id, one.id, one.k AS tag, one.members, NOT kept.ok AS label_only FROM one JOIN kept ON one.drawing_id = kept.drawing_id AND one.id = kept.id WHERE one.k LIKE 'V-%' OR NOT EXISTS (SELECT 1 FROM site WHERE site.drawing_id = one.drawing_id AND site.k = one.k)""")
def entity_resolution(spark, d):
    b = boxes(spark, d).withColumn("tag", F.concat(F.when(F.col("id") % 7 == 0, "V-").otherwise(""), "tag")).withColumn("category", F.when(F.col("id") % 3 == 0, "equipment").otherwise("valve"))
    entities, _ = flow.resolve_entities(b, 400)
    return entities.select("drawing_id", "id", "tag", "members", "label_only")


@query(f"""{B}, t AS (SELECT *, id % 4 <> 0 AS own, x1 + CASE WHEN id % 4 = 0 THEN 0 ELSE 40 END AS tx1, x2 + CASE WHEN id % 4 = 0 THEN 0 ELSE 40 END AS tx2, greatest(y2 - y1, 1) * 1.5 AS pad FROM boxes),
n AS (SELECT DISTINCT a.drawing_id, a.id FROM t a JOIN t b ON a.drawing_id = b.drawing_id AND a.id <> b.id AND b.own AND a.tx1 - a.pad < b.x2 AND a.tx2 + a.pad > b.x1 AND a.y1 - a.pad < b.y2 AND a.y2 + a.pad > b.y1)
SELECT t.drawing_id, t.id, t.own OR n.id IS NOT NULL OR NOT ((y1 + y2) / 2.0 < 400 OR (y1 + y2) / 2.0 > 6500 OR (x1 + x2) / 2.0 < 800 OR (x1 + x2) / 2.0 > 9000) AS kept FROM t LEFT JOIN n ON t.drawing_id = n.drawing_id AND t.id = n.id""")
def zone_text_gate(spark, d):
    b = F.col("box")
    move = F.when(F.col("id") % 4 == 0, 0).otherwise(40)
    tag_box = F.struct((b["x1"] + move).alias("x1"), b["y1"].alias("y1"), (b["x2"] + move).alias("x2"), b["y2"].alias("y2"))
    rows = boxes(spark, d).select("drawing_id", "id", "tag", b.alias("symbol"), tag_box.alias("tag_box"))
    return flow.zone_text_gate(rows).select("drawing_id", "id", "kept")


@query(f"{S}, p AS (SELECT a.drawing_id, a.id, s.id % 30 AS line FROM boxes a JOIN seg s ON a.drawing_id = s.drawing_id WHERE {_BS} <= 50) SELECT drawing_id, line, count(DISTINCT id) AS nodes FROM p GROUP BY 1, 2")
def line_reach(spark, d):
    symbols = boxes(spark, d).withColumn("kind", F.when(F.col("id") % 2 == 0, "valve").otherwise("instrument"))
    return flow.line_reach(symbols, segments(spark, d).withColumn("line", F.col("id") % 30), 50).select("drawing_id", "line", F.size("nodes").alias("nodes"))


_NOTES = "SELECT doc_id % 20 AS drawing_id, CASE doc_id % 3 WHEN 0 THEN ' n' || CAST(doc_id % 400 AS VARCHAR) WHEN 1 THEN 'unknown' END AS id, text AS raw_text, CASE WHEN doc_id % 5 <> 0 THEN CAST(doc_id % 7 AS DOUBLE) / 10 END AS confidence, doc_id AS ord FROM documents"


def _notes(spark, d):
    n = F.col("doc_id")
    return table(spark, d, "documents").select((n % 20).alias("drawing_id"), F.when(n % 3 == 0, F.concat(F.lit(" n"), n % 400)).when(n % 3 == 1, "unknown").alias("id"), F.col("text").alias("raw_text"), F.when(n % 5 != 0, (n % 7).cast("double") / 10).alias("confidence"), n.alias("ord"))


@query(f"WITH n AS ({_NOTES}), k AS (SELECT *, CASE WHEN upper(trim(coalesce(id, ''))) NOT IN ('', 'UNKNOWN') THEN upper(trim(id)) ELSE upper(left(trim(coalesce(raw_text, '')), 40)) END AS key, coalesce(confidence, 0.5) + length(trim(coalesce(raw_text, ''))) / 1000 AS score FROM n) SELECT drawing_id, ord FROM k WHERE key <> '' QUALIFY row_number() OVER (PARTITION BY drawing_id, key ORDER BY score DESC, ord) = 1")
def best_notes(spark, d):
    return shaping.best_notes(_notes(spark, d)).select("drawing_id", "ord")


@query("WITH t AS (SELECT o_custkey AS drawing_id, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE lower(o_orderpriority) END AS title, o_orderkey % 3 AS priority, o_orderkey AS ord FROM orders) SELECT drawing_id, ord FROM t QUALIFY title = '' OR row_number() OVER (PARTITION BY drawing_id, title ORDER BY priority, ord) = 1")
def distinct_tables(spark, d):
    k = F.col("o_orderkey")
    title = F.when(k % 4 == 0, " ").when(k % 2 == 0, F.col("o_orderpriority")).otherwise(F.lower("o_orderpriority"))
    return shaping.distinct_tables(table(spark, d, "orders").select(F.col("o_custkey").alias("drawing_id"), title.alias("title"), (k % 3).alias("priority"), k.alias("ord"))).select("drawing_id", "ord")


@query("SELECT o_custkey AS drawing_id, left(o_orderpriority, 1) AS abbreviation, arg_max(o_orderstatus || CAST(o_orderkey AS VARCHAR), o_orderkey) AS meaning FROM orders GROUP BY 1, 2")
def merged_abbreviations(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("drawing_id"), F.col("o_orderkey").alias("ord"), F.create_map(F.left("o_orderpriority", F.lit(1)), F.concat("o_orderstatus", "o_orderkey")).alias("abbreviations"))
    return shaping.merged_abbreviations(o)


@query("WITH n AS (SELECT o_custkey AS drawing_id, o_orderkey AS ord, CASE o_orderkey % 7 WHEN 0 THEN 'imperial' WHEN 1 THEN 'metric' WHEN 2 THEN 'imperial' END AS u FROM orders) SELECT drawing_id, coalesce(arg_max(u, ord) FILTER (u IS NOT NULL), 'mixed') AS unit_system FROM n GROUP BY 1")
def conventions(spark, d):
    k = F.col("o_orderkey")
    raw = F.when(k % 7 == 0, "Units are Metric and imperial").when(k % 7 == 1, "METRIC only").when(k % 7 == 2, "imperial").otherwise("none")
    return shaping.conventions(table(spark, d, "orders").select(F.col("o_custkey").alias("drawing_id"), k.alias("ord"), raw.alias("raw_text")))


@query(f"{B}, q AS (SELECT drawing_id, id, x2 - x1 AS w, y2 - y1 AS h FROM boxes) SELECT drawing_id, id, round((w + 2.0 * h + 2.0 * sqrt((w / 2.0) ** 2 + (h / 2.0) ** 2)) / (2.0 * w + 2.0 * h), 6) AS bumps, 0.75::DOUBLE AS solid FROM q")
def polygon_shape(spark, d):
    """Boxes with a notch from the top side down to the centre: three quarters of the box, and two slanted sides in place of the top one."""
    b = F.col("box")
    x, y = g.center(b)

    def at(u, v):
        return F.struct(u.cast("double").alias("x"), v.cast("double").alias("y"))

    p = F.array(at(b["x1"], b["y1"]), at(x, y), at(b["x2"], b["y1"]), at(b["x2"], b["y2"]), at(b["x1"], b["y2"]))
    rows = boxes(spark, d).select("drawing_id", "id", p.alias("p")).withColumn("h", g.convex_hull(F.col("p")))
    return rows.select("drawing_id", "id", F.round(g.scallopedness(F.col("p"), F.col("h")), 6).alias("bumps"), F.round(g.solidity(F.col("p"), F.col("h")), 6).alias("solid"))


@query(f"{B} SELECT drawing_id, id, round((x2 - x1 - 4.0) * (y2 - y1 + 1.0) / ((x2 - x1 + 6.0) * (y2 - y1 + 1.0)), 6) AS iou FROM boxes")
def polygon_overlaps(spark, d):
    """Each box against itself moved by five: whole coordinates inside or on both over those of either."""
    b = F.col("box")

    def rectangle(by):
        return F.array(*[F.struct((u + by).cast("double").alias("x"), v.cast("double").alias("y")) for u, v in ((b["x1"], b["y1"]), (b["x2"], b["y1"]), (b["x2"], b["y2"]), (b["x1"], b["y2"]))])

    rows = boxes(spark, d).select("drawing_id", "id", g.polygon_overlap(rectangle(0), rectangle(5)).alias("o"))
    return rows.select("drawing_id", "id", F.round(g.polygon_iou(F.col("o")), 6).alias("iou"))

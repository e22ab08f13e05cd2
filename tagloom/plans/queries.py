"""A query per operator or group of operators, bound to the supplied tables, and DuckDB SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom import rules
from tagloom.functions import geometry as g
from tagloom.functions import scores as s
from tagloom.functions import text as t
from tagloom.operators import dedup, graph, hierarchy, lookup, shaping, spatial
from tagloom.plans.fixtures import BOXES, CANDIDATES, SEGMENTS, boxes, candidates, segments, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
C = f"WITH cand AS ({CANDIDATES})"
B = f"WITH RECURSIVE boxes AS ({BOXES})"
S = f"WITH boxes AS ({BOXES}), seg AS ({SEGMENTS})"


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return put


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_case(text: str, table_: list[tuple], outcome: int = 1) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({text}, {_q(r[0])}) THEN {_q(r[outcome])}" for r in table_) + " END"


def sql_fold(x: str) -> str:
    return f"translate({x}, '—–―−', '----')"


def sql_key(x: str, strip: str) -> str:
    return f"replace(regexp_replace({sql_fold(f'upper(trim(coalesce({x}, {_q('')})))')}, {_q(strip)}, '', 'g'), 'IN', '')"


DEDUP_KEY = "[\\s\\-.“”‘’\"']+"
EVAL_KEY = "[\\s\\-`“”‘’\"']+"
CANON = f"""{C}, c0 AS (SELECT id, drawing_id, tag, symbol_name, category, trim(tag) AS t0 FROM cand),
c1 AS (SELECT *, translate(t0, '–—−' || chr(160) || chr(9), '---  ') AS t1 FROM c0),
c2 AS (SELECT *, regexp_replace(t1, '([0-9])\\s*["”“]', '\\1IN', 'g') AS t2 FROM c1),
c3 AS (SELECT *, upper(t2) AS t3 FROM c2), c4 AS (SELECT *, regexp_replace(t3, '[\\s./_\\\\]+', '-', 'g') AS t4 FROM c3),
c5 AS (SELECT *, regexp_replace(t4, '-{{2,}}', '-', 'g') AS t5 FROM c4), c6 AS (SELECT *, regexp_replace(t5, '[^A-Z0-9\\-"]', '', 'g') AS t6 FROM c5),
c7 AS (SELECT *, regexp_replace(t6, '^-+|-+$', '', 'g') AS t7 FROM c6),
canon AS (SELECT *, CASE WHEN tag = '' THEN '' ELSE t7 END AS canonical_tag, CASE WHEN tag = '' THEN ['empty_input'] ELSE list_filter([
  CASE WHEN t0 <> t1 THEN 'ocr_char_fix' END, CASE WHEN t1 <> t2 THEN 'inch_normalised' END, CASE WHEN t2 <> t3 THEN 'uppercased' END,
  CASE WHEN t3 <> t4 THEN 'separators_normalised' END, CASE WHEN t4 <> t5 THEN 'collapsed_hyphens' END,
  CASE WHEN t5 <> t6 THEN 'illegal_chars_removed' END, CASE WHEN t6 <> t7 THEN 'leading_trailing_hyphens_stripped' END], lambda x: x IS NOT NULL) END AS log0 FROM c7)"""


@query(f"{CANON} SELECT id, canonical_tag, array_to_string(CASE WHEN len(log0) = 0 THEN ['no_change'] ELSE log0 END, ',') AS log FROM canon")
def canonical_tag(spark, d):
    return t.canonical_tag(candidates(spark, d), "tag").select("id", "canonical_tag", F.array_join("transforms", ",").alias("log"))


@query(f"{CANON} SELECT unnest(CASE WHEN len(log0) = 0 THEN ['no_change'] ELSE log0 END) AS label, count(*) AS n FROM canon GROUP BY 1")
def transform_log(spark, d):
    return shaping.tally(t.canonical_tag(candidates(spark, d), "tag"))


@query(f"""{C} SELECT id, {sql_key('tag', DEDUP_KEY)} AS dedup_key, {sql_key('tag', EVAL_KEY)} AS eval_key, regexp_replace({sql_key('tag', DEDUP_KEY)}, '^[A-Z]', '') AS no_area,
translate({sql_key('tag', DEDUP_KEY)}, '01', 'OI') AS folded, regexp_replace(tag, '^[A-Z]+-', '') AS bare, regexp_extract(tag, '^([A-Z]{{1,4}})', 1) AS prefix FROM cand""")
def tag_keys(spark, d):
    c = F.col("tag")
    return candidates(spark, d).select("id", t.dedup_key(c).alias("dedup_key"), t.eval_key(c).alias("eval_key"), t.registry_key_without_area(c).alias("no_area"), t.fold_confusable(t.dedup_key(c)).alias("folded"), t.strip_area_prefix(c).alias("bare"), t.tag_prefix(c).alias("prefix"))


@query(f"""{C}, a AS (SELECT id, upper(trim(tag)) AS x FROM cand), b AS (SELECT id, regexp_replace(x, '([0-9]+(?:\\.[0-9]+)?)\\s*(?:''''|"|´´|′′|″|”|’’)', '\\1IN', 'g') AS x FROM a),
c AS (SELECT id, regexp_replace(x, '\\s*-\\s*', '-', 'g') AS x FROM b), e AS (SELECT id, regexp_replace(x, '^([A-Z])\\s+([A-Z])', '\\1-\\2') AS x FROM c),
f AS (SELECT id, trim(regexp_replace(regexp_replace(x, '-{{2,}}', '-', 'g'), '\\s+', ' ', 'g')) AS x FROM e) SELECT id, regexp_replace(x, '^-+|-+$', '', 'g') AS tag FROM f""")
def normalize_tag(spark, d):
    return candidates(spark, d).select("id", t.normalize_tag(F.col("tag")).alias("tag"))


_FOLDED = "translate(trim(tag), '—–―−“”’', '----\"\"''')"


@query(f"""{C}, f AS (SELECT id, {_FOLDED} AS x, {sql_case(_FOLDED, rules.TAG_FORMATS)} AS name FROM cand)
SELECT id, CASE WHEN x = '' THEN 'Empty or null tag text' WHEN name IS NOT NULL THEN 'Matches ISA pattern: ' || name
WHEN regexp_matches(x, {_q(rules.BASIC_FORMAT)}) THEN 'Matches basic prefix-number format' ELSE 'Does not match ISA-5.1 format: ''' || x || '''' END AS message,
x <> '' AND (name IS NOT NULL OR regexp_matches(x, {_q(rules.BASIC_FORMAT)})) AS passed FROM f""")
def rule_first_match(spark, d):
    return candidates(spark, d).withColumn("f", t.tag_format(F.col("tag"))).select("id", "f.message", F.col("f.pass").alias("passed"))


@query(f"""{C} SELECT id, length(trim(tag)) < 3 OR regexp_matches(trim(tag), {_q(rules.DRAWING_REFERENCES)}) OR regexp_matches(trim(tag), {_q(rules.BARE_LABELS)}) AS false_positive,
regexp_matches(trim(tag), {_q(rules.LINE_NUMBER)}) AS line_number, regexp_matches(upper(trim(tag)), {_q(rules.EQUIPMENT_TAG)}) AS equipment FROM cand""")
def tag_predicates(spark, d):
    c = F.col("tag")
    return candidates(spark, d).select("id", t.is_false_positive(c).alias("false_positive"), t.is_line_number(c).alias("line_number"), t.is_equipment_tag(c).alias("equipment"))


_PREFIX = "regexp_replace(regexp_extract(canonical_tag, '^([A-Z-]{1,8})', 1), '^-+|-+$', '', 'g')"
_CODES = f"[split_part({_PREFIX}, '-', -1), split_part({_PREFIX}, '-', 1), {_PREFIX}]"
_DISC = "CASE " + " ".join(f"WHEN list_has_any({_CODES}, [{', '.join(_q(n) for n in names)}]) THEN {_q(out)}" for names, out in rules.DISCIPLINES)


@query(f"""{CANON} SELECT id, {_DISC} WHEN category = 'instrument' THEN 'INSTRUMENTATION' WHEN category IN ('valve', 'equipment') THEN 'MECHANICAL' WHEN category = 'piping' THEN 'PIPING'
WHEN regexp_matches(canonical_tag, '^[0-9]+["\\-]') THEN 'PIPING' ELSE 'MECHANICAL' END AS discipline FROM canon""")
def discipline(spark, d):
    return t.canonical_tag(candidates(spark, d), "tag").select("id", t.discipline(F.col("canonical_tag"), F.col("category")).alias("discipline"))


_ONTO = sql_case("symbol_name", rules.ONTOLOGY)
_ONTO2 = sql_case("symbol_name", rules.ONTOLOGY, 2)


@query(f"""{CANON} SELECT id, upper(coalesce({_ONTO}, symbol_name)) AS equipment_description,
upper(coalesce({_ONTO2} || ',' || split_part(canonical_tag, '-', -1), canonical_tag)) AS tag_description FROM canon""")
def descriptions(spark, d):
    df = t.canonical_tag(candidates(spark, d), "tag")
    none = F.lit(None).cast("string")
    return df.withColumn("x", t.descriptions(F.col("symbol_name"), F.col("canonical_tag"), none, none, none)).select("id", "x.equipment_description", "x.tag_description")


@query("SELECT p_partkey AS id, n_nationkey AS nation, upper(substr(sha256(concat_ws('|', p_brand, p_name, n_name)), 1, 12)) AS canonical_id FROM part JOIN nation ON p_partkey % 25 = n_nationkey")
def canonical_id(spark, d):
    j = table(spark, d, "part").join(F.broadcast(table(spark, d, "nation")), F.col("p_partkey") % 25 == F.col("n_nationkey"))
    return j.select(F.col("p_partkey").alias("id"), F.col("n_nationkey").alias("nation"), t.canonical_id(F.col("p_brand"), F.col("p_name"), F.col("n_name")).alias("canonical_id"))


_STATUS = "CASE x " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in rules.DOC_STATUS.items()) + " WHEN '' THEN 'ACTIVE' ELSE 'REVISION ' || x END"


@query(f"WITH a AS (SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN 'C' WHEN 1 THEN 'IFC' WHEN 2 THEN '' WHEN 3 THEN 'Z9' ELSE o_orderstatus END AS x, o_orderpriority AS p FROM orders) SELECT id, CASE WHEN id % 7 = 0 THEN upper(trim(p)) ELSE {_STATUS} END AS status FROM a")
def doc_status(spark, d):
    k = F.col("o_orderkey")
    rev = F.when(k % 5 == 0, "C").when(k % 5 == 1, "IFC").when(k % 5 == 2, "").when(k % 5 == 3, "Z9").otherwise(F.col("o_orderstatus"))
    return table(spark, d, "orders").select(k.alias("id"), t.doc_status(rev, F.when(k % 7 == 0, F.col("o_orderpriority"))).alias("status"))


def _scored(df: DataFrame) -> DataFrame:
    c = s.confidence(F.col("det"), F.col("ocr"), F.col("geo"), F.col("val"), F.col("reg"), F.col("isolated"))
    status = F.when(F.col("id") % 11 == 0, "FAIL").otherwise("WARN")
    r = s.review(F.col("tag"), status, F.lit(""), F.lit("NO"), F.col("in_registry"), F.lit("IN_SCOPE"), F.col("c"))
    df = df.withColumn("c", c).withColumn("route", s.route(F.col("tag"), F.col("c.c_final"))).withColumn("r", F.when(F.col("route") == "HUMAN_REVIEW", r))
    return df.select("id", "drawing_id", "c.c_final", "route", "r.priority", F.col("r.reason").alias("reason"))


SCORED = f"""{C}, e AS (SELECT *, CASE WHEN val = 0 THEN 0.5 ELSE val END AS v2, CASE WHEN isolated THEN round(geo * 0.5, 3) ELSE geo END AS g2,
CASE WHEN ocr > 0 THEN ocr ELSE round(0.9 * det, 3) END AS o2 FROM cand),
f AS (SELECT *, round(least(1.0, greatest(0.0, 0.30 * det + 0.30 * o2 + 0.15 * g2 + 0.20 * v2 + 0.05 * reg)), 4) AS c_final FROM e),
h AS (SELECT *, CASE WHEN trim(tag) IN ('', 'UNKNOWN') THEN 'HUMAN_REVIEW' WHEN c_final >= 0.80 THEN 'AUTO_ACCEPT' WHEN c_final >= 0.55 THEN 'HUMAN_REVIEW' ELSE 'AUTO_REJECT' END AS route FROM f),
routed AS (SELECT id, drawing_id, c_final, route, CASE WHEN route = 'HUMAN_REVIEW' THEN CASE WHEN trim(tag) IN ('', 'UNKNOWN') THEN 'MISSING_TAG' WHEN id % 11 = 0 THEN 'VALIDATION_FAIL'
WHEN o2 < 0.75 THEN 'LOW_TEXT_CONF' WHEN isolated THEN 'ISOLATED_DETECTION' WHEN NOT in_registry THEN 'NOT_IN_REGISTER' WHEN round(v2, 3) < 0.8 THEN 'VALIDATION_WARN' ELSE 'CONFIDENCE_BORDERLINE' END END AS reason FROM h),
ranked AS (SELECT *, CASE WHEN reason IN ('MISSING_TAG', 'VALIDATION_FAIL') THEN 1 WHEN reason = 'LOW_TEXT_CONF' THEN 2 WHEN reason IN ('ISOLATED_DETECTION', 'NOT_IN_REGISTER') THEN 3 WHEN reason IS NOT NULL THEN 4 END AS priority FROM routed)"""


@query(f"{SCORED} SELECT id, drawing_id, c_final, route, priority, reason FROM ranked")
def confidence_route(spark, d):
    return _scored(candidates(spark, d))


@query(f"""{SCORED} SELECT drawing_id, count(*) AS total, count(*) FILTER (route = 'AUTO_ACCEPT') AS accepted, count(*) FILTER (route = 'HUMAN_REVIEW') AS review, count(*) FILTER (route = 'AUTO_REJECT') AS rejected,
round(100.0 * count(*) FILTER (route = 'AUTO_ACCEPT') / count(*), 1) AS accept_rate, round(100.0 * count(*) FILTER (route = 'HUMAN_REVIEW') / count(*), 1) AS review_rate,
count(*) FILTER (priority = 1) AS p1, count(*) FILTER (priority = 2) AS p2, count(*) FILTER (priority = 3) AS p3, count(*) FILTER (priority = 4) AS p4,
round(avg(c_final) FILTER (route <> 'AUTO_REJECT'), 6) AS avg_confidence, min(c_final) FILTER (route <> 'AUTO_REJECT') AS min_confidence, max(c_final) FILTER (route <> 'AUTO_REJECT') AS max_confidence
FROM ranked GROUP BY drawing_id""")
def routing_summary(spark, d):
    return shaping.routing_summary(_scored(candidates(spark, d)), ["drawing_id"])


@query(f"{C} SELECT id, round(0.25 * det + 0.30 * ocr + 0.15 * geo + 0.20 * val + 0.10 * reg, 3) AS c, CASE WHEN round(0.25 * det + 0.30 * ocr + 0.15 * geo + 0.20 * val + 0.10 * reg, 3) >= 0.85 THEN 'AUTO_ACCEPT' WHEN round(0.25 * det + 0.30 * ocr + 0.15 * geo + 0.20 * val + 0.10 * reg, 3) >= 0.60 THEN 'REVIEW_REQUIRED' ELSE 'AUTO_REJECT' END AS route FROM cand")
def legacy_profile(spark, d):
    df = candidates(spark, d).withColumn("c", s.legacy_confidence(*[F.col(x) for x in ("det", "ocr", "geo", "val", "reg")]))
    return df.select("id", "c", s.legacy_route(F.col("c")).alias("route"))


_REG = "SELECT upper(trim(tag)) AS reg_tag, min(ord) AS reg_ord FROM cand WHERE drawing_id < 8 AND upper(trim(tag)) <> '' GROUP BY 1"


@query(f"""{C}, reg AS ({_REG}), rk AS (SELECT reg_tag, reg_ord, {sql_key('reg_tag', DEDUP_KEY)} AS rn FROM reg), k AS (SELECT id, upper(trim(tag)) AS u, {sql_key('upper(trim(tag))', DEDUP_KEY)} AS rn FROM cand),
ex AS (SELECT k.id, k.u, k.rn, reg.reg_tag AS e FROM k LEFT JOIN reg ON k.u = reg.reg_tag),
nm AS (SELECT ex.id, arg_min(rk.reg_tag, rk.reg_ord) AS m FROM ex JOIN rk ON ex.e IS NULL AND (ex.rn = rk.rn OR regexp_replace(ex.rn, '^[A-Z]', '') = regexp_replace(rk.rn, '^[A-Z]', '')) GROUP BY ex.id)
SELECT ex.id, CASE WHEN e IS NOT NULL THEN 'exact' WHEN m IS NOT NULL THEN 'normalised' ELSE 'none' END AS match, coalesce(e, m) AS matched_key FROM ex LEFT JOIN nm ON ex.id = nm.id""")
def registry_join(spark, d):
    c = candidates(spark, d)
    reg = lookup.load_registry(c.where("drawing_id < 8").select("tag", "ord"))
    return lookup.registry_join(c, reg).select("id", "match", "matched_key")


_SCOPE = "SELECT * FROM (VALUES (0, 'BALL VALVE', 'ALLOW'), (1, 'FLOW TRANSMITTER', 'BLOCK'), (2, 'PRESSURE TRANSMITTER', 'ALLOW'), (3, 'GAS COMPRESSOR', 'BLOCK'), (4, 'SAFETY RELIEF VALVE', 'ALLOW'), (5, 'LIMIT SWITCH OPEN', 'ALLOW'), (6, 'BALL VALVE', 'BLOCK')) v(ord, name, status)"


@query(f"{C}, sc AS ({_SCOPE}), one AS (SELECT name, max(CASE WHEN status = 'BLOCK' THEN 1 ELSE 0 END) AS b FROM sc GROUP BY name) SELECT id, CASE WHEN b = 1 THEN 'OUT_OF_SCOPE' WHEN b = 0 THEN 'IN_SCOPE' ELSE 'UNSPECIFIED' END AS sow_status FROM cand LEFT JOIN one ON upper(trim(symbol_name)) = one.name")
def scope_exact(spark, d):
    return lookup.scope_exact(candidates(spark, d), spark.sql(_SCOPE.replace("v(ord", "AS v(ord"))).select("id", "sow_status")


@query(f"""{C}, sc AS ({_SCOPE}), a AS (SELECT DISTINCT symbol_name AS name, list_distinct(regexp_split_to_array(upper(trim(symbol_name)), '\\s+')) AS w FROM cand),
h AS (SELECT a.name, sc.name AS best, sc.status, sc.ord, round(len(list_intersect(a.w, string_split(sc.name, ' '))) / greatest(len(a.w), len(string_split(sc.name, ' '))), 6) AS score FROM a, sc)
SELECT name, arg_max(best, (score, -ord)) AS best, max(score) AS score, arg_max(status, (score, -ord)) AS status FROM h WHERE score >= 0.6 GROUP BY name""")
def scope_fuzzy(spark, d):
    return lookup.scope_fuzzy(candidates(spark, d), spark.sql(_SCOPE.replace("v(ord", "AS v(ord")))


@query(f"""{C}, k AS (SELECT id, upper(trim(tag)) AS tg, upper(symbol_name) AS nm, category, {_FOLDED} AS x, {sql_case(_FOLDED, rules.TAG_FORMATS)} AS name FROM cand),
f AS (SELECT *, x <> '' AND (name IS NOT NULL OR regexp_matches(x, {_q(rules.BASIC_FORMAT)})) AS ok, nm LIKE '%TRANSMITTER%' AND NOT regexp_matches(tg, '[A-Z]T-[0-9]|[A-Z]IT-[0-9]') AS b2,
(nm LIKE '%RELIEF%' OR nm LIKE '%SAFETY%') AND NOT regexp_matches(tg, '[A-Z]-?[RP][SV]V?-?[0-9]') AS b3 FROM k)
SELECT id, CASE WHEN NOT ok OR b2 OR b3 THEN 'FAIL' WHEN id % 3 = 0 THEN 'WARN' ELSE 'PASS' END AS status, CASE WHEN NOT ok OR b2 OR b3 THEN array_to_string(list_filter([CASE WHEN NOT ok THEN CASE WHEN x = '' THEN 'Empty or null tag text' ELSE 'Does not match ISA-5.1 format: ''' || x || '''' END END,
CASE WHEN b2 THEN 'Transmitter tag missing T/IT: ' || tg END, CASE WHEN b3 THEN 'Relief valve missing RV/PSV: ' || tg END], lambda y: y IS NOT NULL), ' | ') WHEN id % 3 = 0 THEN 'Tag not found' ELSE 'All validation checks passed' END AS reason FROM f""")
def validation_rollup(spark, d):
    reg = F.struct(F.when(F.col("id") % 3 != 0, True).alias("pass"), F.lit("REGISTRY").alias("rule"), F.lit("Tag not found").alias("message"))
    checks = F.concat(F.array(t.tag_format(F.col("tag"))), shaping.business_checks(F.col("tag"), F.col("symbol_name"), F.col("category")), F.array(reg))
    return candidates(spark, d).withColumn("r", shaping.roll_up(checks)).select("id", "r.status", "r.reason")


@query("""WITH u AS (SELECT o_orderkey, unnest(['status', 'priority', 'clerk']) AS column_header, unnest([o_orderstatus, o_orderpriority, 'CLK-' || CAST(o_custkey AS VARCHAR)]) AS tag_number FROM orders)
SELECT * FROM u WHERE trim(tag_number) NOT IN ('', '-') AND length(trim(tag_number)) >= 3""")
def master_tags_unpivot(spark, d):
    cells = F.create_map(F.lit("status"), F.col("o_orderstatus"), F.lit("priority"), F.col("o_orderpriority"), F.lit("clerk"), F.concat(F.lit("CLK-"), F.col("o_custkey").cast("string")))
    return shaping.unpivot_cells(table(spark, d, "orders").select("o_orderkey", cells.alias("cells")))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n = 1")
def best_per_key(spark, d):
    return shaping.best_per_key(table(spark, d, "orders"), ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey, l_linenumber) > 1 THEN 'DUPLICATE' ELSE 'FIRST' END AS dup FROM lineitem")
def dup_marking(spark, d):
    return shaping.mark_repeats(table(spark, d, "lineitem"), ["l_partkey", "l_suppkey"], ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "dup")


_K = sql_key("tag", EVAL_KEY)


@query(f"""{C}, a AS (SELECT DISTINCT tag, {_K} AS k FROM cand WHERE drawing_id < 20), b AS (SELECT tag AS hit, {_K} AS k, ord FROM cand WHERE drawing_id >= 20),
h AS (SELECT a.tag, b.hit, CASE WHEN a.k = b.k THEN 0 ELSE 1 END AS far, b.ord FROM a JOIN b ON a.k <> '' AND b.k <> '' AND (a.k = b.k OR (abs(length(a.k) - length(b.k)) <= 2 AND (contains(a.k, b.k) OR contains(b.k, a.k)))))
SELECT a.tag, arg_min(h.hit, (far, ord)) AS hit FROM a LEFT JOIN h ON a.tag = h.tag GROUP BY a.tag""")
def recall_report(spark, d):
    c = candidates(spark, d)
    return lookup.recall(c.where("drawing_id < 20").select("tag").distinct(), c.where("drawing_id >= 20"))


@query(f"{C} SELECT id FROM cand WHERE drawing_id < 20 AND {_K} NOT IN (SELECT {_K} FROM cand WHERE drawing_id >= 20)")
def critical_miss(spark, d):
    c = candidates(spark, d)
    return lookup.missing(c.where("drawing_id < 20"), c.where("drawing_id >= 20")).select("id")


@query(f"{C} SELECT id FROM cand WHERE drawing_id < 20 AND {_K} IN (SELECT {_K} FROM cand WHERE drawing_id >= 20)")
def agreed(spark, d):
    c = candidates(spark, d)
    return lookup.agreed(c.where("drawing_id < 20"), c.where("drawing_id >= 20")).select("id")


@query(f"""{C}, a AS (SELECT DISTINCT tag, {_K} AS k FROM cand WHERE drawing_id < 20 AND {_K} <> ''), b AS (SELECT DISTINCT tag AS reg, {_K} AS rk FROM cand WHERE drawing_id >= 20),
h AS (SELECT a.tag, b.reg, length(rk) - length(k) AS lead, length(rk) AS n FROM a JOIN b ON suffix(rk, k) AND length(rk) - length(k) BETWEEN 0 AND 3 AND (rk = k OR NOT regexp_matches(left(rk, length(rk) - length(k)), '^[0-9]+$'))),
m AS (SELECT tag, min(lead) AS l, count(DISTINCT reg) AS c, arg_min(reg, (lead, n, reg)) AS match FROM h GROUP BY tag)
SELECT a.tag, CASE WHEN c IS NULL THEN 'NOT_IN_REGISTER' WHEN l = 0 OR c = 1 THEN 'OK' ELSE 'SUSPICIOUS' END AS status, match FROM a LEFT JOIN m ON a.tag = m.tag""")
def register_match(spark, d):
    c = candidates(spark, d)
    return lookup.register_match(c.where("drawing_id < 20"), c.where("drawing_id >= 20"))


_I = "greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0) * greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0)"
_IOU = f"CAST({_I} AS DOUBLE) / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - {_I})"
_D = "sqrt(((a.x1 + a.x2) / 2.0 - (b.x1 + b.x2) / 2.0) ** 2 + ((a.y1 + a.y2) / 2.0 - (b.y1 + b.y2) / 2.0) ** 2)"


@query(f"{B} SELECT a.drawing_id, a.id AS a, b.id AS b, round({_IOU}, 6) AS iou FROM boxes a JOIN boxes b ON a.drawing_id = b.drawing_id AND a.id < b.id AND a.x1 < b.x2 AND a.x2 > b.x1 AND a.y1 < b.y2 AND a.y2 > b.y1 AND {_IOU} >= 0.15")
def bbox_iou_pairs(spark, d):
    return spatial.pairs_by_iou(boxes(spark, d), 0.15)


def _pd(px: str, py: str) -> str:
    n = "((s.sx1 - s.sx0) * (s.sx1 - s.sx0) + (s.sy1 - s.sy0) * (s.sy1 - s.sy0))"
    tt = f"greatest(0.0, least(1.0, CASE WHEN {n} = 0 THEN 0.0 ELSE (({px} - s.sx0) * (s.sx1 - s.sx0) + ({py} - s.sy0) * (s.sy1 - s.sy0)) / {n} END))"
    return f"sqrt(({px} - (s.sx0 + {tt} * (s.sx1 - s.sx0))) ** 2 + ({py} - (s.sy0 + {tt} * (s.sy1 - s.sy0))) ** 2)"


_CX, _CY = "(a.x1 + a.x2) / 2.0", "(a.y1 + a.y2) / 2.0"


@query(f"{S}, p AS (SELECT a.drawing_id, a.id, s.id AS segment, s.ord, {_pd(_CX, _CY)} AS d FROM boxes a JOIN seg s ON a.drawing_id = s.drawing_id) SELECT drawing_id, id, arg_min(segment, (round(d, 6), ord)) AS segment, round(min(round(d, 6)), 3) AS distance FROM p WHERE d < 120 GROUP BY drawing_id, id")
def nearest_segment(spark, d):
    def dist(l, r):
        cx, cy = g.center(l["box"])
        return F.round(g.point_segment_distance(cx, cy, r["seg"]), 6)

    near = spatial.nearest(boxes(spark, d), segments(spark, d), 120, dist)
    return near.select("drawing_id", "id", F.col("nearest.id").alias("segment"), F.round("distance", 3).alias("distance"))


@query(f"{B} SELECT a.drawing_id, a.id, arg_min(b.id, ((b.x2 - b.x1) * (b.y2 - b.y1), b.ord)) AS holder FROM boxes a JOIN boxes b ON a.drawing_id = b.drawing_id AND a.id <> b.id AND (b.x2 - b.x1) * (b.y2 - b.y1) > 3000 AND a.x1 >= b.x1 AND a.y1 >= b.y1 AND a.x2 <= b.x2 AND a.y2 <= b.y2 GROUP BY a.drawing_id, a.id")
def containment_smallest(spark, d):
    b = boxes(spark, d)
    return spatial.smallest_container(b, b.where(g.area(F.col("box")) > 3000))


@query(f"{B} SELECT * FROM (SELECT a.drawing_id, a.id, b.id AS other, round({_D}, 3) AS distance, row_number() OVER (PARTITION BY a.drawing_id, a.id ORDER BY b.ord) AS rank FROM boxes a JOIN boxes b ON a.drawing_id = b.drawing_id AND a.id <> b.id AND {_D} <= 200) WHERE rank <= 5")
def neighbours_topk(spark, d):
    return spatial.neighbours(boxes(spark, d), 200)


_DX, _DY = "((b.x1 + b.x2) - (a.x1 + a.x2))", "((b.y1 + b.y2) - (a.y1 + a.y2))"


@query(f"""{B}, p AS (SELECT a.drawing_id, a.id, b.id AS other, {_D} AS d, CASE WHEN a.x1 < b.x2 AND a.x2 > b.x1 AND a.y1 < b.y2 AND a.y2 > b.y1 THEN 'overlaps' WHEN abs({_DX}) >= abs({_DY}) THEN CASE WHEN {_DX} >= 0 THEN 'right_of' ELSE 'left_of' END WHEN {_DY} >= 0 THEN 'below' ELSE 'above' END AS direction
FROM boxes a JOIN boxes b ON a.drawing_id = b.drawing_id AND a.id <> b.id AND {_D} <= 700) SELECT drawing_id, id, direction, other, rank FROM (SELECT *, row_number() OVER (PARTITION BY drawing_id, id, direction ORDER BY round(d, 9), other) AS rank FROM p) WHERE rank <= 5""")
def direction_relations(spark, d):
    return spatial.directions(boxes(spark, d))


@query(f"{B} SELECT a.drawing_id, a.id, count(*) - 1 AS near FROM boxes a JOIN boxes b ON a.drawing_id = b.drawing_id AND abs(a.y1 - b.y1) < 15 GROUP BY a.drawing_id, a.id")
def grid_density(spark, d):
    return spatial.band_density(boxes(spark, d).withColumn("y", F.col("box.y1")), "y").select("drawing_id", "id", "near")


@query(f"""{B}, e AS (SELECT a.drawing_id, a.id AS a, b.id AS b FROM boxes a JOIN boxes b ON a.drawing_id = b.drawing_id AND a.id <> b.id AND a.x1 < b.x2 AND a.x2 > b.x1 AND a.y1 < b.y2 AND a.y2 > b.y1 AND {_IOU} >= 0.15),
r AS (SELECT drawing_id, id AS node, id AS root FROM boxes UNION SELECT r.drawing_id, e.b, r.root FROM r JOIN e ON r.drawing_id = e.drawing_id AND r.node = e.a) SELECT drawing_id, node AS id, min(root) AS root FROM r GROUP BY drawing_id, node""")
def duplicate_components(spark, d):
    b = boxes(spark, d)
    return graph.component_of(b.select("drawing_id", "id"), spatial.pairs_by_iou(b, 0.15), "id").select("drawing_id", "id", "root")


@query(f"""{B}, e AS (SELECT a.drawing_id, a.id AS a, b.id AS b FROM boxes a JOIN boxes b ON a.drawing_id = b.drawing_id AND a.id <> b.id AND a.tag = b.tag AND {_D} <= 300),
r AS (SELECT drawing_id, id AS node, id AS root FROM boxes UNION SELECT r.drawing_id, e.b, r.root FROM r JOIN e ON r.drawing_id = e.drawing_id AND r.node = e.a),
m AS (SELECT drawing_id, node, min(root) AS root FROM r GROUP BY 1, 2) SELECT m.drawing_id, m.root, arg_max(b.id, (b.conf, (b.x2 - b.x1) * (b.y2 - b.y1), -b.id)) AS id, min(b.tag) AS tag, count(*) AS members, min(b.x1) AS x1, min(b.y1) AS y1, max(b.x2) AS x2, max(b.y2) AS y2
FROM m JOIN boxes b ON m.drawing_id = b.drawing_id AND m.node = b.id GROUP BY m.drawing_id, m.root""")
def entity_collapse(spark, d):
    e = dedup.collapse_entities(boxes(spark, d).withColumn("category", F.lit("x")), 300)
    return e.select("drawing_id", "root", "id", "tag", "members", "box.x1", "box.y1", "box.x2", "box.y2")


@query()
def greedy_keep(spark, d):
    return dedup.nms(boxes(spark, d).withColumnRenamed("tag", "label"), 0.15, 60).select("drawing_id", "id")


@query(f"""{B}, e AS (SELECT a.drawing_id, a.id AS a, b.id AS b FROM boxes a JOIN boxes b ON a.drawing_id = b.drawing_id AND a.id <> b.id AND a.tag = b.tag AND ({_D} <= 120 OR {_IOU} >= 0.2)),
r AS (SELECT drawing_id, id AS node, id AS root FROM boxes UNION SELECT r.drawing_id, e.b, r.root FROM r JOIN e ON r.drawing_id = e.drawing_id AND r.node = e.a),
m AS (SELECT drawing_id, node AS id, min(root) AS root FROM r GROUP BY 1, 2), p AS (SELECT m.drawing_id, m.root, count(*) AS n, arg_max(b.id, (round(CASE WHEN b.id % 2 = 0 THEN 1.0 ELSE 0.0 END + 0.4 * b.conf + 0.15 + 0.1 + 0.1, 9), -b.id)) AS first FROM m JOIN boxes b ON m.drawing_id = b.drawing_id AND m.id = b.id GROUP BY 1, 2)
SELECT m.drawing_id, m.id, m.root, CASE WHEN m.id = p.first THEN 'PRIMARY' ELSE 'DISCARDED' END AS duplicate_status, CASE WHEN m.id <> p.first THEN p.first END AS merged_into, p.n AS merged_count FROM m JOIN p ON m.drawing_id = p.drawing_id AND m.root = p.root""")
def resolve_duplicates(spark, d):
    b = boxes(spark, d).withColumn("in_registry", F.col("id") % 2 == 0).withColumn("ocr", F.lit(0.5)).withColumn("assoc", F.lit(0.5)).withColumn("status", F.lit("PASS"))
    return dedup.resolve_duplicates(b).select("drawing_id", "id", "root", "duplicate_status", "merged_into", "merged_count")


@query()
def tile_duplicates(spark, d):
    return dedup.tile_duplicates(boxes(spark, d)).select("drawing_id", "id")


@query()
def line_stitch(spark, d):
    b = boxes(spark, d).withColumn("tag", F.concat(F.lit("2IN-GV-V"), F.substring(F.col("id").cast("string"), -3, 3), F.lit("-1150")))
    return dedup.stitch(b)


@query()
def greedy_clusters(spark, d):
    b = boxes(spark, d)
    a = dedup.leader_clusters(b, 800).withColumnRenamed("cluster", "leader")
    return a.join(dedup.running_clusters(b, 800).withColumnRenamed("cluster", "running"), ["drawing_id", "id"])


def _tree(spark, d):
    """(drawing_id, a, b): a nation's region, then the nation, its customers and suppliers, and the customers' orders; a drawing for each nation."""
    def edges(name: str, drawing: str, up: tuple[str, str], down: tuple[str, str], frame=None):
        return (frame if frame is not None else table(spark, d, name)).select(F.col(drawing).cast("int").alias("drawing_id"), F.concat(F.lit(up[0]), F.col(up[1])).alias("a"), F.concat(F.lit(down[0]), F.col(down[1])).alias("b"))

    n = edges("nation", "n_nationkey", ("R", "n_regionkey"), ("N", "n_nationkey"))
    c = edges("customer", "c_nationkey", ("N", "c_nationkey"), ("C", "c_custkey"))
    su = edges("supplier", "s_nationkey", ("N", "s_nationkey"), ("S", "s_suppkey"))
    own = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return n.unionAll(c).unionAll(su).unionAll(edges("orders", "c_nationkey", ("C", "o_custkey"), ("O", "o_orderkey"), own))


_E = """e AS (SELECT n_nationkey AS drawing_id, 'R' || CAST(n_regionkey AS VARCHAR) AS a, 'N' || CAST(n_nationkey AS VARCHAR) AS b FROM nation UNION ALL SELECT c_nationkey, 'N' || CAST(c_nationkey AS VARCHAR), 'C' || CAST(c_custkey AS VARCHAR) FROM customer
UNION ALL SELECT s_nationkey, 'N' || CAST(s_nationkey AS VARCHAR), 'S' || CAST(s_suppkey AS VARCHAR) FROM supplier UNION ALL SELECT c_nationkey, 'C' || CAST(o_custkey AS VARCHAR), 'O' || CAST(o_orderkey AS VARCHAR) FROM orders JOIN customer ON o_custkey = c_custkey)"""
TREE = f"WITH RECURSIVE {_E}"


def _regions(spark, d):
    return table(spark, d, "nation").select(F.col("n_nationkey").cast("int").alias("drawing_id"), F.concat(F.lit("R"), F.col("n_regionkey")).alias("node"))


@query(f"{TREE}, r AS (SELECT n_nationkey AS drawing_id, 'R' || CAST(n_regionkey AS VARCHAR) AS node, CAST(NULL AS VARCHAR) AS parent, 0 AS depth FROM nation UNION ALL SELECT e.drawing_id, e.b, e.a, r.depth + 1 FROM r JOIN e ON e.a = r.node AND e.drawing_id = r.drawing_id) SELECT drawing_id, node, parent, depth FROM r")
def bfs_tree(spark, d):
    return graph.bfs_tree(_tree(spark, d), _regions(spark, d)).select("drawing_id", "node", "parent", "depth")


@query(f"{TREE}, r AS (SELECT drawing_id, b AS node, [a] AS chain, a AS last FROM e UNION ALL SELECT r.drawing_id, r.node, list_append(r.chain, e.a), e.a FROM r JOIN e ON e.b = r.last AND e.drawing_id = r.drawing_id) SELECT drawing_id, node, array_to_string(arg_max(chain, len(chain)), '>') AS chain, max(len(chain)) AS depth FROM r GROUP BY 1, 2 UNION ALL SELECT n_nationkey, 'R' || CAST(n_regionkey AS VARCHAR), '', 0 FROM nation")
def ancestor_path(spark, d):
    nodes = _tree(spark, d).select("drawing_id", F.col("b").alias("node"), F.col("a").alias("parent")).unionAll(_regions(spark, d).withColumn("parent", F.lit(None).cast("string")))
    return graph.ancestors(nodes).select("drawing_id", "node", F.array_join("chain", ">").alias("chain"), "depth")


def _signals(spark, d):
    """(drawing_id, a, b): each order with its parts; a hundred orders a drawing."""
    return table(spark, d, "lineitem").select(F.floor(F.col("l_orderkey") / 100).cast("long").alias("drawing_id"), F.concat(F.lit("O"), F.col("l_orderkey")).alias("a"), F.concat(F.lit("P"), F.col("l_partkey")).alias("b")).distinct()


def _signal_tag(node):
    n = F.substr(node, F.lit(2)).cast("long") % 4
    return F.when(node.startswith("O"), F.concat(F.lit("V-XV-"), F.substr(node, F.lit(2)))).otherwise(F.concat(F.element_at(F.array(F.lit("FIC-"), F.lit("V-FIT-"), F.lit("FE-"), F.lit("FY-")), (n + 1).cast("int")), F.substr(node, F.lit(2))))


_SG = "SELECT DISTINCT CAST(floor(l_orderkey / 100) AS BIGINT) AS drawing_id, 'O' || CAST(l_orderkey AS VARCHAR) AS a, 'P' || CAST(l_partkey AS VARCHAR) AS b FROM lineitem"
_LOOPS = f"""e0 AS ({_SG}), ee AS (SELECT drawing_id, a, b FROM e0 UNION ALL SELECT drawing_id, b, a FROM e0),
r AS (SELECT drawing_id, a AS node, a AS root FROM ee UNION SELECT r.drawing_id, ee.b, r.root FROM r JOIN ee ON r.drawing_id = ee.drawing_id AND r.node = ee.a),
m AS (SELECT drawing_id, node, min(root) AS root, CASE WHEN node LIKE 'P%' AND CAST(substr(node, 2) AS BIGINT) % 4 = 0 THEN 'FIC-' || substr(node, 2) END AS lead FROM r GROUP BY 1, 2),
z AS (SELECT drawing_id, root, count(*) AS size, array_to_string(list_sort(list(node)), ',') AS members, coalesce(array_to_string(list_sort(list(lead) FILTER (lead IS NOT NULL)), ','), '') AS controllers FROM m GROUP BY 1, 2),
k AS (SELECT *, CASE WHEN size > 15 THEN 'CLUSTER' ELSE 'CL' END AS kind FROM z), n AS (SELECT *, CAST(row_number() OVER (PARTITION BY drawing_id, kind ORDER BY size DESC, root) - 1 AS VARCHAR) AS no FROM k)"""


@query(f"WITH RECURSIVE {_LOOPS} SELECT drawing_id, kind || '-' || lpad(no, CAST(greatest(2, length(no)) AS INTEGER), '0') AS loop_id, size, members, controllers FROM n")
def control_loops(spark, d):
    e = _signals(spark, d)
    tags = e.select("drawing_id", F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("tag", _signal_tag(F.col("node")))
    return graph.control_loops(e, tags).select("drawing_id", "loop_id", "size", F.array_join("member_ids", ",").alias("members"), F.array_join("controllers", ",").alias("controllers"))


@query(f"""WITH RECURSIVE e0 AS ({_SG}), ee AS (SELECT drawing_id, a, b FROM e0 UNION ALL SELECT drawing_id, b, a FROM e0),
r AS (SELECT DISTINCT drawing_id, a AS node, CASE WHEN a LIKE '%7' THEN 'FORWARD' ELSE 'REVERSE' END AS value, 0 AS hops FROM e0 WHERE a LIKE '%7' OR a LIKE '%4'
UNION SELECT r.drawing_id, ee.b, r.value, r.hops + 1 FROM r JOIN ee ON r.drawing_id = ee.drawing_id AND r.node = ee.a WHERE r.hops < 30)
SELECT drawing_id, node, arg_min(value, (hops, value)) AS value, min(hops) AS hops FROM r GROUP BY 1, 2""")
def label_propagation(spark, d):
    e = _signals(spark, d)
    seeds = e.where(F.col("a").endswith("7") | F.col("a").endswith("4")).select("drawing_id", F.col("a").alias("node"), F.when(F.col("a").endswith("7"), "FORWARD").otherwise("REVERSE").alias("value")).distinct()
    return graph.propagate(seeds, e).select("drawing_id", "node", "value", "hops")


@query(f"{TREE}, r AS (SELECT drawing_id, b AS start, b AS node, 0 AS hops FROM e WHERE b LIKE 'N%' OR b LIKE 'C%' UNION ALL SELECT r.drawing_id, r.start, e.b, r.hops + 1 FROM r JOIN e ON e.a = r.node AND e.drawing_id = r.drawing_id) SELECT drawing_id, start, node, hops FROM r")
def reachability(spark, d):
    e = _tree(spark, d)
    starts = e.where("b LIKE 'N%' OR b LIKE 'C%'").select("drawing_id", F.col("b").alias("node"))
    return graph.reachable(e, starts).select("drawing_id", "start", "node", "hops")


def _nodes(spark, d):
    """The tree's nodes with tags (every tenth supplier shares one), kinds, parents (every fiftieth order has none), isolation and confidence."""
    e = _tree(spark, d)
    b, n = F.col("b"), F.substr(F.col("b"), F.lit(2)).cast("long")
    tag = F.when(b.startswith("S"), F.concat(F.lit("T"), (n % 10).cast("string"))).otherwise(b)
    kind = F.when(b.startswith("N"), "equipment").when(b.startswith("C"), "valve").when(b.startswith("S"), "piping").otherwise("instrument")
    lost = b.startswith("O") & (n % 50 == 0)
    return e.select("drawing_id", b.alias("node"), tag.alias("tag"), kind.alias("kind"), F.when(~lost & ~b.startswith("N"), F.col("a")).alias("parent"), (b.startswith("O") & (n % 40 == 0)).alias("is_isolated"), F.round((n % 100) / 100, 2).alias("confidence"))


_NODES = """nodes AS (SELECT drawing_id, b AS node, CASE WHEN b LIKE 'S%' THEN 'T' || CAST(CAST(substr(b, 2) AS BIGINT) % 10 AS VARCHAR) ELSE b END AS tag, CASE WHEN b LIKE 'N%' THEN 'equipment' WHEN b LIKE 'C%' THEN 'valve' WHEN b LIKE 'S%' THEN 'piping' ELSE 'instrument' END AS kind,
CASE WHEN b LIKE 'N%' OR (b LIKE 'O%' AND CAST(substr(b, 2) AS BIGINT) % 50 = 0) THEN NULL ELSE a END AS parent, b LIKE 'O%' AND CAST(substr(b, 2) AS BIGINT) % 40 = 0 AS iso, round(CAST(substr(b, 2) AS BIGINT) % 100 / 100, 2) AS conf FROM e)"""


def _edges(spark, d):
    """The tree's edges as graph edges, from the lower end; those of regions have an end that is no node."""
    b, n = F.col("b"), F.substr(F.col("b"), F.lit(2)).cast("long")
    rel = F.when(b.startswith("S"), "MOUNTED_ON").when(b.startswith("C"), "CONTAINED_WITHIN").when(n % 3 == 0, "MONITORS").when(n % 3 == 1, "ADJACENT_TO").otherwise("SIGNAL_TO")
    return _tree(spark, d).select("drawing_id", b.alias("a"), F.col("a").alias("b"), rel.alias("rel"), F.lit(0.5).alias("confidence"))


_EDGES = "edges AS (SELECT drawing_id, b AS a, a AS b, CASE WHEN b LIKE 'S%' THEN 'MOUNTED_ON' WHEN b LIKE 'C%' THEN 'CONTAINED_WITHIN' WHEN CAST(substr(b, 2) AS BIGINT) % 3 = 0 THEN 'MONITORS' WHEN CAST(substr(b, 2) AS BIGINT) % 3 = 1 THEN 'ADJACENT_TO' ELSE 'SIGNAL_TO' END AS rel FROM e)"


def _loops(spark, d):
    """A loop for each customer: it controls its orders, of which the even ones are transmitters."""
    e = _tree(spark, d).where("a LIKE 'C%'")
    lead = e.select("drawing_id", F.col("a").alias("loop_id"), F.col("a").alias("node")).distinct().withColumn("role", F.lit("controller"))
    rest = e.select("drawing_id", F.col("a").alias("loop_id"), F.col("b").alias("node"), F.when(F.substr(F.col("b"), F.lit(2)).cast("long") % 2 == 0, "transmitter").otherwise("valve").alias("role"))
    return lead.unionAll(rest).withColumn("tag", F.col("node"))


_RELS = f"""{_E}, {_NODES}, {_EDGES}, rels AS (SELECT drawing_id, parent, node AS child, 'part_of' AS rel, 'hierarchy_tree' AS source FROM nodes WHERE parent IS NOT NULL
UNION ALL SELECT g.drawing_id, g.b, g.a, 'support_function', g.rel FROM edges g WHERE g.rel = 'MOUNTED_ON' UNION ALL SELECT g.drawing_id, g.b, g.a, 'contains', g.rel FROM edges g WHERE g.rel = 'CONTAINED_WITHIN'
UNION ALL SELECT g.drawing_id, g.a, g.b, CASE g.rel WHEN 'MONITORS' THEN 'monitors' ELSE 'controls' END, g.rel FROM edges g WHERE g.rel IN ('MONITORS', 'SIGNAL_TO') AND g.b NOT LIKE 'R%'
UNION ALL SELECT drawing_id, a, b, CASE WHEN CAST(substr(b, 2) AS BIGINT) % 2 = 0 THEN 'monitors' ELSE 'controls' END, 'control_loop:' || a FROM e WHERE a LIKE 'C%')"""


@query(f"WITH {_RELS} SELECT drawing_id, parent, child, rel, source FROM rels")
def relationships(spark, d):
    return hierarchy.relationships(_nodes(spark, d), _edges(spark, d), _loops(spark, d)).select("drawing_id", "parent", "child", "rel", "source")


@query(f"""WITH {_RELS}, i AS (SELECT drawing_id, 'Multiple Parents' AS issue, 'HIGH' AS severity FROM rels WHERE rel IN ('part_of', 'contains') GROUP BY drawing_id, child HAVING count(DISTINCT parent) > 1
UNION ALL SELECT drawing_id, 'Missing Parent', 'MEDIUM' FROM nodes WHERE parent IS NULL AND kind <> 'equipment' UNION ALL SELECT drawing_id, 'Missing System', 'LOW' FROM nodes WHERE parent IS NULL AND kind <> 'equipment'
UNION ALL SELECT drawing_id, 'Disconnected Subgraph', 'MEDIUM' FROM nodes WHERE iso UNION ALL SELECT drawing_id, 'Duplicate Nodes', 'MEDIUM' FROM nodes GROUP BY drawing_id, upper(tag) HAVING count(*) > 1
UNION ALL SELECT drawing_id, 'Broken Relationship', 'HIGH' FROM edges WHERE b LIKE 'R%')
SELECT 'severity' AS kind, severity AS name, count(*) AS n FROM i GROUP BY severity UNION ALL SELECT 'issue', issue, count(*) FROM i GROUP BY issue UNION ALL SELECT 'total', 'TOTAL ISSUES', count(*) FROM i""")
def structural_issues(spark, d):
    nodes, edges = _nodes(spark, d), _edges(spark, d)
    return hierarchy.issue_summary(hierarchy.issues(nodes, edges, hierarchy.relationships(nodes, edges, _loops(spark, d))))


@query(f"""WITH {_RELS}, o AS (SELECT drawing_id, count(DISTINCT tag) AS n FROM nodes WHERE iso OR (parent IS NULL AND kind <> 'equipment') GROUP BY 1),
p AS (SELECT drawing_id, count(*) AS n, count(*) FILTER (kind = 'equipment') AS eq, count(*) FILTER (kind = 'instrument') AS ins, count(*) FILTER (kind = 'valve') AS va, count(*) FILTER (kind = 'piping') AS pi, count(*) FILTER (iso) AS iso,
max(CASE WHEN parent IS NULL THEN 0 WHEN node LIKE 'C%' OR node LIKE 'S%' THEN 1 ELSE 2 END) AS deep FROM nodes GROUP BY 1), g AS (SELECT drawing_id, count(*) AS n FROM edges GROUP BY 1), r AS (SELECT drawing_id, count(*) AS n FROM rels GROUP BY 1), l AS (SELECT drawing_id, count(DISTINCT a) AS n FROM e WHERE a LIKE 'C%' GROUP BY 1),
x AS (SELECT p.drawing_id, unnest(['Total Nodes (tagged)', 'Total Graph Nodes (incl. virtual)', 'Total Relationships (business)', 'Total Graph Edges', 'Equipment Count', 'Instrument Count', 'Valve Count', 'Piping Count', 'Control Loops', 'Cross Drawing Links', 'Orphan Nodes', 'Virtual Nodes (pipelines+junctions)', 'Hierarchy Depth (max)', 'Isolated Detections']) AS metric,
unnest([p.n, p.n + 1, coalesce(r.n, 0), coalesce(g.n, 0), eq, ins, va, pi, coalesce(l.n, 0), eq, coalesce(o.n, 0), 1, deep, iso]) AS value FROM p LEFT JOIN r USING (drawing_id) LEFT JOIN g USING (drawing_id) LEFT JOIN o USING (drawing_id) LEFT JOIN l USING (drawing_id)) SELECT drawing_id, metric, CAST(value AS BIGINT) AS value FROM x""")
def hier_stats(spark, d):
    nodes, edges, loops = _nodes(spark, d), _edges(spark, d), _loops(spark, d)
    whole = nodes.select("drawing_id", "node", "kind").unionAll(_regions(spark, d).withColumn("kind", F.lit("pipeline")))
    named = loops.select("drawing_id", "loop_id").distinct()
    found = hierarchy.statistics(nodes, edges, hierarchy.relationships(nodes, edges, loops), whole, named, nodes.where("kind = 'equipment'"))
    return found.select("drawing_id", "metric", "value")


@query()
def pipelines(spark, d):
    lines, _ = hierarchy.pipelines(segments(spark, d).withColumn("seg", F.struct(*[F.col("seg")[c].cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")])))
    return lines


@query("""WITH s AS (SELECT p_partkey AS drawing_id, 1000 + p_size * 20 AS w, 800 + p_size * 10 AS h FROM part),
x AS (SELECT drawing_id, w, h, unnest(range(0, CAST(greatest(0, ceil((w - 768) / 460.0)) AS BIGINT) + 1)) * 460 AS x1 FROM s),
y AS (SELECT drawing_id, w, h, x1, unnest(range(0, CAST(greatest(0, ceil((h - 768) / 460.0)) AS BIGINT) + 1)) * 460 AS y1 FROM x)
SELECT drawing_id, row_number() OVER (PARTITION BY drawing_id ORDER BY y1, x1) - 1 AS patch_id, x1, y1, least(x1 + 768, w) AS x2, least(y1 + 768, h) AS y2 FROM y""")
def tiles(spark, d):
    sheets = table(spark, d, "part").select(F.col("p_partkey").alias("drawing_id"), (1000 + F.col("p_size") * 20).alias("width_px"), (800 + F.col("p_size") * 10).alias("height_px"))
    return shaping.tiles(sheets).select("drawing_id", "patch_id", "box.x1", "box.y1", "box.x2", "box.y2")


@query("""WITH p AS (SELECT p_partkey AS id, left(p_name, (2 * length(p_name) + 2) // 3) AS a, right(p_name, (2 * length(p_name) + 2) // 3) AS b FROM part), n AS (SELECT id, a, b, list_max(list_filter(range(4, CAST(least(length(a), length(b)) AS BIGINT) + 1), lambda s: right(a, s) = left(b, s))) AS k FROM p)
SELECT id, CASE WHEN contains(a, b) THEN a WHEN contains(b, a) THEN b WHEN k IS NOT NULL THEN a || substr(b, CAST(k + 1 AS BIGINT)) END AS joined FROM n""")
def overlap_concat(spark, d):
    n = F.floor((2 * F.length("p_name") + 2) / 3).cast("int")
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.left("p_name", n).alias("a"), F.right("p_name", n).alias("b"))
    return p.select("id", t.overlap_concat(F.col("a"), F.col("b")).alias("joined"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_repair(spark, d):
    broken = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("Answer: "), F.translate(F.col("props"), '"', "'"), F.lit(" done"))).otherwise(F.col("props"))
    return table(spark, d, "events").select("event_id", F.get_json_object(t.lenient_json(broken), "$.k").cast("long").alias("k"))


@query("""WITH t AS (SELECT doc_id % 50 AS drawing_id, CASE WHEN quality = 1 THEN 'GOOD' ELSE 'BAD' END AS kind, string_agg('- rule ' || CAST(doc_id AS VARCHAR), chr(10) ORDER BY doc_id) AS body FROM labels GROUP BY 1, 2)
SELECT drawing_id, string_agg('[' || kind || ']' || chr(10) || body, chr(10) ORDER BY kind) AS block FROM t GROUP BY 1""")
def text_block(spark, d):
    notes = table(spark, d, "labels").select((F.col("doc_id") % 50).alias("drawing_id"), F.col("doc_id").cast("string").alias("id"), F.when(F.col("quality") == 1, "GOOD").otherwise("BAD").alias("semantic_type"), F.concat(F.lit("rule "), F.col("doc_id")).alias("rule"))
    return shaping.rules_block(notes)


@query("SELECT count(*) AS calls, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS tokens FROM (SELECT DISTINCT text FROM documents WHERE text NOT IN (SELECT text FROM documents WHERE doc_id % 2 = 0))")
def cache_worklist(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    cache = docs.where("doc_id % 2 = 0").select(F.sha2(F.concat_ws("\x1f", F.coalesce("text", F.lit(""))), 256).alias("key")).distinct().withColumn("answer", F.lit("yes"))
    _, work = lookup.worklist(docs, cache, ["text"])
    return lookup.cost_gate(work, F.length("text"), 0.0, 1.0).select("calls", "tokens")


@query(f"{C} SELECT category, count(*) AS n FROM cand GROUP BY category")
def category_counts(spark, d):
    return candidates(spark, d).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query("WITH k AS (SELECT row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey, l_linenumber) AS n FROM lineitem) SELECT round(CAST(count(*) FILTER (n > 1) AS DOUBLE) / count(*), 6) AS rate FROM k")
def dup_rate(spark, d):
    m = shaping.mark_repeats(table(spark, d, "lineitem"), ["l_partkey", "l_suppkey"], ["l_orderkey", "l_linenumber"])
    return m.agg(F.round(F.count_if(F.col("dup") == "DUPLICATE") / F.count(F.lit(1)), 6).alias("rate"))


@query(f"""{B} SELECT drawing_id, id, CASE WHEN (y1 + y2) / 2.0 < 400 THEN 'title_block_top' WHEN (y1 + y2) / 2.0 > 6500 THEN 'bottom_tables' WHEN (x1 + x2) / 2.0 < 800 THEN 'notes_left' WHEN (x1 + x2) / 2.0 > 9000 THEN 'ref_panel_right' ELSE 'main_drawing' END AS zone,
CASE WHEN x2 - x1 < 30 OR y2 - y1 < 30 THEN 'bbox too small' WHEN (x2 - x1) * (y2 - y1) < 5000 THEN 'equipment area too small' WHEN CAST(greatest(x2 - x1, y2 - y1) AS DOUBLE) / least(x2 - x1, y2 - y1) > 3.5 THEN 'equipment bbox too flat' ELSE 'ok' END AS gate FROM boxes""")
def zones_and_gates(spark, d):
    cx, cy = g.center(F.col("box"))
    return boxes(spark, d).select("drawing_id", "id", g.zone(cx, cy).alias("zone"), g.size_gate(F.col("box"), F.lit("equipment"))["reason"].alias("gate"))


@query(f"{S}, p AS (SELECT a.drawing_id, a.id AS equipment, s.id AS line, least({_pd(_CX, _CY)}, {_pd('a.x1', 'a.y1')}, {_pd('a.x2', 'a.y1')}, {_pd('a.x1', 'a.y2')}, {_pd('a.x2', 'a.y2')}) AS d FROM boxes a JOIN seg s ON a.drawing_id = s.drawing_id) SELECT drawing_id, equipment, line, round(min(d), 3) AS distance FROM p WHERE d <= 90 GROUP BY 1, 2, 3")
def hub_edges(spark, d):
    return spatial.hub_edges(boxes(spark, d), segments(spark, d).withColumn("line", F.col("id")))


@query(f"""{C}, n AS (SELECT drawing_id, tag, CASE WHEN id % 5 = 0 THEN 'see 4224-PID-6-' || CAST(id % 50 AS VARCHAR) || ', 42240-AB-1-2 and 4224-XX-0-00 or 4224-PI-1-7-3.' WHEN id % 5 = 1 THEN 'x4224-PID-6-1 9999-PID-6-1' ELSE symbol_name END AS context FROM cand),
x AS (SELECT drawing_id, tag, 'reference_in_tag' AS r, unnest(regexp_extract_all(tag, '\\b(\\d{{3,4}}-[A-Z]{{2,5}}-\\d+-\\d+(?:-\\d+)?)\\b', 1)) AS t FROM n UNION ALL SELECT drawing_id, tag, 'reference_in_context', unnest(regexp_extract_all(context, '\\b(\\d{{3,4}}-[A-Z]{{2,5}}-\\d+-\\d+(?:-\\d+)?)\\b', 1)) FROM n)
SELECT drawing_id, tag AS source_tag, t AS ref_drawing, r AS relationship FROM x WHERE starts_with(t, '4224') AND t <> '4224-XX-0-00'""")
def cross_refs(spark, d):
    """Tags of one kind in twelve are numbers of the own series, and contexts hold own, other and foreign numbers."""
    n = F.col("id")
    context = F.when(n % 5 == 0, F.concat(F.lit("see 4224-PID-6-"), n % 50, F.lit(", 42240-AB-1-2 and 4224-XX-0-00 or 4224-PI-1-7-3."))).when(n % 5 == 1, "x4224-PID-6-1 9999-PID-6-1").otherwise(F.col("symbol_name"))
    return hierarchy.cross_references(candidates(spark, d).withColumn("context", context), F.lit("4224-XX-0-00"))


@query(f"""{B}, m AS (SELECT id, drawing_id, drawing_id % 7 AS patch, tag FROM boxes), o AS (SELECT id AS ord, drawing_id, drawing_id % 7 AS patch, lower(tag) || CASE WHEN id % 2 = 0 THEN '' ELSE 'x' END AS text FROM boxes),
w AS (SELECT drawing_id, patch, upper(text) AS b, arg_min(text, ord) AS text, min(ord) AS ord FROM o GROUP BY 1, 2, 3), p AS (SELECT m.drawing_id, m.patch, m.id, w.text, w.ord, upper(m.tag) AS a, w.b FROM m JOIN w ON m.drawing_id = w.drawing_id AND m.patch = w.patch), s AS (SELECT *, CASE WHEN a = b THEN 1.0 ELSE len(list_filter(range(1, least(length(a), length(b)) + 1), lambda i: a[i] = b[i])) / greatest(length(a), length(b), 1) END AS score FROM p)
SELECT drawing_id, patch AS patch_id, id, arg_max(text, (CASE WHEN a = b THEN 1 ELSE 0 END, score, -ord)) AS ocr_text, round(max(score), 6) AS score FROM s WHERE a = b OR score >= 0.7 GROUP BY 1, 2, 3""")
def ocr_reconcile(spark, d):
    b = boxes(spark, d).withColumn("patch_id", F.col("drawing_id") % 7)
    words = b.select("drawing_id", "patch_id", F.col("id").alias("ord"), F.concat(F.lower("tag"), F.when(F.col("id") % 2 == 0, "").otherwise("x")).alias("text"))
    return lookup.reconcile(b.select("drawing_id", "patch_id", "id", F.col("tag").alias("tag_text")), words)


_BARE = "regexp_replace({}, '^[A-Z]+-', '')"


@query(f"""{C}, k AS (SELECT DISTINCT upper(tag) AS m FROM cand WHERE drawing_id >= 20 AND tag <> ''), a AS (SELECT DISTINCT tag, upper(tag) AS u FROM cand WHERE drawing_id < 20 AND tag <> ''),
h AS (SELECT a.tag, k.m, 0 AS r FROM a JOIN k ON a.u = k.m UNION ALL SELECT a.tag, k.m, 1 FROM a JOIN k ON {_BARE.format('a.u')} = {_BARE.format('k.m')} UNION ALL SELECT a.tag, k.m, 2 FROM a JOIN k ON length({_BARE.format('a.u')}) >= 3 AND suffix(k.m, {_BARE.format('a.u')}))
SELECT a.tag, arg_min(m, (r, m)) AS match FROM a LEFT JOIN h ON a.tag = h.tag GROUP BY a.tag""")
def tolerant_match(spark, d):
    c = candidates(spark, d).where("tag <> ''")
    return lookup.tolerant_match(c.where("drawing_id < 20"), c.where("drawing_id >= 20"))


@query(f"{C}, b AS (SELECT drawing_id, id, CASE WHEN floor(id / 40) % 2 = 0 THEN 'V-' ELSE '' END || 'X' || CAST(id % 7 AS VARCHAR) AS tag FROM cand) SELECT a.drawing_id, a.id, min(t.id) AS into_id FROM b a JOIN b t ON a.drawing_id = t.drawing_id AND t.tag = 'V-' || a.tag WHERE NOT starts_with(a.tag, 'V-') GROUP BY 1, 2")
def prefix_twins(spark, d):
    tag = F.concat(F.when(F.floor(F.col("id") / 40) % 2 == 0, "V-").otherwise(""), F.lit("X"), (F.col("id") % 7).cast("string"))
    return lookup.prefix_twins(candidates(spark, d).withColumn("tag", tag)).withColumnRenamed("into", "into_id")


@query("SELECT round(avg(CASE WHEN o_custkey IS NULL THEN 0 ELSE 1 END), 6) AS matched, avg(CASE WHEN o_custkey IS NULL THEN 0 ELSE 1 END) < 0.5 AS stale FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) o ON c_custkey = o_custkey")
def enrichment_staleness(spark, d):
    links = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return lookup.enrich(table(spark, d, "customer"), links, ["c_custkey"])[1]


@query(f"""{C}, x AS (SELECT *, regexp_replace(upper(tag), '^V*-*', '') AS u, upper(trim(tag)) AS n FROM cand) SELECT id, CASE WHEN u LIKE 'T%' THEN 'temperature' WHEN u LIKE 'PAHH%' OR u LIKE 'PIT%' OR u LIKE 'PI%' THEN 'pressure' WHEN u LIKE 'LIT%' OR u LIKE 'LI%' THEN 'level' WHEN u LIKE 'FIC%' OR u LIKE 'FIT%' OR u LIKE 'FI%' THEN 'flow' END AS family,
CASE WHEN n LIKE 'LT%' OR n LIKE 'GT%' OR n LIKE '%-LT-%' OR n LIKE '%-GT-%' THEN 'COUNT_ONLY' WHEN n LIKE 'LC%' OR n LIKE 'GC%' OR n LIKE '%-LC-%' OR n LIKE '%-GC-%' THEN 'FULL_EXTRACTION' WHEN id % 3 = 0 THEN 'COUNT_ONLY' ELSE 'FULL_EXTRACTION' END AS mode,
CASE WHEN id % 11 = 0 THEN 'CLOUD_ONLY' WHEN id % 5 IN (0, 1, 2) THEN 'FULL_DRAWING' ELSE 'CLOUD_PRIORITY' END AS scope, round(CASE WHEN isolated THEN 0.8 WHEN in_registry THEN 0.7 - least(det * 100 / 300, 0.3) ELSE 0.3 END, 3) AS assoc,
CASE WHEN isolated THEN 'CONTAINED_WITHIN' WHEN in_registry AND geo * 300 < 20 THEN 'ATTACHED_TO' WHEN det * 300 < 30 THEN 'CONNECTED_TO' WHEN det * 300 <= 150 OR (in_registry AND geo * 300 <= 150) THEN 'ADJACENT_TO' ELSE 'ISOLATED' END AS relation FROM x""")
def families_and_modes(spark, d):
    a = s.association_confidence(F.lit(None).cast("double"), F.when(F.col("in_registry") & ~F.col("isolated"), F.col("det") * 100), F.when(F.col("isolated"), F.lit(True)))
    title = F.when(F.col("id") % 3 == 0, "Unit X-LT-1").otherwise("GC plan")
    scope = s.revision_scope(F.when(F.col("id") % 11 == 0, "within clouded areas only"), F.element_at(F.array(*[F.lit(x) for x in ("0", "ifi", " REVA ", "", "B")]), (F.col("id") % 5 + 1).cast("int")))
    relation = s.spatial_relationship(F.col("isolated"), F.when(F.col("in_registry"), F.col("geo") * 300), F.col("det") * 300)
    return candidates(spark, d).select("id", t.instrument_family(F.col("tag")).alias("family"), s.project_mode(F.col("tag"), title).alias("mode"), scope.alias("scope"), a.alias("assoc"), relation.alias("relation"))


@query("""WITH a AS (SELECT o_orderkey AS row_label, o_orderstatus AS s, o_orderpriority AS p FROM orders) SELECT row_label, CASE WHEN row_label % 3 <> 0 THEN s END AS s, CASE WHEN row_label % 2 = 0 OR row_label % 3 = 0 THEN 'right' ELSE p END AS p FROM a""")
def merge_table_halves(spark, d):
    o = table(spark, d, "orders").withColumnRenamed("o_orderkey", "row_label")
    left = o.where("row_label % 3 <> 0").select("row_label", F.create_map(F.lit("s"), F.col("o_orderstatus"), F.lit("p"), F.col("o_orderpriority")).alias("cells"))
    right = o.where("row_label % 2 = 0 OR row_label % 3 = 0").select("row_label", F.create_map(F.lit("p"), F.lit("right")).alias("cells"))
    return shaping.merge_halves(left, right).select("row_label", F.col("cells")["s"].alias("s"), F.col("cells")["p"].alias("p"))


@query("""WITH RECURSIVE v AS (SELECT l_suppkey AS k, CAST(l_linenumber * 40 + l_partkey % 37 AS BIGINT) AS v FROM lineitem), f AS (SELECT k, min(v) AS v FROM v GROUP BY k), r AS (SELECT k, v FROM f UNION ALL SELECT r.k, (SELECT min(v.v) FROM v WHERE v.k = r.k AND v.v - r.v > 9) FROM r WHERE EXISTS (SELECT 1 FROM v WHERE v.k = r.k AND v.v - r.v > 9))
SELECT k, array_to_string(list_sort(list(v)), ',') AS kept FROM r GROUP BY k""")
def spaced_lines(spark, d):
    v = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), (F.col("l_linenumber") * 40 + F.col("l_partkey") % 37).cast("int").alias("v"))
    return v.groupBy("k").agg(F.array_join(shaping.spaced_values(F.collect_set("v"), 9), ",").alias("kept"))


@query(f"{S}, g AS (SELECT drawing_id, id % 5 AS pipeline, sqrt(CAST((sx1 - sx0) ** 2 + (sy1 - sy0) ** 2 AS DOUBLE)) AS l, * EXCLUDE (drawing_id) FROM seg) SELECT drawing_id, pipeline, count(*) AS segments, round(sum(l), 3) AS length, min(sx0) AS x1, min(sy0) AS y1, max(sx1) AS x2, max(sy1) AS y2 FROM g GROUP BY 1, 2")
def line_geometry(spark, d):
    g_ = segments(spark, d).withColumn("pipeline", F.col("id") % 5).withColumn("length", F.sqrt(F.pow(F.col("seg.x1") - F.col("seg.x0"), 2) + F.pow(F.col("seg.y1") - F.col("seg.y0"), 2)))
    return hierarchy.line_geometry(g_).select("drawing_id", "pipeline", "segments", "length", "box.x1", "box.y1", "box.x2", "box.y2")


@query(f"""{S}, e AS (SELECT drawing_id, id, id % 40 AS line, sx0 AS x, sy0 AS y FROM seg UNION ALL SELECT drawing_id, id, id % 40, sx1, sy1 FROM seg),
p AS (SELECT a.drawing_id, a.line AS p, b.line AS q, sqrt(CAST((a.x - b.x) ** 2 + (a.y - b.y) ** 2 AS DOUBLE)) AS d FROM e a JOIN e b ON a.drawing_id = b.drawing_id AND a.line < b.line) SELECT drawing_id, p, q, round(min(d), 3) AS distance FROM p WHERE d > 100 AND d <= 300 GROUP BY 1, 2, 3""")
def endpoint_pairs(spark, d):
    e = hierarchy.ends_of(segments(spark, d)).withColumn("line", F.col("id") % 40)
    return spatial.endpoint_pairs(e, 100, 300)


@query("WITH a AS (SELECT event_id AS id, [100 * (event_id % 11), 50, 100 * (event_id % 11) + 400, 450] AS b FROM events) SELECT id, CAST(floor(b[2] * 9934 / 1000.0) AS INTEGER) AS x1, CAST(floor(b[1] * 7017 / 1000.0) AS INTEGER) AS y1, CAST(least(9934, floor(b[4] * 9934 / 1000.0)) AS INTEGER) AS x2, CAST(least(7017, floor(b[3] * 7017 / 1000.0)) AS INTEGER) AS y2 FROM a")
def model_boxes(spark, d):
    b = F.array((100 * (F.col("event_id") % 11)).cast("int"), F.lit(50), (100 * (F.col("event_id") % 11) + 400).cast("int"), F.lit(450))
    return table(spark, d, "events").withColumn("b", g.decode_model_box(b, F.lit(9934), F.lit(7017))).select(F.col("event_id").alias("id"), "b.x1", "b.y1", "b.x2", "b.y2")


@query(f"{B}, r AS (SELECT drawing_id, 1000 AS a, 1000 AS b, 5000 AS c FROM boxes GROUP BY drawing_id) SELECT boxes.drawing_id, id FROM boxes JOIN r ON boxes.drawing_id = r.drawing_id WHERE (x1 + x2) / 2.0 >= a AND (x1 + x2) / 2.0 < c AND (y1 + y2) / 2.0 >= b AND (y1 + y2) / 2.0 < c AND (x1 + x2) / 2.0 - a + (y1 + y2) / 2.0 - b < 4000")
def points_in_regions(spark, d):
    pts = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((1000, 1000), (5000, 1000), (1000, 5000))])
    b = boxes(spark, d)
    regions = b.select("drawing_id").distinct().withColumn("polygon", pts).withColumn("box", g.polygon_box(pts))
    return spatial.in_regions(b, regions).select("drawing_id", "id")


from tagloom.plans import more, repairs  # noqa: E402, F401  register further queries

"""The register: records from candidates, projections, sheets, review queue, audit log and comparison with a client's register."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import scores as s
from tagloom.functions import text as t
from tagloom.operators.lookup import first_registry_entry
from tagloom.operators.shaping import remarks

DK = ["drawing_id"]
# The register's columns in order.
REGISTER = ["SLNO", "DISCIPLINE", "TAG NUMBER", "TAG DESCRIPTION", "EQUIPMENT DESCRIPTION", "SIZE&RATING", "DOCUMENT NUMBER", "SHEET NO", "REV", "DRAWING REFERENCE", "DOCUMENT TITLE", "DOC STATUS", "DATE", "DUPLICATE STATUS", "REMARKS"]
# Fields of a final record, and of a slim one.
FINAL = [
    "candidate_id", "tag_text", "symbol_name", "symbol_category", "symbol_bbox", "tag_bbox", "connected_pipe", "connected_equipment", "spatial_relationship", "sow_status", "sow_reason",
    "validation_status", "validation_reason", "validation_details", "duplicate_status", "merged_count", "ocr_confidence", "vision_confidence", "association_confidence", "patch_id", "scope_type", "functional_context",
]


def _text(df: DataFrame, name: str, default: str = "") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(default)) if name in df.columns else F.lit(default)


def final_projection(rows: DataFrame, by: list[str] = DK) -> DataFrame:
    """The primary rows with the fields of a final record; fields that rows lack are null, statuses take their defaults."""
    default = {"sow_status": "UNSPECIFIED", "validation_status": "WARN", "scope_type": "FULL_DRAWING"}

    def field(name: str) -> Column:
        if name in default:
            return _text(rows, name, default[name]).alias(name)
        return (F.col(name) if name in rows.columns else F.lit(None).cast("string")).alias(name)

    return rows.where("duplicate_status = 'PRIMARY'").select(*by, *[field(c) for c in FINAL])


def slim_projection(rows: DataFrame, fields: list[str], by: list[str] = DK) -> DataFrame:
    return rows.select(*by, *[c for c in fields if c in rows.columns])


def records(candidates: DataFrame, meta: DataFrame, connectivity: DataFrame | None = None, project: str = "", by: list[str] = DK) -> DataFrame:
    """A register record for each candidate: the 15 columns of the register and, with a leading underscore, those of the pipeline.

    candidates: (candidate_id, tag_text, symbol_name, symbol_category, functional_context, validation_status, validation_reason,
    validation_details, sow_status, scope_type, duplicate_status, vision_confidence, ocr_confidence, association_confidence,
    patch_id, symbol_bbox, ord); meta: a row for each drawing (drawing_number, sheet_number, revision_code, drawing_title,
    drawing_reference, current_issue_status, issue_date); connectivity: (candidate_id, parent_equipment, connected_equipment,
    is_isolated, connected_lines, flow_direction, flow_evidence, control_loop). SLNO counts a drawing's records by ord.
    """
    rows = t.canonical_tag(candidates.withColumn("__raw", F.coalesce("tag_text", F.lit(""))), "__raw", "__tag", "__log")
    blank = F.col("__tag") == ""
    rows = rows.withColumn("__log", F.when(blank, F.concat("__log", F.array(F.lit("no_valid_tag")))).otherwise(F.col("__log"))).withColumn("__tag", F.when(blank, "UNKNOWN").otherwise(F.col("__tag")))
    info = ["parent_equipment", "connected_equipment", "is_isolated", "connected_lines", "flow_direction", "flow_evidence", "control_loop"]
    if connectivity is not None:
        rows = rows.drop(*[c for c in info if c in rows.columns]).join(connectivity.select(*by, "candidate_id", *[c for c in info if c in connectivity.columns]), [*by, "candidate_id"], "left")
    else:
        rows = rows.drop(*[c for c in info if c in rows.columns])
    heads = ["drawing_number", "sheet_number", "revision_code", "drawing_title", "drawing_reference", "current_issue_status", "issue_date"]
    rows = rows.join(meta.select(*by, *[c for c in heads if c in meta.columns]), by, "left")
    rows = rows.withColumn("__reg", first_registry_entry(F.col("validation_details")))
    reg, tag, name, raw = F.col("__reg"), F.col("__tag"), _text(rows, "symbol_name"), F.col("__raw")
    in_reg = reg.isNotNull()
    about = t.descriptions(name, tag, _text(rows, "functional_context"), reg["description"], reg["equipment_description"])
    discipline = F.coalesce(F.nullif(F.upper(F.trim(reg["discipline"])), F.lit("")), t.discipline(tag, F.col("symbol_category")))
    number = F.when(F.col("drawing_number").isNull(), "UNKNOWN").otherwise(F.col("drawing_number"))
    status, reason, sow, scope = _text(rows, "validation_status", "WARN"), _text(rows, "validation_reason"), _text(rows, "sow_status", "UNSPECIFIED"), _text(rows, "scope_type", "FULL_DRAWING")
    parent = F.coalesce(F.nullif(_text(rows, "parent_equipment"), F.lit("")), _text(rows, "connected_equipment"))
    lone = F.coalesce(F.col("is_isolated"), F.lit(False)) if "is_isolated" in rows.columns else F.lit(False)
    flow, loop = _text(rows, "flow_direction"), _text(rows, "control_loop")
    changed = F.exists("__log", lambda x: x.contains("ocr") | x.contains("illegal") | x.contains("sep"))
    notes = remarks([
        F.when(status == "FAIL", F.concat(F.lit("VALIDATION_FAIL: "), reason)).when(status == "WARN", F.concat(F.lit("WARN: "), reason)),
        F.when(sow == "UNSPECIFIED", "NO_SCOPE_DEFINITION_FOUND").when(sow == "OUT_OF_SCOPE", "OUT_OF_SCOPE"),
        F.when(~in_reg, "NOT_IN_REGISTER"),
        F.when(changed, F.concat(F.lit("TAG_NORMALISED_FROM: "), raw)),
        F.when(scope == "REVISION_CLOUD", "WITHIN_REVISION_CLOUD"),
        F.when(parent != "", F.concat(F.lit("PARENT_EQUIP: "), parent)),
        F.when(lone, "ISOLATED_DETECTION"),
        F.when(flow != "", F.concat(F.lit("FLOW: "), flow)),
        F.when(loop != "", F.concat(F.lit("CONTROL_LOOP: "), loop)),
    ])
    serial = F.row_number().over(Window.partitionBy(*by).orderBy("ord", "candidate_id"))
    made = [serial, discipline, tag, about["tag_description"], about["equipment_description"], F.coalesce(reg["size_rating"], F.lit("")), _text(rows, "drawing_number"), _text(rows, "sheet_number"), _text(rows, "revision_code"), _text(rows, "drawing_reference"), _text(rows, "drawing_title"), t.doc_status(F.col("revision_code"), F.col("current_issue_status")), _text(rows, "issue_date"), F.when(F.col("duplicate_status") == "DISCARDED", "YES").otherwise("NO"), notes]
    inner = {
        "_candidate_id": F.col("candidate_id"), "_canonical_id": t.canonical_id(F.lit(project), tag, number), "_raw_tag": raw, "_canonical_tag": tag, "_tag_transforms": F.col("__log"), "_symbol_name": name,
        "_symbol_category": _text(rows, "symbol_category"), "_symbol_bbox": F.col("symbol_bbox"), "_validation_status": status, "_sow_status": sow, "_in_registry": in_reg,
        "_c_det": F.coalesce("vision_confidence", F.lit(0.0)), "_c_ocr": F.coalesce("ocr_confidence", F.lit(0.0)), "_c_geo": F.coalesce("association_confidence", F.lit(0.0)), "_c_val": s.check_value(F.col("validation_details")),
        "_c_reg": F.when(in_reg, 1.0).otherwise(0.5), "_patch_id": F.col("patch_id"), "_scope_type": scope, "_hier_is_isolated": lone, "_hier_parent_equipment": parent,
        "_hier_connected_lines": F.coalesce(F.col("connected_lines"), F.lit(0)).cast("int") if "connected_lines" in rows.columns else F.lit(0), "_hier_flow_direction": flow, "_hier_flow_evidence": _text(rows, "flow_evidence"), "_hier_control_loop": loop,
    }
    return rows.select(*by, *[c.alias(n) for c, n in zip(made, REGISTER, strict=True)], *[c.alias(n) for n, c in inner.items()])


def routed(cedm: DataFrame) -> DataFrame:
    """Records with confidence, route, priority and reason (null unless under review)."""
    conf = s.confidence(F.col("_c_det"), F.col("_c_ocr"), F.col("_c_geo"), F.col("_c_val"), F.col("_c_reg"), F.col("_hier_is_isolated"))
    rows = cedm.withColumn("confidence", conf)
    rows = rows.withColumn("route", s.route(F.col("_raw_tag"), F.col("confidence")["c_final"]))
    told = s.review(F.col("_raw_tag"), F.col("_validation_status"), F.col("REMARKS"), F.col("`DUPLICATE STATUS`"), F.col("_in_registry"), F.col("_sow_status"), F.col("confidence"))
    under = F.col("route") == "HUMAN_REVIEW"
    return rows.withColumn("priority", F.when(under, told["priority"])).withColumn("review_reason", F.when(under, told["reason"]))


def register_sheets(rows: DataFrame, by: list[str] = DK) -> dict[str, DataFrame]:
    """The three sheets of routed records: accepted, under review (with confidence, priority and reason, most urgent first) and a summary."""
    cols = [F.col(f"`{c}`") for c in REGISTER]
    ok = rows.where("route = 'AUTO_ACCEPT'").select(*by, *cols)
    more = [F.round(F.col("confidence.c_final"), 3).alias("C_FINAL"), F.concat(F.lit("P"), F.col("priority").cast("string")).alias("REVIEW_PRIORITY"), F.col("review_reason").alias("REVIEW_REASON")]
    look = rows.where("route = 'HUMAN_REVIEW'").orderBy(*by, F.coalesce("priority", F.lit(9)), "`TAG NUMBER`").select(*by, *cols, *more)
    n = rows.groupBy("route").agg(F.count(F.lit(1)).alias("records")).withColumnRenamed("route", "metric")
    return {"AUTO_ACCEPT": ok, "HUMAN_REVIEW": look, "SUMMARY": n}


def review_queue(rows: DataFrame, by: list[str] = DK) -> DataFrame:
    """Routed records under review as the reviewers' items; `place` is an item's place in its drawing's queue: by priority, then tag."""
    c = F.col("confidence")
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.coalesce("priority", F.lit(9)), "`TAG NUMBER`", "_candidate_id"))
    label = F.concat(F.lit("P"), F.col("priority").cast("string"))
    named = {"raw_tag": "_raw_tag", "symbol_name": "_symbol_name", "discipline": "DISCIPLINE", "symbol_bbox": "_symbol_bbox", "validation_status": "_validation_status", "sow_status": "_sow_status", "in_registry": "_in_registry", "remarks": "REMARKS", "document_number": "DOCUMENT NUMBER", "sheet_number": "SHEET NO"}
    signals = [c[x].alias(x) for x in ("c_final", "c_det", "c_ocr", "c_geo", "c_val", "c_reg")]
    items = rows.where("route = 'HUMAN_REVIEW'").withColumn("place", place)
    return items.select(*by, "place", F.coalesce("_canonical_id", "_candidate_id").alias("queue_id"), "priority", label.alias("priority_label"), "review_reason", F.col("`TAG NUMBER`").alias("tag_number"), *[F.col(f"`{v}`").alias(k) for k, v in named.items()], *signals)


def queue_header(queue: DataFrame, by: list[str] = DK) -> DataFrame:
    return queue.groupBy(*by).agg(F.count(F.lit(1)).alias("total_items"), *[F.count_if(F.col("priority") == p).alias(n) for p, n in ((1, "p1_critical"), (2, "p2_high"), (3, "p3_medium"), (4, "p4_low"))])


def audit_log(rows: DataFrame, by: list[str] = DK) -> DataFrame:
    """Rejected records with their signals."""
    c = F.col("confidence")
    named = {"candidate_id": "_candidate_id", "canonical_id": "_canonical_id", "tag_number": "TAG NUMBER", "raw_tag": "_raw_tag", "symbol_bbox": "_symbol_bbox", "patch_id": "_patch_id"}
    return rows.where("route = 'AUTO_REJECT'").select(*by, *[F.col(f"`{v}`").alias(k) for k, v in named.items()], F.coalesce("review_reason", F.lit("")).alias("rejection_reason"), *[c[x].alias(x) for x in ("c_final", "c_det", "c_ocr", "c_val")])


def canonical_duplicates(cedm: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, tag, records): canonical tags of more than one record."""
    return cedm.groupBy(*by, F.col("_canonical_tag").alias("tag")).agg(F.count(F.lit(1)).alias("records")).where("records > 1")


def compare(rows: DataFrame, register: DataFrame) -> dict[str, DataFrame]:
    """A comparison of final rows (sheet, tag, ord) with a register (tag): `in` (with the register tag that `register_match` finds and its
    flag) and `out`, `missing` (register tags that no row has), `repeated` (register tags of several rows, with them) and a `summary` (metric, value)."""
    from tagloom.operators.lookup import register_match

    hits = register_match(rows, register)
    met = rows.join(hits, "tag", "left")
    inside, out = met.where("match IS NOT NULL"), met.where("match IS NULL")
    own = register.select("tag").distinct()
    gone = own.join(inside.select(F.col("match").alias("tag")), "tag", "left_anti")
    again = inside.groupBy("match").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sheet", "ord", "tag"))), lambda x: F.concat_ws(":", x["sheet"], x["tag"])), "; ").alias("rows")).where("n > 1")
    by_sheet = met.groupBy("sheet").agg(F.count_if(F.col("match").isNotNull()).alias("rows matching"), F.countDistinct("match").alias("unique register tags"), F.count_if(F.col("match").isNull()).alias("rows not in the register"))
    parts = F.array(*[F.struct(F.concat_ws(" ", "sheet", F.lit(c)).alias("metric"), F.col(f"`{c}`").alias("value")) for c in by_sheet.columns[1:]])
    counts = [(own, "register tags"), (inside.select("match").distinct(), "register tags found"), (gone, "register tags missing"), (again, "register tags of several rows")]
    told = by_sheet.select(F.explode(parts).alias("x")).select("x.metric", "x.value")
    for df, name in counts:
        told = told.unionAll(df.agg(F.lit(name).alias("metric"), F.count(F.lit(1)).alias("value")))
    return {"in": inside, "out": out.drop("match", "status"), "missing": gone, "repeated": again, "summary": told}

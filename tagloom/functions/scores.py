"""Confidence, routing, priority and mode rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEIGHTS = {"det": 0.30, "ocr": 0.30, "geo": 0.15, "val": 0.20, "reg": 0.05}
ACCEPT, REVIEW, LOW_TEXT = 0.80, 0.55, 0.75
LEGACY_WEIGHTS = {"det": 0.25, "ocr": 0.30, "geo": 0.15, "val": 0.20, "reg": 0.10}
LEGACY_ACCEPT, LEGACY_REVIEW = 0.85, 0.60


def unit(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c.cast("double")))


def _or(c: Column, default: float, strict: bool) -> Column:
    """c, or the default where it is null; unless strict, also where it is zero (the router's own reading of a zero)."""
    c = c.cast("double")
    return F.coalesce(c if strict else F.nullif(c, F.lit(0.0)), F.lit(default))


def confidence(det: Column, ocr: Column, geo: Column, val: Column, reg: Column, isolated: Column | None = None, strict: bool = False) -> Column:
    """struct of the signals and c_final. A validation score of 0 counts as 0.5 unless strict; isolation halves geo; silent OCR takes 0.9 det."""
    d, o, g = (unit(_or(c, 0.0, strict)) for c in (det, ocr, geo))
    v, r = unit(_or(val, 0.5, strict)), unit(_or(reg, 0.5, strict))
    alone = F.coalesce(isolated, F.lit(False)) if isolated is not None else F.lit(False)
    g2 = F.when(alone, F.round(g * 0.5, 3)).otherwise(g)
    o2 = F.when(o > 0, o).otherwise(F.round(0.9 * d, 3))
    final = F.round(unit(WEIGHTS["det"] * d + WEIGHTS["ocr"] * o2 + WEIGHTS["geo"] * g2 + WEIGHTS["val"] * v + WEIGHTS["reg"] * r), 4)
    return F.struct(F.round(d, 3).alias("c_det"), F.round(o, 3).alias("c_ocr"), o2.alias("c_ocr_eff"), F.round(g2, 3).alias("c_geo"), F.round(g, 3).alias("c_geo_raw"), alone.alias("isolated"), F.round(v, 3).alias("c_val"), F.round(r, 3).alias("c_reg"), final.alias("c_final"))


def legacy_confidence(det: Column, ocr: Column, geo: Column, val: Column, reg: Column) -> Column:
    return F.round(unit(sum(LEGACY_WEIGHTS[k] * unit(c) for k, c in zip(("det", "ocr", "geo", "val", "reg"), (det, ocr, geo, val, reg), strict=True))), 3)


def legacy_label(c: Column) -> Column:
    up = F.trim(F.upper(c))
    return F.when(up == "HIGH", 0.95).when(up == "MEDIUM", 0.75).when(up == "LOW", 0.50).otherwise(0.75)


def legacy_route(c: Column) -> Column:
    return F.when(c >= LEGACY_ACCEPT, "AUTO_ACCEPT").when(c >= LEGACY_REVIEW, "REVIEW_REQUIRED").otherwise("AUTO_REJECT")


def missing_tag(raw: Column) -> Column:
    return F.trim(F.coalesce(raw, F.lit(""))).isin("", "UNKNOWN")


def route(raw: Column, c_final: Column) -> Column:
    return F.when(missing_tag(raw), "HUMAN_REVIEW").when(c_final >= ACCEPT, "AUTO_ACCEPT").when(c_final >= REVIEW, "HUMAN_REVIEW").otherwise("AUTO_REJECT")


def review(raw: Column, status: Column, remarks: Column, duplicate: Column, in_registry: Column, sow: Column, conf: Column) -> Column:
    """struct(priority, reason) of a record under review, by ten rules in order."""
    up = F.upper(F.coalesce(remarks, F.lit("")))
    rules = [
        (missing_tag(raw), 1, "MISSING_TAG"),
        (status == "FAIL", 1, "VALIDATION_FAIL"),
        (up.contains("DUPLICATE") | (duplicate == "YES"), 2, "DUPLICATE_CONFLICT"),
        (conf["c_ocr_eff"] < LOW_TEXT, 2, "LOW_TEXT_CONF"),
        (conf["isolated"], 3, "ISOLATED_DETECTION"),
        (~F.coalesce(in_registry, F.lit(False)), 3, "NOT_IN_REGISTER"),
        (sow == "UNSPECIFIED", 3, "SOW_UNSPECIFIED"),
        (up.contains("PREFIX_MISMATCH"), 3, "PREFIX_MISMATCH"),
        (conf["c_val"] < 0.8, 4, "VALIDATION_WARN"),
    ]
    case = None
    for when, p, why in rules:
        out = F.struct(F.lit(p).alias("priority"), F.lit(why).alias("reason"))
        case = F.when(F.coalesce(when, F.lit(False)), out) if case is None else case.when(F.coalesce(when, F.lit(False)), out)
    return case.otherwise(F.struct(F.lit(4).alias("priority"), F.lit("CONFIDENCE_BORDERLINE").alias("reason")))


def check_value(details: Column) -> Column:
    """The least of the checks: 1 true, 0 false, 0.5 unknown; 0.5 without checks."""
    v = F.array_min(F.transform(details, lambda d: F.when(d["pass"], 1.0).when(~d["pass"], 0.0).otherwise(0.5)))
    return F.coalesce(v, F.lit(0.5))


def association_confidence(leader: Column, pipe: Column, contained: Column) -> Column:
    """The best of a leader line, a pipe and a container; 0.3 without any."""
    best = F.greatest(
        F.when(leader.isNotNull(), 0.9 - F.least(leader / 200, F.lit(0.4))),
        F.when(pipe.isNotNull(), 0.7 - F.least(pipe / 300, F.lit(0.3))),
        F.when(contained, F.lit(0.8)),
    )
    return F.round(F.coalesce(best, F.lit(0.3)), 3)


def spatial_relationship(contained: Column, gap: Column, pipe: Column) -> Column:
    """gap: distance to a leader line, pipe: to a pipe; null where there is none."""
    return F.when(contained, "CONTAINED_WITHIN").when(gap < 20, "ATTACHED_TO").when(pipe < 30, "CONNECTED_TO").when((pipe <= 150) | (gap <= 150), "ADJACENT_TO").otherwise("ISOLATED")


def project_mode(number: Column, title: Column | None = None) -> Column:
    """By the project prefix of the drawing's number, then of its title: in each, LT or GT (counts only) come before LC or GC."""
    case = None
    for text in (number,) if title is None else (number, title):
        t = F.upper(F.trim(F.coalesce(text, F.lit(""))))
        for names, mode in ((("LT", "GT"), "COUNT_ONLY"), (("LC", "GC"), "FULL_EXTRACTION")):
            hit = None
            for n in names:
                one = t.startswith(n) | t.contains(f"-{n}-")
                hit = one if hit is None else hit | one
            case = F.when(hit, mode) if case is None else case.when(hit, mode)
    return case.otherwise("FULL_EXTRACTION")


#: Revision codes of a first issue.
FIRST_ISSUES = ("0", "A", "00", "REV0", "REVA", "P0", "IFI", "IFA", "P1", "IFR", "IFC-A", "AFC-A")


def revision_scope(notice: Column, revision: Column, cloud_only: Column | None = None) -> Column:
    """A notice of clouds (or the flag cloud_only) limits extraction to clouds; a first issue is read whole; any other revision takes clouds first."""
    clouded = F.upper(F.coalesce(notice, F.lit(""))).contains("CLOUD")
    if cloud_only is not None:
        clouded = clouded | F.coalesce(cloud_only, F.lit(False))
    return F.when(clouded, "CLOUD_ONLY").when(F.upper(F.trim(F.coalesce(revision, F.lit("")))).isin(*FIRST_ISSUES), "FULL_DRAWING").otherwise("CLOUD_PRIORITY")


def applies_cloud_filter(forced_full: Column, regions: Column, scope: Column, required: Column, revision: Column) -> Column:
    return ~F.coalesce(forced_full, F.lit(False)) & (regions > 0) & (scope != "FULL_DRAWING") & ((scope == "CLOUD_ONLY") | F.coalesce(required, F.lit(False)) | F.coalesce(revision, F.lit(False)))


def bridge_score(distance: Column, same_orientation: Column, equipment_between: Column) -> Column:
    return F.round(1 - distance / 300 + F.when(same_orientation, 0.3).otherwise(0.0) - F.when(equipment_between, 0.5).otherwise(0.0), 4)


def cap_label_only(c: Column, label_only: Column, most: float = 0.4) -> Column:
    return F.when(label_only, F.least(c, F.lit(most))).otherwise(c)


def nearer_end(d_a: Column, d_b: Column) -> Column:
    return F.when(d_a <= d_b, "A").otherwise("B")

"""Tiles, tables, records, validation roll-up, windows and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import text as t

DK = ["drawing_id"]


def tiles(sheets: DataFrame, size: int = 768, overlap: float = 0.4, by: list[str] = DK) -> DataFrame:
    """(by, patch_id, box): tiles of a sheet (width_px, height_px); stride int(size * (1 - overlap)), the last ones clipped at the edge."""
    stride = int(size * (1 - overlap))

    def starts(c: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.col(c) - size) / stride).cast("int"))), lambda i: i * stride)

    at = sheets.select(*by, "width_px", "height_px", F.explode(starts("height_px")).alias("y1")).select("*", F.explode(starts("width_px")).alias("x1"))
    box = F.struct("x1", "y1", F.least(F.col("x1") + size, F.col("width_px")).alias("x2"), F.least(F.col("y1") + size, F.col("height_px")).alias("y2"))
    n = F.row_number().over(Window.partitionBy(*by).orderBy("y1", "x1")) - 1
    return at.select(*by, n.alias("patch_id"), box.alias("box"), "width_px", "height_px")


def tile_order(tile_rows: DataFrame, by: list[str] = DK) -> DataFrame:
    """Tiles with `turn`, by Manhattan distance of their centre to the sheet's."""
    b = F.col("box")
    d = F.abs(b["x1"] + b["x2"] - F.col("width_px")) + F.abs(b["y1"] + b["y2"] - F.col("height_px"))
    return tile_rows.withColumn("turn", F.row_number().over(Window.partitionBy(*by).orderBy(d, "patch_id")))


def unpivot_cells(tables: DataFrame, cells: str = "cells") -> DataFrame:
    """A row per filled cell of a map column: column_header, tag_number; null, empty, - and texts under 3 characters are no tags."""
    out = tables.select(*[c for c in tables.columns if c != cells], F.explode(cells).alias("column_header", "tag_number"))
    return out.where("tag_number IS NOT NULL AND trim(tag_number) NOT IN ('', '-') AND length(trim(tag_number)) >= 3")


def best_per_key(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key; order must be total."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def mark_repeats(rows: DataFrame, keys: list[str], order: list, name: str = "dup") -> DataFrame:
    return rows.withColumn(name, F.when(F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) > 1, "DUPLICATE").otherwise("FIRST"))


def spaced_values(values: Column, gap: Column | int) -> Column:
    """Of sorted values those more than gap above the last one kept."""
    zero = F.array().cast("array<int>")
    return F.aggregate(F.array_sort(values), zero, lambda kept, v: F.when((F.size(kept) == 0) | (v - F.element_at(kept, -1) > gap), F.concat(kept, F.array(v.cast("int")))).otherwise(kept))


def merge_halves(left: DataFrame, right: DataFrame, key: str = "row_label") -> DataFrame:
    """Full outer join of two halves of a wide table; cells of the right one win."""
    e = F.create_map().cast("map<string,string>")
    lc, rc = F.coalesce("lc", e), F.coalesce("rc", e)
    both = left.select(key, F.col("cells").alias("lc")).join(right.select(key, F.col("cells").alias("rc")), key, "full")
    return both.select(key, F.map_concat(F.map_filter(lc, lambda k, _: ~F.map_contains_key(rc, k)), rc).alias("cells"))


def business_checks(tag: Column, symbol: Column, category: Column) -> Column:
    """The checks of a record's rules as an array of struct(pass, rule, message); one general pass if no rule speaks."""
    tg, name = F.upper(F.trim(F.coalesce(tag, F.lit("")))), F.upper(F.coalesce(symbol, F.lit("")))

    def check(ok: Column, rule: str, message) -> Column:
        return F.struct(ok.alias("pass"), F.lit(rule).alias("rule"), (message if isinstance(message, Column) else F.lit(message)).alias("message"))

    valve = name.contains("CONTROL VALVE") | F.coalesce(category == "valve", F.lit(False))
    good = tg.rlike("[FTPLAZX]CV") | tg.rlike("[FTPLAZX]V-")
    one = F.when(valve & good, check(F.lit(True), "BR-001", "Valve has correct function prefix")).when(valve & tg.rlike("^[A-Z]+-?[A-Z]{1,5}-?[0-9]"), check(F.lit(True), "BR-001", "Valve tag format acceptable"))
    it = tg.rlike("[A-Z]T-[0-9]|[A-Z]IT-[0-9]")
    two = F.when(name.contains("TRANSMITTER"), check(it, "BR-002", F.when(it, "Transmitter has T/IT suffix").otherwise(F.concat(F.lit("Transmitter tag missing T/IT: "), tg))))
    rv = tg.rlike("[A-Z]-?[RP][SV]V?-?[0-9]")
    three = F.when(name.contains("RELIEF") | name.contains("SAFETY"), check(rv, "BR-003", F.when(rv, "Relief valve has RV/PSV prefix").otherwise(F.concat(F.lit("Relief valve missing RV/PSV: "), tg))))
    found = F.array_compact(F.array(one, two, three))
    return F.when(F.size(found) > 0, found).otherwise(F.array(check(F.lit(True), "BR-GENERAL", "No specific business rules violated")))


def roll_up(checks: Column) -> Column:
    """struct(status, reason): FAIL with the first three failures, WARN if the register is silent, else PASS."""

    def told(a: Column, n: int) -> Column:
        return F.array_join(F.transform(F.slice(a, 1, n), lambda c: c["message"]), " | ")

    def split(c: Column) -> Column:
        return F.struct(F.filter(c, lambda x: ~x["pass"]).alias("failed"), F.filter(c, lambda x: x["pass"].isNull() & (x["rule"] == "REGISTRY")).alias("silent"))

    def status(x: Column) -> Column:
        fail, warn = F.size(x["failed"]) > 0, F.size(x["silent"]) > 0
        return F.struct(F.when(fail, "FAIL").when(warn, "WARN").otherwise("PASS").alias("status"), F.when(fail, told(x["failed"], 3)).when(warn, told(x["silent"], 2)).otherwise("All validation checks passed").alias("reason"))

    return t.let(checks, lambda c: t.let(split(c), status))


def remarks(parts: list[Column]) -> Column:
    return F.array_join(F.array_compact(F.array(*[F.nullif(p, F.lit("")) for p in parts])), " | ")


def merge_metadata(block: Column, context: Column, fields: list[str]) -> Column:
    """Fields of two structs; the title block's counts unless it is empty."""
    return F.struct(*[F.coalesce(F.nullif(F.trim(block[f]), F.lit("")), context[f]).alias(f) for f in fields])


def rules_block(notes: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, block): notes' rules under their type's heading, in order of id."""
    lines = notes.groupBy(*by, "semantic_type").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(t.note_order(F.col("id")).alias("o"), "rule"))), lambda x: F.concat(F.lit("- "), x["rule"])), "\n").alias("body"))
    return lines.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("semantic_type", "body"))), lambda x: F.concat(F.lit("["), x["semantic_type"], F.lit("]\n"), x["body"])), "\n").alias("block"))


def validate_clouds(clouds: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, id, severity, issue) for regions: repeated ids, under three points, no area (errors); more than 50 px outside the sheet (warning)."""
    from tagloom.functions.geometry import polygon_area, polygon_box

    n = F.count(F.lit(1)).over(Window.partitionBy(*by, "id"))
    b = polygon_box(F.col("polygon"))
    out = (b["x1"] < -50) | (b["y1"] < -50) | (b["x2"] > F.col("width_px") + 50) | (b["y2"] > F.col("height_px") + 50)
    found = F.array_compact(
        F.array(
            F.when(F.col("__n") > 1, F.struct(F.lit("ERROR").alias("severity"), F.lit("DUPLICATE_ID").alias("issue"))),
            F.when(F.size("polygon") < 3, F.struct(F.lit("ERROR").alias("severity"), F.lit("TOO_FEW_POINTS").alias("issue"))),
            F.when((F.size("polygon") >= 3) & (polygon_area(F.col("polygon")) == 0), F.struct(F.lit("ERROR").alias("severity"), F.lit("ZERO_AREA").alias("issue"))),
            F.when(out, F.struct(F.lit("WARNING").alias("severity"), F.lit("OUT_OF_BOUNDS").alias("issue"))),
        )
    )
    return clouds.withColumn("__n", n).select(*by, "id", F.explode(found).alias("x")).select(*by, "id", "x.severity", "x.issue")


def routing_summary(routed: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts, rates, priorities and confidence figures of routed records (route, priority, c_final)."""
    n = F.count(F.lit(1))

    def share(r: str) -> Column:
        return F.round(100.0 * F.count_if(F.col("route") == r) / n, 1)

    kept = F.when(F.col("route") != "AUTO_REJECT", F.col("c_final"))
    return routed.groupBy(*(by or [])).agg(
        n.alias("total"),
        *[F.count_if(F.col("route") == r).alias(name) for r, name in (("AUTO_ACCEPT", "accepted"), ("HUMAN_REVIEW", "review"), ("AUTO_REJECT", "rejected"))],
        share("AUTO_ACCEPT").alias("accept_rate"),
        share("HUMAN_REVIEW").alias("review_rate"),
        *[F.count_if(F.col("priority") == p).alias(f"p{p}") for p in (1, 2, 3, 4)],
        F.round(F.avg(kept), 6).alias("avg_confidence"),
        F.min(kept).alias("min_confidence"),
        F.max(kept).alias("max_confidence"),
    )


def tally(rows: DataFrame, labels: str = "transforms") -> DataFrame:
    return rows.select(F.explode(labels).alias("label")).groupBy(F.split("label", ":")[0].alias("label")).agg(F.count(F.lit(1)).alias("n"))


def best_notes(notes: DataFrame, by: list[str] = DK) -> DataFrame:
    """notes (id, raw_text, confidence, ord) without repeats: per id, or without one (or UNKNOWN) per first 40 characters, the one with
    the highest confidence (0.5 if there is none) plus a thousandth of its length; the first of several. Notes with neither go."""
    name, raw = F.upper(F.trim(F.coalesce(F.col("id"), F.lit("")))), F.trim(F.coalesce("raw_text", F.lit("")))
    key = F.when(~name.isin("", "UNKNOWN"), name).otherwise(F.upper(F.left(raw, F.lit(40))))
    score = F.coalesce("confidence", F.lit(0.5)) + F.length(raw) / 1000
    keyed = notes.withColumn("__key", key).withColumn("__score", score).where("__key <> ''")
    return best_per_key(keyed, [*by, "__key"], [F.desc("__score"), "ord"]).drop("__key", "__score")


def distinct_tables(tables: DataFrame, by: list[str] = DK) -> DataFrame:
    """tables (title, priority, ord) of a drawing's tiles: of equal titles (but for case and spaces) the one of the first tile; tables without a title all stay."""
    key = F.regexp_replace(F.upper(F.trim(F.coalesce("title", F.lit("")))), r"\s+", " ")
    n = F.row_number().over(Window.partitionBy(*by, "__key").orderBy("priority", "ord"))
    return tables.withColumn("__key", key).withColumn("__n", n).where("__n = 1 OR __key = ''").drop("__key", "__n")


def merged_abbreviations(regions: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, abbreviation, meaning) of regions (ord, abbreviations map): of several meanings that of the last region."""
    return regions.select(*by, "ord", F.explode("abbreviations").alias("abbreviation", "meaning")).groupBy(*by, "abbreviation").agg(F.max_by("meaning", "ord").alias("meaning"))


def conventions(notes: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, unit_system): metric or imperial by the last note (raw_text, ord) that names one, imperial if it names both; mixed without any."""
    up = F.upper(F.coalesce("raw_text", F.lit("")))
    told = notes.withColumn("__u", F.when(up.contains("IMPERIAL"), "imperial").when(up.contains("METRIC"), "metric"))
    return told.groupBy(*by).agg(F.coalesce(F.max_by("__u", F.when(F.col("__u").isNotNull(), F.col("ord"))), F.lit("mixed")).alias("unit_system"))

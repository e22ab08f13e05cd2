"""What the workbooks of the hierarchy, its validation, the register and its comparison hold: a frame and an order for each sheet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DK = ["drawing_id"]
NONE = "—"
Sheets = dict[str, tuple[DataFrame, list]]


def _or_none(df: DataFrame, drawings: DataFrame, told: dict[str, str], by: list[str]) -> DataFrame:
    """df, with a row that says so for drawings that have none."""
    empty = drawings.select(*by).distinct().join(df.select(*by).distinct(), by, "left_anti")
    return df.select([F.col(c) if c in by else F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]).unionByName(empty.select(*by, *[F.lit(told.get(c, NONE if told else "")).alias(c) for c in df.columns if c not in by]))


def hierarchy_sheets(assets: DataFrame, relations: DataFrame, cross: DataFrame, lone: DataFrame, figures: DataFrame, unit: Column, by: list[str] = DK) -> Sheets:
    """The seven sheets of a hierarchy. assets: `asset_rows`, perhaps with description, symbol_name, drawing and confidence; relations: `relationships` (parent, child, rel, source, confidence);
    cross: (source_drawing, source_tag, ref_drawing, ref_tag, relationship); lone: `orphans`; figures: `statistics` (ord, metric, value).

    Assets go by level, then name; line numbers have a sheet of their own; a drawing without lines, references or orphans says so."""
    def extra(name: str) -> Column:
        return F.col(name) if name in assets.columns else F.lit("")

    told = {"description": extra("description"), "symbol": extra("symbol_name"), "drawing": extra("drawing"), "confidence": extra("confidence")}
    plain = assets.where("NOT piping")
    tree = plain.select(*by, F.col("plant").alias("Plant"), F.col("area").alias("Area"), F.col("system").alias("System"), F.col("functional_location").alias("Functional Location"), F.col("parent_equipment").alias("Parent Equipment"), F.col("equipment").alias("Equipment"), told["description"].alias("Equipment Description"), told["symbol"].alias("Equipment Type"), F.col("level").alias("Hierarchy Level"), F.col("path").alias("Path"), told["drawing"].alias("Source Drawing"), told["confidence"].alias("Confidence"))
    pipes = assets.where("piping").select(*by, F.col("equipment").alias("Line Number"), told["description"].alias("Description"), told["drawing"].alias("Source Drawing"), told["confidence"].alias("Confidence"))
    steps = F.split("path", " > ")
    places = assets.select(*by, F.col("plant").alias("Plant"), F.col("area").alias("Area"), unit.alias("Unit"), F.get(steps, F.lit(0)).alias("System"), F.when(F.size(steps) > 2, F.get(steps, F.lit(1))).otherwise("").alias("Sub-System"), F.col("equipment").alias("Equipment"), F.col("functional_location").alias("Functional Location"))
    links = relations.select(*by, F.col("parent").alias("Parent Node"), F.col("child").alias("Child Node"), F.col("rel").alias("Relationship Type"), F.col("source").alias("Source"), F.col("confidence").alias("Confidence"))
    far = cross.select(*by, F.col("source_drawing").alias("Source Drawing"), F.col("source_tag").alias("Source Tag"), F.col("ref_drawing").alias("Referenced Drawing"), F.col("ref_tag").alias("Referenced Tag"), F.col("relationship").alias("Relationship"))
    yes = lambda c: F.when(c, "YES").otherwise("")
    lost = lone.select(*by, F.col("tag").alias("Node"), F.col("kind").alias("Kind"), yes(F.col("no_parent")).alias("No Parent Found"), F.lit("").alias("No Functional Location"), yes(F.contains("reason", F.lit("no system"))).alias("No System"), yes(F.col("isolated")).alias("Broken Relationship"), F.col("reason").alias("Reason"))
    ordered = figures.select(*by, F.col("metric").alias("Metric"), F.col("value").alias("Value"))
    place = F.array_position(F.array(*[F.lit(m) for m in FIGURES]), F.col("Metric"))
    return {
        "Asset Hierarchy": (tree, ["Hierarchy Level", "Equipment", "Path"]),
        "Piping Lines": (_or_none(pipes, assets, {"Line Number": NONE, "Description": "No piping line numbers detected", "Source Drawing": "", "Confidence": ""}, by), ["Line Number"]),
        "Parent Child Relationships": (links, ["Parent Node", "Child Node", "Relationship Type"]),
        "Functional Location": (places, ["Equipment", "Functional Location"]),
        "Cross Drawing References": (_or_none(far, assets, {"Relationship": "No cross-drawing references detected on this sheet"}, by), ["Source Tag", "Referenced Drawing"]),
        "Orphan Nodes": (_or_none(lost, assets, {"Node": NONE, "Kind": NONE, "No Parent Found": "", "No Functional Location": "", "No System": "", "Broken Relationship": "", "Reason": "No orphan nodes"}, by), ["Node"]),
        "Hierarchy Statistics": (ordered, [place]),
    }


# The figures of a hierarchy in the order of its sheet.
FIGURES = (
    "Total Nodes (tagged)",
    "Total Graph Nodes (incl. virtual)",
    "Total Relationships (business)",
    "Total Graph Edges",
    "Equipment Count",
    "Instrument Count",
    "Valve Count",
    "Piping Count",
    "Control Loops",
    "Cross Drawing Links",
    "Orphan Nodes",
    "Virtual Nodes (pipelines+junctions)",
    "Hierarchy Depth (max)",
    "Isolated Detections",
)


def validation_sheets(issues: DataFrame, drawings: DataFrame, by: list[str] = DK) -> Sheets:
    """The two sheets of a validation: issues (issue, node, severity, reason, fix) and their numbers by severity and type; a drawing without issues says so."""
    rows = issues.select(*by, F.col("issue").alias("Issue Type"), F.col("node").alias("Node"), F.col("severity").alias("Severity"), F.col("reason").alias("Reason"), F.col("fix").alias("Suggested Fix"))
    n = F.count(F.lit(1)).cast("long").alias("Count")
    every = drawings.select(*by).distinct().join(issues.groupBy(*by).agg(n), by, "left").select(*by, F.lit("TOTAL ISSUES").alias("Metric"), F.coalesce("Count", F.lit(0)).alias("Count"), F.lit(0).alias("__o"))
    severity = issues.groupBy(*by, F.concat(F.lit("Severity: "), "severity").alias("Metric")).agg(n).withColumn("__o", F.lit(1))
    kind = issues.groupBy(*by, F.concat(F.lit("Type: "), "issue").alias("Metric")).agg(n).withColumn("__o", F.lit(2))
    told = every.unionByName(severity).unionByName(kind)
    rank = F.when(F.col("Metric") == "TOTAL ISSUES", 0).when(F.startswith("Metric", F.lit("Severity: ")), 1).otherwise(2)
    return {
        "Validation Issues": (_or_none(rows, drawings, {"Issue Type": NONE, "Node": NONE, "Severity": NONE, "Reason": "No validation issues found", "Suggested Fix": ""}, by), ["Issue Type", "Node"]),
        "Summary": (told.drop("__o"), [rank, "Metric"]),
    }

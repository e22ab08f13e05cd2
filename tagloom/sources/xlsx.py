"""Workbooks with the standard library: a reader that runs where Spark reads, and a thin writer for reports."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
MOST_ROWS = 1_048_576


def column_number(ref: str) -> int:
    """The column of a cell reference, from 0."""
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def sheets(content: bytes) -> list[tuple[str, list[list[str | None]]]]:
    """(name, rows of texts) of each sheet."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{{{NS['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", NS)]
        rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        out = []
        for s in ElementTree.fromstring(z.read("xl/workbook.xml")).find("m:sheets", NS):
            target = rels[s.get(REL)]
            path = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
            rows: list[list[str | None]] = []
            for r in ElementTree.fromstring(z.read(path)).iter(f"{{{NS['m']}}}row"):
                cells: dict[int, str | None] = {}
                for i, c in enumerate(r.findall("m:c", NS)):
                    at = column_number(c.get("r")) if c.get("r") else i
                    v, inline = c.find("m:v", NS), c.find("m:is", NS)
                    if c.get("t") == "s" and v is not None:
                        cells[at] = shared[int(v.text)]
                    elif inline is not None:
                        cells[at] = "".join(t.text or "" for t in inline.iter(f"{{{NS['m']}}}t"))
                    else:
                        cells[at] = v.text if v is not None else None
                number = int(r.get("r") or len(rows) + 1)
                rows += [[] for _ in range(number - 1 - len(rows))]
                rows.append([cells.get(k) for k in range(max(cells, default=-1) + 1)])
            out.append((s.get("name"), rows))
        return out


def read_xlsx(spark: SparkSession, path: str) -> DataFrame:
    """(path, sheet, row from 1, cells, sheet_no from 1): every row of every workbook under path; each file is parsed in one task."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for p, content in zip(f["path"], f["content"], strict=True):
                made = [(p, name, i, row, k) for k, (name, rows) in enumerate(sheets(content), 1) for i, row in enumerate(rows, 1)]
                yield pd.DataFrame(made, columns=["path", "sheet", "row", "cells", "sheet_no"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, "path string, sheet string, row int, cells array<string>, sheet_no int")


def by_header(rows: DataFrame, header_row: int = 1) -> DataFrame:
    """(path, sheet, row, values map): rows under a header, by its upper-case names."""
    head = rows.where(F.col("row") == header_row).select("path", "sheet", F.transform("cells", lambda c: F.upper(F.trim(F.coalesce(c, F.lit(""))))).alias("names"))
    body = rows.where(F.col("row") > header_row).join(F.broadcast(head), ["path", "sheet"])
    pairs = F.filter(F.arrays_zip(F.col("names").alias("k"), F.col("cells").alias("v")), lambda p: p["k"].isNotNull() & (p["k"] != ""))
    return body.select("path", "sheet", "row", F.map_from_entries(F.transform(pairs, lambda p: F.struct(p["k"], p["v"]))).alias("values"))


def registry_rows(sheet_rows: DataFrame, tag: str = "TAG NUMBER") -> DataFrame:
    """(tag, discipline, description, equipment_description, ord) of a register workbook."""
    v = F.col("values")
    return by_header(sheet_rows).select(v[tag].alias("tag"), v["DISCIPLINE"].alias("discipline"), v["TAG DESCRIPTION"].alias("description"), v["EQUIPMENT DESCRIPTION"].alias("equipment_description"), F.col("row").alias("ord")).where("trim(coalesce(tag, '')) <> ''")


def ground_truth(sheet_rows: DataFrame, column: int = 3) -> DataFrame:
    """(path, ord, tag): the trimmed texts of a column (from 1) of each workbook's first sheet below its heading; empty cells are left out."""
    tag = F.get("cells", F.lit(column - 1))
    return sheet_rows.where("sheet_no = 1 AND row > 1").select("path", F.col("row").alias("ord"), F.trim(tag).alias("tag")).where(F.coalesce(tag, F.lit("")) != "")


def scope_rows(sheet_rows: DataFrame, use: str = "USE") -> DataFrame:
    """(ord, name, status) of a scope workbook: the sheet named `use` allows, others block."""
    v = F.col("values")
    return by_header(sheet_rows).select(F.col("row").alias("ord"), v["SYMBOL NAME"].alias("name"), F.when(F.upper("sheet") == use, "ALLOW").otherwise("BLOCK").alias("status")).where("trim(coalesce(name, '')) <> ''")


def _cell(ref: str, value) -> str:
    if value is None or value != value:
        return ""
    if isinstance(value, bool | str) or not isinstance(value, int | float):
        return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'
    return f'<c r="{ref}"><v>{value}</v></c>'


def letters(n: int) -> str:
    out = ""
    n += 1
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def workbook(frames: dict[str, DataFrame]) -> bytes:
    """A workbook with a sheet for each frame; for reports: a frame beyond a sheet's rows is an error."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        types, book, rels = [], [], []
        for i, (name, df) in enumerate(frames.items(), 1):
            head = df.limit(MOST_ROWS).collect()
            if len(head) >= MOST_ROWS:
                raise ValueError(f"{name} has more rows than a sheet holds")
            lines = [df.columns, *[list(r) for r in head]]
            body = "".join(f'<row r="{n}">' + "".join(_cell(f"{letters(k)}{n}", v) for k, v in enumerate(line)) + "</row>" for n, line in enumerate(lines, 1))
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{NS["m"]}"><sheetData>{body}</sheetData></worksheet>')
            types.append(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>')
            book.append(f'<sheet name="{escape(name[:31])}" sheetId="{i}" r:id="rId{i}"/>')
            rels.append(f'<Relationship Id="rId{i}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i}.xml"/>')
        z.writestr("[Content_Types].xml", '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>' + "".join(types) + "</Types>")
        z.writestr("_rels/.rels", '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{NS["m"]}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{"".join(book)}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{"".join(rels)}</Relationships>')
    return out.getvalue()

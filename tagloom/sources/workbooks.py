"""A workbook for each drawing, made and written by the tasks: rows become XML as expressions, a task streams a drawing's sheets into an archive, and a data source puts the archives into a folder."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tagloom.sources.xlsx import MOST_ROWS, NS

DK = ["drawing_id"]
_MAIN = NS["m"]
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml"


def _cell(column: Column, kind: str) -> Column:
    """A cell's XML: numbers as such, anything else as text; nulls and what isn't a number keep their place."""
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        sound = column.isNotNull() & ~F.isnan(column.cast("double")) & (F.abs(column.cast("double")) < float("inf"))
        return F.when(sound, F.concat(F.lit("<c><v>"), column.cast("string"), F.lit("</v></c>"))).otherwise("<c/>")
    text = (F.to_json(column) if kind.startswith(("array", "struct", "map")) else column.cast("string"))
    safe = F.replace(F.replace(F.replace(F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F\uFFFE\uFFFF]", ""), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.when(text.isNull(), "<c/>").otherwise(F.concat(F.lit('<c t="inlineStr"><is><t xml:space="preserve">'), safe, F.lit("</t></is></c>")))


def _head(names: list[str]) -> str:
    return "<row>" + "".join(f'<c t="inlineStr"><is><t>{escape(n)}</t></is></c>' for n in names) + "</row>"


def sheet_rows(sheets: dict[str, tuple[DataFrame, list]], drawings: DataFrame, by: list[str] = DK) -> DataFrame:
    """(by, sheet, part, ord, name, xml): the sheets' rows as XML, a row for a heading at ord 0 of every sheet of every drawing. sheets: by name, a frame with the columns of `by` and then those of the sheet, and what its rows are ordered by.

    What goes beyond a sheet's rows goes on in further parts, each with its heading. Names are cut to 31 characters, with the part's number."""
    out = None
    room = MOST_ROWS - 1
    for k, (name, (df, order)) in enumerate(sheets.items(), 1):
        shown = [c for c in df.columns if c not in by]
        kinds = dict(df.dtypes)
        n = F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")
        body = df.withColumn("__n", n - 1).select(*by, F.lit(k).alias("sheet"), F.floor(F.col("__n") / room).cast("int").alias("part"), (F.col("__n") % room + 1).alias("ord"), F.concat(F.lit("<row>"), *[_cell(F.col(f"`{c}`"), kinds[c]) for c in shown], F.lit("</row>")).alias("xml"))
        first = drawings.select(*by).distinct().select(*by, F.lit(k).alias("sheet"), F.lit(0).alias("part"), F.lit(0).cast("long").alias("ord"), F.lit(_head(shown)).alias("xml"))
        more = body.where("part > 0 AND ord = 1").select(*by, "sheet", "part", F.lit(0).cast("long").alias("ord"), F.lit(_head(shown)).alias("xml"))
        rows = first.unionAll(body).unionAll(more).withColumn("name", F.when(F.col("part") == 0, F.lit(name[:31])).otherwise(F.concat(F.lit(f"{name[:24]} "), (F.col("part") + 1).cast("string"))))
        out = rows if out is None else out.unionAll(rows)
    if out is None:
        raise ValueError("a workbook has a sheet at least")
    return out


def _closed(z: zipfile.ZipFile, names: list[str]) -> None:
    """What an archive of these sheets needs besides them."""
    n = range(1, len(names) + 1)
    head = '<?xml version="1.0" encoding="UTF-8"?>'
    part = [f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{_TYPE}.worksheet+xml"/>' for i in n]
    z.writestr("[Content_Types].xml", f'{head}<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{_TYPE}.sheet.main+xml"/>{"".join(part)}</Types>')
    z.writestr("_rels/.rels", f'{head}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
    z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}"><sheets>{"".join(f"<sheet name={quoteattr(x)} sheetId={quoteattr(str(i))} r:id={quoteattr(f"rId{i}")}/>" for i, x in zip(n, names, strict=True))}</sheets></workbook>')
    z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{_PACKAGE}/relationships">{"".join(f"<Relationship Id={quoteattr(f"rId{i}")} Type={quoteattr(f"{_OFFICE}/worksheet")} Target={quoteattr(f"worksheets/sheet{i}.xml")}/>" for i in n)}</Relationships>')


def _archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Archives of sorted rows (file, sheet, part, name, xml); a sheet is compressed as its rows come."""
    now = at = out = z = stream = None
    names: list[str] = []

    def done() -> pa.RecordBatch:
        stream.write(b"</sheetData></worksheet>")
        stream.close()
        _closed(z, names)
        z.close()
        return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([out.getvalue()], pa.binary())], names=["file", "content"])

    for b in batches:
        for file, sheet, part, name, xml in zip(*[b.column(c).to_pylist() for c in ("file", "sheet", "part", "name", "xml")], strict=True):
            if file != now:
                if now is not None:
                    yield done()
                now, at, out, names = file, None, io.BytesIO(), []
                z = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
            if (sheet, part) != at:
                if at is not None:
                    stream.write(b"</sheetData></worksheet>")
                    stream.close()
                at = sheet, part
                names.append(name)
                stream = z.open(zipfile.ZipInfo(f"xl/worksheets/sheet{len(names)}.xml"), "w", force_zip64=True)
                stream.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_MAIN}"><sheetData>'.encode())
            stream.write(xml.encode())
    if now is not None:
        yield done()


def workbooks(rows: DataFrame, file: Column) -> DataFrame:
    """(file, content): a workbook for each value of `file`, from `sheet_rows`. One task makes a drawing's workbook and holds its compressed sheets."""
    keyed = rows.withColumn("file", file.cast("string")).repartition("file").sortWithinPartitions("file", "sheet", "part", "ord")
    return keyed.select("file", "sheet", "part", "name", "xml").mapInArrow(_archives, "file string, content binary")


@dataclass
class Written(WriterCommitMessage):
    files: int


class _Folder(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, rows: Iterator) -> Written:
        from pyarrow import fs
        from pyspark import TaskContext

        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        n, task = 0, TaskContext.get().taskAttemptId()
        for row in rows:
            if "/" in row.file or row.file.startswith((".", "_")):
                raise ValueError(f"not a file's name: {row.file}")
            kept = f"{root}/.{row.file}.{task}"  # a file appears whole, and a task that runs again puts the same one there
            with store.open_output_stream(kept) as out:
                out.write(bytes(row.content))
            store.move(kept, f"{root}/{row.file}")
            n += 1
        return Written(n)

    def commit(self, messages) -> None:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/_SUCCESS") as out:
            out.write(b"")

    def abort(self, messages) -> None:
        """Files that are there are whole, and the next run puts them there again."""


class FilesSource(DataSource):
    """Writes rows (file, content) as files of a folder (option path: a URI that every executor and the driver reach)."""

    @classmethod
    def name(cls) -> str:
        return "tagloom_files"

    def schema(self) -> str:
        return "file string, content binary"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Folder(self.options["path"])


def write_workbooks(spark: SparkSession, books: DataFrame, path: str) -> None:
    """Files of `workbooks` in the folder at a URI (file:, hdfs:, s3: ...); those of the same names are replaced."""
    spark.dataSource.register(FilesSource)
    books.select("file", "content").write.format("tagloom_files").mode("append").option("path", path).save()

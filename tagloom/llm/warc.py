"""WARC archives: written with segmented, chunked payloads and revisit records, and put together again.

Records are laid out as text rows whose line separator is the blank lines that end a record, so Spark's text writer makes
gzipped WARC 1.1 files in any store that Spark reaches; they are read as binary files and parsed by Content-Length.
A payload longer than a segment is framed in HTTP chunks and cut over a first record and continuation records, which carry
WARC-Segment-Origin-ID, WARC-Segment-Number and, on the last, WARC-Segment-Total-Length.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import new_folder, small_batches, staged

VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
#: A fixed date, so that archives of equal pages are equal.
DATE = b"2024-01-01T00:00:00Z"


def chunked(payload: bytes, size: int = 8192) -> bytes:
    """HTTP/1.1 chunked transfer framing."""
    out = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def dechunk(body: bytes) -> bytes:
    """Decode chunked framing; chunk extensions are skipped, trailers dropped; bad framing raises ValueError."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunked body ends in a size line")
        n = int(body[at:end].split(b";", 1)[0], 16)
        if n == 0:
            return b"".join(out)
        if len(body) < end + 4 + n or body[end + 2 + n : end + 4 + n] != b"\r\n":
            raise ValueError("chunk is cut short")
        out.append(body[end + 2 : end + 2 + n])
        at = end + 4 + n


def record(kind: str, ident: str, block: bytes, **more: str) -> bytes:
    """One record without the blank lines that end it."""
    head = [VERSION, b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: <" + ident.encode() + b">", b"WARC-Date: " + DATE]
    head += [b"WARC-" + k.replace("_", "-").encode() + b": " + v.encode("utf-8", "replace") for k, v in more.items()]
    head.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(head) + END + block


def _uri(url: str | None) -> str:
    return "".join(c for c in url or "about:blank" if c > " ") or "about:blank"


def response_records(key: str, url: str | None, payload: bytes, segment_bytes: int) -> list[bytes]:
    digest = hashlib.sha1(payload).hexdigest()
    long = len(payload) > segment_bytes
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (b"Transfer-Encoding: chunked" if long else b"Content-Length: %d" % len(payload)) + END
    block = head + (chunked(payload) if long else payload)
    named = {"Target_URI": _uri(url), "Payload_Digest": f"sha1:{digest}"}
    if not long:
        return [record("response", f"urn:page:{key}", block, **named)]
    parts = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    out = [record("response", f"urn:page:{key}", parts[0], **named, Segment_Number="1")]
    for k, part in enumerate(parts[1:], 2):
        last = {"Segment_Total_Length": str(len(block))} if k == len(parts) else {}
        out.append(record("continuation", f"urn:page:{key}:{k}", part, Segment_Origin_ID=f"<urn:page:{key}>", Segment_Number=str(k), **last))
    return out


def revisit_record(key: str, url: str | None, of: str, digest: str, size: int) -> bytes:
    """A revisit by identical payload digest; its block repeats the HTTP header, with the payload's length."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % size + END
    return record("revisit", f"urn:page:{key}", block, Target_URI=_uri(url), Profile="http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", Refers_To=f"<urn:page:{of}>", Payload_Digest=f"sha1:{digest}")


def parse(raw: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record in a stream of bytes."""
    buffer = bytearray()
    ended = False

    def more() -> None:
        nonlocal ended
        part = next(raw, None)
        if part is None:
            ended = True
        else:
            buffer.extend(part)

    while True:
        while (end := buffer.find(END)) < 0 and not ended:
            more()
        if end < 0:
            if buffer.strip():
                raise ValueError("a WARC header is cut short")
            return
        lines = bytes(buffer[:end]).split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        named = {k.strip().lower().decode(): v.strip().decode("utf-8", "replace") for k, _, v in (x.partition(b":") for x in lines[1:])}
        n = int(named["content-length"])
        while len(buffer) < end + 4 + n + 4 and not ended:
            more()
        if len(buffer) < end + 4 + n:
            raise ValueError("a WARC block is cut short")
        yield named, bytes(buffer[end + 4 : end + 4 + n])
        del buffer[: end + 8 + n]


def unzip(content: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The plain bytes of a file of gzip members, in parts of about `step` bytes; plain files come as they are."""
    if content[:2] != b"\x1f\x8b":
        for at in range(0, len(content), step):
            yield content[at : at + step]
        return
    rest = content
    while rest:
        z = zlib.decompressobj(31)
        data = rest
        while not z.eof:
            part = z.decompress(data, step)
            if part:
                yield part
            elif not z.unconsumed_tail:
                break
            data = z.unconsumed_tail
        if not z.eof:
            raise ValueError("a gzip member is cut short")
        rest = z.unused_data


def http_payload(block: bytes) -> bytes:
    head, _, body = block.partition(END)
    if b"transfer-encoding: chunked" in head.lower():
        return dechunk(body)
    return body


def assemble(parts: list[tuple[int, bytes, int | None]]) -> bytes:
    """A block from (segment number, block, total length or None) in any order; checks that none is missing and that the length is right. Equal repeated segments count once."""
    by = {}
    for n, block, _ in parts:
        if by.setdefault(n, block) != block:
            raise ValueError(f"two segments numbered {n} differ")
    if sorted(by) != list(range(1, len(by) + 1)):
        raise ValueError("segments are missing")
    whole = b"".join(by[n] for n in sorted(by))
    totals = {t for _, _, t in parts if t is not None}
    if totals != {len(whole)}:
        raise ValueError(f"segments have {len(whole)} bytes, the last record says {sorted(totals)}")
    return whole


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", segment_bytes: int = 16384, least_revisit: int = 1000, file_bytes: int = 32 << 20) -> None:
    """Archives of all rows of pages in the folder `path`.

    Null payloads are empty. Of rows with equal payloads of at least `least_revisit` bytes the one with the largest id is
    written whole and the others as revisits of it; repeated rows of that id are each written whole, once per row, and so
    are rows without an id. Every row has a record id of its own, made of its page id (or null) and a row number, so rows
    that share an id never share segments.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"), F.monotonically_increasing_id().alias("row"))
    size = F.octet_length("html").cast("long")
    marks = staged(rows.select("id", "row", "url", F.sha1(F.encode("html", "utf-8")).alias("digest"), size.alias("size")), "payloads")
    total = marks.agg(F.sum("size")).first()[0] or 0
    files = max(1, -(-int(total) // file_bytes))
    kept = marks.where(F.col("size") >= least_revisit).groupBy("digest").agg(F.max(F.struct("id", "row")).alias("of"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", F.col("of.id").alias("of"), F.col("of.row").alias("of_row"))
    revisits = staged(marks.join(kept, "digest").where(F.col("id") < F.col("of")).select("id", "row", "url", "of", "of_row", "digest", "size"), "revisits")
    gone = revisits.select("id", "digest").distinct()
    whole = rows.withColumn("digest", F.sha1(F.encode("html", "utf-8"))).join(gone, ["id", "digest"], "left_anti").select("id", "row", "url", "html") if not revisits.isEmpty() else rows
    out = pa.schema([("record", pa.binary())])
    key = lambda i, row: f"{'null' if i is None else i}:{row}"

    def responses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in small_batches(big, "html", 4 << 20):
                made = [r for i, n, u, h in zip(*(b.column(c).to_pylist() for c in ("id", "row", "url", "html")), strict=True) for r in response_records(key(i, n), u, h.encode("utf-8", "replace"), segment_bytes)]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], schema=out)

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [revisit_record(key(i, k), u, key(o, j), d, n) for i, k, u, o, j, d, n in zip(*(b.column(c).to_pylist() for c in ("id", "row", "url", "of", "of_row", "digest", "size")), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], schema=out)

    # a file for each task; tasks follow the input's splits, so files stay near their size
    both = whole.mapInArrow(responses, "record binary").unionAll(revisits.mapInArrow(others, "record binary"))
    options = {"lineSep": "\r\n\r\n", "compression": "gzip"}
    both.select(F.col("record").cast("string")).coalesce(max(files, int(spark.sparkContext.defaultParallelism))).write.options(**options).text(path)


def read(spark, path: str) -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to) for each page in the archives.

    Whole responses are decoded where they are read; segments are grouped by the record that they continue, ordered by
    number, checked against the total length and then decoded. A digest that doesn't fit its payload is an error. No files: no rows.
    """
    schema = "id long, origin string, segment int, total long, block binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    out = pa.schema([("id", pa.int64()), ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("block", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def number(uri: str) -> int | None:
        last = uri.strip("<>").split(":")[2]
        return None if last == "null" else int(last)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0

        def take() -> pa.RecordBatch:
            nonlocal rows, held
            made = pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*rows, strict=True), out, strict=True)], schema=out)
            rows, held = [], 0
            return made

        for b in batches:
            for k, content in enumerate(b.column("content").to_pylist()):
                for n, (head, block) in enumerate(parse(unzip(content))):
                    kind, digest = head["warc-type"], head.get("warc-payload-digest", "").removeprefix("sha1:")
                    if kind == "revisit":
                        size = int(block.partition(b"Content-Length: ")[2].split(b"\r\n")[0])
                        rows.append((number(head["warc-record-id"]), None, None, None, None, size, digest, kind, number(head["warc-refers-to"])))
                    elif "warc-segment-number" in head:
                        origin = head.get("warc-segment-origin-id", head["warc-record-id"])
                        total = head.get("warc-segment-total-length")
                        rows.append((number(origin), origin, int(head["warc-segment-number"]), total and int(total), block, None, digest or None, "segment", None))
                        held += len(block)
                    elif kind == "response":
                        payload = http_payload(block)
                        if (found := hashlib.sha1(payload).hexdigest()) != digest:
                            raise ValueError(f"{head['warc-record-id']}: payload digest {found}, header {digest}")
                        rows.append((number(head["warc-record-id"]), None, None, None, None, len(payload), digest, kind, None))
                    if held > 4 << 20 or len(rows) >= 10_000:
                        yield take()
        if rows:
            yield take()

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt*").load(path).select("content").mapInArrow(records, schema)
    all_rows = staged(found, "warc-records")
    parts = all_rows.where("record_type = 'segment'").groupBy("origin").agg(F.first("id").alias("id"), F.max("payload_digest").alias("payload_digest"), F.collect_list(F.struct("segment", "block", "total")).alias("parts"))
    end = pa.schema([("id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for i in range(b.num_rows):
                payload = http_payload(assemble([(p["segment"], p["block"], p["total"]) for p in b.column("parts")[i].as_py()]))
                digest = hashlib.sha1(payload).hexdigest()
                if digest != b.column("payload_digest")[i].as_py():
                    raise ValueError(f"{b.column('origin')[i]}: payload digest {digest} isn't the header's")
                made.append((b.column("id")[i].as_py(), len(payload), digest, "response", None))
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*made, strict=True), end, strict=True)], schema=end)

    names = ["id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    whole = parts.mapInArrow(join_up, "id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return all_rows.where("record_type <> 'segment'").select(*names).unionAll(whole.select(*names))


def round_trip(pages: DataFrame, **columns) -> DataFrame:
    """read(write(pages)) through a folder in the shared folder."""
    path = new_folder(pages.sparkSession, "warc")
    write(pages, path, **columns)
    return read(pages.sparkSession, path)

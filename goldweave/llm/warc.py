"""WARC archives: segmented, chunked records, and their reassembly.

Writing. Every page becomes a `response` record whose block is an HTTP head and
the payload in chunked transfer framing. Of pages with equal payloads the
smallest page_id is the response, the others are `revisit` records that refer
to it. Blocks longer than `segment_bytes` are cut: the first segment carries
WARC-Segment-Number 1, `continuation` records follow with the origin's id and
their number, the last with the total length. A record is version line, fields, block
and two line ends, as the standard has it. Archives are written by Spark's text
writer with these line ends as its line separator (gzip, many files, so no task
holds more than its rows); a block may hold anything.

Reading. Spark reads a file line by line in one task, and a walk over the lines
takes every block by its Content-Length, so a task holds one record, not a file.
WARC/1.0 and 1.1 of any writer are read. Continuations are grouped by origin,
ordered by number, checked against the total length, joined, and the chunked
framing is decoded; digests are checked on the way.

Defined results: a null payload is empty; empty payloads are payloads like all
others (of at least `revisit_bytes` = 0 bytes); all rows of the smallest page_id
with one payload are responses if that id is repeated; a null page_id is the
smallest; an empty table gives an empty archive and an empty result; further
columns are ignored. A record that is cut off, out of sequence, of the wrong
length or with a wrong digest is returned with `fault` set, never dropped; bytes
between records that belong to none are one record with a fault. Records without
a digest, or with one of another kind than SHA-1, are not checked against it.
Blocks of any length are segmented; a payload must fit a row (2 GB).
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha1
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.storage import written

VERSION = "WARC/1.1\r\n"
LINE_END = "\r\n"
RECORD_END = LINE_END * 2
ID = "urn:x-page:"
HTTP_OK = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
FAR_PAST = "1970-01-01T00:00:00Z"


@dataclass(frozen=True)
class Layout:
    segment_bytes: int = 16_384
    chunk_bytes: int = 4_096
    revisit_bytes: int = 0
    rows_per_file: int = 50_000


def digest_of(payload: bytes) -> str:
    return base64.b32encode(sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing."""
    parts = (payload[at:at + size] for at in range(0, len(payload), size))
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut off")
        out.append(body[at:at + size])
        at += size + 2


def write_archives(pages: DataFrame, folder: str, layout: Layout = Layout()) -> None:
    """Write the pages as .warc.gz files.

    Only digests are grouped and joined; combined before their shuffle, so one
    payload shared by a third of all pages makes no large group.
    """
    url = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", url.alias("url"), payload.alias("payload"), F.unhex(F.sha1(payload)).alias("sha"))
    slim = written(rows.select("page_id", "sha", F.octet_length("payload").alias("size")), "page-digests")
    first = (
        slim.filter(F.col("size") >= layout.revisit_bytes).groupBy("sha")
        .agg(F.count("*").alias("n"), F.min(F.struct("page_id")).alias("first"))
        .filter("n > 1").select("sha", F.col("first.page_id").alias("first_id"))
    )
    revisits = slim.select("page_id", "sha").distinct().join(first, "sha").filter(
        ~F.col("page_id").eqNullSafe(F.col("first_id"))
    ).select(F.col("page_id").alias("_page"), F.col("sha").alias("_sha"), "first_id", F.lit(True).alias("_revisit"))
    joined = rows.join(
        revisits, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("sha") == F.col("_sha")), "left",
    ).select("page_id", "url", "payload", F.coalesce("_revisit", F.lit(False)).alias("revisit"), "first_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            out: list[bytes] = []
            for page_id, url, payload, revisit, first_id in zip(*(c.to_pylist() for c in batch.columns)):
                row += 1
                name = f"{_spelled(page_id)}:{task}-{row}"
                out += records(name, url, payload, first_id if revisit else None, revisit, layout)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    lines = joined.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    (lines.write.option("lineSep", RECORD_END).option("compression", "gzip")
     .option("maxRecordsPerFile", layout.rows_per_file).text(folder))


def _spelled(page_id: object) -> str:
    return "" if page_id is None else quote(str(page_id), safe="")


def records(row_name: str, url: str | None, payload: bytes, first_id: object, revisit: bool,
            layout: Layout) -> list[bytes]:
    """The records of one row, without the line ends behind each. row_name is the page and the row that writes it: page ids may repeat."""
    digest = digest_of(payload)
    name = f"<{ID}{row_name}>"
    target = "".join(c for c in url or "urn:x-unknown" if c.isprintable() and c != " ")
    head = [("WARC-Record-ID", name), ("WARC-Date", FAR_PAST), ("WARC-Target-URI", target),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]

    def record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
        lines = [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))]
        return (VERSION + "".join(f"{k}: {v}\r\n" for k, v in lines)).encode() + b"\r\n" + block

    if revisit:
        block = HTTP_OK + b"Content-Length: %d\r\n\r\n" % len(payload)
        return [record("revisit", [
            *head, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<{ID}{_spelled(first_id)}>")], block)]
    block = HTTP_OK + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, layout.chunk_bytes)
    if len(block) <= layout.segment_bytes:
        return [record("response", head, block)]
    parts, at = [], 0
    while at < len(block):
        parts.append(block[at:at + layout.segment_bytes])
        at += layout.segment_bytes
    out = [record("response", [*head, ("WARC-Segment-Number", "1")], parts[0])]
    for n, part in enumerate(parts[1:], 2):
        fields = [("WARC-Record-ID", f"<{ID}{row_name}:{n}>"), ("WARC-Date", FAR_PAST),
                  ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", str(n))]
        if n == len(parts):
            fields.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(record("continuation", fields, part))
    return out


FIELDS = {
    "kind": "WARC-Type", "record_id": "WARC-Record-ID", "digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To",
    "origin": "WARC-Segment-Origin-ID", "number": "WARC-Segment-Number", "total": "WARC-Segment-Total-Length",
}
RECORD = pa.schema([*((c, pa.string()) for c in FIELDS), ("block", pa.binary()), ("fault", pa.string())])


class Walk:
    """Records out of the lines of one file after the other."""

    def __init__(self) -> None:
        self.file: int | None = None
        self.found: list[tuple] = []
        self.size = 0
        self._begin()

    def _begin(self) -> None:
        self.head: list[bytes] | None = None
        self.block: list[bytes] | None = None
        self.missing = 0

    def _emit(self, fault: str | None) -> None:
        fields: dict[str, str] = {}
        for line in self.head or []:
            name, _, value = line.partition(b":")
            fields[name.strip().decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
        block = b"".join(self.block or [])
        self.found.append((*(fields.get(n.lower()) for n in FIELDS.values()), block, fault))
        self.size += len(block)
        self._begin()

    def _header_ends(self) -> None:
        lengths = [line.partition(b":")[2].strip() for line in self.head if line.lower().startswith(b"content-length:")]
        self.block = []
        if not lengths or not lengths[0].isdigit():
            self._emit("no length")
            return
        self.missing = int(lengths[0])
        if not self.missing:
            self._emit(None)

    def line(self, file: int, line: bytes) -> None:
        if file != self.file:
            self.end()
            self.file = file
        if self.block is not None:
            if self.missing > len(line):
                self.block.append(line + b"\r\n")
                self.missing -= len(line) + 2
                if self.missing < 0:  # the block ends between the two bytes of the line end
                    self.block[-1] = self.block[-1][:self.missing]
                    self.missing = 0
                if not self.missing:
                    self._emit(None)
                return
            self.block.append(line[:self.missing])
            line = line[self.missing:]
            self._emit(None)
        if self.head is not None:
            if not line:
                self._header_ends()
            elif line[:1] in b" \t" and self.head:
                self.head[-1] += b" " + line.strip()
            else:
                self.head.append(line)
        elif line.startswith((b"WARC/1.0", b"WARC/1.1")):
            self.head = []
        elif line.strip():
            # neither a record nor the end of one
            if not (self.found and self.found[-1][-1] == "not a record"):
                self._emit("not a record")

    def end(self) -> None:
        if self.head is not None:
            self._emit("cut off")

    def taken(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in self.found], f.type) for k, f in enumerate(RECORD)], schema=RECORD)
        self.found, self.size = [], 0
        return out


def _whole_files(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of files, each file in one task. Compressed files are never split;
    for others a session is taken whose splits are larger than any file."""
    lines = spark.read.option("lineSep", LINE_END).option("ignoreCorruptFiles", True).text(folder)
    if any(not f.endswith((".gz", ".bz2", ".zst")) for f in lines.inputFiles()):
        other = spark.newSession()
        for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
            other.conf.set(key, spark.conf.get(key))
        for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
            other.conf.set(key, str(1 << 50))
        lines = other.read.option("lineSep", LINE_END).option("ignoreCorruptFiles", True).text(folder)
    return lines.select(
        F.xxhash64(F.col("_metadata.file_path")).alias("file"), F.col("value").cast("binary").alias("line"))


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: its fields, its block (binary) and what is wrong."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Walk()
        for batch in batches:
            for file, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                walk.line(file, line)
                if walk.size > 4 << 20:
                    yield walk.taken()
        walk.end()
        yield walk.taken()

    schema = ", ".join(f"{c} string" for c in FIELDS) + ", block binary, fault string"
    return _whole_files(spark, folder).mapInArrow(run, schema)


def reassemble(rows: DataFrame) -> DataFrame:
    """Records whole again: continuations joined to their origin in order."""
    number = F.coalesce(F.col("number").try_cast("int"), F.lit(0))
    segment = F.col("number").isNotNull() & F.coalesce("origin", "record_id").isNotNull()
    alone = rows.filter(~segment)
    parts = rows.filter(segment).groupBy(F.coalesce("origin", "record_id").alias("of")).agg(
        F.sort_array(F.collect_list(F.struct(
            number.alias("n"), F.col("kind"), "digest", "refers_to", F.col("total").try_cast("long").alias("total"),
            "block", "fault"))).alias("p"))
    block = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["block"]))
    numbers = F.transform("p", lambda x: x["n"])
    sound = (numbers == F.sequence(F.lit(1), F.size("p"))) & F.coalesce(
        F.element_at("p", -1)["total"] == F.octet_length(block), F.lit(False))
    joined = parts.select(
        F.get("p", F.lit(0))["kind"].alias("kind"), F.col("of").alias("record_id"),
        F.get("p", F.lit(0))["digest"].alias("digest"), F.get("p", F.lit(0))["refers_to"].alias("refers_to"),
        block.alias("block"), F.coalesce(
            F.get(F.filter(F.transform("p", lambda x: x["fault"]), lambda f: f.isNotNull()), F.lit(0)),
            F.when(~sound, F.lit("segments missing or of wrong length"))).alias("fault"))
    whole = alone.select("kind", "record_id", "digest", "refers_to", "block", "fault")
    return whole.unionByName(joined)


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """record_id, record_type, refers_to (record ids), payload (null for
    revisits), payload_bytes, payload_digest, fault: of responses, revisits and
    resources, and of whatever is broken."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads, sizes, found, faults = [], [], [], []
            for kind, digest, block, fault in zip(*(batch.column(k).to_pylist() for k in (0, 2, 4, 5))):
                head, _, body = block.partition(b"\r\n\r\n")
                lower = head.lower()
                said = (digest or "").removeprefix("sha1:")
                payload, size = None, None
                if kind == "revisit":
                    sizes_said = [x.partition(b":")[2].strip() for x in lower.split(b"\r\n") if x.startswith(b"content-length:")]
                    size = int(sizes_said[0]) if sizes_said and sizes_said[0].isdigit() else None
                elif kind == "response":
                    try:
                        payload = unchunked(body) if b"transfer-encoding: chunked" in lower else body
                        size = len(payload)
                        # some writers digest the body as it was sent
                        if (digest or "").startswith("sha1:") and said.upper() not in (digest_of(payload), digest_of(body)):
                            fault = fault or "wrong digest"
                        said = digest_of(payload)
                    except ValueError:
                        fault = fault or "broken chunk"
                elif kind == "resource":
                    payload, size, said = block, len(block), digest_of(block)
                payloads.append(payload)
                sizes.append(size)
                found.append(said)
                faults.append(fault)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(0), batch.column(3), pa.array(payloads, pa.binary()),
                 pa.array(sizes, pa.int64()), pa.array(found, pa.string()), pa.array(faults, pa.string())],
                names=["record_id", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest", "fault"])

    whole = reassemble(read_records(spark, folder)).select(
        "kind", "record_id", "digest", "refers_to", "block", "fault").filter(
        F.col("kind").isin("response", "revisit", "resource") | F.col("fault").isNotNull())
    return whole.mapInArrow(run, "record_id string, record_type string, refers_to string, payload binary, "
                                 "payload_bytes bigint, payload_digest string, fault string")


def page_of(record_id: Column, kind: str) -> Column:
    text = F.regexp_extract(record_id, f"^<{ID}([^:>]*)", 1)
    return F.when(text != "", F.url_decode(text)).cast(kind)

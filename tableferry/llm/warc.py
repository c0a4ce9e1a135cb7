"""WARC archives: written as one gzip stream per file, then normalised to one member per record.

``write_monolithic`` writes each partition of the records as one gzip stream (Spark's text writer
with the blank line between records as separator). ``normalise`` inflates each stream once, from
start to end, in pieces; every record becomes a gzip member of its own, and a sidecar index (JSON
lines, ``.cdxj``) holds the offset and length of each member. ``read_records`` seeks by the index.

A record holds the page's bytes, or refers to the record that does: of pages with equal payloads
of at least ``REVISIT_BYTES``, the one with the smallest page_id is ``response``, others are
``revisit`` without a payload. Smaller payloads are all ``response``.

Memory: a task holds one record and one read buffer. Recovery: a task writes under a name of its
own and moves the finished file to its place, so a repeated task leaves the same files.

Cases: null html is an empty payload; a null url has no target line; blanks and control signs in
a url are percent-encoded. Rows that repeat the owner's page_id are all responses. A null page_id
owns nothing unless all equal payloads have none, and is read back as null. No rows, no archives.
Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.session import new_folder

REVISIT_BYTES = 100
RECORDS_PER_FILE = 50_000
_BREAK = "\r\n"
_GAP = "\r\n\r\n"
_READ = 1 << 20
_LEVEL = 6

_INDEX = (
    "archive string, offset long, length long, type string, page_id long, refers_to long, "
    "digest string, payload_bytes long"
)


def marked(pages: DataFrame) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, record_type and refers_to of each page."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("html").cast("long"), "payload_digest": F.sha2("html", 256)})
    keys = pages.select(F.col("page_id").cast("long").alias("page_id"), html.alias("html"))
    owners = (
        keys.where(F.octet_length("html") >= REVISIT_BYTES)
        .groupBy(F.sha2("html", 256).alias("payload_digest"))
        .agg(F.min("page_id").alias("owner"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    revisit = F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))
    return rows.join(owners, "payload_digest", "left").select(
        "page_id",
        "url",
        "html",
        "payload_bytes",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("owner")).alias("refers_to"),
    )


def record_text(rows: DataFrame, date: str = "1970-01-01T00:00:00Z"):
    """The text of one WARC record, without the blank line after it."""

    def line(name: str, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit(_BREAK))

    def urn(column):
        return F.concat(F.lit("<urn:page:"), F.coalesce(column.cast("string"), F.lit("none")), F.lit(">"))

    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_BREAK}Content-Type: text/html; charset=utf-8{_BREAK}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(_GAP),
        F.col("html"),
    )
    block = F.when(revisit, F.lit("")).otherwise(http)
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    head = F.concat(
        F.lit(f"WARC/1.1{_BREAK}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        F.when(revisit, line("WARC-Refers-To", urn(F.col("refers_to")))).otherwise(F.lit("")),
        F.when(revisit, line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(_BREAK),
    )
    return F.concat(head, block)


def write_monolithic(rows: DataFrame, folder: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write the records of ``rows`` (as ``marked`` gives them), one gzip stream per file."""
    (
        rows.select(record_text(rows).alias("value"))
        .write.option("lineSep", _GAP)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .text(folder)
    )


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file:///"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path)


def inflated(stream):
    """Pieces of the bytes of a gzip stream of any number of members."""
    engine = zlib.decompressobj(31)
    while data := stream.read(_READ):
        while data:
            piece = engine.decompress(data, _READ)
            if piece:
                yield piece
            if engine.eof:
                data, engine = engine.unused_data, zlib.decompressobj(31)
            else:
                data = engine.unconsumed_tail
    if rest := engine.flush():
        yield rest


def parsed(pieces):
    """(headers, whole record) of every record of a WARC byte stream, one at a time."""
    held, pieces = bytearray(), iter(pieces)

    def more(n: int) -> bool:
        while len(held) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while more(4):
        at = 0
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            at = max(0, len(held) - 3)
            if not more(len(held) + 1):
                raise ValueError("a WARC header has no end")
        headers = header_lines(bytes(held[:end]))
        size = end + 4 + int(headers["content-length"]) + 4
        if not more(size):
            raise ValueError("a WARC record is cut off")
        yield headers, bytes(held[:size])
        del held[:size]


def header_lines(head: bytes) -> dict[str, str]:
    """Names, lower-case, and values of a WARC header."""
    lines = head.decode("utf-8", "replace").split(_BREAK)
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:])}


def _page(urn: str | None) -> int | None:
    value = urn.removeprefix("<urn:page:").removesuffix(">") if urn else "none"
    return None if value == "none" else int(value)


def rewrite(source: str, target: str, remove: bool = False) -> int:
    """Normalise one archive; returns its records. The index is moved to its place last; where it
    is there already, an earlier attempt of the task has done the work. ``remove`` then deletes
    the stream."""
    system, path = _file_system(source)
    out_system, out = _file_system(target)
    if out_system.get_file_info(f"{out}.cdxj").type == fs.FileType.File:
        with out_system.open_input_stream(f"{out}.cdxj", compression=None) as index:
            return index.read().count(b"\n")
    own = uuid.uuid4().hex
    offset = records = 0
    with (
        system.open_input_stream(path, compression=None) as stream,
        out_system.open_output_stream(f"{out}.{own}", compression=None) as archive,
        out_system.open_output_stream(f"{out}.cdxj.{own}", compression=None) as index,
    ):
        for headers, record in parsed(inflated(stream)):
            engine = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
            member = engine.compress(record) + engine.flush()
            archive.write(member)
            entry = {
                "archive": target, "offset": offset, "length": len(member), "type": headers["warc-type"],
                "page_id": _page(headers["warc-record-id"]), "refers_to": _page(headers.get("warc-refers-to")),
                "digest": headers["warc-payload-digest"], "payload_bytes": int(headers["x-payload-length"]),
            }
            index.write(json.dumps(entry).encode() + b"\n")
            offset += len(member)
            records += 1
    out_system.move(f"{out}.{own}", out)
    out_system.move(f"{out}.cdxj.{own}", f"{out}.cdxj")
    if remove:
        system.delete_file(path)
    return records


def normalise(spark: SparkSession, folder: str, target: str, remove: bool = False) -> int:
    """Rewrite every archive of ``folder`` into ``target``, one task each; returns the records.
    With ``remove`` each stream is deleted once it is rewritten, so the two copies of the corpus
    never stand side by side."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path")
    files = listed.count()
    system, path = _file_system(target)
    system.create_dir(path, recursive=True)

    def run(batches):
        for batch in batches:
            for source in batch.column(0).to_pylist():
                name = source.rsplit("/", 1)[-1].replace(".txt.gz", ".warc.gz")
                n = rewrite(source, f"{target}/{name}", remove)
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["records"])

    done = listed.repartition(max(1, files)).mapInArrow(run, "records long")
    return done.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("n")).first()["n"]


def index_of(spark: SparkSession, folder: str) -> DataFrame:
    """The sidecar indexes of a folder of normalised archives."""
    return spark.read.schema(_INDEX).option("pathGlobFilter", "*.cdxj").json(folder)


def read_records(index: DataFrame) -> DataFrame:
    """One row per index entry, read from its member: page_id, payload_bytes, payload_digest,
    record_type, refers_to. A payload that does not match its header raises."""

    def run(batches):
        archive, stream = None, None
        for batch in batches:
            rows = []
            for entry in batch.to_pylist():
                if entry["archive"] != archive:
                    if stream is not None:
                        stream.close()
                    archive = entry["archive"]
                    system, path = _file_system(archive)
                    stream = system.open_input_file(path)
                stream.seek(entry["offset"])
                record = zlib.decompress(stream.read(entry["length"]), 31)
                headers, _ = next(parsed([record]))
                page, refers = _page(headers["warc-record-id"]), _page(headers.get("warc-refers-to"))
                kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha256:")
                size = int(headers["x-payload-length"])
                if kind == "response":
                    body = record.split(b"\r\n\r\n", 2)[2][:-4]
                    if len(body) != size or hashlib.sha256(body).hexdigest() != digest:
                        raise ValueError(f"page {page}: the payload is not the one its header states")
                rows.append((page, size, digest, kind, refers))
            if rows:
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                    ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                )
        if stream is not None:
            stream.close()

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return index.mapInArrow(run, schema)


def archived(pages: DataFrame) -> DataFrame:
    """Write the pages, normalise the archives, and read every record back by the index."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write_monolithic(marked(pages), f"{folder}/streams")
    normalise(spark, f"{folder}/streams", f"{folder}/records", remove=True)
    return read_records(index_of(spark, f"{folder}/records"))

"""WARC archives with a two-level capture index: sparse directory, compressed sorted blocks."""

from __future__ import annotations

import bisect
import gzip
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm.common import quoted, shared_path, stored

#: Payloads below this are never deduplicated.
LEAST_REVISIT = 100
#: Bytes of payload and most records aimed at in an archive file.
FILE_BYTES, FILE_RECORDS = 16 << 20, 8192
#: Captures of an index block, and of an index part at least; parts at most.
BLOCK_LINES, PART_LINES, PARTS = 512, 8192, 1 << 16
DATE = "2024-01-01T00:00:00Z"
#: An empty gzip member stands between the members of the records.
BETWEEN = gzip.compress(b"", mtime=0)


@dataclass(frozen=True)
class Archive:
    """Folders of an archive: its files, the index blocks and the directory of the blocks."""

    files: str
    blocks: str
    directory: str

BLOCK = "first string, last string, lines long, data binary, part int"


def target(url: str | None) -> str:
    """The URL as a header can hold it: blanks and controls escaped, null empty."""
    return quote(url or "", safe="".join(map(chr, range(33, 127))), errors="surrogatepass")


def url_key(url: str | None) -> str:
    """Sort key: host parts reversed, then path and query; no scheme, port 80/443, user or fragment.

    ``http://www.Example.com:80/a?b#c`` gives ``com,example)/a?b``.  What is no URL is its own key.
    """
    text = target(url)
    try:
        parts = urlsplit(text)
        host, port = (parts.hostname or "").strip("."), parts.port
    except ValueError:
        return text
    if not host:
        return text
    names = host.split(".")
    if names[0] == "www" and len(names) > 2:
        names = names[1:]
    where = "" if port in (None, 80, 443) else f":{port}"
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(names))}{where}){parts.path or '/'}{query}"


def capture_key(url: str | None, page: object) -> str:
    """Key of one capture: the URL's key, a blank, and the page's id so that ids sort as numbers."""
    if page is None:
        return f"{url_key(url)} -"
    return f"{url_key(url)} {int(page) + (1 << 63):020d}"


def record(page: object, url: str | None, html: bytes, digest: str, original: object) -> bytes:
    """One WARC record as a gzip member of its own."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n".encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if original is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page is None else page}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target(url)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if original is not None:
        head += [
            f"WARC-Refers-To: <urn:x-page:{original}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    block = http if original is not None else http + html
    head += [f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(head).encode() + block + b"\r\n\r\n", 6, mtime=0)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and payload, which a revisit has none of."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(headers["content-length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def members(data: memoryview) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of each gzip member that holds something."""
    at = 0
    while at < len(data):
        opened, pos, out = zlib.decompressobj(31), at, []
        while not opened.eof:
            if pos >= len(data):
                raise ValueError("archive file ends inside a record")
            out.append(opened.decompress(data[pos : pos + 65536]))
            pos = min(pos + 65536, len(data))
        end = pos - len(opened.unused_data)
        if content := b"".join(out):
            yield at, end - at, content
        at = end


def _page(text: str) -> int | None:
    number = text.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def write_archive(pages: DataFrame, *, id_col: str, url_col: str, html_col: str) -> str:
    """A record per row of ``pages`` in gzipped WARC files; returns their folder.

    Of equal payloads of LEAST_REVISIT bytes or more the one with the smallest id is written whole
    and the others refer to it.
    """
    html = F.coalesce(quoted(html_col).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(
        quoted(id_col).cast("long").alias("page"), quoted(url_col).cast("string").alias("url"), html.alias("html")
    ).withColumn("digest", F.sha2("html", 256))
    sizes = rows.select("page", "digest", F.octet_length("html").alias("n"))
    total, count = sizes.agg(F.sum("n"), F.count(F.lit(1))).first()
    each = max(1, min(FILE_RECORDS, int(FILE_BYTES * (count or 1) / max(1, total or 0))))
    shared = sizes.where(F.col("n") >= LEAST_REVISIT).groupBy("digest").agg(
        F.min("page").alias("first"), F.count(F.lit(1)).alias("copies")
    )
    shared = shared.where("copies > 1").select("digest", "first")
    marked = rows.join(shared, "digest", "left")
    original = F.when(~F.col("page").eqNullSafe(F.col("first")), F.col("first"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                out = [
                    record(r["page"], r["url"], r["html"], r["digest"], r["original"])
                    for r in whole.slice(at, 256).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    archive = shared_path(pages.sparkSession, "warc")
    (
        marked.select("page", "url", "html", "digest", original.alias("original"))
        .mapInArrow(run, "value binary")
        .select(F.col("value").cast("string"))
        .write.option("lineSep", BETWEEN.decode("latin-1"))
        .option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", each)
        .text(archive)
    )
    return archive


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).select("path", "content")


def captures(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the archive files: ``key, path, start, length``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                keys, starts, lengths = [], [], []
                for start, length, data in members(memoryview(content.as_buffer())):
                    headers, _ = parse(data)
                    keys.append(capture_key(headers["warc-target-uri"], _page(headers["warc-record-id"])))
                    starts.append(start)
                    lengths.append(length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()), pa.array([path.as_py()] * len(keys), pa.string()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())],
                    names=["key", "path", "start", "length"],
                )

    return _files(spark, folder).mapInArrow(run, "key string, path string, start long, length long")


def build_index(spark: SparkSession, folder: str) -> Archive:
    """Sorted captures in compressed blocks, and a directory of the first and last key of each."""
    found = stored(captures(spark, folder), "warc-captures")
    parts = max(1, min(PARTS, found.count() // PART_LINES))
    ordered = found.repartitionByRange(parts, "key", "path", "start").sortWithinPartitions("key", "path", "start")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(lines: list[tuple]) -> dict:
            text = "\n".join("\t".join(map(str, x)) for x in lines)
            return {"first": lines[0][0], "last": lines[-1][0], "lines": len(lines), "data": zlib.compress(text.encode())}

        held: list[tuple] = []
        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            full = len(held) // BLOCK_LINES * BLOCK_LINES
            out = [block(held[i : i + BLOCK_LINES]) for i in range(0, full, BLOCK_LINES)]
            held = held[full:]
            if out:
                yield pa.RecordBatch.from_pylist(out)
        if held:
            yield pa.RecordBatch.from_pylist([block(held)])

    blocks = ordered.mapInArrow(run, BLOCK.removesuffix(", part int"))
    archive = Archive(folder, shared_path(spark, "warc-blocks"), shared_path(spark, "warc-directory"))
    blocks.withColumn("part", F.spark_partition_id()).write.parquet(archive.blocks)
    written = spark.read.schema(BLOCK).parquet(archive.blocks)
    written.groupBy("part").agg(F.min("first").alias("first"), F.max("last").alias("last")).write.parquet(
        archive.directory
    )
    return archive


def lookup(spark: SparkSession, archive: Archive, wanted: DataFrame) -> DataFrame:
    """Captures of ``wanted`` (``url``, ``page``): ``key, path, start, length``, repeats included.

    The directory (a first and last key for each part, PARTS at most) names the parts a key can be
    in.  In a part the blocks are searched by bisection of their first keys, and only blocks that
    can hold the key are inflated.
    """
    directory = sorted((r["first"], r["last"], r.part) for r in spark.read.schema("first string, last string, part int").parquet(archive.directory).collect())
    shared = spark.sparkContext.broadcast(directory)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = [x[0] for x in shared.value]
        for batch in batches:
            keys, parts = [], []
            for url, page in zip(*(batch.column(c).to_pylist() for c in ("url", "page")), strict=True):
                key = capture_key(url, page)
                at = bisect.bisect_right(firsts, key)
                while at and shared.value[at - 1][1] >= key:  # a key may go over several parts
                    keys.append(key)
                    parts.append(shared.value[at - 1][2])
                    at -= 1
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(parts, pa.int32())], names=["key", "part"])

    def search(keys: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values(["first", "last"], kind="stable").reset_index(drop=True)
        firsts, lasts, out, inflated = blocks["first"].tolist(), blocks["last"].tolist(), [], {}
        for key in sorted(keys["key"]):
            at = bisect.bisect_right(firsts, key) - 1
            while at >= 0 and lasts[at] >= key:
                if at not in inflated:
                    if len(inflated) > 8:
                        inflated.clear()
                    lines = zlib.decompress(blocks["data"][at]).decode().split("\n")
                    inflated[at] = ([x.partition("\t")[0] for x in lines], lines)
                names, lines = inflated[at]
                for i in range(bisect.bisect_left(names, key), bisect.bisect_right(names, key)):
                    out.append(lines[i].split("\t"))
                at -= 1
        found = pd.DataFrame(out, columns=["key", "path", "start", "length"])
        return found.astype({"start": "int64", "length": "int64"})

    placed = wanted.select("url", "page").distinct().mapInArrow(place, "key string, part int")
    blocks = spark.read.schema(BLOCK).parquet(archive.blocks).select("part", "first", "last", "data")
    return (
        placed.distinct()
        .groupBy("part")
        .cogroup(blocks.groupBy("part"))
        .applyInPandas(search, "key string, path string, start long, length long")
    )


def read_records(spark: SparkSession, archive: Archive, found: DataFrame) -> DataFrame:
    """The records at the places ``found``: ``page, url, type, digest, refers_to, payload``."""
    ranges = found.groupBy("path").agg(F.collect_list(F.struct("start", "length")).alias("ranges"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, places in zip(batch.column("content"), batch.column("ranges"), strict=True):
                data, out = memoryview(content.as_buffer()), []
                for r in places.as_py():
                    headers, payload = parse(gzip.decompress(data[r["start"] : r["start"] + r["length"]]))
                    refers = headers.get("warc-refers-to")
                    out.append(
                        {
                            "page": _page(headers["warc-record-id"]),
                            "url": headers["warc-target-uri"],
                            "type": headers["warc-type"],
                            "digest": headers["warc-payload-digest"].removeprefix("sha256:"),
                            "refers_to": _page(refers) if refers else None,
                            "payload": payload if refers is None else None,
                        }
                    )
                    if len(out) == 512:
                        yield pa.RecordBatch.from_pylist(out, schema=RECORD)
                        out = []
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=RECORD)

    return _files(spark, archive.files).join(ranges, "path").select("content", "ranges").mapInArrow(
        run, "page long, url string, type string, digest string, refers_to long, payload binary"
    )


RECORD = pa.schema(
    [("page", pa.int64()), ("url", pa.string()), ("type", pa.string()), ("digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
)


def round_trip(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Writes ``pages`` to an archive, indexes it, looks every page up and reads its record.

    Per page: ``page_id, payload_bytes, payload_digest, record_type, refers_to``; size and digest
    of a response are taken from the payload read back, those of a revisit from the record it
    refers to.  A digest that differs from its record's header fails the read.

    A null payload is empty.  A null or malformed URL is its own key.  A row without an id is no
    record's original; it revisits one with an id, else it is a response.  Rows that repeat an id
    are records each; with the smallest id of their payload they are all responses.  Other columns
    are not read.  An empty table gives no rows.
    """
    spark = pages.sparkSession
    folder = write_archive(pages, id_col=id_col, url_col=url_col, html_col=html_col)
    archive = build_index(spark, folder)
    wanted = pages.select(quoted(url_col).cast("string").alias("url"), quoted(id_col).cast("long").alias("page"))
    records = read_records(spark, archive, lookup(spark, archive, wanted))
    read = F.sha2("payload", 256)
    checked = F.when(F.col("payload").isNull() | (read == F.col("digest")), F.col("digest")).otherwise(
        F.raise_error(F.lit("payload differs from its digest"))
    )
    back = stored(
        records.select(
            "page", "type", "refers_to", checked.alias("digest"), F.octet_length("payload").cast("long").alias("n")
        ),
        "warc-records",
    )
    originals = (
        back.where("type = 'response'")
        .groupBy("page", "digest")
        .agg(F.first("n").alias("full"))
        .select(F.col("page").alias("refers_to"), "digest", "full")
    )
    whole = back.where("type = 'revisit'").join(originals, ["refers_to", "digest"])
    shown = ["page", "full", "digest", "type", "refers_to"]
    rows = back.where("type = 'response'").withColumn("full", F.col("n")).select(shown).union(whole.select(shown))
    return rows.select(
        F.col("page").alias("page_id"),
        F.col("full").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        "refers_to",
    )

"""WARC archives with the index first: write where every record lies, then read by coalesced byte ranges.

``write_archives`` writes one record per page into compressed archives, each record
a gzip member of its own, and an index row per record: archive, offset, length,
URL, digest, kind and id. ``read_records`` takes index rows, all or a selection:
it sorts them by place, joins neighbours that lie close together into one byte
range, and reads each range once.

Of records with equal payloads (SHA-256) of at least ``revisit_bytes`` the one with the
largest page_id is a response; the others are revisits that name it and carry its
headers only. Smaller ones are all responses.

Scale: payloads are shuffled once at most, to meet the responses that others
revisit; Spark broadcasts these where they are small. Copies are dealt over
``SALTS`` parts by page, so a hot payload is no task's alone. A task streams its
records into archives of its own, named anew in each attempt; the index is a
Parquet table, so it names the archives of committed tasks only, and a lost
task's archive is never read. Readers are dealt blocks of archives, so a large
archive has many readers. A record is held whole in memory.

Archives go to a folder that all executors share, by path or URI.

Defined results: a null html is an empty payload; rows with a null page_id are
never named by others, and are revisits where a copy has an id; rows that repeat
the largest page_id with an equal payload are all responses; a null url has no
target; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.session import work_dir

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 1 << 30
SALTS = 8
#: Records this close together are read in one range, up to the size of one read.
GAP_BYTES, READ_BYTES = 1 << 16, 1 << 23
BLOCK_BYTES = 64 << 20
BATCH_BYTES = 1 << 22
#: Pages carry no time of their own.
DATE = "1970-01-01T00:00:00Z"
#: Names and values of the format (fixed values).
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

INDEX_SCHEMA = (
    "archive string, offset long, length long, url string, digest string, record_type string, page_id long, "
    "refers_to long, payload_bytes long"
)
RECORD_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "payload binary"
)
_KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")))
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(v), _KINDS[k]) for v, k in zip(columns, kinds)], list(names))


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def target_uri(url: str) -> str:
    """The URL in a header line: bytes other than visible ASCII are percent-encoded."""
    return "".join(chr(b) if 0x21 <= b <= 0x7E else f"%{b:02X}" for b in url.encode())


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(
    page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers: tuple | None = None
) -> bytes:
    """One record, uncompressed; ``refers`` (page_id, url) makes it a revisit without payload."""
    sha1 = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    block = HTTP.format(size).encode() + (b"" if refers else payload or b"")
    lines = [VERSION, f"WARC-Type: {'revisit' if refers else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {target_uri(url)}")
    if refers:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers[0])}"]
        if refers[1] is not None:
            lines.append(f"WARC-Refers-To-Target-URI: {target_uri(refers[1])}")
    lines += [f"WARC-Payload-Digest: {sha1}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def archive_head(name: str) -> bytes:
    block = b"software: oreflow\r\nformat: WARC File Format 1.1\r\n"
    lines = [VERSION, "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {DATE}",
             f"WARC-Filename: {name}", "Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}


def _id_of(value: str) -> int | None:
    number = value.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def read_record(data: bytes) -> tuple:
    """The row of ``RECORD_SCHEMA`` that a record's bytes tell; its lengths and digest are checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    names = _headers(head)
    size = int(names["content-length"])
    block = rest[:size]
    if not head.startswith(VERSION.encode()) or rest[size:] != b"\r\n\r\n":
        raise ValueError("not one whole record")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(_headers(http)["content-length"])
    digest = base64.b32decode(names["warc-payload-digest"].removeprefix("sha1:")).hex()
    kind = names["warc-type"]
    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {names['warc-record-id']} is not the one that was written")
    refers = _id_of(names["warc-refers-to"]) if kind == "revisit" else None
    return (
        _id_of(names["warc-record-id"]), names.get("warc-target-uri"), kind, refers, length, digest,
        payload if kind == "response" else None,
    )


def _write(batches: Iterable[pa.RecordBatch], folder: str, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    system, root = _place(folder)
    file, name, place, rows = None, "", 0, []
    try:
        for batch in batches:
            columns = [batch.column(x) for x in ("page_id", "url", "payload", "payload_bytes", "digest", "keeper")]
            for i in range(batch.num_rows):
                page_id, url, payload, size, digest, keeper = (c[i].as_py() for c in columns)
                if file is None:
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    file = system.open_output_stream(f"{root}/{name}", compression=None)
                    head = member(archive_head(name))
                    file.write(head)
                    place = len(head)
                refers = (keeper["page_id"], keeper["url"]) if keeper else None
                data = member(record(page_id, url, payload, size, digest, refers))
                file.write(data)
                kind = "revisit" if refers else "response"
                rows.append((name, place, len(data), url, digest, kind, page_id, refers[0] if refers else None, size))
                place += len(data)
                if place >= archive_bytes:
                    file.close()
                    file = None
            if len(rows) >= 10_000:
                yield _batch(rows, INDEX_SCHEMA)
                rows = []
    finally:
        if file is not None:
            file.close()
    if rows:
        yield _batch(rows, INDEX_SCHEMA)


def with_keepers(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Pages with digest, and ``keeper``: the response that a page with an equal payload revisits, else null.

    The payload of a page with a keeper is null.
    """
    html = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload"),
    ).withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    large = F.col("payload_bytes") >= revisit_bytes
    # copies are counted by a digest beyond forgery
    rows = rows.withColumn("same", F.when(large, F.sha2("payload", 256)))
    copies = (
        rows.filter(large).groupBy("same")
        .agg(F.max(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("keeper"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND keeper IS NOT NULL")
        .select("same", "keeper", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt"))
    )
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
    joined = rows.withColumn("salt", salt).join(copies, ["same", "salt"], "left")
    is_copy = F.coalesce(~F.col("keeper.page_id").eqNullSafe(F.col("page_id")) & F.col("keeper").isNotNull(), F.lit(False))
    return joined.select(
        "page_id", "url", F.when(~is_copy, F.col("payload")).alias("payload"), "payload_bytes", "digest",
        F.when(is_copy, F.col("keeper")).alias("keeper"),
    )


def write_archives(
    pages: DataFrame, folder: str, revisit_bytes: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Writes the archives and ``index`` below ``folder`` and returns the index."""
    system, root = _place(folder)
    system.create_dir(f"{root}/archives", recursive=True)
    rows = with_keepers(pages, revisit_bytes)
    index = rows.mapInArrow(lambda batches: _write(batches, f"{folder}/archives", archive_bytes), INDEX_SCHEMA)
    index.write.parquet(f"{folder}/index")
    return read_index(pages.sparkSession, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")


def coalesce_ranges(
    offsets: np.ndarray, lengths: np.ndarray, gap: int = GAP_BYTES, most: int = READ_BYTES
) -> list[tuple[int, int, int, int]]:
    """Ranges (low, high, first, last) that cover records sorted by offset; ``first:last`` are a range's records.

    A record joins the range before it if it starts at most ``gap`` bytes behind its
    end and the range stays within ``most`` bytes. A larger record is a range of its own.
    """
    out: list[tuple[int, int, int, int]] = []
    for i, (low, size) in enumerate(zip(offsets.tolist(), lengths.tolist())):
        if out and low - out[-1][1] <= gap and max(low + size, out[-1][1]) - out[-1][0] <= most:
            out[-1] = (out[-1][0], max(low + size, out[-1][1]), out[-1][2], i + 1)
        else:
            out.append((low, low + size, i, i + 1))
    return out


def _read(batches: Iterable[pa.RecordBatch], folder: str, with_payload: bool) -> Iterator[pa.RecordBatch]:
    system, root = _place(folder)
    file, opened, rows, held = None, None, [], 0
    try:
        for batch in batches:
            names = batch.column("archive").to_pylist()
            offsets, lengths = (batch.column(x).to_numpy() for x in ("offset", "length"))
            edges = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            for first, last in zip(edges, edges[1:]):
                if first == last:
                    continue
                if names[first] != opened:
                    if file is not None:
                        file.close()
                    file, opened = system.open_input_file(f"{root}/{names[first]}"), names[first]
                for low, high, a, b in coalesce_ranges(offsets[first:last], lengths[first:last]):
                    data = memoryview(file.read_at(high - low, low))
                    for i in range(first + a, first + b):
                        start = int(offsets[i]) - low
                        row = read_record(zlib.decompress(data[start : start + int(lengths[i])], 31))
                        rows.append(row if with_payload else (*row[:-1], None))
                        held += 200 + (len(row[-1] or b"") if with_payload else 0)
                        if held > BATCH_BYTES:
                            yield _batch(rows, RECORD_SCHEMA)
                            rows, held = [], 0
    finally:
        if file is not None:
            file.close()
    if rows:
        yield _batch(rows, RECORD_SCHEMA)


def read_records(selected: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that index rows name, read from the archives below ``folder``; payloads of responses on request."""
    places = selected.select("archive", "offset", "length").distinct()
    block: Column = F.floor(F.col("offset") / BLOCK_BYTES)
    dealt = places.repartition(F.col("archive"), block).sortWithinPartitions("archive", "offset")
    return dealt.mapInArrow(lambda batches: _read(batches, f"{folder}/archives", with_payload), RECORD_SCHEMA)


def write_and_read(pages: DataFrame) -> DataFrame:
    """All pages written to a fresh shared folder and read back by the index."""
    folder = work_dir(pages.sparkSession, "warc")
    index = write_archives(pages, folder)
    return read_records(index, folder, with_payload=False)


WARC_SQL = f"""
WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
copies AS (
    SELECT payload, max(page_id) AS keeper FROM payloads WHERE octet_length(payload) >= {REVISIT_BYTES}
    GROUP BY 1 HAVING count(*) > 1 AND max(page_id) IS NOT NULL
), judged AS (
    SELECT page_id, p.payload, keeper, keeper IS NOT NULL AND page_id IS DISTINCT FROM keeper AS revisit
    FROM payloads p LEFT JOIN copies c ON p.payload = c.payload
)
SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN revisit THEN keeper END AS refers_to
FROM judged
"""

"""WARC archives: index first, then coalesced byte-range reads.

``write`` stores one record per page in gzipped WARC files, a member each, and
returns the index: file, offset, length, URL and digest of every record. Of the
pages with equal payloads the one with the largest id is stored in full, the
others as revisit records that refer to it. ``read`` takes index rows - all or
selected ones -, cuts every file into stretches, sorts a stretch's records by
offset and joins neighbouring ranges into single reads.

Scale: equal payloads meet by digest on narrow rows; the largest id of a digest
is summed before the shuffle and written, so that the join back has two plain
tables and can split a payload that very many pages share. A task writes its
own file under a name that no other attempt has; what an attempt wrote counts
only through index rows, which Spark commits once. Files lie in the shared
checkpoint folder (local, HDFS, S3 or GCS paths, by pyarrow).

Defined results: null html is an empty payload; a null URL is stored as
``urn:page``; a null id counts as smaller than any other; of repeated rows with the largest id one is the
response; an empty table gives no files and no rows; extra columns are ignored.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textguard.llm.common import fields, numbered, pin
from textguard.session import ensure_checkpoint_dir

#: Bytes of a stretch (one task row of a read), and the gap that a read may bridge.
STRETCH, GAP = 8 << 20, 64 << 10
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = fields(file="string", offset="long", length="long", url="string", digest="string", record_id="string", record_type="string", refers_to="string", page_id="long")
READ = fields(page_id="long", record_id="string", record_type="string", refers_to="string", digest="string", payload="binary")


def _filesystem(uri: str):
    """(pyarrow filesystem, path) of a URI or a local path."""
    import re

    from pyarrow import fs

    uri = re.sub(r"^file:/+", "/", uri)
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def _base32(hex_digest: str) -> str:
    import base64

    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record(record_id: str, kind: str, url: str | None, digest: str, page_id: int | None, refers_to: str | None, payload: bytes, level: int = 4) -> bytes:
    """One gzip member with one WARC record; a revisit stores no payload."""
    import gzip

    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if kind == "response":
        block += payload
    # A header is one line: a URL's line ends are escaped.
    target = (url if url is not None else "urn:page").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
        *([f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {PROFILE}"] if refers_to else []),
        *([f"X-Page-Id: {page_id}"] if page_id is not None else []), f"Content-Length: {len(block)}",
    ]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", level, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload (what follows the HTTP head) of one gzip member."""
    import gzip

    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def write(pages: DataFrame, least_bytes: int = 0, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the archives and return their index (see INDEX), pinned.

    Payloads under ``least_bytes`` are stored in full each time."""
    spark = pages.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc/{uuid.uuid4().hex}"
    full = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    full = numbered(full, "uid")
    narrow = pin(full.select("uid", "page_id", F.sha1(F.encode("html", "UTF-8")).alias("sha1"), F.octet_length("html").alias("size")), "warc-digests")
    first = narrow.filter(F.col("size") >= least_bytes).groupBy("sha1", "size").agg(F.max(F.struct("page_id", "uid")).alias("top"))
    decided = narrow.join(pin(first, "warc-responses"), ["sha1", "size"], "left").select("uid", "sha1", F.coalesce(F.col("top.uid"), F.col("uid")).alias("response"))
    run_id = uuid.uuid4().hex

    def store(batches):
        import uuid as u

        name = lambda n: f"<urn:uuid:{u.uuid5(u.UUID(run_id), n.hex())}>"
        fs, path = _filesystem(folder)
        out, file, at = None, "", 0
        for b in batches:
            rows = {f.name: [] for f in INDEX}
            for page_id, target, body, uid, sha1, response in zip(*(b.column(i).to_pylist() for i in range(6))):
                if out is None:
                    file = f"{u.uuid4().hex}.warc.gz"
                    fs.create_dir(path, recursive=True)
                    out = fs.open_output_stream(f"{path}/{file}", compression=None)  # members are gzipped already
                digest, kind = _base32(sha1), "response" if response == uid else "revisit"
                refers_to = None if kind == "response" else name(response)
                member = record(name(uid), kind, target, digest, page_id, refers_to, body.encode())
                out.write(member)
                for c, v in zip(INDEX.names, (f"{folder}/{file}", at, len(member), target, digest, name(uid), kind, refers_to, page_id)):
                    rows[c].append(v)
                at += len(member)
            yield pa.RecordBatch.from_pydict(rows, schema=_arrow(INDEX))
        if out is not None:
            out.close()

    joined = full.join(decided, "uid").select("page_id", "url", "html", "uid", "sha1", "response")
    return pin(joined.mapInArrow(store, INDEX), "warc-index")


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def spans(ranges: list[tuple[int, int]], gap: int = GAP) -> list[list[int]]:
    """Sorted (offset, length) ranges joined into [start, end] reads: two meet
    if at most ``gap`` bytes lie between them."""
    out: list[list[int]] = []
    for offset, length in ranges:
        if out and offset - out[-1][1] <= gap:
            out[-1][1] = max(out[-1][1], offset + length)
        else:
            out.append([offset, offset + length])
    return out


def read(index: DataFrame) -> DataFrame:
    """Records of the given index rows, with their payloads (see READ).

    A revisit's payload is null: it is that of the record it refers to."""
    stretches = (
        index.withColumn("stretch", F.expr(f"offset div {STRETCH}")).groupBy("file", "stretch")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "length", "digest"))).alias("records"))
    )  # a stretch is bounded by its bytes

    def load(batches):
        import hashlib

        for b in batches:
            for file, records in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                fs, path = _filesystem(file)
                rows = {f.name: [] for f in READ}
                with fs.open_input_file(path) as f:
                    todo = iter(records)
                    r = next(todo, None)
                    for start, end in spans([(x["offset"], x["length"]) for x in records]):
                        data = f.read_at(end - start, start)
                        while r is not None and r["offset"] < end:
                            fields, payload = parse(data[r["offset"] - start : r["offset"] - start + r["length"]])
                            kind = fields["WARC-Type"]
                            digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                            if kind == "response":
                                found = _base32(hashlib.sha1(payload).hexdigest())
                                if not found == digest == r["digest"]:
                                    raise ValueError(f"{file} at {r['offset']}: digest {found}, header {digest}, index {r['digest']}")
                            page = fields.get("X-Page-Id")
                            for c, v in zip(READ.names, (int(page) if page else None, fields["WARC-Record-ID"], kind, fields.get("WARC-Refers-To"), digest, payload if kind == "response" else None)):
                                rows[c].append(v)
                            r = next(todo, None)
                yield pa.RecordBatch.from_pydict(rows, schema=_arrow(READ))

    return stretches.mapInArrow(load, READ)


def resolved(records: DataFrame) -> DataFrame:
    """Records as read, narrow, revisits with the size and id of their response:
    (page_id, payload_bytes, digest, record_type, refers_to page id)."""
    got = pin(records.select("page_id", "record_id", "record_type", F.col("refers_to").alias("ref"), "digest", F.octet_length("payload").cast("long").alias("payload_bytes")), "warc-read")
    responses = got.filter("record_type = 'response'")
    target = responses.select(F.col("record_id").alias("ref"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("bytes"), F.col("digest").alias("found"))
    revisits = got.filter("record_type = 'revisit'").join(target, "ref", "left")
    # The digest of a revisit is that of the payload read, if it is the one in its own header.
    whole = F.when(F.col("digest") == F.col("found"), F.col("found"))
    return responses.select("page_id", "payload_bytes", "digest", "record_type", F.lit(None).cast("long").alias("refers_to")).unionByName(
        revisits.select("page_id", F.col("bytes").alias("payload_bytes"), whole.alias("digest"), "record_type", "refers_to")
    )

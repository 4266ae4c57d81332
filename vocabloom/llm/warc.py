"""A deterministic, sharded WARC writer, and the reader that takes its archives back.

Writing: payload digests decide which record of equal payloads is the response (the largest
page_id) and which ones revisit it. Records are range-sorted by page_id into shards of a
fixed number of records, so shards do not depend on how the job was split. Each task
streams its sorted records into gzip members, starts a new file when the compressed size
is reached, and writes under a temporary name of its own attempt; a retried or lost task
leaves only files that no manifest names. The driver then renames the files of successful
tasks and writes the manifest last, so an archive is whole exactly when its manifest exists.

Defined results: a null html is an empty payload. Pages that repeat page_id and payload are
written each; the first is the response, the others revisit it. Pages that share a page_id
with different payloads are separate records. A null page_id sorts first, is written as
``null`` and is the target of a revisit only where its group has no id. A null url is the empty URI.
Other columns are not written. An empty table gives an archive without files.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vocabloom.llm._common import filesystem, gapless, scratch_path, ship, staged, table

SHARD_RECORDS, ROLL_BYTES, LEVEL = 8192, 64 << 20, 3
CRLF = b"\r\n"
MANIFEST = "manifest.json"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_uri(page_id: int | None, copy: int = 0) -> str:
    """The name of a page's record; further records of one page_id are numbered, as a record's name is its own."""
    return f"<urn:x-page:{'null' if page_id is None else page_id}{f'#{copy}' if copy else ''}>"


def _page_of(uri: str) -> int | None:
    tail = uri.strip("<>").rpartition(":")[2].partition("#")[0]
    return None if tail == "null" else int(tail)


def make_record(page_id, url, payload: bytes, kind: str, refers_to, date: str, copy: int = 0) -> bytes:
    """One WARC/1.1 record; all headers and digests come from the arguments."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    heads = [
        ("WARC-Type", kind), ("WARC-Record-ID", record_uri(page_id, copy)), ("WARC-Date", date),
        ("WARC-Target-URI", " ".join((url or "").split())), ("WARC-Payload-Digest", "sha1:" + payload_digest(payload)),
        ("WARC-Block-Digest", "sha1:" + payload_digest(block)), ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if kind == "revisit":
        heads[3:3] = [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_uri(refers_to)),
        ]
    head = b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in heads)
    return head + CRLF + block + CRLF + CRLF


def gzip_member(record: bytes, level: int = LEVEL) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def records_in(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a gzip stream, checked against the block digest."""
    z, held, text = zlib.decompressobj(31), b"", bytearray()
    while chunk := held or stream.read(1 << 20):
        text += z.decompress(chunk)
        held = z.unused_data if z.eof else b""
        if not z.eof:
            continue
        end = text.index(b"\r\n\r\n")
        heads = dict(x.split(": ", 1) for x in text[:end].decode().split("\r\n")[1:])
        block = bytes(text[end + 4 : end + 4 + int(heads["Content-Length"])])
        if heads["WARC-Block-Digest"] != "sha1:" + payload_digest(block):
            raise ValueError(f"damaged record {heads['WARC-Record-ID']}")
        yield heads, block
        z, text = zlib.decompressobj(31), bytearray()
    if text:
        raise ValueError("truncated archive")


def _decide(pages: DataFrame, least: int) -> DataFrame:
    """page_id, digest, kind and target for each page, without its payload."""
    html = F.coalesce("html", F.lit(""))
    light = staged(pages.select("page_id", F.unhex(F.sha1(html)).alias("digest"), F.octet_length(html).cast("long").alias("bytes")), "page-digests")
    # _d is an expression, so that the join has an exchange of its own, whose large parts Spark can split.
    target = light.groupBy("digest").agg(F.max("page_id").alias("target")).select(F.substring("digest", 1, 20).alias("_d"), "target")
    joined = light.join(target, F.col("digest") == F.col("_d"))
    first = (F.col("bytes") < least) | F.col("page_id").eqNullSafe(F.col("target"))
    return joined.select(
        "page_id", "digest", F.when(first, "response").otherwise("revisit").alias("kind"), "target",
        (F.col("bytes") >= least).alias("shared"),
    )


def write_archive(
    pages: DataFrame, path: str, *, revisit_least: int = 0, shard_records: int = SHARD_RECORDS,
    roll_bytes: int = ROLL_BYTES, date: str = "2024-01-01T00:00:00Z",
) -> list[dict]:
    """Writes ``pages`` (page_id, url, html) below ``path`` and returns the manifest's files."""
    spark = ship(pages.sparkSession)
    pages = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    )
    ranked = staged(
        gapless(
            _decide(pages, revisit_least).withColumn("_all", F.lit(0)), "_all",
            [F.asc_nulls_first("page_id"), F.asc("digest")], "page-order", "rank",
        ).drop("_all"),
        "page-ranks",
    )
    # One first id for each shard after the first; a shard has shard_records records.
    bounds = np.array(
        sorted(r[0] for r in ranked.where((F.col("rank") > 0) & (F.col("rank") % shard_records == 0)).select("page_id").collect() if r[0] is not None),
        np.int64,
    )
    shards = len(bounds) + 1
    temporary = f"{path}/_temporary-{uuid.uuid4().hex}"

    def with_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("page_id")
            at = np.searchsorted(bounds, ids.fill_null(-(2**63)).to_numpy(zero_copy_only=False), side="right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32))], names=[*batch.schema.names, "shard"])

    heads = ranked.select(
        "page_id", F.lit(0).alias("part"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"),
        "digest", "kind", "target", "shared",
    )
    bodies = pages.select(
        "page_id", F.lit(1).alias("part"), "url", "html", F.lit(None).cast("binary").alias("digest"),
        F.lit(None).cast("string").alias("kind"), F.lit(None).cast("long").alias("target"), F.lit(None).cast("boolean").alias("shared"),
    )
    both = heads.union(bodies)
    dealt = (
        both.mapInArrow(with_shard, T.StructType([*both.schema.fields, T.StructField("shard", T.IntegerType())]))
        .repartitionById(shards, F.col("shard"))
        .sortWithinPartitions("shard", F.asc_nulls_first("page_id"), "part", F.sha1("html"), "url")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, out, now, shard = [], None, None, -1
        folder = f"{temporary}/{uuid.uuid4().hex}"
        store, place = filesystem(folder)

        def close() -> None:
            nonlocal out
            if out:
                out.close()
                out = None

        known: dict[bytes, list] = {}
        written: set[bytes] = set()
        last, copy = object(), 0
        for batch in batches:
            cols = [batch.column(c) for c in ("shard", "page_id", "part", "url", "html", "digest", "kind", "target", "shared")]
            for i in range(batch.num_rows):
                at, page_id, part = (c[i].as_py() for c in cols[:3])
                if page_id != last:
                    known, written, last, copy = {}, set(), page_id, 0
                if part == 0:
                    known[cols[5][i].as_py()] = [cols[6][i].as_py(), cols[7][i].as_py(), cols[8][i].as_py()]
                    continue
                payload = cols[4][i].as_buffer().to_pybytes() if cols[4][i].is_valid else b""
                digest = hashlib.sha1(payload).digest()
                kind, target, shared = known[digest]
                if shared and digest in written:
                    kind = "revisit"
                written.add(digest)
                if at != shard or now["bytes"] >= roll_bytes:
                    close()
                    number = now["number"] + 1 if at == shard else 0
                    shard = at
                    now = {"shard": at, "number": number, "bytes": 0, "records": 0, "temporary": f"{folder}/{at}-{number}"}
                    files.append(now)
                    store.create_dir(place, recursive=True)
                    out = store.open_output_stream(f"{place}/{at}-{number}", compression=None)
                member = gzip_member(make_record(page_id, cols[3][i].as_py(), payload, kind, target, date, copy))
                copy += 1
                out.write(member)
                now["bytes"] += len(member)
                now["records"] += 1
        close()
        names = ("shard", "number", "bytes", "records", "temporary")
        yield pa.RecordBatch.from_pylist(
            [{k: f[k] for k in names} for f in files],
            schema=pa.schema([("shard", pa.int32()), ("number", pa.int32()), ("bytes", pa.int64()), ("records", pa.int64()), ("temporary", pa.string())]),
        )

    done = dealt.mapInArrow(write, "shard int, number int, bytes long, records long, temporary string").collect()
    return _commit(path, temporary, sorted((r.asDict() for r in done), key=lambda f: (f["shard"], f["number"])))


def _commit(path: str, temporary: str, files: list[dict]) -> list[dict]:
    """Gives the files their final names and writes the manifest last. The list has one entry for each file, not record."""
    store, place = filesystem(path)
    store.create_dir(place, recursive=True)
    for f in files:
        f["name"] = f"shard-{f['shard']:06d}-{f['number']:04d}.warc.gz"
        store.move(filesystem(f.pop("temporary"))[1], f"{place}/{f['name']}")
    with store.open_output_stream(f"{place}/{MANIFEST}.tmp", compression=None) as out:
        out.write(json.dumps({"files": files}, indent=1).encode())
    store.move(f"{place}/{MANIFEST}.tmp", f"{place}/{MANIFEST}")
    gone = filesystem(temporary)[1]
    if store.get_file_info(gone).type == pafs.FileType.Directory:
        store.delete_dir(gone)
    return files


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, record_type, payload_bytes, payload_digest, refers_to and payload (null for a revisit) of each record.

    One task streams each file that the manifest names, record by record.
    """
    ship(spark)
    store, place = filesystem(path)
    with store.open_input_stream(f"{place}/{MANIFEST}") as f:
        files = json.loads(f.read())["files"]
    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
    names = spark.createDataFrame([(f"{path}/{f['name']}",) for f in files], "name string")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_schema = pa.schema([
            ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
        ])
        for batch in batches:
            for name in batch.column("name").to_pylist():
                store, place = filesystem(name)
                rows, held = [], 0
                with store.open_input_stream(place, compression=None) as stream:
                    for heads, block in records_in(stream):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(http.rpartition(b"Content-Length: ")[2])
                        full = heads["WARC-Type"] == "response"
                        rows.append({
                            "page_id": _page_of(heads["WARC-Record-ID"]), "url": heads["WARC-Target-URI"],
                            "record_type": heads["WARC-Type"], "payload_bytes": size,
                            "payload_digest": heads["WARC-Payload-Digest"].removeprefix("sha1:"),
                            "refers_to": None if full else _page_of(heads["WARC-Refers-To"]), "payload": payload if full else None,
                        })
                        held += len(block)
                        if held > 8 << 20 or len(rows) >= 4096:
                            yield pa.RecordBatch.from_pylist(rows, schema=out_schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=out_schema)

    return names.repartition(max(1, len(files))).mapInArrow(read, schema)


def op2_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS payload_bytes, CAST(unhex(sha1(html)) AS BIT)::VARCHAR AS bits FROM p),
d AS (
  SELECT page_id, payload_bytes,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT)
             + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT)
             + CAST(substr(bits, 5 * i + 5, 1) AS INT), 1)), '') AS payload_digest
  FROM h),
t AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS target FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = target THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = target THEN NULL ELSE target END AS refers_to
FROM t
"""

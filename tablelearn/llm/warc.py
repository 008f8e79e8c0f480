"""WARC: a normaliser for archives that were gzipped as one stream.

``write_monolithic`` writes the pages of each task as archives of one gzip member;
``normalise`` inflates each of them once, from front to back, and rewrites every record
as a member of its own beside a JSON-lines index (archive, offset, length, page);
``read_records`` fetches single records through that index. Records with equal payloads
become revisits of the one with the smallest page id.

Defined results: a null html is an empty payload; a null url is written as an empty URI;
a null page id comes after every other id and is written without an id header; of
repeated rows the first written is the response; ties between equal payloads go to the smallest
page id; very long pages are records of their own, one in memory at a time; an empty table gives
no archives and an empty result; extra columns are ignored.

Scale and recovery: every task streams its own archive (memory: one record). File names
are new in each attempt and reach the next step only through the rows of attempts that
succeeded (checkpointed), so a lost executor leaves unused files, never wrong ones.
Files go to the shared folder of ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelearn.session import ensure_checkpoint_dir

from .common import materialise, pick, text_bytes_conf

HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
#: Uncompressed bytes after which a new archive is begun, and bytes read at a time.
ARCHIVE_BYTES, CHUNK = 256 << 20, 1 << 20
LEVEL = 6


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, page_id, url: str, payload: bytes, digest: str, size: int, refers_to=None) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP head and drops the payload."""
    block = HTTP_HEAD + (payload if kind == "response" else b"")
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}')}>"),
            ("WARC-Date", DATE), ("WARC-Target-URI", url.replace("\r", "").replace("\n", "")),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(size))]
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    if kind == "revisit":
        head.append(("WARC-Profile", PROFILE))
        if refers_to is not None:
            head.append(("X-Refers-To-Page-Id", str(refers_to)))
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return lines.encode() + block + b"\r\n\r\n"


def parse_head(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8").split("\r\n")
    return dict(x.split(": ", 1) for x in lines[1:] if ": " in x)


def stream_records(read) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a gzip stream, whatever its members; holds one
    record and one chunk."""
    z, buf = zlib.decompressobj(31), bytearray()
    need: tuple[dict[str, str], int, int] | None = None
    while True:
        chunk = read(CHUNK)
        data = chunk
        while data:
            buf += z.decompress(data)
            data = z.unused_data
            if z.eof:
                z = zlib.decompressobj(31)
        while True:
            if need is None:
                end = buf.find(b"\r\n\r\n")
                if end < 0:
                    break
                head = parse_head(bytes(buf[:end]))
                need = head, end + 4, end + 4 + int(head["Content-Length"])
            head, at, stop = need
            if len(buf) < stop + 4:
                break
            yield head, bytes(buf[at:stop])
            del buf[:stop + 4]
            need = None
        if not chunk:
            if buf:
                raise ValueError("the archive ends within a record")
            return


def write_monolithic(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                     html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives; one checkpointed row per record: archive, seq, page_id,
    digest, size."""
    text_bytes_conf(pages.sparkSession)
    d = pick(pages, page_id=id_col, url=url_col, html=html_col).withColumn("page_id", F.col("page_id").cast("bigint"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = open_fs(folder)
        out, name, z, size, seq = None, "", None, 0, 0
        for b in batches:
            rows = []
            for page_id, url, html in zip(b["page_id"], b["url"], b["html"]):
                if out is None:
                    name = f"mono-{uuid.uuid4().hex}.warc.gz"
                    out, z, size, seq = fs.open_output_stream(f"{root}/{name}", compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0, 0
                payload = (html or "").encode("utf-8", "surrogatepass")
                pid = None if pd.isna(page_id) else int(page_id)
                digest = sha1_base32(payload)
                raw = record("response", pid, url or "", payload, digest, len(payload))
                out.write(z.compress(raw))
                rows.append((name, seq, pid, digest, len(payload)))
                seq, size = seq + 1, size + len(raw)
                if size >= archive_bytes:
                    out.write(z.flush())
                    out.close()
                    out = None
            yield pd.DataFrame(rows, columns=["archive", "seq", "page_id", "digest", "size"]).astype({"page_id": "Int64"})
        if out is not None:
            out.write(z.flush())
            out.close()

    return materialise(d.mapInPandas(run, "archive string, seq bigint, page_id bigint, digest string, size bigint"))


def plan_revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """One row per archive: its name and the (seq, refers_to) of its revisits. Each list
    is bounded by the records of one archive."""
    key = F.struct(F.col("page_id").isNull().alias("null_id"), "page_id", "archive", "seq")
    first = (records.where(F.col("size") >= min_bytes).groupBy("digest")
             .agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    again = (records.where(F.col("size") >= min_bytes).join(first, "digest")
             .where((F.col("first.archive") != F.col("archive")) | (F.col("first.seq") != F.col("seq")))
             .groupBy("archive").agg(F.collect_list(F.struct("seq", F.col("first.page_id").alias("to"))).alias("again")))
    return records.select("archive").distinct().join(again, "archive", "left")


def normalise(plan: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive of ``plan``; one checkpointed row per archive: archive (the
    new file), index (its sidecar), records."""
    spark = plan.sparkSession
    tasks = max(1, spark.sparkContext.defaultParallelism)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = open_fs(folder)
        for b in batches:
            for old, again in zip(b["archive"], b["again"]):
                to = {int(r["seq"]): r["to"] for r in again} if again is not None else {}
                name = f"norm-{uuid.uuid4().hex}"
                offset = n = 0
                with fs.open_input_stream(f"{root}/{old}", compression=None) as src, \
                        fs.open_output_stream(f"{root}/{name}.warc.gz", compression=None) as dst, \
                        fs.open_output_stream(f"{root}/index/{name}.cdxj", compression=None) as side:
                    for seq, (head, block) in enumerate(stream_records(src.read)):
                        page = head.get("X-Page-Id")
                        payload = block[len(HTTP_HEAD):]
                        digest = sha1_base32(payload)
                        kind = "revisit" if seq in to else "response"
                        ref = None if seq not in to or pd.isna(to[seq]) else int(to[seq])
                        raw = record(kind, page, head["WARC-Target-URI"], payload, digest, len(payload), ref)
                        z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        member = z.compress(raw) + z.flush()
                        dst.write(member)
                        side.write(json.dumps({"archive": f"{name}.warc.gz", "offset": offset, "length": len(member),
                                               "page_id": None if page is None else int(page)}).encode() + b"\n")
                        offset, n = offset + len(member), n + 1
                yield pd.DataFrame({"archive": [f"{name}.warc.gz"], "index": [f"{name}.cdxj"], "records": [n]})

    dealt = plan.repartition(tasks, "archive")
    return materialise(dealt.mapInPandas(run, "archive string, index string, records bigint"))


def read_index(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """The sidecar rows of the archives in ``manifest``."""
    rows = spark.read.schema("archive string, offset bigint, length bigint, page_id bigint").json(f"{folder}/index")
    return rows.join(manifest.select("archive"), "archive", "left_semi")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Fetch each indexed record on its own: page_id, url, payload_bytes,
    payload_digest, record_type, refers_to, html (null for revisits)."""
    tasks = max(1, index.sparkSession.sparkContext.defaultParallelism)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = open_fs(folder)
        name, src = None, None
        for b in batches:
            rows = []
            for archive, offset, length in zip(b["archive"], b["offset"], b["length"]):
                if archive != name:
                    if src is not None:
                        src.close()
                    name, src = archive, fs.open_input_file(f"{root}/{archive}")
                src.seek(offset)
                raw = zlib.decompress(src.read(length), 31)
                end = raw.index(b"\r\n\r\n")
                head = parse_head(raw[:end])
                size, digest, html = int(head["X-Payload-Length"]), head["WARC-Payload-Digest"][5:], None
                if head["WARC-Type"] == "response":
                    payload = raw[end + 4 + len(HTTP_HEAD):-4]
                    size, digest, html = len(payload), sha1_base32(payload), payload.decode("utf-8", "surrogatepass")
                page, ref = head.get("X-Page-Id"), head.get("X-Refers-To-Page-Id")
                rows.append((page and int(page), head.get("WARC-Target-URI", ""), size, digest, head["WARC-Type"],
                             ref and int(ref), html))
            out = pd.DataFrame(rows, columns=["page_id", "url", "payload_bytes", "payload_digest",
                                              "record_type", "refers_to", "html"])
            yield out.astype({"page_id": "Int64", "refers_to": "Int64"})
        if src is not None:
            src.close()

    dealt = index.repartitionByRange(tasks, "archive", "offset").sortWithinPartitions("archive", "offset")
    return dealt.mapInPandas(run, "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
                                  "record_type string, refers_to bigint, html string")


def round_trip(pages: DataFrame, folder: str | None = None, **cols: str) -> DataFrame:
    """Pages through monolithic archives, normaliser and index back to records."""
    spark = pages.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    fs, root = open_fs(folder)
    fs.create_dir(f"{root}/index", recursive=True)
    manifest = normalise(plan_revisits(write_monolithic(pages, folder, **cols)), folder)
    return read_records(read_index(spark, manifest, folder), folder)

"""WARC writing, reading and transaction assembly.

Every page becomes a capture of three records: request, response (or revisit) and metadata, the first and the
last pointing at the middle one through WARC-Concurrent-To. Records are gzip members of their own. Of
captures with equal payloads of at least ``MIN_DEDUP`` bytes, the one with the largest id keeps the payload
and the others revisit it.

``assemble`` joins records of one capture through concurrent-to identifiers, in whichever direction they
point and over any number of steps, and gives one nested row per capture.

A writing task names its files for its own attempt and reports them; only reported files are read, so lost
or repeated attempts leave nothing that counts. Readers stream: one record at a time is in memory.

Cases: null or empty html gives an empty payload, always a response; pages with a null id or a repeated row
are captures of their own (null ids are never deduplicated, rows with the winning id are all responses); null
urls are written as ``urn:none``; an empty table gives no files and no captures; records without partner give
captures with null parts; a revisit whose response isn't in the archives has null size and target. Only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import join_small, materialise, named, scratch, ship, shuffle_partitions, table
from .components import connected_components
from .token_files import open_fs

MIN_DEDUP = 1000
FILE_BYTES = 128_000_000
LEVEL = 4
DATE = "2000-01-01T00:00:00Z"
MANIFEST = "path string, n_records long"
RECORD = (
    "path string, offset long, record_id string, type string, target_uri string, date string, concurrent_to array<string>, refers_to string, "
    "declared_digest string, payload_bytes long, payload_digest string, fields map<string,string>, payload binary"
)
NAMES = [x.split()[0] for x in RECORD.replace("map<string,string>", "map").split(", ")]
TYPES = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.list_(pa.string()), *[pa.string()] * 2, pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]


def urn(*parts: object) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5('|'.join(map(str, parts)).encode()).digest())}>"


def record(kind: str, record_id: str, uri: str, date: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC/1.1 record."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Target-URI: {uri}", f"WARC-Date: {date}"]
    lines += [f"{k}: {v}" for k, v in headers] + [f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gz(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def base32(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def hex_of(declared: str | None) -> str | None:
    """Lower-case hex of a declared SHA-1, in base 32 or hex."""
    if not declared or ":" not in declared:
        return None
    name, value = declared.split(":", 1)
    if name.lower() != "sha1":
        return None
    return base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower()


def capture(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, row: int) -> list[bytes]:
    """The three records of a page."""
    uri = (url or "urn:none").replace("\r", "%0D").replace("\n", "%0A").replace(" ", "%20")
    main = urn("response", page_id, digest) if refers_to is None and page_id is not None and len(payload) >= MIN_DEDUP else urn("capture", row, page_id, digest)
    host = uri.split("://", 1)[-1].split("/", 1)[0]
    request = record("request", urn("request", main, row), uri, DATE, [("WARC-Concurrent-To", main), ("Content-Type", "application/http; msgtype=request")], f"GET / HTTP/1.1\r\nHost: {host}\r\n\r\n".encode())
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    named = [("WARC-Payload-Digest", base32(digest)), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is None:
        middle = record("response", main, uri, DATE, named, head + payload)
    else:
        profile = [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", urn("response", refers_to, digest))]
        middle = record("revisit", main, uri, DATE, named + profile, head)
    about = f"page-id: {'' if page_id is None else page_id}\r\n".encode()
    metadata = record("metadata", urn("metadata", main, row), uri, DATE, [("WARC-Concurrent-To", main), ("Content-Type", "application/warc-fields")], about)
    return [request, middle, metadata]


def write_archives(pages: DataFrame, folder: str, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes all pages; the manifest of files."""
    spark = pages.sparkSession
    ship(spark)
    rows = pages.select(named(page_id).cast("long").alias("page_id"), named(url).alias("url"), F.coalesce(named(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = rows.where(F.octet_length("payload") >= MIN_DEDUP).where("page_id IS NOT NULL").select("page_id", "digest")
    # one row per page, only of payloads that occur more than once
    several = large.groupBy("digest").agg(F.max("page_id").alias("keeps"), F.min("page_id").alias("least")).where("keeps > least").select("digest", "keeps")
    revisits = materialise(several, "repeated-payloads")
    known = join_small(rows, revisits, "digest", "left", revisits.count(), 500_000)
    again = F.when((F.col("page_id") < F.col("keeps")) & (F.octet_length("payload") >= MIN_DEDUP), F.col("keeps"))
    known = known.select("page_id", "url", "payload", "digest", again.alias("refers_to"), F.monotonically_increasing_id().alias("row"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, at, n, done = None, "", 0, 0, []
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to", "row")]
            for i in range(batch.num_rows):
                if out is None:
                    path, at, n = f"{folder}/part-{uuid.uuid4().hex}.warc.gz", 0, 0
                    fs, local = open_fs(path)
                    fs.create_dir(local.rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(local, buffer_size=1 << 20)
                for r in capture(*(c[i].as_py() for c in columns)):
                    data = gz(r)
                    out.write(data)
                    at += len(data)
                    n += 1
                if at > FILE_BYTES:
                    out.close()
                    done.append((path, n))
                    out = None
        if out is not None:
            out.close()
            done.append((path, n))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64())], ["path", "n_records"])

    return materialise(known.mapInArrow(run, MANIFEST), "warc-manifest")


def members(source) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of each record of a gzip-by-record or plain archive."""
    chunk, start, data = 1 << 20, 0, source.read(1 << 20)
    if data[:2] == b"\x1f\x8b":
        while data:
            z, parts, used = zlib.decompressobj(31), [], 0
            while not z.eof:
                parts.append(z.decompress(data))
                used += len(data) - len(z.unused_data)
                data = z.unused_data if z.eof else source.read(chunk)
                if not data and not z.eof:
                    raise ValueError(f"archive ends inside the record at {start}")
            if not data:
                data = source.read(chunk)
            yield start, b"".join(parts)
            start += used
        return
    while data:
        while b"\r\n\r\n" not in data:
            more = source.read(chunk)
            if not more:
                raise ValueError(f"archive ends inside the record at {start}")
            data += more
        head = data.index(b"\r\n\r\n") + 4
        total = head + int(headers_of(data[: head - 4]).get("content-length", 0)) + 4
        while len(data) < total:
            more = source.read(max(chunk, total - len(data)))
            if not more:
                raise ValueError(f"archive ends inside the record at {start}")
            data += more
        yield start, data[:total]
        start, data = start + total, data[total:] or source.read(chunk)


def header_list(head: bytes) -> list[tuple[str, str]]:
    """Header fields in order, names in lower case; folded lines joined."""
    out: list[tuple[str, str]] = []
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], out[-1][1] + " " + line.strip())
        elif ":" in line:
            k, v = line.split(":", 1)
            out.append((k.strip().lower(), v.strip()))
    return out


def headers_of(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; the first value of a repeated field."""
    return dict(reversed(header_list(head)))


def parse(path: str, offset: int, data: bytes, with_payload: bool) -> tuple:
    """One row of RECORD."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields_of = header_list(head)
    h = dict(reversed(fields_of))
    concurrent = [v for k, v in fields_of if k == "warc-concurrent-to" and v]
    block = rest[: int(h.get("content-length", 0))]
    kind, content = h.get("warc-type"), h.get("content-type", "")
    payload = block
    if content.startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    fields = {}
    if content.startswith("application/warc-fields"):
        fields = headers_of(b"\r\n" + block)
    whole = kind in ("response", "resource", "conversion")
    digest = hashlib.sha1(payload).hexdigest() if whole else None
    declared = hex_of(h.get("warc-payload-digest"))
    if whole and declared and declared != digest:
        raise ValueError(f"{path} at {offset}: the payload's digest is {digest}, declared is {declared}")
    return (
        path, offset, h.get("warc-record-id"), kind, h.get("warc-target-uri"), h.get("warc-date"), concurrent, h.get("warc-refers-to"),
        declared, len(payload) if whole else None, digest, list(fields.items()), payload if whole and with_payload else None,
    )


def read_records(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row of RECORD per record of the files in ``path``."""
    spark = manifest.sparkSession
    ship(spark)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, local = open_fs(path)
                with fs.open_input_stream(local) as source:
                    rows, size = [], 0
                    for offset, data in members(source):
                        rows.append(parse(path, offset, data, with_payload))
                        size += len(data) if with_payload else 500
                        if size > 4_000_000:
                            yield _batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield _batch(rows)

    return manifest.select("path").repartition(shuffle_partitions(spark), "path").mapInArrow(run, RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)], NAMES)


def assemble(records: DataFrame) -> DataFrame:
    """capture_id and the nested request, response (or revisit, resource) and metadata records of each capture.

    Records are of one transaction if concurrent-to identifiers, of which a record may have several, join them in
    either direction and over any number of steps: connected components, unless no record names several and none
    that is named names another. Its identifier is that of its response
    (the smallest, if several), else its smallest one. Of several requests or responses the nested ones are the
    first in file order; ``metadata`` is the first metadata record and ``all_metadata`` all of them, in file order.
    Responses that share an identifier are captures of their own, to which the other records go in file order. Records without identifier are
    captures of their own; an identifier that names no record still joins those that name it.
    """
    main = F.col("type").isin("response", "revisit", "resource")
    keyed = records.withColumn("own", F.coalesce("record_id", F.concat_ws(":", F.lit("none"), "path", F.col("offset").cast("string"))))
    edges = keyed.select(F.col("own").alias("src"), F.explode("concurrent_to").alias("dst")).where("src <> dst").distinct()
    # plain where no record that is pointed at points on, and none points at several
    several = edges.groupBy("src").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("src")
    onward = edges.select("src").join(edges.select(F.col("dst").alias("src")), "src", "left_semi")
    if several.union(onward).head(1):
        groups = connected_components(edges).select(F.col("node").alias("own"), F.col("component").alias("group"))
        placed = keyed.join(groups, "own", "left").withColumn("group", F.coalesce("group", "own"))
    else:
        placed = keyed.withColumn("group", F.coalesce(F.get("concurrent_to", F.lit(0)), "own"))
    role = F.when(main, "main").otherwise(F.col("type"))
    placed = placed.withColumn("role", role).repartition(shuffle_partitions(records.sparkSession), "group")
    # where an identifier stands for several captures, records of each kind are dealt to them in file order
    same = F.count(F.when(F.col("role") == "main", True)).over(W.partitionBy("group", "role", "own"))
    placed = placed.withColumn("same", same).withColumn("copies", F.greatest(F.lit(1), F.max("same").over(W.partitionBy("group"))))
    nth = F.row_number().over(W.partitionBy("group", "role").orderBy("path", "offset")) - 1
    n = F.count(F.lit(1)).over(W.partitionBy("group", "role"))
    dealt = F.when(F.col("copies") == 1, 0).when(n >= F.col("copies"), F.floor(nth * F.col("copies") / n)).otherwise(nth)
    placed = placed.withColumn("copy", dealt)
    at = F.struct("path", "offset")
    whole = F.struct(*(named(c) for c in records.columns))
    part = lambda name: F.min_by(F.when(F.col("role") == name, whole), F.when(F.col("role") == name, at))
    in_order = lambda x, y: F.when(x["at"] < y["at"], -1).when(x["at"] > y["at"], 1).otherwise(0)
    every = F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == "metadata", F.struct(at.alias("at"), whole.alias("record")))), in_order), lambda x: x["record"])
    least = F.min(F.when(main, F.col("own")))
    return placed.groupBy("group", "copy").agg(
        F.coalesce(least, F.min("own")).alias("capture_id"), part("request").alias("request"), part("main").alias("response"), part("metadata").alias("metadata"), every.alias("all_metadata")
    ).drop("group", "copy")


def op5_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(table(spark, sf_dir, "pages"), scratch(spark, "archives"))
    # page ids, sizes and digests are those of the archives; payloads were hashed while they were read
    records = materialise(read_records(manifest, with_payload=False), "warc-records")
    captures = assemble(records)
    flat = captures.select(
        F.col("response.record_id").alias("record_id"), F.col("metadata.fields")["page-id"].try_cast("long").alias("page_id"), F.col("response.type").alias("record_type"),
        "response.payload_bytes", F.coalesce("response.payload_digest", "response.declared_digest").alias("payload_digest"), F.col("response.refers_to").alias("target"),
    )
    flat = materialise(flat, "captures")
    kept = flat.where("record_type = 'response'").select(F.col("record_id").alias("target"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("full_bytes")).dropDuplicates(["target"])
    revisits = flat.where("record_type = 'revisit'").join(kept, "target", "left").select("page_id", F.col("full_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    others = flat.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    return others.union(revisits)


OP5_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeps FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {MIN_DEDUP} AND page_id < keeps THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_DEDUP} AND page_id < keeps THEN keeps END AS refers_to
FROM m
"""

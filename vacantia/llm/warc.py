"""WARC archives with a two-level capture index.

Writing: each page becomes one gzip member of a ``.warc.gz`` file, a ``response`` record or, where an equal
payload has a record with a larger page id, a ``revisit`` that refers to it. Tasks write files under
names of their own attempt; a table that Spark commits lists the captures, so what a lost task left behind
is never read.

Index: captures are sorted by reversed-host URL key (``com,example)/path``) and page id across the cluster,
and each range becomes one file of blocks of ``BLOCK`` captures, compressed one by one, followed by
the sparse directory: the first key, place and size of each block. The upper level is the list of those
files with their first keys, one row per file.

Lookup: keys find their file by binary search in the upper level (``write_index`` makes at most ``PARTS`` files, so
its size is bounded), move to the task of that file, find their block by binary search in its directory, and only
blocks that are asked for are read; the captures found are then read from the archives by range. A key
is a URL's key and a page id.

Cases: a null html is an empty payload, a null url has the key ``)/``; repeated rows with one page id and
payload are both responses if that id is the largest; a null page id is smaller than any other and stays
null; an empty table gives empty archives; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.llm import _files
from vacantia.llm import _text as T

BLOCK = 3000
PARTS = 10_000
#: A file is closed once it has so many bytes.
FILE_BYTES = 1 << 28
DATE = "2024-01-01T00:00:00Z"
NO_ID = -(2**63)
CRLF = b"\r\n"


def url_key(url: str | None) -> str:
    """The sort key of a URL: host labels reversed, then path and query."""
    try:
        parts = urlsplit(url or "")
        host = (parts.hostname or "").rstrip(".")
        port = f":{parts.port}" if parts.port and (parts.scheme, parts.port) not in (("http", 80), ("https", 443)) else ""
    except ValueError:
        return ")/" + (url or "")
    host = host[4:] if host.startswith("www.") else host
    return f"{','.join(reversed(host.split('.')))}{port}){parts.path or '/'}{'?' + parts.query if parts.query else ''}"


def sort_key(url: str | None, page_id: int | None) -> str:
    """The key with the page id, so that a URL's captures are in order and no range is all one key; as the index has it, without tabs and line breaks."""
    return f"{_header(url_key(url)).replace('\t', '%09')} {(page_id if page_id is not None else NO_ID) + 2**63:020d}"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(value: str) -> str:
    """A header value on one line."""
    return value.replace("\\", "\\\\").replace("\r", "\\r").replace("\n", "\\n")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record, compressed; a revisit has the HTTP headers of the full payload without the payload."""
    name = lambda k: f"<urn:page:{'' if k is None else k}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {_header(url or '')}"]
    head.append(f"WARC-Payload-Digest: sha1:{digest_of(payload)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    raw = "\r\n".join(head).encode() + CRLF + CRLF + body + CRLF + CRLF
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def parse(member: bytes) -> dict:
    """The fields of one compressed record."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(CRLF + CRLF)
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(CRLF + CRLF)
    length = next(int(x.split(b":")[1]) for x in http.split(CRLF) if x.lower().startswith(b"content-length:"))
    page = lambda k: int(fields[k][10:-1]) if fields.get(k, "<urn:page:>") != "<urn:page:>" else None
    kind = fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or digest_of(payload) != digest):
        raise ValueError("the payload isn't what the record says")
    return {"page_id": page("WARC-Record-ID"), "payload_bytes": length, "payload_digest": digest, "record_type": kind, "refers_to": page("WARC-Refers-To"), "payload": payload}


def mark_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html and refers_to: the largest page id of an equal payload, null for that page itself."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    key = F.when(F.octet_length("html") >= least_bytes, F.sha1(F.col("html").cast("binary")))
    # aggregated in each task before it is shuffled: digests and ids only
    doubles = rows.select("page_id", key.alias("key")).groupBy("key").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1 AND key IS NOT NULL").select("key", "last")
    joined = rows.withColumn("key", key).join(doubles.hint("shuffle_hash"), "key", "left")
    return joined.select("page_id", "url", "html", F.when(F.col("last") != F.coalesce("page_id", F.lit(NO_ID)), F.col("last")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Writes the archives and returns the captures: key, page_id, url, path, offset, length."""
    spark = pages.sparkSession
    T.importable(spark)
    _files.make_dir(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, at = None, "", 0
        for batch in batches:
            for piece in T.pieces(batch, "html", 8 << 20):
                ids, urls, refers = (piece.column(c).to_pylist() for c in ("page_id", "url", "refers_to"))
                data, offsets = T.utf8(piece.column("html"))
                text, rows = data.tobytes(), []
                for k, (page, url, other) in enumerate(zip(ids, urls, refers)):
                    if out is None or at > FILE_BYTES:
                        if out is not None:
                            out.close()
                        path, at = f"{folder}/pages-{uuid.uuid4().hex}.warc.gz", 0
                        out = _files.create(path)
                    member = record(page, url, text[offsets[k] : offsets[k + 1]], other)
                    out.write(member)
                    rows.append((sort_key(url, page), page, path, at, len(member)))
                    at += len(member)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))], names=["key", "page_id", "path", "offset", "length"])
        if out is not None:
            out.close()

    captures = mark_revisits(pages, least_bytes).mapInArrow(run, "key string, page_id long, path string, offset long, length long")
    return T.written(captures, "captures")


def write_index(captures: DataFrame, folder: str, block: int = BLOCK, parts: int | None = None) -> DataFrame:
    """Writes the index files and returns the upper level: first key, path, directory's place and size, captures."""
    spark = captures.sparkSession
    _files.make_dir(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, first, path, at, rest, n, directory = None, "", "", 0, [], 0, []

        def put(lines: list[tuple[str, str]]) -> None:
            nonlocal at
            body = zlib.compress("\n".join(x for _, x in lines).encode(), 6)
            out.write(body)
            directory.append(f"{lines[0][0]}\t{at}\t{len(body)}")
            at += len(body)

        for batch in batches:
            keys, paths, offsets, lengths = (batch.column(c).to_pylist() for c in ("key", "path", "offset", "length"))
            for key, where, offset, length in zip(keys, paths, offsets, lengths):
                if out is None:
                    first, path = key, f"{folder}/index-{uuid.uuid4().hex}.cdxz"
                    out = _files.create(path)
                rest.append((key, f"{key}\t{where}\t{offset}\t{length}"))
                n += 1
                if len(rest) == block:
                    put(rest)
                    rest = []
        if out is not None:
            if rest:
                put(rest)
            body = zlib.compress("\n".join(directory).encode(), 6)
            out.write(body)
            out.close()
            yield pa.RecordBatch.from_pydict({"first_key": [first], "path": [path], "offset": [at], "length": [len(body)], "n": [n]})

    ordered = captures.select("key", "path", "offset", "length")
    if parts or int(spark.conf.get("spark.sql.shuffle.partitions")) > PARTS:
        parts = min(PARTS, parts or PARTS)  # larger files, not more of them
    ordered = (ordered.repartitionByRange(parts, "key") if parts else ordered.repartitionByRange("key")).sortWithinPartitions("key")
    return T.written(ordered.mapInArrow(run, "first_key string, path string, offset long, length long, n long"), "upper")


def capture_keys(pages: DataFrame) -> DataFrame:
    """The keys that the captures of these pages have."""
    T.importable(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [sort_key(u, p) for u, p in zip(batch.column("url").to_pylist(), batch.column("page_id").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.string())], names=["key"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url").mapInArrow(run, "key string")


def look_up(keys: DataFrame, upper: DataFrame) -> DataFrame:
    """The captures of each key (column ``key``): key, path, offset, length."""
    spark = keys.sparkSession
    T.importable(spark)
    # as many rows as write_index has parts
    top = sorted((r.first_key, r.path, r.offset, r.length) for r in upper.collect())
    sent = spark.sparkContext.broadcast(top)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = np.array([t[0] for t in sent.value], object)
        for batch in batches:
            own = batch.column("key").to_pylist()
            part = np.maximum(np.searchsorted(firsts, np.array(own, object), "right") - 1, 0)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int64)), pa.array(own, pa.string())], names=["part", "key"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, file, directory, block, lines = -1, None, [], -1, {}
        for batch in batches:
            rows = []
            for p, key in zip(batch.column("part").to_pylist(), batch.column("key").to_pylist()):
                if p != part:
                    _, path, offset, length = sent.value[p]
                    file = _files.open_input(path)
                    entries = [x.rsplit("\t", 2) for x in zlib.decompress(file.read_at(length, offset)).decode().split("\n")]
                    directory = np.array([e[0] for e in entries], object)
                    places = [(int(e[1]), int(e[2])) for e in entries]
                    part, block = p, -1
                # the block before the first one that begins after the key; equal keys may begin a block earlier
                b = max(int(np.searchsorted(directory, key, "left")) - 1, 0)
                while b < len(places) and directory[b] <= key:
                    if b != block:
                        body = zlib.decompress(file.read_at(places[b][1], places[b][0])).decode()
                        lines = {}
                        for line in body.split("\n"):
                            name, where, at, size = line.rsplit("\t", 3)
                            lines.setdefault(name, []).append((where, int(at), int(size)))
                        block = b
                    rows += [(key, *x) for x in lines.get(key, ())]
                    b += 1
            types = (pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [()] * 4, types)], names=["key", "path", "offset", "length"])

    if not top:
        return spark.createDataFrame([], "key string, path string, offset long, length long")
    routed = keys.select("key").distinct().mapInArrow(route, "part long, key string")
    return routed.repartitionByRange("part", "key").sortWithinPartitions("part", "key").mapInArrow(search, "key string, path string, offset long, length long")


def read_records(captures: DataFrame, payloads: bool = False) -> DataFrame:
    """The records at (path, offset, length), parsed; payloads only where asked for."""
    T.importable(captures.sparkSession)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payloads
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * payloads

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file = None, None
        for batch in batches:
            places = list(zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length"))))
            at = 0
            while at < len(places):
                # neighbours in a file are one read of at most 8 MB
                to, begin = at + 1, places[at][1]
                while to < len(places) and places[to][0] == places[at][0] and places[to][1] == places[to - 1][1] + places[to - 1][2] and places[to][1] + places[to][2] - begin <= 8 << 20:
                    to += 1
                if places[at][0] != path:
                    path = places[at][0]
                    file = _files.open_input(path)
                data = file.read_at(places[to - 1][1] + places[to - 1][2] - begin, begin)
                found = [parse(data[o - begin : o - begin + n]) for _, o, n in places[at:to]]
                yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], t) for c, t in zip(names, types)], names=names)
                at = to

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads
    return captures.repartitionByRange("path", "offset").sortWithinPartitions("path", "offset").mapInArrow(run, schema)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    captures = write_archives(pages, T.shared_dir(spark))
    upper = write_index(captures, T.shared_dir(spark))
    # what the pages should have, not what was written: a lost capture would be a missing row
    found = T.written(look_up(capture_keys(pages), upper), "found")
    return read_records(found)


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages), m AS (SELECT html, max(page_id) AS last FROM p GROUP BY html)
SELECT p.page_id, strlen(p.html)::BIGINT AS payload_bytes,
       (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ('0b' || substr(bits, 1 + 5 * i, 5))::INTEGER, 1), '' ORDER BY i)
        FROM (SELECT list_aggregate(list_transform(range(40), lambda k: lpad(bin(('0x' || substr(sha1(p.html), k + 1, 1))::INTEGER), 4, '0')), 'string_agg', '') AS bits), range(32) AS r(i)) AS payload_digest,
       CASE WHEN p.page_id = m.last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id = m.last THEN NULL ELSE m.last END AS refers_to
FROM p JOIN m ON m.html = p.html"""

"""WARC archives with segmented records: written by tasks, read back and reassembled.

Writing: each page becomes a response record, or a revisit record where a page with the same payload and a smaller id
has one.  A response larger than ``SEGMENT`` bytes is cut: the first segment keeps the record's type, the others are
continuation records that name their origin, and the last one tells the total length.  Bodies are in chunked transfer
framing.  A task starts another archive beyond ``ARCHIVE`` bytes; every record is a gzip member of its own, as usual.

A response's record id is made of its page id and digest, so that revisits name it without having seen it.

Reading: each archive is one task's work, record by record.  Whole records are decoded at once.  Segments are grouped by
origin, put in order of their numbers and checked: none missing, none twice, total length as told.  Then the chunked
framing is decoded.  Revisits find the page they refer to by a join on record ids; where they name none that is there, by the
payload's digest.  A record that fails a check keeps its row with the reason in ``error``, a damaged one with nothing else; reading goes on with the
next member.  Archives of others may lack page ids and digests; records that are no page (warcinfo, request, metadata,
...) are passed over.

Archives are named by task attempt and told by the manifest, so a repeated task never disturbs others.

Nulls: a null page is an empty payload; a null url leaves out the target; a null id makes a response, unless another
page with the same payload has an id.  Rows that repeat the smallest id and payload are responses each.  Further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import os
import zlib
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireloom.llm.storage import filesystem, make_folder, stored
from wireloom.session import scratch_path

#: Bytes of block in a segment; bytes after which a task starts another archive; bytes of body in a chunk.
SEGMENT, ARCHIVE, CHUNK = 1 << 15, 1 << 26, 1 << 13
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"

MANIFEST = "name string, n_records long, n_bytes long"
RECORD = "record string, origin string, type string, segment int, total long, page_id long, refers_to string, block binary, told string, url string, error string"
RECORD_BLOCK = 7
DECODED = "record string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to string, url string, segments int, error string"
PAGE = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "segments", "error")
#: The first bytes of a gzip member.
MEMBER = b"\x1f\x8b\x08"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """A body in chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(payload[i : i + size]), payload[i : i + size]) for i in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a body in chunked transfer framing; extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("a chunk has no size")
        size = int(body[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if not size:
            if body.find(b"\r\n", at) < 0:
                raise ValueError("the last chunk has no end")
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk has not the size it tells")
        out.append(body[at : at + size])
        at += size + 2


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as a gzip member."""
    head = "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _uri(record_id: str) -> str:
    return f"<urn:wireloom:{record_id}>"


def page_name(page_id: int, payload: bytes) -> str:
    return f"page:{page_id}:{digest(payload)}"


def page_records(record_id: str, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, segment: int = SEGMENT) -> Iterator[bytes]:
    """The records of one page."""
    target = [("WARC-Target-URI", "".join(c for c in url if c not in "\r\n"))] if url else []
    named = [("WARC-Page-ID", str(page_id))] if page_id is not None else []
    common = [("WARC-Date", DATE), *target, *named, ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    kind = ("Content-Type", "application/http; msgtype=response")
    if refers_to is not None:
        block = http + b"Content-Length: %d\r\n\r\n" % len(payload)
        own = [("WARC-Type", "revisit"), ("WARC-Record-ID", _uri(record_id)), ("WARC-Profile", PROFILE), ("WARC-Refers-To", _uri(page_name(refers_to, payload)))]
        yield record([*own, *common, kind], block)
        return
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    pieces = [block[i : i + segment] for i in range(0, len(block), segment)]
    for number, piece in enumerate(pieces, 1):
        if number == 1:
            fields = [("WARC-Type", "response"), ("WARC-Record-ID", _uri(record_id)), *common, kind]
        else:
            fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", _uri(f"{record_id}:{number}")), ("WARC-Date", DATE), *target, ("WARC-Segment-Origin-ID", _uri(record_id))]
        if len(pieces) > 1:
            fields.append(("WARC-Segment-Number", str(number)))
        if number == len(pieces) > 1:
            fields.append(("WARC-Segment-Total-Length", str(len(block))))
        yield record(fields, piece)


def with_first_copy(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, refers_to (the smallest page_id with the same payload, if it is another one), and named.

    Only one row may have the record id of its page and payload: rows that are ``named`` are the only ones.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    alike = rows.groupBy("sha", "page_id").agg(F.count("*").alias("n"))
    least = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "n"))).alias("least")
    copies = alike.groupBy("sha").agg(least, F.sum("n").alias("n")).filter("n > 1").select(F.col("sha").alias("of"), F.col("least.page_id").alias("first"), F.col("least.n").alias("firsts"))
    joined = rows.join(copies, F.col("sha") == F.col("of"), "left")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "payload", F.when(other, F.col("first")).alias("refers_to"), (~other & (F.coalesce("firsts", F.lit(1)) == 1)).alias("named"))


def write_archives(pages: DataFrame, folder: str, segment: int = SEGMENT, archive: int = ARCHIVE) -> DataFrame:
    """Write pages (page_id, url, html) into archives below ``folder``; returns the manifest, one row per archive."""
    make_folder(folder)

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        attempt, (place, path) = TaskContext.get().taskAttemptId(), filesystem(folder)
        done, out, name, size, count, seen = [], None, "", 0, 0, 0
        for batch in batches:
            columns = (batch.column(c) for c in ("page_id", "url", "payload", "refers_to", "named"))
            for page_id, url, payload, refers_to, named in zip(*columns, strict=True):
                if out is None:
                    name = f"pages-{attempt:09d}-{len(done):05d}.warc.gz"
                    out, size, count = place.open_output_stream(os.path.join(path, name), compression=None), 0, 0
                seen += 1
                own = page_id.as_py() is not None and named.as_py()
                record_id = page_name(page_id.as_py(), payload.as_py()) if own else f"row:{attempt}:{seen}"
                for data in page_records(record_id, page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py(), segment):
                    out.write(data)
                    size, count = size + len(data), count + 1
                if size >= archive:
                    out.close()
                    done.append((name, count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, count, size))
        if done:
            arrays = [pa.array(c, k) for c, k in zip(zip(*done, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["name", "n_records", "n_bytes"])

    return stored(with_first_copy(pages).mapInArrow(write, MANIFEST), "warc-manifest")


def members(source) -> Iterator[bytes | ValueError]:
    """The uncompressed members of a gzip stream, one at a time; for a damaged one, why it cannot be read."""
    unpack, parts, lost = zlib.decompressobj(31), [], False
    held = b""
    while data := source.read(1 << 20):
        data, held = held + data, b""
        while data:
            if lost:  # seek the head of the next member
                at = data.find(MEMBER)
                if at < 0:
                    held = data[1 - len(MEMBER) :]
                    break
                data, lost = data[at:], False
            try:
                parts.append(unpack.decompress(data))
            except zlib.error as problem:
                yield ValueError(f"a damaged member: {problem}")
                # What was fed before is gone; go on behind the head at which this piece begins.
                data, unpack, parts, lost = data[1:], zlib.decompressobj(31), [], True
                continue
            data = unpack.unused_data
            if not unpack.eof:
                break
            yield b"".join(parts)
            unpack, parts = zlib.decompressobj(31), []
    if any(parts):
        yield ValueError("the archive ends inside a record")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields (names in lower case) and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    for name in ("content-length", "warc-type", "warc-record-id"):
        if name not in fields:
            raise ValueError(f"a record without {name}")
    length = int(fields["content-length"])
    if len(rest) < length:
        raise ValueError("the block is shorter than told")
    return fields, rest[:length]


def record_row(data: bytes | ValueError) -> tuple | None:
    """A row of ``RECORD`` for a member; nothing for records that are no page or part of one."""
    try:
        if isinstance(data, ValueError):
            raise data
        fields, block = parse_record(data)
        kind = fields["warc-type"].lower()
        if kind not in ("response", "revisit", "continuation"):
            return None
        page_id, total = fields.get("warc-page-id"), fields.get("warc-segment-total-length")
        return (
            fields["warc-record-id"],
            fields.get("warc-segment-origin-id") or fields["warc-record-id"],
            kind,
            int(fields.get("warc-segment-number", 0)),
            int(total) if total else None,
            int(page_id) if page_id else None,
            fields.get("warc-refers-to"),
            block,
            told_digest(fields.get("warc-payload-digest", "")),
            fields.get("warc-target-uri"),
            None,
        )
    except ValueError as problem:
        return (None, None, None, 0, None, None, None, b"", None, None, str(problem))


def told_digest(field: str) -> str | None:
    """The SHA-1 of a digest field; none where another function was used."""
    kind, _, value = field.partition(":")
    return value.upper() if kind.lower() == "sha1" and value else None


def read_records(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per record of the archives: ids, type, segment number, total length and block."""
    schema = T.StructType.fromDDL(RECORD)

    def read(batches):
        import pyarrow as pa

        arrow = pa.schema([(n, k) for n, k in zip(schema.names, (*[pa.string()] * 3, pa.int32(), *[pa.int64()] * 2, pa.string(), pa.binary(), *[pa.string()] * 3), strict=True)])

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

        place, path = filesystem(folder)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, size = [], 0
                with place.open_input_stream(os.path.join(path, name), compression=None) as source:
                    for data in members(source):
                        row = record_row(data)
                        if row is None:
                            continue
                        rows.append(row)
                        size += len(row[RECORD_BLOCK])
                        if size > 1 << 22:
                            yield table(rows)
                            rows, size = [], 0
                if rows:
                    yield table(rows)

    archives = max(1, manifest.count())
    return manifest.select("name").repartition(archives, "name").mapInArrow(read, schema)


def payload_of(block: bytes) -> tuple[bytes | None, int]:
    """The payload of an HTTP block (None for headers alone) and its length."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("no end of HTTP headers")
    fields = {n.strip().lower(): v.strip() for n, _, v in (line.partition(b":") for line in head.split(b"\r\n")[1:])}
    if fields.get(b"transfer-encoding") == b"chunked":
        payload = unchunked(body)
        return payload, len(payload)
    length = int(fields.get(b"content-length", len(body)))
    return (None if length and not body else body), length


def joined(segments: Iterable[tuple[int, int | None, bytes]]) -> bytes:
    """The block of a record from its segments (number, total length or None, block)."""
    ordered = sorted(segments, key=lambda s: s[0])
    if [number for number, _, _ in ordered] != list(range(1, len(ordered) + 1)):
        raise ValueError("segments are missing or repeated")
    block = b"".join(part for _, _, part in ordered)
    total = ordered[-1][1]
    if total is None:
        raise ValueError("the last segment is missing")
    if total != len(block):
        raise ValueError("the total length is not as told")
    return block


def reassemble(records: DataFrame) -> DataFrame:
    """One row per page of the archives, from whole records and from segments grouped by origin."""
    own = ("record", "page_id", "refers_to", "type", "told", "url", "error")
    whole = records.filter("segment = 0").select(*own, F.array(F.struct("segment", "total", "block")).alias("segments"))
    first = lambda name: F.max(F.when(F.col("segment") == 1, F.col(name))).alias(name)
    parts = F.collect_list(F.struct("segment", "total", "block")).alias("segments")  # bounded by one record's size
    split = records.filter("segment > 0").groupBy("origin").agg(*map(first, own), parts).drop("origin")

    def decode(batches):
        import pyarrow as pa

        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.string())
        names = ["record", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "segments", "error"]
        for batch in batches:
            rows = []
            for record_id, page_id, refers_to, kind, told, url, known, segments in zip(*(batch.column(c) for c in (*own, "segments")), strict=True):
                pieces, size, found, error = segments.as_py(), None, told.as_py(), known.as_py()
                try:
                    if error is None:
                        block = pieces[0]["block"] if pieces[0]["segment"] == 0 else joined((s["segment"], s["total"], s["block"]) for s in pieces)
                        payload, size = payload_of(block)
                        if payload is not None and kind.as_py() != "revisit":
                            found = digest(payload)
                            if told.as_py() not in (None, found):
                                raise ValueError("the payload has another digest than told")
                except ValueError as problem:
                    error = str(problem)
                rows.append((record_id.as_py(), page_id.as_py(), size, found, kind.as_py(), refers_to.as_py(), url.as_py(), len(pieces), error))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return resolved(stored(whole.unionByName(split).mapInArrow(decode, DECODED), "warc-pages"))


def resolved(pages: DataFrame) -> DataFrame:
    """Pages whose ``refers_to`` is the page id of what their reference names: a record, else a payload by its digest.

    A record id or digest that stands for several pages means the least of them, so a row stays one row.
    """
    responses = pages.filter("record_type = 'response' and page_id is not null")
    targets = responses.select(F.explode(F.array("record", F.concat(F.lit("sha1:"), "payload_digest"))).alias("target"), F.col("page_id").alias("referred"))
    targets = targets.groupBy("target").agg(F.min("referred").alias("referred"))
    revisits = pages.filter("record_type = 'revisit'")
    by_record = revisits.join(targets, F.col("refers_to") == F.col("target"), "left").select(*pages.columns, F.col("referred").alias("named"))
    by_digest = by_record.join(targets, F.when(F.col("named").isNull(), F.concat(F.lit("sha1:"), "payload_digest")) == F.col("target"), "left")
    found = by_digest.withColumn("refers_to", F.coalesce("named", "referred"))
    others = pages.filter("record_type is distinct from 'revisit'").withColumn("refers_to", F.lit(None).cast("long"))
    return others.select(*PAGE).unionByName(found.select(*PAGE))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write a table's archives into the shared folder and read their pages back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return reassemble(read_records(write_archives(pages, folder), folder))

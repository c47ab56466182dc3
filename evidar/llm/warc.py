"""WARC archives: a writer that deduplicates payloads into revisit records, and a salvage reader.

The writer makes one gzip member of each record and lets Spark's own file sink write them, so that
archives land whole in any store that Spark reaches. The reader takes archives of gzip members or
of plain records. Where a check fails it searches for the next member or version line that holds a
valid record, goes on from there and logs the bytes between as quarantined. It does so within a
member too, and within what inflates of a broken one.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidar.llm.common import fresh_path, table, written

DATE = "2000-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads of fewer bytes are never revisits.
MIN_REVISIT_BYTES = 0
#: Archives end after so many lots of members; a lot ends with the member that brings it to so many bytes.
LOTS_PER_ARCHIVE, LOT_BYTES = 32, 1 << 20
#: Bytes of payloads in the reader's batches.
BATCH_BYTES = 4 << 20
#: A longer header is damaged.
MAX_HEADER = 1 << 20
_MAGIC = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/1\.[01]\r?\n")
_BLANK = re.compile(rb"\r?\n\r?\n")
_ID = "<urn:evidar:page:%s>"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def make_record(kind: str, record_id: str, block: bytes, fields: dict[str, str]) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", DATE), *fields.items(),
            ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, html: str | None, first_id: int | None) -> bytes:
    """The response with the page's payload or, if first_id is given, the revisit of that page's."""
    payload = (html or "").encode("utf-8", "surrogatepass")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    fields = {} if url is None else {"WARC-Target-URI": _uri(url)}
    fields |= {"Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}"}
    if first_id is None:
        return make_record("response", _ID % page_id, http + payload, fields)
    return make_record("revisit", _ID % page_id, http, fields | {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": _ID % first_id})


def member(record: bytes) -> bytes:
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(record) + press.flush()


#: A member without content, whose last byte is NUL.
_NOTHING = member(b"")


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Writes a record for each row of pages to archives under path. Of rows with equal payloads of
    at least min_bytes bytes, those with the least id are responses and the others revisit it. Archives are
    rolled by their bytes."""
    payload = F.coalesce(pages[html_col], F.lit("")).cast("binary")
    rows = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"), pages[html_col].alias("html"), F.sha1(payload).alias("digest"), F.octet_length(payload).alias("n"))
    firsts = rows.where(F.col("n") >= min_bytes).groupBy("digest", "n").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    firsts = firsts.select(F.col("digest").alias("d"), F.col("n").alias("dn"), "first")
    marked = rows.join(firsts, (F.col("digest") == F.col("d")) & (F.col("n") == F.col("dn")), "left").select(
        "id", "url", "html", F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).alias("first"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot, size = [], 0

        def close() -> pa.RecordBatch:
            # the sink ends each lot with NUL: the last byte of a member of less than 16 MiB, after others one without content
            data = b"".join(lot)
            data = data[:-1] if data[-1] == 0 else data + _NOTHING[:-1]
            lot.clear()
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["lot"])

        for batch in batches:
            for row in zip(*batch.columns):
                lot.append(member(page_record(*(x.as_py() for x in row))))
                size += len(lot[-1])
                if size >= LOT_BYTES:
                    yield close()
                    size = 0
        if lot:
            yield close()

    lots = marked.mapInArrow(build, "lot binary").select(F.col("lot").cast("string").alias("value"))
    lots.write.option("lineSep", "\0").option("maxRecordsPerFile", LOTS_PER_ARCHIVE).text(path)


class Broken(ValueError):
    pass


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Fields, block and end of the record that begins at a place in data. Checks lengths and digests."""
    version = _VERSION.match(data, at)
    if version is None:
        raise Broken("no version line")
    blank = _BLANK.search(data, version.end() - 2, version.end() + MAX_HEADER)
    if blank is None:
        raise Broken("header does not end")
    fields: dict[str, str] = {}
    for line in data[version.end() : blank.start()].decode("utf-8", "replace").splitlines():
        name, colon, value = line.partition(":")
        if not colon:
            raise Broken("header line without colon")
        fields[name.strip().lower()] = value.strip()
    if not re.fullmatch(r"[0-9]+", fields.get("content-length", "")) or not {"warc-type", "warc-record-id"} <= fields.keys():
        raise Broken("header lacks a field")
    stop = blank.end() + int(fields["content-length"])
    if stop > len(data):
        raise Broken("block is cut off")
    block = data[blank.end() : stop]
    end = _BLANK.match(data, stop)
    if end is None:
        raise Broken("record does not end")
    claimed = fields.get("warc-block-digest", "")
    if claimed.startswith("sha1:") and claimed[5:] != base32_sha1(block):
        raise Broken("block digest differs")
    if fields["warc-type"] == "response" and fields.get("warc-payload-digest", "").startswith("sha1:") and fields["warc-payload-digest"][5:] != base32_sha1(payload_of(block)):
        raise Broken("payload digest differs")
    return fields, block, end.end()


def payload_of(block: bytes) -> bytes:
    """What follows the HTTP header; the block itself if it has none."""
    if not block.startswith(b"HTTP/"):
        return block
    return block.partition(b"\r\n\r\n")[2]


CUT_OFF = "member is cut off"
_PADDING = re.compile(rb"[\0\r\n]*")
_START = re.compile(re.escape(_MAGIC) + rb"|WARC/1\.[01]\r?\n")


def _inflate(data: memoryview, at: int) -> tuple[bytes, int, str | None]:
    """Content of the gzip member that begins at a place in data, its end and, if it is broken, why;
    the content is then what inflates, the end where that stops. Its checksum is checked."""
    press, out, fed, step = zlib.decompressobj(31), [], at, 65536
    while not press.eof:
        if fed >= len(data):
            return b"".join(out), fed, CUT_OFF
        before = press.copy() if step > 1 else None
        try:
            out.append(press.decompress(data[fed : fed + step]))
        except zlib.error as e:
            if before is None:
                return b"".join(out), fed, f"member does not inflate: {str(e)[:60]}"
            press, step = before, max(step // 16, 1)  # again in smaller steps, up to the byte that fails
            continue
        fed = min(fed + step, len(data))
    return b"".join(out), fed - len(press.unused_data), None


def _has_digest(fields: dict[str, str]) -> bool:
    """Whether parse_record has checked a digest of the record."""
    return fields.get("warc-block-digest", "").startswith("sha1:") or (fields["warc-type"] == "response" and fields.get("warc-payload-digest", "").startswith("sha1:"))


def _records(content: bytes, sound: bool) -> Iterator[tuple[dict[str, str] | None, bytes, str | None]]:
    """(fields, block, None) of each record of a member's content and (None, b"", reason) for each gap.
    Where the content is not sound, a record without a digest cannot be told from a damaged one."""
    at, reason = 0, None
    while (at := _PADDING.match(content, at).end()) < len(content):
        try:
            fields, block, end = parse_record(content, at)
            if not sound and not _has_digest(fields):
                raise Broken("record without digest in a broken member")
        except Broken as e:
            reason = reason or f"{e}, at {at} of the member's content"
            following = _VERSION.search(content, at + 1)
            at = following.start() if following else len(content)
            continue
        if reason:
            yield None, b"", reason
            reason = None
        yield fields, block, None
        at = end
    if reason:
        yield None, b"", reason


def _unit(data: bytes, view: memoryview, at: int) -> tuple[list[tuple[dict[str, str] | None, bytes, str | None]], int, str | None]:
    """Records and gaps of the member, or the plain record, that begins at a place; its end; and, if it
    is broken as a whole, why: then there are only the records that are left of it."""
    if data.startswith(_MAGIC, at):
        content, end, why = _inflate(view, at)
        found = list(_records(content, why in (None, CUT_OFF)))
        if why:
            return [u for u in found if u[2] is None], end, why
        return found, end, None
    try:
        fields, block, end = parse_record(data, at)
    except Broken as e:
        return [], at, str(e)
    return [(fields, block, None)], end, None


def salvage(data: bytes) -> Iterator[tuple[str, int, int, dict[str, str] | None, bytes, str | None]]:
    """(kind, start, end, fields, block, reason) of each record and, of kind gap, of each quarantined
    range of bytes. NUL bytes and line ends between records are padding. What is in a member has the
    member's start and end; records left of a broken member come before the gap that begins with it."""
    view, at = memoryview(data), 0
    gap, reason = None, None
    #: Where the last broken member stopped to inflate and what it gave: stored blocks show it again.
    stopped, given = 0, set()
    while (at := at if gap is not None else _PADDING.match(data, at).end()) < len(data):
        units, end, why = _unit(data, view, at)
        again = at < stopped and not data.startswith(_MAGIC, at) and why is None and (units[0][0]["warc-record-id"], units[0][1]) in given
        if again:
            why, units = reason, []
        if (units or why is None) and gap is not None:
            yield "gap", gap, at, None, b"", reason
            gap = None
        for fields, block, inner in units:
            yield "record" if inner is None else "gap", at, end, fields, block, inner
        if why is None:
            at = end
            continue
        if gap is None:
            gap, reason = at, why
        if units:
            stopped, given = end, {(fields["warc-record-id"], block) for fields, block, _ in units}
        following = _START.search(data, end if again else at + 1)
        at = following.start() if following else len(data)
    if gap is not None:
        yield "gap", gap, len(data), None, b"", reason


ROW = ("archive string, kind string, start long, stop long, reason string, warc_type string, record_id string, target_uri string, "
       "refers_to string, claimed_digest string, payload binary, payload_bytes long, payload_digest string")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record (kind record) and each quarantined range of bytes (kind gap) of the
    archives under path. payload_bytes and payload_digest are of the payload as found in the record;
    a revisit has none. A task reads its archives one after another, each whole, since Spark has no source of
    ranges of bytes; so none should be above 1 GiB."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (x.split(" ") for x in ROW.split(", "))])
        for batch in batches:
            for k in range(batch.num_rows):
                archive, rows, size = batch.column(0)[k].as_py(), [], 0
                for kind, start, stop, fields, block, reason in salvage(batch.column(1)[k].as_py()):
                    fields = fields or {}
                    payload = payload_of(block) if fields.get("warc-type") in ("response", "resource", "conversion") else None
                    rows.append({
                        "archive": archive, "kind": kind, "start": start, "stop": stop, "reason": reason, "warc_type": fields.get("warc-type"),
                        "record_id": fields.get("warc-record-id"), "target_uri": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to"),
                        "claimed_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, "payload": payload,
                        "payload_bytes": None if payload is None else len(payload), "payload_digest": None if payload is None else base32_sha1(payload)})
                    size += len(payload or b"")
                    if size > BATCH_BYTES or len(rows) >= 10_000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, ROW)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Writes pages to archives and returns what the salvage reader finds: id, payload_bytes,
    payload_digest, record_type, refers_to for each record.

    A null html counts as empty. A null id comes after all others and is read back as null. Rows that
    repeat id and payload are responses each. An empty table gives no rows. Very long pages are records
    of their own size; other columns play no part. A revisit gets the size and digest of the response that
    it refers to. Raises where the archives do not give back every page.
    """
    path = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, path, id_col, url_col, html_col, min_bytes)
    found, gaps = read_back(pages.sparkSession, path, pages.schema[id_col].dataType.simpleString())
    given, came = pages.count(), found.count()
    if given != came:
        lost = gaps.orderBy("archive", "start").limit(5).collect()
        raise RuntimeError(f"{given - came} of {given} pages did not come back; first gaps: {[(r.archive, r.start, r.stop, r.reason) for r in lost]}")
    return found


def read_back(spark: SparkSession, path: str, kind: str = "long") -> tuple[DataFrame, DataFrame]:
    """What the salvage reader finds of archives of pages: id (of this kind), payload_bytes, payload_digest, record_type,
    refers_to of each record, and the quarantine log: archive, start, stop, reason of each gap. A revisit whose
    response is lost has neither size nor digest."""
    page_of = lambda c: F.regexp_extract(c, r"^<urn:evidar:page:(.*)>$", 1)
    read = written(read_archives(spark, path).drop("payload", "target_uri"), "warc-records")
    gaps = read.where("kind = 'gap'").select("archive", "start", "stop", "reason")
    found = read.where("warc_type in ('response', 'revisit')").select(
        page_of("record_id").alias("page"), page_of("refers_to").alias("refers"), "warc_type", "payload_bytes", "payload_digest", "claimed_digest")
    responses = found.where("warc_type = 'response'").groupBy(F.col("page").alias("of"), F.col("payload_digest").alias("of_digest")).agg(F.max("payload_bytes").alias("of_bytes"))
    revisits = found.where("warc_type = 'revisit'").join(responses, (F.col("refers") == F.col("of")) & (F.col("claimed_digest") == F.col("of_digest")), "left")
    as_id = lambda c: F.when(F.col(c) != "None", F.col(c)).cast(kind)
    rows = found.where("warc_type = 'response'").select(
        as_id("page").alias("id"), "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), F.lit(None).cast(kind).alias("refers_to")
    ).unionByName(revisits.select(
        as_id("page").alias("id"), F.col("of_bytes").alias("payload_bytes"), F.col("of_digest").alias("payload_digest"), F.col("warc_type").alias("record_type"), as_id("refers").alias("refers_to")))
    return rows, gaps


def op3_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, body, sha1(body) AS hex, min(page_id) OVER (PARTITION BY body) AS first_id FROM p),
d AS (SELECT page_id, strlen(body) AS payload_bytes, first_id,
             list_transform(range(8), lambda g: ('0x' || substr(hex, (g * 5 + 1)::BIGINT, 5))::BIGINT) AS groups FROM h)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(groups, lambda v:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 15) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 10) & 31) + 1, 1) ||
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 5) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v & 31) + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d
"""

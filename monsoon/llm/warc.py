"""WARC archives: a writer with revisit records, and a reader that salvages.

The writer makes every record an expression and lets Spark write them as text files with
the record separator as line separator, which is a WARC file, committed like any output of
a job. Compressed, every record is a gzip member of its own, so that damage costs no other.
Equal payloads are one response and revisits that refer to it.

The reader takes whole files, plain or gzip, as one member or as many. A record that fails
a check (version line, headers, length, end of record, payload digest) or a member that
fails to unpack is not trusted: the reader looks for the next version line or the next
member that unpacks, goes on from there, and reports the bytes between as a gap, with their
range in the file. Lines end in CR LF, as the format says; a file of other line ends is a gap.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monsoon.llm.common import spread_join, table, written
from monsoon.session import scratch

# Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MEMBER = b"\x1f\x8b\x08"
MARK = b"WARC/1."
BLANK_LINE = b"\r\n\r\n"

PAGE_URN = "urn:page:"
DATE = "2026-01-01T00:00:00Z"
RECORDS_PER_FILE = 2_000
STEP = 1 << 16
# What a task can hold of one file as one value.
LARGEST_FILE = (1 << 31) - (1 << 20)

RECORD = (
    "file string, start long, length long, file_start long, file_length long, problem string, "
    "record_type string, record_id string, target_uri string, payload_digest string, "
    "refers_to string, payload_bytes long, payload binary"
)
GAP = ["file", "file_start", "file_length", "start", "length", "problem"]


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, record_type and refers_to of every row.

    Of rows with equal payloads the largest page_id is the response, the others revisit it.
    Rows that repeat the largest page_id are responses too, and so are all rows of a payload
    none of which has a page_id.
    """
    rows = pages.select(
        "page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")
    )
    rows = rows.withColumn("sha1", F.sha1("payload")).withColumn(
        "same", F.concat("sha1", F.lit("-"), F.length("payload").cast("string"))
    )
    first = rows.groupBy("same").agg(
        F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("copies")
    )
    joined = spread_join(rows, first, "same", "copies", F.xxhash64("page_id", "url"))
    revisit = F.coalesce(F.col("page_id") != F.col("response_id"), F.col("response_id").isNotNull())
    return joined.select(
        "page_id",
        "url",
        "payload",
        _base32("sha1").alias("digest"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("response_id")).alias("refers_to"),
    )


def _base32(hex_column: str) -> Column:
    """Base32 of 40 hex digits: every five of them, 20 bits, are four digits."""
    return F.expr(
        f"array_join(transform(sequence(0, 31), i -> substring('{BASE32}', 1 + cast("
        f"shiftright(cast(conv(substring({hex_column}, (i div 4) * 5 + 1, 5), 16, 10) AS int),"
        " 15 - 5 * (i % 4)) & 31 AS int), 1)), '')"
    )


def records(pages: DataFrame, date: str = DATE) -> DataFrame:
    """One column, ``value``: a WARC record without its end."""
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7f]", "")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.length("payload").cast("string"),
        F.lit("\r\n\r\n"),
    )
    body = F.concat(
        http, F.when(F.col("record_type") == "response", F.col("payload").cast("string")).otherwise("")
    )

    def urn(name: str) -> Column:
        page = F.coalesce(F.col(name).cast("string"), F.lit("none"))
        return F.concat(F.lit(f"<{PAGE_URN}"), page, F.lit(">"))

    head = F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "),
        "record_type",
        F.lit("\r\nWARC-Record-ID: "),
        urn("page_id"),
        F.lit(f"\r\nWARC-Date: {date}"),
        F.when(uri != "", F.concat(F.lit("\r\nWARC-Target-URI: "), uri)).otherwise(""),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        "digest",
        F.when(
            F.col("record_type") == "revisit",
            F.concat(
                F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: "),
                urn("refers_to"),
            ),
        ).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return pages.select(F.concat(head, body).alias("value"))


def _packed(batches):
    import zlib

    import pyarrow as pa

    def member(data: bytes) -> bytes:
        packer = zlib.compressobj(wbits=31)
        return packer.compress(data) + packer.flush()

    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            out = []
            for value in batch.column(0).slice(at, 64):
                packed = member(value.as_py() + END.encode())
                # The line separator is the last byte: zero but for 16 MB and more, which
                # an empty member is put behind.
                if packed[-1]:
                    packed += member(b"")
                out.append(packed[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def write_archives(
    pages: DataFrame, path: str, per_file: int = RECORDS_PER_FILE, compression: str | None = None
) -> None:
    """Write the rows as WARC files, none with more than ``per_file`` records.

    ``compression`` is gzip or none. Packed files have no ending that says so.
    """
    if compression not in (None, "none", "gzip"):
        raise ValueError(f"archives are gzip-compressed or plain, not {compression}")
    rows, end = records(with_revisits(pages)), END
    if compression == "gzip":
        members = rows.select(F.col("value").cast("binary")).mapInArrow(_packed, "value binary")
        rows, end = members.select(F.col("value").cast("string")), "\0"
    rows.write.option("lineSep", end).option("compression", "none").option(
        "maxRecordsPerFile", per_file
    ).text(path)


def unpacked(data: bytes) -> Iterator[tuple[int, int, bytes, str | None]]:
    """(offset, length in the file, bytes, problem) of each gzip member, and of each gap
    between members.

    What a broken member gave before it broke comes as bytes of its own, ahead of the gap. A
    file that does not begin with a member is one piece as it is if no member is found. If
    one is and there is a version line ahead of it, the reading counts that loses fewer bytes.
    """
    if data.startswith(MEMBER):
        yield from _members(data, 0)
        return
    line = data.find(MARK)
    # Members that unpack to something else may be payloads.
    at = _member(data, 0, MARK) if line != 0 else -1
    if at < 0 and line < 0:
        at = _member(data, 0)
    plain = at < 0
    if 0 <= line < at:
        lost = at + sum(size for _, size, _, problem in _members(data, at) if problem)
        plain = sum(r["length"] for r in salvaged(data) if r.get("problem")) < lost
    if plain:
        yield 0, len(data), data, None
        return
    if at:
        yield 0, at, data[:at], "member: no beginning"
    yield from _members(data, at)


def _members(data: bytes, at: int) -> Iterator[tuple[int, int, bytes, str | None]]:
    import zlib

    view = memoryview(data)
    while at < len(data):
        member, out, read = zlib.decompressobj(31), [], at
        problem = None
        try:
            while not member.eof and read < len(data):
                out.append(member.decompress(view[read : read + STEP]))
                read += STEP
            if not member.eof:
                problem = "member: cut off"
        except zlib.error as error:
            problem = f"member: {error}"
            out = [_decoded(view[at : read + STEP])]
        if problem is None:
            stop = min(read, len(data)) - len(member.unused_data)
        else:
            nearest = _member(data, at + 1)
            stop = nearest if nearest >= 0 else len(data)
        if out and (problem is None or any(out)):
            yield at, stop - at, b"".join(out), None
        if problem is not None:
            yield at, stop - at, data[at:stop], problem
        at = stop


def _decoded(data: memoryview) -> bytes:
    """All that a broken member gives before it breaks, which is in its last step."""
    import zlib

    member, last = zlib.decompressobj(31), max(0, (len(data) - 1) // STEP * STEP)
    out = [member.decompress(data[at : at + STEP]) for at in range(0, last, STEP)]
    try:
        for at in range(last, len(data)):
            out.append(member.decompress(data[at : at + 1]))
    except zlib.error:
        pass
    return b"".join(out)


def _member(data: bytes, at: int, start: bytes = b"") -> int:
    """Where the next member is that unpacks, to bytes that begin with ``start``, or -1."""
    at = data.find(MEMBER, at)
    while at >= 0 and not _begins(data, at, start):
        at = data.find(MEMBER, at + 1)
    return at


def _begins(data: bytes, at: int, start: bytes) -> bool:
    import zlib

    try:
        found = zlib.decompressobj(31).decompress(data[at : at + 65536], 64)
    except zlib.error:
        return False
    return bool(found) and found.startswith(start)


def salvaged(data: bytes) -> Iterator[dict]:
    """The records of plain WARC bytes, and with ``problem`` set, the gaps between them.

    Places of blank lines are looked for once, so that bytes full of version lines take a
    time in proportion to their length.
    """
    import base64
    import hashlib

    at, gap, why, blank = 0, None, "", -1

    def lost(start, stop):
        return {"start": start, "length": stop - start, "problem": why}

    while at < len(data):
        if blank < at:
            found = data.find(BLANK_LINE, at)
            blank = found if found >= 0 else len(data)
        record, problem = _record(data, at, blank)
        if record is not None and record["payload"] is not None and record["digest_kind"] == "sha1":
            digest = base64.b32encode(hashlib.sha1(record["payload"]).digest()).decode()
            if record["payload_digest"].upper() != digest:
                record, problem = None, "payload digest"
        if record is not None:
            if gap is not None:
                yield lost(gap, at)
                gap = None
            at += record["length"]
            del record["digest_kind"]
            yield record
            continue
        if gap is None:
            gap, why = at, problem
        nearest = data.find(MARK, at + 1)
        at = nearest if nearest >= 0 else len(data)
    if gap is not None:
        yield lost(gap, len(data))


def _record(data: bytes, at: int, stop: int) -> tuple[dict | None, str]:
    """The record that begins there, or what is wrong with it; ``stop`` is where the next
    blank line is, or the end of the data."""
    if not data.startswith(MARK, at):
        return None, "version line"
    # A version line ahead of the blank line begins another record.
    if stop == len(data) or data.find(b"\n" + MARK, at, stop) >= 0:
        return None, "headers"
    lines = data[at:stop].split(b"\r\n")[1:]
    if any(b":" not in line for line in lines):
        return None, "headers"
    head = {}
    for line in lines:
        name, _, value = line.partition(b":")
        head[name.strip().lower()] = value.strip().decode("utf-8", "replace")
    if not head.get(b"warc-type") or not head.get(b"warc-record-id"):
        return None, "headers"
    size = head.get(b"content-length", "")
    if not (size.isascii() and size.isdigit()):
        return None, "length"
    begin = stop + 4
    end = begin + int(size)
    if data[end : end + 4] != END.encode():
        return None, "length" if end + 4 <= len(data) else "cut off"
    block = data[begin:end]
    payload, size_of = block, len(block)
    if head.get(b"content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        size_of = len(payload)
        if head.get(b"warc-type") == "revisit":
            for line in http.split(b"\r\n"):
                name, _, value = line.partition(b":")
                if name.strip().lower() == b"content-length" and value.strip().isdigit():
                    size_of = int(value)

    def uri(name: bytes) -> str | None:
        return head.get(name, "").strip("<>") or None

    kind, _, digest = head.get(b"warc-payload-digest", "").rpartition(":")
    return {
        "start": at,
        "length": end + 4 - at,
        "record_type": head.get(b"warc-type"),
        "record_id": uri(b"warc-record-id"),
        "target_uri": uri(b"warc-target-uri"),
        "digest_kind": kind.lower() if len(digest) == 32 else "",
        "payload_digest": digest or None,
        "refers_to": uri(b"warc-refers-to"),
        "payload_bytes": size_of,
        "payload": payload if head.get(b"warc-type") != "revisit" else None,
    }, ""


def recovered(data: bytes) -> Iterator[dict]:
    """Records and gaps of one file; places in a packed file are those of the members."""
    for offset, size, piece, problem in unpacked(data):
        own = {"start": offset, "file_start": offset, "file_length": size}
        if problem:
            yield own | {"length": size, "problem": problem}
        else:
            packed = piece is not data
            for row in salvaged(piece):
                yield row | (own if packed else {"file_start": row["start"], "file_length": row["length"]})


def _reader(with_payload: bool):
    schema = T.StructType.fromDDL(RECORD)

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, out, held = to_arrow_schema(schema), [], 0
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                for row in recovered(content.as_py()):
                    held += len(row.get("payload") or b"")
                    if not with_payload:
                        row["payload"] = None
                    out.append(row | {"file": file.as_py()})
                    if held > 1 << 24 or len(out) >= 4096:
                        yield pa.RecordBatch.from_pylist(out, schema=arrow)
                        out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return run, schema


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records and gaps of all archives under the path; a gap has ``problem`` set.

    A row gives file, start (in a packed file, of the member) and length, file_start and
    file_length (the range in the file, of a packed one that of the member), and for records
    type, id, target, digest, the id referred to and the full payload's size. A task reads
    whole files, together no more than spark.sql.files.maxPartitionBytes unless a single one
    is larger; the writer bounds its files. Empty files give no rows. A file of LARGEST_FILE
    bytes or more is one gap, since no task can hold it.
    """
    run, schema = _reader(payload)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    small = F.col("length") < LARGEST_FILE
    read = files.filter(small).select("path", "content").mapInArrow(run, schema)
    return read.unionByName(_too_large(files.filter(~small)), allowMissingColumns=True)


def _too_large(files: DataFrame) -> DataFrame:
    none = F.lit(0).cast("long")
    return files.select(
        F.col("path").alias("file"),
        none.alias("start"),
        "length",
        none.alias("file_start"),
        F.col("length").alias("file_length"),
        F.lit("file: too large").alias("problem"),
    )


def salvage(spark: SparkSession, path: str, log: str) -> DataFrame:
    """All records under the path, without payloads; the gaps go to ``log``, a JSON line each.

    Archives are read once: what was found is written to the scratch folder. A log that is
    there already is replaced; without gaps it is empty.
    """
    found = written(read_archives(spark, path, payload=False).drop("payload"), "salvaged")
    found.filter("problem IS NOT NULL").select(*GAP).write.mode("overwrite").json(log)
    return found.filter("problem IS NULL")


def page_records(read: DataFrame) -> DataFrame:
    """The contract's columns of records that the writer made."""

    def page(name: str) -> Column:
        return F.expr(f"try_cast(substring({name}, {len(PAGE_URN) + 1}) AS bigint)")

    return read.filter("problem IS NULL").select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )


def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written to packed archives and read back; see ``with_revisits`` for ties.

    A null html is an empty payload. Repeated rows are each a record; a page without page_id
    comes back without. Other columns are ignored. An empty table gives no rows.
    """
    path = scratch(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path, compression="gzip")
    return page_records(salvage(spark, path, f"{path}-gaps"))

"""WARC archives: a writer of one gzip member per record, and a sequential reader.

Archives are files under a folder that all executors reach, written by the tasks themselves as a
stream. A task that is lost leaves files that no list names: what counts is the list, which Spark
commits. The reader goes through an archive once, from front to back, with incremental decompression;
it frames records by their content length, checks that member and record end together, and verifies
block and payload digests. It holds one piece of the archive at a time, and of a record either the
payload or, where only its digest is asked for, its headers.

Of records with equal payloads that with the largest key is a response; the others are revisits of
profile identical-payload-digest, which have the HTTP headers and no payload.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourledger.llm.staging import staged
from hourledger.operators.reduced import join_reduced

#: Bytes of an archive after which the next record begins another one.
ARCHIVE_BYTES = 256 << 20
#: Bytes read from an archive at a time, and made of them at a time.
READ, MADE = 1 << 20, 1 << 20
#: Bytes of headers; what has more is no record.
MOST_HEADER = 1 << 20
#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"
LINE, END_OF_HEADERS, END_OF_RECORD = b"\r\n", b"\r\n\r\n", b"\r\n\r\n"
KEY_FIELD = "X-Row-Key"
CONTROL = re.compile(r"[\x00-\x20\x7f\u0085\u2028\u2029]")

ARCHIVES = "archive string, records long, bytes long"
TEXT, NUMBER, BYTES = (T.StringType(), pa.string()), (T.LongType(), pa.int64()), (T.BinaryType(), pa.binary())
COLUMNS = {
    "archive": TEXT, "offset": NUMBER, "record_type": TEXT, "record_id": TEXT, "refers_to_id": TEXT, "key": TEXT, "uri": TEXT,
    "payload_bytes": NUMBER, "payload_digest": TEXT, "payload": BYTES, "problem": TEXT,
}
RECORDS = T.StructType([T.StructField(name, kind) for name, (kind, _) in COLUMNS.items()])


def sha1_base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def one_line(value: str) -> str:
    """Text that cannot end a header line: white space and control characters are escaped as in URLs."""
    return CONTROL.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), value)


def record_id(key: str | None, kind: str, payload_sha256: str) -> str:
    """The same for the same row, however often its task runs."""
    name = hashlib.sha256(f"{kind}\n{payload_sha256}\n{'' if key is None else '=' + key}".encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=name[:16], version=4)}>"


def http_headers(length: int) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length


def make_record(key: str | None, uri: str | None, payload: bytes, first_key: str | None, revisit: bool, date: str) -> bytes:
    """One record as it stands in an archive before compression."""
    content = hashlib.sha256(payload).hexdigest()
    headers = http_headers(len(payload))
    block = headers if revisit else headers + payload
    own = record_id(key, f"revisit {uri}" if revisit else "response", content)
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", own), ("WARC-Date", date)]
    if uri is not None:
        fields.append(("WARC-Target-URI", one_line(uri)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(first_key, "response", content))]
    fields += [
        ("WARC-Payload-Digest", f"sha1:{sha1_base32(hashlib.sha1(payload).digest())}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(hashlib.sha1(block).digest())}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if key is not None:
        fields.append((KEY_FIELD, one_line(key)))
    head = LINE.join([VERSION, *(f"{name}: {value}".encode() for name, value in fields)])
    return head + END_OF_HEADERS + block + END_OF_RECORD


def gzip_member(data: bytes) -> bytes:
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def write_warc(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", least_bytes: int = 0, date: str = EPOCH, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write a record of every row into archives under `folder`; archive, records and bytes of each.

    The payload is the text in UTF-8, empty for a null one. Of rows whose payloads are equal and have
    at least `least_bytes` that with the largest id is a response and the others refer to it; rows that
    share the largest id and the payload are all responses of one record id. A null id is smaller than
    any other. A null URL gives no URI; line ends and white space in URLs and ids are escaped, so they
    cannot end a header. An empty table gives no archive. Other columns are not read. Payloads are
    compared by SHA-256; one held by any share of the rows is split over tasks.
    """
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("uri"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    digest = F.sha2(F.col("text").cast("binary"), 256)
    # Only ids and digests are grouped; texts move once, to the answer.
    groups = rows.select("id", digest.alias("content")).groupBy("content").agg(F.max("id").alias("first"), F.count("*").alias("n"))
    judged = join_reduced(rows.withColumn("content", digest), groups.where("n > 1").drop("n"), ["content"])
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")) & (F.octet_length("text") >= least_bytes)
    planned = judged.select(F.col("id").cast("string").alias("key"), "uri", "text", F.col("first").cast("string").alias("first"), F.coalesce(revisit, F.lit(False)).alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top)
        out, name, done, size = None, "", 0, 0

        def listed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([done]), pa.array([size])], ["archive", "records", "bytes"])

        try:
            for batch in batches:
                for key, uri, text, first, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None:
                        # A name of its own for each attempt: a repeated task never writes into another's file.
                        name, done, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = store.open_output_stream(f"{top}/{name}", compression=None)
                    member = gzip_member(make_record(key, uri, text.encode(), first, again, date))
                    out.write(member)
                    done, size = done + 1, size + len(member)
                    if size >= archive_bytes:
                        out.close()
                        yield listed()
                        out = None
            if out is not None:
                out.close()
                yield listed()
                out = None
        finally:
            if out is not None:
                out.close()

    return staged(planned.mapInArrow(write, ARCHIVES), "archives")


class Member:
    """The bytes of one gzip member of a stream, decompressed piece by piece."""

    def __init__(self, source: Source):
        self.source = source
        self.gzip = zlib.decompressobj(31)
        self.made = bytearray()

    def more(self) -> bool:
        """Decompress a piece; false where the member is at its end."""
        if self.gzip.eof:
            return False
        data = self.gzip.unconsumed_tail or self.source.take()
        if not data:
            raise ValueError("the archive ends within a member")
        self.made += self.gzip.decompress(data, MADE)
        if self.gzip.eof:
            self.source.give_back(self.gzip.unused_data)
        return True

    def until(self, mark: bytes) -> bytes:
        """What stands before the mark, which is taken, too."""
        looked = 0
        while (at := self.made.find(mark, looked)) < 0:
            if len(self.made) > MOST_HEADER:
                raise ValueError("the headers are too long")
            looked = max(0, len(self.made) - len(mark) + 1)
            if not self.more():
                raise ValueError("the headers have no end")
        found = bytes(self.made[:at])
        del self.made[: at + len(mark)]
        return found

    def exactly(self, count: int) -> Iterator[bytes]:
        """So many bytes, in pieces."""
        while count:
            while not self.made:
                if not self.more():
                    raise ValueError("the record is shorter than its content length")
            piece = bytes(self.made[:count])
            del self.made[:count]
            count -= len(piece)
            yield piece

    def rest(self) -> bytes:
        """What is left, up to a little more than a record may end with."""
        while len(self.made) <= len(END_OF_RECORD) and self.more():
            pass
        return bytes(self.made)

    def skip(self) -> None:
        while self.more():
            self.made.clear()


class Source:
    """An archive read from front to back, and the place of the next byte."""

    def __init__(self, stream):
        self.stream, self.kept, self.place = stream, b"", 0

    def take(self) -> bytes:
        data, self.kept = self.kept or self.stream.read(READ), b""
        self.place += len(data)
        return data

    def give_back(self, data: bytes) -> None:
        self.kept, self.place = data, self.place - len(data)

    def at_end(self) -> bool:
        if not self.kept:
            self.kept = self.stream.read(READ)
        return not self.kept


def parse_fields(head: bytes) -> dict[str, str]:
    version, *lines = head.split(LINE)
    if not version.startswith(b"WARC/"):
        raise ValueError("no record begins here")
    fields: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            raise ValueError("a header line has no colon")
        fields.setdefault(name.strip().lower(), value.strip())
    return fields


def verified(stated: str | None, digest: hashlib._Hash) -> bool:
    """Whether a digest is as stated; one of another kind, or none, cannot be told."""
    kind, _, value = (stated or "").partition(":")
    return kind.lower() != "sha1" or value.upper() == sha1_base32(digest.digest())


def read_record(member: Member, payloads: bool) -> dict:
    """The next record of a member. A revisit's payload digest and length are those it states."""
    fields = parse_fields(member.until(END_OF_HEADERS))
    length = fields.get("content-length", "")
    if not re.fullmatch("[0-9]+", length):
        raise ValueError("the content length is no number")
    kind = fields.get("warc-type", "")
    pieces = member.exactly(int(length))
    block, payload, kept, count = hashlib.sha1(), hashlib.sha1(), [], 0
    http = fields.get("content-type", "").replace(" ", "").lower().startswith("application/http")
    head, in_head = bytearray(), http
    for piece in pieces:
        block.update(piece)
        if in_head:
            looked = max(0, len(head) - len(END_OF_HEADERS) + 1)
            head += piece
            at = head.find(END_OF_HEADERS, looked)
            if at < 0:
                if len(head) > MOST_HEADER:
                    raise ValueError("the headers are too long")
                continue
            piece, in_head = bytes(head[at + len(END_OF_HEADERS) :]), False
            del head[at:]
        payload.update(piece)
        count += len(piece)
        if payloads:
            kept.append(piece)
    if member.rest() != END_OF_RECORD or member.more():
        raise ValueError("the record does not end with its member")
    stated = fields.get("warc-payload-digest")
    problem = None if verified(fields.get("warc-block-digest"), block) else "block digest"
    found = sha1_base32(payload.digest())
    if kind == "revisit":
        found = stated.partition(":")[2].upper() if (stated or "").lower().startswith("sha1:") else None
        sizes = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)[ \t\r]*$", bytes(head))
        count = int(sizes[1]) if sizes else None
    elif not verified(stated, payload):
        problem = problem or "payload digest"
    return {
        "record_type": kind, "record_id": fields.get("warc-record-id"), "refers_to_id": fields.get("warc-refers-to"), "key": fields.get(KEY_FIELD.lower()),
        "uri": fields.get("warc-target-uri"), "payload_bytes": count, "payload_digest": found,
        "payload": b"".join(kept) if payloads and kind != "revisit" else None, "problem": problem,
    }


def read_archive(stream, payloads: bool) -> Iterator[dict]:
    """All records from front to back. A record that cannot be read is a row with the problem; where
    its member cannot be decompressed to its end, nothing after it can be found."""
    source = Source(stream)
    while not source.at_end():
        offset, member = source.place, Member(source)
        try:
            found = read_record(member, payloads)
        except (ValueError, zlib.error) as why:
            found = {"problem": str(why)}
        yield {"offset": offset} | found
        try:
            member.skip()
        except (ValueError, zlib.error) as why:
            if found.get("problem") != str(why):
                yield {"offset": source.place, "problem": str(why)}
            return


def read_warc(spark: SparkSession, folder: str, archives: DataFrame, payloads: bool = False) -> DataFrame:
    """Every record of the listed archives (a column `archive`, paths under `folder`), in the columns of RECORDS.

    `problem` is null for a record that is whole and as its digests say. Payloads are read into rows
    only where asked for; else a record of any length takes no memory. An archive is read by one
    task; the writer begins a new one at `archive_bytes`. No archives give no rows.
    """
    names = archives.select(F.col("archive").cast("string").alias("archive"))
    count = max(1, names.count())
    tasks = min(count, 4 * spark.sparkContext.defaultParallelism)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        schema = pa.schema([(column, kind) for column, (_, kind) in COLUMNS.items()])
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_stream(f"{top}/{name}", compression=None, buffer_size=0) as stream:
                    rows, held = [], 0
                    for found in read_archive(stream, payloads):
                        rows.append({"archive": name} | found)
                        held += len(found.get("payload") or b"")
                        if len(rows) >= 10_000 or held >= 4 * MADE:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return names.repartition(tasks, F.xxhash64("archive")).mapInArrow(read, RECORDS)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Key, record_type, payload_bytes and payload_digest of every record that is whole, and for revisits
    refers_to, the key of the response they name, whose length and digest count as theirs.

    A revisit whose response is missing, or has another digest than the revisit states, gets null in
    these three. Responses that share a record id are one.
    """
    whole = records.where("problem is null and record_type in ('response', 'revisit')")
    first = (
        whole.where("record_type = 'response' and record_id is not null")
        .groupBy(F.col("record_id").alias("refers_to_id"))
        .agg(F.max(F.struct("payload_digest", "payload_bytes", "key")).alias("first"))
    )
    narrow = whole.select("record_type", "refers_to_id", "key", "payload_bytes", "payload_digest")
    responses = narrow.where("record_type = 'response'").select("key", "record_type", "payload_bytes", "payload_digest", F.lit(None).cast("string").alias("refers_to"))
    joined = join_reduced(narrow.where("record_type = 'revisit'"), first, ["refers_to_id"])
    good = F.col("payload_digest") == F.col("first.payload_digest")
    revisits = joined.select(
        "key", "record_type", F.when(good, F.col("first.payload_bytes")).alias("payload_bytes"), F.when(good, F.col("first.payload_digest")).alias("payload_digest"), F.when(good, F.col("first.key")).alias("refers_to")
    )
    return responses.unionByName(revisits)

"""WARC archives compressed by Zstandard, as a Spark data source that writes and reads them.

An archive starts with a skippable frame (magic number 0x184D2A5D) that holds the dictionary, itself
compressed or plain; after it each record is a frame of its own, compressed with that dictionary.  The
reader loads the dictionary, decodes one frame after the other as the file streams by, and checks every
record: the version line, the headers that must be there, that the frame holds exactly the header, the
block of the stated length and the two line ends, the digest of the block, the length and the digest of
the payload, and that a revisit says which profile it has and what it refers to.  Frames that are skippable
elsewhere are passed over; an archive without a dictionary frame has none.

A record whose payload has been written before is a ``revisit``: it keeps the HTTP header (with the length
of the whole payload) and the payload's digest, and refers to the ``response`` that holds the payload.

Writing: each task writes archives of about ``roll`` bytes under names of its own; a dictionary is trained
from the first ``SAMPLE`` bytes of an archive's payloads, none if they are too few.  The job's commit
lists the archives in a manifest, and readers read what a manifest names, so what a lost or repeated task
leaves behind is never read.  A folder without a manifest is read whole (``*.warc.zst``).

``mode``: ``FAILFAST`` (a record that fails a check ends the job) or ``PERMISSIVE`` (it becomes a row with
``error`` set, and reading goes on at the next frame that decodes).

Defined cases: a null payload is empty; a null url has no target header; control characters of a url are
percent-encoded; texts of any length are one record; repeated rows are records of their own; rows without
a page_id are revisits of the response with an equal payload, and responses if none has a page_id; rows
that share the smallest page_id are all responses; extra columns are not looked at; an empty table makes
archives without pages, or none.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from adherence.llm.base import shared_dir, table
from adherence.sources.gtfs_static import _fs

#: Fixed values of the formats: magic numbers of frames, the version lines, a revisit's profile, record types.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGIC = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MUST_HAVE = ("warc-record-id", "content-length", "warc-date", "warc-type")

#: Bytes of payload that a dictionary is trained on, and bytes of the dictionary.
SAMPLE, DICTIONARY = 1 << 20, 1 << 15
#: Compressed bytes after which a task begins a new archive; bytes read at a time.
ROLL, CHUNK = 1 << 27, 1 << 18
#: Responses and revisits meet by a broadcast of the payloads that several pages have, up to so many.
BROADCAST_PAYLOADS = 500_000
SALTS = 32

RECORD = ("record_id string, record_type string, date string, target_uri string, refers_to string, "
          "payload_length long, payload_digest string, payload binary, archive string, place long, error string")
_TYPES = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.string()]
_NAMES = [c.split()[0] for c in RECORD.split(", ")]


class WarcError(ValueError):
    """An archive or a record that breaks the format."""


def sha1(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(record_id: str, record_type: str, date: str, payload: bytes, target_uri: str | None = None, refers_to: str | None = None) -> bytes:
    """One record.  A response holds the payload below an HTTP header, a revisit the header only; the
    payload of other types is their block."""
    headers = [("WARC-Type", record_type), ("WARC-Record-ID", record_id), ("WARC-Date", date)]
    if target_uri is not None:
        headers.append(("WARC-Target-URI", _header_text(target_uri)))
    if record_type in ("response", "revisit"):
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        block += payload if record_type == "response" else b""
        headers += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{sha1(payload)}")]
        if record_type == "revisit":
            headers += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", refers_to)]
    else:
        block = payload
        headers.append(("Content-Type", "application/warc-fields"))
    headers += [("WARC-Block-Digest", f"sha1:{sha1(block)}"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n").encode() + block + b"\r\n\r\n"


def _header_text(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in value).strip()


def _fields(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise WarcError(f"not a header line: {line[:80]!r}")
        out.setdefault(name.decode().lower(), value.strip().decode())
    return out


def _number(fields: dict[str, str], name: str) -> int:
    value = fields.get(name, "")
    if not (value.isascii() and value.isdigit()):
        raise WarcError(f"{name} is no number: {value[:80]!r}")
    return int(value)


def _check_digest(fields: dict[str, str], name: str, data: bytes) -> None:
    value = fields.get(name)
    if value and value.lower().startswith("sha1:") and value[5:].upper() != sha1(data):
        raise WarcError(f"{name} does not fit")


def parsed(record: bytes) -> dict:
    """The checked fields of a record as a row of ``RECORD``, less where it lies."""
    head, blank, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version not in VERSIONS:
        raise WarcError(f"not a version line: {version[:80]!r}")
    if not blank:
        raise WarcError("the header has no end")
    fields = _fields(lines)
    missing = [k for k in MUST_HAVE if not fields.get(k)]
    if missing:
        raise WarcError(f"headers are missing: {', '.join(missing)}")
    length = _number(fields, "content-length")
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise WarcError(f"the block has {len(rest) - 4} bytes and not {length}, or its end is missing")
    block, kind = rest[:length], fields["warc-type"]
    _check_digest(fields, "warc-block-digest", block)
    digest = fields.get("warc-payload-digest", "")
    out = {"record_id": fields["warc-record-id"], "record_type": kind, "date": fields["warc-date"], "target_uri": fields.get("warc-target-uri"),
           "refers_to": fields.get("warc-refers-to"), "payload": block, "payload_length": length}
    if fields.get("content-type", "").startswith("application/http"):
        head, blank, out["payload"] = block.partition(b"\r\n\r\n")
        if not blank:
            raise WarcError("the HTTP header has no end")
        http = _fields(head.split(b"\r\n")[1:])
        if "content-length" in http:
            out["payload_length"] = _number(http, "content-length")
        elif kind != "revisit":
            out["payload_length"] = len(out["payload"])
    if kind == "revisit":
        if not fields.get("warc-profile") or not fields.get("warc-refers-to"):
            raise WarcError("a revisit without a profile or without what it refers to")
        if fields["warc-profile"] == SAME_PAYLOAD and not digest:
            raise WarcError("a revisit without the digest of its payload")
        out["payload"] = None
    else:
        if out["payload_length"] != len(out["payload"]):
            raise WarcError(f"the payload has {len(out['payload'])} bytes and not {out['payload_length']}")
        _check_digest(fields, "warc-payload-digest", out["payload"])
        digest = digest or f"sha1:{sha1(out['payload'])}"
    out["payload_digest"] = digest.partition(":")[2].upper() if digest.lower().startswith("sha1:") else digest or None
    return out


class _Stream:
    """A file read in chunks, with a place and a look ahead."""

    def __init__(self, file):
        self.file, self.data, self.place = file, b"", 0

    def ahead(self, n: int) -> bytes:
        while len(self.data) < n:
            more = self.file.read(CHUNK)
            if not more:
                break
            self.data += more
        return self.data[:n]

    def take(self, n: int) -> bytes:
        out = self.ahead(n)
        if len(out) < n:
            raise WarcError("the archive ends inside a frame")
        self.data, self.place = self.data[n:], self.place + n
        return out

    def frame(self, decompressor) -> bytes:
        """The content of the frame that begins here; the place moves behind it if it decodes."""
        one, out, used, data = decompressor.decompressobj(), [], 0, self.data
        held = [data]
        while True:
            try:
                out.append(one.decompress(data))
            except zstandard.ZstdError as e:
                self.data = b"".join(held)
                raise WarcError(f"a frame does not decode: {e}") from None
            if one.eof:
                self.place += used + len(data) - len(one.unused_data)
                self.data = one.unused_data
                return b"".join(out)
            used += len(data)
            data = self.file.read(CHUNK)
            if not data:
                self.data = b"".join(held)
                raise WarcError("the archive ends inside a frame")
            held.append(data)

    def next_magic(self) -> None:
        """Moves to the next place, after this one, that looks like a frame, or to the end."""
        self.take(1)
        while True:
            at = self.data.find(FRAME_MAGIC)
            if at >= 0:
                self.take(at)
                return
            keep = min(3, len(self.data))
            self.take(len(self.data) - keep)
            if len(self.ahead(4)) < 4:
                self.take(len(self.data))
                return


def _dictionary(content: bytes):
    """The dictionary of a leading frame, compressed or plain."""
    if content[:4] == FRAME_MAGIC:
        try:
            content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        except zstandard.ZstdError as e:
            raise WarcError(f"the dictionary does not decode: {e}") from None
    return zstandard.ZstdCompressionDict(content)


def frames(file, permissive: bool = False):
    """(place, content, error) of each record's frame of an open archive."""
    stream, decompressor, lost = _Stream(file), zstandard.ZstdDecompressor(), False
    while head := stream.ahead(8):
        place, magic = stream.place, int.from_bytes(head[:4], "little")
        try:
            if magic in SKIPPABLE_MAGIC:
                if len(head) < 8:
                    raise WarcError("the archive ends inside a frame")
                size = int.from_bytes(head[4:8], "little")
                if place == 0 and magic == DICTIONARY_MAGIC:
                    decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(stream.take(8 + size)[8:]))
                else:  # passed over without holding it
                    stream.take(8)
                    while size:
                        size -= len(stream.take(min(size, CHUNK)))
                continue
            if head[:4] != FRAME_MAGIC:
                raise WarcError(f"no frame begins at {place}")
            content = stream.frame(decompressor)
        except WarcError as e:
            if not permissive:
                raise
            if not lost:
                yield place, None, str(e)
            lost = True
            if stream.ahead(1):
                stream.next_magic()
            continue
        lost = False
        yield place, content, None


def records(file, archive: str, permissive: bool = False):
    """Rows of ``RECORD`` (dicts) of an open archive, checked."""
    for place, content, error in frames(file, permissive):
        row = dict.fromkeys(_NAMES)
        if error is None:
            try:
                row.update(parsed(content))
            except (WarcError, UnicodeDecodeError) as e:
                if not permissive:
                    raise WarcError(f"{archive}, frame at {place}: {e}") from None
                error = str(e)
        row.update(archive=archive, place=place, error=error)
        yield row


class _Archive:
    """An archive being written: the first records wait until their dictionary is trained."""

    def __init__(self, folder: str):
        fs, path = _fs(folder)
        self.name, self.bytes, self.records = f"part-{uuid.uuid4().hex}.warc.zst", 0, 0
        fs.create_dir(path, recursive=True)
        self.out = fs.open_output_stream(f"{path}/{self.name}", compression=None)
        self.waiting, self.sampled, self.compressor = [], [], None

    def add(self, record: bytes, sample: bytes) -> None:
        self.records += 1
        if self.compressor:
            self._write(self.compressor.compress(record))
            return
        self.waiting.append(record)
        self.sampled.append(sample[:SAMPLE - sum(map(len, self.sampled))])
        if sum(map(len, self.sampled)) >= SAMPLE or sum(map(len, self.waiting)) >= 4 * SAMPLE:
            self._begin()

    def _begin(self) -> None:
        dictionary = None
        try:
            dictionary = zstandard.train_dictionary(DICTIONARY, [s for s in self.sampled if s], k=256, d=8)
        except (zstandard.ZstdError, ValueError):
            pass  # too few samples for a dictionary
        if dictionary:
            content = zstandard.ZstdCompressor(level=9).compress(dictionary.as_bytes())
            self._write(DICTIONARY_MAGIC.to_bytes(4, "little") + len(content).to_bytes(4, "little") + content)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True, write_content_size=True)
        for record in self.waiting:
            self._write(self.compressor.compress(record))
        self.waiting, self.sampled = [], []

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def close(self) -> dict:
        if not self.compressor:
            self._begin()
        self.out.close()
        return {"name": self.name, "bytes": self.bytes, "records": self.records}


class _Written(WriterCommitMessage):
    def __init__(self, archives: list[dict]):
        self.archives = archives


class _Writer(DataSourceArrowWriter):
    def __init__(self, options):
        self.path, self.roll, self.job = options["path"], int(options.get("roll", ROLL)), uuid.uuid4().hex

    def write(self, iterator):
        done, archive = [], None
        for batch in iterator:
            columns = [batch.column(c).to_pylist() for c in ("record_id", "record_type", "date", "target_uri", "refers_to")]
            payloads = batch.column("payload")
            for i, row in enumerate(zip(*columns, strict=True)):
                record_id, record_type, date, target_uri, refers_to = row
                payload = payloads[i].as_py() or b""
                if archive is None:
                    archive = _Archive(self.path)
                    archive.add(record_bytes(f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, archive.name)}>", "warcinfo", date, b"format: WARC File Format 1.1\r\n"), b"")
                archive.add(record_bytes(record_id, record_type, date, payload, target_uri, refers_to), payload if record_type == "response" else b"")
                if archive.bytes >= self.roll:
                    done, archive = [*done, archive.close()], None
        return _Written([*done, archive.close()] if archive else done)

    def commit(self, messages):
        fs, path = _fs(self.path)
        fs.create_dir(path, recursive=True)
        with fs.open_output_stream(f"{path}/_manifest-{self.job}.json", compression=None) as out:
            out.write(json.dumps([a for m in messages if m for a in m.archives]).encode())

    def abort(self, messages):
        """Archives without a manifest are not read; those that are known go."""
        fs, path = _fs(self.path)
        for message in messages:
            for a in message.archives if message else []:
                fs.delete_file(f"{path}/{a['name']}")


class _Some(InputPartition):
    def __init__(self, names: list[str]):
        self.names = names


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.permissive = options["path"], options.get("mode", "FAILFAST").upper() == "PERMISSIVE"
        self.payload = options.get("payload", "true").lower() == "true"

    def partitions(self):
        from pyarrow.fs import FileSelector

        fs, path = _fs(self.path)
        files = {f.base_name: f.size for f in fs.get_file_info(FileSelector(path))}
        manifests = [n for n in files if n.startswith("_manifest-")]
        if manifests:
            named = {}
            for n in manifests:
                with fs.open_input_stream(f"{path}/{n}", compression=None) as f:
                    named.update((a["name"], a["bytes"]) for a in json.loads(f.read()))
        else:
            named = {n: s for n, s in files.items() if n.endswith(".warc.zst")}
        out, held = [], 0
        for name, size in sorted(named.items()):  # small archives share a task
            if not out or held + size > ROLL // 16:
                out.append([])
                held = 0
            out[-1].append(name)
            held += size
        return [_Some(names) for names in out] or [_Some([])]

    def read(self, partition):
        fs, path = _fs(self.path)
        for name in partition.names:
            rows, held = [], 0
            with fs.open_input_stream(f"{path}/{name}", compression=None) as file:
                for row in records(file, name, self.permissive):
                    if not self.payload:
                        row["payload"] = None
                    rows.append(row)
                    held += 500 + len(row["payload"] or b"")
                    if held > 1 << 23:
                        yield _batch(rows)
                        rows, held = [], 0
            yield _batch(rows)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(_NAMES, _TYPES, strict=True)], _NAMES)


class WarcZstandard(DataSource):
    """``spark.read.format("warc_zst").load(folder)`` gives rows of ``RECORD``; options ``mode`` and
    ``payload`` (false: the payload is checked and not returned).  ``df.write.format("warc_zst")`` takes
    record_id, record_type, date, target_uri, refers_to and payload; option ``roll``."""

    @classmethod
    def name(cls):
        return "warc_zst"

    def schema(self):
        return RECORD

    def reader(self, schema):
        return _Reader(self.options)

    def writer(self, schema, overwrite):
        return _Writer(self.options)


def write_archives(rows: DataFrame, path: str, roll: int = ROLL) -> None:
    """Records as archives in a folder."""
    rows.sparkSession.dataSource.register(WarcZstandard)
    out = rows.select("record_id", "record_type", "date", "target_uri", "refers_to", "payload")
    out.write.format("warc_zst").mode("append").option("roll", roll).save(path)


def read_archives(spark: SparkSession, path: str, mode: str = "FAILFAST", payload: bool = True) -> DataFrame:
    """Rows of ``RECORD`` of all archives of a folder."""
    spark.dataSource.register(WarcZstandard)
    return spark.read.format("warc_zst").option("mode", mode).option("payload", str(payload).lower()).load(path)


def page_records(pages: DataFrame, date: str = "1970-01-01T00:00:00Z", least: int = 0) -> DataFrame:
    """What ``write_archives`` takes, a record for each row of pages (page_id, url, html).  Of rows with an
    equal payload of ``least`` bytes or more, those with the smallest page_id are responses and the others
    revisits.  Payloads that only one row has do not move."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    key = F.when(F.octet_length("payload") >= least, F.unhex(F.sha2("payload", 256)))
    rows = rows.withColumn("key", key)
    shared = (rows.where("key is not null").groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
              .where("n > 1 and first is not null").select("key", "first"))
    if shared.limit(BROADCAST_PAYLOADS + 1).count() <= BROADCAST_PAYLOADS:
        rows = rows.join(F.broadcast(shared), "key", "left")
    else:  # a payload that very many pages have is dealt over several tasks
        shared = shared.withColumn("salt", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))).join(shared, ["key", "salt"], "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    return rows.select(urn("page_id").alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"), F.lit(date).alias("date"),
                       F.col("url").alias("target_uri"), F.when(again, urn("first")).alias("refers_to"), "payload")


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(page_records(table(spark, sf_dir, "pages", "page_id", "url", "html")), path)
    page = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    return read_archives(spark, path, payload=False).where("record_type <> 'warcinfo'").select(
        page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type", page("refers_to").alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p GROUP BY html),
d AS (SELECT p.page_id, strlen(p.html)::BIGINT AS payload_bytes, sha1(p.html) AS hex, first FROM p JOIN f ON f.html = p.html)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((
    ('0x' || substr(hex || '0', 1 + (5 * i // 4)::INTEGER, 2))::INTEGER >> (3 - 5 * i % 4)::INTEGER) & 31)::INTEGER, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""

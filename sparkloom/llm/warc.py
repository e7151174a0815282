"""WARC archives: whole-file gzip streams, their normaliser, and a reader.

``write_monoliths`` puts records into archives that are one gzip stream each,
as some crawlers leave them.  ``normalise`` inflates such a stream once and
writes every record as a gzip member of its own beside a sidecar index of
(record id, offset, length), so that a record can be read alone.
``read_records`` reads through the index.  Records pass in chunks; neither an
archive nor a payload is ever held whole, but for a row's own text.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import bounded, file_system, fresh_path, hot_keys, map_arrow, materialize, remove

CHUNK = 1 << 20
#: Bytes of records after which a writer starts another archive.
ARCHIVE_BYTES = 1 << 30
#: Repeated digests up to which they are broadcast.
MOST_DIGESTS = 1 << 17
_ID = "urn:x-page:"


def _headers(stream: io.BufferedIOBase) -> dict[str, str] | None:
    """The next record's named fields in lower case; None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    out = {"": line.decode().strip()}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _record(kind: str, rid: str, url: str, digest: str, size: int, refers: str | None, payload: bytes, date: str) -> tuple[bytes, bytes]:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    fields = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{_ID}{rid}>", f"WARC-Date: {date}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if kind == "revisit":
        fields += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{_ID}{refers}>"]
    return ("WARC/1.1\r\n" + "\r\n".join(fields) + "\r\n\r\n").encode(), block


class _Writer:
    """mapInArrow: rows to monolithic archives; a manifest row for each."""

    def __init__(self, folder: str, level: int, date: str, limit: int):
        self.folder, self.level, self.date, self.limit = folder, level, date, limit

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(self.folder)
        fs.create_dir(base, recursive=True)
        out = raw = None
        name, written, records = "", 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            raw.close()
            return pa.RecordBatch.from_pydict({"path": [f"{self.folder}/{name}"], "records": pa.array([records], pa.int64())})

        for batch in batches:
            for page, url, html, digest, size, kind, refers in zip(*batch.columns, strict=True):
                if out is not None and written >= self.limit:
                    yield done()
                    out = None
                if out is None:
                    name, written, records = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0
                    raw = fs.open_output_stream(f"{base}/{name}", compression=None)
                    out = gzip.GzipFile(fileobj=raw, mode="wb", compresslevel=self.level, mtime=0)
                link = " ".join((url.as_py() or "").split())
                payload = html.as_buffer() if html.is_valid else b""
                head, block = _record(kind.as_py(), str(page), link, digest.as_py(), size.as_py(), refers.as_py(), bytes(payload), self.date)
                for part in (head, block, b"\r\n\r\n"):
                    out.write(part)
                    written += len(part)
                records += 1
        if out is not None:
            yield done()


class _Normaliser:
    """mapInArrow: monolithic archives to one member per record and a sidecar index."""

    def __init__(self, folder: str, level: int):
        self.folder, self.level = folder, level

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(self.folder)
        fs.create_dir(base, recursive=True)
        for batch in batches:
            for source in batch.column(0).to_pylist():
                name = uuid.uuid4().hex
                at, place = file_system(source)
                with at.open_input_stream(place, compression=None) as raw, fs.open_output_stream(f"{base}/{name}.warc.gz", compression=None) as out, fs.open_output_stream(f"{base}/{name}.cdxj", compression=None) as index:
                    n = self.rewrite(raw, out, index)
                yield pa.RecordBatch.from_pydict({"path": [f"{self.folder}/{name}.warc.gz"], "index": [f"{self.folder}/{name}.cdxj"], "records": pa.array([n], pa.int64())})

    def rewrite(self, raw, out, index) -> int:
        """Inflate ``raw`` once; a member for each record to ``out``, its place to ``index``."""
        stream = io.BufferedReader(gzip.GzipFile(fileobj=raw, mode="rb"), CHUNK)
        offset = n = 0
        while (fields := _headers(stream)) is not None:
            member = zlib.compressobj(self.level, zlib.DEFLATED, 31)
            names = "\r\n".join(f"{k}: {v}" for k, v in fields.items() if k)
            size, left = 0, int(fields["content-length"])
            parts = [f"{fields['']}\r\n{names}\r\n\r\n".encode()]
            while parts or left >= 0:
                if not parts:
                    part = stream.read(min(left, CHUNK)) if left else b"\r\n\r\n"
                    if left and not part:
                        raise EOFError(f"archive ends inside record {fields.get('warc-record-id')}")
                    left = left - len(part) if left else -1
                    parts.append(part)
                packed = member.compress(parts.pop())
                size += len(packed)
                out.write(packed)
            packed = member.flush()
            size += len(packed)
            out.write(packed)
            line = {"id": fields["warc-record-id"], "type": fields["warc-type"], "offset": offset, "length": size}
            index.write((json.dumps(line) + "\n").encode())
            offset += size
            n += 1
        return n


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: every record of normalised archives, through their indexes."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    for batch in batches:
        for path, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            fs, place = file_system(path)
            rows: list[tuple] = []
            with fs.open_input_file(place) as raw, fs.open_input_stream(file_system(index)[1]) as lines:
                for line in io.TextIOWrapper(io.BufferedReader(lines, CHUNK), encoding="utf-8"):
                    entry = json.loads(line)
                    raw.seek(entry["offset"])
                    rows.append(read_member(raw, entry["length"]))
                    if len(rows) == 4096:
                        yield _batch(rows, names)
                        rows = []
            if rows:
                yield _batch(rows, names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


class _Member(io.RawIOBase):
    """The bytes of one member as a stream of its own."""

    def __init__(self, raw, length: int):
        self.raw, self.left = raw, length

    def readable(self) -> bool:
        return True

    def readinto(self, b) -> int:
        part = self.raw.read(min(len(b), self.left))
        self.left -= len(part)
        b[: len(part)] = part
        return len(part)


def read_member(raw, length: int) -> tuple:
    """(page id, payload bytes, payload digest, type, referred page id) of one record.

    A response's payload is hashed again and must agree with its header.
    """
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BufferedReader(_Member(raw, length), 1 << 16), mode="rb"), 1 << 16)
    fields = _headers(stream)
    http = _headers(stream)
    size = int(http["content-length"])
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        sha, left = hashlib.sha1(), size
        while left:
            part = stream.read(min(left, CHUNK))
            if not part:
                raise EOFError("record ends inside its payload")
            sha.update(part)
            left -= len(part)
        if sha.hexdigest() != digest:
            raise ValueError(f"payload of {fields['warc-record-id']} does not have its digest")
    refers = fields.get("warc-refers-to")
    page = fields["warc-record-id"].strip("<>").removeprefix(_ID)
    return None if page == "None" else page, size, digest, kind, refers and refers.strip("<>").removeprefix(_ID)


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 1000) -> DataFrame:
    """Rows to write: page, url, html (bytes), digest, size, kind, refers.

    Of rows with equal payloads of ``least`` bytes or more those with the
    largest id are responses and the others revisit it; smaller payloads are
    all responses.  Only repeated digests take part in the join back: broadcast
    up to ``MOST_DIGESTS`` of them, beyond that joined by shuffle but for hot ones.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).cast("string").alias("url"), payload.cast("binary").alias("html"))
    rows = rows.withColumns({"digest": F.sha1("html"), "size": F.octet_length("html").cast("bigint")})
    most = rows.where(F.col("size") >= least).groupBy("digest").agg(F.max("page").alias("top"), F.count("*").alias("copies")).where("copies > 1")
    most = materialize(most, "digests")
    few = bounded(most.select("digest", "top"), MOST_DIGESTS)
    if few is not None:  # rows stay where they are
        out = rows.join(few, "digest", "left")
    else:
        # Rows of hot digests stay where they are; a payload that can't be repeated is dealt out by its row.
        hot = hot_keys(most, ["digest"], "copies")
        key = F.when(F.col("size") >= least, F.col("digest")).otherwise(F.concat(F.lit("-"), F.xxhash64("page", "digest").cast("string")))
        cold = rows.join(hot, "digest", "left_anti").withColumn("key", key)
        cold = cold.join(most.select(F.col("digest").alias("key"), "top"), "key", "left").drop("key")
        warm = rows.join(F.broadcast(most.join(hot, "digest", "left_semi").select("digest", "top")), "digest")
        out = cold.unionByName(warm)
    revisit = F.coalesce(F.col("page") != F.col("top"), F.col("top").isNotNull()) & (F.col("size") >= least)
    return out.select("page", "url", "html", "digest", "size", F.when(revisit, "revisit").otherwise("response").alias("kind"), F.when(revisit, F.col("top")).cast("string").alias("refers"))


def write_monoliths(records: DataFrame, folder: str, level: int = 6, date: str = "1970-01-01T00:00:00Z", limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``plan_records`` rows as whole-file gzip archives; (path, records).

    A task attempt names its files anew, and only files of the returned table
    count, so a repeated or lost attempt leaves no wrong record.
    """
    return materialize(map_arrow(records, _Writer(folder, level, date, limit), "path string, records bigint"), "manifest")


def normalise(manifest: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Normalise every archive of ``manifest``; (path, index, records)."""
    n = manifest.count()
    spread = manifest.repartition(max(1, n)) if n > 1 else manifest
    return materialize(map_arrow(spread, _Normaliser(folder, level), "path string, index string, records bigint"), "normalised")


def read_records(archives: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Every record of the normalised archives."""
    n = archives.count()
    spread = archives.repartition(max(1, n)) if n > 1 else archives
    out = map_arrow(spread, _read, "page_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string")
    return out.withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))


def round_trip(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 1000, folder: str | None = None, level: int = 6) -> DataFrame:
    """Write ``pages`` to archives, normalise these, and read every record back.

    A null text is an empty payload.  Rows that repeat the largest id of a
    payload are all responses; a null id revisits its payload's largest id if
    there is one.  Null URLs are written empty; other columns are ignored.
    Archives stay in ``folder`` (a new one in the shared folder by default)
    until the caller removes them; the monoliths are removed here.
    """
    folder = folder or fresh_path(spark, "warc")
    kind = pages.schema[id_col].dataType.simpleString()
    manifest = write_monoliths(plan_records(pages, id_col, url_col, html_col, least), f"{folder}/monolithic", level)
    archives = normalise(manifest, f"{folder}/members", level)
    remove(spark, f"{folder}/monolithic")
    return read_records(archives, kind).withColumnRenamed("page_id", id_col)

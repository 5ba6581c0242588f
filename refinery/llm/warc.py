"""Web archives (WARC 1.1) as a Spark data source, with equal payloads stored once.

Reading: a column is the record's header of that name (``warc_type``, ``target_uri``,
``content_type``, ..., with or without ``WARC-``), or one of

| column | content |
| --- | --- |
| headers | map of all headers |
| payload | body of the HTTP message, or the block of other records (binary) |
| payload_length | length that the HTTP message or the block states |
| file, offset | where the record begins |

Only the columns of the schema that is asked for are made. Predicates on headers are pushed into
the reader, which parses the headers of a record first; the block of a record that is
filtered out, or whose payload no column needs, is skipped by the length in its gzip header
(the field ``sl``, compressed and plain size) or by its content length, not inflated.

Writing: every task writes files of its own and the driver then lists them, with places where
they may be cut, in one ``_manifest-*`` file. Files that a lost task left are in no list and are
not read. Folders without a manifest are read as they are, a file per task.

Paths may be plain, ``file:``, ``s3:``/``s3a:``, ``gs:`` or ``hdfs:``; all executors must reach them.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from refinery.llm.common import column_named, discard, stored
from refinery.llm.spread import HOT_ROWS, marked, repeated_keys, spread_lookup

FORMAT = "warc"
DEFAULT_SCHEMA = (
    "warc_type string, record_id string, date string, target_uri string, refers_to string, payload_digest string, "
    "content_type string, content_length long, payload_length long, payload binary"
)
#: What the writer takes; ``payload`` is null where only digest and length are to be kept.
WRITE_SCHEMA = (
    "warc_type string, record_id string, target_uri string, refers_to string, payload binary, payload_sha1 string, payload_length long"
)
# Fixed values of the format.
_VERSION = "WARC/1.1"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "application/http;msgtype=response"
_CHUNK = 1 << 14
_BATCH_ROWS, _BATCH_BYTES = 1_024, 8 << 20
_SPECIAL = {"headers", "payload", "payload_length", "file", "offset"}


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"\w+:/", path):
        return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))
    return pafs.LocalFileSystem(), path


# --- records -------------------------------------------------------------------------


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    """A header value cannot hold control characters; they are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _head(values: dict[str, str | None], length: int) -> bytes:
    lines = [_VERSION, *(f"{k}: {_clean(v)}" for k, v in values.items() if v is not None), f"Content-Length: {length}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _member(record: bytes, level: int) -> bytes:
    """One gzip member that names its compressed and plain size, so that it can be skipped."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = packer.compress(record) + packer.flush()
    size = 10 + 2 + 12 + len(body) + 8
    tail = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    if max(size, len(record)) > 0xFFFFFFFF:
        return struct.pack("<4BI2B", 0x1F, 0x8B, 8, 0, 0, 0, 255) + body + tail
    extra = struct.pack("<2sHII", b"sl", 8, size, len(record))
    return struct.pack("<4BI2BH", 0x1F, 0x8B, 8, 4, 0, 0, 255, len(extra)) + extra + body + tail


def _record(row: dict, date: str) -> bytes:
    payload = row["payload"]
    if payload is None:
        digest, length = base64.b32encode(bytes.fromhex(row["payload_sha1"])).decode(), row["payload_length"]
    else:
        digest, length = base32_sha1(payload), len(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    revisit = row["warc_type"] == "revisit"
    block = http if revisit or payload is None else http + payload
    head = {
        "WARC-Type": row["warc_type"], "WARC-Record-ID": row["record_id"], "WARC-Date": date,
        "WARC-Target-URI": row["target_uri"], "WARC-Profile": _REVISIT if revisit else None,
        "WARC-Refers-To": row["refers_to"], "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": _HTTP,
    }
    return _head(head, len(block)) + block + b"\r\n\r\n"


def _parse_head(raw: bytes) -> dict[str, str]:
    first, *lines = raw.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no WARC record begins with {first[:40]!r}")
    found: dict[str, str] = {}
    name = None
    for line in lines:
        if line[:1] in " \t" and name:  # a folded line
            found[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            found[name] = value.strip()
    return found


# --- reading -------------------------------------------------------------------------


class _Record:
    """A record of which only the headers are read; the block follows on request."""

    def __init__(self, source: pa.NativeFile, offset: int):
        self.source, self.offset, self.taken = source, offset, 0
        self.plain = bytearray()
        first = source.read_at(_CHUNK, offset)
        self.unpack = zlib.decompressobj(31) if first[:2] == b"\x1f\x8b" else None
        self.size = self._stated_size(first) if self.unpack else None
        self._feed(first)
        self._until(lambda: b"\r\n\r\n" in self.plain)
        self.body = self.plain.index(b"\r\n\r\n") + 4
        self.headers = _parse_head(bytes(self.plain[: self.body - 4]))
        self.named = {k.lower(): v for k, v in self.headers.items()}
        self.length = int(self.named.get("content-length", 0))

    @staticmethod
    def _stated_size(first: bytes) -> int | None:
        if len(first) > 12 and first[3] & 4:
            extra = first[12 : 12 + int.from_bytes(first[10:12], "little")]
            while len(extra) >= 4:
                n = int.from_bytes(extra[2:4], "little")
                if extra[:2] == b"sl" and n == 8:
                    return int.from_bytes(extra[4:8], "little")
                extra = extra[4 + n :]
        return None

    def _feed(self, raw: bytes) -> None:
        if not raw:
            raise ValueError(f"a record at {self.offset} is cut off")
        self.taken += len(raw)
        self.plain += self.unpack.decompress(raw) if self.unpack else raw

    def _until(self, done: Callable[[], bool]) -> None:
        while not done():
            if self.unpack and self.unpack.eof:
                raise ValueError(f"a record at {self.offset} is cut off")
            self._feed(self.source.read_at(_CHUNK, self.offset + self.taken))

    def block(self) -> bytes:
        end = self.body + self.length
        if self.size and len(self.plain) < end:  # the rest of the member in one read
            self._feed(self.source.read_at(self.size - self.taken, self.offset + self.taken))
        elif not self.unpack and len(self.plain) < end:
            self._feed(self.source.read_at(end - len(self.plain), self.offset + self.taken))
        self._until(lambda: len(self.plain) >= end)
        return bytes(self.plain[self.body : end])

    def http_head(self) -> bytes:
        """The head of the HTTP message, without its body where that is long."""
        end = self.body + self.length
        self._until(lambda: len(self.plain) >= end or self.plain.find(b"\r\n\r\n", self.body, end) >= 0)
        return bytes(self.plain[self.body : end]).split(b"\r\n\r\n", 1)[0]

    def next(self) -> int:
        if not self.unpack:
            return self.offset + self.body + self.length + 4
        if self.size:
            return self.offset + self.size
        seen = len(self.plain)
        while not self.unpack.eof:
            raw = self.source.read_at(_CHUNK, self.offset + self.taken)
            if not raw:
                raise ValueError(f"a record at {self.offset} is cut off")
            self.taken += len(raw)
            seen += len(self.unpack.decompress(raw))
        if seen != self.body + self.length + 4:
            raise ValueError("each record must be a gzip member of its own")
        return self.offset + self.taken - len(self.unpack.unused_data)

    def header(self, column: str) -> str | None:
        name = column.lower().replace("_", "-")
        return self.named.get(name, self.named.get(f"warc-{name}"))

    @property
    def is_http(self) -> bool:
        return self.named.get("content-type", "").startswith("application/http")

    def payload(self) -> bytes:
        block = self.block()
        return block.split(b"\r\n\r\n", 1)[-1] if self.is_http and b"\r\n\r\n" in block else block

    def payload_length(self) -> int:
        if not self.is_http:
            return self.length
        stated = re.search(rb"(?im)^content-length:[ \t]*(\d+)", self.http_head())
        return int(stated[1]) if stated else len(self.payload())


def _holds(test: ds.Filter, value) -> bool | None:
    """The truth of a predicate, as in SQL."""
    if isinstance(test, ds.IsNull):
        return value is None
    if isinstance(test, ds.IsNotNull):
        return value is not None
    if isinstance(test, ds.EqualNullSafe):
        return value == test.value
    if value is None:
        return None
    if isinstance(test, ds.In):
        return value in test.value or (None if None in test.value else False)
    if test.value is None:
        return None
    ways = {
        ds.EqualTo: lambda a, b: a == b, ds.GreaterThan: lambda a, b: a > b, ds.LessThan: lambda a, b: a < b,
        ds.GreaterThanOrEqual: lambda a, b: a >= b, ds.LessThanOrEqual: lambda a, b: a <= b,
        ds.StringStartsWith: str.startswith, ds.StringEndsWith: str.endswith, ds.StringContains: lambda a, b: b in a,
    }
    return ways[type(test)](value, test.value)


_KNOWN = (
    ds.IsNull, ds.IsNotNull, ds.EqualTo, ds.EqualNullSafe, ds.In, ds.GreaterThan, ds.GreaterThanOrEqual,
    ds.LessThan, ds.LessThanOrEqual, ds.StringStartsWith, ds.StringEndsWith, ds.StringContains,
)


@dataclass
class _Segments(ds.InputPartition):
    """Parts of files that one task reads: (path, from, to)."""

    parts: list[tuple[str, int, int]]


class _Reader(ds.DataSourceReader):
    def __init__(self, path: str, schema: StructType, options: dict):
        self.path, self.schema = path, schema
        self.split = int(options.get("split_bytes", 64 << 20))
        self.verify = str(options.get("verify", "false")).lower() == "true"
        self.tests: list[tuple[bool, ds.Filter]] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        kinds = {f.name: f.dataType.simpleString() for f in self.schema}
        for given in filters:
            negated = isinstance(given, ds.Not)
            test = given.child if negated else given
            column = test.attribute[0] if isinstance(test, _KNOWN) and len(test.attribute) == 1 else None
            if column in kinds and column not in _SPECIAL and kinds[column] in ("string", "bigint", "int"):
                self.tests.append((negated, test))
            else:
                yield given

    def partitions(self) -> Sequence[_Segments]:
        groups, held = [[]], 0
        for path, size, cuts in _listed(self.path):
            bounds = [0, *cuts, size]
            for low, high in zip(bounds, bounds[1:]):
                if held and held + high - low > self.split:
                    groups.append([])
                    held = 0
                last = groups[-1][-1] if groups[-1] else None
                if last and last[0] == path and last[2] == low:  # goes on in the same file
                    groups[-1][-1] = (path, last[1], high)
                else:
                    groups[-1].append((path, low, high))
                held += high - low
        return [_Segments(g) for g in groups if g] or [_Segments([])]

    def _value(self, record: _Record, name: str, kind: str):
        if name == "headers":
            return list(record.headers.items())
        if name == "payload":
            payload = record.payload()
            stated = record.header("payload_digest") or ""
            if self.verify and record.header("warc_type") == "response" and stated.startswith("sha1:") and stated[5:] != base32_sha1(payload):
                raise ValueError(f"the payload of {record.header('record_id')} does not have its digest")
            return payload
        if name == "payload_length":
            return record.payload_length()
        if name == "offset":
            return record.offset
        value = record.header(name)
        return int(value) if value is not None and kind in ("bigint", "int") else value

    def _wanted(self, record: _Record, kinds: dict[str, str]) -> bool:
        for negated, test in self.tests:
            true = _holds(test, self._value(record, test.attribute[0], kinds[test.attribute[0]]))
            if true is None or true == negated:
                return False
        return True

    def read(self, partition: _Segments) -> Iterator[pa.RecordBatch]:
        kinds = {f.name: f.dataType.simpleString() for f in self.schema}
        shape = to_arrow_schema(self.schema)
        columns: list[list] = [[] for _ in kinds]
        rows = held = 0
        for path, low, high in partition.parts:
            system, place = _open(path)
            with system.open_input_file(place) as source:
                at = low
                while at < high:
                    record = _Record(source, at)
                    if self._wanted(record, kinds):
                        for values, (name, kind) in zip(columns, kinds.items()):
                            value = path if name == "file" else self._value(record, name, kind)
                            values.append(value)
                            held += len(value) if name == "payload" else 64
                        rows += 1
                        if rows == _BATCH_ROWS or held >= _BATCH_BYTES:
                            yield _batch(columns, shape)
                            columns, rows, held = [[] for _ in kinds], 0, 0
                    at = record.next()
        if rows:
            yield _batch(columns, shape)


def _batch(columns: list[list], shape: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, shape)], schema=shape)


def _listed(path: str) -> list[tuple[str, int, list[int]]]:
    """Files of an archive with their sizes and the places where they may be cut."""
    system, place = _open(path)
    if system.get_file_info(place).type == pafs.FileType.File:
        return [(path, system.get_file_info(place).size, [])]
    found = system.get_file_info(pafs.FileSelector(place, recursive=True))
    files = {f.base_name: f for f in found if f.type == pafs.FileType.File}
    lists = sorted(n for n in files if re.fullmatch(r"_manifest-\w+\.json", n))
    root = path.rstrip("/")
    if not lists:
        return [(f"{root}{f.path[len(place.rstrip('/')):]}", f.size, []) for f in sorted(files.values(), key=lambda f: f.path) if re.search(r"\.warc(\.gz)?$", f.path)]
    out = []
    for name in lists:
        with system.open_input_stream(files[name].path) as stream:
            out += [(f"{root}/{e['file']}", e["bytes"], e["cuts"]) for e in json.loads(stream.read())]
    return sorted(out)


# --- writing -------------------------------------------------------------------------


@dataclass
class _Written(ds.WriterCommitMessage):
    files: list[dict] = field(default_factory=list)


class _Writer(ds.DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool, options: dict):
        self.path, self.overwrite = path.rstrip("/"), overwrite
        self.limit = int(options.get("file_bytes", 1 << 30))
        self.cut = int(options.get("cut_bytes", 16 << 20))
        self.level = int(options.get("level", 6))
        self.date = options.get("date") or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        system, place = _open(self.path)
        system.create_dir(place, recursive=True)
        done, stream = [], None
        pack = (lambda r: _member(r, self.level)) if self.level else (lambda r: r)
        try:
            for batch in iterator:
                names = batch.schema.names
                for i in range(batch.num_rows):  # one payload at a time
                    row = {n: batch.column(k)[i].as_py() for k, n in enumerate(names)}
                    if stream is None:
                        name = f"part-{uuid.uuid4().hex}.warc" + (".gz" if self.level else "")
                        stream = system.open_output_stream(f"{place}/{name}", compression=None)
                        info = _head({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": self.date, "WARC-Filename": name, "Content-Type": "application/warc-fields"}, 0)
                        done.append({"file": name, "bytes": stream.write(pack(info + b"\r\n\r\n")), "cuts": []})
                    entry = done[-1]
                    if entry["bytes"] - (entry["cuts"] or [0])[-1] >= self.cut:
                        entry["cuts"].append(entry["bytes"])
                    entry["bytes"] += stream.write(pack(_record(row, self.date)))
                    if entry["bytes"] >= self.limit:
                        stream.close()
                        stream = None
            if stream is not None:
                stream.close()
        except BaseException:
            if stream is not None:
                stream.close()
            self._delete(done)
            raise
        return _Written(done)

    def _delete(self, files: list[dict]) -> None:
        system, place = _open(self.path)
        for entry in files:
            if system.get_file_info(f"{place}/{entry['file']}").type == pafs.FileType.File:
                system.delete_file(f"{place}/{entry['file']}")

    def commit(self, messages: list[_Written | None]) -> None:
        system, place = _open(self.path)
        system.create_dir(place, recursive=True)
        before = [f for f in system.get_file_info(pafs.FileSelector(place)) if f.base_name.startswith("_manifest-")]
        entries = [e for m in messages if m for e in m.files]
        name = f"{place}/_manifest-{uuid.uuid4().hex}.json"
        with system.open_output_stream(f"{name}.new", compression=None) as stream:
            stream.write(json.dumps(entries).encode())
        system.move(f"{name}.new", name)  # all files of the write appear at once
        if self.overwrite:
            for old in before:
                system.delete_file(old.path)

    def abort(self, messages: list[_Written | None]) -> None:
        self._delete([e for m in messages if m for e in m.files])


class WarcSource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return DEFAULT_SCHEMA

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self.options["path"], schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        lacking = {c.split()[0] for c in WRITE_SCHEMA.split(", ")} - set(schema.names)
        if lacking:
            raise ValueError(f"the writer needs the columns {sorted(lacking)}")
        return _Writer(self.options["path"], overwrite, self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let Spark push predicates into it."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# --- archives of pages ---------------------------------------------------------------


def _urn(page_id: Column) -> Column:
    text = page_id.cast("string")
    return F.when(text.isNull(), F.lit("<urn:no-page>")).otherwise(F.concat(F.lit("<urn:page:"), F.url_encode(text), F.lit(">")))


def page_of(urn: Column) -> Column:
    """The id in a record id, as text; null where the page had none."""
    return F.when(urn.startswith("<urn:page:"), F.url_decode(F.substring(urn, 11, F.length(urn) - 11)))


def write_archive(
    pages: DataFrame, path: str, id_column: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0, **options
) -> None:
    """Writes a record per row of ``pages`` to ``path``: of equal payloads of at least
    ``min_bytes`` bytes the one with the largest id (of equal ids the largest url, of equal rows
    any one) is a response, the others are revisits that refer to it and hold no payload.

    A text payload is UTF-8; a null one is empty. A null id is smaller than all others. Records of
    rows that repeat an id have the same name. An empty table gives an archive without records.
    ``options`` go to the writer: ``level`` (0: not compressed), ``file_bytes``, ``cut_bytes``, ``date``.

    A payload is read where it lies and goes from there into its file; it is shuffled only where
    it is the response of a payload that may occur again. Revisits travel as digest and length.
    """
    spark = pages.sparkSession
    register(spark)
    base = pages.select(
        column_named(pages, id_column).alias("id"), column_named(pages, url).cast("string").alias("url"),
        F.coalesce(column_named(pages, payload).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumns(
        {
            "digest": F.sha2("payload", 256), "n_bytes": F.octet_length("payload").cast("long"),
            "row_key": F.sha2(F.to_json(F.struct("id", "url")), 256),
        }
    )
    keys = stored(base.where(F.col("n_bytes") >= min_bytes).withColumn("sha1", F.sha1("payload")).drop("payload"), "warc-keys")
    again = repeated_keys(keys, ["digest"], rows=1)
    met = marked(keys, again, ["digest"], "again").where("again")
    # Every payload that the bitmap marks has one response, those it marks by chance too.
    chosen = stored(
        met.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "url", "row_key")).alias("best"))
        .select("digest", "n", F.col("best.id").alias("best_id"), F.col("best.row_key").alias("best_key")),
        "warc-responses",
    )
    flagged = marked(base, again, ["digest"], "again")
    shared = F.col("again") & (F.col("n_bytes") >= min_bytes)
    response = F.lit("response").alias("warc_type")
    nothing = F.lit(None).cast("string")
    single = flagged.where(~shared).select(
        response, _urn(F.col("id")).alias("record_id"), F.col("url").alias("target_uri"), nothing.alias("refers_to"),
        "payload", nothing.alias("payload_sha1"), F.col("n_bytes").alias("payload_length"),
    )
    names = chosen.select("digest", F.col("best_key").alias("row_key"))
    kept = marked(flagged.where(shared), names, ["digest", "row_key"], "best").where("best")
    first = (
        kept.groupBy("digest", "row_key").agg(*[F.max(c).alias(c) for c in ("payload", "url", "n_bytes")], F.max("id").alias("id"))
        .join(names, ["digest", "row_key"])
        .select(
            response, _urn(F.col("id")).alias("record_id"), F.col("url").alias("target_uri"), nothing.alias("refers_to"),
            "payload", nothing.alias("payload_sha1"), F.col("n_bytes").alias("payload_length"),
        )
    )
    counted = met.groupBy("digest", "row_key", "id", "url", "sha1", "n_bytes").agg(F.count(F.lit(1)).alias("copies"))
    hot = chosen.where(F.col("n") > HOT_ROWS).select("digest")
    others = (
        spread_lookup(counted, chosen.drop("n"), ["digest"], hot)
        .withColumn("left", F.col("copies") - (F.col("row_key") == F.col("best_key")).cast("long"))
        .where("left > 0")
        .select(
            F.lit("revisit").alias("warc_type"), _urn(F.col("id")).alias("record_id"), F.col("url").alias("target_uri"),
            _urn(F.col("best_id")).alias("refers_to"), F.lit(None).cast("binary").alias("payload"),
            F.col("sha1").alias("payload_sha1"), F.col("n_bytes").alias("payload_length"), F.explode(F.sequence(F.lit(1), "left")).alias("copy"),
        )
        .drop("copy")
    )
    records = single.unionByName(first).unionByName(others)
    records.write.format(FORMAT).options(**options).mode("append").save(path)
    discard(keys, chosen)


def read_archive(spark: SparkSession, path: str, schema: str = DEFAULT_SCHEMA, **options) -> DataFrame:
    """The records below ``path``; see the module for the columns that ``schema`` may name.

    ``options`` go to the reader: ``split_bytes`` (of a task), ``verify`` (responses must have
    the digest they state).
    """
    register(spark)
    return spark.read.format(FORMAT).schema(schema).options(**options).load(path)


def archived_pages(spark: SparkSession, path: str, verify: bool = True) -> DataFrame:
    """One row per record of an archive of ``write_archive``: ``page`` (the id as text),
    ``payload_bytes``, ``payload_digest`` (base 32 SHA-1), ``record_type`` and ``refers_to``.

    Responses are measured on the payload that is read; of revisits only the headers are.
    """
    digest = F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest")
    heads = "warc_type string, record_id string, refers_to string, payload_digest string"
    responses = read_archive(spark, path, f"{heads}, payload binary", verify=str(verify).lower()).where("warc_type = 'response'")
    revisits = read_archive(spark, path, f"{heads}, payload_length long").where("warc_type = 'revisit'")
    found = responses.select("*", F.octet_length("payload").cast("long").alias("payload_length")).drop("payload").unionByName(revisits)
    return found.select(
        page_of(F.col("record_id")).alias("page"), F.col("payload_length").alias("payload_bytes"), digest,
        F.col("warc_type").alias("record_type"), page_of(F.col("refers_to")).alias("refers_to"),
    )

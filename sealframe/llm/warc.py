"""Web archives (WARC/1.1) as a Spark data source, and the deduplicated archive of a table of pages.

Reading: files are packed into partitions of about equal size. A record's header fields are parsed first; equality,
``IN``, prefix and null conditions on them are pushed down and decide before anything of the block is read. A block
that no column asks for is passed over: by a seek in plain files and in gzip members that state their size, else by
inflating it in small pieces that are thrown away. Only the columns of the schema are made, so payloads cost nothing
unless they are asked for.

Writing: every task writes gzip files of one member per record and reports them; the commit replaces one manifest,
which is what readers go by. Files of lost or repeated attempts are in no manifest, so nothing reads them.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull, StringStartsWith,
    WriterCommitMessage,
)

from sealframe.llm.shared import kept
from sealframe.session import staging_folder

FORMAT = "sealframe_warc"
MANIFEST = "_manifest.json"
SCHEMA = """type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, content_type string,
    content_length bigint, headers map<string,string>, http_headers map<string,string>, payload_bytes bigint, payload binary, file string, position bigint"""
# The header field of each text column, and what ends a header and a record.
FIELDS = {
    "type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date", "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest", "content_type": "content-type",
}
BLANK = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Bytes of files per partition, read at once, of a batch of rows, and of a written file before the next begins.
PARTITION, CHUNK, BATCH, ROLL = 128 << 20, 1 << 18, 8 << 20, 128 << 20


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; ``s3a`` is what Spark calls S3."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    scheme, rest = path.split("://", 1)
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")


# Reading


class Plain:
    """Bytes of a file that can be passed over."""

    def __init__(self, file):
        self.file, self.held, self.at = file, bytearray(), 0
        self.begin()

    def begin(self) -> None:
        pass

    def more(self) -> bool:
        data = self.file.read(CHUNK)
        self.held += data
        return bool(data)

    def until(self, mark: bytes) -> bytes | None:
        """What comes before ``mark``, which is passed too; none where the file ends first."""
        seen = 0
        while (found := self.held.find(mark, seen)) < 0:
            seen = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                return None
        return self.take(found + len(mark))[:found]

    def peek(self, n: int) -> bytes:
        while len(self.held) < n and self.more():
            pass
        return bytes(self.held[:n])

    def take(self, n: int) -> bytes:
        if len(self.peek(n)) < n:
            raise EOFError("the file ends within a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        self.at += n
        return out

    def skip(self, n: int) -> None:
        inside = min(n, len(self.held))
        del self.held[:inside]
        if n > inside:
            self.file.seek(n - inside, 1)
        self.at += n


class Members(Plain):
    """The inflated bytes of a gzip file of any number of members.

    ``start`` is the file position of the member that is being read. A member whose extra field ``sl`` states its
    two sizes (deflated as a whole, inflated) can be left by a seek.
    """

    def begin(self) -> None:
        self.raw, self.inflate, self.start, self.sizes, self.inflated = b"", None, 0, None, 0

    def _fresh(self) -> bool:
        """The next member, if there is one."""
        while len(self.raw) < 24 and (data := self.file.read(CHUNK)):
            self.raw += data
        padding = len(self.raw) - len(self.raw.lstrip(b"\0"))
        self.raw = self.raw[padding:]
        if not self.raw:
            return False
        self.start = self.file.tell() - len(self.raw)
        stated = len(self.raw) >= 24 and self.raw[3] & 4 and self.raw[10:16] == b"\x0c\x00sl\x08\x00"
        self.sizes = (int.from_bytes(self.raw[16:20], "little"), int.from_bytes(self.raw[20:24], "little")) if stated else None
        self.inflate, self.inflated = zlib.decompressobj(31), 0
        return True

    def more(self) -> bool:
        while True:
            if self.inflate is None and not self._fresh():
                return False
            self.raw = self.raw or self.file.read(CHUNK)
            if not self.raw:
                raise EOFError("the file ends within a gzip member")
            data = self.inflate.decompress(self.raw, 4 * CHUNK)
            if self.inflate.eof:
                self.raw, self.inflate = self.inflate.unused_data, None
            else:
                self.raw = self.inflate.unconsumed_tail
            self.inflated += len(data)
            self.held += data
            if data:
                return True

    def skip(self, n: int) -> None:
        # The rest of the member is all that is skipped, and its end is known.
        if self.inflate is not None and self.sizes and self.inflated + n - len(self.held) == self.sizes[1]:
            self.file.seek(self.start + self.sizes[0])
            self.raw, self.inflate = b"", None
            self.held.clear()
            self.at += n
            return
        while n:
            part = min(n, len(self.held))
            del self.held[:part]
            self.at += part
            n -= part
            if n and not self.more():
                raise EOFError("the file ends within a record")


def header_fields(text: bytes) -> dict[str, str]:
    """Named fields by lower-case name; a line that starts blank continues the one before it."""
    fields: dict[str, str] = {}
    last = None
    for line in text.split(b"\r\n"):
        if line[:1] in (b" ", b"\t") and last:
            fields[last] += " " + line.strip().decode("utf-8", "replace")
        elif b":" in line:
            name, value = line.split(b":", 1)
            last = name.strip().lower().decode("utf-8", "replace")
            fields[last] = value.strip().decode("utf-8", "replace")
    return fields


@dataclass(frozen=True)
class Condition:
    """A pushed condition on a text column: ``values`` it may be, a prefix, or whether it is there."""

    column: str
    values: tuple | None = None
    prefix: str | None = None
    present: bool | None = None

    @classmethod
    def of(cls, asked: Filter) -> Condition | None:
        column = asked.attribute[0] if getattr(asked, "attribute", None) and len(asked.attribute) == 1 else None
        if column not in FIELDS:
            return None
        if isinstance(asked, EqualTo | EqualNullSafe) and isinstance(asked.value, str):
            return cls(column, values=(asked.value,))
        if isinstance(asked, In):
            return cls(column, values=tuple(v for v in asked.value if v is not None))
        if isinstance(asked, StringStartsWith):
            return cls(column, prefix=asked.value)
        if isinstance(asked, IsNotNull | IsNull):
            return cls(column, present=isinstance(asked, IsNotNull))
        return None

    def holds(self, fields: dict[str, str]) -> bool:
        value = fields.get(FIELDS[self.column])
        if self.present is not None:
            return (value is not None) == self.present
        if value is None:
            return False
        return value in self.values if self.prefix is None else value.startswith(self.prefix)


def records(file, conditions: list[Condition], columns: list[str], counted: dict[str, int] | None = None) -> Iterator[dict]:
    """The records of a file that meet the conditions, as the ``columns`` asked for.

    ``counted`` gets how many records there were and how many bytes of blocks were read.
    """
    zipped = file.read(2) == b"\x1f\x8b"
    file.seek(0)
    stream = (Members if zipped else Plain)(file)
    needs_http = bool({"http_headers", "payload_bytes", "payload"} & set(columns))
    counted = {} if counted is None else counted
    while True:
        while stream.peek(2) == b"\r\n":
            stream.take(2)
        if not stream.peek(1):
            return
        place = stream.start if zipped else stream.at
        if stream.peek(5) != b"WARC/":
            raise ValueError("no WARC record where one should begin")
        head = stream.until(BLANK)
        if head is None:
            raise EOFError("the file ends within a header")
        fields = header_fields(head)
        length = int(fields["content-length"])
        counted["records"] = counted.get("records", 0) + 1
        if not all(c.holds(fields) for c in conditions):
            stream.skip(length + len(BLANK))
            continue
        row = {c: fields.get(f) for c, f in FIELDS.items()} | {"content_length": length, "headers": fields, "position": place}
        rest = length
        if needs_http:
            http, rest = None, length
            if fields.get("content-type", "").lower().startswith("application/http"):
                http, rest = _http_head(stream, length)
            counted["read"] = counted.get("read", 0) + length - rest
            row["http_headers"] = http
            row["payload_bytes"] = rest
            if fields.get("warc-type") == "revisit":  # its block holds at most a header
                size = (http or {}).get("content-length", "")
                row["payload_bytes"] = int(size) if size.isdecimal() else None
            if "payload" in columns:
                row["payload"] = stream.take(rest)
                counted["read"] += rest
                rest = 0
        stream.skip(rest + len(BLANK))
        yield row


def _http_head(stream: Plain, length: int) -> tuple[dict[str, str] | None, int]:
    """Header fields of an HTTP message and how many bytes of the block follow them."""
    size = 0
    while True:
        size = min(length, size + 4096)
        found = stream.peek(size).find(BLANK)
        if found >= 0:
            return header_fields(stream.take(found + len(BLANK))[:found]), length - found - len(BLANK)
        if size == length:
            return None, length


@dataclass
class Files(InputPartition):
    names: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, schema, options):
        self.schema, self.path = schema, options["path"]
        self.size = int(options.get("partitionBytes", PARTITION))
        self.conditions: list[Condition] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for asked in filters:
            condition = Condition.of(asked)
            if condition is None:
                yield asked
            else:
                self.conditions.append(condition)

    def partitions(self) -> list[Files]:
        system, root = store(self.path)
        found = sorted(listed(system, root), key=lambda f: (-f[1], f[0]))
        packed, size = [], 0
        for name, n in found:
            if not packed or size + n > self.size:
                packed.append(Files([]))
                size = 0
            packed[-1].names.append(name)
            size += n
        return packed or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        system, _ = store(self.path)
        schema = to_arrow_schema(self.schema)
        rows, size = [], 0

        def batch() -> pa.RecordBatch:
            columns = [[r.get(f.name) for r in rows] for f in schema]
            return pa.RecordBatch.from_arrays([pa.array([list(x.items()) if isinstance(x, dict) else x for x in c], f.type) for c, f in zip(columns, schema)], schema=schema)

        for name in partition.names:
            with system.open_input_file(name) as file:
                try:
                    for row in records(file, self.conditions, schema.names):
                        rows.append(row | {"file": name})
                        size += len(row.get("payload") or b"") + 1024
                        if size >= BATCH:
                            yield batch()
                            rows, size = [], 0
                except (EOFError, ValueError, zlib.error) as broken:
                    raise ValueError(f"{name}: {broken}") from broken
        if rows:
            yield batch()


def listed(system: fs.FileSystem, root: str) -> list[tuple[str, int]]:
    """Files and sizes below a folder: those of its manifest, or all that are not hidden. Or the file itself."""
    here = system.get_file_info(root)
    if here.type == fs.FileType.File:
        return [(root, here.size)]
    manifest = system.get_file_info(f"{root}/{MANIFEST}")
    if manifest.type == fs.FileType.File:
        with system.open_input_stream(manifest.path) as file:
            return [(f"{root}/{name}", size) for name, size in json.loads(file.read())]
    every = system.get_file_info(fs.FileSelector(root, recursive=True))
    return [(f.path, f.size) for f in every if f.type == fs.FileType.File and not any(p[:1] in "._" for p in f.path[len(root) + 1:].split("/"))]


# Writing


def member(block: bytes, level: int) -> bytes:
    """A gzip member that states its sizes in the extra field ``sl``."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(block) + deflate.flush()
    sizes = (24 + len(body) + 8).to_bytes(4, "little") + (len(block) & 0xFFFFFFFF).to_bytes(4, "little")
    return b"".join([b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x0c\x00sl\x08\x00", sizes, body,
                     zlib.crc32(block).to_bytes(4, "little"), (len(block) & 0xFFFFFFFF).to_bytes(4, "little")])


def record(row: dict, date: str) -> bytes:
    """A response with an HTTP header, or a revisit with the header alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % row["payload_bytes"] + BLANK
    revisit = row["type"] == "revisit"
    block = http if revisit else http + (row["payload"] or b"")
    fields = [("WARC-Type", row["type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", date), ("WARC-Target-URI", row["target_uri"]),
              ("WARC-Payload-Digest", row["payload_digest"])]
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", row["refers_to"])]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "\r\n".join(["WARC/1.1", *[f"{k}: {v}" for k, v in fields if v is not None]])
    return b"".join([head.encode(), BLANK, block, BLANK])


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.level, self.roll, self.date = int(options.get("level", 6)), int(options.get("rollBytes", ROLL)), options.get("date", "1970-01-01T00:00:00Z")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = store(self.path)
        system.create_dir(root, recursive=True)
        done, file, size = [], None, 0
        for batch in iterator:
            for i in range(batch.num_rows):
                if file is None:
                    name, size = f"part-{uuid.uuid4().hex}.warc.gz", 0
                    file = system.open_output_stream(f"{root}/{name}", compression=None)
                packed = member(record(batch.slice(i, 1).to_pylist()[0], self.date), self.level)
                file.write(packed)
                size += len(packed)
                if size >= self.roll:
                    file.close()
                    done.append((name, size))
                    file = None
        if file is not None:
            file.close()
            done.append((name, size))
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = store(self.path)
        system.create_dir(root, recursive=True)
        before = listed(system, root) if system.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.File else []
        new = [f for m in messages if m for f in m.files]
        named = new if self.overwrite else [*((p[len(root) + 1:], n) for p, n in before), *new]
        with system.open_output_stream(f"{root}/{MANIFEST}", compression=None) as file:
            file.write(json.dumps(named).encode())
        for old, _ in before if self.overwrite else []:
            system.delete_file(old)

    def abort(self, messages: list[Written | None]) -> None:
        system, root = store(self.path)
        for name, _ in [f for m in messages if m for f in m.files]:
            system.delete_file(f"{root}/{name}")


class WarcSource(DataSource):
    """``spark.read.format("sealframe_warc").schema(columns).load(folder)``; options ``partitionBytes``, and for writing ``level``,
    ``rollBytes`` and ``date``. Folders are in stores that Arrow's file systems reach."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


COLUMNS = {c.split()[0]: c for c in (x.strip() for x in SCHEMA.replace("map<string,string>", "map<string;string>").split(","))}


def read_warc(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """These columns of all records. Conditions on header columns that follow are pushed into the scan, whose partitions have the size
    of Spark's own."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    size = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return spark.read.format(FORMAT).option("partitionBytes", size).schema(", ".join(COLUMNS[c].replace(";", ",") for c in columns)).load(path)


# Pages


def base32(hexed: Column, size: int = 40) -> Column:
    """RFC 4648 base32 of ``size`` hexadecimal digits, a multiple of ten: each ten digits are eight of base 32."""
    digits = [F.lpad(F.conv(F.substring(hexed, i, 10), 16, 32), 8, "0") for i in range(1, size, 10)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


# A group of equal payloads with more than this share of all repeated ones is hot; there are fewer than 1 / HOT of them.
HOT = 0.001


def write_pages(pages: DataFrame, path: str, least: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """A record for every row of (page_id, url, html), payload the html in UTF-8, null html being empty.

    Of rows with equal payloads of at least ``least`` bytes the one with the smallest page_id is the response, null ids last
    and one of the rows that repeat it; the others are revisits of it. Control characters and blanks of a URL are percent-encoded; a null URL
    is left out. ``pages`` is a stored table: it is read twice, and its rows are told apart by their places.

    Only digests are gathered to find the groups, and each group is one row of the partial aggregates. Rows of the few hot
    groups learn their response from a broadcast of fewer than 1,000 rows; the rest meet theirs by a join on the digest,
    where no group has more than a thousandth of the repeated rows.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"),
                        F.monotonically_increasing_id().alias("row")).withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("bigint"))
    first = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "row")
    with staging_folder(spark) as folder:
        groups = rows.where(F.col("size") >= least).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("first")).where("n > 1")
        groups = kept(groups.select("digest", "n", F.col("first.page_id").alias("first_id"), F.col("first.row").alias("first_row")), folder)
        repeated = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        is_hot = F.col("n") > F.lit(HOT * repeated)
        hot = groups.where(is_hot).select(F.col("digest").alias("hot_digest"), F.col("first_id").alias("hot_id"), F.col("first_row").alias("hot_row"))
        cold = groups.where(~is_hot).select(F.col("digest").alias("key"), "first_id", "first_row")
        # Hot rows get a key of their own, so that they spread, and leave their payload behind.
        told = rows.join(F.broadcast(hot), (F.col("digest") == F.col("hot_digest")) & (F.col("size") >= least), "left")
        keyed = told.withColumn("key", F.when(F.col("hot_row").isNull() & (F.col("size") >= least), F.col("digest")).otherwise(F.concat(F.lit("row "), "row"))) \
            .withColumn("payload", F.when(F.col("hot_row").isNull() | (F.col("hot_row") == F.col("row")), F.col("payload")))
        joined = keyed.join(cold, "key", "left").withColumn("first_row", F.coalesce("hot_row", "first_row")).withColumn("first_id", F.coalesce("hot_id", "first_id"))
        again = F.col("first_row").isNotNull() & (F.col("first_row") != F.col("row"))
        joined.select(
            F.when(again, "revisit").otherwise("response").alias("type"), _record_id(F.col("page_id"), F.col("row")).alias("record_id"),
            _uri(F.col("url")).alias("target_uri"), F.when(again, _record_id(F.col("first_id"), F.col("first_row"))).alias("refers_to"),
            F.concat(F.lit("sha1:"), base32(F.col("digest"))).alias("payload_digest"), F.col("size").alias("payload_bytes"),
            F.when(~again, F.col("payload")).alias("payload"),
        ).write.format(_registered(spark)).option("date", date).mode("overwrite").save(path)


def _registered(spark: SparkSession) -> str:
    spark.dataSource.register(WarcSource)
    return FORMAT


def _record_id(page_id: Column, row: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), row.cast("string"), F.lit(">"))


def _uri(url: Column) -> Column:
    """No character that would end a header field or be trimmed from it."""
    for code in [*range(0x21), 0x7F]:
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record of an archive of ``write_pages``.

    Responses are read whole, their payloads measured and their digests computed and compared with the header's. Of revisits
    only headers are read.
    """
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d*):\d+>$", 1).try_cast("bigint")
    stated = F.regexp_extract("payload_digest", "^sha1:([A-Z2-7]{32})$", 1)
    found = base32(F.sha1("payload"))
    digest = F.when(found == stated, found).otherwise(F.raise_error(F.concat(F.lit("digest of "), "record_id", F.lit(" does not match"))))
    responses = read_warc(spark, path, ["type", "record_id", "payload_digest", "payload"]).where(F.col("type") == "response").select(
        page("record_id").alias("page_id"), F.octet_length("payload").cast("bigint").alias("payload_bytes"), digest.alias("payload_digest"),
        F.col("type").alias("record_type"), F.lit(None).cast("bigint").alias("refers_to"))
    revisits = read_warc(spark, path, ["type", "record_id", "payload_digest", "refers_to", "payload_bytes"]).where(F.col("type") == "revisit").select(
        page("record_id").alias("page_id"), "payload_bytes", stated.alias("payload_digest"), F.col("type").alias("record_type"), page("refers_to").alias("refers_to"))
    return responses.unionByName(revisits)

"""Crawl-archive source ``warc``: response records of ``.warc`` and ``.warc.gz`` files.

Archives are cut into byte ranges, one task each, and a record belongs to the range its
first byte lies in.  In a compressed archive a task looks for the first gzip member that
opens a record, and stops at the first one beyond its range; an archive that is one
member cannot be cut.  Pages can imitate every mark of a plain archive, so there a task
walks the record headers before its range and skips the bodies.  The rows do not depend
on the ranges.

Rows of a member are let out when its end has been read and checked.  A damaged member
costs its own records only and gives one row that says so; reading goes on at the next
member.  Filters on the header columns are tested before a body is read.
"""

from __future__ import annotations

import functools
import io
import operator
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from pairmine.schemas import CRAWL_RECORD

# Recognised file endings, compared in lower case.
SUFFIXES = (".warc", ".warc.gz")
# An archive is read in ranges of about this size.
SPLIT_BYTES = 128 << 20
# Damage: what stands in the way instead of a record.
JUNK, CUT, BAD = "junk", "cut off", "bad member"
_BATCH_BYTES = 8 << 20
_BATCH_ROWS = 1024
# Junk and headers without line ends are read in pieces of this size.
_LINE_BYTES = 1 << 20
_READ_BYTES = 256 << 10
_PROBE_BYTES = 64 << 10
_MAGIC = b"\x1f\x8b\x08"
_PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def _is_archive(name: str) -> bool:
    return name.lower().endswith(SUFFIXES)


def archives(path: str, recursive: bool = False) -> list[tuple[str, int]]:
    """Archives at ``path`` (a file or a folder) with their sizes, sorted."""
    filesystem, root = _locate(path)
    info = filesystem.get_file_info(root)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    if info.type != fs.FileType.Directory:
        raise FileNotFoundError(path)
    entries = filesystem.get_file_info(fs.FileSelector(root, recursive=recursive))
    prefix = path.rstrip("/")
    return sorted(
        (prefix + e.path[len(root.rstrip("/")):], e.size)
        for e in entries
        if e.type == fs.FileType.File and _is_archive(e.base_name)
    )


def _locate(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


# --- records of a stream ---------------------------------------------------------


def _read_headers(stream) -> dict[str, str]:
    """Header lines up to the empty line, names in lower case."""
    headers: dict[str, str] = {}
    while True:
        line = stream.readline(_LINE_BYTES)
        if line in (b"\r\n", b"\n", b""):
            return headers
        name, _, value = line.decode("utf-8", "replace").partition(":")
        headers.setdefault(name.strip().lower(), value.strip())


def iter_responses(
    stream,
    html_only: bool = False,
    wanted: Callable[[tuple], bool] | None = None,
    low: int = 0,
    high: int | None = None,
) -> Iterator[tuple]:
    """``(offset, target_uri, http_parsed, content_type, length, body, damage)`` of each response record.

    Only records that start in ``[low, high)``.  ``wanted`` is asked with the first five values
    before the body is read; with ``html_only`` the bodies of other responses are skipped, too.

    A stretch that is no record yields one row without URL and headers, and reading goes
    on at the next line that starts a record; a cut end yields such a row as well.  Errors
    of the storage are raised: the task fails and runs again.
    """
    offset, lost = 0, False
    try:
        while True:
            offset = stream.tell()
            line = stream.readline(_LINE_BYTES)
            if not line:
                return
            if not line.strip():
                continue
            if high is not None and offset >= high:
                return
            length = -1
            if line.startswith(b"WARC/"):
                headers = _read_headers(stream)
                declared = headers.get("content-length", "")
                length = int(declared) if declared.isascii() and declared.isdigit() else -1
            if length < 0:
                if not lost and offset >= low:
                    yield (offset, None, False, None, None, None, JUNK)
                lost = True
                continue
            lost = False
            if offset < low or headers.get("warc-type", "").lower() != "response":
                _skip(stream, length)
                continue
            url = headers.get("warc-target-uri", "").strip("<>")
            row = _http(_Record(stream, length), offset, url, html_only, wanted)
            if row:
                yield row
    except EOFError:
        if offset >= low:
            yield (offset, None, False, None, None, None, CUT)


def _skip(stream, length: int) -> None:
    if length > _LINE_BYTES and stream.seekable():
        stream.seek(stream.tell() + length - 1)
        length = 1
    while length > 0:
        chunk = stream.read(min(length, 1 << 20))
        if not chunk:
            raise EOFError("record cut off")
        length -= len(chunk)


class _Record:
    """The part of a stream that one record fills."""

    def __init__(self, stream, length: int):
        self._stream, self.left = stream, length

    def readline(self, size: int = _LINE_BYTES) -> bytes:
        line = self._stream.readline(min(self.left, size)) if self.left else b""
        if not line and self.left:
            raise EOFError("record cut off")
        self.left -= len(line)
        return line

    def read(self) -> bytes:
        data = self._stream.read(self.left) if self.left else b""
        if len(data) < self.left:
            raise EOFError("record cut off")
        self.left = 0
        return data

    def skip(self) -> None:
        _skip(self._stream, self.left)


def _http(record: _Record, offset: int, url: str, html_only: bool, wanted) -> tuple | None:
    """The row of a response, or None if it is not wanted; reads all of the record."""
    first = record.readline()
    parsed = first.startswith(b"HTTP/")
    content_type = _read_headers(record).get("content-type") if parsed else None
    length = record.left if parsed else record.left + len(first)
    head = (offset, url, parsed, content_type, length)
    if wanted and not wanted(head):
        return record.skip()
    if html_only and not (content_type or "").lower().startswith("text/html"):
        record.skip()
        return (*head, None, None)
    return (*head, record.read() if parsed else first + record.read(), None)


# --- gzip members ----------------------------------------------------------------


def _probe(data: bytes) -> bytes | None:
    """The first decompressed bytes of the member at the start of ``data``; None if it is none."""
    if not data.startswith(_MAGIC) or len(data) < 4 or data[3] & 0xE0:
        return None
    try:
        return zlib.decompressobj(31).decompress(data, 32)
    except zlib.error:
        return None


def _opens_record(data: bytes) -> bool:
    return (_probe(data) or b"").lstrip().startswith(b"WARC/")


def _at(file, offset: int, size: int = _PROBE_BYTES) -> bytes:
    file.seek(offset)
    return file.read(size)


def _next_member(file, offset: int, high: int) -> int | None:
    """Where the first member at or after ``offset`` and before ``high`` starts that opens a record."""
    while offset < high:
        block = _at(file, offset, _READ_BYTES)
        if len(block) < len(_MAGIC):
            return None
        place = block.find(_MAGIC)
        while place >= 0:
            if offset + place >= high:
                return None
            if _opens_record(_at(file, offset + place)):
                return offset + place
            place = block.find(_MAGIC, place + 1)
        offset += len(block) - len(_MAGIC) + 1
    return None


class _Members(io.RawIOBase):
    """What a member holds, and members behind it that go on within its last record."""

    def __init__(self, file, start: int):
        self._file, self._at, self.member = file, start, start
        self._inflate, self._held = zlib.decompressobj(31), b""
        self.end: int | None = None

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while self.end is None:
            if not self._held:
                self._held = _at(self._file, self._at, _READ_BYTES)
                self._at += len(self._held)
                if not self._held:
                    raise zlib.error("member cut off")
            data = self._inflate.decompress(self._held, len(buffer))
            self._held = self._inflate.unconsumed_tail
            if self._inflate.eof:
                self._turn(self._at - len(self._inflate.unused_data))
            if data:
                buffer[: len(data)] = data
                return len(data)
        return 0

    def _turn(self, offset: int) -> None:
        """Go on with the member at ``offset`` unless it opens a record of its own."""
        following = _probe(_at(self._file, offset))
        if following is None or following.lstrip().startswith(b"WARC/"):
            self.end = offset
        else:
            self.member, self._at, self._held = offset, offset, b""
            self._inflate = zlib.decompressobj(31)


def _iter_members(file, size: int, low: int, high: int, html_only: bool, wanted) -> Iterator[tuple]:
    """Rows of the members of a compressed archive that start in ``[low, high)``."""
    if low == 0:
        yield from _lost(file, 0, size)
    offset = _next_member(file, low, high)
    while offset is not None:
        members = _Members(file, offset)
        # A row waits until the next record or the checked end shows that it is whole.
        waiting: list[tuple] = []
        try:
            for row in iter_responses(_Counting(members), html_only, wanted):
                if row[-1] is None:
                    yield from waiting
                    waiting = []
                waiting.append((offset + row[0], *row[1:]))
            yield from waiting
            resume = members.end
            yield from _lost(file, resume, size)
        except zlib.error:
            yield (members.member, None, False, None, None, None, BAD)
            resume = members.member + 1
        offset = _next_member(file, resume, high)


def _lost(file, offset: int, size: int) -> Iterator[tuple]:
    """A row if what follows a member is neither the end, nor zeros, nor another member."""
    while offset < size:
        data = _at(file, offset)
        plain = data.lstrip(b"\0")
        if plain:
            offset += len(data) - len(plain)
            if not _opens_record(_at(file, offset)):
                yield (offset, None, False, None, None, None, JUNK)
            return
        offset += len(data)


# --- the rows of an archive ------------------------------------------------------


def read_archive(
    path: str,
    html_only: bool = True,
    low: int = 0,
    high: int | None = None,
    name: str | None = None,
    wanted: Callable[[tuple], bool] | None = None,
) -> Iterator[pa.RecordBatch]:
    """Rows of the records that start in a byte range of one archive.

    With ``html_only`` other payloads are counted but not carried.
    """
    schema = to_arrow_schema(CRAWL_RECORD)
    filesystem, file_path = _locate(path)
    name = name or file_path.rsplit("/", 1)[-1]
    asked = (lambda head: wanted(_columns(name, (*head, None, None)))) if wanted else None
    rows: list[tuple] = []
    held = 0
    with filesystem.open_input_file(file_path) as file:
        size = file.size()
        high = size if high is None else high
        if file_path.lower().endswith(".gz"):
            found = _iter_members(file, size, low, high, html_only, asked)
        else:
            found = iter_responses(_Counting(file), html_only, asked, low, high)
        for row in found:
            if row[-1] and wanted and not wanted(_columns(name, row)):
                continue
            rows.append(_columns(name, row))
            held += len(row[5] or b"")
            if held >= _BATCH_BYTES or len(rows) >= _BATCH_ROWS:
                yield _batch(rows, schema)
                rows, held = [], 0
    if rows:
        yield _batch(rows, schema)


def _columns(name: str, row: tuple) -> tuple:
    """The row in the order of ``CRAWL_RECORD``."""
    offset, url, parsed, content_type, length, body, damage = row
    kind = content_type.lower().partition(";")[0].strip() if content_type else None
    return (name, offset, url, parsed, content_type, length, body, kind, damage)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(values, type=field.type) for values, field in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


class _Counting(io.BufferedReader):
    """Buffered reader whose position also works over an unseekable stream."""

    def __init__(self, raw):
        super().__init__(_Raw(raw), 1 << 20)
        self._position = 0

    def readline(self, size=-1):
        line = super().readline(size)
        self._position += len(line)
        return line

    def read(self, size=-1):
        data = super().read(size)
        self._position += len(data)
        return data

    def seek(self, offset):
        self._position = super().seek(offset)

    def tell(self):
        return self._position


class _Raw(io.RawIOBase):
    def __init__(self, stream):
        self._stream = stream

    def readable(self):
        return True

    def seekable(self):
        return self._stream.seekable()

    def seek(self, *place):
        return self._stream.seek(*place)

    def tell(self):
        return self._stream.tell()

    def readinto(self, buffer):
        data = self._stream.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


# --- the source ------------------------------------------------------------------

_NAMES = CRAWL_RECORD.fieldNames()
_COMPARED = {
    ds.EqualTo: operator.eq,
    ds.GreaterThan: operator.gt,
    ds.GreaterThanOrEqual: operator.ge,
    ds.LessThan: operator.lt,
    ds.LessThanOrEqual: operator.le,
    ds.StringStartsWith: str.startswith,
    ds.StringEndsWith: str.endswith,
    ds.StringContains: operator.contains,
    ds.In: lambda value, among: value in among,
}


def _test(condition) -> tuple[int, Callable, object] | None:
    """A condition on a header column as (place, test, value); None for any other."""
    if isinstance(condition, ds.Not):
        inner = _test(condition.child)
        compared = inner and inner[1] not in (operator.is_, operator.is_not)
        return (inner[0], functools.partial(_fails, inner[1]), inner[2]) if compared else None
    if not hasattr(condition, "attribute") or len(condition.attribute) != 1:
        return None
    name = condition.attribute[0]
    if name not in _NAMES or name == "html_bytes":
        return None
    place = _NAMES.index(name)
    if isinstance(condition, ds.IsNotNull):
        return place, operator.is_not, None
    if isinstance(condition, ds.IsNull):
        return place, operator.is_, None
    compare = _COMPARED.get(type(condition))
    return (place, compare, condition.value) if compare else None


def _fails(test: Callable, value, among) -> bool:
    return not test(value, among)


class _Wanted:
    """All conditions at once, over a row without its body."""

    def __init__(self, tests: list[tuple]):
        self.tests = tests

    def __call__(self, row: tuple) -> bool:
        for place, test, value in self.tests:
            own = row[place]
            if test is operator.is_ or test is operator.is_not:
                if not test(own, None):
                    return False
            elif own is None or not test(own, value):
                return False
        return True


class _RangePartition(InputPartition):
    def __init__(self, path: str, name: str, low: int, high: int):
        super().__init__(path)
        self.path, self.name, self.low, self.high = path, name, low, high


class _ArchiveReader(DataSourceReader):
    def __init__(self, options):
        self._path = options["path"]
        self._recursive = options.get("recursive", "false").lower() == "true"
        self._html_only = options.get("htmlonly", "true").lower() == "true"
        self._split = max(1, int(options.get("splitbytes", SPLIT_BYTES)))
        self.tests: list[tuple] = []

    def partitions(self):
        root = self._path.rstrip("/") + "/"
        return [
            _RangePartition(path, name, low, min(size, low + self._split))
            for path, size in archives(self._path, self._recursive)
            for name in [path.removeprefix(root) if path.startswith(root) else path.rsplit("/", 1)[-1]]
            for low in range(0, size, self._split)
        ]

    def read(self, partition):
        if getattr(partition, "path", None):
            p = partition
            wanted = _Wanted(self.tests) if self.tests else None
            yield from read_archive(p.path, self._html_only, p.low, p.high, p.name, wanted)


class _FilteringReader(_ArchiveReader):
    """Takes over the filters on header columns."""

    def pushFilters(self, filters):
        for condition in filters:
            test = _test(condition)
            if test is None:
                yield condition
            else:
                self.tests.append(test)


class WarcDataSource(DataSource):
    """``spark.read.format("warc").option("recursive", …).load(path)``.

    Options: ``recursive``, ``htmlOnly``, ``splitBytes``, and ``pushDown``, which needs the
    session setting that ``read_warc`` makes.
    """

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return CRAWL_RECORD

    def reader(self, schema):
        options = {k.lower(): v for k, v in self.options.items()}
        pushes = options.get("pushdown", "false").lower() == "true"
        return (_FilteringReader if pushes else _ArchiveReader)(options)


def read_warc(
    spark: SparkSession,
    path: str,
    recursive: bool = False,
    html_only: bool = True,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Response records of all archives at ``path``, a task per range of ``split_bytes``.

    ``record_offset`` is where the member (in a plain archive: the record) starts; records behind
    the first of a member count on in its uncompressed bytes.  ``warc_path`` is relative to
    ``path``.  Filters on all columns but ``html_bytes`` are tested in the source.
    """
    spark.dataSource.register(WarcDataSource)
    spark.conf.set(_PUSHDOWN, "true")
    reader = spark.read.format("warc").option("recursive", str(recursive).lower()).option("pushDown", "true")
    return reader.option("htmlOnly", str(html_only).lower()).option("splitBytes", str(split_bytes)).load(path)


def records_of(paths: DataFrame, html_only: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Response records of the archives listed in ``paths(path, length)``; for listings that stream in.

    The ranges of large archives go to tasks of their own.
    """
    from pyspark.sql import functions as F

    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))
    ranges = paths.select("path", "length", F.explode(starts).alias("low"))

    def read(batches):
        for batch in batches:
            for path, length, low in zip(*(c.to_pylist() for c in batch.columns)):
                yield from read_archive(path, html_only, low, min(length, low + split_bytes))

    return ranges.mapInArrow(read, CRAWL_RECORD)


def stream_archives(spark: SparkSession, path: str, max_files: int = 1_000) -> DataFrame:
    """New archives of a folder as a stream of response records.

    Only the listing streams through the file source, which remembers what it
    has seen; file contents are read by the tasks.
    """
    listing = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", "*.[wW][aA][rR][cC]*")
        .option("maxFilesPerTrigger", max_files)
        .load(path)
    )
    wanted = listing.filter("lower(path) rlike '[.]warc([.]gz)?$'")
    return records_of(wanted)

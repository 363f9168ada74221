"""Readers of raw files. Cells are strings until a projection types them."""

from __future__ import annotations

import bz2
import codecs
import csv
import gzip
import io
import re
import tarfile
import xml.etree.ElementTree as ET
import zipfile
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.csv as pa_csv
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OVERFLOW = "_overflow_"
FILE = "filename"


def file_of() -> Column:
    """The path a row was read from, with its escapes undone."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def scan_csv_positional(spark: SparkSession, paths, names: list[str], **options) -> DataFrame:
    """Cells by place: short rows are padded with nulls, and what lies past the names is in
    _overflow_, which a reader with the bare names would silently drop. A name "-" is left out."""
    wide = [f"_skip{i}" if n == "-" else n for i, n in enumerate(names)] + [OVERFLOW]
    rows = spark.read.schema(_strings(wide)).options(header=False, **options).csv(paths).withColumn(FILE, file_of())
    return rows.select(*[c for c in wide if not c.startswith("_skip")], FILE)


def _header(line: str) -> list[str]:
    """The names in a table's first line, in lower case."""
    return [n.strip().strip('"').lower() for n in next(csv.reader([line.strip("\r\n\ufeff")]), [])]


class _Cells:
    """Cells of headed tables as columns: the wanted ones by the table's own names, the first cell past them, and the table's file."""

    def __init__(self, wanted: list[str]):
        self.wanted = wanted
        self.schema = pa.schema([(w, pa.string()) for w in [*wanted, OVERFLOW, FILE]])

    def batches(self, path: str, names: list[str], rows, line_breaks: bool) -> Iterator[pa.RecordBatch]:
        """Columns of rows, a file of comma-separated lines without the header. Short rows are padded with nulls."""
        ragged: list[str] = []

        def put_by(row) -> str:
            ragged.append(row.text)
            return "skip"

        width, places = len(names), {n: i for i, n in reversed(list(enumerate(names)))}
        taken = [places.get(w.lower()) for w in self.wanted]
        columns = [f"c{i}" for i in range(width)]
        try:
            reader = pa_csv.open_csv(rows, pa_csv.ReadOptions(column_names=columns, block_size=8 << 20, use_threads=False), pa_csv.ParseOptions(newlines_in_values=line_breaks, invalid_row_handler=put_by),
                                     pa_csv.ConvertOptions(column_types=dict.fromkeys(columns, pa.string()), strings_can_be_null=True, quoted_strings_can_be_null=False, null_values=[""]))
        except pa.ArrowInvalid as broken:
            if not str(broken).startswith("Empty CSV") and not ragged:
                raise
            reader = ()
        for batch in reader:
            none = pa.nulls(batch.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays([*(none if i is None else batch.column(i) for i in taken), none, pa.array([path] * batch.num_rows)], schema=self.schema)
        cells = list(csv.reader(ragged))
        at = lambda row, i: row[i] or None if i is not None and i < len(row) else None
        if cells:
            yield pa.RecordBatch.from_arrays([*(pa.array([at(r, i) for r in cells], pa.string()) for i in taken), pa.array([at(r, width) for r in cells], pa.string()), pa.array([path] * len(cells))], schema=self.schema)

    def table(self, path: str, stream: io.BufferedIOBase) -> Iterator[pa.RecordBatch]:
        """Columns of a whole table, header included."""
        stream = stream if hasattr(stream, "peek") else io.BufferedReader(stream)
        first = stream.readline().decode("utf-8", "replace")
        if first.strip("\r\n\ufeff"):
            yield from self.batches(path, _header(first), pa.PythonFile(_Utf8(stream)), True)


class _Utf8(io.RawIOBase):
    """A stream of text with what is no UTF-8 replaced."""

    def __init__(self, stream):
        self.stream, self.decoder, self.left = stream, codecs.getincrementaldecoder("utf-8")("replace"), b""

    def readable(self) -> bool:
        return True

    def read(self, size: int = -1) -> bytes:
        while not self.left:
            data = self.stream.read(size if size and size > 0 else 1 << 20)
            self.left = self.decoder.decode(data, final=not data).encode()
            if not data:
                break
        out, self.left = (self.left, b"") if size is None or size < 0 else (self.left[:size], self.left[size:])
        return out


#: Bytes of an Arrow batch sent to Python: files must not meet in one.
BATCH_BYTES = 16 << 20


def one_by_one(spark: SparkSession) -> None:
    """Files of some size go to Python one by one."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def _split_from(spark: SparkSession) -> int:
    """The size from which a file is read in splits. Splits of two such files are never one task's, so a task that reads the head of one begins with it."""
    text = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return int(text) // 2


def scan_csv_named(spark: SparkSession, paths, wanted: list[str]) -> DataFrame:
    """Cells by the names of each file's own header, compared without case; files may differ in order and in columns, and columns that a file has not
    are null. Folders are read with all below them. Files are not listed or grouped in the driver.

    A file is read once, whole, by the task that has it, and may have line breaks inside quotes. One too large for a task is read in splits: a first pass takes the
    first lines of such files, each from the head of one task's split, and every split has its file's header beside it (a short row for each file of half
    a split's size or more). There, a quoted line break ends the row. Empty files have no header and are left out.
    """
    one_by_one(spark)
    cells, most = _Cells(wanted), _split_from(spark)
    schema = ", ".join(f"`{w}` string" for w in [*wanted, OVERFLOW, FILE])

    def whole(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                for name, stream in _members(path.as_py(), content.as_buffer(), single=True):
                    yield from cells.table(path.as_py(), stream)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    small = files.filter(F.col("length").between(1, most)).select(file_of().alias("path"), "content").mapInArrow(whole, schema)
    lines = _large_lines(spark, paths, most)
    return small.unionByName(_cells_of_splits(lines, _heads(lines), wanted))


def _large_lines(spark: SparkSession, paths, most: int) -> DataFrame:
    """value, path, at (where its split begins) of the lines of files of over most bytes."""
    return spark.read.option("recursiveFileLookup", True).text(paths).filter(F.col("_metadata.file_size") > most).select("value", file_of().alias("path"), F.col("_metadata.file_block_start").alias("at"))


def _heads(lines: DataFrame) -> DataFrame:
    """path, header: the first line of each file, from the head of one task's split."""

    def heads(batches):
        for batch in batches:
            if batch.num_rows:
                if batch.column(2)[0].as_py() == 0:
                    yield pa.RecordBatch.from_arrays([batch.column(1).slice(0, 1), batch.column(0).slice(0, 1)], names=["path", "header"])
                return

    return lines.mapInArrow(heads, "path string, header string")


def _cells_of_splits(lines: DataFrame, known: DataFrame, wanted: list[str]) -> DataFrame:
    """Cells of the files of known (path, header) from their lines, split by split."""
    cells = _Cells(wanted)
    schema = ", ".join(f"`{w}` string" for w in [*wanted, OVERFLOW, FILE])

    def splits(batches):
        for batch in batches:
            value, path, at, header = batch.columns
            file = path.dictionary_encode()
            where = np.asarray(file.indices) * (1 << 1) + (np.asarray(at) > 0)
            edges = np.flatnonzero(np.r_[True, where[1:] != where[:-1], True]) if len(where) else []
            for lo, hi in zip(edges, edges[1:]):
                name, first = path[int(lo)].as_py(), header[int(lo)].as_py()
                lines = value.slice(lo, hi - lo).to_pylist()
                if at[int(lo)].as_py() == 0 and name not in begun:
                    begun.add(name)
                    lines = lines[1:]
                if first and lines:
                    yield from cells.batches(name, _header(first), io.BytesIO("\n".join(lines).encode()), False)

    begun: set[str] = set()
    return lines.join(F.broadcast(known), "path").select("value", "path", "at", "header").mapInArrow(splits, schema)


def scan_ndjson(spark: SparkSession, paths, fields: str) -> DataFrame:
    """One JSON object a line, with declared fields; unknown ones are ignored, missing ones null."""
    return spark.read.schema(fields).json(paths).withColumn(FILE, file_of())


def scan_lines(spark: SparkSession, paths, name: str = "line") -> DataFrame:
    return spark.read.text(paths).withColumnRenamed("value", name).withColumn(FILE, file_of())


def scan_words(spark: SparkSession, paths, names: list[str]) -> DataFrame:
    """Words between runs of blanks, by place, with the number of words in _width."""
    return words_of(scan_lines(spark, paths), names)


def words_of(lines: DataFrame, names: list[str]) -> DataFrame:
    words = F.split(F.regexp_replace("line", r"^[ \t\r]+|[ \t\r]+$", ""), r"\s+")
    rows = lines.filter(F.trim("line") != "").withColumn("_words", words)
    return rows.select(*[F.get("_words", F.lit(i)).alias(n) for i, n in enumerate(names)], F.size("_words").alias("_width"), FILE)


SHEET = b"PK\x03\x04"


def binary_files(spark: SparkSession, paths) -> DataFrame:
    """path, content, length of whole files: of archives and workbooks, which cannot be split."""
    return spark.read.format("binaryFile").load(paths).select("path", "content", "length")


def split_by_signature(files: DataFrame) -> DataFrame:
    """path, kind (sheet or text) by the first four bytes, and the length."""
    return files.select("path", F.when(F.substring("content", 1, 4) == F.lit(SHEET), "sheet").otherwise("text").alias("kind"), F.length("content").cast("long").alias("length"))


def _stream(content: bytes | pa.Buffer) -> io.BufferedIOBase:
    """A stream over bytes where they are."""
    return io.BufferedReader(pa.BufferReader(content))


def _members(path: str, content: bytes | pa.Buffer, single: bool = False) -> Iterator[tuple[str, io.BufferedIOBase]]:
    """The files in a file: single takes it for one, compressed or not."""
    if path.endswith(".gz") and not path.endswith(".tar.gz"):
        yield path.rsplit("/", 1)[-1][:-3], gzip.GzipFile(fileobj=_stream(content))
    elif path.endswith(".bz2"):
        yield path.rsplit("/", 1)[-1][:-4], bz2.BZ2File(_stream(content))
    elif single or not path.endswith((".zip", ".tar.gz", ".tgz", ".tar")):
        yield path.rsplit("/", 1)[-1], _stream(content)
    elif not path.endswith(".zip"):
        with tarfile.open(fileobj=_stream(content)) as tar:
            for member in tar:
                if member.isfile():
                    yield member.name, tar.extractfile(member)
    else:
        with zipfile.ZipFile(_stream(content)) as archive:
            for info in archive.infolist():
                if not info.is_dir():
                    yield info.filename, archive.open(info)


#: A zip archive of over this many bytes is handed out member by member.
SPREAD_FROM = 32 << 20


class _Inflated(io.RawIOBase):
    """A member of a zip archive from its bytes there: stored (0) or deflated (8), held to its checksum."""

    def __init__(self, packed: bytes, method: int, crc: int):
        if method not in (0, 8):
            raise ValueError(f"a member is packed by method {method}")
        self.packed, self.inflate, self.crc, self.seen, self.at = packed, zlib.decompressobj(-15) if method else None, crc, 0, 0

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        if self.inflate is None:
            data = self.packed[self.at : self.at + len(into)]
            self.at += len(data)
        else:
            data = b""
            while not data and not self.inflate.eof:
                fed = self.inflate.unconsumed_tail or self.packed[self.at : self.at + (1 << 16)]
                if not self.inflate.unconsumed_tail:
                    self.at += len(fed)
                data = self.inflate.decompress(fed, len(into))
                if not fed and not data:
                    break
        self.seen = zlib.crc32(data, self.seen)
        if not data and self.seen != self.crc:
            raise ValueError("a member is damaged")
        into[: len(data)] = data
        return len(data)


def zip_members(files: DataFrame) -> DataFrame:
    """path, member, method, crc, packed: the members of zip archives (path, content) as they lie there, by the archive's own directory, not inflated."""

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                data = content.as_buffer()
                with zipfile.ZipFile(pa.BufferReader(data)) as archive:
                    for info in archive.infolist():
                        if info.is_dir():
                            continue
                        if info.flag_bits & 1:
                            raise ValueError(f"{info.filename} is encrypted")
                        lengths = data.slice(info.header_offset + 26, 4).to_pybytes()  # of the name and the extra field before the bytes
                        begin = info.header_offset + 30 + int.from_bytes(lengths[:2], "little") + int.from_bytes(lengths[2:], "little")
                        packed = data.slice(begin, info.compress_size).to_pybytes()
                        yield pa.RecordBatch.from_arrays([pa.array([path.as_py()]), pa.array([info.filename]), pa.array([info.compress_type], pa.int32()), pa.array([info.CRC], pa.int64()), pa.array([packed], pa.binary())],
                                                         names=["path", "member", "method", "crc", "packed"])

    return files.select("path", "content").mapInArrow(run, "path string, member string, method int, crc long, packed binary")


def _unpacked(files: DataFrame, read, schema: str) -> DataFrame:
    """read(archive, member, stream) over every member of files (path, content). Zip archives over SPREAD_FROM are taken apart first, and their
    members, still packed, dealt over tasks, which inflate and read them; any other file is one task's, its members streamed, and so is a file without
    a length (see binary_files), which a reader could not choose by."""
    one_by_one(files.sparkSession)
    spread = F.col("path").endswith(".zip") & (F.col("length") > SPREAD_FROM)

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                for name, stream in _members(path.as_py(), content.as_buffer()):
                    yield from read(path.as_py(), name, stream)

    def run_members(batches):
        for batch in batches:
            for path, name, method, crc, packed in zip(*batch.columns):
                yield from read(path.as_py(), name.as_py(), io.BufferedReader(_Inflated(packed.as_buffer().to_pybytes(), method.as_py(), crc.as_py())))

    if "length" not in files.columns:
        return files.select("path", "content").mapInArrow(run, schema)
    near = files.filter(~spread).select("path", "content").mapInArrow(run, schema)
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # said, so that packed bytes are not put together for being few
    return near.unionByName(zip_members(files.filter(spread)).repartition(tasks, "path", "member").mapInArrow(run_members, schema))


def scan_archive(files: DataFrame) -> DataFrame:
    """archive, member, number, line of every line of every member of files (path, content): zip and tar
    archives, gzip and plain files."""

    def read(path: str, name: str, stream):
        held: list[str] = []
        number = 0
        for raw in io.TextIOWrapper(stream, encoding="utf-8", errors="replace", newline="\n"):
            held.append(raw.rstrip("\r\n"))
            if len(held) == 8192:
                yield _lines(path, name, number, held)
                number, held = number + len(held), []
        if held:
            yield _lines(path, name, number, held)

    return _unpacked(files, read, "archive string, member string, number long, line string")


def scan_archive_named(files: DataFrame, wanted: list[str]) -> DataFrame:
    """Cells of the members of files (path, content) by the names in each member's first line, without case, as scan_csv_named has them, of any number of columns;
    line breaks inside quotes are part of their cell."""
    cells = _Cells(wanted)
    return _unpacked(files, lambda path, name, stream: cells.table(path, stream), ", ".join(f"`{w}` string" for w in [*wanted, OVERFLOW, FILE]))


def cells_of_lines(lines: DataFrame, names: list[str]) -> DataFrame:
    """Lines of scan_archive as cells by place, as scan_csv_positional has them."""
    wide = [f"_skip{i}" if n == "-" else n for i, n in enumerate(names)] + [OVERFLOW]
    cells = F.from_csv("line", ", ".join(f"`{n}` string" for n in wide))
    return lines.filter("line <> ''").select(cells.alias("_c"), F.col("archive").alias(FILE)).select(*[F.col("_c")[c].alias(c) for c in wide if not c.startswith("_skip")], FILE)


def _lines(path: str, name: str, number: int, held: list[str]) -> pa.RecordBatch:
    n = len(held)
    return pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array([name] * n), pa.array(range(number, number + n), pa.int64()), pa.array(held)], names=["archive", "member", "number", "line"])


_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet of a workbook, every cell as text."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            for item in ET.parse(book.open("xl/sharedStrings.xml")).getroot():
                shared.append("".join(t.text or "" for t in item.iter(f"{_NS}t")))
        sheet = min(n for n in book.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n))
        for _, element in ET.iterparse(book.open(sheet)):
            if element.tag != f"{_NS}row":
                continue
            row: list[str | None] = []
            for cell in element:
                letters = re.match(r"[A-Z]+", cell.get("r", "A"))[0]
                at = 0
                for ch in letters:
                    at = at * 26 + ord(ch) - 64
                value = cell.find(f"{_NS}v")
                text = value.text if value is not None else "".join(t.text or "" for t in cell.iter(f"{_NS}t")) or None
                if cell.get("t") == "s" and text is not None:
                    text = shared[int(text)]
                row += [None] * (at - 1 - len(row)) + [text]
            yield row
            element.clear()


def _table_rows(stream: io.BufferedReader) -> Iterator[list[str | None]]:
    """Rows of a workbook's first sheet, or of a text table: the first four bytes tell."""
    if stream.peek(4)[:4] == SHEET:
        yield from sheet_rows(stream.read())
    else:
        for row in csv.reader(io.TextIOWrapper(stream, encoding="utf-8-sig", errors="replace", newline="")):
            if row:
                yield [c if c != "" else None for c in row]


#: Endings of files that hold their tables as members; a workbook is a table although it is a zip.
PACKED = (".zip", ".tar.gz", ".tgz", ".tar", ".gz")
#: Rows of a table that are in Python at a time.
SHEET_ROWS = 8192


def scan_sheets(files: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns of the tables in files (path, content), by the names in each table's first row,
    without case. A table is the first sheet of a workbook or a text table, alone or in an archive; a
    file is one task's, its rows streamed."""
    one_by_one(files.sparkSession)

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                for _, stream in _members(path.as_py(), content.as_buffer(), single=not path.as_py().endswith(PACKED)):
                    rows = _table_rows(stream if isinstance(stream, io.BufferedReader) else io.BufferedReader(stream))
                    names = [(n or "").strip().lower() for n in next(rows, [])]
                    places = [names.index(w.lower()) if w.lower() in names else None for w in wanted]
                    while held := list(islice(rows, SHEET_ROWS)):
                        columns = [pa.array([r[p] if p is not None and p < len(r) else None for r in held], pa.string()) for p in places]
                        yield pa.RecordBatch.from_arrays([*columns, pa.array([path.as_py()] * len(held), pa.string())], names=[*wanted, FILE])

    schema = ", ".join(f"`{w}` string" for w in [*wanted, FILE])
    return files.select("path", "content").mapInArrow(run, schema)


def scan_sheet_files(spark: SparkSession, paths, wanted: list[str]) -> DataFrame:
    """scan_sheets over the files at paths. Text tables of half a split or more are read in splits, as scan_csv_named does, if no line has an odd number of quotes: then no
    cell has a line break in it. Which of the large files are such tables is found by a first pass over their lines."""
    one_by_one(spark)
    most = _split_from(spark)
    whole = F.col("path").rlike("[.](zip|tar[.]gz|tgz|tar|gz)$")
    lines = _large_lines(spark, paths, most).filter(~whole)
    broken = lines.groupBy("path").agg(F.bool_or(F.length("value") % 2 != F.length(F.replace("value", F.lit('"'))) % 2).alias("broken"))
    plain = _heads(lines).filter(~F.startswith("header", F.lit(SHEET.decode()))).join(broken.filter("NOT broken"), "path").select("path", "header")
    files = spark.read.format("binaryFile").load(paths).filter("length > 0").select(file_of().alias("path"), "content", "length")
    other = files.filter(F.col("length") > most).join(F.broadcast(plain.select("path")), "path", "left_anti")
    cells = _cells_of_splits(lines, plain, wanted).select(*[F.when(F.col(w) != "", F.col(w)).alias(w) for w in wanted], FILE)
    return scan_sheets(files.filter(F.col("length") <= most), wanted).unionByName(scan_sheets(other, wanted)).unionByName(cells)


def malformed_files(spark: SparkSession, paths) -> DataFrame:
    """Headed files whose rows have fewer cells than the header, or that are a single column: file,
    header_cells, most_cells, rows."""
    cells = F.size(F.split(F.regexp_replace("line", r'"(?:[^"]|"")*"', ""), ","))  # commas inside quotes part nothing
    rows = scan_lines(spark, paths).select(FILE, "line", cells.alias("cells"), F.monotonically_increasing_id().alias("at"))
    by = rows.groupBy(FILE).agg(F.min_by("cells", "at").alias("header_cells"), F.max("at").alias("last"), F.min("at").alias("first"), F.count("*").alias("lines"))
    most = rows.join(by.select(FILE, "first"), FILE).filter("at > first").groupBy(FILE).agg(F.max("cells").alias("most_cells"))
    return by.join(most, FILE).filter("header_cells = 1 OR most_cells < header_cells").select(FILE, "header_cells", "most_cells", (F.col("lines") - 1).alias("rows"))


def wide_rows(rows: DataFrame) -> DataFrame:
    """The files that have rows with more cells than were declared, and how many."""
    return rows.filter(F.col(OVERFLOW).isNotNull()).groupBy(FILE).agg(F.count("*").alias("wide"))


def first_offender(rows: DataFrame) -> DataFrame:
    """One row that has more cells than were declared, none if there is none: ends at the first that is found."""
    return rows.filter(F.col(OVERFLOW).isNotNull()).limit(1)


def assert_width(rows: DataFrame) -> DataFrame:
    """rows, failing as soon as one is wider than declared, with the file's name."""
    seen = F.when(F.col(OVERFLOW).isNotNull(), F.raise_error(F.concat(F.lit("a row is wider than declared in "), F.col(FILE)))).otherwise(F.lit(True))
    return rows.filter(seen).drop(OVERFLOW)


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path, length, modified of the files under root; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def drop_empty(files: DataFrame) -> DataFrame:
    """files (path, and length or content) less those without a byte; with their content at hand, also less gzip files
    that decode to nothing."""
    if "content" not in files.columns:
        return files.filter("length > 0")
    one_by_one(files.sparkSession)

    def run(batches):
        for batch in batches:
            held = [c.as_buffer() for c in batch.column("content")]
            keep = [b.size > 0 and (b.slice(0, 2).to_pybytes() != b"\x1f\x8b" or gzip.GzipFile(fileobj=_stream(b)).read(1) != b"") for b in held]
            yield batch.filter(pa.array(keep))

    return files.mapInArrow(run, files.schema)


def list_buckets(spark: SparkSession, root: str, suffix: str = ".csv.gz") -> DataFrame:
    """Raw store: table, days, first, last, bytes by table, from the names of root/table/day.suffix, or of the pieces in root/table/day/."""
    return bucket_sums(list_files(spark, root, f"*{suffix}"))


def bucket_sums(files: DataFrame) -> DataFrame:
    day = r"/([^/]+)/(\d{4}-?\d{2}-?\d{2})[^/]*(?:/part-[^/]*)?$"
    named = files.select(F.regexp_extract("path", day, 1).alias("table"), F.regexp_extract("path", day, 2).alias("day"), "length")
    return named.filter("table <> ''").groupBy("table").agg(F.countDistinct("day").alias("days"), F.min("day").alias("first"), F.max("day").alias("last"), F.sum("length").alias("bytes"))


#: Message tables with free text: quotes and line breaks inside cells.
FREE_TEXT = ("announcement", "chat", "publicNotifications")


def read_bucket(spark: SparkSession, paths, table: str) -> DataFrame:
    """A day's message rows, all strings; quoting is honoured where a table has free text."""
    reader = spark.read.options(header=True, inferSchema=False)
    return reader.options(multiLine=True, escape='"').csv(paths) if table in FREE_TEXT else reader.options(quote="").csv(paths)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """A pipe-separated log, columns by its heading, with `line`, by which its rows are in the order of their
    writing: the time that append_ledger stamped on them, then their place."""
    rows = spark.read.options(sep="|", header=True).csv(path)
    return rows.withColumn("line", F.struct(F.col("at").cast("long").alias("at"), F.monotonically_increasing_id().alias("n"))).drop("at")


def read_table(spark: SparkSession, root: str, table: str, **filters) -> DataFrame:
    """A canonical table, filtered by path levels (pruned) and by in-file columns such as symbol."""
    rows = spark.read.parquet(f"{root}/{table}")
    for name, value in filters.items():
        rows = rows.filter(F.col(name).isin(value) if isinstance(value, (list, tuple, set)) else F.col(name) == value)
    return rows

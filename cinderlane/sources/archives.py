"""Readers whose rows come from a stream and never from a whole file: tar members, numbered lines, SQLite tables, and the
growing end of a log.

They are data sources in Python: the driver lists what there is (names and offsets, no contents), and each task opens
the file system itself and reads its own part. register() makes them known to a session.
"""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

#: Bytes of members that one task reads, and rows of a table that it reads.
PART_BYTES, PART_ROWS = 64 << 20, 100_000


def _files(path: str, suffixes: tuple[str, ...] = ()) -> list:
    """(file system, path, size) of a file or of all files below a folder, in order of path."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner, recursive=True))
    files = [(x.path, x.size) for x in found if x.type == fs.FileType.File and (not suffixes or x.path.endswith(suffixes))]
    return [(system, p, n) for p, n in sorted(files)]


def _open(path: str, uri: str):
    """A seekable file of the file system that the source's path names."""
    from pyarrow import fs

    system = fs.FileSystem.from_uri(uri)[0] if "://" in uri or uri.startswith("file:") else fs.LocalFileSystem()
    return system.open_input_file(path)


@dataclass
class _Part(InputPartition):
    path: str
    items: tuple = ()


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.uri, self.options = options["path"], options


class TarReader(_Reader):
    def partitions(self):
        """Members in parts of about PART_BYTES: headers are read, contents are skipped."""
        most, out = int(self.options.get("partBytes", PART_BYTES)), []
        for _, path, _ in _files(self.uri, (".tar",)):
            now, size = [], 0
            with _open(path, self.uri) as f, tarfile.open(fileobj=f, mode="r:") as t:
                for m in t:
                    if m.isfile():
                        now.append((m.name, m.offset_data, m.size))
                        size += m.size
                        if size >= most:
                            out.append(_Part(path, tuple(now)))
                            now, size = [], 0
            if now:
                out.append(_Part(path, tuple(now)))
        return out or [_Part("")]

    def read(self, partition) -> Iterator[tuple]:
        if partition.items:
            with _open(partition.path, self.uri) as f:
                for name, at, size in partition.items:
                    f.seek(at)
                    yield partition.path, name, size, f.read(size)


class TarSource(DataSource):
    """Uncompressed tar archives: archive, member, size, content; a member is a row, wherever it stands in its archive."""

    @classmethod
    def name(cls):
        return "tar"

    def schema(self):
        return "archive string, member string, size long, content binary"

    def reader(self, schema):
        return TarReader(self.options)


def _lines(f, path: str) -> Iterator[str]:
    """Text lines of a plain, gzip or zstd stream, each by itself, frame after frame."""
    import gzip

    import zstandard

    raw = gzip.GzipFile(fileobj=f) if path.endswith(".gz") else zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True) if path.endswith(".zst") else f
    for line in io.TextIOWrapper(io.BufferedReader(raw, 1 << 20) if path.endswith(".zst") else raw, encoding="utf-8", errors="replace", newline="\n"):
        yield line.rstrip("\n")


class LinesReader(_Reader):
    def partitions(self):
        return [_Part(p) for _, p, _ in _files(self.uri)] or [_Part("")]

    def read(self, partition) -> Iterator[tuple]:
        if partition.path:
            with _open(partition.path, self.uri) as f:
                for n, line in enumerate(_lines(f, partition.path)):
                    yield partition.path, n, line


class LinesSource(DataSource):
    """Lines of text files, plain, .gz or .zst: path, n (from 0), line. Numbers need the file's order, so a file is one
    task; it is read as a stream, so its size doesn't matter."""

    @classmethod
    def name(cls):
        return "numbered_lines"

    def schema(self):
        return "path string, n long, line string"

    def reader(self, schema):
        return LinesReader(self.options)


class SqliteReader(_Reader):
    def __init__(self, options: dict, schema):
        super().__init__(options)
        self.columns = [x.name for x in schema.fields]

    def _rows(self, sql: str, values: tuple = ()):
        import sqlite3
        from contextlib import closing

        with closing(sqlite3.connect(f"file:{self.uri.removeprefix('file://')}?mode=ro&immutable=1", uri=True)) as db:
            yield from db.execute(sql, values)

    def _table(self) -> str:
        return '"' + self.options["table"].replace('"', '""') + '"'

    def partitions(self):
        ((low, high),) = self._rows(f"SELECT min(rowid), max(rowid) FROM {self._table()}")
        step = int(self.options.get("partRows", PART_ROWS))
        return [_Part(self.uri, (a, a + step)) for a in range(low, high + 1, step)] if low is not None else [_Part("")]

    def read(self, partition) -> Iterator[tuple]:
        if partition.items:
            names = ", ".join('"' + c.replace('"', '""') + '"' for c in self.columns)
            yield from self._rows(f"SELECT {names} FROM {self._table()} WHERE rowid >= ? AND rowid < ? ORDER BY rowid", partition.items)


class SqliteSource(DataSource):
    """A table of a SQLite file, opened for reading only, by ranges of row numbers: the columns of the schema given, which
    has to fit the stored types. The file has to be on a path that every machine can open, and must not change."""

    @classmethod
    def name(cls):
        return "sqlite"

    def schema(self):
        raise ValueError("a schema has to be given")

    def reader(self, schema):
        return SqliteReader(self.options, schema)


class TailReader(DataSourceStreamReader):
    """Whole lines of log files by byte offset; what follows the last line end waits for its rest."""

    def __init__(self, options: dict):
        self.uri, self.most = options["path"], int(options.get("partBytes", PART_BYTES))

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        out = {}
        for _, path, size in _files(self.uri):
            with _open(path, self.uri) as f:
                at = size
                while at > 0:
                    lo = max(0, at - (1 << 16))
                    f.seek(lo)
                    end = f.read(at - lo).rfind(b"\n")
                    if end >= 0:
                        out[path] = lo + end + 1
                        break
                    at = lo
        return out

    def partitions(self, start: dict, end: dict):
        """Byte ranges; a task reads the lines that begin in its range."""
        cuts = [(p, a, min(a + self.most, stop), start.get(p, 0), stop) for p, stop in sorted(end.items()) for a in range(start.get(p, 0), stop, self.most)]
        return [_Part(c[0], c[1:]) for c in cuts] or [_Part("")]

    def read(self, partition) -> Iterator[tuple]:
        if not partition.items:
            return
        low, high, first, stop = partition.items
        with _open(partition.path, self.uri) as f:
            at = low
            if low > first:  # the line before is another task's, unless it ended just here
                f.seek(low - 1)
                at = low - 1 + len(_until_line_end(f))
            f.seek(at)
            while at < high and at < stop:
                line = _until_line_end(f)
                yield partition.path, at, line.rstrip(b"\n").decode("utf-8", "replace")
                at += len(line)


def _until_line_end(f) -> bytes:
    """The bytes up to and with the next line end; leaves the file behind it."""
    start, out = f.tell(), b""
    while block := f.read(1 << 14):
        end = block.find(b"\n")
        if end >= 0:
            out += block[: end + 1]
            break
        out += block
    f.seek(start + len(out))
    return out


class TailSource(DataSource):
    """A stream of the lines of growing files: path, offset (of the line's first byte), line."""

    @classmethod
    def name(cls):
        return "tail"

    def schema(self):
        return "path string, offset long, line string"

    def streamReader(self, schema):
        return TailReader(self.options)


def register(spark: SparkSession) -> SparkSession:
    for source in (TarSource, LinesSource, SqliteSource, TailSource):
        spark.dataSource.register(source)
    return spark


def tar_members(spark: SparkSession, path: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """archive, member, size, sha256 and content of the members of tar archives."""
    rows = register(spark).read.format("tar").option("partBytes", part_bytes).load(path)
    return rows.withColumn("sha256", F.sha2("content", 256))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    return register(spark).read.format("numbered_lines").load(path)


def sqlite_table(spark: SparkSession, path: str, table: str, schema: str, part_rows: int = PART_ROWS) -> DataFrame:
    return register(spark).read.format("sqlite").schema(schema).option("table", table).option("partRows", part_rows).load(path)


def catalogue_check(members: DataFrame, catalogue: DataFrame, name: str = "member") -> DataFrame:
    """(name, problem) of members (name, size, sha256) that aren't as the catalogue (name, size, sha256) says: missing,
    unlisted, repeated (several members of the name), listed_twice, size_differs, digest_differs."""
    side = lambda d, c: d.groupBy(name).agg(F.count(F.lit(1)).alias(f"_n{c}"), F.min(F.struct("size", "sha256")).alias(c))
    both = side(members, "_m").join(side(catalogue, "_c"), name, "full")
    problem = (
        F.when(F.col("_m").isNull(), "missing").when(F.col("_c").isNull(), "unlisted").when(F.col("_n_m") > 1, "repeated").when(F.col("_n_c") > 1, "listed_twice")
        .when(~F.col("_m.size").eqNullSafe(F.col("_c.size")), "size_differs").when(~F.col("_m.sha256").eqNullSafe(F.col("_c.sha256")), "digest_differs")
    )
    return both.select(name, problem.alias("problem")).filter("problem IS NOT NULL")

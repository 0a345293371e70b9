"""Observation files as a Spark data source (``station_text``), read in byte ranges.

Every range of a file is a partition, so a file of any length is read by many
tasks. A task reads the first line of the file for its column names, cuts the
lines of its range into fields as Arrow arrays and returns only the columns
asked for. No file needs the layout of another one, and no rows are joined by file.

Options: ``path`` (JSON list of files, folders or patterns, in any file system that Arrow opens),
``columns`` (JSON list, the first two being station and time stamp), ``sep``, ``range_bytes``.
Each line that is no header and not blank gives a row:

* file_path, file_name, place (byte of the file at which the line begins)
* year: of the time stamp, NULL if that is no number
* rejected: the line has more fields than the header of its file; its columns are NULL
* the columns, trimmed; NULL if empty, or if the line or the file has no such field

Columns are found by name in the header, whatever its case and padding. A file
whose first line is no header holds ``columns`` in order; header lines further down are skipped.
With ``spark.sql.python.filterPushdown.enabled``, conditions on ``year`` are applied before lines are cut up.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds

# The source travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
RANGE_BYTES = 64 << 20
#: Bytes read at once within a range; the longest header line.
BLOCK_BYTES = 4 << 20
HEADER_BYTES = 1 << 16
FACTS = "file_path string, file_name string, place bigint, year int, rejected boolean"
#: Files whose first lines one task reads.
HEADERS = 256
STAMP = 12  # digits of a time stamp, the first four are the year


@dataclass
class Files(ds.InputPartition):
    uris: list[str]


@dataclass
class Range(ds.InputPartition):
    path: str
    uri: str
    start: int
    stop: int


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path within it; ``file:/x`` and plain paths are local."""
    for plain in ("file://", "file:"):
        if path.startswith(plain):
            path = path[len(plain) :]
    if ":/" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def list_files(pattern: str) -> list[tuple[str, str, int]]:
    """(path, address, size) of the files that a pattern, folder or file name stands for, by path."""
    fixed = pattern
    while any(c in fixed for c in "*?["):
        fixed = fixed.rsplit("/", 1)[0]
    store, root = _open(fixed)
    about = store.get_file_info(root)
    if about.type == fs.FileType.File:
        found = [about]
    else:
        found = store.get_file_info(fs.FileSelector(root, recursive=True))
    wanted = _open(pattern)[1] if fixed != pattern else None
    head = fixed[: len(fixed) - len(root)] if fixed.endswith(root) else ""
    out = []
    for info in found:
        if info.type != fs.FileType.File or info.base_name.startswith((".", "_")):
            continue
        if wanted is None or fnmatch(info.path, wanted) or fnmatch(info.path, wanted + "/*"):
            out.append((info.path, head + info.path, info.size))
    return sorted(out)


#: What surrounds a field; other white space is content.
PADDING = " \r"


def _header(file: pa.NativeFile, sep: str) -> list[str]:
    """Fields of the first line that is not blank."""
    head = file.read_at(min(HEADER_BYTES, file.size()), 0).decode("latin-1")
    first = next((x for x in head.split("\n") if x.strip(PADDING)), "")
    return [f.strip(PADDING) for f in first.split(sep)]


def _trimmed(text: pa.Array) -> pa.Array:
    return pc.utf8_trim(text, characters=PADDING)


class Years:
    """Bounds and lists that conditions on ``year`` set."""

    def __init__(self):
        self.tests: list[tuple[str, object]] = []

    def take(self, condition: ds.Filter) -> None:
        name = type(condition).__name__
        if getattr(condition, "attribute", None) == ("year",) and name in ("EqualTo", "In", "GreaterThan", "GreaterThanOrEqual", "LessThan", "LessThanOrEqual"):
            self.tests.append((name, condition.value))

    def keep(self, year: pa.Array) -> pa.Array | None:
        """Which rows pass all conditions; None if there are none."""
        out = None
        for name, value in self.tests:
            if name == "In":
                own = pc.is_in(year, pa.array(list(value), pa.int32()))
            else:
                test = {"EqualTo": pc.equal, "GreaterThan": pc.greater, "GreaterThanOrEqual": pc.greater_equal, "LessThan": pc.less, "LessThanOrEqual": pc.less_equal}[name]
                own = pc.fill_null(test(year, value), False)
            out = own if out is None else pc.and_(out, own)
        return out


class Reader(ds.DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.patterns = json.loads(options["path"])
        self.columns = json.loads(options["columns"])
        self.sep = options.get("sep", ";")
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))
        self.years = Years()

    def partitions(self) -> list[Range]:
        files = {path: (uri, size) for pattern in self.patterns for path, uri, size in list_files(pattern)}
        return [Range(path, uri, at, min(at + self.range_bytes, size)) for path, (uri, size) in sorted(files.items()) for at in range(0, size, self.range_bytes)] or [Range("", "", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        store, path = _open(partition.uri)
        with store.open_input_file(path) as file:
            header = _header(file, self.sep)
            names = [n.upper() for n in header] if header[0].upper() == self.columns[0].upper() else [c.upper() for c in self.columns]
            for place, lines in self._lines(file, partition):
                batch = self._rows(partition, names, place, lines)
                if batch.num_rows:
                    yield batch

    def _lines(self, file, partition: Range) -> Iterator[tuple[int, list[str]]]:
        """Lines that begin within the range, some at a time, with the byte at which the first one begins."""
        at, rest, size = partition.start, b"", file.size()
        if at:  # the line that the range before began
            at -= 1
            while True:
                block = file.read_at(min(BLOCK_BYTES, size - at), at)
                cut = block.find(b"\n")
                if cut >= 0 or not block:
                    at += cut + 1 if block else 0
                    break
                at += len(block)
        place = at
        while at < size and (at < partition.stop or rest):
            block = file.read_at(min(BLOCK_BYTES, max(partition.stop - at, HEADER_BYTES), size - at), at)
            at += len(block)
            data = rest + block
            if at >= partition.stop:  # to the end of the line that holds the last byte of the range
                last = max(partition.stop - 1 - place, 0)
                cut = data.find(b"\n", last) + 1
                if not cut and at < size:
                    rest = data
                    continue
                data, rest = data[: cut or len(data)], b""
                if place < partition.stop:
                    yield place, data.decode("latin-1").split("\n")
                return
            cut = data.rfind(b"\n") + 1
            rest = data[cut:]
            if cut:
                yield place, data[: cut - 1].decode("latin-1").split("\n")
                place += cut
        if rest and place < partition.stop:
            yield place, rest.decode("latin-1").split("\n")

    def _rows(self, partition: Range, names: list[str], place: int, lines: list[str]) -> pa.RecordBatch:
        size = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines)) + 1
        text = pa.array(lines, pa.string())
        places = pa.array(place + np.cumsum(size) - size)
        parts = pc.split_pattern(text, self.sep)
        field = lambda parts, i: _trimmed(pc.list_element(parts, i))
        keep = pc.and_(pc.not_equal(_trimmed(text), ""), pc.not_equal(pc.utf8_upper(field(parts, 0)), self.columns[0].upper()))
        parts, places = parts.filter(keep), places.filter(keep)

        year = self._year(parts, names)
        wanted = self.years.keep(year)
        if wanted is not None:
            parts, places, year = parts.filter(wanted), places.filter(wanted), year.filter(wanted)
        count = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        begin = np.cumsum(count) - count
        values = parts.flatten()
        rejected = count > len(names)
        columns = [pa.array([partition.uri] * len(parts), pa.string()), pa.array([partition.path.rsplit("/", 1)[-1]] * len(parts), pa.string()), places, year, pa.array(rejected)]
        for c in self.columns:
            i = names.index(c.upper()) if c.upper() in names else None
            if i is None:
                columns.append(pa.nulls(len(parts), pa.string()))
                continue
            there = (count > i) & ~rejected
            own = _trimmed(values.take(pa.array(begin + i, mask=~there)))
            columns.append(pc.if_else(pc.equal(own, ""), pa.scalar(None, pa.string()), own))
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), *[pa.string()] * len(self.columns)]
        labels = ["file_path", "file_name", "place", "year", "rejected", *self.columns]
        return pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(columns, kinds, strict=True)], labels)

    def _year(self, parts: pa.Array, names: list[str]) -> pa.Array:
        """First four digits of the time stamp, which may have lost leading zeros."""
        stamp = self.columns[1].upper()
        if stamp not in names:
            return pa.nulls(len(parts), pa.int32())
        i = names.index(stamp)
        count = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        begin = np.cumsum(count) - count
        text = _trimmed(parts.flatten().take(pa.array(begin + i, mask=count <= i)))
        good = pc.fill_null(pc.match_substring_regex(text, f"^[0-9]{{1,{STAMP}}}$"), False)
        padded = pc.utf8_lpad(pc.if_else(good, text, pa.scalar(None, pa.string())), STAMP, "0")
        return pc.utf8_slice_codeunits(padded, 0, 4).cast(pa.int32())


class HeaderReader(ds.DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.patterns, self.sep = json.loads(options["path"]), options.get("sep", ";")

    def partitions(self) -> list[Files]:
        uris = sorted({uri for pattern in self.patterns for _, uri, _ in list_files(pattern)})
        return [Files(uris[at : at + HEADERS]) for at in range(0, max(len(uris), 1), HEADERS)]

    def read(self, partition: Files) -> Iterator[tuple[str, list[str]]]:
        for uri in partition.uris:
            store, path = _open(uri)
            with store.open_input_file(path) as file:
                yield uri, _header(file, self.sep)


class PushingReader(Reader):
    """Spark checks every condition again, so the rows it gets are a superset."""

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:  # noqa: N802
        for condition in filters:
            self.years.take(condition)
            yield condition


class StationText(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return "station_text"

    def schema(self) -> str:
        if "headers" in self.options:
            return "file_path string, header array<string>"
        columns = json.loads(self.options["columns"])
        return ", ".join([FACTS, *[f"`{c}` string" for c in columns]])

    def reader(self, schema) -> ds.DataSourceReader:
        if "headers" in self.options:
            return HeaderReader(dict(self.options))
        return (PushingReader if self.options.get("pushdown") == "true" else Reader)(dict(self.options))


def scan(spark: SparkSession, path: str | list[str], columns: list[str], sep: str = ";", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All lines of the files, rejected ones too."""
    spark.dataSource.register(StationText)
    paths = [path] if isinstance(path, str) else list(path)
    pushdown = spark.conf.get(PUSHDOWN, "false").lower()
    options = {"path": json.dumps(paths), "columns": json.dumps(list(columns)), "sep": sep, "range_bytes": str(range_bytes), "pushdown": pushdown}
    return spark.read.format("station_text").options(**options).load()


def headers(spark: SparkSession, path: str | list[str], sep: str = ";") -> DataFrame:
    """(file_path, header) of every file, without reading further than its first line."""
    spark.dataSource.register(StationText)
    paths = [path] if isinstance(path, str) else list(path)
    options = {"path": json.dumps(paths), "columns": "[]", "sep": sep, "headers": "true"}
    return spark.read.format("station_text").options(**options).load()

"""Inventories over many files: type by first bytes, and binary headers.

Tasks list folders and read the first bytes of each file; nothing is listed on the driver.
"""

from __future__ import annotations

import fnmatch
import os
import re
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridsteps.model import METADATA

# File signatures and the header name of unsupported restart files.
GRID_MAGIC = b"LPJ"
RESTART_NAME = "LPJRESTART"
CDF_MAGIC = (b"CDF", b"\x89HDF\r\n\x1a\n")
PROBE_BYTES = 10
# A name of at most 30 bytes and 13 four-byte words.
HEADER_BYTES = 30 + 13 * 4

# Header words that follow the version word, in file order; f is a
# four-byte float, i a four-byte integer.
BASE_WORDS = [("order", "i"), ("firstyear", "i"), ("nyear", "i"), ("firstcell", "i"),
              ("ncell", "i"), ("nbands", "i")]
EXTRA_WORDS = {
    1: [],
    2: [("cellsize_lon", "f"), ("scalar", "f")],
    3: [("cellsize_lon", "f"), ("scalar", "f"), ("cellsize_lat", "f"), ("datatype", "i")],
    4: [("cellsize_lon", "f"), ("scalar", "f"), ("cellsize_lat", "f"), ("datatype", "i"),
        ("nstep", "i"), ("timestep", "i")],
}
# What a header without the word means.
WORD_DEFAULTS = {"cellsize_lon": 0.5, "scalar": 1.0, "datatype": 1, "nstep": 1, "timestep": 1}

HEADER_SCHEMA = (
    "path string, length bigint, name string, version int, endian string, `order` int, "
    "firstyear int, nyear int, lastyear int, firstcell int, ncell int, nbands int, "
    "cellsize_lon double, scalar double, cellsize_lat double, datatype int, nstep int, "
    "timestep int, header_bytes int, error string"
)


def open_path(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path inside it, for any URI that Spark lists."""
    if "://" not in path:
        return pafs.LocalFileSystem(), re.sub(r"^file:", "", path)
    return pafs.FileSystem.from_uri(path)


def read_head(path: str, n: int) -> bytes:
    system, inner = open_path(path)
    with system.open_input_file(inner) as f:
        return f.read(n)


def classify(head: bytes) -> str:
    """Type of a file from its first ten bytes."""
    if head.startswith(GRID_MAGIC):
        return "clm"
    if head.startswith(CDF_MAGIC):
        return "cdf"
    if re.fullmatch(rb"[\x20-\x7e\r\n\t]*", head):
        return "meta" if head.lstrip().startswith(b"{") else "text"
    return "raw"


def parse_header(head: bytes, force_version: int | None = None) -> dict:
    """Fields of one header; raises ValueError for what is not a grid header."""
    name = re.match(rb"\w{0,30}", head).group().decode("ascii")
    if not name.startswith(GRID_MAGIC.decode()):
        raise ValueError(f"invalid header name {name!r}")
    if name == RESTART_NAME:
        raise ValueError("restart headers are not supported")
    body = head[len(name):]
    if len(body) < 28:
        raise ValueError("header is cut short")
    # A version is a small number, so its lowest byte is zero only when swapped.
    swapped = body[0] == 0
    mark = ">" if swapped else "<"
    version = struct.unpack(mark + "i", body[:4])[0]
    if force_version is not None:
        version = force_version
    # Versions outside 1..4 still show the words that all headers share.
    words = BASE_WORDS + EXTRA_WORDS.get(version, EXTRA_WORDS[3] if version > 4 else [])
    layout = mark + "".join(kind for _, kind in words)
    if len(body) < 4 + struct.calcsize(layout):
        raise ValueError("header is cut short")
    fields = dict(zip([w for w, _ in words], struct.unpack(layout, body[4:4 + struct.calcsize(layout)])))
    for word, value in WORD_DEFAULTS.items():
        fields.setdefault(word, value)
    fields.setdefault("cellsize_lat", fields["cellsize_lon"])
    fields.update(
        name=name, version=version, endian="big" if swapped else "little",
        lastyear=fields["firstyear"] + fields["nyear"] - 1, error=None, header_bytes=None)
    if version in EXTRA_WORDS:
        fields["header_bytes"] = len(name) + struct.calcsize(layout) + 4
    else:
        fields["error"] = f"header version {version} is not between 1 and 4"
    return fields


# Levels of folders that are dealt out again before a task goes down by itself, and rows in a batch.
DEALT_LEVELS, LISTED_ROWS = 3, 4096


def _entries(system: pafs.FileSystem, folder: str) -> Iterator[tuple[str, int | None]]:
    """(path, length) of what one folder holds; a folder has no length. Local folders are read bit by bit."""
    if isinstance(system, pafs.LocalFileSystem):
        with os.scandir(folder) as found:
            for e in found:
                if e.is_dir() or e.is_file():
                    yield e.path, None if e.is_dir() else e.stat().st_size
    else:
        for f in system.get_file_info(pafs.FileSelector(folder)):
            yield f.path, f.size if f.type == pafs.FileType.File else None


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, length) of all files below a path; contents stay unread.

    Folders of the upper levels are listed one by one and dealt out to tasks, which
    go down the rest folder by folder; rows leave in batches of bounded size, so no task
    holds a whole listing. Empty files count; names that begin with a dot or an
    underscore do not, nor does what is below them.
    """
    schema = "path string, length bigint"

    def batch(rows: list[tuple[str, int | None]]) -> pa.RecordBatch:
        names, sizes = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], names=["path", "length"])

    def batches_of(rows: Iterator[tuple[str, int | None]]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, int | None]] = []
        for row in rows:
            held.append(row)
            if len(held) == LISTED_ROWS:
                yield batch(held)
                held = []
        if held:
            yield batch(held)

    def below(name: str, deep: bool) -> Iterator[tuple[str, int | None]]:
        """What a folder holds, or, going deep, all files below it."""
        system, inner = open_path(name)
        prefix = name[:len(name) - len(inner)] if "://" in name else ""
        folders = [inner]
        while folders:
            for found, size in _entries(system, folders.pop()):
                if found.rsplit("/", 1)[-1].startswith((".", "_")):
                    continue
                if size is None and deep:
                    folders.append(found)
                else:
                    yield prefix + found, size

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in batches:
            for name in own.column(0).to_pylist():
                system, inner = open_path(name)
                found = system.get_file_info(inner)
                if found.type == pafs.FileType.NotFound:
                    raise FileNotFoundError(name)
                yield batch([(name.rstrip("/"), found.size if found.type == pafs.FileType.File else None)])

    def level(deep: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for own in batches:
                yield from batches_of(
                    row for name, size in zip(*(c.to_pylist() for c in own.columns))
                    for row in (below(name, deep) if size is None else [(name, size)]))
        return run

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = spark.range(1).select(F.lit(path).alias("path")).coalesce(1).mapInArrow(start, schema)
    for k in range(DEALT_LEVELS):
        listed = listed.mapInArrow(level(k == DEALT_LEVELS - 1), schema).repartition(tasks, "path")
    pattern = re.compile(fnmatch.translate(glob)).pattern
    return listed.filter(F.regexp_extract("path", r"([^/]*)$", 1).rlike(f"^{_java(pattern)}"))


def _java(pattern: str) -> str:
    """The body of a translated file name pattern, without marks that only Python knows."""
    return re.sub(r"\(\?s:(.*)\)\\[Zz]$", r"(?s:\1)$", pattern)


def _probe(files: DataFrame, schema: str, row: Callable[[str, int], dict]) -> DataFrame:
    """One output row per listed file, computed in tasks."""
    types = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}
    fields = [part.rsplit(" ", 1) for part in schema.split(", ")]
    arrow = pa.schema([(name.strip("`"), types[kind]) for name, kind in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [{"path": f["path"], "length": f["length"], **row(f["path"], f["length"])}
                    for f in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return files.mapInArrow(run, schema)


def inventory_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, length, io_type): clm, cdf, meta, text or raw; an empty file is text."""
    def kind(name: str, length: int) -> dict:
        return {"io_type": classify(read_head(name, PROBE_BYTES) if length else b"")}

    return _probe(list_files(spark, path, glob), "path string, length bigint, io_type string", kind)


def header_catalog(spark: SparkSession, path: str, glob: str = "*",
                   force_version: int | None = None) -> DataFrame:
    """One row of header fields per file; what cannot be read fills ``error``."""
    def fields(name: str, length: int) -> dict:
        try:
            return parse_header(read_head(name, HEADER_BYTES), force_version)
        except ValueError as e:
            return {"error": str(e)}

    return _probe(list_files(spark, path, glob), HEADER_SCHEMA, fields)


def header_metadata(headers: DataFrame) -> DataFrame:
    """Header rows in the shape of the metadata table; names are not in a header."""
    known = headers.filter(F.col("error").isNull()).withColumn("variable", F.col("name"))
    fields = [f for f in METADATA.fields if f.name in known.columns and f.name != "name"]
    return known.select(
        "path", *(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields),
        F.lit(None).cast("array<string>").alias("band_names"))

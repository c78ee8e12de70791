"""Flat binary grid files as a Spark data source, both ways.

A file holds numbers only, ordered by year, band, cell, after an optional
header. Reading skips files and element ranges that a filter on variable, year,
band or cell rules out, and deals the rest out in even shares, so one large file
is read by many tasks.

A write makes two kinds of files, element blocks of every (variable, year) and a
sidecar per variable, under names of their own; its commit publishes a version
that names them (see ``versions``). Readers take layouts from the sidecars and only
files that the newest version names, so neither files of failed attempts nor blocks
of another size that an earlier write left are ever read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, Filter, InputPartition, WriterCommitMessage)

from gridsteps.model import MISSING_INT
from gridsteps.sources import versions
from gridsteps.sources.files import HEADER_BYTES, list_files, open_path, parse_header, read_head
from gridsteps.sources.metadata import load_metadata
from gridsteps.sources.selection import Selection, shares

# Storage of each type code or word, unsigned for bytes.
NUMPY_TYPES = {"0": "u1", "1": "i2", "2": "i4", "3": "f4", "4": "f8",
               "byte": "u1", "short": "i2", "int": "i4", "float": "f4", "double": "f8"}
# Order words and codes of the year, band, cell layout.
ORDERS = {"1", "cellyear"}

READ_ELEMENTS = 4_000_000
BATCH_ELEMENTS = 100_000
WRITE_ELEMENTS = 4_000_000

READ_SCHEMA = "variable string, cell bigint, band int, year int, raw double, value double"


def storage_type(datatype: str, bigendian: bool) -> np.dtype:
    word = str(datatype).lower()
    if word not in NUMPY_TYPES:
        raise ValueError(f"unknown value type {datatype!r}")
    return np.dtype(NUMPY_TYPES[word]).newbyteorder(">" if bigendian else "<")


def layout_of(path: str, size: int, o: dict) -> dict:
    """Where each element of one file belongs, from the options and its header."""
    variable = o.get("variable") or path.rsplit("/", 1)[-1].split(".")[0]
    layout = {"variable": variable, "offset": int(o.get("offset", 0)),
              "firstyear": int(o.get("firstyear", 0)), "firstcell": int(o.get("firstcell", 0)),
              "nbands": int(o.get("nbands", 1)), "scalar": float(o.get("scalar", 1.0)),
              "datatype": o.get("datatype", "short"), "order": str(o.get("order", "cellyear")),
              "bigendian": str(o.get("bigendian", "false")).lower() == "true"}
    layout["ncell"] = int(o["ncell"]) if "ncell" in o else None
    layout["base"] = 0
    if str(o.get("header", "false")).lower() == "true":
        head = parse_header(read_head(path, HEADER_BYTES))
        if head["error"]:
            raise ValueError(f"{path}: {head['error']}")
        layout.update(
            {k: head[k] for k in ("firstyear", "firstcell", "ncell", "nbands", "scalar")},
            offset=head["header_bytes"], datatype=str(head["datatype"]),
            order=str(head["order"]), bigendian=head["endian"] == "big")
        if "variable" not in o:
            layout["variable"] = head["name"]
    if layout["order"] not in ORDERS:
        raise ValueError(f"{path}: order {layout['order']} is not year, band, cell")
    width = storage_type(layout["datatype"], layout["bigendian"]).itemsize
    elements, rest = divmod(size - layout["offset"], width)
    if layout["ncell"] is None:
        layout["ncell"] = elements // layout["nbands"]
    per_year = layout["ncell"] * layout["nbands"]
    if rest or not per_year or elements % per_year:
        raise ValueError(f"{path}: {size} bytes do not hold whole years of {per_year} values")
    layout["elements"] = elements
    return layout


def _elements(path: str, ranges: list[tuple[int, int]], lay: dict, selection: Selection) -> Iterator[pa.RecordBatch]:
    """Elements of one file in some ranges as rows, without those that the selection leaves out."""
    if not ranges:
        return
    dtype = storage_type(lay["datatype"], lay["bigendian"])
    system, inner = open_path(path)
    with system.open_input_file(inner) as f:
        for start, count in ranges:
            f.seek(lay["offset"] + start * dtype.itemsize)
            for at in range(start, start + count, BATCH_ELEMENTS):
                n = min(BATCH_ELEMENTS, start + count - at)
                raw = np.frombuffer(f.read(n * dtype.itemsize), dtype=dtype).astype("f8")
                slot, cell = np.divmod(np.arange(at, at + n, dtype="i8") + lay["base"], lay["ncell"])
                year, band = np.divmod(slot, lay["nbands"])
                axes = {"cell": cell + lay["firstcell"], "band": band.astype("i4"), "year": (year + lay["firstyear"]).astype("i4")}
                keep = selection.mask(axes)
                if keep is not None:
                    raw, axes = raw[keep], {k: v[keep] for k, v in axes.items()}
                if raw.size:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lay["variable"]] * raw.size, pa.string()), *map(pa.array, axes.values()),
                         pa.array(raw), pa.array(raw * lay["scalar"])],
                        names=["variable", "cell", "band", "year", "raw", "value"])


@dataclass
class WrittenPart(WriterCommitMessage):
    """What one task wrote: its list of blocks, summed up, and sidecars."""

    part: dict | None
    years: dict[str, list[int]]
    sidecars: dict[str, str]


class FlatGridWriter(DataSourceArrowWriter):
    """Every task writes its blocks and sidecars under names of the attempt; the commit names the valid ones.

    Rows come by variable, year and block. The first of a block has no cell and carries
    the sidecar of its variable, which holds the layout; one row per variable has no
    block either and stands for the sidecar itself.
    """

    def __init__(self, options: dict, overwrite: bool):
        self.options, self.overwrite, self.write_id = options, overwrite, uuid.uuid4().hex[:12]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        o = self.options
        block = int(o.get("blockelements", WRITE_ELEMENTS))
        system, root = open_path(o["path"])
        root = root.rstrip("/")
        attempt = f"{self.write_id}-{uuid.uuid4().hex[:12]}"
        current, data, taken, lay, texts = None, None, None, None, {}
        entries: list[dict] = []
        sidecars: dict[str, str] = {}

        def put(name: str, content: bytes) -> None:
            system.create_dir(f"{root}/{name}".rsplit("/", 1)[0], recursive=True)
            with system.open_output_stream(f"{root}/{name}") as out:
                out.write(content)

        def flush() -> None:
            if current is None:
                return
            variable, year, b = current
            dtype = lay["dtype"]
            fill = float(o["fill"]) if "fill" in o else np.nan if dtype.kind == "f" else MISSING_INT
            limits = np.iinfo(dtype) if dtype.kind != "f" else None
            if not taken.all() and limits and not limits.min <= fill <= limits.max:
                raise ValueError(f"{variable} {year}: {dtype} has no value for what is missing; give a fill")
            name = f"{variable}/{int(year)}/{int(b):08d}-{attempt}.bin"
            put(name, np.where(taken, data, fill).astype(dtype).tobytes())
            entries.append({"variable": variable, "year": int(year), "base": int(b) * block, "elements": data.size, "file": name})

        for batch in iterator:
            frame = batch.to_pandas()
            for variable, text in frame.loc[frame["block"].isna(), ["variable", "sidecar"]].itertuples(index=False):
                sidecars[variable] = f"{versions.FOLDER}/{variable}-{attempt}.json"
                put(sidecars[variable], text.encode())
            for key, part in frame.groupby(["variable", "year", "block"], sort=False):
                if key != current:
                    flush()
                    current, text = key, part["sidecar"].iloc[0]
                    if text not in texts:
                        texts = {text: block_layout(json.loads(text))}
                    lay = texts[text]
                    size = min(block, lay["ncell"] * lay["nbands"] - int(key[2]) * block)
                    data, taken, given = np.zeros(size), np.zeros(size, bool), np.zeros(size, bool)
                part = part[part["cell"].notna()]
                place = part["band"].to_numpy("i8") * lay["ncell"] + part["cell"].to_numpy("i8") - lay["firstcell"] - int(key[2]) * block
                if given[place].any() or np.unique(place).size < place.size:
                    raise ValueError(f"{key[0]} {key[1]}: a cell and band occur more than once")
                given[place] = True
                values = part["value"].to_numpy("f8")
                seen = ~np.isnan(values)
                data[place[seen]], taken[place[seen]] = values[seen], True
        flush()
        part, years = versions.write_part(system, root, attempt, entries)
        return WrittenPart(part, years, sidecars)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        done = [m for m in messages if m is not None]
        years: dict[str, set[int]] = {}
        for m in done:
            for variable, own in m.years.items():
                years.setdefault(variable, set()).update(own)
        versions.publish(self.options["path"], {
            "id": self.write_id, "parts": [m.part for m in done if m.part],
            "sidecars": {k: v for m in done for k, v in m.sidecars.items()},
            "years": {k: sorted(v) for k, v in sorted(years.items())}}, replace=self.overwrite)


def block_layout(sidecar: dict) -> dict:
    """Layout of the blocks of a variable, from its sidecar."""
    if str(sidecar.get("order", "cellyear")) not in ORDERS:
        raise ValueError(f"{sidecar['variable']}: order {sidecar['order']} is not year, band, cell")
    return {"variable": sidecar["variable"], "offset": 0, "firstcell": int(sidecar.get("firstcell") or 0),
            "ncell": int(sidecar["ncell"]), "nbands": int(sidecar["nbands"]), "scalar": float(sidecar.get("scalar") or 1.0),
            "datatype": sidecar["datatype"], "bigendian": bool(sidecar.get("bigendian")),
            "dtype": storage_type(sidecar["datatype"], bool(sidecar.get("bigendian")))}


@dataclass
class BlockShare(InputPartition):
    """Some consecutive entries of a list of blocks that a version names."""

    version: int
    write: int
    file: str
    first: int
    count: int


@dataclass
class FileShare(InputPartition):
    """One of n shares of a file that no version names."""

    path: str
    size: int
    k: int
    n: int


class FlatGridReader(DataSourceReader):
    """Reads the newest version below a path, or, where there is none, the files that options describe.

    Planning touches the version, which holds a line per writing task, or the list of
    files; lists of blocks and headers are read in tasks. Filters on variable, year,
    band and cell are taken over whole.
    """

    def __init__(self, options: dict):
        self.options, self.selection = dict(options), Selection()
        self.version = versions.newest(self.options["path"])

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        return [f for f in filters if not self.selection.add(f)]

    def partitions(self) -> Sequence[InputPartition]:
        if self.version is None:
            return self._file_shares()
        return block_shares(self.version, self.selection) or [BlockShare(0, 0, "", 0, 0)]

    def _file_shares(self) -> Sequence[InputPartition]:
        out = []
        for path, size in versions.plain_files(self.options["path"]):
            if str(self.options.get("header", "false")).lower() != "true" or "variable" in self.options:
                name = self.options.get("variable") or path.rsplit("/", 1)[-1].split(".")[0]
                if not self.selection.takes_variable(name):
                    continue
            n = max(1, -(-size // (4 * READ_ELEMENTS)))
            out += [FileShare(path, size, k, n) for k in range(n)]
        return out or [FileShare("", 0, 0, 1)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if isinstance(partition, FileShare):
            if partition.path:
                lay = layout_of(partition.path, partition.size, self.options)
                own = shares(self.selection.ranges(lay), partition.k, partition.n)
                yield from _elements(partition.path, own, lay, self.selection)
            return
        yield from read_blocks(self.options["path"], self.version, partition, self.selection)


def block_shares(version: dict, selection: Selection, after: int = 0) -> list[BlockShare]:
    """Shares of about ``READ_ELEMENTS`` of what writes with a number above ``after`` left, if a selection may take it."""
    out = []
    for i, write in enumerate(version["writes"]):
        for part in write["parts"] if write["number"] > after else []:
            named = part["variables"] is None or any(map(selection.takes_variable, part["variables"]))
            if not named or not selection.may_take_year(part["first"], part["last"]):
                continue
            step = max(1, READ_ELEMENTS * part["blocks"] // max(1, part["elements"]))
            out += [BlockShare(version["number"], i, part["file"], low, min(step, part["blocks"] - low))
                    for low in range(0, part["blocks"], step)]
    return out


def read_blocks(path: str, version: dict, share: BlockShare, selection: Selection) -> Iterator[pa.RecordBatch]:
    """Rows of the blocks of one share that no later write of the version replaced."""
    if not share.count:
        return
    root = path.rstrip("/")
    write = version["writes"][share.write]
    later = versions.written_later(version, share.write)
    layouts: dict[str, dict] = {}
    for e in versions.read_part(root, share.file, share.first, share.count):
        variable, year = e["variable"], e["year"]
        if (variable, year) in later or not selection.takes_variable(variable) or not selection.may_take_year(year, year):
            continue
        if variable not in layouts:
            layouts[variable] = block_layout(json.loads(versions.read_text(f"{root}/{write['sidecars'][variable]}")))
        lay = layouts[variable] | {"firstyear": year, "base": e["base"], "elements": e["elements"]}
        yield from _elements(f"{root}/{e['file']}", selection.ranges(lay), lay, selection)


class FlatGridStreamReader(DataSourceStreamReader):
    """Writes to a folder as a stream: an offset is the number of a version.

    A batch holds what the versions after its start up to its end wrote, as the last of them names it, so a
    replayed batch has the same rows whatever was written since. ``startversion`` is the version that counts as read
    already; ``progress`` names a file that gets the last version whose rows are done with.
    """

    def __init__(self, options: dict):
        self.options = dict(options)

    def initialOffset(self) -> dict:
        return {"version": int(self.options.get("startversion", 0))}

    def latestOffset(self) -> dict:
        newest = versions.newest(self.options["path"])
        return {"version": newest["number"] if newest else 0}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if start["version"] >= end["version"]:
            return []
        return block_shares(versions.numbered(self.options["path"], end["version"]), Selection(), start["version"])

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        path = self.options["path"]
        yield from read_blocks(path, versions.numbered(path, partition.version), partition, Selection())

    def commit(self, end: dict) -> None:
        if "progress" in self.options:
            versions.put_text(self.options["progress"], json.dumps(end))


class FlatGridSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "flatgrid"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FlatGridReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return FlatGridWriter(dict(self.options), overwrite)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return FlatGridStreamReader(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make ``spark.read.format("flatgrid")`` known to a session, with filters pushed into it."""
    spark.dataSource.register(FlatGridSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_flat_grid(spark: SparkSession, path: str, **options) -> DataFrame:
    """What ``write_flat_grid`` and ``convert_raw`` wrote, or foreign files that options describe.

    Filters on variable, year, band and cell are pushed down: what they rule out
    is not opened or read. Missing values are as stored.
    """
    register(spark)
    return spark.read.format("flatgrid").options(**{k: str(v) for k, v in options.items()}).load(path)


def read_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """Metadata of the variables that the newest version of a folder holds, one row each."""
    version = versions.newest(path)
    if version is None:
        raise FileNotFoundError(f"no version below {path}")
    # Of several writes the last describes a variable.
    named = {v: name for w in version["writes"] for v, name in w["sidecars"].items()}
    return load_metadata(spark, [f"{path.rstrip('/')}/{name}" for name in named.values()])


def stream_flat_grid(spark: SparkSession, path: str, **options) -> DataFrame:
    """The writes to a folder as a stream of rows, each with the versions since the last batch.

    A folder without a version yet is an empty stream. See ``FlatGridStreamReader`` for options.
    """
    register(spark)
    return spark.readStream.format("flatgrid").options(**{k: str(v) for k, v in options.items()}).load(path)


def scan_flat_grid(spark: SparkSession, path: str, variables: Iterable[str] | None = None, years: Sequence[int] | None = None,
                   bands: Sequence[int] | None = None, cells: Sequence[int] | None = None, **options) -> DataFrame:
    """Values of flat files below a path; options describe the layout.

    ``blocks="true"`` reads what this library wrote, by its newest version. Other
    files are listed in tasks, which read each header once and cut element ranges; the
    ranges are then dealt out, so one large file is read by many tasks. ``variables``
    and the closed ranges of the axes limit what is read.
    """
    selection = Selection.of(variables, years, bands, cells)
    if str(options.get("blocks", "false")).lower() == "true":
        df = read_flat_grid(spark, path)
        if variables is not None:
            df = df.filter(F.col("variable").isin(*variables))
        for name, ends in (("year", years), ("band", bands), ("cell", cells)):
            if ends is not None:
                df = df.filter(F.col(name).between(*ends))
        return df
    options = {k: str(v) for k, v in options.items()}
    step = READ_ELEMENTS

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, size in zip(*(c.to_pylist() for c in batch.columns)):
                lay = layout_of(name, size, options)
                own = selection.ranges(lay)
                n = -(-sum(c for _, c in own) // step)
                rows += [(name, json.dumps(lay), [x for r in shares(own, k, n) for x in r]) for k in range(n)]
            if rows:
                path, layouts, cut = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(path), pa.array(layouts), pa.array(cut, pa.list_(pa.int64()))], names=["path", "layout", "cut"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, lay, cut in zip(*(c.to_pylist() for c in batch.columns)):
                yield from _elements(name, list(zip(cut[::2], cut[1::2])), json.loads(lay), selection)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = list_files(spark, path).select("path", "length").mapInArrow(ranges, "path string, layout string, cut array<bigint>")
    return cut.repartition(tasks, "path", "cut").mapInArrow(read, READ_SCHEMA)


def write_flat_grid(values: DataFrame, path: str, ncell: int, nbands: int, mode: str = "append", **options) -> None:
    """Write values of one layout as flat files, one folder per (variable, year), with a sidecar per variable.

    See ``write_blocks``. ``mode="append"`` replaces the (variable, year)s that the
    values hold, ``"overwrite"`` everything.
    """
    sidecar = {"ncell": int(ncell), "nbands": int(nbands), "firstcell": int(options.get("firstcell", 0)),
               "datatype": str(options.get("datatype", "float")), "order": "cellyear",
               "bigendian": str(options.get("bigendian", "false")).lower() == "true"}
    described = values.select("variable").distinct().select("variable", *(F.lit(v).alias(k) for k, v in sidecar.items()))
    layout = [F.lit(sidecar[k]).alias(k) for k in ("ncell", "nbands", "firstcell", "datatype")]
    write_blocks(values.select("*", *layout), described, path, mode, **options)


def write_blocks(values: DataFrame, sidecars: DataFrame, path: str, mode: str, **options) -> None:
    """Write values with their layout (ncell, nbands, firstcell, datatype) and the sidecar rows of all variables.

    Rows meet by element block, never by whole year, so a variable and year
    that hold most rows still spread over many tasks. Every block of every
    (variable, year) is written, also one without a row. Cells and bands outside
    the layout, repeated keys, and values that the type cannot hold are errors;
    so is a missing value in a type without sentinel, unless ``fill`` is given.
    Nothing of a write that fails can be read. One write at a time.
    """
    register(values.sparkSession)
    block = int(options.get("blockelements", WRITE_ELEMENTS))
    cell, band, value = F.col("cell").cast("bigint"), F.col("band").cast("bigint"), F.col("value").cast("double")
    first, ncell, nbands = (F.col(c).cast("bigint") for c in ("firstcell", "ncell", "nbands"))
    value = F.when(~F.isnan(value), value)
    low, high = _limits(F.col("datatype"))
    wrong = (
        F.when(ncell.isNull() | nbands.isNull(), F.concat_ws(" ", F.lit("no layout of variable"), F.col("variable")))
        .when(~F.coalesce(cell.between(first, first + ncell - 1) & band.between(0, nbands - 1), F.lit(False)),
              F.concat_ws(" ", F.lit("outside the layout: cell"), cell, F.lit("band"), band))
        .when(~value.between(low, high), F.concat_ws(
            " ", F.lit("outside the range of"), F.col("datatype"), F.lit("cell"), cell, F.lit("value"), value)))
    place = band * ncell + cell - first
    none = F.lit(None)
    rows = values.select(
        "variable", "year", F.floor(place / block).cast("bigint").alias("block"),
        F.when(wrong.isNotNull(), F.raise_error(wrong).cast("bigint")).otherwise(cell).alias("cell"),
        band.cast("int").alias("band"), value.alias("value"), none.cast("string").alias("sidecar"))
    blocks = F.ceil(ncell * nbands / block).cast("bigint")
    text = F.to_json(F.struct(*(F.col(f"`{c}`") for c in sidecars.columns)))
    texts = sidecars.select("variable", blocks.alias("blocks"), text.alias("sidecar"))
    empty = [none.cast("bigint").alias("cell"), none.cast("int").alias("band"), none.cast("double").alias("value")]
    heads = values.select("variable", "year").distinct().join(texts, "variable").select(
        "variable", "year", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"), *empty, "sidecar")
    whole = texts.select("variable", none.cast("int").alias("year"), none.cast("bigint").alias("block"), *empty, "sidecar")
    keys = ["variable", "year", "block"]
    (
        rows.unionByName(heads).unionByName(whole).repartition(*keys)
        .sortWithinPartitions(*keys, F.col("cell").asc_nulls_first())
        .write.format("flatgrid").mode(mode).options(**{k: str(v) for k, v in options.items()}).save(path)
    )


def _limits(datatype: Column) -> tuple[Column, Column]:
    """The least and largest value of an integer type; everything for other types."""
    word, ends = F.lower(datatype), []
    for pick, other in (("min", -np.inf), ("max", np.inf)):
        case = F.when(F.lit(False), F.lit(0.0))
        for name, kind in NUMPY_TYPES.items():
            if kind[0] != "f":
                case = case.when(word == name, F.lit(float(getattr(np.iinfo(kind), pick))))
        ends.append(case.otherwise(F.lit(float(other))))
    return ends[0], ends[1]

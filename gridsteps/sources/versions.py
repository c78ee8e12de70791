"""Versions of a folder of flat grid blocks.

    _versions/00000003.json       what the third commit published; the highest number counts
    _versions/part-ATTEMPT.parquet    the blocks that one task wrote, by variable, year and place
    _versions/VARIABLE-ATTEMPT.json   a sidecar
    VARIABLE/YEAR/BLOCK-ATTEMPT.bin   the blocks

A version lists the writes that still count, oldest first. A write holds the number of the
version that it made, a line per task that wrote (not per block), its sidecars, and the
years of each variable that it replaced in the writes before it. Files that no version names are never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs

from gridsteps.sources.files import open_path

FOLDER = "_versions"
# Rows in a part's row groups: a share of a part reads only the groups it lies in.
GROUP_ROWS = 1024
NAMED_VARIABLES = 64

ENTRY = pa.schema([("variable", pa.string()), ("year", pa.int32()), ("base", pa.int64()), ("elements", pa.int64()), ("file", pa.string())])


def read_text(path: str) -> str:
    system, inner = open_path(path)
    with system.open_input_file(inner) as f:
        return f.read().decode()


def put_text(path: str, text: str) -> None:
    """Replace a small file whole."""
    system, inner = open_path(path)
    draft = f"{inner}.{uuid.uuid4().hex}"
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(draft) as out:
        out.write(text.encode())
    system.move(draft, inner)


def _numbered(system: pafs.FileSystem, root: str) -> list[str]:
    found = system.get_file_info(pafs.FileSelector(f"{root}/{FOLDER}", allow_not_found=True))
    return sorted(f.base_name for f in found if f.base_name[:8].isdigit() and f.base_name.endswith(".json"))


def newest(path: str) -> dict | None:
    """The version that counts, or None."""
    system, root = open_path(path)
    names = _numbered(system, root.rstrip("/"))
    return numbered(path, int(names[-1][:8])) if names else None


def numbered(path: str, number: int) -> dict:
    """One version, with its ``number``."""
    return {"number": number} | json.loads(read_text(f"{path.rstrip('/')}/{FOLDER}/{number:08d}.json"))


def publish(path: str, write: dict, replace: bool) -> None:
    """Make a write the last one of a new version; writes of which nothing is left are dropped."""
    system, root = open_path(path)
    root = root.rstrip("/")
    names = _numbered(system, root)
    number = int(names[-1][:8]) + 1 if names else 1
    earlier = [] if replace or not names else newest(path)["writes"]
    writes = [*earlier, write | {"number": number}]
    left = []
    for i, w in enumerate(writes):
        gone = written_later({"writes": writes}, i)
        if i == len(writes) - 1 or any((v, y) not in gone for v, years in w["years"].items() for y in years):
            left.append(w)
    put_text(f"{path.rstrip('/')}/{FOLDER}/{number:08d}.json", json.dumps({"writes": left}))


def written_later(version: dict, index: int) -> set[tuple[str, int]]:
    """(variable, year) that writes after one have replaced."""
    return {(v, y) for w in version["writes"][index + 1:] for v, years in w["years"].items() for y in years}


def write_part(system: pafs.FileSystem, root: str, attempt: str, entries: list[dict]) -> tuple[dict | None, dict[str, list[int]]]:
    """Store the blocks of one task; returns their summary, and the years of each variable."""
    if not entries:
        return None, {}
    entries = sorted(entries, key=lambda e: (e["variable"], e["year"], e["base"]))
    name = f"{FOLDER}/part-{attempt}.parquet"
    system.create_dir(f"{root}/{FOLDER}", recursive=True)
    pq.write_table(pa.Table.from_pylist(entries, ENTRY), f"{root}/{name}", filesystem=system, row_group_size=GROUP_ROWS)
    years: dict[str, set[int]] = {}
    for e in entries:
        years.setdefault(e["variable"], set()).add(e["year"])
    every = [e["year"] for e in entries]
    return {"file": name, "blocks": len(entries), "elements": sum(e["elements"] for e in entries), "first": min(every),
            "last": max(every), "variables": sorted(years) if len(years) <= NAMED_VARIABLES else None
            }, {v: sorted(y) for v, y in years.items()}


def read_part(root: str, name: str, first: int, count: int) -> Iterator[dict]:
    """Entries ``first`` to ``first + count`` of a part."""
    system, inner = open_path(f"{root}/{name}")
    with system.open_input_file(inner) as f:
        table = pq.ParquetFile(f)
        at = 0
        for g in range(table.num_row_groups):
            n = table.metadata.row_group(g).num_rows
            low, high = max(first, at), min(first + count, at + n)
            if low < high:
                yield from table.read_row_group(g).slice(low - at, high - low).to_pylist()
            at += n


def plain_files(path: str) -> list[tuple[str, int]]:
    """(path, length) of the files below a path, without those whose names begin with a dot or an underscore."""
    system, root = open_path(path)
    found = system.get_file_info(root)
    if found.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    if found.type == pafs.FileType.File:
        return [(path, found.size)]
    prefix = path[:len(path) - len(root)] if "://" in path else ""
    below = system.get_file_info(pafs.FileSelector(root, recursive=True))
    return sorted((prefix + f.path, f.size) for f in below if f.type == pafs.FileType.File
                  and not any(x.startswith((".", "_")) for x in f.path[len(root):].strip("/").split("/")))

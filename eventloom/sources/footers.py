"""Sizes from Parquet footers, without reading a row."""

from __future__ import annotations

import os
from collections.abc import Iterable

import pyarrow.parquet as pq


def uncompressed_bytes(path: str) -> int:
    meta = pq.read_metadata(path)
    return sum(meta.row_group(g).column(c).total_uncompressed_size for g in range(meta.num_row_groups) for c in range(meta.num_columns))


def volume(paths: list[str]) -> dict[str, int]:
    sizes = [os.path.getsize(p) for p in paths]
    return {"files": len(paths), "file_bytes": sum(sizes), "least_bytes": min(sizes, default=0), "most_bytes": max(sizes, default=0), "uncompressed_bytes": sum(map(uncompressed_bytes, paths))}


def rows_in(paths: Iterable[str]) -> int:
    return sum(pq.read_metadata(p).num_rows for p in paths)

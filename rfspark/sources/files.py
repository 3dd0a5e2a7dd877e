"""Files on any file system the cluster shares, listed and opened by path."""

from __future__ import annotations

from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql.datasource import InputPartition


def filesystem(path: str):
    """The file system of a path or URI, and the path inside it."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


@dataclass
class Files(InputPartition):
    """Some whole files, read by one task."""

    names: list

    def __init__(self, names):
        super().__init__(0)
        self.names = names


def listed(path: str, suffix: str = "") -> list:
    """URIs and sizes of the data files below a folder (or of one file), in order.

    A name keeps the scheme and the host of the path it was listed under, so a
    task opens it in the same store.
    """
    system, inner = filesystem(path)
    info = system.get_file_info(inner)
    if info.is_file:
        return [(path, info.size)] if path.endswith(suffix) else []
    base = inner.rstrip("/")
    found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted(
        (path.rstrip("/") + f.path[len(base) :], f.size)
        for f in found
        if f.is_file and f.path.endswith(suffix) and not f.base_name.startswith((".", "_"))
    )


def packed(files: list, max_bytes: int = 256 << 20, max_files: int = 256) -> list:
    """Group small files so that a task gets a fair amount; a large file stays alone."""
    groups, current, size = [], [], 0
    for name, n in files:
        if current and (size + n > max_bytes or len(current) >= max_files):
            groups.append(Files(current))
            current, size = [], 0
        current.append(name)
        size += n
    return groups + ([Files(current)] if current else [])

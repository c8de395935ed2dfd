"""Files of the Python data sources, on any file system that Arrow knows: local paths, s3://, gs://, hdfs://, file://."""

from __future__ import annotations

import gzip
import io
import os
from fnmatch import fnmatch
from glob import glob

from pyarrow import fs


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))


def expand(pattern: str) -> list[str]:
    """The files that match, in order; the pattern itself where it has no wildcard. Wildcards of an address stand in its last part."""
    if "://" not in pattern:
        return sorted(glob(pattern)) or [pattern]
    folder, _, last = pattern.rpartition("/")
    if not set(last) & set("*?["):
        return [pattern]
    system, inside = _place(folder)
    found = [f"{folder}/{i.base_name}" for i in system.get_file_info(fs.FileSelector(inside)) if i.is_file and fnmatch(i.base_name, last)]
    return sorted(found) or [pattern]


def size(path: str) -> int:
    system, inside = _place(path)
    info = system.get_file_info(inside)
    if not info.is_file:
        raise FileNotFoundError(path)
    return info.size


def open_binary(path: str, unzip: bool = False):
    """The bytes of a file, to be read and sought in; with `unzip` what its gzip members hold."""
    system, inside = _place(path)
    file = io.BufferedReader(system.open_input_file(inside), 1 << 20)
    return gzip.GzipFile(fileobj=file) if unzip else file

"""Files that tasks write to and read from the shared folder, by URI, wherever pyarrow can reach it.

A task writes under a name of its own and reports it in its output row; only files that a committed manifest names count,
so a repeated or lost task leaves at most a file nobody reads.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.fs as pafs


def _resolved(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def own_name(folder: str, task: int, suffix: str) -> str:
    return f"{folder}/{task:06d}-{uuid.uuid4().hex}{suffix}"


def writer(uri: str) -> pa.NativeFile:
    system, path = _resolved(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def reader(uri: str) -> pa.NativeFile:
    """For reading ranges."""
    system, path = _resolved(uri)
    return system.open_input_file(path)


def stream(uri: str) -> pa.NativeFile:
    """For reading once from the start."""
    system, path = _resolved(uri)
    return system.open_input_stream(path, compression=None)

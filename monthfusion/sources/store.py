"""Byte access of tasks to files in any store pyarrow knows."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs

COMPRESSED = (".gz", ".bz2", ".zst", ".lz4")
BLOCK = 1 << 22


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """A store and the path in it, from a name as Spark lists it (not percent-encoded)."""
    if ":" not in uri or uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + re.sub("^(file:)?/*", "", uri)
    scheme, rest = re.fullmatch("([^:]+)://(.*)", uri).groups()
    bucket, _, key = rest.partition("/")
    store, root = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{bucket}")
    return store, f"{root.rstrip('/')}/{key}" if root else key


def reachable(uri: str) -> bool:
    """Whether tasks can open files beside this one without Spark's readers."""
    try:
        locate(uri)
    except (pa.ArrowException, OSError, ValueError, AttributeError):
        return False
    return True


def blocks(uri: str, start: int = 0, end: int | None = None, size: int = BLOCK) -> Iterator[bytes]:
    """The bytes of a file from ``start`` to ``end``; a compressed file from its first."""
    store, path = locate(uri)
    if uri.endswith(COMPRESSED):
        with store.open_input_stream(path) as source:
            while data := source.read(size):
                yield data
        return
    with store.open_input_file(path) as source:
        source.seek(start)
        while data := source.read(size if end is None else min(size, end - start)):
            yield data
            start += len(data)
            if end is not None and start >= end:
                return

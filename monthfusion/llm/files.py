"""Byte files of tasks in the folder all executors share, by any store pyarrow knows."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """A store and the path in it; ``file:`` with any number of slashes is a plain path."""
    if uri.startswith("file:"):
        uri = "/" + re.sub("^file:/*", "", uri)
    return fs.FileSystem.from_uri(uri)


@contextmanager
def new_file(uri: str) -> Iterator[pa.NativeFile]:
    """Write a file under another name first, so that a lost or repeated task never
    leaves half a file under this one."""
    store, path = locate(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    with store.open_output_stream(draft) as out:
        yield out
    store.move(draft, path)


def open_file(uri: str) -> pa.NativeFile:
    store, path = locate(uri)
    return store.open_input_file(path)

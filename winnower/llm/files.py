"""Binary files that tasks write to and read from a shared folder, whatever its store."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlsplit

from pyarrow import fs

_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """The store of a folder and the folder's path in it."""
    parts = urlsplit(folder)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), parts.path
    scheme = _SCHEMES.get(parts.scheme, parts.scheme)
    return fs.FileSystem.from_uri(folder.replace(parts.scheme, scheme, 1))


@contextmanager
def new_file(folder: str, label: str, suffix: str) -> Iterator[tuple[str, object]]:
    """(name, stream) of a file that no other attempt of the task writes.

    A failed attempt leaves a file that nothing refers to: names are only
    passed on by the rows of tasks that succeed.
    """
    store, base = file_system(folder)
    store.create_dir(base, recursive=True)
    name = f"{label}-{uuid.uuid4().hex}{suffix}"
    with store.open_output_stream(f"{base}/{name}", compression=None) as stream:
        yield name, stream

"""Binary files in the shared folder, written and read by tasks on any machine."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyarrow import fs as pafs


def opened(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder's URI or local path."""
    if "://" in folder or folder.startswith("file:"):
        return pafs.FileSystem.from_uri(folder if not folder.startswith("file:/") or folder.startswith("file://") else "file://" + folder[5:])
    return pafs.LocalFileSystem(), folder


@contextlib.contextmanager
def created(folder: str, name: str) -> Iterator:
    """A file that appears under its name when it is whole: a task that is lost or runs twice leaves no half file."""
    fs, path = opened(folder)
    fs.create_dir(path, recursive=True)
    part = f"{path}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part, compression=None) as f:
        yield f
    fs.move(part, f"{path}/{name}")

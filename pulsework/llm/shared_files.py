"""Binary files in the folder that all executors share, on any file system that pyarrow knows."""

from __future__ import annotations

import uuid

from pyarrow import fs


def open_path(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; a bare path is on a mounted, shared disk."""
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))
    return fs.LocalFileSystem(), uri


def write_new(folder: str, stem: str, suffix: str, parts) -> str:
    """Write a file under a name that no other attempt of the task uses, and return its URI.

    Readers take names only from a manifest that Spark has committed, so what a lost or
    doubled attempt leaves behind is never read.
    """
    uri = f"{folder}/{stem}-{uuid.uuid4().hex[:12]}{suffix}"
    system, path = open_path(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path) as out:
        for part in parts:
            out.write(part)
    return uri

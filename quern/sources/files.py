"""Files opened inside a task, by the paths that Spark lists."""

from __future__ import annotations

from urllib.parse import quote


def store_of(path: str):
    """The file system of a path as Spark names it, and the path inside it."""
    from pyarrow import fs

    scheme, found, rest = path.partition(":")
    if not found:
        return fs.LocalFileSystem(), path
    if scheme == "file":  # listed paths are not escaped
        path = "file://" + quote("/" + rest.lstrip("/"))
    elif scheme in ("s3a", "s3n"):  # names of the same store that only Hadoop knows
        path = "s3:" + rest
    return fs.FileSystem.from_uri(path)


def opened(path: str, packed: bool = False):
    """A stream over the file's bytes, unpacked where its name says that it is compressed.

    ``packed`` leaves the bytes as they are stored.
    """
    system, inner = store_of(path)
    return system.open_input_stream(inner, compression=None if packed else "detect")
